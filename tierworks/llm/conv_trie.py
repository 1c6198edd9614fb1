"""Prefix trie of conversations that share heads, by fingerprints that compose.

A conversation is rebuilt as the head of a base conversation and its own turns behind that head. No rebuilt text
is ever made: a turn at place ``i`` has the fingerprint ``c * B^i mod P`` (``c``: hash of role and text), the
fingerprint of a run of turns is the sum of these, and moving a run by ``k`` places multiplies it by ``B^k``. So the
fingerprint of every rebuilt prefix follows from two running sums, that of the base and that of the conversation::

    head(h') + (own(j) - own(h)) * B^(h' - h)

Four such sums with bases of their own (124 bits) name a prefix. Prefixes of one name are one node of the trie if all
of them have the same parent and the same last turn; this is checked for every node, and turns count as the same
only if their stored role and text are equal. By induction over the depth the grouping is then exact. If a check
fails, everything is computed anew with other bases.

What a node's subtree adds up to needs no walk: a node belongs to its smallest member, and what a conversation owns of
its own path is always the rest of it from some depth on. So sums over subtrees are sums over members.
"""

from __future__ import annotations

import hashlib
import random
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tierworks.plans import OrderedGroups
from tierworks.plans.workspace import scratch_path, settle

P = (1 << 31) - 1
LANES = 4
#: Turns of a base conversation that a head takes at the most.
MAX_HEAD = 5
#: Places are written with so many digits of base 16.
PLACE_DIGITS = 10
#: Conversation ids that end in one node are written down in runs of ids that agree but for so many bits.
RUN_BITS = 15
TRIES = 5

KEY = ["depth", "k1", "k2"]


def base_of_hundred(conv: Column) -> Column:
    return conv - conv % 100


def head_by_crc(conv: Column) -> Column:
    return (F.crc32(conv.cast("string").cast("binary")) % 6).cast("int")


def bases(seed: int) -> list[int]:
    return random.Random(seed).sample(range(1 << 20, P - 1), LANES)


def longs(values) -> Column:
    return F.expr(f"array({', '.join(f'{v}L' for v in values)})")


def power(base: int, n: Column) -> Column:
    """``base ** n mod P`` by the digits of ``n``; plain arithmetic, so it stays in generated code."""
    out = F.lit(1).cast("long")
    for k in range(PLACE_DIGITS):
        row = longs(pow(base, digit << 4 * k, P) for digit in range(16))
        out = out * F.get(row, F.shiftright(n, 4 * k).bitwiseAND(F.lit(15)).cast("int")) % P
    return out


def numbered_turns(df: DataFrame, conv: str, turn: str, role: str, text: str, seed: int, modulus: int, rows_per_task: int | None) -> DataFrame:
    """Turns with their place in the conversation, ``x1, x2`` (content), ``n_chars``, and running sums up to them."""
    rows = df.select(
        F.col(conv).cast("long").alias("c"),
        F.col(turn).isNotNull().alias("has_turn"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    ).filter(F.col("c").isNotNull())
    groups = OrderedGroups(rows, ["c"], ["has_turn", "turn", "role", "text"], rows_per_task)
    out = groups.running_sum(groups.rows, F.lit(1).cast("long"), "place")
    for k in (1, 2):
        out = out.withColumn(f"x{k}", F.pmod(F.xxhash64(F.lit(2 * seed + k), "role", "text"), F.lit(modulus)))
    out = out.withColumn("n_chars", F.length("text").cast("long"))
    for k, base in enumerate(bases(seed)):
        half = F.col(f"x{1 + k // 2}")
        half = F.shiftrightunsigned(half, 32) if k % 2 else half.bitwiseAND(F.lit(0xFFFFFFFF))
        out = out.withColumn(f"t{k}", (half + 1) % P * power(base, F.col("place")) % P)
    out = groups.running_sum(out, F.col("n_chars"), "chars")
    for k in range(LANES):
        out = groups.running_sum(out, F.col(f"t{k}"), f"s{k}").withColumn(f"s{k}", F.col(f"s{k}") % P)
    sums = [f"{x}{k}" for x in "ts" for k in range(LANES)]
    return out.select("c", "place", "role", "text", "x1", "x2", "n_chars", "chars", *sums)


def heads(turns: DataFrame, base: Column, head: Column) -> DataFrame:
    """One row for each conversation: ``h`` (own turns passed over), ``first`` (turns taken over, at most ``MAX_HEAD``),
    running sums at ``h``, and ``depth`` of the rebuilt conversation."""
    at = F.col("place") == F.col("h")
    sums = [F.coalesce(F.max(F.when(at, F.col(x))), F.lit(0)).alias(f"own_{x}") for x in ["chars", *(f"s{k}" for k in range(LANES))]]
    own = turns.withColumn("h", F.least(head, F.lit(MAX_HEAD))).groupBy("c", "h").agg(F.count(F.lit(1)).alias("n"), *sums)
    columns = ["place", "x1", "x2", "n_chars", "chars", *(f"{x}{k}" for x in "ts" for k in range(LANES))]
    first = turns.filter(F.col("place") <= MAX_HEAD).groupBy(F.col("c").alias("b"))
    first = first.agg(F.array_sort(F.collect_list(F.struct(*columns))).alias("first"))
    out = own.withColumn("b", base).join(first, "b", "left")
    out = out.withColumn("first", F.slice("first", F.lit(1), F.col("h")))
    n_first = F.coalesce(F.array_size("first"), F.lit(0))
    out = out.withColumn("n_first", n_first).withColumn("depth", (n_first + F.greatest(F.lit(0), F.col("n") - F.col("h"))).cast("long"))
    last = F.get("first", F.col("n_first") - 1)
    return out.withColumns({f"head_{x}": F.coalesce(last[x], F.lit(0)) for x in ["chars", *(f"s{k}" for k in range(LANES))]})


def _keys(lanes: list[Column], names: tuple[str, str]) -> list[Column]:
    return [(lanes[2 * k] * (1 << 31) + lanes[2 * k + 1]).alias(names[k]) for k in range(2)]


def rebuilt_prefixes(turns: DataFrame, convs: DataFrame, seed: int) -> DataFrame:
    """One row for each conversation and depth: the prefix's name, its parent's, and a reference to its last turn."""
    sums = [f"s{k}" for k in range(LANES)]
    root = convs.select(
        "c",
        F.lit(0).cast("long").alias("depth"),
        *(F.lit(0).cast("long").alias(x) for x in ("k1", "k2", "p1", "p2", "x1", "x2", "n_chars", "chars")),
        *(F.lit(None).cast("long").alias(x) for x in ("turn_of", "turn_place")),
        F.col("depth").alias("full"),
    )
    head = convs.filter("n_first > 0").select("c", "b", F.col("depth").alias("full"), F.inline("first"))
    head = head.select(
        "c",
        F.col("place").alias("depth"),
        *_keys([F.col(s) for s in sums], ("k1", "k2")),
        *_keys([F.pmod(F.col(s) - F.col(f"t{k}"), F.lit(P)) for k, s in enumerate(sums)], ("p1", "p2")),
        *("x1", "x2", "n_chars", "chars"),
        F.col("b").alias("turn_of"),
        F.col("place").alias("turn_place"),
        "full",
    )
    side = convs.filter("n > h").select("c", "h", "n_first", F.col("depth").alias("full"), *(f"{a}_{x}" for a in ("own", "head") for x in ["chars", *sums]))
    own = turns.drop("role", "text").join(side, "c").filter(F.col("place") > F.col("h"))
    lanes, before = [], []
    for k, base in enumerate(bases(seed)):
        inverse = pow(base, -1, P)
        back = F.get(longs(pow(inverse, j, P) for j in range(MAX_HEAD + 1)), F.col("h") - F.col("n_first"))
        upto = F.pmod(F.col(f"s{k}") - F.col(f"own_s{k}"), F.lit(P))
        lanes.append((F.col(f"head_s{k}") + upto * back % P) % P)
        before.append((F.col(f"head_s{k}") + F.pmod(upto - F.col(f"t{k}"), F.lit(P)) * back % P) % P)
    own = own.select(
        "c",
        (F.col("place") - F.col("h") + F.col("n_first")).alias("depth"),
        *_keys(lanes, ("k1", "k2")),
        *_keys(before, ("p1", "p2")),
        *("x1", "x2", "n_chars"),
        (F.col("head_chars") + F.col("chars") - F.col("own_chars")).alias("chars"),
        F.col("c").alias("turn_of"),
        F.col("place").alias("turn_place"),
        "full",
    )
    return root.unionByName(head).unionByName(own)


def _nodes(prefixes: DataFrame) -> DataFrame:
    ends = F.count(F.when(F.col("depth") == F.col("full"), 1))
    low_high = [f(x).alias(f"{n}_{x}") for x in ("p1", "p2", "x1", "x2") for n, f in (("low", F.min), ("high", F.max))]
    return prefixes.groupBy(*KEY).agg(
        F.min("c").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        ends.alias("n_ends"),
        F.max(F.col("chars") - F.col("n_chars")).alias("chars_before"),
        F.min("turn_of").alias("last_conv_id"),
        F.min_by("turn_place", "turn_of").alias("last_place"),
        *low_high,
    )


def _one_turn_and_parent(nodes: DataFrame) -> bool:
    alike = reduce(lambda a, b: a & b, [F.col(f"low_{x}") == F.col(f"high_{x}") for x in ("p1", "p2", "x1", "x2")])
    return nodes.filter(~alike).limit(1).count() == 0


def _equal_contents(turns: DataFrame) -> bool:
    """Whether turns of the same content hashes have the same role and text, read through stored references."""
    repeated = turns.groupBy("x1", "x2").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("c", "place")).alias("at"))
    repeated = settle(repeated.filter("n > 1").select("x1", "x2", F.col("at.c").alias("c"), F.col("at.place").alias("place")))
    stored = settle(
        turns.select("c", "place", F.col("role").alias("role_"), F.col("text").alias("text_"))
        .join(repeated, ["c", "place"])
        .select("x1", "x2", "role_", "text_")
    )
    found = turns.select("x1", "x2", "role", "text").join(stored, ["x1", "x2"])
    return found.filter((F.col("role") != F.col("role_")) | (F.col("text") != F.col("text_"))).limit(1).count() == 0


def _ends(prefixes: DataFrame) -> DataFrame:
    """Digest of the sorted ids that end in a node: runs of ids are joined side by side, then hashed one after the other."""
    last = prefixes.filter(F.col("depth") == F.col("full"))
    runs = last.groupBy(*KEY, F.shiftright("c", RUN_BITS).alias("run")).agg(F.array_join(F.array_sort(F.collect_list("c")).cast("array<string>"), ",").alias("ids"))
    dealt = runs.repartition(*KEY).sortWithinPartitions(*KEY, "run")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, state = None, None
        for batch in batches:
            done = []
            for depth, k1, k2, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 4)), strict=True):
                if (depth, k1, k2) == own:
                    state.update(b"," + ids.encode())
                    continue
                if own is not None:
                    done.append((*own, state.hexdigest()))
                own, state = (depth, k1, k2), hashlib.sha256(ids.encode())
            if done:
                yield _digests(done)
        if own is not None:
            yield _digests([(*own, state.hexdigest())])

    return dealt.mapInArrow(digest, "depth long, k1 long, k2 long, ends_sha256 string")


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), kinds, strict=True)], [*KEY, "ends_sha256"])


def prefix_trie(
    df: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    base=base_of_hundred,
    head=head_by_crc,
    rows_per_task: int | None = None,
    modulus: int = (1 << 62) - 57,
) -> DataFrame:
    """The trie's nodes: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens``, ``ends_sha256``, ``last_conv_id`` and ``last_place`` (where the node's last turn is stored).

    ``base`` and ``head`` give the base conversation and the head's length as columns of the id (``c``); heads have at most
    ``MAX_HEAD`` turns. Turns are ordered by ``turn`` (NULL first), then role and text, so repeated rows are turns of their
    own, in a defined order. NULL role or text is empty. Rows without id belong to no conversation. A table without
    rows has no nodes, not even a root. Other columns are not read. Ids below zero: remainders keep the sign of the id.
    """
    c = F.col("c")
    for seed in range(TRIES):
        path = scratch_path(df.sparkSession, "turns")
        numbered_turns(df, conv, turn, role, text, seed, modulus if not seed else (1 << 62) - 57, rows_per_task).write.parquet(path)
        turns = df.sparkSession.read.parquet(path)
        convs = settle(heads(turns, base(c), head(c)))
        prefixes = settle(rebuilt_prefixes(turns, convs, seed))
        nodes = settle(_nodes(prefixes))
        if _one_turn_and_parent(nodes) and _equal_contents(turns):
            return _described(nodes, prefixes)
    raise RuntimeError(f"fingerprints of different prefixes were equal {TRIES} times")


def _described(nodes: DataFrame, prefixes: DataFrame) -> DataFrame:
    owned = settle(
        nodes.groupBy(F.col("conv_id").alias("c")).agg(
            F.min_by("chars_before", "depth").alias("owned_from"),
            F.max((F.col("n_ends") == F.col("n_convs")).cast("long")).alias("leaf"),
        )
    )
    full = prefixes.filter(F.col("depth") == F.col("full")).select("c", F.col("chars").alias("all_chars"))
    per_conv = settle(full.join(owned, "c", "left").select("c", F.coalesce("owned_from", "all_chars").alias("upto"), F.coalesce("leaf", F.lit(0)).alias("leaf")))
    shared = F.greatest(F.lit(0), F.col("upto") - (F.col("chars") - F.col("n_chars")))
    sums = prefixes.join(per_conv, "c").groupBy(*KEY).agg(F.sum("leaf").alias("n_leaves"), F.sum(shared).alias("saved_tokens"))
    children = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("low_p1").alias("k1"), F.col("low_p2").alias("k2"))
    children = children.agg(F.count(F.lit(1)).alias("n_children"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("low_p1"), F.col("k2").alias("low_p2"), F.col("conv_id").alias("parent_conv_id"))
    found = settle(nodes.join(parents, ["depth", "low_p1", "low_p2"], "left"))
    out = found.join(sums, KEY).join(children, KEY, "left").join(_ends(prefixes), KEY, "left")
    return out.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        F.coalesce("n_children", F.lit(0)).alias("n_children"),
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
        "last_conv_id",
        "last_place",
    )
