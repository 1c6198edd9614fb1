"""Near duplicates by HyperMinHash: compressed registers, banding, corrected estimates, exact verification.

A text's set are its distinct shingles of ``words`` lower-cased words (a shorter text: its whole sequence). One
hash deals each shingle to one of ``REGISTERS`` buckets; a bucket keeps the smallest value seen as 6 bits of
leading zeros and ``MANTISSA`` bits after them. Empty buckets borrow from the first filled one in an order of
their own that is the same for all texts.

Texts of one set are one class, found by a 128-bit digest, and only classes go on. ``BANDS`` keys of
``ROWS`` registers each make candidates: at similarity 0.8 all bands miss with probability (1 - 0.8^4)^32 =
5e-8. Within a bucket no pairs are made up front: all members are compared with one leader (the member in the
fullest buckets), which then leaves the bucket. A bucket whose members have become one component is settled,
whatever pairs it holds. Others get a second leader. What is still open after that, pairs between different
components of a bucket, is found by the rarest shingles that members share, see :func:`_by_rare_shingles`. Candidates are
cut by size and by the estimate (``SIGMAS`` standard errors below the limit) and then verified on full sets. Nothing
is capped, and at no point all pairs of a bucket are made.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tierworks.llm import arrays
from tierworks.llm.arrays import U64
from tierworks.llm.components import components, pieces
from tierworks.plans.workspace import settle

BANDS, ROWS = 32, 4
REGISTERS = BANDS * ROWS
MANTISSA, VALUE_BITS = 10, 53
PERCENT = 80
SIGMAS = 7
#: Rounds of leaders before what is still open goes by rare shingles.
LEADER_ROUNDS = 2
#: Sizes of sets within this factor are of one class.
SIZE_CLASS = 1.05
#: Up to so many ids (8 bytes each) are broadcast to pick texts; beyond, texts are shuffled.
BROADCAST_IDS = 500_000
#: Up to so many pairs (with registers 300 bytes each) are broadcast to the classes; beyond, both are shuffled.
BROADCAST_PAIRS = 50_000
#: So many pairs are verified in a task.
PAIRS_IN_A_TASK = 2_000


def shingle_sets(block: arrays.Block, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle fingerprints of each text."""
    low = arrays.LOWER[block.data]
    found = arrays.words(low, block.bounds, arrays.NOT_SPACE)
    hashes = arrays.span_hashes(low, found.starts, found.ends)
    runs = arrays.chained(hashes, size)
    out = []
    for a, b in zip(found.first[:-1].tolist(), found.first[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(runs[a : b - size + 1]))
        elif b > a:
            out.append(arrays.mix(arrays.chained(hashes[a:b], b - a) + U64(b - a)))
        else:
            out.append(np.zeros(0, U64))
    return out


@cache
def borrow_orders() -> np.ndarray:
    """For each register the order in which it looks for a filled one; itself first."""
    keys = arrays.mix(np.arange(REGISTERS * REGISTERS, dtype=U64) * U64(arrays.BASE)).reshape(REGISTERS, REGISTERS)
    np.fill_diagonal(keys, 0)
    return np.argsort(keys, axis=1)


def registers_of(shingles: np.ndarray) -> np.ndarray:
    """Compressed registers (uint16) of one non-empty set."""
    none = np.iinfo(np.uint64).max
    least = np.full(REGISTERS, none, U64)
    np.minimum.at(least, (shingles & U64(REGISTERS - 1)).astype(np.int64), shingles >> U64(64 - VALUE_BITS))
    filled = least != none
    part, exponent = np.frexp(np.where(filled, least, 1).astype(float))
    zeros = VALUE_BITS - exponent
    cells = (zeros << MANTISSA) | np.where(part > 0, (part * 2 - 1) * (1 << MANTISSA), 0).astype(np.int64)
    if not filled.all():
        orders = borrow_orders()
        cells = cells[orders[np.arange(REGISTERS), np.argmax(filled[orders], axis=1)]]
    return cells.astype("<u2")


def sketch(df: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """``id, n, d1, d2, registers`` of each row; empty sets have NULL digests and registers."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in arrays.blocks(batches):
            rows = []
            for shingles in shingle_sets(block, size):
                if len(shingles):
                    digest = np.frombuffer(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest(), np.int64).tolist()
                    rows.append((len(shingles), *digest, registers_of(shingles).tobytes()))
                else:
                    rows.append((0, None, None, None))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
            columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([block.rows.column(0), *columns], ["id", "n", "d1", "d2", "registers"])

    rows = df.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(work, "id long, n long, d1 long, d2 long, registers binary")


def chance_matches(n: np.ndarray) -> np.ndarray:
    """For sets of the given sizes, the share of registers at each number of leading zeros."""
    per = np.maximum(n, 1)[:, None] / REGISTERS
    low = np.append(0.5 ** np.arange(1, 33), 0.0)
    high = 0.5 ** np.arange(0, 33)
    return np.exp(-per * low) - np.exp(-per * high)


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Similarity of rows of registers, freed from the matches that chance gives to equal leading zeros."""
    equal = (a == b).mean(axis=1)
    chance = (chance_matches(n_a) * chance_matches(n_b)).sum(axis=1) / (1 << MANTISSA)
    return np.clip((equal - chance) / (1 - chance), 0, 1)


def likely(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Those of the settled ``pairs`` (``a, b``) that sizes and estimates leave open. Small sets are judged by size only."""
    left = classes.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("registers").alias("r_a"))
    right = classes.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("registers").alias("r_b"))
    n = pairs.count()

    def small(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if n <= BROADCAST_PAIRS else df

    both = right.join(small(left.join(small(pairs), "a")), "b")
    sized = both.filter(100 * F.least("n_a", "n_b") >= PERCENT * F.greatest("n_a", "n_b"))
    least = PERCENT / 100 - SIGMAS * (PERCENT / 100 * (1 - PERCENT / 100) / REGISTERS) ** 0.5

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            n_a, n_b = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("n_a", "n_b"))
            r_a, r_b = (
                np.frombuffer(b"".join(batch.column(batch.schema.get_field_index(c)).to_pylist()), "<u2").reshape(-1, REGISTERS)
                for c in ("r_a", "r_b")
            )
            open_ = (np.minimum(n_a, n_b) < 2 * REGISTERS) | (estimate(r_a, r_b, n_a, n_b) >= least)
            chosen = batch.filter(pa.array(open_))
            yield pa.RecordBatch.from_arrays([chosen.column(chosen.schema.get_field_index(c)) for c in ("a", "b")], ["a", "b"])

    return sized.mapInArrow(cut, "a long, b long")


def verified(pairs: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """The pairs ``a, b`` whose full sets are similar; ``texts`` has ``id, text`` of all classes.

    A leader ``a`` stands once before the texts it is compared with, so no row holds two texts. A leader of more than
    ``PAIRS_IN_A_TASK`` pairs is dealt out with them to several tasks.
    """
    pairs = settle(pairs)
    n = pairs.count()
    if not n:
        return pairs
    pairs = pieces(pairs, n)
    busy = pairs.groupBy("a").agg(F.count("*").alias("n")).filter(F.col("n") > PAIRS_IN_A_TASK)
    busy = settle(pieces(busy.select("a", F.ceil(F.col("n") / PAIRS_IN_A_TASK).alias("parts")), n))
    if busy.isEmpty():
        pairs = pairs.withColumn("part", F.lit(0).cast("long"))
    else:
        part = F.coalesce(F.pmod(F.xxhash64("b"), F.col("parts")), F.lit(0))
        pairs = settle(pairs.join(busy, "a", "left").select("a", part.alias("part"), "b"))
    ids = settle(pieces(pairs.select(F.col("a").alias("id")).unionAll(pairs.select("b")), n).distinct())
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    wanted = texts.join(F.broadcast(ids) if few else ids, "id", "left_semi").distinct()

    def small(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if n <= BROADCAST_PAIRS else df

    leaders = wanted.join(small(pairs.select(F.col("a").alias("id"), "a", "part").distinct()), "id")
    members = wanted.join(small(pairs.select(F.col("b").alias("id"), "a", "part", "b")), "id")
    line = leaders.select("a", "part", F.lit(None).cast("long").alias("b"), "text").unionAll(members.select("a", "part", "b", "text"))
    dealt = line.repartition(1 + n // PAIRS_IN_A_TASK, "a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, leading = None, []  # an id may have several texts
        for block in arrays.blocks(batches):
            rows = dict(zip(block.rows.schema.names, block.rows.columns, strict=True))
            found = []
            for a, part, b, own in zip(rows["a"].to_pylist(), rows["part"].to_pylist(), rows["b"].to_pylist(), shingle_sets(block, size), strict=True):
                if (a, part) != last:
                    last, leading = (a, part), []
                if b is None:
                    leading.append(own)
                    continue
                shared = ((len(np.intersect1d(own, x, assume_unique=True)), len(x)) for x in leading)
                if any(k > 0 and 100 * k >= PERCENT * (len(own) + other - k) for k, other in shared):
                    found.append((a, b))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found, strict=True)], ["a", "b"])

    return settle(dealt.mapInArrow(verify, "a long, b long").distinct())


def link_classes(classes: DataFrame, texts: DataFrame, size: int, given: DataFrame) -> DataFrame:
    """``node, root`` of all classes that some link reaches; ``classes``: ``id, n, registers``; ``given``: links ``a, b``."""
    keys = F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda k: F.xxhash64(k, F.substr("registers", k * (2 * ROWS) + 1, F.lit(2 * ROWS))),
    )
    # Sets of up to 3 shingles are similar to equal sets only.
    dealt = classes.filter("n > 3").select("id", F.explode(keys).alias("bucket"))
    full = dealt.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1")
    members = settle(dealt.join(full, "bucket"))
    degrees = members.groupBy("id").agg(F.sum("size").alias("degree"))
    members = settle(members.join(degrees, "id").select("bucket", "id", "degree"))

    roots, tried = settle(components(given)), 0
    rows = members.withColumn("comp", F.col("id"))
    while True:
        rows, open_pairs, open_members = _open(rows)
        if not open_pairs:
            return roots
        last = tried >= LEADER_ROUNDS
        if last:
            pairs = settle(_by_rare_shingles(rows, texts, size))
        else:
            led = pieces(settle(_with_leaders(rows, open_members)), open_members)
            pairs = settle(pieces(led.filter("comp <> leading").select("a", F.col("id").alias("b")), open_members).distinct())
        found = verified(likely(pairs, classes), texts, size)
        known = roots.count() + found.count()
        links = found.unionAll(roots.select(F.col("node").alias("a"), F.col("root").alias("b")))
        roots = pieces(settle(components(pieces(links, known))), known)
        if last:
            return roots
        tried += 1
        # All pairs of a leader within its bucket are decided now, so it leaves the bucket.
        others = led.filter("id <> a").select("bucket", "id", "degree")
        placed = pieces(others.join(roots.withColumnRenamed("node", "id"), "id", "left"), open_members)
        rows = placed.select("bucket", "id", "degree", F.coalesce("root", "id").alias("comp"))


def _open(rows: DataFrame) -> tuple[DataFrame, int, int]:
    """The members of buckets that hold several components (settled), their open pairs, and their number."""
    by_comp = rows.groupBy("bucket", "comp").agg(F.count("*").alias("n"))
    by_bucket = by_comp.groupBy("bucket").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("within"))
    several = settle(by_bucket.filter("n * n > within"))
    pairs, members = several.agg(F.sum((F.col("n") * F.col("n") - F.col("within")) / 2), F.sum("n")).first()
    several = pieces(several.select("bucket"), members or 0)
    kept = settle(pieces(rows.join(several, "bucket", "left_semi"), members or 0))
    return pieces(kept, members or 0), int(pairs or 0), int(members or 0)


def _by_rare_shingles(rows: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """Pairs ``a, b`` of open members in different components, all that can be linked among them.

    Sets of ``x <= y`` shingles are linked if they share at least 4/9 (x + y) of them. Shingles that one component alone has
    are not shared by such pairs; the others are put into one order, rare ones first. Then two linked sets must meet in the first few of
    their orders: among the ``s - 8/9 x + 1`` first of the smaller one, and the ``s - 4/5 y + 1`` first of the larger one. Members
    whose common shingles are too few for any partner have none. Sizes that cannot meet are kept apart by size classes in the
    key. So rows grow with the rare shingles that members share, not with the square of a bucket.
    """
    ids = rows.select("id", "comp").distinct()
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in arrays.blocks(batches):
            sets = shingle_sets(block, size)
            counts = [len(x) for x in sets]
            columns = [pa.array(np.repeat(block.rows.column(k).to_numpy(), counts)) for k in range(3)]
            columns += [pa.array(np.repeat(np.array(counts, np.int64), counts)), pa.array(np.concatenate(sets).view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "comp", "owner", "n", "shingle"])

    held = texts.join(F.broadcast(ids) if few else ids, "id").distinct()
    held = held.select("id", "comp", F.xxhash64("id", "text").alias("owner"), "text")
    shingles = settle(held.mapInArrow(spread, "id long, comp long, owner long, n long, shingle long"))
    common = shingles.groupBy("shingle").agg(F.count("*").alias("held"), F.min("comp").alias("c0"), F.max("comp").alias("c1"))
    common = settle(common.filter("c0 <> c1").select("shingle", "held"))
    order = F.array_sort(F.collect_list(F.struct("held", "shingle")))
    sets = shingles.join(common, "shingle").groupBy("owner", "id", "comp", "n").agg(order.alias("order"))
    sets = sets.withColumn("s", F.size("order").cast("long")).filter("5 * s >= 4 * n")
    sets = settle(sets)

    def size_class(n) -> Column:
        return F.floor(F.log(n.cast("double")) / float(np.log(SIZE_CLASS))).cast("int")

    def first(count: Column) -> Column:
        """The first shingles, with how many of the order are left from there on."""
        left = F.slice("order", F.lit(1), F.greatest(F.lit(0), count).cast("int"))
        return F.inline(F.transform(left, lambda x, k: F.struct(x["shingle"].alias("shingle"), (F.col("s") - k).alias("left"))))

    n, s = F.col("n"), F.col("s")
    smaller = settle(sets.select("owner", "id", "comp", "n", "s", size_class(n).alias("class"), first(s - F.ceil(8 * n / 9) + 1)))
    least, most = F.ceil(4 * n / 5), F.least(n, F.floor((9 * s - 4 * n) / 4))
    larger = sets.filter(most >= least).withColumn("classes", F.sequence(size_class(least), size_class(most)))
    larger = larger.select("owner", "id", "comp", "n", "s", "classes", first(s - F.ceil(4 * n / 5) + 1))
    larger = settle(larger.withColumn("class", F.explode("classes")).drop("classes"))
    x, y = smaller.alias("x"), larger.alias("y")
    before = (F.col("x.n") < F.col("y.n")) | ((F.col("x.n") == F.col("y.n")) & (F.col("x.owner") < F.col("y.owner")))
    # If this is the first shingle that they share, no more than what is left from it on can be shared.
    enough = 9 * F.least("x.left", "y.left") >= 4 * (F.col("x.n") + F.col("y.n"))
    same = (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.class") == F.col("y.class"))
    met = x.join(y, same & (F.col("x.comp") != F.col("y.comp")) & before & enough)
    return met.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()


def _with_leaders(rows: DataFrame, n: int) -> DataFrame:
    """Each of ``n`` members of buckets with the bucket's leader: the one whose buckets are the fullest."""
    rank = F.col("degree")
    leaders = rows.groupBy("bucket").agg(F.max(F.struct(rank.alias("r"), F.col("id").alias("id"), F.col("comp").alias("comp"))).alias("l"))
    leaders = leaders.select("bucket", F.col("l.id").alias("a"), F.col("l.comp").alias("leading"))
    return pieces(rows.join(pieces(leaders, n), "bucket"), n)


def near_duplicates(df: DataFrame, size: int = 5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, n_shingles, component_id, kept`` for each row of ``df``.

    A link joins texts whose shared shingles are at least ``PERCENT`` per cent of all; ``component_id`` is the smallest
    key reachable over links, ``kept`` says that it is the row's own. NULL and empty texts have no shingles and no
    links. Rows of one key count as one document: links of any of their texts join all. Rows with a NULL key
    have no links, a NULL component, and are kept. Other columns are not read.
    """
    marked = settle(sketch(df, key, text, size))
    linked = marked.filter("n > 0 AND id IS NOT NULL")
    sets = linked.groupBy("d1", "d2").agg(F.min("id").alias("rep"))
    members = linked.join(sets, ["d1", "d2"]).select("id", "n", "registers", "rep")
    classes = settle(members.filter("id = rep").select("id", "n", "registers").distinct())
    texts = df.select(F.col(key).cast("long").alias("id"), F.coalesce(text, F.lit("")).alias("text"))
    of_class = members.select("id", "rep").distinct()
    several = of_class.join(of_class.groupBy("id").count().filter("count > 1"), "id").select(
        F.col("id").alias("a"), F.col("rep").alias("b")
    )
    roots = link_classes(classes, texts, size, several)
    placed = of_class.join(roots.withColumnRenamed("node", "rep"), "rep", "left")
    placed = placed.groupBy("id").agg(F.min(F.coalesce("root", "rep")).alias("component_id"))
    return (
        marked.select("id", F.col("n").alias("n_shingles"))
        .join(placed, "id", "left")
        .withColumn("component_id", F.coalesce("component_id", "id"))
        .withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))
    )


def keep_one(df: DataFrame, size: int = 5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group of near duplicates, all columns: the row with the smallest key.

    Of several rows with that key the one with the smallest text (then the smallest of the other columns) stays; rows
    with a NULL key stay.
    """
    judged = near_duplicates(df, size, key, text).filter(F.col("id").isNotNull())
    dropped = settle(judged.filter("NOT kept").select(F.col("id").alias(key)).distinct())
    few = dropped.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    left = df.join(F.broadcast(dropped) if few else dropped, key, "left_anti")
    again = settle(left.filter(F.col(key).isNotNull()).groupBy(key).count().filter("count > 1").select(key))
    if again.isEmpty():
        return left.select(*df.columns)
    order = F.struct(text, *(c for c in df.columns if c != text))
    chosen = left.join(again, key, "left_semi").groupBy(key).agg(F.min(order).alias("row")).select("row.*")
    return left.join(again, key, "left_anti").select(*df.columns).unionByName(chosen.select(*df.columns))
