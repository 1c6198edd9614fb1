"""Repeated byte strings: positions of a difference cover are named, names are refined, neighbours compared.

A byte is removed when some string of ``length`` bytes that covers it also starts anywhere else. As in the
difference-cover way to sort suffixes, only sampled positions are named, any two equal strings hold samples at equal
offsets, and the positions between samples are decided through the next sample's name. Two things differ (the
README has the figures). The cover is chosen by content: a position is sampled when its 16-byte hash is the least
of some window of ``width`` such hashes, so two equal strings have the same samples but for less than
``width`` bytes at their edges, and about 2 of ``width`` positions are sampled instead of 2 of 3. And names are
fingerprints of what all strings around a sample share, so that equality needs no order and no long suffix is
ever sorted.

Let ``p`` be the last sample that begins within ``width`` bytes of ``i``; the positions with one ``p`` are a block.
If the string at ``i`` equals the one at ``j``, then ``p`` lies as far behind ``i`` as its twin behind ``j``, and
the ``length - width + 1`` bytes from ``p`` on (the *core*) are equal.

1. Wide cover: blocks whose core occurs at one position only are dropped. That is most of a corpus.
2. Narrow cover, within what is left: a block whose whole span (all its strings) occurs again is decided.
3. The others, and one block of each whole span that shares their core, go down to single positions.

All texts' equal copies are found by digest first. Names are aggregated to their least and greatest position, which
is combined before the shuffle, so a passage that a third of all texts hold costs one row for each task. What is
known of each name is stored before rows are joined with it: adaptive execution splits a large name's rows in a
join, but not where the join's other side is an aggregate over the name in the same job.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tierworks.llm import arrays
from tierworks.llm.carry import packed, unpacked
from tierworks.llm.arrays import U64
from tierworks.plans.workspace import scratch_path

LENGTH = 400
GRAM = 16
#: Up to so many spans (24 bytes each) are broadcast to the texts; beyond, texts that have some are shuffled to them.
BROADCAST_SPANS = 1_000_000
#: Up to so many texts with spans are told from the others by broadcast digests (8 bytes each); beyond, all are shuffled.
BROADCAST_TEXTS = 2_000_000
#: Positions of a text, or of some short ones together, that are worked on at once; what they need fits a core's cache.
PIECE = 1 << 15


def widths(length: int) -> tuple[int, int, int]:
    """Wide and narrow cover and the bytes of a sample's hash; 128, 32 and 16 for strings of 400 bytes.

    Windows that hold one of a string's first ``width`` positions must not reach behind the string, so that its last
    sample there is the same wherever the string stands.
    """
    gram = min(GRAM, max(1, length // 4))
    wide = 1 << int(np.log2(max(1, (length - gram + 2) / 2)))
    return wide, max(1, wide // 4), gram


def parts(data: np.ndarray, length: int) -> Iterator[tuple[int, int, int, np.ndarray]]:
    """``first, behind the last, shift, bytes``: positions decided in a part of a text, and the part's bytes.

    A part starts ``shift`` bytes before its first position, and ends where its last string's samples are certain.
    """
    last, wide = len(data) - length + 1, widths(length)[0]
    for at in range(0, last, PIECE):
        to, low = min(at + PIECE, last), max(0, at - wide)
        yield at, to, at - low, data[low : to + length + 2 * wide]


def symbols(block: arrays.Block, words: bool) -> tuple[np.ndarray, np.ndarray]:
    """What a block's texts are made of, bytes or fingerprints of words, and where each text starts (and the end)."""
    if not words:
        return block.data, block.bounds
    found = arrays.words(block.data, block.bounds, arrays.NOT_SPACE)
    return arrays.span_hashes(block.data, found.starts, found.ends), found.first


def samples(hashes: np.ndarray, width: int, whole: np.ndarray | None = None) -> np.ndarray:
    """Positions whose hash is the least of some ``width`` neighbouring ones; ``width`` is a power of two.

    With ``whole``, only the windows that it marks count (by their first position).
    """
    least, step = hashes, 1
    while step < width:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    if whole is not None:
        least = np.where(whole, least, U64(0))
    around = np.concatenate([np.zeros(width - 1, U64), least, np.zeros(width - 1, U64)])
    step = 1
    while step < width:
        around = np.maximum(around[:-step], around[step:])
        step *= 2
    return np.flatnonzero(around == hashes)


def text_blocks(data: np.ndarray, width: int, length: int) -> tuple[np.ndarray, ...]:
    """``first, last, core name, span name`` of a text's blocks; they share out all positions where a string starts."""
    made, gram = [], widths(length)[2]
    for at, to, shift, part in parts(data, length):
        sums = arrays.Sums(part)
        grams = np.arange(len(part) - gram + 1)
        found = samples(sums.of(grams, grams + gram), width)
        following = np.append(found[1:], len(part) + width)
        first = np.maximum(found - width + 1, shift)
        last = np.minimum(following - width, to - at + shift - 1)
        own = first <= last
        p, first, last = found[own], first[own], last[own]
        core = sums.of(p, p - width + 1 + length)
        span = sums.of(first, last + length)
        made.append((first + at - shift, last + at - shift, core, span))
    return tuple(np.concatenate(x) for x in zip(*made, strict=True)) if made else (np.zeros(0, np.int64),) * 2 + (np.zeros(0, U64),) * 2


def block_blocks(data: np.ndarray, bounds: np.ndarray, width: int, length: int) -> tuple[np.ndarray, ...]:
    """``text, first, last, core name, span name``: ``text_blocks`` of all texts of a block."""
    at, made = 0, []
    while at < len(bounds) - 1:
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + PIECE, "right")) - 1)
        own, part = bounds[at : to + 1] - bounds[at], data[bounds[at] : bounds[to]]
        if len(part) <= PIECE:
            text, *found = _blocks_at_once(part, own, width, length)
        else:  # one text
            found = text_blocks(part, width, length)
            text = np.zeros(len(found[0]), np.int64)
        made.append((text + at, *found))
        at = to
    return tuple(np.concatenate(x) for x in zip(*made, strict=True))


def _blocks_at_once(data: np.ndarray, bounds: np.ndarray, width: int, length: int) -> tuple[np.ndarray, ...]:
    gram = widths(length)[2]
    reach = width + gram - 1
    if len(data) < length:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, U64),) * 2
    sums = arrays.Sums(data)
    grams = np.arange(len(data) - gram + 1)
    long = np.flatnonzero(np.diff(bounds) >= length)
    edges = np.zeros(len(data) - reach + 2, np.int32)  # windows within one text
    edges[bounds[long]] += 1
    edges[bounds[long + 1] - reach + 1] -= 1
    found = samples(sums.of(grams, grams + gram), width, np.cumsum(edges[:-1]) > 0)
    text = np.searchsorted(bounds, found, "right") - 1
    behind = np.append(found[1:], 0)
    behind[np.append(text[1:] != text[:-1], True)] = len(data) + width
    first = np.maximum(found - width + 1, bounds[text])
    last = np.minimum(behind - width, bounds[text + 1] - length)
    own = first <= last
    p, first, last, text = found[own], first[own], last[own], text[own]
    core = sums.of(p, p - width + 1 + length)
    span = sums.of(first, last + length)
    return text, first - bounds[text], last - bounds[text], core, span


def string_names(data: np.ndarray, first: np.ndarray, last: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the given disjoint ascending ranges, and the name of the string at each."""
    places, names = [], []
    for at, to, shift, part in parts(data, length):
        sums = arrays.Sums(part)
        own = (last >= at) & (first < to)
        ranges = zip(np.maximum(first[own], at).tolist(), np.minimum(last[own], to - 1).tolist(), strict=True)
        here = [np.arange(a, b + 1) for a, b in ranges]
        if here:
            place = np.concatenate(here)
            places.append(place)
            names.append(sums.of(place - at + shift, place - at + shift + length))
    return (np.concatenate(places), np.concatenate(names)) if places else (np.zeros(0, np.int64), np.zeros(0, U64))


def merged(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Disjoint ascending ranges that cover the same positions."""
    if not len(first):
        return first, last
    order = np.argsort(first, kind="stable")
    first, last = first[order], np.maximum.accumulate(last[order])
    fresh = np.concatenate(([True], first[1:] > last[:-1] + 1))
    return first[fresh], last[np.append(np.flatnonzero(fresh)[1:] - 1, len(last) - 1)]


def stored(df: DataFrame, label: str) -> DataFrame:
    """Written once into the shared folder, as Parquet; later passes read it there."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def digests(text: Column) -> tuple[Column, Column]:
    """128 bits that stand for a whole text."""
    return F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(1), text).alias("t2")


def place_id() -> Column:
    return F.xxhash64("t1", "t2", "first")


def _names(texts: DataFrame, width: int, length: int, within: bool, words: bool) -> DataFrame:
    """Blocks of ``texts`` (``t1, t2, text`` and, with ``within``, ``ranges``: only blocks that meet one of them)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in arrays.blocks(batches):
            t1, t2 = (block.rows.column(block.rows.schema.get_field_index(c)).to_numpy() for c in ("t1", "t2"))
            ranges = block.rows.column(block.rows.schema.get_field_index("ranges")) if within else None
            data, bounds = symbols(block, words)
            text, first, last, core, span = block_blocks(data, bounds, width, length)
            if within:
                meets, ends = np.zeros(len(first), bool), np.searchsorted(text, np.arange(block.rows.num_rows + 1))
                for k in np.flatnonzero(np.diff(ends)).tolist():
                    own = slice(ends[k], ends[k + 1])
                    low, high = _ranges(ranges[k])
                    at = np.searchsorted(high, first[own])  # the first range that ends at or behind the block's start
                    meets[own] = (at < len(low)) & (low[np.minimum(at, len(low) - 1)] <= last[own])
                text, first, last, core, span = text[meets], first[meets], last[meets], core[meets], span[meets]
            columns = [t1[text], t2[text], first, last, core.view(np.int64), span.view(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["t1", "t2", "first", "last", "core", "span"])

    return texts.mapInArrow(work, "t1 long, t2 long, first long, last long, core long, span long")


def _ranges(cell: pa.Scalar) -> tuple[np.ndarray, np.ndarray]:
    values = cell.values
    return merged(values.field("first").to_numpy().astype(np.int64), values.field("last").to_numpy().astype(np.int64))


def _collected(rows: DataFrame) -> DataFrame:
    """``t1, t2, ranges``: a text's distinct ranges; their number is bound by the text's length."""
    return rows.groupBy("t1", "t2").agg(F.collect_set(F.struct("first", "last")).alias("ranges"))


def _joined(texts: DataFrame, ranges: DataFrame, how: str) -> DataFrame:
    """``texts`` with the lists of spans that ``ranges`` (``t1, t2``, lists) has for them; texts without any are not shuffled."""
    spans = sum(F.coalesce(F.size(c), F.lit(0)) for c in ranges.columns if c not in ("t1", "t2"))
    held, total = ranges.agg(F.count("*"), F.sum(spans + 2)).first()
    if (total or 0) <= BROADCAST_SPANS:
        return texts.join(F.broadcast(ranges), ["t1", "t2"], how)
    if held > BROADCAST_TEXTS:
        return texts.join(ranges, ["t1", "t2"], how)
    some = F.broadcast(ranges.select("t1"))
    with_spans = texts.join(some, "t1", "left_semi").join(ranges, ["t1", "t2"], how)
    return with_spans if how == "inner" else with_spans.unionByName(texts.join(some, "t1", "left_anti"), allowMissingColumns=True)


def repeated_starts(texts: DataFrame, length: int, words: bool = False) -> DataFrame:
    """``t1, t2, ranges`` of positions in distinct texts whose string also starts elsewhere; ``texts``: ``t1, t2, text``.

    Positions and ``length`` are in bytes, or in ``words`` between white space. Copies of a text count as one here.
    """
    wide_width, narrow_width, _ = widths(length)
    wide = _names(texts, wide_width, length, False, words)
    again = stored(_again(wide.select("core", place_id().alias("id")), "core"), "cores")
    left = stored(_collected(wide.select("t1", "t2", "first", "last", "core").join(again, "core", "left_semi")), "ranges")
    held = stored(_joined(texts, left, "inner").dropDuplicates(["t1", "t2"]), "texts")

    narrow = stored(_names(held, narrow_width, length, True, words), "blocks")
    spans = stored(narrow.select("span", place_id().alias("id")).groupBy("span").agg(F.min("id").alias("s0"), F.max("id").alias("s1")), "spans")
    marked = stored(
        narrow.join(spans, "span").select(
            "t1", "t2", "first", "last", "core", (F.col("s0") != F.col("s1")).alias("decided"), (place_id() == F.col("s0")).alias("one")
        ),
        "marked",
    )
    ones = marked.filter("one")
    open_cores = stored(
        ones.groupBy("core")
        .agg(F.min(place_id()).alias("c0"), F.max(place_id()).alias("c1"), F.bool_or(~F.col("decided")).alias("open"))
        .filter("c0 <> c1 AND open"),
        "open-cores",
    )
    open_blocks = stored(_collected(ones.join(open_cores, "core", "left_semi")), "open")
    strings = stored(_strings(held.drop("ranges"), open_blocks, length, words), "strings")
    equal = stored(_again(strings.select("name", place_id().alias("id")), "name"), "names")
    single = strings.join(equal, "name", "left_semi").select("t1", "t2", "first", F.col("first").alias("last"))
    return _collected(marked.filter("decided").select("t1", "t2", "first", "last").unionAll(single))


def _again(rows: DataFrame, name: str) -> DataFrame:
    """Names that stand at two different places at least."""
    return rows.groupBy(name).agg(F.min("id").alias("i0"), F.max("id").alias("i1")).filter("i0 <> i1").select(name)


def _strings(held: DataFrame, open_blocks: DataFrame, length: int, words: bool) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in arrays.blocks(batches):
            t1, t2 = (block.rows.column(block.rows.schema.get_field_index(c)).to_numpy() for c in ("t1", "t2"))
            ranges = block.rows.column(block.rows.schema.get_field_index("ranges"))
            data, bounds = symbols(block, words)
            for k in range(block.rows.num_rows):
                place, name = string_names(data[bounds[k] : bounds[k + 1]], *_ranges(ranges[k]), length)
                columns = [np.full(len(place), t1[k]), np.full(len(place), t2[k]), place, name.view(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["t1", "t2", "first", "name"])

    return _joined(held, open_blocks, "inner").mapInArrow(work, "t1 long, t2 long, first long, name long")


def _starts(texts: DataFrame, length: int, words: bool) -> DataFrame:
    """The same with copies: of a text that several rows hold, all positions (the last one may lie behind the text's)."""
    every = F.array(F.struct(F.lit(0).cast("long").alias("first"), F.col("size").alias("last")))
    copies = (
        texts.groupBy("t1", "t2")
        .agg(F.count("*").alias("n"), F.max(F.octet_length("text")).cast("long").alias("size"))
        .filter("n > 1")
        .select("t1", "t2", every.alias("ranges"))
    )
    found = repeated_starts(texts, length, words).unionByName(copies)
    return stored(_merged(found.groupBy("t1", "t2").agg(F.flatten(F.collect_list("ranges")).alias("ranges"))), "starts")


def _merged(rows: DataFrame) -> DataFrame:
    """The same positions in as few ranges as can be: a passage decided position by position is one."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t1, t2, ranges = (batch.column(batch.schema.get_field_index(c)) for c in ("t1", "t2", "ranges"))
            if not len(ranges):
                continue
            made = [_ranges(cell) for cell in ranges]
            first, last = (np.concatenate(x) for x in zip(*made, strict=True))
            ends = np.cumsum([0, *(len(x) for x, _ in made)])
            pairs = pa.StructArray.from_arrays([pa.array(first), pa.array(last)], ["first", "last"])
            yield pa.RecordBatch.from_arrays([t1, t2, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)], ["t1", "t2", "ranges"])

    return rows.mapInArrow(work, "t1 long, t2 long, ranges array<struct<first: long, last: long>>")


def _spans(cell: pa.Scalar, size: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last position of what goes from a text of ``size`` bytes or words."""
    first, last = _ranges(cell) if cell.is_valid else (np.zeros(0, np.int64),) * 2
    last = np.minimum(last, size - length)
    own = first <= last
    return first[own], last[own] + length - 1


def without_repeats(
    df: DataFrame, text: str = "text", length: int = LENGTH, words: int | None = None, cut_words: bool = True
) -> DataFrame:
    """``df`` with ``n_bytes``, ``removed`` (ascending disjoint byte ranges, ``first`` to ``last``) and ``kept`` (binary: the rest).

    Judged on the texts as given, within and across rows; a text that several rows hold is a repeat of itself. All
    occurrences go, the first included. NULL texts are empty; texts shorter than ``length`` lose nothing. With
    ``words``, ``passages`` (byte ranges like ``removed``) are runs of so many equal words, however short and whatever
    white space stands between them; they go as well, or are only told if ``cut_words`` is false.
    Columns of ``df`` with these names are replaced, all others come back as they are, whatever they are called.
    """
    added = ["n_bytes", "removed", "kept"] + ["passages"] * bool(words)
    cut = _cut(packed(df, text), length, words, cut_words)
    return cut.select(*unpacked([c for c in df.columns if c not in added], text), *added)


def _cut(rows: DataFrame, length: int, words: int | None, cut_words: bool = True, readable: bool = False) -> DataFrame:
    """``text, carried, n_bytes, removed, kept, passages`` of packed rows; ``readable``: the rest as a string, without cut characters."""
    added = ["n_bytes", "removed", "kept", "passages"]
    whole = F.coalesce("text", F.lit(""))
    keyed = rows.select("*", *digests(whole))
    texts = keyed.select("t1", "t2", whole.alias("text"))
    starts = _starts(texts.filter(F.octet_length("text") >= length), length, False)
    names = rows.columns
    starts = starts.withColumnRenamed("ranges", "__ranges")
    if words:
        runs = _starts(texts.filter(F.octet_length("text") >= 2 * words - 1), words, True)
        starts = starts.join(runs.withColumnRenamed("ranges", "__runs"), ["t1", "t2"], "full_outer")
    joined = _joined(keyed, starts, "left").select(*names, *starts.columns[2:])

    def rest(data: np.ndarray) -> bytes | str:
        return data.tobytes().decode("utf-8", "ignore") if readable else data.tobytes()

    def passage_bytes(own: np.ndarray, cell: pa.Scalar) -> tuple[np.ndarray, np.ndarray]:
        found = arrays.words(own, np.array([0, len(own)]), arrays.NOT_SPACE)
        low, high = _spans(cell, len(found.starts), words)
        return merged(found.starts[low], found.ends[high] - 1)

    def pairs(first: np.ndarray, last: np.ndarray) -> list[dict[str, int]]:
        return [{"first": a, "last": b} for a, b in zip(first.tolist(), last.tolist(), strict=True)]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
        for block in arrays.blocks(batches):
            ranges = block.rows.column(block.rows.schema.get_field_index("__ranges"))
            runs = block.rows.column(block.rows.schema.get_field_index("__runs")) if words else None
            removed, kept, passages = [], [], []
            for k in range(block.rows.num_rows):
                own = block.data[block.bounds[k] : block.bounds[k + 1]]
                if not ranges[k].is_valid and not (words and runs[k].is_valid):
                    removed.append([])
                    kept.append(rest(own))
                    passages.append([])
                    continue
                first, last = _spans(ranges[k], len(own), length)
                low, high = passage_bytes(own, runs[k]) if words and runs[k].is_valid else (first[:0], last[:0])
                if cut_words:
                    first, last = np.append(first, low), np.append(last, high)
                first, last = merged(first, last)
                removed.append(pairs(first, last))
                passages.append(pairs(low, high))
                gone = np.zeros(len(own) + 1, np.int8)
                gone[first] = 1
                gone[last + 1] -= 1
                kept.append(rest(own[np.cumsum(gone[:-1], dtype=np.int8) == 0]))
            columns = [block.rows.column(block.rows.schema.get_field_index(c)) for c in names]
            columns += [pa.array(np.diff(block.bounds), pa.int64()), pa.array(removed, pair), pa.array(kept, pa.string() if readable else pa.binary())]
            columns.append(pa.array(passages, pair))
            yield pa.RecordBatch.from_arrays(columns, [*names, *added])

    spans = "array<struct<first: long, last: long>>"
    more = T.StructType.fromDDL(f"n_bytes long, removed {spans}, kept {'string' if readable else 'binary'}, passages {spans}")
    return joined.mapInArrow(cut, T.StructType([*rows.schema.fields, *more.fields]))


def deduplicated(df: DataFrame, text: str = "text", length: int = LENGTH, words: int | None = None) -> DataFrame:
    """``df`` with repeats cut out of its texts; characters of which a byte is gone go in whole.

    A text of which nothing is left becomes empty; NULL stays NULL. Columns of ``df`` stay.
    """
    cut = _cut(packed(df, text), length, words, readable=True)
    some = F.when(F.size("removed") > 0, F.col("kept")).otherwise(F.col("text"))
    return cut.select(*unpacked(df.columns, text, some))
