"""Remove lines that repeat, word for word or nearly, across documents."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructType

from cardtide.llm.common import MAX_BROADCAST_ROWS, components, small, stored

SIMILARITY = 0.8
BANDS, ROWS = 9, 3
# Two lines are alike by the sets of all their runs of so many characters.
WIDTH = 12
MIN_CHARS = 20
# Of the 27 minhashes, so many must be equal before two texts are fetched: 99.9 % are at 0.8.
LEAST_EQUAL = 14
# Code points whose runs a task holds at a time, and of which it takes all minhashes at once: few
# enough to stay in a core's cache.
BLOCK, CACHED = 1 << 20, 1 << 16
# Fills lines shorter than a run: no character.
FILL = "\U0010ffff"
# The order of each permutation: the hash with these bits turned.
TURNED = np.random.RandomState(5).randint(0, 1 << 32, BANDS * ROWS, np.uint32)
NO_RUNS = np.zeros(0, np.uint64)
# Leaders of a bucket in the first round.
LEADERS = 32
# Lines, and characters of them, of a bucket that one task compares at once; larger ones are cut up.
TILE, TILE_CHARS = 2048, 1 << 21
# Lines whose places in the buckets a task deals out at a time, and places that one task sorts.
POSTED, SORTED = 1 << 15, 1 << 19


def _lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """The lines of each document that may be removed: ``doc_id, at, line``."""
    exploded = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("at", "line"))
    return exploded.filter(F.length(F.trim("line")) >= min_chars)


def _runs(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``WIDTH`` characters of each line, and where each line's begin."""
    filled = [s if len(s) >= WIDTH else s.ljust(WIDTH, FILL) for s in lines]
    size = np.array([len(s) for s in filled])
    points = np.frombuffer("".join(filled).encode("utf-32-le"), "<u4").astype(np.uint64)
    step = [np.uint64(pow(0x9E3779B97F4A7C15, n, 1 << 64)) for n in range(9)]
    one = points * np.uint64(0xD6E8FEB86659FD93)
    one ^= one >> np.uint64(29)
    two = one[:-1] * step[1] + one[1:]
    four = two[:-2] * step[2] + two[2:]
    eight = four[:-4] * step[4] + four[4:]
    every = eight[:-4] * step[4] + four[8:]
    every ^= every >> np.uint64(33)
    every *= np.uint64(0xFF51AFD7ED558CCD)
    every ^= every >> np.uint64(29)
    inside = np.ones(len(every), bool)
    inside[(np.cumsum(size)[:-1, None] - np.arange(1, WIDTH)).ravel()] = False
    return every[inside], np.concatenate([[0], np.cumsum(size - WIDTH + 1)[:-1]])


def _texts(column: pa.Array) -> list[str]:
    return [str(x, "utf-8", "replace") for x in column.cast(pa.binary()).to_pylist()]


def _least(lines: list[str]) -> Iterator[tuple[int, int, np.ndarray]]:
    """Stretches of the lines, and per line and permutation the least of its runs."""
    at = 0
    while at < len(lines):
        end, held = at, 0
        while end < len(lines) and (end == at or held + len(lines[end]) <= CACHED):
            held += len(lines[end])
            end += 1
        runs, starts = _runs(lines[at:end])
        high = (runs >> np.uint64(32)).astype(np.uint32)
        least = [np.minimum.reduceat(high ^ t, starts) >> 1 for t in TURNED]
        yield at, end, np.stack(least, axis=1).astype(np.int32)
        at = end


def _with_least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The columns with ``least`` behind them: per permutation the least run of the ``line``."""
    for batch in batches:
        for at, end, least in _least(_texts(batch.column("line"))):
            places = np.arange(0, least.size + 1, len(TURNED), dtype=np.int32)
            rows = batch.slice(at, end - at)
            yield pa.record_batch(
                [*rows.columns, pa.ListArray.from_arrays(places, least.ravel())],
                names=[*rows.schema.names, "least"],
            )


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The columns before ``line``, and ``bands``: the numbers of the line's buckets, 8 bytes each."""
    for batch in batches:
        for at, end, least in _least(_texts(batch.column("line"))):
            size = 8 * BANDS
            places = pa.py_buffer(np.arange(0, size * (end - at) + 1, size, dtype=np.int32))
            bands = pa.Array.from_buffers(
                pa.binary(), end - at, [None, places, pa.py_buffer(_bands(least))]
            )
            rows = batch.slice(at, end - at)
            yield pa.record_batch(
                [rows.column("line_id"), rows.column("first_doc"), rows.column("n"), bands],
                names=["line_id", "first_doc", "n", "bands"],
            )


def _bands(least: np.ndarray) -> np.ndarray:
    """The number of each bucket of each line: a hash of the band and its minhashes."""
    parts = least.astype(np.uint64).reshape(len(least), BANDS, ROWS)
    bands = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (len(least), 1))
    for r in range(ROWS):
        bands = _mixed(bands * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, r])
    return bands


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _dealt(parts: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Per part of the buckets one row with all the lines of a stretch that stand in it, as bytes:
    ``part, bands, lines``."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, ids = [], []
        for batch in batches:
            for at in range(0, batch.num_rows, POSTED):
                rows = batch.slice(at, POSTED)
                held.append(np.frombuffer(b"".join(rows.column("bands").to_pylist()), np.uint64))
                ids.append(np.repeat(rows.column("line_id").to_numpy(), BANDS))
                if sum(map(len, ids)) >= POSTED * BANDS:
                    yield out(np.concatenate(held), np.concatenate(ids))
                    held, ids = [], []
        if held:
            yield out(np.concatenate(held), np.concatenate(ids))

    def out(bands: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
        part = (bands % np.uint64(parts)).astype(np.int32)
        order = np.argsort(part, kind="stable")
        own, starts = np.unique(part[order], return_index=True)
        ends = pa.py_buffer(np.append(starts, len(order)).astype(np.int32) * np.int32(8))
        packed = [
            pa.Array.from_buffers(pa.binary(), len(own), [None, ends, pa.py_buffer(x[order])])
            for x in (bands, ids)
        ]
        return pa.record_batch([pa.array(own), *packed], names=["part", "bands", "lines"])

    return deal


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The buckets of two lines and more: ``line_id, band``.

    ``band`` is made of the lines in it, so buckets of the same lines have the same.
    """
    bands, ids = [], []
    for batch in batches:
        for held, name in ((bands, "bands"), (ids, "lines")):
            held.append(np.frombuffer(b"".join(batch.column(name).to_pylist()), np.int64))
    if not bands:
        return
    band, line = np.concatenate(bands), np.concatenate(ids)
    order = np.argsort(band, kind="stable")
    band, line = band[order], line[order]
    starts = np.flatnonzero(np.append(True, band[1:] != band[:-1]))
    sizes = np.diff(np.append(starts, len(band)))
    # Only the lines of buckets that hold more than one.
    inside = np.repeat(sizes > 1, sizes)
    line, sizes = line[inside], sizes[sizes > 1]
    if not len(sizes):
        return
    starts = np.append(0, np.cumsum(sizes)[:-1])
    named = _mixed(np.add.reduceat(_mixed(line.view(np.uint64)), starts) + sizes.astype(np.uint64))
    first = np.zeros(len(sizes), bool)
    first[np.unique(named, return_index=True)[1]] = True
    inside = np.repeat(first, sizes)
    line, band = line[inside], np.repeat(named, sizes)[inside].view(np.int64)
    for at in range(0, len(line), POSTED):
        yield pa.record_batch(
            [pa.array(line[at : at + POSTED]), pa.array(band[at : at + POSTED])],
            names=["line_id", "band"],
        )


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs ``a, b`` whose lines are alike by the sets of all their runs."""
    for batch in batches:
        a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
        lines_a, lines_b = _texts(batch.column("line_a")), _texts(batch.column("line_b"))
        at = 0
        while at < len(a):
            end, held, lines = at, 0, {}
            while end < len(a) and (end == at or held <= BLOCK):
                for key, line in ((a[end], lines_a[end]), (b[end], lines_b[end])):
                    held += 0 if key in lines else len(line)
                    lines[key] = line
                end += 1
            sets = dict(zip(lines, _sets(list(lines.values())), strict=True))
            alike = [i for i in range(at, end) if _near(sets[a[i]], sets[b[i]])]
            yield batch.select(["a", "b"]).take(pa.array(alike, pa.int64()))
            at = end


def _sets(lines: list[str]) -> list[np.ndarray]:
    """The hashes of each line's runs, in order, each once."""
    runs, starts = _runs(lines)
    ends = [*starts[1:].tolist(), len(runs)]
    for start, end in zip(starts.tolist(), ends, strict=True):
        runs[start:end].sort()
    new = np.ones(len(runs), bool)
    new[1:] = runs[1:] != runs[:-1]
    new[starts] = True
    return np.split(runs[new], np.cumsum(np.add.reduceat(new, starts, dtype=np.int64))[:-1])


def _near(one: np.ndarray, other: np.ndarray) -> bool:
    if min(len(one), len(other)) < SIMILARITY * max(len(one), len(other)):
        return False
    every = np.concatenate([one, other])
    every.sort()
    both = np.count_nonzero(every[1:] == every[:-1])
    return both >= SIMILARITY * (len(one) + len(other) - both)


def _tile_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links ``a, b`` that join the lines of each tile, of rows in order of their ``tile``.

    As many as its components need: pairs of lines already joined, or of one ``root``, are not
    compared. Lines of ``side`` 0 and 1 only meet the other side, those of side -1 each other.
    """
    rest = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if rest is None else pa.concat_tables([rest, rows])
        tiles = rows.column("tile").to_numpy()
        cut = int(np.searchsorted(tiles, tiles[-1])) if len(tiles) else 0
        rest = rows.slice(cut)
        yield from _linked_rows(rows.slice(0, cut))
    if rest is not None:
        yield from _linked_rows(rest)


def _linked_rows(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    if not rows.num_rows:
        return
    rows = rows.combine_chunks()
    ids, roots, tiles, sides = (rows.column(x).to_numpy() for x in ("line_id", "root", "tile", "side"))
    least = np.concatenate([x.flatten().to_numpy() for x in rows.column("least").chunks])
    least = least.reshape(len(ids), BANDS * ROWS)
    bounds = np.append(np.flatnonzero(np.append(True, tiles[1:] != tiles[:-1])), len(ids))
    size = rows.column("size").to_numpy()
    open_pairs, wanted, held = [], [], 0
    for low, high in zip(bounds[:-1], bounds[1:], strict=True):
        pairs = _likely(least[low:high], roots[low:high], sides[low:high])
        if pairs:
            open_pairs.append((low, high, pairs))
            new = low + np.unique(np.concatenate([x for i, others in pairs for x in ([i], others)]))
            wanted.extend(new.tolist())
            held += int(size[new].sum())
        if held > BLOCK:
            yield _compared(rows, ids, roots, open_pairs, wanted)
            open_pairs, wanted, held = [], [], 0
    if open_pairs:
        yield _compared(rows, ids, roots, open_pairs, wanted)


def _likely(least: np.ndarray, roots: np.ndarray, sides: np.ndarray) -> list:
    """Per line of a tile, the later ones of other roots that agree on ``LEAST_EQUAL`` minhashes."""
    found = []
    for i in range(len(least) - 1):
        fit = (least[i + 1 :] == least[i]).sum(axis=1, dtype=np.int8) >= LEAST_EQUAL
        fit &= roots[i + 1 :] != roots[i]
        if sides[i] >= 0:
            fit &= sides[i + 1 :] != sides[i]
        others = fit.nonzero()[0]
        if len(others):
            found.append((i, others + (i + 1)))
    return found


def _compared(rows: pa.Table, ids: np.ndarray, roots: np.ndarray, tiles: list, wanted: list) -> pa.RecordBatch:
    # A line that stands in several tiles is cut into runs once.
    at = dict(zip(ids[wanted].tolist(), wanted, strict=True))
    texts = _texts(rows.column("line").take(pa.array(list(at.values()))).combine_chunks())
    sets = dict(zip(at, _sets(texts), strict=True))
    a, b = [], []
    for low, high, pairs in tiles:
        labels, own = roots[low:high].copy(), ids[low:high].tolist()
        many = sum(len(others) for _, others in pairs) > 2 * (high - low)
        fits = _Fits([sets.get(x, NO_RUNS) for x in own]) if many else None
        for i, others in pairs:
            if many:
                others = fits(i, others[labels[others] != labels[i]])
            for j in others.tolist():
                if labels[i] != labels[j] and _near(sets[own[i]], sets[own[j]]):
                    labels[labels == labels[j]] = labels[i]
                    a.append(own[i])
                    b.append(own[j])
    return pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


class _Fits:
    """Of the lines ``others``, those that may be near a line.

    Runs are counted by the last bits of their hashes, so at least as many as agree; fewer than
    near lines share rule a line out.
    """

    def __init__(self, sets: list[np.ndarray]):
        self.size = np.array([len(x) for x in sets])
        bits = min(max(16, int(64 * self.size.max()).bit_length()), 20)
        self.held = np.zeros(1 << bits, np.int32)
        self.slots = [(x & np.uint64((1 << bits) - 1)).astype(np.int64) for x in sets]

    def __call__(self, one: int, others: np.ndarray) -> np.ndarray:
        size, sizes = self.size[one], self.size[others]
        fit = np.minimum(size, sizes) >= SIMILARITY * np.maximum(size, sizes)
        others, sizes = others[fit], sizes[fit]
        if not len(others):
            return others
        self.held[self.slots[one]] = 1
        every = self.held[np.concatenate([self.slots[j] for j in others])]
        self.held[self.slots[one]] = 0
        both = np.add.reduceat(every, np.append(0, np.cumsum(sizes)[:-1]))
        return others[both >= SIMILARITY * (size + sizes - both)]


def line_components(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Lines that occur again, and where the first one of their kind stands.

    ``line_id, root, first_doc``: the hash of a distinct line that has a copy or a near
    copy, the smallest hash of its component and the smallest doc_id with a line of it.
    """
    distinct = (
        _lines(docs.filter(F.col("doc_id").isNotNull()), min_chars)
        .groupBy("line")
        .agg(F.min("doc_id").alias("first_doc"), F.count(F.lit(1)).alias("n"))
        .select(F.xxhash64("line").alias("line_id"), "line", "first_doc", "n")
    )
    kept = [f for f in distinct.schema if f.name != "line"]
    signed = stored(distinct.mapInArrow(_signed, StructType(kept).add("bands", "binary")), "signatures")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(parts, BANDS * signed.count() // SORTED)
    met = (
        signed.select("line_id", "bands")
        .mapInArrow(_dealt(parts), "part int, bands binary, lines binary")
        .repartition(parts, "part")
        .mapInArrow(_buckets, "line_id long, band long")
    )
    met = stored(met.distinct(), "met")
    held = met.select("line_id").distinct()
    held = small(stored(held, "held"), 2 * MAX_BROADCAST_ROWS)
    # Lines that share a bucket: fetched once, for whatever pairs of them are compared.
    texts = (
        _lines(docs.filter(F.col("doc_id").isNotNull()), min_chars)
        .select(F.xxhash64("line").alias("line_id"), "line")
        .join(held, "line_id", "left_semi")
        .groupBy("line_id")
        .agg(F.min("line").alias("line"))
    )
    texts = texts.mapInArrow(_with_least, StructType([*texts.schema.fields]).add("least", ArrayType(IntegerType())))
    roots = _linked(met, stored(texts, "texts"))

    known = signed.select("line_id", "first_doc", "n").join(
        small(roots), F.col("line_id") == F.col("node"), "left"
    )
    again = known.filter((F.col("n") > 1) | F.col("root").isNotNull()).select(
        "line_id", F.coalesce("root", "line_id").alias("root"), "first_doc"
    )
    again = stored(again, "again")
    # Most roots are a line's own; a component's first document is found before it is joined.
    firsts = small(stored(again.groupBy("root").agg(F.min("first_doc").alias("first_doc")), "firsts"))
    return again.drop("first_doc").join(firsts, "root").select("line_id", "root", "first_doc")


def _linked(met: DataFrame, texts: DataFrame) -> DataFrame:
    """Components of the lines that are alike: ``node, root``.

    All lines of a bucket are compared, within one task, or those of a large one by pairs of its
    slices, a task for each. As every line goes to as many tasks as there are slices, a bucket of
    more slices than leaders meets its leaders first, a star, twice as many each time, and is
    left out as soon as it holds one component.
    """
    lengths = texts.select("line_id", F.length("line").alias("size"))
    sized = met.join(lengths, "line_id").groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size"))
    slices = F.greatest(F.ceil(F.col("n") / TILE), F.ceil(F.col("size") / TILE_CHARS)).cast("int")
    large = sized.select("band", slices.alias("slices")).filter(F.col("slices") > 1)
    large = small(stored(large, "large"))
    cut = met.join(large, "band", "left").withColumn("slices", F.coalesce("slices", F.lit(1)))
    alone = cut.withColumn("root", F.col("line_id"))
    found = stored(_alike_in_tiles(alone.filter(F.col("slices") <= LEADERS), texts), "links")
    roots = stored(components(found), "roots")
    crowd, turn = stored(met.join(large.filter(F.col("slices") > LEADERS), "band"), "crowd"), 0
    while not crowd.isEmpty():
        lines = _open_lines(crowd, roots)[1]
        roots = _joined(roots, stored(_alike(stored(_met_leaders(lines, turn), "pairs"), texts), "links"))
        turn += 1
        lines = _open_lines(crowd, roots)[1].join(large, "band")
        few = lines.filter(F.col("slices") <= LEADERS << turn)
        roots = _joined(roots, stored(_alike_in_tiles(few, texts), "links"))
        crowd = lines.filter(F.col("slices") > LEADERS << turn).select("line_id", "band")
    return roots


def _alike_in_tiles(lines: DataFrame, texts: DataFrame) -> DataFrame:
    """Links that join the lines of each bucket: of ``line_id, band, slices, root``."""
    own = F.when(F.col("slices") > 1, F.pmod(F.xxhash64("line_id"), "slices")).otherwise(0).cast("int")
    met = lines.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    tile = F.when(F.col("slices") == 1, F.col("band")).otherwise(
        F.xxhash64("band", F.least("own", "other"), F.greatest("own", "other"))
    )
    side = F.when(F.col("own") == F.col("other"), -1).otherwise((F.col("own") > F.col("other")).cast("int"))
    placed = met.select("line_id", "root", tile.alias("tile"), side.alias("side")).join(
        texts.select("line_id", "line", F.length("line").alias("size"), "least"), "line_id"
    )
    return placed.repartition("tile").sortWithinPartitions("tile").mapInArrow(_tile_links, "a long, b long")


def _joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """The components of ``roots`` joined by new ``links``: each node's edge to its root stands
    for all links found before, so the union-find only walks the new ones."""
    known = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
    return stored(components(known.unionByName(links)), "roots")


def _open_lines(met: DataFrame, roots: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The lines of buckets that hold more than one component, without and with their ``root``."""
    placed = met.join(small(roots), F.col("line_id") == F.col("node"), "left").select(
        "line_id", "band", F.coalesce("root", "line_id").alias("root")
    )
    mixed = (
        placed.groupBy("band")
        .agg(F.min("root").alias("low"), F.max("root").alias("high"))
        .filter(F.col("low") < F.col("high"))
        .select("band")
    )
    lines = stored(placed.join(small(stored(mixed, "mixed")), "band"), "open")
    return lines.select("line_id", "band"), lines


def _met_leaders(lines: DataFrame, turn: int) -> DataFrame:
    """Pairs of each line and its bucket's leaders of this turn: the lines of least hash.

    One ranking per bucket, limited within each partition before the shuffle, however many leaders.
    """
    n = LEADERS << turn
    order = Window.partitionBy("band").orderBy(F.xxhash64(F.lit(turn), "line_id"), "line_id")
    leaders = (
        lines.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= n)
        .select("band", F.col("line_id").alias("other"), F.col("root").alias("its_root"))
    )
    return _pairs(lines.join(leaders, "band"))


def _pairs(met: DataFrame) -> DataFrame:
    return (
        met.filter(F.col("root") != F.col("its_root"))
        .select(F.least("line_id", "other").alias("a"), F.greatest("line_id", "other").alias("b"))
        .distinct()
    )


def _alike(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs whose sets of runs have a Jaccard similarity of ``SIMILARITY`` or more.

    Pairs that agree on fewer than ``LEAST_EQUAL`` minhashes cannot well be among them; the texts of the
    others are fetched and compared exactly.
    """
    a = [F.col("line_id").alias("a"), F.col("least").alias("l_a")]
    b = [F.col("line_id").alias("b"), F.col("least").alias("l_b")]
    signs = pairs.join(texts.select(a), "a").join(texts.select(b), "b")
    equal = sum(
        (F.element_at("l_a", i + 1) == F.element_at("l_b", i + 1)).cast("int") for i in range(BANDS * ROWS)
    )
    likely = stored(signs.filter(equal >= LEAST_EQUAL).select("a", "b"), "likely")
    joint = likely.join(
        texts.select(F.col("line_id").alias("a"), F.col("line").alias("line_a")), "a"
    ).join(texts.select(F.col("line_id").alias("b"), F.col("line").alias("line_b")), "b")
    return joint.select("a", "b", "line_a", "line_b").mapInArrow(_verified, "a long, b long")


def dedup_lines(
    docs: DataFrame, min_chars: int = MIN_CHARS, drop_emptied: bool = False
) -> DataFrame:
    """Keep one line of each component of copies and near copies, over all documents.

    ``docs`` with all its columns and, in ``text``, without the lines removed; the lines that stay
    keep their order. Lines are cut at line feeds. Two lines are alike when the sets of all their
    runs of 12 characters have a Jaccard similarity of 0.8 or more. Candidates come from 9 bands of 3
    minhashes of those sets (99.8 % at 0.8); each is verified exactly, and a distributed union-find
    joins them. Signatures and the comparison are numpy in Arrow batches, the rest is DataFrames. All
    lines of a bucket are compared, a large one by pairs of its slices, after rounds of leaders if
    there are very many. The line that stays is the first in the document with the smallest doc_id that
    has one. Lines of fewer than ``min_chars`` characters beside blanks stay, as headings,
    brackets and empty lines do.

    A null text stays null, an empty one empty. Documents without a doc_id are left as
    they are and take no part. Rows that repeat a doc_id are one document read several
    times: each keeps the lines that the document keeps. With ``drop_emptied``, a document that
    loses lines and has none but blank ones left is dropped. An empty table stays empty. Other
    columns may have any names.
    """
    again = small(stored(line_components(docs, min_chars), "again"))
    placed = (
        _lines(docs.select("doc_id", "text").filter(F.col("doc_id").isNotNull()), min_chars)
        .select("doc_id", "at", F.xxhash64("line").alias("line_id"))
        .join(again, "line_id")
        .select("doc_id", "at", "root", (F.col("doc_id") == F.col("first_doc")).alias("home"))
    )
    away = placed.filter(~F.col("home")).select("doc_id", "at")
    order = Window.partitionBy("doc_id", "root")
    later = (
        placed.filter("home")
        .withColumn("first_at", F.min("at").over(order))
        .filter(F.col("at") > F.col("first_at"))
        .select("doc_id", "at")
    )
    removed = away.unionByName(later).groupBy("doc_id").agg(F.collect_set("at").alias("removed"))
    removed = stored(removed, "removed")
    n_docs, n_lines = removed.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(F.size("removed")), F.lit(0))
    ).first()
    if n_docs <= MAX_BROADCAST_ROWS and n_lines <= 4 * MAX_BROADCAST_ROWS:
        removed = F.broadcast(removed)
    # The caller's row travels in a struct of its own, so that no name meets one of these.
    given = docs.select(F.col("doc_id"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("given"))
    joined = given.join(removed, "doc_id", "left")
    text = F.col("given.text")
    kept = F.array_join(_without(F.split(text, "\n"), F.sort_array("removed")), "\n")
    cleaned = joined.select(
        "given", "removed", F.when(F.col("removed").isNull(), text).otherwise(kept).alias("cleaned")
    )
    if drop_emptied:
        cleaned = cleaned.filter(F.col("removed").isNull() | F.regexp_like("cleaned", F.lit(r"\S")))
    return cleaned.select(
        *[
            F.col("cleaned").alias(c) if c == "text" else F.col(f"given.`{c}`").alias(c)
            for c in docs.columns
        ]
    )


def _without(lines: Column, removed: Column) -> Column:
    """The lines at other places than those removed (in order): the stretches between them."""
    starts = F.concat(F.array(F.lit(0)), F.transform(removed, lambda at: at + 1))
    ends = F.concat(removed, F.array(F.size(lines)))
    return F.flatten(
        F.zip_with(starts, ends, lambda start, end: F.slice(lines, start + 1, end - start))
    )
