"""Spelling variants: words one edit apart, found by prefix-suffix tiles.

Two words of at most M code points are one edit apart exactly when their common prefix and
common suffix together reach M - 1. Then there is a place of the edit, and all before it
and behind it is common. Places are cut into a few segments; words that agree on all
letters outside a segment meet in a bucket of that segment. A bucket is dealt into blocks,
and every pair of blocks is a tile: a task compares the words of a tile as matrices of
code points, one padded on the right for prefixes and one on the left for suffixes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cardtide.llm.common import ascii_lower, stored

SEGMENTS = 4
BLOCK_WORDS = 512
# Cells of the comparison matrices that a task holds at once.
CELLS = 4_000_000
# Fixed value: the letters a word is made of.
LETTERS = r"[A-Za-zÀ-ÿ]"


def misspelt_words(
    docs: DataFrame, min_chars: int = 7, min_count: int = 2, every: int = 31
) -> DataFrame:
    """Words of all texts with their number of occurrences: ``word, n``.

    A word is a maximal run of letters with A-Z lower-cased. Where ``every`` divides the
    crc32 h of ``<doc_id>:<run>``, code point h % length is left out. Words below
    ``min_chars`` code points or ``min_count`` occurrences are dropped. A null text has no
    word; a null doc_id counts as empty.
    """
    runs = F.regexp_extract_all(
        ascii_lower(F.col("text")), F.lit(f"{LETTERS}{{{int(min_chars)},}}"), F.lit(0)
    )
    found = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_id"), F.explode(runs).alias("run")
    )
    h = F.crc32(F.concat("_id", F.lit(":"), "run"))
    found = found.select("run", h.alias("h"), F.char_length("run").alias("size"))
    at = (F.col("h") % F.col("size")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.col("size")))
    word = F.when(F.col("h") % every == 0, shorter).otherwise(F.col("run"))
    counted = found.select(word.alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter((F.col("n") >= min_count) & (F.char_length("word") >= min_chars))


def near_words(
    words: DataFrame, segments: int = SEGMENTS, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """Pairs of words one inserted, deleted or replaced code point apart, either way round:
    ``word, other, other_n``. ``words(word, n)`` holds each word once and is stored.

    Buckets of any size are split into tiles, so none is compared in one task, and each pair
    of near words is found in exactly one tile.
    """
    keys = _keys(words, segments)
    sizes = keys.groupBy("bucket").agg(F.count(F.lit(1)).alias("held")).filter(F.col("held") > 1)
    ways = F.ceil(F.col("held") / block_words).cast("int")
    dealt = keys.join(sizes.select("bucket", ways.alias("ways")), "bucket")
    block = F.pmod(F.xxhash64(F.lit(13), "word"), F.col("ways")).cast("int")
    dealt = dealt.withColumn("block", block).withColumn(
        "beside", F.explode(F.sequence(F.lit(0), F.col("ways") - 1))
    )
    tiles = dealt.select(
        "bucket",
        F.least("block", "beside").alias("low"),
        F.greatest("block", "beside").alias("high"),
        "block",
        "longest",
        "first",
        "behind",
        "word",
        "n",
    )
    tiles = tiles.repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high")
    return tiles.mapInArrow(_compare_tiles, "word string, other string, other_n long")


def _keys(words: DataFrame, segments: int) -> DataFrame:
    """A row per word, greater length M of a pair it may be in, and segment of M's places.

    ``first`` and ``behind`` bound the places of the segment; the bucket follows from M, these and
    the letters outside.
    """
    size = F.char_length("word")
    spans = F.flatten(
        F.transform(
            F.array(size, size + 1),
            lambda m: F.transform(
                F.sequence(F.lit(0), F.lit(segments - 1)),
                lambda s: F.struct(
                    m.alias("longest"),
                    F.floor(s * m / segments).cast("int").alias("first"),
                    F.floor((s + 1) * m / segments).cast("int").alias("behind"),
                ),
            ),
        )
    )
    each = words.select("word", "n", F.explode(spans).alias("span")).select("word", "n", "span.*")
    before = F.substring("word", F.lit(1), F.col("first"))
    # The last M - behind letters, counted from the word's own end.
    after = F.substring(
        "word",
        F.char_length("word") - (F.col("longest") - F.col("behind")) + 1,
        F.col("longest") - F.col("behind"),
    )
    bucket = F.xxhash64("longest", "first", "behind", before, after)
    return each.filter(F.col("first") < F.col("behind")).withColumn("bucket", bucket)


def _compare_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near pairs of each tile; tiles come one after the other, rows of a tile together."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        tile = _tile_numbers(batch)
        last = int(np.searchsorted(tile, tile[-1]))
        # A tile that goes on in the next batch waits for it.
        if last:
            yield from _compare(pa.Table.from_batches([*waiting, batch.slice(0, last)]))
            waiting = [batch.slice(last)]
        elif waiting and not _same_tile(waiting[-1], batch):
            yield from _compare(pa.Table.from_batches(waiting))
            waiting = [batch]
        else:
            waiting.append(batch)
    if waiting:
        yield from _compare(pa.Table.from_batches(waiting))


def _tile_numbers(rows: pa.RecordBatch | pa.Table) -> np.ndarray:
    """0, 0, 1, ...: a number per row that rises where the next tile begins."""
    change = np.zeros(rows.num_rows, bool)
    for name in ("bucket", "low", "high"):
        values = rows.column(name).to_numpy()
        change[1:] |= values[1:] != values[:-1]
    return np.cumsum(change)


def _same_tile(left: pa.RecordBatch, right: pa.RecordBatch) -> bool:
    return all(
        left.column(name)[left.num_rows - 1] == right.column(name)[0] for name in ("bucket", "low", "high")
    )


def _compare(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    tile = _tile_numbers(rows)
    number = {c: rows.column(c).to_numpy() for c in ("low", "high", "block", "longest", "first", "behind")}
    words = rows.column("word").combine_chunks()
    counts = rows.column("n").to_numpy()
    texts = words.to_pylist()
    size = np.array([len(t) for t in texts])
    for longest in np.unique(number["longest"]).tolist():
        chosen = np.flatnonzero(number["longest"] == longest)
        ends = np.searchsorted(tile[chosen], tile[chosen], side="right")
        partners = ends - np.arange(len(chosen)) - 1
        most = max(1, CELLS // max(1, longest))
        at = 0
        while at < len(chosen):
            # As many rows as make ``most`` pairs, one at least.
            upto = at + max(1, int(np.searchsorted(np.cumsum(partners[at:]), most, side="right")))
            a = np.repeat(np.arange(at, upto), partners[at:upto])
            first = np.cumsum(partners[at:upto]) - partners[at:upto]
            b = a + 1 + np.arange(len(a)) - np.repeat(first, partners[at:upto])
            at = upto
            one, two = chosen[a], chosen[b]
            crossing = (number["low"][one] == number["high"][one]) | (
                number["block"][one] != number["block"][two]
            )
            apt = crossing & (np.maximum(size[one], size[two]) == longest)
            one, two = one[apt], two[apt]
            if not len(one):
                continue
            prefix, suffix = _common(texts, size, one, two, longest)
            near = (prefix + suffix >= longest - 1) & (prefix < longest)
            # The pair's place of edit must be in this segment; it meets in others as well.
            near &= (number["first"][one] <= prefix) & (prefix < number["behind"][one])
            one, two = one[near], two[near]
            if len(one):
                left, right = np.concatenate([one, two]), np.concatenate([two, one])
                yield pa.record_batch(
                    [words.take(pa.array(left)), words.take(pa.array(right)), pa.array(counts[right])],
                    names=["word", "other", "other_n"],
                )


def _common(texts, size: np.ndarray, one: np.ndarray, two: np.ndarray, longest: int):
    """Lengths of the common prefix and the common suffix of each pair."""
    used, place = np.unique(np.concatenate([one, two]), return_inverse=True)
    codes = np.frombuffer("".join(texts[i] for i in used.tolist()).encode("utf-32-le"), np.uint32)
    lengths = size[used]
    starts = np.cumsum(lengths) - lengths
    column = np.arange(longest)
    held = column < lengths[:, None]
    last = max(0, len(codes) - 1)
    forward = np.where(held, codes[np.minimum(starts[:, None] + column, last)], 0xFFFFFFFF)
    backward = np.where(
        held, codes[np.clip((starts + lengths - 1)[:, None] - column, 0, last)], 0xFFFFFFFF
    )
    left, right = place[: len(one)], place[len(one) :]

    def common(matrix: np.ndarray) -> np.ndarray:
        differ = matrix[left] != matrix[right]
        return np.where(differ.any(axis=1), differ.argmax(axis=1), longest)

    return common(forward), common(backward)


def spelling_forms(
    words: DataFrame, ratio: int = 10, segments: int = SEGMENTS, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of ``words(word, n)``, each word once.

    ``n_near`` counts a word's near words. Its ``form`` is the one of largest n, ties to the
    smallest in code-point order, if that n is at least ``ratio`` times the word's own; else
    null, like ``form_n``. ``root`` is reached by following forms to the last; it is the word itself
    if there is none. Null words take no part.
    """
    words = stored(words.filter(F.col("word").isNotNull()).select("word", "n"), "words")
    # A struct is compared by its fields in turn, and texts by code points.
    best = F.min(F.struct((-F.col("other_n")).alias("minus"), F.col("other").alias("form")))
    near = near_words(words, segments, block_words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), best.alias("best")
    )
    found = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), "best.form", (-F.col("best.minus")).alias("form_n")
    )
    real = F.col("form_n") >= F.col("n") * ratio
    found = stored(
        found.select(
            "word",
            F.when(real, F.col("form")).alias("form"),
            "n",
            "n_near",
            F.when(real, F.col("form_n")).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(found.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root")))
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def _roots(links: DataFrame) -> DataFrame:
    """Follow ``word, root`` to the end, twice as far in every round.

    A form has more occurrences than its word, so there is no circle and a path is shorter
    than the digits of the greatest count.
    """
    while True:
        nexts = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = stored(links.join(nexts, "root", "left"), "roots")
        links = moved.select("word", F.coalesce("further", "root").alias("root"))
        if moved.filter(F.col("further").isNotNull()).isEmpty():
            return links
