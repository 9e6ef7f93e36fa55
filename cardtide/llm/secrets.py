"""Find secrets in texts: fixed patterns, and Markov models of random strings."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from cardtide.llm.common import WORD

# The base patterns, in the order in which spans are listed.
PATTERNS = {
    "assign": r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]+",
}
# A maximal run that is too short is no match; of these two kinds, none can begin inside one.
LONG_ENOUGH = {"access": r"AKIA[A-Z0-9]{16,}", "hex": r"[0-9a-f]{24,}"}
ASSIGN_LEAST = 6
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
SIDE = len(ALPHABET) + 1
KINDS = (*PATTERNS, "markov")


def _pairs(text: Column) -> Column:
    """The pairs of neighbouring characters of a text, as numbers."""
    chars = F.split(text, "")
    n = F.greatest(F.size(chars) - 1, F.lit(0))
    return F.zip_with(
        F.slice(chars, F.lit(1), n),
        F.slice(chars, F.lit(2), n),
        lambda a, b: F.position(a, F.lit(ALPHABET)) * SIDE + F.position(b, F.lit(ALPHABET)),
    )


def train_markov(samples: DataFrame, smoothing: float = 0.5) -> list[float]:
    """Log-likelihood ratio of each pair of neighbours, from ``samples(text, random)``.

    Two first-order models, one of the strings marked random and one of the rest, each
    smoothed by ``smoothing`` of a count, so that a class without samples is uniform. Null
    or one-character texts add nothing. Only 2 x 68 x 68 counts come to the driver.
    """
    counts = (
        samples.filter(F.col("text").isNotNull() & F.col("random").isNotNull())
        .select(F.col("random").cast("int").alias("random"), F.explode(_pairs(F.col("text"))).alias("pair"))
        .groupBy("random", "pair")
        .count()
        .collect()
    )
    seen = {0: [smoothing] * SIDE**2, 1: [smoothing] * SIDE**2}
    for random, pair, n in counts:
        seen[random][pair] += n
    ratio = []
    for first in range(SIDE):
        row = slice(first * SIDE, (first + 1) * SIDE)
        totals = {k: sum(v[row]) for k, v in seen.items()}
        ratio += [
            math.log(r / totals[1]) - math.log(o / totals[0])
            for r, o in zip(seen[1][row], seen[0][row], strict=True)
        ]
    return ratio


def mean_ratio(text: Column, ratio: Sequence[float]) -> Column:
    """Log-likelihood ratio of a string per pair of neighbours (null below two)."""
    table = F.split(F.lit(",".join(repr(float(x)) for x in ratio)), ",").cast("array<double>")
    pairs = _pairs(text)
    total = F.aggregate(
        pairs, F.lit(0.0), lambda acc, pair: acc + F.element_at(table, pair.cast("int") + 1)
    )
    return F.when(F.size(pairs) > 0, total / F.size(pairs))


def labelled_strings(docs: DataFrame, max_docs: int = 2000, seed: int = 5) -> DataFrame:
    """Training strings of ``docs``: ``text, random``.

    What a base pattern finds is labelled random, other words of six and more characters
    ordinary. They come from at most ``max_docs`` documents that hold a base match and as many
    that hold none, taken by a hash of ``doc_id``.
    """
    texts = docs.select("doc_id", "text").filter(F.col("text").isNotNull())
    some = _suspicious(F.col("text"), (*PATTERNS,))
    by_hash = F.xxhash64(F.lit(seed), "doc_id")

    def chosen(rows: DataFrame) -> DataFrame:
        # Only ids are ordered in one task; so few of them may be broadcast.
        ids = rows.select("doc_id").orderBy(by_hash, "doc_id").limit(max_docs)
        return rows.join(F.broadcast(ids), "doc_id", "left_semi")

    positive, negative = chosen(texts.filter(some)), chosen(texts.filter(~some))
    found = positive.select(
        F.explode(
            F.concat(
                F.regexp_extract_all("text", F.lit(PATTERNS["assign"]), F.lit(2)),
                F.regexp_extract_all("text", F.lit(LONG_ENOUGH["access"]), F.lit(0)),
                F.regexp_extract_all("text", F.lit(LONG_ENOUGH["hex"]), F.lit(0)),
            )
        ).alias("text"),
        F.lit(True).alias("random"),
    )
    plain = negative.select(
        F.explode(F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).alias("text"),
        F.lit(False).alias("random"),
    )
    return found.unionByName(plain).filter(F.length("text") >= ASSIGN_LEAST)


def _suspicious(text: Column, kinds: Sequence[str]) -> Column:
    tests = [F.regexp_like(text, F.lit(LONG_ENOUGH.get(k, PATTERNS[k]))) for k in kinds]
    return F.greatest(*tests) if len(tests) > 1 else tests[0]


def _hits(text: Column, pattern: str) -> tuple[Column, Column]:
    """Matches of a pattern, and the texts before each of them and behind the last."""
    found = F.regexp_like(text, F.lit(pattern))
    none = F.array().cast("array<string>")
    hit = F.when(found, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none)
    return hit, F.when(found, F.split(text, pattern, -1)).otherwise(none)


def _matches(kind: int, hits: Column, gaps: Column, good: Column) -> Column:
    """Rows of matches in order: ``kind, place, gap`` before it, ``width``, ``ok``.

    All three are arrays worked out before, so that each match costs the same.
    """
    together = F.arrays_zip(
        hits.alias("hit"), F.slice(gaps, F.lit(1), F.size(hits)).alias("gap"), good.alias("ok")
    )
    return F.transform(
        together,
        lambda m, i: F.struct(
            F.lit(kind).alias("kind"),
            (i + 1).alias("place"),
            F.length(m["gap"]).cast("long").alias("gap"),
            F.length(m["hit"]).cast("long").alias("width"),
            m["ok"].alias("ok"),
        ),
    )


def find_secrets(docs: DataFrame, ratio: Sequence[float], threshold: float = 0.25) -> DataFrame:
    """Spans of secrets of each document: ``doc_id, spans``.

    ``spans`` is an array of ``(start, kind, end)`` in code points, end exclusive, by
    start, then kind: 0 assign, 1 access, 2 hex, 3 markov. The first three are
    leftmost non-overlapping matches of the patterns, without those too short. The last are
    maximal runs of 20 and more characters of ``ALPHABET`` that touch none of the others and
    whose mean log-likelihood ratio under ``train_markov``'s models is at least ``threshold``.

    A null or empty text has no spans. Every row of ``docs`` gives a row, so repeated
    rows repeat, and a null ``doc_id`` stays null. No rows, no result. Columns other
    than doc_id and text are not read.

    Places are found by adding up the lengths between and of the matches, as rows: a text
    with very many matches costs in proportion. Texts do not leave the task that reads them.
    """
    text = F.coalesce("text", F.lit(""))
    patterns = [PATTERNS["assign"], LONG_ENOUGH["access"], LONG_ENOUGH["hex"], CANDIDATE]
    arrays = []
    for kind, pattern in enumerate(patterns):
        hits, gaps = _hits(text, pattern)
        arrays += [hits.alias(f"hits{kind}"), gaps.alias(f"gaps{kind}")]
    values = F.when(
        F.regexp_like(text, F.lit(patterns[0])),
        F.regexp_extract_all(text, F.lit(patterns[0]), F.lit(2)),
    ).otherwise(F.array().cast("array<string>"))
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    # A one-element explode keeps the arrays in a step of their own, worked out once a text.
    cut = numbered.select(
        "row", "doc_id", F.explode(F.array(F.struct(*arrays, values.alias("values")))).alias("t")
    ).select("row", "doc_id", "t.*")
    always = lambda hits: F.transform(hits, lambda hit: F.lit(True))
    good = [
        F.transform("values", lambda value: F.length(value) >= ASSIGN_LEAST),
        always(F.col("hits1")),
        always(F.col("hits2")),
        F.transform("hits3", lambda hit: F.coalesce(mean_ratio(hit, ratio) >= threshold, F.lit(False))),
    ]
    found = F.concat(
        F.array(
            F.struct(
                F.lit(-1).alias("kind"),
                F.lit(0).alias("place"),
                F.lit(0).cast("long").alias("gap"),
                F.lit(0).cast("long").alias("width"),
                F.lit(True).alias("ok"),
            )
        ),
        *[_matches(k, F.col(f"hits{k}"), F.col(f"gaps{k}"), good[k]) for k in range(len(patterns))],
    )
    rows = cut.select("row", "doc_id", F.explode(found).alias("m")).select("row", "doc_id", "m.*")
    rows = rows.repartition("row")
    upto = (
        Window.partitionBy("row", "kind").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    )
    end = F.sum(F.col("gap") + F.col("width")).over(upto)
    spans = (
        rows.withColumn("end", end)
        .withColumn("start", F.col("end") - F.col("width"))
        .filter("ok")
    )
    is_base = F.col("kind").between(0, 2)
    by_start = Window.partitionBy("row").orderBy("start")
    upto_here = by_start.rangeBetween(Window.unboundedPreceding, 0)
    # Running from the end, the frame only grows.
    from_here = (
        Window.partitionBy("row")
        .orderBy(F.col("start").desc())
        .rangeBetween(Window.unboundedPreceding, 0)
    )
    clear = (
        spans.withColumn("_left", F.max(F.when(is_base, F.col("end"))).over(upto_here))
        .withColumn("_right", F.min(F.when(is_base, F.col("start"))).over(from_here))
        .filter(
            (F.col("kind") != 3)
            | (
                F.coalesce(F.col("_left") <= F.col("start"), F.lit(True))
                & F.coalesce(F.col("_right") >= F.col("end"), F.lit(True))
            )
        )
    )
    span = F.when(F.col("kind") >= 0, F.struct("start", "kind", "end"))
    return clear.groupBy("row", "doc_id").agg(
        F.sort_array(F.collect_list(span)).alias("spans")
    ).drop("row")


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )
