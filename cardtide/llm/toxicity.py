"""Grade the toxicity of texts by cumulative-link ordinal regression."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from cardtide.llm.common import small, stored

BITS = 22
MOST_FEATURES = 5000
LEAST_Z = 4.0
MEMO_WORDS = 400_000
STEMS = (4, 5, 6)
EDGE = ".,;:!?\"'()[]{}<>|*#`~_-"


def features_of(word: str) -> list[int]:
    """Numbers of a word's features: the word, and its beginnings of 4 to 6 characters."""
    found = [f"w {word}", *(f"s {word[:k]}" for k in STEMS if len(word) >= k)]
    return [zlib.crc32(f.encode("utf8", "surrogatepass")) >> (32 - BITS) for f in found]


def word_counts(text: str | None) -> Counter:
    """Lower-cased words of a whole text, without punctuation at their ends."""
    counts: Counter = Counter()
    for word, n in Counter((text or "").lower().split()).items():
        if bare := word.strip(EDGE):
            counts[bare] += n
    return counts


def text_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Sparse features of a text, each ``1 + ln n`` of its count; not scaled by length, so that
    a few words tell as much in a long text as in a short one."""
    totals: Counter = Counter()
    for word, n in word_counts(text).items():
        for feature in features_of(word):
            totals[feature] += n
    index = np.fromiter(totals.keys(), np.int32, len(totals))
    value = 1 + np.log(np.fromiter(totals.values(), np.float64, len(totals)))
    return index, value.astype(np.float32)


@dataclass
class OrdinalModel:
    """P(grade > k) = sigmoid(weights . x - cuts[k]), one set of weights, rising cuts."""

    weights: np.ndarray
    cuts: np.ndarray

    def above(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k) for each score and each cut."""
        with np.errstate(over="ignore"):
            return 1 / (1 + np.exp(self.cuts[None, :] - score[:, None]))


def _labelled_sample(
    docs: DataFrame, grades: DataFrame, max_per_grade: int, seed: int
) -> DataFrame:
    """Up to ``max_per_grade`` labelled texts of each grade, taken by a hash of the id."""
    graded = grades.na.drop().groupBy("doc_id").agg(F.max("grade").alias("grade"))
    order = [F.xxhash64(F.lit(seed), "doc_id"), F.col("doc_id")]
    # The first of each of 64 shares, then the first of those: no task sorts a whole grade.
    share = F.pmod(F.xxhash64("doc_id"), F.lit(64))
    chosen = graded.withColumn("share", share)
    for keys in (["grade", "share"], ["grade"]):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        chosen = chosen.withColumn("place", place).filter(F.col("place") <= max_per_grade)
    chosen = small(stored(chosen.select("doc_id", "grade"), "chosen"))
    # A doc_id that repeats gives one text.
    texts = docs.select("doc_id", "text").join(chosen, "doc_id")
    return texts.groupBy("doc_id", "grade").agg(F.min("text").alias("text"))


def train_ordinal(
    docs: DataFrame,
    grades: DataFrame,
    max_per_grade: int = 2500,
    rounds: int = 300,
    ridge: float = 1e-3,
    seed: int = 11,
) -> OrdinalModel:
    """Fit the cumulative-link model to ``docs(doc_id, text)`` with ``grades(doc_id, grade)``.

    Grades are whole numbers from 0; the highest one seen sets the number of cuts. At most
    ``max_per_grade`` documents of each grade are used, whole texts, and their sparse features
    (bounded by that and by 2^22 features a text) are fitted on the driver by full-gradient
    AdaGrad with the proportional-odds loss, after features that go with the grades by
    chance are left out. Without rows of two grades the model expects severity 0 of every text.
    """
    sample = _labelled_sample(docs, grades, max_per_grade, seed)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, v, g in (
                (*text_features(t), g)
                for t, g in zip(
                    batch.column("text").to_pylist(), batch.column("grade").to_pylist(), strict=True
                )
            ):
                yield pa.record_batch(
                    [pa.array([i.tobytes()]), pa.array([v.tobytes()]), pa.array([g], pa.int32())],
                    names=["i", "v", "grade"],
                )

    texts = sample.select("text", F.col("grade").cast("int").alias("grade"))
    rows = texts.mapInArrow(read, "i binary, v binary, grade int").toArrow()
    grade = rows.column("grade").to_numpy()
    index = [np.frombuffer(x, np.int32) for x in rows.column("i").to_pylist()]
    value = [np.frombuffer(x, np.float32) for x in rows.column("v").to_pylist()]
    if len(set(grade.tolist())) < 2:
        return OrdinalModel(np.zeros(1 << BITS), np.full(1, np.inf))
    return fit(index, value, grade, rounds, ridge)


def fit(
    index: list[np.ndarray], value: list[np.ndarray], grade: np.ndarray, rounds: int, ridge: float
) -> OrdinalModel:
    n, top = len(grade), int(grade.max())
    owner = np.repeat(np.arange(n), [len(i) for i in index])
    column, cell = np.concatenate(index), np.concatenate(value).astype(np.float64)
    chosen = _telling(column, owner, grade)
    keep = np.isin(column, chosen)
    owner, column, cell = owner[keep], column[keep], cell[keep] / 4.0
    column = np.searchsorted(np.sort(chosen), column)
    over = (grade[:, None] > np.arange(top)[None, :]).astype(np.float64)

    w, cuts = np.zeros(len(chosen)), np.linspace(0.5, 1.5, top)
    sum_w, sum_c = np.full(len(chosen), 1e-8), np.full(top, 1e-8)
    for _ in range(rounds):
        score = np.bincount(owner, cell * w[column], minlength=n)
        p = 1 / (1 + np.exp(-np.clip(score[:, None] - cuts[None, :], -30, 30)))
        slope = (p - over) / n
        by_row = slope.sum(axis=1)
        grad_w = np.bincount(column, cell * by_row[owner], minlength=len(chosen)) + ridge * w / n
        grad_c = -slope.sum(axis=0)
        sum_w += grad_w**2
        sum_c += grad_c**2
        w -= 0.3 * grad_w / np.sqrt(sum_w)
        cuts = np.maximum.accumulate(cuts - 0.1 * grad_c / np.sqrt(sum_c))
    weights = np.zeros(1 << BITS)
    weights[np.sort(chosen)] = w / 4.0
    return OrdinalModel(weights, cuts)


def _telling(column: np.ndarray, owner: np.ndarray, grade: np.ndarray) -> np.ndarray:
    """Features whose presence goes with the grade by more than chance: at most 5,000.

    Of very many features some agree with the grades by accident; a long text would add
    all of these up.
    """
    n, mean, spread = len(grade), grade.mean(), grade.std()
    seen = np.bincount(column, minlength=1 << BITS).astype(np.float64)
    sums = np.bincount(column, (grade - mean)[owner], minlength=1 << BITS)
    with np.errstate(divide="ignore", invalid="ignore"):
        z = sums / (spread * np.sqrt(seen * (1 - seen / n)))
    z[~np.isfinite(z) | (seen < 3)] = 0
    strong = np.flatnonzero(np.abs(z) >= LEAST_Z)
    return strong[np.argsort(-np.abs(z[strong]), kind="stable")[:MOST_FEATURES]]


def _grader(weights: np.ndarray, cuts: np.ndarray):
    """A function from texts to P(grade > k): one row a text."""
    own = OrdinalModel(weights, cuts)
    memo: dict[str, tuple[int, ...]] = {}

    def score(text: str | None) -> float:
        """The same sum as over ``text_features``, with the telling features only."""
        totals: Counter = Counter()
        for word, n in Counter((text or "").lower().split()).items():
            known = memo.get(word)
            if known is None:
                if len(memo) >= MEMO_WORDS:
                    memo.clear()
                bare = word.strip(EDGE)
                found = features_of(bare) if bare else ()
                known = memo[word] = tuple(f for f in found if weights[f])
            for feature in known:
                totals[feature] += n
        return float(sum(weights[f] * (1 + np.log(n)) for f, n in totals.items()))

    return lambda texts: own.above(np.array([score(t) for t in texts]))


def grade_texts(docs: DataFrame, model: OrdinalModel) -> DataFrame:
    """Severity of each text: ``doc_id, expected_severity, grade``, one row per row of ``docs``.

    Expected severity is the sum over the cuts of P(grade > k); ``grade`` the number of cuts
    passed with probability above one half. Whole texts are read. A null, empty or blank
    text scores 0 before the cuts. Repeated rows repeat; a null doc_id stays. No rows, no
    result. Columns other than doc_id and text are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(
        (model.weights.astype(np.float32), model.cuts)
    )
    schema = pa.schema(
        [("doc_id", pa.int64()), ("expected_severity", pa.float64()), ("grade", pa.int32())]
    )

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        above_of = _grader(*shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                above = above_of(part.column("text").to_pylist())
                yield pa.record_batch(
                    [
                        part.column("doc_id"),
                        pa.array(above.sum(axis=1)),
                        pa.array((above > 0.5).sum(axis=1), pa.int32()),
                    ],
                    schema=schema,
                )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(judge, "doc_id long, expected_severity double, grade int")


def drop_toxic(docs: DataFrame, model: OrdinalModel, at: float = 0.5) -> DataFrame:
    """The rows whose expected severity is below ``at``, with all their columns.

    Each row is judged by its own text, whatever its doc_id.
    """
    shared = docs.sparkSession.sparkContext.broadcast(
        (model.weights.astype(np.float32), model.cuts)
    )
    place = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        above_of = _grader(*shared.value)
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                severity = above_of(part.column(place).to_pylist()).sum(axis=1)
                yield part.filter(pa.array(severity < at))

    return docs.mapInArrow(keep, docs.schema)
