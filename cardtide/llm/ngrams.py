"""N-gram Jaccard join: which documents share most of their word shingles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from cardtide.llm.common import components, small, stored

# Each Python worker keeps at most so many word hashes: some 7 MB beside the executor.
MEMO_WORDS = 50_000
ROWS_PER_BLOCK = 2048
POSTINGS_PER_RANGE = 1_000_000
# A shingle in more than one of so many documents comes last in the order of shingles.
COMMON_SHARE = 1000
SHORT, LONG = "<u2", "<u8"
MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
       0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)


class WordHashes(dict):
    """64-bit hashes of words, kept for the words seen lately."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingles(text: str | None, width: int, memo: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles.

    A-Z are lower-cased; words are split at blanks, tabs and line ends; fewer words than
    ``width`` are one shingle; no word, none.
    """
    words = (text or "").encode("utf8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, LONG)
    hashes = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
    width = min(width, len(words))
    n = len(words) - width + 1
    total = np.full(n, width, np.uint64)
    for i in range(width):
        total += _scramble(hashes[i : i + n] + np.uint64(MIX[i % len(MIX)] ^ i)) * np.uint64(
            MIX[(i + 3) % len(MIX)] | 1
        )
    return np.unique(_scramble(total))


def _overlap_needed(percent: int, a, b):
    """The least intersection of sets of sizes a and b at ``percent`` similarity."""
    return -(-percent * (a + b) // (100 + percent))


def _prefix(n, percent: int):
    """Of n shingles in order, two similar sets share one among the first so many."""
    return n - -(-percent * n // 100) + 1


def _sets(docs: DataFrame, width: int) -> DataFrame:
    """``doc_id, n, s1, s2`` of each row, and ``common, df`` of the shingles found often.

    (s1, s2) identify a set. A shingle counts as often found in a block of some thousand
    documents that hold it several times; all that stand in more than one in
    ``COMMON_SHARE`` documents do so in at least one block.
    """
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()),
         ("common", pa.int64()), ("df", pa.int64())]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, held, n_held = WordHashes(), [], 0

        def often() -> pa.RecordBatch:
            found, df = np.unique(np.concatenate(held), return_counts=True)
            keep = df > max(3, n_held // COMMON_SHARE)
            found, df = found[keep].view(np.int64), df[keep]
            none = pa.nulls(len(found), pa.int64())
            return pa.record_batch([none, none, none, none, pa.array(found), pa.array(df, pa.int64())], schema=schema)

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = [shingles(t, width, memo) for t in part.column("text").to_pylist()]
                marks = [xxhash.xxh3_128_intdigest(s.tobytes()) for s in sets]
                halves = np.array([[m >> 64, m & (2**64 - 1)] for m in marks], np.uint64).view(np.int64)
                none = pa.nulls(len(sets), pa.int64())
                yield pa.record_batch(
                    [part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array(halves[:, 0]), pa.array(halves[:, 1]), none, none],
                    schema=schema,
                )
                held += sets
                n_held += len(sets)
                if n_held >= ROWS_PER_BLOCK or sum(map(len, held)) > 2_000_000:
                    yield often()
                    held, n_held = [], 0
        if n_held:
            yield often()

    return docs.mapInArrow(read, "doc_id long, n long, s1 long, s2 long, common long, df long")


PACKED = "block long, kind int, range long, hashes binary, owners binary, dfs binary"


def _postings(
    docs: DataFrame, width: int, common: tuple[np.ndarray, np.ndarray], bits: int
) -> DataFrame:
    """Shingles by range of their hash, packed per block of documents.

    A row of a real range holds the hashes of a block that fall into it and the number of
    the document in the block for each. Two rows of a block need no counting and have a
    negative range of their own: the documents (``kind`` 1: ids and set sizes), and their common
    shingles (``kind`` 2).
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(common)
    schema = pa.schema(
        [("block", pa.int64()), ("kind", pa.int32()), ("range", pa.int64()), ("hashes", pa.binary()),
         ("owners", pa.binary()), ("dfs", pa.binary())]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, number = WordHashes(), TaskContext.get().partitionId() << 32
        often, times = shared.value

        def block(ids: list[int], sets: list[np.ndarray]) -> pa.RecordBatch:
            nonlocal number
            sizes = np.array([len(s) for s in sets], np.int64)
            every = np.concatenate(sets)
            owner = np.repeat(np.arange(len(sets), dtype=SHORT), sizes)
            number += 1
            rows = [(1, -number, np.array(ids, np.int64).tobytes(), sizes.tobytes(), None)]
            if len(often):
                at = np.minimum(np.searchsorted(often, every), len(often) - 1)
                known = often[at] == every
                held = (every[known].tobytes(), owner[known].tobytes(), times[at[known]].tobytes())
                rows.append((2, -number, *held))
                every, owner = every[~known], owner[~known]
            order = np.argsort(every)
            every, owner = every[order], owner[order]
            cuts = np.array([0, len(every)])
            if bits:
                starts = np.arange((1 << bits) + 1, dtype=np.uint64)
                cuts = np.searchsorted(every >> np.uint64(64 - bits), starts)
            for r in range(1 << bits):
                if cuts[r] < cuts[r + 1]:
                    span = slice(cuts[r], cuts[r + 1])
                    rows.append((0, r, every[span].tobytes(), owner[span].tobytes(), None))
            columns = zip(*[(number, *row) for row in rows], strict=True)
            return pa.record_batch(
                [pa.array(c, kind) for c, kind in zip(columns, schema.types, strict=True)],
                schema=schema,
            )

        ids, sets, held = [], [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids += part.column("doc_id").to_pylist()
                new = [shingles(t, width, memo) for t in part.column("text").to_pylist()]
                sets += new
                held += sum(map(len, new))
                if len(sets) >= ROWS_PER_BLOCK or held > 2_000_000:
                    yield block(ids, sets)
                    ids, sets, held = [], [], 0
        if sets:
            yield block(ids, sets)

    return docs.mapInArrow(read, PACKED)


REPEATED = "block long, kind int, hashes binary, owners binary, dfs binary"
RECORD = "doc long, n long, alone long, shared binary, prefix array<long>"


def _repeated(key: tuple, part: pa.Table) -> pa.Table:
    """Of one range: the shingles of more than one document, given back to their blocks."""
    if key[0].as_py() < 0:
        return part.drop_columns("range")
    blocks = part.column("block").to_pylist()
    hashes = [np.frombuffer(x, LONG) for x in part.column("hashes").to_pylist()]
    owners = [np.frombuffer(x, SHORT) for x in part.column("owners").to_pylist()]
    every = np.concatenate(hashes)
    order = np.argsort(every, kind="stable")
    ordered = every[order]
    first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    runs = np.diff(np.r_[first, len(ordered)])
    df = np.empty(len(every), np.uint32)
    df[order] = np.repeat(np.minimum(runs, 2**31 - 1), runs)
    rows, at = [], 0
    for block, h, o in zip(blocks, hashes, owners, strict=True):
        n, at = df[at : at + len(h)], at + len(h)
        keep = n > 1
        if keep.any():
            rows.append((block, h[keep].tobytes(), o[keep].tobytes(), n[keep].tobytes()))
    return pa.table(
        {
            "block": pa.array([r[0] for r in rows], pa.int64()),
            "kind": pa.array([0] * len(rows), pa.int32()),
            "hashes": pa.array([r[1] for r in rows], pa.binary()),
            "owners": pa.array([r[2] for r in rows], pa.binary()),
            "dfs": pa.array([r[3] for r in rows], pa.binary()),
        }
    )


def _records(percent: int):
    """Documents of a block that may have a partner, with their shared shingles in order."""

    def build(key: tuple, part: pa.Table) -> pa.Table:
        rows = part.to_pylist()
        head = next(r for r in rows if r["kind"] == 1)
        ids, sizes = np.frombuffer(head["hashes"], np.int64), np.frombuffer(head["owners"], np.int64)
        rest = [r for r in rows if r["kind"] != 1]
        hashes = np.concatenate([np.frombuffer(r["hashes"], LONG) for r in rest] or [np.empty(0, LONG)])
        owners = np.concatenate([np.frombuffer(r["owners"], SHORT) for r in rest] or [np.empty(0, SHORT)])
        dfs = np.concatenate(
            [np.frombuffer(r["dfs"], np.uint32) for r in rest] or [np.empty(0, np.uint32)]
        )
        order = np.lexsort((hashes, dfs, owners))
        hashes, owners = hashes[order], owners[order]
        bounds = np.searchsorted(owners, np.arange(len(ids) + 1))
        kept = []
        for i, (doc, n) in enumerate(zip(ids.tolist(), sizes.tolist(), strict=True)):
            shared = hashes[bounds[i] : bounds[i + 1]]
            alone = n - len(shared)  # shingles of no other document come first
            ahead = _prefix(n, percent) - alone
            if n and ahead > 0:
                kept.append((doc, n, alone, shared.tobytes(), shared[:ahead].view(np.int64)))
        return pa.table(
            {
                "doc": pa.array([k[0] for k in kept], pa.int64()),
                "n": pa.array([k[1] for k in kept], pa.int64()),
                "alone": pa.array([k[2] for k in kept], pa.int64()),
                "shared": pa.array([k[3] for k in kept], pa.binary()),
                "prefix": pa.array([k[4] for k in kept], pa.list_(pa.int64())),
            }
        )

    return build


def _alike(percent: int):
    """Whether two sets are similar: a suffix filter first, then the intersection."""

    def suffix_bound(a: np.ndarray, b: np.ndarray) -> int:
        """No more shingles than this are shared: both are cut at the middle of one."""
        if not len(a) or not len(b):
            return 0
        cut = a[len(a) // 2]
        low_a, low_b = int((a < cut).sum()), int((b < cut).sum())
        return min(low_a, low_b) + min(len(a) - low_a, len(b) - low_b)

    @pandas_udf("boolean")
    def alike(a: pd.Series, b: pd.Series, n_a: pd.Series, n_b: pd.Series) -> pd.Series:
        out = []
        for x, y, m, n in zip(a, b, n_a, n_b, strict=True):
            x, y = np.frombuffer(x, LONG), np.frombuffer(y, LONG)
            needed = _overlap_needed(percent, m, n)
            if suffix_bound(x, y) < needed:
                out.append(False)
            else:
                out.append(len(np.intersect1d(x, y, assume_unique=True)) >= needed)
        return pd.Series(out, dtype=bool)

    return alike


def _verified(pairs: DataFrame, records: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose sets are similar; each pair is verified once."""
    one = records.select(F.col("doc").alias("a"), F.col("n").alias("n_a"), F.col("shared").alias("set_a"))
    two = records.select(F.col("doc").alias("b"), F.col("n").alias("n_b"), F.col("shared").alias("set_b"))
    both = pairs.join(one, "a").join(two, "b")
    return both.filter(_alike(percent)("set_a", "set_b", "n_a", "n_b")).select("a", "b")


def _may_reach(percent: int, left: str, right: str):
    """Length and positional filters on two postings of one shingle.

    All that two sets share stands at or after the first shingle they share, so a similar pair
    passes at that one; it need not pass at its later ones.
    """
    a, b = F.col(f"{left}.n"), F.col(f"{right}.n")
    needed = F.ceil((F.lit(percent) * (a + b)) / F.lit(100 + percent))
    ahead = F.least(a - F.col(f"{left}.place"), b - F.col(f"{right}.place"))
    return (F.lit(100) * F.least(a, b) >= F.lit(percent) * F.greatest(a, b)) & (ahead >= needed)


def similar_documents(
    docs: DataFrame, width: int = 4, percent: int = 85
) -> DataFrame:
    """Class of each document: ``doc_id, n_shingles, component_id``.

    Two documents link when their sets of ``width``-word shingles have a Jaccard similarity
    of ``percent`` hundredths or more; ``component_id`` is the smallest doc_id reachable by
    links. Texts of no words (null, empty, blank) have no shingle and no link. Rows that repeat a
    doc_id are documents that link by text as any others do, and where they link by nothing else they share
    a component, being one id. A null doc_id gets a row; alone, its component is null.
    Columns other than doc_id and text are not read. An empty table gives no rows.

    Documents of equal sets are one class from the start. For the classes, shingles are ordered
    rarest first: those of one class, then by the number of classes, and last those that more than
    one in 1,000 documents hold (at most 1,000 mean set sizes of them, so they are
    broadcast). By pigeonhole two similar sets share a shingle among their first
    ``n - ceil(p n) + 1``, so a document with that many shingles of its own has no partner. The
    others post their prefixes. First each is compared with one document of those
    it shares most postings with, which ties groups of near copies together; then all pairs with
    a common posting that are not yet in one component pass length, positional and suffix
    filters and are verified. So a group of near copies costs about its size, not its square.

    Shingles travel as packed arrays in ranges of their hash. 64-bit hashes stand for shingles
    and 128-bit hashes for sets.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    read = stored(_sets(texts, width), "sets")
    sets = read.filter(F.col("common").isNull()).select("doc_id", "n", "s1", "s2")
    classes = stored(
        sets.filter((F.col("n") > 0) & F.col("doc_id").isNotNull())
        .groupBy("s1", "s2")
        .agg(F.min("doc_id").alias("doc"), F.max("doc_id").alias("_last"), F.max("n").alias("n")),
        "classes",
    )
    n_classes, n_shingles = classes.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()

    members = sets.filter(F.col("n") > 0).join(
        classes.filter(F.col("_last") > F.col("doc")).drop("_last", "n"), ["s1", "s2"]
    )
    same = members.select(F.col("doc_id").alias("a"), F.col("doc").alias("b"))

    common = _common(read, n_classes)
    bits = max(0, (n_shingles // POSTINGS_PER_RANGE)).bit_length()
    chosen = small(classes.select(F.col("doc").alias("doc_id")).distinct(), 1_000_000)
    packed = _postings(texts.join(chosen, "doc_id", "left_semi"), width, common, bits)
    links = _links(packed, percent)
    roots = components(same.unionByName(links))
    roots = small(stored(roots, "roots"))
    return sets.join(roots, sets["doc_id"] == roots["node"], "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("root", "doc_id").alias("component_id"),
    )


def one_of_each_group(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One row of each group of rows that link over any way, the one of the smallest doc_id.

    Columns stay as they are, whatever their names. Every row is a document of its own, also where
    doc_ids repeat or are null; a row with a doc_id comes before one without.
    """
    given = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("given")
    rows = stored(docs.select(given, F.monotonically_increasing_id().alias("row")), "rows")
    texts = rows.select(F.col("row").alias("doc_id"), F.col("given.text").alias("text"))
    classes = similar_documents(texts, width, percent).select(
        F.col("doc_id").alias("row"), F.col("component_id").alias("group")
    )
    placed = rows.select("row", F.col("given.doc_id").alias("doc_id")).join(classes, "row")
    placed = stored(placed, "placed")
    first = placed.groupBy("group").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).getField("row").alias("first")
    )
    gone = placed.join(first, "group").filter(F.col("row") != F.col("first"))
    gone = small(stored(gone.select("row"), "gone"), 1_000_000)
    return rows.join(gone, "row", "left_anti").select(
        *[F.col(f"given.`{c}`").alias(c) for c in docs.columns]
    )


def _common(read: DataFrame, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles in more than one of ``COMMON_SHARE`` documents, sorted, and their counts.

    The counts stand above those of all other shingles.
    """
    often = (
        read.filter(F.col("common").isNotNull())
        .groupBy("common")
        .agg(F.sum("df").alias("df"))
        .filter(F.col("df") > max(64, n_docs // COMMON_SHARE))
        .toArrow()
    )
    found = often.column("common").to_numpy().astype(np.int64).view(np.uint64)
    df = np.minimum(often.column("df").to_numpy().astype(np.int64), 2**31 - 1).astype(np.uint32)
    order = np.argsort(found)
    return found[order], df[order] + np.uint32(2**31)


def _links(packed: DataFrame, percent: int) -> DataFrame:
    """Links that connect all similar classes: ``a, b``."""
    counted = packed.groupBy("range").applyInArrow(_repeated, REPEATED)
    records = stored(counted.groupBy("block").applyInArrow(_records(percent), RECORD), "records")
    postings = stored(
        records.select("doc", "n", "alone", F.posexplode("prefix").alias("at", "shingle")).select(
            "doc", "n", "alone", (F.col("alone") + F.col("at")).alias("place"), "shingle"
        ),
        "prefixes",
    )
    links, placed = None, postings.withColumn("group", F.col("doc"))
    # The most central document of a list has the fewest shingles of its own.
    for central in (F.struct("alone", "doc"), F.struct(-F.col("doc"), "doc")):
        new = stored(
            _verified(_led(placed, central), records, percent), "links"
        )
        links = new if links is None else links.unionByName(new)
        groups = small(stored(components(links), "groups"))
        placed = postings.join(groups, F.col("doc") == F.col("node"), "left").select(
            "shingle", "doc", "n", "alone", "place", F.coalesce("root", "doc").alias("group")
        )
    open_lists = (
        placed.groupBy("shingle")
        .agg(F.min("group").alias("low"), F.max("group").alias("high"))
        .filter(F.col("low") < F.col("high"))
        .select("shingle")
    )
    placed = stored(placed.join(open_lists, "shingle"), "open")
    x, y = placed.alias("x"), placed.alias("y")
    pairs = (
        x.join(
            y,
            F.expr("x.shingle = y.shingle AND x.doc < y.doc AND x.group <> y.group")
            & _may_reach(percent, "x", "y"),
        )
        .select(F.col("x.doc").alias("a"), F.col("y.doc").alias("b"))
        .distinct()
    )
    return links.unionByName(_verified(pairs, records, percent))


def _led(placed: DataFrame, central) -> DataFrame:
    """For each document one of the least documents of its lists by ``central``: that which most
    of its lists have, of those in another group than its own."""
    first = F.min(F.struct(central.alias("by"), "group")).alias("first")
    leaders = placed.groupBy("shingle").agg(first)
    leaders = leaders.select(
        "shingle", F.col("first.by.doc").alias("leader"), F.col("first.group").alias("led")
    )
    return (
        placed.join(leaders, "shingle")
        .filter(F.col("group") != F.col("led"))
        .groupBy("doc", "leader")
        .agg(F.count(F.lit(1)).alias("lists"))
        .groupBy("doc")
        .agg(F.max_by("leader", F.struct("lists", "leader")).alias("leader"))
        .select(F.col("doc").alias("a"), F.col("leader").alias("b"))
    )
