"""Pack documents into training windows with lexically related neighbours."""

from __future__ import annotations

import functools
import json
import re
import sys
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from cardtide.llm.common import stored

WINDOW = 2048
END_ID = 1
SHARD_TOKENS = 2_000_000
SEED_TERMS = 16
# A task packs its shards one after the other.
MAX_TASKS = 20_000
K1, B = 1.2, 0.75
SHORT, LONG = "<u2", "<u4"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@functools.cache
def encoder(path: str) -> Callable[[str], bytes]:
    """From a text to its ids, as little-endian 16-bit numbers, by a byte-level BPE file.

    The ids are those of ``Tokenizer.encode(text, add_special_tokens=False)``. The ranks are read
    from the file and run by tiktoken, which is several times faster; a text that spells
    an added token goes through the tokenizer itself. One encoder serves all tasks of a worker.
    """
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    with open(path, encoding="utf8") as file:
        whole = json.load(file)
    model = whole["model"]
    if model["type"] != "BPE":
        raise ValueError("packing needs a byte-level BPE tokenizer")
    added = {t["content"]: t["id"] for t in whole["added_tokens"]}
    if max([*model["vocab"].values(), *added.values()]) >= 1 << 16:
        raise ValueError("packing holds ids as 16-bit numbers; this vocabulary is larger")
    # Byte-level files spell each byte as one printable character.
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
    ranks = {
        bytes(byte_of[c] for c in token): rank
        for token, rank in model["vocab"].items()
        if all(c in byte_of for c in token) and token not in added
    }
    fast = tiktoken.Encoding(
        "words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    marks = re.compile("|".join(map(re.escape, added))) if added else None
    # Read at the first text that needs it: some 30 MB in each worker.
    tokenizer = None

    def encode(text: str) -> bytes:
        nonlocal tokenizer
        if marks is not None and marks.search(text):
            if tokenizer is None:
                tokenizer = Tokenizer.from_file(path)
            return _packed(tokenizer.encode(text, add_special_tokens=False).ids)
        return _packed(fast.encode_ordinary(text))

    return encode


def _packed(ids: list[int]) -> bytes:
    numbers = array("H", ids)
    if sys.byteorder == "big":
        numbers.byteswap()
    return numbers.tobytes()


def _tokenized(docs: DataFrame, path: str) -> DataFrame:
    """One row per document, and per task the documents that hold each id.

    ``doc_id, n, ids`` for a document; ``term, df`` for a count.
    """
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n", pa.int64()), ("ids", pa.binary()), ("term", pa.int32()), ("df", pa.int64())]
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoded, df = encoder(path), np.zeros(1 << 16, np.int64)
        end = np.array([END_ID], SHORT).tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = [encoded(t or "") + end for t in part.column("text").to_pylist()]
                for x in ids:
                    df[np.unique(np.frombuffer(x, SHORT))] += 1
                n = len(ids)
                yield pa.record_batch(
                    [
                        part.column("doc_id"),
                        pa.array([len(x) // 2 for x in ids], pa.int64()),
                        pa.array(ids, pa.binary()),
                        pa.nulls(n, pa.int32()),
                        pa.nulls(n, pa.int64()),
                    ],
                    schema=schema,
                )
        terms = np.flatnonzero(df)
        yield pa.record_batch(
            [
                pa.nulls(len(terms), pa.int64()),
                pa.nulls(len(terms), pa.int64()),
                pa.nulls(len(terms), pa.binary()),
                pa.array(terms, pa.int32()),
                pa.array(df[terms], pa.int64()),
            ],
            schema=schema,
        )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(encode, "doc_id long, n long, ids binary, term int, df long")


def pack(
    docs: DataFrame,
    tokenizer: str | None = None,
    window: int = WINDOW,
    shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """Pack ``docs(doc_id, text)`` into sequences of at most ``window`` tokens.

    One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset, ids`` (``ids`` as little-endian 16-bit numbers). A document's tokens are its
    byte-level BPE ids and id 1; a null or empty text is that id alone. Every row is a
    document of its own, also where rows or ids repeat; a null doc_id stays null. An empty
    table gives no pieces. Other columns are not read.

    Documents that share rare ids come to lie together, in the order of two weighted MinHash
    keys (an id wins by its squared inverse document frequency, so two documents agree on
    a key as often as their weighted sets of ids overlap), at any size of the corpus. Ranges of
    that order are cut into shards of about ``shard_tokens`` tokens; a key that very many documents
    have is split like any other stretch. A shard has a BM25 index whose terms are
    token ids, with document counts of the whole corpus (one number per id of the
    vocabulary, which bounds what is broadcast). What is left of a seed document after its
    full windows opens a window; the best unused neighbours of the seed fill it, the last of them is
    cut, and its rest is the next seed. Neighbours are sought by the seed's rarest ids first, then
    by four times as many, up to all. So all windows are full, but for the last of each
    shard, which is cut into powers of two.
    """
    spark = docs.sparkSession
    rows = stored(_tokenized(docs, tokenizer or default_tokenizer()), "tokens")
    counts = rows.filter(F.col("term").isNotNull()).groupBy("term").agg(F.sum("df").alias("df"))
    texts = rows.filter(F.col("ids").isNotNull())
    n_docs, n_tokens = texts.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(1 << 16, np.int64)
    for term, n in counts.collect():
        df[term] = n
    idf = np.log1p((n_docs - df + 0.5) / (df + 0.5)).astype(np.float32)
    shared = spark.sparkContext.broadcast(idf)
    mean = n_tokens / max(1, n_docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        ids: list[int | None] = []
        blobs: list[bytes] = []
        held = 0
        for batch in batches:
            for doc_id, blob in zip(
                batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist(), strict=True
            ):
                ids.append(doc_id)
                blobs.append(blob)
                held += len(blob) // 2
                if held >= shard_tokens:
                    made, first = _pack_shard(first, ids, blobs, shared.value, mean, window)
                    yield from made.to_batches()
                    ids, blobs, held = [], [], 0
        if ids:
            made, first = _pack_shard(first, ids, blobs, shared.value, mean, window)
            yield from made.to_batches()

    tasks = max(1, min(MAX_TASKS, -(-n_tokens // shard_tokens)))
    order = ["key", "second", "spread", "at"]
    dealt = _keyed(texts, shared).repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    return dealt.select("doc_id", "ids").mapInArrow(
        run,
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
        "sequence_id long, offset long, ids binary",
    )


def _keyed(texts: DataFrame, shared) -> DataFrame:
    """Documents with two ids each that rare ids win most often, and what orders equal keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        races = [_race(shared.value, seed) for seed in (1, 2)]
        for batch in batches:
            blobs = [np.frombuffer(b, SHORT) for b in batch.column("ids").to_pylist()]
            keys = [pa.array([int(x[race[x].argmin()]) for x in blobs], pa.int32()) for race in races]
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("ids"), *keys], names=["doc_id", "ids", "key", "second"]
            )

    keyed = texts.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, key int, second int")
    return keyed.withColumns(
        {"spread": F.xxhash64("ids", "doc_id"), "at": F.monotonically_increasing_id()}
    )


def _race(idf: np.ndarray, seed: int) -> np.ndarray:
    """Per id a time of arrival, exponential with its squared inverse document frequency as rate."""
    drawn = np.random.default_rng(seed).exponential(size=len(idf))
    return drawn / np.maximum(idf.astype(float), 1e-6) ** 2


class ShardIndex:
    """BM25 over the documents of a shard: postings in term order."""

    def __init__(self, docs: list[np.ndarray], idf: np.ndarray, mean: float):
        self.idf = idf
        counted = [np.unique(d, return_counts=True) for d in docs]
        self.terms = [t for t, _ in counted]
        lengths = np.array([len(d) for d in docs], np.float32)
        sizes = [len(t) for t in self.terms]
        terms = np.concatenate(self.terms)
        tf = np.concatenate([c for _, c in counted]).astype(np.float32)
        owner = np.repeat(np.arange(len(docs), dtype=np.int32), sizes)
        norm = K1 * (1 - B + B * lengths / mean)
        weight = idf[terms] * tf * (K1 + 1) / (tf + norm[owner])
        order = np.argsort(terms, kind="stable")
        self.owner, self.weight = owner[order], weight[order]
        self.bounds = np.searchsorted(terms[order], np.arange((1 << 16) + 1))
        self.scores = np.zeros(len(docs), np.float32)

    def neighbours(self, doc: int, unused: np.ndarray, n_terms: int = SEED_TERMS) -> np.ndarray:
        """Unused documents that share one of the ``n_terms`` rarest terms of ``doc``, best first."""
        terms = self.terms[doc]
        if len(terms) > n_terms:
            terms = terms[np.argpartition(-self.idf[terms], n_terms)[:n_terms]]
        spans = [slice(self.bounds[t], self.bounds[t + 1]) for t in terms.tolist()]
        owners = np.concatenate([self.owner[s] for s in spans])
        np.add.at(self.scores, owners, np.concatenate([self.weight[s] for s in spans]))
        found = np.unique(owners)
        found = found[unused[found]]
        best = found[np.argsort(-self.scores[found], kind="stable")]
        self.scores[owners] = 0
        return best


def _pack_shard(
    first: int, ids: list, blobs: list[bytes], idf: np.ndarray, mean: float, window: int
) -> tuple[pa.Table, int]:
    """The pieces of a shard, sequences numbered from ``first``, and the number after the last."""
    # The same order in every run, whatever order the rows came in.
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, blobs[i]))
    ids, docs = [ids[i] for i in order], [np.frombuffer(blobs[i], SHORT) for i in order]
    index = ShardIndex(docs, idf, mean)
    unused = np.ones(len(docs), bool)
    pieces: list[tuple[int, int, int, int, int]] = []
    sequence, filled, cursor = 0, 0, 0

    def take(doc: int, start: int) -> int:
        """Put what fits of a document into the open window; how far it got."""
        nonlocal sequence, filled
        length = min(len(docs[doc]) - start, window - filled)
        pieces.append((doc, start, length, sequence, filled))
        filled += length
        if filled == window:
            sequence, filled = sequence + 1, 0
        return start + length

    carried: tuple[int, int] | None = None
    while True:
        if carried is None:
            while cursor < len(docs) and not unused[cursor]:
                cursor += 1
            if cursor == len(docs):
                break
            carried = (cursor, 0)
            unused[cursor] = False
        seed, start = carried
        carried = None
        while len(docs[seed]) - start >= window - filled:
            start = take(seed, start)
            if start == len(docs[seed]):
                break
        if start == len(docs[seed]):
            continue
        take(seed, start)
        n_terms, closed = SEED_TERMS, False
        while not closed:
            for doc in index.neighbours(seed, unused, n_terms).tolist():
                unused[doc] = False
                end = take(doc, 0)
                if end < len(docs[doc]) or filled == 0:
                    carried = (doc, end) if end < len(docs[doc]) else None
                    closed = True
                    break
            closed = closed or n_terms >= len(index.terms[seed])
            n_terms *= 4
    pieces = _cut_last(pieces, sequence, filled)
    cut = [docs[d][s : s + n] for d, s, n, _, _ in pieces]
    made = pa.table(
        {
            "doc_id": pa.array([ids[p[0]] for p in pieces], pa.int64()),
            "start": pa.array([p[1] for p in pieces], pa.int64()),
            "length": pa.array([p[2] for p in pieces], pa.int64()),
            "ids_crc32": pa.array([zlib.crc32(c.astype(LONG).tobytes()) for c in cut], pa.int64()),
            "doc_tokens": pa.array([len(docs[p[0]]) for p in pieces], pa.int64()),
            "sequence_id": pa.array([first + p[3] for p in pieces], pa.int64()),
            "offset": pa.array([p[4] for p in pieces], pa.int64()),
            "ids": pa.array([c.tobytes() for c in cut], pa.binary()),
        }
    )
    return made, first + 1 + max(p[3] for p in pieces)


def _cut_last(pieces: list, sequence: int, filled: int) -> list:
    """Deal the last, unfilled window over sequences whose lengths are powers of two."""
    kept = [p for p in pieces if p[3] != sequence]
    open_window = [p for p in pieces if p[3] == sequence]
    room, offset = 0, 0
    for doc, start, length, _, _ in open_window:
        while length:
            if room == 0:
                room, offset = 1 << (filled.bit_length() - 1), 0
                filled -= room
            n = min(length, room)
            kept.append((doc, start, n, sequence, offset))
            start, length, room, offset = start + n, length - n, room - n, offset + n
            if room == 0:
                sequence += 1
    return kept
