import random

import numpy as np
import pyarrow as pa
import pytest

from cardtide.llm import lines

LETTERS = "abcdefghijklmnopqrstuvwxyz"


def clusters(rng, n, each, span=150):
    """Texts of ``n`` clusters of copies with another of their first ``span`` letters changed."""
    out = []
    for _ in range(n):
        base = [rng.choice(LETTERS) for _ in range(150)]
        for _ in range(each):
            near = list(base)
            near[rng.randrange(span)] = rng.choice("0123456789")
            out.append("".join(near))
    rng.shuffle(out)
    return out


def tables(spark, texts):
    least = np.concatenate([x[2] for x in lines._least(texts)]).tolist()
    met = spark.createDataFrame([(i, 7) for i in range(1, len(texts) + 1)], "line_id long, band long")
    rows = [(i, t, m) for i, (t, m) in enumerate(zip(texts, least, strict=True), 1)]
    return met, spark.createDataFrame(rows, "line_id long, line string, least array<int>")


def is_near(a, b):
    one, other = ({s[i : i + 12] for i in range(len(s) - 11)} for s in (a, b))
    return len(one & other) >= 0.8 * len(one | other)


# One tile; tiles of pairs of slices; leaders first, then tiles.
@pytest.mark.parametrize(("tile", "leaders"), [(2048, 32), (13, 32), (13, 2)])
def test_tiles_find_the_components(spark, monkeypatch, tile, leaders):
    monkeypatch.setattr(lines, "TILE", tile)
    monkeypatch.setattr(lines, "LEADERS", leaders)
    texts = clusters(random.Random(4), 12, 6)
    got = {r.node: r.root for r in lines._linked(*tables(spark, texts)).collect()}
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if is_near(texts[i], texts[j]):
                root = [root[j] if r == root[i] else r for r in root]
    least = {r: min(i for i, x in enumerate(root, 1) if x == r) for r in set(root)}
    assert {i: got.get(i, i) for i in range(1, len(texts) + 1)} == {i: least[r] for i, r in enumerate(root, 1)}


def test_rows_made_follow_the_lines(spark):
    """A bucket gives as many rows as join its lines, not one for each pair of them."""
    texts = clusters(random.Random(5), 10, 30, span=4)
    met, texts_of = tables(spark, texts)
    alone = met.selectExpr("line_id", "band", "1 AS slices", "line_id AS root")
    links = lines._alike_in_tiles(alone, texts_of)
    assert links.count() == 300 - 10
    assert "MapInArrow" in links._jdf.queryExecution().executedPlan().toString()


def test_buckets_of_the_same_lines_are_one():
    ids, bands = [11, 12, 13, 14], np.arange(4 * lines.BANDS, dtype=np.uint64).reshape(4, lines.BANDS)
    bands[1] = bands[0]  # lines 11 and 12 meet in all bands
    bands[3, 0] = bands[2, 0]
    packed = [row.tobytes() for row in bands]
    dealt = lines._dealt(5)(iter([pa.record_batch([pa.array(ids), pa.array(packed)], names=["line_id", "bands"])]))
    met = [r for b in lines._buckets(dealt) for r in b.to_pylist()]
    by = {}
    for r in met:
        by.setdefault(r["band"], set()).add(r["line_id"])
    assert sorted(map(sorted, by.values())) == [[11, 12], [13, 14]] and len(met) == 4
