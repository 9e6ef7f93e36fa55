"""Page text, whitening and spelling variants against brute force, and on awkward rows."""

import collections
import decimal
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardtide.llm import pagetext, variants, whitening
from cardtide.llm.vectors import finite

# Page text ------------------------------------------------------------------------------

LONG = "A long sentence, with words in it; and another one, longer still. " * 4
LONG = LONG.strip()
PAGE = "page_id long, url string, html string, text string, n_chars int"


@pytest.mark.parametrize(
    "html, blocks",
    [
        # Plain divisions, a menu of links, a notice and readers' comments without an article element.
        (
            "<body class='home has-sidebar'><div id=top>Site <a href=/>Home</a> <a>About</a></div>"
            "<div class=wrap><div class=left><ul><li><a>One</a></li><li><a>Two</a></li><li><a>Three</a>"
            f"</li></ul></div><div class=text><h1>Title</h1><p>{LONG}</p><p>Short.</p><ul><li>a</li>"
            f"<li>b</li></ul><p>{LONG}</p></div><div class='cookie-notice'>{LONG}</div></div>"
            f"<div id='comments'><p>{LONG} {LONG} {LONG}</p></div></body>",
            ["Title", LONG, "Short.", "a", "b", LONG],
        ),
        # Names that say nothing.
        (
            "<div class=x1><a>A</a> | <a>B</a> | <a>C</a></div><div class=x2><div class=x3><h1>Head</h1>"
            f"<div class=x4>{LONG}</div><div class=x4>tiny</div><div class=x4>{LONG}</div></div></div>"
            "<div class=x5>copyright</div>",
            ["Head", LONG, "tiny", LONG],
        ),
        # A header of its own, a table, an open paragraph; comments told by their heading alone.
        (
            "<header><h1>SITE</h1></header><main><article><header><h1>T</h1></header><p>"
            f"{LONG}<p>two<table><tr><td>a<td>b</table></article><section><h2>Comments (3)</h2><p>{LONG}"
            f"</p><p>{LONG}</p></section></main><aside>x</aside>",
            ["T", LONG, "two", "a", "b"],
        ),
        # An article in an article is a comment; forms, adverts and hidden text go.
        (
            f"<article><h1>T</h1><p>one &nbsp; two</p><article><p>{LONG}</p></article><form><p>mail</p>"
            f"</form><div class='ad-box'>{LONG}</div><p hidden>no</p><p style='display: none'>no</p>"
            "<p>in <span class=advert>Buy</span>line<footer>by x</footer></article>",
            ["T", "one two", "in line"],
        ),
        # Quotes and signs in attributes, references decoded once, scripts, styles, inline marks.
        (
            "<article><p title=\"a > b\">x < y &amp;amp; z</p><P CLASS='q'>UP<script>if(a</b>)</script>"
            "</P><style>p{}</style><!-- c --><p>s<b>o</b>me<i>t</i>hing<br>new\n\tline</p>",
            ["x < y &amp; z", "UP", "something new line"],
        ),
        # A title above the text's own element.
        (
            f"<div class=page><h1>Big</h1><div class=body><p>{LONG}</p><p>{LONG}</p></div>"
            "<div class=share>Tweet</div></div><footer>f</footer>",
            ["Big", LONG, LONG],
        ),
        # A layout table, and a long list as text.
        (
            "<table><tr><td><a>m1</a><br><a>m2</a><br><a>m3</a></td><td><h1>H</h1><p>"
            f"{LONG}</p><ul><li>{LONG}</li><li>{LONG}</li></ul><p>{LONG}</p></td></tr></table>",
            ["H", LONG, LONG, LONG, LONG],
        ),
        # One word only, beside a longer advert and footer.
        (
            f"<nav><a>x</a></nav><div class=ad>{LONG}</div><article><h1>Hi</h1></article><footer>{LONG}</footer>",
            ["Hi"],
        ),
        ("<nav><a>x</a></nav><article><h1></h1></article><footer>foo</footer>", []),
        ("just &lt;text&gt;\n and  more", ["just <text> and more"]),
        ("<p>cut off &amp", ["cut off &"]),
        ("<article><p>text <a hre", ["text"]),
        ("", []),
    ],
)
def test_main_text(html, blocks):
    assert pagetext.article_blocks(html) == blocks


@pytest.mark.parametrize(
    "html",
    [
        "<b>" * 40_000 + "x", "<div>" * 20_000 + "x", "<a " * 20_000, '<p a="' * 20_000, "<!--" * 20_000,
        "<" * 100_000, "<p><b>x" * 10_000, "<div><b>x</p>" * 10_000, "<table><tr><td>" * 5_000 + "x",
        "</p" * 20_000, "&" * 100_000, "<p>w</p>" * 20_000,
    ],
)
def test_hostile_pages_end(html):
    pagetext.main_text(html)


def test_page_rows(spark):
    html = [None, "", "<p>one", "<p>one", "<article>" + "<p>w" * 50_000 + "</article>", "<p>" + "y" * 300_000]
    rows = [(i if i else None, "u", h, "mine", 7) for i, h in enumerate(html)]
    pages = spark.createDataFrame(rows, PAGE)
    got = pagetext.extract_text(pages, keep=["page_id", "url"]).collect()
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in got) == [
        (0, "", 0), (1, "", 0), (2, "one", 3), (3, "one", 3),
        (4, "\n\n".join(["w"] * 50_000), 50_000 * 3 - 2), (5, "y" * 300_000, 300_000),
    ]
    assert pagetext.extract_text(pages.limit(0), keep=["page_id"]).count() == 0
    with pytest.raises(ValueError):
        pagetext.extract_text(pages, keep=["page_id", "text"])


# Whitening ------------------------------------------------------------------------------


def vectors(rng, n, d):
    mixed = rng.normal(0, 0.3, (n, d)) @ rng.normal(0, 1, (d, d)) + rng.normal(0, 5, d)
    return mixed.astype(np.float32)


def whole(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, x string, weight int")
    return df.filter(finite(F.col("embedding"))).select(
        "vec_id", whitening.whole_vector(F.col("embedding")).alias("x")
    )


@pytest.mark.parametrize("weights", ["one", "copies"])
def test_whitening(spark, weights):
    rng = np.random.default_rng(4)
    data = vectors(rng, 400, 20)
    data[100:250] = data[7]  # a third of all rows are one vector
    rows = [(i, v.tolist(), "c", 1) for i, v in enumerate(data)]
    rows += [(900, None, "c", 1), (901, [math.nan] * 20, "c", 1), (902, [None] * 20, "c", 1),
             (903, [math.inf] + [0.0] * 19, "c", 1), (None, data[0].tolist(), "c", 1),
             (3, data[3].tolist(), "c", 1), (904, [], "c", 1)]
    got = whitening.whiten(whole(spark, rows), weights=weights).collect()
    x = np.floor(data.astype(float) * 64).astype(np.int64) + 1_000_000
    used = np.concatenate([x, x[[0, 3]]])
    distinct, copies = np.unique(used, axis=0, return_counts=True)
    w = np.ones(len(distinct), np.int64) if weights == "one" else copies
    n, sums = int(w.sum()), (distinct * w[:, None]).sum(axis=0)
    centred = distinct - sums / n
    cov = (centred * w[:, None]).T @ centred / n
    spread, axes = np.linalg.eigh(cov)
    spread, axes = spread[::-1], axes[:, ::-1]
    assert len(got) == 402 * 16
    values = collections.defaultdict(dict)
    for r in got:
        assert r.n == n
        assert r.explained == pytest.approx(spread[r.component - 1] / np.trace(cov), rel=1e-6)
        assert 0 <= r.identity_error < 1e-9
        values[r.vec_id][r.component] = r
    assert len([r for r in got if r.vec_id == 3]) == 32
    signs = None
    for i in range(400):
        exact = int(((n * x[i].astype(object) - sums) ** 2).sum())
        assert values[i][1].deviation == exact
        want = ((x[i] - sums / n) @ axes / np.sqrt(spread))[:16]
        have = np.array([values[i][c].whitened for c in range(1, 17)])
        signs = np.sign(want * have) if signs is None else signs
        assert np.allclose(have, want * signs, atol=1e-6)


def test_whitening_without_spread(spark):
    same = whole(spark, [(i, [1.0, 2.0, 3.0], "c", 1) for i in range(5)])
    got = whitening.whiten(same).collect()
    assert len(got) == 15
    assert {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in got} == {
        (1, 0, None, None, None)
    }
    # Three points in space have two components; vectors of another length are fitted apart.
    few = [(i, v, "c", 1) for i, v in enumerate([[0.0, 0.0, 0.0], [1.0, 0.0, 0.0], [0.0, 2.0, 0.0], [5.0], [7.0]])]
    got = whitening.whiten(whole(spark, few))
    found = {(r.vec_id, r.component): r for r in got.collect()}
    assert len(found) == 11
    assert all(found[i, 3].whitened is None and found[i, 3].explained == 0 for i in range(3))
    assert all(abs(found[i, 1].identity_error) < 1e-9 for i in range(5))
    assert [abs(found[i, 1].whitened) for i in (3, 4)] == pytest.approx([1, 1])
    assert found[3, 1].n == 2 and found[0, 1].n == 3
    assert whitening.whiten(same.limit(0)).count() == 0


def test_deviation_beyond_a_long(spark):
    far = whole(spark, [(1, [3.0e38, 0.0], "c", 1), (2, [1e14, 1.0], "c", 1), (3, [-1e14, 0.0], "c", 1)])
    got = {r.vec_id: r.deviation for r in whitening.whiten(far.filter("vec_id > 1")).collect()}
    gap = 64 * int(np.float32(1e14)) * 2
    assert got == {2: decimal.Decimal(gap**2 + 64**2), 3: decimal.Decimal(gap**2 + 64**2)}
    assert whitening.whiten(far).count() == 6


# Spelling variants ------------------------------------------------------------------------


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_forms(counts, ratio=10):
    rows = {}
    for w, n in counts.items():
        others = [o for o in counts if near(w, o)]
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        real = best is not None and counts[best] >= ratio * n
        rows[w] = (best if real else None, n, len(others), counts[best] if real else None)
    out = set()
    for w, (form, n, n_near, form_n) in rows.items():
        root = w
        while rows[root][0]:
            root = rows[root][0]
        out.add((w, form, root, n, n_near, form_n))
    return out


@pytest.mark.parametrize("block_words, segments", [(512, 4), (3, 4), (7, 1), (5, 3)])
def test_spelling_forms(spark, block_words, segments):
    rng = random.Random(block_words)
    words = set()
    for _ in range(60):
        word = "".join(rng.choice("abß") for _ in range(rng.randrange(1, 12)))
        words.add(word)
        for _ in range(4):
            i = rng.randrange(len(word) + 1)
            words |= {word[:i] + rng.choice("abé") + word[i:], word[:i] + word[i + 1 :],
                      word[:i] + "c" + word[i + 1 :]}
    words = {w for w in words if w} | {"x" * 5000, "x" * 5001, "x" * 2500 + "y" + "x" * 2499, "😀a", "😀"}
    counts = {w: rng.choice([1, 2, 9, 10, 19, 20, 100, 1000, 10_000]) for w in sorted(words)}
    df = spark.createDataFrame([(w, n, "extra") for w, n in counts.items()], "word string, n long, form string")
    got = variants.spelling_forms(df, segments=segments, block_words=block_words)
    assert {tuple(r) for r in got.collect()} == brute_forms(counts)


def test_forms_of_nothing(spark):
    none = spark.createDataFrame([(None, 3)], "word string, n long")
    assert variants.spelling_forms(none).count() == 0
    one = spark.createDataFrame([("word", 3), (None, 4)], "word string, n long")
    assert [tuple(r) for r in variants.spelling_forms(one).collect()] == [("word", None, "word", 3, 0, None)]


def misspelt(doc_id, text):
    for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
        run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
        h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
        yield run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run


def test_misspelt_words(spark):
    rng = random.Random(2)
    stems = ["".join(rng.choice("abcdeéßÀ×ÿ") for _ in range(rng.randrange(5, 10))) for _ in range(150)]
    rows = [(i, " ".join(rng.choice(stems) + rng.choice(["", "1", "-x", " "]) for _ in range(60)))
            for i in range(40)]
    rows += [(None, "ABCDEFGH abcdefgh"), (5, None), (6, ""), (7, "Z" * 50_000 + " " + "z" * 50_000), (7, "ÉTÉÉTÉÉTÉ")]
    df = spark.createDataFrame([(i, t, "a") for i, t in rows], "doc_id long, text string, word string")
    counts = collections.Counter(w for i, t in rows for w in misspelt(i, t) if len(w) >= 7)
    got = {r.word: r.n for r in variants.misspelt_words(df).collect()}
    assert got == {w: n for w, n in counts.items() if n >= 2}
    assert variants.misspelt_words(df.limit(0)).count() == 0


def test_spelling_query(spark):
    """The whole query on the smallest tables, against all pairs."""
    from cardtide.llm import entries

    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    counts = collections.Counter(w for d in docs for w in misspelt(d.doc_id, d.text) if len(w) >= 7)
    counts = {w: n for w, n in counts.items() if n >= 2}
    by_gap = collections.defaultdict(set)
    for w in counts:
        by_gap[w].add(w)
        for i in range(len(w)):
            by_gap[w[:i] + w[i + 1 :]].add(w)
    beside = collections.defaultdict(set)
    for group in by_gap.values():
        for a in group:
            beside[a] |= {b for b in group if near(a, b)}
    got = {r.word: r for r in entries.op13_spelling_variants(spark, sf_dir).collect()}
    assert got.keys() == counts.keys()
    for w, n in counts.items():
        best = min(beside[w], key=lambda o: (-counts[o], o), default=None)
        form = best if best and counts[best] >= 10 * n else None
        assert (got[w].n, got[w].n_near, got[w].form) == (n, len(beside[w]), form)
        assert got[w].form_n == (counts[form] if form else None)
        root = w
        while got[root].form:
            root = got[root].form
        assert got[w].root == root
