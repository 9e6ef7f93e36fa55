"""Main text of web pages by tag-path ratios.

A page is cut into blocks, the runs of text between tags that start or end a block. Blocks
under one root-to-leaf tag path are taken together: their text outside links and their
punctuation, a block, are the path's two ratios. Ratios are smoothed along the page, more
between like paths, fused into one score with what element names say, and cut at the
scores' standard deviation. The element that holds the paths above the cut is the article.
"""

from __future__ import annotations

import html as references
import re
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

# Elements without content, with text that is no markup, and inside a line.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("iframe noembed noframes noscript script style textarea title xmp".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark nobr output q rb "
    "rp rt ruby s samp small span strike strong sub sup time tt u var".split()
)
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
IN_HEAD = set("base head link meta noscript script style template title".split())
# Elements that a start tag ends where it stands in them, and where the search stops.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr"}, {"table"}),
    "thead": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
SCOPE = set("caption object table td template th".split())
TABLE_PARTS = set("caption table tbody td tfoot th thead tr".split())
# Elements that are never the article, and words that say so in a class, id or role.
NEVER = set(
    "aside audio button canvas datalist dialog fieldset footer form head map math menu nav object "
    "search select svg template video".split()
)
NAMES = set(
    "ad ads advert adverts advertisement advertising alert alertdialog breadcrumb breadcrumbs "
    "comment comments complementary consent contentinfo cookie cookies dialog discussion disqus "
    "dropdown feedback footer gdpr login masthead menu menubar modal nav navbar navigation "
    "newsletter notice notices overlay pager paginate pagination paywall popup promo promoted "
    "promotion recommended related replies respond share sharing sidebar signup skip social "
    "sponsor sponsored subscribe teaser toolbar tooltip widget widgets".split()
)
# Words that say so unless the element is named as part of the article, too.
WEAK_NAMES = {"banner", "header", "search", "toc"}
PART_NAMES = {"article", "body", "content", "entry", "main", "page", "post", "story", "text"}
NEGATIONS = {"has", "hide", "is", "no", "not", "show", "with", "without"}
COMMENT_HEADING = re.compile(
    r"\W*(?:\d+\s+)?(?:(?:reader|user|leave a)\s+)?"
    r"(?:comments?|replies|responses|(?:leser)?kommentare?|commentaires?|comentarios?)"
    r"(?:\s+\(?\d+\)?)?\W*",
    re.IGNORECASE,
)
MENU_LINKS = 3

MARK = re.compile(
    r"<(?:!--(?:-?>|.*?(?:--!?>|\Z))"
    r"|[!?][^>]*+>?"
    r"|/([a-zA-Z][^\s/>]*+)[^>]*+>?"
    r"|([a-zA-Z][^\s/>]*+)"
    r"((?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>]*+))?+)*+)(>|\Z))",
    re.DOTALL,
)
ATTRIBUTE = re.compile(
    r"([^\s/>=][^\s/>=]*+)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]*+)))?+"
)
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
PUNCTUATION = re.compile(r"[.,;:!?、。！，：；？،؟।]")
INVISIBLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)


class Page:
    """Elements of a page in page order, and the blocks of text in them.

    ``parent``, ``tag``, ``names`` and ``path`` are by element; inline elements have none of
    their own. ``blocks`` holds (element, text, characters in links).
    """

    def __init__(self, source: str):
        self.parent, self.tag, self.names = [-1], ["#page"], [frozenset()]
        self.label, self.hidden = ["#page"], [False]
        self.blocks: list[tuple[int, str, int]] = []
        self._open: list[tuple[str, int]] = [("#page", 0)]
        self._count = Counter()
        self._unseen: list[int] = []
        self._chunks: list[str] = []
        self._linked = 0
        self._read(source)

    def _read(self, source: str) -> None:
        at = 0
        while True:
            mark = MARK.search(source, at)
            self._text(source[at : mark.start() if mark else len(source)])
            if mark is None:
                break
            at = mark.end()
            if mark[1]:
                self._end(mark[1].lower())
            elif mark[2] and mark[4]:
                name = mark[2].lower()
                self._start(name, mark[3] or "")
                if name in RAW:
                    close = re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE).search(source, at)
                    at = close.start() if close else len(source)
        self._flush()

    def _text(self, text: str) -> None:
        if not text or self._count["head"] and not text.strip():
            return
        if self._open[-1][0] == "head":
            self._pop(len(self._open) - 1)
        if self._unseen:
            return
        decoded = references.unescape(text) if "&" in text else text
        self._chunks.append(decoded)
        if self._count["a"]:
            self._linked += len("".join(decoded.split()))

    def _flush(self) -> None:
        if self._chunks:
            text = " ".join("".join(self._chunks).split())
            if text:
                self.blocks.append((self._open[-1][1], text, self._linked))
            self._chunks = []
        self._linked = 0

    def _pop(self, depth: int) -> None:
        """End the elements from ``depth`` on."""
        if any(name not in INLINE for name, _ in self._open[depth:]):
            self._flush()
        for name, _ in self._open[depth:]:
            self._count[name] -= 1
        del self._open[depth:]
        while self._unseen and self._unseen[-1] >= depth:
            self._unseen.pop()

    def _find(self, wanted: set[str], stops: set[str]) -> int | None:
        if not any(self._count[name] for name in wanted):
            return None
        for depth in range(len(self._open) - 1, 0, -1):
            name = self._open[depth][0]
            if name in wanted:
                return depth
            if name in stops:
                return None
        return None

    def _start(self, name: str, attributes: str) -> None:
        if name == "br":
            self._chunks.append(" ")
            return
        if name in ("html", "body") and self._count[name]:
            return
        if self._count["head"] and name not in IN_HEAD:
            head = self._find({"head"}, set())
            if head is not None:
                self._pop(head)
        if name in VOID or name in RAW:
            if name == "hr":
                self._flush()
            return
        if name in INLINE:
            # Its text is the enclosing block's, or nobody's.
            names, hidden = _names_of(attributes)
            if hidden or names & NAMES:
                self._unseen.append(len(self._open))
            self._open.append((name, self._open[-1][1]))
            self._count[name] += 1
            return
        names, hidden = _names_of(attributes)
        ended, stops = ENDS.get(name, (set(), set()))
        depth = self._find(ended, stops) if ended else None
        if depth is None:
            depth = self._find({"p"}, SCOPE | {"button"})
        if depth is not None:
            self._pop(depth)
        if name in HEADINGS and self._open[-1][0] in HEADINGS:
            self._pop(len(self._open) - 1)
        if name in ("svg", "math") and attributes.endswith("/"):
            return
        self._flush()
        first = next(iter(re.findall(r"[a-z]+", " ".join(sorted(names))[:40])), "")
        self.parent.append(self._open[-1][1])
        self.tag.append(name)
        self.names.append(names)
        self.hidden.append(hidden)
        self.label.append(f"{name}.{first}" if first else name)
        self._open.append((name, len(self.tag) - 1))
        self._count[name] += 1

    def _end(self, name: str) -> None:
        if name in ("html", "body") or not self._count[name]:
            if name == "br":
                self._chunks.append(" ")
            return
        if name in INLINE:
            for depth in range(len(self._open) - 1, 0, -1):
                if self._open[depth][0] == name:
                    self._pop(depth)
                    return
                if self._open[depth][0] not in INLINE:
                    return
        depth = self._find({name}, {"table"} if name in TABLE_PARTS - {"table"} else SCOPE - {name})
        if depth is not None:
            self._pop(depth)


def _names_of(attributes: str) -> tuple[frozenset[str], bool]:
    """Words of class, id, role and label; and whether the element is not to be seen."""
    if not attributes or attributes.isspace():
        return frozenset(), False
    words, hidden = set(), False
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), next((v for v in values if v), "")
        if name == "hidden" or name == "style" and INVISIBLE.search(value):
            hidden = True
        elif name in ("class", "id", "role", "aria-label"):
            for token in value.split():
                before = None
                for part in NAME_PART.findall(token):
                    part = part.lower()
                    if before not in NEGATIONS:
                        words.add(part)
                    before = part
    return frozenset(words), hidden


def _told_off(tag: str, names: frozenset[str]) -> bool:
    if tag in ("body", "html", "main"):
        return False
    return bool(names & NAMES) or bool(names & WEAK_NAMES) and not names & PART_NAMES


def article_blocks(source: str) -> list[str]:
    """The blocks of a page's main text, in page order."""
    page = Page(source)
    if not page.blocks:
        return []
    outside = _outside(page)
    blocks = [block for block in page.blocks if not outside[block[0]]]
    if not blocks:
        return []
    chosen = _chosen_paths(page, blocks, outside)
    top = _container(page, blocks, chosen)
    within = _below(page, top)
    menus = _menus(page, blocks, chosen, within)
    kept = [text for (node, text, _), good in zip(blocks, chosen, strict=True)
            if within[node] and (good or not menus[node])]
    return _title_before(page, blocks, within) + kept


def _outside(page: Page) -> list[bool]:
    """True for elements that are never the article, by their names or place."""
    n = len(page.tag)
    holds, in_main, in_article = [False] * n, [False] * n, [False] * n
    for node in range(n - 1, 0, -1):
        main = page.tag[node] in ("main", "article") and not _told_off(page.tag[node], page.names[node])
        holds[page.parent[node]] |= holds[node] or main
    commented = _comment_sections(page)
    out = [False] * n
    for node in range(1, n):
        tag, up, names = page.tag[node], page.parent[node], page.names[node]
        in_main[node] = in_main[up] or tag in ("main", "article")
        in_article[node] = in_article[up] or tag == "article"
        never = page.hidden[node] or tag in NEVER and not (tag in ("form", "fieldset") and holds[node])
        header = tag == "header" and not in_main[node]
        # An article within an article is a reader's comment on it.
        comment = tag == "article" and in_article[up] or node in commented and not holds[node]
        named = _told_off(tag, names) and not holds[node]
        if named and in_main[up] and not names & NAMES:
            named = False
        out[node] = out[up] or never or header or comment or named
    return out


def _comment_sections(page: Page) -> set[int]:
    """Elements whose first block is a heading such as "Comments (3)"."""
    found, seen = set(), set()
    for node, text, _ in page.blocks:
        up = page.parent[node]
        if up not in seen and page.tag[node] in HEADINGS and len(text) < 60:
            if COMMENT_HEADING.fullmatch(text) and page.tag[up] in ("div", "section"):
                found.add(up)
        while node >= 0 and node not in seen:
            seen.add(node)
            node = page.parent[node]
    return found


def _weights(page: Page, outside: list[bool], with_text: set[int]) -> list[float]:
    """What names say of a path: 0 beside the page's only article or main element."""
    for wanted in ("article", "main"):
        roots = [i for i, tag in enumerate(page.tag) if tag == wanted and not outside[i]]
        if len(roots) == 1:
            below = _below(page, roots[0])
            return [1.0 if b else 0.0 for b in below]
        if wanted == "article" and len(roots) > 1 and any(r in with_text for r in roots):
            weights = [1.0] * len(page.tag)
            for node in range(1, len(page.tag)):
                own = page.tag[node] == "article"
                weights[node] = 4.0 if own or weights[page.parent[node]] > 1 else 1.0
            return weights
    return [1.0] * len(page.tag)


def _chosen_paths(page: Page, blocks: list[tuple[int, str, int]], outside: list[bool]) -> list[bool]:
    """For each block, whether its path's smoothed and fused ratios pass the threshold."""
    with_text = set()
    for node, _, _ in blocks:
        while node > 0 and node not in with_text:
            with_text.add(node)
            node = page.parent[node]
    weights = _weights(page, outside, with_text)
    # Paths as numbers: an element's path is its parent's and its own label.
    numbers: dict[tuple[int, str], int] = {}
    path, depth = [0] * len(page.tag), [0] * len(page.tag)
    for node in range(1, len(page.tag)):
        up = page.parent[node]
        path[node] = numbers.setdefault((path[up], page.label[node]), len(numbers) + 1)
        depth[node] = depth[up] + 1
    of_block = np.array([path[node] for node, _, _ in blocks])
    _, member = np.unique(of_block, return_inverse=True)
    n = np.bincount(member)
    plain = np.array([max(0, len(t) - t.count(" ") - linked) for _, t, linked in blocks], float)
    shown = np.array([max(1, len(t) - t.count(" ")) for _, t, _ in blocks], float)
    points = np.array([len(PUNCTUATION.findall(t)) for _, t, _ in blocks], float)
    weight = np.array([weights[node] for node, _, _ in blocks])
    length = np.bincount(member, plain) / n
    density = np.bincount(member, plain) / np.bincount(member, shown)
    marks = np.bincount(member, points) / n
    fused = (np.sqrt(length) * (1.0 + np.log1p(marks)) * density)[member] * weight
    smooth = _smoothed(page, blocks, fused, depth, path)
    smooth = np.where(weight > 0, smooth, 0.0)
    of_path = (np.bincount(member, smooth) / n)[member]
    return ((of_path > 0) & (of_path >= of_path.std())).tolist()


def _smoothed(page, blocks, scores: np.ndarray, depth, path) -> np.ndarray:
    """Gaussian mean over the two blocks on either side, weighted by common path depth."""
    total, mass = scores.copy(), np.ones(len(scores))
    nodes = [node for node, _, _ in blocks]
    for step, share in ((1, 0.6), (2, 0.14)):
        if len(scores) <= step:
            break
        like = np.array([_likeness(page, a, b, depth, path)
                         for a, b in zip(nodes, nodes[step:], strict=False)])
        like = like * share
        total[:-step] += like * scores[step:]
        mass[:-step] += like
        total[step:] += like * scores[:-step]
        mass[step:] += like
    return total / mass


def _likeness(page: Page, a: int, b: int, depth, path, deepest: int = 64) -> float:
    """Share of two paths that is common from the root; 1 for equal paths."""
    if path[a] == path[b]:
        return 1.0
    longest = max(depth[a], depth[b], 1)
    for _ in range(deepest):
        if path[a] == path[b] or a <= 0 or b <= 0:
            break
        if depth[a] >= depth[b]:
            a = page.parent[a]
        else:
            b = page.parent[b]
    return depth[a] / longest if path[a] == path[b] else 0.0


def _below(page: Page, top: int) -> list[bool]:
    within = [False] * len(page.tag)
    within[top] = True
    for node in range(top + 1, len(page.tag)):
        within[node] = within[page.parent[node]]
    return within


def _container(page: Page, blocks: list[tuple[int, str, int]], chosen: list[bool]) -> int:
    """The element that holds the chosen text: downwards while one child has most of it."""
    mass, held = [0] * len(page.tag), [0] * len(page.tag)
    own = [False] * len(page.tag)
    for (node, text, _), good in zip(blocks, chosen, strict=True):
        held[node] += 1
        if good:
            mass[node] += len(text)
            own[node] = True
    children = defaultdict(list)
    leaf = [True] * len(page.tag)
    for node in range(len(page.tag) - 1, 0, -1):
        up = page.parent[node]
        mass[up] += mass[node]
        held[up] += held[node]
        if held[node]:
            leaf[up] = False
            children[up].append(node)
    top = 0
    while page.tag[top] != "article" and not own[top]:
        under = [c for c in children[top] if mass[c]]
        if not under:
            break
        best = max(under, key=lambda c: (mass[c], -c))
        flow = {"ul", "ol", "dl", "blockquote", "pre", "figure", "p"} | HEADINGS
        if leaf[best] or page.tag[best] in flow or mass[best] < 0.7 * mass[top]:
            break
        # A chosen paragraph beside it, or a sibling of the same path, is of the same text.
        if any(c != best and (leaf[c] and own[c] and page.tag[c] not in HEADINGS or page.tag[c] in flow - HEADINGS
                              or page.label[c] == page.label[best]) for c in under):
            break
        top = best
    return top


def _menus(page: Page, blocks, chosen: list[bool], within: list[bool]) -> list[bool]:
    """Elements below which nearly all text is links, three at least, and no path is chosen."""
    n = len(page.tag)
    links, linked, shown, good = [0] * n, [0] * n, [0] * n, [False] * n
    for (node, text, in_links), taken in zip(blocks, chosen, strict=True):
        size = len(text) - text.count(" ")
        links[node] += in_links > 0
        linked[node] += in_links
        shown[node] += size
        good[node] |= taken
    for node in range(n - 1, 0, -1):
        up = page.parent[node]
        links[up] += links[node]
        linked[up] += linked[node]
        shown[up] += shown[node]
        good[up] |= good[node]
    menu = [False] * n
    for node in range(1, n):
        own = within[node] and not good[node] and links[node] >= MENU_LINKS
        menu[node] = menu[page.parent[node]] or own and linked[node] >= 0.9 * shown[node]
    return menu


def _title_before(page: Page, blocks, within: list[bool]) -> list[str]:
    """The last main heading before the container, if it has none of its own."""
    if any(page.tag[node] == "h1" and within[node] for node, _, _ in blocks):
        return []
    if page.tag[within.index(True)] in ("article", "#page"):
        return []
    title: list[str] = []
    for node, text, _ in blocks:
        if within[node]:
            return title
        if page.tag[node] == "h1":
            title = [text]
    return []


def main_text(source: str | None) -> str:
    """A page's main text: blocks in page order, with two line ends between them."""
    return "\n\n".join(article_blocks(source)) if source else ""


def extract_text(pages: DataFrame, keep: Sequence[str], html: str = "html", rows: int = 128) -> DataFrame:
    """``keep`` columns of every row, ``text`` (its page's main text) and ``n_chars``.

    A null or empty page, and one without an article, gives the empty text. Rows are
    judged one by one, so repeats, ties and null ids stay as they are, and a page of any
    length is read whole; tasks give their results out every ``rows`` pages. Columns not in ``keep`` may
    have any names; ``keep`` itself holds neither ``text`` nor ``n_chars``.
    """
    if {"text", "n_chars"} & set(keep):
        raise ValueError("text and n_chars are made here; rename the columns of that name")
    source = pages.select(*keep, F.col(html).alias("_page_source"))
    schema = T.StructType(
        [f for f in source.schema.fields[:-1]]
        + [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, rows):
                batch = whole.slice(start, rows)
                texts = [main_text(s.as_py()) for s in batch.column(batch.num_columns - 1)]
                columns = list(batch.columns[:-1])
                columns += [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, "text", "n_chars"])

    return source.mapInArrow(run, schema)
