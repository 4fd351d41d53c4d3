"""HTML extraction: flat text blocks, classified by a decision tree.

A page becomes a flat list of text blocks, cut at block tags. Each block has its word count and link density, those
of the block before and after it, whether it lies in an article (or outside one, on a page that has any), whether in an element
that HTML itself sets apart, and what share of the words in the names of its elements speak of page furniture. A tree of Gini
splits, grown on the labelled table below, decides which blocks are main text: a name alone decides nothing. Pages are parsed in
one pass, in time proportional to their length, without a shuffle.

Null and empty html give empty text. Repeated rows and null ids are returned each. Unclosed tags end with the element
around them; an unclosed comment, script or style, and a tag that the page ends in, hide the rest of the page, as in browsers.
Extra columns, also of clashing names, are ignored; a table without rows gives one."""

from __future__ import annotations

import html as _html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.llm import common as C

# Elements of HTML by kind.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
APART = frozenset("nav header footer aside form button select menu dialog noscript template svg head object canvas".split())
APART_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert".split())
# Words in class names and ids that speak of page furniture, and words that speak of layout only.
SPEAKING = re.compile(r"ad|ads|advert.*|sponsor.*|promo.*|banner.*|nav.*|menu.*|sidebar.*|aside|footer.*|header|masthead|comment.*|replies|disqus.*|cookie.*|consent|notice.*|alert|popup|modal|overlay|related|recommend.*|share.*|sharing|social|breadcrumb.*|newsletter|subscribe|pagination|pager|toolbar|widget.*|login|signup|copyright|legal|skip.*")
LAYOUT = frozenset("site page main box wrapper container block section area list item bar inner outer left right top bottom row col grid clearfix the js".split())
_OPEN = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+)?+)*+)>")
_ATTRIBUTE = re.compile(r"""([a-zA-Z:_-]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?+""")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
COLUMNS = ("words", "link_density", "words_before", "link_density_before", "words_after", "link_density_after", "article", "apart", "speaking")


def _speaking(name: str) -> float:
    """The share of furniture words among the words of a class name or id that speak of more than layout."""
    words = [w for w in (m.lower() for m in _WORDS.findall(name)) if w not in LAYOUT]
    return sum(bool(SPEAKING.fullmatch(w)) for w in words) / len(words) if words else 0.0


def _marks(tag: str, attributes: str) -> tuple[bool, float, bool]:
    """Whether an element is set apart, the share of furniture words in its names, and whether it is an article."""
    if not attributes.strip(" /"):
        return tag in APART, 0.0, tag == "article"
    at = {m[0].lower(): m[1] or m[2] or m[3] for m in _ATTRIBUTE.findall(attributes)}
    role = at.get("role", "")
    hidden = "hidden" in at or at.get("aria-hidden") == "true" or "display:none" in at.get("style", "").replace(" ", "")
    name = 0.0 if tag in ("body", "html") else max((_speaking(n) for n in [*at.get("class", "").split(), at.get("id", "")]), default=0.0)
    return tag in APART or hidden or role in APART_ROLES, name, tag == "article" or role == "article"


def blocks(page: str) -> list[tuple[str, int, bool, bool, float]]:
    """(text, words inside links, in an article, set apart, greatest share of furniture words) of each block that has text, in page order."""
    out: list[tuple[str, int, bool, bool, float]] = []
    stack: list[tuple[str, bool, float, bool, dict]] = []  # and of an element that isn't inline the counts of those around it
    counts: dict[str, int] = {}  # open elements that aren't inline, by tag
    inline: dict[str, int] = {}  # open inline elements within the innermost that isn't
    names: list[float] = [0.0]
    text: list[str] = []
    linked: list[str] = []
    apart = article = link = at = 0
    n = len(page)

    def flush() -> None:
        if text:
            t = " ".join(_html.unescape("".join(text)).split())
            if t:
                out.append((t, len(_html.unescape("".join(linked)).split()), article > 0, apart > 0, names[-1]))
            text.clear(), linked.clear()

    def add(s: str) -> None:
        if s:
            text.append(s)
            if link:
                linked.append(s)

    def pop() -> str:
        nonlocal apart, article, link, inline
        tag, f, _, a, outer = stack.pop()
        apart, article, link = apart - f, article - a, link - (tag == "a")
        names.pop()
        if tag in INLINE:
            inline[tag] -= 1
        else:
            counts[tag] -= 1
            inline = outer
        return tag

    while at < n:
        k = page.find("<", at)
        if k < 0:
            add(page[at:])
            break
        add(page[at:k])
        nxt = page[k + 1 : k + 2]
        if nxt in ("!", "?"):
            if page.startswith("<!--", k):
                at = page.find("-->", k + 4)
                at = n if at < 0 else at + 3
            elif page.startswith("<![CDATA[", k):
                end = page.find("]]>", k)
                add(_html.escape(page[k + 9 : n if end < 0 else end], quote=False))
                at = n if end < 0 else end + 3
            else:
                at = page.find(">", k)
                at = n if at < 0 else at + 1
            continue
        if not (nxt.isascii() and nxt.isalpha() or nxt == "/"):
            add("<")
            at = k + 1
            continue
        m = _OPEN.match(page, k)
        if not m:
            at = page.find(">", k) + 1 if nxt == "/" else 0
            if not at:
                break  # the page ends inside the tag
            continue
        at, tag, attributes = m.end(), m[2].lower(), m[3]
        if tag not in INLINE:
            flush()
        if m[1]:
            if (inline if tag in INLINE else counts).get(tag, 0):
                while pop() != tag:
                    pass
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*+>", re.I).search(page, at)
            at = end.end() if end else n
            continue
        if tag in VOID or attributes.rstrip().endswith("/") and tag in ("svg", "path"):
            continue
        if tag in ("p", "li") and stack and counts.get(tag, 0):
            depth = len(stack) - 1
            while depth >= 0 and stack[depth][0] in INLINE:
                depth -= 1
            if stack[depth][0] == tag:
                while pop() != tag:
                    pass
        f, s, a = _marks(tag, attributes)
        stack.append((tag, f, s, a, inline))
        names.append(max(names[-1], s))
        if tag in INLINE:
            inline[tag] = inline.get(tag, 0) + 1
        else:
            counts[tag] = counts.get(tag, 0) + 1
            inline = {}
        apart, article, link = apart + f, article + a, link + (tag == "a")
    flush()
    return out


def table_of(found: list[tuple[str, int, bool, bool, float]]) -> np.ndarray:
    """A row of COLUMNS for each block; article is 1 inside one, -1 outside on a page that has any, else 0."""
    x = np.zeros((len(found), len(COLUMNS)))
    some = any(b[2] for b in found)
    for i, (t, linked, article, apart, speaking) in enumerate(found):
        words = t.count(" ") + 1
        x[i, 0], x[i, 1], x[i, 6], x[i, 7], x[i, 8] = words, min(linked / words, 1.0), 1 if article else -some, apart, speaking
    x[1:, 2:4] = x[:-1, :2]
    x[:-1, 4:6] = x[1:, :2]
    return x


def grow(x: np.ndarray, y: np.ndarray, depth: int = 8):
    """A tree (column, threshold, low branch, high branch) of least Gini impurity; a leaf is 0 or 1."""
    if depth == 0 or len(set(y.tolist())) < 2:
        return int(y.mean() >= 0.5) if len(y) else 0
    best = None
    for c in range(x.shape[1]):  # of equal splits the first column counts: words and neighbours before marks
        for t in (np.unique(x[:, c])[:-1] + np.unique(x[:, c])[1:]) / 2:
            low = x[:, c] <= t
            cost = sum(len(s) * s.mean() * (1 - s.mean()) for s in (y[low], y[~low]))
            if best is None or cost < best[0] - 1e-12:
                best = (cost, c, float(t), low)
    if best is None:
        return int(y.mean() >= 0.5)
    _, c, t, low = best
    return c, t, grow(x[low], y[low], depth - 1), grow(x[~low], y[~low], depth - 1)


def decide(tree, row) -> int:
    while not isinstance(tree, int):
        c, t, low, high = tree
        tree = low if row[c] <= t else high
    return tree


#: The labelled table. A line is a page, a cell a block: + main text or - not, its words (of them in links), and the elements it lies in.
LABELLED = """
-1/1 nav | -2/2 nav | -1/1 nav | -9 div class=ad | +7 article | +60 article | +2 article | +25/2 article | +3/3 article | +80 article | +1 article | +40 article | -8 footer
-5 header | -1/1 header | +4 article | +1 article | +1 article | +50 article | -30 article aside | +3 article | +12 article | -45 article section id=comments | -3 article section id=comments | -2/2 article footer | -9 footer
-3/3 div | -2/2 div | -1 div | +6 div | +55 div | +90 div | +4 div | +70 div | +9 div | +65 div | -3/3 div | -5/5 div | -2 div
-2/2 div | -1/1 div | -2/2 div | +8 main div | +120 main div | +35/3 main div | +1 main div | +48 main div | -4/4 div | -6/6 div | -7/6 div | -4 div
-3 div class=site-header | -1/1 div class=menu | -2/2 div class=menu | +5 article div class=widget-text | +64 article div class=widget-text | +2 article div class=widget-text | +33 article div class=story-social-history | +7 article div class=story-social-history | -5 div class=share | -12 div class=cookie-notice
-4/4 td | -3/3 td | +66 td | +28 td | +3 td | +52 td | -1/1 td | -5/5 td | -16 td class=legal
-11 div class=banner | +9 section | +75 section | +14 section | +41 section | -55 section class=comments | -2 section class=comments | -38 section class=comments | -3/3 ul | -2/2 ul
-1/1 nav | +6 article | +44 article | -12 article div class=advert | +51 article | -4 article form | -7 article form | +30 article | -2/2 article nav | -6 article div class=newsletter | -70 div class=related | -9/9 div class=related | -10 footer
-2 div | -3/3 div | -2/2 div | -3/3 div | +11 div | +85 div | +39/4 div | +58 div | -6/6 div | -8/8 div | -7/7 div | -5 div
-25 aside | +5 div | +49 div | +2 div | +62 div | +13 div | +47 div | -60 aside | -3 aside | -1/1 footer | -14 footer
-8 div | -1/1 ul | -2/2 ul | +10 article | +1 article | +2 article | +3 article | +1 article | +5 article | +70 article | -26 div | -6 div
-1/1 div class=nav-item | +7 div id=post-header-story | +88 div class=post | +45 div class=post | -50 div class=sidebar | -20 div class=sidebar | -31 div class=notice | -13 div class=promo-box
-40 article div class=comment-list | -2 article div class=comment-list | -28 article div class=advert | -35 article div class=related-stories | +40 article | +2 article | +28 article | +3 article div class=lead | -3/3 article div class=share-bar
+1 article div class=widget-text | +50 article div class=widget-text | +3 article
+1 article | +30 article
-5/5 nav | -6/6 nav | +7 article | +60 article | +3 article | +1 article | -5/5 footer
-9/9 ul | +1 article | +33 article | +6/6 article | +41 article | +12/12 article | +2 article | -6/6 ul
-7/7 header | +6 article | +1 article | +80 article | -6/6 article nav | +9 article | +22 article | -8/8 div
-12/12 div | +1 article | +3 article | +2 article | +66 article | +11 article | -7/7 article footer | -9/9 footer
-6/6 div | -7/7 div | +5 main div | +61 main div | +2 main div | +37 main div | -8/8 div
+5 | +60 | +1 | +44 | +12
+70 div | +3 div | +52 div
+40
+2
"""


def _labelled() -> tuple[np.ndarray, np.ndarray]:
    rows, labels = [], []
    for line in filter(None, LABELLED.splitlines()):
        html = []
        for cell in line.split("|"):
            what, *path = cell.split()
            n, _, k = what[1:].partition("/")
            n, k = int(n), int(k or 0)
            tags = re.findall(r"[a-z]+(?: (?:class|id)=[\w-]+)?", " ".join(path))
            words = "<a>" * (k > 0) + " ".join(["x"] * k) + "</a>" * (k > 0) + " " + " ".join(["x"] * (n - k))
            html.append("".join(f"<{t}>" for t in tags) + f"<p>{words}</p>" + "".join(f"</{t.split()[0]}>" for t in tags[::-1]))
            labels.append(float(what[0] == "+"))
        rows.append(table_of(blocks("".join(html))))
    return np.concatenate(rows), np.array(labels)


TREE = grow(*_labelled())


def main_text(page: str | None, tree=None) -> str:
    found = blocks(page or "")
    rows = table_of(found).tolist()
    tree = TREE if tree is None else tree
    return " ".join(b[0] for b, r in zip(found, rows, strict=True) if decide(tree, r))


def extract(pages: DataFrame, html: str = "html", text: str = "text") -> DataFrame:
    """page_id, url, and the main text of every row."""
    C.ship(pages.sparkSession)

    def run(batches):
        for batch in batches:
            for part in C.text_chunks(batch, html):
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([main_text(p) for p in part.column(2).to_pylist()], pa.string())], ["page_id", "url", text])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html).mapInArrow(run, f"page_id long, url string, {text} string")


def op3_html(spark, sf_dir: str) -> DataFrame:
    return extract(C.load(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))
