"""Main text of web pages by tag-path ratios."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Sequence
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.llm.batches import with_text_columns

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)", re.S)
#: one run of attribute text without quotes, or one quoted value
ATTRIBUTES = re.compile(r"[^>\"']++|\"[^\"]*+\"|'[^']*+'")
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
#: elements whose text is never content; the first group is not even markup inside
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "xmp", "noembed", "noframes"}
APART = RAW | {
    "head", "nav", "footer", "aside", "form", "svg", "button", "select", "option", "menu", "dialog", "object", "canvas",
    "audio", "video", "label", "fieldset", "input", "map", "math",
}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img",
    "ins", "kbd", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time",
    "tt", "u", "var", "wbr",
}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: open elements that a new start tag of the kind closes
CLOSED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}, "thead": {"tbody"}, "tbody": {"thead", "tbody"},
}
FENCES = {"table", "ul", "ol", "dl", "article", "section", "div", "main", "body", "html", "td", "th", "blockquote"}
#: names of boxes beside the article
BESIDE = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adbox|sponsor\w*|promo\w*|banner\w*|teaser\w*|cookie\w*|consent\w*|gdpr|notices?|"
    r"noticebar|disclaimer\w*|copyright|popup\w*|modal\w*|overlay|nav\w*|menus?|menubar|breadcrumbs?|toc|\w*sidebars?|aside|"
    r"footer\w*|foot|masthead|site-?header|page-?header|topbar|toolbar|\w*comments?|comment\w*|disqus\w*|respond|replies|"
    r"share\w*|sharing|social\w*|related\w*|recommend\w*|newsletter\w*|subscri\w*|signup|login|paywall|pagination|pager|"
    r"widgets?|skip|search|navigation|complementary|contentinfo|alert|alertdialog)(?=$|[\s_-])", re.I,
)
#: class words that speak of the layout, not of the box
LAYOUT = re.compile(r"(?:has|with|without|no|is)-", re.I)
HIDDEN = re.compile(r"(?:^|\s)hidden(?=[\s=/]|$)|display\s*:\s*none", re.I)
STOPS = re.compile(r"[.,;:!?…。，、！？;：]")
SMOOTH = np.exp(-np.arange(-2, 3) ** 2 / 2.0)
SMOOTH /= SMOOTH.sum()


class Tags:
    """The tags and comments of a page, in one pass over it.

    A tag ends at the first ">" outside quotes. Where there is none, "<" is text, and so is every "<" that the search for
    it has passed outside quotes: those places are kept and not searched again, so a page of tags that never end takes a
    few passes, not one for each.
    """

    def __init__(self, html: str):
        self.html = html
        self.open: list[tuple[int, int]] = []  # runs outside quotes from which no ">" is reached, ascending

    def _end(self, at: int) -> int:
        """The place of the ">" that ends a tag whose attributes begin at ``at``; -1 for none."""
        html, runs = self.html, []
        while True:
            k = bisect_right(self.open, (at, len(html)))
            if k and self.open[k - 1][0] <= at < self.open[k - 1][1]:
                break
            if html.startswith(">", at):
                return at
            run = ATTRIBUTES.match(html, at)
            if not run:
                break
            if html[at] not in "\"'":
                runs.append((at, run.end()))
            at = run.end()
        if runs:
            self.open = sorted([*self.open, *runs])
        return -1

    def next(self, at: int) -> tuple[int, int, str, str, str] | None:
        """(start, end, "/" or "", name, attributes) of the next tag or comment from ``at``; comments have no name."""
        while found := TOKEN.search(self.html, at):
            if not found[2]:
                return found.start(), found.end(), "", "", ""
            end = self._end(found.end())
            if end >= 0:
                return found.start(), end + 1, found[1], found[2].lower(), self.html[found.end() : end]
            at = found.start() + 1
        return None


class Leaf:
    __slots__ = ("path", "chain", "text", "beside", "named")

    def __init__(self, path: str, chain: tuple[int, ...], text: str, beside: bool, named: tuple[int, ...] = ()):
        self.path, self.chain, self.text, self.beside, self.named = path, chain, text, beside, named


def leaves(html: str) -> list[Leaf]:
    """Text blocks in page order, each with its tag path, the elements above it, whether a tag of those stands beside the
    article (or is hidden), and which of them only bear the name of a box beside it. Inline elements and line breaks do not end a block. Unclosed elements end with their parent."""
    out: list[Leaf] = []
    names, marks, numbers = [], [], []  # open block elements: tag, beside, number
    named: list[int] = []  # numbers of those with a name of a box beside
    text: list[str] = []
    count = 0

    def flush():
        if text:
            block = " ".join(unescape("".join(text)).split())
            text.clear()
            if block:
                out.append(Leaf("/".join(names), tuple(numbers), block, any(marks), tuple(named)))

    def close(at):
        flush()
        while named and named[-1] >= numbers[at]:
            named.pop()
        del names[at:], marks[at:], numbers[at:]

    at, tags = 0, Tags(html)
    while tag := tags.next(at):
        start, end, closing, name, said = tag
        if start > at:
            text.append(html[at:start])
        at = end
        if not name:
            continue
        if closing:
            if name in INLINE:
                continue
            if name == "br":
                text.append(" ")
            elif name == "p" and "p" not in names:
                flush()
            elif name in names:
                close(len(names) - 1 - names[::-1].index(name))
            continue
        if name in RAW:
            # nothing inside is markup: go on behind its end tag
            last = re.compile(rf"</{re.escape(name)}\b", re.I).search(html, at)
            at = html.find(">", last.end()) + 1 if last else 0
            at = at or len(html)
            if name not in INLINE:
                flush()
            continue
        if name in INLINE:
            continue
        if name == "br":
            text.append(" ")
            continue
        if name in VOID:
            if name == "hr":
                flush()
            continue
        flush()
        if "p" in names:
            close(len(names) - 1 - names[::-1].index("p"))
        shut = CLOSED_BY.get(name)
        if shut:
            for k in range(len(names) - 1, -1, -1):
                if names[k] in shut:
                    close(k)
                    break
                if names[k] in FENCES - shut:
                    break
        if name in HEADINGS and names and names[-1] in HEADINGS:
            close(len(names) - 1)
        if said.endswith("/"):
            continue
        hidden = bool(HIDDEN.search(said))
        said = " ".join((m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(said)).split()
        # a word of hundreds of letters names no box
        said = [w for w in said if len(w) <= 200 and not LAYOUT.match(w)]
        inner = "article" in names or "main" in names
        beside = name in APART or (not inner and name == "header") or hidden
        called = any(map(BESIDE.search, said)) or (not inner and "header" in said)
        if name in ("html", "body", "main", "article"):
            beside = called = False
        if name == "body" and "head" in names:
            close(names.index("head"))
        count += 1
        names.append(name)
        marks.append(beside)
        numbers.append(count)
        if called:
            named.append(count)
    if at < len(html):
        rest = html[at:]
        cut = rest.rfind("<")
        if cut >= 0 and re.match(r"</?[a-zA-Z!]", rest[cut:]):
            rest = rest[:cut]  # a tag the page ends in
        text.append(rest)
    flush()
    return out


def path_scores(found: Sequence[Leaf]) -> np.ndarray:
    """One fused score per block: text length and punctuation per tag path, each smoothed over neighbours."""
    sums: dict[str, list[float]] = {}
    for leaf in found:
        each = sums.setdefault(leaf.path, [0.0, 0.0, 0.0])
        each[0] += 1
        each[1] += len(leaf.text)
        each[2] += len(STOPS.findall(leaf.text))
    length = np.array([sums[x.path][1] / sums[x.path][0] for x in found])
    stops = np.array([sums[x.path][2] / sums[x.path][0] for x in found])
    smooth = lambda v: np.convolve(np.pad(v, 2, mode="edge"), SMOOTH, mode="valid")
    return smooth(length) * (1 + smooth(stops))


def _article(inside: Sequence[Leaf], weight: dict[int, float], total: float) -> int | None:
    """The element that is the article: an article or main element around most of the content found; else the deepest
    element around it, widened as long as that adds less than a third of it; None for the whole page."""
    best: tuple[int, ...] = ()
    tags: list[str] = []
    for x in inside:
        held = [n for n in x.chain if weight.get(n, 0.0) > 0.6 * total]
        if len(held) > len(best):
            best, tags = tuple(x.chain[: len(held)]), x.path.split("/")
    for wanted in ("article", "main"):
        for number, tag in zip(best, tags):
            if tag == wanted:
                return number
    text: dict[int, int] = {}
    for x in inside:
        for n in x.chain:
            text[n] = text.get(n, 0) + len(x.text)
    boxes = [(n, t) for n, t in zip(best, tags) if t not in ("html", "body", "p") and t not in HEADINGS]
    chosen = None
    for number, _ in reversed(boxes):
        if chosen is not None and text[number] - text[chosen] > total / 3:
            break
        chosen = number
    return chosen


def _content_paths(found: Sequence[Leaf], share: float) -> set[str]:
    """Paths whose mean fused score reaches ``share`` of the deviation of all scores."""
    score = path_scores(found)
    paths: dict[str, list[float]] = {}
    for leaf, s in zip(found, score):
        paths.setdefault(leaf.path, []).append(s)
    level = share * score.std()
    return {p for p, s in paths.items() if np.mean(s) >= level}


def _without_named(found: Sequence[Leaf], share: float) -> list[Leaf]:
    """The blocks outside boxes with the name of a box beside the article.

    A name halves the weight of the content below it. A box counts in spite of its name if an article or main element
    with much of the content is inside, or if it still outweighs all content outside it and no such element stands apart.
    """
    if not any(x.named for x in found):
        return list(found)
    good = _content_paths(found, share)
    total = 0.0
    inside: dict[int, float] = {}
    articles: dict[int, float] = {}
    above: dict[int, tuple[int, ...]] = {}
    joined: dict[int, set[int]] = {}  # articles around or inside a named box
    for x in found:
        if x.path not in good:
            continue
        weight = len(x.text) * 0.5 ** len(x.named)
        total += weight
        for n in x.named:
            inside[n] = inside.get(n, 0.0) + weight
        for n, tag in zip(x.chain, x.path.split("/")):
            if tag in ("article", "main"):
                articles[n] = articles.get(n, 0.0) + weight
                above[n] = tuple(k for k in x.named if k < n)
                for k in x.named:
                    joined.setdefault(k, set()).add(n)
    spared = {n for n, weight in inside.items() if weight > total - weight and len(joined.get(n, ())) == len(articles)}
    most = max(articles.values(), default=0.0)
    for n, weight in articles.items():
        if 2 * weight > most:
            spared.update(above[n])
    return [x for x in found if spared.issuperset(x.named)]


def main_text(html: str | None, share: float = 0.25) -> str:
    """The article's blocks, one per line.

    Blocks in elements whose tag says that they stand beside the article (menus, forms and the like) or that are hidden
    have no score, nor have boxes with such a name (see _without_named). A path is content if its mean fused score
    reaches ``share`` of the deviation of all scores, and all its blocks are part of the text wherever they stand. Of the
    other blocks, a box that directly holds content, or the element that is the article, adds those between its content
    and the headings before; a page without any such box adds its headings.
    """
    found = [x for x in leaves(html) if not x.beside] if html else []
    inside = _without_named(found, share) if found else []
    if not inside:
        return ""
    good = _content_paths(inside, share)
    content = [x.path in good for x in inside]
    weight: dict[int, float] = {}
    total = 0.0
    for leaf, is_good in zip(inside, content):
        if is_good:
            total += len(leaf.text)
            for number in leaf.chain:
                weight[number] = weight.get(number, 0.0) + len(leaf.text)
    article = _article(inside, weight, total)
    boxes = {article}
    span: dict[int, list[int]] = {}  # first and last content block of an element
    for at, (x, is_good) in enumerate(zip(inside, content)):
        if is_good:
            tags = x.path.split("/")
            if len(tags) > 1 and tags[-2] not in ("html", "body"):
                boxes.add(x.chain[-2])
            for n in x.chain:
                span.setdefault(n, [at, at])[1] = at
    kept = []
    for at, (x, is_good) in enumerate(zip(inside, content)):
        heading = x.path.rsplit("/", 1)[-1] in HEADINGS
        if is_good or (heading and article is None):
            kept.append(x)
            continue
        around = [span[n] for n in x.chain if n in boxes and n in span]
        if any(at < last and (heading or first < at) for first, last in around):
            kept.append(x)
    return "\n".join(x.text for x in kept)


def with_main_text(pages: DataFrame, keep: Sequence[str] = ("page_id", "url"), html: str = "html") -> DataFrame:
    """``keep`` columns plus text and n_chars (code points) for every page.

    Null and empty pages, and pages without an article, have an empty text and 0. Pages are worked off in batches of
    bounded bytes without a shuffle; a kept column named text or n_chars gives way.
    """
    fields = [T.StructField("text", T.StringType(), False), T.StructField("n_chars", T.LongType(), False)]

    def compute(data, borders):
        raw = data.tobytes()
        made = [main_text(raw[a:b].decode("utf-8", "replace")) for a, b in zip(borders[:-1], borders[1:])]
        return {"text": pa.array(made, pa.string()), "n_chars": pa.array([len(t) for t in made], pa.int64())}

    return with_text_columns(pages, html, compute, fields, keep)
