"""Main text of web pages by tag-path ratios.

Every text node lies under a path of tags from the root.  Per path, the length
of the text and its punctuation are added up and divided by the number of nodes;
both ratios are smoothed over the paths in page order and fused, by
multiplication, with the path's length and a prior: what markup declares about
the elements of the path (a name such as ``sidebar`` makes it unlikely, a
``footer`` impossible).  The paths that reach a threshold taken from the page
select the content nodes.

Short parts of an article (headlines, list items, captions) have poor ratios.
They are content where they stand among content nodes: inside the smallest
element that holds all of these, as :func:`_grown` says.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from .common import append_columns

# Elements by their role in HTML.
NO_TEXT = {"script", "style", "noscript", "template", "svg", "iframe", "object", "canvas", "head", "title", "textarea"}
NOT_CONTENT = {"nav", "footer", "aside", "button", "select", "menu", "dialog"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Blocks that hold running text rather than lay out a page.
PROSE = HEADINGS | {"p", "ul", "ol", "dl", "li", "dt", "dd", "table", "pre", "blockquote", "figure", "figcaption", "caption", "tr", "td", "th", "thead", "tbody", "tfoot", "address", "hgroup"}
#: Class, id or role words of parts that aren't the article, wherever they stand.
NEVER = {"ad", "ads", "advert", "adverts", "advertisement", "sponsor", "sponsored", "promo", "promotion", "cookie", "cookies", "consent", "gdpr", "popup", "modal", "newsletter", "subscribe", "breadcrumb", "breadcrumbs", "copyright", "comment", "comments", "disqus", "replies", "share", "sharing", "social", "related", "recommended", "login", "pagination", "pager", "complementary", "contentinfo"}
#: Words that may also name a wrapper around the article (``with-sidebar``): an article or main element inside is content again.
OFTEN = {"banner", "notice", "notices", "alert", "sidebar", "side", "aside", "menu", "nav", "navbar", "navigation", "header", "masthead", "footer", "foot", "search", "widget", "toolbar"}
#: With one of these, ``header`` names the article's own.
OWN = {"article", "post", "entry", "story"}
CONTENT_TAGS = {"html", "body", "main", "article"}
#: Closed by the start of another of the same group.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
BARRIER = {"ul", "ol", "dl", "table", "select", "div", "section", "article", "main", "body", "nav", "aside", "header", "footer", "form", "blockquote"}

#: What markup says, as a factor of a path's score, by how surely it isn't content: nothing, often, by a name or a form, in any case.
PRIOR = (1.0, 0.02, 0.004, 0.0)
#: A path is content from this share of the page's best score on, and from the mean of the page's scores on.
THRESHOLD = 0.3

#: Share of the selected text in paragraphs and the like from which on only these select.
PARAGRAPHS = 0.4

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(?P<raw>script|style|textarea|noscript|template|svg|iframe|title)\b(?:[^>"']++|"[^"]*+"|'[^']*+')*+>.*?(?:</(?P=raw)\s*>|\Z)|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<[!?/][^>]*(?:>|\Z)|(?P<text>[^<]+|<)""", re.S | re.I)
_ATTR = re.compile(r"""([^\s"'>/=]+)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_PUNCTUATION = re.compile(r"[.,;:!?…。，；：！？、]")


class Element:
    """An element of the page: its path, the element around it, and what markup says of it.

    A path is a number, given to each pair of the path above and a step by the
    page's table ``paths``; an element knows only its neighbours upwards, so memory
    grows with the page and not with its depth.
    """

    __slots__ = ("above", "article", "declared", "headline", "level", "link", "own", "path", "prose", "tag", "unseen", "wider")

    def __init__(self, tag: str, step: str, level: int, above: Element | None, paths: dict[tuple[int, str, int], int]) -> None:
        self.tag, self.own, self.above = tag, level, above
        self.path: int = paths.setdefault((above.path, step, level), len(paths) + 1) if above else 0
        self.prose = tag in PROSE or (tag in INLINE and above is not None and above.prose)
        self.headline = tag in ("h1", "h2") or (tag in INLINE and above is not None and above.headline)
        self.link = tag == "a" or (above is not None and above.link)
        self.unseen = tag in NO_TEXT or (above is not None and above.unseen)
        around, declared, article = (above.level, above.declared, above.article) if above else (0, None, False)
        if tag in ("article", "main") and around == 1:
            around, declared = 0, None
        #: The surest level of the element and those around it; the nearest element of level 1 and 2 among them, and the next such around that; in an article, main or so named element.
        self.level = max(level, around)
        self.wider: Element | None = declared
        self.declared: Element | None = self if level in (1, 2) else declared
        self.article = article or tag in ("article", "main") or not OWN.isdisjoint(step.split(".")[1:])


ROOT = Element("", "", 0, None, {})


@dataclass(slots=True)
class Node:
    """A text node: the element it stands in, its block's number, its raw text, how surely markup says that it isn't content."""

    at: Element
    block: int
    text: str
    level: int
    size: int

    @property
    def path(self) -> int:
        return self.at.path


def _label(tag: str, attrs: str) -> tuple[str, int]:
    """Path step of an element, and how surely markup says that it isn't content: 0 not, 1 often, 2 by a name or a form, 3 in any case."""
    level = 2 if tag == "form" else 3 if tag in NOT_CONTENT or tag in NO_TEXT else 0
    if not attrs or (tag in CONTENT_TAGS and tag != "article"):
        return tag, level
    names, words = [], []
    for name, *value in _ATTR.findall(attrs):
        name, text = name.lower(), next((v for v in value if v), "")
        if name == "hidden" or (name == "aria-hidden" and text.lower() == "true"):
            level = 3
        elif name in ("class", "id", "role"):
            names += text.lower().split()
            words += [w for w in re.split(r"[^a-z]+", text.lower()) if w]
    # an article is named by what its names begin with: category-social is one about social matters
    never = [re.split(r"[^a-z]+", n)[0] for n in names] if tag == "article" else words
    if not NEVER.isdisjoint(never):
        level = max(level, 2)
    elif tag not in CONTENT_TAGS and not (OFTEN - {"header"} if not OWN.isdisjoint(words) else OFTEN).isdisjoint(words):
        level = max(level, 1)
    return (f"{tag}.{'.'.join(words)}" if words else tag), level


def nodes(page: str) -> list[Node]:
    """Text nodes in page order.  Broken markup is read as far as it goes."""
    out: list[Node] = []
    stack: list[Element] = [ROOT]
    paths: dict[tuple[int, str, int], int] = {}
    closable: dict[str, int] = {}  # open elements by tag
    block = 0

    def close(at: int) -> None:
        for e in stack[at:]:
            closable[e.tag] -= 1
        del stack[at:]

    for m in _TOKEN.finditer(page):
        tag = m["tag"]
        if tag is None:
            if m["text"] is not None:
                at = stack[-1]
                out.append(Node(at, block, m["text"], at.level, len(m["text"].strip())))
            continue
        tag = tag.lower()
        if tag == "br":
            out.append(Node(stack[-1], block, " ", stack[-1].level, 0))
            continue
        if tag not in INLINE:
            block += 1
        if m["end"]:
            at = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), None) if closable.get(tag) else None
            if at is not None and (tag not in INLINE or not any(x.tag in BARRIER for x in stack[at + 1 :])):
                close(at)
        elif tag not in VOID and not m["attrs"].endswith("/"):
            group = CLOSES.get(tag) or ({"p"} if tag not in INLINE else None)
            if group:  # an open paragraph or item ends here
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag in group:
                        close(i)
                        break
                    if stack[i].tag in BARRIER:
                        break
            step, level = _label(tag, m["attrs"])
            if tag == "header" and not (closable.get("article") or closable.get("main")):  # the page's own; an article's header holds its headline
                level = max(level, 1)
            stack.append(Element(tag, step, level, stack[-1], paths))
            closable[tag] = closable.get(tag, 0) + 1
    return out


def _blocks(found: list[Node]) -> str:
    """Nodes as text: characters decoded, white space single, one block a line."""
    lines, current, parts = [], None, []
    for node in [*found, None]:
        if node is None or node.block != current:
            line = " ".join(html.unescape("".join(parts)).split())
            if line:
                lines.append(line)
            if node is None:
                break
            current, parts = node.block, []
        parts.append(node.text)
    return "\n".join(lines)


def path_scores(found: list[Node], width: float = 1.0) -> dict[int, float]:
    """Smoothed, fused ratio of each path; paths in the order of their first node."""
    length: dict[int, float] = {}
    marks: dict[int, float] = {}
    count: dict[int, int] = {}
    prior: dict[int, float] = {}
    for node in found:
        if node.size:
            path = node.path
            length[path] = length.get(path, 0) + node.size
            marks[path] = marks.get(path, 0) + len(_PUNCTUATION.findall(node.text))
            count[path] = count.get(path, 0) + 1
            prior[path] = max(prior.get(path, 0.0), PRIOR[node.level])
    paths = list(length)
    if not paths:
        return {}
    kernel = np.exp(-0.5 * (np.arange(-2, 3) / width) ** 2)
    kernel /= kernel.sum()

    def smooth(x: list[float]) -> np.ndarray:
        near = np.convolve(np.pad(np.array(x, dtype=float), 2, mode="edge"), kernel, mode="valid")
        return 0.85 * np.array(x) + 0.15 * near  # few paths a page: neighbours count less than the path itself

    text_ratio = smooth([length[p] / count[p] for p in paths])
    mark_ratio = smooth([marks[p] / count[p] for p in paths])
    mass = np.log1p([length[p] for p in paths])
    fused = np.log1p(text_ratio) * np.log(1.2 + mark_ratio) * mass * np.array([prior[p] for p in paths])
    return dict(zip(paths, map(float, fused), strict=True))


def _chosen(scores: dict[int, float]) -> set[int]:
    """Paths that reach the page's threshold."""
    best = max(scores.values(), default=0.0)
    least = max(THRESHOLD * best, sum(scores.values()) / max(1, len(scores)))
    return {p for p, v in scores.items() if v and v >= least - 1e-12}


def main_text(page: str) -> str:
    """The article of a page, one block a line; empty if there is none."""
    found = nodes(page)
    freed = _holding_most(found)
    if freed:
        left: dict[Element, int] = {}  # the surest level of what is declared from an element upwards, but for the freed
        for e in _declared(found):
            left[e] = max(0 if e in freed else e.own, left[e.wider] if e.wider else 0)
        for node in found:
            if node.level < 3:
                node.level = left[node.at.declared] if node.at.declared else 0
    chosen = _chosen(path_scores(found))
    selected = [n.path in chosen for n in found]
    # where much of the selected text is in paragraphs, text that stands bare in a layout element selects nothing
    if sum(n.size for n, x in zip(found, selected, strict=True) if x and n.at.prose) >= PARAGRAPHS * sum(n.size for n, x in zip(found, selected, strict=True) if x):
        selected = [x and n.at.prose for n, x in zip(found, selected, strict=True)]
    return _blocks(_grown(found, selected))


def _declared(found: list[Node]) -> list[Element]:
    """The elements of level 1 and 2 around text nodes, each after those around it."""
    out: dict[Element, None] = {}
    for n in found:
        e, chain = n.at.declared, []
        while e is not None and e not in out:
            chain.append(e)
            e = e.wider
        out.update(dict.fromkeys(reversed(chain)))
    return list(out)


def _held(order: list[Element], some: list[Node]) -> dict[Element, int]:
    """Characters of ``some`` nodes inside each of the declared elements."""
    held = dict.fromkeys(order, 0)
    for n in some:
        if n.at.declared is not None:
            held[n.at.declared] += n.size
    for e in reversed(order):
        if e.wider is not None:
            held[e.wider] += held[e]
    return held


def _holding_most(found: list[Node]) -> set[Element]:
    """Elements of level 1 or 2 that hold most of the text, of all and of the chosen paths.

    None where an article outside of them has a tenth of the latter, or where the
    headline (h1 or h2) stands outside and none inside.
    """
    can = [n for n in found if n.level < 3]
    order = _declared(can)
    half = sum(n.size for n in can) / 2
    big = {e for e, size in _held(order, can).items() if size > half}
    if not big:
        return big
    free = [Node(n.at, n.block, n.text, 0, n.size) for n in can]
    chosen = _chosen(path_scores(free))
    headed = [n for n in can if n.size and n.at.headline]
    outside, inside = any(n.at.declared is None for n in headed), _held(order, headed)
    can = [n for n in can if n.path in chosen]
    total = sum(n.size for n in can)
    if sum(n.size for n in can if n.at.article and not n.level) >= 0.1 * total:
        return set()
    held = _held(order, can)
    return {e for e in big if 2 * held[e] > total and (not outside or inside[e])}


class _Part:
    """A node of the page's tree: an element with its parts, or a run of text."""

    __slots__ = ("above", "chosen", "element", "leaf", "linked", "nodes", "open", "parts", "size")

    def __init__(self, element: Element | None, above: _Part | None) -> None:
        self.element, self.above = element, above
        self.parts: list[_Part] = []
        self.nodes: list[int] = []  # places of the text nodes that are direct children
        self.size = self.chosen = self.linked = self.open = 0  # characters: in all, of chosen nodes, in links, not declared to be something else
        self.leaf = True  # a block without blocks inside, or a run of text

    @property
    def tag(self) -> str:
        return self.element.tag if self.element else ""

    def prose(self) -> bool:
        return self.element is None or self.tag in INLINE or self.tag in PROSE


def _tree(found: list[Node], chosen: list[bool]) -> _Part:
    """The page's elements that hold text, with their sums."""
    root = _Part(ROOT, None)
    made, order = {id(ROOT): root}, [root]  # every part after the one above it
    for i, node in enumerate(found):
        e, missing = node.at, []
        while id(e) not in made:
            missing.append(e)
            e = e.above
        at = made[id(e)]
        for e in reversed(missing):
            at.parts.append(inner := _Part(e, at))
            order.append(inner)
            made[id(e)] = at = inner
        if not at.parts or at.parts[-1].element is not None:
            at.parts.append(run := _Part(None, at))
            order.append(run)
        run = at.parts[-1]
        run.nodes.append(i)
        run.size += node.size
        run.chosen += node.size if chosen[i] else 0
        run.linked += node.size if node.at.link else 0
        run.open += node.size if node.level == 0 else 0
    for part in reversed(order):
        if (above := part.above) is not None:
            above.size, above.chosen, above.linked, above.open = above.size + part.size, above.chosen + part.chosen, above.linked + part.linked, above.open + part.open
            above.leaf = above.leaf and (part.element is None or (part.tag in INLINE and part.leaf))
    return root


def _grown(found: list[Node], chosen: list[bool]) -> list[Node]:
    """The chosen nodes and the short parts of the article around them, in page order.

    Start from the smallest element that holds every chosen node, and go up while
    a headline stands beside it.  From there down, an element that holds chosen
    nodes keeps its other parts

    * all of them where it is an article or most of its chosen text is in blocks
      of its own: the paragraphs' siblings;
    * elsewhere, where elements only lay out the page, those between two parts
      with chosen nodes, and headings, paragraphs, lists and tables;

    but never what markup declares not to be content, and outside of articles no
    parts of which most text is links.
    """
    root = _tree(found, chosen)
    if not root.chosen:
        return []
    top = root
    while (inner := next((p for p in top.parts if p.element is not None and p.chosen == root.chosen), None)) is not None and not inner.leaf:
        top = inner
    while top.above is not None and top.tag not in ("article", "main", "body", "html", ""):
        above = top.above
        before = above.parts[: above.parts.index(top)]
        if not any(p.prose() and p.tag not in ("ul", "ol", "") and p.open and 2 * p.linked < p.size for p in before):
            break
        top = above
    keep: set[int] = set()

    def every(part: _Part) -> None:
        todo = [part]
        while todo:
            p = todo.pop()
            keep.update(i for i in p.nodes if found[i].level == 0)
            todo += p.parts

    todo = [(top, top.element.article)]
    while todo:
        part, article = todo.pop()
        with_chosen = [i for i, p in enumerate(part.parts) if p.chosen]
        own = sum(p.chosen for p in part.parts if p.leaf or p.tag in PROSE)
        siblings = article or (2 * own >= part.chosen and part.tag not in ("body", "html", ""))
        for i, p in enumerate(part.parts):
            if p.chosen:
                keep.update(k for k in p.nodes if chosen[k] or found[k].level == 0)
                todo.append((p, article or (p.element is not None and p.element.article)))
            elif not p.open:
                continue
            elif siblings or ((with_chosen[0] < i < with_chosen[-1] or p.prose()) and 2 * p.linked < p.size):
                every(p)
    # a block is content as a whole: its inline parts may lie under paths of their own
    blocks = {found[i].block for i in keep}
    return [n for i, n in enumerate(found) if i in keep or (n.block in blocks and n.level == 0)]


def visible_text(page: str) -> str:
    """All text that a reader sees, boilerplate included."""
    return _blocks([n for n in nodes(page) if not n.at.unseen])


def extract_main_text(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` plus ``text`` and ``n_chars`` (its code points).

    The whole html is read, each row for itself.  Null or empty html, and pages
    without text, give an empty text.  Broken markup (open elements, cut tags) is
    read as far as it goes.  Input columns keep their values; ones named like an
    output are replaced.
    """

    def make():
        def run(pages: list[str]) -> list[list]:
            out = [main_text(p) if p else "" for p in pages]
            return [out, [len(t) for t in out]]

        return run

    return append_columns(pages, html_col, [("text", "string"), ("n_chars", "bigint")], make)
