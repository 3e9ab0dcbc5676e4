"""Main text of web pages by consensus host paths.

1. Every page is read into its tree of block elements; each container is scored by the text
   that stands in it outside links and outside boilerplate elements.
2. The pages of a host vote, in Spark, with the path of their best container: tags and
   classes from the root, digits generalised. The votes are summed per (host, path), so a
   host of any size is a row per path.
3. Every page is read again with its host's winning path: the containers on that path (the
   page's own best one, if it has none) give the text, block by block in page order.

Boilerplate elements (menus, headers, footers, sidebars, notices, adverts, forms, scripts,
styles, reader comments) never give text, also inside the winning container. Ids of headings,
paragraphs, sections and other anchors do not mark boilerplate, but for a section whose whole
id names a part of the page. A class marks by its name as a whole: the words that also name
topics (``search``, ``social``, ``notice``) mark as the last word of a name or among words for parts
of a page; ``has-sidebar`` and ``content-sidebar-wrap`` tell of a layout, and a class ``discussion``
inside an article is a part of it.
What holds the main element is never left out, and if the marks would leave a page without
text, its outermost marked elements are taken back. Advert marks also count on inline elements.

A page's container is the one with the most text of its own. Quotations, table cells of plain
text and sections beside text of their container belong to the container around them; if the
best one holds less than half of the page's good text, the smallest around it that does is
taken. Character references are decoded; white space becomes one space
within a block, blocks are joined by one space; nothing else is dropped.

Defined cases: null or empty html gives an empty text; a null url counts as one host of its
own; a self-closed svg is empty, and a raw element but script, style, textarea and title that
nothing closes ends at its own tag; a page cut off in the middle ends there (open elements close, an open comment, script or
tag gives nothing); an empty table gives an empty result.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from erpweave.llm.stored import stored

# Element names of HTML.
RAW = ("script", "style", "textarea", "title", "template", "iframe", "svg", "select")
#: Raw elements that go on to the end of the page if nothing closes them; the others then end at their own tag.
TO_END = frozenset(("script", "style", "textarea", "title"))
BOILERPLATE = frozenset(("nav", "header", "footer", "aside", "form", "button", "dialog", "menu", "head"))
CONTAINERS = frozenset(("article", "main", "section", "div", "body", "td", "center", "blockquote"))
BLOCKS = CONTAINERS | BOILERPLATE | frozenset((
    "html", "p", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "li", "dl", "dt", "dd", "table", "thead", "tbody", "tfoot",
    "tr", "th", "pre", "address", "figure", "figcaption", "fieldset", "details", "summary", "hgroup", "caption",
))
VOID = frozenset(("br", "hr", "img", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr"))
#: Words in a class, id or role that mark adverts, on inline elements too.
ADVERTS = frozenset((
    "ad", "ads", "advert", "adverts", "advertisement", "advertisements", "advertising", "adsbygoogle", "sponsor", "sponsored",
    "promo", "promotion",
))
#: Words that mark boilerplate wherever they stand in a name.
STRONG = ADVERTS | frozenset((
    "banner", "navbar", "breadcrumb", "breadcrumbs", "sidebar", "masthead", "footer", "cookie", "cookies", "consent", "gdpr",
    "popup", "modal", "newsletter", "subscribe", "signup", "login", "comment", "comments", "disqus", "pagination", "pager",
    "contentinfo", "complementary",
))
#: Words that also name topics; they mark alone, or among words for parts of a page.
WEAK = frozenset((
    "nav", "navigation", "menu", "header", "notice", "notices", "overlay", "reply", "replies", "respond", "discussion", "related",
    "recommended", "share", "sharing", "social", "widget", "search", "toolbar", "skip", "hidden",
))
MARKS = STRONG | WEAK
#: Words for parts and places of a page.
PART_WORDS = frozenset((
    "list", "lists", "link", "links", "box", "bar", "form", "post", "posts", "article", "articles", "story", "stories", "item", "items",
    "button", "buttons", "icon", "icons", "wrap", "wrapper", "area", "section", "inner", "outer", "container", "content", "left", "right", "top",
    "bottom", "main", "site", "page", "blog", "block", "panel", "media", "result", "results", "input", "row", "col", "column", "primary", "secondary",
    "global", "local", "mobile", "desktop", "sticky", "fixed", "thread", "threads", "title", "body", "text", "group", "tools", "network", "networks",
    "privacy", "legal", "to", "js", "ui", "module", "reader", "user", "follow", "this", "previous", "next", "reading", "count", "more",
))
#: First words of names that tell of something beside the element, not of itself.
NOT_SELF = frozenset(("has", "no", "with", "without", "hide"))
INLINE = frozenset(("span", "ins", "a", "b", "i", "em", "strong", "small", "font", "label"))
#: Elements whose ids are anchors, mostly made from a heading's text, and tell nothing.
ANCHORS = frozenset((
    "h1", "h2", "h3", "h4", "h5", "h6", "hgroup", "p", "section", "li", "dt", "dd", "pre", "figure", "figcaption", "blockquote",
    "caption", "details", "summary", "address",
))
#: Whole ids of sections that name a part of the page all the same.
PARTS = frozenset(("comments", "respond", "disqus", "disqus_thread", "sidebar", "footer", "header", "nav", "navbar", "masthead", "breadcrumbs", "newsletter"))
#: An element that closes an open element of these names in the same container.
CLOSES = {
    "li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "tr": ("tr", "td", "th", "p"),
    "td": ("td", "th", "p"), "th": ("td", "th", "p"), "option": ("option",),
}
LIKELY = frozenset(("article", "main"))

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.S | re.I,
)
_CLOSE = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for name in RAW}
_NAMES = re.compile(r"(?<![^\s\"'/])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_CLASS = re.compile(r"(?<![^\s\"'/])class\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORD = re.compile(r"[a-z]+")
_DIGITS = re.compile(r"\d+")


@dataclass
class Page:
    """Nodes of the block elements: parent, name for the path, tag, left out or not, and why."""

    parent: list[int] = field(default_factory=lambda: [-1])
    name: list[str] = field(default_factory=lambda: [""])
    tag: list[str] = field(default_factory=lambda: [""])
    out: list[bool] = field(default_factory=lambda: [False])
    #: Left out by its own marks, not by its tag.
    marked: list[bool] = field(default_factory=lambda: [False])
    #: (node, text, inside a link) in page order.
    texts: list[tuple[int, str, bool]] = field(default_factory=list)

    def path(self, node: int) -> str:
        names = []
        while node > 0:
            names.append(self.name[node])
            node = self.parent[node]
        return ">".join(reversed(names))

    def on_path(self, path: str) -> set[int]:
        """The nodes on a path, found from the root in one pass."""
        names = path.split(">")
        depth = [0] + [-1] * (len(self.parent) - 1)
        hits = set()
        for i in range(1, len(depth)):
            above = depth[self.parent[i]]
            if 0 <= above < len(names) and self.name[i] == names[above]:
                depth[i] = above + 1
                if depth[i] == len(names) and not self.out[i]:
                    hits.add(i)
        return hits

    def leave_out(self) -> None:
        """Work out ``out`` from the boilerplate tags and the marks of every node."""
        for i in range(1, len(self.parent)):
            self.out[i] = self.out[self.parent[i]] or self.tag[i] in BOILERPLATE or self.marked[i]


def _name_marks(name: str) -> bool:
    """Whether one class name, role or id names boilerplate."""
    words = _WORD.findall(name)
    marks = MARKS.intersection(words)
    if not marks or words[0] in NOT_SELF:
        return False
    if not marks.isdisjoint(STRONG):
        # The wrapper of content and sidebar holds the article.
        return not (words[0] == "content" and words[-1] != "sidebar" and marks == {"sidebar"})
    return words[-1] in marks or all(w in marks or w in PART_WORDS for w in words)


def _marked(tag: str, attrs: str, in_article: bool = False) -> bool:
    """Whether class, role or id mark boilerplate; the id of an anchor does not."""
    for found in _NAMES.finditer(attrs):
        kind, value = found[1].lower(), (found[2] or found[3] or found[4] or "").lower()
        if kind == "id" and tag in ANCHORS:
            if tag == "section" and value.strip() in PARTS:
                return True
        elif any(_name_marks(name) and not (in_article and kind == "class" and name == "discussion") for name in value.split()):
            return True
    return False


def _advert(attrs: str) -> bool:
    """Whether class or id of an inline element mark an advert."""
    return any(
        not ADVERTS.isdisjoint(_WORD.findall(name)) and _WORD.findall(name)[0] not in NOT_SELF
        for found in _NAMES.finditer(attrs) if found[1].lower() != "role"
        for name in (found[2] or found[3] or found[4] or "").lower().split()
    )


def _step(tag: str, attrs: str) -> str:
    """The generalised name of an element on a path: tag and classes, digits as #."""
    found = _CLASS.search(attrs) if attrs else None
    if not found:
        return tag
    classes = sorted(set((found[1] or found[2] or found[3] or "").lower().split()))
    return ".".join([tag, *(_DIGITS.sub("#", c).replace(">", "") for c in classes)])


def read_page(text: str) -> Page:
    """The block tree of a page with its texts."""
    page = Page()
    stack: list[int] = [0]
    open_tags: Counter[str] = Counter()
    link = at = 0

    def close_to(depth: int) -> None:
        for node in stack[depth:]:
            open_tags[page.tag[node]] -= 1
        del stack[depth:]

    def add(tag: str, name: str, marked: bool) -> None:
        page.parent.append(stack[-1])
        page.name.append(name)
        page.tag.append(tag)
        page.marked.append(marked)
        page.out.append(False)
        open_tags[tag] += 1
        stack.append(len(page.parent) - 1)

    unclosed: set[str] = set()
    while token := _TOKEN.search(text, at):
        if token.start() > at:
            page.texts.append((stack[-1], text[at : token.start()], link > 0))
        at = token.end()
        tag = token["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in _CLOSE and not token["end"]:
            if tag != "title":
                page.texts.append((stack[-1], " ", False))
            if tag == "svg" and token["attrs"].endswith("/") or tag in unclosed:
                continue
            close = _CLOSE[tag].search(text, at)
            if close:
                at = close.end()
            elif tag in TO_END:
                at = len(text)
            else:
                unclosed.add(tag)
            continue
        if tag == "a":
            link = 0 if token["end"] else 1
        if tag in VOID:
            page.texts.append((stack[-1], " ", False))
        if tag in INLINE:
            # Inline elements are nodes only where an advert begins, and inside it.
            if token["end"]:
                if page.tag[stack[-1]] == tag:
                    close_to(len(stack) - 1)
            elif not token["attrs"].endswith("/") and (page.tag[stack[-1]] in INLINE or _advert(token["attrs"])):
                add(tag, tag, page.tag[stack[-1]] not in INLINE)
            continue
        if tag not in BLOCKS:
            continue
        page.texts.append((stack[-1], " ", False))
        if token["end"]:
            for depth in range(len(stack) - 1, 0, -1) if open_tags[tag] else ():
                if page.tag[stack[depth]] == tag:
                    close_to(depth)
                    link = 0
                    break
            continue
        attrs = token["attrs"]
        # An open paragraph ends before the next block, a list item before the next item.
        ends = CLOSES.get(tag, ("p",))
        for depth in range(len(stack) - 1, 0, -1) if any(open_tags[t] for t in ends) else ():
            if page.tag[stack[depth]] in ends:
                close_to(depth)
                break
            if page.tag[stack[depth]] in CONTAINERS or page.tag[stack[depth]] in ("table", "ul", "ol", "dl"):
                break
        body = tag in ("html", "body", "article", "main")
        in_article = open_tags["article"] + open_tags["main"] > 0
        add(tag, _step(tag, attrs), not body and bool(attrs) and _marked(tag, attrs, in_article))
    if at < len(text):
        page.texts.append((stack[-1], text[at:], link > 0))
    # What holds the main element is a layout, whatever its name.
    for i in range(1, len(page.parent)):
        if page.tag[i] == "main":
            up = page.parent[i]
            while up > 0 and page.tag[up] not in BOILERPLATE and page.tag[up] != "main":
                page.marked[up] = False
                up = page.parent[up]
    page.leave_out()
    while any(page.marked) and not any(text.strip() and not page.out[node] for node, text, _ in page.texts):
        outer = [i for i in range(1, len(page.parent)) if page.marked[i] and not page.out[page.parent[i]] and page.tag[i] in CONTAINERS]
        if not outer:
            break
        for i in outer:
            page.marked[i] = False
        page.leave_out()
    return page


def _own_scores(page: Page) -> list[float]:
    """Text outside links less text in links of every container, given to the nearest one that can be chosen."""
    n = len(page.parent)
    # A cell is a container of its own only in a layout table, where it holds blocks.
    holds = [False] * n
    for i in range(1, n):
        if page.tag[i] in ("p", "div", "h1", "h2", "h3", "article", "section", "main"):
            holds[page.parent[i]] = True
    takes = [0] * n
    for i in range(1, n):
        tag = page.tag[i]
        own = tag in CONTAINERS and tag != "blockquote" and (tag != "td" or holds[i])
        takes[i] = i if own else takes[page.parent[i]]
    score = [0.0] * n
    for node, text, in_link in page.texts:
        if not page.out[node] and (size := len(text.strip())):
            score[takes[node]] += -size if in_link else size
    # Sections and layout cells beside text, or other sections, of their container belong to it.
    first: dict[int, int] = {}
    for i in range(n - 1, 0, -1):
        if page.tag[i] not in ("section", "td") or takes[i] != i or page.out[i] or score[i] <= 0:
            continue
        up = takes[page.parent[i]]
        if up > 0 and page.tag[up] not in ("body", "td") and (score[up] > 0 or up in first):
            score[up] += score[i]
            score[i] = 0.0
        elif up > 0 and page.tag[up] not in ("body", "td"):
            first[up] = i
    for up, i in first.items():
        if score[up] > 0:
            score[up] += score[i]
            score[i] = 0.0
    return score


def best_container(page: Page) -> tuple[int, float]:
    """The container with the most text outside links and boilerplate, and its score.

    An article or main element around that container takes over, as its parts belong
    together; without one, the smallest container around it that holds most of the page's text.
    """
    score = _own_scores(page)
    best = max(range(len(score)), key=lambda i: (score[i], -i))
    if score[best] <= 0:
        return 0, 0.0
    value, up, around = score[best], best, best
    while up > 0:
        if page.tag[up] in LIKELY:
            around = up
        up = page.parent[up]
    if page.tag[around] in LIKELY:
        return around, value
    total = [max(0.0, x) for x in score]
    for i in range(len(total) - 1, 0, -1):
        total[page.parent[i]] += total[i]
    while around > 0 and 2 * total[around] < total[0] and page.parent[around] > 0:
        around = page.parent[around]
    return around, value


def page_text(page: Page, path: str | None) -> str:
    """The text of the containers on ``path``, or of the page's own best container."""
    chosen = page.on_path(path) if path else set()
    if not chosen:
        chosen = {best_container(page)[0]}
    inside = [i in chosen for i in range(len(page.parent))]
    for i in range(1, len(inside)):
        inside[i] = inside[i] or inside[page.parent[i]]
    parts = [text for node, text, _ in page.texts if inside[node] and not page.out[node]]
    return " ".join(html.unescape("".join(parts)).split())


def host_of(url: Column) -> Column:
    """The host of a URL in lower case; null and hostless URLs share the empty host."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]*)", 1), F.lit("")))


def host_paths(pages: DataFrame) -> DataFrame:
    """host and its winning path: the one with the most votes, each weighted by the log of the text it holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, paths, sizes = [], [], []
            for host, source in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
                page = read_page(source or "")
                node, score = best_container(page)
                if node and score > 0:
                    hosts.append(host)
                    paths.append(page.path(node))
                    sizes.append(len(bin(int(score))))
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(sizes, pa.int64())], names=["host", "path", "votes"])

    votes = pages.select(host_of(F.col("url")).alias("host"), F.col("html")).mapInArrow(run, "host string, path string, votes long")
    summed = votes.groupBy("host", "path").agg(F.sum("votes").alias("votes"))
    return summed.groupBy("host").agg(F.max_by("path", F.struct("votes", "path")).alias("path"))


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) per page."""
    winners = stored(pages.sparkSession, host_paths(pages), "html-paths").withColumnRenamed("host", "_host")
    source = pages.select("page_id", "url", F.col("html").alias("_html"), host_of(F.col("url")).alias("_h"))
    joined = source.join(winners, F.col("_h") == F.col("_host"), "left").select("page_id", "url", "_html", F.col("path").alias("_path"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                page_text(read_page(source), path) if source else ""
                for source, path in zip(batch.column("_html").to_pylist(), batch.column("_path").to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return joined.mapInArrow(run, "page_id long, url string, text string, n_chars long")
