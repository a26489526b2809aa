"""Main text of web pages by tree scoring.

A page becomes a tree of its block elements; each run of inline text between block
boundaries is a paragraph of the innermost one. What is never main text by its element,
role or class (menus, page headers, footers, sidebars, notices, adverts, forms, comments,
scripts) is left out with all inside. Every other paragraph earns points for its length and
its commas, times the share of its text that is not links, and passes them to its
ancestors, less to each further one. The best container is taken, or the ``article`` or
``main`` around it, with those of its siblings that score enough, and gives all of its
paragraphs in page order. A row is one page and one task's work; nothing is shuffled.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements by their part in a page.
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark meter nobr output picture "
    "q rp rt ruby s samp small source span strike strong sub sup time tt u var wbr "
    "math maction merror mfrac mi mn mo mover mpadded mphantom mroot mrow ms mspace msqrt mstyle msub msubsup msup "
    "mtable mtd mtext mtr munder munderover semantics".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_DROPPED = frozenset(
    "applet aside audio button canvas datalist dialog fieldset footer form frame frameset head iframe input "
    "legend link map menu menuitem meta nav noembed noframes noscript object optgroup option progress script "
    "search select style svg template textarea title video".split()
)
_RAW = "script|style|noscript|template|textarea|svg|iframe|title|select|noframes|xmp|annotation|annotation-xml"
# Words of class, id and role that mark what the contract leaves out: menus, headers, footers, sidebars, notices,
# adverts, forms and reader comments.
_UNWANTED = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments "
    "complementary consent contentinfo cookie cookies dialog discussion footer foot form gdpr login masthead menu menus "
    "modal nav navbar navigation newsletter notice notices notification overlay pager pagination popup privacy promo "
    "promoted promotion recommended related replies reply respond search share sharing sidebar signup skip social "
    "sponsor sponsored sponsors subscribe subscription supplemental tags toolbar topbar widget".split()
)
# An article is left out for these only; a name with one of the second says what a part lacks or has beside it.
_UNWANTED_ARTICLE = frozenset(
    "ad ads advert advertisement comment comments promo promoted recommended related replies reply sponsored".split()
)
_BESIDE = frozenset("free has is no non not with without".split())
# What such a part may be called besides: a name with any other word, such as social-science, is the name of a topic.
_PARTS = frozenset(
    "a area article articles bar block body bottom box btn button buttons center col column container content "
    "entry fixed footer global group head header heading holder icon icons inner inline item items left link links list main "
    "media meta mobile module nav page panel posts post primary right row secondary section side site slot small "
    "sticky stories story text top unit view wide wrap wrapper form field input us me on our policy bottom-bar".split()
)
# As the id of a section these may be the anchor of a heading: what is inside decides.
_ANCHORS = frozenset(
    "discussion notice notices notification privacy recommended related replies respond search share sharing social "
    "sponsors subscription supplemental tags consent comments navigation promotion".split()
)
_COMMENT = frozenset("author avatar comment comments commenter replies reply respond user username".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_MOST_LINKS = 0.25
# Elements that hold the page: their class names drop nothing.
_WHOLE = frozenset(["html", "body", "main"])
_HEADERS = frozenset(["header", "head", "heading", "banner", "masthead", "topbar"])
_WANTED = frozenset("article body content entry main post story text".split())
# One attribute with its value, if any; the style of what is not shown.
_ATTRIBUTE = re.compile(r"([^\s\"'>/=][^\s>/=]*+)(?:\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.S)
_UNSHOWN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)\s*(?:!\s*important\s*)?(?:;|$)", re.I)
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({_RAW})\b[^>]*>.*?(?:</\1\s*>|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>",
    re.S | re.I,
)
_WORDS = re.compile(r"[a-z]+")
_CLOSES_P = frozenset(
    "address article aside blockquote center details dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr main menu nav ol p pre section table ul".split()
)
_SAME_CLOSES = {"li": "li", "dt": "dd dt", "dd": "dd dt", "tr": "tr td th", "td": "td th", "th": "td th"}
_LIMITS = frozenset("ul ol dl table body html article div section".split())
_PROSE = 80
_MIN_PARAGRAPH, _PER_POINT, _MOST_BY_LENGTH = 25, 100, 3
_LINKS_ONLY, _SIBLING_SHARE, _SIBLING_POINTS = 0.8, 0.2, 10.0


def _attributes(raw: str) -> dict[str, str]:
    """Values by name in lower case; of a repeated name the first counts."""
    found: dict[str, str] = {}
    for match in _ATTRIBUTE.finditer(raw):
        value = match[2] or match[3] or match[4] or ""
        found.setdefault(match[1].lower(), html.unescape(value) if "&" in value else value)
    return found


def _hidden(tag: str, attributes: dict[str, str]) -> bool:
    """Whether the page does not show an element: by an attribute, its style or a class of that name."""
    return (
        attributes.get("hidden", "false").strip().lower() not in ("false", "until-found")
        or attributes.get("aria-hidden", "").strip().lower() == "true"
        or bool(_UNSHOWN.search(attributes.get("style", "")))
        or tag not in _WHOLE
        and "hidden" in attributes.get("class", "").lower().split()
    )


class _Node:
    __slots__ = ("begin", "chars", "comments", "doubtful", "dropped", "end", "links", "link_chars", "parent", "points", "tag", "wanted")

    def __init__(self, tag: str, parent: _Node | None, dropped: bool, wanted: bool) -> None:
        self.tag, self.parent, self.dropped, self.wanted = tag, parent, dropped, wanted
        self.points, self.chars, self.link_chars, self.links = 0.0, 0, 0, 0
        self.begin = self.end = 0
        self.doubtful, self.comments = False, 0

    def above(self) -> Iterator[_Node]:
        node = self.parent
        while node:
            yield node
            node = node.parent


class _Tree:
    """Blocks of a page; ``paragraphs`` are (node, text, characters in links) in page order."""

    def __init__(self, page: str) -> None:
        self.root = _Node("html", None, False, False)
        self.nodes = [self.root]
        self.stack = [self.root]
        self.paragraphs: list[tuple[_Node, str, int]] = []
        self._pieces: list[str] = []
        self._link_chars = self._links = 0
        self._in_link = False
        at = 0
        for token in _TOKEN.finditer(page):
            if token.start() > at:
                self._text(page[at : token.start()])
            at = token.end()
            tag = token[3] or token[6]
            if tag:
                closing = token[2] if token[3] else token[5]
                self._tag(tag.lower(), bool(closing), (token[4] if token[3] else token[7]) or "")
            elif token[0].startswith("<![CDATA["):
                self._text(token[0][9:-3])
        if at < len(page):
            self._text(page[at:])
        self._flush()
        for node in self.stack:
            node.end = len(self.paragraphs)

    def _text(self, raw: str) -> None:
        if not self.stack[-1].dropped:
            text = html.unescape(raw) if "&" in raw else raw
            self._pieces.append(text)
            if self._in_link:
                self._link_chars += len(text.strip())

    def _flush(self) -> None:
        text = " ".join("".join(self._pieces).split())
        if text:
            node = self.stack[-1]
            link_chars = min(len(text), self._link_chars)
            self.paragraphs.append((node, text, link_chars))
            for one in (node, *node.above()):
                one.chars += len(text)
                one.link_chars += link_chars
                one.links += self._links
        self._pieces, self._link_chars, self._links = [], 0, 0

    def _tag(self, tag: str, closing: bool, attributes: str) -> None:
        if tag == "br":
            self._pieces.append(" ")
            return
        if tag == "a":
            self._in_link = not closing
            self._links += not closing
        if tag in _INLINE:
            if not closing and attributes and tag not in _VOID and _hidden(tag, _attributes(attributes)):
                self._open(tag, attributes)
            elif closing and self.stack[-1].tag == tag:
                self._close(tag)
            return
        self._flush()
        self._in_link = False
        if closing:
            self._close(tag)
            return
        if tag in _CLOSES_P and any(node.tag == "p" for node in self.stack):
            self._close("p")
        for other in _SAME_CLOSES.get(tag, "").split():
            self._close(other, _LIMITS)
        if tag not in _VOID:
            self._open(tag, attributes)

    def _open(self, tag: str, attributes: str) -> None:
        parent = self.stack[-1]
        names: set[str] = set()
        anchors: set[str] = set()
        unwanted_names: set[str] = set()
        values = _attributes(attributes) if attributes else {}
        if values:
            for key in ("class", "id", "role"):
                for name in values.get(key, "").lower().split():
                    words = set(_WORDS.findall(name))
                    if _BESIDE & words:
                        continue
                    names |= words
                    # A part is called by words for parts alone.
                    if words & (_UNWANTED | _HEADERS) and words <= _UNWANTED | _HEADERS | _PARTS:
                        if key == "id" and words <= _ANCHORS:
                            anchors |= words
                        else:
                            unwanted_names |= words
        inside = any(node.tag in ("article", "main") for node in self.stack)
        dropped = (
            parent.dropped
            or tag in _DROPPED
            or (tag == "header" and not inside)
            or bool(values and _hidden(tag, values))
        )
        if not dropped and unwanted_names and tag not in _WHOLE and tag not in _HEADINGS:
            unwanted = _UNWANTED_ARTICLE if tag == "article" else _UNWANTED - _HEADERS if inside else _UNWANTED | _HEADERS
            dropped = bool(unwanted_names & unwanted)
        if names & _COMMENT:
            for above in self.stack:
                above.comments += 1
        node = _Node(tag, parent, dropped, tag in ("article", "main") or bool(names & _WANTED))
        node.doubtful = bool(anchors) and tag not in _WHOLE and tag not in _HEADINGS
        node.begin = len(self.paragraphs)
        self.nodes.append(node)
        self.stack.append(node)

    def _close(self, tag: str, limits: frozenset[str] = frozenset()) -> None:
        for depth in range(len(self.stack) - 1, 0, -1):
            if self.stack[depth].tag == tag:
                for node in self.stack[depth:]:
                    node.end = len(self.paragraphs)
                del self.stack[depth:]
                return
            if self.stack[depth].tag in limits:
                return

    def _drop_doubtful(self) -> None:
        """Parts that an id alone calls menus or comments go unless they are prose of the page."""
        for node in self.nodes:
            if node.doubtful and not node.dropped and node.chars:
                prose = any(len(self.paragraphs[k][1]) >= _PROSE for k in range(node.begin, node.end))
                if not prose or node.comments or node.link_chars >= _MOST_LINKS * node.chars:
                    gone = [self.paragraphs[k] for k in range(node.begin, node.end)]
                    for k in range(node.begin, node.end):
                        self.paragraphs[k] = (node, "", 0)
                    for one in node.above():
                        one.chars -= sum(len(text) for _, text, _ in gone)
                        one.link_chars -= sum(chars for *_, chars in gone)
                    node.dropped = True
        # A node comes after the one around it.
        for node in self.nodes:
            node.dropped |= node.parent is not None and node.parent.dropped

    def main(self) -> list[str]:
        self._drop_doubtful()
        for node, text, link_chars in self.paragraphs:
            if len(text) < _MIN_PARAGRAPH:
                continue
            points = 1 + text.count(",") + text.count("،") + text.count("、") + text.count("，")
            points += min(len(text) / _PER_POINT, _MOST_BY_LENGTH)
            points *= 1 - link_chars / len(text)
            holders = [node, *node.above()]
            if node.tag in ("p", "pre", "td", "blockquote", "li", "dd") and len(holders) > 1:
                holders = holders[1:]
            for level, holder in enumerate(holders):
                holder.points += points / (1 if level == 0 else 2 if level == 1 else 3 * level)
        best, most = self.root, -1.0
        for node in self.nodes:
            if node.dropped or not node.chars:
                continue
            score = self._score(node)
            if score > most:
                best, most = node, score
        around = [node for node in best.above() if node.tag in ("article", "main")]
        if around and best.tag != "article":
            best = around[0]
        chosen = [best]
        if best.parent and best.tag != "body":
            least = max(_SIBLING_POINTS, _SIBLING_SHARE * self._score(best))
            for node in self.nodes:
                if node.parent is best.parent and node is not best and not node.dropped and node.chars:
                    links = node.link_chars / node.chars
                    prose = node.tag in ("p", "blockquote", "pre") and links < 0.25 and node.chars > 80
                    title = node.tag in ("h1", "h2") and links < 0.25
                    if self._score(node) >= least or prose or title:
                        chosen.append(node)
        held = {k for node in chosen for k in range(node.begin, node.end)}
        kept = sorted(held - self._link_lists(held))
        return [self.paragraphs[k][1] for k in kept if self.paragraphs[k][1]]

    def _score(self, node: _Node) -> float:
        return (node.points + 25 * node.wanted) * (1 - node.link_chars / node.chars)

    def _link_lists(self, held: set[int]) -> set[int]:
        """Paragraphs of lists and tables that hold little but links, unless text of the page goes on after them.

        A list that says something beside each of its links, such as an author and a year, stays as well.
        """
        listed = [
            node
            for node in self.nodes
            if node.tag in ("ul", "ol", "dl", "table") and node.links > 1 and node.link_chars > _LINKS_ONLY * node.chars
        ]
        inside = {k for node in listed for k in range(node.begin, node.end)}
        prose = [k for k in held - inside if len(self.paragraphs[k][1]) >= _PROSE]
        last = max(prose, default=-1)
        first = min(prose, default=len(self.paragraphs))
        return {k for node in listed if node.begin < first or node.end > last for k in range(node.begin, node.end)}


def main_text(page: str | None) -> str:
    """Paragraphs of the main text, one a line; empty for null, empty and wordless pages."""
    return "\n".join(_Tree(page).main()) if page else ""


def _extracted(position: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page) for page in batch.column(position).to_pylist()]
            kept = [k for k in range(batch.num_columns) if k != position]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(k) for k in kept),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                [*(batch.schema.names[k] for k in kept), "text", "n_chars"],
            )

    return run


def extracted(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages(page_id, url, html, ...)``; repeated rows too."""
    kinds = {"page_id": "long", "url": "string", "html": "string"}
    pages = pages.select(*(F.col(name).cast(kind).alias(name) for name, kind in kinds.items()))
    return pages.mapInArrow(_extracted(2), "page_id long, url string, text string, n_chars long")
