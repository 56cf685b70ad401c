"""Blocks of text of an HTML page, with what a classifier may know about each."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

#: Fixed values of HTML: elements without an end, without text of the page, and blocks.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
SILENT = frozenset(
    "head script style noscript template svg math canvas iframe object select textarea button "
    "label legend datalist title audio video".split()
)
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li "
    "main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: A start of these ends an open element of the named kinds, up to the nearest of the last.
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}
MAIN = frozenset({"article", "main"})
ASIDE = frozenset({"nav", "aside", "footer", "header", "menu", "dialog"})
#: Parts of a class, id or role that often name what does not belong to an article.
OTHER_NAME = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|nav\w*|menu\w*|breadcrumbs?|sidebar|"
    r"side-?bar|widget|footer|comments?|comment-?list|respon[ds]e?s?|replies|discussion|"
    r"disqus|cookies?|consent|gdpr|notice|alert|popup|modal|overlay|newsletter|subscri\w+|signup|"
    r"login|search|share|sharing|social|related|recommend\w*|pagination|pager|toolbar|skip|"
    r"copyright|legal|disclaimer|complementary|navigation|contentinfo|dialog|hidden)(?:$|[\s_-])",
    re.IGNORECASE,
)
#: Those of them that name what readers wrote.
COMMENT_NAME = re.compile(
    r"(?:^|[\s_-])(?:comments?|comment-?list|respond|replies|disqus)(?:$|[\s_-])", re.IGNORECASE
)
#: Parts that turn a name into one of the layout around, such as has-sidebar or no-banner.
LAYOUT_NAME = re.compile(
    r"(?:^|[_-])(?:has|have|no|not|non|with|without|is|hide|show|enabled?|disabled?|open|closed|"
    r"layout|wrap|wrapper|container|page|site)(?:$|[_-])",
    re.IGNORECASE,
)
#: Elements whose own names say nothing about the text in them: they hold the whole page. The
#: names of a page's main article do not either.
WHOLE = frozenset({"html", "body", "main"})
NOT_SHOWN = re.compile(r"(?:^|[\s;])(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.IGNORECASE)
#: Names that do so outside of an article only, whose own head they are inside it.
HEAD_NAME = re.compile(r"(?:^|[\s_-])(?:header|masthead)(?:$|[\s_-])", re.IGNORECASE)
MAIN_NAME = re.compile(
    r"(?:^|[\s_-])(?:article|post|entry|story|content|main|body|text)(?:$|[\s_-])", re.IGNORECASE
)


@dataclass(eq=False)
class Node:
    """An open element: its tag, its place in the tree and what its markup says.

    `naming` is the nearest element, itself or above, whose name tells of something else than
    an article, `comments` the nearest whose name tells of readers' comments, `article` and `form`
    the nearest of these. `holds_main` is set if a main element or the page's main article is
    this element or below it; `size` counts the characters in it, for an article without those
    of articles inside.
    """

    tag: str
    path: tuple[int, ...]
    other: bool
    main: bool
    children: int = 0
    above: Node | None = None
    naming: Node | None = None
    comments: Node | None = None
    article: Node | None = None
    form: Node | None = None
    holds_main: bool = False
    holds_title: bool = False
    size: int = 0

    def outwards(self) -> Iterator[Node]:
        node: Node | None = self
        while node is not None:
            yield node
            node = node.above


@dataclass
class Block:
    """Text between two block boundaries; `path` numbers the elements around it.

    `in_other` is what elements say that never hold an article's text (nav, footer, hidden
    ones, forms that are not around the page); `in_named` what a class, id or role suggests,
    which may be wrong; `in_comments` that it suggests readers' comments.
    """

    path: tuple[int, ...]
    tag: str
    in_main: bool
    in_other: bool
    box: Node
    naming: Node | None = None
    comments: Node | None = None
    in_named: bool = False
    in_comments: bool = False
    pieces: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""


def named_other(names: list[str], in_main: bool) -> bool:
    """Whether one of the names, each taken whole, tells of something else than an article."""
    return any(
        (OTHER_NAME.search(name) or (not in_main and HEAD_NAME.search(name)))
        and not LAYOUT_NAME.search(name)
        for name in names
    )


class BlockParser(HTMLParser):
    """Collects blocks in page order. Ill-formed markup is read as leniently as it can be."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[Node] = [Node("", (), False, False)]
        self.blocks: list[Block] = []
        self.articles: list[Node] = []
        self.forms: list[Node] = []
        self.block: Block | None = None
        self.silent = self.links = 0
        #: Inline elements that are not shown; their text alone is left out.
        self.unseen: list[Node] = []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "br":
            if self.block:
                self.block.pieces.append(" ")
            return
        if tag in BLOCK:
            self._end_block()
            self._close_before(tag)
        if tag in VOID:
            return
        above = self.stack[-1]
        names = [
            name for key, value in attrs if key in ("class", "id", "role") and value for name in value.split()
        ]
        shown = {key: value or "" for key, value in attrs if key in ("hidden", "aria-hidden", "style")}
        hidden = shown.get("hidden", "false") != "false" or bool(NOT_SHOWN.search(shown.get("style", "")))
        unread = shown.get("aria-hidden", "false") != "false"
        article = above.main and tag == "header"  # the head of an article belongs to it
        opens_main = tag in MAIN or any(
            MAIN_NAME.search(name) and not named_other([name], above.main) for name in names
        )
        other = tag in BLOCK and hidden or (tag in ASIDE and not article)
        node = Node(
            tag,
            (*above.path, above.children),
            above.other or other,
            above.main or opens_main,
            above=above,
            naming=above.naming,
            comments=above.comments,
            article=above.article,
            form=above.form,
        )
        if tag not in WHOLE and (named_other(names, above.main) or tag == "address" or (unread and tag in BLOCK)):
            node.naming = node
            if any(COMMENT_NAME.search(name) and not LAYOUT_NAME.search(name) for name in names):
                node.comments = node
        if tag == "main":
            self._holds_main(node)
        elif tag == "article":
            node.article = node
            self.articles.append(node)
        elif tag == "form":
            node.form = node
            self.forms.append(node)
        elif tag == "h1" and node.form:
            node.form.holds_title = True
        if tag not in BLOCK and (hidden or unread):
            self.unseen.append(node)
        self.stack.append(node)
        above.children += 1
        self.silent += tag in SILENT
        self.links += tag == "a"

    @staticmethod
    def _holds_main(node: Node) -> None:
        for outer in node.outwards():
            if outer.holds_main:
                return  # as do all around it
            outer.holds_main = True

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # a slash closes void elements only, which need none

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCK:
            self._end_block()
        for at in range(len(self.stack) - 1, 0, -1):
            if self.stack[at].tag == tag:
                self._pop(at)
                return
            if self.stack[at].tag in BLOCK and tag not in BLOCK and tag not in SILENT:
                return  # an inline end does not leave the block around it

    def handle_data(self, data: str) -> None:
        if self.silent or self.unseen:
            return
        top = self.stack[-1]
        if self.block is None:
            if not data.strip():
                return
            box = next((n for n in reversed(self.stack) if n.tag in BLOCK), self.stack[0])
            self.block = Block(box.path, box.tag, top.main, box.other, box, top.naming, top.comments)
            self.blocks.append(self.block)
        block = self.block
        block.pieces.append(data)
        if not data.strip():
            return
        # A name inside a block counts if all of the block's text is under one.
        block.in_main |= top.main
        if top.naming is block.box.naming:
            block.naming = top.naming
        if top.comments is block.box.comments:
            block.comments = top.comments
        size = len(data)
        if self.links:
            block.linked += size
        if top.article:
            top.article.size += size
        if top.form:
            top.form.size += size

    def _end_block(self) -> None:
        self.block = None

    def _pop(self, at: int) -> None:
        for node in self.stack[at:]:
            self.silent -= node.tag in SILENT
            self.links -= node.tag == "a"
        while self.unseen and self.unseen[-1] in self.stack[at:]:
            self.unseen.pop()
        del self.stack[at:]

    def _close_before(self, tag: str) -> None:
        """Ends what a block start ends without an end tag: paragraphs, items, cells."""
        kinds, until = CLOSES.get(tag, ((), ()))
        for at in range(len(self.stack) - 1, 0, -1):
            name = self.stack[at].tag
            if name == "p" or name in kinds:
                self._pop(at)
            elif name in BLOCK and (not kinds or name in until):
                return


def _main_article(articles: list[Node]) -> Node | None:
    """The article with most text of its own, of those that no name around calls something else
    if there are such; articles inside it may be comments."""
    plain = [article for article in articles if article.naming is None and not article.other]
    return max(plain or articles, key=lambda article: article.size, default=None)


def page_blocks(html: str | None) -> list[Block]:
    """Blocks with text, white space reduced to single blanks."""
    if not html:
        return []
    parser = BlockParser()
    parser.feed(html)
    parser.close()
    article = _main_article(parser.articles)
    if article is not None:
        parser._holds_main(article)
    some_main = any(node.holds_main for node in parser.stack[:1])
    whole = sum(sum(map(len, block.pieces)) for block in parser.blocks if not block.in_other)
    # A form around the page is layout: it holds the article or title, or most of the text.
    around = {
        id(form)
        for form in parser.forms
        if form.holds_main or (not some_main and (form.holds_title or 2 * form.size > whole))
    }
    for block in parser.blocks:
        block.text = " ".join("".join(block.pieces).split())
        block.pieces = []
        # What is around an element that holds an article holds it too.
        block.in_named = block.naming is not None and not block.naming.holds_main
        block.in_comments = block.comments is not None and not block.comments.holds_main
        form = block.box.form
        block.in_other |= form is not None and id(form) not in around
        block.naming = block.comments = None
    return [block for block in parser.blocks if block.text]
