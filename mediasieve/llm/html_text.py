"""Main text of web pages by tree scoring.

Paragraphs pass points for their length and commas to their parent, half of them to the next ancestor, and so on; an
element's points are discounted by the share of its text that is in links. Marks by tag, role, class or id that an
element is not the article are penalties: its points reach no ancestor and its text is left out, unless the page's points
or its article lie inside. The element with the most points is the article's container; those of its siblings that
hold article text are kept, and inside it the blocks that are menus or notices by their own text are not.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp template noembed noframes svg math".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol option p pre section select summary table tbody tfoot thead tr ul".split())
CELLS = frozenset(("td", "th"))
CLOSES_P = BLOCKS - {"option", "select"}
# Elements that hold no text of a page; those that are no part of an article; those that are none as a rule.
NEVER = frozenset("head script style noscript template iframe object embed svg math canvas audio video button input select textarea option datalist title".split())
ASIDE = frozenset("nav footer aside menu dialog".split())
SELDOM = frozenset("form fieldset".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar tablist status form note".split())
# Words of class and id. Of one token those of the first kind count 2, of the second 1, and of the third -1; a sum of 1 marks the element.
MARKS = frozenset(
    "adbox adsbygoogle adsense advert adverts advertisement advertising aside breadcrumb breadcrumbs comment comments commentlist consent cookie cookies copyright disqus footer footnav gdpr "
    "header masthead menu menus modal nav navbar navigation newsletter outbrain overlay pager pagination popup promoted rail replies respond sidebar sidenav signup skiplink sponsor sponsored sponsors "
    "subscribe subscription taboola toolbar topbar widget widgets".split()
)
HINTS = frozenset("ad ads adv adslot alert banner hidden legal login notice notices notification popular promo promotion recommendations recommended related search share sharing skip social sr trending".split())
CONTENT = frozenset("article body content entry free main opinion page post story text".split())
PARTS = re.compile(r"cookie|sidebar|advert|newsletter|breadcrumb|disqus|sponsor|paywall")
#: Words of headers, which count outside an article only, and not with a word of the second kind; words by which an article is a comment or a teaser; words of reader comments; words of page layout, which an article inside overrules.
HEAD_WORDS, TITLE_WORDS = frozenset(("header", "masthead", "banner", "topbar")), frozenset("post entry article content story page".split())
REMARKS = frozenset("comment comments reply replies ad ads advert sponsored related recommended promo teaser".split())
READERS = frozenset("comment comments commentlist disqus replies respond".split())
LAYOUT = frozenset("sidebar sidenav rail header banner footer nav navbar menu overlay modal widget widgets".split())
KEEP_TAGS = frozenset(("html", "body", "article", "main"))
#: Marks: none; never text; no article; layout, unless an article is inside; a guess, unless an article or most points are.
NONE, DROP, OFF, FRAME, GUESS = range(5)
#: Characters worth a point and most such points of a paragraph; commas of the scripts in use.
POINT_CHARS, MOST_POINTS, COMMAS = 100, 3, re.compile(r"[,،、，;]")
#: Share of link text of a menu; share of the page's points, and points, that overrule a mark; that share on a page with an article; worth of article and main; share of the best score that keeps a sibling.
MENU_DENSITY, MAJORITY, LEAST, CLEAR, WORTH, SIBLING = 0.6, 0.5, 4.0, 0.75, {"article": 1.5, "main": 1.25}, 0.2
#: A notice by its text: short, and begins with a copyright sign.
NOTICE, NOTICE_CHARS = re.compile(r"\s*(?:©|&copy;|&#169;|&#xa9;|\(c\)\s|copyright\b)", re.I), 200

_TAG = re.compile(r"""<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|</\s*([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)|<([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)>|<([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""", re.S)
_ATTR = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_HREF = re.compile(r"""\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_SPACE = re.compile(r"\s+")
_WORDS = re.compile(r"[a-z0-9]+")
#: What a class says of the layout around, not of the element.
_LAYOUT_NOTE = re.compile(r"\b(?:no|has|with|without)[-_][\w-]*")
_RAW_END = {name: re.compile(rf"</{name}\b[^>]*>", re.I) for name in RAW}
#: What an open element of the first kind is closed by, up to the nearest of the last kind.
_IMPLIED = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}


class Node:
    __slots__ = ("tag", "attrs", "parent", "kids", "mark", "article", "chars", "linked", "links", "inner", "own", "net", "points")

    def __init__(self, tag: str, attrs: str, parent: Node | None, mark: int = NONE):
        self.tag, self.attrs, self.parent, self.kids, self.mark = tag, attrs, parent, [], mark
        self.article = False
        self.chars = self.linked = self.links = self.inner = 0
        self.own = self.net = self.points = 0.0


def _worth(token: str, in_article: bool, words: frozenset[str]) -> int:
    """What the words of one token of class or id say against an element."""
    mine = _WORDS.findall(token)
    total = 0
    for w in mine:
        if w in HEAD_WORDS and (in_article or not TITLE_WORDS.isdisjoint(words)):
            continue
        total += 2 if w in MARKS else 1 if w in HINTS else -1 if w in CONTENT else 0
    return max(total, 1 if PARTS.search(token) else 0)


def _mark(tag: str, attrs: str, in_article: bool) -> int:
    """What tag and attributes say of an element."""
    if tag in NEVER:
        return DROP
    out = OFF if tag in ASIDE else GUESS if tag in SELDOM else FRAME if tag == "header" and not in_article else NONE
    if not attrs or tag in ("html", "body"):
        return out
    for m in _ATTR.finditer(attrs):
        name = m[1].lower()
        if name not in ("class", "id", "role", "style", "hidden", "aria-hidden", "for"):
            continue
        value = (m[2] or m[3] or m[4] or "").lower()
        if name in ("class", "id"):
            value = _LAYOUT_NOTE.sub(" ", value)
            words = frozenset(_WORDS.findall(value))
            if tag in KEEP_TAGS:
                if not REMARKS.isdisjoint(words):
                    return OFF
                continue
            for token in value.split():
                if _worth(token, in_article, words) > 0:
                    found = frozenset(_WORDS.findall(token))
                    if not READERS.isdisjoint(found):
                        return OFF
                    out = out if out == OFF else FRAME if found & MARKS and found & MARKS <= LAYOUT else GUESS
        elif tag in KEEP_TAGS:
            continue
        elif name == "hidden" or name == "aria-hidden" and value == "true":
            return DROP
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return DROP
        elif name == "role" and value.strip() in ROLES:
            out = GUESS if value.strip() == "form" else OFF
        elif name == "for" and tag == "label":  # a label of a field
            return DROP
    return out


def parse(page: str) -> Node:
    """Tree of a page. Missing end tags are implied, stray ones ignored; the time is in proportion to the page, however deep it nests."""
    root = Node("html", "", None)
    stack, names = [root], ["html"]
    depths: dict[str, list[int]] = {}  # where elements of a name are open
    blocks: list[int] = []  # where blocks and cells are open
    at, end, articles = 0, len(page), 0

    def last(name: str) -> int:
        return depths[name][-1] if depths.get(name) else 0

    def pop_to(depth: int) -> None:
        nonlocal articles
        for name in reversed(names[depth:]):
            articles -= name in ("article", "main")
            depths[name].pop()
            if name in BLOCKS or name in CELLS:
                blocks.pop()
        del names[depth:]
        del stack[depth:]

    while at < end:
        m = _TAG.search(page, at)
        upto = m.start() if m else end
        if upto > at:
            stack[-1].kids.append(page[at:upto])
        if not m:
            break
        at = m.end()
        if m[1]:
            name = m[1].lower()
            depth = last(name)
            # An inline end tag does not close a block, nor a paragraph end one around a box.
            if depth and (name in BLOCKS and name != "p" or name in CELLS or not blocks or blocks[-1] <= depth):
                pop_to(depth)
            continue
        name = (m[2] or m[4] or "").lower()
        if not name:
            continue
        attrs = m[3] or m[5] or ""
        if name in ("html", "body") or name == "form" and last("form"):  # a form in a form is none
            continue
        if name in RAW:
            stop = None if attrs.endswith("/") and name in ("svg", "math") else _RAW_END[name].search(page, at)
            at = stop.end() if stop else end if not attrs.endswith("/") else at
            continue
        if name in CLOSES_P and last("p") and blocks[-1] == last("p"):
            pop_to(last("p"))
        if name in _IMPLIED:
            ends, stops = _IMPLIED[name]
            # The outermost of those that end here and lie inside the nearest that stops.
            stop = max(map(last, stops))
            inside = [d for x in ends for d in depths.get(x, ())[-2:] if d > stop]
            if inside:
                pop_to(min(inside))
        if name in VOID:
            if name in ("br", "hr"):
                stack[-1].kids.append(Node(name, "", stack[-1]))
            continue
        here = Node(name, attrs, stack[-1], _mark(name, attrs, articles > 0))
        stack[-1].kids.append(here)
        if attrs.endswith("/") and name not in BLOCKS:
            continue
        articles += name in ("article", "main")
        depths.setdefault(name, []).append(len(names))
        if name in BLOCKS or name in CELLS:
            blocks.append(len(names))
        names.append(name)
        stack.append(here)
    return root


def _order(root: Node) -> list[Node]:
    """All nodes, parents first."""
    out, todo = [], [root]
    while todo:
        n = todo.pop()
        out.append(n)
        todo += [k for k in reversed(n.kids) if type(k) is not str]
    return out


def _outer(attrs: str) -> bool:
    """Whether a link leads to another place by its full address, or to a note of the page."""
    m = _HREF.search(attrs)
    return bool(m) and (m[1] or m[2] or m[3] or "").strip().lower().startswith(("http:", "https:", "//", "#", "doi:"))


def _judge(order: list[Node]) -> None:
    """Characters, link text and points of all nodes; marks that are overruled are taken away."""
    for n in reversed(order):
        n.chars += sum(len(k) - k.count(" ") for k in n.kids if type(k) is str)
        if n.tag == "a":
            n.linked, n.links, n.inner = n.chars, 1, 0 if _outer(n.attrs) else 1
        up = n.parent
        if up is not None and n.mark != DROP:
            up.chars += n.chars
            up.linked += n.linked
            up.links += n.links
            up.inner += n.inner
    for n in order:
        block = n.tag in BLOCKS and any(type(k) is str and not k.isspace() for k in n.kids)
        if n.parent is None or n.mark == DROP or not n.chars or not (block or n.tag in ("p", "pre", "td", "blockquote", "li", "dd", "h1", "h2", "h3")):
            continue
        text = "".join(k if type(k) is str else " " for k in n.kids)
        n.own = (1 + len(COMMAS.findall(text)) + min(n.chars // POINT_CHARS, MOST_POINTS)) * (1 - _density(n))
        if n.tag in ("h1", "h2", "h3", "li"):
            n.own *= 0.25
    marked = []
    for n in reversed(order):
        n.net += n.own
        if n.mark in (FRAME, GUESS) and n.article:
            n.mark = NONE
        up = n.parent
        if n.mark == NONE:
            if up is not None:
                up.net += n.net
                up.article |= n.article or n.tag in ("article", "main") and n.own + n.net > 0
        elif n.mark in (FRAME, GUESS):
            marked.append(n)
    # What holds most of the points of the page is no box beside the article; on a page with an article that takes more, and
    # layout is never overruled so. Without one the largest box may also hold twice what no mark hides.
    free, has_article = order[0].net, order[0].article
    total = free + sum(n.net for n in marked)
    largest = max((n.net for n in marked), default=0.0)
    for n in marked:
        if n.net < LEAST or has_article and (n.mark == FRAME or n.net <= CLEAR * total):
            continue
        if n.net > MAJORITY * total or n.net == largest and n.net > 2 * free:
            n.mark = NONE
            up = n.parent
            while up is not None and up.mark != DROP:
                up.mark, up = NONE, up.parent
    for n in reversed(order):
        up = n.parent
        if up is not None and n.mark == NONE:
            up.points += n.own + n.points / 2


def _density(n: Node) -> float:
    return n.linked / n.chars if n.chars else 0.0


def _menu(n: Node) -> bool:
    """A block of nothing much but links, most of them to the site itself."""
    return n.links > 1 and n.tag in ("ul", "ol", "dl", "div", "section", "table", "p") and _density(n) >= MENU_DENSITY and 2 * n.inner > n.links


def _notice(n: Node) -> bool:
    """A short block whose text begins with a copyright sign."""
    if n.chars > NOTICE_CHARS or n.tag not in ("p", "div", "section", "small", "li", "address"):
        return False
    todo, seen = [n], ""
    while todo and not seen.strip():
        x = todo.pop()
        if type(x) is str:
            seen = x
        else:
            todo += reversed(x.kids)
    return bool(NOTICE.match(seen))


def _lines(roots: list) -> list[str]:
    """Blocks of text of the nodes in page order, without what is marked, menus and notices."""
    out, now = [], []

    def close() -> None:
        if now:
            text = _SPACE.sub(" ", html.unescape("".join(now))).strip()
            now.clear()
            if text:
                out.append(text)

    for root in roots:
        todo: list = [root]
        while todo:
            x = todo.pop()
            if type(x) is str:
                now.append(x)
            elif x is None:
                close()
            elif x.mark != NONE and x is not root:
                if x.tag in BLOCKS:
                    close()
            elif x.tag in BLOCKS or x.tag == "br":
                close()
                if x is not root and (_menu(x) or _notice(x)):
                    continue
                todo.append(None)
                todo += reversed(x.kids)
            else:
                if x.tag in CELLS:
                    now.append(" ")
                todo += reversed(x.kids)
        close()
    return out


def _kept(k: Node, top: float) -> bool:
    """Whether a sibling of the container holds article text."""
    if k.mark != NONE or not k.chars or _menu(k):
        return False
    if k.tag in ("p", "pre", "blockquote", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "dl", "table", "figure"):
        return _density(k) < MENU_DENSITY or 2 * k.inner <= k.links
    return k.points * (1 - _density(k)) >= max(2.0, SIBLING * top)


def main_text(page: str | None) -> str:
    """The article of a page, a line a block; empty for a null or empty page. A page without markup is its own text."""
    if not page:
        return ""
    root = parse(page)
    order = _order(root)
    _judge(order)
    best, top = None, 0.0
    open_ = {id(root)}  # nodes with no mark on the way down to them
    for n in order:
        if n.parent is not None:
            if n.mark != NONE or id(n.parent) not in open_:
                continue
            open_.add(id(n))
        score = n.points * (1 - _density(n)) * WORTH.get(n.tag, 1.0)
        if score > top:
            best, top = n, score
    if best is None:
        return "\n".join(_lines([root]))
    # An article around the best element is the container; without one, its siblings may belong to it.
    around, n = None, best
    while n is not None:
        if n.tag == "article" or n.tag == "main" and around is None:
            around = n
        n = n.parent
    if around is not None:
        return "\n".join(_lines([around]))
    if best.parent is None:
        return "\n".join(_lines([best]))
    top = best.points * (1 - _density(best))
    # Bare text is kept where it stands between parts of the article, not as the text of a page around a box.
    kids = [k for k in best.parent.kids if (not k.isspace() if type(k) is str else k is best or _kept(k, top))]
    if best.parent.parent is None:
        kids = [k for k in kids if type(k) is not str]
    return "\n".join(_lines(kids))


def extracted(df: DataFrame, html_col: str = "html") -> DataFrame:
    """df with text, the main text of html_col (empty for null), and without html_col. One row for each row, repeated ones too; a column of df called text is replaced; an empty table gives no rows."""
    names = [c for c in df.columns if c not in (html_col, "text")]
    own = df.select(*names, F.col(html_col).alias(fresh(df, "_html")))
    kinds = df.select(*names).schema.add("text", "string")

    def run(batches):
        for b in batches:
            texts = pa.array([main_text(x.as_py()) for x in b.column(len(names))], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns[: len(names)], texts], [*names, "text"])

    return own.mapInArrow(run, kinds)


def result(pages: DataFrame) -> DataFrame:
    return extracted(pages.select("page_id", "url", "html")).withColumn("n_chars", F.char_length("text").cast("long"))
