"""Main text of web pages by tree scoring: paragraphs pass points to their ancestors, discounted by link density."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField, StructType

_RAW = "script|style|noscript|template|iframe|title|textarea"
_TAGS = (
    r"<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>{attrs})>"
    r"|<[!?/][^>]*(?:>|\Z)|(?P<text>[^<]+|<)"
)
_QUOTED = "(?>\"[^\"]*\"|'[^']*'|[^'\">])*+"


def _tokens(attrs: str) -> tuple[re.Pattern[str], re.Pattern[str]]:
    """Patterns of the next token in HTML, and within svg and math, where no element is raw and any may be self-closed."""
    tags = _TAGS.format(attrs=attrs)
    raw = rf"<!--.*?(?:-->|\Z)|<(?P<raw>{_RAW})(?=[\s/>])(?P<rawattrs>{attrs})>.*?(?:</(?P=raw)\s*>|\Z)|{tags}"
    return re.compile(raw, re.S | re.I), re.compile(rf"<!--.*?(?:-->|\Z)|{tags}", re.S | re.I)


#: Once a tag has no end, as a quote in it has none, the rest of the page is read without regard to quotes.
_STRICT, _LOOSE = _tokens(_QUOTED), _tokens("[^>]*+")
_FOREIGN = frozenset(("svg", "math"))
#: Elements of a foreign one that hold HTML again; other start tags of HTML end the foreign element.
_HTML_AGAIN = frozenset("foreignobject desc title annotation-xml mi mo mn ms mtext".split())
_ENDS_FOREIGN = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split()
)
_ATTR = re.compile(r"""([^\s=/>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>][^\s>]*)))?""")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rb rp rt s samp small span strike strong sub sup time tt u var wbr".split())
#: Elements that never hold main text.
_DROPPED = frozenset("head nav footer aside button select input menu dialog script style noscript template iframe title textarea svg object".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar alert dialog alertdialog note".split())
#: Words of a label that tell an advert.
_AD_LABELS = frozenset("ad ads advert advertisement advertisements sponsored".split())
#: Words of a class or id that mark menus, headers, footers, sidebars, notices, adverts, forms and reader comments.
_NOISE = frozenset(
    "ad ads adbox adsbygoogle adslot adsense advert alert alerts adverts advertisement advertising banner bottombar breadcrumb breadcrumbs comment commentlist comments consent cookie cookies copyright discuss disqus"
    " footer gdpr header legal login masthead menu modal nav navbar navigation newsletter notice notices notification pagination paywall popup promo promoted promotion"
    " related replies reply respond reviews share sharing shoutbox sidebar sidenav signin signup skyscraper social sponsor sponsored subscribe subscription toolbar topbar widget".split()
)
#: Of these, words that also name sections of articles: what is not mostly links may be text of an article.
_WEAK_NOISE = frozenset("alert alerts bottombar copyright discuss legal notice notices notification promoted promotion related reviews share sharing social topbar".split())
#: A block that such words alone mark is text if it holds so much of the points around it.
WEAK_SHARE = 0.25
#: Whole names that say the same as two words, or as a word that says nothing within a longer name.
_NAMES = {"top-bar": "topbar", "bottom-bar": "bottombar", "bottom": "bottombar"}
#: Words of a name: parts between hyphens, underscores and colons, and of camel case.
_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[^\W\d_A-Z]+|\d+")
#: Words of an element that holds reader comments, which can be longer than the article.
_COMMENTS = frozenset("comment commentlist comments discuss disqus replies reply respond shoutbox".split())
#: A form that holds so many points of paragraphs, and most of the page's, is a wrapper of the page.
FORM_POINTS = 4.0
#: Words of names that tell how a page is laid out, as has-sidebar and comments-open do.
_STATE = frozenset("closed disabled enabled has no open with without".split())
_HEADER = frozenset(("header", "masthead"))
_FORM = frozenset(("form",))
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Up to this share of text in links an element counts as text.
LOW_LINKS = 0.25
#: Beyond this share it counts as links.
MOSTLY_LINKS = 0.5
_SCORED = frozenset("p pre td blockquote li dd".split())
#: Elements that end an open element of the same group.
_GROUPS = {"li": "#li", "dt": "#dd", "dd": "#dd", "tr": "#tr", "td": "#td", "th": "#td", "option": "#option"}
_ITEM_SCOPES = frozenset("ul ol dl table select menu".split())
_BLOCK_ENDS_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())


class Node:
    __slots__ = ("children", "depth", "drop", "inner", "links", "noise", "own", "parent", "points", "size", "tag")

    def __init__(self, tag: str, parent: Node | None, drop: bool):
        self.tag, self.parent, self.drop = tag, parent, drop
        self.depth = 0 if parent is None else parent.depth + 1
        #: Whether it lies within an article or main.
        self.inner = parent is not None and (parent.inner or parent.tag in ("article", "main"))
        self.children: list[Node | str] = []
        self.points, self.own, self.size, self.links = 0.0, 0.0, 0, 0
        self.noise: frozenset[str] = frozenset()


class _Open:
    """The open elements of a page: the last one of each kind is found without a walk."""

    def __init__(self, root: Node):
        self.at = root
        self.kinds: dict[str, list[Node]] = {}

    def push(self, node: Node) -> None:
        self.at = node
        for kind in self._of(node.tag):
            self.kinds.setdefault(kind, []).append(node)

    def _of(self, tag: str) -> tuple[str, ...]:
        if tag in _INLINE:
            return (tag,)
        if tag in _ITEM_SCOPES:
            return (tag, "#scope", "#block")
        return (tag, _GROUPS[tag], "#block") if tag in _GROUPS else (tag, "#block")

    def last(self, kind: str) -> Node | None:
        found = self.kinds.get(kind)
        return found[-1] if found else None

    def close(self, node: Node) -> None:
        """Closes ``node`` and all within it."""
        at = self.at
        while at.depth >= node.depth:
            for kind in self._of(at.tag):
                self.kinds[kind].pop()
            at = at.parent
        self.at = at


def _unseen(style: str) -> bool:
    """Whether a style says display:none or visibility:hidden; the last declaration of a property counts."""
    says = {}
    for part in style.split(";"):
        name, _, value = part.partition(":")
        says[name.strip()] = value.replace("!important", "").strip()
    return says.get("display") == "none" or says.get("visibility") == "hidden"


def _read(new: Node, attrs: str) -> None:
    """Sets ``drop`` of an element that never holds main text, and the words of its class and id that mark noise."""
    tag = new.tag
    if tag in _DROPPED or tag == "header" and not new.inner:  # a header of the page, not the head of an article
        new.drop = True
        return
    if tag == "form":
        new.noise = _FORM
    if not attrs or attrs == "/":
        return
    for name, a, b, c in _ATTR.findall(attrs):
        given = a or b or c
        value = given.lower()
        name = name.lower()
        if tag not in ("html", "body") and (name == "hidden" or name == "style" and _unseen(value)):
            new.drop = True
        elif name == "role" and value in _ROLES or name == "aria-hidden" and value == "true":
            new.drop = True
        elif name == "aria-label" and tag not in ("html", "body", "article", "main") and not _AD_LABELS.isdisjoint(value.split()):
            new.drop = True
        elif name in ("class", "id"):
            found = re.split(r"[\s_\-:]+", value)
            if tag == "article" and not {"comment", "comments", "reply", "ad", "advert", "promo"}.isdisjoint(found):
                new.drop = True
            elif tag not in ("html", "body", "article", "main"):
                for one in given.split():
                    low = one.lower()
                    names = {_NAMES.get(low, low), *re.split(r"[_\-:]+", low), *map(str.lower, _WORDS.findall(one))}
                    if _STATE.isdisjoint(names):
                        new.noise |= names & _NOISE


def parse(html: str) -> Node:
    """Element tree of a page, in linear time; unclosed and stray tags are tolerated, character references are decoded."""
    root = Node("#root", None, False)
    opened = _Open(root)
    foreign: Node | None = None  # the outermost open svg or math
    tokens = _STRICT
    end = 0
    while end < len(html):
        m = tokens[foreign is not None].match(html, end)
        text = m["text"]
        if text == "<" and tokens is _STRICT and (after := html[end + 1 : end + 2]).isalpha() and after.isascii():
            tokens = _LOOSE
            continue
        end = m.end()
        at = opened.at
        if text is not None:
            if text == "<" and tokens is _LOOSE and html.find(">", end) < 0:  # no further tag
                text, end = html[end - 1 :], len(html)
            if not at.drop:
                at.children.append(unescape(text) if "&" in text else text)
            continue
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if m["close"]:
            node = opened.last(tag)
            if node is not None:
                opened.close(node)
                if foreign and opened.at.depth < foreign.depth:
                    foreign = None
            continue
        if foreign and tag in _ENDS_FOREIGN:
            if all(again is None or again.depth <= foreign.depth for again in map(opened.last, _HTML_AGAIN)):
                opened.close(foreign)
                foreign = None
        if foreign:
            pass
        elif tag in _BLOCK_ENDS_P:
            node = opened.last("#block")
            if node is not None and node.tag == "p":
                opened.close(node)
        elif tag in _GROUPS:
            node, scope = opened.last(_GROUPS[tag]), opened.last("#scope")
            if node is not None and (scope is None or node.depth > scope.depth):
                opened.close(node)
        at = opened.at
        new = Node(tag, at, at.drop)
        if not new.drop:
            _read(new, m["attrs"])
        if not new.drop:
            at.children.append(new)
        if tag not in _VOID and not m["attrs"].endswith("/"):
            opened.push(new)
            if tag in _FOREIGN and not foreign:
                foreign = new
    return root


def _length(text: str) -> int:
    return len(" ".join(text.split()))


def _score(root: Node) -> list[Node]:
    """Sets sizes and link sizes bottom-up, passes points up; the nodes in page order."""
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        node.points, node.own, node.size, node.links = 0.0, 0.0, 0, 0
        todo.extend(x for x in reversed(node.children) if isinstance(x, Node))
    for node in reversed(order):
        own = sum(_length(x) for x in node.children if isinstance(x, str))
        node.size += own
        if node.tag == "a":
            node.links = node.size
        if node.parent is not None:
            node.parent.size += node.size
            node.parent.links += node.links
    for node in order:
        direct = [x for x in node.children if isinstance(x, str) and not x.isspace()]
        if not node.size or not (node.tag in _SCORED or direct and node.tag not in _INLINE and node.parent is not None):
            continue
        commas = sum(x.count(",") + x.count("،") + x.count("，") for x in direct)
        points = (1 + commas + min(node.size / 100, 3)) * (1 - node.links / node.size)
        node.own = points
        for share, ancestor in ((1.0, node.parent), (0.5, node.parent.parent if node.parent else None)):
            if ancestor is not None:
                ancestor.points += points * share
        if node.tag not in _SCORED:
            node.points += points
    return order


def _cut_noise(order: list[Node]) -> bool:
    """Takes marked subtrees out of a scored tree; whether any went.

    One stays if it is a wrapper around the text: it holds a ``main``, the ``article`` with the most points, or half of
    the points around it without reader comments (nine tenths, if the article is beside it). Comments can outweigh a
    short article, so what such a word marks stays only if nearly no other text is there, and only the first. Headers in an article stay. So does what has weak words
    only, if few of its words are links and it is a paragraph, a heading or holds much (WEAK_SHARE) of the points around it.
    """
    root = order[0]
    held = {id(n): n.own for n in order}
    for node in reversed(order):
        if node.parent is not None:
            held[id(node.parent)] += held[id(node)]
    top = max((n for n in order if n.tag == "article" and n.size), key=lambda n: held[id(n)], default=None)
    wrappers: set[int] = set()
    has_article = False
    for node in order:
        if node is top or node.tag == "main" and node.size:
            has_article = True
            at: Node | None = node
            while at is not None and id(at) not in wrappers:
                wrappers.add(id(at))
                at = at.parent
    scope = {id(root): root}  # the nearest marked ancestor
    marked, plain, comments = [], {id(root): held[id(root)]}, {id(root): 0.0}
    for node in order[1:]:
        parent = node.parent
        around = scope[id(node)] = parent if parent.noise else scope[id(parent)]
        if node.noise:
            marked.append(node)
            plain[id(node)], comments[id(node)] = held[id(node)], 0.0
            plain[id(around)] -= held[id(node)]
            if node.noise & _COMMENTS and id(node) not in wrappers:
                comments[id(around)] += held[id(node)]
    for node in marked:
        around = id(scope[id(node)])
        share = 0.9 if has_article and not node.inner else 0.5
        little = node.noise & _COMMENTS or node.noise == _FORM and held[id(node)] < FORM_POINTS
        if id(node) in wrappers or not little and held[id(node)] and held[id(node)] >= share * (held[around] - comments[around]):
            wrappers.add(id(node))
            plain[around] += held[id(node)]
    for node in marked:
        around = id(scope[id(node)])
        if node.noise & _COMMENTS and id(node) not in wrappers and held[id(node)] and 20 * plain[around] < held[id(node)]:
            wrappers.add(id(node))
            plain[around] += held[id(node)]
    gone: set[int] = set()
    for node in marked:
        if id(node) in wrappers or node.noise <= _HEADER and node.inner:
            continue
        if node.noise <= _WEAK_NOISE and node.links <= LOW_LINKS * node.size and (node.tag == "p" or node.tag in _HEADINGS or held[id(node)] and held[id(node)] >= WEAK_SHARE * held[id(scope[id(node)])]):
            continue
        gone.add(id(node))
    for parent in {id(n.parent): n.parent for n in marked if id(n) in gone}.values():
        parent.children = [x for x in parent.children if id(x) not in gone]
    return bool(gone)


def _collect(node: Node, out: list[str]) -> None:
    todo: list[Node | str] = [node]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            out.append(x)
            continue
        if x.tag not in _INLINE:
            out.append(" ")
            todo.append(" ")
        todo.extend(reversed(x.children))


def _collect_run(run: list[Node | str], out: list[str]) -> None:
    size = sum(x.size if isinstance(x, Node) else _length(x) for x in run)
    if sum(x.links for x in run if isinstance(x, Node)) <= MOSTLY_LINKS * size:
        for x in run:
            if isinstance(x, Node):
                _collect(x, out)
            else:
                out.append(x)


def _collect_around(best: Node, out: list[str]) -> None:
    """The text of ``best`` and of what lies beside it and is neither marked as noise nor mostly links.

    Runs of strings and inline elements count as one. It goes on beside the parent while what lies around ``best`` is
    mostly text, up to the body.
    """
    before: list[list[str]] = []
    after: list[list[str]] = []
    node, parent = best, best.parent
    while parent is not None:
        sides: tuple[list[str], list[str]] = ([" "], [" "])
        side = 0
        run: list[Node | str] = []
        for x in parent.children:
            if isinstance(x, str) or x is not node and x.tag in _INLINE and not x.noise:
                run.append(x)
                continue
            _collect_run(run, sides[side])
            run = []
            if x is node:
                side = 1
            elif x.size and not x.noise and x.links <= MOSTLY_LINKS * x.size:
                _collect(x, sides[side])
        _collect_run(run, sides[side])
        before.append(sides[0])
        after.append(sides[1])
        if parent.tag in ("body", "html") or parent.links - node.links > MOSTLY_LINKS * (parent.size - node.size):
            break
        node, parent = parent, parent.parent
    for part in reversed(before):
        out.extend(part)
    _collect(best, out)
    for part in after:
        out.extend(part)


def main_text(html: str | None) -> str:
    """The main text: the best container and what belongs to it beside it, blocks joined by one space.

    A null or empty page, and one without main text, gives an empty text. The container grows to the ``article`` or
    ``main`` element around it, so that headings and short paragraphs of the article are kept; without one, the text
    around the container is kept, but for noise and links.
    """
    if not html:
        return ""
    root = parse(html)
    order = _score(root)
    if any(n.noise for n in order) and _cut_noise(order):
        order = _score(root)
    best = max(order, key=lambda n: n.points * (1 - n.links / n.size) if n.size else 0.0)
    if not best.size:
        best = root
    if best.points <= 0:
        best = next((n for n in order if n.tag in ("article", "main", "body") and n.size), root)
    around, node = best, best
    while node is not None:
        if node.tag in ("article", "main"):
            around = node
        node = node.parent
    best = around
    out: list[str] = []
    parent = best.parent
    if parent is None or best.tag in ("article", "main") and not any(isinstance(x, Node) and x is not best and x.tag == "article" for x in parent.children):
        _collect(best, out)
    elif best.tag in ("article", "main"):
        least = max(10.0, 0.2 * best.points)
        for x in parent.children:
            if x is best:
                _collect(best, out)
            elif isinstance(x, Node) and x.size:
                density = x.links / x.size
                alike = x.tag == best.tag == "article"
                if alike or x.points * (1 - density) >= least or x.tag in ("p", "h1", "h2") and density < LOW_LINKS and (x.size > 80 or x.tag != "p"):
                    _collect(x, out)
    else:
        _collect_around(best, out)
    return " ".join("".join(out).split())


EXTRACTED = StructType([StructField("page_id", LongType()), StructField("url", StringType()), StructField("text", StringType()), StructField("n_chars", LongType())])


def extract_pages(pages: DataFrame) -> DataFrame:
    """Main text of every row of ``pages`` (page_id, url, html): page_id, url, text, n_chars (code points).

    A null html counts as empty and gives an empty text; a null page_id or url stays null; very long pages are read
    whole, in linear time; of containers with equally many points the first in the page counts; repeated rows give
    repeated rows; other columns are ignored; an empty table gives no rows. One pass without shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                texts = [main_text(x) for x in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], EXTRACTED.names)

    return pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url"), pages["html"]).mapInArrow(run, EXTRACTED)
