"""Main text of web pages by tree scoring.

Every block of text passes points for its length and its commas to the containers above it, all
to the nearest, half to the next, less to those beyond; points are discounted by the share of the
block's text that is in links. The container with the most points, discounted by its own links,
and those of its siblings that look like text too are kept; of these, every block is returned.
Of the article or main element around that container, all other blocks are kept too, unless
links are most of the block or of its list.
Elements that are no part of an article by their kind or name are cut off before; a name alone
does not cut what holds the article itself (see ``_cut_named``).
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import picked

# --- fixed values: HTML's elements by kind, and names of what is no article -----------------

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe title textarea xmp noembed noframes".split())
BLOCKS = frozenset(
    """address article aside blockquote body caption center dd details dialog dir div dl dt
    fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu
    nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul""".split()
)
DROPPED = frozenset(
    """nav footer aside form button select menu dialog svg object canvas audio video map
    head input datalist annotation annotation-xml""".split()
)
# An opening tag closes an open element of these, unless an element of the last set is between.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select", "optgroup", "datalist"}),
}
NAMES = frozenset(
    """ad ads adbox adslot advert adverts advertisement advertising banner sponsor sponsored
    promo promotion sidebar menu nav navbar navigation breadcrumb breadcrumbs footer header
    masthead cookie cookies consent gdpr notice notices notification alert popup modal overlay
    newsletter subscribe subscription share sharing social comment comments discussion replies
    disqus related recommended recommendations widget widgets toolbar pagination pager login
    signup search skip""".split()
)
# Words that say nothing about what an element holds, and words before the name of another one.
GENERAL = frozenset(
    """area article articles bar block body bottom box btn button buttons card column container
    content entry first form global group icon icons inner item items last left link links list
    main module outer page panel post posts primary right row secondary section site slot stories
    story text title top unit wrap wrapper""".split()
)
BESIDE = frozenset("with has no without".split())
IN_ARTICLES = frozenset("header masthead".split())
ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split()
)
CONTAINERS = frozenset("div section ul ol dl table td p span header figure center".split())

# --------------------------------------------------------------------------------------------

_TOKEN = re.compile(
    r"</?\Z|<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</([a-zA-Z][^\s/>]*)[^>]*(>|\Z)"
    r"|<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(>|[\"'].*\Z|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_PARTS = re.compile(r"[a-z]+")
# Elements that hold a block and pass its points on, and the shares of the containers above.
LEAVES = frozenset("p pre td blockquote h1 h2 h3 h4 h5 h6 li dt dd th figcaption".split())
SHARES = (1, 1 / 2, 1 / 6, 1 / 9, 1 / 12)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PARAGRAPHS = frozenset("p pre blockquote".split())
# Blocks and lists of an article with a larger share of their text in links are no text.
MOST_LINKED = 0.5
# A sibling is kept from so many points, absolute and of the best, or characters of plain text.
SIBLING_LEAST, SIBLING_SHARE, SIBLING_CHARS = 10.0, 0.2, 80


@dataclass(eq=False)
class Node:
    tag: str
    parent: Node | None
    dropped: bool = False
    children: list = field(default_factory=list)
    score: float = 0.0
    chars: int = 0
    linked: int = 0
    kept: bool = False
    scoped: bool = False
    # Words of a name by which the element may be cut, and whether an article is around it.
    names: frozenset = frozenset()
    inside: bool = False

    @property
    def points(self) -> float:
        return self.score * (1 - self.density)

    @property
    def density(self) -> float:
        return self.linked / self.chars if self.chars else 0.0


def _attributes(raw: str) -> dict[str, str]:
    if not raw.strip(" /"):
        return {}
    return {
        m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "").lower()
        for m in _ATTRIBUTE.finditer(raw)
    }


def _unwanted(tag: str, found: dict[str, str], in_article: bool) -> bool:
    if tag in DROPPED:
        return True
    if tag == "header" and not in_article:
        return True
    if "hidden" in found or found.get("aria-hidden") == "true":
        return True
    if "display:none" in found.get("style", "").replace(" ", ""):
        return True
    return tag in CONTAINERS and found.get("role") in ROLES


def _names(tag: str, found: dict[str, str], in_article: bool) -> frozenset[str]:
    """The words of class and id if one of them may name what is no article, else none."""
    if tag not in CONTAINERS:
        return frozenset()
    words: set[str] = set()
    for name in f"{found.get('class', '')} {found.get('id', '')}".split():
        parts = _PARTS.findall(name)
        if parts and parts[0] not in BESIDE:
            words.update(parts)
    unwanted = NAMES - IN_ARTICLES if in_article else NAMES
    return frozenset() if unwanted.isdisjoint(words) else frozenset(words)


class _Builder:
    """The tree of a page while it is read, with its open elements."""

    def __init__(self):
        root = Node("html", None)
        self.nodes, self.stack, self.open = [root], [root], Counter()

    def add(self, tag: str, raw: str) -> None:
        if tag in CLOSES:
            self.close(*CLOSES[tag])
        if tag in BLOCKS:
            self.close({"p"}, {"table", "td", "th", "object"})
        above = self.stack[-1]
        in_article = bool(self.open["article"] or self.open["main"])
        found = _attributes(raw)
        node = Node(tag, above, _unwanted(tag, found, in_article), inside=in_article)
        if not node.dropped:
            node.names = _names(tag, found, in_article)
        above.children.append(node)
        self.nodes.append(node)
        if tag not in VOID:
            self.stack.append(node)
            self.open[tag] += 1

    def close(self, tags: set[str], barrier: set[str] = frozenset()) -> None:
        """Close the innermost open element of ``tags`` and all in it, if one is open."""
        if not any(self.open[tag] for tag in tags):
            return
        for depth in range(len(self.stack) - 1, 0, -1):
            if self.stack[depth].tag in tags:
                for node in self.stack[depth:]:
                    self.open[node.tag] -= 1
                del self.stack[depth:]
                return
            if self.stack[depth].tag in barrier:
                return


def parse(page: str) -> list[Node]:
    """The tree of a page, however badly nested or cut short: its elements in page order."""
    built = _Builder()
    position, end = 0, len(page)
    while position < end:
        token = _TOKEN.search(page, position)
        text = page[position : token.start() if token else end]
        if text:
            built.stack[-1].children.append(html.unescape(text))
        if token is None:
            break
        position = token.end()
        closing, _, opening, raw, closed = token.groups()
        if closing:
            built.close({closing.lower()})
        elif opening and closed == ">":  # a tag that the end of the page cuts off is none
            tag = opening.lower()
            if tag in RAW:
                rest = re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, position)
                position = rest.end() if rest else end
            else:
                built.add(tag, raw)
    return built.nodes


def _walk(root: Node):
    """The tree in page order without recursion: (node or text, node above, leaving)."""
    stack: list = [(root, None, False)]
    while stack:
        item, above, leaving = stack.pop()
        yield item, above, leaving
        if isinstance(item, Node) and not leaving and not item.dropped:
            stack.append((item, above, True))
            stack.extend((child, item, False) for child in reversed(item.children))


def _blocks(root: Node) -> list[tuple[str, int, Node]]:
    """Blocks of text below ``root``: text, characters in links, element that holds it."""
    found: list[tuple[str, int, Node]] = []
    parts: list[str] = []
    holder, links, linked = root, 0, 0

    def close() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            found.append((text, min(linked, len(text)), holder))
        parts.clear()
        linked = 0

    for item, above, leaving in _walk(root):
        if isinstance(item, str):
            if not parts or not "".join(parts).strip():
                holder = above
                while holder.tag not in BLOCKS and holder.parent is not None:
                    holder = holder.parent
            parts.append(item)
            if links:
                linked += len(" ".join(item.split()))
            continue
        if item.tag in BLOCKS:
            close()
        elif item.tag == "br" or item.dropped:
            parts.append(" ")
        elif item.tag == "a":
            links += -1 if leaving else 1
    close()
    return found


def _scope(nodes: list[Node], best: Node) -> Node | None:
    """The article around ``best``, or the main element if it has no other article; or None."""
    above = [best]
    while above[-1].parent is not None:
        above.append(above[-1].parent)
    articles = [n for n in above if n.tag == "article"]
    mains = [n for n in above if n.tag == "main"]
    if not articles or not mains:
        return (articles or mains or [None])[-1]
    inside, others = {mains[-1]}, 0
    for node in nodes:
        if node.parent in inside and not node.dropped:
            if node.tag == "article":
                others += node is not articles[-1] and bool(node.chars)
            else:
                inside.add(node)
    return articles[-1] if others else mains[-1]


def _is_prose(text: str, linked: int, holder: Node) -> bool:
    """Whether a block of the article counts as its text by the links in it and in its list."""
    if holder.tag == "h1":
        return True
    if linked > MOST_LINKED * len(text):
        return False
    listed = holder.tag in ("li", "dt", "dd", "td", "th") and holder.parent is not None
    return not listed or holder.parent.density <= MOST_LINKED


def _cut_named(nodes: list[Node]) -> bool:
    """Drop elements by their names, and tell whether any is; never what holds the article.

    That is the article or main element with most text, of those outside such names if there
    are some. Without one it is what holds most paragraph text, unless all words of the name
    are unwanted. Inside an article a name with further words of its own ("share-prices")
    does not cut text that is not links, and no name cuts the only h1 of the page.
    """
    if not any(node.names for node in nodes):
        return False
    size = {node: [0, 0, 0, 0] for node in nodes}  # Plain text, linked text, paragraphs, h1.
    named = {nodes[0]: False}
    for node in nodes[1:]:
        named[node] = named[node.parent] or bool(node.names) or node.dropped
    for node in reversed(nodes):
        own = size[node]
        if node.dropped:
            size[node] = own = [0, 0, 0, 0]
        else:
            own[0] += sum(len(" ".join(c.split())) for c in node.children if isinstance(c, str))
            if node.tag == "a":
                own[0], own[1] = 0, own[0] + own[1]
            if node.tag in PARAGRAPHS:
                own[2] = own[0]
            own[3] += node.tag == "h1"
        if node.parent is not None:
            size[node.parent] = [a + b for a, b in zip(size[node.parent], own)]
    articles = [n for n in nodes if n.tag in ("article", "main") and size[n][0]]
    holders, node = set(), max(articles, key=lambda n: (not named[n], size[n][0]), default=None)
    while node is not None:
        holders.add(node)
        node = node.parent
    all_text = size[nodes[0]]
    measure = 2 if all_text[2] else 0
    any_cut = False
    for node in nodes[1:]:
        if not node.names or node in holders:
            continue
        plain, linked, paragraphs, titles = size[node]
        own_words = node.names - NAMES
        keep = False
        if own_words - GENERAL or own_words and (node.inside or not articles):
            keep = 2 * size[node][measure] > all_text[measure]
        if node.inside:
            text = plain > 3 * linked and (paragraphs > 0 or node.tag == "p")
            keep = keep or bool(own_words - GENERAL) and text
            keep = keep or titles > 0 and titles == all_text[3] == 1
        if not keep:
            node.dropped = any_cut = True
    return any_cut


def main_text(page: str | None) -> str:
    """The blocks of a page's article, joined by empty lines; empty if there is none.

    Where names leave no text at all, nothing is cut by names.
    """
    nodes = parse(page or "")
    any_cut = _cut_named(nodes)
    return _best_text(nodes) or (_best_text(parse(page)) if any_cut else "")


def _best_text(nodes: list[Node]) -> str:
    blocks = _blocks(nodes[0])
    for text, linked, holder in blocks:
        holder.chars += len(text)
        holder.linked += linked
        points = 1 + text.count(",") + min(len(text) / 100, 3)
        points *= 1 - linked / len(text)
        node = holder.parent if holder.tag in LEAVES and holder.parent else holder
        for share in SHARES:
            node.score += points * share
            node = node.parent
            if node is None:
                break
    for node in reversed(nodes[1:]):  # what an element holds counts for all around it
        node.parent.chars += node.chars
        node.parent.linked += node.linked
    best = max(nodes, key=lambda n: n.points)
    if not best.points:
        return ""
    best.kept = True
    scope = _scope(nodes, best)
    least = max(SIBLING_LEAST, best.points * SIBLING_SHARE)
    for other in best.parent.children if best.parent else ():
        if isinstance(other, Node) and not other.dropped:
            like_text = other.tag in LEAVES and other.chars > SIBLING_CHARS and other.density < 0.25
            beside = HEADINGS | PARAGRAPHS if scope is None else {"h1"}
            plain = other.tag in beside and bool(other.chars) and not other.linked
            other.kept = other.kept or other.points >= least or like_text or plain
    if scope is not None:
        scope.scoped = True
    for node in nodes[1:]:
        node.kept = node.kept or node.parent.kept
        node.scoped = node.scoped or node.parent.scoped
    return "\n\n".join(
        text
        for text, linked, holder in blocks
        if holder.kept or holder.scoped and _is_prose(text, linked, holder)
    )


@F.pandas_udf(T.StringType())
def _texts(pages: pd.Series) -> pd.Series:
    return pages.map(main_text, na_action=None).astype(object)


def page_texts(
    pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html"
) -> DataFrame:
    """One row per row of ``pages``: ``key``, ``url``, text, n_chars.

    Character references are decoded, white space inside a block is one space, blocks are joined
    by an empty line. NULL, empty and text-free pages have an empty text; pages may be cut off
    anywhere; repeated rows are done one by one.
    """
    rows = picked(pages, _key=key, _url=url, _page=page)
    done = rows.select("_key", "_url", _texts("_page").alias("text"))
    return done.select(
        F.col("_key").alias(key), F.col("_url").alias(url), "text", F.length("text").cast("long").alias("n_chars")
    )
