"""Main text of a page by composite text density.

A page becomes a tree of elements. Every node gets its characters per tag,
adjusted by its share of link characters and link tags and by that of the body
(the composite text density), and the sum of the densities of its children. The
node with the largest sum carries the article; the least density on its path to
the body is the threshold from which other nodes count as content too, each
with the maximum-sum node of its own subtree. Of the article or main element
around the maximum-sum node, or the outermost element below the body that holds
only text beside it, the whole rest is kept too, however sparse.

Elements that are no running text by their name or role (menus, page headers,
footers, forms, scripts, styles) are left out before densities are counted, and
lists that are mostly links after, if they are outside articles. A word in a
class or id (sidebars, adverts, notices, reader comments) leaves an element out
if an article element stands beside it, if it is mostly links, or if it holds no
more than DOUBT times the text found outside such elements (for comments:
COMMENT_DOUBT); else it is taken for the page's own text.

Defined results: a null page is empty and has an empty text, null ids and URLs
are carried, repeated rows give a row each, broken markup is read as far as it
goes (an unclosed element ends with its parent), other columns are not read, an
empty table gives no rows.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glotta.llm.common import map_batches, table

TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*)")
STOP = re.compile(r"""[>"']""")
#: One attribute: its whole name, and its value in any of the three ways to write one.
ATTRIBUTE = re.compile(r"""([^\s"'>/=]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?+|"[^"]*+"|'[^']*+'""")
SPACE = re.compile(r"\s+")
NOT_WORD = re.compile(r"[\W_]+")

# How elements behave in HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript iframe template xmp noframes noembed svg math select object".split())
BLOCK = set("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption "
            "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary "
            "table tbody tfoot thead tr ul".split())
ENDS_PARAGRAPH = BLOCK - {"caption", "tbody", "tfoot", "thead", "tr", "body", "html"}
INLINE = set("a abbr b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark q ruby s samp small "
             "span strike strong sub sup time tt u var wbr".split())
SPACED = {"br", "td", "th", "wbr"}
#: A start tag ends open elements of these names, up to one of the others.
IMPLIED = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
           "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
           "tbody": ({"tbody", "thead", "tfoot"}, {"table"}), "thead": ({"tbody", "thead", "tfoot"}, {"table"}),
           "tfoot": ({"tbody", "thead", "tfoot"}, {"table"}), "body": ({"head"}, {"html"})}
CLOSED_TO = {"table", "article", "section", "div", "main", "aside", "td", "th", "li", "blockquote", "body", "button"}

# What is no running text.
DROPPED = set("nav footer aside form button dialog menu head".split())
ROLES = set("navigation banner contentinfo complementary search form menu menubar toolbar alert dialog".split())
WORDS = set("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar menu "
            "nav navbar navigation navi breadcrumb breadcrumbs footer header masthead cookie cookies consent gdpr "
            "notice notices notification popup modal overlay newsletter subscribe subscription signup share sharing "
            "social related recommended recommendations comment comments disqus respond replies login search widget "
            "widgets copyright skip toolbar pagination pager toc".split())
COMMENTS = set("comment comments disqus respond replies".split())
STATES = set("no not has have with without is".split())  # `no-sidebar` tells how a page is laid out, not what an element is
KEPT = {"html", "body", "article", "main"}
LINK_SHARE = 0.6
#: A class or id word drops an element unless it has more than that many times the text found outside such elements.
DOUBT, COMMENT_DOUBT = 4, 10
LINKED = {"ul", "ol", "dl", "table", "div", "section"}


class Page:
    """The tree of a page in page order: parents come before their children."""

    def __init__(self, source: str):
        self.name, self.parent, self.dropped, self.in_article = ["#page"], [-1], [False], [False]
        self.pieces: list[tuple[int, int, str]] = []  # node, block, text
        self._stack, self._block = [0], 0
        self._open: Counter[str] = Counter()  # names on the stack
        self._unclosed: set[int] = set()  # quotes from which no tag ends
        self._doubts: dict[int, int] = {}  # nodes that a class or id word speaks against
        self._read(source)
        if self._doubts:
            self._settle()

    def _tag_end(self, source: str, at: int) -> int:
        """Where the ``>`` stands that ends a tag, past quoted values; -1 if none does.

        Quotes that led nowhere are remembered, so that all tags of a page together take linear time.
        """
        passed = []
        while found := STOP.search(source, at):
            quote = found.start()
            if source[quote] == ">":
                return quote
            if quote in self._unclosed:
                break
            passed.append(quote)
            end = source.find(source[quote], quote + 1)
            if end < 0:
                break
            at = end + 1
        self._unclosed.update(passed)
        return -1

    def _text(self, text: str) -> None:
        if text:
            self.pieces.append((self._stack[-1], self._block, html.unescape(text) if "&" in text else text))

    def _read(self, source: str) -> None:
        at, text_from, lowered = 0, 0, None
        while (at := source.find("<", at)) >= 0:
            if source.startswith(("<!", "<?"), at):
                self._text(source[text_from:at])
                mark = "-->" if source.startswith("<!--", at) else ">"
                end = source.find(mark, at + (4 if mark == "-->" else 2))
                at = text_from = len(source) if end < 0 else end + len(mark)
                continue
            found = TAG.match(source, at)
            if not found:
                at += 1
                continue
            tag_end = self._tag_end(source, found.end())
            if tag_end < 0:
                # No tag that starts before the next quote ends either.
                stop = STOP.search(source, found.end())
                at = stop.start() if stop else len(source)
                continue
            self._text(source[text_from:at])
            name, at = found[2].lower(), tag_end + 1
            if found[1]:
                self._end(name)
            elif name in RAW:
                lowered = source.lower() if lowered is None else lowered
                lowered = lowered if len(lowered) == len(source) else source
                end = lowered.find(f"</{name}", at)
                at = len(source) if end < 0 else end
                if end >= 0 and (close := self._tag_end(source, end)) >= 0:
                    at = close + 1
            else:
                self._start(name, source[found.end():tag_end])
            text_from = at
        self._text(source[text_from:])

    def _pop_to(self, depth: int) -> None:
        if any(self.name[n] in BLOCK for n in self._stack[depth:]):
            self._block += 1
        self._open.subtract(self.name[n] for n in self._stack[depth:])
        del self._stack[depth:]

    def _start(self, name: str, attributes: str) -> None:
        if name in ENDS_PARAGRAPH:
            self._close({"p"}, CLOSED_TO)
        if name in IMPLIED:
            self._close(*IMPLIED[name])
        if name in BLOCK:
            self._block += 1
        top = self._stack[-1]
        if name in SPACED:
            self.pieces.append((top, self._block, " "))
        self.name.append(name)
        self.parent.append(top)
        doubt = self._doubt(name, attributes, self.in_article[top])
        self.dropped.append(self.dropped[top] or doubt < 0)
        if doubt > 0:
            self._doubts[len(self.name) - 1] = doubt
        self.in_article.append(self.in_article[top] or name in ("article", "main"))
        if name not in VOID and not attributes.endswith("/"):
            self._stack.append(len(self.name) - 1)
            self._open[name] += 1
        elif name in BLOCK:
            self._block += 1

    def _close(self, names: set[str], until: set[str]) -> None:
        if not any(self._open[name] for name in names):
            return
        for depth in range(len(self._stack) - 1, 0, -1):
            name = self.name[self._stack[depth]]
            if name in names:
                self._pop_to(depth)
                return
            if name in until:
                return

    def _end(self, name: str) -> None:
        if not self._open[name]:
            return
        for depth in range(len(self._stack) - 1, 0, -1):
            if self.name[self._stack[depth]] == name:
                self._pop_to(depth)
                return

    @staticmethod
    def _doubt(name: str, attributes: str, inside: bool) -> int:
        """-1: no running text by its name, role or being hidden; else what its class and id words demand, 0 if nothing."""
        if name in DROPPED:
            return -1
        if name == "header":
            return 0 if inside else -1
        if not attributes or name in KEPT:
            return 0
        words: set[str] = set()
        for key, *values in ATTRIBUTE.findall(attributes):
            key, value = key.lower(), "".join(values).lower()
            if key == "hidden" and value != "until-found" or key == "role" and value.strip() in ROLES:
                return -1
            if key in ("class", "id"):
                for label in value.split():
                    parts = [x for x in NOT_WORD.split(label) if x]
                    if parts and parts[0] not in STATES:
                        words.update(parts)
        if inside and name in ("h1", "h2", "h3", "hgroup", "div", "header"):
            words.discard("header")
        if words & COMMENTS:
            return COMMENT_DOUBT
        return DOUBT if words & WORDS else 0

    def _settle(self) -> None:
        """Drop the elements in doubt, but for those that hold most of the page's text and few links."""
        n = len(self.name)
        chars, links, in_link = [0] * n, [0] * n, [False] * n
        for i in range(1, n):
            in_link[i] = in_link[self.parent[i]] or self.name[i] == "a"
        for node, _, text in self.pieces:
            if not self.dropped[node]:
                size = len(SPACE.sub(" ", text).strip())
                chars[node] += size
                links[node] += size * in_link[node]
        # Of each element all text, and what is outside further elements in doubt; at the root, outside all of them.
        free = list(chars)
        for i in range(n - 1, 0, -1):
            p = self.parent[i]
            chars[p] += chars[i]
            links[p] += links[i]
            if i not in self._doubts:
                free[p] += free[i]
        beside, in_doubt, named = [free[0]] * n, [False] * n, False
        for i in range(1, n):
            p = self.parent[i]
            in_doubt[i] = in_doubt[p] or i in self._doubts
            named = named or self.name[i] in ("article", "main") and free[i] > 0 and not in_doubt[i] and not self.dropped[i]
        for i in range(1, n):
            p = self.parent[i]
            self.dropped[i] = self.dropped[i] or self.dropped[p]
            beside[i] = beside[p]
            if i in self._doubts and not self.dropped[i]:
                # Beside an article element there is no need to look for one here.
                self.dropped[i] = (named and not self.in_article[p] or chars[i] <= self._doubts[i] * beside[p]
                                   or 2 * links[i] > chars[i])
                beside[i] += free[i]


def densities(page: Page) -> tuple[list[float], list[float], list[int], list[int]]:
    """Composite density, sum over children, characters and link characters of every node.

    Inline elements belong to the run of text they stand in; such a run, where a
    block has one, counts as a child of the block.
    """
    n = len(page.name)
    # Two sets of counts: of the subtree, and of the block's own run of text.
    chars, link_chars, tags, link_tags = ([0] * n for _ in range(4))
    own_chars, own_link_chars, own_tags, own_link_tags = ([0] * n for _ in range(4))
    in_link, block = [False] * n, [0] * n
    for i in range(1, n):
        p, name = page.parent[i], page.name[i]
        in_link[i] = in_link[p] or name == "a"
        block[i] = block[p] if name in INLINE else i
        if name in INLINE and not page.dropped[i]:
            own_tags[block[i]] += 1
            own_link_tags[block[i]] += name == "a"
    for node, _, text in page.pieces:
        if not page.dropped[node]:
            size = len(SPACE.sub(" ", text).strip())
            chars[node] += size
            link_chars[node] += size * in_link[node]
            own_chars[block[node]] += size
            own_link_chars[block[node]] += size * in_link[node]
    for i in range(n - 1, 0, -1):
        if not page.dropped[i]:
            p = page.parent[i]
            chars[p] += chars[i]
            link_chars[p] += link_chars[i]
            tags[p] += tags[i] + 1
            link_tags[p] += link_tags[i] + (page.name[i] == "a")
    body = page.name.index("body") if "body" in page.name else 0
    body_share = link_chars[body] / max(1, chars[body])

    def composite(c: int, lc: int, t: int, lt: int) -> float:
        if not c:
            return 0.0
        base = math.log(c / max(1, c - lc) * max(1, lc) + body_share * c + math.e)
        t = max(1, t)
        return c / t * max(0.0, math.log(c / max(1, lc) * t / max(1, lt)) / math.log(base))

    density, total = [0.0] * n, [0.0] * n
    for i in range(n - 1, -1, -1):
        if page.dropped[i] or block[i] != i:
            continue
        density[i] = composite(chars[i], link_chars[i], tags[i], link_tags[i])
        total[i] += composite(own_chars[i], own_link_chars[i], own_tags[i], own_link_tags[i])
        if i:
            total[block[page.parent[i]]] += density[i]
    return density, total, chars, link_chars


def _whole(page: Page, chosen: int, body: int, chars: list[int], link_chars: list[int]) -> list[int]:
    """The nodes whose subtrees are the article that the chosen node is a part of.

    Its outermost article or main element; without one, the outermost ancestor
    below the body that holds nothing but text beside the path to it (lists of
    links are dropped anyway). Of the body's other children its main headings
    count, and further sections beside a section.
    """
    path = [chosen]
    while chosen > body and page.parent[path[-1]] > body:
        path.append(page.parent[path[-1]])
    if chosen <= body:
        return [chosen]
    named = [i for i in path if page.name[i] in ("article", "main")]
    if named:
        return [named[-1]]
    children: dict[int, list[int]] = {i: [] for i in path}
    beside = []
    for i in range(body + 1, len(page.name)):
        if chars[i] and not page.dropped[i]:
            if page.parent[i] in children:
                children[page.parent[i]].append(i)
            elif page.parent[i] == body:
                beside.append(i)

    def text(i: int) -> bool:
        return page.name[i] in LINKED or page.name[i] in INLINE or link_chars[i] <= LINK_SHARE * chars[i]

    top = 0
    while top + 1 < len(path) and all(text(i) for i in children[path[top + 1]]):
        top += 1
    if top + 1 < len(path):
        return [path[top]]
    wanted = {"h1", "hgroup"} | ({"section"} if page.name[path[top]] == "section" else set())
    return [path[top], *(i for i in beside if page.name[i] in wanted)]


def content_nodes(page: Page) -> list[bool]:
    """Which nodes belong to the main text."""
    density, total, chars, link_chars = densities(page)
    n = len(page.name)
    # The maximum-sum node of each subtree; of equal sums the outermost.
    best = list(range(n))
    for i in range(n - 1, 0, -1):
        p = page.parent[i]
        if not page.dropped[i] and total[best[i]] > total[best[p]]:
            best[p] = best[i]
    body = page.name.index("body") if "body" in page.name else 0
    chosen = best[body]
    threshold, node = density[chosen] or density[body], chosen
    while node >= 0 and node >= body:
        if density[node]:
            threshold = min(threshold, density[node])
        node = page.parent[node]
    inside = [False] * n
    for node in _whole(page, chosen, body, chars, link_chars):
        inside[node] = True
    for i in range(n):
        if not page.dropped[i] and chars[i] and density[i] >= threshold and i >= body:
            inside[best[i]] = True
    for i in range(1, n):
        p = page.parent[i]
        linked = not page.in_article[i] and page.name[i] in LINKED and link_chars[i] > LINK_SHARE * chars[i]
        inside[i] = (inside[i] or inside[p]) and not page.dropped[i] and not linked
        if linked:
            page.dropped[i] = True
        elif page.dropped[p]:
            page.dropped[i], inside[i] = True, False
    return inside


def main_text(source: str) -> str:
    """The blocks of the main text, in page order, joined by an empty line."""
    page = Page(source)
    inside = content_nodes(page)
    blocks: dict[int, list[str]] = {}
    for node, block, text in page.pieces:
        if inside[node]:
            blocks.setdefault(block, []).append(text)
    found = (SPACE.sub(" ", "".join(parts)).strip() for _, parts in sorted(blocks.items()))
    return "\n\n".join(block for block in found if block)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    chosen = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                          F.col(html_col).alias("html"))

    def run(batch: pa.RecordBatch):
        for first in range(0, batch.num_rows, 256):
            part = batch.slice(first, 256)
            texts = [main_text(page.as_py() or "") for page in part.column(2)]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return map_batches(chosen, run, "page_id long, url string, text string, n_chars long")


def op5_composite_text_density(spark, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
