"""Main text of web pages by site style trees.

The pages of a host are merged into one tree, whose nodes are the chains of elements with their
classes and ids. A node that shows the same text in the same shape on page after page has little
entropy and so little importance; its branch goes from every page. An inner node is judged by all
the text below it. Menus, adverts, forms and the like go by what the markup says; article and main
elements are a prior, which branches outside them must outweigh.
"""

from __future__ import annotations

import hashlib
import html
import re
from array import array
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StringType, StructField, StructType

from sensorloom.llm.common import per_text
from sensorloom.operators.ordering import fits_broadcast
from sensorloom.session import written

#: Branches below this importance go; it is judged on at least so many pages.
LEAST_IMPORTANCE = 0.2
LEAST_PAGES = 5
#: Hosts with branches to remove up to which these are broadcast, if they take few bytes; beyond it they are joined by shuffle.
BROADCAST_HOSTS = 20_000
#: Paths of a page that are remembered at a time.
REMEMBERED_PATHS = 100_000

# Elements by what they do in a page.
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("iframe noembed noframes noscript script style svg template textarea title xmp".split())
#: Elements that hold no article text, though an article may stand in one that was left open.
CHROME = frozenset("footer head header menu nav".split())
NOISE = frozenset("aside audio button canvas datalist dialog form input map select video".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
NAMES = frozenset(
    "ad ads adsense advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer gdpr"
    " hidden login masthead menu menubar modal nav navbar navigation newsletter notice notices notification pager pagination paywall popup"
    " promo promoted recommended related replies reply responses search share sharing sidebar signup skip social sponsor sponsored"
    " subscribe subscription toolbar topbar tracking widget widgets".split()
)
#: What may stand beside such a name in a class or id that still says what the element itself is, as in related-posts.
BESIDE = frozenset(
    "area bar block box button buttons container form icons inner item items link links list outer panel post posts section site slot unit"
    " wrap wrapper".split()
)
HOLDS = frozenset("article main".split())
#: A start of one of these ends an open one of the same group.
ENDS_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}, "option": {"option"}}
FENCE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "td": {"table"}, "th": {"table"}, "tr": {"table"}, "option": {"select"}}
ENDS_P = BLOCKS - {"br", "body", "html", "option", "optgroup"}

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>?|</([a-zA-Z][^\s/>]*+)[^>]*+>?|<([a-zA-Z][^\s/>]*+)|[^<]++|<", re.S)
_STOP = re.compile("[>\"']")
#: What is left out of the end of a page in which no tag is closed any more.
_OPEN = re.compile(r"<(?:[!?]|/[a-zA-Z])")
_ATTRIBUTE = re.compile(r"""(?<![\w:-])([a-zA-Z][\w:-]*+)\s*+=\s*+(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|\b(hidden)\b""")
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_MASK = (1 << 63) - 1


class _Node:
    """An open element: what it is, its path's hash, whether its text counts, the places of its named element and holder,
    its own place, the element that begins its block, its node in the page's tree and the next one above."""

    __slots__ = ("tag", "path", "noise", "chrome", "sure", "named", "holder", "at", "block", "node", "above")

    def __init__(self, tag: str, path: int, noise: bool, chrome: bool, sure: bool, named: int = -1, holder: int = -1, at: int = 0, around: _Node | None = None):
        self.tag, self.path, self.noise, self.chrome, self.sure, self.named, self.holder = tag, path, noise, chrome, sure, named, holder
        self.at, self.block = at, self if around is None or tag in BLOCKS else around.block
        self.node, self.above = -1, -1


def _hash(*parts: object) -> int:
    return int.from_bytes(hashlib.blake2b("\x1f".join(map(str, parts)).encode("utf-8", "surrogatepass"), digest_size=8).digest()) & _MASK


def _tag_end(page: str, at: int, dead: set[int]) -> int:
    """Where the tag that goes on at ``at`` ends: its first ``>`` outside quotes, or at all if there is none outside.

    ``dead`` holds the quotes from which no such ``>`` was found, so that none is followed twice.
    """
    tried, to = [], at
    while (m := _STOP.search(page, to)) and m.start() not in dead:
        if m[0] == ">":
            return m.start()
        tried.append(m.start())
        to = page.find(m[0], m.end()) + 1
        if not to:
            break
    dead.update(tried)
    return page.find(">", at)


def _said(raw: str) -> dict[str, str]:
    found = {}
    for m in _ATTRIBUTE.finditer(raw):
        name = (m[1] or m[5]).lower()
        if name not in found:
            found[name] = html.unescape(next((v for v in (m[2], m[3], m[4]) if v is not None), ""))
    return found


def _is_noise(said: dict[str, str]) -> bool:
    if "hidden" in said or said.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none", said.get("style", ""), re.I):
        return True
    return said.get("role", "").lower() in ROLES


def _is_named(said: dict[str, str]) -> bool:
    """Whether a whole class or the id is a name of noise: no part of it says anything else, as in has-sidebar."""
    for name in [*said.get("class", "").split(), said.get("id", "")]:
        parts = [part.lower() for part in _NAME_PART.findall(name)]
        if any(p in NAMES for p in parts) and all(p in NAMES or p in BESIDE or p.isdigit() for p in parts):
            return True
    return False


def _dropped(pieces: list[tuple[str, int, int]], names: list[tuple[int, bool]], holders: list[tuple[int, int]]) -> list[bool]:
    """Which named elements go with all that is in them.

    A name does not count against most of the page's text, unless other text stands in an article or
    main element and no single such element holds most of the text; nor against an article or main
    element if no other text stands in one. ``pieces`` are (text, named element, holder); ``names`` have the
    named element around and whether they are holders themselves, ``holders`` the holder around and
    their named element.
    """
    if not names:
        return []
    chars, held, central = [0] * len(names), [0] * len(holders), [False] * len(names)
    total, plain = 0, False
    for text, named, holder in pieces:
        n = len(text.strip())
        total += n
        if named >= 0:
            chars[named] += n
        if holder >= 0:
            held[holder] += n
            plain = plain or named < 0 and n > 0
    for i in reversed(range(len(holders))):
        around, named = holders[i]
        if around >= 0:
            held[around] += held[i]
        if named >= 0 and 2 * held[i] > total:
            central[named] = True
    for i in reversed(range(len(names))):
        around, _ = names[i]
        if around >= 0:
            chars[around] += chars[i]
            central[around] = central[around] or central[i]
    out: list[bool] = []
    for i, (around, holds) in enumerate(names):
        spared = holds and not plain or 2 * chars[i] > total and (central[i] or not plain)
        out.append(not spared or around >= 0 and out[around])
    return out


def _outside(elements: tuple[array, array], blocks: list[tuple[int, bool]]) -> list[int]:
    """The branch of each block: -1 in an article or main element, and on pages without any.

    Elsewhere the path of the outermost element around the block with no article or main element below it.
    ``elements`` are the places of the elements around and the paths, ``blocks`` have their element and whether they are sure.
    """
    around, paths = elements
    trunk = {0}
    for at, sure in blocks:
        while sure and at not in trunk:
            trunk.add(at)
            at = around[at]
    if not any(sure for _, sure in blocks):
        return [-1] * len(blocks)
    top = {at: at for at in trunk}
    out = []
    for at, sure in blocks:
        chain = []
        while at not in top:
            chain.append(at)
            at = around[at]
        for below in reversed(chain):
            top[below] = below if top[at] in trunk else top[at]
            at = below
        out.append(-1 if sure else paths[top[at]])
    return out


def page_blocks(page: str) -> list[tuple[int, str, bool]]:
    """The page's blocks of text as (path, text, sure), without those that the markup calls something else.

    ``sure`` blocks stand in an article or main element. Element ends may be missing.
    """
    return [block[:3] for block in page_tree(page)[0]]


def page_tree(page: str) -> tuple[list[tuple[int, str, bool, int, int]], list[tuple[int, int, int, int, bool]]]:
    """The blocks of ``page_blocks`` with their branch outside article and main elements and their node, and the nodes.

    A node is (path, the next one above or -1, the sum of the hashes of all texts below it, their length, sure). Those
    above stand first. In an article or main element only the nodes inside it count. The time follows the
    page's length, whatever is left open or closed in it.
    """
    made: list[tuple[_Node, list[tuple[str, int, int]]]] = []
    elements = array("q", [0]), array("q", [0])
    pieces: list[tuple[str, int, int]] = []
    names: list[tuple[int, bool]] = []
    holders: list[tuple[int, int]] = []
    paths: dict[tuple, int] = {}
    root = _Node("", 0, False, False, False)
    nodes, places = [[0, -1, 0, 0, False]], {0: 0}
    root.node = 0
    stack, opened = [root], defaultdict(list)  # of each tag the places in the stack

    def flush() -> None:
        if pieces:
            made.append((stack[-1].block, pieces.copy()))
            pieces.clear()

    def close(tags: frozenset | set, fence: set = frozenset()) -> None:
        at = max((opened[t][-1] for t in tags if opened.get(t)), default=0)
        if at and at > max((opened[t][-1] for t in fence if opened.get(t)), default=0):
            if any(node.tag in BLOCKS for node in stack[at:]):
                flush()
            for node in stack[at:]:
                opened[node.tag].pop()
            del stack[at:]

    at, n, last, dead = 0, len(page), page.rfind(">"), set()
    while at < n:
        if at > last:  # no tag ends any more: all that is left is text, up to what would be left out
            m = _OPEN.search(page, at)
            rest, at = page[at : m.start() if m else n], n
            if rest and not (stack[-1].noise or stack[-1].chrome):
                pieces.append((html.unescape(rest), stack[-1].named, stack[-1].holder))
            break
        m = _TOKEN.match(page, at)
        at = m.end()
        if m[2]:
            tag = m[2].lower()
            end = _tag_end(page, at, dead)
            raw, at = page[at:end], end + 1
            if tag in RAW:
                if not raw.endswith("/"):
                    end = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.I).search(page, at)
                    at = end.end() if end else n
                continue
            if tag in BLOCKS:
                flush()
            if tag in ENDS_P:
                close({"p"}, {"article", "body", "div", "main", "section", "td", "th", "li", "blockquote", "button"})
            if tag in ENDS_SAME:
                close(ENDS_SAME[tag], FENCE[tag])
            if tag in VOID or raw.endswith("/") and tag not in BLOCKS:
                continue
            said, top = _said(raw) if raw else {}, stack[-1]
            holds = tag in HOLDS or said.get("role", "").lower() == "main"
            key = (top.path, tag, said.get("class", ""), said.get("id", ""), holds)
            if key not in paths:
                if len(paths) >= REMEMBERED_PATHS:
                    paths.clear()
                paths[key] = _hash(*key)
            path, sure = paths[key], top.sure or holds
            noise = top.noise or tag in NOISE or tag not in ("html", "body") and not holds and _is_noise(said) or tag == "article" and _is_noise(said)
            named, holder = top.named, top.holder
            if not noise and tag not in ("html", "body") and (not holds or tag == "article") and _is_named(said):
                names.append((named, holds))
                named = len(names) - 1
            if holds:
                holders.append((holder, named))
                holder = len(holders) - 1
            # The header of an article is part of it; an article inside a menu left open is still one.
            chrome = False if holds else top.chrome or tag in CHROME and not (tag == "header" and top.sure)
            elements[0].append(top.at)
            elements[1].append(path)
            node = _Node(tag, path, noise, chrome, sure, named, holder, len(elements[0]) - 1, top)
            if not sure or top.sure and stack[-2].sure:  # else the outermost holder or in it
                node.above = top.node if top.tag in BLOCKS else top.above
            if tag in BLOCKS:
                if path not in places:
                    places[path] = len(nodes)
                    nodes.append([path, node.above, 0, 0, sure])
                node.node = places[path]
            opened[tag].append(len(stack))
            stack.append(node)
        elif m[1]:
            tag = m[1].lower()
            if tag in BLOCKS:
                flush()
            close({tag}, set() if tag in BLOCKS else {"article", "body", "div", "main", "p", "section", "td", "li"})
        elif not page.startswith(("<!", "<?"), m.start()) and not (stack[-1].noise or stack[-1].chrome):
            pieces.append((html.unescape(m[0]) if "&" in m[0] else m[0], stack[-1].named, stack[-1].holder))
    flush()
    gone = _dropped([piece for _, own in made for piece in own], names, holders)
    texts = [" ".join("".join(t for t, named, _ in own if named < 0 or not gone[named]).split()) for _, own in made]
    kept = [(node, text) for (node, _), text in zip(made, texts) if text]
    branches = _outside(elements, [(node.at, node.sure) for node, _ in kept])
    for node, text in kept:
        own = nodes[node.node]
        own[2] += _hash(text) >> 19  # sums of 44 bits: the order of the blocks does not count
        own[3] += len(text)
    for path, above, texts_below, chars, _ in reversed(nodes):
        if above >= 0:
            nodes[above][2] += texts_below
            nodes[above][3] += chars
    # Only nodes with text count; what is above a node with text has some too.
    place = {}
    for i, node in enumerate(nodes):
        if node[3]:
            place[i] = len(place)
    told = [(path, place.get(above, -1), below & _MASK, chars, sure) for path, above, below, chars, sure in nodes if chars]
    return [(node.path, text, node.sure, branch, place[node.node]) for (node, text), branch in zip(kept, branches)], told


BLOCK = StructType([
    StructField("path", LongType()), StructField("text", StringType()), StructField("sure", BooleanType()),
    StructField("branch", LongType()), StructField("node", IntegerType()),
])
NODE = StructType([
    StructField("path", LongType()), StructField("above", IntegerType()), StructField("text", LongType()),
    StructField("chars", LongType()), StructField("sure", BooleanType()),
])


def parse_pages(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``host`` and the page's ``blocks`` and ``nodes``."""
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    named = pages.select("page_id", "url", host.alias("host"), "html")
    return per_text(named, ["page_id", "url", "host"], "html", [StructField("blocks", ArrayType(BLOCK)), StructField("nodes", ArrayType(NODE))], page_tree)


def _spread(parsed: DataFrame, what: str) -> DataFrame:
    """A row for each of a page's blocks or nodes ``x``; pages of equal text are one page, so that copies say nothing."""
    in_articles = F.aggregate(F.filter("blocks", lambda b: b["sure"]), F.lit(0).cast("bigint"), lambda n, b: n + F.length(b["text"]))
    return parsed.select("host", F.xxhash64("blocks.text").alias("_page"), in_articles.alias("in_articles"), F.posexplode(what).alias("_at", "x"))


def tree_places(parsed: DataFrame) -> DataFrame:
    """A row per block, outside article and main elements, of every different page of a host."""
    own = [F.col(f"x.{c}").alias(c) for c in ("path", "sure", "branch")]
    spread = _spread(parsed, "blocks").filter(~F.col("x.sure"))
    return spread.select("host", "_page", "in_articles", "_at", *own, F.xxhash64("x.text").alias("_text"), F.length("x.text").cast("bigint").alias("chars")).distinct()


def tree_nodes(parsed: DataFrame) -> DataFrame:
    """A row per node of every different page of a host: all the text below it, as a sum of hashes, and the length of it."""
    rival = F.when(F.col("x.sure"), F.col("in_articles")).otherwise(0).alias("rival")
    spread = _spread(parsed, "nodes").select("host", F.col("x.path").alias("path"), "_page", F.col("x.text").alias("_text"), F.col("x.chars").alias("chars"), rival)
    return spread.groupBy("host", "path", "_page").agg(F.max("_text").alias("_text"), F.max("chars").alias("chars"), F.max("rival").alias("rival"))


def _entropy(counted: DataFrame, value: str, *sums: str) -> DataFrame:
    """The entropy of the counts ``n`` of each ``host`` and ``path``, as a share of the highest that their total allows."""
    total, logs = F.sum("n"), F.sum(F.col("n") * F.log("n"))
    bits = F.when(total > 1, (F.log(total) - logs / total) / F.log(total)).otherwise(1.0)
    return counted.groupBy("host", "path").agg(bits.alias(value), total.alias(f"{value}_n"), *[F.sum(c).alias(c) for c in sums])


def branch_importance(places: DataFrame) -> DataFrame:
    """``host``, ``path``, ``pages`` and ``importance`` of the nodes that have blocks of their own, by these blocks.

    Content: the entropy of the branch's texts over its places. Presentation: the entropy of how many
    blocks it has in a page. Both are shares of the highest entropy that so many places allow; the
    importance is the larger of the two, and 1 for branches on fewer than ``LEAST_PAGES`` pages.
    """
    content = _entropy(places.groupBy("host", "path", "_text").agg(F.count("*").alias("n")), "content")
    shapes = places.groupBy("host", "path", "_page").agg(F.count("*").alias("_shape")).groupBy("host", "path", "_shape").agg(F.count("*").alias("n"))
    both = content.join(_entropy(shapes, "presentation"), ["host", "path"])
    importance = F.when(F.col("presentation_n") < LEAST_PAGES, 1.0).otherwise(F.greatest("content", "presentation"))
    return both.select("host", "path", F.col("presentation_n").alias("pages"), importance.alias("importance"))


def node_importance(nodes: DataFrame) -> DataFrame:
    """``host``, ``path``, ``pages`` and ``importance`` of all nodes, inner ones too, by all the text below them on each page.

    The entropy of that text over the pages, as a share of the highest; it is never below that of the
    number of blocks, which the text decides. It is 1 for nodes on fewer than ``LEAST_PAGES`` pages, and
    for nodes in an article or main element with most of its text on their pages: the prior.
    """
    shown = nodes.groupBy("host", "path", "_text").agg(F.count("*").alias("n"), F.sum("chars").alias("chars"), F.sum("rival").alias("rival"))
    judged = _entropy(shown, "content", "chars", "rival")
    most = (F.col("rival") > 0) & (2 * F.col("chars") > F.col("rival"))
    importance = F.when((F.col("content_n") < LEAST_PAGES) | most, 1.0).otherwise(F.col("content"))
    return judged.select("host", "path", F.col("content_n").alias("pages"), importance.alias("importance"))


def outweighing(places: DataFrame) -> DataFrame:
    """``host`` and ``path`` of the branches outside article and main elements with more text, over their pages, than these."""
    outside = places.filter("branch >= 0").groupBy("host", F.col("branch").alias("path"), "_page")
    pages = outside.agg(F.sum("chars").alias("chars"), F.first("in_articles").alias("rival"))
    return pages.groupBy("host", "path").agg(F.sum("chars").alias("chars"), F.sum("rival").alias("rival")).filter("chars > rival").select("host", "path")


def _kept_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The text of each page that its host's tree leaves."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            texts = []
            for blocks, nodes, *lists in zip(*(part.column(c).to_pylist() for c in ("blocks", "nodes", "leaf", "node", "wins"))):
                leaf, weak, wins = (frozenset(paths or ()) for paths in lists)
                gone: list[bool] = []
                for node in nodes:
                    gone.append(node["path"] in weak or node["above"] >= 0 and gone[node["above"]])
                kept = [b["text"] for b in blocks if not gone[b["node"]] and (
                    b["sure"] or (b["branch"] < 0 or b["branch"] in wins) and b["path"] not in leaf)]
                texts.append("\n".join(kept))
            columns = [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])


def main_text(pages: DataFrame, least: float = LEAST_IMPORTANCE) -> DataFrame:
    """``page_id``, ``url``, the main ``text`` (blocks joined by newlines) and its ``n_chars`` for every page.

    Blocks go from every page that stand in a node of less than ``least`` importance in their host's style
    tree. Of pages with an article or main element, blocks outside it go too, unless their branch has
    more text on the host's pages than these elements; in it, a node that has most of the text stays.

    A null or empty html has an empty text. A null url belongs to the host without a name. Very long and
    deeply nested pages are taken whole, in time that follows their length. Equal rows are each returned; an
    empty table gives no rows. Other columns are ignored.
    """
    parsed = written(parse_pages(pages), "pages")
    places, nodes = written(tree_places(parsed), "places"), written(tree_nodes(parsed), "tree")
    low = F.col("importance") < least
    found = branch_importance(places).filter(low).select("host", "path", F.lit("leaf").alias("why"))
    found = found.unionAll(node_importance(nodes).filter(low).select("host", "path", F.lit("node"))).unionAll(outweighing(places).select("host", "path", F.lit("wins")))
    # What the style tree says of each host; at most three times as much as the tree has nodes.
    lists = [F.collect_set(F.when(F.col("why") == c, F.col("path"))).alias(f"_{c}") for c in ("leaf", "node", "wins")]
    said = written(found.groupBy(F.col("host").alias("_host")).agg(*lists), "weak")
    few = said.count() <= BROADCAST_HOSTS and fits_broadcast(said)
    joined = parsed.join(F.broadcast(said) if few else said, F.col("host") == F.col("_host"), "left")
    # Of its host's tree a page takes along what is about its own paths.
    own = {"leaf": "blocks.path", "node": "nodes.path", "wins": "blocks.branch"}
    joined = joined.select("page_id", "url", "blocks", "nodes", *[F.array_intersect(f"_{c}", path).alias(c) for c, path in own.items()])
    kind = f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars bigint"
    return joined.mapInArrow(_kept_text, kind)
