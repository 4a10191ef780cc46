"""Main text of web pages by consensus of their hosts.

Every page scores its containers and votes for the best one, by its path: tags and classes from the root, numbers taken
out. Spark counts the votes per host; the paths that win there say where the article is, and each page is read again by
them. So a page whose own article is short, or whose noise is long, is still cut where the other pages of its host are.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import arrow_map, positional, stored, with_columns

# A path wins on a host with at least this share of its votes, so there are at most ten.
SHARE = 0.1

# A path longer than this goes on from a digest of it, so deep nesting costs no more than flat.
LONG_PATH = 400

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)"""
    r"""|<(script|style|noscript|template|iframe|svg|textarea|title|select|object|math|noembed|noframes)\b(?:"[^"]*+"|'[^']*+'|[^'">])*+>.*?(?:</\1\s*+>|\Z)"""
    r"""|<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|[^\s/>=]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"']?[^\s>]*+))?+|=)*+)>"""
    r"""|<[!?/][^>]*+>""",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CONTAINERS = frozenset("article main section div td body center".split())
# A start tag ends an open element of these kinds, up to the nearest of the kinds behind it.
ENDS = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "td": (frozenset(["td", "th"]), frozenset(["table"])),
    "th": (frozenset(["td", "th"]), frozenset(["table"])),
    "tr": (frozenset(["tr"]), frozenset(["table"])),
}
P, P_SCOPE = frozenset(["p"]), frozenset(["td", "th", "button", "caption", "html"])

NOISE_TAGS = frozenset("nav aside footer form button dialog menu".split())
NOISE_ROLES = frozenset("navigation banner complementary contentinfo search dialog alert alertdialog menu menubar form toolbar".split())
NOISE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice "
    "notices alert popup modal overlay newsletter subscribe subscription sidebar aside menu nav navbar navigation breadcrumb breadcrumbs "
    "footer share sharing social related recommended recommendations comment comments commentlist disqus respond reply replies discussion "
    "toolbar widget widgets login signup search pagination pager skip masthead teaser teasers trending".split()
)
GOOD_WORDS = frozenset("article post entry content main story text body".split())


class Node:
    __slots__ = ("container", "good", "linked", "near", "noise", "own", "parent", "path", "score", "soft", "tag")

    def __init__(self, tag: str, parent: Node | None, path: str, noise: bool) -> None:
        self.tag, self.parent, self.path, self.noise, self.score = tag, parent, path, noise, 0.0
        # Noise by words or as a form alone, and noise of its own that holds whatever is inside.
        self.soft = self.own = self.good = False
        self.container = tag in CONTAINERS
        # The nearest container, this one or around it, and whether a link lies on the way.
        self.near: Node | None = self if self.container else parent.near if parent is not None else None
        self.linked = not self.container and (tag == "a" or (parent is not None and parent.linked))


def _open(tag: str, attributes: str, parent: Node) -> Node:
    words: list[str] = []
    noise, soft = tag in NOISE_TAGS and tag != "form", tag == "form"
    name = tag
    if attributes and not attributes.isspace():
        for kind, value in ATTRIBUTE.findall(attributes):
            kind, value = kind.lower(), value.strip("\"'").lower()
            if kind == "class":
                classes = sorted({re.sub(r"\d+", "#", c) for c in value.split()})
                name = ".".join([tag, *classes])
                words += re.split(r"[\W_]+", value)
            elif kind == "id":
                words += re.split(r"[\W_]+", value)
            elif kind == "role":
                noise |= value in NOISE_ROLES
            elif kind == "hidden" or (kind == "aria-hidden" and value == "true") or (kind == "style" and re.search(r"display\s*:\s*none", value)):
                noise = True
        if tag not in ("html", "body", "article", "main") or "comment" in words or "comments" in words:
            soft |= not NOISE_WORDS.isdisjoint(words)
    # Pages may leave out html and body, so paths begin behind them.
    path = parent.path if tag in ("html", "body") else f"{parent.path}/{name}"
    if len(path) > LONG_PATH:
        path = "#" + blake2b(path.encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()
    node = Node(tag, parent, path, noise or soft or parent.noise)
    node.soft, node.own, node.good = soft and not noise, noise, not GOOD_WORDS.isdisjoint(words)
    if node.container:
        node.score = (30.0 if tag in ("article", "main") else 0.0) + (10.0 if not GOOD_WORDS.isdisjoint(words) else 0.0)
    return node


def _acquit(nodes: list[Node], texts: list[tuple[Node, str | None]]) -> None:
    """Takes the noise off elements that are noise by a word or as a form alone but hold an article, main or most of the
    page's text outside links; if no text is left then, off all of them. Most is half with a good word or as a form, else
    four fifths, as comments can be longer than the article; and a page with an article or main of its own needs neither."""
    if not any(n.soft for n in nodes):
        return
    # Text outside links and outside noise that holds in any case, in elements and what is below them.
    size: dict[int, int] = {}
    dead: dict[int, bool] = {}
    for node in nodes:
        dead[id(node)] = node.own or node.tag == "a" or (node.parent is not None and dead[id(node.parent)])
        size[id(node)] = 0
    for node, text in texts:
        if text is not None and not dead[id(node)]:
            size[id(node)] += len("".join(text.split()))
    holds: set[int] = set()
    for node in reversed(nodes):
        if node.parent is not None:
            size[id(node.parent)] += size[id(node)]
            if not node.own and (id(node) in holds or (node.tag in ("article", "main") and not node.soft and size[id(node)])):
                holds.add(id(node.parent))
    total = size[id(nodes[0])]
    sure = any(n.tag in ("article", "main") and not n.soft and not dead[id(n)] and size[id(n)] for n in nodes)

    def most(node: Node) -> bool:
        return not sure and size[id(node)] * (2 if node.good or node.tag == "form" else 1.25) > total

    def settle(spare: bool) -> None:
        for node in nodes:
            soft = node.soft and not (spare or id(node) in holds or most(node))
            node.noise = node.own or soft or (node.parent is not None and node.parent.noise)

    settle(False)
    if total and all(n.noise or t is None or n.tag == "a" or not t.strip() for n, t in texts):
        settle(True)


def parse(page: str) -> tuple[list[Node], list[tuple[Node, str | None]]]:
    """The elements of a page, and its text by element in page order. A None is the border of a block."""
    root = Node("", None, "", False)
    stack, nodes, texts = [root], [root], []
    opened: Counter[str] = Counter()
    at = 0

    def drop(i: int) -> None:
        opened.subtract(n.tag for n in stack[i:])
        del stack[i:]

    def close(kinds: frozenset[str], scope: frozenset[str]) -> None:
        if not any(opened[k] for k in kinds):
            return
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in kinds:
                drop(i)
                texts.append((stack[-1], None))
                return
            if stack[i].tag in scope:
                return

    # Behind the last ">" there can't be a tag.
    for token in TOKEN.finditer(page, 0, page.rfind(">") + 1):
        start = token.start()
        if start > at:
            texts.append((stack[-1], page[at:start]))
        at = token.end()
        tag = token[3]
        if tag is None:
            continue
        tag = tag.lower()
        if token[2]:
            for i in range(len(stack) - 1, 0, -1) if opened[tag] else ():
                if stack[i].tag == tag:
                    drop(i)
                    break
            if tag in BLOCK:
                texts.append((stack[-1], None))
            continue
        if tag == "br":
            texts.append((stack[-1], " "))
            continue
        if tag in BLOCK:
            close(P, P_SCOPE)
            if tag in ENDS:
                close(*ENDS[tag])
            texts.append((stack[-1], None))
        if tag not in VOID:
            node = _open(tag, token[4], stack[-1])
            nodes.append(node)
            stack.append(node)
            opened[tag] += 1
    if at < len(page):
        texts.append((stack[-1], page[at:]))
    _acquit(nodes, texts)
    return nodes, texts


def _blocks(texts: Iterator[str | None]) -> list[str]:
    blocks, parts = [], []
    for text in [*texts, None]:
        if text is not None:
            parts.append(text)
        elif parts:
            block = " ".join(html.unescape("".join(parts)).split())
            if block:
                blocks.append(block)
            parts = []
    return blocks


def best_container(page: str) -> str | None:
    """The path of the container with the most article text: text counts for its nearest container in full and for the
    one around that by half, text in links against both; noise counts nothing."""
    nodes, texts = parse(page)
    for node, text in texts:
        if text is None or node.noise:
            continue
        size = len(text) - text.count(" ") * 0.1
        if size < 2:
            continue
        weight, node = (-1.0 if node.linked else 1.0), node.near
        if node is not None:
            node.score += weight * size
            outer = node.parent.near
            if outer is not None:
                outer.score += weight * size / 2
    found = [n for n in nodes if n.container and not n.noise and n.score > 0]
    if not found:
        return None
    return _widened(max(found, key=lambda n: n.score), texts).path


def _widened(best: Node, texts: list[tuple[Node, str | None]]) -> Node:
    """The article or main around a container; without one, the elements around it as long as they have good words or it
    is a section, and what text they add is at most a fifth links."""
    if best.tag in ("article", "main"):
        return best
    outer = best.parent
    while outer is not None:
        if outer.tag in ("article", "main") and outer.container and not outer.noise:
            return outer
        outer = outer.parent
    while (outer := best.parent) is not None and outer.container and not outer.noise and outer.tag != "body" and (outer.good or best.tag == "section"):
        plain = links = 0
        for node, text in texts:
            if text is None or node.noise or not text.strip():
                continue
            link = False
            while node is not None and node is not best and node is not outer:
                link |= node.tag == "a"
                node = node.parent
            if node is outer:
                plain, links = plain + len(text) * (not link), links + len(text) * link
        if not plain or links * 4 > plain:
            break
        best = outer
    return best


def main_text(page: str, paths: list[str]) -> str:
    """The text of the elements at the first of the paths that the page has; without any, of its own best container."""
    nodes, texts = parse(page)
    own = False
    for path in [*paths, None]:
        if path is None:
            path, own = best_container(page), True
        chosen = {id(n) for n in nodes if path is not None and n.container and not n.noise and n.path == path}
        if chosen or own:
            break
    if not chosen:
        chosen = {id(nodes[0])}
    # 0 outside, 1 article, 2 an article's header, of which only headings count. Parents come before their children.
    inside: dict[int, int] = {}
    for node in nodes:
        state = inside[id(node.parent)] if node.parent is not None else 0
        if node.noise:
            state = 0
        elif id(node) in chosen:
            state = 1
        elif (state == 1 and node.tag == "header") or (state == 2 and node.tag in HEADINGS):
            state = 3 - state
        inside[id(node)] = state
    return "\n\n".join(_blocks(text if text is None or inside[id(node)] == 1 else "" for node, text in texts))


def host_of(url: Column) -> Column:
    """The host in lower case; empty where there is none."""
    return F.coalesce(F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit(""))


def winning_paths(pages: DataFrame, url_col: str = "url", html_col: str = "html", share: float = SHARE) -> DataFrame:
    """``host, paths``: the paths with at least ``share`` of their host's votes, the most votes first."""

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = [best_container(h or "") for h in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(paths, pa.string())], ["host", "path"])

    votes = arrow_map(pages.select(host_of(F.col(url_col)).alias("host"), html_col), vote, "host string, path string")
    # Counted before the shuffle: a host of any size is a row per path and task.
    counted = stored(votes.where("path IS NOT NULL").groupBy("host", "path").agg(F.count(F.lit(1)).alias("n")), "votes")
    total = counted.groupBy("host").agg(F.sum("n").alias("total"))
    won = counted.join(total, "host").where(F.col("n") >= share * F.col("total"))
    ranked = won.groupBy("host").agg(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("n"), "path"))).alias("won"))
    return stored(ranked.select("host", F.col("won.path").alias("paths")), "paths")


def extract(pages: DataFrame, url_col: str = "url", html_col: str = "html", share: float = SHARE) -> DataFrame:
    """``pages`` with the html replaced by ``text`` and ``n_chars``, one row per row.

    Blocks are in page order, white space inside a block is one space, blocks are joined by two newlines, character
    references are decoded. NULL and empty html give an empty text; pages without a host vote together. Repeated rows
    stay, other columns too; a column with the name of a new one gives way to it. An empty table gives an empty result.
    """
    winners = winning_paths(pages, url_col, html_col, share)
    plain, (url, source) = positional(pages, url_col, html_col)
    kept = [(place, name) for place, name in zip(plain.columns, pages.columns, strict=True) if name not in (html_col, "text", "n_chars")]
    joined = plain.withColumn("host", host_of(F.col(url))).join(winners, "host", "left").select(*(p for p, _ in kept), F.col(source).alias("source"), "paths")
    schema = with_columns(joined.drop("source", "paths").schema, text="string", n_chars="bigint")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in batches:
            *others, sources, paths = batch.columns
            texts = [main_text(h or "", p or []) for h, p in zip(sources.to_pylist(), paths.to_pylist(), strict=True)]
            columns = [*others, pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    return arrow_map(joined, read, schema).toDF(*(name for _, name in kept), "text", "n_chars")
