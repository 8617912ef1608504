"""Main-text extraction from HTML by consensus host paths.

1. Every page's containers are scored by the plain text of the blocks in them and
   vote for their generalised tag-class path, in proportion to their score.
2. Votes are summed per (host, path) in Spark, partially before the shuffle, and each
   host's best path wins.
3. Every page is read again: the elements on its host's winning path give the main
   text; a page without that path falls back on its own best container.

Elements that never hold an article (menus, footers, scripts, hidden parts) are out. A
class or id word such as ``sidebar`` and a form around it only make an element doubtful: it
is out unless most of the page's text is in it and the article's title is too, or next to
nothing would be left without it. So a layout wrapper of such a name keeps its article.

The reader below handles broken markup: implied and missing end tags, comments, raw
text elements. Pages are handled one by one and whole, in time and memory that grow
with their length, not with their depth.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.session import cut_lineage

#: Winning paths are broadcast up to this many hosts (under 20 MB), else joined with salted keys.
BROADCAST_HOSTS = 50_000
_SALTS = 16

# HTML element and class vocabulary.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript template iframe textarea title xmp noembed noframes svg math".split())
_BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section
summary table tbody td tfoot th thead tr ul caption colgroup""".split())
_CONTAINER = frozenset("article body div main section td html center".split())
_HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
_NOT_TEXT = frozenset("""nav footer aside form button select option datalist dialog menu object embed canvas audio video
map head script style noscript template iframe textarea title xmp noembed noframes svg math fieldset search""".split()) - {"form"}
_COMMENTS = frozenset("comments commentlist disqus reply replies respond".split())
_NOT_CLASS = frozenset("""nav navbar navigation menu submenu breadcrumb breadcrumbs sidebar aside footer masthead banner ad
ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promotion cookie cookies consent
gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login share sharing social related
recommended recommendations comment comments commentlist disqus reply replies respond pagination pager tagcloud toolbar
widget widgets copyright skip search hidden header outbrain taboola""".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
_NEGATION = frozenset("has no with without".split())
_CLOSED_BY = {
    "p": _BLOCK - {"option", "colgroup", "caption", "legend", "summary"}, "li": {"li"}, "dt": {"dt", "dd"},
    "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"}, "td": {"td", "th", "tr", "tbody", "tfoot"},
    "th": {"td", "th", "tr", "tbody", "tfoot"}, "option": {"option"}, "head": {"body"}}
_SCOPE = frozenset("table td th ul ol dl html body article section div main".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_ATTR = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_SPLIT = re.compile(r"[^a-z0-9]+")
_DIGITS = re.compile(r"\d+")


class _Node:
    """An open element. What it has from its ancestors is set when it opens, so nothing walks up to the root."""

    __slots__ = ("tag", "parent", "own", "key", "hard", "doubt", "heading", "level", "link", "article", "box", "near",
                 "score", "out", "inside")

    def __init__(self, tag: str, parent: _Node | None):
        self.tag, self.parent = tag, parent
        self.own, self.key, self.hard, self.doubt, self.heading = tag, 0, False, "", False
        self.level, self.link, self.article, self.box, self.near = "", False, False, None, None
        self.score, self.out, self.inside = 0.0, False, False

    @property
    def path(self) -> str:
        """The tag-class path from the root, as its hash, and its last step."""
        return f"{self.key:016x} {self.own}"


def _attributes(raw: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _ATTR.finditer(raw):
        out.setdefault(m[1].lower(), unescape(m[2] or m[3] or m[4] or ""))
    return out


def _open(tag: str, raw: str, parent: _Node) -> _Node:
    node = _Node(tag, parent)
    node.hard, node.heading = parent.hard, parent.heading
    if raw and not raw.isspace():
        attrs = _attributes(raw)
        names = attrs.get("class", "").lower().split()
        node.own = tag + "".join("." + _DIGITS.sub("#", c) for c in sorted(names))
        if tag not in ("html", "body", "main") and not node.hard:
            for name in [*names, attrs.get("id", "").lower()]:
                parts = [x for x in _SPLIT.split(name) if x]
                hit = _NOT_CLASS.intersection(parts)
                if not hit or parts[0] in _NEGATION:
                    continue
                if hit == {"header"} and {"article", "post", "entry", "story"} & set(parts):
                    node.heading = True
                elif tag != "article" or hit & {"comment", "comments", "reply", "related", "ad", "ads", "advert", "promo"}:
                    node.doubt = "comments" if hit & _COMMENTS or node.doubt == "comments" else "words"
            node.hard = attrs.get("role", "").lower() in _ROLES or "hidden" in attrs or attrs.get("aria-hidden") == "true" \
                or "display:none" in attrs.get("style", "").replace(" ", "").lower()
    if tag in _NOT_TEXT:
        node.hard = True
    elif tag == "form" and not node.doubt:
        node.doubt = "words"
    elif tag == "header" and not node.hard and not node.doubt:
        if parent.article or parent.tag == "main":
            node.heading = True                                      # an article's own header: its title stays
        else:
            node.hard = True
    node.key = xxhash.xxh64_intdigest(node.own, parent.key)
    node.article = parent.article or "article" in node.own
    node.level = tag if tag in _HEADING else parent.level
    node.link = tag == "a" or parent.link
    node.box = node if tag in _CONTAINER else parent.box
    node.near = node if node.doubt else parent.near
    return node


def read(html: str) -> tuple[list[_Node], list[tuple[str, _Node, int]]]:
    """Elements in page order, and (text, innermost element, characters in links) of each text block that may count."""
    nodes, pieces = _elements(html)
    _settle(nodes, [p for block in pieces for p in block])
    blocks = []
    for block in pieces:
        kept = [(raw, node) for raw, node in block if not node.out]
        joined = " ".join("".join(raw for raw, _ in kept).split())
        if joined:
            owner = next(node for raw, node in kept if raw.strip())
            blocks.append((joined, owner, sum(len(raw.strip()) for raw, node in kept if node.link)))
    return nodes, blocks


def _elements(html: str) -> tuple[list[_Node], list[list[tuple[str, _Node]]]]:
    """All elements, and the pieces of text of every block with the element they stand in."""
    root = _Node("", None)
    node, nodes, blocks = root, [root], []
    pieces: list[tuple[str, _Node]] = []
    open_tags: Counter = Counter()
    at, n = 0, len(html)

    def text(raw: str) -> None:
        if not node.hard and (not node.heading or node.level):
            pieces.append((unescape(raw) if "&" in raw else raw, node))

    def flush() -> None:
        if pieces:
            blocks.append(pieces.copy())
            pieces.clear()

    def close(last: _Node) -> _Node:
        """End ``last`` and all that is open in it."""
        up = node
        while up is not last:
            open_tags[up.tag] -= 1
            up = up.parent
        open_tags[last.tag] -= 1
        return last.parent

    while at < n:
        m = _TOKEN.search(html, at)
        if m is None:
            text(html[at:])
            break
        if m.start() > at:
            text(html[at:m.start()])
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if m[1]:
            if tag in _BLOCK:
                flush()
            if open_tags[tag]:
                up = node
                while up.tag != tag:
                    if up.tag in ("td", "th", "table") and tag not in ("td", "th", "tr", "table", "tbody", "thead", "tfoot"):
                        break                                        # a cell's end tags don't close what is around the table
                    up = up.parent
                if up.tag == tag:
                    node = close(up)
            continue
        if tag == "br":
            pieces.append((" ", node))
            continue
        if tag in _BLOCK:
            flush()
            up = node                                                # elements that this start tag ends
            while up is not root:
                if tag in _CLOSED_BY.get(up.tag, ()):
                    node = close(up)
                    if up.tag in ("td", "th", "tr"):
                        up = node
                        continue
                    break
                if up.tag in _SCOPE:
                    break
                up = up.parent
        if tag in _VOID or m[3].endswith("/") and tag not in _BLOCK:
            continue
        if tag in _RAW:
            end = re.compile(rf"</{tag}\s*[^>]*>", re.I).search(html, at)
            at = end.end() if end else n
            continue
        node = _open(tag, m[3], node)
        open_tags[tag] += 1
        nodes.append(node)
    flush()
    return nodes, blocks


def _settle(nodes: list[_Node], pieces: list[tuple[str, _Node]]) -> None:
    """Decide which doubtful elements are out: ``out`` of every element."""
    chars, titles = Counter(), Counter()                             # by the nearest doubtful element; None: outside all
    for raw, node in pieces:
        if not node.link:
            chars[node.near] += len(raw.strip())
    for node in nodes:
        if not node.hard and not node.doubt and node.tag in ("h1", "main", "article"):
            titles[node.near] += 1
    doubtful = [x for x in nodes if x.doubt]
    total = sum(chars.values())
    held, named = {}, {}                                             # with the doubtful elements inside
    for x in reversed(doubtful):
        held[x] = held.get(x, 0) + chars[x]
        named[x] = named.get(x, 0) + titles[x]
        up = x.parent.near
        if up is not None:
            held[up] = held.get(up, 0) + held[x]
            named[up] = named.get(up, 0) + named[x]
    kept, title = chars[None], titles[None]
    lifted = set()
    for x in doubtful:                                               # outer ones first
        if 2 * held[x] > total and (named[x] and not title or 10 * kept < held[x] and x.doubt != "comments"):
            lifted.add(x)
            kept, title = kept + chars[x], title + titles[x]
    for x in nodes:
        x.out = x.hard or (x.parent is not None and x.parent.out) or bool(x.doubt and x not in lifted)


def score_containers(nodes: list[_Node], blocks: list[tuple[str, _Node, int]]) -> list[_Node]:
    """Containers by falling score: a block's text without links counts in full for the nearest, then by halves."""
    for text, owner, links in blocks:
        worth = max(0, len(text) - 3 * links)
        box = owner.box
        while worth >= 1 and box is not None:
            box.score += worth * (1.25 if box.tag in ("article", "main") else 1.0)
            worth /= 2
            box = box.parent.box
    return sorted((x for x in nodes if x.score > 0), key=lambda x: -x.score)


def extract(html: str, path: str | None) -> tuple[str, str | None]:
    """Main text on ``path``, or in the page's own best container; and the path used."""
    nodes, blocks = read(html)
    if not path or not _mark(nodes, blocks, path):
        best = score_containers(nodes, blocks)
        if not best:
            return "\n".join(t for t, _, _ in blocks), None          # text outside all containers
        path = best[0].path
        _mark(nodes, blocks, path)
    inside = [owner.inside for _, owner, _ in blocks]
    first = inside.index(True) if True in inside else 0
    if first and not any(k and o.level == "h1" for (_, o, _), k in zip(blocks, inside)):
        # a title that stands right before the container belongs to it
        if blocks[first - 1][1].level in ("h1", "h2"):
            inside[first - 1] = True
    return "\n".join(t for (t, _, _), k in zip(blocks, inside) if k), path


def _mark(nodes: list[_Node], blocks: list[tuple[str, _Node, int]], path: str) -> bool:
    """Mark the elements on the path and all inside them; is there any text?"""
    key, own = int(path[:16], 16), path[17:]
    for x in nodes:
        x.inside = x.parent is not None and x.parent.inside or x.key == key and x.own == own and x.box is x
    return any(owner.inside for _, owner, _ in blocks)


def host_of(url):
    return F.coalesce(F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1), F.lit(""))


def vote(pages: DataFrame, *, html_col: str = "html", url_col: str = "url") -> DataFrame:
    """``host, path, votes, pages``: each page's containers vote by their score, the best with 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                host, path, votes = [], [], []
                for h, html in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    best = score_containers(*read(html or ""))
                    for x in best:
                        host.append(h)
                        path.append(x.path)
                        votes.append(x.score / best[0].score)
                yield pa.RecordBatch.from_arrays([pa.array(host, pa.string()), pa.array(path, pa.string()),
                                                 pa.array(votes, pa.float64())], names=["host", "path", "votes"])

    rows = pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(run, "host string, path string, votes double").groupBy("host", "path").agg(
        F.sum("votes").alias("votes"), F.count("*").alias("pages"))


def winning_paths(votes: DataFrame) -> DataFrame:
    # rounded: sums of doubles may differ in the last bits between runs; ties go to the lesser path
    return votes.groupBy("host").agg(F.min_by("path", F.struct(-F.round("votes", 6), F.col("path"))).alias("path"))


def main_texts(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars, path`` of every page.

    ``text`` has the article's blocks in page order joined by a line break, white space
    inside a block as one space, character references decoded; menus, headers, footers,
    sidebars, notices, adverts, forms, scripts, styles and reader comments are left out.
    Nothing is capped. Defined cases: null and empty html give an empty text; a null or
    unreadable url votes with host "" ; equal votes go to the lesser path; repeated rows
    are extracted each; an empty table gives an empty result; other columns are not read
    and not returned.
    """
    winners = cut_lineage(winning_paths(vote(pages, html_col=html_col, url_col=url_col)))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html"), host_of(F.col(url_col)).alias("_host"))
    paths = winners.select(F.col("host").alias("_host"), "path")
    if winners.count() <= BROADCAST_HOSTS:
        rows = rows.join(F.broadcast(paths), "_host", "left")
    else:                                                            # a hot host is dealt over the salts
        rows = rows.withColumn("_salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(_SALTS)))
        paths = paths.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1)).cast("array<bigint>")))
        rows = rows.join(paths, ["_host", "_salt"], "left")
    rows = rows.select("page_id", "url", "html", "path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                found = [extract(h or "", p) for h, p in zip(part.column(2).to_pylist(), part.column(3).to_pylist())]
                texts = [t for t, _ in found]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64()), pa.array([p for _, p in found], pa.string())],
                    names=["page_id", "url", "text", "n_chars", "path"])

    kind = rows.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long, path string")
