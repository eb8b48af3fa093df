"""HTML extraction by a site style tree.

Method. The pages of a host are merged into one style tree: a node is a path of elements, each with
its tag, class, id and role. Over a host's pages, each node has a presentation importance, the
entropy of its sequences of children, and a content importance, one less the mean share of the
pages over which its texts are spread as an entropy; both are to the base of the node's pages, and
a node's importance blends its presentation with the content of its branch. It is shrunk towards what
is thought of a node without evidence, 1 or for noise names 0, as by `PRIOR_PAGES` pages more: so a
branch that is the same on all of five pages goes and one on two stays, without a switch. Branches of
low importance are removed from each page. Pages of a host with the same undeclared blocks count once, so copies of a page are no evidence. A
branch that holds all undeclared text of a page is not removed from it, and no removal leaves a page
without text that it had.

Elements that their tag, role or hidden attribute declare to be menu, footer, form and the like are
never text. Class and id names of notices, adverts, comments and the like are a prior of 0, blended by
half with the node's content times the share of the pages' text in its branch: a branch that is
nearly all of a host's text is kept in spite of its names. Without statistics the prior decides,
unless it would take all text of a page. `article` and `main` are kept and branches below them are
judged like any other. Text outside is not part of a page that has text inside them, unless what is
inside is a teaser: less than `TEASER` of the text outside, and that `LEAST_OUTSIDE` characters at least.

Only (host, path, feature) counts are merged, with map-side aggregation, so a large host is no
task's burden; pages meet the paths to remove by a join on the host, where they stay while those
paths are few.

Input cases. html null or empty: no text. A null or odd url: the host is '', whose pages need have
nothing in common and are in no style tree. One page of a host, or few: declared and named nodes alone are removed. Broken markup: end tags without a start are passed over,
open elements end with the page. Elements nested deeper than `MOST_DEPTH` are part of the one at that
depth. Repeated rows give repeated rows. Other columns are ignored,
whatever their names.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dirlens.llm import tables

PRIOR_PAGES, LEAST_IMPORTANCE, GAMMA = 1, 0.2, 0.9
NAME_WEIGHT, TEASER, LEAST_OUTSIDE = 0.5, 0.5, 200
#: Elements in each other that the tree tells apart; a path has so many numbers at most.
MOST_DEPTH = 256
#: Paths to turn, of 8 bytes each and their hosts, up to which they are broadcast; more are joined.
BROADCAST_PATHS = 50_000

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*+)>"
    r"|<[!?][^>]*+>",
    re.S,
)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
WORD = re.compile(r"[a-z]+")

# Fixed names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe xmp noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
ENDS_SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "thead": ("thead", "tbody", "tr", "td", "th"), "tbody": ("thead", "tbody", "tr", "td", "th"), "tfoot": ("thead", "tbody", "tr", "td", "th")}
SCOPE = frozenset("html body table td th ul ol dl select div article section main nav aside header footer form".split())
#: Elements that are never part of the main text.
DECLARED = frozenset("head nav footer aside form button select dialog menu svg canvas object applet audio video math template fieldset".split()) | RAW
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
NAMES = frozenset(
    "ad ads adsense advert adverts advertisement advertising alert aside banner breadcrumb breadcrumbs consent cookie cookies copyright disclaimer footer form gdpr legal login masthead menu menubar modal nav navbar navigation newsletter notice notices notification overlay pager pagination popup promo promotion recommended related search share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar widget".split()
)
COMMENTS = frozenset("comment comments commentlist disqus reader respond reply replies".split())

_paths: dict[tuple[int, str, str], int] = {}


def path(parent: int, tag: str, names: str) -> int:
    """A 63-bit number of a path, from its parent's and its last element."""
    key = (parent, tag, names)
    if key not in _paths:
        if len(_paths) > 200_000:
            _paths.clear()
        _paths[key] = int.from_bytes(hashlib.blake2b(f"{parent}\0{tag}\0{names}".encode("utf-8", "replace"), digest_size=8).digest(), "big") >> 1
    return _paths[key]


def feature(x: str) -> int:
    return int.from_bytes(hashlib.blake2b(x.encode("utf-8", "replace"), digest_size=8).digest(), "big") >> 1


class Page:
    """Blocks of a page in order: (text, all paths to it, in main?, declared?, paths down to its main); the paths of noise names."""

    def __init__(self, source: str):
        self.blocks: list[tuple[str, tuple[int, ...], bool, bool, int]] = []
        self.named: set[int] = set()
        self.children: dict[int, list[str]] = {}
        # tag, paths from the root, in main?, declared?, paths down to the main that is not judged
        self.stack: list[tuple[str, tuple[int, ...], bool, bool, int]] = [("", (0,), False, False, 1)]
        self.pieces: list[str] = []
        self.main_seen = False
        at, raw = 0, ""
        for token in TOKEN.finditer(source):
            if token.start() < at:
                continue
            tag = (token[2] or token[5] or "").lower()
            if raw:
                if not ((token[1] or token[4]) and tag == raw):
                    continue
                raw = ""
                self.end(tag)
                at = token.end()
                continue
            if token.start() > at:
                self.pieces.append(source[at : token.start()])
            at = token.end()
            if not tag:
                continue
            if token[1] or token[4]:
                self.end(tag)
            else:
                self.start(tag, token[3] or token[6] or "")
                if tag in RAW:
                    raw = tag
        if not raw:
            self.pieces.append(source[at:])
        self.close_block()

    def close_block(self) -> None:
        if self.pieces:
            text = " ".join(html.unescape("".join(self.pieces)).split())
            self.pieces = []
            if text:
                self.blocks.append((text, *self.stack[-1][1:]))

    def pop(self, tags: tuple[str, ...]) -> None:
        """Close the innermost open element of these tags, if no other scope lies between."""
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i][0] in tags:
                self.close_block()
                del self.stack[i:]
                return
            if self.stack[i][0] in SCOPE:
                return

    def start(self, tag: str, attributes: str) -> None:
        if tag in INLINE and not attributes:
            return
        if tag == "br" or tag not in INLINE:
            self.close_block()
        if tag in ENDS_P:
            self.pop(("p",))
        if tag in ENDS_SAME:
            for _ in range(3):
                self.pop(ENDS_SAME[tag])
        if tag in VOID:
            return
        found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attributes)} if attributes.strip() else {}
        names = f"{found.get('class', '')} {found.get('id', '')}".lower()
        role = found.get("role", "").lower()
        _, paths, main, declared, base = self.stack[-1]
        words = frozenset(WORD.findall(names))
        hidden = "hidden" in found
        named = bool(words & COMMENTS)
        if tag in INLINE:
            if not named and not hidden:
                return
            self.close_block()
        is_main = tag in ("article", "main") or role == "main"
        noise = tag in DECLARED or role in ROLES or hidden or "display:none" in found.get("style", "").replace(" ", "").lower() or not main and tag == "header"
        named = tag not in ("html", "body") and (named or not is_main and (bool(words & NAMES) or not main and "header" in words))
        deep = len(paths) > MOST_DEPTH
        here = paths if deep else (*paths, path(paths[-1], tag, f"{names.strip()} {role}"))
        if named and not deep:
            self.named.add(here[-1])
        if is_main and not noise and not named:
            below = declared or not self.named.isdisjoint(paths[base:])
            if not below or not self.main_seen:
                declared, base, self.main_seen = False, len(here), True
        self.children.setdefault(paths[-1], []).append(tag)
        self.stack.append((tag, here, main or is_main, declared or noise, base))

    def end(self, tag: str) -> None:
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i][0] == tag:
                self.close_block()
                del self.stack[i:]
                return
            if self.stack[i][0] in ("table", "td", "th") and tag not in SCOPE:
                return

    def text(self, turned: frozenset[int] = frozenset()) -> str:
        """The main text. turned: paths to remove, and of those with noise names the ones to keep."""
        good = [b for b in self.blocks if not b[3]]
        if not good:
            return ""
        low = self.named ^ turned
        low -= frozenset.intersection(*(frozenset(b[1]) for b in good)) - self.named
        kept = [b for b in good if low.isdisjoint(b[1][b[4] :])]
        if not kept:
            low = self.named - turned
            kept = [b for b in good if low.isdisjoint(b[1][b[4] :])] or good
        inside = [b[0] for b in kept if b[2]]
        outside = sum(len(b[0]) for b in kept if not b[2])
        if not inside or outside >= LEAST_OUTSIDE and sum(map(len, inside)) < TEASER * outside:
            return " ".join(b[0] for b in kept)
        return " ".join(inside)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, html) to (host, page, nodes): the hash of a page's undeclared blocks, and of each of their nodes
    path, kind, feature, ancestors and share: kind 0 a text of the node, with its ancestors and itself, 1 its
    children, 2 those of a node with a noise name; each once a page. share: thousandths of the page's text in a named node's branch, else 0."""
    node = pa.struct([("path", pa.int64()), ("kind", pa.int32()), ("feature", pa.int64()), ("ancestors", pa.list_(pa.int64())), ("share", pa.int64())])
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            numbers, nodes = [], []
            for source in batch.column(1).slice(at, 256).to_pylist():
                page = Page(source or "")
                good = [(text, paths) for text, paths, _, declared, _ in page.blocks if not declared]
                chars: dict[int, int] = {}
                for text, paths in good:
                    for p in page.named.intersection(paths):
                        chars[p] = chars.get(p, 0) + len(text)
                whole = sum(len(text) for text, _ in good)
                seen = {(paths[-1], 0, feature(text)): paths[1:] for text, paths in good}
                for p in {p for _, paths in good for p in paths[1:]}:
                    seen[p, 2 if p in page.named else 1, feature(" ".join(page.children.get(p, [])))] = ()
                numbers.append(feature("\0".join(f"{paths[-1]} {text}" for text, paths in good)))
                nodes.append([{"path": p, "kind": kind, "feature": f, "ancestors": list(ancestors), "share": 1000 * chars.get(p, 0) // whole if kind else 0} for (p, kind, f), ancestors in seen.items()])
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, 256), pa.array(numbers, pa.int64()), pa.array(nodes, pa.list_(node))], names=["host", "page", "nodes"])


def host_of(url: str = "url") -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def style_tree(pages: DataFrame) -> DataFrame:
    """host, path, named (a noise name?), distinct pages, presentation, content and importance of every node of pages (url, html)."""
    found = pages.select(host_of().alias("host"), "html").where("host <> ''").mapInArrow(_features, "host string, page long, nodes array<struct<path:long,kind:int,feature:long,ancestors:array<long>,share:long>>")
    rows = found.dropDuplicates(["host", "page"]).select("host", F.inline("nodes"))
    counts = tables.cut(rows.groupBy("host", "path", "kind", "feature", "ancestors").agg(F.count("*").alias("n"), F.sum("share").alias("share")))
    shape, n = F.col("kind") > 0, F.col("n")
    nodes = counts.groupBy("host", "path").agg(
        (F.max("kind") == 2).alias("named"),
        (F.sum("share") / 1000 / F.sum(F.when(shape, n))).alias("share"),
        F.sum(F.when(shape, n)).alias("pages"),
        F.count(F.when(shape, n)).alias("styles"),
        F.sum(F.when(shape, n * F.log(n))).alias("shape_log"),
        F.coalesce(F.sum(F.when(~shape, n)), F.lit(0)).alias("texts"),
        F.coalesce(F.sum(F.when(~shape, n * F.log(n))), F.lit(0.0)).alias("text_log"),
    )
    base = F.greatest(F.log("pages"), F.lit(1e-9))
    nodes = nodes.withColumn("presentation", F.when(F.col("pages") > 1, (base - F.col("shape_log") / F.col("pages")) / base).otherwise(1.0))
    nodes = nodes.withColumn("own", F.when(F.col("pages") > 1, F.col("texts") - F.col("text_log") / base).otherwise(F.col("texts")))
    below = counts.where("kind = 0").select("host", "path", "ancestors").distinct().join(nodes.select("host", "path", "own", "texts"), ["host", "path"])
    branch = below.select("host", F.explode("ancestors").alias("path"), "own", "texts").groupBy("host", "path").agg(F.sum("own").alias("own"), F.sum("texts").alias("texts"))
    content = F.when(F.coalesce(F.col("branch.texts"), F.lit(0)) > 0, F.greatest(F.lit(0.0), F.col("branch.own") / F.col("branch.texts"))).otherwise(0.0)
    even = F.pow(F.lit(GAMMA), F.col("styles"))
    blend = F.when(F.col("named"), (1 - NAME_WEIGHT) * content * F.col("share")).otherwise((1 - even) * F.col("presentation") + even * content)
    prior = F.when(F.col("named"), 0.0).otherwise(1.0)
    shrunk = (F.col("pages") * blend + PRIOR_PAGES * prior) / (F.col("pages") + PRIOR_PAGES)
    joined = nodes.alias("node").join(branch.alias("branch"), ["host", "path"], "left")
    return joined.select("host", "path", "named", "pages", "presentation", content.alias("content"), shrunk.alias("importance"))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url and text, the main text, of every row of pages (page_id, url, html)."""
    low = F.col("importance") < LEAST_IMPORTANCE
    paths = tables.cut(style_tree(pages).where(low != F.col("named")).select("host", "path"))
    turned = paths.groupBy("host").agg(F.collect_set("path").alias("turned"))
    if paths.count() <= BROADCAST_PATHS:
        turned = F.broadcast(turned)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [Page(x or "").text(frozenset(y or ())) for x, y in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", host_of().alias("host")).join(turned, "host", "left")
    return rows.select("page_id", "url", "html", "turned").mapInArrow(work, "page_id long, url string, text string")


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract(tables.read(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
