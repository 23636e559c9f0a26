"""Main text of web pages, with site templates found by counting element subtrees per host.

Every element subtree outside of an article (and every container inside of one) is hashed. Spark counts, for each host, the
distinct pages that hold a subtree; subtrees of at least MIN_PAGES pages and a share of SHARE of the host's pages are the site's template and are deleted. Paragraphs
and headings of an article are never counted as template, so that copies and quoted passages stay. Elements that are
boilerplate by their own name, role or class (menus, forms, adverts, comments and so on) are left out on any page, but not where a mere role,
class or form holds an article (or main element) and most of the page's text.

On a host of at least MIN_PAGES distinct pages all else is the text, in articles or not. Where a host has too few pages to
count, the article elements (else the main element) stand for the text, if there are any.

Null and empty html give an empty text; a null url or one without a host is the host ''. Repeated pages count as one page of
a host and are returned as often as they come. Any length of page is read whole. Broken markup never fails: an end tag that
closes nothing is passed over, and what is open at the end is closed.
"""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm.common import cut, table

#: A subtree on so many distinct pages of a host belongs to its template.
MIN_PAGES = 8
#: ... if they are this share of the host's pages.
SHARE = 0.01
#: The number of a page's root; among its template subtrees it says that its host has enough pages to count.
_COUNTED = 0
_DEALT = 64

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody td tfoot th thead title tr ul".split())
_DROP = frozenset("aside audio button canvas datalist dialog embed fieldset footer form head iframe input label legend math menu nav noscript object optgroup option progress script search select style svg template textarea title video".split())
_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
_WORDS = frozenset("ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice notices pagination popup promo promoted promotion related respond share sharing sidebar signup social sponsor sponsored subscribe subscription toolbar widget widgets".split())
_KEEP = frozenset("html body article main".split())
_CONTAINERS = frozenset("div section ul ol dl table figure center details span".split())
#: An opening tag of the first kind ends an open element of the second, as browsers do.
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"}, "thead": {"caption"}}
_SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select"}, "p": {"td", "th", "li", "button", "caption", "object"}}
_P_ENDS = _BLOCK - {"body", "html", "option", "legend", "caption", "td", "th", "tr", "tbody", "thead", "tfoot", "title"}
_SPLIT = re.compile(r"[^a-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
_SPACE = re.compile(r"\s+")
_OPENS = re.compile(r"<[A-Za-z/!?]")


class Node:
    __slots__ = ("at", "tag", "marks", "kids", "drop", "soft")

    def __init__(self, at: int, tag: str, attrs: list):
        self.at, self.tag, self.kids = at, tag, []
        had = {k: v or "" for k, v in attrs}
        self.marks = " ".join(had.get(k, "") for k in ("class", "id", "role"))
        hard = tag in _DROP and tag != "form"
        self.drop = hard or tag == "form" or (tag not in _KEEP and self._boilerplate(had)) or (tag == "article" and bool(_WORDS & self._tokens(had)))
        self.soft = self.drop and not hard and tag != "article" and "hidden" not in had

    @staticmethod
    def _tokens(had: dict) -> set:
        return set(_SPLIT.split(_CAMEL.sub(" ", f"{had.get('class', '')} {had.get('id', '')}").lower()))

    def _boilerplate(self, had: dict) -> bool:
        if not had:
            return False
        hidden = "hidden" in had or had.get("aria-hidden") == "true" or "display:none" in had.get("style", "").replace(" ", "")
        return hidden or had.get("role", "").lower() in _ROLES or bool(_WORDS & self._tokens(had))


class _Tree(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node(_COUNTED, "", [])
        self.open, self.count, self.named = [self.root], 1, Counter()
        self.wrappers: dict[int, Node] = {}

    def handle_starttag(self, tag, attrs):
        if tag in _P_ENDS:
            self._end({"p"}, _SCOPE["p"])
        if tag in _ENDS:
            self._end(_ENDS[tag], _SCOPE.get(tag, {"table"}))
        node = Node(self.count, tag, attrs)
        self.count += 1
        if tag in ("article", "main"):
            self.wrappers.update((n.at, n) for n in self.open if n.soft)
        self.open[-1].kids.append(node)
        if tag not in _VOID:
            self.open.append(node)
            self.named[tag] += 1

    def _close(self, at):
        self.named.subtract(n.tag for n in self.open[at:])
        del self.open[at:]

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID and tag not in _BLOCK:
            self.handle_endtag(tag)

    def _end(self, tags, scope):
        if not any(self.named[t] for t in tags):
            return
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag in tags:
                self._close(i)
                return
            if self.open[i].tag in scope or self.open[i].tag in _KEEP:
                return

    def handle_endtag(self, tag):
        if not self.named[tag]:
            return
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                self._close(i)
                return
            if self.open[i].tag in ("article", "main", "td", "th", "nav", "footer", "aside") and tag not in ("html", "body", "article", "main", "table", "tr", "div", "section"):
                return

    def handle_data(self, data):
        self.open[-1].kids.append(data)


def parse(html: str) -> Node:
    # A tag or comment that the page's end cuts off is dropped, as browsers do.
    cut_off = _OPENS.search(html, html.rfind(">") + 1)
    tree = _Tree()
    tree.feed(html[:cut_off.start()] if cut_off else html)
    tree.close()
    for node in tree.wrappers.values():
        node.drop = 2 * _length(node) <= _length(tree.root)
    return tree.root


def _length(node: Node) -> int:
    """Characters of text below a node, without what has no text of its own kind."""
    total, stack = 0, [node]
    while stack:
        for k in stack.pop().kids:
            if isinstance(k, str):
                total += len(k.strip())
            elif k.tag not in ("script", "style", "template", "noscript"):
                stack.append(k)
    return total


def subtrees(root: Node) -> list[tuple[int, int]]:
    """(number, hash) of the subtrees that a template may hold. Deep trees are walked without recursion."""
    found, hashes = [], {}
    stack = [(root, False, False, False)]
    while stack:
        node, inside, under, done = stack.pop()
        if done:
            parts = [f"<{node.tag} {node.marks}>"]
            parts += [_SPACE.sub(" ", k).strip() if isinstance(k, str) else f"#{hashes.pop(k.at)}" for k in node.kids]
            hashes[node.at] = h = xxhash.xxh64_intdigest("\x1f".join(parts).encode("utf-8", "surrogatepass")) - (1 << 63)
            if node.tag not in _KEEP and node.tag and not under and (not inside or node.tag in _CONTAINERS):
                found.append((node.at, h))
            continue
        stack.append((node, inside, under, True))
        inside_now, under_now = inside or node.tag == "article", under or node.drop
        stack.extend((k, inside_now, under_now, False) for k in node.kids if not isinstance(k, str))
    return found


def _tops(root: Node, tag: str, gone: frozenset) -> list[Node]:
    """The outermost elements of a name that are not dropped, in page order."""
    found, stack = [], [root]
    while stack:
        node = stack.pop()
        if node.drop or node.at in gone:
            continue
        if node.tag == tag:
            found.append(node)
            continue
        stack.extend(k for k in reversed(node.kids) if not isinstance(k, str))
    return found


def main_text(root: Node, gone: frozenset = frozenset()) -> str:
    """The text without dropped subtrees: of the whole page where its host was counted, else of its articles, else of its main element, else of all."""
    tops = [root] if _COUNTED in gone else _tops(root, "article", gone) or _tops(root, "main", gone) or [root]
    found, now = [], []

    def flush():
        text = _SPACE.sub(" ", "".join(now)).strip()
        now.clear()
        if text:
            found.append(text)

    for top in tops:
        stack = [(top, False)]
        while stack:
            item, inside = stack.pop()
            if item is None:
                flush()
            elif isinstance(item, str):
                now.append(item)
            elif item.tag == "br":
                now.append(" ")
            elif item is top or not (item.drop or item.at in gone or item.tag == "header" and not inside):
                if item.tag in _BLOCK:
                    flush()
                    stack.append((None, inside))
                inside = inside or item.tag in ("article", "main")
                stack.extend((k, inside) for k in reversed(item.kids))
        flush()
    return "\n".join(found)


def _host(url):
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))


def extract(pages: DataFrame, id_col: str = "page_id", min_pages: int = MIN_PAGES) -> DataFrame:
    """id_col, url and html in; id_col, url, text and n_chars out, a row per page.

    Subtrees are counted as (host, hash) pairs after a count per task, so that a hot host is dealt out by hash. A page's
    numbers of template subtrees, bounded by the page, come back to it by a join on host and content digest.
    """
    kind = pages.schema[id_col].dataType.simpleString()
    rows = pages.select(F.col(id_col).alias("id"), "url", F.coalesce("html", F.lit("")).alias("html")).withColumn("host", _host(F.col("url"))).withColumn("page", F.unhex(F.md5(F.concat_ws("\0", "host", "html").cast("binary"))))

    def hash_pages(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                out = ([], [], [], [])
                part = batch.slice(at, 64)
                for host, page, html in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    # The root is counted under a hash of its own, once a page: the pages of the host.
                    for node, h in [(_COUNTED, 0), *subtrees(parse(html))]:
                        for column, value in zip(out, (host, page, node, h), strict=True):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.binary()), pa.array(out[2], pa.int32()), pa.array(out[3], pa.int64())], names=["host", "page", "node", "hash"])

    nodes = cut(rows.select("host", "page", "html").mapInArrow(hash_pages, "host string, page binary, node int, hash long"))
    # Distinct pages of a (host, hash): a page is one row here however often the subtree or the page itself is repeated.
    seen = nodes.groupBy("host", "hash", "page").agg(F.count("*").alias("n"))
    counted = cut(seen.groupBy("host", "hash").agg(F.count("*").alias("pages")).filter(F.col("pages") >= min_pages))
    # A host's root is counted once a page: the pages of the host.
    hosts = counted.filter("hash = 0").select("host", F.col("pages").alias("of"))
    template = counted.join(hosts, "host").filter(F.col("pages") >= SHARE * F.col("of")).select("host", "hash")
    # A host's roots are one key, which is dealt to _DEALT parts.
    dealt = nodes.withColumn("part", F.when(F.col("node") == _COUNTED, F.pmod(F.xxhash64("page"), F.lit(_DEALT)).cast("int")).otherwise(0))
    template = template.withColumn("part", F.explode(F.when(F.col("hash") == 0, F.sequence(F.lit(0), F.lit(_DEALT - 1))).otherwise(F.array(F.lit(0)))))
    marks = dealt.join(template, ["host", "hash", "part"], "left_semi").groupBy("page").agg(F.collect_set("node").alias("gone"))

    def text_of(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                texts = [main_text(parse(html), frozenset(gone or ())) for html, gone in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[id_col, "url", "text", "n_chars"])

    return rows.join(marks, "page", "left").select("id", "url", "html", "gone").mapInArrow(text_of, f"`{id_col}` {kind}, url string, text string, n_chars long")


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
