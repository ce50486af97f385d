"""Main text of web pages, with site templates removed by subtree counts.

A page is read once, leniently, into text blocks.  Every block-level element
is a subtree with a hash over its tag, its text and its children's hashes.  Spark counts,
per host, on how many different pages each subtree occurs; subtrees on at least ``MIN_SHARE``
of the host's different pages, and on ``MIN_PAGES`` at least, are the site's template and
their blocks go.  Elements that are
no article by their name or class (menus, footers, forms, comments, ...) go
at once.

Where a page marks its article (``article`` or ``main``), only that is
read, and its own paragraphs, headings, lists and tables are content even when
they recur on the site, also inside of neutral containers (``div``, ``section``, ...): a template
is then looked for among the texts that stand in such a container directly.  Without such an element, every block outside the named
containers is content unless it is template.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from hashlib import blake2b
from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: Different pages of a host on which a template subtree occurs at least, and their share of all of its different pages.
MIN_PAGES = 10
MIN_SHARE = 0.5
#: Blocks and pages to drop from, up to which they are broadcast.
BROADCAST_BLOCKS = 1_000_000

# Element names of HTML by their part in a page.
RAW = {"script", "style", "textarea", "title", "iframe", "noembed", "noframes", "xmp", "template", "noscript", "svg", "math", "object"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "div", "dl",
         "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header",
         "html", "legend", "li", "main", "menu", "nav", "ol", "option", "p", "pre", "section", "select", "summary",
         "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
LEAVES = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "td", "th", "pre", "caption", "figcaption", "summary", "option"}
CONTENT = LEAVES | {"article", "main", "ul", "ol", "dl", "table", "tbody", "thead", "tfoot", "tr", "blockquote", "figure"}
#: Containers that say nothing about what they hold.
NEUTRAL = {"div", "section", "header", "center", "details"}
DROPPED = {"head", "nav", "footer", "aside", "form", "menu", "dialog", "select", "fieldset", "button"}
# Words of a class, id or role that name something other than the article.
NAMES = {"ad", "ads", "advert", "advertisement", "adverts", "banner", "sponsor", "sponsored", "promo", "promotion", "nav",
         "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "sidebar", "footer", "cookie", "cookies", "consent",
         "notice", "newsletter", "subscribe", "share", "sharing", "social", "related", "recommended", "comment", "comments",
         "disqus", "replies", "popup", "modal", "widget", "pagination", "pager", "toolbar", "masthead", "search", "login",
         "complementary", "contentinfo", "alert"}
# What each of these start tags ends when it is still open, up to the nearest of the second set.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "option": ({"option"}, {"select"})}

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<[a-zA-Z/!?][^>]*(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
INVISIBLE = re.compile(r"display\s*:\s*none")
#: Tags that hold or head the article, whatever their class says.
UNNAMED = {"html", "body", "article", "main", "h1", "h2", "h3", "h4", "h5", "h6"}
#: A class with such a beginning says what is or is not elsewhere on the page.
ELSEWHERE = ("no-", "has-", "with-", "without-")
#: The end of the attributes of a tag that closes itself.
EMPTY = re.compile(r"""(?:^|["'\s])/\s*\Z""")


def named_otherwise(tag: str, attributes: str) -> bool:
    """Whether class, id or role name something other than the article, or it is hidden.  The id of a paragraph, an item or a cell, which is
    often generated from its text, says nothing."""
    if "=" not in attributes and "hidden" not in attributes:
        return False
    for m in ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "hidden" or name == "aria-hidden" and value.strip() == "true" or name == "style" and INVISIBLE.search(value):
            return True
        if tag in UNNAMED or not (name in ("class", "role") or name == "id" and tag not in LEAVES):
            continue
        if any(w in NAMES for c in value.split() if not c.startswith(ELSEWHERE) for w in re.split(r"[^a-z0-9]+", c)):
            return True
    return False


#: Whether an element is the article's: not known; a neutral container of it; its content, which is no template.
OTHER, INSIDE, CONTENTS = range(3)


class Node:
    """An open element: its running hash, and what blocks in it are subject to."""
    __slots__ = ("tag", "digest", "first", "drop", "main", "safe", "inline")

    def __init__(self, tag: str, first: int, drop: bool, main: bool, safe: int, inline: bool):
        self.tag, self.first, self.drop, self.main, self.safe, self.inline = tag, first, drop, main, safe, inline
        self.digest = blake2b(tag.encode(), digest_size=8)


def read_page(page: str) -> tuple[list[tuple[str, bool]], list[tuple[int, int, int]], list[int]]:
    """Blocks in page order, as text and whether it stays in any case; the subtrees that may be
    template as (hash, first block, block after the last); and the page's distinct subtree hashes.
    Time and size are linear in the page, however deep it nests."""
    texts: list[str] = []          # block texts
    kinds: list[tuple] = []        # per block: (dropped, in main, is content)
    removable: list[tuple] = []    # per subtree: hash, first block, end, in main
    subtrees: set[int] = set()
    stack = [Node("", 0, False, False, OTHER, False)]
    opened: dict[str, list[int]] = defaultdict(list)  # depths of open elements by tag
    held: list[str] = []
    has_main = False

    def end_block() -> None:
        if held:
            text = " ".join(html.unescape("".join(held)).split())
            held.clear()
            if text:
                top = stack[-1]
                texts.append(text)
                kinds.append((top.drop, top.main, top.safe == CONTENTS))
                top.digest.update(text.encode("utf-8", "surrogatepass"))

    def push(node: Node) -> None:
        opened[node.tag].append(len(stack))
        stack.append(node)

    def pop() -> None:
        node = stack.pop()
        opened[node.tag].pop()
        if node.inline:
            return
        raw = node.digest.digest()
        stack[-1].digest.update(raw)
        key = int.from_bytes(raw, "little", signed=True)
        if node.first < len(texts):
            subtrees.add(key)
            if node.safe != CONTENTS and (node.main or not has_main):  # what holds an article is no template
                removable.append((key, node.first, len(texts)))

    def close(depth: int) -> None:
        while len(stack) > depth:
            pop()

    at = 0
    while True:
        m = TAG.search(page, at)
        held.append(page[at:m.start()] if m else page[at:])
        if not m:
            break
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            if opened[tag]:
                end_block()
                close(opened[tag][-1])
            elif tag == "br":
                held.append(" ")
            continue
        if tag in RAW:
            if not m[3].rstrip().endswith("/") or tag in ("script", "style"):
                end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                at = end.end() if end else len(page)
            continue
        if tag in VOID:
            held.append(" ")
            if tag == "hr":
                end_block()
            continue
        inline = tag not in BLOCK
        otherwise = tag == "button" or named_otherwise(tag, m[3])
        if inline and otherwise and EMPTY.search(m[3]):
            continue
        if inline and not otherwise:
            if tag in ("span", "a") or opened[tag]:
                # their ends must match even so
                push(Node(tag, len(texts), stack[-1].drop, stack[-1].main, stack[-1].safe, True))
            continue
        end_block()
        if not inline:
            while len(stack) > 1 and (stack[-1].tag in ("p", "span", "a") or stack[-1].inline):
                pop()
            if tag in ENDS:
                same, stop = (max((opened[t][-1] for t in tags if opened[t]), default=0) for tags in ENDS[tag])
                if same > stop:
                    close(same)
        up = stack[-1]
        main = up.main or (tag in ("article", "main") and not up.drop)
        has_main |= main
        drop = up.drop or tag in DROPPED or otherwise or (tag == "header" and not up.main)
        safe = OTHER
        if main and tag in CONTENT:
            safe = CONTENTS if up.safe or tag in ("article", "main") else OTHER
        elif main and tag in NEUTRAL:  # its own text is content inside of a list item, a cell, a quotation
            safe = min(up.safe, INSIDE) if up.tag in ("article", "main") else up.safe
        push(Node(tag, len(texts), drop, main, safe, False))
    end_block()
    close(1)
    read = [not drop and (main or not has_main) for drop, main, _ in kinds]
    blocks = [(t, content) for t, (_, _, content), r in zip(texts, kinds, read) if r]
    before = list(accumulate(read, initial=0))  # blocks that are read, before each
    spans = {(key, before[first], before[end]) for key, first, end in removable}
    return blocks, sorted((k, a, b) for k, a, b in spans if a < b), sorted(subtrees)


def host_of(url) -> F.Column:
    """Host of a URL in lower case; empty for null or none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def parsed(pages: DataFrame) -> DataFrame:
    """Each page with its blocks, the subtrees that may be template, all its distinct subtrees and a hash of all its text."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    ddl = (f"page_id {pages.schema['page_id'].dataType.simpleString()}, url {pages.schema['url'].dataType.simpleString()}, "
           "host string, blocks array<struct<text:string,stays:boolean>>, spans array<struct<key:bigint,first:int,stop:int>>, "
           "subtrees array<bigint>, page_hash long")
    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def run(frames):
        import pyarrow as pa
        for frame in frames:
            for at in range(0, frame.num_rows, 500):
                part = frame.slice(at, 500)
                rows = {c: part[c].to_pylist() for c in ("page_id", "url", "host")}
                found = [read_page(h or "") for h in part["html"].to_pylist()]
                rows["blocks"] = [[{"text": t, "stays": c} for t, c in b] for b, _, _ in found]
                rows["spans"] = [[{"key": k, "first": a, "stop": e} for k, a, e in s] for _, s, _ in found]
                rows["subtrees"] = [s for _, _, s in found]
                rows["page_hash"] = [int.from_bytes(blake2b("\0".join(t for t, _ in b).encode("utf-8", "surrogatepass"),
                                                            digest_size=8).digest(), "little", signed=True) for b, _, _ in found]
                yield pa.RecordBatch.from_pydict(rows, schema=schema)
    return pages.select("page_id", "url", host_of(F.col("url")).alias("host"), "html").mapInArrow(run, ddl)


def main_text(pages: DataFrame, *, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html): ``page_id``, ``url``
    and ``text``, the blocks of the article joined by an empty line.

    White space within a block is one blank; character references are decoded.  Null and
    empty html, and pages of nothing but template, give an empty text.  A
    null or relative URL belongs to the host "".  Pages of equal article text
    (repeated rows, one article under several URLs) count as one page of their host, so
    copies do not make an article a template.  Very long and very deep pages are read
    whole, in time linear in the page.  Ties do not arise: a share of exactly ``min_share`` is
    enough.  Empty table: no rows.  Other columns are not read.
    """
    rows = written(parsed(pages).withColumn("row", F.monotonically_increasing_id()), "pages")
    hosts = written(rows.select("host", "page_hash").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
                    .where(F.col("pages") >= min_pages), "hosts")
    hosts = F.broadcast(hosts) if hosts.count() <= BROADCAST_BLOCKS else hosts
    templates = (rows.select("host", "page_hash", F.explode("subtrees").alias("key")).distinct()
                 .groupBy("host", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_pages)
                 .join(hosts, "host").where(F.col("n") >= F.col("pages") * min_share).select("host", "key"))
    # the outermost template subtrees of each page; subtrees nest, so the others lie within
    outer = Window.partitionBy("row").orderBy("first", F.desc("stop")).rowsBetween(Window.unboundedPreceding, -1)
    marked = (rows.select("row", "host", F.explode("spans").alias("s")).select("row", "host", "s.*")
              .join(templates, ["host", "key"], "left_semi").withColumn("until", F.max("stop").over(outer))
              .where("until IS NULL OR first >= until")
              .groupBy("row").agg(F.flatten(F.collect_list(F.sequence("first", F.col("stop") - 1))).alias("gone")))
    marked = written(marked, "marked")
    size = marked.agg(F.sum(F.size("gone") + 1)).first()[0] or 0
    # pages without an article element have such blocks; few of them need not move the texts
    marked = F.broadcast(marked) if size <= BROADCAST_BLOCKS else marked
    # positions by set operations, which are linear
    places = F.when(F.size("blocks") > 0, F.sequence(F.lit(0), F.size("blocks") - 1)).otherwise(F.array().cast("array<int>"))
    stay = F.filter(F.transform("blocks", lambda b, i: F.when(b["stays"], i)), lambda i: i.isNotNull())
    kept = F.array_except(places, F.array_except("gone", stay))
    text = F.when(F.col("gone").isNull(), F.array_join("blocks.text", "\n\n")).otherwise(
        F.array_join(F.transform(kept, lambda i: F.col("blocks")[i]["text"]), "\n\n"))
    return rows.join(marked, "row", "left").select("page_id", "url", text.alias("text"))
