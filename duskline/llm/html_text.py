"""Main text of web pages, with nearest-URL page differencing."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duskline.llm.common import bounded_batches, numbered, staged, text_of

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<more>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<more2>[^>]*+)>",
    re.S,
)
_SPACE = re.compile(r"[\x20\x09-\x0D]+")
# Elements that are not the article, whatever they hold.
_ASIDE = frozenset(
    "head title nav header footer aside form script style noscript template svg iframe object canvas select button "
    "textarea dialog menu audio video".split()
)
_RAW = frozenset(("script", "style", "textarea", "title", "noscript", "iframe"))
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Words in a class, id or role that mark a part which is not the article.
_NAMED = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|sponsor\w*|promo\w*|banner|sidebar|widget|comments?|respond|disqus|menu|nav|navbar"
    r"|navigation|breadcrumbs?|header|footer|masthead|cookies?|consent|notices?|alert|popup|modal|newsletter|subscribe"
    r"|share|sharing|social|related|recommended|pagination|pager|toolbar|login|signup|complementary|contentinfo)(?=$|[\s_-])",
    re.I,
)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?=$|[\s=/])|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
_MAIN = re.compile(r"\brole\s*=\s*[\"']?main\b", re.I)

ARTICLE, LOOSE, ASIDE = 2, 1, 0


def blocks(page: str | None) -> list[tuple[str, int]]:
    """The text blocks of a page in order, each with its zone.

    ``ASIDE`` is inside an element that is never the article (by tag, name or being
    hidden), ``ARTICLE`` inside an article or main element, ``LOOSE`` anything else.
    Character references are decoded, white space in a block becomes one space.
    """
    page = page or ""
    out: list[tuple[str, int]] = []
    held: list[str] = []
    stack: list[tuple[str, int]] = []  # open elements with the zone inside them
    zone = LOOSE

    def flush() -> None:
        if held:
            line = _SPACE.sub(" ", html.unescape("".join(held))).strip(" ")
            held.clear()
            if line:
                out.append((line, zone))

    at = 0
    while at < len(page):
        found = _TOKEN.search(page, at)
        if not found:
            break
        if found.start() > at:
            held.append(page[at : found.start()])
        at = found.end()
        tag = found["tag"] or found["tag2"]
        if not tag:
            continue
        tag, more = tag.lower(), found["more"] or found["more2"] or ""
        closing = bool(found["end"] or found["end2"])
        if tag not in _INLINE:
            flush()
        if closing:
            if any(name == tag for name, _ in stack):
                flush()
                while stack.pop()[0] != tag:
                    pass
                zone = stack[-1][1] if stack else LOOSE
            continue
        if tag in _VOID:
            continue
        if tag in _RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        names = " ".join(a or b or c for a, b, c in _NAMES.findall(more)) if more else ""
        inner = zone
        if zone != ASIDE:
            whole = tag in ("html", "body")
            if tag in _ASIDE or not whole and (names and _NAMED.search(names) or more and _HIDDEN.search(more)):
                inner = ASIDE
            elif tag in ("article", "main") or _MAIN.search(more):
                inner = ARTICLE
        if inner != zone or tag not in _INLINE and tag not in ("p", "li", "dt", "dd", "tr", "td", "th", "option"):
            if inner != zone:
                flush()
            # A paragraph of another zone ends where the next block begins.
            while stack and stack[-1][0] == "p" and tag not in _INLINE:
                stack.pop()
            if stack and tag not in _INLINE and inner == zone:
                inner = stack[-1][1]
            stack.append((tag, inner))
            zone = inner
        elif tag == "p" and stack and stack[-1][0] == "p":
            stack.pop()
            zone = stack[-1][1] if stack else LOOSE
    if at < len(page):
        held.append(page[at:])
    flush()
    return out


def _rows(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Lengths of the longest common subsequence of ``a`` and each prefix of ``b``."""
    best = np.zeros(len(b) + 1, dtype=np.int32)
    for x in a:
        best[1:] = np.maximum.accumulate(np.maximum(best[1:], best[:-1] + (b == x)))
    return best


def common_lines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which lines of ``a`` a longest common subsequence with ``b`` holds; memory grows with the lines only."""
    marked = np.zeros(len(a), dtype=bool)
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, j, k, m = todo.pop()
        while i < j and k < m and a[i] == b[k]:
            marked[i] = True
            i, k = i + 1, k + 1
        while i < j and k < m and a[j - 1] == b[m - 1]:
            marked[j - 1] = True
            j, m = j - 1, m - 1
        if i == j or k == m or not np.isin(a[i:j], b[k:m]).any():
            continue
        if j - i == 1:
            marked[i] = True
            continue
        half = (i + j) // 2
        ahead = _rows(a[i:half], b[k:m])
        behind = _rows(a[half:j][::-1], b[k:m][::-1])[::-1]
        split = k + int(np.argmax(ahead + behind))
        todo += [(i, half, k, split), (half, j, split, m)]
    return marked


def main_text(lines: list[str], zones: np.ndarray, shared: np.ndarray | None) -> str:
    """The blocks that the neighbour does not share, checked by their zones.

    What is aside goes though the neighbour has no such line (adverts differ from page
    to page); what stands inside a marked article stays though it has (copies, quoted
    passages). Without a neighbour, or where it shares all, the zones alone decide:
    the marked article, or else the loose blocks.
    """
    marked, content = zones == ARTICLE, zones != ASIDE
    own = content if shared is None else content & ~shared
    if shared is None or not own.any():
        own = marked if marked.any() else content
    return " ".join(line for line, k in zip(lines, own | marked) if k)


def _neighbours(keys: DataFrame) -> DataFrame:
    """``(row, near)``: for each page the page of its host next to it in order of path.

    Pages are sorted by (host, path, row) over range partitions and numbered, so a
    host with a third of all pages is many tasks. Of the two pages beside it, a page
    takes the one with the longer common beginning of the path. What lies across a
    partition's edge comes from a table of two rows per partition.
    """
    order = ["host", "path", "row"]
    sized = keys.repartitionByRange(keys.sparkSession.sparkContext.defaultParallelism * 4, *order).sortWithinPartitions(*order)
    placed = staged(sized.withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.spark_partition_id()), "pages-sorted")
    me = F.struct("host", "path", "row")
    inside = Window.partitionBy("part").orderBy("at")
    near = placed.select("*", F.lag(me).over(inside).alias("before"), F.lead(me).over(inside).alias("after"))
    ends = placed.groupBy("part").agg(F.min_by(me, "at").alias("first"), F.max_by(me, "at").alias("last"))
    row_of_ends = Window.orderBy("part")
    ends = staged(ends.select(F.col("part").alias("p"), F.lag("last").over(row_of_ends).alias("prev"), F.lead("first").over(row_of_ends).alias("next")), "pages-ends")
    near = near.join(ends, near["part"] == ends["p"]).select(
        "host", "path", "row", F.coalesce("before", "prev").alias("before"), F.coalesce("after", "next").alias("after")
    )

    def alike(side: str):
        here, there = F.split("path", ""), F.split(F.col(f"{side}.path"), "")
        parts = F.arrays_zip(here.alias("a"), there.alias("b"))
        upto = F.array_position(F.transform(parts, lambda x: ~x["a"].eqNullSafe(x["b"])), True)
        score = F.when(upto == 0, F.size(parts) + 1).otherwise(upto)
        return F.when(F.col(f"{side}.host").eqNullSafe(F.col("host")) & F.col(f"{side}.row").isNotNull(), score).otherwise(0)

    near = near.withColumn("b", alike("before")).withColumn("a", alike("after"))
    pick = F.when((F.col("b") >= F.col("a")) & (F.col("b") > 0), F.col("before.row")).when(F.col("a") > 0, F.col("after.row"))
    return near.select("row", pick.alias("near"))


def extract(pages: DataFrame, url_col: str = "url", html_col: str = "html", carry: list[str] | None = None) -> DataFrame:
    """``pages`` with ``text``, the main text, one row per input row.

    A first pass cuts each whole page into blocks and keeps their hashes. Every page is
    paired with the nearest page of its host by URL path; the hashes of the pair's
    blocks are aligned by a longest common subsequence. A second pass cuts the pages
    again and deletes the shared blocks. Then the markup is checked: menus, headers,
    footers, sidebars, notices, adverts, forms and comments go by tag or name where the
    neighbour has other ones, and what stands inside an article or main element comes
    back where it was shared (copies of an article, and passages that many articles
    quote, are content). So differencing decides for all blocks that the markup leaves open.

    Null html is empty and gives an empty text. Null urls are one host. A page alone
    on its host shares nothing. Pages with equal url (but for its query) and html are
    one page for the pairing, and rows of their own in the result. ``carry`` names the
    columns to keep (all by default); one named ``text`` is replaced.
    """
    bounded_batches(pages.sparkSession, 200)
    wanted = [c for c in (carry if carry is not None else pages.columns) if c.lower() != "text"]

    @F.pandas_udf("array<long>")
    def hashed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(
                [[xxhash.xxh64_intdigest(t.encode("utf-8", "surrogatepass")) - (1 << 63) for t, _ in blocks(page)] for page in batch], dtype=object
            )

    @F.pandas_udf("array<boolean>")
    def aligned(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for here, there in batches:
            yield pd.Series(
                [None if o is None else common_lines(np.asarray(h, dtype=np.int64), np.asarray(o, dtype=np.int64)).tolist() for h, o in zip(here, there)],
                dtype=object,
            )

    @F.pandas_udf("string")
    def text(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for batch, shared in batches:
            rows = []
            for page, s in zip(batch, shared):
                got = blocks(page)
                zones = np.array([zone for _, zone in got], dtype=np.int64)
                rows.append(main_text([t for t, _ in got], zones, None if s is None else np.asarray(s, dtype=bool)))
            yield pd.Series(rows, dtype=object)

    bare = F.regexp_replace(text_of(f"`{url_col}`"), r"[?#].*$", "")
    key = F.md5(F.concat(F.length(bare).cast("string"), F.lit(":"), bare, text_of(f"`{html_col}`")))
    host = F.lower(F.regexp_extract(bare, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/]*)", 1))
    path = F.regexp_replace(bare, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//[^/]*", "")
    cut = pages.select(key.alias("key"), host.alias("host"), path.alias("path"), hashed(F.col(f"`{html_col}`")).alias("hashes"))
    own = numbered(cut.dropDuplicates(["key"]), "pages-cut", "row")
    near = _neighbours(own.select("host", "path", "row")).filter("near is not null")
    there = own.select(F.col("row").alias("near"), F.col("hashes").alias("other"))
    met = near.join(there, "near").join(own.select("row", "key", "hashes"), "row")
    marks = staged(met.select(F.col("key").alias("__of"), aligned("hashes", "other").alias("__shared")), "pages-shared")
    rows = pages.select(*[F.col(f"`{c}`") for c in wanted], F.col(f"`{html_col}`").alias("__html"), key.alias("__key"))
    rows = rows.join(marks.hint("merge"), F.col("__key") == F.col("__of"), "left")
    return rows.select(*[F.col(f"`{c}`") for c in wanted], text("__html", "__shared").alias("text"))
