"""Line dedup by site-relative frequency, in DataFrame operations.

Lines are counted once a page within their host; a line on more than ``max_ratio`` of its host's pages
is boilerplate there and goes from each of them. A host has at most (lines a page / max_ratio) such
lines, so their list is bounded and every page is filtered in place: no page is taken apart and put
together again, and a host with a third of all pages is counted by partial sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import join_hot, stored

MAX_RATIO = 0.2
#: Pages that a dropped line is on at least: what stands on one or two pages is no boilerplate, although
#: it is on all or half of the pages of a site that small.
MIN_COUNT = 3
#: Boilerplate lines up to which all hosts' lists (8 bytes a line) are broadcast, and hosts whose lists are
#: beyond that: those with over one in so many of all pages.
MOST_BROADCAST = 500_000
HOT_HOSTS = 1000

_HIDDEN = r"(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->"
_BLOCK = r"(?i)</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|figure|footer|form|h[1-6]|head|header|hr|html|li|main|nav|ol|option|p|pre|section|table|tbody|td|th|thead|title|tr|ul)(?:[ \t\n\f\r/][^>]*)?>"
_TAG = r"<[a-zA-Z/!][^>]*>"
_BREAK = r"[ \t\f\r]*\n[ \t\n\f\r]*"
_HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)"


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, _HOST, 1)), F.lit(""))


def lines_of(html: Column) -> Column:
    """Text lines of a page: hidden parts go, block tags break lines, other tags go; no empty lines."""
    t = F.regexp_replace(F.coalesce(html, F.lit("")), F.lit(_HIDDEN), F.lit(""))
    t = F.regexp_replace(F.regexp_replace(t, F.lit(_BLOCK), F.lit("\n")), F.lit(_TAG), F.lit(""))
    t = F.regexp_replace(t, F.lit(_BREAK), F.lit("\n"))
    return F.array_remove(F.split(F.regexp_replace(t, F.lit(r"^[ \t\n\f\r]+|[ \t\n\f\r]+$"), F.lit("")), "\n"), "")


def boilerplate(pages: DataFrame, max_ratio: float = MAX_RATIO, min_count: int = MIN_COUNT) -> DataFrame:
    """``pages(host, lines)`` -> ``(host, n, drop)``: its pages and hashes of the lines to drop there."""
    total = pages.groupBy("host").agg(F.count("*").alias("n"))
    each = pages.select("host", F.explode(F.array_distinct("lines")).alias("line")).select("host", F.xxhash64("line").alias("line"))
    count = each.groupBy("host", "line").agg(F.count("*").alias("times")).where(F.col("times") >= min_count)
    found = count.join(total, "host").where(F.col("times") > max_ratio * F.col("n"))
    found = found.groupBy("host").agg(F.sort_array(F.collect_list("line")).alias("drop"))
    return total.join(found, "host", "left")


def drop_boilerplate(pages: DataFrame, max_ratio: float = MAX_RATIO, min_count: int = MIN_COUNT) -> DataFrame:
    """``pages(page_id, url, html, ...)`` -> ``(page_id, host, n_lines, n_dropped, kept_text)``, a row
    for each input row. A line goes if it is on over ``max_ratio`` of its host's pages and on
    ``min_count`` (3) of them at least.

    Nulls: a null or malformed url has the host '', a null html no lines; a null page_id is carried.
    Empty texts have no lines. Very long pages are read whole. Ties: a line on exactly ``max_ratio`` of
    the pages stays; a page counts once for a line however often it holds it. Repeated rows are pages
    of their own. An empty table gives no rows. Extra columns of any name are left out."""
    rows = stored(pages.select(F.col("page_id").cast("long").alias("page_id"), host_of(F.col("url")).alias("host"), lines_of(F.col("html")).alias("lines")))
    drop = stored(boilerplate(rows, max_ratio, min_count))
    size = drop.agg(F.sum("n").alias("pages"), F.sum(F.size("drop")).alias("lines"), F.count("drop").alias("hosts")).first()
    if max(size["lines"] or 0, size["hosts"]) <= MOST_BROADCAST:
        rows = rows.join(F.broadcast(drop.where("drop is not null")), "host", "left")
    else:
        rows = join_hot(rows, drop, "host", size["pages"], HOT_HOSTS)
    kept = F.when(F.col("drop").isNull(), F.col("lines")).otherwise(F.filter("lines", lambda x: ~F.array_contains(F.col("drop"), F.xxhash64(x))))
    rows = rows.select("page_id", "host", F.size("lines").cast("long").alias("n_lines"), kept.alias("kept"))
    return rows.select("page_id", "host", "n_lines", (F.col("n_lines") - F.size("kept")).alias("n_dropped"), F.array_join("kept", "\n").alias("kept_text"))


ORACLE = rf"""
WITH a AS (SELECT page_id, coalesce(lower(regexp_extract(url, '{_HOST}', 1)), '') AS host,
  regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''), '{_HIDDEN}', '', 'g'), '{_BLOCK}', chr(10), 'g'), '{_TAG}', '', 'g') AS t, row_number() OVER () AS r FROM pages),
b AS (SELECT page_id, host, r, list_filter(string_split(regexp_replace(regexp_replace(t, '{_BREAK}', chr(10), 'g'), '^[ \t\n\f\r]+|[ \t\n\f\r]+$', '', 'g'), chr(10)), lambda x: x <> '') AS lines FROM a),
h AS (SELECT host, count(*) AS pages FROM b GROUP BY host),
c AS (SELECT host, line, count(*) AS n FROM (SELECT host, r, unnest(list_distinct(lines)) AS line FROM b) GROUP BY host, line),
d AS (SELECT c.host, list(line) AS bad FROM c JOIN h USING (host) WHERE n >= {MIN_COUNT} AND n > {MAX_RATIO} * pages GROUP BY c.host),
k AS (SELECT page_id, b.host, lines, CASE WHEN bad IS NULL THEN lines ELSE list_filter(lines, lambda x: NOT list_contains(bad, x)) END AS kept FROM b LEFT JOIN d USING (host))
SELECT page_id, host, CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(kept) AS BIGINT) AS n_dropped,
  CAST(length(array_to_string(kept, chr(10))) AS BIGINT) AS kept_chars, md5(array_to_string(kept, chr(10))) AS kept_md5 FROM k
"""
