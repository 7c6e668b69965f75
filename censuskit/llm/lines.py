"""Site-relative line deduplication.

For each line of a site, the pages of the site that hold it are divided by all
its pages; lines above a ratio are boilerplate and go. Counting is a grouped
aggregate with map-side sums, so a big site is no hot key; what a page is
joined with is its site's list of boilerplate lines, whose length the ratio
bounds by the number of lines that a page of the site has on average. The lists
are written and counted: up to a bound they are broadcast and no page moves,
beyond it they are joined by site, where AQE splits a big site.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import cut

#: A line on more than this share of a site's pages is boilerplate, if it is on
#: this many pages at least.
RATIO = 0.1
LEAST_PAGES = 3
#: Boilerplate lines of all sites (8 bytes each) up to which they are broadcast.
BROADCAST_MARKS = 1_000_000

HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)"
HIDDEN = r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->"
BLOCK = (
    r"(?i)</?(?:p|div|li|ul|ol|nav|h[1-6]|br|hr|tr|td|th|table|article|section|footer|header|title|body|html|head|main|aside|blockquote|pre|form)\b[^>]*>"
)
TAG = r"<[^>]*>"


def host(url: str) -> F.Column:
    """The host of a URL in lower case; null if it has none."""
    return F.nullif(F.lower(F.regexp_extract(url, HOST, 1)), F.lit(""))


def html_lines(html: str) -> F.Column:
    """The text of a page, a line for each block element's text, without blank
    lines; of a null page, no lines."""
    text = F.regexp_replace(F.coalesce(F.col(html), F.lit("")), HIDDEN, "")
    text = F.regexp_replace(F.regexp_replace(text, BLOCK, "\n"), TAG, "")
    return F.filter(F.transform(F.split(text, "\n"), lambda x: F.trim(x)), lambda x: x != "")


def boilerplate(pages: DataFrame, site: str, lines: str, ratio: float = RATIO, least_pages: int = LEAST_PAGES) -> DataFrame:
    """Per site with any, ``marks``: the hashes of its boilerplate lines.
    ``lines`` is an array; lines count once a page, trimmed, blank ones not."""
    known = pages.where(F.col(site).isNotNull()).select(F.col(site).alias("site"), F.col(lines).alias("lines"))
    marks = F.array_distinct(F.transform(F.filter("lines", lambda x: F.trim(x) != ""), lambda x: F.xxhash64(F.trim(x))))
    holds = known.select("site", F.explode(marks).alias("mark")).groupBy("site", "mark").agg(F.count("*").alias("n"))
    totals = known.groupBy("site").agg(F.count("*").alias("total"))
    often = holds.where(F.col("n") >= least_pages).join(totals, "site").where(F.col("n") > ratio * F.col("total"))
    return often.groupBy("site").agg(F.collect_set("mark").alias("marks"))


def drop_lines(df: DataFrame, site: str, lines: str, ratio: float = RATIO, least_pages: int = LEAST_PAGES, broadcast_marks: int = BROADCAST_MARKS) -> DataFrame:
    """``df`` with its array ``lines`` replaced by the lines that stay.

    Blank lines stay, and so does everything on rows whose site is null; a null
    array stays null. Repeated rows count as pages of their own. No rows, none
    back.
    """
    found = boilerplate(df, site, lines, ratio, least_pages).select(F.col("site").alias("_line_site"), F.col("marks").alias("_line_marks"))
    found = cut(found, "boilerplate")
    marks = found.agg(F.sum(F.size("_line_marks") + 8)).first()[0] or 0
    found = F.broadcast(found) if marks <= broadcast_marks else found.hint("merge")
    joined = df.join(found, df[site] == F.col("_line_site"), "left")
    stays = F.filter(df[lines], lambda x: (F.trim(x) == "") | ~F.array_contains(F.col("_line_marks"), F.xxhash64(F.trim(x))))
    return joined.select(*[F.when(F.col("_line_marks").isNull(), df[c]).otherwise(stays).alias(c) if c == lines else df[c] for c in df.columns])


def drop_text_lines(df: DataFrame, site: str = "source", text: str = "text", ratio: float = RATIO, least_pages: int = LEAST_PAGES) -> DataFrame:
    """``df`` with the boilerplate lines of its sites taken out of ``text``
    (lines end with a line feed); all columns and rows stay, a null text null, an
    empty one empty. Columns that begin with ``_line`` would clash."""
    kept = drop_lines(df.withColumn(text, F.split(text, "\n")), site, text, ratio, least_pages)
    return kept.withColumn(text, F.when(F.col(text).isNotNull(), F.concat_ws("\n", text)))


def page_report(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", ratio: float = RATIO, least_pages: int = LEAST_PAGES) -> DataFrame:
    """Per page: key, ``host``, ``n_lines``, ``n_dropped`` and ``kept_sha256``
    of the lines that stay, joined by line feeds. A null page has no lines; a
    page without a host keeps all. Repeated pages count, and are reported, each;
    a very long page is read whole, in the JVM; other columns are not read, so
    none can clash. No pages, none back."""
    rows = pages.select(F.col(key).alias("key"), host(url).alias("host"), html_lines(html).alias("lines"))
    rows = rows.withColumn("n_lines", F.size("lines"))
    kept = drop_lines(rows, "host", "lines", ratio, least_pages)
    return kept.select(
        F.col("key").alias(key), "host", "n_lines", (F.col("n_lines") - F.size("lines")).alias("n_dropped"),
        F.sha2(F.concat_ws("\n", "lines").cast("binary"), 256).alias("kept_sha256"),
    )


REPORT_SQL = f"""
WITH p AS (
  SELECT row_number() OVER () AS r, page_id, nullif(lower(regexp_extract(url, '{HOST}', 1)), '') AS host,
    [trim(x) FOR x IN string_split(
      regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''), '{HIDDEN}', '', 'g'), '{BLOCK}', chr(10), 'g'), '{TAG}', '', 'g'),
      chr(10)) IF trim(x) <> ''] AS lines
  FROM pages),
l AS (SELECT r, host, unnest(lines) AS line, generate_subscripts(lines, 1) AS at FROM p),
n AS (SELECT host, line, count(DISTINCT r) AS n FROM l WHERE host IS NOT NULL GROUP BY host, line),
t AS (SELECT host, count(*) AS total FROM p GROUP BY host),
b AS (SELECT n.host, n.line FROM n JOIN t ON n.host = t.host WHERE n.n >= {LEAST_PAGES} AND n.n > {RATIO} * t.total),
k AS (
  SELECT l.r, count(*) FILTER (b.line IS NULL) AS n_kept, string_agg(l.line, chr(10) ORDER BY l.at) FILTER (b.line IS NULL) AS kept
  FROM l LEFT JOIN b ON l.host = b.host AND l.line = b.line GROUP BY l.r)
SELECT p.page_id, p.host, CAST(len(p.lines) AS INTEGER) AS n_lines, CAST(len(p.lines) - coalesce(k.n_kept, 0) AS INTEGER) AS n_dropped,
  sha256(coalesce(k.kept, '')) AS kept_sha256
FROM p LEFT JOIN k ON p.r = k.r
"""
