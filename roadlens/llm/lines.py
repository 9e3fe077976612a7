"""Line dedup by site-relative frequency.

The text lines of a page are what stands between its tags. A line's frequency is the share of its
host's pages that have it; lines above ``MAX_SHARE`` that are on ``MIN_PAGES`` pages at least are
boilerplate and go. Since a boilerplate line is on more than a fixed share of the pages, a host has at
most (lines of a mean page / ``MAX_SHARE``) of them: they travel to the pages as one array per host,
and pages are never taken apart into rows again. Only 64-bit hashes of lines are shuffled and counted;
the lines themselves are read again from the pages. A page counts a line once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.llm.frames import table
from roadlens.llm.urls import host_of

MAX_SHARE = 0.2
MIN_PAGES = 3
HIDDEN = r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->"
SPACE = r"[\x20\x09-\x0D]+"


def lines_of(html: F.Column) -> F.Column:
    """The lines between tags, white space runs as one space, without empty ones; null has none."""
    text = F.regexp_replace(F.regexp_replace(F.coalesce(html, F.lit("")), HIDDEN, "\n"), "<[^>]*>", "\n")
    trimmed = F.transform(F.split(text, "\n"), lambda x: F.trim(F.regexp_replace(x, SPACE, " ")))
    return F.filter(trimmed, lambda x: x != "")


def _hashes(lines: F.Column) -> F.Column:
    return F.transform(lines, lambda x: F.xxhash64(x))


def boilerplate(rows: DataFrame, max_share: float = MAX_SHARE, min_pages: int = MIN_PAGES) -> DataFrame:
    """Per host (rows: host, lines) the array of the hashes of its boilerplate lines."""
    pages = rows.groupBy("host").agg(F.count("*").alias("pages"))
    on = rows.select("host", F.explode(_hashes(F.array_distinct("lines"))).alias("line")).groupBy("host", "line").agg(
        F.count("*").alias("n")
    )
    return (
        on.filter(F.col("n") >= min_pages)
        .join(pages, "host")
        .filter(F.col("n") > F.col("pages") * max_share)
        .groupBy("host")
        .agg(F.collect_set("line").alias("dropped"))
    )


def dedup(
    pages: DataFrame, max_share: float = MAX_SHARE, min_pages: int = MIN_PAGES,
    id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
) -> DataFrame:
    """Per row of ``pages``: page_id, host, n_lines, n_dropped and the text left, lines joined by line ends.

    Null urls and urls without ``://`` share the empty host. Null html has no lines and counts as a
    page. Repeated rows are pages of their own. An empty table gives an empty result.
    """
    rows = pages.select(
        F.col(f"`{id_col}`").alias("page_id"), host_of(F.col(f"`{url_col}`")).alias("host"),
        lines_of(F.col(f"`{html_col}`")).alias("lines"),
    )
    dropped = F.coalesce("dropped", F.array().cast("array<bigint>"))
    left = F.filter("lines", lambda x: ~F.array_contains(dropped, F.xxhash64(x)))
    return (
        rows.join(boilerplate(rows, max_share, min_pages), "host", "left")
        .withColumn("_left", left)
        .select(
            "page_id", "host", F.size("lines").cast("long").alias("n_lines"),
            (F.size("lines") - F.size("_left")).cast("long").alias("n_dropped"), F.array_join("_left", "\n").alias("text"),
        )
    )


def op2_lines(spark, sf_dir) -> DataFrame:
    """All pages without the lines that more than a fifth of their host's pages have."""
    return dedup(table(spark, sf_dir, "pages"))


OP2_SQL = rf"""
with bare as (
  select row_number() over () as r, page_id, coalesce(url, '') as url, coalesce(html, '') as html from pages),
rests as (
  select r, page_id, html,
    case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from bare),
rows as (
  select r, page_id,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    list_filter(list_transform(
      string_split(regexp_replace(regexp_replace(html, '{HIDDEN}', chr(10), 'g'), '<[^>]*>', chr(10), 'g'), chr(10)),
      lambda x: trim(regexp_replace(x, '{SPACE}', ' ', 'g'), ' ')), lambda x: x <> '') as lines
  from rests),
totals as (select host, count(*) as pages from rows group by host),
bad as (
  select host, line from (
    select host, line, count(*) as n
    from (select host, unnest(list_distinct(lines)) as line from rows) group by host, line) join totals using (host)
  where n >= {MIN_PAGES} and n > pages * {MAX_SHARE}::double),
sets as (select host, list(line) as dropped from bad group by host),
cut as (
  select page_id, host, lines, list_filter(lines, lambda x: not list_contains(coalesce(dropped, []), x)) as kept
  from rows left join sets using (host))
select page_id, host, len(lines)::bigint as n_lines, (len(lines) - len(kept))::bigint as n_dropped,
  array_to_string(kept, chr(10)) as text
from cut
"""
