"""Boilerplate lines of web pages: lines that stand on too large a share of their host's pages are dropped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut

RATIO = 0.3
#: A line on fewer pages is never boilerplate, whatever the size of its host.
LEAST_HOLDING = 2

# How a page becomes lines; plain patterns that read the same in Spark and in SQL engines with linear-time patterns.
UNSEEN = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
BREAKS = r"(?i)</?(p|div|li|ul|ol|h[1-6]|br|tr|td|th|table|nav|footer|header|article|section|main|aside|title|head|body|html|pre|blockquote)\b[^>]*>"
TAGS = r"<[^>]*>"
SPACES = r"[ \t\r\f]+"
ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")]
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"


def host_of(url: str) -> Column:
    """Lower-cased host of an address; null where there is none."""
    return F.nullif(F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), HOST, 1)), F.lit(""))


def lines_of(html: str) -> Column:
    """The non-blank lines of a page without markup, in order; null html: none."""
    text = F.coalesce(F.col(html), F.lit(""))
    for pattern, by in ((UNSEEN, " "), (BREAKS, "\n"), (TAGS, "")):
        text = F.regexp_replace(text, pattern, by)
    for entity, sign in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(sign))
    lines = F.split(F.regexp_replace(text, SPACES, " "), "\n")
    return F.filter(F.transform(lines, lambda x: F.trim(x)), lambda x: x != "")


def boilerplate(pages: DataFrame, ratio: float = RATIO, least_holding: int = LEAST_HOLDING) -> DataFrame:
    """(host, lines): of each host the lines on more than ``ratio`` of its pages, and on ``least_holding`` pages at least.

    ``pages`` holds (host, lines), one row a page. Counts are summed before they are shuffled, so a hot host or line
    costs no task more. A host has fewer than (mean distinct lines of its pages) / ratio such lines: that bounds the
    list that one row holds.
    """
    totals = pages.groupBy("host").agg(F.count("*").alias("pages"))
    seen = pages.select("host", F.explode(F.array_distinct("lines")).alias("line")).groupBy("host", "line").agg(F.count("*").alias("n")).filter(F.col("n") >= least_holding)
    over = seen.join(totals, "host").filter(F.col("n") > F.lit(ratio) * F.col("pages"))
    return over.groupBy("host").agg(F.collect_list("line").alias("drop"))


def clean(pages: DataFrame, ratio: float = RATIO, least_holding: int = LEAST_HOLDING, url: str = "url", html: str = "html", keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """For every page the columns ``keep`` with host, n_lines, n_dropped and ``text``, its lines without its host's boilerplate.

    A line counts once for a page, however often it stands there, and is dropped wherever it stands. Pages without a
    host, and those of a host with one page, lose nothing; hosts of two pages or more are treated alike. Repeated rows are pages like others. Null or
    empty html has no lines and an empty text. An empty table gives an empty table.
    """
    split = pages.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)], host_of(url).alias("host"), lines_of(html).alias("lines"))
    drops = cut(boilerplate(split.filter("host IS NOT NULL"), ratio, least_holding))
    both = split.join(drops, "host", "left")
    kept = F.when(F.col("drop").isNull(), F.col("lines")).otherwise(F.expr("filter(lines, x -> NOT array_contains(drop, x))"))
    out = both.select("*", kept.alias("kept"))
    return out.select(
        *[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], "host", F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size("kept")).alias("n_dropped"), F.array_join("kept", "\n").alias("text"),
    )


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sql() -> str:
    """The production query as SQL."""
    text = "coalesce(html, '')"
    for pattern, by in ((UNSEEN, "' '"), (BREAKS, "chr(10)"), (TAGS, "''")):
        text = f"regexp_replace({text}, {_quoted(pattern)}, {by}, 'g')"
    for entity, sign in ENTITIES:
        text = f"replace({text}, {_quoted(entity)}, {_quoted(sign)})"
    text = f"regexp_replace({text}, {_quoted(SPACES)}, ' ', 'g')"
    return f"""
    WITH split AS (
      SELECT page_id, nullif(lower(regexp_extract(coalesce(url, ''), {_quoted(HOST)}, 1)), '') AS host,
        list_filter(list_transform(string_split({text}, chr(10)), lambda x: trim(x, ' ')), lambda x: x <> '') AS lines
      FROM pages
    ), totals AS (
      SELECT host, count(*) AS pages FROM split WHERE host IS NOT NULL GROUP BY host
    ), seen AS (
      SELECT host, line, count(*) AS n FROM (SELECT host, unnest(list_distinct(lines)) AS line FROM split WHERE host IS NOT NULL) GROUP BY host, line
    ), drops AS (
      SELECT host, list(line) AS lines FROM seen JOIN totals USING (host) WHERE n > {RATIO} * pages AND n >= {LEAST_HOLDING} GROUP BY host
    ), kept AS (
      SELECT s.*, CASE WHEN d.lines IS NULL THEN s.lines ELSE list_filter(s.lines, lambda x: NOT list_contains(d.lines, x)) END AS k
      FROM split s LEFT JOIN drops d ON s.host = d.host
    )
    SELECT page_id, host, CAST(len(lines) AS INTEGER) AS n_lines, CAST(len(lines) - len(k) AS INTEGER) AS n_dropped,
      coalesce(array_to_string(k, chr(10)), '') AS text FROM kept
    """
