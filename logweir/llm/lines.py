"""Line dedup by site-relative frequency.

For each line of a site, the pages that hold it are divided by the site's pages; lines above
``RATIO`` of them, on two pages at least, are boilerplate and go from every page. Pages are
different texts: copies of a page count once, so a group of copies does not make its own
lines common, and a page counts a line once.

Lines and pages travel as digests. The first shuffle is keyed by site and page, so a hot site is
spread, and copies are combined before it; lines are counted on the map side of the second. The
boilerplate lines of a site have a proven bound: a line above the ratio takes that share of the
site's pages, so there are at most (lines per page) / ratio of them. They are kept as one array
per site and joined to the pages by site, without a hint: Spark broadcasts a small table by its
size and shuffles a large one, where the pages of a hot site can be split since the other side
is a stored table. Texts are cleaned in place and never taken apart and put together by a
shuffle.

Defined results: a null text is an empty page and stays as an empty text; null is a site of its
own; lines are compared without spaces at their ends, and blank lines stay; repeated rows are
one page and are cleaned each; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweir.llm.common import materialize, own_columns

RATIO = 0.05
#: A line on one page is no repeat.
LEAST = 2


def host(url: str = "url") -> Column:
    """The host of an address, for pages; null if there is none."""
    found = F.regexp_extract(F.lower(F.col(url)), r"^[a-z][a-z0-9+.-]*://([^/?#:]+)", 1)
    return F.when(found != "", found)


def _digest(line: Column) -> Column:
    return F.unhex(F.md5(F.trim(line).cast("binary")))


def _lines(text: str) -> Column:
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)


def boilerplate(pages: DataFrame, text: str, site: str, ratio: float = RATIO) -> DataFrame:
    """__site, __bad: digests of the lines to drop, for each site that has any."""
    held = F.filter(_lines(text), lambda x: F.trim(x) != "")
    page = F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))
    rows = pages.select(
        F.col(site).alias("__site"), page.alias("__page"), F.array_distinct(F.transform(held, _digest)).alias("__lines")
    )
    # Copies have the same lines: any of them will do.
    different = rows.groupBy("__site", "__page").agg(F.first("__lines").alias("__lines"))
    different = materialize(different.drop("__page"), "site-pages")
    totals = different.groupBy(F.col("__site").alias("__of")).agg(F.count("*").alias("__total"))
    lines = different.select("__site", F.explode("__lines").alias("__line"))
    counted = lines.groupBy("__site", "__line").agg(F.count("*").alias("__n")).where(F.col("__n") >= LEAST)
    frequent = counted.join(materialize(totals, "site-totals"), F.col("__site").eqNullSafe(F.col("__of")))
    frequent = frequent.where(F.col("__n") > F.lit(ratio) * F.col("__total"))
    return materialize(frequent.groupBy("__site").agg(F.collect_list("__line").alias("__bad")), "site-lines")


def drop_lines(
    pages: DataFrame, text: str = "text", site: str = "source", ratio: float = RATIO
) -> DataFrame:
    """``pages`` with the cleaned text, ``n_lines`` before and ``n_dropped``."""
    made = ["n_lines", "n_dropped"]
    bad = boilerplate(pages, text, site, ratio)
    kept = [c for c in own_columns(pages, made) if c.lower() != text.lower()]
    joined = pages.join(bad, F.col(site).eqNullSafe(F.col("__site")), "left")
    lines = _lines(text)
    stay = F.when(F.col("__bad").isNull(), lines).otherwise(
        F.filter(lines, lambda x: (F.trim(x) == "") | ~F.array_contains(F.col("__bad"), _digest(x)))
    )
    cleaned = joined.select(*kept, F.size(lines).alias("n_lines"), stay.alias("__stay"))
    return cleaned.select(
        *kept,
        F.array_join("__stay", "\n").alias(text),
        "n_lines",
        (F.col("n_lines") - F.size("__stay")).alias("n_dropped"),
    )


#: The documents' result in SQL; rows are told apart by number, as ids may repeat.
SQL = f"""
with rows as (
    select row_number() over () as r, doc_id, source, coalesce(text, '') as text from documents
), pages as (
    select distinct source, text from rows
), totals as (
    select source, count(*) as total from pages group by source
), held as (
    select distinct source, text, trim(unnest(string_split(text, chr(10)))) as line from pages
), counted as (
    select source, line, count(*) as n from held where line <> '' group by 1, 2
), bad as (
    select c.source, c.line from counted c join totals t on c.source is not distinct from t.source
    where c.n >= {LEAST} and c.n > cast({RATIO} as double) * t.total
), split as (
    select r, doc_id, source, string_split(text, chr(10)) as l from rows
), lines as (
    select r, doc_id, source, unnest(l) as line, generate_subscripts(l, 1) as i from split
), marked as (
    select l.r, l.doc_id, l.line, l.i, b.line is not null as gone
    from lines l left join bad b on l.source is not distinct from b.source and trim(l.line) = b.line
)
select doc_id, coalesce(string_agg(line, chr(10) order by i) filter (not gone), '') as text,
       count(*) as n_lines, count(*) filter (gone) as n_dropped
from marked group by r, doc_id
"""
