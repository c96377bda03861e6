"""Landed API pages: which of them a page-by-page reader would have kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.jsontext import is_falsy, member, result_items, with_document

# Fixed value: pages read at most when a ceiling is asked for.
DEFAULT_MAX_PAGES = 166

_BLOCK = 100_000


def with_record_count(pages: DataFrame, payload: str = "payload") -> DataFrame:
    """Add ``records``: how many results the page's JSON holds, 0 for an empty page.

    Null stands for a payload that is not a JSON object.
    """
    results = member(F.col("_document"), "$.results")
    items = result_items(F.col("_document"))
    is_object = F.coalesce(F.col(payload).rlike(r"^[ \t\n\r]*\{"), F.lit(False))
    return (
        with_document(pages, F.col(payload), "_document")
        .withColumn(
            "records",
            F.when(F.col("_document").isNull() | ~is_object, F.lit(None).cast("long"))
            .when(is_falsy(results), F.lit(0).cast("long"))
            .otherwise(F.coalesce(F.size(items), F.lit(1)).cast("long")),
        )
        .drop("_document")
    )


def keep_pages(
    pages: DataFrame,
    *,
    page: str = "page",
    records: str = "records",
    max_pages: int | None = None,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Pages before the first empty or missing page number, up to ``max_pages``.

    ``records`` is the number of results on the page. Reading stops at the first page without
    any, so later pages are dropped even when they hold results. A null count marks a page that
    could not be understood; reaching one is an error. ``counted`` gives the counts in a frame of
    their own, so that the pages themselves need no parsing here.
    """
    numbers = F.col(page)

    def readable(rows: DataFrame) -> DataFrame:
        rows = rows.filter(numbers >= 1)
        return rows if max_pages is None else rows.filter(numbers <= max_pages)

    wanted = readable(pages)
    source = wanted if counted is None else readable(counted)
    cut = _first_stop(source, numbers, F.col(records)).scalar()
    reached_bad = F.raise_error(F.format_string("page %d holds no JSON object", cut["page"]))
    before = F.when(cut["bad"], reached_bad.cast("boolean")).otherwise(numbers < cut["page"])
    return wanted.filter(before)


def _first_stop(pages: DataFrame, page: Column, records: Column) -> DataFrame:
    """One row: the first page number that is missing, empty or not understood.

    The page after the last one is always missing. Both candidates come from one grouped frame
    of page numbers, so no window over all pages is needed.
    """
    numbered = pages.groupBy(page.cast("bigint").alias("page")).agg(
        F.bool_or(records.isNull()).alias("bad"), F.bool_or(records <= 0).alias("empty")
    )
    stops = numbered.filter("bad or empty").select("page", F.coalesce("bad", F.lit(False)).alias("bad"))
    successors = numbered.select((F.col("page") + 1).alias("page")).union(
        pages.sparkSession.range(1, 2).toDF("page")
    )
    gaps = successors.join(numbered.select("page"), "page", "left_anti").select(
        "page", F.lit(False).alias("bad")
    )
    return stops.union(gaps).agg(F.min(F.struct("page", "bad")).alias("cut")).select("cut")


def missing_pages(pages: DataFrame, *, page: str = "page", last: int | None = None) -> DataFrame:
    """Ranges ``(first_missing, last_missing)`` of page numbers absent between 1 and ``last``.

    ``last`` defaults to the highest landed page. The next landed number is looked up by a
    window within blocks of page numbers; blocks meet through a frame of one row per block that has pages.
    """
    numbers = pages.select(F.col(page).cast("bigint").alias("page")).filter("page >= 1")
    if last is not None:
        numbers = numbers.filter(F.col("page") <= last)
    edges = [0] if last is None else [0, last + 1]
    numbers = numbers.distinct().union(
        pages.sparkSession.createDataFrame([(edge,) for edge in edges], "page bigint")
    )
    blocks = numbers.withColumn("block", F.expr(f"page div {_BLOCK}"))
    starts = blocks.groupBy("block").agg(F.min("page").alias("block_start"))
    following = starts.select(
        "block", F.lead("block_start").over(Window.orderBy("block")).alias("next_block_start")
    )
    inside = F.lead("page").over(Window.partitionBy("block").orderBy("page"))
    gaps = blocks.withColumn("inside", inside).join(following, "block")
    return (
        gaps.select("page", F.coalesce("inside", "next_block_start").alias("next"))
        .filter("next > page + 1")
        .select((F.col("page") + 1).alias("first_missing"), (F.col("next") - 1).alias("last_missing"))
    )
