"""Landed pages of paged sources: which pages belong to a scan, and their records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Page sizes of the sources.
USER_PAGE_SIZE = 5000
AUDIT_PAGE_SIZE = 1000
POST_PAGE_SIZE = 50


def _upto(pages: DataFrame, position: str, is_last: Column, run: str | None) -> DataFrame:
    """Pages of each run up to and including its first one on which ``is_last`` holds (all of them when none does).

    The bounds are one MIN over page numbers for each run, so no ordering or window over pages is needed. Without a ``run``
    column the pages are one run.
    """
    marked = pages.where(is_last)
    if run is None:
        stop = marked.agg(F.min(position).alias("stop")).scalar()
        return pages.where(stop.isNull() | (F.col(position) <= stop))
    stops = marked.groupBy(F.col(run).alias("__run")).agg(F.min(position).alias("__stop"))
    bounded = pages.join(stops, F.equal_null(F.col(run), F.col("__run")), "left")
    return bounded.where(F.col("__stop").isNull() | (F.col(position) <= F.col("__stop"))).select(*pages.columns)


def islands(pages: DataFrame, run: str | None = None, position: str = "page") -> DataFrame:
    """``run, first_page, last_page``: the stretches of each run without a missing page. Repeated pages count once, null ones not at all.

    A page without a page before it starts a stretch, one without a page behind it ends one. Both are found by joins on run and page,
    so a long run is spread over tasks; only the ends of stretches are put in order, the k-th start belongs to the k-th end.
    """
    own = F.lit(0) if run is None else F.col(run)
    seen = pages.select(own.alias("run"), F.col(position).cast("bigint").alias("page")).dropna(subset=["page"]).distinct()

    def edge(step: int, name: str) -> DataFrame:
        near = seen.select(F.col("run").alias("near_run"), (F.col("page") + step).alias("near_page"))
        alone = seen.join(near, F.equal_null("run", F.col("near_run")) & (F.col("page") == F.col("near_page")), "left_anti")
        return alone.select("run", F.col("page").alias(name), F.row_number().over(W.partitionBy("run").orderBy("page")).alias("place"))

    ends = edge(-1, "last_page").withColumnsRenamed({"run": "end_run", "place": "end_place"})
    same = F.equal_null("run", F.col("end_run")) & (F.col("place") == F.col("end_place"))
    return edge(1, "first_page").join(ends, same).select("run", "first_page", "last_page")


def unbroken(pages: DataFrame, run: str | None = None) -> DataFrame:
    """Pages of each run before its first missing one; none of a run that lacks page 0."""
    first = islands(pages, run).where("first_page = 0").select(F.col("run").alias("__run"), "last_page")
    own = F.lit(0) if run is None else F.col(run)
    kept = pages.join(first, F.equal_null(own, F.col("__run")) & (F.col("page") <= F.col("last_page")))
    return kept.select(*pages.columns)


def scan_pages(
    pages: DataFrame,
    body: str,
    page_size: int,
    total: str | None = None,
    last_page: int | None = None,
    run: str | None = None,
    gaps: bool = True,
) -> DataFrame:
    """Pages 0, 1, ... of each run until an empty or short page, ``total`` records, or page number ``last_page`` (kept).

    Every page before the stop is full, hence ``(page + 1) * page_size`` records have been read after ``page``. With ``gaps`` false a
    missing page ends the run too.
    """
    pages = pages if gaps else unbroken(pages, run)
    is_last = F.coalesce(F.size(body), F.lit(0)) < page_size
    if total is not None:
        is_last |= (F.col("page") + 1).cast("bigint") * page_size >= F.coalesce(F.col(total), F.lit(0))
    if last_page is not None:
        is_last |= F.col("page") >= last_page
    return _upto(pages, "page", is_last, run)


def scan_offset_pages(pages: DataFrame, body: str = "elements", run: str | None = None) -> DataFrame:
    """Offset-addressed pages of each run until an empty one or one whose next offset does not advance."""
    count = F.coalesce(F.size(body), F.lit(0))
    following = F.coalesce(F.col("paging.start"), F.lit(0)) + F.coalesce(F.col("paging.count"), count)
    return _upto(pages, "start", (count == 0) | (following <= F.col("start")), run)


def records(pages: DataFrame, body: str, place: str | None = None) -> DataFrame:
    """One row per record of the page bodies, fields as columns.

    ``place`` names a column for the record's place in the scan, (page, position): the order of reading.
    """
    if place is None:
        return pages.select(F.explode(body).alias("record")).select("record.*")
    found = pages.select("page", F.posexplode(body).alias("__at", "record"))
    return found.select("record.*", F.struct("page", F.col("__at").alias("at")).alias(place))


# A landed folder is what a scan has read, so all its pages are taken; the stop rules above are for folders that hold more.
def user_records(pages: DataFrame) -> DataFrame:
    return records(pages, "users")


def audit_records(pages: DataFrame, place: str | None = "place") -> DataFrame:
    return records(pages, "audits", place)


def post_records(pages: DataFrame) -> DataFrame:
    return records(pages, "elements")


def source_fallback(primary: DataFrame, fallback: DataFrame, newest: Column, count: int | None = None) -> DataFrame:
    """``primary`` unless it is empty, else the narrower ``fallback`` (with ``count``, its newest rows).

    The emptiness test is a one-row subquery, so the choice needs no driver round trip.
    """
    rows = fallback.where(~primary.select(F.lit(1)).exists())
    if count is not None:
        rows = rows.orderBy(newest.desc()).limit(count)
    return primary.unionByName(rows, allowMissingColumns=True)
