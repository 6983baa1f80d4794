"""Landed response pages to rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverair.operators.dedupe import remaining_order, top_per_key
from silverair.operators.lookup import lookup_join
from silverair.operators.nested import explode_where


def kept_pages(pages: DataFrame, request: str, page: str, results: str, count: str | None = None) -> DataFrame:
    """Pages 1..n of each request, up to its first empty or missing page.

    A run ends behind a page whose successor has no rows. These ends are found
    with an equi-join on (request, page), which no hot request can skew; a partial
    aggregate keeps one end per request, which is then looked up for every page. ``count`` names a column with
    the number of results, where the landing has one; the search for ends then
    reads no results.
    """
    # A page that was landed again after a retry counts once, the newest landing.
    newest = F.col("called_at").desc_nulls_last() if "called_at" in pages.columns else F.lit(0)
    landed = top_per_key(pages, [request, page], [newest, *remaining_order(pages, [request, page])], 1)
    filled = landed.filter((F.col(count) if count else F.size(results)) > 0)
    numbers = filled.select(request, F.col(page).cast("bigint").alias("__page"))
    # Requests without a first page have no run at all and join nothing below.
    following = numbers.select(request, (F.col("__page") - 1).alias("__page"))
    ends = (
        numbers.filter(F.col("__page") >= 1)
        .join(following, [request, "__page"], "left_anti")
        .groupBy(request)
        .agg(F.min("__page").alias("__last"))
    )
    opened = numbers.filter(F.col("__page") == 1).select(request)
    ends = ends.join(opened, request, "left_semi")
    in_run = F.col(page).between(1, F.col("__last"))
    return lookup_join(filled, ends, [request], [page]).filter(in_run).drop("__last")


def concat_pages(
    pages: DataFrame,
    request: str,
    page: str,
    results: str,
    name: str,
    max_records: int | None = None,
    count: str | None = None,
) -> DataFrame:
    """One row per result of the kept pages; at most ``max_records`` per request if given."""
    kept = kept_pages(pages, request, page, results, count)
    if max_records is not None:
        # Every kept page holds a row, so later pages are beyond the cap anyway.
        kept = kept.filter(F.col(page) <= max_records)
    rows = explode_where(kept, results, None, name)
    if max_records is None:
        return rows
    return top_per_key(rows, [request], [F.col(page).asc(), F.col(f"{name}_pos").asc()], max_records)
