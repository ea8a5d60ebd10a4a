"""Counts that tell what a run did."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postloom.session import cut_lineage


def skip_report(classified: DataFrame) -> DataFrame:
    """Dropped postings per source and reason."""
    return (
        classified.where("skip_reason is not null")
        .groupBy("source", "skip_reason").agg(F.count(F.lit(1)).alias("n"))
    )


def source_counts(postings: DataFrame) -> DataFrame:
    """Postings per source."""
    return postings.groupBy("source").agg(F.count(F.lit(1)).alias("n"))


def link_report(links: DataFrame, seen: DataFrame, page: str = "page_no") -> DataFrame:
    """Per listing page: distinct links, links new with this page, running total.

    A link is new on the first page that has it, if it was not seen before.  The
    running total needs one ordered pass, but over one row per listing page only.
    Links are found once: the distinct ones are checkpointed, as they are read twice,
    and so are the counts per page.
    """
    found = cut_lineage(links.select(page, "url").distinct())
    first_page = found.groupBy("url").agg(F.min(page).alias(page))
    fresh = first_page.join(seen.select("url"), "url", "left_anti")
    per_page = (
        found.groupBy(page).agg(F.count(F.lit(1)).alias("links"))
        .join(fresh.groupBy(page).agg(F.count(F.lit(1)).alias("new_links")), page, "left")
        .fillna(0, ["new_links"])
    )
    return running_total(cut_lineage(per_page), page, "new_links", "total_new")


def running_total(
    df: DataFrame, order: str, value: str, name: str, width: int = 100_000,
) -> DataFrame:
    """Cumulative sum over the whole frame without sorting it in one task.

    ``order`` is a whole number.  Rows fall into ranges of ``width`` numbers; each
    range is summed in its own task and shifted by the total of the ranges before
    it.  Only the totals, one row per range, pass through a single task.
    """
    part = F.floor(F.col(order) / width)
    totals = df.groupBy(part.alias("__part")).agg(F.sum(value).alias("__sum"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "__part", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__offset"))
    within = Window.partitionBy("__part").orderBy(order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    summed = df.withColumn("__part", part).withColumn("__running", F.sum(value).over(within))
    return (
        summed.join(offsets, "__part")
        .withColumn(name, F.col("__running") + F.col("__offset"))
        .drop("__part", "__running", "__offset")
    )
