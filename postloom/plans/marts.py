"""Gold layer: summary tables over staged postings.

The layer is declared upstream without a definition, so these three tables are
our own choice of aggregates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postloom.operators.reports import running_total
from postloom.session import cut_lineage


def skill_demand(postings: DataFrame) -> DataFrame:
    """Postings per skill, their share of all postings, and rank.

    One pass over the postings: each also counts once under no skill, which gives
    the total.  Counts combine before the shuffle, so a skill named by every posting
    is not a hot key.  The counts are checkpointed, one row per skill; ranks come from
    the distinct counts in ranges, so no task sees all skills, however many free-text
    skills the sources name.
    """
    with_total = F.array_append(
        F.coalesce(F.col("skills"), F.array().cast("array<string>")), F.lit(None))
    counts = cut_lineage(
        postings.select(F.explode(with_total).alias("skill"))
        .groupBy("skill").agg(F.count(F.lit(1)).alias("postings")))
    total = counts.where("skill is null").first()
    named = counts.where("skill is not null")
    levels = named.groupBy((-F.col("postings")).alias("level")).agg(
        F.count(F.lit(1)).alias("skills"))
    ranks = running_total(levels, "level", "skills", "through").select(
        (-F.col("level")).alias("postings"),
        (F.col("through") - F.col("skills") + 1).alias("demand_rank"))
    return named.join(ranks, "postings").select(
        "skill", "postings",
        F.round(F.col("postings") / F.lit(total["postings"] if total else None), 6).alias("share"),
        "demand_rank")


def skill_pairs(postings: DataFrame, min_support: int = 2) -> DataFrame:
    """Pairs of skills that at least ``min_support`` postings name together, with their lift.

    Apriori: a pair cannot be more frequent than its skills, so pairs are made of frequent skills
    only, which bounds them by the square of the number of frequent skills, and a posting adds
    the pairs of its own skills.  Lift is the share of the pair over what independent skills
    would have.
    """
    named = cut_lineage(postings.select(F.array_distinct(F.filter(
        F.coalesce(F.col("skills"), F.array().cast("array<string>")),
        lambda s: s.isNotNull())).alias("skills")))
    total = named.count()
    counts = named.select(F.explode("skills").alias("skill")).groupBy("skill").agg(
        F.count(F.lit(1)).alias("n"))
    frequent = cut_lineage(counts.where(F.col("n") >= min_support))
    kept = named.withColumn("__row", F.monotonically_increasing_id()).select(
        "__row", F.explode("skills").alias("skill")).join(frequent.select("skill"), "skill")
    baskets = kept.groupBy("__row").agg(F.array_sort(F.collect_list("skill")).alias("skills"))
    both = F.flatten(F.transform("skills", lambda a, i: F.transform(
        F.slice("skills", i + 2, F.size("skills")), lambda b: F.struct(
            a.alias("skill"), b.alias("other")))))
    pairs = baskets.select(F.inline(both)).groupBy("skill", "other").agg(
        F.count(F.lit(1)).alias("postings")).where(F.col("postings") >= min_support)
    ours = frequent.withColumnRenamed("n", "n_skill")
    theirs = frequent.select(F.col("skill").alias("other"), F.col("n").alias("n_other"))
    return pairs.join(ours, "skill").join(theirs, "other").select(
        "skill", "other", "postings", F.round(
            F.col("postings") * F.lit(total) / (F.col("n_skill") * F.col("n_other")), 6).alias("lift"))


def city_employment(postings: DataFrame) -> DataFrame:
    """Postings by city and employment type, with all subtotals."""
    return (
        postings.cube("city", "employment_type")
        .agg(F.count(F.lit(1)).alias("postings"), F.grouping_id().alias("level"))
        .select("city", "employment_type", F.col("level").cast("long"), "postings"))


def daily_postings(postings: DataFrame, date: str = "posted_date", days: int = 7) -> DataFrame:
    """Postings per day and the sum of the last ``days`` days.

    The window runs over one row per calendar day, not over postings.
    """
    per_day = (
        postings.where(F.col(date).isNotNull())
        .groupBy(F.to_date(date).alias("day")).agg(F.count(F.lit(1)).alias("postings")))
    recent = Window.partitionBy(F.lit(0)).orderBy(F.unix_date("day")).rangeBetween(1 - days, 0)
    return per_day.select("day", "postings", F.sum("postings").over(recent).alias("recent"))
