"""Search plan: which keyword to search for in which place."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postloom.functions.wordlists import QUERY_KEYWORDS, SEARCH_KEYWORDS, SEARCH_LOCATIONS


def search_plan(
    locations: DataFrame, location: str = "location", keywords: Sequence[str] = SEARCH_KEYWORDS,
) -> DataFrame:
    """Every keyword for every location; the keywords travel with the row."""
    listed = F.array(*map(F.lit, keywords))
    return locations.select(
        F.col(location).alias("location"), F.posexplode(listed).alias("keyword_no", "keyword"))


def default_locations(spark: SparkSession) -> DataFrame:
    """The places that are searched when no others are given."""
    return spark.createDataFrame([(place,) for place in SEARCH_LOCATIONS], "location string")


def search_queries(
    places: DataFrame, place: str = "place", keywords: Sequence[str] = QUERY_KEYWORDS,
) -> DataFrame:
    """Query texts for a source that has no field for a place: ``<keyword> jobs in <place>``."""
    listed = F.array(*map(F.lit, keywords))
    planned = places.select(F.col(place).alias("place"), F.explode(listed).alias("keyword"))
    return planned.select(
        "keyword", F.format_string("%s jobs in %s", "keyword", "place").alias("query"))
