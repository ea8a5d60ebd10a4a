"""Helpers for arrays inside a row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_CHUNK = 128  # numbers that are added up together


def running_starts(values: Column) -> Column:
    """Sum of the numbers in front of each number of an array of whole numbers.

    Running sums in chunks: arrays that grow by one stay short, so the work is not the
    square of the length.
    """
    def one(value: Column, body) -> Column:
        return F.element_at(F.transform(F.array(value), body), 1)

    def sums(chunk: Column, start: Column) -> Column:
        empty = F.struct(start.alias("at"), F.array().cast("array<int>").alias("starts"))
        return F.aggregate(chunk, empty, lambda s, v: F.struct(
            (s["at"] + v).alias("at"), F.array_append(s["starts"], s["at"]).alias("starts")),
            lambda s: s["starts"])

    def add_up(numbers: Column) -> Column:
        chunks = F.transform(
            F.sequence(F.lit(0), F.floor((F.size(numbers) - 1) / _CHUNK).cast("int")),
            lambda c: F.slice(numbers, c * _CHUNK + 1, _CHUNK))
        return one(chunks, lambda cs: one(
            F.transform(cs, lambda c: F.aggregate(c, F.lit(0), lambda a, v: a + v)),
            lambda totals: F.flatten(F.zip_with(cs, sums(totals, F.lit(0)), sums))))

    return one(values, lambda numbers: F.when(
        F.size(numbers) > 0, add_up(numbers)).otherwise(F.array().cast("array<int>")))
