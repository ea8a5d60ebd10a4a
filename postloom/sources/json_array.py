"""Records of JSON array files of any size, read in parts by many tasks.

A file that holds one array may be one endless line. It is cut at every ``}``, which the text
reader does at byte ranges. Whether such a piece begins inside a string is not known to its
task, so the piece counts its unescaped quotes and how far the depth changes in either case.
Sums over the pieces of a byte range, and over the ranges of a file, then give each piece the
quote state and depth at its start; a record ends with the piece that returns to depth one.

A file that is no array of objects (broken text, another value) has no records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_RANGE = ["file", "block"]


def _net(text: Column) -> Column:
    """Opened less closed levels; ``}`` only stands between pieces."""
    return F.length(F.replace(text, F.lit("]"))) - F.length(F.translate(text, "{[", ""))


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, seq, value) and, for a start outside and inside of a string, the quotes
    and the change of depth; the ``}`` behind a piece is part of it."""
    read = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"), "value")
    segments = F.split(F.regexp_replace("value", r"(?s)\\.", ""), '"')
    part = lambda rest: F.array_join(
        F.filter("segments", lambda s, i: i % 2 == rest), "")
    odd = F.col("quotes") % 2
    return read.withColumn("segments", segments).withColumn(
        "quotes", F.size("segments") - 1).select(
        *_RANGE, "seq", "value", "quotes",
        (_net(part(0)) - (odd == 0).cast("int")).alias("outside"),
        (_net(part(1)) - (odd == 1).cast("int")).alias("inside"))


def _before(value: Column | str, *keys: str, order: str) -> Column:
    """Sum of the rows in front of a row."""
    window = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(window), F.lit(0))


def _placed(read: DataFrame) -> DataFrame:
    """Pieces with ``depth`` behind them, whether a record ends there, and whether they are last."""
    own = read.withColumn("odd", _before("quotes", *_RANGE, order="seq") % 2)
    either = own.withColumns({
        "if_outside": F.when(F.col("odd") == 0, F.col("outside")).otherwise(F.col("inside")),
        "if_inside": F.when(F.col("odd") == 0, F.col("inside")).otherwise(F.col("outside"))})
    ranges = either.groupBy(*_RANGE).agg(
        F.sum("quotes").alias("quotes"), F.sum("if_outside").alias("if_outside"),
        F.sum("if_inside").alias("if_inside"), F.max("seq").alias("last_seq"))
    # one row for each byte range
    starts = ranges.withColumn("start_odd", _before("quotes", "file", order="block") % 2)
    change = F.when(F.col("start_odd") == 0, F.col("if_outside")).otherwise(F.col("if_inside"))
    last = F.col("block") == F.max("block").over(Window.partitionBy("file"))
    starts = starts.select(
        *_RANGE, "start_odd", F.when(last, F.col("last_seq")).alias("last_seq"),
        _before(change, "file", order="block").alias("start_depth"))
    moved = F.when(F.col("start_odd") == 0, F.col("if_outside")).otherwise(F.col("if_inside"))
    # no brace stands behind the last piece
    is_last = F.coalesce(F.col("seq") == F.col("last_seq"), F.lit(False))
    in_string = (F.col("start_odd") + F.col("odd") + F.col("quotes")) % 2 == 1
    running = Window.partitionBy(*_RANGE).orderBy("seq").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    joined = either.join(starts, _RANGE).withColumn(
        "moved", moved + F.when(is_last & ~in_string, 1).otherwise(0))
    return joined.select(
        *_RANGE, "seq", "value", is_last.alias("is_last"), in_string.alias("in_string"),
        (F.col("start_depth") + F.sum("moved").over(running)).alias("depth"))


def array_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, pos, json) of every object of the arrays in the files of ``path``."""
    placed = _placed(pieces(spark, path)).withColumn("ends", (
        (F.col("depth") == 1) & ~F.col("in_string") & ~F.col("is_last")).cast("int"))
    counts = placed.groupBy(*_RANGE).agg(F.sum("ends").alias("n"))
    offsets = counts.select(*_RANGE, _before("n", "file", order="block").alias("offset"))
    numbered = placed.withColumn("own", _before("ends", *_RANGE, order="seq")).join(
        offsets, _RANGE).withColumn("pos", F.col("own") + F.col("offset"))
    # the rows of one record, and what stands behind the last one
    grouped = numbered.groupBy("file", "pos").agg(
        F.array_sort(F.collect_list(F.struct("block", "seq", "value"))).alias("rows"),
        F.max("is_last").alias("tail"), F.max_by("depth", F.struct("block", "seq")).alias("depth"))
    whole = F.array_join(F.transform("rows", lambda r: r["value"]), "}")
    texts = grouped.select("file", "pos", "tail", "depth", F.when(
        F.col("tail"), whole).otherwise(F.concat(whole, F.lit("}"))).alias("text"))
    json = F.regexp_replace("text", r"\A\s*[\[,]\s*", "")
    good = F.when(
        F.col("tail"), (F.col("depth") == 0) & F.col("text").rlike(r"\A\s*\]\s*\z")
        | F.col("text").rlike(r"\A\s*\[\s*\]\s*\z") & (F.col("pos") == 0)).otherwise(
        F.col("text").rlike(r"\A\s*[\[,]\s*\{") & (F.col("text").rlike(r"\A\s*\[") == (F.col("pos") == 0))
        & F.from_json(json, "bad string, nothing string", {"columnNameOfCorruptRecord": "bad"})["bad"].isNull())
    checked = texts.select("file", "pos", "tail", json.alias("json"), good.alias("good"))
    broken = checked.where(~F.coalesce("good", F.lit(False))).select("file").distinct()
    return checked.where(~F.col("tail")).join(broken, "file", "left_anti").select(
        "file", "pos", "json")
