"""Category levels without a limit: a dictionary as a table, joined in, and sparse 0/1 slots.

The dictionary is never held by the driver. Its numbers come from ranges of the sorted levels, and rows find them by a join that
keeps frequent levels apart, so no level gathers its rows in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import Column, DataFrame, Window, functions as F

from vitalsieve.functions.columns import col

#: Levels with more than this share of a column's rows are looked up by broadcast; there are at most 1 / HOT of them.
HOT = 0.001


def ordered_index(df: DataFrame, group: str, order: Sequence[Column], path: str) -> DataFrame:
    """``df`` with ``index``: its place in the order within its group, from 0, written below ``path``.

    Rows are dealt in ranges of (group, order) and numbered where they lie; a table of one row per range and group says where each
    range starts. Equal rows share places in any order.
    """
    spread = df.repartitionByRange(col(group), *order).sortWithinPartitions(col(group), *order)
    spread.withColumn("_at", F.monotonically_increasing_id()).write.mode("overwrite").parquet(path)
    rows = df.sparkSession.read.parquet(path).withColumn("_range", F.shiftright("_at", 33))
    ranges = rows.groupBy(group, "_range").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.select(group, "_range", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    return rows.join(starts, [group, "_range"]).withColumn("index", F.col("_at") + F.col("_shift")).drop("_at", "_range", "_shift")


def level_dictionary(counts: DataFrame, numbers: Sequence[str], path: str) -> DataFrame:
    """(feature, level, n, is_mode, index) from the counts of ``category_levels``, kept at ``path``.

    Levels are numbered in the order in which fitted vectors have their slots: numbers by value, texts by their text.
    """
    as_number = F.when(F.col("feature").isin(*numbers, ""), F.col("level").try_cast("double"))
    numbered = ordered_index(counts, "feature", [as_number, F.col("level")], f"{path}/sorted")
    numbered.write.mode("overwrite").partitionBy("feature").parquet(f"{path}/levels")
    return read_dictionary(counts.sparkSession, path)


def read_dictionary(spark, path: str) -> DataFrame:
    return spark.read.schema("level string, n long, is_mode boolean, index long, feature string").parquet(f"{path}/levels")


def with_level_index(df: DataFrame, column: str, dictionary: DataFrame, size: int, mode: str | None, out: str) -> DataFrame:
    """``df`` with ``out``: the number of the column's level, or ``size`` for a level that was not there when fitting.

    Gaps count as the most frequent level. Frequent levels come from a broadcast of at most 1 / HOT rows; the rows of the others are
    joined by shuffle, and those that have their answer are spread over all tasks meanwhile.
    """
    mine = dictionary.filter(F.col("feature") == column)
    total = mine.agg(F.sum("n")).scalar()
    often = F.broadcast(mine.filter(F.col("n") > total * HOT).select(F.col("level").alias("_level"), F.col("index").alias("_hot")))
    rest = mine.filter(F.col("n") <= total * HOT).select(F.col("level").alias("_key"), F.lit(True).alias("_open"), F.col("index").alias("_cold"))
    rows = df.withColumn("_level", F.coalesce(col(column).cast("string"), F.lit(mode))).join(often, "_level", "left")
    unknown = F.col("_hot").isNull() & F.col("_level").isNotNull()
    key = F.when(unknown, F.col("_level")).otherwise(F.pmod(F.monotonically_increasing_id(), F.lit(4096)).cast("string"))
    rows = rows.withColumns({"_open": unknown, "_key": key}).join(rest, ["_key", "_open"], "left")
    return rows.withColumn(out, F.coalesce("_hot", "_cold", F.lit(size)).cast("double")).drop("_level", "_hot", "_key", "_open", "_cold")


def slots(df: DataFrame, index: str, size: int, out: str) -> DataFrame:
    """Sparse 0/1 vector of ``size`` slots from a level number; ``size`` itself, an unknown level, gives zeros."""
    widest = df.sparkSession.createDataFrame([(float(size - 1),)], f"`{index}` double")
    encoder = OneHotEncoder(inputCols=[index], outputCols=[out], dropLast=True, handleInvalid="keep").fit(widest)
    return encoder.transform(df)
