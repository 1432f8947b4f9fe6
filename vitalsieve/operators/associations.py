"""Correlation, prevalence and contingency tables."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from vitalsieve.functions.columns import col, percent, quoted, tall


def pearson(x: Column, y: Column) -> Column:
    """Correlation over rows where both values are present; NULL, not an error, for a constant column."""
    both = x.isNotNull() & y.isNotNull()
    a, b = F.when(both, x.cast("double")), F.when(both, y.cast("double"))
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


#: Above so many columns, pairs are worked out as matrices and not as aggregates of their own.
FEW_COLUMNS = 12


def _moments(columns: int, pivots: Sequence[float]):
    """Sums per pair of columns over a task's rows: rows that have both, and of those x, x² and xy, all around the pivots.

    With the values X, gaps as 0, and their mask M these are the four products M'M, X'M, (X²)'M and X'X: two blocks in, one set of matrices out.
    """
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, seen = np.zeros((4, columns, columns)), False
        for batch in batches:
            block = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype(np.float64) - pivots
            mask = ~np.isnan(block)
            values, present = np.where(mask, block, 0.0), mask.astype(np.float64)
            sums += np.stack([present.T @ present, values.T @ present, (values * values).T @ present, values.T @ values])
            seen = True
        if seen:
            i, j = (x.ravel() for x in np.indices((columns, columns)))
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), *[pa.array(x.ravel()) for x in sums]], ["i", "j", "n", "x", "xx", "xy"])

    return task


def gram_correlations(df: DataFrame, columns: Sequence[str], lower_only: bool = False) -> DataFrame:
    """The same as ``correlation_matrix`` for very many columns: one pass, one set of matrices summed per task.

    A pair's correlation is over the rows that have both values. Sums are taken around the columns' means, so that large values with little
    spread lose nothing. NaN counts as a gap. The driver holds a mean per column.
    """
    names = list(columns)
    numbers = df.select(*[F.nanvl(col(c).cast("double"), F.lit(None).cast("double")).alias(f"c{i}") for i, c in enumerate(names)])
    means = [m or 0.0 for m in numbers.agg(*[F.avg(c) for c in numbers.columns]).first()]
    parts = numbers.mapInArrow(_moments(len(names), means), "i int, j int, n double, x double, xx double, xy double")
    sums = parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "x", "xx", "xy")])
    other = sums.select(F.col("i").alias("j"), F.col("j").alias("i"), F.col("x").alias("y"), F.col("xx").alias("yy"))
    both = F.col("xy") - F.try_divide(F.col("x") * F.col("y"), F.col("n"))
    spreads = [F.col(f"{v}{v}") - F.try_divide(F.col(v) * F.col(v), F.col("n")) for v in "xy"]
    real = (spreads[0] > 1e-12 * F.col("xx")) & (spreads[1] > 1e-12 * F.col("yy"))
    corr = F.when(real, both / F.sqrt(spreads[0] * spreads[1]))
    labels = df.sparkSession.createDataFrame([(i, j, names[i], names[j]) for i in range(len(names)) for j in range(i if lower_only else len(names))], "i int, j int, row string, column string")
    found = sums.join(other, ["i", "j"]).select("i", "j", corr.alias("corr"))
    return labels.join(found, ["i", "j"], "left").select("row", "column", "i", "j", "corr")


def correlation_matrix(df: DataFrame, columns: Sequence[str], lower_only: bool = False) -> DataFrame:
    """(row, column, i, j, corr) from one aggregate over the pairs i > j; mirrored and completed unless ``lower_only``.

    More than ``FEW_COLUMNS`` go through ``gram_correlations``, whose plan does not grow with the pairs.
    """
    names = list(columns)
    if len(names) > FEW_COLUMNS:
        return gram_correlations(df, names, lower_only)
    pairs = [(i, j) for i in range(len(names)) for j in range(i)]
    wide = df.agg(
        *[pearson(col(names[i]), col(names[j])).alias(f"r{i}_{j}") for i, j in pairs],
        *[pearson(col(c), col(c)).alias(f"d{i}") for i, c in enumerate(names)],
    )

    def cell(i: int, j: int, value: Column) -> Column:
        return F.struct(
            F.lit(names[i]).alias("row"), F.lit(names[j]).alias("column"), F.lit(i).alias("i"), F.lit(j).alias("j"), value.alias("corr")
        )

    cells = [cell(i, j, F.col(f"r{i}_{j}")) for i, j in pairs]
    if not lower_only:
        cells += [cell(j, i, F.col(f"r{i}_{j}")) for i, j in pairs]
        cells += [cell(i, i, F.col(f"d{i}")) for i in range(len(names))]
    return wide.select(F.inline(F.array(*cells)))


def correlation_with_target(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """(feature, corr) of each column with the target."""
    wide = df.agg(*[pearson(col(c), col(target)).alias(f"r{i}") for i, c in enumerate(columns)])
    rows = [F.struct(F.lit(c).alias("feature"), F.col(f"r{i}").alias("corr")) for i, c in enumerate(columns)]
    return wide.select(F.inline(F.array(*rows)))


def missing_rate_by_class(df: DataFrame, column: str, target: str) -> DataFrame:
    """(class, n, missing_pct)."""
    return df.groupBy(col(target).alias("class")).agg(
        F.count(F.lit(1)).alias("n"), (F.avg(col(column).isNull().cast("int")) * 100).alias("missing_pct")
    )


def prevalence(df: DataFrame, categories: Sequence[str], target: str) -> DataFrame:
    """Target count, rate and percentage by category level: (feature, level, n, rate, rate_pct). One pass for all."""
    long = tall(df.withColumn("_y", col(target).cast("double")), categories, ["_y"], "string")
    return (
        long.groupBy("feature", F.col("value").alias("level"))
        .agg(F.count("_y").alias("n"), F.avg("_y").alias("rate"))
        .withColumn("rate_pct", F.col("rate") * 100)
    )


def crosstab(df: DataFrame, category: str, target: str, levels: Sequence[object]) -> DataFrame:
    """Contingency table: one column ``n_<level>`` per target level."""
    return df.groupBy(col(category).alias("level")).agg(
        *[F.count_if(col(target) == F.lit(v)).alias(f"n_{v}") for v in levels]
    )


def flag_prevalence(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """(feature, pct) of rows where the flag is 1."""
    return tall(df, flags).groupBy("feature").agg((F.avg((F.col("value") == 1).cast("int")) * 100).alias("pct"))


def flag_rate_gap(df: DataFrame, flags: Sequence[str], target: str, positive: object = 1) -> DataFrame:
    """Positive rate with and without each flag, in percent, and the difference. One pass for all flags."""
    long = tall(df.withColumn("_y", (col(target) == F.lit(positive)).cast("double")), flags, ["_y"])
    y, v = F.col("_y"), F.col("value")
    return (
        long.groupBy("feature")
        .agg(
            F.count_if(v == 1).alias("n_present"),
            (F.avg(F.when(v == 1, y)) * 100).alias("rate_present"),
            (F.avg(F.when(v == 0, y)) * 100).alias("rate_absent"),
        )
        .withColumn("gap", F.col("rate_present") - F.col("rate_absent"))
    )


def class_distribution(df: DataFrame, split: str, label: str) -> DataFrame:
    """(split, label, n, pct of the split)."""
    counts = df.groupBy(col(split).alias("split"), col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy(F.col("split").alias("_of")).agg(F.sum("n").alias("total"))
    return counts.join(totals, F.col("split").eqNullSafe(F.col("_of"))).select("split", "label", "n", percent(F.col("n"), F.col("total")).alias("pct"))
