"""Outliers, box-plot numbers, histograms and kernel density."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from vitalsieve.functions.columns import col, percent, quoted, tall
from vitalsieve.operators.quantiles import groups_fit, quantiles


def _quartiles(df: DataFrame, columns: Sequence[str], probs: list[float], names: list[str], by: Sequence[str], method: str) -> DataFrame:
    spread = quantiles(df, columns, probs, by, method)
    return spread.groupBy(*map(quoted, [*by, "feature"])).agg(
        *[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n) for p, n in zip(probs, names)]
    )


def iqr_bounds(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), method: str = "select") -> DataFrame:
    """(by..., feature, q25, q75, iqr, lower, upper): the fences lie 1.5 interquartile ranges outside the quartiles."""
    iqr = F.col("q75") - F.col("q25")
    return (
        _quartiles(df, columns, [0.25, 0.75], ["q25", "q75"], by, method)
        .withColumn("iqr", iqr)
        .withColumn("lower", F.col("q25") - 1.5 * iqr)
        .withColumn("upper", F.col("q75") + 1.5 * iqr)
    )


def iqr_outliers(df: DataFrame, columns: Sequence[str], base: str = "valid", method: str = "select") -> DataFrame:
    """Outlier summary per column. ``base`` of the percentage: ``valid`` (non-null) or ``all`` rows."""
    bounds = iqr_bounds(df, columns, method=method)
    value = F.col("value")
    counts = (
        tall(df, columns)
        .join(F.broadcast(bounds), "feature")
        .groupBy("feature", "q25", "q75", "iqr", "lower", "upper")
        .agg(
            F.count("value").alias("valid_count"),
            F.count(F.lit(1)).alias("all_count"),
            F.count_if((value < F.col("lower")) | (value > F.col("upper"))).alias("outliers"),
        )
    )
    whole = F.col("valid_count") if base == "valid" else F.col("all_count")
    return counts.select(
        "feature", "valid_count", "q25", "q75", "iqr", "lower", "upper", "outliers",
        percent(F.col("outliers"), whole).alias("outlier_pct"),
    )


def outlier_rows(df: DataFrame, column: str, method: str = "select") -> DataFrame:
    """Rows of the table whose value lies outside the fences of the column."""
    bounds = iqr_bounds(df, [column], method=method).select(F.struct("lower", "upper").alias("b")).scalar()
    return df.filter((col(column) < bounds["lower"]) | (col(column) > bounds["upper"]))


def box_by_class(df: DataFrame, columns: Sequence[str], by: str, method: str = "select") -> DataFrame:
    """Box-plot numbers per class: quartiles, whiskers (furthest values inside the fences) and points beyond them."""
    iqr = F.col("q3") - F.col("q1")
    boxes = (
        _quartiles(df, columns, [0.25, 0.5, 0.75], ["q1", "median", "q3"], [by], method)
        .withColumn("_lower", F.col("q1") - 1.5 * iqr)
        .withColumn("_upper", F.col("q3") + 1.5 * iqr)
        .withColumnRenamed(by, "_class")
        .withColumnRenamed("feature", "_feature")
    )
    rows = tall(df, columns, [by]).filter(F.col("value").isNotNull())
    same = (F.col("feature") == F.col("_feature")) & col(by).eqNullSafe(F.col("_class"))
    inside = F.col("value").between(F.col("_lower"), F.col("_upper"))
    return (
        rows.join(F.broadcast(boxes) if groups_fit(df, [by], len(columns)) else boxes, same)
        .groupBy(quoted(by), "feature", "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
            F.count_if(~inside).alias("beyond"),
        )
    )


def histogram(df: DataFrame, column: str, bins: int | None = None, by: str | None = None) -> DataFrame:
    """Equal-width counts and density, per class if ``by`` is given. Bins default to Sturges' rule.

    Range and row count come from one aggregate used as scalar subqueries; then one grouped count.
    """
    value = col(column).cast("double")
    stats = df.agg(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi"), F.count(value).cast("double").alias("n")).alias("s")).scalar()
    low, high = stats["lo"], stats["hi"]
    parts = F.lit(bins) if bins else (F.ceil(F.log2(stats["n"])) + 1)
    keyed = df.filter(value.isNotNull()).select(
        *([col(by)] if by else []),
        F.least(F.coalesce(F.floor(F.try_divide((value - low) * parts, high - low)), F.lit(0)), parts - 1).alias("bucket"),
    )
    keys = [quoted(by)] if by else []
    counts = keyed.groupBy(*keys, "bucket").agg(F.count(F.lit(1)).alias("n"))
    if by:
        totals = counts.groupBy(col(by).alias("_of")).agg(F.sum("n").alias("total"))
        counts = counts.join(totals, col(by).eqNullSafe(F.col("_of"))).drop("_of")
    else:
        counts = counts.withColumn("total", counts.agg(F.sum("n")).scalar())
    width = (high - low) / parts
    return counts.select(
        *keys, F.col("bucket").cast("long").alias("bucket"), (low + F.col("bucket") * width).alias("bin_start"), "n",
        F.try_divide(F.col("n"), F.col("total") * width).alias("density"),
    )


def kernel_density(df: DataFrame, column: str, points: int = 200, bins: int | None = None) -> DataFrame:
    """Gaussian kernel density at ``points`` equally spaced values between the minimum and the maximum.

    The bandwidth is the sample deviation times n^(-1/5). Equal values are counted first; ``bins`` also rounds values
    to that many equal-width cells, which bounds the work per grid point by ``bins`` at any number of rows. A constant column has no
    density: NULL.
    """
    value = col(column).cast("double")
    data = df.filter(value.isNotNull())
    stats = data.agg(F.struct(
        F.min(value).alias("lo"), F.max(value).alias("hi"), F.count(value).cast("double").alias("n"), F.stddev_samp(value).alias("sd")
    ).alias("s")).scalar()
    low, high, n, sd = (stats[c] for c in ("lo", "hi", "n", "sd"))
    cell = value if bins is None else low + (F.coalesce(F.floor(F.try_divide(value - low, high - low) * (bins - 1) + 0.5), F.lit(0)) * (high - low) / (bins - 1))
    counted = data.groupBy(cell.alias("v")).agg(F.count(F.lit(1)).alias("cnt"))
    step = (high - low) / (points - 1)
    width = sd * F.pow(n, F.lit(-0.2))
    spread = counted.select("v", "cnt", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i"))
    z = F.try_divide(low + F.col("i") * step - F.col("v"), width)
    mass = F.sum(F.col("cnt") * F.exp(-0.5 * z * z))
    return (
        spread.groupBy("i")
        .agg(mass.alias("mass"))
        .select("i", (low + F.col("i") * step).alias("x"), F.try_divide(F.col("mass"), n * width * math.sqrt(2.0 * math.pi)).alias("density"))
    )


def mean_and_median(df: DataFrame, columns: Sequence[str], method: str = "select") -> DataFrame:
    medians = quantiles(df, columns, [0.5], method=method).select("feature", F.col("value").alias("median"))
    means = tall(df, columns).groupBy("feature").agg(F.avg("value").alias("mean"))
    return means.join(F.broadcast(medians), "feature", "left")
