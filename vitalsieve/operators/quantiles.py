"""Exact and approximate interpolated quantiles of many columns at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from vitalsieve.functions.columns import quoted, tall
from vitalsieve.functions.ordering import linear_bucket, order_bucket
from vitalsieve.session import SMALL_ROWS

_PER_OCTAVE = 1024
_PARTS = 4096


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    method: str = "select",
    accuracy: int = 10_000,
) -> DataFrame:
    """Linearly interpolated quantiles: one row per (``by``, feature, prob) with ``value`` and row count ``n``.

    ``select`` (default) is exact for any size: it narrows the value range around each wanted rank by counting, so no
    task ever holds the values of a column. ``hash`` is Spark's ``percentile``: one pass, exact, keeps a map of the
    distinct values and so suits columns known to have few. ``approx`` is ``percentile_approx``; its rank error is
    1/accuracy and the bound comes back in ``rank_error``.
    """
    if method == "select":
        return _by_selection(df, columns, probs, list(by))
    long = tall(df, columns, by).filter(F.col("value").isNotNull())
    keys = [*by, "feature"]
    wanted = F.array(*[F.lit(float(p)) for p in probs])
    if method == "hash":
        values = F.percentile("value", wanted)
    elif method == "approx":
        values = F.percentile_approx("value", wanted, F.lit(accuracy))
    else:
        raise ValueError(f"unknown quantile method: {method}")
    out = (
        long.groupBy(*map(quoted, keys))
        .agg(values.alias("values"), F.count(F.lit(1)).alias("n"))
        .select(*map(quoted, keys), "n", F.posexplode(F.arrays_zip(wanted.alias("prob"), F.col("values").alias("value"))))
        .select(*map(quoted, keys), F.col("col.prob").alias("prob"), F.col("col.value").alias("value"), "n")
    )
    return out.withColumn("rank_error", F.lit(1.0 / accuracy)) if method == "approx" else out


def _by_selection(df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: list[str]) -> DataFrame:
    """Three counting passes: geometric buckets, linear parts of one bucket, values of one part.

    Each pass shuffles only counts per bucket, combined before the shuffle, so neither skew nor size matters. What is
    joined back is one row per (group, feature, prob, side).
    """
    long = tall(df, columns, by).filter(F.col("value").isNotNull() & ~F.isnan("value"))
    keys = [*by, "feature"]
    few_groups = groups_fit(df, by, len(columns) * len(probs) * 2)

    first = (
        long.groupBy(*map(quoted, keys), order_bucket(F.col("value"), _PER_OCTAVE).alias("bucket"))
        .agg(F.count(F.lit(1)).alias("cnt"), F.min("value").alias("lo"), F.max("value").alias("hi"))
        .withColumn("n", F.sum("cnt").over(W.partitionBy(*map(quoted, keys))))
        .withColumn("before", _running(keys) - F.col("cnt"))
        .withColumn("want", F.explode(_wanted_ranks(probs, F.col("n"))))
        .select(*map(quoted, keys), "n", "before", "cnt", "lo", "hi", "want.prob", "want.side", "want.rank", "want.frac")
    )
    bracket = _hit(first)
    bracket = _narrow(long, bracket, by, few_groups, lambda v, lo, hi: linear_bucket(v, lo, hi, _PARTS))
    bracket = _narrow(long, bracket, by, few_groups, lambda v, lo, hi: v)
    low = F.max(F.when(F.col("side") == 0, F.col("lo")))
    high = F.max(F.when(F.col("side") == 1, F.col("lo")))
    return (
        bracket.groupBy(*map(quoted, keys), "prob")
        .agg((low + (high - low) * F.max("frac")).alias("value"), F.max("n").alias("n"))
        .select(*map(quoted, keys), "prob", "value", "n")
    )


def groups_fit(df: DataFrame, by: Sequence[str], rows_per_group: int) -> bool:
    """Are there so few groups that a table with ``rows_per_group`` rows for each may be broadcast?"""
    if not by:
        return True
    limit = SMALL_ROWS // rows_per_group
    return df.select(*map(quoted, by)).distinct().limit(limit + 1).count() <= limit


def _wanted_ranks(probs: Sequence[float], n: Column) -> Column:
    """1-based ranks on both sides of each wanted position, and how far between them the quantile lies."""
    wanted = []
    for p in probs:
        position = F.lit(float(p)) * (n - 1)
        for side, rank in ((0, F.floor(position)), (1, F.ceil(position))):
            wanted.append(
                F.struct(
                    F.lit(float(p)).alias("prob"),
                    F.lit(side).alias("side"),
                    (rank + 1).alias("rank"),
                    (position - F.floor(position)).alias("frac"),
                )
            )
    return F.array(*wanted)


def _running(keys: list[str]) -> Column:
    over = W.partitionBy(*map(quoted, keys)).orderBy("bucket").rowsBetween(W.unboundedPreceding, 0)
    return F.sum("cnt").over(over)


def _hit(counts: DataFrame) -> DataFrame:
    """Keep the bucket that holds the wanted rank and count the rank from the start of that bucket."""
    inside = (F.col("rank") > F.col("before")) & (F.col("rank") <= F.col("before") + F.col("cnt"))
    return counts.filter(inside).withColumn("rank", F.col("rank") - F.col("before")).drop("before", "cnt")


def _narrow(long: DataFrame, bracket: DataFrame, by: list[str], few_groups: bool, bucket) -> DataFrame:
    keys = [*by, "feature", "prob", "side"]
    side = bracket.select(
        *[F.col(quoted(c)).alias(f"g{i}") for i, c in enumerate(by)],
        F.col("feature").alias("b_feature"), "prob", "side", "rank", "frac", "n", "lo", "hi",
    )
    same = F.col("feature") == F.col("b_feature")
    for i, c in enumerate(by):
        same = same & F.col(quoted(c)).eqNullSafe(F.col(f"g{i}"))
    inside = F.col("value").between(F.col("lo"), F.col("hi"))
    matched = long.join(F.broadcast(side) if few_groups else side, same & inside)
    counts = (
        matched.groupBy(
            *map(quoted, keys), "rank", "frac", "n", bucket(F.col("value"), F.col("lo"), F.col("hi")).alias("bucket")
        )
        .agg(F.count(F.lit(1)).alias("cnt"), F.min("value").alias("lo"), F.max("value").alias("hi"))
        .withColumn("before", _running(keys) - F.col("cnt"))
        .drop("bucket")
    )
    return _hit(counts)
