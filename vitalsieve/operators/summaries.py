"""Column summaries that scale with columns and merge: exact distinct counts in one grouped pass, and sketches per part of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from vitalsieve.functions.columns import col, columns_of_type, quoted


def exact_distincts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, n_distinct): values of each column, NULL not counted.

    Values travel as (column, 128 hash bits), combined before the shuffle, whatever their width: one grouped pass for all columns, in
    place of one copy of each row per column. A column without values counts 0.
    """
    def tagged(i: int, name: str):
        value = col(name)
        return F.struct(F.lit(i).alias("i"), F.xxhash64(F.lit("a"), value).alias("a"), F.xxhash64(F.lit("b"), value).alias("b"), value.isNotNull().alias("known"))

    names = df.sparkSession.createDataFrame([(i, c) for i, c in enumerate(columns)], "i int, feature string")  # a row per column
    values = df.select(F.explode(F.array(*[tagged(i, c) for i, c in enumerate(columns)])).alias("v")).select("v.*").filter("known")
    counts = values.groupBy("i", "a", "b").agg(F.count(F.lit(1)).alias("n")).groupBy("i").agg(F.count(F.lit(1)).alias("n_distinct"))
    return F.broadcast(names).join(counts, "i", "left").select("feature", F.coalesce("n_distinct", F.lit(0)).cast("long").alias("n_distinct"))


def column_sketches(df: DataFrame, columns: Sequence[str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """(by..., feature, n, missing, zeros, min, max, mean, m2, sketch): what is kept of each column of each part.

    ``m2`` is the sum of squared distances from the mean; ``sketch`` an HLL sketch of the values as text. Columns that are no numbers have
    NULL moments. Every field merges with that of another part: keep one such row per file or day, and never read the part again.
    """
    names = list(columns or [c for c in df.columns if c not in by])
    numeric = set(columns_of_type(df.select(*map(quoted, names)), "numeric"))
    none = F.lit(None).cast("double")
    aggs, rows = [F.count(F.lit(1)).alias("n")], []
    for i, c in enumerate(names):
        value = col(c).cast("double") if c in numeric else none
        parts = {
            "missing": F.count_if(col(c).isNull()), "zeros": F.count_if(value == 0) if c in numeric else F.lit(None).cast("long"),
            "min": F.min(value), "max": F.max(value), "mean": F.avg(value), "m2": F.var_pop(value) * F.count(value),
            "sketch": F.hll_sketch_agg(col(c).cast("string")),
        }
        aggs += [agg.alias(f"{k}_{i}") for k, agg in parts.items()]
        rows.append(F.struct(F.lit(c).alias("feature"), *[F.col(f"{k}_{i}").alias(k) for k in parts]))
    wide = df.groupBy(*map(quoted, by)).agg(*aggs)
    return wide.select(*map(quoted, by), "n", F.inline(F.array(*rows)))


def merged_sketches(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The sketches of parts as those of their union, per ``by`` and feature, in the same columns.

    Means and squared distances merge from the parts' own; no part is read. Merging in any order or in steps gives the same up to rounding.
    """
    known = F.col("n") - F.col("missing")
    keys = [*map(quoted, by), "feature"]
    total = F.sum(F.when(F.col("mean").isNotNull(), known))
    mean = F.try_divide(F.sum(known * F.col("mean")), total)
    merged = sketches.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.sum("missing").alias("missing"), F.sum("zeros").alias("zeros"), F.min("min").alias("min"), F.max("max").alias("max"),
        mean.alias("mean"), (F.sum("m2") + F.greatest(F.sum(known * F.col("mean") * F.col("mean")) - total * mean * mean, F.lit(0.0))).alias("m2"),
        F.hll_union_agg("sketch").alias("sketch"),
    )
    return merged.select(*map(quoted, by), "n", "feature", "missing", "zeros", "min", "max", "mean", "m2", "sketch")


def summarised(sketches: DataFrame) -> DataFrame:
    """Readable columns of sketches: distinct values (within about 2 %), standard deviation of the sample, shares."""
    known = F.col("n") - F.col("missing")
    return sketches.withColumns({
        "n_distinct": F.hll_sketch_estimate("sketch"), "std": F.when(known > 1, F.sqrt(F.col("m2") / (known - 1))),
        "missing_pct": F.try_divide(F.col("missing") * 100.0, F.col("n")),
    }).drop("sketch", "m2")
