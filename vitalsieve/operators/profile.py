"""Column profiles, audits and value counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from vitalsieve.functions.columns import col, columns_of_type, percent, quoted, tall
from vitalsieve.operators.dedup import duplicate_count
from vitalsieve.operators.quantiles import quantiles
from vitalsieve.operators.summaries import exact_distincts


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """(value, n). Order the result by either as needed."""
    return df.groupBy(col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def value_share(df: DataFrame, column: str) -> DataFrame:
    """(value, n, pct); NULL is a class of its own."""
    counts = value_counts(df, column)
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("pct", percent(F.col("n"), total))


def imbalance(df: DataFrame, column: str) -> DataFrame:
    """One row: classes, largest and smallest class, and their ratio."""
    return value_counts(df, column).agg(
        F.count(F.lit(1)).alias("n_classes"),
        F.max("n").alias("n_majority"),
        F.min("n").alias("n_minority"),
        (F.max("n") / F.min("n")).alias("ratio"),
    )


def missing_values(df: DataFrame, columns: Sequence[str] | None = None, only_present: bool = False) -> DataFrame:
    """(feature, missing, missing_pct) from one aggregate over all columns."""
    names = list(columns or df.columns)
    wide = df.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(col(c).isNull()).alias(f"m{i}") for i, c in enumerate(names)])
    rows = [F.struct(F.lit(c).alias("feature"), F.col(f"m{i}").alias("missing")) for i, c in enumerate(names)]
    out = wide.select("n", F.inline(F.array(*rows))).select("feature", "missing", percent(F.col("missing"), F.col("n")).alias("missing_pct"))
    return out.filter("missing > 0") if only_present else out


def distinct_values(df: DataFrame, columns: Sequence[str], null_is_value: bool = False, exact: bool = True) -> DataFrame:
    """(feature, n_distinct). ``exact=False`` uses sketches: one pass and no shuffle of values."""
    aggs = []
    for i, c in enumerate(columns):
        n = F.lit(0).cast("long") if exact else F.approx_count_distinct(col(c))
        extra = F.coalesce(F.max(col(c).isNull().cast("int")), F.lit(0)) if null_is_value else F.lit(0)
        aggs.append((n + extra).alias(f"d{i}"))
    rows = [F.struct(F.lit(c).alias("feature"), F.col(f"d{i}").alias("n_distinct")) for i, c in enumerate(columns)]
    if exact and not null_is_value:
        return exact_distincts(df, columns)
    extra = df.agg(*aggs).select(F.inline(F.array(*rows)))
    if not exact:
        return extra
    exact_counts = exact_distincts(df, columns).withColumnRenamed("n_distinct", "known")
    return extra.join(F.broadcast(exact_counts), "feature").select("feature", (F.col("known") + F.col("n_distinct")).alias("n_distinct"))


def constant_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns with at most one value, NULL counted as a value. Needs only the minimum, maximum and null count."""
    aggs = []
    for i, c in enumerate(columns):
        value = col(c).cast("string")
        aggs += [F.min(value).alias(f"a{i}"), F.max(value).alias(f"b{i}"), F.max(value.isNull()).alias(f"c{i}")]
    rows = [
        F.struct(
            F.lit(c).alias("feature"),
            ((F.col(f"a{i}").isNull()) | ((F.col(f"a{i}") == F.col(f"b{i}")) & ~F.col(f"c{i}"))).alias("constant"),
        )
        for i, c in enumerate(columns)
    ]
    return df.agg(*aggs).select(F.inline(F.array(*rows))).filter("constant").select("feature")


def identifier_columns(df: DataFrame, columns: Sequence[str], exact: bool = True) -> DataFrame:
    """(feature, n_distinct, n_rows, is_identifier): does the column have a value of its own on every row?"""
    rows = df.agg(F.count(F.lit(1))).scalar()
    return distinct_values(df, columns, exact=exact).withColumn("n_rows", rows).withColumn(
        "is_identifier", F.col("n_distinct") == F.col("n_rows")
    )


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def column_profile(
    df: DataFrame, columns: Sequence[str] | None = None, target: str | None = None, method: str = "select", exact: bool = True
) -> DataFrame:
    """Profile row per column: dtype, target flag, distinct, missing, zeros, min, mean, median, sample std, max.

    Text columns have NULL statistics. One aggregate for everything but the distinct counts and the medians.
    """
    names = list(columns or df.columns)
    kinds = dict(df.select(*map(quoted, names)).dtypes)
    numeric = [c for c in columns_of_type(df, "numeric") if c in names]
    aggs: list[Column] = [F.count(F.lit(1)).alias("n")]
    rows = []
    for i, c in enumerate(names):
        is_num = c in numeric
        value = col(c).cast("double") if is_num else F.lit(None).cast("double")
        parts = {
            "n_distinct": F.lit(None).cast("long") if exact else F.approx_count_distinct(col(c)),
            "missing": F.count_if(col(c).isNull()),
            "zeros": F.count_if(col(c) == 0) if is_num else F.lit(None).cast("long"),
            "min": F.min(value), "mean": F.avg(value), "std": F.stddev_samp(value), "max": F.max(value),
        }
        aggs += [agg.alias(f"{k}_{i}") for k, agg in parts.items()]
        rows.append(
            F.struct(
                F.lit(c).alias("feature"), F.lit(kinds[c]).alias("dtype"), F.lit(c == target).alias("is_target"),
                *[F.col(f"{k}_{i}").alias(k) for k in parts],
            )
        )
    base = df.agg(*aggs).select("n", F.inline(F.array(*rows)))
    if exact:
        base = base.drop("n_distinct").join(F.broadcast(exact_distincts(df, names)), "feature")
    base = base.withColumn("missing_pct", percent(F.col("missing"), F.col("n"))).withColumn("zero_pct", percent(F.col("zeros"), F.col("n")))
    if numeric:
        medians = quantiles(df, numeric, [0.5], method=method).select("feature", F.col("value").alias("median"))
        base = base.join(F.broadcast(medians), "feature", "left")
    else:
        base = base.withColumn("median", F.lit(None).cast("double"))
    return base.select(
        "feature", "dtype", "is_target", "n_distinct", "missing", "missing_pct", "zeros", "zero_pct",
        "min", "mean", "median", "std", "max",
    )


def summary_statistics(df: DataFrame, columns: Sequence[str], method: str = "select") -> DataFrame:
    """(feature, count, mean, std, min, q1, median, q3, max) with exact quartiles."""
    quart = (
        quantiles(df, columns, [0.25, 0.5, 0.75], method=method)
        .groupBy("feature")
        .pivot("prob", [0.25, 0.5, 0.75])
        .agg(F.first("value"))
        .toDF("feature", "q1", "median", "q3")
    )
    base = tall(df, columns).groupBy("feature").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"),
    )
    return base.join(F.broadcast(quart), "feature", "left").select("feature", "count", "mean", "std", "min", "q1", "median", "q3", "max")


def zero_audit(df: DataFrame, columns: Sequence[str], valid_zero: Sequence[str] = ()) -> DataFrame:
    """(feature, zeros, zero_pct, zero_is_valid)."""
    return (
        tall(df, columns)
        .groupBy("feature")
        .agg(F.count_if(F.col("value") == 0).alias("zeros"), F.count(F.lit(1)).alias("n"))
        .select("feature", "zeros", percent(F.col("zeros"), F.col("n")).alias("zero_pct"), F.col("feature").isin(*valid_zero, "").alias("zero_is_valid"))
    )


def feature_dictionary(profile: DataFrame, entries: Sequence[Mapping[str, str]]) -> DataFrame:
    """Contract entries (feature, logical_type, role, action, reason) beside the measured profile."""
    spark = profile.sparkSession
    known = spark.createDataFrame(
        [(e["feature"], e.get("logical_type"), e.get("role"), e.get("action"), e.get("reason")) for e in entries],
        "feature string, logical_type string, role string, cleaning_action string, reason string",
    )
    return F.broadcast(known).join(profile, "feature", "left").withColumn("is_excluded", F.col("role") != "predictor")


def input_schema(df: DataFrame) -> DataFrame:
    """(name, dtype, n_present, widest) of every column: its type, how many values it holds, and the longest as text."""
    aggs, rows = [], []
    for i, (name, kind) in enumerate(df.dtypes):
        aggs += [F.count(col(name)).alias(f"n{i}"), F.max(F.length(col(name).cast("string"))).alias(f"w{i}")]
        rows.append(F.struct(F.lit(name).alias("name"), F.lit(kind).alias("dtype"), F.col(f"n{i}").alias("n_present"), F.col(f"w{i}").alias("widest")))
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def verification_summary(df: DataFrame, target: str, columns: Sequence[str] | None = None) -> DataFrame:
    """One tall table (section, item, number) of shape, missing, distinct, constant and target shares."""
    names = list(columns or df.columns)
    parts = [
        shape(df).select(F.inline(F.array(
            F.struct(F.lit("shape").alias("section"), F.lit("rows").alias("item"), F.col("n_rows").cast("double").alias("number")),
            F.struct(F.lit("shape").alias("section"), F.lit("columns").alias("item"), F.col("n_columns").cast("double").alias("number")),
        ))),
        missing_values(df, names).select(F.lit("missing").alias("section"), F.col("feature").alias("item"), F.col("missing").cast("double").alias("number")),
        distinct_values(df, names, null_is_value=True).select(F.lit("distinct").alias("section"), F.col("feature").alias("item"), F.col("n_distinct").cast("double").alias("number")),
        constant_columns(df, names).select(F.lit("constant").alias("section"), F.col("feature").alias("item"), F.lit(1.0).alias("number")),
        duplicate_count(df, names).select(F.lit("duplicates").alias("section"), F.lit("rows").alias("item"), F.col("n_duplicates").cast("double").alias("number")),
        value_share(df, target).select(F.lit("target_pct").alias("section"), F.col("value").cast("string").alias("item"), F.col("pct").alias("number")),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def table_summary(name: str, df: DataFrame, target: str, positive: object, id_column: str | None = None) -> DataFrame:
    """One row for a cross-table overview; union the rows of several tables."""
    names = df.columns
    cells = sum((col(c).isNull().cast("int") for c in names), F.lit(0))
    content = [c for c in names if c != id_column]
    base = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(col(target) == F.lit(positive)).alias("n_positive"),
        F.sum(cells).alias("n_missing"),
    )
    unique = exact_distincts(df, [id_column]).select("n_distinct").scalar() == F.col("n_rows") if id_column else F.lit(None).cast("boolean")
    duplicates = duplicate_count(df, content).select("n_duplicates").scalar()
    return base.select(
        F.lit(name).alias("table_name"), "n_rows", F.lit(len(names)).alias("n_columns"), F.lit(target).alias("target"),
        "n_positive", percent(F.col("n_positive"), F.col("n_rows")).alias("positive_pct"), "n_missing",
        duplicates.alias("n_duplicates"), unique.alias("id_is_unique"),
    )


def records_per_subject(df: DataFrame, subject: str, top: int = 20) -> DataFrame:
    """Largest subjects by number of records."""
    counts = df.filter(col(subject).isNotNull()).groupBy(col(subject).alias("subject")).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), "subject").limit(top)


def subject_coverage(df: DataFrame, subject: str) -> DataFrame:
    """One row: rows with a subject id and distinct subjects."""
    counts = df.groupBy(col(subject).alias("subject")).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(
        F.coalesce(F.sum(F.when(F.col("subject").isNotNull(), F.col("n"))), F.lit(0)).alias("n_rows_with_subject"),
        F.count("subject").alias("n_subjects"),
    )
