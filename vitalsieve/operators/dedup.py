"""Duplicate rows, duplicate feature vectors and conflicting labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from vitalsieve.functions.columns import col, quoted, row_hash


def drop_duplicate_rows(df: DataFrame, content: Sequence[str], row_id: str | None = None) -> DataFrame:
    """Keep one row of each set of equal rows, the one with the smallest ``row_id`` if there is one.

    Rows without an id come after those with one; of rows that share the smallest id one stays. The rows themselves are combined before
    the shuffle, so a row repeated in a third of the table is one record per task, and no row is shuffled twice.
    """
    if row_id is None or row_id in content:
        return df.dropDuplicates(list(content))
    rest = [c for c in df.columns if c != row_id]
    place = F.struct(col(row_id).isNull(), col(row_id), row_hash(df, rest))
    kept = df.groupBy(row_hash(df, content).alias("_h")).agg(F.min_by(F.struct(*map(quoted, df.columns)), place).alias("_row"))
    return kept.select("_row.*")


def duplicate_count(df: DataFrame, content: Sequence[str]) -> DataFrame:
    """One row: rows, distinct rows, duplicate rows."""
    groups = df.groupBy(row_hash(df, content).alias("_h")).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(
        F.sum("n").alias("n_rows"),
        F.count(F.lit(1)).alias("n_distinct"),
        (F.sum("n") - F.count(F.lit(1))).alias("n_duplicates"),
    )


def with_group_id(df: DataFrame, content: Sequence[str], out: str = "group_id") -> DataFrame:
    """Id shared by rows with equal values in ``content``; NULL equals NULL. Needs no shuffle."""
    return df.withColumn(out, row_hash(df, content))


def duplicate_groups(df: DataFrame, content: Sequence[str], row_id: str, label: str | None = None) -> DataFrame:
    """One row per feature vector: first row id, size, how many labels it carries, distinct (vector, label) rows.

    Counted per (vector, label) first, so one vector in a third of the rows stays small.
    """
    keyed = with_group_id(df, content, "_g")
    keys = ["_g"] if label is None else ["_g", quoted(label)]
    part = keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min(col(row_id)).alias("first"))
    labels = F.count(F.lit(1)) if label is None else F.count(col(label))
    return part.groupBy("_g").agg(
        F.min("first").alias("first_row"), F.sum("n").alias("n_rows"), labels.alias("n_labels"), F.count(F.lit(1)).alias("n_distinct")
    ).withColumnRenamed("_g", "group_id")


def conflicting_groups(df: DataFrame, content: Sequence[str], row_id: str, label: str) -> DataFrame:
    """Feature vectors that carry more than one label."""
    return duplicate_groups(df, content, row_id, label).filter(F.col("n_labels") > 1)


def duplicate_summary(df: DataFrame, content: Sequence[str], row_id: str, label: str) -> DataFrame:
    """One row: groups, repeated groups, repeats of a vector, repeats of a vector with its label, conflicting groups."""
    return duplicate_groups(df, content, row_id, label).agg(
        F.count(F.lit(1)).alias("n_groups"),
        F.count_if(F.col("n_rows") > 1).alias("n_repeated_groups"),
        F.sum(F.col("n_rows") - 1).alias("n_duplicate_vectors"),
        F.sum(F.col("n_rows") - F.col("n_distinct")).alias("n_duplicate_rows"),
        F.count_if(F.col("n_labels") > 1).alias("n_conflicting_groups"),
    )


def groups_per_split(df: DataFrame, group: str, split: str = "split") -> DataFrame:
    """Group counts of each split and how many groups also occur in another split."""
    pairs = df.groupBy(quoted(group), quoted(split)).agg(F.count(F.lit(1)).alias("n"))
    spread = pairs.groupBy(quoted(group)).agg(
        F.collect_list(F.struct(col(split).alias("split"), F.col("n"))).alias("parts"), F.count(F.lit(1)).alias("n_splits")
    )
    return (
        spread.select("n_splits", F.inline("parts"))
        .groupBy("split")
        .agg(
            F.sum("n").alias("n_rows"),
            F.count(F.lit(1)).alias("n_groups"),
            F.count_if(F.col("n_splits") > 1).alias("n_shared_groups"),
        )
    )


def shared_groups(df: DataFrame, group: str, split: str = "split") -> DataFrame:
    """Groups that occur in more than one split. Empty when the split does not leak."""
    return (
        df.groupBy(quoted(group))
        .agg(F.min(col(split)).alias("a"), F.max(col(split)).alias("b"))
        .filter(F.col("a") != F.col("b"))
        .select(quoted(group))
    )
