"""Reproducible splits and folds that do not depend on partitioning.

Rows are ordered by a seeded hash of their key. A split is then a set of hash cut points per class: applying it compares
two texts, needs no shuffle, and the cut points are all that has to be stored to replay it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from vitalsieve.functions.columns import col, quoted
from vitalsieve.functions.ordering import keyed_hash
from vitalsieve.operators.dedup import shared_groups, with_group_id
from vitalsieve.session import checkpointed, small_side

_PREFIX = 4  # hex digits: 65,536 slices of each class


class SplitError(ValueError):
    """A split leaks or lacks a class."""


@dataclass(frozen=True)
class HashSplit:
    """Cut points per class. ``cuts`` has rows (stratum, part, cut): part i holds the hashes above cut i-1, up to cut i."""

    key: tuple[str, ...]
    label: str
    seed: int
    cuts: DataFrame

    def parts(self, df: DataFrame, out: str) -> DataFrame:
        """Add the part number of every row: a map over the table with a broadcast of the cut points."""
        packed = self.cuts.groupBy("stratum").agg(F.array_sort(F.collect_list("cut")).alias("_cuts"))
        code = keyed_hash(self.seed, *[col(k) for k in self.key])
        hashed = df.withColumn("_h", code)
        part = F.size(F.filter("_cuts", lambda c: F.col("_h") > c))
        return (
            hashed.join(small_side(packed), col(self.label).eqNullSafe(F.col("stratum")), "left")
            .withColumn(out, part)
            .drop("_h", "_cuts", "stratum")
        )


def _cut_points(df: DataFrame, key: Sequence[str], strata: Column, seed: int, targets) -> DataFrame:
    """Hash of the k-th row of each class for every k in ``targets``: count slices, then rank inside one slice only."""
    rows = df.select(strata.alias("stratum"), keyed_hash(seed, *[col(k) for k in key]).alias("h"))
    rows = rows.withColumn("slice", F.substring("h", 1, _PREFIX))
    counts = rows.groupBy("stratum", "slice").agg(F.count(F.lit(1)).alias("cnt"))
    wanted = targets(counts.groupBy("stratum").agg(F.sum("cnt").alias("n")))  # stratum, part, k
    running = W.partitionBy("stratum").orderBy("slice").rowsBetween(W.unboundedPreceding, 0)
    spans = counts.withColumn("upto", F.sum("cnt").over(running)).withColumn("before", F.col("upto") - F.col("cnt"))
    inside = (F.col("k") > F.col("before")) & (F.col("k") <= F.col("upto"))
    nothing = (F.col("k") <= 0) & (F.col("before") == 0)
    hit = small_side(
        spans.join(wanted.withColumnRenamed("stratum", "s"), F.col("stratum").eqNullSafe(F.col("s")))
        .filter(inside | nothing)
        .select("s", F.col("slice").alias("sl"), "part", (F.col("k") - F.col("before")).alias("k"))
    )
    edge = rows.join(hit, F.col("stratum").eqNullSafe(F.col("s")) & (F.col("slice") == F.col("sl")) & (F.col("k") > 0))
    copies = edge.groupBy("stratum", "part", "k", "h").agg(F.count(F.lit(1)).alias("cnt"))
    upto = F.sum("cnt").over(W.partitionBy("stratum", "part").orderBy("h").rowsBetween(W.unboundedPreceding, 0))
    reached = copies.withColumn("upto", upto).filter((F.col("upto") >= F.col("k")) & (F.col("upto") - F.col("cnt") < F.col("k")))
    found = reached.select("stratum", "part", F.col("h").alias("cut"))
    empty = hit.filter("k <= 0").select(F.col("s").alias("stratum"), "part", F.lit("").alias("cut"))
    return found.unionByName(empty)


def stratified_holdout(
    df: DataFrame, key: Sequence[str], label: str, test_size: float = 0.2, seed: int = 42, out: str = "split"
) -> DataFrame:
    """Add ``split`` = train/test. Train has n - ceil(n * test_size) rows; classes share it by largest remainder."""
    return apply_holdout(df, fit_holdout(df, key, label, test_size, seed), out)


def fit_holdout(df: DataFrame, key: Sequence[str], label: str, test_size: float = 0.2, seed: int = 42) -> HashSplit:
    def targets(sizes: DataFrame) -> DataFrame:
        whole = W.partitionBy(F.lit(1))  # one row per class
        n = F.sum("n").over(whole)
        train = n - F.ceil(n * F.lit(float(test_size)))
        share = F.col("n") * train / n
        order = F.row_number().over(whole.orderBy(F.desc(F.round(share - F.floor(share), 9)), "stratum"))
        spare = train - F.sum(F.floor(share)).over(whole)
        extra = (order <= spare).cast("long")
        return sizes.select("stratum", F.lit(0).alias("part"), (F.floor(share) + extra).alias("k"))

    return HashSplit(tuple(key), label, seed, _cut_points(df, key, col(label), seed, targets))


def apply_holdout(df: DataFrame, split: HashSplit, out: str = "split") -> DataFrame:
    return split.parts(df, "_part").withColumn(out, F.when(F.col("_part") == 0, "train").otherwise("test")).drop("_part")


def stratified_folds(df: DataFrame, key: Sequence[str], label: str, k: int = 5, seed: int = 42, out: str = "fold") -> DataFrame:
    """Add ``fold`` 0..k-1. Fold sizes are those of dealing the class-sorted rows one by one to k hands."""
    return fit_folds(df, key, label, k, seed).parts(df, out)


def fit_folds(df: DataFrame, key: Sequence[str], label: str, k: int = 5, seed: int = 42) -> HashSplit:
    def targets(sizes: DataFrame) -> DataFrame:
        end = F.sum("n").over(W.partitionBy(F.lit(1)).orderBy("stratum").rowsBetween(W.unboundedPreceding, 0))
        spans = sizes.withColumn("end", end).withColumn("start", F.col("end") - F.col("n"))
        upto = [_dealt(F.col("end"), i, k) - _dealt(F.col("start"), i, k) for i in range(k)]
        cuts = F.array(*[F.struct(F.lit(i).alias("part"), sum(upto[1:i + 1], upto[0]).alias("k")) for i in range(k - 1)])
        return spans.select("stratum", F.inline(cuts))

    return HashSplit(tuple(key), label, seed, _cut_points(df, key, col(label), seed, targets))


def _dealt(count: Column, hand: int, k: int) -> Column:
    """Cards hand ``hand`` holds after ``count`` cards were dealt to k hands."""
    return F.floor((count + F.lit(k - 1 - hand)) / F.lit(k))


def group_folds(
    df: DataFrame, group: str, label: str, positive: object = 1, k: int = 5, seed: int = 42
) -> DataFrame:
    """(group, n, n_positive, fold): one row per group. Groups of like class and size are spread evenly over the folds.

    Strata are (majority class, power of two of the size). Each is cut into k runs of hash order whose sizes continue
    the dealing where the previous stratum ended.
    """
    y = (col(label) == F.lit(positive)).cast("long")
    groups = df.groupBy(col(group).alias("group")).agg(F.count(F.lit(1)).alias("n"), F.sum(y).alias("n_positive"))
    major = (F.col("n_positive") * 2 >= F.col("n")).cast("int")
    stratum = F.format_string("%d-%03d", major, 999 - F.floor(F.log2(F.col("n"))).cast("int"))
    groups = checkpointed(groups.withColumn("size_class", stratum))
    return fit_folds(groups, ["group"], "size_class", k, seed).parts(groups, "fold").drop("size_class")


def with_group_folds(df: DataFrame, folds: DataFrame, group: str, out: str = "fold") -> DataFrame:
    """Give every row the fold of its group.

    Groups above a thousandth of all rows number at most a thousand: they are broadcast. The others are joined by
    shuffle, where no key can hold more than a thousandth of the rows.
    """
    parts = folds.select(F.col("group").alias("_g"), F.col("n").alias("_n"), F.col("fold").alias(out))
    total = parts.agg(F.sum("_n")).scalar()
    heavy = F.broadcast(parts.filter(F.col("_n") > total / 1000).drop("_n"))
    light = parts.filter(F.col("_n") <= total / 1000).drop("_n")
    same = col(group).eqNullSafe(F.col("_g"))
    hot = df.join(heavy, same).drop("_g")
    rest = df.join(heavy, same, "left_anti").join(light, same).drop("_g")
    return hot.unionByName(rest)


def group_holdout(
    df: DataFrame, group: str, label: str, positive: object = 1, test_size: float = 0.2, seed: int = 42, out: str = "split"
) -> DataFrame:
    """Train/test split that never cuts a group: fold 0 of round(1/test_size) group folds is the test part."""
    k = round(1 / test_size) if test_size > 0 else 5
    folds = group_folds(df, group, label, positive, k, seed)
    rows = with_group_folds(df, folds, group, "_fold")
    return rows.withColumn(out, F.when(F.col("_fold") == 0, "test").otherwise("train")).drop("_fold")


def replay_split(df: DataFrame, manifest: DataFrame, row_id: str, split: str) -> DataFrame:
    """Rows of one part of a stored split (row_id, split)."""
    wanted = manifest.filter(F.col("split") == split).select(col(row_id))
    return df.join(wanted, row_id, "left_semi")


def outside_split(df: DataFrame, manifest: DataFrame, row_id: str, split: str) -> DataFrame:
    """Rows that are not in the given part."""
    return df.join(manifest.filter(F.col("split") == split).select(col(row_id)), row_id, "left_anti")


def require_both_classes(df: DataFrame, split: str, label: str) -> None:
    thin = df.groupBy(quoted(split)).agg(F.min(col(label)).alias("a"), F.max(col(label)).alias("b")).filter("a = b").collect()
    for row in thin:
        raise SplitError(f"{row[0]} partition missing classes. Found only: {row['a']}")


def require_no_leakage(df: DataFrame, split: str, group: str | None = None, row_id: str | None = None) -> None:
    """Fail if a group or a row id occurs in more than one part."""
    for key, what in ((group, "groups"), (row_id, "rows")):
        if key and (found := shared_groups(df, key, split).limit(1).count()):
            raise SplitError(f"Split leakage: {what} of '{key}' occur in more than one part ({found}+).")


def require_clean_features(features: Sequence[str], target: str, identifiers: Sequence[str]) -> None:
    bad = [f for f in features if f == target or f in identifiers]
    if bad:
        raise SplitError(f"Target or identifier among the features: {bad}")


def conflict_allocation(df: DataFrame, content: Sequence[str], label: str, split: str) -> DataFrame:
    """(allocation, n_vectors): in which part the feature vectors with several labels lie; ``both`` if cut."""
    parts = with_group_id(df, content, "_g").groupBy("_g").agg(
        F.min(col(label)).alias("a"), F.max(col(label)).alias("b"), F.min(col(split)).alias("s"), F.max(col(split)).alias("t")
    )
    where = F.when(F.col("s") == F.col("t"), F.col("s")).otherwise(F.lit("both"))
    return parts.filter("a <> b").groupBy(where.alias("allocation")).agg(F.count(F.lit(1)).alias("n_vectors"))


def split_report(df: DataFrame, split: str, label: str, group: str | None = None) -> DataFrame:
    """(split, n, n_positive, positive_pct, n_groups) per part."""
    base = df.groupBy(quoted(split)).agg(
        F.count(F.lit(1)).alias("n"), F.sum((col(label) == 1).cast("long")).alias("n_positive")
    )
    if group:
        pairs = df.select(col(split).alias("_of"), quoted(group)).distinct().groupBy("_of").agg(F.count(F.lit(1)).alias("n_groups"))
        base = base.join(pairs, col(split).eqNullSafe(F.col("_of"))).drop("_of")
    return base.withColumn("positive_pct", F.round(F.try_divide(F.col("n_positive") * 100.0, F.col("n")), 2))
