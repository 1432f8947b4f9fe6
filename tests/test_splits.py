import pytest
from pyspark.sql import functions as F

from vitalsieve.operators import dedup, splits


def _labelled(spark, n, every=3):
    return spark.range(n).select(F.col("id").alias("row_id"), (F.col("id") % every == 0).cast("int").alias("label"))


def _map(df, column):
    return {r.row_id: r[column] for r in df.collect()}


@pytest.mark.parametrize("n,train", [(270, 216), (768, 614), (5110, 4088), (569, 455)])
def test_holdout_sizes(spark, n, train):
    got = _map(splits.stratified_holdout(_labelled(spark, n), ["row_id"], "label"), "split")
    assert len(got) == n and sum(v == "train" for v in got.values()) == train


def test_published_class_counts(spark):
    df = spark.range(768).select(F.col("id").alias("row_id"), (F.col("id") < 268).cast("int").alias("label"))
    rows = splits.stratified_holdout(df, ["row_id"], "label").groupBy("split", "label").count().collect()
    assert {(r.split, r.label): r["count"] for r in rows} == {("train", 0): 400, ("train", 1): 214, ("test", 0): 100, ("test", 1): 54}


def test_split_ignores_partitioning_and_follows_seed(spark):
    df = _labelled(spark, 500)
    one = _map(splits.stratified_holdout(df, ["row_id"], "label"), "split")
    assert one == _map(splits.stratified_holdout(df.repartition(7).orderBy(F.rand()), ["row_id"], "label"), "split")
    assert one != _map(splits.stratified_holdout(df, ["row_id"], "label", seed=7), "split")


def test_fold_sizes(spark):
    df = _labelled(spark, 203)
    rows = splits.stratified_folds(df, ["row_id"], "label").groupBy("fold").agg(F.count("*").alias("n"), F.sum("label").alias("p")).collect()
    assert sorted(r.fold for r in rows) == [0, 1, 2, 3, 4]
    assert {r.n for r in rows} <= {40, 41} and max(r.p for r in rows) - min(r.p for r in rows) <= 1


def test_class_smaller_than_folds(spark):
    df = spark.range(40).select(F.col("id").alias("row_id"), (F.col("id") < 2).cast("int").alias("label"))
    got = splits.stratified_folds(df, ["row_id"], "label")
    assert got.count() == 40 and got.filter("label = 1").select("fold").distinct().count() == 2


def test_replaying_a_fitted_split(spark):
    df = _labelled(spark, 300)
    fitted = splits.fit_holdout(df, ["row_id"], "label")
    assert _map(splits.apply_holdout(df, fitted), "split") == _map(splits.stratified_holdout(df, ["row_id"], "label"), "split")


def _grouped(spark):
    """A third of the rows in one group; the rest in small ones."""
    group = F.when(F.col("id") < 1000, F.lit("big")).otherwise(F.concat(F.lit("g"), (F.col("id") % 400).cast("string")))
    return spark.range(3000).select(F.col("id").alias("row_id"), group.alias("g"), (F.col("id") % 4 == 0).cast("int").alias("label"))


def test_groups_are_never_cut(spark):
    rows = splits.group_holdout(_grouped(spark), "g", "label")
    assert rows.count() == 3000
    splits.require_no_leakage(rows, "split", "g", "row_id")
    splits.require_both_classes(rows, "split", "label")
    assert dedup.groups_per_split(rows, "g").agg(F.sum("n_shared_groups")).first()[0] == 0


def test_group_folds_keep_all_rows(spark):
    df = _grouped(spark)
    rows = splits.with_group_folds(df, splits.group_folds(df, "g", "label"), "g")
    assert rows.count() == 3000 and rows.select("row_id").distinct().count() == 3000
    assert rows.groupBy("g").agg(F.count_distinct("fold").alias("k")).filter("k > 1").count() == 0


def test_leak_and_missing_class_are_errors(spark):
    leaky = spark.createDataFrame([(1, "a", "train", 0), (2, "a", "test", 1)], "row_id int, g string, split string, label int")
    with pytest.raises(splits.SplitError):
        splits.require_no_leakage(leaky, "split", "g")
    with pytest.raises(splits.SplitError):
        splits.require_both_classes(leaky, "split", "label")
    with pytest.raises(splits.SplitError):
        splits.require_clean_features(["age", "label"], "label", ["id"])


def test_replay_of_a_manifest(spark):
    df = _labelled(spark, 10)
    manifest = spark.createDataFrame([(1, "train"), (2, "test")], "row_id long, split string")
    assert [r.row_id for r in splits.replay_split(df, manifest, "row_id", "test").collect()] == [2]
    assert splits.outside_split(df, manifest, "row_id", "test").count() == 9
