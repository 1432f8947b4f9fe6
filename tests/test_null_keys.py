"""NULL keys, colliding values and constant columns: nothing is lost and nothing collides."""

import pytest

from vitalsieve.functions.ordering import keyed_hash
from vitalsieve.operators import associations, distributions, metrics, splits
from vitalsieve.operators.features import MAX_LEVELS, BalancedWeights
from vitalsieve.sources import tables


@pytest.fixture(scope="module")
def rows(spark):
    data = [("a", 1.0, 1, 0.9, 1), ("a", 2.0, 0, 0.2, 2), (None, 3.0, 1, 0.8, 1), (None, 4.0, 0, 0.7, 3)]
    return spark.createDataFrame(data, "part string, v double, label int, score double, g int")


def test_null_class_keeps_its_histogram(rows):
    got = distributions.histogram(rows, "v", bins=2, by="part").collect()
    assert sum(r["n"] for r in got if r["part"] is None) == 2 and sum(r["n"] for r in got) == 4


def test_null_split_is_reported(rows):
    assert {r["split"] for r in associations.class_distribution(rows, "part", "label").collect()} == {"a", None}
    got = {r["part"]: r["n_groups"] for r in splits.split_report(rows, "part", "label", "g").collect()}
    assert got == {"a": 2, None: 2}


def test_null_model_has_ranking_metrics(rows):
    got = metrics.all_metrics(rows, "label", "label", "score", ["part"]).collect()
    assert {r["part"]: r["roc_auc"] for r in got} == {"a": 1.0, None: 1.0}


def test_constant_column_has_no_density(spark):
    df = spark.createDataFrame([(2.0,)] * 5, "v double")
    for bins in (None, 10):
        assert {r["density"] for r in distributions.kernel_density(df, "v", points=3, bins=bins).collect()} == {None}


def test_keys_and_fingerprints_do_not_collide(spark):
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), (None, "c"), ("c", None), ("-", "c")], "x string, y string")
    assert df.select(keyed_hash(1, df.x, df.y).alias("h")).distinct().count() == 5
    prints = {tuple(tables.fingerprint(df.filter(f"coalesce(x, 'none') = '{x}'")).first()) for x in ("a|b", "a", "none", "c", "-")}
    assert len(prints) == 5


def test_too_many_labels_are_refused(spark):
    df = spark.range(MAX_LEVELS + 5).selectExpr("CAST(id AS double) AS label")
    with pytest.raises(ValueError, match="labels"):
        BalancedWeights().fit(df)
