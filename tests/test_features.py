import math

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from vitalsieve.contracts import DIABETES, HEART, LUNG, STROKE
from vitalsieve.operators import features
from vitalsieve.operators.features import BalancedWeights, TablePrep


def _train(spark):
    rows = [(1.0, 5.0, "b", 10), (2.0, 5.0, "a", 2), (3.0, 5.0, "a", 2), (4.0, 5.0, "b", 10), (None, 5.0, None, 3)]
    return spark.createDataFrame(rows, "x double, k double, c string, code int")


PLAN = [("x", "scale"), ("k", "scale"), ("c", "levels"), ("code", "levels")]


def test_median_scale_and_levels(spark):
    model = TablePrep(PLAN).fit(_train(spark))
    x, k, c, code = model.fitted()
    assert x["median"] == 2.5 and x["mean"] == pytest.approx(2.5)
    assert x["scale"] == pytest.approx(math.sqrt((1.5**2 + 0.5**2) * 2 / 5))
    assert k["scale"] == 1.0
    assert c["levels"] == ["a", "b"] and c["mode"] == "a"
    assert code["levels"] == ["2", "3", "10"] and code["mode"] == "2"
    assert model.feature_names() == ["x", "k", "c_a", "c_b", "code_2", "code_3", "code_10"]


def test_unseen_levels_give_zeros_and_gaps_are_filled(spark):
    model = TablePrep(PLAN).fit(_train(spark))
    new = spark.createDataFrame([(None, None, None, 99)], "x double, k double, c string, code int")
    row = model.transform(new).select(vector_to_array("features").alias("f")).first().f
    assert row == [0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 0.0]


def test_empty_column_is_left_out(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None)], "x double, y double")
    with pytest.warns(UserWarning, match="no values"):
        model = TablePrep([("x", "scale"), ("y", "scale")]).fit(df)
    assert model.feature_names() == ["x"]


def test_fit_uses_training_rows_only(spark):
    df = spark.createDataFrame([(float(i), "train" if i < 50 else "test") for i in range(100)], "x double, split string")
    model = TablePrep([("x", "scale")]).fit(df.filter("split = 'train'"))
    assert model.fitted()[0]["mean"] == pytest.approx(24.5)
    assert {r.stat for r in model.statistics(spark).collect()} == {"median", "mean", "scale"}


def test_reload_gives_equal_output(spark, tmp_path):
    df = _train(spark).withColumn("label", (F.col("code") > 2).cast("int"))
    model = Pipeline(stages=[TablePrep(PLAN), BalancedWeights()]).fit(df)
    model.write().overwrite().save(str(tmp_path / "prep"))
    again = PipelineModel.load(str(tmp_path / "prep"))
    assert again.transform(df).collect() == model.transform(df).collect()
    assert "weight" not in again.transform(df.drop("label")).columns


def test_class_weights(spark):
    df = spark.createDataFrame([(0,)] * 6 + [(1,)] * 2, "label int")
    assert {r.label: r.weight for r in features.class_weights(df, "label").collect()} == {0: 8 / 12, 1: 2.0}
    assert features.with_class_weights(df, "label").agg(F.sum("weight")).first()[0] == pytest.approx(8.0)


def test_contract_plans():
    import json

    def plan(contract):
        return json.loads(TablePrep.for_contract(contract).getOrDefault("plan"))

    assert [how for _, how in plan(LUNG)].count("scale") == 1 and len(plan(LUNG)) == 15
    assert [how for _, how in plan(HEART)].count("levels") == 8
    assert all(how == "scale" for _, how in plan(DIABETES)) and len(plan(STROKE)) == 10


def test_methods_agree(spark):
    df = spark.createDataFrame([(float(i % 17), None if i % 5 == 0 else i * 0.5) for i in range(200)], "a double, b double")
    one = {r.feature: r for r in features.numeric_statistics(df, ["a", "b"]).collect()}
    two = {r.feature: r for r in features.numeric_statistics(df, ["a", "b"], "hash").collect()}
    for name in ("a", "b"):
        assert one[name].median == two[name].median and one[name].scale == pytest.approx(two[name].scale)


def test_many_levels_have_the_slots_of_few(spark, monkeypatch, tmp_path):
    rows = [(float(i % 5), f"level{i % 37}" if i % 3 else "common", i % 23 if i % 7 else None, "x" if i % 2 else None) for i in range(400)]
    df = spark.createDataFrame(rows, "x double, c string, n int, few string")
    new = spark.createDataFrame([(1.0, "unseen", 99, "x"), (None, None, None, None), (2.0, "level5", 22, "y"), (3.0, "", 0, "")], df.schema)
    plan = [("few", "levels"), ("c", "levels"), ("x", "scale"), ("n", "levels")]
    few = TablePrep(plan).fit(df)
    monkeypatch.setattr(features, "MAX_LEVELS", 12)
    many = TablePrep(plan, dictionaries=str(tmp_path)).fit(df)
    assert [s["how"] for s in many.fitted()] == ["levels", "dictionary", "scale", "dictionary"]
    assert len(many.feature_names()) == len(few.feature_names())
    many.write().overwrite().save(str(tmp_path / "prep"))
    again = features.TablePrepModel.load(str(tmp_path / "prep"))
    for rows in (df, new):
        want, got, loaded = (sorted(tuple(r.f) for r in m.transform(rows).select(vector_to_array("features").alias("f")).collect()) for m in (few, many, again))
        assert want == got == loaded
    assert many.transform(new).columns == [*new.columns, "features"]


def test_dictionary_of_nothing(spark, monkeypatch):
    monkeypatch.setattr(features, "MAX_LEVELS", 1)
    df = spark.createDataFrame([(1.0, None), (2.0, None)], "x double, c string")
    assert len(TablePrep([("x", "scale"), ("c", "levels")]).fit(df).feature_names()) == 1
