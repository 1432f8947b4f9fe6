import json
import math

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from vitalsieve.contracts import LUNG, SURVEY_FLAGS, FieldRule, TableContract
from vitalsieve.operators import models
from vitalsieve.operators.features import TablePrep
from vitalsieve.operators.scoring import Scorer, respond, score_table
from vitalsieve.plans import train
from vitalsieve.plans.prepare import prepare
from vitalsieve.sources import artifacts
from vitalsieve.streaming.scoring import read_requests, score_stream

CONTRACT = TableContract(
    name="demo", target="y", target_codes={"no": 0, "yes": 1}, numeric=("a", "b"), categorical=("c",),
    rules=(FieldRule("a"), FieldRule("b"), FieldRule("c", codes={"u": 0, "v": 1}, style="flag")),
)


@pytest.fixture(scope="module")
def raw(spark):
    rng = np.random.RandomState(0)
    a, b = rng.normal(size=240), rng.normal(size=240)
    y = (a + 0.5 * b + rng.normal(scale=0.5, size=240) > 0.3).astype(int)
    rows = [(i, float(a[i]), None if i % 11 == 0 else float(b[i]), "uv"[i % 2], " YES" if y[i] else "no") for i in range(240)]
    return spark.createDataFrame(rows, "row_id long, a double, b double, c string, y string")


@pytest.fixture(scope="module")
def prepared(raw):
    return prepare(raw, CONTRACT, method="hash")


def test_prepare(prepared):
    assert prepared.train.count() == 192 and prepared.test.count() == 48
    assert prepared.prep.feature_names() == ["a", "b", "c_u", "c_v"]
    assert {r.split for r in prepared.report.collect()} == {"train", "test"}
    assert prepared.duplicates.first().n_conflicting_groups == 0


def test_prepare_with_duplicate_groups(spark):
    rows = [(i, *[int(i % 7 == j % 7) for j in range(13)], "YES" if i % 3 else "NO") for i in range(60)]
    kinds = "row_id long, " + ", ".join(f"{c} int" for c in SURVEY_FLAGS) + ", lung_cancer string"
    df = spark.createDataFrame(rows, kinds).withColumns({"gender": F.lit("MALE"), "age": (F.col("row_id") % 20).cast("double")})
    out = prepare(df, LUNG, group_duplicates=True, method="hash")
    shared = out.rows.groupBy("group_id").agg(F.count_distinct("split").alias("k")).filter("k > 1").count()
    assert shared == 0 and out.rows.count() == 60


def test_logistic_reaches_its_optimum(spark):
    """The gradient of the C-weighted objective vanishes, and the intercept is free."""
    rng = np.random.RandomState(4)
    x = rng.normal(size=(80, 2))
    y = (x[:, 0] - x[:, 1] + rng.normal(size=80) > 0).astype(int)
    df = spark.createDataFrame([(float(p), float(q), int(t)) for (p, q), t in zip(x, y)], "p double, q double, label int").coalesce(1)
    model = Pipeline(stages=[TablePrep([("p", "pass"), ("q", "pass")]), *models.logistic(C=0.5)]).fit(df)
    w, b = model.stages[-1].coefficients.toArray(), model.stages[-1].intercept
    err = 1 / (1 + np.exp(-(x @ w + b))) - y
    assert np.abs(w + 0.5 * x.T @ err).max() < 1e-3 and abs(err.sum()) < 1e-3


FAMILIES = {
    "logistic": models.Family("logistic", models.logistic, {"C": [0.1, 1.0]}, {"balanced": True}),
    "forest": models.Family("forest", models.forest, {"depth": [2, 4]}, {"trees": 5}),
}


def test_training_workflow(prepared):
    found = train.train_best(prepared.train, prepared.test, CONTRACT, FAMILIES, k=3, staged=1, method="hash")
    metrics = found.test_metrics.first()
    assert found.name in FAMILIES and metrics.tp + metrics.tn + metrics.fp + metrics.fn == 48 and metrics.roc_auc > 0.8
    row = found.comparison.first()
    assert json.loads(row.best_parameters) == found.params and 0 <= row.roc_auc_std <= 1


def test_other_families_score_in_range(prepared):
    stages = {
        "svm": lambda: models.support_vector(kernel="linear", calibrated=False, iterations=10),
        "boosted": lambda: models.boosted(trees=3),
        "plain_trees": lambda: models.forest_no_bootstrap(trees=3, depth=3),
    }
    train_rows, test_rows = (prepared.prep.transform(d.coalesce(1)) for d in (prepared.train, prepared.test))
    rows = {r.model: r for r in train.evaluate_candidates(train_rows, test_rows, stages).collect()}
    assert set(rows) == set(stages) and all(r.roc_auc > 0.7 for r in rows.values())


def test_calibrated_kernel_machine_and_reload(prepared, tmp_path):
    rows = prepared.prep.transform(prepared.train.coalesce(1))
    model = Pipeline(stages=models.support_vector(C=1.0, kernel="rbf", size=32, iterations=10)).fit(rows)
    scored = models.scored(model, rows, ["label"]).collect()
    assert all(0 < r.score < 1 and r.prediction == int(r.score > 0.5) for r in scored)
    artifacts.save_model(model, str(tmp_path / "svm"))
    again = models.scored(artifacts.load_model(str(tmp_path / "svm")), rows, ["label"]).collect()
    assert [r.score for r in again] == pytest.approx([r.score for r in scored])


def test_kernel_features_approximate_the_kernel(spark):
    df = spark.createDataFrame([(0.0, 0.0), (0.5, -0.5), (1.0, 2.0)], "p double, q double").coalesce(1)
    ready = TablePrep([("p", "pass"), ("q", "pass")]).fit(df).transform(df)
    out = models.FourierFeatures(gamma=0.3, size=4000).fit(ready).transform(ready)
    z = np.array([r[0] for r in out.select(vector_to_array("kernel_features")).collect()])
    x = np.array([(0, 0), (0.5, -0.5), (1, 2)])
    exact = np.exp(-0.3 * ((x[:, None] - x[None]) ** 2).sum(-1))
    assert np.abs(z @ z.T - exact).max() < 0.08


def test_evaluator_in_sparks_cross_validator(prepared):
    rows = train.with_folds(prepared.prep.transform(prepared.train), "row_id", 2).coalesce(1).persist()
    estimator = models.InverseLogistic()
    grid = ParamGridBuilder().addGrid(estimator.C, [0.001, 1.0]).build()
    search = CrossValidator(estimator=estimator, estimatorParamMaps=grid, evaluator=models.MetricEvaluator("avg_precision"), foldCol="fold", numFolds=2)
    assert all(0.5 < m <= 1.0 for m in search.fit(rows).avgMetrics)


def test_release_model_scores_and_answers(spark, raw, prepared, tmp_path):
    model = train.fit_release(prepared.rows, CONTRACT, FAMILIES["logistic"], {"C": 1.0}, "hash")
    rows = score_table(prepared.rows, model, ["row_id"]).collect()
    assert len(rows) == 240 and {r.risk_category for r in rows} <= {"low", "moderate", "high"}
    # a pipeline takes the validated numbers of the request, so train it on the coded column
    coded = prepared.rows.withColumn("c", F.when(F.col("c") == "v", 1.0).otherwise(0.0))
    numeric = Pipeline(stages=[TablePrep([("a", "scale"), ("b", "scale"), ("c", "pass")], method="hash"), *models.logistic()]).fit(coded)
    artifacts.save_model(numeric, str(tmp_path / "demo"))
    folder = tmp_path / "in"
    folder.mkdir()
    lines = [json.dumps({"disease": "demo", "data": {"a": i / 3 - 1, "b": 0.1 * i, "c": "uv"[i % 2]}}) for i in range(6)]
    lines += ["{bad", json.dumps({"disease": "demo", "data": {"a": 1, "b": None, "c": "u"}}), json.dumps({"disease": "flu", "data": {"a": 1}})]
    for n, line in enumerate(lines):
        (folder / f"{n}.txt").write_text(line + "\n")

    scorer = {"demo": Scorer(CONTRACT, model=artifacts.load_model(str(tmp_path / "demo")))}
    batch = respond(spark.createDataFrame([(x,) for x in lines], "body string"), "body", scorer)
    expected = sorted(map(str, batch.collect()))
    assert batch.filter("status = 'success'").count() == 6
    for files in (1, 100):
        home = str(tmp_path / f"run{files}")
        run = score_stream(read_requests(spark, str(folder), files), "body", scorer, f"{home}/ok", f"{home}/bad", f"{home}/state")
        run.awaitTermination()
        ok, bad = (spark.read.parquet(f"{home}/{part}").drop("batch") for part in ("ok", "bad"))
        assert ok.count() == 6 and bad.count() == 3
        assert sorted(map(str, ok.unionByName(bad).collect())) == expected


def test_registry_of_a_saved_model(spark, prepared, tmp_path):
    model = train.fit_release(prepared.rows, CONTRACT, FAMILIES["logistic"], method="hash")
    artifacts.save_model(model, str(tmp_path / "m"))
    entry = {"disease": "demo", "model": "m", "threshold": 0.5, "features": ["a"], "labels": CONTRACT.labels, "path": str(tmp_path / "m")}
    assert artifacts.readiness(artifacts.registry(spark, [entry])).first().status == "ready"
    assert isinstance(artifacts.load_model(str(tmp_path / "m")), PipelineModel)


def test_grids_have_the_documented_sizes():
    sizes = {n: len(f.settings()) for n, f in models.lung_families().items()}
    assert sizes == {"Logistic Regression": 5, "Support Vector Machine": 12, "Random Forest": 18, "Extra Trees": 18, "HistGradientBoosting": 36}
    assert len(models.breast_families()["Support Vector Machine"].settings()) == 13
    assert "XGBoost" in models.general_families(boosted_preset=True) and "XGBoost" not in models.general_families()
    assert math.prod([len(models.staged_families())]) == 4


def test_workflow_writes_every_artifact(spark, raw, tmp_path):
    from vitalsieve.plans.workflow import run_table

    run = run_table(raw, CONTRACT, {"forest": FAMILIES["forest"]}, str(tmp_path / "out"), k=2, method="hash")
    for part in ("model", "split", "split_report", "statistics", "comparison", "profile", "evaluation", "schema", "runs"):
        assert (tmp_path / "out" / part).exists(), part
    record = spark.read.parquet(str(tmp_path / "out" / "runs")).first()
    assert record.model == run.trained.name and record.counts["test_rows"] == 48
    assert spark.read.parquet(str(tmp_path / "out" / "split")).count() == 240
