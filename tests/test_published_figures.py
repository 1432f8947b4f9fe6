"""Published figures of four public screening tables.

The tables are not part of this repository. Set VITALSIEVE_TABLES to a folder of their CSV files (found by header), and
VITALSIEVE_MANIFEST to the frozen lung split, to run these tests.
"""

import os
from pathlib import Path

import pytest
from pyspark.ml import Pipeline
from pyspark.sql import Window as W, functions as F

from vitalsieve.contracts import DIABETES, HEART, LIVER, LUNG
from vitalsieve.functions.columns import strip_headers
from vitalsieve.operators import associations, cleaning, dedup, distributions, models, profile, splits
from vitalsieve.operators.features import TablePrep
from vitalsieve.operators.metrics import all_metrics
from vitalsieve.plans import train
from vitalsieve.sources import documents, tables

FOLDER = os.environ.get("VITALSIEVE_TABLES")
MANIFEST = os.environ.get("VITALSIEVE_MANIFEST")
pytestmark = pytest.mark.skipif(not FOLDER, reason="VITALSIEVE_TABLES is not set")


def _load(spark, column):
    """Rows in file order: single small files, read by one task."""
    for path in sorted(Path(FOLDER).glob("*.csv")):
        if column in [c.strip() for c in path.open().readline().strip().split(",")]:
            rows = strip_headers(tables.read_table(spark, str(path), "csv").coalesce(1))
            return rows.withColumn("_at", F.monotonically_increasing_id()).withColumn(
                "row_id", (F.row_number().over(W.orderBy("_at")) - 1).cast("long")
            ).drop("_at")
    pytest.skip(f"no table with a column {column}")


def test_diabetes(spark):
    raw = _load(spark, "Outcome")
    rows = cleaning.clean(raw, DIABETES).persist()
    assert {r.label: r["count"] for r in rows.groupBy("label").count().collect()} == {0: 500, 1: 268}
    zeros = {r.feature: r.converted for r in cleaning.zero_conversions(raw, DIABETES.zero_means_missing).collect()}
    assert [zeros[c] for c in DIABETES.zero_means_missing] == [5, 35, 227, 374, 11]
    outliers = {r.feature: r.outliers for r in distributions.iqr_outliers(rows, DIABETES.numeric).collect()}
    assert [outliers[c] for c in DIABETES.numeric] == [4, 0, 14, 3, 24, 8, 29, 9]
    corr = {r.feature: round(r["corr"], 3) for r in associations.correlation_with_target(rows, DIABETES.numeric, "label").collect()}
    assert corr == {
        "Glucose": 0.495, "BMI": 0.314, "Insulin": 0.303, "SkinThickness": 0.259, "Age": 0.238, "Pregnancies": 0.222,
        "DiabetesPedigreeFunction": 0.174, "BloodPressure": 0.171,
    }
    held = splits.stratified_holdout(rows, ["row_id"], "label").groupBy("split", "label").count().collect()
    assert {(r.split, r.label): r["count"] for r in held} == {("train", 0): 400, ("train", 1): 214, ("test", 0): 100, ("test", 1): 54}


def test_heart(spark):
    rows = cleaning.clean(_load(spark, "Heart Disease"), HEART).persist()
    corr = {r.feature: round(r["corr"], 3) for r in associations.correlation_with_target(rows, HEART.features, "label").collect()}
    assert [corr[c] for c in (
        "Thallium", "Number of vessels fluro", "Exercise angina", "Max HR", "ST depression", "Chest pain type", "Slope of ST", "Sex",
        "Age", "EKG results", "BP", "Cholesterol", "FBS over 120",
    )] == [0.525, 0.455, 0.419, -0.419, 0.418, 0.417, 0.338, 0.298, 0.212, 0.182, 0.155, 0.118, -0.016]
    outliers = {r.feature: r.outliers for r in distributions.iqr_outliers(rows, HEART.numeric).collect()}
    assert [outliers[c] for c in HEART.numeric] == [0, 9, 5, 1, 4]
    age = profile.column_profile(rows, ["Age"]).first()
    assert (age.n_distinct, round(age["mean"], 4), age["median"], round(age["std"], 4)) == (41, 54.4333, 55.0, 9.1091)
    assert len(TablePrep.for_contract(HEART, "hash").fit(rows).feature_names()) == 28
    held = splits.stratified_holdout(rows, ["row_id"], "label")
    assert {(r.split, r.label): r["count"] for r in held.groupBy("split", "label").count().collect()} == {
        ("train", 0): 120, ("train", 1): 96, ("test", 0): 30, ("test", 1): 24}
    folded = train.with_folds(held.filter("split = 'train'"), "row_id")
    found = train.compare_models(folded, {"lr": models.Family("lr", models.logistic, fixed={"C": 0.1})}, lambda: TablePrep.for_contract(HEART, "hash")).first()
    assert found.roc_auc_mean == pytest.approx(0.9119, abs=0.04)


def test_liver(spark):
    raw = _load(spark, "Albumin_and_Globulin_Ratio")
    content = [c for c in raw.columns if c != "row_id"]
    assert dedup.duplicate_count(raw, content).first().n_duplicates == 13
    assert profile.missing_values(raw.select(*content), only_present=True).first().missing == 4
    rows = cleaning.clean(raw, LIVER)
    assert rows.count() == 570
    assert profile.value_counts(raw, "Dataset").orderBy("value").collect()[0].n == 416


def test_lung(spark):
    rows = cleaning.clean(_load(spark, "YELLOW_FINGERS"), LUNG).persist()
    summary = dedup.duplicate_summary(rows, LUNG.features, "row_id", "label").first()
    assert (summary.n_groups, summary.n_duplicate_vectors, summary.n_duplicate_rows, summary.n_conflicting_groups) == (275, 34, 33, 1)
    keyed = dedup.with_group_id(rows, LUNG.features)
    held = splits.group_holdout(keyed, "group_id", "label").persist()
    splits.require_no_leakage(held, "split", "group_id", "row_id")
    splits.require_both_classes(held, "split", "label")
    assert 52 <= held.filter("split = 'test'").count() <= 72


@pytest.mark.skipif(not MANIFEST, reason="VITALSIEVE_MANIFEST is not set")
def test_lung_on_its_frozen_split(spark):
    rows = cleaning.clean(_load(spark, "YELLOW_FINGERS"), LUNG).persist()
    manifest = documents.read_manifest(spark, MANIFEST)
    train_rows, test_rows = (splits.replay_split(rows, manifest, "row_id", part) for part in ("train", "test"))
    assert (train_rows.count(), test_rows.count()) == (247, 62)
    prep = TablePrep.for_contract(LUNG).fit(train_rows)
    age = next(s for s in prep.fitted() if s["column"] == "age")
    assert age["mean"] == pytest.approx(62.85425101214575) and age["scale"] == pytest.approx(8.336241795499054)
    model = Pipeline(stages=[TablePrep.for_contract(LUNG), *models.logistic(C=0.1, balanced=True)]).fit(train_rows.coalesce(1))
    m = all_metrics(models.scored(model, test_rows), "label", "prediction", "score").first()
    assert (m.tn, m.fp, m.fn, m.tp) == (8, 0, 7, 47)
    assert m.roc_auc == pytest.approx(0.983796, abs=1e-6) and m.pr_trapezoid == pytest.approx(0.997857, abs=1e-6)
    assert m.balanced_accuracy == pytest.approx(0.9352, abs=1e-4)
    first = models.scored(model, rows.filter("row_id = 0"), ["label"]).first()
    assert first.score == pytest.approx(0.8709, abs=1e-3)
