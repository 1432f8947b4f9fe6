import pytest
from pyspark.sql import functions as F

from vitalsieve.operators import metrics
from vitalsieve.sources.documents import comparison_rows


def _scored(spark, truth, prediction, score):
    return spark.createDataFrame([(int(a), int(b), None if c is None else float(c)) for a, b, c in zip(truth, prediction, score)], "y int, p int, s double")


def test_perfect(spark):
    m = metrics.all_metrics(_scored(spark, [0, 0, 1, 1], [0, 0, 1, 1], [0.1, 0.2, 0.8, 0.9]), "y", "p", "s").first()
    assert (m.tn, m.fp, m.fn, m.tp) == (2, 0, 0, 2)
    assert all(m[n] == 1.0 for n in metrics.METRICS)


def test_mixed(spark):
    truth, pred = [0] * 80 + [1] * 20, [0] * 70 + [1] * 10 + [0] * 5 + [1] * 15
    m = metrics.threshold_metrics(_scored(spark, truth, pred, pred), "y", "p").first()
    assert (m.recall, m.specificity, m.precision, m.accuracy) == (0.75, 0.875, 0.6, 0.85)


def test_inverted_pair(spark):
    m = metrics.ranking_metrics(_scored(spark, [0, 1, 0, 1, 0, 1], [0] * 6, [0.1, 0.9, 0.3, 0.8, 0.85, 0.4]), "y", "s").first()
    assert m.roc_auc == pytest.approx(0.777778, abs=1e-6) and m.pr_trapezoid == pytest.approx(0.763889, abs=1e-6)


def test_edges(spark):
    tied = metrics.ranking_metrics(_scored(spark, [0, 1, 0, 1], [0] * 4, [0.5] * 4), "y", "s").first()
    assert tied.roc_auc == 0.5
    single = metrics.all_metrics(_scored(spark, [1, 1], [0, 0], [0.2, 0.3]), "y", "p", "s").first()
    assert single.roc_auc is None and single.precision == 0.0 and single.specificity == 0.0


def test_negative_scores_and_groups(spark):
    rows = [("a", 0, -3.0), ("a", 1, 2.0), ("a", 0, -1.0), ("a", 1, -2.0), ("b", 1, 0.0), ("b", 0, -0.5)]
    df = spark.createDataFrame(rows, "model string, y int, s double")
    got = {r.model: r.roc_auc for r in metrics.ranking_metrics(df, "y", "s", ["model"]).collect()}
    assert got == {"a": 0.75, "b": 1.0}


def test_curves_stay_in_range(spark):
    df = _scored(spark, [0, 1, 0, 1, 0, 1], [0] * 6, [0.1, 0.9, 0.3, 0.8, 0.4, 0.7])
    roc = metrics.roc_points(df, "y", "s").orderBy(F.desc("threshold")).collect()
    assert (roc[0].fpr, roc[0].tpr) == (0.0, 0.0) and (roc[-1].fpr, roc[-1].tpr) == (1.0, 1.0)
    assert all(0 <= r.precision <= 1 and 0 <= r.recall <= 1 for r in metrics.pr_points(df, "y", "s").collect())


def test_fold_deviation_is_population(spark):
    df = spark.createDataFrame([("m", 0.8), ("m", 0.9)], "model string, roc_auc double")
    row = metrics.fold_summary(df, names=["roc_auc"]).first()
    assert row.roc_auc_mean == pytest.approx(0.85) and row.roc_auc_std == pytest.approx(0.05)
    line = comparison_rows(metrics.fold_summary(df, names=["roc_auc"]), ["roc_auc"]).first().line
    assert line == "| m | 0.8500 ± 0.0500 |"


def test_champion_breaks_ties(spark):
    rows = [("b", 0.9, 0.5, 0.5, 0.5), ("a", 0.9, 0.6, 0.5, 0.5), ("c", 0.8, 0.9, 0.9, 0.9)]
    df = spark.createDataFrame(rows, "model string, roc_auc_mean double, avg_precision_mean double, balanced_accuracy_mean double, specificity_mean double")
    assert [r.model for r in metrics.champion(df, top=2).collect()] == ["a", "b"]


def test_metric_defects(spark):
    df = spark.createDataFrame([(0.5, float("nan")), (1.5, 0.2)], "accuracy double, f1 double")
    assert {r.metric: r.defects for r in metrics.metric_defects(df, ["accuracy", "f1"]).collect()} == {"accuracy": 1, "f1": 1}


def test_crowded_buckets_are_cut(spark, monkeypatch):
    """Scores packed into a few buckets give the same curve as plain running sums."""
    monkeypatch.setattr(metrics, "_CROWDED", 5)
    monkeypatch.setattr(metrics, "_PIECES", 50)
    rows = [(i % 3 % 2, 0.5 + i * 1e-12) for i in range(400)] + [(1, 0.5)] * 200 + [(0, -0.25), (1, 1e-9)]
    df = spark.createDataFrame(rows, "y int, s double")
    curve = {r.score: (r.tp, r.fp) for r in metrics.score_curve(df, "y", "s").collect()}
    tp = fp = 0
    for score in sorted({s for _, s in rows}, reverse=True):
        tp += sum(y for y, s in rows if s == score)
        fp += sum(1 - y for y, s in rows if s == score)
        assert curve[score] == (tp, fp)


def test_missing_group_key_is_a_group(spark):
    df = spark.createDataFrame([(None, 0, 0.1), (None, 1, 0.9), ("a", 1, 0.1), ("a", 0, 0.9)], "model string, y int, s double")
    assert {r.model: r.roc_auc for r in metrics.ranking_metrics(df, "y", "s", ["model"]).collect()} == {None: 1.0, "a": 0.0}
