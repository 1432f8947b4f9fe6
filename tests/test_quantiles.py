import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from vitalsieve.functions.ordering import order_bucket
from vitalsieve.operators.distributions import box_by_class, histogram, iqr_bounds, iqr_outliers, kernel_density
from vitalsieve.operators.quantiles import quantiles

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]


def _frame(spark, **columns):
    names = list(columns)
    rows = [tuple(None if v is None else float(v) for v in row) for row in zip(*columns.values())]
    return spark.createDataFrame(rows, ", ".join(f"`{n}` double" for n in names))


def _check(spark, values):
    got = {r.prob: r.value for r in quantiles(_frame(spark, x=values), ["x"], PROBS).collect()}
    present = np.array([v for v in values if v is not None], dtype=float)
    for p in PROBS:
        assert got[p] == pytest.approx(np.quantile(present, p), rel=1e-12, abs=1e-300), p


CASES = {
    "signs and zeros": list(np.random.RandomState(1).normal(size=500)) + [0.0] * 50 + [-0.0],
    "one value in a third of the rows": [7.5] * 400 + list(np.linspace(-1000, 1000, 800)),
    "far outliers": [1e-300, 1e300, -1e300, 1e-12, 5.0, 5.0 + 1e-12, 5.0 + 2e-12, 3.0],
    "neighbours": [1.0 + i * 2.0**-52 for i in range(300)],
    "constant": [4.0] * 17,
    "two": [1.0, 2.0],
    "one": [9.0],
    "missing": [None, 1.0, None, 3.0, 10.0],
    "powers": [2.0**i for i in range(-60, 60)],
}


@pytest.mark.parametrize("case", CASES)
def test_selection_equals_sorting(spark, case):
    _check(spark, CASES[case])


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False, min_value=-1e100, max_value=1e100), min_size=1, max_size=60))
def test_selection_on_any_values(spark, values):
    got = {r.prob: r.value for r in quantiles(_frame(spark, x=values), ["x"], [0.25, 0.5]).collect()}
    for p in (0.25, 0.5):
        assert got[p] == pytest.approx(np.quantile(np.array(values), p), rel=1e-9, abs=1e-290)


def test_bucket_keeps_order(spark):
    values = sorted([*np.random.RandomState(3).normal(scale=1e6, size=2000), *[2.0**k for k in range(-1000, 1000, 7)], 0.0, -1e-300, float("inf"), float("-inf")])
    rows = spark.createDataFrame([(float(v),) for v in values], "x double").select("x", order_bucket(F.col("x"), 65536).alias("b")).orderBy("x").collect()
    buckets = [r.b for r in rows]
    assert buckets == sorted(buckets)


def test_methods_agree_per_group(spark):
    rng = np.random.RandomState(5)
    rows = [(int(i % 3 == 0), float(v), float(v**2)) for i, v in enumerate(rng.normal(size=900))]
    df = spark.createDataFrame(rows, "label int, `a b` double, c double")
    results = [
        {(r.label, r.feature, r.prob): r.value for r in quantiles(df, ["a b", "c"], [0.25, 0.5, 0.75], ["label"], m).collect()}
        for m in ("select", "hash")
    ]
    assert results[0].keys() == results[1].keys() and len(results[0]) == 12
    for key, value in results[0].items():
        assert value == pytest.approx(results[1][key], rel=1e-12)


def test_approximate_carries_its_error(spark):
    row = quantiles(_frame(spark, x=range(1000)), ["x"], [0.5], method="approx", accuracy=100).first()
    assert row.rank_error == 0.01 and abs(row.value - 499.5) <= 10 + 0.5


def test_unknown_method(spark):
    with pytest.raises(ValueError):
        quantiles(_frame(spark, x=[1]), ["x"], [0.5], method="guess")


def test_outlier_base(spark):
    df = _frame(spark, x=[1, 2, 3, 4, 100, None, None, None, None, None])
    assert iqr_outliers(df, ["x"]).first().outlier_pct == 20.0
    assert iqr_outliers(df, ["x"], base="all").first().outlier_pct == 10.0
    bounds = iqr_bounds(df, ["x"]).first()
    assert (bounds.q25, bounds.q75, bounds.lower, bounds.upper) == (2.0, 4.0, -1.0, 7.0)


def test_box_whiskers(spark):
    df = spark.createDataFrame([("a", float(v)) for v in (1, 2, 3, 4, 100)] + [("b", 5.0)], "k string, x double")
    rows = {r.k: r for r in box_by_class(df, ["x"], "k").collect()}
    assert (rows["a"].whisker_low, rows["a"].whisker_high, rows["a"].beyond) == (1.0, 4.0, 1)
    assert (rows["b"].q1, rows["b"].whisker_high, rows["b"].beyond) == (5.0, 5.0, 0)


def test_histogram_edges(spark):
    rows = histogram(_frame(spark, x=[0, 1, 2, 3, 10]), "x", bins=5).orderBy("bucket").collect()
    assert [(r.bucket, r.n) for r in rows] == [(0, 2), (1, 2), (4, 1)]
    assert sum(r.density for r in rows) * 2.0 == pytest.approx(1.0)
    assert histogram(_frame(spark, x=[3, 3, 3]), "x", bins=4).first().n == 3


def test_density_bins_are_close(spark):
    values = list(np.random.RandomState(2).normal(size=400))
    exact = {r.i: r.density for r in kernel_density(_frame(spark, x=values), "x", 20).collect()}
    binned = {r.i: r.density for r in kernel_density(_frame(spark, x=values), "x", 20, bins=512).collect()}
    for i, d in exact.items():
        assert binned[i] == pytest.approx(d, abs=2e-3)
