"""Exact distinct counts without copies of rows, and sketches that merge in any order."""

import pytest
from pyspark.sql import functions as F

from vitalsieve.operators import associations, profile, summaries


@pytest.fixture(scope="module")
def rows(spark):
    data = [(i % 3, float(i % 10) if i % 4 else None, f"t{i % 23}" if i % 5 else None, None, -0.0 if i % 2 else 0.0) for i in range(300)]
    return spark.createDataFrame(data, "day int, x double, t string, nothing int, zero double")


def test_exact_distincts(spark, rows):
    got = {r.feature: r.n_distinct for r in summaries.exact_distincts(rows, rows.columns).collect()}
    assert got == {"day": 3, "x": 10, "t": 23, "nothing": 0, "zero": 1}
    assert {r.n_distinct for r in summaries.exact_distincts(rows.limit(0), rows.columns).collect()} == {0}


def test_no_copy_of_rows_per_column(rows):
    plan = profile.distinct_values(rows, rows.columns, null_is_value=True)._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan


def test_sketches_merge_to_the_whole(spark, rows):
    columns = ["x", "t", "nothing", "zero"]
    whole = {r.feature: r for r in summaries.summarised(summaries.column_sketches(rows, columns)).collect()}
    daily = summaries.column_sketches(rows, columns, ["day"])
    stepped = summaries.merged_sketches(summaries.merged_sketches(daily.withColumn("part", F.col("day") % 2), ["part"]))
    for merged in (summaries.merged_sketches(daily), stepped):
        for r in summaries.summarised(merged).collect():
            want = whole[r.feature]
            assert (r.n, r.missing, r.zeros, r.min, r.max) == (want.n, want.missing, want.zeros, want.min, want.max)
            assert r.mean == pytest.approx(want.mean) and r["std"] == pytest.approx(want["std"])
            assert abs(r.n_distinct - want.n_distinct) <= 1
    assert whole["nothing"].mean is None and whole["x"].n_distinct == 10 and whole["t"].zeros is None


def test_input_schema_reads_the_rows(rows):
    got = {r.name: (r.dtype, r.n_present, r.widest) for r in profile.input_schema(rows).collect()}
    assert got["t"] == ("string", 240, 3) and got["nothing"] == ("int", 0, None)


def test_gram_matrix_equals_pairwise_correlation(spark):
    rows = spark.range(500).select(
        *[F.when(F.col("id") % (k + 2) != 0, 1e6 * k + (F.col("id") * (k + 3)) % 41).alias(f"c{k}") for k in range(6)], F.lit(3.0).alias("flat"), F.lit(None).cast("double").alias("none"))
    few = {(r.row, r.column): r.corr for r in associations.correlation_matrix(rows, rows.columns).collect()}
    many = {(r.row, r.column): r.corr for r in associations.gram_correlations(rows, rows.columns).collect()}
    assert few.keys() == many.keys()
    for key, want in few.items():
        assert (want is None) == (many[key] is None) and (want is None or many[key] == pytest.approx(want, abs=1e-9)), key
    assert {r.corr for r in associations.gram_correlations(rows.limit(0), ["c0", "c1"]).collect()} == {None}
