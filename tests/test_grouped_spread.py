"""Grouped payloads are flattened once a request, and requests are dealt over the cores."""

import json

from pyspark.sql import functions as F

from vitalsieve.operators.validation import grouped_payload
from vitalsieve.plans import catalog, requests

GROUPS = ["g", "h", "i"]


def _flat(spark, bodies):
    df = spark.createDataFrame([(i, b if b is None else json.dumps(b)) for i, b in enumerate(bodies)], "n int, body string").coalesce(1)
    rows = df.select("n", F.to_json(grouped_payload(F.from_json("body", "map<string,variant>"), GROUPS)).alias("flat")).orderBy("n").collect()
    return [None if r["flat"] is None else list(json.loads(r["flat"]).items()) for r in rows]


def test_flattening_is_worked_out_once(spark):
    df = spark.createDataFrame([("{}",)], "body string").select(grouped_payload(F.from_json("body", "map<string,variant>"), GROUPS).alias("flat"))
    plan = df._jdf.queryExecution().analyzed().toString()
    assert plan.count("try_variant_get(") == 4 * len(GROUPS)


def test_last_value_wins_and_names_keep_their_first_place(spark):
    bodies = [
        {"g": {"a": 1, "b": 2}, "h": [{"name": "c", "value": 3}], "d": 4},
        {"g": {"a": 1, "b": 2}, "h": [{"name": "b", "value": 3}, {"name": "c", "value": 5}, {"name": "c", "value": [6]}], "i": 7, "a": None},
        {"x": 1, "a": 2},
        {"g": {}, "h": [], "i": "text"},
        {"h": [5, {"name": "x"}, {"value": 3}, {"name": "y", "value": 1}], "y": "z"},
        None,
    ]
    assert _flat(spark, bodies) == [
        [("a", 1), ("b", 2), ("c", 3), ("d", 4)],
        [("a", None), ("b", 3), ("c", [6])],
        [("x", 1), ("a", 2)],
        [],
        [("y", "z")],
        None,
    ]


def test_requests_of_one_file_are_dealt_over_the_cores(spark, tmp_path):
    rows = spark.range(4000).select(
        F.col("id").alias("event_id"), F.timestamp_seconds("id").alias("ts"), (F.col("id") % 50).alias("user_id"), F.lit("click").alias("event_type"),
        F.lit(1.5).alias("value"), F.format_string('{"k": %d}', F.col("id") % 90).alias("props"),
    )
    rows.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    bodies = catalog._mixed(spark, str(tmp_path), requests.grouped_body)
    sizes = bodies.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) >= spark.sparkContext.defaultParallelism
    assert max(r["count"] for r in sizes) <= 2 * 4000 / len(sizes)
    assert bodies.count() == 4000
    assert bodies.select("event_id").distinct().count() == 4000
