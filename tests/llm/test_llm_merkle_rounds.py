"""Small rounds of a tree take few tasks; rounds of any task size give the same proofs."""

import pytest

from vitalsieve.llm import merkle


def _tasks(spark, group, run):
    """Tasks of what ``run`` does, with 64 shuffle partitions that are not coalesced."""
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.sparkContext.setJobGroup(group, group)
    try:
        run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        for k, v in held.items():
            spark.conf.set(k, v)
    tracker = spark.sparkContext.statusTracker()
    stages = {s for job in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(job).stageIds}
    return sum(info.numTasks for s in stages if (info := tracker.getStageInfo(s)))


def test_few_nodes_are_folded_without_shuffles(spark):
    docs = spark.range(300).selectExpr("id AS doc_id", "'s' AS source", "IF(id % 3 = 0, 'en', 'fr') AS lang", "id AS n_chars", "CAST(id AS STRING) AS text")
    assert _tasks(spark, "few-nodes", lambda: merkle.manifest(docs)) < 64


@pytest.mark.parametrize("per_task", [1, 100])
def test_dealt_rounds_give_the_same_proofs(spark, monkeypatch, per_task):
    docs = spark.range(300).selectExpr("id AS doc_id", "'s' AS source", "IF(id % 3 = 0, 'en', NULL) AS lang", "id AS n_chars", "CAST(id AS STRING) AS text")
    whole = sorted(map(str, merkle.checked(docs).collect()))
    monkeypatch.setattr(merkle, "PER_TASK", per_task)
    assert sorted(map(str, merkle.checked(docs).collect())) == whole
