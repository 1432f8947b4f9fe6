"""Small link tables take few tasks; both ways to contract links agree with a search."""

import random

import pytest

from vitalsieve.llm import graph


def _search(links):
    near, roots = {}, {}
    for a, b in links:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    for start in sorted(near):
        todo = [start]
        while todo:
            x = todo.pop()
            if x not in roots:
                roots[x] = start
                todo += near[x]
    return sorted((x, r) for x, r in roots.items() if x != r)


def _links():
    pick = random.Random(3)
    chain = [(i, i + 1) for i in range(1000, 1100)]
    hub = [(5000, i) for i in range(2000, 2300)]
    loose = [(pick.randrange(400), pick.randrange(400)) for _ in range(150)]
    return chain + hub + loose + [(7, 7), (9, 8), (8, 9)]


@pytest.mark.parametrize("few", [0, 100, graph.FEW])
def test_roots_are_smallest_members(spark, monkeypatch, few):
    monkeypatch.setattr(graph, "FEW", few)
    links = [x for x in _links() if x[0] != x[1]]
    got = graph.components(spark.createDataFrame(_links(), "a long, b long")).collect()
    assert sorted(map(tuple, got)) == _search(links)


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


def test_rounds_of_few_links_are_not_shuffled(spark):
    links = spark.createDataFrame(_links(), "a long, b long")
    assert _tasks(spark, "few-links", lambda: graph.components(links)) < 64 * 6
