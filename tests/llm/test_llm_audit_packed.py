"""Numbers of words come back packed by shard, and a shard is recoded and counted in one worker."""

import pytest

from vitalsieve.llm import audit


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(1, "fr", "a b c"), (2, None, None)], "doc_id long, lang string, text string")


def test_numbers_come_back_packed(spark, docs, monkeypatch):
    monkeypatch.setattr(audit, "PACKED", 1000)
    terms = spark.createDataFrame([(s, c, f"w{(c * 7 + s) % 500}".encode()) for s in range(3) for c in range(500)], "shard long, code int, word binary")
    ids = {}
    for row in audit.encoded(terms).collect():
        codes = audit._from_planes(row.codes, row.n)
        for code, number in zip(codes, row.first + audit._from_planes(row.steps, row.n).cumsum(), strict=True):
            assert ids.setdefault((row.shard, int(code)), int(number)) == int(number)
    assert len(ids) == 1500 and len(set(ids.values())) == 500
    assert all(ids[s, c] == ids[0, (c * 7 + s) % 500 * 143 % 500] for s in range(3) for c in range(500))


def test_counts_take_one_python_step_a_shard(docs):
    plan = audit.row_counts(docs.select("doc_id", "lang", "text"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 2  # the numbers, and the rows; recoded shards do not pass between workers
    assert "collect_list(struct(n" in plan
