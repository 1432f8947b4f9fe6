"""Near copies of one text that are not near each other, over many batches."""

import random

import pytest

from vitalsieve.llm import forest


@pytest.mark.parametrize("batch", [50, 10000])
def test_edited_copies_of_one_text_are_one_group(spark, batch):
    pick = random.Random(7)
    text = [f"word{i}" for i in range(300)]
    rows = [(0, " ".join(text))]
    for i in range(1, 601):
        changed = set(pick.sample(range(5, 295), 15))
        rows.append((i, " ".join(f"new{i}x{k}" if k in changed else w for k, w in enumerate(text))))
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, batch)
    try:
        got = forest.near_groups(spark.createDataFrame(rows, "doc_id long, text string"), width=2, percent=80).collect()
    finally:
        spark.conf.set(key, before)
    assert [r["doc_id"] for r in got if r["component_id"] != 0] == []
    assert [r["doc_id"] for r in got if r["kept"]] == [0]
