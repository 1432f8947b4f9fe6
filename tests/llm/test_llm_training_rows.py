"""The training sample is bounded by rows, also where an id repeats."""

from vitalsieve.llm.common import training_rows


def test_a_repeated_id_brings_one_row(spark):
    rows = [(1, f"text {i}") for i in range(300)] + [(i, f"own {i}") for i in range(2, 60)] + [(2, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 60)], "doc_id long, toxic int")
    got = training_rows(docs, labels, "toxic", 1000).collect()
    ids = [r["doc_id"] for r in got]
    assert len(ids) == len(set(ids))
    assert 1 in ids and all(r["label"] == r["doc_id"] % 2 for r in got)
    assert all(r["text"] in {t or "" for i, t in rows if i == r["doc_id"]} for r in got)
