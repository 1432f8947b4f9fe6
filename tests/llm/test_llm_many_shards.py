"""Blocks that ask very many shards, shards whose passages are compared in lots, and shuffle files of ended steps."""

import glob
import random
import string
import time

import numpy as np
import pyarrow as pa

from vitalsieve.llm import repeats

LINE = "a shared line that is longer than fifty bytes and comes in several documents of the corpus"


def _rows(n):
    pick = random.Random(5)
    lines = [LINE, *("".join(pick.choices(string.ascii_lowercase + " ", k=70)) for _ in range(9))]
    return [(i, "".join(pick.choices(string.ascii_letters, k=30 + i % 60)) + " ".join(pick.sample(lines, i % 4))) for i in range(n)]


def _wanted(rows):
    first, want = {}, {}
    for i, t in rows:
        x, gone = t.encode(), set()
        for a in range(len(x) - 49):
            if first.setdefault(x[a : a + 50], i) < i:
                gone.update(range(a, a + 50))
        want[i] = bytes(c for k, c in enumerate(x) if k not in gone)
    return want


def test_more_shards_than_a_block_has_runs_remove_the_same(spark, monkeypatch):
    rows = _rows(300)
    monkeypatch.setattr(repeats, "SHARD_BYTES", 4)
    monkeypatch.setattr(repeats, "_FEW", 1 << 13)
    got = repeats.without_repeats(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()
    assert {r["doc_id"]: bytes(r["kept"]) for r in got} == _wanted(rows)


def test_shards_become_larger_before_there_are_many():
    assert [repeats._shards(x) for x in (0, 1 << 22, 864 << 20, 10 << 30)] == [1, 2, 256, 1024]
    counts = [repeats._shards(x << 20) for x in range(1, 20_000, 7)]
    assert counts == sorted(counts)


def test_passages_compared_in_lots_meet_as_in_one(monkeypatch):
    rows = [t.encode() for _, t in _rows(400)]
    r = repeats.runs_of(rows)
    passages = sorted({rows[d][f : e + repeats.LENGTH] for d, f, e in zip(r.doc, r.first, r.last, strict=True)})
    ids = np.arange(len(passages))[::-1].copy()
    whole = repeats._by_strings(passages, ids, repeats.LENGTH)
    monkeypatch.setattr(repeats, "_COMPARED", 1 << 8)
    for a, b in zip(whole, repeats._by_strings(passages, ids, repeats.LENGTH), strict=True):
        assert a.tolist() == b.tolist()


def test_records_of_binary_values_come_back():
    records, counts = np.arange(10, dtype=np.uint64), np.array([3, 0, 2, 5])
    column = pa.chunked_array([repeats._packed(records, counts), repeats._packed(records, counts).slice(2, 2), repeats._packed(records[:0], np.array([0]))])
    got, of = repeats._unpacked(column, np.uint64)
    assert got.tolist() == [*range(10), *range(3, 10)]
    assert of.tolist() == [3, 0, 2, 5, 2, 5, 0]


def test_ended_steps_leave_no_shuffle_files(spark):
    folders = [d.getPath() for d in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    files = lambda: {x for d in folders for x in glob.glob(f"{d}/*/shuffle_*.data")}
    before = files()
    rows = repeats.without_repeats(spark.createDataFrame(_rows(200), "doc_id long, text string"))
    until = time.time() + 20
    while len(files() - before) > 1 and time.time() < until:  # Spark deletes in the background
        time.sleep(0.2)
    assert len(files() - before) <= 1  # no runs and no passages
    assert {r["doc_id"]: bytes(r["kept"]) for r in rows.collect()} == _wanted(_rows(200))
