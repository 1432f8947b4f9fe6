"""A line that many documents hold, each with other surroundings."""

import random
import string

import pytest

from vitalsieve.llm import repeats
from vitalsieve.llm.common import located

LINE = b"a shared line that is longer than fifty bytes and comes in several documents of the corpus"


def _rows(n):
    pick = random.Random(3)
    return [(i, "".join(pick.choices(string.ascii_letters, k=90)) + LINE.decode() + "".join(pick.choices("abc", k=60))) for i in range(n)]


@pytest.mark.parametrize("hot", [2, repeats.HOT])
def test_hot_anchors_remove_the_same(spark, hot):
    rows = _rows(200)
    first, want = {}, {}
    for i, t in rows:
        x, gone = t.encode(), set()
        for a in range(len(x) - 49):
            if first.setdefault(x[a : a + 50], i) < i:
                gone.update(range(a, a + 50))
        want[i] = bytes(c for k, c in enumerate(x) if k not in gone)
    got = repeats.without_repeats(spark.createDataFrame(rows, "doc_id long, text string"), hot=hot).collect()
    assert {r["doc_id"]: bytes(r["kept"]) for r in got} == want


def test_passages_of_a_hot_anchor_do_not_meet_in_one_shard(spark):
    n, shards, bits = 2 * repeats.HOT, 8, 1 << 16
    docs = located(spark.createDataFrame(_rows(n), "doc_id long, text string"))
    maps = spark.sparkContext.broadcast(repeats._maps(docs, shards, bits, repeats.LENGTH, repeats.HOT))
    asked = repeats._asked(docs, maps, shards, bits, repeats.LENGTH).selectExpr("shard", "size(texts) AS n", "length(single) AS entries").groupBy("shard").sum().collect()
    assert len(asked) == shards
    assert max(r["sum(n)"] for r in asked) < repeats.HOT
    assert max(r["sum(entries)"] for r in asked) < sum(r["sum(entries)"] for r in asked) / 4
