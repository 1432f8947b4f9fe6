"""Every source ends on its target, also those smaller than a block, and the mix is the same again."""

import pytest

from vitalsieve.llm import mixing


def _goals(sizes):
    """Water filling by hand: shares by weight, capped at twice the source, the excess dealt again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total, goals, open_ = sum(sizes.values()) * 1.5, {}, set(names)
    while open_:
        left = total - sum(goals.values())
        unit = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * unit > 2 * sizes[s]}
        if not full:
            return goals | {s: weight[s] * unit for s in open_}
        goals |= {s: 2.0 * sizes[s] for s in full}
        open_ -= full
    return goals


SIZES = [
    {"a": 10_000, "b": 10_000, "c": 10_000, **{f"t{i}": 5 for i in range(6)}},
    {"a": 3000, None: 7, "c": 1, "d": 64, "e": 0},
    {"one": 100},
]


@pytest.mark.parametrize("sizes", SIZES)
def test_targets_are_met_to_a_word(spark, sizes):
    rows, n = [], 0
    for source, words in sizes.items():
        while words > 0 or not any(r[2] == source for r in rows):
            take = min(words, 1 + n * 37 % 211)
            rows.append((n, " ".join(["w"] * take), source))
            n, words = n + 1, words - take
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mixed(docs).collect()
    goals = _goals(sizes)
    for source, goal in goals.items():
        mine = [r for r in got if r.source == source]
        assert all(abs(r.target - goal) < 1e-6 for r in mine)
        assert abs(sum(r.taken for r in mine) - goal) <= 0.5 + 1e-6, source
    assert all(0 <= r.taken <= 2 * r.size for r in got)
    assert sorted(map(tuple, mixing.mixed(docs.repartition(7)).collect()), key=repr) == sorted(map(tuple, got), key=repr)
