"""Manifests and proofs, against trees built one node at a time."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from vitalsieve.llm import merkle

ROWS = (
    [(i, "s", "en", i % 7, f"text {i}") for i in range(150)] + [(i, None, "fr", None, "é" * i) for i in range(3)] + [(None, "s", None, 3, None), (None, "s", None, 3, None)]
    + [(5, "s", "", 1, ""), (14, "s", "zz", 9, "long " * 300_000)] + [(7, "s", "en", 0, "again")] * 3
)
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree int, digest string, root string, steps int, m int"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, 1, "d", "r", 2, 3) for r in ROWS], SCHEMA).repartition(5)


def _h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _leaf(row, more=0):
    i, source, lang, n, text = row
    values = (i, source, lang, n if n is None else n + more, text)
    return _h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def _levels(nodes, arity):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([_h("".join(levels[-1][i : i + arity])) for i in range(0, len(levels[-1]), arity)])
    return levels


def _steps(levels, i, arity):
    out = []
    for level in levels[:-1]:
        first = i // arity * arity
        out.append(("".join(level[first:i]), "".join(level[i + 1 : first + arity])))
        i //= arity
    return out


def _brute(rows, arity=2):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, _leaf(r)))
        trees[g] = _levels([_leaf(r) for r in groups[g]], arity)
    top = _levels([trees[g][-1][0] for g in names], arity)
    out = []
    for k, g in enumerate(names):
        for i, r in enumerate(groups[g]):
            steps = _steps(trees[g], i, arity) + _steps(top, k, arity)
            digest = _leaf(r, int(r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0))
            for left, right in steps:
                digest = _h(left + digest + right)
            root = top[-1][0]
            out.append((r[0], _leaf(r), trees[g][-1][0], root, _h("".join(a + b for a, b in steps)), digest, digest == root))
    return sorted(out, key=repr)


def test_equals_trees_built_by_hand(docs):
    got = sorted(map(tuple, merkle.checked(docs).collect()), key=repr)
    assert got == _brute(ROWS)
    assert {x[-1] for x in got} == {True, False}


@pytest.mark.parametrize("arity,levels", [(3, 2), (2, 1)])
def test_other_shapes(docs, arity, levels):
    rows = merkle.manifest(docs, arity=arity, levels=levels)
    rows = rows.select("doc_id", "leaf", "subroot", "root", F.sha2(merkle.proof_text(F.col("steps")), 256), merkle.folded(F.col("leaf"), F.col("steps")))
    assert sorted((tuple(r)[:5] for r in rows.collect()), key=repr) == sorted((r[:5] for r in _brute(ROWS, arity)), key=repr)
    assert all(r[3] == r[5] for r in rows.collect())


def test_one_row_and_none(docs):
    one = docs.filter("text = 'text 8'")
    assert list(map(tuple, merkle.checked(one).collect())) == _brute([r for r in ROWS if r[4] == "text 8"])
    assert merkle.checked(docs.limit(0)).collect() == []
