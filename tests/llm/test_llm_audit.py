"""Filter interactions and the document-term matrix behind them, against brute force."""

import re
from collections import Counter, defaultdict
from itertools import permutations

import pytest

from vitalsieve.llm import audit

LONG = " ".join(f"word{i % 5003}" for i in range(300_000))
TEXTS = [
    (1, "fr", "a b c " * 100), (2, "fr", "a b c " * 100), (2, "fr", "a b c " * 100), (None, "fr", "a b c " * 100), (3, None, None), (4, "", ""), (5, "de", "THE END"), (6, "de", " ".join(f"w{i}" for i in range(300)) + " #"),
    (7, "de", LONG), (8, "de", LONG + " $"), (9, "en", "ÄÖÜ ß A"), (10, "en", " \t\n"), (10, "en", "x"), (11, "en", " ".join(f"w{i}" for i in range(300))),
]
LABELS = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (5, None, 1), (6, 0, None), (None, 1, 1), (7, 1, 1), (99, 1, 1)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, lang, t, "x", 1, "y") for i, lang, t in TEXTS]
    return spark.createDataFrame(rows, "doc_id long, lang string, text string, part string, marks int, digest string")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")


def _words(text):
    return re.findall(r"[^\x20\x09-\x0d]+", text or "")


def _fails(docs):
    out = []
    for i, lang, text in docs:
        w, t = _words(text), text or ""
        fails = ("A" * (len(w) < 200) + "B" * (100 * len(set(w)) < 50 * len(w)) + "C" * (100 * len(re.findall("[A-Z]", t)) > 3 * len(t)) + "D" * bool(re.search(r"[#$%&*|]", t))
                 + "E" * (i is not None and any(j is not None and j < i and (u or "") == t for j, _, u in docs)))
        out.append((i, lang or "", fails))
    return out


def _brute(docs, labels):
    good, toxic = ({i for i, q, x in labels if i is not None and (q, x)[k] == 1} for k in (0, 1))
    rows = _fails(docs)
    parts = defaultdict(list)
    for i, part, fails in rows:
        parts[part].append((i, fails))
    out = []
    for part, members in parts.items():
        taken = Counter()
        lines = []
        for order in permutations("ABCDE"):
            left = list(members)
            for step, f in enumerate(order, 1):
                gone = [(i, x) for i, x in left if f in x]
                left = [(i, x) for i, x in left if f not in x]
                taken[f] += len(gone)
                redundant = sum(f in x for _, x in members) - len(gone)
                lines.append((part, "".join(order), step, len(left), len(gone), redundant, sum(x == f for _, x in members), sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone), f))
        out += [(*line[:-1], taken[line[-1]]) for line in lines]
    return sorted(out)


def test_equals_brute_force(docs, labels):
    assert sorted(map(tuple, audit.filter_audit(docs, labels).collect())) == _brute(TEXTS, LABELS)


def test_hot_keys_are_joined_apart(docs, labels, monkeypatch):
    monkeypatch.setattr(audit, "HOT", 0.1)
    assert sorted(map(tuple, audit.filter_audit(docs, labels).collect())) == _brute(TEXTS, LABELS)


@pytest.mark.parametrize("shard_bytes", [1, 500, 1 << 21])
def test_matrix_holds_every_word(docs, shard_bytes):
    matrix = audit.term_matrix(docs, shard_bytes).collect()
    got, seen = [], set()
    for shard in matrix:
        for r, doc_id in enumerate(shard.doc_id):
            at = slice(shard.row_ends[r], shard.row_ends[r + 1])
            assert len(set(shard.columns[at])) == len(shard.columns[at])
            seen |= set(shard.columns[at])
            got.append((doc_id, Counter(sorted(shard.data[at]))))
    want = [(i, Counter(Counter(_words(t)).values())) for i, _, t in TEXTS]
    assert sorted(map(repr, got)) == sorted(repr((i, Counter(sorted(c.elements())))) for i, c in want)
    assert len(seen) == len({w for _, _, t in TEXTS for w in _words(t)})


def test_empty_tables(docs, labels):
    assert audit.filter_audit(docs.limit(0), labels).collect() == []
    assert sorted(map(tuple, audit.filter_audit(docs, labels.limit(0)).collect())) == _brute(TEXTS, [])
