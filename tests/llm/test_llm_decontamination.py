"""Benchmark passages in documents, against brute force: edges of windows, short items, odd rows, long texts, cut spans."""

import hashlib
import re

import pytest

from vitalsieve.llm import decontamination

ITEM = " ".join(f"q{i}" for i in range(14))
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(160_000))
BENCHMARK = [
    (3, ITEM), (20, "Two Words"), (20, "another form of item twenty that is a little longer than ten"), (None, "no id but ten words are here to be found too"),
    (5, "!!! ..."), (6, None), (7, ""), (8, ITEM), (9, "É ß 你好 ten words here and a few more of them"),
]
DOCS = [
    (1, f"Start {ITEM.upper()}!, end"), (1, f"Start {ITEM.upper()}!, end"), (2, " ".join(ITEM.split()[:9])), (3, " ".join(ITEM.split()[2:12])), (4, "--two--WORDS-- two words"),
    (5, None), (6, ""), (7, "..."), (None, "x no id but ten words are here to be found too y"), (8, "é ß 你好 ten words here and a few more of them"),
    (9, "É ß 你好 ten words here and a few more of them"), (10, f"{LONG} {ITEM} {LONG} two words"), (11, "two\x00words and sİx"), (12, f"{ITEM} {ITEM}"),
]
SCHEMA = "doc_id long, text string, locator string, spans string, items int, words string, start int"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "mine", "s", 1, "w", 2) for i, t in DOCS], SCHEMA)


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame(BENCHMARK, "item_id long, text string")


def _words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered)


def _brute(docs, benchmark):
    grams = {}
    for item, text in benchmark:
        w = _words(text)
        for i in range(max(len(w) - 9, min(len(w), 1))):
            grams.setdefault(tuple(w[i : i + 10]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, items = _words(text), set(), set()
        for n in {len(g) for g in grams}:
            for i in range(len(w) - n + 1):
                if (g := tuple(w[i : i + n])) in grams:
                    hit.update(range(i, i + n))
                    items |= grams[g]
        names = sorted(str(x) for x in items if x is not None)
        out.append((doc, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return out


def _sorted(rows):
    return sorted(map(tuple, rows), key=repr)


def test_equals_brute_force(docs, benchmark):
    assert _sorted(decontamination.judged(docs, benchmark).collect()) == _sorted(_brute(DOCS, BENCHMARK))


def test_slices_of_a_large_benchmark_find_the_same(docs, benchmark, monkeypatch):
    monkeypatch.setattr(decontamination, "MOST_WINDOWS", 3)
    assert _sorted(decontamination.judged(docs, benchmark).collect()) == _sorted(_brute(DOCS, BENCHMARK))


def test_empty_tables(docs, benchmark):
    assert decontamination.judged(docs.limit(0), benchmark).collect() == []
    assert _sorted(decontamination.judged(docs, benchmark.limit(0)).collect()) == _sorted(_brute(DOCS, []))
    assert decontamination.decontaminated(docs, benchmark.limit(0)).count() == len(DOCS)


def test_documents_go(docs, benchmark):
    kept = decontamination.decontaminated(docs, benchmark)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r[0] for r in _brute(DOCS, BENCHMARK) if not r[5])


def test_spans_go_and_the_rest_stays(docs, benchmark):
    kept = decontamination.decontaminated(docs, benchmark, "spans")
    assert kept.columns == docs.columns and kept.count() == len(DOCS)
    texts = {r.doc_id: r.text for r in kept.collect()}
    assert texts[1] == "Start !, end"
    assert texts[4] == "--"
    assert texts[2] == " ".join(ITEM.split()[:9]) and texts[5] is None and texts[6] == "" and texts[7] == "..."
    assert texts[10] == f"{LONG}  {LONG} "
    assert texts[12] == ""
    for doc, text in DOCS:
        if not any(r[0] == doc and r[5] for r in _brute(DOCS, BENCHMARK)):
            assert texts[doc] == text


def test_unknown_choice(docs, benchmark):
    with pytest.raises(ValueError):
        decontamination.decontaminated(docs, benchmark, "lines")
