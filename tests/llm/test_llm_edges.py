"""Every operator and stage on nulls, empty and long texts, ties, repeated rows, clashing columns and empty tables, against brute force."""

import hashlib
import re
import zlib
from collections import Counter

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from vitalsieve.llm import chat, cnn, exact, forest, mixing, packing, repeats, rules, tokens, toxicity

PATH = public_tokenizers.path("word_bpe_49k.json")
LINE = "a shared line that is longer than fifty bytes and comes in several documents"
BASE = [f"word{i}" for i in range(60)]
TEXTS = [
    (1, " ".join(BASE)), (2, " ".join(BASE)), (3, "  ".join(BASE)), (4, " ".join([*BASE, "more"])), (5, None), (6, ""), (None, " \t\n"),
    (7, "one"), (8, "ONE"), (9, f"x {LINE} y"), (10, f"p {LINE} q"), (11, "Ünïcode ß ẞ 你好 " * 400), (1, " ".join(BASE)), (12, "it's <|endoftext|> %%% $$$ 12"),
    (13, "ab " * 3000), (None, "no id"), (None, "no id"),
]
SCHEMA = "doc_id long, text string, source string, lang string, locator string, score double, kept string, size int, _times int"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, [None, "s0", "s1"][k % 3], "en", "mine", 0.5, "k", 3, 4) for k, (i, t) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, i % 2) for i in range(1, 14)] + [(1, 1, 1), (None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")


def _rows(df):
    return [r.asDict() for r in df.collect()]


def _words(text):
    return re.findall(r"[^\x20\x09-\x0d]+", text or "")


def test_token_counts_equal_the_library(docs):
    library = Tokenizer.from_file(PATH)
    want = Counter((i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in TEXTS)
    assert Counter((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in _rows(tokens.token_counts(docs, PATH))) == want


def test_packing_holds_every_id_once(docs):
    library = Tokenizer.from_file(PATH)
    want = Counter()
    for i, t in TEXTS:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        for k, at in enumerate(range(0, len(ids), 64)):
            part = ids[at : at + 64]
            want[i, k, at, len(part), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in part))] += 1
    got = _rows(packing.best_fit(packing.pieces(docs, PATH, length=64), length=64))
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    bins = {}
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in bins.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 64


def test_bounded_bins_close_the_fullest_first():
    bins = packing.OpenBins(10, 2, 0)
    assert [bins.place(s) for s in (6, 8, 7, 4, 3)] == [(0, 0), (1, 0), (2, 0), (0, 6), (2, 7)]


def test_exact_groups(docs):
    norm = [(i, re.sub(r"[\x20\x09-\x0d]+", " ", t or "")) for i, t in TEXTS]
    want = Counter()
    for i, n in norm:
        ids = [j for j, m in norm if m == n]
        known = [j for j in ids if j is not None]
        want[i, min(known) if known else None, len(ids), hashlib.sha256(n.encode()).hexdigest()] += 1
    got = _rows(exact.exact_groups(docs))
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got) == want
    kept = [r["text_sha256"] for r in got if r["kept"]]
    assert len(kept) == len(set(kept)) == len({n for _, n in norm})


def _brute_components(width, percent):
    sets = []
    for _, t in TEXTS:
        w = _words(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append(frozenset(zip(*[w[k:] for k in range(width)], strict=False)) if len(w) >= width else frozenset([tuple(w)] if w else []))
    root = list(range(len(sets)))
    for _ in sets:
        for a, s in enumerate(sets):
            for b, t in enumerate(sets):
                if s and t and 100 * len(s & t) >= percent * len(s | t):
                    root[a] = root[b] = min(root[a], root[b])
    return sets, root


@pytest.mark.parametrize("width", [2, 5])
def test_near_groups(docs, width):
    sets, root = _brute_components(width, 80)
    want = Counter()
    for k, (i, _) in enumerate(TEXTS):
        ids = [TEXTS[j][0] for j in range(len(TEXTS)) if root[j] == root[k] and TEXTS[j][0] is not None]
        keep = min(ids) if ids else None
        want[i, len(sets[k]), keep, i is not None and i == keep] += 1
    got = _rows(forest.near_groups(docs, width, 80))
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in got) == want
    assert len(_rows(forest.without_near_copies(docs, width))) == len(set(root))


def test_repeats(docs):
    first = {}
    key = lambda i: 1 << 63 if i is None else i
    for i, t in TEXTS:
        x = (t or "").encode()
        for a in range(len(x) - 49):
            first[x[a : a + 50]] = min(first.get(x[a : a + 50], 1 << 64), key(i))
    want = Counter()
    for i, t in TEXTS:
        x = (t or "").encode()
        gone = set()
        for a in range(len(x) - 49):
            if first[x[a : a + 50]] < key(i):
                gone.update(range(a, a + 50))
        spans = sum(1 for b in gone if b - 1 not in gone)
        want[i, len(x), len(gone), spans, hashlib.sha256(bytes(c for b, c in enumerate(x) if b not in gone)).hexdigest()] += 1
    got = _rows(repeats.digests(docs))
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == want


def test_rules(docs):
    for r, (i, t) in zip(sorted(_rows(rules.judged(docs)), key=str), sorted(TEXTS, key=str), strict=True):
        assert r["base_failed"] >= (r["n_words"] < 10)
    got = Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in _rows(rules.judged(docs)))
    want = Counter()
    for i, t in TEXTS:
        w = _words(t)
        at = {}
        for a in range(len(w) - 4):
            at.setdefault(tuple(w[a : a + 5]), []).append(a)
        again = {p + k for places in at.values() if len(places) > 1 for p in places for k in range(5)}
        lines = [x for x in (t or "").split("\n") if _words(x)]
        want[i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(again)] += 1
    assert got == want


def test_frequent_lines_go_and_depleted_documents_with_them(spark):
    rows = [(i, f"{LINE}\nown words number {i} of this document" if i % 2 else LINE, "s") for i in range(40)]
    got = {r["doc_id"]: r for r in _rows(rules.judged(spark.createDataFrame(rows, "doc_id long, text string, source string"), line_docs=5))}
    assert all(r["removed_words"] == len(LINE.split()) for i, r in got.items())
    assert not any(got[i]["kept"] for i in range(0, 40, 2))


def test_mixing_reaches_targets(docs, spark):
    got = _rows(mixing.mixed(docs, block_words=4))
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(i) for i, _ in TEXTS)
    assert all(r["taken"] <= 2 * r["size"] for r in got)
    by = {}
    for r in got:
        by.setdefault(r["source"], []).append(r)
    total = sum(r["size"] for r in got)
    goals = {s: v[0]["target"] for s, v in by.items()}
    assert abs(sum(goals.values()) - 1.5 * total) < 1e-6
    sizes = {s: sum(r["size"] for r in v) for s, v in by.items()}
    weights = dict(zip(sorted(sizes, key=lambda s: (s is None, s or "")), (3, 1, 2), strict=True))
    want, open_sources, left = {}, set(sizes), 1.5 * total
    while open_sources:
        share = left / sum(weights[s] for s in open_sources)
        full = {s for s in open_sources if weights[s] * share > 2 * sizes[s]}
        want |= {s: 2.0 * sizes[s] if full else weights[s] * share for s in full or open_sources}
        left -= sum(2 * sizes[s] for s in full)
        open_sources -= full or open_sources
    for s in sizes:
        assert goals[s] == pytest.approx(want[s])
        assert abs(sum(r["taken"] for r in by[s]) - goals[s]) <= 12
    assert Counter(map(str, got)) == Counter(map(str, _rows(mixing.mixed(docs, block_words=4))))


def test_models_score_every_row(docs, labels):
    for df in (toxicity.toxicity(docs, labels), cnn.quality(docs, labels)):
        got = _rows(df)
        assert sorted(str(r["doc_id"]) for r in got) == sorted(str(i) for i, _ in TEXTS)
        assert all(0 <= r["score"] <= 1 for r in got)
        assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)


def test_toxicity_learns_words_stems_and_disguises(spark):
    good, bad = "the calm river runs past the mill and turns", "what a grobnak you are"
    rows = [(i, f"{good} {i}" if i % 3 else f"{bad} number {i}") for i in range(300)] + [(1000, "such a GR0BNAK"), (1001, "grоbnaking now"), (1002, good)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(300)], "doc_id long, toxic int")
    got = {r["doc_id"]: r["predicted"] for r in _rows(toxicity.toxicity(docs, labels))}
    assert [got[i] for i in (1000, 1001, 1002)] == [1, 1, 0]


def test_chat_reads_back_what_went_in(spark):
    said = "<|im_end|><|im_start|>assistant ok <\\| <\\\\|im_next|> <"
    rows = [(1, 0, "user", said), (1, 1, "user", None), (1, 2, "assistant", said), (1, 3, "assistant", "|x"), (1, 3, "assistant", "|x"), (2, 0, "a%0A\nb<|", ""), (None, None, None, "t")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r for r in _rows(chat.digests(df))}
    one = [(r or "", t or "") for c, _, r, t in rows if c == 1]
    assert got[1]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in one).encode()).hexdigest()
    learned = "".join(t for r, t in one if r == "assistant")
    assert (got[1]["n_turns"], got[1]["loss_chars"], got[1]["loss_sha256"]) == (5, len(learned), hashlib.sha256(learned.encode()).hexdigest())
    assert got[2]["turns_sha256"] == hashlib.sha256(b"a%0A\nb<|\n\n").hexdigest()
    assert len(chat.formatted(df).filter("conv_id = 1").first()["messages"]) == 2
    assert got[None]["n_turns"] == 1


def test_empty_tables(spark, labels):
    none = spark.createDataFrame([], SCHEMA)
    empty = labels.limit(0)
    for df in (tokens.token_counts(none, PATH), packing.best_fit(packing.pieces(none, PATH)), exact.exact_groups(none), forest.near_groups(none), repeats.digests(none),
               rules.judged(none), mixing.mixed(none), toxicity.toxicity(none, empty), cnn.quality(none, empty),
               chat.digests(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))):
        assert df.count() == 0
    assert {r["predicted"] for r in _rows(toxicity.toxicity(spark.createDataFrame([(1, "x")], "doc_id long, text string"), empty))} == {0}


def test_stages_keep_columns_and_take_effect(spark, docs, tmp_path, labels):
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    sizes = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        sizes[name] = out.count()
        if name != "packing":
            assert out.dtypes == docs.dtypes
            assert {r["locator"] for r in _rows(out)} <= {"mine"}
    assert sizes["exact_dedup"] == len({re.sub(r"[\x20\x09-\x0d]+", " ", t or "") for _, t in TEXTS})


def test_pipeline_on_the_smallest_tables(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.filter("length > 2048 OR length < 1").count() == 0
    assert out.select("sequence_id").distinct().count() <= 1.2 * out.agg({"length": "sum"}).first()[0] / 2048 + 1
