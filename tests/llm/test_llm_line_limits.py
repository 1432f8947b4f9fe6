"""Shared lines go with the limits as they are in use, in small hosts by their share and in large ones by their count."""

from vitalsieve.llm import rules

SHARED = "all rights of this page are reserved by the people who wrote it"


def test_shared_lines_go_in_small_and_large_hosts(spark):
    own = lambda h, i: " ".join(f"{h}{i}w{k}" for k in range(12))
    rows = []
    for host, size, holders in (("small", 10, 3), ("large", 2000, 30), ("calm", 400, 15), ("tiny", 4, 2)):
        for i in range(size):
            text = own(host, i)
            if i < holders:
                text = f"{SHARED.upper()}\n{text}" if i else f"{SHARED}\n{' '.join(text.split()[:4])}"
            rows.append((len(rows), text, host))
    got = rules.judged(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    gone = {r["doc_id"]: r["removed_words"] for r in got if r["removed_words"]}
    n = len(SHARED.split())
    assert gone == dict.fromkeys([*range(3), *range(10, 40)], n)
    kept = {r["doc_id"] for r in got if r["kept"]}
    assert kept == set(range(len(rows))) - {0, 10}
