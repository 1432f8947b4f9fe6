"""Benchmark passages in training documents, found by a broadcast set of word n-grams. Built-in expressions only.

Every window of a document's words is looked up by its hash; a hit counts when the words are the same. Windows are never shuffled,
only hits are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from vitalsieve.llm.common import body, located, restored, written

#: Words of a window; an item of fewer is one window of its own length.
WIDTH = 10
#: Windows of one broadcast (about 40 MB). A larger benchmark is looked up in slices of this size, one scan of the documents each.
MOST_WINDOWS = 200_000

_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The same words before capitals are lowered, and what lies between them.
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: str = "text") -> Column:
    """Words in lower case (A-Z only); NULL has none."""
    whole = body(text)
    lowered = F.when(F.length(whole) == F.octet_length(whole), F.lower(whole)).otherwise(F.translate(whole, _UPPER, _LOWER))
    return F.filter(F.split(lowered, _GAP), lambda w: w != "")


def benchmark_windows(benchmark: DataFrame, width: int = WIDTH) -> tuple[DataFrame, DataFrame]:
    """(window, hash, gram) for each distinct window, and (window, item_id) for each item that has it.

    Items without words have no windows. A row without item_id gives windows but belongs to no item; rows that repeat an id are
    one item.
    """
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words().alias("words"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - width, F.lit(0)))
    grams = items.filter(F.size("words") > 0).select("item_id", F.explode(F.transform(starts, lambda i: F.slice("words", i + 1, width))).alias("gram"))
    distinct = written(grams.select("gram").distinct().select(F.monotonically_increasing_id().alias("window"), F.xxhash64("gram").alias("hash"), "gram"), "benchmark-windows")
    holders = grams.filter(F.col("item_id").isNotNull()).join(distinct, "gram").select("window", "item_id").distinct()
    return distinct, written(holders, "benchmark-holders")


def hits(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """(locator, start, end, window): every occurrence of a window in the located ``docs``, in words from ``start`` to before ``end``.

    The scan unfolds positions, not words: a position's hash is looked up in the broadcast table, then its words are compared.
    """
    lengths = sorted(r[0] for r in windows.select(F.size("gram")).distinct().collect())  # at most WIDTH values
    slices = -(-windows.count() // MOST_WINDOWS)
    rows = docs.select("locator", words().alias("words"))
    found = None
    for i in range(max(slices, 1)):
        part = windows if slices <= 1 else windows.filter(F.pmod(F.xxhash64("gram", F.lit("slice")), F.lit(slices)) == i)
        at = rows.filter(F.size("words") > 0).select("locator", "words", F.explode(F.sequence(F.lit(0), F.size("words") - 1)).alias("start"))
        at = at.withColumn("n", F.lit(lengths[0]) if len(lengths) == 1 else F.explode(F.array(*map(F.lit, lengths)).cast("array<int>")))
        at = at.filter(F.col("start") + F.col("n") <= F.size("words"))
        here = F.slice("words", F.col("start") + 1, F.col("n"))
        same = F.when(F.col("gram") == here, True).otherwise(False)
        hit = at.join(F.broadcast(part), (F.xxhash64(here) == F.col("hash")) & same)
        hit = hit.select("locator", "start", (F.col("start") + F.col("n")).alias("end"), "window")
        found = hit if found is None else found.unionByName(hit)
    return found


def spans(found: DataFrame) -> DataFrame:
    """(locator, spans): the hit words of each document as maximal runs [start, end) that do not overlap, in order."""
    order = Window.partitionBy("locator").orderBy("start", "end")
    reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    runs = found.select("locator", "start", "end").distinct().withColumn("opens", (reached.isNull() | (F.col("start") > reached)).cast("int"))
    runs = runs.withColumn("run", F.sum("opens").over(order)).groupBy("locator", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return runs.groupBy("locator").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """(locator, spans, items) of the located ``docs`` that hold benchmark windows; ``items`` are the ids, sorted as strings."""
    windows, holders = benchmark_windows(benchmark, width)
    if windows.isEmpty():
        return docs.limit(0).select("locator", F.lit(None).cast("array<struct<start:int,end:int>>").alias("spans"), F.lit(None).cast("array<string>").alias("items"))
    found = written(hits(docs, windows), "benchmark-hits")
    few = holders.count() <= MOST_WINDOWS
    named = found.select("locator", "window").distinct().join(F.broadcast(holders) if few else holders, "window").select("locator", "item_id").distinct()
    items = named.groupBy("locator").agg(F.sort_array(F.collect_list("item_id")).alias("items"))
    return spans(found).join(items, "locator", "left")


def decontaminated(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", width: int = WIDTH) -> DataFrame:
    """``docs`` without the documents that hold benchmark windows, or with those words (and what lies between them) cut out.

    Texts without hits stay as they are, NULL stays NULL; columns of any name are kept. An empty benchmark removes nothing.
    """
    if remove not in ("documents", "spans"):
        raise ValueError("remove: documents or spans")
    placed = located(docs)
    hit = contamination(placed, benchmark, width).select("locator", "spans")
    if remove == "documents":
        return restored(placed.join(hit, "locator", "left_anti"), docs.columns)
    name = "spans" + "_" * max(len(c) for c in placed.columns)  # a name that no column has
    rows = placed.join(hit.withColumnRenamed("spans", name), "locator", "left")
    return restored(rows.withColumn("text", F.when(F.col(name).isNull(), F.col("text")).otherwise(_without(F.col("text"), F.col(name)))), docs.columns)


def _without(text: Column, runs: Column) -> Column:
    """``text`` without the words of ``runs``. Words and what lies between them alternate, so word w is segment 2 w, or 2 w + 1 behind a gap."""
    segments = F.regexp_extract_all(text, F.lit(f"{_WORD}|{_BETWEEN}"), F.lit(0))
    shift = F.when(text.rlike(f"^{_BETWEEN}"), 1).otherwise(0)
    ends = F.concat(F.array(F.lit(0)), F.transform(runs, lambda r: (2 * r["end"] - 1 + shift).cast("int")))
    starts = F.concat(F.transform(runs, lambda r: (2 * r["start"] + shift).cast("int")), F.array(F.size(segments)))
    kept = F.zip_with(ends, starts, lambda e, s: F.slice(segments, e + 1, s - e))
    return F.array_join(F.flatten(kept), "")


def judged(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) for every row of ``docs``.

    NULL and empty texts have no words; repeated rows are judged each. Items without id are neither counted nor listed, though
    their windows hit words.
    """
    placed = located(docs.select("doc_id", "text"))
    found = contamination(placed, benchmark, width)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    facts = found.select("locator", n_hit.alias("n_hit"), F.size(F.coalesce("items", F.array().cast("array<string>"))).cast("long").alias("n_items"), F.array_join("items", ",").alias("items"))
    n_words = F.regexp_count(body(), F.lit(_WORD)).cast("long")
    rows = placed.select("locator", "doc_id", n_words.alias("n_words")).join(facts, "locator", "left")
    return rows.select("doc_id", "n_words", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_hit", "n_items")],
                       F.sha2(F.coalesce("items", F.lit("")), 256).alias("items_sha256"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))
