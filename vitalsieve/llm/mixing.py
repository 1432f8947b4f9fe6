"""Mixing sources to target weights by a low-discrepancy schedule, in built-in expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from vitalsieve.llm.common import located, n_words, restored, written

#: Weights by position of the source, repeating, and the mix's size as a share of all words.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
#: No source gives more than this many times its own words.
MOST_PASSES = 2
#: Words of a block; a source's last block is cut to what its target leaves.
BLOCK_WORDS = 64
#: Sources whose goals are broadcast (a few MB); goals of more sources are joined by shuffle.
MOST_SOURCES = 20_000
GOLDEN = 0.6180339887498949
#: Pieces of a source that order its documents, cells of the unit interval, slots ranked by one task.
BUCKETS, CELLS, CHUNK = 4096, 1024, 1 << 16


def _key(source: Column) -> Column:
    """Sources as never-NULL keys in code point order, NULL last."""
    return F.when(source.isNull(), F.lit("~")).otherwise(F.concat(F.lit("="), source))


def targets(sizes: DataFrame, share: float = SHARE) -> DataFrame:
    """(src, source_size, target): one row per source of (src, size).

    Water filling: every source gets its weight times one common level, and stops at twice its size. Sources are ordered by the
    level at which they stop; the level is the first one that its own source does not stop below. Sources are the mix's
    dimension (a row each), so these windows run over a table that does not grow with the documents.
    """
    by_name = Window.orderBy("src")
    by_limit = Window.orderBy("limit", "src")
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    onwards = by_limit.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    weights = F.array(*[F.lit(float(w)) for w in WEIGHTS])
    rows = (
        sizes.groupBy("src").agg(F.sum("size").alias("source_size"))
        .withColumn("weight", F.element_at(weights, (F.row_number().over(by_name) - 1) % len(WEIGHTS) + 1))
        .withColumn("most", F.col("source_size") * float(MOST_PASSES))
        .withColumn("limit", F.col("most") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(everything) * share)
        .withColumn("level", (F.col("total") - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(onwards))
        .withColumn("common", F.min(F.when(F.col("level") <= F.col("limit"), F.struct("limit", "src", "level"))).over(everything)["level"])
    )
    aim = F.when(F.col("common").isNull(), F.col("most")).otherwise(F.least("most", F.col("weight") * F.col("common")))
    return rows.select("src", "source_size", aim.alias("target"))


def positions(sizes: DataFrame) -> DataFrame:
    """Where each document lies in its source's stream, the source's documents shuffled by a hash of their ids.

    A source is cut in BUCKETS pieces by the hash, so no source is ordered by one task.
    """
    rows = sizes.withColumn("bucket", F.pmod("order", F.lit(BUCKETS)))
    offsets = rows.groupBy("src", "bucket").agg(F.sum("size").alias("bucket_size")).withColumn(
        "offset", F.coalesce(F.sum("bucket_size").over(Window.partitionBy("src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    within = Window.partitionBy("src", "bucket").orderBy("order", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("before", F.coalesce(F.sum("size").over(within), F.lit(0))).join(offsets.select("src", "bucket", "offset"), ["src", "bucket"])
    start = (F.col("offset") + F.col("before")).cast("long").alias("start")
    return placed.select("doc_id", "size", "src", start, *[c for c in sizes.columns if c == "locator"])


def slots(goals: DataFrame, total: float, block: int) -> DataFrame:
    """(slot, src, k): slot t falls on the source whose share of the unit interval holds frac(t * golden ratio); k is its rank there.

    Shares are cut at the cells of a grid, so that points meet their source by an equality. Ranks are counted per chunk of
    slots, then inside each.
    """
    spark = goals.sparkSession
    n = round(total / block)
    ends = goals.withColumn("to", F.sum("target").over(Window.orderBy("src")) / F.lit(total or 1.0)).withColumn("from", F.col("to") - F.col("target") / F.lit(total or 1.0))
    last = Window.orderBy("src").rowsBetween(-1, -1)
    shares = ends.withColumn("from", F.coalesce(F.max("to").over(last), F.lit(0.0)))  # the same number as the one before ends with
    shares = shares.withColumn("to", F.when(F.lead("src").over(Window.orderBy("src")).isNull(), F.lit(2.0)).otherwise(F.col("to")))
    cells = shares.filter(F.col("to") > F.col("from")).select(
        "src", "from", "to", F.explode(F.sequence(F.floor(F.col("from") * CELLS), F.floor(F.least(F.col("to"), F.lit(1.0)) * CELLS))).alias("cell"))
    points = spark.range(n).select(F.col("id").alias("slot"), ((F.col("id") + 0.5) * GOLDEN - F.floor((F.col("id") + 0.5) * GOLDEN)).alias("u"))
    hit = (F.col("u") >= F.col("from")) & (F.col("u") < F.col("to"))
    dealt = points.withColumn("cell", F.floor(F.col("u") * CELLS)).join(cells, "cell").filter(hit).select("slot", "src", F.floor(F.col("slot") / CHUNK).alias("chunk"))
    before = Window.partitionBy("src").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy("src", "chunk").agg(F.count(F.lit(1)).alias("here")).withColumn("earlier", F.coalesce(F.sum("here").over(before), F.lit(0)))
    rank = F.row_number().over(Window.partitionBy("src", "chunk").orderBy("slot")) - 1
    return dealt.withColumn("rank", rank).join(counts.select("src", "chunk", "earlier"), ["src", "chunk"]).select("slot", "src", (F.col("rank") + F.col("earlier")).alias("k"))


def schedule(docs: DataFrame, share: float = SHARE, block_words: int = BLOCK_WORDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The mix of ``docs`` (doc_id, text, source): places (doc_id, size, src, start), goals (src, source_size, target), and
    pieces (slot, doc_id, src, start, words): what each slot takes of each document, in the order of the slots.

    Slot k of a source takes the k-th block of its stream, which runs through the shuffled documents up to twice. A source takes as many
    slots as its target fills, the last one in part; where the sequence has dealt it fewer, which is off by a few slots at most, the rest
    follow at the end. So every source, also one smaller than a block, ends on its target. NULL texts have no words, a NULL source is a
    source, repeated rows are documents of their own. A column ``locator`` goes along in places.
    """
    sizes = written(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), n_words().alias("size"), _key(F.col("source")).alias("src"),
        F.xxhash64(F.lit("mix"), "doc_id").alias("order"), *[c for c in docs.columns if c == "locator"],
    ), "mix-sizes")
    goals = written(targets(sizes, share).withColumn("aim", F.round("target").cast("long")), "mix-goals")
    by_source = F.broadcast(goals) if goals.count() <= MOST_SOURCES else goals
    total = (sizes.agg(F.sum("size")).first()[0] or 0) * share
    places = written(positions(sizes), "mix-places")
    passes = places.filter("size > 0").join(by_source, "src").select(
        "doc_id", "src", "start", "source_size", "aim",
        F.explode(F.array(*[F.struct((F.col("start") + F.col("source_size") * i).alias("at"), (F.col("start") + F.col("size") + F.col("source_size") * i).alias("end")) for i in range(MOST_PASSES)])).alias("run"))
    block = block_words
    end = F.least(F.col("run.end"), F.col("aim"))
    blocks = passes.filter(F.col("run.at") < F.col("aim")).select(
        "doc_id", "src", "start", "run", "aim", F.explode(F.sequence(F.floor(F.col("run.at") / block), F.floor((end - 1) / block))).alias("k"))
    words = F.least(F.col("run.end"), (F.col("k") + 1) * block, F.col("aim")) - F.greatest(F.col("run.at"), F.col("k") * block)
    wanted = F.ceil(F.col("aim") / block)
    dealt = written(slots(goals, total, block), "mix-slots")
    counts = dealt.groupBy("src").agg((F.max("k") + 1).alias("dealt"))
    late = goals.join(counts, "src", "left").withColumn("first", F.coalesce("dealt", F.lit(0))).filter(F.col("first") < wanted).select(
        "src", F.explode(F.sequence(F.col("first"), (wanted - 1).cast("long"))).alias("k")).select((F.lit(round(total / block)) + F.col("k")).alias("slot"), "src", "k")
    pieces = dealt.unionByName(late).join(blocks.withColumn("words", words.cast("long")), ["src", "k"]).select("slot", "doc_id", "src", "start", "words")
    return places, goals.drop("aim"), pieces


def mixed(docs: DataFrame, share: float = SHARE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, size, source, source_size, target, taken) for every row of ``docs``: the words that the mix takes of it."""
    places, goals, pieces = schedule(docs.select("doc_id", "text", "source"), share, block_words)
    rows = _taken(places, pieces).join(F.broadcast(goals) if goals.count() <= MOST_SOURCES else goals, "src")
    source = F.when(F.col("src") != "~", F.substring("src", 2, 1 << 30))
    return rows.select("doc_id", "size", source.alias("source"), "source_size", "target", "taken")


def _taken(places: DataFrame, pieces: DataFrame) -> DataFrame:
    """``places`` with the words that all slots take of each. Documents with words differ in (src, start)."""
    sums = pieces.groupBy("src", "start").agg(F.sum("words").alias("sum")).withColumn("some", F.lit(True))
    rows = places.withColumn("some", F.col("size") > 0).join(sums, ["src", "start", "some"], "left")
    return rows.drop("some").withColumn("taken", F.coalesce("sum", F.lit(0)).cast("long")).drop("sum")


def remixed(docs: DataFrame, share: float = SHARE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, rounded to whole documents; so rows without words are not taken."""
    placed = located(docs)
    places, _, pieces = schedule(placed, share, block_words)
    name = "times" + "_" * max(len(c) for c in placed.columns)  # a name that no column has
    times = _taken(places, pieces).filter("size > 0").select("locator", F.round(F.col("taken") / F.col("size")).cast("int").alias(name))
    rows = placed.join(times.filter(F.col(name) > 0), "locator")
    return restored(rows.withColumn(name, F.explode(F.sequence(F.lit(1), F.col(name)))), docs.columns)
