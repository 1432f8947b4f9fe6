"""Exact deduplication by a stream over digests whose state is kept on disk, in built-in expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vitalsieve.llm.common import body, located, restored, shared_path, written

#: Files of digests that one micro-batch takes in; an interrupted run goes on after the last one.
FILES_PER_BATCH = 100_000
_RUN = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def normalised(text: str = "text") -> Column:
    """Each run of white space as one space. Single spaces are left alone, which matches far less. NULL counts as empty."""
    return F.regexp_replace(body(text), _RUN, " ")


def _digest() -> Column:
    return F.unhex(F.sha2(normalised().cast("binary"), 256))


def remembered(spark: SparkSession, digests: DataFrame, path: str) -> DataFrame:
    """(digest, keeper, copies) from a stream over the table of digests at ``path``.

    The state is keyed by digest, never expires, lies in RocksDB on the executors' disks and is backed up below the shared folder. For
    each digest it holds the smallest (doc_id, locator), NULL ids last, and the number of rows. Each micro-batch writes what it changed;
    counts only grow and the smallest only falls, so the state is read back as one minimum and one maximum. A batch that is
    repeated writes the same folder again.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    session.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false")  # else each store reserves megabytes for its log
    state, updates = shared_path(spark, "dedup-state"), shared_path(spark, "dedup-updates")
    keeper = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "locator")
    stream = session.readStream.schema(digests.schema).option("maxFilesPerTrigger", FILES_PER_BATCH).parquet(path)
    groups = stream.groupBy("digest").agg(F.min(keeper).alias("keeper"), F.count(F.lit(1)).alias("copies"))

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{updates}/batch={number}")

    save(session.createDataFrame([], groups.schema), -1)
    query = groups.writeStream.outputMode("update").option("checkpointLocation", state).foreachBatch(save).trigger(availableNow=True).start()
    query.awaitTermination()
    changed = spark.read.schema(groups.schema).parquet(updates)
    return changed.groupBy("digest").agg(F.min("keeper").alias("keeper"), F.max("copies").alias("copies"))


def groups_of(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, groups): rows (doc_id, locator, digest) of ``docs``, which must have ``locator``, and groups (digest, keeper, copies).

    On a hit the digest is not trusted: the whole normalised text of every further row is compared with that of the row that
    stays, and a difference stops the job.
    """
    spark = docs.sparkSession
    path = shared_path(spark, "digests")
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "locator", _digest().alias("digest"))
    slim.write.parquet(path)
    rows = spark.read.schema(slim.schema).parquet(path)
    groups = written(remembered(spark, rows, path), "dedup-groups")
    hits = groups.filter("copies > 1").select("digest", "keeper")
    texts = written(
        docs.select("locator", normalised().alias("norm"), _digest().alias("digest")).join(hits, "digest")
        .select("digest", "norm", (F.col("locator") == F.col("keeper.locator")).alias("stays")), "dedup-hits")
    stays = texts.filter("stays").select("digest", F.col("norm").alias("kept_norm"))
    differ = texts.filter("NOT stays").join(stays, "digest").filter("norm != kept_norm")
    if not differ.isEmpty():
        raise ValueError("different texts share a digest")
    return rows, groups


def exact_groups(docs: DataFrame) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row of ``docs``.

    The smallest doc_id of equal texts stays. Of repeated rows with that id, the first by file and place stays; a NULL id stays only
    where no row has an id, and keep_id is then NULL. NULL and empty texts are equal.
    """
    rows, groups = groups_of(located(docs.select("doc_id", "text")))
    return rows.join(groups, "digest").select(
        "doc_id", F.col("keeper.doc_id").alias("keep_id"), F.col("copies").alias("group_size"),
        (F.col("locator") == F.col("keeper.locator")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def without_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    placed = located(docs)
    rows, groups = groups_of(placed)
    gone = rows.join(groups.filter("copies > 1"), "digest").filter(F.col("locator") != F.col("keeper.locator")).select("locator")
    return restored(placed.join(gone, "locator", "left_anti"), docs.columns)
