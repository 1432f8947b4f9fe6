"""Helpers shared by the operators: tables in the shared folder, words, reading of the generated tables."""

from __future__ import annotations

import gc
import time
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vitalsieve.session import checkpoint_dir

#: A word is a maximal run of anything but these six ASCII characters; ``bytes.split()`` cuts at the same ones.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
_ASIDE = "_column_named_locator"


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path below the folder that all executors share."""
    base = spark.conf.get("spark.checkpoint.dir", None) or checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{label}-{uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: later steps read it, and lost executors cost no recompute."""
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete shuffle files of queries that nothing refers to any more; else they stay until the driver happens to collect its garbage."""
    for _ in range(2):  # objects of the driver's Python first, which hold those of its JVM
        gc.collect()
        time.sleep(0.3)
        spark.sparkContext._jvm.System.gc()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def located(docs: DataFrame) -> DataFrame:
    """``docs`` with ``locator``: the file and the row in it. Frames that do not come straight from files are written first.

    A column of that name is set aside until ``restored``.
    """
    docs = docs.withColumnRenamed("locator", _ASIDE)
    place = F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    try:
        return docs.select(*docs.columns, place.alias("locator"))
    except AnalysisException:
        return written(docs, "located").select(*docs.columns, place.alias("locator"))


def restored(rows: DataFrame, columns: list[str]) -> DataFrame:
    """``rows`` of a located frame with the columns it had before."""
    return rows.select(*[F.col(_ASIDE).alias(c) if c == "locator" else F.col(c) for c in columns])


def body(text: str = "text") -> Column:
    """The whole text; NULL counts as empty."""
    return F.coalesce(F.col(text), F.lit(""))


def utf8(text: str = "text") -> Column:
    return body(text).cast("binary")


def n_words(text: str = "text") -> Column:
    return F.regexp_count(body(text), F.lit(WORD)).cast("long")


def held_out(doc_id: str = "doc_id") -> Column:
    """True for rows that no model may learn from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """(doc_id, text, label) of at most ``per_class`` labelled documents of each class, chosen by a hash of the id.

    Held-out rows, NULL ids and labels other than 0 and 1 are left out; of repeated labels the larger counts. Of rows that repeat an id one is
    taken, by a hash of the text, before the shuffle already. The ids are at most
    ``2 * per_class`` longs, so they are broadcast; texts stay on the executors.
    """
    known = (
        labels.select("doc_id", F.col(label).cast("int").alias("label"))
        .filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out())
        .groupBy("doc_id").agg(F.max("label").alias("label"))
    )
    chosen = None
    for value in (0, 1):
        part = known.filter(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    rows = docs.select("doc_id", body().alias("text")).join(F.broadcast(chosen), "doc_id")
    one = F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("one")
    return rows.groupBy("doc_id", "label").agg(one).select("doc_id", "one.text", "label")
