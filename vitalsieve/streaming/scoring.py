"""Scoring of request streams with the batch expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from vitalsieve.operators.scoring import Scorer, respond


def read_requests(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Stream of request bodies, one JSON text per line, from a folder."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path).select(F.col("value").alias("body"))


def read_table_stream(spark: SparkSession, path: str, schema, files_per_batch: int | None = None) -> DataFrame:
    """Stream of Parquet rows from a folder."""
    reader = spark.readStream.format("parquet").schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def score_stream(
    requests: DataFrame, body: str, scorers: Mapping[str, Scorer], accepted: str, rejected: str, checkpoint: str, keep: Sequence[str] = (),
) -> StreamingQuery:
    """Answer a stream until it is drained: scored requests to one table, rejected ones to another.

    No state and no watermark: each request is answered alone. A micro-batch is written under its own id, so a batch
    that is repeated after a failure replaces its output instead of doubling it.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        answers = respond(batch, body, scorers, keep).persist()
        try:
            ok = F.col("status") == "success"
            answers.filter(ok).write.mode("overwrite").parquet(f"{accepted}/batch={batch_id}")
            answers.filter(~ok).write.mode("overwrite").parquet(f"{rejected}/batch={batch_id}")
        finally:
            answers.unpersist()

    return (
        requests.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
