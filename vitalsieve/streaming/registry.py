"""Models that change while a stream runs: a registry of versions on shared storage, read anew for every micro-batch."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from vitalsieve.contracts import TableContract
from vitalsieve.operators.routing import Served, answer
from vitalsieve.sources.artifacts import artifact_present, load_model

_ROW = (
    "disease string, intercept double, weights map<string,double>, filled map<string,double>, filled_levels map<string,string>, calibrated boolean, model_path string"
)


def publish(spark: SparkSession, path: str, version: int, served: Mapping[str, Served], model_paths: Mapping[str, str] = {}) -> None:
    """Make these models the current ones of their diseases. A version is one folder, written whole; publishing it again replaces it.

    Fitted pipelines are named by the path they were saved at; an entry with neither weights nor a path takes its disease out of service.
    """
    rows = []
    for name, s in sorted(served.items()):
        texts = {k: v for k, v in s.filled.items() if isinstance(v, str)}
        numbers = {k: float(v) for k, v in s.filled.items() if not isinstance(v, str)}
        weights = None if s.weights is None else {k: float(v) for k, v in s.weights.items()}
        rows.append((name, float(s.intercept), weights, numbers, texts, s.calibrated, model_paths.get(name)))
    spark.createDataFrame(rows, _ROW).coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}/version={int(version)}")


def latest(spark: SparkSession, path: str) -> DataFrame:
    """The newest row of each disease, with its version. An empty registry has none."""
    try:
        rows = spark.read.schema(f"{_ROW}, version int").parquet(path)
    except AnalysisException:  # nothing published yet
        return spark.createDataFrame([], f"{_ROW}, version int")
    newest = F.max_by(F.struct(*rows.columns), "version").alias("r")
    return rows.groupBy("disease").agg(newest).select("r.*")


def current(spark: SparkSession, path: str, contracts: Mapping[str, TableContract]) -> tuple[dict[str, Served], dict[str, int]]:
    """What is served now, and each disease's version (0: never published). A saved pipeline that cannot be read is no model."""
    served, versions = {name: Served(c) for name, c in contracts.items()}, dict.fromkeys(contracts, 0)
    for r in latest(spark, path).collect():  # a row per disease
        if r.disease in contracts:
            model = load_model(r.model_path) if r.model_path and artifact_present(spark, r.model_path) else None
            served[r.disease] = Served(contracts[r.disease], r.weights, r.intercept, {**r.filled, **r.filled_levels}, model, r.calibrated)
            versions[r.disease] = r.version
    return served, versions


def model_info(spark: SparkSession, path: str, contracts: Mapping[str, TableContract]) -> DataFrame:
    """(disease, version, model, threshold, feature_count, class_mapping, status): a row per contract, ready or unavailable."""
    served, versions = current(spark, path, contracts)
    rows = [
        (n, versions[n], c.model_name, float(c.threshold), len(c.rules), {str(k): v for k, v in c.labels.items()}, "ready" if served[n].ready else "unavailable")
        for n, c in sorted(contracts.items())
    ]
    return spark.createDataFrame(rows, "disease string, version int, model string, threshold double, feature_count int, class_mapping map<string,string>, status string")


def answer_stream(
    requests: DataFrame, body: str, registry: str, contracts: Mapping[str, TableContract], out: str, checkpoint: str, keep: Sequence[str] = (),
) -> StreamingQuery:
    """Answer a stream until it is drained, each micro-batch wholly by the models that are current when it starts.

    Answers carry ``model_version``, of their disease. A batch lies below its own id, so one that is repeated after a failure replaces its
    output: then by the models current at that time, all rows alike.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        served, versions = current(batch.sparkSession, registry, contracts)
        by_disease = F.create_map(*[F.lit(x) for pair in sorted(versions.items()) for x in pair])
        answers = answer(batch, body, served, keep).withColumn("model_version", F.try_element_at(by_disease, F.col("disease")))
        answers.write.mode("overwrite").parquet(f"{out.rstrip('/')}/batch={batch_id}")

    return requests.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
