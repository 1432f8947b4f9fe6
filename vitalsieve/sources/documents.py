"""JSON documents: schemas, class maps, split manifests, run records and reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from vitalsieve.functions.columns import col

# Document schemas.

MANIFEST_SCHEMA = (
    "random_state int, test_size double, split_strategy string, total_rows int, train_rows int, test_rows int, "
    "train_indices_raw_csv_0_indexed array<int>, test_indices_raw_csv_0_indexed array<int>, "
    "train_class_distribution map<string,int>, test_class_distribution map<string,int>, "
    "duplicate_group_handling struct<total_groups int, train_groups int, test_groups int, overlapping_groups int, "
    "conflicting_rows_indices array<int>, conflicting_rows_assigned_to string>"
)
LIST_SCHEMA = "disease string, target string, target_mapping map<string,string>, features array<struct<name string, dtype string>>"
PROPERTY_SCHEMA = "disease string, required array<string>, properties map<string, struct<type: string>>"


def read_document(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.option("multiLine", True).option("mode", "FAILFAST")
    return (reader.schema(schema) if schema else reader).json(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Frozen split as a table (row_id, split). A missing file is an error."""
    doc = read_document(spark, path, MANIFEST_SCHEMA)
    parts = F.array(
        F.struct(F.lit("train").alias("split"), F.col("train_indices_raw_csv_0_indexed").alias("ids")),
        F.struct(F.lit("test").alias("split"), F.col("test_indices_raw_csv_0_indexed").alias("ids")),
    )
    return doc.select(F.inline(parts)).select(F.explode(F.col("ids").cast("array<bigint>")).alias("row_id"), "split")


def read_request_schema(spark: SparkSession, path: str, form: str = "list") -> DataFrame:
    """(name, dtype, required) from either form of request schema."""
    if form == "list":
        doc = read_document(spark, path, LIST_SCHEMA)
        return doc.select(F.inline("features")).withColumn("required", F.lit(True))
    doc = read_document(spark, path, PROPERTY_SCHEMA)
    entries = doc.select("required", F.explode("properties").alias("name", "spec"))
    return entries.select("name", F.col("spec.type").alias("dtype"), F.array_contains("required", F.col("name")).alias("required"))


def read_class_map(spark: SparkSession, path: str) -> DataFrame:
    """(code, label) from a document whose keys are class codes."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.explode(F.from_json("value", "map<string,string>")).alias("code", "label"))


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def schema_document(df: DataFrame, disease: str, target: str, labels: Mapping[object, str]) -> DataFrame:
    """One-row request schema document of the feature columns of ``df``."""
    features = F.array(*[
        F.struct(F.lit(n).alias("name"), F.lit(t).alias("dtype")) for n, t in df.dtypes if n not in (target, "label", "row_id")
    ])
    mapping = F.create_map(*[x for k, v in labels.items() for x in (F.lit(str(k)), F.lit(v))])
    return df.sparkSession.range(1).select(
        F.lit(disease).alias("disease"), F.lit(target).alias("target"), mapping.alias("target_mapping"), features.alias("features")
    )


def run_record(
    spark: SparkSession, model: str, params: Mapping[str, object], features: Sequence[str], metrics: Mapping[str, float],
    counts: Mapping[str, int], notes: Mapping[str, str] | None = None,
) -> DataFrame:
    """One-row run record with the current time, to be appended to a runs table."""
    def as_map(items: Mapping[str, object], kind: str):
        if not items:
            return F.create_map().cast(f"map<string,{kind}>")
        return F.create_map(*[x for k, v in items.items() for x in (F.lit(k), F.lit(v).cast(kind))])

    return spark.range(1).select(
        F.lit(model).alias("model"),
        as_map({k: str(v) for k, v in params.items()}, "string").alias("params"),
        F.array(*[F.lit(f) for f in features]).alias("features"),
        as_map(metrics, "double").alias("metrics"),
        as_map(counts, "long").alias("counts"),
        as_map(notes or {}, "string").alias("notes"),
        F.current_timestamp().alias("run_at"),
    )


def append_run(record: DataFrame, path: str) -> None:
    record.write.mode("append").parquet(path)


def comparison_rows(summary: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """(model, line): ``| model | mean ± std | ...`` to four decimals."""
    cells = [F.format_string("%.4f ± %.4f", col(f"{m}_mean"), col(f"{m}_std")) for m in metrics]
    return summary.select("model", F.concat(F.lit("| "), F.concat_ws(" | ", "model", *cells), F.lit(" |")).alias("line"))
