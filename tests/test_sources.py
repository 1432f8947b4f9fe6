import json

import pytest
from pyspark.sql import functions as F

from vitalsieve.contracts import LIVER
from vitalsieve.operators import cleaning, profile
from vitalsieve.sources import artifacts, documents, tables


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.5, "a"), (2, None, None)], "i int, x double, s string")
    tables.write_table(df, str(tmp_path / "t"), "csv")
    again = tables.read_table(spark, str(tmp_path / "t"), "csv", "i int, x double, s string")
    assert sorted(map(tuple, again.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)


def test_nan_is_missing_after_reading(spark, tmp_path):
    spark.createDataFrame([(float("nan"),), (1.0,)], "x double").write.parquet(str(tmp_path / "p"))
    assert tables.read_table(spark, str(tmp_path / "p")).filter("x is null").count() == 1


def test_contract_table(spark, tmp_path):
    head = [*LIVER.numeric, "Gender", "Dataset"]
    df = spark.createDataFrame([tuple([1.0] * 9 + ["Male", 1])], ", ".join(f"{c} {'string' if c == 'Gender' else 'int' if c == 'Dataset' else 'double'}" for c in head))
    tables.write_table(df, str(tmp_path / "liver"))
    assert tables.read_contract_table(spark, str(tmp_path / "liver"), LIVER).count() == 1
    tables.write_table(df.drop("Albumin"), str(tmp_path / "short"))
    with pytest.raises(cleaning.ContractError, match="Albumin"):
        tables.read_contract_table(spark, str(tmp_path / "short"), LIVER)


def test_absent_table(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        tables.read_table(spark, str(tmp_path / "nothing"))


def test_row_ids_depend_on_content_only(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "i int, s string")
    ids = sorted(r.row_id for r in tables.with_row_id(df).collect())
    assert len(set(ids)) == 3 and ids == sorted(r.row_id for r in tables.with_row_id(df.repartition(5)).collect())


def test_fingerprints(spark, tmp_path):
    df = spark.range(100).select("id", F.when(F.col("id") > 5, F.col("id").cast("string")).alias("s"))
    assert tables.fingerprint(df).first() == tables.fingerprint(df.orderBy(F.rand())).first()
    assert tables.fingerprint(df).first() != tables.fingerprint(df.withColumn("s", F.lit("x"))).first()
    (tmp_path / "f.csv").write_bytes(b"a,b\n1,2\n")
    import hashlib

    assert tables.file_fingerprints(spark, str(tmp_path / "f.csv")).first().sha256 == hashlib.sha256(b"a,b\n1,2\n").hexdigest()


def test_manifest(spark, tmp_path):
    doc = {"random_state": 42, "train_indices_raw_csv_0_indexed": [0, 2, 3], "test_indices_raw_csv_0_indexed": [1]}
    (tmp_path / "m.json").write_text(json.dumps(doc, indent=2))
    rows = {r.row_id: r.split for r in documents.read_manifest(spark, str(tmp_path / "m.json")).collect()}
    assert rows == {0: "train", 2: "train", 3: "train", 1: "test"}
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        documents.read_manifest(spark, str(tmp_path / "absent.json")).collect()


def test_schemas_and_class_map(spark, tmp_path):
    (tmp_path / "list.json").write_text(json.dumps({"disease": "d", "features": [{"name": "Age", "dtype": "int64"}]}, indent=1))
    (tmp_path / "prop.json").write_text(json.dumps({"disease": "d", "required": ["Age"], "properties": {"Age": {"type": "integer"}, "BP": {"type": "number"}}}, indent=1))
    (tmp_path / "map.json").write_text(json.dumps({"0": "Benign", "1": "Malignant"}, indent=1))
    assert documents.read_request_schema(spark, str(tmp_path / "list.json")).first().name == "Age"
    rows = {r.name: r.required for r in documents.read_request_schema(spark, str(tmp_path / "prop.json"), "property").collect()}
    assert rows == {"Age": True, "BP": False}
    assert {r.code: r.label for r in documents.read_class_map(spark, str(tmp_path / "map.json")).collect()} == {"0": "Benign", "1": "Malignant"}


def test_documents_written(spark, tmp_path):
    df = spark.createDataFrame([(1, 0.5)], "Age int, x double")
    documents.write_json(documents.schema_document(df, "d", "t", {0: "no", 1: "yes"}), str(tmp_path / "s"))
    doc = spark.read.json(str(tmp_path / "s")).first()
    assert [f.name for f in doc.features] == ["Age", "x"]
    assert {r.name: r.dtype for r in profile.input_schema(df).collect()} == {"Age": "int", "x": "double"}


def test_runs_are_appended(spark, tmp_path):
    for name in ("a", "b"):
        record = documents.run_record(spark, name, {"C": 0.1}, ["age"], {"roc_auc": 0.9}, {"train": 10})
        documents.append_run(record, str(tmp_path / "runs"))
    rows = spark.read.parquet(str(tmp_path / "runs")).collect()
    assert {r.model for r in rows} == {"a", "b"} and rows[0].metrics["roc_auc"] == 0.9 and rows[0].run_at is not None


def test_registry_readiness(spark, tmp_path):
    entry = {"disease": "d", "model": "m", "threshold": 0.5, "features": ["a"], "labels": {0: "n", 1: "p"}, "path": str(tmp_path / "absent")}
    models = artifacts.registry(spark, [entry])
    assert models.first().status == "unavailable" and artifacts.readiness(models).first().status == "unavailable"
    with pytest.raises(artifacts.ArtifactError):
        artifacts.load_model(str(tmp_path / "absent"))
