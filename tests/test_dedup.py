"""Duplicates that must not be lost or taken for one another."""

from pyspark.sql import functions as F

from vitalsieve.contracts import DIABETES
from vitalsieve.functions.columns import row_hash
from vitalsieve.operators import dedup
from vitalsieve.operators.cleaning import ContractError, clean


def test_rows_without_id_or_with_repeated_ids_stay(spark):
    rows = [(None, "a"), (None, "a"), (None, "b"), (1, "c"), (1, "d"), (1, "d"), (2, "c"), (None, "c")]
    df = spark.createDataFrame(rows, "row_id int, x string")
    kept = sorted(map(tuple, dedup.drop_duplicate_rows(df, ["x"], "row_id").collect()), key=repr)
    assert kept == sorted([(None, "a"), (None, "b"), (1, "c"), (1, "d")], key=repr)


def test_the_kept_row_is_whole(spark):
    df = spark.createDataFrame([(2, "a", 5), (1, "a", 7), (1, "a", 6)], "row_id int, x string, y int")
    (row,) = dedup.drop_duplicate_rows(df, ["x"], "row_id").collect()
    assert row.row_id == 1 and row.y in (6, 7)
    again = dedup.drop_duplicate_rows(df.orderBy(F.desc("y")).repartition(3), ["x"], "row_id").first()
    assert again == row


def test_hash_tells_values_apart(spark):
    df = spark.createDataFrame(
        [(["a, b"], 0.0, {"k": 1, "l": 2}, (1, None), bytearray(b"\xff")), (["a", "b"], 0.0, {"k": 1, "l": 2}, (1, None), bytearray(b"\xff")),
         ([], 0.0, {"k": 1, "l": 2}, (1, None), bytearray(b"\xff")), (None, 0.0, {"k": 1, "l": 2}, (1, None), bytearray(b"\xff")), ([None], 0.0, {"k": 1, "l": 2}, (1, None), bytearray(b"\xff")),
         (["a, b"], -0.0, {"l": 2, "k": 1}, (1, None), bytearray(b"\xff")), (["a, b"], 0.0, {"k": 1, "l": 2}, None, bytearray(b"\xff")), (["a, b"], 0.0, {"k": 1, "l": 2}, (1, None), bytearray(b"\xfe")),
         (["-"], 0.0, {"k": 1, "l": 2}, (1, None), bytearray(b"\xff")), (["a, b"], float("nan"), {"k": 1, "l": 2}, (1, None), bytearray(b"\xff"))],
        "t array<string>, z double, m map<string,int>, s struct<a:int,b:string>, b binary")
    hashes = [r[0] for r in df.select(row_hash(df, df.columns)).collect()]
    assert hashes[0] == hashes[5] and len(set(hashes)) == len(hashes) - 1


def test_lost_zeros_stop_the_cleaner(spark):
    columns = [*DIABETES.features, "Outcome"]
    row = {c: 3.0 for c in columns} | {"Outcome": 1.0, "row_id": 1}
    df = spark.createDataFrame([tuple(row.values())], list(row))
    try:
        clean(df, DIABETES)
    except ContractError as error:
        assert "Pregnancies" in str(error)
    else:
        raise AssertionError("no error")
    assert clean(df.withColumn("Pregnancies", F.lit(0.0)), DIABETES).count() == 1
