"""Table sources and sinks, contracts at read time, fingerprints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from vitalsieve.contracts import TableContract
from vitalsieve.functions.columns import col, nan_to_null, normalise_headers, quoted, row_hash, strip_headers
from vitalsieve.operators.cleaning import check_table


def read_table(spark: SparkSession, path: str, format: str = "parquet", schema: StructType | str | None = None, **options) -> DataFrame:
    """Read a table; NaN becomes NULL. CSV has a header; give a schema, as inferring one reads the file twice."""
    reader = spark.read.format(format)
    if format == "csv":
        options = {"header": True, "inferSchema": schema is None, **options}
    if schema is not None:
        reader = reader.schema(schema)
    return nan_to_null(reader.options(**options).load(path))


def read_contract_table(spark: SparkSession, path: str, contract: TableContract, format: str = "parquet", **options) -> DataFrame:
    """Read a table and check it against its contract before anything uses it."""
    raw = strip_headers(read_table(spark, path, format, **options))
    check_table(normalise_headers(raw) if contract.normalise else raw, contract)
    return raw


def write_table(df: DataFrame, path: str, format: str = "parquet", partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Write without an index. CSV has a header."""
    writer = df.write.mode(mode).format(format)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if format == "csv":
        writer = writer.option("header", True)
    writer.save(path)


def with_row_id(df: DataFrame, out: str = "row_id", chunk: int = 1_000_000) -> DataFrame:
    """Row id from content for tables without a key: hash of the row and a number among its equals.

    It depends on values only, never on partitioning. Equal rows are counted, not collected, and written out again in
    chunks of bounded size, so a row repeated very often spreads over many tasks.
    """
    names = df.columns
    n, start = F.col("_n"), F.col("_c") * chunk
    return (
        df.groupBy(*map(quoted, names)).agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_h", row_hash(df, names))
        .withColumn("_c", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / chunk))))
        .repartition("_h", "_c")
        .withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), F.least(n - start, F.lit(chunk)))))
        .withColumn(out, F.concat_ws("-", "_h", (start + F.col("_i")).cast("string")))
        .select(*map(quoted, names), quoted(out))
    )


def fingerprint(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row (n_rows, checksum, xor): equal for equal content in any row order. One pass, sums of 56-bit hash parts.

    Values are hashed with their lengths and a mark for NULL, so text cannot imitate a boundary or a missing value. The checksum is a decimal,
    which cannot overflow.
    """
    names = list(columns or df.columns)
    value = [col(c).cast("string") for c in names]
    text = F.concat_ws("|", *[F.coalesce(F.concat(F.length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in value])
    head = F.conv(F.substring(F.md5(text), 1, 14), 16, 10).cast("long")
    return df.select(head.alias("h")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("h").cast("decimal(20,0)")).cast("decimal(38,0)").alias("checksum"), F.bit_xor("h").alias("xor")
    )


def file_fingerprints(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, sha256) of the files under a path, hashed where they are read."""
    return spark.read.format("binaryFile").load(path).select("path", "length", F.sha2("content", 256).alias("sha256"))
