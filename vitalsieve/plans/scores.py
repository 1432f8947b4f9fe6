"""Held-out scores as a table on shared storage: one part per (model, fold), committed once, skipped when a run starts again."""

from __future__ import annotations

import hashlib
import json
from threading import Lock

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from vitalsieve.functions.columns import col


def row_version(df: DataFrame) -> str:
    """A text that changes when any row of ``df`` does, whatever their order: row count and summed hashes, in one pass."""
    hashes = [F.sum(F.xxhash64(F.lit(seed), *[col(c) for c in df.columns]).cast("decimal(38,0)")) for seed in (1, 2)]
    return "-".join(str(x) for x in df.agg(F.count(F.lit(1)), *hashes).first())


class ScoreTable:
    """Scores below ``path``, written part by part.

    A part is written first and entered in the ledger after; a part without an entry is written over when its turn comes again. Parts of another
    ``version`` (other rows, other settings) are never read. The driver keeps names of parts, no models and no rows.
    """

    def __init__(self, spark: SparkSession, path: str, version: str):
        self.spark, self.path, self.version, self._one = spark, path.rstrip("/"), version, Lock()

    def _part(self, model: str, fold: int) -> str:
        name = hashlib.sha256(json.dumps([self.version, model, fold]).encode()).hexdigest()[:32]
        return f"{self.path}/parts/{name}"

    def committed(self) -> set[tuple[str, int]]:
        """The (model, fold) pairs whose scores are there; as many as candidates times folds at most."""
        try:
            ledger = self.spark.read.schema("version string, model string, fold int").parquet(f"{self.path}/ledger")
        except AnalysisException:  # nothing entered yet
            return set()
        return {(r.model, r.fold) for r in ledger.filter(F.col("version") == self.version).select("model", "fold").distinct().collect()}

    def commit(self, rows: DataFrame, model: str, fold: int) -> None:
        """Write the scores of one model on one fold, then enter them. Entries are made one at a time, so that none loses another's file."""
        rows.withColumns({"model": F.lit(model), "fold": F.lit(fold)}).write.mode("overwrite").parquet(self._part(model, fold))
        with self._one:
            entry = self.spark.range(1).select(F.lit(self.version).alias("version"), F.lit(model).alias("model"), F.lit(fold).alias("fold"))
            entry.write.mode("append").parquet(f"{self.path}/ledger")

    def scores(self) -> DataFrame:
        """All committed scores of this version."""
        parts = [self._part(m, f) for m, f in sorted(self.committed())]
        if not parts:
            raise ValueError(f"no scores of this version below {self.path}")
        return self.spark.read.parquet(*parts)
