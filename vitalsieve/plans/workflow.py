"""The whole run of one table: prepare, train, evaluate once, and write every artifact."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from vitalsieve.contracts import TableContract
from vitalsieve.operators.metrics import METRICS
from vitalsieve.operators.models import Family
from vitalsieve.operators.profile import column_profile
from vitalsieve.plans.prepare import Prepared, prepare
from vitalsieve.plans.train import Trained, train_best
from vitalsieve.sources import artifacts, documents, tables


@dataclass(frozen=True)
class Run:
    prepared: Prepared
    trained: Trained
    record: DataFrame


def run_table(
    raw: DataFrame, contract: TableContract, families: Mapping[str, Family], out: str | None = None, k: int = 5, seed: int = 42,
    metric: str = "roc_auc", staged: int | None = None, group_duplicates: bool = False, method: str = "select",
) -> Run:
    """Prepare and train a table. With ``out``, write model, split, statistics, comparison, evaluation, profile and run record."""
    spark = raw.sparkSession
    prepared = prepare(raw, contract, group_duplicates=group_duplicates, seed=seed, method=method)
    group = "group_id" if group_duplicates else None
    trained = train_best(prepared.train, prepared.test, contract, families, k, seed, metric, staged, method=method, group=group)
    test = trained.test_metrics.first().asDict()
    counts = {f"{r.split}_rows": r.n for r in prepared.report.collect()}
    record = documents.run_record(
        spark, trained.name, trained.params, contract.features, {m: test[m] for m in METRICS if test[m] is not None},
        {**counts, **{c: test[c] for c in ("tn", "fp", "fn", "tp")}}, {"table": contract.name, "seed": str(seed), "selection": metric},
    )
    if out:
        artifacts.save_model(trained.model, f"{out}/model")
        tables.write_table(prepared.rows.select(contract.row_id, "split"), f"{out}/split")
        tables.write_table(prepared.report, f"{out}/split_report", "csv")
        tables.write_table(prepared.prep.statistics(spark), f"{out}/statistics", "csv")
        tables.write_table(trained.comparison, f"{out}/comparison", "csv")
        tables.write_table(column_profile(prepared.rows, [*contract.features, "label"], "label", method), f"{out}/profile", "csv")
        documents.write_json(trained.test_metrics.withColumn("model", F.lit(trained.name)), f"{out}/evaluation")
        documents.write_json(documents.schema_document(prepared.rows.select(*[f"`{c}`" for c in contract.features]), contract.name, contract.target, contract.labels), f"{out}/schema")
        documents.append_run(record, f"{out}/runs")
    return Run(prepared, trained, record)
