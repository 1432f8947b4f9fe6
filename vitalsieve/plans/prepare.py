"""From a raw table to split rows with a fitted preparation."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from vitalsieve.contracts import TableContract
from vitalsieve.operators.cleaning import check_cleaned, clean
from vitalsieve.operators.features import TablePrep, TablePrepModel
from vitalsieve.operators.splits import (
    conflict_allocation, group_holdout, require_both_classes, require_clean_features, require_no_leakage, split_report, stratified_holdout,
)
from vitalsieve.operators.dedup import duplicate_summary, with_group_id
from vitalsieve.session import checkpointed


@dataclass(frozen=True)
class Prepared:
    rows: DataFrame
    prep: TablePrepModel
    report: DataFrame
    duplicates: DataFrame
    conflicts: DataFrame

    @property
    def train(self) -> DataFrame:
        return self.rows.filter(F.col("split") == "train")

    @property
    def test(self) -> DataFrame:
        return self.rows.filter(F.col("split") == "test")


def prepare(
    raw: DataFrame, contract: TableContract, group: str | None = None, group_duplicates: bool = False, test_size: float = 0.2,
    seed: int = 42, method: str = "select", engineer: Callable[[DataFrame], DataFrame] = lambda d: d,
) -> Prepared:
    """Clean, split without leaking, fit the preparation on the training rows, report.

    ``engineer`` may derive columns from the cleaned table; by default it changes nothing.

    ``group`` keeps the rows of a group together; ``group_duplicates`` does so for rows with equal features. The split
    rows are checkpointed once, as every later fit reads them.
    """
    rows = engineer(clean(raw, contract))
    group = group or contract.group
    if not contract.nulls_allowed:
        check_cleaned(rows, contract)
    if group_duplicates:
        rows, group = with_group_id(rows, contract.features), "group_id"
    if group:
        rows = group_holdout(rows, group, "label", 1, test_size, seed)
    else:
        rows = stratified_holdout(rows, [contract.row_id], "label", test_size, seed)
    rows = checkpointed(rows)
    require_clean_features(contract.features, contract.target, [c for c in (contract.row_id, group) if c])
    require_both_classes(rows, "split", "label")
    require_no_leakage(rows, "split", group, contract.row_id)
    prep = TablePrep.for_contract(contract, method).fit(rows.filter(F.col("split") == "train"))
    return Prepared(
        rows, prep, split_report(rows, "split", "label", group), duplicate_summary(rows, contract.features, contract.row_id, "label"),
        conflict_allocation(rows, contract.features, "label", "split"),
    )
