"""Cleaning operators and the contract-driven whole-table cleaner."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from vitalsieve.contracts import TableContract
from vitalsieve.functions.columns import (
    col, drop_present, nan_to_null, normalise_headers, quoted, recode, strip_headers, subject_id, tall, tokens_to_null,
    trim_strings, zeros_to_null,
)
from vitalsieve.operators.dedup import drop_duplicate_rows


class ContractError(ValueError):
    """A table or its values break the contract."""


def check_table(df: DataFrame, contract: TableContract) -> DataFrame:
    """Target present, its classes allowed, no missing target, every expected column present. One aggregate."""
    missing = [c for c in contract.columns if c not in df.columns]
    if contract.target not in df.columns:
        raise ContractError(f"Target column '{contract.target}' not found. Available columns: {df.columns}")
    if missing:
        raise ContractError(f"Missing expected columns: {missing}")
    allowed = [str(k).strip().upper() for k in contract.target_codes]
    seen = df.agg(
        F.count_if(col(contract.target).isNull()).alias("nulls"),
        F.count_if(~F.upper(F.trim(col(contract.target).cast("string"))).isin(*allowed)).alias("bad"),
        F.min(F.when(~F.upper(F.trim(col(contract.target).cast("string"))).isin(*allowed), col(contract.target).cast("string"))).alias("example"),
    ).first()
    if seen["nulls"]:
        raise ContractError(f"Found {seen['nulls']} missing values in target column '{contract.target}'.")
    if seen["bad"]:
        raise ContractError(f"Unexpected target classes in '{contract.target}': {seen['example']!r}. Expected a subset of {allowed}.")
    return df


def domain_violations(df: DataFrame, domains: Mapping[str, Sequence[object]]) -> DataFrame:
    """Values outside the allowed set, per column, in one pass: (feature, violations)."""
    return _one_pass(df, {c: F.count_if(~col(c).isin(*allowed)) for c, allowed in domains.items()}, "violations")


def range_violations(df: DataFrame, ranges: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Values outside the open-closed range (low, high], per column."""
    return _one_pass(
        df, {c: F.count_if((col(c) <= low) | (col(c) > high)) for c, (low, high) in ranges.items()}, "violations"
    )


def unreadable_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Texts that are present but no number, per column."""
    return _one_pass(
        df, {c: F.count_if(col(c).isNotNull() & col(c).cast("string").try_cast("double").isNull()) for c in columns}, "unreadable"
    )


def value_defects(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Nulls, NaN, infinities and blank texts of every column in one pass: (feature, nulls, nans, infinities, blanks)."""
    names = list(columns or df.columns)
    kinds = {f.name: f.dataType for f in df.schema.fields}
    aggs, rows = [], []
    for i, c in enumerate(names):
        value, kind = col(c), kinds[c]
        floating = isinstance(kind, (T.DoubleType, T.FloatType))
        zero = F.lit(0).cast("long")
        parts = {
            "nulls": F.count_if(value.isNull()),
            "nans": F.count_if(F.isnan(value)) if floating else zero,
            "infinities": F.count_if(F.abs(value) == float("inf")) if floating else zero,
            "blanks": F.count_if(F.trim(value) == "") if isinstance(kind, T.StringType) else zero,
        }
        aggs += [agg.alias(f"{k}_{i}") for k, agg in parts.items()]
        rows.append(F.struct(F.lit(c).alias("feature"), *[F.col(f"{k}_{i}").alias(k) for k in parts]))
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def zero_conversions(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """How many zeros of each column would become missing, and how many zeros the table holds: (feature, converted)."""
    return _one_pass(df, {c: F.count_if(col(c) == 0) for c in columns}, "converted")


def require_zeros(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fail when a column whose zeros are real values holds none."""
    if not columns:
        return df
    counts = df.agg(*[F.count_if(col(c) == 0).alias(f"z{i}") for i, c in enumerate(columns)]).first()
    for i, c in enumerate(columns):
        if not counts[f"z{i}"]:
            raise ContractError(f"Valid zeros in {c} were removed.")
    return df


def checked_number(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Cast text columns to double; the first column with unreadable text is an error that names it."""
    for row in unreadable_numbers(df, columns).filter("unreadable > 0").orderBy("feature").collect():
        raise ContractError(f"Non-numeric values encountered in '{row.feature}' column: {row.unreadable} rows")
    return df.withColumns({c: col(c).cast("double") for c in columns})


def check_cleaned(df: DataFrame, contract: TableContract) -> DataFrame:
    """Structure and values of a cleaned table: names, order, no defects, labels 0/1, flags 0/1."""
    features = [c for c in df.columns if c not in (contract.row_id, contract.group, "label")]
    if contract.target in features:
        raise ContractError(f"Target column '{contract.target}' accidentally included in predictors.")
    if len(features) != len(contract.features):
        raise ContractError(f"Expected exactly {len(contract.features)} features, but found {len(features)}.")
    if features != list(contract.features):
        raise ContractError(f"Predictor column names/order mismatch. Expected: {list(contract.features)} Found: {features}")
    kinds = ["nulls"] if contract.nulls_allowed is False else []
    wrong = F.greatest(*[F.col(k) for k in [*kinds, "nans", "infinities", "blanks"]]) > 0
    bad = value_defects(df, [*contract.features, "label"]).filter(wrong).orderBy("feature").first()
    if bad is not None:
        raise ContractError(f"Predictor column '{bad.feature}' contains missing, infinite or blank values.")
    domains = {c: (0, 1) for c in contract.flags} | {"label": (0, 1)}
    off = domain_violations(df, domains).filter("violations > 0").orderBy("feature").first()
    if off is not None:
        raise ContractError(f"Column '{off.feature}' has invalid values. Expected strictly a subset of {{0, 1}}.")
    return df


def clean(df: DataFrame, contract: TableContract, report: bool = False):
    """Apply a contract to a raw table: headers, text, null tokens, duplicates, codes, types, zeros, label.

    The result holds the row id, the features in contract order and ``label``. Lazy, apart from the subject-id rule and the check
    that columns with real zeros still hold some. With ``report`` also returns an audit of what was there before duplicates went and
    after unknown targets did.
    """
    raw = strip_headers(df)
    if contract.normalise:
        raw = normalise_headers(raw)
    out = trim_strings(nan_to_null(raw))
    if contract.null_tokens:
        out = tokens_to_null(out, contract.null_tokens)
    before = out
    if contract.drop_duplicates:
        content = [c for c in out.columns if c != contract.row_id or contract.row_id_is_data]
        out = drop_duplicate_rows(out, content, contract.row_id)
    if contract.keep_only_known_targets:
        lenient = col(contract.target).cast("string").try_cast("double")
        out = out.filter(lenient.isin(*[float(k) for k in contract.target_codes]))
    if contract.group_from:
        out = subject_id(out, contract.group_from, contract.group)
    out = zeros_to_null(out, contract.zero_means_missing)
    after = out
    out = require_zeros(out, [c for c in contract.valid_zero if c != contract.target])
    for name, codes in contract.codes.items():
        out = out.withColumn(name, recode(col(name), codes, what=f"value in '{name}'"))
    out = out.withColumn("label", recode(col(contract.target), contract.target_codes, what=f"target in '{contract.target}'").cast("int"))
    out = out.withColumns({c: col(c).cast(t) for c, t in contract.types.items() if c in out.columns})
    keys = [k for k in (contract.row_id, contract.group) if k and k in out.columns]
    out = drop_present(out, contract.dropped).select(*map(quoted, keys), *map(quoted, contract.features), "label")
    if not report:
        return out
    return out, cleaning_audit(before, after, contract)


def cleaning_audit(before: DataFrame, after: DataFrame, contract: TableContract) -> DataFrame:
    """Before and after cleaning, per column: rows, missing and zeros (full outer join on the column name)."""
    content = [c for c in before.columns if c != contract.row_id]

    def side(df: DataFrame, tag: str) -> DataFrame:
        names = [c for c in content if c in df.columns]
        return tall(df, names, as_type="string").groupBy("feature").agg(
            F.count(F.lit(1)).alias(f"rows_{tag}"),
            F.count_if(F.col("value").isNull()).alias(f"missing_{tag}"),
            F.count_if(F.col("value").try_cast("double") == 0).alias(f"zeros_{tag}"),
        )

    joined = side(before, "before").join(side(after, "after"), "feature", "full_outer")
    return joined.withColumn("preserved_pct", F.round(F.try_divide(F.col("rows_after") * 100.0, F.col("rows_before")), 2))


def _one_pass(df: DataFrame, aggs: Mapping[str, Column], out: str) -> DataFrame:
    names = list(aggs)
    wide = df.agg(*[aggs[c].alias(f"a{i}") for i, c in enumerate(names)])
    rows = [F.struct(F.lit(c).alias("feature"), F.col(f"a{i}").alias(out)) for i, c in enumerate(names)]
    return wide.select(F.inline(F.array(*rows)))
