"""Scores, risk tiers and responses."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, functions as F

from vitalsieve.contracts import TableContract
from vitalsieve.functions.columns import col, decode
from vitalsieve.operators.models import positive_score
from vitalsieve.operators.validation import redacted, status_class, validate_requests

# Tier limits and texts.

LOW_RISK, MODERATE_RISK, SIGNAL = 0.30, 0.60, 0.50
HIGHER, LOWER = "Higher predicted risk", "Lower predicted risk"
SERVICE_DOWN = "An internal error occurred in the disease prediction service."


def linear_probability(terms: Mapping[str, float], intercept: float) -> Column:
    """Logistic score of named columns as one arithmetic expression."""
    margin = F.lit(float(intercept))
    for name, weight in terms.items():
        margin = margin + F.lit(float(weight)) * col(name).cast("double")
    return 1.0 / (1.0 + F.exp(-margin))


def dot_probability(values: Column, weights: Column, intercept: float) -> Column:
    """Logistic score of an array column against an array of weights."""
    margin = F.aggregate(F.zip_with(values, weights, lambda x, w: x * w), F.lit(float(intercept)), lambda s, x: s + x)
    return 1.0 / (1.0 + F.exp(-margin))


def risk_tier(probability: Column) -> Column:
    """low, moderate, high; unknown without a probability."""
    return (
        F.when(probability.isNull(), "unknown").when(probability < LOW_RISK, "low").when(probability < MODERATE_RISK, "moderate").otherwise("high")
    )


def screening_signal(probability: Column) -> Column:
    """Two tiers at one half."""
    return F.when(probability >= SIGNAL, "elevated_screening_signal").otherwise("lower_screening_signal")


def screening_columns(probability: Column, contract: TableContract) -> dict[str, Column]:
    """Prediction, label, rounded probability and percentage, interpretation."""
    prediction = (probability > contract.threshold).cast("int")
    return {
        "prediction": prediction,
        "prediction_label": decode(prediction, contract.labels, "Unknown"),
        "probability": F.round(probability, 4),
        "risk_percentage": F.round(probability * 100.0, 2),
        "model": F.lit(contract.model_name),
        "threshold": F.lit(contract.threshold),
        "screening_interpretation": F.when(prediction == 1, HIGHER).otherwise(LOWER),
    }


def score_table(df: DataFrame, model: PipelineModel, keep: Sequence[str] = (), features: Sequence[str] = ()) -> DataFrame:
    """Score rows that already follow the contract: (keep..., prediction, probability, risk_category)."""
    missing = [f for f in features if f not in df.columns]
    if missing:
        raise ValueError(f"Missing required features: {missing}")
    out = model.transform(df)
    p = positive_score(out)
    return out.select(
        *[col(k) for k in keep], F.col("prediction").cast("int").alias("prediction"), p.alias("probability"), risk_tier(p).alias("risk_category")
    )


@dataclass(frozen=True)
class Scorer:
    """A disease, its contract, and either a fitted pipeline or the weights of a logistic model."""

    contract: TableContract
    model: PipelineModel | None = None
    weights: Mapping[str, float] | None = None
    intercept: float = 0.0


RESPONSE = (
    "status", "disease", "mode", "prediction", "prediction_label", "probability", "risk_percentage", "model", "threshold",
    "screening_interpretation", "error_type", "message", "status_class",
)


def respond(df: DataFrame, body: str, scorers: Mapping[str, Scorer], keep: Sequence[str] = ()) -> DataFrame:
    """Answer every request: one response shape for scored, rejected and unavailable ones.

    Logistic weights are scored in the same pass as the validation. A fitted pipeline is applied to the valid requests
    of its disease, one more pass for each.
    """
    checked = validate_requests(df, body, {name: s.contract for name, s in scorers.items()})
    valid = F.col("clean").isNotNull()
    p = F.lit(None).cast("double")
    for name, s in scorers.items():
        if s.weights is not None:
            p = F.when(valid & (F.col("disease") == name), _weighted(s)).otherwise(p)
    checked = checked.select(*[col(k) for k in keep], "status", "disease", "mode", "error_type", "message", "clean", p.alias("_p"))
    fitted = {name: s for name, s in scorers.items() if s.weights is None and s.model is not None}
    if fitted:
        elsewhere = F.coalesce(~(valid & F.col("disease").isin(*fitted)), F.lit(True))
        parts = [checked.filter(elsewhere)]
        for name, s in fitted.items():
            mine = checked.filter(valid & (F.col("disease") == name))
            moved = s.model.transform(mine.withColumns({r.name: F.col("clean")[r.name] for r in s.contract.rules}))
            parts.append(moved.withColumn("_p", positive_score(moved)).select(*[col(c) for c in checked.columns]))
        checked = reduce(DataFrame.unionByName, parts)
    return _responses(checked, scorers, keep)


def _weighted(s: Scorer) -> Column:
    margin = F.lit(float(s.intercept))
    for name, weight in s.weights.items():
        margin = margin + F.lit(float(weight)) * F.col("clean")[name]
    return 1.0 / (1.0 + F.exp(-margin))


def _responses(checked: DataFrame, scorers: Mapping[str, Scorer], keep: Sequence[str]) -> DataFrame:
    down = (F.col("status") == "success") & F.col("_p").isNull()
    out = checked.withColumns({
        "status": F.when(down, "error").otherwise(F.col("status")),
        "error_type": F.when(down, "service_error").otherwise(F.col("error_type")),
        "message": redacted(F.when(down, SERVICE_DOWN).otherwise(F.col("message"))),
    })
    names = ("prediction", "prediction_label", "probability", "risk_percentage", "model", "threshold", "screening_interpretation")
    made = {n: F.lit(None) for n in names}
    for name, s in scorers.items():
        mine = F.col("_p").isNotNull() & (F.col("disease") == name)
        for n, value in screening_columns(F.col("_p"), s.contract).items():
            made[n] = F.when(mine, value).otherwise(made[n])
    return (
        out.withColumns(made)
        .withColumn("status_class", status_class(F.col("status"), F.col("error_type")))
        .select(*[col(k) for k in keep], *RESPONSE)
    )


def outcome_counts(responses: DataFrame) -> DataFrame:
    """(status_class, error_type, n) of a batch of responses."""
    return responses.groupBy("status_class", "error_type").agg(F.count(F.lit(1)).alias("n"))
