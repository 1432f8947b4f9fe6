"""Requests of any number of diseases judged and scored in one pass: contracts, rules and weights are rows of a registry.

The registry has one row a disease, joined to the requests by a broadcast. Every rule is data, so one expression judges every
contract; a new disease is a new row and no new plan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vitalsieve.contracts import BREAST_GROUPS, FieldRule, TableContract
from vitalsieve.functions.columns import col, computed_once
from vitalsieve.operators.models import positive_score
from vitalsieve.operators.scoring import HIGHER, LOWER, RESPONSE, SERVICE_DOWN, risk_tier, screening_signal
from vitalsieve.operators.validation import TEXT, _kind, _parsed, envelope, grouped_payload, redacted, status_class

_RULE = (
    "struct<feature:string, text:boolean, nullable:boolean, coded:boolean, booleans:boolean, tells_nan:boolean, codes:map<string,double>,"
    " above:double, at_most:double, say:map<string,string>>"
)
_ENTRY = (
    f"disease string, rules array<{_RULE}>, features array<string>, grouped boolean, lists_missing boolean, refuses_extra boolean, model_first boolean, ready boolean,"
    " fitted boolean, calibrated boolean, threshold double, model string, labels map<int,string>, tiers string, intercept double,"
    " weights map<string,double>, filled map<string,double>, filled_levels map<string,string>"
)

# Type and text of an answer that could not be worked out.

INTERNAL, INTERNAL_TEXT = "internal_error", "An internal server error occurred."


@dataclass(frozen=True)
class Served:
    """A disease as it is served: its contract, and a linear model over numbers and levels, or a fitted pipeline, or nothing yet.

    ``weights`` go by feature for numbers and by ``feature=level`` for levels; unknown levels weigh nothing. ``filled`` replaces nulls. Without ``calibrated`` the
    score decides, but there is no probability to tell.
    """

    contract: TableContract
    weights: Mapping[str, float] | None = None
    intercept: float = 0.0
    filled: Mapping[str, float | str] = field(default_factory=dict)
    model: PipelineModel | None = None
    calibrated: bool = True

    @property
    def ready(self) -> bool:
        return self.weights is not None or self.model is not None


def rule_row(r: FieldRule) -> tuple:
    """A rule as a row of the registry, with the texts of what may be wrong."""
    style = r.style if r.style in ("age", "gender", "flag") else "plain"
    keys = {"null": "null", "bool": f"{style}_bool", "text": f"{style}_text", "number": f"{style}_number", "nan": "nan", "infinite": "infinite", "low": "age_low", "high": "age_high"}
    keys["other"] = "gender_other" if style == "gender" else f"{style}_number"
    say = {k: TEXT.get(v, TEXT["plain_text"]).replace("{f}", r.name).replace("{limit}", str(int(r.at_most or 0))) for k, v in keys.items()}
    codes = None if r.codes is None else {str(k).upper(): float(v) for k, v in r.codes.items()}
    return r.name, r.text, r.nullable, r.codes is not None, r.allow_boolean, r.style != "gender", codes, r.above, r.at_most, say


def registry(spark: SparkSession, served: Mapping[str, Served]) -> DataFrame:
    """One row a disease: its rules in contract order, how it is served, and what its responses say. The driver's own table, a row per contract."""
    rows = []
    for name, s in sorted(served.items()):
        c = s.contract
        if not c.rules:
            raise ValueError(f"contract without request rules: {name}")
        texts = {k: v for k, v in s.filled.items() if isinstance(v, str)}
        numbers = {k: float(v) for k, v in s.filled.items() if not isinstance(v, str)}
        rows.append((
            name, [rule_row(r) for r in c.rules], [r.name for r in c.rules], c.grouped_requests, c.lists_missing, c.refuses_extra, c.model_first, s.ready, s.model is not None,
            s.calibrated, float(c.threshold), c.model_name, {int(k): v for k, v in c.labels.items()}, c.tiers, float(s.intercept),
            None if s.weights is None else {k: float(v) for k, v in s.weights.items()}, numbers, texts,
        ))
    return spark.createDataFrame(rows, _ENTRY)


def _level(text: Column) -> Column:
    """Text of a level; whole numbers read the same with and without a decimal point."""
    return F.regexp_replace(text, r"^([+-]?[0-9]+)\.0+$", "$1")


def _fields(data: Column, rules: Column) -> Column:
    """(feature, message, number, level) of every rule's field in ``data``, a map<string,variant>."""
    def seen(rule: Column) -> Column:
        value = F.try_element_at(data, rule["feature"])
        return F.struct(_kind(value).alias("kind"), value.cast("string").alias("text"))

    def read(view: Column, i: Column) -> Column:
        rule, kind, text = F.get(rules, i), view["kind"], view["text"]
        parsed = _parsed(text)
        number = (
            F.when(rule["text"] | kind.isin("OBJECT", "ARRAY", "VOID"), None)
            .when(kind == "BOOLEAN", F.when(text == "true", 1.0).otherwise(0.0))
            .when(rule["coded"] & (kind == "STRING"), F.try_element_at(rule["codes"], F.upper(F.trim(text))))
            .when(rule["coded"], F.when(F.array_contains(F.map_values(rule["codes"]), parsed), parsed))
            .otherwise(parsed)
        )
        shown = F.when(kind == "BOOLEAN", F.initcap(text)).otherwise(text)
        return F.struct(kind.alias("kind"), shown.alias("text"), number.alias("number"))

    def verdict(f: Column, i: Column) -> Column:
        rule, kind, text, number = F.get(rules, i), f["kind"], f["text"], f["number"]
        nan = F.coalesce(F.isnan(number), F.lit(False)) | (rule["coded"] & (text == "NaN"))
        endless = F.coalesce(F.abs(number) == float("inf"), F.lit(False)) | (rule["coded"] & text.isin("Infinity", "-Infinity"))
        nested = kind.isin("OBJECT", "ARRAY")

        def say(key: str) -> Column:
            return F.replace(rule["say"][key], F.lit("%s"), text)

        message = (
            F.when(kind == "VOID", F.when(~rule["nullable"], rule["say"]["null"]))
            .when(rule["text"], F.when(nested, say("text")))
            .when((kind == "BOOLEAN") & ~rule["booleans"], say("bool"))
            .when(nan & rule["tells_nan"], F.when(~rule["nullable"], rule["say"]["nan"]))
            .when(endless & rule["tells_nan"], rule["say"]["infinite"])
            .when(number.isNull() & (~rule["coded"] | (kind == "STRING")), say("text"))
            .when(number.isNull() & nested, say("other"))
            .when(number.isNull(), say("number"))
            .when(number <= rule["above"], say("low"))
            .when(number > rule["at_most"], say("high"))
        )
        level = F.when(rule["text"] & ~nested & (kind != "VOID"), _level(text))
        return F.struct(rule["feature"].alias("feature"), message.alias("message"), F.when(~F.isnan(number), number).alias("number"), level.alias("level"), rule["text"].alias("text"))

    return F.transform(F.transform(F.transform(rules, seen), read), verdict)


def _incomplete(data: Column, rule: Column, sent: Column) -> Column:
    """The first unexpected field as it was sent, where the contract refuses them; then the first missing one, or all of them."""
    extras = F.array_except(F.map_keys(data), rule["features"])
    first = F.when(F.size(extras) > 1, F.coalesce(F.get(F.array_intersect(sent, extras), F.lit(0)), F.get(extras, F.lit(0)))).otherwise(F.get(extras, F.lit(0)))
    missing = F.array_except(rule["features"], F.map_keys(data))
    every = F.concat(F.lit("Missing required features: ['"), F.array_join(missing, "', '"), F.lit("']"))
    one = F.concat(F.lit(TEXT["missing"].replace("%s", "")), F.get(missing, F.lit(0)))
    return (
        F.when(rule["refuses_extra"] & (F.size(extras) > 0), F.concat(F.lit(TEXT["extra"].replace("%s", "")), first))
        .when(F.size(missing) > 0, F.when(rule["lists_missing"], every).otherwise(one))
    )


def judge(df: DataFrame, body: str, entries: DataFrame) -> DataFrame:
    """Envelope and field checks of every request by its disease's row of ``entries``.

    Adds disease, mode, status, error_type, message, errors, ``numbers`` and ``levels`` (of valid requests), and ``_entry``. A disease
    without a model fails with ``service_error``: before its fields are looked at where the contract says so, else only if they are valid.
    """
    names = [r[0] for r in entries.select("disease").collect()]  # one a contract
    packed = entries.select("disease", F.struct(*[c for c in entries.columns if c != "disease"]).alias("_entry"))
    joined = envelope(df, body, names).join(F.broadcast(packed), "disease", "left")
    rule = F.col("_entry")
    payload = F.when(rule["grouped"], grouped_payload(F.col("data"), list(BREAST_GROUPS))).otherwise(F.col("data"))
    held = computed_once(joined, _data=payload, _down=F.col("message").isNull() & ~rule["ready"])
    sent = F.json_object_keys(F.get_json_object(col(body), "$.data"))
    looked = F.col("message").isNull() & ~(F.col("_down") & rule["model_first"])
    held = computed_once(held, _shape=F.when(looked, _incomplete(F.col("_data"), rule, sent)), _looked=looked)
    held = computed_once(held, _fields=F.when(F.col("_looked") & F.col("_shape").isNull(), _fields(F.col("_data"), rule["rules"])))
    errors = F.transform(F.filter("_fields", lambda x: x["message"].isNotNull()), lambda x: F.struct(x["feature"].alias("feature"), x["message"].alias("message")))
    held = computed_once(held, errors=errors)
    fault = F.coalesce("message", "_shape", F.get("errors", F.lit(0))["message"])
    held = computed_once(held, message=F.when(fault.isNull() & F.col("_down"), SERVICE_DOWN).otherwise(fault), _invalid=fault.isNotNull())
    fine = F.col("message").isNull()
    numbers = F.filter("_fields", lambda x: ~x["text"])
    levels = F.filter("_fields", lambda x: x["text"])
    return (
        held.withColumn("numbers", F.when(fine, F.map_from_arrays(F.transform(numbers, lambda x: x["feature"]), F.transform(numbers, lambda x: x["number"]))))
        .withColumn("levels", F.when(fine, F.map_from_arrays(F.transform(levels, lambda x: x["feature"]), F.transform(levels, lambda x: x["level"]))))
        .withColumn("status", F.when(fine, "success").otherwise("error"))
        .withColumn("error_type", F.when(~fine, F.coalesce("error_type", F.when(F.col("_invalid"), "validation_error").otherwise("service_error"))))
        .drop("data", "_data", "_down", "_shape", "_looked", "_fields", "_invalid")
    )


def _margin(rule: Column) -> Column:
    """Weighted sum of numbers and levels, nulls replaced by what the registry fills in; terms without a weight count nothing."""
    zero = F.lit(0.0)
    numbers = F.transform(F.map_entries("numbers"), lambda e: F.coalesce(F.try_element_at(rule["weights"], e["key"]), zero) * F.coalesce(e["value"], F.try_element_at(rule["filled"], e["key"]), zero))
    level = lambda e: F.coalesce(e["value"], F.try_element_at(rule["filled_levels"], e["key"]), F.lit(""))
    levels = F.transform(F.map_entries("levels"), lambda e: F.coalesce(F.try_element_at(rule["weights"], F.concat(e["key"], F.lit("="), level(e))), zero))
    return F.aggregate(F.concat(numbers, levels), rule["intercept"], lambda total, term: total + term)


def answer(df: DataFrame, body: str, served: Mapping[str, Served], keep: Sequence[str] = ()) -> DataFrame:
    """Answer requests of all diseases: (keep..., the response columns, risk_category).

    Linear models are scored in the pass that judges. Fitted pipelines get the valid requests of their disease with numbers and
    levels as columns, one more pass each. A score that is no number is an ``internal_error`` of that row; other rows go on.
    """
    asked = df.select(col(body).alias("_body"), *[col(k).alias(f"_keep{i}") for i, k in enumerate(keep)])
    checked = judge(asked, "_body", registry(df.sparkSession, served))
    rule, valid = F.col("_entry"), F.col("status") == "success"
    margin = F.when(valid & rule["weights"].isNotNull(), _margin(rule))
    checked = checked.withColumn("_p", 1.0 / (1.0 + F.exp(-margin)))
    checked = checked.select(*[f"_keep{i}" for i in range(len(keep))], "status", "disease", "mode", "error_type", "message", "numbers", "levels", "_entry", "_p")
    fitted = {name: s for name, s in served.items() if s.weights is None and s.model is not None}
    if fitted:
        parts = [checked.filter(~F.coalesce(valid & rule["fitted"] & rule["weights"].isNull(), F.lit(False)))]
        for name, s in fitted.items():
            mine = checked.filter(valid & (F.col("disease") == name))
            inputs = {r.name: F.try_element_at("levels" if r.text else "numbers", F.lit(r.name)) for r in s.contract.rules}
            moved = s.model.transform(mine.withColumns(inputs))
            parts.append(moved.withColumn("_p", positive_score(moved)).select(*checked.columns))
        checked = reduce(DataFrame.unionByName, parts)
    return _responses(checked, keep)


def _responses(checked: DataFrame, keep: Sequence[str]) -> DataFrame:
    rule, p = F.col("_entry"), F.col("_p")
    broken = (F.col("status") == "success") & (p.isNull() | F.isnan(p))
    out = checked.withColumns({
        "error_type": F.when(broken, INTERNAL).otherwise(F.col("error_type")),
        "message": redacted(F.when(broken, INTERNAL_TEXT).otherwise(F.col("message"))),
        "status": F.when(broken, "error").otherwise(F.col("status")),
        "_p": F.when(~broken, p),
    })
    prediction = (p > rule["threshold"]).cast("int")
    scored = p.isNotNull()
    told = F.when(rule["calibrated"], p)
    made = {
        "prediction": prediction,
        "prediction_label": F.when(scored, F.coalesce(F.try_element_at(rule["labels"], prediction), F.lit("Unknown"))),
        "probability": F.round(told, 4),
        "risk_percentage": F.round(told * 100.0, 2),
        "model": F.when(scored, rule["model"]),
        "threshold": F.when(scored, rule["threshold"]),
        "screening_interpretation": F.when(prediction == 1, HIGHER).when(scored, LOWER),
        "risk_category": F.when(scored & (rule["tiers"] == "risk"), risk_tier(told)).when(scored & (rule["tiers"] == "signal"), screening_signal(told)),
    }
    out = out.withColumns(made).withColumn("status_class", status_class(F.col("status"), F.col("error_type")))
    return out.select(*[F.col(f"_keep{i}").alias(k) for i, k in enumerate(keep)], *RESPONSE, "risk_category")
