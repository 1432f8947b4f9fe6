"""Validation of prediction requests as column expressions, the same for batch and stream.

A request body is JSON text ``{"disease": ..., "data": {...}, "mode": ...}``. Field values keep their JSON type, because
``true``, ``"true"`` and ``1`` are judged differently. Rules are checked in contract order; the first failure is the
message, all field failures are listed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from vitalsieve.contracts import BREAST_GROUPS, FieldRule, TableContract
from vitalsieve.functions.columns import bound, col, computed_once
from vitalsieve.functions.json import repeated_key

# Modes, message texts and the error types of each outcome class.

MODES = ("user", "clinical")
UNAVAILABLE_ERRORS = ("service_error", "service_unavailable", "artifact_error")

TEXT = {
    "empty": "Request body cannot be empty.",
    "malformed": "Malformed JSON in request body.",
    "not_object": "Request body must contain a valid JSON object.",
    "duplicate": "Duplicate JSON field: %s",
    "no_disease": "Missing required field 'disease'.",
    "no_data": "Missing required field 'data'.",
    "null_disease": "Field 'disease' is required and cannot be null.",
    "bad_disease": "Invalid disease identifier: '%s'. Must be a non-empty string.",
    "unknown_disease": "Unsupported disease '%s'. Supported diseases: %s.",
    "null_data": "Field 'data' is required and cannot be null.",
    "data_type": "Field 'data' must be a valid JSON object. Received %s.",
    "empty_data": "Field 'data' cannot be an empty object.",
    "bad_mode": "Invalid mode '%s'. Supported modes: ['user', 'clinical'].",
    "extra": "Unexpected feature encountered: %s",
    "missing": "Missing required feature: %s",
    "null": "Feature '{f}' cannot be None.",
    "nan": "Feature '{f}' cannot be NaN.",
    "infinite": "Feature '{f}' cannot be infinite.",
    "plain_text": "Invalid non-numeric value for feature '{f}': %s",
    "age_bool": "Invalid value for {f}: %s. Boolean values are not accepted.",
    "age_text": "Invalid non-numeric value for {f}: '%s'.",
    "age_low": "Age must be positive (greater than 0). Received: %s",
    "age_high": "Age exceeds realistic human limit ({limit}). Received: %s",
    "gender_bool": "Invalid value for {f}: %s. Boolean values are not accepted.",
    "gender_text": "Invalid value for {f}: '%s'. Expected 'MALE' or 'FEMALE'.",
    "gender_number": "Invalid numeric value for {f}: %s. Expected 0 (FEMALE) or 1 (MALE).",
    "gender_other": "Invalid value for {f}: %s. Expected 'MALE' or 'FEMALE'.",
    "flag_bool": "Invalid value for {f}: %s. Boolean values (True/False) are not accepted. Expected 0, 1, YES, or NO.",
    "flag_text": "Invalid value for {f}: '%s'. Expected 0, 1, YES, or NO.",
    "flag_number": "Invalid value for {f}: %s. Expected 0, 1, YES, or NO.",
}

# Text of a number; Java's suffixes and hexadecimal forms are not numbers here.
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_SPECIAL = r"(?i)^[+-]?(nan|inf|infinity)$"


def _kind(value: Column) -> Column:
    """VOID, BOOLEAN, STRING, OBJECT, ARRAY, BIGINT or another number type; NULL for an absent field."""
    return F.substring_index(F.substring_index(F.schema_of_variant(value), "<", 1), "(", 1)


def _viewed(value: Column) -> Column:
    return F.struct(_kind(value).alias("kind"), value.cast("string").alias("text"))


def _parsed(text: Column) -> Column:
    trimmed = F.trim(text)
    special = F.when(F.lower(trimmed).contains("nan"), float("nan")).when(trimmed.startswith("-"), float("-inf")).otherwise(float("inf"))
    return F.when(trimmed.rlike(_NUMBER), trimmed.try_cast("double")).when(trimmed.rlike(_SPECIAL), special)


class _Rules:
    """The rules as literal arrays, one per property, so that one lambda judges every field by its position."""

    def __init__(self, rules: Sequence[FieldRule]):
        def texts(key) -> Column:
            filled = []
            for r in rules:
                style = r.style if r.style in ("age", "gender", "flag") else "plain"
                text = TEXT.get(key(style))
                filled.append(F.lit(None if text is None else text.replace("{f}", r.name).replace("{limit}", str(int(r.at_most or 0)))))
            return F.array(*filled).cast("array<string>")

        def codes(r: FieldRule) -> Column:
            pairs = [F.lit(x) for k, v in (r.codes or {}).items() for x in (str(k).upper(), float(v))]
            return F.create_map(*pairs).cast("map<string,double>")

        def values(r: FieldRule) -> Column:
            return F.array(*[F.lit(v) for v in sorted({float(v) for v in (r.codes or {}).values()})]).cast("array<double>")

        lits = lambda items, kind: F.array(*[F.lit(x) for x in items]).cast(f"array<{kind}>")
        self.columns = {
            "feature": lits([r.name for r in rules], "string"),
            "coded": lits([r.codes is not None for r in rules], "boolean"),
            "allow_boolean": lits([r.allow_boolean for r in rules], "boolean"),
            "tells_nan": lits([r.style != "gender" for r in rules], "boolean"),
            "codes": F.array(*[codes(r) for r in rules]),
            "values": F.array(*[values(r) for r in rules]),
            "above": lits([r.above for r in rules], "double"),
            "at_most": lits([r.at_most for r in rules], "double"),
            "t_null": texts(lambda s: "null"), "t_bool": texts(lambda s: f"{s}_bool"), "t_text": texts(lambda s: f"{s}_text"),
            "t_number": texts(lambda s: f"{s}_number"), "t_other": texts(lambda s: "gender_other" if s == "gender" else f"{s}_number"),
            "t_nan": texts(lambda s: "nan"), "t_infinite": texts(lambda s: "infinite"),
            "t_low": texts(lambda s: "age_low"), "t_high": texts(lambda s: "age_high"),
        }

    def at(self, i: Column) -> dict[str, Column]:
        return {n: F.get(c, i) for n, c in self.columns.items()}


def plain_numbers(data: Column, rules: Sequence[FieldRule]) -> Column:
    """Numbers of a request whose fields are all of the usual valid forms; an element is NULL where a closer look is due."""
    table = _Rules(rules)

    def number(text: Column, i: Column) -> Column:
        rule = table.at(i)
        value = F.when(rule["coded"], rule["codes"][F.upper(F.trim(text))]).otherwise(_parsed(text))
        fine = (F.abs(value) < float("inf")) & F.coalesce(value > rule["above"], F.lit(True)) & F.coalesce(value <= rule["at_most"], F.lit(True))
        return F.when(fine, value)

    return F.transform(F.array(*[F.try_element_at(data, F.lit(r.name)).cast("string") for r in rules]), number)


def judged_fields(data: Column, rules: Sequence[FieldRule]) -> Column:
    """(feature, message, number) of every field of a map<string,variant>, in contract order."""
    table = _Rules(rules)

    def seen(view: Column, i: Column) -> Column:
        rule, kind, text = table.at(i), view["kind"], view["text"]
        number = (
            F.when(kind == "BOOLEAN", F.when(text == "true", 1.0).otherwise(0.0))
            .when(rule["coded"] & (kind == "STRING"), rule["codes"][F.upper(F.trim(text))])
            .when(rule["coded"], F.when(F.array_contains(rule["values"], _parsed(text)), _parsed(text)))
            .when(~kind.isin("OBJECT", "ARRAY"), _parsed(text))
        )
        shown = F.when(kind == "BOOLEAN", F.initcap(text)).otherwise(text)
        return F.struct(kind.alias("kind"), shown.alias("text"), number.alias("number"))

    def verdict(f: Column, i: Column) -> Column:
        rule, kind, text, number = table.at(i), f["kind"], f["text"], f["number"]
        nan = F.coalesce(F.isnan(number), F.lit(False)) | (rule["coded"] & (text == "NaN"))
        endless = (F.abs(number) == float("inf")) | (rule["coded"] & text.isin("Infinity", "-Infinity"))

        def say(key: str) -> Column:
            return F.replace(rule[key], F.lit("%s"), text)

        message = (
            F.when(kind == "VOID", rule["t_null"])
            .when((kind == "BOOLEAN") & ~rule["allow_boolean"], say("t_bool"))
            .when(nan & rule["tells_nan"], rule["t_nan"])
            .when(endless & rule["tells_nan"], rule["t_infinite"])
            .when(number.isNull() & (~rule["coded"] | (kind == "STRING")), say("t_text"))
            .when(number.isNull() & kind.isin("OBJECT", "ARRAY"), say("t_other"))
            .when(number.isNull(), say("t_number"))
            .when(number <= rule["above"], say("t_low"))
            .when(number > rule["at_most"], say("t_high"))
        )
        return F.struct(rule["feature"].alias("feature"), message.alias("message"), number.alias("number"))

    views = F.array(*[_viewed(F.try_element_at(data, F.lit(r.name))) for r in rules])
    return F.transform(F.transform(views, seen), verdict)


def completeness_error(data: Column, rules: Sequence[FieldRule], sent: Column | None = None) -> Column:
    """Unexpected fields first, then missing fields in contract order.

    Parsed objects list their fields by name; ``sent`` gives the names in request order, for the first unexpected one.
    """
    expected = F.array(*[F.lit(r.name) for r in rules])
    extras = F.array_except(F.map_keys(data), expected)
    extra = F.get(extras, F.lit(0))
    if sent is not None:
        extra = F.when(F.size(extras) > 1, F.coalesce(F.get(F.array_intersect(sent, extras), F.lit(0)), extra)).otherwise(extra)
    missing = F.get(F.array_except(expected, F.map_keys(data)), F.lit(0))
    return F.coalesce(F.concat(F.lit(TEXT["extra"].replace("%s", "")), extra), F.concat(F.lit(TEXT["missing"].replace("%s", "")), missing))


def _with_verdict(
    df: DataFrame, payloads: Sequence[tuple[Column, Column, TableContract]], sent: Column | None = None
) -> DataFrame:
    """Judge each request once, by the contract whose condition holds; add ``message``, ``errors``, ``clean``, ``status``.

    Requests whose fields are all plainly valid, the usual case, are recognised from their texts. Only the others are
    taken apart by type to word their messages.
    """
    names, data = F.lit(None).cast("array<string>"), F.lit(None).cast("map<string,variant>")
    for when, payload, contract in payloads:
        data = F.when(when, payload).otherwise(data)
        names = F.when(when, F.array(*[F.lit(r.name) for r in contract.rules])).otherwise(names)
    held = computed_once(df, _data=data, _names=names)
    request = F.col("_data")

    shape, plain = F.lit(None).cast("string"), F.lit(None).cast("array<double>")
    for when, _, contract in payloads:
        shape = F.when(when, completeness_error(request, contract.rules, sent)).otherwise(shape)
        plain = F.when(when, plain_numbers(request, contract.rules)).otherwise(plain)
    held = computed_once(held, _shape=F.when(request.isNotNull(), shape), _plain=F.when(request.isNotNull(), plain))
    doubtful = F.col("_shape").isNull() & F.exists("_plain", lambda x: x.isNull())
    fields = F.lit(None).cast("array<struct<feature:string,message:string,number:double>>")
    for when, _, contract in payloads:
        fields = F.when(when & doubtful, judged_fields(request, contract.rules)).otherwise(fields)
    held = computed_once(held, _fields=fields)

    broken = F.transform(
        F.filter("_fields", lambda x: x["message"].isNotNull()), lambda x: F.struct(x["feature"].alias("feature"), x["message"].alias("message"))
    )
    complete = request.isNotNull() & F.col("_shape").isNull()
    none = F.array().cast("array<struct<feature:string,message:string>>")
    held = computed_once(held, errors=F.when(complete, F.coalesce(broken, none)))
    held = computed_once(held, message=F.coalesce("message", "_shape", F.get("errors", F.lit(0))["message"]))
    fine = F.col("message").isNull()
    numbers = F.coalesce(F.transform("_fields", lambda x: x["number"]), F.col("_plain"))
    return (
        held.withColumn("clean", F.when(fine, F.map_from_arrays("_names", numbers)))
        .withColumn("status", F.when(fine, "success").otherwise("error"))
        .drop("_data", "_names", "_shape", "_plain", "_fields")
    )


def validate_fields(df: DataFrame, data: str, contract: TableContract) -> DataFrame:
    """Add ``message`` (NULL if valid), ``errors``, ``clean`` (map of numbers), ``status`` for a map<string,variant> column."""
    return _with_verdict(df.withColumn("message", F.lit(None).cast("string")), [(F.lit(True), col(data), contract)])


def grouped_payload(data: Column, groups: Sequence[str]) -> Column:
    """Flatten groups of fields, given as objects or as lists of {name, value}, with loose fields; later ones win.

    Items of a list that are no objects with both a name and a value are passed over, as are groups of any other kind.
    """
    entry = "array<struct<key: string, value: variant>>"
    parts = []
    for g in groups:
        group = F.try_element_at(data, F.lit(g))
        named = F.map_entries(F.try_variant_get(group, "$", "map<string,variant>"))
        listed = F.transform(
            F.try_variant_get(group, "$", "array<variant>"),
            lambda x: F.struct(F.try_variant_get(x, "$.name", "string").alias("key"), F.try_variant_get(x, "$.value", "variant").alias("value")),
        )
        listed = F.filter(listed, lambda x: x["key"].isNotNull() & x["value"].isNotNull())
        parts.append(F.coalesce(named, listed, F.array().cast(entry)))
    loose = F.map_entries(F.map_filter(data, lambda k, _: ~k.isin(*groups)))

    def flattened(entries: Column) -> Column:
        keys = F.transform(entries, lambda x: x["key"])
        seen = F.struct(keys.alias("all"), F.array_distinct(keys).alias("names"), F.reverse(keys).alias("back"))

        def by_name(k: Column) -> Column:
            last = F.transform(k["names"], lambda n: F.get(entries, (F.size(k["all"]) - F.array_position(k["back"], n)).cast("int"))["value"])
            return F.when(F.size(k["names"]) == F.size(k["all"]), F.map_from_entries(entries)).otherwise(F.map_from_arrays(k["names"], last))

        return bound(seen, by_name)

    has_groups = F.arrays_overlap(F.map_keys(data), F.array(*[F.lit(g) for g in groups]))
    return F.when(has_groups, bound(F.concat(*parts, loose), flattened)).otherwise(data)


def envelope(df: DataFrame, body: str, diseases: Sequence[str]) -> DataFrame:
    """Check request bodies. Adds ``disease``, ``mode``, ``data``, ``error_type`` and ``message`` (NULL when well-formed)."""
    text = col(body)
    parsed = F.from_json(text, "map<string,variant>")
    listed = "[" + ", ".join(f"'{d}'" for d in sorted(diseases)) + "]"
    known = F.array(*[F.lit(d) for d in diseases])
    read = computed_once(df, _top=parsed)
    top_data = F.try_element_at("_top", F.lit("data"))
    read = computed_once(
        read,
        _keys=F.coalesce(F.map_keys("_top"), F.json_object_keys(text)),
        _single=F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))).eqNullSafe(F.lit(1)),
        _disease=_viewed(F.try_element_at("_top", F.lit("disease"))),
        _entries=F.try_variant_get(top_data, "$", "map<string,variant>"),
        _mode=_viewed(F.try_element_at("_top", F.lit("mode"))),
    )
    disease, mode = F.col("_disease"), F.col("_mode")
    read = computed_once(
        read,
        _dup=F.when(F.col("_top").isNull() | (F.size(F.array_distinct("_keys")) < F.size("_keys")), F.when(F.col("_keys").isNotNull(), repeated_key(text))),
        _folded=F.lower(F.trim(disease["text"])),
        _kind=F.when(F.col("_entries").isNotNull(), "OBJECT").otherwise(_kind(top_data)),
        _chosen=F.when(mode["kind"] == "STRING", F.lower(F.trim(mode["text"]))).otherwise(F.lit("user")),
    )
    kind = F.col("_kind")
    is_json = F.try_parse_json(text).isNotNull()
    type_name = (
        F.when(kind == "STRING", "str").when(kind == "ARRAY", "list").when(kind == "BOOLEAN", "bool").when(kind == "BIGINT", "int").otherwise("float")
    )
    shown = F.when(disease["kind"] == "BOOLEAN", F.initcap(disease["text"])).otherwise(disease["text"])
    keys, dup, request, field = F.col("_keys"), F.col("_dup"), "invalid_request", "validation_error"

    def said(key: str, *values: Column) -> Column:
        return F.format_string(TEXT[key], *values) if values else F.lit(TEXT[key])

    checks = [
        (F.coalesce(F.trim(text), F.lit("")) == "", request, said("empty")),
        (keys.isNull() & (is_json | F.json_array_length(text).isNotNull()), request, said("not_object")),
        (keys.isNull() | (~F.col("_single") & is_json), request, said("malformed")),
        (dup.isNotNull(), field, said("duplicate", dup)),
        (F.col("_top").isNull(), field, said("duplicate", F.lit("(nested)"))),
        (~F.array_contains(keys, "disease"), field, said("no_disease")),
        (~F.array_contains(keys, "data"), field, said("no_data")),
        (disease["kind"] == "VOID", field, said("null_disease")),
        ((disease["kind"] != "STRING") | (F.col("_folded") == ""), field, said("bad_disease", shown)),
        (~F.array_contains(known, F.col("_folded")), field, said("unknown_disease", disease["text"], F.lit(listed))),
        (kind == "VOID", field, said("null_data")),
        (kind != "OBJECT", field, said("data_type", type_name)),
        (F.size("_entries") == 0, field, said("empty_data")),
        (~F.col("_chosen").isin(*MODES), field, said("bad_mode", mode["text"])),
    ]
    fault = F.lit(None).cast("struct<type:string,message:string>")
    for failed, error, message in reversed(checks):
        fault = F.when(failed, F.struct(F.lit(error).alias("type"), message.alias("message"))).otherwise(fault)
    judged = computed_once(read, _fault=fault)
    fine = F.col("_fault").isNull()
    temps = ["_top", "_keys", "_single", "_disease", "_mode", "_dup", "_folded", "_entries", "_kind", "_chosen", "_fault"]
    return judged.withColumns({
        "error_type": F.col("_fault")["type"],
        "message": F.col("_fault")["message"],
        "disease": F.when(F.array_contains(known, F.col("_folded")), F.col("_folded")),
        "mode": F.when(fine, F.col("_chosen")),
        "data": F.when(fine, F.col("_entries")),
    }).drop(*temps)


def validate_requests(df: DataFrame, body: str, contracts: Mapping[str, TableContract]) -> DataFrame:
    """Envelope and field validation for several diseases. Adds disease, mode, status, error_type, message, errors, clean."""
    out = envelope(df, body, list(contracts))
    payloads = []
    for name, contract in contracts.items():
        payload = grouped_payload(F.col("data"), list(BREAST_GROUPS)) if contract.grouped_requests else F.col("data")
        payloads.append((F.col("disease") == name, payload, contract))
    sent = F.json_object_keys(F.get_json_object(col(body), "$.data"))
    final = _with_verdict(out, payloads, sent).drop("data")
    return final.withColumn("error_type", F.when(F.col("message").isNotNull(), F.coalesce("error_type", F.lit("validation_error"))))


def typed_request(df: DataFrame, fields: Sequence[str], out: str = "data") -> DataFrame:
    """Request map from the columns of a table, each value with its own type. An absent column is an absent field."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    present = [c for c in fields if c in kinds]

    def value(name: str) -> Column:
        as_json = F.to_json(F.struct(col(name).alias("v")), {"ignoreNullFields": "false"})
        return F.from_json(as_json, "struct<v: variant>")["v"]

    return df.withColumn(out, F.map_from_arrays(F.array(*[F.lit(c) for c in present]), F.array(*[value(c) for c in present])))


def redacted(message: Column) -> Column:
    """Replace file paths of any depth in a message: what follows a drive letter, or two and more parts behind slashes."""
    return F.regexp_replace(message, r"\b[A-Za-z]:[\\/]\S+|(?:/[\w.-]+){2,}", "[redacted_path]")


def status_class(status: Column, error_type: Column) -> Column:
    """Outcome class 200, 400, 503 or 500."""
    return (
        F.when(status == "success", 200)
        .when(error_type.isin(*UNAVAILABLE_ERRORS), 503)
        .when(error_type == "internal_error", 500)
        .otherwise(400)
    )


def quarantine(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted and rejected rows."""
    return df.filter(F.col("status") == "success"), df.filter(F.col("status") != "success")


def strict(df: DataFrame) -> DataFrame:
    """Fail on the first rejected row instead of setting it aside."""
    passes = F.when(F.col("status") == "success", True).otherwise(F.raise_error(F.col("message")).cast("boolean"))
    return df.filter(passes)
