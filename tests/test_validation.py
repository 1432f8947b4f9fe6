import json

import pytest
from pyspark.sql import functions as F

from vitalsieve.contracts import BREAST, BREAST_FEATURES, LUNG, SURVEY_FLAGS
from vitalsieve.operators import validation as v
from vitalsieve.operators.scoring import Scorer, outcome_counts, respond

LUNG_RECORD = {
    "gender": "MALE", "age": 69, "smoking": 0, "yellow_fingers": 1, "anxiety": 1, "peer_pressure": 0, "chronic_disease": 0,
    "fatigue": 1, "allergy": 0, "wheezing": 1, "alcohol_consuming": 1, "coughing": 1, "shortness_of_breath": 1,
    "swallowing_difficulty": 1, "chest_pain": 1,
}
BREAST_RECORD = {f: 0.5 + i for i, f in enumerate(BREAST_FEATURES)}
CONTRACTS = {"lung_cancer": LUNG, "breast_cancer": BREAST}


def body(disease="lung_cancer", data=None, **more):
    return json.dumps({"disease": disease, "data": LUNG_RECORD if data is None else data, **more})


def check(spark, bodies):
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "i int, body string")
    rows = v.validate_requests(df, "body", CONTRACTS).orderBy("i").collect()
    assert len(rows) == len(bodies)
    return rows


def lung(**changes):
    return {**LUNG_RECORD, **changes}


LUNG_CASES = [
    (lung(), None),
    (lung(gender=" male "), None),
    (lung(gender="1"), None),
    (lung(gender=1.0), None),
    (lung(age="69"), None),
    (lung(age=0.5), None),
    (lung(age=120), None),
    (lung(smoking="YES", anxiety=" no ", coughing="1"), None),
    (lung(smoking=1.0), None),
    (lung(gender=None), "Feature 'gender' cannot be None."),
    (lung(gender=True), "Invalid value for gender: True. Boolean values are not accepted."),
    (lung(gender="OTHER"), "Invalid value for gender: 'OTHER'. Expected 'MALE' or 'FEMALE'."),
    (lung(gender=5), "Invalid numeric value for gender: 5. Expected 0 (FEMALE) or 1 (MALE)."),
    (lung(gender=[1]), "Invalid value for gender: [1]. Expected 'MALE' or 'FEMALE'."),
    (lung(age=None), "Feature 'age' cannot be None."),
    (lung(age=False), "Invalid value for age: False. Boolean values are not accepted."),
    (lung(age="old"), "Invalid non-numeric value for age: 'old'."),
    (lung(age="12d"), "Invalid non-numeric value for age: '12d'."),
    (lung(age="nan"), "Feature 'age' cannot be NaN."),
    (lung(age="-inf"), "Feature 'age' cannot be infinite."),
    (lung(age=0), "Age must be positive (greater than 0). Received: 0"),
    (lung(age=-10), "Age must be positive (greater than 0). Received: -10"),
    (lung(age=150), "Age exceeds realistic human limit (120). Received: 150"),
    (lung(smoking=2), "Invalid value for smoking: 2. Expected 0, 1, YES, or NO."),
    (lung(smoking="1.0"), "Invalid value for smoking: '1.0'. Expected 0, 1, YES, or NO."),
    (lung(smoking="MAYBE"), "Invalid value for smoking: 'MAYBE'. Expected 0, 1, YES, or NO."),
    (lung(chest_pain=True), "Invalid value for chest_pain: True. Boolean values (True/False) are not accepted. Expected 0, 1, YES, or NO."),
    (lung(chest_pain=None, coughing=None), "Feature 'coughing' cannot be None."),
    ({k: x for k, x in LUNG_RECORD.items() if k not in ("age", "smoking")}, "Missing required feature: age"),
    (lung(weight=70, height=1) | {"gender": None}, "Unexpected feature encountered: weight"),
]


def test_lung_fields(spark):
    rows = check(spark, [body(data=d) for d, _ in LUNG_CASES])
    assert [r.message for r in rows] == [m for _, m in LUNG_CASES]
    assert all((r.error_type == "validation_error") == (r.message is not None) for r in rows)
    assert rows[0].clean["gender"] == 1.0 and rows[0].clean["age"] == 69.0 and len(rows[0].clean) == 15
    assert rows[7].clean["smoking"] == 1.0 and rows[7].clean["anxiety"] == 0.0


def test_all_failures_are_listed(spark):
    row = check(spark, [body(data=lung(smoking=3, chest_pain="x"))])[0]
    assert [e.feature for e in row.errors] == ["smoking", "chest_pain"]


def test_breast_fields(spark):
    def breast(**changes):
        return {**BREAST_RECORD, **changes}

    grouped = {
        "mean_features": {f: BREAST_RECORD[f] for f in BREAST_FEATURES[:10]},
        "se_features": [{"name": f, "value": BREAST_RECORD[f]} for f in BREAST_FEATURES[10:20]],
        "worst_features": {f: 0.0 for f in BREAST_FEATURES[20:]},
        **{f: BREAST_RECORD[f] for f in BREAST_FEATURES[20:]},
    }
    cases = [
        (breast(), None), (breast(radius_mean=True), None), (breast(radius_mean="12.5"), None), (grouped, None),
        (breast(radius_mean=None), "Feature 'radius_mean' cannot be None."),
        (breast(radius_mean="abc"), "Invalid non-numeric value for feature 'radius_mean': abc"),
        (breast(**{"concave points_mean": "inf"}), "Feature 'concave points_mean' cannot be infinite."),
        (breast(extra=1), "Unexpected feature encountered: extra"),
    ]
    rows = check(spark, [body("breast_cancer", d) for d, _ in cases])
    assert [r.message for r in rows] == [m for _, m in cases]
    assert rows[1].clean["radius_mean"] == 1.0
    assert rows[3].clean == rows[0].clean


ENVELOPES = [
    ("", "invalid_request", "Request body cannot be empty."),
    ("   ", "invalid_request", "Request body cannot be empty."),
    (None, "invalid_request", "Request body cannot be empty."),
    ("{bad", "invalid_request", "Malformed JSON in request body."),
    (body() + " tail", "invalid_request", "Malformed JSON in request body."),
    (body() + "," + body(), "invalid_request", "Malformed JSON in request body."),
    ("[]", "invalid_request", "Request body must contain a valid JSON object."),
    ("5", "invalid_request", "Request body must contain a valid JSON object."),
    ('"x"', "invalid_request", "Request body must contain a valid JSON object."),
    ("null", "invalid_request", "Request body must contain a valid JSON object."),
    ('{"disease": "a", "disease": "b"}', "validation_error", "Duplicate JSON field: disease"),
    ('{"disease": "lung_cancer", "data": {"age": 1, "age": 2}}', "validation_error", "Duplicate JSON field: age"),
    ("{}", "validation_error", "Missing required field 'disease'."),
    ('{"disease": "lung_cancer"}', "validation_error", "Missing required field 'data'."),
    (body(None), "validation_error", "Field 'disease' is required and cannot be null."),
    (body("  "), "validation_error", "Invalid disease identifier: '  '. Must be a non-empty string."),
    (body(7), "validation_error", "Invalid disease identifier: '7'. Must be a non-empty string."),
    (body("flu"), "validation_error", "Unsupported disease 'flu'. Supported diseases: ['breast_cancer', 'lung_cancer']."),
    ('{"disease": "lung_cancer", "data": null}', "validation_error", "Field 'data' is required and cannot be null."),
    (body(data=[1]), "validation_error", "Field 'data' must be a valid JSON object. Received list."),
    (body(data="x"), "validation_error", "Field 'data' must be a valid JSON object. Received str."),
    (body(data=3), "validation_error", "Field 'data' must be a valid JSON object. Received int."),
    (body(data={}), "validation_error", "Field 'data' cannot be an empty object."),
    (body(mode="expert"), "validation_error", "Invalid mode 'expert'. Supported modes: ['user', 'clinical']."),
    (body(mode=5), None, None),
    (body(" Lung_Cancer ", mode=" Clinical"), None, None),
]


def test_envelopes(spark):
    rows = check(spark, [b for b, _, _ in ENVELOPES])
    assert [(r.error_type, r.message) for r in rows] == [(t, m) for _, t, m in ENVELOPES]
    assert rows[-2].mode == "user" and (rows[-1].mode, rows[-1].disease) == ("clinical", "lung_cancer")


def test_bare_nan_tokens(spark):
    text = body(data=lung(age="#")).replace('"#"', "NaN")
    assert check(spark, [text])[0].status == "error"


def test_key_order_and_mode_do_not_matter(spark):
    scorer = {"lung_cancer": Scorer(LUNG, weights={f: 0.1 for f in LUNG.features}, intercept=-3.0)}
    turned = dict(reversed(list(LUNG_RECORD.items())))
    df = spark.createDataFrame([(body(),), (body(data=turned),), (body(mode="clinical"),)], "body string")
    rows = respond(df, "body", scorer).collect()
    assert len({(r.prediction, r.probability, r.risk_percentage) for r in rows}) == 1
    assert rows[0].status_class == 200 and rows[0].screening_interpretation == "Higher predicted risk"


def test_missing_model_is_unavailable(spark):
    df = spark.createDataFrame([(body(),), ("{bad",)], "body string")
    rows = {r.status_class: r for r in respond(df, "body", {"lung_cancer": Scorer(LUNG)}).collect()}
    assert rows[503].error_type == "service_error" and "internal error" in rows[503].message
    assert rows[400].error_type == "invalid_request"
    assert outcome_counts(respond(df, "body", {"lung_cancer": Scorer(LUNG)})).count() == 2


def test_typed_rows(spark):
    kinds = "gender string, age double, " + ", ".join(f"{c} int" for c in SURVEY_FLAGS)
    good, bad = ["FEMALE", 50.0] + [1] * 13, ["FEMALE", 50.0] + [1] * 12 + [None]
    df = spark.createDataFrame([tuple(good), tuple(bad)], kinds)
    rows = v.validate_fields(v.typed_request(df, LUNG.features), "data", LUNG).collect()
    assert [r.message for r in rows] == [None, "Feature 'chest_pain' cannot be None."]
    short = v.validate_fields(v.typed_request(df.drop("age"), LUNG.features), "data", LUNG).first()
    assert short.message == "Missing required feature: age"


def test_redaction(spark):
    df = spark.createDataFrame([(r"cannot read C:\data\x.bin now",), ("no /srv/models file",), ("plain",)], "m string")
    got = [r[0] for r in df.select(v.redacted(F.col("m"))).collect()]
    assert got == ["cannot read [redacted_path] now", "no [redacted_path] file", "plain"]


def test_strict_mode_raises(spark):
    df = spark.createDataFrame([(body(data=lung(age=-1)),)], "body string")
    with pytest.raises(Exception, match="Age must be positive"):
        v.strict(v.validate_requests(df, "body", CONTRACTS)).collect()


def test_status_classes(spark):
    df = spark.createDataFrame([("success", None), ("error", "validation_error"), ("error", "artifact_error"), ("error", "internal_error")], "s string, e string")
    assert [r[0] for r in df.select(v.status_class(F.col("s"), F.col("e"))).collect()] == [200, 400, 503, 500]
