"""Requests of all seven tables in one batch: what is refused, what is filled, what is missing, and how each is answered."""

import json

import pytest
from pyspark.sql import functions as F

from vitalsieve import contracts as C
from vitalsieve.operators import models, validation
from vitalsieve.operators.features import TablePrep
from vitalsieve.operators.routing import Served, answer, registry

SEVEN = (C.HEART, C.DIABETES, C.STROKE, C.ASTHMA, C.PARKINSONS, C.BREAST, C.LUNG)
SERVED = {c.name: Served(c, weights={r.name: 0.01 for r in c.rules if not r.text}) for c in SEVEN}


def payload(contract):
    return {r.name: "A" if r.text else 1 for r in contract.rules}


def ask(spark, served, *requests):
    rows = [(i, r if isinstance(r, str) else json.dumps(r)) for i, r in enumerate(requests)]
    df = spark.createDataFrame(rows, "_entry int, body string")
    return sorted(answer(df, "body", served, ["_entry"]).collect(), key=lambda r: r["_entry"])


def request(contract, **changes):
    return {"disease": contract.name, "data": {**payload(contract), **changes}}


def test_every_table_is_served(spark):
    for r, c in zip(ask(spark, SERVED, *[request(c) for c in SEVEN]), SEVEN, strict=True):
        assert (r.status, r.disease, r.status_class) == ("success", c.name, 200)
        assert r.probability is not None and r.prediction_label in c.labels.values()
        assert (r.risk_category is None) == (c.tiers is None)


def test_both_modes_agree(spark):
    user, clinical = ask(spark, SERVED, {**request(C.ASTHMA), "mode": "user"}, {**request(C.ASTHMA), "mode": "clinical"})
    assert (user.prediction, user.probability) == (clinical.prediction, clinical.probability) and clinical["mode"] == "clinical"


@pytest.mark.parametrize("contract,field", [(C.HEART, "Age"), (C.DIABETES, "BMI"), (C.STROKE, "bmi"), (C.ASTHMA, "Age"), (C.PARKINSONS, "PPE")])
def test_text_is_no_number(spark, contract, field):
    (r,) = ask(spark, SERVED, request(contract, **{field: "not_a_number"}))
    assert (r.status_class, r.message) == (400, f"Invalid non-numeric value for feature '{field}': not_a_number")


def test_missing_fields_are_told_together_or_one_by_one(spark):
    heart, breast = payload(C.HEART), payload(C.BREAST)
    del heart["Thallium"], heart["Sex"], breast["area_se"], breast["radius_mean"]
    a, b = ask(spark, SERVED, {"disease": "heart", "data": heart}, {"disease": "breast_cancer", "data": breast})
    assert a.message == "Missing required features: ['Sex', 'Thallium']"
    assert b.message == "Missing required feature: radius_mean"


def test_strangers_are_ignored_or_refused(spark):
    a, b = ask(spark, SERVED, request(C.HEART, zz=1), request(C.BREAST, zz=1, aa=2))
    assert a.status == "success" and b.message == "Unexpected feature encountered: zz"


def test_nulls_and_nans_are_filled_where_the_contract_allows(spark):
    served = {"heart": Served(C.HEART, {"Age": 1.0, "Sex=B": 2.0}, -3.0, {"Age": 1, "Sex": "B"}), "breast_cancer": SERVED["breast_cancer"]}
    a, b, c, d = ask(spark, served, request(C.HEART, Age=None, Sex=None), request(C.HEART, Age="NaN", Sex="B"), request(C.HEART, Age=2, Sex="other"), request(C.BREAST, area_se=None))
    assert a.probability == b.probability == 0.5
    assert c.probability == round(1 / (1 + 2.718281828459045), 4)
    assert d.message == "Feature 'area_se' cannot be None."


def test_levels_read_the_same_as_number_or_text(spark):
    served = {"heart": Served(C.HEART, {"Sex=1": 1.0})}
    found = {r.probability for r in ask(spark, served, *[request(C.HEART, Sex=v) for v in (1, 1.0, "1")])}
    assert found == {0.7311}
    (r,) = ask(spark, served, request(C.HEART, Sex=[1]))
    assert r.status_class == 400


def test_no_model_is_503_before_or_behind_the_fields(spark):
    served = {"heart": Served(C.HEART), "breast_cancer": Served(C.BREAST)}
    a, b, c = ask(spark, served, {"disease": "heart", "data": {"x": 1}}, {"disease": "breast_cancer", "data": {"x": 1}}, request(C.BREAST))
    assert [(r.status_class, r.error_type) for r in (a, b, c)] == [(503, "service_error"), (400, "validation_error"), (503, "service_error")]
    assert a.message == "An internal error occurred in the disease prediction service."


def test_a_score_that_is_no_number_fails_its_row_alone(spark):
    served = {**SERVED, "heart": Served(C.HEART, {"Age": float("nan")})}
    a, b = ask(spark, served, request(C.HEART), request(C.STROKE))
    assert (a.status, a.status_class, a.error_type, a.prediction) == ("error", 500, "internal_error", None)
    assert a.message == "An internal server error occurred." and b.status == "success"


def test_without_probability_the_risk_is_unknown(spark):
    (r,) = ask(spark, {"stroke": Served(C.STROKE, {"age": 1.0}, calibrated=False)}, request(C.STROKE))
    assert (r.prediction, r.probability, r.risk_category) == (1, None, "unknown")


def test_groups_need_no_session_setting(spark):
    before = spark.conf.get("spark.sql.mapKeyDedupPolicy")
    spark.conf.set("spark.sql.mapKeyDedupPolicy", "EXCEPTION")
    try:
        flat = payload(C.BREAST)
        names = list(flat)
        grouped = {
            "mean_features": {n: 1 for n in names[:10]}, "se_features": [3, {"name": "area_se"}, {"value": 1}, {"name": names[10], "value": 50}, *[{"name": n, "value": 1} for n in names[10:20]]],
            "worst_features": {n: 1 for n in names[20:]}, names[0]: 1.0,
        }
        a, b, c = ask(spark, SERVED, {"disease": "breast_cancer", "data": flat}, {"disease": "breast_cancer", "data": grouped}, {"disease": "breast_cancer", "data": {**grouped, "mean_features": 7}})
        assert a.probability == b.probability and b.status == "success"
        assert c.message == f"Missing required feature: {names[1]}"
    finally:
        spark.conf.set("spark.sql.mapKeyDedupPolicy", before)


def test_fitted_pipeline_gets_numbers_and_levels(spark):
    rows = [(float(i), "A" if i % 2 else "B", i % 2) for i in range(40)] + [(None, None, 1)]
    table = spark.createDataFrame(rows, "Age double, Gender string, label int")
    contract = C.TableContract("small", "y", {0: 0, 1: 1}, rules=(C.FieldRule("Age", nullable=True), C.FieldRule("Gender", text=True, nullable=True)), refuses_extra=False)
    model = models.pipeline(TablePrep([("Age", "scale"), ("Gender", "levels")]), models.logistic()).fit(table)
    served = {"small": Served(contract, model=model), "heart": SERVED["heart"]}
    a, b, c, d = ask(spark, served, {"disease": "small", "data": {"Age": 3, "Gender": "A"}}, {"disease": "small", "data": {"Age": None, "Gender": "B"}}, {"disease": "small", "data": {"Age": 3, "Gender": "new"}}, request(C.HEART))
    assert [r.status for r in (a, b, c, d)] == ["success"] * 4 and (a.prediction, b.prediction) == (1, 0)


def test_strict_raises(spark):
    df = spark.createDataFrame([(0, json.dumps(request(C.HEART, Age="x")))], "i int, body string")
    with pytest.raises(Exception, match="Invalid non-numeric value"):
        validation.strict(answer(df, "body", SERVED, ["i"])).collect()


def test_contract_without_rules(spark):
    with pytest.raises(ValueError, match="without request rules"):
        registry(spark, {"liver": Served(C.LIVER)})


def test_no_requests(spark):
    assert answer(spark.createDataFrame([], "body string"), "body", SERVED).count() == 0
    (r,) = ask(spark, SERVED, "")
    assert r.message == "Request body cannot be empty." and r.status_class == 400
    assert answer(spark.createDataFrame([(None,)], "body string"), "body", SERVED).select(F.col("status_class")).first()[0] == 400
