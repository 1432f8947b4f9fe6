"""The registry of versions, and a stream whose model is swapped between its batches."""

import json

from vitalsieve.contracts import HEART, STROKE
from vitalsieve.operators.routing import Served, answer
from vitalsieve.streaming import registry, scoring

BOTH = {"heart": HEART, "stroke": STROKE}


def _ask(contract, **changes):
    return json.dumps({"disease": contract.name, "data": {r.name: "A" if r.text else 1 for r in contract.rules} | changes})


def test_newest_version_of_each_disease(spark, tmp_path):
    path = str(tmp_path / "registry")
    served, versions = registry.current(spark, path, BOTH)
    assert versions == {"heart": 0, "stroke": 0} and not served["heart"].ready
    registry.publish(spark, path, 1, {"heart": Served(HEART, {"Age": 1.0}, filled={"Age": 5, "Sex": "A"}), "stroke": Served(STROKE, {"age": 1.0}, calibrated=False)})
    registry.publish(spark, path, 3, {"heart": Served(HEART, {"Age": 2.0})})
    registry.publish(spark, path, 3, {"heart": Served(HEART, {"Age": 3.0})})
    served, versions = registry.current(spark, path, BOTH)
    assert versions == {"heart": 3, "stroke": 1}
    assert served["heart"].weights == {"Age": 3.0} and served["stroke"].calibrated is False
    registry.publish(spark, path, 4, {"stroke": Served(STROKE)}, {"stroke": str(tmp_path / "nowhere")})
    info = {r.disease: r for r in registry.model_info(spark, path, BOTH).collect()}
    assert (info["heart"].status, info["stroke"].status, info["stroke"].version) == ("ready", "unavailable", 4)


def test_a_swap_between_batches(spark, tmp_path):
    home = str(tmp_path)
    contract, first, second = {"heart": HEART}, Served(HEART, {"Age": 0.1}), Served(HEART, {"Age": -0.2}, 0.5)
    bodies = [[_ask(HEART, Age=i + 10 * k) for i in range(4)] + ["{"] for k in range(3)]
    (tmp_path / "in").mkdir()
    for k, model in ((0, None), (1, first), (2, second)):
        if model:
            registry.publish(spark, f"{home}/registry", k, {"heart": model})
        (tmp_path / "in" / f"{k}.txt").write_text("\n".join(bodies[k]))
        registry.answer_stream(scoring.read_requests(spark, f"{home}/in", 1), "body", f"{home}/registry", contract, f"{home}/out", f"{home}/state", ["body"]).awaitTermination()
    got = {(r.body, r.model_version, r.probability, r.status_class) for r in spark.read.parquet(f"{home}/out").collect()}
    want = set()
    for k, model in ((0, Served(HEART)), (1, first), (2, second)):
        df = spark.createDataFrame([(b,) for b in bodies[k]], "body string")
        want |= {(r.body, k if r.disease else None, r.probability, r.status_class) for r in answer(df, "body", {"heart": model}, ["body"]).collect()}
    assert got == want
