"""Request bodies made from the events table, valid and broken in every way the rules name."""

from __future__ import annotations

from dataclasses import replace

from vitalsieve import contracts
from vitalsieve.operators.routing import Served

# One SQL text builds the same bodies in both engines; {k} is the number inside the event's props.

BODY = """CASE WHEN {k} = 87 THEN '' WHEN {k} = 86 THEN '[1]' ELSE
'{{' ||
CASE {k} WHEN 97 THEN '' WHEN 96 THEN '"disease": null, ' WHEN 95 THEN '"disease": "  ", ' WHEN 94 THEN '"disease": "liver", '
  WHEN 93 THEN '"disease": " Lung_Cancer ", ' WHEN 92 THEN '"disease": 5, ' WHEN 85 THEN '"disease": "x", "disease": "lung_cancer", '
  ELSE '"disease": "lung_cancer", ' END ||
CASE {k} WHEN 91 THEN '"mode": "expert", ' WHEN 90 THEN '"mode": "Clinical ", ' WHEN 89 THEN '"mode": 7, ' ELSE '' END ||
CASE {k} WHEN 83 THEN '"data": null' WHEN 82 THEN '"data": {{}}' WHEN 81 THEN '"data": "text"' WHEN 80 THEN '"request": 1' ELSE
  '"data": {{' ||
  CASE WHEN {k} = 84 THEN '"age": 3, ' ELSE '' END ||
  '"gender": ' || CASE WHEN event_type = 'click' THEN '"MALE"' WHEN event_type = 'view' THEN '" female "' WHEN event_type = 'purchase' THEN '1'
    WHEN event_type = 'signup' AND {k} < 15 THEN '"OTHER"' WHEN event_type = 'signup' THEN '"1"'
    WHEN {k} < 10 THEN 'true' WHEN {k} < 20 THEN '5' ELSE '0' END ||
  ', "age": ' || CASE {k} WHEN 0 THEN 'null' WHEN 1 THEN 'false' WHEN 2 THEN '"old"' WHEN 3 THEN '"55"' WHEN 4 THEN '0.5' ELSE CAST({k} * 2 - 20 AS {text}) END ||
  ', "smoking": ' || CASE WHEN user_id < 5 THEN '2' WHEN user_id < 8 THEN '"MAYBE"' WHEN user_id < 11 THEN '"yes"' WHEN user_id < 14 THEN 'true' WHEN user_id < 70 THEN '1' ELSE '0' END ||
  ', "yellow_fingers": ' || CASE WHEN value > 10 THEN '1' ELSE '0' END ||
  ', "anxiety": ' || CASE WHEN value > 14 THEN '"YES"' ELSE '"no"' END ||
  ', "peer_pressure": 0, "chronic_disease": 1, "fatigue": ' || CASE WHEN value < 1.2 THEN 'null' ELSE '1' END ||
  ', "allergy": 0, "wheezing": 1, "alcohol_consuming": 1' ||
  CASE WHEN value < 0.5 THEN '' ELSE ', "coughing": 1' END ||
  ', "shortness_of_breath": 1, "swallowing_difficulty": 0, "chest_pain": 1' ||
  CASE WHEN value > 40 THEN ', "weight": 70' ELSE '' END || '}}' END ||
CASE WHEN {k} = 88 THEN '' ELSE '}}' END END"""

# Weights of the logistic score used on these requests.

WEIGHTS = {
    "gender": 0.25, "age": 0.03, "smoking": 0.5, "yellow_fingers": 0.75, "anxiety": 0.5, "peer_pressure": 0.25,
    "chronic_disease": 0.25, "fatigue": -0.5, "allergy": 0.25, "wheezing": -0.75, "alcohol_consuming": 0.25, "coughing": 0.5,
    "shortness_of_breath": -1.25, "swallowing_difficulty": 0.5, "chest_pain": -1.0,
}
INTERCEPT = -1.0


# Requests of all diseases. {k} is the number inside the event's props; a disease follows from the event's id.

MIXED = ("heart", "diabetes", "stroke", "asthma", "parkinsons", "breast_cancer", "lung_cancer")
#: No model is there for this one, and this one's score is no probability.
ABSENT, MARGIN_ONLY = "diabetes", "stroke"


def request_number(i: int) -> str:
    return f"CAST((event_id * {i + 3} + user_id) % 97 AS {{text}}) || CASE WHEN (event_id + {i}) % 5 = 0 THEN '.5' ELSE '' END"


def _level(i: int) -> str:
    return f"""CASE (event_id + {i}) % 4 WHEN 0 THEN '"A"' WHEN 1 THEN '"b c"' WHEN 2 THEN '7' ELSE 'null' END"""


def _coded(i: int, rule: contracts.FieldRule) -> str:
    if rule.style == "gender":
        return """CASE user_id % 3 WHEN 0 THEN '"MALE"' WHEN 1 THEN '" female"' ELSE '1' END"""
    return f"""CASE (user_id + {i}) % 4 WHEN 0 THEN '1' WHEN 1 THEN '0' WHEN 2 THEN '"yes"' ELSE '" NO "' END"""


def _value(i: int, rule: contracts.FieldRule) -> str:
    """One field's text; the first three and the last are broken where the event says so."""
    plain = _level(i) if rule.text else _coded(i, rule) if rule.codes else request_number(i)
    faults = {0: [(0, '"old"'), (4, "null"), (6, '"NaN"')], 1: [(1, "true"), (2, '"55"')], 2: [(3, "{{}}"), (5, '"Infinity"')]}.get(i, [])
    cases = "".join(f" WHEN {k} THEN '{v}'" for k, v in faults)
    return f"CASE {{k}}{cases} ELSE {plain} END" if cases else plain


def mixed_body() -> str:
    """SQL text of a request body, the same in both engines; format it with ``k`` and ``text``."""
    bodies = []
    for at, name in enumerate(MIXED):
        rules = contracts.CONTRACTS[name].rules
        fields = [f"""'"{r.name}": ' || {_value(i, r)}""" for i, r in enumerate(rules)]
        last = f"""CASE WHEN {{k}} IN (7, 8) THEN '' WHEN {{k}} = 12 THEN ', "{rules[-1].name}": [1]' ELSE ', ' || {fields[-1]} END"""
        before = f"""CASE WHEN {{k}} = 8 THEN '' ELSE ', ' || {fields[-2]} END"""
        bodies.append(f"WHEN {at} THEN " + " || ', ' || ".join(fields[:-2]) + f" || {before} || {last}")
    disease = " ".join(f"""WHEN {at} THEN '"{name}"'""" for at, name in enumerate(MIXED))
    return f"""'{{{{"disease": ' || CASE event_id % 9 {disease} WHEN 7 THEN '" Heart "' ELSE '"liver"' END ||
  CASE {{k}} WHEN 10 THEN ', "mode": "Clinical"' WHEN 11 THEN ', "mode": "expert"' ELSE '' END || ', "data": {{{{' ||
  CASE event_id % 9 {' '.join(bodies)} {bodies[0].replace('WHEN 0', 'WHEN 7', 1)} ELSE '"Age": 5' END ||
  CASE WHEN {{k}} = 9 THEN ', "weight": 70' ELSE '' END || '}}}}}}}}'"""


def mixed_served(absent: tuple[str, ...] = (ABSENT,)) -> dict[str, Served]:
    """Weights in 64ths by a field's place, so that sums are exact in any order; nulls become the place, or level A."""
    served = {}
    for name in MIXED:
        contract = contracts.CONTRACTS[name]
        weights, filled = {}, {}
        for i, r in enumerate(contract.rules):
            if r.text:
                weights |= {f"{r.name}=A": (i % 3 - 1) / 4, f"{r.name}=7": (i % 5 - 2) / 8}
                filled[r.name] = "A"
            else:
                weights[r.name] = (i % 5 - 2) / 64
                filled[r.name] = i
        served[name] = Served(contract) if name in absent else Served(contract, weights, 0.125, filled, calibrated=name != MARGIN_ONLY)
    return served


def turned(served: dict[str, Served]) -> dict[str, Served]:
    """The same models with every weight and the intercept negated."""
    return {n: s if s.weights is None else replace(s, weights={k: -v for k, v in s.weights.items()}, intercept=-s.intercept) for n, s in served.items()}


# Grouped payloads: means as an object, errors as a list of items with strangers in it, the rest as an object, and loose fields that win.


def grouped_body() -> str:
    """SQL text of a grouped request; format it with ``k`` and ``text``."""
    features = contracts.BREAST_FEATURES

    def pairs(lo: int, hi: int) -> str:
        return " || ', ' || ".join(f"""'"{features[i]}": ' || {request_number(i)}""" for i in range(lo, hi))

    items = " || ', ' || ".join(f"""'{{{{"name": "{features[i]}", "value": ' || {request_number(i)} || '}}}}'""" for i in range(10, 20))
    loose = f"""CASE {{k}} % 5 WHEN 0 THEN ', "{features[0]}": 1000' WHEN 1 THEN ', "{features[12]}": null' WHEN 2 THEN ', "stranger": 1' ELSE '' END"""
    strangers = f"""CASE {{k}} % 3 WHEN 0 THEN '5, {{{{"name": "x"}}}}, {{{{"value": 3}}}}, ' WHEN 1 THEN '{{{{"name": "{features[10]}", "value": 77}}}}, ' ELSE '' END"""
    worst = f"""CASE WHEN {{k}} % 7 = 0 THEN '"worst_features": 5' ELSE '"worst_features": {{{{' || {pairs(20, 30)} || '}}}}' END"""
    return f"""'{{{{"disease": "breast_cancer", "data": {{{{"mean_features": {{{{' || {pairs(0, 10)} || '}}}}, "se_features": [' || {strangers} || {items} || '], ' || {worst} || {loose} || '}}}}}}}}'"""


# Keys that repeat below the first level, look-alikes that do not, and what each is told as.

NESTED = (
    ('{"disease": "heart", "data": {"a": {"b": [1, {"c": 1, "c": 2}]}}}', "c"),
    ('{"disease": "heart", "disease": "heart", "data": {"x": 1, "y": {"x": 2}, "x": 3}}', "x"),
    ('{"disease": "he\\"{,art", "data": {"k": "a,:{", "k": [{"k": 1}]}}', "k"),
    ('{"disease": "heart", "data": {"\\u0061": 1, "a": {"a": "a"}}}', "a"),
    ('{"disease": "unknown", "data": [{"k": 1}, {"k": 2}, "k", "k"], "k": {"disease": {"data": []}}}', None),
    ('{"data": {"p": {"q": {}, "q": []}, "p": 1}, "disease": null, "data": 1}', "q"),
    ('{"disease": "heart", "mode": "user", "mode": "user", "data": {"a": [[], [{}]]}}', "mode"),
)


def nested_body() -> str:
    """SQL text of a body with nested keys; format it with ``k``."""
    cases = " ".join(f"WHEN {i} THEN '{body}'" for i, (body, _) in enumerate(NESTED)).replace("{", "{{").replace("}", "}}")
    return f"CASE {{k}} % {len(NESTED)} {cases} END"
