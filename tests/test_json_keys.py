"""Repeated keys against Python's own parser, on texts built at random."""

import json
import random

from pyspark.sql import functions as F

from vitalsieve.functions.json import repeated_key


def _first_repeated(text):
    found = []

    def hook(pairs):
        seen = set()
        for key, _ in pairs:
            if key in seen:
                found.append(key)
                break
            seen.add(key)
        return dict(pairs)

    json.loads(text, object_pairs_hook=hook)
    return found[0] if found else None


def _text(draw, depth):
    kind = draw.randrange(6) if depth else draw.randrange(3)
    if kind == 0:
        return draw.choice(["1", "-2.5e3", "true", "null"])
    if kind < 3:
        return json.dumps(draw.choice(["", "a", "b", 'q"{', "x,y:[", "\\", "é\n", "{}"]), ensure_ascii=draw.random() < 0.5)
    if kind == 3:
        return "[" + draw.choice([",", " , "]).join(_text(draw, depth - 1) for _ in range(draw.randrange(4))) + "]"
    keys = [draw.choice(['"a"', '"b"', '"\\u0061"', '"k\\"{"', '""', '"c"', '"d"', '"e"']) for _ in range(draw.randrange(5))]
    return "{" + draw.choice([",", "\n, "]).join(f"{k} : {_text(draw, depth - 1)}" for k in keys) + "}"


def test_equals_the_parser(spark):
    draw = random.Random(7)
    texts = [_text(draw, 5) for _ in range(1500)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r.i: r.k for r in df.select("i", repeated_key(F.col("t")).alias("k")).collect()}
    want = {i: _first_repeated(t) for i, t in enumerate(texts)}
    assert got == want
    assert sum(v is not None for v in want.values()) > 50


def test_nothing_to_find(spark):
    df = spark.createDataFrame([(None,), ("",), ("5",), ("[]",), ('{"a"',)], "t string")
    assert [r[0] for r in df.select(repeated_key(F.col("t"))).collect()] == [None] * 5
