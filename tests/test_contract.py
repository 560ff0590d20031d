import json
import random

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsflow.operators import contract
from obsflow.schemas import DOUBLE, LONG, RAW_CURRENT, RAW_MARINE, STRING, struct

SCHEMA = struct(
    ("name", STRING, False),
    ("n", LONG),
    ("d", DOUBLE),
    ("o", struct(("x", LONG, False), ("y", T.BooleanType())), False),
    ("items", T.ArrayType(struct(("v", DOUBLE, False)))),
    ("tags", T.MapType(STRING, STRING)),
)
GOOD = {"name": "a", "n": 1, "d": 1.5, "o": {"x": 1, "y": True}, "items": [{"v": 1}], "tags": {"k": "v"}}


def found(spark, *texts, schema=SCHEMA):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, payload string")
    return rows(contract.contract_violations(df, "payload", schema, keep=["id"]))


def changed(**parts):
    return json.dumps({**GOOD, **parts})


@pytest.mark.parametrize(
    "text",
    [
        json.dumps(GOOD),
        changed(n=None, d=2, items=None),
        changed(d=5.0),
        changed(items=[]),
        json.dumps({"name": "", "o": {"x": -3}}),
        changed(d=1e300, tags={}),
    ],
)
def test_conforming(spark, text):
    assert found(spark, text) == []


@pytest.mark.parametrize(
    "text, expected",
    [
        ("{broken", [("", "corrupt")]),
        (None, [("", "corrupt")]),
        ("[1]", [("", "wrong_type")]),
        ("5", [("", "wrong_type")]),
        ("{}", [("name", "missing"), ("o", "missing")]),
        (changed(name=None), [("name", "wrong_type")]),
        (changed(name=3), [("name", "wrong_type")]),
        (changed(n="3"), [("n", "wrong_type")]),
        (changed(n=2.5), [("n", "wrong_type")]),
        (changed(d=True), [("d", "wrong_type")]),
        (changed(o=None), [("o", "wrong_type")]),
        (changed(o=[]), [("o", "wrong_type")]),
        (changed(o={"y": 1}), [("o.x", "missing"), ("o.y", "wrong_type")]),
        (changed(extra=1), [("extra", "unknown_key")]),
        (changed(o={"x": 1, "z": 0}), [("o.z", "unknown_key")]),
        (changed(items=[{"v": 1}, {"v": "a"}, {"v": "b"}, {}]),
         [("items[].v", "missing"), ("items[].v", "wrong_type")]),
        (changed(items={}), [("items", "wrong_type")]),
        (changed(tags=[1]), [("tags", "wrong_type")]),
    ],
)
def test_violations(spark, text, expected):
    assert found(spark, text) == [(0, *e) for e in expected]


def test_check_does_not_block_but_strict_sets_aside(spark):
    df = spark.createDataFrame([(1, json.dumps(GOOD)), (2, "{}")], "id int, payload string")
    assert contract.with_violations(df, "payload", SCHEMA).count() == 2
    assert [r.id for r in contract.conforming(df, "payload", SCHEMA).collect()] == [1]
    assert [r.id for r in contract.violating(df, "payload", SCHEMA).collect()] == [2]


def test_feed_schemas(spark):
    current = {"location": {"name": "x", "lat": 1, "lon": 2.5}, "current": {"condition": {"code": 1}}}
    assert found(spark, json.dumps(current), schema=RAW_CURRENT) == []
    del current["current"]
    assert found(spark, json.dumps(current), schema=RAW_CURRENT) == [(0, "current", "missing")]
    marine = {"location": {}, "forecast": {"forecastday": [
        {"date": "2024-01-01", "hour": [{"time": 5}], "day": {"tides": [{"tide": [{"tide_type": 1}]}]}}
    ]}}
    assert found(spark, json.dumps(marine), schema=RAW_MARINE) == [
        (0, "forecast.forecastday[].day.tides[].tide[].tide_type", "wrong_type"),
        (0, "forecast.forecastday[].hour[].time", "wrong_type"),
    ]


NAMES = ["a", "é", "a b", "a`b", "x.y", "DECIMAL(1,2)", "Z", "_", "\\", "n\n", "1"]


def test_shapes_settle_what_the_check_settles(spark):
    """With names of any characters, nested, required or not: the same as the check alone, and most need no check."""
    rng = random.Random(5)
    leaves = [STRING, LONG, DOUBLE, T.BooleanType()]
    inner = struct(*((n, leaves[k % 4], k % 3 > 0) for k, n in enumerate(NAMES)))
    schema = struct(*((n, leaves[k % 4], k % 2 > 0) for k, n in enumerate(NAMES)), ("in", inner), ("must", inner, False))
    values = {STRING: "x", LONG: 7, DOUBLE: 2.5, T.BooleanType(): True}

    def document(of, slips):
        made = {}
        for field in of:
            value = document(field.dataType, slips) if isinstance(field.dataType, T.StructType) else values[field.dataType]
            if field.dataType == DOUBLE:
                value = rng.choice([2, 2.5, 1e300, 10**25 + 0.5])
            if field.nullable and rng.random() < 0.3:
                value = None
            if not (field.nullable and rng.random() < 0.2) and rng.random() >= slips:
                made[field.name] = rng.choice([1.5, "y", None, {}, []]) if rng.random() < slips else value
        return made | ({"more": 1} if rng.random() < slips else {})

    texts = [json.dumps(document(schema, slips)) for slips in [0.0] * 60 + [0.02] * 60] + [None, "{", "{}", "null", "5", "[]"]
    frame = spark.createDataFrame(list(enumerate(texts)), "id int, payload string").select("id", F.try_parse_json("payload").alias("v"))
    pattern = contract._clean_shape(schema, False)
    both = frame.select("id", contract.violations(F.col("v"), schema).alias("a"), contract._violations(F.col("v"), schema).alias("b"), F.schema_of_variant("v").rlike(f"^{pattern}$").alias("clean"))
    found = both.collect()
    assert [r.id for r in found if r.a != r.b] == []
    assert [r.id for r in found if bool(r.clean) != (r.b == [])] == []
    assert sum(bool(r.clean) for r in found) >= 60 and sum(not r.clean for r in found) >= 30


def test_violations_are_computed_once(spark):
    df = spark.createDataFrame([(1, "{}")], "id int, payload string")
    text = plan(contract.contract_violations(df, "payload", SCHEMA, keep=["id"]))
    assert "Filter" not in text and "rlike" in plan(contract.contract_violations(df, "payload", RAW_CURRENT)).lower()
