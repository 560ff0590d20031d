"""Leaves of undeclared documents and drift from a declared schema."""

import json
import random

from conftest import final_plan, plan, rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsflow.operators import drift, leaves
from obsflow.schemas import DOUBLE, LONG, STRING, struct


def brute(value, path="", levels=leaves.LEVELS):
    """Leaves of a parsed document by plain recursion: (path, kind, value as parsed)."""
    if isinstance(value, dict) and value and levels:
        return [leaf for k, v in value.items() for leaf in brute(v, f"{path}.{k}" if path else k, levels - 1)]
    kinds = {dict: "OBJECT", list: "ARRAY", str: "STRING", bool: "BOOLEAN", int: "BIGINT", float: "DOUBLE", type(None): "VOID"}
    return [(path, kinds[type(value)], value)]


def random_document(rng, depth=0):
    kind = rng.randrange(9 if depth < 5 else 6)
    if kind >= 6:
        return {rng.choice("abcdeé") + str(k): random_document(rng, depth + 1) for k in range(rng.randrange(4))}
    return [rng.choice(["", "x'y", "ü \"q\""]), rng.randrange(10**6), rng.random(), rng.random() < 0.5, None, [1, {"a": 2}]][kind]


def parsed(found):
    return [(i, p, k, v if k == "STRING" else json.loads(v) if v is not None else None) for i, p, k, v in found]


def test_leaves_of_random_documents(spark):
    rng = random.Random(4)
    documents = [random_document(rng) for _ in range(150)] + [{"a": {"b": {"c": 1}}}] * 2
    frame = spark.createDataFrame([(i, json.dumps(x)) for i, x in enumerate(documents)], "id long, t string")
    expected = [(i, *leaf) for i, x in enumerate(documents) for leaf in brute(x)]
    assert sorted(parsed(rows(leaves.variant_leaves(frame, "t", ["id"]))), key=repr) == sorted(expected, key=repr)


def test_leaves_at_the_edges(spark):
    texts = [None, "", "{", "{}", "5", '"x"', '{"m": {"k": 1}, "n": {"k": [1]}}', '{"a": {"a": {"a": 1}}}']
    frame = spark.createDataFrame(list(enumerate(texts)), "path long, t string")
    found = leaves.variant_leaves(frame.withColumnRenamed("path", "id"), "t", ["id"], whole=["m"], levels=2)
    assert rows(found) == sorted([
        (0, "", "CORRUPT", None), (1, "", "CORRUPT", ""), (2, "", "CORRUPT", "{"), (3, "", "OBJECT", "{}"), (4, "", "BIGINT", "5"),
        (5, "", "STRING", "x"), (6, "m", "OBJECT", '{"k":1}'), (6, "n.k", "ARRAY", "[1]"), (7, "a.a", "OBJECT", '{"a":1}'),
    ], key=repr)
    assert leaves.variant_leaves(frame.limit(0), "t").count() == 0
    assert "Exchange" not in plan(leaves.variant_leaves(frame, "t")) and "Python" not in plan(leaves.variant_leaves(frame, "t"))


SCHEMA = struct(("a", LONG), ("b", struct(("c", STRING, False), ("d", DOUBLE))), ("m", T.MapType(STRING, LONG)), ("l", T.ArrayType(LONG)))


def _hours(spark, texts):
    """Payloads, one list per hour of a day."""
    flat = [(h, "x" if h % 2 else "y", t) for h, hour in enumerate(texts) for t in hour]
    frame = spark.createDataFrame(flat, "h int, feed string, t string")
    return frame.withColumn("at", F.make_timestamp_ntz(F.lit(2024), F.lit(1), F.lit(5), "h", F.lit(17), F.lit(3)))


def test_drift_of_shapes(spark):
    full = '{"a": 1, "b": {"c": "", "d": 1}, "m": {"k1": 1}, "l": []}'
    frame = _hours(spark, [
        [full, full], ['{"a": "1", "b": {"c": "x", "d": null}, "m": {"k2": 2, "k3": 4}, "l": [1]}'],
        ['{"a": null, "b": {}, "m": null, "l": null}', "{"], ['{"a": 2, "b": {"c": null, "d": {"e": 1}}, "m": {}, "l": 3}'], [full],
    ])
    shapes = drift.hour_shapes(frame, "t", "at", SCHEMA)
    found = sorted(((r.path, r.kind, r.change, r.first_hour.hour, r.last_hour.hour, r.hours, r.payloads) for r in drift.schema_drift(shapes, SCHEMA).collect()), key=repr)
    assert found == sorted([
        ("a", "STRING", "retyped", 1, 1, 1, 1), ("", "CORRUPT", "corrupt", 2, 2, 1, 1), ("b.c", None, "lost", 2, 2, 1, 0),
        ("b.d", None, "lost", 2, 3, 2, 0), ("b.c", "VOID", "retyped", 3, 3, 1, 1), ("b.d.e", "BIGINT", "new", 3, 3, 1, 1),
        ("l", "BIGINT", "retyped", 3, 3, 1, 1),
    ], key=repr)
    per_feed = drift.schema_drift(drift.hour_shapes(frame, "t", "at", SCHEMA, ["feed"]), SCHEMA, ["feed"])
    assert sorted((r.feed, r.path) for r in per_feed.where("change = 'lost'").collect()) == [("x", "b.d"), ("y", "b.c"), ("y", "b.d")]


def test_hours_of_a_wall_clock(spark, settings):
    settings(spark__sql__session__timeZone="America/New_York")
    frame = spark.sql("SELECT '{}' AS t, TIMESTAMP_NTZ '2024-03-10 02:30:00' AS at")  # an hour that zone skips
    assert [str(r.hour) for r in drift.hour_shapes(frame, "t", "at", SCHEMA).collect()] == ["2024-03-10 02:00:00"]


def test_shapes_of_batches_add_up(spark):
    full, less = '{"a": 1, "b": {"c": "", "d": 1}}', '{"a": 1.5}'
    frame = _hours(spark, [[full, less], [less] * 5, [full] * 3])
    whole = drift.hour_shapes(frame, "t", "at", SCHEMA)
    parts = [drift.hour_shapes(frame.where(half), "t", "at", SCHEMA) for half in ("rand(1) < 2 AND h < 1", "h >= 1 AND feed = 'x'", "h >= 1 AND feed = 'y'")]
    merged = drift.merge_shapes(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    assert rows(merged) == rows(whole)
    assert drift.schema_drift(whole.limit(0), SCHEMA).count() == 0
    # Shapes are counted before they are exploded: one generator, above a partial count.
    explained = final_plan(whole)
    assert explained.index("Generate") < explained.rindex("partial_count") and "Python" not in explained


def test_leaves_of_shapes(spark):
    """Those of the walk through the document, for names of any characters, maps and few levels."""
    rng = random.Random(7)
    names = ["a", "a b", "a`b", "``", "`", "", "OBJECT", "OBJECT<", "x: y, z>", "DECIMAL(1,2)", "1", "é.ü", "n\n", "\\", '"', "BIGINT"]
    odd = {name: {other: [1, 2.5, {"x": []}] for other in names} for name in names}
    texts = [json.dumps(random_document(rng)) for _ in range(150)] + [json.dumps(odd), json.dumps({"a": {"b": {"c": {}}}, "m": {"k": {"x": 1}}})]
    texts += [None, "", "{", '{"a": 1, "a": 2}', "5.0", "1e400", str(10**30), str(10**50), "true", "[]", "{}"]
    frame = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    for whole, levels in (((), leaves.LEVELS), (["m", "a"], 2), (["m.k"], 1), ((), 0)):
        walked = leaves.variant_leaves(frame, "t", ["id"], whole, levels).select("id", "path", "kind")
        found = frame.select("id", F.inline(leaves.shape_leaves(leaves.leaf_shape(F.col("t")), whole, levels)))
        assert rows(found) == rows(walked)


def test_shapes_are_walked_once_counted(spark):
    """Without maps only shapes that differ are taken apart, and no payload; numbers of any size share one."""
    plain = struct(("a", DOUBLE), ("b", struct(("c", STRING))))
    frame = _hours(spark, [[f'{{"a": {10.0 ** k / 4}, "b": {{"c": "{k}"}}}}' for k in range(1, 7)]] * 3)
    shapes = drift.hour_shapes(frame, "t", "at", plain)
    assert rows(shapes.drop("hour")) == sorted([("a", "DOUBLE", 6), ("b.c", "STRING", 6)] * 3, key=repr)
    assert frame.select(leaves.leaf_shape(F.col("t"))).distinct().count() == 1
    explained = final_plan(shapes)
    assert "lambda" not in explained[explained.rindex("partial_count"):]
