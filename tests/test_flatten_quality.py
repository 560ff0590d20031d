from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsflow.operators import flatten, quality
from obsflow.schemas import CURRENT_FIELDS, RAW_CURRENT


def nested(spark):
    return spark.sql(
        """SELECT named_struct('b', 1, 'c', named_struct('d', 'x', 'e', array(1, 2))) AS a,
                  map('k', 'v') AS m, named_struct('b.c', 7) AS `x.y`"""
    )


def test_leaves_are_named_by_path(spark):
    flat = flatten.flatten_leaves(nested(spark))
    assert flat.columns == ["a_b", "a_c_d", "a_c_e", "m", "x.y_b.c"]
    assert flat.first() == (1, "x", [1, 2], {"k": "v"}, 7)


def test_one_branch_only(spark):
    assert flatten.flatten_leaves(nested(spark), "a").columns == ["a_b", "a_c_d", "a_c_e"]
    assert flatten.flatten_leaves(nested(spark), "m").columns == ["m"]


def test_empty_struct_has_no_leaf():
    schema = T.StructType([T.StructField("e", T.StructType()), T.StructField("n", T.LongType())])
    assert list(flatten.leaf_paths(schema)) == [("n",)]


def test_mapping_covers_22_fields(spark):
    flat = flatten.flatten_mapped(spark.createDataFrame([], RAW_CURRENT), CURRENT_FIELDS)
    assert len(flat.columns) == 22
    assert flat.schema["condition"].dataType == RAW_CURRENT["current"].dataType["condition"].dataType


def test_explode_results_drops_null_and_empty(spark):
    df = spark.sql(
        """SELECT * FROM VALUES (array(named_struct('m', 'a', 'r', named_struct('s', 1)))),
             (array()), (NULL) AS t(result)"""
    )
    assert flatten.explode_results(df, "result").collect() == [("a", 1)]


def test_explode_tagged_aligns_by_name(spark):
    df = spark.sql(
        """SELECT 9 AS id, array(named_struct('p', 'x', 'q', 1)) AS one,
                  array(named_struct('q', 2, 'r', 'z')) AS two,
                  CAST(NULL AS array<struct<p: string>>) AS three"""
    )
    got = flatten.explode_tagged(df, ["one", "two", "three"], "source", keep=["id"])
    assert got.columns == ["id", "source", "p", "q", "r"]
    assert rows(got) == [(9, "one", "x", 1, None), (9, "two", None, 2, "z")]


def test_drop_all_empty_lists(spark):
    df = spark.sql(
        """SELECT * FROM VALUES (1, array(1), array()), (2, array(), CAST(NULL AS array<int>)),
             (3, NULL, array(1)), (4, NULL, NULL) AS t(id, a, b)"""
    )
    assert rows(flatten.drop_all_empty_lists(df, ["a", "b"]).select("id")) == [(1,), (3,)]


def test_identifiable_truth_table(spark):
    df = spark.createDataFrame(
        [(c, la, lo) for c in ("x", None) for la in (1.0, None) for lo in (2.0, None)],
        "city string, lat double, long double",
    )
    dropped = {(None, 1.0, None), (None, None, 2.0), (None, None, None)}
    flags = {(r.city, r.lat, r.long): r.is_identifiable for r in quality.identifiable_flag(df).collect()}
    assert {k for k, keep in flags.items() if not keep} == dropped
    assert quality.identifiable_rows(df).count() == 5
    assert rows(quality.identifiable_strict(df)) == [("x", 1.0, 2.0)]
    assert rows(quality.identifiable_rows(df.select("long", "lat", "city")).select("city"))


def test_profiles(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "a int, b string")
    assert quality.null_profile(df).collect() == [("a", False), ("b", True)]
    assert quality.type_profile(df).collect() == [("a", "int", 2), ("b", "string", 0)]
    none = df.where(F.lit(False))
    assert quality.null_profile(none).collect() == [("a", False), ("b", False)]
