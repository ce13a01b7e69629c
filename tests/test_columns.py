"""Column functions on the edge rows of FIXTURES.md §3."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from argent.functions import columns as C


def one_col(spark, values, dtype="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {dtype}")


def test_integer_rule(spark):
    values = ["12", " 7.9 ", "12.7", "-0.9", ".5", "1e3", "abc", "", "2147483648",
              "-.25", ".", "+.", "+", "+5", "12.", "\t12", "\x0012\x7f", "12\u00a0", None]
    expect = [12, 7, 12, 0, 0, None, None, None, None, 0, 0, 0, None, 5, 12, 12, 12, None, None]
    got = [r[0] for r in one_col(spark, values).select(C.text_to_integer("v")).collect()]
    assert got == expect


def test_integer_rule_long(spark):
    got = one_col(spark, ["3000000000", "9223372036854775808"]) \
        .select(C.text_to_integer("v", "long")).collect()
    assert [r[0] for r in got] == [3000000000, None]


def test_float_and_boolean(spark):
    df = spark.createDataFrame([("x", "yes"), ("1.5", "maybe"), (None, "true")], "f string, b string")
    got = df.select(C.safe_cast("f", "float"), C.safe_cast("b", "boolean")).collect()
    assert [tuple(r) for r in got] == [(None, True), (1.5, None), (None, True)]


def test_long_to_int_overflow_is_null(spark):
    got = one_col(spark, [3000000000, 5], "bigint") \
        .select(C.safe_cast("v", "int", T.LongType())).collect()
    assert [r[0] for r in got] == [None, 5]


def test_number_to_int_truncates(spark):
    got = one_col(spark, [12.7, -0.9], "double") \
        .select(C.safe_cast("v", "int", T.DoubleType())).collect()
    assert [r[0] for r in got] == [12, 0]


def test_epoch_ms_text(spark):
    values = ["1700000000123", "1700000000000", "0", "-1001", None, "x"]
    got = one_col(spark, values).select(
        C.timestamp_text(C.epoch_ms_to_timestamp("v", T.StringType()))).collect()
    assert [r[0] for r in got] == [
        "2023-11-14 22:13:20.123", "2023-11-14 22:13:20", "1970-01-01 00:00:00",
        "1969-12-31 23:59:58.999", None, None]


ELEM = "array<struct<f:string>>"


def test_last_first_has(spark):
    df = spark.createDataFrame(
        [(None,), ([],), ([("x",), ("y",)],), ([None],)], f"a {ELEM}")
    got = df.select(C.last_element("a", "f"), C.first_element(F.col("a.f")),
                    C.has_elements("a")).collect()
    assert [tuple(r) for r in got] == [
        (None, None, False), (None, None, False), ("y", "x", True), (None, None, True)]


def test_nested_last_of_last(spark):
    schema = "ev struct<r: array<struct<cc: array<struct<id:string>>>>>"
    data = [((None,),), (([],),), (([([],)],),), (([([("a",), ("b",)],), ([("c",)],)],),),
            (([([("a",)],), None],),)]
    df = spark.createDataFrame(data, schema)
    got = df.select(C.last_of(C.last_element("ev.r", "cc").getField("id"))).collect()
    assert [r[0] for r in got] == [None, None, None, "c", None]


def test_surrogate_key_skips_nulls(spark):
    df = spark.createDataFrame([("item", None, "c"), ("a", "b", "c")], "x string, y string, z string")
    assert [r[0] for r in df.select(C.surrogate_key("x", "y", "z")).collect()] == ["item-c", "a-b-c"]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_same_results_with_ansi_on_and_off(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        test_integer_rule(spark)
        test_float_and_boolean(spark)
        test_last_first_has(spark)
        test_long_to_int_overflow_is_null(spark)
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_complex_text_forms(spark):
    df = spark.createDataFrame([([(1, "x"), None],)], "a array<struct<n:int,s:string>>")
    spark_text, json_text = df.select(C.complex_text("a"), C.complex_text("a", as_json=True)).first()
    assert spark_text == "[{1, x}, null]"
    assert json_text == '[{"n":1,"s":"x"},null]'


def test_text_to_boolean_is_the_cast_without_its_exceptions(spark):
    values = ["t", "TRUE", " yes\t", "\x00Y\x7f", "1", "f", "False", "n", "NO\n", "0", "maybe", "", " ", "10", "tr ue",
              "true ", " true", "İ", "yeſ", "01", "+1", "on", None]
    df = one_col(spark, values)
    checked = C.safe_cast("v", "boolean", T.StringType())
    got = df.select(checked.alias("a"), F.col("v").try_cast("boolean").alias("b"))
    assert all(r.a == r.b for r in got.collect())
    # text that is no boolean never reaches the cast
    assert "RLIKE" in df.select(checked)._jdf.queryExecution().optimizedPlan().toString()
