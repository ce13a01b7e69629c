"""Property test: text -> integer against Spark's own permissive (ANSI off) cast
on generated text, white space and control characters included."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from argent.functions.columns import text_to_integer

texts = st.text(alphabet="0123456789+-. ex\t\n\r\x00\x0b\x1f\x7f\u00a0\u2003", max_size=12)
numbers = st.integers(min_value=-2 ** 40, max_value=2 ** 40).map(str)
decimals = st.tuples(st.integers(-10 ** 6, 10 ** 6), st.integers(0, 999)).map(lambda p: f"{p[0]}.{p[1]}")
padded = st.tuples(st.sampled_from(["", "\t", "\x00", " \r\n", "\x7f"]), numbers, st.sampled_from(["", " ", "\x1f", "\x7f\t"])) \
    .map("".join)
values = st.one_of(texts, numbers, decimals, padded, st.none())


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.too_slow])
@given(st.lists(values, min_size=50, max_size=300))
def test_integer_rule_is_the_permissive_cast(spark, batch):
    df = spark.createDataFrame(list(enumerate(batch)), "i int, v string").coalesce(1)
    ours = [tuple(r) for r in df.select("i", text_to_integer("v"), text_to_integer("v", "long")).collect()]
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        theirs = [tuple(r) for r in df.selectExpr("i", "cast(v as int)", "cast(v as bigint)").collect()]
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    assert sorted(ours, key=repr) == sorted(theirs, key=repr)
