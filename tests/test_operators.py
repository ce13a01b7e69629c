"""Relational operators: keep-one, explode, unions, joins."""

import pytest
from pyspark.sql import functions as F

from argent.operators import (
    explode_rows,
    fits_broadcast,
    keep_one,
    lookup_join,
    rows_referenced_by,
    union_by_name,
)
from argent.operators.joins import hot_keys
from engine_fixtures import rows


def test_keep_one_total_order_and_null_key(spark):
    df = spark.createDataFrame(
        [(1, 2, "b"), (1, 3, "a"), (1, 3, "c"), (None, 1, "x"), (None, 5, "y"), (2, 1, "z")],
        "k int, v int, s string")
    got = keep_one(df, ["k"], [F.col("v").desc()])
    assert rows(got) == rows(spark.createDataFrame(
        [(1, 3, "a"), (None, 5, "y"), (2, 1, "z")], "k int, v int, s string"))


def test_keep_one_repeatable_across_partitionings(spark):
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    a = keep_one(li.repartition(7), ["l_orderkey"])
    b = keep_one(li.coalesce(1), ["l_orderkey"])
    c = keep_one(li.orderBy(F.rand(3)), ["l_orderkey"])
    assert rows(a) == rows(b) == rows(c)


def test_keep_one_plans_partial_limit_before_shuffle(spark):
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    plan = keep_one(li, ["l_orderkey"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2, plan


def test_explode_edge_rows(spark):
    df = spark.createDataFrame([(1, None), (2, []), (3, ["a", "b"]), (4, [None])],
                               "id int, a array<string>")
    got = explode_rows(df, "a", "e", keep=["id"])
    assert rows(got) == [(3, "a"), (3, "b"), (4, None)]
    pos = explode_rows(df, "a", "e", keep=["id"], position="p")
    assert rows(pos) == [(3, 0, "a"), (3, 1, "b"), (4, 0, None)]


def test_union_missing_and_strict(spark):
    a = spark.createDataFrame([(1, "x")], "id int, fornecedor string")
    b = spark.createDataFrame([("y", 2)], "cliente string, id int")
    got = union_by_name([a, b], allow_missing=True)
    assert got.columns == ["id", "fornecedor", "cliente"]
    assert rows(got) == [(1, "x", None), (2, None, "y")]
    c = spark.createDataFrame([(3, "z")], "id int, fornecedor string")
    assert union_by_name([a, c]).count() == 2


def test_rows_referenced_by_keeps_duplicates(spark):
    cat = spark.createDataFrame(
        [("P", "parent", None), ("P", "parent old", None), ("C1", "c", "P"), ("C2", "c", "P"),
         ("Q", "unused", None)], "id string, nome string, categoria_pai string")
    got = rows_referenced_by(cat, "id", "categoria_pai")
    assert rows(got) == sorted([("P", "parent", None), ("P", "parent old", None)], key=repr)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan


def test_lookup_join_both_strategies_agree(spark):
    fact = spark.createDataFrame([(1, "a"), (None, "b"), (3, "c")], "k int, v string")
    dim = spark.createDataFrame([(1, "one"), (2, "two")], "k int, name string")
    small = lookup_join(fact, dim, "k", "left", broadcast=True)
    large = lookup_join(fact, dim, "k", "left", broadcast=False)
    assert small.columns == large.columns == ["k", "v", "name"]
    assert rows(small) == rows(large) == rows(spark.createDataFrame(
        [(1, "a", "one"), (None, "b", None), (3, "c", None)], "k int, v string, name string"))
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()


def test_fits_broadcast_checks_rows_and_bytes(spark):
    dim = spark.createDataFrame([(i, "x" * 10) for i in range(100)], "k int, s string")
    assert fits_broadcast(dim, max_rows=100, max_bytes=10_000)
    assert not fits_broadcast(dim, max_rows=99, max_bytes=10_000)
    assert not fits_broadcast(dim, max_rows=100, max_bytes=1_000)


def test_fits_broadcast_refuses_huge_estimate_without_a_job(spark):
    big = spark.range(0, 10 ** 12)          # never scanned: the estimate decides
    assert not fits_broadcast(big, max_rows=10, max_bytes=1000)


def test_explode_outer_keeps_empty_and_null(spark):
    df = spark.createDataFrame([(1, None), (2, []), (3, ["a"])], "id int, a array<string>")
    got = explode_rows(df, "a", "e", keep=["id"], outer=True)
    assert rows(got) == [(1, None), (2, None), (3, "a")]


def test_lookup_join_shuffle_path_reads_the_fact_once_and_spreads_null_keys(spark):
    fact = spark.range(0, 4000, 1, 4).selectExpr("IF(id % 3 = 0, NULL, id % 7) AS k", "id AS v").distinct()
    dim = spark.range(7).selectExpr("id AS k", "CAST(id AS STRING) AS name")
    out = lookup_join(fact, dim, "k", "left", broadcast=False)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Union" not in plan and plan.count("Range (0, 4000") == 1, plan
    assert out.columns == ["k", "v", "name"] and out.count() == 4000
    nulls = out.filter("k IS NULL")
    assert nulls.filter("name IS NULL").count() == fact.filter("k IS NULL").count()
    from argent.operators.joins import NULL_SPREAD
    spread = fact.filter("k IS NULL").selectExpr(f"pmod(xxhash64(k, v), {NULL_SPREAD}) AS s").distinct().count()
    assert spread > 500


@pytest.mark.parametrize("how", ["left", "inner"])
def test_hot_key_is_split_at_default_settings(spark, how):
    """The sketch finds the hot key; its rows meet copies of its dimension rows in many tasks."""
    fact = spark.range(0, 30000, 1, 8).selectExpr("IF(id % 3 = 0, 7, IF(id % 7 = 0, NULL, id)) AS k", "id AS v")
    dim = spark.range(0, 20000, 1, 4).selectExpr("id AS k", "CAST(id AS STRING) AS name")
    assert [k for k, _ in hot_keys(fact, "k")] == [7] and hot_keys(fact.limit(0), "k") == []
    assert hot_keys(dim, "k") == [] and hot_keys(fact.select(F.array("k").alias("k")), "k") == []
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        out = lookup_join(fact, dim, "k", how, broadcast=False)
        assert out.columns == ["k", "v", "name"] and rows(out) == rows(fact.join(dim, "k", how))
        tasks = out.withColumn("task", F.spark_partition_id()).groupBy("task").agg(
            F.count("*").alias("n"), F.sum((F.col("k") == 7).cast("int")).alias("hot")).collect()
        assert sum(1 for t in tasks if t["hot"]) >= 3 and max(t["n"] for t in tasks) < 10000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_lookup_join_hot_key_is_split(spark):
    """Without the sketch, and with thresholds a test size can reach, adaptive
    execution splits the partition of the hot key."""
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        fact = spark.range(0, 30000, 1, 8).selectExpr("IF(id % 3 = 0, 0, id) AS k", "id AS v", "repeat('x', 20) AS t")
        dim = spark.range(0, 30000, 1, 4).selectExpr("id AS k", "CAST(id AS STRING) AS name")
        out = lookup_join(fact, dim, "k", "left", broadcast=False, split_hot=False)
        assert len(out.collect()) == 30000
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in conf:
            spark.conf.unset(k)
