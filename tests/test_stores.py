"""Commits, staged catalog refreshes, drifted files, rejects."""

import gzip
import json
import os
import threading

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from argent import session
from argent.plans import bronze as B
from argent.plans import job as J
from argent.plans import pipelines as P
from argent.plans import queries as Q
from argent.plans.queries import land_driver_bronze
from argent.sources.driver_shapes import RUN_TS, DriverTables
from argent.sources.drift import fitted, read_declared, schema_groups
from argent.sources.layers import CatalogStore, LayerStore
from argent.sources.snapshots import TAG, Conflict, SnapshotStore
from engine_fixtures import SF_SMALL, rows


@pytest.fixture
def store(spark, tmp_path):
    return SnapshotStore(spark, str(tmp_path / "lake"))


def failing(spark):
    return spark.range(5).select(F.when(F.col("id") < 3, F.col("id")).otherwise(F.raise_error(F.lit("stop")).cast("long")).alias("id"))


def test_snapshots_and_failed_refresh(spark, store):
    store.write(spark.range(5), "Silver", "t", folder="f")
    store.write(spark.range(2), "Silver", "t", folder="f")
    assert store.read("Silver", "t").count() == 2 and store.read("Silver", "t", version=1).count() == 5
    with pytest.raises(Exception, match="stop"):
        store.write(failing(spark), "Silver", "t")
    assert store.read("Silver", "t").count() == 2 and store.version() == 2
    store.write(store.read("Silver", "t").union(spark.range(1)), "Silver", "t")   # from itself
    assert store.read("Silver", "t", folder="f").count() == 3
    with pytest.raises(ValueError):
        store.read("Silver", "none")


def shuffled(spark):
    manager = getattr(spark.sparkContext._jvm.org.apache.spark, "SparkEnv").get().blockManager().diskBlockManager()
    return {os.path.join(d, n) for x in manager.localDirsString() for d, _, names in os.walk(x) for n in names if n.startswith("shuffle_")}


def test_a_write_leaves_no_shuffle_files_and_is_zstd(spark, store, tmp_path):
    df = spark.range(20_000).groupBy((F.col("id") % 1000).alias("k")).count()
    layers, before = LayerStore(spark, str(tmp_path / "layers")), shuffled(spark)
    layers.write(df, "Silver", "t")
    layers.write(df, "Silver", "t", mode="append")
    store.write(df, "Silver", "t")
    with store.run() as run:
        run.write_tagged(df.withColumn(TAG, F.lit("0")), {"0": ("Silver", "tagged", None)})
    kept = session.materialize(df)
    J.write_all({n: (lambda n=n: layers.write(df, "Silver", n)) for n in ("a", "b", "c")}, 3)
    assert not shuffled(spark) - before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) is None
    assert layers.read("Silver", "t").count() == 2000 and kept.count() == layers.read("Silver", "c").count() == 1000
    files = list((tmp_path / "layers").rglob("*.parquet")) + list((tmp_path / "lake").rglob("*.parquet"))
    assert {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files} == {"ZSTD"}


def test_what_the_session_says_about_files_wins(spark, store, tmp_path):
    clean, codec = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "spark.sql.parquet.compression.codec"
    spark.conf.set(clean, "false")
    spark.conf.set(codec, "gzip")
    try:
        store.write(spark.range(3).coalesce(1), "Silver", "t")
        assert spark.conf.get(clean) == "false"
    finally:
        spark.conf.unset(clean)
        spark.conf.unset(codec)
    files = list((tmp_path / "lake").rglob("*.parquet"))
    assert {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files} == {"GZIP"}


def test_landed_bronze_leaves_no_shared_orders(spark, tmp_path):
    before = set(session._RUN_FOLDERS)
    land_driver_bronze(DriverTables(spark, SF_SMALL), LayerStore(spark, str(tmp_path / "lake")))
    new = [f.removeprefix("file:") for f in set(session._RUN_FOLDERS) - before]
    assert new and not any(os.path.exists(f) for f in new)


def test_two_writers_one_refused(spark, store):
    store.write(spark.range(1), "Silver", "t")
    first, second, third = store.run(), store.run(), store.run()
    first.write(spark.range(10), "Silver", "t")
    second.write(spark.range(20), "Silver", "t")
    third.write(spark.range(30), "Silver", "u")                                  # another table: no conflict
    first.publish_all()
    with pytest.raises(Conflict):
        second.publish_all()
    third.publish_all()
    assert store.read("Silver", "t").count() == 10 and store.read("Silver", "u").count() == 30


def test_commit_number_is_given_once(spark, store):
    done = []
    threads = [threading.Thread(target=lambda k=k: done.append(store.commits.add({"number": 1, "tables": {"k": k}})))
               for k in range(6)]
    [t.start() for t in threads], [t.join() for t in threads]
    assert done.count(True) == 1 and store.commits.numbers() == [1]


def test_reader_never_fails_during_refreshes(spark, store):
    store.write(spark.range(100), "Silver", "t")
    seen, errors, stop = [], [], threading.Event()

    def read():
        while not stop.is_set():
            try:
                seen.append(store.read("Silver", "t").count())
            except Exception as e:  # noqa: BLE001
                errors.append(e)
    reader = threading.Thread(target=read)
    reader.start()
    for k in range(6):
        store.write(spark.range(100 * (k + 2)), "Silver", "t")
    stop.set(), reader.join()
    assert not errors and set(seen) <= {100 * k for k in range(1, 8)} and seen


def test_append_of_a_batch_counts_once(spark, store):
    for batch in ("a", "b", "a", "b", "a"):
        store.write(spark.range(3), "Bronze", "t", mode="append", batch=batch)
    assert store.read("Bronze", "t").count() == 6
    one, two = store.run(), store.run()
    one.write(spark.range(1), "Bronze", "t", mode="append", batch="c")
    two.write(spark.range(1), "Bronze", "t", mode="append", batch="c")            # both began before either committed
    one.publish_all(), two.publish_all()
    assert store.read("Bronze", "t").count() == 7
    store.write(spark.range(2), "Bronze", "t")
    store.write(spark.range(3), "Bronze", "t", mode="append", batch="a")          # a new table: the batch is new
    assert store.read("Bronze", "t").count() == 5


def test_vacuum_keeps_what_is_named_or_young(spark, store, tmp_path):
    for k in range(4):
        store.write(spark.range(k + 1), "Silver", "t")
    folders = lambda: len(list((tmp_path / "lake" / "_data").iterdir()))
    assert store.vacuum(keep=2) == 0 and folders() == 4                           # young
    assert store.vacuum(keep=2, grace_seconds=-5) == 2 and folders() == 2
    assert store.read("Silver", "t").count() == 4 and store.read("Silver", "t", version=3).count() == 3


def test_a_failing_job_publishes_none_of_its_tables(spark, store, monkeypatch):
    """All 16 tables of a run appear together; a job that stops at the ninth leaves the run before."""
    land_driver_bronze(DriverTables(spark, SF_SMALL), LayerStore(spark, f"{store.root}/raw"))
    raw = LayerStore(spark, f"{store.root}/raw")
    with store.run() as run:
        for name in ("users", "spaces", "time_entries"):
            run.write(raw.read(J.BRONZE, name), J.BRONZE, name)
    tables = ["users", "spaces", "time_entries"]
    with store.run() as run:
        J.run(spark, run, RUN_TS, tables=tables)
    before, version = {n: rows(store.read(J.SILVER, n)) for n in tables}, store.version()
    assert before["users"] == rows(P.users(raw.read(J.BRONZE, "users"))) and version == 2
    monkeypatch.setattr(P, "time_entries", lambda *_: failing(spark))
    with pytest.raises(Exception), store.run() as run:
        J.run(spark, run, RUN_TS, tables=tables)
    assert store.version() == version and {n: rows(store.read(J.SILVER, n)) for n in tables} == before


def test_one_pass_to_two_tables(spark, store):
    rows_in = spark.range(10).select("id", (F.col("id") % 3).cast("int").alias(TAG))
    with store.run() as run:
        run.write_tagged(rows_in, {"0": ("S", "a", None), "1": ("S", "b", None), "2": ("S", "c", "f"), "9": ("S", "none", None)})
    assert [store.read("S", t).count() for t in ("a", "b", "c", "none")] == [4, 3, 3, 0]
    assert store.read("S", "a").columns == ["id"] and store.read("S", "none").columns == ["id"]
    with pytest.raises(Exception, match="tagged for no table"), store.run() as run:
        run.write_tagged(rows_in, {"0": ("S", "a", None)})


# ------------------------------------------------------------- the catalog

def test_failed_catalog_refresh_leaves_the_old_rows(spark):
    store = CatalogStore(spark)
    store.write(spark.range(5), "Silver", "argent_refresh")
    with pytest.raises(Exception, match="stop"):
        store.write(failing(spark), "Silver", "argent_refresh")
    assert store.read("Silver", "argent_refresh").count() == 5
    store.write(store.read("Silver", "argent_refresh").where("id > 0"), "Silver", "argent_refresh")   # from itself
    assert store.read("Silver", "argent_refresh").count() == 4
    store.write(spark.range(3).selectExpr("id", "'x' AS name"), "Silver", "argent_refresh", folder="f")   # another schema
    assert store.read("Silver", "argent_refresh").columns == ["id", "name"]
    for k in range(3):
        store.write(spark.range(k).selectExpr("id", "'x' AS name"), "Silver", "argent_refresh")
    assert store.read("Silver", "argent_refresh").count() == 2
    names = [r.tableName for r in spark.sql("SHOW TABLES IN silver").collect()]
    assert not [n for n in names if "__new_" in n or "__old_" in n]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_tables_meet_without_an_exchange(spark):
    t = DriverTables(spark, SF_SMALL)
    store = CatalogStore(spark, buckets={name: (column, 16) for name, column in J.BUCKET_COLUMNS.items()})
    plain = P.sales(t.sales(), t.sales_details(), RUN_TS)
    for name, df in {"sales": t.sales(), "sales_details": t.sales_details()}.items():
        store.write(df, "Bronze", name)
    stored = P.sales(store.read("Bronze", "sales", B.SALES), store.read("Bronze", "sales_details", B.SALES_DETAILS), RUN_TS)
    assert "Exchange" not in plan_of(stored) and rows(stored) == rows(plain)
    payable, receivable = P.accounts_payable(t.payables(), RUN_TS), P.accounts_receivable(t.receivables(), RUN_TS)
    categories = P.categories(t.categories(), RUN_TS)
    for name, df in {"accounts_payable": payable, "accounts_receivable": receivable, "categories": categories}.items():
        store.write(df, "Silver", name)
    read = lambda n: store.read("Silver", n)
    joined = P.combined_accounts(read("accounts_payable"), read("accounts_receivable"), read("categories"),
                                 broadcast=False, bucketed=True)
    lines = plan_of(joined).splitlines()
    for name in ("accounts_payable", "accounts_receivable"):                      # no exchange between a scan and the union
        at = scan = next(k for k, line in enumerate(lines) if "FileScan" in line and f".{name}[" in line)
        assert "Bucketed: true" in lines[scan]
        while "Union" not in lines[at]:
            depth = lines[at].index("- ")
            at = next(k for k in range(at - 1, -1, -1) if lines[k].index("- ") < depth)
            assert "Exchange" not in lines[at]
    assert rows(joined) == rows(P.combined_accounts(payable, receivable, categories))
    built = J.builders(store, RUN_TS)["combined_accounts"]()
    assert rows(built) == rows(joined)


def test_buckets_of_a_refresh_an_append_and_a_hot_key(spark):
    store = CatalogStore(spark, buckets={"Silver.argent_buckets": ("k", 8)})
    spread = spark.range(800).selectExpr("id", "id % 80 AS k")
    write = lambda df, **how: store.write(df, "Silver", "argent_buckets", **how)
    read = lambda: store.read("Silver", "argent_buckets")
    grouped = lambda: plan_of(read().groupBy("k").count())
    write(spread)
    assert store.bucketed("Silver", "argent_buckets") == ("k", 8) and "Exchange" not in grouped()
    write(spread.where("id < 400"))                                               # the same buckets elsewhere
    write(spread.where("id >= 400"), mode="append")
    assert "Exchange" not in grouped() and rows(read()) == rows(spread)
    for hot in (F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("k")), F.when(F.col("id") % 3 != 0, F.col("k"))):
        skewed = spread.withColumn("k", hot.cast("long"))
        write(skewed)                                                             # a third on one key, or on none
        assert store.bucketed("Silver", "argent_buckets") is None and "Exchange" in grouped()
        assert rows(read()) == rows(skewed)
    write(read().where("k < 40"))                                                 # from itself, in buckets again
    assert store.bucketed("Silver", "argent_buckets") == ("k", 8)
    assert rows(read()) == rows(skewed.where("k < 40"))
    write(spread.where("false"))
    assert read().count() == 0 and store.bucketed("Silver", "argent_buckets") == ("k", 8)
    write(spread)
    CatalogStore(spark).write(spread.where("id < 10"), "Silver", "argent_buckets")   # a store that asks for none
    assert store.bucketed("Silver", "argent_buckets") is None and read().where("k = 3").count() == 1
    with pytest.raises(ValueError, match="not measured"):
        CatalogStore(spark, buckets={"Silver.argent_buckets": ("k", 8)}).write(
            spark.range(3).selectExpr("id", "array(id) AS k"), "Silver", "argent_buckets")
    with pytest.raises(Exception, match="stop"):
        write(failing(spark).selectExpr("id", "id AS k"))
    assert read().count() == 10
    assert not [r.tableName for r in spark.sql("SHOW TABLES IN silver").collect() if "__new_" in r.tableName]


# ---------------------------------------------------------- drifted files

def test_files_of_differing_types_are_read_by_name(spark, tmp_path):
    where = str(tmp_path / "t")
    spark.sql("SELECT 1 AS id, named_struct('a', 1, 'b', 'x') AS s").write.parquet(where)
    spark.sql("SELECT '2' AS id, named_struct('b', 'y') AS s").write.mode("append").parquet(where)
    spark.sql("SELECT CAST(3 AS BIGINT) AS id, named_struct('a', '7.0', 'b', 'z', 'c', 1) AS s, 'new' AS late").write.mode("append").parquet(where)
    spark.sql("SELECT 4 AS id, CAST(NULL AS STRUCT<a: INT, b: STRING>) AS s").write.mode("append").parquet(where)
    schema = T.StructType.fromDDL("id int, s struct<a: int, b: string>, late string")
    got = sorted(read_declared(spark, [where], schema).collect())
    assert [tuple(r) for r in got] == [(1, (1, "x"), None), (2, (None, "y"), None), (3, (7, "z"), "new"), (4, None, None)]
    files = spark.read.parquet(where).inputFiles()
    assert len(schema_groups(spark, sorted(files))) == 3                          # the two integer files are one group
    with pytest.raises(ValueError, match="s.d"):
        read_declared(spark, [where], T.StructType.fromDDL("id int, s struct<d: int>"))
    assert LayerStore(spark, str(tmp_path)).path("a", "b") and fitted(T.IntegerType(), T.LongType()) is None


# ------------------------------------------------------------- landing

def test_nested_landing_sets_rejects_aside(spark, store, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    good = [{"id": k, "who": {"name": f"n{k}"}, "items": [{"q": k}, {"q": None}]} for k in range(20)]
    lines = [json.dumps(g) for g in good] + ['{"id": 99, "who": {"name"', "[1", '{"id": "text", "who": {"name": "b"}}', "", "  ", "{}"]
    (raw / "a.json").write_text("\n".join(lines[:13]) + "\n")
    (raw / "b.json").write_text("\n".join(lines[13:]))
    schema = T.StructType.fromDDL("id int, who struct<name: string>, items array<struct<q: int>>")
    got = store.land(str(raw), "Bronze", "orders", schema, folder="f")
    assert got.count() == 21 and got.where("id = 7").select("who.name", "items.q").first() == ("n7", [7, None])
    bad = sorted(store.rejects("Bronze", "orders").collect(), key=lambda r: r.place)
    assert [r.raw for r in bad] == lines[20:23] and all(r.file.endswith("b.json") and r.split == 0 for r in bad)
    assert [r.reason for r in bad] == ["not a JSON object"] * 2 + ["a field does not fit its declared type"]
    assert store.version() == 1
    (raw / "b.json").unlink()
    assert store.land(str(raw), "Bronze", "orders", schema).count() == 13 and store.rejects("Bronze", "orders").count() == 0


def test_files_that_differ_are_drawn_once(spark, monkeypatch):
    """The draw is a stored column, hashed from the values and not from their JSON text."""
    kept, whole = [], Q.materialize
    monkeypatch.setattr(Q, "materialize", lambda df: (kept.append(df), whole(df))[1])
    assert Q.bronze_mixed_files(spark, SF_SMALL).count() == 3
    assert len(kept) == 4
    for df in kept:
        assert "argent_some" in df.columns and "to_json" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_raw_files_are_gzipped_and_bounded(spark, monkeypatch, tmp_path):
    """Raw lines keep a fraction of their size on disk, and a file is no more than a task may read."""
    folder = str(tmp_path / "run")
    monkeypatch.setattr(Q, "run_folder", lambda _: folder)
    monkeypatch.setattr(Q, "RAW_RECORDS", 400)
    got = {r.table_name: r.row_count for r in Q.landing_nested(spark, SF_SMALL).collect()}
    files = list((tmp_path / "run" / "landing").rglob("part-*"))
    lines = [len(gzip.open(f).readlines()) for f in files]
    assert files and all(f.name.endswith(".gz") for f in files) and max(lines) <= 400
    t = DriverTables(spark, SF_SMALL)
    customers = t.table("customer").count()
    assert sum(lines) == t.time_entries().count() + t.installments().count() + 2 * customers
    assert got["rejects"] == 2 * customers and got["installments"] == t.installments().count()
