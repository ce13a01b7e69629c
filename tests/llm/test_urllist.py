import datetime

from pyspark.sql import functions as F

from argent.llm import urllist as M

D = datetime.date


def test_as_of_edges(spark):
    entries = spark.createDataFrame([
        ("host:a.x.com", D(2024, 1, 10), True), ("host:a.x.com", D(2024, 3, 1), False), ("host:a.x.com", D(2024, 3, 1), True),
        ("host:a.x.com", D(2024, 3, 5), False), ("domain:x.com", D(2024, 2, 1), True), ("path:b.x.com/p", D(2024, 1, 1), True),
        (None, D(2024, 1, 1), True), ("host:c.y.org", None, True), ("host:c.y.org", D(2024, 5, 1), False)],
        "pattern string, day date, block boolean")
    captures = spark.createDataFrame([
        (1, "http://a.x.com/q", D(2024, 1, 9), "k"), (2, "http://A.x.com:80/q", D(2024, 1, 10), "k"), (3, "http://a.x.com", D(2024, 3, 4), None),
        (4, "http://a.x.com", D(2024, 3, 5), ""), (5, "https://b.x.com/p/z?u", D(2024, 1, 31), ""), (5, "https://b.x.com/p/z?u", D(2024, 1, 31), ""),
        (6, None, D(2024, 3, 4), ""), (7, "no url", D(2024, 3, 4), ""), (8, "http://a.x.com", None, ""), (None, "http://c.y.org", D(2024, 6, 1), "")],
        "id long, u string, day date, pattern string")
    out = sorted(((r.id, r.blocked, r.pattern, r.since) for r in M.blocked(captures, entries, "id", "u", "day").collect()), key=repr)
    assert out == sorted([
        (1, False, None, None), (2, True, "host:a.x.com", D(2024, 1, 10)), (3, True, "host:a.x.com", D(2024, 3, 1)),
        (4, True, "domain:x.com", D(2024, 2, 1)), (5, True, "path:b.x.com/p", D(2024, 1, 1)), (5, True, "path:b.x.com/p", D(2024, 1, 1)),
        (6, False, None, None), (7, False, None, None), (8, False, None, None), (None, False, None, None)], key=repr)
    none = entries.limit(0)
    assert not M.blocked(captures, none, "id", "u", "day").filter("blocked").count()
    assert M.blocked(captures.limit(0), entries, "id", "u", "day").count() == 0


def test_shuffle_path_gives_the_same(spark, sf, monkeypatch):
    want = sorted(map(repr, M.op7_url_filters(spark, sf).collect()))
    monkeypatch.setattr(M, "fits_broadcast", lambda df: False)
    df = M.op7_url_filters(spark, sf)
    assert sorted(map(repr, df.collect())) == want
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_a_far_capture_adds_no_rows_between(spark, monkeypatch):
    entries = spark.createDataFrame([(f"host:h{k}.com", D(2024, 1, 10), True) for k in range(20)], "pattern string, day date, block boolean")
    captures = spark.createDataFrame([(1, "http://h1.com", D(2024, 1, 11)), (2, "http://h2.com", D(9999, 12, 31)), (3, "http://h2.com", D(1, 1, 1))],
                                     "id long, u string, day date")
    sizes, landed = [], M.landed
    monkeypatch.setattr(M, "landed", lambda df, name: (out := landed(df, name), sizes.append((name, out.count())))[0])
    out = {r.id: r.blocked for r in M.blocked(captures, entries, "id", "u", "day").collect()}
    assert out == {1: True, 2: True, 3: False} and dict(sizes)["intervals"] == 40   # 20 entries in the 2 later buckets


def test_hosts(spark):
    urls = {"http://user:pw@evil.com/x": ["domain:evil.com", "host:evil.com", "path:evil.com/x"], "HTTP://A.B.co.uk.:80": ["domain:b.co.uk", "host:a.b.co.uk", None],
            "http://10.0.0.1/a": [None, "host:10.0.0.1", "path:10.0.0.1/a"], "http://[::1]:8080/a?b": [None, "host:[::1]", "path:[::1]/a"],
            "http://localhost": [None, "host:localhost", None], "http://co.uk": [None, "host:co.uk", None], "http://": None, "x": None, "http://a@b@c.org": ["domain:c.org", "host:c.org", None]}
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    got = {r.u: r.p for r in df.select("u", M.patterns(F.col("u")).alias("p")).collect()}
    assert got == urls
    assert df.select(M.patterns(F.lit("http://a.b.co.uk"), ["x"])[0].alias("d")).first().d == "domain:co.uk"
