"""Ordered interval steps and coverage over many ranges, against plain versions."""

import random

import pytest
from pyspark.sql import functions as F

from strandflow.operators import coverage, intervals, ranges

SCHEMA = "grp string, s long, e long"


@pytest.fixture(autouse=True)
def many_ranges(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def made(seed, n, groups="aab"):
    r = random.Random(seed)
    return [(r.choice(groups), s, s + r.choice([0, 1, 3, 9, 40])) for s in (r.randrange(0, 400) for _ in range(n))]


def covered(rows):
    out = {}
    for g, s, e in rows:
        for x in range(s, e):
            out[g, x] = out.get((g, x), 0) + 1
    return out


def stretches(places):
    out = []
    for g, x in sorted(places):
        if out and out[-1][0] == g and out[-1][2] == x:
            out[-1][2] = x + 1
        else:
            out.append([g, x, x + 1])
    return [tuple(o) for o in out]


@pytest.mark.parametrize("seed", [1, 2])
def test_sweeps(spark, seed):
    a, b = made(seed, 150), made(seed + 10, 60)
    x, y = spark.createDataFrame(a, SCHEMA), spark.createDataFrame(b, SCHEMA)
    in_a, in_b = covered(a), covered(b)
    assert sorted(map(tuple, intervals.intersect(x, y).collect())) == stretches(set(in_a) & set(in_b))
    assert sorted(map(tuple, intervals.subtract(x, y).collect())) == stretches(set(in_a) - set(in_b))
    assert sorted((r.grp, r.s, r.e) for r in intervals.merge(x.filter("s < e")).collect()) == stretches(in_a)
    depth = {(r.grp, p): r.depth for r in coverage.depth_runs(x).collect() for p in range(r.s, r.e)}
    assert depth == in_a


def test_runs_and_components(spark):
    rows = made(3, 200)
    got = intervals.runs(spark.createDataFrame(rows, SCHEMA), touching_joins=False).collect()
    want, top, n = {}, {}, {}
    for g, s, e in sorted(rows):
        if g not in top or s >= top[g]:
            n[g] = n.get(g, 0) + 1
        top[g] = max(top.get(g, e), e)
        want.setdefault((g, s, e), []).append(n[g])
    assert sorted((r.grp, r.s, r.e, r.run) for r in got) == sorted((*k, v) for k, x in want.items() for v in x)


def test_containing(spark):
    spans = [("a", i * 10, i * 10 + 6) for i in range(60)] + [("b", 5, 5), ("b", 100, 900)]
    points = [("a", p, p) for p in range(-3, 620, 3)] + [("b", 5, 1), ("b", 899, 2), ("b", 900, 3), ("c", 1, 4), (None, 7, 5), ("a", None, 6)]
    got = intervals.containing(spark.createDataFrame(points, "grp string, at long, tag int"), spark.createDataFrame(spans, SCHEMA))
    want = [(g, p, t, next((s for h, s, e in spans if p is not None and h == g and s <= p < e), None)) for g, p, t in points]
    assert sorted(map(str, ((r.grp, r["at"], r.tag, r.phase) for r in got.collect()))) == sorted(map(str, want))


def test_a_hot_group_and_a_hot_place_are_spread(spark):
    d = spark.range(40_000, numPartitions=4).selectExpr("'a' AS grp", "if(id % 2 = 0, 5, id) AS s", "id + 7 AS e")
    sizes = [r["count"] for r in ranges.by_rows(d, "s", "e").groupBy("part").count().collect()]
    assert len(sizes) >= 8 and max(sizes) < 3 * 40_000 / 16
    lines = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet").select(F.lit(1).alias("grp"), F.datediff("l_shipdate", F.lit("1970-01-01")).alias("s"), F.col("l_orderkey").alias("e"))
    assert ranges.by_rows(lines, "s", "e").select("part").distinct().count() >= 8


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert intervals.merge(none).count() == intervals.intersect(none, none).count() == coverage.depth_runs(none).count() == 0


def test_depth_summary(spark):
    rows = made(5, 80)
    targets = [(g, s, s + 30, n) for n, (g, s, _) in enumerate(made(6, 25, "abc"))] + [("a", 5, 5, 99)]
    h = coverage.depth_histogram(coverage.depth_runs(spark.createDataFrame(rows, SCHEMA)), spark.createDataFrame(targets, SCHEMA + ", id int"), "id")
    got = {r.id: (r.bases, r.mean, r.q50, r.over_2) for r in coverage.depth_summary(h, ["id"], (2,), (0.5,)).collect()}
    in_a = covered(rows)
    for g, s, e, n in targets:
        d = sorted(in_a.get((g, x), 0) for x in range(s, e))
        want = (len(d), sum(d) / len(d), d[(len(d) + 1) // 2 - 1], sum(x >= 2 for x in d) / len(d)) if d else (0, None, None, None)
        assert got[n] == pytest.approx(want), n


def test_small_side_as_arrays(spark):
    from strandflow.operators import interval_index

    a, b = made(21, 300, "aabc") + [("a", -5, 500)], made(22, 120, "abd") + [("a", 0, 390), (None, 1, 2), ("a", None, 3)]
    x = spark.createDataFrame([(*r, i) for i, r in enumerate(a)], SCHEMA + ", id int").repartition(3)
    y = spark.createDataFrame([(*r, f"n{i}") for i, r in enumerate(b)], SCHEMA + ", name string")
    small, large = interval_index.small_overlap_join(x, y), interval_index.small_overlap_join(x, y, most_rows=5)
    rows = lambda d: sorted((r["grp"], r["as"], r["ae"], r["a_id"], r["bs"], r["be"], r["b_name"], r["overlap"]) for r in d.collect())
    assert sorted(small.columns) == sorted(large.columns) and rows(small) == rows(large) and len(rows(small)) > 500
    plan = lambda d: d._jdf.queryExecution().executedPlan().toString()
    only = interval_index.small_overlap_join(spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").selectExpr("'a' AS grp", "l_orderkey AS s", "l_orderkey + 3 AS e"), y)
    assert "Exchange" not in plan(only) and "MapInArrow" in plan(only)
    assert interval_index.small_overlap_join(x, y.limit(0)).count() == 0 == interval_index.small_overlap_join(x.limit(0), y).count()
