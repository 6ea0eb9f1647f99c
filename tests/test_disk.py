"""What kept tables and joins over bins leave on disk."""

import glob
import time

import pytest
from test_plans import SF

from strandflow import scratch
from strandflow.operators import copynumber, intervals
from strandflow.plans import event_queries


def tables(spark):
    return len(glob.glob(f"{scratch.shared_dir(spark).removeprefix('file://')}/{spark.sparkContext.applicationId}/*"))


def shuffled(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(i).getName().startswith("shuffle_") for i in range(files.size()))


def test_kept_tables_leave_no_shuffle_files(spark):
    before = shuffled(spark)
    d = scratch.kept(spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count())
    ends = time.time() + 20
    while shuffled(spark) > before and time.time() < ends:
        time.sleep(0.2)
    assert shuffled(spark) <= before and d.count() == 7
    assert spark.conf.get(scratch.CLEAN) == "false"


def test_a_step_keeps_its_result_only(spark):
    before = tables(spark)
    d = scratch.step(lambda: intervals.merge(spark.createDataFrame([("a", 0, 5), ("a", 4, 9)], "grp string, s long, e long")))
    assert [tuple(r) for r in d.collect()] == [("a", 0, 9, 2)] and tables(spark) == before + 1


@pytest.mark.parametrize("name, most", [("event_summary", 10), ("event_strata", 2)])
def test_evaluation_keeps_few_tables(spark, name, most):
    before = tables(spark)
    event_queries.QUERIES[name](spark, SF)
    assert tables(spark) <= before + most


def test_rare_wide_intervals_add_no_level(spark):
    assert intervals._used({6: (1000, 3000), 12: (3, 6000)}, {6: (1000, 3000)}) == [6]
    # wide ones that would more than double their side keep their own level, as do those too many to split
    assert intervals._used({6: (1000, 3000), 30: (1, 1 << 29)}, {6: (1000, 3000)}) == [6, 30]
    assert intervals._used({12: (3, 6000)}, {6: (9, 30)}) == [6, 12]
    assert intervals._used({}, {}) == [intervals.LEVELS[0]]
    short = spark.range(2000).selectExpr("'a' AS grp", "id * 3 AS s", "id * 3 + 2 AS e")
    wide = spark.createDataFrame([("a", 100, 4000), ("a", -70, 1)], "grp string, s long, e long")
    j = intervals.overlap_join(short.unionByName(wide), short)
    want = 2000 + sum(3 * i < e and s < 3 * i + 2 for s, e in ((100, 4000), (-70, 1)) for i in range(2000))
    assert j.count() == j.distinct().count() == want
    assert "level" not in j.columns and j._jdf.queryExecution().analyzed().toString().count("Union") == 1


def test_no_strata_give_no_stats(spark):
    t, c, r = event_queries._events(spark, SF)
    strata = r.selectExpr("'x' AS stratum", "grp", "s", "e")
    assert [d.count() for d in copynumber.stratified(t, c, strata, [], **event_queries.OPTIONS)] == [0, 0]
