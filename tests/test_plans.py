"""Every plan query against DuckDB on the smallest tables, and small fixtures of the operators."""

import glob
import os

import duckdb
import pytest

from strandflow.operators import intervals, tags
from strandflow.plans.queries import ORACLES, QUERIES
from strandflow.sources import text

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


def rounded(rows):
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    rel = duck.sql(ORACLES[name])
    cols = sorted(df.columns)
    assert cols == sorted(rel.columns)
    got = rounded(tuple(r[c] for c in cols) for r in df.collect())
    want = rounded(duck.sql(f"SELECT {', '.join(cols)} FROM ({ORACLES[name]})").fetchall())
    assert got == want


def spans(spark, rows):
    return spark.createDataFrame(rows, "grp string, s long, e long")


def test_touching_rule(spark):
    d = spans(spark, [("a", 0, 5), ("a", 5, 7), ("a", 1, 2), ("b", 3, 4)])
    assert {tuple(r) for r in intervals.merge(d).collect()} == {("a", 0, 7, 3), ("b", 3, 4, 1)}
    assert {tuple(r) for r in intervals.merge(d, False).collect()} == {("a", 0, 5, 2), ("a", 5, 7, 1), ("b", 3, 4, 1)}


def test_subtract_and_intersect(spark):
    a, b = spans(spark, [("a", 0, 10), ("b", 0, 3)]), spans(spark, [("a", 2, 3), ("a", 9, 12), ("c", 0, 9)])
    assert {tuple(r) for r in intervals.subtract(a, b).collect()} == {("a", 0, 2), ("a", 3, 9), ("b", 0, 3)}
    assert {tuple(r) for r in intervals.intersect(a, b).collect()} == {("a", 2, 3), ("a", 9, 10)}


def test_tags_ignore_missing_values_and_unset_parameters(spark):
    rules = [("low", ("t",), lambda t: intervals.F.col("q") < t), ("high", ("u",), lambda u: intervals.F.col("q") > u)]
    d = spark.createDataFrame([(1.0, ["PASS"]), (None, ["old"]), (9.0, None)], "q double, filter array<string>")
    got = [r.filter for r in tags.tagged(d, rules, {"t": 2.0, "u": None}, clear=["old"]).collect()]
    assert got == [["low"], ["PASS"], ["PASS"]]


def test_readers(spark, tmp_path):
    (tmp_path / "a.bed").write_text("#x\ntrack y\nchr1\t0\t5\tz\nchr1\t7\nchr2\t1\t2\n")
    assert [tuple(r) for r in text.read_bed(spark, str(tmp_path / "a.bed")).collect()] == [("chr1", 0, 5), ("chr2", 1, 2)]
    (tmp_path / "a.vcf").write_text("##f\n#CHROM\nchr1\t10\t.\tAC\tA,T\t50\tPASS\tDP=3;STR\tGT:AD\t0/1:3,4\n")
    r = text.read_vcf(spark, str(tmp_path / "a.vcf")).first()
    assert (r.pos, r.end, r.alt, r.info["DP"], r.info["STR"], r.samples[0]["AD"]) == (9, 11, ["A", "T"], "3", None, "3,4")
