"""Variant, neighbour and index operators: queries against DuckDB, plain versions and small fixtures."""

import glob
import os
import random
import struct

import duckdb
import pytest
from pyspark.sql import functions as F

from strandflow.operators import evaluation, neighbours, positional, tags, variants
from strandflow.plans import record_queries
from strandflow.plans.variant_queries import ORACLES, QUERIES, _neighbours
from strandflow.sources import index

SF = "/root/testdata/sf0.001"
ORACLES, QUERIES = ORACLES | record_queries.ORACLES, QUERIES | record_queries.QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, name):
    c = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    want = sorted(c.sql(f"SELECT {', '.join(cols)} FROM ({ORACLES[name]})").fetchall(), key=repr)
    assert sorted((tuple(r[x] for x in cols) for r in df.collect()), key=repr) == want and want


def plain_merge(rows, reach):
    """One walk over a whole chromosome, without islands."""
    out, run = [], []

    def close():
        used = set()
        for i, v in enumerate(run):
            if not v.passed or i in used:
                continue
            chain = [i]
            for j in range(i + 1, len(run)):
                a, b = run[chain[-1]], run[j]
                if b.passed and j not in used and not a.sv and not b.sv and b.pos - a.pos < reach + len(a.ref) and a.phase == b.phase and a.phase:
                    chain.append(j)
            members = [run[j] for j in chain]
            if len(chain) > 1 and all(b.pos >= a.pos + len(a.ref) for a, b in zip(members, members[1:])):
                used.update(chain)
                out.append((v.id, len(chain), tuple(m.id for m in members)))
        run.clear()

    for v in rows:
        last = next((u for u in reversed(run) if u.passed), None)
        if last is not None and v.pos - last.pos - len(last.ref) + 1 > reach:
            close()
            last = None
        if last is not None or (v.passed and not v.sv):
            run.append(v)
    close()
    return out


def test_neighbours_equal_a_plain_walk(spark):
    d = _neighbours(spark, SF)
    got = neighbours.merge_neighbours(d).collect()
    want = []
    rows = sorted(d.collect(), key=lambda r: (r.chrom, r.pos, r.id))
    for chrom in sorted({r.chrom for r in rows}):
        want += plain_merge([r for r in rows if r.chrom == chrom], 5)
    assert sorted((r.id, r.members) for r in got if r.members > 1) == sorted(w[:2] for w in want)
    assert {r.id for r in got if r.merged} == {i for w in want for i in w[2]} and want
    assert sum(r.members == 1 for r in got) == len(rows)


def test_neighbour_alleles(spark):
    rows = [("c", 10, 1, "A", "T", "CGTAA", 10.0, True, False, "p"), ("c", 12, 2, "G", "GA", "TTTTT", None, True, False, "p"), ("c", 90, 3, "G", "A", "", 1.0, True, False, "p")]
    d = spark.createDataFrame(rows, neighbours.COLUMNS)
    got = {(r.pos, r.ref, r.alt, r.qual, r.merged, r.members) for r in neighbours.merge_neighbours(d).collect()}
    assert got == {(10, "A", "T", 10.0, True, 1), (12, "G", "GA", None, True, 1), (90, "G", "A", 1.0, False, 1), (10, "ACG", "TCGA", None, False, 2)}
    assert neighbours.merge_neighbours(d.limit(0)).count() == 0


def test_following_bases(spark):
    chunks = spark.createDataFrame([("c", 0, "acgtacgtac"), ("c", 1, "ggtt")], "chrom string, chunk long, seq string")
    d = spark.createDataFrame([("c", 7, "TA"), ("c", 0, "A"), ("x", 0, "A")], "chrom string, pos long, ref string")
    assert {r.pos if r.chrom == "c" else -1: r.after for r in neighbours.following(d, chunks, 10, 3).collect()} == {7: "CGG", 0: "CGT", -1: ""}


def test_alleles(spark):
    d = spark.createDataFrame([("ACC", "AC", [9, 5, 7, 1], ["x", "y", "z"]), ("A", "A", None, ["x"])], "r string, a string, pl array<int>, alt array<string>")
    t = variants.trimmed(F.col("r"), F.col("a"))
    p = variants.padded(F.col("r"), F.lit("T"), F.col("a"), F.lit("G"))
    got = d.select(t.alias("t"), p.alias("p"), variants.best_two(F.col("alt"), F.col("pl")).alias("b")).collect()
    assert [tuple(r.t) for r in got] == [("AC", "A"), ("A", "A")]
    assert (got[0].p.ref, got[0].p.alts) == ("ACC", ["T", "GC"])
    assert [r.b for r in got] == [[3, 1], [1]]


def test_label_rounds_halves_to_even(spark):
    d = spark.createDataFrame([(5.0, 10.0, 2.0, 1), (0.0, 10.0, None, 1), (10.0, 10.0, None, -9)], "overlap double, size double, period double, diff int")
    assert [r.label for r in evaluation.effective_label(d).collect()] == [4, 2, 0]


def test_header(spark):
    old = spark.createDataFrame([("a", "1"), ("b", "2")], "id string, description string")
    new = spark.createDataFrame([("b", "3"), ("c", "4")], "id string, description string")
    assert {tuple(r) for r in tags.header(old, new, ["a"]).collect()} == {("b", "3"), ("c", "4")}


def test_binary_index(spark, tmp_path):
    bins = [(4681, [(0, 3 << 16)]), (4682, [(3 << 16, 5 << 16)]), (585, [(5 << 16, 13 << 16)]), (37450, [(1, 2)])]
    body = b"".join(struct.pack("<II", b, len(c)) + b"".join(struct.pack("<QQ", *x) for x in c) for b, c in bins)
    (tmp_path / "x.bai").write_bytes(b"BAI\1" + struct.pack("<I", 2) + struct.pack("<I", 4) + body + struct.pack("<I2Q", 2, 0, 7) + struct.pack("<II", 0, 0))
    d = index.read_bai(spark, str(tmp_path / "x.bai"))
    assert d.filter("bin IS NULL").count() == 2 and d.filter("bin IS NOT NULL").count() == 4
    assert {(r.tid, r.slot): r.density for r in index.density(d).collect()} == {(0, 0): 7.0, (0, 1): 6.0}
    got = spark.range(1).select(index.region_bins(F.lit(16000).cast("long"), F.lit(17000).cast("long")).alias("b")).first().b
    assert got == [4681, 4682, 585, 73, 9, 1, 0]


def test_region_chunks_of_every_level(spark):
    number = random.Random(4)
    starts = {k: [number.randrange(1 << 29) >> k << k for _ in range(60)] for k in index.SHIFTS}
    rows = [(g, index.first_bin(k) + (a >> k), a + k, a + k + number.randrange(9)) for g in "ab" for k, at in starts.items() for a in at] + [("a", index.NO_BIN, 1, 99), ("a", None, 1, 99), ("a", 4681, 0, 9)]
    wide = [1, 16384, 200_000, 9_000_000, 1 << 26, 300_000_000]
    regions = [(g, i, a, a + w, a % 5) for i, (g, a, w) in enumerate((g, number.randrange(1 << 28), w) for g in "abc" for w in wide for _ in range(4))]
    # past the last place no bin of another level is meant
    regions += [("a", 900, (1 << 29) - 1, (1 << 29) + 5, 0)]
    d = spark.createDataFrame(rows, "grp string, bin long, s long, e long")
    got = index.region_chunks(d, spark.createDataFrame(regions, "grp string, id long, s long, e long, floor long"), ["grp"])

    def meets(b, s, e):
        k = next((k for k in index.SHIFTS if b is not None and index.first_bin(k) <= b <= 8 * index.first_bin(k)), None)
        return k is not None and (b - index.first_bin(k) << k) < e and s < (b - index.first_bin(k) + 1 << k)

    want = [(g, i, cs, ce) for g, i, s, e, floor in regions for h, b, cs, ce in rows if g == h and ce > floor and meets(b, s, e)]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    # bins that regions make are never broadcast: their number is not in Spark's estimate
    plan = got._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("SortMergeJoin") == 1 and plan.count("BroadcastHashJoin") == 1


def test_site_fill(spark):
    variants_ = spark.createDataFrame([("a", 5, 1, "v1"), ("a", 5, 1, "v2"), ("a", 9, 2, "v3")], "grp string, s long, sample int, id string")
    blocks_ = spark.createDataFrame([("a", 0, 6, 1, "b1"), ("a", 0, 10, 2, "b2"), ("a", 4, 8, 2, "b3"), ("a", 9, 9, 3, "b4"), ("b", 0, 99, 3, "b5"), ("a", 5, 6, 4, "b6")], "grp string, s long, e long, sample int, id string")
    got = sorted((r.s, r["sample"], r.source, r.record.id) for r in positional.site_fill(variants_, variants_, blocks_).collect())
    # of two variants the greater record, of two blocks the one that starts last; no row for a sample without a record there
    assert got == [(5, 1, "variant", "v2"), (5, 2, "block", "b3"), (5, 4, "block", "b6"), (9, 2, "variant", "v3")]
    assert positional.site_fill(variants_.limit(0), variants_, blocks_).count() == 0
