"""Queries of coverage, duplicates, read metrics and consensus on the given tables, with their DuckDB SQL. Lines stand for reads."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import coverage, reads
from .queries import DAY, SPANS, lines, spans

CIGARS = ("50M", "5S45M", "3H2S40M2D3I5M", "45M3S2H")
#: Bases on the reference, and clipped ones before and behind, of CIGARS.
LENGTHS = ((50, 0, 0), (45, 5, 0), (47, 5, 0), (45, 0, 5))


def _targets(spark, sf: str):
    """A stretch of forty days on one supplier for each order."""
    s = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    o = spark.read.parquet(f"{sf}/orders.parquet")
    return o.select((F.col("o_custkey") % 100).alias("grp"), s.alias("s"), (s + 40).alias("e"), F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"))


def coverage_targets(spark, sf):
    """Mean, quartiles and shares of depth for each target."""
    h = coverage.depth_histogram(coverage.depth_runs(spans(spark, sf)), _targets(spark, sf), "id")
    return coverage.depth_summary(h, ["id"], (1, 5, 20))


def coverage_groups(spark, sf):
    """The same for all targets of a status and supplier together."""
    h = coverage.depth_histogram(coverage.depth_runs(spans(spark, sf)), _targets(spark, sf), "grp", "status")
    return coverage.depth_summary(h, ["grp", "status"], (1, 5, 20))


TARGETS = "(SELECT o_custkey % 100 AS grp, date_diff('day', DATE '1970-01-01', o_orderdate::DATE) AS s, date_diff('day', DATE '1970-01-01', o_orderdate::DATE) + 40 AS e, o_orderkey AS id, o_orderstatus AS status FROM orders)"


def coverage_sql(by: str) -> str:
    """Every day of every span and target as a row."""
    cols = ", ".join(f"quantile_disc(depth, {q}) AS q{round(100 * q)}" for q in (0.25, 0.5, 0.75))
    over = ", ".join(f"avg((depth >= {k})::INT) AS over_{k}" for k in (1, 5, 20))
    return f"""WITH d AS (SELECT grp, d, count(*) AS depth FROM (SELECT grp, unnest(range(s, e)) AS d FROM {SPANS}) GROUP BY grp, d),
  t AS (SELECT *, unnest(range(s, e)) AS d FROM {TARGETS}), j AS (SELECT t.*, coalesce(depth, 0) AS depth FROM t LEFT JOIN d ON d.grp = t.grp AND d.d = t.d)
SELECT {by}, count(*) AS bases, avg(depth) AS mean, {cols}, {over} FROM j GROUP BY {by}"""


def _reads(spark, sf: str):
    """Two reads of a name where an order has them, at coarse places, clipped in four ways."""
    q = F.col("l_quantity").cast("int")
    d = lines(spark, sf).withColumns({"q": q, "k": q % 4, "p": F.col("l_partkey").cast("int")})
    lead = F.when(F.col("k").isin(1, 2), 5).otherwise(0)
    gone = (F.col("l_returnflag") == "A") & (q % 5 == 0)
    n = 10 + q % 5
    seq = F.substring(F.repeat(F.lit("ACGTTGCA"), F.lit(4)), (F.col("p") % 3 + q % 4 + 1), n)
    sign = lambda x: F.char(x + 33)
    qual = F.concat(F.repeat(sign(q % 41), F.lit(5)), F.repeat(sign(F.col("p") % 41), n - 5))
    return d.select(
        "l_orderkey", "l_linenumber", F.concat_ws("-", "l_orderkey", F.floor((F.col("l_linenumber") - 1) / 2)).alias("name"), F.when(~gone, F.concat(F.lit("c"), (F.col("grp") % 3).cast("string"))).alias("chrom"),
        (F.floor(F.col("s") / 300) * 100 + lead).alias("pos"), F.when(gone, "*").otherwise(F.get(F.array(*map(F.lit, CIGARS)), F.col("k"))).alias("cigar"), (F.col("l_linestatus") == "O").alias("reverse"), seq.alias("seq"), qual.alias("qual"),
        (F.col("p") % 2).alias("library"), (F.col("p") % 300 - 50).alias("insert"),
    )


READS = f"""b AS (SELECT *, l_quantity::INT AS q, l_quantity::INT % 4 AS k, l_partkey::INT AS p, l_orderkey || '-' || (l_linenumber - 1) // 2 AS name, l_returnflag = 'A' AND l_quantity::INT % 5 = 0 AS gone, l_linestatus = 'O' AS reverse, {DAY} // 300 * 100 AS place FROM lineitem),
  r AS (SELECT *, 10 + q % 5 AS n, CASE WHEN NOT gone THEN 'c' || (l_suppkey % 3) END AS chrom, {[list(x) for x in LENGTHS]}[k + 1] AS x, CASE WHEN k IN (1, 2) THEN place + 5 ELSE place END AS pos,
    substr(repeat('ACGTTGCA', 4), p % 3 + q % 4 + 1, 10 + q % 5) AS seq, repeat(chr(q % 41 + 33), 5) || repeat(chr(p % 41 + 33), 5 + q % 5) AS qual FROM b),
  e AS (SELECT *, CASE WHEN gone THEN NULL WHEN reverse THEN pos + x[1] + x[3] - 1 ELSE pos - x[2] END AS five, CASE WHEN q % 41 >= 15 THEN 5 * (q % 41) ELSE 0 END + CASE WHEN p % 41 >= 15 THEN (n - 5) * (p % 41) ELSE 0 END AS score FROM r)"""


def duplicates_marked(spark, sf):
    return reads.marked(_reads(spark, sf), "library").select("l_orderkey", "l_linenumber", "duplicate")


def duplicates_removed(spark, sf):
    """What stays, by contig and library, unaligned reads included."""
    d = reads.without_duplicates(_reads(spark, sf), "library")
    return d.groupBy(F.coalesce("chrom", F.lit("*")).alias("chrom"), "library").agg(F.count("*").alias("n"), F.sum("l_orderkey").alias("orders"))


MARKED = f"""{READS}, t AS (SELECT name, list_sort(list((chrom, five, reverse))) AS ends, sum(score) AS score, min(p % 2) AS lib, count(*) AS n FROM e WHERE NOT gone GROUP BY name HAVING count(*) <= 2),
  w AS (SELECT *, row_number() OVER (PARTITION BY lib, n, ends ORDER BY score DESC, name) AS rn FROM t), h AS (SELECT DISTINCT lib, unnest(ends) AS x FROM t WHERE n = 2),
  stay AS (SELECT name FROM w WHERE rn = 1 AND (n = 2 OR NOT EXISTS (SELECT 1 FROM h WHERE h.lib = w.lib AND h.x = w.ends[1]))),
  m AS (SELECT e.*, NOT gone AND name IN (SELECT name FROM t) AND name NOT IN (SELECT name FROM stay) AS duplicate FROM e)"""


def read_metrics(spark, sf):
    return reads.metrics(_reads(spark, sf))


READ_METRICS = f"""WITH {READS}, c AS (SELECT *, unnest(range(1, n + 1)) AS i FROM r),
  y AS (SELECT i, CASE WHEN reverse THEN n + 1 - i ELSE i END AS cycle, CASE WHEN i <= 5 THEN q % 41 ELSE p % 41 END AS z FROM c)
SELECT 'quality_by_cycle' AS metric, cycle::VARCHAR AS key, count(*) AS n, sum(z)::BIGINT AS total FROM y GROUP BY cycle UNION ALL SELECT 'quality', z::VARCHAR, count(*), NULL FROM y GROUP BY z
UNION ALL SELECT 'gc', (100 * length(regexp_replace(seq, '[^GC]', '', 'g')) // n)::VARCHAR, count(*), NULL FROM r GROUP BY 2
UNION ALL SELECT 'insert_size', (p % 300 - 50)::VARCHAR, count(*), NULL FROM r WHERE p % 300 > 50 GROUP BY 2
UNION ALL SELECT 'alignment', k, v, NULL FROM (SELECT unnest(['reads', 'aligned', 'reverse', 'bases', 'aligned_bases', 'inserted_bases', 'deleted_bases', 'clipped_bases']) AS k,
  unnest([count(*), count(*) FILTER (NOT gone), count(*) FILTER (NOT gone AND reverse), sum(n)::BIGINT, (sum([50, 45, 45, 45][k + 1]) FILTER (NOT gone))::BIGINT, 3 * count(*) FILTER (NOT gone AND k = 2), 2 * count(*) FILTER (NOT gone AND k = 2), 5 * count(*) FILTER (NOT gone AND k > 0)]) AS v FROM r) WHERE v > 0"""


def umi_consensus(spark, sf):
    """One read for each family of tags at a place: tags of three bases, of which neighbours follow more frequent ones."""
    d = reads.with_ends(_reads(spark, sf)).filter("five IS NOT NULL")
    d = d.withColumns(reads.structured(F.concat(F.translate(F.right(F.concat(F.lit("00"), F.col("l_orderkey").cast("string")), F.lit(3)), "0123456789", "ACGTACGTAC"), F.col("seq")), F.concat(F.lit("III"), F.col("qual")), "2M1S+T"))
    d = d.withColumn("tag", F.concat("tag", F.substring("seq", 1, 1)))
    families = reads.tag_families(d.select("chrom", "five", "tag", F.lit(1).alias("n")), "chrom", "five")
    j = d.drop("seq", "qual").withColumnsRenamed({"template": "seq", "template_qual": "qual"}).join(families.drop("n"), ["chrom", "five", "tag"])
    return reads.consensus(j, "chrom", "five", "family")


UMI_CONSENSUS = f"""WITH RECURSIVE {READS}, u AS (SELECT chrom, five, left(translate(right('00' || l_orderkey, 3), '0123456789', 'ACGTACGTAC'), 2) || left(seq, 1) AS tag, l_orderkey, seq, qual, n FROM e WHERE NOT gone),
  v AS (SELECT chrom, five, tag, count(*) AS c FROM u GROUP BY ALL),
  f AS (SELECT a.chrom, a.five, a.tag, arg_min(b.tag, (-b.c, b.tag)) AS up FROM v a JOIN v b ON a.chrom = b.chrom AND a.five = b.five AND length(a.tag) = length(b.tag) AND a.tag <> b.tag AND hamming(a.tag, b.tag) = 1 AND b.c >= 2 * a.c - 1 AND (b.c > a.c OR b.tag < a.tag) GROUP BY ALL),
  g AS (SELECT chrom, five, tag, tag AS family FROM v UNION ALL SELECT g.chrom, g.five, g.tag, f.up FROM g JOIN f ON f.chrom = g.chrom AND f.five = g.five AND f.tag = g.family),
  h AS (SELECT chrom, five, tag, family FROM g WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.chrom = g.chrom AND f.five = g.five AND f.tag = g.family)),
  x AS (SELECT chrom, five, family, seq, qual, unnest(range(1, n + 1)) AS i FROM u JOIN h USING (chrom, five, tag)),
  y AS (SELECT chrom, five, family, i, substr(seq, i, 1) AS b, sum(ascii(substr(qual, i, 1)) - 33) AS w, count(*) AS c FROM x GROUP BY ALL),
  z AS (SELECT chrom, five, family, i, arg_min(b, (-w, b)) AS b, least(greatest(2 * max(w) - sum(w), 2), 60)::INT AS q, sum(c) AS c FROM y GROUP BY ALL)
SELECT chrom, five, family, string_agg(b, '' ORDER BY i) AS seq, string_agg(chr(q + 33), '' ORDER BY i) AS qual, arg_min(c, i)::BIGINT AS reads FROM z GROUP BY chrom, five, family"""

QUERIES = {f.__name__: f for f in (coverage_targets, coverage_groups, duplicates_marked, duplicates_removed, read_metrics, umi_consensus)}
ORACLES = {
    "coverage_targets": coverage_sql("id"),
    "coverage_groups": coverage_sql("grp, status"),
    "duplicates_marked": f"WITH {MARKED} SELECT l_orderkey, l_linenumber, duplicate FROM m",
    "duplicates_removed": f"WITH {MARKED} SELECT coalesce(chrom, '*') AS chrom, p % 2 AS library, count(*) AS n, sum(l_orderkey)::BIGINT AS orders FROM m WHERE NOT duplicate GROUP BY ALL",
    "read_metrics": READ_METRICS,
    "umi_consensus": UMI_CONSENSUS,
}
