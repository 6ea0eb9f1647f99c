"""Queries of the indexed source and of alleles in normal form on the given tables, with their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import alleles
from ..scratch import fresh
from ..sources import indexed
from .queries import DAY, lines

HEADER = ["##fileformat=VCFv4.2", '##INFO=<ID=END,Number=1,Type=Integer,Description="End">', "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO"]
SPREAD = 40_000
#: Bases of one row of the reference that the queries make of the parts.
WIDTH = 32


def _stored(spark, sf: str, files: int | None = None) -> str:
    """All lines as records, by supplier's last digit and day, in an indexed folder; every seventh is a long one that INFO ends."""
    d = lines(spark, sf).withColumn("long", F.col("l_orderkey") % 7 == 0)
    end = F.when(F.col("long"), F.col("s") * SPREAD + F.col("l_quantity").cast("long") * 100_000).otherwise(F.col("s") * SPREAD + F.col("l_linenumber"))
    d = d.select(
        F.concat(F.lit("c"), (F.col("grp") % 10).cast("string")).alias("chrom"), (F.col("s") * SPREAD + F.col("l_partkey") % 1000).alias("pos"), end.alias("stop"), "long",
        F.col("l_orderkey").cast("string").alias("id"), F.repeat(F.lit("A"), F.col("l_linenumber")).alias("ref"), F.array(F.lit("C")).alias("alt"), F.col("l_quantity").cast("double").alias("qual"),
    )
    none = F.array().cast("array<string>")
    info = F.when(F.col("long"), F.create_map(F.lit("END"), F.col("stop").cast("string"))).otherwise(F.create_map().cast("map<string,string>"))
    d = d.select("chrom", "pos", F.when(F.col("long"), F.col("stop")).otherwise(F.col("pos") + F.length("ref")).alias("end"), "id", "ref", "alt", "qual", none.alias("filter"), info.alias("info"), F.array().cast("array<map<string,string>>").alias("samples"))
    path = fresh(spark, "indexed")
    indexed.write_vcf(d, HEADER, path, files=files)
    return path


RECORDS = f"""(SELECT 'c' || (l_suppkey % 10) AS chrom, {DAY} * {SPREAD} + l_partkey % 1000 AS pos, l_quantity::DOUBLE AS qual, l_orderkey,
  CASE WHEN l_orderkey % 7 = 0 THEN {DAY} * {SPREAD} + l_quantity::BIGINT * 100000 ELSE {DAY} * {SPREAD} + l_partkey % 1000 + l_linenumber END AS stop FROM lineitem)"""


def indexed_regions(spark, sf):
    """Records that meet regions, one for each nation, read through the index of what was written."""
    at = F.lit(8200 * SPREAD) + F.col("n_nationkey") * 80 * SPREAD
    nations = spark.read.parquet(f"{sf}/nation.parquet").select(F.concat(F.lit("c"), (F.col("n_nationkey") % 8).cast("string")).alias("chrom"), at.alias("lo"), (at + 2 * SPREAD).alias("hi"))
    regions = [(r.chrom, r.lo, r.hi) for r in nations.collect()]  # a list of regions, as a user gives one
    d = indexed.read_vcf(spark, _stored(spark, sf), regions)
    return d.groupBy("chrom").agg(F.count("*").alias("n"), F.sum("pos").alias("pos"), F.sum("end").alias("stop"), F.sum("qual").alias("qual"), F.min("id").alias("id"))


INDEXED_REGIONS = f"""SELECT chrom, count(*) AS n, sum(pos)::BIGINT AS pos, sum(stop)::BIGINT AS stop, sum(qual) AS qual, min(l_orderkey::VARCHAR) AS id FROM {RECORDS} r
WHERE EXISTS (SELECT 1 FROM nation WHERE r.chrom = 'c' || (n_nationkey % 8) AND r.pos < (8202 + 80 * n_nationkey::BIGINT) * {SPREAD} AND r.stop > (8200 + 80 * n_nationkey::BIGINT) * {SPREAD}) GROUP BY chrom"""


def block_splits(spark, sf):
    """All records of the written folder, read in splits of 64 KiB wherever they fall."""
    d = indexed.read_vcf(spark, _stored(spark, sf), split_bytes=1 << 16)
    return d.groupBy("chrom", F.length("ref").alias("size")).agg(F.count("*").alias("n"), F.sum("pos").alias("pos"), F.sum("end").alias("stop"), F.sum("qual").alias("qual"))


BLOCK_SPLITS = f"""SELECT 'c' || (l_suppkey % 10) AS chrom, l_linenumber::INT AS size, count(*) AS n, sum({DAY} * {SPREAD} + l_partkey % 1000)::BIGINT AS pos, sum(l_quantity)::DOUBLE AS qual,
  sum(CASE WHEN l_orderkey % 7 = 0 THEN {DAY} * {SPREAD} + l_quantity::BIGINT * 100000 ELSE {DAY} * {SPREAD} + l_partkey % 1000 + l_linenumber END)::BIGINT AS stop FROM lineitem GROUP BY 1, 2"""


def _chunks(spark, sf: str):
    """A reference of three contigs, a row of bases for each part: short units over and over, some of them through several rows."""
    p = spark.read.parquet(f"{sf}/part.parquet")
    kind = F.floor(F.col("p_size") / 10).cast("int")
    unit = F.lit("ACGTCAGT").substr(kind + 1, kind % 3 + 1)
    return p.select((F.col("p_partkey") % 3).cast("string").alias("chrom"), F.floor(F.col("p_partkey") / 3).alias("chunk"), F.substring(F.repeat(unit, F.lit(WIDTH)), 1, WIDTH).alias("seq"))


def allele_ids(spark, sf):
    """Alleles of shipped lines named by those of returned ones, all in normal form."""
    chunks = _chunks(spark, sf)
    d = lines(spark, sf, "l_returnflag IN ('A', 'R')").withColumns({"chrom": (F.col("l_partkey") % 3).cast("string"), "chunk": F.floor(F.col("l_partkey") / 3), "off": (F.col("l_quantity") % WIDTH).cast("int")}).join(chunks, ["chrom", "chunk"])
    ref = F.substring(F.col("seq"), F.col("off") + 1, F.least(F.col("l_linenumber").cast("int") + 1, WIDTH - F.col("off")))
    d = d.withColumn("ref", ref)
    alt = F.when(F.col("l_orderkey") % 3 == 0, F.substring("ref", 1, 1)).when(F.col("l_orderkey") % 3 == 1, F.concat("ref", F.right("ref", F.lit(2)))).otherwise(F.concat(F.reverse("ref"), F.lit("G")))
    d = d.select("chrom", (F.col("chunk") * WIDTH + F.col("off")).alias("pos"), "ref", alt.alias("alt"), "l_returnflag", F.col("l_orderkey").cast("string").alias("name"))
    got = alleles.with_allele_ids(d.filter("l_returnflag = 'A'").drop("name", "l_returnflag"), d.filter("l_returnflag = 'R'").drop("l_returnflag"), chunks, WIDTH)
    return got.groupBy("chrom", F.col("npos").alias("pos"), F.col("nref").alias("ref"), F.col("nalt").alias("alt"), "id").agg(F.count("*").alias("n"))


LONGEST = "list_max(list_filter(range(0, least(length({0}), length({1})) + 1), lambda n: {2}({0}, n::BIGINT) = {2}({1}, n::BIGINT)))::BIGINT"
ALLELE_IDS = f"""WITH RECURSIVE p AS (SELECT p_partkey % 3 AS chrom, p_partkey // 3 AS chunk, left(repeat(substr('ACGTCAGT', p_size // 10 + 1, (p_size // 10) % 3 + 1), {WIDTH}), {WIDTH}) AS seq FROM part),
  c AS (SELECT chrom, string_agg(seq, '' ORDER BY chunk) AS whole FROM p GROUP BY chrom),
  d AS (SELECT chrom, chunk * {WIDTH} + l_quantity::INT % {WIDTH} AS pos, substr(seq, l_quantity::INT % {WIDTH} + 1, least(l_linenumber + 1, {WIDTH} - l_quantity::INT % {WIDTH})) AS ref, l_orderkey, l_returnflag
    FROM lineitem JOIN p ON p.chrom = l_partkey % 3 AND p.chunk = l_partkey // 3 WHERE l_returnflag IN ('A', 'R')),
  e AS (SELECT *, CASE l_orderkey % 3 WHEN 0 THEN left(ref, 1) WHEN 1 THEN ref || right(ref, 2) ELSE reverse(ref) || 'G' END AS alt FROM d),
  k AS (SELECT DISTINCT chrom, pos, ref, alt FROM e),
  f AS (SELECT *, left(ref, length(ref) - n) AS r, left(alt, length(alt) - n) AS a FROM (SELECT *, {LONGEST.format('ref', 'alt', 'right')} AS n FROM k)),
  g AS (SELECT chrom, pos, ref, alt, pos + m AS loc, substr(r, m + 1) AS gone, substr(a, m + 1) AS come FROM (SELECT *, {LONGEST.format('r', 'a', 'left')} AS m FROM f)),
  w AS (SELECT g.*, gone || come AS unit FROM g WHERE (gone = '') <> (come = '')
    UNION ALL SELECT w.chrom, pos, ref, alt, loc - 1, gone, come, right(unit, 1) || left(unit, length(unit) - 1) FROM w JOIN c USING (chrom) WHERE loc > 0 AND substr(whole, loc, 1) = right(unit, 1)),
  x AS (SELECT chrom, pos, ref, alt, min(loc) AS loc, arg_min(unit, loc) AS unit, any_value(come <> '') AS ins FROM w GROUP BY ALL),
  y AS (SELECT chrom, pos, ref, alt, greatest(loc - 1, 0) AS npos, CASE WHEN loc > 0 THEN substr(whole, loc, 1) ELSE '' END AS b, CASE WHEN loc > 0 THEN '' ELSE substr(whole, CASE WHEN ins THEN 1 ELSE length(unit) + 1 END, 1) END AS z, unit, ins FROM x JOIN c USING (chrom)),
  n AS (SELECT chrom, pos, ref, alt, npos, CASE WHEN ins THEN b || z ELSE b || unit || z END AS nref, CASE WHEN ins THEN b || unit || z ELSE b || z END AS nalt FROM y
    UNION ALL SELECT chrom, pos, ref, alt, loc, gone, come FROM g WHERE gone <> '' AND come <> '' UNION ALL SELECT chrom, pos, ref, alt, pos, ref, alt FROM g WHERE gone = '' AND come = ''),
  i AS (SELECT chrom, npos, nref, nalt, min(l_orderkey::VARCHAR) AS id FROM e JOIN n USING (chrom, pos, ref, alt) WHERE l_returnflag = 'R' GROUP BY ALL)
SELECT chrom::VARCHAR AS chrom, npos AS pos, nref AS ref, nalt AS alt, id, count(*) AS n FROM e JOIN n USING (chrom, pos, ref, alt) LEFT JOIN i USING (chrom, npos, nref, nalt) WHERE l_returnflag = 'A' GROUP BY ALL"""

QUERIES = {f.__name__: f for f in (indexed_regions, block_splits, allele_ids)}
ORACLES = {"indexed_regions": INDEXED_REGIONS, "block_splits": BLOCK_SPLITS, "allele_ids": ALLELE_IDS}
