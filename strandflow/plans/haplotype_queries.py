"""Queries of patched and joined haplotype records on the given tables, with their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..operators import evaluation, haplotypes
from .queries import lines
from .variant_queries import ORDER, RECORDS

POOL = ["C", "G", "T", "AA"]


def _text(x: Column) -> Column:
    return F.array_join(F.transform(x, lambda v: v.cast("string")), ",")


def _map(**values: Column) -> Column:
    """A map of the values that are not null; a true one is a flag."""
    entries = F.array(*[F.struct(F.lit(k).alias("k"), v.alias("v")) for k, v in values.items()])
    return F.map_from_entries(F.transform(F.filter(entries, lambda e: e["v"].isNotNull()), lambda e: F.struct(e["k"], F.when(e["v"] != "true", e["v"]))))


def _first_rows(spark, sf):
    q = F.col("l_quantity").cast("int")
    d = lines(spark, sf).withColumns({"k": (F.col("l_linenumber") % 4).cast("int"), "q": q, "p": F.col("l_partkey").cast("int") % 4, "chrom": (F.col("l_orderkey") % 3).cast("string"), "pos": F.col("l_orderkey")})
    return evaluation.first_per_position(d, ["l_orderkey", "k"], ORDER)


STREAM = ["chrom", "pos", "record", "ref", "alt", "gt", "gq", "pl", "ad", "filter", "qual", "delta", "str", "ru", "rpa", "id", "info", "samples", "end"]


def _patch_streams(spark, sf):
    """Haploid records of one to four alleles, their genotype, likelihoods and counts made of the quantity."""
    q, p, n = F.col("q"), F.col("p"), F.col("q") % 4 + 1
    d = _first_rows(spark, sf)
    every = F.array(*map(F.lit, POOL))
    alt = F.transform(F.sequence(F.lit(0), n - 1), lambda j: F.get(every, (p + j) % 4))
    gt = F.when(q % 6 != 0, (q % (n + 1)).cast("string"))
    numbers = F.sequence(F.lit(0), n)
    d = d.withColumns({"alts": alt, "called": gt, "likely": F.transform(numbers, lambda j: F.when(j == 0, q % 2).otherwise((q * (j + 3) + p * 5) % 11).cast("int")), "depth": F.transform(numbers, lambda j: (j * 5 + q % 3).cast("int"))})
    info = _map(AC=_text(F.transform(F.sequence(F.lit(1), n), lambda j: j * 10 + p)), STR=F.when(q % 4 == 1, F.lit("true")), RPA=F.concat((q % 9).cast("string"), F.lit(",7")))
    first = _map(GT=F.coalesce("called", F.lit(".")), PL=_text(F.col("likely")), AD=_text(F.col("depth")))
    d = d.select(
        "k", "chrom", "pos", F.col("l_orderkey").alias("record"), F.lit("A").alias("ref"), F.col("alts").alias("alt"), F.col("called").alias("gt"), q.alias("gq"), F.col("likely").alias("pl"), F.col("depth").alias("ad"), F.array().cast("array<string>").alias("filter"),
        q.cast("double").alias("qual"), F.lit(False).alias("delta"), (q % 4 == 1).alias("str"), F.lit("A").alias("ru"), F.array(q % 9, F.lit(7)).alias("rpa"), F.lit(None).cast("string").alias("id"), info.alias("info"), F.array(first).alias("samples"), (F.col("pos") + 1).alias("end"),
    )
    return {name: d.filter(F.col("k") == k).select(*STREAM) for k, name in enumerate(("v1", "v2", "d1", "d2"))}


def _flat(d, *more: str):
    of = lambda k: F.try_element_at(F.get("samples", F.lit(0)), F.lit(k))
    info = lambda k: F.try_element_at(F.col("info"), F.lit(k))
    flag = lambda k: F.map_contains_key("info", F.lit(k))
    return d.select(*more, "pos", "ref", F.array_join("alt", ",").alias("alt"), of("GT").alias("gt"), info("AC").alias("ac"), of("AD").alias("ad"), flag("DELTA").alias("delta"), of("PL").alias("pl"), of("DP").alias("dp"), of("PS").alias("ps"), info("DP").alias("info_dp"), info("AN").alias("an"), info("AF").alias("af"), info("RPA").alias("rpa"), info("RU").alias("ru"), flag("STR").alias("str"), info("MQ").alias("mq"), info("QD").alias("qd"), F.col("qual").cast("long").alias("qual"))


def patched_records(spark, sf):
    """Whole records of both haplotypes after patching: two alleles at most, fields and genotypes by the alleles that stay."""
    counts = haplotypes.Counts({"A": ["AC"]}, {"R": ["AD"], "G": ["PL"]})
    d = haplotypes.patched(_patch_streams(spark, sf), {n: counts for n in ("v1", "v2", "d1", "d2")})
    return _flat(d, "hap", "source").select("hap", "source", "pos", "ref", "alt", "gt", "ac", "ad", "pl", "delta")


FIRST = "r AS (SELECT *, l_quantity::INT AS q, (l_partkey % 4)::INT AS p, l_linenumber % 4 AS k, row_number() OVER (PARTITION BY l_orderkey, l_linenumber % 4 ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS rn FROM lineitem)"
PATCHED_RECORDS = f"""WITH {FIRST},
  v AS (SELECT l_orderkey AS pos, k, q, p, q % 4 + 1 AS n, list_transform(range(0, q % 4 + 1), lambda j: {POOL}[(p + j) % 4 + 1]) AS alt, CASE WHEN q % 6 <> 0 THEN q % (q % 4 + 2) END AS gt,
    list_transform(range(0, q % 4 + 2), lambda j: CASE WHEN j = 0 THEN q % 2 ELSE (q * (j + 3) + p * 5) % 11 END) AS pl FROM r WHERE rn = 1),
  c AS (SELECT o.pos, hap, d.pos IS NOT NULL AND d.gt IS NOT NULL AND (v.pos IS NULL OR list_has_all(d.alt, v.alt)) AS patched, v, d FROM (SELECT DISTINCT pos FROM v) o CROSS JOIN (VALUES (0), (1)) h(hap)
    LEFT JOIN v ON v.pos = o.pos AND v.k = hap LEFT JOIN v d ON d.pos = o.pos AND d.k = hap + 2),
  x AS (SELECT pos, hap, patched, CASE WHEN patched THEN d ELSE v END AS z FROM c), s AS (SELECT pos FROM x GROUP BY pos HAVING bool_and(z.pos IS NULL OR (z.pl[1] = 0 AND z.q >= 20))),
  y AS (SELECT pos, hap, patched, z.q AS q, z.p AS p, z.n AS n, z.alt AS alt, z.gt AS gt, z.pl AS pl, CASE WHEN z.n > 2 THEN list_transform(list_sort(list_transform(range(1, z.n + 1), lambda j: (z.pl[j + 1], j)))[1:2], lambda t: t[2]) ELSE range(1, z.n + 1) END AS best FROM x WHERE z.pos IS NOT NULL AND pos NOT IN (SELECT pos FROM s))
SELECT hap, CASE WHEN patched THEN 'patch' ELSE 'kept' END AS source, pos, 'A' AS ref, array_to_string(list_transform(best, lambda j: alt[j]), ',') AS alt, CASE WHEN gt IS NULL THEN '.' WHEN n > 2 AND gt > 0 THEN coalesce(list_position(best, gt), 0)::VARCHAR ELSE gt::VARCHAR END AS gt,
  array_to_string(list_transform(best, lambda j: j * 10 + p), ',') AS ac, array_to_string(list_transform([0] || best, lambda j: j * 5 + q % 3), ',') AS ad, array_to_string(list_transform([0] || best, lambda j: pl[j + 1]), ',') AS pl, patched OR (q % 4 = 1 AND q % 9 >= 4) AS delta FROM y"""


def _merge_streams(spark, sf):
    """Phased, haplotypes' and unphased records of one or two alleles of differing lengths."""
    q = F.col("q")
    ref = F.lit("ACGTAACC").substr(q % 3 + 1, q % 4 + 1)
    d = _first_rows(spark, sf).withColumn("base", ref)
    alts = F.when(q % 5 == 0, F.array(F.concat("base", F.lit("T")))).otherwise(F.array(F.col("base").substr(F.lit(1), F.lit(1)), F.concat("base", F.lit("T"))))
    n = F.when(q % 5 == 0, 1).otherwise(2)
    haploid = F.col("k").isin(1, 2)
    gt = F.when(haploid, F.when(q % 7 != 0, (q % (n + 1)).cast("string"))).otherwise(F.get(F.array(*map(F.lit, ["./.", "0/1", "0/0", "1/1", "0|1"])), q % 6))
    d = d.withColumns({"alts": alts, "called": gt, "gone": F.col("l_linestatus") == "O"})
    info = _map(DP=(q * 2).cast("string"), MQ=F.lit("60"), QD=F.lit("3"), MLEAC=F.lit("1,1"), RU=F.when(q % 3 == 0, F.concat(F.lit("U"), (q % 4).cast("string"))), STR=F.when(q % 3 == 0, F.lit("true")), RPA=F.when(q % 3 == 0, F.concat_ws(",", q % 4, q % 5 + 1, q % 6 + 2)), DELTA=F.when(F.col("gone"), F.lit("true")))
    first = _map(GT=F.coalesce("called", F.lit(".")), AD=F.concat_ws(",", q % 4, q % 5, q % 6), DP=q.cast("string"))
    d = d.select(
        "k", "chrom", "pos", F.col("l_orderkey").alias("record"), F.col("base").alias("ref"), F.col("alts").alias("alt"), F.col("called").alias("gt"), q.alias("gq"), F.array(q % 2).alias("pl"), F.array(q % 4).alias("ad"), F.when(F.col("l_returnflag") == "R", F.array(F.lit("low"))).otherwise(F.array().cast("array<string>")).alias("filter"),
        q.cast("double").alias("qual"), F.col("gone").alias("delta"), (q % 3 == 0).alias("str"), F.lit("A").alias("ru"), F.array(q % 4).alias("rpa"), F.lit(None).cast("string").alias("id"), info.alias("info"), F.array(first).alias("samples"), (F.col("pos") + 1).alias("end"),
    )
    return {name: d.filter(F.col("k") == k).select(*STREAM) for k, name in enumerate(("v", "h1", "h2", "u"))}


def haplotype_records(spark, sf):
    """Diploid records of phased, haplotypes' and unphased ones: alleles by genotype, summed depths and repeats, inherited fields, phase sets."""
    declared = haplotypes.Counts({"A": ["AC", "AF", "MLEAC"], "R": ["RPA"], "": ["AN", "DP", "MQ", "QD", "RU", "STR"]}, {"A": [], "R": ["AD"], "": ["GT", "DP"]})
    counts = haplotypes.Counts({"R": ["RPA"]}, {"R": ["AD"]})
    o = spark.read.parquet(f"{sf}/orders.parquet").filter("o_orderkey % 97 < 2")
    blocks = o.select((F.col("o_orderkey") % 3).cast("string").alias("grp"), (F.col("o_orderkey") - F.col("o_orderkey") % 97).alias("s")).distinct().withColumn("e", F.col("s") + 30)
    streams = _merge_streams(spark, sf)
    return _flat(haplotypes.merged(streams, blocks, declared, {n: counts for n in streams}), "source").drop("pl")


def _side(k: int) -> str:
    """The called haploid record of stream k: its allele trimmed, its counts."""
    n = f"list_max(list_filter(range(0, least(length(ref), length(alt[gt::INT]))), lambda n: right(ref, n::BIGINT) = right(alt[gt::INT], n::BIGINT)))::BIGINT"  # noqa: F541
    return f"SELECT pos, left(ref, length(ref) - n) AS ref, left(a, length(a) - n) AS alt, q, g FROM (SELECT pos, ref, alt[gt::INT] AS a, q, gt::INT AS g, {n} AS n FROM w WHERE k = {k} AND NOT bad AND gt IS NOT NULL AND gt <> '0')"


HAPLOTYPE_RECORDS = f"""WITH {RECORDS.replace('v AS (', 'v0 AS (')},
  w AS (SELECT * EXCLUDE (gt), l_orderkey AS pos, CASE WHEN k IN (1, 2) THEN CASE WHEN q % 7 <> 0 THEN (q % (len(alt) + 1))::VARCHAR END ELSE ['./.', '0/1', '0/0', '1/1', '0|1', NULL][q % 6 + 1] END AS gt FROM v0),
  a AS ({_side(1)}), b AS ({_side(2)}),
  m AS (SELECT o.pos, v.q AS vq, v.ref AS vref, v.alt AS valt, v.gt AS vgt, v.delta AS vdelta, u.q AS uq, u.ref AS uref, u.alt AS ualt, u.gt AS ugt, v.pos IS NOT NULL AND NOT v.bad AND v.gt IS NOT NULL AND v.gt <> '0/0' AS ok, coalesce(h1.delta, false) OR coalesce(h2.delta, false) AS hd, coalesce(u.delta, false) AS ud,
      u.pos IS NOT NULL AND NOT u.bad AND u.gt IS NOT NULL AND u.gt <> '0/0' AS uok, a, b, x.s AS ps FROM (SELECT DISTINCT pos FROM w) o LEFT JOIN w v ON v.pos = o.pos AND v.k = 0 LEFT JOIN w h1 ON h1.pos = o.pos AND h1.k = 1 LEFT JOIN w h2 ON h2.pos = o.pos AND h2.k = 2 LEFT JOIN w u ON u.pos = o.pos AND u.k = 3
    LEFT JOIN a ON a.pos = o.pos LEFT JOIN b ON b.pos = o.pos LEFT JOIN (SELECT DISTINCT o_orderkey % 3 AS c, o_orderkey - o_orderkey % 97 AS s FROM orders WHERE o_orderkey % 97 < 2) x ON x.c = o.pos % 3 AND x.s <= o.pos AND o.pos < x.s + 30),
  s AS (SELECT *, CASE WHEN ok AND len(list_filter(valt, lambda y: length(y) = length(vref))) > 0 THEN 'phased' WHEN hd THEN CASE WHEN a.pos IS NOT NULL OR b.pos IS NOT NULL THEN 'joined' END WHEN ud THEN CASE WHEN uok THEN 'unphased' END WHEN ok THEN 'phased' END AS source,
    a.pos IS NOT NULL AND b.pos IS NOT NULL AS two, a.ref = b.ref AND a.alt = b.alt AS same FROM m),
  j AS (SELECT *, two AND NOT same AS apart, coalesce(a.q % 4, 0) + coalesce(b.q % 4, 0) AS ad0, coalesce((CASE a.g WHEN 1 THEN a.q % 5 ELSE a.q % 6 END), 0) AS ad1, coalesce((CASE b.g WHEN 1 THEN b.q % 5 ELSE b.q % 6 END), 0) AS ad2,
    CASE WHEN a.q % 3 = 0 THEN [a.q % 4, CASE a.g WHEN 1 THEN a.q % 5 + 1 ELSE a.q % 6 + 2 END] END AS ra, CASE WHEN b.q % 3 = 0 THEN [b.q % 4, CASE b.g WHEN 1 THEN b.q % 5 + 1 ELSE b.q % 6 + 2 END] END AS rb FROM s WHERE source = 'joined')
SELECT source, pos, CASE WHEN b.pos IS NULL OR (a.pos IS NOT NULL AND length(a.ref) >= length(b.ref)) THEN a.ref ELSE b.ref END AS ref,
    CASE WHEN a.pos IS NULL THEN b.alt WHEN NOT apart OR b.pos IS NULL THEN a.alt ELSE a.alt || substr(b.ref, length(a.ref) + 1) || ',' || b.alt || substr(a.ref, length(b.ref) + 1) END AS alt,
    CASE WHEN two THEN '1' || CASE WHEN ps IS NULL THEN '/' ELSE '|' END || CASE WHEN same THEN '1' ELSE '2' END WHEN ps IS NULL THEN '0/1' WHEN a.pos IS NOT NULL THEN '1|0' ELSE '0|1' END AS gt,
    CASE WHEN apart THEN '1,1' WHEN two THEN '2' ELSE '1' END AS ac, CASE WHEN ad0 <> 0 THEN ad0 || ',' || CASE WHEN apart THEN ad1 || ',' || ad2 ELSE (ad1 + ad2)::VARCHAR END END AS ad, ok AND vdelta AS delta, (coalesce(a.q, 0) + coalesce(b.q, 0))::VARCHAR AS dp, ps::VARCHAR AS ps,
    CASE WHEN ok THEN vq * 2 ELSE coalesce(a.q, 0) * 2 + coalesce(b.q, 0) * 2 END::VARCHAR AS info_dp, CASE WHEN ok THEN '2' END AS an, CASE WHEN apart THEN '0.5,0.5' WHEN two THEN '1.0' ELSE '0.5' END AS af,
    CASE WHEN coalesce(rb[1], ra[1], 0) <> 0 THEN coalesce(rb[1], ra[1]) || ',' || CASE WHEN apart THEN coalesce(ra[2], 0) || ',' || coalesce(rb[2], 0) ELSE coalesce(rb[2], ra[2])::VARCHAR END WHEN ok AND vq % 3 = 0 THEN (vq % 4) || ',' || (vq % 5 + 1) || ',' || (vq % 6 + 2) END AS rpa,
    CASE WHEN ok THEN CASE WHEN vq % 3 = 0 THEN 'U' || (vq % 4) END WHEN a.q % 3 = 0 THEN 'U' || (a.q % 4) WHEN b.q % 3 = 0 THEN 'U' || (b.q % 4) END AS ru, CASE WHEN ok THEN vq % 3 = 0 ELSE coalesce(a.q % 3 = 0, false) OR coalesce(b.q % 3 = 0, false) END AS str,
    CASE WHEN ok THEN '60' END AS mq, NULL AS qd, (coalesce(a.q, 0) + coalesce(b.q, 0))::BIGINT AS qual FROM j
UNION ALL SELECT source, pos, ref, array_to_string(alt, ',') AS alt, gt, NULL, (q % 4) || ',' || (q % 5) || ',' || (q % 6), delta, q::VARCHAR, NULL, (q * 2)::VARCHAR, NULL, NULL, CASE WHEN q % 3 = 0 THEN (q % 4) || ',' || (q % 5 + 1) || ',' || (q % 6 + 2) END, CASE WHEN q % 3 = 0 THEN 'U' || (q % 4) END, q % 3 = 0, '60', '3', q::BIGINT
  FROM (SELECT source, pos, CASE source WHEN 'phased' THEN vq ELSE uq END AS q, CASE source WHEN 'phased' THEN vref ELSE uref END AS ref, CASE source WHEN 'phased' THEN valt ELSE ualt END AS alt, CASE source WHEN 'phased' THEN vgt ELSE ugt END AS gt, source = 'phased' AND vdelta AS delta FROM s WHERE source <> 'joined')"""

QUERIES = {f.__name__: f for f in (patched_records, haplotype_records)}
ORACLES = {"patched_records": PATCHED_RECORDS, "haplotype_records": HAPLOTYPE_RECORDS}
