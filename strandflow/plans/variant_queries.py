"""Queries of the allele, label, stratum, index and neighbour operators on the given tables, with their DuckDB SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..operators import evaluation, intervals, neighbours, positional, variants
from ..sources import index
from .queries import DAY, DENSITY, SPANS, A, lines, merged_sql, spans

ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]


def _streams(spark, sf):
    """Four streams of variant records by order: alleles and genotypes follow from the quantity."""
    q = F.col("l_quantity").cast("int")
    ref = F.lit("ACGTAACC").substr(q % 3 + 1, q % 4 + 1)
    alts = F.when(q % 5 == 0, F.array(F.concat(ref, F.lit("T")))).otherwise(F.array(ref.substr(F.lit(1), F.lit(1)), F.concat(ref, F.lit("T"))))
    gt = F.get(F.array(*map(F.lit, ["./.", "0/1", "1|2", "1/1", "0|1"])), q % 6)
    d = lines(spark, sf).withColumn("k", F.col("l_linenumber") % 4)
    d = evaluation.first_per_position(d, ["l_orderkey", "k"], ORDER)
    d = d.select(
        "l_orderkey", "k", ref.alias("ref"), alts.alias("alt"), gt.alias("gt"), q.alias("gq"), F.array(q % 2, q % 7, q % 3).alias("pl"),
        F.when(F.col("l_returnflag") == "R", F.array(F.lit("low"))).otherwise(F.array().cast("array<string>")).alias("filter"), (F.col("l_linestatus") == "O").alias("delta"),
    )
    return d, positional.by_stream(d, ["l_orderkey"], "k", {f"v{k}": k for k in range(4)})


RECORDS = """r AS (SELECT *, substr('ACGTAACC', q % 3 + 1, q % 4 + 1) AS ref, CASE q % 6 WHEN 0 THEN './.' WHEN 1 THEN '0/1' WHEN 2 THEN '1|2' WHEN 3 THEN '1/1' WHEN 4 THEN '0|1' END AS gt FROM (
  SELECT *, l_quantity::INT AS q, l_linenumber % 4 AS k, row_number() OVER (PARTITION BY l_orderkey, l_linenumber % 4 ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS rn FROM lineitem) WHERE rn = 1),
v AS (SELECT *, CASE WHEN q % 5 = 0 THEN [ref || 'T'] ELSE [substr(ref, 1, 1), ref || 'T'] END AS alt, l_returnflag = 'R' AS bad, l_linestatus = 'O' AS delta FROM r)"""


def trimmed_sql(ref: str, alt: str) -> str:
    """ref and alt as one text, the common ending cut: the longest ending that both have, less than either."""
    n = f"list_max(list_filter(range(0, least(length({ref}), length({alt}))), lambda n: right({ref}, n::BIGINT) = right({alt}, n::BIGINT)))::BIGINT"
    return f"(left({ref}, length({ref}) - {n}) || '>' || left({alt}, length({alt}) - {n}))"


def allele_patch(spark, sf):
    m = _streams(spark, sf)[1]
    return m.select("l_orderkey", variants.patch(F.col("v0"), F.col("v1")).alias("source"))


ALLELE_PATCH = f"""WITH {RECORDS}, t AS (SELECT *, list_transform(alt, lambda a: {trimmed_sql('ref', 'a')}) AS ts FROM v),
  o AS (SELECT DISTINCT l_orderkey FROM lineitem)
SELECT o.l_orderkey, CASE WHEN d.gt IS NOT NULL AND d.gt <> './.' AND (v.ref IS NULL OR list_has_all(d.ts, v.ts)) THEN CASE WHEN NOT (d.q % 2 = 0 AND d.q >= 20) THEN 'patch' END WHEN v.ref IS NOT NULL THEN 'kept' END AS source
FROM o LEFT JOIN (SELECT * FROM t WHERE k = 0) v USING (l_orderkey) LEFT JOIN (SELECT * FROM t WHERE k = 1) d USING (l_orderkey)"""


def haplotype_split(spark, sf):
    return variants.split_haplotypes(_streams(spark, sf)[0], ["l_orderkey", "k"])


HAPLOTYPE_SPLIT = f"""WITH {RECORDS}, h AS (SELECT *, unnest(CASE gt WHEN '1|2' THEN [1, 2] WHEN '1/1' THEN [1, 1] WHEN '0|1' THEN [0, 1] ELSE [0, 0] END) AS allele, unnest([0, 1]) AS hap FROM v),
  t AS (SELECT *, alt[allele] AS a FROM h WHERE allele > 0 AND allele <= len(alt)), s AS (SELECT *, least(length(ref), length(a)) - 1 AS n FROM t)
SELECT l_orderkey, k, hap, left(ref, length(ref) - n) AS ref, left(a, length(a) - n) AS alt FROM s"""


def haploid_patches(spark, sf):
    """Both haplotypes' records after patching, streams 0 and 1 by 2 and 3."""
    rows, _ = _streams(spark, sf)
    rows = rows.withColumns({"str": F.col("gq") % 4 == 1, "rpa": F.array(F.col("gq") % 9, F.lit(1))})
    m = positional.by_stream(rows, ["l_orderkey"], "k", {f"v{k}": k for k in range(4)})
    m = m.select("l_orderkey", F.inline(variants.haploid_patch(*[F.col(f"v{k}") for k in range(4)])))
    return m.select("l_orderkey", "hap", "source", "record.ref", F.array_join("record.alt", ",").alias("alt"), "delta")


HAPLOID_PATCHES = f"""WITH {RECORDS}, t AS (SELECT *, list_transform(alt, lambda a: {trimmed_sql('ref', 'a')}) AS ts FROM v), o AS (SELECT DISTINCT l_orderkey FROM lineitem),
  h AS (SELECT o.l_orderkey, hap, v.ref AS vr, v.alt AS va, v.q AS vq, d.ref AS dr, d.alt AS da, d.q AS dq, d.gt IS NOT NULL AND (v.ref IS NULL OR list_has_all(d.ts, v.ts)) AS patched
    FROM o CROSS JOIN (VALUES (0), (1)) x(hap) LEFT JOIN t v ON v.l_orderkey = o.l_orderkey AND v.k = hap LEFT JOIN t d ON d.l_orderkey = o.l_orderkey AND d.k = hap + 2),
  c AS (SELECT l_orderkey, hap, patched, CASE WHEN patched THEN dr ELSE vr END AS ref, CASE WHEN patched THEN da ELSE va END AS alt, CASE WHEN patched THEN dq ELSE vq END AS q FROM h),
  s AS (SELECT l_orderkey FROM c GROUP BY l_orderkey HAVING bool_and(ref IS NULL OR (q % 2 = 0 AND q >= 20)))
SELECT l_orderkey, hap, CASE WHEN patched THEN 'patch' ELSE 'kept' END AS source, ref, array_to_string(alt, ',') AS alt, patched OR (q % 4 = 1 AND q % 9 >= 4) AS delta FROM c WHERE ref IS NOT NULL AND l_orderkey NOT IN (SELECT l_orderkey FROM s)"""


def codon_table(spark, sf):
    """Codons of exons in file order; transcripts change from order to order and come again."""
    d = lines(spark, sf).groupBy("l_orderkey", "l_linenumber").agg(F.max("l_quantity").cast("int").alias("q"), F.min("s").alias("s"))
    name = F.concat(F.lit("T"), (F.floor(F.col("l_orderkey") / 3) % 5).cast("string"), F.lit("."), F.col("l_linenumber").cast("string"))
    exons = d.select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("line"), (F.col("l_orderkey") % 3).cast("string").alias("chrom"), "s", (F.col("s") + F.col("q") % 8).alias("e"), name.alias("transcript"))
    return positional.codons(exons).groupBy("chrom", "pos", "codon").agg(F.count("*").alias("n"))


CODON_TABLE = f"""WITH d AS (SELECT l_orderkey * 8 + l_linenumber AS line, l_orderkey % 3 AS chrom, min(s) AS s, max(l_quantity)::INT % 8 AS len, 'T' || (l_orderkey // 3 % 5) AS name FROM {SPANS} GROUP BY l_orderkey, l_linenumber),
  n AS (SELECT *, CASE WHEN name IS DISTINCT FROM lag(name) OVER (ORDER BY line) THEN 1 ELSE 0 END AS new FROM d), r AS (SELECT *, sum(new) OVER (ORDER BY line) AS run FROM n),
  c AS (SELECT *, sum(len) OVER (PARTITION BY run ORDER BY line) - len AS base, sum(len) OVER (PARTITION BY run) AS total FROM r), b AS (SELECT *, unnest(range(0, len)) AS k FROM c)
SELECT chrom::VARCHAR AS chrom, s + k AS pos, name || '-Codon' || ((base + k) // 3 + 1)::BIGINT AS codon, count(*) AS n FROM b WHERE ((base + k) // 3 + 1) * 3 <= total GROUP BY ALL"""


def shard_memory(spark, sf):
    """Memory by shard: a supplier's two regions in fragments of 100 over slots of 32."""
    number = F.col("l_quantity")
    sized = lines(spark, sf).select("grp", "s", (F.col("s") + F.floor(number * 2) + 1).alias("e"), number.alias("size"))
    dense = positional.density(sized, 32).withColumn("density", F.round("density", 6))
    half = F.explode(F.array(F.struct(F.lit(9000).alias("s"), F.lit(9350).alias("e")), F.struct(F.lit(9400).alias("s"), F.lit(9417).alias("e"))))
    shards = spark.read.parquet(f"{sf}/supplier.parquet").select((F.col("s_suppkey") % 7).alias("shard"), F.col("s_suppkey").alias("grp"), half.alias("x"))
    shards = shards.select("shard", "grp", F.col("x.s").cast("long").alias("s"), F.col("x.e").cast("long").alias("e"))
    return positional.shard_memory(dense, shards, 5, 100, 32, 8.0 * (1 << 30)).withColumn("gigabytes", F.round("gigabytes", 3))


SHARD_MEMORY = f"""WITH f AS (SELECT s_suppkey % 7 AS shard, s_suppkey AS grp, unnest([9000, 9100, 9200, 9300, 9400]) AS f FROM supplier),
  k AS (SELECT shard, grp, unnest(range(f // 32, (f + 131) // 32)) AS slot FROM f), j AS (SELECT shard, density, row_number() OVER (PARTITION BY shard ORDER BY density DESC) AS rn FROM k JOIN {DENSITY} d USING (grp, slot))
SELECT s.shard, round(coalesce(sum(density), 0) * 8, 3) AS gigabytes FROM (SELECT DISTINCT shard FROM f) s LEFT JOIN (SELECT * FROM j WHERE rn <= 5) j ON j.shard = s.shard GROUP BY s.shard"""


def contig_presence(spark, sf):
    """Lines of suppliers that have a returned line, near (within two days of) one of another's: padding and semi-joins."""
    d = lines(spark, sf).groupBy("grp", "l_orderkey").agg(F.min("s").alias("s"), F.max("e").alias("e")).withColumn("id", F.col("l_orderkey") * 1_000_000 + F.col("grp"))
    there = lines(spark, sf, "l_returnflag = 'R' AND l_quantity > 49").select("grp", "s", "e")
    near = intervals.overlapping(d.join(there.select("grp").distinct(), "grp", "left_semi"), intervals.padded(there, 2))
    return near.groupBy("grp").agg(F.count("*").alias("n"))


CONTIG_PRESENCE = f"""WITH i AS (SELECT grp, l_orderkey, min(s) AS s, max(e) AS e FROM {SPANS} GROUP BY grp, l_orderkey), r AS (SELECT grp, greatest(s - 2, 0) AS s, e + 2 AS e FROM {SPANS} WHERE l_returnflag = 'R' AND l_quantity > 49)
SELECT grp, count(*) AS n FROM i WHERE EXISTS (SELECT 1 FROM r WHERE r.grp = i.grp AND i.s < r.e AND r.s < i.e) GROUP BY grp"""


def site_union(spark, sf):
    """Sites over samples: a row per place with how many samples and which alleles it has, and an id from known places."""
    d = lines(spark, sf).select(F.col("grp"), "s", (F.col("l_linenumber") % 4).alias("sample"), F.substring(F.lit("ACGT"), 1 + F.col("l_linenumber") % 4, 1).alias("alt"))
    sites = positional.site_union(d, ["grp", "s"], "sample", "alt")
    known = spark.read.parquet(f"{sf}/orders.parquet").select((F.col("o_custkey") % 100 + 1).alias("grp"), F.datediff(F.col("o_orderdate").cast("date"), F.lit("1970-01-01").cast("date")).cast("long").alias("s"), F.col("o_orderkey").cast("string").alias("name"))
    known = known.groupBy("grp", "s").agg(F.min("name").alias("known"))
    return positional.with_ids(sites, known, ["grp", "s"], "known").select("grp", "s", "samples", F.array_join("alleles", ",").alias("alleles"), "id")


SITE_UNION = f"""WITH k AS (SELECT o_custkey % 100 + 1 AS grp, date_diff('day', DATE '1970-01-01', o_orderdate::DATE) AS s, min(o_orderkey::VARCHAR) AS id FROM orders GROUP BY 1, 2),
  d AS (SELECT grp, s, count(DISTINCT l_linenumber % 4) AS samples, string_agg(DISTINCT substr('ACGT', 1 + l_linenumber % 4, 1), ',' ORDER BY substr('ACGT', 1 + l_linenumber % 4, 1)) AS alleles FROM {SPANS} GROUP BY grp, s)
SELECT d.grp, d.s, samples, alleles, k.id FROM d LEFT JOIN k ON k.grp = d.grp AND k.s = d.s"""


def site_fill(spark, sf):
    """Each sample's record at every site of the union: lines of one supplier stand for four samples' variants and blocks."""
    d = lines(spark, sf).withColumns({"sample": (F.col("l_orderkey") % 4), "id": F.col("l_orderkey") * 8 + F.col("l_linenumber"), "chrom": F.concat_ws(":", "l_suppkey", "l_returnflag")})
    variants_, blocks_ = d.filter("l_linenumber = 1"), d.filter("l_linenumber > 1")
    cols = [F.col("chrom").alias("grp"), "s", "sample", "id"]
    got = positional.site_fill(variants_.select(*cols), variants_.select(*cols), blocks_.select(*cols, "e"))
    return got.select("grp", "s", "sample", "source", F.col("record.id").alias("id"))


SITE_FILL = f"""WITH d AS (SELECT l_suppkey || ':' || l_returnflag AS grp, s, e, l_orderkey % 4 AS sample, l_orderkey * 8 + l_linenumber AS id, l_linenumber = 1 AS own FROM {SPANS}), t AS (SELECT DISTINCT grp, s FROM d WHERE own),
  j AS (SELECT t.grp, t.s, d.sample, d.own, d.s AS lo, d.id FROM t JOIN d ON d.grp = t.grp AND CASE WHEN own THEN d.s = t.s ELSE d.s <= t.s AND d.e > t.s END)
SELECT grp, s, sample, CASE WHEN max(own) THEN 'variant' ELSE 'block' END AS source, arg_max(id, (own, lo, id)) AS id FROM j GROUP BY grp, s, sample"""


def haplotype_join(spark, sf):
    m = _streams(spark, sf)[1]
    side = lambda v: F.when(v.isNotNull(), F.struct(v["ref"].alias("ref"), F.get(v["alt"], F.lit(0)).alias("alt"), v["gq"].alias("qual")))
    out = m.select("l_orderkey", variants.joined(side(F.col("v1")), side(F.col("v2")), F.coalesce(F.col("v0.delta"), F.lit(False))).alias("j")).filter("j IS NOT NULL")
    return out.select("l_orderkey", "j.ref", F.array_join("j.alts", ",").alias("alts"), "j.gt", F.array_join("j.ac", ",").alias("ac"), "j.qual")


HAPLOTYPE_JOIN = f"""WITH {RECORDS}, s AS (SELECT l_orderkey, max(ref) FILTER (WHERE k = 1) AS r1, max(alt[1]) FILTER (WHERE k = 1) AS a1, max(q) FILTER (WHERE k = 1) AS q1,
  max(ref) FILTER (WHERE k = 2) AS r2, max(alt[1]) FILTER (WHERE k = 2) AS a2, max(q) FILTER (WHERE k = 2) AS q2, coalesce(bool_or(delta) FILTER (WHERE k = 0), false) AS ps FROM v GROUP BY l_orderkey)
SELECT l_orderkey, CASE WHEN r2 IS NULL OR length(r1) >= length(r2) THEN r1 ELSE r2 END AS ref,
  CASE WHEN r1 IS NULL THEN a2 WHEN r2 IS NULL OR (r1 = r2 AND a1 = a2) THEN a1 ELSE a1 || substr(r2, length(r1) + 1) || ',' || a2 || substr(r1, length(r2) + 1) END AS alts,
  CASE WHEN r1 IS NULL THEN CASE WHEN ps THEN '0|1' ELSE '0/1' END WHEN r2 IS NULL THEN CASE WHEN ps THEN '1|0' ELSE '0/1' END ELSE '1' || CASE WHEN ps THEN '|' ELSE '/' END || CASE WHEN r1 = r2 AND a1 = a2 THEN '1' ELSE '2' END END AS gt,
  CASE WHEN r1 IS NULL OR r2 IS NULL THEN '1' WHEN r1 = r2 AND a1 = a2 THEN '2' ELSE '1,1' END AS ac, (coalesce(q1, 0) + coalesce(q2, 0))::INT AS qual FROM s WHERE r1 IS NOT NULL OR r2 IS NOT NULL"""


def phase_precedence(spark, sf):
    m = _streams(spark, sf)[1]
    return m.select("l_orderkey", variants.precedence(*[F.col(f"v{k}") for k in range(4)]).alias("source"))


PHASE_PRECEDENCE = f"""WITH {RECORDS}, o AS (SELECT l_orderkey, {", ".join(f"coalesce(bool_or(delta) FILTER (WHERE k = {k}), false) AS d{k}, coalesce(bool_or(NOT bad AND gt IS NOT NULL) FILTER (WHERE k = {k}), false) AS ok{k}" for k in range(4))},
  coalesce(bool_or(len(list_filter(alt, lambda a: length(a) = length(ref))) > 0) FILTER (WHERE k = 0), false) AS same FROM v GROUP BY l_orderkey)
SELECT l_orderkey, CASE WHEN ok0 AND same THEN 'phased' WHEN d1 OR d2 THEN CASE WHEN ok1 OR ok2 THEN 'joined' END WHEN d3 THEN CASE WHEN ok3 THEN 'unphased' END WHEN ok0 THEN 'phased' END AS source FROM o"""


def period_label(spark, sf):
    d = lines(spark, sf).select("l_orderkey", "l_linenumber", (F.col("l_quantity") - 5).alias("overlap"), (F.col("l_partkey") % 40).cast("double").alias("size"), (F.col("l_suppkey") % 9 - 1).cast("double").alias("period"), (F.col("l_linenumber") - 4).alias("diff"))
    return evaluation.effective_label(d).groupBy("l_orderkey", "l_linenumber", "label").agg(F.count("*").alias("n"))


PERIOD_LABEL = """SELECT l_orderkey, l_linenumber, label, count(*) AS n FROM (SELECT *, CASE WHEN overlap > 0 AND size > 0 THEN greatest(0, least(10, 2 + round_even(diff * (size / period) / greatest(1, round_even(overlap / period, 0)), 0)))::BIGINT ELSE 2 END AS label FROM (
  SELECT *, CASE WHEN p > 0 THEN p ELSE nullif(size, 0) END AS period FROM (SELECT l_orderkey, l_linenumber, l_quantity - 5 AS overlap, (l_partkey % 40)::DOUBLE AS size, (l_suppkey % 9 - 1)::DOUBLE AS p, l_linenumber - 4 AS diff FROM lineitem))) GROUP BY ALL"""


def strata_count(spark, sf):
    flags = ("N", "R")
    strata = [intervals.merge(spans(spark, sf, f"l_returnflag = '{x}'")).drop("n").withColumn("stratum", F.lit(x)) for x in flags]
    d = lines(spark, sf, A).groupBy("grp", "l_orderkey").agg(F.min("s").alias("s"), F.max("e").alias("e")).withColumn("id", F.col("l_orderkey") * 1_000_000 + F.col("grp"))
    return evaluation.in_strata(d, reduce(lambda a, b: a.unionByName(b), strata)).groupBy("grp", "stratum").agg(F.count("*").alias("n"))


STRATA_COUNT = " UNION ALL ".join(
    f"SELECT i.grp, '{x}' AS stratum, count(*) AS n FROM (SELECT grp, l_orderkey, min(s) AS s, max(e) AS e FROM {SPANS} WHERE {A} GROUP BY grp, l_orderkey) i JOIN ({merged_sql(f'l_returnflag = {chr(39)}{x}{chr(39)}')}) m ON m.grp = i.grp AND m.s <= i.s AND m.e >= i.e GROUP BY i.grp"
    for x in ("N", "R")
)


def bin_region_lookup(spark, sf):
    """Chunks that a supplier's region has to read, lines standing for chunks of bins on all six levels."""
    number = F.pmod(F.col("l_partkey") * 7919 + F.col("l_orderkey") * 31, F.lit(37449))
    chunks = lines(spark, sf).select("grp", number.alias("bin"), F.col("l_orderkey").alias("s"), (F.col("l_orderkey") + F.col("l_quantity").cast("long")).alias("e"))
    at = F.pmod(F.col("s_suppkey") * 1_000_003, F.lit(1 << 28))
    regions = spark.read.parquet(f"{sf}/supplier.parquet").select(F.col("s_suppkey").alias("grp"), F.col("s_suppkey").alias("id"), at.alias("s"), (at + 9_000_000).alias("e"), F.lit(40).cast("long").alias("floor"))
    return index.region_chunks(chunks, regions, ["grp"]).groupBy("grp").agg(F.count("*").alias("n"), F.sum("s").alias("starts"))


BIN_REGION_LOOKUP = """WITH c AS (SELECT l_suppkey AS grp, (l_partkey * 7919 + l_orderkey * 31) % 37449 AS bin, l_orderkey AS s, l_orderkey + l_quantity::BIGINT AS e FROM lineitem),
  k AS (SELECT *, 1 << shift AS wide, CASE shift WHEN 14 THEN 4681 WHEN 17 THEN 585 WHEN 20 THEN 73 WHEN 23 THEN 9 WHEN 26 THEN 1 ELSE 0 END AS first FROM c, (VALUES (14, 4681, 37448), (17, 585, 4680), (20, 73, 584), (23, 9, 72), (26, 1, 8), (29, 0, 0)) l(shift, lo, hi) WHERE bin BETWEEN lo AND hi),
  r AS (SELECT s_suppkey AS grp, s_suppkey * 1000003 % 268435456 AS a, s_suppkey * 1000003 % 268435456 + 9000000 AS b FROM supplier)
SELECT k.grp, count(*) AS n, sum(s)::BIGINT AS starts FROM k JOIN r ON k.grp = r.grp WHERE (bin - first) * wide < b AND (bin - first + 1) * wide > a AND e > 40 GROUP BY k.grp"""


def _neighbours(spark, sf):
    q = F.col("l_quantity").cast("int")
    base = F.lit("ACGTAACCGT")
    return lines(spark, sf).select(
        F.col("grp").cast("string").alias("chrom"), (F.col("s") * 3 + F.col("l_linenumber")).cast("long").alias("pos"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), base.substr(q % 5 + 1, q % 2 + 1).alias("ref"),
        base.substr(q % 7 + 1, q % 3 + 1).alias("alt"), base.substr(q % 4 + 1, F.lit(5)).alias("after"), F.col("l_extendedprice").alias("qual"), (F.col("l_returnflag") != "R").alias("passed"), (q == 50).alias("sv"), F.col("l_linestatus").alias("phase"),
    )


def neighbour_merge(spark, sf):
    """An ordered fold, inside the islands that variants in reach of each other make."""
    return neighbours.merge_neighbours(_neighbours(spark, sf)).select("chrom", "pos", "id", "ref", "alt", "qual", "merged", "members")


def neighbour_merge_sql(reach: int = 5) -> str:
    """Row by row over each chromosome for the stacks, then member by member over each stack for the chains."""
    first = "{'done': false, 'pos': v.pos, 'ref': v.ref, 'after': v.after, 'phase': v.phase, 'rns': [v.rn], 'r': v.ref, 'a': v.alt, 'bad': false, 'q': v.qual, 'sv': v.sv}"
    gap = "(u.pos - c.pos - length(c.ref))"
    more = f"{{'done': false, 'pos': u.pos, 'ref': u.ref, 'after': u.after, 'phase': u.phase, 'rns': list_append(c.rns, u.rn), 'r': c.r || left(c.after, greatest({gap}, 0)) || u.ref, 'a': c.a || left(c.after, greatest({gap}, 0)) || u.alt, 'bad': c.bad OR {gap} < 0, 'q': c.q + u.qual, 'sv': u.sv}}"
    same = "{'done': c.done OR far, 'pos': c.pos, 'ref': c.ref, 'after': c.after, 'phase': c.phase, 'rns': c.rns, 'r': c.r, 'a': c.a, 'bad': c.bad, 'q': c.q, 'sv': c.sv}".replace("far", f"u.pos - c.pos > {reach} + length(c.ref) - 1")
    takes = f"NOT c.done AND u.pos - c.pos <= {reach} + length(c.ref) - 1 AND u.passed AND NOT u.sv AND NOT c.sv AND NOT list_contains(g.merged, u.rn) AND u.phase <> '' AND u.phase = c.phase"
    chain = f"list_reduce(list_filter(m, lambda x: x.rn > v.rn), lambda c, u: CASE WHEN {takes} THEN {more} ELSE {same} END, {first})"
    return f"""WITH RECURSIVE r AS (SELECT l_suppkey::VARCHAR AS chrom, ({DAY} * 3 + l_linenumber)::BIGINT AS pos, l_orderkey * 10 + l_linenumber AS id, substr('ACGTAACCGT', q % 5 + 1, q % 2 + 1) AS ref, substr('ACGTAACCGT', q % 7 + 1, q % 3 + 1) AS alt,
      substr('ACGTAACCGT', q % 4 + 1, 5) AS after, l_extendedprice::DOUBLE AS qual, l_returnflag <> 'R' AS passed, q = 50 AS sv, l_linestatus AS phase FROM (SELECT *, l_quantity::INT AS q FROM lineitem)),
  o AS (SELECT *, row_number() OVER (PARTITION BY chrom ORDER BY pos, id, ref, alt, qual) AS rn FROM r),
  f AS (SELECT chrom, 0::BIGINT AS rn, 0 AS stack, false AS held, NULL::BIGINT AS stop FROM (SELECT DISTINCT chrom FROM o)
    UNION ALL SELECT o.chrom, o.rn, CASE WHEN f.stop IS NOT NULL AND o.pos - f.stop <= {reach} THEN f.stack WHEN o.passed AND NOT o.sv THEN f.stack + 1 ELSE f.stack END, coalesce(o.pos - f.stop <= {reach}, false) OR (o.passed AND NOT o.sv),
      CASE WHEN coalesce(o.pos - f.stop <= {reach}, false) OR (o.passed AND NOT o.sv) THEN CASE WHEN o.passed THEN o.pos + length(o.ref) - 1 ELSE f.stop END END FROM f JOIN o ON o.chrom = f.chrom AND o.rn = f.rn + 1),
  s AS (SELECT chrom, stack, list(o ORDER BY o.rn) AS m FROM f JOIN o USING (chrom, rn) WHERE held GROUP BY chrom, stack HAVING count(*) > 1),
  g AS (SELECT chrom, stack, 0 AS k, []::BIGINT[] AS merged, NULL::STRUCT(rns BIGINT[], r VARCHAR, a VARCHAR, q DOUBLE) AS made FROM s
    UNION ALL SELECT chrom, stack, k, CASE WHEN good THEN merged || c.rns ELSE merged END, CASE WHEN good THEN {{'rns': c.rns, 'r': c.r, 'a': c.a, 'q': c.q}} END FROM (
      SELECT *, v.passed AND NOT list_contains(merged, v.rn) AND len(c.rns) > 1 AND NOT c.bad AS good FROM (SELECT g.chrom, g.stack, g.k + 1 AS k, g.merged, v, {chain} AS c FROM (SELECT g.*, m, m[g.k + 1] AS v FROM g JOIN s USING (chrom, stack) WHERE g.k < len(m)) g))),
  n AS (SELECT o.chrom, o.pos, o.id, made.r AS r, made.a AS a, made.q / len(made.rns) AS qual, len(made.rns) AS members FROM g JOIN o ON o.chrom = g.chrom AND o.rn = made.rns[1] WHERE made IS NOT NULL),
  t AS (SELECT *, coalesce(list_max(list_filter(range(1, least(length(r), length(a))), lambda i: left(r, i::BIGINT) = left(a, i::BIGINT))), 0)::BIGINT AS c FROM n)
SELECT chrom, pos, id, ref, alt, qual, (chrom, rn) IN (SELECT (chrom, unnest(made.rns)) FROM g WHERE made IS NOT NULL) AS merged, 1 AS members FROM o
UNION ALL SELECT chrom, pos + c, id, substr(r, c + 1), substr(a, c + 1), qual, false, members::INT FROM t"""


QUERIES = {f.__name__: f for f in (allele_patch, haplotype_split, haplotype_join, phase_precedence, period_label, strata_count, bin_region_lookup, neighbour_merge, haploid_patches, codon_table, shard_memory, contig_presence, site_union, site_fill)}
ORACLES = {"allele_patch": ALLELE_PATCH, "haplotype_split": HAPLOTYPE_SPLIT, "haplotype_join": HAPLOTYPE_JOIN, "phase_precedence": PHASE_PRECEDENCE, "period_label": PERIOD_LABEL, "strata_count": STRATA_COUNT, "bin_region_lookup": BIN_REGION_LOOKUP, "haploid_patches": HAPLOID_PATCHES, "codon_table": CODON_TABLE, "shard_memory": SHARD_MEMORY, "contig_presence": CONTIG_PRESENCE, "site_union": SITE_UNION, "site_fill": SITE_FILL, "neighbour_merge": neighbour_merge_sql()}
