"""Queries of the somatic rules, genotype arrays, block combining and copy-number events on the given tables, with their DuckDB SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..functions import genotypes, somatic
from ..operators import blocks, copynumber, neighbours, tags
from .queries import SPANS, lines


def _rows(spark, sf):
    """One row per order and supplier."""
    d = lines(spark, sf).groupBy("grp", "l_orderkey").agg(F.min("s").alias("s"), F.max("e").alias("e"), F.max("l_quantity").cast("int").alias("q"), F.min("l_partkey").alias("part"), F.max("l_tax").alias("tax"))
    return d.withColumn("id", F.col("l_orderkey") * 1_000_000 + F.col("grp"))


ROWS = f"i AS (SELECT grp, l_orderkey, l_orderkey * 1000000 + grp AS id, min(s) AS s, max(e) AS e, max(l_quantity)::INT AS q, min(l_partkey) AS part, max(l_tax) AS tax FROM {SPANS} GROUP BY grp, l_orderkey)"
EVERY = {"min_depth": 20, "min_tumor_af": 0.3, "max_normal_af": 0.05, "min_qd": 900, "min_map_qual_ranksum": 2, "clear": "all"}


def somatic_rules(spark, sf):
    """Tags of lines under every preset, and under the parameters that no preset sets."""
    text = lambda c: F.col(c).cast("string")
    some = lambda **kv: F.map_filter(F.map_from_arrays(F.array(*map(F.lit, kv)), F.array(*kv.values())), lambda _, v: v.isNotNull())
    q, n = F.col("l_quantity").cast("int"), F.col("l_linenumber")
    flag = some(STR=F.when(F.col("l_returnflag") == "A", F.lit("")))
    info = F.map_concat(flag, some(PV=text("l_discount"), PV2=(F.col("l_tax") * 2).cast("string"), SOR=n.cast("string"), ECNT=(q % 14).cast("string"), RPA=F.when(F.col("l_linestatus") == "O", F.concat_ws(",", (q % 12).cast("string"), F.lit("3"))).otherwise(F.lit("."))))
    tumor = some(AD=F.concat_ws(",", q.cast("string"), n.cast("string")), AF=(q / 64).cast("string"), ReadPosRankSumPS=(-n).cast("string"), BaseQRankSumPS=(-q / 8).cast("string"), NBQPS=q.cast("string"), MQRankSumPS=(n / 2).cast("string"), ALTHC=(n - 2).cast("string"), FOXOG=F.when(n > 3, (q % 3 / 2).cast("string")))
    d = lines(spark, sf).select(
        "l_returnflag", (F.col("l_extendedprice") / 1000).alias("qual"), info.alias("info"), tumor.alias("tumor"), F.when(n != 1, some(AF=text("l_tax"))).alias("normal"),
        F.array_compact(F.array(F.when(F.col("l_returnflag") == "R", "triallelic_site"), F.when(F.col("l_linestatus") == "F", "old"))).alias("filter"),
    )
    cases = (somatic.PRESETS | {"none": EVERY}).items()
    # a pass for each preset: all rules of all presets in one projection make a method too long for the JVM to compile
    out = [d.select("l_returnflag", F.array_join(tags.merged(F.col("filter"), tags.tags(somatic.RULES, x), x["clear"]), ";").alias("filter")).groupBy("l_returnflag", "filter").agg(F.count("*").alias("n")).withColumn("preset", F.lit(p)) for p, x in cases]
    return reduce(lambda a, b: a.unionByName(b), out)


def tag_chain(spark, sf):
    """Lines tagged by the chain for whole genomes, tags in the order of its steps."""
    q, n = F.col("l_quantity").cast("int"), F.col("l_linenumber")
    info = F.create_map(*[x for k, v in {"PV": F.col("l_discount") * 5, "PV2": F.col("l_tax") * 5, "SOR": n, "ECNT": q % 14, "RPA": F.concat_ws(",", q % 12, F.lit(3))}.items() for x in (F.lit(k), v.cast("string"))])
    info = F.when(F.col("l_returnflag") == "A", F.map_concat(info, F.create_map(F.lit("STR"), F.lit(None).cast("string")))).otherwise(info)
    tumor = F.create_map(F.lit("FOXOG"), (q % 3 / 2).cast("string"), F.lit("ReadPosRankSumPS"), F.when(n > 1, (-q / 4).cast("string")))
    old = F.array_compact(F.array(F.when(F.col("l_returnflag") == "R", "triallelic_site"), F.when(F.col("l_linestatus") == "F", "old")))
    d = somatic.unflag(lines(spark, sf).select("l_linestatus", (F.col("l_extendedprice") / 100).alias("qual"), info.alias("info"), tumor.alias("tumor"), old.alias("filter")), "triallelic_site")
    d = somatic.flag(d, [(name, x) for name, x, _ in somatic.steps(somatic.WHOLE_GENOME, min_qual=300)])
    return d.groupBy("l_linestatus", F.array_join("filter", ";").alias("filter")).agg(F.count("*").alias("n"))


TAG_CHAIN = """SELECT l_linestatus, coalesce(nullif(array_to_string(list_filter([CASE WHEN l_linestatus = 'F' THEN 'old' END,
  CASE WHEN (l_discount * 5 > 0.25 AND l_tax * 5 > 0.25) OR (l_returnflag = 'A' AND l_discount * 5 > 0.05) THEN 'insignificant' END, CASE WHEN q % 3 = 2 THEN 'orientation_bias' END, CASE WHEN l_linenumber > 3 THEN 'strand_bias' END,
  CASE WHEN l_extendedprice / 100 < 300 THEN 'low_qual' END, CASE WHEN q % 12 >= 10 THEN 'short_tandem_repeat' END, CASE WHEN q % 14 > 5 THEN 'noisy_region' END, CASE WHEN l_linenumber > 1 AND q > 32 THEN 'read_pos_bias' END], lambda x: x IS NOT NULL), ';'), ''), 'PASS') AS filter, count(*) AS n
FROM (SELECT *, l_quantity::INT AS q FROM lineitem) GROUP BY ALL"""


def somatic_sql() -> str:
    """Every rule as a comparison of the table's own columns."""
    rules = {
        "alt_allele_in_normal": ("l_linenumber <> 1 AND l_tax >= {}", ["max_normal_af"]), "base_qual_bias": ("-q / 8 < {}", ["min_base_qual_ranksum"]), "depth_high_conf": ("l_linenumber - 2 < {}", ["min_depth_high_conf"]),
        "insignificant": ("l_discount > {} AND l_tax * 2 > {}", ["max_pv", "max_pv2"]), "insignificant_str": ("l_returnflag = 'A' AND l_discount > {}", ["max_str_pv"]), "low_allele_frac": ("q / 64 < {}", ["min_tumor_af"]),
        "low_depth": ("q + l_linenumber < {}", ["min_depth"]), "low_qual": ("l_extendedprice / 1000 < {}", ["min_qual"]), "low_qual_by_depth": ("l_extendedprice / 1000 < {}::DOUBLE * l_linenumber", ["min_qd"]),
        "map_qual_bias": ("l_linenumber / 2 < {}", ["min_map_qual_ranksum"]), "neighbor_base_qual": ("q < {}", ["min_neighbor_base_qual"]), "noisy_region": ("q % 14 > {}", ["max_ecnt"]),
        "orientation_bias": ("l_linenumber > 3 AND (q % 3) / 2 >= {}", ["max_foxog"]), "read_pos_bias": ("-l_linenumber < {}", ["min_read_pos_ranksum"]), "short_tandem_repeat": ("l_linestatus = 'O' AND q % 12 >= {}", ["max_str_length"]),
        "strand_bias": ("l_linenumber > {}", ["max_sor"]),
    }
    out = []
    for preset, params in (somatic.PRESETS | {"none": EVERY}).items():
        found = [f"CASE WHEN {text.format(*[params[p] for p in needs])} THEN '{name}' END" for name, (text, needs) in rules.items() if all(p in params for p in needs)]
        old = [] if params["clear"] == "all" else ["CASE WHEN l_linestatus = 'F' THEN 'old' END"]
        out.append(f"SELECT l_returnflag, '{preset}' AS preset, list_aggregate(list_sort(list_filter([{', '.join(found + old)}], lambda x: x IS NOT NULL)), 'string_agg', ';') AS tags FROM (SELECT *, l_quantity::INT AS q FROM lineitem)")
    return f"SELECT l_returnflag, preset, coalesce(nullif(tags, ''), 'PASS') AS filter, count(*) AS n FROM ({' UNION ALL '.join(out)}) GROUP BY ALL"


def best_alleles(spark, sf):
    """The two best alleles of records of up to four, and what stays of their arrays by allele and by genotype."""
    n = F.col("q") % 4 + 1
    size = ((n + 1) * (n + 2) / 2).cast("int") - F.when(F.col("q") % 11 == 0, 1).otherwise(0)
    d = _rows(spark, sf).select(
        "id", F.transform(F.sequence(F.lit(1), n), lambda i: F.concat(F.lit("A"), i.cast("string"))).alias("alt"),
        F.transform(F.sequence(F.lit(0), size - 1), lambda k: ((F.col("q") * 7 + k * 13 + F.col("part")) % 17).cast("int")).alias("pl"), F.transform(F.sequence(F.lit(0), n), lambda i: F.col("q") + i).alias("ad"),
    )
    d = d.withColumn("chosen", genotypes.best_pair(F.col("alt"), F.col("pl")))
    joined = lambda c, count: F.array_join(F.transform(genotypes.subset(F.col(c), count, F.col("chosen")), lambda x: x.cast("string")), ",", "-")
    return d.select("id", F.array_join(F.transform("chosen", lambda x: x.cast("string")), ",").alias("best"), joined("alt", "A").alias("alts"), joined("ad", "R").alias("ad"), joined("pl", "G").alias("pl"))


BEST_ALLELES = f"""WITH {ROWS}, g AS (SELECT a, b, (row_number() OVER (ORDER BY b, a) - 1)::INT AS k FROM range(5) x(a), range(5) y(b) WHERE a <= b),
  r AS (SELECT *, q % 4 + 1 AS n, CASE WHEN q % 11 = 0 THEN 1 ELSE 0 END AS short FROM i),
  l AS (SELECT r.*, g.*, (q * 7 + k * 13 + part) % 17 AS p FROM r JOIN g ON g.b <= r.n AND k < (n + 1) * (n + 2) // 2 - short),
  o AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY p, k) AS rn FROM l WHERE k > 0) WHERE rn = 1),
  s AS (SELECT * FROM (SELECT l.id, l.b AS other, row_number() OVER (PARTITION BY l.id ORDER BY l.p, l.k) AS rn FROM l JOIN o ON l.id = o.id WHERE l.k > 0 AND l.k <> o.k AND (l.a = 0 OR l.a = o.b OR l.b = o.b)) WHERE rn = 1),
  c AS (SELECT r.*, CASE WHEN r.n = 1 THEN [1] WHEN r.short = 0 THEN list_sort(list_distinct(list_filter(CASE WHEN o.a = 0 OR o.a = o.b THEN [o.a, o.b, s.other] ELSE [o.a, o.b] END, lambda x: x > 0))) END AS best FROM r LEFT JOIN o USING (id) LEFT JOIN s USING (id))
SELECT id, array_to_string(best, ',') AS best, array_to_string(list_transform(best, lambda x: 'A' || x), ',') AS alts, array_to_string(list_transform([0] || best, lambda x: q + x), ',') AS ad,
  array_to_string(flatten(list_transform([0] || best, lambda b: list_transform(list_filter([0] || best, lambda a: a <= b), lambda a: CASE WHEN b * (b + 1) // 2 + a < (n + 1) * (n + 2) // 2 - short THEN ((q * 7 + (b * (b + 1) // 2 + a) * 13 + part) % 17)::VARCHAR ELSE '-' END))), ',') AS pl
FROM c WHERE best IS NOT NULL UNION ALL SELECT id, NULL, NULL, NULL, NULL FROM c WHERE best IS NULL"""


def block_combine(spark, sf):
    d = _rows(spark, sf).select("grp", "s", "e", "id", F.lit("A").alias("ref"), F.when(F.col("part") % 3 == 1, F.array(F.lit(blocks.ANY))).otherwise(F.array(F.lit("C"), F.lit("G"))).alias("alt"), F.lit("0/1").alias("gt"), (F.col("part") % 3).alias("k"))
    out = blocks.combine(d.filter("k > 0").drop("k"), d.filter("k = 0").drop("k"))
    return out.select("grp", "s", "e", "id", F.size("alt").alias("n_alt"), "gt")


BLOCK_COMBINE = f"""WITH RECURSIVE {ROWS}, v AS (SELECT * FROM i WHERE part % 3 = 0), b AS (SELECT * FROM i WHERE part % 3 = 1),
  m AS (SELECT *, row_number() OVER (PARTITION BY grp, s ORDER BY e, id) AS rn FROM i WHERE part % 3 = 2),
  h AS (SELECT b.id, b.grp, b.s AS lo, b.e AS hi, v.s, v.e FROM b JOIN v ON v.grp = b.grp AND v.s >= b.s AND v.s < b.e),
  c AS (SELECT id, grp, lo, hi, struct_pack(s := min((s, e))[1], e := min((s, e))[2]) AS x FROM h GROUP BY ALL UNION ALL
    SELECT c.id, c.grp, c.lo, c.hi, struct_pack(s := min((h.s, h.e))[1], e := min((h.s, h.e))[2]) FROM c JOIN h ON h.id = c.id AND h.s >= c.x.e GROUP BY c.id, c.grp, c.lo, c.hi),
  d AS (SELECT grp, id, unnest(range(s, e)) AS d FROM b EXCEPT SELECT grp, id, unnest(range(x.s, x.e)) FROM c),
  p AS (SELECT grp, id, min(d) AS s, max(d) + 1 AS e FROM (SELECT *, d - row_number() OVER (PARTITION BY id ORDER BY d) AS k FROM d) GROUP BY grp, id, k)
SELECT grp, s, e, id, 1 AS n_alt, '0/1' AS gt FROM p UNION ALL SELECT grp, s, e, id, 2, '0/0' FROM m WHERE rn > 1 OR NOT EXISTS (SELECT 1 FROM v WHERE v.grp = m.grp AND v.s = m.s)
UNION ALL SELECT grp, s, e, id, 3, '0/1' FROM v"""


def copy_number_events(spark, sf):
    """Components of true and called events, and the events that calls make of them; calls must lie in the regions of large lines."""
    d = _rows(spark, sf)
    cn = copynumber.copy_number(F.when(F.col("q") % 2 == 0, F.col("q") % 5), F.when(F.col("q") % 3 == 0, F.col("part") % 4).cast("int"))
    d = d.select("grp", "s", "e", "id", cn.alias("cn"), (F.col("e") - F.col("s")).alias("size"), (F.col("tax") >= 0.04).alias("tp"), (F.col("l_orderkey") % 3).alias("k"))
    call = d.filter("k = 1").drop("k")
    inside = copynumber.confident(call, d.filter("k = 2").select("grp", "s", "e")).filter("inside").select("id")
    return copynumber.call_events(copynumber.components(d.filter("k = 0").drop("k"), call), inside, least=3)


COPY_NUMBER_EVENTS = f"""WITH {ROWS}, d AS (SELECT *, l_orderkey % 3 AS k, e - s AS size, tax >= 0.04 AS tp, (CASE WHEN q % 2 = 0 THEN q % 5 WHEN q % 3 = 0 THEN part % 4 ELSE 2 END)::INT AS cn FROM i),
  r AS (SELECT *, sum(new) OVER (PARTITION BY grp ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS run FROM (SELECT *, CASE WHEN coalesce(s >= max(e) OVER (PARTITION BY grp ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) THEN 1 ELSE 0 END AS new FROM d WHERE k < 2)),
  days AS (SELECT DISTINCT grp, unnest(range(s, e)) AS d FROM d WHERE k = 2), h AS (SELECT c.id, count(*) = any_value(c.size) AS inside FROM d c JOIN days ON days.grp = c.grp AND days.d >= c.s AND days.d < c.e WHERE c.k = 1 GROUP BY c.id),
  a AS (SELECT grp, grp || ':' || min(s) || '-' || max(e) AS component, arg_min(cn, (s, id)) FILTER (WHERE k = 1 AND cn <> 2) AS cn, sum(size) FILTER (WHERE k = 1 AND cn <> 2)::BIGINT AS size, coalesce(bool_or(tp) FILTER (WHERE k = 1 AND cn <> 2), false) AS tp,
    max(size) FILTER (WHERE k = 0 AND tp) AS largest, bool_and(coalesce(inside, false)) FILTER (WHERE k = 1 AND cn <> 2) AS every FROM r LEFT JOIN h USING (id) GROUP BY grp, run)
SELECT grp, component, cn, size, CASE WHEN tp THEN coalesce(largest, 0) ELSE 0 END AS truth_size, tp FROM a WHERE size IS NOT NULL AND (tp OR (size >= 3 AND every))"""


def codons_covered(spark, sf):
    """Codons of lines whose part names their place, by a table of three places a codon over all places of lines and the four after each."""
    at = lambda c: F.col(c).cast("long")
    v = _rows(spark, sf).select(F.col("grp").cast("string").alias("chrom"), at("part").alias("pos"), "id", F.lit("ACGTACGT").substr(F.lit(1), F.col("q") % 5 + 1).alias("ref"))
    places = lines(spark, sf).select(F.col("grp").cast("string").alias("chrom"), F.explode(F.sequence(at("l_partkey"), at("l_partkey") + 4)).alias("pos")).distinct()
    table = places.filter("pos % 7 > 0").withColumn("codon", F.concat("chrom", F.lit("-"), F.floor(F.col("pos") / 3).cast("string")))
    return neighbours.with_codons(v, table).select("id", F.array_join("codons", ",").alias("codons"))


CODONS_COVERED = f"""WITH {ROWS}, p AS (SELECT id, grp, unnest(CASE WHEN q % 5 = 0 THEN [part] ELSE range(part + 1, part + q % 5 + 1) END) AS place FROM i),
  c AS (SELECT DISTINCT id, grp || '-' || (place // 3) AS codon FROM p WHERE place % 7 > 0)
SELECT i.id, coalesce(string_agg(codon, ',' ORDER BY codon), '') AS codons FROM i LEFT JOIN c USING (id) GROUP BY i.id"""

QUERIES = {f.__name__: f for f in (somatic_rules, tag_chain, best_alleles, block_combine, copy_number_events, codons_covered)}
ORACLES = {"somatic_rules": somatic_sql(), "tag_chain": TAG_CHAIN, "best_alleles": BEST_ALLELES, "block_combine": BLOCK_COMBINE, "copy_number_events": COPY_NUMBER_EVENTS, "codons_covered": CODONS_COVERED}
