"""Demonstration queries of the interval and variant operators on the given tables, with their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import evaluation, interval_index, intervals, positional, tags

DAY = "date_diff('day', DATE '1970-01-01', l_shipdate::DATE)"
SPANS = f"(SELECT *, l_suppkey AS grp, {DAY} AS s, {DAY} + floor(l_quantity / 10)::BIGINT + 1 AS e FROM lineitem)"


def lines(spark: SparkSession, sf: str, where: str = "true") -> DataFrame:
    s = F.datediff(F.col("l_shipdate").cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    d = spark.read.parquet(f"{sf}/lineitem.parquet").filter(where).withColumns({"grp": F.col("l_suppkey"), "s": s})
    return d.withColumn("e", F.col("s") + F.floor(F.col("l_quantity") / 10) + 1)


def spans(spark: SparkSession, sf: str, where: str = "true") -> DataFrame:
    return lines(spark, sf, where).select("grp", "s", "e")


def merged_sql(where: str = "true", op: str = ">") -> str:
    return f"""SELECT grp, min(s) AS s, max(e) AS e, count(*) AS n FROM (SELECT grp, s, e, sum(new) OVER (PARTITION BY grp ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS run FROM (
      SELECT grp, s, e, CASE WHEN coalesce(s {op} max(e) OVER (PARTITION BY grp ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) THEN 1 ELSE 0 END AS new FROM {SPANS} WHERE {where})) GROUP BY grp, run"""


def days_sql(where: str) -> str:
    """Every covered day, for an oracle that shares nothing with the sweeps."""
    return f"SELECT DISTINCT grp, unnest(range(s, e)) AS d FROM {SPANS} WHERE {where}"


def islands_sql(days: str) -> str:
    return f"SELECT grp, min(d) AS s, max(d) + 1 AS e FROM (SELECT grp, d, d - row_number() OVER (PARTITION BY grp ORDER BY d) AS k FROM ({days})) GROUP BY grp, k"


A, R = "l_returnflag = 'A'", "l_returnflag = 'R'"


def interval_merge(spark, sf):
    return intervals.merge(spans(spark, sf))


def interval_components(spark, sf):
    return intervals.merge(spans(spark, sf), touching_joins=False)


def interval_overlap_join(spark, sf):
    j = intervals.overlap_join(spans(spark, sf, A), spans(spark, sf, R))
    return j.groupBy("grp").agg(F.count("*").alias("pairs"), F.sum("overlap").alias("days"))


def interval_overlap_small(spark, sf):
    """The same pairs with the larger side's intervals probing arrays of the few largest ones, without a shuffle of either."""
    j = interval_index.small_overlap_join(spans(spark, sf, A), spans(spark, sf, f"{R} AND l_quantity > 45"))
    return j.groupBy("grp").agg(F.count("*").alias("pairs"), F.sum("overlap").alias("days"))


def interval_intersect(spark, sf):
    return intervals.intersect(spans(spark, sf, A), spans(spark, sf, R))


def interval_subtract(spark, sf):
    return intervals.subtract(spans(spark, sf, A), spans(spark, sf, R))


def point_in_interval(spark, sf):
    points = lines(spark, sf, "l_returnflag = 'N'").select("grp", F.col("s").alias("at"))
    j = intervals.containing(points, intervals.merge(spans(spark, sf, R)).drop("n"))
    return j.groupBy("grp", "phase").agg(F.count("*").alias("points"))


RULES: list[tags.Rule] = [
    ("low_depth", ("min_depth",), lambda x: F.col("l_quantity") < x),
    ("high_discount", ("max_discount",), lambda x: F.col("l_discount") >= x),
    ("low_price", ("min_price",), lambda x: F.col("l_extendedprice") < x),
    ("insignificant", ("max_tax", "max_discount2"), lambda x, y: (F.col("l_tax") > x) & (F.col("l_discount") > y)),
]
PRESETS = {"strict": {"min_depth": 10, "max_discount": 0.08, "min_price": 5000, "max_tax": 0.05, "max_discount2": 0.04}, "loose": {"min_depth": 3, "min_price": 1000}}


def rule_tag(spark, sf):
    old = F.array_compact(F.array(F.when(F.col("l_returnflag") == "R", "returned"), F.when(F.col("l_linestatus") == "O", "open")))
    d = lines(spark, sf).withColumn("filter", old)
    out = [tags.tagged(d, RULES, p, clear=["open"]).groupBy(F.array_join("filter", ";").alias("filter")).agg(F.count("*").alias("n")).withColumn("preset", F.lit(k)) for k, p in PRESETS.items()]
    return out[0].unionByName(out[1])


def rule_tag_sql() -> str:
    parts = []
    for k, p in PRESETS.items():
        found = {"low_depth": f"l_quantity < {p['min_depth']}", "low_price": f"l_extendedprice < {p['min_price']}"}
        if "max_discount" in p:
            found |= {"high_discount": f"l_discount >= {p['max_discount']}", "insignificant": f"l_tax > {p['max_tax']} AND l_discount > {p['max_discount2']}"}
        each = ", ".join(f"CASE WHEN {c} THEN '{n}' END" for n, c in sorted(found.items()))
        parts.append(f"SELECT coalesce(nullif(array_to_string(list_sort(list_filter([{each}, CASE WHEN l_returnflag = 'R' THEN 'returned' END], lambda x: x IS NOT NULL)), ';'), ''), 'PASS') AS filter, '{k}' AS preset FROM lineitem")
    return f"SELECT filter, preset, count(*) AS n FROM ({' UNION ALL '.join(parts)}) GROUP BY ALL"


def _truth_and_call(spark, sf):
    # one interval per (order, supplier), numbered by order and supplier
    d = lines(spark, sf).groupBy("grp", "l_orderkey").agg(F.min("s").alias("s"), F.max("e").alias("e"), F.avg("l_discount").alias("x"))
    d = d.select("grp", "s", "e", (F.col("l_orderkey") * 1_000_000 + F.col("grp")).alias("id"), F.when(F.col("x") < 0.05, "Loss").otherwise("Gain").alias("dir"), (F.col("l_orderkey") % 2).alias("odd"))
    return d.filter("odd = 0").drop("odd"), d.filter("odd = 1").drop("odd")


def confusion(spark, sf):
    return evaluation.confusion(*evaluation.outcomes(*_truth_and_call(spark, sf), 0.3))


def confusion_by_size(spark, sf):
    t, c = evaluation.outcomes(*_truth_and_call(spark, sf), 0.3)
    return evaluation.confusion(evaluation.in_bins(t, [2, 4, 6, 5000]), evaluation.in_bins(c, [2, 4, 6, 5000]), "bin")


def best_match(spark, sf):
    return evaluation.outcomes(*_truth_and_call(spark, sf), 0.3)[1].select("id", "tp", "best")


OUTCOMES = f"""i AS (SELECT grp, l_orderkey * 1000000 + grp AS id, l_orderkey % 2 AS odd, min(s) AS s, max(e) AS e, CASE WHEN avg(l_discount) < 0.05 THEN 'Loss' ELSE 'Gain' END AS dir FROM {SPANS} GROUP BY grp, l_orderkey),
p AS (SELECT a.id AS t, b.id AS c, least(a.e, b.e) - greatest(a.s, b.s) AS o FROM i a JOIN i b ON a.grp = b.grp AND a.dir = b.dir AND a.odd = 0 AND b.odd = 1 AND a.s < b.e AND b.s < a.e),
t AS (SELECT i.*, coalesce((SELECT sum(o) FROM p WHERE p.t = i.id) >= 0.3 * (e - s), false) AS tp FROM i WHERE odd = 0),
c AS (SELECT i.*, i.id IN (SELECT p.c FROM p JOIN t ON p.t = t.id WHERE t.tp) AS tp FROM i WHERE odd = 1)"""


def confusion_sql(bins: bool) -> str:
    edge = ", (VALUES ('0-2', 0, 2), ('2-4', 2, 4), ('4-6', 4, 6), ('6-5000', 6, 5000)) b(bin, lo, hi) WHERE e - s BETWEEN lo AND hi" if bins else ""
    by = "bin, " if bins else ""
    each = ", ".join(f"count(*) FILTER (WHERE {w} AND (k.dir IS NULL OR r.dir = k.dir)) AS {n}" for n, w in (("tp_t", "side AND tp"), ("fn", "side AND NOT tp"), ("tp_c", "NOT side AND tp"), ("fp", "NOT side AND NOT tp")))
    return f"""WITH {OUTCOMES}, r AS (SELECT {by}dir, tp, true AS side FROM t{edge} UNION ALL SELECT {by}dir, tp, false FROM c{edge}),
    g AS (SELECT {by}k.dir, {each}, count_if(side) AS n_t, count_if(NOT side) AS n_c FROM r CROSS JOIN (VALUES ('Loss'), ('Gain'), (NULL)) k(dir) GROUP BY {by}k.dir),
    h AS (SELECT {by}dir, tp_t, fn, tp_c, fp, CASE WHEN dir IS NOT NULL AND n_t = 0 THEN 1 ELSE coalesce(tp_t / nullif(tp_t + fn, 0), 0) END AS sensitivity, CASE WHEN dir IS NOT NULL AND n_c = 0 THEN 1 ELSE coalesce(tp_c / nullif(tp_c + fp, 0), 0) END AS precision FROM g)
    SELECT *, coalesce(2 * sensitivity * precision / nullif(sensitivity + precision, 0), 0) AS f1 FROM h"""


def _streams(spark, sf):
    d = lines(spark, sf).withColumn("k", F.col("l_linenumber") % 4)
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    first = evaluation.first_per_position(d, ["l_orderkey", "k"], order)
    return positional.by_stream(first.select("l_orderkey", "k", "l_quantity", "l_discount"), ["l_orderkey"], "k", {f"v{k}": k for k in range(4)})


def positional_merge_4way(spark, sf):
    return _streams(spark, sf).select("l_orderkey", *[F.col(f"v{k}.l_quantity").alias(f"q{k}") for k in range(4)])


def precedence_merge(spark, sf):
    """The first stream with a large discount wins, else both of streams 1 and 2 joined, else stream 3."""
    m = _streams(spark, sf)
    both = F.col("v1").isNotNull() & F.col("v2").isNotNull()
    source = F.when(F.col("v0.l_discount") >= 0.05, "first").when(both, "joined").when(F.col("v3").isNotNull(), "last").when(F.col("v0").isNotNull(), "first")
    value = F.when(source == "first", F.col("v0.l_quantity")).when(source == "joined", F.col("v1.l_quantity") + F.col("v2.l_quantity")).when(source == "last", F.col("v3.l_quantity"))
    return m.select("l_orderkey", source.alias("source"), value.alias("value"))


STREAMS = "m AS (SELECT l_orderkey, " + ", ".join(f"max(l_quantity) FILTER (WHERE k = {k}) AS q{k}, max(l_discount) FILTER (WHERE k = {k}) AS d{k}" for k in range(4)) + """ FROM (
  SELECT *, l_linenumber % 4 AS k, row_number() OVER (PARTITION BY l_orderkey, l_linenumber % 4 ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS rn FROM lineitem) WHERE rn = 1 GROUP BY l_orderkey)"""


def codon_numbering(spark, sf):
    d = lines(spark, sf).withColumn("len", F.col("l_quantity").cast("int"))
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "len"]
    n = positional.triplets(d.select("l_orderkey", *order), "l_orderkey", order, "len")
    return n.groupBy("l_orderkey", "unit").agg(F.count_distinct("l_linenumber").alias("lines"), F.min("base").alias("first_base"))


def _sized(spark, sf):
    return lines(spark, sf).select("grp", "s", (F.col("s") + F.floor(F.col("l_quantity") * 2) + 1).alias("e"), F.col("l_quantity").alias("size"))


def slot_density(spark, sf):
    return positional.density(_sized(spark, sf), 32).withColumn("density", F.round("density", 6))


def topk_sum(spark, sf):
    return positional.top_sum(slot_density(spark, sf), 5, 8.0).withColumn("estimate", F.round("estimate", 4))


def densest_slots(spark, sf):
    return slot_density(spark, sf).orderBy(F.desc("density"), "grp", "slot").limit(25)


DENSITY = f"(SELECT grp, slot, round(sum(share), 6) AS density FROM (SELECT grp, size / (hi - lo + 1) AS share, unnest(range(lo, hi + 1)) AS slot FROM (SELECT grp, l_quantity AS size, s // 32 AS lo, (s + floor(l_quantity * 2)::BIGINT) // 32 AS hi FROM {SPANS})) GROUP BY grp, slot)"


def mark_duplicates(spark, sf):
    """Of documents with one normalised text the longest, then the least id, is kept; the others are marked."""
    d = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "n_chars", F.md5(F.lower(F.trim("text"))).alias("key"))
    best = d.groupBy("key").agg(F.max_by("doc_id", F.struct("n_chars", -F.col("doc_id"))).alias("best"))
    return d.join(best, "key").select("doc_id", (F.col("doc_id") != F.col("best")).alias("duplicate"))


def name_list_semi(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet")
    names = events.filter("event_type = 'purchase'").select("user_id").distinct()
    return events.join(names, "user_id", "left_semi").groupBy("event_type").agg(F.count("*").alias("n"))


QUERIES = {f.__name__: f for f in (interval_merge, interval_components, interval_overlap_join, interval_overlap_small, interval_intersect, interval_subtract, point_in_interval, rule_tag, confusion, confusion_by_size, best_match, positional_merge_4way, precedence_merge, codon_numbering, slot_density, topk_sum, densest_slots, mark_duplicates, name_list_semi)}

ORACLES = {
    "interval_merge": merged_sql(),
    "interval_components": merged_sql(op=">="),
    "interval_overlap_join": f"SELECT a.grp, count(*) AS pairs, sum(least(a.e, b.e) - greatest(a.s, b.s))::BIGINT AS days FROM {SPANS} a JOIN {SPANS} b ON a.grp = b.grp AND a.s < b.e AND b.s < a.e WHERE a.{A} AND b.{R} GROUP BY a.grp",
    "interval_overlap_small": f"SELECT a.grp, count(*) AS pairs, sum(least(a.e, b.e) - greatest(a.s, b.s))::BIGINT AS days FROM {SPANS} a JOIN {SPANS} b ON a.grp = b.grp AND a.s < b.e AND b.s < a.e WHERE a.{A} AND b.{R} AND b.l_quantity > 45 GROUP BY a.grp",
    "interval_intersect": islands_sql(f"({days_sql(A)}) INTERSECT ({days_sql(R)})"),
    "interval_subtract": islands_sql(f"({days_sql(A)}) EXCEPT ({days_sql(R)})"),
    "point_in_interval": f"SELECT p.grp, m.s AS phase, count(*) AS points FROM {SPANS} p LEFT JOIN ({merged_sql(R)}) m ON p.grp = m.grp AND p.s >= m.s AND p.s < m.e WHERE p.l_returnflag = 'N' GROUP BY ALL",
    "rule_tag": rule_tag_sql(),
    "confusion": confusion_sql(False),
    "confusion_by_size": confusion_sql(True),
    "best_match": f"WITH {OUTCOMES} SELECT id, tp, (SELECT t FROM p WHERE p.c = c.id ORDER BY o DESC, t LIMIT 1) AS best FROM c",
    "positional_merge_4way": f"WITH {STREAMS} SELECT l_orderkey, q0, q1, q2, q3 FROM m",
    "precedence_merge": f"""WITH {STREAMS} SELECT l_orderkey, source, CASE source WHEN 'first' THEN q0 WHEN 'joined' THEN q1 + q2 WHEN 'last' THEN q3 END AS value FROM (
      SELECT *, CASE WHEN d0 >= 0.05 THEN 'first' WHEN q1 IS NOT NULL AND q2 IS NOT NULL THEN 'joined' WHEN q3 IS NOT NULL THEN 'last' WHEN q0 IS NOT NULL THEN 'first' END AS source FROM m)""",
    "codon_numbering": """SELECT l_orderkey, (base - 1) // 3 + 1 AS unit, count(DISTINCT l_linenumber) AS lines, min(base) AS first_base FROM (
      SELECT *, unnest(range(upto - len + 1, upto + 1)) AS base FROM (SELECT *, l_quantity::INT AS len, sum(l_quantity::INT) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity ROWS UNBOUNDED PRECEDING)::BIGINT AS upto,
        sum(l_quantity::INT) OVER (PARTITION BY l_orderkey)::BIGINT AS total FROM lineitem)) WHERE ((base - 1) // 3 + 1) * 3 <= total GROUP BY l_orderkey, unit""",
    "slot_density": f"SELECT * FROM {DENSITY}",
    "topk_sum": f"SELECT grp, round(sum(density) * 8, 4) AS estimate FROM (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY density DESC, slot) AS rn FROM {DENSITY}) WHERE rn <= 5 GROUP BY grp",
    "densest_slots": f"SELECT * FROM {DENSITY} ORDER BY density DESC, grp, slot LIMIT 25",
    "mark_duplicates": "SELECT doc_id, row_number() OVER (PARTITION BY lower(trim(text, ' ')) ORDER BY n_chars DESC, doc_id) > 1 AS duplicate FROM documents",
    "name_list_semi": "SELECT event_type, count(*) AS n FROM events WHERE user_id IN (SELECT user_id FROM events WHERE event_type = 'purchase') GROUP BY event_type",
}
