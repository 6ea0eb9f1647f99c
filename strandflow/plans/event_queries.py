"""Queries of the copy-number evaluation on the given tables, with their DuckDB SQL.

Lines stand for events: one per order and supplier, a third of them true, a third called, the rest regions.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import copynumber, evaluation
from .record_queries import ROWS, _rows

OPTIONS = {"least_overlap": 0.3, "least_distance": 0.5, "least_size": 3}


def _events(spark, sf):
    d = _rows(spark, sf).withColumns({"k": F.col("l_orderkey") % 3, "size": F.col("e") - F.col("s")})
    tags = F.when(F.col("part") % 17 == 0, F.array(F.lit("low"))).otherwise(F.array(F.lit("PASS")))
    truth = d.filter("k = 0").select(
        "grp", "s", "e", "id", (F.col("q") % 5 - 2).cast("long").alias("diff"), "size", F.when(F.col("q") % 4 == 0, F.lit(2).cast("long")).alias("period"), F.when(F.col("q") % 3 > 0, F.col("tax") * 20).alias("distance"), tags.alias("filter")
    )
    call = d.filter("k = 1").select("grp", "s", "e", "id", (F.col("q") % 6).cast("long").alias("cn"), "size", tags.alias("filter"))
    return truth, call, d.filter("k = 2").select("grp", "s", "e", "part")


EVENTS = f"""{ROWS}, v AS (SELECT *, l_orderkey % 3 AS k, e - s AS size FROM i WHERE part % 17 > 0 OR l_orderkey % 3 = 2),
  days AS (SELECT DISTINCT grp, unnest(range(s, e)) AS d FROM v WHERE k = 2),
  n AS (SELECT v.id, count(days.d) AS n FROM v LEFT JOIN days ON days.grp = v.grp AND days.d >= v.s AND days.d < v.e GROUP BY v.id),
  t AS (SELECT v.*, q % 5 - 2 AS diff, n.n >= size AS inside, n.n > 0 AS touches, least(CASE WHEN q % 4 = 0 THEN 2 ELSE size END, size) >= 3 AS large, coalesce(CASE WHEN q % 3 > 0 THEN tax * 20 END, 1) >= 0.5 AS far, CASE WHEN q % 4 = 0 THEN 2 END AS period FROM v JOIN n USING (id) WHERE k = 0 AND q % 5 <> 2),
  c AS (SELECT v.*, q % 6 AS cn, n.n >= size AS inside, n.n > 0 AS touches, size >= 3 AS large FROM v JOIN n USING (id) WHERE k = 1 AND q % 6 <> 2),
  u AS (SELECT grp, s, e, id, true AS side FROM t UNION ALL SELECT grp, s, e, id, false FROM c),
  r AS (SELECT *, sum(new) OVER (PARTITION BY grp ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS run FROM (SELECT *, CASE WHEN coalesce(s >= max(e) OVER (PARTITION BY grp ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) THEN 1 ELSE 0 END AS new FROM u)),
  m AS (SELECT grp, run, grp || ':' || min(s) || '-' || max(e) AS component, count_if(side) AS nt, count_if(NOT side) AS nc FROM r GROUP BY grp, run),
  tr AS (SELECT t.*, m.run, component, nt, nc FROM t JOIN r ON r.id = t.id JOIN m ON m.grp = r.grp AND m.run = r.run), cr AS (SELECT c.*, m.run, component, nt, nc FROM c JOIN r ON r.id = c.id JOIN m ON m.grp = r.grp AND m.run = r.run),
  p AS (SELECT a.id AS a, b.id AS b, least(a.e, b.e) - greatest(a.s, b.s) AS o, a.s AS a_s, a.e AS a_e, a.size AS a_size, a.large AS a_large, a.touches AS a_touches, b.s AS b_s, b.e AS b_e, b.size AS b_size FROM tr a JOIN cr b ON a.grp = b.grp AND a.s < b.e AND b.s < a.e AND (b.cn - 2) * a.diff > 0),
  f AS (SELECT a, sum(o) AS cover, string_agg(b_s || '-' || b_e, ',' ORDER BY b_s, b) AS call, string_agg(b_size::VARCHAR, ',' ORDER BY b_s, b) AS call_size FROM p GROUP BY a),
  te AS (SELECT tr.*, f.call, f.call_size, nc > 0 AND size > 0 AND coalesce(cover / size >= 0.3, false) AS found,
    EXISTS (SELECT 1 FROM cr WHERE cr.grp = tr.grp AND cr.run = tr.run AND (cr.cn - 2) * tr.diff > 0 AND (cr.large OR tr.large) AND (cr.touches OR tr.touches)) AS deserved FROM tr LEFT JOIN f ON f.a = tr.id),
  tv AS (SELECT *, CASE WHEN found THEN CASE WHEN deserved THEN 'TP' END WHEN large AND far AND inside THEN 'FN' END AS eval FROM te),
  b AS (SELECT * FROM (SELECT p.*, row_number() OVER (PARTITION BY p.b ORDER BY o DESC, a_s, a) AS k FROM p JOIN te ON te.id = p.a WHERE te.found) WHERE k = 1),
  ce AS (SELECT cr.*, b.a_s, b.a_e, b.a_size, b.a IS NOT NULL AND (a_large OR large) AND (a_touches OR touches) AS own FROM cr LEFT JOIN b ON b.b = cr.id),
  ev AS (SELECT * FROM (SELECT grp, run, bool_or(own) AS tp, arg_min(cn, (s, id)) AS cn, sum(size)::BIGINT AS size, bool_and(inside) AS inside FROM ce WHERE nt > 0 GROUP BY grp, run) WHERE tp OR (size >= 3 AND inside)),
  cv AS (SELECT ce.*, CASE WHEN nt > 0 THEN CASE WHEN ev.run IS NOT NULL THEN CASE WHEN own THEN 'TP' ELSE 'FP' END END WHEN ce.size >= 3 AND ce.inside THEN 'FP' END AS eval FROM ce LEFT JOIN ev ON ev.grp = ce.grp AND ev.run = ce.run),
  ts AS (SELECT grp, diff + 2 AS cn, size, eval FROM tv WHERE eval IS NOT NULL),
  cs AS (SELECT grp, cn, size, 0 AS truth_size, eval FROM cv WHERE nt = 0 AND eval IS NOT NULL UNION ALL SELECT ev.grp, ev.cn, ev.size, CASE WHEN tp THEN coalesce((SELECT max(size) FROM te WHERE te.grp = ev.grp AND te.run = ev.run AND found), 0) ELSE 0 END, CASE WHEN tp THEN 'TP' ELSE 'FP' END FROM ev)"""


def _spans(regions):
    return regions.select("grp", "s", "e")


def event_truth(spark, sf):
    """Verdicts of true events, with the calls that found them."""
    t, c, r = _events(spark, sf)
    return copynumber.evaluate(t, c, _spans(r), **OPTIONS).truth


def event_calls(spark, sf):
    """Verdicts of called events, with the true events that they found."""
    t, c, r = _events(spark, sf)
    return copynumber.evaluate(t, c, _spans(r), **OPTIONS).call


def event_summary(spark, sf):
    t, c, r = _events(spark, sf)
    got = copynumber.evaluate(t, c, _spans(r), **OPTIONS)
    return copynumber.summary(got.truth_stats, got.call_stats)


def event_summary_by_length(spark, sf):
    t, c, r = _events(spark, sf)
    got = copynumber.evaluate(t, c, _spans(r), **OPTIONS)
    return copynumber.by_length(got.truth_stats, got.call_stats, [3, 5, 9])


def event_strata(spark, sf):
    """The summary in strata of regions: those of odd and of even parts."""
    t, c, r = _events(spark, sf)
    strata = r.select(F.when(F.col("part") % 2 == 1, "odd").otherwise("even").alias("stratum"), "grp", "s", "e")
    ts, cs = copynumber.stratified(t, c, strata, ["odd", "even"], _spans(r.filter("part % 5 > 0")), **OPTIONS)
    return copynumber.summary(ts, cs, "stratum")


def event_labels(spark, sf):
    """Labels of called events by the true events that they overlap."""
    t, c, r = _events(spark, sf)
    return copynumber.labelled(t, c, _spans(r))


def summary_sql(events: str, edge: str = "", by: str = "") -> str:
    sums = ", ".join(f"count(*) FILTER (WHERE {w} AND (k.dir IS NULL OR x.dir = k.dir)) AS {n}" for n, w in (("tp_t", "side AND eval = 'TP'"), ("fn", "side AND eval = 'FN'"), ("tp_c", "NOT side AND eval = 'TP'"), ("fp", "NOT side AND eval = 'FP'")))
    return f"""WITH {events}, w AS (SELECT CASE WHEN cn < 2 THEN 'Loss' WHEN cn > 2 THEN 'Gain' END AS dir, size AS at, eval, true AS side FROM ts UNION ALL SELECT CASE WHEN cn < 2 THEN 'Loss' WHEN cn > 2 THEN 'Gain' END, CASE WHEN truth_size <> 0 THEN truth_size ELSE size END, eval, false FROM cs),
  x AS (SELECT * FROM w{edge}), y AS (SELECT {by}k.dir, {sums}, count_if(side) AS n_t, count_if(NOT side) AS n_c FROM x CROSS JOIN (VALUES ('Loss'), ('Gain'), (NULL)) k(dir) GROUP BY {by}k.dir),
  z AS (SELECT {by}dir, tp_t, fn, tp_c, fp, CASE WHEN dir IS NOT NULL AND n_t = 0 THEN 1 ELSE coalesce(tp_t / nullif(tp_t + fn, 0), 0) END AS sensitivity, CASE WHEN dir IS NOT NULL AND n_c = 0 THEN 1 ELSE coalesce(tp_c / nullif(tp_c + fp, 0), 0) END AS precision FROM y)
SELECT *, coalesce(2 * sensitivity * precision / nullif(sensitivity + precision, 0), 0) AS f1 FROM z"""


LARGEST = "(SELECT max(size) FROM (SELECT size FROM ts UNION ALL SELECT size FROM cs))"
CUTS = f", (SELECT lo || '-' || hi AS bin, lo, hi FROM (SELECT unnest([0, 3, 5, 9]) AS lo, unnest([3, 5, 9, {LARGEST}]) AS hi) WHERE hi > lo) b WHERE w.at >= lo AND w.at <= hi"


def strata_sql() -> str:
    """The summary of each stratum by itself, its days limited to those of the regions."""
    parts = []
    for name, odd in (("odd", 1), ("even", 0)):
        days = f"days AS (SELECT DISTINCT grp, unnest(range(s, e)) AS d FROM v WHERE k = 2 AND part % 2 = {odd} INTERSECT SELECT grp, unnest(range(s, e)) FROM v WHERE k = 2 AND part % 5 > 0)"
        old = "days AS (SELECT DISTINCT grp, unnest(range(s, e)) AS d FROM v WHERE k = 2)"
        assert old in EVENTS
        parts.append(f"SELECT *, '{name}' AS stratum FROM ({summary_sql(EVENTS.replace(old, days))})")
    return " UNION ALL ".join(parts)


QUERIES = {f.__name__: f for f in (event_truth, event_calls, event_summary, event_summary_by_length, event_strata, event_labels)}
ORACLES = {
    "event_truth": f"WITH {EVENTS} SELECT id, eval, CASE WHEN eval IS NOT NULL THEN component END AS component, CASE WHEN eval = 'TP' THEN call END AS call, CASE WHEN eval = 'TP' THEN call_size END AS call_size FROM tv",
    "event_calls": f"WITH {EVENTS} SELECT id, eval, CASE WHEN eval IS NOT NULL THEN component END AS component, CASE WHEN eval = 'TP' THEN a_s || '-' || a_e END AS truth, CASE WHEN eval = 'TP' THEN a_size::VARCHAR END AS truth_size FROM cv",
    "event_summary": summary_sql(EVENTS),
    "event_summary_by_length": summary_sql(EVENTS, CUTS, "bin, "),
    "event_strata": strata_sql(),
    "event_labels": f"""WITH {EVENTS}, al AS (SELECT v.id, v.grp, v.s, v.e, v.size, n.n >= v.size AS inside FROM (SELECT *, l_orderkey % 3 AS k, e - s AS size FROM i) v JOIN (
      SELECT x.id, count(days.d) AS n FROM i x LEFT JOIN days ON days.grp = x.grp AND days.d >= x.s AND days.d < x.e GROUP BY x.id) n USING (id) WHERE k = 1),
    best AS (SELECT * FROM (SELECT c.id, t.diff, t.size::DOUBLE AS size, coalesce(t.period, t.size)::DOUBLE AS period, least(t.e, c.e) - greatest(t.s, c.s) AS o, row_number() OVER (PARTITION BY c.id ORDER BY least(t.e, c.e) - greatest(t.s, c.s) DESC, t.s, t.id) AS k
      FROM al c JOIN t ON t.grp = c.grp AND t.s < c.e AND c.s < t.e WHERE t.inside AND (least(t.e, c.e) - greatest(t.s, c.s)) / c.size >= 0.3) WHERE k = 1)
    SELECT al.id, coalesce(CASE WHEN best.id IS NOT NULL THEN greatest(0, least(10, 2 + round_even(diff * (best.size / period) / greatest(1, round_even(o / period, 0)), 0)))::BIGINT END, CASE WHEN inside THEN 2 END) AS label FROM al LEFT JOIN best USING (id)""",
}
