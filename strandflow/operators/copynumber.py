"""Copy-number events: resolution of the number, gates of size and region, evaluation by component of overlapping events."""

from __future__ import annotations

from functools import partial, reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import kept, step
from . import evaluation
from .intervals import intersect, merge, overlap_join, runs

# Tags that an accepted record may carry.
ACCEPTED = ("PASS", "cnvLength")


def copy_number(info: Column, sample: Column, neutral: int = 2, difference: bool = False) -> Column:
    """A record's number from its INFO value, else its first sample's; neutral where both are null. Differences count from neutral."""
    value = F.coalesce(info, sample)
    return F.coalesce(value + neutral if difference else value, F.lit(neutral))


def event_class(cn: Column, neutral: int = 2) -> Column:
    return F.when(cn < neutral, "Loss").when(cn > neutral, "Gain").otherwise("Neutral")


def accepted(tags: Column) -> Column:
    """Whether a record carries accepted tags only."""
    return F.coalesce(F.size(F.array_except(tags, F.array(*map(F.lit, ACCEPTED)))) <= 0, F.lit(True))


def confident(events: DataFrame, regions: DataFrame | None, disjoint: bool = False) -> DataFrame:
    """Adds fraction, inside and any: how much of an event (grp, s, e, id) lies in regions (known to be disjoint or not). Without regions all of it does."""
    if regions is None:
        return events.withColumns({"fraction": F.lit(1.0), "inside": F.lit(True), "any": F.lit(True)})
    j = overlap_join(events.select("grp", "s", "e", "id"), regions if disjoint else step(lambda: merge(regions).drop("n")))
    within = j.groupBy(F.col("a_id").alias("id")).agg(F.sum("overlap").alias("within"))
    d = events.join(within, "id", "left").withColumn("fraction", F.coalesce(F.col("within") / F.nullif(F.greatest(F.col("e") - F.col("s"), F.lit(0)), F.lit(0)), F.lit(0.0))).drop("within")
    return d.withColumns({"inside": F.col("fraction") >= 1.0, "any": F.col("fraction") > 0})


def truth_gate(size: Column, period: Column, inside: Column, least: int, distance: Column | None = None, least_distance: float = 0.0) -> Column:
    """Whether a true event counts: large enough by its size and its period, far enough from others (missing: 1), wholly confident."""
    far = F.coalesce(distance, F.lit(1.0)) >= least_distance if distance is not None else F.lit(True)
    return (F.least(F.coalesce(period, size), size) >= least) & far & inside


def call_gate(cn: Column, size: Column, inside: Column, least: int, neutral: int = 2) -> Column:
    return (cn != neutral) & (size >= least) & inside


def components(truth: DataFrame, call: DataFrame) -> DataFrame:
    """Both sides (grp, s, e, id, cn, size, tp) with side and component, a text of group and bounds; events that only touch stay apart."""
    cols = ["grp", "s", "e", "id", "cn", "size", "tp"]
    d = truth.select(*cols, F.lit("truth").alias("side")).unionByName(call.select(*cols, F.lit("call").alias("side")))
    d = runs(d, touching_joins=False)
    bounds = d.groupBy("grp", "run").agg(F.min("s").alias("lo"), F.max("e").alias("hi"))
    return d.join(bounds, ["grp", "run"]).withColumn("component", F.format_string("%s:%d-%d", F.col("grp"), F.col("lo"), F.col("hi"))).drop("run", "lo", "hi")


def call_events(members: DataFrame, inside: DataFrame | None = None, least: int = 0, neutral: int = 2) -> DataFrame:
    """A row per component with calls that are not neutral: cn of the first, summed size, truth_size (largest true event found), tp.

    A component without a true positive counts only if large enough and if all its calls (inside: id) are confident.
    """
    at = F.struct("s", "id")
    is_call = (F.col("side") == "call") & (F.col("cn") != neutral)
    d = members.join(inside.select("id", F.lit(True).alias("in"), F.lit("call").alias("side")), ["id", "side"], "left") if inside is not None else members.withColumn("in", F.lit(True))
    g = d.groupBy("grp", "component").agg(
        F.min_by(F.when(is_call, F.col("cn")), F.when(is_call, at)).alias("cn"), F.sum(F.when(is_call, F.col("size"))).alias("size"), F.coalesce(F.bool_or(is_call & F.col("tp")), F.lit(False)).alias("tp"),
        F.max(F.when((F.col("side") == "truth") & F.col("tp"), F.col("size"))).alias("largest"), F.bool_and(F.when(is_call, F.coalesce("in", F.lit(False)))).alias("all_in"),
    ).filter("size IS NOT NULL")
    g = g.withColumn("truth_size", F.when(F.col("tp"), F.coalesce("largest", F.lit(0))).otherwise(F.lit(0)))
    return g.filter(F.col("tp") | ((F.col("size") >= least) & F.col("all_in"))).select("grp", "component", "cn", "size", "truth_size", "tp")


def true_events(vcf: DataFrame) -> DataFrame:
    """grp, s, e, id, diff, size, period, distance, filter of a truth set's records (read_vcf's columns and record, its number)."""
    info = lambda k, t: F.try_element_at(F.col("info"), F.lit(k)).try_cast(t)
    return vcf.select(
        F.col("chrom").alias("grp"), info("REFSTART", "long").alias("s"), info("REFSTOP", "long").alias("e"), F.col("record").alias("id"), F.coalesce(info("CNDIFF", "long"), F.lit(0)).alias("diff"),
        info("SVLEN", "long").alias("size"), info("PERIOD", "long").alias("period"), info("DIST", "double").alias("distance"), "filter",
    )


def called_events(vcf: DataFrame, field: str = "CN", neutral: int = 2) -> DataFrame:
    """grp, s, e, id, cn, size, filter of a call set's records; a field that ends with DIFF counts from neutral."""
    value = lambda fields, k: F.try_element_at(fields, F.lit(k)).try_cast("long")
    first = F.get("samples", F.lit(0))
    # a record that has the field in INFO is read there, even if it holds nothing
    sample = F.when(~F.coalesce(F.map_contains_key("info", F.lit(field)), F.lit(False)), value(first, field))
    cn = copy_number(value(F.col("info"), field), sample, neutral, field.endswith("DIFF"))
    size = F.coalesce(value(F.col("info"), "SVLEN"), F.col("end") - F.col("pos"))
    return vcf.select(F.col("chrom").alias("grp"), F.col("pos").alias("s"), F.col("end").alias("e"), F.col("record").alias("id"), cn.alias("cn"), size.alias("size"), "filter")


class Evaluation(NamedTuple):
    """truth and call: every accepted event with eval (null: not counted) and what it met; the stats hold a row per counted event."""

    truth: DataFrame
    call: DataFrame
    truth_stats: DataFrame
    call_stats: DataFrame


def evaluate(truth: DataFrame, call: DataFrame, regions: DataFrame | None = None, least_overlap: float = 0.3, least_distance: float = 0.95, least_size: int = 5000, neutral: int = 2, contigs: DataFrame | None = None) -> Evaluation:
    """Calls (called_events) against the truth (true_events), by component of overlapping events.

    A true event is found if calls of its direction cover least_overlap of its size. One found counts if some call of its
    direction in the component deserves it, one not found if it is large, distant and confident enough. A call is true if
    it overlaps a found event of its direction, and the one it overlaps most deserves it. Calls of a component with true
    events count as one event; it is dropped if false and too small or not wholly confident, and so are its calls' verdicts.
    Calls of other components count one by one. contigs (grp) limits the calls, as a truth set's header does.
    """
    held = step(lambda: merge(regions).drop("n")) if regions is not None else None  # both sides look at one union
    gain, large = F.col("cn") > neutral, F.coalesce(F.col("size") >= least_size, F.lit(False))
    counts = truth_gate(F.col("size"), F.col("period"), F.col("inside"), least_size, F.col("distance"), least_distance)

    # what several branches read below is written once; their plans would repeat it many times over
    def true_ones() -> DataFrame:
        d = kept(truth.filter((F.col("diff") != 0) & accepted(F.col("filter"))).select("grp", "s", "e", "id", "diff", "size", "period", "distance"))
        d = confident(d, held, True).withColumns({"large": F.coalesce(F.least(F.coalesce("period", "size"), F.col("size")) >= least_size, F.lit(False)), "counts": F.coalesce(counts, F.lit(False))})
        return d.select("grp", "s", "e", "id", (F.col("diff") + neutral).alias("cn"), "size", "large", "any", "counts")

    def called_ones() -> DataFrame:
        d = call.filter((F.col("cn") != neutral) & accepted(F.col("filter"))).select("grp", "s", "e", "id", "cn", "size")
        d = kept(d.join(contigs.select("grp").distinct(), "grp", "left_semi") if contigs is not None else d)
        return confident(d, held, True).select("grp", "s", "e", "id", "cn", "size", large.alias("large"), "any", "inside")

    t, c = step(true_ones), step(called_ones)

    def by_component() -> DataFrame:
        """run, bounds, whether it has a true event, and what its calls are, in four bits for losses and four for gains: there, any, large, both in one."""
        bit = lambda x, n: F.when(x, F.lit(1 << n)).otherwise(F.lit(0))
        bits = bit(F.lit(True), 0) + bit(F.col("any"), 1) + bit(F.col("large"), 2) + bit(F.col("any") & F.col("large"), 3)
        cols = ["grp", "s", "e", "id"]
        d = t.select(*cols, F.lit(0).alias("seen")).unionByName(c.select(*cols, F.when(gain, bits * 16).otherwise(bits).alias("seen")))
        d = step(partial(runs, d, touching_joins=False))
        parts = d.groupBy("grp", "run").agg(F.min("s").alias("lo"), F.max("e").alias("hi"), F.bool_or(F.col("seen") == 0).alias("true"), F.bit_or("seen").alias("met"))
        return d.select("grp", "run", "id", (F.col("seen") > 0).alias("called")).join(parts, ["grp", "run"]).withColumnRenamed("met", "seen")

    both = step(by_component)
    of = lambda d, called: d.join(both.filter(F.col("called") == called).drop("grp", "called"), "id")
    component = F.format_string("%s:%d-%d", F.col("grp").cast("string"), "lo", "hi")

    pairs = overlap_join(t.select("grp", "s", "e", "id", gain.alias("gain"), "size"), c.select("grp", "s", "e", "id", gain.alias("gain"), "size"))
    pairs = kept(pairs.filter("a_gain = b_gain").drop("grp", "a_gain", "b_gain"))
    met = F.array_sort(F.collect_list(F.struct(F.col("bs").alias("s"), F.col("b_id").alias("id"), F.col("be").alias("e"), F.col("b_size").alias("size"))))
    cover = pairs.groupBy(F.col("a_id").alias("id")).agg(F.sum("overlap").alias("cover"), met.alias("met"))
    t = of(t, False).join(cover, "id", "left")
    found = (F.col("seen") > 0) & (F.col("size") > 0) & (F.coalesce("cover", F.lit(0)) / F.nullif(F.col("size"), F.lit(0)) >= least_overlap)
    t = t.withColumn("found", F.coalesce(found, F.lit(False)))
    needed = F.when(F.col("large") & F.col("any"), 1).when(F.col("large"), 2).when(F.col("any"), 4).otherwise(8)
    deserved = F.col("seen").bitwiseAND(F.when(gain, needed * 16).otherwise(needed)) > 0
    t = t.withColumn("eval", F.when(F.col("found"), F.when(deserved, "TP")).when(F.col("counts"), "FN"))
    t = kept(t.select("grp", "run", "lo", "hi", "id", "cn", "size", "large", "any", "found", "met", "eval"))

    hits = pairs.join(t.filter("found").select(F.col("id").alias("a_id"), F.struct("large", "any").alias("hit")), "a_id")
    first = F.struct("overlap", -F.col("as"), -F.col("a_id"))
    best = hits.groupBy(F.col("b_id").alias("id")).agg(F.max_by(F.struct("as", "ae", "a_size", "hit"), first).alias("best"))
    rewarded = (F.col("best.hit.large") | F.col("large")) & (F.col("best.hit.any") | F.col("any"))
    c = of(c, True).join(best, "id", "left")
    c = kept(c.withColumn("own", F.coalesce(F.col("best").isNotNull() & rewarded, F.lit(False))))
    largest = t.filter("found").groupBy("grp", "run").agg(F.max("size").alias("largest"))
    events = c.filter(F.col("true")).groupBy("grp", "run").agg(F.bool_or("own").alias("tp"), F.min_by("cn", F.struct("s", "id")).alias("cn"), F.sum("size").alias("size"), F.bool_and("inside").alias("inside"))
    events = events.filter((F.col("tp")) | ((F.col("size") >= least_size) & F.col("inside"))).join(largest, ["grp", "run"], "left")
    events = events.withColumn("truth_size", F.when(F.col("tp"), F.coalesce("largest", F.lit(0))).otherwise(F.lit(0)))
    events = kept(events)
    c = c.join(events.select("grp", "run", F.lit(True).alias("event")), ["grp", "run"], "left")
    alone = F.coalesce(call_gate(F.col("cn"), F.col("size"), F.col("inside"), least_size, neutral), F.lit(False))
    verdict = F.when(F.col("true"), F.when(F.col("event"), F.when(F.col("own"), "TP").otherwise("FP"))).when(alone, "FP")
    c = c.withColumn("eval", verdict)

    text = lambda f: F.when(F.col("eval") == "TP", F.array_join(F.transform("met", f), ","))
    listed = t.select(
        "id", "eval", F.when(F.col("eval").isNotNull(), component).alias("component"),
        text(lambda x: F.concat(x["s"].cast("string"), F.lit("-"), x["e"].cast("string"))).alias("call"), text(lambda x: x["size"].cast("string")).alias("call_size"),
    )
    mine = lambda x: F.when(F.col("eval") == "TP", x)
    calls = c.select(
        "id", "eval", F.when(F.col("eval").isNotNull(), component).alias("component"),
        mine(F.concat(F.col("best.as").cast("string"), F.lit("-"), F.col("best.ae").cast("string"))).alias("truth"), mine(F.col("best.a_size").cast("string")).alias("truth_size"),
    )
    truth_stats = t.filter("eval IS NOT NULL").select("grp", "cn", "size", "eval")
    apart = c.filter(~F.col("true") & F.col("eval").isNotNull()).select("grp", "cn", "size", F.lit(0).cast("long").alias("truth_size"), "eval")
    joint = events.select("grp", "cn", "size", F.col("truth_size").cast("long").alias("truth_size"), F.when(F.col("tp"), "TP").otherwise("FP").alias("eval"))
    return Evaluation(listed, calls, truth_stats, apart.unionByName(joint))


def stratified(truth: DataFrame, call: DataFrame, strata: DataFrame, names: list[str], regions: DataFrame | None = None, **options) -> tuple[DataFrame, DataFrame]:
    """The stats of evaluate() for each stratum (stratum, grp, s, e) in place of the regions: with a column stratum.

    Every event takes part once for each of the names; strata are limited to regions where those are given. Strata are
    evaluated one after the other, and only a stratum's stats stay: together they would need the disk of all at once.
    """
    cols = ["grp", "cn", "size", "truth_size", "eval", "called"]

    def stats(name: str) -> DataFrame:
        held = strata.filter(F.col("stratum") == name).select("grp", "s", "e")
        held = step(partial(intersect, held, regions)) if regions is not None else held
        got = evaluate(truth, call, held, **options)
        t = got.truth_stats.withColumns({"truth_size": F.lit(None).cast("long"), "called": F.lit(False)}).select(*cols)
        return t.unionByName(got.call_stats.withColumn("called", F.lit(True)).select(*cols))

    each = [step(partial(stats, name)).withColumn("stratum", F.lit(name)) for name in names or [""]]
    d = reduce(DataFrame.unionByName, each) if names else each[0].limit(0)
    return d.filter("NOT called").drop("truth_size", "called"), d.filter("called").drop("called")


def summary(truth_stats: DataFrame, call_stats: DataFrame, *by: str, neutral: int = 2, groups: list[tuple] | None = None) -> DataFrame:
    """Counts and ratios of stats for all events (dir null), losses and gains; groups (values of by) appear even without events."""
    side = lambda d: d.select(*by, event_class(F.col("cn"), neutral).alias("dir"), (F.col("eval") == "TP").alias("tp"))
    return evaluation.confusion(side(truth_stats), side(call_stats), *by, groups=groups)


def by_length(truth_stats: DataFrame, call_stats: DataFrame, cuts: list[int], neutral: int = 2) -> DataFrame:
    """summary() for each range of sizes, both ends included, the last one up to the largest event. A call that found an event counts by that one's size."""
    cuts = evaluation.cuts_to(cuts, truth_stats.select("size").unionByName(call_stats.select("size")))
    met = F.when(F.col("truth_size") != 0, F.col("truth_size")).otherwise(F.col("size"))
    return summary(evaluation.in_bins(truth_stats, cuts, F.col("size")), evaluation.in_bins(call_stats, cuts, met), "bin", neutral=neutral, groups=[(n,) for n in evaluation.bin_names(cuts)])


def labelled(truth: DataFrame, call: DataFrame, regions: DataFrame | None = None, least_overlap: float = 0.3, neutral: int = 2) -> DataFrame:
    """id and label of every call: the copy number that the true event it overlaps most lets it see.

    Only true events wholly within regions count, and overlaps of at least least_overlap of the call's size. A call
    without such an event is neutral if it lies in regions, and has no label otherwise.
    """
    held = step(lambda: merge(regions).drop("n")) if regions is not None else None
    t = kept(confident(truth.filter((F.col("diff") != 0) & accepted(F.col("filter"))), held, True).filter("inside"))
    c = kept(confident(call, held, True))
    pairs = overlap_join(t.select("grp", "s", "e", "id", "diff", "size", "period"), c.select("grp", "s", "e", "id", "size"))
    pairs = pairs.filter((F.col("b_size") <= 0) | (F.col("overlap") / F.nullif(F.col("b_size"), F.lit(0)) >= least_overlap))
    event = F.struct(F.col("overlap"), F.col("a_diff").alias("diff"), F.col("a_size").cast("double").alias("size"), F.col("a_period").cast("double").alias("period"))
    best = pairs.groupBy(F.col("b_id").alias("id")).agg(F.max_by(event, F.struct("overlap", -F.col("as"), -F.col("a_id"))).alias("x"))
    seen = evaluation.effective_label(best.select("id", "x.*"), neutral).select("id", "label")
    return c.join(seen, "id", "left").select("id", F.coalesce("label", F.when(F.col("inside"), F.lit(neutral).cast("long"))).alias("label"))
