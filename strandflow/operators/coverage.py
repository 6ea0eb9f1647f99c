"""Depth of coverage: runs of equal depth, and statistics of targets from histograms of depth. No step makes a row for each base."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import ranges
from .intervals import overlap_join


def depth_runs(spans: DataFrame) -> DataFrame:
    """Stretches (grp, s, e, depth) that the same number of spans (grp, s, e) covers, one at least.

    Starts add one and ends take one away; the sum over all places before is carried from range to range of equal
    numbers of places.
    """
    ends = F.array(F.struct(F.col("s").cast("long").alias("at"), F.lit(1).alias("by")), F.struct(F.col("e").cast("long").alias("at"), F.lit(-1).alias("by")))
    points = spans.filter("grp IS NOT NULL AND s < e").select("grp", F.inline(ends)).groupBy("grp", "at").agg(F.sum("by").alias("by")).filter("by <> 0")
    d = ranges.by_rows(points, "at")
    d = ranges.passed_on(d, depth=(F.sum, F.sum, F.col("by")))
    d = ranges.passed_on(d, later=True, following=(F.min, F.min, F.col("at")))
    d = d.withColumn("depth", F.coalesce("depth", F.lit(0)) + F.sum("by").over(ranges.upto("at")))
    return d.select("grp", F.col("at").alias("s"), F.coalesce(F.lead("at").over(ranges.inside("at")), "following").alias("e"), "depth").filter("depth > 0")


def depth_histogram(runs: DataFrame, targets: DataFrame, *by: str) -> DataFrame:
    """Bases of each depth, 0 included, over the targets (grp, s, e and the columns by): by, depth, bases. Targets that overlap count their common bases each."""
    names = {f"a_{c}": c for c in by}
    hit = overlap_join(targets.select("grp", "s", "e", *[c for c in by if c != "grp"]), runs)
    hit = hit.withColumnsRenamed(names).groupBy(*by, F.col("b_depth").alias("depth")).agg(F.sum("overlap").alias("bases"))
    size = targets.filter("grp IS NOT NULL").groupBy(*by).agg(F.sum(F.greatest(F.col("e") - F.col("s"), F.lit(0))).alias("bases"))
    covered = hit.groupBy(*by).agg(F.sum("bases").alias("covered"))
    bare = size.join(covered, list(by), "left").select(*by, F.lit(0).cast("long").alias("depth"), (F.col("bases") - F.coalesce("covered", F.lit(0))).alias("bases"))
    return hit.unionByName(bare)


def depth_summary(histogram: DataFrame, by: list[str], thresholds: tuple[int, ...] = (1, 10, 20), quantiles: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """by, bases, mean, q<percent> (the least depth that so many bases do not exceed) and over_<threshold> (share of bases at least so deep).

    Ratios of targets without bases are null.
    """
    w = Window.partitionBy(*by)
    # a target has a row for each depth that occurs in it
    d = histogram.withColumns({"upto": F.sum("bases").over(w.orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)), "all": F.sum("bases").over(w)})
    total = F.nullif(F.sum("bases"), F.lit(0))
    least = [F.min(F.when((F.col("bases") > 0) & (F.col("upto") >= F.col("all") * q), F.col("depth"))).alias(f"q{round(100 * q)}") for q in quantiles]
    shares = [(F.coalesce(F.sum(F.when(F.col("depth") >= k, F.col("bases"))), F.lit(0)) / total).alias(f"over_{k}") for k in thresholds]
    return d.groupBy(*by).agg(F.sum("bases").alias("bases"), (F.sum(F.col("depth") * F.col("bases")) / total).alias("mean"), *least, *shares)
