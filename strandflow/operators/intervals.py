"""Interval algebra over (grp, s, e), half-open: runs, merge, overlap, intersect, subtract, as-of.

No step puts a whole group into one task. Ordered steps work on ranges of about equal numbers of rows (ranges.by_rows);
what earlier ranges pass on (the largest end, the number of runs, what is open) travels through a table of one row for
each group and range. Rows without grp, s or e are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import collected
from . import ranges

#: Powers of two of the widths of bins: an interval belongs to the first level as wide as itself.
LEVELS = tuple(range(6, 61, 3))


def top_before(df: DataFrame) -> DataFrame:
    """A written table with part and tie, and top: the largest end of the intervals before this one in the order of (s, e); null if there is none."""
    d = ranges.by_rows(df.filter("grp IS NOT NULL AND s IS NOT NULL AND e IS NOT NULL"), "s", "e")
    d = ranges.passed_on(d, earlier=(F.max, F.max, F.col("e")))
    return d.withColumn("top", F.greatest("earlier", F.max("e").over(ranges.before("s", "e")))).drop("earlier")


def runs(df: DataFrame, touching_joins: bool) -> DataFrame:
    """Adds run: numbered stretches of overlapping intervals within grp."""
    d = top_before(df)
    new = F.col("s") > F.col("top") if touching_joins else F.col("s") >= F.col("top")
    d = d.withColumn("new", F.coalesce(new, F.lit(True)).cast("int"))
    d = d.withColumn("run", F.sum("new").over(ranges.upto("s", "e")))
    d = ranges.passed_on(d, earlier=(F.sum, F.sum, F.col("new")))
    return d.withColumn("run", F.col("run") + F.coalesce("earlier", F.lit(0))).drop("part", "tie", "top", "new", "earlier")


def merge(df: DataFrame, touching_joins: bool = True) -> DataFrame:
    """Union of intervals; touching ones join unless told otherwise. Columns grp, s, e, n."""
    return runs(df, touching_joins).groupBy("grp", "run").agg(F.min("s").alias("s"), F.max("e").alias("e"), F.count("*").alias("n")).drop("run")


def _level(s: Column, e: Column) -> Column:
    bits = F.ceil(F.log2(F.greatest(e - s, F.lit(1)).cast("double")))
    return F.least(F.lit(LEVELS[0]) + 3 * F.greatest(F.ceil((bits - LEVELS[0]) / 3), F.lit(0)), F.lit(LEVELS[-1])).cast("int")


def _used(a: dict[int, tuple[int, int]], b: dict[int, tuple[int, int]]) -> list[int]:
    """The levels to join on, in order, from the number of rows and the summed width of each side's levels.

    The intervals of a level out of use stand in bins of the last used one below it. A level is out of use where they make
    no more rows there than copies of the other side's narrower intervals would in it, and at most double their own side.
    """
    used: list[int] = []
    for level in sorted({*a, *b}):
        split = [2 * side[level][0] + side[level][1] / 2 ** used[-1] if used and level in side else 0 for side in (a, b)]
        copied = sum(n for side, other in ((a, b), (b, a)) if level in side for k, (n, _) in other.items() if k < level)
        if not used or sum(split) > copied or any(x > sum(n for n, _ in side.values()) for x, side in zip(split, (a, b))):
            used.append(level)
    return used or [LEVELS[0]]


def overlap_join(a: DataFrame, b: DataFrame) -> DataFrame:
    """Pairs of a and b of one grp that overlap: grp, as, ae, bs, be and the overlap's length.

    Bins come in widths that grow by eight. An interval belongs to the level as wide as itself,
    where it meets two bins at most, however long it is, and looks for shorter ones of the other
    side there. Those stand in the bins of every level that the other side's intervals belong to.
    Both sides' levels are counted now, since those of few intervals only cost rows (_used).
    A pair is kept in the later of the two first bins only.
    """
    down = lambda at, by: F.call_function("shiftright", at, by)

    def named(df: DataFrame, p: str) -> DataFrame:
        names = [F.col(c).alias(f"{p}{c}" if c in ("s", "e") else c if c == "grp" else f"{p}_{c}") for c in df.columns]
        return df.filter("grp IS NOT NULL AND s IS NOT NULL AND e IS NOT NULL").select(*names)

    def counted(df: DataFrame, p: str) -> dict[int, tuple[int, int]]:
        s, e = F.col(f"{p}s"), F.col(f"{p}e")
        rows = collected(df.groupBy(_level(s, e).alias("level")).agg(F.count("*").alias("n"), F.sum((e - s).cast("double")).alias("wide")))
        return {r.level: (r.n, int(r.wide)) for r in rows}  # at most len(LEVELS) rows

    x, y = named(a, "a"), named(b, "b")
    of_x, of_y = counted(x, "a"), counted(y, "b")
    used = _used(of_x, of_y)

    def owned(counts: dict[int, tuple[int, int]]) -> list[int]:
        return sorted({max((u for u in used if u <= k), default=used[0]) for k in counts}) or used[:1]

    def bins(df: DataFrame, p: str, levels: list[int] | None = None, strict: bool = False) -> DataFrame:
        """df in the bins of its own level, else of those of levels that are not below it (strict: above it). A bin's number ends in six bits for the level."""
        s, e = F.col(f"{p}s").cast("long"), F.col(f"{p}e").cast("long")
        own = F.lit(used[0])
        for k in used[1:]:
            own = F.when(_level(s, e) >= k, k).otherwise(own)
        if levels is None:
            d = df.withColumn("level", own)
        else:
            d = df.withColumn("level", F.explode(F.array(*map(F.lit, levels))) if len(levels) > 1 else F.lit(levels[0]))
            d = d.filter(F.col("level") > own if strict else F.col("level") >= own)
        places = F.sequence(down(s, F.col("level")), down(F.greatest(e - 1, s), F.col("level")))
        return d.withColumn("place", F.explode(places)).withColumn("bin", F.call_function("shiftleft", F.col("place"), F.lit(6)) + F.col("level")).drop("place", "level")

    def met(own: DataFrame, copied: DataFrame) -> DataFrame:
        j = own.join(copied, ["grp", "bin"]).filter((F.col("as") < F.col("be")) & (F.col("bs") < F.col("ae")))
        later = F.greatest(F.col("as").cast("long"), F.col("bs").cast("long"))
        j = j.filter(down(later, F.col("bin").bitwiseAND(63).cast("int")) == down(F.col("bin"), F.lit(6)))
        return j.select("grp", *[c for c in x.columns + y.columns if c != "grp"])

    j = met(bins(x, "a"), bins(y, "b", owned(of_x)))
    above = [k for k in owned(of_y) if k > owned(of_x)[0]]
    if above:
        j = j.unionByName(met(bins(y, "b"), bins(x, "a", above, True)))
    return j.withColumn("overlap", F.least("ae", "be") - F.greatest("as", "bs"))


def _swept(a: DataFrame, b: DataFrame, keep: str) -> DataFrame:
    """Where keep holds of in_a and in_b, the numbers of intervals of both that cover a place: one sweep over all starts and ends."""

    def ends(d: DataFrame, x: int, y: int) -> DataFrame:
        both = F.array(*[F.struct(F.col(at).cast("long").alias("at"), F.lit(sign * x).alias("da"), F.lit(sign * y).alias("db")) for at, sign in (("s", 1), ("e", -1))])
        return d.filter("grp IS NOT NULL AND s < e").select("grp", F.inline(both))

    points = ends(a, 1, 0).unionByName(ends(b, 0, 1)).groupBy("grp", "at").agg(F.sum("da").alias("da"), F.sum("db").alias("db"))
    d = ranges.by_rows(points.filter("da <> 0 OR db <> 0"), "at")
    d = ranges.passed_on(d, in_a=(F.sum, F.sum, F.col("da")), in_b=(F.sum, F.sum, F.col("db")))
    d = d.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("in_a", "in_b")}).withColumn("was", F.expr(keep))
    d = d.withColumns({"in_a": F.col("in_a") + F.sum("da").over(ranges.upto("at")), "in_b": F.col("in_b") + F.sum("db").over(ranges.upto("at"))}).withColumn("holds", F.expr(keep))
    d = d.withColumn("was", F.coalesce(F.lag("holds").over(ranges.inside("at")), "was")).filter("holds <> was").select("grp", "part", "tie", "at", "holds")
    d = ranges.passed_on(d, later=True, following=(F.min, F.min, F.col("at")))
    d = d.withColumn("e", F.coalesce(F.lead("at").over(ranges.inside("at")), "following"))
    return d.filter("holds").select("grp", F.col("at").alias("s"), "e")


def intersect(a: DataFrame, b: DataFrame) -> DataFrame:
    """What both cover."""
    return _swept(a, b, "in_a > 0 AND in_b > 0")


def subtract(a: DataFrame, b: DataFrame) -> DataFrame:
    """What a covers and b does not."""
    return _swept(a, b, "in_a > 0 AND in_b = 0")


def overlapping(a: DataFrame, b: DataFrame, id: str = "id") -> DataFrame:
    """Rows of a (grp, s, e, id, ...) that overlap an interval of b, each once (a semi-join)."""
    hit = overlap_join(a.select("grp", "s", "e", id), b.select("grp", "s", "e")).select(F.col(f"a_{id}").alias(id)).distinct()
    return a.join(hit, id, "left_semi")


def padded(df: DataFrame, by: int) -> DataFrame:
    """Intervals wider by so many positions on both sides, none below 0."""
    return df.withColumns({"s": F.greatest(F.col("s") - by, F.lit(0).cast("long")), "e": F.col("e") + by})


def containing(points: DataFrame, spans: DataFrame) -> DataFrame:
    """points (grp, at, ...) with the start of the interval of spans (disjoint) that holds them, else null; as-of, without a range join."""
    names = [c for c in points.columns if c not in ("grp", "at")]
    span = F.struct(F.col("s").cast("long").alias("s"), F.col("e").cast("long").alias("e"))
    left = spans.filter("grp IS NOT NULL AND s < e").select("grp", F.col("s").cast("long").alias("at"), F.lit(0).alias("side"), span.alias("span"), *[F.lit(None).cast(points.schema[c].dataType).alias(c) for c in names])
    right = points.select("grp", F.col("at").cast("long").alias("at"), F.lit(1).alias("side"), F.lit(None).cast("struct<s:bigint,e:bigint>").alias("span"), *names)
    d = ranges.by_rows(left.unionByName(right), "at", "side")
    known = lambda x: F.last(x, ignorenulls=True)
    d = ranges.passed_on(d, earlier=(lambda x: F.max_by(x, F.when(x.isNotNull(), F.col("at"))), known, F.col("span")))
    d = d.withColumn("span", F.coalesce(known("span").over(ranges.upto("at", "side")), "earlier")).filter("side = 1")
    return d.withColumn("phase", F.when(F.col("at") < F.col("span.e"), F.col("span.s"))).drop("side", "span", "part", "tie", "earlier")
