"""Truth-versus-call evaluation of signed intervals: coverage, best match, confusion metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .intervals import overlap_join


def matched(truth: DataFrame, call: DataFrame) -> DataFrame:
    """Overlapping pairs of one direction. Both sides: grp, s, e, id, dir."""
    return overlap_join(truth, call).filter("a_dir = b_dir")


def outcomes(truth: DataFrame, call: DataFrame, share: float) -> tuple[DataFrame, DataFrame]:
    """truth with tp (calls of its direction cover the share of it) and call with tp (it overlaps such a truth) and best, the truth it overlaps most."""
    pairs = matched(truth, call)
    cover = pairs.groupBy(F.col("a_id").alias("id")).agg(F.sum("overlap").alias("cover"))
    t = truth.join(cover, "id", "left").withColumn("tp", F.coalesce(F.col("cover") >= share * (F.col("e") - F.col("s")), F.lit(False)))
    found = pairs.join(t.filter("tp").select(F.col("id").alias("a_id"), F.lit(True).alias("hit")), "a_id", "left")
    best = found.groupBy(F.col("b_id").alias("id")).agg(F.coalesce(F.bool_or("hit"), F.lit(False)).alias("tp"), F.max_by("a_id", F.struct("overlap", -F.col("a_id"))).alias("best"))
    c = call.join(best, "id", "left").withColumn("tp", F.coalesce("tp", F.lit(False)))
    return t, c


def confusion(t: DataFrame, c: DataFrame, *by: str, classes: tuple[str, ...] = ("Loss", "Gain"), groups: list[tuple] | None = None) -> DataFrame:
    """Counts, sensitivity, precision and F1 for each class of dir, rows or not, and for all of them (dir null).

    Zero denominators give 0; a class's ratio is 1 where its side has no row at all. Other values of dir count nowhere.
    groups (values of by, as text) appear even without rows.
    """
    rows = t.select(*by, "dir", "tp", F.lit(True).alias("true")).unionByName(c.select(*by, "dir", "tp", F.lit(False).alias("true")))
    if groups is not None:
        none = t.sparkSession.createDataFrame(groups, ", ".join(f"{c} string" for c in by))
        rows = rows.unionByName(none.select(*by, F.lit(None).cast("string").alias("dir"), *[F.lit(None).cast("boolean").alias(c) for c in ("tp", "true")]))
    count = lambda x: F.count(F.when(x, 1)).alias
    true, tp, held = F.col("true"), F.col("tp"), F.col("dir").isin(*classes)
    kinds = [(None, held), *[(k, F.col("dir") == k) for k in classes]]
    aggs = [count(true)("all_t"), count(~true)("all_c")]
    for i, (_, is_) in enumerate(kinds):
        aggs += [count(is_ & true & tp)(f"tp_t{i}"), count(is_ & true & ~tp)(f"fn{i}"), count(is_ & ~true & tp)(f"tp_c{i}"), count(is_ & ~true & ~tp)(f"fp{i}")]
    names = ("tp_t", "fn", "tp_c", "fp")
    each = [F.struct(F.lit(k).cast("string").alias("dir"), *[F.col(f"{x}{i}").alias(x) for x in names]) for i, (k, _) in enumerate(kinds)]
    g = rows.groupBy(*by).agg(*aggs).select(*by, "all_t", "all_c", F.inline(F.array(*each)))

    def ratio(a: str, b: str, every: str) -> Column:
        known = F.coalesce(F.col(a) / F.nullif(F.col(a) + F.col(b), F.lit(0)), F.lit(0.0))
        return F.when(F.col("dir").isNotNull() & (F.col(every) == 0), F.lit(1.0)).otherwise(known)

    g = g.withColumns({"sensitivity": ratio("tp_t", "fn", "all_t"), "precision": ratio("tp_c", "fp", "all_c")}).drop("all_t", "all_c")
    both = F.col("sensitivity") + F.col("precision")
    return g.withColumn("f1", F.coalesce(2 * F.col("sensitivity") * F.col("precision") / F.nullif(both, F.lit(0.0)), F.lit(0.0)))


def cuts_to(cuts: list[int], sizes: DataFrame) -> list[int]:
    """cuts, with the largest of sizes (one column) as a last one where it lies beyond."""
    largest = sizes.agg(F.max(sizes.columns[0])).first()[0]
    return [*cuts, largest] if largest is not None and largest > cuts[-1] else list(cuts)


def bin_names(cuts: list[int]) -> list[str]:
    return [f"{a}-{b}" for a, b in zip([0, *cuts[:-1]], cuts)]


def in_bins(df: DataFrame, cuts: list[int], size: Column | None = None) -> DataFrame:
    """A row for each size bin that holds size (e - s unless given); both ends belong to a bin, so a value on a cut counts twice."""
    size = F.col("e") - F.col("s") if size is None else size
    edges = list(zip([0, *cuts[:-1]], cuts))
    hits = F.array_compact(F.array(*[F.when(size.between(a, b), F.lit(n)) for n, (a, b) in zip(bin_names(cuts), edges)]))
    return df.withColumn("bin", F.explode(hits))


def first_per_position(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    return df.withColumn("rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("rn = 1").drop("rn")


def effective_label(df: DataFrame, neutral: int = 2, most: int = 10) -> DataFrame:
    """Adds label: the copy number that a call of a periodic event sees.

    Needs overlap, size, period (null or not positive: size) and diff. The difference over the whole event is dealt to
    the periods that the overlap covers, halves rounded to even both times; without overlap or size it is neutral.
    """
    period = F.when(F.col("period") > 0, F.col("period")).otherwise(F.col("size"))
    covered = F.greatest(F.lit(1.0), F.rint(F.col("overlap") / F.nullif(period, F.lit(0))))
    diff = F.rint(F.col("diff") * (F.col("size") / F.nullif(period, F.lit(0))) / covered).cast("long")
    seen = F.greatest(F.lit(0), F.least(F.lit(neutral) + diff, F.lit(most)))
    return df.withColumn("label", F.when((F.col("overlap") > 0) & (F.col("size") > 0), seen).otherwise(F.lit(neutral)).cast("long"))


def in_strata(df: DataFrame, strata: DataFrame) -> DataFrame:
    """A row for each stratum (stratum, grp, s, e; disjoint within one) that an interval of df lies wholly in, in one pass."""
    j = overlap_join(df.select("grp", "s", "e", "id"), strata.select("grp", "s", "e", "stratum"))
    held = j.groupBy("a_id", "b_stratum").agg(F.sum("overlap").alias("within"))
    held = held.select(F.col("a_id").alias("id"), F.col("b_stratum").alias("stratum"), "within")
    return df.join(held, "id").filter(F.col("within") >= F.col("e") - F.col("s")).drop("within")
