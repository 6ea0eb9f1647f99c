"""Mixing sources to target weights [native]: Efraimidis-Spirakis sampling to token budgets.

A source's budget is its share of all words by weight, at most EPOCHS times its own words,
the excess shared again among the others. Whole epochs are taken first; what is left of
the budget is filled with documents in the order of their exponential keys
-ln(u) / weight, u from a hash of the doc_id and the text, weight from the text's quality.
The running sum is taken over a histogram of keys (256 buckets per octave, so that no
bucket holds more than a thousandth of a source whatever the weights) and then sorted row
by row within the one bucket of each source where the budget ends.

Rows that are equal (in doc_id, text, source and what else is passed on) are numbered from 0,
and the number is part of the key, so that a source made of copies, or without ids, meets
its target like any other. Which of them gets which number does not show in the result:
reruns agree however the table is cut into files and tasks.

Defined results: a null source is one source, ordered last; a null or empty text has
size 0; repeated rows and null ids are rows of their own; a source without words has
target 0; an empty table gives an empty table. Sources are taken to be few enough for one
small aggregate (a row each); the plan joins them by broadcast only where Spark sees that
the table of budgets is small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import keep, words
from .quality_rules import SYMBOLS

EPOCHS = 3
WEIGHTS = (1, 2, 3)
BUCKETS_PER_OCTAVE = 256


def _rest(docs: DataFrame, columns: tuple[str, ...]) -> Column:
    """A hash of columns; of types that Spark does not hash, their JSON."""
    plain = lambda c: F.to_json(F.struct(c)) if "map<" in docs.schema[c].dataType.simpleString() or "variant" in docs.schema[c].dataType.simpleString() else F.col(c)
    return F.xxhash64(*map(plain, columns)) if columns else F.lit(0).cast("long")


def numbered(d: DataFrame) -> DataFrame:
    """d (written rows with __item, __source, __rest and __place) with __nth, which counts equal rows from 0.

    Equal rows of one task are counted in a window, those of the tasks before by prefix sums over a row for each task; so a
    row that a third of the table repeats is spread as the table is, and the numbers given to equal rows are the same for
    any layout of the table.
    """
    group = F.md5(F.concat("__item", F.lit("|"), F.coalesce(F.concat(F.lit("s"), "__source"), F.lit("")), F.lit("|"), F.col("__rest").cast("string")))
    d = d.withColumns({"__group": group, "__part": F.shiftright("__place", 33)})
    each = keep(d.groupBy("__group", "__part").count(), "mix-counts")
    again = keep(each.groupBy("__group").agg(F.sum("count").alias("n")).filter("n > 1").select("__group"), "mix-again")
    earlier = Window.partitionBy("__group").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    before = each.join(again, "__group").select("__group", "__part", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("__before"))
    within = F.row_number().over(Window.partitionBy("__group", "__part").orderBy("__place")) - 1
    many = d.join(before, ["__group", "__part"]).withColumn("__nth", F.col("__before") + within).drop("__before")
    once = d.join(again, "__group", "left_anti").withColumn("__nth", F.lit(0).cast("long"))
    return once.unionByName(many).drop("__group", "__part")


def sized(docs: DataFrame, *passed: str) -> DataFrame:
    """A written table of size, key and bucket of each row, beside its source, doc_id and the columns in passed."""
    text = F.coalesce(F.col("text"), F.lit(""))
    symbols = F.length(text) - F.length(F.translate(text, SYMBOLS, ""))
    item = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.md5(text))
    d = docs.select(
        *passed, F.col("doc_id").alias("__id"), F.col("source").alias("__source"), F.size(words(F.col("text"))).cast("long").alias("__size"),
        symbols.alias("__symbols"), item.alias("__item"), _rest(docs, passed).alias("__rest"), F.monotonically_increasing_id().alias("__place"),
    )
    d = numbered(keep(d, "mix-items"))
    nth = F.when(F.col("__nth") > 0, F.concat(F.lit(":"), F.col("__nth").cast("string"))).otherwise("")
    u = (F.conv(F.substring(F.md5(F.concat("__item", F.lit(":mix"), nth)), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    weight = 1 / (1 + F.col("__symbols") / F.greatest(F.col("__size"), F.lit(1)))
    d = d.withColumn("__key", -F.log(u) / weight)
    return d.withColumn("__bucket", F.floor(F.log2("__key") * BUCKETS_PER_OCTAVE)).drop("__symbols", "__item", "__place")


def budgets(d: DataFrame) -> DataFrame:
    """source, source_size, target, whole epochs and the rest of the budget."""
    s = d.groupBy("__source").agg(F.sum("__size").alias("source_size"))
    by_name = Window.orderBy(F.col("__source").asc_nulls_last())
    place = F.row_number().over(by_name) - 1
    weight = F.get(F.array(*map(F.lit, WEIGHTS)), place % len(WEIGHTS)).cast("double")
    every = Window.partitionBy()
    s = s.withColumn("weight", weight).withColumns({"cap": EPOCHS * F.col("source_size").cast("double")})
    s = s.withColumns({"all_words": F.sum("source_size").over(every).cast("double"), "all_weight": F.sum("weight").over(every)})
    before = Window.orderBy(F.col("cap") / F.col("weight"), F.col("__source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumns({"cap_before": F.coalesce(F.sum("cap").over(before), F.lit(0.0)), "weight_before": F.coalesce(F.sum("weight").over(before), F.lit(0.0))})
    s = s.withColumn("capped", F.col("cap") * (F.col("all_weight") - F.col("weight_before")) <= F.col("weight") * (F.col("all_words") - F.col("cap_before")))
    s = s.withColumns({"cap_sum": F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0.0)).over(every), "weight_sum": F.sum(F.when(F.col("capped"), F.col("weight")).otherwise(0.0)).over(every)})
    target = F.when(F.col("capped"), F.col("cap")).otherwise(F.col("weight") * (F.col("all_words") - F.col("cap_sum")) / F.nullif(F.col("all_weight") - F.col("weight_sum"), F.lit(0.0)))
    s = s.withColumn("target", target)
    whole = F.coalesce(F.floor(F.col("target") / F.nullif(F.col("source_size"), F.lit(0))), F.lit(0))
    return s.withColumn("epochs", whole).select("__source", "source_size", "target", "epochs", F.greatest(F.col("target") - F.col("epochs") * F.col("source_size"), F.lit(0.0)).alias("rest"))


def _order() -> Column:
    return F.struct("__key", "__id", "__size", "__rest", "__nth")


def cutoffs(d: DataFrame, plan: DataFrame) -> DataFrame:
    """plan with the bucket where each source's rest ends, and in it the first row left out (null: none)."""
    running = Window.partitionBy("__source").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, 0)
    hist = d.groupBy("__source", "__bucket").agg(F.sum("__size").alias("n")).withColumn("upto", F.sum("n").over(running))
    same = lambda a, b: a["__source"].eqNullSafe(b["__source"])
    edge = hist.join(plan.select(F.col("__source").alias("s"), "rest"), F.col("__source").eqNullSafe(F.col("s")))
    edge = edge.filter((F.col("upto") > F.col("rest")) & (F.col("upto") - F.col("n") <= F.col("rest")))
    edge = edge.select(F.col("s"), F.col("__bucket").alias("edge"), (F.col("upto") - F.col("n")).alias("base"), "rest")
    rows = d.select("__source", "__bucket", "__key", "__id", "__size", "__rest", "__nth").join(edge, F.col("__source").eqNullSafe(F.col("s")) & (F.col("__bucket") == F.col("edge")))
    inside = Window.partitionBy("s").orderBy("__key", "__id", "__size", "__rest", "__nth").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("before", F.col("base") + F.sum("__size").over(inside) - F.col("__size"))
    first = rows.groupBy("s", "edge").agg(F.min(F.when(F.col("before") + F.col("__size") / 2 > F.col("rest"), _order())).alias("first_out"))
    return plan.join(first, plan["__source"].eqNullSafe(first["s"]), "left").drop("s", "rest")


def copies(d: DataFrame, cut: DataFrame) -> DataFrame:
    """d with source_size, target and times: how often the mix takes the row."""
    cut = cut.withColumnRenamed("__source", "s")
    j = d.join(cut, F.col("__source").eqNullSafe(F.col("s")), "left").drop("s")
    more = (F.col("__bucket") < F.col("edge")) | ((F.col("__bucket") == F.col("edge")) & (F.col("first_out").isNull() | (_order() < F.col("first_out"))))
    return j.withColumn("times", F.col("epochs") + F.coalesce(more, F.lit(False)).cast("long")).drop("epochs", "edge", "first_out", "__bucket", "__key", "__rest", "__nth")


def mix_plan(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken."""
    d = sized(docs)
    cut = keep(cutoffs(d, keep(budgets(d), "mix-budgets")), "mix-cutoffs")
    out = copies(d, cut)
    return out.select(F.col("__id").alias("doc_id"), F.col("__size").alias("size"), "source_size", "target", (F.col("__size") * F.col("times")).alias("taken"), F.col("__source").alias("source"), "times")


def mix(docs: DataFrame) -> DataFrame:
    """The mixed documents: each row as often as the mix takes it, with all its columns."""
    names = [F.col(c).alias(f"__c_{c}") for c in docs.columns]
    d = sized(docs.select("doc_id", "source", "text", *names), *[f"__c_{c}" for c in docs.columns])
    cut = keep(cutoffs(d, keep(budgets(d), "mix-budgets")), "mix-cutoffs")
    out = copies(d, cut).filter("times > 0").withColumn("__n", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))
    return out.select(*[F.col(f"__c_{c}").alias(c) for c in docs.columns])


def oracle_copies(source: str = "documents") -> str:
    """DuckDB SQL: doc_id, size, source, source_size, target, times of each document."""
    weights = ", ".join(map(str, WEIGHTS))
    return rf"""
    SELECT doc_id, size, source, source_size, target, epochs + CASE WHEN NOT cut THEN 1 ELSE 0 END AS times FROM (
      SELECT *, coalesce(bool_or(running - size + size / 2 > rest) OVER (PARTITION BY source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), true) AS cut FROM (
        SELECT d.doc_id, d.size, d.source, d.key, p.source_size, p.target, p.epochs, p.rest,
          sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running
        FROM (SELECT doc_id, source, size, -ln((('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, '')) || ':mix'), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0)
                / (1 / (1 + symbols / greatest(size, 1)::DOUBLE)) AS key
              FROM (SELECT doc_id, source, text, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                      length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) AS symbols FROM {source})) d
        JOIN (
          SELECT source, source_size, target, epochs, greatest(target - epochs * source_size, 0) AS rest FROM (
            SELECT *, coalesce(floor(target / nullif(source_size, 0)), 0)::BIGINT AS epochs FROM (
              SELECT *, CASE WHEN capped THEN cap ELSE weight * (all_words - sum(CASE WHEN capped THEN cap ELSE 0 END) OVER ())
                  / nullif(all_weight - sum(CASE WHEN capped THEN weight ELSE 0 END) OVER (), 0) END AS target FROM (
                SELECT *, cap * (all_weight - weight_before) <= weight * (all_words - cap_before) AS capped FROM (
                  SELECT *, coalesce(sum(cap) OVER o, 0) AS cap_before, coalesce(sum(weight) OVER o, 0) AS weight_before FROM (
                    SELECT *, 3 * source_size::DOUBLE AS cap, sum(source_size) OVER ()::DOUBLE AS all_words, sum(weight) OVER () AS all_weight FROM (
                      SELECT source, source_size, ([{weights}])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight FROM (
                        SELECT source, sum(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')))::BIGINT AS source_size FROM {source} GROUP BY source)))
                  WINDOW o AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)))))) p
        ON d.source IS NOT DISTINCT FROM p.source))"""
