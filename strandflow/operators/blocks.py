"""Reference blocks against called variants: blocks are cut around the variants that start inside them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import kept
from .evaluation import first_per_position
from .intervals import overlap_join, runs, top_before

ANY = "<NON_REF>"


def _cutting(members: Column) -> Column:
    """Of overlapping variants (s, e) in order, those that start where no earlier one of these has cut."""
    start = F.struct(F.lit(None).cast("long").alias("end"), F.array().cast("array<struct<s:bigint,e:bigint>>").alias("all"))

    def step(a: Column, v: Column) -> Column:
        cuts = a["end"].isNull() | (v["s"] >= a["end"])
        return F.struct(F.when(cuts, v["e"]).otherwise(a["end"]).alias("end"), F.when(cuts, F.concat(a["all"], F.array(v))).otherwise(a["all"]).alias("all"))

    return F.aggregate(members, start, step, lambda a: a["all"])


def cut(blocks: DataFrame, variants: DataFrame) -> DataFrame:
    """The pieces of each block (grp, s, e, id, ...) around the variants (grp, s, e) that start inside it.

    Variants cut in the order of (s, e), and only where something is left: one that starts within a stretch already cut
    out does not cut, even if it reaches further. Unlike intervals.subtract, blocks that touch or overlap stay apart, and
    keep their other columns.
    """
    start = variants.select("grp", "s", (F.col("s") + 1).alias("e"), F.col("e").alias("stop"))
    hits = overlap_join(blocks.select("grp", "s", "e", "id"), start).select(F.col("a_id").alias("grp"), F.col("as").alias("lo"), F.col("ae").alias("hi"), F.col("bs").cast("long").alias("s"), F.col("b_stop").cast("long").alias("e"))
    hits = kept(hits)
    # what has been cut matters among overlapping variants only, so each such run decides by itself
    each = runs(hits, touching_joins=False).groupBy("grp", "run", "lo", "hi").agg(F.array_sort(F.collect_list(F.struct("s", "e"))).alias("members"))
    cuts = kept(each.select("grp", "lo", "hi", F.inline(_cutting(F.col("members")))))
    gaps = top_before(cuts).select(F.col("grp").alias("id"), F.coalesce("top", "lo").alias("s"), F.col("s").alias("e"))
    last = cuts.groupBy(F.col("grp").alias("id")).agg(F.max("e").alias("s"), F.max("hi").alias("e"))
    left = gaps.unionByName(last).filter("s < e")
    rest = [c for c in blocks.columns if c not in ("s", "e")]
    whole = blocks.join(last.select("id"), "id", "left_anti")
    return blocks.drop("s", "e").join(left, "id").select(*rest, "s", "e").unionByName(whole.select(*rest, "s", "e"))


def combine(calls: DataFrame, variants: DataFrame) -> DataFrame:
    """Blocks and variants of calls (grp, s, e, id, ref, alt, gt), with those of variants (the same) in their place.

    A row of one alternative is a block, and is cut around variants. One of more at a variant's position gives way to
    it (to each, the first of them pairs); elsewhere its genotype becomes 0/0. Variants gain the open alternative.
    Further columns that both have are kept.
    """
    names = [c for c in calls.columns if c in variants.columns]
    block = F.size("alt") == 1
    own = calls.filter(~block).withColumn("rn", F.row_number().over(Window.partitionBy("grp", "s").orderBy("e", "id")))
    taken = first_per_position(variants, ["grp", "s"], ["e", "id"]).select("grp", "s", F.lit(1).alias("rn"))
    alone = own.join(taken, ["grp", "s", "rn"], "left_anti").withColumn("gt", F.lit("0/0"))
    out = cut(calls.filter(block).select(*names), variants.select("grp", "s", "e")).select(*names)
    return out.unionByName(alone.select(*names)).unionByName(variants.withColumn("alt", F.concat("alt", F.array(F.lit(ANY)))).select(*names))


def clipped(df: DataFrame, s: int, e: int) -> DataFrame:
    """Blocks clipped to a shard [s, e); variants belong to the shard that they start in."""
    block = F.size("alt") == 1
    inside = df.filter((block & (F.col("s") < e) & (F.col("e") > s)) | (~block & F.col("s").between(s, e - 1)))
    return inside.withColumns({"s": F.when(block, F.greatest("s", F.lit(s))).otherwise(F.col("s")), "e": F.when(block, F.least("e", F.lit(e))).otherwise(F.col("e"))})
