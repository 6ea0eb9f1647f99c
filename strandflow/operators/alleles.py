"""Alleles in normal form, as keys that equal changes share however they are spelled, and ids by allele."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import kept

#: Bases of context that the first round of moving looks at; each later round looks at sixteen times as many.
CONTEXT = 64
#: Alleles that are bases; others (symbols, the star) have no normal form but their own spelling.
BASES = "^[ACGTN]+$"


def shared_start(a: Column, b: Column) -> Column:
    """Length of the longest start that two texts share."""
    most = F.least(F.length(a), F.length(b))
    each = F.sequence(F.lit(1), F.greatest(most, F.lit(1)))
    first = F.get(F.filter(each, lambda n: (n > most) | (F.substring(a, n, F.lit(1)) != F.substring(b, n, F.lit(1)))), F.lit(0))
    return F.when(most == 0, 0).otherwise(F.coalesce(first - 1, most))


def stripped(records: DataFrame) -> DataFrame:
    """Adds at, gone and come: what a record (pos, ref, alt) replaces, without the end and then the start that both share. Null for alleles that are no bases."""
    r, a = F.upper("ref"), F.upper("alt")
    d = records.withColumns({"__r": F.when(r.rlike(BASES) & a.rlike(BASES), r), "__a": a})
    d = d.withColumn("__n", shared_start(F.reverse("__r"), F.reverse("__a")))
    d = d.withColumns({c: F.col(c).substr(F.lit(1), F.length(c) - F.col("__n")) for c in ("__r", "__a")})
    d = d.withColumn("__n", shared_start(F.col("__r"), F.col("__a")))
    rest = lambda c: F.when(F.col("__r").isNotNull(), F.col(c).substr(F.col("__n") + 1, F.length(c)))
    return d.withColumns({"at": F.when(F.col("__r").isNotNull(), F.col("pos") + F.col("__n")), "gone": rest("__r"), "come": rest("__a")}).drop("__r", "__a", "__n")


def _moved(d: DataFrame, chunks: DataFrame, width: int, context: int) -> DataFrame:
    """One round: each row (chrom, at, unit, ...) moved left as far as context of its chunk allows. Adds anchor, the base before it, once it is done."""
    d = d.withColumn("chunk", F.floor((F.col("at") - 1) / width))
    d = d.join(chunks.select("chrom", "chunk", "seq"), ["chrom", "chunk"], "left")
    inside = F.col("at") - F.col("chunk") * width
    size = F.least(inside, F.lit(context)).cast("int")
    d = d.withColumn("left", F.upper(F.coalesce(F.substring(F.col("seq"), (inside - size + 1).cast("int"), size), F.lit("")))).drop("seq", "chunk")
    # moving by one turns the unit round: what it passes are its own bases from the end, over and over
    times = F.ceil(F.length("left") / F.length("unit")).cast("int")
    n = F.col("n")
    d = d.withColumn("n", shared_start(F.reverse("left"), F.repeat(F.reverse("unit"), times))).withColumn("turn", n % F.length("unit"))
    turned = F.concat(F.expr("right(unit, turn)"), F.expr("left(unit, length(unit) - turn)"))
    anchor = F.when(n < F.length("left"), F.substring(F.col("left"), F.length("left") - n, F.lit(1)))
    return d.withColumns({"at": F.col("at") - n, "unit": turned, "anchor": anchor, "ended": (F.length("left") == 0) | anchor.isNotNull()}).drop("left", "n", "turn")


def normalized(records: DataFrame, chunks: DataFrame, width: int) -> DataFrame:
    """records (chrom, pos from 0, ref, alt, one alternative a row, ...) with npos, nref and nalt: trimmed, and moved left as far as the reference allows.

    chunks: chrom, chunk, seq of width bases each. A gap that can be moved through its whole context is moved on in a further
    round with more of it, so that repeats of any length end at the same place. A change at the start of a contig takes the
    base behind it as its anchor. Rows whose alleles are no bases, or that have nulls there, keep their spelling.
    """
    spark = records.sparkSession
    d = kept(stripped(records).withColumn("__row", F.monotonically_increasing_id()))
    gap = (F.length("gone") == 0) != (F.length("come") == 0)
    todo = d.filter(gap & F.col("chrom").isNotNull() & F.col("pos").isNotNull()).select("__row", "chrom", "at", F.concat("gone", "come").alias("unit"), (F.length("come") > 0).alias("insertion"))
    done, context = [], CONTEXT
    while True:
        moved = kept(_moved(todo, chunks, width, context))
        done.append(moved.filter("ended OR at <= 0").drop("ended"))
        todo = moved.filter("NOT ended AND at > 0").drop("ended", "anchor")
        if todo.isEmpty():
            break
        context = min(context * 16, width)
    moved = done[0]
    for more in done[1:]:
        moved = moved.unionByName(more)
    # at a contig's start the base behind the change stands in
    behind = F.when(F.col("insertion"), F.lit(0)).otherwise(F.length("unit"))
    start = moved.filter("anchor IS NULL").withColumn("behind", behind).withColumn("chunk", F.floor(F.col("behind") / width))
    start = start.join(chunks.select("chrom", "chunk", "seq"), ["chrom", "chunk"], "left")
    start = start.withColumn("next", F.upper(F.coalesce(F.substring(F.col("seq"), (F.col("behind") - F.col("chunk") * width + 1).cast("int"), F.lit(1)), F.lit(""))))
    both = lambda before, after: [F.when(F.col("insertion"), x).otherwise(y) for x, y in ((before, F.concat(before, "unit", after)), (F.concat(before, "unit", after), before))]
    a = moved.filter("anchor IS NOT NULL")
    ref, alt = both(F.col("anchor"), F.lit(""))
    a = a.select("__row", (F.col("at") - 1).alias("npos"), ref.alias("nref"), alt.alias("nalt"))
    ref = F.when(F.col("insertion"), F.col("next")).otherwise(F.concat("unit", "next"))
    alt = F.when(F.col("insertion"), F.concat("unit", "next")).otherwise(F.col("next"))
    b = start.select("__row", F.col("at").alias("npos"), ref.alias("nref"), alt.alias("nalt"))
    found = a.unionByName(b)
    same = (F.length("gone") == 0) & (F.length("come") == 0)
    plain = F.when(F.col("at").isNotNull() & ~same, F.struct(F.col("at").alias("npos"), F.col("gone").alias("nref"), F.col("come").alias("nalt"))).otherwise(F.struct(F.col("pos").alias("npos"), F.col("ref").alias("nref"), F.col("alt").alias("nalt")))
    out = d.join(found.select("__row", F.struct("npos", "nref", "nalt").alias("x")), "__row", "left").withColumn("x", F.coalesce("x", plain))
    return out.select(*records.columns, "x.npos", "x.nref", "x.nalt")


def with_allele_ids(records: DataFrame, known: DataFrame, chunks: DataFrame, width: int, name: str = "name") -> DataFrame:
    """records with id: the least name of a known allele (chrom, pos, ref, alt, name) that is the same change; null where there is none."""
    key = ["chrom", "npos", "nref", "nalt"]
    ids = normalized(known, chunks, width).filter("npos IS NOT NULL").groupBy(*key).agg(F.min(name).alias("id"))
    return normalized(records, chunks, width).join(ids, key, "left").select(*records.columns, "npos", "nref", "nalt", "id")
