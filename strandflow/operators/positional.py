"""Positional merges of several streams, ordered numbering, slot densities and top-k."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def full_outer(streams: dict[str, DataFrame], keys: list[str]) -> DataFrame:
    """One row per position; each stream's other columns are a struct under its name, null where it has no row.

    Streams have one row per position. All are united and grouped, so that any number of them takes one shuffle.
    """
    packed = [d.select(*keys, F.struct(*[c for c in d.columns if c not in keys]).alias(n)) for n, d in streams.items()]
    united = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), packed)
    return united.groupBy(*keys).agg(*[F.first(n, ignorenulls=True).alias(n) for n in streams])


def by_stream(df: DataFrame, keys: list[str], stream: str, names: dict[str, object]) -> DataFrame:
    """The same from one table whose column stream tells the streams apart; names gives its value for each."""
    packed = F.struct(*[c for c in df.columns if c not in keys and c != stream])
    return df.groupBy(*keys).agg(*[F.first(F.when(F.col(stream) == v, packed), ignorenulls=True).alias(n) for n, v in names.items()])


def triplets(pieces: DataFrame, key: str, order: list[str], length: str) -> DataFrame:
    """Numbers units of three bases across the ordered pieces of each key (base from 1, within its piece from 0); an incomplete last unit is dropped."""
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    all_ = Window.partitionBy(key)
    d = pieces.withColumns({"upto": F.sum(length).over(w), "total": F.sum(length).over(all_)})
    d = d.filter(F.col(length) > 0).withColumn("base", F.explode(F.sequence(F.col("upto") - F.col(length) + 1, F.col("upto"))))
    d = d.withColumn("within", F.col("base") - F.col("upto") + F.col(length) - 1)
    return d.withColumn("unit", F.floor((F.col("base") - 1) / 3) + 1).filter(F.col("unit") * 3 <= F.col("total")).drop("upto", "total")


def density(spans: DataFrame, width: int) -> DataFrame:
    """Each span's size spread evenly over the slots that it meets: grp, slot, density."""
    lo, hi = F.floor(F.col("s") / width), F.floor((F.col("e") - 1) / width)
    d = spans.withColumn("share", F.col("size") / (hi - lo + 1)).withColumn("slot", F.explode(F.sequence(lo, hi)))
    return d.groupBy("grp", "slot").agg(F.sum("share").alias("density"))


def top_sum(dense: DataFrame, k: int, factor: float) -> DataFrame:
    """factor times the sum of the k largest densities of each grp."""
    w = Window.partitionBy("grp").orderBy(F.desc("density"), "slot")
    return dense.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= k).groupBy("grp").agg((F.sum("density") * factor).alias("estimate"))


def adjacent_runs(df: DataFrame, value: str, line: str, block: int = 12) -> DataFrame:
    """Adds run: numbered stretches of rows of one value that follow each other in the order of line (distinct numbers).

    Lines are walked in blocks of 2 ** block numbers; a table of one row per block passes on the last value and the count.
    """
    d = df.withColumn("part", F.shiftright(F.col(line).cast("long"), block))
    w = Window.partitionBy("part").orderBy(line)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # over one row per block
    last = d.groupBy("part").agg(F.max_by(F.struct(value), line).alias("v")).select("part", F.last("v").over(before).alias("earlier"))
    d = d.join(last, "part").withColumn("new", (~F.coalesce(F.lag(F.struct(value)).over(w), F.col("earlier")).eqNullSafe(F.struct(value))).cast("int"))
    d = d.withColumn("run", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    count = d.groupBy("part").agg(F.sum("new").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return d.join(count, "part").withColumn("run", F.col("run") + F.col("base")).drop("part", "earlier", "new", "base")


def codons(exons: DataFrame) -> DataFrame:
    """chrom, pos, codon of exons (line, chrom, s, e, transcript): bases of exons that follow each other with one transcript, three by three.

    A transcript's version (after the first full stop) does not count; the last one or two bases of a run are left out.
    """
    d = exons.withColumns({"name": F.split_part("transcript", F.lit("."), F.lit(1)), "len": F.greatest(F.col("e") - F.col("s"), F.lit(0).cast("long"))})
    n = triplets(adjacent_runs(d, "name", "line"), "run", ["line"], "len")
    return n.select("chrom", (F.col("s") + F.col("within")).alias("pos"), F.concat("name", F.lit("-Codon"), F.col("unit").cast("string")).alias("codon"))


def shard_memory(dense: DataFrame, shards: DataFrame, threads: int, fragment: int = 1_000_000, width: int = 1 << 14, factor: float = 8.0, calibrated: bool = False) -> DataFrame:
    """Gigabytes that each shard needs: factor (twice that with calibration) times its densest slots, one for each thread.

    dense: grp, slot, density. shards: shard, grp, s, e, several rows for a shard of several regions. Slots are taken fragment
    by fragment, so one at a fragment's bound counts for both; the last fragment is not cut at the shard's end.
    """
    w = Window.partitionBy("shard").orderBy(F.desc("density"))
    d = fragment_slots(dense, shards, fragment, width)
    top = d.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= threads).groupBy("shard").agg(F.sum("density").alias("size"))
    scale = factor * (2 if calibrated else 1) / (1 << 30)
    return shards.select("shard").distinct().join(top, "shard", "left").select("shard", (F.coalesce("size", F.lit(0.0)) * scale).alias("gigabytes"))


def fragment_slots(dense: DataFrame, shards: DataFrame, fragment: int = 1_000_000, width: int = 1 << 14) -> DataFrame:
    """shard, grp, slot, density of the slots of every fragment of the shards."""
    f = shards.filter("s < e").withColumn("f", F.explode(F.sequence(F.col("s"), F.col("e") - 1, F.lit(fragment).cast("long"))))
    slots = F.sequence(F.floor(F.col("f") / width), F.floor((F.col("f") + fragment + width - 1) / width) - 1)
    return f.select("shard", "grp", F.explode(slots).alias("slot")).join(dense, ["grp", "slot"])


def site_union(records: DataFrame, keys: list[str], sample: str, allele: str) -> DataFrame:
    """A row per place of any sample's records: how many samples have one there, and their alleles."""
    return records.groupBy(*keys).agg(F.count_distinct(sample).alias("samples"), F.array_sort(F.collect_set(allele)).alias("alleles"))


def with_ids(sites: DataFrame, known: DataFrame, keys: list[str], name: str) -> DataFrame:
    """sites with id from known ones (keys, name; one row for a place), null where there is none."""
    return sites.join(known.select(*keys, F.col(name).alias("id")), keys, "left")


def site_fill(sites: DataFrame, variants: DataFrame, blocks: DataFrame) -> DataFrame:
    """For every site (grp, s) each sample's own variant there, or the block of it that covers the site: grp, s, sample, source and the record.

    variants (grp, s, sample, ...) and blocks (grp, s, e, sample, ...) share their further columns, as structs in record.
    Of a sample's variants at a site, and of its blocks over it, the one that starts last, then the greatest record, stands.
    A sample without a record there has no row: sites meet blocks by an overlap join, not samples.
    """
    from .intervals import overlap_join

    more = [c for c in variants.columns if c in blocks.columns and c not in ("grp", "s", "e", "sample")]
    places = sites.select("grp", "s").distinct()
    own = variants.join(places, ["grp", "s"], "left_semi").select("grp", "s", "sample", F.lit(1).alias("rank"), F.col("s").alias("from"), F.struct(*more).alias("record"))
    hit = overlap_join(places.withColumn("e", F.col("s") + 1), blocks.select("grp", "s", "e", "sample", *more))
    over = hit.select("grp", F.col("as").alias("s"), F.col("b_sample").alias("sample"), F.lit(0).alias("rank"), F.col("bs").alias("from"), F.struct(*[F.col(f"b_{c}").alias(c) for c in more]).alias("record"))
    best = own.unionByName(over).groupBy("grp", "s", "sample").agg(F.max(F.struct("rank", "from", "record")).alias("x"))
    return best.select("grp", "s", "sample", F.when(F.col("x.rank") == 1, "variant").otherwise("block").alias("source"), F.col("x.record").alias("record"))
