"""Readers and writers of tab-separated interval and variant files."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read_bed(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """grp, s, e (0-based, half-open); comments, track lines and rows of fewer than three columns are skipped. Gzip by suffix."""
    c = F.split("value", "\t")
    lines = spark.read.text(path).filter(~F.col("value").startswith("#") & ~F.col("value").startswith("track") & (F.size(c) >= 3))
    return lines.select(F.get(c, F.lit(0)).alias("grp"), F.get(c, F.lit(1)).cast("long").alias("s"), F.get(c, F.lit(2)).cast("long").alias("e"))


def read_vcf(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per record of one or more files: chrom, pos (0-based), end, id, ref, alt, qual, filter, info (map, flags hold null), samples (array of maps), record.

    end is INFO's END where a record has one, as blocks and copy-number events do, else the end of ref. record numbers the
    rows in file order; it is the same whenever the same files are read.
    """
    return records(spark.read.text(path).select("value", F.monotonically_increasing_id().alias("record")))


def records(lines: DataFrame) -> DataFrame:
    """read_vcf's columns from lines (value, record)."""
    c = F.split("value", "\t")
    at = lambda i: F.get(c, F.lit(i))
    missing = lambda x: F.when(x != ".", x)
    keys = F.split(at(8), ":")
    samples = F.transform(F.slice(c, 10, 1 << 20), lambda s: F.map_from_entries(F.filter(F.arrays_zip(keys.alias("key"), F.split(s, ":").alias("value")), lambda x: x["key"].isNotNull())))
    info = F.when(at(7) != ".", F.str_to_map(at(7), F.lit(";"), F.lit("=")))
    declared = F.regexp_extract(at(7), r"(?:^|;)END=(\d+)(?:;|$)", 1).try_cast("long")
    return lines.filter(~F.col("value").startswith("#")).select(
        at(0).alias("chrom"), (at(1).try_cast("long") - 1).alias("pos"), F.coalesce(declared, at(1).try_cast("long") - 1 + F.length(at(3))).alias("end"), missing(at(2)).alias("id"), at(3).alias("ref"),
        F.when(at(4) != ".", F.split(at(4), ",")).otherwise(F.array().cast("array<string>")).alias("alt"), missing(at(5)).try_cast("double").alias("qual"),
        F.when(at(6) != ".", F.split(at(6), ";")).otherwise(F.array().cast("array<string>")).alias("filter"), info.alias("info"), samples.alias("samples"), "record",
    )


def with_info(vcf: DataFrame, values: dict[str, Column]) -> DataFrame:
    """Records with INFO entries set to the values (as text) that are not null."""
    keys, texts = F.array(*map(F.lit, values)), F.array(*[v.cast("string") for v in values.values()])
    new = F.map_filter(F.map_from_arrays(keys, texts), lambda _, v: v.isNotNull())
    old = F.map_filter(F.coalesce("info", F.create_map().cast("map<string,string>")), lambda k, _: ~F.map_contains_key(new, k))
    return vcf.withColumn("info", F.map_concat(old, new))


def read_codons(spark: SparkSession, path: str) -> DataFrame:
    """chrom, pos (0-based) and codon of "chrom:pos<tab>codon" lines; of lines for one locus the last of its file order wins."""
    c = F.split("value", "\t")
    d = spark.read.text(path).select(F.get(c, F.lit(0)).alias("locus"), F.get(c, F.lit(1)).alias("codon"), F.monotonically_increasing_id().alias("line"))
    d = d.groupBy("locus").agg(F.max_by("codon", "line").alias("codon"))
    return d.select(F.regexp_extract("locus", r"^(.*):\d+$", 1).alias("chrom"), (F.regexp_extract("locus", r":(\d+)$", 1).cast("long") - 1).alias("pos"), "codon")


def write_tsv(df: DataFrame, path: str) -> None:
    df.write.option("sep", "\t").option("header", True).csv(path)


def read_header(spark: SparkSession, path: str) -> DataFrame:
    """Declarations of a VCF header: kind (FILTER, INFO, FORMAT, contig, ...), id, number, type, length, description, line."""
    value = F.col("value")
    part = lambda key: F.nullif(F.regexp_extract("value", rf"[<,]{key}=([^,>]*)", 1), F.lit(""))
    return spark.read.text(path).filter(value.rlike("^##[A-Za-z]+=<")).select(
        F.regexp_extract(value, "^##([A-Za-z]+)=", 1).alias("kind"), part("ID").alias("id"), part("Number").alias("number"), part("Type").alias("type"),
        part("length").cast("long").alias("length"), F.nullif(F.regexp_extract(value, 'Description="((?:[^"\\\\]|\\\\.)*)"', 1), F.lit("")).alias("description"), value.alias("line"),
    )


def sample_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the samples in column order, from the one line that holds them."""
    line = spark.read.text(path).filter(F.col("value").startswith("#CHROM")).first()
    return line.value.split("\t")[9:] if line else []


def header_lines(spark: SparkSession, path: str) -> list[str]:
    """All lines of a header in their order; it is as long as its declarations, not as the file."""
    first = spark.read.text(path).filter(F.col("value").startswith("#")).select("value", F.monotonically_increasing_id().alias("n"))
    return [r.value for r in first.orderBy("n").collect()]


def extended_header(lines: list[str], added: list[str], removed: list[str] = []) -> list[str]:  # noqa: B006
    """Header lines with further declarations before the column names; those of the same kind and id, and removed ones (kind, id), give way."""
    import re

    name = lambda x: m.group() if (m := re.match(r"##\w+=<ID=[^,>]+", x)) else x
    gone = {name(x) for x in added} | set(removed)
    return [x for x in lines if x.startswith("##") and name(x) not in gone] + list(added) + [x for x in lines if not x.startswith("##")]


def contig_names(lines: list[str]) -> list[str]:
    """Contigs of header lines, in order."""
    import re

    return [m.group(1) for x in lines if (m := re.match(r"##contig=<(?:.*,)?ID=([^,>]+)", x))]


def added_declarations(first: DataFrame, second: DataFrame) -> DataFrame:
    """Declarations that only the second header has."""
    return second.join(first, ["kind", "id"], "left_anti")


def vcf_lines(df: DataFrame, *passed: str) -> DataFrame:
    """value, a VCF line for each record of read_vcf's columns, with chrom and pos to sort by.

    Missing values are a dot, an empty filter is PASS, numbers without a fraction lose it. FORMAT lists the keys of the
    first sample, GT first and the others sorted; samples that lack one get a dot.
    """
    dot = lambda c: F.coalesce(c, F.lit("."))
    listed = lambda c, sep, none: F.when(F.size(c) > 0, F.array_join(c, sep, ".")).otherwise(F.lit(none))
    entries = F.transform(F.array_sort(F.map_entries("info")), lambda e: F.when(e["value"].isNull(), e["key"]).otherwise(F.concat(e["key"], F.lit("="), e["value"])))
    keys = F.array_sort(F.map_keys(F.get("samples", F.lit(0))))
    keys = F.concat(F.filter(keys, lambda k: k == "GT"), F.filter(keys, lambda k: k != "GT"))
    values = F.transform("samples", lambda s: F.array_join(F.transform(keys, lambda k: dot(F.try_element_at(s, k))), ":"))
    qual = F.when(F.col("qual") == F.floor("qual"), F.col("qual").cast("long").cast("string")).otherwise(F.col("qual").cast("string"))
    fixed = [F.col("chrom"), (F.col("pos") + 1).cast("string"), dot(F.col("id")), F.col("ref"), listed(F.col("alt"), ",", "."), dot(qual), listed(F.col("filter"), ";", "PASS"), F.when(F.size("info") > 0, F.array_join(entries, ";")).otherwise(F.lit("."))]
    row = F.when(F.size("samples") > 0, F.concat(F.array(*fixed, F.array_join(keys, ":")), values)).otherwise(F.array(*fixed))
    return df.select("chrom", "pos", *passed, F.array_join(row, "\t").alias("value"))


def write_vcf(df: DataFrame, header: list[str], path: str, compression: str | None = None, contigs: list[str] | None = None, by_quality: bool = False) -> None:
    """A folder of text files, records ranged over them by contig and pos; each starts with the header's lines.

    Every file is a VCF by itself; read_vcf reads them all. Contigs are in the order given (the header's), others after
    them by name; records of one position in the order of record, or by falling quality first.
    """

    def headed(parts):
        for n, pdf in enumerate(parts):
            yield pdf[["value"]] if n else pd.concat([pd.DataFrame({"value": header}), pdf[["value"]]])

    place = {c: i for i, c in enumerate(contigs or [])}
    named = F.map_from_arrays(F.array(*map(F.lit, place)), F.array(*map(F.lit, place.values()))) if place else None
    nth = F.coalesce(F.try_element_at(named, F.col("chrom")), F.lit(len(place))) if place else F.lit(0)
    record = F.col("record") if "record" in df.columns else F.lit(0)
    rows = vcf_lines(df.withColumns({"__nth": nth, "__record": record}), "__nth", "__record", "qual")
    last = [F.col("qual").desc_nulls_last()] if by_quality else []
    rows = rows.repartitionByRange("__nth", "chrom", "pos").sortWithinPartitions("__nth", "chrom", "pos", *last, "__record")
    rows.select("value").mapInPandas(headed, "value string").write.text(path, compression=compression)


def read_fasta(spark: SparkSession, path: str, width: int = 1 << 16) -> DataFrame:
    """chrom, chunk, seq: chunks of width bases, for neighbours.following. Lines may be of any length.

    Files are read by line; the positions of lines come from per-file prefix sums over pieces of the files, so no
    sequence has to fit into a task.
    """
    offset = F.monotonically_increasing_id()
    d = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), offset.alias("line"), "value").filter("value <> ''")
    # lines of one block are walked in order; what the blocks before pass on is each one's last name
    d = d.withColumns({"part": F.shiftright("line", 12), "name": F.when(F.col("value").startswith(">"), F.regexp_extract("value", r"^>(\S*)", 1))})
    upto = Window.partitionBy("path", "part").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("path").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    passed = d.groupBy("path", "part").agg(F.max_by("name", F.when(F.col("name").isNotNull(), F.col("line"))).alias("last"))
    passed = passed.select("path", "part", F.last("last", ignorenulls=True).over(before).alias("earlier"))
    bases = d.withColumn("own", F.last("name", ignorenulls=True).over(upto)).filter("name IS NULL").join(passed, ["path", "part"])
    bases = bases.withColumn("chrom", F.coalesce("own", "earlier")).filter("chrom IS NOT NULL").select("path", "chrom", "line", F.upper(F.trim("value")).alias("seq"))
    block = bases.withColumn("block", F.shiftright("line", 12))
    sums = block.groupBy("path", "chrom", "block").agg(F.sum(F.length("seq")).alias("n"))
    before = F.sum("n").over(Window.partitionBy("path", "chrom").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.select("path", "chrom", "block", F.coalesce(before, F.lit(0)).alias("base"))
    inside = F.sum(F.length("seq")).over(Window.partitionBy("path", "chrom", "block").orderBy("line").rowsBetween(Window.unboundedPreceding, 0))
    placed = block.withColumn("inside", inside - F.length("seq")).join(sums, ["path", "chrom", "block"]).withColumn("at", F.col("base") + F.col("inside"))
    cut = F.explode(F.sequence(F.floor(F.col("at") / width), F.floor((F.col("at") + F.length("seq") - 1) / width)))
    pieces = placed.select("chrom", "at", "seq", cut.alias("chunk")).withColumn("lo", F.greatest(F.col("at"), F.col("chunk") * width))
    hi = F.least(F.col("at") + F.length("seq"), (F.col("chunk") + 1) * width)
    pieces = pieces.select("chrom", "chunk", "lo", F.col("seq").substr((F.col("lo") - F.col("at") + 1).cast("int"), (hi - F.col("lo")).cast("int")).alias("seq"))
    ordered = F.array_sort(F.collect_list(F.struct("lo", "seq")))
    return pieces.groupBy("chrom", "chunk").agg(F.array_join(F.transform(ordered, lambda p: p["seq"]), "").alias("seq"))


def read_contigs(spark: SparkSession, path: str) -> DataFrame:
    """Whole contigs (grp, s, e) of a FASTA index."""
    c = F.split("value", "\t")
    return spark.read.text(path).filter(F.size(c) >= 2).select(F.get(c, F.lit(0)).alias("grp"), F.lit(0).cast("long").alias("s"), F.get(c, F.lit(1)).cast("long").alias("e"))


def read_sam_header(spark: SparkSession, path: str) -> DataFrame:
    """Contigs (tid, name, length) of a header's text, numbered in order of the lines."""
    fields = F.str_to_map(F.regexp_replace("value", r"^@SQ\t", ""), F.lit("\t"), F.lit(":"))
    d = spark.read.text(path).select("value", F.monotonically_increasing_id().alias("line")).filter(F.col("value").startswith("@SQ\t"))
    d = d.select("line", fields["SN"].alias("name"), fields["LN"].cast("long").alias("length"))
    # a header holds one line per contig; its lines are numbered in one window
    return d.select((F.row_number().over(Window.orderBy("line")) - 1).alias("tid"), "name", "length")


def read_strata(spark: SparkSession, path: str) -> DataFrame:
    """stratum, grp, s, e of a list of "name<tab>BED file" lines, files relative to the list; blank lines are skipped."""
    listed = [r.value.split("\t") for r in spark.read.text(path).filter(F.trim("value") != "").collect()]
    folder = path.rsplit("/", 1)[0] if "/" in path else "."
    parts = [read_bed(spark, f if f.startswith("/") or "://" in f else f"{folder}/{f}").withColumn("stratum", F.lit(name)) for name, f in listed]
    if not parts:
        return spark.createDataFrame([], "stratum string, grp string, s long, e long")
    return reduce(lambda a, b: a.unionByName(b), parts).select("stratum", "grp", "s", "e")


def regions(spark: SparkSession, text: str) -> DataFrame:
    """grp, s, e of a region text: "chr1:1-100,chr2:5-9", from 1 and both ends included; a name may hold colons."""
    d = spark.range(1).select(F.explode(F.split(F.lit(text), ",")).alias("one"))
    at = lambda g: F.regexp_extract("one", r"^(.*):(\d+)-(\d+)$", g)
    return d.select(at(1).alias("grp"), (at(2).cast("long") - 1).alias("s"), at(3).cast("long").alias("e"))
