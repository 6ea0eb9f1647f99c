"""Records of haplotypes as whole records: patched by others, and joined to diploid ones.

Streams hold the first record of each position: chrom, pos, ref, alt, gt, gq, pl, ad, filter, qual, delta, str, ru, rpa
and the record's own id, info, samples, end and record. Counts are what a file's header declares: for INFO and FORMAT,
the ids of the fields that count by allele (A), by allele and reference (R) or by genotype (G).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import genotypes
from . import intervals, positional, variants


@dataclass(frozen=True)
class Counts:
    """Ids by declared number, of INFO and FORMAT fields."""

    info: dict[str, list[str]] = field(default_factory=dict)
    sample: dict[str, list[str]] = field(default_factory=dict)


def chosen_only(fields: Column, counted: dict[str, list[str]], alleles: Column, ploidy: int = 2, genotype_at: Column | None = None) -> Column:
    """fields (text by name), those with a count cut down to the chosen alleles; what a field lacks is a dot.

    genotype_at, if given, holds the places of the genotypes to keep.
    """

    def value(k: Column, v: Column) -> Column:
        out = F.when(v == ".", v)
        for count, ids in counted.items():
            parts = F.split(v, ",")
            kept = F.transform(genotype_at, lambda i: F.get(parts, i)) if count == "G" and genotype_at is not None else genotypes.subset(parts, count, alleles, ploidy)
            out = out.when(k.isin(ids), F.array_join(kept, ",", "."))
        return out.otherwise(v)

    return F.transform_values(fields, value) if any(counted.values()) else fields


def with_first(samples: Column, first: Column) -> Column:
    return F.when(F.size(samples) > 0, F.concat(F.array(first), F.slice(samples, 2, 1 << 20))).otherwise(samples)


def with_entries(fields: Column, values: dict[str, Column]) -> Column:
    """fields with entries set to the values (text) that are not null."""
    new = F.map_filter(F.map_from_arrays(F.array(*map(F.lit, values)), F.array(*values.values())), lambda _, v: v.isNotNull())
    return F.map_concat(F.map_filter(fields, lambda k, _: ~F.map_contains_key(new, k)), new)


def some(info: Column) -> Column:
    return F.coalesce(info, F.create_map().cast("map<string,string>"))


def _numbers(text: Column) -> Column:
    return F.transform(F.split(F.nullif(text, F.lit(".")), ","), lambda v: v.try_cast("int"))


def one_haplotype(v: Column, hap: int, counts: Counts) -> Column:
    """The haploid record of one side of a phased record; null where it carries the reference or no call."""
    allele = F.get(variants.haplotypes(v["gt"]), F.lit(hap))
    there, at = F.array(allele), F.array(F.lit(0), (allele * (allele + 1) / 2).cast("int"))
    text = variants.cut(v["ref"], F.get(v["alt"], allele - 1))
    info = chosen_only(some(v["info"]), {k: x for k, x in counts.info.items() if k != "G"}, there)
    first = chosen_only(F.get(v["samples"], F.lit(0)), counts.sample, there, 2, at)
    record = v.withField("ref", text["ref"]).withField("alt", F.array(text["alt"])).withField("gt", F.lit("1")).withField("info", info)
    record = record.withField("pl", F.when(v["pl"].isNotNull(), F.transform(at, lambda i: F.get(v["pl"], i)))).withField("ad", genotypes.subset(v["ad"], "R", there))
    record = record.withField("rpa", genotypes.subset(v["rpa"], "R", there) if "RPA" in counts.info.get("R", []) else v["rpa"])
    return F.when((allele > 0) & (allele <= F.size(v["alt"])), record.withField("samples", with_first(v["samples"], with_entries(first, {"GT": F.lit("1")}))))


def patched(streams: dict[str, DataFrame], counts: dict[str, Counts]) -> DataFrame:
    """Both haplotypes' records patched by others: hap, source, chrom, pos, end, id, ref, alt, qual, filter, info, samples, record.

    streams: v1 and v2, or v (one phased file, whose records are split), and d1 and d2. A record of more than two alleles
    keeps the two likeliest, in that order, and of its fields what belongs to them; its genotype is numbered anew. DELTA
    marks patched records and, of haplotypes called by themselves, repeats of four units or more.
    """
    m = positional.full_outer(streams, ["chrom", "pos"])
    phased = "v" in streams
    if phased:
        m = m.select("chrom", "pos", *[one_haplotype(F.col("v"), h, counts["v"]).alias(f"v{h + 1}") for h in (0, 1)], "d1", "d2")
    # all of one shape, so that either may stand
    m = m.select("chrom", "pos", F.inline(variants.haploid_patch(*map(F.col, ("v1", "v2", "d1", "d2")), two_inputs=not phased)))
    r = F.col("record")
    many = F.size("record.alt") > 2
    best = F.when(many, variants.best_two(r["alt"], r["pl"])).otherwise(F.sequence(F.lit(1), F.greatest(F.size("record.alt"), F.lit(1))))
    m = m.withColumn("best", best)

    def by_file(fields: Column, kind: str) -> Column:
        out = F.when(~many, fields)
        for hap in (0, 1):
            for source, name in (("patch", f"d{hap + 1}"), ("kept", "v" if phased else f"v{hap + 1}")):
                out = out.when((F.col("hap") == hap) & (F.col("source") == source), chosen_only(fields, getattr(counts[name], kind), F.col("best"), 1))
        return out

    text = F.when(many, genotypes.trimmed_all(r["ref"], genotypes.subset(r["alt"], "A", F.col("best")))).otherwise(F.struct(r["ref"].alias("ref"), r["alt"].alias("alts")))
    m = m.withColumns({"text": text, "info": by_file(some(r["info"]), "info"), "first": by_file(F.get(r["samples"], F.lit(0)), "sample")})
    gt = F.when(many, genotypes.renumbered(r["gt"], F.col("best")))
    info = F.map_filter("info", lambda k, _: (k != "ML_PROB") & ~((k == "DELTA") & F.col("delta")))
    info = F.when(F.col("delta"), F.map_concat(info, F.create_map(F.lit("DELTA"), F.lit(None).cast("string")))).otherwise(info)
    return m.select(
        "hap", "source", "chrom", "pos", (F.col("pos") + F.length("text.ref")).alias("end"), "record.id", "text.ref", F.col("text.alts").alias("alt"), "record.qual", F.array().cast("array<string>").alias("filter"),
        info.alias("info"), with_first(r["samples"], with_entries(F.col("first"), {"GT": gt})).alias("samples"), "record.record",
    )


def _haploid(v: Column, counts: Counts) -> Column:
    """What a joined record takes of a called haploid one: the allele that its genotype names, its quality, depths and repeats."""
    allele = v["gt"].try_cast("int")
    text = variants.trimmed(v["ref"], F.get(v["alt"], allele - 1))
    first, info = F.get(v["samples"], F.lit(0)), lambda k: F.try_element_at(v["info"], F.lit(k))
    own = lambda kind, k, x: genotypes.subset(x, "R", F.array(allele)) if k in getattr(counts, kind).get("R", []) else x
    called = v.isNotNull() & (F.coalesce(F.size(v["filter"]), F.lit(0)) <= 0) & v["gt"].isNotNull() & (v["gt"] != "0")
    number = lambda x: F.nullif(x, F.lit(".")).try_cast("int")
    record = F.struct(
        text["ref"].alias("ref"), text["alt"].alias("alt"), v["qual"].alias("qual"), number(F.try_element_at(first, F.lit("DP"))).alias("dp"), number(info("DP")).alias("info_dp"),
        own("sample", "AD", _numbers(F.try_element_at(first, F.lit("AD")))).alias("ad"), own("info", "RPA", _numbers(info("RPA"))).alias("rpa"), F.when(F.map_contains_key(v["info"], F.lit("STR")), True).alias("str"), info("RU").alias("ru"),
    )
    return F.when(called, record)


def merged(streams: dict[str, DataFrame], blocks: DataFrame, declared: Counts, counts: dict[str, Counts]) -> DataFrame:
    """One diploid record for each position: chrom, pos, end, id, ref, alt, qual, filter, info, samples, record, source.

    streams: v (phased), h1 and h2 (patched haplotypes), u (patched unphased). declared: the ids that v's header declares,
    by number ("" stands for all numbers but A and R); the joined records' fields follow from it. A joined record starts
    as the phased one with an empty first sample, or as an empty one. Phase sets are starts of blocks (disjoint).
    """
    m = positional.full_outer(streams, ["chrom", "pos"])
    m = m.withColumn("source", variants.precedence(*map(F.col, ("v", "h1", "h2", "u")))).filter("source IS NOT NULL")
    m = intervals.containing(m.withColumnsRenamed({"chrom": "grp", "pos": "at"}), blocks).withColumnsRenamed({"grp": "chrom", "at": "pos"})
    m = m.withColumns({h: _haploid(F.col(h), counts[h]) for h in ("h1", "h2")})
    v = F.col("v")
    usable = v.isNotNull() & (F.coalesce(F.size(v["filter"]), F.lit(0)) <= 0) & v["gt"].isNotNull() & (v["gt"] != "0/0")
    one, two, phase = F.col("h1"), F.col("h2"), F.col("phase")
    m = m.withColumns({"base": F.when(usable, v), "j": variants.joined(one, two, phase.isNotNull())})
    m = m.withColumn("x", genotypes.joined_fields(one, two, F.size("j.alts") == 1))
    numbers = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",")
    zero = lambda h, k: F.coalesce(F.col(h)[k], F.lit(0))
    base = F.col("base")
    by = lambda k: next((n for n, ids in declared.info.items() if k in ids), None)
    # of the phased record: fields by allele go, but repeats, which joined ones replace; of the others only QD goes
    gone = [k for n in ("A", "R") for k in declared.info.get(n, []) if k != "RPA"] + [k for k in declared.info.get("", []) if k == "QD"]
    inherited = F.map_filter(some(base["info"]), lambda k, _: ~k.isin(gone)) if gone else some(base["info"])
    alone = base.isNull()
    flag = F.array(F.lit("STR")) if by("STR") == "" else F.array().cast("array<string>")
    set_ = {"AC": numbers(F.col("j.ac")), "AF": numbers(F.col("j.af")), "AN": F.when(~alone, F.lit("2")) if by("AN") == "" else F.lit("2")}
    if by("RPA") == "R":
        set_["RPA"] = numbers(F.col("x.rpa"))
    if by("RU") == "":
        set_["RU"] = F.when(alone, F.col("x.ru"))
    if by("DP") == "":
        set_["DP"] = F.when(alone, (zero("h1", "info_dp") + zero("h2", "info_dp")).cast("string"))
    info = with_entries(inherited, set_)
    flags = F.map_from_arrays(flag, F.transform(flag, lambda _: F.lit(None).cast("string")))
    info = F.when(alone & F.coalesce(F.col("x.str"), F.lit(False)), F.map_concat(info, flags)).otherwise(info)
    sample = {"GT": F.col("j.gt"), "PS": phase.cast("string")}
    if "AD" in declared.sample.get("R", []):
        sample["AD"] = numbers(F.col("x.ad"))
    if "DP" in [k for n, ids in declared.sample.items() if n != "R" for k in ids]:
        sample["DP"] = (zero("h1", "dp") + zero("h2", "dp")).cast("string")
    first = with_entries(F.create_map().cast("map<string,string>"), sample)
    none = F.array().cast("array<string>")
    made = F.struct(
        base["id"].alias("id"), F.col("j.ref").alias("ref"), F.col("j.alts").alias("alt"), F.col("j.qual").alias("qual"), none.alias("filter"), info.alias("info"),
        F.concat(F.array(first), F.slice(F.coalesce(base["samples"], F.array().cast("array<map<string,string>>")), 2, 1 << 20)).alias("samples"), F.coalesce(base["record"], F.lit(-1).cast("long")).alias("record"),
    )
    names = ("id", "ref", "alt", "qual", "filter", "info", "samples", "record")
    whole = lambda c, info: F.struct(*[(info if n == "info" else c[n]).alias(n) for n in names])
    u = F.col("u")
    out = F.when(F.col("source") == "joined", made).when(F.col("source") == "unphased", whole(u, F.map_filter(some(u["info"]), lambda k, _: k != "DELTA"))).otherwise(whole(v, v["info"]))
    return m.select("chrom", "pos", "source", out.alias("r")).select("chrom", "pos", (F.col("pos") + F.length("r.ref")).alias("end"), *[f"r.{n}" for n in names], "source")
