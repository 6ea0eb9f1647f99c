"""Alleles and genotypes: trimming, padding, compatibility, haplotypes, patch and merge rules, as columns.

A record is a struct with ref, alt (array), gt, gq, pl (array), filter (array) and delta (boolean); a null
struct is a position without a record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def trimmed(ref: Column, alt: Column) -> Column:
    """ref and alt without their common ending, each keeping a base at least."""
    most = F.least(F.length(ref), F.length(alt)) - 1
    r, a = F.reverse(ref), F.reverse(alt)
    at = F.when(most > 0, F.sequence(F.lit(1), F.greatest(most, F.lit(1)))).otherwise(F.array().cast("array<int>"))
    differ = F.filter(at, lambda i: r.substr(i, F.lit(1)) != a.substr(i, F.lit(1)))
    n = F.when(F.size(differ) > 0, F.get(differ, F.lit(0)) - 1).otherwise(F.size(at))
    return F.struct(ref.substr(F.lit(1), F.length(ref) - n).alias("ref"), alt.substr(F.lit(1), F.length(alt) - n).alias("alt"))


def padded(ref1: Column, alt1: Column, ref2: Column, alt2: Column) -> Column:
    """Two alleles of one position over the longer of their references: struct of ref and alts."""
    lack = lambda alt, ref, other: F.concat(alt, other.substr(F.length(ref) + 1, F.greatest(F.length(other) - F.length(ref), F.lit(0))))
    ref = F.when(F.length(ref1) >= F.length(ref2), ref1).otherwise(ref2)
    return F.struct(ref.alias("ref"), F.array(lack(alt1, ref1, ref2), lack(alt2, ref2, ref1)).alias("alts"))


def compatible(v: Column, d: Column) -> Column:
    """Whether every allele of v is, once trimmed, one of d's."""
    return F.forall(v["alt"], lambda a: F.exists(d["alt"], lambda b: trimmed(d["ref"], b) == trimmed(v["ref"], a)))


def best_two(alt: Column, pl: Column) -> Column:
    """Numbers (from 1) of the two alleles of least haploid likelihood; the first two without likelihoods."""
    ranked = F.array_sort(F.transform(F.slice(pl, 2, 1 << 20), lambda x, i: F.struct(x.alias("x"), (i + 1).alias("i"))))
    first = F.slice(F.sequence(F.lit(1), F.greatest(F.size(alt), F.lit(1))), 1, 2)
    return F.when(F.size(alt) <= 2, F.slice(first, 1, 2)).when(F.size(pl) > 0, F.transform(F.slice(ranked, 1, 2), lambda x: x["i"])).otherwise(first)


def haplotypes(gt: Column) -> Column:
    """Allele numbers on both haplotypes; 0 where a genotype is missing, or unphased and not of one allele."""
    a, b = F.regexp_extract(gt, r"^(\d+)[/|]\d+$", 1), F.regexp_extract(gt, r"^\d+[/|](\d+)$", 1)
    known = (a != "") & (gt.contains("|") | (a == b))
    return F.when(known, F.array(a.cast("int"), b.cast("int"))).otherwise(F.array(F.lit(0), F.lit(0)))


def cut(ref: Column, alt: Column) -> Column:
    """ref and alt shortened at the end by one length, so that the shorter keeps one base."""
    n = F.least(F.length(ref), F.length(alt)) - 1
    return F.struct(ref.substr(F.lit(1), F.length(ref) - n).alias("ref"), alt.substr(F.lit(1), F.length(alt) - n).alias("alt"))


def split_haplotypes(df: DataFrame, keys: list[str], numbered: dict[str, str] | None = None) -> DataFrame:
    """A row per haplotype that carries an allele: keys, hap (0 or 1), ref and its allele cut to their lengths.

    numbered names array columns with their declared count (A, R, G): what they hold for the allele is kept.
    """
    from ..functions.genotypes import subset

    d = df.select(*keys, *(numbered or {}), "ref", "alt", F.posexplode(haplotypes(F.col("gt"))).alias("hap", "allele"))
    # in two steps: a column of the lambda named like an output of the same select would be taken for that output
    d = d.filter("allele > 0 AND allele <= size(alt)").withColumn("cut", cut(F.col("ref"), F.get("alt", F.col("allele") - 1)))
    kept = [subset(F.col(c), n, F.array("allele")).alias(c) for c, n in (numbered or {}).items()]
    return d.select(*keys, "hap", "cut.ref", "cut.alt", *kept)


def extended_end(pos: Column, end: Column, repeat: Column, unit: Column, counts: Column) -> Column:
    """A record's end, or that of the tandem repeat (flag, unit, counts of units) that it lies in."""
    return F.when(F.coalesce(repeat, F.lit(False)), pos + 1 + F.length(unit) * F.get(counts, F.lit(0))).otherwise(end)


def _sure(v: Column, least_quality: int) -> Column:
    """No record, or one that is confidently the reference."""
    called = (F.size(v["pl"]) > 0) & (F.size(v["alt"]) > 0) & (F.get(v["pl"], F.lit(0)) == 0) & (v["gq"] >= least_quality)
    return v.isNull() | F.coalesce(called, F.lit(False))


def haploid_patch(v1: Column, v2: Column, d1: Column, d2: Column, two_inputs: bool = True, least_quality: int = 20) -> Column:
    """Records of both haplotypes after patching: array of (hap, source "patch" or "kept", record, delta); empty if both are sure to be the reference.

    A called d stands where v is absent or compatible with it. delta marks what was patched and, where haplotypes were
    called by themselves (two_inputs), tandem repeats (fields str, rpa) of four units or more.
    """

    def chosen(v: Column, d: Column) -> Column:
        takes = d.isNotNull() & d["gt"].isNotNull() & (v.isNull() | F.coalesce(compatible(v, d), F.lit(False)))
        return F.struct(F.when(takes, d).otherwise(v).alias("record"), takes.alias("patched"))

    def emitted(hap: int, x: Column) -> Column:
        r = x["record"]
        repeat = F.coalesce(r["str"] & (F.get(r["rpa"], F.lit(0)) >= 4), F.lit(False)) if two_inputs else F.lit(False)
        source = F.when(x["patched"], "patch").otherwise("kept")
        return F.when(r.isNotNull(), F.struct(F.lit(hap).alias("hap"), source.alias("source"), r.alias("record"), (x["patched"] | repeat).alias("delta")))

    a, b = chosen(v1, d1), chosen(v2, d2)
    both = F.array_compact(F.array(emitted(0, a), emitted(1, b)))
    return F.when(_sure(a["record"], least_quality) & _sure(b["record"], least_quality), F.slice(both, 1, 0)).otherwise(both)


def best_two_only(v: Column) -> Column:
    """A haploid record (ref, alt, pl, ad) with its two likeliest alleles at most: ref, alt, pl, ad, chosen."""
    from ..functions.genotypes import subset, trimmed_all

    few = F.size(v["alt"]) <= 2
    best = F.when(few, F.sequence(F.lit(1), F.greatest(F.size(v["alt"]), F.lit(1)))).otherwise(best_two(v["alt"], v["pl"]))
    text = F.when(few, F.struct(v["ref"].alias("ref"), v["alt"].alias("alts"))).otherwise(trimmed_all(v["ref"], subset(v["alt"], "A", best)))
    return F.struct(text["ref"].alias("ref"), text["alts"].alias("alt"), subset(v["pl"], "G", best, 1).alias("pl"), subset(v["ad"], "R", best).alias("ad"), best.alias("chosen"))


def patch(v: Column, d: Column, least_quality: int = 20) -> Column:
    """"patch" if d stands for v, "kept" if v stays, null if neither is called or d is a confident reference call.

    d stands where v is absent or compatible with it; an uncalled d counts as absent.
    """
    called = d.isNotNull() & d["gt"].isNotNull() & ~d["gt"].isin("./.", ".")
    takes = called & (v.isNull() | F.coalesce(compatible(v, d), F.lit(False)))
    sure = (F.size(d["alt"]) > 0) & (F.get(d["pl"], F.lit(0)) == 0) & (d["gq"] >= least_quality)
    return F.when(takes, F.when(~F.coalesce(sure, F.lit(False)), "patch")).when(v.isNotNull(), "kept")


def _valid(v: Column, reference: str) -> Column:
    return v.isNotNull() & (F.coalesce(F.size(v["filter"]), F.lit(0)) <= 0) & v["gt"].isNotNull() & (v["gt"] != reference)


def precedence(phased: Column, first: Column, second: Column, unphased: Column) -> Column:
    """Which records give a position's result: "phased", "joined" (of both haplotypes), "unphased", or null.

    A phased substitution wins; then patched haplotypes, a patched unphased record, the phased one.
    """
    ok = _valid(phased, "0/0")
    replaced = ok & F.exists(phased["alt"], lambda a: F.length(a) == F.length(phased["ref"]))
    delta = lambda v: F.coalesce(v["delta"], F.lit(False))
    return (
        F.when(replaced, "phased")
        .when(delta(first) | delta(second), F.when(_valid(first, "0") | _valid(second, "0"), "joined"))
        .when(delta(unphased), F.when(_valid(unphased, "0/0"), "unphased"))
        .when(ok, "phased")
    )


def joined(first: Column, second: Column, in_phase: Column) -> Column:
    """The diploid record of two haplotypes (structs of ref, alt, qual; null: the reference): ref, alts, gt, ac, af, an, qual.

    Null if both are null. Outside a phase block the genotype is unphased, and that of a single allele is 0/1.
    """
    both, one = first.isNotNull() & second.isNotNull(), F.coalesce(first, second)
    same = both & (first["ref"] == second["ref"]) & (first["alt"] == second["alt"])
    two = padded(first["ref"], first["alt"], second["ref"], second["alt"])
    apart = both & ~same
    gt = F.when(same, F.when(in_phase, "1|1").otherwise("1/1")).when(both, F.when(in_phase, "1|2").otherwise("1/2"))
    gt = gt.when(~in_phase, "0/1").when(first.isNotNull(), "1|0").otherwise("0|1")
    record = F.struct(
        F.when(apart, two["ref"]).otherwise(one["ref"]).alias("ref"), F.when(apart, two["alts"]).otherwise(F.array(one["alt"])).alias("alts"), gt.alias("gt"),
        F.when(same, F.array(F.lit(2))).when(both, F.array(F.lit(1), F.lit(1))).otherwise(F.array(F.lit(1))).alias("ac"),
        F.when(same, F.array(F.lit(1.0))).when(both, F.array(F.lit(0.5), F.lit(0.5))).otherwise(F.array(F.lit(0.5))).alias("af"),
        F.lit(2).alias("an"), F.when(both, first["qual"] + second["qual"]).otherwise(one["qual"]).alias("qual"),
    )
    return F.when(one.isNotNull(), record)
