"""Arrays counted per allele (A, R) or per genotype (G): subsets for chosen alleles, likelihoods, fields of a joined record.

Alleles are numbered from 1 in order of the alternatives; 0 is the reference.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..operators.variants import trimmed

#: Likelihood of an allele that a record does not carry.
ABSENT = 999_999_999


def subset(values: Column, count: str, alleles: Column, ploidy: int = 2) -> Column:
    """What stays of an array whose length the header declares as count (A, R or G; any other stays whole), for ascending alleles.

    Elements beyond the array's end are null. A null array stays null.
    """
    kept = F.concat(F.array(F.lit(0)), alleles)
    if count == "A":
        at = F.transform(alleles, lambda a: a - 1)
    elif count == "R" or (count == "G" and ploidy == 1):
        at = kept
    elif count == "G":
        at = F.flatten(F.transform(kept, lambda b, i: F.transform(F.slice(kept, 1, i + 1), lambda a: (b * (b + 1) / 2).cast("int") + a)))
    else:
        return values
    return F.when(values.isNotNull(), F.transform(at, lambda i: F.get(values, i)))


def trimmed_all(ref: Column, alts: Column) -> Column:
    """ref and alts (struct) without the ending that all share, each keeping its first base at least."""
    shortest = F.least(F.length(ref), F.array_min(F.transform(alts, F.length))) - 1
    sizes = F.when(shortest > 0, F.sequence(F.lit(1), F.greatest(shortest, F.lit(1)))).otherwise(F.array().cast("array<int>"))
    shared = F.filter(sizes, lambda n: F.forall(alts, lambda a: F.right(a, n) == F.right(ref, n)))
    n = F.coalesce(F.array_max(shared), F.lit(0))
    return F.struct(ref.substr(F.lit(1), F.length(ref) - n).alias("ref"), F.transform(alts, lambda a: a.substr(F.lit(1), F.length(a) - n)).alias("alts"))


def cut_all(ref: Column, alts: Column) -> Column:
    """ref and alts (struct) shortened at the end by one length, so that the shortest keeps one base."""
    n = F.least(F.length(ref), F.array_min(F.transform(alts, F.length))) - 1
    return F.struct(ref.substr(F.lit(1), F.length(ref) - n).alias("ref"), F.transform(alts, lambda a: a.substr(F.lit(1), F.length(a) - n)).alias("alts"))


def renumbered(gt: Column, alleles: Column) -> Column:
    """A haploid genotype by the chosen alleles: one that is not among them, or a missing one, becomes 0."""
    called = F.coalesce(gt.try_cast("int"), F.lit(0))
    return F.when(called > 0, F.array_position(alleles, called).cast("string")).otherwise(gt)


def best_pair(alt: Column, pl: Column) -> Column:
    """At most two alleles, ascending: those of the likeliest genotype with a variant, and if that holds only one, of the next that shares it.

    pl has an element per diploid genotype; null if it has not. A record of one allele keeps it.
    """
    n = F.size(alt)
    every = F.transform(pl, lambda p, k: F.struct(p.alias("p"), k.alias("k"), F.floor((F.sqrt(8 * k + 1) - 1) / 2).cast("int").alias("b")))
    every = F.transform(every, lambda g: F.struct(g["p"].alias("p"), g["k"].alias("k"), (g["k"] - (g["b"] * (g["b"] + 1) / 2).cast("int")).alias("a"), g["b"].alias("b")))
    variant = F.filter(every, lambda g: g["k"] > 0)
    # the first choice and all genotypes travel as one value, so that neither is computed again for each element
    first = F.struct(F.array_min(variant).alias("g"), variant.alias("all"))

    def chosen(x: Column) -> Column:
        one, b = x["g"], x["g"]["b"]
        others = F.filter(x["all"], lambda g: (g["k"] != one["k"]) & (g["a"].isin(0) | (g["a"] == b) | (g["b"] == b)))
        second = F.when((one["a"] == 0) | (one["a"] == b), F.array_min(others)["b"]).otherwise(F.lit(0))
        return F.filter(F.array_sort(F.array_distinct(F.array(one["a"], b, second))), lambda i: i > 0)

    return F.when(n == 1, F.array(F.lit(1))).when(F.size(pl) == ((n + 1) * (n + 2) / 2).cast("int"), F.get(F.transform(F.array(first), chosen), F.lit(0)))


def likelihood(ref: Column, alt: Column, pl: Column, allele: Column) -> Column:
    """Number and haploid likelihood (struct allele, pl) that a record gives to a trimmed allele (struct ref, alt; null: the reference).

    (0, 0) for the reference where there is no record, (-1, ABSENT) for an allele it does not carry.
    """
    pair = lambda a, p: F.struct(a.cast("int").alias("allele"), p.cast("int").alias("pl"))
    same = F.filter(F.transform(alt, lambda a, i: F.struct(i.alias("i"), trimmed(ref, a).alias("cut"))), lambda x: x["cut"] == allele)
    at = F.get(same, F.lit(0))["i"] + 1
    return (
        F.when(ref.isNull() & allele.isNull(), pair(F.lit(0), F.lit(0)))
        .when((F.size(pl) > 0) & (F.size(alt) > 0) & allele.isNull(), pair(F.lit(0), F.get(pl, F.lit(0))))
        .when((F.size(pl) > 0) & at.isNotNull(), pair(at, F.get(pl, at)))
        .otherwise(pair(F.lit(-1), F.lit(ABSENT)))
    )


def joined_fields(first: Column, second: Column, same: Column) -> Column:
    """Depths and repeats of a record of two haplotypes (structs with dp, ad, rpa, str, ru; arrays of the reference and one allele).

    Depths add up; ad and rpa are null if nothing counts for the reference. The second's repeats stand before the first's.
    same tells whether both carry one allele.
    """
    at = lambda v, field, i: F.get(v[field], F.lit(i))
    zero = lambda x: F.coalesce(x, F.lit(0))
    added = lambda field, i: zero(at(first, field, i)) + zero(at(second, field, i))
    apart = first.isNotNull() & second.isNotNull() & ~F.coalesce(same, F.lit(False))
    ad = F.when(apart, F.array(added("ad", 0), zero(at(first, "ad", 1)), zero(at(second, "ad", 1)))).otherwise(F.array(added("ad", 0), added("ad", 1)))
    later = lambda i: zero(F.coalesce(at(second, "rpa", i), at(first, "rpa", i)))
    rpa = F.when(apart, F.array(later(0), zero(at(first, "rpa", 1)), zero(at(second, "rpa", 1)))).otherwise(F.array(later(0), later(1)))
    return F.struct(
        (zero(first["dp"]) + zero(second["dp"])).alias("dp"), F.when(F.get(ad, F.lit(0)) != 0, ad).alias("ad"), F.when(F.get(rpa, F.lit(0)) != 0, rpa).alias("rpa"),
        F.coalesce(first["str"], second["str"]).alias("str"), F.coalesce(first["ru"], second["ru"]).alias("ru"),
    )
