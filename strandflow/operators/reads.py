"""Aligned reads: ends from operation strings, duplicates by coordinates, metrics in one scan, tags by read structure, consensus by tag.

A read: name, chrom, pos (from 0), cigar, reverse, seq, qual (Phred + 33). Both reads of a pair share their name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import kept

#: Base qualities below this do not count for a read's score.
LEAST_QUALITY = 15


def operations(cigar: Column) -> Column:
    """Array of (n, op) of an operation string; empty for a star or null."""
    found = F.regexp_extract_all(F.coalesce(cigar, F.lit("")), F.lit(r"(\d+[MIDNSHP=X])"), F.lit(1))
    return F.transform(found, lambda x: F.struct(F.substring(x, F.lit(1), F.length(x) - 1).cast("long").alias("n"), F.right(x, F.lit(1)).alias("op")))


def _summed(ops: Column, kinds: str) -> Column:
    return F.aggregate(ops, F.lit(0).cast("long"), lambda a, o: a + F.when(o["op"].isin(*kinds), o["n"]).otherwise(0))


def _clipped(ops: Column) -> Column:
    """Bases clipped, hard and soft, before the first operation of another kind."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(True).alias("open"))
    step = lambda a, o: F.struct((a["n"] + F.when(a["open"] & o["op"].isin("S", "H"), o["n"]).otherwise(0)).alias("n"), (a["open"] & o["op"].isin("S", "H")).alias("open"))
    return F.aggregate(ops, start, step, lambda a: a["n"])


def with_ends(reads: DataFrame) -> DataFrame:
    """Adds end, and five: where the read's first sequenced base would lie were its clipped bases aligned. Null for unaligned reads."""
    d = reads.withColumn("__ops", operations(F.col("cigar")))
    aligned = F.col("chrom").isNotNull() & F.col("pos").isNotNull() & (F.size("__ops") > 0)
    end = F.col("pos") + _summed(F.col("__ops"), "MDN=X")
    first = F.when(F.col("reverse"), end + _clipped(F.reverse("__ops")) - 1).otherwise(F.col("pos") - _clipped(F.col("__ops")))
    return d.withColumns({"end": F.when(aligned, end), "five": F.when(aligned, first)}).drop("__ops")


def quality_sum(qual: Column, least: int = LEAST_QUALITY) -> Column:
    """Sum of a read's base qualities of at least least."""
    values = F.transform(F.split(F.coalesce(qual, F.lit("")), ""), lambda c: F.ascii(c) - 33)
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, q: a + F.when(q >= least, q).otherwise(0))


def marked(reads: DataFrame, library: str | None = None) -> DataFrame:
    """reads with duplicate: whether a better pair or read of the same ends (and library) stands for it.

    Pairs of two aligned reads are compared by both ends and directions, and by the sum of their scores; the least name
    wins ties. A read whose mate is missing or unaligned is a duplicate of any pair that has its end, else it is compared
    with the others of its kind. Unaligned reads, and names of more than two reads, are never duplicates.

    The best of each key comes from a grouped maximum, which tasks take before the shuffle; reads learn of it by their
    name, not by the key, so a key that a third of all reads share stays spread.
    """
    lib = F.coalesce(F.col(library).cast("string"), F.lit("")) if library else F.lit("")
    d = with_ends(reads).withColumns({"__lib": lib, "__score": quality_sum(F.col("qual"))})
    side = F.struct("chrom", "five", "reverse")
    # a read may lack a name: it stands for itself
    named = d.filter("name IS NOT NULL AND five IS NOT NULL")
    t = named.groupBy("name").agg(F.array_sort(F.collect_list(side)).alias("ends"), F.sum("__score").alias("score"), F.min("__lib").alias("lib"), F.count("*").alias("n"))
    t = kept(t.filter("n <= 2").withColumn("ends", F.slice("ends", 1, 2)))
    # the greatest score, and of equals the least name: a minimum of (-score, name)
    least = lambda x: x.groupBy("lib", "ends").agg(F.min(F.struct((-F.col("score")).alias("score"), F.col("name").alias("name"))).alias("best"))
    pairs, single = t.filter("n = 2"), t.filter("n = 1")
    winners = least(pairs).select("best.name")
    paired_ends = pairs.select("lib", F.explode("ends").alias("end")).distinct()
    alone = least(single).select("lib", F.get("ends", F.lit(0)).alias("end"), "best.name").join(paired_ends, ["lib", "end"], "left_anti")
    stay = winners.unionByName(alone.select("name")).withColumn("__stays", F.lit(True))
    known = t.select("name", F.lit(True).alias("__compared")).join(stay, "name", "left")
    out = d.join(known, "name", "left")
    dup = F.col("five").isNotNull() & F.coalesce("__compared", F.lit(False)) & F.col("__stays").isNull()
    return out.select(*reads.columns, dup.alias("duplicate"))


def without_duplicates(reads: DataFrame, library: str | None = None) -> DataFrame:
    """reads without those that marked() finds."""
    return marked(reads, library).filter("NOT duplicate").drop("duplicate")


def metrics(reads: DataFrame) -> DataFrame:
    """Five metrics in one scan of reads (cigar, reverse, seq, qual, chrom, insert): rows of metric, key, n and total.

    quality_by_cycle: key is the cycle (from 1, in the order of sequencing), n bases, total their qualities. quality: key
    is a base quality, n its bases. gc: key is the percentage of G and C among a read's bases, n reads. alignment: key is
    one of the kinds in ALIGNMENT, n their reads or bases. insert_size: key is the size of a pair's insert (positive, so
    each pair counts once), n pairs. Tasks add arrays element by element and send one row for each element.
    """

    def added(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}

        def add(name: str, keys: np.ndarray, by: np.ndarray) -> None:
            if not len(keys):
                return
            counts = np.bincount(keys, by)
            held = sums.get(name, np.zeros(0))
            if len(counts) > len(held):
                held = np.concatenate([held, np.zeros(len(counts) - len(held))])
            held[: len(counts)] += counts
            sums[name] = held

        for pdf in parts:
            quals = [np.frombuffer((q or "").encode(), dtype=np.uint8).astype(np.int64) - 33 for q in pdf["qual"]]
            turned = [q[::-1] if r else q for q, r in zip(quals, pdf["reverse"])]
            flat = np.concatenate([*turned, np.zeros(0, dtype=np.int64)])
            cycle = np.concatenate([*(np.arange(1, len(q) + 1) for q in turned), np.zeros(0, dtype=np.int64)])
            add("quality_by_cycle", cycle, np.ones(len(cycle)))
            add("quality_total", cycle, flat)
            add("quality", flat, np.ones(len(flat)))
            size, gc = pdf["seq"].str.len().fillna(0).to_numpy(dtype=np.int64), pdf["seq"].str.count("[GCgc]").fillna(0).to_numpy(dtype=np.int64)
            add("gc", 100 * gc[size > 0] // size[size > 0], np.ones((size > 0).sum()))
            aligned = pdf["chrom"].notna().to_numpy()
            ops = pdf["cigar"].fillna("")
            bases = lambda kinds: ops.map(lambda c: sum(int(n) for n, o in re.findall(r"(\d+)([MIDNSHP=X])", c) if o in kinds)).to_numpy(dtype=np.int64)
            values = [np.ones(len(pdf)), aligned, aligned & pdf["reverse"].fillna(False).to_numpy(dtype=bool), size, bases("M=X"), bases("I"), bases("D"), bases("SH")]
            add("alignment", np.arange(len(values)), np.array([v.sum() for v in values], dtype=float))
            inserts = pdf["insert"].dropna().to_numpy(dtype=np.int64)
            add("insert_size", inserts[inserts > 0], np.ones((inserts > 0).sum()))
        total = sums.pop("quality_total", None)
        rows = [(name, str(ALIGNMENT[k]) if name == "alignment" else str(k), int(v[k]), int(total[k]) if name == "quality_by_cycle" else None) for name, v in sums.items() for k in np.nonzero(v)[0]]
        yield pd.DataFrame(rows, columns=["metric", "key", "n", "total"]).astype({"total": "Int64"})

    d = reads.select("cigar", "reverse", "seq", "qual", "chrom", "insert").mapInPandas(added, "metric string, key string, n long, total long")
    return d.groupBy("metric", "key").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


ALIGNMENT = ("reads", "aligned", "reverse", "bases", "aligned_bases", "inserted_bases", "deleted_bases", "clipped_bases")


def structured(seq: Column, qual: Column, structure: str) -> dict[str, Column]:
    """Parts of a read by a structure like "3M2S146T": bases of its tags (M, joined by "-"), and of its template (T) with their qualities; S is skipped.

    The last length may be a plus sign, for all that is left. Reads shorter than the lengths before it have null parts.
    """
    found = re.findall(r"(\d+|\+)([MST])", structure)
    if not found or "".join(a + b for a, b in found) != structure or any(n == "+" for n, _ in found[:-1]) or any(n == "0" for n, _ in found) or not any(k == "T" for _, k in found):
        raise ValueError(f"not a read structure: {structure!r}")
    at, pieces = 0, []
    for n, kind in found:
        pieces.append((kind, at, None if n == "+" else int(n)))
        at += 0 if n == "+" else int(n)
    whole = (F.length(seq) >= at) & (F.length(qual) == F.length(seq))
    cut = lambda x, start, n: x.substr(F.lit(start + 1), F.length(x) if n is None else F.lit(n))
    of = lambda x, kind, sep: F.when(whole, F.concat_ws(sep, *[cut(x, s, n) for k, s, n in pieces if k == kind]))
    return {"tag": of(seq, "M", "-"), "template": of(seq, "T", ""), "template_qual": of(qual, "T", "")}


def tag_families(tags: DataFrame, *group: str) -> DataFrame:
    """tags (group, tag, n: reads) with family: the tag that stands for it.

    Tags of one group and length that differ at one place are neighbours. Each tag follows its neighbour of at least twice
    its reads less one, the one of most reads (then the least tag), and so on up; what none exceeds stands for all below.
    Neighbours meet by keys that leave one place out, so no pairs of a group are listed but those that share such a key.
    """
    d = kept(tags.groupBy(*group, "tag").agg(F.sum("n").alias("n")))
    at = F.explode(F.sequence(F.lit(1), F.length("tag")))
    keyed = d.filter(F.length("tag") > 0).select(*group, "tag", "n", at.alias("at"))
    hole = F.concat(F.substring(F.col("tag"), F.lit(1), F.col("at") - 1), F.lit("*"), F.expr("substring(tag, at + 1)"))
    # of a key's tags (as many as letters, at most) only those of most reads can be followed
    keyed = kept(keyed.withColumn("key", hole).drop("at"))
    top = keyed.select(*group, "key", F.col("tag").alias("up"), F.col("n").alias("more"))
    near = keyed.join(top, [*group, "key"]).filter((F.col("tag") != F.col("up")) & (F.col("more") >= 2 * F.col("n") - 1) & ((F.col("more") > F.col("n")) | (F.col("up") < F.col("tag"))))
    first = F.min(F.struct((-F.col("more")).alias("more"), F.col("up").alias("up"))).alias("first")
    follows = kept(near.groupBy(*group, "tag").agg(first).select(*group, "tag", F.col("first.up").alias("up")))
    # each round doubles the way that a tag has gone up
    while True:
        nxt = follows.select(*group, F.col("tag").alias("up"), F.col("up").alias("further"))
        follows = kept(follows.join(nxt, [*group, "up"], "left").select(*group, "tag", F.coalesce("further", "up").alias("up"), F.col("further").isNotNull().alias("moved")))
        if follows.filter("moved").isEmpty():
            break
        follows = follows.drop("moved")
    return d.join(follows.drop("moved"), [*group, "tag"], "left").select(*group, "tag", "n", F.coalesce("up", "tag").alias("family"))


def consensus(reads: DataFrame, *group: str, least: int = 1) -> DataFrame:
    """One read for each group: seq and qual by place, and reads, how many there were (at least least).

    At each place the base of most summed quality wins (of equals the least letter), its quality is the winner's sum less
    the others', 2 to 60. Places are counted before the shuffle: a family of any size is a few counts for each place.
    """
    place = F.posexplode(F.arrays_zip(F.split("seq", "").alias("base"), F.split("qual", "").alias("q"))).alias("place", "x")
    d = reads.filter((F.length("seq") == F.length("qual")) & (F.length("seq") > 0)).select(*group, place)
    votes = d.groupBy(*group, "place", F.col("x.base").alias("base")).agg(F.sum(F.ascii("x.q") - 33).alias("w"), F.count("*").alias("reads"))
    best = F.min(F.struct((-F.col("w")).alias("w"), F.col("base").alias("base"))).alias("best")
    places = votes.groupBy(*group, "place").agg(best, F.sum("w").alias("all"), F.sum("reads").alias("reads"))
    q = F.least(F.greatest(-2 * F.col("best.w") - F.col("all"), F.lit(2)), F.lit(60))
    one = F.struct("place", F.col("best.base").alias("base"), F.char(q + 33).alias("q"), F.col("reads"))
    out = places.groupBy(*group).agg(F.array_sort(F.collect_list(one)).alias("all"))
    out = out.select(*group, F.array_join(F.transform("all", lambda x: x["base"]), "").alias("seq"), F.array_join(F.transform("all", lambda x: x["q"]), "").alias("qual"), F.get("all", F.lit(0))["reads"].alias("reads"))
    return out.filter(F.col("reads") >= least)
