"""Merging of neighbouring variants: native islands, and an ordered fold inside those that may merge."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from operator import add

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .intervals import runs

COLUMNS = "chrom string, pos long, id long, ref string, alt string, after string, qual double, passed boolean, sv boolean, phase string"
Rule = Callable[[dict, dict], bool]


def following(df: DataFrame, chunks: DataFrame, width: int, n: int) -> DataFrame:
    """Adds after: the n reference bases behind each variant, from chunks (chrom, chunk, seq) of a width of n at least."""
    end = F.col("pos") + F.length("ref")
    c = chunks.select("chrom", "chunk", F.upper("seq").alias("seq"))
    d = df.withColumn("chunk", F.floor(end / width)).join(c, ["chrom", "chunk"], "left")
    d = d.join(c.select("chrom", (F.col("chunk") - 1).alias("chunk"), F.col("seq").alias("next")), ["chrom", "chunk"], "left")
    whole = F.concat(F.coalesce("seq", F.lit("")), F.coalesce("next", F.lit("")))
    return d.withColumn("after", whole.substr((end % width + 1).cast("int"), F.lit(n))).drop("seq", "next", "chunk")


def _mergeable(a: dict, b: dict, reach: int, rule: Rule | None) -> bool:
    near = b["pos"] - a["pos"] <= reach + len(a["ref"]) - 1
    same = any(bool(a.get(k)) and a[k] == b[k] for k in ("phase", "ps"))
    return a["passed"] and b["passed"] and not a["sv"] and not b["sv"] and near and same and (rule is None or rule(a, b))


def _joined(chain: list[dict]) -> dict | None:
    """One variant for a chain; None if two members overlap or differ in their number of alleles. A common beginning goes, each allele keeps a base."""
    several = not isinstance(chain[0]["alt"], str)
    each = [list(v["alt"]) if several else [v["alt"]] for v in chain]
    if any(len(x) != len(each[0]) for x in each):
        return None
    ref, alts = chain[0]["ref"], each[0]
    for a, b, more in zip(chain, chain[1:], each[1:]):
        gap = b["pos"] - a["pos"] - len(a["ref"])
        if gap < 0:
            return None
        if gap > len(a["after"] or ""):
            raise ValueError(f"{gap} bases are needed behind {a['chrom']}:{a['pos']}, {len(a['after'] or '')} are given")
        between = (a["after"] or "")[:gap]
        ref, alts = ref + between + b["ref"], [x + between + y for x, y in zip(alts, more)]
    same = 0
    while same < len(ref) - 1 and all(same < len(x) - 1 and x[same] == ref[same] for x in alts):
        same += 1
    quals = [v["qual"] for v in chain]
    alts = [x[same:] for x in alts]
    return chain[0] | {"pos": chain[0]["pos"] + same, "ref": ref[same:], "alt": alts if several else alts[0], "qual": None if any(pd.isna(q) for q in quals) else reduce(add, quals) / len(quals), "members": len(chain), "ids": [v["id"] for v in chain]}


def _stacks(rows: list[dict], reach: int) -> list[list[dict]]:
    """Runs measured from their last passing member; only a passing variant that is no SV opens one."""
    out, stop = [], None
    for v in rows:
        if stop is not None and v["pos"] - stop <= reach:
            out[-1].append(v)
        elif v["passed"] and not v["sv"]:
            out.append([v])
        else:
            stop = None
            continue
        if v["passed"]:
            stop = v["pos"] + len(v["ref"]) - 1
    return out


def merge_neighbours(df: DataFrame, reach: int = 5, rule: Rule | None = None, extra: str = "") -> DataFrame:
    """All variants (COLUMNS) with merged (became part of another), members and ids; merged ones are added with members > 1, and the ids of their members in order.

    extra declares more columns for the rule to see; a merged variant has those of its first member. One named ps is a
    second phase: variants that share it, or the first one, may merge. alt may be an array of alleles.

    Islands are cut where no chain can cross. Only those with two passing variants of one phase go through Python; an
    island spans as many rows as lie within reach of each other.
    """
    columns = f"{COLUMNS}, {extra}" if extra else COLUMNS
    if df.schema["alt"].dataType.typeName() == "array":
        columns = columns.replace("alt string", "alt array<string>")
    names = [c.split()[0] for c in columns.split(", ")]
    d = df.select(*names, F.col("chrom").alias("grp"), F.col("pos").alias("s"), (F.col("pos") + F.length("ref") - 1 + reach).alias("e"))
    d = runs(d, touching_joins=True).drop("grp", "s", "e").withColumnRenamed("run", "island")
    phased = F.coalesce(F.col("phase") != "", F.lit(False)) | (F.coalesce(F.col("ps") != "", F.lit(False)) if "ps" in names else F.lit(False))
    open_ = F.col("passed") & ~F.col("sv") & phased
    counts = Window.partitionBy("chrom", "island")
    d = d.withColumn("able", F.sum(F.coalesce(open_, F.lit(False)).cast("int")).over(counts))
    full = columns + ", merged boolean, members int, ids array<long>"
    added = ["merged", "members", "ids"]

    def fold(rows: list[dict]) -> list[tuple]:
        for v in rows:
            v |= {"merged": False, "members": 1, "ids": [v["id"]]}
        found = []
        for stack in _stacks(rows, reach):
            for i, v in enumerate(stack):
                chain = [v]
                for u in stack[i + 1 :] if v["passed"] and not v["merged"] else []:
                    if u["pos"] - chain[-1]["pos"] > reach + len(chain[-1]["ref"]) - 1:
                        break  # what follows is further off still
                    if not u["merged"] and _mergeable(chain[-1], u, reach, rule):
                        chain.append(u)
                one = _joined(chain) if len(chain) > 1 else None
                if one:
                    found.append(one)
                    for u in chain:
                        u["merged"] = True
        return [tuple(v[n] for n in (*names, *added)) for v in rows + found]

    def folded(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Islands in their order; one that a batch cuts waits for the next."""
        at, rows = None, []
        for pdf in parts:
            out = []
            for v in pdf.to_dict("records"):
                key = (v["chrom"], v["island"])
                if key != at:
                    out += fold(rows)
                    at, rows = key, []
                rows.append(v)
            yield pd.DataFrame(out, columns=[*names, *added])
        yield pd.DataFrame(fold(rows), columns=[*names, *added])

    still = d.filter("able < 2").select(*names, F.lit(False).alias("merged"), F.lit(1).alias("members"), F.array("id").alias("ids"))
    dealt = d.filter("able >= 2").drop("able").repartition("chrom", "island").sortWithinPartitions("chrom", "island", "pos", "id")
    return dealt.mapInPandas(folded, full).unionByName(still)


def member_means(merged: DataFrame, fields: DataFrame, means: list[str], truncated: list[str] = [], else_first: list[str] = []) -> DataFrame:  # noqa: B006
    """chrom, id (of the first member) and the mean over all members for each merged variant.

    fields: chrom, id and the named columns, numbers or arrays of them (mean by element, as many as all members have).
    Null where a member has none, or the first member's value for those in else_first; truncated ones are cut to whole numbers.
    """
    part = merged.filter("members > 1").select("chrom", F.col("id").alias("first"), "members", F.explode("ids").alias("id"))
    j = part.join(fields, ["chrom", "id"], "left")
    shapes = {c: fields.schema[c].dataType.typeName() == "array" for c in [*means, *truncated]}

    def mean(c: str):
        if not shapes[c]:
            out = F.when(F.count(c) == F.first("members"), F.avg(c))
            return (out.cast("long") if c in truncated else out).alias(c)
        held = F.collect_list(c)
        width = F.array_min(F.transform(held, F.size))
        at = F.when(width > 0, F.sequence(F.lit(0), F.greatest(width - 1, F.lit(0)))).otherwise(F.array().cast("array<int>"))
        one = lambda i: F.aggregate(F.transform(held, lambda a: F.get(a, i).cast("double")), F.lit(0.0), lambda s, x: s + x) / F.size(held)
        out = F.transform(at, lambda i: one(i).cast("long") if c in truncated else one(i))
        return F.when(F.size(held) == F.first("members"), out).alias(c)

    def value(c: str):
        own = F.first(F.when(F.col("id") == F.col("first"), F.col(c)), ignorenulls=True)
        return F.coalesce(mean(c), own).alias(c) if c in else_first else mean(c)

    return j.groupBy("chrom", F.col("first").alias("id")).agg(*map(value, shapes))


def with_codons(df: DataFrame, codons: DataFrame) -> DataFrame:
    """Adds codons, the sorted codons (chrom, pos, codon) that a variant covers: its own place, or those after it that a longer ref spans."""
    last = F.col("pos") + F.length("ref") - 1
    places = F.when(F.length("ref") > 1, F.sequence(F.col("pos") + 1, F.greatest(last, F.col("pos") + 1))).otherwise(F.array("pos"))
    hit = df.select("chrom", "id", F.explode(places).alias("pos")).join(codons.select("chrom", "pos", "codon"), ["chrom", "pos"])
    held = hit.groupBy("chrom", "id").agg(F.array_sort(F.collect_set("codon")).alias("codons"))
    return df.join(held, ["chrom", "id"], "left").withColumn("codons", F.coalesce("codons", F.array().cast("array<string>")))


def share_codon(ignore_indels: bool = False) -> Rule:
    """A rule for merge_neighbours with extra "codons array<string>"; indels (any allele longer than a base) may be left out."""

    def rule(a: dict, b: dict) -> bool:
        alleles = lambda v: [v["alt"]] if isinstance(v["alt"], str) else v["alt"]
        long = any(len(x) > 1 for v in (a, b) for x in (v["ref"], *alleles(v)))
        return not (ignore_indels and long) and not set(a["codons"]).isdisjoint(b["codons"])

    return rule
