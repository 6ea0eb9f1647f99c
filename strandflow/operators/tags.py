"""Rule tags: predicates declared with their parameters, compiled into one array column."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Rule = tuple[str, tuple[str, ...], Callable[..., Column]]


def tags(rules: list[Rule], params: dict[str, float | Column | None]) -> Column:
    """Sorted tags of the rules that hold; a rule takes part if all its parameters are set, a missing value never tags.

    A parameter may be a column: where it is null, its rules take no part.
    """
    active = sorted((r for r in rules if all(params.get(p) is not None for p in r[1])), key=lambda r: r[0])
    found = [F.when(F.coalesce(f(*[params[p] if isinstance(params[p], Column) else F.lit(params[p]) for p in needs]), F.lit(False)), F.lit(name)) for name, needs, f in active]
    return F.array_except(F.array(*found), F.array(F.lit(None).cast("string"))) if found else F.array().cast("array<string>")


def merged(old: Column, new: Column, clear: str | list[str] = "none") -> Column:
    """old tags without the cleared ones (always without PASS), united with new; PASS if none is left."""
    base = F.array().cast("array<string>") if clear == "all" else F.array_except(old, F.array(*map(F.lit, ["PASS", *(clear if isinstance(clear, list) else [])])))
    out = F.sort_array(F.array_union(base, new))
    return F.when(F.size(out) == 0, F.array(F.lit("PASS"))).otherwise(out)


def tagged(df: DataFrame, rules: list[Rule], params: dict[str, float | None], column: str = "filter", clear: str | list[str] = "none") -> DataFrame:
    return df.withColumn(column, merged(F.coalesce(F.col(column), F.array().cast("array<string>")), tags(rules, params), clear))


def header(old: DataFrame, active: DataFrame, cleared: list[str]) -> DataFrame:
    """Declared tags (id, description) after a run: the cleared ones go, the active ones are added or replace theirs."""
    stay = old.filter(~F.col("id").isin(cleared)) if cleared else old
    return stay.join(active.select("id"), "id", "left_anti").unionByName(active).dropDuplicates(["id"])
