"""Ordered steps over groups of any size: rows ranged by (grp, order), and what each range hands to the next.

A group is cut into ranges of about equal numbers of rows, however its positions lie, so a hot group, and a hot position
in it, is spread over tasks. What ranges pass on is one row for each group and range.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import kept


def by_rows(df: DataFrame, *order: str) -> DataFrame:
    """df (grp, ...) as a written table with part, the number of a row's range, and tie, which orders rows alike in order.

    Ranges are those of a sample that Spark draws, as many as shuffles have partitions. They are written down with the
    rows: a task that is run again cannot put a row into another range.
    """
    hashed = [c for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind]
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    d = df.withColumn("tie", F.xxhash64(*hashed)).repartitionByRange(n, "grp", *order, "tie")
    return kept(d.withColumn("part", F.spark_partition_id()))


def inside(*order: str) -> Window:
    """The window of one range of a group, in order."""
    return Window.partitionBy("grp", "part").orderBy(*order, "tie")


def upto(*order: str):
    return inside(*order).rowsBetween(Window.unboundedPreceding, 0)


def before(*order: str):
    return inside(*order).rowsBetween(Window.unboundedPreceding, -1)


def passed_on(df: DataFrame, later: bool = False, **values: tuple[Callable[[Column], Column], Callable[[Column], Column], Column]) -> DataFrame:
    """df with what the earlier (or later) ranges of a row's group amount to: name = (fold of a range's rows, fold over ranges, value)."""
    each = df.groupBy("grp", "part").agg(*[own(value).alias(name) for name, (own, _, value) in values.items()])
    w = Window.partitionBy("grp").orderBy("part")
    w = w.rowsBetween(1, Window.unboundedFollowing) if later else w.rowsBetween(Window.unboundedPreceding, -1)
    carried = each.select("grp", "part", *[over(F.col(name)).over(w).alias(name) for name, (_, over, _) in values.items()])
    return df.join(carried, ["grp", "part"], "left")
