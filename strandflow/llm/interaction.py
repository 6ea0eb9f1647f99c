"""Audit of how filters interact: what each order of five filters removes, and what a filter removes that others would too.

Each document becomes a mask of the filters that it fails. Documents are counted by part
and mask; every such cell is folded over the array of all orders by higher-order functions
into one struct for each order and step, weighted by the cell's counts. The arrays of a part
are then added element by element. Words are counted inside the row; only digests and
masks are shuffled.

Texts are compared for equality by their SHA-256. Copies are told from the first of them
without a join: rows are grouped by digest and by part and labels, so a text that a third
of all rows repeat is reduced before it is shuffled.

Defined results: a null text is empty, a null lang is the part "" like an empty one; a null
doc_id is never a copy and none of it; rows that repeat a text's smallest doc_id are not
copies. Several labels of one doc_id count once, each as its greatest; null or missing
labels are not 1. An empty table gives an empty table. Extra columns are not looked at.
"""

from __future__ import annotations

from functools import reduce
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import words

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def failures() -> list[Column]:
    """Whether a row fails A to D; words, its words, must be a column."""
    text, n = F.coalesce(F.col("text"), F.lit("")), F.size("words")
    return [
        n < 100,
        100 * F.size(F.array_distinct("words")) < 80 * n,
        100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")) > 10 * F.length(text),
        text.rlike("[#$%&*|]"),
    ]


def judged(docs: DataFrame) -> DataFrame:
    """part, doc_id, digest and mask (bit 0 for A) of A to D."""
    d = docs.select(F.coalesce("lang", F.lit("")).alias("part"), "doc_id", "text", words(F.col("text")).alias("words"))
    mask = reduce(lambda a, b: a + b, [F.when(f, 1 << i).otherwise(0) for i, f in enumerate(failures())])
    return d.select("part", "doc_id", F.unhex(F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)).alias("digest"), mask.alias("mask"))


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask (all filters), n, good and toxic."""
    marks = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(*[F.max(F.when(F.col(c) == 1, 1).otherwise(0)).alias(c) for c in ("quality", "toxic")])
    # rows without doc_id have no labels; a key of their own keeps them apart
    known = F.col("doc_id").isNotNull()
    d = judged(docs).withColumns({"known": known, "key": F.when(known, F.col("doc_id").cast("long")).otherwise(F.xxhash64("digest"))})
    d = d.join(marks.select(F.col("doc_id").cast("long").alias("key"), "quality", "toxic", F.lit(True).alias("known")), ["key", "known"], "left")
    by = ["digest", "part", "mask", "good", "toxic"]
    d = d.select("digest", "part", "mask", "doc_id", F.coalesce("quality", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))
    same = d.groupBy(*by, "doc_id").agg(F.count("*").alias("rows"))
    first = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "rows"))).alias("first")
    groups = same.groupBy(*by).agg(F.sum("rows").alias("rows"), first, F.coalesce(F.sum(F.when(F.col("doc_id").isNull(), F.col("rows"))), F.lit(0)).alias("without"))
    # a digest has a row for each part and label at most
    least = F.min("first.doc_id").over(Window.partitionBy("digest"))
    originals = F.col("without") + F.when(F.col("first.doc_id") == least, F.col("first.rows")).otherwise(0)
    groups = groups.withColumn("originals", originals)
    split = F.explode(F.array(F.struct("mask", F.col("originals").alias("n")), F.struct((F.col("mask") + 16).alias("mask"), (F.col("rows") - F.col("originals")).alias("n")))).alias("x")
    d = groups.select("part", "good", "toxic", split).filter("x.n > 0")
    return d.groupBy("part", F.col("x.mask").alias("mask")).agg(F.sum("x.n").alias("n"), F.sum(F.col("x.n") * F.col("good")).alias("good"), F.sum(F.col("x.n") * F.col("toxic")).alias("toxic"))


def steps(cell: Column, orders: Column) -> Column:
    """One struct of COUNTS for each order and step, for a cell of equal masks."""
    mask = cell["mask"]
    fails = lambda f: mask.bitwiseAND(f) != 0
    weigh = lambda hit, weight: F.when(hit, weight).otherwise(F.lit(0).cast("long"))

    def step(state: Column, bit: Column) -> Column:
        gone, failing = state["gone"], fails(bit)
        here = failing & ~gone
        made = F.struct(
            weigh(~gone & ~failing, cell["n"]).alias("kept"), weigh(here, cell["n"]).alias("removed"), weigh(failing & gone, cell["n"]).alias("redundant"),
            weigh(mask == bit, cell["n"]).alias("unique_fails"), weigh(here, cell["good"]).alias("good_lost"), weigh(here, cell["toxic"]).alias("toxic_lost"),
        )
        return F.struct((gone | failing).alias("gone"), F.concat(state["out"], F.array(made)).alias("out"))

    none = F.array().cast(f"array<struct<{','.join(f'{c}:bigint' for c in COUNTS)}>>")
    start = F.struct(F.lit(False).alias("gone"), none.alias("out"))
    return F.flatten(F.transform(orders, lambda bits: F.aggregate(bits, start, step, lambda s: s["out"])))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step, COUNTS and shapley: 600 rows for each part."""
    orders = F.lit([[1 << FILTERS.index(c) for c in o] for o in ORDERS])  # one constant, sent along with each task's plan
    total = lambda a, b: F.zip_with(a, b, lambda x, y: F.struct(*[(x[c] + y[c]).alias(c) for c in COUNTS]))
    # a part has 32 cells at most
    folded = cells(docs, labels).select("part", steps(F.struct("mask", "n", "good", "toxic"), orders).alias("steps"))
    zeros = F.array_repeat(F.struct(*[F.lit(0).cast("long").alias(c) for c in COUNTS]), len(ORDERS) * len(FILTERS))
    parts = folded.groupBy("part").agg(F.collect_list("steps").alias("all"))
    parts = parts.select("part", F.aggregate("all", zeros, total).alias("sums"))
    rows = parts.select("part", F.posexplode("sums").alias("at", "x"))
    at, size = F.col("at"), F.lit(len(FILTERS))
    name = F.get(F.lit(ORDERS), F.floor(at / size).cast("int"))
    rows = rows.select("part", name.alias("filter_order"), (at % size + 1).cast("int").alias("step"), *[F.col(f"x.{c}").alias(c) for c in COUNTS])
    own = Window.partitionBy("part", F.substring("filter_order", F.col("step"), F.lit(1)))
    return rows.withColumn("shapley", F.sum("removed").over(own))


def oracle() -> str:
    """DuckDB SQL: every order applied to every document."""
    letters = ", ".join(f"('{c}')" for c in FILTERS)
    fails = "CASE substr(o.filter_order, j, 1) WHEN 'A' THEN a WHEN 'B' THEN b WHEN 'C' THEN c WHEN 'D' THEN d ELSE e END"
    return rf"""
    WITH l AS (SELECT * FROM (VALUES {letters}) x(f)),
    o AS (SELECT p.f || q.f || r.f || s.f || t.f AS filter_order FROM l p, l q, l r, l s, l t WHERE len(list_distinct([p.f, q.f, r.f, s.f, t.f])) = 5),
    w AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
    m AS (SELECT part, doc_id, len(ws) < 100 AS a, 100 * len(list_distinct(ws)) < 80 * len(ws) AS b, 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) AS c,
      regexp_matches(t, '[#$%&*|]') AS d, coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS e FROM w),
    g AS (SELECT m.*, a::INT + b::INT + c::INT + d::INT + e::INT AS k, (coalesce(x.quality, 0) = 1)::INT AS good, (coalesce(x.toxic, 0) = 1)::INT AS toxic FROM m LEFT JOIN labels x USING (doc_id)),
    s AS (SELECT part, filter_order, j AS step, substr(filter_order, j, 1) AS f, g.k, good, toxic, {fails} AS failing,
      list_bool_or(list_transform(range(1, j), lambda i: CASE substr(o.filter_order, i, 1) WHEN 'A' THEN a WHEN 'B' THEN b WHEN 'C' THEN c WHEN 'D' THEN d ELSE e END)) IS TRUE AS gone
      FROM g, o, (SELECT unnest(range(1, 6)) AS j)),
    n AS (SELECT part, filter_order, step::INT AS step, f, count(*) FILTER (NOT failing AND NOT gone) AS kept, count(*) FILTER (failing AND NOT gone) AS removed, count(*) FILTER (failing AND gone) AS redundant,
      count(*) FILTER (failing AND k = 1) AS unique_fails, count(*) FILTER (failing AND NOT gone AND good = 1) AS good_lost, count(*) FILTER (failing AND NOT gone AND toxic = 1) AS toxic_lost FROM s GROUP BY ALL)
    SELECT * EXCLUDE (f), (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley FROM n"""
