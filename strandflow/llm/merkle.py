"""Merkle manifest of a table of documents, and proofs that climb it.

Leaves are numbered within their source by range partitions: rows are sorted into ranges of
(source, doc_id), numbered inside each range, and moved on by a small table of counts, so
that a source of any size is spread over many tasks. Levels are built one after the other,
each a grouping of three neighbours, and written as rows that name a node by (source,
level, slot) and hold its siblings; its parent is slot // 3 of the next level. Spark's
recursive query then ascends from every leaf: each step joins the rows of the level,
appends a row of the siblings met and folds them around the hash that started as the
tampered leaf. A leaf's rows, in order of levels, are its proof.

From level BLOCK_LEVEL on, and in the tree over sources, a node's row is written once for
each block of 3 ** BLOCK_LEVEL leaves below it and the slot is the block: no key of the
climb's joins meets more leaves than that. The climb runs in three queries, so that
no step reads the many nodes of levels far below it.

Defined results: the leaf of a null field is "-"; null sources come first, then sources by
bytes; leaves with equal doc_id of one source are ordered by their hash, null doc_ids come
first and are never tampered; equal rows are leaves of their own with equal hashes. A lone
leaf is its source's root, a lone source's root is the root, without siblings the proof is
the hash of nothing. An empty table gives an empty table. Extra columns are not looked at.
"""

from __future__ import annotations

from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import keep

ARITY = 3
BLOCK_LEVEL = 7
#: The lowest levels have most nodes; a recursive query of their own climbs them, as each step reads all nodes of its query.
WIDE_LEVELS = 2
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def hashed(digests: Column) -> Column:
    """sha256 (binary) of digests (binary, side by side) written as lower-case hex."""
    return F.unhex(F.sha2(F.lower(F.hex(digests)).cast("binary"), 256))


def leaf(text: Column) -> Column:
    """sha256 (binary) of a row's fields, with text in place of its own."""
    values = [text if c == "text" else F.col(c).cast("string") for c in FIELDS]
    sized = [F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in values]
    return F.unhex(F.sha2(F.concat(*sized).cast("binary"), 256))


def tampered_text() -> Column:
    """The text without line feeds where 2 divides the crc32 of the decimal doc_id, else as it is."""
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False))
    return F.when(hit, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))


def depth(n: int, arity: int = ARITY) -> int:
    """Levels above n nodes until one remains."""
    steps = 0
    while n > 1:
        n, steps = -(-n // arity), steps + 1
    return steps


def depth_of(n: Column) -> Column:
    """depth() of a column, without rounding errors of logarithms."""
    return sum((F.when(n > ARITY**j, 1).otherwise(0) for j in range(40)), F.lit(0))


def numbered(docs: DataFrame) -> DataFrame:
    """One row per document: k (its source's place), n (leaves of the source), i (its place there), doc_id, leaf, tampered."""
    src = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("")).alias("src")
    rows = keep(docs.select(src, "doc_id", leaf(F.col("text")).alias("leaf"), leaf(tampered_text()).alias("tampered")), "merkle-hashes")
    # the range of a row is written down, so that a lost task cannot put it into another one
    rows = keep(rows.repartitionByRange("src", "doc_id", "leaf").withColumn("part", F.spark_partition_id()), "merkle-ranges")
    counts = keep(rows.groupBy("part", "src").count(), "merkle-counts")
    earlier = Window.partitionBy("src").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sources = counts.groupBy("src").agg(F.min("part").alias("part"), F.sum("count").alias("n"))
    # one row per range: sources that begin in earlier ranges
    begun = sources.groupBy("part").count().select("part", F.coalesce(F.sum("count").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    places = sources.join(begun, "part").select("src", "n", (F.col("base") + F.row_number().over(Window.partitionBy("part").orderBy("src")) - 1).alias("k"))
    offsets = counts.withColumn("offset", F.coalesce(F.sum("count").over(earlier), F.lit(0))).join(places, "src").drop("count")
    within = F.row_number().over(Window.partitionBy("part", "src").orderBy("doc_id", "leaf")) - 1
    d = rows.withColumn("within", within).join(offsets, ["part", "src"])
    return keep(d.select("k", "n", (F.col("within") + F.col("offset")).alias("i"), "doc_id", "leaf", "tampered"), "merkle-leaves")


def levels(leaves: DataFrame, most: int) -> tuple[DataFrame | None, DataFrame]:
    """leaves: k, n, i, digest; most: the largest n. Rows of all nodes that have a parent (k, n, lev, i, before, after), and the roots (k, n, digest)."""
    current = leaves.select("k", "n", "i", "digest", F.col("n").alias("left"))
    rows, roots = [], []
    for lev in range(depth(most)):
        roots.append(current.filter("left = 1").select("k", "n", "digest"))
        kids = F.array_sort(F.collect_list(F.struct("i", "digest")))
        runs = current.filter("left > 1").groupBy("k", "n", "left", F.floor(F.col("i") / ARITY).alias("up")).agg(kids.alias("kids"))
        whole = lambda x: F.aggregate(x, F.lit(b""), lambda a, y: F.concat(a, y["digest"]))
        runs = runs.withColumn("made", hashed(whole("kids")))
        nodes = runs.select("k", "n", "left", "up", "made", "kids", F.posexplode("kids").alias("pos", "kid"))
        nodes = nodes.select(
            "k", "n", "left", "up", "made", F.lit(lev).alias("lev"), F.col("kid.i").alias("i"),
            whole(F.slice("kids", 1, F.col("pos"))).alias("before"), whole(F.slice("kids", F.col("pos") + 2, ARITY)).alias("after"),
        )
        nodes = keep(nodes, f"merkle-level{lev}")
        rows.append(nodes.select("k", "n", "lev", "i", "before", "after"))
        current = nodes.filter("pmod(i, 3) = 0").select("k", "n", F.col("up").alias("i"), F.col("made").alias("digest"), (F.ceil(F.col("left") / ARITY)).alias("left"))
    roots.append(current.filter("left = 1").select("k", "n", "digest"))
    union = lambda x: reduce(lambda a, b: a.unionByName(b), x)
    return (union(rows) if rows else None), union(roots)


def blocks_of(n: Column) -> Column:
    return F.ceil(n / ARITY**BLOCK_LEVEL)


def spread(nodes: DataFrame) -> DataFrame:
    """Node rows of a tree by slot: below BLOCK_LEVEL the node's place, from there on one row for each block of leaves below it."""
    low = nodes.filter(F.col("lev") < BLOCK_LEVEL).withColumn("slot", F.col("i"))
    high = nodes.filter(F.col("lev") >= BLOCK_LEVEL)
    width = F.expr(f"CAST(power({ARITY}, lev - {BLOCK_LEVEL}) AS BIGINT)")
    last = F.least((F.col("i") + 1) * width, blocks_of(F.col("n"))) - 1
    return low.unionByName(high.withColumn("slot", F.explode(F.sequence(F.col("i") * width, last))))


@contextmanager
def unlimited_recursion(spark: SparkSession):
    """Spark stops recursive queries at a million rows unless told otherwise; the session's own setting comes back."""
    key = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "-1")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


CLIMB = """
WITH RECURSIVE climb(k, i, lev, stop, siblings, folded) AS (
  SELECT k, i, lev, stop, CAST(NULL AS BINARY), folded FROM {start}
  UNION ALL
  SELECT c.k, c.i, c.lev + 1, c.stop, concat(n.before, n.after), unhex(sha2(CAST(lower(hex(concat(n.before, c.folded, n.after))) AS BINARY), 256))
  FROM climb c JOIN {nodes} n ON c.k = n.k AND c.lev = n.lev AND c.i DIV CAST(power({arity}, least(c.lev, {low})) AS BIGINT) = n.slot
  WHERE c.lev < c.stop)
SELECT k, i, lev, siblings, CASE WHEN lev = stop THEN folded END AS folded FROM climb"""


def climbed(start: DataFrame, nodes: DataFrame) -> DataFrame:
    """A row for each leaf of start (k, i, lev, stop, folded) and level up to its stop: the siblings met below it; the last one has the hash folded so far."""
    spark = start.sparkSession
    with unlimited_recursion(spark):
        return keep(spark.sql(CLIMB, start=start, nodes=nodes, low=BLOCK_LEVEL, arity=ARITY), "merkle-climb")


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof (binary digests, level by level) and folded_root of each document."""
    spark = docs.sparkSession
    leaves = numbered(docs)
    most = leaves.agg(F.max("n"), F.max("k")).first()
    trees, subroots = levels(leaves.select("k", "n", "i", F.col("leaf").alias("digest")), most[0] or 0)
    subroots = keep(subroots, "merkle-subroots")
    count = 0 if most[1] is None else most[1] + 1
    over, root = levels(subroots.select(F.lit(-1).cast("long").alias("k"), F.lit(count).cast("long").alias("n"), F.col("k").alias("i"), "digest"), count)
    empty = spark.createDataFrame([], "k long, n long, lev int, i long, before binary, after binary")
    trees, over, tops = spread(empty if trees is None else trees), spread(empty if over is None else over), depth(count)
    nodes = ["k", "lev", "slot", "before", "after"]
    # each source's way through the tree over sources, once for each block of its leaves
    way = subroots.select("k", "n", F.explode(F.sequence(F.lit(0), F.lit(tops - 1)) if tops else F.array().cast("array<int>")).alias("t"))
    way = way.withColumn("at", F.floor(F.col("k") / F.expr(f"CAST(power({ARITY}, least(t, {BLOCK_LEVEL})) AS BIGINT)")))
    way = way.join(over.select(F.col("lev").alias("t"), F.col("slot").alias("at"), "before", "after"), ["t", "at"])
    way = way.select("k", (depth_of(F.col("n")) + F.col("t")).alias("lev"), F.explode(F.sequence(F.lit(0).cast("long"), blocks_of(F.col("n")) - 1)).alias("slot"), "before", "after")
    top = root.select("digest").first()
    blocks = F.explode(F.sequence(F.lit(0).cast("long"), blocks_of(F.col("n")) - 1)).alias("block")
    ends = keep(subroots.select("k", blocks, F.col("digest").alias("subroot"), F.lit(top and bytes(top[0])).cast("binary").alias("root")), "merkle-ends")
    own, height = F.least(depth_of(F.col("n")), F.lit(BLOCK_LEVEL)), depth_of(F.col("n")) + tops
    heights = leaves.select("k", "i", "n")
    rows, done = [], leaves.select("k", "i", "n", F.col("tampered").alias("folded"))
    wide = min(WIDE_LEVELS, BLOCK_LEVEL)
    for low, high in ((0, wide), (wide, BLOCK_LEVEL), (BLOCK_LEVEL, None)):
        if low == high:
            continue
        if high is None:
            stop, there = height, trees.filter(F.col("lev") >= BLOCK_LEVEL).select(*nodes).unionByName(way.select(*nodes))
        else:
            stop, there = F.least(own, F.lit(high)), trees.filter(F.col("lev").between(low, high - 1)).select(*nodes)
        start = done.select("k", "i", F.least(own, F.lit(low)).alias("lev"), stop.alias("stop"), "folded")
        rows.append(climbed(start, keep(there, "merkle-nodes")))
        done = rows[-1].filter("folded IS NOT NULL").select("k", "i", "folded").join(heights, ["k", "i"])
    block = F.floor(F.col("i") / ARITY**BLOCK_LEVEL).alias("block")
    about = leaves.select("k", "i", "doc_id", "leaf", block).join(ends, ["k", "block"]).select("k", "i", "doc_id", "leaf", "subroot", "root")
    steps = [r.select("k", "i", "lev", "siblings", (F.col("folded") if r is rows[-1] else F.lit(None).cast("binary")).alias("folded")).filter("siblings IS NOT NULL OR folded IS NOT NULL") for r in rows]
    met = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [about, *steps]).groupBy("k", "i")
    path = F.array_sort(F.collect_list(F.when(F.col("siblings").isNotNull(), F.struct("lev", "siblings"))))
    made = met.agg(*[F.max(c).alias(c) for c in ("doc_id", "leaf", "subroot", "root")], F.max("folded").alias("folded_root"), path.alias("path"))
    return made.select("doc_id", "leaf", "subroot", "root", F.aggregate("path", F.lit(b""), lambda a, x: F.concat(a, x["siblings"])).alias("proof"), "folded_root")


def verified(made: DataFrame) -> DataFrame:
    """The manifest in hex, proofs as their hash, and whether the climb met the root."""
    text = lambda c: F.lower(F.hex(c)).alias(c)
    return made.select("doc_id", text("leaf"), text("subroot"), text("root"), F.lower(F.hex(hashed(F.col("proof")))).alias("proof_sha256"), text("folded_root"), (F.col("folded_root") == F.col("root")).alias("verified"))


def oracle() -> str:
    """DuckDB SQL: crc32 bit by bit, levels and folds as recursive queries over documents (unique doc_id)."""
    sized = lambda c, v: f"coalesce(strlen({v})::VARCHAR || ':' || {v}, '-')"
    h = lambda text: "sha256(" + " || ".join(sized(c, text if c == "text" else f"{c}::VARCHAR") for c in FIELDS) + ")"
    crc = "list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda p: ascii(substr(doc_id::VARCHAR, p, 1))::BIGINT)), lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda c, s: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END))"
    up = "SELECT k, lev + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM {0} WHERE n > 1 GROUP BY k, lev, i // 3, n"
    return f"""
    WITH RECURSIVE c AS (SELECT *, xor({crc}, 4294967295) AS crc FROM documents),
    d AS (SELECT doc_id, dense_rank() OVER (ORDER BY source IS NOT NULL, encode(source)) - 1 AS k, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS i, count(*) OVER (PARTITION BY source) AS n,
      {h('text')} AS leaf, {h("(CASE WHEN crc % 2 = 0 THEN replace(text, chr(10), '') ELSE text END)")} AS bad FROM c),
    t(k, lev, i, n, h) AS (SELECT k, 0, i, n, leaf FROM d UNION ALL {up.format('t')}),
    s AS (SELECT k, lev AS own, h AS subroot FROM t WHERE n = 1),
    u(k, lev, i, n, h) AS (SELECT -1, 0, k, count(*) OVER (), subroot FROM s UNION ALL {up.format('u')}),
    r AS (SELECT h AS root, lev AS tops FROM u WHERE n = 1),
    w AS (SELECT k, lev, i, h, n FROM t WHERE n > 1 UNION ALL SELECT s.k, s.own + u.lev, u.i, u.h, -1 FROM s JOIN u ON u.n > 1),
    f(doc_id, k, lev, own, i, proof, folded) AS (
      SELECT doc_id, d.k, 0, s.own, CASE WHEN s.own = 0 THEN d.k ELSE d.i END, '', bad FROM d JOIN s USING (k)
      UNION ALL
      SELECT f.doc_id, f.k, f.lev + 1, f.own, CASE WHEN f.lev + 1 = f.own THEN f.k ELSE f.i // 3 END,
        f.proof || string_agg(CASE WHEN w.i = f.i THEN '' ELSE w.h END, '' ORDER BY w.i), sha256(string_agg(CASE WHEN w.i = f.i THEN f.folded ELSE w.h END, '' ORDER BY w.i))
      FROM f JOIN w ON w.k = f.k AND w.lev = f.lev AND w.i // 3 = f.i // 3 GROUP BY f.doc_id, f.k, f.lev, f.own, f.i, f.proof, f.folded)
    SELECT d.doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
    FROM d JOIN s USING (k) CROSS JOIN r JOIN f ON f.doc_id = d.doc_id AND f.lev = s.own + r.tops"""
