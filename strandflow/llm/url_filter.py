"""URL filters: sort-merge range join of urls with nested host rules.

A host's labels are reversed into a canonical key ("a.example.com" becomes
"com.example.a."), so that a rule's host and all its subdomains are the keys with one
prefix, an interval. Sampled splitters cut the keys (with the row's own hash behind
them, so that one hot host is cut too) into buckets; a rule goes to each bucket that its
interval meets. Within a bucket, sorted by key, one sweep keeps the stack of rules whose
interval holds the current key; the longest rule whose path also fits wins.

Defined results: a null url, or one without "://", has an empty host and path and meets
no rule; such rows get the default verdict. Rows are judged one by one, so repeated rows
and null ids stay; among equal rules allow wins; an empty table gives an empty table.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows that a bucket holds on average, and sampled keys for each bucket.
BUCKET_ROWS = 100_000
SAMPLES = 32
MAX_BUCKETS = 8192

#: Fixed values: (verdict, host, path) of the contract.
RULES = (
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def reversed_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def _upper(prefix: str) -> str:
    """The least string above all that begin with prefix, which ends with a full stop."""
    return prefix[:-1] + "/"


def rule_frame(spark: SparkSession, rules: Iterable[tuple[str, str, str]] = RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "verdict string, host string, path string")


def splitters(keys: DataFrame, seed: int = 7) -> list[tuple[str, int]]:
    """Cut points of (key, tie): at most MAX_BUCKETS - 1, from SAMPLES sampled rows for each."""
    total = keys.count()
    n = min(MAX_BUCKETS, max(keys.sparkSession.sparkContext.defaultParallelism * 4, total // BUCKET_ROWS))
    fraction = min(1.0, n * SAMPLES / max(total, 1))
    found = sorted(tuple(r) for r in keys.sample(fraction, seed).limit(2 * n * SAMPLES).collect())
    return list(dict.fromkeys(found[i * len(found) // n] for i in range(1, n) if found))


def _sweep(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    bucket, stack = None, []
    for pdf in parts:
        out = []
        for b, key, kind, row, host, path, verdict in zip(*(pdf[c] for c in ("bucket", "key", "kind", "row", "host", "path", "verdict"))):
            if b != bucket:
                bucket, stack = b, []
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if kind == 0:
                if not stack or stack[-1][0] != key:
                    stack.append((key, {}))
                old = stack[-1][1].get(path)
                if old is None or verdict == "allow":
                    stack[-1][1][path] = (len(host) + len(path), len(host), host + path, verdict)
                continue
            best = None
            for _, by_path in reversed(stack):
                for n in {len(p) for p in by_path if len(p) <= len(path)}:
                    hit = by_path.get(path[:n])
                    if hit and (best is None or hit[:2] > best[:2]):
                        best = hit
            out.append((row, host, path, best[2] if best else None, best[3] if best else None))
        yield pd.DataFrame(out, columns=["row", "host", "path", "rule", "verdict"])


def url_filter(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """page_id, host, path, rule (null: none) and verdict of each row."""
    host, path = host_and_path(F.col("url"))
    urls = pages.select(F.col("page_id").alias("row"), host.alias("host"), path.alias("path")).withColumns(
        {"key": reversed_key(F.col("host")), "tie": F.xxhash64("row", "path")}
    )
    cuts = splitters(urls.select("key", "tie"))

    @F.pandas_udf("int")
    def bucket_of(key: pd.Series, tie: pd.Series) -> pd.Series:
        return pd.Series([bisect.bisect_right(cuts, x) for x in zip(key, tie)], dtype="int32")

    @F.pandas_udf("array<int>")
    def buckets_of(key: pd.Series) -> pd.Series:
        low = -(1 << 63)
        return pd.Series([list(range(bisect.bisect_left(cuts, (k, low)), bisect.bisect_right(cuts, (_upper(k), low)) + 1)) for k in key])

    held = rules.select("verdict", F.lower("host").alias("host"), F.coalesce("path", F.lit("")).alias("path")).filter("host IS NOT NULL")
    held = held.withColumn("key", reversed_key(F.col("host")))
    id_type = urls.schema["row"].dataType
    left = held.select(F.explode(buckets_of("key")).alias("bucket"), "key", F.lit(0).alias("kind"), F.lit(None).cast(id_type).alias("row"), "host", "path", "verdict")
    right = urls.select(bucket_of("key", "tie").alias("bucket"), "key", F.lit(1).alias("kind"), "row", "host", "path", F.lit(None).cast("string").alias("verdict"))
    dealt = left.unionByName(right).repartition(len(cuts) + 1, "bucket").sortWithinPartitions("bucket", "key", "kind")
    swept = dealt.mapInPandas(_sweep, f"row {id_type.simpleString()}, host string, path string, rule string, verdict string")
    return swept.select(F.col("row").alias("page_id"), "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))


def oracle() -> str:
    """DuckDB SQL for url_filter(pages, RULES)."""
    values = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)
    return f"""
    WITH u AS (SELECT row_number() OVER () AS n, page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages),
    p AS (SELECT n, page_id,
        coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
        coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM u),
    r(v, h, q) AS (VALUES {values}),
    j AS (SELECT p.n, h || q AS rule, v, row_number() OVER (PARTITION BY p.n ORDER BY length(h || q) DESC, length(h) DESC, v) AS k
          FROM p JOIN r ON (p.host = h OR ends_with(p.host, '.' || h)) AND starts_with(p.path, q))
    SELECT p.page_id, p.host, p.path, j.rule, coalesce(j.v, 'allow') AS verdict FROM p LEFT JOIN j ON p.n = j.n AND j.k = 1"""
