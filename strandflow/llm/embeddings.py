"""Embedding near-dedup: int8 tile products with rigorous error bounds.

Equal vectors are one class with a multiplicity. Classes are dealt into stripes; each pair
of stripes is one cell, whose task multiplies quantised tiles. A unit vector x is stored as
s*q + e with q in int8 and |e| known, so that for two vectors
|<x,y> - s_x s_y <q_x,q_y>| <= |s_x q_x| |e_y| + |e_x| |s_y q_y| + |e_x| |e_y|.
Only pairs whose upper bound reaches the threshold are computed again in double
precision. A cell returns, for each of its vectors with a link, the linked multiplicity
and the least vector that its links within the cell reach: never the pairs. Components of
those edges follow.

Stripes are parts of the neighbourhoods of pivots: at most PIVOTS vectors, chosen by hash.
A vector is sent only to stripes of pivots that its angle to the pivot, less the widest
angle within that neighbourhood, does not put beyond the threshold's angle (the triangle
inequality of angles, with some slack for rounding), so that clustered vectors meet few
stripes. Vectors without clusters meet all: the number of cells then grows with the square
of the stripes. Vectors travel as packed bytes of their own precision; a stripe's size
(STRIPE_ROWS, fewer where vectors are long) bounds the memory of a task.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components link with nothing; vectors of different lengths never link; equal vectors all
link with each other; vectors are scaled by their largest component first, so that very
large and very small ones have a direction too; null ids count as vectors but never name a
component that has an id; kept is false for them; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep
from .graph import connected_components

THRESHOLD = 0.9
STRIPE_ROWS = 16_384
STRIPE_BYTES = 32 << 20
PIVOTS = 256
BLOCK_ROWS = 256


class Union:
    """Labels of nodes, lowered together until linked nodes share the least."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            ra, rb = self.up[a], self.up[b]
            differ = ra != rb
            a, b, ra, rb = a[differ], b[differ], ra[differ], rb[differ]
            np.minimum.at(self.up, np.maximum(ra, rb), np.minimum(ra, rb))
            while (self.up[self.up] != self.up).any():
                self.up = self.up[self.up]


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scales, norms of the quantised vectors and of their errors, for unit rows."""
    scale = np.abs(x).max(axis=1) / 127
    q = np.rint(x / scale[:, None]).astype(np.int8)
    near = q * scale[:, None]
    return q, scale, np.linalg.norm(near, axis=1), np.linalg.norm(x - near, axis=1)


def exact_products(q: np.ndarray, p: np.ndarray) -> np.ndarray:
    """q @ p.T in integers: float32 products are exact as long as sums stay below 2**24."""
    width, out = (1 << 24) // (127 * 127), 0
    for at in range(0, q.shape[1], width):
        out = out + (q[:, at : at + width].astype(np.float32) @ p[:, at : at + width].astype(np.float32).T).astype(np.float64)
    return out


def units(raw: np.ndarray) -> np.ndarray:
    """Rows of length 1, whatever their size."""
    x = raw / np.abs(raw).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def linked_pairs(raw: np.ndarray, left: np.ndarray, right: np.ndarray, threshold: float):
    """Yields arrays (i, j), i < j, of linked rows of raw with one of them in left and the other in right (positions)."""
    raw = raw / np.abs(raw).max(axis=1, keepdims=True)
    norm = np.linalg.norm(raw, axis=1)
    q, s, near, err = quantised(raw / norm[:, None])
    slack, same = 1e-9, left is right
    for at in range(0, len(left), BLOCK_ROWS):
        i, j = left[at : at + BLOCK_ROWS], right[at if same else 0 :]
        bound = exact_products(q[i], q[j]) * s[i, None] * s[None, j]
        bound += near[i, None] * err[None, j] + err[i, None] * near[None, j] + err[i, None] * err[None, j]
        a, b = np.nonzero(bound >= threshold - slack)
        a, b = i[a], j[b]
        if same:
            once = a < b
            a, b = a[once], b[once]
        a, b = np.minimum(a, b), np.maximum(a, b)
        hit = np.zeros(len(a), dtype=bool)
        for k in range(0, len(a), 65_536):
            c, d = a[k : k + 65_536], b[k : k + 65_536]
            hit[k : k + 65_536] = np.einsum("ij,ij->i", raw[c], raw[d]) / (norm[c] * norm[d]) >= threshold
        yield a[hit], b[hit]


def _stack(packed: pd.Series, wide: str) -> np.ndarray:
    return np.frombuffer(b"".join(packed), dtype=wide).reshape(len(packed), -1).astype(np.float64)


def _cell(key: tuple, pdf: pd.DataFrame, threshold: float, wide: str) -> pd.DataFrame:
    pdf = pdf.sort_values("cid", kind="stable")
    raw = _stack(pdf["packed"], wide)
    cid, many, stripe = (pdf[c].to_numpy() for c in ("cid", "copies", "stripe"))
    first, second = np.nonzero(stripe == key[1])[0], np.nonzero(stripe == key[2])[0]
    links, union = np.zeros(len(pdf), dtype=np.int64), Union(len(pdf))
    if len(first) and len(second):
        for a, b in linked_pairs(raw, first, first if key[1] == key[2] else second, threshold):
            np.add.at(links, a, many[b])
            np.add.at(links, b, many[a])
            union.join(a, b)
    some = links > 0
    return pd.DataFrame({"cid": cid[some], "links": links[some], "least": cid[union.up[some]]})


def _angles(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(units(x) @ pivots.T, -1, 1))


def _dealt(classes: DataFrame, threshold: float, wide: str) -> DataFrame:
    """classes with their stripe, and a row for each stripe (other) that may hold a linked vector."""
    size = np.dtype(wide).itemsize
    dims = [(r["bytes"] // size, r["count"]) for r in classes.groupBy(F.octet_length("packed").alias("bytes")).count().collect()]
    chosen = classes.select("packed").orderBy(F.xxhash64("packed"), "packed").limit(PIVOTS).collect()  # at most PIVOTS vectors
    pivots = {}
    for dim, n in dims:
        own = [r["packed"] for r in chosen if len(r["packed"]) == dim * size]
        rows = max(256, min(STRIPE_ROWS, STRIPE_BYTES // (8 * dim)))
        # as many neighbourhoods as stripes, so that vectors without clusters are not cut finer than need be
        pivots[dim] = units(_stack(pd.Series(own[: max(1, -(-n // rows))], dtype=object), wide)) if own else np.zeros((0, dim))

    def nearest(parts):
        for pdf in parts:
            for bytes_, part in pdf.groupby(pdf["packed"].str.len(), sort=False):
                p = pivots[bytes_ // size]
                angle = _angles(_stack(part["packed"], wide), p) if len(p) else np.full((len(part), 1), np.pi)
                at = angle.argmin(axis=1)
                yield part.assign(pivot=at.astype(np.int32), angle=angle[np.arange(len(part)), at])

    c = keep(classes.mapInPandas(nearest, "cid long, packed binary, copies long, pivot int, angle double"), "emb-nearest")
    length = F.octet_length("packed").alias("bytes")
    held = c.groupBy(length, "pivot").agg(F.max("angle").alias("angle"), F.count("*").alias("n")).collect()  # a row per pivot
    place, stripes = 0, {}
    for r in sorted(held, key=lambda r: (r["bytes"], r["pivot"])):
        rows = max(256, min(STRIPE_ROWS, STRIPE_BYTES // (8 * (r["bytes"] // size))))
        many = -(-r["n"] // rows)
        stripes[r["bytes"], r["pivot"]] = (place, many, r["angle"])
        place += many
    reach, slack = float(np.arccos(threshold)), 1e-6

    def dealt(parts):
        for pdf in parts:
            for bytes_, part in pdf.groupby(pdf["packed"].str.len(), sort=False):
                p = pivots[bytes_ // size]
                own = np.array([stripes[bytes_, k][:2] for k in part["pivot"]])
                stripe = own[:, 0] + part["cid"].to_numpy() % own[:, 1]
                angle = _angles(_stack(part["packed"], wide), p) if len(p) else np.zeros((len(part), 1))
                other = [[] for _ in range(len(part))]
                for (b, k), (first, many, widest) in stripes.items():
                    if b == bytes_:
                        for i in np.flatnonzero(angle[:, k] <= widest + reach + slack):
                            other[i] += range(first, first + many)
                yield part.drop(columns=["pivot", "angle"]).assign(stripe=stripe.astype(np.int32), others=other)

    c = c.mapInPandas(dealt, "cid long, packed binary, copies long, stripe int, others array<int>")
    return c.select("cid", "packed", "copies", "stripe", F.explode("others").alias("other"))


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    e = F.col("embedding")
    usable = F.coalesce((F.size(e) > 0) & ~F.exists(e, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(e, lambda x: x != 0), F.lit(False))
    wide = "<f4" if vectors.schema["embedding"].dataType.elementType.typeName() == "float" else "<f8"

    @F.pandas_udf("binary")
    def packed(column: pd.Series) -> pd.Series:
        return pd.Series([None if x is None else np.asarray(x, dtype=wide).tobytes() for x in column], dtype=object)

    v = vectors.select("vec_id", F.when(usable, e).alias("embedding"))
    v = keep(v.select("vec_id", packed("embedding").alias("packed")), "emb-packed").withColumn("key", F.md5("packed"))
    classes = v.filter("packed IS NOT NULL").groupBy("key").agg(F.first("packed").alias("packed"), F.min("vec_id").alias("least_id"), F.count("*").alias("copies"))
    classes = keep(classes.withColumn("cid", F.monotonically_increasing_id()), "emb-classes")
    c = _dealt(classes.select("cid", "packed", "copies"), threshold, wide)
    c = c.select("cid", "packed", "copies", "stripe", F.octet_length("packed").alias("dim"), F.least("stripe", "other").alias("p"), F.greatest("stripe", "other").alias("q"))
    found = keep(c.groupBy("dim", "p", "q").applyInPandas(lambda k, pdf: _cell(k, pdf, threshold, wide), "cid long, links long, least long"), "emb-links")
    labels = connected_components(found.select(F.col("cid").alias("a"), F.col("least").alias("b")))
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    per_class = classes.select("cid", "key", "least_id", "copies").join(links, "cid", "left").join(labels.withColumnRenamed("node", "cid"), "cid", "left").withColumn("label", F.coalesce("label", "cid"))
    per_class = keep(per_class, "emb-labelled")
    names = keep(per_class.groupBy("label").agg(F.min("least_id").alias("component_id")), "emb-components")
    per_class = per_class.join(names, "label").select("key", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    per_class = keep(per_class, "emb-result")
    # unusable vectors take part under keys of their own, which match nothing
    own = F.concat(F.lit("own:"), F.xxhash64("vec_id", F.monotonically_increasing_id()).cast("string"))
    rows = v.select("vec_id", F.coalesce("key", own).alias("key")).join(per_class, "key", "left")
    component = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return rows.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


def oracle(threshold: float = THRESHOLD) -> str:
    """DuckDB SQL for near_duplicates over unique ids."""
    return f"""
    WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE embedding IS NOT NULL),
    l AS (SELECT a.vec_id AS i, b.vec_id AS j FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
          AND list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= {threshold}),
    reach(i, j) AS (SELECT i, j FROM l UNION SELECT r.i, l.j FROM reach r JOIN l ON r.j = l.i)
    SELECT e.vec_id, (SELECT count(*) FROM l WHERE l.i = e.vec_id) AS n_links, least(e.vec_id, coalesce((SELECT min(j) FROM reach WHERE reach.i = e.vec_id), e.vec_id)) AS component_id,
      e.vec_id = least(e.vec_id, coalesce((SELECT min(j) FROM reach WHERE reach.i = e.vec_id), e.vec_id)) AS kept FROM embeddings e"""
