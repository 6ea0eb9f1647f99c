"""Overlap join with a small side: its intervals as sorted arrays that every task gets whole, probed in Arrow batches, without a shuffle.

The arrays are split by width (levels that grow by eight). Within one, intervals sorted by start have running maxima of
their ends; two binary searches bound what an interval of the other side can meet, and few of those in between miss it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StructField, StructType

from .intervals import overlap_join

#: A side is small up to so many rows and bytes, which are measured; a larger one takes the join over bins.
MOST_ROWS, MOST_BYTES = 1_000_000, 64 << 20
#: Pairs that a task hands over at a time, about.
PAIRS = 200_000


class Arrays:
    """Sorted arrays of one side by group and level of width."""

    def __init__(self, table: pa.Table):
        self.table = table
        self.groups = pc.unique(table["grp"].combine_chunks() if table.num_rows else table["grp"])
        self.groups = self.groups.combine_chunks() if isinstance(self.groups, pa.ChunkedArray) else self.groups
        code = pc.index_in(table["grp"], value_set=self.groups).to_numpy().astype(np.int64)
        s, e = (table[c].to_numpy().astype(np.int64) for c in ("s", "e"))
        level = np.ceil(np.log2(np.maximum(e - s, 1)) / 3).astype(np.int64)
        order = np.lexsort((e, s, level, code))
        key = code[order] << 6 | level[order]
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, dtype=np.int64)
        self.parts: dict[int, list[tuple]] = {}
        for lo, hi in zip(starts, [*starts[1:], len(key)]):
            at = order[lo:hi]
            self.parts.setdefault(int(key[lo] >> 6), []).append((s[at], e[at], np.maximum.accumulate(e[at]), at))

    def pairs(self, code: np.ndarray, s: np.ndarray, e: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows of the other side (places in its batch) with rows of this one that they overlap."""
        for group in np.unique(code[code >= 0]):
            rows = np.flatnonzero(code == group)
            for starts, ends, top, at in self.parts.get(int(group), ()):
                lo, hi = np.searchsorted(top, s[rows], "right"), np.searchsorted(starts, e[rows], "left")
                many = np.maximum(hi - lo, 0)
                upto, first = np.cumsum(many), 0
                while first < len(rows):
                    last = max(first + 1, int(np.searchsorted(upto, (upto[first - 1] if first else 0) + PAIRS, "right")))
                    n = many[first:last]
                    left = np.repeat(np.arange(first, last), n)
                    right = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo[first:last], n)
                    hit = ends[right] > s[rows][left]
                    if hit.any():
                        yield rows[left[hit]], at[right[hit]]
                    first = last


def small_overlap_join(a: DataFrame, b: DataFrame, most_rows: int = MOST_ROWS, most_bytes: int = MOST_BYTES) -> DataFrame:
    """overlap_join(a, b) for a small b: its size is measured, and beyond the bounds the join over bins takes its place."""
    b = b.filter("grp IS NOT NULL AND s IS NOT NULL AND e IS NOT NULL")
    table = b.limit(most_rows + 1).toArrow()
    if table.num_rows > most_rows or table.nbytes > most_bytes:
        return overlap_join(a, b)
    sent = a.sparkSession.sparkContext.broadcast(table)
    named = lambda d, p: [StructField(f"{p}{f.name}" if f.name in ("s", "e") else f.name if f.name == "grp" else f"{p}_{f.name}", f.dataType) for f in d.schema]
    mine, theirs = named(a, "a"), [f for f in named(b, "b") if f.name != "grp"]
    others = [c for c in b.columns if c != "grp"]
    out = StructType([*mine, *theirs, StructField("overlap", LongType())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = Arrays(sent.value)
        for batch in parts:
            batch = batch.filter(pc.and_(pc.is_valid(batch["grp"]), pc.and_(pc.is_valid(batch["s"]), pc.is_valid(batch["e"]))))
            if not batch.num_rows or not arrays.table.num_rows:
                continue
            code = pc.fill_null(pc.index_in(batch["grp"], value_set=arrays.groups), -1).to_numpy(zero_copy_only=False)
            s, e = (batch[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in ("s", "e"))
            for left, right in arrays.pairs(code, s, e):
                found = arrays.table.take(pa.array(right)).combine_chunks()
                columns = [c.take(pa.array(left)) for c in batch.columns] + [found[c].combine_chunks() for c in others]
                bs, be = (found[c].to_numpy().astype(np.int64) for c in ("s", "e"))
                overlap = np.minimum(e[left], be) - np.maximum(s[left], bs)
                yield pa.RecordBatch.from_arrays([*columns, pa.array(overlap)], [f.name for f in out])

    return a.mapInArrow(run, out)
