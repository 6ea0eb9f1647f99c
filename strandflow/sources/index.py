"""Binary alignment indexes (BAI): decoding, densities per slot and region lookup by bin numbers."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the format: bits of a bin's span on its six levels, and the least number that is no bin.
SHIFTS = (14, 17, 20, 23, 26, 29)
NO_BIN = 37449


def first_bin(shift: int) -> int:
    """Number of the first bin of a level."""
    return ((1 << 29 - shift) - 1) // 7


def _decoded(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows (path, tid, bin, s, e); those with a null bin are the linear index: s numbers the slot, e is its offset."""
    for pdf in parts:
        for path, data in zip(pdf["path"], pdf["content"]):
            at = 8

            def read(form: str) -> tuple:
                nonlocal at
                at += struct.calcsize(form)
                return struct.unpack_from(form, data, at - struct.calcsize(form))

            magic, n_ref = struct.unpack_from("<4sI", data)
            if magic != b"BAI\1":
                raise ValueError(f"not an alignment index: {path}")
            for tid in range(n_ref):
                rows = []
                for _ in range(read("<I")[0]):
                    number, n = read("<II")
                    ends = read(f"<{2 * n}Q")
                    rows += [(path, tid, number, s, e) for s, e in zip(ends[::2], ends[1::2])]
                linear = read(f"<{read('<I')[0]}Q")
                rows += [(path, tid, None, i, o) for i, o in enumerate(linear)]
                yield pd.DataFrame(rows, columns=["path", "tid", "bin", "s", "e"]).astype({"bin": "Int64"})


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_bai(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(_decoded, "path string, tid int, bin long, s long, e long")


def slots(number: Column) -> Column:
    """First and last 16 kb slot (struct lo, hi) that a bin covers; null for numbers that are no bin."""
    out = F.lit(None).cast("struct<lo:bigint,hi:bigint>")
    for shift in SHIFTS:
        first, wide = first_bin(shift), 1 << shift - SHIFTS[0]
        lo = (number - first) * wide
        out = F.when((number >= first) & (number <= 8 * first), F.struct(lo.cast("long").alias("lo"), (lo + wide - 1).cast("long").alias("hi"))).otherwise(out)
    return out


def density(index: DataFrame) -> DataFrame:
    """Compressed size per slot (path, tid, slot, density): a bin's size spread over its slots that the linear index has."""
    n = index.filter("bin IS NULL").groupBy("path", "tid").agg((F.max("s") + 1).alias("n"))
    size = F.shiftright("e", 16) - F.shiftright("s", 16)
    bins = index.filter("bin IS NOT NULL").groupBy("path", "tid", "bin").agg(F.sum(size).alias("size")).withColumn("at", slots(F.col("bin")))
    d = bins.filter("at IS NOT NULL").join(n, ["path", "tid"], "left").withColumn("hi", F.least("at.hi", F.greatest(F.coalesce("n", F.lit(1)), F.lit(1)) - 1))
    d = d.filter("at.lo <= hi").withColumn("share", F.col("size") / (F.col("hi") - F.col("at.lo") + 1))
    return d.withColumn("slot", F.explode(F.sequence("at.lo", "hi"))).groupBy("path", "tid", "slot").agg(F.sum("share").alias("density"))


def offsets(index: DataFrame) -> DataFrame:
    """Least and largest virtual offset (path, tid, first, last) of each contig's chunks."""
    return index.filter("bin IS NOT NULL").groupBy("path", "tid").agg(F.min("s").alias("first"), F.max("e").alias("last"))


def contig_density(dense: DataFrame, headers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Densities (grp, slot, density) of named contigs summed over inputs, and their greatest lengths (grp, nth, length).

    dense: path, tid, slot, density; headers: path, tid, name, length. An input's contigs go by their number in its header.
    """
    named = dense.join(headers.select("path", "tid", F.col("name").alias("grp")), ["path", "tid"])
    contigs = headers.groupBy(F.col("name").alias("grp")).agg(F.min("tid").alias("nth"), F.max("length").alias("length"))
    return named.groupBy("grp", "slot").agg(F.sum("density").alias("density")), contigs


def _encoded(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    """One contig's part of an index: bins by number, chunks by start, then the linear index (0 for slots without a row)."""
    chunks = pdf[pdf["bin"].notna()].sort_values(["bin", "s", "e"])
    bins = {int(n): x[["s", "e"]].to_numpy() for n, x in chunks.groupby("bin", sort=True)}
    linear = pdf[pdf["bin"].isna()]
    slots_ = dict(zip(linear["s"], linear["e"]))
    n = max(slots_, default=-1) + 1
    out = [struct.pack("<I", len(bins))]
    for number, ends in bins.items():
        out += [struct.pack("<II", number, len(ends)), ends.astype("<u8").tobytes()]
    out += [struct.pack("<I", n), *(struct.pack("<Q", int(slots_.get(i, 0))) for i in range(n))]
    return pd.DataFrame({"tid": [key[0]], "data": [b"".join(out)]})


def write_bai(index: DataFrame, path: str) -> None:
    """One alignment index file, on any Hadoop file system, from rows of read_bai (of one path).

    Contigs are encoded by tasks; the driver takes their parts in order and writes one after the other. A contig's part
    is bounded by the bins and slots of its length.
    """
    spark = index.sparkSession
    parts = index.select("tid", "bin", "s", "e").groupBy("tid").applyInPandas(_encoded, "tid int, data binary").orderBy("tid")
    last = index.agg(F.max("tid")).first()[0]
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p, True)
    try:
        out.write(bytearray(b"BAI\1" + struct.pack("<I", 0 if last is None else last + 1)))
        tid = 0
        for r in parts.toLocalIterator():
            out.write(bytearray(struct.pack("<II", 0, 0) * (r.tid - tid) + bytes(r.data)))
            tid = r.tid + 1
    finally:
        out.close()


def region_bins(s: Column, e: Column) -> Column:
    """Numbers of all bins that meet [s, e)."""
    levels = [F.sequence((F.shiftright(s, k) + first_bin(k)).cast("long"), (F.shiftright(e - 1, k) + first_bin(k)).cast("long")) for k in SHIFTS]
    return F.concat(*levels)


def region_chunks(index: DataFrame, regions: DataFrame, keys: list[str]) -> DataFrame:
    """Chunks (keys, id, s, e) to read for regions (keys, id, s, e, floor): of the bins that meet a region, ending after floor.

    A region stands in the bins of its own level, the widest one no wider than itself, and of the wider levels: nine of a
    level at most. A chunk looks for it in its own bin there, or in the bin of the region's level that holds its own one.
    Both sides are shuffled: Spark's estimate for a broadcast leaves out how many rows the bins of regions make.
    """
    own = F.lit(SHIFTS[0])
    for k in SHIFTS[1:]:
        own = F.when(F.col("to") - F.col("from") >= 1 << k, k).otherwise(own)
    r = regions.select(*keys, "id", "floor", F.col("s").alias("from"), F.col("e").alias("to")).withColumn("level", own)
    place = lambda at, k: F.least(F.greatest(F.shiftright(at, k), F.lit(0)), F.lit((1 << SHIFTS[-1] - k) - 1))
    met = lambda k: F.sequence(place(F.col("from"), k), place(F.greatest(F.col("to") - 1, F.col("from")), k))
    each = [F.when(F.col("level") <= k, F.struct(F.lit(first_bin(k)).alias("first"), (F.col("level") == k).alias("home"), met(k).alias("places"))) for k in SHIFTS]
    bins = r.select("*", F.inline(F.array_compact(F.array(*each)))).select(*keys, "id", "floor", "from", "to", "home", "first", F.explode("places").alias("place"))
    bins = bins.withColumn("bin", F.col("first") + F.col("place")).drop("first", "place")

    # for each depth of a bin in the tree of bins, the levels on which its chunks look: at most 21 rows
    n = len(SHIFTS) - 1
    looks = [F.struct(F.lit(n - i).cast("long").alias("depth"), F.lit(w).alias("own"), F.lit(first_bin(w)).cast("long").alias("own_first"), F.lit(k).alias("shift"), F.lit(first_bin(k)).cast("long").alias("first")) for i, w in enumerate(SHIFTS) for k in SHIFTS[i:]]
    levels = r.select("level").distinct().select("level", F.inline(F.array(*looks)))
    levels = levels.filter("CASE WHEN own = shift THEN level <= shift ELSE level = shift END").drop("level").distinct()
    # bins of depth d are numbered from (8 ** d - 1) / 7
    c = index.select(*keys, F.col("bin").alias("number"), "s", "e", F.floor(F.log2(F.col("bin") * 7 + 1.5) / 3).alias("depth")).join(F.broadcast(levels), "depth")
    c = c.withColumns({"lo": F.expr("shiftleft(number - own_first, own)"), "hi": F.expr("shiftleft(number - own_first + 1, own)"), "mine": F.col("own") == F.col("shift")})
    c = c.withColumn("bin", F.expr("first + shiftright(lo, shift)")).select(*keys, "bin", "s", "e", "lo", "hi", "mine")
    j = c.join(bins.hint("merge"), [*keys, "bin"]).filter("(mine OR home) AND lo < to AND from < hi AND e > floor")
    return j.select(*keys, "id", "s", "e")


def _inflated(data: bytes) -> Iterator[bytes]:
    """Blocks of a blocked gzip file in order."""
    at = 0
    while at + 18 <= len(data):
        size = struct.unpack_from("<H", data, at + 16)[0] + 1
        if at + size > len(data):
            return
        yield zlib.decompress(data[at + 18 : at + size - 8], -15)
        at += size


def _contigs(data: bytes) -> list[tuple[int, str, int]] | None:
    """tid, name, length; None if data ends before the header does."""
    blocks, held, at = _inflated(data), b"", 0

    def take(n: int) -> bytes:
        nonlocal held, at
        while len(held) < at + n:
            held += next(blocks)
        at += n
        return held[at - n : at]

    def count() -> int:
        return struct.unpack("<I", take(4))[0]

    try:
        if take(4) != b"BAM\1":
            raise ValueError("not an alignment file")
        take(count())
        return [(tid, take(count())[:-1].decode(), count()) for tid in range(count())]
    except StopIteration:
        return None


def _opening(spark: SparkSession, path: str, n: int) -> tuple[bytes, bool]:
    """The first n bytes of a file on any Hadoop file system, and whether that is all of it."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    size = fs.getFileStatus(p).getLen()
    stream = fs.open(p)
    try:
        return bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream, min(n, size))), n >= size
    finally:
        stream.close()


def read_bam_header(spark: SparkSession, path: str) -> DataFrame:
    """tid, name, length of one alignment file's contigs. Reads no more of it than the header fills, a megabyte at least."""
    n = 1 << 20
    while True:
        data, whole = _opening(spark, path, n)
        rows = _contigs(data)
        if rows is not None:
            return spark.createDataFrame(rows, "tid int, name string, length long")
        if whole:
            raise ValueError(f"header cut short: {path}")
        n *= 4
