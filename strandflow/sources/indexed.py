"""Spark data source of position-sorted text in blocked gzip (VCF or BED): read in splits of bytes, by region through an index, written with one.

    spark.read.format("strand_indexed").load(path)     # chrom, pos, end, value

A path is a file or a folder that the sink wrote. Without regions a file is cut into
splits of split_bytes, wherever blocks and lines end. Regions choose the files (by the
folder's manifest) and the byte ranges (by each file's .tbi) that partitions are made of;
only records that meet a region come out, each once. Regions are an option of the scan:
Spark 4.1 keeps what filters a Python source has taken from one query of a DataFrame for
all later ones of it, which then lack rows, so the source takes none.

The sink writes one file for each task, with an index of its own made while it is written,
and on commit a manifest of one row for each file and contig. Rows must come sorted within
tasks; write() does that. Reading and writing go through pyarrow's file systems.
"""

from __future__ import annotations

import bisect
import json
import struct
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from . import bgzf, text
from .index import SHIFTS, first_bin

NAME = "strand_indexed"
SCHEMA = "chrom string, pos long, end long, value string"
MANIFEST = "_manifest.json"
SPLIT_BYTES, ROWS = 64 << 20, 20_000
#: Fixed values of the index format: its kinds (VCF; BED, from 0), columns of name, begin and end, comment sign.
KINDS = {"vcf": (2, 1, 2, 0, 35, 0), "bed": (0x10000, 1, 2, 3, 35, 0)}
#: Positions that the index's bins hold.
LAST_POS = 1 << SHIFTS[-1]


def parsed(line: bytes, kind: str) -> tuple[str, int, int] | None:
    """chrom, pos and end of a line; None for headers and lines that are no record."""
    if line.startswith(b"#") or (kind == "bed" and line.startswith(b"track")):
        return None
    c = line.split(b"\t", 8)
    try:
        if kind == "bed":
            return c[0].decode(), int(c[1]), int(c[2])
        pos = int(c[1]) - 1
        if len(c) > 7 and (info := b";" + c[7].split(b"\t", 1)[0] + b";").find(b";END=") >= 0:
            declared = info[info.find(b";END=") + 5 :].split(b";", 1)[0]
            if declared.isdigit():
                return c[0].decode(), pos, int(declared)
        return c[0].decode(), pos, pos + len(c[3].decode())
    except (IndexError, ValueError):
        return None


def bin_of(s: int, e: int) -> int:
    """The smallest bin that holds [s, e)."""
    for shift in SHIFTS:
        if s >> shift == (e - 1) >> shift:
            return first_bin(shift) + (s >> shift)
    return 0


class IndexBuilder:
    """A tabix index, fed with records in order."""

    def __init__(self, kind: str):
        self.kind, self.contigs, self.names, self.last = kind, [], [], -1

    def add(self, chrom: str, s: int, e: int, start: int, stop: int) -> None:
        e = max(e, s + 1)
        if s < 0 or e > LAST_POS:
            raise ValueError(f"{chrom}:{s}-{e} lies beyond the index's bins")
        if not self.names or self.names[-1] != chrom:
            if chrom in self.names:
                raise ValueError(f"records of {chrom} do not stand together")
            self.names.append(chrom)
            self.contigs.append(({}, {}))
            self.last = -1
        if s < self.last:
            raise ValueError(f"{chrom}:{s} comes after {self.last}")
        self.last = s
        bins, linear = self.contigs[-1]
        chunks = bins.setdefault(bin_of(s, e), [])
        if chunks and chunks[-1][1] == start:
            chunks[-1][1] = stop
        else:
            chunks.append([start, stop])
        for slot in range(s >> SHIFTS[0], ((e - 1) >> SHIFTS[0]) + 1):
            linear.setdefault(slot, start)

    def written(self) -> bytes:
        names = b"".join(n.encode() + b"\0" for n in self.names)
        out = [b"TBI\1", struct.pack("<8i", len(self.names), *KINDS[self.kind], len(names)), names]
        for bins, linear in self.contigs:
            out.append(struct.pack("<i", len(bins)))
            for number, chunks in sorted(bins.items()):
                out += [struct.pack("<Ii", number, len(chunks)), *(struct.pack("<QQ", *c) for c in chunks)]
            slots, before = [], 0
            for slot in range(max(linear) + 1):
                before = linear.get(slot, before)
                slots.append(before)
            out.append(struct.pack(f"<i{len(slots)}Q", len(slots), *slots))
        raw = b"".join(out)
        return b"".join(bgzf.block(raw[i : i + bgzf.TEXT]) for i in range(0, len(raw), bgzf.TEXT)) + bgzf.END


class Index:
    """A tabix index read whole: it is a summary, bounded by the bins of its contigs."""

    def __init__(self, file):
        blocks, at, parts = bgzf.Blocks(file), 0, []
        while at < blocks.size:
            part, at = blocks.text(at)
            parts.append(part)
        data, place = b"".join(parts), 36
        magic, n, *_, length = struct.unpack_from("<4s8i", data)
        if magic != b"TBI\1":
            raise ValueError("not an index")
        names = data[place : place + length].split(b"\0")[:n]
        place += length
        self.contigs = {}
        for name in names:
            bins = {}
            (count,) = struct.unpack_from("<i", data, place)
            place += 4
            for _ in range(count):
                number, chunks = struct.unpack_from("<Ii", data, place)
                ends = struct.unpack_from(f"<{2 * chunks}Q", data, place + 8)
                bins[number] = list(zip(ends[::2], ends[1::2]))
                place += 8 + 16 * chunks
            (count,) = struct.unpack_from("<i", data, place)
            self.contigs[name.decode()] = bins, struct.unpack_from(f"<{count}Q", data, place + 4)
            place += 4 + 8 * count

    def chunks(self, contig: str, lo: int, hi: int) -> list[tuple[int, int]]:
        """Ranges of virtual offsets, merged and in order, that hold all records of a contig that meet [lo, hi)."""
        bins, linear = self.contigs.get(contig, ({}, ()))
        lo, hi = max(lo, 0), min(hi, LAST_POS)
        if lo >= hi or not bins:
            return []
        slot = lo >> SHIFTS[0]
        floor = linear[min(slot, len(linear) - 1)] if linear else 0
        met: Iterable[int] = {0} | {first_bin(k) + i for k in SHIFTS for i in range(lo >> k, ((hi - 1) >> k) + 1)} if hi - lo < 1 << 24 else {n for n in bins if self._meets(n, lo, hi)}
        found = ((max(s, floor), e) for n in met for s, e in bins.get(n, ()) if e > floor and n <= 37449 and (n == 0 or self._meets(n, lo, hi)))
        return joined(found)

    @staticmethod
    def _meets(number: int, lo: int, hi: int) -> bool:
        for shift in SHIFTS:
            first = first_bin(shift)
            if first <= number <= 8 * first:
                return number - first << shift < hi and lo < number - first + 1 << shift
        return number == 0


@dataclass
class Piece(InputPartition):
    """A part of a file, as bgzf.Blocks.lines takes it."""

    path: str
    start: int
    stop: int
    exact: bool
    stop_exact: bool

    def bytes(self) -> int:
        return (self.stop >> 16 if self.stop_exact else self.stop) - (self.start >> 16 if self.exact else self.start)


def cut(piece: Piece, most: int) -> Iterator[Piece]:
    """piece in parts of about most bytes."""
    first, last = (piece.start >> 16 if piece.exact else piece.start), (piece.stop >> 16 if piece.stop_exact else piece.stop)
    bounds = list(range(first + most, last, most))
    starts, stops = [(piece.start, piece.exact), *((b, False) for b in bounds)], [*((b, False) for b in bounds), (piece.stop, piece.stop_exact)]
    for (start, exact), (stop, stop_exact) in zip(starts, stops):
        yield Piece(piece.path, start, stop, exact, stop_exact)


class Regions:
    """Disjoint, sorted stretches of each contig."""

    def __init__(self, rows: Iterable[tuple[str, int | None, int | None]]):
        self.of: dict[str, list[list[int]]] = {}
        for contig, lo, hi in sorted((c, lo or 0, LAST_POS * 8 if hi is None else hi) for c, lo, hi in rows):
            held = self.of.setdefault(contig, [])
            if held and lo <= held[-1][1]:
                held[-1][1] = max(held[-1][1], hi)
            elif lo < hi:
                held.append([lo, hi])
        self.starts = {c: [lo for lo, _ in held] for c, held in self.of.items()}

    def meet(self, contig: str, s: int, e: int) -> bool:
        """Whether [s, e), at least its first position, meets one."""
        at = bisect.bisect_left(self.starts.get(contig, []), max(e, s + 1)) - 1
        return at >= 0 and self.of[contig][at][1] > s


def joined(ranges: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges of virtual offsets in order; those that share a block become one."""
    out: list[list[int]] = []
    for s, e in sorted(ranges):
        if out and s >> 16 <= out[-1][1] >> 16:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


class IndexedReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.kind = options.get("kind", "vcf")
        self.most = int(options.get("split_bytes", SPLIT_BYTES))
        self.regions = Regions(json.loads(options["regions"])) if "regions" in options else None

    def _files(self) -> list[str]:
        from pyarrow import fs

        system, path = bgzf.filesystem(self.path)
        if system.get_file_info(path).type == fs.FileType.File:
            return [path]
        with system.open_input_stream(f"{path}/{MANIFEST}") as f:
            rows = json.loads(f.read())
        wanted = lambda r: self.regions is None or self.regions.meet(r["contig"], r["first"], r["end"])
        return [f"{path}/{n}" for n in dict.fromkeys(r["file"] for r in rows if wanted(r))]

    def partitions(self) -> list[Piece]:
        from pyarrow import fs

        system, _ = bgzf.filesystem(self.path)
        out = []
        for path in self._files():
            size = system.get_file_info(path).size
            ranges = [Piece(path, 0, size, False, False)]
            if self.regions is not None and system.get_file_info(f"{path}.tbi").type == fs.FileType.File:
                with system.open_input_file(f"{path}.tbi") as f:
                    index = Index(f)
                found = [x for c, held in self.regions.of.items() for lo, hi in held for x in index.chunks(c, lo, hi)]
                ranges = [Piece(path, s, e, True, True) for s, e in joined(found)]
            out += [p for r in ranges for p in cut(r, self.most)]
        return out or [Piece("", 0, 0, False, False)]

    def read(self, piece: Piece) -> Iterator[pa.RecordBatch]:
        if not piece.path:
            return
        system, _ = bgzf.filesystem(self.path)
        names = ["chrom", "pos", "end", "value"]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
        rows: list[tuple] = []
        batch = lambda: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
        with system.open_input_file(piece.path) as f:
            for _, line in bgzf.Blocks(f).lines(piece.start, piece.stop, piece.exact, piece.stop_exact):
                r = parsed(line, self.kind)
                if r is None or (self.regions is not None and not self.regions.meet(*r)):
                    continue
                rows.append((*r, line.decode()))
                if len(rows) >= ROWS:
                    yield batch()
                    rows = []
        if rows:
            yield batch()


@dataclass
class Written(WriterCommitMessage):
    file: str | None
    contigs: list[dict]


class IndexedWriter(DataSourceArrowWriter):
    """Rows (chrom, pos, end, value) sorted within each task."""

    def __init__(self, options: dict[str, str], overwrite: bool):
        if overwrite:
            raise ValueError("indexed files are written to a new folder")
        self.path, self.kind, self.header = options["path"], options.get("kind", "vcf"), options.get("header", "")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        from pyspark import TaskContext

        system, folder = bgzf.filesystem(self.path)
        system.create_dir(folder, recursive=True)
        # a name for each attempt: what a failed one leaves is not in the manifest
        name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.{self.kind}.gz"
        index, found = IndexBuilder(self.kind), {}
        with system.open_output_stream(f"{folder}/{name}", compression=None) as sink:
            out = bgzf.Writer(sink)
            if self.header:
                out.write(self.header.rstrip("\n").encode() + b"\n")
            for batch in iterator:
                for chrom, pos, end, value in zip(*(batch.column(c).to_pylist() for c in ("chrom", "pos", "end", "value"))):
                    start = out.tell()
                    out.write(value.encode() + b"\n")
                    index.add(chrom, pos, end, start, out.tell())
                    row = found.setdefault(chrom, {"file": name, "contig": chrom, "first": pos, "end": end, "rows": 0})
                    row["end"], row["rows"] = max(row["end"], end, pos + 1), row["rows"] + 1
            out.close()
        with system.open_output_stream(f"{folder}/{name}.tbi", compression=None) as sink:
            sink.write(index.written())
        return Written(name, list(found.values()))

    def commit(self, messages: list[Written | None]) -> None:
        """A row for each file and contig: as many as ranges were written."""
        system, folder = bgzf.filesystem(self.path)
        system.create_dir(folder, recursive=True)
        with system.open_output_stream(f"{folder}/{MANIFEST}", compression=None) as sink:
            sink.write(json.dumps([r for m in messages if m for r in m.contigs]).encode())

    def abort(self, messages: list[Written | None]) -> None:
        system, folder = bgzf.filesystem(self.path)
        for m in messages:
            if m and m.file:
                for name in (m.file, f"{m.file}.tbi"):
                    system.delete_file(f"{folder}/{name}")


class IndexedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> IndexedReader:
        return IndexedReader(dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> IndexedWriter:
        return IndexedWriter(dict(self.options), overwrite)


Region = tuple[str, int | None, int | None]


def lines(spark: SparkSession, path: str, kind: str = "vcf", regions: list[Region] | None = None, split_bytes: int | None = None) -> DataFrame:
    """chrom, pos, end and value of all records, or of those that meet one of regions (contig, start, stop; from 0, None for no bound)."""
    spark.dataSource.register(IndexedSource)
    options = {"kind": kind} | ({"split_bytes": str(split_bytes)} if split_bytes else {}) | ({"regions": json.dumps(regions)} if regions is not None else {})
    return spark.read.format(NAME).options(**options).load(path)


def read_vcf(spark: SparkSession, path: str, regions: list[Region] | None = None, split_bytes: int | None = None) -> DataFrame:
    """Columns of text.read_vcf."""
    d = lines(spark, path, "vcf", regions, split_bytes)
    return text.records(d.select("value", F.monotonically_increasing_id().alias("record")))


def read_bed(spark: SparkSession, path: str, regions: list[Region] | None = None, split_bytes: int | None = None) -> DataFrame:
    """grp, s, e of a BED file in blocked gzip."""
    return lines(spark, path, "bed", regions, split_bytes).select(F.col("chrom").alias("grp"), F.col("pos").alias("s"), F.col("end").alias("e"))


def ranged(df: DataFrame, contigs: list[str] | None, order: list[Column], files: int | None) -> DataFrame:
    """Rows ranged and sorted by contig (in the order given, others after them by name), pos and order."""
    nth = F.array_position(F.array(*map(F.lit, contigs)), F.col("chrom")) if contigs else F.lit(0)
    d = df.withColumn("__nth", F.when(nth == 0, 1 << 30).otherwise(nth) if contigs else nth)
    return d.repartitionByRange(*([files] if files else []), "__nth", "chrom", "pos").sortWithinPartitions("__nth", "chrom", "pos", *order).drop("__nth")


def write_vcf(df: DataFrame, header: list[str], path: str, contigs: list[str] | None = None, files: int | None = None) -> None:
    """Records of read_vcf's columns into a new folder of indexed files (as many as Spark's shuffles have partitions), each a VCF by itself."""
    spark = df.sparkSession
    spark.dataSource.register(IndexedSource)
    record = F.col("record") if "record" in df.columns else F.lit(0)
    rows = text.vcf_lines(df.withColumn("__record", record), "end", "__record")
    rows = ranged(rows, contigs, [F.col("__record"), F.col("value")], files).select("chrom", "pos", "end", "value")
    rows.write.format(NAME).option("header", "\n".join(header)).mode("append").save(path)


def write_bed(df: DataFrame, path: str, files: int | None = None) -> None:
    """Intervals (grp, s, e) into a new folder of indexed files."""
    df.sparkSession.dataSource.register(IndexedSource)
    d = df.select(F.col("grp").alias("chrom"), F.col("s").alias("pos"), F.col("e").alias("end"), F.concat_ws("\t", "grp", "s", "e").alias("value"))
    ranged(d, None, [F.col("end")], files).write.format(NAME).option("kind", "bed").mode("append").save(path)
