"""Blocked gzip in splits, the index and the indexed data source."""

import gzip
import io
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strandflow.sources import bgzf, indexed, text

HEADER = ["##fileformat=VCFv4.2", "##contig=<ID=chr2,length=400000000>", "##contig=<ID=chr10,length=9000000>", "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\ts1"]


def written(lines, tail=b"\n"):
    out = io.BytesIO()
    w = bgzf.Writer(out)
    w.write(b"\n".join(lines) + tail)
    w.close()
    return out.getvalue()


def opened(data):
    return bgzf.Blocks(pa.BufferReader(data))


def lines_of(seed, n):
    r = random.Random(seed)
    return [bytes(r.choices(b"ACGT\x1f\x8b\x08\x04x", k=r.choice([0, 3, 80, 900, 90_000 if i % 97 == 0 else 5]))) for i in range(n)]


@pytest.mark.parametrize("tail", [b"\n", b""])
def test_every_split_holds_every_line_once(monkeypatch, tail):
    monkeypatch.setattr(bgzf, "TEXT", 1500)
    lines = [*lines_of(1, 700), b"last"]
    data = written(lines, tail)
    assert gzip.decompress(data) == b"\n".join(lines) + tail
    r = random.Random(2)
    for n in (1, 2, 3, 17, 200):
        bounds = sorted({0, len(data), *(r.randrange(len(data)) for _ in range(n))})
        got = [x for a, b in zip(bounds, bounds[1:]) for _, x in opened(data).lines(a, b, False, False)]
        assert got == lines, n


def test_splits_at_block_bounds(monkeypatch):
    monkeypatch.setattr(bgzf, "TEXT", 10)
    lines = [b"123456789", b"abcdefghi", b"x" * 35, b"", b"12345678", b"123456789"]  # some lines end where blocks do
    data = written(lines)
    for a in range(len(data)):
        got = [x for s, e in ((0, a), (a, len(data))) if s < e for _, x in opened(data).lines(s, e, False, False)]
        assert got == lines, a


def test_virtual_offsets_lead_to_their_lines(monkeypatch):
    monkeypatch.setattr(bgzf, "TEXT", 500)
    lines = lines_of(3, 200)
    data = written(lines)
    at = [o for o, _ in opened(data).lines(0, len(data), False, False)]
    for i in range(0, 190, 7):
        assert [x for _, x in opened(data).lines(at[i], at[i + 9], True, True)] == lines[i : i + 9]


def test_what_is_no_block_is_refused():
    with pytest.raises(ValueError):
        list(opened(gzip.compress(b"a\nb\n")).lines(0, 10, False, False))
    data = bytearray(written([b"abc"]))
    data[20] ^= 1
    with pytest.raises(Exception):
        list(opened(bytes(data)).lines(0, len(data), False, False))


def table(spark, n=6000):
    r = random.Random(7)
    rows = []
    for i in range(n):
        chrom = r.choice(["chr2", "chr2", "chr10", "alt"])
        pos = r.randrange(300_000_000 if chrom == "chr2" else 3_000_000) if i % 5 else 77_000
        ref = "A" * r.choice([1, 1, 2, 40])
        info = {"END": str(pos + r.choice([100, 70_000, 3_000_000]))} if i % 50 == 0 else {"DP": "3"}
        rows.append((chrom, pos, int(info.get("END", pos + len(ref))), f"id{i}", ref, ["C"], 9.0, [], info, [{"GT": "0/1"}], i))
    return spark.createDataFrame(rows, "chrom string, pos long, end long, id string, ref string, alt array<string>, qual double, filter array<string>, info map<string,string>, samples array<map<string,string>>, record long"), rows


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    df, rows = table(spark)
    path = str(tmp_path_factory.mktemp("indexed") / "v")
    indexed.write_vcf(df, HEADER, path, ["chr2", "chr10"], 6)
    return path, rows


def test_folder_reads_back_whole(spark, stored):
    path, rows = stored
    d = indexed.read_vcf(spark, path, split_bytes=3000)
    assert d.rdd.getNumPartitions() > 8
    got = sorted((r.chrom, r.pos, r.end, r.id, r.ref, tuple(r.alt), r.info.get("DP"), r.samples[0]["GT"]) for r in d.collect())
    assert got == sorted((r[0], r[1], r[2], r[3], r[4], ("C",), r[8].get("DP"), "0/1") for r in rows)
    # every file is a VCF by itself, which other readers take
    assert text.read_vcf(spark, f"{path}/*.gz").count() == len(rows)


@pytest.mark.parametrize("contig,lo,hi", [("chr2", 76_990, 77_001), ("chr2", 150_000_000, 150_900_000), ("chr10", 0, 50_000), ("chr2", 0, 1 << 40), ("alt", 2_999_000, 2_999_900), ("none", 0, 9)])
def test_regions_equal_a_full_scan(spark, stored, contig, lo, hi):
    path, rows = stored
    got = sorted(r.id for r in indexed.read_vcf(spark, path, [(contig, lo, hi)]).select("id").collect())
    assert got == sorted(r[3] for r in rows if r[0] == contig and r[1] < hi and r[2] > lo)


def test_several_regions_give_each_record_once(spark, stored):
    path, rows = stored
    regions = [("chr2", 70_000, 80_000), ("chr10", None, 90_000), ("chr2", 75_000, 9_000_000), ("chr2", 100_000_000, 200_000_000), ("alt", 5, 5)]
    got = sorted(r.id for r in indexed.read_vcf(spark, path, regions, 3000).select("id").collect())
    assert got == sorted(r[3] for r in rows if any(r[0] == c and r[1] < hi and r[2] > (lo or 0) for c, lo, hi in regions if (lo or 0) < hi))


def test_regions_choose_files_and_bytes(spark, stored):
    import json

    path, _ = stored

    def planned(**regions):
        pieces = indexed.IndexedReader({"path": path, "split_bytes": "3000"} | regions).partitions()
        return len(pieces), len({p.path for p in pieces}), sum(p.bytes() for p in pieces)

    region = [("chr2", 150_000_000, 150_900_000)]
    whole, small = planned(), planned(regions=json.dumps(region))
    assert small[1] <= 2 < whole[1] and small[2] < whole[2] / 5 and small[0] < whole[0] / 4
    assert planned(regions=json.dumps([("none", 0, 9)]))[2] == 0
    tasks = lambda *x: indexed.lines(spark, path, "vcf", *x).rdd.getNumPartitions()
    assert tasks(region, 3000) == small[0] < tasks(None, 3000) == whole[0]


def test_one_foreign_file_without_an_index(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(bgzf, "TEXT", 2000)
    _, rows = table(spark, 900)
    lines = [x.encode() for x in HEADER] + [f"{r[0]}\t{r[1] + 1}\t{r[3]}\t{r[4]}\tC\t9\t.\tEND={r[2]}\tGT\t0/1".encode() for r in rows]
    (tmp_path / "v.vcf.gz").write_bytes(written(lines))
    d = indexed.read_vcf(spark, str(tmp_path / "v.vcf.gz"), split_bytes=1000)
    assert d.rdd.getNumPartitions() > 5 and sorted(r.id for r in d.collect()) == sorted(r[3] for r in rows)
    some = indexed.read_vcf(spark, str(tmp_path / "v.vcf.gz"), [("chr10", 5, 900_000)])
    assert sorted(r.id for r in some.collect()) == sorted(r[3] for r in rows if r[0] == "chr10" and r[1] < 900_000 and r[2] > 5)


def test_bed(spark, tmp_path):
    rows = [("a", i * 3, i * 3 + 2) for i in range(5000)] + [("b", 5, 5)]
    indexed.write_bed(spark.createDataFrame(rows, "grp string, s long, e long"), str(tmp_path / "b"))
    assert sorted(tuple(r) for r in indexed.read_bed(spark, str(tmp_path / "b"), split_bytes=4000).collect()) == rows
    assert sorted(tuple(r) for r in indexed.read_bed(spark, str(tmp_path / "b"), [("b", 5, 6), ("a", 2, 4)]).collect()) == [("a", 3, 5), ("b", 5, 5)]


def test_empty_table_and_unsorted_rows(spark, tmp_path):
    df, _ = table(spark, 5)
    indexed.write_vcf(df.limit(0), HEADER, str(tmp_path / "e"))
    assert indexed.read_vcf(spark, str(tmp_path / "e")).count() == 0
    builder = indexed.IndexBuilder("vcf")
    builder.add("a", 5, 6, 0, 9)
    for chrom, pos in (("a", 4), ("a", 1 << 29)):
        with pytest.raises(ValueError):
            builder.add(chrom, pos, pos + 1, 9, 12)
    builder.add("b", 1, 2, 9, 12)
    with pytest.raises(ValueError):
        builder.add("a", 9, 10, 12, 15)
