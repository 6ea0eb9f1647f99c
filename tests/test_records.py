"""Files, genotype arrays, blocks, copy-number gates and means on small fixtures."""

import gzip
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from strandflow.functions import genotypes, somatic
from strandflow.operators import blocks, copynumber, neighbours
from strandflow.sources import index, text

HEADER = ["##fileformat=VCFv4.2", '##FILTER=<ID=low,Description="Low, by ""rule""">', '##INFO=<ID=DP,Number=1,Type=Integer,Description="Depth">', "##contig=<ID=c1,length=1000>", "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\ttum\tnorm"]
RECORDS = ["c1\t5\t.\tA\tC,G\t12.5\tlow;old\tDP=3;STR\tGT:AD:AF\t0/1:3,4,5:0.5\t0/0:.:.", "c1\t9\trs1\tAT\tA\t.\tPASS\t.\tGT\t0/1\t.", "c2\t1\t.\tA\t.\t40\tPASS\tDP=1\tGT\t0/0\t0/0"]


@pytest.fixture
def vcf(tmp_path):
    path = tmp_path / "a.vcf"
    path.write_text("\n".join(HEADER + RECORDS) + "\n")
    return str(path)


def test_vcf_round_trip(spark, vcf, tmp_path):
    text.write_vcf(text.read_vcf(spark, vcf), HEADER, str(tmp_path / "out"), compression="gzip")
    files = sorted((tmp_path / "out").glob("*.gz"))
    parts = [gzip.open(f, "rt").read().splitlines() for f in files]
    assert all(p[: len(HEADER)] == HEADER for p in parts if p)
    records = [x for p in parts for x in p if not x.startswith("#")]
    assert records == [RECORDS[0].replace("GT:AD:AF", "GT:AD:AF"), *RECORDS[1:]]
    read = lambda p: sorted(map(str, text.read_vcf(spark, p).collect()))
    assert read(str(tmp_path / "out")) == read(vcf)


def test_header(spark, vcf):
    rows = {(r.kind, r.id): r for r in text.read_header(spark, vcf).collect()}
    assert set(rows) == {("FILTER", "low"), ("INFO", "DP"), ("contig", "c1")}
    assert rows["INFO", "DP"].number == "1" and rows["INFO", "DP"].type == "Integer" and rows["contig", "c1"].length == 1000
    assert text.sample_names(spark, vcf) == ["tum", "norm"]
    h = text.read_header(spark, vcf)
    assert [r.id for r in text.added_declarations(h.filter("kind <> 'INFO'"), h).collect()] == ["DP"]


def test_somatic_on_a_file(spark, vcf):
    d = somatic.samples(text.read_vcf(spark, vcf), ["tum", "norm"], "tum", "norm")
    out = {r.pos: r["filter"] for r in somatic.filtered(d, clear=["old"], min_depth=13, min_tumor_af=0.6, max_normal_af=0.0, min_qual=13).collect()}
    assert out == {4: ["low", "low_allele_frac", "low_depth", "low_qual"], 8: ["PASS"], 0: ["PASS"]}
    assert {r.pos: r["filter"] for r in somatic.filtered(d, "amplicon", min_qual=50).collect()}[0] == ["low_qual"]
    with pytest.raises(ValueError):
        somatic.filtered(d, min_quality=1)
    with pytest.raises(ValueError):
        somatic.samples(d, ["tum"], "norm")
    marked = somatic.flag(d, [("q", "qual < 13"), ("deep", "info['DP'] > 2")])
    assert {r.pos: r["filter"] for r in marked.collect()} == {4: ["low", "old", "q", "deep"], 8: ["PASS"], 0: ["PASS"]}
    assert {r.pos: r["filter"] for r in somatic.unflag(marked, "old").collect()}[4] == ["low", "q", "deep"]


def test_fasta_chunks(spark, tmp_path):
    one, two = "acgtac" * 7, "GGT"
    (tmp_path / "g.fa").write_text(">c1 first\n" + "\n".join(one[i : i + 9] for i in range(0, len(one), 9)) + "\n>c2\n" + two + "\n")
    rows = sorted((r.chrom, r.chunk, r.seq) for r in text.read_fasta(spark, str(tmp_path / "g.fa"), width=8).collect())
    want = [(c, i // 8, s.upper()[i : i + 8]) for c, s in (("c1", one), ("c2", two)) for i in range(0, len(s), 8)]
    assert rows == want


def test_contigs_strata_regions(spark, tmp_path):
    (tmp_path / "g.fai").write_text("c1\t100\t5\t60\t61\nc2\t7\t9\t60\t61\n")
    assert [tuple(r) for r in text.read_contigs(spark, str(tmp_path / "g.fai")).collect()] == [("c1", 0, 100), ("c2", 0, 7)]
    (tmp_path / "x.hdr").write_text("@HD\tVN:1.6\n@SQ\tSN:c1\tLN:100\n@SQ\tSN:HLA:1\tLN:7\tM5:a:b\n")
    assert [r.length for r in text.read_sam_header(spark, str(tmp_path / "x.hdr")).orderBy("tid").collect()] == [100, 7]
    (tmp_path / "a.bed").write_text("c1\t1\t5\n")
    (tmp_path / "list.tsv").write_text("easy\ta.bed\n\nhard\t" + str(tmp_path / "a.bed") + "\n")
    assert sorted(r.stratum for r in text.read_strata(spark, str(tmp_path / "list.tsv")).collect()) == ["easy", "hard"]
    assert [tuple(r) for r in text.regions(spark, "c1:1-10,HLA:2:5-9").collect()] == [("c1", 0, 10), ("HLA:2", 4, 9)]


def test_bam_header(spark, tmp_path):
    names = [f"contig{i}" for i in range(20_000)]
    body = b"BAM\1" + struct.pack("<I", 3) + b"@HD" + struct.pack("<I", len(names)) + b"".join(struct.pack("<I", len(n) + 1) + n.encode() + b"\0" + struct.pack("<I", i) for i, n in enumerate(names))

    def block(data):
        z = zlib.compressobj(1, zlib.DEFLATED, -15)
        packed = z.compress(data) + z.flush()
        return struct.pack("<4BI2BH2BHH", 31, 139, 8, 4, 0, 0, 255, 6, 66, 67, 2, len(packed) + 25) + packed + struct.pack("<II", zlib.crc32(data), len(data))

    data = b"".join(block(body[i : i + 60_000]) for i in range(0, len(body), 60_000))
    (tmp_path / "a.bam").write_bytes(data)
    rows = index.read_bam_header(spark, str(tmp_path / "a.bam")).orderBy("tid").collect()
    assert [(r.name, r.length) for r in rows] == [(n, i) for i, n in enumerate(names)]
    (tmp_path / "b.bam").write_bytes(data[:3000])
    with pytest.raises(ValueError):
        index.read_bam_header(spark, str(tmp_path / "b.bam"))


def test_genotype_arrays(spark):
    one = spark.range(1)
    lit = lambda xs, t="int": F.lit(None).cast(f"array<{t}>") if xs is None else F.array(*map(F.lit, xs)).cast(f"array<{t}>")
    get = lambda c: one.select(c.alias("x")).first().x
    assert get(genotypes.subset(lit([1, 2, 3]), "R", lit([2]))) == [1, 3]
    assert get(genotypes.subset(lit([10, 11, 12, 13, 14, 15]), "G", lit([2]))) == [10, 13, 15]
    assert get(genotypes.subset(lit([10, 11, 12]), "G", lit([2]), ploidy=1)) == [10, 12]
    assert get(genotypes.subset(lit(None), "A", lit([1]))) is None and get(genotypes.subset(lit([4]), "1", lit([1]))) == [4]
    assert tuple(get(genotypes.trimmed_all(F.lit("CATT"), lit(["GATT", "CTT"], "string")))) == ("CA", ["GA", "C"])
    assert tuple(get(genotypes.cut_all(F.lit("CATT"), lit(["GA", "CTT"], "string")))) == ("CAT", ["G", "CT"])
    assert [get(genotypes.renumbered(F.lit(g).cast("string"), lit([1, 3]))) for g in ("3", "2", "0", None)] == ["2", "0", "0", None]
    assert get(genotypes.best_pair(lit(["C", "G"], "string"), lit([9, 1, 5, 3, 7, 8]))) == [1, 2]
    assert get(genotypes.best_pair(lit(["C", "G"], "string"), lit([9, 1]))) is None
    carried = F.struct(F.lit("A").alias("ref"), F.lit("C").alias("alt"))
    absent = F.lit(None).cast("struct<ref:string,alt:string>")
    none = F.lit(None).cast("string")
    assert tuple(get(genotypes.likelihood(F.lit("AT"), lit(["G", "CT"], "string"), lit([5, 6, 7]), carried))) == (2, 7)
    assert tuple(get(genotypes.likelihood(F.lit("AT"), lit(["G"], "string"), lit([5, 6]), absent))) == (0, 5)
    assert tuple(get(genotypes.likelihood(none, lit(None, "string"), lit(None), absent))) == (0, 0)
    assert get(genotypes.likelihood(none, lit(None, "string"), lit(None), carried)).allele == -1


def test_joined_fields(spark):
    t = "dp int, ad array<int>, rpa array<int>, str boolean, ru string"
    rows = [((3, [1, 2], [4, 5], True, "AT"), (4, [2, 2], None, None, None), False), ((3, [1, 2], [4, 5], None, None), (4, [2, 2], [6, 7], True, "T"), True), (None, (4, [0, 2], None, None, None), None)]
    d = spark.createDataFrame(rows, f"a struct<{t.replace(' ', ':').replace(',:', ',')}>, b struct<{t.replace(' ', ':').replace(',:', ',')}>, same boolean")
    out = [tuple(r.x) for r in d.select(genotypes.joined_fields(F.col("a"), F.col("b"), F.col("same")).alias("x")).collect()]
    assert out == [(7, [3, 2, 2], [4, 5, 0], True, "AT"), (7, [3, 4], [6, 7], True, "T"), (4, None, None, None, None)]


def test_blocks_keep_their_own_bounds(spark):
    rows = [("c", 0, 10, 1, "A", [blocks.ANY], "0/0"), ("c", 10, 20, 2, "A", [blocks.ANY], "0/0"), ("c", 12, 13, 3, "A", ["C", blocks.ANY], "0/1"), ("c", 15, 16, 4, "A", ["C", blocks.ANY], "0/1")]
    schema = "grp string, s long, e long, id long, ref string, alt array<string>, gt string"
    calls, called = spark.createDataFrame(rows, schema), spark.createDataFrame([("c", 12, 14, 9, "AT", ["C"], "1/1"), ("c", 8, 11, 8, "ATT", ["C"], "1/1")], schema)
    out = sorted((r.s, r.e, r.id, r.gt) for r in blocks.combine(calls, called).collect())
    assert out == [(0, 8, 1, "0/0"), (8, 11, 8, "1/1"), (10, 12, 2, "0/0"), (12, 14, 9, "1/1"), (14, 20, 2, "0/0"), (15, 16, 4, "0/0")]
    assert sorted((r.s, r.e) for r in blocks.clipped(calls, 5, 15).collect()) == [(5, 10), (10, 15), (12, 13)]
    assert blocks.combine(calls.limit(0), called.limit(0)).count() == 0


def test_copy_number_gates(spark):
    d = spark.createDataFrame([(None, 3, 100, None, True), (1, 3, 100, 20, True), (None, None, 100, 60, True), (4, None, 100, None, False)], "a int, b int, size int, period int, inside boolean")
    cn = copynumber.copy_number(F.col("a"), F.col("b"))
    out = d.select(cn, copynumber.copy_number(F.col("a"), F.col("b"), difference=True), copynumber.event_class(cn), copynumber.truth_gate(F.col("size"), F.col("period"), F.col("inside"), 50), copynumber.call_gate(cn, F.col("size"), F.col("inside"), 50))
    assert [tuple(r) for r in out.collect()] == [(3, 5, "Gain", True, True), (1, 3, "Loss", False, True), (2, 2, "Neutral", True, False), (4, 6, "Gain", False, False)]
    tags = spark.createDataFrame([(["PASS"],), (["cnvLength"],), (["other", "PASS"],), ([],), (None,)], "t array<string>")
    assert [r[0] for r in tags.select(copynumber.accepted(F.col("t"))).collect()] == [True, True, False, True, True]
    events = spark.createDataFrame([("c", 0, 10, 1), ("c", 5, 5, 2), ("d", 0, 4, 3)], "grp string, s long, e long, id long")
    spans = spark.createDataFrame([("c", 0, 6), ("c", 4, 8)], "grp string, s long, e long")
    assert {r.id: (r.fraction, r.inside, r.any) for r in copynumber.confident(events, spans).collect()} == {1: (0.8, False, True), 2: (0.0, False, False), 3: (0.0, False, False)}
    assert copynumber.confident(events, None).filter("inside").count() == 3


def test_codon_rule_and_member_means(spark):
    names = [c.split()[0] for c in neighbours.COLUMNS.split(", ")]
    v = [("c", 3, 1, "A", "C", "GGGGG", 10.0, True, False, "p"), ("c", 5, 2, "A", "C", "GGGGG", 20.0, True, False, "p"), ("c", 6, 3, "A", "C", "GGGGG", None, True, False, "p")]
    d = spark.createDataFrame(v, neighbours.COLUMNS)
    codons = spark.createDataFrame([("c", p, f"k{p // 3}") for p in range(9)], "chrom string, pos long, codon string")
    coded = neighbours.with_codons(d, codons)
    out = neighbours.merge_neighbours(coded, rule=neighbours.share_codon(), extra="codons array<string>").select(*names, "merged", "members", "ids")
    joint = out.filter("members > 1").collect()
    assert [(r.ids, r.ref, r.alt, r.qual) for r in joint] == [([1, 2], "AGA", "CGC", 15.0)]
    fields = spark.createDataFrame([(1, "c", [0.5, 0.1], [3, 4], 7), (2, "c", [0.25, 0.3], [4, 5], 8), (3, "c", None, None, None)], "id long, chrom string, af array<double>, ad array<int>, afdp int")
    r = neighbours.member_means(out, fields, ["af"], ["ad", "afdp"]).first()
    assert r.id == 1 and r.af == pytest.approx([0.375, 0.2]) and r.ad == [3, 4] and r.afdp == 7
    assert not neighbours.share_codon(True)({"ref": "AT", "alt": "A", "codons": ["x"]}, {"ref": "A", "alt": "C", "codons": ["x"]})
