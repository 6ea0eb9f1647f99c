"""Whole runs from small files, against results worked out by hand."""

import struct
import zlib

import pytest

from strandflow import flows
from strandflow.operators import intervals, positional
from strandflow.sources import index, text

COLUMNS = "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\ts1\n"


def vcf(path, *rows, head="##fileformat=VCFv4.2\n##contig=<ID=chr2>\n##contig=<ID=chr1>\n"):
    path.write_text(head + COLUMNS + "".join("\t".join(map(str, r)) + "\n" for r in rows))
    return str(path)


def lines(spark, path):
    """Records of a written file or folder, in the order of files."""
    return [r.value.split("\t") for r in spark.read.text(str(path)).collect() if not r.value.startswith("#")]


def test_copy_number_evaluation(spark, tmp_path):
    t = vcf(
        tmp_path / "t.vcf",
        ("chr1", 101, "a", "N", "<DEL>", ".", "PASS", "REFSTART=10000;REFSTOP=20000;SVLEN=10000;CNDIFF=-1", "GT", "0/1"),
        ("chr1", 201, "b", "N", "<DUP>", ".", "PASS", "REFSTART=50000;REFSTOP=60000;SVLEN=10000;CNDIFF=1;DIST=0.99", "GT", "0/1"),
        ("chr1", 301, "c", "N", "<DUP>", ".", "lowq", "REFSTART=70000;REFSTOP=80000;SVLEN=10000;CNDIFF=1", "GT", "0/1"),
        ("chr1", 401, "d", "N", "<DUP>", ".", "PASS", "REFSTART=90000;REFSTOP=99000;SVLEN=9000;CNDIFF=1;DIST=0.5", "GT", "0/1"),
    )
    c = vcf(
        tmp_path / "c.vcf",
        ("chr1", 10001, "x", "N", "<DEL>", ".", "PASS", "END=14000;CN=1", "GT", "0/1"),
        ("chr1", 15001, "y", "N", "<DEL>", ".", "PASS", "END=16000;SVLEN=1000", "GT:CN", "0/1:1"),
        ("chr1", 50001, "z", "N", "<DEL>", ".", "PASS", "END=60000;CN=1", "GT", "0/1"),
        ("chr1", 200001, "w", "N", "<DUP>", ".", "PASS", "END=210000;CN=4", "GT", "0/1"),
        ("chr1", 300001, "v", "N", "<DUP>", ".", "PASS", "END=310000;CN=2", "GT", "0/1"),
        ("chrX", 300001, "u", "N", "<DUP>", ".", "PASS", "END=310000;CN=4", "GT", "0/1"),
    )
    # chrX is none of the truth set's contigs: its calls count nowhere, in strata neither
    (tmp_path / "odd.bed").write_text("chr1\t0\t100000\nchrX\t0\t400000\n")
    (tmp_path / "strata.txt").write_text("low\todd.bed\n\n")
    got = flows.evaluate_copy_numbers(spark, t, c, strata=str(tmp_path / "strata.txt"), out=str(tmp_path / "out"), out_truth=str(tmp_path / "ot"), out_call=str(tmp_path / "oc"))
    table = {r.dir: (r.tp_t, r.fn, r.tp_c, r.fp) for r in got["summary"].collect()}
    # a is found (5000 of 10000), b is not (its call has the other direction), d is too near others; x and y count as one event
    assert table == {None: (1, 1, 1, 2), "Loss": (1, 0, 1, 1), "Gain": (0, 1, 0, 1)}
    assert {(r.stratum, r.dir): (r.tp_t, r.fn, r.tp_c, r.fp) for r in got["strata"].collect()} == {("low", None): (1, 1, 1, 1), ("low", "Loss"): (1, 0, 1, 1), ("low", "Gain"): (0, 1, 0, 0)}
    # the first cut gives way to the least size
    assert {(r.bin, r.dir): r.tp_c for r in got["by_length"].collect()}.items() >= {("5000-50000", "Loss"): 1, ("50000-100000", "Loss"): 0}.items()
    calls = {r[2]: dict(x.partition("=")[::2] for x in r[7].split(";")) for r in lines(spark, tmp_path / "oc")}
    assert set(calls) == {"x", "y", "z", "w"} and calls["x"]["EVAL"] == "TP" and calls["x"]["TRUTH"] == "10000-20000" and calls["z"]["EVAL"] == "FP" and calls["w"]["COMP"] == "chr1:200000-210000"
    truths = {r[2]: dict(x.partition("=")[::2] for x in r[7].split(";")) for r in lines(spark, tmp_path / "ot")}
    assert truths["a"]["CALL"] == "10000-14000,15000-16000" and truths["a"]["CALLSIZE"] == "4000,1000" and truths["b"]["EVAL"] == "FN" and "EVAL" not in truths["d"] and "c" not in truths
    flows.label_copy_numbers(spark, t, c, str(tmp_path / "labels"))
    labels = {r[2]: r[7].split("LABEL=")[1].split(";")[0] for r in lines(spark, tmp_path / "labels")}
    assert labels == {"x": "1", "y": "1", "z": "3", "w": "2", "v": "2", "u": "2"}


def test_somatic_filter(spark, tmp_path):
    head = '##fileformat=VCFv4.2\n##contig=<ID=chr2>\n##contig=<ID=chr1>\n##FILTER=<ID=triallelic_site,Description="x">\n'
    v = vcf(tmp_path / "v.vcf", ("chr1", 5, ".", "A", "C", 10, "triallelic_site", "SOR=4", "GT", "0/1"), ("chr1", 5, ".", "A", "G", 300, ".", "PV=0.01", "GT", "0/1"), ("chr2", 9, ".", "A", "G", 300, "PASS", "SOR=1", "GT", "0/1"), head=head)
    flows.filter_somatic(spark, v, str(tmp_path / "o"), "s1", preset="amplicon")
    assert [(r[0], r[5], r[6]) for r in lines(spark, tmp_path / "o")] == [("chr2", "300", "PASS"), ("chr1", "300", "PASS"), ("chr1", "10", "low_qual;strand_bias")]
    out = [r.value for r in spark.read.text(str(tmp_path / "o")).collect()]
    assert not any("triallelic" in x for x in out) and any(x.startswith("##FILTER=<ID=strand_bias,") for x in out)
    with pytest.raises(ValueError):
        flows.filter_somatic(spark, v, str(tmp_path / "p"), "nobody")


def test_tag_chain(spark, tmp_path):
    head = '##fileformat=VCFv4.2\n##contig=<ID=chr1>\n##FILTER=<ID=triallelic_site,Description="x">\n##FILTER=<ID=old,Description="y">\n'
    v = vcf(
        tmp_path / "v.vcf",
        ("chr1", 5, ".", "A", "C", 300, "triallelic_site", "PV=0.3;PV2=0.3;SOR=1", "GT:FOXOG", "0/1:0.5"), ("chr1", 6, ".", "A", "C", 199, "old", "PV=0.06;STR;RPA=10,11", "GT:FOXOG", "0/1:1"),
        ("chr1", 7, ".", "A", "C", ".", "PASS", "PV=.;SOR=3;ECNT=5", "GT:ReadPosRankSumPS", "0/1:-8"), ("chr1", 8, ".", "A", "C", 300, "PASS", "SOR=3.1;ECNT=6", "GT:ReadPosRankSumPS", "0/1:-8.5"), head=head,
    )
    flows.flag_somatic(spark, v, str(tmp_path / "o"), "s1")
    assert [r[6] for r in lines(spark, tmp_path / "o")] == ["insignificant", "old;insignificant;orientation_bias;low_qual;short_tandem_repeat", "PASS", "strand_bias;noisy_region;read_pos_bias"]
    out = [r.value for r in spark.read.text(str(tmp_path / "o")).collect()]
    assert not any("triallelic" in x for x in out) and any(x.startswith("##FILTER=<ID=low_qual,") and "QUAL < 200" in x for x in out)
    flows.flag_somatic(spark, v, str(tmp_path / "p"), "s1", min_qual=100)
    assert "low_qual" not in [t for r in lines(spark, tmp_path / "p") for t in r[6].split(";")]


def test_merge_neighbouring(spark, tmp_path):
    (tmp_path / "r.fa").write_text(">chr1 x\nACGTACGTAC\nGTACGT\n>chr2\nTTTT\n")
    v = vcf(
        tmp_path / "v.vcf",
        ("chr1", 3, "a", "G", "A,C", 30, "PASS", "DP=10;X=q", "GT:PS:AF:AD", "0|1:7:0.5,0.25:10,5,1"),
        ("chr1", 6, "b", "C", "T,G", 50, "PASS", "DP=21", "GT:PS:AF:AD", "0|1:7:0.25,0.75:5,4,2"),
        ("chr1", 14, "c", "C", "T", 50, "PASS", "DP=2", "GT:PS", "0|1:7"),
    )
    flows.merge_neighbouring(spark, v, str(tmp_path / "r.fa"), str(tmp_path / "o"))
    got = lines(spark, tmp_path / "o")
    assert [(r[1], r[2], r[3], r[4], r[6]) for r in got] == [("3", ".", "GTAC", "ATAT,CTAG", "PASS"), ("3", "a", "G", "A,C", "MERGED"), ("6", "b", "C", "T,G", "MERGED"), ("14", "c", "C", "T", "PASS")]
    assert got[0][5] == "40" and got[0][7] == "DP=15.5" and dict(zip(got[0][8].split(":"), got[0][9].split(":"))) == {"GT": "0|1", "PS": "7", "AF": "0.375,0.5", "AD": "7,4"}
    (tmp_path / "e.bed").write_text("chr1\t1\t4\tT1.2\nchr1\t5\t8\tT1.3\nchr1\t13\t14\tT2.1\n")
    flows.codon_file(spark, str(tmp_path / "e.bed"), str(tmp_path / "codons"))
    assert [r.value for r in spark.read.text(str(tmp_path / "codons")).orderBy("value").collect()] == ["chr1:2\tT1-Codon1", "chr1:3\tT1-Codon1", "chr1:4\tT1-Codon1", "chr1:6\tT1-Codon2", "chr1:7\tT1-Codon2", "chr1:8\tT1-Codon2"]
    flows.merge_neighbouring(spark, v, str(tmp_path / "r.fa"), str(tmp_path / "o2"), codons=str(tmp_path / "codons"))
    assert [r[6] for r in lines(spark, tmp_path / "o2")] == ["PASS"] * 3


def test_merged_means_of_every_sample(spark, tmp_path):
    (tmp_path / "r.fa").write_text(">chr1\nACGTACGTACGT\n")
    head = "##fileformat=VCFv4.2\n##contig=<ID=chr1>\n"
    rows = [("chr1", 3, "a", "G", "A", 30, "PASS", ".", "GT:PS:AF:AD:AFDP", "0|1:7:0.5:10,5:9", "0|1:7:0.1:8,3:5"), ("chr1", 5, "b", "A", "T", 50, "PASS", ".", "GT:PS:AF:AD:AFDP", "0|1:7:0.25:5,4:2", "0|1:7:.:5,4:8")]
    text_ = head + "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\ts1\ts2\n" + "".join("\t".join(map(str, r)) + "\n" for r in rows)
    (tmp_path / "v.vcf").write_text(text_)
    flows.merge_neighbouring(spark, str(tmp_path / "v.vcf"), str(tmp_path / "r.fa"), str(tmp_path / "o"))
    got = lines(spark, tmp_path / "o")[0]
    one, two = (dict(zip(got[8].split(":"), x.split(":"))) for x in got[9:])
    assert (got[3], got[4]) == ("GTA", "ATT") and one == {"GT": "0|1", "PS": "7", "AF": "0.375", "AD": "7,4", "AFDP": "5"}
    # a member without AF leaves the first one's
    assert two == {"GT": "0|1", "PS": "7", "AF": "0.1", "AD": "6,3", "AFDP": "6"}


def test_combine_blocks(spark, tmp_path):
    g = vcf(tmp_path / "g.vcf", ("chr1", 1, ".", "A", "<NON_REF>", ".", ".", "END=100", "GT", "0/0"), ("chr1", 120, ".", "A", "C,<NON_REF>", ".", ".", "DP=1", "GT", "0/1"), ("chr1", 130, ".", "A", "C,<NON_REF>", ".", ".", "DP=1", "GT", "0/1"))
    v = vcf(tmp_path / "v.vcf", ("chr1", 11, ".", "ACGTACGTAC", "A", 9, ".", ".", "GT", "0/1"), ("chr1", 16, ".", "ACGTACGTACACGTA", "A", 9, ".", ".", "GT", "0/1"), ("chr1", 120, ".", "A", "G", 9, ".", ".", "GT", "1/1"))
    flows.combine_blocks(spark, g, v, str(tmp_path / "o"))
    got = [(r[1], r[4], r[7], r[9]) for r in lines(spark, tmp_path / "o")]
    # the second variant starts in what the first has cut out, so it cuts nothing itself
    assert got == [("1", "<NON_REF>", "END=10", "0/0"), ("11", "A,<NON_REF>", ".", "0/1"), ("16", "A,<NON_REF>", ".", "0/1"), ("21", "<NON_REF>", "END=100", "0/0"), ("120", "G,<NON_REF>", ".", "1/1"), ("130", "C,<NON_REF>", "DP=1", "0/0")]


def test_patch_and_merge_haplotypes(spark, tmp_path):
    row = lambda pos, ref, alt, gt, pl="9,0", gq=30, info=".", tags="PASS": ("chr1", pos, ".", ref, alt, 20, tags, info, "GT:GQ:PL:AD", f"{gt}:{gq}:{pl}:3,4")
    v1 = vcf(tmp_path / "v1.vcf", row(5, "A", "C", "1"), row(9, "A", "C", "0", "0,9"), row(20, "A", "C", "1", info="ML_PROB=3;STR;RU=A;RPA=5,6"))
    v2 = vcf(tmp_path / "v2.vcf", row(7, "A", "T", "1"), row(9, "A", "C", "0", "0,9"))
    d1 = vcf(tmp_path / "d1.vcf", row(5, "AT", "CT", "1"), row(30, "A", "G", "1"))
    d2 = vcf(tmp_path / "d2.vcf", row(7, "A", "G", "1"), row(30, "A", "G", "."))
    flows.patch_haplotypes(spark, v1, v2, d1, d2, str(tmp_path / "o1"), str(tmp_path / "o2"))
    # at 5 the same allele is patched, at 7 another one is not, both are sure at 9, no genotype at 30 on the second
    assert [(r[1], r[3], r[4], r[7]) for r in lines(spark, tmp_path / "o1")] == [("5", "AT", "CT", "DELTA"), ("20", "A", "C", "DELTA;RPA=5,6;RU=A;STR"), ("30", "A", "G", "DELTA")]
    assert [(r[1], r[4], r[7]) for r in lines(spark, tmp_path / "o2")] == [("7", "T", ".")]
    p = vcf(tmp_path / "p.vcf", row(5, "AT", "A", "0|1", "9,0,9"), row(7, "A", "T", "0|1", "9,0,9"))
    u = vcf(tmp_path / "u.vcf", row(40, "A", "T", "0/1", "9,0,9", info="DELTA"), row(41, "A", "T", "0/1", "9,0,9"))
    (tmp_path / "b.bed").write_text("chr1\t2\t10\n")
    flows.merge_haplotypes(spark, p, str(tmp_path / "o1"), str(tmp_path / "o2"), u, str(tmp_path / "m"), str(tmp_path / "b.bed"))
    got = [(r[1], r[3], r[4], dict(zip(r[8].split(":"), r[9].split(":")))["GT"]) for r in lines(spark, tmp_path / "m")]
    assert got == [("5", "A", "C", "1|0"), ("7", "A", "T", "0|1"), ("20", "A", "C", "0/1"), ("30", "A", "G", "0/1"), ("40", "A", "T", "0/1")]


COUNTED = (
    '##fileformat=VCFv4.2\n##contig=<ID=chr1>\n##INFO=<ID=AC,Number=A,Type=Integer,Description="x">\n##INFO=<ID=AF,Number=A,Type=Float,Description="x">\n##INFO=<ID=AN,Number=1,Type=Integer,Description="x">\n'
    '##INFO=<ID=DP,Number=1,Type=Integer,Description="x">\n##INFO=<ID=QD,Number=1,Type=Float,Description="x">\n##INFO=<ID=MQ,Number=1,Type=Float,Description="x">\n##INFO=<ID=RPA,Number=R,Type=Integer,Description="x">\n##INFO=<ID=RU,Number=1,Type=String,Description="x">\n'
    '##INFO=<ID=STR,Number=0,Type=Flag,Description="x">\n##INFO=<ID=MLEAC,Number=A,Type=Integer,Description="x">\n##FORMAT=<ID=AD,Number=R,Type=Integer,Description="x">\n##FORMAT=<ID=PL,Number=G,Type=Integer,Description="x">\n##FORMAT=<ID=DP,Number=1,Type=Integer,Description="x">\n'
)


def sample(r):
    return dict(zip(r[8].split(":"), r[9].split(":")))


def test_patch_keeps_two_alleles_and_renumbers(spark, tmp_path):
    rec = lambda pos, alt, gt, pl, info: ("chr1", pos, ".", "A", alt, 20, "q", info, "GT:GQ:PL:AD", f"{gt}:30:{pl}:9,1,2,3,4")
    v1 = vcf(tmp_path / "v1.vcf", rec(5, "C,G,T,AA", "3", "90,20,40,0,60", "AC=1,2,3,4;ML_PROB=1;DELTA"), rec(6, "C,G,T,AA", "4", "90,20,40,0,60", "AC=1,2,3,4"), rec(7, "C,G", "2", "90,20,0", "AC=1,2"), head=COUNTED)
    none = vcf(tmp_path / "n.vcf", head=COUNTED)
    d1 = vcf(tmp_path / "d1.vcf", rec(6, "AA,T,G,C", "1", "90,0,40,20,60", "AC=4,3,2,1"), head=COUNTED)
    flows.patch_haplotypes(spark, v1, none, d1, none, str(tmp_path / "o1"), str(tmp_path / "o2"))
    got = [(r[1], r[3], r[4], r[7], sample(r)) for r in lines(spark, tmp_path / "o1")]
    assert got == [
        ("5", "A", "T,C", "AC=3,1;DELTA", {"GT": "1", "GQ": "30", "PL": "90,0,20", "AD": "9,3,1"}),
        ("6", "A", "AA,G", "AC=4,2;DELTA", {"GT": "1", "GQ": "30", "PL": "90,0,20", "AD": "9,1,3"}),
        ("7", "A", "C,G", "AC=1,2", {"GT": "2", "GQ": "30", "PL": "90,20,0", "AD": "9,1,2,3,4"}),
    ]
    assert lines(spark, tmp_path / "o2") == []


def test_patch_of_one_phased_file(spark, tmp_path):
    rec = lambda pos, ref, alt, gt, info="STR;RU=A;RPA=7,8,9": ("chr1", pos, ".", ref, alt, 20, "q", info, "GT:GQ:PL:AD", f"{gt}:30:50,1,2,3,4,5:9,1,2")
    v = vcf(tmp_path / "v.vcf", rec(5, "AC", "A,ACC", "1|2"), rec(6, "A", "C,G", "0|2"), rec(7, "A", "C,G", "1/2"), rec(8, "A", "C,G", "2/2"), rec(9, "A", "C,G", "1|2"), head=COUNTED)
    d1 = vcf(tmp_path / "d1.vcf", ("chr1", 9, ".", "A", "C", 20, ".", ".", "GT:GQ:PL:AD", "1:30:9,0:1,2"), head=COUNTED)
    d2 = vcf(tmp_path / "d2.vcf", ("chr1", 9, ".", "A", "C", 20, ".", ".", "GT:GQ:PL:AD", "1:30:9,0:1,2"), head=COUNTED)
    flows.patch_haplotypes(spark, v, None, d1, d2, str(tmp_path / "o1"), str(tmp_path / "o2"))
    got = [[(r[1], r[3], r[4], r[7], sample(r)["GT"], sample(r)["PL"], sample(r)["AD"]) for r in lines(spark, tmp_path / o)] for o in ("o1", "o2")]
    # split records keep repeats unmarked; an unphased genotype of two alleles has no side
    assert got[0] == [("5", "AC", "A", "RPA=7,8;RU=A;STR", "1", "50,1", "9,1"), ("8", "A", "G", "RPA=7,9;RU=A;STR", "1", "50,3", "9,2"), ("9", "A", "C", "DELTA", "1", "9,0", "1,2")]
    assert got[1] == [("5", "A", "AC", "RPA=7,9;RU=A;STR", "1", "50,3", "9,2"), ("6", "A", "G", "RPA=7,9;RU=A;STR", "1", "50,3", "9,2"), ("8", "A", "G", "RPA=7,9;RU=A;STR", "1", "50,3", "9,2"), ("9", "A", "G", "RPA=7,9;RU=A;STR", "1", "50,3", "9,2")]


def test_joined_records_take_what_belongs_to_them(spark, tmp_path):
    hap = lambda pos, alt, gt, dp, ad, info: ("chr1", pos, "x", "A", alt, 20, ".", info, "GT:GQ:PL:AD:DP", f"{gt}:30:9,0:{ad}:{dp}")
    h1 = vcf(tmp_path / "h1.vcf", hap(5, "C,G", "2", 7, "1,2,3", "DELTA;DP=7;MQ=9;RPA=4,5,6;STR;RU=A"), hap(6, "C", "1", 7, "0,3", "DELTA;DP=5"), hap(7, "C", "0", 7, "1,3", "DELTA"), head=COUNTED)
    h2 = vcf(tmp_path / "h2.vcf", hap(5, "T", "1", 7, "2,5", "DP=8;RPA=4,9"), hap(6, "C", "1", 4, "0,4", "DP=6"), hap(7, "AT", "1", 3, "2,9", "DP=3;RU=T"), head=COUNTED)
    v = vcf(tmp_path / "v.vcf", ("chr1", 6, "rs", "AT", "A", 90, ".", "DP=50;QD=3;MQ=60;MLEAC=1;AN=2;RPA=3,4;OWN=1", "GT:GQ:PL:AD", "0|1:1:2:3"), head=COUNTED)
    u = vcf(tmp_path / "u.vcf", ("chr1", 9, ".", "A", "T", 20, ".", "DELTA;DP=4", "GT:GQ", "0/1:5"), head=COUNTED)
    (tmp_path / "b.bed").write_text("chr1\t5\t10\n")
    flows.merge_haplotypes(spark, v, h1, h2, u, str(tmp_path / "m"), str(tmp_path / "b.bed"))
    got = [(*r[1:6], r[7], sample(r)) for r in lines(spark, tmp_path / "m")]
    assert got == [
        # the allele that the genotype names; depths and repeats added; no phased record, so none of a haplotype's own fields
        ("5", ".", "A", "G,T", "40", "AC=1,1;AF=0.5,0.5;DP=15;RPA=4,6,9;RU=A;STR", {"GT": "1/2", "AD": "3,3,5", "DP": "14"}),
        # the phased record's fields stay, but QD and those by allele; its repeats stay where there are no others
        ("6", "rs", "A", "C", "40", "AC=2;AF=1.0;AN=2;DP=50;MQ=60;OWN=1;RPA=3,4", {"GT": "1|1", "PS": "5", "DP": "11"}),
        ("7", ".", "A", "AT", "20", "AC=1;AF=0.5;DP=3;RU=T", {"GT": "0|1", "PS": "5", "AD": "2,9", "DP": "3"}),
        ("9", ".", "A", "T", "20", "DP=4", {"GT": "0/1", "GQ": "5"}),
    ]


def test_patch_unphased(spark, tmp_path):
    head = '##fileformat=VCFv4.2\n##contig=<ID=chr2>\n##contig=<ID=chr1>\n##INFO=<ID=AC,Number=A,Type=Integer,Description="x">\n##FORMAT=<ID=AD,Number=R,Type=Integer,Description="x">\n##FORMAT=<ID=PL,Number=G,Type=Integer,Description="x">\n'
    row = lambda pos, ref, alt, gt, pl, ad, gq=30, info=".", chrom="chr1": (chrom, pos, ".", ref, alt, 20, "lowq", info, "GT:GQ:PL:AD", f"{gt}:{gq}:{pl}:{ad}")
    v = vcf(
        tmp_path / "v.vcf", row(5, "A", "C", "0/1", "9,0,9", "3,4", info="ML_PROB=3"), row(7, "A", "T", "0/1", "9,0,9", "3,4"), row(9, "A", "C", "0/1", "9,0,9", "3,4"),
        row(20, "AGG", "CGG,A,TGG", "1/3", "90,80,70,60,50,40,30,0,20,10", "1,2,3,4", info="AC=1,2,3;ML_PROB=1"), row(25, "A", "C,G", "0/1", "9,0,9", "3,4,5"), row(40, "A", "C", "0/0", "0,9,9", "3,4"), head=head,
    )
    d = vcf(
        tmp_path / "d.vcf", row(5, "AT", "CT", "0/1", "9,0,9", "5,6"), row(7, "A", "G", "0/1", "9,0,9", "5,6"), row(9, "A", "C", "./.", "9,0,9", "5,6"),
        row(30, "A", "G", "0/0", "0,9,9", "5,6"), row(31, "A", "G", "0/0", "0,9,9", "5,6", gq=19), row(3, "A", "C,G", "1/1", "50,40,0,60,70,80", ".", chrom="chr2", info="AC=2,0"), head=head,
    )
    flows.patch_unphased(spark, v, d, str(tmp_path / "o"))
    got = [(r[0], r[1], r[3], r[4], r[6], r[7], dict(zip(r[8].split(":"), r[9].split(":")))) for r in lines(spark, tmp_path / "o")]
    of = lambda gt, pl, ad, gq="30": {"GT": gt, "GQ": gq, "PL": pl, "AD": ad}
    # at 20 genotype 1/3 is likeliest and alleles are cut by one length; 25 lacks likelihoods; 30 is surely the reference
    assert got == [
        ("chr2", "3", "A", "C", "PASS", "AC=2;DELTA", of("1/1", "50,40,0", ".")),
        ("chr1", "5", "AT", "CT", "PASS", "DELTA", of("0/1", "9,0,9", "5,6")),
        ("chr1", "7", "A", "T", "PASS", ".", of("0/1", "9,0,9", "3,4")),
        ("chr1", "9", "A", "C", "PASS", ".", of("0/1", "9,0,9", "3,4")),
        ("chr1", "20", "A", "C,T", "PASS", "AC=1,3", of("1/2", "90,80,70,30,0,10", "1,2,4")),
        ("chr1", "31", "A", "G", "PASS", "DELTA", of("0/0", "0,9,9", "5,6", "19")),
        ("chr1", "40", "A", "C", "PASS", ".", of("0/0", "0,9,9", "3,4")),
    ]


def bam_header(path, contigs):
    data = b"BAM\1" + struct.pack("<I", 0) + struct.pack("<I", len(contigs)) + b"".join(struct.pack("<I", len(n) + 1) + n.encode() + b"\0" + struct.pack("<I", size) for n, size in contigs)
    c = zlib.compressobj(wbits=-15)
    body = c.compress(data) + c.flush()
    path.write_bytes(b"\x1f\x8b\x08\x04" + bytes(6) + b"\x06\0BC\x02\0" + struct.pack("<H", len(body) + 25) + body + struct.pack("<II", zlib.crc32(data), len(data)))


def test_memory(spark, tmp_path):
    rows = [(0, 4681, 0, 100 << 16), (0, 4682, 0, 50 << 16), (0, 4681 + 61, 0, 70 << 16), (0, None, 0, 0), (0, None, 61, 0), (1, 4681, 0, 10 << 16), (1, None, 0, 0)]
    d = spark.createDataFrame(rows, "tid int, bin long, s long, e long")
    for name, extra in (("a.bam.bai", 0), ("b.bai", 1)):
        index.write_bai(d.withColumn("e", d["e"] + (extra << 16) * d["bin"].eqNullSafe(4682).cast("int")), str(tmp_path / name))
    again = index.read_bai(spark, str(tmp_path / "a.bam.bai")).filter("bin IS NOT NULL").select("tid", "bin", "s", "e").collect()
    assert sorted(map(tuple, again)) == sorted(r for r in rows if r[1] is not None)
    bam_header(tmp_path / "a.bam", [("chr1", 1_100_000), ("chr2", 10)])
    (tmp_path / "b.bam.hdr").write_text("@HD\tVN:1\n@SQ\tSN:chr1\tLN:900\n@SQ\tSN:chr2\tLN:9\n")
    got = [tuple(r) for r in flows.memory(spark, [str(tmp_path / "a.bam"), str(tmp_path / "b.bam")], 3).collect()]
    # slot 61 lies in both fragments of chr1 and counts twice
    assert [x for x, _ in got] == ["chr1", "chr2"] and got[0][1] * (1 << 30) / 8 == pytest.approx(200 + 140 + 140) and got[1][1] * (1 << 30) / 8 == pytest.approx(20)
    one = flows.memory(spark, [str(tmp_path / "a.bam")], 1, ["chr1:1-10,chr2:1-5"], calibrated=True).collect()
    assert one[0].shard == "chr1:1-10,chr2:1-5" and one[0].gigabytes * (1 << 30) / 16 == pytest.approx(100)
    assert [tuple(r) for r in index.offsets(index.read_bai(spark, str(tmp_path / "b.bai"))).select("tid", "first", "last").orderBy("tid").collect()] == [(0, 0, 100 << 16), (1, 0, 10 << 16)]


def test_one_hot_group_of_long_intervals(spark):
    """A million rows of one group, intervals of a megabase and of one base: bins and stretches stay few."""
    n = 1_000_000
    short = spark.range(n, numPartitions=8).selectExpr("'a' AS grp", "id * 200 AS s", "id * 200 + 50 AS e")
    long = spark.range(100, numPartitions=2).selectExpr("'a' AS grp", "id * 2000000 AS s", "id * 2000000 + 1000000 AS e")
    assert intervals.merge(short).count() == n
    pairs = intervals.overlap_join(long, short).groupBy().sum("overlap").first()[0]
    assert pairs == intervals.intersect(long, short).selectExpr("sum(e - s)").first()[0] == 100 * 5000 * 50
    assert intervals.subtract(short, long).count() == n - 100 * 5000


def test_intervals_against_brute_force(spark):
    import random

    pick = random.Random(7)
    make = lambda n: [(pick.choice("ab"), s, s + pick.choice([0, 1, 3, 50, 5000, 200_000, 3_000_000])) for s in (pick.randrange(-300_000, 300_000) for _ in range(n))]
    a, b = make(60), make(60)
    x, y = (spark.createDataFrame(d, "grp string, s long, e long") for d in (a, b))
    want = sorted((g, s, e, t, f) for g, s, e in a for h, t, f in b if g == h and s < f and t < e)
    assert sorted((r["grp"], r["as"], r["ae"], r["bs"], r["be"]) for r in intervals.overlap_join(x, y).collect()) == want

    def union(d):
        out = []
        for g, s, e in sorted(d):
            if out and out[-1][0] == g and s <= out[-1][2]:
                out[-1][2] = max(out[-1][2], e)
            else:
                out.append([g, s, e])
        return [tuple(o) for o in out]

    assert sorted((r.grp, r.s, r.e) for r in intervals.merge(x).collect()) == sorted(union(a))
    cut = union([(g, max(s, t), min(e, f)) for g, s, e in union(a) for h, t, f in union(b) if g == h and max(s, t) < min(e, f)])
    assert sorted(tuple(r) for r in intervals.intersect(x, y).collect()) == sorted(cut)


def test_adjacent_runs_cross_blocks(spark):
    rows = [(i, "ab"[i // 5 % 2]) for i in range(40)]
    got = sorted((r.line, r.run) for r in positional.adjacent_runs(spark.createDataFrame(rows, "line long, v string"), "v", "line", block=2).collect())
    assert got == [(i, i // 5 + 1) for i in range(40)]


def test_sources(spark, tmp_path):
    v = vcf(tmp_path / "v.vcf", ("chr1", 5, ".", "ACG", "C", ".", ".", "XEND=9;END=40", "GT", "0/1"), ("chr1", 6, ".", "ACG", "C", ".", ".", "XEND=9", "GT", "0/1"))
    assert [(r.end) for r in text.read_vcf(spark, [v, v]).orderBy("record").collect()] == [40, 8, 40, 8]
    (tmp_path / "r.fa").write_text("".join(f">c{i}\n{'ACGT' * 3}\n{'TT'}\n" for i in range(3000)))
    got = {r.chrom: r.seq for r in text.read_fasta(spark, str(tmp_path / "r.fa")).collect()}
    assert len(got) == 3000 and set(got.values()) == {"ACGTACGTACGTTT"}
