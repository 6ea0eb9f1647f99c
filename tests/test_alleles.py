"""Normal forms of alleles against a plain walk, one base at a time."""

import random

from strandflow.operators import alleles

WIDTH = 40
SCHEMA = "chrom string, pos long, ref string, alt string, n int"


def plain(seq, pos, ref, alt):
    """Trim and move by the definition: while both end alike drop that base, adding the base before when one runs empty."""
    r, a = ref, alt
    if r == a:
        return pos, ref, alt
    while True:
        if r and a and r[-1] == a[-1]:
            r, a = r[:-1], a[:-1]
        elif (not r or not a) and pos > 0:
            pos -= 1
            r, a = seq[pos] + r, seq[pos] + a
            if r[-1] != a[-1]:
                break
        else:
            break
    while len(r) > 1 and len(a) > 1 and r[0] == a[0]:
        r, a, pos = r[1:], a[1:], pos + 1
    if not r or not a:  # at the contig's start
        after = seq[pos + len(r) : pos + len(r) + 1]
        r, a = r + after, a + after
    return pos, r, a


def chunks(spark, seqs):
    return spark.createDataFrame([(c, i // WIDTH, s[i : i + WIDTH]) for c, s in seqs.items() for i in range(0, len(s), WIDTH)], "chrom string, chunk long, seq string")


def test_normal_form(spark, monkeypatch):
    monkeypatch.setattr(alleles, "CONTEXT", 3)
    r = random.Random(3)
    seqs = {"a": "CACACACACA" * 30 + "".join(r.choices("ACGT", k=200)), "b": "A" * 150 + "".join(r.choices("AC", k=300))}
    rows = []
    for n in range(1500):
        c = r.choice("ab")
        pos, size = r.randrange(len(seqs[c]) - 30), r.randrange(1, 12)
        ref = seqs[c][pos : pos + size]
        alt = r.choice([ref[:1], ref + ref[-2:], ref[: size // 2 + 1], "".join(r.choices("AC", k=r.randrange(1, 9))), ref])
        rows.append((c, pos, ref.lower() if n % 7 == 0 else ref, alt, n))
    got = {x.n: (x.npos, x.nref, x.nalt) for x in alleles.normalized(spark.createDataFrame(rows, SCHEMA), chunks(spark, seqs), WIDTH).collect()}
    want = {n: plain(seqs[c], pos, ref.upper(), alt) if ref.upper() != alt else (pos, ref, alt) for c, pos, ref, alt, n in rows}
    assert got == want


def test_equal_changes_share_an_id(spark):
    seqs = {"a": "GGCACACACATT"}
    known = spark.createDataFrame([("a", 1, "GCA", "G", "rs2"), ("a", 1, "GCA", "G", "rs1"), ("a", 1, "G", "GCA", "rs3"), ("a", 0, "G", "<DEL>", "rs4")], "chrom string, pos long, ref string, alt string, name string")
    rows = [("a", 7, "ACA", "A", 0), ("a", 5, "ACACATT", "ACATT", 1), ("a", 9, "A", "ACA", 2), ("a", 3, "A", "T", 3), ("a", 0, "G", "<DEL>", 4), (None, 1, "G", "GCA", 5), ("a", 1, None, "G", 6)]
    got = {x.n: x.id for x in alleles.with_allele_ids(spark.createDataFrame(rows, SCHEMA), known, chunks(spark, seqs), WIDTH).collect()}
    assert got == {0: "rs1", 1: "rs1", 2: "rs3", 3: None, 4: "rs4", 5: None, 6: None}
    assert alleles.with_allele_ids(spark.createDataFrame([], SCHEMA), known, chunks(spark, seqs), WIDTH).count() == 0
