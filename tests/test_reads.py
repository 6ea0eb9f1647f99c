"""Duplicates, metrics, read structures and consensus of reads against plain versions."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strandflow.operators import reads

SCHEMA = "name string, chrom string, pos long, cigar string, reverse boolean, seq string, qual string, insert long, n int"


def plain_five(chrom, pos, cigar, reverse):
    ops = [(int(n), o) for n, o in re.findall(r"(\d+)([MIDNSHP=X])", cigar or "")]
    if chrom is None or pos is None or not ops:
        return None
    lead, trail = 0, 0
    for n, o in ops:
        if o not in "SH":
            break
        lead += n
    for n, o in reversed(ops):
        if o not in "SH":
            break
        trail += n
    return pos + sum(n for n, o in ops if o in "MDN=X") + trail - 1 if reverse else pos - lead


def plain_marked(rows):
    by = {}
    for r in rows:
        five = plain_five(*r[1:5])
        if r[0] is not None and five is not None:
            by.setdefault(r[0], []).append(((r[1], five, r[4]), sum(q for c in r[6] or "" if (q := ord(c) - 33) >= 15)))
    by = {k: v for k, v in by.items() if len(v) <= 2}
    pairs, single, held = {}, {}, set()
    for name, v in by.items():
        ends = tuple(sorted(e for e, _ in v))
        (pairs if len(v) == 2 else single).setdefault(ends, []).append((-sum(s for _, s in v), name))
        held |= set(ends) if len(v) == 2 else set()
    stay = {min(v)[1] for v in pairs.values()} | {min(v)[1] for e, v in single.items() if e[0] not in held}
    return [plain_five(*r[1:5]) is not None and r[0] in by and r[0] not in stay for r in rows]


def made(n, seed=1):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        cigar = r.choice(["10M", "2S8M", "3H2S6M", "8M2S", "4M1D2I4M", "5=1X4N5M", "*", None, "10S"])
        size = r.randrange(1, 14)
        qual = "".join(chr(33 + r.randrange(42)) for _ in range(size))
        rows.append((r.choice([f"r{i // 2}", f"r{i}", None]), r.choice(["c1", "c1", "c2", None]), r.randrange(6), cigar, r.random() < 0.5, "".join(r.choices("ACGTN", k=size)), qual, r.choice([None, -5, 7, 9]), i))
    return rows + [("x", "c1", 1, "10M", False, "A", "I", 1, n + k) for k in range(3)] + [("y", "c1", 1, "10M", False, None, None, None, n + 3)]


def test_duplicates(spark):
    rows = made(500)
    d = spark.createDataFrame(rows, SCHEMA)
    got = {r.n: r.duplicate for r in reads.marked(d).collect()}
    assert [got[r[-1]] for r in rows] == plain_marked(rows) and sum(got.values()) > 50
    assert reads.without_duplicates(d).count() == len(rows) - sum(got.values())
    assert reads.marked(d.limit(0)).count() == 0


def test_metrics_in_one_scan(spark):
    rows = made(300, 2)
    d = reads.metrics(spark.createDataFrame(rows, SCHEMA).repartition(5))
    plan = d._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInPandas") == 1 and plan.count("Scan ") == 1
    want = Counter()
    total = Counter()
    for _, chrom, _, cigar, reverse, seq, qual, insert, _ in rows:
        q = [ord(c) - 33 for c in qual or ""]
        for k, x in enumerate(q[::-1] if reverse else q, 1):
            want["quality_by_cycle", str(k)] += 1
            total[str(k)] += x
            want["quality", str(x)] += 1
        if seq:
            want["gc", str(100 * sum(c in "GC" for c in seq) // len(seq))] += 1
        if insert and insert > 0:
            want["insert_size", str(insert)] += 1
        ops = [(int(n), o) for n, o in re.findall(r"(\d+)([MIDNSHP=X])", cigar or "")]
        values = [1, chrom is not None, chrom is not None and reverse, len(seq or ""), *(sum(n for n, o in ops if o in k) for k in ("M=X", "I", "D", "SH"))]
        want.update({("alignment", k): int(v) for k, v in zip(reads.ALIGNMENT, values)})
    got = d.collect()
    assert {(r.metric, r.key): r.n for r in got} == {k: v for k, v in want.items() if v}
    assert {r.key: r.total for r in got if r.metric == "quality_by_cycle"} == dict(total)


def test_read_structures(spark):
    d = spark.createDataFrame([("ACGTTTGG", "ABCDEFGH"), ("ACGTT", "ABCDE"), ("ACG", "ABC"), ("ACGTT", "ABC"), (None, None)], "seq string, qual string")
    one = [tuple(r) for r in d.select(*reads.structured(F.col("seq"), F.col("qual"), "2M1S1M+T").values()).collect()]
    assert one == [("AC-T", "TTGG", "EFGH"), ("AC-T", "T", "E"), (None, None, None), (None, None, None), (None, None, None)]
    assert [r[0] for r in d.limit(2).select(reads.structured(F.col("seq"), F.col("qual"), "3T2S1M")["template"]).collect()] == ["ACG", None]
    for wrong in ("", "3M", "M3T", "+M3T", "3M2X4T", "0M3T", "3M 2T"):
        with pytest.raises(ValueError):
            reads.structured(F.col("seq"), F.col("qual"), wrong)


def plain_families(tags):
    up = {}
    for t, n in tags.items():
        above = [(-m, u) for u, m in tags.items() if len(u) == len(t) and sum(a != b for a, b in zip(u, t)) == 1 and m >= 2 * n - 1 and (m > n or u < t)]
        if above:
            up[t] = min(above)[1]

    def root(t):
        return root(up[t]) if t in up else t

    return {t: root(t) for t in tags}


def test_families_of_tags(spark):
    r = random.Random(4)
    tags = Counter("".join(r.choices("ACGT", k=4)) for _ in range(400)) + Counter({"AAAA": 900, "AAAC": 300, "AACC": 100, "ACCC": 30, "CCCC": 10, "T": 1, "G": 1, "": 5})
    d = spark.createDataFrame([(g, t, n) for g in ("x", "y") for t, n in tags.items()], "grp string, tag string, n int")
    got = {(x.grp, x.tag): x.family for x in reads.tag_families(d, "grp").collect()}
    want = plain_families(tags)
    assert want["CCCC"] == "AAAA" and got == {(g, t): f for g in ("x", "y") for t, f in want.items()}


def test_consensus(spark):
    rows = [("f", "ACGT", "IIII"), ("f", "ACGA", "II5+"), ("f", "AGG", "I!5"), ("g", "AC", "!!"), ("g", "CA", "!!"), ("h", "AC", "I"), ("h", None, None)]
    got = {r.family: (r.seq, [ord(c) - 33 for c in r.qual], r.reads) for r in reads.consensus(spark.createDataFrame(rows, "family string, seq string, qual string"), "family").collect()}
    # f: C has 80 against 0, G 80, T 40 against 10; g: a tie goes to the least base
    assert got == {"f": ("ACGT", [60, 60, 60, 30], 3), "g": ("AA", [2, 2], 2)}
    assert reads.consensus(spark.createDataFrame(rows, "family string, seq string, qual string"), "family", least=3).count() == 1
