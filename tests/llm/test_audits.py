"""Merkle manifest, filter interaction and byte-pair encoding against plain versions, with the odd cases."""

import hashlib
import random
import zlib
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strandflow.llm import bpe, interaction, merkle
from strandflow.llm.queries import word_vocabulary

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = SCHEMA + ", k int, words string, digest string, lev int, ids string, leaf long"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def plain_manifest(rows):
    """(doc_id, leaf) -> (subroot, root, hash of the proof, folded root) by building each tree in memory."""

    def leaf(r, text):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r[0], r[3], r[2], r[4], text)))

    def tree(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([sha("".join(levels[-1][i : i + 3])) for i in range(0, len(levels[-1]), 3)])
        return levels

    def climb(levels, at, h, proof):
        for nodes in levels[:-1]:
            first = at - at % 3
            run = nodes[first : first + 3]
            proof += run[: at - first] + run[at - first + 1 :]
            run = [*run[: at - first], h, *run[at - first + 1 :]]
            at, h = at // 3, sha("".join(run))
        return h

    by: dict = {}
    for r in rows:
        by.setdefault(r[3], []).append((r[0] is not None, r[0] or 0, leaf(r, r[1]), r))
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[2] for x in sorted(by[s], key=lambda x: x[:3])]) for s in sources}
    top = tree([trees[s][-1][0] for s in sources])
    out = Counter()
    for k, s in enumerate(sources):
        for at, (_, _, h, r) in enumerate(sorted(by[s], key=lambda x: x[:3])):
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
            proof: list = []
            folded = climb(trees[s], at, leaf(r, r[1].replace("\n", "")) if hit and r[1] is not None else h, proof)
            folded = climb(top, k, folded, proof)
            out[r[0], h, trees[s][-1][0], top[-1][0], sha("".join(proof)), folded, folded == top[-1][0]] += 1
    return out


ROWS = [
    *[(i, f"text {i}\nline\n", "en", "hot", i) for i in range(40)], (None, "no id\n", None, "hot", None), (3, "text 3\nline\n", "en", "hot", 3), (3, "other\n", "de", "hot", 3),
    (50, None, "en", None, 7), (51, "", "", "", 0), (52, "é\n" * 50_000, "fr", "ünit", 3), *[(100 + i, "x\ny", "en", f"s{i}", i) for i in range(12)],
]


def manifest_rows(df):
    return Counter((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in merkle.verified(merkle.manifest(df)).collect())


@pytest.mark.parametrize("level", [1, 2, 7])
def test_manifest(spark, monkeypatch, level):
    monkeypatch.setattr(merkle, "BLOCK_LEVEL", level)
    got = manifest_rows(spark.createDataFrame([(*r, 1, "w", "d", 2, "i", 3) for r in ROWS], CLASHING).repartition(3))
    assert got == plain_manifest(ROWS)


def test_manifest_of_few(spark):
    key = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(key, None)
    assert manifest_rows(spark.createDataFrame([], SCHEMA)) == Counter()
    for rows in ([ROWS[0]], ROWS[:2], [ROWS[0], ROWS[43]]):
        assert manifest_rows(spark.createDataFrame(rows, SCHEMA)) == plain_manifest(rows)
    assert spark.conf.get(key, None) == before


def test_depth(spark):
    sizes = [1, 2, 3, 4, 9, 10, 27, 28, 3**20, 3**20 + 1]
    got = [r[0] for r in spark.createDataFrame([(n, i) for i, n in enumerate(sizes)], "n long, i int").orderBy("i").select(merkle.depth_of(F.col("n"))).collect()]
    assert got == [merkle.depth(n) for n in sizes] == [0, 1, 1, 2, 2, 3, 3, 4, 20, 21]


def plain_audit(docs, labels):
    marks = {c: {r[0] for r in labels if r[n] == 1 and r[0] is not None} for c, n in (("good", 1), ("toxic", 2))}
    least: dict = {}
    for i, text, *_ in docs:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    rows = []
    for i, text, lang, *_ in docs:
        t = text or ""
        w = t.encode().split()
        fails = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t), "D": any(c in "#$%&*|" for c in t), "E": i is not None and i > least[t]}
        rows.append((lang or "", {f for f in fails if fails[f]}, i in marks["good"], i in marks["toxic"]))
    out = {}
    for part in {r[0] for r in rows}:
        removed = Counter()
        for order in map("".join, permutations("ABCDE")):
            for step, f in enumerate(order, 1):
                n = Counter()
                for p, fails, good, toxic in rows:
                    if p == part:
                        gone = bool(fails & set(order[: step - 1]))
                        here = f in fails and not gone
                        n.update(kept=not gone and f not in fails, removed=here, redundant=f in fails and gone, unique=fails == {f}, good=here and good, toxic=here and toxic)
                removed[f] += n["removed"]
                out[part, order, step] = [n["kept"], n["removed"], n["redundant"], n["unique"], n["good"], n["toxic"]]
        for (p, order, step), x in out.items():
            if p == part:
                x.append(removed[order[step - 1]])
    return out


LONG = " ".join(f"w{i}" for i in range(200))
def test_pipeline_of_odd_rows(spark):
    """Nulls in every column, repeated rows, a long text, clashing names, and an empty table go through all stages."""
    import corpus_pipeline
    from strandflow.llm.common import keep

    prose = lambda n: " ".join(f"the word{i} of plain{i * n} text and number{i}" for i in range(40))
    rows = [(1, prose(1), "en", "a", 9), (1, prose(1), "en", "a", 9), (None, prose(2), None, None, None), (2, None, "en", "a", 0), (3, "", "en", "b", 0), (4, " \n", "en", "b", 3), (5, " ".join(f"the long{i} text" for i in range(40_000)), "en", "b", 1), (6, prose(3) + " mail a.b@c.de", "en", None, 1)]
    for table in (rows, []):
        docs = spark.createDataFrame([(*r, 1, "w", "d", 2, "i", 3) for r in table], CLASHING)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            columns = docs.columns
            docs = keep(stage(spark, docs, ""), "odd")
            assert docs.columns == columns
        texts = {r.text for r in docs.select("text").distinct().collect()}
        assert texts == ({prose(1), prose(2), rows[6][1], prose(3) + " mail [EMAIL]"} if table else set())
        pieces = corpus_pipeline.STAGES[-1][1](spark, docs, "").collect()
        assert {r.doc_id for r in pieces} == ({1, None, 5, 6} if table else set())


DOCS = [
    (1, LONG, "en", None, 0), (2, LONG, "en", None, 0), (2, LONG, "de", None, 0), (1, LONG, "de", None, 0), (3, None, None, None, 0), (4, "", "", None, 0), (None, LONG, "en", None, 0), (None, "", None, None, 0),
    (5, "A" * 30 + " b #", "en", None, 0), (6, "word " * 150, "en", None, 0), (7, LONG + " $ É É", "fr", None, 0), (8, "x" * 300_000, "en", None, 0), (9, LONG.upper(), "en", None, 0), *[(20 + i, "same text", "en", None, 0) for i in range(30)],
]
LABELS = [(1, 1, 0), (1, 0, 1), (2, 1, None), (6, None, 1), (None, 1, 1), (25, 1, 1), (999, 1, 1)]


def test_audit(spark):
    d = spark.createDataFrame([(*r, 1, "w", "d", 2, "i", 3) for r in DOCS], CLASHING).repartition(3)
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    got = {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley] for r in interaction.audit(d, labels).collect()}
    assert got == plain_audit(DOCS, LABELS)


def test_audit_of_nothing(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert interaction.audit(spark.createDataFrame([], SCHEMA), labels).count() == 0
    assert interaction.audit(spark.createDataFrame(DOCS[:1], SCHEMA), labels).count() == 600


@pytest.fixture(scope="module")
def coder():
    return bpe.encoder(word_vocabulary()), bpe.decoder(word_vocabulary()), Tokenizer.from_file(word_vocabulary())


def test_prefix_encoder_equals_the_library(coder):
    ours, back, library = coder
    r = random.Random(5)
    texts = ["", " \n", "ΑΣ ΟΔΟΣ İstanbul ǅ", "é x́", "a<|endoftext|>b <|startoftext|><|ENDOFTEXT|>", "\x1c\x1d a\x85b　c", "don't 12345 ½² !!!??? 🎉🎉", "日本語 テキスト", "a\x00b", "x" * 3000, "aa" * 700 + "b", "ÀÉ naïve Straße"]
    texts += ["".join(r.choice("aabbeeinthrsolm ") for _ in range(r.randint(1, 60))) for _ in range(1500)]
    texts += ["".join(r.choice(["ab", "a", "lo", "ha!", "é'", "01s", "'re", "the", "!?.", "日本"]) for _ in range(r.randint(1, 60))) for _ in range(500)]
    texts += ["".join(chr(r.choice([r.randint(1, 0x24F), r.randint(0x250, 0xD7FF), r.randint(0x10000, 0x1FFFF)])) for _ in range(r.randint(1, 30))) for _ in range(800)]
    for t in texts:
        ids = ours.encode(t)
        want = library.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want, t
        assert back.decode(ids) == library.decode(want, skip_special_tokens=False)


def test_one_last_token_for_each_prefix(coder):
    ours = coder[0]
    word = "internationalization"
    word = word[:-1] + chr(ord(word[-1]) + bpe.LAST)
    ends: dict = {-1: {None}}
    for end, token in ours.automaton.iter(word):
        before = end - ours.lengths[token]
        for last in ends.get(before, ()):
            if last is None or ours.compatible(last, token):
                ends.setdefault(end, set()).add(token)
    assert all(len(x) == 1 for x in ends.values()) and len(ends) == len(word) + 1


def test_encode_and_decode(spark, coder, monkeypatch):
    library = coder[2]
    monkeypatch.setattr(bpe, "BATCH_BYTES", 50)
    rows = [(1, "Some words, some more.", "en", "s", 1), (1, "Some words, some more.", "en", "s", 1), (None, "no id", None, None, None), (2, None, "en", "s", 1), (3, "", "en", "s", 1), (4, "long " * 40_000, "en", "s", 1)]
    d = spark.createDataFrame([(*r, 1, "w", "d", 2, "i", 3) for r in rows], CLASHING)
    path = word_vocabulary()
    got = Counter((r.doc_id, bytes(r.ids), r.decoded) for r in bpe.decode(bpe.encode(d, path), path).collect())
    want = Counter()
    for i, t, *_ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want[i, np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False)] += 1
    assert got == want
    assert bpe.decode(bpe.encode(d.limit(0), path), path).count() == 0
