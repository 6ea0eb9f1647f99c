"""Operators against plain versions on small tables, with the odd cases that each must survive."""

import hashlib
import zlib

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from strandflow.llm import embeddings, gbdt, minhash, mixing, packing, pii, quality_classifier, quality_rules, suffix_dedup, url_filter, warc
from strandflow.llm.common import scratch_path
from strandflow.llm.queries import vocabulary

PROSE = " ".join(f"word{i % 97} of plain{i} text and the number{i}" for i in range(60))
ODD = [
    (1, PROSE, "src0"), (2, None, None), (3, "", "src1"), (4, " \n\t", "src0"), (5, PROSE, "src0"), (5, PROSE, "src0"), (6, PROSE + " and a few more", "src1"),
    (7, "x" * 30_000, "src0"), (8, "mail a.b@c.de or +1 (743) 555-3824, 10.0.0.1, 4111 1111 1111 1111 é", "src2"), (None, "no id here", "src2"), (9, "a b", "src1"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", s, len(t or ""), "clash", 0, True) for i, t, s in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, key string, size int, kept boolean")


@pytest.fixture(scope="module")
def empty(spark, docs):
    return docs.limit(0)


def test_quality_rules(docs, empty):
    got = {(r.doc_id, r.n_words, r.kept) for r in quality_rules.quality_rules(docs).collect()}
    assert {(2, 0, False), (3, 0, False), (4, 0, False), (7, 1, False)} <= got and (1, len(PROSE.split()), True) in got
    assert quality_rules.quality_rules(empty).count() == 0
    assert quality_rules.passing(docs).columns == docs.columns and quality_rules.passing(docs).count() == 4


def test_repeated_windows(spark):
    d = spark.createDataFrame([(1, "a b c d a b c x a b c"), (2, "a a a a"), (3, "p\nq\np\n\n")], "doc_id long, text string")
    got = {r.doc_id: (r.n_repeat_words, r.n_dup_lines) for r in quality_rules.quality_rules(d).collect()}
    assert got == {1: (9, 0), 2: (4, 0), 3: (0, 1)}


def test_url_filter(spark):
    urls = [(1, "http://www.EXAMPLE.com/en/77?q"), (2, "http://a.com/en/"), (3, None), (4, "no scheme"), (5, "x://com/en/1"), (6, "x://example.net/de/81"), (7, "x://notcom/en/"), (1, "http://www.EXAMPLE.com/en/77?q"), (None, "ftp://q.org/es/a://b")]
    got = sorted(((r.page_id, r.host, r.rule, r.verdict) for r in url_filter.url_filter(spark.createDataFrame(urls, "page_id long, url string"), url_filter.rule_frame(spark)).collect()), key=str)
    want = [(1, "www.example.com", "example.com/en/7", "allow")] * 2 + [(2, "a.com", "com/en/", "block"), (3, "", None, "allow"), (4, "", None, "allow"), (5, "com", "com/en/", "block"), (6, "example.net", "example.net/de/8", "block"), (7, "notcom", None, "allow"), (None, "q.org", "org/es/", "block")]
    assert got == sorted(want, key=str)


def test_url_rules_of_the_contract(spark):
    """Each rule's word, in the operator and in its SQL, on a url that only this rule decides."""
    import duckdb

    urls = [(1, "x://a.com/en/1"), (2, "x://example.com/en/71"), (3, "x://a.net/de/1"), (4, "x://net/de/"), (5, "x://example.net/de/1"), (6, "x://www.example.net/de/8"), (7, "x://a.org/es/1")]
    want = [(1, "com/en/", "block"), (2, "example.com/en/7", "allow"), *((i, "net/de/", "allow") for i in (3, 4, 5)), (6, "example.net/de/8", "block"), (7, "org/es/", "block")]
    rows = url_filter.url_filter(spark.createDataFrame(urls, "page_id long, url string"), url_filter.rule_frame(spark), default="neither")
    assert sorted((r.page_id, r.rule, r.verdict) for r in rows.collect()) == want
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?)", urls)
    assert sorted((r[0], r[3], r[4]) for r in con.execute(url_filter.oracle()).fetchall()) == want


def test_warc_round_trip(spark):
    long_ = "é<p>" * 20_000
    rows = [(3, "http://a\nb", long_), (1, None, None), (2, "u", "short"), (4, "u", "short"), (9, "u", long_), (9, "u", long_), (None, "u", long_)]
    got = sorted((r.page_id or 0, r.length, r.digest, r.kind, r.refers_to, r.complete) for r in warc.archive_round_trip(spark.createDataFrame(rows, "page_id long, url string, html string")).collect())
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    n = len(long_.encode())
    assert got == [(0, n, sha(long_), "revisit", 3, True), (1, 0, sha(""), "response", None, True), (2, 5, sha("short"), "response", None, True), (3, n, sha(long_), "response", None, True), (4, 5, sha("short"), "response", None, True)] + [(9, n, sha(long_), "revisit", 3, True)] * 2
    assert warc.unchunked(warc.chunked(b"abc" * 50, 7)) == b"abc" * 50 and warc.unchunked(b"5\r\nabc") is None


def test_warc_empty_and_extra_columns(spark):
    d = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.archive_round_trip(d).count() == 0
    d = spark.createDataFrame([(1, "u", "<p>", "x", 5, "y")], "page_id long, url string, html string, digest string, n int, first string")
    assert [(r.page_id, r.length, r.complete) for r in warc.archive_round_trip(d).collect()] == [(1, 3, True)]


def test_warc_two_writes_read_together(spark):
    d = spark.createDataFrame([(1, "u", "<p>" * 9000)], "page_id long, url string, html string")
    paths = [scratch_path(spark, "warc-test") for _ in range(2)]
    for k, path in enumerate(paths):
        warc.write_archives(d.withColumn("page_id", F.col("page_id") + k), path)
    got = sorted((r.page_id, r.length, r.complete) for r in warc.read_archives(spark, paths).collect())
    assert got == [(1, 27_000, True), (2, 27_000, True)]


def rewritten(spark, edit, rows=((1, "u", "<p>" * 9000),), **options):
    """Archives of rows, each changed by edit(bytes), read back."""
    import glob
    import gzip

    path = scratch_path(spark, "warc-test")
    warc.write_archives(spark.createDataFrame(list(rows), "page_id long, url string, html string").coalesce(1), path, **options)
    for name in glob.glob(path.removeprefix("file://") + "/*.gz"):
        with open(name, "rb") as f:
            raw = edit(gzip.decompress(f.read()))
        with open(name, "wb") as f:
            f.write(raw if raw[:2] in (b"", b"no") else gzip.compress(raw))
        import os

        crc = os.path.join(os.path.dirname(name), f".{os.path.basename(name)}.crc")
        if os.path.exists(crc):
            os.remove(crc)
    return sorted(((r.page_id, r.kind, r.digest is not None, r.complete) for r in warc.read_archives(spark, path).collect()), key=str)


def test_warc_damage(spark):
    """Swapped segments are put in order; missing or cut ones make a record incomplete; a damaged archive counts up to the damage."""
    mark = b"WARC/1.1\r\n"
    parts = lambda raw: [mark + x for x in raw.split(mark)[1:]]
    good = [(1, "response", True, True)]
    assert len(parts(b"")) == 0 and rewritten(spark, lambda raw: b"".join(parts(raw)[::-1])) == good
    assert rewritten(spark, lambda raw: b"".join(parts(raw)[:1] + parts(raw)[2:])) == [(1, "response", False, False)]
    assert rewritten(spark, lambda raw: b"".join(parts(raw)[:-1])) == [(1, "response", False, False)]
    assert rewritten(spark, lambda raw: b"".join(parts(raw)[1:])) == [(None, "continuation", False, False)]
    assert rewritten(spark, lambda raw: raw[:-100]) == [(1, "response", False, False)]
    assert rewritten(spark, lambda raw: raw + b"rubbish\r\n") == sorted([*good, (None, "damaged", False, False)], key=str)
    assert rewritten(spark, lambda raw: b"no gzip") == [(None, "damaged", False, False)]
    assert rewritten(spark, lambda raw: raw, [(i, "u", f"<p>{i}" * 3000) for i in range(9)], archive_records=4) == sorted([(i, "response", True, True) for i in range(9)], key=str)


def test_pii_base_and_redaction(docs, empty):
    text = "a@b.c_d@e.f 1.2.3.4.5.6.7.8 999.1.1.1 4111111111111112 +12 " + "@" * 300 + "1" * 5000
    assert pii.base_spans(text) == {"email": [(0, 5), (5, 11)], "ip": [(12, 19), (20, 27)], "card": [], "phone": []}
    r = next(r for r in pii.detect(docs).collect() if r.doc_id == 8)
    assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == (1, 1, 1, 1)
    assert pii.detect(empty).count() == 0
    got = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert got[8] == "mail [EMAIL] or [PHONE], [IP], [CARD] é" and got[2] is None and got[1] == PROSE


def pii_corpus(n=300):
    """Prose with base matches of every kind, on which the selector learns."""
    import random

    pick = random.Random(5)
    card = lambda: next(f"4{x:014d}{c}" for x in [pick.randrange(10**14)] for c in range(10) if pii.luhn(f"4{x:014d}{c}"))
    rows = []
    for i in range(n):
        w = [f"word{pick.randrange(50)}x" for _ in range(40)]
        data = [f"jo.smith{pick.randrange(99)}@mail{pick.randrange(9)}.example.com", ".".join(str(pick.randrange(256)) for _ in range(4)), card(), f"+1 ({pick.randrange(1000):03d}) 555-{pick.randrange(10000):04d}"]
        w.insert(pick.randrange(40), data[i % 4])
        rows.append((i, " ".join(w)))
    return rows


def test_pii_equals_plain_patterns(spark):
    """Counts, digest and order of base spans on odd strings and on whole documents; selected spans keep them."""
    import random

    pick = random.Random(3)
    parts = ["a", "b.c", "@", ".", "+", "-", " ", "(", ")", "1", "22", "255", "256", "4111111111111111", "4111 1111-1111 1111", "+1 555 123 4567", "10.0.0.1", "x@y.z", "\u0661\u0662", "\u00e9", "\n", "%", "_"]
    rows = [(i, "".join(pick.choice(parts) for _ in range(pick.randrange(30)))) for i in range(1500)] + [(2000, None), (2001, ""), (2002, "1." * 3000), (2003, "@" * 2000)]
    d = spark.createDataFrame(rows, "doc_id long, text string").unionByName(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").filter("doc_id > 5000").unionByName(spark.createDataFrame([(i + 9000, t) for i, t in pii_corpus(40)], "doc_id long, text string")))
    texts = {}
    for r in d.collect():
        texts.setdefault(r.doc_id, set()).add(r.text)
    for r in pii.detect(d).collect():
        if len(texts[r.doc_id]) > 1:
            continue
        base = brute.base_personal_data(next(iter(texts[r.doc_id])))
        listed = [f"{k}:{s}:{e}" for k, s, e in base]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for k, _, _ in base) for x in pii.KINDS]
        assert r.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        spans = r.spans.split(",") if r.spans else []
        assert set(listed) <= set(spans) and r.n_spans == len(spans) == len(set(spans))
        assert spans == sorted(spans, key=lambda x: (pii.KINDS.index(x.split(":")[0]), int(x.split(":")[1])))


def test_pii_selects_what_base_patterns_miss(spark):
    """Planted forms are found, dates, prices and numbers are left alone; held-out precision and recall of renderings."""
    planted = ["write to john.doe (at) example (dot) com now", "I am jane at mail dot org please", "bob @ corp.example.com says", "call 555-123-4567 today", "tel (030) 123-4567 or", "card 4111.1111.1111.1111 ok", "at host 10[.]0[.]0[.]1 down"]
    clean = ["on 2021-03-04 it rained", "costs 1,234,567 dollars", "isbn 978-3-16-148410-0 x", "order 1234567890 now", "from 1914-1918 it went", "at noon. Then dot matrix", "version 10.4.22 of it", PROSE]
    rows = pii_corpus() + [(1000 + i, t) for i, t in enumerate(planted)] + [(2000 + i, t) for i, t in enumerate(clean)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in pii.detect(d).collect()}
    assert all(got[1000 + i].n_spans == 1 and got[1000 + i].n_email + got[1000 + i].n_ip + got[1000 + i].n_card + got[1000 + i].n_phone == 0 for i in range(len(planted)))
    assert all(got[2000 + i].n_spans == 0 for i in range(len(clean)))
    x, y, _ = pii.training_rows(d.filter("doc_id < 200"))
    z, t, _ = pii.training_rows(d.filter("doc_id BETWEEN 200 AND 299"))
    selector = pii.fitted(x, y, np.arange(len(y)) % pii.FOLDS)
    hit = selector.model.score(z) > np.array([selector.cuts[pii.KINDS[int(k)]] for k in z[:, 0]])
    assert (hit & (t == 1)).sum() > 0.95 * t.sum() and (hit & (t == 1)).sum() > 0.95 * hit.sum()


def test_pii_learns_from_every_match_of_every_document(spark):
    """More matches of a document, and more examples, than were once looked at; repeated rows count once."""
    texts = [" and ".join(f"host {i}.{j}.7.1" for j in range(30)) for i in range(30)]
    d = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None, "no match"])] + [(0, texts[0])] * 3, "doc_id long, text string")
    _, y, n = pii.training_rows(d)
    plain = [v for t in texts for _, v in pii.examples(t)]
    assert n.shape == (len(y), pii.FOLDS) and (n * (y == 1)[:, None]).sum() == sum(plain) == 30 * 30 * 5 and n.sum() == len(plain) > 30_000


def test_pii_redacts_with_what_all_documents_teach(spark, monkeypatch):
    """The pipeline's redaction learns from the same examples as op5, all of them."""
    seen = []
    fitted = pii.fitted
    monkeypatch.setattr(pii, "fitted", lambda x, y, n, *more: seen.append(n.sum()) or fitted(x, y, n, *more))
    d = spark.createDataFrame([(i, t, len(t)) for i, t in enumerate([" and ".join(f"host {i}.{j}.7.1" for j in range(30)) for i in range(30)])], "doc_id long, text string, n_chars long")
    got = corpus_pipeline.redact(spark, d, "").collect()
    assert all(r.text == " and ".join(["host [IP]"] * 30) and r.n_chars == len(r.text) for r in got)
    assert seen == [sum(1 for r in d.collect() for _ in pii.examples(r.text))] and seen[0] > 30_000


def test_pii_learns_the_same_in_tasks(spark):
    d = spark.createDataFrame(pii_corpus(60), "doc_id long, text string").repartition(3)
    here, there = pii.train(d, trees=3), pii.train(d, driver_rows=0, trees=3)
    assert here.cuts == there.cuts and all(np.array_equal(getattr(here.model, a), getattr(there.model, a)) for a in ("base", "feature", "threshold", "leaf"))
    none = spark.createDataFrame([(1, "no match"), (2, None)], "doc_id long, text string")
    assert pii.train(none, driver_rows=-1).model is None


def test_pii_thresholds_leave_a_hundredth_of_the_background(spark):
    import pandas as pd

    pick = np.random.default_rng(1)
    margins = pick.normal(3, 2, 5000)
    counted = pd.DataFrame({"kind": 2, "step": np.ceil(margins * pii.MARGIN_STEPS).astype(int), "n": 1}).groupby(["kind", "step"], as_index=False)["n"].sum()
    cuts = pii.thresholds(counted)
    above = (1 / (1 + np.exp(-margins)) > cuts["card"]).mean()
    assert 0.008 < above <= pii.BACKGROUND_SHARE and cuts["ip"] == pii.MIN_SCORE


def test_pii_learns_from_one_match_or_none(spark):
    d = spark.createDataFrame([(None, "mail a@b.cd"), (None, "mail a@b.cd"), (1, None)], "doc_id long, text string")
    assert sorted((r.n_email, r.n_spans) for r in pii.detect(d).collect()) == [(0, 0), (1, 1), (1, 1)]
    assert [r.n_spans for r in pii.detect(d.filter("text IS NULL")).collect()] == [0]


def test_trees_learn(spark, docs):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    assert ((gbdt.fit(x[:1500], y[:1500]).score(x[1500:]) > 0.5) == y[1500:]).mean() > 0.9
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 1)], "doc_id long, quality int")
    got = quality_classifier.classify(docs, labels).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)


def test_held_out_accuracy(spark):
    d, y = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    r = quality_classifier.classify(d, y).join(y, "doc_id").filter("held_out").agg(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()
    assert r[0] > 0.95


def test_mixing(docs, empty):
    rows = mixing.mix_plan(docs).collect()
    assert len(rows) == len(ODD) and all(r.taken <= 3 * r["size"] for r in rows)
    total = sum(r["size"] for r in rows)
    assert abs(sum({r.source: r.target for r in rows}.values()) - total) < 1e-6 * total
    assert sorted(map(str, mixing.mix_plan(docs).collect())) == sorted(map(str, rows))
    assert mixing.mix_plan(empty).count() == 0 and mixing.mix(docs).columns == docs.columns


def test_mixing_reaches_targets(spark):
    """Sources without ids, with one id, made of one row, with ties and null: each comes near its target."""
    text = " ".join(f"w{i}" for i in range(10))
    rows = [(None, f"{text} {i}", "null ids") for i in range(200)] + [(7, f"{text} {i}", "one id") for i in range(200)] + [(8, text, "one row")] * 200
    rows += [(1000 + i, text, None) for i in range(200)] + [(2000, "", "no words"), (2001, None, "no words")]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    d.write.mode("overwrite").parquet(path := scratch_path(spark, "mix-test"))
    d = spark.read.parquet(path)
    got = mixing.mix_plan(d).collect()
    taken, target = {}, {}
    for r in got:
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
    assert set(target) == {"null ids", "one id", "one row", "no words", None} and target["no words"] == 0
    assert all(abs(taken[s] - t) <= 11 for s, t in target.items()) and all(r.taken <= 3 * r.size for r in got if r.size)
    assert sorted(map(str, mixing.mix_plan(d).collect())) == sorted(map(str, got))
    mixed = mixing.mix(d).groupBy("source").agg(F.sum(F.size(F.split("text", " "))).alias("n")).collect()
    assert {r.source: r.n for r in mixed} == {s: n for s, n in taken.items() if n}


def test_mixing_does_not_depend_on_the_layout(spark):
    """Equal rows, rows equal but for a source or a further column: the same result from one file, three files, and any order."""
    rows = [(i, f"some words of text {i} " * (1 + i % 5), f"s{i % 3}", lang, {"k": lang}) for i in range(150) for lang in ("en", "en", "de")] + [(7, "one text", f"s{i % 3}", "en", None) for i in range(60)] + [(None, None, None, None, None)] * 3
    schema = "doc_id long, text string, source string, lang string, extra map<string,string>"
    results = []
    for n, order in ((1, rows), (3, rows), (7, rows[::-1])):
        path = scratch_path(spark, "mix-layout")
        spark.createDataFrame(order, schema).repartition(n).write.parquet(path)
        d = spark.read.parquet(path)
        results.append((sorted(map(str, mixing.mix_plan(d).collect())), sorted(map(str, mixing.mix(d).collect()))))
    assert results[0] == results[1] == results[2]


def test_embeddings(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(40, 16))
    v = [list(map(float, x)) for x in np.concatenate([base, base[:20] + 0.1 * rng.normal(size=(20, 16)), base[:2]])] + [None, [], [0.0] * 16, [float("nan")] * 16, [1.0, None], [1.0, 2.0]]
    got = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_duplicates(spark.createDataFrame(list(enumerate(v)), "vec_id long, embedding array<float>")).collect()}
    usable = [(i, np.array(np.float32(x), dtype=float)) for i, x in enumerate(v[:62])]
    links = {i: [j for j, y in usable if j != i and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.9] for i, x in usable}
    assert {i: n for i, (n, _) in got.items()} == {i: len(links.get(i, [])) for i in range(len(v))}
    assert got[60][1] == 0 and all(got[i] == (0, i) for i in range(62, 68))


def brute_links(vectors):
    usable = {i: np.array(x, dtype=float) / np.abs(x).max() for i, x in vectors if x}
    cosine = lambda x, y: x @ y / np.linalg.norm(x) / np.linalg.norm(y)
    return {i: sum(len(usable[j]) == len(usable[i]) and cosine(usable[i], usable[j]) >= 0.9 for j in usable if j != i) for i in usable}


@pytest.mark.parametrize("rows", [16_384, 300])
def test_embeddings_in_clusters(spark, monkeypatch, rows):
    """Many stripes and neighbourhoods, several lengths, very large and small vectors, null ids, other columns: all links are found."""
    monkeypatch.setattr(embeddings, "STRIPE_ROWS", rows)
    rng = np.random.default_rng(4)
    centre = rng.normal(size=(12, 8))
    v = [list(map(float, centre[i % 12] + 0.25 * rng.normal(size=8))) for i in range(700)] + [[float(x) * 1e200 for x in centre[0]], [float(x) * 1e-200 for x in centre[0]], list(map(float, centre[0])), [1.0, 0.1], [1.0, 0.0], None]
    got = {r.vec_id: r.n_links for r in embeddings.near_duplicates(spark.createDataFrame([(i, x, "k", 1) for i, x in enumerate(v)], "vec_id long, embedding array<double>, key string, stripe int")).collect()}
    want = brute_links(enumerate(v))
    assert {i: n for i, n in got.items() if i in want} == want and got[len(v) - 1] == 0
    d = spark.createDataFrame([(None, [1.0, 0.0]), (None, [1.0, 0.0]), (3, [1.0, 0.01])], "vec_id long, embedding array<float>")
    assert sorted((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in embeddings.near_duplicates(d).collect()) == [(0, 2, 3, False)] * 2 + [(3, 2, 3, True)]
    assert embeddings.near_duplicates(d.limit(0)).count() == 0


def test_minhash(docs, empty):
    got = {(r.doc_id, r.class_id, r.kept) for r in minhash.near_duplicates(docs).collect()}
    assert {(1, 1, True), (5, 1, False), (6, 1, False), (2, 2, True), (3, 3, True), (4, 4, True), (7, 7, True), (9, 9, True), (None, None, True)} <= got
    assert minhash.near_duplicates(empty).count() == 0 and minhash.deduplicated(docs).columns == docs.columns


def test_minhash_equals_brute_force(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert {r.doc_id: r.class_id for r in minhash.near_duplicates(d).collect()} == brute.near_duplicate_classes([(r.doc_id, r.text) for r in d.collect()])


def test_minhash_leaves_one_row_of_each_class(spark):
    """Classes without ids, repeated rows, and copies that share a doc_id."""
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(60)) for x in "abcd")
    rows = [(None, a, "s"), (None, a, "r"), (None, a + " more", "s"), (None, b, "s"), (None, b, "s"), (1, c, "s"), (1, c, "r"), (1, c, "s"), (2, d, "s"), (2, d + " more", "s"), (None, d, "s"), (3, "", "s"), (3, "", "r"), (None, "", "s"), (None, "", "s")]
    got = [tuple(r) for r in minhash.deduplicated(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()]
    assert sum(r[0] is None and r[1].startswith("a0") for r in got) == 1 and (None, b, "s") in got and (1, c, "r") in got
    assert sorted((r[0] or 0, r[1][:1]) for r in got) == [(0, ""), (0, ""), (0, "a"), (0, "b"), (1, "c"), (2, "d"), (3, "")]


def test_minhash_repeated_passages(spark):
    """80 shared shingles and 20 own ones, which occur about 50 times: Jaccard is 0.8 exactly."""
    rows = []
    for k in range(40):
        shared = " ".join(f"s{k}x{i}" for i in range(84))
        rows += [(2 * k, shared), (2 * k + 1, shared + (" " + " ".join(f"p{k}x{i}" for i in range(16))) * 50)]
    got = {r.doc_id: r.class_id for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute.near_duplicate_classes(rows) == {i: i - i % 2 for i in range(80)}


def test_minhash_repeated_lines(spark):
    """100 distinct words against the same with a line of 12 words repeated 400 times: Jaccard 0.857, all found."""
    rows = []
    for k in range(200):
        words = " ".join(f"w{k}x{i}" for i in range(100))
        rows += [(2 * k, words), (2 * k + 1, words + (" " + " ".join(f"r{k}x{i}" for i in range(12))) * 400)]
    got = {r.doc_id: r.class_id for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: i - i % 2 for i in range(400)}


def test_word_hashes():
    """Unlike words differ, a word's fingerprint does not depend on where segments are cut."""
    a = bytes(97 + bin(i).count("1") % 2 for i in range(1024))
    b = bytes(97 + 1 - bin(i).count("1") % 2 for i in range(1024))
    assert len({int(h) for w in (a, b, a[::-1] + b"c", b"ab", b"ba", b"a", b"aa") for h in minhash.word_hashes(w)}) == 7
    text = b"  one two\tthree " + a * 40 + b" four\n"
    whole, before = minhash.word_hashes(text), minhash.SEGMENT
    try:
        for minhash.SEGMENT in (1, 3, 7, 100):
            assert (minhash.word_hashes(text) == whole).all()
    finally:
        minhash.SEGMENT = before
    assert len(whole) == 5 and len(minhash.word_hashes(b"")) == len(minhash.word_hashes(b" \n")) == 0


def test_minhash_mixed_buckets(spark, monkeypatch):
    """Clusters that share bands, in tiles of two members: every link is found, none is made up."""
    monkeypatch.setattr(minhash, "TILE", 2)
    base = [f"b{i}" for i in range(84)]
    rows = [(c * 100 + k, " ".join(base[: 60 + 4 * c] + [f"own{c}x{i}" for i in range(24 - 4 * c)] + [f"tail{k}"] * (k > 0))) for c in range(7) for k in range(5)]
    got = {r.doc_id: r.class_id for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute.near_duplicate_classes(rows)


@pytest.mark.parametrize("small", [64, 1])
def test_suffix_dedup(spark, docs, small):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").unionByName(docs.filter("doc_id NOT IN (5)").select((F.col("doc_id") + 10_000).alias("doc_id"), "text"))
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.dedup(d, small).collect()}
    assert got == brute.repeated_bytes([(r.doc_id, r.text) for r in d.collect()])
    assert suffix_dedup.dedup(docs.limit(0)).count() == 0 and suffix_dedup.dedup(docs).count() == len(ODD)


@pytest.mark.parametrize("small", [64, 1])
def test_suffix_dedup_repeated_rows(spark, small):
    """Repeated rows are one document: a text that occurs nowhere else stays, and both rows share a verdict."""
    near = "other start " + PROSE[:700] + " another middle " + PROSE[800:]
    alone = " ".join(f"alone{i}" for i in range(40))
    once = [(-1, alone), (1, PROSE), (2, near), (3, alone + " " + near[300:])]
    rows = [(None if i < 0 else i, t) for i, t in once for _ in range(3 if i == 2 else 2)]
    got = suffix_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), small).collect()
    want = brute.repeated_bytes(once)
    assert want[-1][1] == want[1][1] == 0 < want[2][1]
    assert sorted((-1 if r.doc_id is None else r.doc_id, tuple(r)[1:]) for r in got) == sorted((-1 if i is None else i, want[-1 if i is None else i]) for i, _ in rows)


def test_suffix_dedup_of_strings_that_agree_modulo_a_power_of_two(spark):
    """Two strings that a polynomial modulo 2 ** 64 cannot tell apart, between equal passages: their own bytes stay."""
    one, two = "jiihihjhhlkmjlhhhhhh", "hhhlhmhhjhhhhhnihlij"
    side = lambda n, k: " ".join(f"w{n}x{k}y{i}" for i in range(60))[:400]
    rows = [(2 * n + k, side(n, "a") + x + side(n, "b")) for n in range(12) for k, x in enumerate((one, two))]
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute.repeated_bytes(rows) and got[1][1:3] == (800, 2)


def test_anchors_do_not_depend_on_the_pieces(monkeypatch):
    rng = np.random.default_rng(3)
    text = bytes(rng.integers(97, 100, 5000, dtype=np.uint8)) + b"a" * 700 + b"abc" * 300 + bytes(rng.integers(0, 255, 1500, dtype=np.uint8))
    key = suffix_dedup.drawn_key()
    whole = suffix_dedup.anchors(text, key)
    for piece in (100, 137, 1000, 4999):
        monkeypatch.setattr(suffix_dedup, "PIECE", piece)
        assert all((a == b).all() for a, b in zip(whole, suffix_dedup.anchors(text, key)))


def packed_right(docs, pieces):
    """Every id of docs (id, text), by the vocabulary file's own library, in one piece; sequences without gaps or overflow."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocabulary()["json_path"])
    want, got = {}, {}
    for i, text in docs:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        want.setdefault(i, []).append(ids)
    for p in pieces:
        got.setdefault(p.doc_id, []).append(p)
    assert set(got) == set(want)
    for i, all_ids in want.items():
        # copies of one document have equal pieces up to where they are cut, so the totals are compared
        assert sum(p.length for p in got[i]) == sum(map(len, all_ids))
        ids = all_ids[0]
        assert all(p.doc_tokens in set(map(len, all_ids)) for p in got[i])
        if len({x.tobytes() for x in all_ids}) == 1:
            assert all(p.ids_crc32 == zlib.crc32(ids[p.start : p.start + p.length].tobytes()) for p in got[i])
            covered = np.zeros(len(ids) + 1, dtype=int)
            for p in got[i]:
                covered[p.start] += 1
                covered[p.start + p.length] -= 1
            assert (covered.cumsum()[:-1] == len(all_ids)).all()
    by = {}
    for p in pieces:
        by.setdefault(p.sequence_id, []).append(p)
    for own in by.values():
        own.sort(key=lambda p: p.offset)
        assert [p.offset for p in own] == [sum(q.length for q in own[:k]) for k in range(len(own))] and sum(p.length for p in own) <= packing.WINDOW


def test_packing(spark, docs, empty):
    more = [(20, PROSE * 9), (21, "ça <|endoftext|> \u00a0\u2003x"), (22, " " * 9000), (23, "<|endoftext|>"), (24, "a <|endoftext|><|endoftext|>b <|endoftext"), (25, "x" * 5000 + "<|endoftext|>" + "x" * 5000), (26, "  <|endoftext|>  'll \n\n"), (27, "\x00\ufffd\u200b e\u0301 \U0001f600 \u4e2d\u6587")]
    d = docs.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    pieces = packing.pack(d, **vocabulary()).collect()
    packed_right([(r.doc_id, r.text) for r in d.collect()], pieces)
    assert packing.pack(empty, **vocabulary()).count() == 0


def test_pipeline_stages(spark):
    """Each stage's decisions against the plain reading of its input."""
    from strandflow.llm.common import keep

    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    columns = d.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = d.collect()
        d = keep(stage(spark, d, "/root/testdata/sf0.001"), f"test-{name}")
        rows = d.collect()
        ids = {r.doc_id for r in before}
        assert {r.doc_id for r in rows} <= ids
        assert k == len(corpus_pipeline.STAGES) - 1 or d.columns == columns
        if name == "minhash_dedup":
            assert {r.doc_id for r in rows} == set(brute.near_duplicate_classes([(r.doc_id, r.text) for r in before]).values())
        if name == "pii_redaction":
            assert not any(v for r in rows for v in pii.base_spans(r.text).values()) and len(rows) == len(before)
    assert {r.doc_id for r in rows} == ids
