"""MinHash near-dedup: ProbMinHash signatures, banding, exact verification, components.

A text's elements are its distinct shingles of WORDS words (a text of fewer words is one
shingle), each of weight 1 however often it occurs. Each element sends Poisson arrivals at
the rate of its weight to random registers; a register keeps the element that arrives first,
and an element stops once its next arrival is later than every register's. Two registers are
equal with the probability of the pair's Jaccard similarity, the measure of links too.
Registers are hashed in bands; texts that share a band are candidates, and a link is a pair
whose Jaccard similarity, counted on 64-bit fingerprints of all shingles, is at least
THRESHOLD.

No bucket's pairs are listed. First each member is checked against the least member of
its bucket, and components are formed. Buckets that still hold several components are cut
into tiles of TILE members, where every pair across components is counted in place and only
links come out. So every candidate pair is checked or joined through others.

Equal texts are one class before all that. Defined results: a text without words (null,
empty, white space) links with nothing; class_id is the least doc_id of the class, nulls
aside; repeated rows of one doc_id and text are one document and share its verdict; an
empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keep
from .graph import connected_components

WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 32, 6
TILE = 256
SEGMENT = 1 << 20
SHORT = 64
BATCH_ELEMENTS = 100_000

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_PLACES = np.cumprod(np.full(64, np.uint64(0xD6E8FEB86659FD93)), dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


#: Values of (place, byte) for the first SHORT places of a word; later places are scrambled as they come.
_LETTERS = mix(np.arange(SHORT << 8, dtype=np.uint64) + _PLACES[5])


def _letters(byte: np.ndarray, place: np.ndarray) -> np.ndarray:
    code = (place << 8) + byte
    out = _LETTERS[np.minimum(code, (SHORT << 8) - 1)]
    far = np.flatnonzero(place >= SHORT)
    if len(far):
        out[far] = mix(code[far].astype(np.uint64) + _PLACES[5])
    return out


def word_hashes(raw: bytes) -> np.ndarray:
    """A fingerprint of each word; a word that crosses segments is summed on."""
    ended = lambda total, size: mix(total + size.astype(np.uint64) * _PLACES[3])
    out, total, size = [], np.zeros(1, dtype=np.uint64), np.zeros(1, dtype=np.int64)  # of the word that is open
    for at in range(0, len(raw), SEGMENT):
        b = np.frombuffer(raw, dtype=np.uint8)[at : at + SEGMENT]
        edge = np.flatnonzero(np.diff(_SPACE[b], prepend=True, append=True))
        start, end = edge[::2], edge[1::2]
        goes_on = len(start) > 0 and start[0] == 0
        if size[0] and not goes_on:
            out.append(ended(total, size))
            total, size = np.zeros_like(total), np.zeros_like(size)
        if not len(start):
            continue
        n = end - start
        before = np.cumsum(n) - n
        place = np.arange(before[-1] + n[-1]) - np.repeat(before, n)
        if goes_on:
            place[: n[0]] += size[0]
        sums = np.add.reduceat(_letters(b[~_SPACE[b]].astype(np.int64), place), before)
        if goes_on:
            sums[:1] += total
            n[0] += size[0]
        is_open = end[-1] == len(b)
        done = len(n) - is_open
        out.append(ended(sums[:done], n[:done]))
        total, size = (sums[done:], n[done:]) if is_open else (np.zeros(1, dtype=np.uint64), np.zeros(1, dtype=np.int64))
    if size[0]:
        out.append(ended(total, size))
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)


def shingles(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles, ascending, and how often each occurs."""
    w = word_hashes((text or "").encode())
    n = min(WORDS, len(w))
    if n == 0:
        return w, np.zeros(0, dtype=np.int64)
    many = len(w) - n + 1
    s = np.full(many, np.uint64(n))
    for j in range(n):
        s += w[j : j + many] * _PLACES[j]
    return np.unique(mix(s), return_counts=True)


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], k: int = BANDS * ROWS) -> np.ndarray:
    """(sets, k) winning elements, for sets of (elements, weights); a set without elements has zeros."""
    n = len(sets)
    element = np.concatenate([e for e, _ in sets]) if sets else np.zeros(0, dtype=np.uint64)
    weight = np.concatenate([w for _, w in sets]).astype(float) if sets else np.zeros(0)
    owner = np.repeat(np.arange(n), [len(e) for e, _ in sets])
    first, winner = np.full(n * k, np.inf), np.zeros(n * k, dtype=np.uint64)
    time, arrival, step = np.zeros(len(element)), 0, 1
    while len(element):
        number = np.arange(arrival, arrival + step, dtype=np.uint64)
        bits = mix(element[:, None] + (number + np.uint64(1)) * _PLACES[7])
        gap = -np.log(((bits >> np.uint64(11)).astype(float) + 0.5) / float(1 << 53))
        at = time[:, None] + np.cumsum(gap / weight[:, None], axis=1)
        register = owner[:, None] * k + (mix(bits + _PLACES[9]) % np.uint64(k)).astype(np.int64)
        latest = first.reshape(n, k).max(axis=1)
        row, col = np.nonzero(at < latest[owner][:, None])
        t, r, e = at[row, col], register[row, col], element[row]
        np.minimum.at(first, r, t)
        won = first[r] == t
        winner[r[won]] = e[won]
        going = at[:, -1] < first.reshape(n, k).max(axis=1)[owner]
        element, weight, owner, time = element[going], weight[going], owner[going], at[going, -1]
        arrival, step = arrival + step, min(16, 2 * step)
    return winner.reshape(n, k)


def _sign_batch(ids: list, keys: list, sets: list) -> pd.DataFrame:
    sig = signatures([(e, np.ones(len(e))) for e, _ in sets])
    parts = sig.reshape(len(sets), BANDS, ROWS)
    bands = mix((parts * _PLACES[:ROWS]).sum(axis=2, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64) * _PLACES[11]).view(np.int64)
    some = [len(e) > 0 for e, _ in sets]
    return pd.DataFrame({"doc_id": pd.array(ids, dtype="Int64"), "key": keys, "some": some, "bands": [b if s else b[:0] for b, s in zip(bands, some)]})


def _sign(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in parts:
        ids, keys, sets, size = [], [], [], 0
        for i, key, text in zip(pdf["doc_id"], pdf["key"], pdf["text"]):
            got = shingles(text)
            ids.append(None if pd.isna(i) else int(i))
            keys.append(key)
            sets.append(got)
            size += len(got[0])
            if size > BATCH_ELEMENTS:
                yield _sign_batch(ids, keys, sets)
                ids, keys, sets, size = [], [], [], 0
        if ids:
            yield _sign_batch(ids, keys, sets)


def text_key(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def _fingerprints(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """All shingles of each class's text; repeated rows of one document come one after the other and count once."""
    last = None
    for pdf in parts:
        nid, out = pdf["nid"].to_numpy(), []
        new = np.append(nid[:1] != last, nid[1:] != nid[:-1])
        last = nid[-1] if len(nid) else last
        for i in np.flatnonzero(new):
            out.append((nid[i], shingles(pdf["text"].iat[i])[0].tobytes()))
            if len(out) >= 1000:
                yield pd.DataFrame(out, columns=["nid", "elements"])
                out = []
        yield pd.DataFrame(out, columns=["nid", "elements"])


def alike(x: bytes, y: bytes) -> bool:
    """Whether the Jaccard similarity of two fingerprint sets reaches the threshold."""
    small, large = sorted((len(x), len(y)))
    if small < THRESHOLD * large:
        return False
    u, v = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
    both = len(np.intersect1d(u, v, assume_unique=True))
    return both >= THRESHOLD * (len(u) + len(v) - both)


def _alike(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in parts:
        out = [(a, b) for a, b, x, y in zip(pdf["a"], pdf["b"], pdf["x"], pdf["y"]) if alike(x, y)]
        yield pd.DataFrame(out, columns=["a", "b"])


def verified(pairs: DataFrame, elements: DataFrame) -> DataFrame:
    x = elements.select(F.col("nid").alias("a"), F.col("elements").alias("x"))
    y = elements.select(F.col("nid").alias("b"), F.col("elements").alias("y"))
    return keep(pairs.hint("merge").join(x, "a").hint("merge").join(y, "b").select("a", "b", "x", "y").mapInPandas(_alike, "a long, b long"), "mh-links")


def _runs(parts: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Groups of a partition sorted by keys, one after the other."""
    held = None
    for pdf in parts:
        pdf = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
        if not len(pdf):
            continue
        k = pdf[keys].to_numpy()
        cuts = np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1
        for s, e in zip([0, *cuts[:-1]], cuts):
            yield pdf.iloc[s:e]
        held = pdf.iloc[cuts[-1] if len(cuts) else 0 :]
    if held is not None and len(held):
        yield held


def _tile_links(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links across components within each tile; a pair counts in the first band that it shares."""
    for pdf in _runs(parts, ["bucket", "p", "q"]):
        nid, comp, head, chunk = (pdf[c].to_numpy() for c in ("nid", "comp", "head", "chunk"))
        comp, bands, out = comp.copy(), np.stack(pdf["bands"].to_numpy()), []
        bucket, p, q = (pdf[c].iloc[0] for c in ("bucket", "p", "q"))
        before = bands[:, : np.flatnonzero(bands[0] == bucket)[0]]
        size = pdf["elements"].str.len().to_numpy() // 8
        start = np.cumsum(size) - size
        # numbers of the tile's distinct elements, so that one member is counted against all others by looking up flags
        _, number = np.unique(np.frombuffer(b"".join(pdf["elements"]), dtype=np.uint64), return_inverse=True)
        flag = np.zeros(len(number), dtype=bool)
        left, right = np.flatnonzero(chunk == p), np.flatnonzero(chunk == q)
        for i in left:
            j = right[nid[right] > nid[i]] if p == q else right
            j = j[(comp[j] != comp[i]) & (head[i] != nid[i]) & (head[j] != nid[j])]
            j = j[np.minimum(size[i], size[j]) >= THRESHOLD * np.maximum(size[i], size[j])]
            j = j[~(before[j] == before[i]).any(axis=1)]
            if not len(j):
                continue
            own = number[start[i] : start[i] + size[i]]
            flag[own] = True
            both = np.array([np.count_nonzero(flag[number[s : s + n]]) for s, n in zip(start[j], size[j])])
            flag[own] = False
            for k in j[both >= THRESHOLD * (size[i] + size[j] - both)]:
                if comp[k] != comp[i]:
                    out.append((nid[i], nid[k]))
                    comp[comp == comp[k]] = comp[i]
        yield pd.DataFrame(out, columns=["a", "b"])


def _unsettled(members: DataFrame, labels: DataFrame, classes: DataFrame, elements: DataFrame) -> DataFrame:
    """Members of buckets that hold several components, dealt into tiles of two chunks, one of them outside the largest component."""
    m = keep(members.join(labels.withColumnRenamed("node", "nid"), "nid", "left").withColumn("comp", F.coalesce("label", "nid")).drop("label", "size"), "mh-members")
    sizes = m.groupBy("bucket", "comp").count().groupBy("bucket").agg(F.max(F.struct("count", "comp")).alias("main"), F.sum("count").alias("size"))
    chunks = lambda n: F.ceil(n / TILE).cast("int")
    mixed = sizes.filter("size > main.count").select("bucket", F.col("main.comp").alias("main"), chunks(F.col("size") - F.col("main.count")).alias("outer"), chunks(F.col("main.count")).alias("inner"))
    m = m.join(keep(mixed, "mh-mixed"), "bucket").withColumn("inside", F.col("comp") == F.col("main"))
    # chunks are numbered from 0 outside the largest component, and on from there inside it
    own = F.pmod(F.xxhash64("nid"), F.when(F.col("inside"), F.col("inner")).otherwise(F.col("outer"))).cast("int")
    m = m.withColumn("chunk", own + F.when(F.col("inside"), F.col("outer")).otherwise(F.lit(0)))
    last = F.col("outer") + F.when(F.col("inside"), F.lit(0)).otherwise(F.col("inner")) - 1
    m = m.select("bucket", "nid", "comp", "head", "chunk", F.explode(F.sequence(F.lit(0), last)).alias("other"))
    m = m.withColumns({"p": F.least("chunk", "other"), "q": F.greatest("chunk", "other")})
    m = m.join(classes.select("nid", "bands"), "nid").join(elements, "nid")
    return m.select("bucket", "p", "q", "chunk", "nid", "comp", "head", "bands", "elements")


def text_classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """signed rows (doc_id, key, some) and the class of each key of a text with words: its label, and class id or null."""
    source = docs.select("doc_id", text_key(F.col("text")).alias("key"), "text")
    signed = keep(source.mapInPandas(_sign, "doc_id long, key binary, some boolean, bands array<long>"), "mh-signed")
    classes = signed.filter("some").groupBy("key").agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands"))
    classes = keep(classes.withColumn("nid", F.monotonically_increasing_id()), "mh-classes")
    buckets = classes.select("nid", F.explode("bands").alias("bucket"))
    heads = keep(buckets.groupBy("bucket").agg(F.min("nid").alias("head"), F.count("*").alias("size")).filter("size > 1"), "mh-heads")
    members = keep(buckets.hint("merge").join(heads, "bucket"), "mh-members")
    nodes = members.select("nid").distinct().join(classes.select("nid", "rep", "key"), "nid")
    nodes = keep(nodes, "mh-nodes")
    # a merge join at every size: the side of the texts grows with the input
    texts = source.hint("merge").join(nodes.withColumnRenamed("key", "node_key"), F.col("doc_id").eqNullSafe(F.col("rep")) & (F.col("key") == F.col("node_key")))
    elements = keep(texts.select("nid", "text").mapInPandas(_fingerprints, "nid long, elements binary"), "mh-elements")
    links = verified(members.filter("nid <> head").select(F.col("nid").alias("a"), F.col("head").alias("b")).distinct(), elements)
    labels = keep(connected_components(links), "mh-labels")
    rest = _unsettled(members, labels, classes, elements)
    dealt = rest.repartition("bucket", "p", "q").sortWithinPartitions("bucket", "p", "q")
    more = keep(dealt.mapInPandas(_tile_links, "a long, b long"), "mh-more")
    if not more.isEmpty():
        labels = keep(connected_components(more.unionByName(labels.select(F.col("node").alias("a"), F.col("label").alias("b")))), "mh-labels")
    named = classes.select("nid", "key", "rep").join(labels.withColumnRenamed("node", "nid"), "nid", "left").withColumn("label", F.coalesce("label", "nid"))
    named = keep(named, "mh-labelled")
    names = keep(named.groupBy("label").agg(F.min("rep").alias("class_id")), "mh-names")
    return signed.select("doc_id", "key", "some"), keep(named.join(names, "label").select("key", "label", "class_id"), "mh-result")


def _verdicts(rows: DataFrame, by_key: DataFrame) -> DataFrame:
    # texts without words take part under keys of their own, which match nothing
    own = F.concat(F.lit("own").cast("binary"), F.xxhash64("doc_id").cast("string").cast("binary"))
    j = rows.withColumn("key", F.when(F.col("some"), F.col("key")).otherwise(own)).join(by_key, "key", "left")
    j = j.withColumn("class_id", F.when(F.col("some"), F.col("class_id")).otherwise(F.col("doc_id")))
    return j.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("class_id")))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, class_id, kept."""
    return _verdicts(*text_classes(docs)).select("doc_id", "class_id", "kept")


def deduplicated(docs: DataFrame) -> DataFrame:
    """One row of each class, with all its columns: the least doc_id, nulls last, then the least key of its text.

    Rows without words stay, but for repeated rows of one doc_id and text. Of repeated rows the
    one with the least other columns stays.
    """
    rows, by_key = text_classes(docs)
    item = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key")
    counted = keep(rows.groupBy("doc_id", "key", "some").agg(F.count("*").alias("n")), "mh-counted")
    least = counted.filter("some").join(by_key, "key").groupBy("label").agg(F.min_by(F.struct("doc_id", "key", "n"), item).alias("x")).select("x.*")
    # rows without words or id are told apart by nothing, so none of them repeats another
    wordless = counted.filter("NOT some").withColumn("n", F.when(F.col("doc_id").isNull(), 1).otherwise(F.col("n"))).select("doc_id", "key", "n")
    chosen = keep(least.unionByName(wordless).select(F.col("doc_id").alias("chosen_id"), F.col("key").alias("chosen_key"), F.col("n").alias("chosen_n")), "mh-chosen")
    mine = lambda c: docs["doc_id"].eqNullSafe(c["chosen_id"]) & (text_key(docs["text"]) == c["chosen_key"])
    single, several = chosen.filter("chosen_n = 1"), chosen.filter("chosen_n > 1")
    out = docs.join(single, mine(single), "left_semi")
    if several.isEmpty():
        return out
    again = docs.join(several, mine(several)).withColumn("row", F.struct(*docs.columns))
    return out.unionByName(again.groupBy("chosen_id", "chosen_key").agg(F.min("row").alias("row")).select("row.*"))
