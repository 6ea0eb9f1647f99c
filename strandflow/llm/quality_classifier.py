"""Quality classifier: histogram gradient-boosted trees over document statistics.

The trees are fitted on at most SAMPLE_ROWS labelled rows (in the order of a hash of
their ids) outside the held-out fold, and flattened into arrays; every whole text is then
measured and scored in batches. Only statistics of the text are inputs.

Defined results: a null or empty text has all statistics 0 and is scored like any other;
several labels of one doc_id count by their mean, null labels not at all; of several
documents with one doc_id one is learnt from; repeated rows are scored one by one; without usable labels every score is 0.5; a null doc_id is not
held out; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import gbdt
from .quality_rules import STOP_WORDS

SAMPLE_ROWS = 20_000
HELD_OUT_OF = 5
CUT = 0.3
_STOP = frozenset(w.encode() for w in STOP_WORDS)
_CLASSES = {
    "symbols": b"#*$%&|<>", "marks": b"!?", "stops": b".,;:", "digits": b"0123456789", "upper": bytes(range(65, 91)),
    "lower": bytes(range(97, 123)), "brackets": b"{}[]()", "quotes": b"\"'`", "slashes": b"/\\_=+~^@-", "high": bytes(range(128, 256)),
}
_TABLE = np.zeros((256, len(_CLASSES)))
for _i, _members in enumerate(_CLASSES.values()):
    _TABLE[list(_members), _i] = 1
FEATURES = ("bytes", "words", "word_length", "distinct", "distinct_triples", "stop_words", "lines", "repeated_lines", "line_words", "longest_word", *_CLASSES)


def statistics(text: str | None) -> np.ndarray:
    raw = (text or "").encode()
    words = raw.split()
    n = max(len(words), 1)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    triples = len(words) - 2
    counts = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256) @ _TABLE
    size = max(len(raw), 1)
    return np.array([
        np.log1p(len(raw)), np.log1p(len(words)), sum(map(len, words)) / n, len(set(words)) / n,
        len(set(zip(words, words[1:], words[2:]))) / triples if triples > 0 else 1.0, sum(w.lower() in _STOP for w in words) / n,
        np.log1p(len(lines)), 1 - len(set(lines)) / len(lines) if lines else 0.0, len(words) / max(len(lines), 1), max(map(len, words), default=0), *(counts / size),
    ])


def matrix(texts: pd.Series) -> np.ndarray:
    return np.stack([statistics(t) for t in texts]) if len(texts) else np.zeros((0, len(FEATURES)))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % HELD_OUT_OF == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> gbdt.Trees:
    """Fits on the labelled rows outside the held-out fold, at most sample_rows of them."""
    y = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    y = y.groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    rows = docs.select("doc_id", "text").join(F.broadcast(y), "doc_id")  # at most sample_rows rows of 12 bytes

    def measure(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "y": pdf["y"], "x": list(matrix(pdf["text"]))})

    # one row per doc_id, however often it occurs: at most sample_rows come to the driver
    measured = rows.mapInPandas(measure, "doc_id long, y int, x array<double>").groupBy("doc_id").agg(F.min(F.struct("y", "x")).alias("m"))
    got = measured.select("doc_id", "m.y", "m.x").toPandas().sort_values("doc_id", kind="stable")
    x = np.stack(got["x"].to_numpy()) if len(got) else np.zeros((0, len(FEATURES)))
    return gbdt.fit(x, got["y"].to_numpy(dtype=float))


def score(docs: DataFrame, model: gbdt.Trees) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""

    @F.pandas_udf("double")
    def scored(text: pd.Series) -> pd.Series:
        return pd.Series(model.score(matrix(text)))

    d = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), scored("text").alias("score"))
    return d.withColumn("predicted", (F.col("score") >= CUT).cast("int"))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, train(docs, labels))
