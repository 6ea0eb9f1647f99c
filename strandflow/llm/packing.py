"""Packing: bounded-space online packing of token sequences.

Each task reads its documents once, in order. A document is cut into full windows and a
rest; the rest goes best-fit into one of OPEN open windows. Where none fits, the fullest
is filled with the head of the rest if its gap is worth a piece, and emitted. What is
still open at the end of a task is merged: the pieces of about GROUP_WINDOWS left-over
windows at a time are packed anew, whole, best-fit decreasing. Only piece rows travel, no
token ids. Sequences are numbered by task (or merge group) and order, so that reruns over
the same splits agree.

Defined results: a null or empty text is one piece that holds just the end id; rows are
packed one by one, so repeated rows and null ids stay; an empty table gives an empty
table. A text that spells an added token of the vocabulary file ("<|endoftext|>") gets that
token's id there, as the file's own library gives it.
"""

from __future__ import annotations

import bisect
import json
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep

WINDOW = 2048
OPEN = 64
#: A gap of fewer tokens is left as padding rather than filled with a cut piece.
MIN_PIECE = 32
GROUP_WINDOWS = 256
END_ID = 1
#: Unbroken runs above this length go to the library whose merges take n log n steps.
LONG_RUN = re.compile(r"\S{2000}|\s{2000}|[^\W\d_]{2000}")
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, task int, left_over boolean"
COLUMNS = [x.split()[0] for x in PIECES.split(", ")]


def tokenizer(ranks_path: str, json_path: str, pattern: str) -> Callable[[str], np.ndarray]:
    """text -> ids of the byte-level BPE. Both files hold the same vocabulary; the faster library reads its ranks."""
    import base64

    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    with open(json_path, encoding="utf-8") as f:
        added = {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}
    fast = tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens=added)
    slow = []

    def encode(text: str) -> np.ndarray:
        if LONG_RUN.search(text):
            if not slow:
                from tokenizers import Tokenizer

                slow.append(Tokenizer.from_file(json_path))
            return np.array(slow[0].encode(text, add_special_tokens=False).ids, dtype="<u4")
        ids = fast.encode(text, allowed_special="all") if any(t in text for t in added) else fast.encode_ordinary(text)
        return np.array(ids, dtype="<u4")

    return encode


class Packer:
    """Open windows by free room; closed pieces come out as (piece, sequence, offset)."""

    def __init__(self, first_id: int, open_windows: int | None = OPEN, cut: bool = True):
        self.free: list[tuple[int, int]] = []  # ascending (room, sequence)
        self.held: dict[int, list] = {}
        self.next, self.limit, self.cut = first_id, open_windows, cut

    def _new(self) -> int:
        self.next += 1
        self.held[self.next - 1] = []
        return self.next - 1

    def _put(self, k: int, room: int, piece: tuple) -> Iterator[tuple]:
        self.held[k].append((piece, WINDOW - room))
        if room == piece[2]:
            yield from self._close(k)
        else:
            bisect.insort(self.free, (room - piece[2], k))

    def _close(self, k: int) -> Iterator[tuple]:
        for piece, offset in self.held.pop(k):
            yield piece, k, offset

    def add(self, piece: tuple, split: Callable[[tuple, int], tuple[tuple, tuple]] | None = None) -> Iterator[tuple]:
        """piece: (doc_id, start, length, ...); split cuts one after so many ids."""
        at = bisect.bisect_left(self.free, (piece[2], -1))
        if at < len(self.free):
            room, k = self.free.pop(at)
            yield from self._put(k, room, piece)
            return
        if self.limit is not None and len(self.free) >= self.limit:
            room, k = self.free.pop(0)
            if split and room >= MIN_PIECE:
                head, piece = split(piece, room)
                self.held[k].append((head, WINDOW - room))
                yield from self._close(k)
                yield from self.add(piece, split)
                return
            yield from self._close(k)
        yield from self._put(self._new(), WINDOW, piece)

    def rest(self) -> Iterator[tuple]:
        for k in list(self.held):
            yield from self._close(k)


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.tobytes())


def _pack_task(encode: Callable[[str], np.ndarray], docs: Iterator[tuple[int | None, str | None]], task: int) -> Iterator[tuple]:
    packer = Packer(task << 32)

    def split(piece: tuple, n: int) -> tuple[tuple, tuple]:
        doc, start, length, total, ids = piece
        return (doc, start, n, total, ids[:n]), (doc, start + n, length - n, total, ids[n:])

    def row(x: tuple, left: bool) -> tuple:
        (doc, start, length, total, ids), k, offset = x
        return doc, start, length, _crc(ids), total, k, offset, task, left

    for doc, text in docs:
        ids = np.append(encode(text or ""), np.array([END_ID], dtype="<u4")).astype("<u4")
        whole = len(ids) // WINDOW * WINDOW
        for at in range(0, whole, WINDOW):
            yield row(((doc, at, WINDOW, len(ids), ids[at : at + WINDOW]), packer._new(), 0), False)
            packer.held.pop(packer.next - 1)
        if whole < len(ids):
            for x in packer.add((doc, whole, len(ids) - whole, len(ids), ids[whole:].copy()), split):
                yield row(x, False)
    for x in packer.rest():
        yield row(x, True)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    pdf = pd.DataFrame(rows, columns=COLUMNS)
    pdf["doc_id"] = pd.array(pdf["doc_id"], dtype="Int64")
    return pdf


def pack(docs: DataFrame, ranks_path: str, json_path: str, pattern: str) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = tokenizer(ranks_path, json_path, pattern)
        each = ((None if pd.isna(i) else int(i), t) for pdf in parts for i, t in zip(pdf["doc_id"], pdf["text"]))
        rows = []
        for r in _pack_task(encode, each, TaskContext.get().partitionId()):
            rows.append(r)
            if len(rows) >= 20_000:
                yield _frame(rows)
                rows = []
        yield _frame(rows)

    def merge(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "task", "sequence_id", "offset"], ascending=[False, True, True, True], kind="stable")
        packer = Packer((1 << 62) + (int(key[0]) << 32), None)
        pieces = [(None if pd.isna(r[0]) else int(r[0]), *map(int, r[1:5])) for r in pdf[COLUMNS[:5]].itertuples(index=False)]
        done = [x for p in pieces for x in packer.add(p)]
        return _frame([(*p, k, offset, 0, True) for p, k, offset in [*done, *packer.rest()]])

    pieces = keep(docs.select("doc_id", "text").mapInPandas(run, PIECES), "pack-pieces")
    left = pieces.filter("left_over")
    windows = left.select("sequence_id").distinct().count()
    groups = max(1, -(-windows // GROUP_WINDOWS))
    merged = left.withColumn("grp", F.pmod(F.xxhash64("sequence_id"), F.lit(groups))).groupBy("grp").applyInPandas(merge, PIECES)
    return pieces.filter("NOT left_over").unionByName(merged).drop("task", "left_over")
