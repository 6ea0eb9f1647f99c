"""Byte-pair encoding by dynamic programming over prefixes, and decoding.

A text is cut at white space; every run between is normalised and split into words by the
vocabulary file's own rules. The encoding of each prefix of a word ends in exactly one
token: the one that ends there, as found by an automaton over all tokens, and that is
compatible with the last token of the prefix before it. Two tokens are compatible if no
merge would have joined symbols across their border before the merges inside both were
done. One pass over a word stores the last token of each prefix; following these back from
its end gives the ids. Merging never runs on the texts, and a long unbroken word takes a
time that is linear in its length.

Defined results: a null or empty text, or one of white space only, has no ids and decodes
to an empty text. Rows are treated one by one, so repeated rows and null ids stay. A text
that spells an added token of the file gets that token's id. Extra columns are left out.
An empty table gives an empty table.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: White space as the vocabulary's rules understand it: Unicode's White_Space.
RUN = re.compile("[^\\x09-\\x0D\\x20\\x85\\xA0\\u1680\\u2000-\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000]+")
#: A worker remembers the ids of so many runs and of so many words lately met, twice, of so many characters at most each.
CACHE, CACHED_CHARS = 1 << 17, 64
#: And so many pairs of tokens that it has compared.
PAIRS = 1 << 19
#: Rows are handed to Spark in batches of about so many bytes.
BATCH_BYTES = 4 << 20
#: A word's last symbol is another symbol than the same byte elsewhere.
LAST = 0x4000
#: The word rule for which plain runs need no library, and its endings.
WORD_RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
ENDINGS = "'s|'t|'re|'ve|'m|'ll|'d"
#: Letters, digits and signs of Latin-1 and Latin Extended-A: normal form C leaves them alone, and their lower-case forms are single and among them.
PLAIN = "\x21-\x7E\xA1-\u012F\u0131-\u017F"


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: its own if it has a visible one in Latin-1, else the next from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(256, 512))
    return [chr(b if b in own else next(others)) for b in range(256)]


class Recent:
    """A bounded memory: when one dictionary is full, it becomes the older one, from which what is met again moves on."""

    def __init__(self):
        self.new, self.old = {}, {}

    def get(self, key: str):
        value = self.new.get(key)
        if value is None and (value := self.old.get(key)) is not None:
            self.put(key, value)
        return value

    def put(self, key: str, value) -> None:
        if len(key) <= CACHED_CHARS:
            if len(self.new) >= CACHE:
                self.new, self.old = {}, self.new
            self.new[key] = value


class PrefixEncoder:
    """ids of texts under a vocabulary file whose model is byte-level pair merging with a word-end suffix or none."""

    def __init__(self, path: str):
        import ahocorasick
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if model["type"] != "BPE" or model.get("dropout") or model.get("ignore_merges") or model.get("continuing_subword_prefix"):
            raise ValueError("not a plain byte-pair vocabulary")
        if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] or not RUN.fullmatch(t["content"]) for t in spec["added_tokens"]):
            raise ValueError("added tokens must be plain strings without white space")
        library = Tokenizer.from_file(path)
        self.normalize, self.split = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        self.added_form = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.plain = re.compile(f"[{PLAIN}]+").fullmatch if WORD_RULE in [p.get("pattern", {}).get("Regex") for p in spec["pre_tokenizer"].get("pretokenizers", [])] else lambda run: None
        chars = [chr(c) for c in range(0x180)]
        letters, numbers = ("".join(c for c in chars if unicodedata.category(c)[0] == kind) for kind in "LN")
        self.plain_words = re.compile(f"{ENDINGS}|[{letters}]+|[{numbers}]|[^{letters}{numbers}]+").findall
        self.alphabet = {b: x for b, x in enumerate(byte_alphabet()) if ord(x) != b}
        vocab = model["vocab"]
        self.symbols = {self._symbols(t): i for t, i in vocab.items()}
        self.parts: dict[int, tuple[int, int]] = {}
        self.rank: dict[tuple[int, int], int] = {}
        born = {}
        for n, pair in enumerate(model["merges"]):
            a, b = (vocab[x] for x in (pair.split(" ") if isinstance(pair, str) else pair))
            made = vocab[self._text(a, b, pair)]
            if made in born or born.get(a, -1) >= n or born.get(b, -1) >= n:
                raise ValueError("merges must make each token once, after its parts")
            born[made], self.parts[made], self.rank[a, b] = n, (a, b), n
        self.born = born
        self.length = np.zeros(max(vocab.values()) + 1, dtype=np.int32)
        self.automaton = ahocorasick.Automaton()
        for s, i in self.symbols.items():
            self.length[i] = len(s)
        self.lengths = self.length.tolist()
        self.rights, self.lefts, self.pairs = {}, {}, {}
        for s, i in self.symbols.items():
            if self._is_own_encoding(i):
                self.automaton.add_word(s, i)
        self.automaton.make_automaton()
        self.runs, self.words = Recent(), Recent()

    def _text(self, a: int, b: int, pair) -> str:
        left, right = pair.split(" ") if isinstance(pair, str) else pair
        return left + right

    def _symbols(self, token: str) -> str:
        """One character a byte, a word's last one marked."""
        if self.suffix and token.endswith(self.suffix) and len(token) > len(self.suffix):
            token = token[: -len(self.suffix)]
            return token[:-1] + chr(ord(token[-1]) + LAST)
        return token

    def _border(self, token: int, side: int) -> list[tuple[int, float]]:
        """What stands at one side of token while it is merged: (part, merge at which the part is taken up), the whole first."""
        known = self.rights if side else self.lefts
        if token not in known:
            out, until = [(token, float("inf"))], token
            while until in self.parts:
                out.append((self.parts[until][side], self.born[until]))
                until = self.parts[until][side]
            known[token] = out
        return known[token]

    def _first_across(self, a: int, b: int) -> float:
        """The first merge across the border of a and b, were they merged side by side; infinite if there is none."""
        first = float("inf")
        for x, until_x in self._border(a, 1):
            for y, until_y in self._border(b, 0):
                n = self.rank.get((x, y))
                if n is not None and n < until_x and n <= until_y and n < first:
                    first = n
        return first

    def compatible(self, a: int, b: int) -> bool:
        """Whether a then b is the encoding of both together."""
        key = a << 20 | b
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self._first_across(a, b) == float("inf")
        return known

    def _is_own_encoding(self, token: int) -> bool:
        """Whether a token's symbols are merged to the token itself: its parts are, and nothing joins them before their own merge."""
        todo = [token]
        while todo:
            t = todo.pop()
            if t in self.parts:
                a, b = self.parts[t]
                if self._first_across(a, b) != self.born[t]:
                    return False
                todo += [a, b]
        return True

    def word(self, word: str) -> list[int]:
        """ids of one word, given in the byte-level alphabet."""
        if self.suffix:
            word = word[:-1] + chr(ord(word[-1]) + LAST)
        last, lengths, pairs = [-1] * len(word), self.lengths, self.pairs
        for end, token in self.automaton.iter(word):
            if last[end] < 0:
                before = end - lengths[token]
                if before < 0:
                    last[end] = token
                elif (previous := last[before]) >= 0:
                    fits = pairs.get(previous << 20 | token)
                    if fits or (fits is None and self.compatible(previous, token)):
                        last[end] = token
        ids, at = [], len(word) - 1
        while at >= 0:
            ids.append(last[at])
            at -= lengths[last[at]]
        return ids[::-1]

    def _words(self, part: str) -> list[str]:
        """The words of a run, normalised, in the byte-level alphabet."""
        if not self.plain(part):
            return [w for w, _ in self.split(self.normalize(part))]
        found = self.plain_words(part.lower())
        return found if part.isascii() else [w.encode().decode("latin-1").translate(self.alphabet) for w in found]

    def _run(self, run: str) -> bytes:
        ids: list[int] = []
        for part in self.added_form.split(run) if self.added_form and self.added_form.search(run) else [run]:
            if part in self.added:
                ids.append(self.added[part])
            elif part:
                for word in self._words(part):
                    known = self.words.get(word)
                    if known is None:
                        known = self.word(word)
                        self.words.put(word, known)
                    ids += known
        return array("I", ids).tobytes()

    def encode(self, text: str | None) -> bytes:
        """ids as little-endian unsigned 32-bit integers."""
        out, runs = [], self.runs
        for run in RUN.findall(text or ""):
            ids = runs.new.get(run)
            if ids is None and (ids := runs.get(run)) is None:
                ids = self._run(run)
                runs.put(run, ids)
            out.append(ids)
        return b"".join(out)


class Decoder:
    """Texts of ids as the vocabulary's library gives them: without a decoder of its own, a file's tokens stand side by side, apart by spaces."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if spec.get("decoder"):
            raise ValueError("vocabulary files with a decoder of their own are not covered")
        tokens = spec["model"]["vocab"] | {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = np.empty(max(tokens.values()) + 1, dtype=object)
        for t, i in tokens.items():
            self.tokens[i] = t

    def decode(self, ids: bytes) -> str:
        return " ".join(self.tokens[np.frombuffer(ids, dtype="<u4")].tolist())


@lru_cache(maxsize=2)
def encoder(path: str) -> PrefixEncoder:
    """One for each worker: it keeps what it has seen from task to task."""
    return PrefixEncoder(path)


@lru_cache(maxsize=2)
def decoder(path: str) -> Decoder:
    return Decoder(path)


def _batches(parts: Iterator[pa.RecordBatch], source: str, made: str, kind: pa.DataType, convert) -> Iterator[pa.RecordBatch]:
    """parts with a column made from source row by row, in batches of bounded size."""
    for batch in parts:
        start, values, held = 0, [], 0
        for n, x in enumerate(batch.column(source)):
            values.append(convert(x.as_py()))
            held += len(values[-1])
            if held >= BATCH_BYTES or n + 1 == batch.num_rows:
                piece = batch.slice(start, n + 1 - start)
                kept = [(name, c) for name, c in zip(piece.schema.names, piece.columns) if name != "text"]
                yield pa.RecordBatch.from_arrays([*(c for _, c in kept), pa.array(values, kind)], [*(name for name, _ in kept), made])
                start, values, held = n + 1, [], 0


def encode(docs: DataFrame, json_path: str) -> DataFrame:
    """doc_id and ids (binary, little-endian unsigned 32-bit integers) of each row's whole text."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(parts, "text", "ids", pa.binary(), encoder(json_path).encode)

    d = docs.select("doc_id", "text")
    return d.mapInArrow(run, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, ids binary")


def decode(encoded: DataFrame, json_path: str) -> DataFrame:
    """doc_id, ids and the text that the ids stand for."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(parts, "ids", "decoded", pa.string(), decoder(json_path).decode)

    d = encoded.select("doc_id", "ids")
    return d.mapInArrow(run, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, ids binary, decoded string")
