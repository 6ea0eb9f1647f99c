"""PII: candidate gradient boosting.

Base patterns (email, ip, card, phone) always stand. High-recall generators propose
further, overlapping spans: written-out addresses, phone numbers without a country's plus
sign, cards and quads with other separators. Boosted trees see a candidate's format and
context and select among them.

What is sought has no labels, so it is made from what is known: each base match of every
document is rendered in forms that the base patterns miss,
in its own context (positives), and gives way there to numbers and phrases of the same look
that are nobody's (dates, prices, versions, book and order numbers: background). A
document's own candidates outside base spans carry no label and are left out, so that
nothing sought is taught as background. Features are codes of whole numbers, so examples are
counted by their codes, label and fold, and the trees grow from the counts of all of them: on the
driver where at most DRIVER_ROWS different ones are left, else from sums that tasks add up, to
the same trees. Each kind has its own threshold, calibrated by
cross-fitting: of the scores that the folds' models give to the background of documents they have not
seen, at most BACKGROUND_SHARE lie above it; it is never below MIN_SCORE. The final model is fitted on all folds.
Selected spans overlap neither base spans nor better ones.

Defined results: null is an empty text without spans; offsets are code points, ends
exclusive; rows are judged one by one, so repeated rows and null ids stay; a table without
base matches gives nothing to learn from, and base spans only; an empty table gives an
empty table.
"""

from __future__ import annotations

import bisect
import hashlib
import itertools
import random
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import gbdt
from .common import keep

KINDS = ("email", "ip", "card", "phone")
#: Different counted examples that are learnt from on the driver, of some 400 bytes each there; more are left in tasks.
DRIVER_ROWS = 100_000
#: Examples that a task holds at once.
CHUNK = 5_000
FOLDS = 4
TREES = 60
#: Parts of one to which margins are rounded up where scores of background are counted.
MARGIN_STEPS = 64
BACKGROUND_SHARE = 0.01
MIN_SCORE = 0.5

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)+")
_DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_AT = r"(?:\s?[(\[{<]\s?(?:at|@)\s?[)\]}>]\s?|\s(?:at|@)\s)"
_DOT = r"(?:\s?[(\[{<]\s?(?:dot|\.)\s?[)\]}>]\s?|\sdot\s|\s\.\s|\.)"
_WRITTEN = re.compile(rf"{_AT}[A-Za-z0-9-]{{1,63}}(?:{_DOT}[A-Za-z0-9-]{{1,63}}){{1,4}}", re.I)
_GROUPED = re.compile(r"(?<![0-9A-Za-z.])[(+]?[0-9]+(?:[\x20().,:/\u00a0-]{1,3}[0-9]+)*(?![0-9A-Za-z])")
_QUAD = re.compile(rf"(?<![0-9A-Za-z.])[0-9]{{1,3}}(?:{_DOT}[0-9]{{1,3}}){{3}}(?![0-9A-Za-z])", re.I)
_ANY = re.compile(r"[0-9@]|[(\[{<]\s?at\s?[)\]}>]|\sat\s", re.I)
_HINTS = {"email": re.compile(r"mail|contact|write", re.I), "ip": re.compile(r"\bip\b|host|server|address", re.I), "card": re.compile(r"card|visa|carte|tarjeta|karte|credit", re.I), "phone": re.compile(r"phone|tel|call|mobile|fax", re.I)}
CONTEXT = 24


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and _LOCAL.match(text[start - 1]):
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            last = m.end()
            yield start, last
        at = text.find("@", max(at + 1, last))


def _written(text: str) -> Iterator[tuple[int, int]]:
    """name (at) domain (dot) tld, or the same with bare words or spaces."""
    for m in _WRITTEN.finditer(text):
        start = m.start()
        while start > max(0, m.start() - 64) and _LOCAL.match(text[start - 1]):
            start -= 1
        if start < m.start():
            yield start, m.end()


def _only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """Leftmost, non-overlapping matches of each kind that pass its test."""
    out: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    out["email"] = list(_emails(text))
    for m in _DOTTED.finditer(text):
        parts, at = m.group().split("."), m.start()
        for i in range(0, len(parts) - 3, 4):
            size = sum(map(len, parts[i : i + 4])) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p[-3:] if not p.strip("0") else p.lstrip("0")) <= 255 for p in parts[i : i + 4]):
                out["ip"].append((at, at + size))
            at += size + 1
    for m in _DIGITS.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(d := _only_digits(m.group())) <= 19 and luhn(d):
            out["card"].append(m.span())
    for m in _PHONE.finditer(text):
        if 8 <= len(_only_digits(m.group())) <= 15:
            out["phone"].append(m.span())
    return out


def proposals(text: str) -> list[tuple[str, int, int]]:
    """High recall: spans of any kind that might be personal data; they may overlap."""
    out = [("email", *x) for x in _written(text)] + [("ip", *m.span()) for m in _QUAD.finditer(text)]
    for m in _GROUPED.finditer(text):
        n = sum(c.isdecimal() for c in m.group())
        if 7 <= n <= 15:
            out.append(("phone", *m.span()))
        if 13 <= n <= 19:
            out.append(("card", *m.span()))
    return out


#: Characters that a candidate's features count.
_COUNTED = " -./:,()[]@"


def features(text: str, kind: str, start: int, end: int) -> list[float]:
    """Format and context of a candidate, whole numbers from 0. Candidates never match a base pattern, so none of these is its test."""
    s, before, after = text[start:end], text[max(0, start - CONTEXT) : start], text[end : end + CONTEXT]
    digits = _only_digits(s)
    groups = re.findall(r"[0-9]+", s)
    sizes = [*map(len, groups)] or [0]
    first = int(groups[0][:6]) if groups else 0
    edge = lambda c: 0 if not c else 1 if c.isspace() else 2 if c.isalpha() else 3 if c.isdigit() else 4
    words = re.findall(r"[A-Za-z]+", s.lower())
    return [
        float(KINDS.index(kind)), len(s), len(digits), len(groups), max(sizes), min(sizes), sizes[0], sizes[-1], *map(s.count, _COUNTED), sum(c.isalpha() for c in s), words.count("at"), words.count("dot"),
        2.0 * luhn(digits) if len(digits) >= 13 else 1.0, float(all(int(g[:6]) <= 255 for g in groups)), float(first), float(s[:1] == "0"), float(s[:1] in "(+"), float(len(set(digits))),
        float(any(len(g) == 4 and 1900 <= int(g) <= 2100 for g in groups)), float(all(len(g) == 4 for g in groups)), float(len(words[-1]) if words else 0),
        edge(before[-1:]), edge(after[:1]), *(float(bool(h.search(before))) for h in _HINTS.values()), float(before.rstrip()[-1:] in {"=", ":", "#"}), float(before.rstrip()[-1:] in {'"', "'"}),
    ]


class Taken:
    """Spans, of which those added later overlap none; tells whether another overlaps any."""

    def __init__(self, spans: Iterable[tuple[int, int]]):
        first = sorted(spans)
        self.starts, self.reach = [s for s, _ in first], list(itertools.accumulate((e for _, e in first), max))
        self.more: list[tuple[int, int]] = []

    def overlaps(self, s: int, e: int) -> bool:
        i, j = bisect.bisect_left(self.starts, e), bisect.bisect_left(self.more, (e,))
        return (i > 0 and self.reach[i - 1] > s) or (j > 0 and self.more[j - 1][1] > s)

    def add(self, s: int, e: int) -> None:
        bisect.insort(self.more, (s, e))


def renderings(kind: str, s: str, pick: random.Random) -> list[str]:
    """Forms of a base match that base patterns miss."""
    digits = _only_digits(s)
    if kind == "email":
        out = []
        for _ in range(8):
            # other names and hosts of the same make, so that no one corpus's habit is taken for the format
            name, _, host = s.partition("@")
            labels = host.split(".")
            name = pick.choice([name, name.rstrip("0123456789.") or name, re.split("[._+-]", name)[0] or name, name.title()])
            host = ".".join(labels[pick.randint(0, len(labels) - 2) : -1] + [pick.choice([labels[-1], "org", "net", "de", "io", "co.uk"])])
            at = pick.choice([" (at) ", "(at)", " [at] ", "[at]", " at ", " AT ", " {at} ", " @ "])
            dot = pick.choice([" (dot) ", "(dot)", " [dot] ", "[.]", " dot ", " dot ", " DOT ", " . "] + ["."] * (at not in (" at ", " AT ")))
            out.append(f"{name}{at}{host.replace('.', dot)}")
        return out
    if kind == "ip":
        return [s.replace(".", x) for x in ("[.]", " . ", "(.)", " dot ", "[dot]")]
    if kind == "card":
        four = [digits[i : i + 4] for i in range(0, len(digits), 4)]
        return [x.join(four) for x in (".", "/", "  ", " - ", "\u00a0")]
    own = digits[-10:]
    area, mid, last = own[:-7], own[-7:-4], own[-4:]
    if not area:
        return [f"{mid}-{last}", f"{mid} {last}", f"{mid}.{last}"]
    return [f"({area}) {mid}-{last}", f"{area}-{mid}-{last}", f"{area}.{mid}.{last}", f"0{area} {mid} {last}", f"0{area}/{mid}{last}", f"{area} {mid} {last}", f"00{digits[: len(digits) - len(own)] or 1} {area} {mid} {last}", f"({area}){mid}{last}"]


WORDS = ("noon", "home", "shop", "example", "mail", "school", "the", "port7", "news", "once")


def background(pick: random.Random) -> list[str]:
    """Numbers and phrases of the same look that are nobody's."""
    n, two = (lambda lo, hi: pick.randint(lo, hi)), lambda hi: f"{pick.randint(1, hi):02d}"
    y, m, d = n(1900, 2100), two(12), two(28)
    digits = lambda k: "".join(str(n(0, 9)) for _ in range(k))
    false = digits(15)
    false += next(c for c in "0123456789" if not luhn(false + c))  # no card: its check digit is wrong
    four = pick.choice(["-", " ", ".", "/", ""]).join(false[i : i + 4] for i in range(0, 16, 4))
    isbn = digits(9)
    return [
        f"{y}-{m}-{d}", f"{d}.{m}.{y}", f"{m}/{d}/{y}", f"{d}/{m}/{y} {two(23)}:{two(59)}", f"{y}-{m}-{d} {two(23)}:{two(59)}:{two(59)}", f"{y}{m}{d}", f"{y}-{n(1900, 2100)}", f"{y} {n(1900, 2100)}",
        f"{n(1, 999)},{digits(3)},{digits(3)}", f"{n(1, 999)}.{digits(3)}.{digits(3)},{digits(2)}", f"{n(1, 999)},{digits(3)}.{digits(2)}", f"{n(1, 99)} {digits(3)} {digits(3)}", f"{n(1, 9)}.{digits(7)}", f"{n(0, 90)}.{digits(4)}, {n(0, 180)}.{digits(4)}",
        digits(7), digits(9), digits(10), digits(12), four, f"978-{isbn[0]}-{isbn[1:4]}-{isbn[4:9]}-{n(0, 9)}", f"{n(1, 20)}.{n(0, 40)}.{n(0, 40)}.{n(256, 999)}", f"{n(1, 9)} . {n(256, 999)} . {n(0, 9)} . {n(0, 9)}", f"{n(1, 9)} {n(1, 9)} {n(1, 9)} {n(1, 9)} {n(1, 9)} {n(1, 9)} {n(1, 9)}",
        f"look at {pick.choice(WORDS)}.com", f"us at www.{pick.choice(WORDS)}.{pick.choice(WORDS)}.de", f"bought at {pick.choice(WORDS)}.{pick.choice(WORDS)} for", f"arrived at {pick.choice(WORDS)}.{pick.choice(WORDS)}", f"stay at home . {n(1, 9)}", f"{n(2, 9)} @ {n(1, 99)}.{digits(2)}", f"sold at {n(1, 99)}.{digits(2)}", f"looked at it . and", f"at {n(1, 12)}.{two(59)}", f"ratio {n(1, 9)}:{n(1, 9)}:{digits(4)}:{digits(4)}",
    ]


def examples(text: str) -> Iterator[tuple[list[float], int]]:
    """Candidates over renderings of all base matches (1), and over what is nobody's in their place (0)."""
    base = base_spans(text)
    found = sorted((s, e, k) for k in KINDS for s, e in base[k])
    pick = random.Random(f"{len(text)}:{found}")
    for s, e, kind in found:
        for y, forms in ((1, renderings(kind, text[s:e], pick)), (0, background(pick))):
            for form in forms:
                # the context reaches as far as a candidate's features look, and as its name may
                near = text[max(0, s - 100) : s], text[e : e + 100]
                at, new = len(near[0]), near[0] + form + near[1]
                now = Taken(x for v in base_spans(new).values() for x in v)
                for k, a, b in proposals(new):
                    if a < at + len(form) and at < b and not now.overlaps(a, b):
                        whole = k == kind and a <= at and b >= at + len(form) and b - a <= len(form) + 2
                        if y == 0 or whole:
                            yield features(new, k, a, b), y


class Selector:
    """A fitted model with its threshold for each kind."""

    def __init__(self, model: gbdt.Trees | None, cuts: dict[str, float]):
        self.model, self.cuts = model, cuts

    def spans(self, text: str) -> tuple[dict[str, list[tuple[int, int]]], dict[str, list[tuple[int, int]]]]:
        """Base spans, and all spans, by kind."""
        if not _ANY.search(text):
            return {k: [] for k in KINDS}, {k: [] for k in KINDS}
        base = base_spans(text)
        taken = Taken(x for k in KINDS for x in base[k])
        more = [x for x in proposals(text) if not taken.overlaps(*x[1:])] if self.model else []
        chosen = {k: list(base[k]) for k in KINDS}
        if more:
            score = self.model.score(gbdt.coded(np.array([features(text, *x) for x in more])))
            for i in np.argsort(-score, kind="stable"):
                k, s, e = more[i]
                if score[i] > self.cuts[k] and not taken.overlaps(s, e):
                    taken.add(s, e)
                    chosen[k].append((s, e))
        return base, {k: sorted(v) for k, v in chosen.items()}


N_FEATURES = len(features("", "email", 0, 0))


def example_counts(docs: DataFrame) -> DataFrame:
    """Codes (a byte each) and labels of the examples of all different documents, with their numbers in each fold."""
    rows = docs.select(F.xxhash64("doc_id", "text").alias("h"), "text")

    def block(found: list[tuple[int, int, list[float], int]]) -> pd.DataFrame:
        codes = gbdt.coded(np.array([x for _, _, x, _ in found]).reshape(-1, N_FEATURES))
        return pd.DataFrame({"h": [f[0] for f in found], "n": [f[1] for f in found], "codes": [c.tobytes() for c in codes], "y": [f[3] for f in found]})

    def measure(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = []
        for pdf in parts:
            for h, t in zip(pdf["h"], pdf["text"]):
                for n, (x, y) in enumerate(examples(t) if t and _ANY.search(t) else ()):
                    found.append((h, n, x, y))
                    if len(found) == CHUNK:
                        yield block(found)
                        found = []
        yield block(found)

    # repeated rows count once
    every = rows.mapInPandas(measure, "h long, n long, codes binary, y int").distinct()
    by_fold = [F.sum((F.pmod("h", F.lit(FOLDS)) == k).cast("long")).alias(f"n{k}") for k in range(FOLDS)]
    return keep(every.groupBy("codes", "y").agg(*by_fold), "pii-examples")


def unpacked(counted: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes (each feature's in one piece of memory), labels and numbers by fold."""
    codes = np.frombuffer(b"".join(counted["codes"]), dtype=np.uint8).reshape(-1, N_FEATURES)
    return np.asfortranarray(codes, dtype=np.int64), counted["y"].to_numpy(dtype=float), counted[[f"n{k}" for k in range(FOLDS)]].to_numpy(dtype=float)


def training_rows(docs: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different codes and labels of all examples, with their numbers by fold; for tables whose counted examples fit the driver."""
    return unpacked(example_counts(docs).toPandas())


def learners(positives: np.ndarray) -> np.ndarray:
    """The folds (columns) that each model learns from: those other than its own, for the last one all. A fold that holds all positives is scored by a model of all rows."""
    use = np.vstack([1 - np.eye(FOLDS), np.ones(FOLDS)])
    use[use @ positives == 0] = 1
    return use


def background_margins(models: list[gbdt.Trees], x: np.ndarray, y: np.ndarray, n: np.ndarray) -> pd.DataFrame:
    """How much background of each kind has which margin, rounded up, with the model that has not seen it."""
    x, n = x[y == 0], n[y == 0]
    parts = [pd.DataFrame({"kind": x[:, 0], "step": np.ceil(np.clip(models[k].margin(x), -30, 30) * MARGIN_STEPS).astype(int), "n": n[:, k].astype(int)}) for k in range(FOLDS)]
    return pd.concat(parts).query("n > 0").groupby(["kind", "step"], as_index=False)["n"].sum()


def thresholds(margins: pd.DataFrame) -> dict[str, float]:
    cuts = {}
    for i, k in enumerate(KINDS):
        own = margins[margins["kind"] == i].sort_values("step", ascending=False)
        above = own["n"].cumsum() - own["n"]
        step = own["step"][above <= BACKGROUND_SHARE * own["n"].sum()].min() if len(own) else -30 * MARGIN_STEPS
        cuts[k] = max(MIN_SCORE, float(1 / (1 + np.exp(-step / MARGIN_STEPS))))
    return cuts


def fitted(x: np.ndarray, y: np.ndarray, fold: np.ndarray, trees: int = TREES) -> Selector:
    """A model of all rows, with thresholds from the scores that models of the other folds give to each fold's background. fold: one for each row, or each row's numbers by fold."""
    n = np.eye(FOLDS)[fold] if fold.ndim == 1 else fold
    by_class = np.stack([n[y == v].sum(axis=0) for v in (0, 1)], axis=1)
    if not by_class[:, 1].any():
        return Selector(None, {})
    use = learners(by_class[:, 1])
    models = gbdt.grown(gbdt.held_sums(x, y, use @ n.T), use @ by_class, trees)
    return Selector(models[-1], thresholds(background_margins(models, x, y, n)))


def fitted_in_tasks(counted: DataFrame, trees: int = TREES) -> Selector:
    """fitted() for counted examples of any number: tasks add up what the trees grow from, and the driver gets the sums."""
    got = {r.y: np.array(r[1:], dtype=float) for r in counted.groupBy("y").agg(*(F.sum(f"n{k}") for k in range(FOLDS))).collect()}
    by_class = np.stack([got.get(v, np.zeros(FOLDS)) for v in (0, 1)], axis=1)
    if not by_class[:, 1].any():
        return Selector(None, {})
    use = learners(by_class[:, 1])

    def sums(models: list[gbdt.Trees], level: int) -> np.ndarray:
        shape = (len(models), 1 << level, N_FEATURES, gbdt.CODES, 2)

        def add(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = np.zeros(shape)
            for pdf in parts:
                x, y, n = unpacked(pdf)
                total += gbdt.level_sums(x, y, use @ n.T, models, [m.first(len(m.leaf) - 1).margin(x) for m in models], level)
            yield pd.DataFrame({"node": range(shape[0] * shape[1]), "part": [a.tobytes() for a in total.reshape(-1, *shape[2:])]})

        def joined(pdf: pd.DataFrame) -> pd.DataFrame:
            total = sum(np.frombuffer(part) for part in pdf["part"])
            return pd.DataFrame({"node": pdf["node"][:1], "part": [total.tobytes()]})

        each = counted.mapInPandas(add, "node int, part binary").groupBy("node").applyInPandas(joined, "node int, part binary")
        return np.frombuffer(b"".join(each.toPandas().sort_values("node")["part"])).reshape(shape)

    models = gbdt.grown(sums, use @ by_class, trees)

    def margins(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            yield background_margins(models, *unpacked(pdf))

    tallied = counted.mapInPandas(margins, "kind long, step long, n long").groupBy("kind", "step").agg(F.sum("n").alias("n"))
    return Selector(models[-1], thresholds(tallied.toPandas()))


def train(docs: DataFrame, driver_rows: int = DRIVER_ROWS, trees: int = TREES) -> Selector:
    counted = example_counts(docs)
    return fitted(*unpacked(counted.toPandas()), trees) if counted.count() <= driver_rows else fitted_in_tasks(counted, trees)


def listed(spans: dict[str, list[tuple[int, int]]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k in KINDS for s, e in spans[k])


def find(docs: DataFrame, selector: Selector) -> DataFrame:
    """Counts of base spans by kind, their digest, and all spans, for every row."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            rows = []
            for t in pdf["text"]:
                base, chosen = selector.spans(t or "")
                rows.append((*(len(base[k]) for k in KINDS), hashlib.sha256(listed(base).encode()).hexdigest(), listed(chosen), sum(map(len, chosen.values()))))
            out = pd.DataFrame(rows, columns=[*(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_spans"])
            out.insert(0, "doc_id", pdf["doc_id"].to_numpy())
            yield out

    return docs.select("doc_id", "text").mapInPandas(run, "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string, n_spans long")


def detect(docs: DataFrame) -> DataFrame:
    return find(docs, train(docs))


def redacted(text: str, spans: dict[str, list[tuple[int, int]]]) -> str:
    """Each span, or run of overlapping spans, becomes its first kind in brackets."""
    out, at = [], 0
    for s, e, k in sorted((s, e, k) for k in KINDS for s, e in spans[k]):
        if s >= at:
            out += [text[at:s], f"[{k.upper()}]"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame) -> DataFrame:
    """docs with the selected spans replaced in text; its columns stay."""
    selector = train(docs)

    @F.pandas_udf("string")
    def cleaned(text: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else redacted(t, selector.spans(t)[1]) for t in text], dtype=object)

    return docs.withColumn("text", cleaned("text"))
