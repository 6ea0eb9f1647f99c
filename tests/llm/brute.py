"""Plain versions of operators, for tests."""

from __future__ import annotations


def shingle_set(text: str | None, n: int = 5) -> set:
    words = (text or "").encode().split()
    k = min(n, len(words))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if k else set()


def near_duplicate_classes(docs: list[tuple], threshold: float = 0.8) -> dict:
    """doc_id -> least doc_id reachable by pairs of Jaccard similarity >= threshold."""
    sets = [(i, shingle_set(t)) for i, t in docs]
    up = {i: i for i, _ in docs}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    by = {}
    for k, (_, s) in enumerate(sets):
        for x in s:
            by.setdefault(x, []).append(k)
    for k, (i, s) in enumerate(sets):
        seen: dict[int, int] = {}
        for x in s:
            for m in by[x]:
                if m > k:
                    seen[m] = seen.get(m, 0) + 1
        for m, both in seen.items():
            j, t = sets[m]
            if both >= threshold * (len(s) + len(t) - both):
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    return {i: find(i) for i, _ in docs}


def repeated_bytes(docs: list[tuple], span: int = 100) -> dict:
    """doc_id -> (n_bytes, n_removed, n_spans, sha256 of the rest), first occurrences by (doc_id, start)."""
    import hashlib

    seen, out = set(), {}
    for i, text in sorted(docs):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for s in range(len(raw) - span + 1):
            w = raw[s : s + span]
            if w in seen:
                gone[s : s + span] = b"\1" * span
            seen.add(w)
        runs = sum(1 for k in range(len(raw)) if gone[k] and (k == 0 or not gone[k - 1]))
        out[i] = (len(raw), sum(gone), runs, hashlib.sha256(bytes(b for b, g in zip(raw, gone) if not g)).hexdigest())
    return out


def base_personal_data(text: str | None) -> list[tuple[str, int, int]]:
    """Base matches by plain regular expressions, those that fail their kind's test dropped."""
    import re

    def luhn(d: str) -> bool:
        twice = [sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))]
        return sum(twice) % 10 == 0

    digits = lambda s: re.sub("[^0-9]", "", s)
    kinds = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 16 <= len(digits(s)) <= 19 and luhn(digits(s))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 8 <= len(digits(s)) <= 15),
    ]
    return [(k, *m.span()) for k, form, ok in kinds for m in re.finditer(form, text or "") if ok(m.group())]
