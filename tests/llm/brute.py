"""Plain-Python versions of the contracts, to compare with."""

from __future__ import annotations

import hashlib
import re

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_AZ = {c: c + 32 for c in range(65, 91)}


def fold(text: str | None) -> str:
    return (text or "").translate(_AZ)


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def near_duplicates(rows: list[tuple[int, str | None]]) -> dict[int, tuple[int, int]]:
    """doc_id -> (set size, component), for distinct ids."""
    sets, least = {}, {}
    for doc, text in rows:
        w = SPACE.findall(fold(text))
        sets[doc] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
        least[doc] = doc

    def root(x):
        while least[x] != x:
            x = least[x]
        return x

    by_shingle: dict = {}
    for doc in sorted(sets):
        seen: dict = {}
        for s in sets[doc]:
            for other in by_shingle.setdefault(s, []):
                seen[other] = seen.get(other, 0) + 1
            by_shingle[s].append(doc)
        for other, both in seen.items():
            if 100 * both >= 75 * (len(sets[doc]) + len(sets[other]) - both):
                a, b = root(doc), root(other)
                least[max(a, b)] = min(a, b)
    return {d: (len(sets[d]), root(d)) for d in sets}


def repeated_words(rows: list[tuple[int, str | None]]) -> dict[int, tuple[int, int, str]]:
    """doc_id -> (words, removed, digest of the rest), for distinct ids."""
    return {doc: (n, gone, digest(text)) for doc, (n, gone, text) in rest_of_repeated(rows).items()}


def rest_of_repeated(rows: list[tuple[int, str | None]]) -> dict[int, tuple[int, int, str]]:
    """doc_id -> (words, removed, the rest)."""
    first: dict = {}
    words = {doc: SPACE.findall(text or "") for doc, text in rows}
    for doc in sorted(words):
        w = words[doc]
        for i in range(len(w) - 12):
            first.setdefault(tuple(w[i : i + 13]), doc)
    out = {}
    for doc, w in words.items():
        gone = set()
        for i in range(len(w) - 12):
            if first[tuple(w[i : i + 13])] < doc:
                gone.update(range(i, i + 13))
        out[doc] = (len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone))
    return out


def contamination(rows, items) -> dict[int, tuple]:
    """doc_id -> (words, hit, items, digest, contaminated), for distinct ids."""
    windows: dict = {}
    for item, text in items:
        w = PLAIN.findall(fold(text))
        for i in range(max(1, len(w) - 12)) if w else ():
            windows.setdefault(tuple(w[i : i + 13]), set()).add(item)
    sizes = {len(w) for w in windows}
    out = {}
    for doc, text in rows:
        w = PLAIN.findall(fold(text))
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if names := windows.get(tuple(w[i : i + n])):
                    found |= names
                    hit.update(range(i, i + n))
        names = ",".join(sorted(map(str, found)))
        out[doc] = (len(w), len(hit), len(found), digest(names), len(hit) > 0 and 20 * len(hit) >= len(w))
    return out
