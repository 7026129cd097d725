"""The operators' results by the plainest means, for small inputs."""

from __future__ import annotations

import hashlib
import re
from itertools import combinations

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text: str | None, lower: bool = False) -> list[str]:
    text = text or ""
    if lower:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    return WORD.findall(text)


def shingles(text: str | None, k: int, whole_if_short: bool = True) -> set[tuple[str, ...]]:
    w = words(text, lower=True)
    if len(w) < k:
        return {tuple(w)} if w and whole_if_short else set()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def components(docs: list[tuple[int, str | None]], k: int, percent: int) -> dict[int, int]:
    sets = [(i, shingles(t, k)) for i, t in docs if i is not None]
    root = {i: i for i, _ in sets}

    def find(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    for (i, x), (j, y) in combinations(sets, 2):
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            a, b = sorted((find(i), find(j)))
            root[b] = a
    return {i: find(i) for i in root}


def leaks(docs: list[tuple[int, str | None]], items: list[tuple[int, str | None]], k: int = 5) -> dict[tuple[int, int], tuple[int, int]]:
    out = {}
    for j, item in items:
        wanted = shingles(item, k, False)
        for i, text in docs:
            hits = len(wanted & shingles(text, k, False))
            if wanted and 10 * hits >= 8 * len(wanted):
                out[i, j] = (len(wanted), max(hits, out.get((i, j), (0, 0))[1]))
    return out


def covered(docs: list[tuple[int, str | None]], window: int) -> list[list[bool]]:
    """Per document, per word: whether substring dedup removes it."""
    first: dict[tuple[str, ...], int] = {}
    for i, text in docs:
        w = words(text)
        for a in range(len(w) - window + 1):
            key = tuple(w[a : a + window])
            if i is not None:
                first[key] = min(i, first.get(key, i))
    out = []
    for i, text in docs:
        w = words(text)
        gone = [False] * len(w)
        for a in range(len(w) - window + 1):
            if i is not None and first[tuple(w[a : a + window])] < i:
                gone[a : a + window] = [True] * window
        out.append(gone)
    return out


def cut_text(text: str | None, gone: list[bool]) -> str | None:
    """The text without some words, each kept word with the white space behind it."""
    if not any(gone):
        return text
    spans = [m.span() for m in WORD.finditer(text)] + [(len(text), 0)]
    return "".join(text[spans[i][0] : spans[i + 1][0]] for i, g in enumerate(gone) if not g)


def sha(kept: list[str]) -> str:
    return hashlib.sha256(" ".join(kept).encode()).hexdigest()


def base_measures(text: str | None) -> tuple[int, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    w, text = words(text), text or ""
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    again = {i + j for i, g in enumerate(grams) if grams.count(g) > 1 for j in range(3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(again)


def base_failed(text: str | None) -> bool:
    n, _, _, _, again = base_measures(text)
    return n < 50 or 100 * again > 50 * n
