"""Plain single-process versions of the operators, to hold the Spark ones against."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

JACCARD_WORD = re.compile(r"[^\x20\x09-\x0D]+")
BENCH_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text: str | None) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def sha(data: bytes | str) -> str:
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def cut_repeats(docs: list[tuple[int, str | None]], length: int) -> dict[int, tuple[int, list[list[int]], bytes]]:
    """Documents with distinct ids: their size, cut spans and kept bytes."""
    seen: set[bytes] = set()
    result = {}
    for doc, text in sorted(docs, key=lambda d: d[0]):
        data = (text or "").encode()
        strings = [data[i : i + length] for i in range(len(data) - length + 1)]
        gone = [False] * len(data)
        for i, s in enumerate(strings):
            if s in seen:
                gone[i : i + length] = [True] * length
        seen.update(strings)
        edges = [i for i in range(len(data) + 1) if (i < len(data) and gone[i]) != (i > 0 and gone[i - 1])]
        spans = [list(x) for x in zip(edges[::2], edges[1::2], strict=True)]
        result[doc] = (len(data), spans, bytes(b for b, g in zip(data, gone, strict=True) if not g))
    return result


def contamination(text: str | None, items: list[tuple[object, str | None]], window: int = 10) -> tuple[int, set[int], list[str]]:
    """The document's number of words, the hit ones and the ids of the items that occur."""
    words = BENCH_WORD.findall(lower(text))
    hit: set[int] = set()
    found: set[str] = set()
    for item, item_text in items:
        test = BENCH_WORD.findall(lower(item_text))
        n = min(window, len(test))
        windows = {tuple(test[i : i + n]) for i in range(len(test) - n + 1)} if n else set()
        for i in range(len(words) - n + 1):
            if n and tuple(words[i : i + n]) in windows:
                hit.update(range(i, i + n))
                found.add(str(item))
    return len(words), hit, sorted(found)


def shingles(text: str | None, n: int = 5) -> set[tuple[str, ...]]:
    words = JACCARD_WORD.findall(lower(text))
    if not words:
        return set()
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))}


def components(docs: list[tuple[int, str | None]], percent: int = 75) -> dict[int, tuple[int, int]]:
    """Documents with distinct ids: the size of their set and the smallest id of their component."""
    sets = {d: shingles(t) for d, t in docs}
    holders = defaultdict(list)
    for d, s in sets.items():
        for g in s:
            holders[g].append(d)
    common: dict[tuple[int, int], int] = defaultdict(int)
    for own in holders.values():
        for i, a in enumerate(own):
            for b in own[:i]:
                common[a, b] += 1
    parent = {d: d for d in sets}

    def find(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, b), k in common.items():
        if 100 * k >= percent * (len(sets[a]) + len(sets[b]) - k):
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    return {d: (len(s), find(d)) for d, s in sets.items()}
