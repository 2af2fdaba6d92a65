"""Plain single-process versions that the operators are held against."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from itertools import combinations

WORD = re.compile("[^\x20\x09-\x0D]+")
_LOWER = {c: c + 32 for c in range(65, 91)}


def lower_ascii(text: str) -> str:
    return text.translate(_LOWER)


class Sets(dict):
    """Union-find; every id's root is the smallest of its set."""

    def find(self, x):
        self.setdefault(x, x)
        while self[x] != x:
            self[x] = self[self[x]]
            x = self[x]
        return x

    def join(self, x, y):
        x, y = self.find(x), self.find(y)
        if x != y:
            self[max(x, y)] = min(x, y)


def similar_pairs(sets: dict, num: int, den: int):
    """Pairs whose Jaccard similarity is num / den or more, by counting shared members."""
    members = defaultdict(list)
    for k, s in sets.items():
        for m in s:
            members[m].append(k)
    shared = Counter(p for ks in members.values() for p in combinations(sorted(ks), 2))
    for (a, b), n in shared.items():
        if n * den >= num * (len(sets[a]) + len(sets[b]) - n):
            yield a, b


def text_stats(text: str | None) -> tuple[int, int, int, int, int]:
    text = text or ""
    words = WORD.findall(text)
    at = defaultdict(list)
    for i in range(len(words) - 7):
        at[tuple(words[i:i + 8])].append(i)
    covered = {j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def line_shingles(line: str, size: int) -> frozenset:
    line = " ".join(WORD.findall(line))
    return frozenset(line[i:i + size] for i in range(max(1, len(line) - size + 1)))


def redundant_lines(docs: list[tuple], size: int, threshold: float, min_chars: int) -> dict:
    """(doc_id, text) to the positions of lines that go."""
    spots = defaultdict(list)
    for doc_id, text in docs:
        for at, line in enumerate((text or "").split("\n")):
            if len("".join(WORD.findall(line))) >= min_chars:
                spots[line].append((doc_id, text, at))
    sets = {line: line_shingles(line, size) for line in spots}
    joined = Sets()
    for a, b in similar_pairs(sets, round(threshold * 1000), 1000):
        joined.join(a, b)
    groups = defaultdict(list)
    for line, where in spots.items():
        groups[joined.find(line)] += where
    out = defaultdict(set)
    for where in groups.values():
        keep = min(where, key=lambda w: (w[0], w[2]))
        for doc_id, text, at in where:
            if (doc_id, at) != (keep[0], keep[2]):
                out[doc_id].add(at)
    return out


def word_shingles(text: str | None, n: int = 5) -> frozenset:
    words = WORD.findall(lower_ascii(text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1)))


def near_components(docs: list[tuple]) -> dict:
    """doc_id to (set size, smallest linked doc_id)."""
    sets = {d: word_shingles(t) for d, t in docs}
    joined = Sets()
    for a, b in similar_pairs({d: s for d, s in sets.items() if s}, 75, 100):
        joined.join(a, b)
    return {d: (len(s), joined.find(d)) for d, s in sets.items()}
