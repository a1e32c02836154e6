"""The operators in plain Python over all pairs, all windows and all positions."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


def sha256(x: str | bytes) -> str:
    return hashlib.sha256(x.encode() if isinstance(x, str) else x).hexdigest()


class Groups:
    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> None:
        self.up[self.find(x)] = self.find(y)


def contamination(texts: list[str | None], items: list[tuple]) -> list[tuple]:
    """(n_words, n_hit, n_items, items_sha256, contaminated) of every text."""
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    split = lambda t: word.findall((t or "").translate(ASCII_LOWER))
    windows = defaultdict(set)
    for item, text in items:
        w = split(text)
        size = min(13, len(w))
        for i in range(len(w) - size + 1 if size else 0):
            windows[tuple(w[i : i + size])] |= {str(item)} - {"None"}
    sizes = {len(k) for k in windows}
    out = []
    for text in texts:
        w, hit, found = split(text), set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                if tuple(w[i : i + size]) in windows:
                    hit |= set(range(i, i + size))
                    found |= windows[tuple(w[i : i + size])]
        bad = bool(hit) and 20 * len(hit) >= len(w)
        out.append((len(w), len(hit), len(found), sha256(",".join(sorted(found))), bad))
    return out


def secrets(text: str | None) -> tuple:
    """(n_assign, n_access, n_hex, base_sha256) of a text."""
    kinds = [
        ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
        ("access", r"AKIA[A-Z0-9]+", 0, 16),
        ("hex", r"[0-9a-f]+", 0, 32),
    ]
    found = []
    for k, (kind, pattern, group, least) in enumerate(kinds):
        found += [(m.start(), k, kind, m.end()) for m in re.finditer(pattern, text or "", re.ASCII) if len(m[group]) >= least]
    found.sort()
    count = Counter(f[2] for f in found)
    listed = ",".join(f"{f[2]}:{f[0]}:{f[3]}" for f in found)
    return count["assign"], count["access"], count["hex"], sha256(listed)


def quality(text: str | None) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed) of a text."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, again = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(covered), failed


def repeats(texts: list[str | None], length: int) -> list[tuple]:
    """(n_bytes, n_removed, n_spans, kept_sha256) of every text."""
    data = [(t or "").encode() for t in texts]
    count = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if count[d[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        runs = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((len(d), sum(gone), runs, sha256(bytes(b for b, g in zip(d, gone) if not g))))
    return out


def shingle_set(text: str | None, size: int) -> frozenset:
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(ASCII_LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1)))


def jaccard_groups(texts: list[str | None], size: int, similar: int, of: int) -> tuple[list[int], list[int]]:
    """(set sizes, group of every text)."""
    sets = [shingle_set(t, size) for t in texts]
    groups = Groups(len(texts))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            common = len(a & b) if a and b else 0
            if common and of * common >= similar * (len(a) + len(b) - common):
                groups.join(i, j)
    return [len(s) for s in sets], [groups.find(i) for i in range(len(texts))]


def edit_distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def normal_line(line: str) -> str:
    line = re.sub("[0-9]", "0", line.translate(ASCII_LOWER))
    return " ".join(re.findall(r"[a-z0\u0080-\U0010ffff]+", line))
