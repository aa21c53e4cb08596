"""Plain versions of the operators that tests hold results against."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import xxhash


def simhash(text: str | None) -> int:
    words = [w for w in re.split(r"[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints: dict) -> dict:
    """doc -> smallest doc reachable over links of at most 3 bits."""
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for x, i in enumerate(ids):
        for j in ids[x + 1 :]:
            if bin(prints[i] ^ prints[j]).count("1") <= 3:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in ids}


def secrets(text: str) -> list[tuple[str, int, int]]:
    found = []
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    for kind, pattern, good in (("assign", assign, lambda m: len(m[2]) >= 6), ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20), ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24)):
        found += [(kind, m.start(), m.end()) for m in pattern.finditer(text) if good(m)]
    order = ("assign", "access", "hex")
    return sorted(found, key=lambda f: (f[1], order.index(f[0])))


def listed(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def nearest(rows: list[tuple], query: int, k: int) -> list[tuple[int, float]]:
    vec = {i: np.array(v, float) for i, v in rows if i is not None and v is not None and all(c is not None and np.isfinite(c) for c in v) and any(c for c in v)}
    q = vec[query]
    scored = [(-(float((q * v).sum()) / (np.sqrt((q * q).sum()) * np.sqrt((v * v).sum()))), i) for i, v in vec.items() if i != query and len(v) == len(q)]
    return [(i, -s) for s, i in sorted(scored)[:k]]
