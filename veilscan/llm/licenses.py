"""License scans: fuzzy search of short notices.

A notice that may have k edits is cut into k + 1 seeds, of which at least one is then found unchanged.  Exact seeds
locate windows; in those the regex library's bounded-error matching verifies the edits and gives spans.  Edits may fall
anywhere but on the words that tell licenses apart: a span must have its notice's words of that kind, and no other's.
"""

from __future__ import annotations

import bisect
from dataclasses import dataclass

import numpy as np
import regex
from pyspark.sql import DataFrame

from .common import map_texts

#: To blanks: what is no word; A-Z to lower case.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 or 48 <= b <= 57 else 32 for b in range(256))
#: Phrases found exactly, word by word, and their labels (fixed values).
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: Short notices searched with edits: their labels, words, and the words that tell them from others.
NOTICES = (
    ("mit", "released under the mit license", "mit"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", ""),
    ("apache-2", "licensed under the apache license version 2 0", "apache 2"),
    ("gpl-3", "licensed under the gnu general public license version 3", "3"),
    ("gpl-2", "licensed under the gnu general public license version 2", "2"),
    ("lgpl", "licensed under the gnu lesser general public license", "lesser"),
    ("agpl-3", "licensed under the gnu affero general public license version 3", "affero 3"),
    ("mpl-2", "subject to the terms of the mozilla public license v 2 0", "mozilla 2"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", ""),
    ("bsd", "released under the bsd license", "bsd"),
    ("isc", "released under the isc license", "isc"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-nd", "licensed under cc by nd 4 0", "cc by nd"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("unlicense", "this is free and unencumbered software released into the public domain", ""),
)
#: Edits allowed for so many characters of a notice.
CHARS_AN_EDIT = 10


@dataclass(frozen=True)
class Notice:
    """A notice with its seeds (start in the notice, bytes), its compiled bounded-error pattern, and the words a span must and must not have."""

    label: str
    text: bytes
    edits: int
    seeds: tuple[tuple[int, bytes], ...]
    pattern: regex.Pattern
    own: tuple[bytes, ...] = ()
    rivals: frozenset[bytes] = frozenset()
    grams: tuple[bytes, ...] = ()

    def possible(self, window: bytes) -> bool:
        """Whether a window can have a match: an edit spoils at most three of the notice's trigrams, and its own words are there."""
        return all(w in window for w in self.own) and sum(g in window for g in self.grams) >= len(self.grams) - 3 * self.edits

    def told(self, span: bytes) -> bool:
        """Whether a span has this notice's own words, in order, and none of its rivals'."""
        words = span.split()
        rest = iter(words)
        return all(w in rest for w in self.own) and self.rivals.isdisjoint(words)


def notice(label: str, text: str, own: str = "", rivals: frozenset[bytes] = frozenset(), chars_an_edit: int = CHARS_AN_EDIT) -> Notice:
    raw = text.encode()
    k = max(1, len(raw) // chars_an_edit)
    cuts = [round(i * len(raw) / (k + 1)) for i in range(k + 2)]
    pattern = regex.compile(rf"(?b)(?<![0-9a-z])(?:{regex.escape(text)}){{e<={k}}}(?![0-9a-z])".encode())
    return Notice(label, raw, k, tuple((a, raw[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)), pattern, tuple(own.encode().split()), rivals - set(raw.split()), tuple(raw[i : i + 3] for i in range(len(raw) - 2)))


_compiled: dict[tuple, list[Notice]] = {}


def compiled(notices: tuple = NOTICES) -> list[Notice]:
    """This worker's notices; each has the telling words of all others as rivals."""
    if notices not in _compiled:
        telling = frozenset(w for _, _, own in notices for w in own.encode().split())
        _compiled[notices] = [notice(*n, rivals=telling) for n in notices]
    return _compiled[notices]


def fold(text: bytes) -> tuple[int, bytes]:
    """Number of words; the words between single blanks, one at both ends."""
    words = text.translate(FOLD).split()
    return len(words), b" " + b" ".join(words) + b" "


def places(line: bytes, words: bytes) -> list[int]:
    """Starting words of all places where these words stand one after another."""
    out, at, counted, n = [], line.find(words), 0, 0
    while at >= 0:
        n += line.count(b" ", counted, at)
        counted = at
        out.append(n)
        at = line.find(words, at + 1)
    return out


def windows(line: bytes, n: Notice) -> list[tuple[int, int]]:
    """Where n may stand: around the starts that its exact seeds tell.  Starts up to half a notice apart share a window, so windows are bounded."""
    starts = []
    for start, seed in n.seeds:
        at = line.find(seed)
        while at >= 0:
            starts.append(at - start)
            at = line.find(seed, at + 1)
    if not starts:
        return []
    out, reach = [], n.edits + 1
    starts.sort()
    first = last = starts[0]
    for p in [*starts[1:], len(line) + len(n.text)]:
        if p - first > len(n.text) // 2:
            out.append((max(0, first - reach), min(len(line), last + len(n.text) + reach)))
            first = p
        last = p
    return out


def fuzzy(line: bytes, of: list[Notice]) -> list[tuple[str, int, int, int, int]]:
    """(label, first word, end word, edits, characters of the notice) of verified notices; of several that overlap the closest."""
    out, blanks = set(), None
    for n in of:
        for a, b in windows(line, n):
            parts = [(a, b)]
            while parts:
                a, b = parts.pop()
                if b - a < len(n.text) - n.edits or not n.possible(line[a:b]) or not (m := n.pattern.search(line, a, b)):
                    continue
                # The closest may stand anywhere: what lies before and after it is searched too.
                parts += [(m.end(), b), (a, m.start())]
                if not n.told(m.group()):
                    continue
                if blanks is None:
                    blanks = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
                start = m.start() + (line[m.start() : m.start() + 1] == b" ")
                out.add((n.label, int(np.searchsorted(blanks, start)) - 1, int(np.searchsorted(blanks, m.end())), sum(m.fuzzy_counts), len(n.text)))
    # Of notices that overlap, the one with the smaller share of edits stands.
    starts: list[int] = []
    kept: list[tuple[str, int, int, int, int]] = []
    for m in sorted(out, key=lambda m: (m[3] / m[4], -m[4], m[1], m[0])):
        at = bisect.bisect_left(starts, m[1])
        if (at == 0 or kept[at - 1][2] <= m[1]) and (at == len(kept) or kept[at][1] >= m[2]):
            starts.insert(at, m[1])
            kept.insert(at, m)
    return kept


def scan_text(text: bytes, notices: tuple = NOTICES) -> dict:
    n, line = fold(text)
    base = {label: places(line, b" " + phrase.encode() + b" ") for phrase, label in PHRASES.items()}
    every = sorted(p for some in base.values() for p in some)
    matches = fuzzy(line, compiled(notices))
    labels = {k for k, v in base.items() if v}
    return {
        "n_words": n, "n_base": len(every), "first_word": every[0] if every else None, "last_word": every[-1] if every else None, "base_labels": ",".join(sorted(labels)), "labels": ",".join(sorted(labels | {m[0] for m in matches})),
        "score": 1.0 if every else max((1 - m[3] / m[4] for m in matches), default=0.0), "spans": ",".join(f"{m[0]}:{m[1]}:{m[2]}:{m[3]}" for m in matches),
    }


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", notices: tuple = NOTICES) -> DataFrame:
    """One row for each row of docs: counts and labels of exact phrases, labels and spans (label:first word:end word:edits) of notices with edits.

    notices: (label, words, telling words) of each, lower case and parted by blanks.  Of matches that overlap the one
    with the smallest share of edits stands, ties to the longer notice, then to the first.  Null and empty texts have no words and no labels, first_word and last_word null; a null doc_id stays null.
    """

    def work(ids: list, texts: list) -> dict:
        rows = [scan_text(t, notices) for t in texts]
        return {"doc_id": ids} | {k: [r[k] for r in rows] for k in rows[0]}

    return map_texts(docs, work, "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double, spans string", id_col, text_col)
