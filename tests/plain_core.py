"""Plain versions of queries that SQL can't express, on one row at a time."""

from __future__ import annotations

import html
import math
import re

from veilscan.functions import vocab as V


def normalized(text: str) -> str:
    for glyph, letters in V.LIGATURES.items():
        text = text.replace(glyph, letters)
    text = re.sub("(?<=[A-Za-zА-Яа-яЁё])\0(?=[A-Za-zА-Яа-яЁё])", "", text).replace("\0", " ")
    text = re.sub(r"\n{3,}", "\n\n", re.sub(r"[ \t\r\f\v]+", " ", text))
    return repaired(text).strip()


def repaired(text: str) -> str:
    """Words that lost a ligature, where the first 20,000 characters have two: capitals, a capital, or neither are kept."""
    lost = re.compile(r"\b(" + "|".join(sorted(V.LOST_LIGATURES, key=len, reverse=True)) + r")\b", re.I)
    if len(lost.findall(text[:20_000])) < 2:
        return text

    def whole(m: re.Match) -> str:
        good = V.LOST_LIGATURES[m[0].lower()]
        return good.upper() if m[0].isupper() else good.capitalize() if m[0][0].isupper() else good

    return lost.sub(whole, text)


def page_text(page: str) -> str:
    """Text between tags, without scripts, styles and comments, one line a piece."""
    page = re.sub(r"(?is)<(script|style|noscript)\b[^>]*>.*?</\1\s*>", "<>", page)
    page = re.sub(r"(?s)<!--.*?-->|<![^>]*>", "<>", page)
    pieces = [html.unescape(p) for p in re.split(r"<[^<>]*>", page)]
    return "\n".join(p for p in pieces if p)


def snippets(turns: list[tuple[int, str]]) -> str:
    """Of a conversation's turns (frame, text): the best each, at least 35 and 45 hundredths of the best of all, no text twice, five at most."""

    def worth(t: str) -> int:
        t = t.strip()
        if len(t) < 12:
            return 0
        words = [w for w in t.split() if sum(c.isalpha() for c in w) >= 3]
        return 12 * len(words) + sum(2 * c.isdigit() + c.isalnum() + (c == "\n") - 3 * (not c.isalnum() and not c.isspace()) for c in t)

    scored = [(worth(t), f, t) for f, t in turns]
    least, seen, kept = max(35, int(max((s for s, *_ in scored), default=0) * 0.45)), set(), []
    for s, f, t in sorted(scored, key=lambda x: (-x[0], x[1])):
        mark = "".join(c.lower() for c in t if c.isalnum())[:120]
        if s >= least and len(mark) >= 20 and mark not in seen and len(kept) < 5:
            seen.add(mark)
            kept.append((f, f"[frame_{f:04d}; rus+eng; full/enhanced_gray --psm 6; score={s}]\n{t}"))
    return "\n\n".join(t for _, t in sorted(kept))


def digits(value: str) -> str:
    return re.sub(r"\D", "", value)


def luhn(value: str) -> bool:
    d = [int(c) for c in digits(value)]
    return 13 <= len(d) <= 19 and sum(x if i % 2 == 0 else x * 2 - 9 * (x > 4) for i, x in enumerate(reversed(d))) % 10 == 0


def inn(d: str) -> bool:
    first, second = (7, 2, 4, 10, 3, 5, 9, 4, 6, 8), (3, 7, 2, 4, 10, 3, 5, 9, 4, 6, 8)
    rules = {10: [first[1:]], 12: [first, second]}.get(len(d), [])
    return bool(rules) and all(sum(w * int(c) for w, c in zip(ws, d, strict=False)) % 11 % 10 == int(d[len(ws)]) for ws in rules)


def pattern(name: str) -> re.Pattern:
    """A pattern of the vocabulary; Python's classes are Unicode anyway."""
    return re.compile(re.sub(r"^\(\?(i?s?)U\)", lambda m: f"(?{m[1]})" if m[1] else "", V.PATTERNS[name]))


def found(text: str) -> dict[str, int]:
    """Categories of a text without Cyrillic letters and without identity documents."""
    near = lambda m, n: text[max(0, m.start() - n) : m.end() + n].lower()
    technical = lambda m: re.search(V.TECHNICAL[4:], near(m, 40))
    out = {c: {m[0].strip() for m in pattern(c).finditer(text)} for c in ("email", "phone", "cvv", "mrz", "bik")}
    out["bank_card"] = {m[0].strip() for m in pattern("bank_card").finditer(text) if luhn(m[0]) and not technical(m) and re.search(V.CARD_WORD[4:], near(m, 100)) and not all(1900 <= int(g) <= 2099 for g in re.findall(r"\d{4}", m[0]))}
    numbers = {m[0] for m in pattern("inn").finditer(text) if inn(m[0])}
    out |= {"inn_legal": {n for n in numbers if len(n) == 10}, "inn_person": {n for n in numbers if len(n) == 12}}
    born = [re.compile(re.sub(r"^\(\?isU\)", "(?is)", p)) for p in V.BIRTH_IN_CONTEXT]
    out["birth_date"] = {m[1] for p in born for m in p.finditer(text)}
    return {c: len(v) for c, v in out.items() if v}


#: Points and flags that make a sum; see assessed().
IDENTITY = {*V.DIRECT, *V.DEMOGRAPHIC, *V.CONTACT, "bank_card"}


def assessed(path: str, ext: str, text: str, cats: dict[str, int], kind: str, passport_context: bool = False) -> tuple[int, str, bool, str]:
    """(score, level, reported, reasons) of a file without table analysis, recognition, public paths or weak health words."""
    names, has = set(cats), lambda *c: bool(set(cats) & set(c))
    content, low = f"{path} {text}".lower(), path.lower()
    persons = cats.get("full_name", 0)
    total = sum(cats.values())
    value = total - sum(n for c, n in cats.items() if c in V.WEAK)
    private = sum(n for c, n in cats.items() if c in V.DIRECT or c in ("bank_card", "cvv") or c in V.SPECIAL_FEATURES)
    identity = has("full_name") and ({"passport_rf", "snils"} <= names or (has(*V.DIRECT) and has("birth_date", "address", "phone", "email")) or len(names & IDENTITY) >= 4)
    government = has("passport_rf", "foreign_id_document", "snils", "driver_license", "mrz") and (has("full_name") or len(names & set(V.DIRECT)) >= 2)
    card_phone, payment = {"bank_card", "phone"} <= names, has("bank_card", "cvv") or {"bank_account", "bik"} <= names
    contact = has("full_name") and len(names & set(V.CONTACT)) >= 2
    parts: dict[str, list[tuple[int, str]]] = {k: [] for k in "smcl"}

    def say(part: str, n: int, what: str) -> None:
        parts[part].append((n, what))

    for c in sorted(cats):
        most = 5 if c in V.HIGH_IMPACT else 3 if c in (*V.CONTACT, "full_name", "birth_date") else 2
        extra = min(most, int(math.log2(cats[c])) + (c in V.HIGH_IMPACT)) if cats[c] > 1 else 0
        say("s", V.POINTS.get(c, 1) + extra, f"{c}: {cats[c]} found (+{V.POINTS.get(c, 1)}{f'+{extra} count' if extra else ''})")
    if identity:
        say("s", 6, "Full identity bundle: name plus strong identifiers/contact data (+6 sensitivity)")
    elif government:
        say("s", 5, "Government ID bundle detected (+5 sensitivity)")
    if card_phone:
        say("s", 5, "Bank card plus phone detected (+5 sensitivity)")
    elif payment and not (has(*V.LEGAL) and not has("bank_card", "cvv")):
        say("s", 3, "Payment data bundle detected (+3 sensitivity)")
    if contact:
        say("s", 3, "Name plus multiple contact categories detected (+3 sensitivity)")
    if passport_context:
        say("s", 2, "Passport context confirmed around passport-like number (+2 sensitivity)")
    density = round(value / (max(len(text), 1) / 1000), 3)
    for n, points in ((30, 5), (10, 3)):
        if value >= n:
            say("m", points, f"Many non-keyword PII findings (>={n}) (+{points} massiveness)")
            break
    if private >= 10:
        say("m", 4, "Many sensitive identifiers (>=10) (+4 massiveness)")
    elif private >= 3:
        say("m", 2, "Several sensitive identifiers (>=3) (+2 massiveness)")
    if density >= 2 and value >= 5:
        say("m", 3, "High value PII density (+3 massiveness)")
    elif density >= 0.8 and value >= 3:
        say("m", 1, "Elevated value PII density (+1 massiveness)")
    if ext in V.RISK_TABLES and value >= 5:
        say("m", 2, "Structured file contains repeated PII-like values (+2 massiveness)")
    if any(w in low for w in V.DUMP_PATHS) or any(w in content for w in V.DUMP_CONTENT):
        say("c", 5, "Dump/backup/export context (+5 context)")
    if kind == V.PASSPORT_SCAN:
        say("c", 5, f"Document type is {kind} (+5 context)")
    elif kind == V.ID_TABLE:
        say("c", 4, "Document type is identifier table (+4 context)")
    elif kind == V.DUMP:
        say("c", 5, "Document type is export/dump (+5 context)")
    elif kind == V.MEDICAL and has("health"):
        say("c", 3, "Medical context with health data (+3 context)")
    special = has(*V.SPECIAL_RISK) and names <= {*V.SPECIAL_RISK, *V.REQUISITES} and kind in (V.MEDICAL, V.UNKNOWN)
    if special:
        say("l", 8, "Special-category words without a concrete person anchor (-8 legitimate context)")
    if any(w in content for w in V.BUSINESS_WORDS) and not has("bank_card", "cvv", "mrz", "health", "biometric", "inn_person"):
        say("l", 4, "Formal business context without personal high-impact identifiers (-4 legitimate context)")
    if names and names <= set(V.REQUISITES):
        say("l", 4, "Only contact/legal-entity requisites found (-4 legitimate context)")
    if names <= set(V.BENIGN):
        say("l", 2, "No high-impact personal category found (-2 legitimate context)")
    storage = any(w in low for w in V.SUSPICIOUS_PATHS)
    sums = {k: sum(n for n, _ in v) for k, v in parts.items()}
    sums["c"] += 4 * storage
    sums["l"] = min(12, sums["l"])
    score = max(0, sums["s"] + sums["m"] + sums["c"] - sums["l"])
    level = "high" if score >= V.HIGH else "medium" if score >= V.MEDIUM else "low"
    reasons = [f"Risk components: pii_sensitivity={sums['s']}, massiveness={sums['m']}, context_suspicion={sums['c']}, legitimate_context=-{sums['l']}", *(w for k in "smcl" for _, w in parts[k])]
    reasons += ["Suspicious file or directory name (+4 context)"] * storage
    suspicious = sums["c"] >= 5
    if not names or special or (names <= {*V.REQUISITES, "full_name"} and not suspicious):
        reported = False
    elif level == "high":
        dump = ext in V.RISK_TABLES and storage and value >= 20 and len(names & {*V.DIRECT, *V.CONTACT}) >= 2
        reported = identity or government or card_phone or payment or dump or (has(*V.DIRECT, "bank_card", "cvv") and suspicious)
    else:
        reported = level == "medium" and (identity or government or card_phone or payment or (contact and (has(*V.DIRECT, "bank_card", "cvv") or suspicious)))
    assert persons == 0 or persons == cats["full_name"]
    return score, level, reported, "; ".join(reasons)
