"""Language identification by hierarchical discrimination.

A text is a profile of hashed byte 2- and 3-grams over letters.  Linear support vector machines, one for each pair of
language families, predict the family first; machines for each pair of languages of that family then separate those.
The machines are fitted on the driver on a bounded sample of labelled rows; prediction is a pass over whole texts.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_texts, split_rule

UNKNOWN = "und"
#: Length of a profile (a power of two).
BITS = 12
DIM = 1 << BITS
#: The bound of the training sample: rows together and of one language (each also gives a short snippet).
MOST_ROWS = 2400
MOST_OF_A_LANGUAGE = 600
LEAST_OF_A_LANGUAGE = 20
SNIPPET_WORDS = 6
#: Families of languages (fixed values); any other language is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb yi",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be pl cs sk bg sr hr sl mk bs",
    "baltic": "lt lv",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz tk ky",
    "indic": "hi bn ur pa mr ne gu",
    "semitic": "ar he mt am",
    "sinitic": "zh yue",
}
FAMILY_OF = {lang: family for family, langs in FAMILIES.items() for lang in langs.split()}
#: Bytes to letters: A-Z lower-cased, other ASCII to blanks, the rest (parts of letters beyond ASCII) kept.
FOLD = np.array([b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256)], np.uint8)
#: Bytes of a text whose n-grams are counted at a time.
CHUNK = 1 << 20


def has_letters(text: bytes) -> bool:
    return any(map(str.isalpha, text.decode("utf-8", "ignore")))


def grams(text: bytes) -> np.ndarray:
    """Hashes of the 2- and 3-grams with a letter in them, blanks at both ends included, of one chunk."""
    b = FOLD[np.frombuffer(b" " + text + b" ", np.uint8)].astype(np.uint32)
    two = b[:-1] | b[1:] << np.uint32(8)
    three = two[:-1] | b[2:] << np.uint32(16)
    two, three = two[two != 0x2020], three[(three & 0xFFFF00) != 0x202000]
    codes = np.concatenate([two | np.uint32(1 << 24), three | np.uint32(2 << 24)])
    return (codes * np.uint32(2654435761)) >> np.uint32(32 - BITS)


def profile(text: bytes) -> np.ndarray:
    """Counts of hashed n-grams over the whole text."""
    counts = np.zeros(DIM, np.int64)
    for at in range(0, max(1, len(text)), CHUNK):
        counts += np.bincount(grams(text[at : at + CHUNK]), minlength=DIM)
    return counts


@dataclass
class Model:
    """pairs: (a, b) groups told apart by each column of weights; a where positive."""

    languages: list[str]
    members: dict[str, list[str]]
    pairs: list[tuple[str, str]]
    weights: np.ndarray
    bias: np.ndarray

    def predict(self, text: bytes) -> tuple[str, float]:
        """The language and how sure the least sure of the deciding machines is, 0 to 1."""
        if not self.languages or not has_letters(text):
            return UNKNOWN, 0.0
        counts = profile(text)
        total = counts.sum()
        if not total:
            return UNKNOWN, 0.0
        sure = dict(zip(self.pairs, counts / total @ self.weights + self.bias, strict=True))
        family, p = _tournament(sorted(self.members), sure)
        lang, q = _tournament(self.members[family], sure)
        return lang, float(min(p, q))


def _tournament(names: list[str], margins: dict[tuple[str, str], float]) -> tuple[str, float]:
    """One against one: the name with the most wins, ties to the larger sum of margins."""
    if len(names) == 1:
        return names[0], 1.0
    wins, sums = dict.fromkeys(names, 0), dict.fromkeys(names, 0.0)
    for a, b in itertools.combinations(names, 2):
        m = margins[a, b]
        wins[a if m > 0 else b] += 1
        sums[a] += m
        sums[b] -= m
    best = max(names, key=lambda x: (wins[x], sums[x]))
    least = min(margins[a, b] if a == best else -margins[a, b] for a, b in itertools.combinations(names, 2) if best in (a, b))
    return best, float(1 / (1 + np.exp(-np.clip(3 * least, -30, 30))))


def _machine(x: np.ndarray, y: np.ndarray, steps: int = 250, cost: float = 20.0) -> tuple[np.ndarray, float]:
    """Linear support vector machine, squared hinge loss, by accelerated gradient descent; classes count alike."""
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    w, b = np.zeros(x.shape[1], np.float32), 0.0
    v, vb = w.copy(), b
    rate = 1.0 / (1.0 + 2 * cost * float(share @ np.einsum("ij,ij->i", x, x) + 1))
    for k in range(steps):
        slack = np.maximum(0, 1 - y * (x @ v + vb))
        pull = -2 * cost * share * slack * y
        new, newb = v - rate * (v * 1e-2 + pull @ x), vb - rate * float(pull.sum())
        m = k / (k + 3)
        v, vb = new + m * (new - w), newb + m * (newb - b)
        w, b = new, newb
    return w, b


def fit(labelled: DataFrame, most_rows: int = MOST_ROWS, most_of_a_language: int = MOST_OF_A_LANGUAGE, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Fit on rows with a language and a text with letters: of each language the first by a hash of the id.

    Languages have alike many rows, at most most_of_a_language and together most_rows, but LEAST_OF_A_LANGUAGE where
    there are so many languages that this is more; every language takes part.
    """
    known = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    sizes = {r[0]: r[1] for r in known.groupBy(lang_col).count().collect()}
    if not sizes:
        return Model([], {}, [], np.zeros((DIM, 0)), np.zeros(0))
    each = max(LEAST_OF_A_LANGUAGE, min(most_of_a_language, most_rows // len(sizes)))
    # A share by hash first, of about twice the wanted rows, so that what is ranked is bounded.
    share = F.create_map(*(F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, 2 * each / n))))
    draw = F.xxhash64(F.lit("langid"), id_col)
    some = known.where(F.pmod(draw, F.lit(1_000_000)) / 1e6 < share[F.col(lang_col)]).select(F.col(lang_col).alias("lang_"), F.col(text_col).cast("binary").alias("text_"), draw.alias("draw_"))
    place = F.row_number().over(Window.partitionBy("lang_").orderBy("draw_", F.crc32("text_")))
    some = some.withColumn("place_", place).where(F.col("place_") <= each)

    def work(langs: list, texts: list) -> dict:
        out: dict[str, list] = {"lang": [], "at": [], "n": []}
        for lang, text in zip(langs, texts, strict=True):
            for part in (text, b" ".join(text.split()[:SNIPPET_WORDS])):
                counts = profile(part)
                at = np.flatnonzero(counts)
                if len(at):
                    out["lang"].append(lang)
                    out["at"].append(at.astype(np.int32))
                    out["n"].append((counts[at] / counts.sum()).astype(np.float32))
        return out

    rows = map_texts(some, work, "lang string, at array<int>, n array<float>", "lang_", texts=F.col("text_")).toArrow()
    langs = rows.column(0).to_pylist()
    x = np.zeros((len(langs), DIM), np.float32)
    i = 0
    for at, n in zip(rows.column(1).chunks, rows.column(2).chunks, strict=True):
        sizes = at.value_lengths().to_numpy(zero_copy_only=False)
        x[np.repeat(np.arange(i, i + len(sizes)), sizes), at.flatten().to_numpy()] = n.flatten().to_numpy()
        i += len(sizes)
    del rows
    return fit_profiles(langs, x)


def fit_profiles(langs: list[str], x: np.ndarray) -> Model:
    """The machines from languages and profiles of shares."""
    scale = (1 / np.sqrt(x.mean(axis=0) + 1e-5) if len(x) else np.ones(DIM)).astype(np.float32)
    x *= scale
    languages = sorted(set(langs))
    family = {lang: FAMILY_OF.get(lang.lower().split("-")[0], f"={lang}") for lang in languages}
    members: dict[str, list[str]] = {}
    for lang in languages:
        members.setdefault(family[lang], []).append(lang)
    y = np.array(langs)
    of = np.array([family[k] for k in langs])
    pairs, columns, bias = [], [], []
    for labels, names in [(of, sorted(members)), *((y, m) for m in members.values())]:
        for a, b in itertools.combinations(names, 2):
            use = (labels == a) | (labels == b)
            w, c = _machine(x if use.all() else x[use], np.where(labels[use] == a, 1, -1).astype(np.float32))
            pairs.append((a, b))
            columns.append(w * scale)
            bias.append(c)
    weights = np.stack(columns, axis=1).astype(np.float64) if columns else np.zeros((DIM, 0))
    return Model(languages, members, pairs, weights, np.array(bias))


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score for every row of docs: `und` and 0 for null texts and texts without letters."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # its size depends on the number of languages only

    def work(ids: list, texts: list) -> dict:
        found = [sent.value.predict(t) for t in texts]
        return {"doc_id": ids, "lang_pred": [f[0] for f in found], "score": [f[1] for f in found]}

    return map_texts(docs, work, "doc_id bigint, lang_pred string, score double", id_col, text_col)


def training_rows(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return docs.where(split_rule(id_col, 3) != 1)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score: fitted on the rows of docs that are not held out, predicted for all.

    Without a single labelled row every text is `und`.  Equal texts get equal predictions; a null id is not held out.
    """
    model = fit(training_rows(docs, id_col), id_col=id_col, text_col=text_col, lang_col=lang_col)
    return predict(docs, model, id_col, text_col).withColumn("held_out", split_rule("doc_id", 3) == 1)
