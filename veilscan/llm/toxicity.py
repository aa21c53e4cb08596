"""Toxicity by maximum-scoring segments.

Tokens (words and word beginnings) get log-odds of toxic against other labelled texts with a Dirichlet prior from both.
Counted are
texts with a token and then, for what stands out, its distinct neighbours to the left, so copies of a text count once.
A word scores its most specific significant token, or a fixed cost; a linear scan finds all maximal-scoring segments of
the whole text.  The highest score of a random text follows an extreme-value law; its parameters turn segment scores
into E-values, what passes is summed, and a logistic curve makes that a score.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, map_texts, materialize, split_rule, text_bytes

#: The bound of the training sample: labelled rows of each label.
MOST_OF_A_LABEL = 6000
#: Lengths in bytes of the word beginnings that are tokens too.
STEMS = (6, 5, 4)
#: Strength of the prior in texts, least numbers of texts with a token and of its neighbours, least z value of one that scores.
PRIOR = 20.0
LEAST_TEXTS, LEAST_NEIGHBOURS = 3, 5
LEAST_Z = 2.3
#: Score of a word without significant token, and the highest of one with.
COST = -1.0
HIGHEST = 6.0
#: E-value up to which a segment counts.
E_VALUE = 0.05
THRESHOLD = 0.3
#: Words whose scores a worker keeps.
KEPT = 400_000
#: To blanks: ASCII but letters, digits and apostrophes; A-Z to lower case.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 or 48 <= b <= 57 or b == 39 else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


def tokens_of(word: bytes) -> list[bytes]:
    """The word, marked as whole, and its beginnings, the most specific first."""
    return [b"=" + word, *(word[:n] for n in STEMS if len(word) > n)]


def segments(scores: np.ndarray) -> list[tuple[float, int, int]]:
    """All maximal-scoring segments (score, start, end) in linear time (Ruzzo and Tompa).

    Of each candidate the last one before it whose left sum is smaller is kept, so a search leaps from candidate to
    candidate and none that was leapt over is looked at again.
    """
    if not len(scores):
        return []
    starts = np.flatnonzero(np.r_[True, (scores[1:] > 0) != (scores[:-1] > 0)])
    sums = np.add.reduceat(scores, starts)
    ends = np.r_[starts[1:], len(scores)]
    found: list[tuple[float, float, int, int, int]] = []  # sum before, sum up to the end, start, end, last with a smaller sum before
    total = 0.0
    for s, a, b in zip(sums.tolist(), starts.tolist(), ends.tolist(), strict=True):
        if s <= 0:
            total += s
            continue
        left, right, start = total, total + s, a
        total = right
        j = len(found) - 1
        while j >= 0:
            if found[j][0] >= left:
                j = found[j][4]
            elif found[j][1] >= right:
                break
            else:  # joined with all from j on
                left, start, back = found[j][0], found[j][2], found[j][4]
                del found[j:]
                j = back
        found.append((left, right, start, b, j))
    return [(r - le, a, b) for le, r, a, b, _ in found]


@dataclass
class Model:
    scores: dict[bytes, float] = field(default_factory=dict)
    decay: float = 1.0  # lambda of the extreme-value law
    size: float = 1.0  # its K
    slope: float = 1.0
    offset: float = -4.0
    cache: dict[bytes, float] = field(default_factory=dict, repr=False)

    def word_score(self, word: bytes) -> float:
        for token in tokens_of(word):
            if token in self.scores:
                return self.scores[token]
        return COST

    def passages(self, text: bytes) -> tuple[int, list[tuple[float, float, int, int]]]:
        """Number of words; (log E-value, score, first word, end) of each segment that counts."""
        words = words_of(text)
        if len(self.cache) > KEPT:
            self.cache.clear()
        new = set(words).difference(self.cache)
        self.cache.update(zip(new, map(self.word_score, new), strict=True))
        scores = np.fromiter(map(self.cache.__getitem__, words), np.float64, len(words))
        if not len(scores) or scores.max() <= 0:
            return len(words), []
        # A word said over and over counts once.
        scores[[a == b for a, b in zip([b"", *words], words, strict=False)]] = COST
        out = [(math.log(self.size * len(words)) - self.decay * s, s, a, b) for s, a, b in segments(scores)]
        return len(words), [x for x in out if x[0] <= math.log(E_VALUE)]

    def evidence(self, text: bytes) -> tuple[float, int]:
        """Evidence of all segments that count, and their number."""
        _, found = self.passages(text)
        return sum(-e for e, *_ in found), len(found)

    def score(self, text: bytes) -> tuple[float, int]:
        e, n = self.evidence(text)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.slope * math.log1p(e) + self.offset)))), n

    def __getstate__(self) -> dict:
        return self.__dict__ | {"cache": {}}


def log_odds(y1: np.ndarray, y0: np.ndarray, n1: float, n0: float) -> tuple[np.ndarray, np.ndarray]:
    """Log-odds ratio of tokens in n1 against n0 texts with a Dirichlet prior from both, and its z value."""
    prior = np.maximum(0.5, PRIOR * (y1 + y0) / max(1.0, n1 + n0))
    a, b = y1 + prior, y0 + prior
    delta = np.log(a / (n1 + PRIOR - a).clip(n1 / 10 + 0.5)) - np.log(b / (n0 + PRIOR - b).clip(n0 / 10 + 0.5))
    return delta, delta / np.sqrt(1 / a + 1 / b)


def extreme_values(counts: dict[float, int]) -> tuple[float, float]:
    """lambda > 0 with the mean of exp(lambda * score) at 1, and K by the law's usual estimate; counts: words by score in clean texts."""
    s, n = np.array(list(counts), float), np.array(list(counts.values()), float)
    if not len(s) or s.max() <= 0:
        s, n = np.append(s, 1.0), np.append(n, 0.5)  # never seen: half a word
    p = n / n.sum()
    if (p * s).sum() >= 0:
        return 0.1, 1.0
    lo, hi = 1e-6, 50.0
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if (p * np.exp(np.minimum(mid * s, 600))).sum() < 1 else (lo, mid)
    lam = (lo + hi) / 2
    k = min(1.0, max(1e-3, lam * abs((p * s).sum()) / max(1e-9, (p * s * np.exp(lam * s)).sum())))
    return lam, k


def training_labels(labels: DataFrame, most: int = MOST_OF_A_LABEL, id_col: str = "doc_id", label_col: str = "toxic") -> DataFrame:
    """doc_id, toxic, weight of at most `most` ids of each label that are not held out: the first by a hash of the id.

    weight says how many labelled ids one stands for.  Null and doubtful labels are left out.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1) & (split_rule(id_col, 4) != 2)).groupBy(F.col(id_col).alias("doc_id")).agg(F.max(label_col).alias("toxic"), F.min(label_col).alias("least")).where("toxic = least").drop("least")
    sizes = {r[0]: r[1] for r in known.groupBy("toxic").count().collect()}
    first = [known.where(F.col("toxic") == y).orderBy(F.xxhash64(F.lit("toxicity"), "doc_id"), "doc_id").limit(most).withColumn("weight", F.lit(max(1.0, sizes.get(y, 0) / most))) for y in (0, 1)]
    return first[0].unionByName(first[1])


def fit(docs: DataFrame, labels: DataFrame, most: int = MOST_OF_A_LABEL, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Fit on the labelled texts of docs, which are written once; the sample of labels is bounded by `most` and so can be broadcast."""
    chosen = training_labels(labels, most, id_col, label_col).withColumnRenamed("doc_id", "labelled")
    whole = docs.select(F.col(id_col).alias("own_id"), text_bytes(text_col).alias("text")).join(F.broadcast(chosen), F.col("own_id") == F.col("labelled")).select("toxic", "text", "weight")
    rows = materialize(whole, "labelled-texts")

    def counted(batches):
        for batch in batches:
            seen: dict[bytes, list[int]] = {}
            n = [0, 0]
            for y, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                n[y] += 1
                for token in {k for w in set(words_of(t)) for k in tokens_of(w)}:
                    seen.setdefault(token, [0, 0])[y] += 1
            seen[b""] = n
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array([v[1] for v in seen.values()], pa.int64()), pa.array([v[0] for v in seen.values()], pa.int64())], names=["token", "y1", "y0"])

    counts = rows.mapInArrow(counted, "token binary, y1 bigint, y0 bigint").groupBy("token").agg(F.sum("y1").alias("y1"), F.sum("y0").alias("y0"))
    # All tokens in enough toxic texts: which of them stand out depends on the numbers of texts of both labels.
    totals = F.col("token") == F.lit(b"").cast("binary")
    kept = counts.where(totals | (F.col("y1") >= LEAST_TEXTS)).toArrow()
    tokens, y1, y0 = kept.column(0).to_pylist(), kept.column(1).to_numpy().astype(float), kept.column(2).to_numpy().astype(float)
    if b"" not in tokens or not y1[(at := tokens.index(b""))] or not y0[at]:
        dropped(rows)
        return Model()  # one label only: nothing to tell apart
    delta, z = log_odds(y1, y0, y1[at], y0[at])
    first = {t for t, d, v in zip(tokens, delta, z, strict=True) if t and v >= LEAST_Z and d > 0.5}
    told = docs.sparkSession.sparkContext.broadcast(first)

    def neighbours(batches):
        for batch in batches:
            seen: set[tuple[bytes, int, int]] = set()
            for y, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = words_of(t)
                for left, w in zip([b"", *words], words, strict=False):
                    seen.update((k, y, zlib.crc32(left)) for k in tokens_of(w) if k in told.value)
            rows = list(seen)
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.int64())], names=["token", "toxic", "left"])

    pairs = rows.mapInArrow(neighbours, "token binary, toxic int, left bigint").distinct().groupBy("token").agg(F.sum("toxic").alias("y1"), F.sum(1 - F.col("toxic")).alias("y0")).toArrow()
    tokens, c1, c0 = pairs.column(0).to_pylist(), pairs.column(1).to_numpy().astype(float), pairs.column(2).to_numpy().astype(float)
    delta, z = log_odds(c1, c0, y1[at], y0[at])
    model = Model({t: min(HIGHEST, float(d)) for t, d, v, n in zip(tokens, delta, z, c1, strict=True) if v >= LEAST_Z and d > 0.5 and n >= LEAST_NEIGHBOURS})

    # The law, and the curve, from the same sample.
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def words_by_score(batches):
        m = sent.value
        for batch in batches:
            by: dict[float, int] = {}
            for y, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if y == 0:
                    for w in words_of(t):
                        s = round(m.cache.setdefault(w, m.word_score(w)), 1)
                        by[s] = by.get(s, 0) + 1
                    if len(m.cache) > KEPT:
                        m.cache.clear()
            yield pa.RecordBatch.from_arrays([pa.array(list(by), pa.float64()), pa.array(list(by.values()), pa.int64())], names=["score", "n"])

    by = {r[0]: r[1] for r in rows.mapInArrow(words_by_score, "score double, n bigint").groupBy("score").agg(F.sum("n")).collect()}
    model.decay, model.size = extreme_values(by)
    again = docs.sparkSession.sparkContext.broadcast(model)

    def evidence(batches):
        for batch in batches:
            e = [again.value.evidence(t)[0] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int32()), pa.array(e, pa.float64()), batch.column(2)], names=["toxic", "evidence", "weight"])

    seen = rows.mapInArrow(evidence, "toxic int, evidence double, weight double").toArrow()
    model.slope, model.offset = _curve(np.log1p(seen.column(1).to_numpy()), seen.column(0).to_numpy().astype(float), seen.column(2).to_numpy())
    model.cache = {}
    dropped(rows)
    return model


def _curve(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[float, float]:
    """Logistic regression of y on x with weights w by Newton's method, slightly damped: a probability at the labels' own rate."""
    w = w * len(w) / max(w.sum(), 1e-9)
    a = np.stack([x, np.ones_like(x)], axis=1)
    beta = np.array([1.0, -2.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ beta, -30, 30)))
        grad = a.T @ (w * (y - p)) - 0.5 * beta
        hess = (a * (w * p * (1 - p))[:, None]).T @ a + 0.5 * np.eye(2)
        beta = beta + np.clip(np.linalg.solve(hess, grad), -2, 2)
    return float(max(beta[0], 1e-3)), float(beta[1])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score (0 to 1), passages (segments that count) for every row of docs; null and empty texts have none and the least score."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # bounded with the training sample

    def work(ids: list, texts: list) -> dict:
        found = [sent.value.score(t) for t in texts]
        return {"doc_id": ids, "score": [f[0] for f in found], "passages": [f[1] for f in found]}

    return map_texts(docs, work, "doc_id bigint, score double, passages bigint", id_col, text_col)


def rate(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted, passages; held-out rows (crc32 of the id modulo 4 is 2) teach nothing."""
    model = fit(docs, labels, id_col=id_col, text_col=text_col)
    return score(docs, model, id_col, text_col).select("doc_id", (split_rule("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "passages")
