"""Toxic passages as maximum-scoring segments of word log-odds, calibrated by extreme-value statistics.

Words weigh the log-odds of standing in a toxic rather than another document, with a Dirichlet prior in proportion to the
words' frequency over both; words that do not differ clearly weigh a small negative amount. In a text, the linear-time scan
of Ruzzo and Tompa finds every maximal segment of positive total weight: the passages. In texts that are not toxic the best
of many random segments follows an extreme-value law (Karlin and Altschul): a score S in n words is expected K n exp(-lambda
S) times. lambda solves sum p(s) exp(lambda s) = 1 over the weights of words in such texts; with K, half the passages found
in training texts that are not toxic are expected above their median. A passage's evidence is lambda S - log(K n), less than zero for one that chance makes more than once.
The evidence of a text is the sum over the passages above zero, or else that of the best one: chance adds 1 to it on
average, however long the text. One logistic curve, fitted to the training labels, turns it into a probability.

Only labelled rows are learnt from, at most ``TRAIN_ROWS`` of them (those of least hash). All rows are scored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quartier.llm.arrow import map_rows
from quartier.session import cut_lineage

#: Bound of the labelled rows that the model is fitted on, and of the words it keeps.
TRAIN_ROWS = 40_000
MODEL_WORDS = 20_000
#: Standard errors from zero at which a word's log-odds count; weight of all other words.
CLEAR = 3.5
OTHER = -0.5
#: A passage is reported if it is expected by chance less than this often in the text.
SIGNIFICANT = 0.05

_LETTERS = bytes(b if b >= 128 or 97 <= b < 123 else b + 32 if 65 <= b < 91 else 32 for b in range(256))


def words(text: str | None) -> list[bytes]:
    """Runs of letters, A-Z lowered; every character beyond ASCII counts as a letter."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_LETTERS).split()


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments as (first, end, score), in order.

    Each positive score opens a candidate, which is joined with the nearest earlier one that starts lower and ends lower,
    until there is none. A candidate remembers the nearest earlier one that starts lower, so that steps are not repeated.
    """
    total = np.concatenate(([0.0], np.cumsum(scores)))
    found: list[tuple[int, int, float, float, int]] = []  # first, end, total before, total at end, nearest lower start
    for at in np.flatnonzero(scores > 0).tolist():
        first, end, low, high = at, at + 1, float(total[at]), float(total[at + 1])
        near = len(found) - 1
        while True:
            while near >= 0 and found[near][2] >= low:
                near = found[near][4]
            if near < 0 or found[near][3] >= high:
                break
            first, low, before = found[near][0], found[near][2], found[near][4]
            del found[near:]
            near = before
        found.append((first, end, low, high, near))
    return [(first, end, high - low) for first, end, low, high, _ in found]


@dataclass(frozen=True)
class Model:
    weights: dict[bytes, float]
    rate: float  # lambda
    k: float
    slope: float
    level: float

    def evidence(self, n: int, passages: list[tuple[int, int, float]]) -> float:
        chance = math.log(self.k * max(n, 1))
        each = [self.rate * s - chance for _, _, s in passages] or [-chance]
        return sum(e for e in each if e > 0) or max(each)

    def expected(self, n: int, score: float) -> float:
        return self.k * max(n, 1) * math.exp(-min(self.rate * score, 700.0))

    def passages(self, own: list[bytes]) -> list[tuple[int, int, float]]:
        if self.weights.keys().isdisjoint(own):
            return []
        weight = self.weights.get
        return segments(np.array([weight(w, OTHER) for w in own]))

    def probability(self, evidence: float) -> float:
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, self.slope * evidence + self.level))))


def log_odds(counts: dict[bytes, tuple[int, int]], prior: float = 0.05) -> dict[bytes, float]:
    """Weights of the words whose log-odds between the classes (other, toxic) are clear, the clearest ``MODEL_WORDS``.

    Counts are of texts that hold the word, so one text that repeats a word is one case.
    """
    total = [sum(c[k] for c in counts.values()) for k in (0, 1)]
    mass = prior * sum(total)
    clear = []
    for word, (other, toxic) in counts.items():
        if not other + toxic:
            continue
        alpha = mass * (other + toxic) / sum(total)
        mine, theirs = toxic + alpha * total[1] / sum(total), other + alpha * total[0] / sum(total)
        odds = math.log(mine / (total[1] + mass - mine)) - math.log(theirs / (total[0] + mass - theirs))
        clearness = odds / math.sqrt(1 / mine + 1 / theirs)
        if abs(clearness) >= CLEAR:
            clear.append((-abs(clearness), word, odds))
    return {word: odds for _, word, odds in sorted(clear)[:MODEL_WORDS]}


def chance_rate(weights: dict[bytes, float], others: dict[bytes, int]) -> float:
    """lambda over the words of texts that are not toxic; 1 where no positive lambda exists."""
    n = sum(others.values())
    scores = Counter({w: c for w, c in others.items() if w in weights})
    s = np.array([*(weights[w] for w in scores), OTHER])
    p = np.array([*scores.values(), n - sum(scores.values())], dtype=float) / max(n, 1)
    if not (s > 0).any() or p @ s >= 0:
        return 1.0
    low, high = 0.0, 1.0
    while p @ np.exp(np.minimum(high * s, 700.0)) < 1 and high < 1e3:
        high *= 2
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if p @ np.exp(np.minimum(middle * s, 700.0)) < 1 else (low, middle)
    return high


def chance_scale(rate: float, sizes: Sequence[int], scores: Sequence[Sequence[float]]) -> float:
    """K from the passages of texts that are not toxic. Their median is not moved by a few wrong labels.

    Where such texts have no passage, one of score zero in a text of mean length is taken for it.
    """
    total = max(sum(sizes), 1)
    found = [s for own in scores for s in own]
    if not found:
        return max(len(sizes), 1) / total
    return len(found) / 2 / total * math.exp(min(rate * float(np.median(found)), 600.0))


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and level of the likeliest logistic curve, with a little shrinking of the slope."""
    if not len(x) or y.min() == y.max():
        return 0.0, -20.0 if not len(y) or y.max() == 0 else 20.0
    middle, scale = x.mean(), x.std() or 1.0
    design = np.stack([(x - middle) / scale, np.ones_like(x)])
    beta = np.array([1.0, math.log(y.mean() / (1 - y.mean()))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(beta @ design, -30, 30)))
        slope = design @ (y - p) - np.array([1e-3 * beta[0], 0])
        bend = (design * np.maximum(p * (1 - p), 1e-9)) @ design.T + np.diag([1e-3, 1e-9])
        step = np.linalg.solve(bend, slope)
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0] / scale), float(beta[1] - beta[0] * middle / scale)


def held_out(id_col: str = "doc_id") -> Column:
    """Rows never learnt from: those whose id, as text, has a CRC that five divides. A null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, rows: int, id_col: str, text_col: str) -> DataFrame:
    """(text, toxic) of at most ``rows`` labelled documents, those of least id hash.

    A document is toxic if any label says so. Copies of one text count once.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col("toxic").isNotNull() & ~held_out(id_col))
    known = known.groupBy(id_col).agg(F.max("toxic").alias("_toxic")).orderBy(F.xxhash64(id_col)).limit(rows)
    # Bounded by ``rows`` two-number rows.
    texts = docs.select(F.col(id_col), F.col(text_col).alias("_text"))
    return texts.join(F.broadcast(known), id_col).groupBy(F.col("_text").cast("string")).agg(F.max("_toxic").cast("int"))


def fit(
    docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, id_col: str = "doc_id", text_col: str = "text",
) -> Model:
    """A model from labels (doc_id, toxic). Without any usable label it has no words and finds nothing toxic."""
    train = cut_lineage(training_rows(docs, labels, rows, id_col, text_col))

    def count():
        def step(texts: list, toxic: list) -> Iterator[tuple]:
            counts: list[Counter] = [Counter(), Counter()]
            for text, label in zip(texts, toxic):
                counts[int(label == 1)].update(set(words(text)))
            for word in counts[0].keys() | counts[1].keys():
                yield word, counts[0][word], counts[1][word]

        return step

    by_word = map_rows(train, "word binary, other long, toxic long", count).groupBy("word")
    totals = by_word.agg(F.sum("other").alias("other"), F.sum("toxic").alias("toxic"))
    # A word that occurs once or twice cannot be clear; the rest of the bounded sample's words come to the driver.
    seen = totals.where("other + toxic > 2").collect()
    rare = totals.where("other + toxic <= 2").agg(F.sum("other"), F.sum("toxic")).first()
    counts = {bytes(r.word): (r.other, r.toxic) for r in seen} | {b" ": (rare[0] or 0, rare[1] or 0)}
    weights = log_odds(counts) if all(sum(c[k] for c in counts.values()) for k in (0, 1)) else {}
    weights.pop(b" ", None)
    model = Model(weights, chance_rate(weights, {w: c[0] for w, c in counts.items()}), 1.0, 0.0, -20.0)

    def measure():
        def step(texts: list, toxic: list) -> Iterator[tuple]:
            for text, label in zip(texts, toxic):
                own = words(text)
                found = model.passages(own)
                yield len(own), [s for *_, s in found], int(label == 1)

        return step

    # At most ``rows`` rows, of two numbers and the passages' scores.
    got = map_rows(train, "n long, scores array<double>, toxic int", measure).toPandas()
    model = replace(model, k=chance_scale(model.rate, got.n[got.toxic == 0].tolist(), got.scores[got.toxic == 0].tolist()))
    evidence = np.array([model.evidence(n, [(0, 0, s) for s in scores]) for n, scores in zip(got.n, got.scores)])
    slope, level = logistic(evidence, got.toxic.to_numpy(dtype=float))
    return replace(model, slope=slope, level=level)


def score(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: Sequence[str] = (),
) -> DataFrame:
    """(doc_id, score, passages) of every row of ``docs``; a passage is (first word, end word, score, expected).

    The columns of ``docs`` named in ``keep`` come along.

    ``score`` is the probability of the label. Passages are the significant ones. Null and empty texts have none and get
    the score of no evidence. Repeated rows stay, each scored alike; further columns are not looked at.
    """

    def work():
        def step(ids: list, texts: list) -> Iterator[tuple]:
            for key, text in zip(ids, texts):
                own = words(text)
                found = model.passages(own)
                told = [(a, b, s, model.expected(len(own), s)) for a, b, s in found]
                parts = [dict(zip(("first", "end", "score", "expected"), t)) for t in told if t[3] < SIGNIFICANT]
                yield key, model.probability(model.evidence(len(own), found)), parts

        return step

    schema = "doc_id long, score double, passages array<struct<first: long, end: long, score: double, expected: double>>"
    return map_rows(docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"), *keep), schema, work, keep)
