"""Quality by weak supervision: rules vote or abstain, their accuracies are estimated without labels, votes are fused.

Each rule looks at counts of one document and votes good, bad or nothing. Documents with the same votes are alike for the
model, and there are at most 3 ** rules vote patterns whatever the number of documents; so the corpus is reduced to
pattern counts by one aggregation over all documents, and expectation-maximisation runs on those exactly. It assumes that
rules err independently given the class, and alternates between the posterior of each pattern and, for each rule, the
chance of each vote in each class. A base filter goes first; what passes is kept if its posterior is at least one half.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quartier.llm.arrow import map_rows
from quartier.llm.words import WordHashes, shingles, split
from quartier.session import cut_lineage

SYMBOLS = "#*$%&|<>"
COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
_MORE = "n_lines long, n_letters long, n_upper long, n_stops long, n_distinct long"


def _repeat_words(runs: np.ndarray, n_words: int) -> int:
    """Words inside runs of five words that occur twice or more."""
    if n_words < 6:
        return 0
    _, inverse, counts = np.unique(runs, return_inverse=True, return_counts=True)
    again = counts[inverse] > 1
    if not again.any():
        return 0
    edges = np.zeros(n_words + 1, dtype=np.int64)
    edges[: len(again)] += again
    edges[5 : 5 + len(again)] -= again
    return int((np.cumsum(edges[:-1]) > 0).sum())


def measure(text: str, hashes: WordHashes) -> tuple[int, ...]:
    words = split(text)
    n, own = len(words), hashes.of(words)
    blank = sum(text.count(c) for c in " \t\n\v\f\r")
    lines = [line for line in text.split("\n") if line.strip(" \t\v\f\r")]
    joined = b"".join(words)
    upper = sum(map(joined.count, (bytes([c]) for c in range(65, 91))))
    raw = np.frombuffer(joined, np.uint8)
    letters = int(((raw >= 128) | ((raw | 32) - 97 < 26)).sum()) if n else 0
    return (
        n, len(text) - blank, sum(text.count(c) for c in SYMBOLS), len(lines) - len(set(lines)),
        _repeat_words(shingles(own), n), len(lines), letters, upper,
        sum(w[-1] in b".!?:;" for w in words), len(np.unique(own)),
    )


def text_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The counts that the rules look at, for every row of ``docs``; all are 0 without a text."""

    def work():
        hashes = WordHashes()

        def step(ids: list, texts: list) -> Iterator[tuple]:
            for key, text in zip(ids, texts):
                yield key, *measure(text or "", hashes)

        return step

    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return map_rows(rows, f"doc_id long, {COUNTS}, {_MORE}", work)


def _share(part: str, whole: str) -> Column:
    return F.col(part) / F.greatest(F.col(whole), F.lit(1))


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def rules() -> dict[str, Column]:
    """Votes by rule: 1 good, -1 bad, 0 none. Rules on shares leave short texts without a vote.

    A fault is no vote for a text's other sides: rules that look for one fault vote bad or nothing, so a text that is
    junk in one way does not gather good votes for not being junk in the other ways.
    """
    enough, never = F.col("n_words") >= 10, F.lit(False)
    symbols, repeats = _share("n_symbols", "n_words"), _share("n_repeat_words", "n_words")
    upper, letters = _share("n_upper", "n_letters"), _share("n_letters", "word_chars")
    length, stops = _share("word_chars", "n_words"), _share("n_stops", "n_words")
    copies, varied = _share("n_dup_lines", "n_lines"), _share("n_distinct", "n_words")
    plain = (symbols < 0.05) & (letters > 0.8) & (upper < 0.3)
    return {
        "prose": _vote(enough & plain & (stops < 0.5), never),
        "varied": _vote(enough & plain & (varied > 0.3), enough & (varied < 0.1)),
        "length": _vote(never, F.col("n_words") < 5),
        "symbols": _vote(never, enough & (symbols > 0.15)),
        "capitals": _vote(never, enough & (upper > 0.5)),
        "letters": _vote(never, enough & (letters < 0.75)),
        "word_length": _vote(never, enough & ((length < 2) | (length > 14))),
        "repeats": _vote(never, enough & (repeats > 0.15)),
        "lines": _vote(never, copies > 0.3),
    }


def fit(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 200) -> dict[tuple[int, ...], float]:
    """Posterior of a good document for each vote pattern, by expectation-maximisation over pattern counts.

    Starts from rules that are right nine times in ten when they vote. Counts get a prior of some votes of that kind,
    which keeps a rule that hardly votes near it, and keeps classes from changing places. No pattern gives no posterior.
    """
    if not patterns:
        return {}
    votes = np.array([p for p, _ in patterns])
    weight = np.array([n for _, n in patterns], dtype=float)
    of = [votes == v for v in (-1, 0, 1)]  # by vote: pattern x rule
    believed = {1: (0.05, 0.5, 0.45), 0: (0.45, 0.5, 0.05)}  # chances of the votes in good and in bad documents
    strength = 0.05 * weight.sum()
    chance = {c: np.tile(np.array(believed[c])[:, None], (1, votes.shape[1])) for c in (0, 1)}
    prior = 0.8
    good = np.zeros(len(votes))
    for _ in range(rounds):
        score = {c: sum(of[v] @ np.log(chance[c][v]) for v in range(3)) for c in (0, 1)}
        odds = score[1] - score[0] + math.log(prior / (1 - prior))
        new = 1 / (1 + np.exp(-np.clip(odds, -700, 700)))
        if np.abs(new - good).max() < 1e-9:
            break
        good = new
        prior = min(0.99, max(0.01, (weight @ good + 0.8 * strength) / (weight.sum() + strength)))
        for c, share in ((1, good), (0, 1 - good)):
            got = np.stack([(weight * share) @ m for m in of]) + strength * np.array(believed[c])[:, None]
            chance[c] = got / got.sum(axis=0)
    return {p: float(g) for (p, _), g in zip(patterns, good)}


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, counts, base_failed, kept, quality, one vote per rule) for every row of ``docs``.

    Runs when called: the counts are kept as a table, and only the pattern counts (19,683 at most) come to the driver. Null
    and empty texts fail the base filter. Repeated rows stay, each judged alike; further columns are not looked at.
    """
    n, repeats = F.col("n_words"), F.col("n_repeat_words")
    counted = cut_lineage(text_counts(docs, id_col, text_col))
    voted = counted.withColumns({f"vote_{name}": vote for name, vote in rules().items()})
    columns = [f"vote_{name}" for name in rules()]
    patterns = voted.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).collect()
    posterior = fit([(tuple(r[c] for c in columns), r["n"]) for r in sorted(patterns)])
    model = docs.sparkSession.createDataFrame(
        [(*p, q) for p, q in posterior.items()], ", ".join(f"{c} int" for c in columns) + ", quality double"
    )
    base_failed = (n < 10) | (100 * repeats > 20 * n)
    judged = voted.join(F.broadcast(model), columns, "left").withColumn("base_failed", base_failed)
    kept = ~F.col("base_failed") & (F.col("quality") >= 0.5)
    plain = [c.split()[0] for c in COUNTS.split(", ")]
    return judged.select("doc_id", *plain, "base_failed", kept.alias("kept"), "quality", *columns)
