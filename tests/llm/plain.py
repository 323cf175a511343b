"""Plain versions of estimators, one row or one document at a time, that tests hold the operators against."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np

from quartier.llm import language, toxicity


# --- language ----------------------------------------------------------------------------------------------------


def _share(model, text):
    """Posterior of the text alone over the languages, and whether it is as likely as texts of each usually are."""
    found = language.trigrams(text).tolist()
    n = len(found)
    if not n:
        return 0, [1 / len(model.languages)] * len(model.languages), [False] * len(model.languages)
    means = [sum(float(model.likelihood[c, k]) for c in found) / n for k in range(len(model.languages))]
    scaled = [m * n * language.INDEPENDENT / (n + language.INDEPENDENT) for m in means]
    weights = [math.exp(s - max(scaled)) for s in scaled]
    fits = [m >= u - language.UNUSUAL - 4 * s / math.sqrt(n) for m, u, s in zip(means, model.usual, model.spread)]
    return n, [w / sum(weights) for w in weights], fits


def fused(model, rows):
    """(lang or None, posterior, accepted) of each of ``rows`` (text, host, domain, suffix, declared or None)."""
    size, w = len(model.languages), language.WEIGHT
    read = []
    for text, host, domain, suffix, said in rows:
        said = "none" if said is None else said if said in model.languages else "other"
        read.append((*_share(model, text), host, domain, suffix, said))
    some = [r for r in read if r[0]]

    def counts(chosen):
        return [sum(r[1][k] for r in chosen) for k in range(size)], len(chosen)

    def mixed(own, n, parent):
        return [(max(c, 0.0) + w * p) / (n + w) for c, p in zip(own, parent)]

    whole, _ = counts(some)
    root = [(c + 1) / (sum(whole) + size) for c in whole]
    out = []
    for n, share, fits, host, domain, suffix, said in read:
        if not n:
            out.append((None, 0.0, False))
            continue
        prior = root
        if host is not None:
            if domain is not None:
                with_domain = [r for r in some if r[3] is not None and r[4] is not None]
                prior = mixed(*counts([r for r in with_domain if r[5] == suffix]), root)
                prior = mixed(*counts([r for r in with_domain if r[4] == domain]), prior)
            own, rows_there = counts([r for r in some if r[3] == host])
            prior = mixed([c - s for c, s in zip(own, share)], rows_there - 1, prior)
        told, _ = counts([r for r in some if r[6] == said])
        chance = [(t + 1) / (c + size + 2) for t, c in zip(told, whole)]
        logs = [math.log(s + 1e-300) + math.log(p) + math.log(c) for s, p, c in zip(share, prior, chance)]
        posterior = 1 / sum(math.exp(x - max(logs)) for x in logs)
        best = logs.index(max(logs))
        good = round(posterior, 6) >= language.SURE and fits[best]
        out.append((model.languages[best] if good else None, posterior, good))
    return out


# --- toxicity ----------------------------------------------------------------------------------------------------


def maximal(scores):
    """All maximal segments by their definition: the best one, then those left and right of it."""
    if not scores:
        return []
    total = [0.0]
    for s in scores:
        total.append(total[-1] + s)
    best, low, at = (0.0, 0, 0), 0, 0
    for end in range(1, len(total)):
        if total[end] - total[low] > best[0] + 1e-12:
            best, at = (total[end] - total[low], low, end), low
        if total[end] < total[low]:
            low = end
    score, first, end = best
    if score <= 0:
        return []
    return maximal(scores[:first]) + [score] + maximal(scores[end:])


def toxic_scores(docs, labels):
    """Probability of the label for each of ``docs`` (id, text) with ``labels`` (id, toxic): small tables only."""
    told = {}
    for i, toxic in labels:
        if i is not None and toxic is not None and zlib.crc32(str(i).encode()) % 5:
            told[i] = max(told.get(i, 0), toxic)
    train = {}
    for i, text in docs:
        if i in told:
            train[text] = max(train.get(text, 0), told[i])
    texts = {t: toxicity.words(t) for t in {text for _, text in docs} | set(train)}
    counts = {}
    for text, toxic in train.items():
        for word in set(texts[text]):
            counts.setdefault(word, [0, 0])[toxic] += 1
    total = [sum(c[k] for c in counts.values()) for k in (0, 1)]
    mass, weights = 0.05 * sum(total), {}
    for word, (other, toxic) in counts.items():
        if other + toxic <= 2:
            continue
        alpha = mass * (other + toxic) / sum(total)
        a, b = toxic + alpha * total[1] / sum(total), other + alpha * total[0] / sum(total)
        odds = math.log(a / (total[1] + mass - a)) - math.log(b / (total[0] + mass - b))
        if abs(odds / math.sqrt(1 / a + 1 / b)) >= toxicity.CLEAR:
            weights[word] = odds
    others = Counter()
    for word, (other, _) in counts.items():
        others[weights.get(word, toxicity.OTHER)] += other
    drift = sum(n * s for s, n in others.items()) / sum(others.values())
    low, high = 0.0, 1.0

    def mean(rate):
        return sum(n * math.exp(min(rate * s, 700.0)) for s, n in others.items()) / sum(others.values())

    if any(s > 0 for s in others) and drift < 0:
        while mean(high) < 1 and high < 1e3:  # no clean text may have a word of weight
            high *= 2
        for _ in range(80):
            middle = (low + high) / 2
            low, high = (middle, high) if mean(middle) < 1 else (low, middle)
    found = {t: maximal([weights.get(w, toxicity.OTHER) for w in own]) for t, own in texts.items()}
    clean = [t for t, toxic in train.items() if not toxic]
    scores = sorted(s for t in clean for s in found[t])
    words_there = sum(len(texts[t]) for t in clean)
    if scores:
        half = (scores[(len(scores) - 1) // 2] + scores[len(scores) // 2]) / 2
        k = len(scores) / 2 / words_there * math.exp(min(high * half, 600.0))
    else:
        k = len(clean) / words_there

    def evidence(text):
        chance = math.log(k * max(len(texts[text]), 1))
        each = [high * s - chance for s in found[text]] or [-chance]
        return sum(e for e in each if e > 0) or max(each)

    slope, level = toxicity.logistic(np.array([evidence(t) for t in train]), np.array([float(v) for v in train.values()]))
    return [1 / (1 + math.exp(-max(-700.0, min(700.0, slope * evidence(text) + level)))) for _, text in docs]


# --- quality -----------------------------------------------------------------------------------------------------


def good_shares(documents, rounds=200):
    """Posterior of a good document for each of ``documents`` (tuples of votes), by EM over the documents themselves."""
    believed = {1: {-1: 0.05, 0: 0.5, 1: 0.45}, 0: {-1: 0.45, 0: 0.5, 1: 0.05}}
    rules, strength, prior = range(len(documents[0])), 0.05 * len(documents), 0.8
    chance = {c: [dict(believed[c]) for _ in rules] for c in (0, 1)}
    good = [0.0] * len(documents)
    for _ in range(rounds):
        new = []
        for votes in documents:
            like = {c: math.prod(chance[c][r][votes[r]] for r in rules) for c in (0, 1)}
            new.append(prior * like[1] / (prior * like[1] + (1 - prior) * like[0]))
        moved, good = max(abs(a - b) for a, b in zip(new, good)), new
        if moved < 1e-9:
            break
        prior = min(0.99, max(0.01, (sum(good) + 0.8 * strength) / (len(documents) + strength)))
        for c in (0, 1):
            for r in rules:
                got = {v: strength * believed[c][v] for v in (-1, 0, 1)}
                for votes, g in zip(documents, good):
                    got[votes[r]] += g if c else 1 - g
                chance[c][r] = {v: x / sum(got.values()) for v, x in got.items()}
    return good
