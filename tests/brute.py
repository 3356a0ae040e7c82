"""Plain-Python reference implementations used as brute-force oracles."""

from __future__ import annotations

import itertools
import math
import re
from collections import Counter

import numpy as np


def word_terms(text: str, lo: int = 1, hi: int = 2) -> list[str]:
    toks = re.findall(r"(?u)\b\w\w+\b", (text or "").lower())
    out = []
    for n in range(lo, min(hi + 1, len(toks) + 1)):
        for i in range(len(toks) - n + 1):
            out.append(" ".join(toks[i:i + n]))
    return out


def char_wb_terms(text: str, lo: int = 3, hi: int = 5) -> list[str]:
    """Each word with a space on both sides, cut into all windows of each length; lengths beyond the
    padded word count only as the shortest one, which then holds the whole of it."""
    padded = [f" {w} " for w in (text or "").lower().split()]
    return [p[i:i + n] for p in padded for n in range(lo, hi + 1) if n <= max(lo, len(p))
            for i in range(max(1, len(p) - n + 1))]


def tfidf(fit_docs: dict, apply_docs: dict, analyzer, min_df=2, max_features=None):
    """{doc: {term: weight}} with smooth idf (+1) and L2 rows."""
    counts = {d: Counter(analyzer(t)) for d, t in fit_docs.items()}
    df, cf = Counter(), Counter()
    for c in counts.values():
        for t, n in c.items():
            df[t] += 1
            cf[t] += n
    kept = [t for t in df if df[t] >= min_df]
    if max_features is not None:
        kept = sorted(kept, key=lambda t: (-cf[t], t))[:max_features]
    n = len(fit_docs)
    idf = {t: math.log((1 + n) / (1 + df[t])) + 1 for t in kept}
    out = {}
    for d, text in apply_docs.items():
        c = Counter(analyzer(text))
        w = {t: c[t] * idf[t] for t in c if t in idf}
        norm = math.sqrt(sum(v * v for v in w.values()))
        out[d] = {t: v / norm for t, v in w.items()} if norm > 0 else {}
    return out, sorted(kept)


def f1_metrics(y, p, focus=()):
    labels = sorted(set(y) | set(p))
    n = len(y)
    acc = sum(a == b for a, b in zip(y, p)) / n
    f1s, sup = {}, {}
    for c in labels:
        tp = sum(a == c and b == c for a, b in zip(y, p))
        fp = sum(a != c and b == c for a, b in zip(y, p))
        fn = sum(a == c and b != c for a, b in zip(y, p))
        f1s[c] = 2 * tp / (2 * tp + fp + fn) if (2 * tp + fp + fn) else 0.0
        sup[c] = sum(a == c for a in y)
    macro = sum(f1s.values()) / len(labels)
    weighted = sum(f1s[c] * sup[c] for c in labels) / n
    if focus:
        rec = []
        for c in focus:
            s = sum(a == c for a in y)
            tp = sum(a == c and b == c for a, b in zip(y, p))
            rec.append(tp / s if s else 0.0)
        fr = sum(rec) / len(rec)
    else:
        fr = weighted
    blend = 0.45 * acc + 0.35 * weighted + 0.20 * fr
    return dict(accuracy=acc, macro_f1=macro, weighted_f1=weighted, focus_recall=fr, blend=blend)


def argmax(v):
    m = max(v)
    return v.index(m)


def apply_scales(p, s):
    a = np.multiply(p, s)
    return (a / (a.sum() if a.sum() > 0 else 1.0)).tolist()


def score_of(y, proba, scales, focus):
    return round(f1_metrics(y, [argmax(apply_scales(r, scales)) for r in proba], focus)["blend"], 12)


def with_value(scales, c, g):
    return [*scales[:c], g, *scales[c + 1:]]


def best_value(y, proba, scales, focus, c, grid):
    """(score, value) of the best grid value of one class; the first of equals."""
    found = max((score_of(y, proba, with_value(scales, c, g), focus), -i) for i, g in enumerate(grid))
    return found[0], grid[-found[1]]


def rounds_of(y, proba, focus, grid):
    """(scales, score) after each round over the focus classes, endlessly."""
    now = [1.0] * len(proba[0])
    score = score_of(y, proba, now, focus)
    while True:
        for c in focus:
            top, g = best_value(y, proba, now, focus, c, grid)
            now, score = (with_value(now, c, g), top) if top > score else (now, score)
        yield now, score


def tune_scales(y, proba, focus, grid, rounds=4):
    """The state after ``rounds`` rounds, or after the first one that gains nothing (later ones gain nothing either)."""
    return list(itertools.islice(rounds_of(y, proba, focus, grid), rounds))[-1]
