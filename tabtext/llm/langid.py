"""Language identification by hierarchical discrimination.

A first linear classifier picks the language family; inside a family, one-versus-one linear support
vector machines separate the languages, and the language with most wins (ties: larger sum of margins,
then name) is predicted. Features: square roots of hashed byte 3-gram counts of the lower-cased text with
everything but letters turned into single spaces, scaled to length 1. All SVMs have squared hinge loss.

Families come from a fixed table; languages that it lacks form a family each. Training uses at most
``PER_LANGUAGE`` documents of each language (those with the smallest hash of id and text), so what reaches
the driver is bounded by languages times that number times ``DIM``; at most ``MAX_LANGUAGES`` languages.
Prediction reads whole texts and nothing else.

A text that is null or has no letter is ``und`` with score 0. A corpus without training rows predicts
``und`` throughout. Rows with null language or null id never train. Repeated rows are predicted each.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabtext.llm.common import append_columns, ship_by_value, small_batches

ship_by_value(__name__)

DIM = 4096
PER_LANGUAGE = 800
MAX_LANGUAGES = 256
SEED = 42
# fixed values: language codes by family
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is fo af lb fy yi",
    "romance": "fr es pt it ro ca gl oc la",
    "slavic": "ru uk be pl cs sk bg sr hr bs sl mk",
    "baltic": "lt lv", "celtic": "ga cy gd br", "uralic": "fi et hu", "turkic": "tr az kk uz ky tt",
    "indo-aryan": "hi bn ur mr ne gu pa si", "dravidian": "ta te kn ml", "iranian": "fa ku ps tg",
    "semitic": "ar he mt am", "sinitic": "zh yue", "japonic": "ja", "koreanic": "ko", "hellenic": "el",
    "austronesian": "id ms tl jv su", "tai": "th lo", "austroasiatic": "vi km",
}
LETTER = re.compile(r"[^\W\d_]")
FIELDS = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])


def family_of(lang: str) -> str:
    head = re.split(r"[-_]", lang.lower())[0]
    return next((f for f, codes in FAMILIES.items() if head in codes.split()), "=" + lang)


def _fold() -> np.ndarray:
    b = np.arange(256)
    letter = ((b >= 0x41) & (b <= 0x5A)) | ((b >= 0x61) & (b <= 0x7A)) | (b >= 0x80)
    return np.where(letter, np.where((b >= 0x41) & (b <= 0x5A), b + 32, b), 32).astype(np.uint8)


def features(text: str, dim: int = DIM) -> np.ndarray:
    """Feature vector of a whole text, made in pieces of bounded size."""
    counts = np.zeros(dim)
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    fold, step = _fold(), 1 << 20
    for at in range(0, max(1, len(raw)), step):
        b = fold[raw[max(0, at - 2):at + step]]
        keep = np.ones(len(b), bool)
        keep[1:] = (b[1:] != 32) | (b[:-1] != 32)
        b = np.concatenate(([32], b[keep], [32])).astype(np.uint32)
        code = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
        slot = (code * np.uint32(2654435761)) >> np.uint32(32 - int(dim).bit_length() + 1)
        counts += np.bincount(slot, minlength=dim)
    x = np.sqrt(counts)
    n = np.linalg.norm(x)
    return x / n if n else x


def fit_svm(x: np.ndarray, y: np.ndarray, c: float = 10.0, rounds: int = 150) -> np.ndarray:
    """Linear SVM (squared hinge, class-balanced) by accelerated gradient descent; the last weight is the bias."""
    x = np.hstack([x, np.ones((len(x), 1))]).astype(np.float32)
    y = y.astype(np.float32)
    n = len(x)
    cost = (np.where(y > 0, n / (2 * max(1, (y > 0).sum())), n / (2 * max(1, (y < 0).sum()))) * c / n).astype(np.float32)
    v = np.full(x.shape[1], x.shape[1] ** -0.5, np.float32)
    for _ in range(20):
        v = x.T @ (cost * (x @ v))
        v /= np.linalg.norm(v) or 1
    step = np.float32(1 / (1 + 2.2 * float(v @ (x.T @ (cost * (x @ v))))))
    w = z = np.zeros(x.shape[1], np.float32)
    for k in range(rounds):
        slack = np.maximum(0, 1 - y * (x @ z))
        new = z - step * (z - 2 * (x.T @ (cost * y * slack)))
        z = new + np.float32(k / (k + 3)) * (new - w)
        w = new
    return w


class Model:
    """Family SVMs (one family against the rest) and, per family, one SVM per pair of languages."""

    def __init__(self, x: np.ndarray, lang: list[str], dim: int = DIM):
        self.dim = dim
        langs = sorted(set(lang))
        y = np.array([langs.index(v) for v in lang], dtype=int)
        fam = [family_of(v) for v in langs]
        self.families = sorted(set(fam))
        self.members = [[k for k, f in enumerate(fam) if f == g] for g in self.families]
        self.langs = langs
        of = np.array([self.families.index(f) for f in fam], dtype=int)
        rows = []
        if len(self.families) > 1:
            for g in range(len(self.families)):
                rows.append(fit_svm(x, np.where(of[y] == g, 1.0, -1.0)))
        self.pairs = []
        for m in self.members:
            for i, a in enumerate(m):
                for b in m[i + 1:]:
                    at = (y == a) | (y == b)
                    self.pairs.append((a, b, len(rows)))
                    rows.append(fit_svm(x[at], np.where(y[at] == a, 1.0, -1.0)))
        self.weights = np.array(rows, np.float32).reshape(len(rows), dim + 1)

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.langs or not LETTER.search(text):
            return "und", 0.0
        margin = self.weights[:, :-1] @ features(text, self.dim).astype(np.float32) + self.weights[:, -1]
        score, g = 1.0, 0
        if len(self.families) > 1:
            m = margin[:len(self.families)]
            g = int(np.argmax(m))
            rest = np.partition(m, -2)[-2]
            score = _squash((m[g] - rest) / 2)
        wins, total, worst = {}, {}, {}
        for k in self.members[g]:
            wins[k], total[k], worst[k] = 0, 0.0, np.inf
        for a, b, r in self.pairs:
            if a in wins and b in wins:
                s = float(margin[r])
                wins[a if s >= 0 else b] += 1
                total[a], total[b] = total[a] + s, total[b] - s
                worst[a], worst[b] = min(worst[a], s), min(worst[b], -s)
        best = max(self.members[g], key=lambda k: (wins[k], total[k], -k))
        if np.isfinite(worst[best]):
            score *= _squash(worst[best])
        return self.langs[best], float(score)


def _squash(margin: float) -> float:
    return float(1.0 / (1.0 + np.exp(-3.0 * margin)))


def remainder(doc_id: str | Column) -> Column:
    """crc32 of the id as text, modulo 4 (null for a null id)."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(c.cast("string")) % 4


def _below(k: int) -> Column:
    """The k-th part of all hashes."""
    return F.col("h") < -(1 << 63) + (1 << 64) // k if k > 1 else F.lit(True)


def _any_of(cases) -> Column:
    out = F.lit(False)
    for lang, holds in cases:
        out = out | ((F.col("l") == lang) & holds)
    return out


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
        per_language: int = PER_LANGUAGE, dim: int = DIM) -> Model:
    """Train on rows whose remainder is not 2 and whose language is known."""
    d = docs.select(F.col(lang).cast("string").alias("l"), F.col(text).alias("t"), remainder(doc_id).alias("r"),
                    F.xxhash64(F.col(doc_id).cast("string"), F.col(text)).alias("h")) \
        .where((F.col("r") != 2) & F.col("l").isNotNull() & (F.col("l") != "und") & F.col("t").isNotNull())
    small_batches(docs.sparkSession)
    counts = d.groupBy("l").count().limit(MAX_LANGUAGES + 1).collect()
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not counts:
        return Model(np.zeros((0, dim), np.float32), [], dim)
    # hashes are uniform: about 4 * per_language rows of a language lie below its first border
    border = {r.l: max(1, r["count"] // (4 * per_language)) for r in counts}
    w = Window.partitionBy("l").orderBy("h")
    while True:
        low = d.select("l", "h").where(_any_of((r, _below(k)) for r, k in border.items()))
        top = {r.l: r for r in low.withColumn("n", F.row_number().over(w)).where(F.col("n") <= per_language)
               .groupBy("l").agg(F.max("h").alias("h"), F.max("n").alias("n")).collect()}
        short = [k for k in border if border[k] > 1 and (k not in top or top[k].n < per_language)]
        if not short:
            break
        border |= {k: border[k] // 4 for k in short}
    # equal rows have equal hashes; distinct ones bound the sample by per_language texts a language
    sample = d.where(_any_of((k, F.col("h") <= r.h) for k, r in top.items())).select("l", "t").distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep, xs = [], []
            for i in range(b.num_rows):
                t = b.column(1)[i].as_py()
                if LETTER.search(t):
                    keep.append(b.column(0)[i].as_py())
                    xs.append(features(t, dim).astype(np.float16).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(keep, pa.string()), pa.array(xs, pa.binary())], names=["l", "x"])

    rows = sample.mapInArrow(run, "l string, x binary").toArrow()
    x = np.frombuffer(b"".join(rows["x"].to_pylist()), np.float16).reshape(-1, dim).astype(np.float32)
    names = rows["l"].to_pylist()
    order = sorted(range(len(names)), key=lambda i: (names[i], x[i].tobytes()))
    return Model(x[order], [names[i] for i in order], dim)


def annotate(docs: DataFrame, model: Model, text: str = "text") -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with all its columns plus the predicted language and its score."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    def compute(col: pa.Array) -> list[pa.Array]:
        here = Model.__new__(Model)
        here.__dict__.update(shared.value)
        got = [here.predict(x.as_py()) for x in col]
        return [pa.array([x[0] for x in got], pa.string()), pa.array([x[1] for x in got], pa.float64())]

    return append_columns(docs, text, FIELDS, compute, "_lid_")


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row."""
    model = fit(docs, doc_id, text, lang)
    d = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    out, c = annotate(d, model)
    return out.select("doc_id", F.coalesce(remainder("doc_id") == 2, F.lit(False)).alias("held_out"),
                      F.col(c["lang_pred"]).alias("lang_pred"), F.col(c["score"]).alias("score"))
