"""Toxicity by a classifier chain.

Categories are predicted one after another, from broad to narrow; each linear
model sees the words of a text and the log-odds of the categories before it.
In training those log-odds are out of fold: each labelled row gets them from
models fitted without its fold, as unseen texts will.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grimlake.llm.common import id_as_text, stored, text_or_empty

#: Chain order: (category, condition over the label columns).
CATEGORIES = (("unfit", "quality = 0 OR toxic = 1"), ("toxic", "toxic = 1"),
              ("severe", "toxic = 1 AND quality = 0"))
#: Labelled rows used for fitting, at most: those with the smallest id hashes.
TRAIN_ROWS = 20_000
FEATURES = 256
FOLDS = 5
PENALTY = 0.3
#: Chi-square that a feature must reach.
LEAST_CHI = 15.0
STEPS = 200
THRESHOLD = 0.5
#: Word beginnings of these lengths are features too, by how many different
#: words of the text have them: inflected languages vary a stem.
PREFIXES = (5, 7)
LEVELS = (1, 2, 4)
KEPT_WORDS = 500_000
TOKEN = re.compile(r"[^\W_]+")


def marks_of(word: str) -> list[str]:
    return [word] + [f"{word[:n]}-" for n in PREFIXES if len(word) > n]


def tokens(text: str) -> list[str]:
    """Features of a text: its words, and beginnings with the levels they reach."""
    count = Counter(m for w in set(TOKEN.findall(text.lower())) for m in marks_of(w))
    return [f"{m}{level}" if m[-1] == "-" else m for m, n in count.items()
            for level in (LEVELS if m[-1] == "-" else (1,)) if n >= level]


def labelled_rows(docs: DataFrame, labels: DataFrame, categories, rows: int) -> DataFrame:
    """(fold, y0, y1, ..., tokens) of at most ``rows`` labelled documents. Labels
    are one row per id (of repeated ones the larger values); rows with a null
    id or a null category are left out."""
    ys = [F.expr(cond).cast("int").alias(f"y{k}") for k, (_, cond) in enumerate(categories)]
    marks = labels.select("doc_id", *ys).dropna().groupBy("doc_id").agg(
        *[F.max(f"y{k}").alias(f"y{k}") for k in range(len(ys))])
    chosen = marks.withColumn("at", F.xxhash64("doc_id")).orderBy("at", "doc_id").limit(rows)
    picked = docs.join(F.broadcast(chosen.drop("at")), "doc_id").select(
        F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(FOLDS)).cast("int").alias("fold"),
        *[f"y{k}" for k in range(len(ys))], "text")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for a in range(0, len(frame), 500):
                part = frame.iloc[a:a + 500]
                yield part.drop(columns="text").assign(tokens=[tokens(t) for t in part["text"]])

    return stored(picked.mapInPandas(run, "fold int, " + "".join(f"y{k} int, " for k in range(len(ys)))
                                     + "tokens array<string>"), "op5-train")


def select_features(train: DataFrame, n_categories: int, features: int) -> list[str]:
    """Tokens whose presence says most about some category (chi-square), counted
    over all training rows by Spark; the driver gets the ``features`` best."""
    total = train.agg(F.count(F.lit(1)).alias("n"), *[F.sum(f"y{k}").alias(f"p{k}")
                                                     for k in range(n_categories)]).first()
    if not total["n"]:
        return []
    n = float(total["n"])
    seen = train.withColumn("word", F.explode("tokens")).groupBy("word").agg(
        F.count(F.lit(1)).alias("df"), *[F.sum(f"y{k}").alias(f"y{k}") for k in range(n_categories)])
    chi = []
    for k in range(n_categories):
        share = float(total[f"p{k}"] or 0) / n
        if 0 < share < 1:
            want = F.col("df") * F.lit(share)
            chi.append(F.pow(F.col(f"y{k}") - want, 2) / (want * F.lit(1 - share)) * (F.lit(n) / (F.lit(n) - F.col("df") + 1)))
    if not chi:
        return []
    best = F.greatest(*chi) if len(chi) > 1 else chi[0]
    rows = seen.withColumn("chi", best).where(F.col("chi") >= LEAST_CHI).orderBy(F.col("chi").desc(), "word").limit(features).collect()
    return [r["word"] for r in rows]


def fit_linear(x: np.ndarray, y: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Logistic regression (last weight: bias) by accelerated gradient steps."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    rate = 1.0 / (0.25 * np.linalg.norm(x.T @ x, 2) + PENALTY)
    w = v = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], PENALTY)
    ridge[-1] = 1e-3
    for k in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ v, -30, 30)))
        nxt = v - rate * (x.T @ (p - y) + ridge * v)
        v = nxt + k / (k + 3) * (nxt - w)
        w = nxt
    return w


def log_odds(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return np.clip(x @ w[:-1] + w[-1], -12, 12)


class Chain:
    """Words and weights of a fitted chain; a few hundred numbers a category."""

    def __init__(self, vocabulary: list[str], weights: list[np.ndarray]):
        self.vocabulary = {w: i for i, w in enumerate(vocabulary)}
        self.weights = weights
        self.stems = {v.rpartition("-")[0] + "-" for v in vocabulary if "-" in v}
        self.known: dict[str, list[str]] = {}  # features of words seen before, up to KEPT_WORDS

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probabilities, a column for each category."""
        out = np.zeros((len(x), len(self.weights)))
        if not self.vocabulary:
            return out
        for k, w in enumerate(self.weights):
            z = log_odds(x, w)
            out[:, k] = 1 / (1 + np.exp(-z))
            x = np.hstack([x, z[:, None]])
        return out

    def features(self, texts: list[str]) -> np.ndarray:
        """Indicator rows of :func:`tokens`, counting only what the model knows."""
        x = np.zeros((len(texts), len(self.vocabulary)))
        known = self.known
        for i, t in enumerate(texts):
            count: Counter = Counter()
            for w in set(TOKEN.findall(t.lower())):
                if (found := known.get(w)) is None:
                    if len(known) >= KEPT_WORDS:
                        known.clear()
                    found = known[w] = [m for m in marks_of(w) if m in self.stems or m in self.vocabulary]
                if found:
                    count.update(found)
            for m, n in count.items():
                for name in [f"{m}{k}" for k in LEVELS if n >= k] if m[-1] == "-" else [m]:
                    if name in self.vocabulary:
                        x[i, self.vocabulary[name]] = 1
        return x


def fit_chain(x: np.ndarray, ys: np.ndarray, folds: np.ndarray) -> list[np.ndarray]:
    """Weights per category. Every later model is trained on out-of-fold log-odds."""
    weights = []
    for k in range(ys.shape[1]):
        y = ys[:, k].astype(float)
        weights.append(fit_linear(x, y))
        unseen = np.zeros(len(x))
        for f in range(FOLDS):
            out = folds == f
            if out.any():
                rest = fit_linear(x[~out], y[~out]) if (~out).any() else weights[-1]
                unseen[out] = log_odds(x[out], rest)
        x = np.hstack([x, unseen[:, None]])
    return weights


def train(docs: DataFrame, labels: DataFrame, categories=CATEGORIES, rows: int = TRAIN_ROWS,
          features: int = FEATURES) -> Chain:
    """Fit on at most ``rows`` labelled documents with columns doc_id, text.
    The driver gets their ``features`` indicator columns, never texts. Without
    labelled rows the chain gives probability 0."""
    n = len(categories)
    data = labelled_rows(docs, labels, categories, rows)
    vocabulary = select_features(data, n, features)
    if not vocabulary:
        return Chain([], [np.zeros(1)] * n)
    listed = F.array(*[F.lit(w) for w in vocabulary])
    frame = data.select("fold", *[f"y{k}" for k in range(n)],
                        F.array_intersect("tokens", listed).alias("tokens")).collect()
    at = {w: i for i, w in enumerate(vocabulary)}
    frame.sort(key=lambda r: (r["fold"], *[r[f"y{k}"] for k in range(n)], sorted(r["tokens"])))
    x = np.zeros((len(frame), len(vocabulary)))
    for i, r in enumerate(frame):
        x[i, [at[w] for w in r["tokens"]]] = 1
    ys = np.array([[r[f"y{k}"] for k in range(n)] for r in frame])
    return Chain(vocabulary, fit_chain(x, ys, np.array([r["fold"] for r in frame])))


def score(docs: DataFrame, chain: Chain, categories=CATEGORIES, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without its ``_text``, with p_<category>... and toxic."""
    names = [c for c, _ in categories]
    decisive = names.index("toxic")
    kept = [c for c in docs.columns if c != "_text"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for a in range(0, len(frame), 2000):
                part = frame.iloc[a:a + 2000]
                p = chain.predict(chain.features(part["_text"].tolist()))
                yield part[kept].assign(**{f"p_{c}": p[:, k] for k, c in enumerate(names)},
                                        toxic=p[:, decisive] >= threshold)

    schema = T.StructType([*[docs.schema[c] for c in kept], *[T.StructField(f"p_{c}", T.DoubleType())
                                                             for c in names],
                           T.StructField("toxic", T.BooleanType())])
    return docs.mapInPandas(run, schema)


def detect(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           categories=CATEGORIES, rows: int = TRAIN_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """Per row of ``docs``: doc_id, p_<category> for each category, and toxic.

    Null text counts as empty. Null ids are never trained on but are scored;
    repeated rows are scored alike; whole texts are read; empty tables give
    empty results.
    """
    doc_id, kind = id_as_text(docs, id_col)
    base = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    chain = train(base, labels, categories, rows)
    named = docs.select(doc_id.alias("doc_id"), text_or_empty(text_col).alias("_text"))
    return score(named, chain, categories, threshold).withColumn("doc_id", F.col("doc_id").cast(kind))


def reject(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           categories=CATEGORIES, rows: int = TRAIN_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that are not toxic, with their columns."""
    base = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    chain = train(base, labels, categories, rows)
    decisive = [c for c, _ in categories].index("toxic")
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), 2000):
                part = batch.slice(a, 2000)
                texts = [t or "" for t in part.column(at).to_pylist()]
                p = chain.predict(chain.features(texts))[:, decisive]
                yield part.filter(pa.array(p < threshold))

    return docs.mapInArrow(run, docs.schema)
