"""Toxicity by a classifier chain of linear models.

Categories are predicted in order; each later model sees the probabilities of the earlier ones.
The models are fitted on a bounded sample of labelled documents; in training, the earlier
probabilities that a later model sees are out-of-fold, so they look as they will on new texts.
Features are the presence of words; the vocabulary is chosen by how unevenly a word's documents
fall on a category, from document counts over the sample. Scoring reads every whole text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripledger.sources.scratch import materialize

#: Labelled documents that are fitted on, per value of each category at most.
SAMPLE = 2_000
#: Words per category.
VOCABULARY = 256
FOLDS = 3
RIDGE = 1.0

_LETTERS = re.compile(r"[^\W\d_]+")


def terms(text: str | None) -> set[str]:
    """The distinct lower-cased runs of letters of a whole text."""
    return set(_LETTERS.findall(text.lower())) if text else set()


def _fit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge-penalized logistic regression by Newton steps; the last weight is the constant."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], RIDGE)
    penalty[-1] = 1e-6
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + penalty * w
        curvature = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curvature, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _predict(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))


class Chain:
    """Words, and for each category its weights: words, earlier probabilities, constant."""

    def __init__(self, categories: list[str], words: list[str], weights: list[np.ndarray], limits: list[float]):
        self.categories, self.words, self.weights, self.limits = categories, words, weights, limits
        self.place = {w: i for i, w in enumerate(words)}

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Probability of each category (columns) for each text."""
        n = len(self.words)
        sums = np.array([w[:n] for w in self.weights]).T.reshape(n, len(self.weights))
        known = self.place.keys()
        out = np.empty((len(texts), len(self.weights)))
        for i, t in enumerate(texts):
            at = [self.place[w] for w in terms(t) & known]
            base = sums[at].sum(axis=0)
            earlier: list[float] = []
            for k, w in enumerate(self.weights):
                z = base[k] + w[-1] + sum(a * b for a, b in zip(w[n:-1], earlier))
                earlier.append(1 / (1 + np.exp(-min(30.0, max(-30.0, z)))))
            out[i] = earlier
        return out


def _best_limit(p: np.ndarray, y: np.ndarray) -> float:
    """The probability at which out-of-fold predictions have the best F1; 0.5 without examples."""
    order = np.argsort(-p, kind="stable")
    hits = np.cumsum(y[order])
    if not hits.size or not hits[-1]:
        return 0.5
    f1 = 2 * hits / (np.arange(1, len(y) + 1) + hits[-1])
    best = np.argmax(f1)
    below = p[order][best + 1] if best + 1 < len(p) else 0.0
    return float((p[order][best] + below) / 2)


def train(docs: DataFrame, labels: DataFrame, categories: list[str], key: str = "doc_id", text: str = "text",
          sample: int = SAMPLE) -> Chain:
    """Fit the chain. `labels` has `key` and a 0/1 column per category, in the order of the chain.

    For each value of each category the `sample` labelled documents with the smallest key hashes
    are taken. Rows without key or with a null label are ignored; of repeated keys the largest
    labels count. A category without both values predicts its prior.
    """
    known = labels.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), *categories).na.drop()
    known = known.groupBy("key").agg(*[F.max(c).cast("int").alias(c) for c in categories])
    known = materialize(known.withColumn("draw", F.xxhash64("key")), "labels")
    picked = None
    for c in categories:
        for value in (0, 1):  # the smallest hashes of each kind; both sides are bounded
            some = known.where(F.col(c) == value).orderBy("draw", "key").limit(sample)
            picked = some if picked is None else picked.unionByName(some)
    picked = materialize(picked.distinct(), "sample")
    texts = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    rows = (  # at most 2 * sample * len(categories) keys are broadcast, and as many rows come back
        texts.join(F.broadcast(picked), "key").groupBy("key", *categories)
        .agg(F.min("text").alias("text")).orderBy("key")
    )
    y_rows, bags = [], []
    schema = T.StructType([T.StructField(c, T.IntegerType()) for c in categories]
                          + [T.StructField("words", T.ArrayType(T.StringType()))])

    def bag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = [sorted(terms(t)) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in categories], pa.array(words, pa.list_(pa.string()))],
                names=[*categories, "words"])

    bagged = materialize(rows.mapInArrow(bag, schema), "bags")
    counts = bagged.select(*categories, F.explode("words").alias("word")).groupBy("word").agg(
        F.count("*").alias("n"), *[F.sum(c).alias(c) for c in categories])
    totals = bagged.agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for c in categories]).first()
    vocabulary: dict[str, None] = {}
    for c in categories:
        share = (totals[c] or 0) / max(1, totals["n"])
        # Distance of a word's labelled documents from the overall share, in standard deviations.
        off = F.abs(F.col(c) - F.col("n") * share) / F.sqrt(F.col("n") * max(share * (1 - share), 1e-9) + 1)
        for r in counts.where("n >= 3").orderBy(off.desc(), "word").select("word").limit(VOCABULARY).collect():
            vocabulary[r["word"]] = None
    words = list(vocabulary)
    place = {w: i for i, w in enumerate(words)}
    for r in bagged.select(*categories, F.array_intersect("words", F.array(*[F.lit(w) for w in words]).cast(
            "array<string>")).alias("words")).toLocalIterator():
        y_rows.append([r[c] for c in categories])
        bags.append([place[w] for w in r["words"]])
    x = np.zeros((len(bags), len(words)))
    for i, b in enumerate(bags):
        x[i, b] = 1
    y = np.array(y_rows, float).reshape(-1, len(categories))
    fold = np.arange(len(x)) % FOLDS
    weights, limits = [], []
    for k in range(len(categories)):
        if len(np.unique(y[:, k])) < 2:
            prior = float(np.clip(y[:, k].mean() if len(y) else 0.0, 1e-6, 1 - 1e-6))
            w = np.zeros(x.shape[1] + 1)
            w[-1] = np.log(prior / (1 - prior))
            out_of_fold = np.full(len(x), prior)
        else:
            w = _fit(x, y[:, k])
            out_of_fold = np.empty(len(x))
            for f in range(FOLDS):
                out_of_fold[fold == f] = _predict(x[fold == f], _fit(x[fold != f], y[fold != f, k]))
        weights.append(w)
        limits.append(_best_limit(out_of_fold, y[:, k]))
        x = np.hstack([x, out_of_fold[:, None]])
    return Chain(categories, words, weights, limits)


def score(docs: DataFrame, chain: Chain, text: str = "text") -> DataFrame:
    """`row` (all columns but the text), and for each category `p_<category>` and `is_<category>`.

    Null and empty texts are texts without words. Equal texts get equal scores. An empty input
    gives no row.
    """
    others = [c for c in docs.columns if c != text]
    kept = F.struct(*[F.col(f"`{c}`") for c in others]) if others else F.struct(F.lit(0).alias("none"))
    rows = docs.select(kept.alias("row"), F.col(text).cast("string").alias("text"))
    schema = T.StructType([rows.schema["row"], T.StructField("p", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = chain.scores(b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), pa.array(p.tolist(), pa.list_(pa.float64()))], names=["row", "p"])

    out = rows.mapInArrow(run, schema)
    cols = []
    for k, (c, limit) in enumerate(zip(chain.categories, chain.limits)):
        cols += [F.get("p", k).alias(f"p_{c}"), (F.get("p", k) >= limit).alias(f"is_{c}")]
    return out.select("row", *cols)
