"""Toxicity by a classifier chain: linear models that see earlier categories' probabilities.

The categories are 0/1 columns of a label table, predicted one after the other.
Each model is a logistic regression over word features, a few shape features
and the logits of the categories before it; for training those come from models
that did not see the row (out-of-fold), for prediction from the final models.

Training uses a bounded sample: at most ``max_train`` labelled rows, those with
the smallest hash of their id.  Prediction reads every document once.

Cases: labels that are null, or whose document is missing, are not used; with
no labelled rows, or only one class, a category gets a constant probability; a
null or empty text has no words and is scored by its shape features alone; each
of several rows with one id gets its own score; an empty table gives an empty
result.  Only id and text are read, so other columns may have any names;
``nontoxic`` keeps all columns of its input.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsfold.llm.frames import stored, trimmed
from opsfold.llm.hashing import PUNCTUATION, SPACE, U64, Words, mix, slices

MAX_TRAIN = 10_000
MAX_FEATURES = 600
MIN_DOCS = 3
FOLDS = 5
THRESHOLD = 0.4
SLICE_BYTES = 1_000_000
SHAPES = 5
SEPARATORS = SPACE + PUNCTUATION
PREFIXES = (4, 6)  # bytes


def text_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text number, word hash) pairs, and a row of shape features per text."""
    raw = [t.encode() for t in texts]
    w = Words([t.lower().encode() for t in texts], SEPARATORS)
    n = np.diff(w.first)
    owner = np.repeat(np.arange(len(texts)), n)
    features, owners = [w.hashes], [owner]
    for k in PREFIXES:  # inflected and compound words share their beginnings
        long = w.end - w.start > k
        features.append(mix(w.prefixes(k)[long] + U64(k)))
        owners.append(owner[long])
    h, o = np.concatenate(features), np.concatenate(owners)
    order = np.lexsort((h, o))
    h, o = h[order], o[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
    o, h = o[new], h[new]
    distinct = np.bincount(o, minlength=len(texts))
    chars = np.bincount(owner, weights=w.end - w.start, minlength=len(texts))
    size = np.array([max(len(r), 1) for r in raw], dtype=float)
    upper = np.array([len(r) - len(r.translate(None, _UPPER)) for r in raw]) / size
    symbols = np.array([sum(map(r.count, _MARKS)) for r in raw]) / size
    some = np.maximum(n, 1)
    shapes = np.stack([np.log1p(n), distinct / some, chars / some / 10, upper, symbols * 5], axis=1)
    return o, h, shapes


_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_MARKS = [bytes([c]) for c in b"#*$%&|!"]


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_linear(x: np.ndarray, y: np.ndarray, steps: int = 300, ridge: float = 1e-5) -> np.ndarray:
    """Weights (the last one is the bias) of a logistic regression, by accelerated descent."""
    share = float(y.mean()) if len(y) else 0.0
    w = np.zeros(x.shape[1] + 1, dtype=np.float32)
    y = y.astype(np.float32)
    w[-1] = np.log((share + 1e-4) / (1 - share + 1e-4))
    if not 0 < share < 1:
        return w
    xb = np.hstack([x, np.ones((len(x), 1), dtype=x.dtype)])
    v = np.random.Generator(np.random.PCG64(1)).random(xb.shape[1], dtype=np.float32)
    for _ in range(12):  # power iteration: the largest curvature
        v = xb.T @ (xb @ v)
        curvature = np.linalg.norm(v)
        v /= curvature
    rate = np.float32(1 / (0.25 * curvature / len(x) * 1.1 + ridge))
    ridge = np.float32(ridge)
    ahead = w.copy()
    for k in range(steps):
        grad = (_sigmoid(xb @ ahead) - y) @ xb / np.float32(len(x))
        grad[:-1] += ridge * ahead[:-1]
        nxt = ahead - rate * grad
        ahead = nxt + np.float32(k / (k + 3)) * (nxt - w)
        w = nxt
    return w


@dataclass
class Chain:
    """A fitted chain: the words it looks at, and one weight vector per category."""

    names: list[str]
    words: np.ndarray
    value: np.ndarray  # of a word's feature: rare words get larger ones, so all learn as fast
    center: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray] = field(default_factory=list)

    def matrix(self, owner: np.ndarray, hashes: np.ndarray, shapes: np.ndarray) -> np.ndarray:
        x = np.zeros((len(shapes), len(self.words) + shapes.shape[1]), dtype=np.float32)
        if len(self.words):
            at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
            hit = self.words[at] == hashes
            x[owner[hit], at[hit]] = self.value[at[hit]]
        x[:, len(self.words):] = (shapes - self.center) / self.scale
        return x

    def predict(self, texts: list[str]) -> np.ndarray:
        """Probabilities, a row per text and a column per category."""
        x = self.matrix(*text_features(texts))
        out = np.zeros((len(texts), len(self.names)))
        for j, w in enumerate(self.weights):
            z = x @ w[:x.shape[1]] + w[-1]
            out[:, j] = _sigmoid(z)
            x = np.hstack([x, _chained(z)])
        return out


def _chained(z: np.ndarray) -> np.ndarray:
    return np.clip(z, -6, 6)[:, None].astype(np.float32) / 6


def choose_words(words: np.ndarray, docs: np.ndarray, with_word: np.ndarray, positive: np.ndarray,
                 n: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Words whose share of documents differs most between the classes of any category,
    and their shares.

    ``docs`` counts the documents of each word, ``with_word`` those of each category
    (a column each), ``positive`` all documents of each category, ``n`` all documents.
    """
    chosen = np.zeros(len(words), dtype=bool)
    for j in range(len(positive)):
        pos, neg = max(positive[j], 1), max(n - positive[j], 1)
        a, b = (with_word[:, j] + 0.5) / (pos + 1), (docs - with_word[:, j] + 0.5) / (neg + 1)
        mean = (docs + 1) / (n + 2)
        z = np.abs(a - b) / np.sqrt(mean * (1 - mean) * (1 / pos + 1 / neg))
        top = np.argsort(-z, kind="stable")[:most // len(positive)]
        chosen[top[(z[top] > 3) & (docs[top] >= MIN_DOCS)]] = True
    order = np.flatnonzero(chosen)[np.argsort(words[chosen])]
    return words[order], docs[order] / max(n, 1)


def _empty_chain(names: list[str], words: np.ndarray, share: np.ndarray, shapes: np.ndarray) -> Chain:
    center = shapes.mean(axis=0) if len(shapes) else np.zeros(SHAPES)
    scale = shapes.std(axis=0) + 1e-6 if len(shapes) else np.ones(SHAPES)
    return Chain(list(names), words, (0.5 / np.sqrt(share)).astype(np.float32), center, scale)


def _fit(chain: Chain, x: np.ndarray, y: np.ndarray, folds: int) -> Chain:
    """Fit the models one after the other; later ones see out-of-fold logits of earlier ones."""
    fold = np.arange(len(x)) % folds
    for j in range(len(chain.names)):
        chain.weights.append(fit_linear(x, y[:, j]))
        held = np.zeros(len(x))
        for f in range(folds):
            w = fit_linear(x[fold != f], y[fold != f, j])
            held[fold == f] = x[fold == f] @ w[:-1] + w[-1]
        x = np.hstack([x, _chained(held)])
    return chain


def fit_chain(names: list[str], texts: list[str], y: np.ndarray,
              max_features: int = MAX_FEATURES, folds: int = FOLDS) -> Chain:
    """Fit the chain to texts in memory and their 0/1 labels (a column per category)."""
    y = np.asarray(y, dtype=float).reshape(len(texts), len(names))
    owner, hashes, shapes = text_features(texts)
    words, at = np.unique(hashes, return_inverse=True)
    counts = [np.bincount(at, weights=w, minlength=len(words)) for w in (None, *y[owner].T)]
    chosen = choose_words(words, counts[0], np.stack(counts[1:], axis=1), y.sum(axis=0), len(y),
                          max_features)
    chain = _empty_chain(names, *chosen, shapes)
    return _fit(chain, chain.matrix(owner, hashes, shapes), y, folds)


def train(docs: DataFrame, labels: DataFrame, categories: dict[str, Column],
          id_col: str = "doc_id", text_col: str = "text", max_train: int = MAX_TRAIN,
          max_features: int = MAX_FEATURES, folds: int = FOLDS) -> Chain:
    """Fit a chain on a sample of at most ``max_train`` labelled documents.

    The tasks count words and, once they are chosen, look up which of them each
    document holds; the driver gets counts of words in ``MIN_DOCS`` documents or
    more and the rows of the design matrix, both bounded by the sample.
    """
    names, ys = list(categories), [f"__y{j}" for j in range(len(categories))]
    marked = labels.select(F.col(id_col).alias("__id"),
                           *(c.cast("int").alias(y) for c, y in zip(categories.values(), ys)))
    marked = marked.dropna().groupBy("__id").agg(*(F.max(y).alias(y) for y in ys))
    sample = marked.orderBy(F.xxhash64("__id"), "__id").limit(max_train)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = (docs.select(F.col(id_col).alias("__id"), text.alias("__text"))
            .join(F.broadcast(sample), "__id").dropDuplicates(["__id"]))  # sample: max_train rows
    rows = stored(rows.orderBy(F.xxhash64("__id"), "__id").limit(max_train)
                  .repartition(max(1, max_train // 1000)), "sample").select("__text", *ys)

    def words_of(batches):
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for a, b in slices([len(t) for t in texts], SLICE_BYTES):
                owner, hashes, _ = text_features(texts[a:b])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes.view(np.int64)),
                     *(batch.column(y).slice(a, b - a).take(pa.array(owner)) for y in ys)],
                    names=["word", *ys])

    counts = (rows.mapInArrow(words_of, "word long, " + ", ".join(f"{y} int" for y in ys))
              .groupBy("word").agg(F.count(F.lit(1)).alias("docs"),
                                   *(F.sum(y).cast("long").alias(y) for y in ys))
              .filter(F.col("docs") >= MIN_DOCS).toArrow())
    y = np.array(rows.select(*ys).collect(), dtype=float).reshape(-1, len(ys))
    with_word = np.stack([counts[c].to_numpy() for c in ys], axis=1).reshape(-1, len(ys))
    words, share = choose_words(counts["word"].to_numpy().view(U64), counts["docs"].to_numpy(),
                                with_word, y.sum(axis=0), len(y), max_features)
    lookup = _empty_chain(names, words, share, np.empty((0, SHAPES)))

    def design(batches):
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for a, b in slices([len(t) for t in texts], SLICE_BYTES):
                owner, hashes, shapes = text_features(texts[a:b])
                x = lookup.matrix(owner, hashes, shapes)[:, :len(words)]
                held = [np.flatnonzero(r) for r in x]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(held, pa.list_(pa.int32())), pa.array(list(shapes), pa.list_(pa.float64())),
                     *(batch.column(y).slice(a, b - a) for y in ys)],
                    names=["held", "shapes", *ys])

    table = rows.mapInArrow(design, "held array<int>, shapes array<double>, "
                            + ", ".join(f"{y} int" for y in ys)).toArrow()
    y = np.stack([table[c].to_numpy().astype(float) for c in ys], axis=1).reshape(-1, len(ys))
    shapes = np.array(table["shapes"].to_pylist(), dtype=float).reshape(-1, SHAPES)
    chain = _empty_chain(names, words, share, shapes)
    held = table["held"].to_pylist()
    owner = np.repeat(np.arange(len(held)), [len(h) for h in held]).astype(np.int64)
    hashes = words[np.array([i for h in held for i in h], dtype=np.int64)]
    return _fit(chain, chain.matrix(owner, hashes, shapes), y, folds)


def _score_batches(batches, chain: Chain, column: int):
    for batch in batches:
        texts = ["" if t is None else t for t in batch.column(column).to_pylist()]
        for a, b in slices([len(t) for t in texts], SLICE_BYTES):
            yield batch.slice(a, b - a), chain.predict(texts[a:b])


def score(docs: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text",
          threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, a probability per category, and whether it reaches the threshold."""
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([source.schema["doc_id"],
                           *(T.StructField(f"p_{n}", T.DoubleType()) for n in chain.names),
                           *(T.StructField(f"is_{n}", T.BooleanType()) for n in chain.names)])

    def run(batches):
        for part, p in _score_batches(batches, chain, 1):
            columns = list(p.T)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *(pa.array(c) for c in columns),
                 *(pa.array(c >= threshold) for c in columns)], names=schema.names)

    return source.mapInArrow(trimmed(run), schema)


def below(docs: DataFrame, chain: Chain, category: str, text_col: str = "text",
          threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows whose ``category`` reaches the threshold; nothing is shuffled."""
    j, at = chain.names.index(category), docs.columns.index(text_col)

    def run(batches):
        for part, p in _score_batches(batches, chain, at):
            yield part.filter(pa.array(p[:, j] < threshold))

    return docs.mapInArrow(trimmed(run), docs.schema)


def label_categories() -> dict[str, Column]:
    """The chain over the label table: poor quality first, then toxicity."""
    return {"poor": F.col("quality") == 0, "toxic": F.col("toxic") == 1}
