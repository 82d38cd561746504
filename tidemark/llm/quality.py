"""Quality classifier: supervised subword embeddings.

Every word, character n-gram and pair of neighbouring words is hashed to a row
of one embedding table; a document is the mean of its rows, and a softmax layer
over that mean gives the class.  Both are learned by numpy stochastic gradient
descent (Adagrad steps) on a bounded sample of labelled documents
(``Params.train_docs`` and ``train_chars``).

Scoring needs no vectors: the mean is linear, so each table row is folded with
the softmax weights into one number, and a document's logit is the mean of the
numbers of its features.  Each task keeps the sums of the distinct words it
has met.  Whole texts are scored.

Defined cases: null, empty and blank texts have no feature and get the prior of
the training rows; repeated rows each get their score; with no labelled row of
both classes all documents get that prior (0.5 without any label).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .textmap import (WordTable, char_ngrams, code_points, labelled_texts, map_texts, mix64,
                      segment_sums)


@dataclass(frozen=True)
class Params:
    buckets: int = 1 << 15     # rows of the hashed embedding table
    dim: int = 8
    min_n: int = 3             # character n-gram lengths
    max_n: int = 4
    epochs: int = 6
    rate: float = 0.5
    batch: int = 32
    train_docs: int = 3000     # bound of the labelled sample
    train_chars: int = 50_000  # longer texts are scored but not trained on
    seed: int = 7


@dataclass(frozen=True)
class Model:
    weight: np.ndarray  # logit share of every bucket
    bias: float
    prior: float
    params: Params


def _word_hashes(words: list) -> np.ndarray:
    """One 64-bit hash per word, of all its characters."""
    chars, owner = code_points(words)
    starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    place = np.arange(len(chars)) - starts[owner]
    return mix64(np.add.reduceat(mix64(chars + (place.astype(np.uint64) << np.uint64(32))), starts))


def _bucket(h: np.ndarray, p: Params) -> np.ndarray:
    return (h % np.uint64(p.buckets)).astype(np.int64)


def _pair_buckets(h: np.ndarray, p: Params) -> np.ndarray:
    """Buckets of neighbouring pairs.  A word followed by itself is one shared
    feature whatever the word: repetition is what tells such texts apart."""
    a, b = h[:-1], h[1:]
    return np.where(a == b, 1, _bucket(mix64(a * np.uint64(3) + b), p))


def _subword_buckets(words: list, p: Params) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, word number) of the character n-grams of the words."""
    chars, owner = code_points(words)
    parts = [char_ngrams(chars, owner, n) for n in range(p.min_n, p.max_n + 1)]
    return (_bucket(np.concatenate([h for h, _ in parts]), p),
            np.concatenate([w for _, w in parts]))


def _features(text: str | None, p: Params) -> np.ndarray:
    words = (text or "").split()
    if not words:
        return np.empty(0, np.int64)
    h = _word_hashes(words)
    return np.concatenate([_bucket(h, p), _subword_buckets(words, p)[0], _pair_buckets(h, p)])


def train(rows: list[tuple[str, int]], p: Params = Params()) -> Model:
    """Learn the table and the softmax layer from ``(text, 0 or 1)`` rows."""
    y = np.array([int(v > 0) for _, v in rows], np.int64)
    prior = (y.sum() + 1) / (len(y) + 2)
    if len(y) == 0 or y.min() == y.max():
        return Model(np.zeros(p.buckets), float(np.log(prior / (1 - prior))), float(prior), p)
    docs = []
    for text, _ in rows:
        f, c = np.unique(_features(text, p), return_counts=True)
        docs.append((f, (c / max(1, c.sum())).astype(np.float32)))
    rng = np.random.default_rng(p.seed)
    emb = rng.uniform(-1 / p.dim, 1 / p.dim, (p.buckets, p.dim)).astype(np.float32)
    out = rng.normal(0, 1, (p.dim, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    g_emb, g_out = np.full(p.buckets, 1e-6, np.float32), np.full(out.shape, 1e-6, np.float32)
    g_bias = np.full(2, 1e-6, np.float32)
    for _ in range(p.epochs):
        order = rng.permutation(len(docs))
        for lo in range(0, len(order), p.batch):
            at = order[lo:lo + p.batch]
            f = np.concatenate([docs[i][0] for i in at])
            w = np.concatenate([docs[i][1] for i in at])
            lens = np.array([len(docs[i][0]) for i in at])
            mean = segment_sums(emb[f] * w[:, None], lens)
            z = mean @ out + bias
            z -= z.max(axis=1, keepdims=True)
            prob = np.exp(z)
            prob /= prob.sum(axis=1, keepdims=True)
            prob[np.arange(len(at)), y[at]] -= 1
            prob /= len(at)
            d_out, d_bias = mean.T @ prob, prob.sum(axis=0)
            d_mean = (prob @ out.T).astype(np.float32)
            rows_, inv = np.unique(f, return_inverse=True)
            d_rows = w[:, None] * np.repeat(d_mean, lens, axis=0)
            d_emb = np.stack([np.bincount(inv, d_rows[:, k], len(rows_))
                              for k in range(p.dim)], axis=1).astype(np.float32)
            g_emb[rows_] += (d_emb ** 2).mean(axis=1)
            emb[rows_] -= p.rate * d_emb / np.sqrt(g_emb[rows_])[:, None]
            g_out += d_out ** 2
            out -= p.rate * 0.2 * d_out / np.sqrt(g_out)
            g_bias += d_bias ** 2
            bias -= p.rate * 0.2 * d_bias / np.sqrt(g_bias)
    side = (out[:, 1] - out[:, 0]).astype(np.float64)
    return Model(emb.astype(np.float64) @ side, float(bias[1] - bias[0]), float(prior), p)


def scorer(model: Model):
    """Batch function: texts to one score each."""
    p, weight = model.params, model.weight

    def build(words: list) -> tuple:
        h = _word_hashes(words)
        b, owner = _subword_buckets(words, p)
        total = weight[_bucket(h, p)] + np.bincount(owner, weight[b], len(words))
        return h, total, 1 + np.bincount(owner, minlength=len(words))

    def make():
        table = WordTable(build)

        def score(texts: list) -> tuple:
            split = [(t or "").split() for t in texts]
            lens = np.fromiter(map(len, split), np.int64, len(split))
            words = [w for s in split for w in s]
            result = np.full(len(texts), model.prior)
            if words:
                at = table.lookup(words)
                h, total, n = (c[at] for c in table.cols)
                pair = np.zeros(len(words))
                pair[:-1] = weight[_pair_buckets(h, p)]
                ends = np.cumsum(lens)[lens > 0] - 1
                pair[ends] = 0  # the last word of a text has no partner
                logit = segment_sums(total + pair, lens)
                size = segment_sums(n.astype(float), lens) + np.maximum(lens - 1, 0)
                z = np.clip(logit / np.maximum(size, 1) + model.bias, -40, 40)
                result = np.where(lens > 0, 1 / (1 + np.exp(-z)), result)
            return (result,)

        return score

    return make


def fit(docs: DataFrame, labels: DataFrame, train_rows: Column | None = None,
        p: Params = Params()) -> Model:
    """Train on the labelled rows of ``docs`` for which ``train_rows`` (a
    condition on ``doc_id``) holds."""
    cond = F.lit(True) if train_rows is None else train_rows
    return train(labelled_texts(docs, labels, "quality", cond, p.train_docs, p.train_chars), p)


def score_documents(docs: DataFrame, model: Model, once: bool = False) -> DataFrame:
    """``row`` (the input row), ``score`` and ``predicted`` per input row (``once`` as in
    ``map_texts``)."""
    scored = map_texts(docs, scorer(model), [T.StructField("score", T.DoubleType())], once=once)
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
