"""Toxicity: gradient-boosted trees over dense features, isotonic calibration.

Features of a text: densities of a fixed insult lexicon and of a lexicon
learned from the labels (whole words and word beginnings, in tiers of their log
odds), lexicon words close to a second-person word, capitals, punctuation and
obfuscation rates (letters mixed with digits or signs, long letter runs,
masked words).  Trees are fitted by numpy on binned features with the logistic
loss; a pool-adjacent-violators fit on out-of-fold margins turns margins into
probabilities.

Training uses a bounded sample of labelled documents (``Params.train_docs`` and
``train_chars``).  The learned lexicon is cross-fitted: the rows of one fold get
features from a lexicon learned on the others, so the trees do not learn from
words that were chosen because of the same row.

Defined cases: null, empty and blank texts have all features 0 and are scored
like any other row; without labels of both classes each text gets the share of
label 1 (0.5 without labels).
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .textmap import WordTable, code_points, labelled_texts, map_texts, segment_sums

#: Common insults.
INSULTS = frozenset("""
idiot idiots moron morons stupid dumb fool loser losers trash garbage scum
pathetic worthless disgusting clown jerk hate ugly bastard dumm trottel arsch
abschaum idiota imbécil basura asqueroso estúpido estupido imbécile stupide
ordure connard minable débile
""".split())
#: Words that address the reader.
SECOND_PERSON = frozenset("""
you your yours yourself ur du dich dir dein deine ihr euch tu te toi ton ta
tes vous votre vos tú ti tus usted ustedes vosotros
""".split())

NEAR = 5  # words between a lexicon word and a second-person word
#: Lowest log odds of each tier of the learned lexicon.
TIERS = (1.0, 2.0, 3.0)
FEATURES = ("fixed_share", "fixed_any", *(f"tier{k}_share" for k in range(len(TIERS))),
            *(f"tier{k}_count" for k in range(len(TIERS))), "odds_max", "odds_mean",
            "person_share", "near_share", "caps_words", "caps_chars", "bangs", "questions",
            "punctuation", "mixed", "masked", "runs", "words_log")
_MIXED = re.compile(r"[^\W\d_][0-9@$*#]+[^\W\d_]")
_MASKED = re.compile(r"\w[*#@$%!]{2,}\w?")
_EDGE = re.compile(r"^\W+|\W+$")


@dataclass(frozen=True)
class Params:
    train_docs: int = 4000     # bound of the labelled sample
    train_chars: int = 50_000  # longer texts are scored but not trained on
    folds: int = 3
    min_docs: int = 3          # positive documents of a learned unit
    prefix: tuple[int, int] = (3, 8)
    trees: int = 40
    depth: int = 3
    rate: float = 0.2
    bins: int = 32
    ridge: float = 1.0
    min_rows: int = 5


@dataclass
class Trees:
    """Complete binary trees of one depth, as arrays."""
    edges: list[np.ndarray]
    feature: list[np.ndarray] = field(default_factory=list)
    split: list[np.ndarray] = field(default_factory=list)
    leaf: list[np.ndarray] = field(default_factory=list)
    base: float = 0.0

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, k], side="left")
                         for k, e in enumerate(self.edges)], axis=1)

    def margin(self, x: np.ndarray) -> np.ndarray:
        b, out = self.binned(x), np.full(len(x), self.base)
        every = np.arange(len(x))
        for f, s, leaf in zip(self.feature, self.split, self.leaf):
            node = np.zeros(len(x), np.int64)
            while node.size and node[0] < len(f):
                node = 2 * node + 1 + (b[every, f[node]] > s[node])
            out += leaf[node - len(f)]
        return out


@dataclass(frozen=True)
class Model:
    lexicon: dict[str, float]
    trees: Trees | None
    knots: tuple[np.ndarray, np.ndarray] | None  # margin, probability
    prior: float
    params: Params


def units(word: str, p: Params) -> list[str]:
    """A word and its beginnings (marked by a trailing hyphen)."""
    lo, hi = p.prefix
    return [word, *(word[:n] + "-" for n in range(lo, min(hi, len(word) - 1) + 1))]


def _unit_counts(texts: list, p: Params) -> list[set]:
    cache: dict[str, list] = {}
    found = []
    for t in texts:
        got: set = set()
        for w in set((t or "").split()):
            if w not in cache:
                bare = _EDGE.sub("", w).lower()
                cache[w] = units(bare, p) if bare else ()
            got.update(cache[w])
        found.append(got)
    return found


def learn_lexicon(found: list[set], y: np.ndarray, p: Params) -> dict[str, float]:
    """Log odds of the units that mark label 1 well beyond chance."""
    pos, neg = Counter(), Counter()
    for got, label in zip(found, y):
        (pos if label else neg).update(got)
    n1, n0 = int(y.sum()), int(len(y) - y.sum())
    lexicon = {}
    for u, k in pos.items():
        if k >= p.min_docs:
            odds = np.log((k + 0.5) / (n1 + 1)) - np.log((neg[u] + 0.5) / (n0 + 1))
            expected = (k + neg[u]) * n1 / max(1, n1 + n0)
            if odds >= TIERS[0] and k - expected >= 4 * np.sqrt(expected):
                lexicon[u] = float(odds)
    return lexicon


def featurizer(lexicon: dict[str, float], p: Params):
    """Batch function: texts to one row of ``FEATURES`` each."""

    starts = {u[:p.prefix[0]] for u in lexicon}

    def build(words: list) -> tuple:
        out = np.zeros((len(words), 7), np.float32)
        low = list(map(str.lower, words))
        for i in [i for i, w in enumerate(words) if not w.isalpha()]:
            low[i] = _EDGE.sub("", low[i])
            out[i, 4] = bool(_MIXED.search(words[i]))
            out[i, 5] = bool(_MASKED.search(words[i]))
        for i in [i for i, w in enumerate(low) if w[:p.prefix[0]] in starts]:
            out[i, 1] = max(lexicon.get(u, 0.0) for u in units(low[i], p))
        out[[i for i, w in enumerate(low) if w in INSULTS], 0] = 1
        out[[i for i, w in enumerate(low) if w in SECOND_PERSON], 2] = 1
        size = np.fromiter(map(len, words), np.float32, len(words))
        out[:, 3] = np.fromiter(map(str.isupper, words), bool, len(words)) * size * (size > 1)
        chars, owner = code_points(words, "", " ")
        same = chars[1:] == chars[:-1]
        out[owner[:-2][same[1:] & same[:-1]], 6] = 1
        return (out,)

    table = WordTable(build)

    def features(texts: list) -> np.ndarray:
        x = np.zeros((len(texts), len(FEATURES)))
        split = [(t or "").split() for t in texts]
        lens = np.fromiter(map(len, split), np.int64, len(split))
        words = [w for s in split for w in s]
        if not words:
            return x
        at = table.lookup(words)
        v = table.cols[0][at]
        owner = np.repeat(np.arange(len(texts)), lens)
        n = np.maximum(lens, 1).astype(float)
        lex = (v[:, 0] > 0) | (v[:, 1] > 0)
        cols = [v[:, 0], *(v[:, 1] >= t for t in TIERS), v[:, 1], v[:, 2], v[:, 3] > 0, v[:, 4],
                v[:, 5], v[:, 6], v[:, 3]]
        sums = segment_sums(np.stack([c.astype(float) for c in cols], axis=1), lens)
        tiers = sums[:, 1:1 + len(TIERS)]
        best = np.zeros(len(texts))
        np.maximum.at(best, owner, v[:, 1].astype(float))
        near = np.zeros(len(texts))
        hot, you = np.flatnonzero(lex), np.flatnonzero(v[:, 2] > 0)
        if len(hot) and len(you):
            k = np.searchsorted(you, hot)
            for side in (np.clip(k, 0, len(you) - 1), np.clip(k - 1, 0, len(you) - 1)):
                close = (np.abs(you[side] - hot) <= NEAR) & (owner[you[side]] == owner[hot])
                np.add.at(near, owner[hot[close]], 1)
        chars = np.fromiter((len(t or "") for t in texts), float, len(texts))
        bangs = np.fromiter(((t or "").count("!") for t in texts), float, len(texts))
        asks = np.fromiter(((t or "").count("?") for t in texts), float, len(texts))
        stops = np.fromiter(((t or "").count(".") + (t or "").count(",") for t in texts), float,
                            len(texts))
        c = np.maximum(chars, 1)
        x[:, 0], x[:, 1] = sums[:, 0] / n, np.minimum(sums[:, 0], 8)
        x[:, 2:5], x[:, 5:8] = tiers / n[:, None], np.minimum(tiers, 8)
        o = 1 + len(TIERS)
        x[:, 8], x[:, 9], x[:, 10], x[:, 11] = best, sums[:, o] / n, sums[:, o + 1] / n, near / n
        x[:, 12], x[:, 13], x[:, 14], x[:, 15], x[:, 16] = sums[:, o + 2] / n, sums[:, o + 6] / c, \
            bangs / c, asks / c, stops / c
        x[:, 17:20] = sums[:, o + 3:o + 6] / n[:, None]
        x[:, 20] = np.log1p(lens)
        return x

    return features


def boost(x: np.ndarray, y: np.ndarray, p: Params) -> Trees:
    """Second-order boosting of complete trees on binned features."""
    edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, p.bins + 1)[1:-1],
                                   method="lower")) for k in range(x.shape[1])]
    # rare features: every tenth of their non-zero values is an edge, too
    for k in range(x.shape[1]):
        some = x[x[:, k] > 0, k]
        if len(some):
            edges[k] = np.unique(np.r_[0.0, edges[k], np.quantile(some, np.linspace(0, 1, 11)[:-1],
                                                                  method="lower")])
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    model = Trees(edges, base=float(np.log(share / (1 - share))))
    b = model.binned(x)
    width = max(len(e) for e in edges) + 1
    margin = np.full(len(y), model.base)
    for _ in range(p.trees):
        prob = 1 / (1 + np.exp(-margin))
        g, h = prob - y, prob * (1 - prob)
        f, s = np.zeros(2 ** p.depth - 1, np.int64), np.full(2 ** p.depth - 1, width, np.int64)
        node = np.zeros(len(y), np.int64)
        for level in range(p.depth):
            first, n_nodes = 2 ** level - 1, 2 ** level
            local = node - first
            gain_best = np.full(n_nodes, 1e-9)
            for k in range(x.shape[1]):
                key = local * width + b[:, k]
                gs, hs, cs = (np.bincount(key, w, n_nodes * width).reshape(n_nodes, width)
                              .cumsum(axis=1) for w in (g, h, None))
                gt, ht, ct = gs[:, -1:], hs[:, -1:], cs[:, -1:]
                gain = gs ** 2 / (hs + p.ridge) + (gt - gs) ** 2 / (ht - hs + p.ridge) \
                    - gt ** 2 / (ht + p.ridge)
                gain[(cs < p.min_rows) | (ct - cs < p.min_rows)] = -1
                at = gain.argmax(axis=1)
                top = gain[np.arange(n_nodes), at]
                better = top > gain_best
                gain_best = np.where(better, top, gain_best)
                f[first:first + n_nodes][better] = k
                s[first:first + n_nodes][better] = at[better]
            node = 2 * node + 1 + (b[np.arange(len(y)), f[node]] > s[node])
        leaf = node - len(f)
        size = 2 ** p.depth
        value = -p.rate * np.bincount(leaf, g, size) / (np.bincount(leaf, h, size) + p.ridge)
        margin += value[leaf]
        model.feature.append(f)
        model.split.append(s)
        model.leaf.append(value)
    return model


def isotonic(margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators; knots of a rising step-wise linear map."""
    at, inv = np.unique(margin, return_inverse=True)
    total, hits = np.bincount(inv), np.bincount(inv, y)
    blocks: list[list[float]] = []  # hits, rows, lowest and highest margin
    for m, n, k in zip(at, total, hits):
        blocks.append([k, n, m, m])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            k2, n2, _, hi = blocks.pop()
            blocks[-1][0] += k2
            blocks[-1][1] += n2
            blocks[-1][3] = hi
    xs = [e for b in blocks for e in (b[2], b[3])]
    ys = [(b[0] + 0.1) / (b[1] + 0.2) for b in blocks for _ in (0, 1)]
    return np.array(xs), np.maximum.accumulate(np.array(ys))


def train(rows: list[tuple[str, int]], p: Params = Params()) -> Model:
    y = np.array([float(v > 0) for _, v in rows])
    prior = (y.sum() + 1) / (len(y) + 2)
    if len(y) < 2 * p.folds or y.min() == y.max():
        return Model({}, None, None, float(prior), p)
    texts = [t for t, _ in rows]
    found = _unit_counts(texts, p)
    fold = np.random.default_rng(3).permutation(len(y)) % p.folds
    x = np.zeros((len(y), len(FEATURES)))
    for k in range(p.folds):
        ours = np.flatnonzero(fold == k)
        rest = np.flatnonzero(fold != k)
        lexicon = learn_lexicon([found[i] for i in rest], y[rest], p)
        x[ours] = featurizer(lexicon, p)([texts[i] for i in ours])
    margins = np.zeros(len(y))
    for k in range(p.folds):
        margins[fold == k] = boost(x[fold != k], y[fold != k], p).margin(x[fold == k])
    return Model(learn_lexicon(found, y, p), boost(x, y, p), isotonic(margins, y),
                 float(prior), p)


def scorer(model: Model):
    """Batch function: texts to one probability each."""

    def make():
        if model.trees is None:
            return lambda texts: (np.full(len(texts), model.prior),)
        features = featurizer(model.lexicon, model.params)

        def score(texts: list) -> tuple:
            margin = model.trees.margin(features(texts))
            raw = 1 / (1 + np.exp(-np.clip(margin, -40, 40)))
            # isotonic steps are flat; a hundredth of the raw value orders ties
            return (np.clip(0.99 * np.interp(margin, *model.knots) + 0.01 * raw, 0, 1),)

        return score

    return make


def fit(docs: DataFrame, labels: DataFrame, train_rows: Column | None = None,
        p: Params = Params()) -> Model:
    cond = F.lit(True) if train_rows is None else train_rows
    return train(labelled_texts(docs, labels, "toxic", cond, p.train_docs, p.train_chars), p)


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """``row`` (the input row), ``score`` and ``predicted`` per input row."""
    scored = map_texts(docs, scorer(model), [T.StructField("score", T.DoubleType())])
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
