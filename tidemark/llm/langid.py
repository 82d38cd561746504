"""Language ID with language-bitmask n-gram filters.

One bit-sliced Bloom filter holds the character n-grams of all languages: each
slot is a bitmask with one bit per language, in as many 64-bit words as there are
languages for.  The AND of the ``hashes`` slots
of an n-gram is the set of all languages that contain it.  A text is decided by
the count of its n-grams per language bit, corrected for the filter's false
positives: with ``p`` the chance that an unknown n-gram shows the bit and ``r``
the observed share, the corrected share is ``(r - p) / (1 - p)``.

Training counts n-grams on Spark over a bounded sample per language
(``Params.train_docs`` and ``Params.train_chars``, by a hash of the id).  Texts of one language quote others, so an n-gram is a
member of a language if its rate there is at least ``member`` times its highest
rate in any language.

Defined cases: a null text or one without a letter is ``und`` with score 0;
ties go to the language whose name sorts first; with nothing learned every text
is ``und``.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .textmap import WORD_LIMIT, WordTable, char_ngrams, code_points, map_texts, mix64, segment_sums

UNDETERMINED = "und"
#: Words are runs of letters (no digits, no underscore).
WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Params:
    slots: int = 1 << 20     # slots of the filter, one bitmask each
    hashes: int = 3
    min_n: int = 2
    max_n: int = 4
    member: float = 0.3
    min_count: int = 2       # rarer n-grams of the sample are not learned
    train_docs: int = 2000   # bound of the sample of each language
    train_chars: int = 20_000_000  # the same in characters


@dataclass(frozen=True)
class Model:
    langs: tuple[str, ...]
    masks: np.ndarray      # slots of the first 64 languages, of the next, ...: uint64
    false_rate: np.ndarray  # per language
    params: Params


def _grams(words: list, p: Params) -> tuple[np.ndarray, np.ndarray]:
    chars, owner = code_points(words, "<", ">")
    parts = [char_ngrams(chars, owner, n) for n in range(p.min_n, p.max_n + 1)]
    return np.concatenate([h for h, _ in parts]), np.concatenate([o for _, o in parts])


def _slots(grams: np.ndarray, p: Params):
    """The slots of each n-gram, one array per hash function."""
    step = mix64(grams ^ np.uint64(0xA5A5A5A5A5A5A5A5)) | np.uint64(1)
    for k in range(p.hashes):
        yield ((grams + np.uint64(k) * step) >> np.uint64(20)) % np.uint64(p.slots)


def gram_counts(texts: DataFrame, p: Params = Params()) -> DataFrame:
    """``(lang, gram, n)`` of a table ``(lang, text)``; counts are summed in
    each task before the shuffle."""

    def run(batches: Iterable[pa.RecordBatch]):
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), dtype=object)
            split = [WORD.findall((t or "").lower()) for t in batch.column(1).to_pylist()]
            for lang in sorted(set(langs)):
                words = [w for i in np.flatnonzero(langs == lang) for w in split[i]]
                if words:
                    grams, n = np.unique(_grams(words, p)[0], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(grams)), pa.array(grams.view(np.int64)),
                         pa.array(n.astype(np.int64))], ["lang", "gram", "n"])

    return (texts.select("lang", "text").mapInArrow(run, "lang string, gram long, n long")
            .groupBy("lang", "gram").agg(F.sum("n").alias("n")))


def language_bit(masks: np.ndarray, b: int) -> np.ndarray:
    """Bit of language ``b`` in each mask; ``masks`` has a row for 64 languages."""
    return masks[b // 64] >> np.uint64(b % 64) & np.uint64(1)


def languages_of(grams: np.ndarray, model: Model) -> np.ndarray:
    """Mask of all languages that contain each n-gram, a row for 64 languages."""
    masks = model.masks.reshape(-1, model.params.slots)
    out = np.full((len(masks), len(grams)), ~np.uint64(0))
    for at in _slots(grams, model.params):
        out &= masks[:, at]
    return out


def build(langs: list[str], grams: list[np.ndarray], p: Params = Params()) -> Model:
    """Filter of the member n-grams (hashes) of each language."""
    masks = np.zeros((max(1, -(-len(langs) // 64)), p.slots), np.uint64)
    for b, members in enumerate(grams):
        for at in _slots(members, p):
            masks[b // 64, at] |= np.uint64(1 << b % 64)
    fill = np.array([language_bit(masks, b).mean() for b in range(len(langs))])
    return Model(tuple(langs), masks.ravel(), fill ** p.hashes, p)


def _by_lang(values: dict[str, float]) -> Column:
    """Literal map of a value per language."""
    if not values:
        return F.create_map().cast("map<string,double>")
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def fit(docs: DataFrame, train_rows: Column | None = None, p: Params = Params()) -> Model:
    """Learn from the rows with a language for which ``train_rows`` holds."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    if train_rows is not None:
        rows = rows.where(train_rows)
    sizes = {r["lang"]: min(1.0, p.train_docs / r["n"], p.train_chars / max(r["chars"], 1))
             for r in rows.groupBy("lang").agg(F.count("*").alias("n"),
                                               F.sum(F.length("text")).alias("chars")).collect()}
    if not sizes:
        return Model((), np.zeros(p.slots, np.uint64), np.zeros(0), p)
    share = F.element_at(_by_lang(sizes), F.col("lang"))
    sample = rows.where(F.pmod(F.xxhash64("doc_id", F.lit("lang")), F.lit(1 << 30))
                        < share * (1 << 30)).select("lang", "text")
    counts = gram_counts(sample, p)
    # rate of an n-gram in a language against its highest rate in any
    totals = counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()
    total = _by_lang({r["lang"]: float(r["n"]) for r in totals})
    rated = counts.withColumn("rate", F.col("n") / F.element_at(total, F.col("lang")))
    best = rated.groupBy("gram").agg(F.max("rate").alias("best"), F.sum("n").alias("all"))
    members = (rated.join(best, "gram")
               .where((F.col("all") >= p.min_count) & (F.col("rate") >= F.col("best") * p.member))
               .select("lang", "gram").toPandas())  # bounded by the sample
    langs = sorted(sizes)
    return build(langs, [members.loc[members["lang"] == x, "gram"].to_numpy(np.int64)
                         .view(np.uint64) for x in langs], p)


def predictor(model: Model):
    """Batch function: texts to (language, score)."""
    p, n_langs = model.params, len(model.langs)
    names = np.array([*model.langs, UNDETERMINED], dtype=object)

    def build_words(words: list) -> tuple:
        grams, owner = _grams(words, p)
        mask = languages_of(grams, model)
        hits = np.stack([np.bincount(owner, language_bit(mask, b).astype(float), len(words))
                         for b in range(n_langs)], axis=1)
        return hits, np.bincount(owner, minlength=len(words)).astype(float)

    def make():
        table = WordTable(build_words, min(WORD_LIMIT, 32_000_000 // max(n_langs, 1)))

        def predict(texts: list) -> tuple:
            split = [WORD.findall((t or "").lower()) for t in texts]
            lens = np.fromiter(map(len, split), np.int64, len(split))
            words = [w for s in split for w in s]
            pred, score = np.full(len(texts), n_langs), np.zeros(len(texts))
            if words and n_langs:
                at = table.lookup(words)
                hits = segment_sums(table.cols[0][at], lens)
                size = segment_sums(table.cols[1][at], lens)
                share = hits / np.maximum(size, 1)[:, None]
                true = np.clip((share - model.false_rate)
                               / np.maximum(1 - model.false_rate, 1e-9), 0, 1)
                some = lens > 0
                pred[some] = true.argmax(axis=1)[some]
                score[some] = (true.max(axis=1) / np.maximum(true.sum(axis=1), 1e-12))[some]
            return pa.array(names[pred], pa.string()), np.clip(score, 0, 1)

        return predict

    return make


def predict_documents(docs: DataFrame, model: Model) -> DataFrame:
    """``row`` (the input row), ``lang_pred`` and ``score`` per input row."""
    return map_texts(docs, predictor(model), [T.StructField("lang_pred", T.StringType()),
                                              T.StructField("score", T.DoubleType())])
