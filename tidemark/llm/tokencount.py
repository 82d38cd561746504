"""Count-only Viterbi token counts of a unigram tokenizer.

An Aho-Corasick automaton over the vocabulary names every piece that ends at
each character; dynamic programming carries the best score of each prefix and
its number of pieces, and nothing else: no back pointers, no pieces.  Tie rules
are the tokenizer's: of two equal scores the earlier start (the longer last
piece) wins; a character that is no piece costs the lowest score less 10 and,
with byte fallback, counts one token per UTF-8 byte; without it, neighbouring
unknown characters are one token.

A space is written as the mark U+2581 and each text starts with one.  No piece
has the mark behind another character except in runs of marks, so the best path
of a text is the chain of the best paths of its marked words: a word is solved
once per task and its count is summed.  Scores are held as doubles; where they
are whole numbers, sums are exact and ties are true ties.

Defined cases: null and empty texts have 0 tokens; repeated rows each get their
row.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .textmap import WordTable, map_texts, segment_sums

MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: A run of marks and what follows up to the next mark.
_WORD = re.compile(f"{MARK}+[^{MARK}]*|^[^{MARK}]+")


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with scores.  ``byte_fallback`` tells whether all byte pieces
    are there; ``specials`` can't be matched in a text."""
    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    byte_fallback: bool
    specials: frozenset[str] = frozenset()

    @property
    def lowest(self) -> float:
        return min(self.scores, default=0.0)


def load_sentencepiece(path: str) -> Vocabulary:
    """Pieces and scores of a sentencepiece file, as a unigram vocabulary."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    pieces = tuple(sp.id_to_piece(i) for i in range(n))
    special = frozenset(pieces[i] for i in range(n)
                        if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))
    return Vocabulary(pieces, tuple(float(sp.get_score(i)) for i in range(n)),
                      any(sp.is_byte(i) for i in range(n)), special)


def _splits_at_mark(vocab: Vocabulary) -> bool:
    return not any(re.search(f"[^{MARK}]{MARK}", p) for p in vocab.pieces)


def word_counter(vocab: Vocabulary):
    """Tokens of one marked word."""
    import ahocorasick

    machine = ahocorasick.Automaton()
    for piece, score in zip(vocab.pieces, vocab.scores):
        if piece and piece not in vocab.specials:
            machine.add_word(piece, (len(piece), score))
    machine.make_automaton()
    unknown = vocab.lowest - UNKNOWN_PENALTY
    fallback = vocab.byte_fallback

    def count(word: str) -> int:
        n = len(word)
        ends: list[list] = [[] for _ in range(n)]
        for end, found in machine.iter(word):
            ends[end].append(found)
        best, pieces = [0.0] * (n + 1), [0] * (n + 1)
        fused = [False] * (n + 1)  # the last piece is unknown (no fallback)
        for end in range(1, n + 1):
            # longest pieces first: they start earliest and win ties
            top, at, single = None, 0, False
            for length, score in sorted(ends[end - 1], reverse=True):
                value = best[end - length] + score
                single = single or length == 1
                if top is None or value > top:
                    top, at = value, end - length
            lone = best[end - 1] + unknown
            if not single and (top is None or lone > top):
                best[end] = lone
                if fallback:
                    pieces[end] = pieces[end - 1] + len(word[end - 1].encode("utf-8"))
                else:
                    pieces[end] = pieces[end - 1] + (not fused[end - 1])
                    fused[end] = True
            else:
                best[end], pieces[end] = top, pieces[at] + 1
        return pieces[n]

    return count


def counter(vocab: Vocabulary):
    """Batch function: texts to token counts."""
    if not _splits_at_mark(vocab):
        raise ValueError("a piece has the space mark behind another character")

    def make():
        count = word_counter(vocab)

        def build(words: list) -> tuple:
            return (np.fromiter(map(count, words), np.int64, len(words)),)

        table = WordTable(build)

        def run(texts: list) -> tuple:
            split = []
            for t in texts:
                if not t:
                    split.append(())
                elif MARK in t or "  " in t or t[0] == " " or t[-1] == " ":
                    split.append(_WORD.findall(MARK + t.replace(" ", MARK)))
                else:  # single spaces only: each part is one marked word
                    split.append(t.split(" "))
            lens = np.fromiter(map(len, split), np.int64, len(split))
            words = [w if w[0] == MARK else MARK + w for s in split for w in s]
            if not words:
                return (np.zeros(len(texts), np.int64),)
            at = table.lookup(words)
            return (segment_sums(table.cols[0][at], lens).astype(np.int64),)

        return run

    return make


def count_tokens(docs: DataFrame, vocab: Vocabulary, text: str = "text") -> DataFrame:
    """``row`` (the input row) and ``n_tokens`` per input row."""
    return map_texts(docs, counter(vocab), [T.StructField("n_tokens", T.LongType())], text=text)
