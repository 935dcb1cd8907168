"""Token counts by a count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton lists the vocabulary pieces that end at each code point; dynamic programming keeps, for each end, the best score and the
number of tokens of the best path, and no path. The tie rules are the tokenizer's: of equal scores the earliest start wins (a later path must be
strictly better); a code point without a piece of its own may also be unknown, at the least score of the vocabulary less 10, and counts as its UTF-8 bytes.

Spaces become the word mark; a text starts with a mark of its own unless it starts with one; each mark starts a new stretch, and no piece crosses
into another stretch. So a text's count is the sum of its stretches', and a worker remembers those it has counted, up to a bound.

The vocabulary is read from a sentencepiece model file. Its unknown, control and byte pieces stand for no text: strings that look like them ("<s>", "<0x0A>")
are ordinary text. The others stand in order of frequency, and the score of the piece in place r of the file (from 0) is -ln(r + 1) (Zipf's law): the file carries
no probabilities, and tokenizers are not trained here. Nulls and empty texts have no tokens and score 0.
"""

from __future__ import annotations

import math
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from twinframe.llm.common import map_slices

MARK = "▁"
UNKNOWN_PENALTY = 10.0
CACHE_ENTRIES = 400_000
CACHED_CHARS = 48


def vocabulary(model_file: str) -> list[tuple[str, float]]:
    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    special = lambda i: model.is_unknown(i) or model.is_control(i) or model.is_byte(i) or model.is_unused(i)
    return [(model.id_to_piece(i), -math.log(i + 1)) for i in range(model.get_piece_size()) if not special(i)]


class Counter:
    def __init__(self, pieces: list[tuple[str, float]]):
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(score for _, score in pieces) - UNKNOWN_PENALTY
        self.known: dict[str, tuple[int, float]] = {}

    def stretch(self, s: str) -> tuple[int, float]:
        """Tokens and score of the best path through one stretch."""
        n = len(s)
        score, count = [0.0] * (n + 1), [0] * (n + 1)
        done = 0  # ends up to here are settled

        def settle(upto: int) -> None:
            # ends at which no piece ends have the unknown code point only
            for e in range(done + 1, upto + 1):
                score[e] = score[e - 1] + self.unknown
                count[e] = count[e - 1] + len(s[e - 1].encode())

        at, best, tokens, single = -1, None, 0, False
        for last, (size, own) in self.automaton.iter(s):
            if last != at:
                if at >= 0:
                    self._close(s, at + 1, best, tokens, single, score, count)
                    done = at + 1
                settle(last)
                done = last
                at, best, tokens, single = last, None, 0, False
            start = last + 1 - size
            found = score[start] + own
            if best is None or found > best:
                best, tokens = found, count[start] + 1
            single = single or size == 1
        if at >= 0:
            self._close(s, at + 1, best, tokens, single, score, count)
            done = at + 1
        settle(n)
        return count[n], score[n]

    def _close(self, s: str, end: int, best: float, tokens: int, single: bool, score: list[float], count: list[int]) -> None:
        if not single:
            found = score[end - 1] + self.unknown
            if found > best:
                best, tokens = found, count[end - 1] + len(s[end - 1].encode())
        score[end], count[end] = best, tokens

    def __call__(self, text: str | None) -> tuple[int, int, float]:
        """Stretches, tokens and score of a text."""
        if not text:
            return 0, 0, 0.0
        marked = text.replace(" ", MARK)
        parts = (marked[1:] if marked[0] == MARK else marked).split(MARK)
        known, total, value = self.known, 0, 0.0
        for part in parts:
            got = known.get(part)
            if got is None:
                got = self.stretch(MARK + part)
                if len(part) <= CACHED_CHARS:
                    if len(known) >= CACHE_ENTRIES:
                        known.clear()
                    known[part] = got
            total += got[0]
            value += got[1]
        return len(parts), total, value


@lru_cache(maxsize=2)
def counter(model_file: str) -> Counter:
    return Counter(vocabulary(model_file))


def count(docs: DataFrame, model_file: str) -> DataFrame:
    """doc_id, n_stretches, n_tokens and score of every row of docs; nothing is shuffled."""

    def step(rows: pa.RecordBatch) -> pa.RecordBatch:
        own = counter(model_file)
        got = [own(t) for t in rows.column(1).to_pylist()]
        return pa.record_batch([rows.column(0), *(pa.array([g[k] for g in got], kind) for k, kind in enumerate((pa.int64(), pa.int64(), pa.float64())))], ["doc_id", "n_stretches", "n_tokens", "score"])

    return map_slices(docs, ["doc_id", "text"], step, "doc_id long, n_stretches long, n_tokens long, score double")
