"""Token counts of a unigram tokenizer by a count-only Viterbi pass.

The text is cut at spaces, each space leading the word that follows it as
``SPACE_MARK`` (one is put before a text that has none there).  Within a word an Aho-Corasick automaton
enumerates every vocabulary piece; dynamic programming over positions carries
the best score and the number of pieces of the best path, no path itself.

Tie rules of the public ``tokenizers`` library's unigram model: of equal scores the
piece that starts first (the longest) stays; a character without a piece of its
own costs the lowest score less 10; neighbouring unknown characters are one
token, or, with byte fallback, one token a byte.  Scores are double precision.

The vocabulary is read on the driver from a model file (its path is a
parameter), is bounded by ``MAX_VOCABULARY`` pieces and travels with the tasks.
Counts of words seen before are kept in each task, up to ``CACHE_WORDS`` of at most
``LONG_WORD`` characters.  In a longer word (a text without a space is one word) no piece
reaches back further than the longest piece, so scores and counts are held for that many
positions: memory follows the vocabulary, not the word.  Neither changes a result.

Nulls and empty texts: no tokens.  Repeated rows count alike.  An empty table
gives an empty result.  Extra columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import inf

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .common import whole_text

DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MAX_VOCABULARY = 1_000_000
CACHE_WORDS = 1_000_000
#: Longer words are not kept, and their scores are held for the last piece's length only.
LONG_WORD = 1_024
SPACE_MARK = "▁"
UNKNOWN_PENALTY = 10.0


def load_vocabulary(path: str = DEFAULT_MODEL) -> tuple[list[tuple[str, float]], int]:
    """(piece, score) in id order, and the id of the unknown piece."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]
    return pieces, model.unk_id()


class UnigramCounter:
    """Counts the pieces of words under a unigram vocabulary."""

    def __init__(self, vocabulary: list[tuple[str, float]], byte_fallback: bool = True):
        if len(vocabulary) > MAX_VOCABULARY:
            raise ValueError(f"a vocabulary has at most {MAX_VOCABULARY} pieces")
        self.vocabulary = vocabulary
        pieces = {p for p, _ in vocabulary}
        self.byte_fallback = byte_fallback and all(f"<0x{b:02X}>" in pieces for b in range(256))
        self.unknown = min(s for _, s in vocabulary) - UNKNOWN_PENALTY
        self.automaton = None
        self.known: dict[str, int] = {}

    def __getstate__(self):
        return {**self.__dict__, "automaton": None, "known": {}}

    def _build(self):
        self.automaton = ahocorasick.Automaton()
        for piece, score in self.vocabulary:
            if piece:  # of equal pieces the last counts, as in a map
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()

    def word(self, word: str) -> int:
        """Pieces of one word (no space inside)."""
        count = self.known.get(word)
        if count is None:
            if len(word) > LONG_WORD:
                return self._viterbi_long(word)
            if len(self.known) >= CACHE_WORDS:
                self.known.clear()
            count = self.known[word] = self._viterbi(word)
        return count

    def _viterbi(self, word: str) -> int:
        if self.automaton is None:
            self._build()
        size = len(word)
        best = [0.0] + [-inf] * size
        pieces = [0] * (size + 1)
        odd = None  # ends whose best path closes with an unknown character

        def close(end: int) -> None:
            """The unknown character competes last for an end without a piece of one character."""
            nonlocal odd
            other = best[end - 1] + self.unknown
            if other > best[end]:
                odd = odd or set()
                best[end] = other
                if self.byte_fallback:
                    pieces[end] = pieces[end - 1] + len(word[end - 1].encode())
                else:
                    pieces[end] = pieces[end - 1] + (end - 1 not in odd)
                odd.add(end)

        now, single = 0, True
        for last, (length, value) in self.automaton.iter(word):
            if last >= now:
                if not single:
                    close(now)
                for end in range(now + 1, last + 1):
                    close(end)
                now, single = last + 1, False
            # matches of one end come longest first: the earliest start stays
            candidate = best[now - length] + value
            if candidate > best[now]:
                best[now] = candidate
                pieces[now] = pieces[now - length] + 1
            if length == 1:
                single = True
        if not single:
            close(now)
        for end in range(now + 1, size + 1):
            close(end)
        return pieces[size]

    def _viterbi_long(self, word: str) -> int:
        """As ``_viterbi``, with places for the last positions only."""
        if self.automaton is None:
            self._build()
        ring = max((len(p) for p, _ in self.vocabulary), default=1) + 2
        best, pieces, odd = [-inf] * ring, [0] * ring, [False] * ring
        best[0] = 0.0

        def open_(end: int) -> None:
            """No path leads to ``end`` yet."""
            best[end % ring], odd[end % ring] = -inf, False

        def close(end: int) -> None:
            at, before = end % ring, (end - 1) % ring
            other = best[before] + self.unknown
            if other > best[at]:
                best[at] = other
                if self.byte_fallback:
                    pieces[at] = pieces[before] + len(word[end - 1].encode())
                else:
                    pieces[at] = pieces[before] + (not odd[before])
                odd[at] = True

        now, single = 0, True
        for last, (length, value) in self.automaton.iter(word):
            if last >= now:
                if not single:
                    close(now)
                for end in range(now + 1, last + 1):
                    open_(end)
                    close(end)
                now, single = last + 1, False
                open_(now)
            start, at = (now - length) % ring, now % ring
            candidate = best[start] + value
            if candidate > best[at]:
                best[at] = candidate
                pieces[at] = pieces[start] + 1
            if length == 1:
                single = True
        if not single:
            close(now)
        for end in range(now + 1, len(word) + 1):
            open_(end)
            close(end)
        return pieces[len(word) % ring]

    def text(self, text: str) -> int:
        """Pieces of a whole text."""
        if not text:
            return 0
        word, known = self.word, self.known
        total = 0
        parts = text.replace(SPACE_MARK, " ").split(" ")
        if not parts[0]:
            del parts[0]  # a text that starts with a space gets no second one
        for w in parts:
            w = SPACE_MARK + w
            n = known.get(w)
            total += word(w) if n is None else n
        return total


def token_count(counter: UnigramCounter, text_col: str = "text") -> Column:
    """Column expression: number of tokens of the text."""

    @arrow_udf("long")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            yield pa.array([counter.text(t) for t in column.to_pylist()], type=pa.int64())

    return run(whole_text(text_col))


def count_tokens(docs: DataFrame, counter: UnigramCounter, text_col: str = "text",
                 output: str = "n_tokens") -> DataFrame:
    """``docs`` with the token count of each text."""
    return docs.withColumn(output, token_count(counter, text_col))
