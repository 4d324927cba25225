"""Token counts by a count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton lists every piece that ends at each character of a segment; dynamic
programming keeps, for each end, the best score and the number of pieces on that path, and nothing
else: no pieces are ever written out. The rules are those of the public unigram tokenizers: the
text gets a blank in front (unless empty) and blanks become U+2581; a character without a piece of
its own costs the worst score less 10 and counts as its UTF-8 bytes; of equal scores, the path
whose last piece starts first stays.

The vocabulary is the given piece file's; that file holds merge ranks, not probabilities, so a
piece's log-probability is set by Zipf's law from its rank, in steps of 2**-10. Sums of such steps
are exact in any order, so a text's result is the sum over segments that no piece can reach over
(a piece has blanks only in front), and each worker keeps the results of segments it has met.
"""
from __future__ import annotations

import math
from functools import lru_cache

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from latticeguard.llm.common import free_name

PIECES = "piece_bpe_32k.model"
BLANK = "▁"
#: Steps of a score to one unit of log-probability, and the cost of an unknown character in units.
STEPS = 1 << 10
UNKNOWN_PENALTY = 10
#: Segments a worker remembers before it starts anew, and the longest that it remembers.
REMEMBERED = 800_000
LONGEST = 64
_SHIFT = 40


def unigram_scores(pieces: str = PIECES) -> dict[str, int]:
    """Score, in steps, of every ordinary piece of a file: Zipf's law over the rank by the file's own order."""
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(pieces))
    ids = [i for i in range(model.get_piece_size()) if not (
        model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    ids.sort(key=lambda i: (-model.get_score(i), i))
    return {model.id_to_piece(i): -round(STEPS * math.log(rank + 2)) for rank, i in enumerate(ids)}


class Counter:
    """Counts pieces; `known` maps a segment without its first blank to its packed result."""

    def __init__(self, scores: dict[str, int]):
        if any(BLANK in piece.lstrip(BLANK) for piece in scores):
            raise ValueError("a piece has a blank behind its front: segments would not be independent")
        self.automaton = ahocorasick.Automaton()
        for piece, score in scores.items():
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.single = {piece for piece in scores if len(piece) == 1}
        self.unknown = min(scores.values()) - UNKNOWN_PENALTY * STEPS
        self.known: dict[str, int] = {}

    def viterbi(self, segment: str) -> tuple[int, int]:
        """(score in steps, pieces) of the best path through a segment."""
        scores, counts = [0], [0]
        matches = self.automaton.iter(segment)
        end, found = next(matches, (-1, None))
        for at, char in enumerate(segment):
            best = count = None
            while end == at:  # longest first, so the earliest start keeps ties
                length, score = found
                score += scores[at + 1 - length]
                if best is None or score > best:
                    best, count = score, counts[at + 1 - length] + 1
                end, found = next(matches, (-1, None))
            if char not in self.single:
                score = scores[at] + self.unknown
                if best is None or score > best:
                    best, count = score, counts[at] + len(char.encode())
            scores.append(best)
            counts.append(count)
        return scores[-1], counts[-1]

    def _packed(self, tail: str) -> int:
        score, count = self.viterbi(BLANK + tail)
        packed = -score << _SHIFT | count
        if len(tail) <= LONGEST:
            self.known[tail] = packed
        return packed

    def count(self, text: str | None) -> tuple[int, int]:
        """(score in steps, pieces) of a text; (0, 0) if it is null or empty."""
        if not text:
            return 0, 0
        tails = text.replace(BLANK, " ").split(" ")
        if "" in tails:
            tails = _joined(tails)
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        total = 0
        try:
            total = sum(map(known.__getitem__, tails))
        except KeyError:
            for tail in tails:
                packed = known.get(tail)
                total += self._packed(tail) if packed is None else packed
        return -(total >> _SHIFT), total & ((1 << _SHIFT) - 1)


def _joined(tails: list[str]) -> list[str]:
    """Runs of blanks, which empty tails stand for, put in front of what follows them."""
    out, blanks = [], 0
    for tail in tails:
        if tail:
            out.append(BLANK * blanks + tail)
            blanks = 0
        else:
            blanks += 1
    if blanks:
        out.append(BLANK * (blanks - 1))
    return out


@lru_cache(maxsize=2)
def counter(pieces: str = PIECES) -> Counter:
    """One counter per worker process."""
    return Counter(unigram_scores(pieces))


_RESULT = T.StructType([T.StructField("n", T.LongType()), T.StructField("score", T.DoubleType())])


def count_tokens(docs: DataFrame, text: str = "text", pieces: str = PIECES) -> DataFrame:
    """`docs` with n_tokens and token_score (the best path's log-probability).

    Null and empty text has no token and score 0. Texts of any length are counted whole; repeated
    rows get equal results; an empty table gives no rows. New columns get an underscore in front
    where `docs` has their name already.
    """

    @F.arrow_udf(_RESULT)
    def counted(column: pa.Array) -> pa.Array:
        each = [counter(pieces).count(t.as_py()) for t in column]
        scores, counts = np.array(each, np.int64).reshape(-1, 2).T
        return pa.StructArray.from_arrays([pa.array(counts), pa.array(scores / STEPS)], ["n", "score"])

    out, n, score = (free_name(docs, c) for c in ("counted", "n_tokens", "token_score"))
    return docs.withColumn(out, counted(F.col(text))).select(
        *(F.col(f"`{c}`") for c in docs.columns), F.col(f"{out}.n").alias(n), F.col(f"{out}.score").alias(score))
