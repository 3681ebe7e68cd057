"""Token counts: count-only Viterbi over a scored piece vocabulary.

An Aho-Corasick automaton over the pieces lists every piece that ends at each
character; dynamic programming carries, per position, the best score and the
number of pieces on its path, and nothing to walk back.  Ties follow the
unigram tokenizer exactly: of equal scores the earliest start (longest piece)
wins; a character that is no piece costs the lowest score less 10, and stands
for its UTF-8 bytes where the vocabulary has byte pieces, else neighbouring
unknown characters are one token.

White space becomes the vocabulary's mark and a text starts with one.  Where no
piece holds a mark after another character, no path crosses the place before
a mark, nor either side of a character that is in no piece; with whole-number
scores (sums are exact) a text's count is then the sum over its parts, and a
task remembers the counts of parts it has met.  Otherwise whole texts are run.

Cases: null and empty texts have 0 tokens; a text of any length is run whole;
equal rows count alike; no rows give no rows; extra columns pass through.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
UNKNOWN = 10.0
CACHE = 400_000
VOCABULARY = os.path.join(os.environ.get("TOKENIZERS_DIR", "/opt/tokenizers"), "piece_bpe_32k.model")


@dataclass
class Vocabulary:
    pieces: list[tuple[str, float]]      # pieces that match text
    lowest: float                        # lowest score of any entry
    bytes_known: bool                    # all 256 byte pieces are there


def load(path: str = VOCABULARY) -> Vocabulary:
    """Scored pieces of a SentencePiece model file."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(sp.get_piece_size())
    text = [i for i in ids if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
    return Vocabulary([(sp.id_to_piece(i), sp.get_score(i)) for i in text],
                      min(sp.get_score(i) for i in ids), sum(map(sp.is_byte, ids)) == 256)


class Counter(dict):
    """Tokens of a part of a text, remembered up to a bound."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.auto = ahocorasick.Automaton()
        for piece, score in vocabulary.pieces:
            self.auto.add_word(piece, (len(piece), score))
        self.auto.make_automaton()
        self.single = {p for p, _ in vocabulary.pieces if len(p) == 1}
        chars = {c for p, _ in vocabulary.pieces for c in p}
        whole = all(s == int(s) for _, s in vocabulary.pieces) and vocabulary.lowest == int(vocabulary.lowest)
        crossed = any(MARK in p.lstrip(MARK) for p, _ in vocabulary.pieces)
        self.parts = None
        if whole and not crossed and vocabulary.bytes_known:
            known = "".join(map(re.escape, sorted(chars - {MARK})))
            self.parts = re.compile(f"{MARK}*[{known}]+|{MARK}+|[^{known}{MARK}]+")

    def __missing__(self, part: str) -> int:
        if len(self) >= CACHE:
            self.clear()
        self[part] = n = self.viterbi(part)
        return n

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        text = MARK + text.replace(" ", MARK)
        if self.parts is None:
            return self.viterbi(text)
        return sum(map(self.__getitem__, self.parts.findall(text)))

    def viterbi(self, text: str) -> int:
        n, low = len(text), self.vocabulary.lowest - UNKNOWN
        best, count, unknown = [-np.inf] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        best[0], at = 0.0, 1
        byte = self.vocabulary.bytes_known

        def miss(upto: int) -> None:                  # characters that are no piece
            nonlocal at
            while at <= upto:
                c = text[at - 1]
                if c not in self.single and best[at - 1] + low > best[at]:
                    best[at], unknown[at] = best[at - 1] + low, True
                    count[at] = count[at - 1] + (len(c.encode("utf-8", "surrogatepass")) if byte else not unknown[at - 1])
                at += 1

        for end, (size, score) in self.auto.iter(text):
            miss(end)
            e, s = end + 1, end + 1 - size
            # hits of one end come longest first, so an equal score keeps the earlier start
            if best[s] + score > best[e]:
                best[e], count[e], unknown[e] = best[s] + score, count[s] + 1, False
        miss(n)
        return count[n]


def with_tokens(docs: DataFrame, vocabulary: Vocabulary, out: str = "n_tokens") -> DataFrame:
    """``docs`` with the number of tokens of each text."""
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = Counter(vocabulary)
        for texts in parts:
            yield pd.Series([counter.count(t) for t in texts], dtype="int64")

    return docs.withColumn(out, F.pandas_udf(run, "long", F.PandasUDFType.SCALAR_ITER)(F.col("text").cast("string")))
