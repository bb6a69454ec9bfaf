"""Token counts of a unigram tokenizer, without the tokens.

Words are split off at white space and marked with a leading ``▁``. An Aho-Corasick automaton finds
every vocabulary piece in a word; dynamic programming over the places keeps the best score and, on
that path, the number of pieces. Nothing of the path itself is kept.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from sensorloom.llm.common import SLICE

#: Where a vocabulary is, unless a caller names another.
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
#: What the score of an unknown character lies below that of the worst piece.
UNKNOWN_PENALTY = 10.0
MARK = "▁"
#: Words whose counts a task remembers, and the longest of them.
REMEMBERED = 1 << 19
LONGEST_REMEMBERED = 40
#: The characters with the Unicode property White_Space.
_WORD = re.compile("[^\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")


def vocabulary(path: str = VOCABULARY) -> list[tuple[str, float]]:
    """The pieces of a sentence-piece model file by id, with the logarithm of 1 / rank as score.

    The file's own scores are ranks, whose sums would always prefer few frequent-ranked pieces by
    units that are not probabilities; a share that falls with the rank is the usual stand-in. Pieces of
    text come first in the ranks, then the bytes and the pieces that stand for no text, whose ids are the lowest.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    ranked = sorted(ids, key=lambda i: (model.is_byte(i) or model.is_control(i) or model.is_unknown(i), i))
    score = {i: -math.log(rank) for rank, i in enumerate(ranked, 1)}
    return [(model.id_to_piece(i), score[i]) for i in ids]


class Counter:
    """Counts the pieces of words. Ties go to the longer last piece, unknown characters count their bytes.

    ``byte_pieces`` says whether the vocabulary has a piece for every byte; without them a run of unknown
    characters is one piece.
    """

    def __init__(self, pieces: Sequence[tuple[str, float]]):
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min((score for _, score in pieces), default=0.0) - UNKNOWN_PENALTY
        known = {piece for piece, _ in pieces}
        self.byte_pieces = all(f"<0x{b:02X}>" in known for b in range(256))
        self.seen: dict[str, tuple[int, float]] = {}

    def word(self, marked: str) -> tuple[int, float]:
        """(pieces, score) of one marked word."""
        n = len(marked)
        ending: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
        if len(self.automaton):
            for end, found in self.automaton.iter(marked):
                ending[end + 1].append(found)  # for one end the longest comes first
        scores, counts, unknown = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        for end in range(1, n + 1):
            best, start, single = -math.inf, -1, False
            for length, score in ending[end]:
                value = score + scores[end - length]
                if value > best:
                    best, start = value, end - length
                single = length == 1
            if single or not (value := scores[end - 1] + self.unknown) > best:
                counts[end] = counts[start] + 1
            else:
                best, unknown[end] = value, True
                if self.byte_pieces:
                    more = len(marked[end - 1].encode("utf-8", "surrogatepass"))
                else:
                    more = not unknown[end - 1]
                counts[end] = counts[end - 1] + more
            scores[end] = best
        return counts[n], scores[n]

    def text(self, text: str) -> tuple[int, float]:
        total, score, seen = 0, 0.0, self.seen
        for word in _WORD.findall(text):
            found = seen.get(word)
            if found is None:
                found = self.word(MARK + word)
                if len(word) <= LONGEST_REMEMBERED:
                    if len(seen) >= REMEMBERED:
                        seen.clear()
                    seen[word] = found
            total += found[0]
            score += found[1]
        return total, score


def count_tokens(docs: DataFrame, pieces: Sequence[tuple[str, float]]) -> DataFrame:
    """``doc_id``, ``n_tokens`` and the best segmentation's ``score`` for every document.

    The vocabulary, which does not grow with the data, goes to every executor once. A null or blank
    text has no tokens and score 0. Equal rows are each returned; an empty table gives no rows. Other
    columns are ignored.
    """
    sent = docs.sparkSession.sparkContext.broadcast(list(pieces))
    kind = StructType([docs.schema["doc_id"], StructField("n_tokens", LongType()), StructField("score", DoubleType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(sent.value)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                counted = [counter.text(t or "") for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([n for n, _ in counted], pa.int64()), pa.array([s for _, s in counted], pa.float64())], kind.names)

    return docs.select("doc_id", "text").mapInArrow(count, kind)
