"""Quality rules, line first: lines that fail a rule go, then documents that lose too much go."""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StringType, StructField

from sensorloom.llm.common import WORD, per_text

_WORD = re.compile(WORD)
_SYMBOL = re.compile(r"[#*$%&|<>]")
#: Documents with fewer words, or of whose words more than this share stands in repeated windows, fail outright.
LEAST_WORDS = 50
MOST_REPEATED = 50
#: A document goes when more than this share, in percent, of its words stood in lines that failed.
MOST_LOST = 50
#: Percent of a line's words that may be marked up, and that may be separators.
MOST_MARKED = 30
MOST_SEPARATORS = 20

# Fixed values of the line rules. The patterns are plain enough to mean the same to every engine.
MARKED = r"[!?#*$%&<>~^=_]{2}[.,;:]?(?:$|[\x20\x09-\x0D])"
SEPARATOR = r"(?:^|[\x20\x09-\x0D])[|>/*•·»›–-]+(?:$|[\x20\x09-\x0D])"
BOILERPLATE = (
    "all rights reserved", "terms of use", "terms of service", "privacy policy", "cookie policy", "accept cookies",
    "use cookies", "enable javascript", "javascript is disabled", "sign up for our newsletter",
    "subscribe to our newsletter", "click here to", "read more", "skip to content", "back to top", "share this",
    "lorem ipsum", "licensed under", "released under the",
)
MOST_BOILERPLATE_WORDS = 30
_ODD = re.compile(r"[!?#*$%&<>~^=_]{2}|[|>/*•·»›–-]")
_MARKED = re.compile(MARKED)
_SEPARATOR = re.compile(SEPARATOR)
_BOILERPLATE = re.compile("|".join(map(re.escape, BOILERPLATE)))


def line_fails(line: str, n_words: int) -> bool:
    """Whether a line with ``n_words`` words fails a rule.

    Punctuation: too many of its words end in runs of marks. Navigation: too many separators.
    Boilerplate: a short line with a stock phrase.
    """
    if _ODD.search(line):
        if 100 * len(_MARKED.findall(line)) > MOST_MARKED * n_words:
            return True
        # Neighbouring separators share the space between them, so the spaces are doubled first.
        separators = len(_SEPARATOR.findall(re.sub(r"[\x20\x09-\x0D]", "  ", line)))
        if separators > 1 and 100 * separators > MOST_SEPARATORS * n_words:
            return True
    return n_words <= MOST_BOILERPLATE_WORDS and bool(_BOILERPLATE.search(line.lower()))


def repeated_words(words: list[str]) -> int:
    """How many words stand in a window of three words that the text has twice or more."""
    if len(words) < 4:
        return 0
    ids: dict[str, int] = {}
    code = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    if len(ids) == len(words):
        return 0
    _, pairs = np.unique(code[:-1] * len(ids) + code[1:], return_inverse=True)
    _, window, times = np.unique(pairs[:-1] * len(ids) + code[2:], return_inverse=True, return_counts=True)
    hit = times[window] > 1
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[k : k + len(hit)] |= hit
    return int(covered.sum())


def judge(text: str) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, failed lines)."""
    words = _WORD.findall(text)
    n_words, seen, n_dup, lost, failed = len(words), set(), 0, 0, []
    for number, line in enumerate(text.split("\n")):
        in_line = len(_WORD.findall(line))
        if in_line:
            n_dup += line in seen
            seen.add(line)
            if line_fails(line, in_line):
                lost += in_line
                failed.append(number)
    repeated = repeated_words(words)
    base_failed = n_words < LEAST_WORDS or 100 * repeated > MOST_REPEATED * n_words
    kept = not base_failed and 100 * lost <= MOST_LOST * n_words
    return n_words, sum(map(len, words)), len(_SYMBOL.findall(text)), n_dup, repeated, base_failed, kept, failed


FIELDS = [
    *[StructField(c, LongType()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
    StructField("base_failed", BooleanType()), StructField("kept", BooleanType()),
    StructField("failed_lines", ArrayType(IntegerType())),
]


def quality(docs: DataFrame) -> DataFrame:
    """Each document's counts, ``base_failed``, ``kept``, and the numbers of its ``failed_lines`` from 0.

    A null or empty text has no words: all counts 0, failed, not kept. Equal rows are judged alike and
    each returned; an empty table gives no rows. Other columns are ignored.
    """
    return per_text(docs, ["doc_id"], "text", FIELDS, judge)


def without(text: str, failed: list[int]) -> str:
    """``text`` without the lines numbered in ``failed``."""
    gone = set(failed)
    return "\n".join(line for number, line in enumerate(text.split("\n")) if number not in gone)


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose documents are kept, their texts without the lines that failed.

    ``n_chars``, if there is one, is counted anew where lines went; a document without failed lines stays
    as it was. The text goes through the judgement beside the row, so nothing is joined or shuffled.
    Texts may be null (not kept); any further columns are carried along.
    """

    def clean(text: str) -> tuple:
        *_, kept, failed = judge(text)
        return kept, without(text, failed) if kept and failed else None

    fields = [StructField("_kept", BooleanType()), StructField("_clean", StringType())]
    named = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    text = f"c{docs.columns.index('text')}"
    judged = per_text(named, named.columns, text, fields, clean).filter("_kept")
    new = {text: F.coalesce("_clean", text)}
    if "n_chars" in docs.columns:
        counted = f"c{docs.columns.index('n_chars')}"
        n_chars = F.length("_clean").cast(docs.schema["n_chars"].dataType)
        new[counted] = F.when(F.col("_clean").isNull(), F.col(counted)).otherwise(n_chars)
    return judged.select(*[new.get(c, F.col(c)).alias(c) for c in named.columns]).toDF(*docs.columns)
