"""Toxic passages by maximum-scoring segments of token log-odds.

Labelled documents give each token (a word, or the first letters of one) its log-odds of standing in a
toxic text, under a Dirichlet prior in proportion to the token's share of all of them. A text is
scanned once; every maximal run of tokens whose scores outweigh those around it is a passage. The best
passage of a clean text follows an extreme-value law, which says how far a text's own is out of reach.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructField, StructType

from sensorloom.llm.common import SLICE, whole
from sensorloom.session import written

#: Labelled documents that the model is fitted on, at most.
FIT_DOCUMENTS = 200_000
#: Pseudo-counts of the prior, and what a token needs to count: toxic documents, and the likelihood
#: ratio (twice its logarithm) against a token that does not tell the labels apart.
PRIOR = 2000.0
LEAST_DOCUMENTS = 4
LEAST_RATIO = 20.0
LEAST_ODDS = 0.3
#: Letters of a word's beginnings that are tokens beside the word.
STEMS = (4, 5, 6, 7)
#: What each token without odds takes off a passage's score.
DRIFT = 0.05
#: Score in bits-like units a passage needs to be reported, before calibration.
LEAST_PASSAGE = 3.0
#: A document counts as toxic from this score on.
DECISION = 0.3
_WORD = re.compile(r"[^\W\d_]+")
#: What Java calls a letter is what ``_WORD`` matches.
_NOT_LETTER = r"[^\p{L}]+"


class Model(NamedTuple):
    odds: dict[str, float]
    drift: float
    location: float
    scale: float
    weights: tuple[float, float, float]


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document's labels are kept from the model. A null ``doc_id`` is never labelled, and not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def tokens_of(word: str) -> list[str]:
    return [f"={word}", *(f"^{word[:k]}" for k in STEMS if len(word) >= k)]


def token_odds(training: DataFrame) -> dict[str, float]:
    """The odds of the tokens that tell toxic (``label`` 1) from clean documents; ``training`` has ``text``, ``label``.

    Each document counts a token once. At most ``FIT_DOCUMENTS`` documents with a mean of ``m`` distinct
    words have fewer than ``5 m FIT_DOCUMENTS / LEAST_DOCUMENTS`` such tokens, so the table is bounded.
    """
    words = F.array_distinct(F.split(F.lower(whole()), _NOT_LETTER))
    spread = training.select("label", F.explode(F.filter(words, lambda w: w != "")).alias("word"))
    by_word = spread.groupBy("word").agg(F.sum("label").alias("toxic"), F.count("*").alias("all"))
    sums = by_word.agg(F.sum("toxic"), F.sum("all")).first()
    toxic_total, total = float(sums[0] or 0), float(sums[1] or 0)
    if not 0 < toxic_total < total:
        return {}
    clean_total = total - toxic_total
    stems = [F.when(F.length("word") >= k, F.concat(F.lit("^"), F.substring("word", 1, k))) for k in STEMS]
    made = F.explode(F.array_compact(F.array(F.concat(F.lit("="), "word"), *stems)))
    # A document with several words of one stem counts the stem as often.
    tokens = by_word.select(made.alias("token"), "toxic", "all").groupBy("token").agg(F.sum("toxic").alias("a"), F.sum("all").alias("n"))
    a, n = F.col("a").cast("double"), F.col("n").cast("double")
    b, share = n - a, n / total
    odds = F.log((a + PRIOR * share) / (toxic_total + PRIOR - a - PRIOR * share)) - F.log((b + PRIOR * share) / (clean_total + PRIOR - b - PRIOR * share))
    ratio = 2 * (a * F.log(a / (share * toxic_total)) + F.when(b > 0, b * F.log(b / (share * clean_total))).otherwise(0.0))
    telling = tokens.filter(a >= LEAST_DOCUMENTS).select("token", odds.alias("odds"), ratio.alias("ratio"))
    telling = telling.filter((F.col("ratio") >= LEAST_RATIO) & (F.col("odds") > LEAST_ODDS))
    return {row.token: row.odds for row in telling.select("token", "odds").collect()}


def segments(scores: Sequence[tuple[int, float]], length: int, drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first token, last token, score), in order, in linear time.

    ``scores`` has place and odds of the tokens that have any; each of the others takes off ``drift``.
    """
    # The list method for all maximal segments: each candidate with the totals to its left and right ends.
    found: list[tuple[int, int, float, float]] = []
    total, last = 0.0, -1
    for place, odds in scores:
        total -= drift * (place - last - 1)
        last = place
        left, total = total, total + odds
        first, right = place, total
        while found:
            k = len(found) - 1
            while k >= 0 and found[k][2] >= left:
                k -= 1
            if k < 0 or found[k][3] >= right:
                break
            first, left = found[k][0], found[k][2]
            del found[k:]
        found.append((first, place, left, right))
    return [(first, end, right - left) for first, end, left, right in found]


def scan(text: str, odds: dict[str, float], drift: float, seen: dict[str, float]) -> tuple[int, list[tuple[int, int, float]]]:
    """Number of tokens, and the maximal segments by token places."""
    hits, place = [], -1
    for place, word in enumerate(_WORD.findall(text.lower())):
        value = seen.get(word)
        if value is None:
            value = max((odds.get(t, 0.0) for t in tokens_of(word)), default=0.0)
            if len(seen) < 200_000:
                seen[word] = value
        if value:
            hits.append((place, value))
    return place + 1, segments(hits, place + 1, drift)


PASSAGE = StructType([StructField("first", IntegerType()), StructField("last", IntegerType()), StructField("score", DoubleType())])


def passages(docs: DataFrame, keep: Sequence[str], odds: dict[str, float], drift: float = DRIFT) -> DataFrame:
    """``keep``, ``n_tokens`` and the ``passages`` of every text that score ``LEAST_PASSAGE`` or more."""
    sent = docs.sparkSession.sparkContext.broadcast(odds)
    kind = StructType([docs.schema[c] for c in keep] + [StructField("n_tokens", LongType()), StructField("passages", ArrayType(PASSAGE))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, float] = {}
        types = [pa.int64(), pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("score", pa.float64())]))]
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                counts, lists = [], []
                for text in part.column(len(keep)).to_pylist():
                    n, found = scan(text or "", sent.value, drift, seen)
                    counts.append(n)
                    lists.append([{"first": a, "last": b, "score": s} for a, b, s in found if s >= LEAST_PASSAGE])
                made = [pa.array(counts, types[0]), pa.array(lists, types[1])]
                yield pa.RecordBatch.from_arrays([part.column(i) for i in range(len(keep))] + made, kind.names)

    return docs.select(*keep, F.col("text").alias("_text")).mapInArrow(run, kind)


def _evidence() -> Column:
    """The best passage's score less what texts of this length reach by chance."""
    best = F.coalesce(F.array_max(F.transform("passages", lambda p: p["score"])), F.lit(0.0))
    return best - F.log1p(F.col("n_tokens").cast("double"))


def _features(location: float, scale: float) -> list[Column]:
    """How far the best passage lies out on the clean texts' extreme-value law, and how many passages there are."""
    z = (_evidence() - location) / max(scale, 1e-6)
    # -log of the upper tail 1 - exp(-exp(-z)); beyond 30 the tail is exp(-z).
    tail = F.when(z > 30, z).otherwise(-F.log(-F.expm1(-F.exp(-F.greatest(z, F.lit(-5.0))))))
    return [tail, F.log1p(F.size("passages").cast("double"))]


def fit(docs: DataFrame, labels: DataFrame, most: int = FIT_DOCUMENTS) -> Model:
    """Learn from the labelled documents that are not held out, at most about ``most`` of them, by a hash of their id.

    Without toxic or without clean ones every text gets the same score.
    """
    labels = labels.filter(~held_out() & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    marked = labels.groupBy(F.col("doc_id").alias("_id")).agg(F.max(F.when(F.col("toxic") > 0, 1).otherwise(0)).cast("int").alias("label"))
    n = marked.count()
    if n > most:
        marked = marked.filter(F.pmod(F.xxhash64("_id"), F.lit(1 << 30)) < int((1 << 30) * most / n))
    # No more than about `most` rows, whatever the size of the data.
    training = docs.select("doc_id", "text").join(F.broadcast(marked), F.col("doc_id") == F.col("_id")).select("text", "label")
    training = written(training, "toxic-training")
    odds = token_odds(training)
    share = float(training.agg(F.avg("label")).first()[0] or 0.0)
    flat = Model(odds, DRIFT, 0.0, 1.0, (0.0, 0.0, math.log((share + 1e-3) / (1 - share + 1e-3))))
    if not odds:
        return flat
    scanned = written(passages(training, ["label"], odds), "toxic-scanned")
    mean, spread = scanned.filter("label = 0").agg(F.avg(_evidence()), F.stddev_samp(_evidence())).first()
    if mean is None:
        return flat
    # The moments of Gumbel's law: deviation pi / sqrt(6) scales, mean 0.5772 scales above its location.
    scale = max((spread or 0.0) * math.sqrt(6) / math.pi, 1e-3)
    location = mean - 0.57721566 * scale
    named = scanned.select("label", *[c.alias(f"x{i}") for i, c in enumerate(_features(location, scale))])
    rows = VectorAssembler(inputCols=["x0", "x1"], outputCol="features").transform(named)
    found = LogisticRegression(labelCol="label", regParam=1e-4, maxIter=100).fit(rows)
    return flat._replace(location=location, scale=scale, weights=(*map(float, found.coefficients), float(found.intercept)))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``score`` (the chance that the document is toxic) and its ``passages`` (by token places).

    A null or empty text has no passages and the score of a text without evidence. Equal rows are each
    returned; an empty table gives no rows. Other columns are ignored.
    """
    scanned = passages(docs, ["doc_id"], model.odds, model.drift)
    a, b = _features(model.location, model.scale)
    value = 1 / (1 + F.exp(-(a * model.weights[0] + b * model.weights[1] + model.weights[2])))
    return scanned.select("doc_id", value.alias("score"), "passages")


