"""Hard negatives of anchors by exact inner products, several candidates to one wide integer.

A block's candidates are packed component by component (Kronecker substitution): each component,
biased to be no less than zero, takes a field of one wide integer, wide enough for a whole inner
product. An anchor then multiplies once per component, whatever the block's number of candidates,
and its sum of products holds all scores in separate fields. Blocks of candidates meet blocks of anchors
by shuffle; tasks return the best of their block, which are ranked per anchor.
"""

from __future__ import annotations

from operator import mul

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from sensorloom.llm.vectors import LONGEST, against_all, first_best, id_order, matrix, whole_vectors
from sensorloom.session import written

POSITIVES = 5
NEGATIVES = 5
ANCHOR_EVERY = 100
#: A negative scores at least this many percent of its positive, and no more than it.
LEAST_PERCENT = 80


class Packed:
    """Candidates as one wide integer per component, for anchors with components of at most ``most`` either way."""

    def __init__(self, rows: np.ndarray, most: int):
        self.count = len(rows)
        low, high = (int(rows.min()), int(rows.max())) if rows.size else (0, 0)
        self.bias = -min(low, 0)
        # Every sum of products, biased candidates included, lies strictly within half a field either way.
        bound = rows.shape[1] * most * (high + self.bias)
        self.width = next(w for w in (4, 8, 8 + bound.bit_length() // 8) if bound < 1 << (8 * w - 1))
        biased = (rows.astype(object) if self.width > 8 or self.bias + high > LONGEST else rows) + self.bias
        self.words = [self._word(biased[:, d]) for d in range(rows.shape[1])]
        self.half = 1 << (8 * self.width - 1)
        self.zero = int.from_bytes(self.half.to_bytes(self.width, "little") * self.count, "little")

    def _word(self, fields: np.ndarray) -> int:
        if self.width <= 8:
            return int.from_bytes(fields.astype(f"<u{self.width}").tobytes(), "little")
        return int.from_bytes(b"".join(int(f).to_bytes(self.width, "little") for f in fields), "little")

    def scores(self, anchor: list[int]) -> np.ndarray:
        """The inner product of ``anchor`` with every candidate, exact; beyond a long the nearest long."""
        total = sum(map(mul, anchor, self.words), self.zero)
        data = total.to_bytes(self.width * self.count, "little")
        less = self.bias * sum(anchor[: len(self.words)])
        if self.width <= 8 and self.half + abs(less) <= LONGEST:
            return np.frombuffer(data, f"<u{self.width}").astype(np.int64) - np.int64(self.half + less)
        fields = (int.from_bytes(data[i : i + self.width], "little") for i in range(0, len(data), self.width))
        return np.array([min(max(f - self.half - less, -LONGEST), LONGEST) for f in fields], np.int64)


def _opened(rows: pa.Table, anchors: pa.Table) -> tuple[pa.Table, Packed, list[list[int]]]:
    """A block's rows by id, packed, and the anchors' components."""
    rows = rows.take(pa.array(id_order(rows["vec_id"])))
    numbers, own = matrix(rows["vector"]), matrix(anchors["vector"])
    most = max(abs(int(own.min())), abs(int(own.max()))) if own.size else 0
    return rows, Packed(numbers, most), own.tolist()


def _positives(rows: pa.Table, anchors: pa.Table) -> pa.Table:
    rows, packed, own = _opened(rows, anchors)
    label, number = rows["label"].to_numpy(), rows["row"].to_numpy()
    of, at, scores = [], [], []
    for i, (anchor, mine, row) in enumerate(zip(own, anchors["label"].to_pylist(), anchors["row"].to_pylist())):
        alike = np.flatnonzero((label == mine) & (number != row))
        score = packed.scores(anchor)[alike]
        best = first_best(score, POSITIVES)
        of.append(np.full(len(best), i))
        at.append(alike[best])
        scores.append(score[best])
    of, at, scores = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (of, at, scores))
    return pa.table({"anchor": anchors["row"].take(pa.array(of)), "positive_id": rows["vec_id"].take(pa.array(at)), "positive_score": scores})


def _negatives(rows: pa.Table, anchors: pa.Table) -> pa.Table:
    rows, packed, own = _opened(rows, anchors)
    label = rows["label"].to_numpy()
    of, at, scores, places = [], [], [], []
    for i, (anchor, mine, positives) in enumerate(zip(own, anchors["label"].to_pylist(), anchors["positives"].to_pylist())):
        unlike = np.flatnonzero(label != mine)
        score = packed.scores(anchor)[unlike]
        for positive in positives:
            most = positive["positive_score"]
            least = -(-LEAST_PERCENT * most // 100)  # the least whole score that is not below the share
            near = np.flatnonzero((score >= least) & (score <= most))
            best = near[first_best(score[near], NEGATIVES)]
            of.append(np.full(len(best), i))
            at.append(unlike[best])
            scores.append(score[best])
            places.append(np.full(len(best), positive["place"], np.int32))
    of, at, scores = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (of, at, scores))
    places = np.concatenate([np.zeros(0, np.int32), *places])
    return pa.table({"anchor": anchors["row"].take(pa.array(of)), "place": places, "negative_id": rows["vec_id"].take(pa.array(at)), "negative_score": scores})


def _ranked(found: DataFrame, by: list[str], score: str, id: str, k: int, rank: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc(score), F.asc_nulls_last(id))
    return found.withColumn(rank, F.row_number().over(order)).filter(F.col(rank) <= k)


def hard_negatives(df: DataFrame, vector: str = "embedding", anchor_every: int = ANCHOR_EVERY) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank`` (from 1), ``negative_id``, ``positive_score``, ``negative_score``.

    Components become ``floor(256 x)``; where ``vec_id`` is divisible by 7 the label becomes ``(label + 1) % 10``.
    Anchors are the rows whose ``vec_id`` is divisible by ``anchor_every``. An anchor's positives are its first
    ``POSITIVES`` other rows of its label by score, ties by the smaller id; the negatives of each are the first
    ``NEGATIVES`` rows of other labels that score at least ``LEAST_PERCENT`` percent of it and no more than it.

    Rows with a null label or vector, or a null or non-finite component, take no part. A null ``vec_id`` is no
    anchor and comes after all others. Repeated rows are rows of their own: each is a candidate for the other, and as
    anchors each gives its rows. Vectors of different lengths compare as if filled up with zeros; an empty one
    scores 0. Scores beyond a long count as the nearest long. Tables without anchors, positives or
    negatives give no rows; other columns are ignored.
    """
    label = F.col("label").cast("bigint")
    label = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    rows = whole_vectors(df.filter(F.col("label").isNotNull()), label.alias("label"), vector=vector)
    is_anchor = F.col("vec_id") % anchor_every == 0
    n_rows, n_anchors = rows.agg(F.count("*"), F.count_if(is_anchor)).first()
    anchors = rows.filter(is_anchor)

    found = against_all(rows, n_rows, anchors, n_anchors, _positives, "anchor bigint, positive_id bigint, positive_score bigint")
    found = _ranked(found, ["anchor"], "positive_score", "positive_id", POSITIVES, "place")
    found = found.groupBy(F.col("anchor").alias("row")).agg(F.collect_list(F.struct("place", "positive_id", "positive_score")).alias("positives"))
    anchors = written(anchors.join(found, "row"), "anchors")

    schema = "anchor bigint, place int, negative_id bigint, negative_score bigint"
    negatives = against_all(rows, n_rows, anchors, n_anchors, _negatives, schema)
    negatives = _ranked(negatives, ["anchor", "place"], "negative_score", "negative_id", NEGATIVES, "rank")
    positives = anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"), F.explode("positives").alias("p"))
    positives = positives.select("anchor", "anchor_id", "p.*")
    return negatives.join(positives, ["anchor", "place"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
