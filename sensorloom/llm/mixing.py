"""Mixing sources to target weights, cut at each source's exact budget.

Every document gets a hash-random key. Within its source it is placed by that key: the key's range
is cut into equal buckets, sizes are summed per (source, bucket) and the sums run up over the
buckets, so the running total inside one bucket only needs the rows of that bucket. A source with
a third of all rows is spread over all its buckets.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from sensorloom.llm.common import whole, word_count
from sensorloom.operators.ordering import with_position
from sensorloom.session import written

WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
ROWS_PER_BUCKET = 50_000
LEAST_BUCKETS = 256
_SPACE = 1 << 32
_SOURCE = ["_unnamed", "_source"]


def random_key(doc_id: str = "doc_id", text: str = "text", seed: str = "mix") -> Column:
    """Hexadecimal digits that depend on the document alone, so that every run sees the same order."""
    return F.md5(F.concat_ws("|", F.lit(seed), F.col(doc_id).cast("string"), F.md5(whole(text))))


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """``sizes`` (``_unnamed``, ``_source``, ``source_size``) with each source's ``target``.

    Sources in code-point order, the unnamed last, take ``weights`` in turn. A target above ``most``
    times its source is cut to that, and what it gives up goes to the others by weight, until none
    is above. Each round is one aggregate over the sources; only its one row of sums reaches the driver.
    """
    placed = with_position(sizes, _SOURCE, "_place")
    turn = F.col("_place") % len(weights)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (turn + 1).cast("int")).cast("bigint")
    placed = written(placed.withColumn("_weight", weight).withColumn("_cap", most * F.col("source_size")), "sources")
    total = placed.agg(F.sum("source_size")).first()[0] or 0
    share = 0.0
    while True:
        above = F.col("_cap") < F.col("_weight") * F.lit(share)
        given, left = placed.agg(F.sum(F.when(above, F.col("_cap"))), F.sum(F.when(~above, F.col("_weight")))).first()
        new = float(total - (given or 0)) / left if left else share
        if new <= share:
            break
        share = new
    target = F.least(F.col("_cap").cast("double"), F.col("_weight") * F.lit(share))
    return placed.select(*_SOURCE, "source_size", target.alias("target"))


def mix_sources(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_EPOCHS, rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    """Per document ``size`` in words, its source's ``source_size`` and ``target``, and ``taken`` words.

    Each source is repeated for as many whole epochs as fit its target; of the next epoch the
    documents in key order are taken until the target is met to the word, so the document on the
    cut is taken in part. No document is taken more than ``most`` times.

    Very long texts count with all their words. Null or blank texts have size 0 and are never taken; a null source is a source of its own, the last.
    Equal rows are mixed each on its own. An empty table gives no rows. Other columns are ignored.
    """
    key = random_key()
    sized = docs.select(
        "doc_id", F.col("source").isNull().alias("_unnamed"), F.coalesce("source", F.lit("")).alias("_source"),
        word_count(whole()).alias("size"), key.alias("_key"),
    )
    sized = written(sized, "sizes")
    buckets = max(LEAST_BUCKETS, math.ceil(sized.count() / rows_per_bucket))
    place = F.conv(F.substring("_key", 1, 8), 16, 10).cast("bigint")
    sized = sized.withColumn("_bucket", F.expr(f"{buckets}L") * place).withColumn("_bucket", F.floor(F.col("_bucket") / _SPACE))

    sums = written(sized.groupBy(*_SOURCE, "_bucket").agg(F.sum("size").alias("_sum")), "bucket-sums")
    targets = source_targets(sums.groupBy(*_SOURCE).agg(F.sum("_sum").alias("source_size")), weights, most)
    before = Window.partitionBy(*_SOURCE).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("_start", F.coalesce(F.sum("_sum").over(before), F.lit(0))).drop("_sum").join(targets, _SOURCE)

    earlier = Window.partitionBy(*_SOURCE, "_bucket").orderBy("_key", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.withColumn("_before", F.coalesce(F.sum("size").over(earlier), F.lit(0)))
    joined = placed.join(starts, [*_SOURCE, "_bucket"])
    budget = F.round("target").cast("bigint")
    epochs = F.when(F.col("source_size") > 0, F.expr("cast(round(target) as bigint) div source_size")).otherwise(0)
    rest = budget - epochs * F.col("source_size") - F.col("_start") - F.col("_before")
    taken = epochs * F.col("size") + F.greatest(F.lit(0), F.least(rest, F.col("size")))
    source = F.when(~F.col("_unnamed"), F.col("_source"))
    return joined.select("doc_id", source.alias("source"), "size", "source_size", "target", taken.cast("bigint").alias("taken"))
