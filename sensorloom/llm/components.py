"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sensorloom.session import written


LINKS_PER_FILE = 200_000


def components(links: DataFrame) -> DataFrame:
    """``node`` and the least node of its component as ``root``, for all nodes that have links.

    ``links`` has columns ``a`` and ``b``. Each round points neighbours at the least node around
    them, first the larger ones, then the smaller ones, which ends in one star per component after
    a number of rounds that grows with the logarithm of its size. Nodes with many links are joined,
    never gathered into one row; each round is written, so nothing is recomputed from the start.
    """
    down = written(_downward(links.select(F.col("a").alias("u"), F.col("b").alias("v"))), "links")
    state = None
    while True:
        new = down.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if new == state:
            return down.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
                down.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        state = new
        both = down.unionAll(down.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = _downward(both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = _downward(small.unionAll(least.select("u", F.col("m").alias("v"))))
        # As many files as its rows are worth, however many partitions the shuffles have.
        down = written(small.coalesce(1 + new[0] // LINKS_PER_FILE), "links")


def _downward(pairs: DataFrame) -> DataFrame:
    """Each pair once, the larger node first; loops go."""
    return pairs.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
