"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact verification.

All of it is DataFrame expressions. Only windows that hold a shingle of a benchmark item are
fingerprinted: without one, the exact similarity is zero whatever the fingerprint says.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sensorloom.llm.common import whole
from sensorloom.operators.ordering import fits_broadcast, spread_join
from sensorloom.session import written

#: Words in a shingle, and the least weighted similarity of a window and an item.
WORDS = 5
SIMILARITY = 0.8
#: Fingerprints of sets of similarity 0.8 differ in 10 of 64 bits on average, with a deviation of 3.
RADIUS = 19
BITS = 64
#: Item shingles up to which they are broadcast (about 16 MB); beyond it they are joined by shuffle.
BROADCAST_SHINGLES = 500_000
#: Contaminated documents up to which their keys are broadcast.
BROADCAST_DOCS = 500_000


def words_of(text: Column) -> Column:
    """Runs of letters and digits, in lower case."""
    return F.split(F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " ")), " ")


def shingles_of(words: Column, weighted: bool = False) -> Column:
    """Hashes of all runs of five words, none if there are fewer; with ``weighted`` also their letters as weight."""
    places = F.when(F.size(words) >= WORDS, F.sequence(F.lit(0), F.size(words) - WORDS)).otherwise(F.array().cast("array<int>"))

    def at(i: Column) -> Column:
        run = [F.get(words, i + k) for k in range(WORDS)]
        if not weighted:
            return F.xxhash64(*run)
        return F.struct(F.xxhash64(*run).alias("h"), sum((F.length(w) for w in run[1:]), F.length(run[0])).cast("bigint").alias("w"))

    return F.transform(places, at)


def simhash(shingles: Column) -> Column:
    """64 bits, each the sign of the summed weights of the shingles whose hash has it, less the others'."""

    def bit(b: Column) -> Column:
        def vote(total: Column, s: Column) -> Column:
            has = F.getbit(s["h"], b) == 1
            return total + F.when(has, s["w"]).otherwise(-s["w"])

        return F.when(F.aggregate(shingles, F.lit(0).cast("bigint"), vote) > 0, F.call_function("shiftleft", F.lit(1).cast("bigint"), b)).otherwise(F.lit(0).cast("bigint"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(BITS - 1)), F.lit(0).cast("bigint"), lambda all_, b: all_.bitwiseOR(bit(b)))


def blocks(fingerprint: Column, radius: int = RADIUS) -> Column:
    """(number, value) of ``radius + 1`` blocks of the fingerprint; within ``radius`` bits one of them is equal."""
    edges = [BITS * k // (radius + 1) for k in range(radius + 2)]
    cut = [F.shiftrightunsigned(fingerprint, a).bitwiseAND(F.lit((1 << (b - a)) - 1)) for a, b in zip(edges, edges[1:])]
    return F.array(*[F.struct(F.lit(i).alias("block"), value.alias("value")) for i, value in enumerate(cut)])


def similarity(a: Column, b: Column) -> Column:
    """Weighted Jaccard similarity of two arrays of distinct weighted shingles."""

    def total(s: Column) -> Column:
        return F.aggregate(s, F.lit(0).cast("bigint"), lambda t, x: t + x["w"])

    shared = total(F.array_intersect(a, b))
    return shared / (total(a) + total(b) - shared)


def contaminated(docs: DataFrame, benchmark: DataFrame, least: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """Documents that hold a benchmark item: ``doc_id``, ``hash`` (of the text), ``item_id``, ``similarity``,
    ``start`` (word at which the best window begins) and ``distance`` (of the fingerprints).

    A window is as long as the item, or the whole text where that is shorter. Each shingle that a text
    shares with an item says where the item would begin; these windows and those around them, as far as
    an item of similarity ``least`` can be shifted, are fingerprinted, and compared with this item alone.

    Null texts count as empty; very long ones are searched as a whole. Texts and items under five words match nothing. Rows equal in ``doc_id``
    and text give one row for each item; equal windows are compared once. Equal item ids with different
    texts are one item that matches where any of its texts does. Empty tables give no rows. Other columns
    are ignored.
    """
    items = benchmark.select("item_id", words_of(whole()).alias("words")).filter(F.size("words") >= WORDS)
    items = items.select("item_id", F.size("words").alias("n"), F.array_distinct(shingles_of(F.col("words"), True)).alias("item"), shingles_of(F.col("words")).alias("_s"))
    items = written(items.withColumns({"print": simhash(F.col("item")), "variant": F.xxhash64("_s")}), "items")
    variants = items.select("variant", "n", "print", "_s").dropDuplicates(["variant"])
    anchors = written(variants.select("variant", "n", F.posexplode("_s").alias("j", "h")), "anchors")
    if anchors.count() <= BROADCAST_SHINGLES:
        anchors = F.broadcast(anchors)

    keyed = docs.select("doc_id", F.xxhash64(whole()).alias("hash"), words_of(whole()).alias("words"))
    spread = keyed.select("doc_id", "hash", F.size("words").alias("size"), F.posexplode(shingles_of(F.col("words"))).alias("i", "h"))
    hits = spread.join(anchors, "h").select("doc_id", "hash", "size", "variant", "n", (F.col("i") - F.col("j")).alias("start"))
    # The windows around each place; where windows of one item overlap, each counts once.
    shift = F.ceil((F.col("n") - WORDS + 1) * (1 - least) / 2).cast("int") + 1
    hits = hits.distinct().withColumn("start", F.explode(F.sequence(F.col("start") - shift, F.col("start") + shift)))
    last = F.greatest(F.lit(0), F.col("size") - F.col("n"))
    starts = hits.withColumn("start", F.greatest(F.lit(0), F.least("start", last))).groupBy("doc_id", "hash").agg(F.collect_set(F.struct("variant", "n", "start")).alias("at"))
    starts = written(starts.withColumnsRenamed({"doc_id": "_id", "hash": "_hash"}), "starts")

    few = starts.count() <= BROADCAST_DOCS and fits_broadcast(starts)
    held = keyed.join(F.broadcast(starts) if few else starts, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("hash") == F.col("_hash")))
    held = held.dropDuplicates(["_id", "_hash"]).select("doc_id", "hash", "words", F.explode("at").alias("at"))
    window = F.slice("words", F.col("at.start") + 1, F.col("at.n"))
    windows = held.select("doc_id", "hash", *[F.col(f"at.{c}").alias(c) for c in ("variant", "n", "start")], F.array_join(window, " ").alias("window"))
    windows = written(windows.withColumn("key", F.md5("window")), "windows")

    different = windows.groupBy("key", "n").agg(F.first("window").alias("window"))
    different = different.withColumn("shingles", F.array_distinct(shingles_of(F.split("window", " "), True)))
    different = written(different.withColumn("print", simhash(F.col("shingles"))).drop("window"), "prints")

    # A window looks up the items whose shingles led to it, and of these only whose fingerprint shares a block with its own.
    led = windows.select("key", "n", "variant").distinct().join(different.select("key", "n", F.col("print").alias("_p")), ["key", "n"])
    probe = led.select("key", "n", "variant", "_p", F.inline(blocks(F.col("_p"), radius)))
    index = variants.select(F.col("variant").alias("_variant"), F.col("print").alias("_q"), F.inline(blocks(F.col("print"), radius)))
    index = written(index.withColumnsRenamed({"block": "_block", "value": "_value"}), "index")
    met = (F.col("variant") == F.col("_variant")) & (F.col("block") == F.col("_block")) & (F.col("value") == F.col("_value"))
    distance = F.bit_count(F.col("_p").bitwiseXOR(F.col("_q")))
    near = spread_join(probe, index, met, "inner", ["key"]).filter(distance <= radius)
    near = near.select("key", "n", "variant", distance.alias("distance")).distinct()

    tests = near.join(different.select("key", "n", "shingles"), ["key", "n"])
    told = written(items.select(F.col("item_id"), F.col("variant").alias("_variant"), "item"), "item-texts")
    tests = spread_join(tests, told, F.col("variant") == F.col("_variant"), "inner", ["key"])
    passed = tests.withColumn("similarity", similarity(F.col("shingles"), F.col("item"))).filter(F.col("similarity") >= least)
    passed = written(passed.select(F.col("key").alias("_key"), F.col("variant").alias("_of"), "item_id", "similarity", "distance"), "passed")
    # One window that stands in a great many documents is not gathered in one task.
    found = spread_join(windows, passed, (F.col("key") == F.col("_key")) & (F.col("variant") == F.col("_of")), "inner", ["doc_id", "start"])
    best = F.max_by(F.struct("similarity", "start", "distance"), F.struct("similarity", -F.col("start"), -F.col("distance"))).alias("best")
    return found.groupBy("doc_id", "hash", "item_id").agg(best).select("doc_id", "hash", "item_id", "best.*")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with all their columns."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    rows = docs.toDF(*names)
    text, doc_id = (F.col(names[docs.columns.index(c)]) for c in ("text", "doc_id"))
    found = contaminated(docs, benchmark, least).select(F.col("doc_id").alias("_id"), F.col("hash").alias("_hash")).distinct()
    found = written(found, "contaminated")
    few = found.count() <= BROADCAST_DOCS
    same = doc_id.eqNullSafe(F.col("_id")) & (F.xxhash64(F.coalesce(text, F.lit(""))) == F.col("_hash"))
    return rows.join(F.broadcast(found) if few else found, same, "left_anti").toDF(*docs.columns)
