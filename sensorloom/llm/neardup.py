"""Near duplicates by improved consistent weighted sampling over TF-IDF shingles.

A text is a weighted set of five-word shingles: how often it has the shingle, times the shingle's
inverse document frequency, counted for every shingle over all documents, of which those of one least
shingle count once. Samples agree with the probability of the weighted Jaccard similarity, so texts that agree in a band of samples are candidates, and every candidate link is verified by
the exact similarity before it counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, IntegerType, LongType, StructField, StructType

from sensorloom.llm.common import join_spread, whole
from sensorloom.llm.components import components
from sensorloom.llm.shingles import WORDS, Powers, mixed, shared_powers, shingle_hashes, texts_as_bytes, word_hashes
from sensorloom.operators.ordering import spread_join
from sensorloom.session import written

SIMILARITY = 0.8
#: Two texts of similarity 0.8 share a band of 3 with probability 0.51, one of the ten bands with 0.999.
BANDS, ROWS = 10, 3
#: A candidate pair also agrees in so many of the samples; at similarity 0.8 all but 1 in 3,000 pairs do.
SAMPLES, AGREEING = 32, 17
#: Code points of texts and nodes that are read and signed together, and whose shingles' frequencies are counted together.
BATCH, RANGE = 1 << 21, 1 << 25
#: Shingles whose frequencies are counted at a time, and words hashed at a time for the least shingles.
PIECE = 1 << 20
#: Bits of a posting that name its document's least shingle among those of a batch; the others name the shingle.
_LEAST_BITS = np.uint64(24)
#: Rounds in which the texts of each bucket are compared with one of them.
STARS = 1
#: Code points of texts in a block; what the rounds leave open is compared block by block.
BLOCK = 1 << 19
#: Copies of a text, and texts of a bucket, beyond which they are spread over tasks.
BUSY = 50_000
_SLACK = 1e-9  # sums of weights depend on their order


def _sets(column: pa.Array, powers: Powers) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Each text's distinct shingles, sorted, and how often it has them."""
    for data in texts_as_bytes(column):
        yield np.unique(shingle_hashes(word_hashes(data, powers)), return_counts=True)


def _least_of(words: list[np.ndarray]) -> list[np.uint64]:
    """The least shingle of each list of words; lists of five words and more are hashed together."""
    found = [shingle_hashes(w).min() if 0 < len(w) < WORDS else np.uint64(0) for w in words]
    long = [i for i, w in enumerate(words) if len(w) >= WORDS]
    if long:
        ends = np.cumsum([len(words[i]) for i in long])
        starts = ends - [len(words[i]) for i in long]
        made = np.append(shingle_hashes(np.concatenate([words[i] for i in long])), np.uint64(0))
        for i, least in zip(long, np.minimum.reduceat(made, np.stack([starts, ends - WORDS + 1], 1).ravel())[::2]):
            found[i] = least
    return found


def least_shingles(texts: pa.Array) -> pa.Array:
    """The least shingle of each text, 0 for a text without words."""
    found, words, held = [], [], 0
    for data in texts_as_bytes(texts):
        words.append(word_hashes(data, shared_powers()))
        held += len(words[-1])
        if held >= PIECE:
            found, words, held = found + _least_of(words), [], 0
    return pa.array(np.array(found + _least_of(words), np.uint64).view(np.int64))


def _batch(table: pa.Table, ranges: int) -> tuple:
    """A batch's different texts as sets, each row's place among them, and their different shingles, sorted.

    The last two are the place of every set's members among the shingles, and how many shingles each range of
    hashes has. Any two readings of a batch give the same, whatever order its rows come in.
    """
    table = table.combine_chunks()
    _, first, place = np.unique(np.array(table["node"].to_pylist()), return_index=True, return_inverse=True)
    sets = list(_sets(table["text"].chunk(0).take(pa.array(first)), shared_powers()))
    shingles, which = np.unique(np.concatenate([s for s, _ in sets]), return_inverse=True)
    range_ = ((shingles >> np.uint64(48)) * np.uint64(ranges) >> np.uint64(16)).astype(np.int64)
    return sets, place, shingles, which, np.bincount(range_, minlength=ranges)


def document_frequencies(postings: list[np.ndarray]) -> list[np.ndarray]:
    """For each posting (a shingle above, its document's least shingle below) how many least shingles its shingle has."""
    every = np.concatenate(postings)
    order = np.argsort(every)
    every = every[order]
    new = np.concatenate(([True], every[1:] != every[:-1]))
    shingle = every >> _LEAST_BITS
    which = np.cumsum(np.concatenate(([False], shingle[1:] != shingle[:-1])))
    found = np.empty(len(every), np.int32)
    found[order] = np.bincount(which[new])[which]
    return np.split(found, np.cumsum([len(p) for p in postings])[:-1])


def held_in_batch(sets: list[tuple[np.ndarray, np.ndarray]], shingles: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Of how many least shingles of a batch's ``sets`` each of its ``shingles`` is held."""
    _, least = np.unique(np.array([s[0] if len(s) else 0 for s, _ in sets], np.uint64), return_inverse=True)
    least = np.repeat(least, [len(s) for s, _ in sets])
    held = np.zeros(len(shingles), np.int32)
    if len(which):
        held[which] = document_frequencies([which.astype(np.uint64) << _LEAST_BITS | least.astype(np.uint64)])[0]
    return held


def _held_in_all(shingles: list[np.ndarray], held: list[np.ndarray], shared: list[int | None]) -> list[np.ndarray]:
    own, parts = [i for i, least in enumerate(shared) if least is None], {}
    for i, least in enumerate(shared):
        if least is not None:
            parts.setdefault(least, []).append(i)
    merged = [np.unique(np.concatenate([shingles[i] for i in of])) for of in parts.values()]
    every = [shingles[i] for i in own] + merged
    times = [held[i] for i in own] + [np.ones(len(m), np.uint8) for m in merged]
    _, which = np.unique(np.concatenate(every), return_inverse=True)
    total = np.split(np.bincount(which, np.concatenate(times)).astype(np.int32)[which], np.cumsum([len(s) for s in every])[:-1])
    found = dict(zip(own, total))
    for of, members, counts in zip(parts.values(), merged, total[len(own) :]):
        found.update((i, counts[np.searchsorted(members, shingles[i])]) for i in of)
    return [found[i] for i in range(len(shingles))]


def held_in_all(shingles: list[np.ndarray], held: list[np.ndarray], shared: list[int | None]) -> list[np.ndarray]:
    """For each batch's ``shingles`` of a range, sorted, of how many least shingles they are held in all batches.

    A batch without ``shared`` has all documents of its least shingles, so what it ``held`` adds up. Batches that
    have documents of one least shingle between them name it in ``shared``; it counts once for each shingle. The
    range is counted piece by piece of its hashes, so that little is held beside what came in and goes out.
    """
    least, most = min(s[0] for s in shingles), max(s[-1] for s in shingles)
    pieces = -(-sum(map(len, shingles)) // PIECE)
    bounds = least + (most - least) // np.uint64(pieces) * np.arange(1, pieces, dtype=np.uint64)
    cuts = [[0, *np.searchsorted(s, bounds).tolist(), len(s)] for s in shingles]
    found = [np.empty(len(s), np.int32) for s in shingles]
    for k in range(pieces):
        at = [slice(*cut[k : k + 2]) for cut in cuts]
        for i, counts in enumerate(_held_in_all([s[x] for s, x in zip(shingles, at)], [h[x] for h, x in zip(held, at)], shared)):
            found[i][at[i]] = counts
    return found


def idf(frequency: np.ndarray, documents: int) -> np.ndarray:
    """Smoothed inverse document frequency; a shingle of every document still weighs 1."""
    return 1 + np.log((1 + documents) / (1 + frequency))


def _weighted(texts: pa.Array, frequencies: pa.Array, documents: int, powers: Powers) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Each text's shingles, how often it has them, and their TF-IDF weights."""
    for (shingles, times), df in zip(_sets(texts, powers), frequencies):
        yield shingles, times, times * idf(np.frombuffer(df.as_py(), np.int32), documents)


def weighted_samples(shingles: np.ndarray, weights: np.ndarray, n: int = SAMPLES) -> np.ndarray:
    """``n`` consistent samples of a weighted set: two sets agree in one with their weighted Jaccard similarity."""
    seeds = mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))[:, None]
    best, who = np.full(n, np.inf, np.float32), np.zeros(n, np.uint64)
    rows, step = np.arange(n), np.float32(1 / (1 << 16))
    for at in range(0, len(shingles), 1024):  # bounds the memory of long texts
        own = shingles[at : at + 1024]
        log_w = np.log(weights[at : at + 1024]).astype(np.float32)
        x = mixed(own[None, :] ^ seeds)
        # Four uniform numbers of 16 bits each from one hash, and one from its product with a constant.
        u = x.view(np.uint16).reshape(n, len(own), 4).astype(np.float32)
        u += np.float32(0.5)
        u *= step
        beta = ((x * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(40)).astype(np.float32) * np.float32(1 / (1 << 24))
        r = -np.log(u[..., 0] * u[..., 1])
        level = np.floor(log_w / r + beta)
        score = np.log(-np.log(u[..., 2] * u[..., 3])) - r * (level - beta + np.float32(1))
        i = np.argmin(score, axis=1)
        least = score[rows, i]
        new = least < best
        sample = mixed(own[i] + level[rows, i].astype(np.int64).view(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        best, who = np.where(new, least, best), np.where(new, sample, who)
    return who


def sketch_of(samples: np.ndarray) -> list[int]:
    """Eight bits of each sample, eight samples to a number."""
    return (samples & np.uint64(255)).astype(np.uint8).view(np.int64).tolist()


def agreements(a: Column, b: Column) -> Column:
    """In how many samples two sketches agree: the bytes without a different bit."""
    total = F.lit(SAMPLES)
    for i in range(SAMPLES // 8):
        x = a[i].bitwiseXOR(b[i])
        for shift in (4, 2, 1):
            x = x.bitwiseOR(F.shiftrightunsigned(x, shift))
        total = total - F.bit_count(x.bitwiseAND(F.lit(0x0101010101010101)))
    return total


def band_keys(samples: np.ndarray, bands: int = BANDS) -> list[int]:
    rows = samples[: bands * ROWS].reshape(bands, -1)
    keys = np.arange(1, bands + 1, dtype=np.uint64)
    for k in range(rows.shape[1]):
        keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + rows[:, k])
    return keys.view(np.int64).tolist()


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two weighted sets with sorted members."""
    both, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = float(np.minimum(a[1][i], b[1][j]).sum())
    rest = float(a[1].sum() + b[1].sum()) - shared
    return shared / rest if rest > 0 else 1.0


def _chars() -> Column:
    """Code points of a row's text and node, so that empty texts are worth something too."""
    return F.length("text").cast("bigint") + F.length("node")


def _signatures(texts: DataFrame, documents: int, chars: int) -> DataFrame:
    """``doc_id``, ``node``, the set's total weight, band keys, sketch, and its shingles' document frequencies.

    Texts are dealt into batches of bounded size, all of one least shingle into one batch. A batch sends its
    different shingles to the ranges of their hashes, and of how many least shingles it holds them; each range
    adds up, and the sums go back to the batch, whose texts are signed with them. So every shingle is counted
    exactly, no table of them is built, and both sides are bounded: a range takes nine bytes or a little
    more for each shingle of a batch. Documents of the same least shingle count once, since copies of a text, and most of its near copies,
    say nothing about how common its shingles are. Where they are more than a batch they are dealt into several,
    whose shingles a range merges before it counts them. Texts without words have no bands.
    """
    batches, ranges = max(1, -(-chars // BATCH)), min(max(1, -(-chars // RANGE)), 1 << 16)
    named = texts.select("doc_id", "node", "text", F.arrow_udf(least_shingles, LongType())("text").alias("least"))
    busy = named.groupBy(F.col("least").alias("_least")).agg(F.ceil(F.sum(_chars()) / BATCH).alias("_parts")).filter("_parts > 1")
    named = named.join(written(busy, "busy"), F.col("least") == F.col("_least"), "left")
    parts, rest = F.col("_parts"), F.pmod(F.xxhash64("least"), F.lit(batches))
    part = F.when(parts.isNull(), -1).otherwise(F.pmod(F.xxhash64("doc_id", "node"), parts)).cast("int")
    dealt = named.select("doc_id", "node", "text", F.when(parts.isNull(), rest).otherwise(F.col("least")).alias("batch"), part.alias("part"))
    place = [StructField("batch", LongType()), StructField("part", IntegerType()), StructField("range", IntegerType())]
    sent = StructType([*place, StructField("shingles", BinaryType()), StructField("held", BinaryType())])
    back = StructType([*place, StructField("dfs", BinaryType())])

    def send(rows: pa.Table) -> pa.Table:
        sets, _, shingles, which, sizes = _batch(rows, ranges)
        ends = np.cumsum(sizes)[:-1]
        held = held_in_batch(sets, shingles, which)
        parts = [np.split(x, ends) for x in (shingles, held.astype(np.min_scalar_type(held.max(initial=0))))]
        filled = np.flatnonzero(sizes)
        batch, part = (pa.array([rows[c][0].as_py()] * len(filled), kind) for c, kind in (("batch", pa.int64()), ("part", pa.int32())))
        return pa.table([batch, part, pa.array(filled, pa.int32()), *[pa.array([x[i].tobytes() for i in filled], pa.binary()) for x in parts]], sent.names)

    def count(rows: pa.Table) -> pa.Table:
        shingles = [np.frombuffer(b.as_buffer(), np.uint64) for b in rows["shingles"]]
        held = [b.as_buffer() for b in rows["held"]]  # in as many bytes a number as its batch needs
        held = [np.frombuffer(h, f"u{h.size // len(s)}") for h, s in zip(held, shingles)]
        shared = [None if part < 0 else batch for batch, part in zip(rows["batch"].to_pylist(), rows["part"].to_pylist())]
        found = held_in_all(shingles, held, shared)
        return pa.table([rows["batch"], rows["part"], rows["range"], pa.array([f.tobytes() for f in found], pa.binary())], back.names)

    fields = [StructField("weight", DoubleType()), StructField("bands", ArrayType(LongType())), StructField("sketch", ArrayType(LongType())), StructField("dfs", BinaryType())]
    kind = StructType([texts.schema["doc_id"], texts.schema["node"], *fields])

    def sign(rows: pa.Table, frequencies: pa.Table) -> pa.Table:
        sets, place, _, which, _ = _batch(rows, ranges)
        found = dict(zip(frequencies["range"].to_pylist(), frequencies["dfs"].to_pylist()))
        df = np.frombuffer(b"".join(found[i] for i in sorted(found)), np.int32)[which]
        made, at = [], 0
        for own, times in sets:
            part = df[at : at + len(own)]
            at += len(own)
            w = times * idf(part, documents)
            samples = weighted_samples(own, w) if len(w) else None
            made.append((float(w.sum()), [] if samples is None else band_keys(samples), [] if samples is None else sketch_of(samples), part.tobytes()))
        kinds = (pa.float64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary())
        columns = [pa.array(values, k).take(pa.array(place)) for values, k in zip(zip(*made), kinds)]
        return pa.table([rows["doc_id"], rows["node"], *columns], kind.names)

    counted = dealt.groupBy("batch", "part").applyInArrow(send, sent).groupBy("range").applyInArrow(count, back)
    return dealt.groupBy("batch", "part").cogroup(counted.groupBy("batch", "part")).applyInArrow(sign, kind)


def _verified(edges: DataFrame, texts: DataFrame, documents: int, least: float) -> DataFrame:
    """The ``edges`` (a, b) whose texts are at least ``least`` similar, with ``similarity``."""
    kind = StructType([edges.schema["a"], edges.schema["b"], StructField("similarity", DoubleType())])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            pairs = zip(*[_weighted(batch.column(i), batch.column(i + 1), documents, powers) for i in (2, 4)])
            value = np.array([similarity(a[::2], b[::2]) for a, b in pairs])
            kept = pa.array(value >= least - _SLACK, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(kept), batch.column(1).filter(kept), pa.array(value, pa.float64()).filter(kept)], kind.names)

    first = texts.select(F.col("node").alias("a"), F.col("text").alias("_a"), F.col("dfs").alias("_da"))
    second = texts.select(F.col("node").alias("b"), F.col("text").alias("_b"), F.col("dfs").alias("_db"))
    return edges.join(first, "a").join(second, "b").select("a", "b", "_a", "_da", "_b", "_db").mapInArrow(verify, kind)


def block_links(left: list[tuple], right: list[tuple], least: float) -> list[tuple[int, int, float]]:
    """Pairs (place in ``left``, place in ``right``, similarity) of at least ``least`` that join the classes of two blocks.

    Both are lists of (class, shingles, times, weights). The shingles of ``right`` are one sorted index; for
    each text of ``left`` their weights add up over its postings. Only links between classes not yet
    joined are returned, so there are fewer of them than texts.
    """

    def members(text: tuple) -> tuple[np.ndarray, np.ndarray]:
        _, shingles, times, weights = text  # a shingle that stands n times is n members
        which = np.repeat(np.arange(len(shingles)), times)
        number = np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times)
        return mixed(shingles[which] + number.astype(np.uint64)), (weights / times)[which]

    sets = [members(text) for text in right]
    totals = np.array([w.sum() for _, w in sets])
    keys, rows = np.concatenate([k for k, _ in sets]), np.repeat(np.arange(len(sets)), [len(k) for k, _ in sets])
    order = np.argsort(keys, kind="stable")
    keys, rows = keys[order], rows[order]
    joined: dict = {}

    def root(x):
        while x in joined:
            x = joined[x]
        return x

    found = []
    for i, text in enumerate(left):
        own, weights = members(text)
        since, until = np.searchsorted(keys, own, "left"), np.searchsorted(keys, own, "right")
        n = until - since
        at = np.repeat(since - np.cumsum(n) + n, n) + np.arange(n.sum())
        shared = np.bincount(rows[at], np.repeat(weights, n), len(sets))
        value = shared / np.maximum(totals + weights.sum() - shared, 1e-300)
        for j in np.flatnonzero(value >= least - _SLACK):
            a, b = root(text[0]), root(right[j][0])
            if a != b:
                joined[a] = b
                found.append((i, int(j), float(value[j])))
    return found


def _across(open_: DataFrame, texts: DataFrame, documents: int, least: float) -> DataFrame:
    """Links between the classes of each bucket; ``open_`` has ``bucket``, ``node``, ``root`` and its ``_largest`` class.

    The texts outside the largest class are compared with all of the bucket, in blocks of bounded size by a hash
    of the text; every two blocks of a bucket are a group of their own, so a busy bucket is spread over tasks.
    """
    node = texts.schema["node"].dataType
    kind = StructType([StructField("a", node), StructField("b", node), StructField("similarity", DoubleType())])
    rows = written(open_.select("bucket", "node", "root", (F.col("root") != F.col("_largest")).alias("apart")).join(texts, "node"), "open-texts")

    def blocks_of(texts_: Column) -> Column:
        """As many blocks as their text is worth, and no more than there are texts."""
        chars = F.sum(F.when(texts_, F.length("text").cast("bigint")).otherwise(0))
        return F.greatest(F.lit(1), F.least(F.ceil(chars / BLOCK), F.count_if(texts_))).cast("int")

    counts = rows.groupBy("bucket").agg(blocks_of(F.col("apart")).alias("_lefts"), blocks_of(F.lit(True)).alias("_rights"))
    counts = written(counts.withColumnRenamed("bucket", "_of"), "open-buckets")
    placed = spread_join(rows, counts, F.col("bucket") == F.col("_of"), "inner", ["node"])

    def side(of: DataFrame, own: str, other: str) -> DataFrame:
        """Rows in their own block, once for each block of the other side."""
        block = F.pmod(F.xxhash64("node"), F.col(f"{own}s")).cast("int").alias(own)
        copies = F.explode(F.sequence(F.lit(0), F.col(f"{other}s") - 1)).alias(other)
        dealt = of.select(*[F.col(c).alias(c) for c in ("bucket", "node", "root", "text", "dfs")], block, copies)
        return dealt.groupBy("bucket", "_left", "_right")

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        powers, sides = shared_powers(), []
        for table in (left, right):
            table = table.combine_chunks()
            bodies = _weighted(table["text"].chunk(0), table["dfs"].chunk(0), documents, powers) if table.num_rows else []
            sides.append((table["node"].to_pylist(), [(root, *body) for root, body in zip(table["root"].to_pylist(), bodies)]))
        (a, one), (b, other) = sides
        links = block_links(one, other, least) if one and other else []
        ends = [pa.array([pick(a[x], b[y]) for x, y, _ in links], pa.string()) for pick in (min, max)]
        return pa.table([*ends, pa.array([v for *_, v in links], pa.float64())], kind.names)

    return written(side(placed.filter("apart"), "_left", "_right").cogroup(side(placed, "_right", "_left")).applyInArrow(compare, kind), "across")


def _unshared(texts: DataFrame, documents: int) -> DataFrame:
    """The weight that each ``node`` has in shingles of no other of ``texts``; bounds its similarity to all of them."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            for row, (shingles, _, weights) in enumerate(_weighted(batch.column(1), batch.column(2), documents, powers)):
                node = pa.array(np.full(len(shingles), row)).cast(pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).take(node), pa.array(shingles.view(np.int64)), pa.array(weights)], kind.names)

    kind = StructType([texts.schema["node"], StructField("shingle", LongType()), StructField("w", DoubleType())])
    alone = texts.select("node", "text", "dfs").mapInArrow(spread, kind).groupBy("shingle").agg(F.count("*").alias("n"), F.first("node").alias("node"), F.first("w").alias("w"))
    return alone.filter("n = 1").groupBy("node").agg(F.sum("w").alias("unshared"))


def near_duplicates(docs: DataFrame, least: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """Classes of near duplicates, and the verified links between different texts.

    The first frame has per document ``doc_id``, ``node`` (its text's hash), ``class_id`` (the least
    ``doc_id`` of its class) and ``kept`` (whether it is that document). The second has ``a``, ``b``
    (nodes) and ``similarity``. Equal texts are one node and never paired.

    Texts that agree in a band are a bucket, and candidates if enough samples agree. First each text of a
    bucket is compared with one of them. Where a bucket then holds several classes, texts go that have
    too much of their own to be near any other; of the rest, those outside the bucket's largest class are
    compared with all texts of the bucket, in blocks, without a row per pair. So every pair of a bucket is compared, in one class already, or ruled out, and a class does not
    depend on which text came first. Links are those found on the way: enough to join each class.

    Very long texts are compared as a whole, in a block of their own. A null text counts as empty; empty and blank texts are copies of each other where equal, and have
    no links. Texts under five words are one shingle. A null ``doc_id`` loses against any other. Rows
    equal in ``doc_id`` and text are all kept or all not. An empty table gives no rows. Other columns
    are ignored.
    """
    texts = docs.select("doc_id", F.md5(whole()).alias("node"), whole().alias("text"))
    documents, chars = texts.agg(F.count("*"), F.coalesce(F.sum(_chars()), F.lit(0))).first()
    signed = written(_signatures(texts, documents, chars), "signatures")
    firsts = [F.first(c).alias(c) for c in ("weight", "bands", "sketch")]
    nodes = signed.groupBy("node").agg(F.min("doc_id").alias("first"), F.count("*").alias("_copies"), *firsts)
    spread = nodes.select("node", "weight", "sketch", F.explode("bands").alias("bucket"))
    starts = spread.groupBy("bucket").agg(F.min("node").alias("_lead"), F.count("*").alias("_n")).filter("_n > 1")
    starts = written(starts.withColumnRenamed("bucket", "_bucket"), "starts")
    buckets = join_spread(spread, starts, "bucket", "_n", BUSY, ["node"]).drop("_bucket", "_n")
    buckets = written(buckets.withColumn("unshared", F.lit(0.0)), "buckets")
    bodies = texts.join(buckets.select("node").distinct(), "node", "left_semi").dropDuplicates(["node"])
    frequencies = signed.groupBy("node").agg(F.first("dfs").alias("dfs"))
    bodies = written(bodies.select("node", "text").join(frequencies, "node"), "bodies")

    def candidates(left: DataFrame, right: DataFrame) -> DataFrame:
        """Pairs of one bucket that can be as near as asked; ``right`` has ``b``, both the columns of a bucket."""
        right = right.withColumnsRenamed({"weight": "_w", "sketch": "_s", "unshared": "_u"})
        shared = F.least(F.col("weight") - F.col("unshared"), F.col("_w") - F.col("_u"))
        near = shared * (1 + _SLACK) >= least * (F.col("weight") + F.col("_w") - shared)
        alike = near & (F.col("a") != F.col("b")) & (agreements(F.col("sketch"), F.col("_s")) >= AGREEING)
        if "root" in left.columns:
            right = right.withColumnRenamed("root", "_r")
            alike = alike & (F.col("root") != F.col("_r"))
        pairs = left.join(right, "bucket").filter(alike)
        return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    def leads(rows: DataFrame) -> DataFrame:
        return rows.filter(F.col("node") == F.col("_lead")).withColumnRenamed("node", "a").drop("_lead")

    def others(rows: DataFrame) -> DataFrame:
        return rows.withColumnRenamed("node", "b").drop("_lead")

    done = written(candidates(leads(buckets), others(buckets)), "edges")
    links = written(_verified(done, bodies, documents, least), "verified")
    rooted = written(components(links), "roots")
    members = buckets.drop("_lead")
    for turn in range(STARS + 1):
        # The buckets that hold more than one class.
        placed = members.join(rooted, "node", "left").withColumn("root", F.coalesce("root", "node"))
        in_class = placed.groupBy("bucket", "root").agg(F.count("*").alias("n"), F.min_by("node", F.xxhash64("node", F.lit(turn))).alias("node"))
        largest = F.max_by("root", F.struct("n", "root")).alias("_largest")
        several = in_class.groupBy("bucket").agg(largest, F.min_by("node", F.xxhash64("node", F.lit(turn))).alias("_lead"), F.count("*").alias("_c")).filter("_c > 1")
        open_ = written(placed.join(several, "bucket").drop("_c"), "open")
        if open_.isEmpty():
            break
        if turn == 0:
            own = _unshared(bodies.join(open_.select("node").distinct(), "node", "left_semi"), documents)
            own = open_.drop("unshared", "root", "_largest", "_lead").join(own, "node", "left").withColumn("unshared", F.coalesce("unshared", F.lit(0.0)))
            members = written(own.filter(F.col("unshared") <= (1 - least) * F.col("weight") * (1 + _SLACK)), "open")
            continue
        if turn == STARS:
            links = links.unionAll(_across(open_, bodies, documents, least))
        else:
            open_ = open_.drop("_largest")
            new = written(candidates(leads(open_), others(open_)).join(done, ["a", "b"], "left_anti"), "edges")
            links, done = links.unionAll(written(_verified(new, bodies, documents, least), "verified")), done.unionAll(new)
        rooted = written(components(links), "roots")
    classed = nodes.select("node", "first", "_copies").join(rooted, "node", "left").withColumn("root", F.coalesce("root", "node"))
    heads = classed.groupBy("root").agg(F.min(F.struct(F.col("first").isNull(), "first", "node")).alias("_head"))
    classed = classed.join(heads, "root").select(F.col("node").alias("_node"), "_copies", F.col("_head.first").alias("class_id"), F.col("_head.node").alias("_kept"))
    placed = join_spread(signed.select("doc_id", "node"), written(classed, "classes"), "node", "_copies", BUSY, ["doc_id"])
    kept = (F.col("node") == F.col("_kept")) & F.col("doc_id").eqNullSafe(F.col("class_id"))
    return placed.select("doc_id", "node", "class_id", kept.alias("kept")), links


def keep_one(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` with one document of each class, with all their columns.

    Of rows equal in ``doc_id`` and text one stays.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]
    rows = docs.toDF(*names)
    text, doc_id = (F.col(names[docs.columns.index(c)]) for c in ("text", "doc_id"))
    classes, _ = near_duplicates(docs, least)
    kept = classes.filter("kept").select(F.col("doc_id").alias("_id"), F.col("node").alias("_node")).distinct()
    same = doc_id.eqNullSafe(F.col("_id")) & (F.md5(F.coalesce(text, F.lit(""))) == F.col("_node"))
    return rows.join(kept, same).dropDuplicates(["_id", "_node"]).select(*names).toDF(*docs.columns)
