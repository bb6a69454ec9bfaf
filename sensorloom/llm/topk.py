"""Exact top-k inner products by a pivot-distance index.

Every row is keyed by its nearest pivot and its distance from it; a pivot's rows are cut by distance into
annuli, whose number of rows, extreme distances and largest norm make up the index's directory. For a query
at distance D from a pivot, a row at distance r is at least |D - r| away (triangle inequality), and as
``2 q.x = |q|^2 + |x|^2 - |q - x|^2``, no row of an annulus can score more than its bound. A query
expands annuli in the order of their bounds, a few first and more in each round, and stops once
the next bound is below its k-th best score. Only pivots are fitted on a sample; every row is indexed and
no answer is approximate.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from sensorloom.llm.vectors import LONGEST, MOST_PARTITIONS, QUERY_BLOCK, SCALE, block_rows, bucket, first_best, id_order, matrix, whole_vectors
from sensorloom.operators.ordering import spread_join
from sensorloom.session import written

NEIGHBOURS = 5
QUERY_EVERY = 50
#: Rows that pivots are fitted on, most pivots, and most annuli of a pivot: the directory has their product at most.
SAMPLE, MOST_PIVOTS, MOST_RINGS = 4096, 64, 64
ROWS_PER_PIVOT = 4096
#: Rows that a query expands at least in its first round, and how much more in each further one.
FIRST_ROWS, MORE = 2048, 8
#: Vectors turned into distances or scores at a time.
SLICE = 256


def fit_pivots(sample: np.ndarray, count: int, rounds: int = 8) -> np.ndarray:
    """Centres of the sample: far-apart vectors, moved to the mean of those nearest to them."""
    sample = sample.astype(np.float64)
    pivots, away = sample[:1], np.full(len(sample), np.inf)
    while len(pivots) < min(count, len(sample)):
        away = np.minimum(away, ((sample - pivots[-1]) ** 2).sum(1))
        pivots = np.vstack([pivots, sample[away.argmax()]])
    for _ in range(rounds):
        near = distances(sample, pivots).argmin(1)
        pivots = np.array([sample[near == i].mean(0) if (near == i).any() else p for i, p in enumerate(pivots)])
    return pivots


def distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of all vectors from all pivots; components that one side lacks are zero."""
    width = max(vectors.shape[1], pivots.shape[1])
    vectors, pivots = (np.pad(x.astype(np.float64), ((0, 0), (0, width - x.shape[1]))) for x in (vectors, pivots))
    parts = [np.sqrt(((vectors[i : i + SLICE, None] - pivots) ** 2).sum(2)) for i in range(0, len(vectors), SLICE)]
    return np.concatenate(parts) if parts else np.zeros((0, len(pivots)))


def products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers; beyond a long the nearest long."""
    width = min(queries.shape[1], rows.shape[1])
    queries, rows = queries[:, :width], rows[:, :width]
    bound = width * max((max(abs(int(x.min())), abs(int(x.max()))) if x.size else 0) for x in (queries, rows)) ** 2
    if bound < 1 << 53:  # sums of whole numbers this small are exact in floating point
        return (queries.astype(np.float64) @ rows.T.astype(np.float64)).astype(np.int64)
    if bound <= LONGEST:
        return queries @ rows.T
    wide = queries.astype(object) @ rows.T.astype(object)
    return np.clip(wide, -LONGEST, LONGEST).astype(np.int64)


def upper_bounds(to_pivots: np.ndarray, norms: np.ndarray, cells: dict[str, np.ndarray]) -> np.ndarray:
    """For each query and cell a number that no score of the cell exceeds; rounding is allowed for."""
    away = to_pivots[:, cells["pivot"]]
    apart = np.maximum(np.maximum(cells["least"] - away, away - cells["most"]), 0)
    apart = np.maximum(apart - 1e-9 * (away + cells["most"] + 1), 0)
    squares = norms[:, None] + cells["norm"]
    return (squares - apart**2) / 2 + 1e-9 * (squares + 1)


def _key_rows(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``rows`` with the nearest pivot, the distance from it and the squared norm."""
    kind = rows.schema

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4 * SLICE):
                part = batch.slice(at, 4 * SLICE)
                vectors = matrix(pa.chunked_array([part.column(kind.names.index("vector"))]))
                away = distances(vectors, pivots)
                near = away.argmin(1)
                made = [near.astype(np.int32), away[np.arange(len(near)), near], (vectors.astype(np.float64) ** 2).sum(1)]
                yield pa.RecordBatch.from_arrays([*part.columns, *map(pa.array, made)], [*kind.names, "pivot", "distance", "norm"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kind)
    return rows.mapInArrow(key, f"{schema}, pivot int, distance double, norm double")


def index_rows(rows: DataFrame, n_rows: int, pivots: int | None = None, rings: int | None = None) -> tuple[DataFrame, np.ndarray, dict]:
    """The stored index (``cell`` and ``piece`` beside the rows' columns), the pivots, and the directory of cells.

    A cell is an annulus of a pivot. Cells of many rows, as a very common vector makes them, have pieces by a
    hash of the row. Only the sample, the annuli's borders and the directory reach the driver: ``SAMPLE`` vectors
    and at most ``MOST_PIVOTS * MOST_RINGS`` lines of numbers.
    """
    sample = rows.orderBy(F.xxhash64("row"), "row").limit(SAMPLE).select("vector").toArrow()["vector"]
    centres = fit_pivots(matrix(sample), pivots or min(max(1, n_rows // ROWS_PER_PIVOT), MOST_PIVOTS))
    per_block = block_rows(n_rows)
    rings = rings or min(max(1, n_rows // (len(centres) * per_block)), MOST_RINGS)
    keyed = written(_key_rows(rows, centres), "keyed")
    ring = F.lit(0)
    if rings > 1:
        cuts = keyed.groupBy("pivot").agg(F.percentile_approx("distance", [i / rings for i in range(1, rings)], 10_000).alias("c")).collect()
        borders = F.create_map(*[F.lit(x) for r in cuts for x in (r.pivot, r.c)])
        ring = F.size(F.filter(borders[F.col("pivot")], lambda c: c < F.col("distance")))
    celled = keyed.withColumn("cell", (F.col("pivot") * rings + ring).cast("int"))
    found = celled.groupBy("cell", "pivot").agg(
        F.count("*").alias("rows"), F.min("distance").alias("least"), F.max("distance").alias("most"), F.max("norm").alias("norm")
    ).orderBy("cell").toArrow()
    cells = {c: found[c].to_numpy() for c in found.column_names} | {"pieces": -(-found["rows"].to_numpy() // per_block)}
    piece = F.pmod(F.xxhash64("row"), F.col("pieces")).cast("int")
    placed = celled.join(pieces_of(rows.sparkSession, cells), "cell")
    return placed.select("row", "vec_id", "vector", "cell", piece.alias("piece")), centres, cells


def pieces_of(spark: SparkSession, cells: dict) -> DataFrame:
    """Each cell's number of pieces, to be broadcast: at most ``MOST_PIVOTS * MOST_RINGS`` rows."""
    return F.broadcast(spark.createDataFrame(pa.table({"cell": cells["cell"], "pieces": cells["pieces"]})))


def _expanded(state: DataFrame, pivots: np.ndarray, cells: dict, budget: int) -> DataFrame:
    """A row per query and cell that it expands in this round: all with a bound not below its k-th best score, up to ``budget`` rows."""

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = pa.Table.from_batches([batch.slice(at, SLICE)])
                vectors = matrix(part["vector"])
                bounds = upper_bounds(distances(vectors, pivots), (vectors.astype(np.float64) ** 2).sum(1), cells)
                of, cell, done = [], [], []
                for i, (before, least) in enumerate(zip(part["done"].to_pylist(), part["least"].to_pylist())):
                    order = np.argsort(-bounds[i], kind="stable")[before:]
                    if least is not None:
                        order = order[bounds[i][order] >= least]  # a prefix, as bounds fall
                    taken = order[: 1 + np.searchsorted(np.cumsum(cells["rows"][order]), budget)]
                    of += [i] * len(taken)
                    cell += cells["cell"][taken].tolist()
                    done += [before + len(taken)] * len(taken)
                rows = pa.array(of, pa.int64())
                columns = [part[c].combine_chunks().take(rows) for c in ("row", "vector")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(cell, pa.int32()), pa.array(done, pa.int32())], ["row", "vector", "cell", "done"])

    return state.mapInArrow(expand, "row bigint, vector array<bigint>, cell int, done int")


def _searched(rows: pa.Table, queries: pa.Table, k: int) -> pa.Table:
    rows = rows.take(pa.array(id_order(rows["vec_id"])))
    vectors, number = matrix(rows["vector"]), rows["row"].to_numpy()
    of, at, scores = [], [], []
    for begin in range(0, queries.num_rows, SLICE):
        part = queries.slice(begin, SLICE)
        for i, (row, score) in enumerate(zip(part["row"].to_pylist(), products(matrix(part["vector"]), vectors))):
            others = np.flatnonzero(number != row)
            best = others[first_best(score[others], k)]
            of.append(np.full(len(best), begin + i))
            at.append(best)
            scores.append(score[best])
    of, at, scores = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (of, at, scores))
    return pa.table({"query": queries["row"].take(pa.array(of)), "vec_id": rows["vec_id"].take(pa.array(at)), "score": scores})


def exact_top_k(
    df: DataFrame, is_query: Column | None = None, k: int = NEIGHBOURS, vector: str = "embedding", scale: int = SCALE,
    pivots: int | None = None, rings: int | None = None, first_rows: int = FIRST_ROWS,
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: each query's ``k`` highest inner products with other rows.

    Components become ``floor(scale * x)``. Queries are the rows where ``is_query`` holds (by default those
    whose ``vec_id`` is divisible by ``QUERY_EVERY``); candidates are all rows but the query's own. Ties go to the
    smaller ``vec_id``.

    Vectors that are null or hold a null or non-finite component take no part. A null ``vec_id`` comes last and is
    no query by default. Repeated rows are rows of their own: each finds the other, and each query gives its rows.
    Vectors of different lengths compare as if filled up with zeros; an empty one scores 0. Scores beyond a long
    count as the nearest long. Tables without queries or other rows give no rows; other columns are ignored.
    """
    is_query = F.col("vec_id") % QUERY_EVERY == 0 if is_query is None else is_query
    rows = whole_vectors(df, F.coalesce(is_query, F.lit(False)).alias("asks"), vector=vector, scale=scale)
    n_rows, n_queries = rows.agg(F.count("*"), F.count_if("asks")).first()
    spark, kind = df.sparkSession, "query bigint, vec_id bigint, score bigint"
    ids = rows.filter("asks").select(F.col("row").alias("query"), F.col("vec_id").alias("query_id"))
    best = spark.createDataFrame([], f"{kind}, rank int")
    if n_queries:
        index, centres, cells = index_rows(rows.drop("asks"), n_rows, pivots, rings)
        groups = -(-n_queries // QUERY_BLOCK)
        partitions = min(int(cells["pieces"].sum()) * groups, MOST_PARTITIONS)
        start = {"done": F.lit(0), "least": F.lit(None).cast("bigint")}
        state, budget = rows.filter("asks").select("row", "vector").withColumns(start), first_rows
        order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
        key = ["cell", "piece", "group"]
        while True:
            visits = written(_expanded(state, centres, cells, budget), "visits")
            if visits.isEmpty():
                break
            asked = visits.withColumn("group", bucket(groups)).join(pieces_of(spark, cells), "cell")
            asked = asked.withColumn("piece", F.explode(F.sequence(F.lit(0), (F.col("pieces") - 1).cast("int")))).drop("pieces")
            blocks = asked.select(*key).distinct()
            blocks = written(blocks.select(F.col("cell").alias("_cell"), F.col("piece").alias("_piece"), "group"), "blocks")
            visited = (F.col("cell") == F.col("_cell")) & (F.col("piece") == F.col("_piece"))
            held = spread_join(index, blocks, visited, "inner", ["row"]).repartition(partitions, *key).groupBy(*key)
            found = held.cogroup(asked.repartition(partitions, *key).groupBy(*key)).applyInArrow(lambda r, q: _searched(r, q, k), kind)
            best = found.unionByName(best.drop("rank")).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            best = written(best, "best")
            done = visits.groupBy("row").agg(F.max("done").alias("done"))
            known = best.groupBy(F.col("query").alias("row")).agg(F.min("score").alias("least"), F.count("*").alias("found"))
            least = F.when(F.col("found") == k, F.col("least")).alias("least")
            # A query that expanded nothing has stopped.
            state = state.drop("done", "least").join(done, "row").join(known, "row", "left").select("row", "vector", "done", least)
            state, budget = written(state, "queries"), budget * MORE
    return best.join(ids, "query").select("query_id", "rank", "vec_id", "score")
