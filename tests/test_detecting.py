import math
import random

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from sensorloom.operators import detecting
from sensorloom.operators.ordering import chronological, in_pieces, with_position

SCHEMA = "sensor_id string, ts int, event_id int, temperature double"
PIECES = [(10**6, 1 << 20), (7, 1 << 20), (3, 1 << 20), (1, 1 << 20), (7, 0), (3, 0)]


def _same(a, b):
    return a == b or a != a and b != b


def _runs(values, least):
    """(start index, length, value) of runs of equal non-null values, by walking the list."""
    found, begin = [], 0
    for i in range(1, len(values) + 1):
        if i == len(values) or not _same(values[i], values[begin]):
            if i - begin >= least and values[begin] is not None and values[begin] == values[begin]:
                found.append((begin, i - begin, values[begin]))
            begin = i
    return found


def _frame(spark, histories):
    rows = [(s, t, t, v) for s, values in histories.items() for t, v in enumerate(values)]
    random.Random(5).shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def _walked_stuck(histories, least):
    return sorted((s, b, b + n - 1, n, v) for s, values in histories.items() for b, n, v in _runs(values, least))


def _walked_spikes(histories, n, threshold):
    found = []
    for s, values in histories.items():
        for i, v in enumerate(values):
            trail = values[max(0, i - n) : i]
            if len(trail) < n or not all(x is not None and math.isfinite(x) for x in [*trail, v]):
                continue
            if abs(v - sum(trail) / n) >= threshold:
                found.append((s, i))
    return sorted(found)


VARYING = [20.0 + i % 7 + i * 0.01 for i in range(30)]
HISTORIES = {
    "stuck": VARYING + [21.37] * 15 + VARYING,
    "short": VARYING + [21.37] * 14 + VARYING,
    "spike": VARYING[:25] + [VARYING[25] + 20] + VARYING[26:],
    "spike then stuck": VARYING + [50.0] * 16 + VARYING,
    "to the end": VARYING + [21.37] * 18,
    "interleaved a": [1.0, 2.0] * 20,
    "interleaved b": [2.0, 1.0] * 20,
    "gaps": [5.0] * 10 + [None] * 20 + [5.0] * 10,
    "not numbers": VARYING + [math.nan] * 20 + VARYING,
    "one not a number": VARYING[:25] + [math.nan] + VARYING[26:] + [90.0],
    "infinite": VARYING[:25] + [math.inf] + VARYING[26:] + [-math.inf] + VARYING,
    "always": [3.0] * 40,
    "one": [3.0],
}


@pytest.mark.parametrize(("rows_per_task", "broadcast_bytes"), PIECES)
def test_stuck_runs(spark, rows_per_task, broadcast_bytes):
    found = detecting.stuck_runs(_frame(spark, HISTORIES), rows_per_task=rows_per_task, broadcast_bytes=broadcast_bytes)
    assert sorted(map(tuple, found.collect())) == _walked_stuck(HISTORIES, 15)
    assert {row["sensor_id"] for row in found.collect()} == {"stuck", "spike then stuck", "to the end", "always"}


@pytest.mark.parametrize(("rows_per_task", "broadcast_bytes"), PIECES)
def test_spikes(spark, rows_per_task, broadcast_bytes):
    found = detecting.spikes(_frame(spark, HISTORIES), n=20, threshold=15.0, rows_per_task=rows_per_task, broadcast_bytes=broadcast_bytes)
    assert sorted((r["sensor_id"], r["ts"]) for r in found.collect()) == _walked_spikes(HISTORIES, 20, 15.0)
    assert ("spike", 25) in _walked_spikes(HISTORIES, 20, 15.0)


@pytest.mark.parametrize(("rows_per_task", "broadcast_bytes"), PIECES)
def test_labels(spark, rows_per_task, broadcast_bytes):
    labelled = detecting.label_anomalies(_frame(spark, HISTORIES), n=4, threshold=8.0, min_readings=5, rows_per_task=rows_per_task, broadcast_bytes=broadcast_bytes)
    rows = labelled.collect()
    assert len(rows) == sum(map(len, HISTORIES.values()))
    assert sorted((r["sensor_id"], r["ts"]) for r in rows if r["is_spike"]) == _walked_spikes(HISTORIES, 4, 8.0)
    stuck = [(s, i) for s, b, e, _, _ in _walked_stuck(HISTORIES, 5) for i in range(b, e + 1)]
    assert sorted((r["sensor_id"], r["ts"]) for r in rows if r["is_stuck"]) == sorted(stuck)
    assert all(r["is_anomaly"] == int(r["is_spike"] or r["is_stuck"]) for r in rows)


@settings(max_examples=12, deadline=None)
@given(
    st.dictionaries(st.sampled_from("abc"), st.lists(st.sampled_from([1.0, 2.0, None]), min_size=1, max_size=40), min_size=1),
    st.integers(1, 9),
    st.integers(1, 5),
)
def test_any_cut_gives_the_walked_runs(spark, histories, rows_per_task, least):
    found = detecting.stuck_runs(_frame(spark, histories), min_readings=least, rows_per_task=rows_per_task)
    assert sorted(map(tuple, found.collect())) == _walked_stuck(histories, least)


def test_labels_replace_older_ones(spark):
    rows = _frame(spark, {"s": [1.0] * 3}).withColumn("is_anomaly", F.lit(0))
    labelled = detecting.label_anomalies(rows, min_readings=3)
    assert labelled.columns == ["sensor_id", "ts", "event_id", "temperature", "is_spike", "is_stuck", "is_anomaly"]
    assert [r["is_anomaly"] for r in labelled.collect()] == [1, 1, 1]


def test_a_busy_null_sensor_is_cut_too(spark):
    rows = [(None, i, i, 1.0) for i in range(40)] + [("b", i, 100 + i, 1.0) for i in range(3)]
    found = detecting.stuck_runs(spark.createDataFrame(rows, SCHEMA).repartition(3), rows_per_task=6)
    assert [tuple(r) for r in found.collect()] == [(None, 0, 39, 40, 1.0)]


def test_equal_timestamps_are_ordered_by_the_tie_break(spark):
    rows = [("s", 0, 2, 1.0), ("s", 0, 1, 5.0), ("s", 0, 3, 1.0), ("s", 0, 0, 1.0)]
    found = detecting.stuck_runs(spark.createDataFrame(rows, SCHEMA), min_readings=2)
    assert [(r["readings"], r["temperature"]) for r in found.collect()] == [(2, 1.0)]


@pytest.mark.parametrize("rows_per_task", [100, 4])
def test_one_timestamp_for_a_whole_sensor(spark, rows_per_task):
    rows = [("hot", 0, i, float(i // 10)) for i in range(60)] + [("b", i, 100 + i, 0.0) for i in range(20)]
    found = detecting.stuck_runs(spark.createDataFrame(rows, SCHEMA).repartition(4), min_readings=10, rows_per_task=rows_per_task)
    assert sorted((r["sensor_id"], r["temperature"], r["readings"]) for r in found.collect()) == [
        ("b", 0.0, 20), *[("hot", float(v), 10) for v in range(6)]
    ]


def test_no_piece_is_larger_than_asked(spark):
    rows = [("hot", i // 50, i, 0.0) for i in range(500)] + [("b", i, 1000 + i, 0.0) for i in range(20)]
    cut = in_pieces(spark.createDataFrame(rows, SCHEMA), "sensor_id", ["ts", "event_id"], before=3, after=2, rows_per_task=25)
    sizes = cut.groupBy("sensor_id", "_piece").agg(F.count("*").alias("all"), F.count_if("_own").alias("own")).collect()
    assert max(r["own"] for r in sizes) <= 25 and max(r["all"] for r in sizes) <= 30
    assert sum(r["own"] for r in sizes) == len(rows)


def test_positions_are_exact(spark):
    rows = [(random.Random(i).randrange(50), i) for i in range(5000)]
    placed = with_position(spark.createDataFrame(rows, "ts int, id int").repartition(7), ["ts", "id"])
    assert [(r["ts"], r["id"]) for r in placed.orderBy("position").collect()] == sorted(rows)
    assert [r["position"] for r in placed.orderBy("position").collect()] == list(range(len(rows)))


def test_chronological(spark):
    rows = [("b", "2025-07-01T00:01:00Z"), ("a", "2025-07-01T00:01:00Z"), ("z", "2025-06-30T23:59:59Z")]
    out = chronological(spark.createDataFrame(rows, "sensor_id string, timestamp string")).collect()
    assert [r["sensor_id"] for r in out] == ["z", "a", "b"]
