import math

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from sensorloom.operators import codec
from sensorloom.schemas import READING

WHOLE = '{"sensor_id":"a","temperature":21.5,"humidity":50.1,"timestamp":"2025-07-01T00:00:00Z"}'

# message -> (sensor_id, temperature, humidity, timestamp), valid
CASES = {
    WHOLE: (("a", 21.5, 50.1, "2025-07-01T00:00:00Z"), True),
    "not json": ((None, None, None, None), False),
    "null": ((None, None, None, None), False),
    '{"sensor_id":"b","temperature":"hot","humidity":50,"timestamp":"x"}': (("b", None, 50.0, "x"), False),
    '{"sensor_id":"b","temperature":"22.5","humidity":50}': (("b", None, 50.0, None), False),
    '{"sensor_id":"c"}': (("c", None, None, None), False),
    "": ((None, None, None, None), False),
    None: ((None, None, None, None), False),
    '[{"sensor_id":"d","temperature":1.0}]': ((None, None, None, None), False),
    '{"sensor_id":7,"temperature":NaN,"humidity":1e400,"extra":1}': (("7", math.nan, math.inf, None), False),
    '{"Sensor_ID":"e","temperature":1}': ((None, 1.0, None, None), False),
    '{"sensor_id":"f","temperature":1': ((None, None, None, None), False),
    '{"sensor_id":"g","temperature":NaN,"humidity":1,"timestamp":"x"}': (("g", math.nan, 1.0, "x"), False),
    '{"sensor_id":"h","temperature":1e400,"humidity":1,"timestamp":"x"}': (("h", math.inf, 1.0, "x"), False),
    '{"sensor_id":"h","temperature":1e400,"humidity":1,"timestamp":"2025-07-01T00:00:00Z"}': (("h", math.inf, 1.0, "2025-07-01T00:00:00Z"), True),
    '{"sensor_id":"i\\\\","temperature":1,"humidity":1,"timestamp":"2025-07-01T00:00:00Z"}': (("i\\", 1.0, 1.0, "2025-07-01T00:00:00Z"), False),
}


def _same(got, wanted):
    if isinstance(wanted, float) and got is not None:
        return (math.isnan(got) and math.isnan(wanted)) or got == pytest.approx(wanted, rel=1e-6)
    return got == wanted


@pytest.mark.parametrize("binary", [True, False])
def test_decode_follows_the_contract(spark, binary):
    messages = spark.createDataFrame(list(enumerate(CASES)), "n int, value string")
    if binary:
        messages = messages.withColumn("value", F.col("value").cast("binary"))
    decoded = codec.decode_json(messages, keep=["n"])
    assert decoded.drop("n").schema == READING
    rows = decoded.withColumn("valid", codec.is_valid()).orderBy("n").collect()
    for row, (message, (wanted, valid)) in zip(rows, CASES.items(), strict=True):
        assert all(_same(g, w) for g, w in zip(row[1:5], wanted, strict=True)), message
        assert row["valid"] is valid, message


def test_split_valid_is_complete_and_disjoint(spark):
    messages = spark.createDataFrame(list(enumerate(CASES)), "n int, value string")
    decoded = codec.decode_json(messages, keep=["n"])
    valid, rejected = codec.split_valid(decoded)
    good, bad = ({row["n"] for row in part.collect()} for part in (valid, rejected))
    assert good | bad == set(range(len(CASES))) and not good & bad
    assert good == {n for n, (_, ok) in enumerate(CASES.values()) if ok}


@settings(max_examples=10, deadline=None)
@given(
    st.lists(
        st.tuples(
            st.text(st.characters(codec="utf-8", exclude_characters="\x00"), max_size=8),
            st.floats(width=32, allow_nan=False, allow_infinity=False),
            st.floats(width=32, allow_nan=False, allow_infinity=False),
            st.just("2025-07-01T00:00:00Z"),
        ),
        min_size=1,
        max_size=20,
    )
)
def test_decode_undoes_encode(spark, rows):
    readings = spark.createDataFrame(rows, READING)
    back = codec.decode_json(codec.encode_json(readings))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, readings.collect()))


def test_scored_columns(spark):
    scored = spark.createDataFrame([(1.0, "t", 1.5, 2.5, "s")], "prediction double, timestamp string, humidity float, temperature float, sensor_id string")
    out = codec.scored_columns(scored)
    assert out.columns == ["timestamp", "sensor_id", "temperature", "humidity", "is_anomaly_predicted"]
    assert tuple(out.first()) == ("t", "s", 2.5, 1.5, 1)
    assert dict(out.dtypes)["is_anomaly_predicted"] == "int"


T0 = "2025-07-01T00:00:00Z"
NANOS = "1751328000000000000"
LINES = [
    (("plain", 1.5, 2.0, T0), f"sensor_measurement,sensor_id=plain temperature=1.5,humidity=2.0 {NANOS}"),
    (("a,b c=d", 1.5, 2.0, T0), rf"sensor_measurement,sensor_id=a\,b\ c\=d temperature=1.5,humidity=2.0 {NANOS}"),
    (("two\nlines", 1.5, 2.0, T0), rf"sensor_measurement,sensor_id=two\nlines temperature=1.5,humidity=2.0 {NANOS}"),
    (("s", None, 2.0, T0), f"sensor_measurement,sensor_id=s humidity=2.0 {NANOS}"),
    (("s", math.nan, 2.0, T0), f"sensor_measurement,sensor_id=s humidity=2.0 {NANOS}"),
    (("s", 1.5, -math.inf, T0), f"sensor_measurement,sensor_id=s temperature=1.5 {NANOS}"),
    (("s", None, math.inf, T0), None),
    ((None, 1.5, None, T0), f"sensor_measurement temperature=1.5 {NANOS}"),
    (("", 1.5, None, T0), f"sensor_measurement temperature=1.5 {NANOS}"),
    (("s", 1.5, None, "no time"), "sensor_measurement,sensor_id=s temperature=1.5"),
    (("a\\", 1.5, 2.0, T0), None),
    (("s", 0.1, None, T0), f"sensor_measurement,sensor_id=s temperature=0.10000000149011612 {NANOS}"),
]


def test_line_protocol(spark):
    rows = spark.createDataFrame([(n, *row) for n, (row, _) in enumerate(LINES)], "n int, " + "sensor_id string, temperature float, humidity float, timestamp string")
    lines = {row["n"]: row["line"] for row in codec.to_line_protocol(rows, keep=["n"]).collect()}
    assert lines == {n: line for n, (_, line) in enumerate(LINES) if line}


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_line_time_does_not_depend_on_the_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        row = spark.sql(f"select 's' as sensor_id, 1f as temperature, 1f as humidity, '{T0}' as timestamp, timestamp_ntz'2025-07-01 00:00:00.000001' as ts")
        assert codec.to_line_protocol(row).first()[0].endswith(NANOS)
        assert codec.to_line_protocol(row, ts="ts").first()[0].endswith("1751328000000001000")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_latest_per_point(spark):
    rows = spark.createDataFrame([("a", "t", 1, 1.0), ("a", "t", 3, None), ("a", "t", 2, 2.0), ("a", "t", 4, math.nan), ("b", "t", 1, 4.0), ("c", "t", 1, None)], "sensor_id string, timestamp string, id int, temperature float")
    kept = codec.latest_per_point(rows, ["sensor_id", "timestamp"], "id", ["temperature"])
    assert sorted(map(tuple, kept.collect())) == [("a", "t", 2.0), ("b", "t", 4.0), ("c", "t", None)]
