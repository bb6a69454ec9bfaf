"""The jobs: train a model from history, score a stream, only persist it, or watch it.

    spark-submit --py-files sensorloom.zip sensorloom/plans/jobs.py train --history ... --model ...

Connection settings are arguments; none has a default that leads to a live system.
"""

from __future__ import annotations

import argparse
import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from sensorloom.functions.numbers import any_of, is_missing
from sensorloom.functions.times import from_iso
from sensorloom.operators.codec import decode_json, split_valid
from sensorloom.operators.detecting import STUCK_READINGS
from sensorloom.operators.evaluating import evaluate
from sensorloom.operators.modeling import load_model, save_model, score, train
from sensorloom.operators.splitting import split_keyed, split_random
from sensorloom.schemas import FEATURES, LABEL, LINE, READING, REJECTED, SCORED
from sensorloom.session import scratch_scope, session, written
from sensorloom.sinks import stores
from sensorloom.sinks.compaction import compact_store
from sensorloom.sinks.timeseries import TimeSeriesDataSource
from sensorloom.sources.files import csv_source, file_stream
from sensorloom.sources.kafka import kafka_source
from sensorloom.streaming.eventtime import DELAY, rollup_stream
from sensorloom.streaming.fanout import run_stream
from sensorloom.streaming.profiles import profile_stream
from sensorloom.streaming.stuck import stuck_runs_stream


#: In how many parts a history is laid out by default: the same on every machine, as the forest depends on it.
PARTITIONS = 64
#: The jobs that store the stream, and all that read it.
STORING = ("score", "persist")
STREAMS = (*STORING, "hours", "profile", "stuck")


def train_job(
    spark: SparkSession,
    history: str,
    model_path: str,
    split_key: str | None = "sensor_id,timestamp",
    partitions: int | None = None,
    **training: int | bool,
) -> DataFrame:
    """Train on four fifths of a CSV history, store the model, and return its quality on the rest.

    The parts are chosen by the hash of ``split_key``, one or more columns; without one at random, which
    differs from layout to layout. Accuracy and the weighted F1 are reported as numbers and in percent. The columns in use are
    written once, since training alone reads its input several times and CSV is slow to read. With a key, rows are laid
    out by it in ``partitions`` parts (``PARTITIONS`` by default), so the same history gives the same forest anywhere.
    Rows without a label or a feature cannot be trained on and are counted as ``unusable``.
    """
    with scratch_scope(spark):
        key = F.concat_ws("|", *split_key.split(",")) if split_key else F.lit(None)
        rows = written(csv_source(spark, history).select(*FEATURES, LABEL, key.alias("_key")), "history")
        needed = [*FEATURES, LABEL]
        usable = rows.dropna(subset=needed)
        train_part, test_part = split_keyed(usable, "_key") if split_key else split_random(usable)
        laid_out = {"key": "_key", "partitions": partitions or PARTITIONS} if split_key else {"partitions": partitions}
        model = train(train_part, **laid_out, **training)
        save_model(model, model_path)
        quality = evaluate(score(model, test_part)).first()
        unusable = F.count_if(any_of(is_missing(F.col(c)) for c in needed))
        total, bad = rows.agg(F.count("*"), unusable).first()
    measures = quality.asDict()
    tested = measures.pop("readings")
    report = {"rows": total, "unusable": bad, "train_rows": total - bad - tested, "test_rows": tested, **measures}
    report |= {f"{name}_percent": f"{100 * measures[name]:.2f}%" for name in ("accuracy", "f1_weighted")}
    return spark.createDataFrame([report]).select(*report)


def _messages(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.files:
        return file_stream(spark, args.files)
    return kafka_source(spark, args.servers, args.topic, args.starting, args.max_offsets)


def _sinks(spark: SparkSession, args: argparse.Namespace, scored: bool) -> list[stores.Sink]:
    kinds = [("processed_data", stores.valid_rows)] + ([("anomalies", stores.anomalous_rows)] if scored else [])
    if args.documents_uri:
        sinks = [stores.document_store(name, rows, args.documents_uri, args.database, args.document_id) for name, rows in kinds]
    else:
        dated = "timestamp" if args.by_day else None
        sinks = [stores.Sink(name, rows, path=f"{args.out}/{name}", dated=dated) for name, rows in kinds]
    if args.series_url:
        spark.dataSource.register(TimeSeriesDataSource)
        token = os.environ.get("SERIES_TOKEN", "")
        sinks.append(stores.series_store(args.series_url, args.series_org, args.series_bucket or "", token, f"{args.out}/refused"))
    else:
        sinks.append(stores.series(f"{args.out}/series"))
    return [*sinks, stores.rejected(f"{args.out}/rejected")]


def _stream_arguments(stream: argparse.ArgumentParser, out: str) -> None:
    stream.add_argument("--out", required=True, help=out)
    stream.add_argument("--checkpoint", required=True)
    stream.add_argument("--files", help="folder of message files, instead of a topic")
    stream.add_argument("--servers")
    stream.add_argument("--topic")
    stream.add_argument("--starting", default="latest", help="where a first start begins: latest, earliest, or offsets as JSON")
    stream.add_argument("--max-offsets", type=int, help="messages in a batch at most")
    stream.add_argument("--trigger-interval", help="time between batches, such as '1 minute'; none by default")
    stream.add_argument("--until-caught-up", action="store_true", help="stop after what is there now")


def _readings(messages: DataFrame) -> DataFrame:
    """The valid readings of a stream of messages, with their time as a timestamp ``ts``."""
    valid, _ = split_valid(decode_json(messages))
    return valid.withColumn("ts", from_iso(F.col("timestamp")))


def _watch(args: argparse.Namespace, messages: DataFrame, trigger: dict | None) -> StreamingQuery:
    """Start one of the jobs that read the stream without storing it."""
    readings = _readings(messages)
    if args.job == "hours":
        return rollup_stream(readings, args.out, args.checkpoint, ts="ts", delay=args.delay, trigger=trigger)
    if args.job == "profile":
        return profile_stream(readings, args.out, args.checkpoint, trigger=trigger)
    return stuck_runs_stream(
        readings, args.out, args.checkpoint, id="timestamp", value=args.value, min_readings=args.min_readings,
        trigger=trigger, delay=args.delay, late=f"{args.out.rstrip('/')}.late",
    )


def _arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="sensorloom")
    jobs = parser.add_subparsers(dest="job", required=True)
    training = jobs.add_parser("train", help="train and store the model")
    training.add_argument("--history", required=True, help="CSV files with a header")
    training.add_argument("--model", required=True)
    training.add_argument("--split-key", default="sensor_id,timestamp", help="columns whose hash parts the rows; empty for a random split")
    training.add_argument("--partitions", type=int)
    training.add_argument("--most-rows", type=int, help="fit on about so many rows at most, chosen by the hash of the split key")
    training.add_argument("--combine-equal", action="store_true", help="train on distinct readings with weights")
    for name, text in (("score", "score the stream and store the results"), ("persist", "store the stream unscored")):
        stream = jobs.add_parser(name, help=text)
        _stream_arguments(stream, "folder for path-based stores and rejected messages")
        stream.add_argument("--documents-uri", default=os.environ.get("DOCUMENTS_URI"), help="or in DOCUMENTS_URI")
        stream.add_argument("--database")
        stream.add_argument("--document-id", default="sensor_id,timestamp", help="columns that name a document, so that a replay replaces it; empty to append")
        stream.add_argument("--series-url", help="its token is read from SERIES_TOKEN")
        stream.add_argument("--series-org", default="")
        stream.add_argument("--series-bucket")
        stream.add_argument("--by-day", action="store_true", help="lay the folders of readings out by day and time")
        stream.add_argument("--distinct", default="", help="columns that name a reading, such as sensor_id,timestamp; one that was sent again is stored once")
        stream.add_argument("--delay", default=DELAY, help="how much older than the newest reading one may arrive, for --distinct")
        if name == "score":
            stream.add_argument("--model", required=True)
    hours = jobs.add_parser("hours", help="figures per sensor and hour, given out when the hour is closed")
    _stream_arguments(hours, "folder of the figures")
    hours.add_argument("--delay", default=DELAY, help="how much older than the newest reading one may arrive")
    profile = jobs.add_parser("profile", help="keep each sensor's daily profile up to date")
    _stream_arguments(profile, "folder of the profile")
    stuck = jobs.add_parser("stuck", help="alerts of stuck sensors")
    _stream_arguments(stuck, "folder of the alerts; late readings go to a folder beside it")
    stuck.add_argument("--delay", default=DELAY, help="how much older than the newest reading one may arrive and take its place")
    stuck.add_argument("--min-readings", type=int, default=STUCK_READINGS)
    stuck.add_argument("--value", choices=FEATURES, default=FEATURES[0], help="what is watched for repeats")
    compacting = jobs.add_parser("compact", help="merge the folders of a store's older batches")
    compacting.add_argument("--out", required=True, help="folder of the path-based stores")
    compacting.add_argument("--store", required=True, choices=["processed_data", "anomalies", "series", "rejected"])
    compacting.add_argument("--by-day", action="store_true", help="the store is laid out by day")
    compacting.add_argument("--unscored", action="store_true", help="the store holds readings without a prediction")
    return parser


def _checked(parser: argparse.ArgumentParser, argv: Sequence[str] | None) -> argparse.Namespace:
    """The arguments, or an error before anything starts if some that need each other are not there."""
    args = parser.parse_args(argv)
    if args.job == "train" and args.most_rows and not args.split_key:
        parser.error("--most-rows needs --split-key")
    if args.job in STREAMS:
        if not args.files and not (args.servers and args.topic):
            parser.error("give --servers and --topic, or --files")
        if args.job in STORING and args.documents_uri and not args.database:
            parser.error("--documents-uri needs --database")
        if args.job in STORING and (args.series_url or "").startswith("http") and not args.series_bucket:
            parser.error("--series-url needs --series-bucket")
        if args.trigger_interval and args.until_caught_up:
            parser.error("--trigger-interval and --until-caught-up exclude each other")
    return args


def main(argv: Sequence[str] | None = None) -> None:
    args = _checked(_arguments(), argv)
    spark = session(f"sensorloom-{args.job}")
    if args.job == "train":
        bound = {"most_rows": args.most_rows} if args.most_rows else {}
        train_job(spark, args.history, args.model, args.split_key or None, args.partitions, combine_equal=args.combine_equal, **bound).show(truncate=False)
        return
    if args.job == "compact":
        schema, file_format = {"series": (LINE, "text"), "rejected": (REJECTED, "parquet")}.get(args.store, (READING if args.unscored else SCORED, "parquet"))
        print(compact_store(spark, f"{args.out}/{args.store}", schema, file_format, dated="timestamp" if args.by_day else None))
        return
    trigger = {"processingTime": args.trigger_interval} if args.trigger_interval else None
    trigger = {"availableNow": True} if args.until_caught_up else trigger
    messages = _messages(spark, args).select(F.col("value"))
    if args.job not in STORING:
        _watch(args, messages, trigger).awaitTermination()
        return
    model = load_model(spark, args.model) if args.job == "score" else None
    sinks = _sinks(spark, args, scored=model is not None)
    repeats = {"distinct": tuple(args.distinct.split(",")), "delay": args.delay} if args.distinct else {}
    run_stream(messages, sinks, args.checkpoint, model, f"{args.out}/metrics", trigger, **repeats).awaitTermination()


if __name__ == "__main__":
    main()
