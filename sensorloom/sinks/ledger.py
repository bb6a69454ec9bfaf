"""Small durable records next to a checkpoint: what a batch has finished, and where the next one goes on."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

from sensorloom.session import shared_file_system


def put_record(spark: SparkSession, path: str, record: dict) -> None:
    """Store ``record`` at ``path``, whole or not at all; an older one there is replaced."""
    store, at = shared_file_system(spark, path)
    folder, name = path.rsplit("/", 1)
    draft = at(f"{folder}/_{name}.draft")
    store.mkdirs(at(folder))
    out = store.create(draft, True)
    try:
        out.write(json.dumps(record).encode())
    finally:
        out.close()
    store.delete(at(path), False)
    if not store.rename(draft, at(path)):
        raise OSError(f"could not store {path}")


def get_record(spark: SparkSession, path: str) -> dict | None:
    store, at = shared_file_system(spark, path)
    if not store.exists(at(path)):
        return None
    stream = store.open(at(path))
    try:
        return json.loads(bytes(stream.readAllBytes()))
    finally:
        stream.close()


def numbered(spark: SparkSession, folder: str) -> list[int]:
    """The numbers N of the entries ``batch=N`` of a folder, in order."""
    store, at = shared_file_system(spark, folder)
    if not store.exists(at(folder)):
        return []
    names = [entry.getPath().getName() for entry in store.listStatus(at(folder))]
    return sorted(int(n.removeprefix("batch=")) for n in names if n.startswith("batch="))


def forget(spark: SparkSession, folder: str, before: int) -> None:
    """Delete the entries of all batches before this one."""
    store, at = shared_file_system(spark, folder)
    for n in numbered(spark, folder):
        if n < before:
            store.delete(at(f"{folder}/batch={n}"), True)
