"""Every registered query against its SQL counterpart, over the same files."""

import math
import os
import time
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries


TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "float": "FLOAT", "double": "DOUBLE",
    "string": "VARCHAR", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
}


def _plain(value):
    return "nan" if isinstance(value, float) and math.isnan(value) else value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


@pytest.fixture(scope="module")
def sql(sf_dir):
    connection = duckdb.connect()
    for table in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"create view {table.stem} as select * from '{table}'")
    return connection


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, sql, sf_dir, name):
    started = time.time()
    result = queries()[name](spark, sf_dir)
    got = _rows(result.columns, result.collect())
    print(f"{name}: {time.time() - started:.2f} s, {len(got)} rows")
    assert got or os.path.basename(sf_dir) == "sf0.001"
    if name in oracle_sql():
        wanted = sql.execute(oracle_sql()[name])
        names = [column[0] for column in wanted.description]
        types = {column[0]: str(column[1]) for column in wanted.description}
        assert {c: TYPES[t] for c, t in result.dtypes} == types
        assert got == _rows(names, wanted.fetchall())


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    found = entry(spark)
    assert found.columns[0] == "event_id"
    assert found.count() > 0
