"""Partition-parallel writes of line protocol to a time-series database.

Each task sends its own partition's lines in requests of 500, so nothing passes through the
driver. The database overwrites a point with equal measurement, tags and time, which makes
retried tasks and replayed batches harmless.

Where ``url`` is no web address but a folder all executors share, the same request bodies are written
there as files, for bulk imports. Tasks write them to a folder beside it, ``<folder>.commits``, and their
commit messages carry the names. The driver's commit first notes in the batch's manifest every name that
may stand in the folder, then deletes what an earlier attempt of the batch has left there, moves the files
of the tasks that count to their places, and ends with the names that stand. So a batch that is replayed,
in however many partitions, stands there once, and one whose commit broke off is put right by its replay.

A request that the database refuses is sent again line by line, and the lines that it still refuses
go to files below ``rejected``, which a replay of the batch replaces; one bad point does not stop the
stream. Without ``rejected`` a refusal is an error.
"""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceStreamArrowWriter,
    WriterCommitMessage,
)

# Fixed value: points per write request.
POINTS_PER_REQUEST = 500
RETRIES = 5


def requests_of(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[list[str]]:
    """Regroup a partition's lines into lists of ``size``; only one list is held at a time."""
    waiting: list[str] = []
    for batch in batches:
        for line in batch.column("line").to_pylist():
            if line is not None:
                waiting.append(line)
            if len(waiting) == size:
                yield waiting
                waiting = []
    if waiting:
        yield waiting


def is_refusal(failure: OSError) -> bool:
    """Whether the server understood the request and will not have its points, however often they are sent."""
    return isinstance(failure, urllib.error.HTTPError) and failure.code in (400, 413, 422)


def send(url: str, params: dict[str, str], token: str, lines: list[str]) -> None:
    """Post one request; wait and retry where the server is busy or unreachable."""
    target = f"{url.rstrip('/')}/api/v2/write?{urllib.parse.urlencode(params)}"
    headers = {"Authorization": f"Token {token}", "Content-Type": "text/plain; charset=utf-8"}
    body = "\n".join(lines).encode()
    for attempt in range(RETRIES + 1):
        try:
            urllib.request.urlopen(urllib.request.Request(target, body, headers), timeout=60).close()
            return
        except OSError as failure:
            final = isinstance(failure, urllib.error.HTTPError) and failure.code < 500 and failure.code != 429
            if final or attempt == RETRIES:
                raise
            time.sleep(2**attempt)


def opened(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a shared folder, and the folder's path there."""
    uri = f"file://{folder.removeprefix('file:')}" if folder.startswith(("/", "file:/")) and not folder.startswith("file://") else folder
    return fs.FileSystem.from_uri(uri)


def put(store: fs.FileSystem, path: str, name: str, lines: Sequence[str]) -> None:
    """Write one file of a folder, whole or not at all; an older one of that name is replaced."""
    store.create_dir(path)
    draft = f"{path}/_{name}.{TaskContext.get().taskAttemptId() if TaskContext.get() else 0}"
    with store.open_output_stream(draft) as out:
        out.write("\n".join(lines).encode())
    store.move(draft, f"{path}/{name}")


@dataclass
class Written(WriterCommitMessage):
    """What one task has written of a batch: files that wait in its staging folder, and files that stand in their place."""

    batch: str
    task: str
    staged: list[str]
    standing: list[str]


class _Folder:
    """A folder in which each batch's files stand once; see the module."""

    def __init__(self, folder: str, batch: str):
        self.store, self.path = opened(folder)
        beside = f"{self.path.rstrip('/')}.commits"
        self.staging, self.manifest = f"{beside}/staging/{batch}", f"{beside}/manifests/{batch}.json"

    def _exists(self, path: str) -> bool:
        return self.store.get_file_info(path).type != fs.FileType.NotFound

    def _note(self, names: Sequence[str]) -> None:
        put(self.store, *self.manifest.rsplit("/", 1), [json.dumps(names)])

    def commit(self, messages: Sequence[Written]) -> None:
        """Let what these tasks have written take the place of all that the batch has here."""
        moves = {f"{self.staging}/{m.task}/{name}": name for m in messages for name in m.staged}
        names = [*moves.values(), *(name for m in messages for name in m.standing)]
        old = []
        if self._exists(self.manifest):
            with self.store.open_input_stream(self.manifest) as noted:
                old = json.loads(noted.read())
        if old or names:
            self._note(sorted({*old, *names}))
            for name in {*old} - {name for m in messages for name in m.standing}:
                if self._exists(f"{self.path}/{name}"):
                    self.store.delete_file(f"{self.path}/{name}")
            self.store.create_dir(self.path)
            for staged, name in moves.items():
                self.store.move(staged, f"{self.path}/{name}")
            self._note(names)
        self.abort()

    def abort(self) -> None:
        """Take away what waits for the batch, files of tasks that failed or came too late included."""
        if self._exists(self.staging):
            self.store.delete_dir(self.staging)


class _Points:
    def __init__(self, options):
        self.url = options["url"]
        self.params = {"org": options.get("org", ""), "bucket": options.get("bucket", ""), "precision": "ns"}
        self.token = options.get("token", "")
        self.size = int(options.get("points", POINTS_PER_REQUEST))
        self.rejected = options.get("rejected")
        self.run, self.batch = options.get("run"), options.get("batch")

    def _batch(self) -> str:
        """What names the batch; a stream that is written directly says so in its tasks' properties."""
        task = TaskContext.get()
        run = self.run or task.getLocalProperty("sql.streaming.queryId") or "run"
        batch = self.batch or task.getLocalProperty("streaming.sql.batchId") or "0"
        return f"{run}-{batch}"

    def _send(self, lines: list[str]) -> list[str]:
        """Send the lines; return those that the database refuses."""
        try:
            send(self.url, self.params, self.token, lines)
        except OSError as failure:
            if not (self.rejected and is_refusal(failure)):
                raise
            if len(lines) == 1:
                return lines
            return [bad for line in lines for bad in self._send([line])]
        return []

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        task, batch, web = TaskContext.get(), self._batch(), self.url.startswith(("http://", "https://"))
        made = Written(batch, str(task.taskAttemptId()), [], [])
        folder = None if web else _Folder(self.url, batch)
        for n, lines in enumerate(requests_of(iterator, self.size)):
            name = f"{batch}-{task.partitionId():05d}-{n:05d}.lp"
            if folder:
                put(folder.store, f"{folder.staging}/{made.task}", name, lines)
                made.staged.append(name)
            elif refused := self._send(lines):
                put(*opened(self.rejected), name, refused)
                made.standing.append(name)
        return made

    def _end(self, messages: Sequence[Written | None], committed: bool) -> None:
        told = [m for m in messages if m is not None]
        target = self.rejected if self.url.startswith(("http://", "https://")) else self.url
        batch = f"{self.run}-{self.batch}" if self.run and self.batch else told[0].batch if told else None
        if batch and target:
            folder = _Folder(target, batch)
            folder.commit(told) if committed else folder.abort()


class _BatchWriter(_Points, DataSourceArrowWriter):
    def commit(self, messages):
        self._end(messages, True)

    def abort(self, messages):
        """Points that a database has stay there; the replayed batch overwrites them."""
        self._end(messages, False)


class _StreamWriter(_Points, DataSourceStreamArrowWriter):
    def commit(self, messages, batchId):
        self._end(messages, True)

    def abort(self, messages, batchId):
        self._end(messages, False)


class TimeSeriesDataSource(DataSource):
    """Format ``timeseries``: a frame with a ``line`` column. Options url, org, bucket, token, points, rejected, run, batch."""

    @classmethod
    def name(cls) -> str:
        return "timeseries"

    def schema(self) -> str:
        return "line string"

    def writer(self, schema, overwrite):
        return _BatchWriter(self.options)

    def streamWriter(self, schema, overwrite):
        return _StreamWriter(self.options)
