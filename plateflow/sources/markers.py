"""The marker files of jobs as a stream: each job that has ended once, when its marker is first seen.

Executors look into the output folders, one or more roots a task; the driver knows the roots and the time only. What a root
has shown is kept in a log below a shared folder, an entry per root and batch, so an offset is a point of time however
many jobs there are. An entry is written before its rows are handed out and never changed: a batch that runs again, or in two
attempts at a time, reads what the first one found. Entries that precede the current batch are folded into one from time
to time.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from plateflow import constants as C
from plateflow.sources.listing import entries

SCHEMA = "sub_id bigint, job_name string, state string, ts timestamp"
#: Entries of a root that are folded into one.
FOLD = 16


@dataclass
class Roots(InputPartition):
    """Output folders (sub_id, root) that one task looks into, for the batch from `start` to `end`."""

    roots: list[tuple[int, str]]
    start: int
    end: int


def _store(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def _read(store, path: str):
    with store.open_input_stream(path) as source:
        return json.loads(source.read())


def _write_once(store, path: str, content) -> None:
    """Write a file unless it is there already, whole or not at all."""
    from pyarrow import fs

    folder, _, name = path.rpartition("/")
    store.create_dir(folder, recursive=True)
    unfinished = f"{folder}/.{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(unfinished) as out:
        out.write(json.dumps(content).encode())
    if isinstance(store, fs.LocalFileSystem):
        try:
            os.link(unfinished, path)  # fails if it exists
        except FileExistsError:
            pass
        os.unlink(unfinished)
    elif store.get_file_info(path).type == fs.FileType.NotFound:
        store.move(unfinished, path)
    else:
        store.delete_file(unfinished)


class _Log:
    """What one root has shown: entries `{tick}.json` of (job, state), and `seen-{tick}.json`, the jobs up to then."""

    def __init__(self, folder: str, sub_id: int):
        from pyarrow import fs

        self.store, top = _store(folder)
        self.folder = f"{top.rstrip('/')}/{sub_id}"
        files = self.store.get_file_info(fs.FileSelector(self.folder, allow_not_found=True))
        names = [info.base_name.removesuffix(".json") for info in files if info.base_name.endswith(".json") and info.base_name[0] != "."]
        self.ticks = sorted(int(name) for name in names if name.isdigit())
        self.folds = sorted(int(name.removeprefix("seen-")) for name in names if name.startswith("seen-"))

    def _path(self, name) -> str:
        return f"{self.folder}/{name}.json"

    def entry(self, tick: int) -> list[list[str]] | None:
        return _read(self.store, self._path(tick)) if tick in self.ticks else None

    def add(self, tick: int, found: list[tuple[str, str]]) -> list[list[str]]:
        """Write an entry unless another attempt has; returns what it holds."""
        _write_once(self.store, self._path(tick), found)
        return _read(self.store, self._path(tick))

    def seen(self, tick: int) -> set[str]:
        """Jobs shown up to a tick; folds the entries if there are many."""
        fold = max((f for f in self.folds if f <= tick), default=None)
        jobs = set(_read(self.store, self._path(f"seen-{fold}"))) if fold is not None else set()
        later = [t for t in self.ticks if t <= tick and (fold is None or t > fold)]
        for t in later:
            jobs.update(job for job, _ in _read(self.store, self._path(t)))
        if len(later) >= FOLD:
            _write_once(self.store, self._path(f"seen-{tick}"), sorted(jobs))
            # Another attempt of this batch may still read these; the next fold removes them.
            for name in [*[f"seen-{f}" for f in self.folds if f < (fold or 0)], *[t for t in self.ticks if t <= (fold or 0)]]:
                try:
                    self.store.delete_file(self._path(name))
                except FileNotFoundError:
                    pass
        return jobs


def _ended(root: str, seen: set[str]) -> Iterator[tuple[str, str]]:
    """(job, state) of the job folders with a marker that were not seen; `error` before `finished`."""
    from pyarrow import fs

    for path, job, _, is_folder in entries(root, may_lack=True):
        if is_folder and job not in seen:
            store, folder = _store(path)
            marks = {mark: f"{folder.rstrip('/')}/{mark}" for mark in (C.MARKER_ERROR, C.MARKER_FINISHED)}
            found = store.get_file_info(list(marks.values()))
            states = [state for state, info in zip(marks, found) if info.type == fs.FileType.File]
            if states:
                yield job, states[0]


class _Reader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.roots, self.log, self.tasks = options["roots"], options["log"], int(options.get("tasks", "8"))
        self.last = 0

    def initialOffset(self) -> dict:
        return {"tick": 0}

    def latestOffset(self) -> dict:
        # A point of time, in milliseconds: offsets grow also across restarts.
        self.last = max(self.last + 1, int(time.time() * 1000))
        return {"tick": self.last}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        import pyarrow.dataset as ds

        store, path = _store(self.roots)
        table = ds.dataset(path, filesystem=store, format="parquet").to_table(columns=["sub_id", "root"])
        rows = sorted(set(zip(table.column("sub_id").to_pylist(), table.column("root").to_pylist())))
        return [Roots(rows[n :: self.tasks], start["tick"], end["tick"]) for n in range(min(self.tasks, len(rows)))]

    def read(self, partition: Roots) -> Iterator[tuple]:
        at = datetime.fromtimestamp(partition.end / 1000, timezone.utc)
        for sub_id, root in partition.roots:
            log = _Log(self.log, sub_id)
            rows = log.entry(partition.end)
            if rows is None:
                found = list(_ended(root, log.seen(partition.start)))
                rows = log.add(partition.end, found) if found else []
            for job, state in rows:
                yield sub_id, job, state, at


class MarkerSource(DataSource):
    """Options: `roots`, a Parquet table (sub_id, root) that is read anew for each batch; `log`, a shared folder; `tasks`."""

    @classmethod
    def name(cls) -> str:
        return "job_markers"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Reader(dict(self.options))


def stream_markers(spark: SparkSession, roots: str, log: str, tasks: int | None = None) -> DataFrame:
    """A stream (sub_id, job_name, state, ts) of the jobs below `roots` that have ended, each once.

    `roots` is a Parquet table (sub_id, root); sub-analyses may be added to it, or taken out, while the stream runs. A sub-analysis
    has one root. `log` is a folder of this stream's own that all executors share, kept as long as its checkpoint.
    """
    spark.dataSource.register(MarkerSource)
    number = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return spark.readStream.format("job_markers").options(roots=roots, log=log, tasks=str(number)).load()
