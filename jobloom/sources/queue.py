"""A durable queue in a shared folder: a sink whose commit publishes, and a stream whose commit acknowledges.

Tasks write messages into segments that nobody knows of yet; a commit names them in
one entry of the log, which appears at once and whole.  An entry's name tells
where its messages stand, so that a reader plans by listing names alone.  Entries of a
publisher's batch have a key: what is committed again under the same key is left out.

A consumer reads at most ``prefetch`` messages that it has not acknowledged.  The
stream's offsets are places in the log, kept in its checkpoint, so a query that is
stopped and started again goes on after the last batch it finished; acknowledgements
are kept beside the log, so that a new query of the same consumer begins where
the last one ended, and what all consumers have acknowledged can be removed.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, DataSourceStreamReader, InputPartition, WriterCommitMessage

from jobloom.runtime import ship
from jobloom.sources.boards import store_of

#: Messages that a task holds before it writes them, and messages of a task's split.
ROWS, SPLIT = 10_000, 50_000
MESSAGE = pa.schema([("body", pa.binary())])
#: Number of the entry, where its messages begin and end, and the key it was committed under.
ENTRY = re.compile(r"(\d{12})-(\d{15})-(\d{15})-(.*)\.json$")


class Log:
    """The log's entries and acknowledgements.  One publisher commits to a folder at a time."""

    def __init__(self, folder: str):
        self.folder = folder.rstrip("/")
        self.store, self.path = store_of(self.folder)

    def entries(self) -> list[tuple[int, int, int, str, str]]:
        """(number, first, end, key, path), in order; names alone are read."""
        found = self.store.get_file_info(fs.FileSelector(f"{self.path}/log", allow_not_found=True))
        named = ((ENTRY.match(x.base_name), x.path) for x in found)
        return sorted((int(m[1]), int(m[2]), int(m[3]), m[4], path) for m, path in named if m)

    def end(self) -> int:
        return max((e[2] for e in self.entries()), default=0)

    def begin(self) -> int:
        """The first place that is still there."""
        entries = self.entries()
        return entries[0][1] if entries else 0

    def put(self, name: str, content: dict) -> None:
        self.store.create_dir(f"{self.path}/{name.rpartition('/')[0]}")
        hidden = f"{self.path}/.{uuid.uuid4().hex}"
        with self.store.open_output_stream(hidden) as out:
            out.write(json.dumps(content).encode())
        self.store.move(hidden, f"{self.path}/{name}")

    def get(self, path: str) -> dict:
        with self.store.open_input_stream(path) as f:
            return json.loads(f.read())

    def publish(self, segments: list[tuple[str, int]], key: str) -> bool:
        """Adds an entry, unless one of that key is there."""
        entries = self.entries()
        if any(e[3] == key for e in entries):
            return False
        segments = [s for s in segments if s[1]]
        number, at = (entries[-1][0] + 1, entries[-1][2]) if entries else (0, 0)
        self.put(f"log/{number:012d}-{at:015d}-{at + sum(n for _, n in segments):015d}-{key}.json", {"segments": segments})
        return True

    def acknowledged(self, consumer: str) -> int:
        name = f"{self.path}/consumers/{consumer}.json"
        return self.get(name)["next"] if self.store.get_file_info(name).type == fs.FileType.File else 0

    def acknowledge(self, consumer: str, place: int) -> None:
        self.put(f"consumers/{consumer}.json", {"next": place})

    def trim(self) -> int:
        """Removes entries that all consumers have acknowledged, with their segments; the last entry stays, as it says where the log ends."""
        told = self.store.get_file_info(fs.FileSelector(f"{self.path}/consumers", allow_not_found=True))
        least = min((self.get(x.path)["next"] for x in told if x.base_name.endswith(".json")), default=0)
        gone = [e for e in self.entries()[:-1] if e[2] <= least]
        for _, _, _, _, path in gone:
            segments = self.get(path)["segments"]
            self.store.delete_file(path)
            for name, _ in segments:
                self.store.delete_file(f"{self.path}/{name}")
        return len(gone)

    def remove(self, names: list[str]) -> None:
        for name in names:
            if self.store.get_file_info(f"{self.path}/{name}").type == fs.FileType.File:
                self.store.delete_file(f"{self.path}/{name}")


@dataclass
class _Segment(WriterCommitMessage):
    name: str
    rows: int


class _Write:
    """Tasks write segments of their own; they count when they are committed."""

    def __init__(self, folder: str):
        self.folder, self.run = folder, uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Segment:
        log, name, rows = Log(self.folder), f"segments/{self.run}-{uuid.uuid4().hex}.parquet", 0
        out = None
        try:
            for batch in iterator:
                body = batch.column(batch.schema.names.index("body")).cast(pa.binary())
                if out is None:
                    log.store.create_dir(f"{log.path}/segments")
                    out = pq.ParquetWriter(f"{log.path}/{name}", MESSAGE, filesystem=log.store)
                out.write_batch(pa.RecordBatch.from_arrays([body], schema=MESSAGE), row_group_size=ROWS)
                rows += len(body)
        except BaseException:
            if out is not None:
                out.close()
            log.remove([name])
            raise
        if out is not None:
            out.close()
        return _Segment(name, rows)

    def publish(self, messages: list[_Segment | None], key: str) -> None:
        segments = [(m.name, m.rows) for m in messages if m is not None]
        if not Log(self.folder).publish(segments, key):
            self.discard(messages)

    def discard(self, messages: list[_Segment | None]) -> None:
        Log(self.folder).remove([m.name for m in messages if m is not None])


class _BatchWriter(_Write, DataSourceArrowWriter):
    def __init__(self, folder: str, key: str | None):
        super().__init__(folder)
        self.key = key or self.run

    def commit(self, messages):
        self.publish(messages, self.key)

    def abort(self, messages):
        self.discard(messages)


class _StreamWriter(_Write, DataSourceStreamArrowWriter):
    def __init__(self, folder: str, publisher: str):
        super().__init__(folder)
        self.publisher = publisher

    def commit(self, messages, batchId):
        self.publish(messages, f"{self.publisher}-{batchId}")

    def abort(self, messages, batchId):
        self.discard(messages)


class _Part(InputPartition):
    def __init__(self, segment: str, skip: int, rows: int, first: int):
        self.segment, self.skip, self.rows, self.first = segment, skip, rows, first


class _Reader(DataSourceStreamReader):
    def __init__(self, options):
        self.folder, self.consumer, self.prefetch = options["path"], options.get("consumer", "default"), max(1, int(options.get("prefetch", 2)))
        self.told: int | None = None
        self.planned = True

    def initialOffset(self):
        log = Log(self.folder)
        return {"next": max(log.begin(), log.acknowledged(self.consumer))}

    def latestOffset(self):
        """Up to ``prefetch`` messages beyond what was planned last.  After a restart that is not known: the acknowledgement may lie one batch behind the checkpoint, so if nothing is planned by what was told, more is."""
        log = Log(self.folder)
        if self.told is None:
            self.told = max(log.begin(), log.acknowledged(self.consumer))
        self.told = min(max(log.end(), self.told), self.told + self.prefetch)
        return {"next": self.told}

    def partitions(self, start, end):
        log, parts = Log(self.folder), []
        first, stop = start["next"], end["next"]
        self.told = max(self.told or 0, stop)
        for _, at, upto, _, path in log.entries():
            if upto <= first or at >= stop:
                continue
            for name, rows in log.get(path)["segments"]:
                a, b = max(at, first), min(at + rows, stop)
                parts += [_Part(name, x - at, min(SPLIT, b - x), x) for x in range(a, b, SPLIT)]
                at += rows
        if sum(p.rows for p in parts) != stop - first:
            raise ValueError(f"messages {first} to {stop} of {self.folder} are not all there any more")
        return parts

    def read(self, partition):
        """The groups of rows that hold the part, no others."""
        log = Log(self.folder)
        with pq.ParquetFile(log.store.open_input_file(f"{log.path}/{partition.segment}")) as file:
            sizes = [file.metadata.row_group(i).num_rows for i in range(file.num_row_groups)]
            begins = [0, *accumulate(sizes)]
            groups = [i for i, n in enumerate(sizes) if begins[i] < partition.skip + partition.rows and partition.skip < begins[i] + n]
            at = begins[groups[0]] if groups else 0
            for batch in file.iter_batches(ROWS, row_groups=groups):
                a, b = max(0, partition.skip - at), min(batch.num_rows, partition.skip + partition.rows - at)
                if a < b:
                    first = partition.first + at + a - partition.skip
                    yield pa.RecordBatch.from_arrays([pa.array(range(first, first + b - a), pa.int64()), batch.column(0).slice(a, b - a)], names=["place", "body"])
                at += batch.num_rows

    def commit(self, end):
        Log(self.folder).acknowledge(self.consumer, end["next"])


class QueueSource(DataSource):
    """``posting_queue``: a stream of messages (place, body), and a sink of messages (body), batch and stream.

    Options: path; to read, consumer and prefetch; to write a stream, publisher; to
    write a batch, key (a batch of the same key is published once).
    """

    @classmethod
    def name(cls):
        return "posting_queue"

    def schema(self):
        return "place bigint, body binary"

    def streamReader(self, schema):
        return _Reader(self.options)

    def writer(self, schema, overwrite):
        return _BatchWriter(self.options["path"], self.options.get("key"))

    def streamWriter(self, schema, overwrite):
        return _StreamWriter(self.options["path"], self.options.get("publisher", "default"))


def register(spark: SparkSession) -> None:
    ship(spark)
    spark.dataSource.register(QueueSource)


def publish(bodies: DataFrame, folder: str, key: str | None = None) -> None:
    """Publishes messages (body: text or bytes), all or none; those of a ``key`` once."""
    register(bodies.sparkSession)
    bodies.select(bodies.body.cast("binary").alias("body")).write.format("posting_queue").mode("append").options(**({"key": key} if key else {})).save(folder)


def incoming(spark: SparkSession, folder: str, consumer: str = "default", prefetch: int = 2) -> DataFrame:
    """The queue's messages (place, body) as a stream, at most ``prefetch`` of them in a batch."""
    register(spark)
    return spark.readStream.format("posting_queue").options(consumer=consumer, prefetch=str(prefetch)).load(folder)
