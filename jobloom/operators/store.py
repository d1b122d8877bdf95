"""The store of postings: files by bucket of the url, versions that appear whole, and access paths to the files.

A version is one small file that lists the data files, a file for each bucket that has rows.  A
save writes new files for the buckets that it changes and then the next version:
untouched buckets keep their files, and a reader has one version or the other.
The version also says which batch of which query it holds, so a batch that comes
again is left out.

Beside each data file stand the least and greatest values and Bloom filters of its
urls and content hashes.  A save opens only files that may hold a key of its batch.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobloom.operators import dedup
from jobloom.runtime import scratch, ship, stored
from jobloom.schemas import POSTING
from jobloom.sources.boards import store_of

#: Bits of a filter for each key, and hashes of a key.
BITS, HASHES = 16, 5
#: Keys of a batch up to which files are chosen by their filters; beyond, all files may hold some, and the keys' columns of all are joined.
MOST_KEYS = 200_000
KEYS = ("url", "content_hash")
ACCESS = "path string, url_low string, url_high string, url_bloom binary, content_hash_low string, content_hash_high string, content_hash_bloom binary"


def hashes(values: list[str]) -> np.ndarray:
    import pandas as pd

    return pd.util.hash_array(np.array(values, object), categorize=False) if values else np.zeros(0, np.uint64)


def _positions(h: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    first, step = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    for i in range(HASHES):
        yield (first + np.uint64(i) * step) & np.uint64(bits - 1)


def bloom(h: np.ndarray) -> bytes:
    bits = 1 << max(10, (len(h) * BITS - 1).bit_length())
    held = np.zeros(bits, bool)
    for at in _positions(h, bits):
        held[at] = True
    return np.packbits(held).tobytes()


def may_hold(filter: bytes, h: np.ndarray) -> np.ndarray:
    """Whether a filter may hold each key; never false for one that it holds."""
    held, found = np.frombuffer(filter, np.uint8), np.ones(len(h), bool)
    for at in _positions(h, len(held) * 8):
        found &= (held[at >> np.uint64(3)] >> (7 - (at & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)
    return found


class PostingStore:
    """Postings (url is unique) in a folder that Spark and pyarrow know.  One writer at a time; the number of buckets is fixed when the store begins."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int = 64, schema: T.StructType = POSTING):
        ship(spark)
        self.spark, self.folder, self.schema = spark, folder.rstrip("/"), schema
        self.files_of, self.path = store_of(self.folder)
        self.now = self._latest() or {"version": 0, "buckets": buckets, "files": {}, "access": [], "batches": {}, "pending": None, "dispositions": None}

    def _names(self) -> list[str]:
        found = self.files_of.get_file_info(fs.FileSelector(f"{self.path}/versions", allow_not_found=True))
        return sorted(x.path for x in found if x.base_name.endswith(".json") and not x.base_name.startswith("."))

    def _get(self, path: str) -> dict:
        with self.files_of.open_input_stream(path) as f:
            return json.loads(f.read())

    def _latest(self) -> dict | None:
        names = self._names()
        return self._get(names[-1]) if names else None

    def refresh(self) -> PostingStore:
        """Looks for a version that another process has published."""
        self.now = self._latest() or self.now
        return self

    def done(self, query: str, number: int) -> bool:
        """Whether a version holds this batch of this query, or a later one."""
        return self.refresh().now["batches"].get(query, -1) >= number

    def bucket(self, url: Column) -> Column:
        return F.pmod(F.xxhash64(url), F.lit(self.now["buckets"])).cast("int")

    def _paths(self, names: list[str]) -> list[str]:
        return [f"{self.folder}/{x}" for x in names]

    def read(self, names: list[str] | None = None) -> DataFrame:
        """Rows of some data files, or of all."""
        names = list(self.now["files"].values()) if names is None else names
        return self.spark.read.schema(self.schema).parquet(*self._paths(names)) if names else self.spark.createDataFrame([], self.schema)

    def access(self) -> DataFrame:
        """The access paths of the present files."""
        if not self.now["access"]:
            return self.spark.createDataFrame([], ACCESS)
        live = self.spark.createDataFrame([(x,) for x in self.now["files"].values()], "path string")
        return self.spark.read.schema(ACCESS).parquet(*self._paths(self.now["access"])).join(live, "path", "left_semi")

    def candidates(self, keys: DataFrame, columns: tuple[str, ...] = KEYS) -> list[str]:
        """Files that may hold one of the values of ``columns`` in ``keys``: by bucket and filter for urls, by filter for hashes.

        Values are tested by their hashes, which are sent to all tasks: at most
        ``MOST_KEYS`` rows; with more rows all files are named.
        """
        if keys.limit(MOST_KEYS + 1).count() > MOST_KEYS:
            return list(self.now["files"].values())
        found = keys.select(*columns).distinct().toArrow()
        wanted = {}
        for c in columns:
            values = sorted(v for v in found.column(c).to_pylist() if v is not None)
            wanted[c] = (values[0], values[-1], hashes(values)) if values else None
        sent = self.spark.sparkContext.broadcast(wanted)

        def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hit = []
                for row in batch.to_pylist():
                    ways = [(row[f"{c}_low"], row[f"{c}_high"], row[f"{c}_bloom"], *w) for c, w in sent.value.items() if w is not None]
                    if any(a is not None and a <= high and low <= b and may_hold(f, h).any() for a, b, f, low, high, h in ways):
                        hit.append(row["path"])
                yield pa.RecordBatch.from_arrays([pa.array(hit, pa.string())], names=["path"])

        return sorted(r.path for r in self.access().mapInArrow(test, "path string").collect())

    def existing(self, rows: DataFrame, key: str) -> DataFrame:
        """Rows whose key (url or content_hash) the store has."""
        held = self.read(self.candidates(rows.select(key), (key,))).select(F.col(key).alias("held"))
        return rows.join(held, rows[key] == held.held, "left_semi")

    def _described(self, names: list[str]) -> DataFrame:
        """Access paths of data files, each read as a stream of keys."""
        folder = self.folder

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for name in batch.column(0).to_pylist():
                    store, path = store_of(f"{folder}/{name}")
                    row, found = [[name]], {c: [] for c in KEYS}
                    low, high = dict.fromkeys(KEYS), dict.fromkeys(KEYS)
                    with pq.ParquetFile(store.open_input_file(path)) as file:
                        for part in file.iter_batches(20_000, columns=list(KEYS)):
                            for c in KEYS:
                                values = [v for v in part.column(part.schema.names.index(c)).to_pylist() if v is not None]
                                if values:
                                    low[c], high[c] = min([*values, *([low[c]] if low[c] is not None else [])]), max([*values, *([high[c]] if high[c] is not None else [])])
                                    found[c].append(hashes(values))
                    for c in KEYS:
                        row += [[low[c]], [high[c]], [bloom(np.concatenate(found[c] or [np.zeros(0, np.uint64)]))]]
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary() if i in (3, 6) else pa.string()) for i, x in enumerate(row)], names=[x.split(" ")[0] for x in ACCESS.split(", ")])

        return self.spark.createDataFrame([(x,) for x in names], "path string").repartition(max(1, min(len(names), self.spark.sparkContext.defaultParallelism))).mapInArrow(run, ACCESS)

    def _listed(self, name: str) -> dict[int, str]:
        """Data files of a write, by bucket."""
        found = self.files_of.get_file_info(fs.FileSelector(f"{self.path}/{name}", recursive=True))
        files = [x.path for x in found if x.base_name.endswith(".parquet") and x.type == fs.FileType.File]
        return {int(p.rpartition("/")[0].rpartition("=")[2]): f"{name}/{p.split(f'/{name}/', 1)[1]}" for p in files}

    def publish(self, files: dict[int, str], access: list[str], batch: tuple[str, int] | None = None, pending: str | None = None, dispositions: str | None = None) -> None:
        """The next version: with new files for some buckets."""
        after = {k: v for k, v in self.now.items()} | {"version": self.now["version"] + 1, "files": self.now["files"] | {str(b): p for b, p in files.items()}, "access": [*self.now["access"], *access], "pending": pending, "dispositions": dispositions}
        if batch is not None:
            after["batches"] = self.now["batches"] | {batch[0]: batch[1]}
        self.files_of.create_dir(f"{self.path}/versions")
        name = f"{self.path}/versions/{after['version']:012d}.json"
        if self.files_of.get_file_info(name).type != fs.FileType.NotFound:
            raise RuntimeError(f"version {after['version']} is there already: another writer is at work")
        hidden = f"{self.path}/versions/.{uuid.uuid4().hex}"
        with self.files_of.open_output_stream(hidden) as out:
            out.write(json.dumps(after).encode())
        self.files_of.move(hidden, name)
        self.now = after

    def staged(self, batch: DataFrame, seq: str = "seq") -> tuple[DataFrame, dict[int, str], list[str]]:
        """(outcomes (seq, outcome), new files by bucket, their access paths) of saving a batch: nothing that a reader sees yet."""
        batch = stored(batch.select(*self.schema.names, seq))
        old = self.read(self.candidates(batch))
        near = stored(old.join(batch.select("url").distinct(), "url", "left_semi").select(*self.schema.names).union(old.join(batch.select("content_hash").distinct(), "content_hash", "left_semi").select(*self.schema.names)).dropDuplicates(["url"]))
        after, outcomes = dedup.upsert(near, batch, seq, written=True)
        urls = stored(outcomes.filter("outcome <> 'duplicate'").join(batch.select(seq, "url"), seq).select("url").distinct())
        changed = stored(after.join(urls, "url", "left_semi").select(*self.schema.names))
        buckets = [r[0] for r in changed.select(self.bucket(F.col("url"))).distinct().collect()]
        if not buckets:
            return outcomes, {}, []
        before = self.read([self.now["files"][str(b)] for b in buckets if str(b) in self.now["files"]]).join(urls, "url", "left_anti").select(*self.schema.names)
        name = f"data/{self.now['version'] + 1:012d}-{uuid.uuid4().hex}"
        rows = before.union(changed).withColumn("bucket", self.bucket(F.col("url")))
        rows.repartition("bucket").sortWithinPartitions("bucket", "url").write.partitionBy("bucket").parquet(f"{self.folder}/{name}")
        files = self._listed(name)
        index = f"access/{self.now['version'] + 1:012d}-{uuid.uuid4().hex}"
        self._described(list(files.values())).write.parquet(f"{self.folder}/{index}")
        return outcomes, files, [index]

    def save(self, batch: DataFrame, seq: str = "seq", query: str | None = None, number: int = 0) -> DataFrame | None:
        """Saves postings in order and publishes the version; the outcomes (seq, outcome), or None if this batch of this query is there already."""
        if query is not None and self.done(query, number):
            return None
        with scratch(self.spark) as keep:
            outcomes, files, access = self.staged(batch, seq)
            outcomes = keep(outcomes).df
        self.publish(files, access, (query, number) if query is not None else None)
        return outcomes

    def write(self, name: str, rows: DataFrame) -> str:
        """Writes rows beside the store; they count when a version names them."""
        path = f"{name}/{self.now['version'] + 1:012d}-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.folder}/{path}")
        return path

    def dispositions(self) -> DataFrame | None:
        """What became of all messages, by all versions that are kept."""
        names = [x for x in (self._get(p)["dispositions"] for p in self._names()) if x]
        return self.spark.read.parquet(*self._paths(names)) if names else None

    def vacuum(self, keep: int = 2) -> int:
        """Removes the data of all versions but the last ones; how many files went.  Not while a reader may still use them."""
        kept = [self._get(p) for p in self._names()[-keep:]]
        live = {x for v in kept for x in v["files"].values()}
        found = self.files_of.get_file_info(fs.FileSelector(f"{self.path}/data", recursive=True, allow_not_found=True))
        gone = [x.path for x in found if x.type == fs.FileType.File and x.base_name.endswith(".parquet") and f"data/{x.path.split('/data/', 1)[1]}" not in live]
        for path in gone:
            self.files_of.delete_file(path)
        return len(gone)
