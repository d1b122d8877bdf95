"""A pair of tables kept in the same buckets: one sorted Parquet file per table and bucket.

The left table's keys make a Bloom filter of fixed size, by ``treeAggregate``.  Rows
of the right table that it turns away are orphans without any doubt, and are marked
where they are read.  The keys it lets through are verified exactly: both tables'
distinct keys meet in a bucketed join, which also counts each bucket's joined rows.  Keys that
passed the filter wrongly make a second filter; if no true key passes that one, both
filters together decide every row map-side and exactly, and else the rows that pass
it are joined with the wrong keys.  So rows are shuffled once, by their bucket.

That shuffle deals rows to partitions by the bucket's number (``repartitionById``);
each is sorted, and written by Spark as one file.  A bucket with far more rows than
others is sorted in ranges by many tasks, and one task streams the ranges into its
file.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from jobloom.llm.common import scratch, ship, shared_folder, stored

#: Bits of a Bloom filter, and its hashes.  The size is fixed whatever the tables hold: a filter that is too full lets more keys through, which are verified all the same.
BITS, HASHES = 1 << 23, 3
#: Rows beyond which a bucket with over eight times the mean is sorted in ranges, rows of a range, and ranges at most.
HOT_ROWS, MOST_RANGES = 200_000, 1000
#: Numbers of the last two buckets, counted from the number of buckets on: rows without a partner, rows without a key.
ORPHANS, NULLS = 0, 1


def positions(hashes: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """A key's bits, from its 64-bit hash by double hashing."""
    h = hashes.astype(np.uint64)
    first, step = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    for i in range(HASHES):
        yield (first + np.uint64(i) * step) % np.uint64(bits)


def bloom(keys: DataFrame, key: str, bits: int = BITS) -> bytes:
    """Bloom filter of a column's values: bitmaps of partitions, joined by ``treeAggregate``.  Nulls aren't in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(bits, bool)
        for batch in batches:
            for at in positions(batch.column(0).to_numpy(), bits):
                held[at] = True
        yield pa.RecordBatch.from_arrays([pa.array([np.packbits(held).tobytes()], pa.binary())], names=["bitmap"])

    def join(a: bytes, b: bytes) -> bytes:
        return (np.frombuffer(a, np.uint8) | np.frombuffer(b, np.uint8)).tobytes() if a and b else bytes(a or b)

    maps = keys.filter(F.col(key).isNotNull()).select(F.xxhash64(key).alias("h")).mapInArrow(run, "bitmap binary").rdd
    found = maps.treeAggregate(b"", lambda a, row: join(a, row[0]), join, depth=3)
    return found or bytes(bits // 8)


def passes(spark: SparkSession, bitmap: bytes, key: str) -> Column:
    """Whether a filter lets a key through; null for a null key."""
    sent = spark.sparkContext.broadcast(bitmap)

    @F.pandas_udf("boolean")
    def test(hashes):
        import pandas as pd

        held, found = np.frombuffer(sent.value, np.uint8), np.ones(len(hashes), bool)
        for at in positions(hashes.to_numpy(), len(held) * 8):
            found &= (held[at >> np.uint64(3)] >> (7 - (at & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)
        return pd.Series(found)

    return F.when(F.col(key).isNotNull(), test(F.xxhash64(key)))


def bucket_of(key: Column, buckets: int) -> Column:
    """Unsigned CRC-32 of "s" and the decimal key, modulo ``buckets``."""
    return (F.crc32(F.concat(F.lit("s"), key.cast("string")).cast("binary")) % buckets).cast("int")


def _store(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri("s3://" + uri[6:] if uri.startswith("s3a://") else uri)


def _listed(spark: SparkSession, folder: str) -> list[str]:
    """Names of a folder's data files."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(n for n in (s.getPath().getName() for s in store.listStatus(path)) if n.endswith(".parquet")) if store.exists(path) else []


def _remove(spark: SparkSession, *names: str) -> None:
    for name in names:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def _write(rows: DataFrame, folder: str) -> None:
    rows.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").option("maxRecordsPerFile", 0).parquet(folder)


def _write_hot(rows: DataFrame, order: list[str], folder: str, n: int, hot_rows: int) -> str:
    """One file of many rows: ranges are sorted and written by as many tasks, then one task streams them into the file."""
    spark, runs = rows.sparkSession, f"{folder}-ranges-{uuid.uuid4().hex}"
    tie = f"tie-{uuid.uuid4().hex}"  # equal rows can be parted too
    ranges = min(MOST_RANGES, -(-n // hot_rows))
    _write(rows.withColumn(tie, F.monotonically_increasing_id()).repartitionByRange(ranges, *[F.col(f"`{c}`").asc_nulls_first() for c in order], tie).drop(tie).sortWithinPartitions(*[F.col(f"`{c}`").asc_nulls_first() for c in order]), runs)
    paths, schema = [f"{runs}/{x}" for x in _listed(spark, runs)], to_arrow_schema(rows.schema)

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in [p for row in batch.column(0).to_pylist() for p in row]:
                store, name = _store(path)
                with pq.ParquetFile(store.open_input_file(name)) as file:
                    for part in file.iter_batches(20_000):
                        yield part.cast(schema)

    _write(spark.createDataFrame([(paths,)], "paths array<string>").coalesce(1).mapInArrow(stream, rows.schema), folder)
    _remove(spark, runs)
    (name,) = _listed(spark, folder)
    return f"{folder}/{name}"


def write_numbered(rows: DataFrame, number: str, counts: dict[int, int], columns: list[str], order: list[str], folder: str, hot_rows: int = HOT_ROWS) -> dict[int, str]:
    """Writes the rows of each number (int, not null) into a file of its own, sorted by ``order``, and returns the paths by number.

    ``counts`` has each number's rows.  Rows are dealt by number, a partition for
    each, and Spark's writer names files by partition.  Numbers of over ``hot_rows``
    rows and over eight times the mean are sorted in ranges.
    """
    spark, paths = rows.sparkSession, {}
    if not counts:
        return paths
    hot = [n for n, c in counts.items() if c > hot_rows and c * len(counts) > 8 * sum(counts.values())]
    fields = [F.col(f"`{c}`") for c in columns]
    if len(hot) < len(counts):
        rest = rows.filter(~F.col(number).isin(hot)) if hot else rows
        sorted_rows = rest.repartitionById(max(counts) + 1, F.col(number)).sortWithinPartitions(*[F.col(f"`{c}`").asc_nulls_first() for c in order])
        _write(sorted_rows.select(*fields), folder)
        for name in _listed(spark, folder):
            n = int(name.split("-")[1])
            if n in counts and n not in hot:
                paths[n] = f"{folder}/{name}"
            else:
                _remove(spark, f"{folder}/{name}")  # Spark writes an empty first file
    for n in hot:
        paths[n] = _write_hot(rows.filter(F.col(number) == n).select(*fields), order, f"{folder}-{n:05d}", counts[n], hot_rows)
    return paths


def _counted(rows: DataFrame, number: str) -> dict[int, int]:
    """Rows of each number: as many as there are numbers, whatever the input."""
    return {r[0]: r[1] for r in rows.groupBy(number).count().collect()}


def starting_files(rows: DataFrame, number: Column, key: str, folder: str, hot_rows: int = HOT_ROWS) -> dict[int, str]:
    """Writes a table into numbered files, each sorted by the key and then by the other columns from left to right, nulls first.  No file is empty."""
    name, columns = f"number-{uuid.uuid4().hex}", rows.columns
    numbered = rows.withColumn(name, number.cast("int"))
    return write_numbered(numbered, name, _counted(numbered, name), columns, [key, *[c for c in columns if c != key]], folder, hot_rows)


def _read(spark: SparkSession, files: dict[int, str], schema, number: str) -> DataFrame:
    """Rows of numbered files, with their file's number: Spark's names of a folder's files tell it, and a hot number's file has a folder of its own."""
    folders: dict[str, list[int]] = {}
    for n, path in files.items():
        folders.setdefault(path.rpartition("/")[0], []).append(n)
    found = None
    for folder, numbers in sorted(folders.items()):
        names = [files[n].rpartition("/")[2] for n in numbers]
        rows = spark.read.schema(schema).parquet(folder).filter(F.col("_metadata.file_name").isin(names))
        own = F.lit(numbers[0]) if re.search(r"-\d{5}$", folder) else F.split_part("_metadata.file_name", F.lit("-"), F.lit(2)).cast("int")
        part = rows.select("*", own.alias(number))
        found = part if found is None else found.union(part)
    return found


def partners(spark: SparkSession, left: DataFrame, right: DataFrame, key: str, buckets: int) -> DataFrame:
    """(k, l, r): keys and in how many rows of either side they are, of all right keys given; l is null where the left side lacks the key.

    A bucketed join: both sides' counts are written as tables of as many buckets by
    key, so they meet without a shuffle.
    """
    names = []
    for side, name in ((left, "l"), (right, "r")):
        names.append(f"jobloom_{uuid.uuid4().hex}")
        counts = side.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("k")).agg(F.count(F.lit(1)).alias(name))
        counts.repartition(buckets, "k").write.bucketBy(buckets, "k").sortBy("k").format("parquet").option("path", f"{shared_folder(spark)}/{names[-1]}").saveAsTable(names[-1])
    try:
        return stored(spark.table(names[1]).join(spark.table(names[0]).hint("merge"), "k", "left").select("k", "l", "r"))
    finally:
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS `{name}`")
            _remove(spark, f"{shared_folder(spark)}/{name}")


def marker(spark: SparkSession, name: str, key: str, buckets: int, first: bytes, wrong: DataFrame, true_keys: DataFrame, bits: int = BITS) -> Callable[[DataFrame], DataFrame]:
    """A function that adds rows' buckets as column ``name``, by the first filter and the keys (k) that pass it wrongly.

    Where no true key (k) passes the filter of the wrong ones, both filters are
    exact; else rows that pass it are joined with them.
    """
    own, orphan, nothing = bucket_of(F.col(key), buckets), F.lit(buckets + ORPHANS), F.lit(buckets + NULLS)
    through = F.coalesce(passes(spark, first, key), F.lit(False))
    if wrong.isEmpty():
        return lambda rows: rows.withColumn(name, F.when(F.col(key).isNull(), nothing).when(through, own).otherwise(orphan))
    second = bloom(wrong, "k", bits)
    suspect = F.coalesce(passes(spark, second, key), F.lit(False))
    sure = F.when(F.col(key).isNull(), nothing).when(through & ~suspect, own).otherwise(orphan)
    if true_keys.filter(passes(spark, second, "k")).isEmpty():
        return lambda rows: rows.withColumn(name, sure)

    def joined(rows: DataFrame) -> DataFrame:
        doubt = f"doubt-{name}"
        both = rows.withColumn(doubt, through & suspect)
        told = both.filter(~F.col(doubt)).drop(doubt).withColumn(name, sure)
        flag = wrong.select(F.col("k").alias(f"k-{name}"), F.lit(True).alias(f"w-{name}"))
        asked = both.filter(F.col(doubt)).drop(doubt).join(flag.hint("merge"), F.col(key) == F.col(f"k-{name}"), "left")
        return told.union(asked.select(*[F.col(f"`{c}`") for c in rows.columns], F.when(F.col(f"w-{name}"), orphan).otherwise(own).alias(name)))

    return joined


def _digests(spark: SparkSession, files: DataFrame, key: str) -> DataFrame:
    """Of each file (path): n_rows and the SHA-256 of its keys in file order, comma-joined; files are read as streams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                store, name = _store(path)
                digest, rows = hashlib.sha256(), 0
                with pq.ParquetFile(store.open_input_file(name)) as file:
                    for part in file.iter_batches(65_536, columns=[key]):
                        texts = ["" if x is None else str(x) for x in part.column(0).to_pylist()]
                        digest.update(("," * bool(rows and texts) + ",".join(texts)).encode())
                        rows += len(texts)
                yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([rows], pa.int64()), pa.array([digest.hexdigest()])], names=["path", "n_rows", "ids_sha256"])

    return files.select("path").repartition(max(1, spark.sparkContext.defaultParallelism), "path").mapInArrow(run, "path string, n_rows bigint, ids_sha256 string")


def rewrite(spark: SparkSession, folder: str, tables: dict[str, tuple[dict[int, str], object]], key: str, buckets: int = 600, hot_rows: int = HOT_ROWS, bits: int = BITS) -> DataFrame:
    """Rewrites two tables' starting files into one file per table and bucket; ``tables`` has (files by number, schema) by name, the left one first.

    One row per final file: table_name, path, bucket, columns, n_rows, n_joined,
    rewritten, ids_sha256, lineage_sha256.  A starting file that holds a bucket's
    rows and no others stays; all other starting files go once the final ones are
    there.
    """
    (left, (left_files, left_schema)), (right, (right_files, right_schema)) = tables.items()
    number = f"file-{uuid.uuid4().hex}"
    result = spark.createDataFrame([], "table_name string, path string, bucket bigint, rewritten boolean")
    with scratch(spark) as keep:
        sides, name = {}, f"bucket-{uuid.uuid4().hex}"
        if left_files:
            own = F.when(F.col(key).isNull(), buckets + NULLS).otherwise(bucket_of(F.col(key), buckets))
            sides[left] = name, lambda rows: rows.withColumn(name, own), left_files, left_schema
        joined = spark.createDataFrame([], "bucket int, n_joined bigint")
        if right_files:
            rows = _read(spark, right_files, right_schema, number).select(key)
            known = _read(spark, left_files, left_schema, number).select(key) if left_files else rows.filter("false")
            first = bloom(known, key, bits)
            found = partners(spark, known, rows.filter(passes(spark, first, key)), key, max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))))
            joined = stored(found.filter("l IS NOT NULL").groupBy(bucket_of(F.col("k"), buckets).alias("bucket")).agg(F.sum(F.col("l") * F.col("r")).alias("n_joined")))
            sides[right] = name, marker(spark, name, key, buckets, first, found.filter("l IS NULL").select("k"), found.filter("l IS NOT NULL").select("k"), bits), right_files, right_schema
        lineage = None
        for table, (name, mark, files, schema) in sides.items():
            rows = mark(_read(spark, files, schema, number).select(key, number))
            origin = stored(rows.groupBy(F.col(number).alias("file"), F.col(name).alias("bucket")).agg(F.count(F.lit(1)).alias("n")))
            spread = origin.groupBy("file").agg(F.count(F.lit(1)).alias("parts"))
            whole = origin.join(spread, "file").groupBy("bucket").agg(F.count(F.lit(1)).alias("files"), F.max("parts").alias("parts"), F.min("file").alias("file"), F.sum("n").alias("n"))
            plan = whole.collect()  # a row per bucket
            stay = {r.bucket: files[r.file] for r in plan if r.files == 1 and r.parts == 1}
            counts = {r.bucket: r.n for r in plan if r.bucket not in stay}
            changed = {n: p for n, p in files.items() if p not in stay.values()}
            order = [key, *[f.name for f in schema if f.name != key]]
            written = {} if not changed else write_numbered(mark(_read(spark, changed, schema, number)), name, counts, schema.names, order, f"{folder}/{table}/final", hot_rows)
            made = [(table, p, b, b in written) for b, p in sorted({**stay, **written}.items())]
            result = result.union(spark.createDataFrame(made, result.schema)) if made else result
            steps = F.transform(F.array_sort(F.collect_list(F.struct("file", "n"))), lambda x: F.concat_ws(":", x.file, x.n))  # as many as there are starting files at most
            told = origin.groupBy("bucket").agg(F.sha2(F.array_join(steps, ",").cast("binary"), 256).alias("lineage_sha256")).select(F.lit(table).alias("table_name"), "bucket", "lineage_sha256", F.lit(",".join(schema.names)).alias("columns"))
            lineage = told if lineage is None else lineage.union(told)
            sides[table] = changed.values()
        empty = spark.createDataFrame([], "table_name string, bucket int, lineage_sha256 string, columns string")
        result = stored(result)
        told = result.join(lineage if lineage is not None else empty, ["table_name", "bucket"]).join(joined, "bucket", "left").join(_digests(spark, result, key), "path")
        told = keep(told.select("table_name", "path", "columns", "ids_sha256", "lineage_sha256", F.col("bucket").cast("bigint").alias("bucket"), "n_rows", F.coalesce("n_joined", F.lit(0)).cast("bigint").alias("n_joined"), "rewritten")).df
        for changed in sides.values():
            _remove(spark, *changed)
    return told


def co_bucketed(left: DataFrame, right: DataFrame, folder: str, names: tuple[str, str], key: str, deal: str, buckets: int = 600, hot_rows: int = HOT_ROWS, bits: int = BITS) -> DataFrame:
    """Writes two tables into ``folder`` (new, in a store that Spark and pyarrow know) and rewrites them there, one sorted file per table and bucket; see ``rewrite`` for the result.

    The left table starts in file b, or b - 1 if b modulo 4 is 1, b being its bucket;
    the right one in files by the CRC-32 of its column ``deal``, 0 for null.  Left
    rows without a key are in the bucket of rows without one too.  Null values come
    first in every order; repeated rows are all kept; other columns are carried along whatever
    their names.  Empty tables have no files and give no rows.  Only the list of files,
    counts by bucket and filters of fixed size meet at the driver.
    """
    spark = left.sparkSession
    ship(spark)
    own = F.when(left[key].isNull(), buckets + NULLS).otherwise(bucket_of(left[key], buckets))
    dealt = F.coalesce(F.crc32(right[deal].cast("string").cast("binary")) % buckets, F.lit(0))
    files = {
        names[0]: (starting_files(left, F.when(own % 4 == 1, own - 1).otherwise(own), key, f"{folder}/{names[0]}/start", hot_rows), left.schema),
        names[1]: (starting_files(right, dealt, key, f"{folder}/{names[1]}/start", hot_rows), right.schema),
    }
    return rewrite(spark, folder, files, key, buckets, hot_rows, bits)
