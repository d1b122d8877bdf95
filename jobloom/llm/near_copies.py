"""Links of texts whose word shingles are alike, checked exactly.

Distinct texts are sketched by MinHash; texts that agree in all values of a band
meet in a bucket, where whole sketches are compared with room for their error.  What
hangs together so is a candidate group; a hot bucket is one as it is.  A group of
bounded size meets in one task, which counts common shingles and searches it
breadth first: each text is compared with those not reached yet, so that m copies
of each other take m comparisons.  Larger groups are dealt to shards: some pivots
are sent to all of them and gather what is like them, round by round; then what the
largest component has not taken in is sent, in blocks, to all shards, and compared
with every text of another component there.  So no group meets in one task, and the
components are those of all pairs in the group.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobloom.llm.common import fresh, scratch, ship, stored, text_blocks
from jobloom.llm.simhash import connected, fingerprint, links

VALUES, BAND = 80, 4  # of a pair at 0.8, 3 in 100,000 share none of 20 bands
ROOM = 0.2  # a sketch errs by 0.045 (one deviation) at 0.8
#: Texts of a bucket whose sketches are compared, texts and shingles of a group or shard that one task holds, and pivots and rounds of larger groups.
BUCKET, GROUP, SHINGLES, PIVOTS, ROUNDS = 4096, 1000, 4_000_000, 16, 3
#: Keys of texts up to this number (16 bytes each) are broadcast to the documents; beyond it both are joined by shuffling.
BROADCAST_KEYS = 1_000_000
_RNG = np.random.default_rng(11)
_XOR = _RNG.integers(0, 2**64, VALUES, np.uint64)
_MUL = _RNG.integers(0, 2**64, VALUES, np.uint64) | np.uint64(1)


def text_key(text_column: str) -> Column:
    """64 bits that stand for a text; null counts as empty."""
    return F.xxhash64(F.coalesce(F.col(text_column), F.lit("")))


def shingles(text: str, width: int = 5, seed: int = 42) -> np.ndarray:
    """Sorted distinct hashes of the word shingles; a text of fewer words is one shingle, one without words has none."""
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    rows = zip(*(words[k:] for k in range(width))) if len(words) > width else [words]
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(b" ".join(s), seed) for s in rows), np.uint64, max(1, len(words) - width + 1)))


def sketch(hashes: np.ndarray) -> np.ndarray:
    """MinHash values of a set of hashes."""
    least = np.full(VALUES, np.uint64(2**64 - 1))
    for i in range(0, len(hashes), 2048):
        np.minimum(least, ((hashes[None, i : i + 2048] ^ _XOR[:, None]) * _MUL[:, None]).min(1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def sketches(docs: DataFrame, width: int = 3, seed: int = 42, shingle: int = 5, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id, key (of the text), fp (as ``simhash.fingerprints``), size (distinct shingles), sketch and bands of every row; the last two are null for a text without words."""
    ship(docs.sparkSession)
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_blocks(batches, "__text"):
            prints = np.array([fingerprint(x, width, seed) for x in texts], np.uint64).view(np.int64)
            sets = [shingles(x, shingle, seed) for x in texts]
            found = [sketch(h) if len(h) else None for h in sets]
            values = [None if s is None else s.tobytes() for s in found]
            bands = [None if s is None else [xxhash.xxh64_intdigest(s[i : i + BAND].tobytes(), i) - 2**63 for i in range(0, VALUES, BAND)] for s in found]
            schema = pa.schema([part.schema.field("__id"), ("key", pa.int64()), ("fp", pa.int64()), ("size", pa.int32()), ("sketch", pa.binary()), ("bands", pa.list_(pa.int64()))])
            yield pa.RecordBatch.from_arrays([part.column("__id"), part.column("key").cast(pa.int64()), pa.array(prints), pa.array(list(map(len, sets)), pa.int32()), pa.array(values, pa.binary()), pa.array(bands, pa.list_(pa.int64()))], schema=schema)

    rows = docs.select(F.col(id_column).alias("__id"), F.col(text_column).alias("__text"), text_key(text_column).alias("key"))
    return rows.mapInArrow(run, f"__id {kind}, key bigint, fp bigint, size int, sketch binary, bands array<bigint>")


def tree(n: int, alike: Callable[[int, np.ndarray], np.ndarray]) -> list[tuple[int, int]]:
    """Edges that connect what all pairs would; ``alike`` says which of the rows are alike a row."""
    left, edges = np.arange(n), []
    while len(left):
        todo, left = [int(left[0])], left[1:]
        while todo and len(left):
            i = todo.pop()
            near = alike(i, left)
            edges += [(i, int(j)) for j in left[near]]
            todo += left[near].tolist()
            left = left[~near]
    return edges


def _grouped(batches: Iterator[pa.RecordBatch], edges: Callable[[list[tuple]], list[tuple[int, int]]]) -> Iterator[pa.RecordBatch]:
    """Links (a > b) within runs of rows that agree in the first column."""
    rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
    held: list[tuple[int, int]] = []
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    batch = lambda: pa.RecordBatch.from_arrays([pa.array([max(e) for e in held], pa.int64()), pa.array([min(e) for e in held], pa.int64())], schema=schema)
    for _, group in groupby(rows, lambda row: row[0]):
        held += [e for e in edges(list(group)) if e[0] != e[1]]
        if len(held) > 50_000:
            yield batch()
            held.clear()
    yield batch()


def _like(one: np.ndarray, other: np.ndarray, similarity: float) -> bool:
    """Whether two sorted sets of hashes have that Jaccard similarity or more."""
    common = int((other[np.minimum(np.searchsorted(other, one), len(other) - 1)] == one).sum())
    return common >= similarity * (len(other) + len(one) - common) - 1e-9


def _able(sizes: np.ndarray, size: int, similarity: float) -> np.ndarray:
    """Whether sets of these sizes can be that similar to one of ``size``."""
    return np.minimum(sizes, size) >= similarity * np.maximum(sizes, size) - 1e-9


def _across(left: pa.Table, right: pa.Table, similarity: float) -> pa.Table:
    """Links (a, b) by key that join labels of ``left`` and ``right`` (key, label, h); none between texts of one label already."""
    rows = pa.concat_tables([left, right])
    labels, keys, n = rows.column("label").to_numpy(), rows.column("key").to_numpy(), left.num_rows
    _, label = np.unique(labels, return_inverse=True)
    sets = [np.frombuffer(x.as_py(), np.uint64) for x in rows.column("h")]
    sizes = np.array([len(x) for x in sets])
    edges = []
    for i in range(n, len(sets)):
        for j in np.flatnonzero((label[:n] != label[i]) & _able(sizes[:n], sizes[i], similarity)).tolist():
            if label[j] != label[i] and _like(sets[i], sets[j], similarity):
                edges.append((max(keys[i], keys[j]), min(keys[i], keys[j])))
                label[label == label[j]] = label[i]
    return pa.table({"a": pa.array([e[0] for e in edges], pa.int64()), "b": pa.array([e[1] for e in edges], pa.int64())})


def _large_links(members: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) by key of the groups in ``members`` (root, key, size, h, shards), which no task holds whole."""
    on = ["root", "shard", "block"]
    of_group = F.pmod(F.xxhash64("key"), F.col("shards")).alias("shard")
    edges = None
    for turn in range(ROUNDS + 1):
        if edges is None:
            labelled = members.withColumn("label", F.col("key"))
        else:
            labels = connected(edges).withColumnsRenamed({"node": "key", "root": "label"})
            labelled = members.join(labels, "key", "left").withColumn("label", F.coalesce("label", "key"))
        labelled = stored(labelled.select("root", "key", "label", "h", "shards"))
        counts = stored(labelled.groupBy("root", "label").count())
        main = counts.groupBy("root").agg(F.max_by("label", F.struct("count", "label")).alias("main"))
        minor = labelled.join(stored(main), "root").filter("label <> main").select("root", "key", "label", "h", "shards")
        if turn < ROUNDS:  # a pivot for each slot of a group
            order = F.struct(F.xxhash64("key", F.lit(turn)), "key")
            chosen = minor.groupBy("root", F.pmod(F.xxhash64("key", F.lit(-turn)), F.lit(PIVOTS))).agg(F.min(order)["key"].alias("key")).select("root", "key")
            sent = minor.join(stored(chosen), ["root", "key"], "left_semi").withColumn("block", F.lit(0).cast("bigint"))
        else:  # all that the main component lacks, in blocks as large as a shard
            sent = minor.withColumn("block", F.pmod(F.xxhash64("key", F.lit(turn)), F.col("shards")))
        sent = stored(sent)
        if sent.isEmpty():
            break
        probes = sent.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("shards") - 1))).select(*on, "key", "label", "h")
        blocks = stored(sent.select("root", "block").distinct())
        dealt = labelled.withColumn("shard", of_group).join(blocks, "root").select(*on, "key", "label", "h")
        found = dealt.groupBy(*on).cogroup(probes.groupBy(*on)).applyInArrow(lambda a, b: _across(a, b, similarity), "a bigint, b bigint")
        edges = stored(found if edges is None else found.union(edges).distinct())
    return edges


def _checked(keys: DataFrame) -> DataFrame:
    """A written table to be broadcast if it is small."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys


def similar_links(docs: DataFrame, found: DataFrame, similarity: float = 0.8, shingle: int = 5, seed: int = 42, text_column: str = "text") -> DataFrame:
    """Links (a, b), a > b, between fingerprints of texts whose shingles' Jaccard similarity is ``similarity`` or more.

    ``found`` is a written table of ``sketches``.  A task holds the sketches of
    ``BUCKET`` texts of a bucket at most, and the hashes of a group or shard of about
    ``GROUP`` texts or ``SHINGLES`` shingles (or of one text that has more).
    """
    least = int(np.floor((similarity - ROOM) * VALUES))

    def in_bucket(rows: list[tuple]) -> list[tuple[int, int]]:
        values = np.frombuffer(b"".join(r[2] for r in rows), np.uint32).reshape(-1, VALUES)
        return [(rows[i][1], rows[j][1]) for i, j in tree(len(rows), lambda i, left: (values[left] == values[i]).sum(1) >= least)]

    def in_group(rows: list[tuple]) -> list[tuple[int, int]]:
        sets = [np.frombuffer(r[2], np.uint64) for r in rows]
        sizes = np.array([len(s) for s in sets])

        def alike(i: int, left: np.ndarray) -> np.ndarray:
            near = _able(sizes[left], sizes[i], similarity)
            for k in np.flatnonzero(near).tolist():
                near[k] = _like(sets[i], sets[left[k]], similarity)
            return near

        return [(rows[i][1], rows[j][1]) for i, j in tree(len(rows), alike)]

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_blocks(batches, "text"):
            kept = [part.column(c) for c in ("root", "key", "shards")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array([shingles(x, shingle, seed).tobytes() for x in texts], pa.binary())], names=["root", "key", "shards", "h"])

    members = stored(found.filter("bands IS NOT NULL").select("key", F.explode("bands").alias("bucket")).distinct())
    buckets = stored(members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("least")).filter("n > 1"))
    shared = stored(members.join(buckets, "bucket"))
    every = found.filter("bands IS NOT NULL").groupBy("key").agg(F.first("sketch").alias("sketch"), F.first("fp").alias("fp"), F.first("size").alias("size"))
    values = stored(every.join(shared.select("key").distinct(), "key", "left_semi"))
    met = shared.filter(F.col("n") <= BUCKET).join(values, "key").select("bucket", "key", "sketch").repartition("bucket").sortWithinPartitions("bucket", "key")
    hot = shared.filter((F.col("n") > BUCKET) & (F.col("key") > F.col("least"))).select(F.col("key").alias("a"), F.col("least").alias("b"))
    near = stored(met.mapInArrow(lambda batches: _grouped(batches, in_bucket), "a bigint, b bigint").union(hot).distinct())
    labels = stored(connected(near))
    groups = labels.select("root", F.col("node").alias("key")).union(labels.select("root", F.col("root").alias("key")).distinct())
    groups = stored(groups.join(values.select("key", "size"), "key"))
    sizes = stored(groups.groupBy("root").agg(F.greatest(F.ceil(F.count(F.lit(1)) / GROUP), F.ceil(F.sum("size") / SHINGLES)).alias("shards")))
    groups = groups.join(sizes, "root").select("root", "key", "shards")
    wanted = groups.select("key")
    texts = docs.select(text_key(text_column).alias("key"), F.col(text_column).alias("text")).join(_checked(wanted), "key", "left_semi").groupBy("key").agg(F.first("text", ignorenulls=True).alias("text"))
    held = stored(groups.join(texts, "key").mapInArrow(hashes, "root bigint, key bigint, shards bigint, h binary"))
    small = held.filter("shards = 1").select("root", "key", "h").repartition("root").sortWithinPartitions("root", "key")
    edges = small.mapInArrow(lambda batches: _grouped(batches, in_group), "a bigint, b bigint")
    large = held.filter("shards > 1")
    if not large.isEmpty():
        edges = edges.union(_large_links(large, similarity))
    prints = values.select("key", "fp")
    named = stored(edges).join(prints.toDF("a", "x"), "a").join(prints.toDF("b", "y"), "b")
    return named.filter("x <> y").select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct()


def keep_one(docs: DataFrame, similarity: float = 0.8, shingle: int = 5, width: int = 3, radius: int = 2, seed: int = 42, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay when texts are linked by fingerprints, as in ``simhash.near_duplicates``, and by shingles as well.

    Of each component one row stays: the least id, null last, then the least key of
    the text.  Of rows that agree in both, which are copies, any one stays.  Null,
    empty and wordless texts share fingerprint zero and are one group.  A unique text
    stays whatever ids its row has, null or shared.  Other columns pass through; an
    empty table gives an empty result.
    """
    with scratch(docs.sparkSession) as keep:  # sketches and links go once the rows are judged
        found = stored(sketches(docs, width, seed, shingle, id_column, text_column))
        prints = stored(found.select("fp").distinct())
        edges = stored(links(prints, radius).union(similar_links(docs, found, similarity, shingle, seed, text_column)).distinct())
        labels = connected(edges).withColumnRenamed("node", "fp")
        rows = found.groupBy("__id", "key", "fp").agg(F.count(F.lit(1)).alias("n"))
        rows = stored(rows.join(labels, "fp", "left").select("__id", F.col("key").alias("__key"), "n", F.coalesce("root", "fp").alias("root")))
        order = F.struct(F.col("__id").isNull(), "__id", "__key")
        best = stored(rows.groupBy("root").agg(F.min(order).alias("best")))
        judged = rows.join(best, "root").select("__id", "__key", "n", (order == F.col("best")).alias("first"))
        gone, repeated = keep(judged.filter("NOT first")).df, keep(judged.filter("first AND n > 1")).df
    id_name, key_name = fresh("id", "key")
    gone, repeated = (x.select(F.col("__id").alias(id_name), F.col("__key").alias(key_name)) for x in (gone, repeated))
    keyed = docs.withColumn(key_name, text_key(text_column)).withColumn(id_name, F.col(id_column))
    meets = lambda a, b: a[id_name].eqNullSafe(b[id_name]) & (a[key_name] == b[key_name])
    keyed = keyed.join(_checked(gone), meets(keyed, gone), "left_anti")
    if repeated.limit(1).count():
        copies = keyed.join(repeated, meets(keyed, repeated), "left_semi").dropDuplicates([id_name, key_name])
        keyed = keyed.join(repeated, meets(keyed, repeated), "left_anti").unionByName(copies)
    return keyed.drop(id_name, key_name)
