"""Exact deduplication by a Golomb-coded exchange of fingerprints.

1. Each partition fingerprints its rows (64 bits of the SHA-256 of the normalised
   text) and writes parts of them, each as one row: (part, ids, lengths, hashes).
   A part is a row, so that no reader ever meets half of one, however the written
   table is split; texts stay behind.
2. Each part's distinct fingerprints are sorted, and each owner (a range of the
   fingerprint space) is sent its share as Golomb-coded gaps, with a bit for those
   that the part holds more than once itself.
3. Owners decode the lists, find fingerprints that are held twice, and return to
   each part a bitmap over the list that it sent.
4. Rows with a set bit are suspects.  Only their texts are shuffled, combined on
   the map side, and compared byte for byte.

A fingerprint held by a third of all rows costs one entry per part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobloom.llm import co_bucket
from jobloom.llm.common import scratch, ship, stored, text_blocks

DELETED = b"\t\n\x0b\x0c\r "
#: Owners of ranges of fingerprints: at least these, and one more per so many rows.
OWNERS, ROWS_PER_OWNER = 64, 2_000_000
#: Rows of a part at most: a written part then has about 1.5 MB.
PART_ROWS = 32_768
#: Parts of a task have numbers of so many bits; with the rows of a part that leaves 24 bits for the task.
PART_BITS = 24
#: Bitmaps up to so many bytes are broadcast to the parts (one bit for each row of the corpus at most); beyond it parts and bitmaps, not texts, are joined by shuffling.
BROADCAST_BYTES = 32 << 20
#: Suspect ids up to this number (16 bytes each in a hash relation) are broadcast; beyond it they are joined by shuffling.
BROADCAST_IDS = 500_000


def normalised(text: str) -> bytes:
    return text.encode().translate(None, DELETED)


def golomb_encode(values: np.ndarray, span: int) -> bytes:
    """Sorted distinct unsigned values below ``span`` as Golomb-Rice codes of their gaps: 4 bytes count, 1 byte k, then bits."""
    n = len(values)
    gaps = np.diff(values, prepend=np.uint64(0)).astype(np.uint64)
    k = max(0, int(np.log2(max(1.0, 0.69 * span / max(1, n)))))
    quotients = (gaps >> np.uint64(k)).astype(np.int64)
    width = quotients + 1 + k
    ends = np.cumsum(width)
    bits = np.zeros(int(ends[-1]) if n else 0, np.uint8)
    stops = ends - k - 1  # the zero that ends the unary part
    marks = np.zeros(len(bits) + 1, np.int32)
    np.add.at(marks, ends - width, 1)
    np.add.at(marks, stops, -1)
    bits[:] = np.cumsum(marks[:-1]) > 0
    for j in range(k):
        bits[stops + 1 + j] = (gaps >> np.uint64(k - 1 - j)) & np.uint64(1)
    return n.to_bytes(4, "little") + bytes((k,)) + np.packbits(bits).tobytes()


def golomb_decode(data: bytes) -> np.ndarray:
    n, k = int.from_bytes(data[:4], "little"), data[4]
    bits = np.unpackbits(np.frombuffer(data, np.uint8, offset=5))
    zeros = np.append(np.flatnonzero(bits == 0), len(bits))
    gaps, at, z = [0] * n, 0, 0
    stops = np.empty(n, np.int64)
    zeros_list = zeros.tolist()
    for i in range(n):
        while zeros_list[z] < at:
            z += 1
        stops[i] = zeros_list[z]
        gaps[i] = zeros_list[z] - at
        at = zeros_list[z] + 1 + k
    out = np.array(gaps, np.uint64) << np.uint64(k)
    for j in range(k):
        out |= bits[stops + 1 + j].astype(np.uint64) << np.uint64(k - 1 - j)
    return np.cumsum(out, dtype=np.uint64)


def _hashed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Parts: part (its number), ids, n (code points of each text) and sha (32 bytes of each), in the order read."""
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        number = (task.partitionId() if task else 0) << PART_BITS
        ids, sizes, hashes = [], [], []

        def part(of: pa.DataType) -> pa.RecordBatch:
            schema = pa.schema([("part", pa.int64()), ("ids", pa.list_(of)), ("n", pa.binary()), ("sha", pa.binary())])
            held = pa.concat_arrays(ids)
            row = [pa.array([number], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(held)], pa.int32()), held), pa.array([np.array(sizes, np.int64).tobytes()], pa.binary()), pa.array([b"".join(hashes)], pa.binary())]
            ids.clear(), sizes.clear(), hashes.clear()
            return pa.RecordBatch.from_arrays(row, schema=schema)

        of = None
        for rows, texts in text_blocks(batches, text_column):
            of = rows.schema.field(id_column).type
            for at in range(0, len(texts), PART_ROWS):
                if hashes and len(hashes) + min(PART_ROWS, len(texts) - at) > PART_ROWS:
                    yield part(of)
                    number += 1
                some = texts[at : at + PART_ROWS]
                ids.append(rows.column(id_column).slice(at, len(some)))
                sizes += map(len, some)
                hashes += (hashlib.sha256(normalised(x)).digest() for x in some)
        if hashes:
            yield part(of)

    return docs.select(id_column, text_column).mapInArrow(run, f"part bigint, ids array<{kind}>, n binary, sha binary")


def _prints(sha: bytes) -> np.ndarray:
    """The first eight bytes of every hash, as unsigned numbers."""
    return np.frombuffer(sha, ">u8").reshape(-1, 4)[:, 0].astype(np.uint64)


def _exchange(hashed: DataFrame, owners: int) -> DataFrame:
    """(part, owner, held, bitmap): which of the ``held`` sorted distinct fingerprints that a part has for an owner are held more than once anywhere."""
    span = 2**64 // owners + 1

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("owner", pa.int32()), ("part", pa.int64()), ("codes", pa.binary()), ("twice", pa.binary())])
        for batch in batches:
            for p, sha in zip(batch.column(0).to_pylist(), batch.column(1)):
                values, counts = np.unique(_prints(sha.as_py()), return_counts=True)
                owner = (values // np.uint64(span)).astype(np.int64)
                cuts = np.searchsorted(owner, np.arange(owners + 1)).tolist()
                rows = [(o, p, golomb_encode(values[a:b] - np.uint64(o * span), span), np.packbits(counts[a:b] > 1).tobytes()) for o, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), schema)], schema=schema)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("part", pa.int64()), ("owner", pa.int32()), ("held", pa.int32()), ("bitmap", pa.binary())])

        def reply(owner: int, lists: list[tuple[int, bytes, bytes]]) -> pa.RecordBatch:
            decoded = [golomb_decode(codes) for _, codes, _ in lists]
            values, counts = np.unique(np.concatenate(decoded), return_counts=True)
            again = values[counts > 1]
            maps = []
            for (_, _, twice), v in zip(lists, decoded):
                own = np.unpackbits(np.frombuffer(twice, np.uint8))[: len(v)].astype(bool)
                maps.append(np.packbits(own | np.isin(v, again, assume_unique=True)).tobytes())
            return pa.RecordBatch.from_arrays([pa.array([p for p, _, _ in lists], pa.int64()), pa.array([owner] * len(lists), pa.int32()), pa.array(list(map(len, decoded)), pa.int32()), pa.array(maps, pa.binary())], schema=schema)

        now, lists = None, []
        for batch in batches:
            for owner, part, codes, twice in zip(*(c.to_pylist() for c in batch.columns)):
                if owner != now and lists:
                    yield reply(now, lists)
                    lists = []
                now = owner
                lists.append((part, codes, twice))
        if lists:
            yield reply(now, lists)

    sent = hashed.select("part", "sha").mapInArrow(send, "owner int, part bigint, codes binary, twice binary")
    return sent.repartition("owner").sortWithinPartitions("owner").mapInArrow(answer, "part bigint, owner int, held int, bitmap binary")


def _suspects(hashed: DataFrame, maps: DataFrame, owners: int) -> DataFrame:
    """(id, row, n, sha, suspect) of every row; suspect are those whose fingerprint's bit is set in the bitmaps that came back to their part."""
    span = 2**64 // owners + 1
    kind = hashed.schema["ids"].dataType.elementType.simpleString()

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                part, sizes, sha, answers = (batch.column(c)[i].as_py() for c in ("part", "n", "sha", "answers"))
                ids = batch.column("ids")[i].values
                values, place = np.unique(_prints(sha), return_inverse=True)
                owner = (values // np.uint64(span)).astype(np.int64)
                bits, answered = np.zeros(len(values), bool), 0
                for a in answers:
                    begin, end = np.searchsorted(owner, [a["owner"], a["owner"] + 1])
                    if end - begin != a["held"]:
                        raise ValueError(f"part {part} has {end - begin} fingerprints of owner {a['owner']}, which was sent {a['held']}")
                    bits[begin:end] = np.unpackbits(np.frombuffer(a["bitmap"], np.uint8))[: end - begin]
                    answered += int(end - begin)
                if answered != len(values):
                    raise ValueError(f"part {part} has answers for {answered} of {len(values)} fingerprints")
                schema = pa.schema([pa.field("id", ids.type), ("row", pa.int64()), ("n", pa.int64()), ("sha", pa.binary()), ("suspect", pa.bool_())])
                hashes = pa.FixedSizeBinaryArray.from_buffers(pa.binary(32), len(ids), [None, pa.py_buffer(sha)]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([ids, pa.array(part * PART_ROWS + np.arange(len(ids))), pa.array(np.frombuffer(sizes, np.int64)), hashes, pa.array(bits[place])], schema=schema)

    answers = stored(maps.groupBy("part").agg(F.collect_list(F.struct("owner", "held", "bitmap")).alias("answers")))
    few = (maps.agg(F.sum(F.octet_length("bitmap") + 64)).first()[0] or 0) <= BROADCAST_BYTES
    met = hashed.join(F.broadcast(answers) if few else answers, "part")
    return met.select("part", "ids", "n", "sha", "answers").mapInArrow(pick, f"id {kind}, row bigint, n bigint, sha binary, suspect boolean")


#: Bits of the filter of suspects' ids, beyond ``BROADCAST_IDS`` of them: 16 MiB.
SUSPECT_BITS = 1 << 27


def exact_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are the same after ASCII white space is deleted; a
    null text is empty, and all empty texts are one group.  Of a group the row with
    the most code points in its original text stays, then that with the smallest
    id (a null id comes last), then, of repeated rows, the first read; so exactly
    one row of each group has ``kept``.  Other columns are ignored.  An empty
    table gives an empty result.
    """
    ship(docs.sparkSession)
    with scratch(docs.sparkSession) as keep:  # hashes and bitmaps go once rows and groups are known
        hashed = stored(_hashed(docs, id_column, text_column))
        rows = hashed.agg(F.sum(F.octet_length("n"))).first()[0] or 0
        owners = OWNERS + rows // 8 // ROWS_PER_OWNER
        maps = stored(_exchange(hashed, owners))
        marked = keep(_suspects(hashed, maps, owners)).df
        suspects = marked.filter("suspect")
        ids = stored(suspects.select("id").distinct())

        # Byte verification: the suspects' texts, one per partition and distinct text.
        few = ids.count() <= BROADCAST_IDS
        texts = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
        if not few:  # what is no suspect stays where it is; the filter's size is fixed, so of very many suspects' ids it lets more others through
            texts = texts.filter(F.col("id").isNull() | co_bucket.passes(docs.sparkSession, co_bucket.bloom(ids, "id", SUSPECT_BITS), "id"))
        chosen = texts.join(F.broadcast(ids) if few else ids, texts.id.eqNullSafe(ids.id), "left_semi")

        def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part, values in text_blocks(batches, "text"):
                bare = [normalised(x) for x in values]
                yield pa.RecordBatch.from_arrays([pa.array([hashlib.sha256(x).digest() for x in bare], pa.binary()), pa.array(bare, pa.binary())], names=["sha", "bare"])

        verified = chosen.select("text").mapInArrow(strip, "sha binary, bare binary").groupBy("sha", "bare").agg(F.count(F.lit(1)).alias("n")).groupBy("sha").agg(F.count(F.lit(1)).alias("texts"))
        best = F.min(F.struct((-F.col("n")).alias("n"), F.col("id").isNull().alias("no_id"), "id", "row")).alias("best")
        groups = keep(suspects.groupBy("sha").agg(best, F.count(F.lit(1)).alias("group_size")).join(verified, "sha").select("sha", "best", "group_size", F.when(F.col("texts") > 1, F.raise_error(F.lit("unequal texts have one SHA-256"))).alias("fault"))).df
    found = suspects.join(groups, "sha").select("id", F.col("best.id").alias("keep_id"), "group_size", (F.col("row") == F.col("best.row")).alias("kept"), "sha", "fault")
    alone = marked.filter("NOT suspect").select("id", F.col("id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"), F.lit(True).alias("kept"), "sha", F.lit(None).cast("void").alias("fault"))
    return found.withColumn("fault", F.col("fault").cast("string")).union(alone.withColumn("fault", F.col("fault").cast("string"))).select(F.col("id").alias(id_column), "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))
