"""SimHash near-duplicates by vantage-point trees under Hamming distance.

Distinct fingerprints (copies collapse before anything else) are dealt to shards by
their distances to vantage points.  The distances are taken within a band of bits:
distance within a band is a metric that never exceeds the whole distance, so the
triangle bound |d(x, v) - d(y, v)| <= d(x, y) holds in it.  Of radius + 1 bands,
two linked fingerprints agree in one at least; in that band the bound is 0 and
both have the same distances to every vantage point, so they meet in one shard of
that band's tree.  A shard that is too large for a task is parted again, by bands
of the bits that its key has not used.  Within a shard a vantage-point tree over
the whole 64 bits is built: each node splits at the median distance, subtrees
further apart than the radius are pruned by the triangle bound, and the rows on
both sides of the boundary that the bound cannot separate are compared.

A task returns its links as stars (each fingerprint to the least one it reaches
there), never all pairs, and connected components follow from joins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobloom.llm.common import Stored, batch_of, scratch, ship, stored, text_blocks

BITS = 64
VANTAGES = 8
LEAF = 192


def fingerprint(text: str, width: int = 3, seed: int = 42) -> int:
    """Majority of the bits of XXH64 over all ``width``-word shingles; zero for a text without words."""
    words = text.encode().lower().split()  # bytes: only A-Z are lowered and only ASCII white space splits
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) <= width:
        return digest(b" ".join(words), seed)
    counts, n = np.zeros(BITS, np.int64), len(words) - width + 1
    for i in range(0, n, 16384):
        rows = [words[i + k : min(i + 16384, n) + k] for k in range(width)]
        hashes = np.fromiter((digest(b" ".join(s), seed) for s in zip(*rows)), np.uint64, len(rows[0]))
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, width: int = 3, seed: int = 42, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id and fp (bigint, the 64 bits) of every row; a null text is empty."""
    ship(docs.sparkSession)
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_blocks(batches, text_column):
            values = np.array([fingerprint(x, width, seed) for x in texts], np.uint64).view(np.int64)
            yield batch_of(part, [id_column], pa.schema([part.schema.field(id_column), ("fp", pa.int64())]), fp=values)

    return docs.select(id_column, text_column).mapInArrow(run, f"`{id_column}` {kind}, fp bigint")


def _vantages(level: int) -> list[int]:
    return np.random.default_rng(1000 + level).integers(-(2**63), 2**63 - 1, VANTAGES, np.int64).tolist()


def _bands(bits: list[int], n: int) -> list[list[int]]:
    return [part.tolist() for part in np.array_split(np.array(bits), n)]


def _mask(bits: list[int]) -> int:
    m = sum(1 << b for b in bits)
    return m - (1 << 64) if m >= 1 << 63 else m


def _shard(rows: DataFrame, bits: list[int], level: int, radius: int) -> list[tuple[DataFrame, list[int]]]:
    """The rows once for each band of ``bits``: shard keys of distances to vantage points within the band, and the bits left."""
    out = []
    for i, band in enumerate(_bands(bits, radius + 1)):
        mask = F.lit(_mask(band))
        near = [F.bit_count(F.col("fp").bitwiseXOR(F.lit(v)).bitwiseAND(mask)) for v in _vantages(level)]
        out.append((rows.select("fp", F.xxhash64("shard", F.lit(i), *near).alias("shard")), [b for b in bits if b not in set(band)]))
    return out


def components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least member of each of n nodes' components."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while (label[label] != label).any():
            label = label[label]
        apart = label[a] != label[b]
        a, b = a[apart], b[apart]
    return label


class Links:
    """Links of one buffer of rows, folded into stars when there are many."""

    def __init__(self, n: int):
        self.n, self.a, self.b, self.held = n, [], [], 0

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        if len(a):
            self.a.append(a)
            self.b.append(b)
            self.held += len(a)
            if self.held > 1_000_000 + self.n:
                label = self.labels()
                rows = np.flatnonzero(label != np.arange(self.n))
                self.a, self.b, self.held = [rows], [label[rows]], len(rows)

    def labels(self) -> np.ndarray:
        empty = np.zeros(0, np.int64)
        return components(self.n, np.concatenate([empty, *self.a]), np.concatenate([empty, *self.b]))


def _compare(x: np.ndarray, left: np.ndarray, right: np.ndarray, radius: int, links: Links) -> None:
    for i in range(0, len(left), 256):
        near = np.bitwise_count(x[left[i : i + 256], None] ^ x[None, right]) <= radius
        a, b = np.nonzero(near)
        keep = left[i + a] != right[b]
        links.add(left[i + a[keep]], right[b[keep]])


def tree_links(x: np.ndarray, rows: np.ndarray, radius: int, links: Links, seed: int = 7) -> None:
    """Links of x[rows] by a vantage-point tree, and across each node's boundary."""
    rng, todo = np.random.default_rng(seed), [(rows, rows)]
    while todo:
        left, right = todo.pop()
        same = left is right
        if len(left) * len(right) <= LEAF * LEAF:
            if len(left) and len(right):
                _compare(x, left, right, radius, links)
            continue
        pool = left if len(left) >= len(right) else right
        best = None
        for v in x[rng.choice(pool, 3)].tolist() + [int(rng.integers(0, 2**64 - 1, dtype=np.uint64))]:
            d = np.bitwise_count(x[pool] ^ np.uint64(v)).astype(np.int16)
            cut = int(np.median(d))
            seam = int(((d >= cut - radius + 1) & (d <= cut + radius)).sum())
            if (d <= cut).any() and (d > cut).any() and (best is None or seam < best[0]):
                best = seam, v, cut
        if best is None or best[0] > 0.95 * len(pool):  # no vantage point parts these rows
            _compare(x, left, right, radius, links)
            continue
        _, v, cut = best
        dl = np.bitwise_count(x[left] ^ np.uint64(v)).astype(np.int16)
        dr = dl if same else np.bitwise_count(x[right] ^ np.uint64(v)).astype(np.int16)
        inner, outer = left[dl <= cut], left[dl > cut]
        todo += [(inner, inner), (outer, outer)] if same else [(inner, right[dr <= cut]), (outer, right[dr > cut])]
        low_l, high_l = left[(dl <= cut) & (dl > cut - radius)], left[(dl > cut) & (dl <= cut + radius)]
        low_r, high_r = right[(dr <= cut) & (dr > cut - radius)], right[(dr > cut) & (dr <= cut + radius)]
        todo.append((low_l, high_r))
        if not same:
            todo.append((high_l, low_r))


def _shard_stars(shard: np.ndarray, fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Stars of all links in rows sorted by shard, then fp: the fingerprint and the least one it reaches."""
    x, links = fp.view(np.uint64), Links(len(fp))
    cuts = np.flatnonzero(np.diff(shard)) + 1
    starts, stops = np.append(0, cuts), np.append(cuts, len(fp))
    size = stops - starts
    for i in np.flatnonzero(size > LEAF).tolist():
        tree_links(x, np.arange(starts[i], stops[i]), radius, links)
    small = np.repeat(size <= LEAF, size)
    for step in range(1, int(size[size <= LEAF].max(initial=1))):
        at = np.flatnonzero(small[:-step] & (shard[step:] == shard[:-step]))
        at = at[np.bitwise_count(x[at] ^ x[at + step]) <= radius]
        links.add(at, at + step)
    label = links.labels()
    rows = np.flatnonzero(label != np.arange(len(fp)))
    return fp[rows], fp[label[rows]]


def links(prints: DataFrame, radius: int = 2, largest: int = 30_000) -> DataFrame:
    """Stars (a, b), a > b, that connect the same distinct fingerprints ``fp`` as all pairs within ``radius`` bits do.

    A shard with more than ``largest`` rows is parted by further bands.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, fp = np.zeros(0, np.int64), np.zeros(0, np.int64)
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
        for batch in batches:
            shard = np.concatenate([shard, batch.column(0).to_numpy()])
            fp = np.concatenate([fp, batch.column(1).to_numpy()])
            if len(shard) < 20_000:
                continue
            cut = int(np.searchsorted(shard, shard[-1]))  # the last shard may go on
            if cut:
                a, b = _shard_stars(shard[:cut], fp[:cut], radius)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], schema=schema)
                shard, fp = shard[cut:], fp[cut:]
        if len(shard):
            a, b = _shard_stars(shard, fp, radius)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], schema=schema)

    found, todo, level = [], [(prints.select("fp", F.lit(0).cast("bigint").alias("shard")), list(range(BITS)))], 0
    while todo:
        dealt = []
        for rows, bits in todo:
            dealt += _shard(rows, bits, level, radius)
        todo = []
        if level == 0 or len(dealt[0][1]) > radius:
            whole = dealt[0][0].withColumn("way", F.lit(0))
            for i, (rows, _) in enumerate(dealt[1:], 1):
                whole = whole.union(rows.withColumn("way", F.lit(i)))
            whole = stored(whole)
            hot = whole.groupBy("way", "shard").count().filter(F.col("count") > largest).select("way", "shard")
            hot = stored(hot)
            ways = {r.way for r in hot.groupBy("way").count().collect()}
            if ways:
                todo = [(stored(whole.join(hot.filter(F.col("way") == w), ["way", "shard"], "left_semi").select("fp", "shard")), dealt[w][1]) for w in sorted(ways)]
                whole = whole.join(hot, ["way", "shard"], "left_anti")
            whole = whole.select("shard", "fp")
        else:  # no bits are left to part by
            whole = dealt[0][0]
            for rows, _ in dealt[1:]:
                whole = whole.union(rows)
            whole = whole.select("shard", "fp")
        found.append(whole.repartition("shard").sortWithinPartitions("shard", "fp").mapInArrow(run, "a bigint, b bigint"))
        level += 1
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out.distinct()


def connected(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) of every node that is not the least of its component, from edges (a, b) with a > b.

    Each round points every node at its least neighbour, passes its other
    neighbours on to that one, and doubles the pointers' reach.  Hubs are split by
    adaptive execution: all sides of the joins are written tables.
    """
    now = Stored(edges.select("a", "b"))
    for _ in range(most_rounds):
        least = Stored(now.df.groupBy("a").agg(F.min("b").alias("p")))
        e, p = now.df, least.df
        rest = e.join(p, "a").filter("b <> p").select(F.greatest("b", "p").alias("a"), F.least("b", "p").alias("b"), F.lit(True).alias("moved"))
        jump = p.join(p.select(F.col("a").alias("p"), F.col("p").alias("q")), "p", "left").select("a", F.coalesce("q", "p").alias("b"), F.col("q").isNotNull().alias("moved"))
        after = Stored(rest.distinct().union(jump))
        moved = after.df.filter("moved").limit(1).count()
        now.drop()
        least.drop()
        now = after
        if not moved:
            return now.df.select(F.col("a").alias("node"), F.col("b").alias("root"))
    raise RuntimeError("components did not settle")


def near_duplicates(docs: DataFrame, width: int = 3, radius: int = 2, seed: int = 42, largest: int = 30_000, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, fp (bigint), fingerprint (16 hex digits), component_id (least id reachable), component_size (rows).

    Texts are linked when their fingerprints differ in ``radius`` bits at most.  A
    null or wordless text has fingerprint zero and is linked like any other;
    repeated rows belong to one component; a null id never becomes a component_id
    unless the component has no other.  Other columns are ignored.  An empty
    table gives an empty result.  Fingerprints, links and labels are written to
    the shared folder, so lost executors repeat a stage at most.
    """
    prints = stored(fingerprints(docs, width, seed, id_column, text_column))
    with scratch(docs.sparkSession) as keep:  # links and labels go once every fingerprint has its class
        distinct = stored(prints.groupBy("fp").agg(F.min(id_column).alias("rep"), F.count(F.lit(1)).alias("n")))
        labels = connected(links(distinct.select("fp"), radius, largest))
        named = stored(distinct.join(labels.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "rep", "n", F.coalesce("root", "fp").alias("root")))
        roots = stored(named.groupBy("root").agg(F.min("rep").alias("component_id"), F.sum("n").alias("component_size")))
        classes = keep(named.select("fp", "root").join(roots, "root").select("fp", "component_id", "component_size")).df
    return prints.join(classes, "fp").select(id_column, "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "component_size")
