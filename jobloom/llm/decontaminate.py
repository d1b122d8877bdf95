"""Benchmark decontamination with a distributed positional inverted index.

The index consists of segments, one row for some megabytes of documents: its
words, and for each word the sorted positions at which it stands, as bytes of
differences.  Segments are written to the shared folder.  A search first counts the
test items' words in the whole index, and meets every segment with the items.  Each
window of test words starts from the list of its rarest word, and that list is
intersected with the lists of the words around it, adjusted by their offsets: those
next to it first, so that almost every candidate falls at once.  Windows that start
from the same word are followed together.  With a slop, a word may stand so many
places from where it would, counted from the window's rarest word.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobloom.llm.common import fresh, give_back, scratch, ship, stored, text_blocks

WINDOW = 13
GAP = 64  # positions between documents, so that no phrase or proximity match spans two
#: Bytes of test text that are sent to the executors at once; larger benchmarks go in blocks.
BLOCK_BYTES = 16 << 20

#: Bytes as words have them: digits, letters in lower case and everything beyond ASCII; the rest parts words.
_WORD_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def pack(gaps: np.ndarray, heads: np.ndarray, values: np.ndarray) -> bytes:
    """Rising numbers, list after list, as differences of 7 bits a byte, the lowest first; the high bit says that more follow.  At ``heads`` a list begins, with its own first value."""
    gaps = gaps.copy()
    gaps[heads[heads < len(gaps)]] = values[heads[heads < len(gaps)]]
    if not len(gaps):
        return b""
    width = np.ones(len(gaps), np.int64)
    for bits in (7, 14, 21, 28):
        width += gaps >> bits > 0
    ends = np.cumsum(width)
    out = np.zeros(int(ends[-1]), np.uint8)
    for k in range(int(width.max())):
        has = width > k
        out[(ends - width)[has] + k] = (gaps[has] >> (7 * k) & 127) | np.where(width[has] > k + 1, 128, 0)
    return out.tobytes()


def unpack(data: bytes, cuts: np.ndarray) -> np.ndarray:
    """What ``pack`` wrote; ``cuts`` are where lists begin, and the end."""
    raw = np.frombuffer(data, np.uint8)
    if not len(raw):
        return np.zeros(0, np.int64)
    last = raw < 128
    ends = np.flatnonzero(last)
    starts = np.append(0, ends[:-1] + 1)
    place = np.arange(len(raw)) - np.repeat(starts, ends - starts + 1)
    gaps = np.add.reduceat((raw & 127).astype(np.int64) << (7 * place), starts)
    sums = np.cumsum(gaps)
    sizes = np.diff(cuts)
    before = np.where(cuts[:-1] > 0, sums[np.maximum(cuts[:-1] - 1, 0)], 0)  # of all lists before
    return sums - np.repeat(before, sizes)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_WORD_BYTES).split()


def build_index(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", segment_bytes: int = 2 << 20) -> DataFrame:
    """Segments: segment (its number), ids, sizes (words of each), terms (space-joined), cuts (of each term's list), positions."""
    ship(docs.sparkSession)
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        first = (task.partitionId() if task else 0) << 32
        for number_here, (part, texts) in enumerate(text_blocks(batches, text_column, segment_bytes)):
            number: defaultdict[bytes, int] = defaultdict(count().__next__)
            # one text's words at a time: as objects they take many times what their numbers do
            numbers = [np.fromiter(map(number.__getitem__, words_of(x)), np.int32) for x in texts]
            sizes = np.array([len(x) for x in numbers], np.int32)
            terms, term = list(number), np.concatenate([np.zeros(0, np.int32), *numbers])
            bases = np.cumsum(sizes + GAP) - sizes
            place = np.arange(len(term)) + np.repeat(bases - (np.cumsum(sizes) - sizes), sizes)
            order = np.argsort(term, kind="stable")
            cuts = np.append(0, np.cumsum(np.bincount(term, minlength=len(terms))))
            ids = part.column(id_column)
            fields = pa.schema([("segment", pa.int64()), pa.field("ids", pa.list_(ids.type)), ("sizes", pa.binary()), ("terms", pa.binary()), ("cuts", pa.binary()), ("positions", pa.binary())])
            yield pa.RecordBatch.from_arrays([pa.array([first + number_here]), pa.array([ids.to_pylist()], fields.field("ids").type), *(pa.array([x], pa.binary()) for x in (sizes.tobytes(), b" ".join(terms), cuts.astype(np.int32).tobytes(), pack(np.diff(place[order], prepend=0), cuts[:-1], place[order])))], schema=fields)

    return docs.select(id_column, text_column).mapInArrow(run, f"segment bigint, ids array<{kind}>, sizes binary, terms binary, cuts binary, positions binary")


class Items:
    """Test items as numbers of their words, laid end to end."""

    def __init__(self, items: list[tuple[str, str | None]], window: int = WINDOW, slop: int = 0):
        lists = [(str(i), words_of(text)) for i, text in items]
        lists = [(i, w) for i, w in lists if w]
        self.names = [i for i, _ in lists]
        self.vocabulary = list(dict.fromkeys(w for _, x in lists for w in x))
        number = dict(zip(self.vocabulary, range(len(self.vocabulary))))
        self.terms = np.array([number[w] for _, x in lists for w in x], np.int64)
        sizes = np.array([len(w) for _, w in lists], np.int64)
        self.ends = np.cumsum(sizes)
        self.begins = self.ends - sizes
        self.item = np.repeat(np.arange(len(lists)), sizes)
        self.windows: list[tuple[int, np.ndarray]] = []  # length, first words
        for size in range(1, window + 1):
            which = np.flatnonzero(sizes >= window if size == window else sizes == size)
            if len(which):
                self.windows.append((size, np.concatenate([np.arange(self.begins[i], self.ends[i] - size + 1) for i in which])))
        self.slop = slop
        self.anchors: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = []

    def count(self, counts: np.ndarray) -> None:
        """Sets the anchors, given how often each word of the vocabulary stands in the whole index: (window's length, places of the words that are the rarest of a window all of whose words occur, and the first and last such window of each)."""
        counts = counts[self.terms]
        self.anchors = []
        for size, firsts in self.windows:
            span = counts[firsts[:, None] + np.arange(size)]
            able = (span > 0).all(1)
            firsts = firsts[able]
            rarest, which = np.unique(firsts + span[able].argmin(1), return_inverse=True)
            low, high = np.full(len(rarest), len(self.terms)), np.full(len(rarest), -1)
            np.minimum.at(low, which, firsts)
            np.maximum.at(high, which, firsts)
            self.anchors.append((size, rarest, low, high))


class Segment:
    def __init__(self, sizes: bytes, terms: bytes, cuts: bytes, positions: bytes):
        self.sizes = np.frombuffer(sizes, np.int32).astype(np.int64)
        self.terms = terms.split(b" ") if terms else []
        self.cuts = np.frombuffer(cuts, np.int32).astype(np.int64)
        self.positions = unpack(positions, self.cuts)
        self.bases = np.cumsum(self.sizes + GAP) - self.sizes
        self.wide = int(self.bases[-1] + self.sizes[-1] + GAP) + 1 if len(self.sizes) else 1
        #: All lists as one sorted list: a word's number and a position.
        self.keys = np.repeat(np.arange(len(self.terms)) * self.wide, np.diff(self.cuts)) + self.positions

    def numbers(self, vocabulary: list[bytes]) -> np.ndarray:
        """Numbers here of the vocabulary's words; -1 for those that don't occur."""
        known = dict(zip(self.terms, range(len(self.terms))))
        return np.array([known.get(w, -1) for w in vocabulary], np.int64)

    def counts(self, local: np.ndarray) -> np.ndarray:
        size = np.append(np.diff(self.cuts), 0)
        return size[local]

    def holds(self, term: np.ndarray, at: np.ndarray, slop: int) -> np.ndarray:
        """Whether the lists of these words have a position within ``slop`` of each."""
        if not len(self.keys):
            return np.zeros(len(at), bool)
        low = np.maximum(at - slop, 0) + term * self.wide
        found = self.keys[np.minimum(np.searchsorted(self.keys, low), len(self.keys) - 1)]
        return (term >= 0) & (found >= low) & (found <= term * self.wide + at + slop)


def _extent(segment: Segment, at_doc: np.ndarray, at_item: np.ndarray, bound: np.ndarray, step: int, most: int, local: np.ndarray, slop: int) -> np.ndarray:
    """Words around each candidate whose lists hold them, in direction ``step``, up to ``most``."""
    out = np.zeros(len(at_doc), np.int64)
    live = np.arange(len(at_doc))
    for k in range(1, most + 1):
        q = at_item[live] + step * k
        live, q = live[ok := (q < bound[live] if step > 0 else q >= bound[live])], q[ok]
        live = live[segment.holds(local[q], at_doc[live] + step * k, slop)]
        if not len(live):
            break
        out[live] = k
    return out


def hits(segment: Segment, items: Items, slop: int = 0, most: int = 250_000) -> tuple[np.ndarray, ...]:
    """(start, end, item, place of the rarest word) of occurrences in the segment; exact ones as runs of overlapping windows.  Candidates are followed ``most`` at a time, or one word's."""
    local = segment.numbers(items.vocabulary)[items.terms]
    counts = segment.counts(local)
    found = [np.zeros((4, 0), np.int64)]
    for size, anchors, low, high in items.anchors:
        here = counts[anchors] > 0
        anchors, low, high = anchors[here], low[here], high[here]
        lengths = counts[anchors]
        ends = np.cumsum(lengths)
        begin = 0
        while begin < len(anchors):
            stop = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + most)))
            n = lengths[begin:stop]
            which = np.repeat(np.arange(begin, stop), n)
            q = anchors[which]
            p = segment.positions[np.repeat(segment.cuts[local[anchors[begin:stop]]], n) + np.arange(len(q)) - np.repeat(np.cumsum(n) - n, n)]
            right = _extent(segment, p, q, items.ends[items.item[q]], 1, size - 1, local, slop)
            # To the left only what can still reach a window of this anchor.
            go = np.flatnonzero(q + right >= low[which] + size - 1)
            which, q, p, right = which[go], q[go], p[go], right[go]
            left = _extent(segment, p, q, items.begins[items.item[q]], -1, size - 1, local, slop)
            ok = np.maximum(low[which], q - left) <= np.minimum(high[which], q + right - size + 1)
            found.append(np.stack([(p - left)[ok], (p + right + 1)[ok], items.item[q[ok]], p[ok]]))
            begin = stop
    return tuple(np.concatenate(found, 1))


def counted(index: DataFrame, vocabulary: list[bytes]) -> np.ndarray:
    """How often each word of the vocabulary stands in the whole index; only words and the lengths of their lists are read."""
    sent = index.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(sent.value), np.int64)
        for batch in batches:
            for terms, cuts in zip(batch.column(0), batch.column(1)):
                words = terms.as_py().split(b" ") if terms.as_py() else []
                known = dict(zip(words, np.diff(np.frombuffer(cuts.as_py(), np.int32)).tolist()))
                total += np.array([known.get(w, 0) for w in sent.value], np.int64)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["word", "n"])

    out = np.zeros(len(vocabulary), np.int64)
    for r in index.select("terms", "cuts").mapInArrow(run, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n")).collect():  # a row for a word of the block at most
        out[r.word] = r.n
    return out


def search(index: DataFrame, items: list[tuple[str, str | None]], window: int = WINDOW, slop: int = 0) -> DataFrame:
    """One row per indexed document: segment and row (its place), id, n_words, hits (arrays of start and end, in words, merged), items (names, sorted), near_items.

    near_items are those with a window all of whose words stand within ``slop`` places
    of where they would, counted from the window's rarest word in the whole index, of
    equal ones the first (proximity); with 0 they are left empty.
    """
    spark = index.sparkSession
    ship(spark)
    if slop + window >= GAP:
        raise ValueError(f"window and slop must stay below {GAP} together")
    tests = Items(items, window, slop)
    tests.count(counted(index, tests.vocabulary))
    sent = spark.sparkContext.broadcast(tests)
    kind = index.schema["ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests = sent.value
        for batch in batches:
            for i in range(batch.num_rows):  # one segment at a time: a batch holds many megabytes of them
                give_back()
                number, ids, *rest = (c[i].as_py() for c in batch.columns)
                segment = Segment(*rest)
                n = len(ids)
                start, end, item, at = hits(segment, tests)
                doc = np.searchsorted(segment.bases, at, "right") - 1
                places: list[list[list[int]]] = [[] for _ in range(n)]
                for d, a, b in sorted(set(zip(doc.tolist(), start.tolist(), end.tolist()))):
                    a, b, spans = a - int(segment.bases[d]), b - int(segment.bases[d]), places[d]
                    if spans and a <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], b)
                    else:
                        spans.append([a, b])
                names: list[set[str]] = [set() for _ in range(n)]
                for d, t in set(zip(doc.tolist(), item.tolist())):
                    names[d].add(tests.names[t])
                near: list[set[str]] = [set() for _ in range(n)]
                if tests.slop:
                    *_, item, at = hits(segment, tests, tests.slop)
                    doc = np.searchsorted(segment.bases, at, "right") - 1
                    for d, t in set(zip(doc.tolist(), item.tolist())):
                        near[d].add(tests.names[t])
                fields = pa.schema([("segment", pa.int64()), ("row", pa.int32()), pa.field("id", batch.schema.field("ids").type.value_type), ("n_words", pa.int64()), ("hits", pa.list_(pa.list_(pa.int32()))), ("items", pa.list_(pa.string())), ("near_items", pa.list_(pa.string()))])
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip([[number] * n, range(n), ids, segment.sizes, places, [sorted(x) for x in names], [sorted(x) for x in near]], fields)], schema=fields)

    schema = f"segment bigint, row int, id {kind}, n_words bigint, hits array<array<int>>, items array<string>, near_items array<string>"
    return index.select("segment", "ids", "sizes", "terms", "cuts", "positions").mapInArrow(run, schema)


def blocks_of(benchmark: DataFrame, item_column: str = "item_id", text_column: str = "text") -> Iterator[list[tuple[str, str | None]]]:
    """The test items in blocks of bounded size, of which the driver holds one; at least one block, which may be empty.  The items are a stated query set; the corpus never comes to the driver."""
    block, size = [], 0
    for item, text in benchmark.select(F.col(item_column).cast("string"), text_column).filter(F.col(text_column).isNotNull()).toLocalIterator():
        size += len(text.encode())
        if size > BLOCK_BYTES and block:
            yield block
            block, size = [], len(text.encode())
        block.append((item if item is not None else "null", text))
    yield block


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slop: int = 0, share: int = 20, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id") -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_hit, n_items, items (array), near_items (array), contaminated (n_hit > 0 and share * n_hit >= n_words).

    Words are runs of digits, letters and all beyond ASCII, A-Z in lower case.  A
    word is hit if it lies in any occurrence of a window of ``window`` consecutive
    words of an item; an item with fewer is one window.  A null or empty text has
    no words and is clean; items without words, and a null item text, match
    nothing; repeated items each count; repeated rows are judged each; other
    columns are ignored.  An empty table gives an empty result.
    """
    index = stored(build_index(docs, id_column, text_column))
    out = None
    for block in blocks_of(benchmark, item_column):
        found = search(index, block, window, slop)
        out = found if out is None else _merged(stored(out), stored(found))
    n_hit = F.aggregate("hits", F.lit(0).cast("bigint"), lambda acc, s: acc + s[1] - s[0])
    out = out.select(F.col("id").alias(id_column), "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"), "items", "near_items")
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words")))


def _merged(a: DataFrame, b: DataFrame) -> DataFrame:
    """Results of two blocks of test items over the same documents, which meet by their place in the index."""
    union = lambda c: F.array_sort(F.array_union(f"a.{c}", f"b.{c}")).alias(c)
    joined = F.aggregate(
        F.array_sort(F.concat("a.hits", "b.hits")),
        F.array().cast("array<array<int>>"),
        lambda acc, s: F.when((F.size(acc) > 0) & (s[0] <= F.element_at(acc, -1)[1]), F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(F.array(F.element_at(acc, -1)[0], F.greatest(F.element_at(acc, -1)[1], s[1]))))).otherwise(F.concat(acc, F.array(s))),
    )
    return a.alias("a").join(b.alias("b"), ["segment", "row"]).select("segment", "row", "a.id", "a.n_words", joined.alias("hits"), union("items"), union("near_items"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_column: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that are not contaminated.

    Each text is judged for itself, whatever ids its rows have, null or shared: rows
    that repeat a contaminated text all go, others stay.  Null and empty texts are
    clean.  Other columns pass through; an empty table gives an empty result.
    """
    key = F.md5(F.coalesce(F.col(text_column), F.lit("")).cast("binary"))
    keyed = docs.select(F.unhex(key).alias("__key"), F.col(text_column).alias("__text"))
    with scratch(docs.sparkSession) as keep:  # the index goes once the contaminated texts are known
        found = contamination(keyed, benchmark, id_column="__key", text_column="__text", **options)
        gone = keep(found.filter("contaminated").select("__key").distinct()).df
    (name,) = fresh("key")
    return docs.withColumn(name, F.unhex(key)).join(gone.toDF(name), name, "left_anti").drop(name)
