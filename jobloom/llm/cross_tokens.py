"""Alignment of two tokenizers' tokens over the same bytes, and how common their pairs are.

Both tokenizers write a text's bytes; where the cumulative ends of their tokens
agree, a group ends.  A two-pointer merge of the ends gives the groups and the links
(overlapping pairs of tokens): between two ends that follow each other lies a part of exactly one
token of either side, so each end in the merge is one link.  The merge runs over a
block of texts at once, as array operations.

A block of texts names its distinct pairs once.  Spark sums in how many documents
each pair is linked, takes each first-side id's highest count, joins both back to
the blocks' pairs, and hands them to the block's documents.  Rows that are shuffled are a
block's distinct pairs, not links or pairs of documents.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from jobloom.llm.byte_bpe import byte_table
from jobloom.llm.common import Stored, give_back, ship, stored, text_blocks

#: Bytes of text in a block, and characters of a piece in which longer texts are encoded.
BLOCK_BYTES, PIECE = 2 << 20, 256 << 10
#: Units that either of a worker's two generations remembers, and characters of the longest that is.
MOST_UNITS, LONGEST_UNIT = 100_000, 64
UNITS = re.compile(" +[^ ]*")


class ByteVocabulary:
    """Side A: byte-level BPE of a ``.json`` file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        vocabulary, table = told["model"]["vocab"], byte_table()
        special = {t["id"]: t["content"] for t in told["added_tokens"]}
        self.bytes_of = [b""] * (max([*vocabulary.values(), *special]) + 1)
        for word, i in vocabulary.items():
            self.bytes_of[i] = special[i].encode() if i in special else bytes(table[c] for c in word)
        merges = [m.split(" ") if isinstance(m, str) else m for m in told["model"]["merges"]]
        plain = told["pre_tokenizer"] == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True} and not told["normalizer"] and not told["model"].get("ignore_merges")
        if plain and all(vocabulary[a + b] == 256 + i for i, (a, b) in enumerate(merges)):  # ids are ranks: the same merges by a faster library
            ranks = {self.bytes_of[i]: i for i in range(256 + len(merges))}
            self.encode = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        else:
            tokenizer = Tokenizer.from_file(path)
            tokenizer.encode_special_tokens = True
            self.encode = lambda text: tokenizer.encode(text, add_special_tokens=False).ids

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.frombuffer(array("i", self.encode(x)), np.int32) for x in texts]


class PieceVocabulary:
    """Side B: pieces of a ``.model`` file.  Texts begin with the space that the library would add.

    Where no piece holds a space after another character and texts aren't normalised,
    a run of spaces and the characters up to the next make a unit of their own,
    which is encoded when it is first met.
    """

    def __init__(self, path: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.library.get_piece_size()
        names = [self.library.id_to_piece(i) for i in range(n)]
        odd = lambda i: self.library.is_control(i) or self.library.is_unknown(i) or self.library.is_unused(i)
        self.bytes_of = [b"\xff" if odd(i) else bytes([int(x[3:5], 16)]) if self.library.is_byte(i) else x.replace("▁", " ").encode() for i, x in enumerate(names)]
        sample = "ﬁ① é é Å  x\tÄ"
        self.in_units = not any("▁" in x.lstrip("▁") for x in names) and self.library.normalize(sample).replace("▁", " ") == f" {sample}"
        self.lone = np.array(self.library.encode("x ")[len(self.library.encode("x")) :], np.int32).tobytes()  # a space at a text's end: alone, the library would encode nothing
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        if not self.in_units:
            return [np.array(x, np.int32) for x in self.library.encode([x[1:] for x in texts], num_threads=1)]
        found = [UNITS.findall(x) for x in texts]
        once = {}
        if len(self.known) > MOST_UNITS:
            self.known, self.older = {}, self.known
        self.known[" "] = self.lone
        known, older, new = self.known, self.older, []
        for x in set().union(*found).difference(known):
            if (ids := older.get(x)) is not None:
                known[x] = ids
            else:
                new.append(x)
        for x, ids in zip(new, self.library.encode([x[1:] for x in new], num_threads=1)):
            (known if len(x) <= LONGEST_UNIT else once)[x] = array("i", ids).tobytes()
        get = (lambda x: known[x] if x in known else once[x]) if once else known.__getitem__
        return [np.frombuffer(b"".join(map(get, units)), np.int32) for units in found]


def pieces(text: str, size: int = PIECE) -> list[str]:
    """A text that begins with a space, cut before single spaces between other characters: there both tokenizers begin anew.  Without such spaces it stays whole."""
    out, at = [], 0
    while len(text) - at > size:
        cut = next((m.start() + 1 for m in re.compile(r"[^\s] (?=[^\s])").finditer(text, at + size - 1)), None)
        if cut is None:
            break
        out.append(text[at:cut])
        at = cut
    return [*out, text[at:]]


class Side:
    """A vocabulary's bytes as tables."""

    def __init__(self, vocabulary, marks: str):
        self.ids = vocabulary.ids
        self.sizes = np.array([len(x) for x in vocabulary.bytes_of], np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.table = np.frombuffer(b"".join(vocabulary.bytes_of), np.uint8)
        self.texts = [f"{i}{m}".encode() for i in range(len(self.sizes)) for m in marks]  # an id, and what follows it in a group

    def bytes_of(self, ids: np.ndarray, ends: np.ndarray) -> np.ndarray:
        sizes = self.sizes[ids]
        return self.table[np.repeat(self.begins[ids] - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)]


class Aligner:
    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = Side(ByteVocabulary(a_path), ",|"), Side(PieceVocabulary(b_path), ",;")
        self.texts = self.a.texts + self.b.texts
        self.n_b = len(self.b.sizes)

    def aligned(self, texts: list[str]) -> tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray]:
        """Of texts that begin with a space: whole (whether both sides' bytes are the text's); the groups of each, ending in ";"; counts (n_a, n_b, n_groups, n_links by text); links (text, pair)."""
        data = [x.encode() for x in texts]
        sizes = np.array([len(x) for x in data], np.int64)
        found = [side.ids(texts) for side in (self.a, self.b)]
        whole = np.ones(len(texts), bool)
        for side, ids in zip((self.a, self.b), found):
            whole &= np.array([int(side.sizes[x].sum()) for x in ids]) == sizes
        ids, ends, owner = [], [], []
        for side, own in zip((self.a, self.b), found):
            kept = [x for x, w in zip(own, whole) if w]
            ids.append(np.concatenate(kept or [np.zeros(0, np.int32)]))
            ends.append(np.cumsum(side.sizes[ids[-1]]))
            owner.append(np.repeat(np.flatnonzero(whole), [len(x) for x in kept]))
        want = np.frombuffer(b"".join(x for x, w in zip(data, whole) if w), np.uint8)
        wrong = np.flatnonzero((self.a.bytes_of(ids[0], ends[0]) != want) | (self.b.bytes_of(ids[1], ends[1]) != want))
        if len(wrong):  # as long as the text, yet other bytes
            whole[np.flatnonzero(whole)[np.searchsorted(np.cumsum(sizes[whole]), wrong, "right")]] = False
            keep = [whole[x] for x in owner]
            ids, owner = [x[k] for x, k in zip(ids, keep)], [x[k] for x, k in zip(owner, keep)]
            ends = [np.cumsum(side.sizes[x]) for side, x in zip((self.a, self.b), ids)]
        (a, b), (a_ends, b_ends) = ids, ends

        shared_b = a_ends[np.searchsorted(a_ends, b_ends)] == b_ends if len(b) else np.zeros(0, bool)
        shared_a = np.zeros(len(a), bool)
        shared_a[np.searchsorted(a_ends, b_ends[shared_b])] = True
        only_b = b_ends[~shared_b]
        n = len(a) + len(only_b)
        at_a = np.arange(len(a)) + np.searchsorted(only_b, a_ends)  # places of A's ends in the merge
        ends_a, ends_b = np.zeros(n, np.int64), np.ones(n, np.int64)
        ends_a[at_a], ends_b[at_a] = 1, shared_a
        link_a, link_b = np.cumsum(ends_a) - ends_a, np.cumsum(ends_b) - ends_b

        group_a, group_b = np.cumsum(shared_a) - shared_a, np.cumsum(shared_b) - shared_b
        first_b = np.concatenate([[0], np.flatnonzero(shared_b) + 1])
        last_a = np.flatnonzero(shared_a) + 1
        codes = np.empty(len(a) + len(b), np.int64)
        codes[np.arange(len(a)) + first_b[group_a]] = a * 2 + shared_a
        codes[np.arange(len(b)) + last_a[group_b]] = len(self.a.texts) + b * 2 + shared_b
        k = len(texts)
        n_a, n_b = (np.bincount(x, minlength=k) for x in owner)
        stops = np.cumsum(n_a + n_b)
        groups = [b"".join(map(self.texts.__getitem__, codes[i:j].tolist())) for i, j in zip(stops - n_a - n_b, stops)]
        of = owner[0][link_a]
        counts = np.stack([n_a, n_b, np.bincount(owner[0][shared_a], minlength=k), np.bincount(of, minlength=k)])
        return whole, groups, counts, np.stack([of, a[link_a].astype(np.int64) * self.n_b + b[link_b]])


class Block:
    """Documents of a block: their counts and digests, the block's distinct pairs, and how often each document links which."""

    def __init__(self, aligner: Aligner, texts: list[str]):
        self.n = len(texts)
        self.counts, self.digests = np.zeros((4, self.n), np.int64), [""] * self.n
        cut = [(i, x) for i, text in enumerate(texts) if text for x in pieces(" " + text)]
        hashes, bad, parts, waiting, held = [hashlib.sha256() for _ in texts], np.zeros(self.n, bool), [], [], 0
        last = [b""] * self.n

        def take() -> None:
            owners = np.array([i for i, _ in waiting], np.int64)
            whole, groups, counts, links = aligner.aligned([x for _, x in waiting])
            np.logical_or.at(bad, owners[~whole], True)
            for i, x in zip(owners.tolist(), groups):
                hashes[i].update(last[i] + x[:-1])
                last[i] = b";"
            np.add.at(self.counts.T, owners, counts.T)
            if links.shape[1]:
                parts.append(_summed(owners[links[0]], links[1], np.ones(links.shape[1], np.int64)))
            waiting.clear()

        for i, x in cut:
            waiting.append((i, x))
            held += len(x)
            if held >= BLOCK_BYTES:
                take()
                held = 0
        if waiting:
            take()
        doc, pair, times = (np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, np.int64),) * 3
        if len(parts) > 1:
            doc, pair, times = _summed(doc, pair, times)
        keep = ~bad[doc]
        doc, pair, times = doc[keep], pair[keep], times[keep]
        self.counts[:, bad] = 0
        self.digests = [x.hexdigest() if g else "" for x, g in zip(hashes, self.counts[2].tolist())]
        place, self.pairs = pd.factorize(pair)
        self.held = np.bincount(place, minlength=len(self.pairs))
        order = np.argsort(doc, kind="stable")
        doc, self.place, self.times = doc[order], place[order].astype("<u4"), times[order].astype("<u4")
        self.stops = np.cumsum(np.bincount(doc, minlength=self.n))


def _summed(doc: np.ndarray, pair: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (doc, pair) and the sum of ``times``."""
    number, names = pd.factorize(pair)
    place, keys = pd.factorize(doc * len(names) + number)
    return keys // max(1, len(names)), names[keys % max(1, len(names))], np.bincount(place, times, len(keys)).astype(np.int64)


_aligners: dict[tuple[str, str], Aligner] = {}


def _aligner(a_path: str, b_path: str) -> Aligner:
    if (a_path, b_path) not in _aligners:
        _aligners[a_path, b_path] = Aligner(a_path, b_path)
        give_back()
    return _aligners[a_path, b_path]


def aligned_blocks(docs: DataFrame, a_path: str, b_path: str, id_column: str = "doc_id", text_column: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs``: block, id, n_a, n_b, n_groups, n_links, groups_sha256, places and times (its distinct pairs in the block's list, little-endian uint32), and in a block's first row pairs and held (in how many of its documents each is linked)."""
    ship(docs.sparkSession)
    kind = docs.schema[id_column].dataType.simpleString()
    counts = ("n_a", "n_b", "n_groups", "n_links")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, number = _aligner(a_path, b_path), TaskContext.get().partitionId() << 32
        for part, texts in text_blocks(batches, text_column, block_bytes):
            block = Block(aligner, texts)
            starts = np.concatenate([[0], block.stops[:-1]])
            cuts = list(zip((starts * 4).tolist(), (block.stops * 4).tolist()))
            places, times = block.place.tobytes(), block.times.tobytes()
            rest = [None] * (block.n - 1)
            columns = [pa.array([number] * block.n, pa.int64()), part.column(id_column), *[pa.array(x) for x in block.counts], pa.array(block.digests), pa.array([places[i:j] for i, j in cuts], pa.binary()), pa.array([times[i:j] for i, j in cuts], pa.binary()), pa.array([block.pairs, *rest], pa.list_(pa.int64())), pa.array([block.held, *rest], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["block", id_column, *counts, "groups_sha256", "places", "times", "pairs", "held"])
            number += 1

    return docs.select(id_column, text_column).mapInArrow(run, f"block bigint, `{id_column}` {kind}, {', '.join(f'{c} bigint' for c in counts)}, groups_sha256 string, places binary, times binary, pairs array<bigint>, held array<bigint>")


def pair_counts(blocks: DataFrame, n_b: int) -> DataFrame:
    """(pair, a, b, n, best_a, best_b): every linked pair of ids, the documents that hold it linked, and the highest such count of either id."""
    each = blocks.filter("pairs IS NOT NULL").select(F.explode(F.arrays_zip("pairs", "held")).alias("x")).select(F.col("x.pairs").alias("pair"), F.col("x.held").alias("held"))
    counts = stored(each.groupBy("pair").agg(F.sum("held").alias("n")).select("pair", F.floor(F.col("pair") / n_b).cast("int").alias("a"), (F.col("pair") % n_b).cast("int").alias("b"), "n"))
    best = [counts.groupBy(side).agg(F.max("n").alias(f"best_{side}")) for side in ("a", "b")]
    return stored(counts.join(best[0], "a").join(best[1], "b").select("pair", "a", "b", "n", "best_a", "best_b"))


def align(docs: DataFrame, a_path: str | None = None, b_path: str | None = None, id_column: str = "doc_id", text_column: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs``: id, n_a, n_b, n_groups, n_links, n_best, n_best_b, count_sum, groups_sha256.

    n_best and n_best_b count the links whose pair has the highest document count of
    its A or B id, ties included; count_sum adds up the counts of all links.  A null or
    empty text, and one whose bytes either side can't give back, has no tokens: zeros
    and an empty digest.  A null id stays null; repeated rows are documents of their
    own; special strings are ordinary text; other columns are ignored.  An empty table gives an empty result.
    A text longer than a piece is encoded in pieces where both tokenizers begin anew,
    at a space; one of a single long word is held whole.
    """
    a_path, b_path = a_path or public_tokenizers.path("byte_bpe_50k.json"), b_path or public_tokenizers.path("piece_bpe_32k.model")
    n_b = sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()
    written = Stored(aligned_blocks(docs, a_path, b_path, id_column, text_column, block_bytes))
    blocks = written.df
    counts = pair_counts(blocks, n_b).select("pair", "n", (F.col("n") == F.col("best_a")).alias("top_a"), (F.col("n") == F.col("best_b")).alias("top_b"))
    listed = blocks.filter("pairs IS NOT NULL").select("block", F.posexplode("pairs").alias("at", "pair"))
    told = listed.join(counts, "pair").select("block", "at", "n", "top_a", "top_b")
    own = [id_column, "n_a", "n_b", "n_groups", "n_links"]
    kind = docs.schema[id_column].dataType.simpleString()

    def finish(docs_of: pa.Table, told: pa.Table) -> pa.Table:
        at = told.column("at").to_numpy()
        values = np.zeros((3, len(at)), np.int64)
        for row, name in zip(values, ("top_a", "top_b", "n")):
            row[at] = told.column(name).to_numpy()
        sums = np.zeros((3, docs_of.num_rows), np.int64)
        for i, (places, times) in enumerate(zip(docs_of.column("places").to_pylist(), docs_of.column("times").to_pylist())):
            sums[:, i] = values[:, np.frombuffer(places, "<u4")] @ np.frombuffer(times, "<u4").astype(np.int64)
        return pa.table([*[docs_of.column(c) for c in own], *map(pa.array, sums), docs_of.column("groups_sha256")], names=[*own, "n_best", "n_best_b", "count_sum", "groups_sha256"])

    both = written.df.drop("pairs", "held").groupBy("block").cogroup(told.groupBy("block"))
    return both.applyInArrow(finish, f"`{id_column}` {kind}, {', '.join(f'{c} bigint' for c in [*own[1:], 'n_best', 'n_best_b', 'count_sum'])}, groups_sha256 string")
