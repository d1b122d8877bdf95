"""Token counts by finite-state transducers compiled from a byte-level BPE vocabulary.

A text passes through two transducers.  The first (``pretoken``) splits it into
words; its chunks' state maps compose through a parallel prefix scan.  The second
reads the bytes of every word; each of its transitions is annotated with the
number of tokens that it adds to the encoding of what was read so far.  It starts
anew with each word, so a word is a chunk whose map needs one state; a long word
is cut to chunks, whose maps (state at the end and tokens added, for the states that
chunks before them end in) compose by a scan.

That encoding is determined from left to right: the encoding of a prefix ends in
exactly one token, the one vocabulary entry that is a suffix of the prefix and may
stand after the last token of what lies before it (two tokens may stand together
if no merge across them comes before the merges that made them).  A state holds
the longest suffix that a longer entry could still begin with, the last tokens at
the positions in it that can matter, and their counts relative to the present one.
There are finitely many; they are compiled when first reached and the table is
emptied when it is full, so memory is bounded whatever the texts hold.
"""

from __future__ import annotations

import bisect
import json
import re
import sys
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame

from jobloom.llm.byte_bpe import byte_table
from jobloom.llm.common import batch_of, ship, text_blocks
from jobloom.llm.pretoken import Words, packs

ROOT = (b"", (-1,), (0,))
#: Bytes of a word beyond which it is cut to chunks, bytes read before a chunk to find the state it likely starts in, and chunks taken at once.
LONG, AHEAD, AT_ONCE = 512, 64, 256
#: Characters of text that a worker counts at once, be they one text or many.
BLOCK = 1 << 20


class TokenTransducer:
    """Deterministic transducer that counts the tokens of byte strings."""

    def __init__(self, path: str, most_states: int = 100_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        table = byte_table()
        to_bytes = lambda s: bytes(table[c] for c in s)
        self.special = sorted((t["content"] for t in spec["added_tokens"]), key=lambda x: (-len(x), x))
        if any(t.get(flag) for t in spec["added_tokens"] for flag in ("lstrip", "rstrip", "single_word")):
            raise ValueError("added tokens that look at what stands beside them are not supported")
        self.block = sys.maxsize if any(re.search(r"\s", x) for x in self.special) else BLOCK
        special = set(self.special)
        self.ids = {to_bytes(s): i for s, i in spec["model"]["vocab"].items() if s not in special}
        self.split: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        self.rank: dict[int, int] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = (to_bytes(x) for x in (pair.split(" ") if isinstance(pair, str) else pair))
            t = self.ids[a + b]
            self.split[t] = self.ids[a], self.ids[b]
            self.merged[self.split[t]] = t
            self.rank[t] = rank
        self.prefixes = {t[:k] for t in self.ids for k in range(1, len(t))}
        self.sorted = sorted(self.ids)
        self.extended: dict[bytes, list[int]] = {}
        self.joins: dict[tuple[int, int], bool] = {}
        self.sound: dict[int, bool] = {}
        self.most = most_states
        self._empty()

    def _empty(self) -> None:
        self.opened: dict[tuple[int, bytes], int | None] = {}
        self.set_numbers: dict[frozenset[int], int] = {}
        self.sets: list[frozenset[int]] = []
        self.numbers = {ROOT: 0}
        self.states = [ROOT]
        self.next = np.full(1024 * 256, -1, np.int32)
        self.adds = np.zeros(1024 * 256, np.int8)

    def may_join(self, left: int, right: int) -> bool:
        """Whether left, right is how their joined bytes are encoded, each being its own encoding."""
        key = left, right
        known = self.joins.get(key)
        if known is None:
            known = self.joins[key] = self._may_join(left, right)
            if len(self.joins) > 2_000_000:
                self.joins.clear()
        return known

    def _may_join(self, left: int, right: int) -> bool:
        rank, limit = self.rank, len(self.rank) + 1
        # Merges are undone latest first; a pair across the seam that merges before those undone would have been taken.
        while True:
            t = self.merged.get((left, right))
            if t is not None and rank[t] < limit:
                return False
            a, b = rank.get(left, -1), rank.get(right, -1)
            if a < 0 and b < 0:
                return True
            if a > b:  # the left part was made later
                limit, left = a, self.split[left][1]
            else:  # on a tie the left part's merge came first
                limit, right = b + 1, self.split[right][0]

    def is_sound(self, t: int) -> bool:
        """Whether the token is the encoding of its own bytes."""
        known = self.sound.get(t)
        if known is None:
            parts = self.split.get(t)
            known = self.sound[t] = parts is None or (self.is_sound(parts[0]) and self.is_sound(parts[1]) and self._alone(t))
        return known

    def _alone(self, t: int) -> bool:
        """Whether nothing merges across the seam of its parts before its own merge does."""
        left, right = self.split[t]
        limit, rank = self.rank[t], self.rank
        cap = len(rank) + 1
        while True:
            m = self.merged.get((left, right))
            if m is not None and m != t and rank[m] < min(limit, cap):
                return False
            a, b = rank.get(left, -1), rank.get(right, -1)
            if a < 0 and b < 0:
                return True
            if a > b:
                cap, left = a, self.split[left][1]
            else:
                cap, right = b + 1, self.split[right][0]

    def longer(self, seen: bytes) -> list[int]:
        """Vocabulary entries that begin with ``seen`` and go on."""
        found = self.extended.get(seen)
        if found is None:
            i = bisect.bisect_right(self.sorted, seen)
            j = bisect.bisect_left(self.sorted, seen + b"\xff" * 4, i)
            found = self.extended[seen] = [t for x in self.sorted[i:j] if x.startswith(seen) and self.is_sound(t := self.ids[x])]
        return found

    def openings(self, last: int, seen: bytes) -> int | None:
        """Number of the set of entries that can still come to stand after token ``last``, given that ``seen`` follows it; None if there are none.
        Two places with the same set behave alike, so the state holds the number and not the token."""
        key = last, seen
        if key in self.opened:
            return self.opened[key]
        able = frozenset(t for t in self.longer(seen) if last == -1 or self.may_join(last, t))
        number = None
        if able:
            number = self.set_numbers.setdefault(able, len(self.sets))
            if number == len(self.sets):
                self.sets.append(able)
        self.opened[key] = number
        return number

    def compile(self, state: int, byte: int) -> tuple[int, int]:
        """Adds the transition; the state it leads to and the tokens it adds.
        A state is (what was seen, by place the number of its set of openings or the negative code of a token, counts)."""
        seen, places, counts = self.states[state]
        word = seen + bytes((byte,))
        for q in range(len(word)):
            t, at = self.ids.get(word[q:]), places[q]
            if t is None or at is None:
                continue
            if at >= 0:
                if t in self.sets[at]:
                    break
            elif self.is_sound(t) and (at == -1 or self.may_join(-2 - at, t)):
                break
        else:
            raise ValueError("the vocabulary lacks a byte")
        adds = counts[q] + 1
        to_places, to_counts, begin = [], [], len(word)
        for i in range(len(word)):
            at, rest = places[i], word[i:]
            if at is not None and rest in self.prefixes:
                if at >= 0:  # the set narrows to what begins with the longer piece
                    at = self.narrowed(at, rest)
                elif len(rest) > 1:
                    at = self.openings(-1 if at == -1 else -2 - at, rest)
            else:
                at = None
            if at is not None:
                begin = min(begin, i)
            to_places.append(at)
            to_counts.append(counts[i] - adds if at is not None else None)
        to = (word[begin:], (*to_places[begin:], -2 - t), (*to_counts[begin:], 0))
        number = self.numbers.get(to)
        if number is None:
            number = self.numbers[to] = len(self.states)
            self.states.append(to)
            if number * 256 + 256 > len(self.next):
                self.next = np.concatenate([self.next, np.full(len(self.next), -1, np.int32)])
                self.adds = np.concatenate([self.adds, np.zeros(len(self.adds), np.int8)])
        at = state * 256 + byte
        self.next[at], self.adds[at] = number, adds
        return number, adds

    def narrowed(self, number: int, seen: bytes) -> int | None:
        key = -3 - number, seen
        if key not in self.opened:
            able = self.sets[number].intersection(self.longer(seen))
            self.opened[key] = None
            if able:
                self.opened[key] = self.set_numbers.setdefault(able, len(self.sets))
                if self.opened[key] == len(self.sets):
                    self.sets.append(able)
        return self.opened[key]

    def count(self, data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """Tokens of each word data[start:stop]; all words advance together, byte by byte."""
        if len(self.states) > self.most:
            self._empty()
        sizes = stops - starts
        out = np.zeros(len(starts), np.int64)
        for i in np.flatnonzero(sizes > LONG).tolist():
            out[i] = self.count_long(data, int(starts[i]), int(stops[i]))
        lengths = np.where(sizes > LONG, 0, sizes)
        out += self.run(data, starts, lengths, np.zeros(len(starts), np.int64))[1]
        return out

    def run(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """State at the end and tokens added of each stretch of bytes, from a state at its start; all advance together, byte by byte."""
        order = np.argsort(-lengths.astype(np.int16), kind="stable")  # LONG at most
        lengths = lengths[order]
        place, state, total = starts[order], states[order], np.zeros(len(order), np.int64)
        active = np.searchsorted(-lengths, -np.arange(int(lengths[0]) if len(lengths) else 0), "left")
        for j, n in enumerate(active.tolist()):
            at = state[:n] * 256 + data[place[:n] + j]
            to = self.next.take(at)
            if (missing := to < 0).any():
                for key in np.unique(at[missing]).tolist():
                    self.compile(key >> 8, key & 255)
                to = self.next.take(at)
            total[:n] += self.adds.take(at)
            state[:n] = to
        ends, added = np.empty_like(state), np.empty_like(total)
        ends[order], added[order] = state, total
        return ends, added

    def count_long(self, data: np.ndarray, start: int, stop: int) -> int:
        """Tokens of one long word.  Its chunks run from the states that the bytes just before them lead to; where the chunk before ends in another, it is run again from that."""
        kept, total = ROOT, 0
        for base in range(start, stop, LONG * AT_ONCE):
            if len(self.states) > self.most:
                self._empty()
            first = self.numbers.get(kept)
            if first is None:
                first = self.numbers[kept] = len(self.states)
                self.states.append(kept)
            begins = np.arange(base, min(stop, base + LONG * AT_ONCE), LONG)
            lengths = np.minimum(begins + LONG, stop) - begins
            ahead = np.minimum(begins - base, AHEAD)
            guessed = self.run(data, begins - ahead, ahead, np.zeros(len(begins), np.int64))[0]
            guessed[0] = first
            ends, added = self.run(data, begins, lengths, guessed)
            wrong = np.flatnonzero(ends[:-1] != guessed[1:]) + 1
            while len(wrong):  # composition: a chunk's start is the end of the one before
                guessed[wrong] = ends[wrong - 1]
                ends[wrong], added[wrong] = self.run(data, begins[wrong], lengths[wrong], guessed[wrong])
                wrong = np.flatnonzero(ends[:-1] != guessed[1:]) + 1
            total += int(added.sum())
            kept = self.states[int(ends[-1])]
        return total


_transducers: dict[str, TokenTransducer] = {}


def transducer(path: str) -> TokenTransducer:
    if path not in _transducers:
        _transducers[path] = TokenTransducer(path)
    return _transducers[path]


def count_texts(texts: list[str], path: str) -> tuple[list[int], list[int]]:
    """UTF-8 bytes and tokens of each text.  The vocabulary's special strings count as one token each, as the library takes them by default."""
    machine = transducer(path)
    tokens = np.zeros(len(texts), np.int64)
    for part, owners in packs(texts, machine.block):
        words = Words(part, machine.special)
        counts = machine.count(np.frombuffer(words.data, np.uint8), words.starts, words.stops)
        np.add.at(tokens, owners, np.bincount(words.owner, counts, len(part)).astype(np.int64) + words.specials)
    return [len(x.encode()) for x in texts], tokens.tolist()


def token_counts(docs: DataFrame, path: str | None = None, limit: int = 1024, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, n_bytes, n_tokens, over_limit (more tokens than ``limit``).

    path: a byte-level BPE vocabulary of the tokenizers library (.json).  A null
    text is empty: no bytes, no tokens.  A null id stays null; repeated rows are
    counted each.  Other columns are ignored, whatever their names.  An empty
    table gives an empty result.  No shuffle; one pass.
    """
    ship(docs.sparkSession)
    path = path or public_tokenizers.path("byte_bpe_50k.json")
    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"`{id_column}` {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_blocks(batches, text_column):
            size, tokens = count_texts(texts, path)
            fields = pa.schema([part.schema.field(id_column), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])
            yield batch_of(part, [id_column], fields, n_bytes=size, n_tokens=tokens, over_limit=[n > limit for n in tokens])

    return docs.select(id_column, text_column).mapInArrow(run, schema)
