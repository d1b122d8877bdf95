"""Byte-level BPE: encoding by the tokenizers library over Arrow batches, offsets, decoding.

Each worker splits texts into words (``pretoken``) and hands the words it has not
met to the library, as pretokenised input, so that no text is cut and no word is
encoded twice.  Ids are kept as little-endian unsigned 32-bit bytes; a text's ids
are its words' ids joined.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from jobloom.llm.common import batch_of, give_back, ship, text_blocks
from jobloom.llm.pretoken import Words, packs

#: Words that either of a worker's two generations remembers: a full one becomes the old one, and what is met again moves on from there.
MOST_WORDS = 50_000
#: Bytes of a row's text read at once, and characters that a worker encodes at once, be they one text or many: the splitter's tables take many bytes for each.
BLOCK_BYTES = 256 << 10


def byte_table() -> dict[str, int]:
    """Byte of each character that byte-level vocabularies write it by: printable ones stand for themselves, the others follow from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class ByteBpe:
    """Encoder and decoder of one vocabulary (.json of the tokenizers library)."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # special strings in a text are ordinary text
        special = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        table = byte_table()
        vocabulary = self.tokenizer.get_vocab()
        self.bytes_of = [b""] * (max(vocabulary.values()) + 1)
        for word, i in vocabulary.items():
            self.bytes_of[i] = word.encode() if word in special else bytes(table[c] for c in word)
        self.sizes = np.array([len(x) for x in self.bytes_of], np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.table = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def learn(self, words: list[bytes]) -> None:
        """Ids of words not known yet: those of the older generation move on, the library encodes the others."""
        older, new = self.older, []
        for w in words:
            if (ids := older.get(w)) is None:
                new.append(w)
            else:
                self.known[w] = ids
        for i in range(0, len(new), 4096):
            part = new[i : i + 4096]
            got = self.tokenizer.encode([w.decode() for w in part], is_pretokenized=True, add_special_tokens=False)
            ids = np.array(got.ids, "<u4").tobytes()
            cuts = np.searchsorted(np.array([-1 if x is None else x for x in got.word_ids]), np.arange(len(part) + 1)) * 4
            cuts = cuts.tolist()
            self.known.update(zip(part, (ids[a:b] for a, b in zip(cuts, cuts[1:]))))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        out: list[list[bytes]] = [[] for _ in texts]
        for part, owners in packs(texts, BLOCK_BYTES):
            for owner, ids in zip(owners, self._encode(part)):
                out[owner].append(ids)
        return [b"".join(x) for x in out]

    def _encode(self, texts: list[str]) -> list[bytes]:
        words = Words(texts)
        data = words.data
        found = [data[a:b] for a, b in zip(words.starts.tolist(), words.stops.tolist())]
        if len(self.known) > MOST_WORDS:
            self.known, self.older = {}, self.known
        self.learn(sorted({*found} - self.known.keys()))
        cuts = np.searchsorted(words.owner, np.arange(len(texts) + 1)).tolist()
        get = self.known.__getitem__
        return [b"".join(map(get, found[a:b])) for a, b in zip(cuts, cuts[1:])]

    def offsets(self, text: str, ids: bytes) -> np.ndarray:
        """Rows (start, end) in characters; a token with a part of a character covers all of it."""
        data = np.frombuffer(text.encode(), np.uint8)
        character = np.cumsum((data & 0xC0) != 0x80) - 1  # of each byte
        ends = np.cumsum(self.sizes[np.frombuffer(ids, "<u4")])
        starts = ends - self.sizes[np.frombuffer(ids, "<u4")]
        return np.stack([character[starts], character[ends - 1] + 1], 1) if len(ends) else np.zeros((0, 2), np.int64)

    def decode(self, ids: bytes) -> bytes:
        """The bytes of all ids, looked up some at a time."""
        numbers, out = np.frombuffer(ids, "<u4"), []
        for i in range(0, len(numbers), BLOCK_BYTES >> 2):
            some = numbers[i : i + (BLOCK_BYTES >> 2)]
            sizes = self.sizes[some]
            ends = np.cumsum(sizes)
            out.append(self.table[np.repeat(self.begins[some] - (ends - sizes), sizes) + np.arange(int(ends[-1]))].tobytes())
        return b"".join(out)

    def decode_stream(self, ids: Iterable[int]) -> Iterator[str]:
        """Text as it becomes complete: bytes of a split character wait for the rest of it; what never does becomes U+FFFD."""
        import codecs

        decoder = codecs.getincrementaldecoder("utf-8")("replace")
        for i in ids:
            if text := decoder.decode(self.bytes_of[i]):
                yield text
        if text := decoder.decode(b"", True):
            yield text


_codecs: dict[str, ByteBpe] = {}


def codec(path: str) -> ByteBpe:
    if path not in _codecs:
        _codecs[path] = ByteBpe(path)
        give_back()  # reading the vocabulary takes much more than keeping it
    return _codecs[path]


def encode_documents(docs: DataFrame, path: str | None = None, offsets: bool = False, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_tokens, ids (binary, little-endian uint32), decoded (binary), and with ``offsets`` token_starts and token_ends (arrays, in characters).

    A null text is empty and has no ids; a null id stays null; repeated rows are
    encoded each; special strings are ordinary text; other columns are ignored.
    An empty table gives an empty result.  One pass, no shuffle.
    """
    ship(docs.sparkSession)
    path = path or public_tokenizers.path("byte_bpe_50k.json")
    kind = docs.schema[id_column].dataType.simpleString()
    more = ", token_starts array<int>, token_ends array<int>" if offsets else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path)
        for part, texts in text_blocks(batches, text_column, BLOCK_BYTES):
            ids = bpe.encode(texts)
            columns = {"n_tokens": [len(x) // 4 for x in ids], "ids": ids, "decoded": [bpe.decode(x) for x in ids]}
            fields = [part.schema.field(id_column), pa.field("n_tokens", pa.int64()), pa.field("ids", pa.binary()), pa.field("decoded", pa.binary())]
            if offsets:
                spans = [bpe.offsets(text, x) for text, x in zip(texts, ids)]
                columns |= {"token_starts": [x[:, 0] for x in spans], "token_ends": [x[:, 1] for x in spans]}
                fields += [pa.field(n, pa.list_(pa.int32())) for n in ("token_starts", "token_ends")]
            yield batch_of(part, [id_column], pa.schema(fields), **columns)

    return docs.select(id_column, text_column).mapInArrow(run, f"`{id_column}` {kind}, n_tokens bigint, ids binary, decoded binary{more}")


def decode_documents(encoded: DataFrame, path: str | None = None, id_column: str = "doc_id") -> DataFrame:
    """id and text (string) of each row's ids; bytes that are not UTF-8 become U+FFFD, null ids become null."""
    ship(encoded.sparkSession)
    path = path or public_tokenizers.path("byte_bpe_50k.json")
    kind = encoded.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path)
        for part in batches:
            texts = [None if x is None else bpe.decode(x).decode("utf-8", "replace") for x in part.column("ids").to_pylist()]
            yield batch_of(part, [id_column], pa.schema([part.schema.field(id_column), ("text", pa.string())]), text=texts)

    return encoded.select(id_column, "ids").mapInArrow(run, f"`{id_column}` {kind}, text string")


def digest(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
