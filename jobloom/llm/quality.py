"""Compression classifier of text quality.

Two zstandard dictionaries are made from labelled text, one of good and one of bad
rows.  A text is compressed with either; the difference of the two sizes, divided
by their sum, says which kind it is like.  The whole text goes through in
consecutive pieces, each compressed by itself: in one long stream the text itself
soon takes the dictionary's place, and one bad part would vanish.  A logistic curve,
fitted on labelled rows that the dictionaries have not seen, makes a calibrated
score of the difference (in all, and of the pieces that are the most like either
kind) and of the two sizes it is taken from, normalised by the text's.  It sees no
other size than these, and both labels weigh as often as they occur.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobloom.llm.common import batch_of, ship, text_blocks

LEVEL = 3
#: Bytes of a piece of text, of a row's slice in a dictionary, and of a dictionary; chosen on rows of the training fold.
PIECE, SLICE, DICTIONARY = 2048, 1000, 448 << 10
FEATURES = 9


def _tuned(dictionary: zstandard.ZstdCompressionDict | None) -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_content_size=False, write_checksum=False, write_dict_id=False)


@dataclass
class Model:
    """Dictionaries of good and bad text, and the weights of the calibration."""

    good: bytes
    bad: bytes
    weights: list[float]
    middle: list[float]
    scale: list[float]

    def compressors(self) -> tuple[zstandard.ZstdCompressor, ...]:
        raw = [zstandard.ZstdCompressionDict(x, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if x else None for x in (self.good, self.bad)]
        for d in raw:
            if d is not None:
                d.precompute_compress(level=LEVEL)
        return tuple(map(_tuned, raw))

    def score(self, features: np.ndarray) -> np.ndarray:
        z = (features - np.array(self.middle)) / np.array(self.scale)
        return 1 / (1 + np.exp(-np.clip(np.column_stack([np.ones(len(z)), z]) @ np.array(self.weights), -30, 30)))


def features(texts: list[str], compressors: tuple[zstandard.ZstdCompressor, ...]) -> np.ndarray:
    """Normalised size differences over all pieces of a text, and the two normalised sizes, in all and of the pieces at either end.  Pieces of one text are of like size."""
    good, bad = compressors
    out = np.zeros((len(texts), FEATURES))
    for i, text in enumerate(texts):
        data = text.encode()
        size = len(data)
        step = max(1, -(-size // max(1, -(-size // PIECE))))
        pieces = [data[at : at + step] for at in range(0, max(1, size), step)]
        g, b, n = np.array([(len(good.compress(x)), len(bad.compress(x)), len(x) + 16) for x in pieces], float).T
        parts, by_good, by_bad = (b - g) / (b + g), g / n, b / n
        out[i] = (b.sum() - g.sum()) / (b.sum() + g.sum()), parts.min(), parts.max(), g.sum() / (size + 16), b.sum() / (size + 16), by_good.min(), by_good.max(), by_bad.min(), by_bad.max()
    return out


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights (the first is the constant) by Newton's method."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    penalty = np.diag([0.0, *[ridge] * (x.shape[1] - 1)])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty + 1e-9 * np.eye(x.shape[1]), x.T @ (p - y) + penalty @ w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _packed(texts: list[str], size: int, piece: int = SLICE) -> bytes:
    """Slices of many texts, up to ``size`` bytes in all: a raw-content dictionary."""
    out, total = [], 0
    for text in texts:
        data = text.encode()
        at = max(0, (len(data) - piece) // 2)
        out.append(data[at : at + piece])
        total += len(out[-1])
        if total >= size:
            break
    return b"\n".join(out)


def fit(rows: list[tuple[str, int]], dictionary_size: int = DICTIONARY) -> Model:
    """rows: texts with labels 0 or 1, in an order that doesn't depend on the label.  One third makes the dictionaries, the rest the calibration."""
    rows = [(text or "", int(y)) for text, y in rows if y is not None]
    third = len(rows) // 3
    kinds = [[t for t, y in rows[:third] if y == k] for k in (1, 0)]
    model = Model(_packed(kinds[0], dictionary_size), _packed(kinds[1], dictionary_size), [0.0] * (FEATURES + 1), [0.0] * FEATURES, [1.0] * FEATURES)
    rest = rows[third:] or rows
    if len({y for _, y in rest}) < 2:  # one label or none: it is all that can be said
        model.weights[0] = 1.0 if rest and rest[0][1] else -1.0 if rest else 0.0
        return model
    x, y = features([t for t, _ in rest], model.compressors()), np.array([y for _, y in rest])
    model.middle, model.scale = x.mean(0).tolist(), np.maximum(x.std(0), 1e-9).tolist()
    model.weights = logistic((x - x.mean(0)) / np.maximum(x.std(0), 1e-9), y).tolist()
    return model


def held_out(id_column: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, most_rows: int = 6000, most_bytes: int = 32 << 10, id_column: str = "doc_id", text_column: str = "text", label_column: str = "quality") -> Model:
    """Fits on labelled rows outside the held-out fold.

    The sample is bounded: the ``most_rows`` rows whose ids hash lowest among
    those of ``most_bytes`` UTF-8 bytes at most.  Rows without a label, an id or
    a text are left out; a row labelled twice alike counts once.
    """
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).filter("id IS NOT NULL AND text IS NOT NULL")
    chosen = labels.filter(F.col(id_column).isNotNull() & F.col(label_column).isin(0, 1) & ~held_out(id_column)).groupBy(F.col(id_column).alias("id")).agg(F.max(label_column).alias("y"))
    order = F.xxhash64("id")
    ids = chosen.orderBy(order, "id").limit(2 * most_rows)  # some may be too long or absent
    rows = texts.filter(F.octet_length("text") <= most_bytes).join(F.broadcast(ids), "id").orderBy(order, "id").limit(most_rows).select("text", "y").collect()
    return fit([(r.text, r.y) for r in rows])


def score(docs: DataFrame, model: Model, threshold: float = 0.5, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, held_out, score (0 to 1), predicted (1 if score >= threshold).

    A null text is scored as an empty one; a null id is not held out.  The score
    depends on the text alone.  Repeated rows are scored each; other columns are
    ignored.  An empty table gives an empty result.  One pass, no shuffle.
    """
    ship(docs.sparkSession)
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = model.compressors()
        for part, texts in text_blocks(batches, text_column):
            values = model.score(features(texts, tools))
            fields = pa.schema([part.schema.field(id_column), ("score", pa.float64()), ("predicted", pa.int32())])
            yield batch_of(part, [id_column], fields, score=values, predicted=(values >= threshold).astype(np.int32))

    scored = docs.select(id_column, text_column).mapInArrow(run, f"`{id_column}` {kind}, score double, predicted int")
    return scored.select(id_column, held_out(id_column).alias("held_out"), "score", "predicted")


def keep_good(docs: DataFrame, model: Model, threshold: float = 0.5, text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` with a score of ``threshold`` or more, with all their columns.

    A null text is scored as an empty one and stays null.  Rows are judged by their
    text alone: null and repeated ids and repeated rows make no difference.  An empty
    table gives an empty result.  One pass; nothing is joined by id.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = model.compressors()
        for part, texts in text_blocks(batches, text_column):
            yield part.filter(pa.array(model.score(features(texts, tools)) >= threshold))

    return docs.mapInArrow(run, docs.schema)
