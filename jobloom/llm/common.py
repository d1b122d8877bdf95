"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc

from jobloom.runtime import Stored, scratch, ship, shared_folder, stored, table

__all__ = ["Stored", "batch_of", "fresh", "give_back", "scratch", "ship", "shared_folder", "stored", "table", "text_blocks"]


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it


def give_back() -> None:
    """Returns freed memory to the system: a worker lives on, and what a batch took must not stay with it."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def fresh(*names: str) -> tuple[str, ...]:
    """Column names that no table has, to be used beside the columns of a caller."""
    mark = uuid.uuid4().hex
    return tuple(f"{x}-{mark}" for x in names)


def text_blocks(batches: Iterator[pa.RecordBatch], column: str, limit: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of the batches with about ``limit`` bytes of text each (one row at least), and their texts; null counts as empty."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = total = 0
        for i, n in enumerate(sizes):
            if i > start and total + n > limit:
                part = batch.slice(start, i - start)
                yield part, [x or "" for x in part.column(column).to_pylist()]
                start, total = i, 0
            total += n
        if start < len(sizes):
            part = batch.slice(start)
            yield part, [x or "" for x in part.column(column).to_pylist()]
        batch = part = None
        give_back()


def batch_of(source: pa.RecordBatch, keep: list[str], schema: pa.Schema, **columns: list) -> pa.RecordBatch:
    """The kept columns of a slice with new ones, in the order of ``schema``."""
    return pa.RecordBatch.from_arrays([source.column(f.name).cast(f.type) if f.name in keep else pa.array(columns[f.name], f.type) for f in schema], schema=schema)
