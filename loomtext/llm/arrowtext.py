"""Vectorised text helpers for Arrow batches: pieces of bounded size, words, character classes."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from functools import wraps
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that one vectorised step takes at most, unless a single text is longer.
STEP_BYTES = 6 << 20


#: What a Python worker keeps from task to task: of one operator at a time, as workers outlive stages.
_KEPT: dict[tuple, Any] = {}


def kept(name: str, key: Any = None, make: Callable[[], Any] = dict) -> Any:
    """The worker's memory of operator ``name`` for ``key``, made anew when another operator or key had it last."""
    if (name, key) not in _KEPT:
        _KEPT.clear()
        release()
        _KEPT[name, key] = make()
    return _KEPT[name, key]


def release() -> None:
    """Give memory that is free inside this process back to the machine."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` over a partition, then ``release``: an idle worker holds no more than what it has kept."""

    @wraps(run)
    def wrapped(batches: Iterator) -> Iterator:
        yield from run(batches)
        release()

    return wrapped


def text_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    """Column ``name`` as large_string with null as empty text; large_string keeps 64-bit offsets."""
    c = batch.column(batch.schema.get_field_index(name)).cast(pa.large_string())
    return pc.fill_null(c, "")


def steps(texts: pa.Array, limit: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges ``[a, b)`` that hold about ``limit`` bytes each; every row is in one range."""
    n = len(texts)
    if not n:
        return
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    a = 0
    while a < n:
        base = ends[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield a, b
        a = b


def words(texts: pa.Array, unicode: bool = False) -> tuple[pa.Array, np.ndarray]:
    """ASCII-whitespace words of all texts in one array, and the offsets of each text's words; with ``unicode``, split at all white space.

    A text's leading or trailing white space makes no empty word.
    """
    parts = (pc.utf8_split_whitespace if unicode else pc.ascii_split_whitespace)(texts)
    flat, off = parts.flatten(), np.asarray(parts.offsets)
    off = off.astype(np.int64) - int(off[0])
    full = pc.not_equal(flat, "")
    keep = np.asarray(full.to_numpy(zero_copy_only=False), dtype=bool)
    if not keep.all():
        before = np.concatenate([[0], np.cumsum(keep)])
        flat, off = flat.filter(full), before[off]
    return flat, off


def coded(flat: pa.Array) -> tuple[list[str], np.ndarray]:
    """Distinct words and, for each word, its place among them."""
    if not len(flat):
        return [], np.zeros(0, np.int64)
    d = flat.dictionary_encode()
    return d.dictionary.to_pylist(), d.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def group_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of ``values`` over ``[offsets[i], offsets[i+1])``; an empty group sums to zero."""
    out = np.zeros(len(offsets) - 1, values.dtype)
    full = offsets[1:] > offsets[:-1]
    if full.any():
        out[full] = np.add.reduceat(values, offsets[:-1][full])
    return out
