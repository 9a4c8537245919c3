"""Helpers shared by the operators: row batches through Arrow, and words of many texts at once."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICE_BYTES = 2_000_000  # text handled at once inside a task


def tidy(run: Callable) -> Callable:
    """``run`` for mapInArrow, which gives freed memory back to the system when a task ends.

    Python workers are used again by later stages, so what the C allocator keeps of one stage's
    large arrays, and the powers that the next call of the same stage would use, would be added to the
    next one's.
    """
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            _POWERS.clear()
            gc.collect()
            give_back()
    return wrapped


def give_back() -> None:
    """Freed memory goes back to the system."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other systems have no such call
        ctypes.CDLL(None).malloc_trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hashed_part(h: Column, wanted: int, of: int) -> Column:
    """True for about ``wanted`` of ``of`` rows, by a hash. Before a sorted limit it keeps what tasks
    send for the limit from growing with their number."""
    return h.bitwiseAND(F.lit(2**63 - 1)) <= F.lit(
        2**63 - 1 if wanted >= of else 2**63 // of * wanted)


def fresh(df: DataFrame, *names: str) -> DataFrame:
    """Drop the columns of ``df`` that an operator is about to write."""
    taken = {n.lower() for n in names}
    return df.drop(*[c for c in df.columns if c.lower() in taken])


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Bounds of runs of rows of about ``limit`` bytes; one long value is a run of its own."""
    if pa.types.is_list(column.type):
        sizes = pc.multiply(pc.list_value_length(column), 16)
    elif pa.types.is_string(column.type) or pa.types.is_binary(column.type):
        sizes = pc.binary_length(column)
    else:
        sizes = pa.array(np.full(len(column), 8))
    start = size = 0
    for i, n in enumerate(pc.fill_null(sizes, 0).to_pylist()):
        if i > start and size + n > limit:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(column):
        yield start, len(column)


def add_columns(df: DataFrame, column: str, fields: list[T.StructField],
                make: Callable[[], Callable[[list], list[pa.Array]]],
                limit: int = SLICE_BYTES) -> DataFrame:
    """Append columns computed from one column, batch by batch of about ``limit`` bytes.

    ``make`` runs once per task and returns the function from a list of values (None for NULL) to
    one Arrow array per field. Columns that already have one of the new names are replaced.
    """
    kept = fresh(df, *[f.name for f in fields])
    if column not in kept.columns:  # the source column itself is replaced
        kept = df
        order = [c for c in df.columns if c.lower() not in {f.name.lower() for f in fields}]
    else:
        order = kept.columns
    base = T.StructType([f for f in kept.schema if f.name in order])
    out = T.StructType(base.fields + fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        names = order + [f.name for f in fields]
        for batch in batches:
            column = batch.column(kept_index)
            for lo, hi in slices(column, limit):
                old = [batch.column(i).slice(lo, hi - lo) for i in old_index]
                yield pa.RecordBatch.from_arrays(
                    old + fn(column.slice(lo, hi - lo).to_pylist()), names=names)

    kept_index = kept.columns.index(column)
    old_index = [kept.columns.index(c) for c in order]
    return kept.mapInArrow(tidy(run), out)


def byte_class(inside: Callable[[int], bool]) -> np.ndarray:
    """Table of 256 flags: which bytes belong to a word."""
    return np.array([inside(b) for b in range(256)], dtype=bool)


NOT_SPACE = byte_class(lambda b: b not in (0x20, *range(0x09, 0x0E)))
WORD_BYTES = byte_class(lambda b: b > 0x7F or chr(b).isalnum())
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 2**64))


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_POWERS: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """The first ``n`` powers modulo 2 ** 64; kept for the next call up to twice a slice."""
    known = _POWERS.get(int(base))
    if known is None or len(known) < n:
        known = np.full(max(n, 1), base, dtype=np.uint64)
        known[0] = 1
        known = np.multiply.accumulate(known)
        if n <= 2 * SLICE_BYTES:
            _POWERS[int(base)] = known
    return known[:n]


class Words:
    """Words of many texts as flat arrays: 64-bit hashes, byte bounds, and each text's word range."""

    def __init__(self, texts: list, inside: np.ndarray, lower: bool = True):
        raw = [(t or "").encode("utf-8", "surrogatepass") if not isinstance(t, bytes) else t
               for t in texts]
        joined = b" ".join(raw) + b" "
        sizes = np.fromiter((len(r) + 1 for r in raw), np.int64, len(raw))
        self.text_end = np.cumsum(sizes)
        self.bytes = np.frombuffer(joined, np.uint8) if raw else np.zeros(0, np.uint8)
        flags = np.zeros(len(self.bytes) + 1, np.int8)
        flags[1:] = inside[self.bytes]
        edge = np.flatnonzero(flags[1:] != flags[:-1])
        self.start, self.end = edge[::2], edge[1::2]
        body = LOWER[self.bytes] if lower else self.bytes
        total = np.zeros(len(body) + 1, np.uint64)
        np.cumsum((body.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(body)),
                  out=total[1:])
        undo = powers(BASE_INVERSE, len(body))
        self.hash = mix((total[self.end] - total[self.start]) * undo[self.start]
                        + (self.end - self.start).astype(np.uint64))
        self.bound = np.concatenate([[0], np.searchsorted(self.start, self.text_end)])

    def counts(self) -> np.ndarray:
        return np.diff(self.bound)
