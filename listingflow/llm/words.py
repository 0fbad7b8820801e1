"""Words, lines and chunks shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Text bytes that a Python task holds as words at a time. Texts are never cut, so one longer text is a chunk alone.
CHUNK_BYTES = 1 << 20


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, all else as it is."""
    return F.translate(text, UPPER, LOWER)


def spaced_words(text: Column) -> Column:
    """Array of the maximal runs of anything but space, tab, newline, vertical tab, form feed and return."""
    plain = F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\x0c\r", "     ")
    return F.filter(F.split(plain, " "), lambda w: w != "")


def n_spaced_words(text: Column) -> Column:
    return F.size(spaced_words(text)).cast("long")


def chunks(batches: Iterable[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches in order, each with at most ``limit`` bytes in ``column`` or of one row."""
    for batch in batches:
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
        ends = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[bytes | None]:
    """The UTF-8 bytes of each text."""
    return batch.column(column).cast(pa.binary()).to_pylist()


_MULTIPLIERS = np.uint64(0x7FB5D329728EA185), np.uint64(0x81DADEF4BC2DD44D)


def mixed(x: np.ndarray) -> np.ndarray:
    """64 well-spread bits of each number."""
    x = (x ^ (x >> np.uint64(31))) * _MULTIPLIERS[0]
    x = (x ^ (x >> np.uint64(27))) * _MULTIPLIERS[1]
    return x ^ (x >> np.uint64(33))


def _placed(place_and_byte: np.ndarray) -> np.ndarray:
    return mixed(place_and_byte.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))


with np.errstate(over="ignore"):
    # What a byte at one of the first places of a word adds to the word's digest.
    _NEAR = _placed(np.arange(64 << 8))


def digests_of_words(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A digest of 64 bits for each word, by its place and size in ``data``; no word is empty."""
    if not len(start):
        return np.zeros(0, dtype=np.uint64)
    # Numbers of 32 bits are faster and do for all but huge texts and words.
    kind = np.int32 if len(data) < 1 << 31 and size.max() < 1 << 22 else np.int64
    first = np.cumsum(size) - size
    place = np.arange(first[-1] + size[-1], dtype=kind) - np.repeat(first.astype(kind), size)
    at = (place << 8) | data[np.repeat(start.astype(kind), size) + place]
    with np.errstate(over="ignore"):
        one = _NEAR[np.minimum(at, len(_NEAR) - 1)]
        far = np.flatnonzero(at >= len(_NEAR))
        one[far] = _placed(at[far])
        return np.add.reduceat(one, first)


SLICE_BITS = 15  # buckets of a slice of a filter


def _count_type(least: int) -> np.dtype:
    return np.dtype("u1" if least < 256 else "<u8")


def packed_slices(bucket: np.ndarray, count: np.ndarray, least: int) -> pa.RecordBatch:
    """Counts by bucket, in order, as a row for each slice: two bytes for a bucket, and its count as far as it matters."""
    part = bucket >> SLICE_BITS
    first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
    low = (bucket & ((1 << SLICE_BITS) - 1)).astype("<u2")
    count = np.minimum(count, least).astype(_count_type(least))
    ends = [*first[1:].tolist(), len(bucket)]
    return pa.RecordBatch.from_arrays(
        [pa.array(part[first]), pa.array([low[i:j].tobytes() for i, j in zip(first.tolist(), ends)], pa.binary()),
         pa.array([count[i:j].tobytes() for i, j in zip(first.tolist(), ends)], pa.binary())],
        names=["slice", "low", "n"],
    )


def summed_buckets(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, count) in order from several (bucket, count)."""
    bucket, count = (np.concatenate([h[i] for h in held]) for i in (0, 1))
    order = np.argsort(bucket)
    bucket, count = bucket[order], count[order]
    first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    return bucket[first], np.add.reduceat(count, first)


def _full(batches: Iterable[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """The bitmap of each slice: the buckets whose counts, which come slice by slice in order, sum up to ``least``."""
    now, total = None, None

    def row() -> pa.RecordBatch:
        bits = np.packbits(total >= least, bitorder="little").tobytes()
        return pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([bits], pa.binary())], names=["slice", "bits"])

    for batch in batches:
        for part, low, count in zip(*(batch.column(c).to_pylist() for c in ("slice", "low", "n"))):
            if part != now:
                if now is not None:
                    yield row()
                now, total = part, np.zeros(1 << SLICE_BITS, dtype=np.int64)
            total[np.frombuffer(low, dtype="<u2")] += np.frombuffer(count, dtype=_count_type(least))
    if now is not None:
        yield row()


def full_buckets(counted: DataFrame, n_bytes: int, least: int) -> bytearray:
    """A bitmap of ``n_bytes`` of the buckets that the packed slices of ``counted`` fill to ``least``.

    The rows of a slice stream through one task in order, which holds one slice. At most ``n_bytes`` are fetched.
    """
    full = counted.repartition("slice").sortWithinPartitions("slice").mapInArrow(
        partial(_full, least=least), "slice long, bits binary"
    )
    part = 1 << (SLICE_BITS - 3)
    whole = bytearray(n_bytes)
    for row in full.toLocalIterator():
        whole[row["slice"] * part : (row["slice"] + 1) * part] = row["bits"]
    return whole


def in_bitmap(bitmap: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """Whether the bit of each bucket is set in a bitmap of bytes."""
    return (bitmap[bucket >> 3] >> (bucket & 7).astype(np.uint8)) & 1 == 1


def window_codes(ids: np.ndarray, width: int) -> np.ndarray:
    """Numbers for the windows of ``width`` ids, equal exactly where the windows are equal."""
    codes, have = ids.astype(np.int64), 1
    while have < width and len(codes):
        top = int(codes.max()) + 1
        if top >= 1 << 31:
            codes = np.unique(codes, return_inverse=True)[1].astype(np.int64)
            top = int(codes.max()) + 1
        step = min(have, width - have)
        if len(codes) <= step:
            return codes[:0]
        codes = codes[:-step] * top + codes[step:]
        have += step
    return codes
