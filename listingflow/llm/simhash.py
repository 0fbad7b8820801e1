"""Near duplicates by 64-bit SimHash, found through Golay-code keys.

Fingerprints that differ in at most ``MAX_BITS`` = 3 bits are linked. Cut into four segments of 16 bits, two such
fingerprints agree in one segment, and their differences lie in the other 48 bits. 23 of these form a word for the
Golay code, 25 remain. Either at most two differences are in the word, so that the words share a codeword key; or
all three are, and then the 25 remaining bits agree. So every fingerprint gets, per segment,

* keys (segment, its bits, number of a codeword near the word), up to six, and
* one key (segment, its bits, the remaining bits),

and fingerprints that share a key are compared bit by bit. Only distinct fingerprints are keyed, so copies cost
nothing here. A key's fingerprints are searched breadth-first, which yields a spanning forest of the links inside
the bucket and never its pairs. A bucket of more than ``bucket_limit`` fingerprints is not compared but cut by
four finer keys, of which two linked fingerprints share at least one again; that repeats until the buckets are
small. Linking is thus exact at any bucket size.

Defined cases: a text without words, empty or null, has fingerprint zero and links like any other. Rows of equal
text are one group. Rows without doc_id take part in linking but never name a group; a group of such rows alone
has a null ``component_id``. Of several rows with the same text and least doc_id all carry the same component.
Further columns of the input are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listingflow.llm import golay
from listingflow.llm.words import chunks, texts_of
from listingflow.operators.components import connected_components
from listingflow.session import materialize

SHINGLE = 3
SEED = 42
MAX_BITS = 3
BUCKET_LIMIT = 8_192
_SEGMENTS, _SEGMENT_BITS, _WORD_BITS = 4, 16, golay.LENGTH
_ROWS_AT_ONCE = 8_192
_KEY_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_BLOCK = 256  # fingerprints compared with the rest of a bucket at a time


def shingle_hashes(text: bytes, width: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """XXH64 of each run of ``width`` words, lower-cased in A-Z; of all words together if they are fewer."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[: -1] + 1).tolist()]
    width = min(width, len(words))
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], seed) for a, b in zip(starts, ends[width - 1 :].tolist())], dtype=np.uint64)


def fingerprint(text: bytes | None, width: int = SHINGLE, seed: int = SEED) -> int:
    """Bit b is 1 where over half the hashes have bit b."""
    hashes = shingle_hashes(text or b"", width, seed)
    if not len(hashes):
        return 0
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 4_096):
        part = hashes[at : at + 4_096].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def _fingerprinted(batches: Iterator[pa.RecordBatch], width: int, seed: int) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches, "text"):
        prints = np.array([fingerprint(t, width, seed) for t in texts_of(batch)], dtype=np.uint64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("digest"), pa.array(prints.view(np.int64))],
            names=["doc_id", "digest", "print"],
        )


def _digest() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def fingerprints(docs: DataFrame, width: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(doc_id, digest, print) of each row; ``print`` holds the 64 bits as a long, ``digest`` tells texts apart."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", _digest().alias("digest")).mapInArrow(
        partial(_fingerprinted, width=width, seed=seed), f"doc_id {kind}, digest long, print long"
    )


def _mixed(*parts: np.ndarray | int) -> np.ndarray:
    """One 64-bit key of several numbers. A collision only adds a comparison."""
    out = np.zeros(1, dtype=np.uint64)
    for p in parts:
        out = (out ^ np.asarray(p).astype(np.uint64)) * _KEY_MULTIPLIER
        out = out ^ (out >> np.uint64(29))
    return out


def search_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) such that fingerprints with at most three different bits share a key."""
    prints = prints.astype(np.uint64)
    rows, found = [], []
    for i in range(_SEGMENTS):
        turned = prints if i == 0 else (prints >> np.uint64(16 * i)) | (prints << np.uint64(64 - 16 * i))
        own = turned & np.uint64((1 << _SEGMENT_BITS) - 1)
        word = (turned >> np.uint64(_SEGMENT_BITS)) & np.uint64((1 << _WORD_BITS) - 1)
        rest = turned >> np.uint64(_SEGMENT_BITS + _WORD_BITS)
        row, near = golay.keys(word.astype(np.int64))
        rows += [row, np.arange(len(prints))]
        found += [_mixed(2 * i, own[row], near), _mixed(2 * i + 1, own, rest)]
    return np.concatenate(rows), np.concatenate(found)


def _key_rows(rows: np.ndarray, found: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(found.view(np.int64)), pa.array(prints[rows].astype(np.uint64).view(np.int64))], names=["key", "print"]
    )


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS_AT_ONCE):
            prints = batch.column("print").slice(at, _ROWS_AT_ONCE).to_numpy(zero_copy_only=False).view(np.uint64)
            yield _key_rows(*search_keys(prints), prints)


def finer_keys(key: np.ndarray, prints: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Four keys inside a bucket: 3 different bits spread over 4 sets of bits leave one set equal.

    The sets are dealt anew on each level, and the keys gather with the level, down to fingerprints that agree
    in nearly all bits.
    """
    order = np.random.default_rng(level).permutation(64)
    rows, found = [], []
    for part in range(4):
        mask = np.uint64(sum(1 << int(b) for b in order[part::4]))
        rows.append(np.arange(len(prints)))
        found.append(_mixed(key, 4 * level + part, prints & mask))
    return np.concatenate(rows), np.concatenate(found)


def forest(prints: np.ndarray, max_bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect the same fingerprints of the bucket as all links would, one less than those connected.

    Breadth-first: each found fingerprint looks for those not found yet, a block at a time.
    """
    prints = np.unique(prints.astype(np.uint64))
    left, right = [], []
    unseen = prints
    while len(unseen):
        queue, unseen = unseen[:1], unseen[1:]
        while len(queue) and len(unseen):
            block, queue = queue[:_BLOCK], queue[_BLOCK:]
            near = np.bitwise_count(block[:, None] ^ unseen[None, :]) <= max_bits
            reached = near.any(axis=0)
            if reached.any():
                left.append(block[near[:, reached].argmax(axis=0)])
                right.append(unseen[reached])
                queue = np.concatenate([queue, unseen[reached]])
                unseen = unseen[~reached]
    if not left:
        return prints[:0], prints[:0]
    return np.concatenate(left), np.concatenate(right)


def _small_buckets(key: np.ndarray, prints: np.ndarray, sizes: np.ndarray, starts: np.ndarray):
    """Links in many buckets at once: two by two for the smallest, one bucket at a time for the others."""
    pairs = starts[sizes == 2]
    near = np.bitwise_count(prints[pairs] ^ prints[pairs + 1]) <= MAX_BITS
    out = [(prints[pairs][near], prints[pairs + 1][near])]
    for start, size in zip(starts[sizes > 2], sizes[sizes > 2]):
        out.append(forest(prints[start : start + size]))
    return np.concatenate([a for a, _ in out]), np.concatenate([b for _, b in out])


def _linked(batches: Iterator[pa.RecordBatch], limit: int, level: int) -> Iterator[pa.RecordBatch]:
    """Links inside the buckets of a partition sorted by key, and finer keys of buckets over the limit.

    Holds one bucket of at most ``limit`` fingerprints and one batch; larger buckets pass through.
    """
    held_key, held = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    passing: int | None = None  # the key of a bucket over the limit, until its last row

    def rows(a, b, again):
        return pa.RecordBatch.from_arrays(
            [pa.array(np.asarray(a).view(np.int64)), pa.array(np.asarray(b).view(np.int64)),
             pa.array(np.full(len(a), again))], names=["a", "b", "again"]
        )

    def again(key, prints):
        for at in range(0, len(key), _ROWS_AT_ONCE):
            k, p = key[at : at + _ROWS_AT_ONCE], prints[at : at + _ROWS_AT_ONCE]
            row, found = finer_keys(k, p, level)
            yield rows(found, p[row], True)

    def settle(key, prints):
        if not len(key):
            return
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        sizes = np.diff(np.r_[starts, len(key)])
        large = sizes > limit
        if (sizes[~large] > 1).any():
            a, b = _small_buckets(key, prints, sizes[~large], starts[~large])
            if len(a):
                yield rows(a, b, False)
        for start, size in zip(starts[large], sizes[large]):
            yield from again(key[start : start + size], prints[start : start + size])

    for batch in batches:
        key = batch.column("key").to_numpy(zero_copy_only=False)
        prints = batch.column("print").to_numpy(zero_copy_only=False).view(np.uint64)
        if passing is not None:
            n = int(np.searchsorted(key, passing, side="right"))
            yield from again(key[:n], prints[:n])
            key, prints = key[n:], prints[n:]
            if not len(key):
                continue
            passing = None
        key, prints = np.concatenate([held_key, key]), np.concatenate([held, prints])
        if not len(key):
            continue
        cut = int(np.searchsorted(key, key[-1], side="left"))  # the last bucket may go on in the next batch
        yield from settle(key[:cut], prints[:cut])
        held_key, held = key[cut:], prints[cut:]
        if len(held) > limit:
            passing = int(held_key[0])
            yield from again(held_key, held)
            held_key, held = held_key[:0], held[:0]
    yield from settle(held_key, held)


def links(prints: DataFrame, bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """(a, b): fingerprints with at most three different bits, enough of them to connect all that are connected."""
    keyed = prints.mapInArrow(_keyed, "key long, print long")
    found, level = None, 0
    while True:
        searched = materialize(
            keyed.repartition("key").sortWithinPartitions("key")
            .mapInArrow(partial(_linked, limit=bucket_limit, level=level), "a long, b long, again boolean"),
            "simhash-links",
        )
        here = searched.where("not again").select("a", "b").distinct()
        found = here if found is None else found.unionByName(here)
        more = searched.where("again").select(F.col("a").alias("key"), F.col("b").alias("print"))
        if more.isEmpty():
            return found.distinct()
        keyed, level = more, level + 1


def near_duplicates(docs: DataFrame, bucket_limit: int = BUCKET_LIMIT, width: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(doc_id, digest, print, component, component_id) of each row.

    ``component_id`` is the least doc_id that links reach from the row, itself included; ``component`` is the
    group's least fingerprint.
    """
    marked = materialize(fingerprints(docs, width, seed), "fingerprints")
    least = materialize(marked.groupBy("print").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    components = materialize(
        connected_components(links(least.select("print"), bucket_limit), "a", "b"), "fingerprint-components"
    )
    named = materialize(
        least.join(components, least["print"] == components["id"], "left").select(
            "print", F.coalesce("component", "print").alias("component"), "least"
        ),
        "named-fingerprints",
    )
    roots = named.groupBy("component").agg(F.min("least").alias("component_id"))
    by_print = materialize(
        named.join(roots, "component").select("print", "component", "component_id"), "component-names"
    )
    return marked.join(by_print, "print").select("doc_id", "digest", "print", "component", "component_id")


def as_hex(bits: str) -> Column:
    return F.lower(F.lpad(F.hex(bits), 16, "0"))


def keep_first(docs: DataFrame, bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """One row per group of near duplicates: one with the least doc_id, or any if no row of the group has an id."""
    columns = docs.columns
    first = (
        near_duplicates(docs, bucket_limit)
        .where(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("component").agg(F.min(F.struct("doc_id", "digest")).alias("first"))
        .select(F.col("first.doc_id").alias("_first_id"), F.col("first.digest").alias("_first_digest"))
    )
    first = materialize(first, "first-of-group")
    digest = _digest()
    kept = docs.join(
        first, docs["doc_id"].eqNullSafe(first["_first_id"]) & (digest == first["_first_digest"]), "left_semi"
    )
    # The same row may be there several times; rank limits are applied before the exchange. The row travels as one
    # column, so that no name of it is taken for another.
    whole = F.struct(*(docs[c] for c in columns))
    rows = kept.select(docs["doc_id"].alias("id"), digest.alias("digest"), whole.alias("row"))
    turn = Window.partitionBy("id", "digest").orderBy(F.to_json("row"))
    return rows.withColumn("turn", F.row_number().over(turn)).where("turn = 1").select("row.*")
