"""Benchmark decontamination as a prefix-filtered set join.

A window of an item is 13 consecutive words, or all words of a shorter item. It is seen as its set of word shingles
(runs of up to five words) with their places in the window. Shingles are ordered by how often all documents have
them. A document holds the whole window only if it holds each of its shingles, so joining on the rarest one, the
necessary prefix at containment 1, loses no window. A match of the prefix shingle at a place in a document fixes
where the window would begin; windows that would reach beyond the document's ends are dropped by that bound, and the
others are verified word by word over the window's own length.

Documents are read twice by Python tasks that turn words into numbers of the benchmark's vocabulary: once to count
shingles, once to find prefix shingles and the words around them. What follows are Spark joins on the few places
found. What a task holds are the vocabulary and shingles of one block of about ``block_words`` words of items, since
neighbouring windows share all their shingles but one; a larger benchmark is taken in several blocks, each of
which reads the documents twice. Items are dealt to blocks by a hash in stretches of ``STRETCH`` windows, so that a long item is
spread and a block keeps near its mean.

Defined cases: null or empty documents have no words, no hits and are not contaminated. Items without id or without
words have no windows; an item_id that occurs with several texts counts once if any of its windows occurs. Repeated
documents are judged row by row, rows of equal text get equal results.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listingflow.llm.words import chunks, texts_of
from listingflow.session import materialize

WINDOW = 13
SHINGLE = 5
BLOCK_WORDS = 1_000_000
STRETCH = 4_096
CONTAMINATED_IN = 20  # contaminated where at least 1 word in 20 is hit
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# All other ASCII bytes are between words.
_WORD_BYTES = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(0x80, 0x100))
_TO_WORDS = bytes(
    b if b in _WORD_BYTES else b + 32 if 65 <= b <= 90 else 32 for b in range(256)
)


def split_words(text: bytes | None) -> list[bytes]:
    return text.translate(_TO_WORDS).split() if text else []


class _Block:
    """Vocabulary and shingles of a block of items, as a task holds them."""

    def __init__(self, shingles: list[list[bytes]]):
        self.vocabulary: dict[bytes, int] = {}
        self.by_length: dict[int, dict[bytes, int]] = {}
        for number, words in enumerate(shingles):
            ids = np.array([self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words], dtype=np.int32)
            self.by_length.setdefault(len(words), {})[ids.tobytes()] = number

    def find(self, texts: list[bytes | None]):
        """(document, place, shingle) of each shingle found, and the words of the documents."""
        words = [split_words(t) for t in texts]
        known = self.vocabulary
        ids = np.array([known.get(w, -1) for ws in words for w in ws], dtype=np.int32)
        sizes = np.array([len(ws) for ws in words], dtype=np.int64)
        doc = np.repeat(np.arange(len(words)), sizes)
        first = np.cumsum(sizes) - sizes
        found = []
        for length, shingles in self.by_length.items():
            starts = np.arange(max(0, len(ids) - length + 1))
            whole = np.ones(len(starts), dtype=bool)
            for j in range(length):
                whole &= ids[j : j + len(starts)] >= 0
            whole &= doc[: len(starts)] == doc[length - 1 : length - 1 + len(starts)]
            for at in starts[whole].tolist():
                number = shingles.get(ids[at : at + length].tobytes())
                if number is not None:
                    found.append((doc[at], at - first[doc[at]], number))
        return found, words


def _counted(batches: Iterator[pa.RecordBatch], block) -> Iterator[pa.RecordBatch]:
    held, total = _Block([s.split() for s in block.value]), {}
    for batch in chunks(batches, "text"):
        for _, _, number in held.find(texts_of(batch))[0]:
            total[number] = total.get(number, 0) + 1
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())], names=["shingle", "n"]
    )


def _located(batches: Iterator[pa.RecordBatch], block, reach: int) -> Iterator[pa.RecordBatch]:
    """Per document its size and the prefix shingles in it, each with up to ``reach`` words on both sides."""
    shingles = [s.split() for s in block.value["shingles"]]
    numbers, lengths = block.value["numbers"], [len(s) for s in shingles]
    held = _Block(shingles)
    around = pa.list_(pa.struct([("at", pa.int64()), ("shingle", pa.int64()), ("begin", pa.int64()),
                                 ("near", pa.string())]))
    for batch in chunks(batches, "text"):
        found, words = held.find(texts_of(batch))
        places: list[list[dict]] = [[] for _ in words]
        for doc, at, number in found:
            begin = max(0, int(at) - reach)
            near = words[doc][begin : int(at) + lengths[number] + reach]
            places[doc].append({"at": int(at), "shingle": int(numbers[number]), "begin": begin,
                                "near": b" ".join(near).decode()})
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("digest"), pa.array([len(w) for w in words], pa.int64()),
             pa.array(places, around)], names=["doc_id", "digest", "n_words", "places"]
        )


def item_words(text: Column) -> Column:
    return F.regexp_extract_all(
        F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"),
        F.lit(f"({WORD})"), F.lit(1),
    )


def item_windows(benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(item_id, words, block): the windows of each item; equal windows are in one block."""
    listed = materialize(
        benchmark.select(F.col("item_id"), item_words(F.col("text")).alias("words")).where(
            "item_id is not null and size(words) > 0"
        ),
        "items",
    )
    total = listed.agg(F.sum(F.size("words")).alias("n")).first()["n"] or 0
    blocks = max(1, -(-total // block_words))
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - WINDOW, F.lit(0)))
    dealt = F.pmod(F.xxhash64("item_id", F.floor(F.col("at") / STRETCH)), F.lit(blocks)).cast("int")
    windows = listed.select("item_id", "words", F.explode(starts).alias("at")).select(
        "item_id", F.concat_ws(" ", F.slice("words", F.col("at") + 1, WINDOW)).alias("words"), dealt.alias("block")
    )
    windows = windows.groupBy("item_id", "words").agg(F.min("block").alias("block"))
    if blocks == 1:
        return windows
    windows = materialize(windows, "item-windows")
    first = windows.groupBy("words").agg(F.min("block").alias("block"))
    return windows.drop("block").join(first, "words")


def _shingles(windows: DataFrame) -> DataFrame:
    """(words, offset, length, shingle) of each distinct window."""
    parts = F.split("words", " ")
    length = F.least(F.lit(SHINGLE), F.size(parts))
    return windows.select("words").distinct().select(
        "words", F.size(parts).alias("length"),
        F.posexplode(F.transform(
            F.sequence(F.lit(0), F.size(parts) - length),
            lambda i: F.concat_ws(" ", F.slice(parts, i + 1, length)),
        )).alias("offset", "shingle"),
    )


def _hits_of_block(docs: DataFrame, windows: DataFrame, keep_sizes: bool):
    """(rows with sizes, (digest, begin, length, words) of each window found) for one block of windows."""
    spark = docs.sparkSession
    spelled = materialize(_shingles(windows), "window-shingles")
    # About block_words of them: one shingle starts at most at each word of the block's items.
    listed = [r["shingle"] for r in spelled.select("shingle").distinct().orderBy("shingle").collect()]
    shared = spark.sparkContext.broadcast([s.encode() for s in listed])
    counts = docs.select("text").mapInArrow(partial(_counted, block=shared), "shingle long, n long")
    frequency = materialize(counts.groupBy("shingle").agg(F.sum("n").alias("n")), "shingle-counts")
    numbered = spark.createDataFrame(list(enumerate(listed)), "number long, shingle string")
    rarity = numbered.join(frequency.withColumnRenamed("shingle", "number"), "number", "left").select(
        "shingle", "number", F.coalesce("n", F.lit(0)).alias("n")
    )
    rarest = Window.partitionBy("words").orderBy("n", "shingle", "offset")
    prefix = materialize(
        spelled.join(rarity, "shingle").withColumn("rank", F.row_number().over(rarest))
        # A window with a shingle that no document has occurs in none.
        .where("rank = 1 and n > 0").select("words", "length", "offset", F.col("number").alias("shingle")),
        "prefix-shingles",
    )
    wanted = sorted(r["shingle"] for r in prefix.select("shingle").distinct().collect())
    block = spark.sparkContext.broadcast({"shingles": [listed[i].encode() for i in wanted], "numbers": wanted})
    located = docs.select("doc_id", "text", F.md5(F.coalesce("text", F.lit(""))).alias("digest")).mapInArrow(
        partial(_located, block=block, reach=WINDOW),
        f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, digest string, n_words long, "
        "places array<struct<at: bigint, shingle: bigint, begin: bigint, near: string>>",
    )
    located = materialize(located, "prefix-places")
    # Rows of equal text have equal places, so one row per text goes on.
    texts = located.where("size(places) > 0").groupBy("digest").agg(
        F.first("n_words").alias("n_words"), F.first("places").alias("places")
    )
    found = (
        texts.select("digest", "n_words", F.explode("places").alias("p"))
        .select("digest", "n_words", "p.*")
        .join(prefix, "shingle")
        .withColumn("start", F.col("at") - F.col("offset"))
        .where("start >= 0 and start + length <= n_words")  # positional and length bounds
        .where(F.concat_ws(" ", F.slice(
            F.split("near", " "), (F.col("start") - F.col("begin") + 1).cast("int"), F.col("length")
        )) == F.col("words"))
        .select("digest", "start", "length", "words")
    )
    return (located.drop("places") if keep_sizes else None), materialize(found, "windows-found")


def contamination(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, digest, n_words, n_hit, n_items, items_sha256, contaminated) of each row of ``docs``."""
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    windows = materialize(item_windows(benchmark.select("item_id", "text"), block_words), "item-windows-by-block")
    blocks = sorted(r["block"] for r in windows.select("block").distinct().collect()) or [0]
    sizes, found = None, None
    for block in blocks:
        kept, here = _hits_of_block(docs, windows.where(F.col("block") == block), keep_sizes=sizes is None)
        sizes = kept if sizes is None else sizes
        found = here if found is None else found.unionByName(here)
    hit = (
        found.select("digest", F.explode(F.sequence("start", F.col("start") + F.col("length") - 1)).alias("at"))
        .distinct().groupBy("digest").agg(F.count(F.lit(1)).alias("n_hit"))
    )
    items = (
        found.select("digest", "words").distinct()
        .join(windows.select("words", "item_id").distinct(), "words")
        .select("digest", F.col("item_id").cast("string").alias("item_id")).distinct()
        .groupBy("digest").agg(F.array_sort(F.collect_list("item_id")).alias("items"))
    )
    by_text = materialize(hit.join(items, "digest"), "hits-by-text")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    listed = F.coalesce("items", F.array().cast("array<string>"))
    return sizes.join(by_text, "digest", "left").select(
        "doc_id", "digest", "n_words", n_hit.alias("n_hit"), F.size(listed).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", listed), 256).alias("items_sha256"),
        ((n_hit > 0) & (CONTAMINATED_IN * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents that are not contaminated, with the columns of the input."""
    bad = contamination(docs, benchmark, block_words).where("contaminated").select(F.col("digest").alias("_digest"))
    bad = materialize(bad.distinct(), "contaminated-texts")
    text = F.md5(F.coalesce(docs["text"].cast("string"), F.lit("")))
    return docs.join(bad, text == bad["_digest"], "left_anti")
