"""Tokens per document, counted in flat token files by their separators.

A token file is nothing but token ids of a fixed width, each document followed by the end-of-document id; no index
says where documents begin. The files are cut into blocks of equal bytes wherever that falls. Each block is searched
as one vector for the separator and reports its separators and its length. A prefix scan over the blocks of a
file then tells every block how many documents ended before it and where the document that runs into it began, which
stitches documents over any number of blocks. Only these few numbers per block are ordered, never tokens.

``write_token_files`` makes such files from documents: one file per task, with a table that says which document is the
n-th of which file (and nothing of where it lies). A task that is run again writes a new file; only the files named in
the table are read, so what a lost task left behind is never seen. Files are written and read with Arrow's
file systems (local or mounted paths, HDFS, S3, GCS), and the folder is one that all executors share.

Defined cases: null and empty documents have 0 tokens. Tokens after the last separator are a last document. The
strings of special tokens in a text are ordinary text. Rows with null ids or repeated rows are documents like others.
An empty file has no documents. Other columns are not looked at.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator
from functools import cache, partial

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from listingflow.llm.words import chunks
from listingflow.session import materialize, work_path

BLOCK_BYTES = 4 << 20
TYPES = {2: np.dtype("<u2"), 4: np.dtype("<u4")}


@cache
def _encoder(ranks_path: str, pattern: str):
    """The tokenizer of a rank file; one per worker process."""
    import tiktoken

    with open(ranks_path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def _written(batches: Iterator[pa.RecordBatch], folder: str, ranks_path: str, pattern: str, eod: int, width: int):
    store, root = fs.FileSystem.from_uri(folder)
    encoder, kind, place = _encoder(ranks_path, pattern), TYPES[width], 0
    end = np.array([eod], dtype=kind).tobytes()
    out, path = None, f"{uuid.uuid4().hex}.bin"
    try:
        for batch in chunks(batches, "text"):
            if out is None:
                out = store.open_output_stream(f"{root}/{path}")
            for text in batch.column("text").to_pylist():
                if text:
                    out.write(np.array(encoder.encode_ordinary(text), dtype=kind).tobytes())
                out.write(end)
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array([path] * n), pa.array(np.arange(place, place + n)), batch.column("doc_id")],
                names=["file", "place", "doc_id"],
            )
            place += n
    finally:
        if out is not None:
            out.close()


def write_token_files(
    docs: DataFrame, folder: str, ranks_path: str, pattern: str, eod: int, width: int = 2
) -> DataFrame:
    """Token files of ``docs`` in ``folder``; returns (file, place, doc_id), written next to them."""
    if eod >= 1 << 8 * width:
        raise ValueError(f"the separator {eod} does not fit {width} bytes")
    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    kind = docs.schema["doc_id"].dataType.simpleString()
    write = partial(_written, folder=folder, ranks_path=ranks_path, pattern=pattern, eod=eod, width=width)
    return materialize(
        docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
            write, f"file string, place long, doc_id {kind}"
        ),
        "token-documents",
    )


def _sized(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    store, root = fs.FileSystem.from_uri(folder)
    for batch in batches:
        names = batch.column("file").to_pylist()
        sizes = [i.size for i in store.get_file_info([f"{root}/{n}" for n in names])]
        yield pa.RecordBatch.from_arrays([batch.column("file"), pa.array(sizes, pa.int64())], names=["file", "bytes"])


def _searched(batches: Iterator[pa.RecordBatch], folder: str, eod: int, width: int) -> Iterator[pa.RecordBatch]:
    store, root = fs.FileSystem.from_uri(folder)
    for batch in batches:
        for file, block, start, n in zip(*(batch.column(c).to_pylist() for c in ("file", "block", "start", "bytes"))):
            with store.open_input_file(f"{root}/{file}") as source:
                tokens = np.frombuffer(source.read_at(n, start), dtype=TYPES[width])
            ends = np.flatnonzero(tokens == eod) + start // width
            yield pa.RecordBatch.from_arrays(
                [pa.array([file]), pa.array([block], pa.int64()), pa.array([start // width + len(tokens)], pa.int64()),
                 pa.array([ends.tolist()], pa.list_(pa.int64()))],
                names=["file", "block", "stop", "ends"],
            )


def separators(files: DataFrame, folder: str, eod: int, width: int = 2, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(file, place, start, n_tokens) of each document in the files named by ``files`` (file)."""
    block_bytes -= block_bytes % width
    sized = files.select("file").distinct().mapInArrow(partial(_sized, folder=folder), "file string, bytes long")
    blocks = (
        sized.where("bytes > 0")
        .select("file", F.col("bytes").alias("_size"),
                F.posexplode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(block_bytes).cast("long")))
                .alias("block", "start"))
        .select("file", F.col("block").cast("long").alias("block"), "start",
                F.least(F.lit(block_bytes).cast("long"), F.col("_size") - F.col("start")).alias("bytes"))
    )
    # Blocks of one file go to many tasks.
    found = materialize(
        blocks.repartition("file", "block").mapInArrow(
            partial(_searched, folder=folder, eod=eod, width=width),
            "file string, block long, stop long, ends array<long>",
        ),
        "token-separators",
    )
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file")
    last_end = F.when(F.size("ends") > 0, F.element_at("ends", -1))
    scanned = found.select("file", "block", "stop", F.size("ends").alias("n"), last_end.alias("last_end")).select(
        "file", "block",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("places_before"),
        F.coalesce(F.last("last_end", ignorenulls=True).over(before) + 1, F.lit(0)).alias("begun"),
        (F.sum("n").over(whole)).alias("places"), F.max("last_end").over(whole).alias("file_end"),
        F.max("stop").over(whole).alias("file_stop"), (F.col("block") == F.max("block").over(whole)).alias("is_last"),
    )
    scanned = materialize(scanned, "token-blocks")
    starts = F.concat(F.array("begun"), F.transform(F.slice("ends", F.lit(1), F.size("ends") - 1), lambda e: e + 1))
    closed = (
        found.where("size(ends) > 0").join(scanned, ["file", "block"])
        .select("file", "places_before",
                F.posexplode(F.arrays_zip(starts.alias("start"), F.col("ends").alias("end"))).alias("i", "d"))
        .select("file", (F.col("places_before") + F.col("i")).alias("place"), F.col("d.start").alias("start"),
                (F.col("d.end") - F.col("d.start")).alias("n_tokens"))
    )
    start = F.coalesce(F.col("file_end") + 1, F.lit(0))
    open_ = scanned.where(F.col("is_last") & (start < F.col("file_stop"))).select(
        "file", F.col("places").alias("place"), start.alias("start"), (F.col("file_stop") - start).alias("n_tokens")
    )
    return closed.unionByName(open_)


def count_tokens(
    spark: SparkSession, docs: DataFrame, ranks_path: str, pattern: str, eod: int, width: int = 2,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(doc_id, file, place, start, n_tokens) of each row of ``docs``, through token files of its texts."""
    folder = work_path(spark, "token-files")
    named = write_token_files(docs, folder, ranks_path, pattern, eod, width)
    found = separators(named, folder, eod, width, block_bytes)
    return named.join(found, ["file", "place"]).select("doc_id", "file", "place", "start", "n_tokens")
