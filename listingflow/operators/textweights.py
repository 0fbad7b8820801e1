"""Block-local TF-IDF weights and the cosine of two weighted texts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listingflow.functions.columns import dbl
from listingflow.functions.text import ENGLISH_STOP_WORDS, tokens
from listingflow.session import materialize


def _with_block(df: DataFrame, block: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(block))


def inverse_frequencies(
    df: DataFrame, block: Sequence[str], text: str = "text", stop_words: Sequence[str] = ENGLISH_STOP_WORDS
) -> DataFrame:
    """(block, token, idf), smoothed, with texts and documents counted inside each block.

    Repeats inside a text go before the shuffle, and counts combine map-side, so a token that every text of a large
    block holds is still one small row per task. The result is written: joins see its size, and a plain shuffle.
    """
    rows = _with_block(df, block)
    documents = materialize(rows.groupBy(*block).agg(F.count(F.lit(1)).alias("n_docs")), "block-sizes")
    frequencies = (
        rows.select(*block, F.explode(F.array_distinct(tokens(F.col(text), stop_words))).alias("token"))
        .groupBy(*block, "token")
        .agg(F.count(F.lit(1)).alias("doc_freq"))
    )
    idf = F.ln((dbl(1) + F.col("n_docs")) / (dbl(1) + F.col("doc_freq"))) + dbl(1)
    return materialize(
        frequencies.join(documents, list(block)).select(*block, "token", idf.alias("idf")), "idf"
    )


def raw_vectors(
    df: DataFrame, idf: DataFrame, block: Sequence[str], text: str = "text", key: str = "listing_id",
    stop_words: Sequence[str] = ENGLISH_STOP_WORDS,
) -> DataFrame:
    """(key, raw, norm): per text a map of token to term count times inverse document frequency, and its L2 norm.

    Texts of a block have many raw weights in common, so they pack better than the normalised ones.
    Whole texts travel to the task of their key, so their words are counted there, and beside weights that fit in a
    broadcast they are gathered there too: the words, which take many times the bytes, need no shuffle of their own.
    """
    terms = (
        _with_block(df, block).select(key, *block, text).repartition(key)
        .select(key, *block, F.explode(tokens(F.col(text), stop_words)).alias("token"))
        .groupBy(key, *block, "token")
        .agg(F.count(F.lit(1)).alias("tf"))
    )
    raw = terms.join(idf, [*block, "token"]).select(key, "token", (F.col("tf") * F.col("idf")).alias("weight"))
    # One text's distinct tokens are gathered per key; sorting makes the sum of squares repeatable.
    entries = F.map_from_entries(F.sort_array(F.collect_list(F.struct("token", "weight"))))
    norm = F.sqrt(F.aggregate(F.map_values("raw"), dbl(0), lambda acc, w: acc + w * w))
    return raw.groupBy(key).agg(entries.alias("raw")).withColumn("norm", norm)


def term_vectors(
    df: DataFrame, idf: DataFrame, block: Sequence[str], text: str = "text", key: str = "listing_id",
    stop_words: Sequence[str] = ENGLISH_STOP_WORDS,
) -> DataFrame:
    """(key, vector): per text a map of token to L2-normalised term count times inverse document frequency."""
    return normalised(raw_vectors(df, idf, block, text, key, stop_words), key)


def normalised(raw: DataFrame, key: str = "listing_id") -> DataFrame:
    """(key, vector) from (key, raw, norm)."""
    # The norm is handed in as a value: named in the inner function, Spark works it out again for each token.
    scaled = F.transform(F.array("norm"), lambda norm: F.transform_values("raw", lambda _, w: w / norm))
    return raw.select(key, F.get(scaled, F.lit(0)).alias("vector"))


def block_vectors(
    df: DataFrame, block: Sequence[str], text: str = "text", key: str = "listing_id",
    stop_words: Sequence[str] = ENGLISH_STOP_WORDS,
) -> DataFrame:
    """(key, vector) with document counts and frequencies taken inside each block."""
    return term_vectors(df, inverse_frequencies(df, block, text, stop_words), block, text, key, stop_words)


def as_weights(vectors: DataFrame, key: str = "listing_id") -> DataFrame:
    """(key, token, weight): the vectors as rows."""
    return vectors.select(key, F.explode("vector").alias("token", "weight"))


def block_tfidf(
    df: DataFrame, block: Sequence[str], text: str = "text", key: str = "listing_id",
    stop_words: Sequence[str] = ENGLISH_STOP_WORDS,
) -> DataFrame:
    """(key, token, weight): block-local TF-IDF weights of every text."""
    return as_weights(block_vectors(df, block, text, key, stop_words), key)


def text_similarity(a: str, b: str, norm_a: Column | None = None, norm_b: Column | None = None) -> Column:
    """The dot product of two texts given as vectors, normalised or with their norms; 0 when either has no tokens."""
    def product(_, x: Column, y: Column) -> Column:
        return x * y if norm_a is None else (x / norm_a) * (y / norm_b)

    products = F.map_values(F.map_zip_with(a, b, product))
    return F.coalesce(F.aggregate(products, dbl(0), lambda acc, v: acc + F.coalesce(v, dbl(0))), dbl(0))


def cosine_pairs(pairs: DataFrame, vectors: DataFrame, key: str = "listing_id") -> DataFrame:
    """Add ``text_similarity``: the dot product of two normalised texts, 0 when either has no tokens.

    Pairs that bring their vectors along (vector_a, vector_b) are joined with nothing.
    """
    if {"vector_a", "vector_b"} <= set(pairs.columns):
        # Behind a generator no filter on the score is drawn into the join that made the pairs.
        similarity = F.explode(F.array(text_similarity("vector_a", "vector_b"))).alias("text_similarity")
        return pairs.select(*(c for c in pairs.columns if c not in ("vector_a", "vector_b")), similarity)
    a = vectors.select(F.col(key).alias("id_a"), F.col("vector").alias("_va"))
    b = vectors.select(F.col(key).alias("id_b"), F.col("vector").alias("_vb"))
    return (
        pairs.join(a, "id_a", "left")
        .join(b, "id_b", "left")
        .withColumn("text_similarity", text_similarity("_va", "_vb"))
        .drop("_va", "_vb")
    )
