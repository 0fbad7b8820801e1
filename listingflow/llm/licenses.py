"""Licences found by the digest of the canonical text.

A text is brought to a canonical form in which equal licences are equal: lower case, without lines that only state a
copyright, punctuation and white space as single blanks, words of equivalent spelling as one. Its SHA-256 is joined
with the digests of known texts. The same is done with every line of the text that could be a known one-line notice,
that is, has the length of one.

Only DataFrame functions are used. The texts are read once; what is written and joined are digests. Lines travel
only if their length occurs among the notices, which a line equal to a notice cannot fail.

Defined cases: null and empty texts have the digest of the empty text and no licence; so has a text of punctuation
only. Rows are judged one to one, repeated or not, whatever their id. Several known texts of equal digest must carry
the same licence; the least name is taken. Other columns are not looked at.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listingflow.llm.license_texts import SPELLINGS, TEXTS, notices
from listingflow.session import materialize

# What stands before the statement is on its own line and never given back, so many blank lines cost one look each.
COPYRIGHT_LINE = r"(?m)^[ \t\x0B\f\r/*#;!-]*+(?:copyright|©|\(c\))[^\n]*$"
_BETWEEN = r"[^\p{L}\p{N}\n]+"


def canonical_lines(text: Column) -> Column:
    """The canonical text with its line ends."""
    lower = F.lower(F.coalesce(text.cast("string"), F.lit("")))
    # Tests that most texts fail come first, so that they are not rewritten for nothing.
    stated = lower.contains("copyright") | lower.contains("©") | lower.contains("(c)")
    lower = F.when(stated, F.regexp_replace(lower, COPYRIGHT_LINE, "")).otherwise(lower)
    plain = F.regexp_replace(lower, _BETWEEN, " ")
    respelled = plain
    for variant, usual in SPELLINGS:
        respelled = F.regexp_replace(respelled, rf"\b{variant}\b", usual)
    any_variant = r"\b(?:" + "|".join(re.escape(v) for v, _ in SPELLINGS) + r")\b"
    return F.when(plain.rlike(any_variant.replace(r"\ ", " ")), respelled).otherwise(plain)


def canonical(lines: Column) -> Column:
    return F.trim(F.regexp_replace(lines, r"[\s]+", " "))


def known(spark: SparkSession, more: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(digest, licence, length) of the known texts, those of ``more`` (licence, text) among them, and of the notices."""
    out = []
    for rows, others in ((list(TEXTS.items()), more), (notices(), None)):
        text = canonical(canonical_lines(F.col("text")))
        df = spark.createDataFrame(rows, "licence string, text string")
        if others is not None:
            df = df.unionByName(others.select("licence", "text").where("licence is not null and text is not null"))
        df = df.select("licence", text.alias("text"))
        out.append(df.groupBy(F.sha2("text", 256).alias("digest"), F.length("text").alias("length")).agg(
            F.min("licence").alias("licence")))
    return out[0], out[1]


def scan(docs: DataFrame, more: DataFrame | None = None) -> DataFrame:
    """(doc_id, digest, licence, n_notices, notices) of each row.

    ``licence`` is that of the whole text, ``notices`` those of its lines, sorted and joined by commas. ``more``
    (licence, text) are texts to know besides those shipped, a table of any size.
    """
    spark = docs.sparkSession
    texts, lines = (materialize(k, "known-licences") for k in known(spark, more))
    lengths = sorted(r["length"] for r in lines.select("length").distinct().collect())  # of the fixed notices
    split = F.filter(
        F.transform(F.split("lines", "\n"), lambda line: F.trim(line)), lambda line: F.length(line).isin(lengths)
    )
    digests = materialize(
        docs.select("doc_id", canonical_lines(F.col("text")).alias("lines"))
        .select(
            F.monotonically_increasing_id().alias("row"), "doc_id",
            F.sha2(canonical(F.col("lines")), 256).alias("digest"),
            F.transform(split, lambda line: F.sha2(line, 256)).alias("candidates"),
        ),
        "licence-digests",
    )
    found = (
        digests.where("size(candidates) > 0").select("row", F.explode("candidates").alias("digest"))
        .join(lines.select("digest", "licence"), "digest")
        .groupBy("row").agg(
            F.count(F.lit(1)).alias("n_notices"), F.array_join(F.array_sort(F.collect_set("licence")), ",").alias("notices")
        )
    )
    return (
        digests.select("row", "doc_id", "digest")
        .join(texts.select("digest", "licence"), "digest", "left")
        .join(found, "row", "left")
        .select("doc_id", "digest", "licence", F.coalesce("n_notices", F.lit(0)).cast("long").alias("n_notices"),
                F.coalesce("notices", F.lit("")).alias("notices"))
    )
