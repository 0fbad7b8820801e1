"""The registered queries of this subpackage: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listingflow.llm import (
    byte_pairs, collocations, conversations, decontaminate, licenses, mixing, passages, pu_quality, quality_rules, simhash,
    surrogates, token_counts, url_lists,
)

# The key of the surrogates in the registered queries. A real run passes its own secret.
QUERY_KEY = "listing corpus"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def op1_fuzzy_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every passage of 50 words or more that a document shares with an earlier one."""
    return passages.passages(documents(spark, sf_dir))


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the words that the mix takes of it."""
    return mixing.mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op3_simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its fingerprint and its group of near duplicates."""
    return simhash.near_duplicates(documents(spark, sf_dir)).select(
        "doc_id", simhash.as_hex("print").alias("fingerprint"), "component_id"
    )


def op4_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with personal data replaced."""
    return surrogates.replace(documents(spark, sf_dir), QUERY_KEY).select("doc_id", "text", "n_replaced")


def op5_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens, counted in token files of all documents."""
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return token_counts.count_tokens(
        spark, documents(spark, sf_dir), ranks, public_tokenizers.PATTERN, eod=50_256
    ).select("doc_id", "n_tokens")


def url_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages with a day on which each was fetched, within two years."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    day = F.pmod(F.col("page_id") * 7919, F.lit(730)).cast("int")
    return pages.select("page_id", "url", F.date_add(F.lit("2023-01-01").cast("date"), day).alias("fetched"))


def url_events(captures: DataFrame) -> DataFrame:
    """A log of list entries made from the pages' own hosts: a digest says what is listed, and when."""
    host = url_lists.host_of(F.col("url"))
    hosts = captures.select(host.alias("host")).where("host <> ''").distinct()
    number = F.conv(F.substring(F.md5("host"), 1, 6), 16, 10).cast("int")
    kind = F.element_at(F.array(F.lit("host"), F.lit("domain"), F.lit("prefix")), number % 3 + 1)
    entry = (
        F.when(kind == "host", F.col("host"))
        .when(kind == "domain", F.regexp_replace("host", r"^(?:www|m|blog)\.", ""))
        .otherwise(F.concat("host", F.lit("/en/")))
    )
    start = F.date_add(F.lit("2022-06-01").cast("date"), number % 500)
    log = F.explode(F.array(
        F.struct(F.lit("add").alias("action"), start.alias("at")),
        F.struct(F.lit("remove").alias("action"), F.date_add(start, 60 + number % 200).alias("at")),
        F.struct(F.lit("add").alias("action"), F.date_add(start, 300 + number % 200).alias("at")),
    ))
    return hosts.where(number % 4 != 0).select(kind.alias("kind"), entry.alias("entry"), log.alias("e")).select(
        "kind", "entry", "e.action", "e.at"
    )


def op6_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page with the list entry that covered its address on the day it was fetched."""
    captures = url_captures(spark, sf_dir)
    return url_lists.listed(captures, url_events(captures)).select(
        "page_id", "host", "fetched", "listed", "kind", "entry", "since"
    )


def op7_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's measurements, failed rules and verdicts."""
    entries = quality_rules.ledger(documents(spark, sf_dir))
    return entries.select(
        "doc_id", *quality_rules.MEASURES, "fail_bits", (~quality_rules.passes("base")).alias("base_failed"),
        quality_rules.passes(quality_rules.CURRENT).alias("kept"),
    )


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the benchmark windows that occur in it."""
    return decontaminate.contamination(documents(spark, sf_dir), benchmark(spark, sf_dir)).drop("digest")


def op9_license_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's canonical digest and the licences it and its lines are."""
    return licenses.scan(documents(spark, sf_dir))


def op10_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality score."""
    return pu_quality.score(documents(spark, sf_dir), labels(spark, sf_dir))


def op11_bpe_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's token ids and what they decode to, as digests."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    encoded = byte_pairs.encode(documents(spark, sf_dir).select("doc_id", "text"), path).drop("text")
    return byte_pairs.decode(encoded, path).select(
        "doc_id", byte_pairs.n_ids().alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The phrases of each language whose words stand together most."""
    return collocations.collocations(documents(spark, sf_dir))


def damaged_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversations with the contract's damage; a row that it drops stays with ``gone`` true, for its id."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    filled = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    damage = F.crc32(F.concat(filled["conv_id"], F.lit(":"), filled["turn"])) % 20
    return rows.select(
        "conv_id", "turn", (damage == 0).alias("gone"),
        F.when(damage == 4, "user").otherwise(filled["role"]).alias("role"),
        F.when(damage == 1, "").when(damage == 2, F.translate(filled["text"], ".!?", "")).otherwise(filled["text"]).alias("text"),
        F.explode(F.when(damage == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))),
    ).drop("col")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every damaged conversation's faults, its cheapest edits and the digest of what they leave."""
    return conversations.repairs(damaged_conversations(spark, sf_dir), F.col("gone"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = (
        op1_fuzzy_passages, op2_source_mix, op3_simhash_golay, op4_pii_surrogates, op5_separator_scan, op6_url_lists,
        op7_rule_ledger, op8_decontaminate, op9_license_digests, op10_pu_quality,
        op11_bpe_boundaries, op12_collocations, op13_conversation_repair,
    )
    return {f.__name__: f for f in named}
