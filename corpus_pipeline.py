"""From raw documents to a training mix, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. All but the last return the
columns of ``documents``; the last adds how many words of each document the mix takes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listingflow.llm import bindings, decontaminate, mixing, quality_rules, simhash, surrogates
from listingflow.session import materialize


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the current policy of quality rules."""
    return quality_rules.keep_good(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash.keep_first(docs)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return decontaminate.drop_contaminated(docs, bindings.benchmark(spark, sf_dir))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with surrogates for personal data; ``n_chars`` follows the text."""
    replaced = surrogates.replace(docs, bindings.QUERY_KEY)
    length = F.coalesce(F.length("text"), F.col("n_chars")).cast("long")
    return replaced.withColumn("n_chars", length).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes of each document."""
    return mixing.mix(docs)


STAGES = [
    ("quality rules", apply_quality_rules),
    ("near duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_passages),
    ("personal data", replace_personal_data),
    ("source mix", mix_sources),
]

# XXH64 fingerprints, their groups and keyed surrogates cannot be stated in DuckDB SQL; tests/llm checks each stage
# against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each result written before the next stage reads it."""
    docs = bindings.documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
