"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the measurements and one bit per failed rule, so that
a policy, which is a versioned set of rules, is one bitwise AND, and what a rule costs on its own is a count over
the bits. Changing a policy reads the ledger and not the texts.

Null or empty texts have no words and fail ``too_few_words``. Rows are judged one by one: repeated rows, null ids
and columns with other names pass through as they are. A column of the input that has the name of a ledger column
is replaced.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listingflow.llm.words import chunks, texts_of, window_codes

WINDOW = 8
_SYMBOLS = b"#*$%&|<>"
_SPACES = b" \t\n\x0b\x0c\r"
_INSIDE_CHAR = bytes(range(0x80, 0xC0))  # the second and later bytes of a code point

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """A document fails where ``fails`` is true. ``bit`` is its fixed place in the ledger, never used again."""

    name: str
    bit: int
    fails: str


# Multiplied out, so that all comparisons are between whole numbers.
RULES = (
    Rule("too_few_words", 0, "n_words < 20"),
    Rule("repeated_windows", 1, "100 * n_repeat_words > 30 * n_words"),
    Rule("symbols", 2, "10 * n_symbols > n_words"),
    Rule("duplicate_lines", 3, "2 * n_dup_lines > n_lines"),
    Rule("short_words", 4, "word_chars < 2 * n_words"),
    Rule("long_words", 5, "word_chars > 20 * n_words"),
    Rule("bare_symbols", 6, "2 * n_symbols > word_chars"),
)
BASE_RULES = ("too_few_words", "repeated_windows")
# Versioned policies: the rules that reject a document.
POLICIES = {
    "base": BASE_RULES,
    "2024-1": (*BASE_RULES, "symbols", "bare_symbols"),
    "2024-2": (*BASE_RULES, "symbols", "duplicate_lines", "short_words", "long_words", "bare_symbols"),
}
CURRENT = "2024-2"

_MEASURE_TYPES = [(n, pa.int64()) for n in (*MEASURES, "n_lines")]


def policy_mask(rules: Iterable[str], known: Iterable[Rule] = RULES) -> int:
    bits = {r.name: r.bit for r in known}
    return sum(1 << bits[name] for name in set(rules))


def _among(text: bytes, kind: bytes) -> int:
    return len(text) - len(text.translate(None, kind))


def repeated_words(ids: np.ndarray, doc: np.ndarray, n_docs: int, width: int = WINDOW) -> np.ndarray:
    """Per document, the words inside windows of ``width`` ids found at least twice in that document.

    ``ids`` are the words of all documents in a row and ``doc`` the document of each word, ascending.
    """
    codes = window_codes(ids, width)
    inside = doc[: len(codes)] == doc[width - 1 :][: len(codes)]
    at = np.flatnonzero(inside)
    if not len(at):
        return np.zeros(n_docs, dtype=np.int64)
    _, code = np.unique(codes[at], return_inverse=True)
    _, group, count = np.unique(doc[at] * (code.max() + 1) + code, return_inverse=True, return_counts=True)
    edges = np.zeros(len(ids) + 1, dtype=np.int64)
    twice = at[count[group] > 1]
    np.add.at(edges, twice, 1)
    np.add.at(edges, twice + width, -1)
    return np.bincount(doc[np.cumsum(edges[:-1]) > 0], minlength=n_docs)


def measure(texts: list[bytes | None]) -> dict[str, np.ndarray]:
    """The measurements of each text."""
    n = len(texts)
    out = {name: np.zeros(n, dtype=np.int64) for name, _ in _MEASURE_TYPES}
    known: dict[bytes, int] = {}
    ids: list[int] = []
    for i, text in enumerate(texts):
        if not text:
            continue
        words = text.split()
        ids.extend([known.setdefault(w, len(known)) for w in words])
        lines = [line for line in text.split(b"\n") if line.strip()]
        out["n_words"][i] = len(words)
        out["word_chars"][i] = len(text) - _among(text, _INSIDE_CHAR + _SPACES)
        out["n_symbols"][i] = _among(text, _SYMBOLS)
        out["n_lines"][i] = len(lines)
        out["n_dup_lines"][i] = len(lines) - len(set(lines))
    doc = np.repeat(np.arange(n), out["n_words"])
    out["n_repeat_words"] = repeated_words(np.array(ids, dtype=np.int64), doc, n)
    return out


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches, "text"):
        found = measure(texts_of(batch))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, *(pa.array(found[n]) for n, _ in _MEASURE_TYPES)],
            names=[*batch.schema.names, *(n for n, _ in _MEASURE_TYPES)],
        )


def ledger(docs: DataFrame, rules: Iterable[Rule] = RULES) -> DataFrame:
    """``docs`` with the measurements and ``fail_bits``, bit r set where rule r fails."""
    docs = docs.drop(*(n for n, _ in _MEASURE_TYPES), "fail_bits")
    schema = T.StructType([*docs.schema.fields, *(T.StructField(n, T.LongType()) for n, _ in _MEASURE_TYPES)])
    bits = F.lit(0).cast("long")
    for rule in rules:
        bits = bits.bitwiseOR(F.when(F.expr(rule.fails), F.lit(1 << rule.bit).cast("long")).otherwise(F.lit(0).cast("long")))
    return docs.mapInArrow(_measured, schema).withColumn("fail_bits", bits)


def passes(policy: str, policies: Mapping[str, Iterable[str]] = POLICIES) -> Column:
    """Whether the ledger row passes the policy."""
    return F.col("fail_bits").bitwiseAND(F.lit(policy_mask(policies[policy])).cast("long")) == 0


def ablations(entries: DataFrame, policy: str = CURRENT, rules: Iterable[Rule] = RULES) -> DataFrame:
    """Per rule of the policy: documents that fail it, and those that it alone rejects.

    The ledger shrinks to counts per bitmask before anything is listed per rule, so the second step sees as many
    rows as there are bitmasks, whatever the corpus.
    """
    rules = [r for r in rules if r.name in POLICIES[policy]]
    mask = F.lit(policy_mask(POLICIES[policy])).cast("long")
    counted = entries.groupBy(F.col("fail_bits").bitwiseAND(mask).alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    listed = F.explode(F.array(*(
        F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("bit")) for r in rules
    )))
    n = F.col("n")
    return (
        counted.select("bits", "n", listed.alias("r")).groupBy(F.col("r.rule").alias("rule"))
        .agg(
            F.sum(F.when(F.col("bits").bitwiseAND(F.col("r.bit")) != 0, n).otherwise(0)).alias("n_failed"),
            F.sum(F.when(F.col("bits") == F.col("r.bit"), n).otherwise(0)).alias("n_only"),
        )
    )


def keep_good(docs: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The documents that pass the policy, with the columns of the input."""
    # Other columns travel under numbers, so that none is taken for a measurement.
    numbered = docs.select("text", *(docs[c].alias(f"_{i}") for i, c in enumerate(docs.columns)))
    return ledger(numbered).where(passes(policy)).select(*(F.col(f"_{i}").alias(c) for i, c in enumerate(docs.columns)))
