"""Registered queries next to their SQL, the others next to plain versions, and the pipeline stage by stage."""

import re
from collections import Counter

import pytest

import by_hand
import corpus_pipeline
from compare import compare, connect
from listingflow.llm import bindings, oracles

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in bindings.documents(spark, SF_DIR).collect()}


@pytest.mark.parametrize("name", oracles.oracle_sql())
def test_query_equals_its_sql(spark, name):
    assert compare(bindings.queries()[name](spark, SF_DIR), connect(SF_DIR), oracles.oracle_sql()[name]) == ""


def test_fingerprints_and_groups(spark, texts):
    prints = [by_hand.simhash(t) for t in texts.values()]
    groups = by_hand.near_groups(prints, list(texts))
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in bindings.op3_simhash_golay(spark, SF_DIR).collect()}
    assert got == {i: (f"{p:016x}", g) for i, p, g in zip(texts, prints, groups)}


def test_every_long_repeat_is_a_passage(spark, texts):
    first, want = {}, set()
    for i in sorted(texts):
        words = texts[i].encode().lower().split()
        runs = {tuple(words[j : j + 51]) for j in range(len(words) - 50)}
        want |= {x for run in runs if run in first for x in (i, first[run])}
        for run in runs:
            first.setdefault(run, i)
    rows = bindings.op1_fuzzy_passages(spark, SF_DIR).collect()
    assert want and want <= {r.doc_id for r in rows} | {r.other_id for r in rows}
    for r in rows:
        assert r.n_words >= 50 and r.identity >= 0.8 and r.doc_id > r.other_id


def test_source_mix(spark):
    rows = bindings.op2_source_mix(spark, SF_DIR).collect()
    source = {r.doc_id: r.source for r in bindings.documents(spark, SF_DIR).collect()}
    sizes, taken, target = Counter(), Counter(), {}
    for r in rows:
        sizes[source[r.doc_id]] += r.size
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
    want = by_hand.mix_targets(sizes)
    for s, t in want.items():
        assert target[s] == pytest.approx(t) and abs(taken[s] - t) <= 0.02 * t + 32


def test_private_data_is_gone(spark, texts):
    pattern = r"[\w.%+-]+@[\w.-]+\w|\+\d \(\d{3}\) \d{3}-\d{4}|\b\d{16}\b|\b[0-9a-f]{40}\b|\b\d{1,3}(?:\.\d{1,3}){3}\b"
    rows = bindings.op4_pii_surrogates(spark, SF_DIR).collect()
    assert sum(r.n_replaced for r in rows) > 0
    for r in rows:
        found = re.findall(pattern, texts[r.doc_id])
        assert r.n_replaced == len(found) and not any(f in r.text for f in found)
        assert r.n_replaced or r.text == texts[r.doc_id]


def test_pipeline_stages(spark, texts):
    docs = bindings.documents(spark, SF_DIR)
    columns = docs.columns
    stages = [f for _, f in corpus_pipeline.STAGES]
    good = stages[0](spark, docs, SF_DIR)
    measured = {i: by_hand.rule_measures(t) for i, t in texts.items()}
    kept = {r.doc_id for r in good.collect()}
    assert not any(m["n_words"] < 20 or 100 * m["n_repeat_words"] > 30 * m["n_words"] for i, m in measured.items() if i in kept)
    assert len(kept) > 0.6 * len(texts) and good.columns == columns

    once = stages[1](spark, good, SF_DIR)
    ids = sorted(kept)
    groups = by_hand.near_groups([by_hand.simhash(texts[i]) for i in ids], ids)
    kept = {r.doc_id for r in once.collect()}
    assert kept == set(groups) and once.columns == columns

    clean = stages[2](spark, once, SF_DIR)
    items = [(r.item_id, r.text) for r in bindings.benchmark(spark, SF_DIR).collect()]
    ids = sorted(kept)
    judged = by_hand.contamination([texts[i] for i in ids], items)
    kept = {r.doc_id for r in clean.collect()}
    assert kept == {i for i, j in zip(ids, judged) if not j[-1]} and clean.columns == columns

    private = stages[3](spark, clean, SF_DIR)
    assert private.columns == columns and all(r.n_chars == len(r.text) for r in private.collect())
    assert {r.doc_id for r in private.collect()} == kept

    mixed = stages[4](spark, private, SF_DIR).collect()
    assert {r.doc_id for r in mixed} == kept
    whole = corpus_pipeline.run(spark, SF_DIR).collect()
    assert sorted(map(str, whole)) == sorted(map(str, mixed))
