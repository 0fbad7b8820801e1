"""Token ids, phrases and conversations next to the tokenizers library and plain versions."""

import hashlib
import json
import random
import tracemalloc
import zlib
from collections import defaultdict
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import by_hand
from listingflow.llm import bindings, byte_pairs, collocations, conversations, double_array

SF_DIR = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


# --- byte pairs

PIECES = ["a", "'s", "'re", "'ll", "'", "''", "'S", "ll", " ", "  ", "\n", "\t", "\r\n", "1", "é", "日", "!", "<|endoftext|>",
          "\x85", "\x1c", "\x00", "²", "Ⅷ", "́", "x" * 90, "😀", "ﬀ", "don't", "�", "<|end"]


def assert_same_ids(texts, library):
    voc = byte_pairs.vocabulary(PATH)
    for text, ids in zip(texts, byte_pairs.encode_texts(texts, voc)):
        want = library.encode(text or "", add_special_tokens=False).ids
        assert ids.tolist() == want, repr(text[:60])
        assert byte_pairs.decode_ids(ids, voc) == library.decode(want, skip_special_tokens=False)


def test_ids_equal_the_library(library):
    rng = random.Random(11)
    assert_same_ids(["".join(rng.choice(PIECES) for _ in range(rng.randrange(1, 16))) for _ in range(4_000)], library)
    points = [chr(p) for p in range(1, 0x3000)] + [chr(rng.randrange(0xE000, 0x110000)) for _ in range(500)]
    assert_same_ids(["".join(rng.choice(points) for _ in range(30)) for _ in range(400)], library)
    assert_same_ids([None, "", "a" * 5_000, " " * 700, "\n" * 700, "ab" * 2_000, "é" * 900, "日本語" * 500, "'" * 90,
                     "".join(rng.choice("abcdefgh") for _ in range(30_000))], library)



def test_broken_ids_decode_like_the_library(library):
    voc, rng = byte_pairs.vocabulary(PATH), random.Random(5)
    for _ in range(300):
        ids = [rng.randrange(50_257) for _ in range(rng.randrange(12))]
        assert byte_pairs.decode_ids(np.array(ids, dtype="<u4"), voc) == library.decode(ids, skip_special_tokens=False)


def test_encode_keeps_rows_and_replaces_its_column(make_docs):
    docs = make_docs([(1, "Hello there"), (1, "Hello there"), (None, "x"), (2, None), (3, "")]).withColumn("ids", F.lit("mine"))
    coded = byte_pairs.encode(docs, PATH, at_a_time=4)
    assert set(coded.columns) == set(docs.columns)
    rows = byte_pairs.decode(coded.drop("text"), PATH).withColumn("n", byte_pairs.n_ids()).collect()
    assert sorted((r.doc_id or 0, r.text, r.n) for r in rows) == [
        (0, "x", 1), (1, "Hello there", 2), (1, "Hello there", 2), (2, "", 0), (3, "", 0)]
    assert byte_pairs.encode(make_docs([]), PATH).count() == 0


def test_other_vocabularies_are_refused(tmp_path):
    with pytest.raises(ValueError, match="plain byte-level"):
        byte_pairs.Vocabulary(public_tokenizers.path("word_bpe_49k.json"))
    stated = json.load(open(PATH, encoding="utf-8"))
    stated["model"]["merges"] = stated["model"]["merges"][::-1]
    (tmp_path / "turned.json").write_text(json.dumps(stated))
    with pytest.raises(ValueError, match="out of order"):
        byte_pairs.Vocabulary(str(tmp_path / "turned.json"))


def test_every_document_encodes_like_the_library(spark, library):
    texts = {r.doc_id: r.text or "" for r in bindings.documents(spark, SF_DIR).collect()}
    rows = bindings.op11_bpe_boundaries(spark, SF_DIR).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        said = library.decode(ids, skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(),
            hashlib.sha256(said.encode()).hexdigest())


# --- phrases

SAID = "the of a to and in cat dog sat on mat new york city big apple É 日本 x1 don't THE".split()
GAPS = [" ", " ", " ", "  ", "\t", ", ", ".\n", "! ", "\x0b", "\r\n"]


def said(seed, n=300):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        known = SAID[: rng.choice([6, len(SAID)])]
        text = "".join(rng.choice(known) + rng.choice(GAPS) for _ in range(rng.randrange(60)))
        rows.append((i if i % 7 else None, text if i % 40 else None, rng.choice(["en", "de", None, "und", "日"])))
    rows += [(1, "", "en"), (2, " \t\n.,", "fr"), (3, "long" * 20_000 + " " + "word" * 20_000, "en"), (4, "new york " * 300, "es")]
    return rows


@pytest.mark.parametrize("options, limits", [
    ({}, {}),
    ({"filter_bits": 15, "block_bytes": 64, "round_bytes": 30_000}, {}),
    ({"max_words": 4, "share": 30, "min_count": 6, "top": 25}, {"longest": 4, "share": 30, "least": 6, "top": 25}),
])
def test_collocations_equal_plain_counts(spark, options, limits):
    rows = said(len(options))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    docs = docs.withColumn("n", F.lit("mine")).withColumn("words", F.lit(1))
    got = sorted(tuple(r) for r in collocations.collocations(docs, **options).collect())
    assert got == by_hand.phrases([(t, lang) for _, t, lang in rows], **limits) and got


def test_long_repeated_words_are_counted(spark):
    word = "w" * 30_000
    docs = spark.createDataFrame([(1, f"{word} b. " * 12, "en")], "doc_id long, text string, lang string")
    assert [tuple(r) for r in collocations.collocations(docs).collect()] == [
        ("en", 1, f"{word} b", 12, 12, 12, 24, 1_000_000)]


def test_a_task_holds_a_small_part_of_its_text_as_words():
    rng = np.random.default_rng(1)
    texts = [" ".join(f"word{i}" for i in rng.integers(0, 50_000, 1000)) for _ in range(1000)]
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * len(texts)), pa.array(texts)], names=["lang", "text"])
    every = SimpleNamespace(value=b"\xff" * (1 << 24))
    for run in (lambda: collocations._bucketed([batch], [], 27, [1, 2], 10), lambda: collocations._named([batch], [every], 27, 1)):
        tracemalloc.start()
        rows = sum(out.num_rows for out in run())
        held = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert rows and held < 120 << 20


def test_no_phrases_in_empty_tables(make_docs):
    assert collocations.collocations(make_docs([])).collect() == []
    assert collocations.collocations(make_docs([(1, "a b")])).collect() == []


def test_scores_of_large_counts_are_exact(spark):
    a, l, r = 3_037_000_500_123, 3_037_000_500_124, 9_007_199_254_740_993
    row = spark.sql(f"""select cast(1000000 as decimal(7, 0)) * cast({a}L as decimal(16, 0)) * cast({a}L as decimal(16, 0))
        div (cast({l}L as decimal(16, 0)) * cast({r}L as decimal(16, 0))) as score""").first()
    assert row.score == 1_000_000 * a * a // (l * r)


def test_tries_hold_exactly_their_keys():
    rng = random.Random(2)
    keys = sorted({bytes(rng.choices(b"abcdefghijklmnopqrstuvwxyz\xc3\xff\x00", k=rng.randrange(1, 9))) for _ in range(20_000)})
    trie = double_array.build(keys)
    stop = np.isin(np.arange(256), [0x20])
    others = sorted({k[:-1] + b"0" for k in keys} | {k[:3] + b"\x01" for k in keys})
    for asked, want in ((keys, 1), (others, 0)):
        data = np.frombuffer(b" ".join(asked) + b" ", dtype=np.uint8)
        at = np.cumsum([0, *(len(k) + 1 for k in asked[:-1])])
        counts = np.zeros(len(keys), dtype=np.int64)
        trie.walk(data, at, stop, counts)
        assert (counts == want).all()
    assert len(trie.base) < 3 * sum(map(len, keys))


# --- conversations

TURNS = "conv_id long, turn long, role string, text string"


def plain_repairs(rows):
    """By id the result row, from (conv_id, turn, role, text) rows after damage."""
    talks = defaultdict(list)
    for conv, turn, role, text in rows:
        talks[conv].append((turn is not None, turn or 0, role if role is not None else " ", text if text is not None else " "))
    found = {}
    for conv, talk in talks.items():
        talk.sort()
        turns = [t for known, t, _, _ in talk if known]
        said = [(role, text) for _, _, role, text in talk]
        faults = by_hand.first_faults(said)
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(said, said[1:]))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        found[conv] = (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, *by_hand.cheapest_edits(said))
    return found


def test_repairs_equal_all_ways_to_edit(spark):
    rng = random.Random(8)
    rows = []
    for conv in range(250):
        for _ in range(rng.randrange(1, 6)):
            rows.append((conv if conv else None, rng.choice([None, 0, 1, 2, 3, 9]),
                         rng.choice(["user", "assistant", "system", "tool", None, "", "user", "assistant"]),
                         rng.choice(["Hi.", "Yes!", "cut", " \n", None, "So?", "A b.", "No.", "é!", "End. \t"])))
    turns = spark.createDataFrame(rows, TURNS).withColumn("gone", F.lit(1)).withColumn("seen", F.lit("x"))
    found = conversations.repairs(turns, held=2)
    got = {r.conv_id: tuple(r)[1:] for r in found.collect()}
    assert got == plain_repairs(rows)
    kept = defaultdict(list)
    for r in sorted(conversations.repaired_turns(turns, found).collect(), key=lambda r: r.position):
        kept[r.conv_id].append(f"{r.role}:{r.text}")
    for conv, row in got.items():
        assert hashlib.sha256("\n".join(kept[conv]).encode()).hexdigest() == row[-1]


def test_giant_conversation_streams_over_batches(spark):
    n = 40_000
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    try:
        turns = spark.range(n).selectExpr(
            "7L as conv_id", "id as turn", "if(id % 2 = 0, 'user', 'assistant') as role", "concat('Said ', id, '.') as text")
        row = conversations.repairs(turns, held=999).first()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert (row.gaps, row.illegal, row.cost, row.audit) == (0, 0, 0, "K" * n)
    said = "\n".join(f"{'assistant' if i % 2 else 'user'}:Said {i}." for i in range(n))
    assert row.repaired_sha256 == hashlib.sha256(said.encode()).hexdigest()


def test_conversations_without_rows_and_wide_gaps(spark):
    top = (1 << 63) - 1
    turns = spark.createDataFrame([(1, 0, "user", "Hi."), (2, -top, "user", "Hi."), (2, top, "assistant", "Yes.")], TURNS)
    rows = {r.conv_id: tuple(r)[1:] for r in conversations.repairs(turns, F.col("conv_id") == 1).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    assert rows[1] == (0, 0, 0, 0, 0, 0, "", empty) and rows[2][0] == top
    assert conversations.repairs(turns.limit(0)).collect() == []


def test_every_conversation_of_the_query(spark):
    rows, ids = [], set()
    for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").collect():
        role, text = (" " if x is None else x for x in (r.role, r.text))
        ids.add(r.conv_id)
        damage = zlib.crc32(f"{r.conv_id}:{r.turn}".encode()) % 20
        text = {1: "", 2: "".join(c for c in text if c not in ".!?")}.get(damage, text)
        rows += [(r.conv_id, r.turn, "user" if damage == 4 else role, text)] * {0: 0, 3: 2}.get(damage, 1)
    got = {r.conv_id: tuple(r)[1:] for r in bindings.op13_conversation_repair(spark, SF_DIR).collect()}
    assert got.keys() == ids
    short = defaultdict(list)
    for row in rows:
        short[row[0]].append(row)
    want = plain_repairs([row for talk in short.values() if len(talk) < 8 for row in talk])
    assert len(want) > 10 and all(got[conv] == row for conv, row in want.items())
