"""Operators on small tables next to plain versions, with the awkward cases each docstring defines."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import by_hand
from listingflow.llm import (
    bindings, decontaminate, golay, licenses, mixing, passages, pu_quality, quality_rules, simhash, surrogates,
    token_counts, url_lists,
)

WORDS = "alpha bravo charlie delta echo foxtrot golf hotel india juliet kilo lima mike november oscar papa".split()


def prose(seed, n, words=None):
    rng = random.Random(seed)
    return " ".join((words or WORDS)[rng.randrange(len(words or WORDS))] + str(rng.randrange(400)) for _ in range(n))


AWKWARD = [None, "", " \t\n ", "one", "É Ünïcode ﬀ 日本語   x", "a b\x0bc\x0cd\re", "same " * 5_000, "x" * 200_000, "#*$ | <>"]


# --- quality rules

def test_measures_equal_the_plain_ones(make_docs):
    texts = [*AWKWARD, prose(1, 60) + "\n" + prose(1, 60), prose(2, 500), "l1 x\nl1 x\n\n\nl1 x\n y", prose(3, 30) * 2]
    rows = quality_rules.ledger(make_docs(list(enumerate(texts)))).collect()
    for r in rows:
        want = by_hand.rule_measures(texts[r.doc_id])
        assert {k: r[k] for k in want} == want
    assert {r.doc_id for r in rows if r.fail_bits & 1} == {
        i for i, t in enumerate(texts) if by_hand.rule_measures(t)["n_words"] < 20}


def test_rules_keep_rows_columns_and_ignore_names(make_docs):
    docs = make_docs([(1, prose(1, 50)), (1, prose(1, 50)), (None, prose(2, 50)), (3, None)])
    docs = docs.withColumn("n_words", F.lit("mine")).withColumn("fail_bits", F.lit(-1))
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.n_words, r.fail_bits) for r in kept.collect()) == [
        (0, "mine", -1), (1, "mine", -1), (1, "mine", -1)]
    assert quality_rules.ledger(make_docs([])).count() == 0


def test_ablations_count_what_each_rule_alone_rejects(make_docs):
    texts = ["few", "word#### " * 30, prose(1, 40), prose(2, 60) + " #$%" * 10]
    entries = quality_rules.ledger(make_docs(list(enumerate(texts))))
    bits = [r.fail_bits for r in entries.collect()]
    got = {r.rule: (r.n_failed, r.n_only) for r in quality_rules.ablations(entries).collect()}
    for rule in quality_rules.RULES:
        mask = 1 << rule.bit
        want = (sum(bool(b & mask) for b in bits), sum(b == mask for b in bits))
        assert got.get(rule.name, (0, 0)) == want


# --- SimHash

def test_words_two_bits_apart_share_a_golay_key():
    rng = np.random.default_rng(5)
    for word in rng.integers(0, 1 << 23, 40).tolist():
        own = set(golay.keys(np.array([word]))[1].tolist())
        for i in range(23):
            for j in range(i, 23):
                other = word ^ (1 << i) ^ (1 << j if j > i else 0)
                assert own & set(golay.keys(np.array([other]))[1].tolist())


def test_prints_three_bits_apart_share_a_key():
    rng = np.random.default_rng(6)
    a = rng.integers(0, 1 << 63, 2_000, dtype=np.uint64)
    b = a.copy()
    for i in range(len(b)):
        for bit in rng.choice(64, rng.integers(1, 4), replace=False):
            b[i] ^= np.uint64(1 << int(bit))
    keys = []
    for prints in (a, b):
        of = [set() for _ in prints]
        for row, key in zip(*simhash.search_keys(prints)):
            of[row].add(int(key))
        keys.append(of)
    assert all(x & y for x, y in zip(*keys))
    for level in range(4):  # finer keys keep them together
        first, second = (simhash.finer_keys(np.zeros(len(p), np.int64), p, level) for p in (a, b))
        n = len(a)
        same = (first[1] == second[1]).reshape(4, n)
        assert same.any(axis=0).all()


@pytest.mark.parametrize("limit", [8_192, 40])
def test_groups_equal_those_of_all_pairs(spark, limit):
    rng = np.random.default_rng(7)
    centre = rng.integers(0, 1 << 62, 12, dtype=np.uint64)
    prints = [int(c) for c in centre]
    for c in centre[:4]:
        for _ in range(40):  # balls and chains around the first ones
            p = int(c)
            for bit in rng.choice(14, rng.integers(1, 5), replace=False):
                p ^= 1 << int(bit) * 4
            prints.append(p)
    prints = sorted(set(prints))
    df = spark.createDataFrame([(p if p < 1 << 63 else p - (1 << 64),) for p in prints], "print long")
    links = simhash.links(df, bucket_limit=limit).collect()
    group = {p: p for p in prints}

    def root(p):
        while group[p] != p:
            p = group[p]
        return p

    for a, b in links:
        a, b = a % (1 << 64), b % (1 << 64)
        assert (a ^ b).bit_count() <= 3
        group[root(a)] = root(b)
    want = by_hand.near_groups(prints, list(range(len(prints))))
    got = {}
    for i, p in enumerate(prints):
        got.setdefault(root(p), i)
    assert [got[root(p)] for p in prints] == want
    if limit == 8_192:
        assert len(links) < 30 * len(prints)


def test_near_duplicates_with_awkward_rows(make_docs):
    long = prose(8, 400)
    texts = [*AWKWARD, long, long.replace("alpha", "ALPHA"), long + " end", prose(9, 200), "one"]
    docs = make_docs(list(enumerate(texts)) + [(None, long), (None, "alone with no id"), (0, None)])
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.component_id, r.print % (1 << 64)) for r in simhash.near_duplicates(docs).collect()), key=str)
    ids = [*range(len(texts)), None, None, 0]
    prints = [by_hand.simhash(t) for t in [*texts, long, "alone with no id", None]]
    want = sorted(((i is None, i or 0, c, p) for i, p, c in zip(ids, prints, by_hand.near_groups(prints, ids))), key=str)
    assert got == want
    assert simhash.near_duplicates(make_docs([])).count() == 0


def test_keep_first_takes_any_names_and_types(make_docs):
    docs = make_docs([(1, prose(1, 40)), (1, prose(1, 40)), (2, prose(2, 40))])
    docs = docs.withColumn("_turn", F.lit("mine")).withColumn("turn", F.lit(7)).withColumn(
        "tags", F.create_map(F.lit("k"), F.monotonically_increasing_id().cast("string")))
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r._turn, r.turn) for r in kept.collect()) == [(1, "mine", 7), (2, "mine", 7)]


def test_keep_first_leaves_one_row_per_group(make_docs):
    a, b = prose(1, 300), prose(2, 300)
    docs = make_docs([(5, a), (3, a), (3, a), (7, b), (None, b), (None, "nobody else"), (9, a + " more"), (7, "other text, same id")])
    docs = docs.withColumn("digest", F.lit("kept")).withColumn("component", F.lit(1))
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id or 0), r.text[:8], r.digest) for r in kept.collect()) == sorted([
        (3, a[:8], "kept"), (7, b[:8], "kept"), (0, "nobody e", "kept"), (7, "other te", "kept")])
    assert simhash.keep_first(make_docs([])).count() == 0


# --- decontamination

@pytest.mark.parametrize("block_words", [500_000, 60])
def test_contamination_equals_the_plain_one(spark, make_docs, block_words):
    items = [(i, prose(100 + i, n)) for i, n in enumerate((40, 13, 12, 5, 3, 1, 25))]
    items += [(7, None), (None, prose(200, 30)), (8, items[0][1]), (10, "?!"), (1, prose(300, 20)), (1, prose(300, 20))]
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumn("n_words", F.lit("extra"))
    texts = [
        *AWKWARD, items[0][1], prose(1, 300) + " " + items[0][1].upper() + " " + prose(2, 100), items[1][1] + "!" + items[1][1],
        " ".join(items[0][1].split()[:12]), " ".join(items[0][1].split()[3:18]), items[2][1] + " x " + items[3][1], items[4][1],
        prose(3, 2_000) + " " + items[6][1], items[5][1] * 2, items[5][1] + " " + items[5][1], prose(300, 20),
    ]
    docs = make_docs([*enumerate(texts), (3, texts[9]), (None, texts[10])])
    rows = decontaminate.contamination(docs, benchmark, block_words).drop("digest").collect()
    judged = by_hand.contamination([*texts, texts[9], texts[10]], items)
    want = sorted(((i, *j) for i, j in zip([*range(len(texts)), 3, None], judged)), key=str)
    assert sorted(map(tuple, rows), key=str) == want
    clean = decontaminate.drop_contaminated(docs, benchmark, block_words)
    assert clean.columns == docs.columns and clean.count() == sum(not j[-1] for j in judged)


def test_contamination_of_empty_tables(spark, make_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(make_docs([]), none).count() == 0
    row = decontaminate.contamination(make_docs([(1, "a b")]), none).first()
    assert (row.n_words, row.n_hit, row.n_items, row.contaminated) == (2, 0, 0, False)


def test_blocks_hold_words_of_items_and_not_of_windows(spark):
    items = spark.createDataFrame(
        [(i, prose(i, 300)) for i in range(40)] + [(99, prose(99, 12_000)), (7, prose(7, 300))], "item_id long, text string")
    windows = decontaminate.item_windows(items, block_words=8_000)
    sizes = {r.block: r.n for r in windows.groupBy("block").agg(F.countDistinct("words").alias("n")).collect()}
    assert len(sizes) in (2, 3, 4) and sum(sizes.values()) == 40 * 288 + 11_988
    assert windows.groupBy("words").agg(F.countDistinct("block").alias("n")).where("n > 1").count() == 0


# --- surrogates

PRIVATE = "mail Jo.Doe9@Mail.example.com or jo.doe9@mail.EXAMPLE.com, +1 (017) 555-7713, 4539 1488 0343 6467 and 4539148803436467, 10.2.3.4 8.8.8.8, 123-45-6789, token = \"04dbebab91ab85687d33eeaaf9ac699e1188f962\", DE89370400440532013000"
NAMES = "Mr. John Smith met Mrs Smith; MR is no title, Mr. SMITH is. Frau Müller and Господин Иван Петров."


def test_surrogates_hide_keep_shape_and_are_consistent(make_docs):
    texts = [*AWKWARD, PRIVATE, "again jo.doe9@mail.example.com", NAMES, "clean text 12 of 2024, v1.2.3 a@b", PRIVATE]
    docs = make_docs([*enumerate(texts), (None, PRIVATE)]).withColumn("n_replaced", F.lit("clash"))
    out = surrogates.replace(docs, "key")
    got = {}
    for r in out.collect():
        if r.doc_id is not None:
            got[r.doc_id] = r
    n = len(AWKWARD)
    for i in [*range(n), n + 3]:
        assert got[i].text == texts[i] and got[i].n_replaced == 0
    new = got[n].text
    for secret in ("Jo.Doe9", "555-7713", "4539 1488", "4539148803436467", "8.8.8.8", "10.2.3.4", "123-45-6789", "04dbebab", "DE8937"):
        assert secret not in new
    shape = lambda t: re.sub("[A-Z]", "A", re.sub("[a-z]", "a", re.sub("[0-9]", "9", t)))
    mails = re.findall(r"\S+@[\w.]+", new)
    assert shape(mails[0]) == "Aa.Aaa9@Aaaa.aaaaaaa.aaa" and mails[0].lower() == mails[1].lower()
    assert mails[0].lower() in got[n + 1].text
    cards = re.findall(r"\d{4} \d{4} \d{4} \d{4}|\b\d{16}\b", new)
    assert cards[0].replace(" ", "") == cards[1] and cards[1][0] == "4"
    digits = [int(c) for c in cards[1]]
    assert sum(d if i % 2 else (2 * d - 9 if 2 * d > 9 else 2 * d) for i, d in enumerate(digits)) % 10 == 0
    assert re.search(r"\+1 \(\d{3}\) \d{3}-\d{4},", new) and re.search(r" 10\.\d+\.\d+\.\d+ ", new)
    assert got[n + 4].text == new
    names = got[n + 2].text
    first, wife = re.match(r"Mr\. (\w+ \w+) met Mrs (\w+);", names).groups()
    assert first.split()[1] == wife and first.split()[0].lower() in surrogates.GIVEN_NAMES["male", "latin"]
    assert f"Mr. {wife.upper()} is" in names and "Müller" not in names
    assert re.search("Господин [А-Яа-я]+ [А-Яа-я]+\\.", names) and "Петров" not in names
    assert surrogates.replace(docs, "other key").where("doc_id = %d" % n).first().text != new
    assert surrogates.replace(make_docs([]), "key").count() == 0


PLAIN_PHONES = ["555-123-4567", "555.123.4567", "555 123 4567", "1-555-123-4567", "020 7946 0958", "0171 1234567",
                "030/1234567", "06 12 34 56 78", "(020) 7946 0958", "(555) 123 4567"]
IPV6 = ["2001:db8:85a3:0:0:8a2e:370:7334", "2001:db8:85a3::8a2e:370:7334", "fe80::1", "::1", "::ffff:192.0.2.128", "2001:DB8::"]
NO_DATA = "on 01/02/2024 12 of 12:30:45, std::vector a::b, 01.02.2024 and 555-1234-567, 2024-01-02, 2.555.123.4567, 5 :: 6 Dr. no"


def test_national_phones_ipv6_and_more_titles_are_replaced(make_docs):
    titled = "Dr. John Smith and Prof. Dr. Jane Roe, Frau Dr. Meier; Dr John Smith"
    found = PLAIN_PHONES + IPV6
    docs = make_docs([*enumerate([f"call <{x}>, or" for x in found]), (100, titled), (101, NO_DATA)])
    got = {r.doc_id: r for r in surrogates.replace(docs, "key").collect()}
    assert [x for i, x in enumerate(found) if got[i].n_replaced != 1 or x in got[i].text] == []
    digits = lambda t: re.sub("[0-9]", "9", t)
    for i, x in enumerate(PLAIN_PHONES):
        assert digits(got[i].text) == digits(f"call <{x}>, or") and (got[i].text[6] == "0") == (x[0] == "0")
    import ipaddress

    new = [got[len(PLAIN_PHONES) + i].text[6:-5] for i in range(len(IPV6))]
    assert all(ipaddress.ip_address(x).version == 6 for x in new)
    assert new[0] == new[1] and len(set(new)) == len(IPV6) - 1 and ipaddress.ip_address(new[2]).is_link_local
    one, two, three, four = re.fullmatch(
        r"Dr\. (\w+ \w+) and Prof\. Dr\. (\w+ \w+), Frau Dr\. (\w+); Dr (\w+ \w+)", got[100].text).groups()
    assert one == four and not {*one.split(), *two.split(), three} & {"John", "Smith", "Jane", "Roe", "Meier"}
    assert got[100].n_replaced == 4 and got[101].n_replaced == 0 and got[101].text == NO_DATA


def test_titles_that_repeat_without_end(make_docs):
    """A title said thousands of times in a row neither ends the search nor hides the name behind it."""
    docs = make_docs([(1, "Mr " * 20_000 + "Smith"), (2, "Dr. Prof. Mrs Miller said"), (3, "Mr Lord came"), (4, "Mr " * 9)])
    got = {r.doc_id: r for r in surrogates.replace(docs, "key").collect()}
    assert got[1].text.startswith("Mr Mr ") and "Smith" not in got[1].text and got[1].n_replaced == 1
    assert got[2].text.startswith("Dr. Prof. Mrs ") and "Miller" not in got[2].text
    assert "Lord" not in got[3].text and got[3].text.startswith("Mr ")


def test_surrogates_stay_distinct_where_they_would_collide(spark):
    names = [("male", f"name{c}{d}") for c in "abcdefghij" for d in "klmnopqrst"] + [("male", "adam"), ("male", "peter")]
    units = spark.createDataFrame(names, "kind string, canonical string")
    got = surrogates.assign(units, "key").collect()
    assert len(got) == len(names) == len({r.surrogate for r in got})
    assert not {r.surrogate for r in got} & {n for _, n in names}


# --- mixing

def test_mix_meets_targets(make_docs):
    rng = random.Random(3)
    rows = []
    for i in range(300):
        source = rng.choice(["é", "b", None, "a", "a", "a"])
        rows.append((i if i % 50 else None, " ".join(["w"] * rng.choice((0, 3, 40, 700))) or None, source))
    rows += [(1, "x y z", "tiny"), (1, "x y z", "tiny")]
    docs = make_docs(rows).withColumn("size", F.lit("clash"))
    got = mixing.mix(docs, shard_words=2_000).collect()
    sizes, taken, target = Counter(), Counter(), {}
    for r in got:
        assert 0 <= r.taken <= 3 * r.size
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert r.source_size >= r.size
    want = by_hand.mix_targets(sizes)
    for s in want:
        assert target[s] == pytest.approx(want[s])
        assert abs(taken[s] - want[s]) <= max(3 * mixing.BLOCK_WORDS * (1 + sizes[s] // 2_000), 0.01 * want[s])
    again = mixing.mix(docs.repartition(7), shard_words=2_000).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    assert mixing.mix(make_docs([])).count() == 0
    assert [r.taken for r in mixing.mix(make_docs([(1, None)])).collect()] == [0]


def test_seats_go_to_the_highest_quotients(spark):
    rng = random.Random(4)
    rows = [(g, k, float(rng.randrange(1, 400)), seats, 1_000) for g, seats in (("x", 37), ("y", 3), (None, 250)) for k in range(9)]
    df = spark.createDataFrame(rows, "g string, k int, w double, seats long, most long")
    got = {(r.g, r.k): r.quota for r in mixing.apportion(df, ["g"], ["g", "k"], "w", "seats", "most").collect()}
    for g, seats in (("x", 37), ("y", 3), (None, 250)):
        mine = {k: w for gg, k, w, _, _ in rows if gg == g}
        count = dict.fromkeys(mine, 0)
        for _ in range(seats):
            best = max(mine, key=lambda k: (mine[k] / (2 * count[k] + 1), -k))
            count[best] += 1
        assert {k: got[g, k] for k in mine} == count


# --- token files

def test_documents_are_stitched_over_blocks(spark, make_docs, tmp_path):
    rng = np.random.default_rng(1)
    folder = str(tmp_path / "tokens")
    (tmp_path / "tokens").mkdir()
    want = {}
    for name, lengths, tail in (("a.bin", [5, 0, 0, 70, 1], 0), ("b.bin", [3], 9), ("c.bin", [], 4), ("d.bin", [], 0)):
        parts = [np.r_[rng.integers(0, 99, n), 99] for n in lengths] + [rng.integers(0, 99, tail)]
        np.concatenate(parts).astype("<u2").tofile(f"{folder}/{name}")
        want |= {(name, i): n for i, n in enumerate(lengths + ([tail] if tail else []))}
    files = spark.createDataFrame([(n,) for n in ("a.bin", "b.bin", "c.bin", "d.bin")], "file string")
    for block in (2, 8, 1_000):
        got = token_counts.separators(files, folder, 99, block_bytes=block).collect()
        assert {(r.file, r.place): r.n_tokens for r in got} == want


def test_counts_equal_the_tokenizer(spark, make_docs):
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    texts = [*AWKWARD, prose(1, 300), "<|endoftext|> <|endoftext|>"]
    docs = make_docs([*enumerate(texts), (None, "x y"), (9, texts[9])]).withColumn("file", F.lit(1))
    got = token_counts.count_tokens(spark, docs, ranks, public_tokenizers.PATTERN, 50_256, block_bytes=256)
    encode = token_counts._encoder(ranks, public_tokenizers.PATTERN).encode_ordinary
    want = [(i, len(encode(t or ""))) for i, t in [*enumerate(texts), (None, "x y"), (9, texts[9])]]
    assert sorted(((r.doc_id, r.n_tokens) for r in got.collect()), key=str) == sorted(want, key=str)
    empty = token_counts.count_tokens(spark, make_docs([]), ranks, public_tokenizers.PATTERN, 50_256)
    assert empty.count() == 0
    with pytest.raises(ValueError):
        token_counts.write_token_files(docs, "/tmp/never", ranks, "", eod=70_000)


# --- URL lists

def test_lists_hold_as_of_the_fetch(spark):
    events = spark.createDataFrame([
        ("domain", "bad.example", "add", "2024-01-10"), ("domain", "bad.example", "remove", "2024-03-01"),
        ("domain", "bad.example", "add", "2024-05-05"), ("domain", "bad.example", "add", "2024-06-01"),
        ("host", "www.bad.example", "add", "2024-01-20"), ("host", "www.bad.example", "remove", "2024-01-20"),
        ("prefix", "ok.example/ads/", "add", "2020-01-01"), ("prefix", None, "add", "2020-01-01"),
        ("host", "late.example", "add", None), ("prefix", "ok.example/ads/", "add", "2020-01-01"),
    ], "kind string, entry string, action string, at string").withColumn("at", F.col("at").cast("date"))
    captures = [
        ("http://bad.example/x", "2024-01-09", None), ("http://BAD.example:80/x", "2024-01-10", "domain"),
        ("https://u@a.b.bad.example?q", "2024-02-29", "domain"), ("http://bad.example", "2024-03-01", None),
        ("http://notbad.example/", "2024-02-01", None), ("http://www.bad.example/", "2024-01-20", "domain"),
        ("http://bad.example/", "2024-07-01", "domain"), ("http://ok.example/ads/1.html?z", "2024-07-01", "prefix"),
        ("http://ok.example/adserver", "2024-07-01", None), ("http://late.example", "2024-07-01", None),
        (None, "2024-07-01", None), ("no url", "2024-07-01", None), ("http://bad.example/", None, None),
        ("http://bad.example/", "2024-07-01", "domain"),
    ]
    df = spark.createDataFrame([(i, u, t) for i, (u, t, _) in enumerate(captures)], "page_id long, url string, day string")
    df = df.withColumn("fetched", F.col("day").cast("date")).withColumn("entry", F.lit("clash"))
    got = url_lists.listed(df, events)
    assert got.columns.count("entry") == 1
    assert {r.page_id: (r.listed, r.kind) for r in got.collect()} == {
        i: (k is not None, k) for i, (_, _, k) in enumerate(captures)}
    since = {r.page_id: str(r.since) for r in got.collect()}
    assert since[6] == "2024-05-05" and since[1] == "2024-01-10"
    assert url_lists.listed(df.limit(0), events).count() == 0
    assert not any(r.listed for r in url_lists.listed(df, events.limit(0)).collect())


def test_long_urls_cost_their_length(spark):
    events = spark.createDataFrame(
        [("domain", "b.org", "add"), ("prefix", "x.b.org/a/a/a/", "add"), ("prefix", "deep.net" + "/d" * 300 + "/", "add")],
        "kind string, entry string, action string").withColumn("at", F.lit("2020-01-01").cast("date"))
    urls = ["http://x.b.org/" + "a/" * 500_000, "http://" + "s." * 100_000 + "b.org/", "http://deep.net" + "/d" * 300 + "/e",
            "http://deep.net" + "/d" * 299 + "/e", "http://b.org"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id int, url string").withColumn(
        "fetched", F.lit("2021-05-05").cast("date"))
    got = {r.page_id: (r.kind, r.listed) for r in url_lists.listed(df, events).collect()}
    assert got == {0: ("prefix", True), 1: ("domain", True), 2: ("prefix", True), 3: (None, False), 4: ("domain", True)}


# --- licences

def test_licences_by_canonical_digest(spark, make_docs):
    from listingflow.llm.license_texts import TEXTS

    mit = TEXTS["MIT"]
    texts = [
        *AWKWARD, mit, "Copyright (c) 2020 Someone\n\n" + mit.upper().replace(",", " ,"), mit + " extra",
        "words\nReleased under the MIT Licence!\nmore\n* licensed under cc by-nc 4.0", "Released under the MIT License. And more",
        TEXTS["Zlib"].replace("acknowledgment", "acknowledgement"),
    ]
    docs = make_docs([*enumerate(texts), (None, mit), (0, mit)]).withColumn("digest", F.lit("clash"))
    rows = licenses.scan(docs).collect()
    assert len(rows) == len(texts) + 2
    n = len(AWKWARD)
    got = {r.doc_id: r for r in rows if r.doc_id}
    assert got[n].licence == got[n + 1].licence == "MIT" and got[n].digest == got[n + 1].digest
    assert got[n + 2].licence is None and got[n + 5].licence == "Zlib"
    assert (got[n + 3].n_notices, got[n + 3].notices) == (2, "CC-BY-NC-4.0,MIT")
    assert got[n + 4].n_notices == 0 and got[8].licence is None
    assert licenses.scan(make_docs([])).count() == 0


def test_licences_of_a_given_list(spark, make_docs):
    more = spark.createDataFrame([("House-1", "Use it, at your own risk.\nNo more."), ("Gone", None)], "licence string, text string")
    docs = make_docs([(1, "USE IT at your own risk\n\n  no more!"), (2, "use it"), (3, "(c) 2001 Us\nUse it, at your own risk. No more.")])
    assert {r.doc_id: r.licence for r in licenses.scan(docs, more).collect()} == {1: "House-1", 2: None, 3: "House-1"}


def test_many_blank_lines_are_looked_at_once(make_docs):
    text = "(c) 2020 One\n" + "\n \t*\n" * 200_000 + "words"
    row = licenses.scan(make_docs([(1, text), (2, "words")])).collect()
    assert row[0].digest == row[1].digest


# --- passages

def test_fenwick_chains_equal_quadratic_ones():
    rng = random.Random(9)
    for _ in range(200):
        matches = sorted({(rng.randrange(120), rng.randrange(120)) for _ in range(rng.randrange(2, 25))})
        a, b = [m[0] for m in matches], [m[1] for m in matches]
        best = []
        for i in range(len(a)):
            earlier = [best[j] - passages.GAP_COST * (a[i] - a[j] + b[i] - b[j]) for j in range(i) if a[j] < a[i] and b[j] < b[i]]
            best.append(passages.GAIN + max([0.0, *earlier]))
        chains = passages.chain(a, b)
        for c in chains:
            assert all(a[x] < a[y] and b[x] < b[y] for x, y in zip(c, c[1:]))
        assert len({m for c in chains for m in c}) == sum(map(len, chains))
        if chains and max(best) > passages.GAIN:
            def score(c):
                return passages.GAIN * len(c) - passages.GAP_COST * (a[c[-1]] - a[c[0]] + b[c[-1]] - b[c[0]])
            assert max(map(score, chains)) == pytest.approx(max(best))


def test_passages_are_found_whole(make_docs):
    shared = prose(50, 70)
    words = shared.split()
    fuzzy = " ".join("changed" if i in (20, 41) else w for i, w in enumerate(words) if i != 33)
    texts = {
        1: prose(1, 100) + " " + shared + " " + prose(2, 90), 2: prose(3, 80) + "\n" + shared.upper(), 3: shared,
        4: prose(4, 30) + " " + fuzzy + " " + prose(5, 30), 5: prose(6, 400), 6: prose(7, 60) + " " + " ".join(words[:30]),
        7: prose(6, 400), 8: None, 9: "", 10: "same " * 3_000, 11: "same " * 200,
    }
    docs = make_docs([*texts.items(), (None, shared), (3, shared)]).withColumn("start", F.lit("clash"))
    rows = passages.passages(docs).collect()
    found = {(r.doc_id, r.other_id): r for r in rows}
    assert {(2, 1), (3, 1), (4, 1), (7, 5)} <= set(found)
    assert not {r.doc_id for r in rows} & {6, 8, 9}
    whole = found[3, 1]
    assert (whole.start, whole.end, whole.other_start, whole.other_end, whole.identity) == (0, 70, 100, 170, 1.0)
    assert found[7, 5].n_words == 400
    near = found[4, 1]
    assert near.start == 30 and near.end == 99 and 0.9 < near.identity < 1
    assert passages.passages(make_docs([])).count() == 0


def test_runs_of_a_pair_are_chained_whatever_the_batches():
    runs = [(1, 2, p, p + d, -1) for p, d in [(100, 0), (3, 7), (140, 0), (191, 0), (4, 7), (400, 7)]]
    seeds = [(1, 2, 10, 30, 0), (1, 2, 20, 40, 6), (1, 3, 5, 5, 0), (2, 3, 8, 9, -1)]
    rows = sorted(runs + seeds, key=lambda r: r[:2])
    names = ["a", "b", "place_a", "place_b", "gap"]
    for size in (1, 2, 3, len(rows)):
        parts = [pa.table(dict(zip(names, zip(*rows[i : i + size])))) for i in range(0, len(rows), size)]
        found = [b for b in passages._chained((b for t in parts for b in t.to_batches()), 50)]
        assert sorted(tuple(map(str, r.values())) for b in found for r in b.to_pylist()) == sorted(
            tuple(map(str, r)) for r in [
                (1, 2, [10, 20, 26], [30, 40, 46]), (1, 2, [100, 185], [100, 185]), (1, 2, [191, 236], [191, 236]),
                (1, 2, [3, 49], [10, 56]), (1, 2, [400, 445], [407, 452]), (2, 3, [8, 53], [9, 54])])


def test_periodic_passages_are_found_whole(make_docs):
    line, verse = prose(70, 9), prose(71, 30)
    texts = {
        1: "la " * 60, 2: prose(72, 40) + " " + "la " * 60, 3: (line + " ") * 20, 4: (line + " ") * 20,
        5: prose(73, 30) + " " + (verse + " ") * 8, 6: (verse + " ") * 8 + prose(74, 30), 7: (line + " ") * 50,
    }
    rows = passages.passages(make_docs([*texts.items()])).collect()
    assert {(2, 1, 40, 100), (4, 3, 0, 180), (6, 5, 0, 240)} <= {(r.doc_id, r.other_id, r.start, r.end) for r in rows}
    longer = [(r.start, r.end) for r in rows if (r.doc_id, r.other_id) == (7, 3)]
    assert {i for s, e in longer for i in range(s, e)} == set(range(450))


def test_every_run_found_earlier_is_covered(make_docs):
    run = prose(80, 80).split()
    texts = [prose(81, 30) + " " + " ".join(run[:44]), " ".join(run[40:]) + " " + prose(82, 30)]
    # Every part of 49 words was there before, no run of 50.
    texts += [" ".join(run[i : i + 49]) for i in range(0, 32)]
    texts += [prose(83, 20) + " " + " ".join(run), " ".join(run) + " " + prose(84, 25)]
    # Later ones too have parts only; then the whole once more, and one whose ends do not align.
    texts += [" ".join(run[:44]), " ".join(run[40:]), prose(85, 15) + " " + " ".join(run) + " " + prose(86, 15)]
    texts += [prose(87, 60) + " " + " ".join(run[15:65]) + " " + prose(88, 60)]
    docs = make_docs([*enumerate(texts)])
    rows = passages.passages(docs).collect()
    words = [t.split() for t in texts]
    covered = {(r.doc_id, i) for r in rows for i in range(r.start, r.end)}
    seen, missed = {}, []
    for doc, w in enumerate(words):
        for i in range(len(w) - 49):
            key = tuple(w[i : i + 50])
            if seen.setdefault(key, doc) < doc and not all((doc, j) in covered for j in range(i, i + 50)):
                missed.append((doc, i))
    assert not missed
    assert {(35, 34, 0, 80), (38, 34, 15, 95), (39, 34, 60, 110)} <= {(r.doc_id, r.other_id, r.start, r.end) for r in rows}
    assert len({(r.doc_id, r.other_id) for r in rows}) == len(rows)


# --- quality classifier

def test_scores_separate_held_out_documents(spark, make_docs):
    good = [(i, prose(i, 150).replace(" ", ", ", 5) + ".") for i in range(0, 400)]
    bad = [(i, " ".join(w + "###" for w in prose(i, 120).split())) for i in range(400, 500)]
    docs = make_docs(good + bad + [(None, None), (9_001, ""), (9_001, "")]).withColumn("score", F.lit("clash"))
    labels = [(i, 1, 0) for i in range(0, 200)] + [(i, 0, 0) for i in range(400, 420)] + [(5, 1, 0), (6, None, 0), (None, 1, 0)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rows = pu_quality.score(docs, labels).collect()
    assert len(rows) == 503
    right = [r.predicted == (r.doc_id < 400) for r in rows if r.doc_id is not None and r.doc_id < 500 and r.held_out]
    assert len(right) > 50 and sum(right) >= 0.95 * len(right)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert [r.held_out for r in rows if r.doc_id is None] == [None]
    again = {(r.doc_id, r.score) for r in pu_quality.score(docs.repartition(5), labels).collect()}
    assert again == {(r.doc_id, r.score) for r in rows}
    assert pu_quality.score(make_docs([]), labels).count() == 0
    alone = pu_quality.score(make_docs([(1, "a b")]), labels.limit(0)).first()
    assert alone.score == 0.5


def test_the_fit_sees_no_held_out_label(spark):
    docs, labels = (f(spark, "/root/testdata/sf0.001") for f in (bindings.documents, bindings.labels))
    turned = labels.withColumn("quality", F.when(pu_quality.fold_of("doc_id") == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = ({(r.doc_id, r.score) for r in pu_quality.score(docs, x).collect()} for x in (labels, turned))
    assert a == b


def test_prior_of_separable_samples():
    rng = np.random.default_rng(2)
    for share in (0.3, 0.8):
        pos = np.c_[rng.normal(2, 1, 3_000), np.ones(3_000)]
        n = int(4_000 * share)
        unl = np.c_[np.r_[rng.normal(2, 1, n), rng.normal(-3, 1, 4_000 - n)], np.ones(4_000)]
        assert pu_quality.estimate_prior(pos, unl[rng.permutation(4_000)]) == pytest.approx(share, abs=0.06)
