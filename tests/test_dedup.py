import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

import plain
from builders import listing, listings
from listingflow.functions.columns import listing_text
from listingflow.operators import components, dedup, evaluate, review, textweights
from listingflow.operators.components import connected_components
from listingflow.operators.dedup import MatchConfig, block_sizes, find_duplicates, gated_pairs


def found_clusters(result):
    out = {}
    for r in result.members.collect():
        out.setdefault(r.dup_cluster_id, []).append(r.listing_id)
    return {k: sorted(v) for k, v in out.items()}


DRIFTED = {"price_aed_month": 6130, "size_sqft": 604, "lon": 2.1541, "agent_name": "Agency Sud",
           "title": "By the pier: a corner flat"}

# case -> (rows, expected clusters, expected pairs). Each case is a block of its own, so one run answers all.
CASES = {
    "repost with small drift": ([listing(1), listing(2, **DRIFTED)], [[1, 2]], {(1, 2)}),
    "five kilometres apart": ([listing(11), listing(12, lat=41.435)], [], set()),
    "other bedrooms": ([listing(21), listing(22, bedrooms=2)], [], set()),
    "chain": ([listing(31), listing(32, price_aed_month=6070, size_sqft=602),
               listing(33, price_aed_month=6130, size_sqft=604)],
              [[31, 32, 33]], {(31, 32), (31, 33), (32, 33)}),
    "equal numbers need no common word": ([listing(41, title="alpha", description=None),
                                           listing(42, title=None, description="omega")], [[41, 42]], {(41, 42)}),
    "drift needs a common word": ([listing(51, title="alpha", description="beta"),
                                   listing(52, title="gamma", description="delta", price_aed_month=6070)], [], set()),
    "copies hang on the least id": ([listing(i) for i in (67, 63, 69, 65)], [[63, 65, 67, 69]],
                                    {(63, 65), (63, 67), (63, 69)}),
    "no price": ([listing(71, price_aed_month=None), listing(72, price_aed_month=None)], [], set()),
    "no place": ([listing(81, lat=None), listing(82, lon=float("nan")), listing(83)], [[81, 82, 83]],
                 {(81, 82), (81, 83)}),
}


@pytest.fixture(scope="module")
def cases(spark):
    rows = [{**r, "area": case} for case, (group, _, _) in CASES.items() for r in group]
    result = find_duplicates(listings(spark, *rows))
    scores = {(r.id_a, r.id_b): r.score for r in result.pairs.collect()}
    return found_clusters(result), scores


@pytest.mark.parametrize("case", CASES)
def test_small_cases(cases, case):
    clusters, scores = cases
    rows, expected, pairs = CASES[case]
    ids = {r["listing_id"] for r in rows}
    assert sorted(c for c in clusters.values() if set(c) & ids) == expected
    assert {p for p in scores if set(p) & ids} == pairs


def test_scores_and_cluster_names(cases):
    clusters, scores = cases
    assert scores[(41, 42)] == 0.55 and scores[(63, 65)] == 1.0
    assert {int(name.removeprefix("cluster_")) for name in clusters} == {min(c) for c in clusters.values()}


def test_pairs_are_counted_per_block_without_forming_them(spark):
    df = listings(spark, listing(1), listing(2), listing(3), listing(4, bedrooms=2), listing(5, area=None))
    rows = {(r.area, r.bedrooms): (r.n_listings, int(r.n_pairs)) for r in block_sizes(df).collect()}
    assert rows == {("Harbour East", 1): (3, 3), ("Harbour East", 2): (1, 0)}


def random_rows(rng, n, near=True):
    """Rows that coincide often: few places, prices, sizes and words, with nulls, zeros and negatives."""
    words = ["sea", "view", "bright", "tower", "the", "été", "x", "pool", "new_unit", "42"]
    rows = []
    for i in range(n):
        place = rng.choice([0, 1, 2, 3]) * 0.0026 + rng.choice([0, 0.0001, 0.0004])
        rows.append(listing(
            i, area=rng.choice(["A", "A", "A", "B", None]), bedrooms=rng.choice([1, 1, 1, 2]),
            lat=rng.choice([25.0 + place] * 8 + [None, float("nan")]),
            lon=rng.choice([55.0 + place, 55.0 + place, 55.0 - place, 55.0 + rng.random() * 0.01]),
            price_aed_month=rng.choice([9000, 9000, 9100, 9500, 9900, 20000, 0, -500, None]),
            size_sqft=rng.choice([800, 800, 810, 820, 840, 1200, None]),
            title=rng.choice([None, "", " ".join(rng.choices(words, k=rng.randint(1, 5)))]),
            description=rng.choice([None, "", " ".join(rng.choices(words, k=rng.randint(1, 5)))]),
        ))
    return rows


def check_against_plain(spark, rows, config):
    want = plain.pairs(rows, config)
    result = find_duplicates(listings(spark, *rows).repartition(3), config)
    got = {(r.id_a, r.id_b): r.score for r in result.pairs.collect()}
    for pair, score in got.items():
        assert pair in want and score == pytest.approx(want[pair], abs=6e-5)
    assert {r.listing_id: int(r.dup_cluster_id.split("_")[1]) for r in result.members.collect()} == plain.clusters(want)
    return got, want


@pytest.mark.parametrize("seed, hot_rows", [(1, 20_000), (2, 3), (3, 1)])
def test_clusters_equal_those_of_all_pairs(spark, seed, hot_rows):
    rows = random_rows(random.Random(seed), 220)
    check_against_plain(spark, rows, MatchConfig(hot_rows=hot_rows))


@pytest.mark.parametrize("gates", [
    {"min_price_similarity": None}, {"min_size_similarity": None}, {"max_distance_m": None},
    {"min_price_similarity": None, "min_size_similarity": None, "max_distance_m": None},
    {"min_price_similarity": None, "threshold": 0.65},
])
def test_open_gates_keep_zeros_and_nulls_apart(spark, gates):
    rng = random.Random(10)
    rows = random_rows(rng, 150)
    for r in rows:
        r["size_sqft"] = rng.choice([r["size_sqft"]] * 4 + [0])
    check_against_plain(spark, rows, MatchConfig(hot_rows=6, **gates))


def test_a_price_of_zero_matches_by_text_and_size_alone(spark):
    rows = [listing(1, price_aed_month=0), listing(2), listing(3, price_aed_month=0), listing(4, price_aed_month=None)]
    got = {(r.id_a, r.id_b): r.score for r in find_duplicates(
        listings(spark, *rows), MatchConfig(min_price_similarity=None)).pairs.collect()}
    assert got == {(1, 2): 0.7, (2, 3): 0.7}
    gated = gated_pairs(listings(spark, *rows), MatchConfig(min_price_similarity=None, min_size_similarity=None))
    assert {(r.id_a, r.id_b) for r in gated.collect()} == {(1, 2), (1, 3), (1, 4), (2, 3), (2, 4), (3, 4)}


@pytest.mark.parametrize("threshold", [0.6, 0.8])
def test_clusters_with_a_threshold_that_needs_words(spark, threshold):
    rows = random_rows(random.Random(4), 200)
    check_against_plain(spark, rows, MatchConfig(threshold=threshold, hot_rows=4))


def test_all_pairs_are_listed_where_every_point_has_one_text(spark):
    rng = random.Random(5)
    rows = [r for r in random_rows(rng, 200) if r["lat"] == r["lat"] and r["lat"] is not None]
    for i, r in enumerate(rows):
        r["lon"] = 55.0 + (i % 40) * 0.00002 + i * 1e-7  # no two rows at one place
    got, want = check_against_plain(spark, rows, MatchConfig(hot_rows=5))
    assert got.keys() == want.keys() and len(want) > 50


def test_hot_group_of_copies_and_rewordings_stays_linear(spark):
    """A third of all rows in one place: copies, new texts, drifting prices. Links stay near the row count."""
    rng = random.Random(6)
    hot = [listing(i, title=f"offer {rng.choice(['sea', 'sky', 'sun'])} {i % 50}",
                   price_aed_month=9000 + 50 * (i % 4)) for i in range(400)]
    rest = [listing(1000 + i, lat=26.0 + i * 0.01, title=f"unit {i}") for i in range(200)]
    config = MatchConfig(hot_rows=50)
    result = find_duplicates(listings(spark, *hot, *rest), config)
    assert result.pairs.count() < 3 * len(hot)
    assert found_clusters(result) == {"cluster_0": list(range(400))}


def two_crowds(rng, n, planted, n_words=400, skew=3):
    """Two points at one place whose prices differ, so that texts must agree, with ``n`` texts each."""
    def words():
        return " ".join(f"w{int(n_words * rng.random() ** skew)}" for _ in range(14)) + " sunny flat"

    rows = [listing(i, title=words(), description=None, price_aed_month=6000 if i < n else 3000) for i in range(2 * n)]
    if planted:
        rows[n + n // 2]["title"] = rows[n // 3]["title"] + " again"
    return rows


@pytest.mark.parametrize("planted, weights", [
    (True, {}), (False, {}), (True, {"text_weight": 0.4, "price_weight": 0.25, "size_weight": 0.35}),
    (False, {"text_weight": 0.2, "price_weight": 0.4, "size_weight": 0.25}),
])
def test_crowded_points_meet_at_rare_words(spark, planted, weights):
    rows = two_crowds(random.Random(9), 90, planted)
    check_against_plain(spark, rows, MatchConfig(min_price_similarity=None, **weights))


@pytest.mark.parametrize("planted", [True, False])
def test_two_points_of_very_many_texts(spark, planted):
    n = 2_500
    config = MatchConfig(min_price_similarity=None, text_weight=0.3, price_weight=0.2, size_weight=0.4, threshold=0.6)
    result = find_duplicates(listings(spark, *two_crowds(random.Random(12), n, planted, 20_000, 1)), config)
    assert result.pairs.count() < 20 * n
    assert len(found_clusters(result)) == (1 if planted else 2)


@pytest.mark.parametrize("lat", [0.0, 60.0, -75.0, 89.99, -89.999])
def test_distance_gate_at_any_latitude(spark, lat):
    rng = random.Random(7)
    rows = [listing(i, lat=lat + rng.uniform(-0.004, 0.004), lon=rng.choice([-1, 1]) * rng.uniform(0, 0.02),
                    price_aed_month=9000 + i) for i in range(60)]
    config = MatchConfig(min_price_similarity=None, min_size_similarity=None, hot_rows=7)
    want = {(a["listing_id"], b["listing_id"]) for i, a in enumerate(rows) for b in rows[i + 1:]
            if plain._meters(a, b) <= 300}
    assert {(r.id_a, r.id_b) for r in gated_pairs(listings(spark, *rows), config).collect()} == want and want


def test_open_distance_gate_compares_the_whole_block(spark):
    rows = [listing(i, lat=25.0 + i) for i in range(6)]
    assert gated_pairs(listings(spark, *rows), MatchConfig(max_distance_m=None)).count() == 15


@pytest.mark.parametrize("edges", [
    [(1, 2), (2, 3), (3, 4), (10, 11)],
    [(i, i + 1) for i in range(60)],
    [(0, i) for i in range(1, 50)] + [(49, 100), (100, 101)],
    [(5, 3), (3, 5), (9, 9)],
])
def test_components_of_chains_hubs_and_loops(spark, edges):
    got = {r.id: r.component for r in connected_components(
        spark.createDataFrame(edges, "id_a bigint, id_b bigint")).collect()}
    assert got == plain.clusters([e for e in edges if e[0] != e[1]])


def test_components_of_random_edges(spark):
    rng = random.Random(8)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(240)]
    got = {r.id: r.component for r in connected_components(
        spark.createDataFrame(edges, "id_a bigint, id_b bigint")).collect()}
    assert got == plain.clusters([e for e in edges if e[0] != e[1]])


def test_no_edges_give_no_components(spark):
    assert connected_components(spark.createDataFrame([], "id_a bigint, id_b bigint")).count() == 0


def test_review_and_sample(spark):
    rows = [listing(1), listing(2, price_aed_month=6070), listing(3, price_aed_month=6130)]
    rows += [listing(10, lat=26.0), listing(11, lat=26.0, price_aed_month=6030), listing(20, lat=27.0)]
    df = listings(spark, *rows)
    result = find_duplicates(df)
    assert [(r.cluster_id, r.listing_id) for r in review.review_members(df, result).collect()] == [
        ("cluster_1", 1), ("cluster_1", 2), ("cluster_1", 3), ("cluster_10", 10), ("cluster_10", 11)]
    assert {(r.cluster_id, r.id_a, r.id_b) for r in review.review_pairs(result).collect()} == {
        ("cluster_1", 1, 2), ("cluster_1", 1, 3), ("cluster_1", 2, 3), ("cluster_10", 10, 11)}
    sample = review.cluster_sample(df, result, {2: 1}).collect()
    assert [(r.cluster_id, r.clusters_total, len(r.members), len(r.pair_scores)) for r in sample] == [
        ("cluster_10", 2, 2, 1)]


def test_truth_groups_as_links_and_counts(spark):
    df = listings(spark, listing(1, dup_group_truth=1), listing(2, dup_group_truth=1), listing(3),
                  listing(4, dup_group_truth=None), listing(5, dup_group_truth=None))
    assert {tuple(r) for r in evaluate.group_links(df, "dup_group_truth").collect()} == {(1, 2)}
    assert [int(r.n_pairs) for r in evaluate.group_pairs(df, "dup_group_truth").collect()] == [1]


def test_pair_metrics_equal_those_of_pair_sets(spark):
    rng = random.Random(9)
    data = [(i, rng.choice([None, 1, 2, 3, 4]), rng.choice([None, "a", "b", "c"])) for i in range(80)]

    def pair_set(column):
        return {(a[0], b[0]) for a in data for b in data if a[0] < b[0] and a[column] is not None
                and a[column] == b[column]}

    truth, predicted = pair_set(1), pair_set(2)
    row = evaluate.pair_metrics(
        spark.createDataFrame(data, "listing_id bigint, dup_group_truth bigint, dup_cluster_id string")).first()
    tp = len(truth & predicted)
    assert [int(row[c]) for c in ("true_pairs", "predicted_pairs", "true_positives", "false_positives",
                                  "false_negatives")] == [len(truth), len(predicted), tp, len(predicted) - tp,
                                                          len(truth) - tp]
    assert row.precision == pytest.approx(tp / len(predicted), abs=1e-4)
    assert row.clusters_found == 3 and row.listings_scored == 80


def test_pair_metrics_without_any_group(spark):
    row = evaluate.pair_metrics(listings(spark, listing(1)).withColumn(
        "dup_cluster_id", F.lit(None).cast("string"))).first()
    assert (row.precision, row.recall, row.f1, int(row.true_pairs)) == (0.0, 0.0, 0.0, 0)


def test_large_group_counts_do_not_overflow(spark):
    n = F.lit(6_000_000_000).cast("bigint")
    row = spark.range(1).select(evaluate._pairs_of(n).alias("p")).first()
    assert int(row.p) == 6_000_000_000 * 5_999_999_999 // 2


def test_config_is_open_to_change():
    assert MatchConfig().equal_numbers_match and not replace(MatchConfig(), threshold=0.56).equal_numbers_match


def dense_rows(n):
    """Listings of one block at places of their own within the gates of all others: pairs grow with the square."""
    return [listing(i, lat=25.0 + (i % 20) * 1e-5, lon=55.0 + (i // 20) * 1e-5, price_aed_month=6000 + i % 7) for i in range(n)]


def test_clusters_of_a_dense_place_come_from_few_links(spark):
    result = find_duplicates(listings(spark, *dense_rows(300)).repartition(3))
    assert result.links.count() < 2 * 300
    assert result.pairs.count() == 300 * 299 // 2
    assert found_clusters(result) == {"cluster_0": list(range(300))}


def test_thinned_links_keep_the_components(spark, monkeypatch):
    rng = random.Random(21)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(300)] + [(i, j) for i in range(500, 540) for j in range(500, i)]
    want = plain.clusters([e for e in edges if e[0] != e[1]])
    for held in (1 << 20, 50):
        monkeypatch.setattr(components, "HELD", held)
        links = components.thin_links(spark.createDataFrame(
            [(min(e), max(e)) for e in edges], "id_a bigint, id_b bigint").coalesce(1)).collect()
        assert plain.clusters([(r.id_a, r.id_b) for r in links]) == want
        if held > 50:
            assert len(links) < len(want)


def test_pairs_of_some_clusters_compare_no_other_points(spark, monkeypatch):
    """Of whole clusters, points with several texts among them, the same pairs come from their points alone."""
    rows = [listing(3 * i + j, title=f"word{i} garden", description=f"text{j % 2}", lat=25 + i / 50, lon=55.0) for i in range(6) for j in range(3)]
    rows += [listing(100 + i, title="word9 garden", lat=26.0, lon=55.0 + i / 5000) for i in range(3)]
    result = find_duplicates(listings(spark, *rows))
    whole = {tuple(r) for r in result.pairs.select("id_a", "id_b", "score").collect()}
    chosen = result.members.where("dup_cluster_id in ('cluster_3', 'cluster_100')")
    ids = {r.listing_id for r in chosen.collect()}
    compared, gated = [], dedup.gated_points
    monkeypatch.setattr(dedup, "gated_points", lambda points, *a: compared.append(points.count()) or gated(points, *a))
    among = {tuple(r) for r in result.pairs_among(chosen).collect()}
    assert ids == {3, 4, 5, 100, 101, 102} and among == {p for p in whole if p[0] in ids} and len(among) > 3
    assert compared and max(compared) <= 4


def pair_scores(df):
    rows = [(r.id_a, r.id_b, r.score) for r in df.collect()]
    assert len({r[:2] for r in rows}) == len(rows)
    return {(a, b): score for a, b, score in rows}


@pytest.mark.parametrize("seed, options", [
    (31, {}), (32, {"hot_rows": 3}), (33, {"min_price_similarity": None, "hot_rows": 6}), (34, {"threshold": 0.7})])
def test_all_pairs_hold_every_matching_pair(spark, seed, options):
    """copies and several texts at one place are paired with each other and with all that match them."""
    rows = random_rows(random.Random(seed), 160)
    want = plain.pairs(rows, MatchConfig(**options))
    result = find_duplicates(listings(spark, *rows).repartition(3), MatchConfig(**options))
    got = pair_scores(result.all_pairs)
    assert got.keys() == want.keys() and len(got) >= result.pairs.count()
    assert all(got[p] == pytest.approx(want[p], abs=6e-5) for p in want)


def test_all_pairs_of_copies_in_reviews_and_samples(spark):
    """F16, F17: every pair inside a cluster has its score, also of copies, rewordings and rows that come twice."""
    rows = [listing(i) for i in (4, 2, 9, 9)] + [listing(7, title="Hall")]
    rows += [listing(20 + i, lat=26.0, title=f"word{i % 2}") for i in range(3)]
    df = listings(spark, *rows)
    result = find_duplicates(df)
    first = {(a, b) for a in (2, 4, 7, 9) for b in (2, 4, 7, 9) if a < b}
    second = {(20, 21), (20, 22), (21, 22)}
    assert {(r.cluster_id, r.id_a, r.id_b) for r in review.review_pairs(result).collect()} == (
        {("cluster_2", *p) for p in first} | {("cluster_20", *p) for p in second})
    assert review.review_pairs(result).count() == 9
    [sample] = review.cluster_sample(df, result, {3: 2}).collect()
    assert {(p.id_a, p.id_b) for p in sample.pair_scores} == second and len(sample.pair_scores) == 3
    assert pair_scores(result.all_pairs_among(result.members.where("listing_id > 19"))).keys() == second


def test_a_norm_is_worked_out_once_for_a_text(spark):
    """inside the function of a vector's weights, Spark would work out the norm again for each token."""
    df = listings(spark, *(listing(i, title=f"word{i} sea sea pool") for i in range(3)))
    vectors = textweights.block_vectors(df.withColumn("text", listing_text()), MatchConfig.block)
    assert "/ sqrt(aggregate(" not in vectors._jdf.queryExecution().optimizedPlan().toString().lower()
    for row in vectors.collect():
        assert sum(w * w for w in row.vector.values()) == pytest.approx(1.0)


def test_pairs_that_bring_their_vectors_have_the_same_similarity(spark):
    """scores are worked out where pairs meet, with what a join of the vectors gives."""
    df = listings(spark, *random_rows(random.Random(41), 120)).repartition(3)
    vectors = textweights.block_vectors(df.withColumn("text", listing_text()), MatchConfig.block)
    joined = textweights.cosine_pairs(gated_pairs(df), vectors)
    brought = textweights.cosine_pairs(gated_pairs(df, vectors=vectors), vectors)
    brought = brought.select(joined.columns)
    assert sorted(map(tuple, brought.collect())) == sorted(map(tuple, joined.collect())) and joined.count() > 20
    assert pair_scores(dedup.score_pairs(brought)) == pair_scores(dedup.score_pairs(joined))
