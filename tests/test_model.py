import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from builders import listing, listings, members
from listingflow.operators import model, requests
from domain import AREAS, PROPERTY_TYPES, default_areas, default_types
from listingflow.streaming import scoring
from listingflow.session import work_path

PARAMS = model.ModelParams(rounds=15, step=0.3)


@pytest.fixture(scope="module")
def market(spark):
    """Listings whose price follows area, size and furnishing."""
    rng = random.Random(3)
    rows = []
    for i in range(900):
        k = rng.randrange(len(AREAS))
        name, bedrooms, low, high, tower = PROPERTY_TYPES[rng.randrange(len(PROPERTY_TYPES))]
        size = rng.randint(low, high)
        furnished = rng.randint(0, 1)
        price = int(size * (4 + k * 0.6) * (1.1 if furnished else 1.0) * rng.uniform(0.95, 1.05))
        rows.append(listing(i, area=AREAS[k][0], lat=AREAS[k][1], lon=AREAS[k][2], property_type=name,
                            bedrooms=bedrooms, size_sqft=size, furnished=furnished, price_aed_month=price,
                            floor=15 if tower else 0))
    return listings(spark, *rows).repartition(4).persist()


@pytest.fixture(scope="module")
def fitted(market):
    return model.fit_price_model(market, PARAMS)


def test_clean_set_keeps_the_earliest_unflagged_row_per_unit(spark):
    df = listings(spark, listing(1, listed_date=dt.date(2026, 5, 9)), listing(2, listed_date=dt.date(2026, 5, 1)),
                  listing(3), listing(4))
    flags = spark.createDataFrame([(1, 0), (2, 0), (3, 0), (4, 1)], "listing_id bigint, flag int")
    clean = model.clean_training_set(df, members(spark, {1: "cluster_1", 2: "cluster_1"}), flags)
    assert sorted(r.listing_id for r in clean.collect()) == [2, 3]


def test_flagged_rows_go_before_the_earliest_is_chosen(spark):
    df = listings(spark, listing(1, listed_date=dt.date(2026, 5, 1)), listing(2, listed_date=dt.date(2026, 5, 9)),
                  listing(3, listed_date=None))
    flags = spark.createDataFrame([(1, 1)], "listing_id bigint, flag int")
    clean = model.clean_training_set(df, members(spark, dict.fromkeys((1, 2, 3), "cluster_1")), flags)
    assert [r.listing_id for r in clean.collect()] == [2]


def test_split_does_not_depend_on_partitioning(market):
    ids = [{r.listing_id for r in model.train_test_split(df)[1].collect()}
           for df in (market, market.repartition(9).orderBy(F.rand()))]
    assert ids[0] == ids[1] and 0.14 < len(ids[0]) / market.count() < 0.26


def test_unknown_values_are_all_zeros(spark, fitted):
    rows = model.encoded_features(fitted.model, listings(spark, listing(1), listing(2, area="Atlantis"))).collect()
    numbers = len(model.NUMERIC_FEATURES)
    hot = {r.listing_id: sum(r.features[numbers:]) for r in rows}
    assert hot == {1: 2.0, 2: 1.0}
    assert len(rows[0].features) == numbers + len(AREAS) + len(PROPERTY_TYPES)


def test_model_quality_on_held_out_rows(market, fitted):
    row = fitted.metrics.first()
    assert row.r2 > 0.9 and row.mape < 0.2
    assert row.n_train + row.n_test == market.count() and fitted.heldout.count() == row.n_test


def test_regression_metrics(spark):
    df = spark.createDataFrame([(100.0, 110.0), (200.0, 190.0), (300.0, 300.0)], "actual double, predicted double")
    row = model.regression_metrics(df).first()
    assert (row.mae, row.mape, row.r2) == (6.7, 0.05, 0.99)


def test_importances_sum_to_one(market, fitted):
    scored = fitted.model.transform(model.with_distance(market))
    rows = model.feature_importances(fitted.model, scored).collect()
    assert {r.feature for r in rows} == {*model.NUMERIC_FEATURES, *model.CATEGORICAL_FEATURES}
    assert sum(r.importance for r in rows) == pytest.approx(1, abs=1e-3)
    assert rows[0].feature == "size_sqft" and [r.importance for r in rows] == sorted(
        (r.importance for r in rows), reverse=True)


def test_saved_model_predicts_the_same(spark, market, fitted):
    path = work_path(spark, "model")
    model.save_model(fitted.model, path)
    a, b = (model.score_all(m, market).orderBy("listing_id").collect()
            for m in (fitted.model, model.load_model(path)))
    assert a == b
    with pytest.raises(FileNotFoundError):
        model.load_model(path + "-missing")


def test_a_unit_lies_in_one_fold_and_every_row_is_scored_once(spark, market):
    units = members(spark, {i: f"cluster_{i // 3 * 3}" for i in range(300)})
    out = model.score_out_of_fold(market, market, units, params=model.ModelParams(rounds=3, step=0.5)).cache()
    assert out.count() == market.count() == out.select("listing_id").distinct().count()
    spread = out.where(F.col("dup_cluster_id").isNotNull()).groupBy("dup_cluster_id").agg(
        F.countDistinct("fold").alias("n"))
    assert spread.agg(F.max("n")).first()[0] == 1 and out.select("fold").distinct().count() == 5
    assert out.where(F.col("residual_pct").isNull()).count() == 0


def test_folds_are_scored_by_models_of_the_other_folds(spark, market):
    """The same trees as a fit on the rows of the other folds alone."""
    params = model.ModelParams(rounds=3, step=0.5, subsample=1.0)
    out = model.score_out_of_fold(market, market.where("listing_id % 4 <> 0"), None, params=params).where("fold = 2")
    rest = model.group_folds(model.with_clusters(market, None)).where("fold <> 2 and listing_id % 4 <> 0")
    encoder = model.fit_encoder(market)
    fitted = model.fit_vectors(model.with_vectors(encoder, rest), rest.count(), encoder, params)
    want = {r.listing_id: r.predicted_price_aed_month for r in model.score_all(fitted, market).collect()}
    rows = out.collect()
    assert len(rows) > 100
    assert all(abs(r.predicted_price_aed_month - want[r.listing_id]) <= 1 for r in rows)


def test_fewer_units_than_folds_is_an_error(spark):
    with pytest.raises(ValueError):
        model.score_out_of_fold(listings(spark, listing(1), listing(2)), listings(spark, listing(1)), None)


def test_flagged_listings_are_ordered_and_may_be_cut(spark):
    df = spark.createDataFrame([(1, -0.3), (2, -0.5), (3, -0.5), (4, 0.1), (5, None)],
                               "listing_id bigint, residual_pct double")
    assert [r.listing_id for r in model.flagged_listings(df).collect()] == [2, 3, 1]
    assert [r.listing_id for r in model.flagged_listings(df, n=1).collect()] == [2]


# ---- grid and requests ----

REQUEST = ("area string, property_type string, size_sqft double, bedrooms int, furnished boolean, "
           "building_age_years double, floor int")


def ask(spark, *rows):
    base = ("Harbour East", "Flat", 800.0, None, None, None, None)
    return spark.createDataFrame([tuple(r) + base[len(r):] for r in rows], REQUEST)


def test_grid_covers_every_combination(spark):
    grid = requests.grid_points(default_areas(spark), default_types(spark)).cache()
    assert grid.count() == 12 * 6 * 6 * 2 == grid.select("area", "property_type", "size_sqft", "furnished").distinct().count()
    studio = grid.where("property_type = 'Loft'").agg(F.sort_array(F.collect_set("size_sqft")), F.max("floor")).first()
    assert studio[0] == [400, 440, 480, 520, 560, 600] and studio[1] == 15


def test_grid_of_very_many_types(spark, monkeypatch):
    monkeypatch.setattr(requests, "SQUARE", 5)
    types = spark.range(1500).selectExpr(
        "concat('type', id) AS property_type", "1 AS default_bedrooms", "100 AS min_size", "200 AS max_size", "0 AS is_tower")
    assert requests.grid_points(default_areas(spark), types).count() == 12 * 1500 * 6 * 2


def test_bad_requests_are_rejected_with_a_reason(spark):
    df = ask(spark, ("Harbour East", "Flat", 800.0), ("Atlantis",), ("Harbour East", "Castle"),
             ("Harbour East", "Flat", -5.0), ("Harbour East", None), ("Harbour East", "Farmhouse", None),
             ("Harbour East", "Farmhouse", 100.0), ("Harbour East", "Farmhouse", 20000.0),
             ("Harbour East", "Farmhouse", 3000.0, 11), ("Harbour East", "Farmhouse", 3000.0, 4, True, 101.0),
             ("Harbour East", "Farmhouse", 3000.0, 4, True, 8.0, 201), (None,))
    valid, rejected = requests.prepare_requests(df, default_areas(spark), default_types(spark))
    rows = {(r.property_type, r.size_sqft): r for r in valid.collect()}
    assert set(rows) == {("Flat", 800.0), ("Farmhouse", 20000.0)}
    marina = rows[("Flat", 800.0)]
    assert (marina.bedrooms, marina.furnished, marina.building_age_years, marina.floor, marina.lat) == (
        2, 0, 8, 15, 41.39)
    assert rows[("Farmhouse", 20000.0)].floor == 0 and rows[("Farmhouse", 20000.0)].bedrooms == 5
    assert sorted(r.reason for r in rejected.collect()) == sorted([
        "unknown area", "unknown area", "unknown property_type", "unknown property_type", "size_sqft out of range",
        "size_sqft missing", "size_sqft out of range", "bedrooms out of range", "building_age_years out of range",
        "floor out of range"])


def test_price_must_be_positive(spark):
    df = ask(spark, ("North Gate",), ("North Gate",), ("North Gate",)).withColumn(
        "price_aed_month", F.when(F.monotonically_increasing_id() == 0, 0.0))
    _, rejected = requests.prepare_requests(df, default_areas(spark), default_types(spark))
    assert [r.reason for r in rejected.collect()] == ["price_aed_month not positive"] * 3


def test_half_the_fair_price_is_suspicious(spark):
    df = spark.createDataFrame([(1, 4500.0, 9000.0), (2, 9000.0, 9000.0), (3, 12000.0, 9000.0)],
                               "id int, price_aed_month double, raw_prediction double")
    rows = requests.judge_requests(df).orderBy("id").collect()
    assert [(r.residual_pct, r.flag, r.suspicious) for r in rows] == [
        (-0.5, "underpriced", True), (0.0, "fair", False), (0.3333, "overpriced", False)]


def test_requests_agree_with_the_grid_and_grow_with_size(spark, fitted):
    areas, types = default_areas(spark), default_types(spark)
    grid = requests.fair_value_grid(areas, types, fitted.model).cache()
    point = grid.where("area = 'Tannery Row' AND property_type = 'Duplex' AND furnished = 1").first()
    df = ask(spark, ("Tannery Row", "Duplex", float(point.size_sqft), None, True)).withColumn(
        "price_aed_month", F.lit(9000.0))
    valid, _ = requests.prepare_requests(df, areas, types)
    scored = requests.score_requests(valid, fitted.model).first()
    assert scored.predicted_price_aed_month == point.predicted_price_aed_month
    ends = grid.where("area = 'North Gate' AND furnished = 0 AND property_type = 'Farmhouse'").agg(
        F.min_by("predicted_price_aed_month", "size_sqft"), F.max_by("predicted_price_aed_month", "size_sqft")).first()
    assert ends[1] > ends[0]


def test_grid_interpolation_and_clamping(spark):
    grid = spark.createDataFrame([("A", "T", 0, 100, 1000.0), ("A", "T", 0, 200, 3000.0)],
                                 "area string, property_type string, furnished int, size_sqft int, "
                                 "predicted_price_aed_month double")
    asked = spark.createDataFrame([(s, "A", "T", 0, s) for s in (50.0, 100.0, 150.0, 175.0, 200.0, 999.0)]
                                  + [(1.0, "B", "T", 0, 150.0)],
                                  "id double, area string, property_type string, furnished int, size_sqft double")
    got = {(r.area, r.id): r.estimate for r in requests.interpolate_grid(asked, grid).collect()}
    assert got == {("A", 50.0): 1000.0, ("A", 100.0): 1000.0, ("A", 150.0): 2000.0, ("A", 175.0): 2500.0,
                   ("A", 200.0): 3000.0, ("A", 999.0): 3000.0, ("B", 1.0): None}


def test_interpolation_between_all_neighbours(spark):
    """Uneven sizes, several prices of one size, requests without a size or key, next to a plain version."""
    rng = random.Random(4)
    key = ("A", "T", 0)
    points = [(*key, rng.choice([rng.randrange(100), 10 ** rng.randrange(7)]), float(rng.randrange(1000, 9000))) for _ in range(60)]
    points += [("B", "T", 1, 70, 500.0), ("B", "T", 1, 70, 900.0), ("B", "T", 1, None, 1.0)]
    sizes = [float(p[3]) for p in points[:60]] + [rng.uniform(-5, 2e6) for _ in range(200)] + [rng.uniform(0, 100) for _ in range(200)]
    asked = [(i, *key, s) for i, s in enumerate(sizes)]
    asked += [(900, *key, None), (901, "B", "T", 1, 69.0), (902, "B", "T", 1, 70.0), (903, "B", "T", 1, 71.0), (904, None, "T", 0, 5.0)]
    kind = "area string, property_type string, furnished int, size_sqft"
    got = requests.interpolate_grid(
        spark.createDataFrame(asked, f"low int, {kind} double"),
        spark.createDataFrame(points, f"{kind} int, predicted_price_aed_month double"))
    assert got.columns == ["low", "area", "property_type", "furnished", "size_sqft", "estimate"]
    curve = sorted((p[3], p[4]) for p in points[:60])
    want = {900: None, 901: 500.0, 902: 900.0, 903: 900.0, 904: None}
    for i, *_, s in asked[:460]:
        below, above = [p for p in curve if p[0] <= s], [p for p in curve if p[0] >= s]
        low, high = (below or above[:1])[-1], (above or below[-1:])[0]
        step = (s - low[0]) / (high[0] - low[0]) if high[0] > low[0] else 0.0
        want[i] = low[1] + step * (high[1] - low[1])
    rows = got.collect()
    assert len(rows) == len(asked)
    for r in rows:
        assert r.estimate == want[r.low] if want[r.low] is None else abs(r.estimate - want[r.low]) <= 0.5 + 1e-6


# ---- streaming ----

def test_stream_gives_the_rows_of_the_batch(spark, market, fitted):
    arrived, out = work_path(spark, "arrived"), work_path(spark, "feed")
    checkpoint, progress = work_path(spark, "feed-checkpoint"), work_path(spark, "progress")
    market.where("listing_id < 500").write.parquet(arrived)

    def run():
        stream = scoring.arriving_listings(spark, arrived, market.schema, max_files=1)
        query = scoring.write_feed(scoring.score_stream(stream, fitted.model), out, checkpoint)
        scoring.run_feed(spark, query, progress)

    run()
    took = scoring.batch_durations(spark, progress)
    assert took.agg(F.sum("n_rows")).first()[0] == 500
    assert took.where("latency_ms < scoring_ms or scoring_ms <= 0 or started > now()").count() == 0
    market.where("listing_id >= 500").write.mode("append").parquet(arrived)
    run()  # only the files that arrived since
    took = scoring.batch_durations(spark, progress)
    assert took.agg(F.sum("n_rows")).first()[0] == market.count() and took.select("run_id").distinct().count() == 2
    got = spark.read.parquet(out).orderBy("listing_id").collect()
    want = scoring.score_stream(market, fitted.model).orderBy("listing_id").collect()
    assert got == want and len(got) == market.count()


def test_every_micro_batch_keeps_its_duration(spark, market):
    """More micro-batches than the progress that Spark keeps, written in several parts."""
    arrived, progress = work_path(spark, "arrived"), work_path(spark, "progress")
    rows = market.limit(330).withColumn("raw_prediction", F.lit(5000.0))
    rows.repartition(103).write.parquet(arrived)
    n_files = len(spark.read.parquet(arrived).inputFiles())
    stream = scoring.arriving_listings(spark, arrived, rows.schema, max_files=1)
    query = scoring.write_feed(scoring.judge_feed(stream), work_path(spark, "feed"), work_path(spark, "checkpoint"))
    scoring.run_feed(spark, query, progress, held=40)
    took = scoring.batch_durations(spark, progress)
    assert n_files > 100 and sorted(r.batch_id for r in took.collect()) == list(range(n_files))
    assert took.agg(F.sum("n_rows")).first()[0] == 330
    assert len(took.inputFiles()) > 1


def test_feed_band_uses_the_unrounded_gap(spark):
    row = listing(1, price_aed_month=7000)
    df = listings(spark, row).withColumn("raw_prediction", F.lit(9999.7))
    got = scoring.judge_feed(df).first()
    assert (got.predicted_price_aed_month, got.residual_pct, got.flag) == (10000, -0.3, "fair")
