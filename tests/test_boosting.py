"""Trees from shared histograms next to Spark's own."""

import random

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from builders import listing, listings
from listingflow.operators import boosting, model
from listingflow.session import materialize


def rows_of(spark, n, **changes):
    rng = random.Random(9)
    rows = []
    for i in range(n):
        size, age, floor, area = rng.randint(50, 150) * 10, rng.randint(0, 40), rng.randint(0, 30), rng.randrange(4)
        price = size * (5 + area) + 40 * floor - 25 * age + rng.randint(0, 997)
        rows.append(listing(i, area=f"Area {area}", property_type=f"Type {rng.randrange(3)}", bedrooms=rng.randint(0, 5), size_sqft=size,
                            building_age_years=age, floor=floor, furnished=rng.randint(0, 1), price_aed_month=price,
                            **{name: f(i) for name, f in changes.items()}))
    return listings(spark, *rows)


def vectors_of(df):
    encoder = model.fit_encoder(df)
    return encoder, materialize(model.with_vectors(encoder, df), "vectors")


def test_same_trees_as_spark(spark):
    """On columns with fewer values than bins the thresholds are the same, and without draws so are the trees."""
    params = model.ModelParams(rounds=30, step=0.2, subsample=1.0)
    encoder, vectors = vectors_of(rows_of(spark, 1200))
    ours = model.fit_vectors(vectors, 1200, encoder, params)
    theirs = PipelineModel([*encoder.stages, model.booster(params).fit(vectors)])
    a, b = ({r.listing_id: r.raw_prediction for r in m.stages[-1].transform(vectors).collect()} for m in (ours, theirs))
    assert all(a[i] == pytest.approx(b[i], rel=1e-6) for i in b) and len(a) == 1200
    assert ours.stages[-1].featureImportances.toArray() == pytest.approx(theirs.stages[-1].featureImportances.toArray(), abs=1e-6)
    assert ours.stages[-1].treeWeights == theirs.stages[-1].treeWeights


def test_fits_share_their_passes(spark):
    """A round is one job per level, however many models are fitted."""
    df = rows_of(spark, 400)
    jobs = []
    for rounds in (3, 5):
        group = f"fits-{rounds}"
        spark.sparkContext.setJobGroup(group, "")
        model.score_out_of_fold(df, df, None, params=model.ModelParams(rounds=rounds))
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[1] - jobs[0] == 2 * model.ModelParams().depth


def test_predictions_worked_out_again_are_the_same(spark, monkeypatch):
    params = model.ModelParams(rounds=7, step=0.3)
    encoder, vectors = vectors_of(rows_of(spark, 500))
    found = []
    for rebase in (2, 25):
        monkeypatch.setattr(boosting, "REBASE", rebase)
        fitted = model.fit_vectors(vectors, 500, encoder, params).stages[-1]
        found.append({r.listing_id: r.raw_prediction for r in fitted.transform(vectors).collect()})
    assert all(found[0][i] == pytest.approx(found[1][i], rel=1e-9) for i in found[1])


def test_blocks_of_any_size_hold_all_rows(spark, monkeypatch):
    """Without draws the trees do not depend on how the rows are packed."""
    params = model.ModelParams(rounds=5, step=0.3, subsample=1.0)
    encoder, vectors = vectors_of(rows_of(spark, 500))
    one = model.fit_vectors(vectors, 500, encoder, params).stages[-1].transform(vectors)
    monkeypatch.setattr(model, "ROWS_PER_TASK", 70)
    many = model.fit_vectors(vectors.repartition(7), 500, encoder, params).stages[-1].transform(vectors)
    both = one.select("listing_id", F.col("raw_prediction").alias("a")).join(many, "listing_id").where(
        F.abs(F.col("a") - F.col("raw_prediction")) > 1e-6 * F.abs("a"))
    assert both.isEmpty()


def test_missing_numbers_and_labels(spark):
    """A missing number goes with the largest one, as in Spark's trees; a missing price is an error."""
    none = {"floor": lambda i: None if i % 3 == 0 else i % 7, "building_age_years": lambda i: None}
    rng = random.Random(2)
    df = listings(spark, *(listing(i, size_sqft=rng.randint(300, 900), **{n: f(i) for n, f in none.items()},
                                   price_aed_month=9000 if i % 3 == 0 or i % 7 == 6 else 5000) for i in range(120)))
    encoder, vectors = vectors_of(df)
    fitted = model.fit_vectors(vectors, 120, encoder, model.ModelParams(rounds=3, subsample=1.0)).stages[-1]
    assert {(r.price_aed_month, round(r.raw_prediction)) for r in fitted.transform(vectors).collect()} == {(9000, 9000), (5000, 5000)}
    with pytest.raises(Exception, match="Labels MUST NOT be"):
        model.fit(df.withColumn("price_aed_month", F.when(F.col("listing_id") > 3, F.col("price_aed_month"))))
    with pytest.raises(ValueError):
        model.fit_vectors(vectors.limit(0), 0, encoder)


def test_columns_are_counted_together(monkeypatch):
    """A block is counted once for a group of columns, and each column gets the sums that it has alone."""
    rng = np.random.default_rng(3)
    widths, n, calls = [8, 128, 24, 44, 3, 128, 26, 8], 900, []
    bins = np.stack([rng.integers(0, w, n) for w in widths]).astype("u1")
    left, tree = rng.normal(size=n), boosting.Tree.empty(3)
    tree.column[:3], tree.place[:3] = [1, 6, 3], [60, 4, 20]
    plain = np.bincount
    monkeypatch.setattr(np, "bincount", lambda *a, **k: calls.append(1) or plain(*a, **k))
    (found,) = boosting._histograms(iter([(0, (0, 1), bins, left)]), [tree], 2, 1, widths, 6, 0.85, 42)
    assert len(calls) < len(widths)
    drawn = np.random.default_rng([42, 1, 0, 1]).random(n, dtype=np.float32) < 0.85
    node = boosting._nodes(bins, tree, 2, 6)
    for c, end in enumerate(np.cumsum(widths)):
        for k in range(4):
            rows = drawn & (node == k)
            sums = found[0][:, k, end - widths[c] : end]
            assert (sums[0] == plain(bins[c][rows], minlength=widths[c])).all()
            assert sums[1] == pytest.approx(plain(bins[c][rows], 2 * left[rows], minlength=widths[c]))


def test_wide_columns_are_counted_alone():
    assert sorted(map(sorted, boosting._groups([9000, 5000, 2, 2]))) == [[0], [1], [2, 3]]


def test_quantiles_only_of_numbers_with_many_values(spark):
    rows = spark.range(4000).select(
        F.col("id").cast("double").alias("x0"), (F.col("id") % 150).cast("double").alias("x1"),
        (F.col("id") % 3).cast("double").alias("x2"), F.lit(None).cast("double").alias("x3"))
    many, near, few, none = boosting._thresholds(rows, boosting.Layout(4, ()), 128)
    assert len(many) == 127 and 100 < len(near) <= 127 and list(few) == [0.5, 1.5] and not len(none)


def test_written_places_spare_the_vectors(spark):
    """Fits on rows that were spread before they were written never read a vector."""
    encoder, vectors = vectors_of(rows_of(spark, 300))
    params = model.ModelParams(rounds=3, subsample=1.0)
    spread = materialize(boosting.spread(vectors, model._layout(encoder)).drop("features"), "spread")
    a, b = (model.fit_vectors(rows, 300, encoder, params).stages[-1] for rows in (vectors, spread))
    assert a.toDebugString.split("\n")[1:] == b.toDebugString.split("\n")[1:]
