"""The registered queries: each operator bound to the driver's tables.

Every binding reads the whole tables. Doubles are rounded and dates given as text, so that results compare by value.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listingflow import fixtures as fx
from listingflow.functions import columns as c
from listingflow.functions.columns import dbl
from listingflow.operators import evaluate, model, quality, requests, review, sampling, textweights
from listingflow.operators.components import connected_components
from listingflow.operators.dedup import (
    Duplicates, MatchConfig, assign_clusters, block_sizes, find_duplicates, gated_pairs, score_pairs,
)
from listingflow.plans import analytics, load
from listingflow.session import materialize, work_path
from listingflow.sources.listings import read_listings, write_records
from listingflow.sources.schema import LISTING_SCHEMA, SCHEMA_VERSION, STAGING_COLUMNS
from listingflow.sources.store import Warehouse, open_warehouse, write_all
from listingflow.streaming import scoring

Query = Callable[[SparkSession, str], DataFrame]

LOAD_TIMES = tuple(datetime(2026, 1, day, 6, 0, 0, tzinfo=timezone.utc) for day in (1, 2, 3, 4))

_shared: dict = {}


def _once(spark: SparkSession, sf_dir: str, name: str, build: Callable):
    """Stages that several queries start from are built once per application."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _shared:
        _shared[key] = build()
    return _shared[key]


def _r(col, digits: int = 4) -> Column:
    return F.round(F.col(col) if isinstance(col, str) else col, digits)


def _text(col: str) -> Column:
    return F.col(col).cast("string").alias(col)


# ---- shared stages -------------------------------------------------------------------------------------------


def _listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.listings(spark, sf_dir)


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.scored(spark, sf_dir)


def _scored_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scored listings off one written table, which costs their joins and their window once."""
    return _once(spark, sf_dir, "scored", lambda: materialize(_scored(spark, sf_dir), "scored"))


def _members(scored: DataFrame) -> DataFrame:
    return scored.where(F.col("dup_cluster_id").isNotNull()).select("listing_id", "dup_cluster_id")


def _found(spark: SparkSession, sf_dir: str) -> Duplicates:
    return _once(spark, sf_dir, "duplicates", lambda: find_duplicates(
        materialize(_listings(spark, sf_dir), "listings")
    ))


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _scored_once(spark, sf_dir)
    return model.clean_training_set(rows.drop("dup_cluster_id"), _members(rows), evaluate.naive_price_flag(rows))


def _fitted(spark: SparkSession, sf_dir: str) -> model.FittedModel:
    return _once(spark, sf_dir, "model", lambda: model.fit_price_model(_clean(spark, sf_dir)))


def _model(spark: SparkSession, sf_dir: str) -> PipelineModel:
    return _fitted(spark, sf_dir).model


def _batches(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Three states of the feed: up to 1998; everything, with one agent's rows withdrawn and prices cut in one
    area; everything again."""
    rows = _scored_once(spark, sf_dir)
    cut = F.when(F.col("area") == "NATION_7", F.col("price_aed_month") - 500).otherwise(F.col("price_aed_month"))
    return [
        rows.where(F.col("listed_date") < F.lit("1999-01-01").cast("date")),
        rows.where(F.col("agent_name") != "Agent 3").withColumn("price_aed_month", cut.cast("int")),
        rows,
    ]


def _load(spark: SparkSession, path: str, batch: DataFrame, now: datetime) -> load.LoadResult:
    return load.load_batch(spark, path, batch.drop("dup_cluster_id"), _members(batch), now=now)


def _loads(spark: SparkSession, sf_dir: str) -> list[load.LoadResult]:
    """The three batches loaded in order, then the last one once more."""
    def build() -> list[load.LoadResult]:
        path = work_path(spark, "warehouse")
        batches = _batches(spark, sf_dir)
        return [_load(spark, path, b, t) for b, t in zip([*batches, batches[-1]], LOAD_TIMES)]
    return _once(spark, sf_dir, "loads", build)


def _warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """A warehouse with the whole scored table loaded once."""
    return _once(spark, sf_dir, "warehouse", lambda: _load(
        spark, work_path(spark, "warehouse"), _scored(spark, sf_dir), LOAD_TIMES[0]
    ).warehouse)


def _facts(warehouse: Warehouse) -> DataFrame:
    """Facts with their natural keys and load days."""
    return (
        warehouse.table("fact_listings")
        .join(warehouse.table("dim_area"), "area_id")
        .join(warehouse.table("dim_property_type"), "property_type_id")
        .join(warehouse.table("dim_agent"), "agent_id")
        .join(warehouse.table("dim_date"), "date_id")
        .select(
            "listing_id", F.col("area_name").alias("area"), "property_type", "agent_name",
            F.col("full_date").cast("string").alias("listed_date"), "price_aed_month",
            _r("residual_pct").alias("residual_pct"), F.coalesce("dup_cluster_id", F.lit("")).alias("dup_cluster_id"),
            "is_duplicate", "is_flagged_fraud", "is_active",
            F.date_format("first_loaded_at", "yyyy-MM-dd").alias("first_loaded"),
            F.date_format("last_updated_at", "yyyy-MM-dd").alias("last_updated"),
        )
    )


# ---- sources and sinks ---------------------------------------------------------------------------------------


def _read_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _listings(spark, sf_dir).withColumn("status", F.lit("active"))
    path = work_path(spark, "csv")
    names = [field.split()[0] for field in LISTING_SCHEMA.split(", ")]
    rows.select(*names).write.csv(path, header=True, escape='"')
    return read_listings(spark, path).withColumn("listed_date", _text("listed_date"))


def _staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _scored(spark, sf_dir)
    staged = load.build_staging(rows.drop("dup_cluster_id"), _members(rows))
    return staged.select(
        *[name for name in STAGING_COLUMNS if name not in ("listed_date", "dup_cluster_id", "residual_pct")],
        _text("listed_date"), _r("residual_pct").alias("residual_pct"),
        F.coalesce("dup_cluster_id", F.lit("")).alias("dup_cluster_id"),
    )


def _warehouse_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = _warehouse(spark, sf_dir)
    path = work_path(spark, "warehouse-copy")
    write_all(spark, path, source.tables())
    return _facts(open_warehouse(spark, path))


def _save_load_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "model")
    model.save_model(_model(spark, sf_dir), path)
    return model.score_all(model.load_model(path), _listings(spark, sf_dir)).select(
        "listing_id", "predicted_price_aed_month", "residual_pct"
    )


def _write_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "records")
    write_records(model.flagged_listings(_scored(spark, sf_dir)).select(
        "listing_id", "title", "area", "price_aed_month", _r("residual_pct").alias("residual_pct")), path)
    schema = "listing_id bigint, title string, area string, price_aed_month int, residual_pct double"
    return spark.read.schema(schema).json(path)


def _run_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = analytics.run_all(_warehouse(spark, sf_dir))
    out = None
    for i, result in enumerate(results, 1):
        row = result.rows.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(i).alias("position"), F.lit(result.name).alias("name"), F.lit(result.title).alias("title"), "n_rows"
        )
        out = row if out is None else out.unionByName(row)
    return out


# ---- projections ---------------------------------------------------------------------------------------------


def _flat_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _listings(spark, sf_dir)
    first = rows.select(F.col("listing_id").alias("dup_group_truth"), F.col("lat").alias("lat0"),
                        F.col("lon").alias("lon0"))
    return rows.join(first, "dup_group_truth").select(
        "listing_id",
        _r(c.flat_distance("lat", "lon", "lat0", "lon0"), 2).alias("distance_m"),
        _r(c.flat_distance("lat", "lon", "lat0", "lon0", "km"), 4).alias("distance_km"),
    )


def _date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [col.alias(name) for name, col in c.date_parts().items()]
    return _listings(spark, sf_dir).select("listing_id", *parts, c.date_key().alias("date_id"))


def _month_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _date_parts(spark, sf_dir).select("listing_id", c.month_label().alias("month"))


def _row_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hash of every staged row, over all its columns."""
    rows = _scored(spark, sf_dir)
    return load.build_staging(rows.drop("dup_cluster_id"), _members(rows)).select("listing_id", "row_hash")


def _add_residuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _scored(spark, sf_dir).withColumn("raw_prediction", F.col("predicted_price_aed_month") + F.lit(0.25))
    return c.add_residuals(rows.drop("residual_pct", "predicted_price_aed_month")).select(
        "listing_id", "predicted_price_aed_month", "residual_aed", "residual_pct"
    )


def _nan_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    broken = F.when(F.col("furnished") == 1, F.lit(float("nan"))).otherwise(F.col("lat"))
    rows = _listings(spark, sf_dir).select("listing_id", broken.alias("lat"), "lon")
    return c.nan_to_null(rows).select("listing_id", F.coalesce("lat", F.lit(-1.0)).alias("lat"), "lon")


# ---- duplicates ----------------------------------------------------------------------------------------------


def _block_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_sizes(_listings(spark, sf_dir)).withColumn("n_pairs", F.col("n_pairs").cast("bigint"))


def _gates(**open_gates) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return gated_pairs(_listings(spark, sf_dir), MatchConfig(**open_gates)).select(
            "id_a", "id_b", _r("price_similarity", 6).alias("price_similarity"),
            _r("size_similarity", 6).alias("size_similarity"),
        )
    return run


def _tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _listings(spark, sf_dir).withColumn("text", c.listing_text())
    return textweights.block_tfidf(rows, MatchConfig.block).withColumn("weight", _r("weight"))


def _tfidf_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long texts in several languages, weighted inside each language."""
    rows = fx.table(spark, sf_dir, "documents")
    return textweights.block_tfidf(rows, ["lang"], key="doc_id").withColumn("weight", _r("weight"))


def _with_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _listings(spark, sf_dir).withColumn("text", c.listing_text())
    vectors = textweights.block_vectors(rows, MatchConfig.block)
    return textweights.cosine_pairs(gated_pairs(_listings(spark, sf_dir), vectors=vectors), vectors)


def _cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_similarity(spark, sf_dir).select("id_a", "id_b", _r("text_similarity").alias("text_similarity"))


def _crowded(**open_gates) -> Query:
    """Cluster map of the listings made hard, in every branch of the search."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = materialize(fx.crowded(spark, sf_dir), "crowded")
        return find_duplicates(rows, MatchConfig(hot_rows=50, **open_gates)).members
    return run


def _assign_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    members, clusters = assign_clusters(connected_components(_found(spark, sf_dir).links))
    return members.join(clusters, F.col("dup_cluster_id") == F.col("cluster_id")).select(
        "listing_id", "cluster_id", "n_members", "first_id", "last_id"
    )


def _cluster_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = review.review_members(_listings(spark, sf_dir), _found(spark, sf_dir))
    return rows.select("cluster_id", "n_members", "listing_id", "title", "area", "price_aed_month", "size_sqft",
                       _text("listed_date"))


def _cluster_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = review.cluster_sample(_listings(spark, sf_dir), _found(spark, sf_dir))
    return rows.select(
        "cluster_id", "n_members", "clusters_total", F.explode("members").alias("m"),
        F.size("pair_scores").cast("bigint").alias("n_pairs"),
    ).select("cluster_id", "n_members", "clusters_total", "n_pairs", "m.listing_id", "m.title", "m.price_aed_month")


# ---- evaluation ----------------------------------------------------------------------------------------------


def _truth_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = evaluate.group_pairs(_listings(spark, sf_dir), "dup_group_truth")
    return rows.withColumn("n_pairs", F.col("n_pairs").cast("bigint"))


def _cluster_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = evaluate.group_pairs(_found(spark, sf_dir).members, "dup_cluster_id")
    return rows.withColumn("n_pairs", F.col("n_pairs").cast("bigint"))


def _pair_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = model.with_clusters(_listings(spark, sf_dir), _found(spark, sf_dir).members)
    out = evaluate.pair_metrics(labelled)
    whole = [f.name for f in out.schema.fields if f.dataType.typeName() == "decimal"]
    return out.select(*[F.col(n).cast("bigint").alias(n) if n in whole else F.col(n) for n in out.columns])


def _naive_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.naive_price_flag(_listings(spark, sf_dir))


def _flag_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _scored(spark, sf_dir).select(
        (F.col("residual_pct") <= -0.25).cast("int").alias("flag"), F.col("is_suspicious_truth").alias("truth")
    )
    return evaluate.flag_metrics(rows)


# ---- model and requests --------------------------------------------------------------------------------------


def _clean_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clean(spark, sf_dir).select("listing_id", F.coalesce("dup_cluster_id", F.lit("")).alias("dup_cluster_id"))


def _split(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = model.train_test_split(_listings(spark, sf_dir))
    return train.select("listing_id", F.lit("train").alias("part")).unionByName(
        test.select("listing_id", F.lit("test").alias("part"))
    )


def _feature_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = model.encoded_features(_model(spark, sf_dir), _listings(spark, sf_dir))
    numbers = len(model.NUMERIC_FEATURES)
    hot = F.aggregate(F.slice("features", numbers + 1, F.size("features") - numbers), F.lit(0.0), lambda a, v: a + v)
    return rows.select("listing_id", F.size("features").alias("n_features"), hot.cast("int").alias("n_hot"),
                       F.element_at("features", 2).cast("int").alias("size_sqft"))


def _regression_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.regression_metrics(_scored(spark, sf_dir), "price_aed_month", "predicted_price_aed_month")


def _importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    fitted = _model(spark, sf_dir)
    return model.feature_importances(fitted, fitted.transform(model.with_distance(_listings(spark, sf_dir))))


def _score_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.score_all(_model(spark, sf_dir), _listings(spark, sf_dir)).select(
        "listing_id", "price_aed_month", "predicted_price_aed_month", "residual_aed", "residual_pct"
    )


# ---- what SQL can say about the results of a fitted model


def _identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per listing: the residuals are those of its prediction, and the saved model predicts the same."""
    again = _save_load_model(spark, sf_dir).select("listing_id", F.col("predicted_price_aed_month").alias("again"))
    gap = F.col("price_aed_month") - F.col("predicted_price_aed_month")
    return _score_all(spark, sf_dir).join(again, "listing_id").select(
        "listing_id", "price_aed_month",
        (F.col("residual_aed") == gap).alias("absolute_holds"),
        (F.abs(F.col("residual_pct") - gap / F.col("predicted_price_aed_month")) <= 0.00005001).alias("relative_holds"),
        (F.col("again") == F.col("predicted_price_aed_month")).alias("same_after_reload"),
    )


def _quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fitted(spark, sf_dir).metrics.select("n_train", "n_test", (F.col("r2") > 0.9).alias("good"))


def _heldout_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fitted(spark, sf_dir).heldout.select(
        "listing_id", "actual", "area", (F.abs(F.col("predicted") / F.col("actual") - 1) < 1).alias("near"))


def _importance_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _importances(spark, sf_dir)
    return rows.agg(
        F.count(F.lit(1)).alias("n_features"), (F.abs(F.sum("importance") - 1) < 0.001).alias("sum_is_one"),
        F.max_by("feature", "importance").alias("first"),
    )


def _out_of_fold_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per fold: rows, units, units that are in another fold too, and whether the mean error is small."""
    rows = _out_of_fold(spark, sf_dir).join(_scored(spark, sf_dir).select("listing_id", c.unit_key().alias("unit")), "listing_id")
    by_unit = rows.groupBy("unit").agg(F.countDistinct("fold").alias("folds"))
    return rows.join(by_unit, "unit").groupBy("fold").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("unit").alias("n_units"),
        F.count_if(F.col("folds") > 1).alias("n_elsewhere"), (F.avg(F.abs("residual_pct")) < 0.25).alias("good"),
    )


def _grid_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fair_value_grid(spark, sf_dir).select(
        "area", "property_type", "size_sqft", "furnished", (F.col("predicted_price_aed_month") > 0).alias("priced"))


def _stream_is_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["listing_id", "predicted_price_aed_month", "residual_pct", "flag"]
    batch = scoring.score_stream(_listings(spark, sf_dir), _model(spark, sf_dir)).select(*columns).alias("b")
    both = _score_stream(spark, sf_dir).select(*columns).alias("s").join(batch, "listing_id")
    same = [F.col(f"s.{n}").eqNullSafe(F.col(f"b.{n}")) for n in columns[1:]]
    return both.select("listing_id", (same[0] & same[1] & same[2]).alias("same"))


def _request_identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per scored request: the flag is that of the relative gap, and the suspicion too."""
    gap = F.col("residual_pct")
    band = F.when(gap <= -0.3, "underpriced").when(gap >= 0.3, "overpriced").otherwise("fair")
    return _score_requests(spark, sf_dir).select(
        "listing_id", (F.col("flag") == band).alias("flag_holds"), (F.col("suspicious") == (gap <= -0.3)).alias("suspicion_holds"))


def _folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.group_folds(_scored(spark, sf_dir)).select("listing_id", "fold")


def _out_of_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _scored_once(spark, sf_dir)
    raw = rows.drop("dup_cluster_id", "predicted_price_aed_month", "residual_pct", "title", "description")
    out = _once(spark, sf_dir, "out-of-fold", lambda: materialize(
        model.score_out_of_fold(raw, _clean(spark, sf_dir), _members(rows)), "out-of-fold"))
    return out.select("listing_id", "fold", "predicted_price_aed_month", "residual_aed", "residual_pct")


def _areas_and_types(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = _listings(spark, sf_dir)
    return requests.area_table(rows), requests.type_table(rows)


def _grid_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests.grid_points(*_areas_and_types(spark, sf_dir))


def _fair_value_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests.fair_value_grid(*_areas_and_types(spark, sf_dir), _model(spark, sf_dir))


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings as requests: furnished ones without bedrooms, new buildings without floor, one agent's for an
    unknown area."""
    return _scored(spark, sf_dir).select(
        "listing_id",
        F.when(F.col("agent_name") == "Agent 5", "Atlantis").otherwise(F.col("area")).alias("area"), "property_type",
        F.col("size_sqft").cast("double").alias("size_sqft"),
        F.when(F.col("furnished") == 0, F.col("bedrooms")).alias("bedrooms"), "furnished",
        F.lit(None).cast("int").alias("building_age_years"),
        F.when(F.col("building_age_years") >= 6, F.col("floor")).alias("floor"),
        F.col("price_aed_month").cast("double").alias("price_aed_month"), "predicted_price_aed_month",
    )


def _prepare_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = _requests(spark, sf_dir)
    number = F.col("listing_id")
    # One fault of each kind, some in the same row.
    faults = {
        "property_type": F.when(number % 101 == 1, "Castle"), "size_sqft": F.when(number % 103 == 2, dbl(-5.0)),
        "bedrooms": F.when(number % 109 == 4, 11), "building_age_years": F.when(number % 113 == 5, 101),
        "floor": F.when(number % 127 == 6, 201), "price_aed_month": F.when(number % 131 == 7, dbl(0.0)),
    }
    asked = asked.select(*(F.coalesce(faults[n], F.col(n)).alias(n) if n in faults else n for n in asked.columns))
    asked = asked.withColumn("size_sqft", F.when(number % 107 != 3, F.col("size_sqft")))
    valid, rejected = requests.prepare_requests(asked, *_areas_and_types(spark, sf_dir))
    filled = ["listing_id", "area", "property_type", "size_sqft", "bedrooms", "furnished", "building_age_years",
              "floor", "lat", "lon"]
    none = F.lit(-1)
    return valid.select(*filled, F.lit("").alias("reason")).unionByName(rejected.select(
        "listing_id", "area", "property_type", F.coalesce("size_sqft", F.lit(-1.0)).alias("size_sqft"),
        none.alias("bedrooms"), "furnished", none.alias("building_age_years"), none.alias("floor"), F.lit(-1.0).alias("lat"), F.lit(-1.0).alias("lon"),
        "reason",
    ))


def _judge_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _requests(spark, sf_dir).withColumn("raw_prediction", F.col("predicted_price_aed_month") + F.lit(0.4))
    return requests.judge_requests(rows.drop("predicted_price_aed_month")).select(
        "listing_id", "predicted_price_aed_month", "residual_aed", "residual_pct", "flag",
        F.col("suspicious").cast("int").alias("suspicious"),
    )


def _score_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, _ = requests.prepare_requests(
        _requests(spark, sf_dir).drop("predicted_price_aed_month"), *_areas_and_types(spark, sf_dir)
    )
    return requests.score_requests(valid, _model(spark, sf_dir)).select(
        "listing_id", "predicted_price_aed_month", "residual_aed", "residual_pct", "flag", "suspicious"
    )


def _interpolate(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.bround(F.col("size_sqft") * 7.5 + F.length("area") * 100 + F.col("furnished") * 250, 0)
    grid = _grid_points(spark, sf_dir).withColumn("predicted_price_aed_month", price)
    asked = _listings(spark, sf_dir).select(
        "listing_id", "area", "property_type", "furnished", (F.col("size_sqft") * 1.1 - 100).alias("size_sqft")
    )
    return requests.interpolate_grid(asked, grid).select("listing_id", "estimate")


def _flagged(n: int | None) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return model.flagged_listings(_scored(spark, sf_dir), n=n).select(
            "listing_id", "area", "price_aed_month", _r("residual_pct").alias("residual_pct")
        )
    return run


# ---- warehouse loads -----------------------------------------------------------------------------------------


def _upsert_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = _loads(spark, sf_dir)[1].warehouse
    out = warehouse.table("dim_date").select(
        F.lit("dim_date").alias("dimension"), F.col("date_id").cast("bigint").alias("id"),
        F.col("full_date").cast("string").alias("member"),
    )
    for name, id_column, key, _ in load.MEMBER_DIMENSIONS:
        out = out.unionByName(warehouse.table(name).select(
            F.lit(name).alias("dimension"), F.col(id_column).alias("id"), F.col(key).alias("member")
        ))
    return out


def _classify_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = _batches(spark, sf_dir)[1]
    staged = load.build_staging(batch.drop("dup_cluster_id"), _members(batch))
    return load.classify_changes(_loads(spark, sf_dir)[0].warehouse.table("fact_listings"), staged)


def _facts_after(n: int) -> Query:
    return lambda spark, sf_dir: _facts(_loads(spark, sf_dir)[n - 1].warehouse)


def _soft_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _facts(_loads(spark, sf_dir)[1].warehouse).where(F.col("is_active") == 0).select(
        "listing_id", "agent_name", "first_loaded", "last_updated"
    )


def _audit_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loads(spark, sf_dir)[3].warehouse.table("etl_runs").select(
        "run_id", F.date_format("started_at", "yyyy-MM-dd").alias("started"), "rows_in_batch", "rows_inserted",
        "rows_updated", "rows_unchanged", "rows_deactivated", "rows_rejected",
    )


def _ensure_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _warehouse(spark, sf_dir).path
    counts = [
        load.table_counts(open_warehouse(spark, path, version)).withColumn("schema_version", F.lit(version))
        for version in (SCHEMA_VERSION, SCHEMA_VERSION + 1)
    ]
    return counts[0].unionByName(counts[1])


def _analytical(name: str) -> Query:
    return lambda spark, sf_dir: analytics.run_query(_warehouse(spark, sf_dir), name)[1]


# ---- streaming -----------------------------------------------------------------------------------------------


def _score_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _listings(spark, sf_dir)
    arrived, out = work_path(spark, "arrived"), work_path(spark, "feed")
    rows.write.parquet(arrived)
    stream = scoring.arriving_listings(spark, arrived, rows.schema)
    feed = scoring.score_stream(stream, _model(spark, sf_dir))
    scoring.write_feed(feed, out, work_path(spark, "feed-checkpoint")).awaitTermination()
    return spark.read.schema(feed.schema).parquet(out).withColumn("listed_date", _text("listed_date"))


def _stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the stream's own progress says of its micro-batches, kept as a table while it runs."""
    rows = _scored(spark, sf_dir).withColumn("raw_prediction", F.col("predicted_price_aed_month"))
    arrived, progress = work_path(spark, "arrived"), work_path(spark, "progress")
    rows.write.parquet(arrived)
    feed = scoring.judge_feed(scoring.arriving_listings(spark, arrived, rows.schema, max_files=1))
    scoring.run_feed(
        spark, scoring.write_feed(feed, work_path(spark, "timed-feed"), work_path(spark, "timed-checkpoint")), progress
    )
    took = scoring.batch_durations(spark, progress)
    summary = sampling.latency_summary(took, "latency_ms")
    return took.agg(
        F.sum("n_rows").alias("n_rows"), (F.min("latency_ms") > 0).alias("all_timed"),
        (F.min(F.col("latency_ms") - F.col("scoring_ms")) >= 0).alias("within_trigger"),
        (F.count(F.lit(1)) == summary.select("events_scored").scalar()).alias("all_summed"),
    )


def _stream_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The band of the feed under a given prediction, through a stream."""
    rows = _scored(spark, sf_dir).withColumn("raw_prediction", F.col("predicted_price_aed_month") + F.lit(0.4))
    arrived, out = work_path(spark, "arrived"), work_path(spark, "bands")
    rows.write.parquet(arrived)
    feed = scoring.judge_feed(scoring.arriving_listings(spark, arrived, rows.schema))
    scoring.write_feed(feed, out, work_path(spark, "bands-checkpoint")).awaitTermination()
    return spark.read.schema(feed.schema).parquet(out).select(
        "listing_id", "predicted_price_aed_month", "residual_pct", "flag"
    )


def _sample_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = fx.table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    return sampling.systematic_sample(events, ["ts", "event_id"], "event_id").select(
        "position", "event_id", "event_type"
    )


def _sample_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _listings(spark, sf_dir).select("listing_id", "listed_date", "title")
    return sampling.systematic_sample(rows, ["listed_date", "listing_id"], "listing_id").select("position", "listing_id", "title")


def _latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.latency_summary(fx.table(spark, sf_dir, "events"), "value")


def _on(rows: Query, name: str, column: Callable[[], Column]) -> Query:
    """One column next to the id; the column is built when the query runs, since that needs a session."""
    return lambda spark, sf_dir: rows(spark, sf_dir).select("listing_id", column().alias(name))


def queries() -> dict[str, Query]:
    return {
        # sources and sinks
        "read_listings": _read_listings,
        "build_staging": _staging,
        "warehouse_tables": _warehouse_tables,
        "save_load_model": _save_load_model,
        "write_records": _write_records,
        "run_all": _run_all,
        # projections
        "listing_text": _on(_listings, "text", c.listing_text),
        "flat_distance": _flat_distance,
        "distance_to_center_km": _on(_listings, "distance_to_center_km", c.distance_to_center_km),
        "ratio_similarity": _on(_scored, "similarity", lambda: _r(
            c.ratio_similarity("price_aed_month", "predicted_price_aed_month"), 6)),
        "date_parts": _date_parts,
        "month_label": _month_label,
        "row_hash": _row_hash,
        "derive_flags": lambda spark, sf_dir: load.derive_flags(
            _listings(spark, sf_dir).join(_scored(spark, sf_dir).select("listing_id", "residual_pct"), "listing_id"),
            _members(_scored(spark, sf_dir)),
        ).select("listing_id", F.coalesce("dup_cluster_id", F.lit("")).alias("dup_cluster_id"), "is_duplicate",
                 "is_flagged_fraud"),
        "price_band": _on(_scored, "band", c.price_band),
        "annual_price_per_sqft": _on(_listings, "psf", lambda: _r(c.annual_price_per_sqft())),
        "project_review_fields": lambda spark, sf_dir: c.project_review_fields(
            _listings(spark, sf_dir)).withColumn("listed_date", _text("listed_date")),
        "add_residuals": _add_residuals,
        "nan_to_null": _nan_to_null,
        "unit_key": _on(_scored, "unit", c.unit_key),
        # duplicate detection
        "candidate_pairs": _block_sizes,
        "geo_gate": _gates(min_price_similarity=None, min_size_similarity=None),
        "price_gate": _gates(min_size_similarity=None),
        "size_gate": _gates(),
        "block_tfidf": _tfidf,
        "block_tfidf_documents": _tfidf_documents,
        "cosine_pairs": _cosine,
        "score_pairs": lambda spark, sf_dir: score_pairs(_with_similarity(spark, sf_dir)),
        "connected_components": lambda spark, sf_dir: connected_components(_found(spark, sf_dir).links),
        "assign_clusters": _assign_clusters,
        "find_duplicates_pairs": lambda spark, sf_dir: _found(spark, sf_dir).all_pairs,
        "find_duplicates_map": lambda spark, sf_dir: _found(spark, sf_dir).members,
        "crowded_map": _crowded(),
        "crowded_map_open_price": _crowded(min_price_similarity=None),
        "cluster_review_members": _cluster_review,
        "cluster_review_pairs": lambda spark, sf_dir: review.review_pairs(_found(spark, sf_dir)).select(
            "cluster_id", "n_members", "id_a", "id_b", "score"),
        "cluster_sample": _cluster_sample,
        # evaluation and quality
        "truth_pairs": _truth_pairs,
        "truth_links": lambda spark, sf_dir: evaluate.group_links(_listings(spark, sf_dir), "dup_group_truth"),
        "cluster_pairs": _cluster_pairs,
        "pair_metrics": _pair_metrics,
        "naive_price_flag": _naive_flags,
        "flag_metrics": _flag_metrics,
        "compare_fraud_methods": lambda spark, sf_dir: evaluate.compare_fraud_methods(
            _listings(spark, sf_dir), _scored(spark, sf_dir)),
        "field_completeness": lambda spark, sf_dir: quality.field_completeness(_listings(spark, sf_dir)),
        "exact_duplicates": lambda spark, sf_dir: quality.exact_duplicates(_listings(spark, sf_dir)),
        "total_rows": lambda spark, sf_dir: quality.total_rows(_listings(spark, sf_dir)),
        "invalid_prices": lambda spark, sf_dir: quality.invalid_prices(
            _listings(spark, sf_dir).withColumn("price_aed_month", F.col("price_aed_month") - 2000)),
        # model and requests
        "clean_training_set": _clean_rows,
        "train_test_split": _split,
        "feature_pipeline": _feature_pipeline,
        "fit_price_model": lambda spark, sf_dir: _fitted(spark, sf_dir).metrics,
        "regression_metrics": _regression_metrics,
        "heldout_predictions": lambda spark, sf_dir: _fitted(spark, sf_dir).heldout,
        "feature_importances": _importances,
        "score_all": _score_all,
        "model_identities": _identities,
        "model_quality": _quality,
        "heldout_rows": _heldout_rows,
        "importance_summary": _importance_summary,
        "out_of_fold_units": _out_of_fold_units,
        "grid_prices": _grid_prices,
        "request_identities": _request_identities,
        "stream_is_batch": _stream_is_batch,
        "group_folds": _folds,
        "score_out_of_fold": _out_of_fold,
        "grid_points": _grid_points,
        "fair_value_grid": _fair_value_grid,
        "prepare_requests": _prepare_requests,
        "judge_requests": _judge_requests,
        "score_requests": _score_requests,
        "interpolate_grid": _interpolate,
        "flagged_listings": _flagged(None),
        "flagged_listings_top": _flagged(25),
        # warehouse loads
        "upsert_dimension": _upsert_dimension,
        "classify_changes": _classify_changes,
        "upsert_facts": _facts_after(2),
        "soft_delete": _soft_delete,
        "reactivate": _facts_after(3),
        "audit_run": _audit_run,
        "table_counts": lambda spark, sf_dir: load.table_counts(_loads(spark, sf_dir)[3].warehouse),
        "load_batch": lambda spark, sf_dir: _facts(_warehouse(spark, sf_dir)),
        "load_part": _facts_after(1),
        "ensure_version": _ensure_version,
        # analytical SQL
        **{name: _analytical(name) for name, _ in analytics.QUERIES},
        # streaming
        "score_stream": _score_stream,
        "stream_bands": _stream_bands,
        "stream_progress": _stream_progress,
        "systematic_sample": _sample_events,
        "systematic_sample_listings": _sample_listings,
        "latency_summary": _latency,
    }


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: duplicates found, batch loaded with them, areas ranked."""
    rows = _scored(spark, sf_dir).drop("dup_cluster_id")
    loaded = load.load_batch(
        spark, work_path(spark, "warehouse"), rows, _found(spark, sf_dir).members, now=LOAD_TIMES[0]
    )
    return analytics.run_query(loaded.warehouse, "area_leaderboard")[1]
