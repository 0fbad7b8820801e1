"""The fair-price model: clean training rows, boosted trees, scores from models that never saw the row."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from listingflow.functions.columns import (
    FRAUD_THRESHOLD, add_residuals, dbl, distance_to_center_km, hash_bucket, unit_key,
)
from listingflow.operators.boosting import Layout, fit_all, spread
from listingflow.session import materialize

NUMERIC_FEATURES = ("bedrooms", "size_sqft", "building_age_years", "floor", "furnished", "distance_to_center_km")
CATEGORICAL_FEATURES = ("area", "property_type")
TARGET = "price_aed_month"
_READ = {"listing_id", "lat", "lon", TARGET, *NUMERIC_FEATURES, *CATEGORICAL_FEATURES}
SEED = 42
FOLDS = 5
# Training rows of one task, below which a pass costs its tasks and not its rows.
ROWS_PER_TASK = 100_000


@dataclass(frozen=True)
class ModelParams:
    rounds: int = 250
    depth: int = 3
    step: float = 0.06
    subsample: float = 0.85
    max_bins: int = 128
    seed: int = SEED


@dataclass(frozen=True)
class FittedModel:
    model: PipelineModel  # fitted on all clean rows
    metrics: DataFrame  # held-out quality
    heldout: DataFrame  # actual, predicted, area of the test rows


def with_distance(df: DataFrame) -> DataFrame:
    return df.withColumn("distance_to_center_km", distance_to_center_km())


def with_clusters(df: DataFrame, members: DataFrame | None) -> DataFrame:
    """Attach ``dup_cluster_id`` from (listing_id, dup_cluster_id); rows outside any cluster get null.

    Without ``members`` the column stays as it is, or is null where there is none.
    """
    if members is None:
        return df if "dup_cluster_id" in df.columns else df.withColumn("dup_cluster_id", F.lit(None).cast("string"))
    return df.drop("dup_cluster_id").join(members.select("listing_id", "dup_cluster_id"), "listing_id", "left")


def clean_training_set(df: DataFrame, members: DataFrame | None, flags: DataFrame) -> DataFrame:
    """Unflagged listings, one per unit: the earliest, ties by id. Flagged rows go before the earliest is chosen.

    What to leave out is worked out on ids and dates of clustered rows only; the rank limit is applied per task
    before they are exchanged, so a large cluster is cut down to one row per task first. The full rows are joined
    on their id alone.
    """
    flagged = materialize(flags.where(F.col("flag") == 1).select("listing_id"), "flagged")
    rows = with_clusters(df, members)
    if members is None:
        members = rows.where(F.col("dup_cluster_id").isNotNull())
    clustered = materialize(
        df.select("listing_id", "listed_date")
        .join(members.select("listing_id", "dup_cluster_id"), "listing_id")
        .join(flagged, "listing_id", "left_anti"),
        "clustered",
    )
    first = Window.partitionBy("dup_cluster_id").orderBy(F.asc_nulls_last("listed_date"), "listing_id")
    earliest = clustered.withColumn("nth", F.row_number().over(first)).where("nth = 1").select("listing_id")
    later = clustered.select("listing_id").join(earliest, "listing_id", "left_anti")
    return rows.join(materialize(flagged.unionByName(later), "left-out"), "listing_id", "left_anti")


def train_test_split(df: DataFrame, test_share: float = 0.2, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """Split by a hash of the id and the seed: the same rows on any partitioning, unlike a random split."""
    bucket = hash_bucket(F.concat(F.col("listing_id").cast("string"), F.lit(f":{seed}")), 1000)
    is_test = bucket < int(round(test_share * 1000))
    return df.where(~is_test), df.where(is_test)


def encoding_stages() -> list:
    """Numbers as they are, one-hot area and type (all zeros for an unknown value), as one vector ``features``."""
    indexed = [f"{c}_index" for c in CATEGORICAL_FEATURES]
    encoded = [f"{c}_onehot" for c in CATEGORICAL_FEATURES]
    return [
        StringIndexer(inputCols=list(CATEGORICAL_FEATURES), outputCols=indexed, handleInvalid="keep",
                      stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCols=indexed, outputCols=encoded),
        VectorAssembler(inputCols=[*NUMERIC_FEATURES, *encoded], outputCol="features", handleInvalid="keep"),
    ]


def booster(params: ModelParams = ModelParams()) -> GBTRegressor:
    """Boosted trees on ``features``.

    Trees are so shallow that walking a row down again costs less than keeping every row's node between levels.
    """
    return GBTRegressor(
        featuresCol="features", labelCol=TARGET, predictionCol="raw_prediction",
        maxIter=params.rounds, maxDepth=params.depth, stepSize=params.step,
        subsamplingRate=params.subsample, maxBins=params.max_bins, seed=params.seed,
        checkpointInterval=10,
    )


def feature_pipeline(params: ModelParams = ModelParams()) -> Pipeline:
    """The vector of each row and boosted trees on it."""
    return Pipeline(stages=[*encoding_stages(), booster(params)])


def fit_encoder(df: DataFrame) -> PipelineModel:
    """The encoding of the areas and types of ``df``: one pass that counts their values."""
    return Pipeline(stages=encoding_stages()).fit(with_distance(df).select(*NUMERIC_FEATURES, *CATEGORICAL_FEATURES))


def with_vectors(encoder: PipelineModel, df: DataFrame) -> DataFrame:
    """``df`` with the vector ``features``; the working columns of the encoding are dropped."""
    return encoder.transform(with_distance(df)).select(*df.columns, "features")


def _layout(encoder: PipelineModel) -> Layout:
    return Layout(len(NUMERIC_FEATURES), tuple(len(labels) for labels in encoder.stages[0].labelsArray))


def fit_sets(
    sets: Sequence[tuple[DataFrame, int]], encoder: PipelineModel, params: ModelParams = ModelParams(), parallel: int = 2
) -> list[PipelineModel]:
    """For each (written features and prices, number of rows) the encoding followed by trees fitted on them.

    All fits grow their trees in the same passes over the rows; ``parallel`` of them are prepared at a time.
    """
    models = fit_all(sets, _layout(encoder), booster(params), ROWS_PER_TASK, parallel)
    return [PipelineModel([*encoder.stages, trees]) for trees in models]


def fit_vectors(vectors: DataFrame, n_rows: int, encoder: PipelineModel, params: ModelParams = ModelParams()) -> PipelineModel:
    """The encoding followed by trees fitted on the written (features, price) of ``vectors``."""
    return fit_sets([(vectors, n_rows)], encoder, params)[0]


def fit(df: DataFrame, params: ModelParams = ModelParams()) -> PipelineModel:
    """Encode ``df`` once, write the vectors, and fit on them."""
    encoder = fit_encoder(df)
    vectors = materialize(with_vectors(encoder, df).select("features", TARGET), "vectors")
    return fit_vectors(vectors, vectors.count(), encoder, params)


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``df`` with ``raw_prediction``; batch or stream. The working columns of the pipeline are dropped."""
    scored = model.transform(with_distance(df))
    return scored.select(*df.columns, *[c for c in ("distance_to_center_km",) if c not in df.columns],
                         "raw_prediction")


def regression_metrics(
    df: DataFrame, actual: str = "actual", predicted: str = "predicted"
) -> DataFrame:
    """One row: MAE (1 digit), mean relative error and R2 (4 digits), and the number of rows."""
    a, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    # Relative to the actual value, with the same tiny floor for zeros as the usual definition.
    share = F.abs(a - p) / F.greatest(F.abs(a), dbl(2.220446049250313e-16))
    return df.agg(
        F.bround(F.avg(F.abs(a - p)), 1).alias("mae"),
        F.bround(F.avg(share), 4).alias("mape"),
        F.bround(dbl(1) - F.try_divide(F.sum((a - p) * (a - p)), F.var_pop(a) * F.count(a)), 4).alias("r2"),
        F.count(F.lit(1)).alias("n_test"),
    )


def heldout_predictions(test: DataFrame) -> DataFrame:
    return test.select(
        "listing_id", F.col(TARGET).alias("actual"), F.bround("raw_prediction", 0).alias("predicted"), "area"
    )


def fit_price_model(
    clean: DataFrame, params: ModelParams = ModelParams(), written: bool = False, parallel: int = 2
) -> FittedModel:
    """Fit on 80 %, measure on the rest, and fit on all clean rows; the two fits share their passes.

    The rows are encoded once. Both fits read the written vectors; ``written`` says that ``clean`` is a stored table
    already, which is read twice: for the values of area and type, and for the vectors.
    """
    # Texts and other columns that no step reads are not written.
    clean = clean.select(*(n for n in clean.columns if n in _READ))
    clean = clean if written else materialize(clean, "clean")
    encoder = fit_encoder(clean)
    vectors = materialize(
        spread(with_vectors(encoder, clean).select("listing_id", "area", TARGET, "features"), _layout(encoder)), "vectors"
    )
    train, test = train_test_split(vectors)
    n_train, n_all = train.count(), vectors.count()
    whole, part = fit_sets([(vectors, n_all), (train, n_train)], encoder, params, parallel)
    scored = part.stages[-1].transform(test.select("listing_id", "area", TARGET, "features"))
    tested = materialize(scored.drop("features"), "heldout")
    metrics = regression_metrics(tested, TARGET, "raw_prediction").withColumn("n_train", F.lit(n_train))
    return FittedModel(whole, metrics, heldout_predictions(tested))


def feature_importances(model: PipelineModel, scored: DataFrame) -> DataFrame:
    """(feature, importance) with one-hot slots summed to their column, most important first.

    ``scored`` is any output of the model's own ``transform``; its schema names the slots. A table of one row per
    slot, not of data rows.
    """
    attrs = scored.schema["features"].metadata["ml_attr"]["attrs"]
    weights = model.stages[-1].featureImportances.toArray()
    slots = [(slot["name"], float(weights[slot["idx"]])) for group in attrs.values() for slot in group]
    table = scored.sparkSession.createDataFrame(slots, "slot string, weight double")
    parent = F.col("slot")
    for column in CATEGORICAL_FEATURES:
        parent = F.when(F.col("slot").startswith(f"{column}_onehot_"), column).otherwise(parent)
    total = table.agg(F.sum("weight").alias("total"))
    summed = table.groupBy(parent.alias("feature")).agg(F.sum("weight").alias("weight"))
    total = total.select(F.when(F.col("total") > 0, F.col("total")).otherwise(dbl(1))).scalar()
    return summed.select("feature", F.bround(F.col("weight") / total, 4).alias("importance")).orderBy(
        F.desc("importance"), "feature"
    )


def score_all(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Every row with its prediction and residuals."""
    return add_residuals(predict(model, df)).drop("raw_prediction")


def group_folds(df: DataFrame, folds: int = FOLDS, cluster: str = "dup_cluster_id") -> DataFrame:
    """Add ``fold``; all listings of a unit share it."""
    return df.withColumn("fold", hash_bucket(unit_key(cluster), folds))


def score_out_of_fold(
    df: DataFrame, clean: DataFrame, members: DataFrame | None, folds: int = FOLDS,
    params: ModelParams = ModelParams(), parallel: int = FOLDS,
) -> DataFrame:
    """Every row scored by a model fitted on the clean rows of the other folds.

    All rows are encoded once, and written with their fold and vector. The fits read nothing but vectors and prices of
    clean rows and share their passes; ``parallel`` of them are prepared at a time. Each fold's rows are scored from their
    vectors by the model that never saw them.
    """
    grouped = group_folds(with_clusters(df, members), folds)
    encoder = fit_encoder(df)
    is_clean = clean.select("listing_id", F.lit(True).alias("_clean")).dropDuplicates(["listing_id"])
    rows = materialize(
        spread(with_vectors(encoder, grouped).join(is_clean, "listing_id", "left"), _layout(encoder)), "folds",
        partition_by=["fold"],
    )
    train = rows.where("_clean")
    sizes = {r["fold"]: r["n"] for r in train.groupBy("fold").agg(F.count(F.lit(1)).alias("n")).collect()}
    if empty := sorted(set(range(folds)) - sizes.keys()):
        raise ValueError(f"no clean unit in fold {', '.join(map(str, empty))} of {folds}")
    n = sum(sizes.values())

    sets = [(train.where(F.col("fold") != k), n - sizes[k]) for k in range(folds)]
    models = [fitted.stages[-1] for fitted in fit_sets(sets, encoder, params, parallel)]
    columns = [*grouped.columns, *[c for c in ("distance_to_center_km",) if c not in grouped.columns]]
    parts = [
        add_residuals(with_distance(model.transform(rows.where(F.col("fold") == k)))).select(
            *columns, "predicted_price_aed_month", "residual_aed", "residual_pct")
        for k, model in enumerate(models)
    ]
    return reduce(DataFrame.unionByName, parts)


def flagged_listings(scored: DataFrame, threshold: float = FRAUD_THRESHOLD, n: int | None = None) -> DataFrame:
    """Listings at or under ``threshold``, lowest first; with ``n`` only the top of that list."""
    rows = scored.where(F.col("residual_pct") <= dbl(threshold)).orderBy("residual_pct", "listing_id")
    return rows if n is None else rows.limit(n)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """The model saved at ``path``; a missing one is a ``FileNotFoundError``."""
    try:
        return PipelineModel.load(path)
    except Exception as error:  # the cause differs by file system
        raise FileNotFoundError(f"no fitted model at {path}") from error


def encoded_features(model: PipelineModel, df: DataFrame) -> DataFrame:
    """(listing_id, features) with the assembled vector as an array."""
    out = model.transform(with_distance(df))
    return out.select("listing_id", vector_to_array("features").alias("features"))


def known_values(model: PipelineModel) -> dict[str, Sequence[str]]:
    """The areas and types the model was fitted on."""
    return dict(zip(CATEGORICAL_FEATURES, model.stages[0].labelsArray))
