"""Measuring duplicates and price flags against labels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listingflow.functions.columns import FRAUD_THRESHOLD, dbl
from listingflow.session import materialize

NAIVE_RATIO = 0.65
# Parts that a group's range of values is cut into at a time.
BINS = 1024


def _pairs_of(n: Column) -> Column:
    """n choose 2, in a decimal: a group of a few billion rows has more pairs than a bigint holds."""
    n = n.cast("decimal(19,0)")
    return (n * (n - 1) / 2).cast("decimal(38,0)")


def _share(part: Column, whole: Column) -> Column:
    """A ratio that is 0 when its base is 0."""
    part, whole = part.cast("double"), whole.cast("double")
    return F.when(whole > 0, part / whole).otherwise(dbl(0))


def _prf(tp: Column, fp: Column, fn: Column) -> dict[str, Column]:
    precision, recall = _share(tp, tp + fp), _share(tp, tp + fn)
    f1 = F.when(precision + recall > 0, dbl(2) * precision * recall / (precision + recall)).otherwise(dbl(0))
    return {"precision": F.bround(precision, 4), "recall": F.bround(recall, 4), "f1": F.bround(f1, 4)}


def group_pairs(df: DataFrame, group: str, key: str = "listing_id") -> DataFrame:
    """(group, n_members, n_pairs, first_id, last_id) of every group of two or more; null groups form no pairs.

    The pairs of a group are all pairs of its ids, so the group's size says how many there are and listing them
    would only square the largest group.
    """
    return (
        df.where(F.col(group).isNotNull())
        .groupBy(group)
        .agg(F.count(F.lit(1)).alias("n_members"), F.min(key).alias("first_id"), F.max(key).alias("last_id"))
        .where(F.col("n_members") > 1)
        .withColumn("n_pairs", _pairs_of(F.col("n_members")))
    )


def group_links(df: DataFrame, group: str, key: str = "listing_id") -> DataFrame:
    """(id_a, id_b): each id of a group with the group's least id. Their closure is the group."""
    # Written first, so that the join sees two plain shuffles and AQE can split a large group.
    heads = materialize(group_pairs(df, group, key).select(group, F.col("first_id").alias("id_a")), "group-heads")
    return df.join(heads, group).where(F.col(key) > F.col("id_a")).select("id_a", F.col(key).alias("id_b"))


def pair_metrics(df: DataFrame, label: str = "dup_group_truth", cluster: str = "dup_cluster_id") -> DataFrame:
    """One row: pairs by label, pairs by cluster, their overlap, precision, recall and F1.

    A pair is in both sets when its rows share label and cluster, so the overlap is counted from the sizes of the
    (label, cluster) groups. Everything comes from counts that combine before the shuffle; no pair is formed.
    """
    cells = df.groupBy(label, cluster).agg(F.count(F.lit(1)).alias("n"))
    cells = materialize(cells, "label-cluster")
    by_label = cells.where(F.col(label).isNotNull()).groupBy(label).agg(F.sum("n").alias("n"))
    by_cluster = cells.where(F.col(cluster).isNotNull()).groupBy(cluster).agg(F.sum("n").alias("n"))
    both = cells.where(F.col(label).isNotNull() & F.col(cluster).isNotNull())
    zero = F.lit(0).cast("decimal(38,0)")

    def total(frame: DataFrame, name: str) -> DataFrame:
        return frame.agg(F.coalesce(F.sum(_pairs_of(F.col("n"))).cast("decimal(38,0)"), zero).alias(name))

    found = by_cluster.agg(F.count(F.when(F.col("n") > 1, 1)).alias("clusters_found"))
    rows = cells.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("listings_scored"))
    out = rows.select(
        total(by_label, "t").scalar().alias("true_pairs"),
        total(by_cluster, "p").scalar().alias("predicted_pairs"),
        total(both, "tp").scalar().alias("true_positives"),
        found.scalar().alias("clusters_found"),
        "listings_scored",
    )
    tp = F.col("true_positives")
    fp, fn = F.col("predicted_pairs") - tp, F.col("true_pairs") - tp
    return out.select(
        "true_pairs", "predicted_pairs", "true_positives",
        fp.alias("false_positives"), fn.alias("false_negatives"),
        *[c.alias(n) for n, c in _prf(tp, fp, fn).items()],
        "clusters_found", "listings_scored",
    )


def _bin(value: Column, low: Column, high: Column) -> Column:
    """One of ``BINS`` equal parts of low..high; both ends have a part of their own, so a part is always narrower."""
    share = F.coalesce(F.nanvl((value / 2 - low / 2) / F.nullif(high / 2 - low / 2, dbl(0)), dbl(0.5)), dbl(0.5))
    inner = F.least(F.greatest(F.floor(share * BINS), F.lit(1)), F.lit(BINS - 2))
    return F.when(value == low, F.lit(0)).when(value == high, F.lit(BINS - 1)).otherwise(inner).cast("int")


def group_medians(df: DataFrame, group: tuple[str, ...], value: str) -> DataFrame:
    """Exact median per group by selection from histograms.

    Rows combine to one per distinct value before the shuffle. Each group's values are then counted in ``BINS`` parts of
    their range; a running sum over these counts, a bounded number of rows whatever the group's size, names the part
    that holds the middle position, and only that part is cut again, until it is a single value. Whole
    numbers below 2 ** 31 take four rounds at most. No group is ever sorted or held in one task.
    """
    counts = materialize(
        df.dropna(subset=[*group, value]).groupBy(*group, F.col(value).cast("double").alias("v"))
        .agg(F.count(F.lit(1)).alias("n")),
        "value-counts",
    )
    ends = counts.groupBy(*group).agg(F.sum("n").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
    # The middle two positions, from 1; the same one twice when the total is odd.
    middle = F.explode(F.array(F.floor((F.col("n") + 1) / 2), F.floor(F.col("n") / 2) + 1)).alias("position")
    wanted = ends.select(*group, "low", "high", middle).withColumn("k", F.col("position")).distinct()
    wanted, settled = materialize(wanted, "medians-wanted"), []
    while True:
        settled.append(wanted.where("low = high").select(*group, "position", F.col("low").alias("v")))
        wanted = wanted.where("low < high")
        if wanted.isEmpty():
            break
        near = counts.join(wanted, list(group)).where("v between low and high")
        bins = near.groupBy(*group, "position", "k", _bin(F.col("v"), F.col("low"), F.col("high")).alias("bin")).agg(
            F.sum("n").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")
        )
        upto = F.sum("n").over(Window.partitionBy(*group, "position").orderBy("bin"))
        hit = bins.withColumn("upto", upto).where((F.col("upto") >= F.col("k")) & (F.col("upto") - F.col("n") < F.col("k")))
        wanted = materialize(
            hit.select(*group, "low", "high", "position", (F.col("k") - (F.col("upto") - F.col("n"))).alias("k")),
            "medians-wanted",
        )
    found = reduce(DataFrame.unionByName, settled)
    return found.groupBy(*group).agg(((F.min("v") + F.max("v")) / dbl(2)).alias("median"))


def naive_price_flag(df: DataFrame, ratio: float = NAIVE_RATIO) -> DataFrame:
    """(listing_id, flag): 1 when the price is under ``ratio`` of the median of its area and type."""
    group = ("area", "property_type")
    medians = materialize(group_medians(df, group, "price_aed_month"), "medians")
    low = F.col("price_aed_month") < F.col("median") * dbl(ratio)
    return (
        df.select("listing_id", *group, "price_aed_month")
        .join(medians, list(group), "left")
        .select("listing_id", F.coalesce(low, F.lit(False)).cast("int").alias("flag"))
    )


def flag_metrics(df: DataFrame, flag: str = "flag", truth: str = "truth") -> DataFrame:
    """One row: counts, precision, recall and F1 of a 0/1 flag against a 0/1 truth."""
    f, t = F.col(flag), F.col(truth)
    counts = df.agg(
        F.coalesce(F.sum(f), F.lit(0)).cast("bigint").alias("flagged"),
        F.count_if((f == 1) & (t == 1)).alias("true_positives"),
        F.count_if((f == 1) & (t == 0)).alias("false_positives"),
        F.count_if((f == 0) & (t == 1)).alias("false_negatives"),
    )
    rates = _prf(F.col("true_positives"), F.col("false_positives"), F.col("false_negatives"))
    return counts.select("*", *[c.alias(n) for n, c in rates.items()])


def compare_fraud_methods(
    df: DataFrame, scored: DataFrame, threshold: float = FRAUD_THRESHOLD, truth: str = "is_suspicious_truth"
) -> DataFrame:
    """The naive flag and the model flag against the labels, one row each, with the gain of the model in both."""
    naive = naive_price_flag(df)
    by_model = scored.select(
        "listing_id", F.coalesce(F.col("residual_pct") <= dbl(threshold), F.lit(False)).cast("int").alias("model_flag")
    )
    flags = (
        df.select("listing_id", F.col(truth).alias("truth"))
        .join(naive, "listing_id")
        .join(by_model, "listing_id", "left")
        .select("truth", "flag", F.coalesce("model_flag", F.lit(0)).alias("model_flag"))
    )
    flags = materialize(flags, "flags")
    total = flags.agg(F.coalesce(F.sum("truth"), F.lit(0)).cast("bigint").alias("n"))
    both = flag_metrics(flags).withColumn("method", F.lit("naive")).unionByName(
        flag_metrics(flags, "model_flag").withColumn("method", F.lit("model"))
    )
    both = both.withColumn("true_suspicious", total.scalar()).withColumn("model_threshold", dbl(threshold))

    def of(method: str, column: str) -> Column:
        return F.max(F.when(F.col("method") == method, F.col(column)))

    gains = materialize(both.agg(
        F.bround(of("model", "precision") - of("naive", "precision"), 4).alias("precision_gain"),
        F.bround(of("model", "f1") - of("naive", "f1"), 4).alias("f1_gain"),
    ), "gains")
    return both.select(
        "method", *[c for c in both.columns if c != "method"],
        gains.select("precision_gain").scalar().alias("precision_gain"),
        gains.select("f1_gain").scalar().alias("f1_gain"),
    )
