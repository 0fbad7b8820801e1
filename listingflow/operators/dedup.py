"""Duplicate detection: blocking, distance/price/size gates, text vote, clusters.

Rows that compare alike are folded before any pair is formed. A *point* is one (block, place, price, size); a
*posting* is one text at a point. Copies of a posting hang on its least id, postings of a point on the point's
least id, and only points meet each other, so a group of copies costs its size and not its square.

Points take the weights of their first text along to the cells, so a pair is scored where it meets and no pair travels
for its score. Clusters need no list of pairs: each task cuts its matching pairs down to links with the same components.
Pairs are listed only when they are asked for: those that connect points and their postings (``pairs``), or all of
them, for which every listing is a point of its own (``all_pairs``) and copies do cost the square of their number.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listingflow.functions.columns import dbl, flat_distance, listing_text, ratio_similarity
from listingflow.functions.text import ENGLISH_STOP_WORDS, tokens
from listingflow.operators.cells import join_on_cells, neighbour_cells, place, ratio_cell, reach
from listingflow.operators.components import connected_components, thin_links
from listingflow.operators.textweights import (
    as_weights, cosine_pairs, inverse_frequencies, normalised, raw_vectors, text_similarity,
)
from listingflow.session import materialize

# Bounds on a text similarity are trusted only beyond this distance from the limit.
_BOUND_MARGIN = 1e-9


@dataclass(frozen=True)
class MatchConfig:
    """Gates and weights. A gate of None is left open."""

    block: tuple[str, ...] = ("area", "property_type", "bedrooms")
    max_distance_m: float | None = 300.0
    min_price_similarity: float | None = 0.90
    min_size_similarity: float | None = 0.95
    text_weight: float = 0.45
    price_weight: float = 0.30
    size_weight: float = 0.25
    threshold: float = 0.55
    stop_words: tuple[str, ...] = ENGLISH_STOP_WORDS
    # Home rows of one join key that a single task compares; beyond it the key is refined and salted.
    hot_rows: int = 20_000

    @property
    def equal_numbers_match(self) -> bool:
        """Whether equal price and size reach the threshold without any common word."""
        return self.price_weight + self.size_weight >= self.threshold


def block_sizes(df: DataFrame, block: Sequence[str] = MatchConfig.block) -> DataFrame:
    """Rows and candidate pairs per block, counted without forming the pairs."""
    n = F.col("n_listings").cast("decimal(19,0)")
    return (
        df.dropna(subset=list(block))
        .groupBy(*block)
        .agg(F.count(F.lit(1)).alias("n_listings"))
        .withColumn("n_pairs", (n * (n - 1) / 2).cast("decimal(38,0)"))
    )


def _number(name: str) -> Column:
    value = F.col(name).cast("double")
    return F.when(~F.isnan(value), value)


def comparable(df: DataFrame, config: MatchConfig, scored: bool = True) -> DataFrame:
    """The compared columns of every listing that can be in a pair; digests stand for the text.

    A null block key is never compared. A price or size that is null, or 0 next to another 0, has no similarity and
    passes no gate; 0 next to another number has similarity 0. So a null drops the row where the value is gated or
    scored, and a 0 where it is gated. With an open gate a listing of price 0 may still match by size and text, but
    equal zeros are no equal numbers: such rows are kept ``apart`` from each other.
    """
    text = listing_text()
    gates = {"price": config.min_price_similarity, "size": config.min_size_similarity}
    possible, zero = F.lit(True), F.lit(False)
    for name, limit in gates.items():
        if scored or limit is not None:
            possible &= F.col(name).isNotNull()
        if limit is not None and limit > 0:
            possible &= F.coalesce(F.col(name) != 0, F.lit(False))
        zero |= F.coalesce(F.col(name) == 0, F.lit(False))
    unplaced = _number("lat").isNull() | _number("lon").isNull()
    return (
        df.dropna(subset=list(config.block))
        .select(
            "listing_id", *config.block,
            F.when(~unplaced, _number("lat")).alias("lat"), F.when(~unplaced, _number("lon")).alias("lon"),
            _number("price_aed_month").alias("price"), _number("size_sqft").alias("size"),
            F.md5(text).alias("text_key"),
            F.xxhash64(text).alias("text_a"), F.xxhash64(F.lit(1), text).alias("text_b"),
        )
        .where(possible)
        .withColumn("apart", F.when(zero, F.col("listing_id")))
    )


@dataclass(frozen=True)
class _Folded:
    points: DataFrame  # point_id, block columns, lat, lon, price, size, crowded
    # Of points with several listings only, and None without such points:
    located: DataFrame | None = None  # point_id, crowded, text_key, listing_id
    postings: DataFrame | None = None  # point_id, text_key, posting_id, copies
    crowd: DataFrame | None = None  # point_id, posting_id for points with several texts


def fold(rows: DataFrame, config: MatchConfig) -> _Folded:
    """Points of the comparable rows, and the postings of points that hold more than one listing.

    The points take one narrow shuffle, before which the rows of a point combine per task; only rows that share
    their point with others are looked at again.
    """
    spot = [*config.block, "lat", "lon", "price", "size", "apart"]
    if not config.equal_numbers_match:
        spot.append("text_key")  # equal numbers alone are no match then, so only copies share a point
    several_texts = [F.min(t) != F.max(t) for t in ("text_a", "text_b")]
    points = materialize(
        rows.groupBy(*spot).agg(
            F.min("listing_id").alias("point_id"), F.count(F.lit(1)).alias("n_listings"),
            (several_texts[0] | several_texts[1]).alias("crowded"),
        ),
        "points",
    )
    shared = points.where("n_listings > 1")
    if shared.isEmpty():
        return _Folded(points)
    shared = materialize(shared, "shared-points")
    same_spot = [rows[c].eqNullSafe(shared[c]) if c not in config.block else rows[c] == shared[c] for c in spot]
    located = materialize(
        rows.join(shared, same_spot).select("point_id", "crowded", rows["text_key"], "listing_id"), "located"
    )
    postings = materialize(
        located.groupBy("point_id", "crowded", "text_key").agg(
            F.min("listing_id").alias("posting_id"), F.count(F.lit(1)).alias("copies")
        ),
        "postings",
    )
    crowd = postings.where("crowded").select("point_id", "posting_id")
    return _Folded(points, located, postings, None if crowd.isEmpty() else crowd)


def _gates(config: MatchConfig, placed: bool) -> Column:
    gates = F.lit(True)
    if placed and config.max_distance_m is not None:
        gates &= flat_distance("p.lat", "p.lon", "h.lat", "h.lon") <= dbl(config.max_distance_m)
    if config.min_price_similarity is not None:
        gates &= ratio_similarity("p.price", "h.price") >= dbl(config.min_price_similarity)
    if config.min_size_similarity is not None:
        gates &= ratio_similarity("p.size", "h.size") >= dbl(config.min_size_similarity)
    return gates


_PAIR = ("id_a", "id_b", "price_similarity", "size_similarity", "crowded")


def _as_pairs(joined: DataFrame, *more: Column) -> DataFrame:
    return joined.select(
        F.least("p.point_id", "h.point_id").alias("id_a"),
        F.greatest("p.point_id", "h.point_id").alias("id_b"),
        ratio_similarity("p.price", "h.price").alias("price_similarity"),
        ratio_similarity("p.size", "h.size").alias("size_similarity"),
        (F.col("p.crowded") | F.col("h.crowded")).alias("crowded"),
        *more,
    )


def _scored_by(wanted: Callable[[Column], Column], config: MatchConfig) -> Callable[[DataFrame], DataFrame]:
    """Pairs with the ``exact_score`` of their points' first texts, of those whose score is ``wanted``.

    The score is worked out behind the join, on pairs past the gates: as a condition of the join it would be
    interpreted for every two points of a cell.
    """
    def run(joined: DataFrame) -> DataFrame:
        texts = [F.col(f"{side}.{c}").alias(f"{c}_{side}") for side in "ph" for c in ("raw", "norm")]
        pairs = _as_pairs(joined, *texts)
        similarity = text_similarity("raw_p", "raw_h", F.col("norm_p"), F.col("norm_h"))
        score = F.array(_exact_score(similarity, config))
        return pairs.select(*_PAIR, F.explode(F.filter(score, wanted)).alias("exact_score"))
    return run


def _reaching(config: MatchConfig) -> Callable[[DataFrame], DataFrame]:
    return _scored_by(lambda s: s >= dbl(config.threshold), config)


def _by_ratio(df: DataFrame, config: MatchConfig) -> DataFrame:
    return df.withColumn("price_cell", ratio_cell(F.col("price"), config.min_price_similarity)).withColumn(
        "size_cell", ratio_cell(F.col("size"), config.min_size_similarity)
    )


def _around_ratio(df: DataFrame, config: MatchConfig) -> DataFrame:
    """Probe rows for the price and size cells next to their own; an open gate has a single cell."""
    out = _by_ratio(df, config)
    for cell, limit in (("price_cell", config.min_price_similarity), ("size_cell", config.min_size_similarity)):
        if limit is not None and limit > 0:
            out = out.withColumn(cell, neighbour_cells(cell))
    return out


def _placed_pairs(
    points: DataFrame, config: MatchConfig, as_pairs: Callable[[DataFrame], DataFrame], meets: Column
) -> DataFrame:
    """Pairs of points that both have a place: join on geographic cells.

    Cells that hold more than ``hot_rows`` points are cut further by price and size, so an area with a large share
    of all rows is spread over many keys instead of one.
    """
    limit = config.max_distance_m
    keys = [*config.block, "band", "cell"]
    home, probe = place(points, limit), reach(points, limit)
    once = ~F.col("p.own") | (F.col("p.point_id") < F.col("h.point_id"))
    condition = once & meets & _gates(config, placed=True)
    hot = materialize(
        home.groupBy(*keys).count().where(F.col("count") > config.hot_rows).select(*keys), "crowded-cells"
    )
    on = [F.col(f"p.{k}") == F.col(f"h.{k}") for k in keys]
    if hot.isEmpty():
        return as_pairs(probe.alias("p").join(home.alias("h"), [*on, condition]))
    cold = probe.join(hot, keys, "left_anti").alias("p").join(
        home.join(hot, keys, "left_anti").alias("h"), [*on, condition]
    )
    refined = join_on_cells(
        _around_ratio(probe.join(hot, keys), config),
        _by_ratio(home.join(hot, keys), config),
        [*keys, "price_cell", "size_cell"], config.hot_rows, condition, ("point_id", "point_id"),
    )
    return as_pairs(cold).unionByName(as_pairs(refined))


def _unplaced_pairs(
    unplaced: DataFrame, points: DataFrame, config: MatchConfig, as_pairs: Callable[[DataFrame], DataFrame], meets: Column
) -> DataFrame:
    """Pairs in which a point has no place: the distance gate cannot reject them, price and size still can."""
    once = F.col("h.lat").isNotNull() | (F.col("p.point_id") < F.col("h.point_id"))
    return as_pairs(join_on_cells(
        _around_ratio(unplaced, config), _by_ratio(points, config),
        [*config.block, "price_cell", "size_cell"], config.hot_rows,
        once & meets & _gates(config, placed=False), ("point_id", "point_id"),
    ))


def gated_points(
    points: DataFrame, config: MatchConfig, as_pairs: Callable[[DataFrame], DataFrame] = _as_pairs, meets: Column | None = None
) -> DataFrame:
    """(id_a, id_b, price_similarity, size_similarity, crowded) for points that pass every gate.

    ``meets`` is one more condition on the points ``p`` and ``h``, ``as_pairs`` makes other rows of them.
    """
    meets = F.lit(True) if meets is None else meets
    placed = points.where(F.col("lat").isNotNull())
    unplaced = points.where(F.col("lat").isNull())
    if config.max_distance_m is None:
        return _unplaced_pairs(points.withColumn("lat", F.lit(None).cast("double")),
                               points.withColumn("lat", F.lit(None).cast("double")), config, as_pairs, meets)
    pairs = _placed_pairs(placed, config, as_pairs, meets)
    if not unplaced.isEmpty():
        pairs = pairs.unionByName(_unplaced_pairs(unplaced, points, config, as_pairs, meets))
    return pairs


def _with_vectors(joined: DataFrame) -> DataFrame:
    """Pairs with the vectors of their first and second listing."""
    first = F.least("p.point_id", "h.point_id") == F.col("p.point_id")
    second = F.greatest("p.point_id", "h.point_id") == F.col("h.point_id")
    return _as_pairs(
        joined,
        F.when(first, F.col("p.vector")).otherwise(F.col("h.vector")).alias("vector_a"),
        F.when(second, F.col("h.vector")).otherwise(F.col("p.vector")).alias("vector_b"),
    )


def gated_pairs(df: DataFrame, config: MatchConfig = MatchConfig(), vectors: DataFrame | None = None) -> DataFrame:
    """(id_a, id_b, price_similarity, size_similarity) of points past the gates, named by their least listing.

    With ``vectors`` (listing_id, vector) the pairs bring those of their two listings along (vector_a, vector_b), so no pair
    travels to them: what is exchanged grows with the points and not with the pairs.
    """
    points = fold(comparable(df, config, scored=False), config).points
    if vectors is None:
        return gated_points(points, config).drop("crowded")
    points = materialize(
        points.join(vectors.select(F.col("listing_id").alias("point_id"), "vector"), "point_id", "left"), "point-vectors")
    return gated_points(points, config, _with_vectors).drop("crowded")


def _exact_score(similarity: Column, config: MatchConfig) -> Column:
    return (
        dbl(config.text_weight) * similarity
        + dbl(config.price_weight) * F.col("price_similarity")
        + dbl(config.size_weight) * F.col("size_similarity")
    )


def _matching(scored: DataFrame, config: MatchConfig) -> DataFrame:
    return scored.where(F.col("exact_score") >= dbl(config.threshold)).select(
        "id_a", "id_b", F.bround("exact_score", 4).alias("score")
    )


def score_pairs(pairs: DataFrame, config: MatchConfig = MatchConfig()) -> DataFrame:
    """Weighted vote of text, price and size; kept on the exact score, reported to 4 digits."""
    return _matching(pairs.withColumn("exact_score", _exact_score(F.col("text_similarity"), config)), config)


def _alike_texts(left_open: DataFrame, members: DataFrame, weights: DataFrame, similarities: list[str]) -> DataFrame:
    """Posting pairs of two points that may reach the similarity that the points need.

    All texts list their tokens in one order, rare ones first. If t is the first token that two texts have in common,
    their similarity is at most the product of its weights plus the product of what either text still has after t
    (the norms of the rest). Only pairs with a common token for which that reaches what is needed are listed, so texts
    meet at their rare tokens and the frequent ones, late in the order with little left behind them, join nothing.
    """
    points = left_open.select(F.col("id_a").alias("point_id")).unionByName(left_open.select(F.col("id_b").alias("point_id")))
    rows = materialize(
        weights.withColumnRenamed("listing_id", "posting_id").join(
            members.join(points.distinct(), "point_id", "left_semi"), "posting_id"),
        "crowd-tokens",
    )
    spread = rows.groupBy("token").agg(F.count(F.lit(1)).alias("spread"))
    rest = Window.partitionBy("posting_id").orderBy("spread", "token").rowsBetween(1, Window.unboundedFollowing)
    ordered = materialize(
        rows.join(spread, "token").withColumn(
            "after", F.sqrt(F.coalesce(F.sum(F.col("weight") * F.col("weight")).over(rest), dbl(0)))
        ).select("point_id", "posting_id", "token", "weight", "after"),
        "crowd-ordered",
    )
    sides = [
        ordered.select(F.col("point_id").alias(f"id_{s}"), F.col("posting_id").alias(f"q{s}"), "token",
                       F.col("weight").alias(f"weight_{s}"), F.col("after").alias(f"after_{s}"))
        for s in "ab"
    ]
    # Of one text alone: the weight and rest that the other can have are at most one.
    alone = F.sqrt(F.col("weight_a") * F.col("weight_a") + F.col("after_a") * F.col("after_a"))
    reach = F.col("weight_a") * F.col("weight_b") + F.col("after_a") * F.col("after_b")
    least = F.col("needed") - dbl(_BOUND_MARGIN)
    return (
        left_open.join(sides[0], "id_a").where(alone >= least)
        .join(sides[1], ["id_b", "token"]).where(reach >= least)
        .select(F.least("qa", "qb").alias("id_a"), F.greatest("qa", "qb").alias("id_b"), *similarities).distinct()
    )


def _crowded_pairs(gated: DataFrame, crowd: DataFrame, weights: DataFrame, config: MatchConfig) -> DataFrame:
    """Posting pairs to score for two points of which at least one has several texts.

    Two such points need one matching pair to be linked, so their texts are not all compared. From the largest
    weight of each token at either point follow a floor (best single token) and a ceiling (sum over tokens) of
    the best similarity: a floor past the limit names its witness, a ceiling below it rules the points out, and
    for what lies between texts meet at their rare tokens.
    """
    ends = gated.select(F.col("id_a").alias("point_id")).unionByName(gated.select(F.col("id_b").alias("point_id")))
    ends = materialize(ends.distinct(), "crowd-ends")
    members = materialize(
        crowd.join(ends, "point_id", "left_semi").unionByName(
            ends.join(crowd, "point_id", "left_anti").select("point_id", F.col("point_id").alias("posting_id"))
        ),
        "crowd-members",
    )
    peaks = materialize(
        weights.withColumnRenamed("listing_id", "posting_id")
        .join(members, "posting_id")
        .groupBy("point_id", "token")
        .agg(F.max(F.struct("weight", "posting_id")).alias("peak")),
        "crowd-peaks",
    )
    a = peaks.select(F.col("point_id").alias("id_a"), "token", F.col("peak").alias("pa"))
    b = peaks.select(F.col("point_id").alias("id_b"), "token", F.col("peak").alias("pb"))
    product = F.col("pa.weight") * F.col("pb.weight")
    similarities = ["price_similarity", "size_similarity"]
    bounds = (
        gated.join(a, "id_a").join(b, ["id_b", "token"])
        .groupBy("id_a", "id_b", *similarities)
        .agg(
            F.sum(product).alias("ceiling"),
            F.max(F.struct(product.alias("floor"), F.col("pa.posting_id").alias("wa"),
                           F.col("pb.posting_id").alias("wb"))).alias("best"),
        )
    )
    needed = (
        dbl(config.threshold) - dbl(config.price_weight) * F.col("price_similarity")
        - dbl(config.size_weight) * F.col("size_similarity")
    ) / dbl(config.text_weight)
    judged = materialize(bounds.withColumn("needed", needed), "crowd-bounds")
    sure = F.col("best.floor") >= F.col("needed") + dbl(_BOUND_MARGIN)
    open_ = ~sure & (F.col("ceiling") >= F.col("needed") - dbl(_BOUND_MARGIN))
    witnessed = judged.where(sure).select(
        F.least("best.wa", "best.wb").alias("id_a"), F.greatest("best.wa", "best.wb").alias("id_b"), *similarities
    )
    left_open = materialize(judged.where(open_).select("id_a", "id_b", "needed", *similarities), "crowd-open")
    return witnessed.unionByName(_alike_texts(left_open, members, weights, similarities))


def _texts(df: DataFrame, config: MatchConfig) -> DataFrame:
    return df.select("listing_id", *config.block, listing_text().alias("text"))


@dataclass(frozen=True)
class _Compared:
    """What the pairs of a table are found from."""

    config: MatchConfig
    points: DataFrame  # the points of ``folded`` with the weights ``raw`` of their first text and their ``norm``
    folded: _Folded
    vectors: DataFrame | None  # of all postings of points with several texts, where there are such points


def compared(df: DataFrame, folded: _Folded, idf: DataFrame, config: MatchConfig) -> _Compared:
    """The points with the weights of their texts, each written once."""
    wanted = folded.points.select(F.col("point_id").alias("listing_id"))
    if folded.crowd is not None:
        wanted = wanted.unionByName(folded.crowd.select(F.col("posting_id").alias("listing_id")))
    texts = _texts(df, config).join(wanted.distinct(), "listing_id", "left_semi")
    weights = raw_vectors(texts, idf, config.block, stop_words=config.stop_words)
    if folded.crowd is not None:
        weights = materialize(weights, "vectors")
    points = materialize(
        folded.points.join(weights.withColumnRenamed("listing_id", "point_id"), "point_id", "left"), "point-vectors")
    return _Compared(config, points, folded, None if folded.crowd is None else normalised(weights))


def _matching_points(found: _Compared) -> DataFrame:
    """Pairs of points whose first texts match; that settles all points with one text, and most others."""
    return gated_points(found.points, found.config, _reaching(found.config))


def _matching_crowds(found: _Compared, components: DataFrame | None = None) -> DataFrame:
    """(id_a, id_b, score) of postings of points, of which one has several texts, that the first texts leave open.

    With ``components`` (id, component) only of points that are not in one component.
    """
    config, points, meets = found.config, found.points, None
    if components is not None:
        points = materialize(
            points.join(components.select(F.col("id").alias("point_id"), "component"), "point_id", "left")
            .withColumn("component", F.coalesce("component", "point_id")), "point-components")
        meets = F.col("p.component") != F.col("h.component")
    either = F.col("p.crowded") | F.col("h.crowded")
    unsettled = gated_points(
        points, config, _scored_by(lambda s: s < dbl(config.threshold), config), either if meets is None else either & meets
    ).select("id_a", "id_b", "price_similarity", "size_similarity")
    unsettled = materialize(unsettled, "unsettled")
    rest = _crowded_pairs(unsettled, found.folded.crowd, as_weights(found.vectors), config)
    return score_pairs(cosine_pairs(rest, found.vectors), config)


def _matching_within(found: _Compared) -> DataFrame:
    """(id_a, id_b, score) of the first posting of a point with its other ones."""
    within = found.folded.crowd.where("posting_id <> point_id").select(
        F.col("point_id").alias("id_a"), F.col("posting_id").alias("id_b"),
        dbl(1).alias("price_similarity"), dbl(1).alias("size_similarity"),
    )
    return score_pairs(cosine_pairs(within, found.vectors), found.config)


def copy_links(df: DataFrame, folded: _Folded, config: MatchConfig) -> DataFrame:
    """Exact copies, each linked to the least id of its posting."""
    copied = folded.postings.where("copies > 1").select("point_id", "text_key", "posting_id")
    texts = df.select(F.col("listing_id").alias("posting_id"), "title", "description")
    has_tokens = F.size(tokens(listing_text(), config.stop_words)) > 0
    score = (
        dbl(config.text_weight) * F.when(has_tokens, dbl(1)).otherwise(dbl(0))
        + dbl(config.price_weight) + dbl(config.size_weight)
    )
    heads = materialize(
        texts.join(copied, "posting_id").withColumn("exact", score).where(F.col("exact") >= dbl(config.threshold))
        .select("point_id", "text_key", "posting_id", F.bround("exact", 4).alias("score")),
        "copied",
    )
    return (
        folded.located.select("point_id", "text_key", "listing_id")
        .join(heads, ["point_id", "text_key"])
        .where("listing_id <> posting_id")
        .select(F.col("posting_id").alias("id_a"), F.col("listing_id").alias("id_b"), "score")
    )


def cluster_table(members: DataFrame) -> DataFrame:
    """(cluster_id, n_members, first_id, last_id) of each cluster."""
    return members.groupBy(F.col("dup_cluster_id").alias("cluster_id")).agg(
        F.count(F.lit(1)).alias("n_members"), F.min("listing_id").alias("first_id"), F.max("listing_id").alias("last_id")
    )


def assign_clusters(components: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(members, clusters) from (id, component): a cluster is named after its least member.

    Members stay one row each, so a cluster of any size is never gathered in one row.
    """
    members = components.select(
        F.col("id").alias("listing_id"),
        F.concat(F.lit("cluster_"), F.col("component").cast("string")).alias("dup_cluster_id"),
    )
    return members, cluster_table(members)


@dataclass(frozen=True)
class Duplicates:
    """The duplicates of a table; each part is worked out when it is first read."""

    df: DataFrame
    config: MatchConfig

    @cached_property
    def _found(self) -> tuple[_Compared, DataFrame]:
        """What the pairs are found from, and the words' weights."""
        config = self.config
        with ThreadPoolExecutor(1) as pool:
            # Word counts of the blocks need no points, so they are taken while the points are found.
            idf = pool.submit(inverse_frequencies, _texts(self.df, config), config.block, stop_words=config.stop_words)
            folded = fold(comparable(self.df, config), config)
        return compared(self.df, folded, idf.result(), config), idf.result()

    @cached_property
    def _inside(self) -> list[DataFrame]:
        """Pairs inside a point and copies, written once: they are about as many as the listings."""
        found, _ = self._found
        folded, inside = found.folded, []
        if folded.crowd is not None:
            inside.append(_matching_within(found))
        if folded.postings is not None and not folded.postings.where("copies > 1").isEmpty():
            inside.append(copy_links(self.df, folded, self.config))
        return [materialize(rows, "pairs-inside") for rows in inside]

    @cached_property
    def _linked(self) -> tuple[DataFrame, DataFrame]:
        """Links and the members that they connect."""
        found, _ = self._found
        links = [materialize(thin_links(_matching_points(found)), "links"),
                 *(rows.select("id_a", "id_b") for rows in self._inside)]
        components = connected_components(reduce(DataFrame.unionByName, links))
        if found.folded.crowd is not None:
            more = materialize(thin_links(_matching_crowds(found, components)), "crowd-links")
            if not more.isEmpty():
                links.append(more)
                components = connected_components(reduce(DataFrame.unionByName, links))
        members, _ = assign_clusters(components)
        return reduce(DataFrame.unionByName, links), materialize(members, "members")

    @property
    def links(self) -> DataFrame:
        """(id_a, id_b): some of the pairs, which connect the same listings as all of them."""
        return self._linked[0]

    @property
    def members(self) -> DataFrame:
        """(listing_id, dup_cluster_id)."""
        return self._linked[1]

    @cached_property
    def clusters(self) -> DataFrame:
        """(cluster_id, n_members, first_id, last_id)."""
        return materialize(cluster_table(self.members), "clusters")

    def _list_pairs(self, among: DataFrame | None) -> DataFrame:
        found, _ = self._found
        seen = found
        if among is not None:
            # A point is named after one of its listings, and those of them that are in pairs share its cluster.
            ids = among.select(F.col("listing_id").alias("point_id"))
            seen = replace(found, points=materialize(found.points.join(ids, "point_id", "left_semi"), "points-among"))
        parts = [_matching(_matching_points(seen), self.config), *self._inside]
        if found.folded.crowd is not None:
            parts.append(_matching_crowds(seen))
        return reduce(DataFrame.unionByName, parts)

    @cached_property
    def pairs(self) -> DataFrame:
        """(id_a, id_b, score): all matching pairs of points, and of postings and copies enough to connect them."""
        return self._list_pairs(None)

    def pairs_among(self, listings: DataFrame) -> DataFrame:
        """The rows of ``pairs`` inside whole clusters, given by all their (listing_id); no other points are compared."""
        inside = listings.select("listing_id")
        ends = [inside.withColumnRenamed("listing_id", name) for name in ("id_a", "id_b")]
        return self._list_pairs(inside).join(ends[0], "id_a", "left_semi").join(ends[1], "id_b", "left_semi").select(
            "id_a", "id_b", "score")

    @cached_property
    def _listings(self) -> DataFrame:
        """Every listing as a point of its own, with the weights of its text; rows that come twice are one."""
        found, idf = self._found
        if found.folded.postings is None:
            return found.points  # no two listings share a point
        rows = comparable(self.df, self.config).where(F.col("listing_id").isNotNull()).distinct()
        weights = raw_vectors(_texts(self.df, self.config), idf, self.config.block, stop_words=self.config.stop_words)
        points = rows.select(F.col("listing_id").alias("point_id"), *self.config.block, "lat", "lon", "price", "size",
                             F.lit(False).alias("crowded"))
        return materialize(
            points.join(weights.withColumnRenamed("listing_id", "point_id"), "point_id", "left"), "listing-vectors")

    def _list_all(self, points: DataFrame) -> DataFrame:
        return _matching(gated_points(points, self.config, _reaching(self.config)).where("id_a < id_b"), self.config)

    @cached_property
    def all_pairs(self) -> DataFrame:
        """(id_a, id_b, score) of all matching pairs of listings; of n copies all n * (n - 1) / 2."""
        return self._list_all(self._listings)

    def all_pairs_among(self, listings: DataFrame) -> DataFrame:
        """The rows of ``all_pairs`` between the given (listing_id); no other listings are compared."""
        ids = listings.select(F.col("listing_id").alias("point_id"))
        return self._list_all(materialize(self._listings.join(ids, "point_id", "left_semi"), "listings-among"))


def find_duplicates(df: DataFrame, config: MatchConfig = MatchConfig()) -> Duplicates:
    """Clusters, the map from listing to cluster, and scored pairs.

    Clusters are those of all matching pairs. ``pairs`` hold every matching pair of points; where a point has several
    texts or copies, they hold enough of them to connect it (see the module text). ``all_pairs`` hold all.
    """
    return Duplicates(df, config)
