"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listingflow.session import materialize

# Links that a task holds before it cuts them down to stars.
HELD = 1 << 20
# Tasks get the functions of this module themselves, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(id, least id of its component) of all ids of the links but the least ones themselves."""
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v, root = at[: len(a)], at[len(a) :], np.arange(len(ids))
    while len(u):
        low, high = np.minimum(root[u], root[v]), np.maximum(root[u], root[v])
        np.minimum.at(root, high, low)
        while (further := root[root]).tobytes() != root.tobytes():
            root = further
        apart = root[u] != root[v]
        u, v = u[apart], v[apart]
    linked = root != np.arange(len(ids))
    return ids[linked], ids[root[linked]]


def _thinned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links with the components of the task's links, about one for each of its ids; holds ``HELD`` and a batch."""
    held, n_held = [], 0

    def cut() -> pa.RecordBatch:
        child, parent = _stars(*(np.concatenate(side) for side in zip(*held)))
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(parent), pa.array(child)], names=["id_a", "id_b"])

    for batch in batches:
        if batch.num_rows:
            held.append(tuple(batch.column(c).to_numpy(zero_copy_only=False) for c in ("id_a", "id_b")))
            n_held += batch.num_rows
        if n_held > HELD:
            stars = cut()
            if stars.num_rows > HELD // 2:
                yield stars
                n_held = 0
            else:
                held.append(tuple(stars.column(c).to_numpy(zero_copy_only=False) for c in ("id_a", "id_b")))
                n_held = stars.num_rows
    if held:
        yield cut()


def thin_links(pairs: DataFrame) -> DataFrame:
    """(id_a, id_b): links with the same components as the (id_a, id_b) of ``pairs``, cut down inside each task.

    Pairs among n ids that come out of one task leave it as at most n links (unless they are more than it holds), so
    dense groups cost their ids and not their pairs, before anything is exchanged or written.
    """
    ids = pairs.select(F.col("id_a").cast("long").alias("id_a"), F.col("id_b").cast("long").alias("id_b"))
    return ids.where("id_a < id_b").mapInArrow(_thinned, "id_a long, id_b long")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node moves to the least id next to that node."""
    both = edges.select(F.col("child").alias("node"), F.col("parent").alias("near")).unionByName(
        edges.select(F.col("parent").alias("node"), F.col("child").alias("near"))
    )
    # Written before the join: a hub's edges then arrive as a plain shuffle, which AQE can split.
    least = materialize(
        both.groupBy("node").agg(F.min("near").alias("low")).select("node", F.least("node", "low").alias("low")),
        "large-star",
    )
    return (
        edges.join(least, edges["parent"] == least["node"])
        .select("child", F.col("low").alias("parent"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Every parent of a node, and the node, move to its least parent."""
    least = materialize(edges.groupBy("child").agg(F.min("parent").alias("low")), "small-star")
    others = edges.join(least, "child").where(F.col("parent") != F.col("low"))
    return (
        others.select(F.col("parent").alias("child"), F.col("low").alias("parent"))
        .unionByName(least.select("child", F.col("low").alias("parent")))
        .distinct()
    )


def _is_star_forest(edges: DataFrame) -> bool:
    """True when each child has one parent and no parent has a parent."""
    roles = edges.select(F.col("child").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("parent").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    bad = (
        roles.groupBy("node")
        .agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        .where((F.col("up") > 1) | ((F.col("up") == 1) & (F.col("down") == 1)))
    )
    return bad.isEmpty()


def connected_components(edges: DataFrame, a: str = "id_a", b: str = "id_b") -> DataFrame:
    """(id, component) for every id that occurs in ``edges``; the component is its least id.

    Each round is linear in the edges and is written to the shared folder, which cuts the lineage. The number of
    rounds grows with the square of the logarithm of the longest chain at most.
    """
    low, high = F.least(a, b), F.greatest(a, b)
    state = materialize(
        edges.select(high.alias("child"), low.alias("parent")).where("child > parent").distinct(), "edges"
    )
    while not _is_star_forest(state):
        # Groups in which all know all, the common case, are stars after the first half of the round.
        state = materialize(_large_star(state), "large-star-edges")
        if _is_star_forest(state):
            break
        state = materialize(_small_star(state), "small-star-edges")
    roots = state.select(F.col("parent").alias("id")).distinct()
    return state.select(F.col("child").alias("id"), F.col("parent").alias("component")).unionByName(
        roots.select("id", F.col("id").alias("component"))
    )
