"""Boosted regression trees grown from histograms: rows stay where they are, and only sums of bins travel.

The trees are those of Spark's ``GBTRegressor`` with squared loss: the first one is fitted to the labels, each later one to
twice the residuals and counted with the step; a split sends values up to a threshold to the left, wins by the variance that it
takes away, and thresholds lie between neighbouring values or, where there are more than ``max_bins``, quantiles. The
result is a ``GBTRegressionModel``. What differs is the cost. Rows are packed once into blocks of small integers: the bin
of each number and the position of each one-hot column's one, which gives the sums of all its slots at once. Several
fits share their passes, one for each level of a round, so that the number of jobs does not grow with the number of fits.

A pass is a map over the blocks and a sum of one small array per task. Rows are counted once for each of a few groups of
columns, by all columns of the group together, and the sums of the single columns follow from those. Residuals are cached next to the blocks from round
to round; every ``REBASE`` rounds they are worked out again from the written blocks and the trees so far, which bounds the
lineage without writing any row again. A missing number goes with the largest ones; a missing label is an error.
"""

from __future__ import annotations

import json
import sys
import time
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, TaskContext, cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listingflow.session import materialize, work_path

BLOCK_ROWS = 1 << 16
REBASE = 25
JOINT_BINS = 1 << 13  # bins of columns that are counted together; with some nodes they stay in a core's cache
_ALIKE = 1e-9  # shares of a gain that come from the order of sums


@dataclass(frozen=True)
class Layout:
    """Of a vector: how many numbers it begins with, and how many slots each one-hot column has after them."""

    numbers: int
    hot: tuple[int, ...]

    @property
    def size(self) -> int:
        return self.numbers + sum(self.hot)

    def slot(self, column: int, place: int) -> int:
        """The index in the vector of place ``place`` (from 1) of a one-hot column."""
        return self.numbers + sum(self.hot[: column - self.numbers]) + place - 1


@dataclass
class Tree:
    """A full tree by heap order; a node without a split (column -1) sends all to the left."""

    column: np.ndarray
    place: np.ndarray  # last bin of the left side, or the one-hot place of the right side
    gain: np.ndarray
    count: np.ndarray
    total: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        inner, nodes = (1 << depth) - 1, (2 << depth) - 1
        return cls(np.full(inner, -1), np.zeros(inner, np.int64), np.zeros(inner), np.zeros(nodes), np.zeros(nodes))

    def values(self) -> np.ndarray:
        """The mean of each leaf at the bottom."""
        half = len(self.column)
        return self.total[half:] / np.maximum(self.count[half:], 1)


# Number of the fit, seed, bins (columns x rows), and labels less what the trees predict.
_Block = tuple[int, tuple[int, int], np.ndarray, np.ndarray]
# Tasks get the functions of this module themselves, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def spread(vectors: DataFrame, layout: Layout) -> DataFrame:
    """``vectors`` with x0, x1, ...: each number, null if missing, and the place of each one-hot column's one, 0 without any.

    Written next to the vectors they spare every fit and pass the unpacking of vectors.
    """
    array = vectors.withColumn("_array", vector_to_array("features"))
    columns = [F.nanvl(F.get("_array", F.lit(i)), F.lit(None).cast("double")) for i in range(layout.numbers)]
    for c, n in enumerate(layout.hot, layout.numbers):
        columns.append(F.array_position(F.slice("_array", layout.slot(c, 1) + 1, n), 1.0).cast("double"))
    return array.select(*vectors.columns, *(x.alias(f"x{i}") for i, x in enumerate(columns)))


def _columns(vectors: DataFrame, label: str, layout: Layout) -> DataFrame:
    """(x0, x1, ..., label) of vectors, spread already or not."""
    value = F.col(label).cast("double")
    checked = F.when(value.isNull() | F.isnan(value), F.raise_error(F.lit("Labels MUST NOT be Null or NaN"))).otherwise(value)
    names = [f"x{i}" for i in range(layout.numbers + len(layout.hot))]
    rows = vectors if set(names) <= set(vectors.columns) else spread(vectors.select("features", label), layout)
    return rows.select(*names, checked.alias("label"))


def _thresholds(rows: DataFrame, layout: Layout, max_bins: int) -> list[np.ndarray]:
    """Per number: the middles between its neighbouring values, or between its quantiles where it has many values."""
    names = [f"x{i}" for i in range(layout.numbers)]
    shares = np.linspace(0, 1, max_bins).tolist()
    if not names:
        return []
    quantiles = lambda n: F.percentile_approx(n, shares, 10_000).alias(n)
    counted = rows.agg(*(F.approx_count_distinct(n).alias(n) for n in names)).first()
    # Quantiles cost much more than the values themselves, so they are taken only of numbers with many values.
    few = [n for n in names if counted[n] <= 1.5 * max_bins]
    found = rows.agg(*(F.collect_set(n).alias(n) if n in few else quantiles(n) for n in names)).first().asDict()
    if more := [n for n in few if len(found[n]) > max_bins]:
        found |= rows.agg(*(quantiles(n) for n in more)).first().asDict()
    out = []
    for n in names:
        values = np.unique(np.array(found[n] or [], dtype=np.float64))
        out.append((values[1:] + values[:-1]) / 2)
    return out


def _packed(batches: Iterator[pa.RecordBatch], fit: int, thresholds: list[np.ndarray], kind: str) -> Iterator[pa.RecordBatch]:
    """Blocks of rows: their bins column by column, and their labels."""
    part, n_blocks, held, n_held = TaskContext.get().partitionId(), 0, [], 0

    def block(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        nonlocal n_blocks
        table = pa.Table.from_batches(rows)
        bins = np.empty((table.num_columns - 1, table.num_rows), dtype=kind)
        for i in range(len(bins)):
            x = table.column(i).to_numpy()  # null as NaN, which stands behind all numbers
            bins[i] = np.searchsorted(thresholds[i], x, side="left") if i < len(thresholds) else x
        n_blocks += 1
        return pa.RecordBatch.from_arrays(
            [pa.array([fit], pa.int32()), pa.array([part], pa.int32()), pa.array([n_blocks], pa.int32()),
             pa.array([bins.tobytes()], pa.binary()),
             pa.array([table.column("label").to_numpy().astype("<f8").tobytes()], pa.binary())],
            names=["fit", "part", "block", "bins", "label"],
        )

    for batch in batches:
        while batch.num_rows:
            taken = batch.slice(0, BLOCK_ROWS - n_held)
            held.append(taken)
            n_held += taken.num_rows
            batch = batch.slice(taken.num_rows)
            if n_held == BLOCK_ROWS:
                yield block(held)
                held, n_held = [], 0
    if n_held:
        yield block(held)


def _nodes(bins: np.ndarray, tree: Tree, level: int, numbers: int) -> np.ndarray:
    """The node of ``level`` that each row comes to."""
    node = np.zeros(bins.shape[1], dtype=np.min_scalar_type(1 << level))
    for d in range(level):
        right = np.zeros(len(node), dtype=bool)
        for i in range(1 << d):
            at = (1 << d) - 1 + i
            c, place = tree.column[at], tree.place[at]
            if c >= 0:
                beyond = bins[c] > place if c < numbers else bins[c] == place
                right |= beyond & (node == i) if d else beyond
        node = 2 * node + right
    return node


def _grown(block: _Block, trees: Sequence[Sequence[Tree]], weights: Sequence[float], numbers: int) -> _Block:
    """The block with what the trees of its fit predict taken off."""
    fit, drawn, bins, left = block
    left = left.copy()
    for round_, weight in zip(trees, weights):
        tree = round_[fit]
        depth = (len(tree.column) + 1).bit_length() - 1
        left -= (weight * tree.values())[_nodes(bins, tree, depth, numbers)]
    return fit, drawn, bins, left


def _unpacked(row, kind: str) -> _Block:
    label = np.frombuffer(row.label, dtype="<f8")
    bins = np.frombuffer(row.bins, dtype=kind).reshape(-1, len(label))
    return row.fit, (row.part, row.block), bins, label


def _groups(widths: list[int]) -> list[list[int]]:
    """Columns to count together: wide ones first, each put where the product of bins stays within ``JOINT_BINS``."""
    groups: list[tuple[int, list[int]]] = []
    for c in sorted(range(len(widths)), key=lambda c: -widths[c]):
        for i, (size, columns) in enumerate(groups):
            if size * widths[c] <= JOINT_BINS:
                groups[i] = size * widths[c], [*columns, c]
                break
        else:
            groups.append((widths[c], [c]))
    return [columns for _, columns in groups]


def _left_out(n: int, subsample: float, seed: list[int]) -> np.ndarray:
    """Which of ``n`` rows a round leaves out: those whose draw, of 24 bits, reaches ``subsample``."""
    # Each word of the generator is two draws, as in its ``random(n, dtype=np.float32)``.
    raw = np.random.default_rng(seed).bit_generator.random_raw(n + 1 >> 1).astype("<u8", copy=False).view("<u4")[:n]
    return raw >> np.uint32(8) >= np.uint32(np.ceil(float(np.float32(subsample)) * (1 << 24)))


def _histograms(
    blocks: Iterator[_Block], trees: list[Tree], level: int, turn: int, widths: list[int], numbers: int,
    subsample: float, seed: int,
) -> Iterator[dict[int, np.ndarray]]:
    """By fit, of the task's rows: (count and sum) x nodes x bins of all columns in a row.

    Rows that the round leaves out go to a node of their own. They are drawn by block and round, alike at all levels.
    """
    nodes, groups = 1 << level, _groups(widths)
    sizes = [int(np.prod([widths[c] for c in g])) for g in groups]
    joint: dict[int, list[np.ndarray]] = {}
    for fit, block, bins, left in blocks:
        target = left if turn == 0 else 2 * left
        node = _nodes(bins, trees[fit], level, numbers)
        if subsample < 1:
            node[_left_out(len(node), subsample, [seed, turn, *block])] = nodes
        node = node.astype(np.intp)
        if fit not in joint:
            joint[fit] = [np.zeros((2, nodes, size)) for size in sizes]
        for group, size, sums in zip(groups, sizes, joint[fit]):
            place = bins[group[0]].astype(np.min_scalar_type(size))
            for c in group[1:]:
                place = place * place.dtype.type(widths[c]) + bins[c]
            at = node * size + place
            for out, weights in zip(sums, (None, target)):
                out += np.bincount(at, weights, minlength=(nodes + 1) * size).reshape(-1, size)[:nodes]
    yield {fit: _by_column(found, groups, widths) for fit, found in joint.items()}


def _by_column(joint: list[np.ndarray], groups: list[list[int]], widths: list[int]) -> np.ndarray:
    """The sums of the single columns, from those of groups of columns."""
    ends = np.cumsum(widths)
    out = np.empty((*joint[0].shape[:2], ends[-1]))
    for group, sums in zip(groups, joint):
        cube = sums.reshape(*sums.shape[:2], *(widths[c] for c in group))
        for i, c in enumerate(group, 2):
            others = tuple(a for a in range(2, cube.ndim) if a != i)
            out[:, :, ends[c] - widths[c] : ends[c]] = cube.sum(axis=others)
    return out


def _split(tree: Tree, level: int, sums: np.ndarray, widths: list[int], numbers: int) -> None:
    """Give each node of ``level`` that can gain by it the best split, and its children what they hold.

    Of splits that gain the same, as those of a number and of another one that follows from it, the finer column's is taken.
    """
    first, ends = (1 << level) - 1, np.cumsum(widths)
    order = sorted(range(len(widths)), key=lambda c: (c >= numbers, -widths[c], c))
    for i in range(1 << level):
        at = first + i
        count, total = sums[:, i, : widths[0]].sum(axis=1)
        if level == 0:
            tree.count[0], tree.total[0] = count, total
        best = (0.0, -1, 0, 0.0, 0.0)
        for c in order:
            n, s = sums[:, i, ends[c] - widths[c] : ends[c]]
            # What goes to the left: all bins up to one, or all but one place of a one-hot column.
            left_n, left_s = (np.cumsum(n)[:-1], np.cumsum(s)[:-1]) if c < numbers else (count - n[1:], total - s[1:])
            possible = (left_n > 0) & (left_n < count)
            if not possible.any():
                continue
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = left_s**2 / left_n + (total - left_s) ** 2 / (count - left_n) - total**2 / count
            gain = np.where(possible, gain / count, -np.inf)
            k = int(np.argmax(gain))
            if gain[k] > best[0] * (1 + _ALIKE):
                best = (float(gain[k]), c, k if c < numbers else k + 1, left_n[k], left_s[k])
        gain, tree.column[at], tree.place[at], left_n, left_s = best
        left, right = 2 * at + 1, 2 * at + 2
        if tree.column[at] < 0:
            tree.count[left], tree.total[left] = tree.count[at], tree.total[at]
            continue
        tree.gain[at] = gain
        tree.count[left], tree.total[left] = left_n, left_s
        tree.count[right], tree.total[right] = count - left_n, total - left_s


def _rows_of(tree: Tree, number: int, layout: Layout, thresholds: list[np.ndarray]) -> list[tuple]:
    """The nodes as Spark ML stores them, numbered in the order parent, left, right."""
    rows: list = []

    def add(at: int) -> int:
        mine = len(rows)
        rows.append(None)
        count, total = float(tree.count[at]), float(tree.total[at])
        mean, split, gain, left, right = total / count, (-1, [], -1), -1.0, -1, -1
        if at < len(tree.column) and tree.column[at] >= 0:
            c, place, gain = int(tree.column[at]), int(tree.place[at]), float(tree.gain[at])
            split = (c, [float(thresholds[c][place])], -1) if c < layout.numbers else (layout.slot(c, place), [0.5], -1)
            left, right = add(2 * at + 1), add(2 * at + 2)
        # The spread inside a node is not kept: neither predictions nor importances look at it.
        rows[mine] = (number, (mine, mean, 0.0, [count, total, total * mean], int(count), gain, left, right, split))
        return mine

    add(0)
    return rows


_NODE = (
    "treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, rawCount: bigint, "
    "gain: double, leftChild: int, rightChild: int, "
    "split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>>"
)


def _as_model(
    vectors: DataFrame, trees: list[Tree], weights: list[float], layout: Layout, thresholds: list[np.ndarray], booster: GBTRegressor
) -> GBTRegressionModel:
    """The trees as a model of Spark ML, through its own stored form."""
    spark = vectors.sparkSession
    path = work_path(spark, "trees")
    params = {p.name: v for p, v in booster.extractParamMap().items()}

    def described(kind: str, uid: str, shown: dict, **more) -> str:
        return json.dumps({
            "class": f"org.apache.spark.ml.regression.{kind}", "timestamp": int(time.time() * 1000),
            "sparkVersion": spark.version, "uid": uid, "paramMap": shown, "defaultParamMap": {}, **more})

    whole = described("GBTRegressionModel", booster.uid, params, numFeatures=layout.size, numTrees=len(trees))
    shared = {n: params[n] for n in ("featuresCol", "labelCol", "predictionCol", "maxDepth", "maxBins", "impurity")}
    spark.createDataFrame([(whole,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    spark.createDataFrame(
        [(i, described("DecisionTreeRegressionModel", f"{booster.uid}_{i}", shared), w) for i, w in enumerate(weights)],
        "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    nodes = [row for i, tree in enumerate(trees) for row in _rows_of(tree, i, layout, thresholds)]
    spark.createDataFrame(nodes, _NODE).coalesce(1).write.parquet(f"{path}/data")
    return GBTRegressionModel.load(path)


def fit_all(
    sets: Sequence[tuple[DataFrame, int]], layout: Layout, booster: GBTRegressor, rows_per_task: int, parallel: int = 2
) -> list[GBTRegressionModel]:
    """One model for each (written vectors and labels, number of rows); all of them grow in the same passes."""
    spark = sets[0][0].sparkSession
    cores = spark.sparkContext.defaultParallelism
    if not all(n for _, n in sets):
        raise ValueError("no rows to fit trees on")
    rounds, depth, step = booster.getMaxIter(), booster.getMaxDepth(), booster.getStepSize()
    max_bins, subsample, seed = booster.getMaxBins(), booster.getSubsamplingRate(), booster.getSeed()
    label, numbers = booster.getLabelCol(), layout.numbers
    tasks = [max(1, min(cores, -(-n // rows_per_task))) for _, n in sets]
    narrow = [_columns(vectors.coalesce(t), label, layout) for (vectors, _), t in zip(sets, tasks)]
    with ThreadPoolExecutor(parallel) as pool:
        thresholds = list(pool.map(lambda rows: _thresholds(rows, layout, max_bins), narrow))
    # Bins of all fits have one width, so that their sums have one shape.
    widths = [1 + max(len(t[i]) for t in thresholds) for i in range(numbers)] + [1 + n for n in layout.hot]
    kind = np.min_scalar_type(max(widths)).str
    packed = "fit int, part int, block int, bins binary, label binary"
    blocks = materialize(reduce(DataFrame.unionByName, [
        rows.mapInArrow(partial(_packed, fit=k, thresholds=t, kind=kind), packed)
        for k, (rows, t) in enumerate(zip(narrow, thresholds))
    ]), "blocks")
    n_tasks = max(1, min(cores, -(-sum(n for _, n in sets) // rows_per_task)))
    weights = [1.0] + [step] * (rounds - 1)
    trees: list[list[Tree]] = []
    state: RDD | None = None
    for turn in range(rounds):
        if turn % REBASE == 0:
            fresh = blocks.repartition(n_tasks).rdd.map(partial(_unpacked, kind=kind)).map(
                partial(_grown, trees=list(trees), weights=weights, numbers=numbers))
        else:
            fresh = state.map(partial(_grown, trees=trees[-1:], weights=weights[turn - 1 : turn], numbers=numbers))
        fresh.persist(StorageLevel.MEMORY_AND_DISK_DESER)  # bytes as they are, not compressed once more
        grown = [Tree.empty(depth) for _ in sets]
        for level in range(depth):
            found = fresh.mapPartitions(partial(
                _histograms, trees=grown, level=level, turn=turn, widths=widths, numbers=numbers, subsample=subsample,
                seed=seed)).collect()
            for k, tree in enumerate(grown):
                _split(tree, level, reduce(np.add, [part[k] for part in found if k in part]), widths, numbers)
        if state is not None:
            state.unpersist()
        state = fresh
        trees.append(grown)
    state.unpersist()
    return [
        _as_model(vectors, [r[k] for r in trees], weights, layout, thresholds[k], booster) for k, (vectors, _) in enumerate(sets)
    ]
