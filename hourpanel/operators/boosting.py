"""Gradient-boosted regression trees for many training samples at once.

The samples of a rolling origin are prefixes of one table, so a row belongs to many of them. A *cell* is a row
in a sample, with the prediction that the sample's trees give so far. Every tree level is one pass over all
cells of all samples: tasks add up residuals and counts by (sample, node, feature, bin), a shuffle adds
them over tasks, and the tasks behind it choose the splits of their samples. Only the splits, a few numbers a node,
reach the driver. So the number of jobs is trees times depth, whatever the number of samples.

Blocks of rows stay cached between the passes, which is why this is an RDD: each pass reads the cells' state and sends
back sums. The state is written to the checkpoint folder every ``CHECKPOINT_EVERY`` trees, so a lost executor
costs a few passes. Residuals are added as whole numbers, so sums, and with them splits, do not depend on order.
"""

from __future__ import annotations

import json
import pickle
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourpanel.session import checkpoint_root

BLOCK_CELLS = 1 << 17  # cells of a cached block, or those of one row
SAMPLES_AT_ONCE = 32  # samples whose sums a task holds at the same time
CHECKPOINT_EVERY = 16  # trees
RESOLUTION = 1 << 24  # steps between zero and the largest label


@dataclass(frozen=True)
class BoostParams:
    trees: int = 64
    depth: int = 6
    rate: float = 0.1
    bins: int = 32
    min_leaf: int = 20  # rows on each side of a split


@dataclass
class Block:
    """Rows with binned features, and their cells."""

    row: np.ndarray
    bins: np.ndarray  # rows x features, 0: missing
    label: np.ndarray
    owner: np.ndarray  # a cell's row
    sample: np.ndarray
    trains: np.ndarray  # whether the cell counts in its sample
    wanted: np.ndarray  # whether its prediction is asked for
    predicted: np.ndarray

    def nodes(self, tree: Tree) -> np.ndarray:
        """The node of every cell; nodes are numbered by level, the root is 0."""
        node = np.zeros(len(self.owner), np.int64)
        for _ in range(tree.depth):
            feature = tree.feature[self.sample, node]
            right = self.bins[self.owner, feature] > tree.cut[self.sample, node]
            node = np.where(feature >= 0, 2 * node + 1 + right, node)
        return node


@dataclass
class Tree:
    """One tree of every sample: feature (-1: leaf) and last bin of the left side per node, and each node's value."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    depth: int

    @classmethod
    def empty(cls, samples: int, depth: int) -> Tree:
        # one more slot below the last level, so that a leaf there can be looked up
        n = (1 << (depth + 1)) - 1
        return cls(np.full((samples, n), -1, np.int16), np.zeros((samples, n), np.uint8), np.zeros((samples, n)), 0)


def cut_points(rows: DataFrame, features: list[str], bins: int) -> list[np.ndarray]:
    """Up to ``bins`` - 1 approximate quantiles of every feature, from one aggregation; labels are not used."""
    steps = [k / bins for k in range(1, bins)]
    found = rows.agg(*(F.percentile_approx(F.nanvl(F.col(n), F.lit(None).cast("double")), steps, 10_000).alias(n) for n in features)).first()
    return [np.unique(np.array(found[n] or [], float)) for n in features]


def binned(values: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """Bin numbers of a matrix of features: 0 for a missing value, else 1 + the number of smaller cut points."""
    out = np.zeros(values.shape, np.uint8)
    for k, points in enumerate(cuts):
        known = ~np.isnan(values[:, k])
        out[known, k] = np.searchsorted(points, values[known, k], "left") + 1
    return out


def _block(row: np.ndarray, bins: np.ndarray, label: np.ndarray, first: np.ndarray, stop: np.ndarray, test: np.ndarray) -> Block:
    count = np.maximum(stop - first, 0)
    owner = np.repeat(np.arange(len(row)), count)
    sample = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count) + first[owner]
    wanted = sample == test[owner]
    alone = np.flatnonzero((test >= 0) & ~((first <= test) & (test < stop)))  # a prediction only
    trains = np.concatenate([np.ones(len(owner), bool), np.zeros(len(alone), bool)])
    owner, sample = np.concatenate([owner, alone]), np.concatenate([sample, test[alone]])
    wanted = np.concatenate([wanted, np.ones(len(alone), bool)])
    return Block(row, bins, label, owner.astype(np.int32), sample.astype(np.int32), trains, wanted, np.zeros(len(owner)))


def blocks(rows: DataFrame, features: list[str], cuts: list[np.ndarray], samples: int) -> RDD:
    """Cached blocks of ``rows``: row, label, first, stop (samples it trains, to before stop), test (sample it is predicted by, or -1), features."""
    per_block = max(1, BLOCK_CELLS // (samples + 1))

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, per_block):
                part = batch.slice(a, per_block)
                number = {n: part.column(n).to_numpy(zero_copy_only=False) for n in ("row", "label", "first", "stop", "test")}
                values = np.stack([part.column(n).cast(pa.float64()).to_numpy(zero_copy_only=False) for n in features], axis=1)
                block = _block(number["row"], binned(values, cuts), number["label"].astype(float), number["first"], number["stop"], number["test"])
                yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(block)], pa.binary())], ["block"])

    used = rows.select("row", "label", "first", "stop", "test", *features)
    return used.mapInArrow(pack, "block binary").rdd.map(lambda r: pickle.loads(r.block))


def _sums(tree: Tree, level: int, samples: int, features: int, width: int, quantum: float, going: np.ndarray):
    """Per sample with cells at ``level``: whole residual sums and counts by (node, feature, bin)."""
    low, nodes = (1 << level) - 1, 1 << level

    def work(states: Iterable[Block]) -> Iterator[tuple[int, np.ndarray]]:
        held = []
        for block in states:
            node = block.nodes(tree) - low
            use = block.trains & (node >= 0) & going[block.sample]
            held.append((block, block.owner[use], block.sample[use], node[use], np.rint((block.label[block.owner[use]] - block.predicted[use]) / quantum)))
        for begin in range(0, samples, SAMPLES_AT_ONCE):
            stop = min(samples, begin + SAMPLES_AT_ONCE)
            size = (stop - begin) * nodes * width
            total = np.zeros((2, features, size), np.int64)
            for block, owner, sample, node, residual in held:
                inside = (sample >= begin) & (sample < stop)
                if inside.any():
                    own, residuals = block.bins[owner[inside]], residual[inside]
                    slot = ((sample[inside] - begin).astype(np.int64) * nodes + node[inside]) * width
                    for k in range(features):
                        total[0, k] += np.bincount(slot + own[:, k], residuals, size).astype(np.int64)
                        total[1, k] += np.bincount(slot + own[:, k], minlength=size)
            total = total.reshape(2, features, stop - begin, nodes, width)
            for i in np.flatnonzero(total[1, 0].any(axis=(1, 2))).tolist():
                yield begin + i, total[:, :, i].swapaxes(1, 2).copy()

    return work


def best_splits(sums: np.ndarray, min_leaf: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(feature or -1, last bin of the left side, mean residuals (node, left, right), rows) per node, from sums by (node, feature, bin).

    The split with the largest reduction of the squared error wins; ties go to the first feature and bin.
    """
    residual, count = sums[0].astype(float), sums[1].astype(float)
    left_sum, left_n = residual.cumsum(axis=2)[:, :, :-1], count.cumsum(axis=2)[:, :, :-1]
    all_sum, all_n = residual[:, :1].sum(axis=2, keepdims=True), count[:, :1].sum(axis=2, keepdims=True)
    right_sum, right_n = all_sum - left_sum, all_n - left_n
    allowed = (left_n >= min_leaf) & (right_n >= min_leaf)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = left_sum**2 / left_n + right_sum**2 / right_n - all_sum**2 / all_n
    gain = np.where(allowed, gain, -np.inf).reshape(len(residual), -1)
    at = gain.argmax(axis=1)
    feature, cut = np.unravel_index(at, allowed.shape[1:])
    nodes = np.arange(len(residual))
    splits = gain[nodes, at] > 1e-9
    parts = [(all_sum[:, 0, 0], all_n[:, 0, 0]), (left_sum[nodes, feature, cut], left_n[nodes, feature, cut]), (right_sum[nodes, feature, cut], right_n[nodes, feature, cut])]
    means = np.stack([s / np.maximum(n, 1) for s, n in parts], axis=1)
    return np.where(splits, feature, -1), cut, means, all_n[:, 0, 0]


def _grown(states: RDD, samples: int, features: int, params: BoostParams, quantum: float, going: np.ndarray) -> Tree:
    tree = Tree.empty(samples, params.depth)
    width = params.bins + 1
    for level in range(params.depth):
        sums = states.mapPartitions(_sums(tree, level, samples, features, width, quantum, going), preservesPartitioning=True)
        if states.getNumPartitions() > 1:  # else each sample's sums are together already
            sums = sums.reduceByKey(np.add, min(samples, states.getNumPartitions()))
        found = sums.mapValues(lambda x: best_splits(x, params.min_leaf)).collect()  # per sample and node a split and three means
        low, more = (1 << level) - 1, False
        tree.depth = level + 1
        for sample, (feature, cut, means, rows) in found:
            node = low + np.flatnonzero(rows > 0)
            k = node - low
            tree.feature[sample, node], tree.cut[sample, node] = feature[k], cut[k]
            tree.value[sample, node] = means[k, 0] * params.rate * quantum
            inner = feature[k] >= 0
            for side in (1, 2):
                tree.value[sample, 2 * node[inner] + side] = means[k][inner, side] * params.rate * quantum
            more |= bool(inner.any())
        if not more:
            break
    return tree


def _advanced(tree: Tree):
    def step(block: Block) -> Block:
        block.predicted = block.predicted + tree.value[block.sample, block.nodes(tree)]
        return block

    return step


def boost(states: RDD, samples: int, features: int, params: BoostParams, min_rows: int) -> tuple[RDD, np.ndarray, np.ndarray, list[Tree]]:
    """(blocks with final predictions, start value and training rows per sample, trees). Samples below ``min_rows`` are left alone.

    The returned blocks are cached; the caller unpersists them.
    """
    sc = states.context
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(checkpoint_root(SparkSession.getActiveSession()))

    def totals(parts: Iterable[Block]) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
        sums, rows, most = np.zeros(samples), np.zeros(samples, np.int64), 0.0
        for block in parts:
            sample, label = block.sample[block.trains], block.label[block.owner[block.trains]]
            sums += np.bincount(sample, label, samples)
            rows += np.bincount(sample, minlength=samples)
            most = max(most, float(np.abs(label).max(initial=0.0)))
        yield sums, rows, most

    states = states.persist(StorageLevel.MEMORY_AND_DISK)
    parts = states.mapPartitions(totals).collect()  # two numbers a sample and task
    rows = sum((p[1] for p in parts), np.zeros(samples, np.int64))
    # added in one order, whatever the order of the tasks
    start = np.array([sum(sorted(x)) for x in zip(*(p[0] for p in parts), strict=True)] if parts else [0.0] * samples) / np.maximum(rows, 1)
    quantum = max([p[2] for p in parts], default=0.0) / RESOLUTION or 1.0
    going = rows >= max(min_rows, 1)
    root = Tree.empty(samples, 0)
    root.value[:, 0] = start
    trees, old = [], states
    states = states.map(_advanced(root), preservesPartitioning=True).persist(StorageLevel.MEMORY_AND_DISK)
    if not going.any():
        return states, start, rows, trees
    for number in range(1, params.trees + 1):
        tree = _grown(states, samples, features, params, quantum, going)
        trees.append(tree)
        old.unpersist()
        old, states = states, states.map(_advanced(tree), preservesPartitioning=True).persist(StorageLevel.MEMORY_AND_DISK)
        if number % CHECKPOINT_EVERY == 0:
            states.checkpoint()
            states.count()
    return states, start, rows, trees


def predictions(spark: SparkSession, states: RDD, known: np.ndarray, column: str) -> DataFrame:
    """(row, prediction) of the wanted cells of samples that were fitted."""

    def work(block: Block) -> list[tuple[int, float]]:
        use = block.wanted & known[block.sample]
        return list(zip(block.row[block.owner[use]].tolist(), block.predicted[use].tolist(), strict=True))

    return spark.createDataFrame(states.flatMap(work), f"row long, {column} double", verifySchema=False)


@dataclass(frozen=True)
class BoostedTrees:
    """A fitted model: feature names, their cut points, the start value, and flat trees."""

    features: list[str]
    cuts: list[list[float]]
    start: float
    trees: list[dict]

    @classmethod
    def of(cls, features: list[str], cuts: list[np.ndarray], start: np.ndarray, trees: list[Tree], sample: int = 0) -> BoostedTrees:
        flat = [{"feature": t.feature[sample].tolist(), "cut": t.cut[sample].tolist(), "value": t.value[sample].tolist(), "depth": t.depth} for t in trees]
        return cls(features, [c.tolist() for c in cuts], float(start[sample]), flat)

    def scored(self, values: np.ndarray) -> np.ndarray:
        bins = binned(values, [np.array(c) for c in self.cuts])
        block = _block(np.arange(len(bins)), bins, np.zeros(len(bins)), *(np.full(len(bins), x) for x in (0, 1, 0)))
        out = np.full(len(bins), self.start)
        for t in self.trees:
            tree = Tree(np.array([t["feature"]], np.int16), np.array([t["cut"]], np.uint8), np.array([t["value"]]), t["depth"])
            out += tree.value[0, block.nodes(tree)]
        return out

    def column(self, frame: DataFrame) -> Column:
        """The prediction of a row, as an Arrow-batched function of its features."""
        model = frame.sparkSession.sparkContext.broadcast(self)  # trees times nodes numbers

        @F.pandas_udf("double")
        def score(values: pd.Series) -> pd.Series:
            return pd.Series(model.value.scored(np.stack(values.to_numpy()).astype(float)) if len(values) else [], dtype="float64")

        nan = F.lit(float("nan"))
        return score(F.array(*(F.coalesce(F.col(n).cast("double"), nan) for n in self.features)))

    def to_json(self) -> str:
        return json.dumps(self.__dict__)

    @classmethod
    def from_json(cls, text: str) -> BoostedTrees:
        return cls(**json.loads(text))
