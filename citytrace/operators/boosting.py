"""Gradient-boosted regression trees over histograms, fitted on a distributed table.

Features are cut into at most 256 bins once, and the binned rows stay with the tasks as arrays, next to
their predictions so far. Each level of a tree is one job: tasks route their rows to the open nodes and add
up gradients per node, feature and bin; the sums of a node meet in one group, which answers with the best split. The driver sees splits only, never rows or histograms. Trees grow by the
largest gain first up to a number of leaves. For the absolute loss a leaf takes the weighted median of its
residuals, found by two passes of slot weights.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

from citytrace.session import checkpoint_dir, cut_lineage

WRITE_EVERY = 50  #: rounds after which the rows are written, so a lost task repeats few trees
BLOCK_ROWS = 1 << 18  #: rows that a task works on at once, about
SLOTS = 4096  #: slots of a residual range in one pass; two passes tell values apart at a part in 16 million
LEAST_HESSIAN = 1e-3
LEAST_PROGRESS = 1e-7
TREE_SCHEMA = (
    "tree int, base double, feature array<int>, threshold array<double>, left array<int>, right array<int>, value array<double>"
)


@dataclass(frozen=True)
class BoostConfig:
    """``rounds`` at most; ``held_out`` of the rows stop the rounds when ``patience`` of them bring nothing."""

    rounds: int
    depth: int
    min_leaf: int
    rate: float = 0.05
    bins: int = 255
    l2: float = 0.1
    leaves: int = 31
    patience: int = 10
    held_out: float = 0.1
    seed: int = 42


@dataclass
class Tree:
    """Nodes in order of creation; feature -1 marks a leaf. A row goes left if its value is <= the threshold."""

    feature: list[int]
    bin: list[int]
    threshold: list[float]
    left: list[int]
    right: list[int]
    value: list[float]

    @classmethod
    def root(cls) -> Tree:
        return cls([-1], [0], [0.0], [-1], [-1], [0.0])

    def split(self, node: int, feature: int, cut: int, threshold: float) -> tuple[int, int]:
        left = len(self.feature)
        self.feature[node], self.bin[node], self.threshold[node] = feature, cut, threshold
        self.left[node], self.right[node] = left, left + 1
        for column, empty in zip(
            (self.feature, self.bin, self.threshold, self.left, self.right, self.value), (-1, 0, 0.0, -1, -1, 0.0), strict=True
        ):
            column += [empty, empty]
        return left, left + 1

    def place(self, columns: np.ndarray, cuts: Sequence[float]) -> np.ndarray:
        """The leaf of each row; cuts are bins for binned columns, thresholds for raw ones."""
        feature, cut = np.array(self.feature), np.array(cuts)
        left, right = np.array(self.left), np.array(self.right)
        node, rows = np.zeros(len(columns), np.int64), np.arange(len(columns))
        while len(rows):
            at = node[rows]
            inner = feature[at] >= 0
            rows, at = rows[inner], at[inner]
            node[rows] = np.where(columns[rows, feature[at]] <= cut[at], left[at], right[at])
        return node


@dataclass
class Boosted:
    """A fitted model: base value, trees and the names of its inputs."""

    features: tuple[str, ...]
    base: float
    trees: list[Tree]

    def frame(self, spark: SparkSession) -> DataFrame:
        """One row a tree; a model without a tree has one row of a single leaf worth nothing."""
        trees = self.trees or [Tree.root()]
        rows = [(k, self.base, t.feature, t.threshold, t.left, t.right, t.value) for k, t in enumerate(trees)]
        return spark.createDataFrame(rows, TREE_SCHEMA)

    @classmethod
    def of_frame(cls, frame: DataFrame, features: Sequence[str]) -> Boosted:
        """The model of a table of trees; its size depends on rounds and leaves only."""
        rows = frame.orderBy("tree").collect()
        trees = [Tree(r["feature"], [0] * len(r["feature"]), r["threshold"], r["left"], r["right"], r["value"]) for r in rows]
        return cls(tuple(features), rows[0]["base"], trees)

    def prediction(self) -> Column:
        """Base and leaf values of a row; a missing input counts as larger than any threshold."""
        trees, base = self.trees, self.base

        @pandas_udf("double")
        def predicted(*columns: pd.Series) -> pd.Series:
            x = np.column_stack([c.to_numpy(np.float64, na_value=np.nan) for c in columns])
            total = np.full(len(x), base)
            for tree in trees:
                total += np.array(tree.value)[tree.place(x, tree.threshold)]
            return pd.Series(total)

        return predicted(*[F.col(c).cast("double") for c in self.features])


def bin_edges(df: DataFrame, features: Sequence[str], bins: int) -> list[np.ndarray]:
    """Upper ends of the bins of each feature: all distinct values where they are few, else quantiles.

    The last end is the largest value, so missing ones have a bin of their own above it.
    """
    edges = []
    inner = np.arange(1, bins + 1) / bins
    for name in features:
        values = df.select(F.col(name).cast("double").alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
        few = [r["v"] for r in values.distinct().limit(bins + 1).collect()]
        if len(few) <= bins:
            edges.append(np.array(sorted(few), np.float64))
        else:
            edges.append(np.unique(values.approxQuantile("v", inner.tolist(), 1 / (8 * bins))))
    return edges


def binned(df: DataFrame, features: Sequence[str], label: str, weight: str, edges: list[np.ndarray], config: BoostConfig) -> DataFrame:
    """(bins, y, w, raw, valid): a byte for each feature; ``valid`` rows only tell when to stop."""
    inputs = [F.col(c).cast("double") for c in features]
    held = F.lit(False)
    if config.patience:
        held = F.pmod(F.xxhash64(*features, label), F.lit(1 << 20)) < int(config.held_out * (1 << 20))
    narrow = df.where(F.col(label).isNotNull() & (F.col(weight) > 0)).select(
        F.array(*inputs).alias("x"), F.col(label).cast("double").alias("y"), F.col(weight).cast("double").alias("w"),
        F.lit(0.0).alias("raw"), held.alias("valid"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(batch.num_rows, -1)
            cells = np.column_stack([np.searchsorted(e, x[:, k]) for k, e in enumerate(edges)]).astype(np.uint8)
            packed = pa.array([row.tobytes() for row in cells], pa.binary())
            yield pa.RecordBatch.from_arrays([packed, *(batch.column(k) for k in range(1, 5))], names=["bins", "y", "w", "raw", "valid"])

    return narrow.mapInArrow(run, "bins binary, y double, w double, raw double, valid boolean")


def _blocks(data: DataFrame, n_features: int) -> RDD:
    """Blocks of at most about BLOCK_ROWS rows: bins, y, w, predictions so far and the held-out mark as arrays."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = b"".join(batch.column(0).to_pylist())
            rest = [np.ascontiguousarray(batch.column(k).to_numpy(zero_copy_only=False)).tobytes() for k in range(1, 5)]
            yield pa.RecordBatch.from_arrays([pa.array([v], pa.binary()) for v in (cells, *rest)], names=names)

    def joined(rows: Iterator[Row]) -> Iterator[tuple[np.ndarray, ...]]:
        held, n = [], 0
        for row in rows:
            cells = np.frombuffer(row[0], np.uint8).reshape(-1, n_features)
            held.append((cells, *(np.frombuffer(v, np.float64) for v in row[1:4]), np.frombuffer(row[4], bool)))
            n += len(cells)
            if n >= BLOCK_ROWS:
                yield tuple(map(np.concatenate, zip(*held, strict=True)))
                held, n = [], 0
        if held:
            yield tuple(map(np.concatenate, zip(*held, strict=True)))

    names = ["bins", "y", "w", "raw", "valid"]
    narrow, tasks = data.select(*names), data.sparkSession.sparkContext.defaultParallelism
    if narrow.rdd.getNumPartitions() < tasks:
        narrow = narrow.repartition(tasks)
    rows = narrow.mapInArrow(packed, ", ".join(f"{name} binary" for name in names))
    return rows.rdd.mapPartitions(joined).persist(StorageLevel.MEMORY_AND_DISK)


def _gradient(loss: str, raw: np.ndarray, y: np.ndarray) -> np.ndarray:
    return raw - y if loss == "squared" else np.sign(raw - y)


def best_split(sums: np.ndarray, min_leaf: int, l2: float) -> tuple[int, int, float, float, float, float] | None:
    """(feature, bin, gain, g, h and rows of the left part) of sums over (feature, bin, g/h/rows); None without a gain."""
    left = sums.cumsum(axis=1)[:, :-1]
    total = sums[0].sum(axis=0)
    g, h, n = (left[:, :, k] for k in range(3))
    g2, h2, n2 = (total[k] - left[:, :, k] for k in range(3))
    score = lambda a, b: a * a / (b + l2 + 1e-300)
    gain = score(g, h) + score(g2, h2) - score(total[0], total[1])
    allowed = (n >= min_leaf) & (n2 >= min_leaf) & (h >= LEAST_HESSIAN) & (h2 >= LEAST_HESSIAN)
    gain = np.where(allowed, gain, -np.inf)
    feature, cut = np.unravel_index(gain.argmax(), gain.shape)
    if not gain[feature, cut] > 0:
        return None
    return int(feature), int(cut), float(gain[feature, cut]), *(float(left[feature, cut, k]) for k in range(3))


def _level(
    rows: RDD, tree: Tree, open_nodes: list[int], loss: str, config: BoostConfig, n_features: int
) -> tuple[dict[int, dict], float | None]:
    """The best split of every open node, and at the root the held-out loss."""
    bins = 256
    slot = np.full(len(tree.feature), -1)
    slot[open_nodes] = np.arange(len(open_nodes))
    at_root = open_nodes == [0]

    def sums(blocks: Iterator[tuple[np.ndarray, ...]]) -> Iterator[tuple[int, np.ndarray]]:
        total = np.zeros((3, n_features, len(open_nodes) * bins))
        lost = np.zeros(2)
        for cells, y, w, raw, valid in blocks:
            if at_root and valid.any():
                error = raw[valid] - y[valid]
                lost += (w[valid] * (error * error if loss == "squared" else np.abs(error))).sum(), w[valid].sum()
            where = slot[tree.place(cells, tree.bin)]
            used = ~valid & (where >= 0)
            first, inside, weight = where[used] * bins, cells[used], w[used]
            g = weight * _gradient(loss, raw[used], y[used])
            for feature in range(n_features):
                place = first + inside[:, feature]
                for k, worth in enumerate((g, weight, None)):
                    total[k, feature] += np.bincount(place, worth, total.shape[2])
        if at_root:
            yield -1, lost
        cubes = total.reshape(3, n_features, len(open_nodes), bins).transpose(2, 1, 3, 0)
        yield from ((node, np.ascontiguousarray(cube)) for node, cube in zip(open_nodes, cubes, strict=True))

    def best(total: np.ndarray) -> dict | float | None:
        if total.ndim == 1:
            return float(total[0] / total[1]) if total[1] else None
        g, h, _ = total[0].sum(axis=0)
        found = best_split(total, config.min_leaf, config.l2) or (-1, -1, 0.0, 0.0, 0.0, 0.0)
        names = ("feature", "bin", "gain", "g_left", "h_left")
        return dict(zip(names, found, strict=False), g=float(g), h=float(h))

    parts = max(1, min(len(open_nodes), rows.getNumPartitions()))
    found = dict(rows.mapPartitions(sums).reduceByKey(np.add, parts).mapValues(best).collect())
    return {node: split for node, split in found.items() if node >= 0}, found.get(-1)


def _chosen(splits: dict[int, dict], children: dict[int, tuple[int, int]], leaves: int) -> set[int]:
    """Nodes that are split when the largest gain goes first, as far as gains are known.

    Gains of deeper nodes can only take places from these, so no other node is ever worth opening.
    """
    heap = [(-splits[0]["gain"], 0)] if splits.get(0, {}).get("feature", -1) >= 0 else []
    chosen: set[int] = set()
    while heap and len(chosen) < leaves - 1:
        _, node = heapq.heappop(heap)
        chosen.add(node)
        for child in children.get(node, ()):
            if splits.get(child, {}).get("feature", -1) >= 0:
                heapq.heappush(heap, (-splits[child]["gain"], child))
    return chosen


def _grown(rows: RDD, edges: list[np.ndarray], loss: str, config: BoostConfig) -> tuple[Tree, float | None]:
    """A tree with Newton leaves, and the held-out loss before it."""
    wide, splits, children, depth = Tree.root(), {}, {}, {0: 0}
    open_nodes, held_out = [0], None
    while open_nodes:
        found, lost = _level(rows, wide, open_nodes, loss, config, len(edges))
        held_out = lost if open_nodes == [0] else held_out
        splits |= found
        chosen = _chosen(splits, children, config.leaves)
        fresh = [n for n in open_nodes if n in chosen]
        open_nodes = []
        for node in fresh:
            s = splits[node]
            children[node] = wide.split(node, s["feature"], s["bin"], float(edges[s["feature"]][s["bin"]]))
            for child in children[node]:
                depth[child] = depth[node] + 1
            if depth[node] + 1 < config.depth:
                open_nodes += children[node]
        # Children at the last depth need no split of their own: their sums follow from the parent's.
    chosen = _chosen(splits, children, config.leaves)
    tree = Tree.root()
    worth = lambda g, h: -config.rate * g / (h + config.l2 + 1e-300)
    walk = [(0, 0, splits.get(0, {}).get("g", 0.0), splits.get(0, {}).get("h", 0.0))]
    while walk:
        node, at, g, h = walk.pop()
        tree.value[at] = worth(g, h)
        if node in chosen:
            s = splits[node]
            low, high = tree.split(at, s["feature"], s["bin"], float(edges[s["feature"]][s["bin"]]))
            walk.append((children[node][0], low, s["g_left"], s["h_left"]))
            walk.append((children[node][1], high, g - s["g_left"], h - s["h_left"]))
    return tree, held_out


def _medians(rows: RDD, tree: Tree, low: float, high: float) -> dict[int, float]:
    """The weighted lower median of the residuals in each leaf, all of which lie between low and high."""
    span = max(high - low, 1e-12)
    first = span / SLOTS
    found: dict[int, tuple] = {}
    for last in (False, True):
        chosen = np.array([found[n][1] if n in found else -1 for n in range(len(tree.feature))])

        def weights(blocks: Iterator[tuple[np.ndarray, ...]], last=last, chosen=chosen) -> Iterator[tuple[int, np.ndarray]]:
            size = len(tree.feature) * SLOTS
            held, most = np.zeros(size), np.full(size, -np.inf)
            for cells, y, w, raw, valid in blocks:
                leaf = tree.place(cells, tree.bin)
                far = (y - raw - low) / first
                slot = np.clip(np.floor(far).astype(np.int64), 0, SLOTS - 1)
                used = ~valid
                if last:  # the slot of the first pass, cut again
                    used = used & (slot == chosen[leaf])
                    slot = np.clip(np.floor((far - slot) * SLOTS).astype(np.int64), 0, SLOTS - 1)
                place = leaf[used] * SLOTS + slot[used]
                held += np.bincount(place, w[used], size)
                np.maximum.at(most, place, (y - raw)[used])
            both = np.stack((held, most)).reshape(2, -1, SLOTS)
            yield from ((int(n), both[:, n].copy()) for n in np.flatnonzero(both[0].any(axis=1)))

        def middle(item: tuple[int, np.ndarray], found=found) -> tuple[int, tuple[float, int, float, float]]:
            leaf, (held, most) = item
            filled = np.flatnonzero(held)
            _, _, before, total = found.get(leaf, (0.0, 0, 0.0, None))
            running = before + held[filled].cumsum()
            total = float(running[-1]) if total is None else total
            at = min(int(np.searchsorted(running, total / 2)), len(filled) - 1)
            slot = int(filled[at])
            return leaf, (float(most[slot]), slot, float(running[at] - held[slot]), total)

        merged = lambda a, b: np.stack((a[0] + b[0], np.maximum(a[1], b[1])))
        leaves = sum(f < 0 for f in tree.feature)
        parts = max(1, min(leaves, rows.getNumPartitions()))
        found = dict(rows.mapPartitions(weights).reduceByKey(merged, parts).map(middle).collect())
    return {leaf: value for leaf, (value, *_) in found.items()}


def fit_boosted(
    df: DataFrame, features: Sequence[str], label: str, weight: str, config: BoostConfig, loss: str = "squared"
) -> Boosted:
    """Boosted trees of the squared or the absolute loss. Runs Spark jobs, one a level of each tree.

    Rows without a label or a positive weight are left out. Missing inputs are larger than any threshold.
    Leaf and split counts go by rows, gains and leaf values by weight with the L2 term. An empty table gives
    a model that predicts 0.
    """
    if loss not in ("squared", "absolute"):
        raise ValueError("loss is squared or absolute")
    edges = bin_edges(df, features, config.bins)
    data = cut_lineage(binned(df, features, label, weight, edges, config))
    seen = data.where("not valid").agg(
        F.min("y").alias("low"), F.max("y").alias("high"), (F.sum(F.col("y") * F.col("w")) / F.sum("w")).alias("mean")
    ).first()
    if seen["low"] is None:
        return Boosted(tuple(features), 0.0, [])
    n_features, low, high = len(features), seen["low"], seen["high"]
    rows, former = _blocks(data, n_features), None
    base = seen["mean"]
    if loss == "absolute":
        base = _medians(rows, Tree.root(), low, high)[0]
    start = Tree.root()
    start.value[0] = base
    rows, former = _advanced(rows, start), rows
    trees = []
    raw_low = raw_high = base
    best, stale = np.inf, 0
    for _ in range(config.rounds):
        tree, held_out = _grown(rows, edges, loss, config)
        former.unpersist()
        if config.patience and held_out is not None:
            stale = 0 if held_out < best - LEAST_PROGRESS else stale + 1
            best = min(best, held_out)
            if stale >= config.patience:
                break
        if loss == "absolute":
            medians = _medians(rows, tree, low - raw_high, high - raw_low)
            for leaf, value in medians.items():
                tree.value[leaf] = config.rate * value
        leaf_values = [v for v, f in zip(tree.value, tree.feature, strict=True) if f < 0]
        raw_low, raw_high = raw_low + min(leaf_values), raw_high + max(leaf_values)
        trees.append(tree)
        if len(tree.feature) == 1:
            break
        rows, former = _advanced(rows, tree), rows
        if len(trees) % WRITE_EVERY == 0:
            checkpoint_dir(df.sparkSession)
            rows.checkpoint()
    former.unpersist()
    rows.unpersist()
    return Boosted(tuple(features), float(base), trees)


def _advanced(rows: RDD, tree: Tree) -> RDD:
    """The rows with the predictions that a tree adds."""
    value = np.array(tree.value)

    def run(block: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
        cells, y, w, raw, valid = block
        return cells, y, w, raw + value[tree.place(cells, tree.bin)], valid

    return rows.map(run).persist(StorageLevel.MEMORY_AND_DISK)
