"""Isolation forest: one task group per tree to fit, a vectorised pass over the rows to score.

A tree sees at most ``max_samples`` rows, so every group is bounded by configuration. The forest is
a table with one row per tree. A tree is an implicit heap: the children of node i are 2i + 1 and
2i + 2. A node is one byte (its column, or LEAF) and one 32-bit number (its threshold, or the depth
that a row which ends there counts for), so 180 trees of 120,000 rows are 236 MB. Features are
compared as 32-bit numbers in fitting and in scoring. The functions that run in Python workers are
closures over numpy only, so workers need no copy of this package.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from urllib.parse import unquote, urlparse

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf
from pyspark.sql.types import DoubleType

from citytrace.session import checkpoint_dir

TREES = 180
MAX_SAMPLES = 120_000
SEED = 42
LEAF = 255  #: in place of a column, so at most 255 columns are handled
FOREST_SCHEMA = "tree int, rows long, value binary, feature binary"
ROWS = 1 << 18  #: rows that one reading of the forest scores
CHUNK = 1 << 15  #: of them, rows that go down a tree side by side
_UNIT = float(1 << 52)


@dataclass(frozen=True)
class ForestConfig:
    trees: int = TREES
    max_samples: int = MAX_SAMPLES
    seed: int = SEED


def _depth_function():
    """Made inside a function so that it travels to the workers by value."""

    def expected(n):
        """Mean depth of an unsuccessful search in a binary search tree of n keys."""
        n = np.asarray(n, dtype=np.float64)
        many = np.maximum(n, 3.0)
        grown = 2.0 * (np.log(many - 1.0) + np.euler_gamma) - 2.0 * (many - 1.0) / many
        return np.where(n <= 1, 0.0, np.where(n <= 2, 1.0, grown))

    return expected


average_depth = _depth_function()


def _draws(trees: int, seed: int):
    """Rows of (_row, _twin, _share, inputs) as one row for each tree that draws them.

    A draw is the low 52 bits of ``xxhash64(xxhash64(row, twin, seed), tree)``: the hash of the SQL function,
    for all rows of a batch at once, as a lambda over the trees costs more than all else in the fit.
    """
    unit = _UNIT

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p1, p2, p3, p4, p5 = (
            np.uint64(p)
            for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
        )
        word = np.uint64
        turn = lambda x, by: (x << word(by)) | (x >> word(64 - by))

        def mixed(h):
            h = (h ^ (h >> word(33))) * p2
            h = (h ^ (h >> word(29))) * p3
            return h ^ (h >> word(32))

        def of_long(value, start):
            return mixed(turn((start + p5 + word(8)) ^ (turn(value * p2, 31) * p1), 27) * p1 + p4)

        def of_int(value, start):
            return mixed(turn((start + p5 + word(4)) ^ (np.array([value], np.uint64) * p1), 23) * p2 + p3)

        numbers = lambda column: column.to_numpy().view(np.uint64)
        for batch in batches:
            if not batch.num_rows:
                continue
            row = of_int(seed & 0xFFFFFFFF, of_long(numbers(batch.column(1)), numbers(batch.column(0))))
            start = of_long(row, np.array([42], np.uint64))
            least = word(min(np.ceil(batch.column(2)[0].as_py() * unit), unit))
            picks, draws = [], []
            for tree in range(trees):
                draw = of_int(tree, start) & word((1 << 52) - 1)
                picks.append(np.flatnonzero(draw < least))
                draws.append(draw[picks[-1]])
            at = np.concatenate(picks)
            order = np.argsort(at, kind="stable")  # the inputs of a row stay together, which packs well
            tree = np.repeat(np.arange(trees, dtype=np.int32), [len(p) for p in picks])[order]
            draw = np.concatenate(draws)[order] / unit
            yield pa.RecordBatch.from_arrays(
                [pa.array(tree), pa.array(draw), *(c.take(pa.array(at[order])) for c in batch.columns[3:])],
                names=["tree", "_draw", *batch.schema.names[3:]],
            )

    return run


def fit_iforest(sample: DataFrame, cols: Sequence[str], config: ForestConfig = ForestConfig()) -> DataFrame:
    """Forest table of a training sample.

    Each (row, tree) pair draws a repeatable number; a tree keeps the ``max_samples`` rows with
    the smallest. A first cut with some slack happens before any pair becomes a row, so about
    ``trees * max_samples`` rows travel, however many rows are drawn from. A row is hashed once;
    its draws are hashes of that number and the tree, made for a batch of rows at once.
    """
    cols = list(cols)
    if not 0 < len(cols) <= LEAF:
        raise ValueError(f"{len(cols)} columns; 1 to {LEAF} are handled")
    counted = sample.agg(F.count(F.lit(1)).cast("double")).scalar()
    psi = float(config.max_samples)
    slack = 6.0 * psi**0.5 + 16.0
    share = F.least(F.lit(1.0), F.try_divide(F.lit(psi + slack), counted))
    inputs = [f"_f{k}" for k in range(len(cols))]
    # Equal rows are counted, and numbered so that each draws for itself. A row travels as its hash and inputs.
    rows = sample.select(
        F.xxhash64(*sample.columns).alias("_row"), *[F.col(c).cast("float").alias(f) for c, f in zip(cols, inputs, strict=True)]
    )
    drawn = (
        rows.groupBy("_row", *inputs)
        .agg(F.count(F.lit(1)).alias("_copies"))
        .select("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))).alias("_twin"), *inputs)
        .select("_row", "_twin", share.alias("_share"), *inputs)
        .mapInArrow(_draws(config.trees, config.seed), f"tree int, _draw double, {', '.join(f'{f} float' for f in inputs)}")
    )
    limit, seed, unit_depth, leaf = config.max_samples, config.seed, average_depth, LEAF
    features = inputs

    def build(key, group):
        """A level at a time: the rows of a node are neighbours, so all its nodes are cut at once."""
        tree = int(key[0])
        group = group.sort_values(["_draw", *features], kind="stable").head(limit)
        data = group[features].to_numpy(dtype=np.float32)
        rng = np.random.default_rng([seed, tree])
        deepest = int(np.ceil(np.log2(max(len(data), 2))))
        value = np.zeros((2 << deepest) - 1, "<f4")
        feature = np.full(len(value), leaf, np.uint8)
        at = np.zeros(len(data), np.int64)
        for level in range(deepest + 1):
            if not len(data):
                break
            starts = np.flatnonzero(np.diff(at, prepend=-1))
            nodes, sizes = at[starts], np.diff(starts, append=len(at))
            low, high = np.minimum.reduceat(data, starts, axis=0), np.maximum.reduceat(data, starts, axis=0)
            free = (high > low) & (level < deepest)
            choices = free.sum(axis=1)
            inner = choices > 0
            value[nodes[~inner]] = level + unit_depth(sizes[~inner])
            # The place of the column among those that differ within the node, then the cut in its range.
            place, share = rng.random((2, len(nodes)))
            place = np.minimum((place * choices).astype(np.int64), choices - 1)
            column = (np.cumsum(free, axis=1) == place[:, None] + 1).argmax(axis=1)
            here = np.arange(len(nodes))
            least, most = low[here, column], high[here, column]
            span = most.astype(np.float64) - least
            cut = (least + np.where(inner, share * span, 0.0)).astype(np.float32)
            cut = np.where(cut < most, cut, least)  # rounding must not empty the right side
            feature[nodes[inner]], value[nodes[inner]] = column[inner], cut[inner]
            node = np.repeat(here, sizes)
            going = inner[node]
            right = data[np.arange(len(data)), column[node]] > cut[node]
            at, data = (2 * at + 1 + right)[going], data[going]
            order = np.argsort(at, kind="stable")
            at, data = at[order], data[order]
        return pd.DataFrame(
            {"tree": [tree], "rows": [len(group)], "value": [value.tobytes()], "feature": [feature.tobytes()]}
        )

    return drawn.groupBy("tree").applyInPandas(build, FOREST_SCHEMA)


def heap(tree) -> tuple[bytes, bytes]:
    """Values and columns of a tree that is given as (column, threshold, low side, high side) or a depth."""
    placed: dict[int, tuple[float, int]] = {}

    def put(node: int, part) -> None:
        if isinstance(part, tuple):
            column, threshold, low_side, high_side = part
            placed[node] = (threshold, column)
            put(2 * node + 1, low_side)
            put(2 * node + 2, high_side)
        else:
            placed[node] = (part, LEAF)

    put(0, tree)
    full = (1 << (max(placed) + 1).bit_length()) - 1
    nodes = [placed.get(k, (0.0, LEAF)) for k in range(full)]
    return np.array([v for v, _ in nodes], "<f4").tobytes(), bytes(c for _, c in nodes)


def _shared_files(forest: DataFrame) -> tuple[str, list[str], int]:
    """The folder, the files of the trees in order, and the most rows of a tree.

    Executors write a file per tree to the shared folder, so the forest never passes the driver's
    memory. Where that folder is a file system of the machines, tasks map the files as they lie;
    else each executor fetches them once.
    """
    spark = forest.sparkSession
    folder = f"{checkpoint_dir(spark)}/forest-{uuid.uuid4().hex}"
    seen = Observation()
    counted = forest.observe(seen, F.count(F.lit(1)).alias("trees"), F.max("rows").alias("rows"))
    record = F.concat("value", "feature").cast("string")
    counted.select("tree", record.alias("value")).write.partitionBy("tree").option("lineSep", "\n").text(folder)
    if not seen.get["trees"]:
        raise ValueError("the forest has no trees")
    found = spark.read.text(folder).inputFiles()
    files = sorted(found, key=lambda f: int(re.search(r"/tree=(\d+)/", f)[1]))
    if len(files) != seen.get["trees"]:
        raise ValueError("two trees have one number")
    if all(f.startswith("file:") for f in files):
        return "", [unquote(urlparse(f).path) for f in files], int(seen.get["rows"])
    spark.sparkContext.addFile(folder, recursive=True)
    return folder.rsplit("/", 1)[-1], ["/".join(f.split("/")[-2:]) for f in files], int(seen.get["rows"])


def score_iforest(df: DataFrame, forest: DataFrame, cols: Sequence[str], out: str) -> DataFrame:
    """Add the anomaly score ``2 ** (-mean depth / expected depth) - 0.5``, larger = more unusual.

    Writes the forest to the shared folder at call time (an action). Tasks map its files, so the
    workers of an executor share one copy that the system may drop at need. Only the feature columns
    travel to the Python workers; there is no shuffle.
    """
    folder, files, rows = _shared_files(forest)
    expected = float(average_depth(rows)) or 1.0
    depth = _depth_sum(folder, files)(*[F.col(c).cast("float") for c in cols])
    mean_depth = F.col("_depth") / float(len(files))
    return df.withColumn("_depth", depth).withColumn(out, F.pow(F.lit(2.0), -mean_depth / expected) - 0.5).drop("_depth")


def _depth_sum(folder: str, files: list[str]):
    leaf, most, step = LEAF, ROWS, CHUNK

    def laid_out(raw: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
        """Levels of a tree, its inner nodes as pairs (threshold, column) from 1 on, and the depths at its last level.

        What a leaf above the last level is worth goes down to all places below it, so every row makes the
        same number of steps. The low side of a node has the odd number of its two.
        """
        nodes = len(raw) // 5
        value, feature = raw[: 4 * nodes].view("<f4"), raw[4 * nodes : 5 * nodes]
        levels = (nodes + 1).bit_length() - 2
        pairs = np.zeros((1 << levels, 2), np.int32)
        ends, ended = value[:1], feature[:1] == leaf
        for level in range(levels):
            here, below = slice((1 << level) - 1, (2 << level) - 1), slice((2 << level) - 1, (4 << level) - 1)
            pairs[1 << level : 2 << level, 0] = value[here][::-1].view(np.int32)
            pairs[1 << level : 2 << level, 1] = np.where(ended, 0, feature[here])[::-1]
            done = np.repeat(ended, 2)
            ends = np.where(done, np.repeat(ends, 2), value[below])
            ended = done | (feature[below] == leaf)
        return levels, pairs.reshape(-1).view(np.int64), ends[::-1].astype(np.float64)

    def summed(data: np.ndarray) -> np.ndarray:
        """Depths over the trees in their order; each tree is read once for all rows."""
        from pyspark import SparkFiles

        total = np.zeros(len(data))
        width = data.shape[1]
        first = np.arange(min(len(data), step)) * width
        place, node, pair = np.empty_like(first), np.empty_like(first), np.empty_like(first)
        depth, x, low = np.empty(len(first)), np.empty(len(first), np.float32), np.empty(len(first), bool)
        for name in files:
            raw = np.memmap(f"{SparkFiles.get(folder)}/{name}" if folder else name, np.uint8, "r")
            levels, pairs, ends = laid_out(raw)
            for start in range(0, len(data), step):
                part = data[start : start + step].reshape(-1)
                n = len(part) // width
                at, held, node_ = place[:n], pair[:n], node[:n]
                cut, column = held.view(np.float32).reshape(-1, 2)[:, 0], held.view(np.int32).reshape(-1, 2)[:, 1]
                at[:] = 1
                for _ in range(levels):
                    pairs.take(at, out=held, mode="clip")
                    np.add(first[:n], column, out=node_)
                    part.take(node_, out=x[:n], mode="clip")
                    np.less_equal(x[:n], cut, out=low[:n])
                    np.left_shift(at, 1, out=at)
                    np.add(at, low[:n], out=at)
                at -= 1 << levels
                ends.take(at, out=depth[:n], mode="clip")
                total[start : start + n] += depth[:n]
        return total

    def depth_sum(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        held, rows = [], 0
        for features in batches:
            held.append(np.column_stack([f.to_numpy(dtype=np.float32) for f in features]))
            rows += len(held[-1])
            if rows >= most:
                yield pd.Series(summed(np.concatenate(held)))
                held, rows = [], 0
        if rows:
            yield pd.Series(summed(np.concatenate(held)))

    return pandas_udf(depth_sum, DoubleType())
