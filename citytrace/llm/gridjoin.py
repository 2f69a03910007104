"""Embedding near-duplicates by an epsilon grid order join.

Vectors are normalised, turned to their principal dimensions and sorted by the grid cells (of width
epsilon) on the leading ones. The sorted sequence lies in chunks, a file of the shared folder each, and
is cut into intervals and pieces of bounded size. A task reads the two files of a pair of chunks; any two
chunks, intervals or pieces whose boxes are farther apart than epsilon are skipped. So a vector is dealt
out and written once, however many intervals it meets. Equal vectors of an interval are one class.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import SparkFiles, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, FloatType, IntegerType, LongType, StructType

from .shared import component_roots, field, saved

LEADING = 4  #: principal dimensions whose cells give the order
INTERVAL = 4096  #: vectors of an interval, at most
LEAF = 512  #: vectors of a piece that is compared outright
TURNED = 2048  #: leading columns that are turned to their axes; the covariance of these comes to the driver
CHUNK_BYTES = 1 << 25  #: of a chunk's vectors as doubles, about
CHUNKS_A_TASK = 32  #: chunks that a task compares with one of them, at most
MOST_TASKS = 1 << 14  #: tasks of the comparison, at most
PAIRS_HELD = 1 << 19  #: linked pairs that are held before they are counted, about
COARSE = 1e-5  #: more than the error of a sum of single-precision products
EQUAL = 1e-24  #: squared distance of equal vectors whose turned values differ by rounding, at most
PART_BITS, DIMS_BITS = 28, 48  #: a class's number: its place in the chunk, above it the chunk, above that the vectors' length
SLACK = 1e-9


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that no square overflows or vanishes."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _rows(column: pa.Array, dims: int) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, dims)


def principal_axes(classes: DataFrame, dims: int) -> np.ndarray:
    """Orthogonal axes by falling variance; tasks add up products, the sums are combined by place.

    Of wide vectors only the leading columns are turned. Distances stay, so this costs skipped pairs only.
    """
    wide, dims = dims, min(dims, TURNED)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims + 1, dims + 1))
        for batch in batches:
            x = np.pad(_unit(_rows(batch.column(0), wide))[:, :dims], ((0, 0), (0, 1)), constant_values=1.0)
            total += x.T @ x
        flat = total.ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat)], names=["place", "total"])

    parts = classes.select("vector").mapInArrow(products, "place long, total double")
    sums = parts.groupBy("place").agg(F.sum("total").alias("total")).toArrow()
    total = np.zeros((dims + 1) ** 2)
    total[sums.column("place").to_numpy()] = sums.column("total").to_numpy()
    total = total.reshape(dims + 1, dims + 1)
    n = max(total[-1, -1], 1.0)
    mean = total[-1, :dims] / n
    _, axes = np.linalg.eigh(total[:dims, :dims] / n - np.outer(mean, mean))
    return np.ascontiguousarray(axes[:, ::-1])


def _lists(x: np.ndarray) -> pa.Array:
    offsets = np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(x.ravel()))


def _unite(roots: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Roots of all nodes after the pairs are linked; every node points at the smallest it reaches."""
    while True:
        p, q = roots[a], roots[b]
        apart = p != q
        if not apart.any():
            return roots
        a, b = a[apart], b[apart]
        p, q = p[apart], q[apart]
        np.minimum.at(roots, np.maximum(p, q), np.minimum(p, q))
        while True:
            further = roots[roots]
            if (further == roots).all():
                break
            roots = further


class Chunk(NamedTuple):
    """A file's classes in grid order: the first one's number, members of each, vectors, their heads, starts of pieces and boxes."""

    first: int
    sizes: np.ndarray
    x: np.ndarray
    heads: np.ndarray
    starts: np.ndarray
    low: np.ndarray
    high: np.ndarray


def _heads(x: np.ndarray) -> np.ndarray:
    """Leading dimensions and the length of the rest: products of two heads are cosines or more."""
    n = max(16, x.shape[1] * 3 // 8)
    rest = np.sqrt(np.einsum("ij,ij->i", x[:, n:], x[:, n:]))
    return np.concatenate((x[:, :n], rest[:, None]), axis=1).astype(np.float32)


def _near(low: np.ndarray, high: np.ndarray, low2: np.ndarray, high2: np.ndarray, epsilon: float) -> np.ndarray:
    """Which boxes of two lists are within epsilon, a row for each box of the first."""
    out = np.empty((len(low), len(low2)), bool)
    for k in range(len(low)):
        gap = np.maximum(0, np.maximum(low[k] - high2, low2 - high[k]))
        out[k] = np.einsum("ij,ij->i", gap, gap) <= (epsilon + SLACK) ** 2
    return out


def _cut(first: int, sizes: np.ndarray, x: np.ndarray) -> Chunk:
    starts = np.arange(0, len(x), LEAF)
    return Chunk(first, sizes, x, _heads(x), starts, np.minimum.reduceat(x, starts), np.maximum.reduceat(x, starts))


def join_chunks(a: Chunk, b: Chunk, limit: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (i in a, j in b) of pairs with cosine >= limit; within one chunk each pair once."""
    same = a is b
    for k, l in zip(*np.nonzero(_near(a.low, a.high, b.low, b.high, np.sqrt(max(0.0, 2 - 2 * limit)))), strict=True):
        if same and l < k:
            continue
        s, s2 = a.starts[k], b.starts[l]
        x, y = a.x[s : s + LEAF], b.x[s2 : s2 + LEAF]
        found = a.heads[s : s + LEAF] @ b.heads[s2 : s2 + LEAF].T >= np.float32(limit - COARSE)
        n = np.count_nonzero(found)
        if not n:
            continue
        if n > found.size // 64:
            found = x @ y.T >= limit - SLACK
        if same and k == l:
            found = np.triu(found, 1)
        touched = np.flatnonzero(found.any(axis=1))
        i, j = np.nonzero(found[touched])
        i = touched[i]
        for at in range(0, len(i), LEAF * 16):
            p, q = i[at : at + LEAF * 16], j[at : at + LEAF * 16]
            left, right = x[p], y[q]
            # Equal vectors link at any limit; they are two classes where they lie in two intervals.
            exact = ((left * right).sum(axis=1) >= limit) | (((left - right) ** 2).sum(axis=1) < EQUAL)
            if exact.any():
                yield p[exact] + s, q[exact] + s2


def _links(a: Chunk, b: Chunk, limit: float) -> pa.RecordBatch:
    """(class, other, n) of a pair of chunks: counts where other is null, else a forest of its links."""
    offset = 0 if a is b else len(a.x)
    sizes = a.sizes if a is b else np.concatenate((a.sizes, b.sizes))
    names = np.arange(len(a.x)) + a.first
    names = names if a is b else np.concatenate((names, np.arange(len(b.x)) + b.first))
    counts, roots = np.zeros(len(names), np.int64), np.arange(len(names))
    held: list[tuple[np.ndarray, np.ndarray]] = []
    n_held = 0

    def settled(roots: np.ndarray) -> np.ndarray:
        p, q = (np.concatenate(side) for side in zip(*held, strict=True))
        np.add.at(counts, p, sizes[q])
        np.add.at(counts, q, sizes[p])
        held.clear()
        return _unite(roots, p, q)

    for p, q in join_chunks(a, b, limit):
        held.append((p, q + offset))
        n_held += len(p)
        if n_held >= PAIRS_HELD:
            roots, n_held = settled(roots), 0
    if held:
        roots = settled(roots)
    told, tied = np.flatnonzero(counts), np.flatnonzero(roots != np.arange(len(roots)))
    other = np.concatenate((np.full(len(told), -1), names[roots[tied]]))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate((names[told], names[tied]))),
            pa.array(other, mask=other < 0),
            pa.array(np.concatenate((counts[told], np.zeros(len(tied), np.int64)))),
        ],
        names=["class", "other", "n"],
    )


def near_duplicates(
    vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", limit: float = 0.95
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row; a link is a cosine of the limit or more.

    Null, empty and zero vectors and those with null or non-finite components link with nothing.
    Vectors of different lengths don't link. Rows with equal vectors link with each other, repeated
    ids included; ids are expected to tell rows apart, and rows of one id are one member each.
    The table is read several times.
    """
    number, values = F.col(f"`{vec_id}`"), F.col(f"`{embedding}`")
    finite = F.forall(values, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) != float("inf")), F.lit(False)))
    real = F.coalesce(finite & F.exists(values, lambda v: v != 0), F.lit(False))
    single = isinstance(vectors.select(values).schema[0].dataType.elementType, FloatType)
    kept = values if single else values.cast("array<double>")
    rows = vectors.select(number.alias("id"), F.when(real, kept).alias("vector"))
    there = rows.filter("vector is not null")
    lengths = there.groupBy(F.size("vector").alias("dims")).agg(F.count("*").alias("n")).orderBy("dims").collect()
    out = rows.filter("vector is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component"))
    parts = [_classes(there.filter(F.size("vector") == r["dims"]), k, r["dims"], r["n"], limit) for k, r in enumerate(lengths)]
    if parts:
        members, found = parts[0]
        for more_members, more_found in parts[1:]:
            members, found = members.union(more_members), found.union(more_found)
        out = _labelled(members, found).union(out)
    return out.select(
        F.col("id").alias(vec_id), "n_links", F.col("component").alias("component_id"),
        F.col("id").eqNullSafe(F.col("component")).alias("kept"),
    )


def _labelled(members: DataFrame, found: DataFrame) -> DataFrame:
    """(id, n_links, component) of rows (class, id, first, mates), where links (class, other, n) connect the classes."""
    counts = found.filter("other is null").groupBy("class").agg(F.sum("n").alias("n"))
    roots = component_roots(found.filter("other is not null").select(F.col("class").alias("a"), F.col("other").alias("b")))
    roots = roots.select(F.col("node").alias("class"), "root")
    lowest = members.select("class", "first").join(roots, "class").groupBy("root").agg(F.min("first").alias("lowest"))
    tags = saved(roots.join(lowest, "root").join(counts, "class", "left").select("class", "lowest", "n"), "linked-classes")
    return members.join(tags, "class", "left").select(
        "id", (F.coalesce("n", F.lit(0)) + F.col("mates") - 1).alias("n_links"), F.coalesce("lowest", "first").alias("component")
    )


def _files(table: DataFrame) -> tuple[str, list[str]]:
    """Files of a written table as tasks read them; unless the machines share them, executors fetch them once."""
    files = sorted(table.inputFiles())
    if all(f.startswith("file:") for f in files):
        return "", [unquote(urlparse(f).path) for f in files]
    folder = files[0].rsplit("/", 1)[0]
    table.sparkSession.sparkContext.addFile(folder, recursive=True)
    return folder.rsplit("/", 1)[-1], [unquote(f.rsplit("/", 1)[-1]) for f in files]


def _classes(own: DataFrame, k: int, dims: int, n: int, limit: float) -> tuple[DataFrame, DataFrame]:
    """Rows (class, id, first, mates) of the n vectors of one length, and the links (class, other, n) of their classes.

    ``first`` is the smallest id of a class, ``mates`` the number of its rows. With other null, n rows of
    other classes link with the class; else a link.
    """
    spark = own.sparkSession
    axes = spark.sparkContext.broadcast(principal_axes(own, dims))
    epsilon = float(np.sqrt(max(0.0, 2 - 2 * limit))) + SLACK
    leading = min(LEADING, dims)
    kind = np.float32 if isinstance(own.schema["vector"].dataType.elementType, FloatType) else np.float64
    interval = max(1, min(INTERVAL, CHUNK_BYTES // (8 * dims)))
    at_once = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chunks = max(-(-n * dims * 8 // CHUNK_BYTES), min(at_once, -(-n // interval)))

    def turned(x: np.ndarray) -> np.ndarray:
        x, n_turned = _unit(x.astype(np.float64)), len(axes.value)
        return np.concatenate((x[:, :n_turned] @ axes.value, x[:, n_turned:]), axis=1)

    def celled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = np.floor(turned(_rows(batch.column(1), dims))[:, :leading] / epsilon).astype(np.int32)
            yield pa.RecordBatch.from_arrays([_lists(cells), *batch.columns], names=["cell", "id", "vector"])

    def cut(batches: list[pa.RecordBatch], start: int) -> tuple[pa.RecordBatch, int]:
        table = pa.Table.from_batches(batches).combine_chunks()
        ids, x = table.column("id").chunk(0), _rows(table.column("vector").chunk(0), dims).astype(kind)
        fresh = np.concatenate(([True], (x[1:] != x[:-1]).any(axis=1)))
        starts, of = np.flatnonzero(fresh), fresh.cumsum() - 1
        sizes = np.diff(starts, append=len(x))
        # The rows of a class come by id, null ids first: its smallest id is the one after them.
        nulls = np.add.reduceat(ids.is_null().to_numpy(zero_copy_only=False).astype(np.int64), starts)
        lowest = ids.take(pa.array((starts + np.where(nulls < sizes, nulls, 0))[of]))
        x = np.ascontiguousarray(x[starts])
        places = turned(x)
        lists = (ids, lowest, pa.array(of), pa.array(sizes[of]))
        blobs = (x, sizes.astype(np.int64), places.min(axis=0), places.max(axis=0))
        offsets = pa.array([0, len(ids)], pa.int32())
        columns = [pa.array([start]), *(pa.ListArray.from_arrays(offsets, v) for v in lists)]
        columns += [pa.array([v.tobytes()], pa.binary()) for v in blobs]
        return pa.RecordBatch.from_arrays(columns, names=schema.names), start + len(x)

    def intervals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = k << DIMS_BITS | TaskContext.get().partitionId() << PART_BITS
        held, rows = [], 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                held.append(batch.slice(at, interval - rows))
                at, rows = at + held[-1].num_rows, rows + held[-1].num_rows
                if rows == interval:
                    out, start = cut(held, start)
                    yield out
                    held, rows = [], 0
        if held:
            yield cut(held, start)[0]

    # The grid order over all tasks; a chunk is what one of them has, cut into intervals of bounded size.
    dealt = own.mapInArrow(celled, StructType([field("cell", ArrayType(IntegerType())), *own.schema.fields]))
    dealt = dealt.withColumns({"hash": F.xxhash64("vector"), "row": F.monotonically_increasing_id()})
    order = ["cell", "hash", "id", "row"]
    ordered = dealt.repartitionByRange(chunks, *order).sortWithinPartitions(*order).select("id", "vector")
    ids, longs = ArrayType(own.schema["id"].dataType), ArrayType(LongType())
    schema = StructType(
        [field("start", LongType()), field("id", ids), field("first", ids), field("of", longs), field("mates", longs)]
        + [field(name, BinaryType()) for name in ("x", "sizes", "low", "high")]
    )
    written = saved(ordered.mapInArrow(intervals, schema), "intervals")
    members = written.select("start", F.inline(F.arrays_zip("id", "first", "of", "mates")))
    members = members.select((F.col("start") + F.col("of")).alias("class"), "id", "first", "mates")
    folder, files = _files(written)

    def read(file: int, columns: list[str]) -> pa.Table:
        at = f"{SparkFiles.get(folder)}/{files[file]}" if folder else files[file]
        return pq.ParquetFile(at).read(columns)

    def joined(column: pa.ChunkedArray, of: type) -> np.ndarray:
        return np.frombuffer(b"".join(column.to_pylist()), of)

    def chunk(file: int) -> Chunk:
        table = read(file, ["start", "x", "sizes"])
        x = turned(joined(table.column("x"), kind).reshape(-1, dims))
        return _cut(table.column("start")[0].as_py(), joined(table.column("sizes"), np.int64), x)

    def boxes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column(0).to_pylist():
                table = read(file, ["low", "high"])
                if table.num_rows:
                    low, high = (joined(table.column(c), np.float64).reshape(-1, dims) for c in ("low", "high"))
                    ends = [pa.array([v.tobytes()], pa.binary()) for v in (low.min(axis=0), high.max(axis=0))]
                    yield pa.RecordBatch.from_arrays([pa.array([file]), *ends], names=["file", "low", "high"])

    box = spark.range(0, len(files), 1, min(len(files), at_once)).mapInArrow(boxes, "file long, low binary, high binary").toArrow()
    filed = box.column("file").to_numpy()
    low, high = (joined(box.column(c), np.float64).reshape(-1, dims) for c in ("low", "high"))
    near = [filed[at:][_near(low[at : at + 1], high[at : at + 1], low[at:], high[at:], epsilon)[0]] for at in range(len(filed))]
    step = max(1, min(CHUNKS_A_TASK, sum(map(len, near)) // (4 * at_once)))
    items = [(int(a), b[at : at + step].tolist()) for a, b in zip(filed, near, strict=True) for at in range(0, len(b), step)]
    given = spark.sparkContext.broadcast(items)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item in batch.column(0).to_pylist():
                a, others = given.value[item]
                mine = chunk(a)
                for b in others:
                    yield _links(mine, mine if a == b else chunk(b), limit)

    tasks = spark.range(0, len(items), 1, min(len(items), MOST_TASKS))
    return members, saved(tasks.mapInArrow(compare, "class long, other long, n long"), "class-links")
