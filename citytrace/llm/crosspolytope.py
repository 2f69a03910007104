"""Approximate nearest neighbours by cross-polytope hashing.

Unit vectors go through fast pseudo-rotations (random signs and a Hadamard transform, three rounds) and
take the nearest signed axis as their cell. Each of the tables is a tree of cells: a cell with more than
``LEAF`` vectors is divided by the next rotation, so leaves stay small at any size and in any hot
direction. Queries visit the leaves of the most likely cells of every level and compare exactly there.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, IntegerType, LongType, StructType

from .shared import field, saved

TABLES = 5
LEVELS = 6  #: divisions of a cell at most; what shares all six is compared in blocks
LEAF = 1024  #: vectors of a leaf that is not divided further
FIRST_AXES, NEXT_AXES = 64, 16  #: axes of the first cell, and of each division
PROBES = (16, 128, 512, 512, 512, 512)  #: cells of each level that a query visits in each table, at most
BANDS = 4  #: bands of length to a doubling, so that the nearest direction has the largest product within a band
SEED = 11
PAIRS_AT_ONCE = 1 << 16  #: exact products of a step
ROWS_AT_ONCE = 512  #: rows of a matrix that is rotated or compared
QUERIES_AT_ONCE = 2048  #: queries that are compared with all rows at a time, where the leaves had too few


@cache
def _signs(table: int, level: int, size: int) -> np.ndarray:
    return np.random.default_rng((SEED, table, level, size)).choice((-1.0, 1.0), (3, size))


def hadamard(x: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of each row, scaled to keep lengths; the width is a power of two."""
    n, size = x.shape
    width = 1
    while width < size:
        pairs = x.reshape(n, -1, 2, width)
        x = np.stack((pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]), axis=2)
        width *= 2
    return x.reshape(n, size) / np.sqrt(size)


def rotated(x: np.ndarray, table: int, level: int) -> np.ndarray:
    """The leading coordinates of the pseudo-rotated rows; level 0 has more of them than the others."""
    axes = FIRST_AXES if level == 0 else NEXT_AXES
    size = max(axes, 1 << (x.shape[1] - 1).bit_length())
    y = np.pad(x, ((0, 0), (0, size - x.shape[1])))
    for signs in _signs(table, level, size):
        y = hadamard(y * signs)
    return y[:, :axes]


def nearest_cell(y: np.ndarray) -> np.ndarray:
    """The nearest signed axis: twice the axis, plus one if it is the negative one."""
    axis = np.abs(y).argmax(axis=1)
    return 2 * axis + (y[np.arange(len(y)), axis] < 0)


def likely_cells(y: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The most likely cells of each row and their penalties, by growing penalty.

    The penalty is what the squared coordinate falls short of the largest one, a negative one in full.
    """
    signed = np.stack((y, -y), axis=2).reshape(len(y), -1)
    top = signed.max(axis=1, keepdims=True)
    penalty = top * top - np.sign(signed) * signed * signed
    cells = np.argsort(penalty, axis=1, kind="stable")[:, :most]
    return cells, np.take_along_axis(penalty, cells, axis=1)


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that no square overflows or vanishes."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and vectors of one length, a bounded number at a time."""
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    for length in np.unique(lengths):
        places = np.flatnonzero(lengths == length)
        for start in range(0, len(places), ROWS_AT_ONCE):
            part = places[start : start + ROWS_AT_ONCE]
            yield part, _matrix(column.take(pa.array(part)))


def products(q: np.ndarray, x: np.ndarray, who: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Inner products of pairs of rows, each summed in one order whatever the company of a pair."""
    steps = range(0, len(who), PAIRS_AT_ONCE)
    parts = [(q[who[k : k + PAIRS_AT_ONCE]] * x[row[k : k + PAIRS_AT_ONCE]]).sum(axis=1) for k in steps]
    return np.concatenate(parts) if parts else np.zeros(0)


def best_of(q: np.ndarray, x: np.ndarray, first: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, product) of the largest products of each query, ties to the smaller ``first``."""
    rough = q @ x.T
    if x.shape[0] > most:
        edge = np.partition(rough, len(x) - most, axis=1)[:, len(x) - most]
        slack = 1e-12 * np.sqrt((q * q).sum(axis=1)) * np.sqrt((x * x).sum(axis=1)).max()
        who, row = np.nonzero(rough >= (edge - slack)[:, None])
    else:
        who, row = (a.ravel() for a in np.indices(rough.shape))
    exact = products(q, x, who, row)
    order = np.lexsort((first[row], -exact, who))
    who, row, exact = who[order], row[order], exact[order]
    starts = np.searchsorted(who, np.arange(len(q)))
    kept = np.arange(len(who)) - starts[who] < most
    return who[kept], row[kept], exact[kept]


def _classes(rows: DataFrame, most: int) -> DataFrame:
    """One row for each distinct vector: class, vector, dims, band, and its smallest ids.

    Copies are cut to the ``most`` smallest ids in each task before they meet, so a vector of any number of
    rows is a small group. Further ids can't be among the nearest, since ties go to the smaller id.
    """
    window = Window.partitionBy("vector").orderBy("id")
    few = rows.distinct().withColumn("place", F.row_number().over(window)).filter(F.col("place") <= most)
    grouped = few.groupBy("vector").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    top = F.array_max(F.transform("vector", lambda v: F.abs(v.cast("double"))))
    squares = F.aggregate("vector", F.lit(0.0), lambda s, v: s + F.pow(v.cast("double") / top, F.lit(2.0)))
    band = F.round((F.log2(top) + F.log2(squares) / 2) * BANDS).cast("int")
    return grouped.select(
        F.monotonically_increasing_id().alias("class"),
        "vector",
        F.size("vector").alias("dims"),
        band.alias("band"),
        "ids",
        F.array_min("ids").alias("first"),
    )


def _hashed(classes: DataFrame) -> DataFrame:
    """(class, dims, band, cells): the cells of all levels of all tables, a byte each."""
    schema = StructType(
        [*[classes.schema[name] for name in ("class", "dims", "band")], field("cells", BinaryType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = np.zeros((batch.num_rows, TABLES * LEVELS), np.uint8)
            for places, x in _by_length(batch.column(3)):
                x = _unit(x)
                for k in range(TABLES * LEVELS):
                    cells[places, k] = nearest_cell(rotated(x, k // LEVELS, k % LEVELS))
            packed = pa.array([row.tobytes() for row in cells], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(3)), packed], names=schema.names)

    return classes.select("class", "dims", "band", "vector").mapInArrow(run, schema)


def _no_path() -> Column:
    return F.lit("").cast("binary")


def _key(path: Column) -> Column:
    """Name of a cell: 64 bits of its place. Two cells of one name are compared together, nothing is lost."""
    return F.xxhash64("dims", "band", "table", path)


def index(classes: DataFrame, leaf: int = LEAF) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """Every class at its leaf of each table (class, key), the cells of level 0 (dims, band, n), and for each
    further level the sizes (key, n) of its cells.

    All vectors of one length and band are the cell of level 0; it is one leaf for all tables if it is small.
    A level counts its cells, files the small ones as leaves and divides the others.
    """
    hashed = saved(_hashed(classes), "cells")
    roots = saved(hashed.groupBy("dims", "band").agg(F.count("*").alias("n")), "roots")
    small = hashed.join(roots.filter(F.col("n") <= leaf), ["dims", "band"]).withColumn("table", F.lit(0))
    filed = [small.select("class", _key(_no_path()).alias("key"))]
    large = hashed.join(roots.filter(F.col("n") > leaf).drop("n"), ["dims", "band"])
    left = large.withColumn("table", F.explode(F.array(*[F.lit(t) for t in range(TABLES)]))).select(
        "class", "dims", "band", "table", F.substring("cells", F.col("table") * LEVELS + 1, F.lit(LEVELS)).alias("path")
    )
    levels: list[DataFrame] = []
    while len(levels) < LEVELS:
        named = saved(left.withColumn("key", _key(F.substring("path", 1, len(levels) + 1))), "divided")
        if named.isEmpty():
            break
        sizes = saved(named.groupBy("key").agg(F.count("*").alias("n")), "sizes")
        levels.append(sizes)
        is_leaf = (F.col("n") <= leaf) | F.lit(len(levels) == LEVELS)
        filed.append(named.join(sizes.filter(is_leaf), "key").select("class", "key"))
        left = named.join(sizes.filter(~is_leaf).drop("n"), "key").drop("key")
    leaves = filed[0]
    for more in filed[1:]:
        leaves = leaves.unionByName(more)
    return saved(leaves, "leaves"), roots, levels


_PATH = StructType([field("path", BinaryType()), field("penalty", DoubleType())])
_VISIT = StructType(
    [
        field("asker", LongType()),
        *[field(name, IntegerType()) for name in ("dims", "band", "table")],
        *_PATH.fields,
    ]
)


def _next_cells(front: DataFrame, level: int) -> DataFrame:
    """The most likely cells of a level below the divided cells (path, penalty) that each query has visited.

    The best sums of penalties go on from those of the level before, so none better is missed.
    """
    most = PROBES[level]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            tables = whole.column(3).to_numpy(zero_copy_only=False)
            for table in np.unique(tables):
                batch = whole.take(pa.array(np.flatnonzero(tables == table)))
                visited = batch.column(5).to_pylist()
                for places, x in _by_length(batch.column(4)):
                    cells, penalty = likely_cells(rotated(_unit(x), int(table), level), most)
                    paths: list[bytes] = []
                    sums: list[np.ndarray] = []
                    for row, place in enumerate(places):
                        before = np.array([v["penalty"] for v in visited[place]])
                        total = (before[:, None] + penalty[row]).ravel()
                        kept = np.argsort(total, kind="stable")[:most]
                        sums.append(total[kept])
                        at, cell = np.divmod(kept, cells.shape[1])
                        paths += [
                            visited[place][k]["path"] + bytes((c,)) for k, c in zip(at, cells[row][cell].tolist(), strict=True)
                        ]
                    of = np.repeat(places, list(map(len, sums)))
                    yield pa.RecordBatch.from_arrays(
                        [
                            *(batch.column(k).take(pa.array(of)) for k in range(4)),
                            pa.array(paths, pa.binary()),
                            pa.array(np.concatenate(sums)),
                        ],
                        names=_VISIT.names,
                    )

    return front.select("asker", "dims", "band", "table", "vector", "visited").mapInArrow(run, _VISIT)


def _probes(asked: DataFrame, roots: DataFrame, levels: list[DataFrame], leaf: int) -> DataFrame:
    """(asker, key, n) of the leaves that each query vector visits, in every band of lengths.

    A query goes on only below divided cells that it visits, so a hot direction costs its own queries alone.
    """
    asked = asked.select(F.col("class").alias("asker"), "vector", "dims")
    started = asked.join(roots, "dims")
    at_root = started.filter(F.col("n") <= leaf).withColumn("table", F.lit(0))
    found = [at_root.select("asker", _key(_no_path()).alias("key"), "n")]
    whole = F.struct(_no_path().alias("path"), F.lit(0.0).alias("penalty"))
    front = started.filter(F.col("n") > leaf).withColumn("visited", F.array(whole))
    front = front.withColumn("table", F.explode(F.array(*[F.lit(t) for t in range(TABLES)])))
    for level, sizes in enumerate(levels):
        cells = _next_cells(front, level).withColumn("key", _key(F.col("path")))
        cells = saved(cells.join(sizes, "key"), "visited")
        is_leaf = (F.col("n") <= leaf) | F.lit(level + 1 == LEVELS)
        found.append(cells.filter(is_leaf).select("asker", "key", "n"))
        below = cells.filter(~is_leaf).groupBy("asker", "dims", "band", "table")
        below = below.agg(F.collect_list(F.struct("path", "penalty")).alias("visited"))
        front = below.join(asked.select("asker", "vector"), "asker")
    probes = found[0]
    for more in found[1:]:
        probes = probes.unionByName(more)
    return probes


_FOUND = StructType(
    [field("asker", LongType()), field("class", LongType()), field("first", LongType()), field("score", DoubleType())]
)


def _searched(classes: DataFrame, leaves: DataFrame, probes: DataFrame, most: int, leaf: int) -> DataFrame:
    """(asker, class, first, score) of the best of each visited leaf, at most ``most`` a query and block.

    A leaf that no division could make small, and a leaf that very many queries visit, are compared in
    blocks, a block of vectors with a block of queries to a task.
    """
    asked = probes.groupBy("key").agg(F.count("*").alias("askers"), F.max("n").alias("n"))
    plan = asked.select(
        "key", F.ceil(F.col("n") / leaf).cast("int").alias("blocks"), F.ceil(F.col("askers") / leaf).cast("int").alias("parts")
    )
    plan = saved(plan, "plan")
    vectors = classes.select("class", "first", "vector")
    left = (
        leaves.join(plan, "key")
        .join(vectors, "class")
        .withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select("key", "block", "part", "class", "first", "vector")
    )
    right = (
        probes.drop("n")
        .join(plan, "key")
        .join(classes.select(F.col("class").alias("asker"), "vector"), "asker")
        .withColumn("part", F.pmod(F.xxhash64("asker"), F.col("parts")).cast("int"))
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(*[F.col(name).alias(f"of_{name}") for name in ("key", "block", "part", "asker", "vector")])
    )
    place = ["key", "block", "part"]

    def search(rows: pa.Table, askers: pa.Table) -> pa.Table:
        columns = [pa.array([], pa.int64())] * 3 + [pa.array([], pa.float64())]
        if rows.num_rows and askers.num_rows:
            rows, askers = rows.combine_chunks(), askers.combine_chunks()
            x, q = (_matrix(t.column(name).combine_chunks()) for t, name in ((rows, "vector"), (askers, "of_vector")))
            first = rows.column("first").to_numpy()
            who, row, score = best_of(q, x, first, most)
            columns = [
                pa.array(askers.column("of_asker").to_numpy()[who]),
                pa.array(rows.column("class").to_numpy()[row]),
                pa.array(first[row]),
                pa.array(score),
            ]
        return pa.Table.from_arrays(columns, names=_FOUND.names)

    return left.groupBy(*place).cogroup(right.groupBy(*[f"of_{name}" for name in place])).applyInArrow(search, _FOUND)


def _against_all(classes: DataFrame, asked: DataFrame, most: int) -> DataFrame:
    """(asker, class, first, score) by comparing queries with every vector of their length, in blocks of queries.

    Each step of a task answers with its own best, which the window over a query cuts again in every task.
    """
    found = None
    slices = -(-asked.count() // QUERIES_AT_ONCE)
    context = classes.sparkSession.sparkContext
    for k in range(slices):
        block = asked.filter(F.pmod(F.xxhash64("asker"), F.lit(slices)) == k).select("asker", "vector").toArrow()
        shared = context.broadcast([(block.column("asker").to_numpy(), block.column("vector").to_pylist())])

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            number, vectors = shared.value[0]
            of_length = {n: [i for i, v in enumerate(vectors) if len(v) == n] for n in set(map(len, vectors))}
            for batch in batches:
                for places, x in _by_length(batch.column(2)):
                    own = of_length.get(x.shape[1], [])
                    if not own:
                        continue
                    q = np.array([vectors[i] for i in own], np.float64)
                    first = batch.column(1).to_numpy(zero_copy_only=False)[places]
                    who, row, score = best_of(q, x, first, most)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(number[own][who]),
                            pa.array(batch.column(0).to_numpy(zero_copy_only=False)[places][row]),
                            pa.array(first[row]),
                            pa.array(score),
                        ],
                        names=_FOUND.names,
                    )

        part = classes.select("class", "first", "vector").mapInArrow(run, _FOUND)
        found = part if found is None else found.unionByName(part)
    return found


def _nearest(found: DataFrame, classes: DataFrame, most: int) -> DataFrame:
    """(asker, near): the ``most`` nearest rows of each query vector as (score, id), nearest first."""
    order = [F.col("score").desc(), F.col("first").asc(), F.col("class").asc()]
    ranked = found.withColumn("place", F.dense_rank().over(Window.partitionBy("asker").orderBy(*order)))
    best = ranked.filter(F.col("place") <= most).groupBy("asker", "class").agg(F.max("score").alias("score"))
    rows = best.join(classes.select("class", "ids"), "class").select("asker", "score", F.explode("ids").alias("id"))
    placed = rows.withColumn(
        "place", F.row_number().over(Window.partitionBy("asker").orderBy(F.col("score").desc(), F.col("id").asc()))
    ).filter(F.col("place") <= most)
    near = F.array_sort(F.collect_list(F.struct("place", "score", "id")))
    return placed.groupBy("asker").agg(near.alias("near"))


def nearest_neighbours(
    vectors: DataFrame,
    is_query=None,
    k: int = 20,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    leaf: int = LEAF,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k rows of largest inner product that each query's probes find.

    Every row is indexed. Queries are the rows with an id divisible by 20, or those of ``is_query``, a function
    of the id column. A query's own id is no candidate. Scores are inner products of the original vectors in
    double precision; ties go to the smaller id. A query whose leaves hold fewer than k rows is compared with
    all rows of its length, so it has k of them or all.

    Null, empty and zero vectors, vectors with null or non-finite components and rows without an id take no
    part. Vectors of different lengths are no candidates of each other. Repeated rows count once; an id with
    several vectors is a row for each of them. An empty table gives an empty result.
    """
    most = k + 1  # the query itself may be among the nearest
    number, values = F.col(f"`{vec_id}`"), F.col(f"`{embedding}`")
    finite = F.forall(values, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    usable = number.isNotNull() & values.isNotNull() & (F.size(values) > 0) & finite & F.exists(values, lambda v: v != 0)
    rows = vectors.filter(usable).select(number.cast("long").alias("id"), values.alias("vector"))
    classes = saved(_classes(rows, most), "vectors")
    wanted = is_query or (lambda column: F.pmod(column, F.lit(20)) == 0)
    askers = rows.filter(wanted(F.col("id"))).distinct().join(classes.select("vector", "class", "dims"), "vector")
    askers = saved(askers.select("id", F.col("class").alias("asker"), "dims"), "queries")
    distinct = askers.select(F.col("asker").alias("class")).distinct()
    asked = saved(classes.join(distinct, "class", "left_semi").select("class", "vector", "dims"), "asked")

    leaves, roots, levels = index(classes, leaf)
    probes = saved(_probes(asked, roots, levels, leaf), "probes")
    near = saved(_nearest(_searched(classes, leaves, probes, most, leaf), classes, most), "near")

    # As many rows as there are, but no more than asked for.
    totals = classes.groupBy("dims").agg(F.sum(F.size("ids")).alias("total"))
    had = near.select(F.col("asker").alias("had_by"), F.size("near").alias("had"))
    short = asked.join(had, F.col("class") == F.col("had_by"), "left").join(totals, "dims")
    short = short.filter(F.coalesce("had", F.lit(0)) < F.least(F.lit(most), "total"))
    short = saved(short.select(F.col("class").alias("asker"), "vector"), "short")
    if not short.isEmpty():
        more = _nearest(_against_all(classes, short, most), classes, most)
        near = near.join(short.select("asker"), "asker", "left_anti").unionByName(more)

    others = F.slice(F.filter("near", lambda n: n["id"] != F.col("id")), 1, k)
    listed = askers.join(near, "asker").select("id", F.posexplode(others).alias("place", "row"))
    return listed.select(
        F.col("id").alias("query_id"),
        (F.col("place") + 1).alias("rank"),
        F.col("row.id").alias("vec_id"),
        F.col("row.score").alias("score"),
    )
