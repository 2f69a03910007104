"""What several operators share: tables in the shared folder, Arrow passes over whole rows, components."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from citytrace.session import checkpoint_dir


def saved(df: DataFrame, name: str) -> DataFrame:
    """The frame written once to the shared folder and read back, so that no later step repeats it."""
    path = f"{checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of an Arrow batch; documents are long, and a batch is held several times over.
BATCH_ROWS = 512
_BATCH_KEY, _SPARK_DEFAULT = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"


def small_batches(df: DataFrame) -> DataFrame:
    """The frame, after the session's Arrow batches are made small unless it has a size of its own."""
    conf = df.sparkSession.conf
    if conf.get(_BATCH_KEY) == _SPARK_DEFAULT:
        conf.set(_BATCH_KEY, str(BATCH_ROWS))
    return df


def with_columns_from_text(
    df: DataFrame,
    text: str,
    added: StructType,
    make: Callable[[], Callable[[list[str | None]], list[pa.Array]]],
) -> DataFrame:
    """Every input row as the struct ``row``, next to columns computed from its text.

    ``make`` runs once per task and returns the function of a batch of texts. The input row travels
    in one struct, so its names never clash with the added ones.
    """
    packed = df.select(F.struct(*[F.col(f"`{name}`") for name in df.columns]).alias("row"))
    place = df.columns.index(text)
    schema = StructType([packed.schema["row"], *added.fields])
    types = [field.type for field in to_arrow_schema(added)]
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = make()
        for batch in batches:
            row = batch.column(0)
            found = function(row.field(place).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [row, *[a if isinstance(a, pa.Array) else pa.array(a, t) for a, t in zip(found, types, strict=True)]],
                names=names,
            )

    return small_batches(packed).mapInArrow(run, schema)


def field(name: str, kind: object) -> StructField:
    return StructField(name, kind)


def ascii_lower(value: Column) -> Column:
    """A-Z only, whatever the locale."""
    return F.translate(value, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def quarter(doc_id: Column) -> Column:
    """crc32 of the id as text, mod 4; the remainder 2 is held out from learning."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def held_out(doc_id: Column) -> Column:
    """True on the held-out quarter; a null id is never learned from."""
    return F.coalesce(quarter(doc_id) == 2, F.lit(True))


def _scrambled(value: Column) -> Column:
    """A bijection of 64-bit values (xorshift), so that every round ranks nodes in a new random order."""
    value = value.bitwiseXOR(F.lit(0x5DEECE66D1CE4E5B))
    value = value.bitwiseXOR(F.shiftleft(value, 13))
    value = value.bitwiseXOR(F.shiftrightunsigned(value, 7))
    return value.bitwiseXOR(F.shiftleft(value, 17))


def component_roots(edges: DataFrame) -> DataFrame:
    """(node, root): equal roots for the nodes that links (a, b) connect; only nodes with a link.

    Rounds of random contraction: each node points to the neighbour of lowest rank, links are carried
    to those, and ranks are drawn anew. Every round removes a constant share of the nodes of any
    shape of graph, chains and stars alike. Minima are combined before the shuffle, so the degree of
    a node does not matter.
    """
    edges = saved(edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")), "edges")
    links = edges.filter("a <> b").select(_scrambled(F.col("a")).alias("a"), _scrambled(F.col("b")).alias("b")).distinct()
    nodes = (
        edges.select(F.col("a").alias("node"))
        .union(edges.select("b"))
        .distinct()
        .select("node", _scrambled(F.col("node")).alias("root"))
    )
    while not links.isEmpty():
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = saved(
            both.groupBy("a")
            .agg(F.min("b").alias("low"))
            .select(F.col("a").alias("at"), _scrambled(F.least("a", "low")).alias("to")),
            "parents",
        )
        nodes = saved(
            nodes.join(parents, F.col("root") == F.col("at"), "left").select(
                "node", F.coalesce("to", _scrambled(F.col("root"))).alias("root")
            ),
            "nodes",
        )
        start, end = parents.toDF("a", "from_a"), parents.toDF("b", "from_b")
        links = saved(
            links.join(start, "a")
            .join(end, "b")
            .select(F.col("from_a").alias("a"), F.col("from_b").alias("b"))
            .filter("a <> b")
            .distinct(),
            "links",
        )
    return nodes
