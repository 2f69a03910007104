"""Quality classifier: regularised quadratic discriminant over transformed document statistics."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructType

from .shared import field, held_out, saved, with_columns_from_text

SHRINKAGE = 0.3  #: share of the pooled covariance in that of a class
RIDGE = 0.1  #: share of the mean variance on the diagonal
THRESHOLD = 0.7

#: Names of the statistics, in the order of ``statistics_of``.
STATISTICS = (
    "log_words", "word_length", "upper", "digits", "exclaims", "signs", "bars", "stops", "commas", "other_marks",
    "line_rate", "distinct_words", "repeats_next", "repeated_lines", "entropy", "top_word",
)


def _codes(chars: str) -> np.ndarray:
    return np.frombuffer(chars.encode(), np.uint8)


_UPPER, _DIGITS, _SIGNS = _codes("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _codes("0123456789"), _codes("*#$%&^~_=+<>@\\")
_OTHER = _codes("\"'();:-/[]{}?`")
_LETTERS = np.concatenate((np.arange(65, 91), np.arange(97, 123), np.arange(192, 256)))


def statistics_of(text: str | None) -> np.ndarray:
    """Transformed statistics of a whole text; null is empty. Shares are on a log scale."""
    data = (text or "").encode("utf-8", "surrogatepass")
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    words = data.split()
    n = max(1, len(words))
    letters = max(1, int(counts[_LETTERS].sum()))
    lines = [line for line in data.split(b"\n") if line.strip()]
    seen: dict[bytes, int] = {}
    for word in words:
        seen[word] = seen.get(word, 0) + 1
    most = max(seen.values(), default=0)
    again = sum(a == b for a, b in zip(words, words[1:], strict=False))
    shares = counts[counts > 0] / max(1, len(data))
    rate = lambda x, of: np.log(x / of + 0.002)
    return np.array(
        [
            np.log1p(len(words)),
            np.log1p(sum(map(len, words)) / n),
            rate(int(counts[_UPPER].sum()), letters),
            rate(int(counts[_DIGITS].sum()), letters),
            rate(int(counts[33]), n),
            rate(int(counts[_SIGNS].sum()), n),
            rate(int(counts[124]), n),
            rate(int(counts[46]), n),
            rate(int(counts[44]), n),
            rate(int(counts[_OTHER].sum()), n),
            rate(len(lines), n),
            # Distinct words fall with length by a power; what is left is repetition.
            np.log(max(1, len(seen)) / n**0.85),
            rate(again, n),
            rate(len(lines) - len(set(lines)), max(1, len(lines))),
            float(-(shares * np.log(shares)).sum()),
            rate(most, n),
        ]
    )


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Each input row as ``row`` with ``x``, its statistics."""

    def make() -> Callable:
        return lambda texts: [[statistics_of(t).tolist() for t in texts]]

    return with_columns_from_text(docs, text, StructType([field("x", ArrayType(DoubleType()))]), make)


@dataclass
class Discriminant:
    """Means, inverse Cholesky factors, and log-density constants of classes 0 and 1."""

    mean: list[np.ndarray]
    whiten: list[np.ndarray]
    constant: list[float]

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1: the sigmoid of the difference of the log-densities."""
        logs = [
            c - 0.5 * (((x - m) @ w.T) ** 2).sum(axis=1)
            for m, w, c in zip(self.mean, self.whiten, self.constant, strict=True)
        ]
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))


def fit(labelled: DataFrame, label: str = "label") -> Discriminant | float:
    """Learn from all rows with statistics ``x`` and a label 0 or 1; no sample is drawn.

    Tasks add up counts, sums and products; only those of the two classes reach the driver. Without
    rows of both classes the share of class 1 is returned (a half if there is none).
    """
    size = len(STATISTICS)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = np.asarray(batch.column(0).to_pylist(), np.int64)
            x = np.asarray(batch.column(1).to_pylist(), float).reshape(len(labels), size)
            for k in (0, 1):
                own = x[labels == k]
                if len(own):
                    total = np.concatenate(([len(own)], own.sum(axis=0), (own.T @ own).ravel()))
                    yield pa.RecordBatch.from_pydict(
                        {"label": np.full(len(total), k), "place": np.arange(len(total)), "total": total}
                    )

    rows = labelled.filter(F.col(label).isin(0, 1)).select(F.col(label).cast("int").alias("label"), "x")
    parts = rows.mapInArrow(sums, "label long, place long, total double")
    found = parts.groupBy("label", "place").agg(F.sum("total").alias("total")).collect()
    totals = np.zeros((2, 1 + size + size * size))
    for row in found:
        totals[row["label"], row["place"]] = row["total"]
    counts = totals[:, 0]
    if (counts < 2).any():
        return float(counts[1] / counts.sum()) if counts.sum() else 0.5
    means = totals[:, 1 : 1 + size] / counts[:, None]
    scatter = [totals[k, 1 + size :].reshape(size, size) - counts[k] * np.outer(means[k], means[k]) for k in (0, 1)]
    pooled = (scatter[0] + scatter[1]) / counts.sum()
    scale = np.sqrt(np.maximum(np.diag(pooled), 1e-8))
    model = Discriminant([], [], [])
    for k in (0, 1):
        own = (1 - SHRINKAGE) * scatter[k] / counts[k] + SHRINKAGE * pooled
        own = own + RIDGE * np.diag(scale**2)
        factor = np.linalg.cholesky(own)
        model.mean.append(means[k])
        model.whiten.append(np.linalg.inv(factor))
        model.constant.append(float(np.log(counts[k] / counts.sum()) - np.log(np.diag(factor)).sum()))
    return model


def scored(found: DataFrame, model: Discriminant | float) -> DataFrame:
    """Rows with ``x`` and then ``score``; the factors are sent once."""
    shared = found.sparkSession.sparkContext.broadcast(model)
    schema = StructType([*found.schema.fields, field("score", DoubleType())])
    place = found.columns.index("x")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            x = np.asarray(batch.column(place).to_pylist(), float).reshape(batch.num_rows, len(STATISTICS))
            scores = np.full(len(x), model) if isinstance(model, float) else model.scores(x)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], names=schema.names)

    return found.mapInArrow(run, schema)


def classified(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality"
) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row, learned from labelled rows that are not held out.

    Null and empty texts have the statistics of an empty text and a score like any other. Null labels
    and ids teach nothing; of repeated labels each counts.
    """
    narrow = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    found = saved(statistics(narrow).select("row.id", "x"), "statistics")
    known = labels.select(F.col(f"`{doc_id}`").alias("of"), F.col(f"`{label}`").alias("label"))
    known = known.filter(F.col("label").isNotNull() & ~held_out(F.col("of")))
    model = fit(found.join(known, F.col("id") == F.col("of")))
    return scored(found, model).select(
        F.col("id").alias(doc_id),
        held_out(F.col("id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
