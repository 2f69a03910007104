"""Language ID: a bidirectional gated recurrent network over bytes, trained in numpy.

A text is cut into windows of bytes; every position of every window is labelled by the states of a
forward and a backward gated recurrent network, and the positions' probabilities are averaged over
the document. Training is backpropagation through time with Adam, on a bounded, documented sample.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructType

from .shared import field, held_out, with_columns_from_text

UNDETERMINED = "und"
SPAN = 64  #: bytes of a window; a text is padded to whole windows
HIDDEN = 8  #: units of each direction
SAMPLE_DOCS = 300  #: training documents of each language, at most
SAMPLE_WINDOWS = 12  #: windows of each training document, spread over its whole text
STEPS = 220
BATCH = 192
LEARNING_RATE = 0.02
MAX_LANGUAGES = 512  #: the labels come to the driver, so there is a stated bound; more raise an error
WINDOWS_AT_ONCE = 2048


@dataclass
class Network:
    """Weights: for each direction input table (3H x 257), recurrent matrix (3H x H); output (L x 2H)."""

    languages: list[str]
    table: list[np.ndarray]
    recurrent: list[np.ndarray]
    inner: list[np.ndarray]
    out: np.ndarray
    bias: np.ndarray


def windows_of(data: bytes) -> np.ndarray:
    """Rows of SPAN codes; 0..255 are bytes, and 256 fills the last row up."""
    n = max(1, -(-len(data) // SPAN))
    codes = np.full(n * SPAN, 256, np.int16)
    codes[: len(data)] = np.frombuffer(data, np.uint8)
    return codes.reshape(n, SPAN)


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _run(net: Network, codes: np.ndarray, keep: bool = False) -> tuple[np.ndarray, list]:
    """States of both directions (SPAN x 2H x B), and with keep what the gradient needs."""
    span, batch = codes.shape
    kind = net.out.dtype
    hidden = net.recurrent[0].shape[1]
    states = np.empty((span, 2 * hidden, batch), kind)
    trace: list = [[], []]
    half = kind.type(0.5)
    for way in (0, 1):
        gates, inner = net.recurrent[way], net.inner[way]
        h = np.zeros((hidden, batch), kind)
        for t in range(span) if way == 0 else range(span - 1, -1, -1):
            x = np.take(net.table[way], codes[t], axis=1, mode="clip")
            rec = gates @ h
            both = np.tanh((x[: 2 * hidden] + rec[: 2 * hidden]) * half)
            both *= half
            both += half
            z, r = both[:hidden], both[hidden:]
            cand = rec[2 * hidden :] + inner
            n = np.tanh(x[2 * hidden :] + r * cand)
            new = n + z * (h - n)
            if keep:
                trace[way].append((t, h, z, r, n, cand))
            h = new
            states[t, way * hidden : (way + 1) * hidden] = h
    return states, trace


def _softmax(logits: np.ndarray) -> np.ndarray:
    logits = logits - logits.max(axis=-2, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=-2, keepdims=True)
    return logits


def gradients(net: Network, codes: np.ndarray, target: np.ndarray) -> list[np.ndarray]:
    """Gradients of the mean cross-entropy over all real positions, through time, in the order of the weights."""
    span, batch = codes.shape
    hidden = net.recurrent[0].shape[1]
    states, trace = _run(net, codes, keep=True)
    probs = _softmax(np.matmul(net.out, states) + net.bias)
    real = codes < 256
    error = probs
    error[:, target, np.arange(batch)] -= 1
    error *= (real / max(1, real.sum()))[:, None, :]
    g_out = np.einsum("tkb,thb->kh", error, states, optimize=True)
    g_bias = error.sum(axis=(0, 2))[:, None]
    g_states = np.matmul(net.out.T, error)
    grads: list[list[np.ndarray]] = [[], [], []]
    for way in (0, 1):
        g_inputs = np.empty((span, 3 * hidden, batch))
        g_rec, g_inner = np.zeros_like(net.recurrent[way]), np.zeros_like(net.inner[way])
        carry = np.zeros((hidden, batch))
        for t, h, z, r, n, cand in reversed(trace[way]):
            carry = carry + g_states[t, way * hidden : (way + 1) * hidden]
            d_n = carry * (1 - z) * (1 - n * n)
            d_z = carry * (h - n) * z * (1 - z)
            d_r = d_n * cand * r * (1 - r)
            d_cand = d_n * r
            d_rec = np.concatenate((d_z, d_r, d_cand))
            g_inputs[t] = np.concatenate((d_z, d_r, d_n))
            g_rec += d_rec @ h.T
            g_inner += d_cand.sum(axis=1, keepdims=True)
            carry = carry * z + net.recurrent[way].T @ d_rec
        seen = codes.ravel()
        g_table = [np.bincount(seen, g_inputs[:, unit].ravel(), 257) for unit in range(3 * hidden)]
        grads[0].append(np.array(g_table))
        grads[1].append(g_rec)
        grads[2].append(g_inner)
    return [*grads[0], *grads[1], *grads[2], g_out, g_bias]


def train(languages: list[str], windows: np.ndarray, labels: np.ndarray, seed: int = 7) -> Network:
    """Backpropagation through time over random batches of windows; every position has the label."""
    rng = np.random.default_rng(seed)
    hidden, n_out = HIDDEN, len(languages)
    net = Network(
        languages,
        [rng.normal(0, 0.3, (3 * hidden, 257)) for _ in range(2)],
        [rng.normal(0, 0.4, (3 * hidden, hidden)) for _ in range(2)],
        [np.zeros((hidden, 1)) for _ in range(2)],
        rng.normal(0, 0.3, (n_out, 2 * hidden)),
        np.zeros((n_out, 1)),
    )
    weights = [*net.table, *net.recurrent, *net.inner, net.out, net.bias]
    moment, square = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    # Every language has the same chance to be drawn, whatever its share.
    by_label = [np.flatnonzero(labels == k) for k in range(n_out)]
    by_label = [rows for rows in by_label if len(rows)]
    for step in range(1, STEPS + 1):
        label_rows = rng.integers(len(by_label), size=BATCH)
        picked = np.array([by_label[k][rng.integers(len(by_label[k]))] for k in label_rows])
        codes, target = np.ascontiguousarray(windows[picked].T), labels[picked]
        found = gradients(net, codes, target)
        rate = LEARNING_RATE * min(1.0, 2.0 * (1 - step / (STEPS + 1)))
        for w, g, m, s in zip(weights, found, moment, square, strict=True):
            g = np.clip(g, -1, 1)
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
    single = lambda arrays: [a.astype(np.float32) for a in arrays]
    return Network(
        languages, single(net.table), single(net.recurrent), single(net.inner), *single([net.out, net.bias])
    )


def document_probabilities(net: Network, texts: list[str | None]) -> np.ndarray:
    """Mean over all positions of each text (rows x languages); an empty text has an even spread.

    Windows of all texts run side by side in blocks of fixed size, so a long text needs no more
    memory than a short one.
    """
    n_out = len(net.languages)
    totals, counts = np.zeros((len(texts), n_out)), np.zeros(len(texts))
    held: list[np.ndarray] = []
    owners: list[np.ndarray] = []
    size = 0

    def flush() -> None:
        nonlocal size
        if not size:
            return
        codes, owner = np.concatenate(held), np.concatenate(owners)
        held.clear()
        owners.clear()
        size = 0
        for at in range(0, len(codes), WINDOWS_AT_ONCE):
            part, rows = np.ascontiguousarray(codes[at : at + WINDOWS_AT_ONCE].T), owner[at : at + WINDOWS_AT_ONCE]
            states, _ = _run(net, part)
            real = part < 256
            summed = np.zeros((n_out, part.shape[1]), np.float32)
            for t in range(part.shape[0]):
                summed += _softmax(net.out @ states[t] + net.bias) * real[t]
            np.add.at(totals, rows, summed.T)
            np.add.at(counts, rows, real.sum(axis=0))

    for row, text in enumerate(texts):
        data = _bytes(text)
        if data:
            codes = windows_of(data)
            held.append(codes)
            owners.append(np.full(len(codes), row))
            size += len(codes)
        if size >= 8 * WINDOWS_AT_ONCE:
            flush()
    flush()
    return np.where(counts[:, None] > 0, totals / np.maximum(counts, 1)[:, None], 1 / max(1, n_out))


def _sample(docs: DataFrame, doc_id: str, text: str, lang: str) -> list[tuple[str, int, tuple[str, ...]]]:
    """Up to SAMPLE_DOCS training texts of each language, by the order of a hash of the id.

    A cut on the hash, from the counts of the languages, leaves a small multiple of the wanted rows;
    the exact choice is made among those.
    """
    known = docs.select(
        F.col(f"`{doc_id}`").alias("id"), F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text")
    ).filter(F.col("lang").isNotNull() & ~held_out(F.col("id")) & F.coalesce(F.length("text") > 0, F.lit(False)))
    draw = F.pmod(F.xxhash64("id"), F.lit(1 << 40)) / float(1 << 40)
    counts = known.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    share = {row["lang"]: 2.0 * SAMPLE_DOCS / row["count"] for row in counts}
    wanted = F.lit(False)
    for name, part in sorted(share.items()):
        wanted = wanted | ((F.col("lang") == name) & (F.col("draw") < part))
    drawn = known.withColumn("draw", draw).filter(wanted)
    # The pieces of a text that are looked at, spread over all of it.
    size, wide = F.length("text"), SPAN * 2
    step = F.greatest((size - wide) / float(SAMPLE_WINDOWS - 1), F.lit(1.0))
    pieces = F.transform(
        F.sequence(F.lit(0), F.least(F.lit(SAMPLE_WINDOWS - 1), F.floor(size / wide).cast("int"))),
        lambda k: F.substring("text", (k * step).cast("int") + 1, F.lit(wide)),
    )
    drawn = drawn.select("id", "lang", "draw", pieces.alias("pieces"))
    order = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "id", "pieces"))
    rows = drawn.withColumn("place", order).filter(F.col("place") <= SAMPLE_DOCS).select("lang", "pieces", "place")
    return sorted((r["lang"], r["place"], tuple(r["pieces"])) for r in rows.collect())


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Network | None:
    """The network learned from labelled rows that are not held out; None if there is no such row."""
    rows = _sample(docs, doc_id, text, lang)
    if not rows:
        return None
    languages = sorted({name for name, _, _ in rows})
    place = {name: k for k, name in enumerate(languages)}
    found = [(windows_of(_bytes(piece)[:SPAN]), place[name]) for name, _, pieces in rows for piece in pieces if piece]
    return train(languages, np.concatenate([w for w, _ in found]), np.array([k for _, k in found]))


def predict(docs: DataFrame, net: Network | None, text: str = "text") -> DataFrame:
    """Each input row as ``row`` with lang_pred and score, the pooled probability of that language.

    A null text, a text without a letter, and any text where nothing was learned, is ``und`` with
    score 0.
    """
    schema = StructType([field("best", StringType()), field("probability", DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def make() -> Callable:
        network = shared.value

        def columns(texts: list[str | None]) -> list:
            if network is None:
                return [[None] * len(texts), [0.0] * len(texts)]
            found = document_probabilities(network, texts)
            best = found.argmax(axis=1)
            return [[network.languages[k] for k in best], found[np.arange(len(texts)), best].tolist()]

        return columns

    scored = with_columns_from_text(docs, text, schema, make)
    letters = F.coalesce(F.col(f"row.`{text}`").rlike(r"\p{L}"), F.lit(False)) & F.col("best").isNotNull()
    return scored.select(
        "row",
        F.when(letters, F.col("best")).otherwise(UNDETERMINED).alias("lang_pred"),
        F.when(letters, F.least(F.lit(1.0), F.col("probability"))).otherwise(0.0).alias("score"),
    )


def identified(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", least: float = 0.3
) -> DataFrame:
    """The input's rows whose language is determined with at least that pooled probability."""
    net = fit(docs, doc_id, text, lang)
    if net is None:
        return docs
    kept = predict(docs, net, text).filter((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= least))
    return kept.select("row.*")
