"""Benchmark decontamination: an FM-index per training shard, searched backwards for test phrases.

A shard is the word sequence of a batch of documents. Words that no phrase holds are separators, and
so are document ends. Suffixes are sorted in numpy, the Burrows-Wheeler transform is kept as a
wavelet matrix (a wavelet tree of level bitmaps with rank counts), and occurrences are located from
sampled suffix positions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructType

from .shared import field, with_columns_from_text

WINDOW = 10
SHARD_WORDS = 1 << 19
SAMPLE_EVERY = 16
#: Characters of benchmark text that are searched for, and sent to the executors, at once.
BLOCK_CHARS = 16_000_000

_SPLIT = bytes(
    code + 32 if 65 <= code <= 90 else code if 48 <= code <= 57 or 97 <= code <= 122 or code >= 128 else 32
    for code in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    """Runs of digits, letters and everything beyond ASCII, after lowering A-Z."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_SPLIT).split()


class Bits:
    """A bitmap with constant-time rank."""

    def __init__(self, bits: np.ndarray) -> None:
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.zeros(len(self.words), np.int64)
        np.cumsum(np.bitwise_count(self.words[:-1]), out=self.before[1:])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        below = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.before[word] + np.bitwise_count(below)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Suffix array; zeros are separators that differ from each other and rank by position."""
    n = len(symbols)
    gaps = symbols == 0
    n_gaps = int(gaps.sum())
    rank = np.where(gaps, np.cumsum(gaps) - 1, symbols + (n_gaps - 1)).astype(np.int64)
    top = int(rank.max()) + 2
    width = 1
    while width < 3 and top ** (width + 1) < 1 << 62:
        width += 1
    key = rank + 1
    for step in range(1, width):
        shifted = np.zeros(n, np.int64)
        shifted[: n - step] = rank[step:] + 1
        key = key * top + shifted
    order = np.argsort(key)
    sorted_key = key[order]

    def groups(changed: np.ndarray) -> np.ndarray:
        return np.maximum.accumulate(np.where(changed, np.arange(len(changed)), 0))

    changed = np.ones(n, bool)
    changed[1:] = sorted_key[1:] != sorted_key[:-1]
    start = groups(changed)
    rank[order] = start
    tied = np.flatnonzero(~changed | np.append(~changed[1:], False))
    while len(tied):
        at = order[tied]
        first = rank[at]
        follow = at + width
        second = np.where(follow < n, rank[np.minimum(follow, n - 1)], -1)
        by = np.lexsort((second, first))
        at, first, second = at[by], first[by], second[by]
        order[tied] = at
        differs = np.ones(len(tied), bool)
        differs[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
        rank[at] = tied[groups(differs)]
        tied = tied[~differs | np.append(~differs[1:], False)]
        width *= 2
    return order


class FmIndex:
    """Backward search and location of phrases over symbols 1..sigma; zeros separate."""

    def __init__(self, symbols: np.ndarray, sigma: int) -> None:
        order = suffix_order(symbols)
        transform = np.where(order > 0, symbols[order - 1], 0)
        counts = np.bincount(symbols, minlength=sigma + 1)
        self.first = np.concatenate(([0], np.cumsum(counts)))
        self.size = len(symbols)
        self.levels: list[tuple[Bits, int]] = []
        n_levels = max(1, int(sigma).bit_length())
        current = transform
        for level in range(n_levels - 1, -1, -1):
            ones = (current >> level) & 1 == 1
            self.levels.append((Bits(ones), len(ones) - int(ones.sum())))
            current = np.concatenate((current[~ones], current[ones]))
        # Ranks count from where a symbol's run begins on the last level.
        self.begin = self._run_starts(np.arange(sigma + 1), n_levels)
        sampled = (order % SAMPLE_EVERY == 0) | (transform == 0)
        self.sampled = Bits(sampled)
        self.samples = order[sampled]

    def _run_starts(self, symbols: np.ndarray, n_levels: int) -> np.ndarray:
        at = np.zeros(len(symbols), np.int64)
        for level, (bits, zeros) in zip(range(n_levels - 1, -1, -1), self.levels, strict=True):
            ones = bits.rank(at)
            at = np.where((symbols >> level) & 1 == 1, zeros + ones, at - ones)
        return at

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each position of the transform."""
        for level, (bits, zeros) in zip(range(len(self.levels) - 1, -1, -1), self.levels, strict=True):
            ones = bits.rank(at)
            at = np.where((symbols >> level) & 1 == 1, zeros + ones, at - ones)
        return at - self.begin[symbols]

    def back(self, rows: np.ndarray) -> np.ndarray:
        """The rows of the suffixes that begin one symbol earlier."""
        at, symbols = rows, np.zeros(len(rows), np.int64)
        for bits, zeros in self.levels:
            one, ones = bits.get(at), bits.rank(at)
            symbols = symbols * 2 + one
            at = np.where(one, zeros + ones, at - ones)
        return self.first[symbols] + at - self.begin[symbols]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges [low, high) of phrases, one a row, filled with -1 on the right."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), self.size, np.int64)
        for column in range(phrases.shape[1] - 1, -1, -1):
            on = np.flatnonzero((phrases[:, column] >= 0) & (low < high))
            if not len(on):
                continue
            symbol = phrases[on, column]
            both = self.rank(np.concatenate((symbol, symbol)), np.concatenate((low[on], high[on])))
            low[on] = self.first[symbol] + both[: len(on)]
            high[on] = self.first[symbol] + both[len(on) :]
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows: back to a sampled suffix, then as many steps on."""
        found = np.zeros(len(rows), np.int64)
        todo, at, steps = np.arange(len(rows)), rows, 0
        while len(todo):
            known = self.sampled.get(at)
            found[todo[known]] = self.samples[self.sampled.rank(at[known])] + steps
            todo, at = todo[~known], at[~known]
            at, steps = self.back(at), steps + 1
        return found


class Phrases:
    """Distinct windows of the items, over a vocabulary numbered from 1, and the items of each."""

    def __init__(self, items: list[tuple[int, str | None]], window: int) -> None:
        self.vocabulary: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set[int]] = {}
        for item, text in items:
            if item is None:
                continue
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            for at in range(max(1, len(ids) - window + 1)) if ids else ():
                found.setdefault(tuple(ids[at : at + window]), set()).add(item)
        self.lengths = np.array([len(p) for p in found], np.int64)
        self.symbols = np.full((len(found), window), -1, np.int64)
        for row, phrase in enumerate(found):
            self.symbols[row, : len(phrase)] = phrase
        self.items = [sorted(x) for x in found.values()]
        self.window = window


def _shard(docs: list[np.ndarray], phrases: Phrases) -> list[tuple[int, list[tuple[int, int]], set[int]]]:
    """Words, merged hit spans (first word, word after the last) and items of documents of word numbers."""
    lengths = np.array([len(d) for d in docs], np.int64)
    total = int(lengths.sum())
    results: list[tuple[int, list, set]] = [(len(d), [], set()) for d in docs]
    if not total or not len(phrases.symbols):
        return results
    ids = np.concatenate(docs).astype(np.int64)
    doc_of = np.repeat(np.arange(len(docs)), lengths)
    begins = np.cumsum(lengths) - lengths
    new_doc = np.zeros(total, bool)
    new_doc[begins[lengths > 0]] = True
    # One separator stands for a run of unknown words, and one before each document.
    known = np.flatnonzero(ids)
    if not len(known):
        return results
    breaks = np.ones(len(known), bool)
    breaks[1:] = (np.diff(known) > 1) | new_doc[known[1:]]
    place = np.arange(len(known)) + np.cumsum(breaks)
    symbols = np.zeros(int(place[-1]) + 2, np.int64)
    symbols[place] = ids[known]
    source = np.zeros(len(symbols), np.int64)
    source[place] = known
    index = FmIndex(symbols, len(phrases.vocabulary))
    low, high = index.search(phrases.symbols)
    hit = np.flatnonzero(high > low)
    if not len(hit):
        return results
    times = high[hit] - low[hit]
    rows = np.repeat(low[hit] - (np.cumsum(times) - times), times) + np.arange(int(times.sum()))
    which = np.repeat(hit, times)
    start = source[index.locate(rows)]
    cover = np.zeros(total + 1, np.int64)
    np.add.at(cover, start, 1)
    np.add.at(cover, start + phrases.lengths[which], -1)
    covered = np.cumsum(cover[:-1]) > 0
    edge = covered.copy()
    edge[1:] &= ~covered[:-1] | new_doc[1:]
    last = covered.copy()
    last[:-1] &= ~covered[1:] | new_doc[1:]
    for a, b in zip(np.flatnonzero(edge).tolist(), np.flatnonzero(last).tolist(), strict=True):
        doc = int(doc_of[a])
        results[doc][1].append((a - int(begins[doc]), b + 1 - int(begins[doc])))
    pairs = np.unique(np.stack((doc_of[start], which)), axis=1)
    for doc, phrase in pairs.T.tolist():
        results[doc][2].update(phrases.items[phrase])
    return results


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if merged and start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((start, end))
    return merged


def search_texts(
    texts: list[str | None], phrases: Phrases, shard_words: int = SHARD_WORDS
) -> list[tuple[int, list[tuple[int, int]], list[int]]]:
    """Words, merged spans and items of each text, shard after shard.

    A text longer than a shard is cut into pieces that overlap by a window less one word, so no
    occurrence is lost and memory stays bounded.
    """
    found: list[tuple[int, list, set]] = [(0, [], set()) for _ in texts]
    pieces: list[np.ndarray] = []
    get = phrases.vocabulary.get
    owners: list[tuple[int, int]] = []
    held = 0

    def flush() -> None:
        nonlocal held
        for (doc, offset), (_, spans, items) in zip(owners, _shard(pieces, phrases), strict=True):
            found[doc][1].extend((a + offset, b + offset) for a, b in spans)
            found[doc][2].update(items)
        pieces.clear()
        owners.clear()
        held = 0

    for doc, text in enumerate(texts):
        words = words_of(text)
        words = np.fromiter(map(get, words, repeat(0)), np.int32, len(words))
        found[doc] = (len(words), [], set())
        step = max(1, shard_words - phrases.window + 1)
        for at in range(0, max(1, len(words) - phrases.window + 1), step):
            piece = words[at : at + shard_words]
            pieces.append(piece)
            owners.append((doc, at))
            held += len(piece)
            if held >= shard_words:
                flush()
    flush()
    return [(n, _merge(spans), sorted(items)) for n, spans, items in found]


def without_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the characters from the first to the last word of each span."""
    data = text.encode("utf-8", "surrogatepass")
    marks = np.frombuffer(data.translate(_SPLIT), np.uint8) != 32
    edges = np.diff(np.concatenate(([0], marks.view(np.int8), [0])))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    kept, at = [], 0
    for a, b in spans:
        kept.append(data[at : starts[a]])
        at = int(ends[b - 1])
    kept.append(data[at:])
    return b"".join(kept).decode("utf-8", "surrogatepass")


SPAN = StructType([field("first", IntegerType()), field("after", IntegerType())])


def _blocks(benchmark: DataFrame, item_id: str, text: str) -> Iterator[list[tuple[int, str]]]:
    """The query set in blocks of bounded size, whatever the size of the benchmark."""
    items = benchmark.select(F.col(f"`{item_id}`").alias("item"), F.col(f"`{text}`").alias("text"))
    items = items.filter("item is not null and text is not null")
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n_blocks = size // BLOCK_CHARS + 1
    for block in range(n_blocks):
        part = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n_blocks)) == block) if n_blocks > 1 else items
        yield [tuple(row) for row in part.collect()]


def find_spans(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    cut: bool = False,
) -> DataFrame:
    """Each input row as ``row`` with n_words, spans (first word, word after the last) and items.

    With ``cut`` also kept_text, the text without its spans; null where it has none. Spans are cut in the
    pass that finds them: a second pass in Python would keep a second worker beside it on every core.

    Null and empty texts have no words; null items and texts of items hold no phrase. Repeated rows
    of either table change nothing. Phrases are searched in blocks, in a worker of its own each.
    """
    kept = [field("kept_text", docs.schema[text].dataType)] if cut else []
    added = StructType(
        [field("n_words", LongType()), field("spans", ArrayType(SPAN)), field("items", ArrayType(LongType())), *kept]
    )
    context = docs.sparkSession.sparkContext
    result = None
    for items in _blocks(benchmark, item_id, item_text):
        phrases = context.broadcast(Phrases(items, window))

        def make(phrases=phrases, first=result is None) -> Callable:
            def columns(given: list) -> list:
                texts = given if first else [g["text"] for g in given]
                found = search_texts(texts, phrases.value)
                spans, named = [s for _, s, _ in found], [n for _, _, n in found]
                if not first:  # what the earlier blocks found
                    spans = [_merge(s + [(x["first"], x["after"]) for x in g["spans"]]) for s, g in zip(spans, given, strict=True)]
                    named = [sorted({*n, *g["items"]}) for n, g in zip(named, given, strict=True)]
                shown = [[{"first": a, "after": b} for a, b in s] for s in spans]
                texts_left = [without_spans(t, s) if s else None for t, s in zip(texts, spans, strict=True)] if cut else None
                return [[n for n, _, _ in found], shown, named, *([texts_left] if cut else [])]

            return columns

        if result is None:
            result = with_columns_from_text(docs, text, added, make)
            continue
        # Further blocks carry the input row, and what the earlier ones found beside its text.
        given = F.struct(F.col(f"row.`{text}`").alias("text"), "spans", "items").alias("given")
        carried = with_columns_from_text(result.select("row", given), "given", added, make)
        result = carried.select("row.row", *added.names)
    return result


def digest(items: list[int]) -> str:
    """sha256 of the ids, sorted as strings and joined by commas."""
    return hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()


def decontaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """The input's rows with every occurrence of a phrase cut out of the text; clean rows unchanged.

    A column ``n_chars`` follows the text where the input has one.
    """
    found = find_spans(docs, benchmark, text, window=window, cut=True)
    whole = F.col(f"row.`{text}`")
    left = F.when(F.size("spans") > 0, F.col("kept_text")).otherwise(whole)

    def column(name: str):
        if name == text:
            return left.alias(name)
        if name == "n_chars":
            length = F.length(left).cast(docs.schema[name].dataType)
            return F.when(~left.eqNullSafe(whole), length).otherwise(F.col("row.n_chars")).alias(name)
        return F.col(f"row.`{name}`").alias(name)

    return found.select(*[column(name) for name in docs.columns])
