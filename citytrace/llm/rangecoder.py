"""Token-ID files: an adaptive context-mixing range coder in independently reset, checksummed blocks.

File format. A shard file is a sequence of records, each ended by the byte 0x0A:
  ``CMRC`` | u32 length of the rest | u32 crc32 of the rest | rest
A record's rest is
  u32 documents | u32 ids | u32 size of the vocabulary | u32 length of the head | head | u32 number of
  words of each lane | the lanes' words, 32 bits each
The head is a zlib stream of the documents' ids as i64, their lengths as u32, and one byte that says
whether the first document continues the record before. All numbers are little-endian.
The ids of a record form a matrix of steps x lanes, filled lane after lane. Every lane is a range
coder of its own; all lanes share one model, which starts empty in every record and learns after
each step, so a record can be read alone. The model mixes predictions of order 0 (counts of all ids),
order 1 (the ids that followed the previous one most, with counts) and order 2 (those that followed the
previous two). Their shares of the range adapt in each class of counts and of agreement. An id takes the
share of the first follower that names it, order 2 before order 1, else its part of order 0.
"""

from __future__ import annotations

import json
import os
import struct
import uuid
import zlib
from collections import deque
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructType

from citytrace.session import checkpoint_dir

from .shared import field, saved, small_batches

MAGIC = b"CMRC"
END_OF_RECORD = b"\n"
BLOCK_IDS = 1 << 20
LANES = 4096
STEPS_PER_LANE = 128  #: a record has at least so many steps, as far as its ids reach
SHARD_BYTES = 32 << 20  #: text of a shard file, about
CHUNK_BYTES = 1 << 23  #: text whose words are told apart at once, about

TOTAL_BITS = 28
LOW_BITS = 22
PAIR_BITS = 18
JUMP_BITS = 6  #: order-0 values are looked up by their upper bits first
SLOTS = 2  #: followers of a context; Followers.learn knows two
PLAIN = 2 * SLOTS  #: the place behind the followers of both orders, that of order 0
COUNT_BITS = 3
TOP_COUNT = (1 << COUNT_BITS) - 1
N_CLASSES = (TOP_COUNT + 1) ** 2 * 2 * 9
HALVE_AT = 1 << 14
HALF, ONE = np.uint64(32), np.uint64(1)
LOW_WORD = np.uint64((1 << 32) - 1)


class Followers:
    """For each context the ids that followed it most, with a count each, the largest first.

    An id and its count share one number: id * (TOP_COUNT + 1) + count; the numbers of both places share
    one word, the first in its lower half. An id that is not among them takes one off the counts, and the
    place of the last if that has none left.
    """

    def __init__(self, contexts: int) -> None:
        self.table = np.zeros(contexts, np.int64)

    def look(self, context: np.ndarray) -> None:
        self.context = context
        self.seen = self.table.take(context, mode="clip")
        both = [self.seen.astype(np.int32), (self.seen >> 32).astype(np.int32)]
        self.ids = [seen >> COUNT_BITS for seen in both]
        self.counts = [seen & TOP_COUNT for seen in both]

    def learn(self, ids: np.ndarray) -> None:
        count, other = self.counts
        key = ((count << COUNT_BITS) + other) * np.int32(3)
        key += self.ids[0] == ids
        key += (self.ids[1] == ids).view(np.int8) << 1
        new = _KEPT.take(key, mode="clip")
        new &= self.seen
        new += _ADDED.take(key, mode="clip")
        new += (ids.astype(np.int64) << (32 + COUNT_BITS)) & _TAKEN.take(key, mode="clip")
        self.table[self.context] = np.where(_SWAPPED.take(key, mode="clip"), (new >> 32) | (new << 32), new)


def _moves() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """By both counts and the hit (0 none, 1 the first, 2 the second), for words of both places: the bits that are
    kept, what is added, the bits that the id takes if the second place is its own now, and whether the places
    are swapped."""
    levels = np.arange(TOP_COUNT + 1)
    first, second, hit = (a.ravel() for a in np.meshgrid(levels, levels, np.arange(3), indexing="ij"))
    counts = np.stack((first, second))
    hits = np.stack((hit == 1, hit == 2))
    added = (hits & (counts < TOP_COUNT)).astype(np.int32) - ((hit == 0) & (counts > 0))
    taken = (hit == 0) & (second == 0)
    added[1][taken] = 1  # to a place that is emptied
    after = np.where(taken, added, counts + added)
    swapped = after[1] > counts[0] + added[0]
    upper, every = np.int64(-1) << 32, np.int64(-1)
    gained = added[0].astype(np.int64) + (added[1].astype(np.int64) << 32)
    return np.where(taken, ~upper, every), gained, np.where(taken, upper, np.int64(0)), swapped


_KEPT, _ADDED, _TAKEN, _SWAPPED = _moves()


class Model:
    """Counts and followers of one record; the coder and the decoder keep equal copies."""

    def __init__(self, n_ids: int, lanes: int) -> None:
        self.n_ids = n_ids
        self.counts = np.ones(n_ids, np.int64)
        self.two, self.one = Followers(1 << PAIR_BITS), Followers(n_ids)
        self.credit = np.tile(np.array([2] * PLAIN + [8], np.int64), (N_CLASSES, 1))
        self.last, self.pair = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)
        self.step = 0
        self.refresh = 1
        self.seen: list[tuple[np.ndarray, np.ndarray]] = []  # ids and cells of the steps that are not summed up
        self._sum_up()

    def _sum_up(self) -> None:
        """Order-0 frequencies with a sum of 2**LOW_BITS, one at least, and the weights of the classes."""
        if self.seen:
            ids, cells = map(np.concatenate, zip(*self.seen, strict=True))
            self.counts += 24 * np.bincount(ids, minlength=self.n_ids)
            self.credit += 4 * np.bincount(cells, minlength=self.credit.size).reshape(self.credit.shape)
            self.seen = []
        total = int(self.counts.sum())
        freq = self.counts * ((1 << LOW_BITS) - self.n_ids) // total + 1
        freq[int(self.counts.argmax())] += (1 << LOW_BITS) - int(freq.sum())
        self.low = np.zeros(self.n_ids + 1, np.int32)
        np.cumsum(freq, out=self.low[1:])
        self.first = None
        over = self.credit.sum(axis=1) > HALVE_AT
        self.credit[over] = (self.credit[over] + 1) >> 1
        share = self.credit / self.credit.sum(axis=1, keepdims=True)
        # Order 0 has whole 64ths, one at least, so that every id has a width.
        scale = np.maximum(1, share[:, PLAIN] * (1 << (TOTAL_BITS - LOW_BITS))).astype(np.int64)
        rest = (1 << TOTAL_BITS) - (scale << LOW_BITS)
        upto = np.cumsum(share[:, :PLAIN], axis=1)
        bounds = np.zeros((N_CLASSES, PLAIN + 1), np.int32)
        bounds[:, 1:] = rest[:, None] * (upto / upto[:, -1:])
        self.bounds, self.scales = bounds.ravel(), scale.astype(np.int32)
        self.columns = [np.ascontiguousarray(bounds[:, k]) for k in range(1, PLAIN + 1)]

    def _jumps(self) -> np.ndarray:
        """The last id that begins at or before each multiple of 2**JUMP_BITS; only a decoder asks."""
        up = (self.low + ((1 << JUMP_BITS) - 1)) >> JUMP_BITS
        return (np.cumsum(np.bincount(up, minlength=(1 << (LOW_BITS - JUMP_BITS)) + 1)) - 1).astype(np.int32)

    def mixture(self, on: int) -> None:
        """The followers of the first lanes, and the classes that weigh them."""
        self.two.look(self.pair[:on])
        self.one.look(self.last[:on])
        self.ids = self.two.ids + self.one.ids
        two, one = self.two.counts, self.one.counts
        agree = self.two.ids[0] == self.one.ids[0]
        kind = (two[0] * (TOP_COUNT + 1) + one[0]) * 2 + agree
        self.kind = ((kind * 3 + np.minimum(two[1], 2)) * 3 + np.minimum(one[1], 2)).astype(np.int64)

    def _order_0(self, where: np.ndarray, ids: np.ndarray, begin: np.ndarray, size: np.ndarray) -> None:
        """Begins and widths of the lanes that no follower names."""
        low, scale = self.low.take(ids, mode="clip"), self.scales.take(self.kind[where], mode="clip")
        begin[where] += low * scale
        size[where] = (self.low.take(ids + 1, mode="clip") - low) * scale

    def _named(self) -> tuple[np.ndarray, np.ndarray]:
        """Begin and width of the followers at the places; at the last place the begin of order 0."""
        self.cell = self.kind * (PLAIN + 1) + self.place
        begin = self.bounds.take(self.cell, mode="clip")
        return begin, self.bounds.take(self.cell + 1, mode="clip") - begin  # no width at the last place

    def interval(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begin and width of each id: those of the first follower that names it, else of order 0."""
        self.place = np.full(len(ids), PLAIN, np.int32)
        for k in range(PLAIN - 1, -1, -1):
            np.copyto(self.place, k, where=self.ids[k] == ids)
        begin, size = self._named()
        where = np.flatnonzero(self.place == PLAIN)
        self._order_0(where, ids[where], begin, size)
        return begin, size

    def find(self, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The id of each lane whose interval holds the value, and the interval."""
        self.place = np.zeros(len(value), np.int32)
        for column in self.columns:
            self.place += value >= column.take(self.kind, mode="clip")
        begin, size = self._named()
        ids = np.empty(len(value), np.int32)
        for k in range(PLAIN):
            np.copyto(ids, self.ids[k], where=self.place == k)
        where = np.flatnonzero(self.place == PLAIN)
        wanted = (value[where] - begin[where]) // self.scales[self.kind[where]]
        if self.first is None:
            self.first = self._jumps()
        jump = wanted >> JUMP_BITS
        found = self.first[jump]
        several = np.flatnonzero(found != self.first[jump + 1])
        found[several] = np.searchsorted(self.low, wanted[several], side="right") - 1
        ids[where] = found
        self._order_0(where, found, begin, size)
        return ids, begin, size

    def learn(self, ids: np.ndarray) -> None:
        """Update from the ids of one step, those of the first lanes; their places are known."""
        on = len(ids)
        self.seen.append((ids, self.cell))
        self.two.learn(ids)
        self.one.learn(ids)
        last = self.last[:on]
        self.pair[:on] = ((last * 40503) ^ (ids * np.int64(30011))) & ((1 << PAIR_BITS) - 1)
        last[:] = ids
        self.step += 1
        if self.step >= self.refresh:
            self._sum_up()
            self.refresh = self.step + max(1, min(16, self.step // 2))


def _lanes(n: int) -> tuple[int, int]:
    """Lanes and steps of a record of n ids."""
    lanes = max(1, min(LANES, n // STEPS_PER_LANE))
    return lanes, -(-n // lanes)


def _lengths(n: int, lanes: int, steps: int) -> np.ndarray:
    """Ids of each lane: full lanes first, so that the lanes of any step are the first ones."""
    full = n - (steps - 1) * lanes
    return np.where(np.arange(lanes) < full, steps, steps - 1)


def _narrowed(low: np.ndarray, span: np.ndarray) -> np.ndarray:
    """Lanes that are to move on by a word: their range is below 2**32.

    Where the upper words of both ends still differ, the range is cut at the border between them, so
    that no carry is ever needed.
    """
    where = np.flatnonzero(span <= LOW_WORD)
    if len(where):
        a, s = low[where], span[where]
        differs = (a ^ (a + s - ONE)) > LOW_WORD
        span[where] = np.where(differs, (~a + ONE) & LOW_WORD, s)
    return where


def encode_ids(ids: np.ndarray, n_ids: int) -> bytes:
    """The coded lanes of one record."""
    lanes, steps = _lanes(len(ids))
    lengths = _lengths(len(ids), lanes, steps)
    begins = np.cumsum(lengths) - lengths
    model = Model(n_ids, lanes)
    low, span = np.zeros(lanes, np.uint64), np.full(lanes, (1 << 64) - 1, np.uint64)
    out, sizes = np.empty((lanes, steps // 2 + 8), np.uint32), np.zeros(lanes, np.int64)
    for step in range(steps):
        if int(sizes.max()) + 4 > out.shape[1]:  # a step writes one word at most, the end two
            out = np.concatenate((out, np.empty_like(out)), axis=1)
        on = lanes if step < steps - 1 else int((lengths == steps).sum())
        symbols = ids[begins[:on] + step].astype(np.int32)
        model.mixture(on)
        begin, size = model.interval(symbols)
        unit = span[:on] >> np.uint64(TOTAL_BITS)
        low[:on] += unit * begin.astype(np.uint64)
        span[:on] = unit * size.astype(np.uint64)
        where = _narrowed(low[:on], span[:on])
        if len(where):
            grown = sizes[where]
            out[where, grown] = low[where] >> HALF
            sizes[where] = grown + 1
            low[where] <<= HALF
            span[where] <<= HALF
        model.learn(symbols)
    rows = np.arange(lanes)
    for shift in (32, 0):
        out[rows, sizes] = (low >> np.uint64(shift)) & LOW_WORD
        sizes += 1
    words = out[np.arange(out.shape[1]) < sizes[:, None]]
    return sizes.astype("<u4").tobytes() + words.astype("<u4").tobytes()


def decode_ids(data: bytes, n: int, n_ids: int) -> np.ndarray:
    """The n ids of a record."""
    lanes, steps = _lanes(n)
    lengths = _lengths(n, lanes, steps)
    begins = np.cumsum(lengths) - lengths
    sizes = np.frombuffer(data, "<u4", lanes).astype(np.int64)
    words = np.concatenate((np.frombuffer(data, "<u4", offset=4 * lanes), np.zeros(4, "<u4"))).astype(np.uint64)
    at = np.cumsum(sizes) - sizes
    model = Model(n_ids, lanes)
    # What is kept is the code less the low end of the range.
    code = (words[at] << HALF) | words[at + 1]
    at += 2
    low, span = np.zeros(lanes, np.uint64), np.full(lanes, (1 << 64) - 1, np.uint64)
    ids = np.empty(n, np.int32)
    top = np.uint64((1 << TOTAL_BITS) - 1)
    for step in range(steps):
        on = lanes if step < steps - 1 else int((lengths == steps).sum())
        model.mixture(on)
        unit = span[:on] >> np.uint64(TOTAL_BITS)
        symbols, begin, size = model.find(np.minimum(code[:on] // unit, top).astype(np.int32))
        ids[begins[:on] + step] = symbols
        moved = unit * begin.astype(np.uint64)
        low[:on] += moved
        code[:on] -= moved
        span[:on] = unit * size.astype(np.uint64)
        where = _narrowed(low[:on], span[:on])
        if len(where):
            code[where] = (code[where] << HALF) | words[at[where]]
            at[where] += 1
            low[where] <<= HALF
            span[where] <<= HALF
        model.learn(symbols)
    return ids


def pack_record(doc_ids: list[int | None], lengths: list[int], goes_on: bool, ids: np.ndarray, n_ids: int) -> bytes:
    """One record; goes_on says that its first document began in the record before."""
    head = zlib.compress(
        np.array([d if d is not None else -(1 << 63) for d in doc_ids], "<i8").tobytes()
        + np.array(lengths, "<u4").tobytes()
        + bytes([goes_on])
    )
    rest = struct.pack("<IIII", len(doc_ids), len(ids), n_ids, len(head)) + head
    if len(ids):
        rest += encode_ids(ids, n_ids)
    return MAGIC + struct.pack("<II", len(rest), zlib.crc32(rest)) + rest


def unpack_records(data: bytes) -> Iterator[tuple[list[int | None], list[int], bool, np.ndarray]]:
    """The records of a shard file; a wrong mark or checksum raises ValueError."""
    at = 0
    while at < len(data):
        if data[at : at + 4] != MAGIC:
            raise ValueError(f"no record at byte {at}")
        length, checksum = struct.unpack_from("<II", data, at + 4)
        rest = data[at + 12 : at + 12 + length]
        if len(rest) != length or zlib.crc32(rest) != checksum or data[at + 12 + length :][:1] != END_OF_RECORD:
            raise ValueError(f"damaged record at byte {at}")
        n_docs, n, n_ids, n_head = struct.unpack_from("<IIII", rest)
        head = zlib.decompress(rest[16 : 16 + n_head])
        docs = [None if d == -(1 << 63) else d for d in np.frombuffer(head, "<i8", n_docs).tolist()]
        lengths = np.frombuffer(head, "<u4", n_docs, 8 * n_docs).tolist()
        ids = decode_ids(rest[16 + n_head :], n, n_ids) if n else np.zeros(0, np.int64)
        yield docs, lengths, bool(head[-1]), ids
        at += 13 + length


#: The marks that the splitter takes off a word, and UTF-8 bytes of the letters ß to ÿ, which
#: the normaliser leaves as they are and the splitter keeps together, as it does a to z: their first byte
#: and the range of their second, where ÷ is none.
_MARKS = b".,;:!?"
_FIRST, _SECOND, _NO_LETTER = 0xC3, (0x9F, 0xBF), 0xB7
_LOWER = bytes(code + 32 if 65 <= code <= 90 else code for code in range(256))
LINE_WORDS = 256  #: plain words of a line for the tokenizer
LINES_AT_ONCE = 32  #: the tokenizer's results are large next to the ids, so few lines are held at a time


def _split(data: bytes, ends: np.ndarray) -> pa.LargeBinaryArray:
    """The pieces of data that end at the places."""
    offsets = np.concatenate((np.zeros(1, np.int64), ends))
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _joined(words: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all words and the length of each."""
    _, offsets, data = words.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(words) + 1, 8 * words.offset)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], np.diff(offsets)


def _laid_out(ids: np.ndarray, sizes: np.ndarray, places: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the words at the places in a row, and where each word ends."""
    of_words = _split(ids.astype("<u4").tobytes(), 4 * np.cumsum(sizes))
    data, lengths = _joined(of_words.take(places))
    return data.view("<u4"), np.cumsum(lengths) // 4


class WordIds:
    """Ids of white-space separated words as bytes, from the tokenizers library.

    For a tokenizer that lowers case and drops white space, words never interact, so each distinct
    word of a chunk is encoded once: words of plain letters without the normaliser and splitter, in
    lines, all others by the whole tokenizer.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        setup = json.loads(self.tokenizer.to_str())
        kinds = [x.get("type") for x in (setup.get("normalizer") or {}).get("normalizers", [])]
        steps = [x.get("type") for x in (setup.get("pre_tokenizer") or {}).get("pretokenizers", [])]
        end = setup["model"].get("end_of_word_suffix")
        self.by_word = kinds == ["NFC", "Replace", "Lowercase"] and steps == ["Split", "ByteLevel"] and bool(end)
        if not self.by_word:
            return
        shown = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.shown = np.arange(256, dtype="<u4")  # bytes as the characters that the model knows them by
        for second in range(_SECOND[0], _SECOND[1] + 1):
            first, other = shown.pre_tokenize_str(bytes([_FIRST, second]).decode())[0][0]
            self.shown[_FIRST], self.shown[second] = ord(first), ord(other)
        # The same model over words that are normalised and shown as bytes already.
        self.model = Tokenizer.from_str(
            json.dumps(setup | {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "added_tokens": []})
        )
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[k for token, k in vocabulary.items() if token.endswith(end)]] = True
        self.marks = np.full(256, -1, np.int64)
        for mark in _MARKS:
            found = self.tokenizer.encode(chr(mark), add_special_tokens=False).ids
            if len(found) == 1:
                self.marks[mark] = found[0]

    def _plain(self, data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of words from begin to the space at end: which are plain letters but for a mark, and the mark's id or -1."""
        before = np.concatenate((np.zeros(1, np.uint8), data[:-1]))
        after = np.concatenate((data[1:], np.zeros(1, np.uint8)))
        second = (data >= _SECOND[0]) & (data <= _SECOND[1]) & (data != _NO_LETTER)
        letter = (data >= ord("a")) & (data <= ord("z")) | (second & (before == _FIRST))
        letter |= (data == _FIRST) & (after >= _SECOND[0]) & (after <= _SECOND[1]) & (after != _NO_LETTER)
        others = np.concatenate((np.zeros(1, np.int32), np.cumsum(~letter, dtype=np.int32)))
        long = ends > begins
        marks = np.where(long, self.marks[data[np.maximum(ends - 1, 0)]], -1)
        upto = ends - (marks >= 0)
        return (upto > begins) & (others[upto] == others[begins]), marks

    def _bodies(self, data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain words, and how many each has; the last id of a word, and no other, ends it."""
        if not len(lengths):
            return np.zeros(0, "<u4"), lengths
        text = self.shown[data].tobytes().decode("utf-32-le")
        cuts = np.concatenate((np.zeros(1, np.int64), np.cumsum(lengths)[LINE_WORDS - 1 :: LINE_WORDS], [len(data)])).tolist()
        lines = [text[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
        found = [
            np.array(encoded.ids, "<u4")
            for at in range(0, len(lines), LINES_AT_ONCE)
            for encoded in self.model.encode_batch_fast(lines[at : at + LINES_AT_ONCE], add_special_tokens=False)
        ]
        ids = np.concatenate(found)
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) != len(lengths):
            raise ValueError("words and ends of words differ")
        return ids, np.diff(ends, prepend=0)

    def _distinct_bodies(self, data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same of words that may be equal, as words that differ in their mark are."""
        words = _split(data.tobytes(), np.cumsum(lengths)).dictionary_encode()
        ids, sizes = self._bodies(*_joined(words.dictionary))
        found, upto = _laid_out(ids, sizes, words.indices)
        return found, np.diff(upto, prepend=0)

    def ids_of(self, words: pa.LargeBinaryArray, end_id: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Ids of distinct words, each with a space behind it, how many each has, and the place of the word ``\\n``."""
        data, lengths = _joined(words)
        ends = np.cumsum(lengths) - 1
        plain, marks = self._plain(data, ends + 1 - lengths, ends)
        marked = plain & (marks >= 0)
        of_bodies = np.repeat(plain, lengths)
        of_bodies[ends[marked] - 1] = False
        body_ids, body_sizes = self._distinct_bodies(data[of_bodies], (lengths - marked)[plain])

        odd = np.flatnonzero(~plain)
        texts = [words[k].as_py()[:-1] for k in odd.tolist()]
        encoded = self.tokenizer.encode_batch_fast(
            [t.decode("utf-8", "surrogatepass") for t in texts], add_special_tokens=False
        )
        odd_ids = [[end_id] if t == b"\n" else e.ids for t, e in zip(texts, encoded, strict=True)]
        last = int(odd[texts.index(b"\n")]) if b"\n" in texts else -1

        sizes = np.zeros(len(words), np.int64)
        sizes[plain] = body_sizes
        sizes += marked
        sizes[odd] = [len(ids) for ids in odd_ids]
        stops = np.cumsum(sizes)
        flat = np.zeros(int(stops[-1]) if len(stops) else 0, "<u4")
        of_marks = stops[marked] - 1
        flat[of_marks] = marks[marked]
        free = np.repeat(plain, sizes)
        free[of_marks] = False
        flat[free] = body_ids
        flat[np.repeat(~plain, sizes)] = list(chain.from_iterable(odd_ids))
        return flat, sizes, last

    def encoded(self, data: bytes, end_id: int) -> tuple[np.ndarray, list[int]]:
        """Ids of the words, each with a space behind it, and where texts end; the word ``\\n`` is the end id.

        Words are told apart once for the whole chunk; the ids of the distinct ones are then laid out.
        """
        if not data:
            return np.zeros(0, "<u4"), []
        words = _split(data, np.flatnonzero(np.frombuffer(data, np.uint8) == 32) + 1).dictionary_encode()
        flat, sizes, last = self.ids_of(words.dictionary, end_id)
        ids, ends = _laid_out(flat, sizes, words.indices)
        return ids, ends[words.indices.to_numpy() == last].tolist()


_WORDS: dict[str, WordIds] = {}


def _chunks(text: str) -> Iterator[bytes]:
    """The words of a text, each with a space behind it, in chunks of about CHUNK_BYTES; ``\\n`` is the last word."""
    data = text.encode("utf-8", "surrogatepass").translate(_LOWER).replace(b"\n", b" ") + b" \n "
    at = 0
    while len(data) - at > CHUNK_BYTES:
        cut = data.find(b" ", at + CHUNK_BYTES - 1) + 1
        yield data[at:cut]
        at = cut
    yield data[at:]


def tokenised(texts: Iterable[str | None], path: str, end_id: int) -> Iterator[np.ndarray]:
    """Ids of each whole text with the end id; null is empty. Texts are taken as far as a chunk of words reaches.

    Texts with the mark of a special token, or for a tokenizer that is not word by word, go through
    the tokenizer whole.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores are Spark's to deal out
    table = _WORDS.get(path) or _WORDS.setdefault(path, WordIds(path))
    waiting: list[bytes] = []
    parts: list[np.ndarray] = []  # of a text that is not at its end

    def flush() -> Iterator[np.ndarray]:
        ids, ends = table.encoded(b"".join(waiting), end_id)
        waiting.clear()
        at = 0
        for upto in ends:
            parts.append(ids[at:upto])
            yield np.concatenate(parts) if len(parts) > 1 else parts[0]
            parts.clear()
            at = upto
        if at < len(ids):
            parts.append(ids[at:])

    size = 0
    for text in texts:
        text = text or ""
        if not table.by_word or "<|" in text:
            yield from flush()
            size = 0
            ids = table.tokenizer.encode(text, add_special_tokens=False).ids
            yield np.array([*ids, end_id], "<u4")
            continue
        for chunk in _chunks(text):
            waiting.append(chunk)
            size += len(chunk)
            if size >= CHUNK_BYTES:
                yield from flush()
                size = 0
    yield from flush()


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    doc_id: str = "doc_id",
    text: str = "text",
    end_id: int = 2,
    block_ids: int = BLOCK_IDS,
) -> None:
    """Write shard files of ids, in ascending order of id over shards and within.

    The number of shards follows the size of the texts, so a file stays small at any size.
    Rows of equal id are ordered by text; null ids come first. A hot id may be split over shards. The
    files go through Spark's own writer, so a lost task leaves nothing behind.
    """
    from tokenizers import Tokenizer

    n_ids = Tokenizer.from_file(tokenizer).get_vocab_size(with_added_tokens=True)
    narrow = docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    size = narrow.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    dealt = narrow.repartitionByRange(size // SHARD_BYTES + 1, F.col("id").asc_nulls_first(), F.xxhash64("text"))
    ordered = dealt.sortWithinPartitions(F.col("id").asc_nulls_first(), F.xxhash64("text"), "text")

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        docs_held: list[int | None] = []
        lengths: list[int] = []
        size, goes_on = 0, False

        def flush() -> pa.RecordBatch:
            record = pack_record(docs_held, lengths, goes_on, np.concatenate(held or [np.zeros(0, "<u4")]), n_ids)
            held.clear()
            docs_held.clear()
            lengths.clear()
            return pa.RecordBatch.from_arrays([pa.array([record], pa.binary())], names=["record"])

        number: deque[int | None] = deque()  # of the texts whose words are waiting

        def texts() -> Iterator[str | None]:
            """The texts of all batches: a word is encoded once for a chunk, and a batch is a small part of one."""
            for batch in batches:
                number.extend(batch.column(0).to_pylist())
                yield from batch.column(1).to_pylist()

        for ids in tokenised(texts(), tokenizer, end_id):
            doc = number.popleft()
            at = 0
            while True:
                piece = ids[at : at + block_ids - size]
                held.append(piece)
                docs_held.append(doc)
                lengths.append(len(piece))
                size += len(piece)
                at += len(piece)
                if size >= block_ids:
                    yield flush()
                    size, goes_on = 0, at < len(ids)
                if at >= len(ids):
                    break
        if number:
            raise ValueError("texts and documents differ")
        if docs_held:
            yield flush()

    packed = small_batches(ordered).mapInArrow(records, StructType([field("record", BinaryType())]))
    # Text files of one column take any bytes; the line end is the format's end of record.
    packed.select(F.col("record").cast("string").alias("value")).write.option("lineSep", "\n").text(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(shard, place, id, ids as u32 bytes' crc32, n_tokens) of the documents of all files, checked.

    A document is put together from its pieces; its crc32 runs over them, so memory is bounded by a
    record however long the document is.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    schema = "shard string, place long, id long, n_tokens long, ids_crc32 long"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows: list[list] = []
                for docs, lengths, goes_on, ids in unpack_records(content.as_buffer().to_pybytes()):
                    at = 0
                    for k, (doc, length) in enumerate(zip(docs, lengths, strict=True)):
                        data = ids[at : at + length].astype("<u4").tobytes()
                        at += length
                        if k == 0 and goes_on:
                            rows[-1][3] += length
                            rows[-1][4] = zlib.crc32(data, rows[-1][4])
                        else:
                            rows.append([name, len(rows), doc, length, zlib.crc32(data)])
                columns = list(zip(*rows, strict=True)) or [()] * 5
                kinds = [pa.string(), *[pa.int64()] * 4]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    names=["shard", "place", "id", "n_tokens", "ids_crc32"],
                )

    return files.mapInArrow(read, schema)


def token_output(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    tokenizer: str | None = None,
    end_id: int = 2,
    path: str | None = None,
) -> DataFrame:
    """Write the files, read them back, and return doc_id, start, n_tokens and ids_crc32 of each document.

    start counts the ids of all documents before it: of earlier shards, then of its own. An empty
    table gives no file with a record and an empty result.
    """
    spark = docs.sparkSession
    tokenizer = tokenizer or public_tokenizers.path("word_bpe_49k.json")
    path = path or f"{checkpoint_dir(spark)}/token-ids-{uuid.uuid4().hex}"
    write_token_files(docs, path, tokenizer, doc_id, text, end_id)
    return index_of(read_token_files(spark, path), doc_id)


def index_of(found: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Starts from the lengths: shards are summed first, so only one row a shard meets in one task."""
    found = saved(found, "token-index")
    shards = found.groupBy("shard").agg(F.sum("n_tokens").alias("of_shard"))
    number = F.regexp_extract("shard", r"part-(\d+)", 1).try_cast("long")
    before = Window.orderBy(number, "shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = shards.select(
        F.col("shard").alias("of"), F.coalesce(F.sum("of_shard").over(before), F.lit(0)).alias("offset")
    )
    inside = Window.partitionBy("shard").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    placed = found.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    return placed.join(offsets, F.col("shard") == F.col("of")).select(
        F.col("id").alias(doc_id), (F.col("offset") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"
    )
