"""Cross-tokenizer alignment by diagonal run skipping.

Both token sequences of a text are arrays of byte ends. Where the tokens are one to one, the ends agree
at the current index shift, and stretches of growing length are compared until one differs. An irregular
group is walked token by token up to the next common end, and the shift follows from there.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import cache
from itertools import accumulate, chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructType

from .shared import field, saved, small_batches

CACHE_WORDS = 400_000  #: distinct words whose ids a worker keeps, for each tokenizer
COMMON_PAIRS = 1 << 20  #: pairs whose counts travel to the tasks; all others are joined
BIN_STEPS = 8  #: bins of counts to a doubling, where the common pairs are cut off
LINE = 256  #: words that are encoded in one line
SINGLY = 4  #: ends of a run that are compared one by one, as most runs are short
SPACE = "▁"


#: Fixed value: printable ASCII and the accented letters of the two next Latin blocks, letters in every edition.
PLAIN = re.compile(r"[\t\n\r\x20-\x7eÀ-ÖØ-öø-ſ]*")


class WordCache:
    """Packed ids of words in two bounded halves; a word met again moves to the new half.

    A word is encoded only if its ids give its bytes back; any other word makes its text go whole.
    """

    def __init__(self, encode, token_bytes: list[bytes]) -> None:
        self.encode, self.token_bytes, self.new, self.old = encode, token_bytes, {}, {}
        self.inexact: set[str] = set()

    def ids(self, texts: list[list[str]]) -> list[np.ndarray | None]:
        """Ids of texts, each a list of words; unknown words of all of them are encoded together."""
        if len(self.new) > CACHE_WORDS // 2:
            self.new, self.old = {}, self.new
            self.inexact &= self.old.keys()
        unknown = set().union(*texts).difference(self.new)
        met = {word: self.old[word] for word in unknown if word in self.old}
        self.new.update(met)
        missing = list(unknown.difference(met))
        found = list(self.encode(missing))
        if not self._give_back(missing, found):
            for word, ids in zip(missing, found, strict=True):
                if b"".join(map(self.token_bytes.__getitem__, ids)) != word.encode("utf-8", "surrogatepass"):
                    self.inexact.add(word)
        packed = np.fromiter(chain.from_iterable(found), np.int32).tobytes()
        ends = list(accumulate([4 * len(ids) for ids in found]))
        self.new.update(zip(missing, (packed[s:e] for s, e in zip([0, *ends], ends, strict=False)), strict=True))
        exact = [not self.inexact or self.inexact.isdisjoint(words) for words in texts]
        found = [b"".join(map(self.new.__getitem__, words)) if ok else None for words, ok in zip(texts, exact, strict=True)]
        return [None if ids is None else np.frombuffer(ids, np.int32) for ids in found]


    def _give_back(self, words: list[str], found: list[list[int]]) -> bool:
        """Whether the ids of all words give their bytes, looked at together; only where they don't is each one tried."""
        pieces = list(map(self.token_bytes.__getitem__, chain.from_iterable(found)))
        data = "".join(words).encode("utf-8", "surrogatepass")
        if b"".join(pieces) != data:
            return False
        # Equal as a whole; they are equal word by word if both are cut at the same bytes.
        ends = np.cumsum([0, *map(len, pieces)])[np.cumsum([0, *map(len, found)])]
        starts = np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)  # of characters
        return np.array_equal(ends, np.append(starts, len(data))[np.cumsum([0, *map(len, words)])])


def split_or_whole(
    texts: list[str], split: list[list[str] | None], cache: WordCache, whole
) -> Iterator[tuple[np.ndarray, bool]]:
    """Ids by words where a text has been split, else those of the whole text, and whether their bytes are proven."""
    by_word = iter(cache.ids([words for words in split if words is not None]))
    for text, words in zip(texts, split, strict=True):
        ids = None if words is None else next(by_word)
        yield (np.array(whole(text), np.int32), False) if ids is None else (ids, True)


class ByteLevelTokens:
    """Token ids of a byte-level tokenizer file, and the bytes of each id.

    Words of the splitter never interact. Texts of ``PLAIN`` characters are split here by its published
    pattern, and each distinct word is encoded once; every other text goes through the tokenizer whole.
    """

    #: Fixed value: the splitter's pattern, with its letter and number classes on ``PLAIN``.
    WORD = re.compile(
        r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-zÀ-ÖØ-öø-ſ]+| ?[0-9]+| ?[^\sA-Za-zÀ-ÖØ-öø-ſ0-9]+|\s+(?!\S)|\s+", re.ASCII
    )

    def __init__(self, path: str) -> None:
        import json

        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores are Spark's to deal out
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        setup = json.loads(self.tokenizer.to_str())
        splitter = setup.get("pre_tokenizer") or {}
        self.by_word = (
            splitter.get("type") == "ByteLevel"
            and splitter.get("use_regex", True)
            and not splitter.get("add_prefix_space")
            and setup.get("normalizer") is None
        )
        # Printable Latin-1 stands for itself, every other byte for a character from 256 on.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte_of = {chr(b): b for b in shown}
        byte_of |= {chr(256 + k): b for k, b in enumerate(sorted(set(range(256)) - set(shown)))}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            known = all(c in byte_of for c in token)
            self.bytes[number] = bytes(byte_of[c] for c in token) if known else token.encode()
        self.lengths = np.array(list(map(len, self.bytes)), np.int64)
        self.cache = WordCache(self._encode_words, self.bytes)

    def _encode_words(self, words: list[str]) -> Iterator[list[int]]:
        """Words of letters with a space before them are encoded as lines, which their bytes cut again."""
        spaced = [word for word in words if word[0] == " " and word[1:].isalpha()]
        lines = [spaced[at : at + LINE] for at in range(0, len(spaced), LINE)]
        found = self.tokenizer.encode_batch_fast(["".join(line) for line in lines], add_special_tokens=False)
        known: dict[str, list[int]] = {}
        for line, encoded in zip(lines, found, strict=True):
            ids = encoded.ids
            ends = np.cumsum(self.lengths[ids])
            upto = np.searchsorted(ends, np.cumsum([len(word.encode()) for word in line]), side="right").tolist()
            known.update(zip(line, (ids[s:e] for s, e in zip([0, *upto], upto, strict=False)), strict=True))
        others = [word for word in words if word not in known]
        found = self.tokenizer.encode_batch_fast(others, add_special_tokens=False)
        known.update(zip(others, (encoded.ids for encoded in found), strict=True))
        return map(known.__getitem__, words)

    def ids(self, texts: list[str]) -> Iterator[tuple[np.ndarray, bool]]:
        split = [self.WORD.findall(t) if self.by_word and PLAIN.fullmatch(t) else None for t in texts]
        whole = lambda text: self.tokenizer.encode(text, add_special_tokens=False).ids
        return split_or_whole(texts, split, self.cache, whole)


class PieceTokens:
    """Piece ids of a sentencepiece model, and the bytes of each id.

    If no piece goes on with a space after another character, nothing is merged over the start of a run
    of spaces, and each distinct word with the spaces before it is encoded once.
    """

    BYTE = re.compile(r"<0x([0-9A-F]{2})>")
    WORD = re.compile(r" +[^ ]+")

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(k) for k in range(self.model.get_piece_size())]
        self.bytes = []
        for piece in pieces:
            byte = self.BYTE.fullmatch(piece)
            self.bytes.append(bytes([int(byte[1], 16)]) if byte else piece.replace(SPACE, " ").encode())
        self.lengths = np.array(list(map(len, self.bytes)), np.int64)
        # Both probes fail for a model that joins words, drops spaces or rewrites characters.
        joined = any(SPACE in piece.lstrip(SPACE) for piece in pieces)
        probe = "  a  b c "
        self.by_word = not joined and b"".join(self.bytes[k] for k in self.model.encode(probe)) == b" " + probe.encode()
        self.cache = WordCache(self._encode_words, self.bytes)

    def _encode_words(self, words: list[str]) -> list[list[int]]:
        return self.model.encode([word[1:] for word in words], num_threads=1)  # the model adds one space

    def ids(self, texts: list[str]) -> Iterator[tuple[np.ndarray, bool]]:
        """The model adds a space before each text."""
        plain = [self.by_word and t[-1:] not in (" ", "") and PLAIN.fullmatch(t) for t in texts]
        split = [self.WORD.findall(" " + t) if ok else None for t, ok in zip(texts, plain, strict=True)]
        return split_or_whole(texts, split, self.cache, lambda text: self.model.encode(text, num_threads=1))


@cache
def loaded(kind: type, *setup):
    """One tokenizer or writer a worker process."""
    return kind(*setup)


def matching_stretch(ends_a: list[int], ends_b: list[int], i: int, j: int) -> int:
    """How many ends from (i, j) on agree one by one: a few singly, then stretches double until one differs, and halve."""
    n, step = 0, SINGLY
    for x, y in zip(ends_a[i : i + SINGLY], ends_b[j : j + SINGLY], strict=False):
        if x != y:
            return n
        n += 1
    while True:
        one = ends_a[i + n : i + n + step]
        if not one:
            return n
        if one != ends_b[j + n : j + n + step]:
            break
        n += len(one)
        step += step
    step >>= 1
    while step:
        one = ends_a[i + n : i + n + step]
        if one and one == ends_b[j + n : j + n + step]:
            n += len(one)
        step >>= 1
    return n


def aligned(ends_a: list[int], ends_b: list[int]) -> tuple[list[int], list[int]]:
    """Ends of the groups as token places in both sequences. The ends of tokens ascend, and the last ones agree."""
    cuts_a: list[int] = []
    cuts_b: list[int] = []
    i = j = 0
    n_a = len(ends_a)
    ends_a, ends_b = [*ends_a, -1], [*ends_b, -2]  # beyond the last ends nothing agrees
    while i < n_a:
        x, y = ends_a[i], ends_b[j]
        if x == y:
            n = 1 + matching_stretch(ends_a, ends_b, i + 1, j + 1) if ends_a[i + 1] == ends_b[j + 1] else 1
            cuts_a += range(i + 1, i + n + 1)
            cuts_b += range(j + 1, j + n + 1)
            i += n
            j += n
            continue
        while x != y:
            if x < y:
                i += 1
                x = ends_a[i]
            else:
                j += 1
                y = ends_b[j]
        i += 1
        j += 1
        cuts_a.append(i)
        cuts_b.append(j)
    return cuts_a, cuts_b


def linked(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token places of all pairs with a common byte: one pair for each end of either sequence."""
    ends = np.union1d(ends_a, ends_b)
    return np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)


class GroupWriter:
    """``a1,a2|b1;a3|b2``: numbers with the mark that follows them, put in order and joined at once."""

    def __init__(self, n_a: int, n_b: int) -> None:
        self.n_a, self.n_b = n_a, n_b
        self.a = np.array([f"{k}{mark}" for mark in ",|" for k in range(n_a)], object)
        self.b = np.array([f"{k}{mark}" for mark in ",;" for k in range(n_b)], object)

    def text(self, a: np.ndarray, b: np.ndarray, cuts_a: np.ndarray, cuts_b: np.ndarray) -> str:
        last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        last_a[cuts_a - 1] = last_b[cuts_b - 1] = 1
        # A token of a stands behind the b tokens of all groups before, one of b behind all a tokens of its group.
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        parts = np.empty(len(a) + len(b), object)
        parts[np.arange(len(a)) + np.concatenate(([0], cuts_b))[group_a]] = self.a[a + self.n_a * last_a]
        parts[np.arange(len(b)) + cuts_a[group_b]] = self.b[b + self.n_b * last_b]
        return "".join(parts.tolist())[:-1]


def align_texts(texts: list[str | None], first: ByteLevelTokens, second: PieceTokens) -> Iterator[tuple | None]:
    """(a ids, b ids, group ends in a and in b, linked places in a and in b) of each, or None where nothing is aligned."""
    filled = [t for t in texts if t]
    found = zip(filled, first.ids([" " + t for t in filled]), second.ids(filled), strict=True)
    for text in texts:
        if not text:
            yield None
            continue
        _, (a, proven_a), (b, proven_b) = next(found)
        data = b" " + text.encode("utf-8", "surrogatepass")
        open_ones = [(t, ids) for t, ids, proven in ((first, a, proven_a), (second, b, proven_b)) if not proven]
        if any(b"".join(map(t.bytes.__getitem__, ids.tolist())) != data for t, ids in open_ones):
            yield None
            continue
        ends_a, ends_b = np.cumsum(first.lengths[a]), np.cumsum(second.lengths[b])
        cuts_a, cuts_b = aligned(ends_a.tolist(), ends_b.tolist())
        yield a, b, np.array(cuts_a), np.array(cuts_b), *linked(ends_a, ends_b)


NUMBERS = ("n_a", "n_b", "n_groups", "n_links")


def align_documents(docs: DataFrame, path_a: str, path_b: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, groups, a, b, n) of each row: groups as text, then the distinct
    linked pairs of ids (a, b) with their number in the text."""
    narrow = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    schema = StructType(
        [
            narrow.schema["id"],
            *[field(name, LongType()) for name in NUMBERS],
            field("groups_sha256", StringType()),
            *[field(name, ArrayType(IntegerType())) for name in ("a", "b", "n")],
        ]
    )
    lists = pa.list_(pa.int32())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = loaded(ByteLevelTokens, path_a), loaded(PieceTokens, path_b)
        writer = loaded(GroupWriter, len(first.bytes), len(second.bytes))
        for batch in batches:
            numbers: list[tuple[int, ...]] = []
            digests: list[str] = []
            pairs: tuple[list, list, list] = ([], [], [])
            for found in align_texts(batch.column(1).to_pylist(), first, second):
                if found is None:
                    numbers.append((0, 0, 0, 0))
                    digests.append("")
                    for column in pairs:
                        column.append([])
                    continue
                a, b, cuts_a, cuts_b, links_a, links_b = found
                groups = writer.text(a, b, cuts_a, cuts_b)
                numbers.append((len(a), len(b), len(cuts_a), len(links_a)))
                digests.append(hashlib.sha256(groups.encode()).hexdigest())
                keys, n = np.unique((a[links_a].astype(np.int64) << 32) | b[links_b], return_counts=True)
                for column, values in zip(pairs, (keys >> 32, keys & 0xFFFFFFFF, n), strict=True):
                    column.append(values.astype(np.int32))
            columns = [pa.array(c, pa.int64()) for c in zip(*numbers, strict=True)] or [pa.array([], pa.int64())] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns, pa.array(digests, pa.string()), *[pa.array(c, lists) for c in pairs]],
                names=schema.names,
            )

    return small_batches(narrow).mapInArrow(run, schema)


def pair_counts(read: DataFrame) -> DataFrame:
    """(a, b, total, best) of all pairs linked anywhere; best marks the highest totals of their b."""
    each = read.select(F.explode(F.arrays_zip("a", "b", "n")).alias("p")).select("p.*")
    totals = saved(each.groupBy("a", "b").agg(F.sum("n").alias("total")), "pair-totals")
    highest = totals.groupBy(F.col("b").alias("of_b")).agg(F.max("total").alias("highest"))
    return totals.join(highest, F.col("b") == F.col("of_b")).select(
        "a", "b", "total", (F.col("total") == F.col("highest")).alias("best")
    )


def _cut(counts: DataFrame, most: int) -> int:
    """The smallest total from which on there are at most that many pairs."""
    step = F.floor(F.log2(F.col("total").cast("double")) * BIN_STEPS).cast("int")
    bins = counts.groupBy(step.alias("bin")).agg(F.count("*").alias("n"), F.min("total").alias("low"))
    held, low = 0, None
    for row in sorted(bins.collect(), key=lambda r: -r["bin"]):  # a few bins a doubling, so a few hundred rows
        held += row["n"]
        if held > most:
            break
        low = row["low"]
    return low if low is not None else (1 << 62)


def scored(read: DataFrame, counts: DataFrame, most: int = COMMON_PAIRS) -> DataFrame:
    """The rows of ``align_documents`` with n_best and count_sum.

    Totals of the commonest pairs, a bounded number, travel to the tasks, so no hot pair is ever shuffled.
    The others are joined: each of their rows is a rare pair, so no key is hot.
    """
    read = read.withColumn("uid", F.monotonically_increasing_id())
    counts = saved(counts, "pair-counts")
    cut = _cut(counts, most)
    common = counts.filter(F.col("total") >= cut).toArrow()
    keys = (common.column("a").to_numpy().astype(np.int64) << 32) | common.column("b").to_numpy()
    order = np.argsort(keys)
    table = (keys[order], common.column("total").to_numpy()[order], common.column("best").to_numpy()[order].astype(np.int64))
    shared = read.sparkSession.sparkContext.broadcast(table)
    kept = ["uid", "id", *NUMBERS, "groups_sha256"]
    schema = StructType(
        [
            *[read.schema[name] for name in kept],
            field("n_best", LongType()),
            field("count_sum", LongType()),
            *[field(f"rare_{name}", ArrayType(IntegerType())) for name in ("a", "b", "n")],
        ]
    )
    lists = pa.list_(pa.int32())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total, best = shared.value
        for batch in batches:
            a, b, n = (batch.column(len(kept) + k) for k in range(3))
            ends = np.cumsum(pc.list_value_length(a).to_numpy(zero_copy_only=False).astype(np.int64))
            flat_a, flat_b, flat_n = (c.flatten().to_numpy(zero_copy_only=False) for c in (a, b, n))
            wanted = (flat_a.astype(np.int64) << 32) | flat_b
            at = np.minimum(np.searchsorted(known, wanted), max(len(known) - 1, 0))
            hit = known[at] == wanted if len(known) else np.zeros(len(wanted), bool)
            at = at[hit]
            sums = []
            for worth in (best, total):
                each = np.zeros(len(wanted), np.int64)
                each[hit] = worth[at] * flat_n[hit]
                running = np.concatenate(([0], np.cumsum(each)))
                sums.append(np.diff(running[np.concatenate(([0], ends))]))
            rare = np.concatenate(([0], np.cumsum(~hit)))[np.concatenate(([0], ends))].astype(np.int32)
            left = [pa.ListArray.from_arrays(pa.array(rare), pa.array(c[~hit], pa.int32())) for c in (flat_a, flat_b, flat_n)]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k) for k in range(len(kept))], *[pa.array(s, pa.int64()) for s in sums],
                 *[c.cast(lists) for c in left]],
                names=schema.names,
            )

    found = saved(small_batches(read.select(*kept, "a", "b", "n")).mapInArrow(run, schema), "aligned")
    each = found.select("uid", F.explode(F.arrays_zip("rare_a", "rare_b", "rare_n")).alias("p"))
    rare = each.select("uid", F.col("p.rare_a").alias("a"), F.col("p.rare_b").alias("b"), F.col("p.rare_n").alias("n"))
    met = rare.join(counts.filter(F.col("total") < cut), ["a", "b"])
    more = met.groupBy("uid").agg(
        F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"), F.sum(F.col("total") * F.col("n")).alias("count_sum")
    )
    nulls = [F.lit(None).cast(found.schema[name].dataType).alias(name) for name in kept[1:]]
    both = found.select(*kept, "n_best", "count_sum").unionByName(more.select("uid", *nulls, "n_best", "count_sum"))
    summed = both.groupBy("uid").agg(
        *[F.max(name).alias(name) for name in kept[1:]], F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")
    )
    return summed.drop("uid")


def alignment(
    docs: DataFrame, path_a: str | None = None, path_b: str | None = None, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum) of each input row.

    Null and empty texts, and texts that either tokenizer does not give back byte by byte, have zeros and an
    empty digest. Repeated rows are rows of their own and count each time; a null id stays null. An empty
    table gives an empty result.
    """
    path_a = path_a or public_tokenizers.path("byte_bpe_50k.json")
    path_b = path_b or public_tokenizers.path("piece_bpe_32k.model")
    read = saved(align_documents(docs, path_a, path_b, doc_id, text), "alignment")
    found = scored(read, pair_counts(read))
    shown = [*NUMBERS, "n_best", "count_sum", "groups_sha256"]
    return found.select(F.col("id").alias(doc_id), *shown)
