"""Cross-polytope search, cross-tokenizer alignment and importance resampling against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from citytrace.llm import alignment, crosspolytope, resampling
from citytrace.llm.queries import op11_cross_polytope, op12_alignment, op13_resampling


def plain_nearest(rows, k, wanted):
    """(query, rank, id, score) by comparing everything with everything."""
    usable = sorted({(i, tuple(map(float, v))) for i, v in rows if v and i is not None and None not in v
                     and all(map(math.isfinite, v)) and any(v)})
    out = []
    for i, q in usable:
        if wanted(i):
            near = [(-sum(a * b for a, b in zip(q, v, strict=True)), j) for j, v in usable if j != i and len(v) == len(q)]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(sorted(near)[:k])]
    return out


def same_neighbours(found, expected):
    assert [r[:3] for r in found] == [r[:3] for r in expected]
    assert np.allclose([r[3] for r in found], [r[3] for r in expected], rtol=1e-12, atol=1e-12)


def test_neighbours_of_odd_vectors_are_exact(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [1.0, 0.0]), (40, [-1.0, 0.5]), (60, None), (80, []), (100, [0.0, 0.0]), (120, [nan, 1.0])]
    rows += [(140, [inf, 1.0]), (160, [None, 1.0]), (None, [1.0, 1.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [3.0, 4.0, 0.0])]
    rows += [(180, [0.0, 0.0, 1e200]), (3, [0.5, 0.5]), (4, [1e-200, 0.0]), (200, [7.0])]
    table = spark.createDataFrame([(i, v, "k") for i, v in rows], "vec_id long, embedding array<double>, class string")
    found = sorted(map(tuple, crosspolytope.nearest_neighbours(table, k=3).collect()))
    same_neighbours(found, plain_nearest(rows, 3, lambda i: i % 20 == 0))
    assert crosspolytope.nearest_neighbours(table.limit(0)).count() == 0
    renamed = table.toDF("id", "key", "vector")
    again = crosspolytope.nearest_neighbours(renamed, k=3, vec_id="id", embedding="key")
    assert sorted(map(tuple, again.collect())) == found and again.columns == ["query_id", "rank", "vec_id", "score"]


def test_neighbours_of_masses_of_copies(spark):
    rng = np.random.default_rng(1)
    points = rng.normal(size=(40, 8)).astype(np.float32).tolist()
    rows = [(i, points[0] if i < 300 else points[i % 40]) for i in range(500)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = sorted(map(tuple, crosspolytope.nearest_neighbours(table, k=20).collect()))
    same_neighbours(found, plain_nearest(rows, 20, lambda i: i % 20 == 0))


@pytest.mark.parametrize("dims", [3, 64, 300])
def test_divided_cells_find_neighbours(spark, dims):
    """Small leaves: cells are divided several times, a tight cluster to the last level, and lengths differ."""
    rng = np.random.default_rng(dims)
    centres = rng.normal(size=(12, dims))
    x = centres[rng.integers(12, size=900)] + 0.3 * rng.normal(size=(900, dims))
    x[:120] = centres[0] + 1e-7 * rng.normal(size=(120, dims))
    x[200:300] *= 5
    table = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    found = crosspolytope.nearest_neighbours(table, k=20, leaf=64).toPandas()
    scores = x[::20] @ x.T
    hits = 0
    for row, (q, near) in enumerate(found.sort_values("rank").groupby("query_id")["vec_id"]):
        own = scores[row].copy()
        own[q] = -np.inf
        hits += len(set(np.argsort(-own)[:20]) & set(near))
    assert (found.groupby("query_id").size() == 20).all() and found["query_id"].nunique() == 45
    assert hits / (45 * 20) >= 0.9


def test_too_few_found_are_compared_with_all(spark, monkeypatch):
    monkeypatch.setattr(crosspolytope, "TABLES", 1)
    monkeypatch.setattr(crosspolytope, "PROBES", (1,) * 6)
    x = np.random.default_rng(3).normal(size=(300, 16))
    rows = list(enumerate(x.tolist()))
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = sorted(map(tuple, crosspolytope.nearest_neighbours(table, k=290, leaf=16).collect()))
    same_neighbours(found, plain_nearest(rows, 290, lambda i: i % 20 == 0))


def test_recall_over_the_whole_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").toPandas()
    x = np.array(table["embedding"].tolist(), np.float64)
    found = op11_cross_polytope(spark, sf_dir).toPandas()
    hits = total = 0
    for q, group in found.groupby("query_id"):
        own = x @ x[table["vec_id"] == q][0]
        own[table["vec_id"] == q] = -np.inf
        hits += len(set(table["vec_id"].to_numpy()[np.argsort(-own, kind="stable")[:20]]) & set(group["vec_id"]))
        total += min(20, len(x) - 1)
        assert group.sort_values("rank")["score"].is_monotonic_decreasing
    assert hits / total >= 0.9


def test_hadamard_is_a_rotation():
    x = np.random.default_rng(0).normal(size=(5, 32))
    assert np.allclose(np.linalg.norm(crosspolytope.hadamard(x), axis=1), np.linalg.norm(x, axis=1))
    assert np.allclose(crosspolytope.hadamard(crosspolytope.hadamard(x)), x)
    y = crosspolytope.rotated(x, 0, 0)
    best, _ = crosspolytope.likely_cells(y, 1)
    assert (best[:, 0] == crosspolytope.nearest_cell(y)).all()


# ---- alignment ----


def plain_pieces(model, text):
    out = []
    for k in model.encode(text):
        piece = model.id_to_piece(k)
        byte = re.fullmatch(r"<0x(..)>", piece)
        out.append((k, bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode()))
    return out


def plain_byte_level(tokenizer, text):
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    back = {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(rest)}
    ids = tokenizer.encode(text, add_special_tokens=False).ids
    return [(k, bytes(back.get(c, 0) for c in tokenizer.id_to_token(k))) for k in ids]


def plain_alignment(rows):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    docs, counts = [], Counter()
    for doc, text in rows:
        a = plain_byte_level(tokenizer, " " + text) if text else []
        b = plain_pieces(model, text) if text else []
        wanted = (" " + text).encode() if text else b""
        if b"".join(t for _, t in a) != wanted or b"".join(t for _, t in b) != wanted:
            a, b = [], []
        spans = []
        for tokens in (a, b):
            ends = np.cumsum([len(t) for _, t in tokens]).tolist()
            spans.append(list(zip([0, *ends], ends, strict=False)))
        links = [(a[i][0], b[j][0]) for i, (s, e) in enumerate(spans[0]) for j, (s2, e2) in enumerate(spans[1])
                 if s < e2 and s2 < e]
        cuts = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups = []
        for low, high in zip([0, *cuts], cuts, strict=False):
            parts = [",".join(str(t[0]) for t, (s, e) in zip(x, sp, strict=True) if low <= s and e <= high) for x, sp in zip((a, b), spans, strict=True)]
            groups.append("|".join(parts))
        counts.update(links)
        docs.append((doc, len(a), len(b), groups, links))
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return [
        (doc, n_a, n_b, len(groups), len(links), sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links),
         hashlib.sha256(";".join(groups).encode()).hexdigest() if n_a else "")
        for doc, n_a, n_b, groups, links in docs
    ]


ODD_TEXTS = ["  a  b ", "a\n\nb", "\tx", "<|endoftext|> <s> é ﬁ", "a▁b", "x\x00y", " ", "x\x1cy", "日本 語  ", "a'S 's don't", "\n \n x",
             "  \n  ", "é" * 50, "ÀÉ ſtraße’s 12ab", "<0x41> <unk>", "", None, "naïve 🙂🙂 end ", "don't  'll", "The cat", "The cat"]


def key(row):
    return tuple((v is None, str(v)) for v in row)


@pytest.mark.parametrize("most", [1 << 20, 40, 0])
def test_alignment_matches_all_pairs(spark, sf_dir, monkeypatch, most):
    """Whatever number of pairs travels to the tasks, with odd, repeated and null rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").orderBy("doc_id").limit(12)
    rows = [tuple(r) for r in docs.collect()] + list(enumerate(ODD_TEXTS, 10**6)) + [(None, "The cat"), (10**6, "  a  b ")]
    table = spark.createDataFrame([(*r, "k", "k") for r in rows], "doc_id long, text string, n string, uid string")
    read = alignment.align_documents(table, *(public_tokenizers.path(p) for p in ("byte_bpe_50k.json", "piece_bpe_32k.model")))
    read = alignment.saved(read, "alignment")
    found = alignment.scored(read, alignment.pair_counts(read), most)
    names = ["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, found.select(*names).collect()), key=key) == sorted(plain_alignment(rows), key=key)


def test_alignment_query_on_the_whole_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    found = op12_alignment(spark, sf_dir).select(*names).collect()
    rows.sort(key=lambda r: len(r[1] or ""))
    assert len(found) == len(rows)
    assert sum(r["n_a"] for r in found) > 0 and all(r["n_links"] == r["n_a"] + r["n_b"] - r["n_groups"] for r in found)


def test_alignment_of_odd_documents(spark, odd_docs, no_docs):
    assert alignment.alignment(no_docs).count() == 0
    found = alignment.alignment(odd_docs).collect()
    assert len(found) == odd_docs.count()
    for row in found:
        assert (row["n_a"] == 0) == (row["groups_sha256"] == "")


def test_stretches_double_and_halve():
    random.seed(4)
    for n in (1, 2, 3, 7, 8, 9, 31, 100):
        one = sorted(random.sample(range(1, 10_000), n))
        for same in range(n + 1):
            two = [x if k < same else x + 10_000 for k, x in enumerate(one)]
            assert alignment.matching_stretch(one, two, 0, 0) == same
    for _ in range(300):
        end = random.randrange(1, 60)
        one, two = (sorted({*random.sample(range(1, end + 1), random.randrange(1, end + 1)), end}) for _ in range(2))
        cuts_a, cuts_b = alignment.aligned(one, two)
        common = sorted(set(one) & set(two))
        spans = [list(zip([0, *x], x, strict=False)) for x in (one, two)]
        pairs = [(i, j) for i, (s, e) in enumerate(spans[0]) for j, (s2, e2) in enumerate(spans[1]) if s < e2 and s2 < e]
        assert list(zip(*(x.tolist() for x in alignment.linked(np.array(one), np.array(two))), strict=True)) == pairs
        assert [one[k - 1] for k in cuts_a] == [two[k - 1] for k in cuts_b] == common


# ---- resampling ----


def plain_resampled(docs, items, buckets=10_000, least=20, percent=10):
    bucket = lambda w: zlib.crc32(w.encode()) % buckets
    words = [resampling.lowered_words(t) for _, t in docs]
    s, t = Counter(map(bucket, sum(words, []))), Counter(bucket(w) for text in items for w in resampling.lowered_words(text))
    n_s, n_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (n_s + buckets) / ((s[b] + 1) * (n_t + buckets))))
    rows = []
    for (doc, _), found in zip(docs, words, strict=True):
        weight = sum(gain(bucket(w)) for w in found)
        h = int(hashlib.sha256(f"2024:{doc}".encode()).hexdigest()[:8], 16)
        score = None if doc is None else weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc, len(found), weight, score, None])
    able = sorted((r for r in rows if r[1] >= least and r[3] is not None), key=lambda r: (-r[3], r[0]))
    for rank, row in enumerate(able[: len(able) * percent // 100], 1):
        row[4] = rank
    return sorted(map(tuple, rows), key=key)


def test_resampling_is_its_plain_version(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    items = [r[0] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("text").collect()]
    assert sorted(map(tuple, op13_resampling(spark, sf_dir).collect()), key=key) == plain_resampled(docs, items)


def test_resampling_of_odd_documents(spark, odd_docs, no_docs, monkeypatch):
    monkeypatch.setattr(resampling, "OCCURRENCES_AT_ONCE", 16)
    target = spark.createDataFrame([("the lazy fox",), (None,), ("",)], "text string")
    docs = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    found = resampling.resampled(odd_docs, target, least_words=2, percent=60)
    assert sorted(map(tuple, found.collect()), key=key) == plain_resampled(docs, ["the lazy fox"], least=2, percent=60)
    assert resampling.resampled(no_docs, target).count() == 0
    none = resampling.resampled(odd_docs, target.limit(0), least_words=2, percent=60)
    assert sorted(map(tuple, none.collect()), key=key) == plain_resampled(docs, [], least=2, percent=60)


def test_table_verifies_the_bytes_of_equal_keys(monkeypatch):
    """With all keys equal or nearly so, n-grams are told apart by their bytes alone, also when it grows."""
    random.seed(2)
    monkeypatch.setattr(resampling.xxhash, "xxh64_intdigest", lambda gram: len(gram) % 2)
    table = resampling.InternTable(size=4)
    words = [b"%d" % random.randrange(3000) for _ in range(9000)]
    for at in range(0, 9000, 1000):
        slots = table.intern(words[at : at + 1000])
        assert [table.grams[s] for s in slots] == words[at : at + 1000]
    counted = Counter(words)
    held = {g: n for g, n in zip(table.grams, table.count, strict=True) if g is not None}
    assert held == counted and table.used == len(counted)
    assert all(table.bucket[k] == zlib.crc32(g) % table.buckets for k, g in enumerate(table.grams) if g is not None)


def test_runs_of_several_words():
    assert resampling.features_of([b"a", b"b", b"c"], 3) == [b"a", b"b", b"c", b"a b", b"b c", b"a b c"]
    assert resampling.words_of("Éa B-c_9\x7fx") == "Éa b c 9 x".encode().split()


def test_ranks_over_several_ranges(spark):
    rows = [(k, k * 7919 % 1000) for k in range(1000)] + [(5, 3), (5, 3)]
    table = spark.createDataFrame(rows, "id long, score long").selectExpr("id", "score", "monotonically_increasing_id() as uid")
    keys = [table["score"].desc(), table["id"].asc(), table["uid"].asc()]
    found = resampling.ranked(resampling.saved(table, "rows"), [resampling.F.col("score").desc(), resampling.F.col("id").asc(), resampling.F.col("uid").asc()], 100)
    got = [(r["score"], r["id"]) for r in sorted(found.collect(), key=lambda r: r["rank"])]
    assert len(keys) == 3 and got == sorted([(s, i) for i, s in rows], key=lambda r: (-r[0], r[1]))
    assert sorted(r["rank"] for r in found.collect()) == list(range(1, 1003))


def test_words_are_proven_together():
    """Ids whose bytes are right as a whole but cut at other places are found out word by word."""
    token_bytes = [b" ab", b"c", b" a", b"bc", " ß".encode(), b" d"]
    right = {" abc": [0, 1], " ß": [4], " d": [5]}
    tried = []

    class Bytes(list):
        def __getitem__(self, k):
            tried.append(k)
            return super().__getitem__(k)

    cache = alignment.WordCache(lambda words: [right[w] for w in words], Bytes(token_bytes))
    assert [ids.tolist() for ids in cache.ids([[" abc", " ß"], [" d", " abc"]])] == [[0, 1, 4], [5, 0, 1]]
    assert sorted(tried) == [0, 1, 4, 5]  # each id once: no word was tried by itself
    shifted = {" ab": [2], "bc": []}  # both lack bytes
    cache = alignment.WordCache(lambda words: [shifted[w] for w in words], token_bytes)
    assert cache.ids([[" ab"], ["bc"]]) == [None, None]
    cache = alignment.WordCache(lambda words: [{" ab": [0, 1], "c": []}[w] for w in words], token_bytes)
    assert cache.ids([[" ab"], ["c"]]) == [None, None]
