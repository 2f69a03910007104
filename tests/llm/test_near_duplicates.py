"""SimHash balls, the grid order join and components against brute force."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from citytrace.llm import gridjoin, simhash
from citytrace.llm.shared import component_roots


def components(nodes, links):
    parent = {n: n for n in nodes}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        p, q = top(a), top(b)
        parent[max(p, q)] = min(p, q)
    return {n: top(n) for n in nodes}


def plain_fingerprint(text, n=3):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in "".join(" " if c in " \t\n\v\f\r" else c for c in lowered).split(" ") if w]
    grams = [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", ["", None, "one", "One TWO", "a b c d e f g", "É Ça\tva\x0bbien\x1cla \u00a0x", "x y " * 50])
def test_fingerprint_is_the_majority_of_shingle_hashes(text):
    found = simhash.fingerprint(text, 3)
    assert found % (1 << 64) == plain_fingerprint(text)


def test_components_of_chains_stars_and_rings(spark):
    random.seed(3)
    chain = [(i, i + 1) for i in range(100, 400)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    shuffled = [(random.randrange(5000, 5200), random.randrange(5000, 5200)) for _ in range(120)]
    links = [e for e in chain + star + shuffled + [(-5, 3), (3, -5)] if e[0] != e[1]]
    found = component_roots(spark.createDataFrame(links, "a long, b long")).collect()
    roots = {r["node"]: r["root"] for r in found}
    expected = components(roots, links)
    groups = lambda d: sorted(sorted(n for n in d if d[n] == r) for r in set(d.values()))
    assert groups(roots) == groups(expected) and len(found) == len(roots)
    assert component_roots(spark.createDataFrame([], "a long, b long")).count() == 0


def test_fingerprint_links_match_all_pairs(spark):
    random.seed(5)
    seeds = [random.getrandbits(64) for _ in range(40)]
    values = set(seeds)
    for s in seeds:
        for _ in range(6):
            flipped = s
            for bit in random.sample(range(64), random.randint(1, 4)):
                flipped ^= 1 << bit
            values.add(flipped)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "fp long")
    for radius in (0, 2, 4):
        near = [(a, b) for a in signed for b in signed if a < b and bin((a ^ b) % (1 << 64)).count("1") <= radius]
        found = [(r["a"], r["b"]) for r in simhash.links(df, radius).collect()]
        assert components(signed, found) == components(signed, near)
        assert set(found) <= set(near)
    with pytest.raises(ValueError):
        simhash.links(df, 3)


def test_near_duplicate_documents(spark, odd_docs, no_docs):
    found = simhash.near_duplicates(odd_docs).collect()
    assert len(found) == odd_docs.count()
    by_id = {r["doc_id"]: r["component_id"] for r in found}
    assert by_id[7] == by_id[1] == 1
    assert by_id[2] == by_id[3] == by_id[5] == 2  # no words: fingerprint zero, linked like any other
    assert simhash.near_duplicates(no_docs).count() == 0


def test_one_document_of_each_group_stays(spark, odd_docs, no_docs):
    kept = simhash.one_of_each(odd_docs, simhash.near_duplicates(odd_docs))
    assert kept.columns == odd_docs.columns
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == [-1, 1, 2, 4, 6]
    assert simhash.one_of_each(no_docs, simhash.near_duplicates(no_docs)).count() == 0


def test_simhash_of_the_driver_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    prints = {r["doc_id"]: plain_fingerprint(r["text"]) for r in rows}
    links = [(a, b) for a in prints for b in prints if a < b and bin(prints[a] ^ prints[b]).count("1") <= 2]
    expected = components(prints, links)
    found = simhash.near_duplicates(docs).withColumn("hex", simhash.hex_digits(F.col("fp"))).collect()
    assert {r["doc_id"]: (r["hex"], r["component_id"]) for r in found} == {
        d: (f"{prints[d]:016x}", expected[d]) for d in prints
    }


def brute_vectors(rows, limit):
    real = []
    for key, v in rows:
        ok = v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
        real.append((key, np.array(v, float)) if ok else (key, None))
    links = []
    for i, (_, a) in enumerate(real):
        for j, (_, b) in enumerate(real):
            if i < j and a is not None and b is not None and len(a) == len(b):
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= limit:
                    links.append((i, j))
    of = components(range(len(real)), links)
    ids = [k for k, _ in real]
    lowest = {r: min(ids[i] for i in of if of[i] == r) for r in of.values()}
    return sorted((ids[i], sum(i in e for e in links), lowest[of[i]], ids[i] == lowest[of[i]]) for i in of)


@pytest.mark.parametrize("interval", [16, 4096])
def test_grid_join_matches_all_pairs(spark, monkeypatch, interval):
    monkeypatch.setattr(gridjoin, "INTERVAL", interval)
    monkeypatch.setattr(gridjoin, "LEAF", 8)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 16))
    rows = [(int(k), (centres[k % 12] + rng.normal(size=16) * (0.02 if k % 3 else 0.3)).tolist()) for k in range(150)]
    rows += [(200 + k, centres[3].tolist()) for k in range(40)]  # copies
    rows += [(300, [0.0] * 16), (301, None), (302, []), (303, [float("nan")] * 16), (304, [None] + [1.0] * 15)]
    rows += [(305, [float("inf")] * 16), (306, [1e300] * 16), (307, [1e-300] * 16), (308, [1.0, 2.0]), (309, [2.0, 4.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    with np.errstate(all="ignore"):
        unit = [(k, (np.array(v) / np.max(np.abs(v))).tolist() if k in (306, 307) else v) for k, v in rows]
    found = gridjoin.near_duplicates(df)
    assert sorted(tuple(r) for r in found.collect()) == brute_vectors(unit, 0.95)


@pytest.mark.parametrize("turned", [2, 64])
def test_grid_join_of_wide_vectors(spark, monkeypatch, turned):
    """3,072 dimensions, of which the first few only are turned to their axes."""
    monkeypatch.setattr(gridjoin, "TURNED", turned)
    monkeypatch.setattr(gridjoin, "INTERVAL", 16)
    monkeypatch.setattr(gridjoin, "LEAF", 8)
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(9, 3072))
    rows = [(k, (centres[k % 9] + rng.normal(size=3072) * (0.02, 0.2, 0.5)[k % 3]).tolist()) for k in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(tuple(r) for r in gridjoin.near_duplicates(df).collect()) == brute_vectors(rows, 0.95)


@pytest.mark.parametrize(("dims", "limit"), [(40, 0.95), (40, 0.6), (12, 0.3), (64, 1.0)])
def test_chunks_are_joined_like_all_pairs(monkeypatch, dims, limit):
    """Near and far, sparse and dense pieces, equal vectors at a limit of one."""
    monkeypatch.setattr(gridjoin, "LEAF", 16)
    rng = np.random.default_rng(dims)
    centres = rng.normal(size=(9, dims))
    x = np.sort(rng.integers(0, 9, 130))
    x = centres[x] + rng.normal(size=(130, dims)) * rng.choice([0.0, 0.05, 0.3], (130, 1))
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    a, b = gridjoin._cut(0, np.ones(70, int), x[:70]), gridjoin._cut(70, np.ones(60, int), x[70:])
    whole = gridjoin._cut(0, np.ones(130, int), x)
    links = lambda *found: sorted((int(i), int(j)) for f in found for p, q in f for i, j in zip(p, q, strict=True))
    equal = (np.abs(x[:, None] - x[None]) < 1e-15).all(axis=2)
    expected = [(i, j) for i in range(130) for j in range(i + 1, 130) if x[i] @ x[j] >= limit or equal[i, j]]
    across = [(i, j - 70) for i, j in expected if i < 70 <= j]
    if limit < 1:
        assert links(gridjoin.join_chunks(whole, whole, limit)) == expected
        assert links(gridjoin.join_chunks(a, b, limit)) == across
    else:
        assert set(links(gridjoin.join_chunks(whole, whole, limit))) >= {(i, j) for i, j in expected if equal[i, j]}


def test_grid_join_deals_out_a_vector_once(spark, monkeypatch):
    """No vector travels again for the intervals it meets, however many those are."""
    plans, saved = {}, gridjoin.saved

    def recorded(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return saved(df, name)

    monkeypatch.setattr(gridjoin, "saved", recorded)
    monkeypatch.setattr(gridjoin, "INTERVAL", 16)
    rng = np.random.default_rng(11)
    rows = [(k, rng.normal(size=8).tolist()) for k in range(120)] + [(None, [1.0] * 8), (500, [1.0] * 8), (501, [-0.0] + [1.0] * 7)]
    df = spark.createDataFrame([*rows, (502, [0.0] + [1.0] * 7)], "vec_id long, embedding array<float>")
    found = {r["vec_id"]: tuple(r)[1:] for r in gridjoin.near_duplicates(df, limit=0.999).collect()}
    assert "Exchange" not in plans["class-links"] and "Join" not in plans["class-links"]
    assert found[None] == (1, 500, False) and found[500] == (1, 500, True)
    assert found[501] == (1, 501, True) and found[502] == (1, 501, False)


def test_grid_join_of_nothing(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, hash string, vector string")
    assert gridjoin.near_duplicates(empty).count() == 0
    null = spark.createDataFrame([(None, None), (1, None)], "vec_id long, embedding array<float>")
    assert sorted(str(tuple(r)) for r in gridjoin.near_duplicates(null).collect()) == [
        "(1, 0, 1, True)", "(None, 0, None, True)"]
