import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from citytrace.operators import sampling
from citytrace.operators.quantiles import exact_quantiles, stacked_quantiles
from tests.conftest import rows

PROBS = {"a": 0.25, "b": 0.5, "c": 0.98}


def skewed(spark):
    """One key holds half of the rows, and one value a third of that key."""
    rng = np.random.default_rng(5)
    data = [("hot", float(v)) for v in np.round(rng.normal(0, 40, 4000), 3)] + [("hot", 7.5)] * 2000
    data += [(f"k{i % 300}", float(v)) for i, v in enumerate(np.round(rng.exponential(9, 3000), 2))]
    data += [("one", -3.0), ("none", None), ("none", float("nan"))]
    return spark.createDataFrame(data, "k string, v double").repartition(7), data


@pytest.mark.parametrize("scale", [1.0, 1e-9])
def test_quantiles_match_numpy(spark, scale):
    """Also with all values within a hair of each other: tasks get equal shares of any values."""
    df, data = skewed(spark)
    df, data = df.withColumn("v", F.col("v") * scale), [(k, v * scale if v is not None else v) for k, v in data]
    got = {r["k"]: r for r in exact_quantiles(df, ["k"], "v", PROBS, "n").collect()}
    groups = {}
    for k, v in data:
        if v is not None and v == v:
            groups.setdefault(k, []).append(v)
    assert set(got) == set(groups)
    for k, vs in groups.items():
        assert got[k]["n"] == len(vs)
        for name, p in PROBS.items():
            assert got[k][name] == pytest.approx(np.quantile(vs, p), rel=1e-12, abs=1e-12)


def test_blend_of_neighbours_is_rounded_once(spark):
    """A flag compares with >=, so a threshold must not be a bit off that of the SQL."""
    rng = np.random.default_rng(8)
    starts = rng.random(400) * 900
    data = [(k, float(v + i * np.spacing(v))) for k, v in enumerate(starts) for i in range(1 + k % 40)]
    got = {r["k"]: r["q"] for r in exact_quantiles(spark.createDataFrame(data, "k int, v double"), ["k"], "v", {"q": 0.985}).collect()}
    for k, v in enumerate(starts):
        vs = [x for key, x in data if key == k]
        pos = (len(vs) - 1) * 0.985
        low, high, part = vs[math.floor(pos)], vs[math.ceil(pos)], pos - math.floor(pos)
        assert got[k] == (low if low == high else math.fma(low, 1 - part, high * part))


def test_stacked_quantiles(spark):
    df, data = skewed(spark)
    df = df.select(F.when(F.col("k") != "none", F.length("k")).alias("g"), F.col("v"), (F.col("v") * 2).alias("w"))
    got = {r["g"]: r for r in stacked_quantiles(df, {"v": {"a": 0.25}, "w": {"b": 0.5}}, "g").collect()}
    groups = {None: [v for _, v in data if v is not None and v == v]}
    for k, v in data:
        if k != "none":
            groups.setdefault(len(k), []).append(v)
    assert set(got) == set(groups)
    for g, vs in groups.items():
        assert (got[g]["a"], got[g]["b"]) == pytest.approx((np.quantile(vs, 0.25), 2 * np.quantile(vs, 0.5)), rel=1e-12)


def test_global_quantiles_and_weights(spark):
    df, data = skewed(spark)
    vs = [v for _, v in data if v is not None and v == v]
    row = exact_quantiles(df, [], "v", PROBS, "n").first()
    assert row["n"] == len(vs)
    assert [row[n] for n in PROBS] == pytest.approx([np.quantile(vs, p) for p in PROBS.values()], rel=1e-12)
    folded = df.groupBy("k", "v").agg(F.count(F.lit(1)).alias("w"))
    assert exact_quantiles(folded, [], "v", PROBS, "n", weight="w").first() == row
    assert rows(exact_quantiles(df.limit(0), [], "v", PROBS)) == [(None, None, None)]


def brute(pdf, n):
    return sorted(pdf, key=lambda t: (t[1], t))[:n]


@pytest.mark.parametrize("n", [0, 1, 99, 100, 700, 5000])
def test_take_smallest_is_exact_with_copies(spark, n):
    """A third of the rows are copies of one row; the cut may fall into them."""
    data = [(i, (i * 37) % 500) for i in range(600)] + [(3, 111)] * 300
    df = spark.createDataFrame(data, "i int, k int").repartition(6)
    got = rows(sampling.take_smallest(df, n, F.col("k"), 500))
    assert [tuple(map(int, r)) for r in got] == [tuple(r) for r in sorted(brute(data, n), key=lambda t: (str(t[0]), str(t[1])))]


def test_capped_sample(spark):
    df = spark.range(10_000).withColumn("k", F.col("id") * 7919 % 10_007)
    some = sampling.sample_capped(df, 0.1, 100_000, F.col("k"), 10_007)
    assert some.count() == df.where(F.col("k") < 1000).count()
    assert sampling.sample_capped(df, 0.1, 250, F.col("k"), 10_007).count() == 250
    hashed = sampling.sample_n(df, 500, sampling.hash_key("id"))
    assert rows(hashed) == rows(sampling.sample_n(df.repartition(13), 500, sampling.hash_key("id")))


@pytest.mark.parametrize("n, sizes", [(10, {"a": 1, "b": 1, "c": 8}), (50, {"a": 1, "b": 1, "c": 48}), (2, None), (100, None), (0, None), (400, None)])
def test_stratified(spark, n, sizes):
    data = [("a", 0)] + [("b", i) for i in range(2)] + [("c", i) for i in range(97)]
    df = spark.createDataFrame(data, "s string, i int")
    got = sampling.stratified_sample(df, "s", n, F.col("i") * 31 % 101, 101)
    expected = len(data) if n <= 0 else min(n, len(data))
    assert got.count() == expected
    assert got.distinct().count() == expected
    if sizes:
        counts = dict(rows(got.groupBy("s").count()))
        assert counts.keys() == sizes.keys()
        assert sum(counts.values()) == n and counts["a"] == 1


def test_stratified_tops_up(spark):
    """Three strata of 5 and n = 7: two rows each by rounding, one more from the rest."""
    df = spark.createDataFrame([(s, i) for s in "abc" for i in range(5)], "s string, i int")
    got = sampling.stratified_sample(df, "s", 7, F.col("i") * 3 + F.ascii("s"), 200)
    assert sorted(c for _, c in rows(got.groupBy("s").count())) == [2, 2, 3]


@pytest.mark.parametrize("n", [1, 150, 700, 2999])
def test_take_with_one_key_for_all_rows(spark, n):
    """All rows fall into the slice of the cut; a third are copies of one row, and tasks share the order."""
    data = [(i, 4) for i in range(2000)] + [(700, 4)] * 1000
    df = spark.createDataFrame(data, "i int, k int").repartition(6)
    got = sampling.take_smallest(df, n, F.col("k"), 500)
    assert sorted(r["i"] for r in got.collect()) == sorted(i for i, _ in data)[:n]


def test_preceding_sums(spark):
    rng = np.random.default_rng(3)
    data = [("hot" if i % 3 else f"g{i % 7}", i, int(w)) for i, w in enumerate(rng.integers(1, 9, 3000))]
    df = spark.createDataFrame(data, "g string, i int, w int").repartition(5)
    for by in ([], ["g"]):
        got = {r["i"]: r["_before"] for r in sampling.preceding(df, by, ["i"], "w").collect()}
        totals, plain = {}, {}
        for g, i, w in data:
            key = g if by else None
            plain[i] = totals.get(key, 0)
            totals[key] = plain[i] + w
        assert got == plain
    many = spark.range(5000).select("id", (F.col("id") % 5 + 1).alias("m"))
    got = {r["id"]: r["_before"] for r in sampling.running(many, [], "id", "m").collect()}
    assert got == {i: sum(k % 5 + 1 for k in range(i)) for i in range(0, 5000, 1)}


def test_stratified_with_copies(spark):
    """A stratum of copies of one row keeps its share; no task gets all of them."""
    df = spark.createDataFrame([("a", 1)] * 600 + [("b", i) for i in range(300)], "s string, i int").repartition(6)
    got = sampling.stratified_sample(df, "s", 90, F.col("i") * 31 % 301, 301)
    assert dict(rows(got.groupBy("s").count())) == {"a": 60, "b": 30}
    best = sorted(range(300), key=lambda i: (i * 31 % 301, i))[:30]
    assert sorted(r["i"] for r in got.where("s = 'b'").collect()) == sorted(best)
