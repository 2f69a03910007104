"""Histogram boosting against a plain version that holds all rows."""

import numpy as np
import pytest

from citytrace.operators import boosting
from citytrace.operators.boosting import BoostConfig, Boosted, fit_boosted


def plain_median(values, weights):
    order = np.argsort(values, kind="stable")
    running = np.cumsum(weights[order])
    return values[order][np.searchsorted(running, running[-1] / 2)]


def plain_boosted(x, y, w, config, loss):
    """Best-first trees over all distinct values; predictions of the training rows."""
    raw = np.full(len(y), np.average(y, weights=w) if loss == "squared" else plain_median(y, w))
    for _ in range(config.rounds):
        g = w * (raw - y if loss == "squared" else np.sign(raw - y))
        score = lambda m: g[m].sum() ** 2 / (w[m].sum() + config.l2)

        def best(mask, depth):
            found = (0.0, None, None)
            for f in range(x.shape[1]) if depth < config.depth else ():
                for cut in np.unique(x[:, f])[:-1]:
                    left, right = mask & (x[:, f] <= cut), mask & (x[:, f] > cut)
                    if min(left.sum(), right.sum()) >= config.min_leaf:
                        gain = score(left) + score(right) - score(mask)
                        if gain > found[0] + 1e-12:
                            found = (gain, left, right)
            return found

        leaves = [(np.ones(len(y), bool), 0)]
        splits = [best(*leaves[0])]
        while len(leaves) < config.leaves and max(s[0] for s in splits) > 0:
            at = max(range(len(splits)), key=lambda k: splits[k][0])
            (_, left, right), depth = splits.pop(at), leaves.pop(at)[1]
            for part in (left, right):
                leaves.append((part, depth + 1))
                splits.append(best(part, depth + 1))
        step = np.zeros(len(y))
        for mask, _ in leaves:
            step[mask] = -g[mask].sum() / (w[mask].sum() + config.l2) if loss == "squared" else plain_median((y - raw)[mask], w[mask])
        raw = raw + config.rate * step
    return raw


def table(spark, n=400, seed=0):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.integers(0, 12, n), rng.integers(0, 40, n) / 4, rng.normal(size=n).round(1)]).astype(float)
    y = x[:, 0] * 2 + np.where(x[:, 1] > 5, 7, 0) + x[:, 2] ** 2 + rng.normal(size=n)
    w = rng.integers(1, 6, n).astype(float)
    rows = [(*map(float, r), float(a), float(b), k) for k, (r, a, b) in enumerate(zip(x, y, w, strict=True))]
    return spark.createDataFrame(rows, "a double, b double, c double, y double, w double, k long").repartition(3), x, y, w


def predictions(df, model):
    return np.array([r["p"] for r in df.withColumn("p", model.prediction()).orderBy("k").collect()])


@pytest.mark.parametrize("loss", ["squared", "absolute"])
def test_trees_are_the_plain_ones(spark, loss, monkeypatch):
    """Several rounds, with a leaf bound that bites and predictions written between the rounds."""
    monkeypatch.setattr(boosting, "WRITE_EVERY", 2)
    df, x, y, w = table(spark)
    config = BoostConfig(rounds=3, depth=4, min_leaf=5, rate=0.3, leaves=7, patience=0)
    model = fit_boosted(df, ["a", "b", "c"], "y", "w", config, loss)
    assert len(model.trees) == 3 and all(sum(f < 0 for f in t.feature) <= 7 for t in model.trees)
    assert np.allclose(predictions(df, model), plain_boosted(x, y, w, config, loss), atol=1e-5)
    again = Boosted.of_frame(model.frame(spark), model.features)
    assert (predictions(df, again) == predictions(df, model)).all()


def test_rounds_stop_when_nothing_is_gained(spark):
    df, _, y, _ = table(spark, 600, 1)
    model = fit_boosted(df, ["a", "b", "c"], "y", "w", BoostConfig(rounds=60, depth=3, min_leaf=20, rate=1.0, patience=3))
    assert 3 <= len(model.trees) < 60
    assert np.abs(predictions(df, model) - y).mean() < np.abs(y - y.mean()).mean() / 3


def test_odd_rows(spark):
    rows = [(1.0, 2.0, 1.0, 0), (None, 9.0, 1.0, 1), (float("nan"), 9.0, 2.0, 2), (1.0, None, 1.0, 3), (2.0, 2.0, 0.0, 4), (2.0, 3.0, 1.0, 5)]
    df = spark.createDataFrame(rows, "x double, y double, w double, k long")
    model = fit_boosted(df, ["x"], "y", "w", BoostConfig(rounds=1, depth=2, min_leaf=1, rate=1.0, l2=0.0, patience=0))
    assert predictions(df, model) == pytest.approx([2, 9, 9, 2, 3, 3])
    none = fit_boosted(df.limit(0), ["x"], "y", "w", BoostConfig(rounds=2, depth=2, min_leaf=1))
    assert (predictions(df, none) == 0).all() and none.frame(spark).count() == 1
    one = fit_boosted(df.where("k = 0"), ["x"], "y", "w", BoostConfig(rounds=5, depth=2, min_leaf=1, patience=0), "absolute")
    assert predictions(df, one) == pytest.approx([2] * 6)
    with pytest.raises(ValueError, match="loss"):
        fit_boosted(df, ["x"], "y", "w", BoostConfig(rounds=1, depth=1, min_leaf=1), "other")


def test_split_gain_has_the_l2_term():
    sums = np.zeros((1, 256, 3))
    sums[0, 0], sums[0, 1] = (4.0, 2.0, 2.0), (-3.0, 1.0, 1.0)
    feature, cut, gain, g, h, rows = boosting.best_split(sums, 1, 0.5)
    assert (feature, cut, g, h, rows) == (0, 0, 4.0, 2.0, 2.0)
    assert gain == pytest.approx(16 / 2.5 + 9 / 1.5 - 1 / 3.5)
    assert boosting.best_split(sums, 2, 0.5) is None


def test_fits_read_written_inputs(spark, sf_dir, monkeypatch):
    """Both fits scan a table: no join and no fare model is repeated in their passes."""
    from citytrace.operators import forecast
    from verification import catalog

    plans = []

    def fit(df, features, *args):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return Boosted(tuple(features), 1.0, [])

    monkeypatch.setattr(forecast, "fit_boosted", fit)
    monkeypatch.setattr("verification.tables._WRITTEN", {})
    catalog._bundle(spark, sf_dir)
    assert len(plans) == 2
    for plan in plans:
        assert "Scan parquet" in plan and "Join" not in plan and "ArrowEvalPython" not in plan


def test_queries_fit_the_published_models(spark, sf_dir, monkeypatch):
    from citytrace.operators import forecast
    from verification import catalog

    configs = []

    def fit(df, features, label, weight, config, loss):
        configs.append((config.rounds, config.depth, config.min_leaf, config.patience))
        return Boosted(tuple(features), 1.0, [])

    monkeypatch.setattr(forecast, "fit_boosted", fit)
    monkeypatch.setattr("verification.tables._WRITTEN", {})
    catalog._bundle(spark, sf_dir)
    assert configs == [(500, 8, 40, 10), (450, 10, 30, 10)]


def test_medians_of_rows_in_several_blocks(spark, monkeypatch):
    """A leaf whose rows lie in many blocks and tasks has the weighted median of all of them."""
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 20)
    df, x, y, w = table(spark, 300, 3)
    config = BoostConfig(rounds=2, depth=3, min_leaf=5, rate=0.3, leaves=5, patience=0)
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(size)
    spark.conf.set(size, "8")
    try:
        model = fit_boosted(df, ["a", "b", "c"], "y", "w", config, "absolute")
    finally:
        spark.conf.set(size, before)
    assert np.allclose(predictions(df, model), plain_boosted(x, y, w, config, "absolute"), atol=1e-5)
