"""Leaf-wise trees against a plain builder, early stopping, missing values, samples."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinloom.config import BoostingConfig
from kinloom.operators import boosting, matcher, sampling


def table(seed, n, missing=0.2):
    chance = np.random.default_rng(seed)
    x = np.round(chance.normal(size=(n, 4)), 2)
    x[:, 2] = chance.integers(0, 3, n)
    x[chance.random((n, 4)) < missing] = np.nan
    y = (np.nan_to_num(x[:, 0], nan=0.7) + 0.5 * (x[:, 2] == 2) + 0.4 * chance.normal(size=n) > 0.4).astype(int)
    return x, y


def frame(spark, x, y, held=None, parts=3):
    held = np.zeros(len(y), bool) if held is None else held
    rows = [(i, int(b), bool(h), *[None if math.isnan(v) else float(v) for v in a]) for i, (a, b, h) in enumerate(zip(x, y, held, strict=True))]
    return spark.createDataFrame(rows, "key long, label int, held boolean, a double, b double, c double, d double").repartition(parts)


def plain_trees(bins, y, base, config, rounds):
    """Trees by trying every cut of every leaf, best leaf first: lists of ((feature, cut, missing left), gain), and the margins."""
    margins, out = np.full(len(y), base), []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margins))
        g, h = p - y, p * (1 - p)
        leaves, cuts = {0: np.arange(len(y))}, []

        def score(own, g=g, h=h):
            return g[own].sum() ** 2 / (h[own].sum() + config.lambda_l2)

        def best(own):
            found = None
            for f in range(bins.shape[1]):
                x = bins[own, f]
                for to_left in (True, False):
                    for cut in range(boosting.MISSING):
                        if not (x == cut).any() and cut:
                            continue
                        left = (x <= cut) & (x != boosting.MISSING) | (x == boosting.MISSING) & to_left
                        a, b = own[left], own[~left]
                        if min(len(a), len(b)) < config.min_data_in_leaf:
                            continue
                        gain = score(a) + score(b) - score(own)
                        if gain > 1e-12 and (found is None or gain > found[0] + 1e-9):
                            found = (gain, f, cut, a, b)
            return found

        options, number = {0: best(leaves[0])}, 1
        while len(leaves) < config.num_leaves and any(options.values()):
            leaf = max((k for k in options if options[k]), key=lambda k: options[k][0])
            gain, f, cut, a, b = options.pop(leaf)
            leaves.pop(leaf)
            cuts.append((f, cut, round(gain, 6)))
            for own in (a, b):
                leaves[number], options[number] = own, best(own)
                number += 1
        for own in leaves.values():
            margins[own] -= config.learning_rate * g[own].sum() / (h[own].sum() + config.lambda_l2)
        out.append(cuts)
    return out, margins


def test_equals_a_plain_builder(spark):
    x, y = table(1, 500)
    config = BoostingConfig(num_boost_round=3, num_leaves=6, min_data_in_leaf=10, max_bin=20, feature_fraction=1.0, bagging_fraction=1.0, learning_rate=0.3, lambda_l2=1.0)
    model = boosting.train(frame(spark, x, y), ["a", "b", "c", "d"], config)
    wanted, margins = plain_trees(boosting.binned(x, model.edges), y, model.base, config, 3)
    for tree, cuts in zip(model.trees, wanted, strict=True):
        own = [(f, c, round(g, 6)) for f, c, g in zip(tree.feature, tree.cut, tree.gain, strict=True) if f >= 0]
        assert sorted(own) == sorted(cuts) and len(own) == 5
    assert np.allclose(model.margins(x), margins, atol=1e-9)
    loss = np.mean(np.logaddexp(0, margins) - y * margins)
    assert model.curve[-1][0] == pytest.approx(loss) and model.best_iteration == 3
    # Neither partitions nor the order of rows matter.
    again = boosting.train(frame(spark, x, y, parts=1), ["a", "b", "c", "d"], config)
    assert np.allclose(again.margins(x), margins, atol=1e-9)


def test_early_stopping_keeps_the_best_round(spark, monkeypatch, tmp_path):
    x, y = table(2, 300)
    held = np.arange(300) % 3 == 0
    y = np.where(held, np.random.default_rng(0).integers(0, 2, 300), y)  # held labels cannot be learned
    config = BoostingConfig(num_boost_round=12, early_stopping_rounds=2, num_leaves=3, min_data_in_leaf=5, learning_rate=0.5, bagging_fraction=0.8)
    monkeypatch.setattr(boosting, "RESTAGE", 2)
    model = boosting.train(frame(spark, x, y, held), ["a", "b", "c", "d"], config)
    losses = [h for _, h in model.curve]
    assert len(losses) < 12 and len(model.trees) == model.best_iteration == int(np.argmin(losses)) + 1 == len(losses) - 2
    own = model.margins(x)[held]
    assert losses[model.best_iteration - 1] == pytest.approx(np.mean(np.logaddexp(0, own) - y[held] * own))
    model.save(spark, f"{tmp_path}/model")
    other = boosting.Booster.load(spark, f"{tmp_path}/model")
    assert other.fingerprint() == model.fingerprint() and np.array_equal(other.margins(x), model.margins(x))


def test_missing_values_take_their_own_side(spark):
    x = np.array([[float(i % 10), 0, 0, 0] for i in range(200)])
    x[::2, 0] = np.nan
    y = np.isnan(x[:, 0]).astype(int)
    model = boosting.train(frame(spark, x, y), ["a", "b"], BoostingConfig(num_boost_round=2, num_leaves=4, min_data_in_leaf=5, feature_fraction=1.0, bagging_fraction=1.0))
    margins = model.margins(x[:, :2])
    assert margins[::2].min() > margins[1::2].max()
    assert model.importances()[0][0] == "a" and model.importances()[1] == ("b", 0.0, 0)


def test_matcher_interface(spark):
    rows = [(f"S1-{i}", f"S2-{i}-{label}", label, "train" if i < 60 else "validation", float(label), None if i % 3 == 0 else 0.9 * label) for i in range(72) for label in (1, 0)]
    df = spark.createDataFrame(rows, "source1_entity_id string, candidate_entity_id string, label int, dataset_split string, name_exact double, lev double")
    config = BoostingConfig(num_boost_round=4, early_stopping_rounds=3, min_data_in_leaf=2, num_leaves=4, learning_rate=0.5, max_train_pairs=80, max_early_stopping_pairs=10)
    model = matcher.train(df, config, ["name_exact", "lev"])
    got = matcher.predict(model, df).join(df, ["source1_entity_id", "candidate_entity_id"]).collect()
    assert len(got) == len(rows) and all((r["match_probability"] >= 0.5) == bool(r["label"]) for r in got)
    assert matcher.fingerprint(matcher.train(df.repartition(5), config, ["name_exact", "lev"])) == matcher.fingerprint(model)
    assert matcher.predict(model, df.limit(0)).collect() == []
    for bad in (df.where("label = 1"), df.withColumn("lev", F.lit(float("inf")))):
        with pytest.raises(ValueError):
            matcher.train(bad, config, ["name_exact", "lev"])
    for bad in ({"num_leaves": 1}, {"max_bin": 255}, {"bagging_fraction": 0}, {"max_train_pairs": 0}, {"thresholds": [0.5, 0.2]}, {"other": 1}):
        with pytest.raises(ValueError):
            BoostingConfig.from_dict(bad)


def test_samples_of_exact_size(spark):
    df = spark.range(20_000).withColumnRenamed("id", "n")
    found = [sorted(r["n"] for r in sampling.uniform_sample(df.repartition(p), 5000, 7, "n").collect()) for p in (1, 9)]
    assert found[0] == found[1] and len(set(found[0])) == 5000
    whole = df.orderBy(F.md5(F.concat_ws("|", F.lit("7"), "n"))).limit(5000)
    assert sorted(r["n"] for r in whole.collect()) == found[0]
    assert sampling.uniform_sample(df, 30_000, 7, "n").count() == 20_000
