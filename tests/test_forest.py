"""Forests by brute force, and the same whatever the layout."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from popforge.functions.rng import uniform
from popforge.operators import forest, impute, ranges
from popforge.sources import storage


@pytest.fixture(scope="module")
def donors(spark):
    rng = np.random.default_rng(5)
    rows = []
    for k in range(1500):
        a, b, c = float(rng.integers(0, 50)), float(rng.random()), float(rng.integers(0, 3))
        y = (10.0 if a > 30 else 0.0) + (5.0 if b > 0.5 else 0.0) + float(rng.normal())
        rows.append((k, a, b if k % 17 else None, c, y if k % 50 else None, float(y > 8), float(k % 4)))
    return spark.createDataFrame(rows, "id long, a double, b double, c double, y double, z double, w double")


def test_same_forest_and_draws_from_2_16_and_200_partitions(spark, donors):
    asked = spark.range(400).select("id", (F.col("id") % 50).cast("double").alias("a"), (F.col("id") / 400).alias("b"), F.lit(1.0).alias("c"))
    found = []
    for n in (2, 16, 200):
        laid = donors.repartition(n, F.rand(n)).cache()
        sampler = impute.ForestSampler(["a", "b", "c"], "y", "id", "w", trees=4, depth=3, least=5).fit(laid)
        found.append((sampler.forest.feature.tolist(), sampler.forest.cut.tolist(), sorted(map(tuple, sampler.draw(asked.repartition(n), "id").collect()))))
    assert found[0] == found[1] == found[2]
    assert len({d for _, d in found[0][2]}) > 50


def test_splits_by_brute_force(donors):
    """The first split of every tree, over all cuts of its predictors."""
    rows = donors.where("y is not null and w > 0").toPandas()
    hashes = donors.sparkSession.createDataFrame(rows[["id"]]).select(F.xxhash64(F.col("id").cast("string")).alias("h")).toPandas()["h"].to_numpy()
    (grown,) = forest.grow(donors, [forest.Problem("y", ("a", "b", "c"), 9)], "id", "w", trees=6, depth=1, least=20)
    for tree in range(6):
        times = forest._counts(hashes, 9 * 1_000_003 + tree)
        assert abs(times.mean() - 1) < 0.1 and set(times) >= {0, 1, 2}
        seen = rows[times > 0].assign(t=times[times > 0])
        weight, y, best = (seen.w * seen.t).to_numpy(), seen.y.to_numpy(), None
        error = lambda m: (weight[m] * (y[m] - np.average(y[m], weights=weight[m])) ** 2).sum()
        for k in forest._allowed(tree, 0, 3, 9):
            values = seen["abc"[k]].to_numpy()
            for cut, threshold in enumerate(grown.thresholds[k]):
                left = values <= threshold  # missing values go right
                if min(left.sum(), (~left).sum()) >= 20:
                    gain = error(np.ones(len(y), bool)) - error(left) - error(~left)
                    if best is None or gain > best[0] * (1 + 1e-9):
                        best = (gain, k, cut)
        assert (grown.feature[tree, 0], grown.cut[tree, 0]) == best[1:]


def test_forests_grown_together_are_those_grown_alone(donors, monkeypatch):
    problems = [forest.Problem("y", ("a", "b"), 1), forest.Problem("z", ("a", "b", "y"), 2), forest.Problem("z", (), 3)]
    together = forest.grow(donors, problems, "id", None, trees=3, depth=3, least=10)
    monkeypatch.setattr(forest, "CELLS", 1)  # one problem a job
    apart = forest.grow(donors, problems, "id", None, trees=3, depth=3, least=10)
    alone = [forest.grow(donors, [p], "id", None, trees=3, depth=3, least=10)[0] for p in problems]
    for one, two, three in zip(together, apart, alone, strict=True):
        assert np.array_equal(one.feature, two.feature) and np.array_equal(one.feature, three.feature)
        assert np.array_equal(one.cut, two.cut) and np.array_equal(one.cut, three.cut)
    assert (together[2].feature == -1).all() and (together[1].feature[:, 0] >= 0).all()


def test_forest_predicts(donors):
    """Leaves tell the target apart: most of its variance lies between them."""
    (grown,) = forest.grow(donors, [forest.Problem("y", ("a", "b", "c"), 4)], "id", None, trees=10, depth=5, least=5)
    rows = donors.where("y is not null").toPandas()
    at = grown.leaves(grown.bins(rows), 0)
    predicted = np.mean([rows.groupby(grown.leaves(grown.bins(rows), t)).y.transform("mean") for t in range(10)], axis=0)
    assert len(np.unique(at)) > 4 and ((rows.y - predicted) ** 2).mean() < 0.4 * rows.y.var()


def test_no_donors_no_predictors_one_value(spark, donors):
    asked = spark.createDataFrame([(1, 2.0, None)], "id long, a double, b double")
    for given in (donors.limit(0), donors.where("w = 0")):
        sampler = impute.ForestSampler(["a"], "y", "id", "w", trees=2, depth=2).fit(given)
        assert [tuple(r) for r in sampler.draw(asked, "id").collect()] == [(1, None)]
    flat = donors.withColumn("a", F.lit(1.0)).withColumn("b", F.lit(None).cast("double"))
    sampler = impute.ForestSampler(["a", "b"], "y", "id", trees=2, depth=2).fit(flat)
    assert (sampler.forest.feature == -1).all() and sampler.draw(asked, "id").first().donor_id is not None


def test_quantiles_are_within_their_error_of_brute_force(spark, donors):
    given = donors.select("id", "a", "c", "y", "w")
    asked = spark.range(60).select("id", (F.col("id") % 50).cast("double").alias("a"), (F.col("id") % 3).cast("double").alias("c"))
    quantiles = {"low": 0.1, "mid": 0.5, "high": 0.93, "least": 0.0, "most": 1.0}
    got = {r.id: r for r in impute.forest_quantiles(impute.Donors(given, "id", "w"), asked, "id", "y", ["a", "c"], quantiles, trees=5, depth=3, least=5, seed=11).collect()}
    rows = given.where("y is not null").toPandas()
    renamed = given.where("y is not null").withColumnsRenamed({"a": "_x_a", "c": "_x_c", "y": "_y"})
    (grown,) = forest.grow(renamed, [forest.Problem("_y", ("_x_a", "_x_c"), 11)], "id", "w", trees=5, depth=3, least=5)
    at = [grown.leaves(grown.bins(rows.rename(columns={"a": "_x_a", "c": "_x_c"})), t) for t in range(5)]
    asks = asked.toPandas().rename(columns={"a": "_x_a", "c": "_x_c"})
    for k, ask in asks.iterrows():
        share = np.zeros(len(rows))
        for t in range(5):
            own = at[t] == grown.leaves(grown.bins(asks.iloc[[k]]), t)[0]
            share += np.where(own, rows.w, 0) / rows.w[own].sum() / 5
        for name, q in quantiles.items():
            v = got[ask.id][name]
            below, upto = share[(rows.y < v).to_numpy()].sum(), share[(rows.y <= v).to_numpy()].sum()
            assert below - 1 / impute.SKETCH <= q <= upto + 1 / impute.SKETCH


def test_sketches(spark):
    leaves = [(0, 0, k, float(k // 10), 1.0) for k in range(640)] + [(0, 1, 7, 3.5, 2.0), (1, 0, 1, 1.0, 3.0), (1, 0, 2, 2.0, 1.0), (1, 0, 3, None, 5.0), (1, 0, 4, 9.0, 0.0)]
    got = {(r["_tree"], r["_leaf"]): r["values"] for r in impute.leaf_sketches(spark.createDataFrame(leaves, "_tree int, _leaf int, _donor long, _y double, _w double")).collect()}
    assert got == {(0, 0): [float(k) for k in range(64)], (0, 1): [3.5] * 64, (1, 0): [1.0] * 48 + [2.0] * 16}


def test_quantiles_without_donors(spark, donors):
    asked = spark.createDataFrame([(1, 2.0)], "id long, a double")
    assert [tuple(r) for r in impute.forest_quantiles(impute.Donors(donors.limit(0), "id", "w"), asked, "id", "y", ["a"], {"q": 0.5}, trees=2, depth=2).collect()] == [(1, None)]


def test_donors_are_not_written_for_each_tree(spark, monkeypatch):
    rows = []

    def counted(df):
        out = storage.written(df)
        rows.append(out.count())
        return out

    for module in (impute, ranges):
        monkeypatch.setattr(module, "written", counted)
    given = spark.createDataFrame([(i, float(i % 7), float(i % 5), 1.0 + i % 3) for i in range(400)], "d long, a double, pay double, w double")
    asked = spark.createDataFrame([(i, float(i % 7)) for i in range(50)], "k long, a double")
    got = impute.forest_draws(impute.Donors(given, "d", "w"), asked, "k", ["pay"], ["a"], trees=16, depth=2, least=2).collect()
    assert len(got) == 50 and {r.pay for r in got} <= {float(i) for i in range(5)}
    # leaves were written with a row for each donor and tree before
    assert max(rows) <= 400


def test_drawn_donor_is_the_one_at_its_place_in_the_leaf(spark):
    weights = {i: 0.25 + (i * i) % 11 for i in range(300)}
    given = spark.createDataFrame([(i, 1.0, float(i), w) for i, w in weights.items()], "id long, a double, y double, w double")
    asked = spark.createDataFrame([(i, 1.0) for i in range(500)], "k long, a double")
    sampler = impute.ForestSampler(["a"], "y", "id", "w", trees=3, depth=2).fit(given)
    got = {r.k: r.donor_id for r in sampler.draw(asked, "k").collect()}
    # one leaf: all donors in the order of their hashes, from 0 up
    line = [r.id for r in given.orderBy(F.expr("shiftrightunsigned(xxhash64(cast(id as string)), 1)")).collect()]
    ends = np.cumsum([weights[i] for i in line])
    at = {r.k: r.u for r in asked.select("k", uniform(f"{sampler.seed}:donor", "k").alias("u")).collect()}
    wanted = {k: line[int(np.searchsorted(ends, u * ends[-1], "right"))] for k, u in at.items()}
    assert got == wanted
