"""Plans that must hold where one group has most rows, and the imputation run."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from popforge.operators import calibrate, entities, geography, impute, ranges


def test_persons_without_a_household_stay(spark):
    df = spark.createDataFrame([(1, 7, 3), (2, 7, 30), (3, None, 4), (4, None, 50), (5, None, None)], "p long, h long, age int")
    got = {r.p: (r.size, r.young) for r in entities.household_counts(df, "h", "age", {"young": 18}, "size").collect()}
    assert got == {1: (2, 1), 2: (2, 1), 3: (3, 1), 4: (3, 1), 5: (3, 1)}


def test_running_sums_across_ranges(spark):
    rng = np.random.default_rng(2)
    given = [(int(rng.integers(0, 3)) or None, i, int(rng.integers(0, 9))) for i in range(3000)]
    got = ranges.running_sums(spark.createDataFrame(given, "g long, k long, n long"), ["g"], ["k"], "n", "upto", "total").collect()
    total, so_far = {}, {}
    for g, k, n in given:
        total[g] = total.get(g, 0) + n
        so_far[k] = total[g]
    assert len(got) == 3000 and all(r.upto == so_far[r.k] and r.total == total[r.g] for r in got)


def test_draws_find_the_one_interval(spark):
    units = spark.createDataFrame([(a, u, n) for a in range(3) for u, n in enumerate([5, 0, 1, 20, 3][: a + 3])], "area long, unit long, n long")
    shares = geography.intervals(units, "area", "unit", "n")
    asked = spark.range(3000).select("id", (F.col("id") % 4).alias("area"), (F.col("id") / 3000).alias("u"))
    got = {(r.id, r.area, r.u): r.unit for r in ranges.draw(asked, "u", ["area"], shares, "unit").collect()}
    lines = {}
    for r in shares.collect():
        lines.setdefault(r.area, []).append((r.low, r.high, r.unit))
    assert len(got) == 3000
    for (_, area, u), unit in got.items():
        assert [unit] == [x for low, high, x in lines.get(area, []) if low <= u < high] or area == 3 and unit is None


def test_one_large_cell(spark):
    n = 200_000
    asked = spark.range(n).select("id", F.lit(1).alias("c"), (F.rand(1) * 1000).alias("v"))
    given = spark.range(5000).select("id", F.lit(1).alias("c"), (F.rand(2) * 1000).alias("x"))
    asked, given = asked.toPandas(), given.toPandas()
    began = time.time()
    got = impute.nearest_donor(spark.createDataFrame(asked).withColumnRenamed("id", "k"), spark.createDataFrame(given).withColumnRenamed("id", "d"), "k", "d", "c", "v", "x")
    found = got.toPandas().set_index("k")["d"]
    assert time.time() - began < 60
    order = np.argsort(given["x"].to_numpy())
    x, ids = given["x"].to_numpy()[order], given["id"].to_numpy()[order]
    v = asked["v"].to_numpy()
    at = np.clip(np.searchsorted(x, v), 1, len(x) - 1)
    want = np.where(v - x[at - 1] <= x[at] - v, ids[at - 1], ids[at])
    assert (found.loc[asked["id"]].to_numpy() == want).all()


def test_weighted_quantile_of_one_group(spark):
    rng = np.random.default_rng(5)
    rows = [("a" if i % 50 else "b", i, float(rng.integers(0, 100)), float(rng.integers(1, 5))) for i in range(4000)]
    got = {r.g: r.q for r in impute.weighted_quantile(spark.createDataFrame(rows, "g string, k long, v double, w double"), "g", "v", "w", 0.3, "k", "q").collect()}
    for g in "ab":
        own = sorted((v, k, w) for x, k, v, w in rows if x == g)
        upto = np.cumsum([w for *_, w in own])
        assert got[g] == own[int(np.argmax(upto >= 0.3 * upto[-1]))][0]


@pytest.mark.parametrize("total", [0.5, 40.0, 900.0])
def test_simplex_projection_with_ties(spark, total):
    w = [0.0] * 50 + [1.0] * 50 + [3.5, 3.5, 100.0]
    got = calibrate.simplex_projection(spark.createDataFrame(list(enumerate(w)), "unit long, w double"), total)
    found = np.array([r.w for r in got.orderBy("unit").collect()])
    u = np.sort(w)[::-1]
    k = np.flatnonzero(u - (np.cumsum(u) - total) / np.arange(1, len(u) + 1) > 0)[-1]
    assert np.allclose(found, np.maximum(np.array(w) - (u[: k + 1].sum() - total) / (k + 1), 0), atol=1e-9)


def test_matched_sample_is_exact(spark):
    df = spark.range(20_000)
    few = sorted(r.id for r in calibrate.matched_sample(df, "id", 100, 3).collect())
    from popforge.functions.rng import uniform

    want = sorted(r.id for r in df.withColumn("u", uniform(3, "id")).orderBy("u", "id").limit(100).collect())
    assert few == want and calibrate.matched_sample(spark.range(7), "id", 100, 3).count() == 7


def test_districts_come_from_the_crosswalk(spark):
    homes = spark.createDataFrame([(1, "12"), (2, "13"), (3, None)], "id long, block string")
    crosswalk = spark.createDataFrame([("000000000000012", 7), ("12", 5), ("99", 1)], "block_geoid string, district int")
    got = {r.id: r.congressional_district_geoid for r in geography.with_district(homes, "block", crosswalk).collect()}
    assert got == {1: "0005", 2: None, 3: None}


def test_targets_are_selected(spark):
    rows = [("a", "us", 2024, "p", "national", None), ("b", "us", 2024, "p", "state", "01"), ("c", "us", 2024, "p", "state", "02"), ("d", "us", 2023, "p", "state", "01"), ("e", "us", 2024, "q", "state", "01")]
    df = spark.createDataFrame(rows, "target_id string, country string, model_year int, profile string, geo_level string, state_fips string")
    pick = lambda *a: sorted(r.target_id for r in calibrate.select_targets(df, "us", 2024, "p", *a).collect())
    assert (pick(), pick("national"), pick("state"), pick("state", "02")) == (["a", "b", "c"], ["a"], ["b", "c"], ["c"])
    with pytest.raises(ValueError):
        pick("county")
    for name in ("exact_rescore", "skip_tax_expenditure_targets"):
        with pytest.raises(ValueError):
            calibrate.Settings(**{name: True})


def donors(spark):
    rows = [(i, i % 4, float(i % 4 * 1000 + i % 7), i % 4 > 1, float(1 + i % 3)) for i in range(200)]
    return impute.Donors(spark.createDataFrame(rows, "d long, cell int, pay double, flag boolean, w double"), "d", "w")


def test_forest_draws_go_together_and_are_donors_own(spark):
    asked = spark.range(600).select(F.col("id").alias("k"), (F.col("id") % 4).cast("int").alias("cell"))
    got = impute.forest_draws(donors(spark), asked, "k", ["pay", "flag"], ["cell"], trees=8, depth=4, least=2).join(asked, "k").collect()
    known = {r.pay for r in donors(spark).rows.collect()}
    assert len(got) == 600 and dict(donors(spark).rows.dtypes)["flag"] == "boolean"
    assert all(r.pay in known for r in got)
    # the second draw follows the predictors and the first
    assert np.mean([abs(r.pay - r.cell * 1000) < 10 for r in got]) > 0.95 and np.mean([r.flag == (r.cell > 1) for r in got]) > 0.95


def test_forest_steps_fill_override_and_leave_the_other_half(spark):
    spine = spark.createDataFrame([(k, k % 4, "keep" if k % 2 else "synthetic", -1.0 if k % 3 else None) for k in range(40)], "k long, cell int, half string, pay double")
    steps = [impute.Step("synthetic", ("pay", "flag"), True, ("people",)), impute.Step("keep", ("pay", "flag"), False, ("people",))]
    got = impute.forest_steps(spine, steps, donors(spark), "k", {"people": ["cell"]}, trees=4, depth=3, least=2).collect()
    for r in got:
        assert r.flag is not None
        assert r.pay == -1.0 if r.half == "keep" and r.k % 3 else r.pay >= 0
    with pytest.raises(ValueError):
        impute.Step("keep", ("pay",), True, (), "any")


def test_weeks_follow_compensation(spark):
    given = impute.Donors(spark.createDataFrame([(i, float(i % 2 * 100), float(i % 2 * 60 - 5)) for i in range(80)], "d long, pay double, weeks double"), "d")
    asked = spark.createDataFrame([(1, 0.0), (2, 100.0), (3, None)], "k long, pay double")
    got = {r.k: r.weeks for r in impute.draw_weeks_unemployed(given, asked, "k", "weeks", "pay", trees=4, depth=2, least=2).collect()}
    assert got == {1: 0.0, 2: 52.0, 3: 0.0}


def test_an_iteration_moves_target_sums_only(spark):
    """No row is dealt by unit again once matrix and weights lie in buckets of units."""
    from popforge.sources.storage import bucketed, discard

    units = spark.range(3000).select("id", (F.col("id") % 40).alias("a"), (F.col("id") % 7).alias("b"))
    made = calibrate.loss_matrix(units, "id", {"a": (F.col("a"), F.lit(1.0)), "b": (F.col("b"), F.col("id").cast("double"))})
    matrix = bucketed(made, "unit", 6, deal=True)
    weights = bucketed(units.select(F.col("id").alias("unit"), F.lit(1.0).alias("w")), "unit", 6, deal=True)
    targets = calibrate.estimates(made, units.select(F.col("id").alias("unit"), F.lit(2.0).alias("w"))).select("target_id", F.substring("target_id", 1, 1).alias("bucket"), F.col("estimate").alias("value"))
    targets = targets.cache()
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        moved = calibrate.step(weights, calibrate.gradient(matrix, weights, targets, 1.0, few=True), 0.1)
        plan = moved._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning(target_id" in plan and "Exchange hashpartitioning(unit" not in plan, plan
        again = bucketed(moved, "unit", 6)
        ahead = again.join(weights.withColumnRenamed("w", "old"), "unit")
        assert "Exchange hashpartitioning" not in ahead._jdf.queryExecution().executedPlan().toString()
        assert again.count() == 3000 and {r.unit: r.w for r in again.collect()} == {r.unit: r.w for r in moved.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    name = matrix._table
    discard(matrix, weights, again)
    assert not spark.catalog.tableExists(name)


def test_losses_by_brute_force(spark):
    """The series of losses is that of the same method on dense arrays."""
    rng = np.random.default_rng(3)
    n, m = 60, 5
    dense = rng.random((m, n)) * (rng.random((m, n)) < 0.5)
    start, value = rng.random(n) + 0.5, None
    value = dense @ (start * rng.uniform(0.7, 1.4, n))
    bucket = np.array([0, 0, 1, 1, 1])
    entries = [(f"t{i}", j, float(dense[i, j])) for i in range(m) for j in range(n) if dense[i, j]]
    matrix = spark.createDataFrame(entries, "target_id string, unit long, coef double")
    weights = spark.createDataFrame([(j, float(w)) for j, w in enumerate(start)], "unit long, w double")
    targets = spark.createDataFrame([(f"t{i}", str(bucket[i]), float(value[i])) for i in range(m)], "target_id string, bucket string, value double")
    found, losses = calibrate.calibrate(matrix, weights, targets, calibrate.Settings(max_iter=5, power_rounds=3))

    size_of = np.array([(bucket == b).sum() for b in bucket])
    huber = lambda r: np.where(np.abs(r) <= 1, 0.5 * r * r, np.abs(r) - 0.5)
    loss = lambda w: float((huber((dense @ w - value) / np.abs(value)) / size_of).sum())
    slope = lambda w: dense.T @ (np.clip((dense @ w - value) / np.abs(value), -1, 1) / (np.abs(value) * size_of))
    vector, bound = np.ones(n), 0.0
    for _ in range(3):
        image = dense.T @ ((dense @ vector) / (value * value * size_of))
        bound, vector = np.linalg.norm(image) / np.linalg.norm(vector), image / np.linalg.norm(image)
    now, ahead, momentum, want, size = start, start, 1.0, [loss(start)], 1 / bound
    for _ in range(5):
        new = np.maximum(ahead - size * slope(ahead), 0)
        new = new * start.sum() / new.sum()
        if loss(new) > want[-1]:
            size = size / 2 if momentum == 1.0 else size
            ahead, momentum = now, 1.0
            continue
        following = (1 + (1 + 4 * momentum**2) ** 0.5) / 2
        ahead = np.maximum(new + (momentum - 1) / following * (new - now), 0)
        now, momentum = new, following
        want.append(loss(new))
    assert np.allclose(losses, want, rtol=1e-9)
    got = {r.unit: r.w for r in found.collect()}
    assert np.allclose([got[j] for j in range(n)], now, rtol=1e-9)


def test_donors_that_share_a_key_are_donors_of_their_own(spark):
    given = spark.createDataFrame([(k % 3, k % 4, float(k % 10), 1.0) for k in range(80)] + [(1, 0, 0.0, 1.0)] * 5, "d long, cell int, pay double, w double")
    asked = spark.range(300).select(F.col("id").alias("k"), (F.col("id") % 4).cast("int").alias("cell"))
    got = impute.forest_draws(impute.Donors(given, "d", "w"), asked, "k", ["pay"], ["cell"], trees=4, depth=3, least=2).collect()
    assert sorted(r.k for r in got) == list(range(300)) and {r.pay for r in got} == {float(k) for k in range(10)}
