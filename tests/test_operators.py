import numpy as np
import pytest
from pyspark.sql import functions as F

from popforge.functions import scalars as S
from popforge.functions.rng import uniform
from popforge.operators import calibrate, entities, gates, geography, impute, lineage, normalize, spine, takeup
from popforge.operators.ranges import RANGE, in_ranges
from popforge.plans import spec as specs
from popforge.sources import registry


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_uniform_depends_on_keys_only(spark):
    df = spark.range(2000)
    one = rows(df.select("id", uniform(7, "id").alias("u")))
    two = rows(df.repartition(7).select("id", uniform(7, "id").alias("u")))
    assert one == two
    values = np.array([u for _, u in one])
    assert 0 <= values.min() and values.max() < 1 and abs(values.mean() - 0.5) < 0.03
    assert rows(df.select("id", uniform(8, "id").alias("u"))) != one


def test_numbered_is_consecutive_and_stable(spark):
    df = spark.range(500).select((F.col("id") * 7919 % 1000).alias("k"))
    a = {(r.k, r.n) for r in registry.numbered(df, ["k"], "n").collect()}
    b = {(r.k, r.n) for r in registry.numbered(df.repartition(9), ["k"], "n").collect()}
    assert a == b and [n for _, n in sorted(a)] == list(range(1, 501))


def test_scalars_handle_nulls(spark):
    df = spark.createDataFrame([(None, None), (2.7, "x"), (-2.7, "y")], "v double, s string")
    got = [tuple(r) for r in df.select(S.truncated_int("v"), S.to_boolean("v"), S.indicator("s", "x"), S.recode("s", {"x": 1}, 9), S.horizontal_sum(["v", F.lit(1)])).collect()]
    assert got == [(None, False, False, 9, 1.0), (2, True, True, 1, 3.7), (-3, True, False, 9, pytest.approx(-1.7))]
    assert S.matching_columns(spark.createDataFrame([(1, 2, 3)], "TXAMT1 int, b int, aTXAMT int"), "TXAMT") == ["TXAMT1", "aTXAMT"]
    with pytest.raises(ValueError):
        S.first_existing(df, ["nope"])


def test_delimited_loader(spark, tmp_path):
    (tmp_path / "raw.csv").write_text("SSUID|PNUM|MONTHCODE|X\na|1|12|9\na|1|11|9\nb|2|12|\n")
    df = registry.read_delimited(spark, str(tmp_path / "raw.csv"), "SSUID string, PNUM int, MONTHCODE int, X double", "|", ["SSUID", "PNUM", "MONTHCODE"])
    block = normalize.Block(keys={"person_id": ("SSUID", "PNUM"), "household_id": ("SSUID",)}, period=("MONTHCODE", 12))
    assert rows(normalize.normalize(df, block)) == [("a-1", "a"), ("b-2", "b")]
    assert df.columns == ["SSUID", "PNUM", "MONTHCODE"]
    [(_, digest, size)] = rows(registry.file_fingerprints(spark, str(tmp_path / "raw.csv")))
    assert size == 49 and len(digest) == 64


def test_household_rows_keeps_unmatched_persons(spark):
    persons = spark.createDataFrame([(1, 10), (2, 99), (3, None)], "p long, h long")
    homes = spark.createDataFrame([(10, "RENTED"), (11, "x")], "id long, tenure string")
    got = registry.household_rows(persons, homes, "h", "id", {"tenure": "tenure"})
    assert {(r.p, r.tenure) for r in got.collect()} == {(1, "RENTED"), (2, None), (3, None)}


def test_registry_wants_one_spine():
    with pytest.raises(ValueError):
        registry.Registry.of("/x", {"a": ("t", "donor")})
    with pytest.raises(ValueError):
        registry.Source("a", "t", "other")


def test_observation_fans_out_and_refuses_repeats(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0)], "k long, w double, raw double")
    assert rows(registry.Observation("tax_unit", "k", "w", (("raw", "a"), ("raw", "b"))).apply(df)) == [(1, 2.0, 3.0, 3.0)]
    with pytest.raises(ValueError):
        registry.Observation("tax_unit", "k", "w", (("raw", "a"), ("raw", "a"))).apply(df)


def test_clone_spine_keeps_totals_links_and_strips(spark):
    df = spark.createDataFrame([(1, 1, 30, 5.0, 100.0), (2, 1, 4, 5.0, 0.0)], "person_id long, household_id long, age int, w double, income double")
    both = spine.clone_spine(df, ["age"], {"person_id": 100, "household_id": 100}, "w")
    assert both.agg(F.sum("w")).first()[0] == df.agg(F.sum("w")).first()[0]
    assert both.select("person_id").distinct().count() == 4
    clone = both.where("is_clone")
    assert clone.where("income is not null").count() == 0 and set(r.household_id for r in clone.collect()) == {101}
    assert rows(spine.collisions(both, ["income"])) == [("income", 0)]


def test_override_and_fill(spark):
    base = spark.createDataFrame([(1, "keep", 5.0), (2, "keep", None), (3, "synthetic", None)], "k long, half string, v double")
    draws = spark.createDataFrame([(1, 9.0), (2, 9.0), (3, 9.0)], "k long, v double")
    step = lambda synth: impute.Step("keep", ("v",), synth)
    assert rows(impute.apply_step(base, draws, "k", step(False)).select("k", F.coalesce("v", F.lit(-1.0)))) == [(1, 5.0), (2, 9.0), (3, -1.0)]
    assert rows(impute.apply_step(base, draws, "k", step(True)).select("k", F.coalesce("v", F.lit(-1.0)))) == [(1, 9.0), (2, 9.0), (3, -1.0)]
    assert impute.spine_first(["a", "b", "c"], ["c"]) == ["c", "a", "b"]


def test_nearest_donor_by_brute_force(spark):
    rng = np.random.default_rng(1)
    asked = [(i, int(rng.integers(0, 3)), float(rng.integers(0, 20))) for i in range(200)]
    given = [(i, int(rng.integers(0, 2)), float(rng.integers(0, 20))) for i in range(30)]
    got = impute.nearest_donor(spark.createDataFrame(asked, "k long, c int, v double"), spark.createDataFrame(given, "d long, c int, x double"), "k", "d", "c", "v", "x")
    want = {k: min(((abs(v - x), d) for d, cc, x in given if cc == c), default=(0, None))[1] for k, c, v in asked}
    assert {r.k: r.d for r in got.collect()} == want


def test_nearest_donor_with_nulls_by_brute_force(spark):
    rng = np.random.default_rng(2)
    some = lambda x, k: None if k % 5 == 0 else x
    asked = [(i, some(int(rng.integers(0, 3)), i // 7), some(float(rng.choice([0.0, 0.0, 0.0, 5.0, 30.0, -4.0])), i)) for i in range(300)]
    given = [(some(i, i + 1), some(int(rng.integers(0, 2)), i // 3), some(float(rng.choice([0.0, 6.0, -3.0, 30.0])), i)) for i in range(2, 60)]
    given += [(5, 2, None), (4, 2, None), (7, 4, None), (6, 4, 30.0)]
    asked += [(900, 2, 1.0), (901, 2, None), (902, 4, 5.0), (903, 4, None)]
    got = impute.nearest_donor(spark.createDataFrame(asked, "k long, c int, v double"), spark.createDataFrame(given, "d long, c int, x double"), "k", "d", "c", "v", "x")
    far = lambda v, x: (1, 0.0) if v is None or x is None else (0, abs(v - x))
    want = {k: min(((*far(v, x), d) for d, cc, x in given if cc is not None and cc == c and d is not None), default=(0, 0, None))[2] for k, c, v in asked}
    assert {r.k: r.d for r in got.collect()} == want


def test_nearest_donor_splits_one_value_over_ranges(spark):
    """Most recipients have the value 0; no range has most of them."""
    asked = spark.range(20_000).select(F.col("id").alias("k"), F.lit(1).alias("c"), F.when(F.col("id") % 5 > 0, F.lit(0.0)).otherwise(F.col("id").cast("double")).alias("v"))
    given = spark.range(50).select(F.col("id").alias("d"), F.lit(1).alias("c"), (F.col("id") * 10.0).alias("x"))
    line = in_ranges(asked.select("c", F.col("v").alias("at"), "k"), ["c", "at", "k"])
    sizes = sorted(r["count"] for r in line.groupBy(RANGE).count().collect())
    assert sizes[-1] < 3 * sizes[len(sizes) // 2]
    assert impute.nearest_donor(asked, given, "k", "d", "c", "v", "x").where("d is null").count() == 0


def test_allocate_adds_up(spark):
    df = spark.createDataFrame([(1, 1, 10.0, 1.0), (1, 2, 10.0, 3.0), (2, 3, 8.0, 0.0), (2, 4, 8.0, 0.0)], "g long, k long, amount double, w double")
    got = {r.k: r.share for r in entities.allocate(df, "g", "amount", "w", ["k"], "share").collect()}
    assert got == {1: 2.5, 2: 7.5, 3: 4.0, 4: 4.0}
    head = {r.k: r.share for r in entities.allocate(df, "g", "amount", "w", ["k"], "share", "head").collect()}
    assert head == {1: 10.0, 2: 0.0, 3: 8.0, 4: 0.0}


def test_geography_covers_and_keeps_to_areas(spark):
    units = spark.createDataFrame([("01", "a", 3), ("01", "b", 1), ("02", "c", 5), ("02", "d", 0)], "area string, unit string, n long")
    homes = spark.range(4000).select("id", F.when(F.col("id") % 3 == 0, "01").when(F.col("id") % 3 == 1, "02").otherwise("03").alias("area"))
    got = geography.assign(homes, "id", "area", geography.intervals(units, "area", "unit", "n"), "unit", 5)
    counts = {(r.area, r.unit): r["count"] for r in got.groupBy("area", "unit").count().collect()}
    assert set(counts) == {("01", "a"), ("01", "b"), ("02", "c"), ("03", None)}
    assert abs(counts["01", "a"] / (counts["01", "a"] + counts["01", "b"]) - 0.75) < 0.05


def test_takeup_rates(spark):
    df = takeup.rerandomize(spark.range(5000), "id", {"a": 0.3, "b": 1.0, "c": 0.0}, 1)
    got = df.agg(*[F.avg(F.col(c).cast("int")) for c in "abc"]).first()
    assert abs(got[0] - 0.3) < 0.03 and got[1] == 1.0 and got[2] == 0.0


def test_contract_gate(spark):
    contract = gates.Contract(frozenset("ab"), frozenset("c"), frozenset("d"), frozenset("e"))
    assert gates.check(["a", "b", "c", "e", "z"], contract) == gates.Verdict((), (), ("e",), ("z",))
    verdict = gates.check(["a", "d"], contract)
    assert not verdict.passed and verdict.missing == ("b",) and verdict.forbidden == ("d",)
    df = spark.createDataFrame([(1, 2, 3)], "b int, d int, a int")
    assert gates.export_projection(df, contract).columns == ["a", "b"]
    with pytest.raises(ValueError):
        gates.export_projection(df.drop("a"), contract)
    with pytest.raises(ValueError):
        gates.Contract(frozenset("a"), forbidden=frozenset("a"))


def test_simplex_projection(spark):
    rng = np.random.default_rng(3)
    w = rng.normal(1, 2, 200)
    got = calibrate.simplex_projection(spark.createDataFrame([(i, float(x)) for i, x in enumerate(w)], "unit long, w double"), 50.0)
    u = np.sort(w)[::-1]
    k = np.flatnonzero(u - (np.cumsum(u) - 50) / np.arange(1, 201) > 0)[-1]
    want = np.maximum(w - (u[: k + 1].sum() - 50) / (k + 1), 0)
    assert np.allclose([r.w for r in got.orderBy("unit").collect()], want, atol=1e-6)


def calibration(spark):
    units = spark.range(60).select("id", (F.col("id") % 4).alias("a"), (F.col("id") % 3).alias("b"))
    matrix = calibrate.loss_matrix(units, "id", {"a": (F.col("a"), F.lit(1.0)), "b": (F.col("b"), F.lit(1.0))})
    weights = units.select(F.col("id").alias("unit"), F.lit(1.0).alias("w"))
    truth = weights.withColumn("w", F.when(F.col("unit") % 4 == 0, 2.0).otherwise(F.lit(2.0 / 3)))
    targets = calibrate.estimates(matrix, truth).select("target_id", F.substring("target_id", 1, 1).alias("bucket"), F.col("estimate").alias("value"))
    return matrix, weights, targets


@pytest.mark.parametrize("projection", ["rescale", "simplex"])
def test_calibration_never_rises_and_keeps_the_total(spark, projection):
    matrix, weights, targets = calibration(spark)
    found, losses = calibrate.calibrate(matrix, weights, targets, calibrate.Settings(max_iter=6, power_rounds=3, projection=projection))
    assert all(b <= a for a, b in zip(losses, losses[1:])) and losses[-1] < losses[0] / 2
    total, low = found.agg(F.sum("w"), F.min("w")).first()
    assert total == pytest.approx(60, abs=1e-5) and low >= 0


def test_calibration_refuses_what_it_lacks():
    for bad in ({"use_gates": True}, {"lambda_l0": 0.1}, {"projection": "other"}):
        with pytest.raises(ValueError):
            calibrate.Settings(**bad)


SPEC = """
meta: {country: zz, model_year: 2024}
sources: {survey: {dataset: orders, role: spine}, tax: {dataset: supplier, role: donor}}
spine: {base: survey, seed: 5, halves: [{name: keep, keep: all}, {name: synthetic, keep: demographics}]}
imputation: [{onto: synthetic, from: tax, vars: [wages], condition_on: [demographics], synthesize: true}]
variables:
  age: {entity: person, role: structural, operation: {kind: structural_export}}
  has_cover: {entity: person, operation: {kind: passthrough, source: survey, source_column: covered}, temporary: true,
              provenance: {now: [{path: a.py, lines: 1-2, symbol: f, summary: s}]}}
  wages: {entity: person, operation: {kind: impute, source: tax}}
  state: {entity: household, operation: {kind: encode_geoid, column: st, encoding: S2}}
  in_town: {entity: household, operation: {kind: derive, transform: town}}
  snap: {entity: spm_unit, operation: {kind: rerandomize_takeup, handler: seeded}}
  rent: {entity: household, operation: {kind: open_decision}}
targets: {profile: p}
calibrate: {loss: huber, method: apg}
"""


def test_spec_loads_covers_and_builds_columns(spark):
    spec = specs.load(SPEC)
    assert specs.coverage(spec, frozenset({"age", "missing"})) == ({"missing"}, set())
    assert specs.lint(spec) == {"temporary": 1, "open_decision": 1}
    assert rows(specs.lineage(spark, spec)) == [("has_cover", "now", "a.py", "1-2", "f", "s")]
    df = spark.createDataFrame([(1, 30, True, 7)], "id long, age int, covered boolean, st int")
    handlers = {"town": lambda p, seed: F.col("st") == 7}
    make = lambda n: specs.column_of(spec.variables[n], spec, handlers, {"snap": 1.0}, "id")
    assert rows(df.select(*[make(n) for n in ("age", "has_cover", "state", "in_town", "snap")])) == [(30, True, "07", True, True)]
    for unresolved in ("rent", "wages"):
        with pytest.raises(specs.SpecError):
            make(unresolved)


@pytest.mark.parametrize("old, new", [("base: survey", "base: tax"), ("onto: synthetic", "onto: x"), ("kind: derive", "kind: guess"), ("vars: [wages]", "vars: [nope]"), ("meta:", "mta:"), ("entity: spm_unit", "entity: castle")])
def test_bad_specs_are_refused(old, new):
    with pytest.raises(specs.SpecError):
        specs.load(SPEC.replace(old, new))


def test_allocate_exactly_adds_up_by_brute_force(spark):
    rng = np.random.default_rng(4)
    amounts = {0: 100, 1: -7, 2: 0, 3: 10**17 + 1, 4: 5, 5: None, None: 9}
    given = [(k, g, amounts[g], w) for k, g, w in ((k, [0, 1, 2, 3, 4, 5, None][k % 7], None if k % 11 == 0 else int(rng.integers(-2, 9))) for k in range(200))]
    given = [(k, g, a, 0 if g == 4 else w) for k, g, a, w in given]
    got = {r.k: r.cents for r in entities.allocate_exact(spark.createDataFrame(given, "k long, g int, a long, w long"), "g", "a", "w", "k", "cents").collect()}
    want = {k: None for k, *_ in given}
    for g, a in amounts.items():
        if g is None or a is None:
            continue
        own = {k: max(w or 0, 0) for k, gg, _, w in given if gg == g}
        own = own if sum(own.values()) else dict.fromkeys(own, 1)
        down = {k: divmod(abs(a) * w, sum(own.values())) for k, w in own.items()}
        more = sorted(down, key=lambda k: (-down[k][1], k))[: abs(a) - sum(q for q, _ in down.values())]
        want |= {k: (1 if a > 0 else -1 if a < 0 else 0) * (q + (k in more)) for k, (q, _) in down.items()}
        assert sum(want[k] for k in own) == a
    assert got == want


def test_lineage_closure(spark):
    edges = spark.createDataFrame([("c", "b"), ("b", "a"), ("c", "b"), ("d", "a"), ("d", "c"), (None, "a"), ("a", None)], "node string, needs string")
    assert rows(lineage.closure(edges)) == [("b", "a", 1), ("c", "a", 2), ("c", "b", 1), ("d", "a", 1), ("d", "b", 2), ("d", "c", 1)]
    assert rows(lineage.closure(edges.limit(0))) == []
    for more, looped in ([("a", "a")], "'a'"), ([("a", "d")], "'a', 'd'"):
        with pytest.raises(lineage.CycleError, match=looped):
            lineage.closure(edges.union(spark.createDataFrame(more, edges.schema)))


def test_lineage_of_a_spec(spark):
    from popforge.plans import declared

    made_from = {}
    for r in lineage.closure(specs.edges(spark, declared.load())).collect():
        made_from.setdefault(r.node, {})[r.origin] = r.steps
    assert made_from["variable:in_nyc"] == {"variable:county_fips": 1, "source:geography": 2, "code:content/declared.yaml": 1}
    assert made_from["variable:owes_tax"]["dataset:supplier"] == 3 and made_from["variable:owes_tax"]["dataset:orders"] == 3
    assert made_from["variable:tip_income"]["dataset:lineitem"] == 2
