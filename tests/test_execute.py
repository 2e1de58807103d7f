"""Execution of declared specifications: levels, refusals by name, geography by the lowest known level."""

import os

import pytest
from pyspark.sql import functions as F

from popforge.operators import geography, impute
from popforge.plans import declared, execute
from popforge.plans import spec as specs
from popforge.sources.census import CensusSource, GeographyError

DATA = "/root/testdata/sf0.001"

SPEC = """
meta: {country: zz, model_year: 2024}
sources: {survey: {dataset: s, role: spine}, tax: {dataset: t, role: donor}}
spine:
  base: survey
  support: {seed: 7}
  halves: [{name: keep, keep: all}, {name: synthetic, strip_to: [demographics]}]
imputation:
  - {onto: synthetic, from: tax, vars: [pay, zone_pay], condition_on: [demographics], synthesize: true}
variables:
"""


def declared_as(**operations):
    lines = [f"  {name}: {{entity: {entity}, operation: {operation}}}" for name, (entity, operation) in operations.items()]
    return specs.load(SPEC + "\n".join(["  pay: {entity: person, operation: {kind: impute, source: tax}}", "  zone_pay: {entity: person, operation: {kind: impute, source: tax}}", *lines]))


@pytest.fixture
def frames(spark):
    home = spark.createDataFrame([(1, "01001", "x"), (2, None, "y")], "household_id long, county string, zone string")
    person = spark.createDataFrame([(10, 1, 30, "keep"), (11, 1, 8, "synthetic"), (12, 2, 50, "synthetic")], "person_id long, household_id long, age long, half string")
    return {"household": home, "person": person}


KEYS = {"household": "household_id", "person": "person_id"}


def test_levels_follow_needs_and_columns_come_from_the_household(spark, frames):
    spec = declared_as(
        c=("person", "{kind: derive, transform: both, depends_on: [a, b]}"),
        a=("person", "{kind: derive, transform: same, depends_on: [zone]}"),
        b=("household", "{kind: derive, transform: same, depends_on: [zone]}"),
        old=("person", "{kind: passthrough, source: survey, source_column: age}"),
    )
    transforms = {"same": lambda args, seed: F.upper(args[0]), "both": lambda args, seed: F.concat(*args)}
    given = execute.Inputs(frames, KEYS, transforms=transforms)
    found = execute.plan(spec, given)
    assert found.levels == (("a", "b", "old"), ("c",)) and set(found.refused) == {"pay", "zone_pay"}
    out = execute.execute(spec, given, found)
    assert out["person"].columns == ["person_id", "c", "a", "old"]
    assert sorted(map(tuple, out["person"].collect())) == [(10, "XX", "X", 30), (11, "XX", "X", 8), (12, "YY", "Y", 50)]
    only = execute.plan(spec, given, ["c"])
    assert only.levels == (("a", "b"), ("c",))


def test_refusals_name_the_variable_and_the_reason(spark, frames):
    spec = declared_as(
        undecided=("person", "{kind: open_decision, notes: later}"),
        on_undecided=("person", "{kind: derive, transform: same, depends_on: [undecided]}"),
        twice=("person", "{kind: derive, transform: same, depends_on: [on_undecided]}"),
        on_nothing=("person", "{kind: derive, transform: same, depends_on: [nowhere]}"),
        untaught=("person", "{kind: derive, transform: unknown, depends_on: [age]}"),
        absent=("person", "{kind: passthrough, source: survey, source_column: gone}"),
        elsewhere=("person", "{kind: passthrough, source: tax, source_column: age}"),
        unframed=("tax_unit", "{kind: structural_export}"),
        unlisted=("person", "{kind: structural_export}"),
        block_geoid=("household", "{kind: encode_geoid, source: geography, encoding: S15}"),
        odd_code=("household", "{kind: encode_geoid, column: county, encoding: X5}"),
        takes_up=("person", "{kind: rerandomize_takeup, handler: h}"),
        scf=("person", "{kind: impute, source: scf}"),
        household_id=("household", "{kind: structural_export}"),
    )
    found = execute.plan(spec, execute.Inputs(frames, KEYS, transforms={"same": lambda args, seed: args[0]}))
    assert found.levels == (("household_id",),)
    reasons = {r.variable: r.reason for r in execute.refusals(spark, spec, found).collect()}
    assert set(reasons) == set(spec.variables) - {"household_id"}
    told = {"undecided": "later", "on_undecided": "'undecided', which is refused", "twice": "'on_undecided', which is refused", "on_nothing": "'nowhere'", "untaught": "'unknown'", "absent": "'gone'", "elsewhere": "'tax'", "unframed": "tax_unit", "unlisted": "'unlisted'", "block_geoid": "no geography", "odd_code": "'X5'", "takes_up": "rate", "scf": "'scf'", "pay": "'tax'"}
    assert all(part in reasons[name] for name, part in told.items())


def test_variables_that_need_each_other_are_an_error(frames):
    spec = declared_as(a=("person", "{kind: derive, transform: same, depends_on: [b]}"), b=("person", "{kind: derive, transform: same, depends_on: [a]}"))
    with pytest.raises(specs.SpecError, match=r"\['a', 'b'\]"):
        execute.plan(spec, execute.Inputs(frames, KEYS, transforms={"same": lambda args, seed: args[0]}))


def test_draws_go_to_their_half_and_come_from_donors(spark, frames):
    given = spark.createDataFrame([(k, 20 + k % 40, float(k), k % 2 == 0) for k in range(60)], "donor long, age long, pay double, zone_pay boolean")
    inputs = execute.Inputs(frames, KEYS, donors={"tax": impute.Donors(given, "donor")}, groups={"demographics": ["age"]}, forest={"trees": 4, "depth": 3, "least": 1})
    out = {r.person_id: r for r in execute.execute(declared_as(), inputs)["person"].collect()}
    assert out[10].pay is None and out[11].pay in range(60) and out[12].pay in range(60)
    assert execute.plan(declared_as(), execute.Inputs(frames, KEYS, donors={"tax": impute.Donors(given.drop("age"), "donor")}, groups={"demographics": ["age"]})).refused["pay"] == "source 'tax' lacks predictors ['age']"


def blocks(spark):
    rows = [("010010000000001", 3, "0101"), ("010010000000002", 1, "0102"), ("010030000000001", 2, "0101"), ("020010000000001", 4, "0201"), ("030010000000001", 0, "0301")]
    return CensusSource(spark.createDataFrame(rows, "block_geoid string, population long, district string"), district="district")


def test_lowest_known_level(spark):
    """Known counties are kept, then known states; what does not exist or has no units falls back."""
    homes = spark.range(3000).select("id", F.when(F.col("id") % 4 == 0, "01001").when(F.col("id") % 4 == 1, "01999").when(F.col("id") % 4 == 2, "03001").alias("county_fips"), F.when(F.col("id") % 4 < 2, "1").when(F.col("id") % 4 == 2, "03").alias("st"))
    out = blocks(spark).checked().attach(homes, "id", {"county": "county_fips", "state": "st"}, 3)
    assert out.columns == ["id", "st", "block_geoid", "tract_geoid", "county_fips", "state_fips", "congressional_district_geoid", "block_known_at"]
    got = {(r.k, r.block_known_at, r.county_fips): r["count"] for r in out.groupBy((F.col("id") % 4).alias("k"), "block_known_at", "county_fips").count().collect()}
    assert set(got) == {(0, "county", "01001"), (1, "state", "01001"), (1, "state", "01003"), (2, "all", "01001"), (2, "all", "01003"), (2, "all", "02001"), (3, "all", "01001"), (3, "all", "01003"), (3, "all", "02001")}
    assert abs(got[1, "state", "01001"] / 750 - 4 / 6) < 0.06 and abs(got[3, "all", "02001"] / 750 - 0.4) < 0.06
    assert out.where("length(congressional_district_geoid) <> 4 or congressional_district_geoid is null").count() == 0
    assert {r.block_geoid for r in blocks(spark).attach(homes.limit(0), "id", {}, 3).collect()} == set()
    none = CensusSource(blocks(spark).blocks.limit(0))
    assert {r.block_geoid for r in none.attach(homes.limit(5), "id", {"state": "st"}, 3).collect()} == {None}


def test_lowest_level_equals_assignment_in_one_area(spark):
    """With one level known of all, draws are those of the plain assignment."""
    homes = spark.range(500).select("id", F.lit("01").alias("state"))
    units = blocks(spark).blocks
    one = geography.assign(homes, "id", "state", geography.intervals(units.select(F.substring("block_geoid", 1, 2).alias("state"), "block_geoid", "population"), "state", "block_geoid", "population"), "block_geoid", 5)
    two = geography.assign_lowest(homes, "id", {"state": "state"}, geography.level_intervals(units, "block_geoid", "population"), "unit", 5)
    assert {r.id: r.block_geoid for r in one.collect()} == {r.id: r.unit for r in two.collect()}


def test_crosswalk_gate(spark):
    rows = [("01001000000000123", 1, "1"), (None, 1, "1"), ("010010000000001", -1, "12345"), ("010010000000001", 1, None)]
    bad = CensusSource(spark.createDataFrame(rows, "block_geoid string, population long, district string"), district="district")
    with pytest.raises(GeographyError, match="2 codes of block; 2 codes of congressional_district; 1 blocks listed twice; 1 blocks of negative size"):
        bad.checked()
    with pytest.raises(GeographyError, match="tract"):
        blocks(spark).attach(spark.range(1), "id", {"tract": "id"}, 1)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_declared_population(spark):
    spec, given = declared.load(), declared.inputs(spark, DATA)
    found = execute.plan(spec, given)
    assert {n: r.split(":")[0] for n, r in found.refused.items()} == {"rent": "open decision", "tip_income": "no donors of source 'lines'"}
    made = declared.construct(spark, DATA)
    assert set(made) == {"household", "person", "family", "spm_unit", "tax_unit", "marital_unit"}
    assert {c for df in made.values() for c in df.columns} >= set(spec.variables) - set(found.refused)
    people = made["person"].cache()
    assert people.where("owes_tax is null").count() == 0 and people.where("capital_gains is null").count() == 0
    known = {r[0] for r in spark.read.parquet(f"{DATA}/supplier.parquet").select("s_acctbal").collect()}
    assert {r[0] for r in people.select("capital_gains").distinct().collect()} <= known
    homes = made["household"].cache()
    assert homes.count() == 2 * spark.read.parquet(f"{DATA}/customer.parquet").count()
    assert homes.where("household_weight < 0 or net_worth is null or state_fips <> substr(block_geoid, 1, 2)").count() == 0
    assert people.join(homes, people.person_household_id == homes.household_id, "left_anti").count() == 0
