"""Specs and manifests of the surveyed layout, on small fixtures of the same shape."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from popforge.plans import construct
from popforge.plans import spec as specs
from popforge.sources import manifests, registry

SPEC = """
meta: {country: zz, model_year: 2024, model: m}
sources: {survey: {dataset: orders, role: spine}, tax: {dataset: supplier, role: donor}}
spine:
  base: survey
  method: support_spine
  support: {seed: 5}
  halves:
    - {name: keep, keep: all}
    - {name: synthetic, strip_to: [demographics]}
imputation: [{onto: synthetic, from: tax, vars: [wages], condition_on: [demographics], order: spine_first, synthesize: true}]
variables:
  wages:
    entity: person
    role: imputed
    temporary: true
    before: {method: old, code: [{path: a.py, lines: 1-2, symbol: f, summary: s}]}
    now: {method: new, operation: {kind: impute, source: tax, imputation_step: one}, code: [{path: b.yaml}], notes: n}
  rent:
    entity: household
    role: open
    temporary: true
    before: {method: old, code: []}
    now: {method: new, operation: {kind: open_decision, notes: later}, code: [{path: b.yaml}]}
targets: {store: {country: zz, model_year: 2024, target_profile: p}}
calibrate: {loss: huber, method: apg}
"""


def test_nested_layout(spark):
    spec = specs.load(SPEC)
    assert spec.seed == 5 and spec.halves == (("keep", ("all",)), ("synthetic", ("demographics",)))
    assert spec.targets["target_profile"] == "p" and spec.variables["wages"].parameters["imputation_step"] == "one"
    assert specs.coverage(spec, frozenset({"rent", "age"})) == ({"age"}, set())
    assert specs.lint(spec) == {"temporary": 2, "open_decision": 1}
    assert specs.untraced(spec, ["before", "now"]) == ["rent"]
    assert {tuple(r) for r in specs.lineage(spark, spec).collect()} == {("wages", "before", "a.py", "1-2", "f", "s"), ("wages", "now", "b.yaml", "", "", ""), ("rent", "now", "b.yaml", "", "", "")}


def test_a_variable_has_one_operation():
    with pytest.raises(specs.SpecError):
        specs.load(SPEC.replace("before: {method: old, code: [{", "before: {method: old, operation: {kind: impute}, code: [{"))
    with pytest.raises(specs.SpecError):
        specs.load(SPEC.replace("operation: {kind: open_decision, notes: later}, ", ""))


def test_content_is_data_and_loads(tmp_path):
    assert specs.content_is_data(str(construct.CONTENT)) == []
    spec = specs.load((construct.CONTENT / "proxy.yaml").read_text())
    assert specs.coverage(spec, construct.contract(spec).required) == (set(), set())
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "code.py").write_text("")
    assert specs.content_is_data(str(tmp_path)) == ["a/code.py"]


TIPS = {
    "survey_name": "panel",
    "block_name": "tips",
    "default_year": 2023,
    "archetype": "household_income",
    "raw_loader": {
        "filename": "raw.csv",
        "delimiter": "|",
        "usecols": ["SSUID", "MONTHCODE", "PNUM", "TAGE", "ESEX", "TXAMT1", "TXAMT2", "PAY", "W"],
        "direct_columns": {"age": "TAGE", "sex": "ESEX", "pay": "PAY", "weight": "W"},
        "sum_columns_contains": {"tips": "TXAMT"},
        "indicator_columns": {"is_female": {"column": "ESEX", "equals": 2}},
        "int_columns": ["age", "sex"],
        "household_id_parts": ["SSUID", "MONTHCODE"],
        "person_id_parts": ["SSUID", "MONTHCODE", "PNUM"],
        "constant_columns": {"tenure": 0},
        "copy_columns": {"income": "pay"},
    },
    "required_monthcode": 12,
    "annualized_variables": ["tips", "pay"],
    "household_count_variables": ["count_under_18"],
    "household_variables": ["tenure"],
    "person_variables": ["age", "tips", "count_under_18"],
    "target_variables": ["tips"],
    "predictors": ["pay", "age", "count_under_18"],
}


def test_a_delimited_block(spark, tmp_path):
    (tmp_path / "raw.csv").write_text("SSUID|MONTHCODE|PNUM|TAGE|ESEX|TXAMT1|TXAMT2|PAY|W|MORE\na|12|1|40|1|1.5||10|2|x\na|12|2|9|2|||0|2|x\na|11|1|40|1|9|9|10|2|x\nb|12|1|30|2|1|1|5|1|x\n")
    block = manifests.load_blocks(json.dumps({"blocks": {"tips": TIPS}}))["tips"]
    assert (block.full_name, block.year, block.archetype) == ("panel_tips", 2023, "household_income")
    raw = block.read(spark, str(tmp_path), "SSUID string, MONTHCODE int, PNUM int, TAGE int, ESEX int, TXAMT1 double, TXAMT2 double, PAY double, W double, MORE string")
    assert "MORE" not in raw.columns
    rows = block.build(raw)
    got = {r.person_id: r for r in rows.collect()}
    assert set(got) == {"a-12-1", "a-12-2", "b-12-1"}
    one = got["a-12-1"]
    assert (one.tips, one.pay, one.income, one.count_under_18, one.is_female, one.tenure) == (18.0, 120.0, 10.0, 1, False, 0)
    homes, people = block.entities(rows)
    assert homes.count() == 2 and people.columns == ["household_id", "person_id", "age", "tips", "count_under_18"]
    frame = block.model_frame(rows)
    assert frame.columns == ["person_id", "household_id", "weight", "pay", "age", "count_under_18", "tips"]
    with pytest.raises(manifests.ManifestError):
        block.model_frame(rows.drop("pay"))


def test_a_block_of_households(spark):
    block = manifests.load_blocks((construct.CONTENT / "blocks.json").read_text())["homes"]
    people = spark.createDataFrame([(1, 10, 30, 5.0), (2, 10, 3, None), (3, 99, 50, 1.0)], "person_id long, household_id long, age int, income double")
    homes = spark.createDataFrame([(10, 7, "BUILDING", 2.0), (11, 8, "x", 1.0)], "household_id long, nation int, segment string, weight double")
    got = {r.person_id: (r.state, r.weight, r.tenure, r.income, r.household_size, r.count_under_18) for r in block.build(people, homes).collect()}
    assert got == {1: (7, 2.0, 1, 5.0, 2, 1), 2: (7, 2.0, 1, 0.0, 2, 1), 3: (None, None, None, 1.0, 1, 0)}
    with pytest.raises(manifests.ManifestError):
        block.build(people)


def test_a_block_of_single_persons(spark):
    block = manifests.load_blocks((construct.CONTENT / "blocks.json").read_text())["wealth"]
    assert block.full_name == "wealth_assets"
    raw = spark.createDataFrame([(5, 1, -2.0, 1.0), (3, 2, 4.0, 1.0), (None, 2, 4.0, 1.0)], "donor_id long, nation int, donor_balance double, donor_weight double")
    rows = {r.household_id: (r.person_id, r.nation, r.net_worth, r.assets, r.tenure) for r in block.build(raw, order=["donor_id"]).collect()}
    assert rows == {1: (1, 2, 4.0, 4.0, 0), 2: (2, 1, -2.0, -2.0, 0)}
    with pytest.raises(manifests.ManifestError):
        block.build(raw.drop("donor_id"), order=["donor_id"])


@pytest.mark.parametrize("change", [{"dataset_loader": {"builder_kind": "other"}}, {"raw_loader": {}}, {"household_count_variables": ["children"]}])
def test_bad_blocks_are_refused(change):
    with pytest.raises(manifests.ManifestError):
        manifests.load_blocks(json.dumps({"blocks": {"tips": TIPS | change}}))


def test_observations_contract_and_scoring(spark):
    found = manifests.load_observations(json.dumps({"name": "f", "archetype": "tax_microdata", "population": "p", "observations": [{"entity": "tax_unit", "key_column": "k", "weight_column": "w", "columns": [{"raw_column": "A", "canonical_name": "a"}, {"raw_column": "A", "canonical_name": "b"}]}]}))
    df = spark.createDataFrame([(1, 2.0, 3.0)], "k long, w double, A double")
    assert [tuple(r) for r in found.observations[0].apply(df).collect()] == [(1, 2.0, 3.0, 3.0)] and found.archetype == "tax_microdata"
    contract = manifests.load_contract(json.dumps({"_note": "x", "required": ["a"], "internal_optional": ["b"], "forbidden": ["c"], "formula_owned_excluded": ["d"]}))
    assert (contract.required, contract.optional, contract.forbidden, contract.formula_owned) == tuple(frozenset(x) for x in "abcd")
    raw = {"scoring_config": {"period": 2024, "target_profile": "p", "target_scope": "all", "holdout_target_fraction": 0.2, "holdout_target_seed": 9, "exact_rescore": False, "refit_config": {"max_iter": 200, "tol": 1e-8, "lambda_l0": 0.0, "use_gates": False, "target_total_weight": "preserve_input"}}, "baseline_metrics": {"loss": 0.05}, "baseline_sanity": {"required_nonzero_columns": {"x": {"nonzero_count": 3}}}}
    scoring = manifests.load_scoring(json.dumps(raw))
    assert scoring.settings.max_iter == 200 and scoring.holdout_seed == 9 and scoring.sanity["x"]["nonzero_count"] == 3
    for part, name in (("scoring_config", "exact_rescore"), ("scoring_config", "skip_tax_expenditure_targets")):
        with pytest.raises(ValueError):
            manifests.load_scoring(json.dumps({**raw, part: {**raw[part], name: True}}))
    with pytest.raises(manifests.ManifestError):
        manifests.load_observations(json.dumps({"name": "f"}))


def test_entities_are_exported_and_fingerprinted(spark, tmp_path):
    frames = {"household": spark.range(3).select(F.col("id").alias("household_id")), "person": spark.range(5).select(F.col("id").alias("person_id"))}
    registry.export_entities(frames, str(tmp_path))
    assert {n: spark.read.parquet(f"{tmp_path}/{n}").count() for n in frames} == {"household": 3, "person": 5}
    assert registry.file_fingerprints(spark, str(Path(tmp_path) / "person" / "*.parquet")).count() >= 1
