"""Scoring against the frozen baseline."""

import json

import pytest

from popforge.plans import scoring
from popforge.plans.construct import CONTENT
from popforge.sources import manifests


def frozen(**metrics):
    raw = json.loads((CONTENT / "scoring.json").read_text())
    return manifests.load_scoring(json.dumps(raw | {"baseline_metrics": metrics or raw["baseline_metrics"]}))


def test_baseline_figures_by_any_prefix():
    names = {"baseline_x_native_loss": 3.0, "baseline_initial_x_native_loss": 4.0, "baseline_train_loss": 2.0, "baseline_holdout_loss": 1.0, "baseline_unweighted_msre": 9.0, "n_targets_kept": 5}
    assert scoring.baseline_figures(names) == {"total_loss": 3.0, "initial_loss": 4.0, "train_loss": 2.0, "holdout_loss": 1.0, "unweighted_msre": 9.0, "n_targets_kept": 5.0}
    with pytest.raises(manifests.ManifestError, match="several figures for holdout_loss"):
        scoring.baseline_figures({"a_holdout_loss": 1, "b_holdout_loss": 2})


def test_parts_add_up_and_verdicts(spark):
    rows = [("t0", "a", "national", 0.5), ("t1", "a", "state", -3.0), ("t2", "b", "state", 0.0), ("t3", "b", "state", None), ("t4", "b", "national", 1.0)]
    scored = spark.createDataFrame(rows, "target_id string, bucket string, geo_level string, residual double")
    parts = {r.target_id: r.part for r in scoring.contributions(scored).collect()}
    assert parts == {"t0": 0.0625, "t1": 1.25, "t2": 0.0, "t4": 0.25}
    found = {r.measure: r.candidate for r in scoring.measured(scored, scored, 0.5, 7).collect()}
    assert found["total_loss"] == found["initial_loss"] == 1.5625 and found["train_loss"] + found["holdout_loss"] == 1.5625
    assert (found["n_national_targets"], found["n_state_targets"], found["n_targets_kept"], found["unweighted_msre"]) == (2, 2, 4, 10.25 / 4)
    profile = spark.createDataFrame([("balance", 5.0, True, 3), ("other", 1.0, True, 1)], "column string, abs_sum double, finite boolean, nonzero_count long")
    told = {(r.kind, r.name): r.passed for r in scoring.verdict(scoring.measured(scored, scored, 0.5, 7), profile, frozen(x_loss=1.6, x_initial_loss=1.5, n_state_targets=2, n_targets_kept=5)).collect()}
    assert told == {("measure", "total_loss"): True, ("measure", "initial_loss"): False, ("measure", "n_state_targets"): True, ("measure", "n_targets_kept"): False, ("column", "balance"): True, ("column", "nothing"): False}


def test_no_targets(spark):
    none = spark.createDataFrame([], "target_id string, bucket string, geo_level string, residual double")
    assert {r.candidate for r in scoring.measured(none, none, 0.2, 1).collect()} == {0.0}
