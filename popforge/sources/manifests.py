"""Declarations that come as JSON: source blocks, observations, the export contract and scoring settings."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from popforge.operators.calibrate import Settings
from popforge.operators.entities import household_counts
from popforge.operators.gates import Contract
from popforge.operators.impute import Donors, forest_draws
from popforge.operators.normalize import Block, normalize, split_entities
from popforge.sources.registry import Observation, household_rows, read_delimited, single_person_households

_UNDER = re.compile(r"count_under_([0-9]+)\Z")


class ManifestError(ValueError):
    """A manifest that can't be used."""


@dataclass(frozen=True)
class HouseholdColumns:
    """Where persons find their household, and the household columns that they take (person column -> household column)."""

    person_household: str
    household: str
    columns: Mapping[str, str]


@dataclass(frozen=True)
class DelimitedFile:
    name: str
    delimiter: str | None
    usecols: tuple[str, ...]


@dataclass(frozen=True)
class SourceBlock:
    """One survey as a source of imputation: how it is read and normalised, what it predicts and from what."""

    name: str
    survey: str
    block_name: str | None
    year: int
    archetype: str
    normalized: Block
    household_columns: HouseholdColumns | None = None
    delimited: DelimitedFile | None = None
    #: the column whose presence tells the length of a survey of single persons
    length_column: str | None = None
    generated_ids: bool = False
    targets: tuple[str, ...] = ()
    predictors: tuple[str, ...] = ()
    household_variables: tuple[str, ...] = ()
    person_variables: tuple[str, ...] = ()
    counts: Mapping[str, int] = field(default_factory=dict)

    @property
    def full_name(self) -> str:
        return self.survey if self.block_name is None else f"{self.survey}_{self.block_name}"

    def read(self, spark: SparkSession, folder: str, schema: str) -> DataFrame:
        """The raw rows of a delimited survey."""
        if self.delimited is None:
            raise ManifestError(f"{self.name} is no delimited survey")
        return read_delimited(spark, f"{folder}/{self.delimited.name}", schema, self.delimited.delimiter, self.delimited.usecols)

    def build(self, raw: DataFrame, households: DataFrame | None = None, order: Sequence[str] = ()) -> DataFrame:
        """Canonical person rows: household columns attached, block normalised, ids made and members counted where the
        block says so. order: columns that tell raw rows apart, for generated ids."""
        if self.household_columns is not None:
            if households is None:
                raise ManifestError(f"{self.name} needs households")
            at = self.household_columns
            raw = household_rows(raw, households, at.person_household, at.household, at.columns)
        if self.length_column is not None:
            if self.length_column not in raw.columns:
                raise ManifestError(f"{self.name}: no column {self.length_column!r}")
            raw = raw.where(F.col(self.length_column).isNotNull())
        extra = {c: c for c in order if self.generated_ids}
        block = Block(**{**self.normalized.__dict__, "direct": {**self.normalized.direct, **{f"_order_{c}": c for c in extra}}})
        rows = normalize(raw, block)
        if self.generated_ids:
            rows = single_person_households(rows, [f"_order_{c}" for c in order]).drop(*[f"_order_{c}" for c in order])
        return household_counts(rows, "household_id", "age", self.counts) if self.counts else rows

    def entities(self, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Household and person frames with the block's variables that there are."""
        have = set(rows.columns)
        home, own = ([v for v in names if v in have] for names in (self.household_variables, self.person_variables))
        return split_entities(rows, "household_id", [*home, *(["weight"] if "weight" in have else [])], ["person_id", *own], ["person_id"])

    def model_frame(self, rows: DataFrame, derived: Mapping[str, Column] | None = None) -> DataFrame:
        """person_id, household_id, weight, predictors and targets as doubles; derived: predictors that no column has yet."""
        rows = rows.withColumns(dict(derived or {}))
        missing = [c for c in (*self.predictors, *self.targets) if c not in rows.columns]
        if missing:
            raise ManifestError(f"{self.name}: no columns {missing}")
        numbers = [F.col(c).cast("double").alias(c) for c in dict.fromkeys([*self.predictors, *self.targets])]
        return rows.select(*[c for c in ("person_id", "household_id", "weight") if c in rows.columns], *numbers)


    def draw(self, rows: DataFrame, recipients: DataFrame, key: str, derived: Mapping[str, Column] | None = None, **forest) -> DataFrame:
        """key and every target of the block, drawn for recipients(key, predictors) from the block's canonical rows, one after
        the other, so that the targets of one recipient go together."""
        given = self.model_frame(rows, derived)
        missing = [c for c in self.predictors if c not in recipients.columns]
        if missing:
            raise ManifestError(f"{self.name}: recipients lack {missing}")
        return forest_draws(Donors(given, "person_id", "weight" if "weight" in given.columns else None), recipients, key, self.targets, self.predictors, **forest)


def _counts(names: Sequence[str]) -> dict[str, int]:
    out = {}
    for name in names:
        match = _UNDER.match(name)
        if not match:
            raise ManifestError(f"no age limit in {name!r}")
        out[name] = int(match[1])
    return out


def _built(raw: Mapping) -> dict:
    """Block and loading of a survey that comes as a dataset of arrays."""
    load = raw["dataset_loader"]
    kind = load["builder_kind"]
    direct, homes = dict(load.get("direct_person_columns") or {}), None
    mapped = {}
    if kind == "household_rows":
        at = dict(load.get("row_indexed_person_columns") or {})
        tables = load.get("mapped_value_tables") or {}
        recoded = dict(load.get("mapped_row_person_columns") or {})
        # household columns are attached under names of their own, so that no person column is hidden
        attached = {f"_household_{c}": c for c in {*at.values(), *recoded.values()}}
        direct |= {name: f"_household_{c}" for name, c in at.items()}
        direct |= {"household_id": load["person_household_key"], "person_id": load["person_id_key"]}
        mapped = {name: (f"_household_{c}", tables[name]) for name, c in recoded.items()}
        homes = HouseholdColumns(load["person_household_key"], load["household_index_key"], attached)
    elif kind != "single_person_households":
        raise ManifestError(f"unknown builder {kind!r}")
    sex = load.get("sex_from_boolean_source")
    block = Block(
        direct=direct,
        boolean=load.get("boolean_person_columns") or {},
        mapped=mapped,
        fallback=load.get("fallback_person_columns") or {},
        constant=load.get("constant_person_columns") or {},
        copy=load.get("copy_person_columns") or {},
        sex_code=("sex", sex, load["sex_true_value"], load["sex_false_value"]) if sex else None,
        sums={"income": load["income_sum_columns"]} if load.get("income_sum_columns") else {},
        integers=load.get("int_person_columns") or (),
        annualized=raw.get("annualized_variables") or (),
    )
    return {"normalized": block, "household_columns": homes, "generated_ids": bool(load.get("generated_household_ids")), "length_column": load.get("length_source_key")}


def _delimited(raw: Mapping) -> dict:
    """Block and loading of a survey that comes as a delimited file of person-months."""
    load, month = raw["raw_loader"], raw.get("required_monthcode")
    block = Block(
        direct=load.get("direct_columns") or {},
        keys={"household_id": load["household_id_parts"], "person_id": load["person_id_parts"]},
        name_sums=load.get("sum_columns_contains") or {},
        constant=load.get("constant_columns") or {},
        copy=load.get("copy_columns") or {},
        indicators={name: (x["column"], x["equals"]) for name, x in (load.get("indicator_columns") or {}).items()},
        integers=load.get("int_columns") or (),
        annualized=raw.get("annualized_variables") or (),
        period=("MONTHCODE", month) if month is not None else None,
    )
    return {"normalized": block, "delimited": DelimitedFile(load["filename"], load.get("delimiter"), tuple(load.get("usecols") or ()))}


def load_blocks(text: str) -> dict[str, SourceBlock]:
    """The source blocks of a JSON manifest by name."""
    out = {}
    for name, raw in json.loads(text)["blocks"].items():
        try:
            made = _built(raw) if raw.get("dataset_loader") else _delimited(raw)
            out[name] = SourceBlock(
                name,
                raw["survey_name"],
                raw.get("block_name"),
                int(raw["default_year"]),
                raw["archetype"],
                targets=tuple(raw.get("target_variables") or ()),
                predictors=tuple(raw.get("predictors") or ()),
                household_variables=tuple(raw.get("household_variables") or ()),
                person_variables=tuple(raw.get("person_variables") or ()),
                counts=_counts(raw.get("household_count_variables") or ()),
                **made,
            )
        except (KeyError, TypeError) as e:
            raise ManifestError(f"{name}: missing or misplaced: {e}") from e
    return out


@dataclass(frozen=True)
class ObservationManifest:
    name: str
    archetype: str
    population: str
    observations: tuple[Observation, ...]


def load_observations(text: str) -> ObservationManifest:
    """How the record types of one microdata file are read."""
    raw = json.loads(text)
    try:
        found = tuple(Observation(o["entity"], o["key_column"], o["weight_column"], tuple((c["raw_column"], c["canonical_name"]) for c in o["columns"])) for o in raw["observations"])
        return ObservationManifest(raw["name"], raw["archetype"], raw.get("population", ""), found)
    except (KeyError, TypeError) as e:
        raise ManifestError(f"missing or misplaced: {e}") from e


def load_contract(text: str) -> Contract:
    """An export contract: lists named required and forbidden, and lists whose names end with _optional or begin with
    formula_owned."""
    raw = {name: frozenset(x) for name, x in json.loads(text).items() if isinstance(x, list)}
    if "required" not in raw:
        raise ManifestError("no list of required columns")
    of = lambda test: frozenset().union(*[x for name, x in raw.items() if test(name)])
    return Contract(raw["required"], of(lambda n: n.endswith("_optional")), raw.get("forbidden", frozenset()), of(lambda n: n.startswith("formula_owned")))


@dataclass(frozen=True)
class Scoring:
    """What a candidate is scored by, and the frozen figures it is held against."""

    settings: Settings
    period: int
    profile: str
    scope: str
    holdout_fraction: float
    holdout_seed: int
    metrics: Mapping[str, float]
    #: column -> figures of the baseline's sanity profile
    sanity: Mapping[str, Mapping[str, object]]


def load_scoring(text: str) -> Scoring:
    """Scoring settings of a benchmark manifest. Switches that are not supported are refused, not ignored."""
    raw = json.loads(text)
    try:
        config, refit = raw["scoring_config"], raw["scoring_config"]["refit_config"]
        kept = {name: refit[name] for name in ("max_iter", "tol", "lambda_l0", "lambda_l2", "use_gates") if name in refit}
        switches = {name: config[name] for name in ("exact_rescore", "skip_tax_expenditure_targets") if name in config}
        if refit.get("target_total_weight", "preserve_input") != "preserve_input":
            raise ManifestError(f"unknown total {refit['target_total_weight']!r}")
        return Scoring(
            Settings(**kept, **switches),
            int(config["period"]),
            config["target_profile"],
            config["target_scope"],
            float(config["holdout_target_fraction"]),
            int(config["holdout_target_seed"]),
            raw.get("baseline_metrics", {}),
            raw.get("baseline_sanity", {}).get("required_nonzero_columns", {}),
        )
    except KeyError as e:
        raise ManifestError(f"missing: {e}") from e
