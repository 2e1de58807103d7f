"""Execution of a declared specification: which variables can be made, in what order, and the Spark jobs that make them.

A variable needs others: a transform its arguments, an imputation its predictors. Variables are sorted into levels, each
of which needs earlier levels only. All row-level variables of a level are one projection an entity, all codes of the
geography source one job, all variables drawn from one source one chain of draws. What can't be made is refused by name
with a reason, and so is what needs it; nothing is defaulted in silence, and nothing fails later for want of a column.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from popforge.functions.scalars import fixed_width
from popforge.operators import geography, impute
from popforge.operators.takeup import takeup
from popforge.plans.spec import Spec, SpecError, Variable
from popforge.sources.census import CensusSource
from popforge.sources.registry import household_rows
from popforge.sources.storage import written

#: County codes of New York City's five boroughs (fixed values).
CITY_COUNTIES = ("36005", "36047", "36061", "36081", "36085")

#: (columns of the arguments, seed) -> column
Transform = Callable[[Sequence[Column], int], Column]
TRANSFORMS: Mapping[str, Transform] = {"geography_in_nyc": lambda args, seed: geography.in_set(args[0], CITY_COUNTIES)}


@dataclass(frozen=True)
class Inputs:
    """What a specification is run on. Frames of an entity have its key, and household_id where they may ask for columns of
    the household; those that are drawn for have `half` where the specification has steps for halves."""

    frames: Mapping[str, DataFrame]
    keys: Mapping[str, str]
    census: CensusSource | None = None
    #: level -> column of the household frame that may know the area
    known: Mapping[str, str] = field(default_factory=dict)
    #: donors by source
    donors: Mapping[str, impute.Donors] = field(default_factory=dict)
    #: predictors by name of their group, or by source for sources without steps
    groups: Mapping[str, Sequence[str]] = field(default_factory=dict)
    rates: Mapping[str, float] = field(default_factory=dict)
    transforms: Mapping[str, Transform] = field(default_factory=lambda: TRANSFORMS)
    forest: Mapping[str, object] = field(default_factory=dict)


@dataclass(frozen=True)
class Plan:
    #: names of variables by level
    levels: tuple[tuple[str, ...], ...]
    #: variable -> why it can't be made
    refused: Mapping[str, str]


def _steps(spec: Spec, v: Variable) -> list:
    return [s for s in spec.imputation if s.source == v.parameters.get("source") and v.name in s.variables]


def _predictors(spec: Spec, v: Variable, inputs: Inputs) -> list[str]:
    """Columns that a drawn variable is conditioned on."""
    steps = _steps(spec, v)
    groups = [g for s in steps for g in s.condition_on] if steps else [str(v.parameters.get("source"))]
    return list(dict.fromkeys(c for g in groups for c in inputs.groups.get(g, ())))


def _needs(spec: Spec, v: Variable, inputs: Inputs) -> list[str]:
    if v.kind == "derive":
        return [str(x) for x in v.parameters.get("depends_on", ())]
    return _predictors(spec, v, inputs) if v.kind == "impute" else []


def _reason(spec: Spec, v: Variable, inputs: Inputs) -> str | None:
    """Why a variable can't be made whatever else is, or None."""
    p, frame = v.parameters, inputs.frames.get(v.entity)
    if v.kind == "open_decision":
        return f"open decision: {p.get('notes', 'no notes')}"
    if frame is None:
        return f"no frame of entity {v.entity!r}"
    if v.kind == "structural_export":
        return None if v.name in frame.columns else f"the {v.entity} frame has no column {v.name!r}"
    if v.kind == "passthrough":
        source, column = p.get("source", spec.base), str(p.get("source_column", v.name))
        if source != spec.base:
            return f"source {source!r} is not the spine"
        return None if column in frame.columns else f"source {source!r} has no column {column!r}"
    if v.kind == "encode_geoid":
        if not str(p.get("encoding", "")).startswith("S"):
            return f"unknown encoding {p.get('encoding')!r}"
        if "column" in p:
            return None if p["column"] in frame.columns else f"the {v.entity} frame has no column {p['column']!r}"
        if p.get("source") != "geography":
            return f"codes of unknown source {p.get('source')!r}"
        if inputs.census is None:
            return "no geography source"
        if v.entity != "household":
            return "geography is assigned to households"
        return None if v.name in inputs.census.codes else f"the geography source has no code {v.name!r}"
    if v.kind == "derive":
        return None if p.get("transform") in inputs.transforms else f"no transform {p.get('transform')!r}"
    if v.kind == "rerandomize_takeup":
        return None if v.name in inputs.rates else "no take-up rate"
    if v.kind == "impute":
        source = str(p.get("source"))
        if source not in inputs.donors:
            return f"no donors of source {source!r}"
        if v.name not in inputs.donors[source].rows.columns:
            return f"source {source!r} has no column {v.name!r}"
        steps = _steps(spec, v)
        if steps and "half" not in frame.columns:
            return f"the {v.entity} frame has no halves"
        predictors = _predictors(spec, v, inputs)
        lacking = [c for c in predictors if c not in inputs.donors[source].rows.columns]
        return f"source {source!r} lacks predictors {lacking}" if lacking else None if predictors else f"no predictors for source {source!r}"
    return f"unknown kind {v.kind!r}"


def _visible(entity: str, inputs: Inputs) -> set[str]:
    """Raw columns that variables of an entity may ask for: its own, and the household's where it is linked."""
    frame = inputs.frames[entity]
    home = inputs.frames.get("household")
    return set(frame.columns) | (set(home.columns) if home is not None and inputs.keys.get("household", "household_id") in frame.columns else set())


def plan(spec: Spec, inputs: Inputs, wanted: Collection[str] | None = None) -> Plan:
    """Levels of what can be made and reasons for the rest. Variables that need each other are an error. wanted: only these
    variables, and what they need."""
    refused = {v.name: r for v in spec.variables.values() if (r := _reason(spec, v, inputs))}
    needs: dict[str, set[str]] = {}
    for v in spec.variables.values():
        if v.name in refused:
            continue
        needs[v.name] = set()
        for other in _needs(spec, v, inputs):
            if other in spec.variables and other != v.name:
                needs[v.name].add(other)
            elif other not in _visible(v.entity, inputs):
                refused[v.name] = f"needs {other!r}, which is neither declared nor a column"
    # what needs something that is refused is refused too, unless the raw column stands in for it
    while lost := {n: o for n in needs if n not in refused for o in needs[n] if o in refused and o not in _visible(spec.variables[n].entity, inputs)}:
        refused |= {n: f"needs {o!r}, which is refused" for n, o in lost.items()}
    open_ = {n: {o for o in others if o not in refused} for n, others in needs.items() if n not in refused}
    if wanted is not None:
        if unknown := set(wanted) - spec.variables.keys():
            raise SpecError(f"undeclared {sorted(unknown)}")
        kept, more = set(), {n for n in wanted if n in open_}
        while more:
            kept |= more
            more = {o for n in more for o in open_[n]} - kept
        open_ = {n: o for n, o in open_.items() if n in kept}
    levels = []
    while open_:
        ready = tuple(n for n, others in open_.items() if not others & open_.keys())
        if not ready:
            raise SpecError(f"variables need each other: {sorted(open_)}")
        levels.append(ready)
        open_ = {n: o for n, o in open_.items() if n not in ready}
    return Plan(tuple(levels), refused)


def refusals(spark: SparkSession, spec: Spec, found: Plan) -> DataFrame:
    """variable, entity, kind, reason of what can't be made."""
    rows = [(n, spec.variables[n].entity, spec.variables[n].kind, reason) for n, reason in found.refused.items()]
    return spark.createDataFrame(rows, "variable string, entity string, kind string, reason string")


def _column(v: Variable, spec: Spec, inputs: Inputs) -> Column:
    """A row-level variable, over the columns of its entity's frame."""
    p = v.parameters
    if v.kind == "passthrough":
        return F.col(str(p.get("source_column", v.name)))
    if v.kind == "encode_geoid":
        return fixed_width(str(p.get("column", v.name)), int(str(p["encoding"])[1:]))
    if v.kind == "derive":
        return inputs.transforms[str(p["transform"])]([F.col(str(c)) for c in p.get("depends_on", ())], spec.seed)
    if v.kind == "rerandomize_takeup":
        return takeup(inputs.keys[v.entity], v.name, inputs.rates[v.name], spec.seed)
    return F.col(v.name)


def _with_household(frame: DataFrame, home: DataFrame | None, names: Sequence[str], key: str) -> tuple[DataFrame, list[str]]:
    """The frame with the household's columns of these names that it lacks, and their names."""
    lacking = [n for n in dict.fromkeys(names) if n not in frame.columns]
    return (household_rows(frame, home, key, key, {n: n for n in lacking}) if lacking else frame), lacking


def _drawn(spec: Spec, inputs: Inputs, frame: DataFrame, entity: str, source: str, names: Sequence[str]) -> DataFrame:
    """The frame with variables drawn from one source: by the declared steps, or for every record where there are none."""
    key, given = inputs.keys[entity], inputs.donors[source]
    stepped = [n for n in names if _steps(spec, spec.variables[n])]
    direct = [n for n in names if n not in stepped]
    if stepped:
        steps = [impute.Step(s.onto, tuple(v for v in s.variables if v in stepped), s.synthesize, s.condition_on, s.order) for s in spec.imputation if s.source == source]
        frame = impute.forest_steps(frame, [s for s in steps if s.variables], given, key, inputs.groups, seed=spec.seed, **inputs.forest)
    if direct:
        draws = impute.forest_draws(given, frame, key, direct, inputs.groups[source], seed=spec.seed, **inputs.forest)
        frame = frame.drop(*direct).join(draws, key, "left")
    return frame


def execute(spec: Spec, inputs: Inputs, found: Plan | None = None) -> dict[str, DataFrame]:
    """entity -> its key and the variables that can be made, in the order declared. Entities without any are left out."""
    found = found or plan(spec, inputs)
    frames, made, link = dict(inputs.frames), set(), inputs.keys.get("household", "household_id")
    for level in found.levels:
        variables = [spec.variables[n] for n in level]
        if any(v.kind == "encode_geoid" and "column" not in v.parameters for v in variables):
            frames["household"] = inputs.census.checked().attach(frames["household"], inputs.keys["household"], inputs.known, spec.seed)
        for entity in dict.fromkeys(v.entity for v in variables):
            own = [v for v in variables if v.entity == entity]
            asked = [c for v in own for c in _needs(spec, v, inputs)]
            frame, borrowed = _with_household(frames[entity], frames.get("household") if entity != "household" else None, asked, link)
            by_source: dict[str, list[str]] = {}
            for v in own:
                if v.kind == "impute":
                    by_source.setdefault(str(v.parameters["source"]), []).append(v.name)
            for source, names in by_source.items():
                frame = _drawn(spec, inputs, frame, entity, source, names)
            # raw columns that a variable of another name is made from stay as they are until the projection is made
            frame = frame.withColumns({v.name: _column(v, spec, inputs) for v in own if v.kind != "impute"})
            frames[entity] = frame.drop(*[c for c in borrowed if c not in {v.name for v in own}])
            made |= {v.name for v in own}
            if by_source:
                frames[entity] = written(frames[entity])
    out = {}
    for entity, frame in frames.items():
        names = [v.name for v in spec.variables.values() if v.entity == entity and v.name in made]
        if names:
            out[entity] = frame.select(*dict.fromkeys([inputs.keys[entity], *names]))
    return out
