"""Construction specs: parsed from YAML into dataclasses, validated, and turned into columns where they can be.

A variable's operation says how it is made. Open decisions and imputations have no row-level expression:
asking for one raises, so nothing is defaulted in silence.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Collection, Mapping
from dataclasses import dataclass, field
from pathlib import Path

import yaml
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from popforge.functions.scalars import fixed_width
from popforge.operators.takeup import takeup

ENTITIES = ("person", "household", "family", "spm_unit", "tax_unit", "marital_unit")
KINDS = ("passthrough", "structural_export", "encode_geoid", "derive", "rerandomize_takeup", "impute", "open_decision")


class SpecError(ValueError):
    """A spec that can't be used."""


@dataclass(frozen=True)
class Variable:
    name: str
    entity: str
    role: str
    kind: str
    parameters: Mapping[str, object]
    temporary: bool = False
    #: view -> list of (path, lines, symbol, summary)
    provenance: Mapping[str, tuple[tuple[str, str, str, str], ...]] = field(default_factory=dict)


@dataclass(frozen=True)
class ImputationStep:
    onto: str
    source: str
    variables: tuple[str, ...]
    condition_on: tuple[str, ...]
    order: str
    synthesize: bool


@dataclass(frozen=True)
class Spec:
    country: str
    model_year: int
    sources: Mapping[str, tuple[str, str]]
    base: str
    seed: int
    #: name, column groups kept
    halves: tuple[tuple[str, tuple[str, ...]], ...]
    imputation: tuple[ImputationStep, ...]
    variables: Mapping[str, Variable]
    targets: Mapping[str, object]
    loss: str
    method: str


def _step(raw: Mapping) -> ImputationStep:
    return ImputationStep(raw["onto"], raw["from"], tuple(raw["vars"]), tuple(raw.get("condition_on", ())), raw.get("order", "spine_first"), bool(raw.get("synthesize", False)))


def _variable(name: str, raw: Mapping) -> Variable:
    """A variable whose operation is its own or that of its one view that has one, and whose sources are listed by view,
    under `provenance` or as the `code` of views beside it."""
    views = {view: v for view, v in raw.items() if isinstance(v, Mapping) and "code" in v}
    operations = [raw["operation"]] if "operation" in raw else [v["operation"] for v in views.values() if "operation" in v]
    if len(operations) != 1:
        raise SpecError(f"{name}: {len(operations)} operations")
    operation = dict(operations[0])
    listed = {**raw.get("provenance", {}), **{view: v["code"] for view, v in views.items()}}
    provenance = {view: tuple((c.get("path", ""), str(c.get("lines", "")), c.get("symbol", ""), c.get("summary", "")) for c in calls) for view, calls in listed.items()}
    return Variable(name, raw["entity"], raw.get("role", ""), operation.pop("kind"), operation, bool(raw.get("temporary", False)), provenance)


def _half(raw: Mapping) -> tuple[str, tuple[str, ...]]:
    """Name of a half and the column groups it keeps: ("all",), or those it is stripped to."""
    if "strip_to" in raw:
        return raw["name"], tuple(raw["strip_to"])
    return raw["name"], (raw["keep"],)


def _targets(raw: Mapping) -> Mapping[str, object]:
    """Target settings, which may lie under the name of the target store."""
    nested = [v for v in raw.values() if isinstance(v, Mapping)]
    return nested[0] if len(nested) == 1 and len(raw) == 1 else raw


def load(text: str) -> Spec:
    """A validated spec from YAML text; unknown sources, entities, kinds and steps are errors."""
    raw = yaml.safe_load(text)
    try:
        spec = Spec(
            raw["meta"]["country"],
            int(raw["meta"]["model_year"]),
            {alias: (s["dataset"], s["role"]) for alias, s in raw["sources"].items()},
            raw["spine"]["base"],
            int(raw["spine"]["seed"] if "seed" in raw["spine"] else raw["spine"]["support"]["seed"]),
            tuple(_half(h) for h in raw["spine"]["halves"]),
            tuple(_step(s) for s in raw.get("imputation", ())),
            {name: _variable(name, v) for name, v in raw["variables"].items()},
            _targets(raw.get("targets", {})),
            raw.get("calibrate", {}).get("loss", ""),
            raw.get("calibrate", {}).get("method", ""),
        )
    except (KeyError, TypeError) as e:
        raise SpecError(f"missing or misplaced: {e}") from e
    problems = []
    if spec.base not in spec.sources or spec.sources[spec.base][1] != "spine":
        problems.append(f"base {spec.base!r} is no spine source")
    halves = {name for name, _ in spec.halves}
    for i, s in enumerate(spec.imputation):
        problems += [f"step {i}: unknown half {s.onto!r}"] * (s.onto not in halves)
        problems += [f"step {i}: unknown source {s.source!r}"] * (s.source not in spec.sources)
        problems += [f"step {i}: undeclared {v!r}" for v in s.variables if v not in spec.variables]
    for v in spec.variables.values():
        problems += [f"{v.name}: unknown entity {v.entity!r}"] * (v.entity not in ENTITIES)
        problems += [f"{v.name}: unknown kind {v.kind!r}"] * (v.kind not in KINDS)
    if problems:
        raise SpecError("; ".join(problems))
    return spec


def coverage(spec: Spec, required: frozenset[str]) -> tuple[set[str], set[str]]:
    """Contract columns and imputed variables that the spec does not declare."""
    imputed = {v for s in spec.imputation for v in s.variables}
    return set(required) - set(spec.variables), imputed - set(spec.variables)


def lint(spec: Spec) -> dict[str, int]:
    """Provisional declarations: counts of temporary variables and open decisions, which should only fall."""
    kinds = Counter(v.kind for v in spec.variables.values())
    return {"temporary": sum(v.temporary for v in spec.variables.values()), "open_decision": kinds["open_decision"]}


def content_is_data(path: str) -> list[str]:
    """Files under a content folder that are not declarations (YAML, JSON, Markdown), by relative path."""
    root = Path(path)
    return sorted(str(f.relative_to(root)) for f in root.rglob("*") if f.is_file() and f.suffix not in (".yaml", ".yml", ".json", ".md"))


def untraced(spec: Spec, views: Collection[str]) -> list[str]:
    """Variables that lack a source in one of the views, which must all have one for a spec to be traceable."""
    return sorted(v.name for v in spec.variables.values() if any(not v.provenance.get(view) for view in views))


def lineage(spark: SparkSession, spec: Spec) -> DataFrame:
    """variable, view, path, lines, symbol, summary: every provenance entry."""
    rows = [(v.name, view, *call) for v in spec.variables.values() for view, calls in v.provenance.items() for call in calls]
    return spark.createDataFrame(rows, "variable string, view string, path string, lines string, symbol string, summary string")


def edges(spark: SparkSession, spec: Spec) -> DataFrame:
    """node, needs: what each variable, step, source and dataset of a spec is directly made from. Nodes are named by their
    kind, as in variable:age, step:0, source:survey, dataset:orders, code:some/path."""
    rows = {(f"source:{alias}", f"dataset:{dataset}") for alias, (dataset, _) in spec.sources.items()}
    rows |= {(f"step:{i}", f"source:{s.source}") for i, s in enumerate(spec.imputation)}
    rows |= {(f"step:{i}", f"source:{spec.base}") for i, _ in enumerate(spec.imputation)}
    for v in spec.variables.values():
        node = f"variable:{v.name}"
        steps = [i for i, s in enumerate(spec.imputation) if v.kind == "impute" and v.name in s.variables and s.source == v.parameters.get("source")]
        rows |= {(node, f"step:{i}") for i in steps}
        rows |= {(node, f"variable:{x}") for x in v.parameters.get("depends_on", ())}
        if not steps and "source" in v.parameters:
            rows.add((node, f"source:{v.parameters['source']}"))
        rows |= {(node, f"code:{path}") for calls in v.provenance.values() for path, *_ in calls if path}
    return spark.createDataFrame(sorted(rows), "node string, needs string")


#: handler or transform name -> builder of a column from (parameters, seed)
Handlers = Mapping[str, Callable[[Mapping[str, object], int], Column]]


def column_of(v: Variable, spec: Spec, handlers: Handlers, rates: Mapping[str, float], key: str) -> Column:
    """The column of a variable that has a row-level operation."""
    p = v.parameters
    if v.kind == "passthrough":
        return F.col(str(p.get("source_column", v.name))).alias(v.name)
    if v.kind == "structural_export":
        return F.col(v.name)
    if v.kind == "encode_geoid":
        return fixed_width(str(p["column"]), int(str(p["encoding"])[1:])).alias(v.name)
    if v.kind == "derive":
        name = str(p["transform"])
        if name not in handlers:
            raise SpecError(f"{v.name}: no transform {name!r}")
        return handlers[name](p, spec.seed).alias(v.name)
    if v.kind == "rerandomize_takeup":
        if v.name not in rates:
            raise SpecError(f"{v.name}: no take-up rate")
        return takeup(key, v.name, rates[v.name], spec.seed).alias(v.name)
    raise SpecError(f"{v.name}: {v.kind} has no row-level expression")
