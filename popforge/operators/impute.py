"""Imputation of donor variables: fill and override steps, weighted donor matching, forest-leaf sampling."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from popforge.functions.rng import uniform
from popforge.functions.scalars import clipped, zero_where
from popforge.operators.forest import Forest, Problem, grow, leaf_in, placed
from popforge.operators.ranges import RANGE, draw, in_ranges, running_sums
from popforge.sources.storage import bucketed, discard, written


@dataclass(frozen=True)
class Step:
    """One imputation step: variables drawn for one half; synthesize overwrites, else only nulls are filled."""

    onto: str
    variables: tuple[str, ...]
    synthesize: bool
    condition_on: tuple[str, ...] = ()
    order: str = "spine_first"

    def __post_init__(self):
        if self.order != "spine_first":
            raise ValueError(f"unknown order {self.order!r}")


def spine_first(variables: Sequence[str], available: Sequence[str]) -> list[str]:
    """Variables that the spine has come first, each group in list order."""
    have = set(available)
    return [v for v in variables if v in have] + [v for v in variables if v not in have]


def apply_step(spine: DataFrame, draws: DataFrame, key: str, step: Step) -> DataFrame:
    """A spine with a step's draws (key, variables) in place for its half; other rows and columns stay."""
    side = draws.select(key, *[F.col(v).alias(f"_draw_{v}") for v in step.variables])
    joined = spine.join(side, key, "left")
    here = F.col("half") == step.onto
    new = {}
    for v in step.variables:
        old, draw = (F.col(v) if v in spine.columns else F.lit(None)), F.col(f"_draw_{v}")
        new[v] = F.when(here, draw if step.synthesize else F.coalesce(old, draw)).otherwise(old)
    return joined.withColumns(new).select(*spine.columns, *[v for v in step.variables if v not in spine.columns])


def run_steps(spine: DataFrame, steps: Sequence[Step], draw: Callable[[DataFrame, tuple[str, ...]], DataFrame], key: str) -> DataFrame:
    """Steps in list order; draw(recipients, variables) gives (key, variables)."""
    for step in steps:
        spine = apply_step(spine, draw(spine.where(F.col("half") == step.onto), step.variables), key, step)
    return spine


def nearest_donor(recipients: DataFrame, donors: DataFrame, key: str, donor: str, cell: str, recipient_value: str, donor_value: str) -> DataFrame:
    """key, donor: the donor of the same cell with the nearest value, of equals the one with the smallest key; null
    where the cell has none or is null.

    Null values are nearest to nothing: donors of null value come after all others, and a recipient of null value takes the
    smallest donor of its cell. Donors with a null key or cell take no part.

    Donors and recipients of a cell are laid on one line and each recipient looks at the donors next to it on either
    side, so the work is a sort, never cell x cell pairs. A cell of any size is cut into ranges of values, and recipients of
    one value by their keys.
    """
    donors = donors.where(F.col(donor).isNotNull() & F.col(cell).isNotNull())
    valued = donors.where(F.col(donor_value).isNotNull())
    # donors sort before recipients of the same value
    line = recipients.where(F.col(recipient_value).isNotNull() & F.col(cell).isNotNull())
    line = line.select(cell, F.col(recipient_value).alias("_at"), F.col(key).alias("_key"), F.lit(None).cast("long").alias("_donor"), F.lit(1).alias("_asks")).unionByName(
        valued.groupBy(cell, F.col(donor_value).alias("_at")).agg(F.min(donor).cast("long").alias("_donor")).select(cell, "_at", F.lit(None).cast("long").alias("_key"), "_donor", F.lit(0).alias("_asks"))
    )
    line = in_ranges(line, [cell, "_at", "_asks", "_key"]).withColumn("_here", F.when(F.col("_asks") == 0, F.struct(F.col("_at").alias("v"), F.col("_donor").alias("d"))))
    # the outermost donors of a range stand in for those of the ranges beside it
    ends = line.groupBy(cell, RANGE).agg(F.max("_here").alias("_last"), F.min("_here").alias("_first"))
    ranges, nearest = Window.partitionBy(cell).orderBy(RANGE), Window.partitionBy(cell).orderBy(F.desc(RANGE))
    carried = [F.last(c, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)).alias(name) for c, w, name in (("_last", ranges, "_low"), ("_first", nearest, "_high"))]
    ends = ends.select(F.col(cell).alias("_cell"), F.col(RANGE).alias("_r"), *carried)
    # running values only: a frame that starts at the row would be read anew for each row
    local = Window.partitionBy(cell, RANGE)
    up, down = local.orderBy("_at", "_asks"), local.orderBy(F.desc("_at"), "_asks")
    running = lambda w: F.last("_here", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    seen = line.withColumn("_below", running(up)).withColumn("_above", running(down)).where("_asks = 1")
    seen = seen.join(ends, (F.col(RANGE) == F.col("_r")) & F.col(cell).eqNullSafe(F.col("_cell")))
    seen = seen.withColumn("_below", F.coalesce("_below", "_low")).withColumn("_above", F.coalesce("_above", "_high"))
    sides = F.array_compact(F.array(*[F.when(F.col(s).isNotNull(), F.struct(F.abs(F.col("_at") - F.col(f"{s}.v")).alias("gap"), F.col(f"{s}.d").alias("d"))) for s in ("_below", "_above")]))
    near = seen.select(F.col("_key"), F.get(F.sort_array(sides), 0)["d"].alias("_near"))
    least = donors.groupBy(F.col(cell).alias("_cell")).agg(F.min(donor).cast("long").alias("_least"))
    found = recipients.select(key, cell).join(near, F.col(key) == F.col("_key"), "left").join(least, F.col(cell) == F.col("_cell"), "left")
    return found.select(key, F.coalesce("_near", "_least").alias(donor))


def weighted_quantile(df: DataFrame, group: str, value: str, weight: str, q: float, key: str, name: str) -> DataFrame:
    """group, name: the first value, by value and key, at which the running weight reaches q of the group's total."""
    summed = running_sums(df.select(group, value, key, F.col(weight).alias("_w")), [group], [value, key], "_w", "_upto", "_total")
    reached = summed.where(F.col("_upto") >= F.lit(q) * F.col("_total"))
    return reached.groupBy(group).agg(F.min(F.struct(value, key))[value].alias(name))


#: Donors of a slice, about; there are at least as many slices as partitions.
SLICE = 1 << 16


def in_slices(donors: DataFrame, order: str = "_order") -> DataFrame:
    """donors with `order`, a hash, dealt to slices of its range (_slice) and written in buckets of slices, so that work on a
    slice moves no rows. Read once only: they are written first, if they aren't yet, to be counted."""
    held = donors if hasattr(donors, "_written_to") else written(donors)
    buckets = int(donors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bits = max(1, (max(buckets, -(-held.count() // SLICE)) - 1).bit_length())
    out = bucketed(held.withColumn("_slice", F.shiftrightunsigned(order, 64 - bits).cast("int")), "_slice", buckets, deal=True)
    discard(held)
    return out


class ForestSampler:
    """Draws whole donor rows from the leaves of a random forest (Meinshausen, 2006).

    A recipient's draw picks a tree by a hashed uniform, finds its leaf there, and takes the donor whose share of the
    leaf's weight holds a second uniform: a sample of the weighted conditional distribution that is always an observed
    row, so zeros, booleans and the joint distribution survive. Neither fitting nor drawing depends on data layout.

    Donors lie on the line of a leaf in the order of a hash of their key, and are dealt to slices of that hash once, for all
    leaves and trees. A leaf is known by its weight in each slice; a recipient finds its slice by these, goes there, and
    finds its donor among those of the slice. So a donor is never copied for a tree, and no leaf meets in a task.
    """

    def __init__(self, predictors: Sequence[str], target: str, key: str, weight: str | None = None, trees: int = 20, depth: int = 6, least: int = 5, seed: int = 20260529):
        self.predictors, self.target, self.key, self.weight = list(predictors), target, key, weight
        self.trees, self.depth, self.least, self.seed = trees, depth, least, seed

    def fit(self, donors: DataFrame, grown: Forest | None = None) -> ForestSampler:
        """grown: a forest of these donors that has been grown already, as with those of other targets; donors that
        in_slices() has dealt already stay where they are."""
        self.forest = grown or grow(donors, [Problem(self.target, tuple(self.predictors), self.seed)], self.key, self.weight, self.trees, self.depth, self.least)[0]
        weight = F.col(self.weight).cast("double") if self.weight else F.lit(1.0)
        numbers = [F.col(c).cast("double").alias(f"_at_{i}") for i, c in enumerate(self.forest.predictors)]
        rows = donors.where(F.col(self.target).isNotNull()).withColumn("_size", weight).where("_size > 0")
        own = [F.col(self.key).alias("_donor"), "_size", *numbers]
        self.dealt = "_slice" not in donors.columns
        self.rows = in_slices(rows.select(F.xxhash64(F.col(self.key).cast("string")).alias("_order"), *own)) if self.dealt else rows.select("_slice", "_order", *own)
        forest = self.forest

        def weighed(slice_: pa.Table) -> pa.Table:
            slice_, leaves = _in_order(slice_, forest)
            size, found = slice_["_size"].to_numpy(), []
            for tree in range(len(forest.feature)):
                sums = np.bincount(leaves(tree), size)
                at = np.flatnonzero(sums)
                found.append(pd.DataFrame({"_slice": slice_["_slice"][0].as_py(), "_tree": tree, "_leaf": at, "_size": sums[at]}))
            return pa.Table.from_pandas(pd.concat(found), pa.schema([("_slice", pa.int32()), ("_tree", pa.int32()), ("_leaf", pa.int32()), ("_size", pa.float64())]), preserve_index=False)

        sums = self.rows.drop("_donor").groupBy("_slice").applyInArrow(weighed, "_slice int, _tree int, _leaf int, _size double")
        of = Window.partitionBy("_tree", "_leaf")
        upto = sums.withColumn("_upto", F.sum("_size").over(of.orderBy("_slice").rowsBetween(Window.unboundedPreceding, 0)))
        self.spans = written(upto.withColumn("_total", F.max("_upto").over(of)))
        return self

    def draw(self, recipients: DataFrame, key: str, donor: str = "donor_id") -> DataFrame:
        """key, donor for each recipient: by a join on tree, leaf and the part of the leaf that the uniform falls in to the
        slice, and there by its place in the leaf's weight."""
        asked = recipients.withColumn("_u", uniform(f"{self.seed}:donor", key))
        at = leaf_in(asked, self.forest, F.floor(uniform(f"{self.seed}:tree", key) * self.trees), [key, "_u"])
        high = F.when(F.col("_upto") >= F.col("_total"), F.lit(2.0)).otherwise(F.col("_upto") / F.col("_total"))
        intervals = self.spans.select("_tree", "_leaf", "_slice", ((F.col("_upto") - F.col("_size")) / F.col("_total")).alias("low"), high.alias("high"))
        place = (F.col("_u") * F.col("_total") - (F.col("_upto") - F.col("_size"))).alias("_place")
        found = draw(at, "_u", ["_tree", "_leaf"], intervals, "_slice").join(self.spans, ["_tree", "_leaf", "_slice"], "left")
        found = written(found.select(F.col(key).alias("_key"), "_tree", "_leaf", "_slice", place))
        kinds = {"_key": found.schema["_key"].dataType, "_donor": self.rows.schema["_donor"].dataType}
        forest, schema = self.forest, to_arrow_schema(StructType([StructField(c, t) for c, t in kinds.items()]))

        def picked(slice_: pa.Table, asks: pa.Table) -> pa.Table:
            if not len(asks):
                return schema.empty_table()
            slice_, leaves = _in_order(slice_, forest)
            size, out = slice_["_size"].to_numpy(), np.zeros(len(asks), np.int64)
            trees, leaf, place = (asks[c].to_numpy() for c in ("_tree", "_leaf", "_place"))
            for tree in np.unique(trees):
                ask, at = np.flatnonzero(trees == tree), leaves(tree)
                order = np.argsort(at, kind="stable")
                upto = np.concatenate(([0.0], np.cumsum(size[order])))
                first, last = (np.searchsorted(at[order], leaf[ask], side) for side in ("left", "right"))
                out[ask] = order[np.clip(np.searchsorted(upto, upto[first] + place[ask], "right") - 1, first, last - 1)]
            return pa.table({"_key": asks["_key"], "_donor": slice_["_donor"].take(pa.array(out))}).cast(schema)

        sides = self.rows.groupBy("_slice"), found.where("_slice is not null").groupBy("_slice")
        met = sides[0].cogroup(sides[1]).applyInArrow(picked, StructType([StructField(c, t) for c, t in kinds.items()]))
        none = found.where("_slice is null").select("_key", F.lit(None).cast(kinds["_donor"]).alias("_donor"))
        return met.unionByName(none).select(F.col("_key").alias(key), F.col("_donor").alias(donor))

    def forget(self) -> None:
        """Deletes what fit() has written; draws that were not written yet are lost."""
        discard(self.spans, *[self.rows] * self.dealt)


def _in_order(slice_: pa.Table, forest: Forest) -> tuple[pa.Table, Callable[[int], np.ndarray]]:
    """Donors of a slice in the order of their hash, and the leaf of each in a tree."""
    slice_ = slice_.take(pa.array(np.argsort(slice_["_order"].to_numpy(), kind="stable")))
    bins = forest.bins(pd.DataFrame({c: slice_[f"_at_{i}"].to_numpy() for i, c in enumerate(forest.predictors)}, index=range(len(slice_))))
    return slice_, lambda tree: forest.leaves(bins, tree)


#: Values of a leaf's sketch: ranks of quantiles are off by 1 / SKETCH at most.
SKETCH = 64


def leaf_sketches(leaves: DataFrame, points: int = SKETCH) -> DataFrame:
    """_tree, _leaf, values: of leaves(_tree, _leaf, _donor, _y, _w) the weighted quantiles of _y at the middles of `points`
    equal parts, repeated values as often as they hold a middle, so always `points` values. Leaves of any size are cut into
    ranges of values."""
    summed = running_sums(leaves.where("_w > 0 and _y is not null"), ["_tree", "_leaf"], ["_y", "_donor"], "_w", "_upto", "_total")
    # middles (i + 0.5) / points below a share: the number of i that fit
    below = lambda share: F.least(F.ceil(share * points - 0.5 - 1e-9), F.lit(points)).cast("int")
    last = F.when(F.col("_upto") >= F.col("_total") * (1 - 1e-12), F.lit(points)).otherwise(below(F.col("_upto") / F.col("_total")))
    held = summed.withColumn("_n", last - F.greatest(below((F.col("_upto") - F.col("_w")) / F.col("_total")), F.lit(0))).where("_n > 0")
    lists = held.groupBy("_tree", "_leaf").agg(F.sort_array(F.collect_list(F.struct("_y", "_n"))).alias("of"))
    return lists.select("_tree", "_leaf", F.flatten(F.transform("of", lambda x: F.array_repeat(x["_y"], x["_n"]))).alias("values"))


def forest_quantiles(donors: Donors, recipients: DataFrame, key: str, target: str, predictors: Sequence[str], quantiles: Mapping[str, float], trees: int = 20, depth: int = 6, least: int = 5, seed: int = 20260529) -> DataFrame:
    """key and a column for each quantile (name -> q) of the target's conditional distribution: donors count by their share of
    weight in the recipient's leaf, averaged over the trees (Meinshausen, 2006). The rank of the value given is off by
    1 / SKETCH at most.

    A leaf is known by SKETCH values and there are trees x 2 ** depth leaves at most, whatever the number of donors, so every
    task may hold all of them, and recipients are not moved. Missing predictors count 0. Without donors: nulls.
    """
    weight = [donors.weight] if donors.weight else []
    number = lambda df: [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"_x_{c}") for c in predictors]
    given = written(donors.rows.where(F.col(target).isNotNull()).select(donors.key, *weight, F.col(target).cast("double").alias("_y"), *number(donors.rows)))
    names = tuple(f"_x_{c}" for c in predictors)
    (grown,) = grow(given, [Problem("_y", names, seed)], donors.key, donors.weight, trees, depth, least)
    w = F.col(donors.weight).cast("double") if donors.weight else F.lit(1.0)
    leaves = placed(given.withColumns({"_donor": F.col(donors.key), "_w": w}), grown, ["_donor", "_y", "_w"])
    known = {(r["_tree"], r["_leaf"]): r["values"] for r in leaf_sketches(leaves).collect()}
    discard(given)
    nodes = 2 ** (depth + 1) - 1
    held = np.full((trees, nodes, SKETCH), np.nan)
    for at, values in known.items():
        held[at] = values
    levels = list(quantiles.values())

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            bins = grown.bins(f)
            found = np.sort(np.concatenate([held[t, grown.leaves(bins, t)] for t in range(trees)], axis=1), axis=1)
            rank = [min(max(int(np.ceil(q * found.shape[1] - 1e-9)) - 1, 0), found.shape[1] - 1) for q in levels]
            yield pd.concat([f[[key]], pd.DataFrame(found[:, rank], columns=list(quantiles), index=f.index)], axis=1)

    fields = f"{key} {dict(recipients.dtypes)[key]}, " + ", ".join(f"`{n}` double" for n in quantiles)
    out = recipients.select(key, *number(recipients)).mapInPandas(run, fields)
    return out.select(key, *[F.nanvl(n, F.lit(None).cast("double")).alias(n) for n in quantiles])


@dataclass(frozen=True)
class Donors:
    """Donor rows with their key and weight columns. Weights of None count 1."""

    rows: DataFrame
    key: str
    weight: str | None = None


def forest_draws(donors: Donors, recipients: DataFrame, key: str, variables: Sequence[str], predictors: Sequence[str], trees: int = 20, depth: int = 6, least: int = 5, seed: int = 20260529) -> DataFrame:
    """key and a draw of each variable, in the order given: each has a forest of its own, fitted on the predictors and on
    the variables drawn before it, so that draws of one recipient go together. Values are donors' own, booleans too. What
    forests are fitted on is donors' own too, so they all grow together; only draws wait for each other.

    Missing predictors count 0. Each forest's draws are written, so a long list of variables makes no long plan.
    """
    names = list(dict.fromkeys([*predictors, *variables]))
    weight = [donors.weight] if donors.weight else []
    number = lambda of: [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"_x_{c}") for c in of]
    # rows that share a key are donors of their own; rows that are equal in all are told apart by nothing and needn't be
    every = F.concat_ws("-", F.col(donors.key).cast("string"), F.xxhash64(*[F.col(c) for c in (*weight, *names)]).cast("string"))
    size = F.col(donors.weight).cast("double") if donors.weight else F.lit(1.0)
    # numbers that are made of others are made anew when read
    own = [c for c in predictors if c not in variables]
    given = in_slices(donors.rows.select(F.xxhash64(every).alias("_order"), size.alias("_w"), *variables, *number(dict.fromkeys(own))))
    known = given.select("*", *[F.col(v).cast("double").alias(f"_y_{v}") for v in variables], *number(variables))
    before = [[*predictors, *variables[:k]] for k in range(len(variables))]
    problems = [Problem(f"_y_{v}", tuple(f"_x_{c}" for c in dict.fromkeys(have)), seed + k) for k, (v, have) in enumerate(zip(variables, before, strict=True))]
    forests = grow(known, problems, F.col("_order"), "_w", trees, depth, least)
    asked = recipients.select(key, *predictors)
    for v, have, problem, grown in zip(variables, before, problems, forests, strict=True):
        sampler = ForestSampler(problem.predictors, problem.target, v, "_w", trees, depth, least, problem.seed).fit(known, grown)
        drawn = sampler.draw(asked.select(key, *number(dict.fromkeys(have))), key, v)
        last, asked = asked, written(asked.drop(v).join(drawn, key, "left"))
        discard(last)
        sampler.forget()
    discard(given)
    return asked.select(key, *variables)


def forest_steps(spine: DataFrame, steps: Sequence[Step], donors: Mapping[str, Donors] | Donors, key: str, groups: Mapping[str, Sequence[str]], **forest) -> DataFrame:
    """Steps in list order, each drawn by forests from its donors (by half where a mapping is given). condition_on names
    groups of predictors; variables that the spine has come before those it lacks."""
    for step in steps:
        own = donors[step.onto] if isinstance(donors, Mapping) else donors
        predictors = list(dict.fromkeys(c for group in step.condition_on for c in groups[group]))
        ordered = spine_first(step.variables, spine.columns)
        here = spine.where(F.col("half") == step.onto)
        spine = apply_step(spine, forest_draws(own, here, key, ordered, predictors, **forest), key, step)
    return spine


def weeks_unemployed(drawn: str | Column, compensation: str | Column) -> Column:
    """Weeks as drawn, within 0 and 52, and 0 without unemployment compensation (null counts as none)."""
    pay = F.col(compensation) if isinstance(compensation, str) else compensation
    return zero_where(clipped(drawn, 0.0, 52.0), F.coalesce(pay, F.lit(0.0)) == 0)


def draw_weeks_unemployed(donors: Donors, recipients: DataFrame, key: str, weeks: str, compensation: str, predictors: Sequence[str] = (), **forest) -> DataFrame:
    """key, weeks: drawn conditional on compensation and the predictors, then held to the rule of weeks_unemployed()."""
    drawn = forest_draws(donors, recipients, key, [weeks], [compensation, *predictors], **forest)
    return drawn.join(recipients.select(key, compensation), key).select(key, weeks_unemployed(weeks, compensation).alias(weeks))


def signed_components(df: DataFrame, signs: Mapping[str, int]) -> Column:
    """Sum of components with their signs; nulls count 0."""
    total = F.lit(0)
    for name, sign in signs.items():
        total = total + F.lit(sign) * F.coalesce(F.col(name), F.lit(0))
    return total


def rebalance(components: Sequence[str], total: Column, target: str | Column) -> dict[str, Column]:
    """Components scaled so that they add up to the target; left alone where their total is 0."""
    target = F.col(target) if isinstance(target, str) else target
    factor = F.when(total != 0, target / F.when(total != 0, total)).otherwise(F.lit(1.0))
    return {c: F.coalesce(F.col(c), F.lit(0)) * factor for c in components}
