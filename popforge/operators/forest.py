"""Regression forests grown level by level from histograms, the same whatever the layout of the data.

Every random choice comes from hashed keys: how often a tree sees a donor (Poisson counts in place of a bootstrap), and which
predictors a node may split on. Each level is one Spark job: tasks add up weights, sums and counts by tree, node,
predictor and bin, and the best cut of each node is chosen from the sums. Forests of many targets grow together, since what
they are fitted on is known beforehand: they share the jobs. Through the driver go candidate thresholds from a bounded
sample, and the cuts: targets x trees x nodes numbers. Gains are compared to nine digits, so the order of adding does not
show; equal gains go to the first predictor and lowest cut.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Donors whose values candidate thresholds come from, about, the most thresholds of a predictor, and the sums that a task
#: holds at a time; targets beyond these wait for the next job.
SAMPLE, CUTS, CELLS = 10_000, 31, 4_000_000
#: Chances that a Poisson count of mean 1 is at most 0, 1, 2, ...
_POISSON = np.cumsum([1 / np.e / f for f in (1, 1, 2, 6, 24, 120, 720)])


def _mixed(x: np.ndarray) -> np.ndarray:
    """Scrambled 64-bit values."""
    x = x.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _counts(hashes: np.ndarray, tree: int) -> np.ndarray:
    """How often a tree sees each donor, by the donor's hash."""
    with np.errstate(over="ignore"):
        u = _mixed(hashes.view(np.uint64) ^ _mixed(np.full(1, tree, np.uint64))) / 2.0**64
    return np.searchsorted(_POISSON, u, side="right")


def _allowed(tree: int, node: int, n: int, seed: int) -> np.ndarray:
    """A third of the predictors, one at least, by hashes of tree, node and predictor."""
    with np.errstate(over="ignore"):
        order = np.argsort(_mixed(np.arange(n, dtype=np.uint64) + _mixed(np.full(1, seed * 1_000_003 + tree * 65_537 + node, np.uint64))), kind="stable")
    return np.sort(order[: -(-n // 3)])


@dataclass(frozen=True)
class Forest:
    """predictors with their thresholds; for each tree and node (children of k: 2k + 1 and 2k + 2) the predictor that it is
    split on, -1 in a leaf, and the cut: bins up to it go left. A missing value goes with the largest."""

    predictors: tuple[str, ...]
    thresholds: tuple[np.ndarray, ...]
    feature: np.ndarray
    cut: np.ndarray
    depth: int

    def bins(self, frame: pd.DataFrame) -> np.ndarray:
        return np.column_stack([np.searchsorted(t, frame[c].to_numpy(float), side="left") for c, t in zip(self.predictors, self.thresholds, strict=True)] or [np.empty((len(frame), 0), np.int64)])

    def leaves(self, bins: np.ndarray, tree: np.ndarray | int) -> np.ndarray:
        """The node where each row ends in its tree."""
        at, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
        for _ in range(self.depth):
            f = self.feature[tree, at]
            inner = f >= 0
            if not inner.any():
                break
            right = bins[rows, np.maximum(f, 0)] > self.cut[tree, at]
            at = np.where(inner, 2 * at + 1 + right, at)
        return at


def _thresholds(sample: np.ndarray) -> np.ndarray:
    """Values between the distinct ones, at most CUTS of them, at quantiles."""
    values = np.unique(sample[~np.isnan(sample)])
    if len(values) > CUTS + 1:
        values = np.unique(np.quantile(sample[~np.isnan(sample)], np.linspace(0, 1, CUTS + 2)[1:-1], method="lower"))
        return values
    return values[:-1]


@dataclass(frozen=True)
class Problem:
    """A target and what it is predicted from."""

    target: str
    predictors: tuple[str, ...]
    seed: int


def grow(donors: DataFrame, problems: Sequence[Problem], key: str | Column, weight: str | None, trees: int, depth: int, least: int) -> list[Forest]:
    """A forest for each problem on donors(key, weight, targets, predictors), all numbers but the key, or a hash of it in its
    place (a Column). Donors with a null target or without weight are not seen by its forest. Without donors or predictors each tree is one leaf."""
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    names = list(dict.fromkeys(c for p in problems for c in (*p.predictors, p.target)))
    at = {c: f"x{i}" for i, c in enumerate(names)}
    hashed = F.xxhash64(F.col(key).cast("string")) if isinstance(key, str) else key
    seen = donors.select(hashed.alias("hash"), w.alias("w"), *[F.col(c).cast("double").alias(x) for c, x in at.items()]).where("w > 0")
    n = seen.count()
    rate = (SAMPLE + 8 * SAMPLE**0.5) / max(n, 1)
    few = seen if rate >= 1 else seen.where(F.xxhash64("hash") < F.lit(int(rate * 2.0**64) - (1 << 63)))
    sample = few.select(*at.values()).limit(2 * SAMPLE).toPandas()
    cuts = {c: _thresholds(sample[x].to_numpy(float)) for c, x in at.items()}
    nodes = 2 ** (depth + 1) - 1
    forests = [Forest(tuple(at[c] for c in p.predictors), tuple(cuts[c] for c in p.predictors), np.full((trees, nodes), -1, np.int16), np.zeros((trees, nodes), np.int16), depth) for p in problems]
    for level in range(depth if n else 0):
        first, upto = 2**level - 1, 2 ** (level + 1) - 1
        growing = [k for k, f in enumerate(forests) if f.predictors and (not level or (f.feature[:, (first - 1) // 2 : first] >= 0).any())]
        while growing:
            size, now = 0, []
            while growing and (not now or size + trees * (upto - first) * len(forests[growing[0]].predictors) * (CUTS + 1) <= CELLS):
                size += trees * (upto - first) * len(forests[growing[0]].predictors) * (CUTS + 1)
                now.append(growing.pop(0))
            own = [(k, forests[k], at[problems[k].target], problems[k].seed) for k in now]
            needed = dict.fromkeys(["hash", "w", *[c for _, f, y, _ in own for c in (*f.predictors, y)]])
            sums = seen.select(*needed).mapInPandas(_histograms(own, first, upto), "problem int, tree int, node int, feature int, bin int, w double, wy double, n long")
            sums = sums.groupBy("problem", "tree", "node", "feature", "bin").agg(F.sum("w").alias("w"), F.sum("wy").alias("wy"), F.sum("n").alias("n"))
            best = sums.groupBy("problem", "tree").applyInPandas(_best({k: (len(f.predictors), seed) for k, f, _, seed in own}, least), "problem int, tree int, node int, feature int, cut int")
            for r in best.collect():
                forests[r.problem].feature[r.tree, r.node], forests[r.problem].cut[r.tree, r.node] = r.feature, r.cut
    return [Forest(p.predictors, f.thresholds, f.feature, f.cut, depth) for p, f in zip(problems, forests, strict=True)]


def _histograms(own: list[tuple[int, Forest, str, int]], first: int, upto: int):
    """Sums by problem, tree, node of the level, predictor and bin, added up over a task's rows."""
    width = CUTS + 1

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals = {k: np.zeros((3, len(f.feature) * (upto - first) * len(f.predictors) * width)) for k, f, _, _ in own}
        for frame in frames:
            w, hashes = frame["w"].to_numpy(), frame["hash"].to_numpy()
            for k, forest, target, seed in own:
                y = frame[target].to_numpy(float)
                bins, known, trees = forest.bins(frame), ~np.isnan(y), len(forest.feature)
                for tree in range(trees):
                    times, at = _counts(hashes, seed * 1_000_003 + tree), forest.leaves(bins, tree)
                    rows = np.flatnonzero(known & (times > 0) & (at >= first))
                    weight = w[rows] * times[rows]
                    for j in range(len(forest.predictors)):
                        cell = ((tree * (upto - first) + at[rows] - first) * len(forest.predictors) + j) * width + bins[rows, j]
                        for total, values in zip(totals[k], (weight, weight * y[rows], np.ones(len(rows))), strict=True):
                            np.add.at(total, cell, values)
        for k, forest, _, _ in own:
            at = np.flatnonzero(totals[k][2])
            rest, b = np.divmod(at, width)
            rest, j = np.divmod(rest, len(forest.predictors))
            tree, node = np.divmod(rest, upto - first)
            w, wy, n = totals[k][:, at]
            small = {"problem": np.full(len(at), k), "tree": tree, "node": node + first, "feature": j, "bin": b}
            yield pd.DataFrame({c: v.astype(np.int32) for c, v in small.items()} | {"w": w, "wy": wy, "n": n.astype(np.int64)})

    return run


def _best(of: dict[int, tuple[int, int]], least: int):
    """The cut of each node of a tree that lowers the squared error most, if any does and leaves enough donors on both sides."""

    def run(f: pd.DataFrame) -> pd.DataFrame:
        out = []
        problem, tree = int(f["problem"].iloc[0]), int(f["tree"].iloc[0])
        n_features, seed = of[problem]
        for node, own in f.groupby("node", sort=True):
            best = None
            for k in _allowed(tree, int(node), n_features, seed):
                h = own[own["feature"] == k].sort_values("bin")
                w, s, n = (np.cumsum(h[c].to_numpy(float)) for c in ("w", "wy", "n"))
                if len(h) < 2:
                    continue
                fits = (n[:-1] >= least) & (n[-1] - n[:-1] >= least)
                gain = s[:-1] ** 2 / w[:-1] + (s[-1] - s[:-1]) ** 2 / (w[-1] - w[:-1]) - s[-1] ** 2 / w[-1]
                floor = 1e-9 * max(abs(s[-1] ** 2 / w[-1]), 1e-300)
                for at in np.flatnonzero(fits & (gain > floor)).tolist():
                    told = float(f"{gain[at]:.9g}")
                    if best is None or told > best[0]:
                        best = (told, int(k), int(h["bin"].iloc[at]))
            if best is not None:
                out.append((problem, tree, int(node), best[1], best[2]))
        return pd.DataFrame(out, columns=["problem", "tree", "node", "feature", "cut"]).astype("int32")

    return run


def placed(rows: DataFrame, forest: Forest, keep: Sequence[str]) -> DataFrame:
    """keep, _tree, _leaf: the leaf of every row in every tree."""
    fields = ", ".join(f"{c} {t}" for c, t in rows.select(*keep).dtypes)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            bins = forest.bins(f)
            for tree in range(len(forest.feature)):
                yield f[list(keep)].assign(_tree=np.int32(tree), _leaf=forest.leaves(bins, tree).astype(np.int32))

    return rows.select(*keep, *_numbers(forest, keep)).mapInPandas(run, f"{fields}, _tree int, _leaf int")


def leaf_in(rows: DataFrame, forest: Forest, tree: Column, keep: Sequence[str]) -> DataFrame:
    """keep, _tree, _leaf: the leaf of each row in its own tree."""
    fields = ", ".join(f"{c} {t}" for c, t in rows.select(*keep).dtypes)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            of = f["_tree"].to_numpy()
            yield f[[*keep, "_tree"]].assign(_leaf=forest.leaves(forest.bins(f), of).astype(np.int32))

    return rows.select(*keep, tree.cast("int").alias("_tree"), *_numbers(forest, keep)).mapInPandas(run, f"{fields}, _tree int, _leaf int")


def _numbers(forest: Forest, keep: Sequence[str]) -> list[Column]:
    return [F.col(c).cast("double").alias(c) for c in forest.predictors if c not in keep]
