"""Weights calibrated to aggregate targets: sparse coefficients, bucketed Huber loss, accelerated projected gradient."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from popforge.functions.rng import uniform
from popforge.sources.storage import bucketed, discard, fits, written


def loss_matrix(units: DataFrame, key: str, cells: dict[str, tuple[Column, Column]]) -> DataFrame:
    """target_id, unit, coef in sparse long form: each entry of cells (name -> (target id, coefficient)) gives a unit
    one coefficient; zeros and null targets are left out."""
    rows = F.array(*[F.struct(F.concat_ws("/", F.lit(name), target.cast("string")).alias("target_id"), coef.cast("double").alias("coef"), target.isNull().alias("none")) for name, (target, coef) in cells.items()])
    long = units.select(F.col(key).alias("unit"), F.explode(rows).alias("r"))
    return long.where("r.coef <> 0 and not r.none").select("r.target_id", "unit", "r.coef")


def estimates(matrix: DataFrame, weights: DataFrame) -> DataFrame:
    """target_id, estimate from matrix(target_id, unit, coef) and weights(unit, w)."""
    return matrix.join(weights, "unit").groupBy("target_id").agg(F.sum(F.col("coef") * F.col("w")).alias("estimate"))


def relative_error(estimate: Column, target: Column) -> Column:
    """(estimate - target) / |target|; null for a target of 0."""
    return (estimate - target) / F.nullif(F.abs(target), F.lit(0.0))


def huber(residual: Column, delta: float) -> Column:
    a = F.abs(residual)
    return F.when(a <= delta, 0.5 * residual * residual).otherwise(F.lit(delta) * (a - delta / 2))


def huber_slope(residual: Column, delta: float) -> Column:
    return F.greatest(F.lit(-delta), F.least(F.lit(delta), residual))


def bucketed_loss(scored: DataFrame, bucket: str, delta: float) -> DataFrame:
    """bucket, n_targets, loss: mean Huber loss of scored(bucket, residual) by bucket; null residuals don't count."""
    return scored.where("residual is not null").groupBy(bucket).agg(F.count(F.lit(1)).alias("n_targets"), F.avg(huber(F.col("residual"), delta)).alias("loss"))


def msre(scored: DataFrame) -> DataFrame:
    return scored.agg(F.avg(F.pow("residual", F.lit(2))).alias("msre"))


def losses_by_split(scored: DataFrame, split: str) -> DataFrame:
    """split, n_targets, loss: sum of squared relative errors of scored(split, residual) by split; null residuals count 0."""
    return scored.groupBy(split).agg(F.count(F.lit(1)).alias("n_targets"), F.sum(F.col("residual") * F.col("residual")).alias("loss"))


def select_targets(targets: DataFrame, country: str, model_year: int, profile: str, scope: str = "all", state: str | None = None) -> DataFrame:
    """Targets of targets(target_id, country, model_year, profile, geo_level, state_fips, ...) that a run asks for: scope
    "all", "national" or "state". A state, where it is given, leaves other states' targets out and national ones in."""
    if scope not in ("all", "national", "state"):
        raise ValueError(f"unknown scope {scope!r}")
    found = targets.where((F.col("country") == country) & (F.col("model_year") == model_year) & (F.col("profile") == profile))
    if scope != "all":
        found = found.where(F.col("geo_level") == scope)
    return found.where((F.col("state_fips") == state) | (F.col("geo_level") == "national")) if state is not None else found


def target_counts(cells: DataFrame, levels: Sequence[str]) -> DataFrame:
    """levels, n: rows of each cell and of each total over the later levels."""
    return cells.rollup(*levels).agg(F.count(F.lit(1)).alias("n"))


def holdout(name: str | Column, fraction: float, seed: int) -> Column:
    """Whether a target is held out, by a seeded draw on its name."""
    return uniform(seed, name) < fraction


def matched_sample(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """A uniform sample of n rows: those with the smallest hashes of their key. Rows beyond a threshold that surely leaves
    enough are filtered first, so that partitions don't send n rows each."""
    drawn = df.withColumn("_u", uniform(seed, key))
    total = df.count()
    threshold = (n + 8 * n**0.5 + 20) / max(total, 1)
    if threshold < 1 and drawn.where(F.col("_u") < threshold).count() >= n:
        drawn = drawn.where(F.col("_u") < threshold)
    return drawn.orderBy("_u", key).limit(n).drop("_u")


def preserve_total(weights: DataFrame, before: DataFrame) -> DataFrame:
    """Weights scaled back to the total they had; all zeros stay zeros."""
    totals = weights.agg(F.sum("w").alias("now")).crossJoin(before.agg(F.sum("w").alias("then")))
    scale = F.when(F.col("now") > 0, F.col("then") / F.when(F.col("now") > 0, F.col("now"))).otherwise(F.lit(1.0))
    return weights.crossJoin(F.broadcast(totals)).select("unit", (F.col("w") * scale).alias("w"))


def simplex_projection(weights: DataFrame, total: float, bins: int = 1024, rounds: int = 8) -> DataFrame:
    """The nearest non-negative weights with a given total: w - t clipped at 0.

    t is found by histograms: counts and sums of weights by bin tell which bin it lies in, and only that bin is cut again,
    until it holds no weight that could matter. Nothing is sorted or gathered, and few passes are made.
    """
    n, low, high = weights.agg(F.count(F.lit(1)), F.min("w"), F.max("w")).first()
    if not n:
        return weights
    low, high = low - total / n, high + max(abs(high), 1.0) * 1e-12
    more, above = 0, 0.0  # weights of high or more: their number and sum
    for _ in range(rounds):
        width = (high - low) / bins
        place = F.least(F.floor((F.col("w") - low) / width), F.lit(bins - 1)).cast("int")
        found = weights.where((F.col("w") >= low) & (F.col("w") < high)).groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.sum("w").alias("s"))
        cells = {r.bin: (r.n, r.s) for r in found.collect()}
        for k in range(bins - 1, -1, -1):
            n_bin, s_bin = cells.get(k, (0, 0.0))
            edge = low + k * width
            if k == 0 or above + s_bin - (more + n_bin) * edge >= total:
                break
            more, above = more + n_bin, above + s_bin
        low, high = edge, edge + width
        if not n_bin or width <= 1e-15 * max(abs(low), abs(high)):
            break
    t = (above - total) / more if more else low
    return weights.select("unit", F.greatest(F.col("w") - F.lit(float(t)), F.lit(0.0)).alias("w"))


#: Targets whose pulls every task may hold, and units of a bucket, at most.
MOST_TARGETS, BUCKET_UNITS = 100_000, 1_000_000


@dataclass(frozen=True)
class Settings:
    """Calibration parameters. Gates, L0 penalties, rescoring by a model and skipped targets are not supported and refused."""

    max_iter: int = 200
    tol: float = 1e-8
    delta: float = 1.0
    lambda_l2: float = 0.0
    lambda_l0: float = 0.0
    use_gates: bool = False
    projection: str = "rescale"
    power_rounds: int = 6
    exact_rescore: bool = False
    skip_tax_expenditure_targets: bool = False

    def __post_init__(self):
        asked = [name for name in ("lambda_l0", "use_gates", "exact_rescore", "skip_tax_expenditure_targets") if getattr(self, name)]
        if asked:
            raise ValueError(f"not supported: {', '.join(asked)}")
        if self.projection not in ("rescale", "simplex"):
            raise ValueError(f"unknown projection {self.projection!r}")


def _scored(matrix: DataFrame, weights: DataFrame, targets: DataFrame) -> DataFrame:
    """targets with estimates and residuals, relative errors."""
    found = targets.join(estimates(matrix, weights), "target_id", "left")
    return found.withColumn("residual", relative_error(F.coalesce("estimate", F.lit(0.0)), F.col("value")))


def total_loss(scored: DataFrame, delta: float) -> float:
    return bucketed_loss(scored, "bucket", delta).agg(F.coalesce(F.sum("loss"), F.lit(0.0))).first()[0]


def gradient(matrix: DataFrame, weights: DataFrame, targets: DataFrame, delta: float, few: bool = False) -> DataFrame:
    """unit, g: gradient of the sum over buckets of mean Huber losses of relative errors. few: the targets are known to be
    few enough for every task to hold."""
    scored = _scored(matrix, weights, targets).where("residual is not null")
    sizes = scored.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    pull = scored.join(sizes, "bucket").select("target_id", (huber_slope(F.col("residual"), delta) / (F.abs(F.col("value")) * F.col("n"))).alias("pull"))
    return matrix.join(F.broadcast(pull) if few else pull, "target_id").groupBy("unit").agg(F.sum(F.col("coef") * F.col("pull")).alias("g"))


def step(weights: DataFrame, slopes: DataFrame, size: float) -> DataFrame:
    """One projected step: w - size * g, not below 0."""
    moved = F.col("w") - F.lit(size) * F.coalesce("g", F.lit(0.0))
    return weights.join(slopes, "unit", "left").select("unit", F.greatest(moved, F.lit(0.0)).alias("w"))


def curvature(matrix: DataFrame, targets: DataFrame, rounds: int, buckets: int | None = None, few: bool = False) -> float:
    """Largest eigenvalue of the quadratic part, by power iteration. buckets: those of units that the matrix lies in."""
    sizes = targets.where("value <> 0").groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    scaled = targets.where("value <> 0").join(sizes, "bucket").select("target_id", (F.lit(1.0) / (F.col("value") * F.col("value") * F.col("n"))).alias("s"))
    vector, value = matrix.select("unit").distinct().withColumn("w", F.lit(1.0)), 0.0
    for _ in range(rounds):
        pull = estimates(matrix, vector).join(scaled, "target_id").select("target_id", (F.col("estimate") * F.col("s")).alias("e"))
        image = matrix.join(F.broadcast(pull) if few else pull, "target_id").groupBy("unit").agg(F.sum(F.col("coef") * F.col("e")).alias("w"))
        image = bucketed(image, "unit", buckets) if buckets else written(image)
        norm = image.agg(F.sqrt(F.sum(F.col("w") * F.col("w")))).first()[0] or 0.0
        if not norm:
            return 0.0
        before = vector.agg(F.sqrt(F.sum(F.col("w") * F.col("w")))).first()[0]
        value, vector = norm / before, image.select("unit", (F.col("w") / norm).alias("w"))
    return value


def calibrate(matrix: DataFrame, weights: DataFrame, targets: DataFrame, settings: Settings = Settings()) -> tuple[DataFrame, list[float]]:
    """Monotone accelerated projected gradient (Beck and Teboulle, 2009) on weights(unit, w) against
    targets(target_id, bucket, value). Returns weights and the loss after each accepted iteration, never rising.

    The matrix stays sparse. It and all weights lie in the same buckets of units, so that an iteration joins and groups by
    unit without moving a row; what moves is the sums by target, and the targets' pulls to every task where they are
    MOST_TARGETS at most. Each iteration writes the unit weights to the shared folder.
    """
    targets, few = written(targets), fits(targets, MOST_TARGETS)
    # read in every iteration
    buckets = max(int(matrix.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-weights.count() // BUCKET_UNITS))
    matrix, weights = bucketed(matrix, "unit", buckets, deal=True), bucketed(weights, "unit", buckets, deal=True)
    total = weights.agg(F.sum("w")).first()[0] or 0.0
    bound = curvature(matrix, targets, settings.power_rounds, buckets, few) + settings.lambda_l2

    def project(w: DataFrame) -> DataFrame:
        return simplex_projection(w, total) if settings.projection == "simplex" else preserve_total(w, weights)

    def loss_of(w: DataFrame) -> float:
        extra = settings.lambda_l2 / 2 * (w.agg(F.sum(F.col("w") * F.col("w"))).first()[0] or 0.0) if settings.lambda_l2 else 0.0
        return total_loss(_scored(matrix, w, targets), settings.delta) + extra

    now, ahead, momentum = weights, weights, 1.0
    losses = [loss_of(now)]
    size = 1.0 / bound if bound else 0.0
    for _ in range(settings.max_iter if bound else 0):
        slopes = gradient(matrix, ahead, targets, settings.delta, few)
        if settings.lambda_l2:
            slopes = ahead.join(slopes, "unit", "left").select("unit", (F.coalesce("g", F.lit(0.0)) + settings.lambda_l2 * F.col("w")).alias("g"))
        new = bucketed(project(step(ahead, slopes, size)), "unit", buckets)
        loss = loss_of(new)
        if loss > losses[-1]:
            if momentum == 1.0:  # a plain step that rises: too long
                size /= 2
                if size < 1e-12 / bound:
                    break
            discard(new, *([ahead] if ahead is not now else []))
            ahead, momentum = now, 1.0
            continue
        following = (1 + (1 + 4 * momentum**2) ** 0.5) / 2
        pace = (momentum - 1) / following
        old = [x for x in (ahead, now) if x is not weights]
        ahead = bucketed(new.join(now.withColumnRenamed("w", "old"), "unit").select("unit", F.greatest(F.col("w") + F.lit(pace) * (F.col("w") - F.col("old")), F.lit(0.0)).alias("w")), "unit", buckets)
        discard(*old)
        now, momentum = new, following
        losses.append(loss)
        if losses[-2] - loss <= settings.tol * max(losses[-2], 1e-300):
            break
    return now, losses
