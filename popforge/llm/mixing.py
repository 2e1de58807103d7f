"""Mixing sources to target weights by hash-threshold histograms. DataFrame functions only.

A source's target is met by whole copies of all its documents plus one more copy of those whose id hash
lies under a threshold. Thresholds are nested: a larger target only adds documents. They are found without
sorting documents: word sums by source and hash bucket give the bucket that the budget ends in, only that
bucket's documents are summed again by the next hash bits, and so on to single hashes; then one filter
decides every document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from popforge.llm.shared import written

#: Hash bits in all, and those that one histogram resolves.
HASH_BITS, STEP_BITS = 60, 12
WEIGHTS = (3.0, 1.0, 2.0)


def word_count(text: str | Column) -> Column:
    """Runs of characters other than space and \\t\\n\\v\\f\\r; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def id_hash(doc_id: str) -> Column:
    """60 bits of the md5 of the id as text (null ids: of the empty text)."""
    return F.conv(F.substring(F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 1, HASH_BITS // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...], total_share: float, cap: float) -> DataFrame:
    """key, source_size, target: weights dealt over sources by code point, null last, repeating; targets share
    total_share of all sizes, none above cap times its source's size, the excess reshared by weight.

    Water filling in closed form: with sources by rising cap/weight, the first k are capped, the others get
    weight x level, where k is the smallest for which the level fits under the next cap. One row a source.
    """
    per = sizes.groupBy("key", "source").agg(F.sum("size").alias("source_size"))
    ordered = per.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    capped = ordered.select("key", "source_size", weight.alias("weight"), (F.lit(float(cap)) * F.col("source_size")).alias("most"), "rank").withColumn("fill", F.col("most") / F.col("weight"))
    every, rising = Window.partitionBy(), Window.orderBy("fill", "rank")
    before, after = rising.rowsBetween(Window.unboundedPreceding, -1), rising.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.lit(float(total_share)) * F.sum("source_size").over(every) - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    leveled = capped.withColumn("level", level)
    final = F.min(F.when(F.col("level") <= F.col("fill"), F.struct("fill", "rank", "level"))).over(every)["level"]
    return leveled.withColumn("final", final).select("key", "source_size", F.least("most", F.coalesce(F.col("weight") * F.col("final"), "most")).alias("target"))


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, total_share: float = 1.5, cap: float = 2.0, words: Column | None = None, keep: list[str] | None = None) -> DataFrame:
    """docs(doc_id, source, text) -> doc_id, size, source_size, target, copies, taken, with the columns named in keep.

    Null texts have size 0; a null source is a source; rows of one id are taken alike; no rows: none.
    Each source takes its target to within half of its boundary document's size.
    """
    extra = [F.col(f"`{c}`").alias(f"_keep_{c}") for c in keep or []]
    sized = docs.select("doc_id", "source", F.concat(F.lit("="), F.coalesce("source", F.lit("")), F.col("source").isNull().cast("string")).alias("key"), (word_count("text") if words is None else words).alias("size"), id_hash("doc_id").alias("hash"), *extra)
    slim = written(sized) if not extra else sized
    base = slim if not extra else written(sized.select("key", "source", "size", "hash"))
    targets = written(source_targets(base.select("key", "source", "size"), weights, total_share, cap))
    # the budget beyond whole copies
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    budget = targets.select("key", whole.alias("whole"), (F.col("target") - whole * F.col("source_size")).alias("budget"))
    bounds = budget.select("key", "budget", F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("done"))
    for bits in range(STEP_BITS, HASH_BITS + 1, STEP_BITS):
        shift = HASH_BITS - bits
        inside = base.join(bounds.select("key", "prefix"), "key").where(F.shiftright("hash", shift + STEP_BITS) == F.col("prefix"))
        sums = inside.groupBy("key", F.shiftright("hash", shift).alias("bucket")).agg(F.sum("size").alias("n"))
        running = F.sum("n").over(Window.partitionBy("key").orderBy("bucket"))
        reached = sums.join(bounds, "key").withColumn("upto", F.col("done") + running)
        # the first bucket that reaches the budget
        first = reached.where(F.col("upto") >= F.col("budget")).groupBy("key").agg(F.min(F.struct("bucket", "n", "upto")).alias("b"))
        bounds = written(bounds.select("key", "budget").join(first, "key").select("key", "budget", F.col("b.bucket").alias("prefix"), (F.col("b.upto") - F.col("b.n")).alias("done"), F.col("b.upto").alias("upto")))
    edge = bounds.select("key", F.col("prefix").alias("edge"), ((F.col("done") + F.col("upto")) < 2 * F.col("budget")).alias("edge_in"))
    plan = targets.join(budget.select("key", "whole"), "key").join(edge, "key", "left")
    more = (F.col("hash") < F.col("edge")) | ((F.col("hash") == F.col("edge")) & F.col("edge_in"))
    copies = F.col("whole") + F.when(more, 1).otherwise(0)
    out = slim.join(plan, "key").withColumn("copies", copies).withColumn("taken", F.col("size") * F.col("copies"))
    return out.select("doc_id", "size", "source_size", "target", "copies", "taken", *[F.col(f"_keep_{c}").alias(c) for c in keep or []])
