"""Benchmark decontamination on a positional inverted index, with exact phrase and proximity matches. DataFrame functions only.

Index: term -> (document, position) postings. A test phrase is matched by intersecting the postings of its
terms, each shifted back by the term's offset in the phrase, starting from the rarest terms of the corpus.
Postings are stored only for the PROBES rarest terms of each window of a test item: their intersection
leaves few places, and those are compared word by word with the document.

Document frequencies cover all documents. Test-side tables are broadcast only where they are counted and
small; else the same joins shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from popforge.llm.shared import fits, written

#: Words in a window, terms of a window whose postings are intersected, rows of a side that may be broadcast.
WINDOW, PROBES, BROADCAST_ROWS = 10, 2, 200_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: str | Column) -> Column:
    """The words of a text, A-Z folded: runs of digits, letters a-z and characters beyond ASCII. Null: none."""
    text = F.col(text) if isinstance(text, str) else text
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), _BREAKS), "")


def _side(df: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(df) if small else df


def item_words(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """item, item_id, terms, length (of its windows) for items(item_id, text) with words.

    Windows are all runs of `window` words; an item of fewer words is one window. Rows of one id and the same words
    are one; `item` tells the others apart, whatever their ids.
    """
    listed = items.select("item_id", words("text").alias("terms")).where(F.size("terms") > 0).distinct()
    return written(listed.select(F.monotonically_increasing_id().alias("item"), "item_id", "terms", F.least(F.size("terms"), F.lit(window)).alias("length")))


def probes_of(items: DataFrame, df: DataFrame, probes: int) -> DataFrame:
    """item, offset, term, need: places of an item that are among the rarest terms of one of its windows.

    Windows with a term that no document has can't occur and ask for none.
    """
    starts = F.sequence(F.lit(0), F.size("terms") - F.col("length"))
    windows = items.select("item", "length", F.explode(F.transform(starts, lambda i: F.struct(i.alias("i"), F.slice("terms", i + 1, F.col("length")).alias("terms")))).alias("w"))
    placed = windows.select("item", "length", "w.i", F.posexplode("w.terms").alias("offset", "term")).join(df, "term", "left")
    whole = Window.partitionBy("item", "i")
    ranked = placed.withColumn("rank", F.row_number().over(whole.orderBy("df", "offset"))).withColumn("known", F.count("df").over(whole))
    chosen = ranked.where((F.col("known") == F.col("length")) & (F.col("rank") <= probes))
    return chosen.select("item", (F.col("i") + F.col("offset")).alias("offset"), "term", F.least("length", F.lit(probes)).alias("need")).distinct()


def occurrences(docs: DataFrame, items: DataFrame, probes: int = PROBES) -> tuple[DataFrame, DataFrame]:
    """Exact occurrences (row, start, length, item_id) of windows of item_words() in docs(row, text), and (row, n_words).

    `row` must tell rows apart. start counts words from 0. A place is listed for each item that holds its window.
    """
    vocabulary = written(items.select(F.explode("terms").alias("term")).distinct())
    seen = docs.select(F.explode(words("text")).alias("term"))
    df = seen.join(_side(vocabulary, fits(vocabulary, BROADCAST_ROWS)), "term").groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    probing = written(probes_of(items, df, probes))
    small = fits(probing, BROADCAST_ROWS)
    # each document's word count comes with its postings, as the position of an empty term after its last word
    ends = probing.select("term").distinct().unionByName(docs.sparkSession.createDataFrame([("",)], "term string"))
    listed = docs.select("row", F.posexplode(F.concat(words("text"), F.array(F.lit("")))).alias("pos", "term"))
    index = written(listed.join(_side(ends, small), "term"))
    counts = index.where(F.col("term") == "").select("row", F.col("pos").cast("long").alias("n_words"))
    # postings shifted back by the term's offset in the item: a window's terms meet at one shift
    aligned = index.where(F.col("term") != "").join(_side(probing, small), "term").select("row", "item", "need", (F.col("pos") - F.col("offset")).alias("shift"))
    met = written(aligned.groupBy("row", "item", "shift", "need").agg(F.count(F.lit(1)).alias("n")).where("n >= need").select("row", "item", "shift"))
    # the few shifts left are compared word by word
    claims = met.join(items, "item").groupBy("row").agg(F.collect_list(F.struct("shift", "item_id", "terms", "length")).alias("claims"))
    claimed = met.select("row").distinct()
    texts = docs.join(_side(claimed, fits(claimed, BROADCAST_ROWS)), "row", "left_semi").join(claims, "row")
    each = texts.select("row", words("text").alias("w"), "claims").select("row", F.explode(F.transform("claims", lambda c: _matches("w", c))).alias("c"))
    return each.select("row", F.explode("c.starts").alias("start"), "c.length", "c.item_id"), counts


def _matches(w: str, claim: Column) -> Column:
    terms, length, shift = claim["terms"], claim["length"], claim["shift"]
    same = F.transform(terms, lambda t, j: F.coalesce(F.get(w, shift + j) == t, F.lit(False)))
    starts = F.filter(F.sequence(F.lit(0), F.size(terms) - length), lambda s: F.forall(F.slice(same, s + 1, length), lambda x: x))
    return F.struct(F.transform(starts, lambda s: shift + s).alias("starts"), length.alias("length"), claim["item_id"].alias("item_id"))


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, a row for each row of docs(doc_id, text).

    Null or empty texts have no words; rows that share an id are kept apart by their text, and rows that are
    the same throughout are answered alike, one row each; no items: nothing is hit. Items without an id count as one
    in n_items, as in the SQL, and have no name in items_sha256.
    """
    texts = docs.select(F.struct("doc_id", F.xxhash64("text").alias("h")).alias("row"), "text")
    hits, counts = occurrences(texts, item_words(items, window))
    hits = written(hits)
    covered = hits.groupBy("row").agg(F.size(F.array_distinct(F.flatten(F.collect_list(F.sequence("start", F.col("start") + F.col("length") - 1))))).cast("long").alias("n_hit"))
    named = hits.select("row", F.col("item_id").cast("string").alias("item")).distinct()
    named = named.groupBy("row").agg(F.count(F.lit(1)).alias("n_items"), F.sort_array(F.collect_list("item")).alias("items"))
    found = covered.join(named, "row")
    empty = F.lit(0).cast("long")
    return (
        counts.join(found, "row", "left")
        .select("row.doc_id", "n_words", F.coalesce("n_hit", empty).alias("n_hit"), F.coalesce("n_items", empty).alias("n_items"), F.sha2(F.coalesce(F.concat_ws(",", "items"), F.lit("")), 256).alias("items_sha256"))
        .withColumn("contaminated", F.col("n_hit") > 0)
    )


def uncontaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of docs, all columns kept, that hold no window of an item."""
    row = F.struct("doc_id", F.xxhash64("text").alias("h"))
    hits, _ = occurrences(docs.select(row.alias("row"), "text"), item_words(items, window))
    hit = written(hits.select("row").distinct())
    kept = docs.select(F.struct("*").alias("doc"), row.alias("row")).join(_side(hit, fits(hit, BROADCAST_ROWS)), "row", "left_anti")
    return kept.select("doc.*")


def proximity(docs: DataFrame, phrase: list[str], slop: int) -> DataFrame:
    """doc_id, start, end: places where every distinct term of the phrase occurs within len(terms) + slop words; end is the
    first place by which all have been met. Terms are matched as `words` makes them.

    Postings of all terms are counted over the corpus; only those within reach of a posting of the rarest one, on either
    side, are looked at further. Rows of one id are kept apart by their text; a term that no document has gives no rows.
    """
    distinct = sorted(set(phrase))
    nothing = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(0).alias("start"), F.lit(0).alias("end")).limit(0)
    if not distinct:
        return nothing
    span = len(distinct) + slop
    row = F.struct("doc_id", F.xxhash64("text").alias("h")).alias("row")
    listed = written(docs.select(row, F.posexplode(words("text")).alias("pos", "term")).where(F.col("term").isin(distinct)))
    counts = {r["term"]: r["count"] for r in listed.groupBy("term").count().collect()}
    if len(counts) < len(distinct):
        return nothing
    rarest = F.when(F.col("term") == min(distinct, key=lambda t: (counts[t], t)), F.col("pos"))
    reached = lambda order: F.last(rarest, ignorenulls=True).over(Window.partitionBy("row").orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    beside = listed.withColumns({"before": reached(F.col("pos")), "after": reached(F.desc("pos"))})
    beside = beside.where((F.col("pos") - F.col("before") < span) | (F.col("after") - F.col("pos") < span))
    near = Window.partitionBy("row").orderBy("pos").rangeBetween(0, span - 1)
    found = beside.withColumn("n", F.size(F.collect_set("term").over(near))).withColumn("last", F.collect_list(F.struct("pos", "term")).over(near))
    ends = F.array_max(F.transform(F.array(*[F.lit(t) for t in distinct]), lambda t: F.array_min(F.transform(F.filter("last", lambda p: p["term"] == t), lambda p: p["pos"]))))
    return found.where(F.col("n") == len(distinct)).select(F.col("row.doc_id").cast("long").alias("doc_id"), F.col("pos").alias("start"), ends.alias("end"))
