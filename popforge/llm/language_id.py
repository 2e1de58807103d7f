"""Language identification with error-correcting output codes.

Each language has a codeword of bits. For each bit a naive-Bayes classifier over hashed byte n-grams
(pairs and triples, A-Z folded) separates the languages whose bit is 1 from the others. A document's
evidence for a bit is its mean log-likelihood ratio a gram. Decoding is loss-weighted: each bit's logistic
loss counts by how clearly the counted languages lie on their sides of that bit, and the language with the
smallest loss wins. A document whose two best codewords are close is flagged ambiguous.

n-gram counts cover all training documents and any number of labels: Spark sums them by label and bucket, then
by bit and bucket. The driver gets the labels and BUCKETS numbers a bit, and bits grow with the labels' logarithm.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popforge.llm.shared import crc_mod, map_rows, mapped, written
from popforge.llm.textarrays import chunks, joined

#: n-gram hash buckets; the model is this many numbers a code bit.
BUCKETS = 1 << 14
#: Labels whose counts a task holds at a time, and text bytes it works on at a time.
HELD_LANGUAGES, CHUNK = 64, 1 << 18
SHARPNESS = 40.0
AMBIGUOUS = 0.6
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")
_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[65:91] = _FOLD[97:123]


def gram_buckets(buf: np.ndarray) -> np.ndarray:
    """Buckets of the byte pair and the byte triple at each place; gram i of the result starts at byte i // 2."""
    b = _FOLD[buf]
    pair = (b[:-1] << np.uint32(8)) | b[1:]
    triple = (pair[:-1] << np.uint32(8)) | b[2:]
    out = np.empty((len(triple), 2), np.uint32)
    shift = np.uint32(32 - 14)
    out[:, 0] = (pair[:-1] + np.uint32(1 << 24)) * np.uint32(2654435761) >> shift
    out[:, 1] = triple * np.uint32(2246822519) >> shift
    return out


def codewords(n: int) -> np.ndarray:
    """n rows of +1 and -1: all two-way splits of up to 5 languages, else rows of well separated random bits."""
    if n <= 1:
        return np.ones((n, 1))
    if n <= 5:
        bits = 2 ** (n - 1) - 1
        columns = np.arange(1, bits + 1)
        return np.array([np.ones(bits)] + [1.0 - 2.0 * (columns >> k & 1) for k in range(n - 1)])
    rng, width = np.random.default_rng(7), 4 * int(np.ceil(np.log2(n))) + 7
    tries = [np.where(rng.random((n, width)) < 0.5, -1.0, 1.0) for _ in range(50)]
    tries = [t for t in tries if (np.abs(t.sum(0)) < n).all()] or tries
    return max(tries, key=lambda t: (t @ t.T - 2 * width * np.eye(n)).max() * -1)


def _counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    totals: dict[str, np.ndarray] = {}

    def flush() -> Iterator[pd.DataFrame]:
        for lang, total in totals.items():
            at = np.flatnonzero(total)
            yield pd.DataFrame({"lang": lang, "bucket": at, "n": total[at]})
        totals.clear()

    for pdf in batches:
        for lang, part in pdf.groupby("lang", sort=False):
            if lang not in totals and len(totals) >= HELD_LANGUAGES:
                yield from flush()
            total = totals.setdefault(lang, np.zeros(BUCKETS, np.int64))
            for _, held in chunks(part["text"], CHUNK):
                if sum(map(len, held)) > 2:
                    total += np.bincount(gram_buckets(joined(held)[0]).ravel(), minlength=BUCKETS)
    yield from flush()


def bit_evidence(weights: np.ndarray, texts: list[bytes]) -> np.ndarray:
    """Mean evidence of each document for each bit; zeros for documents of no gram. Works through CHUNK bytes at a
    time, so a long text needs no more memory than a chunk's grams."""
    buf, starts = joined(texts)
    if len(buf) < 3:
        return np.zeros((len(texts), weights.shape[1]))
    buf = np.concatenate([buf, buf[:2]])
    sums = np.zeros((len(texts), weights.shape[1]))
    for at in range(0, starts[-1], CHUNK):
        grams = gram_buckets(buf[at : at + CHUNK + 2])
        first, last = np.searchsorted(starts, [at, at + len(grams) - 1], side="right") - 1
        bounds = np.maximum(starts[first : last + 1] - at, 0)
        for bit in range(weights.shape[1]):
            own = weights[:, bit]
            sums[first : last + 1, bit] += np.add.reduceat(own[grams[:, 0]] + own[grams[:, 1]], bounds, dtype=np.float64)
    return sums / np.maximum(2 * np.diff(starts), 1)[:, None]


def fit(docs: DataFrame) -> dict:
    """Learn from docs(text, lang); rows with a null in either are ignored. No rows: a model that answers `und`.

    Counts stay in Spark; the driver gets the labels' names, and for each bit BUCKETS sums of either side.
    """
    known = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("text", "lang")
    grams = written(mapped(known, _counts, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")))
    totals = written(grams.groupBy("lang").agg((F.sum("n") + 0.5 * BUCKETS).alias("total")))
    langs = sorted(r.lang for r in totals.select("lang").collect())
    code = codewords(len(langs))
    bits = code.shape[1]
    if len(langs) < 2:
        return {"langs": langs, "code": code, "weights": np.zeros((BUCKETS, bits), np.float32), "bit_weight": np.full(bits, 1 / bits)}
    words = totals.sparkSession.createDataFrame([(lang, word.tolist()) for lang, word in zip(langs, code, strict=True)], "lang string, word array<double>")
    told = totals.join(words, "lang")
    shares = grams.join(told, "lang").select("lang", "bucket", (F.col("n") / F.col("total")).alias("share"), "word")
    side = lambda sign: F.sum(F.when(F.col("word") == sign, F.col("share")).otherwise(0.0))
    sums = shares.select("bucket", "share", F.posexplode("word").alias("bit", "word")).groupBy("bucket", "bit").agg(side(1.0).alias("yes"), side(-1.0).alias("no")).toPandas()
    # every bucket of every language has half a gram more than were counted
    spare = pd.DataFrame(told.select(F.posexplode("word").alias("bit", "word"), (0.5 / F.col("total")).alias("share")).groupBy("bit").agg(side(1.0).alias("yes"), side(-1.0).alias("no")).orderBy("bit").toPandas())
    yes, no = (np.tile(spare[c].to_numpy(), (BUCKETS, 1)) for c in ("yes", "no"))
    yes[sums["bucket"], sums["bit"]] += sums["yes"]
    no[sums["bucket"], sums["bit"]] += sums["no"]
    weights = np.log(yes / (code > 0).sum(0) / (no / (code < 0).sum(0))).astype(np.float32)
    return {"langs": langs, "code": code, "weights": weights, "bit_weight": _bit_weights(grams, told, weights)}


def _bit_weights(grams: DataFrame, told: DataFrame, weights: np.ndarray) -> np.ndarray:
    """How clearly each bit tells its languages apart: the least mean evidence, over the languages as they were
    counted, for the side that the codeword puts them on."""
    shared, flat = grams.sparkSession.sparkContext.broadcast(weights), weights.sum(0, dtype=np.float64)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for lang, part in pdf.groupby("lang", sort=False):
                yield pd.DataFrame({"lang": lang, "bit": range(weights.shape[1]), "sum": part["n"].to_numpy(float) @ shared.value[part["bucket"].to_numpy()]})

    sums = mapped(grams, run, "lang string, bit int, sum double").groupBy("lang", "bit").agg(F.sum("sum").alias("sum"))
    margin = (F.col("sum") + 0.5 * F.element_at(F.lit(flat.tolist()), F.col("bit") + 1)) / F.col("total") * F.element_at("word", F.col("bit") + 1)
    least = sums.join(told, "lang").groupBy("bit").agg(F.min(margin).alias("least")).orderBy("bit").toPandas()["least"].to_numpy()
    least = np.maximum(least, 1e-6)
    return least / least.sum()


def predict(docs: DataFrame, model: dict, carry: list[str] | None = None) -> DataFrame:
    """docs(text, ...) with lang_pred, score (0 to 1) and ambiguous added; of the other columns those in carry, or all.

    Null texts and texts without a letter get `und`, score 0. The model is BUCKETS x bits numbers, sent with the tasks.
    """
    langs, code, share = model["langs"], model["code"], model["bit_weight"]
    weights = docs.sparkSession.sparkContext.broadcast(model["weights"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = pdf["text"].tolist()
            best, score, doubt = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
            for rows, held in chunks(texts, CHUNK):
                if not langs:
                    continue
                evidence = bit_evidence(weights.value, held)
                loss = np.stack([(np.logaddexp(0, -SHARPNESS * evidence * word) * share).sum(1) for word in code], axis=1)
                odds = np.exp(-(loss - loss.min(1, keepdims=True)))
                odds /= odds.sum(1, keepdims=True)
                top = odds.argmax(1)
                for k, row in enumerate(rows):
                    if texts[row] is not None and _LETTER.search(texts[row]):
                        best[row], score[row] = langs[top[k]], odds[k, top[k]]
                        doubt[row] = score[row] < AMBIGUOUS
            yield pdf[columns].assign(lang_pred=best, score=score, ambiguous=doubt)

    columns = [c for c in (docs.columns if carry is None else carry) if c not in ("lang_pred", "score", "ambiguous")]
    fields = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in columns)
    asked = docs.select([f"`{c}`" for c in dict.fromkeys([*columns, "text"])])
    fields += "lang_pred string, score double, ambiguous boolean"
    return map_rows(asked, run, fields) if "doc_id" in columns else mapped(asked, run, fields)


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, ambiguous; learned from the three quarters of documents not held out."""
    held = docs.select("doc_id", "text", "lang", (crc_mod("doc_id", 4) == 2).alias("held_out"))
    # a null id has no remainder: it is neither learned from nor held out
    model = fit(held.where(~F.col("held_out")))
    return predict(held.withColumn("held_out", F.coalesce("held_out", F.lit(False))), model, ["doc_id", "held_out"])
