"""Exact repeats of at least `window` tokens, found through winnowed anchors. Shared by the two repeat removers.

Winnowing: of the grams in each window the one with the smallest hash (leftmost of equals) is the window's anchor, so
equal windows have their anchor at the same offset, and about 2 in `window - gram` positions are anchors. The windows
of an anchor start at consecutive places; the tokens that they cover together are its context.

1. A scan of the documents gives anchors (seed = gram hash, digests of the context, document, position); places of
   one document with the same context, as in runs of one word, are one row. Anchors whose seed occurs once go.
2. Anchors of one context form a class, counted with partial sums, so copies meet nowhere. All windows of a class
   with other members are repeats at once. A class is known by 128 bits of two independent digests.
3. Different classes of a seed may still share windows. The offsets of windows (tokens before the anchor) are dealt to
   BLOCKS; all windows with an offset in a block share a core, so only classes that share a core with another
   class of their seed are looked at further, and one context a class is fetched.
4. Contexts of a seed are sorted forwards from the anchor and backwards from it; neighbours' common extensions tell,
   for each offset, which classes hold the same window. A seed with more than HOT_CLASSES classes is first split by
   the cores of narrower and narrower ranges of offsets: classes that are equal over such a range are one, and repeats
   there. Each split leaves groups that go to the sort, and others that are split again, at last down to single windows.
5. Covered ranges go to their documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from popforge.llm.shared import discard, fits, map_rows, mapped, written
from popforge.llm.textarrays import BASE, INVERSE, chunks, mix, powers

#: Classes of one group that are sorted together in a task (some 7 KB each meanwhile), classes dealt to a task, and
#: text bytes scanned at a time.
HOT_CLASSES, TASK_CLASSES, CHUNK = 2000, 2000, 512_000
#: Blocks of offsets, ways that a range of offsets is split, rows or ranges of a side that may be broadcast.
BLOCKS, WAYS, BROADCAST_ROWS = 4, 4, 200_000
#: Bits that hold a position in a chunk beside the hash that orders grams: a text has at most 2**31 bytes.
_POSITION_BITS = np.uint64(31)
_PACK = 1 << 20


@dataclass(frozen=True)
class Kind:
    """window and gram in tokens; tokens: texts -> (token array, bounds of the documents in it); codes: tokens -> 64-bit codes;
    order: (group, token matrix, lengths) -> row order by group and tokens, common prefix of each with the one before;
    earliest: windows count as repeats of rows with a smaller doc_id only, else of any other place."""

    window: int
    gram: int
    tokens: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]
    codes: Callable[[np.ndarray], np.ndarray]
    order: Callable[[np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]
    earliest: bool

    @property
    def before(self) -> int:
        return self.window - self.gram

    @property
    def block(self) -> int:
        return -(-(self.before + 1) // BLOCKS)


def row_key() -> Column:
    """Tells rows apart: rows of one id by their text; only rows equal in both share a key, and fare alike."""
    return F.struct("doc_id", F.xxhash64("text").alias("h"))


def prefix(codes: np.ndarray) -> np.ndarray:
    out = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * powers(BASE, len(codes)), out=out[1:])
    return out


def anchors(sums: np.ndarray, bounds: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Positions of the anchors of all windows inside documents, the grams' hashes there, and the first and last start of
    each anchor's windows. sums: prefix hashes of the tokens. Grams are ordered by a fixed number of hash bits, so
    the same window has the same anchor in any chunk."""
    n, reach = len(sums) - gram, window - gram + 1
    starts = np.concatenate([np.arange(a, b - window + 1) for a, b in zip(bounds[:-1], bounds[1:], strict=True)] or [np.empty(0, np.int64)])
    if not len(starts):
        none = np.empty(0, np.int64)
        return none, none.astype(np.uint64), none, none
    grams = mix((sums[gram:] - sums[:-gram]) * powers(INVERSE, n))
    size = -(-n // reach) * reach + reach
    keys = np.full(size, np.iinfo(np.uint64).max, np.uint64)
    keys[:n] = grams >> _POSITION_BITS << _POSITION_BITS | np.arange(n, dtype=np.uint64)
    blocks = keys.reshape(-1, reach)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(right[starts], left[starts + reach - 1])
    new = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
    at = (least[new] & ((np.uint64(1) << _POSITION_BITS) - np.uint64(1))).astype(np.int64)
    return at, grams[at], starts[new], starts[np.r_[new[1:], len(starts)] - 1]


def _range_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix((sums[end] - sums[start]) * powers(INVERSE, len(sums))[start])


def cores(sums: np.ndarray, at: np.ndarray, low: np.ndarray, high: np.ndarray, kind: Kind) -> list[np.ndarray]:
    """Digests of each anchor's cores: the tokens that all windows with an offset in a block share. 0: it has no such
    window. low and high: the least and largest offset of its windows."""
    out = []
    for k in range(BLOCKS):
        first = min(k * kind.block, kind.before)
        last = min(first + kind.block - 1, kind.before)
        own = (low <= last) & (high >= first) & (k * kind.block <= kind.before)
        a, b = np.where(own, at - first, 0), np.where(own, at + kind.window - last, 0)
        out.append(np.where(own, _range_hashes(sums, a, b) | np.uint64(1), np.uint64(0)).astype(np.uint32).view(np.int32))
    return out


def _first_places(doc: np.ndarray, context: np.ndarray, check: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, list]:
    """The first place of each document and context, and for each of these its further positions (None: none)."""
    order = np.lexsort((pos, check, context, doc))
    d, c, x = doc[order], context[order], check[order]
    first = np.flatnonzero(np.r_[True, (d[1:] != d[:-1]) | (c[1:] != c[:-1]) | (x[1:] != x[:-1])])
    ends, rest = np.r_[first[1:], len(order)], [None] * len(first)
    for k in np.flatnonzero(ends - first > 1).tolist():
        rest[k] = pos[order[first[k] + 1 : ends[k]]].tolist()
    return order[first], rest


def _digest(data) -> bytes:
    return hashlib.blake2b(data, digest_size=8).digest()


def _scan(kind: Kind) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ids, hashes = pdf["doc_id"].to_numpy(), pdf["h"].to_numpy()
            for rows, held in chunks(pdf["text"], CHUNK):
                tokens, bounds = kind.tokens(held)
                sums = prefix(kind.codes(tokens))
                at, seeds, start, last = anchors(sums, bounds, kind.window, kind.gram)
                if not len(at):
                    continue
                doc, end = np.searchsorted(bounds, at, side="right") - 1, last + kind.window
                data, width = memoryview(tokens).cast("B"), tokens.itemsize
                digest = np.frombuffer(b"".join(_digest(data[a:b]) for a, b in zip((start * width).tolist(), (end * width).tolist(), strict=True)), np.int64)
                high, low = at - start, at - last
                row = np.asarray(rows)[doc]
                found = {"seed": seeds.view(np.int64), "context": digest ^ (high * 1024 + low), "check": _range_hashes(sums, start, end).view(np.int64), "doc_id": ids[row], "h": hashes[row], "pos": (at - bounds[doc]).astype(np.int32), "low": low.astype(np.int16), "high": high.astype(np.int16)}
                one, rest = _first_places(doc, found["context"], found["check"], found["pos"])
                found |= {f"core_{k}": c for k, c in enumerate(cores(sums, at, low, high, kind))}
                yield pd.DataFrame({name: column[one] for name, column in found.items()} | {"rest": rest})

    return run


def _contexts(kind: Kind) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for rows, held in chunks(pdf["text"], CHUNK):
                tokens, bounds = kind.tokens(held)
                data, width, out = memoryview(tokens).cast("B"), tokens.itemsize, []
                for k, row in enumerate(rows):
                    for w in pdf["wanted"].iat[row]:
                        at = bounds[k] + w["pos"]
                        out.append((w["seed"], w["context"], w["check"], w["first_doc"], w["size"], w["low"], w["high"], bytes(data[(at - w["high"]) * width : (at - w["low"] + kind.window) * width])))
                yield pd.DataFrame(out, columns=["group", "context", "check", "first_doc", "size", "low", "high", "tokens"])

    return run


def shared_windows(kind: Kind, group: np.ndarray, first: np.ndarray, low: np.ndarray, high: np.ndarray, contexts: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray]]:
    """For each window offset (tokens before the anchor) the rows whose window there is a repeat within its group. A row
    holds the windows with offsets low to high, and its anchor is its token number high."""
    m, upto = len(contexts), kind.window - low
    ahead = np.zeros((m, upto.max()), contexts[0].dtype)
    behind = np.zeros((m, high.max()), contexts[0].dtype)
    for k, c in enumerate(contexts):
        ahead[k, : upto[k]] = c[high[k] :]
        behind[k, : high[k]] = c[: high[k]][::-1]
    (order_a, common_a), (order_b, common_b) = (kind.order(group, matrix, lengths) for matrix, lengths in ((ahead, upto), (behind, high)))
    run_a, run_b = np.empty(m, np.int64), np.empty(m, np.int64)
    for offset in range(low.min(), high.max() + 1):
        fit = np.flatnonzero((low <= offset) & (high >= offset))
        if len(fit) < 2:
            continue
        run_a[order_a] = np.cumsum(common_a < kind.window - offset)
        run_b[order_b] = np.cumsum(common_b < offset)
        same, inverse, counts = np.unique(run_a[fit] * (m + 1) + run_b[fit], return_inverse=True, return_counts=True)
        if len(same) == len(fit):
            continue
        if kind.earliest:
            least = np.full(len(same), np.iinfo(np.int64).max)
            np.minimum.at(least, inverse, first[fit])
            hit = least[inverse] < first[fit]
        else:
            hit = counts[inverse] > 1
        if hit.any():
            yield offset, fit[hit]


def _runs(kind: Kind, low: int, high: int) -> int:
    """The stretch that windows with offsets low to high cover, packed: start after the anchor, plus kind.before, and length."""
    return (kind.before - high) * _PACK + high - low + kind.window


def _within(kind: Kind) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        dtype = kind.tokens([b""])[0].dtype
        # offsets come in rising order: each row's runs of them grow at the end
        runs: dict[int, list[list[int]]] = {}
        contexts = [np.frombuffer(b, dtype) for b in pdf["tokens"]]
        numbers = [pdf[c].to_numpy(np.int64) for c in ("group", "first_doc", "low", "high")]
        for offset, rows in shared_windows(kind, *numbers, contexts):
            for r in rows.tolist():
                own = runs.setdefault(r, [])
                if own and own[-1][1] == offset - 1:
                    own[-1][1] = offset
                else:
                    own.append([offset, offset])
        found = pdf.iloc[list(runs)][["context", "check"]]
        # objects even where nothing is shared: Arrow can't turn an empty column of numbers into lists
        packed = [[_runs(kind, low, high) for low, high in own] for own in runs.values()]
        return found.assign(runs=pd.Series(packed, found.index, object))

    return run


def _split(kind: Kind, width: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Rows of large groups, by ranges of `width` offsets: group by the core, `whole` by all that the row has there."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        size = kind.tokens([b""])[0].itemsize
        for pdf in batches:
            out = []
            for group, context, check, first_doc, low, high, tokens in zip(*(pdf[c].tolist() for c in ("group", "context", "check", "first_doc", "low", "high", "tokens")), strict=True):
                for k in range(low // width, high // width + 1):
                    a, b = max(low, k * width), min(high, (k + 1) * width - 1)
                    last = min((k + 1) * width - 1, kind.before)
                    core = tokens[(high - k * width) * size : (high + kind.window - last) * size] if k * width <= high else b""
                    own = tokens[(high - b) * size : (high - a + kind.window) * size]
                    name = _digest(group.to_bytes(8, "little", signed=True) + (k * width).to_bytes(4, "little") + core)
                    out.append((int.from_bytes(name, "little", signed=True), int.from_bytes(_digest(a.to_bytes(4, "little") + own), "little", signed=True), context, check, first_doc, a, b, own))
            yield pd.DataFrame(out, columns=["group", "whole", "context", "check", "first_doc", "low", "high", "tokens"])

    return run


def _classes(found: DataFrame, kind: Kind) -> DataFrame:
    """A row for each context of anchors(): seed, context, check, n (places), first_doc, one of its places, low, high, cores."""
    places = F.sum(F.lit(1) + F.coalesce(F.size("rest"), F.lit(0)))
    # firsts of one aggregate come from one row
    one = [F.first(c).alias(c) for c in ("seed", "doc_id", "h", "pos", "low", "high", *(f"core_{k}" for k in range(BLOCKS)))]
    return written(found.groupBy("context", "check").agg(places.alias("n"), F.min("doc_id").alias("first_doc"), *one))


def _asked(classes: DataFrame) -> DataFrame:
    """Of the classes those that share a core with another class of their seed."""
    blocks = F.filter(F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"core_{k}").alias("core")) for k in range(BLOCKS)]), lambda b: b["core"] != 0)
    each = classes.select("seed", "context", "check", F.explode(blocks).alias("b")).select("seed", "context", "check", "b.k", "b.core")
    met = each.groupBy("seed", "k", "core").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    asking = each.join(met, ["seed", "k", "core"]).select("context", "check").distinct()
    return written(classes.drop("n", *(f"core_{k}" for k in range(BLOCKS))).join(asking, ["context", "check"]))


def _sized(asked: DataFrame) -> DataFrame:
    """The asked classes with the number of them that their seed has (size), 0 for HOT_CLASSES and fewer."""
    hot = asked.groupBy("seed").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > HOT_CLASSES)
    side = F.broadcast(hot) if fits(hot, BROADCAST_ROWS) else hot
    return asked.join(side, "seed", "left").withColumn("size", F.coalesce("size", F.lit(0).cast("long")))


def _compared(contexts: DataFrame, kind: Kind) -> list[DataFrame]:
    """(context, check, runs) of the windows that classes share: contexts(group, context, check, first_doc, size, low, high,
    tokens) are sorted group by group, groups of more than HOT_CLASSES after splitting."""
    out, pending, width = [], written(contexts), kind.before + 1
    while True:
        hot = F.col("size") > HOT_CLASSES
        n, n_hot = pending.select(F.count(F.lit(1)), F.count_if(hot)).first()
        if n > n_hot:
            dealt = pending.where(~hot).withColumn("deal", F.pmod(F.xxhash64("group"), F.lit(1 + (n - n_hot) // TASK_CLASSES)))
            runs = dealt.groupBy("deal").applyInPandas(_within(kind), "context long, check long, runs array<long>")
            # the last are read once, straight from `pending`
            out.append(written(runs) if n_hot else runs)
        if not n_hot:
            return out
        width = -(-width // WAYS)
        split = written(mapped(pending.where(hot), _split(kind, width), "group long, whole long, context long, check long, first_doc long, low int, high int, tokens binary"))
        alike = split.groupBy("group", "whole").agg(F.count(F.lit(1)).alias("n"), F.min("first_doc").alias("least"), F.min("context").alias("chosen"))
        sizes = alike.groupBy("group").agg(F.sum("n" if kind.earliest else F.lit(1)).alias("size"), F.count(F.lit(1)).alias("kinds"))
        # groups of one class alone have nothing left to find
        alike = written(alike.join(sizes, "group").where("n > 1 or kinds > 1"))
        told = split.join(alike, ["group", "whole"])
        hit = (F.col("least") < F.col("first_doc")) if kind.earliest else (F.col("n") > 1)
        packed = (F.lit(kind.before) - F.col("high")).cast("long") * _PACK + (F.col("high") - F.col("low") + kind.window).cast("long")
        out.append(written(told.where(hit).select("context", "check", F.array(packed).alias("runs"))))
        stays = (F.col("least") == F.col("first_doc")) if kind.earliest else (F.col("context") == F.col("chosen"))
        narrower = written(told.where(stays & (F.col("kinds") > 1)).select("group", "context", "check", "first_doc", "size", "low", "high", "tokens"))
        discard(pending, split, alike)
        pending = narrower


def _merged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each row's packed ranges, sorted, those that touch as one."""
    for pdf in batches:
        out = []
        for ranges in pdf["ranges"]:
            packed = np.unique(np.asarray(ranges, np.int64))
            start, end = packed // _PACK, np.maximum.accumulate(packed // _PACK + packed % _PACK)
            first = np.flatnonzero(np.r_[True, start[1:] > end[:-1]])
            last = np.r_[first[1:], len(start)] - 1
            # a packed length is bounded: a longer range is a row of them
            out.append([int(a + at) * _PACK + int(min(_PACK - 1, b - a - at)) for a, b in zip(start[first], end[last], strict=True) for at in range(0, b - a, _PACK - 1)])
        yield pdf.assign(ranges=out)


def covered(docs: DataFrame, kind: Kind) -> DataFrame:
    """doc_id, h (as in row_key), ranges: for documents with repeats, packed (start token * 2**20 + length) ranges to remove.

    docs(doc_id, text). Judged on the input as it is; null and short texts have no window.
    """
    rows = docs.select("doc_id", F.xxhash64("text").alias("h"), "text")
    fields = "seed long, context long, check long, doc_id long, h long, pos int, low short, high short" + "".join(f", core_{k} int" for k in range(BLOCKS)) + ", rest array<int>"
    every = written(map_rows(rows.where(F.octet_length("text") >= kind.window), _scan(kind), fields))
    seeds = every.groupBy("seed").agg(F.sum(F.lit(1) + F.coalesce(F.size("rest"), F.lit(0))).alias("n")).where("n > 1").select("seed")
    seeds = seeds.persist(StorageLevel.DISK_ONLY)
    few = fits(seeds, 5 * BROADCAST_ROWS)
    found = written(every.join(F.broadcast(seeds) if few else seeds, "seed", "left_semi"))
    seeds.unpersist()
    discard(every)
    classes = _classes(found, kind)
    further = F.coalesce("rest", F.array().cast("array<int>"))
    places = F.concat(F.array("pos"), further)
    whole = (F.col("doc_id") > F.col("first_doc")) if kind.earliest else F.lit(True)
    whole = found.join(classes.where("n > 1").select("context", "check", "first_doc"), ["context", "check"]).where(whole)
    reach = (F.col("high") - F.col("low") + kind.window).cast("long")
    parts = [whole.select("doc_id", "h", F.transform(places, lambda p: (p - F.col("high")).cast("long") * _PACK + reach).alias("ranges"))]
    asked = _asked(classes)
    if not asked.isEmpty():
        nowhere = F.lit((1 << 63) - 1)
        wanted = F.struct("seed", "context", "check", F.coalesce("first_doc", nowhere).alias("first_doc"), "size", "pos", "low", "high")
        wanted = _sized(asked).select(F.struct("doc_id", "h").alias("row"), wanted.alias("w")).groupBy("row").agg(F.collect_list("w").alias("wanted"))
        side = asked.select(F.struct("doc_id", "h").alias("row")).distinct()
        texts = rows.select(F.struct("doc_id", "h").alias("row"), "text")
        texts = texts.join(F.broadcast(side), "row", "left_semi") if fits(side, BROADCAST_ROWS) else texts
        texts = texts.join(wanted, "row").dropDuplicates(["row"]).select("text", "wanted")
        contexts = mapped(texts, _contexts(kind), "group long, context long, check long, first_doc long, size long, low int, high int, tokens binary")
        runs = reduce(DataFrame.unionByName, _compared(contexts, kind))
        # the first document's places of a class fare as the compared one; the others are whole repeats
        own = found.join(asked.select("context", "check", "first_doc"), ["context", "check"])
        own = own.where(F.col("doc_id") == F.col("first_doc")) if kind.earliest else own
        moved = F.transform(places, lambda p: F.transform("runs", lambda r: r + (p - kind.before).cast("long") * _PACK))
        parts.append(own.join(runs, ["context", "check"]).select("doc_id", "h", F.flatten(moved).alias("ranges")))
    gathered = reduce(DataFrame.unionByName, parts).groupBy("doc_id", "h").agg(F.flatten(F.collect_list("ranges")).alias("ranges"))
    return map_rows(gathered, _merged, "doc_id long, h long, ranges array<long>")


def removed_mask(n: int, ranges) -> np.ndarray:
    """Which of n tokens the packed ranges cover."""
    packed = np.asarray(ranges, np.int64)
    edges = np.zeros(n + 1, np.int64)
    start, length = packed // _PACK, packed % _PACK
    np.add.at(edges, start, 1)
    np.add.at(edges, start + length, -1)
    return np.cumsum(edges[:-1]) > 0


def with_ranges(docs: DataFrame, kind: Kind) -> DataFrame:
    """row docs with their ranges (null: nothing to remove). Few ranges, counted, are broadcast to the documents."""
    ranges = written(covered(docs, kind).select(F.struct("doc_id", "h").alias("row"), "ranges"))
    n = ranges.agg(F.count(F.lit(1)) + F.coalesce(F.sum(F.size("ranges")), F.lit(0))).first()[0]
    side = F.broadcast(ranges) if n <= 2 * BROADCAST_ROWS else ranges
    return docs.select(row_key().alias("row"), "doc_id", "text").join(side, "row", "left").select("doc_id", "text", "ranges")
