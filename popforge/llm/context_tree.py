"""Language-model scoring by context-tree weighting over binary-decomposed bytes.

Each byte is eight binary decisions. For every decision node (the bits of the byte seen so far) and context
of 0 to DEPTH preceding bytes, the corpus is counted into zeros and ones; a node's estimate is
Krichevsky-Trofimov's. Weighting runs from the deepest contexts up, P = (P_kt + product of the children's P) / 2,
and leaves each node the weight of stopping there. A text's probability mixes the estimates of all depths
along its contexts with those weights. Texts are A-Z folded and end with a byte that no text has.

Counts cover all training documents and are made by Spark, exactly. The tree is never whole anywhere: byte grams
(context and byte) are dealt to tasks by their context's last two bytes, so each task has whole subtrees; it reports
what they hold for the contexts of one byte, of which there are 65,536 nodes at most, and these few are weighted on
the driver and sent to all tasks. The distinct grams of groups of documents are dealt the same way, packed, and
come back with their chances, so that each group sums those of its own texts.

Beside it: an additive-smoothed word model as a base score. The distinct words of the groups are dealt, and come back with
their counts, in the same manner.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from popforge.llm.shared import NO_ID, crc_mod, map_rows, mapped, written
from popforge.llm.textarrays import chunks, joined, words

#: Bytes of context (2 to 7), text bytes worked on at a time, text bytes of a group of documents.
DEPTH, CHUNK, GATHER = 4, 512_000, 24_000_000
#: Distinct grams or words that a task counts before it hands the counts on.
HELD_COUNTS = 750_000
#: Grams of the model and text bytes asked about for each deal, groups that ask in one task.
DEAL_GRAMS, DEAL_BYTES, DEAL_GROUPS = 100_000, 20_000_000, 512
END = 0xFF
#: Key of the end token; words hash elsewhere but for one chance in 2**64.
END_WORD = 1
SMOOTHING = 0.1
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_SPREAD, _BYTE = 2654435761, np.uint64(8)


def byte_grams(held: list[bytes], depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """Each byte (and end) of the texts with its `depth` bytes of context in one number, and the texts' bounds."""
    pad = bytes([END]) * depth
    buf = _FOLD[np.frombuffer(pad + pad.join(held) + pad, np.uint8)]
    n = len(buf) - depth
    grams = np.zeros(n, np.uint64)
    for i in range(depth + 1):
        grams <<= _BYTE
        grams |= buf[i : i + n]
    lengths = np.array([len(h) for h in held])
    starts = np.concatenate([[0], np.cumsum(lengths + depth)])[:-1]
    at = np.repeat(starts - np.concatenate([[0], np.cumsum(lengths + 1)])[:-1], lengths + 1) + np.arange((lengths + 1).sum())
    return grams[at], np.concatenate([[0], np.cumsum(lengths + 1)])


def _word_keys(held: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the words of the texts with an end after each text, and their text numbers."""
    buf, starts = joined(held)
    hashes, _, _, first = words(buf, starts, fold=True)
    docs = np.repeat(np.arange(len(held)), np.diff(first))
    return np.concatenate([hashes, np.full(len(held), END_WORD, np.uint64)]), np.concatenate([docs, np.arange(len(held))])


def _count(batches: Iterator[pd.DataFrame], depth: int = DEPTH) -> Iterator[pd.DataFrame]:
    """Partial counts of byte grams (kind 0) and words (kind 1)."""
    held_counts = {0: [], 1: []}

    def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        keys = np.concatenate([k for k, _ in parts])
        order = np.argsort(keys)
        keys, n = keys[order], np.concatenate([n for _, n in parts])[order]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        return keys[first], np.add.reduceat(n, first)

    def flush(least: int) -> Iterator[pd.DataFrame]:
        for kind, parts in held_counts.items():
            if parts and sum(len(k) for k, _ in parts) >= least:
                parts[:] = [merged(parts)]
                if len(parts[0][0]) >= least:
                    keys, n = parts.pop()
                    yield pd.DataFrame({"kind": np.int32(kind), "key": keys.view(np.int64), "n": n})

    for pdf in batches:
        for _, held in chunks(pdf["text"], CHUNK):
            for kind, keys in ((0, byte_grams(held, depth)[0]), (1, _word_keys(held)[0])):
                held_counts[kind].append(np.unique(keys, return_counts=True))
            yield from flush(HELD_COUNTS)
    yield from flush(1)


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """ln Gamma(x) for x >= 0.5, by Stirling's series after six steps of the recurrence."""
    y = x + 6
    steps = x * (x + 1) * (x + 2) * (x + 3) * (x + 4) * (x + 5)
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y**3) - np.log(steps)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov probability of any one sequence of so many zeros and ones."""
    return _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - _log_gamma(zeros + ones + 1) - np.log(np.pi)


def _bits(keys: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each of the eight decisions of grams' bytes: their nodes (context * 256 + bits so far, after a 1) and bits."""
    symbol, context = keys & np.uint64(255), keys >> _BYTE << _BYTE
    for k in range(8):
        yield context | np.uint64(1 << k) | symbol >> np.uint64(8 - k), symbol >> np.uint64(7 - k) & np.uint64(1)


def _shorter(nodes: np.ndarray, depth: int) -> np.ndarray:
    """The nodes with only the last `depth` bytes of their contexts."""
    return nodes & np.uint64((1 << 8 * depth + 8) - 1)


@dataclass
class Level:
    """Nodes of one depth, sorted, with their counts, log probabilities and weights of stopping there; later what a text
    that knows nothing deeper is told (one), and what deeper nodes start from (said, left)."""

    nodes: np.ndarray
    zeros: np.ndarray
    ones: np.ndarray
    log_p: np.ndarray
    weight: np.ndarray
    one: np.ndarray | None = None
    said: np.ndarray | None = None
    left: np.ndarray | None = None

    def find(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of nodes, and whether they are here at all."""
        if not len(self.nodes):
            return np.zeros(len(nodes), np.int64), np.zeros(len(nodes), bool)
        at = np.minimum(np.searchsorted(self.nodes, nodes), len(self.nodes) - 1)
        return at, self.nodes[at] == nodes


def _level(nodes: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray | None) -> Level:
    """A level from rows of nodes, summed by node. below: log probabilities of the children (None: deepest)."""
    order = np.argsort(nodes, kind="stable")
    nodes = nodes[order]
    first = np.flatnonzero(np.r_[True, nodes[1:] != nodes[:-1]]) if len(nodes) else np.empty(0, np.int64)
    total = lambda x: np.add.reduceat(x[order], first) if len(first) else np.empty(0)
    zeros, ones = total(zeros), total(ones)
    own = log_kt(zeros, ones)
    if below is None:
        return Level(nodes[first], zeros, ones, own, np.ones(len(own)))
    log_p = np.logaddexp(own, total(below)) - np.log(2)
    return Level(nodes[first], zeros, ones, log_p, np.exp(own - np.log(2) - log_p))


def subtrees(keys: np.ndarray, n: np.ndarray, depth: int) -> list[Level]:
    """Levels `depth` to 2 of the tree of grams that are all that share their contexts' last two bytes."""
    nodes, bits = (np.concatenate(x) for x in zip(*_bits(keys), strict=True))
    n = np.tile(n.astype(float), 8)
    levels = [_level(nodes, n * (bits == 0), n * (bits == 1), None)]
    for d in range(depth - 1, 1, -1):
        last = levels[-1]
        levels.append(_level(_shorter(last.nodes, d), last.zeros, last.ones, last.log_p))
    return levels


def tell(level: Level, above: Level | None, depth: int) -> None:
    """Fill in what the nodes of a level of that depth say, from the level above it (None: the root)."""
    said, left = np.zeros(len(level.nodes)), np.ones(len(level.nodes))
    if above is not None and len(level.nodes):  # each node's parent is a node
        at, _ = above.find(_shorter(level.nodes, depth - 1))
        said, left = above.said[at], above.left[at]
    p = (level.ones + 0.5) / (level.zeros + level.ones + 1)
    level.one = said + left * p
    level.said, level.left = said + left * level.weight * p, left * (1 - level.weight)


@dataclass
class Model:
    """The counted grams(key, n), the number of their deals, and the levels of depths 1 and 0."""

    grams: DataFrame
    deals: int
    top: list[Level]
    depth: int


def _deal(key: Column, deals: int) -> Column:
    return F.pmod(F.shiftright(F.shiftright(key, 8).bitwiseAND(0xFFFF) * F.lit(_SPREAD), 16), F.lit(deals))


def _dealt(keys: np.ndarray, deals: int) -> np.ndarray:
    return ((keys >> _BYTE & np.uint64(0xFFFF)) * np.uint64(_SPREAD) >> np.uint64(16)) % np.uint64(deals)


def _word_deal(key: Column, deals: int) -> Column:
    return F.shiftrightunsigned(key, 1) % F.lit(deals)


def _words_dealt(keys: np.ndarray, deals: int) -> np.ndarray:
    return (keys >> np.uint64(1)) % np.uint64(deals)


def _numbers(column: pd.Series) -> np.ndarray:
    return column.to_numpy(np.int64).view(np.uint64)


def fit(grams: DataFrame, depth: int = DEPTH) -> Model:
    """The context tree of grams(key, n) as byte_grams() makes them, keys distinct. To be read often: written."""

    def lift(pdf: pd.DataFrame) -> pd.DataFrame:
        last = subtrees(_numbers(pdf["key"]), pdf["n"].to_numpy(), depth)[-1]
        return pd.DataFrame({"node": _shorter(last.nodes, 1).view(np.int64), "zeros": last.zeros, "ones": last.ones, "below": last.log_p})

    n, total = grams.select(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    deals = 1 + int(max(n // DEAL_GRAMS, total // DEAL_BYTES))
    lifted = grams.select("key", "n", _deal(F.col("key"), deals).alias("deal")).groupBy("deal").applyInPandas(lift, "node long, zeros double, ones double, below double")
    rows = lifted.groupBy("node").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("below").alias("below")).toPandas()
    first = _level(_numbers(rows["node"]), *(rows[c].to_numpy() for c in ("zeros", "ones", "below")))
    root = _level(_shorter(first.nodes, 0), first.zeros, first.ones, first.log_p)
    tell(root, None, 0)
    tell(first, root, 1)
    return Model(grams, deals, [first, root], depth)


def log10_chances(keys: np.ndarray, levels: list[Level], depth: int) -> np.ndarray:
    """log10 probability of the byte of each gram after its context; levels: told, from `depth` to 0. The deepest context
    known stands for those beyond it."""
    out = np.zeros(len(keys))
    for nodes, bits in _bits(keys):
        one, open_ = np.full(len(keys), 0.5), np.ones(len(keys), bool)
        for d, level in zip(range(depth, -1, -1), levels, strict=True):
            at, known = level.find(_shorter(nodes, d))
            known &= open_
            one[known] = level.one[at[known]]
            open_ &= ~known
        out += np.log10(np.where(bits == 1, one, 1 - one))
    return out


def _pack(keys: np.ndarray, depth: int) -> bytes:
    return np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : depth + 1]).tobytes()


def _unpack(data: bytes, depth: int) -> np.ndarray:
    rows = np.frombuffer(data, np.uint8).reshape(-1, depth + 1)
    out = np.zeros((len(rows), 8), np.uint8)
    out[:, : depth + 1] = rows
    return out.view("<u8").ravel().astype(np.uint64)


def _judged(top: list[Level], depth: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """group, keys, chances (packed) of the grams that groups ask about, from the grams of the model in the same deal."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        learned = pdf["keys"].isna().to_numpy()
        levels = subtrees(_numbers(pdf["key"][learned]), pdf["n"].to_numpy()[learned], depth)
        above = top[0]
        for d, level in zip(range(2, depth + 1), reversed(levels), strict=True):
            tell(level, above, d)
            above = level
        asked = pdf[~learned]
        parts = [_unpack(data, depth) for data in asked["keys"]]
        if not parts:
            return pd.DataFrame({"group": [], "keys": [], "chances": []})
        every, place = np.unique(np.concatenate(parts), return_inverse=True)
        chances = log10_chances(every, [*levels, *top], depth)[place]
        ends = np.cumsum([len(p) for p in parts]).tolist()
        return pd.DataFrame({"group": asked["group"].to_numpy(), "keys": asked["keys"].to_numpy(), "chances": [chances[b - len(p) : b].tobytes() for p, b in zip(parts, ends, strict=True)]})

    return run


def _asked_in_deals(learned: DataFrame, asked: DataFrame, groups: int, run, fields: str) -> DataFrame:
    """Applies run to learned(deal, key, n) and asked(group, deal, keys) of each deal together. Deals that many groups ask
    about are dealt out by group as well."""
    salts = 1 + groups // DEAL_GROUPS
    learned = learned.select(F.col("deal").cast("long"), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), F.lit(0).cast("long").alias("group"), "key", "n", F.lit(None).cast("binary").alias("keys"))
    nothing = F.lit(0).cast("long")
    asking = asked.select(F.col("deal").cast("long"), F.pmod(F.xxhash64("group"), F.lit(salts)).cast("int").alias("salt"), "group", nothing.alias("key"), nothing.alias("n"), "keys")
    return learned.unionByName(asking).groupBy("deal", "salt").applyInPandas(run, fields)


def chances_of(asked: DataFrame, model: Model, groups: int) -> DataFrame:
    """asked(group, deal, keys) -> group, keys, chances."""
    learned = model.grams.select(_deal(F.col("key"), model.deals).alias("deal"), "key", "n")
    return _asked_in_deals(learned, asked, groups, _judged(model.top, model.depth), "group long, keys binary, chances binary")


def _counted(pdf: pd.DataFrame) -> pd.DataFrame:
    """group, keys, chances: the counts (packed doubles) of the words that groups ask about."""
    learned = pdf["keys"].isna().to_numpy()
    keys, n = _numbers(pdf["key"][learned]), pdf["n"].to_numpy(np.float64)[learned]
    order = np.argsort(keys)
    keys, n = keys[order], n[order]
    asked, out = pdf[~learned], []
    for group, data in zip(asked["group"], asked["keys"], strict=True):
        own, count = np.frombuffer(data, np.uint64), np.zeros(len(data) // 8)
        if len(keys):
            at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
            count = np.where(keys[at] == own, n[at], 0.0)
        out.append((group, data, count.tobytes()))
    return pd.DataFrame(out, columns=["group", "keys", "chances"])


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and each key's place among them: a hash table first, a search for what collides in it."""
    found = np.unique(keys)
    shift = np.uint64(44)
    table = np.zeros(1 << 20, np.int32)
    spread = np.uint64(0x9E3779B97F4A7C15)
    table[(found * spread >> shift).astype(np.int64)] = np.arange(len(found))
    place = table[(keys * spread >> shift).astype(np.int64)].astype(np.int64)
    missed = np.flatnonzero(found[place] != keys)
    place[missed] = np.searchsorted(found, keys[missed])
    return found, place


def _summed(held: list[bytes], keys: np.ndarray, chances: np.ndarray, depth: int) -> np.ndarray:
    """Scores of texts from the chances of their grams, keys sorted."""
    grams, bounds = byte_grams(held, depth)
    found, place = _distinct(grams)
    return np.add.reduceat(chances[np.searchsorted(keys, found)][place], bounds[:-1])


def _sorted_chances(rows: pd.DataFrame, depth: int) -> tuple[np.ndarray, np.ndarray]:
    keys, chances = np.concatenate([_unpack(x, depth) for x in rows["keys"]]), np.concatenate([np.frombuffer(x) for x in rows["chances"]])
    order = np.argsort(keys)
    return keys[order], chances[order]


def text_scores(held: list[bytes], model: Model) -> np.ndarray:
    keys = np.unique(byte_grams(held, model.depth)[0])
    deal = _dealt(keys, model.deals)
    rows = [(0, int(d), _pack(keys[deal == d], model.depth)) for d in np.unique(deal)]
    asked = model.grams.sparkSession.createDataFrame(rows, "group long, deal long, keys binary")
    return _summed(held, *_sorted_chances(chances_of(asked, model, 1).toPandas(), model.depth), model.depth)


def _scored(depth: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    """The texts of a group, scored from the chances of all its grams and the counts of all its words."""

    def run(texts: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        words_told = told["words"].to_numpy()
        keys, values = _sorted_chances(told[~words_told], depth)
        names, counts = (np.concatenate([np.frombuffer(x, kind) for x in told.loc[words_told, c]]) for c, kind in (("keys", np.uint64), ("chances", np.float64)))
        order = np.argsort(names)
        names, counts = names[order], counts[order]
        score, logs, known, tokens = (np.zeros(len(texts), kind) for kind in (float, float, np.int64, np.int64))
        for rows, held in chunks(texts["text"], CHUNK):
            score[rows] = _summed(held, keys, values, depth)
            own, docs = _word_keys(held)
            count = counts[np.searchsorted(names, own)]
            logs[rows] = np.bincount(docs, np.log10(count + SMOOTHING), len(held))
            known[rows] = np.bincount(docs, count > 0, len(held))
            tokens[rows] = np.bincount(docs, minlength=len(held))
        return pd.DataFrame({"doc_id": texts["doc_id"], "held_out": texts["held_out"], "n_tokens": tokens, "n_known": known, "logs": logs, "score": score})

    return run


def _gather(deals: int, depth: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Groups of documents (kind 0), their distinct byte grams (kind 1) and words (kind 2), packed by deal."""
    columns = ["group", "kind", "deal", "keys", "doc_id", "held_out", "text"]

    def packed(group: int, kind: int, own: np.ndarray, deal: np.ndarray, pack: Callable[[np.ndarray], bytes]) -> pd.DataFrame:
        order = np.argsort(deal, kind="stable")
        found, first = np.unique(deal[order], return_index=True)
        data = [pack(own[order[a:b]]) for a, b in zip(first.tolist(), [*first[1:].tolist(), len(own)], strict=True)]
        return pd.DataFrame({"group": group, "kind": np.int32(kind), "deal": found.astype(np.int64), "keys": data, "doc_id": None, "held_out": False, "text": None})[columns]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grams: list[np.ndarray] = []
        names: list[np.ndarray] = []
        # told apart by their partition: what is in them may occur in other tasks too
        group, size = TaskContext.get().partitionId() << 32, 0

        def flush() -> Iterator[pd.DataFrame]:
            if grams:
                own = np.unique(np.concatenate(grams))
                yield packed(group, 1, own, _dealt(own, deals), lambda k: _pack(k, depth))
                own = np.unique(np.concatenate(names))
                yield packed(group, 2, own, _words_dealt(own, deals), np.ndarray.tobytes)
                grams.clear()
                names.clear()

        for pdf in batches:
            told = pdf[["doc_id", "held_out", "text"]]
            for at, held in chunks(pdf["text"], CHUNK):
                more = sum(map(len, held))
                if size and size + more > GATHER:
                    yield from flush()
                    group, size = group + 1, 0
                for own, found in ((grams, byte_grams(held, depth)[0]), (names, _word_keys(held)[0])):
                    own.append(np.unique(found))
                    if sum(map(len, own)) > HELD_COUNTS:
                        own[:] = [np.unique(np.concatenate(own))]
                size += more + len(held)
                yield told.iloc[at].assign(group=group, kind=np.int32(0), deal=np.int64(0), keys=None)[columns]
        yield from flush()

    return run


def score(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for each row of docs(doc_id, text).

    Learned from documents whose crc32(doc_id) mod 10 is not 0; null ids are neither learned from nor held out.
    Null texts are empty: one end token. Repeated rows count as often as they occur. An empty table gives no rows.
    """
    marked = docs.select("doc_id", "text", (crc_mod("doc_id", 10) == 0).alias("held_out"))
    training = marked.where(~F.col("held_out")).select("text")
    counts = written(mapped(training, lambda batches: _count(batches, depth), "kind int, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n")))
    known = counts.where("kind = 1").select("key", "n")
    tokens, distinct = known.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    model = fit(counts.where("kind = 0").select("key", "n"), depth)
    fields = "group long, kind int, deal long, keys binary, doc_id long, held_out boolean, text string"
    found = written(map_rows(marked.select("doc_id", "text", F.coalesce("held_out", F.lit(False)).alias("held_out")), _gather(model.deals, depth), fields))
    asked = lambda kind: found.where(F.col("kind") == kind).select("group", "deal", "keys")
    groups = asked(1).select(F.count_distinct("group")).first()[0]
    chances = chances_of(asked(1), model, groups)
    counted = _asked_in_deals(known.select(_word_deal(F.col("key"), model.deals).alias("deal"), "key", "n"), asked(2), groups, _counted, "group long, keys binary, chances binary")
    told = chances.select(F.col("group").alias("own"), "keys", "chances", F.lit(False).alias("words")).unionByName(counted.select(F.col("group").alias("own"), "keys", "chances", F.lit(True).alias("words")))
    texts = found.where("kind = 0").select("group", "doc_id", "held_out", "text")
    fields = "doc_id long, held_out boolean, n_tokens long, n_known long, logs double, score double"
    filled = texts.withColumn("doc_id", F.coalesce("doc_id", F.lit(NO_ID)))
    scored = filled.groupBy("group").cogroup(told.groupBy("own")).applyInPandas(_scored(depth), fields)
    scale = float(np.log10(tokens + SMOOTHING * (distinct + 1)))
    return scored.select(F.nullif("doc_id", F.lit(NO_ID)).alias("doc_id"), "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), (F.col("logs") - F.col("n_tokens") * scale).alias("base_score"), "score")
