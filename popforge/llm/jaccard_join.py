"""Similarity join of documents by the Jaccard measure of their word shingles: a grouped prefix join.

Two documents link when 100 * common >= percent * union. The result is the linked components; links are found
until each component holds together, and pairs already connected are not compared again.

1. Equal shingle sets collapse into one class (digest and size).
2. Of n shingles a linked set holds few that no other set holds. Shingles are counted in packed buckets, those that
   recur in a group of sets once a group, and classes that hold too many alone are done: most of a corpus is.
3. Classes that can link are brought together. With sizes n and m, linked sets differ in at most
   (n + m) * (100 - p) / (100 + p) shingles. The hash range is cut into more parts than that, so linked sets
   agree in a whole part; classes are joined on part digests, and each connected family of candidates goes to
   one task. A family too large for one task, which texts that share a few passages make, is first parted by prefixes
   of its shingles, rarest first; what is still too large is cut into blocks, and every pair of blocks is a task.
4. Within a family runs the grouped prefix join. Shingles are ordered rarest first; sets with the same prefix
   and size form a group; groups meet on prefix shingles, pass size and position filters, and their members are
   expanded and verified exactly.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popforge.llm.graph import components
from popforge.llm.shared import discard, fits, likely, map_rows, mapped, written
from popforge.llm.textarrays import chunks, joined, mix, shingles, words

SHINGLE, PERCENT = 3, 90
#: Shingles of a family that one task takes, shingles dealt to a task, rows of a side that may be broadcast.
FAMILY_SHINGLES, TASK_SHINGLES, BROADCAST_ROWS = 2_000_000, 500_000, 200_000
#: Text bytes worked on at a time, shingles of a group of sets, text bytes whose shingles make a bucket.
CHUNK, GROUP_SHINGLES, BUCKET_BYTES = 512_000, 200_000, 10_000_000
#: One shingle in so many (a power of two) is counted by the sets that hold it.
TOLD = 2
#: Parts beyond those that may differ: this many, and one more for so many of these. A set with no more empty parts than
#: that need not offer them for a match, and sets with the same empty part are no candidates for it.
SPARE_PARTS, SPARE_SHARE = 2, 8


def least_common(n: int, m: int, percent: int) -> int:
    """Common shingles that sets of n and m need: 100 * c >= percent * (n + m - c)."""
    return -(-percent * (n + m) // (100 + percent))


def bands(n: int, percent: int) -> list[tuple[int, int, int]]:
    """(number, parts, spare parts) of the schemes a set of n shingles takes part in: its own size band, and the next, where
    the larger partner may be. Parts exceed the differences between linked sets by the spare ones and one."""
    low, number, out = 1, 0, []
    while len(out) < 2:
        high = max(low + 1, (low - 1) * 100 // percent + 1)
        if high > n:
            most = 2 * (high - 1) * (100 - percent) // (100 + percent)
            spare = SPARE_PARTS + most // SPARE_SHARE
            out.append((number, most + 1 + spare, spare))
        low, number = high, number + 1
    return out


def part_digests(own: np.ndarray, percent: int) -> np.ndarray:
    """Digests of the parts of a sorted shingle set under its schemes."""
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(own ^ np.uint64(0xA5A5A5A55A5A5A5A)), dtype=np.uint64)])
    out = []
    for number, parts, spare in bands(len(own), percent):
        edges = (np.arange(parts + 1, dtype=np.float64) * (2.0**64 / parts))[1:-1].astype(np.uint64)
        at = np.concatenate([[0], np.searchsorted(own, edges), [len(own)]])
        digest = mix(mix(sums[at[1:]] - sums[at[:-1]]) + np.arange(parts, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(number * 0xC2B2AE3D27D4EB4F % 2**64))
        empty = at[1:] == at[:-1]
        out.append(digest if empty.sum() > spare else digest[~empty])
    return np.concatenate(out)


def set_key(own: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(own.tobytes(), digest_size=8).digest(), "little", signed=True)


def _sets(texts, shingle: int) -> Iterator[tuple[int, np.ndarray]]:
    for rows, held in chunks(texts, CHUNK):
        buf, starts = joined(held)
        hashes, _, _, first = words(buf, starts, fold=True)
        yield from zip(rows, shingles(hashes, first, shingle), strict=True)


def _scan(shingle: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = [(pdf["doc_id"].iat[row], pdf["h"].iat[row], len(own), set_key(own)) for row, own in _sets(pdf["text"], shingle)]
            yield pd.DataFrame(out, columns=["doc_id", "h", "n_shingles", "key"])

    return run


def _tokens(shingle: int, buckets: int):
    """Groups of sets by bucket of their told shingles: those that one set of the group holds, with its number, and those
    that several hold; bucket -1: the sets' keys and sizes. Equal sets of a group count once."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group, held, keys = TaskContext.get().partitionId() << 32, [], {}

        def low(tokens: np.ndarray) -> bytes:
            return np.ascontiguousarray(tokens.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()

        def flush() -> pd.DataFrame:
            flat = np.concatenate([own[own & np.uint64(TOLD - 1) == 0] for own in held])
            owner = np.repeat(np.arange(len(held)), [np.count_nonzero(own & np.uint64(TOLD - 1) == 0) for own in held]).astype(np.uint16)
            order = np.argsort(flat, kind="stable")
            flat, owner = flat[order], owner[order]
            first = np.flatnonzero(np.r_[True, flat[1:] != flat[:-1]]) if len(flat) else np.empty(0, np.int64)
            single = np.diff(np.r_[first, len(flat)]) == 1
            # sorted tokens lie in rising buckets
            parts = []
            for tokens, own in ((flat[first[single]], owner[first[single]]), (flat[first[~single]], None)):
                cut = np.searchsorted(tokens >> np.uint64(32), -(-np.arange(buckets + 1) * (1 << 32) // buckets))
                parts.append((tokens, own, cut.tolist()))
            (one, own, a), (more, _, b) = parts
            rows = [(group, k, low(one[a[k] : a[k + 1]]), own[a[k] : a[k + 1]].tobytes(), low(more[b[k] : b[k + 1]])) for k in range(buckets) if a[k] < a[k + 1] or b[k] < b[k + 1]]
            rows.append((group, -1, np.array(list(keys), np.int64).tobytes(), np.array([len(x) for x in held], np.int64).tobytes(), b""))
            return pd.DataFrame(rows, columns=["group", "bucket", "singles", "owners", "several"])

        size = 0
        for pdf in batches:
            for _, own in _sets(pdf["text"], shingle):
                key = set_key(own)
                if not len(own) or key in keys:
                    continue
                if held and (size + len(own) > GROUP_SHINGLES or len(held) == 65535):
                    yield flush()
                    group, size = group + 1, 0
                    held.clear()
                    keys.clear()
                keys[key] = None
                held.append(own)
                size += len(own)
        if held:
            yield flush()

    return run


def _alone(pdf: pd.DataFrame) -> pd.DataFrame:
    """group, counts: how many of a bucket's shingles each set of each group holds alone (pairs of numbers, 16 bits each)."""

    def wide(data) -> np.ndarray:
        rows = np.frombuffer(b"".join(data), np.uint8).reshape(-1, 5)
        out = np.zeros((len(rows), 8), np.uint8)
        out[:, :5] = rows
        return out.view("<u8").ravel()

    singles, several = wide(pdf["singles"]), wide(pdf["several"])
    _, inverse, counts = np.unique(np.concatenate([singles, several, several]), return_inverse=True, return_counts=True)
    alone = counts[inverse[: len(singles)]] == 1
    out, at = [], 0
    for group, owners in zip(pdf["group"], pdf["owners"], strict=True):
        own = np.frombuffer(owners, np.uint16)
        who, n = np.unique(own[alone[at : at + len(own)]], return_counts=True)
        at += len(own)
        out.append((group, np.stack([who, np.minimum(n, 65535)], axis=1).astype(np.uint16).tobytes()))
    return pd.DataFrame(out, columns=["group", "counts"])


def _left(percent: int):
    """key of the sets of a group that hold few enough shingles alone to be linked with any other."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        named = pdf["keys"].notna()
        keys, sizes = (np.frombuffer(pdf.loc[named, c].iat[0], np.int64) for c in ("keys", "sizes"))
        alone = np.zeros(len(keys), np.int64)
        for counts in pdf.loc[~named, "counts"]:
            pairs = np.frombuffer(counts, np.uint16).reshape(-1, 2).astype(np.int64)
            alone[pairs[:, 0]] += pairs[:, 1]
        return pd.DataFrame({"key": keys[alone <= sizes * (100 - percent) // 100]})

    return run


def sharing(texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """key of the sets of texts(text) that may be linked: of n shingles, linked sets hold n * (100 - percent) / 100 at most
    that no other set holds. Counted are those of one shingle hash in TOLD, each by its exact number of sets or more."""
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    told = written(mapped(texts.select("text"), _tokens(shingle, 1 + size // BUCKET_BYTES), "group long, bucket int, singles binary, owners binary, several binary"))
    counts = told.where("bucket >= 0").groupBy("bucket").applyInPandas(_alone, "group long, counts binary")
    nothing = F.lit(None).cast("binary")
    named = told.where("bucket < 0").select("group", nothing.alias("counts"), F.col("singles").alias("keys"), F.col("owners").alias("sizes"))
    counts = counts.select("group", "counts", nothing.alias("keys"), nothing.alias("sizes"))
    left = written(named.unionByName(counts).groupBy("group").applyInPandas(_left(percent), "key long").distinct())
    discard(told)
    return left


def _offer(shingle: int, percent: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[int] = set()  # rows that are the same throughout are one
        for pdf in batches:
            pdf = _new(pdf, seen)
            out = [(pdf["key"].iat[row], part_digests(own, percent).view(np.int64)) for row, own in _sets(pdf["text"], shingle)]
            yield pd.DataFrame(out, columns=["key", "parts"])

    return run


def _new(pdf: pd.DataFrame, seen: set[int]) -> pd.DataFrame:
    """The rows of a batch whose keys no earlier row of the task had."""
    pdf = pdf.drop_duplicates("key")
    pdf = pdf[~pdf["key"].isin(seen)]
    seen.update(pdf["key"])
    return pdf


def _fetch(shingle: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[int] = set()
        for pdf in batches:
            pdf = _new(pdf, seen)
            out = [(pdf["family"].iat[row], pdf["weight"].iat[row], pdf["key"].iat[row], own.tobytes()) for row, own in _sets(pdf["text"], shingle)]
            yield pd.DataFrame(out, columns=["family", "weight", "key", "own"])

    return run


def _tokens_of(shingle: int):
    """The shingles of sets, scrambled with their family so that families meet nowhere."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[int] = set()
        for pdf in batches:
            pdf = _new(pdf, seen)
            family = mix(pdf["family"].to_numpy(np.int64).view(np.uint64))
            out = [(pdf["key"].iat[row], pdf["family"].iat[row], len(own), mix(own ^ family[row]).view(np.int64)) for row, own in _sets(pdf["text"], shingle)]
            yield pd.DataFrame(out, columns=["key", "family", "n", "tokens"])

    return run


class _Forest:
    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def union(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


def grouped_prefix_join(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links (i, j) that connect every linked component of the sets; each is a true link, none closes a cycle."""
    flat = np.concatenate(sets)
    values, inverse, counts = np.unique(flat, return_inverse=True, return_counts=True)
    rank = np.empty(len(values), np.int64)
    rank[np.lexsort((values, counts))] = np.arange(len(values))
    bounds = np.cumsum([0] + [len(s) for s in sets])
    ranked = [np.sort(rank[inverse[a:b]]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    rare = counts[np.argsort(rank)] < 2  # by rank: no other set holds it
    groups: dict[tuple[int, bytes], list[int]] = defaultdict(list)
    for i, own in enumerate(ranked):
        n = len(own)
        groups[n, own[: n - -(-percent * n // 100) + 1].tobytes()].append(i)
    forest, links, index, mark = _Forest(len(sets)), [], defaultdict(list), np.zeros(len(values), bool)
    ordered = sorted(groups.items(), key=lambda g: g[0][0])
    for g, ((n, prefix), members) in enumerate(ordered):
        common: dict[int, int] = {}
        for place, token in enumerate(np.frombuffer(prefix, np.int64).tolist()):
            if rare[token]:
                continue
            for other, m, other_place in index[token]:
                met = common.get(other, 0)
                # what is left after this place must do for the rest
                if m * 100 >= percent * n and met >= 0:
                    common[other] = met + 1 if met + 1 + min(n - place, m - other_place) - 1 >= least_common(n, m, percent) else -1
            index[token].append((g, n, place))
        others = [t for other, met in common.items() if met > 0 for t in ordered[other][1]]
        for k, i in enumerate(members):
            root = forest.find(i)
            targets = [t for t in others + members[:k] if forest.find(t) != root]
            if not targets:
                continue
            mark[ranked[i]] = True
            sizes = np.array([len(ranked[t]) for t in targets])
            both = np.add.reduceat(mark[np.concatenate([ranked[t] for t in targets])].astype(np.int64), np.cumsum(sizes) - sizes)
            mark[ranked[i]] = False
            for t, c, m in zip(targets, both.tolist(), sizes.tolist(), strict=True):
                if 100 * c >= percent * (n + m - c) and forest.union(i, t):
                    links.append((i, t))
    return links


def _join(percent: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, family in pdf.groupby("family", sort=False):
            keys = family["key"].tolist()
            sets = [np.frombuffer(b, np.uint64) for b in family["own"]]
            out += [(keys[i], keys[j]) for i, j in grouped_prefix_join(sets, percent)]
        return pd.DataFrame(out, columns=["a", "b"])

    return run


def representatives(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows of docs with one row left of each linked component, that of its smallest doc_id, and all columns kept.

    Rows that are linked with nothing (null and wordless texts among them) stay; rows of one id and text are one.
    """
    found = _components(docs, shingle, percent)
    first = found.where("n_shingles = 0 or doc_id <=> component_id").select("doc_id", "h").distinct()
    row = F.struct("doc_id", F.xxhash64("text").alias("h"))
    kept = docs.select(F.struct("*").alias("doc"), row.alias("row")).join(first.select(F.struct("doc_id", "h").alias("row")), "row")
    # rows that are the same throughout are one
    return kept.dropDuplicates(["row"]).select("doc.*")


def _texts(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """rows(row, key) with their texts. Where rows are too many for a broadcast, the texts of others are kept out of the shuffle."""
    n = rows.count()
    texts = docs.select("doc_id", F.xxhash64("text").alias("h"), "text")
    if n > BROADCAST_ROWS:
        texts = likely(texts, rows.select("row.h"), n)
    texts = texts.select(F.struct("doc_id", "h").alias("row"), "text")
    return texts.join(rows if n > BROADCAST_ROWS else F.broadcast(rows), "row").select("key", "text")


def _families(offered: DataFrame) -> DataFrame:
    """key, family of the sets of offered(key, part) that are connected by common parts."""
    nearest = offered.groupBy("part").agg(F.min("key").alias("least"), F.max("key").alias("most")).where("least <> most").drop("most")
    met = offered.join(nearest, "part").where("key <> least")
    found = components(met.select(F.col("key").alias("a"), F.col("least").alias("b")))
    found = found.unionByName(found.select(F.col("root").alias("node"), "root").distinct())
    return found.select(F.col("node").alias("key"), F.col("root").alias("family"))


def _weighed(families: DataFrame, classes: DataFrame) -> DataFrame:
    """key, family, n and weight, all shingles of the family."""
    placed = classes.select("key", "n").join(families, "key")
    return placed.join(placed.groupBy("family").agg(F.sum("n").alias("weight")), "family").select("key", "family", "n", "weight")


def _prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """key, part: the shingles of sets(key, family, n, tokens) that others of the family hold too, among the n * (100 - percent) / 100
    and one that fewest of the family hold. Linked sets have one of these in common, others seldom do."""
    each = sets.select("key", "n", F.explode("tokens").alias("token")).select("key", "n", F.col("token").alias("part"))
    held = each.groupBy("part").agg(F.count(F.lit(1)).alias("held")).where("held > 1")
    shared = each.join(held, "part").groupBy("key", "n").agg(F.sort_array(F.collect_list(F.struct("held", "part"))).alias("shared"))
    # those that the set holds alone come first
    most = F.col("n") - F.ceil(F.col("n") * F.lit(percent) / F.lit(100)) + 1 - (F.col("n") - F.size("shared"))
    return shared.where(most > 0).select("key", F.explode(F.slice("shared", F.lit(1), most.cast("int"))).alias("first")).select("key", "first.part")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id: a row for each row of docs(doc_id, text).

    Words are split at white space, A-Z folded; a text shorter than a shingle is one. Null and wordless texts have
    no shingle and are linked with nothing: their component is their own doc_id. Repeated rows are in one component.
    Null ids take part, and no component is named by one unless all its ids are null.
    """
    return _components(docs, shingle, percent).drop("h")


def _components(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    scanned = map_rows(docs.select("doc_id", F.xxhash64("text").alias("h"), "text"), _scan(shingle), "doc_id long, h long, n_shingles long, key long")
    found = written(scanned)
    # firsts of one aggregate come from one row
    classes = found.where("n_shingles > 0").groupBy("key").agg(F.min("doc_id").alias("first_doc"), F.first("doc_id").alias("doc_id"), F.first("h").alias("h"), F.first("n_shingles").alias("n"))
    classes = written(classes.select("key", "first_doc", F.struct("doc_id", "h").alias("row"), "n"))

    # twice: copies make shingles look shared until they are counted as one
    left = classes.join(sharing(docs, shingle, percent), "key")
    left = written(left.select("key", "row"))
    held = written(_texts(docs, left))

    def texts_of(rows: DataFrame) -> DataFrame:
        return held.join(F.broadcast(rows) if fits(rows, BROADCAST_ROWS) else rows, "key")

    left = written(left.join(sharing(held, shingle, percent), "key").select("key"))
    offers = written(mapped(texts_of(left).select("key", "text"), _offer(shingle, percent), "key long, parts array<long>"))
    placed = written(_weighed(_families(offers.select("key", F.explode("parts").alias("part"))), classes))
    discard(offers)
    large = F.col("weight") > FAMILY_SHINGLES
    if placed.where(large).limit(1).count():
        prefixes = written(_prefixes(mapped(texts_of(placed.where(large).select("key", "family")), _tokens_of(shingle), "key long, family long, n long, tokens array<long>"), percent))
        placed = written(placed.where(~large).unionByName(_weighed(_families(prefixes), classes)))
        discard(prefixes)
    total = placed.agg(F.sum("n")).first()[0] or 0
    links = None
    if total:
        texts = texts_of(placed.select("key", "family", "weight"))
        sets = mapped(texts.select("family", "weight", "key", "text"), _fetch(shingle), "family long, weight long, key long, own binary")
        tasks = max(1, total // TASK_SHINGLES)
        whole = F.array(F.struct(F.pmod(F.xxhash64("family"), F.lit(tasks)).alias("deal"), F.lit(0).alias("other")))
        blocks = F.ceil(F.col("weight") * 2 / FAMILY_SHINGLES).cast("int")
        block = F.pmod(F.xxhash64("key"), blocks).cast("int")
        paired = F.transform(F.sequence(F.lit(0), blocks - 1), lambda k: F.struct((F.hash("family").cast("long") * 65536 + F.least(block, k)).alias("deal"), F.greatest(block, k).alias("other")))
        to = F.explode(F.when(F.col("weight") <= FAMILY_SHINGLES, whole).otherwise(paired)).alias("to")
        dealt = sets.select("family", "key", "own", to).select("family", "key", "own", "to.deal", "to.other")
        links = written(dealt.groupBy("deal", "other").applyInPandas(_join(percent), "a long, b long"))
    discard(held)
    out = found.select("doc_id", "h", "n_shingles", "key")
    named = classes.select("key", "first_doc")
    if links is not None:
        roots = components(links)
        named = classes.select("key", "first_doc").join(roots.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
        named = named.select("key", "root").join(named.groupBy("root").agg(F.min("first_doc").alias("first_doc")), "root")
    return out.join(named, "key", "left").select("doc_id", "h", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("first_doc")).otherwise(F.col("doc_id")).alias("component_id"))
