"""Disk and memory that larger tables showed, held on small ones."""

import random
import tracemalloc
from types import SimpleNamespace

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from popforge.llm import hard_negatives, jaccard_join
from popforge.llm.shared import likely


def test_likely_keeps_all_asked_for_and_few_others(spark):
    rows = spark.range(100_000).select("id", F.xxhash64("id").alias("h"))
    asked = rows.where("id % 10 = 3")
    got = {r.id for r in likely(rows, asked.select("h"), 10_000).collect()}
    assert {k for k in range(100_000) if k % 10 == 3} <= got
    assert len(got) < 10_000 + 0.05 * 90_000
    assert likely(rows, asked.where("id < 0").select("h"), 0).count() == 0


def test_texts_that_can_not_be_linked_are_not_shuffled(spark, monkeypatch):
    """Without a broadcast, near_duplicates moved all texts five times."""
    monkeypatch.setattr(jaccard_join, "BROADCAST_ROWS", 0)
    rng = random.Random(3)
    own = [" ".join(f"{rng.getrandbits(40):x}" for _ in range(1500)) for _ in range(120)]
    texts = own + [t + " more" for t in own[:6]] + own[:3]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")

    def moved() -> int:
        held = spark.sparkContext._jsc.sc().statusStore().executorList(False)
        return sum(held.apply(k).totalShuffleWrite() for k in range(held.size()))

    before = moved()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        got = {r.doc_id: r.component_id for r in jaccard_join.near_duplicates(docs).collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert moved() - before < sum(map(len, texts))
    assert got == {k: k for k in range(120)} | {120 + k: k for k in range(6)} | {126 + k: k for k in range(3)}


def test_large_families_are_parted_before_their_pairs_are_made(spark, monkeypatch):
    """Texts that share passages are candidates of each other; cut into blocks, each set of such a family went to all of them."""
    rng = random.Random(4)
    word = lambda: f"{rng.getrandbits(40):x}"
    passages = [[word() for _ in range(30)] for _ in range(6)]
    texts = []
    for _ in range(60):
        own = [w for p in rng.sample(passages, 3) for w in p] + [word() for _ in range(60)]
        texts += [" ".join(own), " ".join(own[:-1] + [word()])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    monkeypatch.setattr(jaccard_join, "FAMILY_SHINGLES", 1000)
    dealt, join = [], jaccard_join._join

    def watched(percent):
        run, rows = join(percent), spark.sparkContext.accumulator(0)
        dealt.append(rows)

        def counted(pdf):
            rows.add(len(pdf))
            return run(pdf)

        return counted

    monkeypatch.setattr(jaccard_join, "_join", watched)
    got = {r.doc_id: r.component_id for r in jaccard_join.near_duplicates(docs, 5, 80).collect()}
    assert got == {k: k - k % 2 for k in range(120)}
    assert 0 < dealt[0].value <= 2 * len(texts)


def test_nearest_centroids_take_little_memory():
    """All distances at once took 24 bytes for each pair of a sampled row and a centroid on the driver."""
    rng = np.random.default_rng(2)
    x, centroids = rng.integers(-99, 99, (8000, 4)).astype(np.float64), rng.integers(-99, 99, (2000, 4)).astype(np.float64)
    tracemalloc.start()
    at = hard_negatives._nearest(x, centroids)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40e6
    for k in range(0, 8000, 400):
        assert at[k] == ((centroids - x[k]) ** 2).sum(1).argmin()


def test_visits_send_only_their_anchors_and_some_bytes_at_a_time(monkeypatch):
    # 64 anchors whose best lists are all different, in 64 shards
    dim, n = 64, 64
    centroids = np.eye(n, dim) * 100
    index = SimpleNamespace(centroids=centroids, radii=np.ones(n), sizes=np.ones(n), first=np.arange(n), parts=np.ones(n, np.int64))
    vecs, longs = centroids.astype(np.int32), np.arange(n).tobytes()
    pack = pd.DataFrame([{"pack": 5, "uids": longs, "labels": longs, "vecs": vecs.tobytes(), "slots": list(range(n)), "lows": None, "highs": None, "with_floor": None, "floors": None}])
    monkeypatch.setattr(hard_negatives, "SENT", 4 * 4 * dim, raising=False)
    sent = list(hard_negatives._visits(index, 0, 1)(iter([pack])))
    # the whole pack went to each shard before, all of it at once
    assert len(sent) > 8 and max(f["vecs"].map(len).sum() for f in sent) <= 8 * 4 * dim
    every = pd.concat(sent)
    assert sorted(every["shard"]) == list(range(n)) and all(len(v) == 4 * dim for v in every["vecs"])
    assert all(list(r.queries) == [r.shard] and list(r.slots) == [0] and list(r.lists) == [r.shard] for r in every.itertuples())
