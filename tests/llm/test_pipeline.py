"""The pipeline's stages do what their operators say, and the whole repository does without them."""

import os
import random

import pytest
from pyspark.sql import functions as F

from popforge.llm import jaccard_join

corpus_pipeline = pytest.importorskip("corpus_pipeline")
DATA = "/root/testdata/sf0.001"


def test_near_duplicates_go_at_five_words_and_four_fifths(spark):
    """Brute force over all pairs; copies lie between this measure and the stricter one of op5's contract."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    texts = []
    for _ in range(12):
        own = [word() for _ in range(200)]
        texts.append(" ".join(own))
        for changes in (1, 4, 5, 12):
            near = list(own)
            for at in rng.sample(range(200), changes):
                near[at] = word()
            texts.append(" ".join(near))
    texts += ["", None, "one two"]
    sets = [{tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if (w := (t or "").split()) else set() for t in texts]
    up = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                old, new = max(up[i], up[j]), min(up[i], up[j])
                up = [new if u == old else u for u in up]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = {r.doc_id for r in corpus_pipeline.keep_one_of_near_duplicates(spark, docs, DATA).collect()}
    assert kept == {i for i in range(len(texts)) if up[i] == i}
    stricter = {r.component_id for r in jaccard_join.near_duplicates(docs).collect()}
    assert len(kept) < len(stricter)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_stages_in_turn(spark):
    from popforge.llm import decontamination, pii
    from popforge.llm.shared import written

    docs = spark.read.parquet(f"{DATA}/documents.parquet").withColumn("score", F.lit(1.5)).withColumn("row", F.col("doc_id"))
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        seen.append(written(stage(spark, seen[-1], DATA)))
        if name != "mixing":
            assert seen[-1].columns == docs.columns
    start, known, single, clean, redacted, mixed = seen
    assert known.count() >= 0.98 * start.where("text rlike '[a-z]'").count()
    components = jaccard_join.near_duplicates(known, corpus_pipeline.SHINGLE, corpus_pipeline.PERCENT)
    assert sorted(r.doc_id for r in single.collect()) == sorted(r.component_id for r in components.select("component_id").distinct().collect())
    bench = spark.read.parquet(f"{DATA}/benchmark.parquet")
    dirty = {r.doc_id for r in decontamination.contamination(single, bench).where("contaminated").collect()}
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in single.collect()} - dirty
    for r in redacted.collect():
        assert not any(pii.base_spans(r.text or "").values()) and r.n_chars == len(r.text)
    assert mixed.where("taken > 2 * size or taken = 0 and size > 0").count() == 0
    whole = corpus_pipeline.run(spark, DATA)
    assert {(r.doc_id, r.taken) for r in whole.collect()} == {(r.doc_id, r.taken) for r in mixed.collect()}
