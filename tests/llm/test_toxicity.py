"""Noisy-channel deobfuscation against all readings, restoration of disguised words, and held-out labels."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from popforge.llm import toxicity
from popforge.llm.queries import QUERIES
from popforge.llm.shared import crc_mod

DATA = "/root/testdata/sf0.01"
INSULTS = ["idiot", "moron", "pathetic", "worthless", "scum"]


@pytest.fixture(scope="module")
def corpus(spark):
    """Plain English sentences, some with an insult, as documents with labels."""
    rng = random.Random(2)
    words = "the a of and to in is was for on with that this house river market morning letter people little garden window answer village".split()
    texts, labels = [], []
    for k in range(1000):
        text = [rng.choice(words) for _ in range(rng.randint(20, 80))]
        if toxic := k % 5 == 0:
            for _ in range(rng.randint(1, 3)):
                text.insert(rng.randrange(len(text)), rng.choice(INSULTS))
        texts.append((k, " ".join(text).capitalize() + ".", "x", 0.5))
        labels.append((k, int(toxic), 1))
    docs = spark.createDataFrame(texts, "doc_id long, text string, words string, restored double")
    return docs, spark.createDataFrame(labels, "doc_id long, toxic int, quality int")


@pytest.fixture(scope="module")
def model(corpus):
    return toxicity.fit(*corpus)


def test_viterbi_against_all_readings(model):
    """The reading found is the best of all, by the same costs."""
    language = model.language

    def best(observed):
        top = None
        for way in itertools.product(*toxicity._offers(observed)):
            state, score, out = 0, 0.0, ""
            for code, letter, cost in way:
                score += cost
                if code > 0 or (code == 0 and state):
                    score += language.log_chance(state * toxicity.CODES + code)
                    state = (state * toxicity.CODES + code) % toxicity.CODES ** (toxicity.ORDER - 1) if code else 0
                    out += letter
            score += language.log_chance(state * toxicity.CODES) if state else 0.0
            if top is None or score > top[0] + 1e-9:
                top = (score, out.strip())
        return top[1]

    for observed in ["1d10t", "m0r0n", "s c u m", "iiidiot", "5cum", "a$", "mo-ron", "p4th*tic", "rivver", "lé tter", "x9z", "$$"]:
        assert toxicity.decode(observed, language) == best(observed)


def test_chances_are_a_distribution(model):
    for context in (0, 9, 9 * 64 + 4, ((9 * 64 + 4) * 64 + 9) * 64 + 15, 63 * 64**3):
        total = sum(np.exp(model.language.log_chance(context * toxicity.CODES + code)) for code in range(toxicity.CODES))
        assert abs(total - 1) < 1e-6


def test_disguised_words_are_restored(model):
    rng = random.Random(1)
    looks = {"o": "0", "i": "1!", "e": "3", "a": "4@", "s": "5$", "t": "7+"}
    ways = [
        lambda w: "".join(rng.choice(looks[c]) if c in looks and rng.random() < 0.7 else c for c in w),
        lambda w: rng.choice([" ", ".", "-", "_", "*"]).join(w),
        lambda w: "".join(c * rng.choice([1, 1, 4]) for c in w),
        lambda w: w.replace("o", "oo", 1).replace("e", "ee", 1),
        lambda w: " ".join(looks.get(c, c)[0] for c in w),
        lambda w: w.upper(),
    ]
    restorer = toxicity.Restorer(model.language)
    found = [w in toxicity._WORD.findall(restorer.text(f"on the {way(w)}, and")) for w in INSULTS for way in ways for _ in range(5)]
    assert sum(found) >= 0.95 * len(found)
    plain = "The little window, on a morning: 1984, 3 letters & 20 people."
    assert toxicity._WORD.findall(restorer.text(plain)) == toxicity._WORD.findall(plain.lower())


def test_disguise_does_not_help(spark, corpus, model):
    clean = "the house on the river and the market was in this village for people with a letter"
    odd = ["you 1d10t", "what a m0r0n", "p a t h e t i c", "w-o-r-t-h-l-e-s-s", "scuuuuum", "$cum", "IDIOT!!!", "idiot"]
    docs = spark.createDataFrame([(k, f"{clean} {w} {clean}") for k, w in enumerate(odd)] + [(100, clean), (101, clean.upper()), (102, "t h e  h o u s e, 7he market")], "doc_id long, text string")
    got = {r.doc_id: (r.score >= toxicity.TOXIC, r.words) for r in toxicity.score(docs, model).collect()}
    assert all(got[k][0] for k in range(len(odd))) and not any(got[k][0] for k in (100, 101, 102))
    assert got[0][1] == ["idiot"]


def test_copies_of_one_text_are_one_witness(spark, corpus):
    """A mislabelled text with many near copies teaches nothing; a beginning that toxic texts share does."""
    docs, labels = corpus
    rng = random.Random(4)
    base = ["zebra", "quartz", *("the house on the river and the market was in this village for people with a letter".split() * 3)]
    more = [(1000 + k, " ".join([*base[: 20 + k % 3], "garden", *base[20 + k % 3 :]])) for k in range(40)]
    stems = [(2000 + k, " ".join(rng.sample(base[2:], 20) + [f"grumpf{chr(97 + k % 20)}", f"grumpf{chr(98 + k % 20)}x"])) for k in range(40)]
    extra = spark.createDataFrame(more + stems, "doc_id long, text string")
    fitted = toxicity.fit(docs.select("doc_id", "text").union(extra), labels.select("doc_id", "toxic").union(extra.select("doc_id", F.lit(1))))
    assert not any(t.startswith(("zebra", "quartz")) for t in fitted.evidence)
    assert fitted.evidence.get("grumpf+", 0) > 0


def test_odd_rows(spark, corpus, model):
    docs = spark.createDataFrame([(1, None), (1, ""), (1, "idiot"), (1, "idiot"), (None, "idiot"), (None, None), (2, " \n"), (3, "1234 !!! ***"), (4, "i d " * 50_000 + "x" * 200_000)], "doc_id long, text string")
    got = toxicity.score(docs, model, with_text=True).collect()
    assert len(got) == 9 and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.n_words == 0}) == 1 and len({r.score for r in got if r.words == ["idiot"]}) == 1
    assert sorted((r.doc_id is None, r.restored) for r in got if r.restored == "idiot") == [(False, "idiot")] * 2 + [(True, "idiot")]
    assert toxicity.score(docs.limit(0), model).collect() == []


def test_labels_that_teach_nothing(spark, corpus):
    docs, labels = corpus
    none = labels.limit(0)
    assert {r.score for r in toxicity.judge(docs, none).collect()} == {0.5}
    assert {r.predicted for r in toxicity.judge(docs, labels.withColumn("toxic", F.lit(0))).collect()} == {0}
    assert toxicity.judge(docs.limit(0), labels).collect() == []
    odd = labels.withColumn("toxic", F.when(F.col("doc_id") < 600, F.col("toxic"))).union(spark.createDataFrame([(None, 1, 1), (0, 0, 0), (9999, 1, 1)], labels.schema))
    found = {r.doc_id: r.predicted for r in toxicity.judge(docs, odd).collect()}
    assert sum(found[r.doc_id] == r.toxic for r in labels.collect()) >= 980


def test_batches_of_one_kind(spark):
    """Evidence doesn't depend on which labelled texts come together, nor on batches without toxic ones, others or words."""
    rows = [(k, "idiot house" if k < 20 else "river house" if k < 60 else "1984", int(k < 20)) for k in range(80)]
    schema = "doc_id long, text string, toxic int"
    # in four partitions: of toxic texts, of others twice, of texts without words
    apart = toxicity._evidence(spark.createDataFrame(spark.sparkContext.parallelize(rows, 4), schema))
    together = toxicity._evidence(spark.createDataFrame(rows, schema).coalesce(1))
    assert apart == together and apart["idiot "] > 0 and "house " not in apart


def test_held_out_labels(spark):
    """Only labels outside the held-out third are read, and those of the third are met."""
    got = QUERIES["op11_toxicity"](spark, DATA).join(spark.read.parquet(f"{DATA}/labels.parquet"), "doc_id").toPandas()
    held = got[got.held_out]
    assert ((held.predicted == 1) & (held.toxic == 0)).sum() <= 1
    assert ((held.predicted == 1) & (held.toxic == 1)).sum() >= 0.65 * (held.toxic == 1).sum()
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    learn = crc_mod("doc_id", 3) != 1
    lies = labels.withColumn("toxic", F.when(learn, F.col("toxic")).otherwise(1 - F.col("toxic")))
    assert toxicity.fit(docs, lies, learn).evidence == toxicity.fit(docs, labels, learn).evidence
