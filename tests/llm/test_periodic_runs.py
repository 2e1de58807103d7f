"""Periodic runs against brute force over all periods and positions."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from popforge.llm import periodic_runs
from popforge.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, start string, runs int, period string"


def brute_runs(words):
    """(start, length, period) of every run, by start and period."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            part = words[i : j + q]
            if j > i and length >= max(6, 4 * q) and not any(part[r:] == part[:-r] for r in range(1, q)):
                out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute(doc_id, text, plant=True):
    words = (text or "").encode().split()
    n = len(words)
    if plant and doc_id is not None and n:
        g, rest = divmod(zlib.crc32(str(doc_id).encode()), 10)
        if rest == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    top = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(runs), *top, sha("".join(f"{a},{b},{q}\n" for a, b, q in runs).encode()), sha(b" ".join(w for i, w in enumerate(words) if i not in gone)))


def periodic(rng, depth):
    """Words in which runs lie within runs."""
    if depth == 0:
        return [rng.choice(["a", "b", "é"]) for _ in range(rng.randint(1, 4))]
    unit = periodic(rng, depth - 1) + ([rng.choice("ab")] if rng.random() < 0.5 else [])
    return unit * rng.randint(1, 7) + [rng.choice("ab") for _ in range(rng.randint(0, 3))]


def test_runs_of_many_documents_together():
    rng = random.Random(3)
    for _ in range(300):
        docs = [periodic(rng, rng.randint(0, 3))[: rng.randint(1, 200)] for _ in range(rng.randint(1, 6))]
        number = {"a": 0, "b": 1, "é": 2}
        got = periodic_runs.found_in([(k, np.array([number[w] for w in d], np.int32)) for k, d in enumerate(docs)])
        for words, of in zip(docs, got, strict=True):
            assert sorted(((a, b - a, q) for a, b, q in of), key=lambda r: (r[0], r[2])) == brute_runs(words)


def test_grid_points_inside_other_runs_are_not_lost():
    """Every grid point of the longer period lies in a run of a period that doesn't divide it."""
    words = (["a"] * 6 + ["b", "c", "d"]) * 5
    assert [(a, b - a, q) for a, b, q in periodic_runs.runs(np.unique(words, return_inverse=True)[1]) if q == 9] == [(0, 45, 9)]


@pytest.mark.parametrize("piece, batch", [(1 << 20, 1 << 19), (5, 40)])
def test_scan_against_brute_force(spark, monkeypatch, piece, batch):
    monkeypatch.setattr(periodic_runs, "PIECE", piece)
    monkeypatch.setattr(periodic_runs, "BATCH_WORDS", batch)
    rng = random.Random(7)
    texts = [" ".join(periodic(rng, rng.randint(0, 3))[: rng.randint(1, 150)]) for _ in range(80)]
    texts += [None, "", " \n\t", "x", "A a A a A a A a", "tie tie tie tie tie tie . no no no no no no", "a\tb\na\x0bb\x0ca\rb a b", "a b " * 9, "nb sp " * 7]
    rows = [(k, t) for k, t in enumerate(texts)] + [(3, texts[3]), (3, texts[3]), (None, texts[5]), (None, None), (-7, texts[8])]
    docs = spark.createDataFrame([(i, t, "s", 1, "p") for i, t in rows], SCHEMA)
    for plant in (True, False):
        got = sorted((tuple(r)[:8] for r in periodic_runs.scan(docs, plant).collect()), key=repr)
        assert got == sorted((brute(i, t, plant) for i, t in rows), key=repr)


def test_runs_and_text(spark):
    docs = spark.createDataFrame([(1, "x " + "go on " * 4 + "y y y y y y z")], "doc_id long, text string")
    (row,) = periodic_runs.scan(docs, with_text=True).collect()
    assert [tuple(r) for r in row.runs] == [(1, 8, 2), (9, 6, 1)] and row.collapsed == "x go on y z" and row.n_dropped == 11
    assert periodic_runs.scan(docs.limit(0)).collect() == []


def test_one_long_text(spark):
    """A text that repeats one word, whose every grid point of every period would pass, and one of many words."""
    docs = spark.createDataFrame([(1, "w " * 200_000), (2, " ".join(map(str, range(200_000))))], "doc_id long, text string")
    got = {r.doc_id: (r.n_runs, r.length, r.period, r.n_dropped) for r in periodic_runs.scan(docs).collect()}
    assert got == {1: (1, 200_000, 1, 199_999), 2: (0, None, None, 0)}


def test_query_on_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = sorted(tuple(r)[:8] for r in QUERIES["op13_periodic_runs"](spark, "/root/testdata/sf0.001").collect())
    short = docs.where(F.length("text") < 20_000).select("doc_id", "text").collect()
    want = {r.doc_id: brute(r.doc_id, r.text) for r in short}
    assert len(got) == docs.count() and [r for r in got if r[0] in want] == sorted(want.values())
