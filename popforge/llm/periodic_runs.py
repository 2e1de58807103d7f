"""Periodic runs of words: harmonic grid probing.

A run is a stretch of consecutive words with smallest period q and length >= max(6, 4 * q) that no neighbouring word
extends keeping period q. For each period p, words at the grid points 0, p, 2p, ... are compared with the words p later:
n / p tests, so n * log(n) for all periods. A run of length 4 * p holds three grid points in a row that pass, whatever its
start; only where three pass, the stretch is extended both ways, by comparing chunks that double. Periods are taken in
growing order. A grid point jp is skipped if a run found before, whose period divides p, holds the words jp to jp + p - 1:
such a stretch repeats a period of p words that itself repeats the smaller one, so it is that run again (Fine and Wilf).

The documents of a batch are probed together, the longest first, each ended by a word of its own, so that short texts cost
no loop of their own. Words are numbered exactly, not hashed. A text is read in pieces; of a text only its word numbers,
its distinct words and its runs are held.
"""

from __future__ import annotations

import hashlib
import itertools
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from popforge.llm.shared import NO_ID, map_rows

#: Shortest run, and the least number of times that its period goes into it.
LEAST_LENGTH, LEAST_TIMES = 6, 4
#: Code points of a text that are split into words at a time, and words of the documents that are probed together.
PIECE, BATCH_WORDS = 1 << 20, 1 << 19
_SPACES = "\t\n\v\f\r "
_FIRST_CHUNK = 64

FIELDS = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string, "
    "n_words long, n_dropped long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
)
BRIEF = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "n_words", "n_dropped"]
FULL = [*BRIEF, "runs", "collapsed"]


def pieces(text: str | None) -> Iterator[list[bytes]]:
    """The words of a text in order, some at a time; a word is never cut."""
    if not text:
        return
    at = 0
    while at < len(text):
        end = at + PIECE
        while end < len(text) and text[end] not in _SPACES:
            end += 1
        yield text[at:end].encode("utf-8", "replace").split()
        at = end


def planted(ids: np.ndarray, doc_id: int | None) -> np.ndarray:
    """The words with the contract's period written into every tenth document, by the crc32 of its decimal id."""
    n = len(ids)
    if doc_id is None or not n:
        return ids
    g, rest = divmod(zlib.crc32(str(doc_id).encode()), 10)
    if rest:
        return ids
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return np.concatenate((ids[:a], ids[a + np.arange(n - a) % p]))


def _reach(ids: np.ndarray, at: int, p: int, step: int) -> int:
    """The first i from `at` on, going by step (1 or -1), where words i and i + p differ; compared in chunks that double."""
    size, last = _FIRST_CHUNK, len(ids) - p
    while True:
        if step > 0:
            end = min(at + size, last)
            differ = np.flatnonzero(ids[at:end] != ids[at + p : end + p])
            if len(differ):
                return at + int(differ[0])
            if end == last:
                return last
            at = end
        else:
            end = max(at - size, -1)
            differ = np.flatnonzero(ids[end + 1 : at + 1] != ids[end + 1 + p : at + 1 + p])
            if len(differ):
                return end + 1 + int(differ[-1])
            if end < 0:
                return -1
            at = end
        size *= 2


def runs(ids: np.ndarray, most: int | None = None, lengths: np.ndarray | None = None) -> list[tuple[int, int, int]]:
    """(start, end, period) of every run, by period and start.

    ids: word numbers; where documents lie one after the other, longest first, lengths gives their words (each ended by a
    word of its own), and only those that are long enough for a period are probed for it.
    """
    n = len(ids)
    lengths = np.array([n]) if lengths is None else lengths
    ends = np.cumsum(lengths)
    most = int(lengths[0]) // LEAST_TIMES if most is None and len(lengths) else most or 0
    found: list[tuple[int, int, int]] = []
    # runs found, under the next multiple of their period that is no longer than they are
    due: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    for p in range(1, most + 1):
        long_enough = int(np.searchsorted(-lengths, -LEAST_TIMES * p, side="right"))
        part = ids[: int(ends[long_enough - 1])] if long_enough else ids[:0]
        grid = part[::p]
        same = grid[1:] == grid[:-1]
        known = due.pop(p, ())
        for run in known:
            start, end, q = run
            same[-(-start // p) : max((end - p) // p + 1, 0)] = False
            if p + q <= end - start:
                due[p + q].append(run)
        passed = np.flatnonzero(same[2:] & same[1:-1] & same[:-2]) * p
        done = -1
        for at in passed.tolist():
            if at < done:
                continue
            right = _reach(part, at, p, 1)
            left = _reach(part, at, p, -1) + 1
            done = right
            if right + p - left >= max(LEAST_LENGTH, LEAST_TIMES * p):
                run = (left, right + p, p)
                found.append(run)
                if 2 * p <= right + p - left:
                    due[2 * p].append(run)
    return found


def _row(doc_id: int, ids: np.ndarray, of: list[tuple[int, int, int]], words: list[bytes], with_text: bool) -> tuple:
    of = sorted(((start, end - start, q) for start, end, q in of), key=lambda run: (run[0], run[2]))
    drop = np.zeros(len(ids), bool)
    best = None
    for run in of:
        start, length, q = run
        drop[start + q : start + length] = True
        # of equal length / period the first by start, then period, stays
        if best is None or length * best[2] > best[1] * q:
            best = run
    kept = ids[~drop]
    sha, joined = hashlib.sha256(), []
    for at in range(0, len(kept), PIECE):
        text = (b" " if at else b"") + b" ".join(map(words.__getitem__, kept[at : at + PIECE].tolist()))
        sha.update(text)
        if with_text:
            joined.append(text)
    of_sha = hashlib.sha256("".join(f"{a},{b},{q}\n" for a, b, q in of).encode()).hexdigest()
    top = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    full = ([{"start": a, "length": b, "period": q} for a, b, q in of], b"".join(joined).decode("utf-8", "replace")) if with_text else (None, None)
    return (doc_id, len(of), *top, of_sha, sha.hexdigest(), len(ids), int(drop.sum()), *full)


def _batches(ids, texts) -> Iterator[tuple[list[tuple[int, np.ndarray]], list[bytes]]]:
    """Documents with their words' numbers, of some BATCH_WORDS together, and the words by number."""
    held: list[tuple[int, np.ndarray]] = []
    number: dict[bytes, int] = defaultdict(itertools.count().__next__)
    size = 0
    for doc_id, text in zip(ids, texts, strict=True):
        parts = [np.fromiter(map(number.__getitem__, w), np.int32, len(w)) for w in pieces(text)]
        held.append((int(doc_id), np.concatenate(parts) if parts else np.empty(0, np.int32)))
        size += len(held[-1][1])
        if size >= BATCH_WORDS:
            yield held, list(number)
            held, size, number = [], 0, defaultdict(itertools.count().__next__)
    if held:
        yield held, list(number)


def found_in(held: list[tuple[int, np.ndarray]]) -> list[list[tuple[int, int, int]]]:
    """The runs of each document, numbered from its own first word."""
    order = sorted(range(len(held)), key=lambda k: -len(held[k][1]))
    lengths = np.array([len(held[k][1]) + 1 for k in order], np.int64)
    line = np.concatenate([part for k in order for part in (held[k][1], np.array([-1 - k], np.int32))])
    starts = np.cumsum(lengths) - lengths
    out: list[list[tuple[int, int, int]]] = [[] for _ in held]
    for start, end, q in runs(line, lengths=lengths):
        at = int(np.searchsorted(starts, start, side="right")) - 1
        out[order[at]].append((start - int(starts[at]), end - int(starts[at]), q))
    return out


def scan(docs: DataFrame, plant: bool = False, with_text: bool = False) -> DataFrame:
    """Every document's periodic runs, the strongest of them, and what is left when each keeps its first period only.

    docs: doc_id, text; other columns, whatever their names, take no part. plant: write the contract's periods into every
    tenth document first. with_text: the runs themselves and the collapsed text too, else these two columns are missing.
    A null or empty text, or one of white space, has no words and no runs: four nulls, hashes of nothing. Repeated rows and
    rows with a null doc_id are scanned each for itself (nothing is planted under a null id); no rows: no rows. Of runs
    with equal length / period the one with the smallest start, then period, is the strongest. A text of any length is
    scanned whole, in one task, with some five bytes a word and its distinct words in memory.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for held, words in _batches(frame["doc_id"], frame["text"]):
                if plant:
                    held = [(i, planted(ids, None if i == NO_ID else i)) for i, ids in held]
                rows = [_row(i, ids, of, words, with_text) for (i, ids), of in zip(held, found_in(held), strict=True)]
                out = pd.DataFrame(rows, columns=FULL)
                for name in ("start", "length", "period", "exponent_milli"):
                    out[name] = out[name].astype("Int64")
                yield out

    found = map_rows(docs.select("doc_id", "text"), run, FIELDS)
    return found if with_text else found.select(BRIEF)
