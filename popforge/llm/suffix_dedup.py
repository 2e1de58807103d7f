"""Suffix-array dedup of byte repeats, by a hash-compared suffix sort.

Suffixes that start at winnowed anchors are sorted, not all suffixes: every repeated string of `window` bytes
holds an anchor at the same offset in each place (see repeats.py). The sort is a merge sort. Two suffixes are
compared by a binary search over their prefix polynomial hashes for the longest common prefix, then by the
byte after it: logarithmic in the length. Neighbours' common prefixes are checked byte by byte; should a hash
have collided, the group is sorted again by its bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from popforge.llm.repeats import Kind, removed_mask, with_ranges
from popforge.llm.shared import map_rows
from popforge.llm.textarrays import _CODES, BASE, encode, powers

WINDOW, GRAM = 400, 32


def byte_tokens(held: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    bounds = np.zeros(len(held) + 1, np.int64)
    np.cumsum([len(x) for x in held], out=bounds[1:])
    return np.frombuffer(b"".join(held), np.uint8), bounds


def byte_codes(tokens: np.ndarray) -> np.ndarray:
    return _CODES[tokens]


def _common(hashes: np.ndarray, lengths: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Longest common prefix of rows a and b, by binary search for the last equal prefix hash."""
    low, high = np.zeros(len(a), np.int64), np.minimum(lengths[a], lengths[b])
    while (low < high).any():
        mid = (low + high + 1) // 2
        same = hashes[a, mid] == hashes[b, mid]
        low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
    return low


def _less(matrix: np.ndarray, hashes: np.ndarray, lengths: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """-1, 0, 1 as row a sorts before, with or after row b."""
    common = _common(hashes, lengths, a, b)
    last = matrix.shape[1] - 1
    next_a = np.where(common < lengths[a], matrix[a, np.minimum(common, last)].astype(np.int64), -1)
    next_b = np.where(common < lengths[b], matrix[b, np.minimum(common, last)].astype(np.int64), -1)
    return np.sign(next_a - next_b)


def merge_order(group: np.ndarray, matrix: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Row order by group, then by bytes: bottom-up merges inside groups, each row ranked in the sibling run."""
    m = len(group)
    hashes = np.zeros((m, matrix.shape[1] + 1), np.uint64)
    hashes[:, 1:] = _CODES[matrix]
    hashes[:, 1:] *= powers(BASE, matrix.shape[1])
    np.cumsum(hashes, axis=1, out=hashes)
    order = np.argsort(group, kind="stable")
    starts = np.flatnonzero(np.r_[True, group[order][1:] != group[order][:-1]])
    sizes = np.diff(np.r_[starts, m])
    base, size = np.repeat(starts, sizes), np.repeat(sizes, sizes)
    place = np.arange(m) - base
    run = 1
    while run < sizes.max():
        pair = place // (2 * run) * (2 * run)
        first_half = place - pair < run
        other = np.where(first_half, pair + run, pair)
        other_end = np.minimum(other + run, size)
        low, high = other.copy(), np.maximum(other_end, other)
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            mid = (low[open_] + high[open_]) // 2
            sign = _less(matrix, hashes, lengths, order[base[open_] + mid], order[open_])
            # rows of the first run go before equal ones of the second
            before = np.where(first_half[open_], sign < 0, sign <= 0)
            low[open_] = np.where(before, mid + 1, low[open_])
            high[open_] = np.where(before, high[open_], mid)
        target = base + pair + (place - np.where(first_half, pair, pair + run)) + (low - other)
        merged = np.empty_like(order)
        merged[target] = order
        order = merged
        run *= 2
    return order


def neighbours(group: np.ndarray, matrix: np.ndarray, lengths: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, bool]:
    """Exact common prefix of each row with the one before (-1 in another group), and whether the order is right."""
    a, b = order[:-1], order[1:]
    differ = matrix[a] != matrix[b]
    common = np.where(differ.any(1), differ.argmax(1), matrix.shape[1]) if matrix.shape[1] else np.zeros(len(a), np.int64)
    common = np.minimum(common, np.minimum(lengths[a], lengths[b]))
    same = group[a] == group[b]
    last = max(matrix.shape[1] - 1, 0)
    at = np.minimum(common, last)
    after_a = np.where(common < lengths[a], matrix[a, at].astype(np.float64), -1)
    after_b = np.where(common < lengths[b], matrix[b, at].astype(np.float64), -1)
    return np.r_[-1, np.where(same, common, -1)], bool((after_a <= after_b)[same].all())


def suffix_order(group: np.ndarray, matrix: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = merge_order(group, matrix, lengths)
    common, right = neighbours(group, matrix, lengths, order)
    if not right:  # a hash collision
        order = np.array(sorted(range(len(group)), key=lambda k: (group[k], matrix[k, : lengths[k]].tobytes())))
        common, _ = neighbours(group, matrix, lengths, order)
    return order, common


def kind(window: int = WINDOW, gram: int = GRAM) -> Kind:
    return Kind(window, gram, byte_tokens, byte_codes, suffix_order, earliest=False)


def _apply(with_text: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for doc_id, text, ranges in zip(pdf["doc_id"], pdf["text"], pdf["ranges"], strict=True):
                data = encode(text)
                removed = spans = 0
                if ranges is not None:
                    mask = removed_mask(len(data), ranges)
                    removed, spans = int(mask.sum()), int(np.count_nonzero(np.diff(mask.astype(np.int8), prepend=0) == 1))
                    size = len(data)
                    data = np.frombuffer(data, np.uint8)[~mask].tobytes()
                else:
                    size = len(data)
                out.append((doc_id, size, removed, spans, hashlib.sha256(data).hexdigest()) + ((data,) if with_text else ()))
            yield pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * with_text)

    return run


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, with_text: bool = False) -> DataFrame:
    """A row for each row of docs(doc_id, text): every byte covered by a `window`-byte string that also starts
    elsewhere, same document included, is removed. Null and empty texts: zeros and the digest of nothing. Repeated
    rows repeat each other and so lose all their windows. with_text: the kept bytes too.
    """
    fields = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text
    return map_rows(with_ranges(docs, kind(window, gram)), _apply(with_text), fields)
