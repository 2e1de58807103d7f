"""Substring dedup by seed and extend, on words.

Seeds are winnowed anchors: documents are joined on the hash of a few words. From each seed, matches are
extended word by word forwards and backwards against the other documents of that seed (by sorting contexts in
both directions, see repeats.py), and stretches of at least `window` common words are kept as repeats.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from popforge.llm.repeats import Kind, removed_mask, with_ranges
from popforge.llm.shared import map_rows
from popforge.llm.suffix_dedup import neighbours
from popforge.llm.textarrays import encode, joined, words

WINDOW, GRAM = 50, 8


def word_tokens(held: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    buf, starts = joined(held)
    hashes, _, _, first = words(buf, starts, fold=False)
    return hashes, first


def word_codes(tokens: np.ndarray) -> np.ndarray:
    return tokens


def word_order(group: np.ndarray, matrix: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((*matrix.T[::-1], group))
    return order, neighbours(group, matrix, lengths, order)[0]


def kind(window: int = WINDOW, gram: int = GRAM) -> Kind:
    return Kind(window, gram, word_tokens, word_codes, word_order, earliest=True)


def _apply(with_text: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for doc_id, text, ranges in zip(pdf["doc_id"], pdf["text"], pdf["ranges"], strict=True):
                kept = encode(text).split()
                n = len(kept)
                if ranges is not None:
                    mask = removed_mask(n, ranges).tolist()
                    kept = [w for w, gone in zip(kept, mask, strict=True) if not gone]
                data = b" ".join(kept)
                out.append((doc_id, n, n - len(kept), hashlib.sha256(data).hexdigest()) + ((data.decode("utf-8", "replace"),) if with_text else ()))
            yield pd.DataFrame(out, columns=["doc_id", "n_words", "n_removed", "kept_sha256"] + ["text"] * with_text)

    return run


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, with_text: bool = False) -> DataFrame:
    """A row for each row of docs(doc_id, text): every word covered by a window of `window` words that also starts
    in a document with a smaller doc_id is removed. Null texts have no words; a null doc_id is smaller than none and
    loses nothing; rows of one doc_id are no repeats of each other. with_text: the kept words joined by spaces too.
    """
    fields = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", text string" * with_text
    return map_rows(with_ranges(docs, kind(window, gram)), _apply(with_text), fields)
