"""Toxicity: noisy-channel deobfuscation, then evidence of restored words.

A character language model (letter grams within words, leaning on shorter ones) is counted over the texts of all documents. Odd tokens, that is
letters mixed with digits or symbols, separated letters and repeated letters, become lattices: each character offers the
letters it may stand for, itself, a word boundary or nothing, at a channel's cost; Viterbi picks the reading that the
channel and the language model together find likeliest. Plain words are left alone.

What terms say about toxicity is learned from restored texts of labelled documents, one of each group of near copies. Terms
are words, beginnings of words, and beginnings that several words of a text share, since languages inflect. A term's log
odds are lowered by their own uncertainty. A logistic regression over a text's strongest term, the sum over its words and
its length gives the score.
"""

from __future__ import annotations

import itertools
import math
import re
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from popforge.llm.shared import discard, map_rows, mapped, thinned, written

#: Labelled documents that evidence and regression are fitted on, about; terms with evidence, at most.
SAMPLE, MOST_TERMS = 20_000, 4096
#: Least number of toxic documents with a term; standard errors taken off its log odds; letters of beginnings.
SUPPORT, DOUBT, BEGINNINGS = 4, 3.0, range(4, 8)
FEATURES = 3
#: Score from which a text counts as toxic.
TOXIC = 0.7

# Letters that a digit or symbol may stand for
LOOKS = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "€": "e", "(": "c", "<": "c", "*": "aeiou",
}
SEPARATORS = " .-_*/'·"
#: The channel's costs: a look-alike, a wildcard, a symbol that only bounds words, an accent taken off; a separator dropped or
#: kept as a word's bound, and so a space; a repeat of a doubled letter and of one that stands three times or more.
COST = {"look": -1.0, "wild": -2.5, "bound": -6.0, "accent": -4.0, "separator": -0.5, "separator kept": -1.0, "space": -0.1, "space kept": -2.0, "double": -3.5, "triple": -0.5}
#: Codes of the language model: 0 bounds words, 1 to 26 are a to z, the rest share what other letters there are.
CODES = 64
#: Letters of a gram, of the shorter gram it leans on, how much it does, and the most grams of full length that are held.
ORDER, SHORT, LEAN, MOST_GRAMS = 5, 3, 4.0, 1 << 18
_DECORATION = re.compile(r"([^\w\s])\1{2,}(?!\w)|(?<!\w)([^\w\s])\2{2,}")
_TOKEN = re.compile(r"""[^\s"#%&),:;=>?\[\\\]^`{}~]+""")
_SPACED = re.compile(r"(?<![^\W_])(?:[^\W_]|[@$!|+€*])(?:[ .\-_*/]{1,2}(?:[^\W_]|[@$!|+€*])){2,}(?![^\W_])")
#: The last two of three characters that stand apart: where this isn't found, _SPACED isn't either.
_APART = re.compile(r"[ .\-_*/][^\s.\-_*/][ .\-_*/]{1,2}[^\s.\-_*/](?!\w)")
_WORD = re.compile(r"[^\W\d_]+")
_REPEATED = re.compile(r"(.)\1+")
#: Distinct tokens whose reading a task remembers.
_REMEMBERED = 1 << 18


def code_of(ch: str) -> int:
    if "a" <= ch <= "z":
        return ord(ch) - 96
    return 27 + ord(ch) % (CODES - 27) if ch.isalpha() else 0


_LOW = 0x3000
_TABLE = np.array([code_of(chr(i)) for i in range(_LOW)], np.int64)


def codes(text: str) -> np.ndarray:
    """Codes of a lower-cased text, a single 0 between words."""
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    out = _TABLE[np.minimum(points, _LOW - 1)]
    high = np.flatnonzero(points >= _LOW)
    if len(high):
        out[high] = [code_of(chr(p)) for p in points[high].tolist()]
    keep = np.ones(len(out), bool)
    keep[1:] = (out[1:] > 0) | (out[:-1] > 0)
    return out[keep]


def grams(line: np.ndarray) -> np.ndarray:
    """Each code of the line, which starts with 0, after the first, with the ORDER - 1 before it as far as its word goes."""
    out = line[1:].copy()
    inside = np.ones(len(out), bool)
    for back in range(1, ORDER):
        before = np.zeros(len(out), np.int64)
        before[back - 1 :] = line[: max(len(line) - back, 0)]
        inside &= before > 0
        out += np.where(inside, before, 0) << (6 * back)
    return out


def count_grams(docs: DataFrame) -> DataFrame:
    """gram, n: letter grams within words, over the texts of all documents."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            held = []
            for text in f["text"]:
                for at in range(0, len(text or ""), 1 << 20):
                    held.append(grams(codes(" " + text[at : at + (1 << 20)].lower() + " ")))
            at, n = np.unique(np.concatenate(held) if held else np.empty(0, np.int64), return_counts=True)
            yield pd.DataFrame({"gram": at, "n": n})

    return mapped(docs.select("text"), run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


class Language:
    """Log chance of a letter after those before it in its word. Grams of ORDER letters lean on those of one letter less, these
    on grams of SHORT letters, and so on. The MOST_GRAMS commonest of full length and all short ones are held, at any size
    of the corpus."""

    def __init__(self, short: np.ndarray, long_grams: list[tuple[int, int]]) -> None:
        tri = short.reshape(CODES, CODES, CODES).astype(np.float64)
        bi, one = tri.sum(0), tri.sum((0, 1))
        p1 = (one + 1) / (one.sum() + CODES)
        p2 = (bi + LEAN * p1) / (bi.sum(1, keepdims=True) + LEAN)
        p3 = (tri + LEAN * p2[None]) / (tri.sum(2, keepdims=True) + LEAN)
        self.short = np.log(p3).reshape(-1).tolist()
        self.levels: list[tuple[dict[int, float], dict[int, float], int]] = []
        counts = {g: n for g, n in long_grams}
        by_order = {ORDER: counts}
        for order in range(ORDER - 1, SHORT, -1):
            fewer: dict[int, int] = {}
            for g, n in by_order[order + 1].items():
                g %= CODES**order
                fewer[g] = fewer.get(g, 0) + n
            by_order[order] = fewer
        for order in range(SHORT + 1, ORDER + 1):
            of = by_order[order]
            total: dict[int, int] = {}
            for g, n in of.items():
                total[g // CODES] = total.get(g // CODES, 0) + n
            chance = {g: math.log((n + LEAN * math.exp(self.log_chance(g))) / (total[g // CODES] + LEAN)) for g, n in of.items()}
            unseen = {context: math.log(LEAN / (n + LEAN)) for context, n in total.items()}
            self.levels.append((chance, unseen, CODES**order))

    def log_chance(self, gram: int) -> float:
        extra = 0.0
        for chance, unseen, size in reversed(self.levels):
            g = gram % size
            found = chance.get(g)
            if found is not None:
                return extra + found
            extra += unseen.get(g // CODES, 0.0)
        return extra + self.short[gram % CODES**SHORT]


def language(docs: DataFrame) -> Language:
    counted = written(count_grams(docs))
    short = np.zeros(CODES**SHORT, np.int64)
    for gram, n in counted.groupBy((F.col("gram") % CODES**SHORT).alias("gram")).agg(F.sum("n")).collect():
        short[gram] = n
    common = [(r.gram, r.n) for r in counted.orderBy(F.col("n").desc(), "gram").limit(MOST_GRAMS).collect()]
    discard(counted)
    return Language(short, common)


def _offers(observed: str) -> list[list[tuple[int, str, float]]]:
    """The lattice: (code, letter, cost) of each reading of each character; code -1 reads nothing."""
    out = []
    for ch, group in itertools.groupby(observed):
        n = len(list(group))
        reads: list[tuple[int, str, float]] = []
        if code := code_of(ch):
            reads.append((code, ch, 0.0))
            base = unicodedata.normalize("NFD", ch)[0]
            if base != ch and code_of(base):
                reads.append((code_of(base), base, COST["accent"]))
        else:
            reads += [(code_of(x), x, COST["wild" if ch == "*" else "look"]) for x in LOOKS.get(ch, "")]
            separates = ch in SEPARATORS or ch.isspace()
            kind = "space" if ch.isspace() else "separator"
            reads.append((0, " ", COST[f"{kind} kept" if separates else "bound"]))
            if separates:
                reads.append((-1, "", COST[kind]))
        out.append(reads)
        again = [*reads, (-1, "", COST["double" if n == 2 else "triple"])]
        out += [again] * (n - 1)
    return out


def decode(observed: str, model: Language) -> str:
    """The likeliest reading of a lower-cased span."""
    chance, size = model.log_chance, CODES ** (ORDER - 1)
    # by the last codes of the word: the best score, and its letters as a linked list
    best: dict[int, tuple[float, tuple | None]] = {0: (0.0, None)}
    for reads in _offers(observed):
        then: dict[int, tuple[float, tuple | None]] = {}
        for state, (score, path) in best.items():
            for code, letter, cost in reads:
                if code < 0 or not (code or state):
                    to, s, p = state, score + cost, path
                else:
                    gram = state * CODES + code
                    to, s, p = gram % size if code else 0, score + cost + chance(gram), (path, letter)
                if to not in then or s > then[to][0]:
                    then[to] = (s, p)
        best = then
    score, path = max(((s + (chance(state * CODES) if state else 0.0), p) for state, (s, p) in best.items()), key=lambda x: x[0])
    letters = []
    while path:
        path, letter = path
        letters.append(letter)
    return "".join(reversed(letters)).strip()


class Restorer:
    """Restored texts, with the readings of tokens seen before."""

    def __init__(self, model: Language) -> None:
        self.model = model
        self.known: dict[str, str] = {}

    def token(self, token: str) -> str:
        """A token's reading: itself where it is plain letters without a repeat, or has no letter at all."""
        out = self.known.get(token)
        if out is None:
            odd = not token.isalpha() or _REPEATED.search(token)
            out = decode(token, self.model) if odd and _WORD.search(token) else token
            if len(self.known) >= _REMEMBERED:
                self.known.clear()
            self.known[token] = out
        return out

    def core(self, token: str) -> str:
        """A token without what ends a sentence or a quotation and without symbols that only decorate."""
        plain = token.rstrip(".!")
        if plain.isalpha():
            return plain
        return _DECORATION.sub(" ", token).strip().rstrip(".!-_/'*·").lstrip(".-_/'·")

    def joined(self, text: str | None) -> str:
        """The text in lower case, with words whose letters stand apart joined."""
        low = (text or "").lower()
        return _SPACED.sub(lambda m: decode(m[0], self.model) if _WORD.search(m[0]) else m[0], low) if _APART.search(low) else low

    def text(self, text: str | None) -> str:
        """The text in lower case, letters that stand apart joined first, then each token read."""

        def read(m: re.Match) -> str:
            core = self.core(m[0])
            return self.token(core) if core else m[0]

        return _TOKEN.sub(read, self.joined(text))


@dataclass(frozen=True)
class Model:
    language: Language
    #: what a term says, the doubt taken off
    evidence: dict[str, float]
    #: of the constant and the features
    weights: np.ndarray


def terms_of(word: str) -> list[str]:
    """The word, marked by a space at its end, and its beginnings."""
    return [word + " ", *(word[:k] for k in BEGINNINGS if k <= len(word))]


def terms(words: set[str]) -> set[str]:
    """Terms of a text's distinct words; a beginning that several share is another term too, marked by +."""
    seen: set[str] = set()
    shared: set[str] = set()
    for word in words:
        for term in terms_of(word):
            (shared if term in seen else seen).add(term)
    return seen | {term + "+" for term in shared}


def _bare(text: str) -> str:
    """Without repeats of letters."""
    return _REPEATED.sub(r"\1", text)


class Judge:
    """Features of texts, with what each token says remembered.

    A token of plain letters, some of them doubled, is only read where a reading could tell something: its readings differ
    in doubled letters, so what they tell is told by terms that are alike without repeats.
    """

    def __init__(self, evidence: dict[str, float], restorer: Restorer) -> None:
        self.evidence, self.restorer = evidence, restorer
        self.shared = {t[:-1]: e for t, e in evidence.items() if t.endswith("+")}
        least = min(BEGINNINGS)
        self.heads = {t[:least] for t in evidence}
        self.bare = {_bare(t.removesuffix("+")) for t in evidence}
        self.bare_lengths = sorted({len(t) for t in self.bare})
        #: token -> the number of its words where they tell nothing, else each word, what it tells, its shared beginnings
        self.known: dict[str, int | list[tuple[str, float, list[str]]]] = {}

    def word(self, word: str) -> tuple[str, float, list[str]] | None:
        """The most that a word's terms say, and those of its beginnings that say something when shared."""
        if (word + " ")[: min(BEGINNINGS)] not in self.heads:
            return None
        of = terms_of(word)
        most, shared = max(self.evidence.get(t, 0.0) for t in of), [t for t in of if t in self.shared]
        return (word, most, shared) if most or shared else None

    def _may_tell(self, word: str) -> bool:
        bare = _bare(word + " ")
        return any(bare[:k] in self.bare for k in self.bare_lengths)

    def token(self, token: str) -> int | list[tuple[str, float, list[str]]]:
        core = self.restorer.core(token)
        out: int | list[tuple[str, float, list[str]]]
        if core.isalpha():
            if _REPEATED.search(core) and self._may_tell(core):
                core = self.restorer.token(core)
            out = 1 if (told := self.word(core)) is None else [told]
        else:
            words = _WORD.findall(self.restorer.token(core)) if core else []
            all_told = [self.word(w) for w in words]
            out = [t or (w, 0.0, []) for t, w in zip(all_told, words, strict=True)] if any(all_told) else len(words)
        if len(self.known) >= _REMEMBERED:
            self.known.clear()
        self.known[token] = out
        return out

    def __call__(self, text: str | None) -> tuple[tuple[float, float, float], int, dict[str, float]]:
        """A text's strongest term, the sum over its distinct words, and its length, on scales of logarithms; the number of
        its words; and the words that say something."""
        n_words = 0
        found: dict[str, float] = {}
        shared: dict[str, set[str]] = {}
        get = self.known.get
        for token, times in Counter(_TOKEN.findall(self.restorer.joined(text))).items():
            told = get(token)
            if told is None:
                told = self.token(token)
            if told.__class__ is int:
                n_words += told * times
                continue
            n_words += len(told) * times
            for word, says, beginnings in told:
                if says:
                    found[word] = says
                for t in beginnings:
                    shared.setdefault(t, set()).add(word)
        strong = max((self.shared[t] for t, words in shared.items() if len(words) > 1), default=0.0)
        x = (max(strong, max(found.values(), default=0.0)), math.log1p(strong + sum(sorted(found.values()))), math.log1p(n_words) / 10)
        return x, n_words, found


def _labelled(docs: DataFrame, labels: DataFrame, learn: Column | None) -> DataFrame:
    """doc_id, text, toxic of a bounded sample of labelled documents; labels of one doc_id are averaged."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    if learn is not None:
        known = known.where(learn)
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.avg("toxic") >= 0.5).cast("int").alias("toxic"))
    # at most some 21,000 rows of two numbers
    few = thinned(known, SAMPLE, "doc_id")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(few), "doc_id")


def signature(restored: str) -> tuple[int, int]:
    """The least of two hashes over the three-word pieces of a text: near copies share one of them nearly always."""
    words = _WORD.findall(restored)
    pieces = {" ".join(words[k : k + 3]).encode() for k in range(max(len(words) - 2, 1))}
    return min(map(zlib.crc32, pieces)), min(zlib.crc32(x, 1) for x in pieces)


def _restored(rows: DataFrame, model: Language) -> DataFrame:
    """Restored texts of labelled documents; of those that share half a signature only the one with the smallest doc_id."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        restorer = Restorer(model)
        for f in frames:
            texts = [restorer.text(t) for t in f["text"]]
            marks = [signature(t) for t in texts]
            yield f.assign(text=texts, one=[m[0] for m in marks], two=[m[1] for m in marks])

    every = written(mapped(rows, run, "doc_id long, text string, toxic int, one long, two long"))
    firsts = [every.groupBy(c).agg(F.min("doc_id").alias(f"first_{c}")) for c in ("one", "two")]
    kept = every.join(firsts[0], "one").join(firsts[1], "two").where((F.col("doc_id") == F.col("first_one")) & (F.col("doc_id") == F.col("first_two")))
    out = written(kept.groupBy("doc_id").agg(F.max("text").alias("text"), F.max("toxic").alias("toxic")))
    discard(every)
    return out


def _evidence(restored: DataFrame) -> dict[str, float]:
    """Terms whose log odds, less DOUBT standard errors, are above 0; the MOST_TERMS strongest."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            counts: tuple[Counter, Counter] = (Counter(), Counter())
            for text, toxic in zip(f["text"], f["toxic"], strict=True):
                counts[int(toxic)].update(terms(set(_WORD.findall(text))))
            # rows with columns named: of a batch without texts of a kind, a dict's empty columns would be numbers, no strings
            yield pd.DataFrame([(term, n * kind, n * (1 - kind)) for kind, of in enumerate(counts) for term, n in of.items()], columns=["term", "t", "n"])

    found = mapped(restored, run, "term string, t long, n long").groupBy("term").agg(F.sum("t").alias("t"), F.sum("n").alias("n"))
    all_n, all_t = restored.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not 0 < all_t < all_n:
        return {}
    t, n = F.col("t") + 0.5, F.col("n") + 0.5
    odds = F.log(t / F.lit(all_t + 1.0)) - F.log(n / F.lit(all_n - all_t + 1.0)) - DOUBT * F.sqrt(1 / t + 1 / n)
    best = found.where(F.col("t") >= SUPPORT).select("term", odds.alias("e")).where("e > 0").orderBy(F.col("e").desc(), "term").limit(MOST_TERMS)
    return {r.term: r.e for r in best.collect()}


def regression(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Weights of a logistic regression with a constant, by Newton's steps."""
    x = np.column_stack((np.ones(len(x)), x))
    w = np.zeros(x.shape[1])
    hold = np.full(len(w), ridge)
    hold[0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(hold), x.T @ (y - p) - hold * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, learn: Column | None = None) -> Model:
    """Language model from all docs (doc_id, text); evidence and regression from labels (doc_id, toxic) where `learn`, a
    condition on labels, holds. Without labels of both kinds every text gets the share of toxic ones, one half if none."""
    model = language(docs)
    restored = _restored(_labelled(docs, labels, learn), model)
    evidence = _evidence(restored)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        judged = Judge(evidence, Restorer(model))
        for f in frames:
            yield pd.DataFrame({"doc_id": f["doc_id"], "y": f["toxic"], "x": [judged(t)[0] for t in f["text"]]})

    rows = mapped(restored, run, "doc_id long, y int, x array<double>").orderBy("doc_id").collect()
    got = np.array([(r.y, *r.x) for r in rows]).reshape(-1, 1 + FEATURES)
    discard(restored)
    toxic = int(got[:, 0].sum())
    if 0 < toxic < len(got):
        weights = regression(got[:, 1:], got[:, 0])
    else:
        weights = np.array([math.log((toxic + 1) / (len(got) - toxic + 1)), *[0.0] * FEATURES])
    return Model(model, evidence, weights)


def score(docs: DataFrame, model: Model, with_text: bool = False) -> DataFrame:
    """doc_id, score (0 to 1), n_words, words (those with evidence, strongest first) of every document, and with_text the
    restored text.

    docs: doc_id, text; other columns take no part, whatever their names. Null and empty texts have no words and get the
    score of such texts. Repeated rows and rows with a null doc_id are scored each for itself; no rows: no rows. Texts of
    any length are read whole. Words of equal evidence go by spelling. Two-letter pieces of a word that was cut by spaces
    are not joined; single letters are.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        restorer = Restorer(model.language)
        judged = Judge(model.evidence, restorer)
        for f in frames:
            out = []
            for doc_id, text in zip(f["doc_id"], f["text"], strict=True):
                x, n, found = judged(text)
                z = float(model.weights[0] + model.weights[1:] @ np.array(x))
                telling = sorted(found, key=lambda w: (-found[w], w))
                out.append((doc_id, 1 / (1 + math.exp(-max(min(z, 30.0), -30.0))), n, telling, restorer.text(text) if with_text else None))
            yield pd.DataFrame(out, columns=["doc_id", "score", "n_words", "words", "restored"])

    found = map_rows(docs.select("doc_id", "text"), run, "doc_id long, score double, n_words long, words array<string>, restored string")
    return found if with_text else found.drop("restored")


def judge(docs: DataFrame, labels: DataFrame, learn: Column | None = None, threshold: float = TOXIC) -> DataFrame:
    """score() with a model fitted on the same documents, and predicted: 1 where the score is at least the threshold."""
    found = score(docs, fit(docs, labels, learn))
    return found.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
