"""Personal data: candidates, boosted trees, calibrated thresholds.

Four kinds of spans: email, ip, card, phone. Exact rules give the base spans, which always stay.
High-recall generators propose further, overlapping candidates: addresses with spelled-out or bracketed signs, numbers
with other separators or without a country code. Gradient-boosted trees over format and context features score them,
and each kind has a threshold. Chosen candidates that overlap no base span are added, best first.

The trees learn from labels that no rule gave: specimens of personal data and look-alikes (a digit changed, a part too
many, a date, a file name) are written in many formats into the text around a random place of a document; what is
proposed exactly where the datum stands is a positive, whatever else touches specimens a negative. Of the candidates
found in the documents themselves, base spans are positives, and those that fail their kind's check (checksum,
range, top-level name) negatives; the others are of unknown label and are left out. What a check refuses is never added.
The trees are fitted on the examples of about SAMPLE_DOCS documents. Thresholds come from histograms of the scores of the
base spans and of a specimen's candidates in every document.
"""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popforge.llm.shared import hash_sample, map_rows, thinned, written

KINDS = ("email", "ip", "card", "phone")
#: Documents, and examples of those, that the trees are fitted on; specimens in each of those documents.
SAMPLE_DOCS, SAMPLE_EXAMPLES, SPECIMENS = 4000, 40_000, 4
#: Share of right choices asked of a threshold, the least score ever taken, and bins of the score histograms.
PRECISION, LEAST_SCORE, SCORE_BINS = 0.995, 0.5, 1000
TREES, DEPTH, RATE, BINS = 40, 4, 0.3, 16
#: Candidates scored at a time.
BLOCK = 10_000
#: Code points of a document around a specimen.
AROUND = 80

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOTTED = re.compile(r"[0-9][0-9.]*")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_AT = re.compile(r"@|[(\[{<] ?at ?[)\]}>]|\bat\b", re.IGNORECASE)
_DOT = r" ?(?:\.|[(\[{] ?(?:\.|dot) ?[)\]}]|\bdot\b) ?"
_RIGHT = re.compile(rf" ?[\w-]{{1,63}}(?:{_DOT}[\w-]{{1,63}}){{1,4}}", re.IGNORECASE)
_OCTETS = re.compile(rf"(?<![0-9])(?=([0-9]{{1,3}}(?:{_DOT}[0-9]{{1,3}}){{3}})(?![0-9]))", re.IGNORECASE)
_NUMBER = re.compile("[+(]?[0-9](?:[ ().\\-/_\u00a0\u2013]{0,2}[0-9])+")
_PIECE = re.compile("[^ \u00a0]+")
_DIGITS = re.compile(r"[0-9]+")
_CUES = (
    re.compile(r"mail|contact|write|reach", re.IGNORECASE),
    re.compile(r"\bip\b|host|server|addr", re.IGNORECASE),
    re.compile(r"card|visa|credit|debit|account", re.IGNORECASE),
    re.compile(r"phone|call|tel|mobile|fax", re.IGNORECASE),
)
Span = tuple[int, int]


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            done = match.end()
            yield start, done
        else:
            done = at + 1
        at = text.find("@", done)


def _in_range(part: str) -> bool:
    short = part.lstrip("0")
    return len(short) <= 3 and int(short or "0") <= 255


def _ips(text: str) -> Iterator[Span]:
    for run in _DOTTED.finditer(text):
        at, parts = run.start(), []
        for part in run.group().split("."):
            parts.append((at, at + len(part)))
            at += len(part) + 1
        k = 0
        while k + 4 <= len(parts):
            if empty := [i for i in range(k, k + 4) if parts[i][0] == parts[i][1]]:
                k = empty[-1] + 1
                continue
            if all(_in_range(text[a:b]) for a, b in parts[k : k + 4]):
                yield parts[k][0], parts[k + 3][1]
            k += 4


def _n_digits(span: str) -> int:
    return sum(map(len, _DIGITS.findall(span)))


def base_spans(text: str) -> dict[str, list[Span]]:
    """The spans of the exact rules by kind, in code points, end exclusive. Linear in the text."""
    return {
        "email": list(_emails(text)),
        "ip": list(_ips(text)),
        "card": [m.span() for m in _CARD.finditer(text) if 13 <= _n_digits(m.group()) <= 19 and luhn("".join(_DIGITS.findall(m.group())))],
        "phone": [m.span() for m in _PHONE.finditer(text) if 9 <= _n_digits(m.group()) <= 15],
    }


def proposals(text: str) -> Iterator[tuple[int, int, int]]:
    """Overlapping high-recall candidates (kind, start, end). Each start has a bounded number, so linear in the text."""
    for at in _AT.finditer(text):
        right = _RIGHT.match(text, at.end(), at.end() + 280)
        if right is None:
            continue
        end = start = at.start() - (text[at.start() - 1 : at.start()] == " ")
        while start > 0 and end - start < 64 and (text[start - 1].isalnum() or text[start - 1] in "._%+-"):
            start -= 1
        if start < end:
            yield 0, start, right.end()
    for run in _OCTETS.finditer(text):
        yield 1, *run.span(1)
    for run in _NUMBER.finditer(text):
        group, start = run.group(), run.start()
        pieces = [(m.start(), m.end(), _n_digits(m.group())) for m in _PIECE.finditer(group)]
        for i, (a, _, _) in enumerate(pieces):
            n = 0
            for j in range(i, len(pieces)):
                n += pieces[j][2]
                if n > 19:
                    break
                if n >= 12:
                    yield 2, start + a, start + pieces[j][1]
                if 8 <= n <= 15:
                    yield 3, start + a, start + pieces[j][1]


def check(text: str, kind: int, start: int, end: int) -> bool:
    """Whether a candidate could be what its kind says: checksum, ranges, number of digits and of their groups, a name as
    last label, and no letter or digit right beside a number."""
    span = text[start:end]
    groups = _DIGITS.findall(span)
    n = sum(map(len, groups))
    if kind and (text[start - 1 : start].isalnum() or text[end : end + 1].isalnum()):
        return False
    if kind == 0:
        return bool(re.search(r"[A-Za-z]{2,}\Z", span)) and "@" in span or bool(re.search(r"at.*dot ?[)\]}]? ?[A-Za-z]{2,}\Z", span, re.IGNORECASE))
    if kind == 1:
        return len(groups) == 4 and all(map(_in_range, groups))
    if kind == 2:
        return 13 <= n <= 19 and luhn("".join(groups))
    return 9 <= n <= 15 and len(groups) <= 6 and not re.search(r"(?:19|20)[0-9]{2}[-./][0-9]{1,2}[-./]", span)


def features(text: str, kind: int, start: int, end: int) -> list[float]:
    """Format and context of a span."""
    span, before, after = text[start:end], text[max(0, start - 30) : start], text[end : end + 12]
    found = _DIGITS.findall(span)
    groups = [len(g) for g in found]
    n = sum(groups)
    row = [float(kind == k) for k in range(4)]
    row += [n, len(span), len(groups), max(groups, default=0), min(groups, default=0), span.count("."), span.count("-"), span.count(" "), span.count("/")]
    row += [span.count("("), float(span[:1] == "+"), float(span[:1] in "3456"), len(set(span)) / len(span), float("@" in span), sum(c.isalpha() for c in span) / len(span)]
    row += [float(before[-1:].isspace() or not before), float(after[:1].isspace() or not after), float(after[:1].isalnum()), float(before[-1:].isalnum()), float(before[-1:] in "-./_" and before != "")]
    row += [float(len(re.findall("dot", span, re.IGNORECASE))), float(span[-2:].isalpha()), float(0 < n < 20 and luhn("".join(found))), float(len(groups) > 1 and groups[0] == groups[1])]
    row += [float(_DIGITS.match(after.lstrip(" -./")) is not None), float(before.rstrip(" -./")[-1:].isdigit())]
    return row + [float(bool(cue.search(before))) for cue in _CUES]


def _card_number(rng: random.Random, good: bool) -> str:
    body = rng.choice("3456") + "".join(rng.choice("0123456789") for _ in range(rng.choice((14, 14, 14, 13, 12, 17))))
    last = next(d for d in "0123456789" if luhn(body + d))
    return body + (last if good else rng.choice([d for d in "0123456789" if d != last]))


def specimen(rng: random.Random, kind: int, real: bool) -> str:
    """A made-up datum of a kind in one of many formats, or a look-alike."""
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9)))
    number = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    date = f"{rng.randint(1900, 2039)}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}"
    if kind == 0:
        at, dot = rng.choice([("@", "."), (" at ", " dot "), ("(at)", "(dot)"), (" (at) ", " (dot) "), ("[at]", "[dot]"), (" [at] ", " [dot] "), (" AT ", " DOT "), ("@", " . "), (" @ ", "."), ("@", "[.]"), ("{at}", "{dot}"), ("(at)", ".")])
        name = rng.choice([word(), f"{word()}.{word()}", f"{word()}{number(2)}", f"{word()}_{word()}"])
        host = dot.join([word() for _ in range(rng.randint(1, 2))] + [rng.choice(("com", "org", "net", "de", "fr", "es", "io", "edu"))])
        if real:
            return name + at + host
        return rng.choice([f"{word()} at {word()}. {word()}", f"{word()} at {word()} dot {word()}", f"{word()}@{word()}", f"{word()} at {number(2)}.{number(2)}", f"@{word()}", f"{word()} @ {number(1)}.{number(2)}", f"at the dot {word()}", f"{word()} at {word()} dot"])
    if kind == 1:
        octets = [str(rng.randint(0, 255)) for _ in range(4)]
        if not real:
            octets[rng.randrange(4)] = str(rng.randint(256, 999))
            if rng.random() < 0.5:
                return rng.choice([f"{rng.randint(1, 28)}.{rng.randint(1, 12)}.{rng.randint(1900, 2039)}", ".".join(number(rng.randint(1, 3)) for _ in range(rng.choice((3, 5, 6)))), f"{number(1)}.{number(1)} {number(2)}.{number(2)}"])
        return rng.choice((".", "[.]", "(.)", " . ", " dot ", "[dot]", "(dot)", " (dot) ")).join(octets)
    if kind == 2:
        digits, mark = _card_number(rng, real), rng.choice(("", " ", "-", ".", "/", "_", "\u00a0", "\u2013", " - "[:2]))
        size = rng.choice((4, 4, 4, 5, 6)) if mark else len(digits)
        return mark.join(digits[k : k + size] for k in range(0, len(digits), size))
    if real:
        area, office, line = rng.randint(200, 989), rng.randint(200, 989), number(4)
        shapes = [f"+{rng.randint(1, 99)} ({area}) {office}-{line}", f"({area}) {office}-{line}", f"{area}-{office}-{line}", f"{area}.{office}.{line}", f"+{rng.randint(1, 99)}/{area}/{office}{line}", f"00{rng.randint(20, 99)} {area} {office} {line}", f"+{rng.randint(1, 99)}_{area}_{office}_{line}", f"{area}/{office}-{line}", f"+{rng.randint(1, 99)}\u00a0{area}\u00a0{office}\u00a0{line}"]
        return rng.choice(shapes)
    return rng.choice([f"{number(1)} {number(3)} {number(3)} {number(3)}", f"{number(3)} {number(3)} {number(3)}", f"{number(2)}.{number(3)}.{number(3)}", number(9), date, date.replace("-", "/"), f"{date} {rng.randint(10, 23)}", number(rng.randint(8, 12)), f"{number(3)}.{number(3)}.{number(3)}", f"{rng.randint(1900, 2039)}-{rng.randint(1900, 2039)}", " ".join(number(rng.randint(1, 2)) for _ in range(7)), f"{date}-{number(4)}"])


def made_examples(text: str, rng: random.Random) -> Iterator[tuple[str, int, int, int, int]]:
    """(text, kind, start, end, label) of the candidates at a datum or a look-alike set into the text at a random place,
    those that no check refuses."""
    at = text.find(" ", rng.randrange(len(text) + 1)) + 1
    kind, real = rng.randrange(4), rng.random() < 0.5
    cue = rng.choice([("mail", "contact"), ("host", "server"), ("card", "account"), ("phone", "call")][kind]) + rng.choice((" ", ": ")) if rng.random() < 0.2 else ""
    left, own = text[max(0, at - AROUND) : at] + cue, specimen(rng, kind, real)
    whole = left + own + rng.choice((" ", " ", " ", ". ", ", ", "!! ", ")", "$$ ")) + text[at : at + AROUND]
    for k, a, b in proposals(whole):
        if a < len(left) + len(own) and b > len(left) and check(whole, k, a, b):
            yield whole, k, a, b, int(real and k == kind and (a, b) == (len(left), len(left) + len(own)))


def own_examples(text: str, refused: bool) -> Iterator[tuple[str, int, int, int, int]]:
    """(text, kind, start, end, label) of the base spans of a text and of its candidates that fail their kind's check."""
    base = base_spans(text)
    for k, kind in enumerate(KINDS):
        for a, b in base[kind]:
            yield text, k, a, b, 1
    for k, a, b in _free(proposals(text), base) if refused else ():
        if not check(text, k, a, b):
            yield text, k, a, b, 0


def _free(candidates: Iterable[tuple[int, int, int]], base: dict[str, list[Span]]) -> Iterator[tuple[int, int, int]]:
    """The candidates that overlap no base span."""
    taken = sorted(s for spans in base.values() for s in spans)
    reach = np.maximum.accumulate([b for _, b in taken]).tolist() if taken else []
    for k, a, b in candidates:
        at = bisect_left(taken, (b, 0))  # spans that start before its end
        if not at or reach[at - 1] <= a:
            yield k, a, b


def _blocks(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == BLOCK:
            yield held
            held = []
    if held:
        yield held


def examples_of(texts: Iterable[str], specimens: int = 1, refused: bool = False) -> Iterator[tuple[str, int, int, int, int]]:
    """Labelled candidates of texts: base spans, those at specimens, and if asked those that a check refuses."""
    for text in texts:
        yield from own_examples(text, refused)
        rng = random.Random(zlib.crc32(text[:2000].encode("utf-8", "replace")) + len(text))
        for _ in range(specimens):
            yield from made_examples(text, rng)


class BoostedTrees:
    """Logistic gradient boosting over binned features, trees of a fixed depth kept as heap-ordered arrays."""

    def __init__(self, rows: np.ndarray, labels: np.ndarray):
        self.edges = [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1])) for column in rows.T]
        self.base = float(np.log((labels.sum() + 1) / (len(labels) - labels.sum() + 1)))
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        bins, score = self._bins(rows), np.full(len(rows), self.base)
        for _ in range(TREES):
            chance = 1 / (1 + np.exp(-score))
            tree = self._grow(bins, labels - chance, chance * (1 - chance))
            self.trees.append(tree)
            score += self._walk(bins, tree)

    def _bins(self, rows: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, column, side="right") for e, column in zip(self.edges, rows.T, strict=True)], axis=1)

    @staticmethod
    def _grow(bins: np.ndarray, slope: np.ndarray, curve: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        inner = 2**DEPTH - 1
        feature, cut, value = np.zeros(inner, int), np.full(inner, BINS), np.zeros(inner + 2**DEPTH)
        node = np.zeros(len(bins), int)
        for at in range(inner):
            here = node == at
            if not here.any():
                continue
            g_all, h_all, best = slope[here].sum(), curve[here].sum(), 1e-6
            for f in range(bins.shape[1]):
                g = np.cumsum(np.bincount(bins[here, f], slope[here], BINS))[:-1]
                h = np.cumsum(np.bincount(bins[here, f], curve[here], BINS))[:-1]
                gain = g**2 / (h + 1) + (g_all - g) ** 2 / (h_all - h + 1) - g_all**2 / (h_all + 1)
                if gain.max() > best:
                    best, feature[at], cut[at] = gain.max(), f, gain.argmax()
            node[here] = 2 * at + 1 + (bins[here, feature[at]] > cut[at])
        for leaf in range(inner, inner + 2**DEPTH):
            here = node == leaf
            value[leaf] = RATE * slope[here].sum() / (curve[here].sum() + 1)
        return feature, cut, value

    @staticmethod
    def _walk(bins: np.ndarray, tree: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
        feature, cut, value = tree
        node = np.zeros(len(bins), int)
        for _ in range(DEPTH):
            node = 2 * node + 1 + (bins[np.arange(len(bins)), feature[node]] > cut[node])
        return value[node]

    def chances(self, rows: np.ndarray) -> np.ndarray:
        bins = self._bins(rows)
        return 1 / (1 + np.exp(-(self.base + sum(self._walk(bins, tree) for tree in self.trees))))


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_examples: int = SAMPLE_EXAMPLES) -> tuple[BoostedTrees, list[float]] | None:
    """Trees and a threshold for each kind. None (rules only) where no document has a text."""
    some = docs.where(F.octet_length("text") > 0).select("doc_id", "text")

    def sampled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for block in _blocks(examples_of(pdf["text"], SPECIMENS, True)):
                yield pd.DataFrame([(label, features(text, k, a, b)) for text, k, a, b, label in block], columns=["label", "features"])

    found = written(map_rows(hash_sample(some, sample_docs, "doc_id"), sampled, "label int, features array<double>"))
    rows = thinned(found, sample_examples, "features", "label").limit(sample_examples).toPandas()
    if rows["label"].nunique() < 2:
        return None
    trees = BoostedTrees(np.array(rows["features"].tolist()), rows["label"].to_numpy(float))
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def judged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        for pdf in batches:
            for block in _blocks(examples_of(pdf["text"])):
                scores = (shared.value.chances(np.array([features(text, k, a, b) for text, k, a, b, _ in block])) * SCORE_BINS).astype(int)
                seen.update(zip([k for _, k, *_ in block], scores.tolist(), [label for *_, label in block], strict=True))
        yield pd.DataFrame([(*key, n) for key, n in seen.items()], columns=["kind", "bin", "label", "n"])

    counts = np.zeros((4, 2, SCORE_BINS + 1))
    sums = map_rows(some, judged, "kind int, bin int, label int, n long").groupBy("kind", "bin", "label").agg(F.sum("n").alias("n"))
    for kind, score_bin, label, n in sums.toPandas().itertuples(index=False):
        counts[kind, label, score_bin] += n
    return trees, [threshold(bad, good) for bad, good in counts]


def threshold(bad: np.ndarray, good: np.ndarray) -> float:
    """The least score, of LEAST_SCORE or more, from which on PRECISION of the examples are right; 2 (none) if there is none."""
    wrong, right = bad[::-1].cumsum()[::-1], good[::-1].cumsum()[::-1]
    ok = np.flatnonzero((right > 0) & (right >= PRECISION * (right + wrong)))
    return max(LEAST_SCORE, ok[0] / SCORE_BINS) if len(ok) else 2.0


def find_spans(texts: list[str], model: tuple[BoostedTrees, list[float]] | None) -> list[tuple[dict[str, list[Span]], dict[str, list[Span]]]]:
    """For each text its base spans, and these with the spans that the model adds."""
    bases = [base_spans(text) for text in texts]
    every = [{kind: list(spans) for kind, spans in base.items()} for base in bases]
    if model is not None:
        trees, thresholds = model
        good: list[list[tuple[float, int, int, int]]] = [[] for _ in texts]
        for block in _blocks((i, *c) for i, text in enumerate(texts) for c in _free(proposals(text), bases[i]) if check(text, *c)):
            chance = trees.chances(np.array([features(texts[i], *c) for i, *c in block]))
            for (i, k, a, b), p in zip(block, chance.tolist(), strict=True):
                if p >= thresholds[k]:
                    good[i].append((-p, k, a, b))
        for i, own in enumerate(good):
            added: list[Span] = []
            for _, k, a, b in sorted(own):
                at = bisect_left(added, (a, b))
                if (not at or added[at - 1][1] <= a) and (at == len(added) or added[at][0] >= b):
                    insort(added, (a, b))
                    every[i][KINDS[k]].append((a, b))
    return [(base, {kind: sorted(spans) for kind, spans in more.items()}) for base, more in zip(bases, every, strict=True)]


def redacted(text: str, spans: dict[str, list[tuple[int, int]]]) -> str:
    """The text with each span, or overlapping spans together, as <KIND>."""
    out, done = [], 0
    for a, b, kind in sorted((a, b, kind) for kind, own in spans.items() for a, b in own):
        if a >= done:
            out += [text[done:a], f"<{kind.upper()}>"]
        done = max(done, b)
    return "".join([*out, text[done:]])


def _listed(spans: dict[str, list[Span]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind in KINDS for a, b in spans[kind])


def scan(docs: DataFrame, model: tuple[BoostedTrees, list[float]] | None, with_text: bool = False) -> DataFrame:
    """A row for each row of docs(doc_id, text): counts and digest of base spans, all spans; with_text: every column
    of docs instead, text redacted. Null texts are empty (redacted: stay null); repeated rows and ids stay."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            texts = [text or "" for text in pdf["text"]]
            for given, text, (base, every) in zip(pdf["text"], texts, find_spans(texts, shared.value), strict=True):
                out.append((*(len(base[k]) for k in KINDS), hashlib.sha256(_listed(base).encode()).hexdigest(), _listed(every), redacted(text, every) if with_text and given is not None else None))
            found = pd.DataFrame(out, columns=["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "_redacted"], index=pdf.index)
            if with_text:
                yield pdf.assign(text=found["_redacted"])
            else:
                yield pd.concat([pdf[["doc_id"]], found.drop(columns="_redacted")], axis=1)

    if with_text:
        return map_rows(docs, run, docs.schema)
    return map_rows(docs.select("doc_id", "text"), run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")
