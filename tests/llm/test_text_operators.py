"""Each operator against brute force on small fixtures, with nulls, empty and long texts, ties and repeated rows."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from popforge.llm import context_tree, decontamination, graph, html_content, jaccard_join, language_id, mixing, pii, quality_rules, repeats, substring_dedup, suffix_dedup
from popforge.llm.shared import written
from popforge.llm.textarrays import chunks, joined, words

SCHEMA = "doc_id long, text string, lang string, source string, row string, h string, size int, score double"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def corpus(seed=0, n=60):
    """Random texts with copies, near copies, shared passages, repeats within a text, and odd rows."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeéöñ") for _ in range(rng.randint(1, 6))) for _ in range(300)]
    text = lambda k: " ".join(rng.choice(vocabulary) for _ in range(k))
    passage = text(70)
    out = []
    for i in range(n):
        kind = i % 6
        if kind == 0 or not out:
            t = text(rng.randint(1, 300))
        elif kind == 1:
            t = rng.choice(out)
        elif kind == 2:
            w = rng.choice(out).split()
            w[rng.randrange(len(w))] = "changed"
            t = " ".join(w)
        elif kind == 3:
            t = text(30) + "\n" + passage + "\t" + text(rng.randint(0, 60))
        elif kind == 4:
            t = ("Ab cd " * rng.randint(1, 150)) + text(20)
        else:
            t = text(150).title() + "  " + passage[: rng.randint(100, 400)]
        out.append(t)
    return [*out, "", " \n ", "x", "x y", None, "a" * 3000]


def frame(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, "en" if k % 2 else "fr", f"s{k % 3}" if k % 7 else None, "r", "h", 1, 0.5) for k, (i, t) in enumerate(zip(ids, texts, strict=True))]
    return spark.createDataFrame(rows, SCHEMA)


def removed_bytes(texts, window):
    data = [(t or "").encode() for t in texts]
    counts = collections.Counter(b[k : k + window] for b in data for k in range(len(b) - window + 1))
    out = []
    for b in data:
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - window + 1):
            if counts[b[k : k + window]] > 1:
                gone[k : k + window] = True
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        runs = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def removed_words(rows, window):
    first = {}
    for i, t in rows:
        w = (t or "").encode().split()
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            if i is not None:
                first[key] = min(first.get(key, i), i)
    out = []
    for i, t in rows:
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if i is not None and first[tuple(w[k : k + window])] < i:
                gone[k : k + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("seed", [0, 1])
@pytest.mark.parametrize("hot", [repeats.HOT_CLASSES, 1])
def test_suffix_dedup(spark, monkeypatch, seed, hot):
    monkeypatch.setattr(repeats, "HOT_CLASSES", hot)
    texts = corpus(seed)
    got = {r[0]: tuple(r)[1:] for r in suffix_dedup.remove_repeats(frame(spark, texts), 100, 16).collect()}
    assert got == dict(enumerate(removed_bytes(texts, 100)))


def test_suffix_dedup_keeps_the_kept_bytes(spark):
    texts = ["q" * 10 + "".join(chr(97 + k * 7 % 26) for k in range(60)) + str(k) for k in range(2)]
    out = {r.doc_id: bytes(r.kept) for r in suffix_dedup.remove_repeats(frame(spark, texts), 50, 8, with_text=True).collect()}
    assert out == {0: b"0", 1: b"1"}


@pytest.mark.parametrize("size", [399, 400])
def test_passages_of_over_50_words_below_400_bytes_stay(spark, size):
    passage = " ".join(f"w{k:05d}" for k in range(57)).ljust(size, "x")
    docs = frame(spark, [f"{i}{passage}{i}" for i in range(2)])
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in suffix_dedup.remove_repeats(docs).collect()}
    assert got == dict.fromkeys(range(2), (size + 2, 400, 1) if size == 400 else (size + 2, 0, 0))
    # the other repeat remover counts words
    assert {r.doc_id: r.n_removed for r in substring_dedup.remove_repeats(docs).collect()} == {0: 0, 1: 55}


def test_passages_of_49_words_stay(spark):
    texts = [" ".join(f"u{i}.{p} " + " ".join(f"w{p}.{k}" for k in range(49)) for p in range(10)) for i in range(2)]
    assert {r.doc_id: (r.n_words, r.n_removed) for r in substring_dedup.remove_repeats(frame(spark, texts)).collect()} == {0: (500, 0), 1: (500, 0)}


@pytest.mark.parametrize("operator", [suffix_dedup, substring_dedup])
def test_repeats_write_few_tables(spark, monkeypatch, operator):
    """Each file written starts a process on a local file system, which for a moment shows the executor's memory twice."""
    tables = []
    monkeypatch.setattr(repeats, "written", lambda df: tables.append(df.columns) or written(df))
    text = lambda k, n: " ".join(f"w{k}x{i}" for i in range(n))
    shared = text(0, 120)
    # classes that differ but share windows: all steps are taken
    texts = [f"{text(k, 60)} {shared} {text(10 + k, 60)}" for k in range(1, 5)]
    rows = {r[0]: tuple(r) for r in operator.remove_repeats(frame(spark, texts)).collect()}
    # of bytes also "x59 " before and " w1" after the shared words
    assert [rows[k][2] for k in range(4)] == ([0, 120, 120, 120] if operator is substring_dedup else [len(shared) + 7] * 4)
    assert ["group", "context", "check", "first_doc", "size", "low", "high", "tokens"] in tables
    assert len(tables) <= 6, tables


def test_repeats_without_broadcasts(spark, monkeypatch):
    monkeypatch.setattr(repeats, "HOT_CLASSES", 1)
    monkeypatch.setattr(repeats, "BROADCAST_ROWS", 0)
    texts = corpus(2)
    got = {r[0]: tuple(r)[1:] for r in suffix_dedup.remove_repeats(frame(spark, texts), 100, 16).collect()}
    assert got == dict(enumerate(removed_bytes(texts, 100)))
    got = collections.Counter(tuple(r) for r in substring_dedup.remove_repeats(frame(spark, texts), 20, 4).collect())
    assert got == collections.Counter(removed_words(list(enumerate(texts)), 20))


def test_suffix_order_survives_hash_collisions(monkeypatch):
    rng = np.random.default_rng(0)
    matrix, lengths, group = rng.integers(97, 99, (40, 12)).astype(np.uint8), np.full(40, 12), rng.integers(0, 3, 40)
    want = sorted(range(40), key=lambda k: (group[k], matrix[k].tobytes()))
    rows = lambda order: [(group[k], matrix[k].tobytes()) for k in order]
    assert rows(suffix_dedup.suffix_order(group, matrix, lengths)[0]) == rows(want)
    monkeypatch.setattr(suffix_dedup, "_CODES", np.ones(256, np.uint64))  # every byte hashes alike
    assert rows(suffix_dedup.suffix_order(group, matrix, lengths)[0]) == rows(want)


@pytest.mark.parametrize("seed", [0, 1])
@pytest.mark.parametrize("hot", [repeats.HOT_CLASSES, 1])
def test_substring_dedup(spark, monkeypatch, seed, hot):
    monkeypatch.setattr(repeats, "HOT_CLASSES", hot)
    texts = corpus(seed)
    ids = [(7 * k) % 101 for k in range(len(texts) - 2)] + [None, 5]
    got = collections.Counter(tuple(r) for r in substring_dedup.remove_repeats(frame(spark, texts, ids), 20, 4).collect())
    assert got == collections.Counter(removed_words(list(zip(ids, texts, strict=True)), 20))


def test_repeats_of_nothing(spark):
    empty = frame(spark, [])
    assert suffix_dedup.remove_repeats(empty).count() == substring_dedup.remove_repeats(empty).count() == 0
    nulls = frame(spark, [None, ""])
    assert {tuple(r)[1:4] for r in suffix_dedup.remove_repeats(nulls).collect()} == {(0, 0, 0)}


def shingle_sets(texts, k=3):
    out = []
    for t in texts:
        w = (t or "").translate(LOWER).encode().split()
        out.append(frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else []))
    return out


def linked(texts, percent=90):
    sets = shingle_sets(texts)
    up = list(range(len(texts)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            c = len(a & sets[j])
            if a and sets[j] and 100 * c >= percent * (len(a) + len(sets[j]) - c):
                x, y = find(i), find(j)
                up[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in range(len(texts))}


def near_corpus(seed):
    rng = random.Random(seed)
    out = []
    for _ in range(12):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.randint(3, 160))]
        for _ in range(rng.randint(1, 14)):
            w = list(base)
            for _ in range(rng.randint(0, 1 + len(w) // 40)):
                at = rng.randrange(len(w))
                w[at : at + rng.randint(0, 1)] = [f"e{rng.randrange(9)}"] * rng.randint(0, 2)
            out.append(" ".join(w))
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("seed", [0, 1, 2])
@pytest.mark.parametrize("family", [jaccard_join.FAMILY_SHINGLES, 400])
def test_jaccard_join(spark, monkeypatch, seed, family):
    monkeypatch.setattr(jaccard_join, "FAMILY_SHINGLES", family)
    texts = near_corpus(seed) + corpus(seed, 20)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.near_duplicates(frame(spark, texts)).collect()}
    assert got == linked(texts)


def test_representatives_keep_one_a_group_and_all_columns(spark):
    texts = near_corpus(3) + ["", None, ""]
    docs = frame(spark, texts)
    kept = jaccard_join.representatives(docs.unionByName(docs.limit(5)))
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, c in linked(texts).values()})


def test_grouped_prefix_join_links_are_true_and_connect(spark):
    sets = [np.unique(np.array([hash(x) & (2**63 - 1) for x in s], np.uint64)) for s in shingle_sets(near_corpus(5)) if s]
    links = jaccard_join.grouped_prefix_join(sets, 90)
    for i, j in links:
        c = len(np.intersect1d(sets[i], sets[j]))
        assert 100 * c >= 90 * (len(sets[i]) + len(sets[j]) - c)
    assert len({frozenset(x) for x in links}) == len(links)


def test_components(spark):
    edges = [(k, k + 1) for k in range(1, 30)] + [(50, 40), (40, 60), (7, 7), (40, 50)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 1 for k in range(2, 31)} | {50: 40, 60: 40}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def leaks(texts, items, size):
    tokens = [WORD.findall((t or "").translate(LOWER)) for t in texts]
    wins = collections.defaultdict(set)
    for item, t in items:
        w = WORD.findall((t or "").translate(LOWER))
        for k in range(max(len(w) - size + 1, 1) if w else 0):
            wins[tuple(w[k : k + size])].add(item)
    out = {}
    for i, w in enumerate(tokens):
        hit, found = set(), set()
        for n in {len(x) for x in wins}:
            for k in range(len(w) - n + 1):
                if own := wins.get(tuple(w[k : k + n])):
                    hit |= set(range(k, k + n))
                    found |= own
        listed = ",".join(sorted(map(str, found)))
        out[i] = (len(w), len(hit), len(found), hashlib.sha256(listed.encode()).hexdigest(), bool(hit))
    return out


def test_decontamination(spark, monkeypatch):
    texts = corpus(4)
    items = [(10, " ".join(texts[3].split()[33:60])), (9, texts[0].upper()), (2, "x y"), (3, "a-b c"), (4, None), (5, ""), (6, "zzz " * 30), (7, " ".join(texts[3].split()[40:52])), (8, "Ab cd Ab cd Ab cd Ab cd Ab cd Ab")]
    texts += ["q a-b, C q", "x y x y"]
    docs, bench = frame(spark, texts), spark.createDataFrame(items, "item_id long, text string")
    want = leaks(texts, items, 10)
    for limit in (decontamination.BROADCAST_ROWS, 0):
        monkeypatch.setattr(decontamination, "BROADCAST_ROWS", limit)
        got = {r[0]: tuple(r)[1:] for r in decontamination.contamination(docs, bench).collect()}
        assert got == want
    clean = decontamination.uncontaminated(docs, bench)
    assert sorted(r.doc_id for r in clean.collect()) == [i for i, x in want.items() if not x[4]] and clean.columns == docs.columns
    assert {r.n_hit for r in decontamination.contamination(docs, bench.limit(0)).collect()} == {0}
    assert decontamination.contamination(docs.limit(0), bench).count() == 0


def test_decontamination_with_repeated_items_and_ids(spark):
    texts = corpus(4) + ["q one two three four five six seven eight nine ten", "only a short one here", "eins zwei drei"]
    passage = lambda i, a, b: " ".join(texts[i].split()[a:b])
    items = [(1, passage(3, 33, 60))] * 3 + [(2, passage(0, 5, 17)), (2, passage(0, 15, 40)), (2, texts[-3][2:])]
    items += [(None, passage(0, 0, 12)), (None, "a short one"), (None, "a short one"), (3, "drei"), (3, "Drei!"), (4, "eins")]
    docs, bench = frame(spark, texts), spark.createDataFrame(items, "item_id long, text string")
    # a null id is one item and has no name
    want = {}
    for i, (n, hit, found, _, dirty) in leaks(texts, items, 10).items():
        names = ",".join(sorted(str(k) for k in {k for k, _ in items if k is not None} if leaks([texts[i]], [x for x in items if x[0] == k], 10)[0][4]))
        want[i] = (n, hit, found, hashlib.sha256(names.encode()).hexdigest(), dirty)
    got = {r[0]: tuple(r)[1:] for r in decontamination.contamination(docs, bench).collect()}
    assert got == want and all(want[i][4] for i in (0, 3, len(texts) - 3, len(texts) - 2, len(texts) - 1))
    assert sorted(r.doc_id for r in decontamination.uncontaminated(docs, bench).collect()) == [i for i, x in want.items() if not x[4]]


def test_proximity(spark):
    docs = frame(spark, ["a x b c y", "c x x x x x a b", "a b", None])
    got = {(r.doc_id, r.start, r.end) for r in decontamination.proximity(docs, ["c", "a", "b"], 1).collect()}
    assert got == {(0, 0, 3)}


def test_base_spans_follow_the_patterns():
    rng = random.Random(9)
    parts = ["a.b@c.d", "@", "x@y", "1.2.3.4", "256.1.1.1", "1.2.3.4.5.6.7.8.9", "4111 1111 1111 1111", "4111111111111112", "+1 (212) 555-0100", "+12", "++49 30 1234567", "0", ".", " ", "-", "é", "1.2.3", "a@b.c@d.e", "5500-0000-0000-0004 1", "..", "%@a-.b-"]
    email, ip = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    card, phone = re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
    digits = lambda s: [c for c in s if "0" <= c <= "9"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 9)))
        want = {
            "email": [m.span() for m in email.finditer(text)],
            "ip": [m.span() for m in ip.finditer(text) if all(int(x) <= 255 for x in m.group().split("."))],
            "card": [m.span() for m in card.finditer(text) if 13 <= len(digits(m.group())) <= 19 and pii.luhn("".join(digits(m.group())))],
            "phone": [m.span() for m in phone.finditer(text) if 9 <= len(digits(m.group())) <= 15],
        }
        assert pii.base_spans(text) == want, text


def test_pii_scan_and_redaction(spark):
    texts = [f"mail me at user{k}@mail.example.com or +1 212 555 01{k:02d} then 41111111111111{k:02d} end" for k in range(60)] + ["", None, "é" * 10 + " 10.0.0.1", "1" * 50_000, "a" * 50_000 + "@"]
    docs = frame(spark, texts)
    model = pii.fit(docs)
    got = {r.doc_id: r for r in pii.scan(docs, model).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        base = pii.base_spans(t or "")
        listed = ",".join(f"{k}:{a}:{b}" for k in pii.KINDS for a, b in base[k])
        assert got[i].base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert (got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone) == tuple(len(base[k]) for k in pii.KINDS)
        assert {f"{k}:{a}:{b}" for k in pii.KINDS for a, b in base[k]} <= set(got[i].spans.split(",")) | {""}
    clean = {r.doc_id: r.text for r in pii.scan(docs, model, with_text=True).collect()}
    assert clean[61] is None and clean[62] == "é" * 10 + " <IP>" and "@" not in clean[0]
    assert pii.fit(docs.limit(0)) is None and pii.scan(docs.limit(0), None).count() == 0


def test_boosted_trees_learn():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float)
    trees = pii.BoostedTrees(x[:400], y[:400])
    assert ((trees.chances(x[400:]) > 0.5) == y[400:]).mean() > 0.9


def test_language_id(spark):
    rng = random.Random(1)
    syllables = {"en": "th he in er an".split(), "de": "ch ei sch ung ge".split(), "fr": "ou eau que les é".split(), "qq": "zz xk qv".split()}
    rows = []
    for k in range(400):
        lang = list(syllables)[k % 4]
        rows.append((k, " ".join("".join(rng.choice(syllables[lang]) for _ in range(3)) for _ in range(rng.randint(2, 40))), lang))
    rows += [(400, None, "en"), (401, "", "de"), (402, "123 !?", "fr"), (403, "thehe inan", None), (None, "eauque les", "fr")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("x"))
    got = {r.doc_id: r for r in language_id.identify(docs).collect()}
    assert len(got) == len(rows)
    for k, _, lang in rows[:400]:
        assert got[k].held_out == (zlib.crc32(str(k).encode()) % 4 == 2)
    held = [k for k in range(400) if got[k].held_out]
    assert sum(got[k].lang_pred == rows[k][2] for k in held) >= 0.98 * len(held)
    assert all(got[k].lang_pred == "und" and got[k].score == 0 for k in (400, 401, 402))
    assert got[403].lang_pred == "en" and not got[None].held_out
    assert all(0 <= r.score <= 1 for r in got.values())
    alone = language_id.identify(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in alone.collect()} == {"und"}
    assert language_id.identify(docs.limit(0)).count() == 0


@pytest.mark.parametrize("n", [1, 2, 4, 5, 9, 40])
def test_codewords_differ(n):
    code = language_id.codewords(n)
    assert len({tuple(r) for r in code}) == n and set(np.unique(code)) <= {-1.0, 1.0}


def rule_stats(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    wins = collections.Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
    hit = {k + j for k in range(len(w) - 2) if wins[tuple(w[k : k + 3])] > 1 for j in range(3)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(hit)


def test_quality_rules(spark):
    rng = random.Random(2)
    good = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta", "eps", "zeta"]) + str(rng.randrange(99)) for _ in range(120)) for _ in range(300)]
    bad = [" | ".join("###" + str(rng.randrange(9999)) for _ in range(80)) for _ in range(40)]
    texts = good + bad + corpus(6, 30) + ["a\nb\na\n\n a\na", "x y z x y z x y z"]
    labels = spark.createDataFrame([(k, int(k < 300)) for k in range(0, 340, 2)] + [(1, None), (2, 1)], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality_rules.judge(frame(spark, texts), labels).collect()}
    for k, t in enumerate(texts):
        r = got[k]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == rule_stats(t)
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
    assert sum(got[k].kept for k in range(300)) >= 299 and not any(got[k].kept for k in range(300, 340))
    unlabelled = quality_rules.judge(frame(spark, texts), labels.limit(0)).where("not base_failed and not kept")
    assert unlabelled.count() == 0
    assert quality_rules.judge(frame(spark, []), labels).count() == 0


def water_fill(sizes, weights, budget, cap):
    target, open_ = {}, set(sizes)
    left = budget
    while open_:
        level = left / sum(weights[s] for s in open_)
        over = {s for s in open_ if weights[s] * level > cap * sizes[s]}
        if not over:
            return target | {s: weights[s] * level for s in open_}
        for s in over:
            target[s] = cap * sizes[s]
            left -= target[s]
        open_ -= over
    return target


def test_mixing(spark):
    texts = corpus(8, 200)
    docs = frame(spark, texts)
    got = mixing.mix(docs).collect()
    again = {(r.doc_id, r.taken) for r in mixing.mix(docs.repartition(3)).collect()}
    assert {(r.doc_id, r.taken) for r in got} == again
    source = {r.doc_id: r.source for r in docs.collect()}
    sizes = collections.Counter()
    for r in got:
        assert r.size == len((texts[r.doc_id] or "").encode().split())
        assert 0 <= r.taken <= 2 * r.size
        sizes[source[r.doc_id]] += r.size
    ordered = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = {s: (3, 1, 2)[k % 3] for k, s in enumerate(ordered)}
    want = water_fill(sizes, weights, 1.5 * sum(sizes.values()), 2.0)
    largest = max(r.size for r in got)
    for s in sizes:
        own = [r for r in got if source[r.doc_id] == s]
        assert own[0].target == pytest.approx(want[s]) and own[0].source_size == sizes[s]
        assert abs(sum(r.taken for r in own) - want[s]) <= largest / 2
    assert mixing.mix(docs.limit(0)).count() == 0
    assert {r.taken for r in mixing.mix(frame(spark, [None, ""])).collect()} == {0}


def test_nested_thresholds_only_add(spark):
    docs = frame(spark, corpus(8, 100)).withColumn("source", F.lit("s"))
    low = {r.doc_id for r in mixing.mix(docs, total_share=0.3).collect() if r.taken}
    high = {r.doc_id for r in mixing.mix(docs, total_share=0.7).collect() if r.taken}
    assert low < high


def test_quality_rules_see_small_shares_of_repeats(spark):
    rng = random.Random(9)
    word = lambda: rng.choice(["alpha", "omega", "gamma", "delta"]) + str(rng.randrange(100, 999))
    texts = []
    for k in range(440):
        w = [word() for _ in range(120)]
        if k >= 400:  # 18 of 120 words repeat, less than any base rule takes
            w[60:63] = w[70:73] = w[80:83] = w[90:93] = w[100:103] = w[110:113] = [word(), word(), word()]
        texts.append(" ".join(w))
    labels = spark.createDataFrame([(k, int(k < 400)) for k in range(440)], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality_rules.judge(frame(spark, texts), labels).collect()}
    assert all(got[k].n_repeat_words == 18 and not got[k].base_failed for k in range(400, 440))
    assert not any(got[k].kept for k in range(400, 440)) and all(got[k].kept for k in range(400))


def test_context_tree_base_and_coding(spark):
    texts = corpus(11, 80)
    ids = list(range(len(texts) - 1)) + [None]
    got = context_tree.score(frame(spark, texts, ids)).collect()
    tokens = {i: (t or "").translate(LOWER).encode().split() + [None] for i, t in zip(ids, texts, strict=True)}
    counts = collections.Counter(x for i, w in tokens.items() if i is not None and zlib.crc32(str(i).encode()) % 10 for x in w)
    total, distinct = sum(counts.values()), len(counts)
    assert len(got) == len(texts)
    for r in got:
        w = tokens[r.doc_id]
        base = sum(np.log10((counts[x] + 0.1) / (total + 0.1 * (distinct + 1))) for x in w)
        assert r.base_score == pytest.approx(base) and r.n_tokens == len(w) and r.n_known == sum(counts[x] > 0 for x in w)
        assert r.train_tokens == total and r.score < 0
    assert context_tree.score(frame(spark, [])).count() == 0


def test_context_tree_scores_partitions_with_the_same_rows(spark):
    texts = ["one two three", "two three four", None]
    docs = frame(spark, texts).coalesce(1)
    counts = collections.Counter(x for i, t in enumerate(texts) if zlib.crc32(str(i).encode()) % 10 for x in [*(t or "").split(), None] * 2)
    got = context_tree.score(docs.unionAll(docs)).collect()
    assert sorted(r.doc_id for r in got) == [0, 0, 1, 1, 2, 2]
    scale = np.log10(sum(counts.values()) + 0.1 * (len(counts) + 1))
    for r in got:
        w = [*(texts[r.doc_id] or "").split(), None]
        assert r.base_score == pytest.approx(sum(np.log10(counts[x] + 0.1) - scale for x in w))
        assert r.n_known == sum(counts[x] > 0 for x in w)


def brute_ctw(data, depth):
    """Weighted log probabilities and predictions from a plain recursive context tree."""
    pad = bytes([255]) * depth
    counts = collections.Counter()
    for t in data:
        full = pad + t + b"\xff"
        for i in range(depth, len(full)):
            for k in range(8):
                node, bit = 1 << k | full[i] >> 8 - k, full[i] >> 7 - k & 1
                for d in range(depth + 1):
                    counts[full[i - d : i], node, bit] += 1
    from math import exp, lgamma, log

    kt = lambda a, b: lgamma(a + 0.5) + lgamma(b + 0.5) - lgamma(a + b + 1) - log(np.pi)
    nodes = {(c, n) for c, n, _ in counts}
    weight, memo = {}, {}
    for c, n in sorted(nodes, key=lambda x: -len(x[0])):
        own = kt(counts[c, n, 0], counts[c, n, 1])
        if len(c) == depth:
            memo[c, n], weight[c, n] = own, 1.0
        else:
            below = sum(memo[x, n] for x in {c2 for c2, n2 in nodes if n2 == n and len(c2) == len(c) + 1 and c2.endswith(c)})
            memo[c, n] = np.logaddexp(own, below) - log(2)
            weight[c, n] = exp(own - log(2) - memo[c, n])
    return counts, weight


def test_context_tree_equals_a_plain_tree(spark):
    data = [b"abracadabra", b"abrabra", b"cadab"]
    rows = spark.createDataFrame([(k, t.decode()) for k, t in enumerate(data)], "doc_id long, text string")
    grams = rows.select("text").mapInPandas(context_tree._count, "kind int, key long, n long").where("kind = 0").groupBy("key").agg(F.sum("n").alias("n"))
    model = context_tree.fit(grams)
    counts, weight = brute_ctw(data, context_tree.DEPTH)
    held = [b"abrac", b"zebra", b""]
    got = context_tree.text_scores(held, model)
    for text, score in zip(held, got, strict=True):
        full, total = b"\xff" * context_tree.DEPTH + text + b"\xff", 0.0
        for i in range(context_tree.DEPTH, len(full)):
            for k in range(8):
                node, bit, chance, known = 1 << k | full[i] >> 8 - k, full[i] >> 7 - k & 1, 0.5, False
                for d in range(context_tree.DEPTH, -1, -1):
                    c = full[i - d : i]
                    if (c, node) in weight:
                        p = (counts[c, node, bit] + 0.5) / (counts[c, node, 0] + counts[c, node, 1] + 1)
                        w = weight[c, node] if known else 1.0
                        chance, known = w * p + (1 - w) * chance, True
                total += np.log10(chance)
        assert score == pytest.approx(total, rel=1e-4)


def test_context_tree_keeps_every_node_apart(spark):
    rng = random.Random(3)
    letters = "".join(map(chr, range(97, 123))) + " 0123456789"
    data = ["".join(rng.choice(letters) for _ in range(6000)).encode(), b"never seen " * 3]
    rows = spark.createDataFrame([(t.decode(),) for t in data], "text string")
    grams = rows.mapInPandas(context_tree._count, "kind int, key long, n long").where("kind = 0").groupBy("key").agg(F.sum("n").alias("n"))
    depth, counts = context_tree.DEPTH, collections.defaultdict(lambda: [0, 0])
    steps = lambda full: ((full[i - depth : i], 1 << k | full[i] >> 8 - k, full[i] >> 7 - k & 1) for i in range(depth, len(full)) for k in range(8))
    for t in data:
        for context, node, bit in steps(b"\xff" * depth + t + b"\xff"):
            for d in range(depth + 1):
                counts[context[depth - d :], node][bit] += 1
    from math import exp, lgamma, log

    weight, below = {}, collections.defaultdict(float)
    for (c, n), (a, b) in sorted(counts.items(), key=lambda x: -len(x[0][0])):
        own = total = lgamma(a + 0.5) + lgamma(b + 0.5) - lgamma(a + b + 1) - log(np.pi)
        weight[c, n] = 1.0
        if len(c) < depth:
            total = np.logaddexp(own, below[c, n]) - log(2)
            weight[c, n] = exp(own - log(2) - total)
        if c:
            below[c[1:], n] += total
    held = ["".join(rng.choice(letters) for _ in range(500)).encode(), b"\xc3\xa9 never seen", b""]
    for text, score in zip(held, context_tree.text_scores(held, context_tree.fit(grams)), strict=True):
        want = 0.0
        for context, node, bit in steps(b"\xff" * depth + text + b"\xff"):
            chance, known = 0.5, False
            for d in range(depth, -1, -1):
                c = context[depth - d :]
                if (c, node) in counts:
                    p = (counts[c, node][bit] + 0.5) / (sum(counts[c, node]) + 1)
                    chance, known = (weight[c, node] * p + (1 - weight[c, node]) * chance if known else p), True
            want += np.log10(chance)
        assert score == pytest.approx(want, rel=1e-6)


PAGE = """<html><head><title>t</title><style>p{}</style><script>var a="<p>no</p>"</script></head><body>
<nav><a href=x>Home</a><a href=y>About</a></nav><div class="cookie-notice">We use cookies.</div>
<article><h1>The   title</h1><p>First &amp; foremost,
a paragraph of words that read like prose.</p><!-- c --><div class="ad">Buy now</div><p>Second <b>bold</b> one&nbsp;here.</article>
<aside>Related</aside><form><label>Mail</label><input></form><section id="comments"><p>A reader says this article is nice.</p></section><footer>&copy; 2024</footer></body></html>"""


def test_html_content(spark):
    pages = spark.createDataFrame([(k, f"u{k}", PAGE.replace("title", f"title {k}")) for k in range(30)] + [(30, None, None), (31, "u", ""), (32, "u", "<p>Only &lt;this&gt; sentence stands here.</p"), (None, "u", "<" * 300)], "page_id long, url string, html string")
    got = {r.page_id: r for r in html_content.extract(pages, html_content.fit(pages)).collect()}
    assert len(got) == 34
    for k in range(30):
        assert got[k].text == f"The title {k}\nFirst & foremost, a paragraph of words that read like prose.\nSecond bold one here."
        assert got[k].n_chars == len(got[k].text)
    assert got[30].text == got[31].text == "" and got[32].text.startswith("Only <this> sentence")
    assert html_content.extract(pages.limit(0), html_content.PRIOR).count() == 0


def test_min_cut_by_brute_force():
    rng = np.random.default_rng(4)
    for _ in range(60):
        n = int(rng.integers(1, 8))
        a, b = rng.random(n) * 3, rng.random(n) * 3
        edges = [(i, j, float(rng.random())) for i in range(n) for j in range(i) if rng.random() < 0.5]
        cost = lambda keep: sum(b[i] if k else a[i] for i, k in enumerate(keep)) + sum(w for i, j, w in edges if keep[i] != keep[j])
        # content costs what the other terminal would have carried
        got = html_content.min_cut(a, b, edges)
        best = min(cost([bool(m >> i & 1) for i in range(n)]) for m in range(2**n))
        assert cost(list(got)) == pytest.approx(best)


def test_isolation_forest_scores_outliers_higher():
    rng = np.random.default_rng(0)
    rows = rng.normal(size=(1000, 4))
    forest = quality_rules.IsolationForest(rows)
    assert forest.scores(np.full((1, 4), 8.0))[0] > forest.scores(rows).max() - 1e-9
    assert quality_rules.IsolationForest(np.zeros((5, 3))).scores(np.zeros((2, 3))).shape == (2,)


def test_word_arrays_equal_split():
    texts = ["a  b\tc", "", " é\x0bz ", "x", "\n"]
    for _, held in chunks(texts, 4):
        buf, starts = joined(held)
        hashes, begin, end, first = words(buf, starts, False)
        got = [[bytes(buf[begin[k] : end[k]]) for k in range(a, b)] for a, b in zip(first[:-1], first[1:], strict=True)]
        assert got == [h.split() for h in held]
