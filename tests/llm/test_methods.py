"""What the methods themselves do: learned spans, labels without telling names, decoding, path lengths, hot groups."""

import collections
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from popforge.llm import context_tree, decontamination, html_content, jaccard_join, language_id, pii, quality_rules, shared, substring_dedup, suffix_dedup

WORDS = ["stone", "river", "and", "the", "of", "walking", "under", "green", "lamp", "a", "house", "with", "long", "quiet", "evening", "then"]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def pii_model(spark):
    rng = random.Random(1)
    texts = []
    for k in range(1500):
        text = prose(rng, 60)
        if k % 5 == 0:
            text += rng.choice([f" mail{k}@host.example.com", f" 10.{k % 250}.3.4", " 4111111111111111", " +1 (212) 555-0100"]) + " " + prose(rng, 10)
        texts.append(text)
    return pii.fit(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))


def test_pii_adds_what_the_rules_miss(pii_model):
    texts = {
        "email": ["please ask jane.doe (at) uni-town (dot) edu about the house", "the evening mark77 [at] river [dot] com then", "write to anna_b at stone dot org today"],
        "ip": ["the host 10 . 20 . 30 . 40 under the lamp", "then 192[.]168[.]7[.]21 of the river"],
        "card": ["the card 4111.1111.1111.1111 with a lamp", "under 5500_0000_0000_0004 the green", "a 4012/8888/8888/1881 and then"],
        "phone": ["call (212) 555-0147 then walking", "the quiet 212-555-0147 evening", "phone +44/207/9460123 under"],
    }
    found = {kind: [bool(set(every[kind]) - set(base[kind])) for base, every in pii.find_spans(given, pii_model)] for kind, given in texts.items()}
    assert sum(map(sum, found.values())) >= 9, found
    assert all(any(own) for own in found.values()), found


def test_pii_precision_and_recall_on_held_out_specimens(pii_model):
    rng = random.Random(99)
    hit, total, wrong, fakes = 0, 0, 0, 0
    for _ in range(150):
        for kind in range(4):
            for real in (True, False):
                left, own = prose(rng, 12) + " ", pii.specimen(rng, kind, real)
                [(base, every)] = pii.find_spans([left + own + " " + prose(rng, 12)], pii_model)
                span = (len(left), len(left) + len(own))
                if real:
                    hit, total = hit + (span in every[pii.KINDS[kind]]), total + 1
                else:
                    wrong, fakes = wrong + any(set(every[k]) - set(base[k]) for k in pii.KINDS), fakes + 1
    assert hit / total > 0.75 and wrong / fakes < 0.02, (hit / total, wrong / fakes)


def test_pii_leaves_look_alikes(pii_model):
    for text in ["on 2024-01-13 the 12.05.2023 lamp", "version 1.2.3 of the house", "a 4111111111111112 stone", "token = \"1eb9c654e721b4f812088970e66a6345\"", "meet at the house. then walk", "pages 1990-1995 and 12 34"]:
        [(base, every)] = pii.find_spans([text], pii_model)
        assert base == every, (text, every)


@pytest.mark.parametrize("text", ["1" * 1_000_000, "1." * 500_000, "a@" * 300_000, "+1 " * 300_000, " at dot " * 100_000])
def test_pii_is_linear(pii_model, text):
    began = time.time()
    pii.base_spans(text)
    assert time.time() - began < 3
    pii.find_spans([text], pii_model)
    assert time.time() - began < 12


def site(rng, k, names="telling"):
    """A page and the texts of its article."""
    head = f"{prose(rng, 6)} {k}"
    own = [f"{prose(rng, rng.randint(25, 80))}." for _ in range(rng.randint(3, 6))]
    nav = "".join(f'<li><a href="/{w}">{w} {prose(rng, 1)}</a></li>' for w in rng.sample(WORDS, 6))
    tag = {"telling": ("nav", "article", "footer", ' class="ad"'), "none": ("div", "div", "div", ""), "lying": ('div class="content"', 'div class="sidebar"', "div", ' class="story"')}[names]
    close = [t.split()[0] for t in tag[:3]]
    body = f"<h1>{head}</h1>" + "".join(f"<p>{t}</p>" for t in own)
    return f"<html><body><{tag[0]}><ul>{nav}</ul></{close[0]}><div{tag[3]}>{prose(rng, 3)} now</div><{tag[1]}>{body}</{close[1]}><{tag[2]}>&copy; {prose(rng, 3)}</{close[2]}></body></html>", [head, *own]


@pytest.fixture(scope="module")
def html_model(spark):
    rng = random.Random(2)
    return html_content.fit(spark.createDataFrame([(k, site(rng, k)[0]) for k in range(200)], "page_id long, html string"))


@pytest.mark.parametrize("names, least", [("telling", 1.0), ("none", 0.95), ("lying", 0.8)])
def test_html_by_names_without_them_and_against_them(html_model, names, least):
    rng = random.Random(3)
    right = total = 0
    for k in range(60):
        page, want = site(rng, k, names)
        blocks = html_content.blocks_of(page)
        kept = {b.text for b in html_content.content_blocks(blocks, html_model)}
        right += sum((b.text in kept) == (b.text in want) for b in blocks)
        total += len(blocks)
    assert right / total >= least, right / total


def test_html_comments_and_adverts_inside_the_article(html_model):
    rng = random.Random(4)
    own = [f"{prose(rng, 40)}." for _ in range(4)]
    page = f"<body><article><h1>{prose(rng, 5)}</h1><p>{own[0]}</p><div class='ad'>{prose(rng, 4)}</div><p>{own[1]}</p><p>{own[2]}</p><section class='comments'><h3>Comments</h3><p>I like it.</p><p>Me too.</p></section></article></body>"
    kept = [b.text for b in html_content.content_blocks(html_content.blocks_of(page), html_model)]
    assert kept[1:] == own[:3]


def test_the_cut_changes_labels(html_model):
    rng = random.Random(6)
    changed = 0
    for k in range(60):
        blocks = html_content.blocks_of(site(rng, k, "lying")[0])
        scores = html_model.scores(blocks)
        changed += int((html_content.content_labels(blocks, scores) != (scores > 0)).sum())
    # a short piece between long ones goes with them
    near = html_content.blocks_of("<div><p>" + "</p><p>".join([prose(rng, 60), "so it was then", prose(rng, 60)]) + "</p></div>")
    scores = np.array([6.0, -0.5, 6.0])
    assert list(html_content.content_labels(near, scores)) == [True, True, True] and changed >= 10


def test_html_blocks_are_linear():
    began = time.time()
    html_content.blocks_of("<div>" * 60_000 + "</p>" * 60_000)
    html_content.blocks_of("<b " * 20_000 + '"')
    assert time.time() - began < 20


def test_language_decoding_by_brute_force(spark):
    rng = random.Random(7)
    letters = {"aa": "abcde", "bb": "fghij", "cc": "klmno", "dd": "pqrst", "ee": "uvwxy", "ff": "acegi"}
    rows = [(k, lang, " ".join("".join(rng.choice(letters[lang]) for _ in range(5)) for _ in range(40))) for k in range(120) for lang in [list(letters)[k % 6]]]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    model = language_id.fit(docs)
    assert model["langs"] == sorted(letters)
    got = {r.doc_id: (r.lang_pred, r.score) for r in language_id.predict(docs, model).collect()}
    for i, lang, text in rows:
        data = text.encode() + b"\n"
        grams = language_id.gram_buckets(np.frombuffer(data + data[:2], np.uint8))
        evidence = sum(model["weights"][grams[j, 0]].astype(float) + model["weights"][grams[j, 1]] for j in range(len(data))) / (2 * len(data))
        loss = [sum(np.log1p(np.exp(-language_id.SHARPNESS * e * bit)) * w for e, bit, w in zip(evidence, word, model["bit_weight"])) for word in model["code"]]
        odds = np.exp(-(np.array(loss) - min(loss)))
        assert got[i][0] == model["langs"][int(np.argmax(odds))] == lang
        assert got[i][1] == pytest.approx(odds.max() / odds.sum(), rel=1e-4)


def test_many_languages_are_no_error(spark):
    rows = [(k, f"l{k % 700:03d}", f"{chr(97 + k % 26)}{chr(97 + k // 26 % 26)} " * 20) for k in range(1400)]
    model = language_id.fit(spark.createDataFrame(rows, "doc_id long, lang string, text string"))
    assert len(model["langs"]) == 700 and np.isfinite(model["weights"]).all() and model["bit_weight"].sum() == pytest.approx(1)


def test_long_texts_are_scored_in_pieces(spark, monkeypatch):
    rng = np.random.default_rng(1)
    weights = rng.normal(size=(language_id.BUCKETS, 3)).astype(np.float32)
    held = [b"abc def", b"", b"x" * 900, b"the end of it " * 40]
    whole = language_id.bit_evidence(weights, held)
    monkeypatch.setattr(language_id, "CHUNK", 64)
    assert np.allclose(language_id.bit_evidence(weights, held), whole, atol=1e-5)


def test_isolation_paths_by_brute_force():
    rng = np.random.default_rng(8)
    rows = rng.normal(size=(300, 5))
    forest = quality_rules.IsolationForest(rows, trees=20, subsample=64)

    def path(t, x):
        node = 0
        while forest.path[t, node] < 0:
            node = 2 * node + (2 if x[forest.feature[t, node]] >= forest.cut[t, node] else 1)
        return forest.path[t, node]

    for x, score in zip(rows[:40], forest.scores(rows[:40]), strict=True):
        assert score == pytest.approx(2 ** (-np.mean([path(t, x) for t in range(20)]) / forest.norm))


def test_thinned_keeps_the_smallest_hashes(spark):
    df = spark.range(50_000)
    few = {r.id for r in shared.thinned(df, 300, "id").collect()}
    want = [r.id for r in df.orderBy(F.xxhash64("id")).limit(300).collect()]
    assert set(want) <= few and len(few) < 600
    assert shared.thinned(spark.range(10), 300, "id").count() == 10
    copies = spark.createDataFrame([(1, "a")] * 3000 + [(k, "b") for k in range(2, 500)], "k long, t string")
    assert shared.hash_sample(copies, 100, "k").groupBy("k").count().where("count > 1").count() == 0


def hot_passage(n, seed=0):
    """Documents that share a passage between texts of their own, so that its ends have as many contexts as documents."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    passage = " ".join(word() for _ in range(90))
    return [f"{' '.join(word() for _ in range(60))} {passage} {' '.join(word() for _ in range(60))}" for _ in range(n)] + [passage] * 3


def test_a_passage_in_many_documents(spark, monkeypatch):
    from popforge.llm import repeats

    from test_text_operators import frame, removed_bytes, removed_words

    monkeypatch.setattr(repeats, "HOT_CLASSES", 20)
    texts = hot_passage(80)
    got = {r[0]: tuple(r)[1:] for r in suffix_dedup.remove_repeats(frame(spark, texts)).collect()}
    assert got == dict(enumerate(removed_bytes(texts, 400)))
    words = collections.Counter(tuple(r) for r in substring_dedup.remove_repeats(frame(spark, texts)).collect())
    assert words == collections.Counter(removed_words(list(enumerate(texts)), 50))


def test_documents_of_shared_passages_are_not_linked(spark):
    texts = hot_passage(60, 1)
    got = {r.doc_id: r.component_id for r in jaccard_join.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 5, 80).collect()}
    assert got == {k: min(k, 60) for k in range(63)}


def test_shingles_held_alone_end_a_search(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    base = [word() for _ in range(100)]
    texts = [" ".join(base), " ".join(base[:97] + [word() for _ in range(3)]), " ".join(word() for _ in range(100)), " ".join(base[:50] + [word() for _ in range(50)])]
    left = jaccard_join.sharing(spark.createDataFrame([(t,) for t in texts], "text string"), 3, 90)
    keys = [jaccard_join.set_key(own) for _, own in jaccard_join._sets(texts, 3)]
    assert {r.key for r in left.collect()} == set(keys[:2])


def test_context_depth_is_a_parameter(spark):
    rng = random.Random(5)
    texts = [prose(rng, 120) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bits = {}
    for depth in (2, 4, 6):
        held = [r for r in context_tree.score(docs, depth).collect() if r.held_out]
        bits[depth] = -sum(r.score for r in held) / np.log10(2) / sum(len(texts[r.doc_id]) + 1 for r in held)
    assert bits[6] < bits[2] and bits[4] < bits[2]


def test_proximity_by_brute_force(spark):
    rng = random.Random(11)
    texts = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 40))) for _ in range(40)] + [None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for phrase, slop in ((["a", "b", "c"], 1), (["a", "a", "h"], 0), (["z", "a"], 3), ([], 1)):
        got = {tuple(r) for r in decontamination.proximity(docs, phrase, slop).collect()}
        distinct, want = set(phrase), set()
        for i, t in enumerate(texts):
            w = re.findall(r"\w", t or "")
            for p in range(len(w)):
                if w[p] in distinct and distinct <= set(w[p : p + len(distinct) + slop]):
                    want.add((i, p, max(p + w[p:].index(x) for x in distinct)))
        assert got == want, (phrase, slop)


def test_no_quality_statistic_has_a_dead_zone():
    import pandas as pd

    base = {"n_words": 100, "word_chars": 500, "n_symbols": 5, "n_dup_lines": 3, "n_repeat_words": 7, "n_lines": 50, "n_stops": 10}
    for column, k in (("word_chars", 0), ("n_symbols", 1), ("n_dup_lines", 2), ("n_repeat_words", 3), ("n_stops", 4)):
        rows = quality_rules.feature_matrix(pd.DataFrame([base | {column: v} for v in (0, 1, 2, 10, 40, 50, 60, 100, 400)]))[:, k]
        assert (np.diff(rows) > 0).all()
