"""Blocks of pages with end tags left out, odd tags and unclosed elements, against the same pages written in full."""

import random
import re

import pytest

from popforge.llm.html_content import blocks_of


def texts(page):
    return [b.text for b in blocks_of(page)]


class Writer:
    """Writes random pages twice: with all tags, and with those left out that HTML lets one leave out."""

    def __init__(self, seed):
        self.rng, self.words = random.Random(seed), iter(range(10**6))
        self.want = []

    def text(self, wanted=True):
        out = " ".join(f"w{next(self.words)}" for _ in range(self.rng.randint(1, 6)))
        if wanted:
            self.want.append(out)
        return out

    def inline(self):
        a, b = f"a{next(self.words)}", f"b{next(self.words)}"
        kind = self.rng.randrange(5)
        self.want.append(f"{a} {b}")
        return [f"{a} {b}", f"<b>{a}</b> {b}", f"{a}<br>{b}", f'<a href="x.html?a=1&amp;b=2">{a}</a> {b}', f"{a} <button type=button>press</button>{b}"][kind]

    def section(self, depth=0):
        kind = self.rng.randrange(7 if depth < 3 else 4)
        if kind == 0:
            return f"<p>{self.inline()}{{/p}}"
        if kind == 1:
            return "<ul>" + "".join(f"<li>{self.inline()}{{/li}}" for _ in range(self.rng.randint(1, 3))) + "</ul>"
        if kind == 2:
            return "<dl>" + "".join(f"<dt>{self.text()}{{/dt}}<dd>{self.inline()}{{/dd}}" for _ in range(2)) + "</dl>"
        if kind == 3:
            head = f"<thead><tr><th>{self.text()}{{/th}}{{/tr}}{{/thead}}"
            rows = "".join(f"<tr><td>{self.inline()}{{/td}}<td>{self.text()}{{/td}}{{/tr}}" for _ in range(2))
            return f"<table>{head}<tbody>{rows}{{/tbody}}</table>"
        if kind == 4:
            return f"<form><select><option>{self.text(False)}{{/option}}<option>{self.text(False)}{{/option}}</select></form>"
        if kind == 5:
            return f"<script>if (a < b) document.write('<p>no</p>')</script><!-- <p>no --><svg width=1><path d='M0'/><text>no</text></svg>"
        return f"<{'div'} class='x'>" + "".join(self.section(depth + 1) for _ in range(self.rng.randint(1, 3))) + "</div>"

    def page(self):
        body = "".join(self.section() for _ in range(self.rng.randint(2, 5)))
        return f"<!DOCTYPE html><html><head><meta charset=utf-8><title>t {self.rng.random()}</title><style>p{{{{}}}}</style>{{/head}}<body>{body}{{/body}}{{/html}}"


@pytest.mark.parametrize("seed", range(200))
def test_optional_end_tags(seed):
    writer = Writer(seed)
    page = writer.page()
    full = re.sub(r"\{(/\w+)\}", r"<\1>", page)
    short = re.sub(r"\{(/\w+)\}", "", page)
    some = re.sub(r"\{(/\w+)\}", lambda m: f"<{m[1]}>" if writer.rng.random() < 0.5 else "", page)
    assert texts(full) == writer.want
    assert texts(short) == texts(some) == writer.want
    bare = re.sub(r"<(html|head|body)>", "", short)
    assert texts(bare) == writer.want


@pytest.mark.parametrize(
    "page, want",
    [
        ("<html><head><title>T</title><body><article><p>One two</p></article>", ["One two"]),
        ("<head><meta charset=x><link href=y>text", ["text"]),
        ("<body><button>Menu<article><p>Body</article>", ["Body"]),
        ("<button>One<button>Two</button><p>Body", ["Body"]),
        ("<body><select><option>a<option>b<p>Body", ["Body"]),
        ("<object data=x>fallback</object> after", ["fallback after"]),
        ("<p>The value <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></math> is used", ["The value x=2 is used"]),
        ("<noscript>no<p>Body", ["Body"]),
        ("<button><div>in</div></button><p>out", ["out"]),
        ("<a href=http://x.com/>link</a> after <div/>block", ["link after", "block"]),
        ("<svg/><p>Body", ["Body"]),
        ('<p class="x>one</p><p>two</p>', ["one", "two"]),
        ("<p title='a>b' hidden=>c</p>", ["c"]),
        ("<p " + "a " * 30_000 + ">long", ["long"]),
        ("<p x='" + "a " * 30_000 + "'>long", ["long"]),
        ("1 < 2 and <3", ["1 < 2 and <3"]),
    ],
)
def test_odd_pages(page, want):
    assert texts(page) == want


@pytest.mark.parametrize("piece", ['<a "', "<a =", '<a ="', "<a b='", "<", "<button>", "<p>x", "<svg><", "<noscript><p>", "<head>"])
def test_long_odd_pages_take_linear_time(piece):
    import time

    began = time.perf_counter()
    texts(piece * 50_000)
    assert time.perf_counter() - began < 10
