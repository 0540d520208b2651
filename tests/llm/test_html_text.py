from __future__ import annotations

import html
import random

import pytest
from pyspark.sql import types as T

from tapebook.llm import html_text as H

LONG = "a sentence with quite a few words that make this paragraph dense enough"

CASES = [
    ("", ""),
    ("plain text only", "plain text only"),
    ("<body><p>Only   para\n here</p></body>", "Only para here"),
    ("<p>1 < 2 and 3 > 2</p>", "1 < 2 and 3 > 2"),
    ("<!-- c --><p>ok</p><p", "ok"),
    ('<script>var a="<p>no</p>"</script><style>x</style>', ""),
    (f"<article><header><h1>T</h1></header><p>x &nbsp; y&eacute;&#33;</p><footer>share</footer></article>", "T\nx yé!"),
    (f"<article><p>{LONG}<p>{LONG} <b>two<br>three</article>", f"{LONG}\n{LONG} two three"),
    (f"<div class='ad'>buy</div><div><h1>T</h1><p>{LONG}</p><p>{LONG}</p></div>", f"T\n{LONG}\n{LONG}"),
    (f"<div id=wrap class=has-sidebar><div class=sidebar><p>{LONG}</p></div><div><h1>T</h1><p>{LONG}.</p><p>{LONG}!</p></div></div>", f"T\n{LONG}.\n{LONG}!"),
    (f"<article><p>{LONG}</p></article><div id=comments><article class=comment><p>{LONG} {LONG}</p></article></div>", LONG),
    (f"<main><p>{LONG}</p><ul><li><a href=1>one</a></li><li><a href=2>two</a></li><li><a href=3>three</a></li></ul></main>", LONG),
    (f"<p>{LONG}</p><div style='display: none'>secret</div><div hidden>secret</div><form>name <input></form>", LONG),
    (f"<div class=body><section><p>{LONG}</p></section><section><p>{LONG}!</p></section></div>", f"{LONG}\n{LONG}!"),
    (f"<article><ul><li>one<li>two</ul><table><tr><td>a<td>b</table><pre>x\n  y</pre></article>", "one\ntwo\na\nb\nx y"),
    (f"<article><a href=\"x>y\">link</a> text <img alt='a>b'>here</article>", "link text here"),
]


@pytest.mark.parametrize("source,text", CASES)
def test_cases(source, text):
    assert H.main_text(source) == text


def test_density_falls_with_links():
    plain = H.composite_density(200, 2, 0, 0, 0.1)
    assert plain > H.composite_density(200, 2, 100, 1, 0.1) > H.composite_density(200, 2, 180, 2, 0.1)
    assert H.composite_density(400, 2, 0, 0, 0.1) > plain
    assert H.composite_density(50, 3, 50, 3, 0.1) == 0


def random_page(rng):
    words = ["alpha", "beta", "&", "<3", "gärten", "delta,", "\"quoted\"", "don't", "5 > 4", "end."]

    def line(n):
        return " ".join(rng.choice(words) for _ in range(n))

    blocks = [line(rng.randint(4, 60)) for _ in range(rng.randint(1, 9))]
    title = line(5)
    escape = lambda t: html.escape(t, quote=rng.random() < 0.5)
    body = "".join(rng.choice(["<p>{}</p>", "<p class='x y'>{}", "<p><b>{}</b></p>\n", "<p>{}<br></p>"]).format(escape(b)) for b in blocks)
    tag, attributes = rng.choice([("article", ""), ("main", ""), ("div", " class='entry'"), ("section", " id=story")])
    links = "".join(f"<li><a href='/{i}'>{escape(line(1))}</a></li>" for i in range(rng.randint(3, 9)))
    beside = [
        f"<nav><ul>{links}</ul></nav>", f"<div class='menu'><ul>{links}</ul></div>", f"<aside><p>{escape(line(9))}</p></aside>",
        f"<div class='sidebar-right'><p>{escape(line(12))}</p></div>", f"<div class='cookie-notice'>{escape(line(8))}</div>",
        f"<header><a href='/'>{escape(line(2))}</a></header>", f"<form action=x>{escape(line(4))}<input name=q></form>",
        f"<div class=ad>{escape(line(6))}</div>", "<script>if (a < b) { document.write('<p>no</p>') }</script>",
    ]
    before = "".join(rng.sample(beside, rng.randint(0, 5)))
    after = "".join(rng.sample(beside, rng.randint(0, 3))) + f"<section id='comments'><p>{escape(line(30))}</p></section>" * rng.randint(0, 2)
    page = f"<!DOCTYPE html><html><head><title>{escape(title)}</title><style>p{{}}</style></head><body>{before}<{tag}{attributes}><h1>{escape(title)}</h1>{body}</{tag}>{after}<footer>&copy; {escape(line(5))}</footer>"
    return page + "</body></html>" * rng.randint(0, 1), "\n".join([title, *blocks])


def test_random_pages():
    rng = random.Random(4)
    pages = [random_page(rng) for _ in range(400)]
    right = sum(H.main_text(p) == t for p, t in pages)
    assert right >= 390


SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("page_id", "url", "html", "text", "N_chars")])


def test_operator(spark):
    sources = [None, "", "<p>" + "word " * 60000 + "</p>", *(c[0] for c in CASES), "<p>twice</p>", "<p>twice</p>"]
    docs = spark.createDataFrame([(str(i), None, s, "clash", None) for i, s in enumerate(sources)], SCHEMA)
    out = H.extract(docs)
    assert out.columns == ["page_id", "url", "text", "N_chars", "text_", "n_chars_"]
    for r in out.collect():
        assert r.text == "clash"
        assert r.text_ == H.main_text(sources[int(r.page_id)] or "")
        assert r.n_chars_ == len(r.text_)


def test_empty_table(spark):
    assert H.extract(spark.createDataFrame([], SCHEMA)).collect() == []


LONG = "This sentence has many words, and it goes on and on for quite a while. " * 4


def test_siblings_of_an_article_element_meet_the_threshold():
    first, second = (f"<article>{f'<p>{name} {LONG}</p>' * n}</article>" for name, n in (("One", 4), ("Two", 3)))
    menu = "<ul>" + "<li><a href=x>menu entry</a></li>" * 9 + "</ul>"
    got = H.main_text(f"<body><h1>Headline</h1>{first}{second}<div><p>Three {LONG}</p><p>Three {LONG}</p></div>{menu}</body>")
    lines = [line.split()[0] for line in got.split("\n")]
    assert lines == ["Headline", *["One"] * 4, *["Two"] * 3, "Three", "Three"]


def test_hinted_sections_and_link_lists_in_an_article_meet_the_threshold():
    menu = "<ul>" + "<li><a href=x>menu entry</a></li>" * 9 + "</ul>"
    page = f"<body><article><p>{LONG}</p><p>{LONG}</p><div class=sidebar><p>Box {LONG}</p></div><div class=share>Share</div>{menu}</article></body>"
    got = H.main_text(page)
    assert "Box This" in got and "menu" not in got and "Share" not in got
    assert "Ad" not in H.main_text(f"<body><p>{LONG}</p><p>{LONG}</p><div class=ad><p>Ad {LONG}</p></div></body>")


def random_tree(rng, depth=0):
    tag = rng.choice(["div", "section", "div", "span", "a"] if depth else ["div"])
    inside = [rng.choice(["", "word", "some more words here", "x" * 60]) if rng.random() < 0.5 or depth > 4 else random_tree(rng, depth + 1) for _ in range(rng.randint(0, 5))]
    if tag in ("a", "span"):
        inside = [x for x in inside if isinstance(x, str)]
    return tag, inside


def render(tree):
    return f"<{tree[0]}>" + "".join(x if isinstance(x, str) else render(x) for x in tree[1]) + f"</{tree[0]}>"


def measures(tree, in_link=False, out=None):
    """(tag, characters, tags, characters in links, links) of every element in page order, by recursion."""
    here = len(out)
    out.append(None)
    tag, linked = tree[0], in_link or tree[0] == "a"
    chars = tags = link_chars = links = 0
    below = []
    for x in tree[1]:
        if isinstance(x, str):
            n = len(x.replace(" ", ""))
            chars, link_chars = chars + n, link_chars + n * linked
        else:
            child = measures(x, linked, out)
            below.append(child)
            chars, tags = chars + child[1], tags + child[2] + 1
            link_chars, links = link_chars + child[3], links + child[4] + (x[0] == "a")
    out[here] = (tag, chars, tags, link_chars, links, below)
    return out[here]


def test_densities_equal_plain_recursion():
    rng = random.Random(3)
    for _ in range(200):
        tree = random_tree(rng)
        page = H.Page(f"<body>{render(tree)}</body>")
        want = []
        measures(("body", [tree]), out=want)
        total = want[0]
        base = total[3] / max(1, total[1])
        density = lambda m: H.composite_density(*m[1:5], base) if m[1] else 0.0

        def summed(m):
            blocks = [c for c in m[5] if c[0] not in H.INLINE and c[1]]
            return sum(map(density, blocks)) if blocks else density(m)

        for e, m in zip(page.elements[1:], want, strict=True):
            assert (e.tag, e.chars, e.tags, e.link_chars, e.link_tags) == m[:5]
            assert e.density == pytest.approx(density(m)) and e.density_sum == pytest.approx(summed(m))
        blocks = [k for k, m in enumerate(want) if m[1] and m[0] not in H.INLINE]
        if blocks and max(map(summed, want)) > 0:
            best = max(blocks, key=lambda k: (summed(want[k]), want[k][1], -k))
            assert best + 1 in page.content()


def test_densities_decide(monkeypatch):
    """Without an article element, the dense part wins against longer lists; with a wrong density it doesn't."""
    menu = "<nav><ul>" + "<li><a href=x>menu entry of some words</a></li>" * 40 + "</ul></nav>"
    for tag in ("div", "article"):
        page = f"<body>{menu}<{tag}><p>One {LONG}</p><p>Two {LONG}</p></{tag}><footer>{LONG}</footer></body>"
        assert [x.split()[0] for x in H.main_text(page).split("\n")] == ["One", "Two"]
        for wrong in (lambda *counts: 1.0, lambda chars, tags, *links: tags / chars):
            with monkeypatch.context() as m:
                m.setattr(H, "composite_density", wrong)
                assert "menu entry" in H.main_text(page)


@pytest.mark.parametrize("tag", ["div", "b", "li", "p", "x-y"])
def test_deep_pages_take_linear_time(tag):
    import time

    start = time.process_time()
    page = f"<{tag}>" * 50_000 + f"<p>{LONG}</p>" + "<i>x</i></i>" * 1000 + f"</{tag}>" * 50_000
    assert "This sentence" in H.main_text(page)
    assert time.process_time() - start < 20
