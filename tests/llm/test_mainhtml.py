"""Main text: markup, and words that a host repeats, against brute force."""

import html
import random
import re
import time

import pyarrow as pa
import pytest

from panelloom.llm import mainhtml


def test_suffix_array_sorts_suffixes():
    import numpy as np

    rnd = random.Random(1)
    for _ in range(60):
        tokens = [rnd.randint(0, 2) for _ in range(rnd.randint(1, 25))]
        order, common = mainhtml.suffix_array(np.array(tokens))
        assert order.tolist() == sorted(range(len(tokens)), key=lambda i: tokens[i:])
        for k in range(1, len(tokens)):
            a, b = tokens[order[k - 1] :], tokens[order[k] :]
            assert common[k] == next((n for n, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def test_repeated_words_match_brute_force():
    rnd = random.Random(2)
    for _ in range(150):
        pages = [[rnd.choice("abc") for _ in range(rnd.randint(0, 15))] for _ in range(rnd.randint(1, 5))]
        names, least = [rnd.randint(1, 4) for _ in pages], rnd.choice([2, 3, 4])
        owners = {}
        for page, name in zip(pages, names):
            for i in range(len(page) - least + 1):
                owners.setdefault(tuple(page[i : i + least]), set()).add(name)
        for page, hit in zip(pages, mainhtml.repeated_words(pages, names, least)):
            want = [False] * len(page)
            for i in range(len(page) - least + 1):
                if len(owners[tuple(page[i : i + least])]) > 1:
                    want[i : i + least] = [True] * least
            assert hit.tolist() == want


def test_markup():
    page = (
        '<body><header>Top</header><div class="cookie-notice">We use</div><nav>a<ul><li>b</ul></nav><main><article><header><h1>T &amp; x</h1></header>'
        '<p>One<br>two <b>th</b>ree<p>Four &lt;b&gt; &#233; &copy 5 <aside>side</aside>six<div class="ad">ad</div><form>f<input></form>'
        '<script>var t="</p>";</script><!-- c > d --></article><section id="comments">c</section></main><aside>s</aside><footer>f</footer></body>'
    )
    assert mainhtml.main_text(page, set()) == "T & x One two three Four <b> é © 5 six"
    assert mainhtml.main_text("a <!-- open", set()) == "a" and mainhtml.main_text("1 < 2 and <b>x", set()) == "1 < 2 and x"
    assert mainhtml.main_text("<p hidden>no</p><div style='display: none'>no</div>yes &nbsp; ok", set()) == "yes ok"


@pytest.mark.parametrize("wrapper", ["class='content with-sidebar'", "id='page' class='has-menu'", "class='post no-comments'", "class='sidebar-left'"])
def test_names_of_wrappers_do_not_empty_the_page(wrapper):
    for tag in ("article", "main"):
        page = f"<body><div class='site-footer'>f</div><div {wrapper}><{tag}><p>One two</p></{tag}><div class='sidebar'>s</div></div><div id='comments'>c</div></body>"
        assert mainhtml.main_text(page, set()).startswith("One two") and " c" not in mainhtml.main_text(page, set())
    assert mainhtml.main_text("<main><article>a b</article><div class='comments'><article>c</article></div></main><div class='related'><article>r</article></div>", set()) == "a b"
    assert mainhtml.main_text("<div class='content with-sidebar'>plain</div><div class='sidebar'>s</div>", set()) == "plain"


def test_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")

    def plain(page):
        inner = re.search(r"<article>(.*)</article>", page, re.S)[1]
        parts = (" ".join(html.unescape(re.sub("<[^>]*>", "", p.replace("<br>", " "))).split()) for p in re.split(r"</?(?:h1|p)>", inner))
        return " ".join(p for p in parts if p)

    want = {r.page_id: plain(r.html) for r in pages.collect()}
    out = mainhtml.page_texts(pages).collect()
    assert {r.page_id: r.text for r in out} == want and all(r.n_chars == len(r.text) for r in out)


@pytest.mark.parametrize("most", [2000, 5])
def test_hosts_repeat_boilerplate(spark, monkeypatch, most):
    monkeypatch.setattr(mainhtml, "HOST_PAGES", most)

    def page(k, body, host="a.com"):
        return (k, f"http://{host}/{k}", body)

    rows = [page(k, f"<div>Welcome to the best site ever</div><p>only{k} page{k} text{k}</p><p>All rights are reserved by us</p>") for k in range(12)]
    rows += [page(100, None), page(101, ""), (None, None, "<p>x"), page(102, "<div>Welcome to the best site ever</div>", "b.com"), rows[3], (104, "http://c.com/", "<article>Welcome to the best site ever</article>"), (105, "http://c.com/2", "<article>Welcome to the best site ever</article>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS mark", "2 AS positions")
    out = mainhtml.extract(df)
    assert out.columns == [*df.columns, "main_text"] and out.count() == len(rows)
    text = {r.page_id: r.main_text for r in out.collect()}
    assert text[3] == "only3 page3 text3" and text[100] == text[101] == "" and text[None] == "x"
    assert text[102] == text[104] == text[105] == "Welcome to the best site ever"
    assert mainhtml.page_texts(df.limit(0)).collect() == []


@pytest.mark.parametrize("most", [2000, 50])
def test_unmarked_prose_keeps_its_phrases(spark, monkeypatch, most):
    monkeypatch.setattr(mainhtml, "HOST_PAGES", most)
    rnd = random.Random(4)
    passage = " ".join(f"licence{k}" for k in range(40))
    rows, want = [], {}
    for k in range(300):
        prose = [" ".join(f"{rnd.choice('abcdefgh')}{k}x{i} at the end of the day" for i in range(6)) for _ in range(3)]
        menu = "".join(f"<div>{w}</div>" for w in ("Home", "News", "About us", "Contact"))
        rows.append((k, f"http://a.com/{k}", f"{menu}<p>{prose[0]}</p><div>{prose[1]}</div><p>{prose[2]} own{k} {passage} end{k}</p><p>All rights are reserved by us</p>"))
        want[k] = f"{' '.join(prose)} own{k} end{k}"
    # On two pages of 300: no boilerplate of the host.
    for k in (300, 301):
        rows.append((k, f"http://a.com/{k}", "<p>One block of words that two of the pages have</p>"))
        want[k] = "One block of words that two of the pages have"
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in mainhtml.page_texts(df).collect()} == want


@pytest.mark.parametrize(("most", "words", "broadcast"), [(2000, 1 << 20, 20_000), (5, 1 << 20, 0), (2000, 100, 20_000)])
def test_boilerplate_within_articles(spark, monkeypatch, most, words, broadcast):
    monkeypatch.setattr(mainhtml, "HOST_PAGES", most)
    monkeypatch.setattr(mainhtml, "HOST_WORDS", words)
    monkeypatch.setattr(mainhtml, "BROADCAST_HOSTS", broadcast)
    letter = " ".join(f"newsletter{k}" for k in range(26))
    quote = " ".join(f"quoted{k}" for k in range(30))
    own = {k: " ".join(f"own{k}x{i}" for i in range(40)) for k in range(60)}
    rows, want = [], {}

    def page(k, body, text, host="a.com"):
        rows.append((k, f"http://{host}/{k}", f"<nav>Home</nav><article>{body}</article>"))
        want[k] = text

    for k in range(40):
        page(k, f"<h1>Title {k}</h1><p>{own[k]}</p><p>{letter}</p><p>end{k}</p>", f"Title {k} {own[k]} end{k}")
    # Four articles of many quote the same passage; one article stands on ten pages, and one is the letter.
    for k in range(40, 44):
        page(k, f"<p>{own[k]}</p><p>{quote}</p>", f"{own[k]} {quote}")
    for k in range(44, 54):
        page(k, f"<p>{own[44]}</p>", own[44])
    page(54, f"<p>{letter}</p>", letter)
    # Too few articles to know what their host repeats.
    for k in range(55, 59):
        page(k, f"<p>{own[k]}</p><p>{letter}</p>", f"{own[k]} {letter}", "b.com")
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in mainhtml.page_texts(df).collect()} == want


def test_every_run_has_its_seed():
    rnd = random.Random(3)
    texts = [" ".join(rnd.choice("ab") for _ in range(n)) for n in (0, 5, 23, 24, 25, 90)]
    seeds, row, place = mainhtml.run_seeds(pa.array([*texts, None]))
    assert list(zip(row, place)) == [(k, i) for k, t in enumerate(texts) for i in range(len(t.split()) - 23)]
    of = {}
    for s, r, i in zip(seeds, row, place):
        assert of.setdefault(tuple(texts[r].split()[i : i + 24]), s) == s


HOSTILE = {
    "open tags": "<a " * 300_000,
    "open quotes": "<a b=\"" * 200_000,
    "open tags before an end": "<a b='x" * 150_000 + "\">",
    "declarations": "<!" * 300_000,
    "deep blocks": "<div class=ad>" * 100_000 + "</p>" * 100_000,
    "deep inline": "<b><div>" + "<i>" * 100_000 + "</b>" * 100_000 + "<div></div>" * 50_000,
    "articles in named elements": "<div class=menu><article>" * 50_000,
}


@pytest.mark.parametrize("name", HOSTILE)
def test_hostile_markup_is_read_in_linear_time(name):
    begin = time.perf_counter()
    mainhtml.page_blocks(f"<article><p>kept</p></article>{HOSTILE[name]}")
    assert time.perf_counter() - begin < 10


@pytest.mark.parametrize(
    "page, text",
    [
        ("<p>it's</p><p title='a > b' class=\"x\">so</p>", "it's so"),
        ("<p>a <x y's here</p><p>next</p>", "a next"),
        ("<p>one <!-- two > --> three</p><!doctype x><?php y ?>four<!-- five", "one three four"),
        ("<p>3 < 4 <b", "3 < 4 <b"),
        ("<p alt=\"open>first</p><p>second</p>", "first second"),
        ("<ul><li>a<li>b</ul><p>c<p>d</i></div>e", "a b c d e"),
    ],
)
def test_tags_quotes_and_comments(page, text):
    assert mainhtml.main_text(page, set()) == text
