import random

import pytest

from eventloom.llm import html

SCHEMA = "page_id long, url string, html string, host string, paths string, text string"


def text_of(source):
    page = html.parse(source)
    return html.extract(page, html.best_path(page))


LONG = "Some running text that is long enough to be the article of a page."

CASES = [
    ("<article><h1>T &amp; t</h1><p>a  b\n c</p><p>&eacute;&#x41;&lt;p&gt;</p></article>", "T & t\n\na b c\n\néA<p>"),
    ("<article><p><b>bold<br><p>next</article>", "bold\n\nnext"),
    (f"<body><nav><a href=/>Home</a></nav><div class=content><p>{LONG}</p><ul><li>one<li>two</ul></div><footer>f</footer></body>", f"{LONG}\n\none\n\ntwo"),
    (f"<main><p>{LONG}</p><aside>side</aside><div class='ad-box'>buy</div><form><p>mail</p></form><script>var a = '<p>x</p>'</script><p>end</p></main>", f"{LONG}\n\nend"),
    (f"<main><div class=cookie-notice>We use</div><p>{LONG}</p><section id=comments><p>A reader's very long comment about it</p></section></main>", LONG),
    (f"<article><header><h1>Title</h1><p>By someone</p></header><p>{LONG}</p></article>", f"Title\n\n{LONG}"),
    (f"<div role=navigation>menu</div><article><p>{LONG}</p><p hidden>no</p><p style='display: none'>no</p></article>", LONG),
    (f"<article><p>{LONG}</p><!-- <p>comment --><table><tr><td>a<td>b</table><pre>x\n  y</pre>", f"{LONG}\n\na\n\nb\n\nx y"),
    (f"<article><p>{LONG} <a href='x>y'>link</a> tail", f"{LONG} link tail"),
    (f"<article><p>{LONG}</p><p>1 < 2 and a<b</p></article>", None),
    (f"<body><header><h1>Site</h1></header><div class='content has-sidebar'><p>Intro.</p><section><h2>A</h2><p>{LONG}</p></section><section><p>{LONG}</p></section></div></body>", f"Intro.\n\nA\n\n{LONG}\n\n{LONG}"),
    (f"<body><div><div><p>{LONG}</p><blockquote>{LONG} {LONG}</blockquote></div></div><div class=sidebar><p>{LONG}</p></div><div id=page-footer>x</div></body>", f"{LONG}\n\n{LONG} {LONG}"),
    (f"<body><div class=teaser><p>{LONG}</p></div><div class=post-body><p>{LONG}</p><p>{LONG}</p></div></body>", f"{LONG}\n\n{LONG}"),
    ("", ""), ("<html><body></body></html>", ""), ("plain words", ""), ("<body>plain words</body>", "plain words"), ("<p", ""), ("<style>p{", ""),
]


@pytest.mark.parametrize("source, want", CASES)
def test_extraction(source, want):
    got = text_of(source)
    if want is not None:
        assert got == want


def test_long_pages_take_linear_time():
    import time
    for source in ("<p>" * 100_000, "<div>" * 100_000 + "x y", "<div>" * 50_000 + "</span>x" * 50_000, "<table>" + "<b>" * 50_000 + "<tr>" * 50_000,
                   "<form>" * 50_000 + "x", "<div class=share-this>" * 50_000 + "x", "<" * 200_000, "<a href='" * 20_000, "<script>" + "<" * 200_000, f"<article>{'<p>word ' * 100_000}"):
        began = time.time()
        text_of(source)
        assert time.time() - began < 20, source[:20]


def page(k, body, url="http://example.com/x"):
    return (k, url, body, "clash", "clash", "clash")


def test_hosts_agree_on_a_path(spark):
    """A page whose noise outweighs its article is extracted by what the host's other pages agree on."""
    article = lambda k: f"<html><body><div class='post-{k}'><p>{LONG} {k}</p><p>{LONG}</p></div><div class=extra><p>short</p></div></body></html>"
    odd = f"<html><body><div class='post-99'><p>tiny</p></div><div class=extra><p>{LONG * 5}</p></div></body></html>"
    pages = [page(k, article(k)) for k in range(20)] + [page(99, odd), page(100, odd, "https://user@OTHER.example.org:8080/y")]
    pages += [page(200, None, None), page(201, "", "no url"), page(None, article(7)), page(3, article(3))]
    got = html.extract_pages(spark.createDataFrame(pages, SCHEMA)).collect()
    assert len(got) == len(pages)
    by = {(r.page_id, r.url): r for r in got}
    assert by[99, "http://example.com/x"].text == "tiny"
    assert by[99, "http://example.com/x"].path == "html>body>div.post-#"
    assert by[100, "https://user@OTHER.example.org:8080/y"].text == LONG * 5
    assert by[5, "http://example.com/x"].text == f"{LONG} 5\n\n{LONG}"
    assert by[200, None].text == "" and by[201, "no url"].text == ""
    digest = html.page_digest(spark.createDataFrame(pages, SCHEMA)).collect()
    assert all(r.n_chars == len(r.text) for r in digest)
    winners = {r.host: r.paths for r in html.winning_paths(spark.createDataFrame(pages, SCHEMA)).collect()}
    assert winners["example.com"][0] == "html>body>div.post-#" and "other.example.org" in winners


@pytest.mark.parametrize("inner, want", [
    ("<h2 id=related-methods>Related methods</h2><p>They differ.</p>", "Related methods\n\nThey differ."),
    ("<section id=share-of-voters><h2>Share</h2><p>It rose to 12 per cent.</p></section>", "Share\n\nIt rose to 12 per cent."),
    ("<section id=form-of-the-argument><p>It has two steps.</p></section>", "It has two steps."),
    ("<section id=sharing><h2 id=comments>Comments</h2><p>They share it.</p></section>", "Comments\n\nThey share it."),
    ("<h2 id=comments-on-the-law>Comments on the law</h2><p class=article-social-history>Long ago.</p>", "Comments on the law\n\nLong ago."),
    ("<section id=header-files-of-c><p>They declare names.</p></section>", "They declare names."),
    ("<p>A <span class=share>share</span> of it.</p>", "A share of it."),
    ("<div class=share-this-now><p>Share <a href=/f>on one site</a> <a href=/t>on another one</a></p></div>", ""),
    ("<div class='post-related-articles'><p>You may also read this one.</p></div>", ""),
    ("<div id=sidebarLeft><p>About the site.</p></div><div class=site-header><p>All the news.</p></div>", ""),
])
def test_skip_words_are_whole_names_of_layout(inner, want):
    assert text_of(f"<article><p>{LONG}</p>{inner}<p>End of it.</p></article>") == "\n\n".join(x for x in (LONG, want, "End of it.") if x)


PARTS = [" ".join(f"Part {c} has sentence {k}." for k in range(n)) for c, n in (("a", 45), ("b", 35), ("c", 20))]


@pytest.mark.parametrize("source, want", [
    (f"<article><h1>Title</h1><p>lead</p><div class=x><p>{LONG * 20}</p></div></article>", f"Title\n\nlead\n\n{LONG * 20}"),
    (f"<article><p>A lead.</p><div><p>Next.</p><div class=content><p>{LONG * 50}</p></div></div></article>", f"A lead.\n\nNext.\n\n{LONG * 50}"),
    ("<body>" + "".join(f"<section class={n}><p>{t}</p></section>" for n, t in zip(("text-a", "b", "c"), PARTS)), "\n\n".join(PARTS)),
    ("<body>" + "".join(f"<div class=teaser><p>{t}</p></div>" for t in PARTS), "\n\n".join(PARTS)),
    (f"<body><p><a href=/>All news of today</a></p><div class=story><h2><a href=/x>T</a></h2><p>{LONG}</p></div>", f"T\n\n{LONG}"),
])
def test_no_text_is_lost_on_the_way_inwards(source, want):
    assert text_of(source) == want


FIELD = "<input type=hidden name=state value=x><input name=q><input type=submit>"


@pytest.mark.parametrize("source, want", [
    (f"<body><form action=/page>{FIELD}<div class=nav>menu</div><div class=story><h1>T</h1><p>{LONG}</p><p>{LONG}</p></div></form></body>", f"T\n\n{LONG}\n\n{LONG}"),
    (f"<body><article><p>{LONG}</p></article><form>{FIELD}<p>{LONG}{LONG}{LONG}</p><textarea></textarea><input><input></form></body>", LONG),
    (f"<body><form>{FIELD}<p>Your name</p></form></body>", ""),
    (f"<body><p>Abstract</p><div class=body><p>{LONG}</p></div></body>", f"Abstract\n\n{LONG}"),
    (f"<body><div class=label><p>Sponsored</p></div><div class=body><p>{LONG}</p></div></body>", LONG),
    (f"<article><p>{LONG} <math><mi>x</mi><mo>+</mo><mn>1</mn><annotation encoding='application/x-tex'>x+1</annotation></math> holds.</p></article>", f"{LONG} x+1 holds."),
    (f"<article><p>{LONG}</p><div hidden=until-found><p>Found late.</p></div><div hidden><p>Never.</p></div></article>", f"{LONG}\n\nFound late."),
    (f"<article class='a b c d'><p>{LONG}</p></article><article class='a b c e'><p>Other.</p></article>", f"{LONG}\n\nOther."),
])
def test_layout_forms_words_and_formulas(source, want):
    assert text_of(source) == want


def test_paths_hold_all_classes():
    page = html.parse(f"<div class='d c b a'><p>{LONG}</p></div><div class='a b c e.f x>y'><p>o</p></div>")
    assert page.path(1) == "html>body>div.a.b.c.d" and page.path(2) == "html>body>div.a.b.c.e_f.x_y"
    assert [page.number(page.path(c)) for c in range(3)] == page.paths and page.number("html>body>div") is None
    assert html.extract(page, page.path(1)) == LONG


def test_built_pages_give_their_blocks():
    """Pages built from known article blocks and boilerplate around, between and after them."""
    rnd = random.Random(11)
    words = lambda n: " ".join(rnd.choice(["stone", "river", "of", "the", "a&b", "é", "12"]) for _ in range(n)) + "."
    escape = lambda t: t.replace("&", "&amp;")
    noise = [
        lambda: f"<nav><ul><li><a href=/>{words(2)}</a></ul></nav>", lambda: f"<div class='ad-box'>{words(9)}</div>", lambda: f"<aside><p>{words(30)}</p></aside>",
        lambda: f"<div id=cookie-consent>{words(12)}</div>", lambda: f"<form><label>{words(4)}</label>{FIELD}</form>", lambda: "<script>var a='<p>x</p>';</script>",
        lambda: f"<!-- {words(5)} -->", lambda: f"<section id=comments><p>{words(40)}</p></section>", lambda: f"<style>p{{}}</style><p hidden>{words(3)}</p>",
    ]
    for k in range(300):
        blocks, body = [words(6)], ""
        body += f"<h1>{escape(blocks[0])}</h1>"
        for _ in range(rnd.randint(2, 12)):
            if rnd.random() < 0.3:
                body += rnd.choice(noise)()
            kind = rnd.choice(["p", "h2", "blockquote", "pre", "list", "deep", "table"])
            new = [words(rnd.randint(5, 40)) for _ in range(3 if kind in ("list", "table") else 1)]
            blocks += new
            inner = [escape(t).replace(" ", rnd.choice([" ", "\n", " \t "])) for t in new]
            body += {
                "list": "<ul>" + "".join(f"<li>{t}" + rnd.choice(["", "</li>"]) for t in inner) + "</ul>", "deep": f"<div><section class=x{k}><p>{inner[0]}</p></section></div>",
                "table": "<table><tr>" + "".join(f"<td>{t}" for t in inner) + "</table>"}.get(kind, f"<{kind}>{inner[0]}</{kind}>")
        wrap = rnd.choice(["<article>{}</article>", "<main>{}</main>", "<div class='post p-9'>{}</div>", "<div><div class=content>{}</div></div>"]).format(body)
        if rnd.random() < 0.2:
            wrap = f"<form>{FIELD}{wrap}</form>" if sum(map(len, blocks)) > 400 else wrap
        around = ["".join(rnd.choice(noise)() for _ in range(rnd.randint(0, 3))) for _ in range(2)]
        source = f"<!DOCTYPE html><html><head><title>{words(3)}</title></head><body>{around[0]}{wrap}{around[1]}<footer>{words(20)}</footer></body></html>"
        assert text_of(source) == "\n\n".join(blocks), source


@pytest.mark.parametrize("source, want", [
    (f"<!DOCTYPE html><title>t</title><h1>A</h1><p>{LONG}</p>", f"A\n\n{LONG}"),
    (f"<title>t</title><h1>A</h1><p>{LONG}</p><ul><li>one<li>two</ul><p>end</p>", f"A\n\n{LONG}\n\none\n\ntwo\n\nend"),
    (f"<html><head><meta charset=utf-8><title>t</title><h1>A</h1><p>{LONG}", f"A\n\n{LONG}"),
    (f"<head><title>t</title>{LONG}", LONG),
    (f"<html><head><title>t</title><body class=x><p>{LONG}", LONG),
    ("<html><body><ul><li><a href=/a>A long title</a><li><a href=/b>Another one</a></ul></body></html>", "A long title\n\nAnother one"),
])
def test_text_outside_containers(source, want):
    assert text_of(source) == want


def test_plain_pages_and_lists_of_links(spark):
    links = "<html><body><p><a href=/a>A title</a></p></body></html>"
    pages = [page(1, f"{LONG} 1 < 2"), page(2, links), page(3, f"<p>{LONG}"), page(4, "", "http://other.example.com/")]
    got = {r.page_id: (r.text, r.path) for r in html.extract_pages(spark.createDataFrame(pages, SCHEMA)).collect()}
    assert got == {1: (f"{LONG} 1 < 2", "html>body"), 2: ("A title", "html>body"), 3: (LONG, "html>body"), 4: ("", None)}


def test_empty_table(spark):
    assert html.page_digest(spark.createDataFrame([], SCHEMA)).count() == 0
