"""Template deduction and main slots of pages, by brute force and on hand cases."""
import collections
import re
import time

from conftest import SF0001
from loomtext.llm import html_template as H

WORDS = "the river runs past old mills where millers once ground corn for every town along its banks".split()


def plain(page):
    return H.main_text(page, frozenset())


def story(i, n):
    return " ".join(WORDS[(i * 7 + k * (i + 3)) % len(WORDS)] for k in range(n)).capitalize() + "."


def bare_page(i):
    """No article, no main, no telling names: what belongs to the site stands on every page or in links."""
    links = "".join(f"<div><a href=/{k}>{WORDS[(i + k) % 9]} {k}</a></div>" for k in range(8))
    return (f"<html><body><div id=x1><div>The Mill Post</div><div>{links}</div></div><div class=c2><div class=t>{story(i, 5)}</div>"
            f"<div class=k>Read in five minutes</div><p>{story(i + 1, 30)}<p>{story(i + 2, 40)} <a href=/>more</a></div>"
            f"<div class=z><p>Write to us at any time</p><p>{story(i, 3)}</p></div></body></html>")


def bare_text(i):
    return f"{story(i, 5)} {story(i + 1, 30)} {story(i + 2, 40)} more"


def frame(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_pages_without_telling_names(spark):
    rows = [(i, f"https://post.example/{i}", bare_page(i)) for i in range(30)]
    got = {r.page_id: r.text for r in H.extract(frame(spark, rows)).collect()}
    assert got == {i: bare_text(i) for i in range(30)}
    # the template decides: without it the fixed line stays
    assert plain(bare_page(3)) == bare_text(3).replace(story(3, 5), story(3, 5) + " Read in five minutes", 1)


def brute_template(rows, support=H.SUPPORT, least=H.MIN_PAGES):
    """(layout, token) of the valid classes of one host's pages, from the vectors themselves."""
    pages = [H.parse(html) for _, _, html in rows]
    out = set()
    for layout in {0, *map(H.layout_of, pages)}:
        mine = [H.tokens_of(p) for p in pages if layout in (0, H.layout_of(p))]
        vectors = {}
        for i, tokens in enumerate(mine):
            for token, (n, path, parent) in tokens.items():
                vectors.setdefault((token, path, parent), [0] * len(mine))[i] = n
        classes = collections.defaultdict(list)
        for key, v in vectors.items():
            stands = sum(n > 0 for n in v)
            if stands >= least and stands >= support * len(mine):
                classes[tuple(v)].append(key)
        valid = {path for c in classes.values() if len(c) > 1 for _, path, _ in c}
        out |= {(layout, t) for c in classes.values() for t, _, parent in c if len(c) > 1 or parent in valid}
    return {(layout, t) for layout, t in out if layout == 0 or (0, t) not in out}


def test_templates_by_brute_force(spark):
    rows = [(i, "https://post.example/", bare_page(i)) for i in range(12)]
    rows += [(50 + i, "https://post.example/", f"<body><article class=w><h1>{story(i, 4)}</h1><p>House line.</p><p>{story(i, 9)}</p></article></body>")
             for i in range(8)]
    df = frame(spark, rows).selectExpr("page_id", "'post.example' AS host", "html")
    found = H.templates(df).collect()
    assert {(a, t) for r in found for a, t in zip(r.layouts, r.tokens)} == brute_template(rows)


def test_given_pages_do_not_need_the_article_tag(spark):
    df = spark.read.parquet(f"{SF0001}/pages.parquet").select("page_id", "url", "html")
    want = {r.page_id: r.text for r in H.extract(df).collect()}
    rows = [(r.page_id, r.url, re.sub(r"(</?)(article|main)\b", r"\1div", r.html or "")) for r in df.collect()]
    assert {r.page_id: r.text for r in H.extract(frame(spark, rows)).collect()} == want


def test_names_inside_an_article():
    keep = "<article><p data-id='share-5'>One.</p><p data-class=ad>Two.</p><div class='related-work'>Three.</div><p id=alert-1>Four.</p>" \
           "<p class=banner-history>Five.</p>{}</article>"
    drop = "<div class=comments>c</div><p class='x cookie-banner'>c</p><div role=search>s</div><p hidden>h</p><p class=a aria-hidden=true>h</p>"
    assert plain(keep.format(drop)) == "One. Two. Three. Four. Five."
    assert plain("<div id=sidebar>x y z</div><p>Some text here.</p>") == "Some text here."


def test_forms():
    text = story(1, 30)
    assert plain(f"<body><form action=/><div><p>{text}</p><p>{text}</p></div><input value=x></form></body>") == f"{text} {text}"
    assert plain(f"<body><form>Name <input></form><div><p>{text}</p></div></body>") == text


def test_a_small_article_does_not_hide_the_page():
    text = story(1, 200)
    assert plain(f"<body><article>Teaser</article><div><p>{text}</p></div></body>") == text
    assert plain(f"<body><div><p>{story(2, 20)}</p></div><article><p>{text}</p></article></body>") == text


def test_deep_and_unclosed_markup():
    began = time.perf_counter()
    assert plain("<font color=red>y" * 60000) == "y" * 60000
    assert plain("<div>" * 40000 + "x" + "</b>" * 40000) == "x"
    assert plain("<article>" + "<p>x<i>" * 30000) == " ".join("x" * 30000)
    assert plain("<p>" + "<a href=x>l<b>" * 20000 + "</a>" * 5) == "l" * 20000
    assert time.perf_counter() - began < 30


def test_long_pages(spark):
    page = "<body><main><p>" + "long text " * 200000 + "</p></main></body>"
    out = H.extract(frame(spark, [(1, "http://h/", page), (2, None, None), (2, None, None)])).collect()
    assert sorted((r.page_id, r.n_chars) for r in out) == [(1, 1999999), (2, 0), (2, 0)]
