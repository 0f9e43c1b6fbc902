import html
import re

import duckdb

from kassa.llm import html_extract as H
from kassa.llm.queries import QUERIES

SF001 = "/root/testdata/sf0.001"
PAGE = (
    "<html><head><title>Site</title></head><body><header><h1>Site name</h1></header><nav><ul><li><a href=x>Home</a></ul></nav>"
    "{before}<article class='post'><h1>A title</h1><p>One &eacute; two<br>three <b>bold</b>text,\n more of it.{inside}"
    "<p>Words of &lt;b&gt; the last &amp; final part <!-- <p>none</p> --> go on.</article>{after}<footer>&copy; us</footer></body></html>"
)
PARTS = ["A title", "One é two three boldtext, more of it.", "Words of <b> the last & final part go on."]


def weights():
    pages = [PAGE.format(before="", inside="", after="")] * 40
    return H.Weights(*H.learn(pages))


def test_boilerplate_around_and_inside():
    w = weights()
    advert = "<div class='ad-box'><p>Buy one of these now, they are cheap and good.</div>"
    for before, inside, after in (
        ("", "", ""),
        (advert, advert, advert),
        ("<aside>Some side remark of a few words</aside>", "<form><input name=a>Search <button>Go</button></form>", ""),
        ("", "<script>var t = '<p>no</p>';</script><style>p{}</style>", "<div id=comments><p>" + "Nice post! " * 30 + "</p></div>"),
        ("<div role='alert'>We use cookies here, accept them all</div>", "<nav>one two three</nav>", "<div class='cookie-notice'>ok</div>"),
    ):
        assert H.main_text(PAGE.format(before=before, inside=inside, after=after), w) == "\n\n".join(PARTS)
    assert H.main_text(PAGE.format(before="", inside="<ul><li>item one<li>item two</ul>", after=""), w).split("\n\n")[2:4] == [
        "item one",
        "item two",
    ]


def test_odd_pages():
    w = weights()
    assert H.main_text(None, w) == H.main_text("", w) == H.main_text("<p></p><!-- x", w) == ""
    assert H.main_text("<p>a &amp b &#233; &nope;</p><p", w) == "a & b é &nope;"
    assert H.main_text("<p>1 < 2 and <b x='>'>so", w) == "1 < 2 and so"
    assert len(H.main_text("<p>" + "word " * 200_000, w)) == 999_999


def test_all_pages(spark):
    rows = duckdb.sql(f"SELECT page_id, html FROM '{SF001}/pages.parquet'").fetchall()
    got = {r.page_id: r for r in QUERIES["op8_html_extraction"](spark, SF001).collect()}
    assert len(got) == len(rows)
    for page_id, page in rows:
        inside = re.search("<article>(.*)</article>", page, re.S)[1]
        parts = [re.sub("</?b>", "", p).replace("<br>", " ") for p in re.split("</?(?:p|h1)>", inside)]
        want = "\n\n".join(p for p in (" ".join(html.unescape(x).split()) for x in parts) if p)
        assert got[page_id].text == want and got[page_id].n_chars == len(want)


def test_edge_rows(spark):
    rows = [(1, None, None, "a"), (1, "u", "", "b"), (None, "u", "<p>x y", "c")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars string")
    model = H.fit(pages)
    got = sorted((r.page_id or 0, r.text, r.n_chars) for r in H.extract(pages, model).collect())
    assert got == [(0, "x y", 3), (1, "", 0), (1, "", 0)]
    assert H.extract(pages.limit(0), H.fit(pages.limit(0))).collect() == []


def test_custom_elements_are_no_raw_text():
    for name in ("title-bar", "style-guide", "script-list"):
        page = f"<body><{name}>x</{name}><p>One two three.</p><style>no</style></body>"
        text = " ".join(t.text or "" for t in H.tokens(page) if not t.skipped)
        assert "One two three." in text and "no" not in text.split()
    assert not [t for t in H.tokens("<STYLE type='a'>gone</style><title/>gone") if t.text == "gone" and not t.skipped]


def test_unclosed_tags_take_linear_time():
    import time

    for page in (
        "<div>" * 100_000 + "</span>" * 100_000,
        "<span>" * 100_000 + "<p>" + "</b>" * 100_000,
        "<span>" * 50_000 + "<li>a" * 50_000,
    ):
        start = time.time()
        H.tokens(page)
        assert time.time() - start < 8  # quadratic work takes many minutes


def test_best_region_equals_a_quadratic_search():
    import random
    from types import SimpleNamespace

    plain = SimpleNamespace(of=lambda score: score)
    draw = random.Random(3)
    for _ in range(300):
        scores = [draw.choice([-2.0, -1.0, -0.5, 0.0, 0.5, 1.0, 3.0]) for _ in range(draw.randrange(12))]
        a, b = H.best_region(scores, plain)
        sums = [sum(scores[i:j]) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)]
        assert sum(scores[a:b]) == max([0.0, *sums])


def test_sample_keeps_all_kinds_and_its_bounds(spark):
    page = "<body><article>{}</article></body>"
    many = [page.format("".join(f'<b class="k{i}x{j}">w</b>' for j in range(4000))) for i in range(4)]
    rows = [(7, p) for p in many] + [(8, page.format("<u>long</u> " + "w " * 70_000))]
    pages = spark.createDataFrame(rows, "page_id long, html string")
    known = H.fit(pages).known
    assert sum(k.startswith("b.k") for k in known) == 16_000
    assert not any("u" in k.split() for k in known)  # that page is over the bound in bytes
    # one id with many pages is no way around the bound in rows
    assert sum(k.startswith("b.k") for k in H.fit(pages, max_pages=2).known) == 8000
