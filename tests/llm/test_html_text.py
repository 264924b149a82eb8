"""Main text against the marked articles and hand-written pages."""

import html
import random
import re
import time

from pyspark.sql import functions as F

from tidemark.llm import queries as Q
from tidemark.llm.html_text import FIXED, Page, main_text, tokens, train

SF = "/root/testdata/sf0.01"


def plain(page):
    """The article of a generated page: its blocks between block tags."""
    body = re.search(r"<article>(.*)</article>", page, re.S)[1]
    blocks = re.split(r"</?(?:p|h1|br|article)[^>]*>", body)
    done = (re.sub(r"\s+", " ", html.unescape(re.sub(r"</?b>", "", b))).strip() for b in blocks)
    return "\n".join(b for b in done if b)


def test_generated_pages(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = Q.REGISTRY["op8_html_text"](spark, SF).collect()
    assert len(got) == len(pages)
    wrong = [r.page_id for r in got if r.text != plain(pages[r.page_id].html)]
    assert not wrong, wrong[:5]
    assert all(r.n_chars == len(r.text) and r.url == pages[r.page_id].url for r in got)


WORDS = "several plain words that make one longer paragraph of the story about rivers and their many bridges"
PAGE = f"""<!doctype html><html><head><title>Site - a title of some words</title><style>p{{x}}</style></head>
<body class="home"><header><h2>Big Site</h2><a href="/">Home</a></header><nav><ul><li><a href="/a">One</a><li><a href="/b">Two</a></ul></nav>
<div class="cookie notice">We use cookies to make this site better for all of you, please accept them now.</div>
<div id="content"><h1>Rivers &amp; bridges</h1><p>{WORDS} 1 &lt; 2.<p>Second <b>bold</b>
  {WORDS}<script>var a = "<p>no</p>";</script></p><div class="ad">Buy this thing today for little money and be glad of it</div>
<form><label>Name</label><input name=q></form><ul><li>item one of a list in the text of the story</li><li>item two of a list in the text of the story</li></ul>
<p>{WORDS}<br>last line</p><p>End</p></div><aside><p>Elsewhere on this site you can read of other things</p></aside>
<div class="comments"><p>First! A reader wrote a rather long comment about the story here</p></div><footer>&copy; 2020 Big Site, all rights reserved</footer></body></html>"""


def test_hand_written_page():
    want = ["Rivers & bridges", f"{WORDS} 1 < 2.", f"Second bold {WORDS}", "item one of a list in the text of the story",
            "item two of a list in the text of the story", WORDS, "last line", "End"]
    assert Page(PAGE).main_text(FIXED).split("\n") == want
    marked = PAGE.replace('<div id="content">', "<article>").replace("<p>End</p></div>", "<p>End</p></article>")
    assert Page(marked).main_text(FIXED).split("\n") == want


def best_region(score):
    """The greatest sum of a contiguous run, by trying all."""
    best = 0.0
    for i in range(len(score)):
        total = 0.0
        for s in score[i:]:
            total += s
            best = max(best, total)
    return best


def test_region_is_the_best_of_all():
    rng = random.Random(4)
    for _ in range(150):
        parts = [rng.choice(["<p>", "</p>", "<div class=ad>", "</div>", "<nav>", "</nav>", "<li>", "one two", "a b c d e f", "x", "<article>", "</article>"])
                 for _ in range(rng.randint(0, 40))]
        page = Page("".join(parts))
        score, lo, hi = page.region(FIXED)
        assert abs((sum(score[lo:hi + 1]) if hi >= lo else 0.0) - best_region(score)) < 1e-9
        assert all(s < 0 for s, f, w, out in zip(score, page.feature, page.words, page.out) if out and (f is not None or w))


def test_short_articles_beside_long_notices(spark):
    """An article of a few words is found beside a longer footer."""
    long_notice = "Copyright of this site and all that it holds, all rights are reserved by its owner " * 3
    page = f"<html><body><nav><a>One</a><a>Two</a></nav><article><h1>Sea.</h1><p>Sea.</p></article><footer><p>{long_notice}</p></footer></body></html>"
    weights = train(spark.createDataFrame([(i, page.replace("Sea.", "Some longer words of a story here")) for i in range(30)], "page_id long, html string"))
    assert Page(page).main_text(weights) == "Sea.\nSea."


def test_sf01_articles(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    got = pages.select("html", main_text(F.col("html"), train(pages)).alias("t")).collect()
    wrong = [r.t for r in got if r.t != plain(r.html)]
    assert not wrong, wrong[:5]


def test_empty_table(spark):
    none = spark.createDataFrame([], "page_id long, html string")
    assert none.select(main_text(F.col("html"), train(none)).alias("t")).collect() == []


def test_awkward_pages(spark):
    rows = [(1, None), (2, ""), (3, "<p></p>"), (4, "just text & more &eacute;"), (5, "a < b <p>x y z"), (6, "<p>open <b>never closed"),
            (7, "<div><p>" + "long text of words " * 40_000), (8, "<" * 30_000), (9, '<a href="x' * 20_000), (10, "<!-- never closed <p>x</p>"), (5, "a < b <p>x y z"),
            (11, "<p>a&#x26;b&nbsp;&nbsp;c</p>" * 3)]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "page_id long, html string, text string")
    start = time.time()
    got = {r.page_id: r.t for r in df.select("page_id", main_text(F.col("html"), FIXED).alias("t")).collect()}
    assert time.time() - start < 60
    assert got[1] == got[2] == got[3] == got[10] == ""
    assert got[4] == "just text & more é" and got[5] == "a < b\nx y z" and got[6] == "open never closed"
    assert len(got[7]) == len("long text of words " * 40_000) - 1
    assert got[11] == "\n".join(["a&b c"] * 3)
    assert train(df.limit(0)) == FIXED
    assert [k for k, *_ in tokens('<a title="x > y">t</a>')] == ["open", "text", "close"]


def test_letter_that_grows_in_lower_case_before_a_raw_element():
    """U+0130 is two characters in lower case; tags are sought in the page itself."""
    for raw in ("script", "SCRIPT", "style", "textarea"):
        page = (f"<html><head><title>{chr(0x130) * 9}stanbul</title></head><body><{raw}>var a = 'no';</{raw}>"
                f"<article><p>{WORDS} one</p><{raw}>b</{raw}><p>{WORDS} two</p></article></body></html>")
        assert Page(page).main_text(FIXED) == f"{WORDS} one\n{WORDS} two", raw


def test_formulas_objects_and_fieldsets_inside_an_article():
    """Ordinary elements; a fieldset of a form goes with the form."""
    page = (f"<body><article><p>{WORDS} <math><mi>a</mi><mo>+</mo><mi>b</mi></math> end</p><p>{WORDS} <object data=x>shown instead</object></p>"
            f"<fieldset><p>{WORDS}</p></fieldset><form><fieldset>Your name</fieldset></form></article></body>")
    assert Page(page).main_text(FIXED).split("\n") == [f"{WORDS} a+b end", f"{WORDS} shown instead", WORDS]
