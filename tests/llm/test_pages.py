import random
import re
from html import unescape

from pyspark.sql import functions as F

from runway.llm import pages, queries
from runway.llm.lcs import common_places

SITE = """<!DOCTYPE html><html><head><title>T</title><style>p{{x:1}}</style><script>var a="</p><article>";</script></head><body>
<header><h1>Site name</h1></header><nav><ul><li><a href="/a">Menu {i}</a></li></ul></nav><!-- <p>commented</p> --><div class="ad big">Buy {i}!</div>
<div id="cookie-notice"><div>We use</div> cookies</div><aside>Side {i}</aside>
<article><header><h2>Title&nbsp;{i}</h2></header><p>First <b>bold</b>&amp;  plain<br>line &lt;3 &#8364;<p class="notice">Mind the step<p>Second
para {i}<script>x()</script><form><input name=q>Search <button>Go</button></form><ul><li>one<li>two</ul><div hidden>secret</div>
<section class="comments"><p>Great post!</p></section></article><div role="contentinfo">c</div><footer>&copy; {i}</footer></body></html>"""


def test_marked_boilerplate_is_left_out():
    assert pages.main_text(SITE.format(i=7)) == "Title 7\n\nFirst bold& plain line <3 €\n\nSecond para 7\n\none\n\ntwo"


def test_odd_markup():
    assert pages.main_text(None) == pages.main_text("") == pages.main_text(" <p> </p> ") == ""
    assert pages.main_text("plain 1 < 2 text &amp; more") == "plain 1 < 2 text & more"
    assert pages.main_text("<article><p>cut &am") == "cut &am"
    assert pages.main_text("<article><p>cut<p clas") == "cut"
    assert pages.main_text("<article><p>a<script>never closed <p>b") == "a"
    assert pages.main_text("<p title='a > b'>x</p>") == "x"
    assert pages.main_text("<article>" + "<p>x" * 20_000) == "\n\n".join(["x"] * 20_000)
    assert pages.main_text('<p title="never closed>' + "a" * 50_000) is not None


def brute_lcs(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


def test_common_places_are_a_longest_common_subsequence():
    rng = random.Random(3)
    for n in range(200):
        a, b = ([rng.randrange(n % 9 + 1) for _ in range(rng.randrange(30))] for _ in range(2))
        used = common_places(a, b)
        assert len(used) == brute_lcs(a, b) and all(a[i] == b[j] for i, j in used)
        assert all(x < y for u, v in zip(used, used[1:]) for x, y in zip(u, v))


def test_unmarked_lines_shared_with_the_nearest_page_go(spark):
    page = "<body><div>Our Site</div><div>Home | News</div><p>Story {i} begins.</p><p>Story {i} ends.</p><div>All rights reserved</div></body>"
    rows = [(i, f"http://{h}.example/{s}/{i}", page.format(i=i) + f"<div>{s} section</div>") for i in range(40) for h in ("a", "b")[:1 + i % 2] for s in ("x", "y")[i % 2:]]
    rows += [(900, "http://a.example/x/3?page=2", page.format(i=900)), (901, None, page.format(i=901)), (902, "http://[bad", page.format(i=902)),
             (903, "http://only.example/", page.format(i=903)), (None, "http://only.example/2", None), (905, "http://a.example/x/1", ""),
             (906, "http://c.example/1", page.format(i=1)), (907, "http://c.example/2", page.format(i=1))]
    rows += [rows[0], rows[0]]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash")).withColumn("key", F.lit(1)).repartition(3)
    got = pages.extract(df).collect()
    assert len(got) == len(rows)
    text = {(r["page_id"], r["url"]): r["text"] for r in got}
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    kept = 0
    for i, url, _ in rows[:60]:
        if text[i, url] == f"Story {i} begins.\n\nStory {i} ends.":
            kept += 1
        assert text[i, url].startswith(f"Story {i} begins.\n\nStory {i} ends.")
    assert kept >= 50
    assert text[901, None].startswith("Our Site") and text[None, "http://only.example/2"] == ""
    assert text[906, "http://c.example/1"].startswith("Our Site")  # a copy: nothing is known about the site
    assert pages.extract(df.limit(0)).count() == 0


def test_articles_of_the_given_pages_stay_whole(spark):
    sf = "/root/testdata/sf0.01"
    html = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    for r in queries.op8_pages(spark, sf).collect():
        article = re.search(r"<article>(.*?)(?:</article>|\Z)", html[r["page_id"]], re.S)[1]
        blocks = [" ".join(unescape(re.sub(r"<[^>]*(>|$)", " " if "br" in b else "", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert r["text"] == "\n\n".join(b for b in blocks if b)


def test_copies_and_near_copies_lose_the_lines_of_the_site_only(spark):
    page = "<body><div>Our Site</div><div>Home | News</div><p>Story {i} begins and goes on for a while, as stories do.{i}</p><p>Story {i} ends after {i} more lines of text.</p>" \
           "<div>Seen {n} times</div><div>All rights reserved</div></body>"
    rows = [(i, f"http://a.example/x/{i}", page.format(i=i, n=i)) for i in range(10, 16)]
    rows += [(100 + n, f"http://a.example/x/12?utm={n}", page.format(i=12, n=n)) for n in range(6)]  # near copies
    rows += [(200 + n, f"http://a.example/y/{n}", page.format(i=50, n=1)) for n in range(4)]  # exact copies
    rows += [(300 + n, f"http://only.example/{n}", page.format(i=60, n=n)) for n in range(3)]  # nothing else on the host
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    text = {r["page_id"]: r["text"] for r in pages.extract(df).collect()}
    for page_id, _, _ in rows:
        i = 12 if 100 <= page_id < 200 else 50 if 200 <= page_id < 300 else 60 if page_id >= 300 else page_id
        assert f"Story {i} begins" in text[page_id] and f"Story {i} ends" in text[page_id], page_id
        assert ("Home | News" in text[page_id]) == (page_id >= 300), page_id
