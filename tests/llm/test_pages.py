from pyspark.sql import functions as F

from tallyline.llm import pages

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p> words words";</script></head><body>
<header><p>Site name and motto</p></header><nav><ul><li><a href="/">Home page</a></li><li><a href="/x">Other page</a></li></ul></nav>
<div class="ad">Buy now and save much</div><article><h1>A &amp; B</h1><p><b>First  words of the
text<br><p>Second para&shy;graph with <a href="y">a link</a> in it.</p><aside>Side remark here</aside><form><input>Your mail</form>
<p>Last words.</p></article><div id="comments"><p>I like this article very much indeed</p></div>
<div class="cookie-notice">We use cookies</div><footer>&copy; All rights</footer></body></html>"""
WANT = "A & B\nFirst words of the text\nSecond para­graph with a link in it.\nLast words."


def test_article_without_the_rest(spark):
    frame = spark.createDataFrame([(1, "u", PAGE), (2, "v", PAGE.split("</article>")[0])], "page_id LONG, url STRING, html STRING")
    got = {r.page_id: r for r in pages.extract_main(frame.withColumn("text", F.lit("clash"))).collect()}
    assert got[1].text == got[2].text == WANT
    assert got[1].n_chars == len(WANT) and got[1].url == "u"


def test_classes_of_bodies_and_wrappers(spark):
    plain = PAGE.replace("<article>", "<div>").replace("</article>", "</div>").replace("<aside>Side remark here</aside><form><input>Your mail</form>", "")
    bodies = ["page has-sidebar", "no-sidebar", "header-fixed", "nav menu", "comments"]
    wraps = [*bodies, "entry-content has-share", "navy", "sidebar", "ad"]
    made = [p.replace("<body>", f'<body class="{c}">') for c in bodies for p in (PAGE, plain)]
    made += [p.replace("<body>", f'<body><div class="{c}" data-id="share">').replace("</body>", "</div></body>") for c in wraps for p in (PAGE, plain)]
    made += [PAGE.replace("<article>", f'<article class="{c}"><div id="{c}">').replace("</article>", "</div></article>") for c in ("has-share", "menu-open")]
    made += [f'<div class="sidebar"><p>{WANT}</p></div>'.replace("\n", "<p>").replace("&", "&amp;")]
    kinds = "page_id LONG, url STRING, html STRING"
    frame = spark.createDataFrame([(k, None, p) for k, p in enumerate(made)], kinds)
    got = {r.page_id: r.text for r in pages.extract_main(frame).collect()}
    assert {made[k]: v for k, v in got.items() if v != WANT} == {}


def test_marked_parts_are_still_left_out():
    weights = pages.Weights()
    words = "some words of the article that go on "
    for mark in ("ad", "cookie-notice", "comment-list", "site-footer", "share-buttons"):
        part = f'<div class="{mark}">Other words here</div>'
        for page in (f"<article><p>{words * 4}</p>{part}<p>{words * 4}</p></article>", f"{part}<div><p>{words * 4}</p>{part}<p>{words * 4}</p></div>{part}"):
            assert "Other" not in pages.main_text(page, weights) and pages.main_text(page, weights).count("some") == 8
    readers = '<div id="comments">' + f"<article><p>{words * 9}</p></article>" * 3 + "</div>"
    for page in (f"<div><h1>A title of some words</h1><p>{words}</p></div>{readers}", f"<article><h1>A title of some words</h1><p>{words}</p>{readers}</article>"):
        assert pages.main_text(page, weights) == f"A title of some words\n{words.strip()}"


def test_marks_are_learnt(spark):
    page = '<article><p>{0}</p></article><div class="promo">{0}</div><div class="ads">{0}</div>'.format("some words " * 9)
    inner = '<article><div class="related">{0}</div><p>{0}</p></article>'.format("some words " * 9)
    frame = spark.createDataFrame([(k, None, p) for k, p in enumerate([page, inner] * 5)], "page_id LONG, url STRING, html STRING")
    marks = pages.fit_weights(frame).marks
    assert set(marks) == {"promo", "ads", "related"} and marks["promo"] < -1 and marks["related"] == -0.1


def test_captions_of_figures_stay(spark):
    figure = '<figure><img src="a.png"><figcaption>What the picture shows</figcaption></figure>'
    page = PAGE.replace("<p>Last words", figure + "<p>Last words")
    frame = spark.createDataFrame([(1, "u", page)], "page_id LONG, url STRING, html STRING")
    want = WANT.replace("\nLast", "\nWhat the picture shows\nLast")
    assert pages.extract_main(frame).first().text == want
    words = "some words of the article that go on " * 3
    plain = f"<div><p>{words}</p>{figure}<p>{words}</p></div>"
    assert pages.main_text(plain, pages.Weights()) == f"{words.strip()}\nWhat the picture shows\n{words.strip()}"


def test_odd_pages(spark):
    odd = [None, "", "   ", "plain words only", "<p>", "<", "a < b", "<!-- open", "<script>never ends", "<article></article>",
           "<p class='x>broken", "<article><p>" + "word " * 50_000 + "</article>", "</div></p></html>"]
    frame = spark.createDataFrame(list(enumerate(odd)) + [(None, PAGE), (1, "")], "page_id LONG, html STRING").withColumn("url", F.lit(None).cast("string"))
    got = pages.extract_main(frame, pages.Weights()).collect()
    text = {r.page_id: r.text for r in got if r.page_id != 1}
    assert len(got) == len(odd) + 2
    assert text[0] == "" and text[3] == "plain words only" and text[6] == "a < b" and text[9] == ""
    assert len(text[11]) == 250_000 - 1 and text[8] == ""
    assert pages.extract_main(frame.limit(0)).count() == 0


def test_short_blocks_at_both_ends_stay(spark):
    """Weights learnt where lists and boxes stand outside of articles only."""
    words = "some words of the article that go on " * 4
    outside = '<div class="box"><ul>' + '<li><a href="/">x</a></li>' * 9 + "</ul></div>"
    learnt = f"{outside}<article><p>{words}</p></article>{outside}"
    frame = spark.createDataFrame([(k, None, learnt) for k in range(5)], "page_id LONG, url STRING, html STRING")
    weights = pages.fit_weights(frame)
    assert weights.tags["li"] <= -1 and weights.block["li"] < -1
    ends = {
        "<ul><li>x</li><li>y</li></ul><p>By me</p>": "x\ny\nBy me",
        "<table><tr><td>1</td><td><a href='z'>2</a></td></tr></table>": "1\n2",
        "<br>" * 40 + "<div><div><ul><li><a href='/'>z</a></li></ul></div></div>": "z",
    }
    for part, text in ends.items():
        for name in ("article", "main"):
            page = f"{outside}<{name}>{part}<p>{words}</p>{part}</{name}>{outside}"
            assert pages.main_text(page, weights) == f"{text}\n{words.strip()}\n{text}"
    two = f"{outside}<article><p>{words}</p></article><div>Box between them</div><article><p>{words}</p></article>{outside}"
    assert pages.main_text(two, weights) == pages.main_text(two, pages.Weights()) == f"{words.strip()}\n{words.strip()}"


def test_names_of_comments():
    words = "some words of the article that go on " * 4
    readers = ("user-comments", "usercomments", "article-comments", "comments-wrapper", "post_comments_list", "reader-comment", "comment-form")
    for mark in [f'class="{c}"' for c in readers] + ['itemprop="comment"', 'itemscope itemtype="https://schema.org/Comment"']:
        page = f"<main><p>{words}</p><div {mark}><p>{words}Well said</p></div></main>"
        assert pages.main_text(page, pages.Weights()) == words.strip(), mark
    for name in ("no-comments", "has-comments", "with-comments", "commentary"):
        page = f'<main><p>{words}</p><div class="{name}"><p>Last words</p></div></main>'
        assert pages.main_text(page, pages.Weights()).endswith("\nLast words"), name


def test_stray_ends_take_linear_time():
    import time

    took = []
    for n in (4_000, 32_000):
        page = "<div>" * n + "some words" + "</section>" * n + "<p>more words</p>"
        start = time.perf_counter()
        pages.tokens(page)
        took.append(time.perf_counter() - start)
    assert took[1] < 32 * took[0] + 0.5


def test_best_region_against_all_parts():
    import random

    rng = random.Random(5)
    for _ in range(300):
        scores = [float(rng.randint(-4, 4)) for _ in range(rng.randint(0, 12))]
        parts = [(i, j) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)]
        most = max([0.0] + [sum(scores[i:j]) for i, j in parts])
        start, end = pages.best_region(scores)
        assert sum(scores[start:end]) == most and (most > 0 or start == end)


def test_best_region():
    assert pages.best_region([]) == (0, 0)
    assert pages.best_region([-1.0, -2.0]) == (0, 0)
    assert pages.best_region([1.0, -3.0, 2.0, -1.0, 2.0, -5.0, 3.0]) == (2, 5)


def test_given_pages_follow_their_structure(spark):
    import html
    import re

    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    got = {r.page_id: r.text for r in pages.op5_main_text(spark, "/root/testdata/sf0.01").collect()}
    for r in rows:
        body = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        parts = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", p)).split()) for p in re.split(r"</?(?:h1|p|br)>", body))
        assert got[r.page_id] == "\n".join(p for p in parts if p)
