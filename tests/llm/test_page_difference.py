import random

import pytest
from pyspark.sql import types as T

from millrace.llm import page_difference as p
from millrace.llm.html_blocks import blocks_of

SCHEMA = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType())])


def pages(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS blocks", "1 AS row", "'y' AS text")


def own_text(page):
    """The text of a page by itself: what is in no named part."""
    return " ".join(b for b, _, named in zip(*blocks_of(page)) if not named)


def lcs_length(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


@pytest.mark.parametrize("every", [3, 128])
def test_common_lines_are_longest(monkeypatch, every):
    monkeypatch.setattr(p, "EVERY", every)
    rng = random.Random(every)
    for _ in range(300):
        a = [rng.randrange(6) for _ in range(rng.randrange(25))]
        b = [rng.randrange(6) for _ in range(rng.randrange(25))]
        found = p.common_lines(a, b)
        assert found == sorted(set(found)) and len(found) == lcs_length(a, b)
        it = iter(b)
        assert all(any(x == a[i] for x in it) for i in found)


def test_page_parts_and_characters():
    page = """<html><head><title>No</title><style>p{}</style></head><body class="home page"><!-- <p>no</p> -->
    <nav><ul><li>Menu</ul></nav><header>Top</header><div class="cookie-notice">We <p>use</p></div><div id='ad-1'>Buy</div>
    <article class="post"><header><h1>Title &amp; co</h1></header><p>One <b>bo</b>ld&nbsp; word<br>next</p>
    <script>var t="</p><p>no</p>";</script><p class="notice">Cookies<p>Two &lt;3 a < b &#233;</p>
    <form><p>Name</p><input></form><aside>Side</aside>
    <section class="comments"><article class="comment"><p>Reader says</p></article></section><ul><li>i1<li>i2</ul></article>
    <div role="complementary">more</div><footer>&copy; x</footer></body></html>"""
    blocks, main, part = blocks_of(page)
    assert own_text(page) == "Title & co One bold word next Two <3 a < b é i1 i2"
    assert [b for b, m in zip(blocks, main) if m] == ["Title & co", "One bold word", "next", "Two <3 a < b é", "i1", "i2"]
    assert [b for b, n in zip(blocks, part) if n] == ["Menu", "Top", "We", "use", "Buy", "Cookies", "Name", "Side", "Reader says", "more", "© x"]


@pytest.mark.parametrize("page, text", [
    ("", ""), ("plain text &am", "plain text &am"), ("<article><p>cut <b>off</b> he", "cut off he"), ("<article><p>a</p><p cla", "a"),
    ("<div class=ad>x<article><p>a</p></article>", "a"), ("<p>1 < 2</p><p>&#x41;&eacute;</p>", "1 < 2 Aé"), ("<script>no", ""),
    ("<article></article><p>a</p>", "a"), ("<main><p>a</p></main><p>b</p>", "a b"), ("<a title='<p>'>x</a>", "x")])
def test_small_pages(page, text):
    assert own_text(page) == text


def test_lines_shared_with_the_nearest_pages_go(spark):
    def page(n):
        return f"<body><p>Site of all</p><div>Go home</div><p>Own text {n}</p><p>More of {n} and a long line so that it is no copy</p><p>Legal line</p></body>"

    rows = [(i, f"https://h{i % 3}.org/a/{i}", page(i)) for i in range(60)]
    rows += [(100, "https://single.org/", page(100)), (101, None, None), (102, "http://[broken", "<p>x</p>"), (103, "https://h0.org/a/5", "")]
    found = {r["page_id"]: r for r in p.extract(pages(spark, rows)).collect()}
    for i in range(60):
        assert found[i]["text"] == f"Own text {i} More of {i} and a long line so that it is no copy"
        assert found[i]["n_chars"] == len(found[i]["text"])
    assert found[100]["text"].startswith("Site of all Go home Own") and found[101]["text"] == found[103]["text"] == ""
    assert found[102]["text"] == "x" and found[101]["url"] is None and found[101]["n_chars"] == 0


def test_articles_and_copies_are_spared(spark):
    article = "<nav>m</nav><article><p>Shared line</p><p>Text</p></article><div>Template</div><p>{}</p>"
    rows = [(i, f"https://h.org/{i}", article.format(f"own {i}" * 9)) for i in range(4)]
    rows += [(10, "https://c.org/1", "<p>same</p>"), (11, "https://c.org/1", "<p>same</p>"), (11, "https://c.org/1", "<p>same</p>")]
    found = sorted((r["page_id"], r["text"]) for r in p.extract(pages(spark, rows)).collect())
    assert found == [(i, "Shared line Text " + f"own {i}" * 9) for i in range(4)] + [(10, "same"), (11, "same"), (11, "same")]


def test_pages_without_an_article_among_copies_and_far_templates(spark):
    """Short pages whose template outweighs their text, runs of copies between them, templates that take turns along the
    path: unnamed menus and notices go, texts stay, and so do texts that copies share."""
    def page(i):
        menu = "".join(f"<div>Menu {i % 4} of {k} with a long line of words in it</div>" for k in range(5))
        return f"<body><span>Site name</span>{menu}<p>Own {i}</p><p>Text {i}</p><p>Third {i}</p><div>All rights of {i % 4}</div></body>"

    rows = [(i, f"https://h.org/{i:03d}", page(i)) for i in range(40)]
    rows += [(100 + k, f"https://h.org/{i:03d}/copy/{k}", page(i)) for i in (3, 4, 5) for k in range(10 * i, 10 * i + 9)]  # copied runs
    near = page(7).replace("Third 7", "Third of the copy")
    rows.append((300, "https://h.org/007-near", near))
    found = {r["page_id"]: r for r in p.extract(pages(spark, rows)).collect()}
    for i in range(40):
        assert found[i]["text"] == f"Own {i} Text {i} Third {i}", i
        assert found[i]["n_shared"] == 7 and found[i]["n_named"] == 0
    assert {found[100 + k]["text"] for k in range(30, 39)} == {"Own 3 Text 3 Third 3"}
    assert found[300]["text"] == "Own 7 Text 7 Third of the copy"


def test_names_decide_only_what_no_other_page_has(spark):
    def page(i):
        return (f"<nav>Home</nav><div class=ad>Buy {i}</div><article><p>Text {i}</p></article>"
                f"<div class=comments><p>Reader {i}</p></div><footer>Legal</footer>")

    found = p.extract(pages(spark, [(i, f"https://h.org/{i}", page(i)) for i in range(5)])).collect()
    assert {(r["page_id"], r["text"], r["n_shared"], r["n_named"]) for r in found} == {(i, f"Text {i}", 2, 2) for i in range(5)}


def test_neighbours_do_not_depend_on_the_layout(spark):
    rng = random.Random(4)
    rows = [(i, f"https://{'big' if i % 3 else f'h{i % 7}'}.org/{rng.randrange(50)}", f"<p>{i}</p><p>{i % 5}</p>") for i in range(400)]
    frame = p.materialize(p.entries_of(pages(spark, rows)), "entries")
    keys = sorted((r["host"], line, r["path"], r["entry"]) for r in frame.collect() for line in set(r["open"]))
    expected = sorted(link for x, y in zip(keys, keys[1:]) if x[:2] == y[:2] for link in ((x[3], y[3]), (y[3], x[3])))
    assert expected
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "9"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            assert sorted((r["entry"], r["other"]) for r in p.neighbours(frame).collect()) == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_empty_table(spark):
    assert p.extract(pages(spark, [])).collect() == []


def test_long_page(spark):
    long = "<article>" + "<p>word &amp; word</p>" * 30_000 + "</article>"
    row = p.extract(pages(spark, [(1, "https://a.b/c", long)])).first()
    assert row["text"] == " ".join(["word & word"] * 30_000) and row["n_chars"] == len(row["text"])
