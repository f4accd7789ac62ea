"""Main text of pages."""

import random

import numpy as np
from brute import SMALL
from pyspark.sql import functions as F

from newsflow.llm import main_text
from newsflow.llm.main_text import ARTICLE, BODY, CHROME, page_blocks, repeated, sorted_runs


def test_suffix_order_and_repeats():
    random_ = random.Random(2)
    for _ in range(20):
        pages = sorted(random_.choices(range(5), k=200))
        tokens = random_.choices(range(2), k=200)
        order, _ = sorted_runs(np.array(tokens), np.array(pages))
        runs = {
            i: tuple(tokens[i : i + 8]) for i in range(193) if pages[i] == pages[i + 7]
        }
        assert set(order.tolist()) == set(runs)
        keys = [runs[i] for i in order.tolist()]
        assert keys == sorted(keys)
        want = [0] * 200
        for i, run in runs.items():
            n = len({pages[j] for j, other in runs.items() if other == run})
            for j in range(i, i + 8):
                want[j] = max(want[j], n)
        assert repeated(np.array(tokens), np.array(pages)).tolist() == want


def test_zones():
    html = (
        "<html><head><title>T</title><script>var a='</p>'</script></head><body><header>Top</header>"
        "<div class='cookie-notice'>We use cookies</div><nav><li>Menu</li></nav><article><header>"
        "<h1>Head &amp; line</h1></header><p><b>One\n  two<br><p>Three &#233;<aside>Side</aside></p>"
        "<section id=comments><p>I say</p></section><form>Mail <button>Go</button></form>"
        "<p style='display: none'>Hidden</p></article><p>After</p><footer>End"
    )
    blocks = page_blocks(html)
    assert [t for t, z in blocks if z == ARTICLE] == ["Head & line", "One two", "Three é"]
    assert [t for t, z in blocks if z == BODY] == ["After"]
    assert {"Top", "We use cookies", "Menu", "Side", "I say", "Hidden", "End"} <= {t for t, z in blocks if z == CHROME}


def test_odd_markup():
    html = "<div class='page has-sidebar'><p>One<p>Two<li>Three</div><div class=SidebarLeft>No</div><script/>x"
    assert [t for t, z in page_blocks(html) if z == BODY] == ["One", "Two", "Three", "x"]
    assert page_blocks("<p>a" * 50_000 + "</b>" * 50_000)[-1] == ("a", BODY)
    assert page_blocks("<article><p>cut off in a tag <a hre") == [("cut off in a tag", ARTICLE)]


def test_repeated_runs_are_removed_without_markup(spark):
    menu = "Start News Sport Weather Culture Travel Money Help About"
    own = lambda i: " ".join(f"word{i}x{j}" for j in range(30))
    rows = [(i, "http://h/x", f"<div>{menu}</div><div>{own(i)} {menu} tail{i}</div>") for i in range(12)]
    rows += [(50, "http://other/x", f"<div>{menu}</div>"), (51, None, None), (52, "http://[bad", "")]
    rows += [(60, "http://third/y", f"<article><p>{menu}</p></article>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("c"))
    found = {r.page_id: r.text for r in main_text.main_text(pages).collect()}
    for i in range(12):
        assert found[i] == f"{own(i)} tail{i}"
    assert found[50] == menu and found[51] == "" and found[52] == "" and found[60] == menu
    twice = main_text.main_text(pages.unionByName(pages))
    assert twice.count() == 2 * len(rows)
    assert main_text.main_text(pages.limit(0)).count() == 0


def test_articles_lose_nothing(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    found = {r.page_id: r.text for r in main_text.main_text(pages).collect()}
    for r in pages.collect():
        assert found[r.page_id] == "\n".join(t for t, z in page_blocks(r.html or "") if z == ARTICLE)


def test_copies_of_an_article_stay(spark):
    text = lambda name, n: " ".join(f"{name}{j}" for j in range(n))
    menu = "Start News Sport Weather Culture Travel Money Help About"
    rows, want = [], {}
    for i in range(30):  # most marked articles of a host are one article, exactly or nearly
        body = text("story", 60) + (f" on day{i}" if i % 2 else "") if i < 24 else text(f"own{i}x", 60)
        rows.append((i, f"http://marked/{i}", f"<nav>{menu}</nav><article><p>{body}</p></article>"))
        want[i] = body
    for i in range(100, 130):  # an article under three urls, pages that begin alike, a menu
        body = text("story", 60) if i < 103 else f"The {text(f'own{i}x', 30)}" if i < 112 else text(f"own{i}x", 30)
        rows.append((i, f"http://plain/{i}", f"<div>{menu}</div><div>{body}</div>"))
        want[i] = body
    for i in range(200, 230):  # the same in one block
        body = f"The {text(f'own{i}x', 30)}" if i < 209 else text(f"own{i}x", 30)
        rows.append((i, f"http://block/{i}", f"<div>{menu} {body}</div>"))
        want[i] = body
    for i in range(300, 312):  # a menu of short blocks
        items = "".join(f"<li>{word}" for word in menu.split())
        rows.append((i, f"http://list/{i}", f"<ul>{items}</ul><p>The {text(f'own{i}x', 30)}"))
        want[i] = f"The {text(f'own{i}x', 30)}"
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in main_text.main_text(pages).collect()} == want


def many_pages(spark):
    """Hosts with menus of several shares, copies and near copies; some with three tokens at most."""
    random_ = random.Random(4)
    words = lambda name, n: " ".join(f"{name}{j}" for j in range(n))
    rows = []
    for i in range(240):
        menu, rare = words("menu", 12), words("rare", 10) if i < 16 else words("seldom", 10) if i < 27 else ""
        story = words("story", 60) + f" tail{i % 7}" if i % 3 == 0 else words(f"own{i}x", 40)
        body = f"<div>{menu}</div><div>{rare} {story}</div><div>{random_.choice(['', menu, words('foot', 9)])}</div>"
        article = f"<article><p>{story}</p><p>{words('share', 14) if i % 5 else ''}</p></article>"
        rows.append((i, "http://plain/x", body))
        rows.append((1000 + i, "http://marked/x", article))
        rows.append((2000 + i, "http://mixed/x", body if i % 2 else article))
    rows += [(3000 + i, f"http://{i}/x", "<p>one two three") for i in range(3)]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_the_text_does_not_depend_on_the_number_of_chunks(spark, monkeypatch):
    pages = many_pages(spark).cache()

    def texts():
        return {r.page_id: r.text for r in main_text.main_text(pages).collect()}

    whole = texts()
    marked = {r.page_id: "\n".join(t for t, z in page_blocks(r.html) if z in (ARTICLE, BODY)) for r in pages.collect()}
    assert not any("menu0 " in whole[i] for i in range(240)) and sum(whole[i] != marked[i] for i in whole) > 400
    assert whole[3000] == "one two three"
    for name, size in (("CHUNK_BYTES", 40_000), ("CHUNK_BYTES", 9_000)):
        monkeypatch.setattr(main_text, name, size)
        assert texts() == whole
