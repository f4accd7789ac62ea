"""The page parser, its derived columns, and the body-text rules."""

import tracemalloc
from html.parser import HTMLParser

import pyarrow as pa
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from newsflow.functions import html
from newsflow.functions.html import read_page
from newsflow.operators import pages

PAGE = """<!DOCTYPE html><HTML><head><meta charset="utf-8"><title>A &amp; B
tab</title>
<meta property="og:site_name" content="Site"><meta name="author" content="Ann">
<meta name="DC.description" content="dc text"><meta name="description" content="meta text">
<meta name=news_keywords content='k1,k2'><link rel="canonical" href="http://c/">
<script>var s = '<a href="http://script/">no</a>';</script></head><body>
<!-- <a href="http://comment/">no</a> -->
<nav><ul><li><A HREF='http://one/?a=1&amp;b=2'>Home</A></li><li><a href="/rel">News</a></li></ul></nav>
<article><h1>Head line of the page</h1><p>{long}</p><p>Short end here now.</p></article>
<a name="x">no href</a><a class="c" href=https://two/x>two</a><a href="http://one/?a=1&b=2">again</a>
<footer>Copyright by <a href="http://foot/">someone</a> and others of this very long footer line that
has many words in it and would count as content but for its place</footer></body></html>
""".replace("{long}", "word " * 40 + "&eacute;nd.")


def fields(spark, html, columns):
    rows = spark.createDataFrame(
        [("http://h/1", 1, "20200101-5", "20200101", 200, html)],
        "url string, eventid bigint, gkgid string, ymd string, status int, html string",
    )
    return pages.parse_pages(rows).select(*columns).first()


def test_links_in_document_order():
    assert read_page(PAGE)["links"] == [
        "http://one/?a=1&b=2", "/rel", "https://two/x", "http://one/?a=1&b=2", "http://foot/",
    ]


def test_odd_markup():
    def links(html):
        return read_page(html, ("links",))["links"]

    assert links('<a href="http://a/" href="http://b/">') == ["http://a/"]
    assert links("<a title='>' href=x>") == ["x"]
    assert links("<a href='x") == []
    assert links("a < b <a href=y>") == ["y"]
    assert links("<abbr href=z><area href=q>") == []
    assert links("<!-- open <a href=x>") == []
    assert links("<!--><a href=x>") == ["x"]
    assert links("<script>if (a<b) '<a href=x>'</SCRIPT ><a href=y>") == ["y"]
    assert links("<script src=x /><a href=y></a>") == ["y"]
    assert links("<a href>") == [""]
    assert links("<textarea><a href=x></textarea><a href=y>") == ["y"]
    assert read_page(None) is None
    assert read_page("") == {"links": [], "meta": [], "blocks": []}


def test_open_markup_is_linear():
    # Each of these would take minutes if the scan started over at every tag.
    for piece in ("<a ", "<a href=\"", "<!-- ", "<script>", "</", "<a b='>", "&amp;<"):
        read_page(piece * 200_000)


class StandardLinks(HTMLParser):
    def __init__(self):
        super().__init__()
        self.links = []

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            self.links += [v or "" for k, v in attrs if k == "href"][:1]


PIECES = st.sampled_from(
    ['<a href="/x?a=1&amp;b">', "<A HREF='y'>", "<a href=z>", "</a>", "<p class='q>r'>", "text & more", " ",
     "<!-- <a href=no> -->", "<script>'<a href=no>'</script>", "<br/>", '<a name=t>', "<!DOCTYPE html>",
     "<style>a{}</style>", "<b>", "</p>", "é < 3 ", '<img alt="a > b" src=x>', "<a\nhref = 'w' >"]
)


@settings(max_examples=300, deadline=None)
@given(st.lists(PIECES, max_size=25))
def test_links_equal_the_standard_parser(pieces):
    html = "".join(pieces)
    standard = StandardLinks()
    standard.feed(html)
    standard.close()
    assert read_page(html, ("links",))["links"] == standard.links


def test_metadata_groups():
    meta = {group: dict(pairs) for group, pairs in read_page(PAGE)["meta"]}
    assert meta["og"] == {"site_name": "Site"}
    assert meta["dc"] == {"description": "dc text"}
    assert meta["meta"] == {
        "charset": "utf-8", "author": "Ann", "description": "meta text", "news_keywords": "k1,k2",
    }
    assert meta["page"] == {"title": "A & B\ntab", "canonical": "http://c/"}


def test_page_fields(spark):
    stats = pages.article_stats(
        pages.parse_pages(
            spark.createDataFrame(
                [("http://h/1", 1, "g", "20200101", 200, PAGE)],
                "url string, eventid bigint, gkgid string, ymd string, status int, html string",
            )
        )
    ).first()
    assert stats.title == "A & B tab"
    assert (stats.site_name, stats.author, stats.keywords) == ("Site", "Ann", "k1,k2")
    assert stats.description == "dc text"
    assert stats.nbytes == len(PAGE)
    assert stats.domain == "http://h/"


def test_title_places(spark):
    places = [
        ("og", '<meta property="og:title" content="T og">'),
        ("dc", '<meta name="dc.title" content="T dc">'),
        ("meta", '<meta name="title" content="T meta">'),
        ("page", "<title>T page</title>"),
    ]
    for start in range(len(places)):
        html = "".join(tag for _, tag in places[start:])
        title = fields(spark, html, [pages.page_fields(F.col("meta"))["title"].alias("t")]).t
        assert title == f"T {places[start][0]}"
    assert fields(spark, "<p>x", [pages.page_fields(F.col("meta"))["title"].alias("t")]).t == ""


def test_body_text(spark):
    body = fields(spark, PAGE, ["text"]).text
    assert "word word" in body and "énd." in body
    assert "Short end here now." in body
    for other in ("Home", "News", "script", "Copyright", "comment", "A & B"):
        assert other not in body


def python_body(html, rules=pages.BodyRules()):
    """The rules written out for one page at a time."""
    blocks = read_page(html)["blocks"]
    nothing = {"words": 0, "link_words": 0}
    density = lambda b: b["link_words"] / max(b["words"], 1)
    kept = []
    for i, block in enumerate(blocks):
        before = blocks[i - 1] if i else nothing
        after = blocks[i + 1] if i + 1 < len(blocks) else nothing
        if block["chrome"] or density(block) > rules.link_density:
            continue
        if density(before) <= rules.previous_link_density:
            content = (block["words"] > rules.short_words or after["words"] > rules.next_words
                       or before["words"] > rules.previous_words)
        else:
            content = (block["words"] > rules.long_words
                       or after["words"] > rules.next_words_after_links)
        if content:
            kept.append(block["text"])
    return "\n".join(kept).replace("\xa0", " ")


def test_body_text_against_brute_force(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    rows = table.select("page_id", "html", html.page_parser("blocks")(F.col("html")).alias("page"))
    found = rows.select("page_id", "html", pages.body_text(F.col("page.blocks")).alias("text")).collect()
    assert len(found) == 50 and sum(len(r.text) for r in found) > 10_000
    for row in found:
        assert row.text == python_body(row.html)


def test_body_of_link_lists_is_left_out(spark):
    menu = "<ul>" + "".join(f"<li><a href=/{i}>menu item {i}</a></li>" for i in range(30)) + "</ul>"
    html = f"<body>{menu}<p>{'text ' * 50}</p>{menu}</body>"
    assert fields(spark, html, ["text"]).text == ("text " * 50).strip()


def test_links_and_domains(spark):
    row = fields(spark, PAGE, ["links", "domains", "meta", "true_bytes", "nbytes"])
    assert row.links == ["http://one/?a=1&b=2", "https://two/x", "http://one/?a=1&b=2", "http://foot/"]
    assert row.domains == {"http://one/": 2, "https://two/": 1, "http://foot/": 1}
    assert row.true_bytes == len(PAGE.encode())


def test_pages_that_were_not_fetched(spark):
    rows = spark.createDataFrame(
        [("http://h/1", 1, "g", "20200101", 404, "<a href=http://x/>"), ("http://h/2", 2, "g", "20200101", -1, None)],
        "url string, eventid bigint, gkgid string, ymd string, status int, html string",
    )
    parsed = pages.parse_pages(rows)
    assert [r.text for r in pages.articles(parsed).collect()] == ["", ""]
    for derived in (pages.links, pages.domains, pages.html_meta, pages.article_stats):
        assert derived(parsed).count() == 0


def test_few_results_are_python_objects_at_once(spark, monkeypatch):
    """A batch is read in slices, so memory follows the slice and not the batch."""
    monkeypatch.setattr(html, "SLICE_CHARS", 20_000, raising=False)
    batch = pa.array([*["<p>a" * 1000] * 200, None, "", "<p>b" * 10_000])
    parse = html.page_parser("blocks").func
    tracemalloc.start()
    found = list(parse(iter([batch, pa.array([], pa.string())])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [len(part) for part in found] == [203, 0]
    assert found[0].to_pylist()[199:] == [html.read_page(h, ("blocks",)) for h in batch.to_pylist()[199:]]
    assert peak < 15e6  # 200,000 blocks as objects take over 40 MB
