"""Column functions against fixed cases and against the plain Python formula."""

import re
from datetime import date, datetime
from urllib.parse import urlparse

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from newsflow.functions import arrays, dates, text, urls

SLOW = settings(
    max_examples=6,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)


def column(spark, values, expression):
    """Values of an expression over a one-column table, in input order."""
    rows = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    return [r.x for r in rows.select("i", expression(F.col("v")).alias("x")).orderBy("i").collect()]


DOMAIN_CASES = {
    "HTTPS://U:p@Host.COM:80/x": "https://U:p@Host.COM:80/",
    "/rel/path": ":///",
    "foo": ":///",
    "": ":///",
    "mailto:a@b.c": "mailto:///",
    "http://[::1]/x": "http://[::1]/",
    "http://[bad/x": "",
    "http://a b.com/x|y": "http://a b.com/",
    "1http://x/y": ":///",
    "  http://a.com\t/x": "http://a.com/",
    "http://a.com\n/x": "http://a.com/",
    "http://a.com?q=/": "http://a.com/",
    "http://a.com#f": "http://a.com/",
    "http://a／b.com/": "",
    "http://日本.jp/x": "http://日本.jp/",
    "http://a\\b.com/x": "http://a\\b.com/",
    "http:///x": "http:///",
    "//host/x": "://host/",
}


def test_base_domain_cases(spark):
    assert column(spark, DOMAIN_CASES, urls.base_domain) == list(DOMAIN_CASES.values())
    assert column(spark, [None], urls.base_domain) == [None]


URL_TEXT = st.text(alphabet="htps:/?#@ab.1+-_\\|% \tÀ日", max_size=30)
SCHEMES = st.sampled_from(["", "http://", "https://", "HTTP://", "ftp:", "//", " http://"])


@SLOW
@given(st.lists(st.tuples(SCHEMES, URL_TEXT), min_size=150, max_size=300))
def test_base_domain_equals_urlparse(spark, pairs):
    values = [a + b for a, b in pairs]

    def formula(url):
        parsed = urlparse(url)
        return f"{parsed.scheme}://{parsed.netloc}/"

    assert column(spark, values, urls.base_domain) == [formula(v) for v in values]


def test_url_helpers(spark):
    assert column(spark, ["http://a/b/c.html", "x", "a/"], urls.base_name) == ["c.html", "x", ""]
    assert column(spark, ["http://a", "https://a", "HTTP://a", "/a"], urls.is_absolute) == [
        True, True, False, False,
    ]
    resolved = column(
        spark,
        ["/x", "//h/x", "http://b/x", "y"],
        lambda c: urls.resolve_root_links(c, F.lit("http://a.com/")),
    )
    assert resolved == ["http://a.com/x", "//h/x", "http://b/x", "y"]


def test_article_key(spark):
    rows = spark.createDataFrame(
        [(7, "g"), (None, "g1"), (0, "g2"), (None, None)], "eventid bigint, gkgid string"
    )
    keys = rows.select(urls.article_key(F.col("eventid"), F.col("gkgid")).alias("k")).collect()
    assert [r.k for r in keys] == ["7", "g_g1", "g_g2", "g_"]


def test_clean_text(spark):
    assert column(spark, ["a\tb\nc\rd"], text.clean_text) == ["a b c d"]
    assert column(spark, ["a\xa0b"], text.plain_spaces) == ["a b"]
    assert column(spark, [None, "", " ", "x"], text.has_text) == [0, 0, 1, 1]


ESCAPES = {
    "café": r"caf\xe9",
    "日本": r"\u65e5\u672c",
    "\U0001f600": r"\U0001f600",
    "a\\b": r"a\\b",
    "": "",
    "plain ~ text": "plain ~ text",
    "\x00\x1f\x7f\x80": r"\x00\x1f\x7f\x80",
}


def test_unicode_escape_cases(spark):
    assert column(spark, ESCAPES, text.unicode_escape) == list(ESCAPES.values())


@SLOW
@given(st.lists(st.text(alphabet=st.characters(exclude_categories=["Cs"])), min_size=100, max_size=300))
def test_unicode_escape_equals_codec(spark, values):
    expected = [v.encode("unicode-escape").decode("utf-8") for v in values]
    assert column(spark, values, text.unicode_escape) == expected


def python_locations(packed):
    parts = re.sub(r"-?[0-9]+\.?[0-9]?", "", packed).split("#")
    return sorted({re.sub(";.*", "", p) for p in parts if p})


def test_locations_case(spark):
    packed = (
        "1#France#FR#FR#46#2#FR;4#Paris, France (general), France#FR#FRA8#48.8667#2.33333#-1456928;"
        "3#Washington, District of Columbia, United States#US#USDC#38.8951#-77.0364#531871"
    )
    expected = [
        "", "FR", "FRA", "France", "Paris, France (general), France", "US", "USDC",
        "Washington, District of Columbia, United States",
    ]
    assert python_locations(packed) == expected
    assert column(spark, [packed], text.readable_locations) == [";".join(expected)]


@SLOW
@given(st.lists(st.text(alphabet="#;-.019aB é\x85", max_size=40), min_size=100, max_size=300))
def test_locations_equal_formula(spark, values):
    expected = [";".join(python_locations(v)) for v in values]
    assert column(spark, values, text.readable_locations) == expected


def test_batch_timestamps(spark):
    names = ["http://h/20190311214500.gkg.csv.zip", "20190311214500.export.CSV", "x.csv", "20191311214500.x"]
    assert column(spark, names, dates.batch_digits) == ["20190311214500"] * 2 + ["", "20191311214500"]
    stamps = column(spark, names, lambda c: dates.batch_ts(dates.batch_digits(c)))
    assert stamps == [datetime(2019, 3, 11, 21, 45)] * 2 + [None, None]


def test_batch_timestamps_do_not_depend_on_the_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        label = lambda c: dates.batch_label(dates.batch_ts(c))
        assert column(spark, ["20190310023000"], label) == ["20190310023000"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_dates(spark):
    assert column(spark, ["20200229", None], dates.strict_date) == [date(2020, 2, 29), None]
    values = ["20200229", "20200230", "20201399", "", "20190311214500", "x", None, "00010101"]
    expected = [date(2020, 2, 29), None, None, None, date(2019, 3, 11), None, None, None]
    assert column(spark, values, dates.lenient_date) == expected
    for bad in ("20201399", "202001011", "abc"):
        with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
            column(spark, [bad], dates.strict_date)
    assert column(spark, ["3", "12"], dates.month_label) == ["03", "12"]
    assert dates.check_ymd("20200229") == date(2020, 2, 29)
    for bad in ("20200230", "2020-2-1", "2020011"):
        with pytest.raises(ValueError):
            dates.check_ymd(bad)


def test_value_counts(spark):
    rows = spark.createDataFrame([(["b", "a", "b", "", None],), ([],), (None,)], "v array<string>")
    found = [r.x for r in rows.select(arrays.value_counts(F.col("v")).alias("x")).collect()]
    assert found == [{"a": 1, "b": 2}, {}, None]
