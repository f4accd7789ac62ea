"""Operators on small tables, joins also against brute force."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from newsflow import schemas
from newsflow.operators import docs, entities, manifest, merge, pages, skew, stats

PAIRS = "id bigint, url string, batch string"
RECORDS = "id string, url string, batch string"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_merge_takes_the_last_record(spark):
    events = spark.createDataFrame(
        [(9, "u1", "20190311000000"), (2, "u1", "20190311001500"), (3, "u2", "20190311001500"),
         (4, None, "20190311001500"), (5, "", "20190311001500")], PAIRS)
    records = spark.createDataFrame(
        [("20190311001500-2", "u1", "20190311001500"), ("20190311001500-10", "u1", "20190311001500"),
         ("20190311001500-1", "u9", "20190311001500")], RECORDS)
    assert rows(merge.merge_url_ids(events, records)) == [
        ("u1", 2, "20190311001500-10"), ("u2", 3, ""),
    ]
    assert rows(merge.merge_url_ids(events, records, "outer", keep_batch=True)) == [
        ("u1", 2, "20190311001500-10", "20190311001500"), ("u2", 3, "", "20190311001500"),
        ("u9", None, "20190311001500-1", "20190311001500"),
    ]


def test_merge_against_brute_force(spark):
    rng = random.Random(1)
    batches = [f"201903110{h}0000" for h in range(5)]
    # One URL holds a third of all rows.
    event_rows = [(n, rng.choice(["hot", *map(str, range(20))][:: 1]) if n % 3 else "hot", rng.choice(batches))
                  for n in range(3000)]
    record_rows = [(f"{b}-{'T' if n % 4 == 0 else ''}{n}", rng.choice(["hot", *map(str, range(10, 30))]), b)
                   for n in range(1000) for b in [rng.choice(batches)]]
    last_event, last_record = {}, {}
    for n, url, b in sorted(event_rows, key=lambda r: (r[2], r[0])):
        last_event[url] = n
    for i, url, b in sorted(record_rows, key=lambda r: (r[2], "T" in r[0], int(r[0].split("-")[1].lstrip("T")))):
        last_record[url] = i
    merged = merge.merge_url_ids(
        spark.createDataFrame(event_rows, PAIRS), spark.createDataFrame(record_rows, RECORDS))
    assert rows(merged) == sorted(
        ((u, e, last_record.get(u, "")) for u, e in last_event.items()), key=str)


def test_merge_without_batches(spark):
    events = spark.createDataFrame([(1, "u", ""), (2, "u", "")], PAIRS)
    assert rows(merge.merge_url_ids(events, spark.createDataFrame([], RECORDS))) == [("u", 2, "")]


@pytest.mark.parametrize("digest", [False, True])
def test_duplicate_counts(spark, digest):
    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("a", None), ("b", "y")], "feed string, url string")
    assert rows(merge.duplicate_counts(df, "url", "feed", digest=digest)) == [
        ("a", 2, 1, 1), ("b", 1, 1, 0),
    ]
    assert rows(merge.duplicate_counts(df, "url")) == [(3, 2, 1)]
    assert rows(merge.duplicate_counts(df, "url", approximate=True)) == [(3, 2, 1)]


def stats_rows(spark, values):
    defaults = {"url": "u", "domain": "http://d/", "nbytes": 1, "eventid": 1, "gkgid": "g", "status": 200,
                "accessdate": "20200305", "title": "", "site_name": "", "author": "", "keywords": "",
                "description": ""}
    return spark.createDataFrame([tuple({**defaults, **v}.values()) for v in values], schemas.ARTICLE_STATS)


def test_whitelist(spark):
    domains = ["http://notcnnxcom/", "http://bbc.co.uk/", "http://abc/", None]
    df = stats_rows(spark, [{"domain": d} for d in domains])
    kept = stats.whitelisted_articles(df, ["cnn.com", "", "abc"])
    assert [r.domain for r in kept.collect()] == ["http://notcnnxcom/", "http://abc/"]
    assert (kept.first().year, kept.first().month, kept.first().day) == (2020, 3, 5)
    exact = stats.whitelisted_articles(df, ["cnn.com", "abc"], escape=True)
    assert [r.domain for r in exact.collect()] == ["http://abc/"]
    assert stats.whitelisted_articles(df, []).count() == 0
    many = [f"no-such-{n}" for n in range(1200)] + ["bbc"]
    assert [r.domain for r in stats.whitelisted_articles(df, many).collect()] == ["http://bbc.co.uk/"]
    assert stats.whitelisted_ids(df, ["abc"]).count() == 1


def test_flags_and_daily_counts(spark):
    df = stats_rows(spark, [
        {"keywords": None, "description": ""}, {"keywords": " ", "description": "d"},
        {"keywords": "k"}, {"status": 404, "keywords": "k"}, {"accessdate": "20191231"},
    ])
    flags = stats.article_flags(df)
    assert flags.columns == schemas.ARTICLE_FLAG_COLUMNS
    assert rows(flags.select("hasKeywords", "hasDescription")) == [(0, 0), (0, 0), (1, 0), (1, 1)]
    assert rows(stats.daily_domain_stats(df)) == [
        (2019, 12, 31, "http://d/", 1, 0, 0, 0), (2020, 3, 5, "http://d/", 3, 2, 1, 1),
    ]
    assert stats.article_flags(df.where("false")).count() == 0
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        stats.article_flags(stats_rows(spark, [{"accessdate": "20201399"}])).collect()


def test_articles_for_ids(spark):
    df = stats_rows(spark, [{"gkgid": "a"}, {"gkgid": "b"}, {"gkgid": "a", "status": 500}])
    ids = spark.createDataFrame([("a",), ("a",), ("c",)], "gkgid string")
    found = stats.articles_for_ids(df, ids)
    assert found.columns == schemas.SELECTED_ARTICLE_COLUMNS
    assert [r.gkgid for r in found.collect()] == ["a"]


def test_run_totals(spark):
    df = spark.createDataFrame([(200, 5), (200, 7), (404, 9), (-1, None)], "status int, nbytes bigint")
    assert rows(stats.run_totals(df)) == [(2, 4, 12)]
    assert rows(stats.run_totals(df.where("false"))) == [(0, 0, 0)]


ENTITY_ROWS = [
    ("r1", 20200305101500, "T", "1#France#FR", "P", None),
    ("r2", 20201399000000, "T", "1#France#FR", "P", "O"),
    ("r3", 10101000000, None, None, None, None),
]


def test_entities(spark):
    schema = "GKGRECORDID string, DATE bigint, Themes string, Locations string, Persons string, Organizations string"
    found = entities.process_entities(spark.createDataFrame(ENTITY_ROWS, schema))
    assert found.columns == schemas.ENTITY_COLUMNS
    assert rows(found) == [("r1", "T", "P", "", "FR;France", 2020, 3, 5)]


def article_and_entity_rows(spark):
    rng = random.Random(2)
    # A third of the articles have no record id, another third share one.
    ids = [rng.choice(["", None, "hot", "hot", *(f"r{n}" for n in range(8))][: 12]) for _ in range(900)]
    articles = [("d", n, i, 2020, 3, 5, 0, 0) for n, i in enumerate(ids)]
    records = [(i, f"t{k}", "p", "o", "l", 2020, 1, 2) for i in ["hot", "r1", "r2", "r99"] for k in range(2)]
    records.append(("", "t", "p", "o", "l", 2020, 1, 2))
    flags = "domain string, eventid bigint, gkgid string, year int, month int, day int, hasKeywords int, hasDescription int"
    processed = "gkgid string, Themes string, Persons string, Organizations string, Locations string, year int, month int, day int"
    return articles, records, spark.createDataFrame(articles, flags), spark.createDataFrame(records, processed)


@pytest.mark.parametrize("hot_share", [None, 0.05])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_article_entities(spark, how, hot_share):
    articles, records, left, right = article_and_entity_rows(spark)
    expected = []
    for a in articles:
        found = [r for r in records if r[0] == a[2] and r[0]]
        expected += [(a[1], a[2], r[1], r[5]) for r in found]
        if not found and how == "left":
            expected.append((a[1], a[2], None, None))
    joined = entities.article_entities(left, right, how, hot_share)
    assert {"gkg_year", "gkg_month", "gkg_day", "year"} <= set(joined.columns)
    assert rows(joined.select("eventid", "gkgid", "Themes", "gkg_year")) == sorted(expected, key=str)


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_salted_join(spark, how):
    rng = random.Random(3)
    left = [(rng.choice([1, 1, 1, 2, 3, None]), n) for n in range(600)]
    right = [(k, v) for k in (1, 2, None) for v in range(3)]
    matched = Counter()
    expected = []
    for k, n in left:
        found = [v for rk, v in right if rk is not None and rk == k]
        if how == "left_semi":
            expected += [(k, n)] if found else []
        elif how == "left_anti":
            expected += [] if found else [(k, n)]
        else:
            expected += [(k, n, v) for v in found]
            if how == "left" and not found:
                expected.append((k, n, None))
        matched[k] += 1
    joined = skew.salted_join(
        spark.createDataFrame(left, "k int, n int"), spark.createDataFrame(right, "k int, v int"),
        ["k"], how, share=0.25, salts=7)
    assert rows(joined) == sorted(expected, key=str)
    assert rows(skew.hot_keys(spark.createDataFrame(left, "k int, n int"), ["k"], 0.25)) == [(1,)]


def test_search_docs(spark):
    df = stats_rows(spark, [{"eventid": 1, "author": None}, {"eventid": None, "gkgid": "x"}, {"eventid": 3}])
    texts = spark.createDataFrame(
        [("1", "20200305", "one"), ("g_x", "20200305", "two"), ("3", "20200306", "other day")],
        "article_id string, ymd string, text string")
    found = docs.search_docs(df, texts)
    assert found.columns == schemas.SEARCH_DOC_COLUMNS
    assert rows(found.select("eventid", "article", "author")) == [(1, "one", ""), (3, "", ""), (None, "two", "")]


def test_whitelist_table(spark):
    kept = [f"http://site{n}.example/" for n in range(700)]
    frame = spark.createDataFrame([(d, i) for i, d in enumerate(kept + ["http://OTHER/", None])], "domain string, n int")
    lines = [(f"site{n}[.]example",) for n in range(0, 700, 2)] + [("(?i)other",)]
    found = stats.whitelisted_by(frame, spark.createDataFrame(lines, "line string"))
    assert sorted(r.n for r in found.collect()) == [*range(0, 700, 2), 700]
    assert stats.whitelisted_by(frame, spark.createDataFrame([], "line string")).count() == 0
    flagged = frame.where(stats.whitelist_match(F.col("domain"), ["(?i)nothing", "other"]))
    assert flagged.count() == 0


def test_missing_ids_are_not_shuffled_for_an_inner_join(spark):
    _, _, left, right = article_and_entity_rows(spark)
    plan = entities.article_entities(left, right, "inner")._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64" not in plan or "NOT (gkgid" in plan


def test_unseen(spark):
    new = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    assert rows(docs.unseen(new, spark.createDataFrame([(1, "z")], "k int, w string"), ["k"])) == [(2, "b")]


BASE = "http://h/v2"


def manifest_rows(spark, names):
    return manifest.parse_manifest(spark.createDataFrame([(f"{BASE}/{n}",) for n in names], "url string"))


def test_manifest(spark):
    names = ["20190311214500.export.CSV.zip", "20190311214500.mentions.CSV.zip",
             "20190311214500.gkg.csv.zip", "20190312000000.export.CSV.zip"]
    found = manifest_rows(spark, names)
    assert {(r.name, r.ymd, r.kind) for r in found.collect()} == {
        (n, n[:8], n.split(".")[1]) for n in names}
    kept = manifest.without_mentions(found)
    assert {r.kind for r in kept.collect()} == {"export", "gkg"}
    assert manifest.for_date(kept, "20190311").count() == 2
    assert {r.ymd: len(r.urls) for r in manifest.files_by_date(kept).collect()} == {"20190311": 2, "20190312": 1}
    assert rows(manifest.files_by_kind(found))[0] == ("export", 2, "20190311214500", "20190312000000")
    assert tuple(manifest.first_batch(found).first()) == ("20190311214500", "20190311")


def test_expected_slots_and_completeness(spark):
    days = spark.createDataFrame([("2019-03-11",)], "day string").select(F.to_date("day").alias("day"))
    slots = manifest.expected_slots(days, BASE)
    urls = sorted(r.url for r in slots.collect())
    assert len(urls) == 192
    assert urls[:2] == [f"{BASE}/20190311000000.export.CSV.zip", f"{BASE}/20190311000000.gkg.csv.zip"]
    assert urls[-1] == f"{BASE}/20190311234500.gkg.csv.zip"
    exports = sorted(u for u in urls if "export" in u)
    records = sorted(u for u in urls if "gkg" in u)
    landed = spark.createDataFrame([(u,) for u in exports[:90] + records[:91] + records[:5]], "url string")
    parsed = manifest.parse_manifest(landed)
    assert rows(manifest.completeness(parsed)) == [("20190311", "export", 90, 0), ("20190311", "gkg", 91, 1)]
    missing = sorted(r.url for r in manifest.missing_slots(slots, parsed).collect())
    assert missing == sorted(exports[90:] + records[91:])


def test_rebuilt_domains(spark):
    df = stats_rows(spark, [{"eventid": 1, "url": "http://a/1"}, {"eventid": 2, "url": "/x"}, {"eventid": 3}])
    links = spark.createDataFrame(
        [("1", "20200305", ["http://b/1", "https://c/", "http://b/2", "http://[bad"]), ("2", "20200305", []),
         ("3", "20200306", ["http://z/"])],
        "article_id string, ymd string, links array<string>")
    found = {r.article_id: r for r in pages.rebuild_domains(df, links).collect()}
    assert found["1"].domains == {"http://b/": 2, "https://c/": 1} and found["1"].basedomain == "http://a/"
    assert found["2"].domains == {} and found["2"].basedomain == ":///"
    assert found["3"].domains == {}


def test_automaton_finds_what_a_search_finds():
    import random

    from newsflow.operators.patterns import Automaton

    random_ = random.Random(1)
    for _ in range(60):
        words = ["".join(random_.choices("abé", k=random_.randint(1, 5))) for _ in range(random_.randint(1, 12))]
        texts = ["".join(random_.choices("abéx", k=random_.randint(0, 20))) for _ in range(15)]
        automaton = Automaton(words)
        found = {(texts[t], automaton.words[w]) for t, w in automaton.found(texts)}
        assert found == {(t, w) for t in texts for w in words if w in t}


def test_whitelist_of_a_hundred_thousand_lines(spark):
    """Equal to a regular-expression search of each line, over many shards and salts."""
    from newsflow.operators.patterns import holding_any

    lines = spark.range(100_000).selectExpr("concat('s', id * 7, '.site', id % 3, '.example') AS line")
    texts = spark.range(0, 20_000).selectExpr("concat('www.s', id, if(id % 2 = 0, '.', '-'), 'site', id % 4, '.example/') AS domain")
    got = {r.domain for r in holding_any(texts, lines, texts_per_salt=5000).collect()}
    known = {(i * 7, i % 3) for i in range(100_000)}
    # www.s123: the line may also begin after the s of a shorter number, so numbers match whole
    want = {
        f"www.s{i}{'.' if i % 2 == 0 else '-'}site{i % 4}.example/" for i in range(20_000) if (i, i % 4) in known
    }
    assert want and got == want


@pytest.mark.parametrize("escape", [False, True])
def test_whitelist_lines_of_all_kinds(spark, escape):
    import re

    from newsflow.operators.patterns import holding_any

    lines = ["a.c", "x", "..", "", None, "(?i)ABC", "b+c", "a.c", "é.è", "long.line.with.dots", ".z", "q."]
    texts = ["a.c", "abc", "ABC", "xx", "zz", "", None, "b", "bbc", "b+c", "é-è", "longxlinexwithxdots", "q", "qq", "a\nc", "éxè"]
    frame = spark.createDataFrame([(t,) for t in texts], "domain string")
    kept = holding_any(frame, spark.createDataFrame([(l,) for l in lines], "line string"), escape=escape, lines_per_shard=2)
    used = [re.escape(l) if escape else l for l in lines if l]
    assert {r.domain for r in kept.collect()} == {t for t in texts if t is not None and any(re.search(l, t) for l in used)}
    assert holding_any(frame, spark.createDataFrame([], "line string")).count() == 0


def test_missing_runs_cross_midnight(spark):
    from newsflow.operators import manifest

    days = spark.createDataFrame([("2024-01-01",), ("2024-01-02",), ("2024-01-03",)], "day string").selectExpr("to_date(day) AS day")
    expected = manifest.expected_slots(days, "http://f", kinds=("gkg",))
    gone = {95, 96, 97, 100, *range(191, 288)}
    slots = [r.batch for r in expected.orderBy("batch").collect()]
    landed = spark.createDataFrame([(b, "gkg") for i, b in enumerate(slots) if i not in gone], "batch string, kind string")
    runs = sorted((r.first_batch, r.last_batch, r.n_slots) for r in manifest.missing_runs(expected, landed).collect())
    assert runs == [(slots[95], slots[97], 3), (slots[100], slots[100], 1), (slots[191], slots[287], 97)]
    assert manifest.missing_runs(expected, expected).count() == 0


def test_sketches_of_days_merge_to_the_whole(spark, folder):
    from newsflow.operators import merge, sketches

    rows = spark.range(200_000).selectExpr(
        "cast(id % 7 AS string) AS ymd", "if(id % 3 = 0, 'gkg', 'export') AS kind", "if(id % 11 = 0, NULL, id % 60000) AS url"
    )
    sketches.daily_sketches(rows, "url", "kind").write.partitionBy("ymd").parquet(folder + "/days")
    kept = spark.read.parquet(folder + "/days")
    assert kept.count() == 14
    exact = {r.kind: r for r in merge.duplicate_counts(rows, "url", "kind").collect()}
    for r in sketches.merged_counts(kept, "kind").collect():
        assert r.n_rows == exact[r.kind].n_rows
        # four standard deviations of 1 / sqrt(2**14)
        assert abs(r.n_distinct - exact[r.kind].n_distinct) <= 4 * exact[r.kind].n_distinct / 128
    few = sketches.merged_counts(sketches.daily_sketches(rows.limit(100), "url"), lg_entries=14).first()
    assert few.n_distinct == rows.limit(100).where("url IS NOT NULL").select("url").distinct().count()
