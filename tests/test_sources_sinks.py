"""Readers on hand-written files, writers read back."""

import gzip
import json
from datetime import datetime, timezone
from pathlib import Path

import pytest
from files import entity_line, event_line, write, write_json, write_zip
from pyspark.sql import functions as F

from newsflow import schemas
from newsflow.sinks import files as out, runlog, search
from newsflow.sinks.tables import add_partitions, read_bucketed, write_bucketed, write_dated
from newsflow.sources import archives, articles, extracts, layout, lists


def test_schemas():
    assert len(schemas.EVENTS) == 61 and len(schemas.ENTITIES) == 27
    assert len(schemas.ARTICLE_STATS) == 12
    kinds = [f.dataType.simpleString() for f in schemas.EVENTS]
    assert (kinds.count("string"), kinds.count("double")) == (39, 9)
    assert kinds.count("int") + kinds.count("bigint") == 13


def test_read_events(spark, folder):
    lines = [
        event_line(1, "http://a/", SQLDATE=20190311, EventCode="025", Actor1Code="NA", AvgTone="-2.5"),
        event_line(2, '"quoted\thttp://b/'),
        "3\tshort",
        "",
    ]
    path = write(f"{folder}/20190311214500.export.CSV.gz", "\n".join(lines) + "\n")
    rows = {r.GLOBALEVENTID: r for r in extracts.read_events(spark, path).collect()}
    assert set(rows) == {1, 2, 3}
    assert (rows[1].EventCode, rows[1].Actor1Code, rows[1].AvgTone) == ("025", "NA", -2.5)
    assert rows[1].Actor2Name is None and rows[1][schemas.CORRUPT] is None
    assert rows[2][schemas.CORRUPT].startswith("2\t") and rows[3][schemas.CORRUPT] == "3\tshort"
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        extracts.read_events(spark, path, strict=True).collect()


def test_encodings(spark, folder):
    line = entity_line("20190311214500-1", "http://a/", Persons="josé")
    old = write(f"{folder}/20190311214500.gkg.csv", line + "\n", "latin-1")
    new = write(f"{folder}/20190311220000.gkg.csv", line + "\n")
    assert extracts.read_entities(spark, old, encoding="ISO-8859-1").first().Persons == "josé"
    assert extracts.read_entities(spark, new).first().Persons == "josé"


def test_pairs_of_many_files(spark, folder):
    paths = [
        write(f"{folder}/2019031121{m}00.export.CSV", event_line(n, f"http://{n}/") + "\n")
        for n, m in enumerate(("00", "15"))
    ]
    pairs = extracts.event_pairs(extracts.read_events(spark, paths))
    assert sorted(map(tuple, pairs.collect())) == [
        (0, "http://0/", "20190311210000"), (1, "http://1/", "20190311211500"),
    ]
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<GLOBALEVENTID:bigint,SOURCEURL:string>" in plan
    gkg = write(f"{folder}/20190311210000.gkg.csv", entity_line("20190311210000-T7", "http://z/") + "\n")
    assert tuple(extracts.entity_pairs(extracts.read_entities(spark, gkg)).first()) == (
        "20190311210000-T7", "http://z/", "20190311210000",
    )


def test_damaged_archives_give_no_lines(spark, folder):
    """A checksum that fails after many good lines, a broken stream, a wrong encoding."""
    path = f"{folder}/20190311214500.export.CSV.zip"
    write_zip(path, {"20190311214500.export.CSV": [f"line {n} {n * n}" for n in range(4000)]})
    good = Path(path).read_bytes()
    crc = bytearray(good)
    crc[14] ^= 255  # of the local header
    at = good.rindex(b"PK\x01\x02")
    crc[at + 16] ^= 255  # of the directory
    Path(folder, "1.export.CSV.zip").write_bytes(bytes(crc))
    stream = bytearray(good)
    stream[60:200] = b"\xff" * 140
    Path(folder, "2.export.CSV.zip").write_bytes(bytes(stream))
    write_zip(f"{folder}/3.export.CSV.zip", {"3.export.CSV": ["caf\xe9"]}, "latin-1")
    found = archives.read_zip_lines(spark, folder).collect()
    assert sorted(r.file_name for r in found if r.error) == [f"{n}.export.CSV.zip" for n in (1, 2, 3)]
    assert len([r for r in found if not r.error]) == 4000
    latin = archives.read_zip_lines(spark, f"{folder}/3.export.CSV.zip", "ISO-8859-1").collect()
    assert [r.line for r in latin] == ["caf\xe9"]


def test_zip_archives(spark, folder):
    write_zip(f"{folder}/20190311214500.export.CSV.zip",
              {"20190311214500.export.CSV": [event_line(n, f"http://{n}/") for n in range(6000)]})
    write(f"{folder}/20190311220000.export.CSV.zip", b"junk bytes")
    lines = archives.read_zip_lines(spark, folder)
    assert lines.where("error is null").count() == 6000
    bad = lines.where("error is not null").collect()
    assert [(r.file_name, r.line) for r in bad] == [("20190311220000.export.CSV.zip", None)]
    parsed = extracts.parse_lines(lines.where("line is not null"), "line", schemas.EVENTS, "file_name")
    assert parsed.agg(F.sum("GLOBALEVENTID")).first()[0] == sum(range(6000))
    assert parsed.where(F.col(schemas.CORRUPT).isNotNull()).count() == 0
    assert parsed.first().file_name == "20190311214500.export.CSV"


STATS = [
    ("http://a/1", "http://a/", 10, 1, "g-1", 200, "20190311", "café\\x", "", None, " k ", 'say "hi"'),
    ("http://a/2", "http://a/", 20, None, "", 404, "20190312", "t", "s", "", None, "d"),
]


def test_article_stats(spark, folder):
    stats = spark.createDataFrame(STATS, schemas.ARTICLE_STATS)
    out.write_article_stats(stats, f"{folder}/stats")
    rows = sorted(map(tuple, extracts.read_article_stats(spark, f"{folder}/stats").collect()))
    escaped = ("caf\\xe9\\\\x",)
    assert rows == [STATS[0][:7] + escaped + STATS[0][8:], STATS[1]]
    text = gzip.open(next(Path(folder, "stats").glob("part-*.gz")), "rt").read()
    assert text.startswith("\t".join(schemas.ARTICLE_STATS.names))
    foreign = "\t".join(schemas.ARTICLE_STATS.names) + "\nu\td\t1\t2\tg\t200\t20190311\t\t\t\t\t\"a \"\"b\"\"\"\n"
    path = write(f"{folder}/foreign/x.csv.gz", foreign)
    row = extracts.read_article_stats(spark, path).first()
    assert (row.title, row.description) == (None, 'a "b"')


def test_per_article_files(spark, folder):
    base = f"{folder}/tree"
    day = "2019/10/20191001"
    write(f"{base}/articles/{day}/876.text.gz", "line one\nline two")
    write(f"{base}/articles/{day}/g_2019-5.text.gz", "")
    write(f"{base}/page_links/{day}/876.txt.gz", "http://b/\nhttp://a/\nhttp://b/")
    write(f"{base}/page_links/{day}/877.txt.gz", "")
    write_json(f"{base}/page_domains/{day}/876.json.gz",
               {"url": "http://x/1", "basedomain": "http://x/", "domains": {"http://b/": 2, "http://a/": 1}})
    write(f"{base}/page_domains/{day}/877.json.gz", "{broken")
    write_json(f"{base}/html_meta/{day}/876.json.gz", {"og": {"title": "T"}, "meta": {"charset": "utf-8"}})
    paths = {kind: layout.date_path(base, kind, "20191001") for kind in layout.KINDS}
    texts = {r.article_id: (r.ymd, r.text) for r in articles.read_articles(spark, paths["articles"]).collect()}
    # A gzip file without content has no line, so Spark gives no row for it.
    assert texts["876"] == ("20191001", "line one\nline two")
    links = {r.article_id: r.links for r in articles.read_page_links(spark, paths["page_links"]).collect()}
    assert links["876"] == ["http://b/", "http://a/", "http://b/"] and links.get("877", []) == []
    domains = {r.article_id: r for r in articles.read_page_domains(spark, paths["page_domains"]).collect()}
    assert domains["876"].domains == {"http://b/": 2, "http://a/": 1} and domains["877"].domains is None
    meta = articles.read_html_meta(spark, f"{folder}/tree/html_meta", **layout.tree_options(".json.gz")).first()
    assert meta.meta["og"] == {"title": "T"} and meta.ymd == "20191001"


def test_layout(spark, folder):
    for day in ("20190930", "20191001"):
        for name in ("b.csv.gz", "a.csv.gz", ".hidden.csv.gz", "x.txt"):
            write(f"{folder}/article_stats/{day[:4]}/{day[4:6]}/{day}/{name}", "x")
    listed = layout.list_files(spark, folder, ".csv.gz")
    assert sorted((r.name, r.kind, r.ymd) for r in listed.collect()) == [
        (name, "article_stats", day) for name in ("a.csv.gz", "b.csv.gz") for day in ("20190930", "20191001")
    ]
    assert layout.listed_dates(listed).count() == 2
    assert {r.first_name for r in layout.first_files(listed).collect()} == {"a.csv.gz"}
    assert layout.date_path("/d/", "events", "20190316") == "/d/events/2019/03/20190316"
    assert [p[-8:] for p in layout.date_paths("/d", "gkg", "20190228", "20190302")] == [
        "20190228", "20190301", "20190302",
    ]


def test_lists(spark, folder):
    path = write(f"{folder}/list.txt",
                 "12 abc http://h/20190311214500.export.CSV.zip\n\n  \n\t9 d  http://h/20190311214500.gkg.csv.zip \nplain\n")
    assert [r.url[-8:] for r in lists.read_file_list(spark, path).collect()] == [".CSV.zip", ".csv.zip", "plain"]
    ids = write(f"{folder}/ids.csv", "gkgid\n 1-2 \n1-2\n\n3-4\n")
    assert sorted(r.gkgid for r in lists.read_id_list(spark, ids).collect()) == ["1-2", "3-4"]
    white = write(f"{folder}/white.txt", "cnn.com\n\n bbc \n")
    assert sorted(r.line for r in lists.read_whitelist(spark, white).collect()) == ["bbc", "cnn.com"]
    out.write_file_list(lists.read_file_list(spark, path), f"{folder}/out")
    assert lists.read_file_list(spark, f"{folder}/out").count() == 3


def test_dated_tables_replace_only_their_days(spark, folder):
    def rows(values):
        return add_partitions(spark.createDataFrame(values, "v int, ymd string"))

    write_dated(rows([(1, "20191231"), (2, "20200101")]), f"{folder}/t")
    write_dated(rows([(3, "20200101")]), f"{folder}/t")
    stored = spark.read.schema("v int, year string, month string, ymd string").parquet(f"{folder}/t")
    assert sorted(map(tuple, stored.collect())) == [
        (1, "2019", "12", "20191231"), (3, "2020", "01", "20200101"),
    ]
    pruned = layout.in_range(stored, "20200101")
    assert [r.v for r in pruned.collect()] == [3]
    assert "PartitionFilters: [isnotnull(ymd" in pruned._jdf.queryExecution().executedPlan().toString()


def test_monthly_append_has_headers(spark, folder):
    rows = spark.createDataFrame([("a\tb", 2020, 1), ("c", 2020, 2)], "v string, year int, month int")
    out.write_monthly(rows, f"{folder}/m")
    out.write_monthly(rows, f"{folder}/m")
    stored = spark.read.options(**extracts.STATS_READ_OPTIONS).schema("v string, year int, month int").csv(f"{folder}/m")
    assert sorted(map(tuple, stored.collect())) == [("a\tb", 2020, 1)] * 2 + [("c", 2020, 2)] * 2


def test_bulk_documents(spark, folder):
    docs = spark.createDataFrame(
        [("t\nx", "20190311", "é", "", "", "", 5, "g"), ("t", "20190311", "", "", "", "", None, "h")],
        "title string, accessdate string, article string, author string, keywords string, "
        "description string, eventid bigint, gkgid string",
    )
    search.write_bulk(docs.coalesce(1), f"{folder}/bulk", "news")
    lines = gzip.open(next(Path(folder, "bulk").glob("part-*.gz")), "rt", encoding="utf-8").read().splitlines()
    assert [json.loads(x)["index"] for x in lines[::2]] == [
        {"_index": "news", "_id": "5"}, {"_index": "news", "_id": "g_h"},
    ]
    assert list(json.loads(lines[1])) == schemas.SEARCH_DOC_COLUMNS
    assert json.loads(lines[3])["eventid"] is None


def test_run_log(spark, folder):
    rows = spark.range(10)
    found = runlog.write_observed(
        rows, lambda df: df.write.parquet(f"{folder}/x"), f"{folder}/runs", "job", total=F.sum("id")
    )
    assert found == {"rows": 10, "total": 45}
    runlog.log_run(spark, f"{folder}/runs", "other", datetime.now(timezone.utc), "done")
    logged = {r.kind: r for r in spark.read.schema(runlog.RUNS_DDL).json(f"{folder}/runs").collect()}
    assert logged["job"].message == "rows: 10; total: 45" and logged["other"].seconds >= 0


def test_bulk_files_read_back(spark, folder):
    """Line ends, quotes and action-like texts inside of documents; empty files too."""
    odd = '{"index":{"_id":"9"}}\n{"index": "x"}\n'
    rows = [("t", "20200101", odd, "", "k", "d", 5, "g-5"), ('"', "20200102", "", "a", "", "", None, "g-6")]
    names = ", ".join(f"{c} {'bigint' if c == 'eventid' else 'string'}" for c in schemas.SEARCH_DOC_COLUMNS)
    docs = spark.createDataFrame(rows, names)
    for partitions in (1, 4):
        search.write_bulk(docs.repartition(partitions), f"{folder}/{partitions}", "news")
        found = search.read_bulk(spark, f"{folder}/{partitions}").orderBy("accessdate").collect()
        assert [tuple(r) for r in found] == [("news", "5", *rows[0]), ("news", "g_g-6", *rows[1])]


def test_bucketed_tables(spark, folder):
    rows = spark.range(200).selectExpr("id % 7 AS k", "id AS v")
    write_bucketed(rows, f"{folder}/it's", "k", 4)
    write_bucketed(rows.select("v", "k"), f"{folder}/it's", "k", 4, "append")
    found = read_bucketed(spark, f"{folder}/it's", rows.schema, "k", 4)
    assert sorted(map(tuple, found.collect())) == sorted(2 * [(n % 7, n) for n in range(200)])
    write_bucketed(rows.where("v < 3"), f"{folder}/it's", "k", 4)
    assert read_bucketed(spark, f"{folder}/it's", rows.schema, "k", 4).count() == 3
    assert not spark.catalog.listTables()
