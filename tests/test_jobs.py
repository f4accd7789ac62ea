"""Whole jobs over small hand-written inputs."""

from pathlib import Path

import pytest
from files import entity_line, event_line, write, write_zip
from pyspark.sql import functions as F

from newsflow import schemas
from newsflow.functions.dates import batch_digits
from newsflow.operators import docs, pages, stats
from newsflow.plans import jobs
from newsflow.plans.session import working_folder
from newsflow.sinks import files as out, runlog
from newsflow.sinks.tables import one_run
from newsflow.sources import extracts, layout

DAY = "20190311"
FETCHED = "url string, eventid bigint, gkgid string, ymd string, status int, html string"


def page(title, *links):
    anchors = "".join(f'<a href="{link}">x</a>' for link in links)
    return f"<title>{title}</title><article><p>{'text ' * 30}{title}</p></article>{anchors}"


PAGES = [
    ("http://a/1", 1, f"{DAY}000000-1", DAY, 200, page("one", "http://b/1", "http://b/2", "/rel")),
    ("http://a/2", None, f"{DAY}000000-2", DAY, 200, page("two")),
    ("http://a/3", 3, "", DAY, 404, None),
]


def landed(spark, folder):
    """Two batches of both feeds as archives, one archive broken, landed as Parquet."""
    write_zip(f"{folder}/in/{DAY}000000.export.CSV.zip", {
        f"{DAY}000000.export.CSV": [event_line(1, "http://a/1", EventCode="010"), event_line(2, "http://a/2")]})
    write_zip(f"{folder}/in/{DAY}001500.export.CSV.zip", {
        f"{DAY}001500.export.CSV": [event_line(3, "http://a/1"), "bad line"]})
    write_zip(f"{folder}/in/20190312000000.export.CSV.zip", {
        "20190312000000.export.CSV": [event_line(9, "http://a/1")]})
    write_zip(f"{folder}/in/{DAY}000000.gkg.csv.zip", {
        f"{DAY}000000.gkg.csv": [entity_line(f"{DAY}000000-{n}", "http://a/1", DATE=f"{DAY}000000") for n in (2, 10)]})
    write(f"{folder}/in/{DAY}001500.gkg.csv.zip", b"junk")
    found = jobs.land_archives(spark, f"{folder}/in", f"{folder}/bronze", f"{folder}/runs")
    return found, spark.read.parquet(f"{folder}/bronze/events"), spark.read.parquet(f"{folder}/bronze/gkg")


def test_land_and_merge(spark, folder):
    found, events, records = landed(spark, folder)
    assert found == {
        "events": {"rows": 5, "bad_lines": 1, "bad_archives": 0},
        "gkg": {"rows": 3, "bad_lines": 0, "bad_archives": 1},
    }
    assert events.where("GLOBALEVENTID = 1").first().EventCode == "010"
    assert records.count() == 2
    merged = sorted(map(tuple, jobs.merge_day(events, records, DAY).collect()))
    assert merged == [("http://a/1", 3, f"{DAY}000000-10"), ("http://a/2", 2, "")]
    with pytest.raises(ValueError):
        jobs.merge_day(events, records, "20190399")
    assert spark.read.schema(runlog.RUNS_DDL).json(f"{folder}/runs").count() == 2


def test_landing_a_batch_keeps_the_others_of_its_day(spark, folder):
    def land(batch, *ids):
        lines = "\n".join(event_line(i, f"http://a/{i}") for i in ids) + "\n"
        path = write(f"{folder}/in{len(ids)}/{batch}.export.CSV.gz", lines)
        return jobs.land_files(spark, path, "export", f"{folder}/bronze", f"{folder}/runs")

    assert land(f"{DAY}000000", 1, 2) == {"rows": 2, "bad_lines": 0}
    land(f"{DAY}001500", 3)
    land(f"{DAY}000000", 1, 2, 4)  # landed again: replaced, not doubled
    events = spark.read.parquet(f"{folder}/bronze/events")
    assert sorted(r.GLOBALEVENTID for r in events.collect()) == [1, 2, 3, 4]
    records = spark.createDataFrame([], "GKGRECORDID string, DocumentIdentifier string, batch string, ymd string")
    assert jobs.merge_day(events, records, DAY).count() == 4


def read(spark, path, ddl):
    return spark.read.schema(f"{ddl}, ymd string, run string").parquet(path)


def test_page_job(spark, folder):
    fetched = spark.createDataFrame(PAGES, FETCHED)
    for _ in range(2):  # a second run of the same label replaces the first
        found = jobs.process_pages(fetched, folder, "r1", f"{folder}/runs")
    assert found["rows"] == 3 and found["n_fetched"] == 2
    texts = {r.article_id: r.text for r in read(spark, f"{folder}/articles", "article_id string, text string").collect()}
    assert texts[f"g_{DAY}000000-2"].endswith("two") and texts["3"] == "" and len(texts) == 3
    links = read(spark, f"{folder}/page_links", "article_id string, links array<string>")
    assert {r.article_id: r.links for r in links.collect()}["1"] == ["http://b/1", "http://b/2"]
    domains = read(spark, f"{folder}/page_domains", "article_id string, url string, basedomain string, domains map<string,bigint>")
    assert {r.url: r.domains for r in domains.collect()} == {"http://a/1": {"http://b/": 2}, "http://a/2": {}}
    meta = read(spark, f"{folder}/html_meta", f"article_id string, meta {schemas.HTML_META_DDL}")
    assert meta.where("article_id = '1'").first().meta == {"page": {"title": "one"}}
    columns = ", ".join(" ".join(schemas.ARTICLE_STATS_DDL.split()).split(", "))
    article_stats = read(spark, f"{folder}/article_stats", columns)
    assert {r.url: (r.title, r.status, r.accessdate) for r in article_stats.collect()} == {
        "http://a/1": ("one", 200, DAY), "http://a/2": ("two", 200, DAY)}

    jobs.backfill_domains(article_stats, links, f"{folder}/rebuilt", DAY)
    rebuilt = spark.read.schema("url string, domains map<string,bigint>").parquet(f"{folder}/rebuilt")
    assert {r.url: r.domains for r in rebuilt.collect()} == {"http://a/1": {"http://b/": 2}, "http://a/2": {}}
    jobs.backfill_domains(article_stats, links, f"{folder}/none", "20190312")
    assert spark.read.schema("url string").parquet(f"{folder}/none").count() == 0

    stored = spark.read.parquet(f"{folder}/articles").select("article_id", F.col("ymd").cast("string").alias("ymd"), "text")
    joined = docs.search_docs(article_stats, stored)
    parsed = pages.parse_pages(spark.createDataFrame(PAGES, FETCHED))
    assert sorted(map(str, joined.collect())) == sorted(map(str, docs.page_docs(parsed).collect()))
    assert not list(Path(folder).glob("_parsed/*"))
    jobs.index_documents(article_stats, stored, f"{folder}/bulk", "news", DAY)
    assert spark.read.text(f"{folder}/bulk").count() == 4


def test_backfill_day(spark, folder):
    _, events, records = landed(spark, folder)
    twice = PAGES + PAGES[:1]
    fetched = spark.createDataFrame(twice, FETCHED).select("url", "ymd", "status", "html")
    jobs.process_pages(spark.createDataFrame(PAGES[:1], FETCHED), f"{folder}/out", "r1", f"{folder}/runs")
    for _ in range(2):
        jobs.backfill_day(events, records, fetched, f"{folder}/out", f"{folder}/runs", DAY)
    found = read(spark, f"{folder}/out/articles", "article_id string").collect()
    assert sorted((r.run, r.article_id) for r in found) == [(f"backfill-{DAY}", "2"), (f"backfill-{DAY}", "3")]
    # a re-run that yields nothing leaves nothing of the day
    jobs.backfill_day(events, records, fetched.limit(0), f"{folder}/out", f"{folder}/runs", DAY)
    assert read(spark, f"{folder}/out/articles", "article_id string").count() == 0


def test_jobs_on_nothing(spark, folder):
    """Empty input: a log row with zero counts, and no crash."""
    empty = spark.createDataFrame([], FETCHED)
    assert jobs.process_pages(empty, f"{folder}/out", "r1", f"{folder}/runs")["rows"] == 0
    write_zip(f"{folder}/in/{DAY}000000.export.CSV.zip", {f"{DAY}000000.export.CSV": [event_line(1, "http://a/1")]})
    found = jobs.land_archives(spark, f"{folder}/in", f"{folder}/bronze", f"{folder}/runs")
    assert found["events"]["rows"] == 1
    assert found["gkg"] == {"rows": 0, "bad_lines": 0, "bad_archives": 0}
    log = spark.read.schema(runlog.RUNS_DDL).json(f"{folder}/runs").collect()
    assert sorted(r.kind for r in log) == ["land events", "land gkg", "pages r1"]


def test_a_run_label_used_again_with_fewer_days(spark, folder):
    later = [(u, e, g, "20190312", s, h) for u, e, g, _, s, h in PAGES]
    jobs.process_pages(spark.createDataFrame(PAGES + later, FETCHED), f"{folder}/out", "r1", f"{folder}/runs")
    jobs.process_pages(spark.createDataFrame(PAGES, FETCHED), f"{folder}/out", "r1", f"{folder}/runs")
    found = read(spark, f"{folder}/out/articles", "article_id string, ymd string")
    assert {r.ymd for r in found.collect()} == {DAY}


def test_one_run_per_article(spark):
    rows = spark.createDataFrame(
        [("d", "1", "a", "old"), ("d", "1", "b", "new"), ("d", "2", "a", "only")],
        "ymd string, article_id string, run string, text string")
    assert sorted(r.text for r in one_run(rows, ["ymd", "article_id"]).collect()) == ["new", "only"]


def stats_tree(spark, folder):
    header = "\t".join(schemas.ARTICLE_STATS.names)
    for day, domain, record in (("20200131", "http://cnn.com/", "r1"), ("20200201", "http://bbc.co.uk/", ""),
                                ("20200202", "http://other/", "r2"), ("20200203", "http://bbc.co.uk/", "r3")):
        status = 404 if record == "r3" else 200
        line = f"u\t{domain}\t5\t1\t{record}\t{status}\t{day}\tt\ts\t\tk\t"
        write(f"{folder}/tree/{day[:4]}/{day[4:6]}/{day}/x.csv.gz", f"{header}\n{line}\n")
    return f"{folder}/tree"


def test_monthly_processing(spark, folder):
    tree = stats_tree(spark, folder)
    write(f"{tree}/2020/01/20200131/.skipped.csv.gz", "x")
    jobs.process_tree(spark, tree, ".csv.gz", extracts.read_article_stats, stats.article_flags,
                      lambda df: out.write_tsv(df, f"{folder}/flags"))
    flags = spark.read.options(**extracts.STATS_READ_OPTIONS).csv(f"{folder}/flags")
    assert flags.columns == schemas.ARTICLE_FLAG_COLUMNS and flags.count() == 3
    table = extracts.read_article_stats(spark, tree, **layout.tree_options(".csv.gz"))
    jobs.monthly_whitelisted(table, ["cnn", "bbc"], f"{folder}/monthly")
    monthly = spark.read.options(**extracts.STATS_READ_OPTIONS).csv(f"{folder}/monthly")
    assert {(r.year, r.month, r.domain) for r in monthly.collect()} == {
        (2020, 1, "http://cnn.com/"), (2020, 2, "http://bbc.co.uk/")}
    records = spark.createDataFrame(
        [("r1", 20200131000000, "T", "1#France#FR", "P", "O")],
        "GKGRECORDID string, DATE bigint, Themes string, Locations string, Persons string, Organizations string")
    report = jobs.article_entity_report(table, records, ["cnn", "bbc"])
    assert sorted((r.domain, r.Themes) for r in report.collect()) == [("http://bbc.co.uk/", None), ("http://cnn.com/", "T")]
    out.write_joined_csv(report, f"{folder}/joined")
    assert spark.read.csv(f"{folder}/joined", header=True).count() == 2


def test_day_is_complete(spark):
    from newsflow.operators.manifest import parse_manifest

    urls = [(f"http://h/{DAY}{n // 4:02d}{n % 4 * 15:02d}00.export.CSV.zip",) for n in range(96)]
    found = jobs.day_is_complete(parse_manifest(spark.createDataFrame(urls, "url string")), DAY).first()
    assert (found.n_batches, found.is_complete) == (96, 1)


class FakeSession:
    """Just enough of a session for the folder rule."""

    def __init__(self, master, shared):
        self.conf = {"spark.checkpoint.dir": shared} if shared else {}
        self.sparkContext = type("Context", (), {"master": master})


def test_working_folder_follows_the_setting():
    cluster = FakeSession("spark://host", "hdfs://shared/")
    first, second = working_folder(cluster, "x"), working_folder(cluster, "x")
    assert first.startswith("hdfs://shared/newsflow/x-") and first != second
    assert "/newsflow/x-" in working_folder(FakeSession("local[2]", None), "x")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        working_folder(FakeSession("spark://host", None), "x")


def test_batch_digits_of_landed_names(spark):
    assert spark.range(1).select(batch_digits(F.lit(f"/x/{DAY}000000.gkg.csv.gz"))).first()[0] == f"{DAY}000000"
