"""Streams: incremental ingest, once-only landing, restarts, late data, batch equality."""

import re
from datetime import datetime
from pathlib import Path

import pytest
from files import entity_line, event_line, write, write_zip
from pyspark.sql import functions as F

from newsflow import schemas
from newsflow.sinks import runlog
from newsflow.sinks.tables import clear, day_runs, write_dated
from newsflow.streaming import deltas, feed, once

PYTHON_STATE = re.compile(r"InPandas|InPySpark|Python", re.IGNORECASE)
URLS = "url string, eventid bigint, gkgid string, batch string, article_id string, ymd string"


def run_ingest(spark, folder, per_trigger=192):
    lines = feed.read_feed_lines(spark, f"{folder}/in", per_trigger)
    feed.ingest_urls(lines, f"{folder}/out", f"{folder}/checkpoint", f"{folder}/runs").awaitTermination()
    return spark.read.schema(URLS).parquet(f"{folder}/out/urls")


@pytest.mark.parametrize("per_trigger", [1, 2, 192])
def test_ingest_does_not_depend_on_triggers(spark, folder, per_trigger):
    """Two days; a batch's files apart, mentions and entities alone in a micro-batch."""
    write(f"{folder}/in/20190311214500.export.CSV",
          "\n".join([event_line(1, "http://a/"), event_line(2, "http://a/"), event_line(3, "http://b/"), "bad"]) + "\n")
    write(f"{folder}/in/20190311214500.gkg.csv.gz", entity_line("20190311214500-4", "http://a/") + "\n")
    write(f"{folder}/in/20190311214500.mentions.CSV", "1\tignored\n")
    first = [("http://a/", 2, "20190311214500-4", "2", "20190311"), ("http://b/", 3, "", "3", "20190311")]

    def rows(found):
        return sorted((r.url, r.eventid, r.gkgid, r.article_id, r.ymd) for r in found.collect())

    assert rows(run_ingest(spark, folder, per_trigger)) == first
    # Nothing new: nothing changes. Then late entities, a later batch and a new day.
    assert rows(run_ingest(spark, folder, per_trigger)) == first
    write(f"{folder}/in/20190311220000.gkg.csv.gz", entity_line("20190311220000-1", "http://b/") + "\n")
    write(f"{folder}/in/20190311220000.export.CSV", event_line(5, "http://c/") + "\n")
    write(f"{folder}/in/20190312000000.export.CSV", event_line(7, "http://a/") + "\n")
    assert rows(run_ingest(spark, folder, per_trigger)) == [
        ("http://a/", 2, "20190311214500-4", "2", "20190311"), ("http://a/", 7, "", "7", "20190312"),
        ("http://b/", 3, "20190311220000-1", "3", "20190311"), ("http://c/", 5, "", "5", "20190311")]
    log = spark.read.schema(runlog.RUNS_DDL).json(f"{folder}/runs").collect()
    assert any("bad_lines: 1" in r.message for r in log)
    assert "urls: 3; distinct: 2; duplicates: 1" in {r.message for r in log if r.kind == "duplicates export"}


def test_entities_that_land_before_all_events(spark, folder):
    """A merge without rows, whose observed plan adaptive execution drops."""
    write(f"{folder}/in/20190311214500.gkg.csv.gz", entity_line("20190311214500-4", "http://a/") + "\n")
    assert run_ingest(spark, folder).count() == 0
    write(f"{folder}/in/20190311214500.export.CSV", event_line(1, "http://a/") + "\n")
    assert [(r.eventid, r.gkgid) for r in run_ingest(spark, folder).collect()] == [(1, "20190311214500-4")]
    log = spark.read.schema(runlog.RUNS_DDL).json(f"{folder}/runs").collect()
    assert sorted(r.message for r in log if r.kind.startswith("merged")) == ["rows: 0", "rows: 1"]


def test_counts_of_rows_that_a_write_leaves_out(spark, folder):
    """Nothing is left behind the shuffle, but the rows that came there are counted."""
    rows = spark.range(100).selectExpr("id", "id % 4 = 0 AS bad", "'20190311' AS ymd")

    def write_none(df):
        write_dated(df.where("id < 0 OR id + 1 < 0").dropDuplicates(["id"]), f"{folder}/none", ("ymd",))

    found = runlog.write_observed(rows, write_none, f"{folder}/runs", "none", bad=F.sum(F.col("bad").cast("int")))
    assert found == {"rows": 100, "bad": 25}


def run_deltas(spark, folder, per_trigger=192):
    lines = feed.read_feed_lines(spark, f"{folder}/in", per_trigger)
    deltas.ingest_deltas(lines, f"{folder}/deltas", f"{folder}/c2", f"{folder}/runs2").awaitTermination()
    return current(spark, folder)


def current(spark, folder, days=None):
    found = deltas.current_urls(spark, f"{folder}/deltas", days)
    return sorted((r.url, r.eventid, r.gkgid, r.batch, r.article_id, r.ymd) for r in found.collect())


@pytest.mark.parametrize("per_trigger", [1, 192])
def test_deltas_merged_on_read(spark, folder, per_trigger):
    """Equal to days merged anew, before and after a compaction, with late rows and bad lines."""
    write(f"{folder}/in/20190311214500.export.CSV",
          "\n".join([event_line(9, "http://a/"), event_line(10, "http://a/"), event_line(3, "http://b/"),
                     event_line(4, ""), "bad"]) + "\n")
    write(f"{folder}/in/20190311214500.gkg.csv.gz",
          entity_line("20190311214500-9", "http://a/") + "\n" + entity_line("20190311214500-10", "http://a/") + "\n")
    first = [("http://a/", 10, "20190311214500-10", "20190311214500", "10", "20190311"),
             ("http://b/", 3, "", "20190311214500", "3", "20190311")]
    assert run_deltas(spark, folder, per_trigger) == first
    assert run_deltas(spark, folder, per_trigger) == first
    write(f"{folder}/in/20190311120000.export.CSV", event_line(99, "http://a/") + "\n")  # late, and older
    write(f"{folder}/in/20190311220000.gkg.csv.gz", entity_line("20190311220000-1", "http://b/") + "\n")
    write(f"{folder}/in/20190312000000.export.CSV", event_line(7, "http://a/") + "\n")
    second = run_deltas(spark, folder, per_trigger)
    anew = run_ingest(spark, folder).collect()
    assert second == sorted((r.url, r.eventid, r.gkgid, r.batch, r.article_id, r.ymd) for r in anew)
    assert deltas.compact(spark, f"{folder}/deltas", least_runs=2) == ["20190311"]
    runs = day_runs(spark, f"{folder}/deltas")
    assert [r[:5] for r in runs["20190311"]] == ["base-"] and len(runs["20190312"]) == 1
    assert current(spark, folder) == second
    assert current(spark, folder, ["20190312"]) == [r for r in second if r[-1] == "20190312"]
    assert current(spark, folder, ["20200101"]) == []
    assert deltas.compact(spark, f"{folder}/deltas", least_runs=2) == []
    log = spark.read.schema(runlog.RUNS_DDL).json(f"{folder}/runs2").collect()
    assert any("bad_lines: 1" in r.message for r in log)


def test_a_compaction_that_ended_halfway(spark, folder):
    """Base and deltas side by side give the same rows, and the next compaction takes both in."""
    path, rows = f"{folder}/deltas", [("export", str(n), "http://a/", "20190311000000", "20190311") for n in (9, 10, 8)]
    for n, row in enumerate(rows):
        one = spark.createDataFrame([(*row, f"{n:012d}")], deltas.WINNERS)
        write_dated(one, path, feed.BY_RUN)
    want = current(spark, folder)
    assert [r[1] for r in want] == [10]
    base = spark.createDataFrame([(*rows[1], "base-x")], deltas.WINNERS)
    write_dated(base, path, feed.BY_RUN)
    clear(spark, f"{path}/ymd=20190311/run={0:012d}")
    assert current(spark, folder) == want
    assert deltas.compact(spark, path, least_runs=2) == ["20190311"] and current(spark, folder) == want
    assert len(day_runs(spark, path)["20190311"]) == 1


def test_a_micro_batch_does_not_touch_landed_days(spark, folder):
    """Only the partitions of its own run are written."""
    write(f"{folder}/in/20190311000000.export.CSV", event_line(1, "http://a/") + "\n")
    run_deltas(spark, folder)
    before = {f: f.stat().st_mtime_ns for f in Path(f"{folder}/deltas").rglob("*.parquet")}
    write(f"{folder}/in/20190311001500.export.CSV", event_line(2, "http://a/") + "\n")
    run_deltas(spark, folder)
    after = {f: f.stat().st_mtime_ns for f in Path(f"{folder}/deltas").rglob("*.parquet")}
    assert before.items() <= after.items() and len(after) == len(before) + 1


def test_ingest_of_archives(spark, folder):
    write_zip(f"{folder}/in/20190311214500.export.CSV.zip",
              {"20190311214500.export.CSV": [event_line(1, "http://a/")]})
    write(f"{folder}/in/20190311220000.export.CSV.zip", b"junk")
    lines = feed.read_zip_stream(spark, f"{folder}/in")
    feed.ingest_urls(lines, f"{folder}/out", f"{folder}/checkpoint", f"{folder}/runs").awaitTermination()
    assert [r.url for r in spark.read.schema(URLS).parquet(f"{folder}/out/urls").collect()] == ["http://a/"]


def test_extract_stream(spark, folder):
    write(f"{folder}/in/20190311214500.export.CSV", event_line(1, "http://a/", EventCode="025") + "\n")
    stream = feed.read_extract_stream(spark, f"{folder}/in", schemas.EVENTS)
    query = stream.select("GLOBALEVENTID", "EventCode", "batch").writeStream.trigger(availableNow=True)
    query.option("checkpointLocation", f"{folder}/c").format("parquet").start(f"{folder}/o").awaitTermination()
    assert tuple(spark.read.parquet(f"{folder}/o").first()) == (1, "025", "20190311214500")


ROWS = "k string, ymd string"
STORED = "k string, ymd string, run string"


def land(spark, folder, values, name):
    spark.createDataFrame(values, ROWS).coalesce(1).write.parquet(f"{folder}/in/{name}")
    stream = spark.readStream.schema(ROWS).option("recursiveFileLookup", "true").parquet(f"{folder}/in")
    feed.land_once(stream, f"{folder}/out", ["ymd", "k"], f"{folder}/checkpoint").awaitTermination()
    stored = spark.read.schema(STORED).parquet(f"{folder}/out")
    return sorted((int(r.run), r.ymd, r.k) for r in stored.collect())


def test_each_key_lands_once(spark, folder):
    first = land(spark, folder, [("a", "20200102"), ("b", "20200102"), ("a", "20200102")], "1")
    assert [k for _, _, k in first] == ["a", "b"]
    second = land(spark, folder, [("a", "20200102"), ("c", "20200102"), ("a", "20200103")], "2")
    assert [(d, k) for run, d, k in second if run == 1] == [("20200102", "c"), ("20200103", "a")]
    third = land(spark, folder, [("late", "20190101"), ("b", "20200102")], "3")
    assert [(d, k) for run, d, k in third if run == 2] == [("20190101", "late")]


def test_a_repeated_micro_batch_changes_nothing(spark, folder):
    feed.ensure_table(spark, f"{folder}/t", feed._with_run(spark.createDataFrame([], ROWS).schema), feed.BY_RUN)
    stored = lambda: sorted(map(tuple, spark.read.schema(STORED).parquet(f"{folder}/t").collect()))
    one = spark.createDataFrame([("a", "20200101")], ROWS)
    two = spark.createDataFrame([("a", "20200101"), ("b", "20200101")], ROWS)
    feed.land_unseen(one, 0, f"{folder}/t", ["ymd", "k"])
    feed.land_unseen(two, 1, f"{folder}/t", ["ymd", "k"])
    before = stored()
    feed.land_unseen(two, 1, f"{folder}/t", ["ymd", "k"])
    assert stored() == before == [
        ("a", "20200101", "000000000000"), ("b", "20200101", "000000000001")]


FETCHED = "url string, eventid bigint, gkgid string, ymd string, status int, html string"


def test_pages_are_processed_once(spark, folder):
    batches = [
        [("http://a/1", 1, "", "20200101", 200, "<title>one</title>"), ("http://a/2", 2, "", "20200101", 404, None)],
        [("http://a/1", 1, "", "20200101", 200, "<title>again</title>"),
         ("http://a/2", 2, "", "20200101", 200, "<title>retried</title>"),
         ("http://a/3", 3, "", "20200101", 200, "<title>three</title>"),
         ("http://a/3", 3, "", "20200101", 200, "<title>three</title>"),
         ("http://a/1", 1, "", "20200102", 200, "<title>next day</title>")],
        [("http://a/3", 3, "", "20200101", 200, "<title>late copy</title>")],
    ]
    for n, values in enumerate(batches):
        spark.createDataFrame(values, FETCHED).coalesce(1).write.parquet(f"{folder}/in/{n}")
        stream = spark.readStream.schema(FETCHED).option("recursiveFileLookup", "true").parquet(f"{folder}/in")
        feed.process_new_pages(stream, f"{folder}/out", f"{folder}/c", f"{folder}/runs").awaitTermination()
    articles = spark.read.schema("article_id string, ymd string, run string").parquet(f"{folder}/out/articles")
    assert sorted((r.ymd, r.article_id, int(r.run)) for r in articles.collect()) == [
        ("20200101", "1", 0), ("20200101", "2", 0), ("20200101", "3", 1), ("20200102", "1", 1),
    ]
    stats = spark.read.schema("title string, ymd string").parquet(f"{folder}/out/article_stats")
    assert sorted(r.title for r in stats.collect()) == ["next day", "one", "three"]


def test_state_looks_keys_up_without_python_and_forgets_them(spark, folder):
    schema = "k string, ts timestamp, ymd string"
    Path(f"{folder}/in").mkdir()
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    firsts = once.first_of_keys(stream, ["k"], "ts", 2)
    assert not PYTHON_STATE.search(firsts._jdf.queryExecution().logical().toString())

    def land(*rows):
        found = spark.createDataFrame([(k, datetime(2024, 1, day), f"2024010{day}") for k, day in rows], schema)
        found.coalesce(1).write.mode("append").parquet(f"{folder}/in")
        once.land_first(stream, f"{folder}/out", ["k"], "ts", f"{folder}/c", 2).awaitTermination()
        landed = spark.read.schema(f"{schema}, run string").parquet(f"{folder}/out")
        return sorted((r.k or "", r.ts.day) for r in landed.collect())

    first = [("", 1), ("a", 1), ("b", 2)]
    assert land(("a", 1), ("a", 1), ("b", 2), (None, 1), (None, 1)) == first
    assert land(("a", 2), ("b", 2), (None, 2)) == first  # after a restart
    land(("c", 8))  # two days after their time a and b are forgotten
    assert land(("a", 8), ("b", 1), ("c", 9)) == [*first[:2], ("a", 8), ("b", 2), ("c", 8)]


def test_the_watermark_variant_drops_late_rows(spark, folder):
    schema = "k string, ts timestamp"
    batches = [[("a", datetime(2020, 1, 1)), ("a", datetime(2020, 1, 1, 1))],
               [("b", datetime(2020, 1, 9))], [("late", datetime(2020, 1, 2)), ("c", datetime(2020, 1, 9))]]
    for n, values in enumerate(batches):
        spark.createDataFrame(values, schema).coalesce(1).write.parquet(f"{folder}/in/{n}")
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(f"{folder}/in")
        once = feed.once_within_watermark(stream, ["k"], "ts", "1 day")
        writer = once.writeStream.format("parquet").option("checkpointLocation", f"{folder}/c")
        writer.trigger(availableNow=True).start(f"{folder}/out").awaitTermination()
    found = sorted(r.k for r in spark.read.schema(schema).parquet(f"{folder}/out").collect())
    assert found == ["a", "b", "c"]


def test_slot_counts_of_a_stream_equal_the_batch(spark, folder):
    schema = "ts timestamp, kind string"
    values = [(datetime(2020, 1, 1, h, m), k) for h in range(3) for m in (0, 14, 15, 59) for k in "ab"]
    rows = spark.createDataFrame(values, schema)
    rows.repartition(4).write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    counts = feed.slot_counts(stream, "ts", "kind")
    feed.upsert_counts(counts, f"{folder}/out", f"{folder}/c").awaitTermination()
    stored = spark.read.schema("slot_start timestamp, kind string, n bigint, run string").parquet(f"{folder}/out")
    found = feed.latest_counts(stored, ["slot_start", "kind"])
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, feed.slot_counts(rows, "ts", "kind").collect()))
    assert stored.count() >= found.count() == 18


def test_ntz_timestamps_cannot_take_a_watermark(spark, folder):
    spark.range(1).select(F.lit("2020-01-01").cast("timestamp_ntz").alias("ts")).write.parquet(f"{folder}/in")
    stream = spark.readStream.schema("ts timestamp_ntz").parquet(f"{folder}/in")
    with pytest.raises(Exception, match="EVENT_TIME_IS_NOT_ON_TIMESTAMP_TYPE"):
        feed.slot_counts(stream, "ts").schema
