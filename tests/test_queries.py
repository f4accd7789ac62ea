"""Registered queries against their SQL, and plan checks."""

import os
import re
import subprocess
import sys
from pathlib import Path

import pytest
from compare import connect, differences

import __spark_entry__ as entry_module
from newsflow.plans.oracles import ORACLES
from newsflow.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_but_the_body_text_has_sql():
    assert set(QUERIES) - set(ORACLES) == {"page_text"}
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    assert differences(QUERIES[name](spark, SF_DIR), duck, ORACLES[name]) == []


def test_page_text(spark):
    found = QUERIES["page_text"](spark, SF_DIR).toPandas()
    assert len(found) == 250
    fetched = found[found.text != ""]
    assert len(fetched) > 200
    assert not fetched.text.str.contains("margin:0|track\\(", regex=True).any()


def test_stream_pages_of_a_table_of_many_files(spark, folder):
    """The table may be a folder of part files, next to others that are not read."""
    rows = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    rows.repartition(3).write.parquet(f"{folder}/pages.parquet")
    rows.limit(1).selectExpr("page_id AS doc_id").write.parquet(f"{folder}/my_pages.parquet")
    one_file, many = (sorted(map(repr, QUERIES["stream_pages"](spark, d).collect())) for d in (SF_DIR, folder))
    assert one_file and many == one_file


def test_entry(spark):
    found = entry_module.entry(spark)
    assert found.columns[:4] == ["year", "month", "day", "domain"] and found.count() > 0


def test_queries_run_from_any_folder(tmp_path):
    """Python workers import the package although it is not on their path."""
    script = tmp_path / "run.py"
    root = Path(__file__).parents[1]
    script.write_text(
        f"import sys; sys.path.insert(0, {str(root)!r})\n"
        "from newsflow.plans.session import local_session\n"
        "from newsflow.plans.queries import QUERIES\n"
        "print(QUERIES['page_title'](local_session('2'), '/root/testdata/sf0.001').count())\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run(
        [sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300
    )
    assert run.stdout.split()[-1:] == ["50"], run.stderr[-2000:]


def plan(spark, name):
    return QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


PYTHON = re.compile(r"ArrowEvalPython|MapInPandas|MapInArrow|BatchEvalPython|FlatMapGroups")
PAGE_QUERIES = {
    "absolute_links", "page_links", "page_domain_counts", "page_title", "page_meta", "page_stats", "page_text"
}
AUTOMATON_QUERIES = {"whitelist_from_file", "whitelist_of_any_length"}
# Plans that only read back what a job or a stream wrote; the Python ran before.
WRITTEN_BEFORE = {
    "backfilled_day", "page_job", "rebuilt_domains", "roundtrip_bulk", "roundtrip_csv", "roundtrip_events", "roundtrip_feed",
    "roundtrip_json", "roundtrip_text", "roundtrip_tsv", "stream_dedup", "stream_dedup_state", "stream_dedup_watermark",
    "stream_ingest", "stream_ingest_deltas", "stream_pages", "stream_window_counts",
}


def test_python_runs_only_for_pages_archives_and_automata(spark):
    light = set(QUERIES) - WRITTEN_BEFORE
    expected = PAGE_QUERIES | AUTOMATON_QUERIES | {"roundtrip_zip"}
    assert {n for n in light if PYTHON.search(plan(spark, n))} == expected


def test_pairs_bucketed_by_url_merge_without_a_shuffle(spark):
    before = {t.name for t in spark.catalog.listTables()}
    found = QUERIES["url_ids_merge_bucketed"](spark, SF_DIR)
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in text and "Exchange rangepartitioning" not in text
    assert text.count("Bucketed: true") == 2
    assert {t.name for t in spark.catalog.listTables()} == before


def test_pages_are_parsed_once(spark):
    assert plan(spark, "page_stats").count("ArrowEvalPython") == 1


def test_semi_join_is_broadcast_when_small(spark):
    assert "BroadcastHashJoin" in plan(spark, "id_semi_join") and "LeftSemi" in plan(spark, "id_semi_join")


def test_last_event_uses_hash_aggregation(spark):
    text = plan(spark, "url_ids_merge")
    assert "HashAggregate(keys=[url" in text and "partial_max_by" in text


def test_daily_stats_shuffle_partial_counts_once(spark):
    text = plan(spark, "daily_domain_stats")
    assert text.count("Exchange hashpartitioning") == 1 and "partial_count" in text


def test_filters_reach_the_scan_below_the_parser(spark):
    text = plan(spark, "page_stats")
    assert text.index("ArrowEvalPython") < text.index("Filter NOT")


def test_no_cross_joins(spark):
    for name in ("article_gkg_join", "batch_grid", "missing_slots", "search_docs", "url_ids_merge_outer"):
        assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", plan(spark, name))


def test_dates_are_pruned(spark):
    assert "PartitionFilters: [isnotnull(ymd" in plan(spark, "date_range_prune")


def test_adaptive_execution_splits_a_hot_key(spark):
    """A record id with a third of the articles: the shuffled join splits it over tasks."""
    from newsflow.operators.entities import article_entities

    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        articles = spark.range(0, 60_000, 1, 8).selectExpr(
            "id AS eventid", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 THEN '' ELSE cast(id AS string) END AS gkgid",
            "sha2(cast(id AS string), 256) AS domain")
        records = spark.range(0, 2_000).selectExpr(
            "CASE WHEN id = 0 THEN 'hot' ELSE cast(id * 30 + 2 AS string) END AS gkgid", "id AS Themes")
        joined = article_entities(articles, records)
        assert len(joined.collect()) == 60_000
        final = joined._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in final
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
