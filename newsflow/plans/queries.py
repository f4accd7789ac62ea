"""Registered queries: each runs an operator over the given tables.

Queries that need files or streams work in a fresh folder below ``spark.checkpoint.dir``.
"""

import io
import zipfile
from collections.abc import Callable, Iterator
from functools import wraps

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from newsflow import schemas
from newsflow.functions import dates, html, text as texts, urls
from newsflow.operators import docs, entities, filters, manifest, merge, pages, sketches, stats
from newsflow.plans import inputs, jobs
from newsflow.plans.inputs import table, text
from newsflow.plans.session import ship_package, working_folder
from newsflow.sinks import files, runlog, search
from newsflow.sinks.tables import add_partitions, read_bucketed, write_bucketed, write_dated
from newsflow.sources import archives, extracts, layout, lists
from newsflow.streaming import deltas, feed, once

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

WHITELIST = ["example.org", "cheap-pills"]
EVENT_WHITELIST = ["click", "pu.chase", "err"]


def query(fn: Query) -> Query:
    """Register a query under its function name."""

    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


# --- statistics ------------------------------------------------------------------------


@query
def daily_domain_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.daily_domain_stats(inputs.event_stats(spark, sf_dir))


@query
def article_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.article_flags(inputs.document_stats(spark, sf_dir))


@query
def domain_whitelist(spark: SparkSession, sf_dir: str) -> DataFrame:
    sites = table(spark, sf_dir, "pages").select(
        "page_id", urls.base_domain(F.col("url")).alias("domain")
    )
    return sites.where(stats.whitelist_match(F.col("domain"), WHITELIST))


@query
def whitelist_from_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whitelist is a file: one line per event type, read back as a table."""
    path = working_folder(spark, "whitelist_from_file")
    kinds = table(spark, sf_dir, "events").where("event_type <> 'view'").select("event_type").distinct()
    kinds.select(text(" ", F.substring("event_type", 1, 4), "  ").alias("value")).write.text(path)
    found = stats.whitelisted_by(inputs.event_stats(spark, sf_dir), lists.read_whitelist(spark, path))
    return found.select("url", "domain", "eventid")


@query
def whitelist_of_any_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sites of customers against a list with one line per customer with an urgent order.

    A dot of a line stands for the mark in the customer's name.
    """
    sites = table(spark, sf_dir, "customer").select(
        "c_custkey", text("www.", F.lower("c_name"), ".", F.lower("c_mktsegment"), ".example").alias("domain")
    )
    urgent = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'")
    plain = urgent.select(text("customer.", F.lpad(F.col("o_custkey").cast("string"), 9, "0")).alias("line"))
    patterns = spark.createDataFrame([("0{4}[12]99\\.b",), ("(?i)MACH.*00077",)], "line string")
    return stats.whitelisted_by(sites, plain.unionByName(patterns))


@query
def domain_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.domain_rollup(inputs.event_stats(spark, sf_dir))


@query
def whitelisted_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.whitelisted_articles(inputs.event_stats(spark, sf_dir), EVENT_WHITELIST)


@query
def whitelisted_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The id list goes through its file: written, then read back as a distinct list."""
    path = working_folder(spark, "whitelisted_ids")
    ids = stats.whitelisted_ids(inputs.event_stats(spark, sf_dir), EVENT_WHITELIST)
    files.write_tsv(ids, path)
    return lists.read_id_list(spark, path)


@query
def monthly_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitelisted articles written to one directory per month, read back."""
    path = working_folder(spark, "monthly_articles")
    jobs.monthly_whitelisted(inputs.event_stats(spark, sf_dir), EVENT_WHITELIST, path)
    schema = f"{schemas.ARTICLE_STATS_DDL}, day int, year int, month int"
    stored = spark.read.options(**extracts.STATS_READ_OPTIONS).schema(schema).csv(path)
    return stored.select(
        "url", "eventid", "gkgid", "keywords", "description", "year", "month", "day"
    )


@query
def run_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    fetched = inputs.fetched_pages(spark, sf_dir)
    return stats.run_totals(fetched.withColumn("nbytes", F.char_length("html")))


@query
def duplicate_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return merge.duplicate_counts(documents, "text", "source", digest=True)


@query
def url_duplicate_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, events = inputs.customer_pairs(spark, sf_dir)
    both = orders.select("url", F.lit("events").alias("feed")).unionByName(
        events.select("url", F.lit("gkg").alias("feed"))
    )
    return merge.duplicate_counts(both, "url", "feed")


@query
def sketched_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct users per event type over all days: exact, and whether the merged sketches of
    the days come within five standard deviations (and one) of it."""
    path = working_folder(spark, "sketched_duplicates")
    rows = table(spark, sf_dir, "events").select("event_type", "user_id", F.date_format("ts", "yyyyMMdd").alias("ymd"))
    write_dated(sketches.daily_sketches(rows, "user_id", "event_type"), path, ("ymd",))
    kept = spark.read.schema("event_type string, n_rows bigint, sketch binary, ymd string").parquet(path)
    exact = merge.duplicate_counts(rows, "user_id", "event_type")
    merged = sketches.merged_counts(kept, "event_type").select(
        "event_type", F.col("n_rows").alias("kept_rows"), F.col("n_distinct").alias("estimate")
    )
    bound = 1 + 5 * F.col("n_distinct") / F.sqrt(F.lit(float(2**sketches.LG_ENTRIES)))
    return exact.join(merged, "event_type").select(
        "event_type", "n_rows", "n_distinct", "n_duplicates", "kept_rows",
        (F.abs(F.col("estimate") - F.col("n_distinct")) <= bound).alias("within"),
    )


@query
def unseen_by_day_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of (user, day) pairs without an error, against error events landed by day with a filter each."""
    path = working_folder(spark, "unseen_by_day_filters")
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", F.date_format("ts", "yyyyMMdd").alias("ymd"))
    write_dated(rows.where("event_type = 'error'"), f"{path}/landed", ("ymd",))
    landed = spark.read.schema(rows.schema).parquet(f"{path}/landed")
    filters.write_filters(landed, f"{path}/filters", ["user_id", "ymd"])
    made = spark.read.schema(filters.FILTERS).parquet(f"{path}/filters")
    new = rows.where("event_type <> 'error'")
    return filters.unseen_by_filters(spark, new, f"{path}/landed", rows.schema, made, ["user_id", "ymd"], f"{path}/probed")


# --- scalar functions ------------------------------------------------------------------


@query
def url_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select(
        "page_id", urls.base_domain(F.col("url")).alias("domain")
    )


@query
def url_basename(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select(
        "page_id", urls.base_name(F.col("url")).alias("name")
    )


@query
def article_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("doc_id").alias("eventid"))
    joined = documents.join(labels, "doc_id", "left")
    return joined.select(
        "doc_id",
        urls.article_key(F.col("eventid"), F.col("doc_id").cast("string")).alias("article_id"),
    )


@query
def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    spaced = F.concat("text", F.lit(" \t"), "source")
    cleaned = texts.clean_text(texts.plain_spaces(spaced))
    return table(spark, sf_dir, "documents").select("doc_id", cleaned.alias("text"))


@query
def escape_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id", texts.unicode_escape(F.col("text")).alias("title")
    )


@query
def null_to_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = texts.null_to_empty(inputs.document_stats(spark, sf_dir))
    return filled.select("url", "author", "keywords", "description")


@query
def locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.customer_records(spark, sf_dir).select(
        F.col("GKGRECORDID").alias("gkgid"),
        texts.readable_locations(F.col("Locations")).alias("locations"),
    )


@query
def date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = dates.strict_date(F.date_format("o_orderdate", "yyyyMMdd"))
    year, month, ymd = dates.partition_columns(day)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        *dates.date_parts(day),
        dates.month_label(F.month(day)).alias("month_label"),
        year.alias("year_label"),
        ymd.alias("ymd"),
    )


@query
def valid_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamp = F.lit(19980000000000) + F.pmod("o_custkey", F.lit(1400)) * 1000000
    dated = table(spark, sf_dir, "orders").select(
        "o_orderkey", dates.lenient_date(stamp).alias("day")
    )
    valid = dated.where(F.col("day").isNotNull())
    return valid.select("o_orderkey", *dates.date_parts(F.col("day")))


@query
def batch_of_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = text("http://feed.example/v2/", dates.batch_label(F.col("ts")), ".export.CSV.zip")
    named = table(spark, sf_dir, "events").select("event_id", name.alias("name"))
    digits = dates.batch_digits(F.col("name"))
    return named.select(
        "event_id",
        digits.alias("batch"),
        dates.batch_ts(digits).alias("batch_ts"),
        F.substring(digits, 1, 8).alias("ymd"),
    )


# --- merges and joins ------------------------------------------------------------------


@query
def url_ids_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.merge_url_ids(*inputs.customer_pairs(spark, sf_dir))


@query
def url_ids_merge_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from pairs that landed bucketed by URL, in two parts: no shuffle is left."""
    path, buckets, landed = working_folder(spark, "url_ids_merge_bucketed"), 16, []
    for n, rows in enumerate(inputs.customer_pairs(spark, sf_dir)):
        first = F.xxhash64("id") % 2 == 0
        write_bucketed(rows.where(first), f"{path}/{n}", "url", buckets)
        write_bucketed(rows.where(~first), f"{path}/{n}", "url", buckets, "append")
        landed.append(read_bucketed(spark, f"{path}/{n}", rows.schema, "url", buckets))
    return merge.merge_url_ids(*landed)


@query
def url_ids_merge_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The roles of the two tables swapped, and URLs of both sides kept."""
    orders, events = inputs.customer_pairs(spark, sf_dir)
    number = F.substring_index("id", "-", -1).cast("bigint")
    return merge.merge_url_ids(
        events.withColumn("id", number),
        orders.withColumn("id", text(F.col("batch"), "-", F.col("id"))),
        how="outer",
    )


def _flagged_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.article_flags(inputs.event_stats(spark, sf_dir))


@query
def article_gkg_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = entities.process_entities(inputs.customer_records(spark, sf_dir))
    return entities.article_entities(_flagged_events(spark, sf_dir), records)


@query
def article_gkg_join_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = entities.process_entities(inputs.customer_records(spark, sf_dir))
    return entities.article_entities(_flagged_events(spark, sf_dir), records, "inner")


@query
def article_gkg_join_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = entities.process_entities(inputs.customer_records(spark, sf_dir))
    return entities.article_entities(_flagged_events(spark, sf_dir), records, hot_share=0.001)


@query
def article_entity_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.article_entity_report(
        inputs.event_stats(spark, sf_dir), inputs.customer_records(spark, sf_dir), EVENT_WHITELIST
    )


@query
def gkg_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entities.process_entities(inputs.customer_records(spark, sf_dir))


@query
def id_semi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = table(spark, sf_dir, "labels").where("quality = 1")
    ids = good.select(text("c-", F.col("doc_id")).alias("gkgid"))
    return stats.articles_for_ids(inputs.event_stats(spark, sf_dir), ids)


@query
def unseen_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    return docs.unseen(documents, table(spark, sf_dir, "labels"), ["doc_id"])


@query
def search_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs.search_docs(
        inputs.document_stats(spark, sf_dir), inputs.document_articles(spark, sf_dir)
    )


# --- file lists ------------------------------------------------------------------------


def _days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(F.to_date("ts").alias("day")).distinct()


@query
def batch_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.expected_slots(_days(spark, sf_dir), inputs.FEED_BASE)


@query
def missing_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected = manifest.expected_slots(_days(spark, sf_dir), inputs.FEED_BASE)
    landed = manifest.parse_manifest(inputs.event_manifest(spark, sf_dir))
    return manifest.missing_slots(expected, landed).select("batch", "kind", "url")


@query
def missing_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected = manifest.expected_slots(_days(spark, sf_dir), inputs.FEED_BASE)
    landed = manifest.parse_manifest(inputs.event_manifest(spark, sf_dir))
    return manifest.missing_runs(expected, landed)


@query
def day_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = manifest.parse_manifest(inputs.event_manifest(spark, sf_dir))
    return manifest.completeness(landed, above=70)


@query
def manifest_by_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.files_by_kind(manifest.parse_manifest(inputs.event_manifest(spark, sf_dir)))


@query
def manifest_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = manifest.parse_manifest(inputs.event_manifest(spark, sf_dir))
    by_date = manifest.files_by_date(manifest.without_mentions(landed))
    return by_date.select("ymd", F.array_join("urls", " ").alias("urls"))


@query
def manifest_urls_by_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.urls_by_kind(manifest.parse_manifest(inputs.event_manifest(spark, sf_dir)))


@query
def first_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = manifest.parse_manifest(inputs.event_manifest(spark, sf_dir))
    return layout.first_files(landed.select("kind", "ymd", "name"))


@query
def complete_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Completeness with the threshold of the feed job, over the whole grid and what landed."""
    landed = manifest.parse_manifest(inputs.event_manifest(spark, sf_dir)).select("ymd", "kind", "batch")
    grid = manifest.expected_slots(_days(spark, sf_dir), inputs.FEED_BASE).where("kind = 'gkg'")
    return manifest.completeness(landed.unionByName(grid.select("ymd", "kind", "batch")))


@query
def manifest_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = manifest.parse_manifest(inputs.event_manifest(spark, sf_dir))
    return manifest.for_date(manifest.without_mentions(landed), "20240115").drop("batch_ts")


@query
def first_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.first_batch(manifest.parse_manifest(inputs.event_manifest(spark, sf_dir)))


# --- pages -----------------------------------------------------------------------------


def _link_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = table(spark, sf_dir, "pages").select(
        F.col("page_id").cast("string").alias("article_id"),
        F.lit("20240101").alias("ymd"),
        "url",
        html.page_parser("links")(F.col("html")).alias("page"),
    )
    return parsed.select("article_id", "ymd", "url", F.col("page.links").alias("links"))


def _page_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = table(spark, sf_dir, "pages").select(
        "page_id", html.page_parser("meta")(F.col("html")).alias("page")
    )
    return parsed.select("page_id", pages.page_meta(F.col("page.meta")).alias("meta"))


@query
def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = _link_lists(spark, sf_dir).withColumn(
        "links", pages.page_links(F.col("links"), absolute_only=False)
    )
    return pages.link_rows(kept)


@query
def absolute_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Root-relative links resolved against their page's site; then all are absolute."""
    resolved = pages.with_site_links(_link_lists(spark, sf_dir))
    kept = resolved.withColumn("links", pages.page_links(F.col("links"), absolute_only=True))
    return pages.link_rows(kept)


@query
def page_domain_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.domain_count_rows(pages.with_site_links(_link_lists(spark, sf_dir)))


@query
def rebuilt_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Domain counts rebuilt from a stored links table, for a range of days."""
    path = working_folder(spark, "rebuilt_domains")
    lists_of_links = pages.with_site_links(_link_lists(spark, sf_dir)).drop("url")
    files.write_links(lists_of_links, f"{path}/links")
    article_stats = inputs.fetched_pages(spark, sf_dir).withColumnRenamed("ymd", "accessdate")
    schema = T.StructType.fromDDL("article_id string, links array<string>, ymd string")
    stored = layout.in_range(spark.read.schema(schema).parquet(f"{path}/links"), "20240101")
    rebuilt = pages.rebuild_domains(article_stats, stored)
    return rebuilt.select(
        "article_id", "url", "basedomain", F.explode_outer("domains").alias("domain", "n_links")
    )


@query
def page_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _page_meta(spark, sf_dir).select(
        "page_id", pages.page_fields(F.col("meta"))["title"].alias("title")
    )


@query
def page_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = _page_meta(spark, sf_dir).select("page_id", F.explode("meta").alias("grp", "pairs"))
    return groups.select("page_id", "grp", F.explode("pairs").alias("key", "value"))


@query
def page_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.article_stats(pages.parse_pages(inputs.fetched_pages(spark, sf_dir)))


@query
def page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.articles(pages.parse_pages(inputs.fetched_pages(spark, sf_dir)))


@query
def page_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole page job: parse once, write five tables, read three of them back."""
    path = working_folder(spark, "page_job")
    jobs.process_pages(inputs.fetched_pages(spark, sf_dir), path, "r1", f"{path}/runs", False)

    def stored(name: str, columns: str) -> DataFrame:
        schema = f"article_id string, {columns} ymd string, run string"
        return spark.read.schema(schema).parquet(f"{path}/{name}")

    keys = ["article_id", "ymd", "run"]
    texts_and_links = stored("articles", "").join(
        stored("page_links", "links array<string>,"), keys, "left"
    )
    metas = stored("html_meta", f"meta {schemas.HTML_META_DDL},")
    joined = texts_and_links.join(metas, keys, "left")
    n_links = F.when(F.col("links").isNull(), 0).otherwise(F.size("links")).cast("bigint")
    return joined.select(
        "article_id",
        n_links.alias("n_links"),
        F.col("meta")["meta"]["charset"].alias("charset"),
    )


# --- tables and files ------------------------------------------------------------------


@query
def date_range_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table laid out by day, read for a range of days."""
    path = working_folder(spark, "date_range_prune")
    events = table(spark, sf_dir, "events").withColumn("ymd", F.date_format("ts", "yyyyMMdd"))
    write_dated(add_partitions(events.select("event_id", "event_type", "ymd")), path)
    schema = "event_id bigint, event_type string, year string, month string, ymd string"
    return layout.in_range(spark.read.schema(schema).parquet(path), "20240110", "20240119")


@query
def partition_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days of a listed tree. The tree is hive-style here, so the day comes from ``ymd=``."""
    path = working_folder(spark, "partition_dates")
    events = table(spark, sf_dir, "events").withColumn("ymd", F.date_format("ts", "yyyyMMdd"))
    write_dated(events.select("event_id", "ymd"), path, ("ymd",))
    listed = layout.list_files(spark, path, ".parquet")
    return listed.select(F.regexp_extract("path", r"ymd=(\d{8})", 1).alias("ymd")).distinct()


@query
def roundtrip_tsv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = working_folder(spark, "roundtrip_tsv")
    files.write_article_stats(inputs.document_stats(spark, sf_dir), path)
    return extracts.read_article_stats(spark, path)


@query
def roundtrip_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entity records written in feed format with all 27 columns, read back and processed."""
    path = working_folder(spark, "roundtrip_feed")
    records = inputs.customer_records(spark, sf_dir)
    files.write_feed(_all_columns(records, schemas.ENTITIES), path)
    return entities.process_entities(extracts.read_entities(spark, path))


def _all_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


def _event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("GLOBALEVENTID"),
        F.date_format("ts", "yyyyMMdd").cast("int").alias("SQLDATE"),
        F.col("event_type").alias("EventCode"),
        F.col("value").alias("AvgTone"),
        inputs.event_url().alias("SOURCEURL"),
    )
    whole = _all_columns(events, schemas.EVENTS)
    return whole.select(
        F.col("SQLDATE").cast("string").alias("ymd"),
        F.to_csv(F.struct(*whole.columns), {"sep": "\t", "emptyValue": ""}).alias("line"),
    )


def _entity_lines(spark: SparkSession, events: DataFrame) -> DataFrame:
    """An entity line per event, in the first batch of its day: ``(kind, batch, line)``."""
    batch = text(F.date_format("ts", "yyyyMMdd"), "000000")
    records = events.select(
        text(batch, "-", F.col("event_id")).alias("GKGRECORDID"),
        inputs.event_url().alias("DocumentIdentifier"),
    )
    whole = _all_columns(records, schemas.ENTITIES)
    return whole.select(
        F.lit("gkg").alias("kind"),
        F.substring("GKGRECORDID", 1, 14).alias("batch"),
        F.to_csv(F.struct(*whole.columns), {"sep": "\t", "emptyValue": ""}).alias("line"),
    )


@query
def roundtrip_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event extracts in feed format, landed as Parquet by day, read back."""
    path = working_folder(spark, "roundtrip_events")
    _event_lines(spark, sf_dir).select("line").write.text(f"{path}/raw", compression="gzip")
    events = extracts.read_events(spark, f"{path}/raw").where(F.col(schemas.CORRUPT).isNull())
    dated = events.withColumn("ymd", F.col("SQLDATE").cast("string"))
    write_dated(dated, f"{path}/events", ("ymd",))
    stored = spark.read.parquet(f"{path}/events")
    return stored.select("GLOBALEVENTID", "SQLDATE", "EventCode", "AvgTone", "SOURCEURL")


@query
def extract_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Id and URL pairs of many event files, one per batch, merged without entity records."""
    path = working_folder(spark, "extract_pairs")
    lines = _event_lines(spark, sf_dir)
    lines.select("line", text(F.col("ymd"), "000000").alias("batch")).write.partitionBy("batch").text(path)
    events = extracts.read_events(spark, path, recursiveFileLookup="true")
    ids = extracts.event_pairs(events).select("id", "url")
    return ids.where(F.col("url").isNotNull()).select(F.col("id").alias("eventid"), "url")


@query
def entity_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Id, URL and batch of entity files, one per day of ``events``; the batch is in the name."""
    path = working_folder(spark, "entity_pairs")
    lines = _entity_lines(spark, table(spark, sf_dir, "events"))
    lines.select(F.col("line").alias("value"), "batch").write.partitionBy("batch").text(path)
    records = extracts.read_entities(spark, path, recursiveFileLookup="true")
    # Spark names its files itself, so the batch is told by the id here.
    return extracts.entity_pairs(records).select("id", "url", F.substring("id", 1, 14).alias("batch"))


@query
def processed_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user transform over every statistics file of a tree, its result written and read back."""
    path = working_folder(spark, "processed_tree")
    rows = inputs.event_stats(spark, sf_dir)
    dated = rows.withColumn("day", F.col("accessdate"))
    dated.write.partitionBy("day").options(**extracts.STATS_OPTIONS).csv(f"{path}/in")
    jobs.process_tree(
        spark, f"{path}/in", ".csv", extracts.read_article_stats, stats.daily_domain_stats,
        lambda found: found.write.parquet(f"{path}/out"),
    )
    return spark.read.parquet(f"{path}/out")


@query
def backfilled_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day processed by a run, then backfilled twice: one row per article is left."""
    path, day = working_folder(spark, "backfilled_day"), "20240101"
    fetched = inputs.fetched_pages(spark, sf_dir)
    jobs.process_pages(fetched, path, "r1", f"{path}/runs")
    named = fetched.select(
        F.col("eventid").alias("GLOBALEVENTID"), F.col("gkgid").alias("GKGRECORDID"), F.col("url").alias("SOURCEURL"),
        F.col("url").alias("DocumentIdentifier"), F.lit(f"{day}000000").alias("batch"), "ymd",
    )
    pages_of_day = fetched.select("url", "ymd", "status", "html", "eventid")
    # A URL that was fetched more than once has the page of its last event.
    last = pages_of_day.groupBy("url").agg(F.max("eventid").alias("eventid"))
    once_fetched = pages_of_day.join(last, ["url", "eventid"], "left_semi").drop("eventid")
    for _ in range(2):
        jobs.backfill_day(named, named, once_fetched, path, f"{path}/runs", day)
    stored = spark.read.schema(schemas.ARTICLE_STATS).parquet(f"{path}/article_stats")
    return stored.select(*schemas.ARTICLE_STATS.names)


@query
def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the page job logs of its run."""
    path = working_folder(spark, "run_log")
    jobs.process_pages(inputs.fetched_pages(spark, sf_dir), f"{path}/out", "r1", f"{path}/runs")
    return spark.read.schema(runlog.RUNS_DDL).json(f"{path}/runs").select("kind", "message")


@query
def article_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts written as one table by day and read back."""
    path = working_folder(spark, "article_texts")
    day = F.substring("source", 4, 9).cast("int") + 1
    rows = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("article_id"),
        text("202401", F.lpad(day.cast("string"), 2, "0")).alias("ymd"),
        "text",
    )
    files.write_articles(rows, path)
    return spark.read.schema("article_id string, text string, ymd string").parquet(path)


@query
def roundtrip_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event lines packed into zip archives inside tasks, unpacked and parsed again."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for ymd, lines in batch.groupby("ymd")["line"]:
                name, buffer = f"{ymd}000000.export.CSV", io.BytesIO()
                with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
                    archive.writestr(name, "\n".join(lines) + "\n")
                yield pd.DataFrame({"path": [f"{name}.zip"], "content": [buffer.getvalue()]})

    packed = _event_lines(spark, sf_dir).mapInPandas(pack, "path string, content binary")
    lines = archives.unzip_lines(packed).where(F.col("error").isNull())
    parsed = extracts.parse_lines(lines, "line", schemas.EVENTS, "file_name")
    return parsed.select(
        dates.batch_digits(F.col("file_name")).alias("batch"),
        "GLOBALEVENTID",
        "EventCode",
        "SOURCEURL",
    )


@query
def roundtrip_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-page domain counts as JSON objects with a map, written and read back."""
    path = working_folder(spark, "roundtrip_json")
    counted = pages.with_site_links(_link_lists(spark, sf_dir)).select(
        "url",
        urls.base_domain(F.col("url")).alias("basedomain"),
        pages.domain_counts(F.col("links")).alias("domains"),
    )
    files.write_json(counted, path)
    stored = spark.read.schema(schemas.PAGE_DOMAINS_DDL).json(path)
    return stored.select(
        "url", "basedomain", F.explode_outer("domains").alias("domain", "n_links")
    )


@query
def roundtrip_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A gzip file list written and read back as URLs."""
    path = working_folder(spark, "roundtrip_text")
    files.write_file_list(inputs.event_manifest(spark, sf_dir), path)
    return lists.read_file_list(spark, path)


@query
def roundtrip_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The article x entity join as comma-separated text, read back."""
    path = working_folder(spark, "roundtrip_csv")
    files.write_joined_csv(article_gkg_join(spark, sf_dir), path)
    ddl = (
        "domain string, eventid bigint, gkgid string, year int, month int, day int, "
        "hasKeywords int, hasDescription int, Themes string, Persons string, "
        "Organizations string, Locations string, gkg_year int, gkg_month int, gkg_day int"
    )
    stored = spark.read.schema(ddl).csv(path, header=True, escape='"')
    return stored.select(
        "eventid", "gkgid", "Persons", "Locations", "gkg_year", "gkg_month", "gkg_day"
    )


@query
def roundtrip_bulk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bulk search files read back: index and id of each action with its document's eight fields."""
    path = working_folder(spark, "roundtrip_bulk")
    search.write_bulk(search_docs(spark, sf_dir), path, "articles")
    return search.read_bulk(spark, path)


# --- streams ---------------------------------------------------------------------------


def _event_files(spark: SparkSession, sf_dir: str, path: str, n_files: int) -> DataFrame:
    """A stream over a copy of ``events``; watermarks need zoned timestamps."""
    events = table(spark, sf_dir, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type"
    )
    # Several files, so that the stream takes several micro-batches.
    events.repartitionByRange(n_files, "ts").write.parquet(path)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", "2").parquet(path)
    return stream.withColumn("ymd", F.date_format("ts", "yyyyMMdd"))


@query
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each (day, user) landed once over several micro-batches, by anti-join."""
    path = working_folder(spark, "stream_dedup")
    rows = _event_files(spark, sf_dir, f"{path}/in", 4).select("ymd", "user_id")
    keys = ["ymd", "user_id"]
    feed.land_once(rows, f"{path}/out", keys, f"{path}/checkpoint").awaitTermination()
    schema = "user_id bigint, ymd string, run string"
    return spark.read.schema(schema).parquet(f"{path}/out").select("ymd", "user_id")


@query
def stream_dedup_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each (day, user) landed once by state; all rows come a second time after a restart."""
    path = working_folder(spark, "stream_dedup_state")
    rows = _event_files(spark, sf_dir, f"{path}/in", 4)
    keys = ["ymd", "user_id"]
    once.land_first(rows.select("ts", *keys), f"{path}/out", keys, "ts", f"{path}/checkpoint", 60).awaitTermination()
    again = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type")
    again.write.mode("append").parquet(f"{path}/in")
    once.land_first(rows.select("ts", *keys), f"{path}/out", keys, "ts", f"{path}/checkpoint", 60).awaitTermination()
    schema = "user_id bigint, ymd string, run string"
    return spark.read.schema(schema).parquet(f"{path}/out").select("ymd", "user_id")


@query
def stream_dedup_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each (day, user) once, with state bounded by a watermark longer than the data."""
    path = working_folder(spark, "stream_dedup_watermark")
    rows = _event_files(spark, sf_dir, f"{path}/in", 4)
    once = feed.once_within_watermark(rows, ["ymd", "user_id"], "ts", "60 days")
    writer = once.select("ymd", "user_id").writeStream.format("parquet").outputMode("append")
    writer = writer.option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True)
    writer.start(f"{path}/out").awaitTermination()
    return spark.read.schema("ymd string, user_id bigint").parquet(f"{path}/out")


@query
def stream_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page job on a stream of fetched pages, once per article."""
    path = working_folder(spark, "stream_pages")
    stream = spark.readStream.schema(table(spark, sf_dir, "pages").schema)
    # A pattern, as a stream takes a plain path for a folder; the table may be one or a file.
    rows = inputs.as_fetched(stream.parquet(f"{sf_dir}/[p]ages.parquet"))
    feed.process_new_pages(rows, path, f"{path}/checkpoint", f"{path}/runs").awaitTermination()
    stored = spark.read.schema(schemas.ARTICLE_STATS).parquet(f"{path}/article_stats")
    return stored.select(*schemas.ARTICLE_STATS.names)


@query
def stream_window_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per quarter hour and event type, updated over several micro-batches."""
    path = working_folder(spark, "stream_window_counts")
    rows = _event_files(spark, sf_dir, f"{path}/in", 4)
    counts = feed.slot_counts(rows, "ts", "event_type", delay="60 days")
    feed.upsert_counts(counts, f"{path}/out", f"{path}/checkpoint").awaitTermination()
    schema = "slot_start timestamp, event_type string, n bigint, run string"
    stored = spark.read.schema(schema).parquet(f"{path}/out")
    latest = feed.latest_counts(stored, ["slot_start", "event_type"])
    return latest.withColumn("slot_start", F.col("slot_start").cast("timestamp_ntz"))


@query
def slot_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same counts as a batch job."""
    return feed.slot_counts(table(spark, sf_dir, "events"), "ts", "event_type")


@query
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both feeds as text files by kind and batch, merged on URL and landed by a stream."""
    path = working_folder(spark, "stream_ingest")
    events = _event_lines(spark, sf_dir).select(
        F.lit("export").alias("kind"), text(F.col("ymd"), "000000").alias("batch"), "line"
    )
    seen = table(spark, sf_dir, "events").where(F.col("event_type").isin("view", "click"))
    lines = _entity_lines(spark, seen)
    both = events.unionByName(lines).withColumnRenamed("line", "value")
    both.write.partitionBy("kind", "batch").text(f"{path}/in")
    # Few files per trigger: the two files of a batch fall into different micro-batches.
    reader = spark.readStream.schema("value string, kind string, batch string")
    stream = reader.option("maxFilesPerTrigger", 25).text(f"{path}/in")
    feed.ingest_urls(
        stream.select("kind", "batch", F.col("value").alias("line")),
        f"{path}/out", f"{path}/checkpoint", f"{path}/runs",
    ).awaitTermination()
    columns = "url string, eventid bigint, gkgid string, batch string, article_id string, ymd string"
    return spark.read.schema(columns).parquet(f"{path}/out/urls")


@query
def stream_ingest_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both whole feeds landed as deltas; compacted after the first half, merged on read."""
    path = working_folder(spark, "stream_ingest_deltas")
    events = _event_lines(spark, sf_dir).select(
        F.lit("export").alias("kind"), text(F.col("ymd"), "000000").alias("batch"), "line"
    )
    both = events.unionByName(_entity_lines(spark, table(spark, sf_dir, "events")))
    both = both.withColumnRenamed("line", "value")
    first = F.xxhash64("value") % 2 == 0
    reader = spark.readStream.schema("value string, kind string, batch string")
    reader = reader.option("maxFilesPerTrigger", 25)
    for half in (first, ~first):
        both.where(half).write.mode("append").partitionBy("kind", "batch").text(f"{path}/in")
        lines = reader.text(f"{path}/in").select("kind", "batch", F.col("value").alias("line"))
        deltas.ingest_deltas(lines, f"{path}/out", f"{path}/checkpoint", f"{path}/runs").awaitTermination()
        if half is first:
            deltas.compact(spark, f"{path}/out", least_runs=2)
    return deltas.current_urls(spark, f"{path}/out")
