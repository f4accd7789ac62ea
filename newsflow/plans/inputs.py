"""Feed-shaped inputs derived from the given tables, for the registered queries."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from newsflow.functions.dates import batch_label
from newsflow.functions.urls import base_domain
from newsflow.operators.manifest import slot_url

FEED_BASE = "http://feed.example/v2"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text(*parts: Column | str) -> Column:
    """Concatenation of literal text and columns."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def event_url() -> Column:
    """The article URL of an ``events`` row: one site per event type, one page per user."""
    return text("http://", F.col("event_type"), ".example/", F.col("user_id"))


def event_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Article statistics from ``events``: errors were not fetched, sign-ups have no record id."""
    url = event_url()
    return table(spark, sf_dir, "events").select(
        url.alias("url"),
        base_domain(url).alias("domain"),
        F.length("props").cast("bigint").alias("nbytes"),
        F.col("event_id").alias("eventid"),
        F.when(F.col("event_type") == "signup", "")
        .otherwise(text("c-", F.col("user_id")))
        .alias("gkgid"),
        F.when(F.col("event_type") == "error", 404).otherwise(200).alias("status"),
        F.date_format("ts", "yyyyMMdd").alias("accessdate"),
        text("Event ", F.col("event_id")).alias("title"),
        F.col("event_type").alias("site_name"),
        F.lit("").alias("author"),
        F.when(F.col("value") >= 10, F.col("props")).otherwise("").alias("keywords"),
        F.when(F.col("value") < 20, F.col("event_type")).alias("description"),
    )


def customer_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entity records from ``customer``, ``nation`` and ``region``; many dates are invalid."""
    joined = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    nation, region, key = F.col("n_name"), F.col("r_name"), F.col("c_custkey")
    city = text(
        "4#", F.col("c_mktsegment"), ", ", nation, " (general)#", region, "#", region, "A8#",
        F.col("c_acctbal"), "#-1.5#", key,
    )
    country = text("1#", nation, "#", region, "#", region, "#46#2#", region)
    return joined.select(
        text("c-", key).alias("GKGRECORDID"),
        (F.lit(20240000000000) + key * 1000000).alias("DATE"),
        text("http://record.example/", key).alias("DocumentIdentifier"),
        F.col("c_mktsegment").alias("Themes"),
        F.col("c_name").alias("Persons"),
        F.when(F.col("c_acctbal") > 0, region).alias("Organizations"),
        F.concat_ws(";", country, city).alias("Locations"),
    )


def customer_pairs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Event pairs from ``orders`` and entity pairs from ``events``, on one URL per customer."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        text("http://customer.example/", F.col("o_custkey")).alias("url"),
        batch_label(F.col("o_orderdate")).alias("batch"),
    )
    label = text(F.date_format("ts", "yyyyMMdd"), "000000")
    events = table(spark, sf_dir, "events").select(
        text(label, "-", F.col("event_id")).alias("id"),
        text("http://customer.example/", F.col("user_id")).alias("url"),
        label.alias("batch"),
    )
    return orders, events


def slot_of(ts: Column) -> Column:
    """Start of the quarter hour of a timestamp."""
    return F.window(ts, "15 minutes")["start"]


def event_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed file URLs from the quarter hours of ``events``; the kind follows the event type."""
    slots = table(spark, sf_dir, "events").select(
        batch_label(slot_of(F.col("ts"))).alias("batch"),
        F.when(F.col("event_type") == "click", "gkg")
        .when(F.col("event_type") == "view", "mentions")
        .otherwise("export")
        .alias("kind"),
    )
    return slots.distinct().select(slot_url(FEED_BASE, F.col("batch"), F.col("kind")).alias("url"))


def fetched_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pages`` as fetched pages; pages of one site count as not found."""
    return as_fetched(table(spark, sf_dir, "pages"))


def as_fetched(pages: DataFrame) -> DataFrame:
    """The page-job columns from the columns of ``pages``, batch or stream."""
    lost = F.col("url").contains("cheap-pills")
    return pages.select(
        "url",
        F.col("page_id").alias("eventid"),
        text("p-", F.col("page_id")).alias("gkgid"),
        F.lit("20240101").alias("ymd"),
        F.when(lost, 404).otherwise(200).alias("status"),
        "html",
    )


def document_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Article statistics from ``documents`` and ``labels``; one day per source."""
    labels = table(spark, sf_dir, "labels")
    joined = table(spark, sf_dir, "documents").drop("text").join(labels, "doc_id", "left")
    url = text("https://", F.col("source"), ".example/", F.col("lang"), "/", F.col("doc_id"))
    day = F.substring("source", 4, 9).cast("int") + 1
    return joined.select(
        url.alias("url"),
        base_domain(url).alias("domain"),
        F.col("n_chars").alias("nbytes"),
        F.when(F.col("doc_id") > 0, F.col("doc_id")).alias("eventid"),
        text("d-", F.col("doc_id")).alias("gkgid"),
        F.lit(200).alias("status"),
        text("202401", F.lpad(day.cast("string"), 2, "0")).alias("accessdate"),
        text("Document ", F.col("doc_id")).alias("title"),
        F.col("source").alias("site_name"),
        F.lit(None).cast("string").alias("author"),
        F.when(F.col("quality") == 1, F.col("lang")).alias("keywords"),
        F.when(F.col("toxic") == 0, F.col("source")).alias("description"),
    )


def document_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Body texts of all documents."""
    kept = table(spark, sf_dir, "documents")
    key = F.when(F.col("doc_id") > 0, F.col("doc_id").cast("string")).otherwise("g_d-0")
    day = F.substring("source", 4, 9).cast("int") + 1
    return kept.select(
        key.alias("article_id"),
        text("202401", F.lpad(day.cast("string"), 2, "0")).alias("ymd"),
        "text",
    )
