"""Per-article files: body text, links, nested JSON.

File names carry the article id: ``<id>.text.gz``, ``<id>.txt.gz``, ``<id>.json.gz``.
"""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from newsflow import schemas


def _article_id() -> Column:
    name = F.col("_metadata.file_name")
    return F.regexp_extract(name, r"^(.*?)\.(?:text|txt|json|html)(?:\.gz)?$", 1)


def _ymd() -> Column:
    return F.regexp_extract(F.col("_metadata.file_path"), r"/(\d{8})/[^/]*$", 1)


def _whole_files(spark: SparkSession, paths: str | list[str], **options: str) -> DataFrame:
    # ``wholetext`` has to be the keyword: the argument's default overrides the option.
    return spark.read.options(**options).text(paths, wholetext=True)


def read_articles(spark: SparkSession, paths: str | list[str], **options: str) -> DataFrame:
    """``(article_id, ymd, text)``, one row per file."""
    return _whole_files(spark, paths, **options).select(
        _article_id().alias("article_id"), _ymd().alias("ymd"), F.col("value").alias("text")
    )


def read_page_links(spark: SparkSession, paths: str | list[str], **options: str) -> DataFrame:
    """``(article_id, ymd, links)``, one row per file, links in file order.

    An empty file is a page without links, not a page with one empty link.
    """
    links = F.filter(F.split("value", "\n"), lambda link: link != "")
    return _whole_files(spark, paths, **options).select(
        _article_id().alias("article_id"), _ymd().alias("ymd"), links.alias("links")
    )


def _json_files(
    spark: SparkSession, paths: str | list[str], ddl: str, **options: str
) -> DataFrame:
    # The files are indented, so a file is parsed as a whole; a broken one gives NULL.
    return _whole_files(spark, paths, **options).select(
        _article_id().alias("article_id"),
        _ymd().alias("ymd"),
        F.from_json("value", ddl, {"mode": "PERMISSIVE"}).alias("content"),
    )


def read_page_domains(spark: SparkSession, paths: str | list[str], **options: str) -> DataFrame:
    """``(article_id, ymd, url, basedomain, domains)`` of per-page domain-count files."""
    return _json_files(spark, paths, schemas.PAGE_DOMAINS_DDL, **options).select(
        "article_id", "ymd", "content.*"
    )


def read_html_meta(spark: SparkSession, paths: str | list[str], **options: str) -> DataFrame:
    """``(article_id, ymd, meta)`` of per-page metadata files (group -> key -> value)."""
    return _json_files(spark, paths, schemas.HTML_META_DDL, **options).withColumnRenamed(
        "content", "meta"
    )
