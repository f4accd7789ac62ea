"""Text, CSV and JSON outputs in the formats the readers accept."""

from pyspark.sql import DataFrame, functions as F

from newsflow.functions.text import null_to_empty, unicode_escape
from newsflow.sources.extracts import STATS_OPTIONS

# Blanks at the ends of a field are data.
_KEEP_BLANKS = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def write_tsv(df: DataFrame, path: str, mode: str = "append", compression: str = "gzip") -> None:
    """Tab-separated rows with one header per file, quoted where needed."""
    df.write.options(**STATS_OPTIONS, **_KEEP_BLANKS).csv(path, mode=mode, compression=compression)


def write_article_stats(stats: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Article statistics with the title unicode-escaped."""
    write_tsv(stats.withColumn("title", unicode_escape(F.col("title"))), path, mode)


def write_feed(
    df: DataFrame, path: str, mode: str = "overwrite", compression: str = "gzip"
) -> None:
    """Feed-format text: tabs, no header, no quotes; values must be free of tabs and breaks."""
    df.write.options(sep="\t", quote="", header="false", emptyValue="", **_KEEP_BLANKS).csv(
        path, mode=mode, compression=compression
    )


def write_monthly(df: DataFrame, path: str, mode: str = "append") -> None:
    """One directory per year and month, tab separated with a header.

    ``append`` adds files to a month; ``overwrite`` replaces the months in ``df``.
    """
    (
        df.hint("rebalance", F.col("year"), F.col("month"))
        .write.options(**STATS_OPTIONS, **_KEEP_BLANKS, partitionOverwriteMode="dynamic")
        .partitionBy("year", "month")
        .csv(path, mode=mode, compression="gzip")
    )


def write_joined_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Comma-separated article x entity rows, empty text for missing values."""
    null_to_empty(df).write.options(header="true", escape='"', **_KEEP_BLANKS).csv(path, mode=mode)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines, gzip; maps become nested objects."""
    df.write.json(path, mode=mode, compression="gzip")


def write_file_list(urls: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One URL per line, gzip."""
    urls.select("url").write.mode(mode).text(path, compression="gzip")


def write_links(links: DataFrame, path: str, mode: str = "overwrite") -> None:
    """``(article_id, ymd, links)`` as a Parquet table by day, one row per article."""
    links.hint("rebalance", F.col("ymd")).write.mode(mode).option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("ymd").parquet(path)


def write_articles(articles: DataFrame, path: str, mode: str = "overwrite") -> None:
    """``(article_id, ymd, text)`` as a Parquet table by day."""
    write_links(articles, path, mode)
