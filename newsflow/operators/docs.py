"""Search documents from article statistics and body texts."""

from pyspark.sql import DataFrame, functions as F

from newsflow import schemas
from newsflow.functions.text import null_to_empty
from newsflow.functions.urls import article_key
from newsflow.operators.pages import page_fields
from newsflow.operators.stats import OK_STATUS

_KEYS = ["ymd", "article_id"]


def search_docs(stats: DataFrame, articles: DataFrame) -> DataFrame:
    """The eight document fields; an article without a text file has an empty text.

    Joins on day and article id: a table laid out by ``ymd`` is pruned by the day, and the
    id alone is not unique over days.
    """
    keyed = stats.withColumns(
        {"ymd": F.col("accessdate"), "article_id": article_key(F.col("eventid"), F.col("gkgid"))}
    )
    texts = articles.select(*_KEYS, F.col("text").alias("article"))
    joined = null_to_empty(keyed.join(texts, _KEYS, "left"))
    return joined.select(*schemas.SEARCH_DOC_COLUMNS)


def page_docs(parsed: DataFrame) -> DataFrame:
    """The same documents straight from parsed pages: text and fields share a row, no join."""
    fields = page_fields(F.col("meta"))
    return parsed.where(F.col("status") == OK_STATUS).select(
        fields["title"].alias("title"),
        F.col("ymd").alias("accessdate"),
        F.col("text").alias("article"),
        *[fields[name].alias(name) for name in ("author", "keywords", "description")],
        "eventid",
        F.coalesce("gkgid", F.lit("")).alias("gkgid"),
    )


def unseen(new: DataFrame, landed: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key has not landed yet."""
    return new.join(landed.select(*keys), keys, "left_anti")
