"""Search documents as bulk newline-delimited JSON. No service is contacted."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from newsflow.functions.urls import article_key


def bulk_lines(docs: DataFrame, index: str) -> DataFrame:
    """Two lines per document: the action, with the article key as id, and the document.

    A fixed id makes loading the same documents twice harmless.
    """
    key: Column = article_key(F.col("eventid"), F.col("gkgid"))
    action = F.to_json(
        F.struct(F.struct(F.lit(index).alias("_index"), key.alias("_id")).alias("index"))
    )
    body = F.to_json(F.struct(*docs.columns), {"ignoreNullFields": "false"})
    return docs.select(F.concat_ws("\n", action, body).alias("value"))


def write_bulk(docs: DataFrame, path: str, index: str, mode: str = "overwrite") -> None:
    """Write bulk files (gzip text)."""
    bulk_lines(docs, index).write.mode(mode).text(path, compression="gzip")


def read_bulk(spark: SparkSession, path: str) -> DataFrame:
    """Bulk files back as one row per document: ``index``, ``doc_key`` and the eight fields.

    A line on its own does not tell which document its action belongs to, so actions and
    documents are read as pairs of lines: the writer never puts a line end inside of one.
    """
    pair = spark.read.option("lineSep", '\n{"index":').text(path)
    # The first pair of a file still has its start, the last one its line end.
    text = F.regexp_replace(F.rtrim("value", F.lit("\n")), r'^\{"index":', "")
    at = F.instr(text, "\n")
    action = F.from_json(F.substring(text, F.lit(1), at - 2), "_index string, _id string")
    body = F.from_json(F.substring(text, at + 1, F.length(text)), _BODY)
    rows = pair.where(F.length(text) > 0).select(action.alias("action"), body.alias("doc"))
    return rows.select(F.col("action._index").alias("index"), F.col("action._id").alias("doc_key"), "doc.*")


_BODY = (
    "title string, accessdate string, article string, author string, keywords string, "
    "description string, eventid bigint, gkgid string"
)
