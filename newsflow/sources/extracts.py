"""Tab-separated feed extracts (plain or gzip) and article statistics."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from newsflow import schemas
from newsflow.functions.dates import batch_digits

# Feed files have no quoting: a leading quote is data, or rows would be merged.
_FEED_OPTIONS = {"sep": "\t", "quote": "", "header": "false"}
STATS_OPTIONS = {"sep": "\t", "quote": '"', "escape": '"', "header": "true"}
# With the default null text (''), a quoted empty field would be read as NULL as well.
STATS_READ_OPTIONS = {**STATS_OPTIONS, "nullValue": "\x00"}


def _read_feed(
    spark: SparkSession,
    paths: str | list[str],
    schema: T.StructType,
    encoding: str,
    strict: bool,
    **options: str,
) -> DataFrame:
    reader = spark.read.options(**_FEED_OPTIONS, encoding=encoding, **options)
    if strict:
        return reader.schema(schema).csv(paths, mode="FAILFAST")
    return reader.schema(schemas.with_corrupt(schema)).csv(
        paths, mode="PERMISSIVE", columnNameOfCorruptRecord=schemas.CORRUPT
    )


def read_events(
    spark: SparkSession,
    paths: str | list[str],
    encoding: str = "UTF-8",
    strict: bool = False,
    **options: str,
) -> DataFrame:
    """Event extracts (61 columns).

    A line with the wrong number of fields keeps its readable fields and is kept whole
    in ``_corrupt_record``; ``strict=True`` fails the job instead.
    """
    return _read_feed(spark, paths, schemas.EVENTS, encoding, strict, **options)


def read_entities(
    spark: SparkSession,
    paths: str | list[str],
    encoding: str = "UTF-8",
    strict: bool = False,
    **options: str,
) -> DataFrame:
    """Entity (knowledge-graph) extracts (27 columns)."""
    return _read_feed(spark, paths, schemas.ENTITIES, encoding, strict, **options)


def _pairs(extract: DataFrame, record_id: str, url: str) -> DataFrame:
    return extract.select(
        F.col(record_id).alias("id"),
        F.col(url).alias("url"),
        batch_digits(F.col("_metadata.file_name")).alias("batch"),
    )


def event_pairs(extract: DataFrame) -> DataFrame:
    """``(id, url, batch)`` of event extracts; only two columns are parsed."""
    return _pairs(extract, schemas.EVENT_ID, schemas.EVENT_URL)


def entity_pairs(extract: DataFrame) -> DataFrame:
    """``(id, url, batch)`` of entity extracts; only two columns are parsed."""
    return _pairs(extract, schemas.ENTITY_ID, schemas.ENTITY_URL)


def parse_lines(
    lines: DataFrame, line: str, schema: T.StructType, *keep: Column | str
) -> DataFrame:
    """Parse feed lines held in a text column (from archives) with a feed schema."""
    record = F.from_csv(
        F.col(line),
        ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schemas.with_corrupt(schema)),
        {"sep": "\t", "quote": "", "columnNameOfCorruptRecord": schemas.CORRUPT},
    )
    parsed = lines.select(*keep, record.alias("record"))
    return parsed.select(*[c for c in parsed.columns if c != "record"], "record.*")


def read_article_stats(spark: SparkSession, paths: str | list[str], **options: str) -> DataFrame:
    """Article statistics files: tab separated with a header, plain or gzip."""
    reader = spark.read.options(**STATS_READ_OPTIONS, **options)
    return reader.schema(schemas.ARTICLE_STATS).csv(paths)
