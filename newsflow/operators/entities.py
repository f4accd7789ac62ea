"""Entity records and their join with articles."""

from pyspark.sql import DataFrame, functions as F

from newsflow import schemas
from newsflow.functions.dates import date_parts, lenient_date
from newsflow.functions.text import null_to_empty, readable_locations
from newsflow.operators.skew import hot_keys, salted_join, scatter_missing

_CLASHING = ("year", "month", "day")


def process_entities(records: DataFrame) -> DataFrame:
    """Readable locations and date parts of entity records; rows with a bad date are dropped."""
    day = lenient_date(F.col("DATE"))
    text = ["GKGRECORDID", "Themes", "Persons", "Organizations", "Locations"]
    dated = records.select(*text, day.alias("_day")).where(F.col("_day").isNotNull())
    filled = null_to_empty(dated).withColumns(
        {"gkgid": F.col("GKGRECORDID"), "Locations": readable_locations(F.col("Locations"))}
    )
    return filled.select("*", *date_parts(F.col("_day"))).select(*schemas.ENTITY_COLUMNS)


def article_entities(
    articles: DataFrame, entities: DataFrame, how: str = "left", hot_share: float | None = None
) -> DataFrame:
    """Articles with the entities of their record, joined on ``gkgid``.

    Date columns of the entity side get a ``gkg_`` prefix. Many articles have no entity
    id: those rows are spread before the shuffle and match nothing. Adaptive skew-join
    splits other hot ids; ``hot_share`` salts ids with that share of the articles by hand.
    An inner or semi join drops rows without an id before the shuffle.
    """
    right = entities.withColumnsRenamed(
        {c: f"gkg_{c}" for c in _CLASHING if c in entities.columns and c in articles.columns}
    )
    right = right.where(F.col("gkgid") != "").withColumnRenamed("gkgid", "_key")
    if how in ("inner", "left_semi"):
        articles = articles.where(F.col("gkgid") != "")
    left = articles.withColumn(
        "_key", scatter_missing(F.col("gkgid"), *[F.col(c) for c in articles.columns])
    )
    if hot_share is None:
        return left.join(right, "_key", how).drop("_key")
    with_id = articles.select(F.col("gkgid").alias("_key")).where(F.col("_key") != "")
    hot = hot_keys(with_id, ["_key"], hot_share)
    return salted_join(left, right, ["_key"], how, hot=hot).drop("_key")
