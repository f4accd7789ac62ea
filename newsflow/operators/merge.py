"""One row per article URL from event and entity records."""

from pyspark.sql import Column, DataFrame, functions as F

def event_order(batch: Column, record_id: Column) -> Column:
    """Batch, then numeric id, packed into one number.

    A number keeps ``max_by`` on hash aggregation; a struct would need a sort.
    """
    shift = F.lit("1" + "0" * 19).cast("decimal(38,0)")
    number = F.coalesce(batch.try_cast("bigint"), F.lit(0).cast("bigint"))
    return number.cast("decimal(19,0)") * shift + record_id.cast("decimal(19,0)")


def entity_order(batch: Column, record_id: Column) -> Column:
    """Batch, then the number at the end of the id (10 comes after 2), then the text.

    Records of translated sources have a T before the number and come after the others.
    """
    tail = F.substring_index(record_id, "-", -1)
    translated = F.startswith(tail, F.lit("T"))
    number = F.when(translated, F.substring(tail, 2, 30)).otherwise(tail).try_cast("bigint")
    return F.struct(batch, translated, F.coalesce(number, F.lit(-1)), record_id)


def latest_per_url(
    pairs: DataFrame, order: Column, alias: str, *extra: Column, by: tuple[str, ...] = ()
) -> DataFrame:
    """Last id of each URL (and group of ``by``). Partial aggregation runs before the shuffle, so a hot URL is cheap.

    Records without a URL name no article and are left out.
    """
    return (
        pairs.where(F.col("url").isNotNull() & (F.col("url") != ""))
        .groupBy("url", *by)
        .agg(F.max_by("id", order).alias(alias), *extra)
    )


def merge_url_ids(
    events: DataFrame,
    entities: DataFrame,
    how: str = "left",
    keep_batch: bool = False,
    by: tuple[str, ...] = (),
) -> DataFrame:
    """``(url, eventid, gkgid)`` from two ``(id, url, batch)`` sets.

    ``left`` keeps event URLs only, as the feed job does; ``outer`` also keeps URLs that
    only the entity feed has. A missing entity id is ''. ``keep_batch`` adds the last
    batch of each URL. ``by`` merges within groups, such as days.
    """
    batch, record_id = F.col("batch"), F.col("id")
    last_batch = [F.max(batch.try_cast("bigint")).alias("_batch")] if keep_batch else []
    last_events = latest_per_url(events, event_order(batch, record_id), "eventid", *last_batch, by=by)
    last_entities = latest_per_url(
        entities, entity_order(batch, record_id), "gkgid", *[c.alias("_other") for c in last_batch], by=by
    )
    merged = last_events.join(last_entities, ["url", *by], how)
    batches = (
        [F.lpad(F.greatest("_batch", "_other").cast("string"), 14, "0").alias("batch")]
        if keep_batch
        else []
    )
    return merged.select("url", *by, "eventid", F.coalesce("gkgid", F.lit("")).alias("gkgid"), *batches)


def duplicate_counts(
    df: DataFrame, key: str, *by: str, digest: bool = False, approximate: bool = False
) -> DataFrame:
    """Rows, distinct keys and their difference, per group.

    The distinct step shuffles on (group, key), so no group has to fit in one task.
    ``digest`` shuffles a SHA-256 of long keys instead of the keys. ``approximate`` shuffles
    one sketch per group and task; the distinct count is then an estimate.
    """
    distinct = F.approx_count_distinct("key") if approximate else F.countDistinct("key")
    value = F.unhex(F.sha2(key, 256)) if digest else F.col(key)
    keyed = df.select(*by, value.alias("key"))
    counted = keyed.groupBy(*by).agg(
        F.count("key").alias("n_rows"), distinct.alias("n_distinct")
    )
    return counted.withColumn("n_duplicates", F.col("n_rows") - F.col("n_distinct"))
