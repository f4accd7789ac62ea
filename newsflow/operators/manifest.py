"""Feed file lists: what a day should hold, what has landed, what is missing."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from newsflow.functions.dates import batch_digits, batch_label, batch_ts
from newsflow.functions.urls import base_name

# File-name tails of the feed kinds, batch length, completeness threshold.
TAILS = {
    "export": ".export.CSV.zip",
    "mentions": ".mentions.CSV.zip",
    "gkg": ".gkg.csv.zip",
}
BATCH_MINUTES = 15
COMPLETE_ABOVE = 90
FEED_KINDS = ("export", "gkg")


def parse_manifest(urls: DataFrame) -> DataFrame:
    """``(url, name, batch, ymd, batch_ts, kind)`` of feed URLs."""
    named = urls.select("url", base_name(F.col("url")).alias("name"))
    batch = batch_digits(F.col("name"))
    return named.select(
        "url",
        "name",
        batch.alias("batch"),
        F.substring(F.substring_index("name", ".", 1), 1, 8).alias("ymd"),
        batch_ts(batch).alias("batch_ts"),
        F.get(F.split("name", r"\."), F.lit(1)).alias("kind"),
    )


def without_mentions(manifest: DataFrame) -> DataFrame:
    """Drop the feed kind that is never read."""
    return manifest.where(~F.col("url").contains("mentions"))


def for_date(manifest: DataFrame, ymd: str) -> DataFrame:
    """Files whose base name starts with a date."""
    return manifest.where(F.startswith(F.col("name"), F.lit(ymd)))


def files_by_date(manifest: DataFrame, distinct: bool = False) -> DataFrame:
    """File URLs of each day, sorted, each as often as it is listed unless ``distinct``.

    A day has 96 batches of three kinds.
    """
    gathered = F.collect_set("url") if distinct else F.collect_list("url")
    return manifest.groupBy("ymd").agg(F.array_sort(gathered).alias("urls"))


def urls_by_kind(manifest: DataFrame) -> DataFrame:
    """``(kind, url)``: the file URLs of each kind, as rows."""
    return manifest.select("kind", "url")


def files_by_kind(manifest: DataFrame) -> DataFrame:
    """Number of files, first batch and last batch of each kind.

    The files of a kind are rows, not a list: a kind grows with the age of the feed.
    """
    return manifest.groupBy("kind").agg(
        F.count(F.lit(1)).alias("n_files"),
        F.min("batch").alias("first_batch"),
        F.max("batch").alias("last_batch"),
    )


def first_batch(manifest: DataFrame) -> DataFrame:
    """Batch that names a run: the smallest of its files."""
    return manifest.agg(F.min("batch").alias("batch"), F.min("ymd").alias("ymd"))


def slot_url(base: str, batch: Column, kind: Column) -> Column:
    """URL of the file of a batch and kind; NULL for an unknown kind."""
    tail = F.coalesce(*[F.when(kind == k, F.lit(t)) for k, t in TAILS.items()])
    return F.concat(F.lit(base.rstrip("/") + "/"), batch, tail)


def expected_slots(
    days: DataFrame, base: str, kinds: tuple[str, ...] = FEED_KINDS, day: str = "day"
) -> DataFrame:
    """Every file a day should have: 96 quarter hours times the kinds, for each day row."""
    midnight = F.col(day).cast("timestamp_ntz")
    last = midnight + F.expr(f"make_dt_interval(0, 24, -{BATCH_MINUTES}, 0)")
    step = F.expr(f"make_dt_interval(0, 0, {BATCH_MINUTES}, 0)")
    slots = days.select(F.explode(F.sequence(midnight, last, step)).alias("batch_ts"))
    labelled = slots.select(
        "batch_ts",
        batch_label(F.col("batch_ts")).alias("batch"),
        F.explode(F.array(*[F.lit(k) for k in kinds])).alias("kind"),
    )
    return labelled.select(
        F.substring("batch", 1, 8).alias("ymd"),
        "batch_ts",
        "batch",
        "kind",
        slot_url(base, F.col("batch"), F.col("kind")).alias("url"),
    )


def completeness(manifest: DataFrame, above: int = COMPLETE_ABOVE) -> DataFrame:
    """Batches present per day and kind, and whether that is more than the threshold."""
    counted = manifest.groupBy("ymd", "kind").agg(F.countDistinct("batch").alias("n_batches"))
    return counted.withColumn("is_complete", (F.col("n_batches") > above).cast("int"))


def missing_slots(expected: DataFrame, landed: DataFrame) -> DataFrame:
    """Expected files that have not landed."""
    return expected.join(landed.select("batch", "kind"), ["batch", "kind"], "left_anti")


def missing_runs(expected: DataFrame, landed: DataFrame) -> DataFrame:
    """Gaps of the feed: runs of consecutive missing slots of a kind, over midnight too.

    ``(kind, first_batch, last_batch, n_slots)``. Slots are numbered by time; in a run the
    number less the rank among the day's missing slots stays the same. Ranks are taken
    within days, and the runs that touch midnight are joined afterwards, so no task holds
    more than a day of a kind, or more than a row a day.
    """
    slot = (F.unix_seconds(F.col("batch_ts").cast("timestamp")) / (60 * BATCH_MINUTES)).cast("long")
    missing = missing_slots(expected, landed).select("kind", "ymd", "batch", slot.alias("slot")).distinct()
    rank = F.row_number().over(Window.partitionBy("kind", "ymd").orderBy("slot"))
    runs = missing.withColumn("island", F.col("slot") - rank).groupBy("kind", "ymd", "island").agg(
        F.min("slot").alias("first"), F.max("slot").alias("last"),
        F.min("batch").alias("first_batch"), F.max("batch").alias("last_batch"),
    )
    per_day = 24 * 60 // BATCH_MINUTES
    whole = (F.col("first") % per_day == 0) | (F.col("last") % per_day == per_day - 1)
    by_time = Window.partitionBy("kind").orderBy("first")
    starts = F.coalesce((F.col("first") != F.lag("last").over(by_time) + 1).cast("int"), F.lit(1))
    touching = runs.where(whole).withColumn("starts", starts)
    touching = touching.withColumn("run", F.sum("starts").over(by_time)).groupBy("kind", "run").agg(
        F.min("first").alias("first"), F.max("last").alias("last"),
        F.min("first_batch").alias("first_batch"), F.max("last_batch").alias("last_batch"),
    )
    columns = ["kind", "first_batch", "last_batch", (F.col("last") - F.col("first") + 1).alias("n_slots")]
    return runs.where(~whole).select(*columns).unionByName(touching.select(*columns))
