"""Incremental merge of feed ids on URL as a base with deltas, merged on read.

``feed.ingest_urls`` merges the days of a micro-batch anew each time. Here a micro-batch only
writes what it has found itself: per feed, day and URL the winning id (see
``merge.event_order`` and ``merge.entity_order``), as a run of ``path``. A winner of winners
is the winner of all rows, so readers fold base and deltas in any order, and the same delta
twice changes nothing. ``compact`` folds the runs of a day into a base of its own.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from newsflow.functions.urls import article_key
from newsflow.operators.merge import entity_order, event_order, merge_url_ids
from newsflow.plans.jobs import BY_RUN
from newsflow.sinks.runlog import write_observed
from newsflow.sinks.tables import clear, day_runs, read_days, write_dated
from newsflow.streaming import feed

WINNERS = T.StructType([T.StructField(c, T.StringType()) for c in ("kind", "id", "url", "batch", "ymd", "run")])
BASE = "base-"


def winners(pairs: DataFrame) -> DataFrame:
    """Last row of each feed, day and URL. ``pairs`` is ``(kind, id, url, batch, ymd)``.

    Both feeds go through one shuffle. Rows without a URL name no article, and rows without
    a day have no place in the layout; both are left out.
    """
    kept = pairs.where("url IS NOT NULL AND url != '' AND ymd IS NOT NULL")
    row, batch, is_event = F.struct("id", "batch"), F.col("batch"), F.col("kind") == "export"
    number = F.when(is_event, F.col("id").try_cast("bigint"))
    found = kept.groupBy("kind", "ymd", "url").agg(
        F.max_by(row, F.when(is_event, event_order(batch, number))).alias("event"),
        F.max_by(row, F.when(~is_event, entity_order(batch, F.col("id")))).alias("record"),
    )
    found = found.withColumn("row", F.coalesce("event", "record")).where("row IS NOT NULL")
    return found.select("kind", F.col("row.id").alias("id"), "url", F.col("row.batch").alias("batch"), "ymd")


def ingest_deltas(
    lines: DataFrame, path: str, checkpoint: str, runs: str, every: str | None = None
) -> StreamingQuery:
    """Land the winners of each micro-batch of feed lines ``(kind, batch, line)``.

    A micro-batch that is run again has the same rows and overwrites its own partitions. No
    landed day is listed, read or written again, however old the rows are.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        run = feed.run_label(batch_id)

        def land(rows: DataFrame) -> None:
            won = winners(rows.where(~F.col("bad")).drop("bad"))
            write_dated(won.withColumn("run", F.lit(run)), path, BY_RUN, rebalance=False)

        bad = F.sum(F.col("bad").cast("int"))
        write_observed(feed.feed_pairs(batch), land, runs, f"deltas {run}", bad_lines=bad)

    feed.ensure_table(lines.sparkSession, path, WINNERS, BY_RUN)
    return feed.start(lines, handle, checkpoint, "append", every)


def current_urls(spark: SparkSession, path: str, days: list[str] | None = None) -> DataFrame:
    """``(url, eventid, gkgid, batch, article_id, ymd)``: base and deltas of some or all days."""
    landed = spark.read.schema(WINNERS).parquet(path) if days is None else read_days(spark, path, WINNERS, days)
    events = landed.where("kind = 'export'").withColumn("id", F.col("id").cast("bigint"))
    merged = merge_url_ids(events, landed.where("kind = 'gkg'"), keep_batch=True, by=("ymd",))
    key = article_key(F.col("eventid"), F.col("gkgid"))
    return merged.select("url", "eventid", "gkgid", "batch", key.alias("article_id"), "ymd")


def compact(spark: SparkSession, path: str, least_runs: int = 8) -> list[str]:
    """Fold each day of ``least_runs`` runs or more into one base, and say which days.

    The base is written before the runs that it holds are removed: a job that ends in
    between leaves rows twice, which changes no result, and the next one takes them in. Runs
    that land meanwhile are neither read nor removed. Only folder names reach the driver.
    Read a table anew after it was compacted: older plans name files that are gone.
    """
    many = {day: names for day, names in day_runs(spark, path).items() if len(names) >= max(least_runs, 2)}
    folders = [f"{path}/ymd={day}/run={name}" for day, names in many.items() for name in names]
    if not folders:
        return []
    rows = spark.read.schema(WINNERS).option("basePath", path).parquet(*folders)
    # Rows of a day lie together: the shuffle by day splits a day that is large.
    base = winners(rows.drop("run")).withColumn("run", F.lit(BASE + uuid.uuid4().hex))
    write_dated(base, path, BY_RUN)
    for folder in folders:
        clear(spark, folder)
    return sorted(many)
