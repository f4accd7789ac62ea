"""Incremental ingest, once-only landing, and 15-minute counts.

The default for "process each article once" is an anti-join with the landed table: it
never forgets a key, and late batches still count. The watermark variant has bounded
state but drops rows that come later than its delay.
"""

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from newsflow import schemas
from newsflow.functions.dates import batch_digits
from newsflow.functions.urls import article_key
from newsflow.operators.docs import unseen
from newsflow.operators.merge import duplicate_counts, merge_url_ids
from newsflow.operators.pages import PAGE_KEYS, one_per_article, with_article_id
from newsflow.plans.jobs import BY_RUN, process_pages
from newsflow.sinks.runlog import log_run, write_observed
from newsflow.sinks.tables import clear, read_days, write_dated
from newsflow.sources.archives import unzip_lines
from newsflow.sources.extracts import parse_lines
from newsflow.sources.layout import day_folders

SLOT = "15 minutes"


def read_extract_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int = 192
) -> DataFrame:
    """Newly landed extract files of one kind, with their batch digits."""
    options = {"sep": "\t", "quote": "", "maxFilesPerTrigger": str(files_per_trigger)}
    stream = spark.readStream.schema(schema).options(**options).csv(path)
    return stream.select("*", batch_digits(F.col("_metadata.file_name")).alias("batch"))


def read_feed_lines(
    spark: SparkSession, path: str, files_per_trigger: int = 192, encoding: str = "UTF-8"
) -> DataFrame:
    """Lines of newly landed extract files of all kinds: ``(kind, batch, line)``.

    Zip archives are read with ``read_zip_stream``.
    """
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_trigger)
    # the text source knows UTF-8 only; the line separator keeps CSV from splitting fields
    whole = {"sep": "\x01", "quote": "", "escape": "", "encoding": encoding}
    lines = reader.schema("value string").options(**whole).csv(path) if encoding != "UTF-8" else reader.text(path)
    name = F.col("_metadata.file_name")
    return lines.select(
        F.get(F.split(name, r"\."), F.lit(1)).alias("kind"),
        batch_digits(name).alias("batch"),
        F.col("value").alias("line"),
    )


def read_zip_stream(
    spark: SparkSession, path: str, encoding: str = "UTF-8", files_per_trigger: int = 192
) -> DataFrame:
    """The same from zip archives. A broken archive gives one line of kind ``error``."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    archives = spark.readStream.format("binaryFile").schema(schema)
    archives = archives.option("maxFilesPerTrigger", files_per_trigger).option("pathGlobFilter", "*.zip")
    lines = unzip_lines(archives.load(path), encoding)
    name = F.col("file_name")
    return lines.select(
        F.when(F.col("error").isNull(), F.get(F.split(name, r"\."), F.lit(1))).otherwise("error").alias("kind"),
        batch_digits(name).alias("batch"),
        F.coalesce("line", "error").alias("line"),
    )


def slot_counts(rows: DataFrame, ts: str, *by: str, delay: str | None = "1 day") -> DataFrame:
    """Rows per 15-minute slot and group, for streams and for batch tables alike."""
    if rows.isStreaming and delay:
        rows = rows.withWatermark(ts, delay)
    slots = rows.groupBy(F.window(ts, SLOT).alias("slot"), *by).agg(F.count(F.lit(1)).alias("n"))
    return slots.select(F.col("slot.start").alias("slot_start"), *by, "n")


def once_within_watermark(rows: DataFrame, keys: list[str], ts: str, delay: str) -> DataFrame:
    """First row of each key, with state that is dropped after ``delay``."""
    return rows.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def ensure_table(
    spark: SparkSession, path: str, schema: T.StructType, by: tuple[str, ...]
) -> None:
    # An empty table makes the first micro-batch like all others.
    spark.createDataFrame([], schema).write.mode("ignore").partitionBy(*by).parquet(path)


def run_label(batch_id: int) -> str:
    return f"{batch_id:012d}"


def _with_run(schema: T.StructType) -> T.StructType:
    return T.StructType(schema.fields + [T.StructField("run", T.StringType())])


def landed_before(
    spark: SparkSession, path: str, schema: T.StructType, run: str, days: list[str]
) -> DataFrame:
    """Rows that other runs have landed for some days; only those partitions are read."""
    return read_days(spark, path, schema, days).where(F.col("run") != run)


def batch_days(batch: DataFrame, ymd: Column) -> list[str]:
    """The days in a micro-batch: a list no longer than the calendar."""
    return [row.ymd for row in batch.select(ymd.alias("ymd")).distinct().collect()]


def land_unseen(
    batch: DataFrame, batch_id: int, path: str, keys: list[str], days: list[str] | None = None
) -> None:
    """Append the rows of a micro-batch whose key has not landed. The table has ``ymd``.

    A micro-batch that is run again overwrites its own partitions and does not take its
    own earlier rows for landed ones, so each key lands exactly once.
    """
    spark, run = batch.sparkSession, run_label(batch_id)
    if days is None:
        days = batch_days(batch, F.col("ymd"))
    landed = landed_before(spark, path, _with_run(batch.schema), run, days)
    new = unseen(batch.dropDuplicates(keys), landed, keys).select(*batch.columns)
    write_dated(new.withColumn("run", F.lit(run)), path, BY_RUN)


def start(rows: DataFrame, each, checkpoint: str, mode: str, every: str | None) -> StreamingQuery:
    writer = rows.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.foreachBatch(each).start()


def land_once(
    rows: DataFrame, path: str, keys: list[str], checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Land each key once. ``every=None`` takes all that is there and stops."""
    ensure_table(rows.sparkSession, path, _with_run(rows.schema), BY_RUN)
    return start(
        rows, lambda batch, n: land_unseen(batch, n, path, keys), checkpoint, "append", every
    )


_PAIRS = "kind string, id string, url string, batch string, ymd string"
_URLS = "url string, eventid bigint, gkgid string, batch string, article_id string, ymd string"


def feed_pairs(lines: DataFrame) -> DataFrame:
    """Ids of feed lines ``(kind, batch, line)``: ``(kind, id, url, batch, ymd, bad)``."""

    def pairs(kind: str, schema: T.StructType, record_id: str, url: str) -> DataFrame:
        parsed = parse_lines(lines.where(F.col("kind") == kind), "line", schema, "batch")
        return parsed.select(
            F.lit(kind).alias("kind"),
            F.col(record_id).cast("string").alias("id"),
            F.col(url).alias("url"),
            "batch",
            F.substring("batch", 1, 8).alias("ymd"),
            F.col(schemas.CORRUPT).isNotNull().alias("bad"),
        )

    events = pairs("export", schemas.EVENTS, schemas.EVENT_ID, schemas.EVENT_URL)
    return events.unionByName(pairs("gkg", schemas.ENTITIES, schemas.ENTITY_ID, schemas.ENTITY_URL))


def ingest_urls(
    lines: DataFrame,
    path: str,
    checkpoint: str,
    runs: str,
    every: str | None = None,
    count_duplicates: bool = True,
) -> StreamingQuery:
    """Merge feed lines on URL, one row per URL and day, whatever the micro-batches are.

    ``lines`` is ``(kind, batch, line)``. A micro-batch first lands its ids as rows of
    ``path/pairs``, by day and run. Then the days it has rows for are merged anew from all
    that has landed for them and replace their partition of ``path/urls``. The result
    follows from the files alone: a batch's files may come in any order and in different
    micro-batches. Each micro-batch logs what it read, corrupt lines too, and what the days
    hold now.

    ``path/urls`` is ``(url, eventid, gkgid, batch, article_id, ymd)``.
    """
    spark = lines.sparkSession
    pair_schema, url_schema = _with_run(T.StructType.fromDDL(_PAIRS)), T.StructType.fromDDL(_URLS)
    ensure_table(spark, f"{path}/pairs", pair_schema, BY_RUN)
    ensure_table(spark, f"{path}/urls", url_schema, ("ymd",))

    def handle(batch: DataFrame, batch_id: int) -> None:
        run = run_label(batch_id)
        found = feed_pairs(batch)
        clear(spark, f"{path}/pairs/ymd=*/run={run}")
        good = ~F.col("bad") & F.col("ymd").isNotNull()

        def land(rows: DataFrame) -> None:
            new = rows.where(good).drop("bad").withColumn("run", F.lit(run))
            write_dated(new, f"{path}/pairs", BY_RUN, rebalance=False)

        write_observed(found, land, runs, f"ingest {run}", bad_lines=F.sum(F.col("bad").cast("int")))
        days = [day for day in day_folders(spark, f"{path}/pairs") if _has_run(spark, path, day, run)]
        if days:
            merge_days(days, run)

    def merge_days(days: list[str], run: str) -> None:
        landed = read_days(spark, f"{path}/pairs", pair_schema, days)
        events = landed.where("kind = 'export'").withColumn("id", F.col("id").cast("bigint"))
        records = landed.where("kind = 'gkg'")
        merged = merge_url_ids(events, records, keep_batch=True, by=("ymd",)).withColumn(
            "article_id", article_key(F.col("eventid"), F.col("gkgid"))
        )
        write_observed(
            merged.select(*url_schema.names),
            lambda rows: write_dated(rows, f"{path}/urls", ("ymd",)),
            runs,
            f"merged {run}",
        )
        if count_duplicates:
            log_duplicates(landed.where(F.col("run") == run))

    def log_duplicates(rows: DataFrame) -> None:
        for row in duplicate_counts(rows, "url", "kind").collect():  # one row per feed
            counts = (row.n_rows, row.n_distinct, row.n_duplicates)
            message = "urls: %d; distinct: %d; duplicates: %d" % counts
            log_run(spark, runs, f"duplicates {row.kind}", datetime.now(timezone.utc), message)

    return start(lines, handle, checkpoint, "append", every)


def _has_run(spark: SparkSession, path: str, day: str, run: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/pairs/ymd={day}/run={run}")
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def new_pages(batch: DataFrame, landed: DataFrame) -> DataFrame:
    """Pages of a micro-batch whose article has not landed, one per article.

    The lookup runs on the keys alone.
    """
    keyed, keys = with_article_id(batch), list(PAGE_KEYS)
    new = unseen(keyed.select(*keys).distinct(), landed, keys)
    return one_per_article(keyed.join(new, keys, "left_semi").select(*batch.columns))


def process_new_pages(
    fetched: DataFrame,
    out: str,
    checkpoint: str,
    runs: str,
    every: str | None = None,
    absolute_only: bool = True,
) -> StreamingQuery:
    """Run the page job on each micro-batch of fetched pages, once per article and day.

    Pages that were not fetched land with an empty text, so they count as done.
    """
    spark = fetched.sparkSession
    articles = T.StructType.fromDDL("article_id string, text string, ymd string, run string")
    ensure_table(spark, f"{out}/articles", articles, BY_RUN)

    def handle(batch: DataFrame, batch_id: int) -> None:
        run = run_label(batch_id)
        days = batch_days(batch, F.col("ymd"))
        landed = landed_before(spark, f"{out}/articles", articles, run, days)
        process_pages(new_pages(batch, landed), out, run, runs, absolute_only)

    return start(fetched, handle, checkpoint, "append", every)


def upsert_counts(
    counts: DataFrame, path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Write the groups that each micro-batch changed, one partition per run."""
    ensure_table(counts.sparkSession, path, _with_run(counts.schema), ("run",))

    def handle(batch: DataFrame, batch_id: int) -> None:
        write_dated(batch.withColumn("run", F.lit(run_label(batch_id))), path, ("run",))

    return start(counts, handle, checkpoint, "update", every)


def latest_counts(stored: DataFrame, keys: list[str], value: str = "n") -> DataFrame:
    """Last written value of each group."""
    newest: Column = F.max_by(value, F.col("run").cast("bigint")).alias(value)
    return stored.groupBy(*keys).agg(newest)
