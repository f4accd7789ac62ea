"""The batch jobs: landing, merging, page processing, monthly reports, backfills.

Every output is laid out by day and run and overwritten by day and run, so a job that
is run again replaces its own rows and nothing else.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from newsflow import schemas
from newsflow.functions.dates import batch_digits, check_ymd
from newsflow.operators import docs, entities, manifest, merge, pages, stats
from newsflow.sinks import files, search
from newsflow.sinks.runlog import write_observed
from newsflow.sinks.tables import clear, land_extract, one_run, write_dated
from newsflow.sources import archives, extracts, layout

BY_RUN = ("ymd", "run")


def process_tree(
    spark: SparkSession,
    root: str,
    suffix: str,
    read: Callable[..., DataFrame],
    transform: Callable[[DataFrame], DataFrame],
    write: Callable[[DataFrame], None],
) -> None:
    """Read every file of a tree with a suffix, apply a user transform, write the result."""
    write(read(spark, root, **layout.tree_options(suffix)).transform(transform))


FEEDS = {
    "export": ("events", schemas.EVENTS, extracts.read_events),
    "gkg": ("gkg", schemas.ENTITIES, extracts.read_entities),
}


def land_files(
    spark: SparkSession, paths: str | list[str], kind: str, out: str, runs: str, **options: str
) -> dict:
    """Plain or gzip extracts of one feed -> its Parquet table by day and batch."""
    name, _, read = FEEDS[kind]
    named = read(spark, paths, **options).withColumn(
        "batch", batch_digits(F.col("_metadata.file_name"))
    )
    return write_observed(
        named,
        lambda df: land_extract(df, f"{out}/{name}"),
        runs,
        f"land {name}",
        bad_lines=F.count(schemas.CORRUPT),
    )


def land_archives(
    spark: SparkSession, paths: str | list[str], out: str, runs: str, encoding: str = "UTF-8"
) -> dict:
    """Zip archives of both feeds -> Parquet tables ``events`` and ``gkg`` by day and batch.

    Broken archives are counted in the run log and skipped whole: what they would replace
    stays as it is.
    """
    found = {}
    for kind, (name, schema, _) in FEEDS.items():
        # Chosen by archive name, so each archive is opened for one of the two only.
        lines = archives.read_zip_lines(spark, paths, encoding, pathGlobFilter=f"*.{kind}.*")
        batch = batch_digits(F.col("file_name")).alias("batch")
        parsed = extracts.parse_lines(lines, "line", schema, batch, "error")

        def land(df: DataFrame, name: str = name) -> None:
            land_extract(df.where(F.col("error").isNull()).drop("error"), f"{out}/{name}")

        found[name] = write_observed(
            parsed,
            land,
            runs,
            f"land {name}",
            bad_lines=F.count(schemas.CORRUPT),
            bad_archives=F.count("error"),
        )
    return found


def merge_day(events: DataFrame, records: DataFrame, ymd: str) -> DataFrame:
    """``(url, eventid, gkgid)`` of one landed day; both tables are pruned to that day."""
    check_ymd(ymd)

    def pairs(df: DataFrame, record_id: str, url: str) -> DataFrame:
        day = layout.in_range(df, ymd, ymd)
        return day.select(F.col(record_id).alias("id"), F.col(url).alias("url"), "batch")

    return merge.merge_url_ids(
        pairs(events, schemas.EVENT_ID, schemas.EVENT_URL),
        pairs(records, schemas.ENTITY_ID, schemas.ENTITY_URL),
    )


def day_is_complete(landed: DataFrame, ymd: str) -> DataFrame:
    """Completeness rows of one day of a landed-file manifest."""
    wanted = manifest.without_mentions(manifest.for_date(landed, ymd))
    return manifest.completeness(wanted)


PAGE_TABLES = ("articles", "page_links", "page_domains", "html_meta", "article_stats")


def process_pages(
    fetched: DataFrame,
    out: str,
    run: str,
    runs: str,
    absolute_only: bool = True,
    replace_day: str | None = None,
) -> dict:
    """Parse pages once and write the five page tables of a run.

    What the run has written before is removed first, or with ``replace_day`` what any run
    has written for that day, so nothing stale stays where there are fewer pages now.

    ``fetched`` holds one row per article (see ``pages.one_per_article``).
    The parsed rows are written first and read back: the tables are then column
    projections of a Parquet table, HTML is not parsed again for each of them, and a
    lost executor costs a read instead of a parse.
    """
    spark = fetched.sparkSession
    staged = f"{out}/_parsed/{run}"
    parsed = pages.parse_pages(fetched, absolute_only)
    ok = F.col("status") == stats.OK_STATUS
    found = write_observed(
        parsed,
        lambda df: df.write.mode("overwrite").parquet(staged),
        runs,
        f"pages {run}",
        n_fetched=F.sum(ok.cast("int")),
        n_chars=F.sum("nbytes"),
    )
    stored = spark.read.schema(parsed.schema).parquet(staged)
    tables = {
        "articles": pages.articles(stored),
        "page_links": pages.links(stored),
        "page_domains": pages.domains(stored),
        "html_meta": pages.html_meta(stored),
        "article_stats": pages.article_stats(stored).withColumn("ymd", F.col("accessdate")),
    }
    for name, table in tables.items():
        clear(spark, f"{out}/{name}/ymd={replace_day}/run=*" if replace_day else f"{out}/{name}/ymd=*/run={run}")
        write_dated(table.withColumn("run", F.lit(run)), f"{out}/{name}", BY_RUN, rebalance=False)
    clear(spark, staged)
    return found


def monthly_whitelisted(article_stats: DataFrame, whitelist: list[str], out: str) -> None:
    """Whitelisted articles of all months in one job, one directory per month."""
    files.write_monthly(stats.whitelisted_articles(article_stats, whitelist), out, "overwrite")


def article_entity_report(
    article_stats: DataFrame, records: DataFrame, whitelist: list[str], how: str = "left"
) -> DataFrame:
    """Flags of whitelisted articles joined with their processed entity records.

    The whitelist filter sits below the join, so only chosen articles are shuffled.
    """
    chosen = article_stats.where(stats.whitelist_match(F.col("domain"), whitelist))
    return entities.article_entities(
        stats.article_flags(chosen), entities.process_entities(records), how
    )


def backfill_domains(
    article_stats: DataFrame, links: DataFrame, out: str, first: str, last: str | None = None
) -> None:
    """Rebuild per-page domain counts from stored links for a range of days."""
    rebuilt = pages.rebuild_domains(
        layout.in_range(article_stats, first, last), layout.in_range(links, first, last)
    )
    spark = article_stats.sparkSession
    last_day = check_ymd(last) if last else None
    days = layout.day_folders(spark, out)
    for day in days:
        if day >= f"{check_ymd(first):%Y%m%d}" and (last_day is None or day <= f"{last_day:%Y%m%d}"):
            clear(spark, f"{out}/ymd={day}")
    write_dated(rebuilt, out, ("ymd",))


def index_documents(
    article_stats: DataFrame, articles: DataFrame, out: str, index: str, ymd: str
) -> None:
    """Bulk search documents of one day."""
    day_stats, day_texts = (layout.in_range(rows, ymd, ymd) for rows in (article_stats, articles))
    if "run" in day_texts.columns:
        day_texts = one_run(day_texts, ["ymd", "article_id"])
    day_docs = docs.search_docs(day_stats, day_texts)
    search.write_bulk(day_docs, out, index)


def backfill_day(
    events: DataFrame, records: DataFrame, fetched: DataFrame, out: str, runs: str, ymd: str
) -> dict:
    """Re-run one day: merge its records, take the day's pages, replace its page tables.

    ``fetched`` holds ``(url, ymd, status, html)``. The day's rows of all earlier runs are
    replaced, so each article of the day is there once.
    """
    day_pages = layout.in_range(fetched, ymd, ymd).join(merge_day(events, records, ymd), "url")
    once = pages.one_per_article(day_pages)
    return process_pages(once, out, f"backfill-{ymd}", runs, replace_day=ymd)
