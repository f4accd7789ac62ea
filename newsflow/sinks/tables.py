"""Date-partitioned Parquet tables and the Parquet copy of landed extracts."""

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from newsflow.functions.dates import partition_columns, strict_date


def add_partitions(df: DataFrame, ymd: str = "ymd") -> DataFrame:
    """Add ``year`` and ``month`` (text) next to a ``YYYYMMDD`` column."""
    year, month, day = partition_columns(strict_date(F.col(ymd)))
    return df.withColumns({"year": year, "month": month, "ymd": day})


def write_dated(
    df: DataFrame,
    path: str,
    by: tuple[str, ...] = ("year", "month", "ymd"),
    mode: str = "overwrite",
    rebalance: bool = True,
) -> None:
    """Write a Parquet table laid out by date; ``overwrite`` replaces only the days in ``df``.

    The rebalance hint lets adaptive execution merge small days into few files and split
    a hot day over many tasks, whatever share of the rows it holds. It costs a shuffle:
    leave it out for wide rows whose tasks hold one or two days anyway.
    """
    laid_out = df.hint("rebalance", *[F.col(c) for c in by]) if rebalance else df
    (
        laid_out.write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def _matching(spark: SparkSession, pattern: str) -> tuple:
    """The file system of a path pattern and the folders that match it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return system, [status.getPath() for status in system.globStatus(path) or []]


def clear(spark: SparkSession, pattern: str) -> None:
    """Remove the partition folders that a path pattern names.

    A job clears what it is about to write: an overwrite by the rows at hand leaves the
    partitions for which a second run has no rows.
    """
    system, folders = _matching(spark, pattern)
    for folder in folders:
        system.delete(folder, True)


def day_runs(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """The runs of each day of a table laid out by ``ymd`` and ``run``: folder names only."""
    found: dict[str, list[str]] = {}
    for folder in _matching(spark, f"{path.rstrip('/')}/ymd=*/run=*")[1]:
        day, run = (part.getName().split("=", 1)[1] for part in (folder.getParent(), folder))
        found.setdefault(day, []).append(run)
    return found


def read_days(spark: SparkSession, path: str, schema: T.StructType, days: list[str]) -> DataFrame:
    """Some days of a table laid out by ``ymd`` first. No other folder is listed."""
    found = [f for day in days for f in _matching(spark, f"{path.rstrip('/')}/ymd={day}")[1]]
    if not found:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).option("basePath", path)
    return reader.parquet(*[folder.toString() for folder in found])


def one_run(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Of rows that several runs have landed for a key, those of the greatest run."""
    newest = rows.groupBy(*keys).agg(F.max("run").alias("run"))
    return rows.join(newest, [*keys, "run"], "left_semi")


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int, mode: str = "overwrite") -> None:
    """Write a Parquet table whose files are dealt by a key, so that joins need no shuffle.

    ``append`` adds files to the buckets. The session's catalog is left as it was.
    """
    name = _BUCKETED + uuid.uuid4().hex
    spark = df.sparkSession
    try:
        if mode == "append":
            _register(spark, name, path, df.schema, key, buckets)
            df.select(*spark.table(name).columns).write.mode(mode).insertInto(name)
        else:
            writer = df.write.format("parquet").mode(mode).option("path", path)
            writer.bucketBy(buckets, key).saveAsTable(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def read_bucketed(
    spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int
) -> DataFrame:
    """A table of ``write_bucketed``, with the layout it was written in.

    Aggregates and joins by ``key`` of tables with as many buckets are planned without an
    exchange. The table is in the catalog for the time of the call only.
    """
    name = _BUCKETED + uuid.uuid4().hex
    _register(spark, name, path, schema, key, buckets)
    try:
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")


_BUCKETED = "newsflow_bucketed_"


def _register(
    spark: SparkSession, name: str, path: str, schema: T.StructType, key: str, buckets: int
) -> None:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    # A table with a location is external: dropping it leaves the files.
    location = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) INTO {buckets} BUCKETS "
        f"LOCATION '{location}'"
    )


def land_extract(df: DataFrame, path: str, batch: str = "batch") -> None:
    """Keep a landed extract as Parquet laid out by the day and label of its batch.

    Text is not splittable once compressed and has to be parsed in full on each read;
    after this step later jobs prune columns and days. Landing a batch again replaces it
    and leaves the other batches of its day alone.
    """
    dated = df.withColumn("ymd", F.substring(F.col(batch), 1, 8))
    # A file holds one batch already: no shuffle.
    write_dated(add_partitions(dated), path, ("year", "month", "ymd", batch), rebalance=False)
