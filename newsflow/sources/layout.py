"""The dated directory tree ``base/kind/YYYY/MM/YYYYMMDD/file`` and its listing."""

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from newsflow.functions.dates import check_ymd

# The kinds of data kept in the tree.
KINDS = (
    "article_stats", "articles", "events", "gkg", "html_meta", "page_domains", "page_links",
)


def date_path(base: str, kind: str, ymd: str) -> str:
    """Directory of one kind and day."""
    day = check_ymd(ymd)
    return f"{base.rstrip('/')}/{kind}/{day:%Y}/{day:%m}/{ymd}"


def date_paths(base: str, kind: str, first: str, last: str) -> list[str]:
    """Directories of a kind for each day of a range: pruning by path for foreign trees."""
    start, end = check_ymd(first), check_ymd(last)
    days: list[date] = [start + timedelta(n) for n in range((end - start).days + 1)]
    return [date_path(base, kind, f"{day:%Y%m%d}") for day in days]


def day_folders(spark: SparkSession, table: str) -> list[str]:
    """The days for which a table laid out by ``ymd`` has a folder. No file is listed."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{table.rstrip('/')}/ymd=*")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    return sorted(status.getPath().getName().removeprefix("ymd=") for status in found)


def list_files(spark: SparkSession, root: str, suffix: str = "") -> DataFrame:
    """``(path, name, kind, ymd, bytes)`` of all files below a directory.

    Files that start with a dot or an underscore are skipped. No file content is read.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", f"*{suffix}")
        .load(root)
    )
    dated = r"/([^/]+)/\d{4}/\d{2}/(\d{8})/[^/]*$"
    return files.select(
        "path",
        F.substring_index("path", "/", -1).alias("name"),
        F.nullif(F.regexp_extract("path", dated, 1), F.lit("")).alias("kind"),
        F.nullif(F.regexp_extract("path", dated, 2), F.lit("")).alias("ymd"),
        F.col("length").alias("bytes"),
    )


def tree_options(suffix: str) -> dict[str, str]:
    """Reader options that walk a tree and keep files with a suffix."""
    return {"recursiveFileLookup": "true", "pathGlobFilter": f"*{suffix}"}


def listed_dates(files: DataFrame) -> DataFrame:
    """Distinct days of a listing, per kind."""
    return files.where(F.col("ymd").isNotNull()).select("kind", "ymd").distinct()


def first_files(files: DataFrame) -> DataFrame:
    """First file name of each kind and day (smallest name, so always the same one)."""
    return files.where(F.col("ymd").isNotNull()).groupBy("kind", "ymd").agg(
        F.min("name").alias("first_name")
    )


def in_range(df: DataFrame, first: str | None = None, last: str | None = None) -> DataFrame:
    """Rows of a table whose partition column ``ymd`` lies in a range (partition pruning)."""
    if first is not None:
        df = df.where(F.col("ymd") >= F.lit(f"{check_ymd(first):%Y%m%d}"))
    if last is not None:
        df = df.where(F.col("ymd") <= F.lit(f"{check_ymd(last):%Y%m%d}"))
    return df
