"""Small list files: feed file lists, id lists, domain whitelists."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


def _strip(text: Column | str) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def file_urls(lines: DataFrame, line: str = "value") -> DataFrame:
    """Last blank-separated token of each non-blank line, as ``url``."""
    return lines.select(_strip(line).alias("line")).where("line <> ''").select(
        F.regexp_extract("line", r"\S+$", 0).alias("url")
    )


def read_file_list(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Landed master lists or last-update lists as ``(url)``."""
    return file_urls(spark.read.text(paths))


def read_id_list(spark: SparkSession, paths: str | list[str], column: str = "gkgid") -> DataFrame:
    """One-column id files with a header, blanks stripped, duplicates left out."""
    schema = T.StructType([T.StructField(column, T.StringType())])
    ids = spark.read.schema(schema).csv(paths, sep="\t", header=True, quote="")
    return ids.select(_strip(column).alias(column)).where(F.col(column) != "").distinct()


def read_whitelist(spark: SparkSession, path: str) -> DataFrame:
    """``(line)`` of a whitelist file, blanks stripped, empty lines left out."""
    return spark.read.text(path).select(_strip("value").alias("line")).where("line <> ''")
