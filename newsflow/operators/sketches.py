"""Distinct counts over any span of batches, from sketches kept per day and feed.

A day's theta sketch is made once, when the day lands, and written next to it. Counts over
many days merge the sketches and never read the rows again; a re-run day replaces its own.
"""

from pyspark.sql import DataFrame, functions as F

# Base-2 logarithm of a sketch's entries. Theta sketches err by 1 / sqrt(entries) at one
# standard deviation, so 2**14 entries by 0.8 percent, at about 130 KB a sketch.
LG_ENTRIES = 14


def daily_sketches(rows: DataFrame, key: str, *by: str, ymd: str = "ymd", lg_entries: int = LG_ENTRIES) -> DataFrame:
    """``(ymd, *by, n_rows, sketch)``: rows and a sketch of the distinct keys of each day and group.

    Null keys do not count. Partial sketches are merged before the shuffle.
    """
    known = rows.where(F.col(key).isNotNull())
    return known.groupBy(ymd, *by).agg(F.count(key).alias("n_rows"), F.theta_sketch_agg(key, lg_entries).alias("sketch"))


def merged_counts(sketches: DataFrame, *by: str, lg_entries: int = LG_ENTRIES) -> DataFrame:
    """``(*by, n_rows, n_distinct, n_duplicates)`` over all days of stored sketches.

    ``n_rows`` is exact, the others are estimates.
    """
    merged = sketches.groupBy(*by).agg(
        F.sum("n_rows").alias("n_rows"),
        F.theta_sketch_estimate(F.theta_union_agg("sketch", lg_entries)).alias("n_distinct"),
    )
    return merged.withColumn("n_duplicates", F.col("n_rows") - F.col("n_distinct"))
