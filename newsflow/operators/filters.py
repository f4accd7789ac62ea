"""Bloom filters per landed day: which days may hold a key, without reading them.

A filter is a table of 64-bit words. A key has one word of each day, by its hash, and four
bits in it, so a filter is made by one aggregate (``bit_or``, combined before the shuffle)
and probed by an equi-join. No key is ever missed; about one in a hundred of the keys that a
day does not hold is taken for one that it may hold, and an exact join decides on those.
"""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from newsflow.sinks.tables import clear, read_days, write_dated

# A word for so many keys of a day on average: 16 bits a key.
KEYS_PER_WORD = 4
FILTERS = "lg int, word bigint, bits bigint, ymd string"


def _hash(keys: list[str]) -> Column:
    return F.xxhash64(*keys)


def _mask(hashed: Column) -> Column:
    """Up to four bits of a word, by the lowest 24 bits of a hash."""
    mask = F.lit(0).cast("bigint")
    for place in range(4):
        bit = F.shiftrightunsigned(hashed, 6 * place).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), bit))
    return mask


def _word(hashed: Column, lg: Column) -> Column:
    """A word of the ``2 ** lg`` of a day, by the other bits of a hash."""
    return F.shiftrightunsigned(hashed, 24).bitwiseAND(F.pow(F.lit(2.0), lg).cast("bigint") - 1)


def _known(keys: list[str]) -> Column:
    """A key with a null equals no other."""
    known = F.lit(True)
    for key in keys:
        known = known & F.col(key).isNotNull()
    return known


def daily_filters(rows: DataFrame, keys: list[str], ymd: str = "ymd") -> DataFrame:
    """``(lg, word, bits, ymd)``: the words of each day's filter that are not empty.

    A day has ``2 ** lg`` words, after an estimate of its distinct keys. Repeated keys are one.
    """
    hashed = rows.where(_known(keys) & F.col(ymd).isNotNull()).select(F.col(ymd).alias("ymd"), _hash(keys).alias("h"))
    words = F.greatest(F.approx_count_distinct("h") / KEYS_PER_WORD, F.lit(1.0))
    sizes = hashed.groupBy("ymd").agg(F.ceil(F.log2(words)).cast("int").alias("lg"))
    # One small row per day of the calendar.
    placed = hashed.join(F.broadcast(sizes), "ymd")
    return (
        placed.groupBy("ymd", "lg", _word(F.col("h"), F.col("lg")).alias("word"))
        .agg(F.bit_or(_mask(F.col("h"))).alias("bits"))
        .select("lg", "word", "bits", "ymd")
    )


def write_filters(rows: DataFrame, path: str, keys: list[str], ymd: str = "ymd") -> None:
    """Write the filters of the days in ``rows``, which have to be whole days, over earlier ones."""
    write_dated(daily_filters(rows, keys, ymd).sortWithinPartitions("word"), path, ("ymd",), rebalance=False)


def days_that_may_hold(new: DataFrame, filters: DataFrame, keys: list[str]) -> DataFrame:
    """``(*keys, ymd)``: for each distinct key the days whose filter has all its bits.

    Where ``ymd`` is one of the keys, only the filter of that day is asked.
    """
    # Numbers from 0 to 40: the sizes of filters, each of which has words of its own for a key.
    sizes = sorted(row.lg for row in filters.select("lg").distinct().collect())
    wanted = new.where(_known(keys)).select(*keys).distinct().withColumn("_h", _hash(keys))
    wanted = wanted.withColumn("_lg", F.explode(F.array(*map(F.lit, sizes)).cast("array<int>")))
    wanted = wanted.withColumns({"_word": _word(F.col("_h"), F.col("_lg")), "_mask": _mask(F.col("_h"))})
    same = (F.col("_lg") == F.col("lg")) & (F.col("_word") == F.col("word"))
    hit = F.col("bits").bitwiseAND(F.col("_mask")) == F.col("_mask")
    if "ymd" in keys:
        same = same & (F.col("ymd") == F.col("_day"))
    found = wanted.join(filters.select("lg", "word", "bits", F.col("ymd").alias("_day")), same & hit)
    return found.select(*[key for key in keys if key != "ymd"], F.col("_day").alias("ymd"))


def unseen_by_filters(
    spark: SparkSession,
    new: DataFrame,
    path: str,
    schema: T.StructType,
    filters: DataFrame,
    keys: list[str],
    working: str,
) -> DataFrame:
    """``docs.unseen`` against a table laid out by ``ymd`` that has filters for all its days.

    Only the days that may hold a key are read, and of them only the rows of such keys reach
    the anti join. ``working`` is a folder for the probed keys; it is replaced.
    """
    probed = days_that_may_hold(new, filters, keys)
    probed.write.mode("overwrite").parquet(working)
    maybe = spark.read.schema(probed.schema).parquet(working)
    days = sorted(row.ymd for row in maybe.select("ymd").distinct().collect())
    on = list(dict.fromkeys([*keys, "ymd"]))
    landed = read_days(spark, path, schema, days).select(*on)
    seen = landed.join(maybe.select(*on), on, "left_semi").select(*keys)
    return new.join(seen, keys, "left_anti")


def drop_days(spark: SparkSession, path: str, days: list[str]) -> None:
    """Remove the filters of days, before a run that may leave such a day without rows."""
    for day in days:
        clear(spark, f"{path.rstrip('/')}/ymd={day}")
