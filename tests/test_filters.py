"""Bloom filters per landed day."""

import re

from pyspark.sql import functions as F

from newsflow.operators import docs, filters
from newsflow.sinks.tables import write_dated

SCHEMA = "k bigint, v string, ymd string"


def landed_days(spark, folder, days=6, a_day=3000):
    rows = spark.range(days * a_day).select(
        F.col("id").alias("k"), F.lit("x").alias("v"), F.format_string("2024010%d", 1 + F.floor(F.col("id") / a_day)).alias("ymd")
    )
    write_dated(rows.union(rows.limit(50)), f"{folder}/landed", ("ymd",))
    kept = spark.read.schema(SCHEMA).parquet(f"{folder}/landed")
    filters.write_filters(kept, f"{folder}/filters", ["k"])
    return kept, spark.read.schema(filters.FILTERS).parquet(f"{folder}/filters")


def test_no_key_is_missed_and_few_are_mistaken(spark, folder):
    kept, made = landed_days(spark, folder)
    probe = spark.range(0, 60_000).select(F.col("id").alias("k"))
    found = filters.days_that_may_hold(probe, made, ["k"])
    assert kept.select("k", "ymd").distinct().exceptAll(found).count() == 0
    mistaken = found.count() - 18_000
    assert 0 < mistaken < 0.02 * (6 * 60_000 - 18_000)
    assert not re.search(
        "CartesianProduct|BroadcastNestedLoopJoin|Python", found._jdf.queryExecution().executedPlan().toString()
    )


def test_unseen_reads_only_days_that_may_hold_a_key(spark, folder):
    kept, made = landed_days(spark, folder)
    new = spark.createDataFrame([(10, "a"), (10, "b"), (7000, "c"), (10**9, "d"), (None, "e")], "k bigint, w string")
    found = filters.unseen_by_filters(spark, new, f"{folder}/landed", kept.schema, made, ["k"], f"{folder}/probed")
    assert sorted(r.w for r in found.collect()) == ["d", "e"]
    assert found.collect() == docs.unseen(new, kept, ["k"]).collect()
    days = {r.ymd for r in spark.read.parquet(f"{folder}/probed").collect()}
    assert {"20240101", "20240103"} <= days and len(days) < 6
    landed = [name for name in found.inputFiles() if "/landed/" in name]
    assert {re.search(r"ymd=(\d+)", name)[1] for name in landed} == days


def test_filters_of_odd_tables(spark, folder):
    rows = spark.createDataFrame(
        [(1, "x", "20240101"), (None, "x", "20240101"), (1, "x", "20240101"), (2, "x", None), (None, None, "20240102")], SCHEMA
    )
    made = filters.daily_filters(rows, ["k", "v"])
    assert [(r.ymd, r.lg) for r in made.collect()] == [("20240101", 0)]
    probe = spark.createDataFrame([(1, "x"), (1, None), (3, "y")], "k bigint, v string")
    found = filters.days_that_may_hold(probe, made, ["k", "v"]).collect()
    assert (1, "x", "20240101") in [tuple(r) for r in found] and all(r.v is not None for r in found)
    none = filters.daily_filters(rows.limit(0), ["k"])
    assert none.count() == 0 and filters.days_that_may_hold(probe, none, ["k"]).count() == 0
    empty = f"{folder}/nothing"
    left = filters.unseen_by_filters(spark, probe, empty, rows.schema, none, ["k"], f"{folder}/probed")
    assert left.count() == 3


def test_a_day_is_replaced_or_dropped(spark, folder):
    day = spark.createDataFrame([(1, "x", "20240101")], SCHEMA)
    other = spark.createDataFrame([(2, "x", "20240102")], SCHEMA)
    path = f"{folder}/filters"
    filters.write_filters(day, path, ["k"])
    filters.write_filters(other, path, ["k"])
    filters.write_filters(day.withColumn("k", F.lit(5).cast("bigint")), path, ["k"])
    made = spark.read.schema(filters.FILTERS).parquet(path)
    assert made.count() == 2
    assert [r.ymd for r in filters.days_that_may_hold(day, made, ["k"]).collect()] in ([], ["20240102"])
    filters.drop_days(spark, path, ["20240101"])
    assert [r.ymd for r in spark.read.schema(filters.FILTERS).parquet(path).collect()] == ["20240102"]
