"""Run log: one row per job run with counts taken while the job writes."""

from collections.abc import Callable
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

RUNS_DDL = "kind string, started_at string, finished_at string, seconds double, message string"


def log_run(
    spark: SparkSession, path: str, kind: str, started: datetime, message: str
) -> None:
    """Append one row to the ``runs`` table."""
    finished = datetime.now(timezone.utc)
    row = (
        kind,
        f"{started:%Y-%m-%d %H:%M:%S}",
        f"{finished:%Y-%m-%d %H:%M:%S}",
        (finished - started).total_seconds(),
        message,
    )
    spark.createDataFrame([row], RUNS_DDL).coalesce(1).write.mode("append").json(path)


def write_observed(
    df: DataFrame,
    write: Callable[[DataFrame], None],
    runs_path: str,
    kind: str,
    **metrics: Column,
) -> dict:
    """Run a write once, collect metrics from the rows that pass through it, log the run.

    Where adaptive execution finds out that there is nothing to write it drops the observed
    plan, and no metrics come: the rows are then counted by a job of their own.
    """
    started = datetime.now(timezone.utc)
    seen = Observation(kind)
    counted = [F.count(F.lit(1)).alias("rows"), *[column.alias(name) for name, column in metrics.items()]]
    write(df.observe(seen, *counted))
    try:
        found = dict(seen.get)
    except (AssertionError, Py4JJavaError) as missing:
        if isinstance(missing, Py4JJavaError) and "java.lang.AssertionError" not in str(missing.java_exception):
            raise
        found = df.agg(*counted).first().asDict()
    found = {name: 0 if value is None else value for name, value in found.items()}
    message = "; ".join(f"{name}: {value}" for name, value in found.items())
    log_run(df.sparkSession, runs_path, kind, started, message)
    return found
