"""Each key once, remembered in a state store.

The anti-join of ``feed.land_once`` reads the landed days again in every micro-batch. Here
the keys that have passed are state of the stream: a lookup costs one read of the store for
each key of the micro-batch, whatever has landed before. A key is forgotten ``keep_days``
after its time, by event time, so the store is bounded by the keys of that many
days; rows that come later than that are left out, as their keys may be forgotten.
"""

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from newsflow.plans.jobs import BY_RUN
from newsflow.sinks.tables import write_dated

# The store that keeps state outside the heap.
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_STORE_CONF = "spark.sql.streaming.stateStore.providerClass"


def first_of_keys(rows: DataFrame, keys: list[str], ts: str, keep_days: int = 30) -> DataFrame:
    """The first row of each key of a stream. Which of a micro-batch's rows is first is not defined.

    ``ts`` is the time of a row; a first row without one fails the stream. Rows without a key
    value are a key of their own. Keys are looked up, kept and forgotten inside the JVM: a
    Python call for each key would be most of the work.
    """
    first = rows.withWatermark(ts, f"{keep_days} days").dropDuplicatesWithinWatermark(keys)
    return first.withColumn(ts, F.coalesce(ts, F.raise_error(F.lit(f"{ts} is null")).cast("timestamp")))


def land_first(
    rows: DataFrame, path: str, keys: list[str], ts: str, checkpoint: str, keep_days: int = 30, every: str | None = None
) -> StreamingQuery:
    """Land each key once, by state alone: landed tables are never read.

    The table has ``ymd`` and ``run``. A micro-batch that is run again starts from the state
    before it and overwrites its own partitions, so each key lands exactly once.
    """
    spark = rows.sparkSession

    def land(batch: DataFrame, batch_id: int) -> None:
        write_dated(batch.withColumn("run", F.lit(f"{batch_id:012d}")), path, BY_RUN)

    before = spark.conf.get(_STORE_CONF)
    spark.conf.set(_STORE_CONF, STORE)  # a query takes the setting when it starts
    try:
        writer = first_of_keys(rows, keys, ts, keep_days).writeStream.outputMode("append")
        writer = writer.option("checkpointLocation", checkpoint)
        writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
        return writer.foreachBatch(land).start()
    finally:
        spark.conf.set(_STORE_CONF, before)
