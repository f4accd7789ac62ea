"""Small helpers that the operators of this subpackage share."""

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from newsflow.plans.session import ship_package, working_folder


def session_of(frame: DataFrame) -> SparkSession:
    """The session of a frame, with this package sent to its Python workers."""
    ship_package(frame.sparkSession)
    return frame.sparkSession


def stored(frame: DataFrame, name: str) -> DataFrame:
    """Write a frame below the shared folder and read it again.

    This cuts the lineage: when executors are lost, later steps read the files again
    instead of running everything before them.
    """
    path = working_folder(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def each(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    """Rows of some columns, made one at a time: a batch of long texts is held once only."""
    return zip(*((value.as_py() for value in batch[name]) for name in names))


def whole_text(text: str = "text") -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(F.col(text), F.lit(""))
