"""Zip archives of feed extracts."""

import io
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

_LINES_PER_BATCH = 5_000


def _members(path: str, content: bytes, encoding: str) -> list[tuple[str, str, str]]:
    """All lines of an archive, or one error: never the part of it that could be read."""
    found = []
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as archive:
            for member in archive.infolist():
                if member.is_dir():
                    continue
                # reads to the end, so the checksum is compared
                lines = io.StringIO(archive.read(member).decode(encoding), newline="\n")
                found += [(member.filename, line.rstrip("\r\n"), None) for line in lines]
    except (
        zipfile.BadZipFile, zlib.error, EOFError, OSError, NotImplementedError, RuntimeError, ValueError
    ) as error:
        return [(path.rsplit("/", 1)[-1], None, f"{type(error).__name__}: {error}")]
    return found


def unzip_lines(archives: DataFrame, encoding: str = "UTF-8") -> DataFrame:
    """``(path, content)`` archives -> ``(file_name, line, error)``, the lines of all members.

    One archive is one 15-minute batch, so a task holds one small archive at a time and
    hands its lines on in chunks. A broken archive, or one that is not in ``encoding``, gives
    one row with ``error`` set and none of its lines.
    """

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                rows = _members(path, content, encoding)
                for at in range(0, len(rows), _LINES_PER_BATCH):
                    chunk = rows[at : at + _LINES_PER_BATCH]
                    yield pd.DataFrame(chunk, columns=["file_name", "line", "error"])

    return archives.select("path", "content").mapInPandas(
        unpack, "file_name string, line string, error string"
    )


def read_zip_lines(
    spark: SparkSession, paths: str | list[str], encoding: str = "UTF-8", **options: str
) -> DataFrame:
    """``(file_name, line, error)`` of the zip archives at some paths."""
    return unzip_lines(spark.read.format("binaryFile").options(**options).load(paths), encoding)
