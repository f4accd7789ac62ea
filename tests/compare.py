"""Compare a Spark result with a DuckDB result: names, types, and all rows in any order."""

import duckdb
import pyarrow as pa
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _normal(table: pa.Table) -> tuple[dict[str, str], list[tuple]]:
    names = sorted(table.column_names)
    types = {n: str(table.schema.field(n).type).replace("large_", "") for n in names}
    columns = [table.column(n).to_pylist() for n in names]
    rows = [tuple("" if v is None else f"={v}" for v in row) for row in zip(*columns)]
    return types, sorted(rows)


def differences(found: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    spark_types, spark_rows = _normal(found.toArrow())
    duck_types, duck_rows = _normal(connection.sql(sql).to_arrow_table())
    problems = []
    if spark_types != duck_types:
        problems.append(f"types {spark_types} != {duck_types}")
    if len(spark_rows) != len(duck_rows):
        problems.append(f"{len(spark_rows)} rows != {len(duck_rows)}")
    if not spark_rows:
        problems.append("no rows")
    for one, other in zip(spark_rows, duck_rows):
        if one != other:
            problems.append(f"first difference {str(one)[:300]} != {str(other)[:300]}")
            break
    return problems
