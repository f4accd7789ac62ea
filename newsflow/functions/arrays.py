"""Small helpers for row-local work on arrays."""

from collections.abc import Callable

from pyspark.sql import Column, functions as F


EMPTY_COUNTS_SQL = "cast(map() as map<string,bigint>)"


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it several times in ``body``.

    A lambda body re-evaluates outer expressions for each element; going through a
    one-element array makes the value a lambda variable, which is computed once.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def value_counts(values: Column) -> Column:
    """``array<string>`` -> ``map<string,bigint>`` of occurrences, nulls and '' left out.

    Sort, find the places where a new value starts, and subtract neighbouring
    places: n log n inside the row, so no explode and no shuffle.
    """

    def count_runs(ordered: Column) -> Column:
        n = F.size(ordered)
        starts = F.filter(
            F.sequence(F.lit(0), n - 1),
            lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1)),
        )
        return bind(
            starts,
            lambda s: F.map_from_entries(
                F.transform(
                    s,
                    lambda at, k: F.struct(
                        F.get(ordered, at).alias("key"),
                        (F.coalesce(F.get(s, k + 1), n) - at).cast("bigint").alias("value"),
                    ),
                )
            ),
        )

    kept = F.array_sort(F.filter(values, lambda v: v.isNotNull() & (v != "")))
    empty = F.expr(EMPTY_COUNTS_SQL)
    return bind(
        kept, lambda a: F.when(F.size(a) > 0, count_runs(a)).when(a.isNotNull(), empty)
    )
