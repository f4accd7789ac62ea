"""Joins whose left side may hold a third of its rows under one key.

Three remedies, cheapest first:

* missing keys never match, so ``scatter_missing`` spreads them before the shuffle;
* plain equi-joins leave the streamed side to adaptive skew-join splitting;
* ``salted_join`` spreads hot keys by hand, where adaptive execution is off or the
  plan above the join keeps it from splitting.
"""

from pyspark.sql import Column, DataFrame, functions as F


def scatter_missing(key: Column, *spread: Column) -> Column:
    """The key; where it is NULL or '', a value that matches nothing and spreads by ``spread``.

    The spread is a hash of the row, not a random number, so a task that is run again
    sends each row to the same place.
    """
    text = key.cast("string")
    nowhere = F.concat(F.lit("\x00"), F.xxhash64(*spread).cast("string"))
    return F.when(text.isNull() | (text == ""), nowhere).otherwise(text)


def hot_keys(df: DataFrame, keys: list[str], share: float) -> DataFrame:
    """Keys with at least ``share`` of all rows: at most 1 / share of them, by arithmetic.

    Only the key columns are scanned, and counts are combined before the shuffle.
    """
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    least = df.agg((F.count(F.lit(1)) * share).alias("_least")).scalar()
    return counted.where(F.col("_n") >= least).drop("_n")


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    how: str = "left",
    share: float = 0.001,
    salts: int = 64,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Equi-join that splits the hot keys of ``left`` into ``salts`` parts.

    Only right rows under a hot key are repeated (``salts`` times); all other rows take
    salt 0. ``how`` is inner, left, left_semi or left_anti. NULL keys match nothing.
    ``hot`` takes hot keys found elsewhere, where ``left`` is costly to compute.
    """
    if hot is None:
        hot = hot_keys(left, keys, share)
    # Bounded by arithmetic: keys with a share of the rows are at most one by that share.
    hot = F.broadcast(hot.withColumn("_hot", F.lit(True)))
    spread = F.pmod(F.xxhash64(*left.columns), F.lit(salts)).cast("int")
    salted_left = left.join(hot, keys, "left").withColumn(
        "_salt", F.when(F.col("_hot"), spread).otherwise(0)
    )
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(
        F.array(F.lit(0))
    )
    salted_right = right.join(hot, keys, "left").withColumn("_salt", F.explode(copies)).drop("_hot")
    return salted_left.drop("_hot").join(salted_right, [*keys, "_salt"], how).drop("_salt")
