"""Interpolated modified Kneser-Ney probabilities of n-grams, as DataFrame joins.

Chen and Goodman's estimate: the highest order uses counts, lower orders the number of
distinct n-grams that continue them, each with three discounts from its counts of counts.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from newsflow.llm.common import stored


def _discounts(grams: DataFrame, group: str) -> DataFrame:
    """Discounts of counts one, two, and more, per group; 0.5, 1, 1.5 where undefined."""
    n = [F.sum(F.when(F.col("c") == i, 1).otherwise(0)).alias(f"n{i}") for i in (1, 2, 3, 4)]
    counts = grams.groupBy(group).agg(*n)
    y = F.try_divide(F.col("n1"), F.col("n1") + 2 * F.col("n2"))

    def discount(i: int) -> Column:
        value = i - (i + 1) * y * F.try_divide(F.col(f"n{i + 1}"), F.col(f"n{i}"))
        return F.when((value > 0) & (value < i), value).otherwise(F.lit(i / 2)).alias(f"d{i}")

    return counts.select(F.col(group).alias("_group"), *(discount(i) for i in (1, 2, 3)))


def _discounted(grams: DataFrame, *group: str) -> DataFrame:
    """Adds d (this count's discount), total and freed (what its context gives away).

    ``grams`` has the discounts d1, d2, d3 of its rows.
    """
    context = Window.partitionBy(*group, "context")
    d = F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3"))
    return (
        # by context: left to joins before, all n-grams of a group would meet in one task
        grams.repartition(*group, "context")
        .withColumn("d", F.when(F.col("c") > 0, d).otherwise(F.lit(0.0)))
        .withColumn("total", F.sum("c").over(context))
        .withColumn("freed", F.sum("d").over(context))
    )


def probabilities(counts: DataFrame, order: int, group: str = "group") -> DataFrame:
    """group, gram, p for ``counts`` (group, gram of ``order`` characters, c)."""
    levels = [counts.select(group, "gram", "c")]
    for _ in range(order - 1):
        above = levels[-1]
        levels.append(
            above.groupBy(group, F.expr("substring(gram, 2)").alias("gram")).agg(F.count("*").alias("c"))
        )
    lower: DataFrame | None = None
    for size, level in enumerate(reversed(levels), start=1):
        level = level.withColumn("context", F.substring("gram", 1, size - 1))
        level = level.join(_discounts(level, group), F.col(group) == F.col("_group"))
        level = _discounted(level, group)
        if lower is None:
            alphabet = Window.partitionBy(group)
            base = level.withColumn("below", 1.0 / (F.count("*").over(alphabet) + 1))
        else:
            shorter = lower.select(
                F.col(group).alias("_lower"), F.col("gram").alias("_gram"), F.col("p").alias("below")
            )
            base = level.join(
                shorter,
                (F.col(group) == F.col("_lower")) & (F.expr("substring(gram, 2)") == F.col("_gram")),
            )
        p = (F.col("c") - F.col("d") + F.col("freed") * F.col("below")) / F.col("total")
        lower = stored(base.select(group, "gram", p.alias("p")), f"order-{size}")
    return lower


def class_probabilities(shared: DataFrame, classes: DataFrame, order: int, names: list[str]) -> DataFrame:
    """gram, and in each class its count, p_ (its probability, backed off to what the
    classes share) and total_ (the count of its context).

    ``shared`` has the probability p of every n-gram, counted on all texts; ``classes`` has
    gram and one count column per class for the n-grams that labelled texts use. In each
    class the discounted mass of a context goes to the shared probability, so n-grams that
    a class has rarely or never seen are judged by the counts that the classes share.
    """
    rows = shared.select("gram", F.col("p").alias("shared"))
    rows = rows.join(classes.select("gram", *names), "gram", "left")
    rows = rows.withColumn("context", F.substring("gram", 1, order - 1))
    for name in names:
        own = rows.withColumn("c", F.coalesce(F.col(name), F.lit(0)))
        discounts = _discounts(own.select("c", F.lit(name).alias("_class")), "_class")
        own = own.withColumns({d: discounts.select(d).scalar() for d in ("d1", "d2", "d3")})
        own = _discounted(own).withColumn(
            f"p_{name}",
            F.coalesce(
                F.try_divide(F.col("c") - F.col("d") + F.col("freed") * F.col("shared"), F.col("total")),
                "shared",
            ),
        )
        own = own.withColumn(f"total_{name}", F.col("total"))
        rows = own.drop("c", "d", "d1", "d2", "d3", "total", "freed")
    columns = [column for name in names for column in (name, f"p_{name}", f"total_{name}")]
    return rows.select("gram", *columns).fillna(0, names)
