"""Merkle manifest of a dataset: a tree per group of rows, and a tree over the groups.

Leaves are digests of rows, so only digests are shuffled. A group's leaves are numbered in
the order of their key; every three consecutive nodes have one parent. A level is one
aggregate over parents: conditional maxima spread the children into slot columns, the
columns together give the parent's digest, and the columns without the own slot are a
child's siblings. Paths are then handed down level by level, each a join of the children
with their parents.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from newsflow.llm.common import session_of, stored

FANOUT = 3
SLOTS = [f"slot{i}" for i in range(FANOUT)]
PATH = "array<struct<before: string, after: string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of parts put together; null parts are left out."""
    return F.sha2(F.concat_ws("", *parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the length in UTF-8 bytes, a colon, and the value as text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(*columns: Column) -> Column:
    """The digest of a row: its fields with their lengths, so no two rows read alike."""
    return digest(*map(field, columns))


def numbered(rows: DataFrame, group: str, *order: str) -> DataFrame:
    """Rows with ``idx``, their place in their group from 0, and ``n``, the group's size.

    Rows are sorted over all tasks by range, and the places come from the row counts of
    (task, group), so a group may be of any size. ``group`` must not be null.
    """
    by = [group, *(F.col(name).asc_nulls_first() for name in order)]
    placed = stored(
        rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_row", F.monotonically_increasing_id()),
        "sorted",
    )
    counts = stored(
        placed.groupBy(F.shiftright("_row", 33).alias("_task"), group).agg(
            F.count("*").alias("_rows"), F.min("_row").alias("_first")
        ),
        "row-counts",
    )
    own = Window.partitionBy(group)
    before = own.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_task",
        group,
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_rows").over(own).alias("n"),
    )
    return (
        placed.withColumn("_task", F.shiftright("_row", 33))
        .join(offsets, ["_task", group])
        .withColumn("idx", F.col("_row") + F.col("_shift"))
        .drop("_task", "_row", "_shift")
    )


def levels(nodes: DataFrame) -> list[DataFrame]:
    """The levels of many trees, from ``nodes`` (tree, idx, h, n) up to their tops.

    ``n`` is the number of a tree's nodes on the level. Upper levels have their children's
    digests in slot columns.
    """
    found = [nodes]
    widest = nodes.agg(F.max("n")).first()[0] or 0
    while widest > 1:
        slot = F.pmod("idx", F.lit(FANOUT))
        runs = (
            found[-1]
            .where("n > 1")
            .groupBy("tree", F.expr(f"idx div {FANOUT}").alias("idx"))
            .agg(
                *(F.max(F.when(slot == i, F.col("h"))).alias(name) for i, name in enumerate(SLOTS)),
                F.max("n").alias("below"),
            )
        )
        width = F.ceil(F.col("below") / FANOUT).alias("n")
        found.append(stored(runs.select("tree", "idx", *SLOTS, digest(*map(F.col, SLOTS)).alias("h"), width), "level"))
        widest = -(-widest // FANOUT)
    return found


def tops(found: list[DataFrame]) -> DataFrame:
    """The top node of each tree: tree, h."""
    top = found[0].where("n = 1").select("tree", "h")
    for level in found[1:]:
        top = top.unionByName(level.where("n = 1").select("tree", "h"))
    return top


def _siblings(slot: Column) -> Column:
    """The slot columns before and after the own one."""
    def those(chosen) -> Column:
        return F.concat_ws("", *(F.when(chosen(F.lit(i), slot), F.col(f"up.{name}")) for i, name in enumerate(SLOTS)))

    before, after = those(lambda i, s: i < s), those(lambda i, s: i > s)
    return F.array(F.struct(before.alias("before"), after.alias("after")))


def _with_paths(level: DataFrame, above: DataFrame | None, top: DataFrame) -> DataFrame:
    """Rows of a level with the path to the root of all, from the level above or the tree's top."""
    ends = level.where("n = 1").join(top.select("tree", "path", "subroot"), "tree")
    if above is None:
        return ends
    up = above.select("tree", F.col("idx").alias("_up"), *SLOTS, "path", "subroot").alias("up")
    inner = level.where("n > 1").alias("own").join(
        up, (F.col("own.tree") == F.col("up.tree")) & (F.expr(f"own.idx div {FANOUT}") == F.col("up._up"))
    )
    slot = F.pmod("own.idx", F.lit(FANOUT))
    path = F.concat(_siblings(slot), F.col("up.path")).alias("path")
    return inner.select(*(f"own.{c}" for c in level.columns), path, "up.subroot").unionByName(
        ends.select(*level.columns, "path", "subroot")
    )


def paths(found: list[DataFrame], top: DataFrame) -> DataFrame:
    """The nodes that the trees began with, and ``path``: from each node to the end of its
    tree's own path in ``top`` (tree, path, subroot)."""
    above = None
    for level in reversed(found[1:]):
        above = _with_paths(level, above, top)
    return _with_paths(found[0], above, top)


def manifest(
    docs: DataFrame,
    columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    key: str = "doc_id",
    group: str = "source",
    extra: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row per document: ``key``, ``leaf``, ``subroot``, ``root``, ``path``, and ``extra``.

    ``leaf`` is the digest of ``columns``. Leaves of a group ascend by ``key``, nulls first;
    rows with equal keys come in the order of their digests, so rows that repeat are
    leaves of their own and the trees are the same on each run. A null group is a group,
    before all others; groups are ordered bytewise. ``path`` has for each level up to the
    root the digests ``before`` and ``after`` the own one. ``extra`` are values computed
    from the row, such as the digest of another version of it. Other columns are not
    looked at. An empty table gives no rows.
    """
    session_of(docs)
    extra = dict(extra or {})
    name = F.col(group).cast("string")
    leaves = stored(
        docs.select(
            F.coalesce(F.concat(F.lit("s"), name), F.lit("-")).alias("_group"),
            F.col(key).alias("_key"),
            leaf_hash(*map(F.col, columns)).alias("h"),
            *(value.alias(f"_x_{alias}") for alias, value in extra.items()),
        ),
        "leaves",
    )
    placed = numbered(leaves, "_group", "_key", "h")
    groups = placed.where("idx = 0").select(F.lit(0).alias("_all"), "_group")
    trees = stored(numbered(groups, "_all", "_group").select("_group", F.col("idx").alias("tree"), "n"), "trees")
    leaves = stored(placed.join(trees.drop("n"), "_group").drop("_group"), "numbered-leaves")
    below = levels(leaves)
    subroots = stored(
        tops(below).join(trees, "tree").select(F.lit(0).alias("tree"), F.col("tree").alias("idx"), "h", "n"),
        "subroots",
    )
    above = levels(subroots)
    root = tops(above).select("tree", F.expr(f"cast(array() AS {PATH})").alias("path"), F.col("h").alias("subroot"))
    by_group = stored(
        paths(above, root).select(
            F.col("idx").alias("tree"), "path", F.struct(F.col("h").alias("own"), F.col("subroot").alias("all")).alias("subroot")
        ),
        "group-paths",
    )
    return paths(below, by_group).select(
        F.col("_key").alias(key),
        F.col("h").alias("leaf"),
        F.col("subroot.own").alias("subroot"),
        F.col("subroot.all").alias("root"),
        "path",
        *(F.col(f"_x_{alias}").alias(alias) for alias in extra),
    )


def proof_hash(path: Column) -> Column:
    """The digest of all siblings on a path, level by level, left to right."""
    return digest(F.array_join(F.transform(path, lambda p: F.concat(p["before"], p["after"])), ""))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path give."""
    return F.aggregate(path, leaf, lambda h, p: digest(p["before"], h, p["after"]))
