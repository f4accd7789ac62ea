"""Exact dedup: one document of each group of byte-equal texts stays.

Documents are grouped by the 128-bit MD5 of their text. The least and the greatest text
of a group are compared byte by byte: if they are equal, all texts between them are. The
aggregate combines within each task first, so a group with a third of all rows sends one
row per task. Groups that fail the comparison (a hash collision) are grouped again by the
text itself.
"""

from pyspark.sql import Column, DataFrame, functions as F

from newsflow.llm.common import stored, whole_text


def content_hash(text: Column) -> Column:
    """The 128-bit hash of a text, as 16 bytes."""
    return F.unhex(F.md5(text.cast("binary")))


def _keeper(doc_id: Column, keep: str) -> Column:
    return F.max(doc_id) if keep == "largest" else F.min(doc_id)


def copy_groups(docs: DataFrame, keep: str = "largest", hashed=content_hash) -> DataFrame:
    """Groups of equal texts: key, keep_id, group_size, and text for groups that collide.

    ``text`` is null unless different texts share a key; then each text has its own row.
    """
    rows = docs.select("doc_id", whole_text().alias("text")).withColumn("key", hashed(F.col("text")))
    compared = stored(
        rows.groupBy("key")
        .agg(
            _keeper(F.col("doc_id"), keep).alias("keep_id"),
            F.count("*").alias("group_size"),
            F.min("text").alias("least"),
            F.max("text").alias("greatest"),
        )
        .select("key", "keep_id", "group_size", (F.col("least") == F.col("greatest")).alias("equal")),
        "copy-groups",
    )
    groups = compared.where("equal").select(
        "key", "keep_id", "group_size", F.lit(None).cast("string").alias("text")
    )
    collided = compared.where("NOT equal").select("key")
    if collided.isEmpty():
        return groups
    exact = (
        rows.join(collided, "key", "left_semi")
        .groupBy("key", "text")
        .agg(_keeper(F.col("doc_id"), keep).alias("keep_id"), F.count("*").alias("group_size"))
    )
    return groups.unionByName(exact.select(groups.columns))


def exact_dedup(docs: DataFrame, keep: str = "largest", hashed=content_hash) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    ``keep`` names the row of a group that stays: the ``largest`` or the ``smallest``
    doc_id. A null text is the empty text; empty texts equal each other. Rows without a
    doc_id are counted, and stay only in groups where no row has one. Rows that repeat
    both doc_id and text each get their result, all of them kept or none. Other columns
    are not looked at. An empty table gives no rows.
    """
    groups = copy_groups(docs, keep, hashed)
    text = whole_text()
    rows = docs.select(
        "doc_id",
        hashed(text).alias("key"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("sha256"),
        text.alias("text"),
    )
    same = F.col("d.key") == F.col("g.key")
    if groups.where("text IS NOT NULL").isEmpty():
        rows = rows.drop("text")
    else:
        same = same & F.coalesce(F.col("d.text") == F.col("g.text"), F.lit(True))
    return (
        rows.alias("d")
        .join(groups.alias("g"), same)
        .select(
            "d.doc_id",
            "g.keep_id",
            "g.group_size",
            F.col("d.doc_id").eqNullSafe(F.col("g.keep_id")).alias("kept"),
            F.lower(F.hex("d.sha256")).alias("text_sha256"),
        )
    )


def without_copies(docs: DataFrame, keep: str = "largest") -> DataFrame:
    """The documents that exact dedup keeps, with all their columns and one row each."""
    kept = exact_dedup(docs, keep).where("kept").select(
        F.col("doc_id").alias("_id"), F.unhex("text_sha256").alias("_sha256")
    )
    rows = docs.withColumn("_sha", F.unhex(F.sha2(whole_text().cast("binary"), 256)))
    matched = rows.join(
        kept.dropDuplicates(["_id", "_sha256"]),
        F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_sha") == F.col("_sha256")),
        "left_semi",
    )
    once = F.row_number().over(_one_row_each())
    return matched.withColumn("_row", once).where("_row = 1").select(*docs.columns)


def _one_row_each():
    from pyspark.sql import Window

    return Window.partitionBy("doc_id", "_sha").orderBy(F.lit(1))
