"""Mixing sources to target weights by Pfair scheduling.

Time is cut into slots of one block. A source with weight w gets block i (from 0) released
at slot floor(i / w) and due before slot ceil((i + 1) / w); among released blocks the one
with the earliest deadline takes the slot. Weights are whole parts of their sum Q, so all
arithmetic is exact and the schedule repeats every Q slots: one frame is planned, from the
weights alone, and block b of a source with p parts takes frame b div p.

At every slot each source is less than one block away from its share, until the first
source has run out; after that the others go on in their proportions. No row is dropped
or repeated: the order is the result.
"""

from pyspark.sql import DataFrame, Window, functions as F

# Most parts a frame may have. It bounds the planned frame, which is sent to all tasks.
MOST_PARTS = 100_000

_PLAN = """
aggregate(
  sequence(0, q - 1),
  named_struct(
    'left', transform(sources, (s, i) -> named_struct('rank', i, 'parts', s.parts, 'done', 0L)),
    'taken', cast(array() as array<int>)),
  (acc, t) -> transform(
    array(array_min(transform(
      filter(acc.left, s -> s.done < s.parts AND (s.done * q) div s.parts <= t),
      s -> named_struct('due', ((s.done + 1) * q + s.parts - 1) div s.parts, 'rank', s.rank)))),
    next -> named_struct(
      'left', transform(acc.left, s -> named_struct('rank', s.rank, 'parts', s.parts,
              'done', s.done + if(s.rank = next.rank, 1L, 0L))),
      'taken', concat(acc.taken, array(next.rank))))[0],
  acc -> acc.taken)
"""


def frame_plan(parts: DataFrame) -> DataFrame:
    """One frame: source, parts, q, place (the source's how-many-th block), slot.

    ``parts`` holds source and parts (a whole number from 1). Ties go to the source that
    comes first by name.
    """
    listed = parts.where("parts >= 1").groupBy("source").agg(F.max("parts").cast("long").alias("parts"))
    frame = (
        listed.groupBy()
        .agg(
            F.sort_array(F.collect_list(F.struct("source", "parts"))).alias("sources"),
            F.sum("parts").alias("q"),
        )
        .where("q IS NOT NULL")
        .withColumn(
            "q",
            F.when(F.col("q") <= MOST_PARTS, F.col("q")).otherwise(
                F.raise_error(F.lit(f"the parts add up to more than {MOST_PARTS}"))
            ),
        )
        .withColumn("taken", F.expr(_PLAN))
    )
    slots = frame.select("sources", "q", F.posexplode("taken").alias("slot", "rank")).select(
        F.expr("sources[rank].source").alias("source"),
        F.expr("sources[rank].parts").alias("parts"),
        "q",
        F.col("slot").cast("long").alias("slot"),
    )
    in_source = Window.partitionBy("source").orderBy("slot")
    return slots.withColumn("place", (F.row_number().over(in_source) - 1).cast("long"))


def tempered_parts(docs: DataFrame, exponent: float = 0.7, total: int = 1000) -> DataFrame:
    """Target parts per source: its row count to the power of ``exponent``, as whole parts
    of about ``total``, at least one each."""
    counts = docs.groupBy(F.coalesce("source", F.lit("")).alias("source")).agg(
        F.count("*").alias("n"), F.pow(F.count("*"), F.lit(exponent)).alias("share")
    )
    return (
        counts.groupBy()
        .agg(F.sort_array(F.collect_list(F.struct("source", "share"))).alias("sources"))
        .withColumn("whole", F.aggregate("sources", F.lit(0.0), lambda sum_, s: sum_ + s["share"]))
        .select("whole", F.inline("sources"))
        .select(
            "source",
            F.greatest(F.lit(1.0), F.round(F.col("share") * total / F.col("whole")))
            .cast("long")
            .alias("parts"),
        )
    )


def _ranked(docs: DataFrame, rows_per_bucket: int) -> DataFrame:
    """Rows with their rank within the source, in the order of the MD5 of doc_id.

    The digest's first digits split each source into buckets of bounded size. Ranks are
    numbered inside the buckets, and the sizes of the buckets before are added, so no
    task holds a whole source.
    """
    digits, buckets = 1, 16
    count = docs.count()
    while buckets * rows_per_bucket < count:
        digits, buckets = digits + 1, buckets * 16
    rows = (
        docs.select("doc_id", F.coalesce("source", F.lit("")).alias("source"))
        .withColumn("digest", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")))
        .withColumn("bucket", F.substring("digest", 1, digits))
    )
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy("source", "bucket")
        .agg(F.count("*").alias("n"))
        .select("source", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    )
    inside = Window.partitionBy("source", "bucket").orderBy("digest", "doc_id")
    return (
        rows.withColumn("row", F.row_number().over(inside) - 1)
        .join(starts, ["source", "bucket"])
        .select("doc_id", "source", (F.col("start") + F.col("row")).alias("rank"))
    )


def mix(
    docs: DataFrame,
    parts: DataFrame | None = None,
    block_rows: int = 64,
    rows_per_bucket: int = 50_000,
) -> DataFrame:
    """One row per document: doc_id, source, block, slot, position (all from 0).

    ``parts`` gives each source its whole parts (default: ``tempered_parts``). Sources
    that it leaves out or gives less than one part come last, in the order of their names
    and blocks; a null source is the source with the empty name. Rows without a doc_id
    come first in their source; repeated rows each get a position. Other columns are not
    looked at. An empty table gives no rows.
    """
    parts = tempered_parts(docs) if parts is None else parts.select(
        F.coalesce("source", F.lit("")).alias("source"), "parts"
    )
    plan = frame_plan(parts)
    blocks = _ranked(docs, rows_per_bucket).withColumn("block", F.expr(f"rank div {block_rows}L"))
    listed = plan.where("place = 0").select("source", "parts", "q")
    rows = (
        blocks.join(F.broadcast(listed), "source", "left")
        .withColumn("place", F.col("block") % F.col("parts"))
        .join(F.broadcast(plan.select("source", "place", "slot")), ["source", "place"], "left")
        .withColumn("frame", F.expr("block div parts"))
        .select("doc_id", "source", "rank", "block", "frame", "q", "slot")
    )
    rows = rows.withColumn("slot", F.col("frame") * F.col("q") + F.col("slot"))
    sizes = rows.groupBy("frame", "slot", "source", "block").agg(F.count("*").alias("n"))
    by_frame = Window.orderBy(F.col("frame").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    in_frame = (
        Window.partitionBy("frame")
        .orderBy(F.col("slot").asc_nulls_last(), "source", "block")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    frames = sizes.groupBy("frame").agg(F.sum("n").alias("n")).select(
        F.col("frame").alias("_frame"), F.coalesce(F.sum("n").over(by_frame), F.lit(0)).alias("base")
    )
    starts = (
        sizes.withColumn("inside", F.coalesce(F.sum("n").over(in_frame), F.lit(0)))
        .join(frames, F.col("frame").eqNullSafe(F.col("_frame")))
        .select("source", "block", (F.col("base") + F.col("inside")).alias("start"))
    )
    return rows.join(starts, ["source", "block"]).select(
        "doc_id",
        "source",
        "block",
        "slot",
        (F.col("start") + F.col("rank") % block_rows).alias("position"),
    )


def in_mixed_order(
    docs: DataFrame,
    parts: DataFrame | None = None,
    block_rows: int = 64,
    position: str | None = None,
) -> DataFrame:
    """All documents with all their columns, sorted by their position in the mix.

    Written as files, the files and their rows follow that order. ``position`` names a
    column that holds it; one of that name in ``docs`` is replaced. Rows with the same
    doc_id and source share out their positions in the order of a hash of the row.
    """
    key = F.struct("doc_id", F.coalesce("source", F.lit("")))
    at = (
        mix(docs, parts, block_rows)
        .groupBy(key.alias("_key"))
        .agg(F.sort_array(F.collect_list("position")).alias("_all"))
    )
    hashed = [name for name, kind in docs.dtypes if "map<" not in kind]  # maps have no hash
    same_key = Window.partitionBy("_key").orderBy(F.xxhash64(*hashed))
    placed = (
        docs.withColumn("_key", key)
        .join(at, "_key")
        .withColumn("_at", F.get("_all", F.row_number().over(same_key) - 1))
    )
    ordered = placed.repartitionByRange("_at").sortWithinPartitions("_at")
    if position is None:
        return ordered.select(*docs.columns)
    return ordered.select(*(c for c in docs.columns if c != position), F.col("_at").alias(position))
