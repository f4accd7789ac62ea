"""MinHash near-dedup with tensored banding.

Two collections of ``tables`` short minhash groups (``rows`` values each) are computed per
distinct shingle set. The keys of the tables are all pairs of one group from either
collection, so ``tables`` squared keys of twice ``rows`` values cost only twice ``tables``
groups. A pair with similarity s shares a key unless one collection has no common group:
it is missed with probability below 2 (1 - s^rows)^tables, 0.00002 at 0.8.

Documents that share keys, directly or over others, form a family. Inside a family links are
confirmed on full shingle sets, against all members at once by an index of their shingles.
Only components are wanted: a member is compared as long as it lies outside its family's
largest component, and what comes out is a spanning forest, never all pairs. Large families
are cut into blocks of bounded size, and every pair of blocks is compared by a task of its
own. Copies of one shingle set stand for one another.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from newsflow.llm.common import each, session_of, stored, whole_text
from newsflow.llm.components import components

TABLES, ROWS = 16, 3
# Shingles in one block of a family: bounds what a task holds.
BLOCK_SHINGLES = 1_500_000
# Members that are compared first, as they have the most common shingles.
_PIVOTS = 8
_CHUNK = 4096
_CACHED_WORDS = 100_000
_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits (the finaliser of splitmix64)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_SEEDS = _mix(np.arange(1, 2 * TABLES * ROWS + 1, dtype=_U) * _U(0x9E3779B97F4A7C15))


class _WordHashes(dict):
    """Hashes of words, each computed once."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > _CACHED_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_set(text: str, words: int, hashes: dict) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a text, ASCII letters lowered."""
    found = text.encode().lower().split()
    if not found:
        return np.empty(0, dtype=_U)
    values = np.fromiter(map(hashes.__getitem__, found), dtype=_U, count=len(found))
    size = min(words, len(values))
    last = len(values) - size + 1
    shingles = np.full(last, size, dtype=_U)
    for i in range(size):
        shingles = _mix((shingles ^ values[i : last + i]) * _U(0x9E3779B97F4A7C15) + _U(i))
    return np.unique(shingles)


def groups_of(shingles: np.ndarray) -> np.ndarray:
    """The 2 * TABLES minhash groups of a set, one hash each."""
    least = np.full(len(_SEEDS), np.iinfo(_U).max, dtype=_U)
    for start in range(0, len(shingles), _CHUNK):
        part = shingles[start : start + _CHUNK]
        permuted = (part[None, :] ^ _SEEDS[:, None]) * _U(0xD6E8FEB86659FD93)
        least = np.minimum(least, (permuted ^ (permuted >> _U(32))).min(axis=1))
    by_group = least.reshape(2 * TABLES, ROWS)
    value = np.arange(2 * TABLES, dtype=_U)
    for i in range(ROWS):
        value = _mix((value ^ by_group[:, i]) * _U(0x9E3779B97F4A7C15) + _U(i))
    return value


def _sketch(words: int):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in batches:
            counts, low, high, groups = [], [], [], []
            for (text,) in each(batch, "text"):
                shingles = shingle_set(text, words, hashes)
                counts.append(len(shingles))
                digest = xxhash.xxh3_128_digest(shingles.tobytes())
                low.append(int.from_bytes(digest[:8], "little", signed=True))
                high.append(int.from_bytes(digest[8:], "little", signed=True))
                groups.append(groups_of(shingles).view(np.int64) if len(shingles) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    pa.array(counts, pa.int64()),
                    pa.array(low, pa.int64()),
                    pa.array(high, pa.int64()),
                    pa.array(groups, pa.list_(pa.int64())),
                ],
                names=["doc_id", "n_shingles", "low", "high", "groups"],
            )

    return sketch


def _sets(words: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in batches:
            found = [shingle_set(t, words, hashes).tobytes() for (t,) in each(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(found, pa.binary())], names=["rep", "shingles"]
            )

    return sets


class Forest:
    """Components of the members of a family, found by comparing full sets."""

    def __init__(self, sets: list[np.ndarray], similarity: int) -> None:
        self.similarity = similarity
        self.sizes = np.array([len(x) for x in sets], dtype=np.int64)
        values, place, counts = np.unique(
            np.concatenate(sets), return_inverse=True, return_counts=True
        )
        member = np.repeat(np.arange(len(sets)), self.sizes)
        self.holders = member[np.argsort(place, kind="stable")]
        self.ends = np.cumsum(counts)
        self.starts = self.ends - counts
        self.common = counts[place] > 1
        self.place, self.offsets = place, np.cumsum(self.sizes) - self.sizes
        self.commonness = np.bincount(member, counts[place].astype(np.float64))
        self.root = np.arange(len(sets))
        self.edges: list[tuple[int, int]] = []

    def join(self, x: int, others: np.ndarray) -> None:
        """Put the components of all ``others`` into that of x, one edge for each."""
        roots, first = np.unique(self.root[others], return_index=True)
        new = roots != self.root[x]
        self.edges += [(x, y) for y in others[first[new]].tolist()]
        moved = np.zeros(len(self.root), dtype=bool)
        moved[roots[new]] = True
        self.root[moved[self.root]] = self.root[x]

    def linked(self, x: int) -> np.ndarray:
        """All members that are similar enough to x."""
        own = slice(self.offsets[x], self.offsets[x] + self.sizes[x])
        shared = self.place[own][self.common[own]]
        runs = [self.holders[s:e] for s, e in zip(self.starts[shared], self.ends[shared])]
        if not runs:
            return np.empty(0, dtype=np.int64)
        both = np.bincount(np.concatenate(runs), minlength=len(self.sizes))
        union = self.sizes[x] + self.sizes - both
        near = np.flatnonzero(100 * both >= self.similarity * union)
        return near[near != x]

    def grow(self) -> None:
        """Compare members until all but those of the largest component have been."""
        waiting = np.ones(len(self.sizes), dtype=bool)
        first = np.argsort(-self.commonness / self.sizes, kind="stable")[:_PIVOTS].tolist()
        while True:
            outside = np.flatnonzero(waiting & (self.root != np.argmax(np.bincount(self.root))))
            if not len(outside):
                return
            x = first.pop(0) if first else int(outside[0])
            if waiting[x]:
                waiting[x] = False
                self.join(x, self.linked(x))


def _link_family(similarity: int):
    def link(rows: pa.Table) -> pa.Table:
        reps = rows["rep"].to_numpy()
        sets = [np.frombuffer(x.as_buffer(), dtype=_U) for x in rows["shingles"]]
        forest = Forest(sets, similarity)
        if "local" in rows.column_names:
            # already connected inside its block: the first member stands for the rest
            _, first, place = np.unique(rows["local"].to_numpy(), return_index=True, return_inverse=True)
            forest.root = first[place]
        forest.grow()
        edges = np.array(forest.edges, dtype=np.int64).reshape(-1, 2)
        return pa.table({"u": reps[edges[:, 0]], "v": reps[edges[:, 1]]})

    return link


def near_duplicates(docs: DataFrame, words: int = 5, similarity: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents are linked if their sets of ``words``-word shingles have at least
    ``similarity`` percent in common (intersection by union). A text of fewer words has
    one shingle, all its words; without words (or with a null text) it has none and is
    linked with nothing. ``component_id`` is the least doc_id reachable over links, its
    own included; that document is kept. Rows without a doc_id are linked with nothing and
    kept; rows that repeat a doc_id count as one document. Other columns are not looked
    at. An empty table gives no rows.
    """
    session_of(docs)
    rows = docs.select("doc_id", whole_text().alias("text"))
    sketches = stored(
        rows.mapInArrow(
            _sketch(words), "doc_id long, n_shingles long, low long, high long, groups array<long>"
        ),
        "sketches",
    )
    with_set = sketches.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = stored(
        with_set.groupBy("low", "high").agg(F.min("doc_id").alias("rep")).select("rep", "low", "high"),
        "classes",
    )
    reps = classes.select("rep", "low", "high").join(
        with_set.select(F.col("doc_id").alias("rep"), "low", "high", "groups"), ["rep", "low", "high"]
    ).dropDuplicates(["rep"])
    reps = stored(reps.select("rep", "groups"), "representatives")
    keys = stored(_table_keys(reps), "table-keys")

    firsts = keys.groupBy("key").agg(F.min("rep").alias("first"), F.count("*").alias("n")).where("n > 1")
    families = _families(keys.join(firsts, "key").select("rep", "first"))
    texts = rows.join(families, F.col("doc_id") == F.col("node"), "left_semi")
    sets = stored(texts.mapInArrow(_sets(words), "rep long, shingles binary").dropDuplicates(["rep"]), "sets")
    labels = components(_family_links(sets, families, similarity))

    of_class = classes.join(labels, classes.rep == labels.node, "left").select(
        F.col("low").alias("_low"), F.col("high").alias("_high"), F.coalesce("component", "rep").alias("component_id")
    )
    joined = sketches.join(
        of_class,
        (F.col("low") == F.col("_low"))
        & (F.col("high") == F.col("_high"))
        & (F.col("n_shingles") > 0)
        & F.col("doc_id").isNotNull(),
        "left",
    )
    return joined.select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _table_keys(reps: DataFrame) -> DataFrame:
    """Table keys (key, rep) that can be shared: pairs of groups which others have too."""
    groups = reps.select("rep", F.posexplode("groups").alias("place", "value"))
    shared = groups.groupBy("value").agg(F.count("*").alias("n")).where("n > 1").select("value")
    by_rep = (
        groups.join(shared, "value", "left_semi")
        .groupBy("rep")
        .agg(
            F.collect_list(F.when(F.col("place") < TABLES, F.col("value"))).alias("one"),
            F.collect_list(F.when(F.col("place") >= TABLES, F.col("value"))).alias("other"),
        )
    )
    pairs = by_rep.select("rep", F.explode("one").alias("a"), "other").select(
        "rep", "a", F.explode("other").alias("b")
    )
    return pairs.select(F.xxhash64("a", "b").alias("key"), "rep")


def _families(shared: DataFrame) -> DataFrame:
    """node, component for documents that share keys with the first of a bucket.

    A document stands with the least of its firsts; only the firsts of one document are
    linked with one another, so a hot bucket adds a row per member and few links.
    """
    least = stored(shared.groupBy("rep").agg(F.min("first").alias("least")), "least-firsts")
    links = (
        shared.join(least, "rep")
        .where("first <> least")
        .select(F.col("least").alias("u"), F.col("first").alias("v"))
        .distinct()
    )
    named = components(links).select(F.col("node").alias("least"), "component")
    return least.join(named, "least", "left").select(
        F.col("rep").alias("node"), F.coalesce("component", "least").alias("component")
    )


def _family_links(sets: DataFrame, families: DataFrame, similarity: int) -> DataFrame:
    """Links (u, v) that connect what is connected inside each family."""
    members = sets.join(families.withColumnRenamed("component", "family"), sets.rep == families.node)
    sizes = members.groupBy("family").agg(F.sum(F.length("shingles") / 8).alias("size"))
    sizes = sizes.select("family", F.ceil(F.col("size") / BLOCK_SHINGLES).cast("int").alias("blocks"))
    members = stored(
        members.join(sizes, "family").select(
            "family",
            "blocks",
            F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int").alias("block"),
            "rep",
            "shingles",
        ),
        "families",
    )
    link = _link_family(similarity)
    inside = stored(members.groupBy("family", "block").applyInArrow(link, "u long, v long"), "links")
    large = members.where("blocks > 1")
    if large.isEmpty():
        return inside
    local = components(inside).select(F.col("node").alias("_node"), F.col("component").alias("_local"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    crossed = (
        large.join(local, large.rep == F.col("_node"), "left")
        .select("family", "block", "rep", "shingles", F.coalesce("_local", "rep").alias("local"), other)
        .where("block <> other")
        .withColumn("one", F.least("block", "other"))
        .withColumn("two", F.greatest("block", "other"))
        .select("family", "one", "two", "rep", "local", "shingles")
    )
    across = crossed.groupBy("family", "one", "two").applyInArrow(link, "u long, v long")
    return inside.unionByName(stored(across, "links"))


def without_near_copies(docs: DataFrame, words: int = 5, similarity: int = 80) -> DataFrame:
    """The documents that near-dedup keeps, with all their columns."""
    found = near_duplicates(docs, words, similarity).where("kept AND doc_id IS NOT NULL")
    kept = found.select(F.col("doc_id").alias("_id")).distinct()
    matched = docs.join(kept, F.col("doc_id") == F.col("_id"), "left_semi")
    return matched.unionByName(docs.where("doc_id IS NULL"))
