"""Line dedup by a sharded minimal perfect hash over the hashes of frequent lines.

Each batch counts its lines, so a line of every document sends one row per batch. The keys
found in enough documents are dealt into shards; each shard builds a minimal perfect hash
(levels of bit arrays, as in Limasset et al. 2017) that indexes arrays of fingerprints,
counts and last documents. Lines then probe the arrays of their shard, streamed past them:
a task holds one shard's arrays and one batch of probes, however often a line occurs. Each
shard is repeated ``SALTS`` times to spread the probes of a hot line.
"""

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from newsflow.llm.common import each, session_of, stored, whole_text

SALTS = 16
KEYS_PER_SHARD = 100_000
_BLANKS = " \t\n\x0b\x0c\r"
_LEAST = -(2**63)


def long_lines(text: str, min_chars: int) -> Iterator[tuple[int, bytes]]:
    """Number and 128-bit key hash of each line whose key is long enough."""
    for number, line in enumerate(text.split("\n")):
        if len(line) >= min_chars:
            key = line.strip(_BLANKS)
            if len(key) >= min_chars:
                yield number, xxhash.xxh3_128_digest(key.encode().lower())


def _halves(digests: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    pairs = np.frombuffer(b"".join(digests), dtype=np.int64).reshape(-1, 2)
    return pairs[:, 0].copy(), pairs[:, 1].copy()


def _count_lines(min_chars: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[bytes, list] = {}
            for doc, text in each(batch, "doc_id", "text"):
                doc = _LEAST if doc is None else doc
                for digest in {digest for _, digest in long_lines(text, min_chars)}:
                    seen = found.get(digest)
                    if seen is None:
                        found[digest] = [1, doc]
                    else:
                        seen[0] += 1
                        seen[1] = max(seen[1], doc)
            low, high = _halves(list(found))
            counts = np.array(list(found.values()), dtype=np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(low), pa.array(high), pa.array(counts[:, 0]), pa.array(counts[:, 1])],
                names=["low", "high", "n", "last"],
            )

    return count


def _probes(min_chars: int, shards: int):
    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, rows, numbers, digests = [], [], [], []
            for doc, text_hash, text in each(batch, "doc_id", "text_hash", "text"):
                for number, digest in long_lines(text, min_chars):
                    docs.append(doc)
                    rows.append(text_hash)
                    numbers.append(number)
                    digests.append(digest)
            low, high = _halves(digests)
            salts = np.arange(len(low), dtype=np.int32) % SALTS
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array((low % shards).astype(np.int32)),
                    pa.array(salts),
                    pa.array(np.ones(len(low), dtype=np.int32)),
                    pa.array(docs, pa.int64()),
                    pa.array(rows, pa.int64()),
                    pa.array(numbers, pa.int32()),
                    pa.array(low),
                    pa.array(high),
                    pa.nulls(len(low), pa.binary()),
                ],
                names=_PROBE_NAMES,
            )

    return probe


_PROBE_NAMES = "shard salt kind doc_id text_hash line low high arrays".split()
_PROBE_DDL = (
    "shard int, salt int, kind int, doc_id long, text_hash long, line int, low long, high long, "
    "arrays binary"
)


class HashArrays:
    """Minimal perfect hash of distinct 128-bit keys, with arrays in its order.

    Level by level, keys that are alone in their slot of a bit array take it; the others
    go on to the next level. A key's index is the number of bits set before its own.
    """

    def __init__(self, levels: list[np.ndarray], arrays: dict[str, np.ndarray]) -> None:
        self.levels, self.arrays = levels, arrays
        self.ranks = [np.cumsum(bits) for bits in levels]

    @staticmethod
    def _slots(low: np.ndarray, high: np.ndarray, level: int, size: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            mixed = low.view(np.uint64) ^ (high.view(np.uint64) >> np.uint64(7))
            mixed = (mixed + np.uint64(level)) * np.uint64(0x9E3779B97F4A7C15)
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            return ((mixed ^ (mixed >> np.uint64(32))) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, low: np.ndarray, high: np.ndarray, **values: np.ndarray) -> "HashArrays":
        left, levels, order = np.arange(len(low)), [], []
        while len(left):
            size = max(8, 2 * len(left))
            slots = cls._slots(low[left], high[left], len(levels), size)
            alone = np.bincount(slots, minlength=size)[slots] == 1
            bits = np.zeros(size, dtype=bool)
            bits[slots[alone]] = True
            placed = left[alone]
            order.append(placed[np.argsort(slots[alone], kind="stable")])
            levels.append(bits)
            left = left[~alone]
        index = np.concatenate(order) if order else np.arange(0)
        return cls(levels, {"print": high[index], **{k: v[index] for k, v in values.items()}})

    def find(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Index of each key, -1 for keys that are not in the set."""
        found = np.full(len(low), -1, dtype=np.int64)
        left, base = np.arange(len(low)), 0
        for level, (bits, ranks) in enumerate(zip(self.levels, self.ranks)):
            slots = self._slots(low[left], high[left], level, len(bits))
            here = bits[slots]
            found[left[here]] = base + ranks[slots[here]] - 1
            left, base = left[~here], base + int(ranks[-1])
        hit = found >= 0
        hit[hit] = self.arrays["print"][found[hit]] == high[hit]
        return np.where(hit, found, -1)

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        bits = {f"level{i}": np.packbits(b) for i, b in enumerate(self.levels)}
        sizes = np.array([len(b) for b in self.levels], dtype=np.int64)
        np.savez(out, sizes=sizes, **bits, **{f"a_{k}": v for k, v in self.arrays.items()})
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> "HashArrays":
        with np.load(io.BytesIO(data)) as file:
            levels = [
                np.unpackbits(file[f"level{i}"], count=size).astype(bool)
                for i, size in enumerate(file["sizes"])
            ]
            return cls(levels, {k[2:]: file[k] for k in file.files if k.startswith("a_")})


def _build_shard(keys: pa.Table) -> pa.Table:
    columns = {name: keys[name].to_numpy() for name in ("low", "high", "n", "last")}
    arrays = HashArrays.build(columns["low"], columns["high"], count=columns["n"], last=columns["last"])
    return pa.table(
        {"shard": pa.array([keys["shard"][0].as_py()], pa.int32()), "arrays": [arrays.to_bytes()]}
    )


def _probe_arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines to drop from rows sorted by shard and salt, the shard's arrays before its probes."""
    arrays, place = None, None
    for batch in batches:
        shards, salts, kinds = (batch[n].to_numpy() for n in ("shard", "salt", "kind"))
        change = (np.diff(shards) != 0) | (np.diff(salts) != 0) | (np.diff(kinds) != 0)
        starts = [0, *(np.flatnonzero(change) + 1).tolist(), len(shards)]
        for start, end in zip(starts, starts[1:]):
            if start == end:
                continue
            if kinds[start] == 0:
                arrays = HashArrays.from_bytes(batch["arrays"][start].as_py())
                place = (shards[start], salts[start])
                continue
            if place != (shards[start], salts[start]):
                continue
            part = batch.slice(start, end - start)
            index = arrays.find(part["low"].to_numpy(), part["high"].to_numpy())
            docs = part["doc_id"].fill_null(_LEAST).to_numpy()
            drop = (index >= 0) & (arrays.arrays["last"][index] != docs)
            yield part.select(["doc_id", "text_hash", "line"]).filter(pa.array(drop))


def frequent_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """Keys of lines found in at least ``min_docs`` documents: low, high, n, last."""
    counted = docs.select("doc_id", whole_text().alias("text")).mapInArrow(
        _count_lines(min_chars), "low long, high long, n long, last long"
    )
    return (
        counted.groupBy("low", "high")
        .agg(F.sum("n").alias("n"), F.max("last").alias("last"))
        .where(F.col("n") >= min_docs)
    )


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """One row per document: doc_id, text (without the dropped lines), n_lines, n_dropped.

    A line's key is the line without white space at its ends, in lower case (ASCII). Keys
    of at least ``min_chars`` code points that occur in at least ``min_docs`` documents
    lose all their lines but those of the largest doc_id that has them. Each row counts as
    a document; rows without a doc_id come before all others. A null text is one empty
    line. Other columns are not looked at. An empty table gives no rows.
    """
    session_of(docs)
    rows = docs.select("doc_id", whole_text().alias("text")).withColumn("text_hash", F.xxhash64("text"))
    frequent = stored(frequent_lines(docs, min_chars, min_docs), "frequent-lines")
    shards = 1 + frequent.count() // KEYS_PER_SHARD
    shards = max(shards, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 4)
    built = (
        frequent.withColumn("shard", F.pmod("low", F.lit(shards)).cast("int"))
        .groupBy("shard")
        .applyInArrow(_build_shard, "shard int, arrays binary")
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    )
    nothing = {name: F.lit(None) for name in ("doc_id", "text_hash", "line", "low", "high")}
    arrays = built.withColumns({"kind": F.lit(0), **nothing}).select(*_PROBE_NAMES)
    probes = rows.mapInArrow(_probes(min_chars, shards), _PROBE_DDL)
    hits = (
        probes.unionByName(arrays)
        .repartition("shard", "salt")
        .sortWithinPartitions("shard", "salt", "kind")
        .mapInArrow(_probe_arrays, "doc_id long, text_hash long, line int")
    )
    dropped = hits.groupBy("doc_id", "text_hash").agg(
        F.sort_array(F.collect_set("line")).alias("dropped")
    )
    joined = rows.alias("r").join(
        dropped.alias("d"),
        F.col("r.doc_id").eqNullSafe(F.col("d.doc_id")) & (F.col("r.text_hash") == F.col("d.text_hash")),
        "left",
    )
    lines = F.split("text", "\n", -1)
    bounds = F.concat(F.array(F.lit(-1)), F.col("dropped"), F.array(F.col("n_lines").cast("int")))
    runs = F.transform(
        F.sequence(F.lit(1), F.size("bounds") - 1),
        lambda k: F.slice(
            "lines",
            F.get("bounds", k - 1) + 2,
            F.get("bounds", k) - F.get("bounds", k - 1) - 1,
        ),
    )
    return (
        joined.select("r.doc_id", "text", "dropped")
        .withColumn("lines", lines)
        .withColumn("n_lines", F.size("lines").cast("long"))
        .withColumn("bounds", bounds)
        .select(
            "doc_id",
            F.when(F.col("dropped").isNull(), F.col("text"))
            .otherwise(F.array_join(F.flatten(runs), "\n"))
            .alias("text"),
            "n_lines",
            F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        )
    )
