"""Blocks of tokenised documents, each with the dictionary of the n-grams it uses.

Models of a corpus grow with it, so they are never sent whole to any task. A task cuts its
documents into blocks and writes, per block, the tokens (packed) and the distinct n-grams
of its words with their counts. The counts of all blocks make the model. The blocks then
ask the sharded model for just the values of their own n-grams. Token blocks are written
bucketed by block, so reading them next to an answer moves the answers only.

N-grams are of characters inside words: a word is spelled from start marks to an end mark,
and each of its characters is predicted from those before it.
"""

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from newsflow.llm.common import each, stored
from newsflow.plans.session import working_folder

START, END = "\x02", "\x03"
# Words and documents in one block, about: bounds what a task holds of text and vocabulary at once.
BLOCK_WORDS, BLOCK_DOCS = 1_500_000, 50_000
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
WINDOW = 8
_U = np.uint64


class Vocabulary(dict):
    """Numbers words in the order in which they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def repeated_words(ids: np.ndarray) -> int:
    """Words inside windows of WINDOW words that occur at least twice in the text."""
    n = len(ids) - WINDOW + 1
    if n < 2:
        return 0
    key = np.zeros(n, dtype=_U)
    for i in range(WINDOW):
        key = mix64((key ^ ids[i : n + i].astype(_U)) * _U(0x9E3779B97F4A7C15) + _U(i))
    _, place, counts = np.unique(key, return_inverse=True, return_counts=True)
    found = counts[place] > 1
    edge = np.zeros(len(ids) + 1, dtype=np.int64)
    edge[:n] += found
    edge[WINDOW : WINDOW + n] -= found
    return int((np.cumsum(edge) > 0).sum())


def base_counts(text: str, ids: np.ndarray) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text."""
    blanks = sum(map(text.count, BLANKS))
    seen: set[str] = set()
    repeats = 0
    for line in text.split("\n"):
        if line in seen:
            repeats += 1
        elif line.strip(BLANKS):
            seen.add(line)
    symbols = sum(map(text.count, SYMBOLS))
    return len(ids), len(text) - blanks, symbols, repeats, repeated_words(ids)


class Grams:
    """The distinct n-grams of a list of words, and which words use them."""

    def __init__(self, words: list[str], order: int) -> None:
        self.order = order
        self.text = "".join([START * (order - 1) + w + END for w in words])
        codes = np.frombuffer(self.text.encode("utf-32-le"), dtype=np.uint32)
        lengths = np.fromiter(map(len, words), dtype=np.int32, count=len(words)) + 1
        self.symbols = lengths
        self.word = np.repeat(np.arange(len(words), dtype=np.int32), lengths)
        # the first character of the n-gram that predicts each character of each word
        starts = np.arange(len(self.word), dtype=np.int32) + self.word * np.int32(order - 1)
        key = np.zeros(len(starts), dtype=_U)
        for i in range(order):
            key = mix64((key ^ codes[starts + i]) * _U(0x9E3779B97F4A7C15) + _U(i))
        _, first, gram = np.unique(key, return_index=True, return_inverse=True)
        self.gram = gram.astype(np.int32)
        self.first = starts[first]

    def strings(self, chosen: np.ndarray) -> list[str]:
        return [self.text[s : s + self.order] for s in self.first[chosen].tolist()]

    def counts(self, of_words: np.ndarray) -> np.ndarray:
        """Occurrences of each n-gram, given those of each word."""
        return np.bincount(self.gram, of_words[self.word], len(self.first)).astype(np.int64)

    def by_word(self, values: np.ndarray) -> np.ndarray:
        """Sum of n-gram values over each word."""
        return np.bincount(self.word, values[self.gram], len(self.symbols)).astype(np.float64)


# Between packed words: a byte that UTF-8 does not use.
_BETWEEN = b"\xff"


def packed(array: np.ndarray) -> bytes:
    """Deflated, byte plane by byte plane."""
    planes = np.ascontiguousarray(array).view(np.uint8).reshape(len(array), array.itemsize).T
    return zlib.compress(planes.tobytes(), 3)


def unpacked(data: bytes, dtype: type) -> np.ndarray:
    raw = np.frombuffer(zlib.decompress(data), dtype=np.uint8)
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(width, len(raw) // width).T).view(dtype).reshape(-1)


class Block:
    """A block read back: docs, group of each doc, n_words, and word numbers."""

    def __init__(self, row: dict) -> None:
        self.words = [w.decode() for w in zlib.decompress(row["words"]).split(_BETWEEN)] if row["words"] else []
        self.ids = unpacked(row["ids"], np.uint32).astype(np.int64)
        self.docs = row["docs"]
        self.counts = np.array([[d[n] for n in COUNTS] for d in self.docs], dtype=np.int64).reshape(-1, 5)
        self.doc_of_word = np.repeat(np.arange(len(self.docs)), self.counts[:, 0])
        self.groups = [d["group"] for d in self.docs]

    def grams(self, order: int) -> Grams:
        return Grams(self.words, order)

    def word_counts(self, docs: np.ndarray) -> np.ndarray:
        """How often each word occurs in the chosen documents."""
        return np.bincount(self.ids[docs[self.doc_of_word]], minlength=len(self.words))

    def by_doc(self, values: np.ndarray) -> np.ndarray:
        """Sum of word values over each document."""
        return np.bincount(self.doc_of_word, values[self.ids], len(self.docs)).astype(np.float64)


COUNTS = "n_words word_chars n_symbols n_dup_lines n_repeat_words".split()
_DOC_TYPE = pa.struct(
    [("doc_id", pa.int64()), ("group", pa.string()), *((name, pa.int64()) for name in COUNTS)]
)
_BLOCK_SCHEMA = pa.schema(
    [
        ("block", pa.int64()),
        ("words", pa.binary()),
        ("ids", pa.binary()),
        ("docs", pa.list_(_DOC_TYPE)),
    ]
)
_DOC_DDL = ", ".join(f"{n}: bigint" for n in COUNTS)
BLOCK_DDL = f"block long, words binary, ids binary, docs array<struct<doc_id: bigint, group: string, {_DOC_DDL}>>"


def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of up to BLOCK_WORDS words and BLOCK_DOCS documents; a longer text has a block of its own."""
    number = TaskContext.get().partitionId() << 32
    vocabulary, ids, docs, size = Vocabulary(), [], [], 0

    def block() -> pa.RecordBatch:
        all_ids = np.concatenate(ids)
        # frequent words first: small numbers pack well
        order = np.argsort(-np.bincount(all_ids, minlength=len(vocabulary)), kind="stable")
        rank = np.empty(len(order), dtype=np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        words = list(vocabulary)
        spelled = zlib.compress(_BETWEEN.join([words[i] for i in order.tolist()]), 3) if words else b""
        row = {"block": number, "words": spelled, "ids": packed(rank[all_ids]), "docs": docs}
        return pa.RecordBatch.from_pylist([row], schema=_BLOCK_SCHEMA)

    for batch in batches:
        for doc, group, text in each(batch, "doc_id", "group", "text"):
            words = text.encode().split()
            if docs and (size + len(words) > BLOCK_WORDS or len(docs) == BLOCK_DOCS):
                yield block()
                number += 1
                vocabulary, ids, docs, size = Vocabulary(), [], [], 0
            own = np.fromiter(map(vocabulary.__getitem__, words), dtype=np.uint32, count=len(words))
            ids.append(own)
            docs.append({"doc_id": doc, "group": group, **dict(zip(COUNTS, base_counts(text, own)))})
            size += len(words)
    if docs:
        yield block()


def write_blocks(docs: DataFrame) -> DataFrame:
    """Token blocks of ``docs`` (doc_id, group, text without nulls), bucketed by block."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", "group", "text").mapInArrow(cut, BLOCK_DDL)
    return bucketed(rows, "block")


def bucketed(rows: DataFrame, key: str) -> DataFrame:
    """Rows written below the shared folder as a table bucketed by a column."""
    spark = rows.sparkSession
    name = f"newsflow_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = rows.write.format("parquet").option("path", working_folder(spark, "buckets"))
    writer.bucketBy(buckets, key).saveAsTable(name)
    return spark.table(name)


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one at a time: a block is large, a batch of them too large for lists."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _dictionary(order: int):
    def dictionary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            block = Block(row)
            grams = block.grams(order)
            groups = np.array([g or "" for g in block.groups], dtype=object)
            for group in sorted(set(groups)):
                counts = grams.counts(block.word_counts(groups == group))
                used = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["block"]], pa.int64()),
                        pa.array([group]),
                        pa.array([grams.strings(used)], pa.list_(pa.string())),
                        pa.array([counts[used]], pa.list_(pa.int64())),
                    ],
                    names=["block", "group", "grams", "counts"],
                )

    return dictionary


def dictionaries(blocks: DataFrame, order: int) -> DataFrame:
    """The n-grams of each block and group of documents: block, group, grams, counts."""
    found = blocks.mapInArrow(
        _dictionary(order), "block long, group string, grams array<string>, counts array<long>"
    )
    return stored(found, "dictionaries")


def gram_key(group: str, gram: str) -> int:
    """What Spark's xxhash64(group, gram) gives."""
    seed = xxhash.xxh64_intdigest(group.encode(), seed=42)
    value = xxhash.xxh64_intdigest(gram.encode(), seed=seed)
    return value - (1 << 64) if value >> 63 else value


KEYS_PER_SHARD = 250_000
# Questions a task answers: many more than a shard has keys, so its copy of the arrays is
# the smaller part of what it reads.
QUESTIONS_PER_TASK = 2_000_000


def _ask(shards: int):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            keys = np.array([gram_key(row["group"], g) for g in row["grams"]], dtype=np.int64)
            for shard in range(shards):
                own = keys[keys % shards == shard]
                if len(own):
                    asked = {"shard": shard, "kind": 1, "keys": own.tobytes(), "values": None}
                    asked |= {"block": row["block"], "group": row["group"]}
                    yield pa.RecordBatch.from_pylist([asked], schema=_ASK_SCHEMA)

    return ask


_ASK_SCHEMA = pa.schema(
    [
        ("shard", pa.int32()),
        ("kind", pa.int32()),
        ("block", pa.int64()),
        ("group", pa.string()),
        ("keys", pa.binary()),
        ("values", pa.binary()),
    ]
)
_ASK_DDL = "shard int, kind int, block long, group string, keys binary, values binary"


def _sorted_arrays(rows: pa.Table) -> pa.Table:
    """A shard of the model: its keys, sorted, and their values in that order."""
    keys = rows["key"].to_numpy()
    order = np.argsort(keys)
    columns = [n for n in rows.column_names if n not in ("key", "shard")]
    values = np.stack([rows[n].to_numpy()[order].astype(np.float32) for n in columns])
    return pa.table(
        {
            "shard": pa.array([rows["shard"][0].as_py()], pa.int32()),
            "keys": [keys[order].tobytes()],
            "values": [values.tobytes()],
        }
    )


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Values for the blocks' keys, from rows sorted so that each shard's arrays come first."""
    keys = values = None
    for row in rows_of(batches):
        if row["kind"] == 0:
            keys = np.frombuffer(row["keys"], dtype=np.int64)
            values = np.frombuffer(row["values"], dtype=np.float32).reshape(-1, len(keys))
            continue
        asked = np.frombuffer(row["keys"], dtype=np.int64)
        place = np.searchsorted(keys, asked)
        if not (keys[np.minimum(place, len(keys) - 1)] == asked).all():
            raise ValueError("a block asks for an n-gram that the model lacks")
        found = {n: row[n] for n in ("block", "group", "shard")}
        yield pa.RecordBatch.from_pylist(
            [found | {"values": values[:, place].tobytes()}], schema=_ANSWER_SCHEMA
        )


_ANSWER_SCHEMA = pa.schema(
    [("block", pa.int64()), ("group", pa.string()), ("shard", pa.int32()), ("values", pa.binary())]
)


def answers(dictionary: DataFrame, model: DataFrame) -> tuple[DataFrame, int]:
    """Per block: answers (group, shard, values) from ``model`` (group, gram, and values).

    The model is held as sorted arrays of key hashes with their values, by shard. Also
    gives the number of shards. The model grows slower than the questions, so a shard's
    questions are dealt over salts, each with a copy of its arrays; their number follows
    from the number of questions.
    """
    values = [name for name in model.columns if name not in ("group", "gram")]
    model = stored(model.select(F.xxhash64("group", "gram").alias("key"), *values), "model")
    shards = int(1 + model.count() // KEYS_PER_SHARD)
    questions = dictionary.agg(F.sum(F.size("counts"))).first()[0] or 0
    salts = int(1 + questions // (shards * QUESTIONS_PER_TASK))
    arrays = (
        model.withColumn("shard", F.pmod("key", F.lit(shards)).cast("int"))
        .groupBy("shard")
        .applyInArrow(_sorted_arrays, "shard int, keys binary, values binary")
        .select(
            "shard",
            F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"),
            F.lit(0).alias("kind"),
            F.lit(None).cast("long").alias("block"),
            F.lit(None).cast("string").alias("group"),
            "keys",
            "values",
        )
    )
    asked = dictionary.select("block", "group", "grams").mapInArrow(_ask(shards), _ASK_DDL)
    asked = asked.withColumn("salt", F.pmod(F.xxhash64("block"), F.lit(salts)).cast("int"))
    found = (
        asked.unionByName(arrays)
        .repartition("shard", "salt")
        .sortWithinPartitions("shard", "salt", "kind")
        .mapInArrow(_answer, "block long, group string, shard int, values binary")
    )
    by_block = found.groupBy("block").agg(
        F.collect_list(F.struct("group", "shard", "values")).alias("answers")
    )
    return by_block, shards


def answered(row: dict, group: str, grams: Grams, used: np.ndarray, shards: int) -> np.ndarray:
    """The model's values for a group, one row of values per column (0 if unused)."""
    keys = np.array([gram_key(group, g) for g in grams.strings(used)], dtype=np.int64)
    values = np.zeros((1, len(grams.first)))
    for answer in row["answers"] or []:
        if answer["group"] == group:
            here = used[keys % shards == answer["shard"]]
            found = np.frombuffer(answer["values"], dtype=np.float32).reshape(-1, len(here))
            if len(values) < len(found):
                values = np.zeros((len(found), len(grams.first)))
            values[:, here] = found
    return values
