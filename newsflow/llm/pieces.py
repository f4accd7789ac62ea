"""SentencePiece encoding and decoding over a lattice of pieces.

A text is cut into units that no piece crosses: runs of space marks with what follows, and
line ends. A unit's substrings of bounded length are joined with the piece table (of fixed
size); the matches are its lattice, which is folded into one path: by Viterbi for unigram
models, by merging in the order of the scores for BPE models, whose scores are ranks that
a best sum over a path does not respect. What no piece covers becomes byte pieces.

``lattice`` and ``viterbi`` are the relational form, for tables of units. ``encode`` does the
same inside the tasks that read the documents, once per distinct unit of a task, so that
documents are not shuffled: as global joins (unit tables, grouping, answers to documents)
the same work took more disk and time than the limits allow, see the README.
"""

import heapq
import re
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from newsflow.llm.common import each, session_of, whole_text

MARK = "▁"  # stands for a space
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
# Substrings are cut from windows of this many characters, so long units stay linear.
WINDOW = 256
# Paths of distinct units that a task keeps at a time.
KEPT_PATHS = 500_000
# Units up to this length are merged by looking up only the edges that merges ask for.
SHORT_UNIT = 48
# Documents in one result batch, which holds ids and texts.
_RESULT_DOCS = 500
_UNIT = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n")


def units_of(text: str) -> list[str]:
    """Units of a text with the mark put before it."""
    return _UNIT.findall(MARK + text.replace(" ", MARK)) if text else []


def piece_table(spark: SparkSession, model: str = MODEL) -> DataFrame:
    """The pieces of a model: id, piece, score, kind (normal, byte, other)."""
    from sentencepiece import SentencePieceProcessor

    read = SentencePieceProcessor(model_file=model)
    rows = []
    for i in range(read.get_piece_size()):
        other = read.is_control(i) or read.is_unknown(i) or read.is_unused(i)
        kind = "byte" if read.is_byte(i) else "other" if other else "normal"
        rows.append((i, read.id_to_piece(i), float(read.get_score(i)), kind))
    return spark.createDataFrame(rows, "id int, piece string, score double, kind string")


class Pieces:
    """A piece table on its way to tasks: its size is that of the model."""

    def __init__(self, table: DataFrame) -> None:
        rows = sorted(table.collect(), key=lambda r: r["id"])
        self.scores = {r["id"]: r["score"] for r in rows}
        self.ranks = {r["piece"]: -r["score"] for r in rows if r["kind"] == "normal"}
        self.ids = {r["piece"]: r["id"] for r in rows if r["kind"] == "normal"}
        self.bytes = {int(r["piece"][3:5], 16): r["id"] for r in rows if r["kind"] == "byte"}
        self.unknown = next((r["id"] for r in rows if r["piece"] == "<unk>"), 0)
        self.text = {r["id"]: r["piece"].encode() for r in rows if r["kind"] == "normal"}
        self.text |= {i: bytes([value]) for value, i in self.bytes.items()}
        self.longest = max(len(r["piece"]) for r in rows if r["kind"] == "normal")

    def spelled(self, char: str) -> list[int]:
        """Pieces of a character that is none: its bytes, or else the unknown piece."""
        raw = char.encode()
        return [self.bytes[b] for b in raw] if all(b in self.bytes for b in raw) else [self.unknown]

    def merged(self, unit: str, edges: dict[tuple[int, int], int]) -> list[int]:
        """BPE: join the neighbours whose piece has the best score, the first of equals."""
        ends = {i: i + 1 for i in range(len(unit))}
        before = {i: i - 1 for i in range(len(unit))}
        heap: list[tuple[float, int, int, int]] = []

        def propose(start: int) -> None:
            middle = ends[start]
            if middle < len(unit):
                piece = edges.get((start, ends[middle] - start))
                if piece is not None:
                    heapq.heappush(heap, (-self.scores[piece], start, middle, ends[middle]))

        for i in range(len(unit) - 1):
            propose(i)
        while heap:
            _, start, middle, end = heapq.heappop(heap)
            if ends.get(start) != middle or ends.get(middle) != end:
                continue
            ends[start] = end
            del ends[middle]
            before.pop(middle)
            if end < len(unit):
                before[end] = start
            propose(start)
            if start:
                propose(before[start])
        found: list[int] = []
        place = 0
        while place < len(unit):
            piece = edges.get((place, ends[place] - place))
            found += [piece] if piece is not None else self.spelled(unit[place])
            place = ends[place]
        return found

    def path(self, unit: str) -> list[int]:
        """The pieces of a unit."""
        if len(unit) > SHORT_UNIT:
            return self.merged(unit, self.edges(unit))
        parts, rank, none = list(unit), self.ranks.get, float("inf")
        pairs = [rank(a + b, none) for a, b in pairwise(parts)]
        while pairs and (best := min(pairs)) != none:
            i = pairs.index(best)
            parts[i] += parts.pop(i + 1)
            del pairs[i]
            if i < len(pairs):
                pairs[i] = rank(parts[i] + parts[i + 1], none)
            if i:
                pairs[i - 1] = rank(parts[i - 1] + parts[i], none)
        found: list[int] = []
        for part in parts:
            piece = self.ids.get(part)
            found += [piece] if piece is not None else self.spelled(part)
        return found

    def edges(self, unit: str) -> dict[tuple[int, int], int]:
        """The lattice of a unit: (start, length) of its substrings that are pieces."""
        return {
            (start, end - start): piece
            for start in range(len(unit))
            for end in range(start + 1, min(start + self.longest, len(unit)) + 1)
            if (piece := self.ids.get(unit[start:end])) is not None
        }

    def decoded(self, ids: list[int]) -> str:
        raw = b"".join([self.text.get(i, b"") for i in ids]).decode(errors="replace")
        return raw.replace(MARK, " ").removeprefix(" ")


class Encoder(dict):
    """Paths by the words between spaces, as packed ids; made once while they are kept."""

    def __init__(self, pieces: Pieces) -> None:
        super().__init__()
        self.pieces = pieces

    def __missing__(self, word: str) -> bytes:
        ids = [
            i for unit in _UNIT.findall(MARK + word) for i in self.pieces.path(unit)
        ]
        if len(self) >= KEPT_PATHS:
            self.clear()
        self[word] = path = np.array(ids, dtype=np.int32).tobytes()
        return path

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.empty(0, dtype=np.int32)
        text = text.replace(MARK, " ")
        words = text.split(" ")
        if "" in words:  # several spaces in a row belong to the word behind them
            words = _spaced(text)
        return np.frombuffer(b"".join([self[word] for word in words]), dtype=np.int32)


def _spaced(text: str) -> list[str]:
    """Words with all but one of the spaces before them, as marks; what stands at the end
    without a word is a word of marks."""
    found = re.findall(" +[^ ]*", " " + text)
    return [MARK * (len(run) - len(run.lstrip(" ")) - 1) + run.lstrip(" ") for run in found]


def lattice(units: DataFrame, pieces: DataFrame, longest: int) -> DataFrame:
    """unit and its edges: array of (start << 40 | length << 32 | piece id), sorted.

    ``units`` (unit, distinct) keeps its partitioning, so the grouping needs no shuffle
    where they are partitioned by unit.
    """
    windows = F.transform(
        F.sequence(F.lit(0), F.length("unit") - 1, F.lit(WINDOW)),
        lambda base: F.struct(
            base.alias("base"), F.substr("unit", base + 1, F.lit(WINDOW + longest - 1)).alias("text")
        ),
    )
    starts = units.where("unit <> ''").select("unit", F.explode(windows).alias("w")).select(
        "unit",
        F.col("w.base").alias("base"),
        F.col("w.text").alias("text"),
        F.explode(
            F.sequence(F.lit(0), F.least(F.lit(WINDOW), F.length("unit") - F.col("w.base")) - 1)
        ).alias("at"),
    )
    ends = F.least(F.lit(longest), F.length("text") - F.col("at"))
    substrings = starts.select(
        "unit", "base", "at", "text", F.explode(F.sequence(F.lit(1), ends)).alias("size")
    ).select(
        "unit",
        (F.col("base") + F.col("at")).cast("long").alias("start"),
        "size",
        F.expr("substring(text, at + 1, size)").alias("piece"),
    )
    normal = pieces.where("kind = 'normal'").select("piece", "id")
    code = F.shiftleft("start", 40) + F.shiftleft(F.col("size").cast("long"), 32) + F.col("id")
    return (
        substrings.join(F.broadcast(normal), "piece")
        .groupBy("unit")
        .agg(F.sort_array(F.collect_list(code)).alias("edges"))
    )


def viterbi(edges: Column, scores: Column, size: Column) -> Column:
    """The piece ids of the best path through sorted edges, by an aggregate over them.

    For unigram models. ``scores`` maps ids to scores. Characters without an edge cost 20
    and give id -1. Of equal paths the one whose last piece starts first wins.
    """
    start, length, piece = (
        lambda e: F.shiftright(e, 40).cast("int"),
        lambda e: (F.shiftright(e, 32) % 256).cast("int"),
        lambda e: (e % (1 << 32)).cast("int"),
    )
    path = "struct<score:double,ids:array<int>>"
    none = F.lit(None).cast(path)
    first = F.struct(F.lit(0.0).alias("score"), F.array().cast("array<int>").alias("ids")).cast(path)
    begin = F.concat(F.array(first), F.array_repeat(none, size))

    def step(best: Column, at: Column) -> Column:
        """The best path to each place behind ``at``, given those up to it."""
        here = F.get(best, at)
        own = F.filter(edges, lambda e: start(e) == at)

        def better(place: Column, old: Column) -> Column:
            to = F.filter(own, lambda e: start(e) + length(e) == place)
            new = F.when(
                F.size(to) > 0,
                F.struct(
                    (here["score"] + F.element_at(scores, piece(F.get(to, F.lit(0))))).alias("score"),
                    F.concat(here["ids"], F.array(piece(F.get(to, F.lit(0))))).alias("ids"),
                ).cast(path),
            ).when(
                place == at + 1,
                F.struct(
                    (here["score"] - 20.0).alias("score"), F.concat(here["ids"], F.array(F.lit(-1))).alias("ids")
                ).cast(path),
            )
            return F.when(new.isNull(), old).when(old.isNull() | (new["score"] > old["score"]), new).otherwise(old)

        return F.transform(best, lambda old, place: better(place, old))

    folded = F.aggregate(F.sequence(F.lit(0), size - 1), begin, step)
    return F.get(folded, size)["ids"]


def _encoded(pieces: Pieces, keep: tuple[str, ...]):
    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(pieces)
        for batch in batches:
            for start in range(0, batch.num_rows, _RESULT_DOCS):
                part = batch.slice(start, _RESULT_DOCS)
                ids = [encoder.encode(text) for (text,) in each(part, "text")]
                texts = [pieces.decoded(found.tolist()) for found in ids]
                yield pa.RecordBatch.from_arrays(
                    [
                        part["doc_id"],
                        pa.array(ids, pa.list_(pa.int32())),
                        pa.array(texts, pa.string()),
                        *(part[name] for name in keep),
                    ],
                    names=["doc_id", "ids", "text", *keep],
                )

    return encoded


def encode(docs: DataFrame, pieces: DataFrame | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: doc_id, ids, text (decoded from the ids), and columns to keep.

    ``pieces`` is the table of a BPE model (default: the public 32k model). Null and empty
    texts have no ids. A space mark in a text counts as a space. Repeated rows are encoded
    each; rows without a doc_id too. Other columns are not looked at. An empty table gives
    no rows.
    """
    spark = session_of(docs)
    table = Pieces(piece_table(spark) if pieces is None else pieces)
    texts = docs.select("doc_id", whole_text().alias("text"), *keep)
    kept = "".join(f", {name} {docs.schema[name].dataType.simpleString()}" for name in keep)
    return texts.mapInArrow(_encoded(table, keep), f"doc_id long, ids array<int>, text string{kept}")


def decode(encoded: DataFrame, pieces: DataFrame) -> DataFrame:
    """doc_id and the text of ``encoded`` (doc_id, ids), by a join with the piece table.

    Repeated doc_ids are decoded each. Ids that the table lacks give nothing.
    """
    raw = F.when(
        F.col("kind") == "byte", F.unhex(F.substring("piece", 4, 2))
    ).otherwise(F.when(F.col("kind") == "normal", F.encode("piece", "utf-8")).otherwise(F.lit(b"")))
    table = pieces.select("id", F.hex(raw).alias("raw"))
    rows = encoded.withColumn("_row", F.monotonically_increasing_id())
    joined = (
        rows.select("doc_id", "_row", F.posexplode_outer("ids").alias("at", "id"))
        .join(F.broadcast(table), "id", "left")
        .groupBy("_row", "doc_id")
        .agg(F.sort_array(F.collect_list(F.struct("at", "raw"))).alias("parts"))
    )
    text = F.decode(F.unhex(F.array_join("parts.raw", "", "")), "utf-8")
    return joined.select(
        "doc_id", F.regexp_replace(F.replace(text, F.lit(MARK), F.lit(" ")), "^ ", "").alias("text")
    )
