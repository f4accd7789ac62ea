"""Quality rules: base rules and n-gram perplexity bands per language.

Every document of the corpus is counted. Each language has a modified Kneser-Ney model of
the character 4-grams inside its words, held as sorted hash arrays; a document whose
perplexity lies outside the band of its language is rejected. A band is the median of the
log perplexities of the language's documents that pass the base rules, plus and minus a
number of their median deviations.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from newsflow.llm import blocks as B
from newsflow.llm.common import session_of, stored, whole_text
from newsflow.llm.kneser_ney import probabilities

ORDER = 4
LEAST_WORDS = 20
MOST_REPEATED = 30  # percent of words inside repeated windows
# Widths of the bands below and above the median, in median deviations.
BELOW, ABOVE = 10.0, 12.0
# Least median deviation, in nats per word, for languages of few documents.
LEAST_SPREAD = 0.05
# Tables of one row per language up to this size are sent to all tasks.
SMALL_TABLE_BYTES = 8 << 20
# Grid on which medians are taken, in nats per word.
_GRID = 0.001


def _score(shards: int):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in B.rows_of(batches):
            block = B.Block(row)
            grams = block.grams(ORDER)
            total = np.zeros(len(block.docs))
            groups = np.array([g or "" for g in block.groups], dtype=object)
            for group in sorted(set(groups)):
                own = groups == group
                used = np.flatnonzero(grams.counts(block.word_counts(own)))
                of_grams = B.answered(row, group, grams, used, shards)[0]
                total[own] = block.by_doc(grams.by_word(of_grams))[own]
            columns = [[d[n] for d in block.docs] for n in ("doc_id", "group", *B.COUNTS)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(columns[0], pa.int64()),
                    pa.array(columns[1], pa.string()),
                    *(pa.array(c, pa.int64()) for c in columns[2:]),
                    pa.array(np.round(-total / np.maximum(block.counts[:, 0], 1), 6)),
                ],
                names=_SCORE_NAMES,
            )

    return score


_SCORE_NAMES = ["doc_id", "lang", *B.COUNTS, "log_perplexity"]
_SCORE_DDL = "doc_id long, lang string, " + "".join(f"{n} long, " for n in B.COUNTS) + "log_perplexity double"


def scored(docs: DataFrame) -> DataFrame:
    """doc_id, lang, the base counts, and log_perplexity (nats per word)."""
    session_of(docs)
    texts = docs.select(
        "doc_id", F.coalesce("lang", F.lit("")).alias("group"), whole_text().alias("text")
    )
    blocks = B.write_blocks(texts)
    dictionary = B.dictionaries(blocks, ORDER)
    counts = (
        dictionary.select("group", F.explode(F.arrays_zip("grams", "counts")).alias("g"))
        .groupBy("group", F.col("g.grams").alias("gram"))
        .agg(F.sum("g.counts").alias("c"))
    )
    model = probabilities(stored(counts, "gram-counts"), ORDER)
    answers, shards = B.answers(dictionary, model.select("group", "gram", F.log("p").alias("value")))
    rows = blocks.join(answers, "block", "left")
    return stored(rows.mapInArrow(_score(shards), _SCORE_DDL), "perplexities")


def _median(rows: DataFrame, value: str, name: str) -> DataFrame:
    """The median of a column per language, on a grid, from counts of its cells."""
    cells = rows.groupBy("lang", F.round(F.col(value) / _GRID).cast("long").alias("cell")).agg(
        F.count("*").alias("n")
    )
    upto = Window.partitionBy("lang").orderBy("cell")
    return (
        cells.withColumn("upto", F.sum("n").over(upto))
        .withColumn("whole", F.sum("n").over(Window.partitionBy("lang")))
        .where("2 * upto >= whole")
        .groupBy("lang")
        .agg((F.min("cell") * _GRID).alias(name))
    )


def _with_language(rows: DataFrame, table: DataFrame, how: str) -> DataFrame:
    """Rows with the columns of a stored table that has a few numbers per language.

    Languages are few as a rule; sending their table to the tasks leaves the rows where they
    are, whatever share of them a language holds. A table of more than ``SMALL_TABLE_BYTES``
    (measured) is joined by shuffles, where adaptive execution splits hot languages.
    """
    size = table.agg(F.sum(F.octet_length("lang") + 64)).first()[0] or 0
    return rows.join(F.broadcast(table) if size <= SMALL_TABLE_BYTES else table, "lang", how)


def quality(docs: DataFrame, below: float = BELOW, above: float = ABOVE) -> DataFrame:
    """One row per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, log_perplexity, kept.

    Words are runs of non-blank characters (ASCII blanks). ``base_failed`` holds for fewer
    than 20 words, or more than 30 percent of them inside repeated 8-word windows; such
    documents are rejected, and others outside their language's band. A null text is
    empty, a null lang is a language of its own. Repeated rows are scored each. Other
    columns are not looked at. An empty table gives no rows.
    """
    found = scored(docs).withColumn(
        "base_failed",
        (F.col("n_words") < LEAST_WORDS)
        | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")),
    )
    passed = found.where("NOT base_failed")
    middle = stored(_median(passed, "log_perplexity", "middle"), "medians")
    spread = _median(
        _with_language(passed, middle, "inner").withColumn("off", F.abs(F.col("log_perplexity") - F.col("middle"))),
        "off",
        "spread",
    )
    spread = spread.withColumn("spread", F.greatest("spread", F.lit(LEAST_SPREAD)))
    bands = middle.join(spread, "lang").select(
        "lang",
        (F.col("middle") - below * F.col("spread")).alias("low"),
        (F.col("middle") + above * F.col("spread")).alias("high"),
    )
    judged = _with_language(found, stored(bands, "bands"), "left")
    return judged.select(
        "doc_id",
        *B.COUNTS,
        "base_failed",
        "log_perplexity",
        (~F.col("base_failed") & F.col("log_perplexity").between(F.col("low"), F.col("high"))).alias("kept"),
    )


def good_documents(docs: DataFrame, below: float = BELOW, above: float = ABOVE) -> DataFrame:
    """The documents that pass, with all their columns."""
    kept = quality(docs, below, above).where("kept").select(F.col("doc_id").alias("_id")).distinct()
    return docs.join(kept, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
