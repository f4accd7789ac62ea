"""Toxicity by class-conditional Kneser-Ney models.

A toxic and an ordinary model of character 5-grams inside words are counted on labelled
documents; both give what they discount to one shared model, counted on all documents. A
document's feature is the difference of its log-likelihoods per n-gram; the first two
letters of each word, which mostly tell the language, do not count. Words are runs of
letters, in lower case. A logistic curve, fitted on the same labelled documents, turns
features into scores. A score follows from the text alone: equal texts have equal scores.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from newsflow.llm import blocks as B
from newsflow.llm.common import session_of, stored, whole_text
from newsflow.llm.kneser_ney import class_probabilities, probabilities

ORDER = 5
FOLDS = 5
# Training documents fall into two halves with a model each. The curve is fitted on features
# from the half a document is not in, which no model has seen; scores take the mean of both.
HALVES = ("a", "b")
_CLASSES = [f"{label}_{half}" for half in HALVES for label in ("toxic", "ordinary")]
_RATIOS = [f"{kind}_{half}" for kind in ("after", "overall") for half in HALVES]
# Evidence (squared standard errors between the classes' shares of an n-gram) at which a ratio
# counts half: what chance may have made counts little, at all sizes of the evidence.
HALF_EVIDENCE = 30.0
# Of weights on features of mean square 1; chosen by cross-validation on training rows alone.
RIDGE = 0.3
_ROUNDS = 12


def _class_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a block's n-grams in the toxic and ordinary training texts of each half."""
    for row in B.rows_of(batches):
        block = B.Block(row)
        grams = block.grams(ORDER)
        counts = []
        for half in HALVES:
            for label in (1, 0):
                chosen = np.zeros(len(block.docs), dtype=bool)
                own = (d for d in row["labelled"] if d["toxic"] == label and d["half"] == half)
                chosen[[d["place"] for d in own]] = True
                counts.append(grams.counts(block.word_counts(chosen)))
        used = np.flatnonzero(sum(counts))
        yield pa.RecordBatch.from_arrays(
            [pa.array(grams.strings(used), pa.string()), *(pa.array(c[used]) for c in counts)],
            names=["gram", *_CLASSES],
        )


def _features(shards: int):
    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in B.rows_of(batches):
            block = B.Block(row)
            grams = block.grams(ORDER)
            size = block.by_doc(grams.symbols.astype(np.float64))
            values = B.answered(row, "", grams, np.arange(len(grams.first)), shards)
            if len(values) < len(_RATIOS):  # no words at all
                values = np.zeros((len(_RATIOS), len(grams.first)))
            ratios = [
                np.round(block.by_doc(grams.by_word(v)) / np.maximum(size, 1), 6) for v in values
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([d["doc_id"] for d in block.docs], pa.int64()),
                    pa.array([row["block"]] * len(block.docs), pa.int64()),
                    pa.array(np.arange(len(block.docs), dtype=np.int32)),
                    *map(pa.array, ratios),
                    pa.array(size),
                ],
                names=["doc_id", "block", "place", *_RATIOS, "size"],
            )

    return features


def _crc() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary"))


def held_out() -> Column:
    return _crc() % FOLDS == 0


def _evidence(one: Column, of_one: Column, other: Column, of_other: Column) -> Column:
    """Squared distance of two shares in standard errors; 0 if either has no base."""
    pooled = F.try_divide(one + other, of_one + of_other)
    apart = F.try_divide(one, of_one) - F.try_divide(other, of_other)
    error = pooled * (1 - pooled) * (F.try_divide(F.lit(1.0), of_one) + F.try_divide(F.lit(1.0), of_other))
    return F.coalesce(F.try_divide(apart * apart, error), F.lit(0.0))


def _ratios(half: str, seen: dict[str, float]) -> dict[str, Column]:
    """Logs of how much likelier an n-gram is in toxic texts, shrunk by the evidence for it.

    Both probabilities are backed off to the shared counts, so an n-gram after a context
    that one class never has counts too. ``overall`` takes the evidence of its shares of all
    n-grams of the two classes (``seen`` of them); ``after`` that of its shares after its
    context where that is greater. Few labels leave chance contexts that only ``after``
    believes; many labels make it the better one. The curve weighs the two.
    """
    toxic, ordinary = f"toxic_{half}", f"ordinary_{half}"
    likelier = F.log(F.col(f"p_{toxic}") / F.col(f"p_{ordinary}"))
    counts = F.col(toxic), F.col(ordinary)
    after = _evidence(counts[0], F.col(f"total_{toxic}"), counts[1], F.col(f"total_{ordinary}"))
    overall = _evidence(counts[0], F.lit(seen[toxic]), counts[1], F.lit(seen[ordinary]))
    told = ~F.col("gram").startswith(B.START * 3)  # the first letters mostly tell the language

    def shrunk(evidence: Column) -> Column:
        return F.when(told, likelier * evidence**2 / (evidence**2 + HALF_EVIDENCE**2)).otherwise(F.lit(0.0))

    return {f"after_{half}": shrunk(F.greatest(after, overall)), f"overall_{half}": shrunk(overall)}


_X = ("x1", "x2", "x3", "x4")


def _curve_features(after: Column, overall: Column) -> list[Column]:
    """A text's two ratios, each also times the log of its length."""
    found = [after, after * F.log1p("size"), overall, overall * F.log1p("size")]
    return [x.alias(name) for x, name in zip(found, _X)]


def _curve(train: DataFrame) -> np.ndarray:
    """Weights of a logistic curve over (1, x1 ... x4), by Newton steps.

    Each step sums thirty numbers over all training rows. The features are brought to mean
    square 1 first; a ridge keeps the curve defined where there is one class only.
    """
    n = 1 + len(_X)
    squares = train.agg(*(F.avg(F.col(x) ** 2) for x in _X)).first()
    scale = np.array([1.0, *(1 / np.sqrt(v) if v else 1.0 for v in squares)])
    x = [F.lit(1.0), *(F.col(name) * float(s) for name, s in zip(_X, scale[1:]))]
    ridge = np.diag([1e-3] + [RIDGE] * len(_X))
    w = np.zeros(n)
    for _ in range(_ROUNDS):
        p = 1 / (1 + F.exp(-sum(float(w[i]) * x[i] for i in range(n))))
        sums = [F.sum(x[i] * (F.col("toxic") - p)) for i in range(n)]
        sums += [F.sum(x[i] * x[j] * p * (1 - p)) for i in range(n) for j in range(n)]
        found = np.array([v or 0.0 for v in train.agg(*sums).first()])
        step = np.linalg.solve(found[n:].reshape(n, n) + ridge, found[:n] - ridge @ w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w * scale


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, ratio, score, predicted.

    ``labels`` has doc_id and toxic (0 or 1). Only documents whose crc32(doc_id) is not
    divisible by 5 are learnt from. ``score`` is from 0 to 1; ``predicted`` is 1 from 0.5
    on. Null and empty texts have ratio 0. Repeated label rows of a document count once,
    as toxic if one of them is; labels without a doc_id or a class are left out. Documents
    without a doc_id are scored and not learnt from. Other columns are not looked at. An
    empty table gives no rows; without labels all documents score alike.
    """
    session_of(docs)
    letters = F.lower(F.regexp_replace(whole_text(), r"[^\p{L}\p{M}]+", " "))
    texts = docs.select("doc_id", F.lit("").alias("group"), letters.alias("text"))
    blocks = B.write_blocks(texts)
    dictionary = B.dictionaries(blocks, ORDER)
    pooled = (
        dictionary.select("group", F.explode(F.arrays_zip("grams", "counts")).alias("g"))
        .groupBy("group", F.col("g.grams").alias("gram"))
        .agg(F.sum("g.counts").alias("c"))
    )
    known = (
        labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .where(~held_out())
        .groupBy("doc_id")
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
        .withColumn("half", F.when((_crc() / FOLDS).cast("long") % 2 == 0, "a").otherwise("b"))
    )
    places = blocks.select("block", F.posexplode("docs.doc_id").alias("place", "doc_id"))
    trained = stored(places.join(known, "doc_id"), "training-rows")
    by_block = trained.groupBy("block").agg(
        F.collect_list(F.struct("place", "toxic", "half")).alias("labelled")
    )
    classes = stored(
        blocks.join(by_block, "block")
        .mapInArrow(_class_counts, "gram string, " + ", ".join(f"{name} long" for name in _CLASSES))
        .groupBy("gram")
        .agg(*(F.sum(name).alias(name) for name in _CLASSES)),
        "class-counts",
    )
    shared = probabilities(stored(pooled, "gram-counts"), ORDER)
    model = class_probabilities(shared, classes, ORDER, _CLASSES)
    seen = {name: float(n or 0) for name, n in classes.agg(*(F.sum(c).alias(c) for c in _CLASSES)).first().asDict().items()}
    ratios = {name: r for half in HALVES for name, r in _ratios(half, seen).items()}
    answers, shards = B.answers(
        dictionary, model.select(F.lit("").alias("group"), "gram", *(ratios[name].alias(name) for name in _RATIOS))
    )
    found = blocks.join(answers, "block", "left").mapInArrow(
        _features(shards),
        "doc_id long, block long, place int, " + ", ".join(f"{name} double" for name in _RATIOS) + ", size double",
    )
    features = stored(found, "features")
    mean = {kind: (F.col(f"{kind}_a") + F.col(f"{kind}_b")) / 2 for kind in ("after", "overall")}
    # the curve learns from ratios of the half that has not counted the document
    unseen = {
        kind: F.when(F.col("half") == "a", F.col(f"{kind}_b")).otherwise(F.col(f"{kind}_a"))
        for kind in ("after", "overall")
    }
    train = features.join(trained.select("block", "place", "toxic", "half"), ["block", "place"]).select(
        "toxic", *_curve_features(unseen["after"], unseen["overall"])
    )
    w = _curve(stored(train, "training-features"))
    scored = features.select(
        "doc_id", mean["after"].alias("ratio"), *_curve_features(mean["after"], mean["overall"])
    )
    at = sum((float(v) * F.col(x) for v, x in zip(w[1:], _X)), F.lit(float(w[0])))
    score = F.round(1 / (1 + F.exp(-at)), 6)
    return scored.select(
        "doc_id",
        F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        "ratio",
        score.alias("score"),
        (score >= 0.5).cast("int").alias("predicted"),
    )
