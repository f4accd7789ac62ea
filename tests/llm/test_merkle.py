"""Merkle manifest against trees built in plain Python."""

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from newsflow.llm import merkle

FIELDS = ("doc_id", "source", "lang", "text")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes):
    """Levels from the leaves to the top."""
    found = [nodes]
    while len(found[-1]) > 1:
        own = found[-1]
        found.append([sha("".join(own[i : i + 3])) for i in range(0, len(own), 3)])
    return found


def siblings(levels, i):
    path = []
    for level in levels[:-1]:
        run = i - i % 3
        path += level[run:i] + level[i + 1 : run + 3]
        i //= 3
    return path


def brute(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append((row[0], leaf(row)))
    trees = {}
    for source, own in groups.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees[source] = climb([h for _, h in own])
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    above = climb([trees[s][-1][0] for s in order])
    return Counter(
        (doc, h, trees[s][-1][0], above[-1][0], sha("".join(siblings(trees[s], i) + siblings(above, order.index(s)))))
        for s in order
        for i, (doc, h) in enumerate(groups[s])
    )


def checked(docs):
    found = merkle.manifest(docs, FIELDS).select(
        "doc_id", "leaf", "subroot", "root", merkle.proof_hash(F.col("path")).alias("proof"),
        merkle.folded(F.col("leaf"), F.col("path")).alias("folded"),
        merkle.folded(F.lit("0" * 64), F.col("path")).alias("forged"),
    )
    rows = found.collect()
    assert all(r.folded == r.root != r.forged for r in rows)
    return Counter(tuple(r)[:5] for r in rows)


def test_manifest_of_odd_rows(tricky, nothing):
    rows = [tuple(r) for r in tricky.select(*FIELDS).collect()]
    assert checked(tricky) == brute(rows)
    assert merkle.manifest(nothing, FIELDS).count() == 0


@pytest.mark.parametrize("sizes", [[1], [2], [3], [4], [1, 1], [9, 10, 1, 28], [1] * 10])
def test_manifest_of_any_size(spark, sizes):
    rows = [(1000 * s + i, f"s{s}", "en", "x") for s, n in enumerate(sizes) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, text string")
    assert checked(docs.repartition(5)) == brute(rows)


def test_a_changed_row_does_not_verify(spark):
    docs = spark.range(50).selectExpr("id AS doc_id", "'s' AS source", "'en' AS lang", "cast(id AS string) AS text")
    changed = merkle.leaf_hash(*(F.lit("?") if n == "text" else F.col(n) for n in FIELDS))
    found = merkle.manifest(docs, FIELDS, extra={"changed": changed})
    assert found.where(merkle.folded(F.col("changed"), F.col("path")) == F.col("root")).count() == 0
