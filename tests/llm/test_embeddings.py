"""Near-duplicate vectors against all pairs."""

import math

import numpy as np
import pytest

from newsflow.llm import embeddings


def brute(rows, cosine):
    """vec_id -> (n_links, component_id), for rows with distinct ids."""
    def usable(vector, label):
        return label is not None and vector and all(x is not None and math.isfinite(x) for x in vector) and any(vector)

    units = {i: (l, np.array(v, dtype=float) / np.linalg.norm(np.array(v, dtype=float))) for i, v, l in rows if usable(v, l)}
    links = {i: [] for i, _, _ in rows}
    for i, (l, u) in units.items():
        for j, (m, w) in units.items():
            if i != j and l == m and len(u) == len(w) and u @ w >= cosine:
                links[i].append(j)
    found = {}
    for i in links:
        seen, todo = {i}, [i]
        while todo:
            todo += [k for k in links[todo.pop()] if k not in seen and not seen.add(k)]
        found[i] = len(links[i]), min(seen)
    return found


def as_found(frame):
    rows = frame.collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in rows)
    return {r.vec_id: (r.n_links, r.component_id) for r in rows}


def crowd(size, near, seed):
    """Vectors at random, and a crowd around one of them."""
    rng = np.random.default_rng(seed)
    far = rng.standard_normal((size, 16))
    close = far[0] + 0.13 * rng.standard_normal((near, 16)) * np.linalg.norm(far[0]) / 4
    return [(i, [float(np.float32(x)) for x in v], i % 2 if i < size else 0) for i, v in enumerate([*far, *close])]


SCHEMA = "vec_id long, embedding array<float>, label int"


def test_as_all_pairs(spark):
    rows = crowd(300, 120, 1)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    expected = brute(rows, 0.98)
    assert max(n for n, _ in expected.values()) > 20
    assert as_found(embeddings.near_vectors(frame, 0.98)) == expected


def test_blocks_of_a_component_are_compared_with_each_other(spark):
    rows = crowd(50, 60, 2)
    frame = spark.createDataFrame(rows, SCHEMA)
    assert as_found(embeddings.near_vectors(frame, 0.95, block=7)) == brute(rows, 0.95)


@pytest.mark.parametrize("window", [1, 5])
def test_windows_reach_over_partition_ends(spark, window):
    """One pass over many small partitions finds the links of one sorted list."""
    rows = crowd(60, 20, 3)
    frame = spark.createDataFrame(rows, SCHEMA)
    prepared = frame.selectExpr("vec_id", "embedding AS vector", "cast(label AS string) AS label").mapInArrow(
        embeddings._prepare, "vec_id long, space string, node binary, vector binary"
    ).where("space LIKE '% 0'")
    nodes = prepared.select("space", "node", "vector")
    found = set()
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    for parts, coalesce in (("1", "true"), ("31", "false")):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
        from newsflow.llm.components import components
        groups = components(embeddings.sorted_pass(nodes, 0, 0.9, window).distinct())
        found.add(frozenset((bytes(r.node), bytes(r.component)) for r in groups.collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert len(found) == 1 and found.pop()


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1),
        (6, [], 1), (7, [0.0, 0.0], 1), (8, [1.0, nan], 1), (9, [1.0, inf], 1), (10, [1.0, None], 1),
        (11, [1.0, 0.0, 0.0], 1), (12, [-1.0, 0.0], 1), (13, [1.0, 0.0], 1), (14, [1e-30, 1e-32], 1),
    ]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr(
        "*", *(f"'x' AS {n}" for n in "node space vector weight least component low high own links u v".split())
    )
    assert as_found(embeddings.near_vectors(frame)) == brute(rows, 0.98)
    repeated = spark.createDataFrame([*rows, (1, [1.0, 0.0], 1), (None, [1.0, 0.0], 1)], SCHEMA)
    found = [tuple(r) for r in embeddings.near_vectors(repeated).collect()]
    assert found.count((1, 4, 1, True)) == 2 and (2, 4, 1, False) in found and (None, 0, None, True) in found
    assert embeddings.near_vectors(frame.limit(0)).count() == 0
    wide = spark.createDataFrame([(1, [1e300, 1e300], "a"), (2, [1e-300, 1e-300], "a")], "vec_id long, embedding array<double>, label string")
    assert as_found(embeddings.near_vectors(wide)) == {1: (1, 1), 2: (1, 1)}


def test_passes_grow_with_the_input():
    assert [embeddings.passes_for(n, 0.98) for n in (0, 100)] == [1, 1]
    assert embeddings.passes_for(10**4, 0.98) < embeddings.passes_for(10**9, 0.98) < 60
