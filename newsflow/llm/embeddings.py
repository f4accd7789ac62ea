"""Near-duplicate vectors by sorted projection passes.

A pass gives each vector the signs of 64 random projections, sorts all vectors of a label by
them, and compares each vector with the WINDOW ones before it. Vectors at cosine c agree in
a sign with probability 1 - acos(c) / pi, so close vectors often stay neighbours; the
passes draw their projections anew, and as many are made as leave a link unfound with
probability LOST at most. Verified links of all passes are closed to components.

Equal vectors are one node with a weight. All links lie inside components, so their number
is counted there, between blocks of bounded size: a window bounds the search, not the links.
"""

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from newsflow.llm.common import session_of, stored
from newsflow.llm.components import components

SIGNS = 64
WINDOW = 128
LOST = 0.001
# Vectors of a component in one block; a task compares two blocks.
BLOCK = 4096
# Rows that are compared with their windows at once.
_STEP = 256
_DOUBLES = "d"


def passes_for(n: int, cosine: float, window: int = WINDOW, lost: float = LOST) -> int:
    """Passes after which a pair at ``cosine`` among ``n`` vectors is unfound with probability ``lost``.

    A pair is compared in a pass if it agrees in the log2(n / window) signs that tell a
    window's vectors from others.
    """
    agree = 1 - math.acos(cosine) / math.pi
    found = agree ** math.log2(max(n / window, 1))
    return 1 if found > 1 - lost else math.ceil(math.log(lost) / math.log1p(-found))


def _prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with the space in which they are compared, a digest, and the packed vector."""
    for batch in batches:
        lists = batch["vector"]
        narrow = pa.types.is_float32(lists.type.value_type)
        kind, code = (np.float32, "f") if narrow else (np.float64, _DOUBLES)
        spaces, nodes, packed = [], [], []
        for i, (vec_id, label) in enumerate(zip(batch["vec_id"].to_pylist(), batch["label"].to_pylist())):
            vector = lists[i].values
            space = node = data = None
            if vec_id is not None and label is not None and vector is not None:
                values = vector.to_numpy(zero_copy_only=False).astype(np.float64)
                if len(values) and np.isfinite(values).all() and values.any():
                    space = f"{len(values)}{code} {label}"
                    data = values.astype(kind).tobytes()
                    node = hashlib.md5(space.encode() + b"\0" + data).digest()
            spaces.append(space)
            nodes.append(node)
            packed.append(data)
        yield pa.RecordBatch.from_arrays(
            [batch["vec_id"], pa.array(spaces, pa.string()), pa.array(nodes, pa.binary()), pa.array(packed, pa.binary())],
            names=["vec_id", "space", "node", "vector"],
        )


def _unit(space: str, packed: list[bytes]) -> np.ndarray:
    """Vectors of one space at length 1, in double precision."""
    kind = np.float64 if space.split(" ", 1)[0].endswith(_DOUBLES) else np.float32
    rows = np.frombuffer(b"".join(packed), dtype=kind).reshape(len(packed), -1).astype(np.float64)
    rows /= np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _runs(keys: list) -> Iterator[tuple[int, int]]:
    """Start and end of each run of equal keys."""
    start = 0
    for i in range(1, len(keys) + 1):
        if i == len(keys) or keys[i] != keys[start]:
            yield start, i
            start = i


def _signs(number: int):
    """Adds the signs of a pass's projections as the sort key of each vector."""

    def signs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        projections: dict[int, np.ndarray] = {}
        for batch in batches:
            spaces, packed = batch["space"].to_pylist(), batch["vector"].to_pylist()
            keys = []
            for start, end in _runs(spaces):
                rows = _unit(spaces[start], packed[start:end])
                size = rows.shape[1]
                if size not in projections:
                    projections[size] = np.random.default_rng([number, size]).standard_normal((size, SIGNS))
                bits = np.packbits(rows @ projections[size] > 0, axis=1)
                keys += [row.tobytes() for row in bits]
            columns = [batch["space"], pa.array(keys, pa.binary()), batch["node"], batch["vector"]]
            yield pa.RecordBatch.from_arrays(columns, names=["space", "key", "node", "vector"])

    return signs


class _Sets:
    """Sets of the rows of a window, joined as links come; each join is a link worth giving."""

    def __init__(self, rows: int) -> None:
        self.label = np.arange(rows)
        self.links: list[tuple[int, int]] = []

    def link(self, row: int, others: np.ndarray) -> None:
        """Join a row with the rows it is linked to."""
        labels, first = np.unique(self.label[others], return_index=True)
        for label, other in zip(labels, others[first]):
            if label != self.label[row]:
                self.links.append((row, int(other)))
        joined = np.append(labels, self.label[row])
        self.label[np.isin(self.label, joined)] = joined.min()


def _compared(rows: np.ndarray, old: int, window: int, cosine: float, cut: int | None = None) -> list[tuple[int, int]]:
    """Links of each row from ``old`` on with rows up to ``window`` places before it.

    Gives a forest of the links found. With ``cut`` only links across that place count.
    """
    sets = _Sets(len(rows))
    for start in range(old, len(rows), _STEP):
        end, least = min(start + _STEP, len(rows)), max(start - window, 0)
        near = rows[start:end] @ rows[least:end].T >= cosine
        i = np.arange(start, end)[:, None]
        j = np.arange(least, end)[None, :]
        near &= (j < i) & (i - j <= window)
        if cut is not None:
            near &= (j < cut) & (i >= cut)
        for row in np.flatnonzero(near.any(axis=1)):
            sets.link(start + int(row), least + np.flatnonzero(near[row]))
    return sets.links


_FOUND = pa.schema(
    [
        ("u", pa.binary()),
        ("v", pa.binary()),
        ("task", pa.int32()),
        ("place", pa.int64()),
        ("space", pa.string()),
        ("node", pa.binary()),
        ("vector", pa.binary()),
    ]
)
_FOUND_DDL = "u binary, v binary, task int, place long, space string, node binary, vector binary"


def _links(nodes: list[bytes], links: list[tuple[int, int]]) -> pa.RecordBatch:
    rows = [{"u": nodes[i], "v": nodes[j]} for i, j in links]
    return pa.RecordBatch.from_pylist(rows, schema=_FOUND)


def _windows(window: int, cosine: float):
    """Links inside a sorted partition, its rows near both ends, and its size (place of a row without node)."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, place = TaskContext.get().partitionId(), 0
        last: list[tuple] = []  # the rows before, for the end of the partition
        space, rows, nodes = None, np.empty((0, 0)), []

        def edges(chosen: list[tuple]) -> pa.RecordBatch:
            named = [dict(zip(("task", "place", "space", "node", "vector"), (task, *row))) for row in chosen]
            return pa.RecordBatch.from_pylist(named, schema=_FOUND)

        for batch in batches:
            columns = [batch[n].to_pylist() for n in ("space", "node", "vector")]
            for start, end in _runs(columns[0]):
                if columns[0][start] != space:
                    space, rows, nodes = columns[0][start], np.empty((0, 0)), []
                old = len(nodes)
                new = _unit(space, columns[2][start:end])
                rows = np.concatenate([rows, new]) if old else new
                nodes = nodes + columns[1][start:end]
                links = _compared(rows, old, window, cosine)
                if links:
                    yield _links(nodes, links)
                rows, nodes = rows[-window:], nodes[-window:]
            numbered = list(zip(range(place, place + batch.num_rows), *columns))
            if place < window:
                yield edges(numbered[: window - place])
            last = (last + numbered)[-window:]
            place += batch.num_rows
        yield edges([row for row in last if row[0] >= window])
        yield edges([(place, None, None, None)])

    return windows


def _to_boundaries(starts: np.ndarray, window: int):
    """Rows near partition ends, once for each boundary between partitions in reach."""
    bounds = np.unique(starts)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank = starts[batch["task"].to_numpy()] + batch["place"].to_numpy()
            low = np.searchsorted(bounds, rank - window, side="right")
            times = np.searchsorted(bounds, rank + window, side="right") - low
            row = np.repeat(np.arange(len(rank)), times)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
            bound = bounds[low[row] + nth]
            taken = batch.select(["space", "node", "vector"]).take(pa.array(row))
            yield pa.RecordBatch.from_arrays(
                [pa.array(bound), pa.array(rank[row]), *taken.columns], names=["bound", "rank", "space", "node", "vector"]
            )

    return deal


def _groups(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[dict[str, list]]:
    """Columns of each run of rows with equal keys, from sorted batches."""
    held: dict[str, list] | None = None
    key = None
    for batch in batches:
        columns = batch.to_pydict()
        row_keys = list(zip(*(columns[k] for k in keys)))
        for start, end in _runs(row_keys):
            part = {name: values[start:end] for name, values in columns.items()}
            if held is not None and row_keys[start] == key:
                for name in held:
                    held[name] += part[name]
                continue
            if held is not None:
                yield held
            held, key = part, row_keys[start]
    if held is not None:
        yield held


def _across(window: int, cosine: float):
    """Links across one boundary, between rows up to ``window`` places apart."""

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, "bound", "space"):
            before = sum(rank < group["bound"][0] for rank in group["rank"])
            if 0 < before < len(group["rank"]):
                rows = _unit(group["space"][0], group["vector"])
                links = _compared(rows, before, window, cosine, cut=before)
                if links:
                    yield _links(group["node"], links).select(["u", "v"])

    return across


def sorted_pass(nodes: DataFrame, number: int, cosine: float, window: int = WINDOW) -> DataFrame:
    """Links (u, v) that one pass finds among ``nodes`` (space, node, vector)."""
    order = ["space", "key", "node"]
    keyed = nodes.select("space", "node", "vector").mapInArrow(
        _signs(number), "space string, key binary, node binary, vector binary"
    )
    found = stored(
        keyed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_windows(window, cosine), _FOUND_DDL),
        "windows",
    )
    sizes = dict(found.where("u IS NULL AND node IS NULL").select("task", "place").collect())  # a number per task
    starts = np.zeros(max(sizes, default=0) + 1, dtype=np.int64)
    for task, size in sizes.items():
        if task + 1 < len(starts):
            starts[task + 1] = size
    starts = np.cumsum(starts)
    inside = found.where("u IS NOT NULL").select("u", "v")
    edges = found.where("u IS NULL AND node IS NOT NULL").select("task", "place", "space", "node", "vector")
    near = edges.mapInArrow(
        _to_boundaries(starts, window), "bound long, rank long, space string, node binary, vector binary"
    )
    across = (
        near.repartition("bound")
        .sortWithinPartitions("bound", "space", "rank")
        .mapInArrow(_across(window, cosine), "u binary, v binary")
    )
    return inside.unionByName(across)


def _counts(cosine: float):
    """Weights of the vectors linked with each vector, between two blocks of a component."""

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, "component", "low", "high", "space"):
            rows = _unit(group["space"][0], group["vector"])
            weight = np.array(group["weight"], dtype=np.int64)
            own = np.array(group["own"])
            low, high = group["low"][0], group["high"][0]
            one, other = np.flatnonzero(own == low), np.flatnonzero(own == high)
            found = np.zeros(len(rows), dtype=np.int64)
            for start in range(0, len(one), _STEP):
                i = one[start : start + _STEP]
                near = rows[i] @ rows[other].T >= cosine
                if low == high:
                    near &= i[:, None] != other[None, :]
                else:
                    found[other] += weight[i] @ near
                found[i] += near @ weight[other]
            yield pa.RecordBatch.from_arrays([pa.array(group["node"], pa.binary()), pa.array(found)], names=["node", "links"])

    return counts


def link_counts(members: DataFrame, cosine: float, block: int = BLOCK) -> DataFrame:
    """node, links: the weights of all linked vectors, from ``members`` (component, space, node, vector, weight).

    A component is cut into blocks by a hash; each pair of its blocks is compared in one
    place, whatever the component's size.
    """
    sizes = members.groupBy("component").agg(F.ceil(F.count("*") / block).alias("blocks"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks"))
    dealt = members.join(sizes, "component").withColumn("own", own)
    pairs = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pairs = pairs.select(
        "component",
        F.least("own", "other").alias("low"),
        F.greatest("own", "other").alias("high"),
        "own",
        "space",
        "node",
        "vector",
        "weight",
    )
    keys = ["component", "low", "high"]
    counted = (
        pairs.repartition(*keys).sortWithinPartitions(*keys, "space").mapInArrow(_counts(cosine), "node binary, links long")
    )
    return counted.groupBy("node").agg(F.sum("links").alias("links"))


def near_vectors(
    rows: DataFrame,
    cosine: float = 0.98,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    window: int = WINDOW,
    lost: float = LOST,
    block: int = BLOCK,
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Vectors of one label link at a cosine of ``cosine`` or more, in double precision.
    Vectors that are null, empty or zero, hold null or non-finite components, or have no label or
    vec_id link with nothing; so do vectors of different lengths. Each of several rows with one
    vec_id is a vector of its own and links with the others if their vectors do. Without
    links ``component_id`` is the own vec_id. ``kept`` marks the least vec_id of a component,
    and rows without one. Other columns are not looked at. An empty table gives no rows.
    """
    session_of(rows)
    chosen = rows.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("vector"), F.col(label).cast("string").alias("label")
    )
    prepared = stored(
        chosen.mapInArrow(_prepare, "vec_id long, space string, node binary, vector binary"), "vectors"
    )
    nodes = stored(
        prepared.where("node IS NOT NULL")
        .groupBy("space", "node")
        .agg(F.first("vector").alias("vector"), F.count("*").alias("weight"), F.min("vec_id").alias("least")),
        "distinct-vectors",
    )
    n = nodes.count()
    links = None
    for number in range(passes_for(n, cosine, window, lost)):
        found = stored(sorted_pass(nodes, number, cosine, window), "links")
        links = found if links is None else links.unionByName(found)
    groups = components(links.distinct())
    members = stored(nodes.join(groups, "node"), "members")
    least = members.groupBy("component").agg(F.min("least").alias("component_id"))
    linked = (
        members.select("node", "component")
        .join(least, "component")
        .join(link_counts(members, cosine, block), "node")
        .select("node", "component_id", "links")
    )
    alone = nodes.where("weight > 1").join(linked, "node", "left_anti")
    known = linked.join(nodes.select("node", "weight"), "node").unionByName(
        alone.select("node", F.col("least").alias("component_id"), F.lit(0).cast("long").alias("links"), "weight")
    )
    component = F.coalesce("component_id", "vec_id")
    return prepared.select("vec_id", "node").join(known, "node", "left").select(
        F.col("vec_id").alias("vec_id"),
        F.coalesce(F.col("links") + F.col("weight") - 1, F.lit(0)).alias("n_links"),
        component.alias("component_id"),
        component.eqNullSafe(F.col("vec_id")).alias("kept"),
    )
