"""Near-duplicate embeddings by a subspace pigeonhole join.

Unit vectors with cosine >= t lie within squared distance ``T = 2 - 2t``. After a fixed random
rotation the coordinates are cut into blocks; each block gets the share of T that its number of
dimensions has of all, and by the pigeonhole principle a linked pair keeps within the share of at
least one block. Each block is a range join of its own. A k-d tree over all coordinates of the block, its
splits taken from a bounded sample (``SAMPLE_VECTORS``), has one leaf for every ``PART_VECTORS`` vectors. A vector is at home in
one leaf and visits those later leaves whose box lies within the budget of it: a vector of such a leaf that links with
it can't be farther. Leaves and their visitors are cut into bounded parts, and a task compares one part with another.
There the home vectors fall into small cells by further splits, and a cell meets only the vectors
within the budget of its bounding box. Block distances select the candidates, the exact cosine in
double precision verifies them. A pair that an earlier block finds too is left to that block, so the links of the blocks
add up without a distinct. The sample moves the boxes and so the work, never the links.

Equal vectors are one class and are not compared with each other. A task returns the number of
links of each vector, and a spanning forest of its links; components come from the forests. No
list of pairs is made, however large a group of near copies is. Vectors without any structure (as far from each
other as random ones) still visit a large part of the leaves; the more vectors, the more splits tell them apart.

A vector that is null, zero, or has a null or non-finite component links with nothing, nor does a
row with a null id (its component is null). Vectors of different length don't link. Repeated rows
count as one vector.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardflow.llm.common import per_group, ship_code, written
from cardflow.llm.components import connected_components

BLOCKS = 4
PART_VECTORS = 8192
#: Vectors that the trees' splits are taken from, and leaves a block has at most (further vectors: more parts).
SAMPLE_VECTORS, MAX_LEAVES = 8192, 4096
#: Vectors of a cell within a task.
CELL_VECTORS = 128
#: Slack of the budgets against rounding: more candidates, never fewer links.
SLACK = 1e-7


@lru_cache(maxsize=8)
def rotation(dim: int, seed: int = 20240601) -> np.ndarray:
    """A fixed random orthonormal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def block_bounds(dim: int, blocks: int = BLOCKS) -> list[tuple[int, int]]:
    cuts = np.linspace(0, dim, min(blocks, dim) + 1).astype(int).tolist()
    return list(zip(cuts, cuts[1:]))


def _unit(flat: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(vectors, unit vectors) as double matrices; scaled first so that no square over- or underflows."""
    x = flat.reshape(rows, -1).astype(np.float64)
    scaled = x / np.abs(x).max(axis=1, keepdims=True)
    return x, scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def leaf_boxes(points: np.ndarray, leaves: int) -> tuple[np.ndarray, np.ndarray]:
    """(lower, upper) bounds of up to ``leaves`` boxes that cover all space: medians of the points split the
    coordinate in which those of a box vary most."""
    width = points.shape[1]
    todo = [(np.arange(len(points)), np.full(width, -np.inf), np.full(width, np.inf), leaves)]
    boxes = []
    while todo:
        rows, low, high, wanted = todo.pop()
        own = points[rows]
        c = int(own.var(axis=0).argmax()) if len(rows) > 1 else 0
        if wanted < 2 or len(rows) < 2 or own[:, c].min() == own[:, c].max():
            boxes.append((low, high))
            continue
        at = np.median(own[:, c])
        left, right = high.copy(), low.copy()
        left[c] = right[c] = at
        below = own[:, c] <= at
        todo.append((rows[~below], right, high, wanted // 2))
        todo.append((rows[below], low, left, wanted // 2))
    return np.array([b[0] for b in boxes]), np.array([b[1] for b in boxes])


def _outside(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of each point from each box."""
    out = np.zeros((len(points), len(low)))
    for c in range(points.shape[1]):
        x = points[:, c, None]
        gap = np.maximum(np.maximum(low[None, :, c] - x, x - high[None, :, c]), 0.0)
        out += gap * gap
    return out


def _budgets(cosine: float, dim: int) -> list[float]:
    return [(2 - 2 * cosine + SLACK) * (b - a) / dim for a, b in block_bounds(dim)]


Trees = dict[int, list[tuple[np.ndarray, np.ndarray]]]


def _trees(classes: DataFrame, cosine: float) -> Trees:
    """The boxes of each block's leaves, by number of dimensions. A number that the sample lacks has none: one leaf."""
    count = classes.count()
    column = classes.orderBy(F.xxhash64("class_id"), "class_id", "vector").limit(SAMPLE_VECTORS).select(
        "vector").toArrow().column("vector").combine_chunks()
    lengths = column.value_lengths().to_numpy()
    flat, starts = column.flatten().to_numpy(), np.cumsum(lengths) - lengths
    out = {}
    for dim in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == dim)
        parts = max(1.0, count * (len(rows) / len(lengths)) / PART_VECTORS)
        leaves = min(MAX_LEAVES, 1 << math.ceil(math.log2(parts)))
        _, unit = _unit(flat[starts[rows][:, None] + np.arange(dim)], len(rows))
        turned = unit @ rotation(dim)
        out[dim] = [leaf_boxes(turned[:, a:b], leaves) for a, b in block_bounds(dim)]
    return out


def _places(cosine: float, trees: Trees):
    """mapInArrow: one row for each vector and block with its leaf and the later leaves that it visits."""

    def leaves_of(points: np.ndarray, boxes, budget: float):
        low, high = boxes
        step = max(1, (1 << 21) // len(low))
        for at in range(0, len(points), step):
            far = _outside(points[at:at + step], low, high)
            home = far.argmin(axis=1)
            near = (far <= budget) & (np.arange(len(low))[None, :] > home[:, None])
            yield home, near.sum(axis=1), np.nonzero(near)[1]

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            column = batch.column(2)
            lengths = column.value_lengths().to_numpy()
            flat, starts = column.flatten().to_numpy(), np.cumsum(lengths) - lengths
            for dim in np.unique(lengths).tolist():
                rows = np.flatnonzero(lengths == dim)
                _, unit = _unit(flat[starts[rows][:, None] + np.arange(dim)], len(rows))
                turned = unit @ rotation(dim)
                for k, ((a, b), budget) in enumerate(zip(block_bounds(dim), _budgets(cosine, dim))):
                    all_space = np.full((1, b - a), -np.inf), np.full((1, b - a), np.inf)
                    boxes = trees[dim][k] if dim in trees else all_space
                    home, sizes, visits = (np.concatenate(x) for x in zip(*leaves_of(turned[:, a:b], boxes, budget)))
                    take = pa.array(rows)
                    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(take), batch.column(1).take(take), column.take(take),
                         pa.array(np.full(len(rows), dim)), pa.array(np.full(len(rows), k)), pa.array(home.astype(np.int64)),
                         pa.ListArray.from_arrays(pa.array(ends), pa.array(visits.astype(np.int64)))],
                        names=["class_id", "copies", "vector", "dim", "block", "leaf", "visits"])

    return run


def _cells(points: np.ndarray, rows: np.ndarray, size: int) -> list[np.ndarray]:
    """``rows`` cut at medians of the coordinate in which they vary most, into cells of at most ``size``."""
    todo, out = [rows], []
    while todo:
        own = todo.pop()
        if len(own) <= size:
            out.append(own)
            continue
        c = points[own].var(axis=0).argmax()
        order = own[np.argsort(points[own, c], kind="stable")]
        todo += [order[len(order) // 2:], order[:len(order) // 2]]
    return out


def _compare(cosine: float, cell: int):
    """Links between the two parts of a task, or within its only part, and a row without ends that counts the
    pairs whose block distance was computed."""

    def compare(group: pa.Table) -> pa.RecordBatch:
        ids = group.column("class_id").to_numpy()
        copies = group.column("copies").to_numpy()
        side = group.column("side").to_numpy()
        inside = bool(group.column("inside")[0].as_py())
        k, dim = int(group.column("block")[0].as_py()), int(group.column("dim")[0].as_py())
        _, unit = _unit(group.column("vector").combine_chunks().flatten().to_numpy(), len(ids))
        turned = unit @ rotation(dim)
        bounds, budget = block_bounds(dim), _budgets(cosine, dim)
        a, b = bounds[k]
        low = turned[:, a:b].astype(np.float32)
        squares = (low * low).sum(axis=1)
        bound = np.float32(budget[k] + 1e-5)
        cells = _cells(low, np.arange(len(ids)) if inside else np.flatnonzero(side == side.min()), cell)
        # within one part a cell meets itself and the cells behind it
        right = np.concatenate(cells) if inside else np.flatnonzero(side != side.min())
        links = np.zeros(len(ids), dtype=np.int64)
        root = np.arange(len(ids))
        compared = done = 0
        for rows in cells:
            others = right[done:] if inside else right
            done += len(rows)
            away = _outside(low[others].astype(np.float64), low[rows].min(axis=0)[None, :], low[rows].max(axis=0)[None, :])[:, 0]
            meets = away <= bound
            if inside:
                meets[:len(rows)] = True
            others = others[meets]
            compared += len(rows) * len(others)
            gram = low[rows] @ low[others].T
            gram *= -2
            gram += squares[rows][:, None]
            gram += squares[others][None, :]
            if inside:  # each pair of the cell once
                gram[:, :len(rows)][np.tri(len(rows), dtype=bool)] = np.inf
            u, v = np.nonzero(gram <= bound)
            u, v = rows[u], others[v]
            found_u, found_v = [], []
            for c in range(0, len(u), 1 << 16):
                p, q = u[c:c + (1 << 16)], v[c:c + (1 << 16)]
                first = np.ones(len(p), dtype=bool)
                for j in range(k):
                    d = turned[p, bounds[j][0]:bounds[j][1]] - turned[q, bounds[j][0]:bounds[j][1]]
                    first &= (d * d).sum(axis=1) > budget[j]
                d = turned[p, a:b] - turned[q, a:b]
                first &= (d * d).sum(axis=1) <= budget[k]
                p, q = p[first], q[first]
                good = np.einsum("ij,ij->i", unit[p], unit[q]) >= cosine
                p, q = p[good], q[good]
                np.add.at(links, p, copies[q])
                np.add.at(links, q, copies[p])
                found_u.append(p)
                found_v.append(q)
            if any(map(len, found_u)):  # a forest is kept, not the pairs
                root = _roots(root, np.concatenate([*found_u, np.arange(len(root))]), np.concatenate([*found_v, root]))
        linked = np.flatnonzero(links)
        tied = np.flatnonzero(root != np.arange(len(root)))
        n = len(linked)
        return pa.RecordBatch.from_arrays(
            [pa.array([*ids[linked].tolist(), *ids[tied].tolist(), None], pa.int64()),
             pa.array([None] * n + ids[root[tied]].tolist() + [None], pa.int64()),
             pa.array(np.concatenate([links[linked], np.zeros(len(tied), np.int64), [compared]]))], names=["u", "v", "links"])

    return compare


def _roots(root: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Least index connected to each index by the pairs (u, v) and the given roots."""
    label = root.copy()
    while True:
        new = label.copy()
        low = np.minimum(label[u], label[v])
        np.minimum.at(new, u, low)
        np.minimum.at(new, v, low)
        np.minimum.at(new, label[u], low)
        np.minimum.at(new, label[v], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def links_between(classes: DataFrame, cosine: float) -> DataFrame:
    """(u, v, links) of distinct vectors (class_id, copies, vector): the links of u where v is null, an edge of a
    spanning forest where it is not, and the pairs that a task compared where both are."""
    placed = written(classes.select("class_id", "copies", "vector").mapInArrow(
        _places(cosine, _trees(classes, cosine)),
        "class_id long, copies long, vector array<double>, dim long, block long, leaf long, visits array<long>"),
        "vector-places")
    key = ["dim", "block", "leaf"]
    # one row for each leaf: their number is bounded, whatever that of the vectors
    parts = placed.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / PART_VECTORS).alias("parts"))
    visitors = placed.select("dim", "block", F.explode("visits").alias("leaf")).groupBy(*key).agg(
        F.ceil(F.count(F.lit(1)) / (2 * PART_VECTORS)).alias("crowds"))
    sizes = written(parts.join(visitors, key, "left").select(
        *key, "parts", F.coalesce("crowds", F.lit(0)).cast("long").alias("crowds")), "vector-leaves")
    number = lambda n: F.pmod(F.xxhash64("class_id"), n)
    below = lambda n: F.filter(F.sequence(F.lit(0).cast("long"), n), lambda j: j < n)
    task = lambda kind, i, j, inside, side: F.struct(
        F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"), F.lit(inside).alias("inside"), side.cast("long").alias("side"))
    own = F.col("own")
    home = placed.join(F.broadcast(sizes), key).withColumn("own", number(F.col("parts")))
    at_home = F.concat(
        F.array(task(0, own, own, True, own)),
        F.transform(F.filter(below(F.col("parts")), lambda j: j != own),
                    lambda j: task(0, F.least(own, j), F.greatest(own, j), False, own)),
        F.transform(below(F.col("crowds")), lambda j: task(1, own, j, False, F.lit(0))))
    visiting = placed.withColumn("leaf", F.explode("visits")).join(F.broadcast(sizes), key).withColumn(
        "own", number(F.col("crowds")))
    as_visitor = F.transform(below(F.col("parts")), lambda j: task(1, j, own, False, F.lit(1)))
    columns = [F.xxhash64(*key, "t.kind", "t.i", "t.j").alias("task"), "class_id", "copies", "vector", "dim", "block",
               "t.inside", "t.side"]
    sent = home.withColumn("t", F.explode(at_home)).select(*columns).unionByName(
        visiting.withColumn("t", F.explode(as_visitor)).select(*columns))
    return written(per_group(sent, "task", _compare(cosine, CELL_VECTORS), "u long, v long, links long"), "vector-links")


def near_duplicates(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding",
                    cosine: float = 0.9) -> DataFrame:
    """(vec_id, n_links, component_id, kept): one row for each row of ``vectors``."""
    spark = vectors.sparkSession
    ship_code(spark)
    v = F.col("vector")
    finite = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = F.col("vec_id").isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0)
    base = vectors.select(F.col(vec_id).cast("long").alias("vec_id"),
                          F.col(vector).cast("array<double>").alias("vector")).withColumn(
        "usable", F.coalesce(usable, F.lit(False)))
    one = base.filter("usable").select("vec_id", "vector").distinct()
    classes = written(one.groupBy("vector").agg(F.min("vec_id").alias("class_id"), F.count(F.lit(1)).alias("copies")),
                      "vector-classes")

    found = links_between(classes, cosine)
    links = found.filter("u is not null and v is null").groupBy(F.col("u").alias("class_id")).agg(F.sum("links").alias("links"))
    component = connected_components(found.filter("v is not null").select("u", "v").union(
        # an id with several vectors ties their classes
        one.join(classes, "vector").filter("vec_id <> class_id").select(F.col("class_id"), F.col("vec_id"))))
    per_class = classes.join(links, "class_id", "left").select(
        "vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    joined = base.join(per_class.withColumn("usable", F.lit(True)), ["vector", "usable"], "left").join(
        component.withColumnRenamed("node", "vec_id"), "vec_id", "left")
    label = F.coalesce("component", "vec_id")
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                         label.alias("component_id"), F.coalesce(label == F.col("vec_id"), F.lit(False)).alias("kept"))
