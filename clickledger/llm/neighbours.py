"""Approximate nearest neighbours by a forest of random-projection trees.

Equal vectors are one point first, with the few smallest ids that any answer can need. The trees are
fitted on a bounded sample of points: a node parts its points by the plane halfway between two of
them. Below the sample's leaves, tables larger than the sample go on parting by random planes through
the leaf's middle, so leaves stay small at any size of the table. Every point is put in its leaf of
every tree. A query keeps one priority queue over the nodes of all trees, ordered by the squared distances to
the planes that part it from them, and visits leaves from the front of it. How many is measured on the
table itself: the nearest points of some of the queries are found by brute force, and the number of leaves
is raised until enough of them lie in the leaves visited. Points and visiting queries meet at the leaves,
where exact cosines decide.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import batch_limits, batches, step


@dataclass(frozen=True)
class Forest:
    """`sample`: points that the trees are fitted on, at most. `leaf`: points of the sample in a leaf at
    most. `candidates`: points that the leaves visited for a query are expected to hold together, at least;
    more are visited until the `checked` queries that are compared with brute force find a share of `recall`
    of their nearest points."""

    trees: int = 16
    leaf: int = 64
    sample: int = 50_000
    candidates: int = 45_000
    recall: float = 0.95
    checked: int = 200
    seed: int = 5


@dataclass
class Tree:
    """Planes of the inner nodes; a child c < 0 is leaf number -c - 1."""

    planes: np.ndarray
    limits: np.ndarray
    children: np.ndarray
    middles: np.ndarray  # of leaves
    below: np.ndarray  # planes for parting leaves further


def fit_tree(points: np.ndarray, leaf: int, levels: int, seed: int) -> Tree:
    """Part unit vectors until at most `leaf` are together."""
    draw = np.random.default_rng(seed)
    planes, limits, children, middles = [], [], [], []

    def node(rows: np.ndarray) -> int:
        if len(rows) <= leaf:
            middles.append(points[rows].mean(0) if len(rows) else np.zeros(points.shape[1]))
            return -len(middles)
        one, two = points[draw.choice(rows, 2, replace=False)]
        plane = one - two
        side = points[rows] @ plane
        limit = float((one + two) @ plane / 2)
        right = side > limit
        if not 0.05 < right.mean() < 0.95:  # lopsided: part at the median of the same plane
            limit = float(np.median(side))
            right = side > limit
        if right.all() or not right.any():
            right = np.arange(len(rows)) % 2 == 1
        number = len(planes)
        norm = np.linalg.norm(plane) or 1.0
        planes.append(plane / norm)
        limits.append(limit / norm)
        children.append([0, 0])
        children[number] = [node(rows[~right]), node(rows[right])]
        return number

    node(np.arange(len(points)))
    size = points.shape[1]
    below = draw.normal(size=(levels, size))
    below /= np.linalg.norm(below, axis=1, keepdims=True)
    return Tree(
        np.array(planes, np.float64).reshape(-1, size),
        np.array(limits, np.float64),
        np.array(children, np.int64).reshape(-1, 2),
        np.array(middles, np.float64),
        below,
    )


def place(tree: Tree, points: np.ndarray) -> np.ndarray:
    """Leaf of each point: the tree's leaf and the sides of the planes below it, in one number."""
    at = np.full(len(points), 0 if len(tree.planes) else -1, np.int64)
    inner = np.flatnonzero(at >= 0)
    while len(inner):
        nodes = at[inner]
        right = np.einsum("ij,ij->i", points[inner], tree.planes[nodes]) > tree.limits[nodes]
        at[inner] = tree.children[nodes, right.astype(np.int64)]
        inner = inner[at[inner] >= 0]
    code = -at - 1
    for plane in tree.below:
        right = (points - tree.middles[-at - 1]) @ plane > 0
        code = code * 2 + right
    return code


def visits(trees: list[Tree], point: np.ndarray, leaves: int) -> Iterator[tuple[int, int]]:
    """The first leaves (tree, leaf) from one queue over all trees, nearest planes first."""
    # (squared distances to the planes crossed, tree, node or leaf, level below the leaf, leaf code)
    queue = [(0.0, t, 0 if len(tree.planes) else -1, 0, 0) for t, tree in enumerate(trees)]
    heapq.heapify(queue)
    sides = [tree.planes @ point - tree.limits if len(tree.planes) else None for tree in trees]
    found = 0
    while queue and found < leaves:
        far, t, at, level, code = heapq.heappop(queue)
        tree = trees[t]
        while at >= 0:
            margin = sides[t][at]
            near, other = tree.children[at, [int(margin > 0), int(margin <= 0)]]
            heapq.heappush(queue, (far + margin * margin, t, int(other), 0, 0))
            at = int(near)
        if not level:
            code = -at - 1
        while level < len(tree.below):
            margin = float((point - tree.middles[-at - 1]) @ tree.below[level])
            level += 1
            heapq.heappush(queue, (far + margin * margin, t, at, level, code * 2 + int(margin <= 0)))
            code = code * 2 + int(margin > 0)
        found += 1
        yield t, code


def _usable(vector: Column) -> Column:
    """No NULL, zero or empty vector, none with NULL or non-finite components."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & good & F.exists(vector, lambda x: x != 0)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(len(column), -1)


def _units(vectors: np.ndarray) -> np.ndarray:
    # by the largest component first, so that no square overflows or vanishes
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(1, keepdims=True))


def fit_forest(points: DataFrame, how: Forest, size: int) -> list[Tree]:
    """Fit the trees on the points whose hashes are lowest, at most `sample` of all `size`."""
    rows = points.orderBy("digest").limit(how.sample).select("vector").toArrow()
    if not rows.num_rows:
        return []
    vectors = _units(_matrix(rows.column("vector").combine_chunks()))
    levels = max(0, int(np.ceil(np.log2(size / len(vectors)))))
    return [fit_tree(vectors, how.leaf, levels, how.seed * 1000 + t) for t in range(how.trees)]


def all_leaves(trees: list[Tree]) -> int:
    return sum(len(tree.middles) << len(tree.below) for tree in trees)


def leaves_for(trees: list[Tree], size: int, candidates: int) -> int:
    """Leaves that hold so many of `size` points together, one of each tree at least.

    Every tree holds all points, however far its leaves were parted.
    """
    return max(len(trees), -(-candidates * all_leaves(trees) // (size * len(trees))))


def nearest_by_force(points: DataFrame, asked: pa.Table, k: int) -> list[np.ndarray]:
    """Unit vectors of the `k` nearest other points of each asked point, by comparing it with all."""
    names = np.asarray(asked.column("point"))
    own = _units(_matrix(asked.column("vector").combine_chunks()))
    shared = points.sparkSession.sparkContext.broadcast((names, own))

    def best(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, own = shared.value
        score = np.full((len(names), k), -np.inf)
        held = np.zeros((len(names), k, own.shape[1]))
        for point, vector in batches(frames, ["point", "vector"]):
            units = _units(_matrix(vector))
            new = own @ units.T
            new[names[:, None] == np.asarray(point)[None, :]] = -np.inf
            both = np.concatenate([score, new], 1)
            top = np.argsort(-both, axis=1, kind="stable")[:, :k]
            score = np.take_along_axis(both, top, 1)
            before = np.take_along_axis(held, np.minimum(top, k - 1)[:, :, None], 1)
            held = np.where((top < k)[:, :, None], before, units[np.maximum(top - k, 0)])
        q, n = np.nonzero(score > -np.inf)
        vectors = pa.ListArray.from_arrays(
            pa.array(np.arange(len(q) + 1) * own.shape[1], pa.int32()), pa.array(held[q, n].ravel())
        )
        yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(score[q, n]), vectors], ["number", "score", "vector"])

    found = points.select("point", "vector").mapInArrow(best, "number bigint, score double, vector array<double>")
    order = Window.partitionBy("number").orderBy(F.desc("score"))
    rows = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).toArrow()
    numbers = np.asarray(rows.column("number"))
    matrix = _matrix(rows.column("vector").combine_chunks()) if len(rows) else np.empty((0, own.shape[1]))
    return [matrix[numbers == i] for i in range(len(names))]


def enough_leaves(points: DataFrame, shared, trees: list[Tree], k: int, how: Forest, least: int) -> int:
    """Leaves to visit, `least` or more, that hold a share of `recall` of the nearest points.

    Measured on the asking points whose hashes are lowest. The number visited is doubled until it is enough,
    and is then cut to what the share took; with all leaves every point is found.
    """
    every = all_leaves(trees)
    if least >= every:
        return every
    asked = points.filter("asks").orderBy("digest").limit(how.checked).select("point", "vector").toArrow()
    if not asked.num_rows:
        return least
    own = _units(_matrix(asked.column("vector").combine_chunks()))
    wanted = []
    for near in nearest_by_force(points, asked, k):
        at: dict[tuple[int, int], list[int]] = {}
        for t, tree in enumerate(trees):
            for n, code in enumerate(place(tree, near).tolist()):
                at.setdefault((t, code), []).append(n)
        wanted.append((len(near), at))
    total = sum(n for n, _ in wanted)
    context = points.sparkSession.sparkContext
    sought = context.broadcast((own, wanted))
    queries = points.sparkSession.range(0, len(own), 1, len(own))
    leaves = least
    while True:
        limit = min(leaves, every)

        def seek(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            trees, (own, wanted) = shared.value, sought.value
            for (numbers,) in batches(frames, ["id"]):
                took = []
                for i in numbers.to_pylist():
                    left, at = set(range(wanted[i][0])), wanted[i][1]
                    for k, leaf in enumerate(visits(trees, own[i], limit), 1):
                        new = left.intersection(at.get(leaf, ()))
                        took += [k] * len(new)
                        left -= new
                        if not left:
                            break
                yield pa.RecordBatch.from_arrays([pa.array(took, pa.int64())], ["took"])

        took = sorted(r["took"] for r in queries.mapInArrow(seek, "took bigint").collect())
        need = int(np.ceil(how.recall * total))
        if len(took) >= need or limit == every:
            sought.destroy()
            return max(least, took[need - 1]) if 0 < need <= len(took) else limit
        leaves *= 2


def nearest(
    vectors: DataFrame, queries: Column, id_column: str = "vec_id", vector_column: str = "embedding",
    k: int = 5, how: Forest = Forest(),
) -> DataFrame:
    """The `k` nearest rows of each row for which `queries` holds, by cosine on the original vectors.

    Rows of query_id, rank (from 1), vec_id, score; ties go to the smaller id. Fewer rows come where
    there are fewer candidates. Rows whose id or vector is NULL, whose vector is zero or empty or holds
    NULL or non-finite components take no part. All vectors must have one length. Rows that repeat an
    id with an equal vector are one row. Other columns are ignored, whatever their names. An empty table
    gives no rows.
    """
    spark = vectors.sparkSession
    batch_limits(spark)
    rows = vectors.select(
        F.col(id_column).cast("long").alias("id"),
        F.col(vector_column).alias("vector"),
        F.coalesce(queries, F.lit(False)).alias("asks"),
    ).filter(F.col("id").isNotNull() & _usable(F.col("vector")))
    keyed = step(rows.withColumn("digest", F.md5(F.to_json("vector").cast("binary"))), "neighbours-rows")
    # a point is named by its smallest id
    points = step(
        keyed.groupBy("digest").agg(
            F.min("id").alias("point"), F.first("vector").alias("vector"), F.max("asks").alias("asks")
        ),
        "neighbours-points",
    )
    names = points.select("digest", "point")
    # an answer takes k ids of a point at most, besides the query itself
    first = Window.partitionBy("digest").orderBy("id")
    ids = (
        keyed.select("digest", "id")
        .withColumn("nth", F.dense_rank().over(first)).filter(F.col("nth") <= k + 1)
        .groupBy("digest").agg(F.collect_set("id").alias("ids"))
        .join(names, "digest").select("point", "ids")
    )
    size = points.count()
    trees = fit_forest(points, how, size)
    empty = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    if not trees:
        return empty
    shared = spark.sparkContext.broadcast(trees)
    leaves = enough_leaves(points, shared, trees, k, how, leaves_for(trees, size, how.candidates))

    def rows_at(tree: np.ndarray, leaf: np.ndarray, row: np.ndarray, query: bool, point: pa.Array, vector: pa.Array) -> pa.RecordBatch:
        pick = pa.array(row)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(tree.astype(np.int32)),
                pa.array(leaf),
                pa.array(np.full(len(row), query)),
                point.take(pick),
                vector.take(pick),
            ],
            ["tree", "leaf", "query", "point", "vector"],
        )

    def meet(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = shared.value
        for point, vector, asks in batches(frames, ["point", "vector", "asks"]):
            units = _units(_matrix(vector))
            tree = np.repeat(np.arange(len(trees)), len(point))
            leaf = np.concatenate([place(t, units) for t in trees])
            row = np.tile(np.arange(len(point)), len(trees))
            for a in range(0, len(row), 20_000):
                yield rows_at(tree[a : a + 20_000], leaf[a : a + 20_000], row[a : a + 20_000], False, point, vector)
            asking = ((*v, i) for i in np.flatnonzero(np.asarray(asks.to_pylist(), bool)) for v in visits(trees, units[i], leaves))
            while some := list(islice(asking, 20_000)):
                yield rows_at(*np.array(some, np.int64).T, True, point, vector)

    def score(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for at, held in _by_leaf(frames):
            if not held["query"] or not held["point"]:
                continue
            asked, known = np.array(held["query_vector"]), np.array(held["point_vector"])
            exact = _cosines(asked, known)
            top = np.argsort(-exact, axis=1, kind="stable")[:, : k + 1]
            # points at the last place's score may tie with it
            limit = np.take_along_axis(exact, top[:, -1:], 1)
            q, p = np.nonzero(exact >= limit)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.array(held["query"], np.int64)[q]),
                    pa.array(np.array(held["point"], np.int64)[p]),
                    pa.array(exact[q, p]),
                ],
                ["query", "point", "score"],
            )

    placed = points.mapInArrow(meet, f"tree int, leaf bigint, query boolean, point bigint, vector {dict(vectors.dtypes)[vector_column]}")
    by_leaf = placed.repartition("tree", "leaf").sortWithinPartitions("tree", "leaf", "query")
    found = by_leaf.mapInArrow(score, "query bigint, point bigint, score double").distinct()
    near = Window.partitionBy("query").orderBy(F.desc("score"))
    # a point gives its smallest ids; every point at one of the k + 1 best scores may be needed
    best = step(found.withColumn("place", F.rank().over(near)).filter(F.col("place") <= k + 1).drop("place"), "neighbours-found")
    asked = (
        keyed.filter("asks").select("digest", F.col("id").alias("query_id")).distinct()
        .join(names.withColumnRenamed("point", "query"), "digest")
    )
    answers = (
        asked.join(best, "query").join(ids, "point")
        .select("query_id", "score", F.explode("ids").alias("vec_id"))
        .filter("vec_id <> query_id")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        answers.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of all pairs in double precision, each from its own two vectors alone.

    Vectors are brought to a largest component near 1 by a power of two, which rounds nothing and keeps
    squares from overflowing or vanishing.
    """
    a, b = (v / np.exp2(np.floor(np.log2(np.abs(v).max(1, keepdims=True)))) for v in (a, b))
    x, y = np.sqrt((a * a).sum(1)), np.sqrt((b * b).sum(1))
    return np.stack([(b * row).sum(1) for row in a]) / (x[:, None] * y[None, :])


def _by_leaf(frames: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, dict[str, list]]]:
    """Points and queries of each leaf, from rows sorted by leaf."""
    at, held = None, None
    for tree, leaf, query, point, vector in batches(frames, ["tree", "leaf", "query", "point", "vector"]):
        matrix = _matrix(vector)
        rows = zip(tree.to_pylist(), leaf.to_pylist(), query.to_pylist(), point.to_pylist(), matrix)
        for t, code, asks, name, numbers in rows:
            if (t, code) != at:
                if held:
                    yield at, held
                at, held = (t, code), {"query": [], "query_vector": [], "point": [], "point_vector": []}
            side = "query" if asks else "point"
            held[side].append(name)
            held[f"{side}_vector"].append(numbers)
    if held:
        yield at, held
