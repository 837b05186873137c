"""Centroid clustering with Ptolemaic pivots.

Vectors are made of integers, so distances, means and ties are exact. A few fixed pivots are taken from
the vectors, and every vector's distances to them are computed once and kept beside it. For two pivots p
and s, Ptolemy's inequality bounds the distance of a vector x from a centroid c from below:

    d(x, c) * d(p, s) >= |d(x, p) * d(c, s) - d(x, s) * d(c, p)|

In each round a vector first meets the centroid of the smallest bound; then only those whose bound, rounded
down by more than the error of its terms, does not pass the exact distance found. Survivors are compared
exactly in whole numbers.

A round is one pass over the written vectors. Tasks send sums for each centroid and component, so what is
shuffled and what reaches the driver depends on the number of centroids alone, and a hot cluster is no
more work than others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from fractions import Fraction
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batch_limits, batches, step

# squared distances of vectors whose components stay below fit in 62 bits up to 256 components
_SMALL = 1 << 26
# relative error allowed for a product of two rounded roots, many times what it can be
_ERROR = 2.0**-46
_LIMB = 1 << 32


@dataclass(frozen=True)
class Pivots:
    """`count` pivots, far from each other, among `sample` vectors."""

    count: int = 6
    sample: int = 512


def _whole(vectors: pa.ListArray, size: int, wide: bool, scale: int) -> np.ndarray:
    """floor(scale * x) of all components, in rows: 64-bit numbers, or Python's where they may be too large."""
    x = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)
    if not wide:
        return np.floor(x * scale).astype(np.int64)
    return np.array([[Fraction(v) * scale // 1 for v in row] for row in x.tolist()], object).reshape(-1, size)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows."""
    return ((a - b) ** 2).sum(axis=1)


def roots(squares: np.ndarray) -> np.ndarray:
    return np.sqrt(squares.astype(np.float64))


class Bounds:
    """Lower bounds of the squared distances from vectors to centroids, by pairs of pivots."""

    def __init__(self, pivots: np.ndarray):
        between = [[float(roots(squared(p[None], s[None]))[0]) for s in pivots] for p in pivots]
        self.pairs = [(i, j, between[i][j]) for i, j in combinations(range(len(pivots)), 2) if between[i][j] > 0]

    def __call__(self, near: np.ndarray, far: np.ndarray) -> np.ndarray:
        """`near`: distances of vectors to the pivots, `far`: of centroids; rounded down."""
        best = np.zeros((len(near), len(far)))
        for i, j, apart in self.pairs:
            left, right = np.outer(near[:, i], far[:, j]), np.outer(near[:, j], far[:, i])
            np.maximum(best, (np.abs(left - right) - (left + right) * _ERROR) / apart, out=best)
        return best**2 * (1 - _ERROR)


def assign(
    x: np.ndarray, near: np.ndarray, centroids: np.ndarray, far: np.ndarray, bounds: Bounds
) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid of each vector (ties: the first), its exact squared distance, and the number of exact
    distances taken."""
    rows = np.arange(len(x))
    if x.dtype == object:
        least = np.zeros((len(x), len(centroids)))
    else:
        least = bounds(near, far)
    own = least.argmin(axis=1)
    best, taken = squared(x, centroids[own]), len(x)
    for k in range(len(centroids)):
        # a bound equal to the best may be a tie
        some = rows if x.dtype == object else np.flatnonzero((least[:, k] <= best * (1 + _ERROR)) & (own != k))
        found = squared(x[some], centroids[k])
        better = (found < best[some]) | ((found == best[some]) & (k < own[some]))
        own[some[better]], best[some[better]] = k, found[better]
        taken += len(some)
    return own, best, taken


def _spread(sample: np.ndarray, count: int) -> np.ndarray:
    """Vectors far from each other: each is the farthest from those before it."""
    chosen = [0]
    least = squared(sample, sample[0])
    while len(chosen) < count and least.max() > 0:
        chosen.append(int(least.argmax()))
        least = np.minimum(least, squared(sample, sample[chosen[-1]]))
    return sample[chosen]


def _limbs(total: int) -> list[tuple[int, int]]:
    """A whole number of any size as parts that can be summed by place."""
    sign, total, out = (1 if total >= 0 else -1), abs(total), []
    while total:
        total, part = divmod(total, _LIMB)
        out.append((len(out), sign * part))
    return out


def cluster(
    table: DataFrame,
    k: int,
    rounds: int,
    order: Column,
    size: int = 64,
    scale: int = 1024,
    how: Pivots = Pivots(),
) -> DataFrame:
    """Clusters of the vectors: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Columns vec_id and embedding are read; others are ignored, whatever their names. Vectors with exactly
    `size` components, none NULL or non-finite, take part as floor(scale * x); other rows are left out. One row for each of
    them; rows that repeat count each. The `k` first by `order` (a column of text over vec_id; NULL last,
    ties by the vector) are the centroids at first; with fewer rows there are fewer. Each of `rounds` rounds
    moves every centroid that has vectors to their mean, rounded down. Ties go to the smaller number.
    Vectors without vec_id take part. An empty table gives no rows. Numbers beyond a long are NULL; tables with
    components that large are compared without bounds.
    """
    spark = table.sparkSession
    batch_limits(spark)
    x = F.col("embedding")
    is_number = lambda c: F.coalesce(F.abs(c.cast("double")) < float("inf"), F.lit(False)) & ~F.isnan(c.cast("double"))
    fit = table.filter((F.size(x) == size) & F.forall(x, is_number)).select(
        F.col("vec_id"), F.transform(x, lambda c: c.cast("double")).alias("vector"), order.alias("_order")
    )
    first = (
        fit.groupBy()
        .agg(F.max(F.array_max(F.transform("vector", F.abs))).alias("top"), F.count(F.lit(1)).alias("n"))
        .first()
    )
    wide = (first["top"] or 0.0) * scale >= _SMALL - 1 or size > 256
    lead = fit.orderBy(F.asc_nulls_last("_order"), "vector").limit(max(k, how.sample)).select("vector").toArrow()
    if not len(lead):
        none = "vec_id {}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        return spark.createDataFrame([], none.format(dict(table.dtypes)["vec_id"]))
    sample = _whole(lead.column("vector").combine_chunks(), size, wide, scale)
    centroids = sample[:k]
    pivots = _spread(sample[: how.sample], how.count)
    bounds = Bounds(pivots) if not wide else None
    id_type = table.schema["vec_id"].dataType.simpleString()

    def keep(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, vectors in batches(frames, ["vec_id", "vector"]):
            rows = _whole(vectors, size, False, scale)
            near = np.column_stack([roots(squared(rows, p)) for p in pivots])
            yield pa.RecordBatch.from_arrays(
                [ids, _lists(rows.astype(np.int32)), _lists(near)], ["vec_id", "vector", "near"]
            )

    if wide:
        points = step(fit.select("vec_id", "vector", F.array().cast("array<double>").alias("near")), "points")
    else:
        points = step(fit.mapInArrow(keep, f"vec_id {id_type}, vector array<int>, near array<double>"), "points")

    def nearest_of(centroids: np.ndarray) -> Callable[..., tuple[np.ndarray, np.ndarray, np.ndarray]]:
        far = None if wide else np.column_stack([roots(squared(centroids, p)) for p in pivots])

        def find(vectors: pa.ListArray, near: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            if wide:
                rows, cached = _whole(vectors, size, True, scale), None
            else:
                rows = vectors.flatten().to_numpy().astype(np.int64).reshape(-1, size)
                cached = near.flatten().to_numpy().reshape(len(rows), -1)
            return rows, *assign(rows, cached, centroids, far, bounds)[:2]

        return find

    def totals(centroids: np.ndarray) -> dict[int, tuple[int, list[int]]]:
        """Number and sums of the vectors of each centroid that has some."""
        find = nearest_of(centroids)

        def partial(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[int, list[int]] = {}
            for vectors, near in batches(frames, ["vector", "near"]):
                rows, own, _ = find(vectors, near)
                for c in np.unique(own).tolist():
                    mine = rows[own == c]
                    got = [len(mine), *map(int, mine.sum(axis=0))]
                    sums[c] = [a + b for a, b in zip(sums[c], got)] if c in sums else got
            parts = [
                (c, place, limb, part)
                for c, values in sums.items()
                for place, value in enumerate(values)
                for limb, part in _limbs(value)
            ]
            columns = zip(*parts) if parts else ([], [], [], [])
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(columns, (pa.int32(), pa.int32(), pa.int32(), pa.int64()))],
                ["cluster", "place", "limb", "part"],
            )

        summed = (
            points.select("vector", "near")
            .mapInArrow(partial, "cluster int, place int, limb int, part bigint")
            .groupBy("cluster", "place", "limb")
            .agg(F.sum("part").alias("part"))
            .collect()
        )
        out: dict[int, list[int]] = {}
        for r in summed:
            values = out.setdefault(r["cluster"], [0] * (size + 1))
            values[r["place"]] += r["part"] * _LIMB ** r["limb"]
        return {c: (values[0], values[1:]) for c, values in out.items()}

    for _ in range(rounds):
        centroids = centroids.copy()
        for c, (count, sums) in totals(centroids).items():
            centroids[c] = [value // count for value in sums]

    find = nearest_of(centroids)

    def label(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, vectors, near in batches(frames, ["vec_id", "vector", "near"]):
            _, own, far = find(vectors, near)
            far = pa.array([v if v < 1 << 63 else None for v in far.tolist()], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(own.astype(np.int32)), far], ["vec_id", "cluster", "distance"]
            )

    labels = step(points.mapInArrow(label, f"vec_id {id_type}, cluster int, distance bigint"), "clusters")
    unknown = F.count(F.lit(1)) > F.count("distance")
    by_cluster = (
        labels.groupBy("cluster")
        .agg(F.when(~unknown, F.sum(F.col("distance").cast("decimal(38,0)"))).alias("total"))
        .collect()
    )
    sums = {r["cluster"]: r["total"] for r in by_cluster}
    fits = lambda v: int(v) if v is not None and v < 1 << 63 else None
    inertia = fits(None if None in sums.values() else sum(sums.values()))
    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    known = spark.createDataFrame(
        [(c, fits(total), inertia, digests[c]) for c, total in sums.items()],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    # at most k rows
    return labels.join(F.broadcast(known), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def _lists(rows: np.ndarray) -> pa.ListArray:
    ends = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(rows.ravel()))
