"""Classification trees grown on counts, and cost-complexity pruning.

All trees of a search grow at once. Trees that learn from the same rows and have made the same splits so far share them: their rows stand
once, with the part they have come to, until a smallest side makes one of them split otherwise. Splits are exact: every value is a
candidate, as many as there are. Large nodes are split level by level. A level counts (part, feature, bin) over bins of about equal size;
between two bins the gain is known, within a bin it is bounded, and only bins that may hold the best split are counted by value. A node of
few rows meets in one task, which splits it to its end, so neither levels nor shuffles grow with the depth of the tree. What is gathered
is one row for each node that is split.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written
from .quantiles import running_totals

# A node of up to SMALL rows is split to its end in one task; bins of a feature.
SMALL = 100_000
BINS = 256

_SPLIT = "tree int, node bigint, feature int, cut double, gain double, n bigint, positive bigint, n_upto bigint, positive_upto bigint"


@dataclass(frozen=True)
class Growth:
    """Rows of `held_out` (a fold) are not learned from; None learns from all. A node of fewer than `min_split` rows is
    not split, and no side of a split has fewer than `min_bucket`."""

    held_out: int | None
    min_split: int
    min_bucket: int


@dataclass
class Node:
    n: int
    positive: int
    feature: int | None = None
    cut: float | None = None
    gain: float = 0.0

    def errors(self) -> int:
        return min(self.positive, self.n - self.positive)


class Tree:
    """Nodes by number: the children of node i are 2i (up to the cut) and 2i + 1.

    They are kept as arrays in the order of their numbers, so children lie side by side; `feature` is -1 and `left` (the place of the first
    child) 0 where a node is not split.
    """

    def __init__(self, nodes: dict[int, Node] | None = None):
        kept = sorted((nodes or {}).items())
        self._fill(
            [i for i, _ in kept],
            [x.n for _, x in kept],
            [x.positive for _, x in kept],
            [-1 if x.feature is None else x.feature for _, x in kept],
            [0.0 if x.cut is None else x.cut for _, x in kept],
            [x.gain for _, x in kept],
        )

    def _fill(self, number, n, positive, feature, cut, gain) -> None:
        self.number, self.n, self.positive = (np.asarray(c, np.int64) for c in (number, n, positive))
        self.feature = np.asarray(feature, np.int32)
        self.cut, self.gain = np.asarray(cut, float), np.asarray(gain, float)
        split = self.feature >= 0
        self.left = np.where(split, np.searchsorted(self.number, 2 * self.number), 0)
        self.errors = np.minimum(self.positive, self.n - self.positive)
        depth = np.frexp(self.number.astype(float))[1]
        self.levels = [np.flatnonzero(depth == d) for d in range(1, int(depth.max(initial=0)) + 1)]

    @staticmethod
    def of(n: int, positive: int, splits: dict[str, np.ndarray]) -> Tree:
        """The tree of a root and its splits, in any order."""
        tree, at = Tree(), splits["node"]
        number = np.r_[1, 2 * at, 2 * at + 1]
        order = np.argsort(number)
        counts = [
            np.r_[whole, splits[f"{c}_upto"], splits[c] - splits[f"{c}_upto"]][order] for c, whole in (("n", n), ("positive", positive))
        ]
        number = number[order]
        place = np.searchsorted(number, at)
        columns = [np.full(len(number), -1, np.int32), np.zeros(len(number)), np.zeros(len(number))]
        for column, c in zip(columns, ("feature", "cut", "gain")):
            column[place] = splits[c]
        tree._fill(number, *counts, *columns)
        return tree

    def _node(self, k: int) -> Node:
        counts = int(self.n[k]), int(self.positive[k])
        return Node(*counts) if self.feature[k] < 0 else Node(*counts, int(self.feature[k]), float(self.cut[k]), float(self.gain[k]))

    @property
    def nodes(self) -> dict[int, Node]:
        return {i: self._node(k) for k, i in enumerate(self.number.tolist())}

    def ends(self, complexity: float) -> np.ndarray:
        """For each place that of the leaf at or above it in the smallest subtree of least errors + complexity * errors of the root *
        leaves; -1 above the leaves."""
        alone = self.errors + (complexity * self.errors[0] if len(self.number) else 0.0)
        cost, ending = alone.copy(), self.feature < 0
        for level in reversed(self.levels):
            split = level[self.feature[level] >= 0]
            below = cost[self.left[split]] + cost[self.left[split] + 1]
            ending[split] = alone[split] <= below + 1e-9
            cost[split] = np.minimum(alone[split], below)
        ends = np.where(ending, np.arange(len(ending)), -1)
        for level in self.levels:
            split = level[self.feature[level] >= 0]
            split = split[ends[split] >= 0]
            for child in (self.left[split], self.left[split] + 1):
                ends[child] = ends[split]
        return ends

    def pruned(self, complexity: float) -> dict[int, int]:
        """Each leaf's node in the pruned tree."""
        leaf = self.feature < 0
        return dict(zip(self.number[leaf].tolist(), self.number[self.ends(complexity)[leaf]].tolist()))

    def splits(self, complexity: float) -> list[Node]:
        """The split nodes that pruning leaves."""
        return [self._node(k) for k in np.flatnonzero(self.ends(complexity) < 0)]

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """Places of the leaves that the rows of a matrix come to."""
        place = np.zeros(len(x), np.int64)
        at = np.flatnonzero(self.feature[place] >= 0)
        while len(at):
            here = place[at]
            place[at] = self.left[here] + (x[at, self.feature[here]] > self.cut[here])
            at = at[self.feature[place[at]] >= 0]
        return place


@dataclass(frozen=True)
class _Part:
    """The rows of a node that some trees, all with the same splits above it, have in common."""

    node: int
    n: int
    positive: int
    trees: tuple[int, ...]

    def still_split(self, growths: list[Growth], max_depth: int) -> _Part:
        """The same rows for the trees that may split them."""
        if self.node >= 2**max_depth or not 0 < self.positive < self.n:
            return _Part(self.node, self.n, self.positive, ())
        kept = tuple(k for k in self.trees if self.n >= max(growths[k].min_split, 2))
        return _Part(self.node, self.n, self.positive, kept)

    def sides(self, trees: list[int], n_upto: int, positive_upto: int) -> tuple[_Part, _Part]:
        return (
            _Part(2 * self.node, n_upto, positive_upto, tuple(trees)),
            _Part(2 * self.node + 1, self.n - n_upto, self.positive - positive_upto, tuple(trees)),
        )


def _purity(positive: Column, n: Column) -> Column:
    """Falls as the Gini impurity of n rows rises; 0 without rows."""
    return (positive * positive + (n - positive) * (n - positive)) / F.greatest(n, F.lit(1))


def _gain(left_positive: Column, left: Column, positive: Column, n: Column) -> Column:
    return _purity(left_positive, left) + _purity(positive - left_positive, n - left) - _purity(positive, n)


def grow(
    rows: DataFrame, trees: list[Growth], max_depth: int = 30, small: int = SMALL, bins: int = BINS
) -> tuple[list[Tree], DataFrame]:
    """The trees, and rows of tree, node, n, positive: counts of the held-out rows by the leaf they come to.

    `rows`: fold, label (0 or 1), x (array of doubles); they are read several times. The best split has the largest Gini gain; ties go
    to the first feature, then to the smallest value. A cut lies halfway to the next value. How many rows are `small`, and how many
    `bins` there are, never changes a tree.
    """
    spark = rows.sparkSession
    folds = rows.groupBy("fold").agg(
        F.count(F.lit(1)).alias("n"), F.sum("label").alias("positive"), F.max(F.size("x")).alias("width")
    )
    folds = [r for r in folds.collect() if r["fold"] is not None]
    roots, parts, held_by = {}, {}, []
    for held in sorted({_held(t) for t in trees}):
        learned = [r for r in folds if r["fold"] != held]
        if learned:
            ks = tuple(k for k, t in enumerate(trees) if _held(t) == held)
            root = _Part(1, sum(r["n"] for r in learned), sum(r["positive"] for r in learned), ks)
            roots |= {k: root for k in ks}
            held_by.append((len(held_by), held))
            parts[len(parts)] = root.still_split(trees, max_depth)
    if any(part.n > small for part in parts.values()):
        source = _with_bins(rows, max(r["width"] for r in folds), bins)
    else:
        source = rows.withColumn("bins", F.lit(None).cast("array<int>"))
    learns = F.inline(F.array(*[F.struct(F.lit(p).alias("part"), F.lit(h).alias("_held")) for p, h in held_by or [(0, 0)]]))
    here = source.select("fold", "label", "x", "bins", learns).filter("fold != _held").select("part", "label", "x", "bins")
    splits, aside, few, number = [], [], {}, len(parts)
    while True:
        parts = {p: part for p, part in parts.items() if part.trees}
        now = {p: part for p, part in parts.items() if part.n <= small}
        if now:
            # their rows stay where they lie until all are split
            few |= now
            asked = spark.createDataFrame([(p,) for p in sorted(now)], "part int")
            aside.append(here.join(F.broadcast(asked), "part", "left_semi").select("part", "label", "x"))
        many = {p: part for p, part in parts.items() if p not in now}
        if not many:
            break
        # trees that find the same split go on together
        alike: dict[tuple, list[int]] = {}
        asked = sorted({(p, trees[k].min_bucket) for p, part in many.items() for k in part.trees})
        for p, bucket, *split in _best_splits(here, asked):
            alike.setdefault((p, *split), []).extend(k for k in many[p].trees if trees[k].min_bucket == bucket)
        moves, parts = [], {}
        for (p, feature, cut, gain, *upto), ks in alike.items():
            splits += [(k, many[p].node, feature, cut, gain, many[p].n, many[p].positive, *upto) for k in ks]
            places = []
            for side in many[p].sides(ks, *upto):
                side = side.still_split(trees, max_depth)
                places.append(number if side.trees else None)
                parts[number] = side
                number += 1
            moves.append((p, feature, cut, *places))
        if not any(part.trees for part in parts.values()):
            break
        moves = spark.createDataFrame(moves, "part int, feature int, cut double, low int, high int")
        side = F.when(F.get("x", "feature") > F.col("cut"), F.col("high")).otherwise(F.col("low"))
        moved = here.join(F.broadcast(moves), "part").select(side.alias("part"), "label", "x", "bins")
        here = written(moved.filter("part IS NOT NULL"), "tree-rows")
    found = pa.Table.from_pylist([], _kinds()) if not splits else _table(splits)
    if aside:
        few_rows = aside[0]
        for rest in aside[1:]:
            few_rows = few_rows.unionByName(rest)
        # parts are small in bytes, not in work, so adaptive execution must not put many into one task
        tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
        ended = few_rows.repartition(tasks, "part").groupBy("part").applyInArrow(_splitter(trees, few, max_depth), _SPLIT).toArrow()
        found = pa.concat_tables([found, ended.cast(_kinds())])
    grown = _trees(roots, len(trees), found)
    return grown, _leaf_counts(rows, trees, grown)


def _held(growth: Growth) -> int:
    return -1 if growth.held_out is None else growth.held_out


def _kinds() -> pa.Schema:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "double": pa.float64()}
    return pa.schema([(name, kinds[kind]) for name, kind in (part.split() for part in _SPLIT.split(", "))])


def _table(splits: list[tuple]) -> pa.Table:
    columns = list(zip(*splits)) or [()] * len(_kinds())
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, _kinds().types)], schema=_kinds())


def _trees(roots: dict[int, _Part], count: int, found: pa.Table) -> list[Tree]:
    columns = {c: found[c].to_numpy() for c in found.column_names}
    order = np.argsort(columns["tree"], kind="stable")
    edges = np.searchsorted(columns["tree"][order], np.arange(count + 1))
    return [
        Tree.of(roots[k].n, roots[k].positive, {c: v[order[edges[k] : edges[k + 1]]] for c, v in columns.items()})
        if k in roots
        else Tree()
        for k in range(count)
    ]


def _matrix(x: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Arrays of one length as the rows of a matrix; there is at least one."""
    if isinstance(x, pa.ChunkedArray):
        x = x.combine_chunks()
    return x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)


def _with_bins(rows: DataFrame, width: int, bins: int) -> DataFrame:
    """Rows with the bin of each value, a number that never falls when the value rises."""
    shares = [i / bins for i in range(1, bins)]
    quantiles = [F.percentile_approx(F.get("x", F.lit(i)), shares, 10 * bins).alias(f"q{i}") for i in range(width)]
    edges = [np.unique(np.array(q, dtype=float)) for q in rows.agg(*quantiles).first()]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in filter(len, batches):
            x = _matrix(batch["x"])
            found = np.stack([np.searchsorted(e, x[:, i]) for i, e in enumerate(edges)], axis=1).astype(np.int32)
            offsets = np.arange(len(x) + 1, dtype=np.int32) * width
            placed = pa.ListArray.from_arrays(pa.array(offsets), pa.array(found.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, placed], names=[*batch.schema.names, "bins"])

    kinds = dict(rows.dtypes)
    binned = rows.select("fold", "label", "x").mapInArrow(
        place, f"fold {kinds['fold']}, label {kinds['label']}, x array<double>, bins array<int>"
    )
    return written(binned, "tree-rows")


def _best_splits(rows: DataFrame, asked: list[tuple[int, int]]) -> list[tuple]:
    """The best split (part, bucket, feature, cut, gain, n_upto, positive_upto) for each (part, smallest side) that has one."""
    spark = rows.sparkSession
    parts = spark.createDataFrame([(p,) for p in sorted({p for p, _ in asked})], "part int")
    asked = spark.createDataFrame(asked, "part int, bucket int")
    cells = (
        rows.join(F.broadcast(parts), "part", "left_semi")
        .select("part", "label", "x", F.posexplode("bins").alias("feature", "bin"))
        .select("part", "label", "feature", "bin", F.get("x", "feature").alias("value"))
    )
    totals = [F.count(F.lit(1)).alias("n"), F.sum(F.col("label").cast("long")).alias("positive")]
    node, group = ["part", "bucket"], ["part", "feature"]
    counts = cells.groupBy(*group, "bin").agg(*totals, F.min("value").alias("least"), F.max("value").alias("most"))
    # a window holds the bins of one feature
    whole = Window.partitionBy(*group)
    in_order = whole.orderBy("bin")
    upto = in_order.rowsBetween(Window.unboundedPreceding, 0)
    placed = counts.select(
        *counts.columns,
        *[F.sum(t).over(upto).alias(f"{t}_upto") for t in ("n", "positive")],
        *[F.sum(t).over(whole).alias(f"{t}_all") for t in ("n", "positive")],
        F.lead("least").over(in_order).alias("next"),
    )
    placed = written(placed, "tree-bins").join(F.broadcast(asked), "part")
    bucket = F.col("bucket")

    def splits(at: DataFrame) -> DataFrame:
        left, left_positive, n, positive = (F.col(c) for c in ("n_upto", "positive_upto", "n_all", "positive_all"))
        return (
            at.filter(F.col("next").isNotNull() & (left >= bucket) & (n - left >= bucket))
            # rounded, so that equal splits tie
            .withColumn("gain", F.round(_gain(left_positive, left, positive, n), 9))
            .filter("gain > 0")
            .withColumn("cut", (F.col("value") + F.col("next")) / 2)
            .select(*group, "bucket", "value", "cut", "gain", "n_upto", "positive_upto")
        )

    between = splits(placed.withColumn("value", F.col("most")))
    known = between.groupBy(*node).agg(F.max("gain").alias("_known"))
    n, positive, before = F.col("n_all"), F.col("positive_all"), F.col("n_upto") - F.col("n")
    # the gain is convex in the two counts on the left, so within a bin it is at most that of a corner
    positive_before, ones = F.col("positive_upto") - F.col("positive"), F.col("positive")
    zeros = F.col("n") - ones
    corners = [
        _gain(positive_before + p, before + p + q, positive, n)
        for p in (F.lit(0), ones)
        for q in (F.lit(0), zeros)
    ]
    # what the sums of doubles may lose
    most = F.greatest(*corners) + 1e-6 + n * 1e-12
    hopeful = (
        placed.filter((F.col("least") < F.col("most")) & (F.col("n_upto") > bucket) & (n - before > bucket))
        .withColumn("_most", most)
        .join(F.broadcast(known), node, "left")
        .filter(F.col("_known").isNull() | (F.col("_most") >= F.col("_known")))
        .select(*group, "bin", "bucket", "n_all", "positive_all", before.alias("_before"), positive_before.alias("_positive_before"))
    )
    # written for its true size, by which it is sent to all tasks or not
    hopeful = written(hopeful, "tree-bins")
    keys = [*group, "bin"]
    values = cells.join(hopeful.select(*keys).distinct(), keys, "left_semi").groupBy(*keys, "value").agg(*totals)
    inside = running_totals(values, keys, "value", ["n", "positive"], following="next").drop("n_all", "positive_all")
    inside = inside.join(hopeful, keys).withColumns(
        {"n_upto": F.col("n_upto") + F.col("_before"), "positive_upto": F.col("positive_upto") + F.col("_positive_before")}
    )
    best = (
        between.unionByName(splits(inside))
        .groupBy(*node)
        .agg(
            F.min_by(
                F.struct("feature", "cut", "gain", "n_upto", "positive_upto"), F.struct(-F.col("gain"), "feature", "value")
            ).alias("b")
        )
        .select(*node, "b.*")
    )
    return [tuple(r) for r in best.collect()]


def _splitter(trees: list[Growth], parts: dict[int, _Part], max_depth: int):
    """A function that splits the rows of a small part to their end, for all its trees."""

    def purity(positive: np.ndarray, n: np.ndarray) -> np.ndarray:
        return (positive * positive + (n - positive) * (n - positive)) / n

    def best(x: np.ndarray, y: np.ndarray, buckets: list[int]) -> dict[int, tuple]:
        """The best split for each smallest side, in rising order, that has one."""
        n, positive = len(y), int(y.sum())
        order = np.argsort(x, axis=0, kind="stable")
        value = np.take_along_axis(x, order, axis=0)
        left = np.arange(1, n, dtype=np.int64)[:, None]
        left_positive = np.cumsum(y[order], axis=0)[:-1]
        gain = np.round(purity(left_positive, left) + purity(positive - left_positive, n - left) - purity(positive, n), 9)
        gain[value[1:] <= value[:-1]] = 0.0
        out, row = {}, -1
        for bucket in buckets:
            # the best of all is the best of fewer, too, if it is among them
            if not out or not bucket <= row + 1 <= n - bucket:
                gain[: max(bucket - 1, 0)] = gain[max(n - bucket, 0) :] = 0.0
                # by feature, then by value: the first of the largest
                feature, row = divmod(int(np.argmax(gain.T)), n - 1)
                if not gain[row, feature] > 0:
                    break
                cut = (value[row, feature] + value[row + 1, feature]) / 2
            out[bucket] = feature, float(cut), float(gain[row, feature]), row + 1, int(left_positive[row, feature])
        return out

    def split(table: pa.Table) -> pa.Table:
        found = []
        waiting = [(parts[table["part"][0].as_py()], _matrix(table["x"]), table["label"].to_numpy().astype(np.int64))]
        while waiting:
            part, x, y = waiting.pop()
            alike: dict[tuple, list[int]] = {}
            at = best(x, y, sorted({trees[k].min_bucket for k in part.trees}))
            for k in part.trees:
                if trees[k].min_bucket in at:
                    alike.setdefault(at[trees[k].min_bucket], []).append(k)
            for (feature, cut, gain, *upto), ks in alike.items():
                found += [(k, part.node, feature, cut, gain, part.n, part.positive, *upto) for k in ks]
                over = x[:, feature] > cut
                for side, some in zip(part.sides(ks, *upto), (~over, over)):
                    side = side.still_split(trees, max_depth)
                    if side.trees:
                        waiting.append((side, x[some], y[some]))
        return _table(found)

    return split


def _leaf_counts(rows: DataFrame, trees: list[Growth], grown: list[Tree]) -> DataFrame:
    """Held-out rows by tree and leaf; a row finds its leaf on its way down from the root."""
    spark = rows.sparkSession
    judged = {k: t.held_out for k, t in enumerate(trees) if t.held_out is not None}
    if not judged:
        return spark.createDataFrame([], "tree int, node bigint, n bigint, positive bigint")
    shared = spark.sparkContext.broadcast({k: grown[k] if len(grown[k].number) else Tree({1: Node(0, 0)}) for k in judged})

    def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = {k: np.zeros((2, len(tree.number)), np.int64) for k, tree in shared.value.items()}
        for batch in filter(len, batches):
            x, fold = _matrix(batch["x"]), batch["fold"].to_numpy()
            label = batch["label"].to_numpy().astype(bool)
            for held in np.unique(fold).tolist():
                mine = fold == held
                for k in (k for k, h in judged.items() if h == held):
                    place = shared.value[k].leaves(x[mine])
                    for total, some in zip(counts[k], (place, place[label[mine]])):
                        total += np.bincount(some, minlength=len(total))
        for k, (n, positive) in counts.items():
            at = np.flatnonzero(n)
            columns = [np.full(len(at), k, np.int32), shared.value[k].number[at], n[at], positive[at]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["tree", "node", "n", "positive"])

    met = rows.filter(F.col("fold").isin(sorted(set(judged.values())))).select("fold", "label", "x")
    return written(
        met.mapInArrow(descend, "tree int, node bigint, n bigint, positive bigint")
        .groupBy("tree", "node")
        .agg(F.sum("n").alias("n"), F.sum("positive").alias("positive")),
        "leaf-counts",
    )
