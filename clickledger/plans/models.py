"""Cancellation models: logistic regression and pruned trees, judged on held-out folds."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.chunked import running_count
from ..operators.quantiles import running_totals
from ..operators.trees import Growth, grow
from ..session import written

# Folds, and the ranges the tree is tuned over.
LOGISTIC_FOLDS = 5
TREE_FOLDS = 3
MIN_SPLITS = (40, 120)
MIN_BUCKETS = (5, 40)
COMPLEXITIES = (0.0001, 0.1)


def with_folds(df: DataFrame, folds: int, label: str = "label", row_id: str = "opportunity_id") -> DataFrame:
    """Stratified folds: rows of each label are dealt out in the order of a digest of their id.

    There are only two labels, so positions come from a chunked count rather than one window each.
    """
    hashed = df.withColumn("_hash", F.md5(F.col(row_id).cast("string").cast("binary"))).withColumn(
        "_chunk", F.substring("_hash", 1, 4)
    )
    placed = running_count(hashed, [label], ["_hash", row_id], ["_chunk"], "_position")
    return placed.withColumn("fold", ((F.col("_position") - 1) % folds).cast("int")).drop(
        "_hash", "_chunk", "_position"
    )


def evaluate(counts: DataFrame, group: list[str]) -> DataFrame:
    """Rows, positives, AUC and accuracy of scores: `group`, score, n and positive of each score.

    The area is the share of pairs of a positive and another row that the scores put in order, ties half; ranks are running
    totals over the distinct scores. NULL where a group has one label only.
    """
    counts = counts.groupBy(*group, "score").agg(F.sum("n").alias("n"), F.sum("positive").alias("positive"))
    placed = running_totals(
        counts.withColumn("other", F.col("n") - F.col("positive")), group, "score", ["other"]
    )
    below = F.col("other_upto") - F.col("other") / 2
    right = F.when(F.col("score") > 0.5, F.col("positive")).otherwise(F.col("n") - F.col("positive"))
    rows, positives = F.sum("n"), F.sum("positive")
    return placed.groupBy(*group).agg(
        rows.alias("rows"),
        positives.alias("positives"),
        F.try_divide(F.sum(F.col("positive") * below), (positives * (rows - positives)).cast("double")).alias("auc"),
        (F.sum(right) / rows).alias("acc"),
    )


# --- logistic regression ------------------------------------------------------------------------


@dataclass(frozen=True)
class Fit:
    """Coefficients, the intercept first, and their standard errors."""

    coefficients: list[float]
    errors: list[float]
    rounds: int


def fit_logistic(
    rows: DataFrame, columns: list[str], held_out: list[int | None], most_rounds: int = 25, tolerance: float = 1e-10
) -> list[Fit]:
    """Maximum likelihood by reweighted least squares, for several sets of rows at once: all but a fold each, or all (None).

    `rows`: label, the columns and, if folds are held out, fold; none NULL. A round sums the normal equations on the executors, one
    row for each model; the small system is solved here. A model stops when no coefficient moves by more than the tolerance.
    Columns that tell nothing new share their coefficient evenly, constant ones get 0.
    """
    terms = len(columns) + 1
    # one row for each model that learns from it
    learns = F.array(*[F.lit(-1 if f is None else f) for f in held_out])
    fold = F.col("fold") if "fold" in rows.columns else F.lit(-2)
    x = [F.lit(1.0), *[F.col(c).cast("double") for c in columns]]
    spread = rows.select(F.col("label").cast("double").alias("y"), F.array(*x).alias("x"), fold.alias("fold"))
    spread = spread.select("y", "x", "fold", F.posexplode(learns).alias("model", "held")).filter("fold <> held")
    b = [np.zeros(terms) for _ in held_out]
    done: dict[int, Fit] = {}
    for number in range(1, most_rounds + 1):
        known = F.array(*[F.array(*[F.lit(float(v)) for v in beta]) for beta in b])
        score = F.aggregate(
            F.zip_with("x", F.get(known, F.col("model")), lambda u, v: u * v), F.lit(0.0), lambda s, v: s + v
        )
        weighed = (
            spread.withColumn("p", 1 / (1 + F.exp(-score)))
            .withColumn("w", F.col("p") * (1 - F.col("p")))
            .select("model", "w", (F.col("y") - F.col("p")).alias("r"), *[F.get("x", F.lit(i)).alias(f"x{i}") for i in range(terms)])
        )
        pairs = [(i, j) for i in range(terms) for j in range(i, terms)]
        sums = weighed.groupBy("model").agg(
            *[F.sum(F.col("w") * F.col(f"x{i}") * F.col(f"x{j}")).alias(f"h{i}_{j}") for i, j in pairs],
            *[F.sum(F.col("r") * F.col(f"x{i}")).alias(f"g{i}") for i in range(terms)],
        )
        for row in sums.collect():
            k = row["model"]
            if k in done:
                continue
            gram = np.zeros((terms, terms))
            for i, j in pairs:
                gram[i, j] = gram[j, i] = row[f"h{i}_{j}"]
            inverse = np.linalg.pinv(gram, rcond=1e-12, hermitian=True)
            move = inverse @ np.array([row[f"g{i}"] for i in range(terms)])
            b[k] = b[k] + move
            if np.abs(move).max() <= tolerance * (1 + np.abs(b[k]).max()) or number == most_rounds:
                errors = np.sqrt(np.maximum(np.diag(inverse), 0.0))
                done[k] = Fit(b[k].tolist(), errors.tolist(), number)
        if len(done) == len(held_out):
            break
    none = Fit([0.0] * terms, [0.0] * terms, 0)
    return [done.get(k, none) for k in range(len(held_out))]


def logistic_cv(table: DataFrame, columns: list[str], folds: int = LOGISTIC_FOLDS) -> DataFrame:
    """Rows, positives, AUC and accuracy of each fold, scored by the model of the others."""
    rows = written(with_folds(table.select("opportunity_id", "label", *columns), folds), "folds")
    fits = fit_logistic(rows, columns, list(range(folds)))
    known = F.array(*[F.array(*[F.lit(v) for v in fit.coefficients]) for fit in fits])
    x = F.array(F.lit(1.0), *[F.col(c).cast("double") for c in columns])
    score = F.aggregate(F.zip_with(x, F.get(known, F.col("fold")), lambda u, v: u * v), F.lit(0.0), lambda s, v: s + v)
    scored = rows.select("fold", "label", (1 / (1 + F.exp(-score))).alias("score"))
    counts = scored.groupBy("fold", "score").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("label").cast("long")).alias("positive")
    )
    return evaluate(counts, ["fold"])


def logistic_model(table: DataFrame, columns: list[str]) -> DataFrame:
    """Coefficients, standard errors and z values of the model of all rows."""
    (fit,) = fit_logistic(written(table.select("label", *columns), "model-rows"), columns, [None])
    terms = [
        (name, b, e, b / e if e > 1e-9 else None)
        for name, b, e in zip(["(intercept)", *columns], fit.coefficients, fit.errors)
    ]
    return table.sparkSession.createDataFrame(terms, "term string, coefficient double, std_error double, z double")


# --- trees --------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Setting:
    min_split: int
    min_bucket: int
    complexity: float


def _between(low: float, high: float, resolution: int, whole: bool) -> list:
    steps = [low + (high - low) * i / max(resolution - 1, 1) for i in range(resolution)]
    return [round(s) for s in steps] if whole else steps


def full_grid(resolution: int = 10) -> list[Setting]:
    """All combinations of evenly spaced values of the three ranges."""
    return [
        Setting(*values)
        for values in product(
            _between(*MIN_SPLITS, resolution, True),
            _between(*MIN_BUCKETS, resolution, True),
            _between(*COMPLEXITIES, resolution, False),
        )
    ]


def _rows_of(table: DataFrame, columns: list[str]) -> DataFrame:
    return table.select(
        "fold", F.col("label").cast("int").alias("label"), F.array(*[F.col(c).cast("double") for c in columns]).alias("x")
    )


def tree_scores(table: DataFrame, columns: list[str], grid: list[Setting], folds: int = TREE_FOLDS) -> DataFrame:
    """Each setting and fold with its rows, positives, AUC and accuracy, scored by the tree of the other folds.

    Settings that differ in complexity only share their trees: a row's leaf in a pruned tree is an ancestor of its leaf in the grown
    one, so counts by grown leaf answer for all of them.
    """
    spark = table.sparkSession
    rows = written(_rows_of(with_folds(table.select("opportunity_id", "label", *columns), folds), columns), "folds")
    shapes = sorted({(s.min_split, s.min_bucket) for s in grid})
    growths = [Growth(fold, *shape) for shape in shapes for fold in range(folds)]
    trees, counts = grow(rows, growths)
    # one row for each leaf and setting
    kinds = pa.schema([("tree", pa.int32()), ("node", pa.int64()), ("setting", pa.int32()), ("fold", pa.int32()), ("score", pa.float64())])
    scores = [kinds.empty_table()]
    for number, (tree, growth) in enumerate(zip(trees, growths)):
        leaf = tree.feature < 0
        node = tree.number[leaf]
        for place, s in enumerate(grid):
            if (s.min_split, s.min_bucket) == (growth.min_split, growth.min_bucket):
                ends = tree.ends(s.complexity)[leaf]
                same = [np.full(len(node), v, np.int32) for v in (number, place, growth.held_out)]
                columns = [same[0], node, *same[1:], tree.positive[ends] / tree.n[ends]]
                scores.append(pa.Table.from_arrays([pa.array(c) for c in columns], schema=kinds))
    known = spark.createDataFrame(pa.concat_tables(scores))
    return evaluate(counts.join(known, ["tree", "node"]), ["setting", "fold"])


def tree_search(table: DataFrame, columns: list[str], grid: list[Setting], folds: int = TREE_FOLDS) -> DataFrame:
    """All settings with their mean AUC and accuracy; `best` marks the highest AUC (the first of several)."""
    spark = table.sparkSession
    scores = tree_scores(table, columns, grid, folds).groupBy("setting").agg(F.avg("auc").alias("auc"), F.avg("acc").alias("acc"))
    found = {r["setting"]: r for r in scores.collect()}
    rounded = {k: -1.0 if r["auc"] is None else round(r["auc"], 9) for k, r in found.items()}
    best = min(rounded, key=lambda k: (-rounded[k], k), default=None)
    rows = [
        (k, s.min_split, s.min_bucket, float(s.complexity), found[k]["auc"], found[k]["acc"], k == best)
        for k, s in enumerate(grid)
        if k in found
    ]
    return spark.createDataFrame(
        rows, "setting int, min_split int, min_bucket int, complexity double, auc double, acc double, best boolean"
    )


def tree_cv(table: DataFrame, columns: list[str], grid: list[Setting], folds: int = TREE_FOLDS) -> DataFrame:
    """Rows, positives, AUC and accuracy of each fold under the setting with the highest mean AUC."""
    scores = written(tree_scores(table, columns, grid, folds), "tree-scores")
    mean = scores.groupBy("setting").agg(F.round(F.avg("auc"), 9).alias("auc"))
    best = mean.agg(F.min_by("setting", F.struct(-F.col("auc"), "setting")).alias("setting"))
    return scores.join(F.broadcast(best), "setting").select("setting", "fold", "rows", "positives", "auc", "acc")


def tree_importance(table: DataFrame, columns: list[str], setting: Setting) -> DataFrame:
    """Splits and summed Gini gain of each feature in the pruned tree of all rows."""
    rows = _rows_of(table.withColumn("fold", F.lit(-2)), columns)
    (tree,), _ = grow(rows, [Growth(None, setting.min_split, setting.min_bucket)])
    kept = tree.splits(setting.complexity)
    found = [
        (name, sum(n.feature == k for n in kept), float(sum(n.gain for n in kept if n.feature == k)))
        for k, name in enumerate(columns)
    ]
    return table.sparkSession.createDataFrame(found, "feature string, splits int, importance double")
