import itertools
import math
import random

import numpy as np
from pyspark.sql import functions as F

from clickledger.operators import cuts
from clickledger.operators import trees as tree_code
from clickledger.operators.trees import Growth, Node, Tree, grow
from clickledger.plans import features, models

from .conftest import rows


def plain_cuts(pairs):
    """Recursive splits of (value, label) pairs by their definition."""
    def h(part):
        p = sum(y for _, y in part) / len(part)
        return -sum(q * math.log2(q) for q in (p, 1 - p) if q)

    n, found = len(pairs), []
    for v in sorted({v for v, _ in pairs})[:-1]:
        a, b = [x for x in pairs if x[0] <= v], [x for x in pairs if x[0] > v]
        found.append((round((len(a) * h(a) + len(b) * h(b)) / n, 10), v, a, b))
    if not found:
        return []
    mean, v, a, b = min(found, key=lambda f: f[:2])
    k, k1, k2 = (len({y for _, y in part}) for part in (pairs, a, b))
    told = math.log2(3**k - 2) - (k * h(pairs) - k1 * h(a) - k2 * h(b))
    if h(pairs) - (len(a) * h(a) + len(b) * h(b)) / n <= (math.log2(n - 1) + told) / n:
        return []
    return plain_cuts(a) + [v] + plain_cuts(b)


def test_cuts_as_by_their_definition(spark):
    draw = random.Random(5)
    made = []
    for _ in range(400):
        x = draw.randint(-40, 40)
        made.append((int(draw.random() < (0.9 if 5 < x < 20 else 0.15)), float(x), draw.random() * 10**6, float(draw.randint(0, 2)), 1.0))
    columns = ["x", "noise", "few", "one"]
    df = spark.createDataFrame(made, "label int, x double, noise double, few double, one double")
    got, counts = cuts.supervised_cuts(df, "label", columns)
    want = {c: plain_cuts([(r[i + 1], r[0]) for r in made]) for i, c in enumerate(columns)}
    assert got == want and len(want["x"]) >= 2 and want["one"] == []
    assert counts.filter("feature = 'x'").agg(F.sum("n")).first()[0] == 400


def test_cuts_of_one_label_and_of_no_rows(spark):
    df = spark.createDataFrame([(1, float(i)) for i in range(50)], "label int, x double")
    assert cuts.supervised_cuts(df, "label", ["x"])[0] == {"x": []}
    assert cuts.supervised_cuts(df.filter("false"), "label", ["x"])[0] == {"x": []}


def test_gain_of_all_features_needs_one_plan(spark):
    df = spark.createDataFrame([(i % 2, float(i % 7), float(i % 2), i % 3 == 0) for i in range(210)], "label int, a double, b double, c boolean")
    gains = features.information_gain(df, "label", ["a", "b", "c"])
    text = gains._jdf.queryExecution().toString()
    assert len(text) < 50_000 and "Subquery" not in text
    assert features.keep_informative(gains, 0.5) == ["b"]


def plain_auc(pairs):
    ups, downs = [s for s, y in pairs if y], [s for s, y in pairs if not y]
    return sum((a > b) + (a == b) / 2 for a in ups for b in downs) / (len(ups) * len(downs))


def test_auc_as_by_all_pairs(spark):
    draw = random.Random(7)
    made = [(f, draw.randint(0, 9) / 10 if f else draw.random(), int(draw.random() < 0.4)) for f in range(2) for _ in range(200)]
    made += [(2, 0.3, 1), (2, 0.4, 1)]
    df = spark.createDataFrame(made, "fold int, score double, label int")
    counts = df.groupBy("fold", "score").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("positive"))
    for r in rows(models.evaluate(counts, ["fold"]), "fold"):
        pairs = [(s, y) for f, s, y in made if f == r["fold"]]
        assert (r["rows"], r["positives"]) == (len(pairs), sum(y for _, y in pairs))
        assert abs(r["acc"] - sum((s > 0.5) == bool(y) for s, y in pairs) / len(pairs)) < 1e-12
        assert r["auc"] is None if r["fold"] == 2 else abs(r["auc"] - plain_auc(pairs)) < 1e-12


def sample(n=300, seed=3):
    draw = np.random.default_rng(seed)
    x = draw.normal(size=(n, 3))
    x[:, 2] = np.round(x[:, 2])
    y = (draw.random(n) < 1 / (1 + np.exp(-(0.5 + x @ [1.2, -0.7, 0.0])))).astype(int)
    return x, y


def plain_logistic(x, y):
    x = np.column_stack([np.ones(len(x)), x])
    b = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ b))
        b = b + np.linalg.solve((x.T * (p * (1 - p))) @ x, x.T @ (y - p))
    p = 1 / (1 + np.exp(-x @ b))
    return b, np.sqrt(np.diag(np.linalg.inv((x.T * (p * (1 - p))) @ x)))


def test_logistic_fits_as_by_a_plain_solve(spark):
    x, y = sample()
    df = spark.createDataFrame(
        [(str(i), int(v), i % 4, *map(float, row), 0.0) for i, (row, v) in enumerate(zip(x, y))],
        "opportunity_id string, label int, fold int, a double, b double, c double, still double",
    )
    fits = models.fit_logistic(df, ["a", "b", "c"], [None, 0, 3])
    for fit, learned in zip(fits, (np.full(300, True), np.arange(300) % 4 != 0, np.arange(300) % 4 != 3)):
        b, errors = plain_logistic(x[learned], y[learned])
        assert np.abs(np.array(fit.coefficients) - b).max() < 1e-6 and np.abs(np.array(fit.errors) - errors).max() < 1e-6
        assert fit.rounds < 12
    terms = {r["term"]: r for r in rows(models.logistic_model(df, ["a", "still"]))}
    assert (terms["still"]["coefficient"], terms["still"]["z"]) == (0.0, None) and terms["a"]["coefficient"] > 0.5
    judged = rows(models.logistic_cv(df, ["a", "b", "c"], folds=3), "fold")
    assert [r["rows"] for r in judged] == [100] * 3 or sum(r["rows"] for r in judged) == 300
    assert all(r["auc"] > 0.6 for r in judged)
    assert models.logistic_cv(df.filter("false"), ["a"], folds=3).count() == 0


def plain_tree(x, y, min_split, min_bucket, number=1, nodes=None):
    nodes = {} if nodes is None else nodes
    n, p = len(y), int(y.sum())
    nodes[number] = Node(n, p)
    if n < min_split or p in (0, n):
        return nodes

    def pure(part):
        return (part.sum() ** 2 + (len(part) - part.sum()) ** 2) / len(part)

    found = []
    for f in range(x.shape[1]):
        seen = sorted(set(x[:, f].tolist()))
        for v, after in zip(seen, seen[1:]):
            left = x[:, f] <= v
            if min(left.sum(), n - left.sum()) >= min_bucket:
                found.append((-round(pure(y[left]) + pure(y[~left]) - pure(y), 9), f, v, (v + after) / 2))
    if not found or min(found)[0] >= 0:
        return nodes
    gain, f, v, cut = min(found)
    left = x[:, f] <= v
    nodes[number].feature, nodes[number].cut, nodes[number].gain = f, cut, -gain
    plain_tree(x[left], y[left], min_split, min_bucket, 2 * number, nodes)
    plain_tree(x[~left], y[~left], min_split, min_bucket, 2 * number + 1, nodes)
    return nodes


def leaf_of(nodes, row):
    number = 1
    while nodes[number].feature is not None:
        number = 2 * number + (row[nodes[number].feature] > nodes[number].cut)
    return number


def test_trees_grow_as_by_plain_code(spark):
    x, y = sample(260, 9)
    fold = np.arange(260) % 3
    df = spark.createDataFrame([(int(f), int(v), row.tolist()) for f, v, row in zip(fold, y, x)], "fold int, label int, x array<double>")
    growths = [Growth(None, 20, 5), Growth(0, 20, 5), Growth(2, 40, 12), Growth(1, 2, 1)]
    trees, counts = grow(df, growths)
    for k, (tree, g) in enumerate(zip(trees, growths)):
        learned = np.full(260, True) if g.held_out is None else fold != g.held_out
        want = plain_tree(x[learned], y[learned], g.min_split, g.min_bucket)
        assert tree.nodes == want and len(want) > 5
        leaves = [(leaf_of(want, row), v) for row, v in zip(x[~learned], y[~learned])]
        got = {r["node"]: (r["n"], r["positive"]) for r in counts.filter(F.col("tree") == k).collect()}
        assert got == {e: (sum(a == e for a, _ in leaves), sum(v for a, v in leaves if a == e)) for e, _ in leaves}


def subtrees(nodes, i):
    """All ways to prune below node i, as sets of leaves."""
    yield {i}
    if nodes[i].feature is not None:
        for a, b in itertools.product(subtrees(nodes, 2 * i), subtrees(nodes, 2 * i + 1)):
            yield a | b


def test_pruning_as_by_all_subtrees():
    for seed in range(12):
        x, y = sample(60, seed)
        nodes = plain_tree(x, y, 12, 4)
        tree = Tree(nodes)
        for complexity in (0.0, 0.0001, 0.01, 0.02, 0.05, 0.1, 0.3, 1.0):
            price = complexity * nodes[1].errors()
            # least cost, then fewest leaves
            best = min(subtrees(nodes, 1), key=lambda s: (round(sum(nodes[i].errors() + price for i in s), 6), len(s)))
            got = tree.pruned(complexity)
            assert set(got.values()) == best and set(got) == {i for i in nodes if nodes[i].feature is None}
            assert all(leaf >> (leaf.bit_length() - end.bit_length()) == end for leaf, end in got.items())
            assert len(tree.splits(complexity)) == len(best) - 1


def test_the_full_grid_spans_the_ranges():
    grid = models.full_grid()
    assert len(grid) == 1000 and grid[0] == models.Setting(40, 5, 0.0001) and grid[-1] == models.Setting(120, 40, 0.1)
    assert len({s.min_split for s in models.full_grid(3)}) == 3


def test_tree_search_marks_the_best(spark):
    x, y = sample(240, 1)
    df = spark.createDataFrame(
        [(str(i), int(v), *map(float, row)) for i, (row, v) in enumerate(zip(x, y))], "opportunity_id string, label int, a double, b double, c double"
    )
    grid = [models.Setting(20, 5, c) for c in (0.0, 0.02, 1.0)]
    search = rows(models.tree_search(df, ["a", "b", "c"], grid), "setting")
    best = [r for r in search if r["best"]]
    assert len(best) == 1 and best[0]["auc"] == max(r["auc"] for r in search) and abs(search[2]["auc"] - 0.5) < 1e-9
    judged = rows(models.tree_cv(df, ["a", "b", "c"], grid), "fold")
    assert [r["setting"] for r in judged] == [best[0]["setting"]] * 3 and sum(r["rows"] for r in judged) == 240
    kept = rows(models.tree_importance(df, ["a", "b", "c"], models.Setting(20, 5, 0.02)), "feature")
    assert kept[0]["importance"] > 0 and sum(r["splits"] for r in kept) >= 1


def test_large_nodes_grow_as_by_plain_code(spark):
    draw = np.random.default_rng(4)
    x = draw.normal(size=(400, 4))
    x[:, 1], x[:, 2], x[:, 3] = np.round(x[:, 1], 1), np.where(x[:, 2] < 0.8, 0.0, x[:, 2]), 1.0
    y = (draw.random(400) < np.where((x[:, 0] > 0.3) ^ (x[:, 1] > 0), 0.8, 0.2)).astype(int)
    fold = np.arange(400) % 3
    df = spark.createDataFrame([(int(f), int(v), row.tolist()) for f, v, row in zip(fold, y, x)], "fold int, label int, x array<double>")
    growths = [Growth(None, 20, 5), Growth(1, 10, 1)]
    # bins that hold several values, nodes above and below `small`, and an end before the last split
    for small, bins, depth in ((130, 7, 30), (0, 3, 3)):
        trees, counts = grow(df, growths, depth, small, bins)
        for k, (tree, g) in enumerate(zip(trees, growths)):
            learned = np.full(400, True) if g.held_out is None else fold != g.held_out
            want = plain_tree(x[learned], y[learned], g.min_split, g.min_bucket)
            assert len(want) > 30 and any(i >= 2 ** (depth + 1) for i in want) == (depth == 3)
            want = {
                i: node if i < 2**depth else Node(node.n, node.positive) for i, node in want.items() if i < 2 ** (depth + 1)
            }
            assert tree.nodes == want
            leaves = [(leaf_of(want, row), v) for row, v in zip(x[~learned], y[~learned])]
            got = {r["node"]: (r["n"], r["positive"]) for r in counts.filter(F.col("tree") == k).collect()}
            assert got == {e: (sum(a == e for a, _ in leaves), sum(v for a, v in leaves if a == e)) for e, _ in leaves}


def test_trees_of_one_search_share_their_rows(spark, monkeypatch):
    """Trees that hold out the same fold stand on the same rows until their smallest sides part them."""
    draw = np.random.default_rng(6)
    x = np.round(draw.normal(size=(600, 3)), 1)
    x[:, 2] = np.where(draw.random(600) < 0.02, 1.0, 0.0)
    y = np.where(x[:, 2] > 0, 1, draw.random(600) < np.where(x[:, 0] > 0.3, 0.7, 0.3)).astype(int)
    fold = np.arange(600) % 3
    df = spark.createDataFrame([(int(f), int(v), row.tolist()) for f, v, row in zip(fold, y, x)], "fold int, label int, x array<double>")
    growths = [Growth(held, split, bucket) for split in (10, 60) for bucket in (0, 8, 25) for held in (2, None)]
    moved = []
    keep = tree_code.written
    monkeypatch.setattr(tree_code, "written", lambda df, name: moved.append((name, keep(df, name))) or moved[-1][1])
    for small, bins in ((300, 9), (10**6, 256)):
        moved.clear()
        trees, counts = grow(df, growths, 30, small, bins)
        for k, (tree, g) in enumerate(zip(trees, growths)):
            learned = np.full(600, True) if g.held_out is None else fold != g.held_out
            assert tree.nodes == plain_tree(x[learned], y[learned], g.min_split, max(g.min_bucket, 1))
        assert len({len(tree.nodes) for tree in trees}) > 4
        got = {(r["tree"], r["node"]): (r["n"], r["positive"]) for r in counts.collect()}
        judged = [k for k, g in enumerate(growths) if g.held_out is not None]
        leaves = [(k, leaf_of(trees[k].nodes, row), v) for k in judged[::2] for row, v, f in zip(x, y, fold) if f == growths[k].held_out]
        for k, e in {(k, e) for k, e, _ in leaves}:
            assert got[k, e] == (sum((a, b) == (k, e) for a, b, _ in leaves), sum(v for a, b, v in leaves if (a, b) == (k, e)))
        # 600 + 400 rows learn, and few splits differ
        levels = [df.count() for name, df in moved if name == "tree-rows"]
        assert all(n <= 2 * 1000 for n in levels) and bool(levels) == (small < 10**6)


def test_jobs_of_a_tree_do_not_grow_with_its_depth(spark):
    """A chain of splits: each takes the next twelve rows off."""
    made = [(str(i), i // 12 % 2, float(i)) for i in range(360)]
    df = spark.createDataFrame(made, "opportunity_id string, label int, a double")
    spark.sparkContext.setJobGroup("tree", "tree")
    try:
        (kept,) = rows(models.tree_importance(df, ["a"], models.Setting(2, 1, 0.0)))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert kept["splits"] == 29
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("tree")) < 12
