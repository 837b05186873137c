"""Operators 11 to 13 against plain code."""

import hashlib
import random
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from clickledger.llm import centroids, queries, runs, vantage
from clickledger.llm.centroids import Pivots, cluster
from clickledger.llm.runs import find_runs, runs_of
from clickledger.llm.vantage import Shards, near_fingerprints
from pyspark.sql import functions as F

from .conftest import by_id


def order():
    return F.sha2(F.concat(F.lit("3:"), F.col("vec_id").cast("string")), 256)


def plain_clusters(rows, k, rounds):
    """Rows of (id, vector): id, cluster, distance, sums and digest, in whole numbers of any size."""
    good = [(i, [Fraction(x) * 1024 // 1 for x in v]) for i, v in rows]
    first = sorted(good, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    middles = [v for _, v in first[:k]]

    def far(v, c):
        return sum((a - b) ** 2 for a, b in zip(v, c))

    def own():
        return [min(range(len(middles)), key=lambda c: (far(v, middles[c]), c)) for _, v in good]

    for _ in range(rounds):
        labels = own()
        for c in range(len(middles)):
            mine = [v for (_, v), label in zip(good, labels) if label == c]
            if mine:
                middles[c] = [sum(x) // len(mine) for x in zip(*mine)]
    labels = own()
    distances = [far(v, middles[c]) for (_, v), c in zip(good, labels)]
    digest = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in middles]
    sums = [sum(d for d, x in zip(distances, labels) if x == c) for c in range(len(middles))]
    fits = lambda v: v if v < 1 << 63 else None
    total = sum(distances)
    unknown = [any(fits(d) is None for d, x in zip(distances, labels) if x == c) for c in range(len(middles))]
    return sorted(
        map(repr, [
            (i, c, fits(d), None if unknown[c] else fits(sums[c]), None if any(unknown) else fits(total), digest[c])
            for (i, _), c, d in zip(good, labels, distances)
        ])
    )


def got_clusters(table, **how):
    return sorted(repr(tuple(r)) for r in cluster(table, order=order(), **how).collect())


def test_clusters_as_by_plain_code(spark):
    draw = np.random.default_rng(4)
    middle = draw.normal(size=(5, 6)) * 3
    rows = [(i, (middle[i % 5] + draw.normal(size=6)).tolist()) for i in range(400)]
    rows += rows[:40] + [(1000 + i, rows[7][1]) for i in range(60)]
    # a grid has many ties
    rows += [(2000 + i, [float(x) for x in draw.integers(-1, 2, 6)]) for i in range(200)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    want = plain_clusters(rows, 8, 3)
    for pivots in (Pivots(), Pivots(1, 1)):
        assert got_clusters(table, k=8, rounds=3, size=6, how=pivots) == want


def test_bounds_are_below_and_leave_work_out():
    draw = np.random.default_rng(8)
    middles = np.floor(draw.normal(size=(8, 64)) * 4096).astype(np.int64)
    x = np.floor(middles[draw.integers(0, 8, 3000)] + draw.normal(size=(3000, 64)) * 300).astype(np.int64)
    pivots = centroids._spread(x[:100], 6)
    bounds = centroids.Bounds(pivots)
    near = np.column_stack([centroids.roots(centroids.squared(x, p)) for p in pivots])
    far = np.column_stack([centroids.roots(centroids.squared(middles, p)) for p in pivots])
    exact = np.column_stack([centroids.squared(x, m) for m in middles])
    assert (bounds(near, far) <= exact).all()
    own, best, taken = centroids.assign(x, near, middles, far, bounds)
    assert (own == exact.argmin(axis=1)).all() and (best == exact.min(axis=1)).all()
    assert taken < 1.5 * len(x)


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    fit = [(1, [0.5, -0.25]), (1, [0.5, -0.25]), (2, [0.1, 0.1]), (None, [3.0, 3.0]), (None, [3.0, 3.0]), (3, [0.0, 0.0])]
    broken = [(4, None), (5, []), (6, [1.0]), (7, [1.0, 2.0, 3.0]), (8, [1.0, None]), (9, [nan, 1.0]), (10, [inf, 1.0])]
    schema = "vec_id long, embedding array<double>, cluster string, distance string, near string, vector string"

    def table(rows):
        return spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], schema)

    for k in (3, 50):
        assert got_clusters(table(fit + broken), k=k, rounds=2, size=2) == plain_clusters(fit, k, 2)
    assert cluster(table(broken), 3, 2, order(), size=2).count() == 0
    empty = cluster(table(fit).filter("false"), 3, 2, order(), size=2)
    assert empty.count() == 0 and empty.columns == cluster(table(fit), 3, 2, order(), size=2).columns
    # beyond whole numbers of 64 bits
    vast = [*fit, (20, [1e300, -1e300]), (21, [1e9, 5.0]), (22, [-1e19, 1e-300])]
    assert got_clusters(table(vast), k=4, rounds=2, size=2) == plain_clusters(vast, 4, 2)


def plain_runs(words, least=24, times=3):
    out = []
    for q in range(1, len(words) // times + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, times * q):
                inside = any(q % d == 0 and s <= i and s + n >= j + q for s, n, d in out if d < q)
                if not inside:
                    out.append((i, j + q - i, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def check_runs(texts, **how):
    got = runs_of(pa.array(texts, pa.string()), **how)
    for text, found in zip(texts, got):
        assert found == plain_runs((text or "").encode().split(), **how), (text or "")[:300]
    return got


def test_runs_as_by_plain_code():
    draw = random.Random(6)
    texts = [None, "", " \n\t", "a", "a " * 23, "a " * 24, "a " * 25 + "b " * 30, "  " * 40]
    for _ in range(150):
        parts = []
        for _ in range(draw.randint(1, 6)):
            alphabet = draw.choice(["ab", "abc", "abcdefghijklmnop"])
            piece = [draw.choice(alphabet) for _ in range(draw.randint(1, 40))]
            again = piece * draw.randint(1, 9)
            parts += again[: len(again) - draw.randint(0, len(piece) - 1)]
        texts.append(" ".join(parts))
    # words of many kinds, a passage twice, its copies in a period, nested periods
    words = [f"w{draw.randint(0, 3000)}" for _ in range(1500)]
    texts += [" ".join(words), " ".join(words + words), " ".join(words + words[300:700] * 4 + words[:90])]
    inner = ("x y " * 13 + "z ").strip()
    texts += [f"{inner} " * 7, f"{inner} p {inner} q " * 4, "a b " * 30 + "a " * 30 + "b a " * 30]
    # random words of two kinds; words of Fibonacci and Thue and Morse
    texts += [" ".join(draw.choice("ab") for _ in range(2000))]
    one, two = "a", "a b"
    for _ in range(12):
        one, two = two, f"{two} {one}"
    texts += [two, " ".join("ab"[bin(i).count("1") % 2] for i in range(1000))]
    got = check_runs(texts)
    assert sum(map(len, got)) > 200
    for least, times in ((8, 2), (5, 3), (1, 2), (30, 4)):
        check_runs(texts[:120], least=least, times=times)


def test_grammar_pairs_repeat_and_derive_the_text():
    draw = random.Random(2)
    words = [draw.choice("abcd") for _ in range(400)] * 3 + ["e"] * 100
    _, ids = np.unique(words, return_inverse=True)
    doc = np.zeros(len(ids), np.int64)
    grammar = runs.Grammar(ids, doc, 2)
    symbols = len(grammar.size)
    assert symbols > 100 and grammar.top.sum() < 300
    for k in range(symbols):
        places = grammar.places[grammar.first[k] : grammar.first[k + 1]]
        texts = {tuple(words[p : p + grammar.size[k]]) for p in places}
        assert len(texts) == 1 and 0 < grammar.left[k] < grammar.size[k]


def test_long_runs_take_one_pass():
    words = "lorem ipsum dolor sit amet "
    text = words * 30_000 + "end " + "x " * 50_000
    assert runs_of(pa.array([text]))[0] == [(0, 150_000, 5), (150_001, 50_000, 1)]


def test_awkward_runs(awkward, nothing):
    found = find_runs(awkward)
    assert found.count() == awkward.count()
    rows = by_id(found.filter("doc_id IS NOT NULL"), "n_words", "runs", "strongest", "collapsed")
    assert rows[2] == rows[3] == rows[4] == (0, [], None, "")
    assert [tuple(r) for r in rows[5][1]] == [(0, 100_000, 5)] and rows[5][3] == "lorem ipsum dolor sit amet"
    assert rows[6][3] == "lorem ipsum dolor sit amet more" and tuple(rows[6][2]) == (0, 100_000, 5)
    assert rows[8][3] == "ein Wort und noch ein Wort der Sprache"
    assert find_runs(nothing).count() == 0


def test_ties_for_the_strongest_run(spark):
    a, b = "a b " * 15, "c d " * 15
    got = by_id(find_runs(spark.createDataFrame([(1, f"{a}- {b}"), (2, f"{b}x y z")], "doc_id long, text string")), "strongest")
    assert tuple(got[1][0]) == (0, 30, 2) and tuple(got[2][0]) == (0, 30, 2)


def plain_fingerprint(text, width=4):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + width]) for i in range(max(len(words) - width + 1, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, points, radius):
    label = list(range(len(points)))

    def top(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, a in enumerate(points):
        for j in range(i):
            if (a ^ points[j]).bit_count() <= radius:
                x, y = top(i), top(j)
                label[max(x, y)] = min(x, y)
    smallest = {}
    for i, d in enumerate(ids):
        if d is not None:
            smallest[top(i)] = min(d, smallest.get(top(i), d))
    return [smallest.get(top(i)) for i in range(len(ids))]


def test_fingerprints_as_by_plain_code(documents):
    rows = documents.select("doc_id", "text").collect()
    got = {r["doc_id"]: r for r in near_fingerprints(documents).collect()}
    points = [plain_fingerprint(r["text"]) for r in rows]
    assert [got[r["doc_id"]]["fingerprint"] % (1 << 64) for r in rows] == points
    assert [got[r["doc_id"]]["component_id"] for r in rows] == plain_components([r["doc_id"] for r in rows], points, 4)


def dense_points(draw, balls, size, bits, loose):
    """Points around a few middles, some of them chains, and points anywhere."""
    points = [draw.getrandbits(64) for _ in range(loose)]
    for _ in range(balls):
        at = draw.getrandbits(64)
        for _ in range(size):
            point = at
            for _ in range(draw.randint(0, bits)):
                point ^= 1 << draw.randrange(64)
            points.append(point)
            if draw.random() < 0.02:
                at = point
    return sorted(set(points))


@pytest.mark.parametrize("radius", [0, 1, 4, 9])
def test_links_span_the_components(radius):
    draw = random.Random(radius)
    points = dense_points(draw, 6, 250, 6, 1500)
    found = vantage.links_among(np.array(points, np.uint64), radius)
    assert all((points[a] ^ points[b]).bit_count() <= radius for a, b in found)
    label = list(range(len(points)))

    def top(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in found:
        x, y = top(a), top(b)
        label[max(x, y)] = min(x, y)
    assert [top(i) for i in range(len(points))] == plain_components(list(range(len(points))), points, radius)


def test_a_dense_group_gives_few_links():
    draw = random.Random(3)
    points = np.array(dense_points(draw, 1, 6000, 4, 0), np.uint64)
    assert len(vantage.links_among(points, 4)) < 2 * len(points)


def test_shards_hold_every_near_pair():
    draw = random.Random(9)
    points = np.array(dense_points(draw, 20, 60, 5, 2000), np.uint64)
    tree = vantage.Tree.fit(points[::3], 4, 32, 1)
    who, where = tree.place(points, 4)
    assert tree.shards > 20 and set(who.tolist()) == set(range(len(points)))
    shards = [set() for _ in points]
    for k, shard in zip(who.tolist(), where.tolist()):
        shards[k].add(shard)
    for i, a in enumerate(points):
        for j in np.flatnonzero(vantage.apart(points, a) <= 4):
            assert shards[i] & shards[j]


def test_large_shards_are_linked_by_pieces(spark):
    draw = random.Random(12)
    points = dense_points(draw, 3, 200, 7, 150)
    rows = [(p - (1 << 64) if p >> 63 else p,) for p in points]
    table = spark.createDataFrame(rows, "point long").repartition(3)
    how = Shards(sample=64, leaf=32, most=40, centers=3)
    found = [(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in vantage.links(table, 4, how).collect()]
    label = {p: p for p in points}

    def top(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in found:
        assert (a ^ b).bit_count() <= 4
        x, y = top(a), top(b)
        label[max(x, y)] = min(x, y)
    assert [top(p) for p in points] == plain_components(points, points, 4)


def test_points_anywhere_meet_few_others(spark, monkeypatch):
    """Points without near ones: no shard grows with the table, and few pairs are compared."""
    points = np.random.default_rng(8).integers(0, 1 << 64, 20_000, dtype=np.uint64)
    points = np.unique(np.r_[points, points[:50] ^ np.uint64(0b10110000000001)])
    kept = {}
    monkeypatch.setattr(vantage, "step", lambda df, name, keep=vantage.step: kept.setdefault(name, keep(df, name)))
    table = spark.createDataFrame([(int(p),) for p in points.view(np.int64)], "point long").repartition(3)
    found = {tuple(sorted((r["a"], r["b"]))) for r in vantage.links(table, 4, Shards()).collect()}
    assert len(found) == 50
    assert kept["shards"].groupBy("shard").count().agg({"count": "max"}).first()[0] < 100
    compared = []
    monkeypatch.setattr(vantage, "apart", lambda a, b: compared.append(np.broadcast(a, b).size) or np.bitwise_count(a ^ b))
    assert len(vantage.links_among(points, 4)) >= 50 and sum(compared) < 100 * len(points)


def test_awkward_fingerprints(spark, awkward, nothing):
    found = near_fingerprints(awkward)
    assert found.count() == awkward.count()
    rows = by_id(found.filter("doc_id IS NOT NULL"), "fingerprint", "component_id")
    assert rows[2] == rows[3] == rows[4] == (0, 2)
    assert {r["component_id"] for r in found.filter("doc_id IS NULL").collect()} == {None}
    assert near_fingerprints(nothing).count() == 0
    two = spark.createDataFrame([(5, "one two three four five"), (5, "other words than these"), (None, "OTHER words than these"),
                                 (9, "x y z")], "doc_id long, text string")
    got = sorted((str(r["doc_id"]), r["component_id"]) for r in near_fingerprints(two).collect())
    assert got == [("5", 5), ("5", 5), ("9", 9), ("None", 5)]


def test_queries_read_whole_tables(spark):
    folder = "/root/testdata/sf0.001"
    found = queries.op13_simhash(spark, folder).collect()
    assert len(found) == 200 and all(len(r["fingerprint"]) == 16 for r in found)
    got = by_id(queries.op12_runs(spark, folder), "n_runs", "exponent_milli")
    assert len(got) == 200 and any(n for n, _ in got.values())
