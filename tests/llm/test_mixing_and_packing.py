import itertools
import random

from pyspark.sql import functions as F

from clickledger.llm.mixing import emit, mix_sources
from clickledger.llm.packing import Shape, best_bounds, pack

from .conftest import by_id


def test_targets_and_taken_words(spark):
    draw = random.Random(3)
    rows = [(i, " ".join(["w"] * draw.randint(1, 400)), "abc"[min(2, i % 12)]) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mix_sources(docs).collect()
    total = sum(r["size"] for r in got)
    for source in "abc":
        mine = [r for r in got if r["source"] == source]
        size, target = mine[0]["source_size"], mine[0]["target"]
        assert size == sum(r["size"] for r in mine) and target <= 2 * size
        assert abs(sum(r["taken"] for r in mine) - target) <= 2 * 400
        assert all(r["taken"] in (0, r["size"], 2 * r["size"]) for r in mine)
    targets = {r["source"]: r["target"] for r in got}
    assert abs(sum(targets.values()) - 1.5 * total) < 1e-6 * total
    assert targets["a"] == 2 * next(r["source_size"] for r in got if r["source"] == "a")  # stopped
    assert sorted(map(tuple, got)) == sorted(map(tuple, mix_sources(docs).collect()))


def test_targets_as_the_rounds_of_sharing_give_them(spark):
    sizes = {"a": 50, "b": 3000, "c": 100, "d": 400, "e": 10, None: 2000}
    docs = spark.createDataFrame(
        [(i, "w " * n, s) for i, (s, n) in enumerate(sizes.items())], "doc_id long, text string, source string"
    )
    weights = dict(zip(["a", "b", "c", "d", "e", None], itertools.cycle([3.0, 1.0, 2.0])))
    left, open_, target = 1.5 * sum(sizes.values()), set(sizes), {}
    while open_:
        level = left / sum(weights[s] for s in open_)
        stopped = {s for s in open_ if level * weights[s] > 2 * sizes[s]}
        for s in stopped or open_:
            target[s] = 2.0 * sizes[s] if stopped else level * weights[s]
        left -= sum(2 * sizes[s] for s in stopped)
        open_ = open_ - stopped if stopped else set()
    got = {r["source"]: r["target"] for r in mix_sources(docs).collect()}
    assert all(abs(got[s] - target[s]) < 1e-6 for s in sizes)


def test_emitted_rows_follow_the_mix(spark, awkward, nothing):
    mix = mix_sources(awkward)
    assert mix.count() == awkward.count()
    assert by_id(mix.filter("doc_id in (2, 3, 4)"), "size") == {2: (0,), 3: (0,), 4: (0,)}
    out = emit(awkward, mix)
    assert out.columns == awkward.columns
    assert out.count() == mix.agg(F.sum("copies")).first()[0]
    assert mix_sources(nothing).count() == 0 and emit(nothing, mix_sources(nothing)).count() == 0


def test_bounds_are_the_best():
    draw = random.Random(1)
    for _ in range(40):
        histogram = {n: draw.randint(1, 9) for n in draw.sample(range(1, 40), draw.randint(1, 9))}
        k = draw.randint(1, 5)
        lengths = sorted(histogram)

        def padding(bounds):
            return sum(c * (min(b for b in bounds if b >= n) - n) for n, c in histogram.items())

        best = min(
            padding([*cut, lengths[-1]])
            for size in range(min(k, len(lengths)))
            for cut in itertools.combinations(lengths[:-1], size)
        )
        got = best_bounds(histogram, k)
        assert len(got) <= k and got[-1] == lengths[-1] and padding(got) == best
    assert best_bounds({}, 3) == []


def test_every_word_is_packed_once(spark, awkward, nothing):
    shape = Shape(longest=50, buckets=3, budget=200)
    got = pack(awkward, shape, with_text=True).collect()
    words = sum(len((r["text"] or "").encode().split()) for r in awkward.select("text").collect())
    assert sum(r["n_words"] for r in got) == words == sum(len(r["text"].split()) for r in got)
    batches = {}
    for r in got:
        if r["n_words"]:
            assert r["n_words"] <= r["bound"] <= 50
            batches.setdefault((r["bound"], r["batch"]), []).append(r["slot"])
        else:
            assert r["bound"] is None and r["batch"] is None
    for (bound, _), slots in batches.items():
        assert sorted(slots) == list(range(len(slots))) and len(slots) * bound <= max(200, bound)
    # only the last batch of a bucket may be short
    for bound in {b for b, _ in batches}:
        sizes = [len(batches[b, n]) for b, n in sorted(batches) if b == bound]
        assert all(n == 200 // bound for n in sizes[:-1])
    assert pack(nothing).count() == 0
