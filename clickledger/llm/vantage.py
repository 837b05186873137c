"""Near duplicates by SimHash fingerprints, found exactly by parts of their bits and with vantage-point trees.

A fingerprint bit is set where more than half of the hashes of a text's shingles have it. Two documents are
linked where their fingerprints differ in few bits; linked documents form components.

Equal fingerprints are one point first. The bits are cut into one part more than `radius`: two points at most `radius` apart
agree on all bits of some part, so the points that agree on a part are a shard. Points without near ones lie anywhere, at nearly the same
distance from each other, so no distance parts them, but few of them share a shard, and a shard of many is parted again by the bits in
which it differs.

Dense points, which agree on most parts, are parted by their distance to a vantage point. Two points that are at most `radius`
apart and fall on different sides are, by the triangle inequality, within `radius` of the cut, so it is enough that
points just inside the cut go to the outer side too; then some side holds both. Shards too large for one task are cut so by a tree fitted
on a bounded sample of their points; within a shard the cuts go on in memory until few points are left, which are compared by blocks.
Shards and blocks give spanning links only, never all pairs of a dense group. A shard that stays too large (points so dense that no
cut parts them) is linked to some of its points first; then only points outside its largest component meet the pieces of the shard.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch_limits, batches, raw_texts, step
from .components import components

_SEED = 42
# points compared by block; points that agree on a part and are compared in place
_LEAF = 512
_FEW = 64


@dataclass(frozen=True)
class Shards:
    """`most`: points that one task takes at once; `sample`: points of larger shards that a tree is fitted on, at most; `leaf`: points
    of the sample in a shard of the tree, at most, also where the sample is the whole table; `centers`: points of a shard that stays too
    large that all its points are compared with first."""

    sample: int = 4096
    leaf: int = 64
    most: int = 250_000
    centers: int = 32
    seed: int = 11


def fingerprints_of(texts: pa.Array, width: int) -> np.ndarray:
    """Fingerprint of each text: A-Z as a-z, shingles of `width` words, repeats included; 0 without words."""
    out = np.zeros(len(texts), np.uint64)
    for k, text in enumerate(raw_texts(texts)):
        words = text.lower().split()
        if not words:
            continue
        line = b" ".join(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes + 1) - 1
        starts = (ends - sizes).tolist()
        ends = ends[min(width, len(words)) - 1 :].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter((digest(line[a:b], _SEED) for a, b in zip(starts, ends)), np.uint64, len(ends))
        out[k] = majority(hashes)
    return out


def majority(hashes: np.ndarray) -> np.uint64:
    """The bits set in more than half of the hashes."""
    counts = np.zeros(64, np.int64)
    for low in range(0, len(hashes), 1 << 16):
        part = hashes[low : low + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(hashes)).astype(np.uint64)
    return (bits << np.arange(64, dtype=np.uint64)).sum(dtype=np.uint64)


def apart(points: np.ndarray, other: np.ndarray) -> np.ndarray:
    return np.bitwise_count(points ^ other)


def best_cut(points: np.ndarray, radius: int, draw: np.random.Generator, tries: int = 4) -> tuple[np.uint64, int] | None:
    """The vantage point and the largest inner distance that part points best, or None.

    A cut sends a share more points down in all and gains the entropy of its sides; the ratio is kept small.
    """
    best = None
    for vantage in points[draw.integers(0, len(points), tries)]:
        within = np.cumsum(np.bincount(apart(points, vantage), minlength=65))
        p = within[:64] / len(points)
        more = (within[:64] - np.r_[np.zeros(radius, np.int64), within[: 64 - radius]]) / len(points)
        fine = (p > 0.03) & (p < 0.97) & (1 - p + more < 0.97)
        if fine.any():
            p, more, cut = p[fine], more[fine], np.flatnonzero(fine)
            price = np.log1p(more) / -(p * np.log(p) + (1 - p) * np.log(1 - p))
            k = int(price.argmin())
            if best is None or price[k] < best[0]:
                best = price[k], vantage, int(cut[k])
    return best and best[1:]


@dataclass
class Tree:
    """Vantage points and cuts of the inner nodes; a child c < 0 is shard number -c - 1."""

    vantage: list[int]
    cut: list[int]
    children: list[list[int]]
    shards: int

    @staticmethod
    def fit(points: np.ndarray, radius: int, leaf: int, seed: int) -> Tree:
        tree, draw = Tree([], [], [], 0), np.random.default_rng(seed)

        def grow(points: np.ndarray) -> int:
            found = best_cut(points, radius, draw) if len(points) > leaf else None
            if found is None:
                tree.shards += 1
                return -tree.shards
            vantage, cut = found
            node = len(tree.vantage)
            tree.vantage.append(int(vantage))
            tree.cut.append(cut)
            tree.children.append([0, 0])
            far = apart(points, vantage)
            # sized by the points that belong to a side, so copies at the cut do not deepen the tree
            tree.children[node] = [grow(points[far <= cut]), grow(points[far > cut])]
            return node

        grow(points)
        return tree

    def place(self, points: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Shards that each point belongs to or lies at the edge of: places of points, and shards."""
        who, where = [], []
        waiting = [(0 if self.vantage else -1, np.arange(len(points)))]
        while waiting:
            node, some = waiting.pop()
            if not len(some):
                continue
            if node < 0:
                who.append(some)
                where.append(np.full(len(some), -node - 1))
                continue
            far = apart(points[some], np.uint64(self.vantage[node])).astype(np.int64)
            inner, outer = self.children[node]
            waiting.append((inner, some[far <= self.cut[node]]))
            waiting.append((outer, some[far > self.cut[node] - radius]))
        if not who:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(who), np.concatenate(where)


def _walk(near: np.ndarray, start: int, left: np.ndarray) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Links that span the component of `start` in a matrix, and what is left of the others."""
    out, waiting = [], [start]
    while waiting and len(left):
        k = waiting.pop()
        hit = near[k, left]
        found = left[hit]
        out += [(k, int(x)) for x in found]
        waiting += found.tolist()
        left = left[~hit]
    return out, left


def _block(points: np.ndarray, some: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Spanning links of few points."""
    near = apart(points[some][:, None], points[some][None, :]) <= radius
    rows = np.flatnonzero(near.sum(axis=1) > 1)
    out, left = [], rows
    while len(left):
        links, left = _walk(near, int(left[0]), left[1:])
        out += [(int(some[a]), int(some[b])) for a, b in links]
    return out


def _dense(points: np.ndarray, some: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Spanning links of many points that no cut parts: each linked point meets only those not reached yet."""
    out, left = [], some
    while len(left):
        waiting, left = [int(left[0])], left[1:]
        while waiting and len(left):
            k = waiting.pop()
            hit = apart(points[left], points[k]) <= radius
            if hit.any():
                out += [(k, int(x)) for x in left[hit]]
                waiting += left[hit].tolist()
                left = left[~hit]
    return out


def masks(bits: list[int], radius: int) -> list[int]:
    """`radius` + 1 parts of the bits: points that differ in at most `radius` of them agree on all bits of a part."""
    edges = [len(bits) * i // (radius + 1) for i in range(radius + 2)]
    return [sum(1 << b for b in bits[low:high]) for low, high in zip(edges, edges[1:])]


def agreeing(points: np.ndarray, some: np.ndarray, radius: int) -> list[np.ndarray] | None:
    """Groups of `some` that hold every pair at most `radius` apart, or None where they are not far less work than all.

    A group agrees on a part of the bits in which the points differ. Groups of few points are left out unless some pair is near.
    """
    mine = points[some]
    differ = int(np.bitwise_or.reduce(mine ^ mine[0]))
    parts = []
    work = 0.0
    for mask in masks([b for b in range(64) if differ >> b & 1], radius):
        key = mine & np.uint64(mask)
        order = np.argsort(key)
        starts = np.flatnonzero(np.r_[True, np.diff(key[order]) != 0])
        sizes = np.diff(np.r_[starts, len(some)])
        work += float((sizes.astype(float) ** 2).sum())
        parts.append((order, starts, sizes))
    if work > len(some) ** 2 / 32:
        return None
    out = []
    for order, starts, sizes in parts:
        ends, of = np.repeat(starts + sizes, sizes), np.repeat(np.arange(len(starts)), sizes)
        met = sizes > _FEW
        at, line = np.flatnonzero(~met[of]), mine[order]
        for ahead in range(1, _FEW):
            at = at[at + ahead < ends[at]]
            if not len(at):
                break
            met[of[at[apart(line[at], line[at + ahead]) <= radius]]] = True
        out += [some[order[starts[k] : starts[k] + sizes[k]]] for k in np.flatnonzero(met)]
    return out


def links_among(points: np.ndarray, radius: int, seed: int = 0) -> list[tuple[int, int]]:
    """Links, as places, that join all points at most `radius` apart into their components."""
    draw, out = np.random.default_rng(seed), []
    waiting = [np.arange(len(points))]
    while waiting:
        some = waiting.pop()
        if len(some) <= _LEAF:
            out += _block(points, some, radius)
            continue
        groups = agreeing(points, some, radius)
        if groups is not None:
            waiting += groups
            continue
        found = best_cut(points[some], radius, draw)
        if found is None:
            out += _dense(points, some, radius)
            continue
        vantage, cut = found
        far = apart(points[some], vantage).astype(np.int64)
        waiting += [some[far <= cut], some[far > cut - radius]]
    return out


def links_across(strays: np.ndarray, points: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """For each stray, a link to each of the points that are near."""
    out = []
    for k, stray in enumerate(strays):
        out += [(k, int(x)) for x in np.flatnonzero(apart(points, stray) <= radius)]
    return out


def _signed(points: np.ndarray) -> pa.Array:
    return pa.array(points.view(np.int64))


def _points(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def _links(out: list[tuple[int, int]], points: np.ndarray, other: np.ndarray) -> pa.RecordBatch:
    a = np.array([x for x, _ in out], np.int64)
    b = np.array([x for _, x in out], np.int64)
    return pa.RecordBatch.from_arrays([_signed(points[a]), _signed(other[b])], ["a", "b"])


def large_shard_links(placed: DataFrame, sizes: DataFrame, radius: int, how: Shards) -> DataFrame:
    """Links of the shards in `sizes` (shard, n), which are too large for one task.

    All points are compared with a few centers of their shard. What is linked so is one component; only points
    outside the largest of a shard (strays) meet its pieces, strays and all.
    """
    mine = step(placed.join(sizes, "shard"), "large-shards")
    draw = F.xxhash64("shard", "point", F.lit(how.seed))
    # the smallest of each of `centers` parts, so that no shard is ordered as a whole
    centers = (
        mine.withColumn("_draw", draw)
        .groupBy("shard", F.pmod("_draw", F.lit(how.centers)).alias("_part"))
        .agg(F.min_by("point", "_draw").alias("point"))
        .groupBy("shard")
        .agg(F.collect_list("point").alias("centers"))
    )
    near = F.bit_count(F.col("center").bitwiseXOR(F.col("point"))) <= radius
    stars = step(
        mine.join(centers, "shard")
        .select("shard", "point", F.explode("centers").alias("center"))
        .filter(near & (F.col("center") != F.col("point")))
        .select(F.col("point").alias("a"), F.col("center").alias("b"))
        .distinct(),
        "shard-stars",
    )
    labels = components(stars).withColumnRenamed("node", "point")
    labelled = mine.join(labels, "point", "left").select(
        "shard", "point", "n", F.coalesce("component", "point").alias("component")
    )
    largest = (
        labelled.groupBy("shard", "component")
        .agg(F.count(F.lit(1)).alias("_held"))
        .groupBy("shard")
        .agg(F.max_by("component", F.struct("_held", "component")).alias("_largest"))
    )
    pieces = F.ceil(F.col("n") / how.most).cast("int")
    dealt = step(
        labelled.join(largest, "shard").select(
            "shard",
            "point",
            (F.col("component") != F.col("_largest")).alias("stray"),
            pieces.alias("pieces"),
            F.pmod(F.xxhash64("point"), pieces).cast("int").alias("piece"),
        ),
        "shard-pieces",
    )
    wandering = dealt.filter("stray").select(
        "shard", "point", F.col("piece").alias("from"), F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece")
    )
    held = dealt.groupBy("shard", "piece").agg(F.collect_list("point").alias("points"))
    met = (
        wandering.groupBy("shard", "piece", "from").agg(F.collect_list("point").alias("strays")).join(held, ["shard", "piece"])
    )

    def compare(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for strays, points in batches(frames, ["strays", "points"]):
            for some, other in zip(strays, points):
                one, two = _points(some.values), _points(other.values)
                out = [(a, b) for a, b in links_across(one, two, radius) if one[a] != two[b]]
                yield _links(out, one, two)

    across = met.select("strays", "points").mapInArrow(compare, "a bigint, b bigint")
    return stars.unionByName(across)


def links(points: DataFrame, radius: int, how: Shards) -> DataFrame:
    """Links (a, b) that join all points (distinct 64-bit numbers) at most `radius` bits apart."""
    parts = [m - (1 << 64) if m >> 63 else m for m in masks(list(range(64)), radius)]
    shards = F.array(*[F.xxhash64(F.lit(k), F.col("point").bitwiseAND(F.lit(m))) for k, m in enumerate(parts)])
    placed = step(points.select("point", F.explode(shards).alias("shard")), "shards")

    def too_large(rows: DataFrame) -> DataFrame:
        sizes = rows.groupBy("shard").agg(F.count(F.lit(1)).alias("n"))
        return step(sizes.filter(F.col("n") > how.most), "large")

    def inside(rows: DataFrame) -> DataFrame:
        # shards are small in bytes, not in work, so adaptive execution must not put many into one task
        tasks = max(int(points.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
        return (
            rows.repartition(tasks, "shard")
            .groupBy("shard")
            .agg(F.collect_list("point").alias("points"))
            .filter(F.size("points") > 1)
            .select("points")
            .mapInArrow(within, "a bigint, b bigint")
        )

    def within(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (lists,) in batches(frames, ["points"]):
            for some in lists:
                mine = _points(some.values)
                if near := links_among(mine, radius):
                    yield _links(near, mine, mine)

    large = too_large(placed)
    if not large.limit(1).count():
        return inside(placed)
    found = inside(placed.join(large.select("shard"), "shard", "left_anti"))
    cut = cut_by_distance(placed.join(large.select("shard"), "shard"), radius, how)
    larger = too_large(cut)
    found = found.unionByName(inside(cut.join(larger.select("shard"), "shard", "left_anti")))
    if larger.limit(1).count():
        found = found.unionByName(large_shard_links(cut, larger, radius, how))
    return found


def cut_by_distance(placed: DataFrame, radius: int, how: Shards) -> DataFrame:
    """Shards (point, shard), each cut into the shards of a tree."""
    points = placed.select("point").distinct()
    rows = points.orderBy(F.xxhash64("point", F.lit(how.seed))).limit(how.sample).toArrow()
    tree = Tree.fit(_points(rows.column("point").combine_chunks()), radius, how.leaf, how.seed)

    def scatter(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for column, shard in batches(frames, ["point", "shard"]):
            mine = _points(column)
            who, where = tree.place(mine, radius)
            yield pa.RecordBatch.from_arrays(
                [_signed(mine[who]), shard.take(pa.array(who)), pa.array(where.astype(np.int32))], ["point", "shard", "side"]
            )

    cut = placed.select("point", "shard").mapInArrow(scatter, "point bigint, shard bigint, side int")
    return step(cut.select("point", F.xxhash64("shard", "side").alias("shard")), "cut-shards")


def near_fingerprints(docs: DataFrame, radius: int = 4, width: int = 4, how: Shards = Shards()) -> DataFrame:
    """Component of each document: doc_id, fingerprint (64-bit number), component_id (smallest linked doc_id).

    One row per row of `docs`. doc_id must be an integer; other columns than doc_id and text are ignored, whatever their
    names. Texts are taken whole; fewer than `width` words are one shingle. A NULL text, or one without words, has
    fingerprint 0 and is linked like any other. Rows are linked by their own texts, so rows of one doc_id with different texts
    may stand in different components. A row without doc_id links others, but names no component; where no linked row has
    an id, component_id is NULL. An empty table gives no rows.
    """
    batch_limits(docs.sparkSession)

    def sign(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in batches(frames, ["doc_id", "text"]):
            yield pa.RecordBatch.from_arrays([ids, _signed(fingerprints_of(texts, width))], ["doc_id", "point"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = step(rows.mapInArrow(sign, "doc_id bigint, point bigint"), "fingerprints")
    points = step(signed.groupBy("point").agg(F.min("doc_id").alias("first")), "points")
    found = step(links(points.select("point"), radius, how).distinct(), "fingerprint-links")
    labels = components(found)
    known = points.join(labels.withColumnRenamed("node", "point"), "point", "left").select(
        "point", "first", F.coalesce("component", "point").alias("component")
    )
    smallest = known.groupBy("component").agg(F.min("first").alias("component_id"))
    return signed.join(known.join(smallest, "component").select("point", "component_id"), "point").select(
        "doc_id", F.col("point").alias("fingerprint"), "component_id"
    )
