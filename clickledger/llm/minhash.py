"""Near-duplicate documents by min-max hashing.

A document is its set of shingles, runs of `width` words: pairs, unless the caller asks for longer ones. Each
hash function permutes all shingles; a signature keeps both the smallest and the largest under it, so `2 * functions` values cost one evaluation each pair and
function. Each value agrees between two documents with the chance of their Jaccard similarity. The
values are cut in bands; documents that agree on a whole band meet in a bucket. With the defaults (32
bands of 5) a pair at similarity 0.8 meets in none with a chance of 3e-6, higher ones with less.

Every link is confirmed on the full sets. Buckets are not paired out. Equal sets are one class first;
then the members of a bucket are compared with its first member, and what is linked so becomes one
component. Only buckets in which two components are left are looked at again: their texts meet in
blocks of bounded size, where an index of the blocks' shingles gives the exact similarity of members
of different components.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, batch_limits, batches, mixed, step
from .components import components

_PAIR, _ALONE = 0xC2B2AE3D27D4EB4F, np.uint64(0x165667B19E3779F9)


@dataclass(frozen=True)
class Bands:
    bands: int = 32
    rows: int = 5
    seed: int = 7

    def functions(self) -> tuple[np.ndarray, np.ndarray]:
        n = -(-self.bands * self.rows // 2)
        draw = np.random.default_rng(self.seed).integers(0, 1 << 63, (2, n), dtype=np.uint64)
        return draw[0] * np.uint64(2) + np.uint64(1), draw[1]


def shingles(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of `width` words of all texts, A-Z as a-z, and the place where each text's begin.

    A text of fewer words has all of them as its only entry.
    """
    words = Words(texts, lower=True)
    sizes = np.diff(words.first)
    runs = words.grams(width, _PAIR)
    # no run starts at the last words of a text
    keep = words.first[1:][words.doc] - np.arange(len(runs)) >= width
    for n in range(1, width):
        short = words.first[:-1][sizes == n]
        if len(short):
            runs[short] = mixed(words.hash[short] ^ _ALONE) if n == 1 else words.grams(n, _PAIR)[short]
            keep[short] = True
    return runs[keep], np.r_[0, np.cumsum(np.where(sizes < width, np.minimum(sizes, 1), sizes - width + 1))]


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        total = np.r_[np.uint64(0), np.cumsum(values)]
        return total[first[1:]] - total[first[:-1]]


def signatures(docs: DataFrame, how: Bands, width: int) -> DataFrame:
    """Rows of doc_id, n_shingles, set_1 and set_2 (hash of the set), and the hashes of its bands."""

    def sign(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors, shifts = how.functions()
        for ids, texts in batches(frames, ["doc_id", "text"]):
            pairs, first = shingles(texts, width)
            distinct = [np.unique(pairs[a:b]) for a, b in zip(first, first[1:])]
            sizes = np.array([len(d) for d in distinct], np.int64)
            pairs, first = np.concatenate([*distinct, np.empty(0, np.uint64)]), np.r_[0, np.cumsum(sizes)]
            some = np.flatnonzero(sizes)
            values = np.empty((2 * len(factors), len(some)), np.uint64)
            with np.errstate(over="ignore"):
                if len(some):
                    for k, (factor, shift) in enumerate(zip(factors, shifts)):
                        permuted = pairs * factor + shift
                        values[k] = np.minimum.reduceat(permuted, first[some])
                        values[len(factors) + k] = np.maximum.reduceat(permuted, first[some])
                bands = np.empty((len(some), how.bands), np.uint64)
                for band in range(how.bands):
                    total = np.full(len(some), band + 1, np.uint64)
                    for row in range(how.rows):
                        total = mixed(total + values[band + row * how.bands])
                    bands[:, band] = total
            counts = np.where(sizes > 0, how.bands, 0)
            lists = pa.ListArray.from_arrays(
                pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32)), pa.array(bands.ravel().view(np.int64))
            )
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array(sizes),
                    pa.array(_sums(mixed(pairs), first).view(np.int64)),
                    pa.array(_sums(mixed(pairs ^ _ALONE), first).view(np.int64)),
                    lists,
                ],
                ["doc_id", "n_shingles", "set_1", "set_2", "bands"],
            )

    return docs.mapInArrow(
        sign, "doc_id bigint, n_shingles bigint, set_1 bigint, set_2 bigint, bands array<bigint>"
    )


def confirmed(pairs: DataFrame, docs: DataFrame, percent: int, width: int) -> DataFrame:
    """The pairs (a, b) whose full sets have a similarity of `percent` or more."""

    def compare(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for a, b, left, right in batches(frames, ["a", "b", "left", "right"]):
            (x, at), (y, to) = shingles(left, width), shingles(right, width)
            good = np.zeros(len(a), bool)
            last, other = None, None
            for i in range(len(a)):
                if b[i] != last:
                    last, other = b[i], np.unique(y[to[i] : to[i + 1]])
                one = np.unique(x[at[i] : at[i + 1]])
                both = len(np.intersect1d(one, other, assume_unique=True))
                good[i] = both > 0 and 100 * both >= percent * (len(one) + len(other) - both)
            pick = pa.array(np.flatnonzero(good))
            yield pa.RecordBatch.from_arrays([a.take(pick), b.take(pick)], ["a", "b"])

    left = docs.select(F.col("doc_id").alias("a"), F.col("text").alias("left"))
    right = docs.select(F.col("doc_id").alias("b"), F.col("text").alias("right"))
    met = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")
    return met.mapInArrow(compare, "a bigint, b bigint")


def _union(parent: dict[int, int], x: int) -> int:
    while parent[x] != x:
        parent[x] = x = parent[parent[x]]
    return x


def block_links(sets: list[np.ndarray], groups: list[int], sides: list[int], percent: int) -> list[tuple[int, int]]:
    """Links between sets of different groups, as places; groups that are linked become one.

    `sides`: 0 or 1; where both occur, only sets of different sides are compared.
    """
    sizes = np.array([len(x) for x in sets])
    _, entry = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(entry, kind="stable")
    listed, first = owner[order], np.r_[0, np.cumsum(np.bincount(entry))]
    begin = np.r_[0, np.cumsum(sizes)]
    parent = {g: g for g in groups}
    own, side = np.array(groups), np.array(sides)
    both_sides = len(set(sides)) > 1
    values, counts = np.unique(own, return_counts=True)
    largest = values[np.argmax(counts)]
    found = []
    for k in np.flatnonzero((own != largest) & (sizes > 0)):
        mine = entry[begin[k] : begin[k + 1]]
        spans = first[mine + 1] - first[mine]
        at = np.repeat(first[mine] - np.r_[0, np.cumsum(spans)[:-1]], spans) + np.arange(spans.sum())
        common = np.bincount(listed[at], minlength=len(sets))
        good = (100 * common >= percent * (sizes + sizes[k] - common)) & (common > 0) & (own != own[k])
        if both_sides:
            good &= side != side[k]
        for other in np.flatnonzero(good):
            x, y = _union(parent, int(own[k])), _union(parent, int(own[other]))
            if x != y:
                parent[max(x, y)] = min(x, y)
                found.append((int(k), int(other)))
    return found


def bucket_pieces(placed: DataFrame, block: int) -> DataFrame:
    """Buckets of more than one component: band, largest (component), pieces, stray_pieces."""
    weights = placed.groupBy("band", "component").agg(F.sum("n_shingles").alias("weight"))
    return (
        weights.groupBy("band")
        .agg(
            F.count(F.lit(1)).alias("components"),
            F.max_by("component", F.struct("weight", "component")).alias("largest"),
            F.sum("weight").alias("all"),
            F.max("weight").alias("most"),
        )
        .filter("components > 1")
        .select(
            "band",
            "largest",
            F.ceil(F.col("all") / block).cast("int").alias("pieces"),
            F.greatest(F.ceil((F.col("all") - F.col("most")) / block), F.lit(1)).cast("int").alias("stray_pieces"),
        )
    )


def deal(placed: DataFrame, split: DataFrame) -> DataFrame:
    """Rows of band, piece, stray_piece, side (1 for strays that visit), doc_id and component."""
    known = placed.join(split, "band")
    held = known.select(
        "band",
        F.pmod(F.xxhash64("doc_id"), F.col("pieces")).cast("int").alias("piece"),
        F.explode(F.sequence(F.lit(0), F.col("stray_pieces") - 1)).alias("stray_piece"),
        F.lit(0).alias("side"),
        "doc_id",
        "component",
    )
    visiting = known.filter("component <> largest").select(
        "band",
        F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"),
        F.pmod(F.xxhash64("doc_id", F.lit(1)), F.col("stray_pieces")).cast("int").alias("stray_piece"),
        F.lit(1).alias("side"),
        "doc_id",
        "component",
    )
    return held.unionByName(visiting)


def links_within(
    members: DataFrame, labels: DataFrame, docs: DataFrame, percent: int, block: int, width: int
) -> DataFrame:
    """Links (a, b) between members of a bucket that are still in different components.

    A bucket is cut in pieces of about `block` shingles. Only its strays, the members outside its largest component, meet
    all of them, as strays of about `block` shingles at a time; all others stay in their piece.
    """
    placed = (
        members.filter("doc_id <> center")
        .join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        .select("band", "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component"))
    )
    split = bucket_pieces(placed, block)
    dealt = deal(placed, split)
    blocks = (
        dealt.join(docs.select("doc_id", "text"), "doc_id")
        .groupBy("band", "piece", "stray_piece")
        .agg(F.collect_list(F.struct("doc_id", "component", "side", "text")).alias("members"))
        .select("members")
    )

    def compare(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (rows,) in batches(frames, ["members"]):
            a, b = [], []
            for row in rows:
                block = row.values
                ids, groups, sides = (block.field(k).to_pylist() for k in ("doc_id", "component", "side"))
                pairs, first = shingles(block.field("text"), width)
                sets = [np.unique(pairs[x:y]) for x, y in zip(first, first[1:])]
                for x, y in block_links(sets, groups, sides, percent):
                    a.append(ids[x])
                    b.append(ids[y])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return blocks.mapInArrow(compare, "a bigint, b bigint").distinct()


def near_duplicates(
    docs: DataFrame, percent: int = 80, how: Bands = Bands(), block: int = 1_000_000, width: int = 2
) -> DataFrame:
    """Component of each document: doc_id, n_shingles, component_id (smallest linked doc_id), kept.

    One row per row of `docs`. Sets hold shingles of `width` words. doc_id must be an integer; other columns
    than doc_id and text are ignored, whatever their names. Texts are taken whole. A NULL text, or one without words, has an
    empty set and is linked with nothing. Rows of one doc_id are one document given again (one text)
    and get the same result. A row without doc_id is not compared: component_id is NULL, kept is true.
    An empty table gives no rows.
    """
    batch_limits(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = step(signatures(texts, how, width), "minmax-signatures")
    known = signed.filter("doc_id IS NOT NULL")
    same = (
        known.filter("n_shingles > 0").groupBy("set_1", "set_2").agg(F.min("doc_id").alias("class_id"))
    )
    classes = step(
        signed.join(same, ["set_1", "set_2"], "left").select(
            "doc_id",
            "n_shingles",
            F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id")).alias("class_id"),
            F.when(F.col("doc_id") == F.col("class_id"), F.col("bands")).alias("bands"),
        ),
        "minmax-classes",
    )
    # one document per class; given again it has the same bands
    banded = classes.filter("bands IS NOT NULL").select("doc_id", "n_shingles", F.explode("bands").alias("band"))
    centers = (
        banded.groupBy("band")
        .agg(F.min("doc_id").alias("center"), F.max("doc_id").alias("last"))
        .filter("center < last")
        .drop("last")
    )
    members = step(banded.join(centers, "band"), "minmax-members")
    real = texts.filter("doc_id IS NOT NULL")
    stars = members.filter("doc_id > center").select(F.col("doc_id").alias("a"), F.col("center").alias("b"))
    links = step(confirmed(stars.distinct(), real, percent, width), "minmax-links")
    labels = components(links)
    more = step(links_within(members, labels, real, percent, block, width), "minmax-links")
    labels = components(links.union(more))
    return (
        classes.join(labels.withColumnRenamed("node", "class_id"), "class_id", "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "class_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )
