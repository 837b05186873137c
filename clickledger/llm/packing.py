"""Packing into length buckets with the least padding.

Documents are cut into pieces of at most `longest` words, so there are at most that many lengths. Their
histogram over all pieces is the whole input of the choice: dynamic programming finds the bucket bounds
for which padding every piece to its bucket's bound wastes least. Inside a bucket, batches take as many
pieces as fit the token budget at the bound.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ranked, step, word_array


@dataclass(frozen=True)
class Shape:
    """Longest piece in words, number of buckets, and padded words of a batch."""

    longest: int = 2048
    buckets: int = 12
    budget: int = 65_536


def best_bounds(histogram: dict[int, int], buckets: int) -> list[int]:
    """Upper bounds of at most `buckets` length ranges with the least padding; the last is the longest.

    waste(i, j) of the lengths after the i-th up to the j-th is bound_j * (count_j - count_i) minus their
    words. For each number of buckets the best cut moves only forward as j grows, so each layer is
    solved by halving.
    """
    lengths = np.array(sorted(histogram), np.int64)
    if not len(lengths):
        return []
    counts = np.r_[0, np.cumsum([histogram[int(x)] for x in lengths])]
    words = np.r_[0, np.cumsum([histogram[int(x)] * int(x) for x in lengths])]
    n, layers = len(lengths), min(buckets, len(lengths))

    def waste(i: np.ndarray, j: int) -> np.ndarray:
        return lengths[j - 1] * (counts[j] - counts[i]) - (words[j] - words[i])

    least = [int(waste(np.array(0), j)) if j else 0 for j in range(n + 1)]
    cuts = []
    for k in range(2, layers + 1):
        before, least, cut = np.array(least), [0] * (n + 1), [0] * (n + 1)
        todo = [(k, n, k - 1, n - 1)]
        while todo:
            low, high, first, last = todo.pop()
            if low > high:
                continue
            j = (low + high) // 2
            options = np.arange(first, min(last, j - 1) + 1)
            costs = before[options] + waste(options, j)
            at = int(np.argmin(costs))
            least[j], cut[j] = int(costs[at]), int(options[at])
            todo += [(low, j - 1, first, cut[j]), (j + 1, high, cut[j], last)]
        cuts.append(cut)
    bounds, j = [], n
    for cut in reversed(cuts):
        bounds.append(int(lengths[j - 1]))
        j = cut[j]
    bounds.append(int(lengths[j - 1]))
    return bounds[::-1]


def pack(docs: DataFrame, shape: Shape = Shape(), with_text: bool = False) -> DataFrame:
    """Pieces of documents in batches: doc_id, piece (from 0), n_words, bound (padded length of its
    bucket), batch (number in its bucket, from 0), slot (place in its batch, from 0); with `with_text`
    also text, the piece's words joined by one space.

    Every word is in exactly one piece. A NULL or empty text gives one piece of 0 words without bound,
    batch and slot, as there is nothing to pad. Rows that repeat, and rows without doc_id, are packed
    like any other. Other columns than doc_id and text are ignored, whatever their names. An empty
    table gives no rows. Equal input gives equal batches, up to rows that are equal in doc_id.

    The histogram has at most `longest` rows; it is all that reaches the driver.
    """
    words = word_array(F.col("text"))
    texts = docs.select("doc_id", words.alias("words"))
    number = F.greatest(F.ceil(F.size("words") / shape.longest), F.lit(1)).cast("int")
    pieces = texts.select(
        "doc_id", "words", F.explode(F.sequence(F.lit(0), number - 1)).alias("piece")
    )
    part = F.slice("words", F.col("piece") * shape.longest + 1, shape.longest)
    text = [F.array_join(part, " ").alias("text")] if with_text else []
    length = F.least(F.lit(shape.longest), F.size("words") - F.col("piece") * shape.longest)
    place = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "piece"))
    rows = step(
        pieces.select("doc_id", "piece", length.cast("long").alias("n_words"), place.alias("place"), *text),
        "packing-pieces",
    )
    counted = rows.filter("n_words > 0").groupBy("n_words").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r["n_words"]: r["n"] for r in counted.collect()}
    bounds = best_bounds(histogram, shape.buckets)
    limits = F.array(*map(F.lit, bounds)).cast("array<bigint>")
    bound = F.element_at(F.filter(limits, lambda b: b >= F.col("n_words")), 1) if bounds else F.lit(None).cast("long")
    filled = rows.filter("n_words > 0").withColumn("bound", bound)
    per_batch = F.greatest(F.floor(F.lit(shape.budget) / F.col("bound")), F.lit(1))
    nth = F.col("nth") - 1
    more = ["text"] if with_text else []
    sizes = F.lit(0).cast("long")
    for low, high in zip([0, *bounds], bounds):
        held = sum(n for size, n in histogram.items() if low < size <= high)
        sizes = F.when(F.col("bound") == high, F.lit(held)).otherwise(sizes)
    batched = ranked(filled, ["bound"], "place", "nth", 10_000, sizes).select(
        "doc_id",
        "piece",
        "n_words",
        "bound",
        F.floor(nth / per_batch).cast("long").alias("batch"),
        (nth % per_batch).cast("long").alias("slot"),
        *more,
    )
    nothing = F.lit(None).cast("long")
    empty = rows.filter("n_words = 0").select(
        "doc_id", "piece", "n_words", nothing.alias("bound"), nothing.alias("batch"), nothing.alias("slot"), *more
    )
    return batched.unionByName(empty)
