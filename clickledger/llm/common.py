"""Helpers of the corpus operators: words, Arrow batches and ranks over groups of any size."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import written

# white space that parts words: space and \t \n \v \f \r. It is exactly what bytes.split() parts at.
GAP = r"[\x20\x09-\x0D]+"


def word_array(text: Column) -> Column:
    """The words of a text in order; none for NULL."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def batch_limits(spark: SparkSession) -> None:
    """Bound an Arrow batch by bytes, so that very long texts do not meet in one batch."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def step(df: DataFrame, name: str) -> DataFrame:
    """Write a step to the shared folder and drop the shuffle files it took."""
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key)
    conf.set(key, "true")
    try:
        return written(df, name)
    finally:
        conf.set(key, before)


def raw_texts(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow column as UTF-8; NULL is empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


_RANDOM = np.random.default_rng(20).integers(0, 1 << 63, 257, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FACTOR = 0x9E3779B97F4A7C15
_INVERSE = pow(_FACTOR, -1, 1 << 64)
_IS_GAP = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
_LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)])
_PIECE = 1 << 18


@lru_cache(4)
def _powers(factor: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(np.r_[np.uint64(1), np.full(n, np.uint64(factor))])


class Words:
    """The words of a batch of texts, without a Python object for each.

    `hash`: 64-bit hash of each word's bytes (A-Z as a-z with `lower`); `doc`: number of its text;
    `start`, `end`: its bytes in `data`; `first`: number of the first word of each text, and the number
    of all words.
    """

    def __init__(self, column: pa.Array, lower: bool = False):
        column = column.cast(pa.large_binary())
        texts = len(column)
        offsets = np.frombuffer(column.buffers()[1], np.int64, texts + 1, column.offset * 8)
        low, high = int(offsets[0]), int(offsets[-1])
        self.data = np.frombuffer(column.buffers()[2], np.uint8, high - low, low) if high > low else np.empty(0, np.uint8)
        cuts = offsets - low
        solid = ~_IS_GAP[self.data]
        edge = np.zeros(high - low + 1, bool)
        edge[cuts] = True
        starts = solid.copy()
        starts[1:] &= ~solid[:-1] | edge[1:-1]
        ends = solid
        ends[:-1] &= starts[1:] | _IS_GAP[self.data[1:]]
        self.start, self.end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, cuts)
        self.doc = np.repeat(np.arange(texts), np.diff(self.first))
        self.hash = self._hashes(_RANDOM[:256][_LOWER] if lower else _RANDOM[:256])

    def _hashes(self, values: np.ndarray) -> np.ndarray:
        """Sum of byte values times rising powers, from running sums taken over pieces of the data."""
        out, done = np.empty(len(self.start), np.uint64), 0
        with np.errstate(over="ignore"):
            while done < len(out):
                base = int(self.start[done])
                last = max(done + 1, int(np.searchsorted(self.end, base + _PIECE, "right")))
                stop = int(self.end[last - 1])
                # beyond a piece only a single word without end
                length = _PIECE if stop - base <= _PIECE else stop - base
                up, down = _powers(_FACTOR, length), _powers(_INVERSE, length)
                sums = np.zeros(stop - base + 1, np.uint64)
                np.cumsum(values[self.data[base:stop]] * up[: stop - base], out=sums[1:])
                s, e = self.start[done:last] - base, self.end[done:last] - base
                out[done:last] = mixed((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64) * _RANDOM[256])
                done = last
        return out

    def grams(self, n: int, factor: int) -> np.ndarray:
        """Hash of the `n` words from each word on; 0 where the text ends before."""
        out = np.zeros(len(self.hash), np.uint64)
        if len(out) >= n:
            found = gram_hashes(self.hash, n, factor)
            out[: len(found)] = np.where(self.doc[: len(found)] == self.doc[n - 1 :], found, 0)
        return out


def sliding_min(x: np.ndarray, n: int) -> np.ndarray:
    """Minimum of each `n` consecutive entries."""
    width = 1
    while width < n:
        step = min(width, n - width)
        x = np.minimum(x[:-step], x[step:])
        width += step
    return x


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def gram_hashes(words: np.ndarray, n: int, factor: int) -> np.ndarray:
    """Hash of each run of `n` consecutive words, from the words' hashes."""
    if len(words) < n:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        total, power = np.zeros(len(words) - n + 1, np.uint64), np.uint64(factor)
        for i in range(n):
            total = total * power + words[i : len(words) - n + 1 + i]
        return mixed(total)


def batches(frames: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[list]:
    """Columns by name of each non-empty batch."""
    for frame in frames:
        if frame.num_rows:
            yield [frame.column(frame.schema.get_field_index(n)) for n in names]


def ranked(
    rows: DataFrame,
    group: list[str],
    place: str,
    name: str,
    piece_rows: int = 50_000,
    sizes: Column | None = None,
) -> DataFrame:
    """Number the rows of each group from 1 in the order of `place`, however many rows a group has.

    `place` holds evenly spread text of hex digits (a digest). A group is cut along it into pieces of
    about `piece_rows` rows; each piece is numbered by itself and starts after the pieces before it.
    Only counts by group and piece are gathered. `sizes` is the number of rows of a row's group where it
    is known beforehand; else it is counted and joined. `group` must hold no NULL. Rows with equal
    `place` are numbered in any order.
    """
    part = F.conv(F.substring(place, 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))
    if sizes is None:
        counted = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("_size"))
        sized = rows.join(counted, group)
    else:
        sized = rows.withColumn("_size", sizes)
    pieces = F.ceil(F.col("_size") / piece_rows)
    cut = sized.withColumn("_piece", F.floor(part * pieces).cast("long")).drop("_size")
    before = Window.partitionBy(*group).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        cut.groupBy(*group, "_piece")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(*group, "_piece", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    inside = Window.partitionBy(*group, "_piece").orderBy(place)
    return (
        cut.join(starts, [*group, "_piece"])
        .withColumn(name, F.row_number().over(inside) + F.col("_start"))
        .drop("_piece", "_start")
    )
