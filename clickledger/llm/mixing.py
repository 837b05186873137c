"""Mixing sources to target weights by systematic sampling.

Within a source every document is expected the same number of times, its source's target by its
source's size. These expectations are summed along the source, a random offset is added, and a
document is emitted once for each whole number that its stretch of the sum crosses. The sum runs from
short to long documents, so each stretch of it stands for documents of like size and the words taken
come near the target, not only the number of documents.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ranked, step, word_array

DOC_KEY = ["doc_id", "source", "text"]


def _fraction(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


def source_targets(sizes: DataFrame, weights: Sequence[float], budget: float, most: float) -> DataFrame:
    """Target of each source from its size: rows of `source_key`, `source`, `source_size`, `target`.

    Sources in order of code points, NULL last, take the weights in turn and share `budget` times all
    sizes by weight. A target stops at `most` times its source's size and the excess goes to the
    others by weight, until none is above. That fills all sources to one level per weight, which is
    found from the sources in order of where they stop. `sizes` has a row per source only.
    """
    if budget > most:
        raise ValueError("no mix can take more than every source's limit")
    order = Window.orderBy(F.col("source").asc_nulls_last())
    ways = F.array(*[F.lit(float(w)) for w in weights])
    stops = sizes.withColumn(
        "weight", F.element_at(ways, (F.row_number().over(order) - 1) % len(weights) + 1)
    ).withColumn("stop", F.lit(float(most)) * F.col("source_size"))
    by_stop = Window.orderBy(F.col("stop") / F.col("weight"), F.col("source").asc_nulls_last())
    earlier = by_stop.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(1))
    level = (
        F.lit(float(budget)) * F.sum("source_size").over(everything)
        - F.coalesce(F.sum("stop").over(earlier), F.lit(0.0))
    ) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0)))
    levels = stops.withColumn("level", level)
    # the first source that does not reach its stop sets the level
    open_ = F.col("level") * F.col("weight") <= F.col("stop")
    found = F.min(F.when(open_, F.struct(F.col("stop") / F.col("weight"), F.col("level")))).over(
        everything
    )
    filled = F.when(found.isNull(), F.col("stop")).otherwise(
        F.least(F.col("stop"), found["level"] * F.col("weight"))
    )
    return levels.select("source_key", "source", "source_size", filled.alias("target"))


def mix_sources(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    budget: float = 1.5,
    most: float = 2.0,
    seed: str = "mix",
) -> DataFrame:
    """How often the mix takes each document: one row per row of `docs`.

    Columns: doc_id, source, size (words of the text), source_size, target (words of its source in the
    mix), copies, taken (copies x size), and `row_key`, which identifies equal rows.

    Takes doc_id, source and text of `docs`; other columns are ignored, whatever their names.
    A NULL source is a source of its own. A NULL or empty text has size 0: it costs nothing and is
    drawn like the other documents of its source, but a source whose sizes are all 0 has target 0 and
    is left out. Equal rows are drawn apart. Rows without doc_id take part. An empty table gives no
    rows. Equal input and seed give equal output.
    """
    narrow = docs.select(
        "doc_id",
        "source",
        F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")).alias("source_key"),
        F.size(word_array(F.col("text"))).cast("long").alias("size"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).alias(
            "place"
        ),
        F.concat_ws(":", "doc_id", F.xxhash64(*DOC_KEY), F.hash(*DOC_KEY)).alias("row_key"),
    )
    rows = step(narrow, "mix-sizes")
    lengths = step(
        rows.groupBy("source_key", "source", "size").agg(F.count(F.lit(1)).alias("n")), "mix-lengths"
    )
    sizes = lengths.groupBy("source_key", "source").agg(
        F.sum(F.col("n") * F.col("size")).alias("source_size")
    )
    targets = source_targets(sizes, weights, budget, most)
    shorter = (
        Window.partitionBy("source_key").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    )
    ahead = lengths.select(
        "source_key", "size", F.coalesce(F.sum("n").over(shorter), F.lit(0)).alias("ahead")
    )
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    per_length = ahead.join(
        targets.select("source_key", "source_size", "target", rate.alias("rate")), "source_key"
    )
    placed = ranked(rows, ["source_key", "size"], "place", "nth").join(
        per_length, ["source_key", "size"]
    )
    upto = F.col("nth") + F.col("ahead")
    offset = _fraction(F.md5(F.concat(F.lit(f"{seed}/"), F.col("source_key"))))
    crossed = F.floor(upto * F.col("rate") + offset) - F.floor((upto - 1) * F.col("rate") + offset)
    # rounding of long sums must not add a copy
    copies = F.least(crossed, F.ceil("rate")).cast("long")
    return placed.select(
        "doc_id",
        "source",
        "size",
        F.col("source_size").cast("long").alias("source_size"),
        "target",
        copies.alias("copies"),
        (copies * F.col("size")).alias("taken"),
        "row_key",
    )


def emit(docs: DataFrame, mix: DataFrame) -> DataFrame:
    """The rows of `docs` as often as the mix takes them, with the columns of `docs`."""
    copies = mix.groupBy("row_key").agg(F.sum("copies").cast("int").alias("copies"))
    keyed = docs.select(
        F.struct("*").alias("doc"),
        F.concat_ws(":", "doc_id", F.xxhash64(*DOC_KEY), F.hash(*DOC_KEY)).alias("row_key"),
    )
    met = keyed.join(copies.filter("copies > 0"), "row_key")
    # equal rows share a key and its copies: one of them stands for all
    one = met.withColumn("nth", F.row_number().over(Window.partitionBy("row_key").orderBy("row_key")))
    return (
        one.filter("nth = 1")
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        .select("doc.*")
    )
