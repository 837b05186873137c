from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def one_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key by `order` (NULL placement is the caller's: use asc_nulls_last ...).

    Spark puts a group limit before the shuffle for this shape, so each task sends at most one row
    per key, however many copies a key has.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")
