"""Warehouse tables in the session catalog: reads, rebuilds, swaps, slices and the load audit."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_query(spark: SparkSession, sql: str) -> DataFrame:
    """The result of a query over warehouse tables."""
    return spark.sql(sql)


def read_jdbc(
    spark: SparkSession,
    url: str,
    query: str,
    column: str,
    lower: str,
    upper: str,
    partitions: int,
    **options: str,
) -> DataFrame:
    """A query's result from a database, read in ranges of one column by many tasks."""
    return (
        spark.read.format("jdbc")
        .options(
            url=url,
            dbtable=f"({query}) q",
            partitionColumn=column,
            lowerBound=lower,
            upperBound=upper,
            numPartitions=str(partitions),
            **options,
        )
        .load()
    )


def rebuild(df: DataFrame, table: str, partition_by: list[str] | None = None) -> None:
    """Drop and create as select. The rows must not come from the table itself; see `swap_in`."""
    writer = df.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)


def swap_in(df: DataFrame, table: str, partition_by: list[str] | None = None) -> None:
    """Replace a table by rows that may be computed from it.

    The name is a view over a numbered version. A new version is complete on disk before one statement points the view to it, so
    a reader finds the old content or the new one at any time, and a run that dies leaves the old one. The version before stays for readers
    that have begun; older ones, and versions that no run finished, go. A plain table of that name becomes the first version.
    """
    spark = df.sparkSession
    recover(spark, table)
    current, known = _current_version(spark, table), _versions(spark, table)
    new = _new_version(table, known)
    rebuild(df, new, partition_by)
    if current is None and spark.catalog.tableExists(table):
        # dies a run between these two statements, `recover` points the name to the new version
        current = _new_version(table, [])
        spark.sql(f"ALTER TABLE {table} RENAME TO {current}")
    _point(spark, table, new)
    for old in known:
        if old != current:
            spark.sql(f"DROP TABLE IF EXISTS {old}")


def _new_version(table: str, known: list[str]) -> str:
    """A numbered name; files that a failed run left under an unfinished one are in nobody's way."""
    number = max([_number(v) for v in known], default=0) + 1
    return f"{table}__v{number}_{uuid.uuid4().hex[:8]}"


def _number(version: str) -> int:
    return int(version.rsplit("__v", 1)[1].split("_")[0])


def _versions(spark: SparkSession, table: str) -> list[str]:
    """All finished versions, the oldest first; the catalog knows a version only when it is complete."""
    *base, name = table.split(".")
    found = spark.sql(f"SHOW TABLES{f' IN {base[0]}' if base else ''} LIKE '{name}__v*'").collect()
    return sorted((".".join([*base, r["tableName"]]) for r in found), key=_number)


def _current_version(spark: SparkSession, table: str) -> str | None:
    """The version that readers see; None for a plain table."""
    if not spark.catalog.tableExists(table):
        return None
    text = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'View Text'").first()
    return text["data_type"].rsplit(" ", 1)[-1] if text else None


def _point(spark: SparkSession, table: str, version: str) -> None:
    spark.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM {version}")


def recover(spark: SparkSession, table: str) -> None:
    """Point a name that has lost its view to its newest finished version."""
    known = _versions(spark, table)
    if known and not spark.catalog.tableExists(table):
        _point(spark, table, known[-1])


def drop_versions(spark: SparkSession, table: str) -> None:
    """Remove a published table with all its versions."""
    spark.sql(f"DROP VIEW IF EXISTS {table}")
    for version in _versions(spark, table):
        spark.sql(f"DROP TABLE IF EXISTS {version}")


def write_slice(df: DataFrame, table: str, column: str, value: str) -> None:
    """Replace one partition, such as one kind of fact, by the rows with that value.

    An empty stage clears it; other partitions stay as they are.
    """
    spark = df.sparkSession
    names = [c for c in spark.table(table).columns if c != column]
    rows = df.filter(F.col(column) == value).select(*names)
    quoted = value.replace("'", "\\'")
    spark.sql(
        f"INSERT OVERWRITE TABLE {table} PARTITION ({column} = '{quoted}') SELECT * FROM {{rows}}", rows=rows
    )


def snapshot(df: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """Rows stamped with their load time, as dashboards get them."""
    return df.withColumn("loaded_at", F.current_timestamp() if loaded_at is None else loaded_at)


AUDIT_SCHEMA = (
    "event_type string, event_category string, event_text string, is_error int, rows_processed long, "
    "is_etl int, rs_table string, stack_trace string, error_message string"
)


def publish(jobs: dict[str, Callable[[], DataFrame]], spark: SparkSession) -> DataFrame:
    """Publish each job's snapshot as a table of its name; one audit row per table, errors included.

    Rows are counted while they are written. An error in one table leaves the others alone.
    """
    category = "Realtime Push"
    audit = []
    for table, job in jobs.items():
        seen = Observation()
        try:
            rows = snapshot(job()).observe(seen, F.count(F.lit(1)).alias("n"))
            swap_in(rows, table)
            audit.append(("event", category, f"{category} ", 0, seen.get["n"], 1, table, "na", "na"))
        except Exception as error:
            audit.append(
                ("error", category, f"{category} Error", 1, 0, 1, table, repr(error), str(error))
            )
    return spark.createDataFrame(audit, AUDIT_SCHEMA)


def ensure_table(spark: SparkSession, table: str, schema: T.StructType | str, partition_by: list[str]) -> None:
    """An empty partitioned table, unless it is there."""
    if not spark.catalog.tableExists(table):
        empty = spark.createDataFrame([], schema)
        empty.write.format("parquet").option("compression", "zstd").partitionBy(*partition_by).saveAsTable(table)


# Fixed value: files that a task keeps open at once.
OPEN_FILES = 64


def overwrite_partitions(df: DataFrame, table: str, gather: bool = True) -> None:
    """Replace the partitions that the rows fall in; others stay. Rows may come from the table: files are replaced when all are written.

    A run that is repeated after a failure overwrites what it left. Without `gather` the rows are not shuffled by partition first, so
    each task leaves a file in each partition that it has rows of; it keeps up to OPEN_FILES of them open and sorts only what falls in
    others.
    """
    spark = df.sparkSession
    parts = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    # few files for a small partition, several tasks for a large one
    rows = df.select(*spark.table(table).columns)
    if gather:
        rows = rows.hint("rebalance", *parts)
    settings = {
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.maxConcurrentOutputFileWriters": str(0 if gather else OPEN_FILES),
    }
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        rows.write.insertInto(table, overwrite=True)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def _partition_spec(values: dict[str, object]) -> str:
    return ", ".join(
        f"{name} = " + ("NULL" if value is None else "'" + str(value).replace("'", "\\'") + "'")
        for name, value in values.items()
    )


def drop_partitions(spark: SparkSession, table: str, partitions: list[dict[str, object]]) -> None:
    """Clear partitions, such as days of which nothing is left."""
    if partitions:
        specs = ", ".join(f"PARTITION ({_partition_spec(p)})" for p in partitions)
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {specs}")
