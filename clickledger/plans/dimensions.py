"""Vertical and place dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import to_int_code
from ..operators.dedupe import one_per_key
from ..operators.loads import unseen
from ..operators.skew import union_all
from ..rules.ladder import mapped, rolled_up

# Kinds of job, and what a vertical belongs to.
JOB_TYPES = ["other", "labour", "material", "service"]
CATEGORIES = {
    "interior_colouring": ["painting", "wallpapering", "lacquering"],
    "exterior_colouring": ["exterior_painting", "scaffolding", "paint_outside_items"],
    "non_parquet_flooring": ["laminate", "carpet", "pvc", "vinyl"],
    "parquet": ["parquet"],
    "plastering": ["exterior_plastering", "plastering"],
    "tiling": ["tiling", "wall_tiling", "floor_tiling"],
    "dry_walling": ["constructional_plastering"],
}
WALLS = [
    *CATEGORIES["plastering"],
    *CATEGORIES["dry_walling"],
    *CATEGORIES["tiling"],
    *CATEGORIES["interior_colouring"],
    *CATEGORIES["exterior_colouring"],
]
FLOORS = ["parquet", *CATEGORIES["non_parquet_flooring"]]
REGIONS = {"de": "dach", "at": "dach", "ch": "dach", "nl": "benelux", "be": "benelux", "us": "usa"}


def vertical_cross(verticals: DataFrame) -> DataFrame:
    """Every vertical with each of the four job types, made by exploding the fixed list."""
    jobs = F.posexplode(F.array(*[F.lit(j) for j in JOB_TYPES])).alias("job_type_id", "job_type")
    return verticals.select("id", "name", "area_type_id", jobs).select(
        (F.col("id") * 10 + F.col("job_type_id")).cast("long").alias("vertical_type_id"),
        F.col("id").alias("vertical_id"),
        F.col("name").alias("vertical"),
        "job_type_id",
        "job_type",
        "area_type_id",
        F.lit(True).alias("is_valid_vertical"),
    )


def vertical_dim(verticals: DataFrame, names: list[DataFrame]) -> DataFrame:
    """Verticals with job types, plus names seen elsewhere, one (the shortest name) per id."""
    seen = union_all([n.toDF("vertical") for n in names]).distinct()
    observed = seen.select(
        to_int_code(F.col("vertical"), 4).alias("vertical_type_id"),
        F.lit(0).alias("vertical_id"),
        F.when(F.col("vertical").like("varn%"), "lacquering")
        .otherwise(F.col("vertical"))
        .alias("vertical"),
        F.lit(0).alias("job_type_id"),
        F.lit("na").alias("job_type"),
        F.lit(0).alias("area_type_id"),
        F.lit(False).alias("is_valid_vertical"),
    )
    name = F.col("vertical")
    rows = vertical_cross(verticals).unionByName(observed).withColumns(
        {
            "category": rolled_up(name, CATEGORIES, "other"),
            "surface_type": F.when(name.isin(WALLS) | name.like("paint%"), "wall")
            .when(name.isin(FLOORS) | name.like("floor%"), "floor")
            .otherwise("other"),
            "bin_valid_vertical": F.col("is_valid_vertical").cast("int"),
        }
    )
    best = one_per_key(
        rows,
        ["vertical_type_id"],
        [F.length("vertical").asc_nulls_last(), name.asc_nulls_last(), F.col("vertical_id").asc()],
    )
    dummies = rows.sparkSession.createDataFrame(
        [
            (1, 0, "na", 0, "0", 0, "na", "na", False, 0),
            (2, None, "mixed", 0, "0", 0, "mixed", "mixed", False, 0),
        ],
        "vertical_type_id long, vertical_id int, vertical string, job_type_id int, job_type string, "
        "area_type_id int, category string, surface_type string, is_valid_vertical boolean, "
        "bin_valid_vertical int",
    )
    return best.unionByName(dummies)


def geo_feed(country, city) -> list:
    return [
        F.trim(F.lower(F.coalesce(country, F.lit("")))).alias("country"),
        F.trim(F.lower(F.coalesce(city, F.lit("")))).alias("city"),
    ]


def geo_dim(feeds: list[DataFrame], known: DataFrame | None = None) -> DataFrame:
    """One row per place of all (country, city) feeds, with its region.

    Without `known` the dimension is rebuilt and gets its 'na' row; with it only new places return.
    """
    # distinct per feed first, so that frequent places leave each task once
    places = union_all([feed.distinct() for feed in feeds]).select(
        F.trim(F.lower(F.concat("country", "city"))).alias("geo_id"),
        mapped(F.col("country"), REGIONS, "other").alias("region"),
        "country",
        "city",
    )
    if known is not None:
        places = unseen(places, known, "geo_id")
    rows = one_per_key(places, ["geo_id"], [F.col("country").asc(), F.col("city").asc()]).withColumn(
        "is_active_region", F.col("region").isin("dach", "benelux").cast("int")
    )
    if known is not None:
        return rows
    dummy = rows.sparkSession.createDataFrame([("na", "na", "na", "na", 0)], rows.schema)
    return rows.unionByName(dummy)
