"""The operators over their whole tables, as registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import checks
from .centroids import cluster
from .common import word_array
from .language import held_out, identify, train
from .minhash import near_duplicates
from .mixing import mix_sources
from .neighbours import nearest
from .packing import pack
from .personal_data import KINDS as PERSONAL_KINDS
from .personal_data import find_personal_data
from .quality import judge
from .runs import find_runs
from .secret_scan import KINDS as SECRET_KINDS
from .secret_scan import find_secrets
from .substrings import drop_repeats
from .vantage import near_fingerprints
from .warc import archive_folder, read_archive, write_archive


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _joined(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ","
    )


def _digest_of_spans(found: DataFrame, kinds: tuple[str, ...], base: Column) -> DataFrame:
    """Counts by kind and digest of the base spans, and all spans."""

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(count, kinds),
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.col("found")).alias("spans"),
    )


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mix_sources(_table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(_table(spark, sf_dir, "documents"))
    fixed = SECRET_KINDS[:3]
    return _digest_of_spans(found, fixed, F.filter("found", lambda x: x["kind"].isin(*fixed)))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(_table(spark, sf_dir, "documents")).drop("character_distance", "word_distance")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = drop_repeats(_table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return read_archive(write_archive(pages, archive_folder(pages)))


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(_table(spark, sf_dir, "documents"))
    return _digest_of_spans(found, PERSONAL_KINDS, F.filter("found", lambda x: ~x["hidden"]))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_table(spark, sf_dir, "documents"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = identify(docs, train(docs), spans=False)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = F.sha2(F.concat(F.lit("3:"), F.col("vec_id").cast("string")), 256)
    return cluster(_table(spark, sf_dir, "embeddings"), k=8, rounds=10, order=order)


def _with_periods(docs: DataFrame) -> DataFrame:
    """Documents of which every tenth by its digest goes on in a period from some word on."""
    words, digest = word_array(F.col("text")), F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = docs.select("doc_id", "text", words.alias("words"), digest.alias("h"))
    rows = rows.withColumns({"g": F.floor(F.col("h") / 10), "n": F.size("words").cast("long")})
    rows = rows.withColumn("a", F.col("g") % F.greatest(F.col("n"), F.lit(1)))
    rows = rows.withColumn("p", F.floor((F.col("n") - F.col("a")) / (F.col("g") % 8 + 3)) + 1)
    after = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("n") - F.col("a") - 1, F.lit(0)))
    again = F.concat(
        F.slice("words", 1, F.col("a").cast("int")),
        F.transform(after, lambda i: F.get("words", (F.col("a") + i % F.col("p")).cast("int"))),
    )
    chosen = (F.col("h") % 10 == 0) & (F.col("n") > 0)
    return rows.select("doc_id", F.when(chosen, F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_runs(_with_periods(_table(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = F.col("strongest")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.expr("strongest.length * 1000 div strongest.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_fingerprints(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_mixing,
        op2_secret_scan,
        op3_quality,
        op4_substring_dedup,
        op5_warc,
        op6_personal_data,
        op7_near_dedup,
        op8_nearest,
        op9_packing,
        op10_language,
        op11_centroids,
        op12_runs,
        op13_simhash,
    )
}
CHECKS: dict[str, str] = {name: sql for name, sql in checks.CHECKS.items() if name in QUERIES}
