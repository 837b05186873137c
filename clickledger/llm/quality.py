"""Quality rules: repetition counts, and divergence from what a language normally looks like.

Two histograms describe a text: its characters by class, and its words by a list of common words of
its language (all others count as one more bin). Each is compared with the mean histogram of all
documents of that language by the Jensen-Shannon distance (base 2, 0 to 1). Short texts have noisy
histograms: below a minimum length a comparison is not made, and above it the distance that chance
alone brings is taken off first. Everything is DataFrame functions on one row at a time; the only
shuffle is the one row per language of the references.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import step, word_array

# fixed values: the most common words of each language
COMMON_WORDS = {
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "auf", "ist"],
    "en": ["the", "of", "and", "to", "a", "in", "is", "that", "for", "with", "was", "on"],
    "es": ["de", "la", "que", "el", "en", "y", "los", "se", "del", "las", "un", "por"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est"],
}
ANY = "*"
# characters of each class are what is left when all others are removed; the rest is one more class
CHARACTER_CLASSES = {
    "space": r"[^\x20\x09-\x0D]+",
    "capital": r"[^A-Z]+",
    "digit": r"[^0-9]+",
    "stop": r"""[^.,;:!?'"()-]+""",
    "sign": r"[^#$%&*+/<=>@\[\]\\^_`{|}~]+",
    "beyond_ascii": r"[\x00-\x7F]+",
}
SYMBOLS = r"[^#*$%&|<>]+"


@dataclass(frozen=True)
class Rules:
    """Limits of the verdict. A distance is judged from its minimum length on."""

    common_words: Mapping[str, Sequence[str]] = field(default_factory=lambda: COMMON_WORDS)
    min_characters: int = 150
    min_words: int = 100
    max_character_distance: float = 0.26
    max_word_distance: float = 0.24


def _left(text: str, pattern: str) -> Column:
    return F.length(F.regexp_replace(text, pattern, "")).cast("long")


def _word_lists(rules: Rules) -> dict[str, list[str]]:
    """Common words by language, each once; for other languages the first three of every listed one."""
    lists = {name: list(dict.fromkeys(words)) for name, words in rules.common_words.items()}
    return {ANY: list(dict.fromkeys(w for words in lists.values() for w in words[:3])), **lists}


def measured(docs: DataFrame, rules: Rules) -> DataFrame:
    """Counts and histograms, one row per document."""
    lists = _word_lists(rules)
    common = reduce(
        lambda rest, name: F.when(F.col("language") == name, F.array(*map(F.lit, lists[name]))).otherwise(rest),
        rules.common_words,
        F.array(*map(F.lit, lists[ANY])),
    )
    known = F.col("lang").isin(*rules.common_words)
    texts = docs.select(
        "doc_id",
        F.when(known, F.col("lang")).otherwise(ANY).alias("language"),
        F.coalesce("text", F.lit("")).alias("text"),
        word_array(F.col("text")).alias("words"),
    )
    size = F.size("words")
    # a window of five words counts by its hash; a document is far too small for two to collide
    starts = F.when(size >= 5, F.sequence(F.lit(0), size - 5)).otherwise(F.array().cast("array<int>"))
    lines = F.filter(F.split("text", "\n"), lambda line: F.rlike(line, F.lit(r"[^\x20\x09-\x0D]")))
    frequent = F.filter("words", lambda w: F.array_contains("common", w))
    counted = texts.withColumn("common", common).select(
        "doc_id",
        "language",
        size.cast("long").alias("n_words"),
        F.length("text").cast("long").alias("n_chars"),
        *[_left("text", pattern).alias(name) for name, pattern in CHARACTER_CLASSES.items()],
        _left("text", SYMBOLS).alias("n_symbols"),
        lines.alias("lines"),
        F.transform(starts, lambda i: F.xxhash64(*[F.get("words", i + k) for k in range(5)])).alias("windows"),
        frequent.alias("frequent"),
        "common",
    )
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    sorted_ = counted.select(
        "doc_id",
        "language",
        "n_words",
        (F.col("n_chars") - F.col("space")).alias("word_chars"),
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "n_chars",
        F.array(
            *CHARACTER_CLASSES,
            reduce(lambda a, b: a - b, map(F.col, CHARACTER_CLASSES), F.col("n_chars")),
        ).alias("characters"),
        F.concat(
            F.transform("common", lambda w: F.size(F.filter("frequent", lambda x: x == w)).cast("long")),
            F.array(F.col("n_words") - F.size("frequent")),
        ).alias("common_counts"),
        F.when(F.size(F.array_distinct("windows")) == F.size("windows"), none)
        .otherwise(F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
        .alias("by_hash"),
    )

    def again(x: Column, k: Column) -> Column:
        last, next_ = F.get("by_hash", k - 1)["h"], F.get("by_hash", k + 1)["h"]
        return F.coalesce(last == x["h"], F.lit(False)) | F.coalesce(next_ == x["h"], F.lit(False))

    repeated = sorted_.withColumn(
        "repeated", F.sort_array(F.transform(F.filter("by_hash", again), lambda x: x["i"]))
    ).drop("by_hash")
    covered = F.transform(
        "repeated", lambda p, k: F.least(F.lit(5), F.coalesce(F.get("repeated", k + 1) - p, F.lit(5)))
    )
    return repeated.withColumn(
        "n_repeat_words", F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x)
    ).drop("repeated")


def _shares(counts: str) -> Column:
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x)
    return F.transform(counts, lambda x: F.when(total > 0, x / total).otherwise(0.0))


def references(counts: DataFrame, rules: Rules) -> DataFrame:
    """Mean histograms by language over all documents long enough, and over all languages as '*'."""
    bins = len(CHARACTER_CLASSES) + 1
    longest = max(map(len, _word_lists(rules).values())) + 1
    long_enough = counts.filter(
        (F.col("n_chars") >= rules.min_characters) & (F.col("n_words") >= rules.min_words)
    ).select("language", _shares("characters").alias("characters"), _shares("common_counts").alias("common_counts"))

    def means(column: str, n: int) -> Column:
        found = F.array(*[F.avg(F.get(column, F.lit(i))) for i in range(n)])
        return F.filter(found, lambda x: x.isNotNull()).alias(f"normal_{column}")

    own = long_enough.groupBy("language").agg(means("characters", bins), means("common_counts", longest))
    # character classes mean the same in every language; common words do not
    all_ = long_enough.groupBy().agg(means("characters", bins)).select(
        F.lit(None).cast("string").alias("language"), "normal_characters", F.array().cast("array<double>").alias("normal_common_counts")
    )
    return own.filter(F.col("language") != ANY).unionByName(
        own.filter(F.col("language") == ANY)
        .select("language", "normal_common_counts")
        .join(all_.select("normal_characters", F.lit(ANY).alias("language")), "language")
        .select("language", "normal_characters", "normal_common_counts")
    )


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (base 2) of two arrays of shares."""

    def part(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(0.0)

    parts = F.zip_with(p, q, lambda a, b: part(a, b) + part(b, a))
    total = F.aggregate(parts, F.lit(0.0), lambda s, x: s + x)
    return F.sqrt(F.greatest(total / 2, F.lit(0.0)))


def judge(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Counts and verdict, one row per row of `docs`.

    Columns: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    character_distance, word_distance (NULL where a text is too short to be compared), kept.

    Takes doc_id, text and lang; other columns are ignored, whatever their names. A NULL text counts
    like an empty one: no words, so it fails. A NULL or unlisted language is compared with the
    documents of such languages. Equal rows get equal results; an empty table gives no rows.
    """
    counts = step(measured(docs, rules), "quality-counts")
    # one row per listed language at most
    normal = F.broadcast(references(counts, rules))
    compared = counts.join(normal, "language", "left")
    base_failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))

    def distance(column: str, length: str, least: int) -> Column:
        far = js_distance(_shares(column), F.col(f"normal_{column}"))
        # of n draws over k bins, chance alone brings about (k - 1) / (8 n ln 2) to the divergence
        chance = (F.size(f"normal_{column}") - 1) / (8 * F.col(length) * F.lit(0.6931471805599453))
        return F.when(F.col(length) >= least, F.sqrt(F.greatest(far * far - chance, F.lit(0.0))))

    judged = compared.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed.alias("base_failed"),
        distance("characters", "n_chars", rules.min_characters).alias("character_distance"),
        distance("common_counts", "n_words", rules.min_words).alias("word_distance"),
    )
    near = F.coalesce(F.col("character_distance") <= rules.max_character_distance, F.lit(True)) & F.coalesce(
        F.col("word_distance") <= rules.max_word_distance, F.lit(True)
    )
    return judged.withColumn("kept", ~F.col("base_failed") & near)
