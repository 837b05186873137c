"""Training sets for the cancellation models and what each feature tells."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.cuts import supervised_cuts
from ..operators.quantiles import group_quantiles
from ..operators.skew import lookup

# subject -> name of its cancellation rate
RATE_SUBJECTS = {
    "partner_id": "partner_c_rate",
    "verticals": "vertical_combo_c_rate",
    "first_sales_agent": "agent_c_rate",
}
# Columns of the training sets, by edition and booking state.
SETS = {
    ("notebook", "pre"): ["vorlauf", "nmv", "vertical_combo_c_rate", "agent_c_rate",
                          "is_image_uploaded", "epd"],
    ("notebook", "post"): ["vorlauf", "close2book", "bin_rematched", "nmv", "margin",
                           "vertical_combo_c_rate", "partner_c_rate", "agent_c_rate",
                           "is_image_uploaded", "epd"],
    ("script", "pre"): ["sale_period", "vorlauf", "nmv", "vertical_combo_c_rate", "agent_c_rate",
                        "is_image_uploaded", "is_urban"],
    ("script", "post"): ["sale_period", "vorlauf", "close2book", "bin_rematched", "nmv", "margin",
                         "vertical_combo_c_rate", "partner_c_rate", "agent_c_rate",
                         "is_image_uploaded", "is_urban"],
}
CLAMPED = {"pre": ["vorlauf", "nmv"], "post": ["vorlauf", "close2book", "nmv", "margin"]}
_NOBODY = "\u0000"


def cancel_rates(features: DataFrame) -> DataFrame:
    """Cancellation rate of each row's partner, vertical combination and agent; a missing subject is one.

    Rates are counted per subject before the shuffle and looked up, so that rows never gather by
    subject as they would in a window.
    """
    for subject, name in RATE_SUBJECTS.items():
        key = F.coalesce(F.col(subject), F.lit(_NOBODY))
        keyed = features.withColumn("_subject", key)
        rates = keyed.groupBy("_subject").agg(
            (F.count_if("bin_cancelled") / F.count(F.lit(1))).alias(name)
        )
        features = lookup(keyed, rates, ["_subject"]).drop("_subject")
    return features


def training_set(
    features: DataFrame,
    booking: str,
    edition: str = "notebook"
) -> DataFrame:
    """Predictors and label before ('pre') or after ('post') a partner was booked.

    The notebook's discount is that of the sales rows, the script knows that of the invoices only.
    """
    rated = cancel_rates(features)
    label = F.col("bin_cancelled")
    if booking == "post":
        rows = rated.filter("bin_prepared")
    elif edition == "script":
        rows = rated.filter("NOT bin_prepared OR bin_completed")
    else:
        rows, label = rated, ~F.col("bin_prepared")
    if edition == "notebook":
        rows = rows.withColumn("epd", F.col("sales_epd"))
    return rows.select(
        "opportunity_id", label.cast("int").alias("label"), *SETS[edition, booking]
    )


def numeric_columns(df: DataFrame, columns: list[str]) -> list[str]:
    kinds = dict(df.dtypes)
    return [c for c in columns if kinds[c] not in ("boolean", "string")]


def _beside(df: DataFrame, figures: DataFrame) -> DataFrame:
    """One row of figures as a struct `_f` beside all rows: a single scalar subquery, whatever reads from it."""
    return df.withColumn("_f", figures.select(F.struct("*")).scalar())


def winsorize(df: DataFrame, columns: list[str]) -> DataFrame:
    """Clamp values to the Tukey fences q1 - 1.5 IQR and q3 + 1.5 IQR of their column."""
    spec = {}
    for c in columns:
        spec |= {f"{c}_q1": (F.col(c), 0.25), f"{c}_q3": (F.col(c), 0.75)}

    def clamped(c: str):
        q1, q3 = F.col(f"_f.{c}_q1"), F.col(f"_f.{c}_q3")
        reach = (q3 - q1) * 1.5
        value = F.col(c).cast("double")
        return F.when(value.isNotNull(), F.least(F.greatest(value, q1 - reach), q3 + reach))

    beside = _beside(df, group_quantiles(df, [], spec))
    return beside.withColumns({c: clamped(c) for c in columns}).drop("_f")


def zscore(df: DataFrame, columns: list[str]) -> DataFrame:
    """Drop incomplete rows, then centre and scale by the sample standard deviation."""
    whole = df.dropna()
    stats = [F.avg(c).alias(f"{c}_mean") for c in columns]
    stats += [F.stddev_samp(c).alias(f"{c}_sd") for c in columns]
    return (
        _beside(whole, whole.agg(*stats))
        .withColumns(
            {c: F.try_divide(F.col(c) - F.col(f"_f.{c}_mean"), F.col(f"_f.{c}_sd")) for c in columns}
        )
        .drop("_f")
    )


def model_table(
    features: DataFrame, booking: str, edition: str = "notebook", scaled: bool = True
) -> DataFrame:
    """A training set ready for a learner: clamped, complete, scaled, booleans as numbers.

    Trees may take it without the scaling, which moves no row across a cut.
    """
    columns = SETS[edition, booking]
    rows = training_set(features, booking, edition)
    rows = winsorize(rows, CLAMPED[booking])
    numbers = numeric_columns(rows, columns)
    if scaled:
        # a constant column has no scale; centred it is 0
        rows = zscore(rows, numbers).fillna(0.0, subset=numbers)
    else:
        rows = rows.dropna()
    return rows.withColumns(
        {c: F.col(c).cast("double") for c in columns if dict(rows.dtypes)[c] == "boolean"}
    )


def information_gain(df: DataFrame, label: str, columns: list[str]) -> DataFrame:
    """Information gain (nats) and Cramer's V of each feature about a label of 0 and 1.

    Numbers are cut where that tells most about the label, as long as it pays (`operators.cuts`); a number without such a
    cut has one piece, gains 0 and has no chi-squared. One pass counts (feature, value, label); all that follows works on these
    counts. Rows with a NULL are left out.
    """
    whole = df.dropna(subset=[label, *columns])
    numbers = numeric_columns(whole, columns)
    cuts, counts = supervised_cuts(whole, label, columns)
    # booleans are two pieces anyway
    edges = {c: cuts[c] if c in numbers else [0.0] for c in columns}
    piece = F.lit(0)
    for c, found in edges.items():
        if found:
            at = F.array(*[F.lit(x) for x in found])
            above = F.size(F.filter(at, lambda x: x < F.col("value")))
            piece = F.when(F.col("feature") == c, above).otherwise(piece)
    sides = F.array(
        F.struct(F.lit(0).alias("label"), (F.col("n") - F.col("positive")).alias("n")),
        F.struct(F.lit(1).alias("label"), F.col("positive").alias("n")),
    )
    counts = (
        counts.select("feature", piece.alias("piece"), F.inline(sides))
        .groupBy("feature", "piece", "label")
        .agg(F.sum("n").alias("n"))
        .filter("n > 0")
    )
    feature, in_piece, in_label = (
        Window.partitionBy("feature"),
        Window.partitionBy("feature", "piece"),
        Window.partitionBy("feature", "label"),
    )
    # empty cells of the table still count for chi-squared: a cell's share is E - 2n + n^2 / E, and
    # the E of all cells sum up to N
    cells = counts.withColumns(
        {
            "total": F.sum("n").over(feature).cast("double"),
            "row": F.sum("n").over(in_piece).cast("double"),
            "column": F.sum("n").over(in_label).cast("double"),
        }
    )
    p = F.col("n") / F.col("total")
    gain = F.sum(p * F.log(F.col("n") * F.col("total") / (F.col("row") * F.col("column"))))
    chi2 = F.sum(F.col("n") * F.col("n") * F.col("total") / (F.col("row") * F.col("column"))) - F.max(
        "total"
    )
    smaller = F.least(F.countDistinct("piece"), F.countDistinct("label")) - 1
    return cells.groupBy("feature").agg(
        gain.alias("information_gain"),
        F.sqrt(F.try_divide(F.greatest(chi2, F.lit(0.0)), F.max("total") * smaller)).alias("chi_squared"),
    )


def keep_informative(gains: DataFrame, threshold: float = 0.0) -> list[str]:
    """Names of the features with at least the threshold; there are as many rows as features."""
    kept = gains.filter(F.col("information_gain") >= threshold).orderBy("feature")
    return [row.feature for row in kept.select("feature").collect()]
