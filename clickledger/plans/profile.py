"""Cancellation figures by any subject."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ratio, round_half_even
from ..operators.quantiles import group_quantiles


def last_year(as_of: date) -> Column:
    """Wished starts between 400 and 35 days ago."""
    today = F.lit(as_of)
    return F.col("wish_start").between(F.date_sub(today, 400), F.date_sub(today, 35))


def profile(
    features: DataFrame,
    subject: str | list[str],
    where: str | None = None,
    min_jobs: int = 0,
    as_of: date | None = None,
    upsells: bool = False,
    split_cancels: bool = False,
    partner_status: bool = False,
    book_to_cancel: bool = False,
    time_to_match: bool = True,
    reasons: bool = True,
    cancelled_only: bool = False
) -> DataFrame:
    """Counts, rates and medians per subject, kept where it has more than `min_jobs` opportunities.

    `where` is a SQL condition; `as_of` restricts to the year before it; `cancelled_only` also asks for
    a cancellation rate above 0. Rates round half to even and are NULL where their base is 0. Medians
    skip NULLs. Spark counts before the shuffle, so a subject with most of the rows costs no more.
    """
    subjects = [subject] if isinstance(subject, str) else subject
    rows = features
    if where:
        rows = rows.filter(F.expr(where))
    if as_of:
        rows = rows.filter(last_year(as_of))
    keys = [*subjects, *(["partner_status"] if partner_status else [])]

    c = F.col
    won, prepared, upsold = c("bin_won_opp"), c("bin_prepared"), c("bin_upsold")
    gone = c("bin_cancelled") & won
    invoiced = c("bin_invoiced")

    counts = {"n_jobs": F.lit(True), "n_cancelled": gone, "n_completed": c("bin_completed")}
    counts["n_d14"] = (c("last_close2cancel") <= 14) & c("bin_cancelled")
    sums: dict[str, Column] = {
        "nmv_total": c("nmv"),
        "cancelled_nmv": F.when(gone, c("nmv")),
    }
    if split_cancels:
        counts |= {"n_cancel_prebook": gone & ~prepared, "n_cancel_postbook": gone & prepared}
        sums |= {
            "cancelled_prebook_nmv": F.when(gone & ~prepared, c("nmv")),
            "cancelled_postbook_nmv": F.when(gone & prepared, c("nmv")),
        }
    if upsells:
        counts |= {"n_up": upsold, "n_up_w": upsold & won}
        sums |= {
            "up_opps_nmv": F.when(upsold, c("nmv")),
            "up_w_opps_nmv": F.when(upsold & won, c("nmv")),
        }
    if reasons:
        sums |= {"no_partner_sum": c("no_partner"), "partner_problem_sum": c("partner_problem")}

    medians: dict[str, tuple[Column, float]] = {
        "med_invoiced_margin": (F.when(invoiced, c("inv_margin")), 0.5),
        "med_invoiced_nmv": (F.when(invoiced, c("nmv")), 0.5),
        "med_invoiced_net_amount": (F.when(invoiced, c("net_inv_amount")), 0.5),
        "med_close_to_cancel": (c("last_close2cancel"), 0.5),
    }
    if book_to_cancel:
        medians["med_book_to_cancel"] = (c("book2cancel"), 0.5)
    if upsells:
        medians["med_sale_period"] = (c("sale_period"), 0.5)
    if time_to_match:
        medians["med_close_to_book"] = (c("close2book"), 0.5)

    # subject figures do not depend on the partner status, which may come along as a second key
    totals = rows.groupBy(*subjects).agg(
        *[F.count_if(v).alias(n) for n, v in counts.items()],
        *[F.coalesce(F.sum(v), F.lit(0.0)).alias(n) for n, v in sums.items()],
        *([F.avg("close2book").alias("mean_close_to_book")] if time_to_match else []),
    )
    middle = group_quantiles(rows, subjects, medians).withColumnsRenamed(
        {s: f"_of_{s}" for s in subjects}
    )
    wide = totals.join(
        middle, [F.col(s).eqNullSafe(F.col(f"_of_{s}")) for s in subjects], "left"
    )
    if partner_status:
        states = rows.select(*keys).distinct().withColumnsRenamed({s: f"_st_{s}" for s in subjects})
        wide = wide.join(states, [F.col(s).eqNullSafe(F.col(f"_st_{s}")) for s in subjects])

    rates: list[tuple[str, Column]] = []
    if split_cancels:
        for when in ("prebook", "postbook"):
            rates += [
                (f"c_rate_{when}_num", ratio(c(f"n_cancel_{when}"), c("n_jobs"))),
                (f"c_rate_{when}_nmv", ratio(c(f"cancelled_{when}_nmv"), c("nmv_total"))),
            ]
    rates += [
        ("c_rate_total_num", ratio(c("n_cancelled"), c("n_jobs"))),
        ("c_rate_total_nmv", ratio(c("cancelled_nmv"), c("nmv_total"))),
    ]
    if upsells:
        rates += [
            ("up_rate_total_num", ratio(c("n_up"), c("n_jobs"))),
            ("up_rate_total_nmv", ratio(c("up_opps_nmv"), c("nmv_total"))),
            ("up_rate_won_num", ratio(c("n_up_w"), c("n_up"))),
            ("up_rate_won_nmv", ratio(c("up_w_opps_nmv"), c("up_opps_nmv"))),
        ]
    if reasons:
        rates += [
            ("cr_no_partner_found_num", ratio(c("no_partner_sum"), c("n_cancelled"))),
            ("cr_partner_problem_num", ratio(c("partner_problem_sum"), c("n_cancelled"))),
        ]
    margin = round_half_even(c("med_invoiced_margin"), 2)
    rates += [
        ("med_invoiced_margin_nmv", margin),
        ("med_invoiced_margin", margin),
        ("med_invoiced_nmv", round_half_even(c("med_invoiced_nmv"), 2)),
        ("med_invoiced_net_amount", round_half_even(c("med_invoiced_net_amount"), 2)),
        ("med_close_to_cancel", c("med_close_to_cancel")),
        ("d14_cancels", ratio(c("n_d14"), c("n_cancelled"))),
    ]
    if book_to_cancel:
        rates.append(("med_book_to_cancel", c("med_book_to_cancel")))
    if upsells:
        rates.append(("med_sale_period", c("med_sale_period")))
    if time_to_match:
        rates += [(n, c(n)) for n in ("med_close_to_book", "mean_close_to_book")]

    result = wide.filter(c("n_jobs") > min_jobs).select(
        *keys, "n_jobs", *[value.alias(name) for name, value in rates]
    )
    return result.filter(c("c_rate_total_num") > 0) if cancelled_only else result


def profile_by_vertical(
    features: DataFrame, names: list[str], subject: str | list[str], **options
) -> DataFrame:
    """The profile within each vertical: an opportunity counts in every vertical it has a share of.

    The share columns are exploded into rows, so all verticals are profiled in one job.
    """
    present = F.array_compact(F.array(*[F.when(F.col(n) > 0, F.lit(n)) for n in names]))
    subjects = [subject] if isinstance(subject, str) else subject
    return profile(
        features.withColumn("vertical", F.explode(present)), ["vertical", *subjects], **options
    )


def by_country(features: DataFrame) -> DataFrame:
    """Each opportunity once under its country and once under 'de,nl'."""
    return features.filter(F.col("country").isin("de", "nl")).withColumn(
        "scope", F.explode(F.array("country", F.lit("de,nl")))
    )


def summary_stats(figures: DataFrame, columns: list[str]) -> DataFrame:
    """Minimum, quartiles, mean and maximum of each column, one row per column."""
    doubles = figures.select(*[F.col(c).cast("double").alias(c) for c in columns])
    long = doubles.unpivot([], columns, "measure", "value")
    value = F.col("value")
    quartiles = group_quantiles(
        long, ["measure"], {"q1": (value, 0.25), "median": (value, 0.5), "q3": (value, 0.75)}
    )
    edges = long.groupBy("measure").agg(
        F.min("value").alias("min"), F.avg("value").alias("mean"), F.max("value").alias("max")
    )
    return edges.join(quartiles, "measure").select(
        "measure", "min", "q1", "median", "mean", "q3", "max"
    )
