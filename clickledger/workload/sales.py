from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans import features as ft
from ..plans import models
from ..plans import opportunities as op
from ..plans import profile as pf
from .registry import Tables, query

AS_OF = date(2019, 6, 1)
MEASURED = ["n_jobs", "c_rate_total_num", "med_invoiced_nmv", "med_close_to_cancel"]


def vertical_names(t: Tables) -> list[str]:
    """The names of the vertical dimension, which become columns."""
    return [r.name for r in t.verticals.select("name").orderBy("name").collect()]


def mart(t: Tables) -> DataFrame:
    return op.opportunity_mart(
        t.sales_revenue,
        t.sales_revenue.select("offer_id", "bin_upsell").distinct(),
        t.opportunities,
        t.invoices,
        t.partners,
        t.agents,
        t.zip_codes,
    )


def study(t: Tables) -> DataFrame:
    shares = op.vertical_shares(t.sales_revenue, t.opportunities)
    return op.study_rows(mart(t), op.vertical_combo(t.sales_revenue), shares, vertical_names(t))


def features(t: Tables) -> DataFrame:
    return op.opportunity_features(op.clean_opportunities(study(t)))


def feature_step(t: Tables) -> DataFrame:
    return t.step("features", features)


_DATES = ["first_offer", "last_offer", "wish_start", "booked", "cancelled", "first_rematch", "completed",
          "downp_inv"]
_MONEY = ["margin", "nmv", "net_inv_amount", "partner_cost", "additional_cost", "csd", "epd", "sales_epd"]


def _text(df: DataFrame, rounded: dict[str, int]) -> DataFrame:
    return df.withColumns(
        {
            **{d: F.col(d).cast("string") for d in _DATES if d in df.columns},
            **{c: F.round(c, n) for c, n in rounded.items() if c in df.columns},
        }
    )


@query("opportunity_rollup", "sales_rollup_text")
def _(spark, sf_dir):
    t = Tables(spark, sf_dir)
    offers = t.sales_revenue.select("offer_id", "bin_upsell").distinct()
    rows = op.opportunity_rollup(t.sales_revenue, offers, t.opportunities)
    return _text(rows, {"margin": 4, "nmv": 4, "sales_epd": 4})


@query("opportunity_mart", "mart_text")
def _(spark, sf_dir):
    return _text(mart(Tables(spark, sf_dir)), dict.fromkeys(_MONEY, 6))


@query("pivot_verticals", "wide_shares_rounded")
def _(spark, sf_dir):
    t = Tables(spark, sf_dir)
    names = vertical_names(t)
    wide = op.pivot_verticals(op.vertical_shares(t.sales_revenue, t.opportunities), names)
    return _text(wide, dict.fromkeys(names, 6))


@query("vertical_combo", "combos")
def _(spark, sf_dir):
    return op.vertical_combo(Tables(spark, sf_dir).sales_revenue)


@query("quality_report", "quality")
def _(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return op.quality_report(study(t), vertical_names(t))


@query("clean_opportunities", "clean_text")
def _(spark, sf_dir):
    t = Tables(spark, sf_dir)
    rounded = dict.fromkeys(_MONEY, 6) | dict.fromkeys(vertical_names(t), 6)
    return _text(op.clean_opportunities(study(t)), rounded)


@query("opportunity_features", "features_text")
def _(spark, sf_dir):
    rows = features(Tables(spark, sf_dir)).select(
        "opportunity_id", "margin", "inv_margin", "close2book", "last_close2cancel", "book2cancel",
        "downp_inv2cancel", "sale_period", "vorlauf", "month_ws",
    )
    return _text(rows, {"margin": 6, "inv_margin": 6})


@query("pair_corr", "correlation")
def _(spark, sf_dir):
    rows = op.pair_corr(features(Tables(spark, sf_dir)), "downp_inv2cancel", "book2cancel")
    return rows.withColumn("corr", F.round("corr", 6))


def _figures(df: DataFrame) -> DataFrame:
    if "mean_close_to_book" in df.columns:
        df = df.withColumn("mean_close_to_book", F.round("mean_close_to_book", 6))
    return df


@query("profile_by_partner", "by_partner")
def _(spark, sf_dir):
    rows = pf.profile(
        feature_step(Tables(spark, sf_dir)),
        "partner_id",
        "bin_prepared AND partner_id IS NOT NULL AND bin_won_opp AND partner_status NOT IN "
        "('black_sheep', 'dropout', 'disabled_partner')",
        min_jobs=1,
        as_of=AS_OF,
        partner_status=True,
        book_to_cancel=True,
        time_to_match=False,
    )
    return _figures(rows)


@query("profile_by_agent", "by_agent")
def _(spark, sf_dir):
    rows = pf.profile(
        feature_step(Tables(spark, sf_dir)),
        "first_sales_agent",
        "bin_active",
        min_jobs=10,
        split_cancels=True,
        time_to_match=False,
    )
    return _figures(rows)


def city_profile(t: Tables) -> DataFrame:
    return pf.profile(
        feature_step(t), "city_bucket", "city_bucket IS NOT NULL", 10, AS_OF, split_cancels=True
    )


@query("profile_by_city", "by_city")
def _(spark, sf_dir):
    return _figures(city_profile(Tables(spark, sf_dir)))


@query("profile_by_month", "by_month")
def _(spark, sf_dir):
    t = Tables(spark, sf_dir)
    rows = pf.profile_by_vertical(
        pf.by_country(feature_step(t)),
        vertical_names(t),
        ["scope", "month_ws"],
        min_jobs=5,
        as_of=AS_OF,
        split_cancels=True,
    )
    return _figures(rows)


@query("profile_by_vertical_combo", "by_combo")
def _(spark, sf_dir):
    rows = pf.profile(
        pf.by_country(feature_step(Tables(spark, sf_dir))),
        ["scope", "verticals"],
        min_jobs=5,
        as_of=AS_OF,
        split_cancels=True,
        upsells=True,
    )
    return _figures(rows)


@query("profile_by_vertical_count", "by_count")
def _(spark, sf_dir):
    scoped = pf.by_country(feature_step(Tables(spark, sf_dir)))
    return _figures(
        pf.profile(scoped, ["scope", "vertical_count"], None, 10, AS_OF, split_cancels=True)
    )


@query("profile_by_main_vertical", "by_main_vertical")
def _(spark, sf_dir):
    scoped = pf.by_country(feature_step(Tables(spark, sf_dir)))
    return _figures(
        pf.profile(scoped, ["scope", "main_vertical"], None, 10, AS_OF, split_cancels=True)
    )


@query("profile_by_vertical_city", "by_vertical_city")
def _(spark, sf_dir):
    t = Tables(spark, sf_dir)
    rows = pf.profile_by_vertical(
        feature_step(t),
        vertical_names(t),
        "city_bucket",
        where="city_bucket IS NOT NULL",
        min_jobs=10,
        as_of=AS_OF,
        split_cancels=True,
    )
    return _figures(rows)


@query("summary_stats", "summary")
def _(spark, sf_dir):
    rows = pf.summary_stats(city_profile(Tables(spark, sf_dir)), MEASURED)
    return rows.withColumn("mean", F.round("mean", 6))


@query("c_rates", "rates_of_rows")
def _(spark, sf_dir):
    rows = ft.cancel_rates(feature_step(Tables(spark, sf_dir)))
    names = list(ft.RATE_SUBJECTS.values())
    return _text(rows.select("opportunity_id", *names), dict.fromkeys(names, 6))


def _training(spark, sf_dir, booking: str, edition: str) -> DataFrame:
    rows = ft.training_set(feature_step(Tables(spark, sf_dir)), booking, edition)
    return _text(rows, {"nmv": 4, "margin": 6, "epd": 4, **dict.fromkeys(ft.RATE_SUBJECTS.values(), 6)})


@query("training_set", "training")
def _(spark, sf_dir):
    return _training(spark, sf_dir, "post", "notebook")


@query("training_set_pre", "training_pre")
def _(spark, sf_dir):
    return _training(spark, sf_dir, "pre", "notebook")


@query("training_set_script", "training_script")
def _(spark, sf_dir):
    """Both sets of the script edition."""
    t = Tables(spark, sf_dir)
    sets = [
        ft.training_set(feature_step(t), booking, "script").withColumn("booking", F.lit(booking)) for booking in ("pre", "post")
    ]
    rows = sets[1].unionByName(sets[0], allowMissingColumns=True)
    return _text(rows, {"nmv": 4, "margin": 6, **dict.fromkeys(ft.RATE_SUBJECTS.values(), 6)})


def _booked(t: Tables) -> DataFrame:
    return feature_step(t).filter("bin_prepared").select("opportunity_id", *ft.CLAMPED["post"])


@query("winsorize", "clamped_text")
def _(spark, sf_dir):
    columns = ft.CLAMPED["post"]
    return _text(ft.winsorize(_booked(Tables(spark, sf_dir)), columns), dict.fromkeys(columns, 6))


@query("zscore", "scaled")
def _(spark, sf_dir):
    columns = ft.CLAMPED["post"]
    clamped = ft.winsorize(_booked(Tables(spark, sf_dir)), columns)
    return _text(ft.zscore(clamped, columns), dict.fromkeys(columns, 6))


def _steady(rows: DataFrame) -> DataFrame:
    """Sums rounded, so that cuts fall between values and not into rounding noise."""
    return rows.withColumns(
        {"margin": F.round("margin", 6), "nmv": F.round("nmv", 4), "sales_epd": F.round("sales_epd", 4)}
    )


def _gains(t: Tables) -> DataFrame:
    rows = ft.training_set(_steady(feature_step(t)), "post")
    return ft.information_gain(rows, "label", ft.SETS["notebook", "post"])


@query("information_gain", "gains")
def _(spark, sf_dir):
    return _text(_gains(Tables(spark, sf_dir)), {"information_gain": 8, "chi_squared": 8})


@query("informative_features", "informative")
def _(spark, sf_dir):
    """The features that pass the threshold, and the training rows reduced to them."""
    t = Tables(spark, sf_dir)
    kept = ft.keep_informative(_gains(t), threshold=0.002)
    rows = ft.training_set(_steady(feature_step(t)), "post")
    return rows.agg(F.count(F.lit(1)).alias("rows"), *[F.count(c).alias(f"n_{c}") for c in kept]).unpivot(
        "rows", [f"n_{c}" for c in kept], "feature", "known"
    )


def _table(t: Tables, booking: str, scaled: bool) -> DataFrame:
    name = f"model_table_{booking}_{scaled}"
    return t.step(name, lambda t: ft.model_table(_steady(feature_step(t)), booking, scaled=scaled))


def _judged(df: DataFrame) -> DataFrame:
    return _text(df, {"auc": 6, "acc": 6})


@query("logistic_cv", "logistic_post")
def _(spark, sf_dir):
    table = _table(Tables(spark, sf_dir), "post", True)
    return _judged(models.logistic_cv(table, ft.SETS["notebook", "post"]))


@query("logistic_cv_pre", "logistic_pre")
def _(spark, sf_dir):
    table = _table(Tables(spark, sf_dir), "pre", True)
    return _judged(models.logistic_cv(table, ft.SETS["notebook", "pre"]))


@query("logistic_model", "logistic_terms")
def _(spark, sf_dir):
    table = _table(Tables(spark, sf_dir), "post", True)
    terms = models.logistic_model(table, ft.SETS["notebook", "post"])
    return _text(terms, {"coefficient": 6, "std_error": 6, "z": 4})


GRID = models.full_grid(3)


@query("tree_cv", "tree_folds")
def _(spark, sf_dir):
    table = _table(Tables(spark, sf_dir), "post", False)
    return _judged(models.tree_cv(table, ft.SETS["notebook", "post"], GRID))


@query("tree_search", "tree_settings")
def _(spark, sf_dir):
    table = _table(Tables(spark, sf_dir), "post", False)
    return _judged(models.tree_search(table, ft.SETS["notebook", "post"], GRID)).withColumn(
        "complexity", F.round("complexity", 6)
    )


@query("tree_importance", "tree_gains")
def _(spark, sf_dir):
    table = _table(Tables(spark, sf_dir), "post", False)
    setting = models.Setting(40, 5, 0.0001)
    return _text(models.tree_importance(table, ft.SETS["notebook", "post"], setting), {"importance": 4})
