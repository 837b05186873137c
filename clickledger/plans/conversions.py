"""Conversions on the site and the sessions that led to them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import berlin_local
from ..operators.chunked import carried_last, group_totals, running_count
from ..operators.dedupe import one_per_key
from ..operators.skew import DEFAULT_RULE, HotKeyRule, hot_keys, per_heat, with_slices
from .sessions import DIRECT

# Apps whose orders are tests; how far back a path reaches.
TEST_APPS = ("web-localhost", "web-staging")
LOOKBACK = "INTERVAL '90 00:00:01' DAY TO SECOND"


def onsite_conversions(
    events: DataFrame,
    session_map: DataFrame,
    valid_leads: DataFrame,
    before: Column | None = None,
    conversion_type: str = "LEAD",
) -> DataFrame:
    """The first order event of each valid lead, with its session and conversion path."""
    orders = events.filter(
        (F.col("event") == "tr")
        & F.col("tr_orderid").isNotNull()
        & ~F.col("app_id").isin(*TEST_APPS)  # unknown apps drop out, too
    ).select(
        "event_id", "event_fingerprint", "event", "collector_tstamp", "tr_orderid", "domain_userid"
    )
    if before is not None:
        orders = orders.filter(F.col("collector_tstamp") < before)
    known = valid_leads.select(F.col("lead_id").cast("string").alias("tr_orderid"))
    orders = orders.join(known, "tr_orderid", "left_semi")
    placed = orders.join(
        session_map.select("event_id", "event_fingerprint", "session_id"),
        ["event_id", "event_fingerprint"],
    )
    first = one_per_key(
        placed, ["tr_orderid"], [F.col("collector_tstamp").asc(), F.col("event_id").asc()]
    )
    return first.select(
        "event_id",
        "event_fingerprint",
        "event",
        "collector_tstamp",
        "tr_orderid",
        "session_id",
        "domain_userid",
        F.col("domain_userid").alias("onsite_user_id"),
        F.col("domain_userid").alias("login_user_id"),
        F.lit(conversion_type).alias("conversion_type"),
        F.concat(F.lit(f"{conversion_type}-"), "session_id").alias("conversion_path_id"),
        berlin_local(F.col("collector_tstamp")).alias("onsite_conversion_locale_tstamp"),
    )


USER_TYPE = ["domain_userid", "conversion_type"]
PATH = [*USER_TYPE, "conversion_path_id"]


def _paths(points: DataFrame, chunk: list[str]) -> DataFrame:
    """Sessions with the conversion they lead to and their place on its path."""
    target = F.when(
        F.col("is_conversion"), F.struct("conversion_path_id", F.col("at").alias("converted_at"))
    )
    points = carried_last(
        points, USER_TYPE, ["at", "is_conversion", "tie"], chunk, target, "_next", True, backward=True
    )
    reached = points.filter(
        ~F.col("is_conversion")
        & (F.col("at") > F.col("_next.converted_at") - F.expr(LOOKBACK))
    ).select(
        *USER_TYPE,
        *chunk,
        "at",
        "session_id",
        "is_direct",
        F.col("_next.conversion_path_id").alias("conversion_path_id"),
    )
    reached = running_count(reached, PATH, ["at", "session_id"], chunk, "path_position")
    reached = group_totals(reached, PATH, chunk, {"path_length": F.lit(1)})
    reached = reached.withColumns(path_weights(F.col("path_position"), F.col("path_length")))
    reached = group_totals(reached, PATH, chunk, {"_custom_total": F.col("custom_prep")})
    # rounded twice, so that a tie in the fourth digit does not hang on the order of the sum
    share = F.round(F.col("custom_prep") / F.col("_custom_total"), 10)
    return reached.withColumn("custom", F.round(share, 4))


def path_weights(position: Column, length: Column) -> dict[str, Column]:
    """Share of each session in its conversion, under the five fixed models and before custom."""
    first, last = position == 1, position == length
    ends = first | last
    by_position = (
        F.when(length == 1, 1.0)
        .when(length == 2, 0.5)
        .when(ends, 0.4)
        .otherwise(F.lit(0.2) / (length - 2))
    )
    return {
        "interaction_type": F.when(first, "first").when(last, "last").otherwise("middle"),
        "first_last": F.when(length == 1, 1.0).when(ends, 0.5).otherwise(0.0),
        "position_based": by_position,
        "first": F.when(first, 1.0).otherwise(0.0),
        "last": F.when(last, 1.0).otherwise(0.0),
        "linear": F.lit(1.0) / length,
        # a direct visit after the first position earns nothing
        "custom_prep": F.when(F.col("is_direct") & ~first, 0.0).otherwise(by_position),
    }


def conversion_path(
    conversions: DataFrame,
    sessions: DataFrame,
    types: tuple[str, ...] = ("LEAD",),
    rule: HotKeyRule = DEFAULT_RULE,
) -> DataFrame:
    """Sessions on the path to each conversion, with attribution weights.

    A session belongs to the user's next conversion of a type, if that follows within 90 days. The
    spans (previous conversion, this conversion] never overlap, so instead of joining
    every session to every conversion of its user, both are put on one timeline and each session
    looks ahead to the next conversion.
    """
    first = one_per_key(
        conversions.filter(F.col("session_id").isNotNull()),
        ["conversion_path_id"],
        [F.col("collector_tstamp").asc(), F.col("tr_orderid").asc()],
    )
    visits = sessions.select(
        "domain_userid",
        F.explode(F.array(*[F.lit(t) for t in types])).alias("conversion_type"),
        F.col("start_collector_tstamp").alias("at"),
        F.lit(False).alias("is_conversion"),
        F.col("session_id").alias("tie"),
        "session_id",
        (F.col("utm_id") == DIRECT).alias("is_direct"),
        F.lit(None).cast("string").alias("conversion_path_id"),
    )
    goals = first.select(
        "domain_userid",
        "conversion_type",
        F.col("collector_tstamp").alias("at"),
        F.lit(True).alias("is_conversion"),
        F.col("conversion_path_id").alias("tie"),
        F.lit(None).cast("string").alias("session_id"),
        F.lit(None).cast("boolean").alias("is_direct"),
        "conversion_path_id",
    )
    points = visits.unionByName(goals)
    hot = hot_keys(points, USER_TYPE, "at", rule)
    points = with_slices(points, USER_TYPE, "at", hot)
    return per_heat(points, hot, _paths).select(
        "conversion_path_id",
        "conversion_type",
        "session_id",
        "domain_userid",
        "is_direct",
        "path_position",
        "path_length",
        F.concat("conversion_path_id", F.lit("-"), "path_position").alias(
            "conversion_path_part_id"
        ),
        "interaction_type",
        "first_last",
        "position_based",
        "first",
        "last",
        "linear",
        "custom_prep",
        "custom",
    )
