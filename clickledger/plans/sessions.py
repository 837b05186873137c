"""Web events -> sessions."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import berlin_local, to_did
from ..operators.chunked import carried_last, running_count
from ..operators.dedupe import one_per_key
from ..operators.loads import unseen
from ..operators.skew import (
    DEFAULT_RULE,
    HotKeyRule,
    hot_keys,
    lookup,
    per_heat,
    with_slices,
)
from ..session import written

# channel keys of the dummy channels
DIRECT, UNTRACKED, TIMEOUT, LOADING = (
    hashlib.md5(name.encode()).hexdigest() for name in ("", "na", "timeout", "loading")
)

IDENTITY = ["collector_tstamp", "event_id", "event_fingerprint"]
# event_id and event_fingerprint only break ties, so that results repeat
ORDER = ["collector_tstamp", "derived_tstamp", "event_id", "event_fingerprint"]
USER_DAY = ["domain_userid", "locale_date"]
# copies of an event share these; the newest counts
COPY = ["event_id", "event_fingerprint"]


def keep_known(name: str, unwanted: str) -> Column:
    """True unless the column holds the unwanted value; NULL stays in."""
    return F.coalesce(F.col(name) != unwanted, F.lit(True))


def countable_events(
    events: DataFrame, start_at: Column | None = None, end_at: Column | None = None
) -> DataFrame:
    """Identified events of people from outside, within [start_at, end_at]."""
    kept = events.filter(
        F.col("domain_userid").isNotNull()
        & F.col("event_fingerprint").isNotNull()
        & F.col("event_id").isNotNull()
        & keep_known("br_renderengine", "bot")
        & keep_known("app_id", "web-internal")
    )
    if start_at is not None:
        kept = kept.filter(F.col("collector_tstamp") >= start_at)
    if end_at is not None:
        kept = kept.filter(F.col("collector_tstamp") <= end_at)
    return kept


def _newest(hits: DataFrame, keys: list[str]) -> DataFrame:
    return one_per_key(hits, keys, [F.col("collector_tstamp").desc(), F.col("derived_ranking").desc()])


def _break_into_sessions(hits: DataFrame, chunk: list[str]) -> DataFrame:
    """Session id and position for deduplicated events.

    The first event of (user, tracker session, Berlin day) always opens a session, so nothing carries
    over midnight and (user, day) is enough as the key of every window. Only rows that open a tracker
    session or come from outside can change the session's entrance, hence "break" rows. The rows must lie together by
    (user, day), so that none of the windows has to shuffle them.
    """
    hits = running_count(
        hits, [*USER_DAY, "domain_sessionid"], ["derived_ranking"], chunk, "session_ranking"
    )
    opens = F.col("session_ranking") == 1
    breaks = opens | F.col("entrance_id").isNotNull()
    hits = hits.withColumn(
        "_entrance", F.when(breaks, F.coalesce("entrance_id", F.lit("direct_or_time").cast("binary")))
    )
    hits = carried_last(
        hits, USER_DAY, ["derived_ranking"], chunk, F.col("_entrance"), "_previous", False
    )
    # the same entrance twice in a row does not split
    new = opens | (F.col("_entrance") != F.col("_previous"))
    hits = hits.withColumn(
        "_own_id", F.when(new, F.concat("locale_date", F.lit("_"), "event_id"))
    )
    hits = carried_last(
        hits, USER_DAY, ["derived_ranking"], chunk, F.col("_own_id"), "session_id", True
    )
    return running_count(
        hits, [*USER_DAY, "session_id"], ["derived_ranking"], chunk, "session_event_index"
    )


def sessionize(
    events: DataFrame,
    start_at: Column | None = None,
    end_at: Column | None = None,
    rule: HotKeyRule = DEFAULT_RULE,
) -> DataFrame:
    """Event -> session map: a session ends with the tracker's session, the Berlin day or a new entrance."""
    hits = countable_events(events, start_at, end_at).select(
        F.left("event_id", F.lit(36)).alias("event_id"),
        F.left("event_fingerprint", F.lit(128)).alias("event_fingerprint"),
        "collector_tstamp",
        "derived_tstamp",
        F.left("domain_userid", F.lit(36)).alias("domain_userid"),
        "domain_sessionid",
        F.date_format(berlin_local(F.col("collector_tstamp")), "yyyyMMdd").alias("locale_date"),
        F.when(
            keep_known("refr_medium", "internal"),
            F.unhex(
                F.md5(
                    F.lower(
                        F.concat(
                            F.coalesce("page_url", F.lit("")), F.coalesce("page_referrer", F.lit(""))
                        )
                    )
                )
            ),
        ).alias("entrance_id"),
    )
    hot = hot_keys(hits, USER_DAY, "collector_tstamp", rule)
    mapped = _cut_in_place(hits) if hot is None else _cut_sliced(with_slices(hits, USER_DAY, "collector_tstamp", hot), hot)
    return mapped.select(
        "session_id",
        "event_id",
        "event_fingerprint",
        "collector_tstamp",
        "domain_userid",
        "derived_ranking",
        "session_event_index",
        F.col("entrance_id").isNotNull().alias("is_external"),
    )


def _cut_in_place(hits: DataFrame) -> DataFrame:
    """Rank, drop copies and cut in one shuffle by (user, day); only copies that lie on several of them meet elsewhere."""
    kept = _kept_copies(hits)
    if kept is not None:
        elsewhere = F.coalesce((F.col("_user") != F.col("domain_userid")) | (F.col("_day") != F.col("locale_date")), F.lit(False))
        hits = hits.join(kept, COPY, "left").withColumn("_elsewhere", elsewhere).drop("_user", "_day")
    # ranked before copies are dropped, so a dropped copy leaves a gap
    hits = running_count(hits, ["domain_userid"], ORDER, ["locale_date"], "derived_ranking", aside=False)
    hits = _newest(hits, [*USER_DAY, *COPY])
    if kept is not None:
        hits = hits.filter(~F.col("_elsewhere")).drop("_elsewhere")
    return _break_into_sessions(hits, [])


def _kept_copies(hits: DataFrame) -> DataFrame | None:
    """Where the newest copy lies (`_user`, `_day`) of the events that several users or days have; None if there are none.

    Hashes find the events that repeat at all; the few that do are then compared themselves. The position among all of its user's
    events breaks a tie, so these users are ranked here as well.
    """
    number = F.xxhash64(*COPY)
    repeated = hits.groupBy(number.alias("_number")).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_number")
    repeated = written(repeated, "repeated")
    place = F.struct(*USER_DAY)
    again = hits.withColumn("_number", number).join(repeated, "_number", "left_semi")
    apart = again.groupBy(*COPY).agg(F.min(place).alias("_least"), F.max(place).alias("_most")).filter("_least != _most")
    apart = written(apart.select(*COPY), "copies-apart")
    if apart.isEmpty():
        return None
    users = written(hits.join(apart, COPY, "left_semi").select("domain_userid").distinct(), "users-of-copies")
    theirs = hits.join(users, "domain_userid", "left_semi")
    theirs = running_count(theirs, ["domain_userid"], ORDER, ["locale_date"], "derived_ranking", aside=False)
    kept = _newest(theirs.join(apart, COPY, "left_semi"), COPY)
    return written(kept.select(*COPY, F.col("domain_userid").alias("_user"), F.col("locale_date").alias("_day")), "kept-copies")


def _cut_sliced(hits: DataFrame, hot: DataFrame) -> DataFrame:
    """The same where some (user, day) hold too many rows for one task and are cut into slices."""
    # exact copies share their time, so no slice parts them; they shrink to one row before any
    # shuffle, and still count in the ranking
    weight = "copies"
    once = F.lit(1).cast("long").alias(weight)
    hits = (
        hits.filter(F.col("slice") == 0)
        .select("*", once)
        .unionByName(
            hits.filter(F.col("slice") > 0)
            .groupBy(*hits.columns)
            .agg(F.count(F.lit(1)).alias(weight))
        )
    )
    # ranked before copies are dropped, so a dropped copy leaves a gap
    hits = running_count(
        hits, ["domain_userid"], ORDER, ["locale_date", "slice"], "derived_ranking", weight
    )
    hits = _newest(hits, COPY)

    def cut(rows: DataFrame, chunk: list[str]) -> DataFrame:
        # one shuffle for all windows, whose keys all start with the day's
        return _break_into_sessions(rows.repartition(*USER_DAY, *chunk), chunk)

    return per_heat(hits, hot, cut)


# what a session takes over from its first event as it is
DETAILS = ["page_urlhost", "geo_zipcode", "geo_latitude", "geo_longitude", "geo_region_name", "useragent", "br_name",
           "br_family", "br_version", "br_type", "br_lang", "br_features_pdf", "br_viewwidth", "br_viewheight", "os_name",
           "os_family", "dvce_type", "dvce_ismobile", "dvce_screenwidth", "dvce_screenheight"]
# what says where it landed, comes from and lies; what is compared first where rows share an identity
PLACE = ["refr_medium", "page_url", "page_title", "page_urlpath", "geo_country", "geo_city"]
# all that a session needs of it
LANDING = [*PLACE, *DETAILS]


def first_hits(events: DataFrame, columns: list[str], prefix: str = "") -> DataFrame:
    """The columns of the first row, by kind of event and the columns, of each identity; `prefix` for the identity's names."""
    hits = events.groupBy(*IDENTITY).agg(F.min(F.struct("event", *columns)).alias("_hit"))
    return hits.select(
        *[F.col(c).alias(f"{prefix}{c}") for c in IDENTITY], *[F.col(f"_hit.{c}").alias(c) for c in columns]
    )


def session_bounds(
    session_map: DataFrame,
    events: DataFrame,
    start_at: Column | None = None,
    end_at: Column | None = None,
    landing: list[str] | None = None,
) -> DataFrame:
    """First and last event and the event counts of each session. Bounds are exclusive here.

    `landing` names columns of the first event to bring along, so that nobody has to join all events
    again to look it up.
    """
    mapped = session_map
    if start_at is not None:
        mapped = mapped.filter(F.col("collector_tstamp") > start_at)
    if end_at is not None:
        mapped = mapped.filter(F.col("collector_tstamp") < end_at)
    extra = landing or []
    # rows that share an identity shrink to one before the shuffle, but each counts as what it is
    hit = [F.min(F.struct("event", *extra)).alias("_hit")] if extra else []
    raw = (
        events.groupBy(*IDENTITY)
        .agg(
            *hit,
            F.count(F.lit(1)).alias("_copies"),
            F.count_if(F.col("event") == "transaction").alias("_transactions"),
            F.count_if(F.col("event") == "page_view").alias("_page_views"),
        )
        .select(
            *IDENTITY,
            *[F.col(f"_hit.{c}").alias(c) for c in extra],
            "_copies",
            "_transactions",
            "_page_views",
        )
    )
    joined = mapped.select("session_id", "domain_userid", "derived_ranking", *IDENTITY).join(
        raw, IDENTITY, "left"
    )

    def edge(pick, columns: list[str]) -> Column:
        # an event missing from the raw table leaves NULLs, as the join does
        return pick(
            F.struct(*[F.when(F.col("_copies") > 0, F.col(c)).alias(c) for c in columns]),
            "derived_ranking",
        )

    def total(counts: str) -> Column:
        return F.coalesce(F.sum(counts), F.lit(0))

    bounds = joined.groupBy("session_id", "domain_userid").agg(
        edge(F.min_by, [*IDENTITY, *extra]).alias("_first"),
        edge(F.max_by, IDENTITY).alias("_last"),
        total("_copies").alias("events"),
        total("_transactions").alias("transactions"),
        total("_page_views").alias("page_views"),
    )
    return bounds.select(
        "session_id",
        "domain_userid",
        *[F.col(f"_first.{c}").alias(f"start_{c}") for c in IDENTITY],
        *[F.col(f"_last.{c}").alias(f"end_{c}") for c in IDENTITY],
        "events",
        "transactions",
        "page_views",
        *[F.col(f"_first.{c}").alias(c) for c in extra],
    )


def session_facts(
    bounds: DataFrame,
    channel_rows: DataFrame,
    tv_peaks: DataFrame,
    iso_codes: DataFrame,
    users: DataFrame,
    utm_ids: DataFrame,
    loaded: DataFrame | None = None,
    events: DataFrame | None = None,
    details: bool = True,
) -> DataFrame:
    """One row per session with landing page, place, device, user, channel key and number, duration and bounce.

    `bounds` must bring the LANDING columns, or `events` be given to look them up: they are wide, so they are then joined once, after
    all that is found by other keys. Channel key: the marketing channel of the first event,
    else a TV spot in the same minute, else 'timeout' after an internal referrer, else direct. `users` names the logins of a
    user (the first by name counts), `utm_ids` numbers channel keys. Without `details` the DETAILS are left out and not fetched; all else
    is the same, as the first hit of an identity is decided by them last.
    """
    fresh = bounds
    if loaded is not None:
        fresh = unseen(bounds, loaded, "session_id")
    start = [f"start_{c}" for c in IDENTITY]
    utm = channel_rows.select(
        *[F.col(c).alias(f"start_{c}") for c in IDENTITY], F.col("utm_id").alias("_utm")
    )
    utm = one_per_key(utm, start, [F.col("_utm").asc_nulls_last()])
    peaks = tv_peaks.select(F.col("minute").alias("_minute"), F.col("utm_id").alias("_tv"))
    codes = iso_codes.select(F.lower("country").alias("_country"), "iso_code")
    rows = fresh.join(utm, start, "left")
    rows = one_per_key(
        rows, ["session_id"], [F.col("domain_userid").asc(), F.col("_utm").asc_nulls_last()]
    ).withColumn("_minute", F.date_trunc("minute", "start_collector_tstamp"))
    rows = lookup(rows, one_per_key(peaks, ["_minute"], [F.col("_tv").asc()]), ["_minute"])
    logins = users.filter(F.col("domain_userid").isNotNull()).select("domain_userid", "login_user_id", "onsite_user_id")
    by_name = [F.col("login_user_id").asc_nulls_last(), F.col("onsite_user_id").asc_nulls_last()]
    rows = lookup(rows, one_per_key(logins, ["domain_userid"], by_name), ["domain_userid"])
    if events is not None:
        rows = rows.join(first_hits(events, LANDING if details else PLACE, "start_"), start, "left")
    rows = lookup(
        rows.withColumn("_country", F.lower("geo_country")),
        one_per_key(codes, ["_country"], [F.col("iso_code").asc()]),
        ["_country"],
    )
    own_key = F.coalesce(
        "_utm", "_tv", F.when(F.col("refr_medium") == "internal", F.lit(TIMEOUT)).otherwise(F.lit(DIRECT))
    )
    numbers = utm_ids.groupBy(F.col("utm_id").alias("_key")).agg(F.min("id").alias("_number"))
    rows = lookup(rows.withColumn("_key", own_key), numbers, ["_key"])
    local = berlin_local(F.col("start_collector_tstamp"))
    country = F.lower(F.coalesce("iso_code", F.lit("00")))
    city = F.trim(F.lower(F.coalesce("geo_city", F.lit(""))))
    return rows.select(
        "session_id",
        *start,
        *[f"end_{c}" for c in IDENTITY],
        "domain_userid",
        "login_user_id",
        "onsite_user_id",
        local.alias("start_locale_tstamp"),
        to_did(local).alias("start_did"),
        F.col("_key").alias("utm_id"),
        F.trim(F.lower(F.concat(country, city))).alias("geo_id"),
        F.col("page_url").alias("landing_page_url"),
        F.col("page_title").alias("landing_page_title"),
        F.col("page_urlpath").alias("landing_pagepath"),
        country.alias("country"),
        city.alias("city"),
        *(DETAILS if details else []),
        ((F.unix_micros("end_collector_tstamp") - F.unix_micros("start_collector_tstamp")) / 1e6).alias(
            "duration_seconds"
        ),
        (F.col("events") < 2).alias("is_bounce"),
        (F.col("events") < 2).cast("int").alias("bin_bounce"),
        "events",
        "transactions",
        "page_views",
        F.col("_number").alias("pbi_utm_id"),
    )
