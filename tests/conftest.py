import sys
from datetime import datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from clickledger.operators.skew import HotKeyRule  # noqa: E402
from clickledger.session import clear_steps, local_session  # noqa: E402

# every key with more than two rows is hot
TINY = HotKeyRule(max_rows=2)


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", "4", shuffle_partitions=4)
    yield session
    clear_steps(session)


def ts(text: str) -> datetime:
    return datetime.fromisoformat(text)


def rows(df, *order):
    """Rows as dicts, in the order of some columns."""
    return [r.asDict() for r in (df.orderBy(*order) if order else df).collect()]


def values(df, column, *order):
    return [r[column] for r in rows(df, *order)]


def same(a, b) -> bool:
    columns = sorted(a.columns)
    assert columns == sorted(b.columns)

    def all_of(df):
        return sorted(map(repr, df.select(*columns).collect()))

    return all_of(a) == all_of(b)


EVENT_SCHEMA = (
    "event_id string, event_fingerprint string, event string, app_id string, collector_tstamp timestamp, "
    "derived_tstamp timestamp, domain_userid string, domain_sessionid string, tr_orderid string, "
    "br_renderengine string, refr_medium string, refr_urlhost string, page_referrer string, "
    "page_url string, page_urlhost string, page_urlpath string, page_title string, mkt_source string, "
    "mkt_medium string, mkt_campaign string, mkt_term string, mkt_content string, mkt_clickid string, "
    "geo_country string, geo_city string, dvce_type string, geo_zipcode string, geo_latitude double, "
    "geo_longitude double, geo_region_name string, useragent string, br_name string, br_family string, "
    "br_version string, br_type string, br_lang string, br_features_pdf boolean, br_viewwidth int, "
    "br_viewheight int, os_name string, os_family string, dvce_ismobile boolean, dvce_screenwidth int, "
    "dvce_screenheight int"
)


def make_events(spark, *given):
    """Web events from the fields that matter; the rest is plain."""
    names = [part.split()[0] for part in EVENT_SCHEMA.split(", ")]
    out = []
    for i, fields in enumerate(given):
        event = {
            "event_id": f"e{i}",
            "event": "page_view",
            "app_id": "web",
            "domain_userid": "u",
            "domain_sessionid": "s",
            "br_renderengine": "webkit",
            "refr_medium": "internal",
            "page_url": "https://x.com/",
        } | fields
        at = ts(event.pop("at"))
        event.setdefault("event_fingerprint", "f" + event["event_id"])
        event.setdefault("derived_tstamp", at)
        out.append(tuple({**dict.fromkeys(names), **event, "collector_tstamp": at}[n] for n in names))
    return spark.createDataFrame(out, EVENT_SCHEMA)
