"""A sample of the registered queries next to their SQL; compare.py runs them all."""

from pathlib import Path

import duckdb
import pytest

from clickledger.sources.shapes import DRIVER_TABLES
from clickledger.workload import checks, queries
from compare import canonical

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test data here")


@pytest.mark.parametrize(
    "name",
    ["sessionize", "session_facts", "channel_classify", "attributed_return", "lead_dim", "spend_facts",
     "opportunity_features", "profile_by_city", "upsert_by_key", "sessionize_stream"],
)
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for table in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    mine, theirs = queries()[name](spark, FOLDER).toPandas(), con.execute(checks()[name]).df()
    assert canonical(mine) == canonical(theirs)
