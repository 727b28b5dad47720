"""Results do not depend on the session time zone or on ANSI mode."""

import os

import pytest

import __spark_entry__ as E
from tools.oracle_check import canon

SF = "/root/testdata/sf0.001"
QUERIES = ["q_epoch_to_ts", "q_chicago_time", "q_offer_stage", "q_typed_progress",
           "q_flatten_legacy", "q_hour_window", "q_path_parts", "q_state_batch",
           "q_expiry_status"]
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.mark.parametrize("name", QUERIES)
def test_zone_and_ansi_independent(spark, name):
    results = []
    for zone, ansi in [("UTC", "true"), ("America/New_York", "false"), ("Asia/Kolkata", "true")]:
        spark.conf.set("spark.sql.session.timeZone", zone)
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            df = E.queries()[name](spark, SF)
            results.append(canon([tuple(r) for r in df.collect()], df.columns))
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            spark.conf.set("spark.sql.ansi.enabled", "true")
    assert results[0] == results[1] == results[2]
