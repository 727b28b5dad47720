"""Hour windows over a partitioned JSON landing."""

import json
import os
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from eligo.functions.paths import hour_window, path_parts
from eligo.sources.landing import SAVED_OFFER_LANDING_SCHEMA, read_window


def make_landing(root, hours):
    for h in hours:
        d = os.path.join(root, f"year={h:%Y}", f"month={h:%m}", f"day={h:%d}", f"hour={h:%H}")
        os.makedirs(d, exist_ok=True)
        with open(os.path.join(d, "part-0.json"), "w") as f:
            f.write(json.dumps({"id": f"{h:%Y%m%d%H}", "startTime": 1, "endTime": 2}) + "\n")


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_window_across_month_end_is_two_hours(spark, tmp_dir):
    hours = [datetime(2024, 1, 31, 22), datetime(2024, 1, 31, 23), datetime(2024, 2, 1, 0),
             datetime(2024, 2, 1, 1)]
    make_landing(tmp_dir, hours)
    df = read_window(spark, tmp_dir, datetime(2024, 1, 31, 23), datetime(2024, 2, 1, 1),
                     SAVED_OFFER_LANDING_SCHEMA)
    assert ids(df) == ["2024013123", "2024020100"]
    r = df.where(F.col("id") == "2024020100").collect()[0]
    assert (r["year"], r["month"], r["day"], r["hour"]) == (2024, 2, 1, 0)
    assert r["file_path"].endswith("hour=00/part-0.json")


def test_window_across_year_end_and_missing_hour(spark, tmp_dir):
    hours = [datetime(2023, 12, 31, 22), datetime(2024, 1, 1, 0), datetime(2024, 1, 1, 2)]
    make_landing(tmp_dir, hours)      # 2023-12-31 23h and 2024-01-01 01h are missing
    df = read_window(spark, tmp_dir, datetime(2023, 12, 31, 22), datetime(2024, 1, 1, 3),
                     SAVED_OFFER_LANDING_SCHEMA)
    assert ids(df) == ["2023123122", "2024010100", "2024010102"]


@pytest.mark.parametrize("days", [5, 15, 40])
def test_stray_directories_and_invalid_dates_are_not_read(spark, tmp_dir, days):
    make_landing(tmp_dir, [datetime(2024, 2, 28, 1)])
    for d in ("manual", "year=2024/month=02/day=30/hour=01"):
        Path(tmp_dir, d).mkdir(parents=True)
        Path(tmp_dir, d, "part-0.json").write_text('{"id": "stray"}\n')
    start = datetime(2024, 2, 27)
    df = read_window(spark, tmp_dir, start, start + timedelta(days=days), SAVED_OFFER_LANDING_SCHEMA)
    assert ids(df) == ["2024022801"]


def test_adjacent_windows_partition_the_landing(spark, tmp_dir):
    hours = [datetime(2024, 3, 1, h) for h in range(24)]
    make_landing(tmp_dir, hours)
    cuts = [datetime(2024, 3, 1, 0), datetime(2024, 3, 1, 5), datetime(2024, 3, 1, 17),
            datetime(2024, 3, 2, 0)]
    got = []
    for a, b in zip(cuts, cuts[1:]):
        got += ids(read_window(spark, tmp_dir, a, b, SAVED_OFFER_LANDING_SCHEMA))
    assert sorted(got) == sorted(f"{h:%Y%m%d%H}" for h in hours)


def test_window_is_a_partition_filter(spark, tmp_dir):
    make_landing(tmp_dir, [datetime(2024, 3, 1, 1)])
    df = read_window(spark, tmp_dir, datetime(2024, 3, 1, 0), datetime(2024, 3, 1, 2),
                     SAVED_OFFER_LANDING_SCHEMA)
    from tests.helpers import explain
    scan = [ln for ln in explain(df).splitlines() if ln.startswith("PartitionFilters")]
    assert scan and "2024030100" in scan[0] and "year" in scan[0]


def test_empty_window_rejected():
    import pytest
    with pytest.raises(ValueError):
        hour_window(datetime(2024, 1, 2), datetime(2024, 1, 1))


def test_path_parts_missing_segment_is_null(spark):
    df = spark.createDataFrame([("s3://x/year=2024/month=01/day=15/f.json",)], "file_path string")
    r = df.select(*[c.alias(n) for n, c in path_parts("file_path").items()]).collect()[0]
    assert (r["year"], r["month"], r["day"], r["hour"]) == (2024, 1, 15, None)


def test_window_without_data_is_empty(spark, tmp_dir):
    make_landing(tmp_dir, [datetime(2024, 3, 1, 1)])
    df = read_window(spark, tmp_dir, datetime(2024, 5, 1, 0), datetime(2024, 5, 1, 2),
                     SAVED_OFFER_LANDING_SCHEMA)
    assert df.count() == 0 and "hour" in df.columns and "file_path" in df.columns


def test_only_window_days_are_listed():
    from eligo.sources.landing import window_days
    assert window_days(datetime(2024, 1, 31, 23), datetime(2024, 2, 1, 1)) == [
        "year=2024/month=01/day=31", "year=2024/month=1/day=31",
        "year=2024/month=02/day=01", "year=2024/month=02/day=1",
        "year=2024/month=2/day=01", "year=2024/month=2/day=1"]
    assert window_days(datetime(2024, 11, 30, 22), datetime(2024, 12, 1, 0)) == [
        "year=2024/month=11/day=30"]
