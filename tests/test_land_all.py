"""Raw keeps everything that landed; values are typed later and never lost to a typed parse."""

import os
from datetime import datetime

from pyspark.sql import functions as F

from eligo.operators import flatten
from eligo.operators.latest import latest_per_key
from eligo.plans import batch_jobs as J
from eligo.schemas import Tables
from eligo.sinks import publish
from eligo.sources import landing

HOUR = datetime(2024, 1, 16, 0)
WINDOW = HOUR, datetime(2024, 1, 16, 1)


def write_lines(root, lines, h=HOUR):
    d = os.path.join(root, f"year={h:%Y}", f"month={h:%m}", f"day={h:%d}", f"hour={h:%H}")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, "part-0.json"), "w") as f:
        f.write("\n".join(lines) + "\n")


def snapshot(user, updated, quantity, uses, extra=""):
    return (f'{{"user_id": "{user}", "updated_timestamp_ms": {updated}, {extra}"offers": [{{"offer_id": "o", '
            f'"start_timestamp_ms": "1705363200000", "potentially_eligible_in_future": false, '
            f'"progress": {{"quantity": {quantity}, "uses": {uses}}}}}]}}')


KAFKA = [
    snapshot("u1", 1705363200000, 12.5, 1.5, '"region": {"a": 1}, '),
    snapshot("u2", '"1705363200000"', '"3"', 2),
    snapshot("u3", "1705363200000.0", "null", "null"),
    snapshot("u4", 9223372036854775807, '"x"', 1),
    '{"user_id": "u5", "updated_timestamp',
    "[1]", "null", "plain text", "", "   ",
    '{"user_id": "u6", "updated_timestamp_ms": 1, "offers": "none"}',
]


def test_corrupt_lines_are_kept_and_marked(spark, tmp_dir):
    write_lines(tmp_dir, KAFKA)
    rows = landing.read_window(spark, tmp_dir, *WINDOW).collect()
    assert [r.line for r in rows] == [x for x in KAFKA if x.strip()]
    assert [r.line for r in rows if r.corrupt] == ['{"user_id": "u5", "updated_timestamp', "[1]", "null", "plain text"]
    assert '"region": {"a": 1}' in rows[0].line


def test_kafka_values_survive_the_landing(spark, tmp_dir):
    write_lines(tmp_dir, KAFKA)
    window = landing.read_window(spark, tmp_dir, *WINDOW)
    staged = latest_per_key(flatten.kafka(flatten.landed_fields(window, "kafka")))
    got = {r.user_id: r for r in staged.collect()}
    assert set(got) == {"u1", "u2", "u3", "u4"}
    assert [got[u].quantity for u in ("u1", "u2", "u3", "u4")] == [13, 3, 0, None]
    assert [got[u].uses for u in ("u1", "u2", "u3")] == [2, 2, None]
    assert all(got[u].updated == HOUR and got[u].start_time == HOUR for u in ("u1", "u2", "u3"))
    assert got["u4"].updated is None


def test_kafka_increment_counts_corrupt_lines(spark, tmp_dir):
    land = os.path.join(tmp_dir, "kafka-stream")
    write_lines(land, KAFKA)
    tables = Tables.for_raw_path(os.path.join(tmp_dir, "wh"), land)
    r = J.run_increment(spark, tables, land, *WINDOW)
    assert r.corrupt_lines == 4 and tables.raw.endswith("_kafka")
    raw = spark.read.parquet(tables.raw)
    assert raw.count() == 9 and raw.where(F.col("line").contains("region")).count() == 1
    assert "corrupt lines 4" in publish.logged_batches(spark, tables.batch_log).first().note


def saved(oid, start, end):
    return (f'{{"id": "{oid}", "startTime": {start}, "endTime": {end}, "note": "kept", '
            f'"eligibilityRequirement": {{"latestEndTime": {end}}}}}')


def staged_rows(spark, tables):
    return sorted((r.offer_id, r.start_time, r.hour) for r in J.current_saved_offers(spark, tables).collect())


def test_saved_offers_with_text_and_decimal_epochs(spark, tmp_dir):
    write_lines(tmp_dir + "/land", [saved("o1", 10, 20), saved("o2", "10.0", "20.0"), saved("o3", '"10"', '"20"'), "{"])
    tables = Tables(tmp_dir + "/wh", "legacy")
    J.run_saved_offers(spark, tables, tmp_dir + "/land", *WINDOW)
    rows = staged_rows(spark, tables)
    assert [r[0] for r in rows] == ["o1", "o2", "o3"] and len({r[1] for r in rows}) == 1
    raw = spark.read.parquet(tables.raw_saved_offers)
    assert raw.count() == 4 and raw.where("corrupt").count() == 1
    assert raw.where(F.col("line").contains("kept")).count() == 3


def test_stage_from_the_last_stage_equals_a_full_rebuild(spark, tmp_dir):
    """Windows in and out of order, one re-run with an emptied row, against staging all of raw."""
    import random
    from eligo.operators import offers
    rng = random.Random(5)
    land, tables = tmp_dir + "/land", Tables(tmp_dir + "/wh", "legacy")
    for version, hour in enumerate([3, 1, 4, 3], 1):
        write_lines(land, [saved(f"o{rng.randrange(6)}", rng.randrange(1, 10**12), 10**12) for _ in range(4)],
                    datetime(2024, 1, 16, hour))
        J.run_saved_offers(spark, tables, land, datetime(2024, 1, 16, hour), datetime(2024, 1, 16, hour + 1), version)
        stage = publish.read_batch(spark, tables.stg_saved_offers, version, ["offer_id", "start_time", "hour"])
        full = offers.stage_saved_offers(spark.read.parquet(tables.raw_saved_offers)).select(*stage.columns)
        assert sorted(map(tuple, stage.collect())) == sorted(map(tuple, full.collect()))
