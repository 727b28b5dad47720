"""End to end: saved offers -> init state -> two increments; check invariants."""

import json
import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from eligo.plans import batch_jobs as J
from eligo.schemas import STATE_COLS, Tables
from eligo.sinks import publish

MS_H = 3_600_000


def ms(dt):
    return int((dt - datetime(1970, 1, 1)).total_seconds() * 1000)


def write_hour(root, h, records):
    d = os.path.join(root, f"year={h:%Y}", f"month={h:%m}", f"day={h:%d}", f"hour={h:%H}")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, "part-0.json"), "w") as f:
        for r in records:
            f.write(json.dumps(r) + "\n")


def legacy(user, updated, offers):
    return {"payload": json.dumps({"userId": user, "updated": str(ms(updated)), "offers": offers})}


def off(oid, start, pef=False, pct=0.5, uses=1):
    return {"offerId": oid, "creationTime": ms(start), "audience": True, "banditStatus": "b",
            "experimentStatus": "e", "holdout": False, "startTime": ms(start),
            "endTime": ms(start) + 100 * MS_H, "potentiallyEligibleInFuture": pef,
            "progress": {"uses": uses, "percentage": pct}}


@pytest.fixture()
def world(spark, tmp_dir):
    wh = os.path.join(tmp_dir, "wh")
    so_root = os.path.join(tmp_dir, "saved")
    write_hour(so_root, datetime(2024, 1, 1, 5), [
        {"id": "o1", "startTime": ms(datetime(2024, 1, 1)), "endTime": ms(datetime(2024, 3, 1)),
         "eligibilityRequirement": {"latestEndTime": ms(datetime(2024, 3, 1))}},
        {"id": "o2", "startTime": ms(datetime(2023, 1, 1)), "endTime": ms(datetime(2023, 2, 1)),
         "eligibilityRequirement": {"latestEndTime": ms(datetime(2023, 2, 1))}}])
    tables = Tables(wh, "legacy")
    J.run_saved_offers(spark, tables, so_root, datetime(2024, 1, 1, 0), datetime(2024, 1, 2, 0))

    # initial dump: u1/o1, u2/o1 (active), u3/o2 (expired offer)
    base = {c: None for c in STATE_COLS if c not in ("expiry_status", "batch_id")}
    def dump_row(u, o, fo):
        r = dict(base, user_id=u, offer_id=o, updated=datetime(2024, 1, 1),
                 start_time=datetime(2024, 1, 1), percentage=0.5,
                 potentiallyeligibleinfuture=False, start_time_first_observed=fo, meta="NA")
        return r
    from eligo.schemas import STATE_SCHEMA
    from pyspark.sql import types as T
    sch = T.StructType([f for f in STATE_SCHEMA.fields if f.name in base])
    rows = [dump_row("u1", "o1", datetime(2024, 1, 1)), dump_row("u2", "o1", None),
            dump_row("u3", "o2", None)]
    dump = os.path.join(tmp_dir, "dump", "snapshot=100")
    spark.createDataFrame([tuple(r[c] for c in sch.fieldNames()) for r in rows], sch) \
        .write.parquet(dump)
    return spark, tables, wh, tmp_dir, dump


def test_init_then_two_increments(world):
    spark, tables, wh, tmp_dir, dump = world
    out = J.run_init(spark, tables, dump, date(2024, 2, 1))
    assert out == {"batch_id": 100, "active_rows": 2, "inactive_rows": 1}
    inactive = publish.read_batch(spark, tables.cs_inactive, 100).collect()
    assert [(r.user_id, r.expiry_status) for r in inactive] == [("u3", "expired")]

    land = os.path.join(tmp_dir, "landing")
    write_hour(land, datetime(2024, 1, 10, 3), [
        legacy("u1", datetime(2024, 1, 10, 3), [off("o1", datetime(2024, 1, 9))]),   # M2
        legacy("u4", datetime(2024, 1, 10, 3), [off("o1", datetime(2024, 1, 9))]),   # N1
        {"payload": "not json"}])
    r1 = J.run_increment(spark, tables, land, datetime(2024, 1, 10, 0), datetime(2024, 1, 10, 6))
    assert r1.batch_id == 2024011006 and r1.previous_batch_id == 100
    assert r1.rule_counts == {"M2": 1, "N1": 1}
    st = {(r.user_id, r.offer_id): r for r in J.read_state(spark, tables).collect()}
    assert set(st) == {("u1", "o1"), ("u2", "o1"), ("u4", "o1")}
    assert st[("u1", "o1")].start_time_recently_observed == datetime(2024, 1, 1)
    assert st[("u2", "o1")].batch_id == 2024011006

    # second window: a stale version for u1 and a gap for u2 (pef with first_observed set later)
    write_hour(land, datetime(2024, 1, 11, 1), [
        legacy("u1", datetime(2024, 1, 9), [off("o1", datetime(2024, 1, 9))]),       # stale
        legacy("u2", datetime(2024, 1, 11, 1), [off("o1", datetime(2024, 1, 9), pef=True)])])  # M4
    r2 = J.run_increment(spark, tables, land, datetime(2024, 1, 11, 0), datetime(2024, 1, 11, 6),
                         compact_rows_per_file=2)
    assert r2.rule_counts == {"stale": 1, "M4": 1}
    st2 = J.read_state(spark, tables)
    assert st2.count() == 3
    assert st2.select("user_id", "offer_id").distinct().count() == 3
    assert {r.batch_id for r in st2.collect()} == {2024011106}

    # the current tables as SQL views, named like the tables
    names = J.register_views(spark, tables)
    assert "offer_eligibility_snapshots_current_state_active" in names
    n = spark.sql("SELECT count(*) AS n FROM offer_eligibility_snapshots_current_state_active").first().n
    assert n == 3
    assert spark.sql("SELECT offer_id FROM saved_offers ORDER BY offer_id").collect()[0].offer_id == "o1"

    # a batch id that is not after the last one is refused
    with pytest.raises(ValueError):
        J.run_increment(spark, tables, land, datetime(2024, 1, 10, 0), datetime(2024, 1, 10, 6), 2024011106)
    # without a wanted id an earlier window is run again, as the next version
    late = J.run_increment(spark, tables, land, datetime(2024, 1, 10, 0), datetime(2024, 1, 10, 6))
    assert late.batch_id == 2024011107 and J.read_state(spark, tables).count() == 3


def test_hours_that_no_longer_land_are_removed(spark, tmp_dir):
    land, tables = os.path.join(tmp_dir, "land"), Tables(os.path.join(tmp_dir, "wh"), "legacy")
    for h in (1, 2):
        write_hour(land, datetime(2024, 1, 10, h), [legacy(f"u{h}", datetime(2024, 1, 10), [off("o", datetime(2024, 1, 1))])])
    window = datetime(2024, 1, 10, 0), datetime(2024, 1, 10, 4)

    def landed():
        return J.land_window(spark, land, *window, tables.raw).count()

    assert landed() == 2
    os.remove(os.path.join(land, "year=2024", "month=01", "day=10", "hour=02", "part-0.json"))
    assert landed() == 1
    assert spark.read.parquet(tables.raw).count() == 1


def test_late_rows_of_an_earlier_window(spark, tmp_dir):
    """Windows 1, 2, then 1 again with a late file: the late key joins, the fresher row of window 2 stays."""
    land, tables = os.path.join(tmp_dir, "land"), Tables(os.path.join(tmp_dir, "wh"), "legacy")
    d = datetime(2024, 1, 10)
    write_hour(land, datetime(2024, 1, 10, 1), [legacy("u1", d, [off("o", d)])])
    write_hour(land, datetime(2024, 1, 10, 2), [legacy("u1", datetime(2024, 1, 11), [off("o", datetime(2024, 1, 11))])])
    one, two = (d.replace(hour=1), d.replace(hour=2)), (d.replace(hour=2), d.replace(hour=3))
    ids = [J.run_increment(spark, tables, land, *w).batch_id for w in (one, two)]
    write_hour(land, datetime(2024, 1, 10, 1), [legacy("u1", d, [off("o", d)]), legacy("u9", d, [off("o", d)])])
    ids.append(J.run_increment(spark, tables, land, *one).batch_id)
    assert ids == [2024011002, 2024011003, 2024011004]
    state = {r.user_id: r.start_time for r in J.read_state(spark, tables).collect()}
    assert set(state) == {"u1", "u9"} and state["u1"] > state["u9"]


def test_refused_version_writes_nothing(world, spark, tmp_dir):
    _, tables, _, _, _ = world
    before = spark.read.parquet(tables.raw_saved_offers).count()
    with pytest.raises(ValueError):
        J.run_saved_offers(spark, tables, os.path.join(tmp_dir, "saved"), datetime(2024, 1, 1, 4),
                           datetime(2024, 1, 1, 6), 5)
    assert spark.read.parquet(tables.raw_saved_offers).count() == before


def test_stopped_init_leaves_no_rows_to_another_snapshot(world, monkeypatch):
    spark, tables, wh, tmp_dir, dump = world
    real = publish.write_batch
    monkeypatch.setattr(publish, "write_batch", lambda *a: (_ for _ in ()).throw(RuntimeError("stopped")))
    with pytest.raises(RuntimeError):
        J.run_init(spark, tables, dump, date(2024, 2, 1))
    monkeypatch.setattr(publish, "write_batch", real)
    other = os.path.join(tmp_dir, "dump", "snapshot=101")
    spark.read.parquet(dump).where("user_id = 'u2'").write.parquet(other)
    got = J.run_init(spark, tables, other, date(2024, 2, 1))
    assert got == {"batch_id": 101, "active_rows": 1, "inactive_rows": 0}
    assert [r.user_id for r in J.read_state(spark, tables).collect()] == ["u2"]


def test_rerun_of_failed_batch_is_invisible(world):
    spark, tables, wh, tmp_dir, dump = world
    J.run_init(spark, tables, dump, date(2024, 2, 1))
    # a half-written batch that was never logged
    half = (publish.read_batch(spark, tables.cs_active, 100).limit(1)
            .withColumn("batch_id", F.lit(2024011006).cast("bigint")))
    publish.write_batch(half, tables.cs_active, 2024011006)
    assert J.read_state(spark, tables).count() == 2
    assert {r.batch_id for r in J.read_state(spark, tables).collect()} == {100}


def test_tables_in_the_catalog(world):
    """Jobs' tables by name: raw hours of the window, published batches only, and again without harm."""
    spark, tables, wh, tmp, dump = world
    J.run_init(spark, tables, dump, date(2024, 1, 1))
    land = os.path.join(tmp, "elig")
    start, end = datetime(2024, 1, 2, 0), datetime(2024, 1, 2, 2)
    write_hour(land, start, [legacy("u1", datetime(2024, 1, 2, 0, 5), [off("o1", datetime(2024, 1, 2))])])
    try:
        res = J.run_increment(spark, tables, land, start, end)
        publish.write_batch(J.read_state(spark, tables).withColumn("batch_id", F.lit(res.batch_id + 1)),
                            tables.cs_active, res.batch_id + 1)          # never logged
        for _ in range(2):
            names = J.register_tables(spark, tables, "eligo_cat", start, end)
        base = tables.cs_active.rsplit("/", 1)[-1]
        assert f"eligo_cat.{base}" in names and "eligo_cat.saved_offers" in names
        by_batch = {r[0]: r[1] for r in spark.table(f"eligo_cat.{base}").groupBy("batch_id").count().collect()}
        assert set(by_batch) == {100, res.batch_id} and by_batch[res.batch_id] == res.audit.rows
        raw = spark.table("eligo_cat." + tables.raw.rsplit("/", 1)[-1])
        assert raw.count() == 1 and raw.where("hour = 1").count() == 0
    finally:
        spark.sql("DROP DATABASE IF EXISTS eligo_cat CASCADE")


def test_dump_path_batch_id():
    assert J.batch_id_from_dump_path("s3://b/dump/snapshot=2024120100/") == 2024120100
    with pytest.raises(ValueError):
        J.batch_id_from_dump_path("s3://b/dump/latest")


def test_rerunning_a_window_changes_no_row(world):
    spark, tables, wh, tmp_dir, dump = world
    J.run_init(spark, tables, dump, date(2024, 2, 1))
    land = os.path.join(tmp_dir, "landing")
    write_hour(land, datetime(2024, 1, 10, 3), [
        legacy("u1", datetime(2024, 1, 10, 3), [off("o1", datetime(2024, 1, 9))]),
        legacy("u4", datetime(2024, 1, 10, 3), [off("o1", datetime(2024, 1, 9), pef=True)])])
    win = (datetime(2024, 1, 10, 0), datetime(2024, 1, 10, 6))
    J.run_increment(spark, tables, land, *win, batch_id=200)
    first = J.read_state(spark, tables).drop("batch_id")
    r = J.run_increment(spark, tables, land, *win, batch_id=201)
    assert set(r.rule_counts) == {"stale"}                 # nothing is fresher the second time
    second = J.read_state(spark, tables).drop("batch_id")
    key = lambda df: sorted(tuple(str(v) for v in row) for row in df.collect())
    assert key(first) == key(second)


def test_cli_saved_offers_runs(tmp_dir):
    import subprocess
    import sys
    root = os.path.join(tmp_dir, "land")
    write_hour(root, datetime(2024, 1, 1, 5), [
        {"id": "o1", "startTime": 1, "endTime": 2, "eligibilityRequirement": {"latestEndTime": 3}}])
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run(
        [sys.executable, os.path.join(repo, "jobs", "saved_offers.py"), "-r", root,
         "-s", "2024-01-01 00", "-e", "2024-01-02 00", "-w", os.path.join(tmp_dir, "wh"),
         "--origin", "legacy"],
        capture_output=True, text=True, timeout=600,
        env=dict(os.environ, PYSPARK_SUBMIT_ARGS="--master local[2] --conf spark.ui.enabled=false pyspark-shell"))
    assert out.returncode == 0, out.stderr[-2000:]
    assert "saved offers: 1 rows" in out.stdout
    bad = subprocess.run(
        [sys.executable, os.path.join(repo, "jobs", "saved_offers.py"), "-r", root,
         "-s", "2024-01-02 00", "-e", "2024-01-01 00", "-w", os.path.join(tmp_dir, "wh")],
        capture_output=True, text=True, timeout=600)
    assert bad.returncode != 0


@pytest.mark.parametrize("script", ["saved_offers.py", "init_state.py", "eligibility_incremental.py"])
def test_cli_help(script):
    import subprocess
    import sys
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, os.path.join(repo, "jobs", script), "--help"],
                         capture_output=True, text=True, timeout=120)
    assert out.returncode == 0 and "--raw-data" in out.stdout
