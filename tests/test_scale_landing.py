"""The JSON landing of the job queries is written by all tasks."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from eligo.plans import standins as S


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lines_are_made_after_the_shuffle_by_hour(spark):
    """The events' columns cross it, not their JSON; an hour stays in one task."""
    events = spark.createDataFrame(
        [(i, datetime(2024, 1, 1) + timedelta(minutes=7 * i), i, "error" if i % 5 == 0 else "view", 1.5, '{"k": 3}') for i in range(300)],
        "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    dealt = S.by_landing_hour(events)
    for lines in (S.kafka_landing, S.legacy_payloads, S.saved_offer_landing):
        text = plan(lines(dealt))
        assert "Exchange hashpartitioning" in text
        assert "to_json" not in text[text.index("Exchange hashpartitioning"):].split("\n", 1)[1]
        assert sorted(map(tuple, lines(dealt).collect())) == sorted(map(tuple, lines(events).collect()))
    per_hour = S.kafka_landing(dealt).withColumn("p", F.spark_partition_id()).groupBy("month", "day", "hour").agg(
        F.countDistinct("p").alias("n"))
    assert per_hour.agg(F.max("n")).first()[0] == 1
