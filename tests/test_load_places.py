"""Loads of events that lie by a place: the rows of the plain way, without a further shuffle."""

import pytest
from pyspark.sql import functions as F

from meterline.operators import load
from meterline.sources import tables

PLACE = ("order_key",)
COLUMNS = "order_key long, event_hash string, timestamp_ms long, request_id string, n long"
ROWS = [
    (1, "a", 1, "r", 10), (1, "a", 2, "r", 11), (1, "a", 2, "r", 11), (1, "b", 1, "r", 12), (1, "b", 1, "r", 13), (1, "b", 5, "r", 14),
    (2, "c", 3, "q", 15), (2, "c", 3, "r", 15), (2, "d", 9, "r", 16), (3, "e", 9, "r", 17), (3, None, 1, "r", 18), (4, "f", 2, "r", 19),
]


@pytest.fixture(scope="module")
def staged(spark):
    return load.with_digest(spark.createDataFrame(ROWS, COLUMNS).repartition(4, *PLACE), *PLACE)


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def rows(df, *names):
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


def identified(df):
    return df.withColumn("id", load.request_id("t", "s"))


def test_rows_of_a_place_are_accepted_and_claimed_where_they_lie(spark, staged):
    held = identified(spark.createDataFrame([(1, "a"), (3, "e"), (1, "f")], "order_key long, event_hash string").repartition(4, *PLACE))
    near, plain = identified(load.accepted(staged, "timestamp_ms", "n", place=PLACE)), identified(load.accepted(staged, "timestamp_ms", "n"))
    names = ["event_hash", "timestamp_ms", "n"]
    assert rows(near, *names) == rows(plain, *names) == [("a", 2, 11), ("d", 9, 16), ("e", 9, 17), ("f", 2, 19), (None, 1, 18)]
    new = load.claim(near, held, PLACE)
    # an id is claimed at its event's own place; ("f", place 1) is no event
    assert rows(new, *names) == [("d", 9, 16), ("f", 2, 19), (None, 1, 18)]
    assert exchanges(new) == 2  # those that laid rows and claims by their place


def test_conflicts_and_copies_of_a_place(staged):
    assert rows(load.conflicts(staged, PLACE), "event_hash", "copies", "payloads") == rows(load.conflicts(staged), "event_hash", "copies", "payloads")
    assert load.duplicates_removed(staged, PLACE).head() == load.duplicates_removed(staged).head() == (12, 7, 5)


def test_changed_events_meet_their_links_in_buckets(spark, staged):
    tables.shared_checkpoints(spark)
    written = tables.bucketed(load.canonical(staged, "source_digest", place=PLACE), *PLACE)
    links = written.select(*PLACE, "event_hash", F.when(F.col("event_hash").isin("a", "c"), "x").when(F.col("event_hash") == "d", "").otherwise(F.col("source_digest")).alias("source_digest"))
    near = load.changed_since(written, links, PLACE)
    assert rows(near, "event_hash") == rows(load.changed_since(written, links), "event_hash") == [("a",), ("c",)]
    assert exchanges(near) == 0  # buckets are read as they lie


def test_marked_events_give_the_checkpoint_in_one_pass(spark, staged):
    new = identified(load.accepted(staged, "timestamp_ms", place=PLACE).where("event_hash IS NOT NULL"))
    held = identified(spark.createDataFrame([(1, "a"), (4, "f"), (1, "e")], "order_key long, event_hash string"))
    once = load.checkpoint(load.marked(new, held, PLACE), None, 1, "", 7)
    assert once.head() == load.checkpoint(new, load.claim(new, held, PLACE), 1, "", 7).head() == (9, "e", 9)
    assert load.checkpoint(load.marked(new.where("false"), held, PLACE), None, 3, "old", 7).head() == (3, "old", 7)
    assert "Join Cross" not in once._jdf.queryExecution().optimizedPlan().toString()
