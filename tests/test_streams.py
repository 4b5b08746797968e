"""Stateful streams: late rows, restarts, and every outcome."""

import pytest
from pyspark.sql import Row

from meterline.plans import streams
from meterline.streaming import state

SCHEMA = "request long, at_ms long, seq long, digest string"


def told(spark, folder):
    return sorted(tuple(r) for r in spark.read.parquet(f"{folder}/out").collect())


def arrive(spark, folder, n, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{folder}/in/{n}")
    stream = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(f"{folder}/in")
    state.take(state.outcomes(stream, "request", state.Claims, "10 seconds"), f"{folder}/out", f"{folder}/checkpoint")


def test_late_rows_and_restarts(spark, tmp_path):
    folder = str(tmp_path)
    arrive(spark, folder, 0, [(1, 20_000, 5, "b"), (2, 21_000, 6, "x")])
    assert told(spark, folder) == []  # the watermark is behind both
    arrive(spark, folder, 1, [(1, 15_000, 9, "a"), (2, 21_000, 2, "y"), (3, 40_000, 7, "z")])  # earlier rows of keys that wait
    assert told(spark, folder) == [(1, 15_000, 9, "claimed", 9), (1, 20_000, 5, "conflict", 9), (2, 21_000, 2, "claimed", 2), (2, 21_000, 6, "conflict", 2)]
    arrive(spark, folder, 2, [(1, 1_000, 1, "b"), (1, 41_000, 8, "a"), (4, 99_000, 10, "end")])  # the first is later than the delay
    assert told(spark, folder)[2:] == [(1, 41_000, 8, "replay", 9), (2, 21_000, 2, "claimed", 2), (2, 21_000, 6, "conflict", 2), (3, 40_000, 7, "claimed", 7)]
    assert spark.conf.get(state.STORE) != state.ROCKS


@pytest.mark.parametrize("name,expected", [
    ("stream_claims", {"claimed", "replay", "conflict"}),
    ("stream_quarantine", {"new", "again", "returned", "replay", "conflict", "resolved", "dismissed", "not found"}),
    ("stream_chains", {"baseline", "no baseline", "next", "replay", "conflict", "invalid"}),
])
def test_every_outcome_occurs(spark, tmp_path_factory, name, expected):
    """In the SQL, which test_oracle.py holds the stream against."""
    from tests.compare import duck_connection

    db = duck_connection("/root/testdata/sf0.01")
    assert {r[0] for r in db.execute(f"SELECT DISTINCT outcome FROM ({streams.ORACLE_SQL[name]}) t").fetchall()} == expected


def test_empty_table(spark, tmp_path):
    spark.read.parquet("/root/testdata/sf0.001/events.parquet").limit(0).write.parquet(f"{tmp_path}/events.parquet")
    assert streams.stream_claims(spark, str(tmp_path)).count() == 0


def test_calls_to_the_state_follow_slots_not_rows():
    """Three thousand rows of a key in a second cost a few calls and one timer."""

    class Held(dict):
        calls = 0

        def containsKey(self, k):  # noqa: N802
            Held.calls += 1
            return k in self

        def getValue(self, k):  # noqa: N802
            Held.calls += 1
            return self[k]

        def updateValue(self, k, v):  # noqa: N802
            Held.calls += 1
            self[k] = v

        def removeKey(self, k):  # noqa: N802
            del self[k]

        def exists(self):
            return () in self

        def get(self):
            return self[()]

        def update(self, v):
            Held.calls += 1
            self[()] = v

    class Handle:
        timers = []

        def getValueState(self, *_):  # noqa: N802
            return Held()

        def getMapState(self, *_):  # noqa: N802
            return Held()

        def registerTimer(self, at):  # noqa: N802
            self.timers.append(at)

    class Timer:
        getExpiryTimeInMs = staticmethod(lambda: 60_001)  # noqa: N815
        getCurrentWatermarkInMs = staticmethod(lambda: 62_000)  # noqa: N815

    claims = state.Claims()
    claims.init(Handle())
    rows = [Row(request=1, at_ms=60_000 + k, seq=k, digest="d", event_time=None) for k in range(3000, 0, -1)]
    claims.handleInputRows((1,), iter(rows), None)
    told = list(claims.handleExpiredTimer((1,), Timer, Timer))
    assert [r.seq for r in told] == list(range(1, 2001)) and [r.outcome for r in told[:2]] == ["claimed", "replay"]
    assert Handle.timers == [60_001, 62_001] and Held.calls < 20
