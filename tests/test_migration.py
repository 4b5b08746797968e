"""Small cases of corrections, snapshots, extraction and references, with nulls, empties and ties."""

import gzip
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from meterline.functions import scalars
from meterline.operators import archive, correction, extraction, graph, load, references, snapshots


def test_ordered_digests_stream_over_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = spark.range(200).selectExpr("CAST(id % 3 AS string) AS session_id", "lpad(CAST(id AS string), 4, '0') AS request_id", "IF(id = 5, null, concat('l', id, '\n')) AS line")
        got = {r.session_id: (r.records, r.sha256) for r in snapshots.ordered_digests(rows).collect()}
        chained = {r.session_id: r.sha256 for r in snapshots.chained_digests(rows, "session_id", ("request_id",), "line").collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for k in range(3):
        lines = ["" if i == 5 else f"l{i}\n" for i in range(k, 200, 3)]
        assert got[str(k)] == (len(lines), hashlib.sha256("".join(lines).encode()).hexdigest())
        state = ""
        for line in lines:
            state = hashlib.sha256((state + line).encode()).hexdigest()
        assert chained[str(k)] == state
    assert snapshots.ordered_digests(rows.where("false")).count() == 0
    none = spark.createDataFrame([], "session_id string, first_at long, last_at long, requests long, deleted boolean, records_sha256 string, deleted_at long")
    assert snapshots.session_set_digest(none).head() == (0, hashlib.sha256(b"[]").hexdigest())


def test_pages(spark):
    rows = spark.createDataFrame([(1, 5), (2, 5), (3, 7), (4, 7), (5, 1)], "id long, at long")
    assert [r.id for r in snapshots.page_after(rows, ["at", "id"], (5, 1), 2).collect()] == [2, 3]
    page = snapshots.latest_page(rows, "at", "id", 2).orderBy(F.col("at").desc(), F.col("id").desc()).collect()
    assert [(r.id, r.has_more) for r in page] == [(4, True), (3, True)]
    assert {r.has_more for r in snapshots.latest_page(rows, "at", "id", 900).collect()} == {False} and snapshots.latest_page(rows, "at", "id", 0).count() == 1


def test_checkpoint_counts_claims_and_never_goes_back(spark):
    events = spark.createDataFrame([(5, "a"), (5, "c"), (5, "b")], "timestamp_ms long, event_hash string")
    claimed = spark.createDataFrame([("x",)], "id string")
    assert load.checkpoint(events, claimed, 3, "old", 10).head() == (5, "c", 11)
    assert load.checkpoint(events, claimed, 5, "zz", 10).head() == (5, "c", 11)
    assert load.checkpoint(events, claimed.where("false"), 9, "old", 10).head() == (9, "old", 10)
    assert load.checkpoint(events.where("false"), claimed.where("false"), 9, "old", 10).head() == (9, "old", 10)


def test_gap_replacement_and_names(spark):
    rows = spark.createDataFrame([("gap://x", "n"), ("o", "o"), ("o", "n"), ("o", None), (None, "n")], "now string, new string")
    got = [tuple(r) for r in rows.select(*references.gap_replacement(F.col("now"), F.col("new"))).collect()]
    assert got == [("n", False), ("o", False), ("o", True), ("o", False), (None, True)]
    p = spark.createDataFrame([(" /a/ ",), ("a/b",), ("",), (None,), ("//",)], "p string").select(references.route_prefix(F.col("p")).alias("p")).collect()
    assert [r.p for r in p] == ["a", None, None, None, None]


def test_stale_rows_are_not_corrected(spark):
    names = ("input_tokens", "cached_input_tokens", "cache_write_tokens", "cost_micros")
    target = spark.createDataFrame([("r1", 1, 0, 0, 5, "default"), ("r2", 1, 0, 0, 6, "default"), ("r3", 1, 0, 0, 5, "default")], f"request_id string, {', '.join(n + ' long' for n in names)}, service_tier string")
    rows = spark.createDataFrame([("r1",), ("r2",)], "request_id string")
    for c, old, new in zip((*names, "service_tier"), (1, 0, 0, 5, "default"), (9, 2, 0, 7, "flex")):
        rows = rows.withColumn(f"old_{c}", F.lit(old)).withColumn(c, F.lit(new))
    got = {r.request_id: (r.cost_micros, r.service_tier, r.outcome) for r in correction.apply(target, rows).collect()}
    assert got == {"r1": (7, "flex", "changed"), "r2": (6, "default", "stale"), "r3": (5, "default", "kept")}


def test_long_conversations_take_linear_time(spark):
    turns = spark.range(40_000).selectExpr("1L AS conv_id", "id AS turn", "'user' AS role", "IF(id = 7, null, concat('t', id)) AS text")
    nodes = graph.context_nodes(turns)
    assert nodes.agg(F.max("depth"), F.countDistinct("node_hash")).head() == (39_999, 40_000)


def test_clean_codes_credentials_and_clocks(spark):
    row = spark.sql("SELECT 'Bad Code: é' AS c, 'sha256:' || upper(repeat('ab', 32)) AS h, TIMESTAMP_NTZ'1969-12-31 23:59:59.5' AS t, '' AS e")
    got = row.select(scalars.clean_error_code(F.col("c")), scalars.credential_hash(F.col("h")), scalars.credential_hash(F.col("e")), scalars.epoch_ms(F.col("t"))).head()
    assert tuple(got) == ("bad_code:__", "ab" * 32, None, -500)
    with pytest.raises(Exception, match="malformed credential hash"):
        row.select(scalars.credential_hash(F.col("c"))).collect()


def test_labels_and_usage_bear_anything(spark):
    texts = [None, "", "[]", '{"a":"x","token_1":"y","b":{"c":1},"d":null,"e":" "}', "{broken"]
    got = [r.n for r in spark.createDataFrame([(t,) for t in texts], "t string").select(F.map_keys(extraction.labels(F.col("t"))).alias("n")).collect()]
    assert got[3] == ["a"] and all(not x for k, x in enumerate(got) if k != 3)
    shapes = ['{"usage":{"input_tokens":1.5,"output_tokens":2}}', '{"usage":[]}', '{"response":{"usage":null},"usage":{"input_tokens":1,"output_tokens":2}}', None, '{"usage":{"input_tokens":3,"output_tokens":4}}']
    rows = spark.createDataFrame([(t,) for t in shapes], "t string").select(*extraction.usage(F.col("t"))).collect()
    assert [tuple(r) for r in rows] == [(0, 0), (0, 0), (0, 0), (0, 0), (3, 4)]


def test_correlation_breaks_ties_by_tokens(spark):
    records = spark.createDataFrame([(1, "x", 0, "m", "m", "k", 5, 6)], "record_id long, external_id string, started_at long, requested_model string, resolved_model string, key_id string, input_tokens long, output_tokens long")
    request = lambda *t: spark.createDataFrame([("x", 10, "m", "k", *pair) for pair in t], "external_id string, created_at long, model string, key_id string, input_tokens long, output_tokens long")
    outcome = lambda *t: archive.correlate(records, request(*t)).head().disposition
    assert outcome((5, 6), (5, 7)) == "exact" and outcome((5, 6), (5, 6)) == "ambiguous" and outcome((0, 0)) == "exact"
