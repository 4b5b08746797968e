"""Files in and out, seals, and helpers of loads."""

import pytest
from pyspark.sql import functions as F

from meterline.functions.scalars import proof_digest
from meterline.operators import load, receipts
from meterline.sources import artifacts
from meterline.streaming import events


def test_lines_go_out_in_order_and_come_back(spark, tmp_path):
    rows = spark.createDataFrame([("b", 2, "l2"), ("a", 9, "l9"), ("b", 1, "é")], "s string, n int, line string").repartition(3)
    artifacts.write_lines(rows, f"file://{tmp_path}/lines", ["s", "n"])
    parts = sorted((tmp_path / "lines").glob("part-*"))
    assert "".join(p.read_text() for p in parts) == "l9\né\nl2\n"
    assert {r.value for r in artifacts.read_lines(spark, f"file://{tmp_path}/lines").collect()} == {"l9", "é", "l2"}


def test_csv_under_a_schema(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k,n\nx,1\ny,\n")
    (tmp_path / "b.csv").write_text("k,n\nx,one\n")
    assert {tuple(r) for r in artifacts.read_csv(spark, f"file://{tmp_path}/a.csv", "k string, n long").collect()} == {("x", 1), ("y", None)}
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|Malformed"):
        artifacts.read_csv(spark, f"file://{tmp_path}/b.csv", "k string, n long").collect()


def test_insert_absent_and_fences(spark):
    target, rows = (spark.createDataFrame(r, "k string, v int") for r in ([("a", 1)], [("a", 2), ("b", 3)]))
    assert {tuple(r) for r in load.insert_absent(target, rows, ["k"]).collect()} == {("a", 1), ("b", 3)}
    receipts.require_none(target.where("v > 5"), "too large")
    with pytest.raises(ValueError, match="too large"):
        receipts.require_none(target, "too large")


def test_facts_of_requests(spark):
    row = spark.createDataFrame([("i", 200, "o", "h"), ("j", 502, "o", "h")], "id string, status_code long, request_object string, event_hash string")
    assert {(r.request_id, r.status_class) for r in load.facts_of(row).collect()} == {("i", "success"), ("j", "failure")}


def test_proofs_keep_fields_apart(spark):
    row = spark.sql("SELECT 'ab' AS a, 'c' AS b, 'a' AS x, 'bc' AS y, CAST(NULL AS string) AS n")
    got = row.select(proof_digest("d", F.col("a"), F.col("b")), proof_digest("d", F.col("x"), F.col("y")), proof_digest("e", F.col("a"), F.col("b")), proof_digest("d", F.col("n"))).head()
    assert len(set(got)) == 4 and all(len(v) == 64 for v in got)


def test_late_rows_inside_the_watermark_count_and_older_ones_do_not(spark, tmp_path):
    day = 86_400_000
    source = f"file://{tmp_path}/in"
    schema = "event_hash string, timestamp_ms long, key_id string, cost_micros long"
    spark.createDataFrame([], schema).write.parquet(source)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    batches = [[("a", 10 * day, "k", 1)], [("b", 10 * day - day // 2, "k", 2), ("a", 10 * day, "k", 1)], [("c", 40 * day, "k", 4)], [("d", 10 * day, "k", 8)], [("e", 80 * day, "k", 16)], [("f", 80 * day, "k", 32)]]
    query = None
    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        query = events.daily(stream).writeStream.format("parquet").option("path", f"file://{tmp_path}/out").option("checkpointLocation", f"file://{tmp_path}/ck").outputMode("append").trigger(availableNow=True).start()
        query.awaitTermination(60)
    got = {(r.day_bucket, r.requests, r.cost_micros) for r in spark.read.parquet(f"file://{tmp_path}/out").collect()}
    assert {(9, 1, 2), (10, 1, 1)} <= got and all(n == 1 for _, n, _ in got) and 8 not in {c for *_, c in got}
