"""Offsets and session breaks over files cut into small splits, against plain Python."""

import json
import random

import pytest
from pyspark.sql import functions as F

from meterline.operators import line_checks
from meterline.sources.lines import numbered_lines


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "97")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    spark.sparkContext.setCheckpointDir(spark.conf.get("spark.checkpoint.dir"))
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_offsets_whatever_the_splits(spark, tmp_path, small_splits):
    rng = random.Random(3)
    want = {}
    for name, end in (("a", ""), ("b", "\n"), ("c", "\n\n"), ("d", "é"), ("one", "")):
        lines = ["" if rng.random() < 0.2 else "é\r" * rng.randrange(60) for _ in range(80 if name != "one" else 1)]
        raw = ("\n".join(lines) + end).encode()
        (tmp_path / name).write_bytes(raw)
        at = 0
        for part in raw.split(b"\n"):
            if at < len(raw):
                want[name, at] = (part.decode(), at + len(part) == len(raw))
            at += len(part) + 1
    rows = numbered_lines(spark, f"file://{tmp_path}").collect()
    assert {(r.file.rsplit("/", 1)[1], r.offset): (r.value, r.partial) for r in rows} == want and len(rows) == len(want)
    assert len({(r.file, r.split) for r in rows}) > 20


SHA = "0a" * 32


def summary(session, n, **change):
    return {"_mtc_delta_type": "session_summary", "schema_version": 2, "session_id": session, "requests": n, "first_at": "2024-01-01T00:00:00Z", "last_at": "2024-01-02T00:00:00.123456Z", "records_sha256": SHA, "deleted": False} | change


def record(session, request, **change):
    return {"schema_version": 2, "session_id": session, "request_id": request, "started_at": "2024-01-01T00:00:00Z", "completed_at": "2024-01-01T01:00:00+01:00"} | change


GONE = {"first_at": None, "records_sha256": None, "deleted": True, "deleted_at": "2024-01-02T00:00:00.123456Z"}
#: Lines of one file, each with the reasons that it gets.
CASES = [
    (record("s", "r1"), ["record without summary"]), (summary("a", 2), []), (record("a", "r1"), []), (record("a", "r2", extra=1), []), (summary("b", 3), ["count"]), (record("b", "r1"), []), (record("b", "r1"), ["order"]),
    (summary("c", 3), []), (record("c", "B"), []), (record("a", "a"), ["other session"]), (record("c", "é"), []), (summary("a", 1), ["session twice"]), (record("a", "r9"), []), (summary("gone", 0, **GONE), []), (summary("gone2", 0, **GONE), ["count"]),
    (record("gone2", "x"), []), (" \t", []), ("{x", ["not JSON"]), ('{"a":1,"a":2}', ["repeated key"]), (summary("d", 1, records_sha256="0A" * 32), ["bad summary"]), (summary("d", 1, more=1), ["bad summary"]), (summary("dé", 1), ["bad summary"]),
    (summary("d", 0), ["bad summary"]), (summary("d", 1, schema_version=1), ["bad summary"]), (summary("d", 0, **GONE | {"deleted_at": "2024-01-03T00:00:00Z"}), ["bad summary"]), (record("gone2", ""), ["bad record"]), (record("gone2", "y\u0007"), ["bad record"]),
    (record("gone2", "y", schema_version=3), ["bad record"]), (record("gone2", "y", completed_at="2023-01-01T00:00:00Z"), ["bad record"]), (record("gone2", "y", started_at="never"), ["bad record"]), ("[1]", ["bad record"]), ("null", ["bad record"]),
    (record("gone2", "y", status_code=2**53), ["unsafe whole number"]), (record("gone2", "y", payload=json.loads("[" * 130 + "]" * 130)), ["too deep"]), (record("gone2", "y", payload="x" * 3000), ["line too long"]), (summary("e", 400), []),
    *[(record("e", f"q{k:05d}"), []) for k in range(400)], (summary("f", 1, first_at="2024-01-02T00:00:00.123456Z"), []), (record("f", "z", schema_version=1), ["partial last line"]),
]


def test_every_break_is_named_with_its_place(spark, tmp_path, small_splits):
    lines, want, at = [], [], 0
    for line, reasons in CASES:
        text = line if isinstance(line, str) else json.dumps(line, ensure_ascii=False)
        want += [(at, r) for r in reasons]
        lines.append(text)
        at += len(text.encode()) + 1
    (tmp_path / "file").write_bytes("\n".join(lines).encode())
    (tmp_path / "other").write_text(json.dumps(summary("a", 1)) + "\n" + json.dumps(record("a", "r1")) + "\n")
    got = line_checks.session_breaks(numbered_lines(spark, f"file://{tmp_path}"), longest=2500)
    assert sorted((r.offset, r.reason) for r in got.where(F.col("file").endswith("/file")).collect()) == sorted(want)
    assert got.where(F.col("file").endswith("/other")).count() == 0


def test_empty_files(spark, tmp_path, small_splits):
    (tmp_path / "file").write_text("\n\n")
    assert line_checks.session_breaks(numbered_lines(spark, f"file://{tmp_path}")).count() == 0


def test_parts_of_a_folder_are_one_text(spark, tmp_path):
    for name, text in (("k=1/part-1", "a\nbb\n"), ("k=1/part-2", "ccc\nd"), ("k=2/part-1", "e\n")):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(text)
    rows = numbered_lines(spark, f"file://{tmp_path}", parts=True).collect()
    got = sorted((r.file.split("/")[-2], r.offset, r.value, r.partial) for r in rows)
    assert got == [("k=1", 0, "a", False), ("k=1", 2, "bb", False), ("k=1", 5, "ccc", False), ("k=1", 9, "d", True), ("k=2", 0, "e", False)]
