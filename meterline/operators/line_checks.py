"""What is wrong with archive files: lines by themselves, and sessions as summaries followed by their records."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

from meterline.functions import json_text
from meterline.sources.lines import counted_before, with_row_before

#: Bytes of a line, levels of JSON, the largest whole number, bytes of ids.
LONGEST_LINE, DEEPEST, LARGEST_WHOLE = 16 << 20, 128, 2**53 - 1
SESSION_BYTES, REQUEST_BYTES, RECORD_SESSION_BYTES = 512, 512, 1024
SUMMARY_FIELDS = ("_mtc_delta_type", "schema_version", "session_id", "requests", "first_at", "last_at", "records_sha256", "deleted", "deleted_at")
FIELDS = "_mtc_delta_type string, schema_version long, session_id string, requests long, first_at string, last_at string, records_sha256 string, deleted boolean, deleted_at string, request_id string, started_at string, completed_at string"


def _depth(value) -> int:
    inside = value.values() if isinstance(value, dict) else value if isinstance(value, list) else None
    return 0 if inside is None else 1 + max(map(_depth, inside), default=0)


def _whole_numbers(value) -> bool:
    if isinstance(value, dict):
        return all(map(_whole_numbers, value.values()))
    if isinstance(value, list):
        return all(map(_whole_numbers, value))
    return not isinstance(value, (int, float)) or isinstance(value, bool) or value != value // 1 or abs(value) <= LARGEST_WHOLE


def strict(text: str | None) -> str | None:
    if text is None:
        return None
    try:
        value = json_text.parse(text)
        if _depth(value) > DEEPEST:
            return "too deep"
        return None if _whole_numbers(value) else "unsafe whole number"
    except json_text.JsonProblem as error:
        return str(error)
    except RecursionError:
        return "too deep"


@pandas_udf(StringType())
def strict_problem(text: pd.Series) -> pd.Series:
    """Why a text is no strict JSON: not JSON, repeated key, number out of range, more than DEEPEST levels, a whole number that doubles can't hold; null if it is."""
    return pd.Series([strict(t) for t in text], dtype=object)


def parsed(lines: DataFrame, longest: int = LONGEST_LINE) -> DataFrame:
    """lines (file, split, offset, value, partial) without blank ones, with kind (summary or record), its fields, and what is wrong with the line by itself."""
    rows = lines.where(F.col("value").rlike(r"[^\x20\t\r\x0c]")).withColumn("_long", F.octet_length("value") + F.when(F.col("partial"), 0).otherwise(1) > longest)
    rows = rows.withColumn("_json", F.when(~F.col("_long"), F.col("value"))).withColumn("_bad", strict_problem("_json"))
    rows = rows.withColumn("_r", F.from_json(F.when(F.col("_bad").isNull(), F.col("_json")), FIELDS))
    keys = F.coalesce(F.json_object_keys("_json"), F.array().cast("array<string>"))
    r = F.col("_r")
    time = lambda name: F.try_to_timestamp(r[name])
    summary = F.array_contains(keys, "_mtc_delta_type")
    plain = lambda t, n: (t != "") & (F.octet_length(t) <= n) & ~t.rlike(r"[^\x20-\x7e]")
    gone = (r["requests"] == 0) & r["first_at"].isNull() & r["records_sha256"].isNull() & (time("deleted_at") == time("last_at"))
    live = (r["requests"] > 0) & (time("first_at") <= time("last_at")) & r["records_sha256"].rlike("^[0-9a-f]{64}$") & r["deleted_at"].isNull()
    shape = F.when(F.coalesce(r["deleted"], F.lit(False)), gone).otherwise(live)
    known = F.size(F.array_except(keys, F.array(*map(F.lit, SUMMARY_FIELDS)))) == 0
    right_summary = known & (r["_mtc_delta_type"] == "session_summary") & (r["schema_version"] == 2) & plain(r["session_id"], SESSION_BYTES) & time("last_at").isNotNull() & shape
    control = r"\p{Cc}"
    right_record = (
        r["schema_version"].isin(1, 2) & (r["request_id"] != "") & (F.octet_length(r["request_id"]) <= REQUEST_BYTES) & ~r["request_id"].rlike(control)
        & (F.octet_length(r["session_id"]) <= RECORD_SESSION_BYTES) & ~r["session_id"].rlike(control) & (time("completed_at") >= time("started_at"))
    )
    problem = (
        F.when(F.col("_long"), "line too long").when(F.col("_bad").isNotNull(), F.col("_bad"))
        .when(summary & ~F.coalesce(right_summary, F.lit(False)), "bad summary").when(~summary & ~F.coalesce(right_record, F.lit(False)), "bad record")
    )
    return rows.select(
        "file", "split", "offset", "partial", problem.alias("problem"), F.when(problem.isNull(), F.when(summary, "summary").otherwise("record")).alias("kind"),
        r["session_id"].alias("session_id"), r["requests"].alias("requests"), r["request_id"].alias("request_id"),
    )


def session_breaks(lines: DataFrame, longest: int = LONGEST_LINE) -> DataFrame:
    """(file, offset, reason) of each break in archive files: a file is summaries, each followed by exactly as many records as it says, of its session, by ascending request_id.

    Reasons of a line by itself: those of parsed(), and partial last line. A right line may break its session's order: record without summary, other session,
    order (request_id isn't above the one before, bytewise); a summary: count (it has another number of right lines), session twice (it stands in
    its file before). Lines that are wrong by themselves count as none. Order is judged across splits of a file without bringing
    a file or a session to one task.
    """
    rows = parsed(lines, longest).checkpoint()
    alone = rows.where("problem IS NOT NULL").select("file", "offset", F.col("problem").alias("reason"))
    open_ended = rows.where("partial").select("file", "offset", F.lit("partial last line").alias("reason"))
    right = rows.where("problem IS NULL").drop("problem", "partial").withColumn("_summary", F.col("kind") == "summary")
    right = counted_before(right, "_summary", "nth")
    right = with_row_before(right, "kind", "request_id").checkpoint()
    heads = right.where("_summary").select("file", "nth", "offset", F.col("session_id").alias("head"), "requests")
    records = right.where("NOT _summary").join(heads.select("file", "nth", "head"), ["file", "nth"], "left")
    reason = (
        F.when(F.col("head").isNull(), "record without summary").when(F.col("head") != F.col("session_id"), "other session")
        .when((F.col("before_kind") == "record") & (F.col("before_request_id") >= F.col("request_id")), "order")
    )
    broken = records.select("file", "offset", reason.alias("reason")).where("reason IS NOT NULL")
    n = records.groupBy("file", "nth").agg(F.count("*").alias("n"))
    counts = heads.join(n, ["file", "nth"], "left").where(F.coalesce("n", F.lit(0)) != F.col("requests")).select("file", "offset", F.lit("count").alias("reason"))
    first = heads.groupBy("file", "head").agg(F.min("offset").alias("_first"))
    twice = heads.join(first, ["file", "head"]).where("offset > _first").select("file", "offset", F.lit("session twice").alias("reason"))
    return alone.unionByName(open_ended).unionByName(broken).unionByName(counts).unionByName(twice)
