"""Session archives: lines, digests, the chain of deltas with tombstones, correlation and quarantine."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterline.operators.snapshots import ordered_digests

RECORD = "schema_version int, session_id string, request_id string, started_at long, completed_at long, key_id string, principal_id string, credential_hash string, requested_model string, model string, outcome string, status_code long"
SUMMARY = "_mtc_delta_type string, schema_version int, session_id string, requests long, first_at long, last_at long, deleted_at long, records_sha256 string, deleted boolean"
#: Fixed value: clocks of the archive and of requests may differ so much.
TOLERANCE_MS = 300_000


def parse(lines: DataFrame, max_bytes: int = 16 << 20) -> DataFrame:
    """Lines (value) as line type, record and summary; `problem` is null for a right line.

    A duplicate key, text after the value or anything but JSON is refused: as the only item of an array, try_parse_json
    gives null for it, while from_json would take the last of two keys. Blank lines are left out.
    """
    text = F.col("value")
    lines = lines.where(F.trim(text) != "")
    kind = F.when(F.get_json_object(text, "$._mtc_delta_type").isNotNull(), "session_summary").otherwise("record")
    alone = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    bad = alone.isNull() | F.try_variant_get(alone, "$[1]", "variant").isNotNull()
    out = lines.select("value", kind.alias("line_type"), bad.alias("_bad"))
    record, summary = F.from_json("value", RECORD), F.from_json("value", SUMMARY)
    out = out.select("value", "line_type", F.when(F.col("line_type") == "record", record).alias("record"), F.when(F.col("line_type") != "record", summary).alias("summary"), "_bad")
    version = F.coalesce("record.schema_version", "summary.schema_version")
    session = F.coalesce("record.session_id", "summary.session_id")
    problem = (
        F.when(F.octet_length("value") > max_bytes, "line too long")
        .when(F.col("_bad"), "not strict JSON")
        .when(version.isNull() | ~version.isin(1, 2), "unknown schema version")
        .when(session.isNull() | (session == ""), "no session")
        .when((F.col("line_type") == "record") & F.col("record.request_id").isNull(), "no request")
    )
    return out.withColumn("problem", problem).drop("_bad")


def session_digests(records: DataFrame) -> DataFrame:
    """(session_id, records, sha256) over the digests of a session's lines (session_id, request_id, line), each ended by a newline, in order of request.

    Lines are sorted and hashed as a stream, so a session of any length takes one batch of memory.
    """
    hashed = records.select("session_id", "request_id", F.concat(F.sha2("line", 256), F.lit("\n")).alias("line"))
    return ordered_digests(hashed)


def set_digest(digests: DataFrame) -> DataFrame:
    """One digest of all sessions: sessions go to 256 buckets by hash, and bucket digests are hashed in order."""
    place = F.substr(F.sha2("session_id", 256), F.lit(1), F.lit(2))
    line = F.sha2(F.concat_ws("\0", "session_id", F.col("records").cast("string"), "sha256"), 256)
    by_bucket = digests.select(place.alias("_bucket"), "session_id", line.alias("_line")).groupBy("_bucket")
    ordered = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("session_id", "_line"))), lambda x: x["_line"]), "")
    buckets = by_bucket.agg(F.sha2(ordered, 256).alias("_sha"), F.count("*").alias("_n"))
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_bucket", "_sha"))), lambda x: x["_sha"]), "")
    return buckets.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("sessions"), F.sha2(whole, 256).alias("set_sha256"))


def completeness(summaries: DataFrame, digests: DataFrame) -> DataFrame:
    """Sessions whose records or digest differ from their summary: (session_id, expected, actual, reason)."""
    both = summaries.select("session_id", "requests", F.col("records_sha256").alias("_told")).join(digests.select("session_id", "records", "sha256"), "session_id", "full_outer")
    reason = F.when(F.col("requests").isNull(), "no summary").when(F.col("records").isNull() & (F.col("requests") > 0), "no records").when(F.col("requests") != F.coalesce("records", F.lit(0)), "count").when(F.col("_told") != F.col("sha256"), "digest")
    return both.select("session_id", F.col("requests").alias("expected"), F.col("records").alias("actual"), reason.alias("reason")).where("reason IS NOT NULL")


def totals(records: DataFrame) -> DataFrame:
    """By session: requests, errors (a status below 200 or from 400 on), first and last activity, and durations that are known."""
    duration = F.col("completed_at") - F.col("started_at")
    error = (F.col("status_code") < 200) | (F.col("status_code") >= 400)
    return records.groupBy("session_id").agg(
        F.count("*").alias("requests"), F.count_if(error).alias("errors"), F.min("started_at").alias("first_at"), F.max("completed_at").alias("last_at"),
        F.count(duration).alias("duration_count"), F.coalesce(F.sum(duration), F.lit(0)).cast("long").alias("duration_sum_ms"),
    )


def chain_breaks(manifests: DataFrame) -> DataFrame:
    """Manifests of a source that do not follow the one before: (source, sequence, reason).

    manifests has source, sequence, output_sha256, prior_output_sha256, watermark, prior_watermark, fence, prior_fence, full.
    """
    w = Window.partitionBy("source").orderBy("sequence")
    before = {c: F.lag(c).over(w) for c in ("sequence", "output_sha256", "watermark", "fence")}
    rows = manifests.withColumns({f"_{k}": v for k, v in before.items()})
    unlike = lambda a, b: ~F.col(a).eqNullSafe(F.col(b))
    reason = (
        F.when(F.col("_sequence").isNull(), F.when((F.col("sequence") != 1) | ~F.col("full"), "first is no full snapshot"))
        .when(F.col("sequence") != F.col("_sequence") + 1, "sequence gap")
        .when(unlike("prior_output_sha256", "_output_sha256"), "prior digest")
        .when(unlike("prior_watermark", "_watermark") | (F.col("watermark") < F.col("_watermark")), "prior watermark")
        .when(unlike("prior_fence", "_fence") | (F.col("fence") < F.col("_fence")), "prior fence")
    )
    return rows.select("source", "sequence", reason.alias("reason")).where("reason IS NOT NULL")


def apply_deltas(summaries: DataFrame) -> DataFrame:
    """Live sessions after a chain of summaries (session_id, sequence, deleted, ...): the latest of a session, unless a tombstone."""
    columns = [c for c in summaries.columns if c != "session_id"]
    latest = summaries.groupBy("session_id").agg(F.max_by(F.struct(*columns), "sequence").alias("_row"))
    return latest.select("session_id", "_row.*").where(~F.col("deleted"))


def retired(current: DataFrame, staged: DataFrame) -> DataFrame:
    """Rows of sessions that are staged anew but which the staged snapshot lacks or holds with another digest."""
    again = current.join(staged.select("session_id").distinct(), "session_id", "left_semi")
    return again.join(staged.select("session_id", "request_id", "digest"), ["session_id", "request_id", "digest"], "left_anti")


def correlate(records: DataFrame, requests: DataFrame, tolerance_ms: int = TOLERANCE_MS) -> DataFrame:
    """(record_id, matches, disposition): exact, ambiguous, incompatible (same id, other facts) or absent.

    A match has the record's external id and key, in either case, a start within the tolerance, and one of its two models (without outer spaces, not blank). Of several
    matches the only one with the record's input and output tokens is exact. The join is on the external id; time and models filter within it.
    """
    tokens = ("input_tokens", "output_tokens")
    right = requests.select("external_id", F.col("created_at").alias("_at"), F.col("model").alias("_model"), F.col("key_id").alias("_key"), *[F.col(c).alias(f"_{c}") for c in tokens], F.lit(1).alias("_there"))
    both = records.join(right, "external_id", "left")
    named = lambda c: F.coalesce((F.trim(c) != "") & (F.trim(c) == F.col("_model")), F.lit(False))
    fits = (F.abs(F.col("_at") - F.col("started_at")) <= tolerance_ms) & (named("requested_model") | named("resolved_model")) & (F.lower("_key") == F.lower("key_id"))
    alike = fits & (F.col("_input_tokens") == F.col("input_tokens")) & (F.col("_output_tokens") == F.col("output_tokens"))
    n = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    counts = both.groupBy("record_id").agg(F.count("_there").alias("_same_id"), n(fits).alias("matches"), n(alike).alias("_alike"))
    what = F.when((F.col("matches") == 1) | ((F.col("matches") > 1) & (F.col("_alike") == 1)), "exact").when(F.col("matches") > 1, "ambiguous").when(F.col("_same_id") > 0, "incompatible").otherwise("absent")
    return counts.select("record_id", "matches", what.alias("disposition"))


def identities(proofs: DataFrame) -> DataFrame:
    """Per credential hash the one identity that all proofs (hash, tenant, key, principal, kind) agree on; others are unproven."""
    who = F.struct("tenant", "key", "principal")
    by_hash = proofs.groupBy("hash").agg(F.min(who).alias("_a"), F.max(who).alias("_b"), F.array_join(F.array_sort(F.collect_set("kind")), "+").alias("proof"))
    return by_hash.select("hash", F.when(F.col("_a") == F.col("_b"), F.col("_a.key")).alias("key"), "proof", (F.col("_a") == F.col("_b")).alias("proven"))


def quarantine_state(versions: DataFrame, resolutions: DataFrame) -> DataFrame:
    """The head version of each occurrence with its state: pending, resolved or dismissed by the latest resolution of that version."""
    heads = versions.groupBy("occurrence").agg(F.max("version").alias("version"), F.max_by("reason", "version").alias("reason"))
    last = resolutions.groupBy("occurrence", "version").agg(F.max_by("action", "at").alias("_action"))
    out = heads.join(last, ["occurrence", "version"], "left")
    return out.select("occurrence", "version", "reason", F.when(F.col("_action") == "link", "resolved").when(F.col("_action") == "dismiss", "dismissed").otherwise("pending").alias("state"))


def unlinked(versions: DataFrame, resolutions: DataFrame) -> DataFrame:
    """What associations of quarantined versions make of them: requests of a key without a link, (occurrence, version, key_id, reason).

    versions has occurrence, version and reason, resolutions occurrence, version, action, key_id and at. The first resolution of a version counts, and
    only an association (link) with a key makes a row; a version may be an older one than the head.
    """
    first = resolutions.groupBy("occurrence", "version").agg(F.min_by(F.struct("action", "key_id"), "at").alias("_r"))
    rows = versions.join(first, ["occurrence", "version"]).where((F.col("_r.action") == "link") & F.col("_r.key_id").isNotNull())
    return rows.select("occurrence", "version", F.col("_r.key_id").alias("key_id"), "reason")
