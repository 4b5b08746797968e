"""Snapshots of a source: ordered digests, stability, order, chains over two schema versions, generations, and plans."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Fixed value: sessions of one snapshot at most; its digest covers them in order, one after the other.
MOST_SESSIONS = 1_000_000
#: Candidates of a refund plan, and of a transition plan, at most.
MOST_REFUNDS, MOST_TRANSITIONS = 10_000, 100_000


def _streamed(rows: DataFrame, group: str, order: list[str], line: str, chained: bool) -> DataFrame:
    """SHA-256 over the lines of each group in order, read as a stream: a group of any length needs no more memory than a batch."""

    def raw(value: str | bytes | None) -> bytes:
        return value if isinstance(value, bytes) else (value or "").encode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, n, state = None, 0, None
        done: list[tuple] = []

        def close() -> tuple:
            return now, n, state if chained else state.hexdigest()

        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if state is None or name != now:
                    if state is not None:
                        done.append(close())
                    now, n, state = name, 0, "" if chained else hashlib.sha256()
                if chained:
                    state = hashlib.sha256(state.encode() + raw(text)).hexdigest()
                else:
                    state.update(raw(text))
                n += 1
            yield as_batch(done)
            done.clear()
        yield as_batch([close()] if state is not None else [])

    def as_batch(found: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*found)) or [[]] * 3
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int64(), pa.string()))], [group, "records", "sha256"])

    sorted_rows = rows.select(F.col(group).cast("string").alias(group), F.col(line).alias("_line"), *[F.col(c).alias(f"_{i}") for i, c in enumerate(order)])
    sorted_rows = sorted_rows.repartition(group).sortWithinPartitions(group, *[f"_{i}" for i in range(len(order))], "_line")
    return sorted_rows.select(group, "_line").mapInArrow(run, f"{group} string, records long, sha256 string")


def ordered_digests(records: DataFrame, group: str = "session_id", order: tuple[str, ...] = ("request_id",), line: str = "line") -> DataFrame:
    """(group, records, sha256) over a group's whole lines in bytewise order."""
    return _streamed(records, group, list(order), line, False)


def chained_digests(records: DataFrame, group: str, order: tuple[str, ...], line: str) -> DataFrame:
    """(group, records, sha256): each step hashes the hex of the step before and the line."""
    return _streamed(records, group, list(order), line, True)


def summary_json(row: DataFrame) -> DataFrame:
    """session_id and the JSON that the set digest takes for a summary; keys stand in a fixed order."""
    present = F.to_json(F.struct("first_at", "last_at", "records_sha256", "requests", "session_id"))
    gone = F.to_json(F.struct("last_at", F.lit(0).alias("requests"), "session_id", "deleted", "deleted_at"))
    return row.select("session_id", F.when(F.col("deleted"), gone).otherwise(present).alias("line"))


def session_set_digest(summaries: DataFrame) -> DataFrame:
    """One row (sessions, sha256) over the JSON array of all summaries, by session_id bytewise.

    The digest is one after the other by definition, so it runs as one stream, over MOST_SESSIONS summaries at most; more are an error.
    """
    lines = summary_json(summaries)
    n = lines.count()
    if n > MOST_SESSIONS:
        raise ValueError(f"{n} sessions; a snapshot has {MOST_SESSIONS} at most")
    first = lines.agg(F.min("session_id").alias("_first"))  # one row
    joined = lines.crossJoin(first).select(F.lit("all").alias("_all"), "session_id", F.concat(F.when(F.col("session_id") == F.col("_first"), "[").otherwise(","), "line").alias("line"))
    end = lines.sparkSession.createDataFrame([("all", 1, "]" if n else "[]")], "_all string, last int, line string")
    rows = joined.select("_all", F.lit(0).alias("last"), "session_id", "line").unionByName(end.withColumn("session_id", F.lit("")))
    return _streamed(rows, "_all", ["last", "session_id"], "line", False).select((F.col("records") - 1).alias("sessions"), "sha256")


def changed_between(first: DataFrame, second: DataFrame, key: str, digest: str) -> DataFrame:
    """Two reads of a source must agree: (key, reason) of rows that are gone, new or changed."""
    both = first.select(key, F.col(digest).alias("_a")).join(second.select(key, F.col(digest).alias("_b")), key, "full_outer")
    reason = F.when(F.col("_b").isNull(), "gone").when(F.col("_a").isNull(), "new").when(F.col("_a") != F.col("_b"), "changed")
    return both.select(key, reason.alias("reason")).where("reason IS NOT NULL")


def beyond_clock(rows: DataFrame, now_ms: int, skew_ms: int, *times: str) -> DataFrame:
    """Rows with a time later than the clock may be off."""
    late = F.lit(False)
    for c in times:
        late |= F.coalesce(F.col(c) > now_ms + skew_ms, F.lit(False))
    return rows.where(late)


def order_breaks(rows: DataFrame, position: str = "position") -> DataFrame:
    """Rows (position from 0 on, last_at, session_id) that don't stand strictly after the one before: last_at falls, session_id rises within.

    Neighbours meet by a join on the position, so no task sees the whole order.
    """
    before = rows.select((F.col(position) + 1).alias(position), F.col("last_at").alias("_last"), F.col("session_id").alias("_id"))
    after = (F.col("last_at") < F.col("_last")) | ((F.col("last_at") == F.col("_last")) & (F.col("session_id") > F.col("_id")))
    return rows.join(before, position).where(~after).select(position, "session_id")


def page_after(rows: DataFrame, key: list[str], after: tuple, limit: int) -> DataFrame:
    """The next rows in the order of key behind a seek position, which has one value for each column of key."""
    place = F.struct(*[F.lit(v).cast(rows.schema[c].dataType).alias(c) for c, v in zip(key, after)])
    return rows.where(F.struct(*key) > place).orderBy(*key).limit(limit)


def latest_page(rows: DataFrame, at: str, tie: str, limit: int, most: int = 200) -> DataFrame:
    """The newest rows, ties by the greater id, with has_more: whether another row follows. The limit is held between 1 and most."""
    limit = min(max(limit, 1), most)
    few = rows.orderBy(F.col(at).desc(), F.col(tie).desc()).limit(limit + 1)
    place = F.row_number().over(Window.orderBy(F.col(at).desc(), F.col(tie).desc()))  # limit + 1 rows
    return few.withColumn("_n", place).withColumn("has_more", F.max("_n").over(Window.partitionBy(F.lit(1))) > limit).where(F.col("_n") <= limit).drop("_n")


CHAIN = ("fingerprint", "sequence", "full", "output", "prior_output", "prior_fence", "schema_version", "fence", "safe_fence")


def chain_outcome(incoming: DataFrame, state: DataFrame, incomplete: DataFrame) -> DataFrame:
    """(source, outcome) of a snapshot against a source's last: baseline, replay, next, or why it is refused.

    Both have source and CHAIN; incomplete has sources with rows that lack the locator they replaced.
    """
    held = state.select("source", *[F.col(c).alias(f"_{c}") for c in CHAIN], F.lit(True).alias("_held"))
    both = incoming.join(held, "source", "left").join(incomplete.select("source", F.lit(True).alias("_incomplete")).distinct(), "source", "left")
    c = F.col
    second = c("schema_version") == 2
    invalid = (c("sequence") <= 0) | ~c("schema_version").isin(1, 2) | (c("fence") < 0) | (second != c("safe_fence").isNotNull()) | F.coalesce((c("safe_fence") < 0) | (c("safe_fence") > c("fence")), F.lit(False))
    baseline = c("full") & (c("sequence") == 1) & c("prior_output").isNull() & c("prior_fence").isNull()
    replay = F.lit(True)
    for x in CHAIN:
        replay &= c(x).eqNullSafe(c(f"_{x}"))
    follows = (
        ~c("full") & (c("fingerprint") == c("_fingerprint")) & (c("sequence") == c("_sequence") + 1) & c("prior_output").eqNullSafe(c("_output"))
        & c("prior_fence").eqNullSafe(c("_fence")) & (c("fence") >= c("_fence"))
    )
    kept = (c("_schema_version") == 1) | (second & c("safe_fence").eqNullSafe(c("_safe_fence")))
    raised = (c("_schema_version") == 2) | ~second | F.coalesce(c("prior_fence") >= c("safe_fence"), F.lit(False))
    outcome = (
        F.when(invalid, "invalid")
        .when(second & c("_incomplete").isNotNull(), "rows lack provenance")
        .when(c("_held").isNull(), F.when(baseline, "baseline").otherwise("no baseline"))
        .when(replay, "replay")
        .when(follows & kept & raised, "next")
        .otherwise("conflict")
    )
    return both.select("source", outcome.alias("outcome"))


def generations(summaries: DataFrame) -> DataFrame:
    """By session of a chain (session_id, sequence, deleted): how often it was made and deleted, and whether it lives."""
    before = F.lag("deleted").over(Window.partitionBy("session_id").orderBy("sequence"))
    rows = summaries.select("session_id", "sequence", "deleted", F.coalesce(before, F.lit(True)).alias("_before"))
    return rows.groupBy("session_id").agg(
        F.count_if(~F.col("deleted") & F.col("_before")).alias("generations"), F.count_if(F.col("deleted") & ~F.col("_before")).alias("deletions"), (~F.max_by("deleted", "sequence")).alias("live")
    )


def preflight(sealed: DataFrame, live: DataFrame) -> DataFrame:
    """(source, delta): counts and fences of a sealed copy against the live source; both have source, records, sessions, bytes and fence."""
    both = sealed.join(live.select("source", *[F.col(c).alias(f"live_{c}") for c in ("records", "sessions", "bytes", "fence")]), "source")
    changed = F.lit(False)
    for c in ("records", "sessions", "bytes"):
        changed |= F.col(c) != F.col(f"live_{c}")
    delta = (
        F.when(changed, "source counts changed")
        .when(F.col("fence").isNull() | F.col("live_fence").isNull(), "fences unknown")
        .when(F.col("live_fence") > F.col("fence"), "changed after the seal")
        .when(F.col("live_fence") < F.col("fence"), "fence went back")
        .otherwise("equal fences")
    )
    return both.select("source", delta.alias("delta"))


def plan_problems(candidates: DataFrame, told: int, lower_ms: int, upper_ms: int, most: int = MOST_REFUNDS) -> DataFrame:
    """One row of counts that must all be zero before a plan (request_id, created_at) is taken: too many, told wrong, repeated, out of scope."""
    outside = F.count_if(~F.coalesce((F.col("created_at") >= lower_ms) & (F.col("created_at") < upper_ms), F.lit(False)))
    n = F.count("*")
    return candidates.agg(F.greatest(n - most, F.lit(0)).alias("too_many"), F.abs(n - told).alias("told_wrong"), (n - F.countDistinct("request_id")).alias("repeated"), outside.alias("out_of_scope"))


def transition_problems(plan: DataFrame, result: DataFrame) -> DataFrame:
    """One row of counts that must be zero: keys that don't rise strictly, and a result (changed, already, and each preserved count) that isn't the plan's.

    plan has position, key_id and changes; result one row.
    """
    before = plan.select((F.col("position") + 1).alias("position"), F.col("key_id").alias("_key"))
    falls = plan.join(before, "position").agg(F.count_if(F.col("key_id") <= F.col("_key")).alias("out_of_order"))
    sums = plan.agg(F.count("*").alias("n"), F.count_if("changes").alias("to_change"))
    preserved = [c for c in result.columns if c not in ("changed", "already")]
    wrong = sum((F.when(F.col(c) != F.col("n"), 1).otherwise(0) for c in preserved), F.lit(0))
    one = result.crossJoin(sums).crossJoin(falls)  # each has one row
    return one.select("out_of_order", F.abs(F.col("changed") - F.col("to_change")).alias("changed_wrong"), F.abs(F.col("changed") + F.col("already") - F.col("n")).alias("sum_wrong"), wrong.cast("long").alias("preserved_wrong"))
