"""Mixing sources to target weights by Pfair windows: blocks get release times and deadlines, the earliest deadline goes first."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meterline.llm.tables import boxed, read

#: Target shares of src0 ... src19 and of whatever else there is, in whole parts.
PRODUCTION_SHARES = {f"src{k}": share for k, share in enumerate([12, 8, 8, 6, 6, 5, 5, 5, 4, 4, 4, 4, 4, 4, 3, 3, 3, 3, 3, 3])}
OTHERS_SHARE = 3
BLOCK_ROWS = 16


def cycle(spark: SparkSession, shares: dict[str, int], others: int) -> DataFrame:
    """The slots of one cycle, as rows (stream, nth, share, slot): as many as there are shares, a size that parameters set.

    Block n of a stream with share a of Q is released at floor(n Q / a) and due at ceil((n + 1) Q / a).
    Each slot takes, of the released blocks, that with the earliest deadline; ties go to the earlier stream.
    Every block falls into its window, so a stream is never a whole block ahead of or behind its share.
    After Q slots everything stands as at the start, so one cycle gives the slot of every block.
    """
    names = [*shares, None]
    parts = [*shares.values(), others]
    total = sum(parts)
    streams = ", ".join(f"named_struct('s', {s}, 'a', {a})" for s, a in enumerate(parts))
    return spark.sql(f"""
        WITH one AS (SELECT array({streams}) AS streams),
        dealt AS (
          SELECT aggregate(
            sequence(0, {total - 1}),
            named_struct('done', transform(streams, x -> 0), 'picks', CAST(array() AS array<int>)),
            (acc, t) -> transform(
              array(array_min(transform(
                filter(streams, x -> x.a > 0 AND (acc.done[x.s] * {total}) div x.a <= t),
                x -> named_struct('due', ((acc.done[x.s] + 1) * {total} + x.a - 1) div x.a, 's', x.s)))),
              pick -> named_struct(
                'done', transform(acc.done, (n, s) -> IF(s = pick.s, n + 1, n)),
                'picks', concat(acc.picks, array(pick.s))))[0],
            acc -> acc.picks) AS picks FROM one
        ), slots AS (SELECT posexplode(picks) AS (slot, s) FROM dealt)
        SELECT element_at(array({", ".join("CAST(NULL AS string)" if n is None else "'" + n.replace("'", "''") + "'" for n in names)}), s + 1) AS stream,
               CAST(row_number() OVER (PARTITION BY s ORDER BY slot) - 1 AS int) AS nth,
               element_at(array({", ".join(map(str, parts))}), s + 1) AS share, slot
        FROM slots""")


def mix(docs: DataFrame, shares: dict[str, int], others: int = 1, block_rows: int = BLOCK_ROWS, rows_per_chunk: int = 1024) -> DataFrame:
    """docs with stream, block_no, release, deadline, slot and place: in the order of (slot, place) they are mixed.

    Each source is dealt into blocks of block_rows documents in the order of the MD5 of doc_id, a fixed
    shuffle. Counts of chunks of that order come first, so no source is ordered in one task. Sources without a
    share, null ones too, form one stream with the share others. No document is dropped: where a stream has
    ended the rest goes on in its own proportions. Repeated rows and ids are each dealt; among equal ids the order
    is by all of source, text and n_chars that docs have, and what is equal in these too is alike.
    Columns of docs with the names made here are replaced. Texts of any length are carried along, null and empty ones too; an
    empty table gives no rows.
    """
    spark = docs.sparkSession
    made = ["stream", "block_no", "release", "deadline", "slot", "place"]
    docs = docs.drop(*made)
    digits = max(1, min(7, len(f"{max(docs.count() // rows_per_chunk, 1):x}")))
    listed = F.col("source").isin(list(shares))
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    dealt = docs.withColumn("stream", F.when(listed, F.col("source"))).withColumn("_key", key).withColumn("_chunk", F.substring("_key", 1, digits))
    before = W.partitionBy("stream").orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    chunks = dealt.groupBy("stream", "_chunk").agg(F.count("*").alias("_n")).select(
        F.col("stream").alias("_stream"), F.col("_chunk").alias("_at"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    ties = [c for c in ("source", "text", "n_chars") if c in docs.columns]
    order = W.partitionBy("stream", "_chunk").orderBy("_key", "doc_id", *ties)
    ranked = dealt.withColumn("_row", F.row_number().over(order) - 1)
    ranked = ranked.join(chunks, F.col("stream").eqNullSafe(F.col("_stream")) & (F.col("_chunk") == F.col("_at"))).withColumn("_row", F.col("_row") + F.col("_before"))
    ranked = ranked.withColumn("block_no", F.expr(f"_row div {block_rows}")).withColumn("place", F.expr(f"_row % {block_rows}"))
    total = sum(shares.values()) + others
    slots = cycle(spark, shares, others).select(F.col("stream").alias("_of"), "nth", "share", F.col("slot").alias("_slot"))
    share = F.coalesce(*[F.when(F.col("stream") == s, F.lit(a)) for s, a in shares.items()], F.lit(others))
    mixed = ranked.withColumn("_share", share).withColumn("_nth", F.expr("CAST(block_no % _share AS int)")).join(
        F.broadcast(slots), F.col("stream").eqNullSafe(F.col("_of")) & (F.col("_nth") == F.col("nth"))
    )
    return mixed.select(
        *docs.columns,
        "stream",
        "block_no",
        F.expr(f"(block_no * {total}) div _share").alias("release"),
        F.expr(f"((block_no + 1) * {total} + _share - 1) div _share").alias("deadline"),
        F.expr(f"(block_no div _share) * {total} + _slot").alias("slot"),
        "place",
    )


def in_mixed_order(docs: DataFrame, shares: dict[str, int], others: int = 1) -> DataFrame:
    """The columns of docs alone, dealt into partitions by rising slot and sorted, so files follow the mixed order.

    No row is dropped, and every column stays as it is, whatever its name. Null sources count as others; rows without
    doc_id, repeated rows, and null, empty and very long texts are dealt like all; an empty table gives no rows.
    """
    ties = [c for c in ("source", "text", "n_chars") if c in docs.columns and c != "source"]
    named = boxed(docs).select("row", "row.doc_id", F.col("row.source").cast("string").alias("source"), *[f"row.{c}" for c in ties])
    placed = mix(named, shares, others)
    return placed.repartitionByRange("slot", "place").sortWithinPartitions("slot", "place").select("row").select("row.*")


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source")
    return mix(docs, PRODUCTION_SHARES, OTHERS_SHARE).select("doc_id", "source", "block_no", "release", "deadline", "slot", "place")


_PARTS = ", ".join(f"({k}, '{s}', {a})" for k, (s, a) in enumerate(PRODUCTION_SHARES.items()))
_TOTAL = sum(PRODUCTION_SHARES.values()) + OTHERS_SHARE
OP8_SQL = f"""
WITH RECURSIVE parts(s, name, a) AS (VALUES {_PARTS}, ({len(PRODUCTION_SHARES)}, NULL, {OTHERS_SHARE})),
-- jobs of one cycle and their windows
jobs AS (SELECT s, n, (n * {_TOTAL}) // a AS release, ((n + 1) * {_TOTAL} + a - 1) // a AS due FROM parts, range(0, 100) r(n) WHERE n < a),
edf(t, done, slots) AS (
  SELECT 0, CAST([] AS BIGINT[]), CAST([] AS BIGINT[])
  UNION ALL
  SELECT t + 1, list_append(done, pick), slots FROM (
    SELECT t, done, slots, (SELECT arg_min(s * 1000 + n, due * 1000 + s) FROM jobs
      WHERE release <= t AND NOT list_contains(done, s * 1000 + n)) AS pick FROM edf WHERE t < {_TOTAL})
), picks AS (SELECT unnest(done) AS job, generate_subscripts(done, 1) - 1 AS slot FROM edf WHERE t = {_TOTAL}),
dealt AS (
  SELECT d.doc_id, d.source, p.s, p.a, row_number() OVER (PARTITION BY p.s ORDER BY md5(coalesce(CAST(d.doc_id AS VARCHAR), '')), d.doc_id NULLS FIRST, d.source NULLS FIRST) - 1 AS r
  FROM documents d JOIN parts p ON p.name IS NOT DISTINCT FROM (CASE WHEN d.source IN (SELECT name FROM parts WHERE name IS NOT NULL) THEN d.source END)
)
SELECT doc_id, source, r // {BLOCK_ROWS} AS block_no, ((r // {BLOCK_ROWS}) * {_TOTAL}) // a AS release,
       ((r // {BLOCK_ROWS} + 1) * {_TOTAL} + a - 1) // a AS deadline,
       ((r // {BLOCK_ROWS}) // a) * {_TOTAL} + picks.slot AS slot, CAST(r % {BLOCK_ROWS} AS BIGINT) AS place
FROM dealt JOIN picks ON picks.job = s * 1000 + (r // {BLOCK_ROWS}) % a
"""
