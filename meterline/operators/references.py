"""References between objects, receipts and audits, and what may be changed or deleted because of them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.operators.ancestry import circular, reachable
from meterline.operators.snapshots import ordered_digests


def receipt_outcome(receipts: DataFrame, current: DataFrame) -> DataFrame:
    """(tenant, request, outcome): a copy receipt against the row it copied: already, eligible or skipped.

    receipts has reference, source_md5 and size; current format, reference, stored_md5, stored_bytes and encoded_bytes.
    """
    key = ["tenant", "request"]
    both = receipts.select(*key, "reference", "source_md5", "size").join(current.withColumnRenamed("reference", "held"), key, "left")
    c = F.col
    same = (c("format") == 1) & (c("stored_md5") == c("source_md5")) & (c("stored_bytes") == c("encoded_bytes")) & (c("encoded_bytes") == c("size"))
    outcome = F.when((c("format") == 2) & (c("held") == c("reference")), "already").when(F.coalesce(same, F.lit(False)), "eligible").otherwise("skipped")
    return both.select(*key, outcome.alias("outcome"))


def read_back(audits: DataFrame, receipts: DataFrame, current: DataFrame) -> DataFrame:
    """By object (tenant, locator, digest, bytes): rows that committed audits prove, rows that wait, and rows with two proofs, which are conflicts.

    Audits that say the same twice count once. An audit waits while its receipt is absent or its row holds another reference.
    """
    key = ["tenant", "request"]
    done = audits.where(F.col("status").isin("committed", "committed_confirmed_by_reread")).select(*key, "receipt", "reference").distinct()
    held = current.select(*key, F.col("reference").alias("held"))
    rows = done.join(receipts.select("receipt", "locator", "digest", "bytes"), "receipt").join(held, key, "left")
    rows = rows.withColumn("proven", F.coalesce(F.col("held") == F.col("reference"), F.lit(False)))
    by_row = rows.groupBy("tenant", "locator", "digest", "bytes", "request").agg(F.count_if("proven").alias("proofs"), F.count_if(~F.col("proven")).alias("waiting"))
    return by_row.groupBy("tenant", "locator", "digest", "bytes").agg(
        F.count_if(F.col("proofs") == 1).alias("members"), F.sum("waiting").cast("long").alias("waiting"), F.count_if(F.col("proofs") > 1).alias("conflicts")
    )


def batch_report(batch: DataFrame) -> DataFrame:
    """One row about raw references (tenant, request, side, target, pending, bound): how many, targets, repeats, repeated identities and forbidden proofs.

    A response can be neither pending nor bound; of requests all four are proofs.
    """
    forbidden = (F.col("side") == "response") & (F.col("pending") | F.col("bound"))
    by_row = batch.groupBy("tenant", "request", "side").count().agg(F.count_if(F.col("count") > 1).alias("repeated_identities"))
    n, targets = F.count("*"), F.countDistinct("target")
    return batch.agg(n.alias("references"), targets.alias("targets"), (n - targets).alias("repeats"), F.count_if(forbidden).alias("forbidden")).crossJoin(by_row)  # one row each


def provenance(requested: DataFrame, imports: DataFrame, accounts: DataFrame, credentials: DataFrame, kind: str, driver: str) -> DataFrame:
    """What was asked for (source_id, source_key) with the active account it was imported as and its one credential that isn't revoked."""
    live = accounts.where((F.col("driver") == driver) & (F.col("status") == "active") & (F.col("generation") >= 1))
    right = credentials.where("revoked_at IS NULL").select("account_id", "generation")
    return (
        requested.join(imports.where(F.col("kind") == kind).select("source_key", "payload_digest", "account_id"), "source_key")
        .join(live.select("account_id", "generation"), "account_id")
        .join(right, ["account_id", "generation"])
    )


def gap_replacement(current: Column, replacement: Column) -> tuple[Column, Column]:
    """The locator after an import, and whether the import is refused: only a gap may be replaced, or anything by itself."""
    free = F.coalesce(current.startswith("gap://"), F.lit(False)) | current.eqNullSafe(replacement)
    return F.when(replacement.isNotNull() & free, replacement).otherwise(current), replacement.isNotNull() & ~free


def route_alias(alias: Column, model: Column) -> Column:
    return F.coalesce(F.when(F.trim(alias) != "", F.trim(alias)), model)


def route_prefix(prefix: Column) -> Column:
    """A prefix without outer spaces and slashes; null if nothing or more than one segment is left."""
    bare = F.regexp_replace(F.trim(prefix), "^/+|/+$", "")
    return F.when((bare != "") & ~F.contains(bare, F.lit("/")), bare)


def closure(roots: DataFrame, references: DataFrame, objects: DataFrame) -> DataFrame:
    """All objects (id, tenant) that roots reach by references (from_id, to_id, digest), each once for a tenant: (id, tenant, problem).

    problem tells of an object that is absent, of another tenant, referred to under two digests, or from which its references lead
    back to itself or into such a circle. Depth has no cap: see ancestry.reachable.
    """
    edges = references.select("from_id", "to_id").distinct()
    found = reachable(roots.select("id", "tenant"), edges)
    at = objects.select("id", F.col("tenant").alias("held_tenant"))
    digests = references.groupBy(F.col("to_id").alias("id")).agg(F.countDistinct("digest").alias("digests"))
    circles = circular(edges).withColumn("circular", F.lit(True))
    rows = found.join(at.hint("merge"), "id", "left").join(digests.hint("merge"), "id", "left").join(circles.hint("merge"), "id", "left")
    problem = (
        F.when(F.col("held_tenant").isNull(), "absent").when(F.col("held_tenant") != F.col("tenant"), "other tenant").when(F.col("digests") > 1, "two digests")
        .when(F.col("circular"), "circle").otherwise("")
    )
    return rows.select("id", "tenant", problem.alias("problem"))


def clusters(observations: DataFrame, edges: DataFrame) -> DataFrame:
    """By key and cluster: the least explicit session, the last time, requests, and candidate edges between the key's own observations."""
    ends = observations.select("id", "key_id", "cluster_id")
    inner = edges.where("relation_kind = 'candidate'").join(ends.toDF("from_id", "from_key", "from_cluster"), "from_id").join(ends.toDF("to_id", "key_id", "cluster_id"), "to_id")
    counts = inner.where("from_key = key_id").groupBy("key_id", "cluster_id").agg(F.count("*").alias("n"))
    rows = observations.groupBy("key_id", "cluster_id").agg(F.min("session_id").alias("session_id"), F.max("created_at").alias("updated_at"), F.count("*").alias("requests"))
    return rows.join(counts, ["key_id", "cluster_id"], "left").select("key_id", "cluster_id", "session_id", "updated_at", "requests", F.coalesce("n", F.lit(0)).alias("candidate_edges"))


def cohorts(policies: DataFrame, expected: DataFrame) -> DataFrame:
    """(model, keys, expected): models whose number of keys isn't what the audit expects."""
    got = policies.groupBy("model").agg(F.countDistinct("key_hash").alias("keys"))
    both = got.join(expected, "model", "full_outer").select("model", F.coalesce("keys", F.lit(0)).alias("keys"), F.coalesce("expected", F.lit(0)).alias("expected"))
    return both.where("keys <> expected")


def import_stats(records: DataFrame) -> DataFrame:
    """One row of counters over records (eligible, mapped, quarantined, replayed)."""
    c = F.col
    return records.agg(
        F.count("*").alias("scanned"), F.count_if("eligible").alias("eligible"), F.count_if(~c("eligible")).alias("before_overlap"), F.count_if(c("eligible") & c("mapped")).alias("mapped"),
        F.count_if(c("eligible") & ~c("mapped") & ~c("quarantined")).alias("unmapped"), F.count_if(c("eligible") & c("quarantined")).alias("quarantined"), F.count_if(c("eligible") & c("mapped") & c("replayed")).alias("replayed"),
    )


def capture_digest(files: DataFrame) -> DataFrame:
    """By capture: files and the digest of the JSON list of (path, sha256) in the order of paths. Two captures of one state have one digest.

    The list is hashed as a stream of sorted files, so a capture of any size takes one batch of memory. A file that is listed twice alike counts once.
    """
    files = files.select("capture", "path", "sha256").distinct()
    first = files.groupBy("capture").agg(F.min(F.struct("path", "sha256")).alias("_first"))
    item = F.to_json(F.struct("path", "sha256"))
    rows = files.join(first, "capture").select("capture", F.lit(1).alias("part"), "path", "sha256", F.concat(F.when(F.struct("path", "sha256") == F.col("_first"), "").otherwise(","), item).alias("line"))
    ends = [first.select("capture", F.lit(n).alias("part"), F.lit("").alias("path"), F.lit("").alias("sha256"), F.lit(text).alias("line")) for n, text in ((0, '{"version":1,"auth":['), (2, "]}\n"))]
    out = ordered_digests(rows.unionByName(ends[0]).unionByName(ends[1]), "capture", ("part", "path", "sha256"))
    return out.select(F.col("capture").cast(files.schema["capture"].dataType).alias("capture"), (F.col("records") - 2).alias("files"), F.col("sha256").alias("digest"))


def reset(target: DataFrame, owned: DataFrame, key: list[str], guards: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """target without the rows that are owned, and the guards (guard, rows) that forbid it: rows of unfinished or foreign work, by name.

    Whoever writes the result refuses it if a guard has rows; nothing is changed here.
    """
    held = [rows.agg(F.count("*").alias("rows")).select(F.lit(name).alias("guard"), "rows") for name, rows in guards.items()]
    return target.join(owned.select(*key).distinct(), key, "left_anti"), reduce(DataFrame.unionByName, held).where("rows > 0")
