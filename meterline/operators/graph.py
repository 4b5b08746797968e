"""Conversation graphs and content-addressed objects."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.functions.scalars import locator_class
from meterline.operators.snapshots import ordered_digests


def node_hash(parent, atom):
    return F.sha2(F.concat(F.coalesce(parent, F.lit("root")), F.lit("\0"), atom), 256)


NODES = "conv_id long, depth long, node_hash string, parent_hash string, atom_hash string"


def context_nodes(turns: DataFrame) -> DataFrame:
    """Nodes (conv_id, depth, node_hash, parent_hash, atom_hash) of conversations (conv_id, turn, role, text).

    A hash covers its parent's, so a conversation's atoms are hashed in order, as a stream of sorted rows: one of any
    length takes time in proportion and no more memory than a batch. Texts stay out of the stream.
    """
    atom = F.sha2(F.concat(F.coalesce("role", F.lit("")), F.lit("\0"), F.coalesce("text", F.lit(""))), 256)
    ordered = turns.select("conv_id", "turn", atom.alias("atom")).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "atom")

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, depth, parent, begun = None, 0, None, False
        for batch in batches:
            rows = []
            for conv_id, atom in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not begun or conv_id != now:
                    now, depth, parent, begun = conv_id, 0, None, True
                node = hashlib.sha256(f"{parent or 'root'}\0{atom}".encode()).hexdigest()
                rows.append((conv_id, depth, node, parent, atom))
                depth, parent = depth + 1, node
            columns = list(zip(*rows)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if k < 2 else pa.string()) for k, c in enumerate(columns)], [c.split()[0] for c in NODES.split(", ")])

    return ordered.select("conv_id", "atom").mapInArrow(grow, NODES)


def broken_nodes(nodes: DataFrame) -> DataFrame:
    """Nodes whose parent is absent, at another depth than one less, or whose hash is not that of parent and atom.

    Nodes that conversations share are one.
    """
    distinct = nodes.select("node_hash", "parent_hash", "atom_hash", "depth").distinct()
    parents = distinct.groupBy(F.col("node_hash").alias("parent_hash")).agg(F.min("depth").alias("_depth"))
    both = distinct.join(parents, "parent_hash", "left")
    reason = (
        F.when(F.col("node_hash") != node_hash(F.col("parent_hash"), F.col("atom_hash")), "hash")
        .when(F.col("parent_hash").isNull(), F.when(F.col("depth") != 0, "root depth"))
        .when(F.col("_depth").isNull(), "no parent")
        .when(F.col("depth") != F.col("_depth") + 1, "depth")
    )
    return both.select("node_hash", reason.alias("reason")).where("reason IS NOT NULL")


def dialogue(leaves: DataFrame, nodes: DataFrame) -> DataFrame:
    """(leaf_hash, length): the walk from each leaf up to its root; a leaf whose walk meets an absent parent has no row.

    Each round doubles the step of every node that isn't at its root yet, so joins are log2 of the depth. Where nodes go in
    a circle, steps outgrow the number of nodes, and an error is raised.
    """
    state = nodes.select(F.col("node_hash").alias("_of"), F.col("parent_hash").alias("_at"), F.lit(1).cast("long").alias("length")).distinct().checkpoint()
    n_nodes, step = state.count(), 1
    while not (open_ := state.where("_at IS NOT NULL")).isEmpty():
        if step > n_nodes:
            raise ValueError("nodes go in a circle")
        there = state.select(F.col("_of").alias("_at"), F.col("_at").alias("_next"), F.col("length").alias("_more"))
        moved = open_.join(there, "_at").select("_of", F.col("_next").alias("_at"), (F.col("length") + F.col("_more")).alias("length"))
        state, step = state.where("_at IS NULL").unionByName(moved).checkpoint(), 2 * step
    return leaves.select(F.col("node_hash").alias("leaf_hash")).distinct().join(state.select(F.col("_of").alias("leaf_hash"), "length"), "leaf_hash")


def foreign_edges(edges: DataFrame, observations: DataFrame) -> DataFrame:
    """Edges (id, from_id, to_id) between observations (id, tenant_id) of different tenants or that lack an end."""
    o = observations.select(F.col("id").alias("_id"), F.col("tenant_id").alias("_tenant"))
    both = edges.join(o.toDF("from_id", "_from"), "from_id", "left").join(o.toDF("to_id", "_to"), "to_id", "left")
    reason = F.when(F.col("_from").isNull() | F.col("_to").isNull(), "missing end").when(F.col("_from") != F.col("_to"), "cross tenant")
    return both.select("id", reason.alias("reason")).where("reason IS NOT NULL")


def locator_union(relations: dict[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """(kind, id, locator, class) of all relations {kind: (table, id column, locator column)}."""
    out = None
    for kind, (table, key, locator) in relations.items():
        part = table.select(F.lit(kind).alias("kind"), F.col(key).cast("string").alias("id"), F.col(locator).alias("locator"), locator_class(F.col(locator)).alias("class"))
        out = part if out is None else out.unionByName(part)
    return out


def storage_class(key):
    """What an object's key says about whether it may be deleted. Prefixes and classes."""
    return (
        F.when(key.startswith("raw-cache/"), "cache_candidate_requires_reference_and_retention_proof")
        .when(key.rlike("^tenants/[^/]+/(?:cas|raw|conversations)/"), "protected_training_or_shared_cas")
        .when(key.startswith("staging/") | key.startswith("conversation-staging/"), "staging_requires_owner_fence")
        .when(key.startswith("readiness/"), "readiness_requires_owner_fence")
        .otherwise("unclassified_protected")
    )


def gap_candidates(locators: DataFrame, objects: DataFrame) -> DataFrame:
    """Locators that are gaps or whose object (key) is absent: (id, locator, reason)."""
    both = locators.join(objects.select(F.col("key").alias("locator"), F.lit(True).alias("_held")), "locator", "left")
    reason = F.when(F.col("class") == "gap", "gap").when((F.col("class") == "content") & F.col("_held").isNull(), "object absent")
    return both.select("id", "locator", reason.alias("reason")).where("reason IS NOT NULL")


def digest_sums(digest: Column) -> list[Column]:
    """Sums of the eight parts of 32 bits of 256-bit digests in hex, low first, named _s0 to _s7."""
    limbs = [F.conv(F.substr(digest, F.lit(57 - 8 * i), F.lit(8)), 16, 10).cast("decimal(20,0)") for i in range(8)]
    return [F.coalesce(F.sum(x), F.lit(0)).cast("decimal(38,0)").alias(f"_s{i}") for i, x in enumerate(limbs)]


def digest_text(sums: list) -> str:
    """The sum modulo 2**256 in hex, from the sums of its parts."""
    return f"{sum(int(x) << 32 * i for i, x in enumerate(sums)) % (1 << 256):064x}"


def multiset_digest(rows: DataFrame, digest: str) -> DataFrame:
    """Sum of 256-bit digests modulo 2**256, as eight sums of 32 bits, low first: the order of rows does not matter, repeats count."""
    sums = rows.agg(F.count("*").alias("rows"), *digest_sums(F.col(digest)))
    word = F.lit(1 << 32).cast("decimal(20,0)")
    carry, parts = F.lit(0).cast("decimal(38,0)"), []
    for i in range(8):
        total = (F.col(f"_s{i}") + carry).cast("decimal(38,0)")
        low = (total % word).cast("decimal(20,0)")
        carry = ((total - low) / word).cast("decimal(30,0)")
        parts.append(F.lpad(F.lower(F.conv(low.cast("string"), 10, 16)), 8, "0"))
    return sums.select("rows", F.concat(*reversed(parts)).alias("digest"))


def chunk_problems(chunks: DataFrame, headers: DataFrame) -> DataFrame:
    """Objects (object_id) whose chunks (seq from 0, n_bytes) do not make up their header (chunks, bytes)."""
    got = chunks.groupBy("object_id").agg(F.count("*").alias("_n"), F.countDistinct("seq").alias("_d"), F.min("seq").alias("_low"), F.max("seq").alias("_high"), F.sum("n_bytes").alias("_bytes"))
    both = headers.join(got, "object_id", "full_outer")
    reason = (
        F.when(F.col("chunks").isNull(), "no header")
        .when(F.coalesce("_n", F.lit(0)) != F.col("chunks"), "count")
        .when((F.col("_d") != F.col("_n")) | (F.col("_low") != 0) | (F.col("_high") != F.col("_n") - 1), "gap")
        .when(F.coalesce("_bytes", F.lit(0)) != F.col("bytes"), "bytes")
    )
    return both.select("object_id", reason.alias("reason")).where("reason IS NOT NULL")


def assembled_problems(chunks: DataFrame, headers: DataFrame) -> DataFrame:
    """chunk_problems, and objects whose chunks (object_id, seq, body), put together in order, have another digest than the header's sha256: (object_id, reason).

    Bodies are hashed as a stream of sorted chunks, so an object of any size takes one batch of memory.
    """
    sized = chunks.withColumn("n_bytes", F.octet_length("body").cast("long"))
    broken = chunk_problems(sized, headers)
    kind = headers.schema["object_id"].dataType
    made = ordered_digests(chunks, "object_id", ("seq",), "body").select(F.col("object_id").cast(kind).alias("object_id"), F.col("sha256").alias("_made"))
    unlike = headers.join(made, "object_id").where(~F.col("_made").eqNullSafe(F.col("sha256"))).select("object_id", F.lit("digest").alias("reason"))
    return broken.unionByName(unlike.join(broken.select("object_id"), "object_id", "left_anti"))
