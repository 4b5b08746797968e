"""Reachability along references: chains are jumped over by doubled steps, so rounds follow the logarithm of their length.

Edges are (from_id, to_id). A unary node has one edge that counts; a table of jumps for each power of two leads from a unary
node as many steps on, as long as all nodes between are unary. Every table is written once, and none holds more than a row a node.
Tables of nodes are joined by sorting: a few MB of shuffled ids would otherwise be sent through the driver as millions of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.sources.tables import written

#: Levels of nodes above the leaves that are left out of the chains and followed one by one.
PEEL = 3


class Jumps:
    """levels[k] has (id, to) for 2^k steps; ends has (id, end) of unary nodes, whose chain ends at a node that is none; circular has the ids of those whose chain never ends."""

    def __init__(self, steps: DataFrame):
        """steps: (id, to), one row for each unary node."""
        self.levels = [written(steps.select("id", "to"))]
        n = self.levels[0].count()
        now = self.levels[0].withColumnRenamed("to", "end")
        while n and 1 << len(self.levels) <= 2 * n:
            last = self.levels[-1]
            further = written(last.join(last.toDF("to", "_next").hint("merge"), "to").select("id", F.col("_next").alias("to")))
            now = written(now.join(now.toDF("end", "_next").hint("merge"), "end", "left").select("id", F.coalesce("_next", "end").alias("end")))
            if further.isEmpty():
                break
            self.levels.append(further)
        far = now.join(self.levels[0].select(F.col("id").alias("end")).hint("merge"), "end", "left_semi").select("id")  # still at a unary node after more steps than there are nodes
        self.circular = written(far)
        self.ends = written(now.join(self.circular.hint("merge"), "id", "left_anti"))

    def passed(self, entries: DataFrame) -> DataFrame:
        """All ids from some entries (id, and columns that are carried along) on along their chains, the ends too."""
        found = entries.distinct()
        carried = [c for c in found.columns if c != "id"]
        for level in reversed(self.levels):
            found = written(found.unionByName(found.join(level.hint("merge"), "id").select(F.col("to").alias("id"), *carried)).distinct())
        return found

    def lifted(self, rows: DataFrame) -> DataFrame:
        """rows (id, steps, ...) with at: the node so many steps on, null if the chain is shorter."""
        out = rows.withColumn("at", F.col("id"))
        for k, level in enumerate(self.levels):
            taken = out.join(level.toDF("at", "_next").hint("merge"), "at", "left")
            out = taken.withColumn("at", F.when(F.col("steps").bitwiseAND(1 << k) != 0, F.col("_next")).otherwise(F.col("at"))).drop("_next")
        return out.withColumn("at", F.when(F.col("steps") < 1 << len(self.levels), F.col("at")))


def _core(edges: DataFrame) -> DataFrame:
    """Edges to nodes that stand PEEL levels above leaves, or lead to a circle."""
    for _ in range(PEEL):
        edges = written(edges.join(edges.select(F.col("from_id").alias("to_id")).distinct().hint("merge"), "to_id", "left_semi"))
    return edges


def _contracted(edges: DataFrame) -> tuple[Jumps, DataFrame]:
    """The jumps over unary nodes, and the edges of all others."""
    degrees = edges.groupBy("from_id").agg(F.count("*").alias("_n"), F.min("to_id").alias("to"))
    jumps = Jumps(degrees.where("_n = 1").select(F.col("from_id").alias("id"), "to"))
    branches = written(edges.join(degrees.where("_n > 1").select("from_id").hint("merge"), "from_id", "left_semi").select("from_id", "to_id"))
    return jumps, branches


def reachable(roots: DataFrame, edges: DataFrame) -> DataFrame:
    """All that roots (id, and columns that are carried along, such as a tenant) reach, themselves included: each id once for each
    value carried. Edges may form circles. There is no cap on depth.

    Only nodes with more than one edge into the upper levels cost a round each level; chains between them are one jump.
    """
    edges = written(edges.select("from_id", "to_id").distinct())
    jumps, branches = _contracted(_core(edges))
    key = ["id", *(c for c in roots.columns if c != "id")]
    carried = key[1:]
    new = written(roots.select(*key).distinct())
    entries = [new]
    while True:
        at = new.join(jumps.ends.hint("merge"), "id", "left").select(F.coalesce("end", "id").alias("from_id"), *carried).distinct()
        new = at.join(branches.hint("merge"), "from_id").select(F.col("to_id").alias("id"), *carried).distinct()
        new = written(new.join(_union(entries).hint("merge"), key, "left_anti"))
        if new.isEmpty():
            break
        entries.append(new)
        if len(entries) > 16:  # few tables to look into, each id still written a bounded number of times
            entries = [written(_union(entries))]
    found = [jumps.passed(_union(entries))]
    new = found[0]
    while True:  # what was peeled: PEEL levels
        new = new.join(edges.withColumnRenamed("from_id", "id").hint("merge"), "id").select(F.col("to_id").alias("id"), *carried).distinct()
        new = written(new.join(_union(found).hint("merge"), key, "left_anti"))
        if new.isEmpty():
            return _union(found)
        found.append(new)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def circular(edges: DataFrame) -> DataFrame:
    """(id) of nodes from which a circle is reached, those in one included.

    Nodes are taken away from the leaves up, chains at once; what can't be taken away leads to a circle.
    """
    edges = _core(written(edges.select("from_id", "to_id").distinct()))
    jumps, branches = _contracted(edges)
    to = branches.join(jumps.ends.withColumnRenamed("id", "to_id").hint("merge"), "to_id", "left").select("from_id", F.coalesce("end", "to_id").alias("to_id")).distinct()
    left = written(to)
    endless = jumps.circular.select(F.col("id").alias("to_id"))
    while True:
        alive = left.select(F.col("from_id").alias("to_id")).union(endless).distinct()
        kept = written(left.join(alive.hint("merge"), "to_id", "left_semi"))
        if kept.count() == left.count():
            break
        left = kept
    rest = left.select(F.col("from_id").alias("id")).distinct()
    before = jumps.ends.join(rest.withColumnRenamed("id", "end").hint("merge"), "end", "left_semi").select("id")
    return rest.union(before).union(jumps.circular).distinct()


def ancestry_problems(heads: DataFrame, nodes: DataFrame) -> DataFrame:
    """(head, problem): why the chain of a manifest's head is not whole; none for those that are.

    heads has head, event_count, branch_id, parent_event_id and parent_branch_id (both null, or both set); nodes have id, parent (null at
    the first), event_count, event_id, branch_id, parent_event_id. Of several the first of: head missing, branch parent half set, count, circle,
    order (a node's count isn't one more than its parent's, down to 1), branch, identity (an event stands twice in the chain), parent
    event (it doesn't stand before its event in the chain), branch parent (it isn't in the chain).

    A pair of event and place is looked up by lifting: from a node as many steps on as the counts differ. So no chain is
    walked, and a chain that many heads share is looked at once.
    """
    up = nodes.where("parent IS NOT NULL")
    jumps = Jumps(up.select("id", F.col("parent").alias("to")))
    above = nodes.select(F.col("id").alias("parent"), (F.col("event_count") + 1).alias("_due"), F.lit(True).alias("_there"))
    checked = nodes.join(above, "parent", "left")
    order = F.when(F.col("parent").isNull(), F.col("event_count") != 1).otherwise(~F.coalesce(F.col("_there") & (F.col("event_count") == F.col("_due")), F.lit(False)))
    # where each event stands: (event, count) has few nodes, and only one of them can be on a chain
    stands = nodes.select("event_id", F.col("event_count").alias("_count"), F.col("id").alias("_node"))
    places = stands.select("event_id", "_count").distinct()

    def on_chain(rows: DataFrame) -> DataFrame:
        """rows (id, event_count, event_id, strict) whose chain holds the event at or above the row's node (strict: above)."""
        asked = rows.join(places, "event_id").where(F.when(F.col("strict"), F.col("_count") < F.col("event_count")).otherwise(F.col("_count") <= F.col("event_count")))
        at = jumps.lifted(asked.withColumn("steps", F.col("event_count") - F.col("_count")))
        return at.join(stands.withColumnRenamed("_node", "at"), ["event_id", "_count", "at"], "left_semi")

    twice = on_chain(nodes.select("id", "event_count", "event_id", F.lit(True).alias("strict"))).select("id").distinct()
    asks = nodes.where("parent_event_id IS NOT NULL").select("id", "event_count", F.col("parent_event_id").alias("event_id"), F.lit(True).alias("strict"))
    orphans = asks.select("id").join(on_chain(asks).select("id").distinct(), "id", "left_anti")
    bad = checked.where(order).select("id", F.lit("order").alias("problem")).union(twice.select("id", F.lit("identity"))).union(orphans.select("id", F.lit("parent event")))
    bad = bad.union(jumps.circular.select("id", F.lit("circle")))
    # a head has a problem if a node of its chain has: nodes below the bad ones are told by following the chains the other way round
    ranks = ["head missing", "branch parent half set", "count", "circle", "order", "branch", "identity", "parent event", "branch parent"]
    rank = F.create_map(*[x for k, r in enumerate(ranks) for x in (F.lit(r), F.lit(k))])
    worst = written(bad.groupBy("id").agg(F.min(rank[F.col("problem")]).alias("rank")))
    for level in jumps.levels:  # the worst within 2^k steps, doubled
        further = level.join(worst.toDF("to", "_rank").hint("merge"), "to").select("id", F.col("_rank").alias("rank"))
        worst = written(worst.union(further).groupBy("id").agg(F.min("rank").alias("rank")))
    first = nodes.select(F.col("id").alias("head"), F.col("event_count").alias("_count"), F.col("branch_id").alias("_branch"))
    own = heads.join(first, "head", "left").join(worst.withColumnRenamed("id", "head"), "head", "left")
    half = F.col("parent_event_id").isNull() != F.col("parent_branch_id").isNull()
    asks = heads.where("parent_event_id IS NOT NULL").join(first, "head").select(F.col("head").alias("id"), F.col("_count").alias("event_count"), F.col("parent_event_id").alias("event_id"), F.col("parent_branch_id").alias("_want"), F.lit(False).alias("strict"))
    at = on_chain(asks).join(nodes.select(F.col("id").alias("at"), F.col("branch_id").alias("_is")), "at").where("_is = _want").select(F.col("id").alias("head"), F.lit(True).alias("_found")).distinct()
    own = own.join(at, "head", "left")
    mine = (
        F.when(F.col("_count").isNull(), 0).when(half, 1).when(F.col("_count") != F.col("event_count"), 2)
        .when(~F.col("_branch").eqNullSafe(F.col("branch_id")), 5).when(F.col("parent_event_id").isNotNull() & F.col("_found").isNull(), 8)
    )
    found = own.select("head", F.least(mine, F.col("rank")).alias("_rank")).where("_rank IS NOT NULL")
    return found.select("head", F.element_at(F.array(*[F.lit(r) for r in ranks]), F.col("_rank") + 1).alias("problem"))
