"""Deletes that are planned over several tables: in order, guarded, held to an exact cohort, and told in receipts."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.operators.graph import multiset_digest


@dataclass
class Step:
    """Rows of a table that go: those whose column holds a value of the parent's key, where the parent is a later step or a set that is given."""

    name: str
    rows: DataFrame
    column: str
    parent: str
    key: str


@dataclass
class Reset:
    kept: dict[str, DataFrame]
    receipt: DataFrame
    #: Guards that have rows: whoever writes what is kept must refuse while there are any.
    broken: DataFrame


def ordered_reset(steps: list[Step], owned: dict[str, DataFrame], guards: dict[str, tuple[str, str]]) -> Reset:
    """What is left of each table after the rows of an owner are gone, in the order of steps, and a receipt (step, name, deleted, kept, kind).

    A step's parent must come later, so that no row loses what it refers to before it goes itself. guards name a table and a condition on its own rows
    that go (unfinished or foreign work, say); their rows in the receipt have kind guard and count what holds. Each table is
    semi-joined to the rows of its parent that go; nothing is changed here.
    """
    names = [s.name for s in steps]
    for k, step in enumerate(steps):
        if step.parent not in owned and step.parent not in names[k + 1 :]:
            raise ValueError(f"{step.name} goes after {step.parent}, which it refers to")
    gone: dict[str, DataFrame] = {}
    kept: dict[str, DataFrame] = {}
    for step in reversed(steps):
        keys = (owned.get(step.parent) if step.parent in owned else gone[step.parent]).select(F.col(step.key).alias(step.column)).where(F.col(step.column).isNotNull()).distinct()
        gone[step.name] = step.rows.join(keys, step.column, "left_semi")
        kept[step.name] = step.rows.join(keys, step.column, "left_anti")
    count = lambda df, name: df.agg(F.count("*").alias(name))
    rows = []
    for k, step in enumerate(steps, 1):
        total = count(step.rows, "_all").crossJoin(count(gone[step.name], "deleted"))  # one row each
        rows.append(total.select(F.lit(k).alias("step"), F.lit(step.name).alias("name"), "deleted", (F.col("_all") - F.col("deleted")).alias("kept"), F.lit("delete").alias("kind")))
    held = [count(gone[table].where(condition), "deleted").select(F.lit(len(steps) + 1).alias("step"), F.lit(name).alias("name"), "deleted", F.lit(None).cast("long").alias("kept"), F.lit("guard").alias("kind")) for name, (table, condition) in guards.items()]
    receipt = reduce(DataFrame.unionByName, rows + held)
    return Reset(kept, receipt, receipt.where("kind = 'guard' AND deleted > 0"))


@dataclass
class Purge:
    left: DataFrame
    receipt: DataFrame


def exact_purge(table: DataFrame, cohort: DataFrame, expected: DataFrame, key: list[str], protected: DataFrame, dry_run: bool = True, receipts: DataFrame | None = None) -> Purge:
    """table without a cohort of keys, but only if the rows that would go are exactly those that are expected; else the table as it is.

    cohort has keys that are to go, expected the keys of all rows that are thought to be there; protected are rows of the table that are counted before
    and after. The receipt is one row: outcome (planned in a dry run, applied, already where receipts hold an applied one of the same
    expected cohort, or cohort differs), expected, found, missing, unexpected, deleted, protected_before, protected_after, cohort_digest.
    Nulls in keys match nothing; repeated keys of cohort and expected count once, repeated rows of the table each.
    """
    spark = table.sparkSession
    wanted = expected.select(*key).dropna().distinct()
    here = table.join(cohort.select(*key).distinct(), key, "left_semi")
    found = here.select(*key).distinct()
    both = wanted.withColumn("_a", F.lit(1)).join(found.withColumn("_b", F.lit(1)), key, "full_outer")
    sides = both.agg(F.count("_a").alias("expected"), F.count("_b").alias("found"), F.count_if(F.col("_b").isNull()).alias("missing"), F.count_if(F.col("_a").isNull()).alias("unexpected")).head()
    text = F.sha2(F.to_json(F.struct(*key)), 256)
    digest = multiset_digest(wanted.select(text.alias("d")), "d").head().digest
    already = receipts is not None and not receipts.where((F.col("outcome") == "applied") & (F.col("cohort_digest") == digest)).isEmpty()
    outcome = "already" if already else "cohort differs" if sides.missing or sides.unexpected else "planned" if dry_run else "applied"
    going = outcome in ("planned", "applied")
    without = table.join(found, key, "left_anti")
    before = protected.count()
    after = protected.join(found, key, "left_anti").count() if going else before
    values = (outcome, sides.expected, sides.found, sides.missing, sides.unexpected, here.count() if going else 0, before, after, digest)
    schema = "outcome string, expected long, found long, missing long, unexpected long, deleted long, protected_before long, protected_after long, cohort_digest string"
    return Purge(without if outcome == "applied" else table, spark.createDataFrame([values], schema))
