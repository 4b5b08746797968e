"""Set reconciliation of inventories: covers, grants, routes, transports and top-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cover(expected: DataFrame, actual: DataFrame, key: list[str]) -> DataFrame:
    """What keeps two sides from being the same set of unique keys: (key, reason)."""
    a = expected.groupBy(*key).agg(F.count("*").alias("_a"))
    b = actual.groupBy(*key).agg(F.count("*").alias("_b"))
    reason = F.when(F.col("_b").isNull(), "missing").when(F.col("_a").isNull(), "unexpected").when(F.col("_a") > 1, "repeated expected").when(F.col("_b") > 1, "repeated actual")
    return a.join(b, key, "full_outer").select(*key, reason.alias("reason")).where("reason IS NOT NULL")


def resolve_grants(grants: DataFrame, models: DataFrame) -> DataFrame:
    """Each distinct grant (key_hash, model, prefix) with what it stands for among models (model_id, name, prefix): an exact prefix, else the only model of the name.

    grants is how often it is made, models how many it stands for, last_id the greatest of their ids; resolution is exact, unique, ambiguous or unmatched.
    Several models of one name and prefix are all meant; they are counted here, so grants times models are never made as rows.
    """
    exact = models.groupBy(F.col("name").alias("model"), "prefix").agg(F.count("model_id").alias("_exact"), F.max("model_id").alias("_last"))
    single = models.groupBy(F.col("name").alias("model")).agg(F.count("*").alias("_n"), F.min("model_id").alias("_only"))
    made = grants.groupBy("key_hash", "model", "prefix").agg(F.count("*").alias("grants"))
    both = made.join(exact, ["model", "prefix"], "left").join(single, "model", "left")
    how = F.when(F.col("_exact") > 0, "exact").when(F.col("_n") == 1, "unique").when(F.col("_n") > 1, "ambiguous").otherwise("unmatched")
    n = F.when(how == "exact", F.col("_exact")).when(how == "unique", 1).otherwise(0).cast("long")
    last = F.when(how == "exact", F.col("_last")).when(how == "unique", F.col("_only"))
    return both.select("key_hash", "model", "prefix", "grants", n.alias("models"), last.alias("last_id"), how.alias("resolution"))


def grant_counts(resolved: DataFrame) -> DataFrame:
    """(key_hash, resolution, n, last_id): pairs of a grant and a model, a grant without model counting once, and the greatest id."""
    pairs = F.col("grants") * F.greatest("models", F.lit(1))
    return resolved.groupBy("key_hash", "resolution").agg(F.sum(pairs).alias("n"), F.max("last_id").alias("last_id"))


def policies(resolved: DataFrame, models: DataFrame) -> DataFrame:
    """Per key its models in order, and whether each grant found one."""
    ids = models.select(F.col("name").alias("model"), "prefix", "model_id")
    exact = resolved.where("resolution = 'exact'").join(ids, ["model", "prefix"]).select("key_hash", F.col("model_id").cast("string").alias("id"))
    unique = resolved.where("resolution = 'unique'").select("key_hash", F.col("last_id").cast("string").alias("id"))
    found = exact.union(unique).where("id IS NOT NULL").distinct().withColumn("ok", F.lit(True))
    rows = found.union(resolved.select("key_hash", F.lit(None).cast("string"), F.col("models") > 0))
    return rows.groupBy("key_hash").agg(F.array_join(F.array_sort(F.collect_list("id")), ",").alias("models"), F.bool_and("ok").alias("complete"))


def route_plan(wanted: DataFrame, live: DataFrame) -> DataFrame:
    """What to do for each wanted route (public_model, protocol, priority, definition): create, replay, update or conflict."""
    key = ["public_model", "protocol", "priority"]
    now = live.groupBy(*key).agg(F.count("*").alias("_n"), F.min("definition").alias("_definition"))
    what = F.when(F.col("_n").isNull(), "create").when(F.col("_n") > 1, "conflict").when(F.col("_definition") == F.col("definition"), "replay").otherwise("update")
    return wanted.join(now, key, "left").select(*key, what.alias("action"))


def transports(source: DataFrame, target: DataFrame) -> DataFrame:
    """Target of each source transport (id, name, base_url, config): by id, else by a name that is unique on both sides."""
    mark = F.sha2(F.concat_ws("\0", "base_url", "config"), 256)
    a, b = source.withColumn("_mark", mark), target.withColumn("_mark", mark)
    by_id = b.select("id", F.col("_mark").alias("_id_mark"))
    by_name = b.groupBy("name").agg(F.count("*").alias("_names"), F.min("id").alias("_name_id"), F.min("_mark").alias("_name_mark"))
    own = a.groupBy("name").agg(F.count("*").alias("_own"))
    sites = b.groupBy("base_url").agg(F.countDistinct("config").alias("_configs"))
    both = a.join(by_id, "id", "left").join(by_name, "name", "left").join(own, "name", "left").join(sites, "base_url", "left")
    result = (
        F.when(F.col("_id_mark").isNotNull(), F.when(F.col("_id_mark") == F.col("_mark"), "matched by id").otherwise("config differs"))
        .when(F.col("_names").isNull(), F.when(F.col("_configs") > 1, "base mixed").otherwise("absent"))
        .when((F.col("_names") > 1) | (F.col("_own") > 1), "name ambiguous")
        .when(F.col("_name_mark") != F.col("_mark"), "config differs")
        .otherwise("matched by name")
    )
    target_id = F.when(F.col("_id_mark").isNotNull(), F.col("id")).when(result == "matched by name", F.col("_name_id"))
    return both.select("id", target_id.alias("target_id"), result.alias("result"))


def merge_routes(routes: DataFrame) -> DataFrame:
    """Enabled routes (pattern, driver, config, candidate) by pattern with the union of candidates; mixed drivers or configs are rejected."""
    by_pattern = routes.where("enabled").groupBy("pattern").agg(F.countDistinct("driver", "config").alias("_n"), F.min("driver").alias("driver"), F.array_join(F.array_sort(F.collect_set("candidate")), ",").alias("candidates"))
    return by_pattern.select("pattern", "driver", "candidates", (F.col("_n") > 1).alias("rejected"))


def top_ups(accounts: DataFrame, maximum_micros: int) -> DataFrame:
    """(account_id, grant_micros) that lifts each account to the maximum; accounts at or above it get nothing."""
    missing = F.lit(maximum_micros).cast("long") - F.col("balance_micros")
    return accounts.select("account_id", missing.alias("grant_micros")).where("grant_micros > 0")


def purge(table: DataFrame, cohort: DataFrame, key: list[str]) -> DataFrame:
    """What is left of a table without an exact cohort."""
    return table.join(cohort.select(*key), key, "left_anti")
