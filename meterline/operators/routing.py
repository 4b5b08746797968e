"""Which accounts may serve a request: ordered wildcard patterns over an index, aliases, prefix policy, and transports matched between two inventories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Letters of a piece inside a pattern by which it is looked up.
GRAM = 3


def _pieces(pattern: Column) -> tuple[Column, Column, Column]:
    """What stands before the first * of a pattern, the pieces between, and what stands after the last, in lower case."""
    parts = F.split(F.lower(pattern), r"\*", -1)
    return F.get(parts, F.lit(0)), F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 2, F.lit(0))), F.get(parts, F.size(parts) - 1)


def _fits(first: Column, middle: Column, last: Column, low: Column) -> Column:
    """Whether a text in lower case matches the pieces of a pattern; those between are looked for last, as that costs most."""
    end = F.aggregate(
        middle,
        F.struct(F.length(first).alias("skip"), F.lit(True).alias("ok")),
        lambda s, part: F.struct(
            F.when(s["ok"], F.position(part, low, s["skip"] + 1) - 1 + F.length(part)).otherwise(s["skip"]).alias("skip"),
            (s["ok"] & (F.position(part, low, s["skip"] + 1) > 0)).alias("ok"),
        ),
    )
    return F.startswith(low, first) & F.endswith(low, last) & ((F.size(middle) == 0) | end["ok"])


def wildcard(pattern: Column, text: Column) -> Column:
    """Whether text matches a pattern whose only sign is *, in either case.

    The text starts with what stands before the first *, ends with what stands after the last, and has the pieces between in order. Start and
    end may overlap, and a pattern without * only has to be both: these are the rules of the tool whose results have to be met.
    """
    return _fits(*_pieces(pattern), F.lower(text))


def _keys(patterns: DataFrame) -> DataFrame:
    """patterns with kind and key: the literal start, else the literal end, else GRAM letters of the longest piece inside, else none."""
    parts = F.split(F.lower("pattern"), r"\*", -1)
    first, last = F.get(parts, F.lit(0)), F.get(parts, F.size(parts) - 1)
    inner = F.aggregate(parts, F.lit(""), lambda longest, p: F.when(F.length(p) > F.length(longest), p).otherwise(longest))
    kind = F.when(first != "", "start").when(last != "", "end").when(F.length(inner) >= GRAM, "gram").otherwise("any")
    key = F.when(first != "", first).when(last != "", last).when(F.length(inner) >= GRAM, F.substr(inner, F.lit(1), F.lit(GRAM))).otherwise("")
    return patterns.withColumns({"kind": kind, "key": key})


def _start_of(low: Column):
    return lambda n: F.struct(F.lit("start").alias("kind"), F.left(low, n).alias("key"))


def _end_of(low: Column):
    return lambda n: F.struct(F.lit("end").alias("kind"), F.right(low, n).alias("key"))


def matches(values: DataFrame, patterns: DataFrame) -> DataFrame:
    """(value, pattern, place) for each distinct value and each pattern (place, pattern) that it matches.

    Patterns are indexed by a literal part; a value is looked up under its starts and ends of the lengths that occur, and under its
    grams where a pattern needs them. So values are read once, and a value meets the patterns that share a part with it.
    """
    index = _keys(patterns)
    lengths = index.groupBy("kind").agg(F.collect_set(F.length("key")).alias("n")).collect()  # a row for each kind
    of = {r.kind: sorted(r.n) for r in lengths}
    low = F.lower("value")
    keys = F.array(F.struct(F.lit("any").alias("kind"), F.lit("").alias("key"))) if "any" in of else F.array().cast("array<struct<kind:string,key:string>>")
    for kind in ("start", "end"):
        if kind in of:
            fit = F.filter(F.array(*[F.lit(n) for n in of[kind]]), lambda n: n <= F.length(low))
            keys = F.concat(keys, F.transform(fit, _start_of(low) if kind == "start" else _end_of(low)))
    if "gram" in of:
        at = F.when(F.length(low) >= GRAM, F.sequence(F.lit(1), F.length(low) - GRAM + 1)).otherwise(F.array().cast("array<int>"))
        keys = F.concat(keys, F.array_distinct(F.transform(at, lambda i: F.struct(F.lit("gram").alias("kind"), F.substr(low, i, F.lit(GRAM)).alias("key")))))
    asked = values.select("value").where("value IS NOT NULL").distinct().select("value", F.inline(keys))
    return asked.join(index, ["kind", "key"]).where(wildcard(F.col("pattern"), F.col("value"))).select("value", "pattern", "place")


def first_match(values: DataFrame, patterns: DataFrame) -> DataFrame:
    """values (value, ...) with the pattern that comes first in order (place) of those it matches, null if there is none."""
    first = matches(values, patterns).groupBy("value").agg(F.min_by("pattern", "place").alias("pattern"))
    return values.join(first, "value", "left")


def candidates(requests: DataFrame, auths: DataFrame, aliases: DataFrame, excluded: DataFrame, registered: DataFrame, force_prefix: bool) -> DataFrame:
    """(request, auth, upstream_model): the accounts that may serve each request.

    requests: request, model, group and upstream_prefix (either may be null); auths: auth, prefix, groups (array); aliases: auth (null: for all), place,
    alias, name; excluded: auth, pattern; registered: auth, model. An account's own aliases come before those for all, and within each
    the first in order counts. A request with a prefix needs an account of that prefix; one without may not go to an account with
    a prefix where prefixes are forced. The model asked for, or what it stands for there, must be registered, and the latter not excluded. Names are
    compared in either case.

    Pairs come from registered models by equal names, so no request meets an account without one, and each carries how it was found: what
    was asked for is enough; what it stands for in general is not where the account has an alias of its own; that alias is looked up by itself. So
    no pair is held against the registered models again.
    """
    own = aliases.where("auth IS NOT NULL").groupBy("auth", F.lower("alias").alias("low")).agg(F.min_by("name", "place").alias("own"))
    shared = aliases.where("auth IS NULL").groupBy(F.lower("alias").alias("low")).agg(F.min_by("name", "place").alias("shared"))
    asked = F.when(F.col("upstream_prefix").isNull(), F.col("model")).otherwise(F.concat_ws("/", "upstream_prefix", "model"))
    wanted = requests.where("request IS NOT NULL").withColumns({"low": F.lower("model"), "asked": F.lower(asked)}).join(shared, "low", "left")
    wanted = wanted.select("request", "low", "group", "upstream_prefix", "asked", F.coalesce("shared", "model").alias("general"))
    has = registered.select("auth", F.lower("model").alias("held")).distinct()
    prefix = F.when(F.col("upstream_prefix").isNotNull(), F.col("prefix").eqNullSafe(F.col("upstream_prefix"))).otherwise(F.lit(not force_prefix) | F.col("prefix").isNull())
    group = F.col("group").isNull() | F.coalesce(F.array_contains("groups", F.col("group")), F.lit(False))
    allowed = lambda rows: rows.join(auths, "auth").where(prefix & group)
    held = F.explode(F.array_distinct(F.array("asked", F.lower("general")))).alias("held")
    direct = allowed(wanted.select("*", held).join(has, "held")).select("request", "auth", "low", "general", (F.col("held").eqNullSafe(F.col("asked"))).alias("enough"))
    by_name = direct.join(own, ["auth", "low"], "left").where("enough OR own IS NULL").select("request", "auth", F.coalesce("own", "general").alias("upstream_model"))
    named = own.withColumn("held", F.lower("own")).join(has, ["auth", "held"], "left_semi").select("auth", "low", "own")
    by_alias = allowed(wanted.join(named, "low")).select("request", "auth", F.col("own").alias("upstream_model"))
    served = by_name.union(by_alias).distinct()
    first, middle, last = _pieces(F.col("pattern"))  # taken apart once for each account, not for each pair
    shut = excluded.select(F.col("auth").alias("_auth"), first.alias("_first"), middle.alias("_middle"), last.alias("_last"))
    return served.join(shut, (F.col("auth") == F.col("_auth")) & _fits(*map(F.col, ("_first", "_middle", "_last")), F.lower("upstream_model")), "left_anti")


#: Why a candidate has no transport, in the order in which they are looked for.
GAPS = (
    "source_candidate_unavailable", "source_candidate_metadata_mismatch", "source_proxy_unverifiable", "target_absent", "target_ambiguous", "target_inactive", "target_driver_mismatch",
    "target_transport_invalid", "target_config_mismatch", "shared_base_transport_conflict",
)
DRIVER = "http-json"


def reconcile_transports(sources: DataFrame, targets: DataFrame, wanted: DataFrame) -> DataFrame:
    """(source_id, target_id, reason, uncovered, distinct_transports): each wanted candidate (source_id, provider) with its target, or the gap.

    sources: source_id, provider, name, disabled, proxied, base_url, config (canonical JSON without transport fields); targets: target_id, name,
    status, driver, base_url, scope, origins (array, null for none), config. A candidate is found by its id, its target by a name that only one target
    has; then both must agree in all but scope and origins. All sources of one base URL must be candidates with a target
    and one transport between them, else none of them has one: uncovered and distinct_transports say how that failed. Ids are distinct on each side.
    """
    c = F.col
    s = sources.select("source_id", c("provider").alias("_provider"), "name", "disabled", "proxied", "base_url", c("config").alias("_config"), F.lit(True).alias("_known"))
    named = targets.groupBy("name").agg(F.count("*").alias("_names"), *[F.min_by(x, "target_id").alias(f"t_{x}") for x in ("target_id", "status", "driver", "base_url", "scope", "origins", "config")])
    rows = wanted.join(s, "source_id", "left").join(named, "name", "left")
    invalid = c("t_scope").isNull() | ~c("t_scope").isin("public", "private")
    bad_origin = F.exists(F.coalesce("t_origins", F.array().cast("array<string>")), lambda o: o.isNull() | ~o.rlike("^https://[^/?#]+$"))
    differs = ~c("t_base_url").eqNullSafe(c("base_url")) | ~c("t_config").eqNullSafe(c("_config"))
    reason = (
        F.when(c("_known").isNull() | c("disabled"), GAPS[0]).when(c("_provider") != c("provider"), GAPS[1]).when(c("proxied"), GAPS[2]).when(c("_names").isNull(), GAPS[3])
        .when(c("_names") > 1, GAPS[4]).when(c("t_status") != "active", GAPS[5]).when(c("t_driver") != DRIVER, GAPS[6]).when(invalid, GAPS[7]).when(c("t_scope") == "private", GAPS[2])
        .when(differs, GAPS[8]).when(c("base_url").isNull() | bad_origin, GAPS[7])
    )
    rows = rows.withColumn("reason", reason)
    signature = F.to_json(F.struct("t_scope", "t_origins"), {"ignoreNullFields": "false"})
    groups = rows.where("reason IS NULL").groupBy("base_url").agg(F.countDistinct(signature).alias("distinct_transports"), F.countDistinct("source_id").alias("_members"))
    all_ = sources.groupBy("base_url").agg(F.count("*").alias("_all"))
    state = groups.join(all_, "base_url").select("base_url", "distinct_transports", (c("_all") - c("_members")).alias("uncovered"))
    both = rows.join(state, "base_url", "left")
    clash = c("reason").isNull() & ((c("distinct_transports") != 1) | (c("uncovered") != 0))
    final = F.when(clash, GAPS[9]).otherwise(c("reason"))
    return both.select(
        "source_id", F.when(final.isNull(), c("t_target_id")).alias("target_id"), final.alias("reason"), F.when(clash, c("uncovered")).alias("uncovered"), F.when(clash, c("distinct_transports")).alias("distinct_transports")
    )
