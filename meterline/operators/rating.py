"""Tiered usage rating: which price applies to an event, what it costs in micros, and what is wrong with it.

Money is exact. Prices per million tokens become whole ten-millionths, multipliers whole tenths, and the only rounding
(half away from zero) is the last step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.functions.scalars import applied_tier, plain, slug
from meterline.sources.tables import shared_checkpoints, written

COMPONENTS = ("prompt", "completion", "cache", "cache_read", "cache_creation")
#: Models with a long-context surcharge, by exact slug or prefix, beyond so many tokens.
LONG_CONTEXT_TOKENS = 272000
LONG_CONTEXT_SLUGS = ("gpt-5.5", "gpt-5.4", "gpt-5.4-pro", "gpt-5.6")
LONG_CONTEXT_PREFIXES = ("gpt-5.5-20", "gpt-5.4-20", "gpt-5.4-pro-20", "gpt-5.6-")
#: Models whose priority service costs 2.5 times and twice as much.
PRIORITY_25 = (("gpt-5.5",), ("gpt-5.5-20",))
PRIORITY_20 = (("gpt-5.6", "gpt-5.4", "gpt-5.3-codex"), ("gpt-5.6-", "gpt-5.4-", "gpt-5.3-codex-"))
#: Service tiers that can be billed.
KNOWN_TIERS = ("default", "auto", "priority", "flex", "scale", "batch", "standard_only")
UNIT = 10_000_000
#: Prices that a cost is made of, by the names of their rates.
RATES = ("prompt", "legacy_cache", "cache_read", "cache_creation", "output")


def _named(text: Column, names: tuple[str, ...], prefixes: tuple[str, ...]) -> Column:
    found = text.isin(*names)
    for p in prefixes:
        found |= text.startswith(p)
    return found


def _book(table: DataFrame, *keep: str) -> list[Column]:
    """Prices of a row as whole units and flags as booleans; a table without a flag column has it set."""
    out: list[Column] = [F.col(k) for k in keep]
    for c in COMPONENTS:
        out.append((F.col(f"{c}_per_1m").cast("decimal(18,6)") * UNIT).cast("decimal(18,0)").alias(c))
        flag = f"{c}_configured"
        out.append((F.col(flag) != 0 if flag in table.columns else F.lit(True)).alias(f"has_{c}"))
    return out


def price_book(prices: DataFrame, context: DataFrame, service: DataFrame) -> DataFrame:
    """(model, priced, tiered, cases): what each price row comes to in every case; all that doesn't depend on an event's tokens is worked out here.

    cases has the service names that have prices of their own, then a null name for all others; each has context tiers, the largest
    threshold first, then one without a threshold. Of both the first that fits applies. usual is what counts with prices of service tiers, aside
    what counts where these are set aside. Of service tiers with one name the first is taken.
    """
    c = F.col
    service = service.withColumns({"mode": plain(c("mode")), "service_tier": plain(c("service_tier"))})
    names = service.withColumn("_name", F.explode(F.array_distinct(F.array("mode", "service_tier"))))
    names = names.groupBy("model", "_name").agg(F.min_by(F.struct(*_book(service)), F.struct("mode", "service_tier")).alias("_service"))
    tiers = context.select("model", c("threshold_tokens").alias("above"), F.struct(*_book(context)).alias("book"))
    models = prices.select("model").union(context.select("model")).union(service.select("model")).where("model IS NOT NULL").distinct()
    base = prices.select("model", F.lit(True).alias("priced"), F.struct(*_book(prices)).alias("_base"))

    def gathered(rows: DataFrame, by: str, name: str) -> DataFrame:
        none = models.withColumns({k: F.lit(None).cast(rows.schema[k].dataType) for k in (by, "book")})
        return rows.where(c(by).isNotNull()).unionByName(none).groupBy("model").agg(F.sort_array(F.collect_list(F.struct(by, "book")), asc=False).alias(name))

    rows = models.join(base, "model", "left").join(context.select("model", F.lit(True).alias("tiered")).distinct(), "model", "left")
    rows = rows.join(gathered(tiers, "above", "_tiers"), "model").join(gathered(names.toDF("model", "name", "book"), "name", "_names"), "model")

    def case(by_context: Column, by_service: Column, tier: Column, own: Column) -> Column:
        def choose(name: str, flag: bool) -> Column:
            value = lambda book: F.lit(True) if flag else book[name]
            usual = F.coalesce(c("_base")["has_" + name], F.lit(False)) if flag else c("_base")[name]
            return F.when(by_context & tier[f"has_{name}"], value(tier)).when(by_service & own[f"has_{name}"], value(own)).otherwise(usual)

        price = {k: F.coalesce(choose(k, False), F.lit(0).cast("decimal(18,0)")) for k in COMPONENTS}
        has = {k: choose(k, True) for k in COMPONENTS}
        read = F.when(has["cache_read"] | (price["cache_read"] > 0), price["cache_read"]).when(price["cache"] > 0, price["cache"]).otherwise((price["prompt"] / 10).cast("decimal(18,0)"))
        creation = F.when(has["cache_creation"] | (price["cache_creation"] > 0), price["cache_creation"]).otherwise(price["prompt"])
        used = {"prompt": price["prompt"], "legacy_cache": price["cache"], "cache_read": read, "cache_creation": creation, "output": price["completion"]}
        return F.struct(
            *[has[k].alias(f"has_{k}") for k in ("prompt", "cache_read", "cache_creation")], *[(choose(k, False).isNotNull() & has[k]).alias(f"exact_{k}") for k in ("prompt", "completion")],
            *[v.cast("long").alias(f"unit_{k}") for k, v in used.items()], *[F.round(v / 10).cast("long").alias(f"rate_{k}") for k, v in used.items()],
        )

    def of_tier(name: Column):
        def of(t: Column) -> Column:
            by_context = t["above"].isNotNull()
            by_service = name["name"].isNotNull() & ~by_context
            usual, aside = (case(by_context, use, t["book"], name["book"]) for use in (by_service, F.lit(False)))
            return F.struct(t["above"].alias("above"), by_context.alias("by_context"), by_service.alias("by_service"), usual.alias("usual"), aside.alias("aside"))

        return of

    cases = F.transform("_names", lambda n: F.struct(n["name"].alias("name"), F.transform("_tiers", of_tier(n)).alias("tiers")))
    return rows.select("model", F.coalesce("priced", F.lit(False)).alias("priced"), F.coalesce("tiered", F.lit(False)).alias("tiered"), cases.alias("cases"))


def select_prices(usage: DataFrame, prices: DataFrame, context: DataFrame, service: DataFrame) -> DataFrame:
    """Events with billing_model, pricing_model and what applies of price_book(); events of a model without any price have nulls there.

    The billed model's price comes before the asked model's. Of context tiers the one with the largest threshold below the input applies. The book is
    written down first: its size is then known, and Spark broadcasts it while it is small, so events aren't shuffled by the few models
    that there are; it joins by sort otherwise. The session needs a checkpoint folder.
    """
    c, total = F.col, F.col("normalized_total_input_tokens")
    shared_checkpoints(usage.sparkSession)
    book = written(price_book(prices, context, service)).select("model", F.struct("model", "priced", "tiered", "cases").alias("_book"))
    billing = F.coalesce(F.get(F.filter(F.array("resolved_model", "model"), lambda m: m != ""), F.lit(0)), F.lit("-"))
    events = usage.withColumn("billing_model", billing)
    events = events.join(book.select(c("model").alias("billing_model"), c("_book").alias("_billed")), "billing_model", "left")
    events = events.join(book.where("_book.priced").withColumnRenamed("_book", "_listed"), "model", "left")
    events = events.withColumns({"_book": F.when(c("_billed.priced"), c("_billed")).otherwise(F.coalesce("_listed", "_billed")), "_asked": plain(c("service_tier"))}).drop("_billed", "_listed")
    named = F.get(F.filter(c("_book.cases"), lambda n: n["name"].isNull() | (n["name"] == c("_asked"))), F.lit(0))
    offer = F.get(F.filter(named["tiers"], lambda t: t["above"].isNull() | (t["above"] < total)), F.lit(0))
    surcharged = F.coalesce((total > LONG_CONTEXT_TOKENS) & _named(slug(c("billing_model")), LONG_CONTEXT_SLUGS, LONG_CONTEXT_PREFIXES), F.lit(False))
    events = events.withColumns({"_offer": offer, "_surcharged": surcharged, "_hurry": c("_asked").isin("priority", "fast")})
    tiered, priced = (F.coalesce(f"_book.{k}", F.lit(False)) for k in ("tiered", "priced"))
    events = events.withColumns({"pricing_model": F.coalesce("_book.model", "billing_model"), "_priced": priced, "_long": c("_surcharged") & ~tiered})
    return events.withColumn("_price", F.when(c("_long") & c("_hurry"), c("_offer.aside")).otherwise(c("_offer.usual"))).drop("_book", "_surcharged")


def rate(usage: DataFrame, prices: DataFrame, context: DataFrame, service: DataFrame) -> DataFrame:
    """Usage events with the price rule, effective prices in micros per million, cost_micros and validation_error ('' when right)."""
    rows = select_prices(usage, prices, context, service)
    c, asked, none = F.col, F.col("_asked"), F.lit(0).cast("long")
    flags = {f"_{k}": F.coalesce(f"_price.{k}", F.lit(False)) for k in ("has_prompt", "has_cache_read", "has_cache_creation", "exact_prompt", "exact_completion")}
    flags |= {f"_{k}": F.coalesce(f"_offer.{k}", F.lit(False)) for k in ("by_context", "by_service")}
    units = {f"_unit_{k}": F.coalesce(f"_price.unit_{k}", none) for k in RATES}
    told = {f"{k}_micros_per_million": F.coalesce(f"_price.rate_{k}", none) for k in RATES}
    rows = rows.withColumns(flags | units | told | {"context_threshold_tokens": F.coalesce("_offer.above", F.lit(-1))}).drop("_price", "_offer")
    name = slug(c("billing_model"))
    times = (
        F.when(c("_by_context") | c("_by_service") | (c("_long") & c("_hurry")), 10)
        .when(asked.isin("flex", "batch"), 5)
        .when(c("_hurry") & _named(name, *PRIORITY_25), 25)
        .when(c("_hurry") & _named(name, *PRIORITY_20), 20)
        .otherwise(10)
    )
    some = lambda k: F.greatest(F.coalesce(k, none), none)
    residual = F.greatest(F.greatest(F.coalesce("cached_tokens", none), F.coalesce("cache_tokens", none)) - some("cache_read_tokens") - some("cache_creation_tokens"), none)
    rows = rows.withColumns({"_times": times.cast("long"), "residual_cached_tokens": residual})
    whole = lambda k: F.coalesce(k, none)
    amounts = {"prompt": whole("normalized_uncached_input_tokens"), "legacy_cache": whole("residual_cached_tokens"), "cache_read": some("cache_read_tokens"), "cache_creation": whole("normalized_cache_creation_tokens"), "output": whole("output_tokens")}
    rule = (
        F.when(~c("_priced"), "zero-token")
        .when(c("_by_context"), "context")
        .when(c("_long") & c("_hurry"), "legacy-long-base")
        .when(c("_by_service"), "service")
        .when(c("_long"), "legacy-long")
        .otherwise("base")
    )
    rows = rows.withColumns({"cost_micros": cost(amounts), "pricing_rule": rule, "applied_service_tier": applied_tier(c("service_tier"))})
    rows = rows.withColumn("validation_error", validation_error())
    return rows.select([k for k in rows.columns if not k.startswith("_")])


def cost(amounts: dict[str, Column]) -> Column:
    """Micros of tokens at _unit_ prices, times tenths, rounded half away from zero. Sums that 64 bits surely hold are made in them, all others in decimals."""
    tenths = {k: F.when(F.col("_long"), 15 if k == "output" else 20).otherwise(10).cast("long") for k in RATES}
    units = {k: F.col(f"_unit_{k}") for k in RATES}
    # five products of at most 3e15, times 20 and 25 tenths, stay below 2 ** 63
    small = (F.least(*amounts.values()) >= 0) & (F.least(*units.values()) >= 0) & (F.greatest(*amounts.values()).cast("double") * F.greatest(*units.values()).cast("double") < 3e15)
    fast = F.col("_times").cast("long") * sum((amounts[k] * units[k] * tenths[k] for k in RATES[1:]), amounts[RATES[0]] * units[RATES[0]] * tenths[RATES[0]])
    parts = F.array(*[F.struct(amounts[k].cast("decimal(15,0)").alias("n"), units[k].cast("decimal(18,0)").alias("unit"), (tenths[k] * F.col("_times")).cast("decimal(4,0)").alias("tenths")) for k in RATES])
    zero, one = F.lit(0).cast("decimal(38,0)"), F.lit(UNIT * 100).cast("decimal(38,0)")
    wide = F.aggregate(parts, zero, lambda s, p: (s + p["n"] * p["unit"] * p["tenths"]).cast("decimal(38,0)"))
    half = F.lit(UNIT * 50).cast("decimal(38,0)")
    rounded = F.transform(F.array(wide), lambda w: w + F.when(w < 0, -half).otherwise(half))[0]
    return F.when(small, F.call_function("div", fast + UNIT * 50, F.lit(UNIT * 100))).otherwise(((rounded - rounded % one) / one).cast("long"))


def validation_error() -> Column:
    """The first rule that a rated row breaks, '' if none."""
    c = F.col
    total, uncached = c("normalized_total_input_tokens"), c("normalized_uncached_input_tokens")
    read, creation = c("normalized_cache_read_tokens"), c("normalized_cache_creation_tokens")
    signed = ["input_tokens", "output_tokens", "reasoning_tokens", "cached_tokens", "cache_tokens", "cache_read_tokens", "cache_creation_tokens", "normalized_uncached_input_tokens", "normalized_total_input_tokens", "normalized_cache_read_tokens", "normalized_cache_creation_tokens", "total_tokens"]
    zero = F.lit(0)
    rules = [
        (~c("_priced") & (F.coalesce(total, zero) + F.coalesce("output_tokens", zero) > 0), "missing source model price"),
        (total.isNull() | uncached.isNull() | read.isNull() | creation.isNull(), "cache-accounting migration is incomplete"),
        (F.least(*signed) < 0, "negative token dimension"),
        (total != uncached + read + creation, "normalized input buckets do not sum to total input"),
        (read != c("residual_cached_tokens") + F.greatest(c("cache_read_tokens"), zero), "cache-read normalization disagrees with source cache buckets"),
        (creation != F.greatest(c("cache_creation_tokens"), zero), "cache-creation normalization disagrees with source cache buckets"),
        (~c("applied_service_tier").isin(*KNOWN_TIERS), "unsupported effective service tier"),
        ((uncached > 0) & ~c("_exact_prompt"), "missing exact prompt price"),
        ((c("output_tokens") > 0) & ~c("_exact_completion"), "missing exact output price"),
        ((c("cache_read_tokens") > 0) & ~c("_has_cache_read") & (c("_unit_legacy_cache") <= 0) & ~c("_has_prompt"), "missing exact cache-read price fallback"),
        ((creation > 0) & ~c("_has_cache_creation") & ~c("_has_prompt"), "missing exact cache-creation price fallback"),
    ]
    out = F
    for broken, reason in rules:
        out = out.when(broken, reason)
    return out.otherwise("")


def price_violations(prices: DataFrame, context: DataFrame, service: DataFrame) -> DataFrame:
    """(relation, model, reason) for each price row out of range, without a name, repeated, or ambiguous by service name."""
    def bad(table: DataFrame, relation: str, key: list[str]) -> DataFrame:
        wrong = F.lit(False)
        for c in COMPONENTS:
            wrong |= ~F.coalesce(F.col(f"{c}_per_1m").between(0, 1_000_000_000), F.lit(False))
            if f"{c}_configured" in table.columns:
                wrong |= ~F.coalesce(F.col(f"{c}_configured").isin(0, 1), F.lit(False))
        named = table.withColumn("_reason", F.when(F.coalesce(F.trim("model"), F.lit("")) == "", "empty name").when(wrong, "out of range"))
        repeated = table.groupBy(*key).count().where("count > 1").select("model", F.lit("repeated key").alias("_reason"))
        return named.where("_reason IS NOT NULL").select("model", "_reason").unionByName(repeated).select(F.lit(relation).alias("relation"), "model", F.col("_reason").alias("reason"))

    names = service.select("model", F.monotonically_increasing_id().alias("_row"), F.explode(F.array_distinct(F.array("mode", "service_tier"))).alias("name"))
    twice = names.groupBy("model", "name").agg(F.countDistinct("_row").alias("n")).where("n > 1")
    ambiguous = twice.select(F.lit("service").alias("relation"), "model", F.lit("ambiguous name").alias("reason"))
    parts = bad(prices, "base", ["model"]).unionByName(bad(context, "context", ["model", "threshold_tokens"]))
    return parts.unionByName(bad(service, "service", ["model", "mode", "service_tier"])).unionByName(ambiguous)
