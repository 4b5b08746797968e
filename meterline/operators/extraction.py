"""What archive records say: protocol, usage, errors and labels out of nested JSON, and record sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Parts of a label's key that mark it as a secret.
SECRET_LIKE = ("authorization", "bearer", "cookie", "credential", "password", "private", "secret", "token", "api_key")
#: Labels kept, and the longest key and value.
MOST_LABELS, LONGEST_KEY, LONGEST_VALUE = 16, 64, 128


def some(text: Column) -> Column:
    """Trimmed text, null if nothing is left."""
    bare = F.regexp_replace(text, r"^\s+|\s+$", "")
    return F.when(bare != "", bare)


def first_facet(facets: Column, name: str) -> Column:
    """The first value of a facet that isn't blank; facets is a map of arrays."""
    values = F.transform(F.try_element_at(facets, F.lit(name)), some)
    return F.get(F.filter(values, lambda v: v.isNotNull()), F.lit(0))


def protocol(path: Column, facets: Column, metadata: Column) -> Column:
    """What a record was asked through: its path, else what facets, metadata (JSON) or the client say."""
    held = F.try_variant_get(F.try_parse_json(metadata), "$.request_path", "variant")
    named = F.when(F.schema_of_variant(held) == "STRING", F.try_variant_get(held, "$", "string"))
    return F.coalesce(some(path), first_facet(facets, "request.path"), some(named), first_facet(facets, "client"), F.lit("session-archive"))


def usage(response: Column) -> tuple[Column, Column]:
    """Input and output tokens of a response (JSON); both are 0 unless both are whole numbers that aren't negative.

    A usage inside `response` comes before one at the top, whatever it holds.
    """
    body = F.try_parse_json(response)
    found = F.coalesce(F.try_variant_get(body, "$.response.usage", "variant"), F.try_variant_get(body, "$.usage", "variant"))

    def number(name: str) -> Column:
        value = F.try_variant_get(found, f"$.{name}", "variant")
        return F.when(F.schema_of_variant(value) == "BIGINT", F.try_variant_get(value, "$", "bigint"))

    a, b = number("input_tokens"), number("output_tokens")
    right = F.coalesce((a >= 0) & (b >= 0), F.lit(False))
    return F.when(right, a).otherwise(F.lit(0)), F.when(right, b).otherwise(F.lit(0))


def error_code(outcome: Column, status: Column) -> Column:
    """Null for a success below 400; else the outcome in signs that a code may have, or the status."""
    bare = F.coalesce(some(outcome), F.lit(""))
    success = F.lower(bare).isin("success", "succeeded")
    code = F.lower(F.regexp_replace(F.substr(bare, F.lit(1), F.lit(200)), "[^A-Za-z0-9._:-]", "_"))
    by_status = F.when(status >= 400, F.concat(F.lit("http_"), status.cast("string")))
    return F.when(success & (status < 400), None).when((bare != "") & ~success, code).otherwise(by_status)


def labels(text: Column) -> Column:
    """Labels (a JSON object) as a map: keys of plain signs that don't look like secrets, values that are short strings, in the order of keys, MOST_LABELS at most."""
    entries = F.array_sort(F.map_entries(F.from_json(text, "map<string,variant>")), lambda a, b: F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0))

    def right(e: Column) -> Column:
        plain = F.replace(F.lower(e["key"]), F.lit("-"), F.lit("_"))
        hidden = F.lit(False)
        for word in SECRET_LIKE:
            hidden |= F.contains(plain, F.lit(word))
        value = some(F.try_variant_get(e["value"], "$", "string"))
        is_text = F.schema_of_variant(e["value"]) == "STRING"
        shown = value.isNotNull() & (F.octet_length(value) <= LONGEST_VALUE) & ~value.rlike(r"\p{Cntrl}")
        return ~hidden & e["key"].rlike(f"^[A-Za-z0-9_.-]{{1,{LONGEST_KEY}}}$") & is_text & F.coalesce(shown, F.lit(False))

    kept = F.slice(F.filter(entries, right), 1, MOST_LABELS)
    return F.map_from_entries(F.transform(kept, lambda e: F.struct(e["key"], some(F.try_variant_get(e["value"], "$", "string")))))


def in_overlap(started: Column, completed: Column, lower_ms: int) -> Column:
    """A record belongs to the overlap if either of its ends does."""
    return (started >= lower_ms) | (completed >= lower_ms)


def recordset(rows: DataFrame, column: str, schema: str, *keep: str | Column) -> DataFrame:
    """One row for each object of a JSON array, under a given schema. What is kept is worked out once for each array, before it becomes rows."""
    read = rows.select(*keep, F.from_json(F.col(column), f"array<struct<{schema}>>").alias("_records"))
    return read.select(*[c for c in read.columns if c != "_records"], F.inline("_records"))


def json_array(rows: DataFrame, by: list[str], order: str, *fields: str) -> DataFrame:
    """By group the JSON array of rows in the order of one column; null fields stay."""
    items = F.transform(F.array_sort(F.collect_list(F.struct(order, F.struct(*fields).alias("row")))), lambda x: x["row"])
    return rows.groupBy(*by).agg(F.to_json(items, {"ignoreNullFields": "false"}).alias("rows"))
