"""Column functions that the engine's operators share."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

HOUR_MS = 3_600_000
DAY_MS = 86_400_000
#: Upper edges of the latency histogram in milliseconds; one more bin holds what is above.
LATENCY_EDGES = (10, 50, 100, 250, 500, 1000, 2500, 5000, 10000, 30000, 60000)


def epoch_ms(ts: Column) -> Column:
    """Milliseconds from 1970 of a timestamp without time zone, whatever the session's zone is."""
    midnight = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("long") * DAY_MS
    clock = F.hour(ts).cast("long") * HOUR_MS + F.minute(ts).cast("long") * 60_000
    return midnight + clock + F.floor(F.extract(F.lit("second"), ts) * 1000).cast("long")


def bucket(ms: Column | str, width_ms: int) -> Column:
    ms = F.col(ms) if isinstance(ms, str) else ms
    return F.floor(ms / F.lit(width_ms).cast("decimal(20,0)")).cast("long")


def uuid_of(text: Column, version: str = "5", variant: str = "a") -> Column:
    """A deterministic UUID string out of the MD5 digest of text."""
    h = F.md5(text)
    parts = [F.substr(h, F.lit(1), F.lit(8)), F.substr(h, F.lit(9), F.lit(4)), F.concat(F.lit(version), F.substr(h, F.lit(14), F.lit(3)))]
    parts += [F.concat(F.lit(variant), F.substr(h, F.lit(18), F.lit(3))), F.substr(h, F.lit(21), F.lit(12))]
    return F.concat_ws("-", *parts)


def uuid8_of(text: Column) -> Column:
    """A deterministic UUID string of version 8 out of the first 16 bytes of the SHA-256 digest of text."""
    h = F.sha2(text, 256)
    part = lambda at, n: F.substr(h, F.lit(at), F.lit(n))
    variant = F.lower(F.hex(F.conv(part(17, 1), 16, 10).cast("int").bitwiseAND(3).bitwiseOR(8)))
    return F.concat_ws("-", part(1, 8), part(9, 4), F.concat(F.lit("8"), part(14, 3)), F.concat(variant, part(18, 3)), part(21, 12))


def _pad(key: Column, byte: int) -> Column:
    """64 bytes: the key, filled up with zeros, each byte xored with one value, four at a time. key is binary of 64 bytes at most."""
    digits, mask = F.rpad(F.hex(key), 128, "0"), int.from_bytes(bytes([byte] * 4))
    part = lambda at: F.conv(F.substr(digits, F.lit(at), F.lit(8)), 16, 10).cast("long").bitwiseXOR(F.lit(mask))
    return F.unhex(F.concat(*[F.lpad(F.hex(part(at)), 8, "0") for at in range(1, 129, 8)]))


def hmac_sha256(key: Column | bytes, message: Column) -> Column:
    """HMAC with SHA-256 in hex. A key given as bytes is xored once, when the plan is made; one in a column (binary or text) row by row."""
    message = message.cast("binary")
    if isinstance(key, bytes):
        key = hashlib.sha256(key).digest() if len(key) > 64 else key
        inner, outer = (F.lit(bytes(b ^ pad for b in key.ljust(64, b"\0"))) for pad in (0x36, 0x5C))
    else:
        key = key.cast("binary")
        short = F.when(F.octet_length(key) > 64, F.unhex(F.sha2(key, 256))).otherwise(key)
        inner, outer = _pad(short, 0x36), _pad(short, 0x5C)
    return F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, message), 256))), 256)


def digest_of(*columns: Column | str) -> Column:
    """SHA-256 over the JSON of the columns, with nulls kept, so that fields cannot run into each other."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def proof_digest(domain: str, *parts: Column) -> Column:
    """SHA-256 over a domain and fields that NUL separates."""
    return F.sha2(F.concat_ws("\0", F.lit(domain), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256)


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def plain(text: Column) -> Column:
    """Lower case without outer spaces; null is empty."""
    return F.lower(F.trim(F.coalesce(text, F.lit(""))))


def applied_tier(tier: Column) -> Column:
    tier = plain(tier)
    return F.when(tier == "", "default").when(tier == "fast", "priority").otherwise(tier)


def slug(model: Column) -> Column:
    """What follows the last slash, in lower case."""
    return F.substring_index(F.lower(model), "/", -1)


def status_of(failed: Column, code: Column) -> Column:
    return F.when(failed == 0, F.lit(200).cast("long")).when(code.between(400, 599), code.cast("long")).otherwise(F.lit(502).cast("long"))


def error_code(failed: Column, code: Column) -> Column:
    return F.when(failed != 0, F.when(code.between(400, 599), F.concat(F.lit("http_"), code.cast("string"))).otherwise("upstream_error"))


def status_class(status: Column) -> Column:
    return F.when(status.between(200, 399), "success").otherwise("failure")


def protocol_class(protocol: Column) -> Column:
    anthropic = (protocol == "anthropic") | protocol.startswith("anthropic-")
    return F.when(anthropic, "anthropic").when(protocol == "openai-image", "openai-image").otherwise("openai")


def billable_input(total: Column, cached: Column, written: Column) -> Column:
    return F.greatest(total - cached - written, F.lit(0))


def latency_bins(ms: Column) -> list[Column]:
    """One 0/1 column per bin of LATENCY_EDGES, named duration_bucket_<i>."""
    edges = [None, *LATENCY_EDGES, None]
    out = []
    for i, (low, high) in enumerate(zip(edges[:-1], edges[1:])):
        inside = F.lit(True)
        if low is not None:
            inside &= ms > low
        if high is not None:
            inside &= ms <= high
        out.append(F.when(inside, 1).otherwise(0).cast("long").alias(f"duration_bucket_{i}"))
    return out


def locator_class(locator: Column) -> Column:
    inline = locator.startswith("inline-json:") | locator.startswith("metadata-only-json:") | locator.startswith("provider-reference-json:")
    return F.when(locator.isNull() | (locator == ""), "missing").when(locator.startswith("gap://"), "gap").when(inline, "inline").otherwise("content")


def is_hex64(text: Column) -> Column:
    return text.rlike("^[0-9a-f]{64}$")


def credential_hash(text: Column) -> Column:
    """The 64 hex digits of a credential, null when absent; anything else stops the job."""
    bare = F.regexp_replace(F.lower(F.trim(text)), "^sha256:", "")
    return F.when(text.isNull() | (text == ""), None).when(is_hex64(bare), bare).otherwise(F.raise_error(F.lit("malformed credential hash")))


def clean_error_code(text: Column) -> Column:
    return F.lower(F.regexp_replace(F.substr(text, F.lit(1), F.lit(200)), "[^A-Za-z0-9._:-]", "_"))


def shard_of(key: Column, shards: int) -> Column:
    """The first 32 bits of the key's MD5 digest, unsigned, modulo shards."""
    return F.conv(F.substr(F.md5(key), F.lit(1), F.lit(8)), 16, 10).cast("long") % shards


def bounded_int64(text: Column) -> Column:
    """A whole number written as text, null where it is none or beyond 64 bits."""
    return F.when(text.rlike("^-?[0-9]+$"), text.try_cast("bigint"))
