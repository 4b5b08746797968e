"""Patterns, candidates, transports and keyed digests against plain Python and published vectors."""

import hashlib
import hmac
import random
import uuid

import pytest
from pyspark.sql import functions as F

from meterline.functions import scalars
from meterline.operators import routing


def wildcard(pattern, value):
    parts, text = pattern.lower().split("*"), value.lower()
    if not text.startswith(parts[0]):
        return False
    at = len(parts[0])
    for part in parts[1:-1]:
        found = text.find(part, at)
        if found < 0:
            return False
        at = found + len(part)
    return text.endswith(parts[-1])


def test_first_pattern_in_order(spark):
    rng = random.Random(1)
    word = lambda n, letters: "".join(rng.choice(letters) for _ in range(rng.randrange(n)))
    values = ["", "a", "ABA", "ab", "x(y)z", "a.b", "aba*", *(word(9, "abAB") for _ in range(300))]
    patterns = ["(", "*", "ab*ba", "*.B", "aba", "*bab*", "a*b*a*b", *(word(7, "ab**") for _ in range(60))]
    rng.shuffle(patterns)
    frame = spark.createDataFrame([(v, k) for k, v in enumerate(values)] + [(None, -1)], "value string, id int")
    index = spark.createDataFrame([(k, p) for k, p in enumerate(patterns)], "place int, pattern string")
    got = {r.id: r.pattern for r in routing.first_match(frame, index).collect()}
    want = {k: next((p for p in patterns if wildcard(p, v)), None) for k, v in enumerate(values)}
    assert got == want | {-1: None}
    few = index.where("pattern <> '*' AND pattern NOT LIKE '*%'")
    assert routing.first_match(frame, few).count() == len(values) + 1 and routing.first_match(frame, index.where("false")).where("pattern IS NOT NULL").count() == 0


@pytest.mark.parametrize("force", [True, False])
def test_candidates(spark, force):
    rng = random.Random(7)
    pick = lambda xs: rng.choice(xs)
    models = ["M1", "m2", "m3", "up1", "up2"]
    requests = [(k, pick(models), pick([None, "g1", "g2"]), pick([None, None, "p", "q"])) for k in range(40)]
    auths = [(f"a{k}", pick([None, "p", "q"]), rng.sample(["g1", "g2"], rng.randrange(3))) for k in range(25)]
    aliases = [(pick([None, *[a[0] for a in auths]]), k, pick(["m1", "M2", "m3"]), pick(["up1", "UP2", "m3"])) for k in range(30)]
    excluded = [(pick(auths)[0], pick(["up*", "*2", "m3", "*"])) for _ in range(8)]
    registered = [(pick(auths)[0], pick([*models, "p/m1", "q/M2"])) for _ in range(60)]

    def serve(auth, request):
        _, model, group, prefix = request
        name, own_prefix, groups = auth
        if group is not None and group not in groups or prefix is not None and own_prefix != prefix or prefix is None and force and own_prefix is not None:
            return None
        ordered = [x for x in aliases if x[0] == name] + [x for x in aliases if x[0] is None]
        upstream = next((x[3] for x in ordered if x[2].lower() == model.lower()), model)
        if any(e[0] == name and wildcard(e[1], upstream) for e in excluded):
            return None
        held = {m.lower() for n, m in registered if n == name}
        return upstream if (model if prefix is None else f"{prefix}/{model}").lower() in held or upstream.lower() in held else None

    want = sorted((r[0], a[0], serve(a, r)) for r in requests for a in auths if serve(a, r) is not None)
    frame = spark.createDataFrame
    got = routing.candidates(
        frame(requests, "request int, model string, group string, upstream_prefix string"), frame(auths, "auth string, prefix string, groups array<string>"),
        frame(aliases, "auth string, place int, alias string, name string"), frame(excluded, "auth string, pattern string"), frame(registered, "auth string, model string"), force,
    )
    assert sorted(tuple(r) for r in got.collect()) == want and want


def test_candidates_are_not_held_against_registered_models_again(spark, sf_dir):
    """Registered models meet requests once and aliases once, and a pattern is taken apart beside its account, not beside each pair."""
    from meterline.plans import routes

    plan = routes.route_candidates(spark, sf_dir)._jdf.queryExecution().executedPlan().toString().split("\n")
    assert sum("FileScan" in line and "lineitem.parquet" in line for line in plan) <= 5
    assert not any("Join" in line and "split(" in line for line in plan)


def test_a_candidate_is_found_by_what_the_account_has(spark):
    """What is asked for is enough; an account's own alias hides what the model stands for in general; one without a registered model serves nothing."""
    frame = spark.createDataFrame
    requests = [(1, "m", None, None), (2, "n", None, None), (3, None, None, "p"), (None, "m", None, None), (4, "m", None, None)]
    aliases = [("b", 1, "m", "odd"), ("c", 1, "m", "Up"), ("d", 1, "M", None), (None, 1, "n", "all"), ("e", 1, "N", "odd")]
    registered = [("a", "M"), ("a", "m"), ("b", "m"), ("c", "up"), ("d", "m"), ("a", "ALL"), ("e", "all"), ("f", "p"), (None, "m"), ("c", None)]
    got = routing.candidates(
        frame(requests, "request int, model string, group string, upstream_prefix string"), frame([(x, "p" if x == "f" else None, []) for x in "abcdef"], "auth string, prefix string, groups array<string>"),
        frame(aliases, "auth string, place int, alias string, name string"), frame([("d", "*x")], "auth string, pattern string"), frame(registered, "auth string, model string"), True,
    )
    of_m = [("a", "m"), ("b", "odd"), ("c", "Up"), ("d", "m")]
    assert {tuple(r) for r in got.collect()} == {(k, *x) for k in (1, 4) for x in of_m} | {(2, "a", "all"), (3, "f", None)} and got.count() == 10


def test_all_gaps_of_transports(spark):
    s = lambda i, **x: {"source_id": i, "provider": "p", "name": f"n{i}", "disabled": False, "proxied": False, "base_url": f"u{i}", "config": "{}"} | x
    t = lambda i, **x: {"target_id": 100 + i, "name": f"n{i}", "status": "active", "driver": "http-json", "base_url": f"u{i}", "scope": "public", "origins": None, "config": "{}"} | x
    sources = [s(1), s(2, disabled=True), s(3, provider="q"), s(4, proxied=True), s(5), s(6), s(7), s(8), s(9), s(10), s(11), s(12), s(13, base_url="b"), s(14, base_url="b"), s(15, base_url="c"), s(16, base_url="c"), s(17, base_url="d"), s(18, base_url="d")]
    targets = [
        t(1, origins=["https://x"]), t(2), t(3), t(4), t(6), t(6, target_id=206), t(7, status="paused"), t(8, driver="other"), t(9, scope="odd"), t(10, scope="private"), t(11, config='{"a":1}'), t(12, origins=["ftp:x"]),
        t(13, base_url="b"), t(14, base_url="b", origins=["https://y"]), t(15, base_url="c"), t(17, base_url="d"), t(18, base_url="d"),
    ]
    wanted = [(k, "p") for k in [0, *range(1, 15), 15, 17, 18]]
    make = lambda rows, schema: spark.createDataFrame([tuple(r[c.split()[0]] for c in schema.split(", ")) for r in rows], schema)
    got = routing.reconcile_transports(
        make(sources, "source_id int, provider string, name string, disabled boolean, proxied boolean, base_url string, config string"),
        make(targets, "target_id int, name string, status string, driver string, base_url string, scope string, origins array<string>, config string"),
        spark.createDataFrame(wanted, "source_id int, provider string"),
    )
    g = routing.GAPS
    want = {0: g[0], 2: g[0], 3: g[1], 4: g[2], 5: g[3], 6: g[4], 7: g[5], 8: g[6], 9: g[7], 10: g[2], 11: g[8], 12: g[7], 13: g[9], 14: g[9], 15: g[9], 1: 101, 17: 117, 18: 118}
    rows = {r.source_id: r for r in got.collect()}
    assert {k: r.reason or r.target_id for k, r in rows.items()} == want
    assert (rows[13].uncovered, rows[13].distinct_transports) == (0, 2) and (rows[15].uncovered, rows[15].distinct_transports) == (1, 1) and rows[1].uncovered is None


#: RFC 4231, test cases 1 to 4, 6 and 7: key, data, digest.
VECTORS = [
    (b"\x0b" * 20, b"Hi There", "b0344c61d8db38535ca8afceaf0bf12b881dc200c9833da726e9376c2e32cff7"),
    (b"Jefe", b"what do ya want for nothing?", "5bdcc146bf60754e6a042426089575c75a003f089d2739839dec58b964ec3843"),
    (b"\xaa" * 20, b"\xdd" * 50, "773ea91e36800e46854db8ebd09181a72959098b3ef8c122d9635514ced565fe"),
    (bytes(range(1, 26)), b"\xcd" * 50, "82558a389a443c0ea4cc819899f2083a85f0faa3e578f8077a2e3ff46729665b"),
    (b"\xaa" * 131, b"Test Using Larger Than Block-Size Key - Hash Key First", "60e431591ee0b67f0d8a26aacbf5b77f8e0bc6213728c5140546040f0ee37f54"),
    (b"\xaa" * 131, b"This is a test using a larger than block-size key and a larger than block-size data. The key needs to be hashed before being used by the HMAC algorithm.", "9b09ffa71b942fcb27635fbcd5b0e944bfdc63644f0713938a7f51535c3a35e2"),
]


def test_hmac_vectors_and_uuids(spark):
    keys = [*VECTORS, (b"", b"", hmac.new(b"", b"", "sha256").hexdigest()), (b"k" * 64, "é".encode(), hmac.new(b"k" * 64, "é".encode(), "sha256").hexdigest())]
    rows = spark.createDataFrame(keys, "key binary, data binary, digest string")
    assert rows.where(scalars.hmac_sha256(F.col("key"), F.col("data")) != F.col("digest")).count() == 0
    for key, data, digest in keys:
        assert spark.range(1).select(scalars.hmac_sha256(key, F.lit(data)).alias("d")).head().d == digest
    for text in ("", "a", "é", *map(str, range(50))):
        raw = bytearray(hashlib.sha256(text.encode()).digest()[:16])
        raw[6], raw[8] = raw[6] & 0x0F | 0x80, raw[8] & 0x3F | 0x80
        assert spark.range(1).select(scalars.uuid8_of(F.lit(text)).alias("u")).head().u == str(uuid.UUID(bytes=bytes(raw)))


def test_keyed_ids_are_dealt_to_all_cores(spark, sf_dir):
    from meterline.plans import routes

    assert routes.keyed_ids(spark, sf_dir).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
