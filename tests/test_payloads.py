"""JSON, blobs in blobs, closures and ancestry against plain Python."""

import base64
import gzip
import hashlib
import json
import random

import pytest

from meterline.functions import json_text
from meterline.operators import ancestry, blobs, references
from meterline.sources import tables


@pytest.fixture(autouse=True)
def checkpoints(spark):
    spark.sparkContext.setCheckpointDir(spark.conf.get("spark.checkpoint.dir"))


def test_canonical_json(spark):
    right = {
        '{"b": 1, "a": [true, null, {"z": "é", "y": 1.50}]}': '{"a":[true,null,{"y":1.5,"z":"é"}],"b":1}',
        '{"n": 1e21, "m": 1e-7, "k": 100000000000000000000, "s": "a\\u0000\\n/\\u007f"}': '{"k":100000000000000000000,"m":1e-7,"n":1e+21,"s":"a\\u0000\\n/\x7f"}',
        "[0.000001, -0.5, 2.0, 100000000000000016.0, 123456789012345678901, 9007199254740993]": "[0.000001,-0.5,2,100000000000000020,123456789012345680000,9007199254740992]",
        "[5e-324, 1.7976931348623157e308, 1.5e-9, 123456.789, 1e-400]": "[5e-324,1.7976931348623157e+308,1.5e-9,123456.789,0]",
        '{"\\ud83d\\ude00": 1, "\\uffff": 2, "\\ud800": 3}': '{"\\ud800":3,"😀":1,"\uffff":2}',
        "null": "null", ' "x" ': '"x"', "-0": "0",
    }
    wrong = {'{"a": 1, "a": 1}': "repeated key", '{"a": {"b": 1, "b": 2}}': "repeated key", "NaN": "not JSON", "[1] 2": "not JSON", "": "not JSON", "{'a': 1}": "not JSON", "[1e999]": "number out of range", "[" * 90_000: "too deep"}
    rows = spark.createDataFrame([(t,) for t in [*right, *wrong, None]], "t string")
    got = {r.t: (r.c.json, r.c.problem) for r in rows.select("t", json_text.canonical("t").alias("c")).collect()}
    assert got == {None: (None, None)} | {t: (c, None) for t, c in right.items()} | {t: (None, p) for t, p in wrong.items()}
    assert {r.c for r in rows.select(json_text.canonical_json("t").alias("c")).collect()} == {None, *right.values()}


def expand(value, held, depth=0):
    """As the operator, from the top down: the value or a reason."""
    if depth > 64:
        raise ValueError("too deep")
    if isinstance(value, list):
        return [expand(v, held, depth + 1) for v in value]
    if not isinstance(value, dict):
        return value
    if isinstance(value.get("$blob"), str):
        raw, kind = held[value["$blob"]], value["encoding"]
        if kind == "json":
            return expand(json.loads(raw), held, depth + 1)
        return raw if kind in ("raw", "utf8") else f"data:{value.get('media_type', '')};base64,{base64.b64encode(raw.encode()).decode()}"
    return {k: expand(v, held, depth + 1) for k, v in value.items()}


def test_blobs_against_plain_python(spark):
    rng = random.Random(4)
    held, names = {}, []

    def value(depth):
        if names and rng.random() < 0.35:
            kind = rng.choice(["raw", "utf8", "data-url", "json", "json", "json"])
            return {"$blob": rng.choice(names[-8:]), "encoding": kind} | ({"media_type": "a/b"} if rng.random() < 0.5 else {})
        if depth > 3 or rng.random() < 0.3:
            return rng.choice([1, 2.5, "é", None, True, "$blob"])
        return [value(depth + 1) for _ in range(rng.randrange(3))] if rng.random() < 0.5 else {k: value(depth + 1) for k in rng.sample("abc", rng.randrange(3))}

    for k in range(120):
        name = hashlib.sha256(str(k).encode()).hexdigest()
        held[name] = json.dumps(value(0), indent=rng.choice([None, 1]), ensure_ascii=rng.random() < 0.5)
        names.append(name)
    texts = [json.dumps(value(0)) for _ in range(60)]
    rows = spark.createDataFrame(list(enumerate([*texts, None])), "id int, text string").repartition(3)
    table = spark.createDataFrame([(h, c, gzip.compress(t.encode()) if c == "gzip" else t.encode()) for h, t in held.items() for c in [rng.choice(["gzip", "none"])]], "hash string, codec string, body binary")
    got = {r.id: (r.text, r.complete, r.problem) for r in blobs.expand_blobs(rows, table).collect()}
    assert got.pop(60) == (None, True, None)
    for k, text in enumerate(texts):
        try:
            top = json.loads(text)
            made = expand(top, held)
            if isinstance(top, dict) and top.get("encoding") == "raw" and "$blob" in top:
                made = json.loads(made)
            want = (json_text.write(made), True, None)
        except ValueError:
            want = (None, False, "too deep")
        assert got[k] == want, k


def test_depth_circles_and_what_is_not_there(spark):
    ref = lambda h, e="json": json.dumps({"encoding": e, "$blob": h})
    held = {"d0": "[]", "loop": f"[{ref('pool')}]", "pool": ref("loop"), "over": f"[{ref('loop')}]", "bad": "{x", "twice": '{"a":1,"a":2}', "hole": f"[{ref('none')},{ref('d0')}]"}
    held |= {f"d{k}": ref(f"d{k - 1}") for k in range(1, 12)}
    rows = {
        1: ref("d8"), 2: ref("d7"), 3: f"[{ref('d6')}]", 4: f"[{ref('d7')}, {ref('d8')}]", 5: ref("over"), 6: ref("bad"), 7: ref("twice"), 8: ref("hole"), 9: ref("d0", "gif"), 10: "{x", 11: '{"$blob": 5}', 12: ref("d11"), 13: f"[{ref('none', 'raw')}]",
    }
    table = spark.createDataFrame([(h, "none", t.encode()) for h, t in held.items()] + [("d0", "none", b"[]"), ("gone", "gzip", b"x")], "hash string, codec string, body binary")
    frame = spark.createDataFrame([*rows.items(), (14, ref("gone", "utf8"))], "id int, text string")
    got = {r.id: (r.text, r.complete, r.problem) for r in blobs.expand_blobs(frame, table, deepest=8).collect()}
    write = lambda t: json_text.write(json_text.parse(t))
    assert got[1] == (None, False, "too deep") and got[2] == ("[]", True, None) and got[3] == ("[[]]", True, None)
    assert got[4][1:] == (False, "too deep") and got[12] == (None, False, "too deep") and got[10] == (None, False, "not JSON")
    assert got[5] == (write(rows[5]), False, "cycle") and got[6] == (write(rows[6]), False, "bad blob") and got[7][2] == "bad blob"
    assert got[8] == (f"[{write(ref('none'))},[]]", False, "absent") and got[9] == (write(rows[9]), False, "unsupported encoding")
    assert got[11] == ('{"$blob":5}', True, None) and got[13][2] == "absent" and got[14][2] == "bad blob"


def graph(rng, n, m):
    return {(rng.randrange(n), rng.randrange(n)) for _ in range(m)}


def reach(roots, edges):
    out, todo = set(roots), list(roots)
    while todo:
        now = todo.pop()
        for a, z in edges:
            if a == now and z not in out:
                out.add(z)
                todo.append(z)
    return out


@pytest.mark.parametrize("n,m", [(30, 20), (40, 45), (25, 60), (5, 0)])
def test_closure_and_circles_of_random_graphs(spark, n, m):
    rng = random.Random(n)
    edges = graph(rng, n, m)
    roots = {rng.randrange(n) for _ in range(2)}
    frame = spark.createDataFrame(sorted(edges), "from_id long, to_id long")
    got = ancestry.reachable(spark.createDataFrame([(r,) for r in roots], "id long"), frame)
    assert sorted(r.id for r in got.collect()) == sorted(reach(roots, edges))
    on_circle = {v for v in range(n) if v in {z for a in reach([v], edges) for b, z in edges if a == b}}
    assert sorted(r.id for r in ancestry.circular(frame).collect()) == sorted(v for v in range(n) if reach([v], edges) & on_circle)


def test_chain_of_ten_thousand(spark):
    """Each node refers to the next and to a leaf of its own; a circle of 3000 hangs on another root."""
    n = 10_000
    chain = spark.range(n).selectExpr("id AS from_id", "id + 1 AS to_id").union(spark.range(n).selectExpr("id", "id + 100000"))
    ring = spark.range(3000).selectExpr("id + 20000 AS from_id", "(id + 1) % 3000 + 20000 AS to_id")
    references_ = chain.union(ring).selectExpr("from_id", "to_id", "'x' AS digest")
    objects = references_.selectExpr("to_id AS id").union(spark.createDataFrame([(0,)], "id long")).distinct().selectExpr("id", "'t' AS tenant")
    found = references.closure(spark.createDataFrame([(0, "t"), (20_100, "t")], "id long, tenant string"), references_, objects).groupBy("problem").count()
    assert {r.problem: r["count"] for r in found.collect()} == {"": 2 * n + 1, "circle": 3000}


def test_ancestry_problems(spark):
    nodes, heads = [], []

    def chain(name, events, branch="b", head=None, change=None):
        before = None
        for k, event in enumerate(events, 1):
            node = {"id": f"{name}{k}", "parent": before, "event_count": k, "event_id": event, "branch_id": branch, "parent_event_id": events[k - 2] if k > 1 else None}
            node |= (change or {}).get(k, {})
            nodes.append(node)
            before = node["id"]
        heads.append({"head": before, "event_count": len(events), "branch_id": branch, "parent_event_id": None, "parent_branch_id": None} | (head or {}))

    many = [f"m{k}" for k in range(500)]
    chain("ok", many)
    chain("half", ["a"], head={"parent_event_id": "a"})
    chain("count", ["a", "b"], head={"event_count": 3})
    chain("order", many, change={7: {"event_count": 9}})
    chain("gap", ["a", "b", "c"], change={2: {"parent": "nowhere"}})
    chain("branch", ["a"], head={"branch_id": "c"})
    chain("twice", [*many[:300], "m3", "z"])
    chain("late", ["a", "b", "c", "d"], change={2: {"parent_event_id": "d"}})
    chain("far", ["a", "b", "c", "d"], change={4: {"parent_event_id": "a"}})
    chain("side", ["a", "b"], head={"parent_event_id": "a", "parent_branch_id": "b"})
    chain("lost", ["a", "b"], head={"parent_event_id": "a", "parent_branch_id": "other"})
    heads.append({**heads[0], "head": "none"})
    ring = [{"id": f"r{k}", "parent": f"r{(k + 1) % 3}", "event_count": 5, "event_id": f"e{k}", "branch_id": "b", "parent_event_id": None} for k in range(3)]
    heads.append({**heads[0], "head": "r0", "event_count": 5})
    schema = "id string, parent string, event_count long, event_id string, branch_id string, parent_event_id string"
    frame = spark.createDataFrame([tuple(n[c.split()[0]] for c in schema.split(", ")) for n in nodes + ring], schema)
    of_heads = "head string, event_count long, branch_id string, parent_event_id string, parent_branch_id string"
    got = ancestry.ancestry_problems(spark.createDataFrame([tuple(h[c.split()[0]] for c in of_heads.split(", ")) for h in heads], of_heads), frame)
    assert {r["head"]: r.problem for r in got.collect()} == {
        "half1": "branch parent half set", "count2": "count", "order500": "order", "gap3": "order", "branch1": "branch", "twice302": "identity", "late4": "parent event", "lost2": "branch parent", "none": "head missing", "r0": "circle",
    }


def test_sizes_of_jumps_do_not_grow_by_rounds(spark):
    """Sizes that were multiplied in each round once filled the driver."""
    ring = spark.range(3000).selectExpr("id", "(id + 1) % 3000 AS to")
    jumps = ancestry.Jumps(ring.unionByName(spark.range(5000, 9000).selectExpr("id", "id + 1 AS to")))
    assert jumps.circular.count() == 3000 and {r.end for r in jumps.ends.select("end").distinct().collect()} == {9000}
    for table in (jumps.ends, jumps.levels[-1]):
        assert table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() < 1 << 30


def test_a_round_meets_only_the_blobs_that_it_needs(spark, monkeypatch):
    tables.shared_checkpoints(spark)
    chain = [("a", b'["end"]'), ("b", b'{"$blob":"a","encoding":"json"}'), ("c", b'[{"$blob":"b","encoding":"json"}]')]
    held = spark.createDataFrame([(h, "none", b) for h, b in chain] + [(f"x{k}", "none", b"1") for k in range(50)], "hash string, codec string, body binary")
    met, values = [], blobs._values
    monkeypatch.setattr(blobs, "_values", lambda leaves, done: met.append(leaves.count()) or values(leaves, done))
    got = blobs.expand_blobs(spark.createDataFrame([(1, '{"$blob":"c","encoding":"json"}')], "id long, text string"), held).collect()
    assert [(r.id, r.text, r.complete) for r in got] == [(1, '[["end"]]', True)]
    assert met == [1, 1, 53]
