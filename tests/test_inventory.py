"""Grants against models that share a name and prefix: pairs are counted, not made."""

from meterline.operators import inventory


def test_copies_of_grants_and_models_are_not_multiplied(spark):
    models = spark.range(200_000).selectExpr("CAST(id AS STRING) AS model_id", "'m' AS name", "'p' AS prefix")
    more = spark.createDataFrame([("x1", "one", "q"), ("y1", "two", "q"), ("y2", "two", "r")], "model_id string, name string, prefix string")
    grants = spark.range(200_000).selectExpr("'k' AS key_hash", "'m' AS model", "'p' AS prefix")
    others = spark.createDataFrame([("k", "one", "z"), ("k", "two", "z"), ("j", "none", "z"), ("j", "two", "r"), ("i", "one", "z"), (None, None, None)], "key_hash string, model string, prefix string")
    resolved = inventory.resolve_grants(grants.unionByName(others), models.unionByName(more))
    counts = {(r.key_hash, r.resolution): (r.n, r.last_id) for r in inventory.grant_counts(resolved).collect()}
    assert counts == {
        ("k", "exact"): (200_000**2, "99999"), ("k", "unique"): (1, "x1"), ("k", "ambiguous"): (1, None), ("j", "unmatched"): (1, None),
        ("j", "exact"): (1, "y2"), ("i", "unique"): (1, "x1"), (None, "unmatched"): (1, None),
    }
    told = {r.key_hash: (r.models, r.complete) for r in inventory.policies(resolved, models.unionByName(more)).collect()}
    assert told["k"] == (",".join(sorted([*map(str, range(200_000)), "x1"])), False)
    assert told["j"] == ("y2", False) and told["i"] == ("x1", True) and told[None] == ("", False)


def test_accepted_keeps_only_what_is_asked_for(spark):
    from meterline.operators import load

    rows = [("a", 1, "r", "x", 10), ("a", 2, "r", "y", 11), ("a", 2, "r", "y", 11), ("b", 1, "r", "x", 12), ("b", 1, "r", "z", 13), ("b", 5, "r", "q", 14), (None, 1, "r", "x", 15)]
    staged = spark.createDataFrame(rows, "event_hash string, timestamp_ms long, request_id string, source_digest string, n long")
    assert sorted(tuple(r) for r in load.accepted(staged, "n").where("event_hash IS NOT NULL").collect()) == [("a", 11)]
    full = load.accepted(staged)
    assert full.columns == ["event_hash", "timestamp_ms", "request_id", "source_digest", "n"] and full.count() == 2
