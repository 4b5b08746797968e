"""Every rule fires, names of tiers and keys in any spelling, generations in totals, and what resets and purges refuse."""

import pytest

from meterline.operators import archive, purge, rollups
from meterline.plans import rules
from tests.compare import duck_connection


def test_every_rule_fires():
    """In the SQL, which test_oracle.py holds the rating against."""
    db = duck_connection("/root/testdata/sf0.01")
    got = {r[0] for r in db.execute(f"SELECT DISTINCT validation_error FROM ({rules.ORACLE_SQL['validation_rules']}) t").fetchall()}
    assert len(got) == 12 and "" in got


def test_correlation_trims_models_and_folds_keys(spark):
    records = spark.createDataFrame([(k, "x", "AB" if k else "c", 0, m, None, None, None) for k, m in enumerate([" m ", " m ", "M", "  "])], "record_id int, external_id string, key_id string, started_at long, requested_model string, resolved_model string, input_tokens long, output_tokens long")
    requests = spark.createDataFrame([("x", 5, "m", "aB", 1, 1), ("x", 5, "  ", "ab", 1, 1)], "external_id string, created_at long, model string, key_id string, input_tokens long, output_tokens long")
    assert {r.record_id: r.disposition for r in archive.correlate(records, requests).collect()} == {0: "incompatible", 1: "exact", 2: "incompatible", 3: "incompatible"}


def test_generations_join_the_unlinked_session(spark):
    f = "key_id string, session_id string, created_at long, model string, protocol string, status_class string, error_code string, currency string, duration_ms long, input_tokens long, output_tokens long, cached_input_tokens long, cache_write_tokens long, cost_micros long"
    facts = spark.createDataFrame([("k", s, 10, "m", "anthropic-x", "success", "", "USD", 1, 9, 2, 3, 1, 7) for s in ("s", "", None)], f)
    g = spark.createDataFrame([("k", 3_600_001, "g", "failure", "e", "USD", 4, 5, 11)], "key_id string, created_at long, model string, status_class string, error_code string, currency string, billed_units long, duration_ms long, cost_micros long")
    got = {r.session_id: (r.requests, r.errors, r.input_tokens, r.generation_units, r.duration_sum_ms, r.cost_micros, r.last_activity_at) for r in rollups.session_usage(facts, g).collect()}
    assert got == {"s": (1, 0, 5, 0, 1, 7, 10), "unlinked:k": (3, 1, 10, 4, 7, 25, 3_600_001)}
    hours = rollups.session_usage(facts, g, by_hour=True)
    assert sorted((r.hour_bucket, r.protocol, r.requests) for r in hours.collect()) == [(0, "anthropic", 1), (0, "anthropic", 2), (1, "generation", 1)]
    assert sorted((r.day_bucket, r.protocol, r.requests) for r in rollups.daily_usage(hours).collect()) == [(0, "anthropic", 1), (0, "anthropic", 2), (0, "generation", 1)]


def test_reset_goes_from_children_to_parents(spark):
    parent, child = spark.createDataFrame([(1, "a"), (2, "b")], "id int, owner string"), spark.createDataFrame([(10, 1), (11, 2), (12, None)], "id int, parent int")
    steps = [purge.Step("child", child, "parent", "parent", "id"), purge.Step("parent", parent, "owner", "owned", "who")]
    owned = {"owned": spark.createDataFrame([("a",), ("a",), (None,)], "who string")}
    done = purge.ordered_reset(steps, owned, {"odd": ("child", "id % 2 = 1"), "even": ("child", "id % 2 = 0")})
    assert {n: sorted(r.id for r in df.collect()) for n, df in done.kept.items()} == {"child": [11, 12], "parent": [2]}
    assert [(r.name, r.deleted) for r in done.broken.collect()] == [("even", 1)]
    with pytest.raises(ValueError, match="goes after"):
        purge.ordered_reset(steps[::-1], owned, {})


def test_purge_only_takes_the_exact_cohort(spark):
    table = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (3, "a"), (None, "a")], "id int, v string")
    keys = lambda *k: spark.createDataFrame([(x,) for x in k], "id int")
    run = lambda cohort, expected, **x: purge.exact_purge(x.pop("table", table), cohort, expected, ["id"], table.where("v = 'b'"), **x)
    outcome = lambda p: (p.receipt.head().outcome, p.receipt.head().deleted, p.left.count())
    assert outcome(run(keys(1, 7), keys(1, 1))) == ("planned", 3 - 1, 5)
    done = run(keys(1, 7), keys(1), dry_run=False)
    assert outcome(done) == ("applied", 2, 3) and (done.receipt.head().protected_before, done.receipt.head().protected_after) == (1, 0)
    assert outcome(run(keys(1, 7), keys(1), dry_run=False, table=done.left, receipts=done.receipt)) == ("already", 0, 3)
    assert outcome(run(keys(1, 2), keys(1), dry_run=False)) == ("cohort differs", 0, 5)
    assert outcome(run(keys(1), keys(1, 2), dry_run=False)) == ("cohort differs", 0, 5)
    assert outcome(run(keys(), keys(), dry_run=False)) == ("applied", 0, 5)
