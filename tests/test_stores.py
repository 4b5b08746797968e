"""Published tables, observed counters and listings."""

import os

import pytest
from pyspark.sql import functions as F

from meterline.operators.graph import multiset_digest
from meterline.sources import artifacts, listing, publish

SCHEMA = "k string, n long, day long"


def rows(spark, *values):
    return spark.createDataFrame(values, SCHEMA)


def seen(spark, root):
    return sorted(tuple(r) for r in publish.published(spark, root, SCHEMA, "day").collect())


def test_readers_see_whole_states_only(spark, tmp_path, monkeypatch):
    root = f"file://{tmp_path}/t"
    assert seen(spark, root) == [] and publish.current(spark, root)["sequence"] == 0
    first = publish.publish_days(rows(spark, ("a", 1, 1), ("b", 2, 1), ("c", 3, 2)), root, "day")
    assert first["rows"] == 3 and set(first["days"]) == {"1", "2"} and len(seen(spark, root)) == 3

    def dies(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as m, pytest.raises(RuntimeError):
        m.setattr(publish, "put_new", dies)
        publish.publish_days(rows(spark, ("x", 9, 1), ("y", 9, 7)), root, "day")
    assert seen(spark, root) == [("a", 1, 1), ("b", 2, 1), ("c", 3, 2)]
    second = publish.publish_days(rows(spark, ("d", 4, 2), ("e", 5, 3)), root, "day")
    assert second["sequence"] == 2 and second["prior"] == first["digest"]
    assert seen(spark, root) == [("a", 1, 1), ("b", 2, 1), ("d", 4, 2), ("e", 5, 3)]
    publish.publish_days(rows(spark).where("false"), root, "day", days=[1])  # a day without rows goes
    assert seen(spark, root) == [("d", 4, 2), ("e", 5, 3)]
    with pytest.raises(ValueError):
        publish.publish_days(rows(spark, ("d", 4, 2)), root, "day", days=[3])


def test_of_two_writers_one_is_refused(spark, tmp_path):
    root = f"file://{tmp_path}/t"
    publish.publish_days(rows(spark, ("a", 1, 1)), root, "day")
    publish.put_new(spark, f"{root}/manifests/{2:010d}.json", '{"sequence": 1, "days": {}, "digest": "x"}')  # another writer's second, seen too late
    with pytest.raises(FileExistsError):
        publish.publish_days(rows(spark, ("b", 1, 1)), root, "day")
    assert not [f for f in os.listdir(tmp_path / "t/manifests") if f.endswith(".tmp")]


def test_rebuild_is_scoped_and_guarded(spark, tmp_path):
    root = f"file://{tmp_path}/t"
    facts = rows(spark, ("a", 1, 1), ("a", 2, 1), ("a", 5, 2))
    sums = lambda f: f.groupBy("k", "day").agg(F.sum("n").alias("n")).select("k", "n", "day")
    publish.publish_days(sums(facts), root, "day")
    changed = facts.withColumn("n", F.col("n") * 10)
    assert publish.rebuild(changed, changed.where("false"), root, "day", sums)["sequence"] == 1
    assert publish.rebuild(changed, changed.where("n = 10"), root, "day", sums)["sequence"] == 2
    assert seen(spark, root) == [("a", 5, 2), ("a", 30, 1)]


def test_days_of_a_plain_table(spark, tmp_path):
    path = f"file://{tmp_path}/p"
    publish.overwrite_days(rows(spark, ("a", 1, 1), ("b", 2, 2)), path, "day")
    publish.overwrite_days(rows(spark, ("c", 3, 2)), path, "day")
    assert sorted(tuple(r) for r in spark.read.schema(SCHEMA).parquet(path).collect()) == [("a", 1, 1), ("c", 3, 2)]


def test_counters_come_with_the_write(spark, tmp_path):
    df = spark.range(1000).selectExpr("CAST(id % 7 AS string) AS s", "id AS n", "IF(id = 3, null, id) AS fence").repartition(5)
    told = artifacts.seal(df, f"file://{tmp_path}/a", session="s", fence="fence", watermark=4)
    digest = F.sha2(F.to_json(F.struct("fence", "n", "s"), {"ignoreNullFields": "false"}), 256)
    assert (told["rows"], told["sessions"], told["fence"]) == (1000, 7, 999)
    assert told["output_sha256"] == multiset_digest(df.select(digest.alias("d")), "d").head().digest
    assert spark.read.parquet(f"file://{tmp_path}/a").columns == ["s", "n", "fence"]
    none = artifacts.seal(df.where("false"), f"file://{tmp_path}/b", told, session="s", fence="fence")
    assert (none["rows"], none["sessions"], none["fence"], none["prior_output_sha256"], none["sequence"]) == (0, 0, None, told["output_sha256"], 2)


def test_listing_reads_no_content(spark, tmp_path):
    sizes = {"raw-cache/x y.bin": 3, "tenants/t/cas/v1/blake/aa": 5, "tenants/t/odd": 7, "staging/a": 2, "conversation-staging/b/c": 11, "readiness/r": 13, "top": 17}
    for key, n in sizes.items():
        (tmp_path / key).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / key).write_bytes(b"x" * n)
    (tmp_path / "staging/empty").touch()  # Spark's file sources pass over it
    for root in (f"file://{tmp_path}", f"file:{tmp_path}/", str(tmp_path)):
        listed = listing.objects(spark, root)
        assert {r.key: r.bytes for r in listed.collect()} == sizes
    assert "content:" not in listed._jdf.queryExecution().executedPlan().toString()
    got = {r["class"]: (r.objects, r.bytes) for r in listing.by_class(listed).collect()}
    assert got["staging_requires_owner_fence"] == (2, 13) and got["unclassified_protected"] == (2, 24) and sum(n for n, _ in got.values()) == 7


def test_full_files_come_from_more_than_one_task(spark, tmp_path):
    from meterline.plans import stores

    coalescing = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalescing, "false")  # which would put so few rows together again
    try:
        rows = stores.in_full_files(spark.range(3050), "id", files=2)
        spread = rows.rdd.glom().map(len).collect()
    finally:
        spark.conf.unset(coalescing)
    assert sum(spread) == 3050 and max(spread) < 3050 and sorted(n % 100 for n in spread)[-2:] == [0, 50]
    assert rows.distinct().count() == 3050
