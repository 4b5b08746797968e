import pytest

from meterline.operators import graph


def test_long_walks_take_few_rounds(spark):
    chain = spark.range(20_000).selectExpr("CAST(id AS STRING) AS node_hash", "IF(id = 0, NULL, CAST(id - 1 AS STRING)) AS parent_hash")
    more = spark.createDataFrame([("x", "3"), ("lost", "absent")], chain.schema)
    leaves = spark.createDataFrame([("19999",), ("x",), ("lost",), ("0",), ("0",)], "node_hash string")
    spark.sparkContext.setCheckpointDir(spark.conf.get("spark.checkpoint.dir"))
    got = sorted((r.leaf_hash, r.length) for r in graph.dialogue(leaves, chain.unionByName(more)).collect())
    assert got == [("0", 1), ("19999", 20_000), ("x", 5)]


def test_circles_are_an_error(spark):
    spark.sparkContext.setCheckpointDir(spark.conf.get("spark.checkpoint.dir"))
    nodes = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a")], "node_hash string, parent_hash string")
    with pytest.raises(ValueError):
        graph.dialogue(nodes.select("node_hash"), nodes)
