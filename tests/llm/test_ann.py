import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from meterline.llm import ann
from tests.llm.edge import empty, folder


def brute_force(rows, top=5):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float64)
    out = {}
    for k in np.flatnonzero(ids % 50 == 0):
        cosines = ann.exact_cosines(np.repeat(x[k : k + 1], len(x), 0), x)
        order = [j for j in np.lexsort((ids, -cosines)) if j != k][:top]
        out[int(ids[k])] = [(int(ids[j]), float(cosines[j])) for j in order]
    return out


@pytest.mark.parametrize("where", ["/root/testdata/sf0.001", "/root/testdata/sf0.1"])
def test_recall_and_scores(spark, where):
    want = brute_force([(r.vec_id, r.embedding) for r in spark.read.parquet(f"{where}/embeddings.parquet").collect()])
    got = {}
    for r in ann.op6_nearest_neighbours(spark, where).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert got.keys() == want.keys()
    hits = sum(len({v for _, v, _ in got[q]} & {v for v, _ in want[q]}) for q in want)
    assert hits >= 0.95 * sum(map(len, want.values())), hits / sum(map(len, want.values()))
    for q, rows in got.items():
        assert [k for k, _, _ in rows] == list(range(1, len(want[q]) + 1))
        exact = dict(want[q])
        assert all(abs(exact[v] - s) < 1e-12 for _, v, s in rows if v in exact)


def test_edges(spark, tmp_path_factory):
    rng = np.random.default_rng(1)
    same = [float(v) for v in rng.normal(size=8)]
    rows = [(i, same) for i in range(0, 1500, 2)] + [(i, [float(v) for v in rng.normal(size=8)]) for i in range(1, 1500, 2)]
    bad = [(2000, None), (2050, [0.0] * 8), (2001, [1.0, None] * 4), (2002, [float("nan")] * 8), (2003, [float("inf")] * 8), (2004, []), (None, same), (2005, [1.0])]
    df = spark.createDataFrame([(i, v, 0) for i, v in [*rows, *rows[:3], *bad]], "vec_id long, embedding array<float>, list int")
    where = folder(spark, tmp_path_factory, embeddings=df)
    got = {}
    for r in ann.op6_nearest_neighbours(spark, where).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got[0] == [2, 4, 6, 8, 10] and got[100] == [0, 2, 4, 6, 8]
    assert set(got) == set(range(0, 1500, 50))
    assert ann.nearest_neighbours(empty(df), df.vec_id > 0).count() == 0
    few = df.where("vec_id < 3")
    assert ann.nearest_neighbours(few, few.vec_id == 0).count() == 2


def test_recall_over_many_lists(spark):
    """Against brute force where the graph and the pruning act: 300 lists, clusters, plain noise, and a third of all rows in one group."""
    rng = np.random.default_rng(3)
    n, width = 60_000, 32
    centres = rng.normal(size=(400, width))
    x = centres[rng.integers(0, 400, n)] + 0.6 * rng.normal(size=(n, width))
    x[: n // 3] = centres[0] + 0.3 * rng.normal(size=(n // 3, width))  # one hot group
    x[n // 3 : n // 2] = rng.normal(size=(n // 2 - n // 3, width))  # no clusters at all
    x = x[rng.permutation(n)]
    arrow = pa.table({"vec_id": pa.array(np.arange(n)), "embedding": pa.array(list(x.astype(np.float64)), pa.list_(pa.float64()))})
    got = ann.nearest_neighbours(spark.createDataFrame(arrow), F.col("vec_id") % 50 == 0, list_rows=200).toPandas()
    units = x / np.linalg.norm(x, axis=1, keepdims=True)
    queries = np.arange(0, n, 50)
    cosines = units[queries] @ units.T
    cosines[np.arange(len(queries)), queries] = -2
    best = np.argpartition(-cosines, 5, axis=1)[:, :5]
    found = got.groupby("query_id")["vec_id"].agg(set)
    recall = np.mean([len(set(b) & found.get(q, set())) / 5 for q, b in zip(queries.tolist(), best.tolist())])
    print("recall at 5 over 300 lists:", recall)
    assert (got.groupby("query_id").size() == 5).all() and len(found) == len(queries)
    assert recall >= 0.9
