import hashlib
import random

import pytest

from meterline.llm import substring
from tests.llm.edge import documents, empty, folder


def brute_force(rows, size=13):
    first = {}
    split = [(i, (t or "").encode().split()) for i, t in rows]
    for i, words in split:
        for k in range(len(words) - size + 1):
            if i is not None:
                key = tuple(words[k : k + size])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, words in split:
        gone = {k + j for k in range(len(words) - size + 1) if i is not None and first[tuple(words[k : k + size])] < i for j in range(size)}
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((i, len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return out


def order(rows):
    return sorted(rows, key=str)


@pytest.fixture(scope="module")
def overlapping(spark, tmp_path_factory):
    rng = random.Random(3)
    base = [f"v{i}" for i in range(400)]
    rows = []
    for i in range(300):
        words = []
        while len(words) < rng.randrange(5, 120):
            at, n = rng.randrange(380), rng.randrange(1, 30)
            words += base[at : at + n] if rng.random() < 0.7 else [rng.choice("abcdef") for _ in range(n)]
        rows.append((rng.randrange(10**9), " ".join(words)))
    return folder(spark, tmp_path_factory, documents=spark.createDataFrame(rows, "doc_id long, text string").repartition(3))


@pytest.mark.parametrize("table", ["edge", "driver", "overlapping"])
def test_against_brute_force(spark, tmp_path_factory, sf_dir, overlapping, table):
    where = {"edge": None, "driver": sf_dir, "overlapping": overlapping}[table] or folder(spark, tmp_path_factory, documents=documents(spark))
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{where}/documents.parquet").collect()]
    got = [tuple(r) for r in substring.op2_substring_dedup(spark, where).collect()]
    assert order(got) == order(brute_force(rows))


def test_factors_and_empty_table(spark):
    docs = spark.createDataFrame([(1, " ".join(f"a{i}" for i in range(20))), (2, "x " + " ".join(f"a{i}" for i in range(2, 18)) + " y")], "doc_id long, text string")
    out = {r.doc_id: r for r in substring.substring_dedup(docs).collect()}
    assert [(f.start, f.n_words) for f in out[2].factors] == [(1, 16)] and out[2].kept == "x y" and not out[1].factors
    assert substring.substring_dedup(empty(docs)).count() == 0
