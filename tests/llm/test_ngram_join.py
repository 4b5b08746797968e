import random

import numpy as np
import pytest

from meterline.llm import ngram_join
from meterline.llm.components import components
from tests.llm.edge import documents, empty, folder


def shingle_set(text):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4)))


def brute_force(rows):
    sets = [(i, shingle_set(t)) for i, t in rows]
    up = {i: i for i, _ in sets if i is not None}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    holders = {}
    for k, (i, s) in enumerate(sets):
        for x in s if i is not None else ():
            holders.setdefault(x, []).append(k)
    seen = set()
    for ks in holders.values():
        for a in ks:
            for b in ks:
                if a < b and (a, b) not in seen:
                    seen.add((a, b))
                    s, t = sets[a][1], sets[b][1]
                    if 100 * len(s & t) >= 75 * len(s | t):
                        x, y = sorted((top(sets[a][0]), top(sets[b][0])))
                        up[y] = x
    return sorted(((i, len(s), None if i is None else top(i)) for i, s in sets), key=str)


def edited(rng, words, share):
    words = list(words)
    for _ in range(max(1, int(share * len(words)))):
        k = rng.randrange(len(words))
        words[k : k + 1] = rng.choice([[], [f"n{rng.randrange(10**6)}"], [words[k], f"n{rng.randrange(10**6)}"]])
    return words


@pytest.fixture(scope="module")
def chains(spark, tmp_path_factory):
    """Short and long texts with chains of edits, so that many pairs lie near the bound and many links bridge groups."""
    rng = random.Random(11)
    rows = []
    for group in range(60):
        words = [f"g{group}w{i}" for i in range(rng.choice([3, 4, 5, 6, 7, 8, 9, 10, 12, 15, 20, 30, 60, 150, 400]))]
        for _ in range(rng.randrange(2, 12)):
            rows.append((rng.randrange(10**12), " ".join(words)))
            if rng.random() < 0.8:
                words = edited(rng, words, rng.choice([0.01, 0.02, 0.03]))
    passage = " ".join(f"common{i}" for i in range(30))
    rows += [(rng.randrange(10**12), passage + " " + " ".join(f"u{rng.randrange(10**9)}" for _ in range(rng.randrange(5, 60)))) for _ in range(150)]
    rng.shuffle(rows)
    return folder(spark, tmp_path_factory, documents=spark.createDataFrame(rows, "doc_id long, text string").repartition(4))


@pytest.mark.parametrize("table", ["chains", "edge", "driver"])
def test_against_brute_force(spark, tmp_path_factory, sf_dir, chains, table):
    where = {"chains": chains, "driver": sf_dir, "edge": None}[table] or folder(spark, tmp_path_factory, documents=documents(spark))
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{where}/documents.parquet").collect()]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.op9_ngram_jaccard(spark, where).collect()), key=str)
    assert got == brute_force(rows)


def test_empty_table(spark):
    assert ngram_join.near_duplicates(empty(documents(spark))).count() == 0


def test_pigeonhole_holds_without_the_first_step():
    """Every pair at the bound is met by the segments alone."""
    rng = np.random.default_rng(5)
    for n in [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 13, 20, 33, 80, 300]:
        for _ in range(40):
            base = rng.integers(0, 2**63, 2 * n, dtype=np.uint64)
            m = int(rng.integers(max(1, n * 3 // 4), n + 1))
            common = next((c for c in range(m, -1, -1) if not ngram_join.linked(n, m, c)), -1) + 1
            if common > m:
                continue
            large, small = base[:n], np.concatenate([base[:common], base[n : n + m - common]])
            sizes = np.array([n, m])
            elements, of = np.concatenate([large, small]), np.repeat([0, 1], sizes)
            met = False
            for own in (True, False):
                x = ngram_join.level(elements, of, sizes, own)
                home = ngram_join.level(elements, of, sizes, True)
                ours = x.set_of == 0
                filled = np.flatnonzero(ours & x.filled)[: x.need[0]]
                theirs = set(home.key[home.filled & (home.set_of == 1)].tolist())
                waiting = set(home.thin_wait[home.thin_set == 1].tolist())
                bare = set(home.key[~home.filled & (home.set_of == 1)].tolist())
                thin = x.twice[x.thin_segment] & (x.thin_set == 0)
                met |= any(k in theirs for k in x.key[filled].tolist() + x.thin_key[thin].tolist())
                met |= any(k in waiting for k in x.double[x.twice & ours].tolist()) or any(k in bare for k in x.key[x.bare & ours].tolist())
            assert met, (n, m, common)


def test_components_of_a_long_chain(spark):
    links = spark.range(40).selectExpr("id AS b", "id + 1 AS a").union(spark.sql("select 100L, 101L")).union(spark.sql("select 7L, 7L"))
    got = {r.id: r.label for r in components(links.select("a", "b")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100}


def test_copies_in_many_blocks_stand_for_one_another(spark, monkeypatch):
    """Families that stay apart just below the bound, each copied into many blocks: pairs follow the different texts, not the copies."""
    rng = random.Random(5)
    rows, common = [], [f"w{i}" for i in range(60)]
    for copy in range(40):
        for family in range(8):
            rows.append((copy * 1000 + family, " ".join(common + [f"f{family}x{i}" for i in range(10)])))
        rows += [(copy * 1000 + 8 + k, " ".join(f"c{copy}k{k}w{rng.randrange(10**6)}" for _ in range(120))) for k in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    asked = []
    held = ngram_join.verified
    monkeypatch.setattr(ngram_join, "verified", lambda pairs, *more: asked.append(pairs.count()) or held(pairs, *more))
    got = sorted((tuple(r) for r in ngram_join.near_duplicates(docs).collect()), key=str)
    assert got == brute_force(rows)
    assert all({c for i, _, c in got if i % 1000 == k} == {k} for k in range(8))
    assert asked[1] <= 28  # one for two families; more where blocks ask for each other's copies
