import random
import re
from collections import Counter

import numpy as np
import pytest

from meterline.llm import collocations as co
from tests.compare import difference, duck_connection
from tests.llm.edge import documents, empty, folder


def low(text):
    return "".join(c.lower() if c < "\x80" else c for c in text or "")


def brute_force(rows, least=10, percent=50, top=2000):
    f, n = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low(text)):
            ws = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(ws)
            for size in (1, 2, 3):
                for k in range(len(ws) - size + 1):
                    counts = f.setdefault(lang, Counter())
                    counts[tuple(ws[k : k + size])] += 1
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in found.items():
            if any(len(q) > len(p) and 100 * b >= percent * a and any(q[k : k + len(p)] == p for k in range(len(q))) for q, b in found.items()):
                continue
            score, _, l, r = min((1000000 * a * a // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def rows_of(df):
    return [(r.lang, r.text) for r in df.select("lang", "text").collect()]


@pytest.fixture(scope="module")
def phrases(spark, tmp_path_factory):
    """Texts of few words in three languages and none, with pieces, capitals, odd blanks, and a text long enough to be cut."""
    rng = random.Random(9)
    words = ["New", "york", "city", "hall", "of", "the", "é", "\u0085x", "a\x00b", "THE"]
    rows = []
    for i in range(400):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", ", ", ".", "\r\n", "\x0b", " \x1c "]) for _ in range(rng.randrange(60)))
        rows.append((i, text, rng.choice(["en", "en", "fr", None])))
    rows.append((None, "new york; city hall. " * 60_000, "en"))
    return folder(spark, tmp_path_factory, documents=documents(spark).select("doc_id", "text", "lang").union(spark.createDataFrame(rows, "doc_id long, text string, lang string")))


def test_automaton():
    """States are the classes of substrings with the same ends, and links lead to the longest suffix with more."""
    rng = random.Random(2)
    for n in (0, 1, 2, 7, 300):
        ids, group = np.array([rng.randrange(4) for _ in range(n)], np.int64), np.sort(np.array([rng.randrange(1 + n // 5) for _ in range(n)], np.int64))
        ends = {}
        for i in range(n):
            for size in (1, 2, 3):
                if i - size + 1 >= 0 and group[i - size + 1] == group[i]:
                    ends.setdefault(tuple(ids[i - size + 1 : i + 1].tolist()), set()).add(i)
        a = co.Automaton(ids, group)
        at = a.places()
        names = [tuple(ids[b : b + size].tolist()) for b, size in zip(at.tolist(), a.length.tolist())]
        assert sorted(names) == sorted(ends)
        by_ends = {}
        for name, state in zip(names, a.state.tolist()):
            assert a.count[state] == len(ends[name]) and by_ends.setdefault(frozenset(ends[name]), state) == state
            assert a.shortest[state] <= len(name) <= a.longest[state]
        assert len(by_ends) == len(a.count)
        for k, name in enumerate(names):
            if len(name) > 1:
                state, length = a.suffix(k)
                assert length == len(name) - 1 and by_ends[frozenset(ends[name[1:]])] == state
        # ids beyond 21 bits are sorted another way
        b = co.Automaton(ids * (1 << 22), group)
        assert sorted(zip(b.places().tolist(), b.length.tolist())) == sorted(zip(at.tolist(), a.length.tolist())) or n > 2


@pytest.mark.parametrize("least,percent,top", [(10, 50, 2000), (2, 80, 5), (1, 0, 2000), (3, 50, 40)])
def test_against_brute_force(spark, phrases, least, percent, top):
    docs = spark.read.parquet(f"{phrases}/documents.parquet").where("text IS NULL OR length(text) < 40000" if least < 10 else "true")
    got = sorted(tuple(r) for r in co.collocations(docs, least, percent, top).collect())
    assert got == brute_force(rows_of(docs), least, percent, top) and (got or least == 1)


def test_small_shards_and_two_steps(spark, phrases):
    docs = spark.read.parquet(f"{phrases}/documents.parquet")
    got = co.collocations(docs, shard_bytes=20_000, bucket_bytes=10_000, fan_out=7)
    assert sorted(got.collect()) == sorted(co.collocations(docs).collect())


def test_query_on_the_drivers_table(spark, sf_dir):
    got = sorted(tuple(r) for r in co.op12_collocations(spark, sf_dir).collect())
    assert got == brute_force(rows_of(spark.read.parquet(f"{sf_dir}/documents.parquet"))) and got


def test_sql_on_odd_rows(spark, tmp_path, phrases):
    db = duck_connection(str(tmp_path))
    db.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{phrases}/documents.parquet/*.parquet')")
    assert difference(co.op12_collocations(spark, phrases), db, co.OP12_SQL) is None


def test_empty_table(spark, phrases):
    docs = spark.read.parquet(f"{phrases}/documents.parquet")
    assert co.collocations(empty(docs)).count() == 0
    assert co.collocations(docs.where("text IS NULL OR text = ''")).count() == 0
