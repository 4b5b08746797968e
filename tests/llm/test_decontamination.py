import hashlib
import re

import pytest

from meterline.llm import decontamination as dc
from tests.compare import difference, duck_connection
from tests.llm.edge import documents, empty, folder

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(text):
    return "".join(c.lower() if c < "\x80" else c for c in text or "")


def brute_force(docs, items):
    windows = {}
    for item, text in items:
        ws = WORD.findall(low(text))
        size = min(10, len(ws))
        for k in range(len(ws) - size + 1 if size else 0):
            windows.setdefault(tuple(ws[k : k + size]), set()).add(item)
    out = []
    for doc_id, text in docs:
        ws = WORD.findall(low(text))
        hit, found = set(), set()
        for size in {len(w) for w in windows}:
            for k in range(len(ws) - size + 1):
                if (w := tuple(ws[k : k + size])) in windows:
                    hit |= set(range(k, k + size))
                    found |= windows[w]
        ids = sorted(str(i) for i in found if i is not None)
        out.append((doc_id, len(ws), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


ITEMS = [
    (1, "Shared3 shared4, shared5 shared6 shared7 shared8 SHARED9 shared10 shared11 shared12 shared13"), (2, "shared12 shared13"), (3, None), (4, " .,; "),
    (5, "Emoji \U0001f600 emoji"), (6, "é ö"), (7, "w5x5 w6x6 w7x7 w8x8 w9x9 w10x10 w11x11 w12x12 w13x13 w14x14"), (None, "hunter22"), (7, "one"), (10, "one"), (8, "É ö"),
]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    return folder(spark, tmp_path_factory, documents=documents(spark), benchmark=spark.createDataFrame(ITEMS, "item_id long, text string"))


@pytest.mark.parametrize("edge", [True, False])
def test_against_brute_force(spark, sf_dir, tables, edge):
    where = tables if edge else sf_dir
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{where}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{where}/benchmark.parquet").collect()]
    got = sorted((tuple(r) for r in dc.op11_decontaminate(spark, where).collect()), key=str)
    assert got == brute_force(docs, items)
    assert any(r[-1] for r in got) and not all(r[-1] for r in got)


def test_sql_on_odd_rows(spark, tmp_path_factory, tables):
    """Very long texts stay out: their windows take DuckDB too long."""
    short = spark.read.parquet(f"{tables}/documents.parquet").where("text IS NULL OR length(text) < 20000")
    where = folder(spark, tmp_path_factory, documents=short, benchmark=spark.read.parquet(f"{tables}/benchmark.parquet"))
    db = duck_connection(str(tmp_path_factory.mktemp("none")))
    for t in ("documents", "benchmark"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{where}/{t}.parquet/*.parquet')")
    assert difference(dc.op11_decontaminate(spark, where), db, dc.OP11_SQL) is None


def test_a_large_benchmark_goes_in_parts(spark, tables):
    docs, items = (spark.read.parquet(f"{tables}/{t}.parquet") for t in ("documents", "benchmark"))
    key = lambda df: sorted(map(str, df.select("doc_id", "n_words", "n_hit", "spans", "items").collect()))
    assert key(dc.contamination(docs, items, most_bytes=60)) == key(dc.contamination(docs, items))


def test_removal(spark):
    item = " ".join(f"q{i}" for i in range(12))
    docs = spark.createDataFrame(
        [(1, f"Before, {item.upper()}! after", 9, "a"), (2, "clean text", 10, "b"), (3, None, None, "c"), (4, item, 4, "d")], "doc_id long, text string, n_chars long, spans string"
    )
    bench = spark.createDataFrame([(5, item)], "item_id long, text string")
    left = {r.doc_id: r for r in dc.decontaminate(docs, bench).collect()}
    assert left[1].text == "Before, ! after" and left[1].n_chars == 15 and left[1].spans == "a"
    assert left[2].text == "clean text" and left[3].text is None and left[4].text == ""
    assert sorted(r.doc_id for r in dc.decontaminate(docs, bench, "documents").collect()) == [2, 3]
    assert sorted(r.doc_id for r in dc.decontaminate(docs, bench, "documents", most_share=0.9).collect()) == [1, 2, 3]
    assert dc.decontaminate(docs, bench).columns == docs.columns
    with pytest.raises(ValueError):
        dc.decontaminate(docs, bench, "words")


def test_empty_tables(spark, tables):
    docs, items = (spark.read.parquet(f"{tables}/{t}.parquet") for t in ("documents", "benchmark"))
    assert dc.contamination(empty(docs), items).count() == 0
    assert dc.contamination(docs, empty(items)).where("n_hit > 0").count() == 0
