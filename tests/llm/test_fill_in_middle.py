import hashlib
import random

import pytest

from meterline.llm import fill_in_middle as fim
from tests.compare import difference, duck_connection
from tests.llm.edge import documents, empty, folder


def brute_force(rows):
    out = []
    for doc_id, text in rows:
        text, n = text or "", len(text or "")
        h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
        h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
        a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
        if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
            form, made, sizes = "plain", text, (None, None)
        elif h4 % 100 < 20:
            form, made, sizes = "spm", f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}", (a, b - a)
        else:
            form, made, sizes = "psm", f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}", (a, b - a)
        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        out.append((doc_id, n, form, *sizes, sha(made), sha(text)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """Texts that look like signs, and characters of one to four bytes; beside them the rows that every operator must bear."""
    rng = random.Random(5)
    signs = ["<", ">", "P", "S", "M", "<P", "S>", "<M", "é", "語", "\U0001f600", "é", " "]
    rows = [(100 + i, "".join(rng.choice(signs) for _ in range(rng.randrange(40)))) for i in range(400)]
    rows += [(900 + i, "aé語\U0001f600" * (300 * i)) for i in range(8)]
    odd = spark.createDataFrame(rows, "doc_id long, text string")
    return folder(spark, tmp_path_factory, documents=documents(spark).unionByName(odd, allowMissingColumns=True))


@pytest.mark.parametrize("edge", [True, False])
def test_against_brute_force(spark, sf_dir, odd, edge):
    where = odd if edge else sf_dir
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{where}/documents.parquet").collect()]
    got = sorted((tuple(r) for r in fim.op13_fill_in_middle(spark, where).collect()), key=str)
    assert got == brute_force(rows)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


def test_sql_on_odd_rows(spark, tmp_path, odd):
    db = duck_connection(str(tmp_path))
    db.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{odd}/documents.parquet/*.parquet')")
    assert difference(fim.op13_fill_in_middle(spark, odd), db, fim.OP13_SQL) is None


@pytest.mark.parametrize("stride", [1, 2, 3, 7, 64, 10_000])
def test_checkpoints_find_every_code_point(stride):
    text = "aé語\U0001f600b" * 50
    index = fim.Checkpoints(text.encode(), stride, at_once=3)
    assert index.n == len(text)
    assert [index.byte_of(k) for k in range(len(text) + 1)] == [len(text[:k].encode()) for k in range(len(text) + 1)]
    assert fim.Checkpoints(b"").byte_of(0) == 0


def test_clashing_columns_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "some text", "a", 5, "row")], "doc_id long, text string, form string, n long, `a row` string")
    out = fim.fill_in_middle(docs)
    assert out.columns == ["doc_id", "text", "a row", "n", "form", "prefix_chars", "middle_chars", "output"]
    assert out.head().n == 9 and out.head()["a row"] == "row"
    assert fim.fill_in_middle(empty(docs)).count() == 0
