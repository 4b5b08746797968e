import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from meterline.llm import quality, secret_scan, subwords
from tests.llm.edge import documents, folder
from tests.llm.test_native import WORDS, quality_of
from tests.llm.test_ngram_join import brute_force


def clean(text):
    """Lines that stay, or None if the document is rejected."""
    if text is None or quality_of(text)[-1]:
        return None
    left = []
    for line in text.split("\n"):
        words = WORDS.findall(line)
        chars = sum(map(len, words))
        end = line.rstrip(" \t\x0b\x0c\r")[-4:]
        fails = bool(words) and (
            (len(words) < 10 and not re.search(quality.CLOSED, end))
            or (len(words) >= 5 and re.search(r"[A-ZÀ-ÖØ-Þ]", line) and not re.search(r"[a-zß-öø-ÿ]", line))
            or re.search(r"[|»›•].*[|»›•].*[|»›•]", line)
            or len(re.findall(r"[#*$%&<>]", line)) * 4 > chars
            or (len(words) < quality.PROSE_WORDS and any(x in line.lower() for x in quality.BOILERPLATE))
        )
        if not fails:
            left.append(line)
    before, after = (sum(map(len, WORDS.findall(t))) for t in (text, "\n".join(left)))
    return "\n".join(left) if before and after >= before / 2 else None


def without_secrets(text):
    spans = []
    for kind, pattern, group, least in secret_scan.RULES:
        spans += [m.span() for m in re.finditer(pattern, text, re.ASCII) if len(m.group(group)) >= least]
    out, at = [], 0
    for a, b in sorted(spans):
        if b > at:
            out += [text[at:a] + "[SECRET]"] if a >= at else []
            at = b
    return "".join(out) + text[at:]


@pytest.mark.parametrize("table", ["edge", "/root/testdata/sf0.001"])
def test_against_plain_python(spark, tmp_path_factory, table):
    from tokenizers import Tokenizer

    where = folder(spark, tmp_path_factory, documents=documents(spark)) if table == "edge" else table
    rows = [(r.doc_id, clean(r.text)) for r in spark.read.parquet(f"{where}/documents.parquet").collect()]
    rows = [(i, t) for i, t in rows if t is not None]
    label = {i: c for i, _, c in brute_force(rows)}
    left = {i: without_secrets(t) for i, t in sorted(rows, key=lambda r: (r[0] or 0, r[1]), reverse=True) if label[i] == i}
    tokenizer = Tokenizer.from_file(subwords.vocabulary_path("word_bpe_49k.json"))
    want = {i: np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 1], "<u4") for i, t in left.items()}
    got = corpus_pipeline.run(spark, where).collect()
    assert {r.doc_id for r in got} == set(want)
    assert sum(r.length for r in got) == sum(map(len, want.values()))
    for r in got:
        assert r.ids_crc32 == zlib.crc32(want[r.doc_id][r.start : r.start + r.length].tobytes())


def test_stages_keep_the_columns(spark, tmp_path_factory):
    docs = documents(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes)
        assert stage(spark, docs.where("false"), "").count() == 0


def test_stages_keep_users_columns_by_value(spark):
    """Columns named like those made on the way, a map, and two texts under one id."""
    prose = " ".join(f"word{k}" for k in range(40)) + ". This closes the only line of the text, as it should."
    names = ["kept", "n_words", "blob", "stream", "_lines", "_repeated", "row", "slot", "spans", "salt", "number", "id"]
    docs = spark.createDataFrame([(1, prose, "src1", 7), (1, prose.upper().lower()[::-1] + ".", "src1", 7), (2, prose + " secret=hunter22 end.", "src2", 8)], "doc_id long, text string, source string, n_chars long")
    for c in names:
        docs = docs.withColumn(c, F.concat(F.lit(c), F.col("doc_id").cast("string")))
    docs = docs.withColumn("m", F.create_map(F.lit("k"), "doc_id"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, docs, "").collect()
        assert rows and all(r[c] == f"{c}{r.doc_id}" and r.m == {"k": r.doc_id} for r in rows for c in names), name
        if name == "ngram_jaccard":
            assert sorted(r.doc_id for r in rows) in ([1, 1], [1, 2])
        else:
            assert len(rows) == (3 if name != "quality_rules" else len(rows))


def test_different_texts_under_one_id_stay(spark):
    a, b = (" ".join(f"{x}{k}" for k in range(40)) for x in "ab")
    docs = spark.createDataFrame([(5, a, 1), (5, b, 2), (5, a, 3), (6, a, 4), (7, None, 5), (None, a, 6), (8, "c " * 30, 7)], "doc_id long, text string, n int")
    assert sorted(r.n for r in corpus_pipeline.ngram_jaccard(spark, docs, "").collect()) in ([1, 2, 5, 6, 7], [2, 3, 5, 6, 7])


def test_mixed_files_follow_the_order(spark, sf_dir):
    from meterline.llm import mixing

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    order = {r.doc_id: (r.slot, r.place) for r in mixing.mix(docs, mixing.PRODUCTION_SHARES, mixing.OTHERS_SHARE).collect()}
    got = [order[r.doc_id] for r in corpus_pipeline.mix_sources(spark, docs, sf_dir).collect()]
    assert got == sorted(got) and len(got) == len(order)


def test_sequences_follow_the_mixed_order(spark, tmp_path):
    from meterline.llm import mixing

    held = {"spark.sql.files.maxPartitionBytes": "20k", "spark.sql.files.openCostInBytes": "1k"}
    docs = spark.range(600).selectExpr("id AS doc_id", "repeat(concat('word', id, ' '), CAST(1 + id % 7 * (id % 7) * 40 AS int)) AS text", "concat('src', IF(id < 400, 0, id % 5)) AS source")
    order = [r.doc_id for r in mixing.mix(docs, mixing.PRODUCTION_SHARES, mixing.OTHERS_SHARE).orderBy("slot", "place").collect()]
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        for k in range(4):
            corpus_pipeline.mix_sources(spark, docs, "").where(f"doc_id % 7 = {k} OR (doc_id % 7 > 3 AND {k} = 3)").coalesce(1).write.mode("append").parquet(f"{tmp_path}/mixed")
        again = spark.read.schema(docs.schema).parquet(f"{tmp_path}/mixed")
        rows = corpus_pipeline.pack_sequences(spark, again, "").orderBy("sequence_id").collect()
    finally:
        for k in held:
            spark.conf.unset(k)
    assert list(dict.fromkeys(r.doc_id for r in rows)) == order
    assert len({r.sequence_id for r in rows}) == len(rows)
