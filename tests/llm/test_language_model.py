import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from meterline.llm import language_model as lm
from meterline.llm import blocks, subwords
from tests.llm.edge import documents, empty, folder


def base_scores(rows):
    texts = [(i, (t or "").encode().lower().split()) for i, t in rows]
    out = lambda i: i is None or zlib.crc32(str(i).encode()) % 10 == 0
    counts = Counter(w for i, words in texts if not out(i) for w in [*words, "end"])
    n, v = sum(counts.values()), len(counts)
    return {
        (i, len(words) + 1): (out(i), sum(counts[w] > 0 for w in [*words, "end"]), n, sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in [*words, "end"]))
        for i, words in texts
    }


@pytest.mark.parametrize("table", ["edge", "/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_base_scores_and_held_out_texts(spark, tmp_path_factory, table):
    where = folder(spark, tmp_path_factory, documents=documents(spark)) if table == "edge" else table
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{where}/documents.parquet").collect()]
    want = base_scores(rows)
    got = lm.op4_lm_scores(spark, where).collect()
    assert len(got) == len(rows)
    for r in got:
        out, known, n, base = want[r.doc_id, r.n_tokens]
        assert (r.held_out, r.n_known, r.train_tokens) == (out, known, n)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and math.isfinite(r.score) and r.score < 0
    if table != "edge":
        ours, base = (sum(getattr(r, k) for r in got if r.held_out) for k in ("score", "base_score"))
        print(table, "held out: model", ours, "base", base)
        assert ours > base


def test_empty_table(spark):
    docs = empty(documents(spark))
    assert lm.score_documents(docs, subwords.vocabulary_path("byte_bpe_50k.tiktoken")).count() == 0


def tiny():
    rng = np.random.default_rng(0)
    counts = np.zeros(lm.VOCABULARY, np.int64)
    counts[:3000] = rng.integers(1, 50, 3000)
    known = lm.ids_from_counts(counts, np.arange(lm.VOCABULARY) % 2 == 0)
    weights = lm.begin_weights()
    weights["u"] = rng.normal(size=weights["u"].shape).astype(np.float32)
    ids = rng.integers(0, 3000, 5000)
    before = lm.inputs_before(ids, np.array([5000]), known)
    pairs = np.zeros((lm.BEFORE, lm.HEADS))
    np.add.at(pairs, (before, known.outcome[ids]), 1)
    return rng, known, lm.Model(weights, lm.bigram_logits(pairs))


def test_probabilities_sum_to_one_and_only_look_back():
    rng, known, model = tiny()
    start = rng.integers(0, 300, 21)
    ids = np.concatenate([np.concatenate([start, [k]]) for k in range(lm.VOCABULARY)]).astype(np.int64)
    logs = lm.id_scores(model, known, ids, np.full(lm.VOCABULARY, 22)).reshape(-1, 22)
    assert np.allclose(logs[:, :21], lm.id_scores(model, known, start, np.array([21])), atol=1e-5)
    assert abs((10 ** logs[:, 21].astype(np.float64)).sum() - 1) < 1e-4


def test_fast_scores_are_those_of_the_model():
    rng, known, model = tiny()
    sizes = np.array([1, 15, 16, 17, 40])
    ids = rng.integers(0, 4000, sizes.sum())
    x, pad, y, _, use, _ = lm.windows(ids, sizes, known)
    f = lm.forward(model.weights, model.bias, x, pad)
    want = np.log10(np.take_along_axis(f["z"], y[..., None], 2)[..., 0] / f["total"])[use]
    want = want + known.share[ids]
    assert np.allclose(lm.id_scores(model, known, ids, sizes), want, atol=1e-4)


def test_each_id_is_scored_once():
    _, known, _ = tiny()
    sizes = np.array([1, 15, 16, 17, 40])
    ids = np.arange(sizes.sum())
    _, _, _, target, use, _ = lm.windows(ids, sizes, known)
    assert sorted(target[use].tolist()) == ids.tolist()


def test_gradient():
    rng, known, model = tiny()
    bias = model.bias
    weights = {k: v.astype(np.float64) for k, v in model.weights.items()}
    sizes = np.array([40, 9])
    ids = rng.integers(0, 300, sizes.sum())
    x, pad, y, _, use, _ = lm.windows(ids, sizes, known)

    def loss(w):
        f = lm.forward(w, bias, x, pad)
        p = np.take_along_axis(f["z"], y[..., None], 2)[..., 0] / f["total"]
        return -(np.log(p) * use).sum() / use.sum()

    for name in weights:
        moved = {k: v.copy() for k, v in weights.items()}
        squares = {k: np.zeros_like(v) for k, v in weights.items()}
        lm.step(moved, bias, x, pad, y, use, squares, 0.0)
        at = np.unravel_index(np.argmax(squares[name]), squares[name].shape)
        up, down = ({k: v.copy() for k, v in weights.items()} for _ in range(2))
        up[name][at] += 1e-5
        down[name][at] -= 1e-5
        slope = (loss(up) - loss(down)) / 2e-5
        assert math.isclose(abs(slope), math.sqrt(squares[name][at]), rel_tol=2e-3), name


def test_pairs_keep_the_sum_of_one():
    rng, known, model = tiny()
    logs = lm.id_scores(model, known, np.stack([np.full(lm.VOCABULARY, 7), np.arange(lm.VOCABULARY)], axis=1).ravel(), np.full(lm.VOCABULARY, 2))[1::2]
    pairs = rng.integers(0, 3, lm.VOCABULARY)
    assert abs((10 ** lm.with_pairs(logs, pairs, pairs.sum())).sum() - 1) < 1e-4


def test_every_window_of_a_training_text_is_learnt(spark):
    vocabulary = subwords.vocabulary_path("byte_bpe_50k.tiktoken")
    texts = {1: "one two", 2: " ".join(f"word{i % 90}" for i in range(20_000)), 3: None, 4: ""}
    sizes = [len(lm.encoder(vocabulary)([(t or "").encode().split()])[0]) + 1 for i, t in texts.items() if not lm.held_out(i)]
    known = lm.ids_from_counts(np.ones(lm.VOCABULARY, np.int64), np.arange(lm.VOCABULARY) % 2 == 0)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    packed = blocks.chunks(docs, blocks.layout(docs), lm.encoded(vocabulary))
    assert lm.train(packed, known, lm.bigram_logits(np.zeros((lm.BEFORE, lm.HEADS)))).n_windows == sum(-(-n // lm.STRIDE) for n in sizes)


def test_attention_is_better_than_bigrams_alone(spark):
    """On held-out texts; and the model is the same however blocks are dealt to tasks."""
    vocabulary = subwords.vocabulary_path("byte_bpe_50k.tiktoken")
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text").where("doc_id % 2 = 0")
    rows = docs.collect()
    encode = lm.encoder(vocabulary)
    ids, sizes = lm.with_ends(*encode([(r.text or "").encode().lower().split() for r in rows]))
    trained = np.repeat([not lm.held_out(r.doc_id) for r in rows], sizes)
    known = lm.ids_from_counts(np.bincount(ids[trained], minlength=lm.VOCABULARY), subwords.begins_word(subwords.ranks_of(vocabulary)))
    pairs = np.bincount(lm.inputs_before(ids, sizes, known)[trained] * lm.HEADS + known.outcome[ids][trained], minlength=lm.BEFORE * lm.HEADS)
    bias = lm.bigram_logits(pairs.reshape(lm.BEFORE, lm.HEADS))
    packed = blocks.chunks(docs, blocks.layout(docs, fewest=2), lm.encoded(vocabulary))
    model = lm.train(packed, known, bias)
    again = lm.train(packed.repartition(7), known, bias)
    assert all(np.allclose(model.weights[k], again.weights[k], atol=1e-5) for k in model.weights)
    alone = lm.Model(lm.begin_weights(), bias)  # its output weights are zero
    with_it, without = (lm.id_scores(m, known, ids, sizes)[~trained].sum() for m in (model, alone))
    print("held out, log10: attention", with_it, "bigrams alone", without)
    assert with_it > without * 0.99


def test_keys_of_words_are_made_when_asked_for():
    rows = pa.table({"doc_id": [1, 2], "text": ["one two one", ""]})
    texts = lm.Texts(pa.chunked_array([pa.array([blocks.packed(lm.encoded(subwords.vocabulary_path("byte_bpe_50k.tiktoken"))(rows))])]))
    assert "word_keys" not in vars(texts)
    a, b, c = texts.word_keys
    assert a == c != b and texts.sizes.sum() == len(texts.ids)


def test_pairs_of_rare_ids_are_counted(spark):
    vocabulary = subwords.vocabulary_path("byte_bpe_50k.tiktoken")
    words = [p[1:].decode() for p in subwords.ranks_of(vocabulary) if p[:1] == b" " and p[1:].isalpha() and p[1:].islower() and p.isascii()][:4004]
    *often, a, b, c, d = words
    ids = [i for i in range(400) if not lm.held_out(i)]
    out = [i for i in range(400) if lm.held_out(i)]
    texts = [(i, " ".join(often[k % 10 :: 10])) for k, i in enumerate(ids[:30])]
    texts += [(i, f"{a} {b}") for i in ids[30:32]] + [(i, f"{c} {d}") for i in ids[32:34]]
    docs = spark.createDataFrame([*texts, (out[0], f"{a} {b}"), (out[1], f"{a} {d}")], "doc_id long, text string")
    score = {r.doc_id: r.score for r in lm.score_documents(docs, vocabulary).collect() if r.held_out}
    assert score[out[0]] > score[out[1]] + 0.02


def test_pairs_only_choose_inside_an_outcome():
    rng, known, model = tiny()
    ids, sizes = np.stack([np.full(lm.VOCABULARY, 7), np.arange(lm.VOCABULARY)], axis=1).ravel(), np.full(lm.VOCABULARY, 2)
    outcomes = lm.outcome_scores(model, known, ids, sizes)[1::2]
    pairs = rng.integers(0, 1000, lm.VOCABULARY)
    befores = np.zeros((lm.VOCABULARY, 2), np.int64)
    befores[7] = [pairs[known.outcome == k].sum() for k in (lm.HEADS - 2, lm.HEADS - 1)]
    inside = 10 ** lm.shares(known, ids[1::2], ids[::2], pairs, befores)
    sums = np.bincount(known.outcome, inside, lm.HEADS)
    assert np.allclose(sums, 1)
    assert abs((10 ** outcomes.astype(np.float64) * inside).sum() - 1) < 1e-4


def test_the_score_comes_through_attention(spark, monkeypatch):
    """With the layer's output weights at zero, the held-out score loses more than a fifth of its gain over the base."""
    vocabulary = subwords.vocabulary_path("byte_bpe_50k.tiktoken")
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")

    def held_out_sums():
        row = lm.score_documents(docs, vocabulary).where("held_out").selectExpr("sum(score) s", "sum(base_score) b", "sum(n_tokens) n").head()
        return row.s / row.n, row.b / row.n

    with_it, base = held_out_sums()
    monkeypatch.setattr(lm, "train", lambda packed, known, bias: lm.Model(lm.begin_weights(), bias))
    without, _ = held_out_sums()
    print("held out, log10 a token: with attention", with_it, "without", without, "base", base)
    assert with_it - without > (with_it - base) / 5
