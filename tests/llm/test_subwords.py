import math
import zlib

import numpy as np
import pytest

from meterline.llm import packing, subwords, token_counts
from tests.llm.edge import documents, empty, folder


@pytest.mark.parametrize("table", ["edge", "driver"])
def test_pieces_hold_every_id_once(spark, tmp_path_factory, sf_dir, table):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(subwords.vocabulary_path("word_bpe_49k.json"))
    where = sf_dir if table == "driver" else folder(spark, tmp_path_factory, documents=documents(spark))
    rows = spark.read.parquet(f"{where}/documents.parquet").collect()
    want = {}
    for r, e in zip(rows, tokenizer.encode_batch([r.text or "" for r in rows], add_special_tokens=False)):
        want.setdefault(r.doc_id, []).append(np.array([*e.ids, 1], "<u4"))
    got = packing.op5_pack_sequences(spark, where).collect()
    assert len({r.sequence_id for r in got}) == len(got)
    seen = {}
    for r in got:
        ids = want[r.doc_id][0]
        assert r.doc_tokens == len(ids) and r.offset == 0 and r.length <= 2048 and r.length & (r.length - 1) == 0
        assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
        seen.setdefault(r.doc_id, []).append((r.start, r.length))
    assert seen.keys() == want.keys()
    for i, pieces in seen.items():
        assert sum(n for _, n in pieces) == sum(map(len, want[i]))


def test_ids_and_empty_table(spark):
    docs = documents(spark)
    vocabulary = subwords.vocabulary_path("word_bpe_49k.json")
    for r in packing.pack_documents(docs, vocabulary).collect():
        assert len(r.ids) == r.length and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
    assert packing.pack_documents(empty(docs), vocabulary).count() == 0
    assert packing.piece_lengths(5000) == [2048, 2048, 512, 256, 128, 8]


def test_encoder_forgets_and_learns_again():
    calls = []

    def ids_of(words):
        calls.append(len(words))
        return np.array([k for w in words for k in (len(w), 7)]), np.full(len(words), 2)

    encode = subwords.WordIds(ids_of, most=2)
    for _ in range(3):
        ids, sizes = encode([[b"a", b"bb"], [], [b"ccc"]])
        assert ids.tolist() == [1, 7, 2, 7, 3, 7] and sizes.tolist() == [4, 0, 2]
    assert calls == [3, 3, 3]


def test_ranks_give_the_ids_of_the_vocabulary(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(subwords.vocabulary_path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    path = subwords.vocabulary_path("byte_bpe_50k.tiktoken")
    words = [w.decode() for r in documents(spark).collect() for w in (r.text or "").encode().split()][:5000]
    words += ["\u00a0a\u00a0", "\u2028", "<|endoftext|>", "isn't", "12ab", "x" * 5000]
    ids, sizes = subwords.rank_words(path)([[w.encode()] for w in words])
    want = [e.ids for e in tokenizer.encode_batch([" " + w for w in words], add_special_tokens=False)]
    assert sizes.tolist() == list(map(len, want)) and ids.tolist() == [k for x in want for k in x]
    begins = subwords.begins_word(subwords.ranks_of(path))
    assert len(begins) == 50257 and all((tokenizer.id_to_token(k) or "").startswith("Ġ") == begins[k] for k in range(50257))


def viterbi(word, scores):
    best = [(0.0, 0)] + [None] * len(word)
    for end in range(1, len(word) + 1):
        n = len(word[end - 1].encode())
        options = [(best[end - 1][0] + token_counts.BYTE_SCORE * n, best[end - 1][1] - n)]
        options += [(best[b][0] + scores[word[b:end]], best[b][1] - 1) for b in range(end) if word[b:end] in scores]
        best[end] = max(options)
    return -best[-1][1]


@pytest.mark.parametrize("table", ["edge", "driver"])
def test_counts_against_single_words(spark, tmp_path_factory, sf_dir, table):
    scores = token_counts.unigram_scores(subwords.vocabulary_path("piece_bpe_32k.model"))
    where = sf_dir if table == "driver" else folder(spark, tmp_path_factory, documents=documents(spark))
    cache, want = {}, []
    for r in spark.read.parquet(f"{where}/documents.parquet").collect():
        words = [w.decode() for w in (r.text or "").encode().split()]
        for w in set(words) - cache.keys():
            cache[w] = viterbi(token_counts.SPACE + w, scores) if len(w) < 1000 else None
        want.append((r.doc_id, len(words), None if None in map(cache.get, words) else sum(map(cache.get, words))))
    got = [tuple(r) for r in token_counts.op3_token_counts(spark, where).collect()]
    assert len(got) == len(want)
    known = {(i, n): t for i, n, t in want}
    assert all(known[i, n] in (t, None) for i, n, t in got)


def test_unigram_scores_are_probabilities_near_the_files_own_counts(spark, sf_dir):
    import sentencepiece

    path = subwords.vocabulary_path("piece_bpe_32k.model")
    assert abs(sum(math.exp(v) for v in token_counts.unigram_scores(path).values()) - 1) < 1e-9
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    own = {r.doc_id: len(model.encode(r.text or "")) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = {r.doc_id: r.n_tokens for r in token_counts.op3_token_counts(spark, sf_dir).collect()}
    assert sum(abs(got[i] - n) for i, n in own.items()) < 0.02 * sum(own.values())


def test_words_of_letters_go_to_the_model_at_once():
    """Ids are those of the library word by word, but its whole way is not taken for words of letters."""
    import tokenizers

    path = subwords.vocabulary_path("word_bpe_49k.json")
    tokenizer = tokenizers.Tokenizer.from_file(path)
    words = ["Word", "word,", "word.,;", "Été", "straße!", "İstanbul", "éte", "ΣΣ.", "don't", "'s", "'sword", "a'", "x1y2", ".", "?!", "to&&&", "é###", "a%'", "b\"'s", "c_d", "e__", "<|endoftext|>", "<|ENDOFTEXT|>", "a<b"]
    words += [" ", " .", "a b", "中文,", "ǅ", "ﬁn", "Å", "ẛ̣", "x" * 3000, "ª", "ʰ", "\U0001d400b", "k̇", "กำ", "ͅ", "aͅ."]
    words += [f"w{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(500)]
    words += [chr(97 + k % 26) + chr(c) + tail for k, c in enumerate(range(0xA1, 0x3100)) for tail in ("", ",") if not chr(c).isspace()]
    want = [e.ids for e in tokenizer.encode_batch(words, add_special_tokens=False)]
    for some in (words, words[::-1]):
        ids, size = subwords.bpe_words(path)([[w.encode()] for w in some])
        got = np.split(ids, np.cumsum(size)[:-1])
        assert all(g.tolist() == w for g, w in zip(got, want if some is words else want[::-1]))
        subwords.bpe_words(path).forget()
    assert subwords.letters_apart(tokenizer)
    assert not subwords.letters_apart(tokenizers.Tokenizer.from_file(subwords.vocabulary_path("byte_bpe_50k.json")))


def test_words_of_ranks_are_encoded_together(monkeypatch):
    """With the ids that each word has by itself, odd spaces and marks inside words as well."""
    import public_tokenizers
    import tiktoken

    path = subwords.vocabulary_path("byte_bpe_50k.tiktoken")
    words = [f"{a}{b}{k}{c}" for k in range(9) for a in ("", "'s", "x", "\u00e9", "(", "12") for b in ("", "'ll", "--", "ab", "\u4e2d") for c in ("", ".", "'", "z\u0301", "\U0001f600")]
    odd = ["\u00a0", "a\u00a0", "\u2003b", "\u00a0\u2003", "c\x1cd", "\x85", "e\u2028f", "\ufeff", "\x00"]
    one = tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=subwords.ranks_of(path), special_tokens={}).encode_ordinary
    calls = []

    class Counted(tiktoken.Encoding):
        def encode_ordinary(self, text):
            calls.append(text)
            return super().encode_ordinary(text)

    monkeypatch.setattr(tiktoken, "Encoding", Counted)
    monkeypatch.setattr(subwords, "_LOADED", {})
    for some in (words, [*words[:300], *odd, *words[300:]], odd, words[:1], []):
        monkeypatch.setattr(subwords, "_LOADED", {})
        calls.clear()
        ids, sizes, n_words = subwords.rank_words(path).by_word([[w.encode() for w in some], []])
        assert [x.tolist() for x in np.split(ids, np.cumsum(sizes))[:-1]] == [one(" " + w) for w in some] and n_words.tolist() == [len(some), 0]
        assert len(calls) < len(some) / 2 or some is not words
