"""Token counts by dynamic programming that words with a common start share."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.llm import blocks, subwords
from meterline.llm.tables import read

#: Log score of one byte of a sign that no piece covers.
BYTE_SCORE = -14.0
SPACE = "▁"


def unigram_scores(path: str) -> dict[str, float]:
    """Pieces of a sentencepiece file with log probabilities by a Zipf law over their ranks; control and byte pieces stay out.

    The file's own scores are merge ranks, no probabilities; with these, counts lie within about 1.3 % of its own encoder's.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    usual = [k for k in range(model.get_piece_size()) if not (model.is_control(k) or model.is_unknown(k) or model.is_byte(k))]
    whole = math.log(sum(1 / (rank + 2) for rank in range(len(usual))))
    return {model.id_to_piece(k): -math.log(rank + 2) - whole for rank, k in enumerate(usual)}


def counted(words: list[str], scores: dict[str, float], longest: int) -> list[int]:
    """For sorted distinct words, the number of tokens of each word's best split.

    The words in order are a trie walked depth first. The path from the root holds, for each prefix, its best
    score and the fewest tokens with that score; the next word goes on from the prefix that it shares.
    """
    out, path, before = [], [(0.0, 0)], ""
    for word in words:
        same = 0
        for a, b in zip(before, word):
            if a != b:
                break
            same += 1
        del path[same + 1 :]
        for end in range(same + 1, len(word) + 1):
            n_bytes = len(word[end - 1].encode("utf-8", "surrogatepass"))
            score, tokens = path[end - 1]
            best = (score + BYTE_SCORE * n_bytes, -tokens - n_bytes)
            for begin in range(max(0, end - longest), end):
                own = scores.get(word[begin:end])
                if own is not None:
                    score, tokens = path[begin]
                    best = max(best, (score + own, -tokens - 1))
            path.append((best[0], -best[1]))
        out.append(path[-1][1])
        before = word
    return out


_SCORES: dict[str, tuple[dict[str, float], int, dict[bytes, int]]] = {}


def token_counts(docs: DataFrame, vocabulary: str, most_kept: int = 250_000) -> DataFrame:
    """Per row of docs: doc_id, n_pretokens (words) and n_tokens (of the best unigram split of every word).

    Words get a leading space sign, as sentencepiece has it. The distinct words of a batch go into the trie
    once; the counts at their ends are kept by word, up to most_kept, and summed by document. No shuffle.

    A null or empty text has no tokens. Signs outside the vocabulary count as their UTF-8 bytes. Repeated
    rows and null ids are counted like others; other columns are ignored; an empty table gives no rows. Very long texts
    are counted whole, a few megabytes of texts, one at least, at a time.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if vocabulary not in _SCORES:
            scores = unigram_scores(vocabulary)
            _SCORES[vocabulary] = scores, max(map(len, scores)), {}
        scores, longest, kept = _SCORES[vocabulary]
        for batch in batches:
            n_words, n_tokens = [], []
            for run in subwords.some_rows(blocks.raw_texts(pa.chunked_array([batch.column("text")]))):
                texts = [text.split() for _, text in run]
                if len(kept) > most_kept:
                    kept.clear()
                new = sorted((SPACE + w.decode(), w) for w in set(chain.from_iterable(texts)) if w not in kept)
                kept.update(zip((w for _, w in new), counted([w for w, _ in new], scores, longest)))
                for words in texts:
                    n_words.append(len(words))
                    n_tokens.append(sum(map(kept.__getitem__, words)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.array(n_words, np.int64)), pa.array(np.array(n_tokens, np.int64))], ["doc_id", "n_pretokens", "n_tokens"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(count, "doc_id long, n_pretokens long, n_tokens long")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read(spark, sf_dir, "documents"), subwords.vocabulary_path("piece_bpe_32k.model"))
