"""Packing by powers of two: each document is split into pieces of binary lengths, and equal lengths make a bucket."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.llm import blocks, subwords
from meterline.llm.tables import read

LONGEST = 2048
END_ID = 1
DIGEST = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def piece_lengths(n: int, longest: int = LONGEST) -> list[int]:
    """As many of the longest as fit, then the binary digits of the rest, largest first."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << k for k in range(longest.bit_length() - 2, -1, -1) if rest >> k & 1]


def pack_documents(docs: DataFrame, vocabulary: str, longest: int = LONGEST, end_id: int = END_ID, with_ids: bool = True, keep_words: bool = True) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, bucket and, if asked for, ids.

    A document's ids and end_id are cut into lengths that are powers of two, up to longest. Each piece is a
    sequence of its own, so none crosses documents and none is padded; bucket is its length, and a batch takes
    sequences of one bucket. Rows are dealt with where they are read; nothing is shuffled, and sequence_id rises in the order of docs.

    A null or empty text gives end_id alone. Repeated rows and ids, null ids too, are packed once for each row
    (sequence_id differs). Other columns are ignored; an empty table gives no rows. A very long text is encoded whole
    and cut into as many pieces as it takes. keep_words=False lets a Python worker forget its words at the end of each task: idle
    workers, which Spark keeps, then hold some 150 MB each instead of some 350, and each task encodes its words anew.
    """
    schema = DIGEST + (", ids array<int>" if with_ids else "")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = subwords.bpe_words(vocabulary)
        for batch in batches:
            doc_ids = batch.column("doc_id").to_pylist()
            for run in subwords.some_rows(blocks.raw_texts(pa.chunked_array([batch.column("text")]))):
                ids, sizes = encode([text.split() for _, text in run])
                rows, pieces, at = [], [], 0
                for (k, _), size in zip(run, sizes.tolist()):
                    own = np.append(ids[at : at + size], np.int32(end_id)).astype("<u4")
                    at += size
                    begin = 0
                    for n in piece_lengths(size + 1, longest):
                        rows.append((doc_ids[k], begin, n, zlib.crc32(own[begin : begin + n].data), size + 1))
                        begin += n
                    pieces.append(own)
                columns = [pa.array(c, pa.int64()) for c in zip(*rows)]
                if with_ids:
                    offsets = np.concatenate([[0], np.cumsum([r[2] for r in rows])]).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(pieces).astype(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in schema.split(", ")])
        if not keep_words:
            encode.forget()

    made = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(pack, schema)
    return made.withColumn("sequence_id", F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long")).withColumn("bucket", F.col("length"))


def op5_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    out = pack_documents(docs, subwords.vocabulary_path("word_bpe_49k.json"), with_ids=False)
    return out.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
