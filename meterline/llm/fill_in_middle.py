"""Fill-in-middle transformation: texts are cut at code points, found by way of a sparse index of checkpoints."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from meterline.llm import words as word_scan
from meterline.llm.tables import boxed, read

#: The signs that mark the parts of an output.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Bytes from one checkpoint to the next.
STRIDE = 1024
#: Of 100 texts so many stay plain, and of 100 others so many put the suffix first.
PLAIN_PERCENT, SPM_PERCENT = 10, 20


class Checkpoints:
    """For every STRIDE-th byte of a text in UTF-8 how many code points begin before it.

    Counting looks at some strides at a time, so beside the text it needs eight bytes for each stride.
    """

    def __init__(self, raw: bytes, stride: int = STRIDE, at_once: int = 1024):
        self.raw, self.stride = np.frombuffer(raw, np.uint8), stride
        counts = [np.zeros(1, np.int64)]
        for begin in range(0, len(self.raw), stride * at_once):
            starts = self._starts(begin, begin + stride * at_once)
            counts.append(np.add.reduceat(starts, np.arange(0, len(starts), stride), dtype=np.int64))
        self.before = np.cumsum(np.concatenate(counts))
        self.n = int(self.before[-1])

    def _starts(self, begin: int, end: int) -> np.ndarray:
        """Whether a code point begins at each byte of a range."""
        return (self.raw[begin:end] & 0xC0) != 0x80

    def byte_of(self, point: int) -> int:
        """The byte at which a code point begins; the end of the text for their number."""
        if point >= self.n:
            return len(self.raw)
        k = int(np.searchsorted(self.before, point, side="right")) - 1  # the last checkpoint at or before it
        begin = k * self.stride
        return begin + int(np.flatnonzero(self._starts(begin, begin + self.stride))[point - int(self.before[k])])


def draws(doc_id: int | None) -> list[int]:
    """Four numbers of 32 bits that follow from the id alone; no id counts as an empty one."""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[k : k + 8], 16) for k in range(0, 32, 8)]


def transform(doc_id: int | None, raw: bytes) -> tuple[int, str, int | None, int | None, bytes]:
    """(code points, form, code points of prefix and middle, output) of a text in UTF-8."""
    index = Checkpoints(raw)
    h1, h2, h3, h4 = draws(doc_id)
    marked = any(sign.encode() in raw for sign in (PREFIX, SUFFIX, MIDDLE))
    if not raw or marked or h3 % 100 >= 100 - PLAIN_PERCENT:
        return index.n, "plain", None, None, raw
    first, second = sorted((h1 % (index.n + 1), h2 % (index.n + 1)))
    a, b = index.byte_of(first), index.byte_of(second)
    parts = {PREFIX: raw[:a], MIDDLE: raw[a:b], SUFFIX: raw[b:]}
    form, order = ("spm", (SUFFIX, PREFIX, MIDDLE)) if h4 % 100 < SPM_PERCENT else ("psm", (PREFIX, SUFFIX, MIDDLE))
    return index.n, form, first, second - first, b"".join(sign.encode() + parts[sign] for sign in order)


def fill_in_middle(docs: DataFrame) -> DataFrame:
    """docs with n, form, prefix_chars, middle_chars (null where plain) and output.

    A text of n code points is cut in two places that follow from doc_id. psm puts prefix, suffix, middle in this order, spm suffix,
    prefix, middle, each after its sign; plain leaves the text. Cuts never part a code point, but may part what
    a reader takes for one character (a letter and its accent, an emoji and its colour).

    A null text is an empty one and plain; so is a text that holds a sign. A row without doc_id is drawn as if its id were empty. Rows are judged
    alone: repeated rows give equal results. Very long texts are cut whole. Columns of docs may have any names; those named like
    the five new ones are replaced. An empty table gives no rows.
    """
    new = "n long, form string, prefix_chars long, middle_chars long, output string"
    names = [c.split()[0] for c in new.split(", ")]
    rows = boxed(docs).select("row", F.col("row.doc_id").cast("long").alias("doc_id"), F.col("row.text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in word_scan.slices(batch, "text"):
                texts = some["text"].cast(pa.large_binary()).fill_null(b"")
                made = list(zip(*(transform(i, t.as_py()) for i, t in zip(some["doc_id"].to_pylist(), texts))))
                columns = [pa.array(c, kind) for c, kind in zip(made, (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()))]
                columns[-1] = columns[-1].cast(pa.string())
                yield pa.RecordBatch.from_arrays([some["row"], *columns], ["row", *names])

    done = rows.mapInArrow(run, StructType([StructField("row", docs.schema), *DataType.fromDDL(new).fields]))
    return done.select(*[F.col(f"row.`{c}`") for c in docs.columns if c not in names], *names)


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of. Texts with signs are plain, and no sign can begin inside another, so each sign in an output parts it right."""
    part = lambda text, sign, n: F.split_part(text, F.lit(sign), F.lit(n))
    rest = part(output, MIDDLE, 1)
    psm_prefix, psm_suffix = part(part(rest, SUFFIX, 1), PREFIX, 2), part(rest, SUFFIX, 2)
    spm_prefix, spm_suffix = part(rest, PREFIX, 2), part(part(rest, PREFIX, 1), SUFFIX, 2)
    middle = part(output, MIDDLE, 2)
    return F.when(form == "psm", F.concat(psm_prefix, middle, psm_suffix)).when(form == "spm", F.concat(spm_prefix, middle, spm_suffix)).otherwise(output)


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fill_in_middle(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256")
    )


_HEX = "CAST('0x' || substr(h, {}, 8) AS BIGINT)"
OP13_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
drawn AS (SELECT doc_id, t, length(t) AS n, {', '.join(f'{_HEX.format(1 + 8 * k)} AS h{k + 1}' for k in range(4))} FROM d),
cut AS (SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
parts AS (SELECT *, substr(t, 1, a) AS p, substr(t, a + 1, b - a) AS m, substr(t, b + 1) AS s FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256
FROM parts"""
