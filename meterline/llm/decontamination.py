"""Benchmark decontamination: a broadcast hash set of the benchmark's word windows, and a scan of every training text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.llm import words as word_scan
from meterline.llm.blocks import FOR_KEY, window_hashes
from meterline.llm.tables import LOWER_SQL, boxed, read, with_field, written

WINDOW = 10
#: Benchmark text in one broadcast, in bytes. A larger benchmark is dealt to several, scanned for one after the other.
MOST_BYTES = 8 << 20
#: Digits, letters, and every byte of a character beyond ASCII.
WORD_BYTES = np.array([b >= 0x80 or chr(b).isalnum() for b in range(256)])
FILTER_BITS = 22
SPANS = "array<struct<start:int,n_words:int>>"


@dataclass
class Windows:
    """Windows of one length: their hashes in order, the words of each, and the items that hold it."""

    size: int
    keys: np.ndarray
    texts: list[list[bytes]]
    items: list[list[list[str]]]
    filter: np.ndarray

    def candidates(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of some hashes are among the windows', and where they stand there."""
        some = np.flatnonzero(self.filter[keys >> np.uint64(64 - FILTER_BITS)])
        at = np.minimum(np.searchsorted(self.keys, keys[some]), len(self.keys) - 1)
        found = self.keys[at] == keys[some]
        return some[found], at[found]


def index(items: list[tuple[str | None, str | None]], size: int = WINDOW) -> list[Windows]:
    """Windows of all lengths that occur: `size` words, or all the words of an item that has fewer."""
    found = word_scan.scan(pa.array([t for _, t in items], pa.large_string()), WORD_BYTES)
    first = np.cumsum(found.sizes) - found.sizes
    by_size: dict[int, dict[bytes, set[str | None]]] = {}
    hashes: dict[bytes, int] = {}
    for (item, _), begin, n in zip(items, first.tolist(), found.sizes.tolist()):
        length = min(size, n)
        if not length:
            continue
        keys = window_hashes(found.hashes[0][begin : begin + n], length, FOR_KEY).tolist()
        for k, key in enumerate(keys):
            text = found.joined(begin + k, length)
            by_size.setdefault(length, {}).setdefault(text, set()).add(item)
            hashes[text] = key
    out = []
    for length, windows in sorted(by_size.items()):
        by_key: dict[int, list[bytes]] = {}
        for text in windows:
            by_key.setdefault(hashes[text], []).append(text)  # more than one only where hashes collide
        keys = np.array(sorted(by_key), np.uint64)
        bits = np.zeros(1 << FILTER_BITS, bool)
        bits[keys >> np.uint64(64 - FILTER_BITS)] = True
        texts = [by_key[k] for k in keys.tolist()]
        out.append(Windows(length, keys, texts, [[sorted(i for i in windows[t] if i is not None) for t in same] for same in texts], bits))
    return out


def hits(texts: pa.Array, known: list[Windows]) -> tuple[np.ndarray, list[list[tuple[int, int]]], list[set[str]]]:
    """For each text: how many words it has, its runs of hit words (first word, words), and the items with occurring windows.

    Hashes only find places; words are compared.
    """
    found = word_scan.scan(texts, WORD_BYTES)
    first = np.cumsum(found.sizes) - found.sizes
    change = np.zeros(len(found.start) + 1, np.int64)
    items: list[set[str]] = [set() for _ in range(len(texts))]
    for windows in known:
        keys = window_hashes(found.hashes[0], windows.size, FOR_KEY)
        places, which = windows.candidates(keys)
        inside = found.whole(windows.size)[places]
        for at, k in zip(places[inside].tolist(), which[inside].tolist()):
            text = found.joined(at, windows.size)
            if text in windows.texts[k]:
                change[at] += 1
                change[at + windows.size] -= 1
                items[found.text[at]].update(windows.items[k][windows.texts[k].index(text)])
    hit = np.cumsum(change)[:-1] > 0
    begins, ends = hit.copy(), hit.copy()
    if len(hit):
        same = found.text[1:] == found.text[:-1]
        begins[1:] &= ~(hit[:-1] & same)
        ends[:-1] &= ~(hit[1:] & same)
    spans: list[list[tuple[int, int]]] = [[] for _ in range(len(texts))]
    for a, z in zip(np.flatnonzero(begins).tolist(), np.flatnonzero(ends).tolist()):
        t = int(found.text[a])
        spans[t].append((a - int(first[t]), z - a + 1))
    return found.sizes, spans, items


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, n in sorted(spans):
        if out and start <= sum(out[-1]):
            out[-1] = (out[-1][0], max(sum(out[-1]), start + n) - out[-1][0])
        else:
            out.append((start, n))
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, most_bytes: int = MOST_BYTES) -> DataFrame:
    """docs with n_words, n_hit, spans (runs of hit words: first word, words) and items (ids, sorted as strings).

    A window is `size` consecutive words of an item (item_id, text), or all words of an item with fewer; a word inside any
    occurrence of a window is hit. The set of windows is broadcast: the bytes of all items are summed up first, and beyond
    most_bytes items are dealt to parts of about that size by a hash, which are scanned for one after the other, with what was
    found before carried along in a written table. So no broadcast grows with the data, but for a single larger item.

    Null and empty texts and texts without words have no words and no hits; an item without words has no windows; windows of an item
    without id are hits, but name no item. Items with one id count as one. Very long texts are scanned whole. Rows are judged
    alone, so repeated rows and ids, and rows without doc_id, each give their own result. Columns of docs may have any names but those five
    here, which are replaced; an empty table gives no rows, an empty benchmark no hits.
    """
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    n_bytes = items.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    n_parts = 1 if n_bytes <= most_bytes else -(-2 * n_bytes // most_bytes)
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(n_parts))
    columns = [c for c in docs.columns if c not in ("n_words", "n_hit", "spans", "items")]
    found = docs.select(*columns, F.lit(0).cast("long").alias("n_words"), F.lit(None).cast(SPANS).alias("spans"), F.lit(None).cast("array<string>").alias("items"))
    for k in range(n_parts):
        held = [(r.item_id, r.text) for r in items.where(part == k).toLocalIterator()]
        found = _scanned(found if k == 0 else written(found, "contamination"), docs.sparkSession.sparkContext.broadcast(index(held, size)))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["n_words"])
    return found.select(*columns, "n_words", n_hit.alias("n_hit"), "spans", "items")


def _scanned(docs: DataFrame, known) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in word_scan.slices(batch, "text"):
                sizes, spans, items = hits(rows["text"], known.value)
                for k, (s, i) in enumerate(zip(rows["spans"].to_pylist(), rows["items"].to_pylist())):
                    if s:
                        spans[k] = _merged([(x["start"], x["n_words"]) for x in s] + spans[k])
                        items[k] |= set(i)
                new = {
                    "n_words": pa.array(sizes, pa.int64()),
                    "spans": pa.array([[{"start": a, "n_words": n} for a, n in s] for s in spans], pa.list_(pa.struct([("start", pa.int32()), ("n_words", pa.int32())]))),
                    "items": pa.array([sorted(i) for i in items], pa.list_(pa.string())),
                }
                yield pa.RecordBatch.from_arrays([new.get(c, rows[c]) for c in rows.schema.names], rows.schema.names)

    return docs.mapInArrow(run, docs.schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "spans", most_share: float = 0.0, size: int = WINDOW) -> DataFrame:
    """docs without what the benchmark has, in the columns of docs.

    remove="documents" leaves out every document of whose words more than most_share are hit. remove="spans" cuts the hit words out,
    and what stands between them, from the first byte of a run's first word to the last of its last; what is left is joined as it
    stands, and n_chars follows where there is such a column. Documents without hits stay as they are, null texts too. The columns may have any names.
    """
    if remove not in ("spans", "documents"):
        raise ValueError(f"remove is spans or documents, not {remove}")
    found = contamination(boxed(docs).withColumn("text", F.col("row.text")), benchmark, size)
    if remove == "documents":
        return found.where(F.col("n_hit") <= F.col("n_words") * most_share).select("row.*")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in word_scan.slices(batch, "text"):
                out, places = rows["text"].to_pylist(), np.flatnonzero(pa.compute.list_value_length(rows["spans"]).to_numpy(zero_copy_only=False))
                for k in places.tolist():
                    found = word_scan.scan(rows["text"].slice(k, 1), WORD_BYTES)
                    raw, left, at = out[k].encode(), [], 0
                    for s in rows["spans"][k].as_py():
                        left.append(raw[at : found.start[s["start"]]])
                        at = int(found.end[s["start"] + s["n_words"] - 1])
                    out[k] = b"".join([*left, raw[at:]]).decode()
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()) if c == "text" else rows[c] for c in rows.schema.names], rows.schema.names)

    left = found.mapInArrow(cut, found.schema)
    row = with_field(docs, F.col("row"), "text", F.col("text"))
    if "n_chars" in docs.columns:
        row = with_field(docs, row, "n_chars", F.when(F.col("n_hit") > 0, F.char_length("text")).otherwise(F.col("row.n_chars")))
    return left.select(row.alias("row")).select("row.*")


def op11_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated")
    )


_WORDS = r"regexp_extract_all(" + LOWER_SQL.format(text="coalesce(text, '')") + r", '[^\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+')"
OP11_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS ws FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS ws FROM benchmark),
bw AS (SELECT DISTINCT item_id, size, array_to_string(ws[i : i + size - 1], ' ') AS s FROM
  (SELECT item_id, ws, least({WINDOW}, len(ws)) AS size, unnest(range(1, len(ws) - least({WINDOW}, len(ws)) + 2)) AS i FROM b WHERE len(ws) > 0) t),
dw AS (SELECT r, size, i, array_to_string(ws[i : i + size - 1], ' ') AS s FROM
  (SELECT r, ws, size, unnest(range(1, len(ws) - size + 2)) AS i FROM d, (SELECT DISTINCT size FROM bw) z WHERE len(ws) >= size) t),
found AS (SELECT r, i, size, item_id FROM dw JOIN bw USING (size, s)),
covered AS (SELECT r, count(DISTINCT i + k) AS n_hit FROM (SELECT r, i, unnest(range(0, size)) AS k FROM found) t GROUP BY 1),
items AS (SELECT r, count(DISTINCT item_id) AS n_items, array_to_string(list_sort(list(DISTINCT item_id) FILTER (WHERE item_id IS NOT NULL)), ',') AS ids FROM found GROUP BY 1)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN items USING (r)"""
