"""Substring deduplication by relative Lempel-Ziv parsing against all blocks of reference documents."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.llm import blocks
from meterline.llm.tables import WORDS_SQL, read

WINDOW = 13
FACTORS = pa.list_(pa.struct([("start", pa.int32()), ("n_words", pa.int32()), ("block", pa.int64())]))
REQUESTS = "block long, bucket long, at binary, to binary, n binary"
PASSAGES = "to long, of long, payload binary"


class _Block:
    """A block's words, and the keys of their windows."""

    def __init__(self, payloads: pa.ChunkedArray, lay: blocks.Layout, size: int):
        self.table = blocks.opened(payloads)
        self.words = [text.split() for text in blocks.raw_texts(self.table["text"])]
        self.n_words = np.array([len(w) for w in self.words], np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.n_words)])
        ids = self.table["doc_id"]
        self.has_id = ids.is_valid().to_numpy()
        self.ids = ids.fill_null(0).to_numpy()
        self.doc = np.repeat(np.arange(len(self.words)), self.n_words)
        self.hashes = np.concatenate([np.zeros(0, np.uint64), *map(blocks.word_hashes, self.words)])
        keys = blocks.window_hashes(self.hashes, size, blocks.FOR_KEY)
        whole = (self.doc[: len(keys)] == self.doc[size - 1 :]) & self.has_id[self.doc[: len(keys)]]
        self.at = np.flatnonzero(whole)
        self.keys = keys[self.at]
        self.bucket = (blocks.window_hashes(self.hashes, size, blocks.FOR_BUCKET)[self.at] % np.uint64(lay.n_buckets)).astype(np.int64)

    def by_bucket(self, lay: blocks.Layout) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Each bucket with its distinct keys in order, and the place of the first window with each."""
        for b, x in blocks.by_bucket(self.bucket, lay.n_buckets):
            keys, first = np.unique(self.keys[x], return_index=True)
            yield b, keys, self.at[x[first]]


class _Reference:
    """Words that a document may be copied from, and the place of one window for each key."""

    def __init__(self, words: list[bytes], hashes: np.ndarray, ends: np.ndarray, blocks_: np.ndarray, keys: np.ndarray, places: np.ndarray):
        self.words, self.hashes, self.ends, self.blocks = words, hashes, ends, blocks_
        self.keys, first = np.unique(keys, return_index=True)
        self.places = places[first]

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of a window with each key, or -1."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.places[at], -1)


def _equal_words(a: list[bytes], i: int, b: list[bytes], j: int, n: int) -> int:
    """How many of n words from a[i] and b[j] on are the same."""
    if a[i : i + n] == b[j : j + n]:
        return n
    return next(k for k in range(n) if a[i + k] != b[j + k])


def _longest(hashes: np.ndarray, words: list[bytes], i: int, end: int, ref: _Reference, j: int) -> int:
    """Length of the match between the words from i on and the reference from j on; words themselves are compared."""
    n, known, step = int(min(end - i, ref.ends[j] - j)), 0, 64
    while known < n:
        part = min(step, n - known)
        differ = hashes[i + known : i + known + part] != ref.hashes[j + known : j + known + part]
        if differ.any():
            known += int(differ.argmax())
            break
        known += part
        step *= 4
    return _equal_words(words, i, ref.words, j, known)


def _factors(block: _Block, words: list[bytes], size: int, found: list[tuple[_Reference, np.ndarray]]) -> list[tuple[int, int, int]]:
    """The parse of all documents of a block: (first word, words, reference block) of each factor of at least size words.

    found has, by reference, a place for each window of the block, or -1. The parse goes from left to right: at a window that a reference has, the
    longest match with any of them is a factor, and the parse goes on at its end. A match that begins inside a
    factor and ends behind it has its windows over that end looked at as well; the rest of it begins the next factor.
    """
    hit = np.flatnonzero(np.logical_or.reduce([places >= 0 for _, places in found]))
    at = block.at[hit].tolist()
    ends = block.start[block.doc[block.at[hit]] + 1].tolist()
    sources = [(ref, places[hit].tolist()) for ref, places in found]
    out, k = [], 0
    while k < len(at):
        begin, longest, source = at[k], 0, -1
        for ref, places in sources:
            if places[k] >= 0:
                n = _longest(block.hashes, words, begin, ends[k], ref, places[k])
                if n > longest:
                    longest, source = n, int(ref.blocks[places[k]])
        if longest < size:
            k += 1
            continue
        end = begin + longest
        out.append((begin, longest, source))
        last = bisect_left(at, end, k)
        for w in range(bisect_left(at, end - size + 1, k + 1), last):
            for ref, places in sources:
                if places[w] >= 0 and at[w] + size <= ends[w] and ends[w] == ends[k] and words[at[w] : at[w] + size] == ref.words[places[w] : places[w] + size]:
                    out.append((at[w], size, int(ref.blocks[places[w]])))
                    break
        k = last
    return out


def substring_dedup(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """Per row of docs: doc_id, n_words, n_removed, kept (the words left, joined by a space) and factors.

    Documents are cut into reference blocks by doc_id. Every block is indexed by its windows of `size` words; the
    index is spread over buckets, which tell for each window of a block the last block before it that has the window, too. That block
    sends the passages that hold such windows, words and all, so each passage goes from a block to one later block at most, however many hold it.
    A document is then parsed greedily against all passages and the documents before it in its own block: see
    _factors. Factors of at least `size` words are duplicate spans; their words are removed. Hashes only
    find places; words are compared, so nothing is removed by a collision.

    Null texts and texts without words give no words; shorter texts than a window keep all. Very long texts are parsed whole. Rows with one doc_id
    are not earlier than each other. A row without doc_id is neither a reference nor parsed. Other columns are
    ignored; an empty table gives no rows.
    """
    docs = docs.select("doc_id", "text")
    lay = blocks.layout(docs)
    packed = blocks.chunks(docs, lay)

    def index(table: pa.Table) -> pa.Table:
        block = _Block(table["payload"], lay, size)
        rows = [(b, keys.tobytes()) for b, keys, _ in block.by_bucket(lay)]
        return pa.table({"bucket": pa.array([b for b, _ in rows], pa.int64()), "of": pa.array([table["block"][0].as_py()] * len(rows), pa.int64()), "keys": pa.array([k for _, k in rows], pa.binary())})

    def look_up(table: pa.Table) -> pa.Table:
        table = table.sort_by("of")
        parts = [np.frombuffer(k.as_buffer(), np.uint64) for k in table["keys"]]
        of = table["of"].to_numpy()
        sizes = np.array([len(p) for p in parts])
        keys, part = np.concatenate(parts), np.repeat(np.arange(len(parts)), sizes)
        order = np.argsort(keys, kind="stable")
        again = np.flatnonzero(np.diff(keys[order]) == 0)
        before, after = order[again], order[again + 1]  # one window in two blocks, with none between
        by = np.lexsort((before, part[after], part[before]))
        before, after = before[by], after[by]
        rows = []
        begin = np.cumsum(sizes) - sizes
        for x in np.split(np.arange(len(before)), np.flatnonzero(np.diff(part[before])) + 1):
            if len(x):
                source = part[before[x[0]]]
                to, n = np.unique(of[part[after[x]]], return_counts=True)
                at = before[x] - begin[source]
                at = at.astype(np.uint16) if sizes[source] <= 1 << 16 else at.astype(np.uint32)
                rows.append((int(of[source]), table["bucket"][0].as_py(), at.tobytes(), to.tobytes(), n.astype(np.int32).tobytes()))
        columns = list(zip(*rows)) or [[]] * 5
        return pa.table([pa.array(c, pa.int64() if k < 2 else pa.binary()) for k, c in enumerate(columns)], names=[c.split()[0] for c in REQUESTS.split(", ")])

    def serve(left: pa.Table, right: pa.Table) -> pa.Table:
        rows: list[tuple[int, int, bytes]] = []
        if len(left) and len(right):
            own = left["block"][0].as_py()
            block = _Block(left["payload"], lay, size)
            asked = {b: (at, to, n) for b, at, to, n in zip(*(right[c].to_pylist() for c in ("bucket", "at", "to", "n")))}
            wanted: list[tuple[np.ndarray, np.ndarray]] = []
            for b, keys, first in block.by_bucket(lay):
                if b in asked:
                    at, to, n = asked[b]
                    at = np.frombuffer(at, np.uint16 if len(keys) <= 1 << 16 else np.uint32)
                    wanted.append((np.repeat(np.frombuffer(to, np.int64), np.frombuffer(n, np.int32)), first[at]))
            to, place = (np.concatenate(x) for x in zip(*wanted))
            order = np.lexsort((place, to))
            to, place = to[order], place[order]
            new = np.concatenate([[True], (np.diff(to) != 0) | (np.diff(place) > size) | (np.diff(block.doc[place]) != 0)])
            begin = np.flatnonzero(new)
            last = np.concatenate([begin[1:], [len(to)]]) - 1
            texts = []
            for a, z in zip(place[begin].tolist(), place[last].tolist()):
                d = int(block.doc[a])
                texts.append(b" ".join(block.words[d][a - int(block.start[d]) : z - int(block.start[d]) + size]))
            for x in np.split(np.arange(len(begin)), np.flatnonzero(np.diff(to[begin])) + 1):
                rows.append((int(to[begin[x[0]]]), own, blocks.packed(pa.table({"text": pa.array(texts[x[0] : x[-1] + 1], pa.large_binary())}))))
        columns = list(zip(*rows)) or [[]] * 3
        return pa.table([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.binary())], names=["to", "of", "payload"])

    def parse(left: pa.Table, right: pa.Table) -> pa.Table:
        own = left["block"][0].as_py()
        block = _Block(left["payload"], lay, size)
        words = list(chain.from_iterable(block.words))
        # other blocks' passages
        passages = [(of, text.as_py().split()) for of, payload in zip(right["of"].to_pylist(), right["payload"]) for text in pa.ipc.open_stream(payload.as_buffer()).read_all()["text"]]
        sizes = np.array([len(p) for _, p in passages], np.int64)
        theirs = list(chain.from_iterable(p for _, p in passages))
        hashes = blocks.word_hashes(theirs)
        passage = np.repeat(np.arange(len(passages)), sizes)
        keys = blocks.window_hashes(hashes, size, blocks.FOR_KEY)
        whole = np.flatnonzero(passage[: len(keys)] == passage[size - 1 :]) if len(keys) else np.zeros(0, np.int64)
        others = _Reference(theirs, hashes, np.cumsum(sizes)[passage], np.array([of for of, _ in passages], np.int64)[passage], keys[whole], whole)
        here = _Reference(words, block.hashes, block.start[block.doc + 1], np.full(len(words), own), block.keys, block.at)
        place = here.find(block.keys)
        earlier = (place >= 0) & (block.ids[block.doc[np.maximum(place, 0)]] < block.ids[block.doc[block.at]]) if len(place) else np.zeros(0, bool)
        factors = _factors(block, words, size, [(others, others.find(block.keys)), (here, np.where(earlier, place, -1))])
        begin, n, source = (np.array(c, np.int64) for c in (zip(*factors) if factors else ([], [], [])))
        change = np.zeros(len(words) + 1, np.int64)
        np.add.at(change, begin, 1)
        np.add.at(change, begin + n, -1)
        gone = np.cumsum(change)[: len(words)] > 0
        factor_doc = block.doc[begin]
        spans = pa.StructArray.from_arrays([pa.array(begin - block.start[factor_doc], pa.int32()), pa.array(n, pa.int32()), pa.array(source, pa.int64())], fields=list(FACTORS.value_type))
        offsets = np.searchsorted(factor_doc, np.arange(len(block.words) + 1)).astype(np.int32)
        removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[block.start])
        kept = []
        for k, own_words in enumerate(block.words):
            if removed[k]:
                own_words = [w for w, x in zip(own_words, gone[block.start[k] : block.start[k + 1]]) if not x]
            kept.append(b" ".join(own_words))
        return pa.table(
            {
                "doc_id": block.table["doc_id"], "n_words": pa.array(block.n_words), "n_removed": pa.array(removed, pa.int64()),
                "kept": pa.array(kept, pa.binary()).cast(pa.string()), "factors": pa.ListArray.from_arrays(pa.array(offsets), spans),
            }
        )

    asked = packed.groupBy("block").applyInArrow(index, "bucket long, of long, keys binary").groupBy("bucket").applyInArrow(look_up, REQUESTS)
    passages = packed.groupBy("block").cogroup(asked.groupBy("block")).applyInArrow(serve, PASSAGES)
    return packed.groupBy("block").cogroup(passages.groupBy("to")).applyInArrow(
        parse, "doc_id long, n_words long, n_removed long, kept string, factors array<struct<start:int,n_words:int,block:bigint>>"
    )


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP2_SQL = f"""
WITH d AS (SELECT doc_id, {WORDS_SQL.format(text="text")} AS ws FROM documents),
windows AS (SELECT doc_id, i, array_to_string(ws[i : i + {WINDOW - 1}], ' ') AS s FROM (SELECT *, unnest(range(1, len(ws) - {WINDOW - 2})) AS i FROM d) t),
first AS (SELECT s, min(doc_id) AS first_id FROM windows GROUP BY 1),
gone AS (SELECT DISTINCT doc_id, i + k AS i FROM windows JOIN first USING (s), range(0, {WINDOW}) r(k) WHERE first_id < doc_id),
words AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM d),
kept AS (SELECT doc_id, count(g.at) AS n_removed, string_agg(w, ' ' ORDER BY words.i) FILTER (WHERE g.at IS NULL) AS text
  FROM words LEFT JOIN (SELECT doc_id AS of, i AS at FROM gone) g ON g.of = doc_id AND g.at = words.i GROUP BY 1)
SELECT doc_id, len(ws) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)"""
