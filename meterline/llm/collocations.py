"""Phrase collocations: suffix automata of shards count short phrases, buckets add the counts up, suffix links tell what lies in what.

A shard is a share of the texts by hash; its automaton holds every phrase of up to three words with its number of end
places. Counts travel as keys of 64 bits to buckets, which a second, independent hash picks: two phrases are only taken for one
if both agree. Buckets keep what is frequent over all shards, and ask one of the shards that hold it for its words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meterline.llm import words as word_scan
from meterline.llm.blocks import FOR_BUCKET, FOR_KEY, mixed, window_hashes
from meterline.llm.tables import LOWER_SQL, read, written

LONGEST = 3
LEAST = 10
#: A candidate goes if a longer one has so many percent of its occurrences.
SUBSUMED_PERCENT = 50
TOP = 2000
UNKNOWN = "und"
#: Text of a shard and keys of a bucket, in bytes; texts above CUT_BYTES are cut into pieces first.
SHARD_BYTES, BUCKET_BYTES, CUT_BYTES = 6 << 20, 8 << 20, 1 << 20
#: Messages of a shard at most. More buckets are reached in two steps.
FAN_OUT = 1024
BREAKS = np.isin(np.arange(256), np.frombuffer(b".,;:!?\n\x0b\x0c\r", np.uint8))
WORD_BYTES = ~(BREAKS | np.isin(np.arange(256), [0x20, 0x09]))
BREAK = r"[.,;:!?\x0A-\x0D]"

MESSAGE = "to long, shard long, buckets binary, sizes binary, keys binary, counts binary"
REPLY = "to long, bucket long, key long, total long"
FREQUENT = "lang string, size int, phrase string, prefix string, suffix string, first string, last string, total long"


class Automaton:
    """The suffix automaton of runs of words, for substrings of up to LONGEST words: a state is a class of substrings that end at the same places.

    ids and group name the word and the run at each place. Windows read backwards from each place and sorted bring all ends of
    a substring together as a range; it shares its state with a longer one that has as many ends. Of a state we know one end place,
    how many there are, the lengths of its shortest and longest substring, and its link: the state of the longest
    suffix that has more ends (-1: the empty one). Each substring of a state is a pair of state and length.
    """

    def __init__(self, ids: np.ndarray, group: np.ndarray):
        n = len(ids)
        back = [ids.astype(np.uint64) + np.uint64(1)]
        for k in range(1, LONGEST):
            earlier = np.zeros(n, np.uint64)
            m = max(0, n - k)
            earlier[n - m :] = np.where(group[n - m :] == group[:m], back[0][:m], np.uint64(0))  # 0: the run has not begun
            back.append(earlier)
        if int(ids.max(initial=0)) + 2 < 1 << 21:
            order = np.argsort(back[0] << np.uint64(42) | back[1] << np.uint64(21) | back[2])
        else:
            order = np.lexsort(back[::-1])
        new = np.zeros(n, bool)
        new[:1] = True
        begins, node_of_run, n_nodes = np.zeros(1, np.int64), np.full(1, -1), 0
        starts, counts, parents, lengths = [], [], [], []
        for depth in range(1, LONGEST + 1):
            level = back[depth - 1][order]
            new[1:] |= level[1:] != level[:-1]
            begin = np.flatnonzero(new)
            there = level[begin] > 0
            starts.append(begin[there])
            counts.append(np.diff(np.append(begin, n))[there])
            parents.append(node_of_run[np.searchsorted(begins, begin[there], side="right") - 1])
            lengths.append(np.full(int(there.sum()), depth))
            begins, node_of_run = begin, np.where(there, n_nodes + np.cumsum(there) - 1, -1)
            n_nodes += len(starts[-1])
        start, count, parent, self.length = (np.concatenate(x) for x in (starts, counts, parents, lengths))
        same = (parent >= 0) & (count == count[parent]) if n_nodes else np.zeros(0, bool)
        top = np.arange(n_nodes)
        for _ in range(LONGEST - 1):
            top = np.where(same[top], parent[top], top)
        first = np.flatnonzero(~same)  # the shortest substring of each state
        self.state = np.searchsorted(first, top)
        self.end, self.count, self.shortest = order[start[first]], count[first], self.length[first]
        self.longest = self.shortest.copy()
        np.maximum.at(self.longest, self.state, self.length)
        self.link = np.where(parent[first] >= 0, self.state[parent[first]], -1) if n_nodes else np.zeros(0, np.int64)

    def places(self) -> np.ndarray:
        """Where one occurrence of each substring begins."""
        return self.end[self.state] - self.length + 1

    def suffix(self, k: int) -> tuple[int, int]:
        """State and length of the suffix that is one word shorter than the k-th substring: its own state, or the linked one."""
        state, length = int(self.state[k]), int(self.length[k]) - 1
        return (state if length >= self.shortest[state] else int(self.link[state])), length


class Shard:
    """Texts of a shard (lang, text) with their automaton, one over all languages, and key and bucket of each substring."""

    def __init__(self, table: pa.Table, n_buckets: int):
        table = table.combine_chunks()
        column = table["text"].combine_chunks() if isinstance(table["text"], pa.ChunkedArray) else table["text"]
        self.words = word_scan.scan(column, WORD_BYTES, n_hashes=2)
        langs = table["lang"].combine_chunks().dictionary_encode()
        self.langs, of_row = langs.dictionary.to_pylist(), langs.indices.to_numpy()
        self.lang = of_row[self.words.text]
        salt = np.array([xxhash.xxh3_64_intdigest((x or "").encode()) for x in self.langs], np.uint64)
        hashes = [mixed(h + salt[self.lang]) if len(salt) else h for h in self.words.hashes]
        breaks = np.flatnonzero(BREAKS[self.words.data])
        self.group = np.searchsorted(breaks, self.words.start) + self.words.text  # changes where the text or the piece does
        _, ids = np.unique(hashes[0], return_inverse=True)
        self.automaton = Automaton(ids, self.group)
        at, length = self.automaton.places(), self.automaton.length
        self.keys, self.bucket = np.zeros(len(at), np.uint64), np.zeros(len(at), np.int64)
        for size in range(1, LONGEST + 1):
            own = length == size
            self.keys[own] = window_hashes(hashes[0], size, FOR_KEY)[at[own]]
            self.bucket[own] = (window_hashes(hashes[1], size, FOR_BUCKET)[at[own]] % np.uint64(n_buckets)).astype(np.int64)


def _counts(values: np.ndarray) -> bytes:
    """Whole numbers in as few bytes each as the largest needs."""
    return values.astype(np.min_scalar_type(int(values.max(initial=0)))).tobytes()


def _numbers(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, f"u{len(raw) // n}").astype(np.int64) if n else np.zeros(0, np.int64)


def _posted(bucket: np.ndarray, keys: np.ndarray, counts: np.ndarray, shards: np.ndarray | int, per_message: int) -> pa.Table:
    """Messages with the keys and counts of some buckets each, in order of buckets; one message goes to bucket // per_message from one shard."""
    if np.ndim(shards):
        order = np.lexsort((bucket, shards, bucket // per_message))
    else:
        order = np.argsort(bucket.astype(np.uint16) if bucket.max(initial=0) < 1 << 16 else bucket, kind="stable")
    shards = np.broadcast_to(np.asarray(shards, np.int64), bucket.shape)
    bucket, keys, counts, shards = bucket[order], keys[order], counts[order], shards[order]
    rows = []
    cut = np.flatnonzero((np.diff(bucket // per_message) != 0) | (np.diff(shards) != 0)) + 1
    for x in np.split(np.arange(len(bucket)), cut):
        if len(x):
            own, sizes = np.unique(bucket[x], return_counts=True)
            rows.append((int(bucket[x[0]]) // per_message, int(shards[x[0]]), own.tobytes(), sizes.tobytes(), keys[x].tobytes(), _counts(counts[x])))
    columns = list(zip(*rows)) or [[]] * 6
    return pa.table([pa.array(c, pa.int64() if k < 2 else pa.binary()) for k, c in enumerate(columns)], names=[c.split()[0] for c in MESSAGE.split(", ")])


def _opened(batch: pa.RecordBatch | pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bucket, key, count and shard of everything in some messages."""
    out = []
    for shard, buckets, sizes, keys, counts in zip(*(batch[c].to_pylist() for c in ("shard", "buckets", "sizes", "keys", "counts"))):
        key = np.frombuffer(keys, np.uint64)
        out.append((np.repeat(np.frombuffer(buckets, np.int64), np.frombuffer(sizes, np.int64)), key, _numbers(counts, len(key)), np.full(len(key), shard)))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))


def _sharded(docs: DataFrame, n_shards: int) -> DataFrame:
    """(shard, lang, text): texts dealt by a hash; those above CUT_BYTES in the pieces that no phrase goes over."""
    text = F.coalesce(F.col("text"), F.lit(""))
    parts = F.when(F.octet_length(text) > CUT_BYTES, F.split(text, BREAK)).otherwise(F.array(text))
    rows = docs.select("doc_id", F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), F.posexplode(parts).alias("nth", "text"))
    return rows.select(F.pmod(F.xxhash64("doc_id", "nth", "text"), F.lit(n_shards)).alias("shard"), "lang", "text")


def frequent_phrases(docs: DataFrame, least: int = LEAST, shard_bytes: int = SHARD_BYTES, bucket_bytes: int = BUCKET_BYTES, fan_out: int = FAN_OUT) -> DataFrame:
    """Phrases of up to LONGEST words that occur at least so often in a language: FREQUENT, where prefix and suffix are the phrase without its last
    and first word (null for one word). Rows of size 0 hold how many words a shard has in a language.
    """
    n_bytes = docs.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    n_shards = max(16, -(-n_bytes // shard_bytes))
    n_buckets = max(16, -(-4 * n_bytes // bucket_bytes))  # about two keys of eight bytes for four to six bytes of text
    per_message = -(-n_buckets // fan_out)
    sharded = _sharded(docs, n_shards)

    def announce(table: pa.Table) -> pa.Table:
        shard = Shard(table, n_buckets)
        return _posted(shard.bucket, shard.keys, shard.automaton.count[shard.automaton.state], table["shard"][0].as_py(), per_message)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bucket, keys, counts, shards = _opened(batch)
            yield from _posted(bucket, keys, counts, shards, 1).to_batches()

    def meet(table: pa.Table) -> pa.Table:
        bucket, keys, counts, shards = _opened(table)
        order = np.argsort(keys, kind="stable")
        keys, shards = keys[order], shards[order]
        begin = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        totals = np.add.reduceat(counts[order], begin)
        n = np.diff(np.append(begin, len(keys)))
        often = totals >= least
        # one of the shards that hold a key, by the key itself, so that none is asked for all that is common
        asked = shards[begin[often] + (mixed(keys[begin[often]]) % n[often].astype(np.uint64)).astype(np.int64)]
        return pa.table({"to": asked, "bucket": np.full(len(asked), bucket[0]), "key": keys[begin[often]].view(np.int64), "total": totals[often]})

    def resolve(left: pa.Table, right: pa.Table) -> pa.Table:
        rows: list[tuple] = []
        if len(left):
            shard = Shard(left, n_buckets)
            for k, n in enumerate(np.bincount(shard.lang, minlength=len(shard.langs)).tolist()):
                rows.append((shard.langs[k], 0, "", None, None, None, None, n))
            wanted, totals = right["key"].to_numpy().view(np.uint64), right["total"].to_numpy()
            order = np.argsort(wanted)
            wanted, totals, buckets = wanted[order], totals[order], right["bucket"].to_numpy()[order]
            bits = np.zeros(1 << 20, bool)
            bits[wanted >> np.uint64(44)] = True
            some = np.flatnonzero(bits[shard.keys >> np.uint64(44)])
            if len(wanted):
                at = np.minimum(np.searchsorted(wanted, shard.keys[some]), len(wanted) - 1)
                found = (wanted[at] == shard.keys[some]) & (buckets[at] == shard.bucket[some])
                begins, a = shard.automaton.places(), shard.automaton
                for k, total in zip(some[found].tolist(), totals[at[found]].tolist()):
                    begin, size = int(begins[k]), int(a.length[k])
                    phrase = shard.words.joined(begin, size).decode()
                    parts = [None] * 4
                    if size > 1:
                        state, length = a.suffix(k)
                        suffix = shard.words.joined(int(a.end[state]) - length + 1, length).decode()
                        parts = [phrase[: phrase.rindex(" ")], suffix, phrase[: phrase.index(" ")], phrase[phrase.rindex(" ") + 1 :]]
                    rows.append((shard.langs[shard.lang[begin]], size, phrase, *parts, total))
        columns = list(zip(*rows)) or [[]] * 8
        kinds = [pa.string(), pa.int32(), *[pa.string()] * 5, pa.int64()]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=[c.split()[0] for c in FREQUENT.split(", ")])

    told = sharded.groupBy("shard").applyInArrow(announce, MESSAGE)
    if per_message > 1:
        told = told.repartition("to").mapInArrow(spread, MESSAGE)
    asked = told.groupBy("to").applyInArrow(meet, REPLY)
    return sharded.groupBy("shard").cogroup(asked.groupBy("to")).applyInArrow(resolve, FREQUENT)


def collocations(docs: DataFrame, least: int = LEAST, subsumed_percent: int = SUBSUMED_PERCENT, top: int | None = TOP, **sizes: int) -> DataFrame:
    """By language (null: UNKNOWN) the phrases of two and three words that occur `least` times or more and stick together: lang, rank, phrase, a, l, r, n, score.

    score is the whole part of 1000000 a a / (l r) for the cut of the phrase for which that is lowest; a, l and r are the occurrences of
    the phrase and both parts, n those of all words. A phrase that lies in a longer one with at least subsumed_percent of its occurrences
    goes. The first `top` of each language by score, a and phrase are returned, all if None. Products are decimals of
    38 digits: right up to 10^16 occurrences.

    Phrases don't go over BREAK, nor over two texts. A-Z count in lower case. A null or empty text, or one of breaks alone, has no words; a language without
    phrases has no rows. Repeated rows count each, rows without doc_id too. A very long text is dealt to shards in its pieces; only a single
    piece is held whole. Other columns are ignored; an empty table gives no rows.
    """
    table = written(frequent_phrases(docs.select("doc_id", "lang", "text"), least, **sizes), "phrases")
    known = table.where("size > 0").select("lang", "phrase", "total")
    found = table.where("size > 1")
    longer = found.where(F.col("size") == LONGEST)
    covers = longer.select("lang", F.explode(F.array("prefix", "suffix")).alias("phrase"), "total").groupBy("lang", "phrase").agg(F.max("total").alias("_longer"))
    # cuts after the first and before the last word: one for two words
    cuts = F.array(F.struct(F.lit(1).alias("k"), F.col("first").alias("left"), F.col("suffix").alias("right")), F.struct((F.col("size") - 1).alias("k"), F.col("prefix").alias("left"), F.col("last").alias("right")))
    kept = found.join(covers, ["lang", "phrase"], "left").where(F.coalesce(100 * F.col("_longer") < subsumed_percent * F.col("total"), F.lit(True)))
    parts = kept.select("lang", "phrase", F.col("total").alias("a"), F.inline(F.array_distinct(cuts)))
    parts = parts.join(known.toDF("lang", "left", "l"), ["lang", "left"]).join(known.toDF("lang", "right", "r"), ["lang", "right"])
    score = F.expr("(CAST(1000000 AS DECIMAL(38, 0)) * a * a) DIV (CAST(l AS DECIMAL(38, 0)) * r)")
    scored = parts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("_cut")).select("lang", "phrase", "a", "_cut.l", "_cut.r", "_cut.score")
    order = [F.col("score").desc(), F.col("a").desc(), "phrase"]
    if top is not None:  # a language is cut down in parts before it comes to one task
        salted = W.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*order)
        scored = scored.withColumn("_n", F.row_number().over(salted)).where(F.col("_n") <= top).drop("_n")
    ranked = scored.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long"))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    n = table.where("size = 0").groupBy("lang").agg(F.sum("total").alias("n"))
    return ranked.join(n, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read(spark, sf_dir, "documents"))


OP12_SQL = rf"""
WITH pieces AS (SELECT coalesce(lang, '{UNKNOWN}') AS lang, unnest(regexp_split_to_array({LOWER_SQL.format(text="text")}, '[.,;:!?\n\x0b\f\r]+')) AS p FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(p, '[ \t]+'), lambda x: x <> '') AS ws FROM pieces),
grams AS (SELECT lang, size, array_to_string(ws[i : i + size - 1], ' ') AS phrase FROM
  (SELECT lang, ws, size, unnest(range(1, len(ws) - size + 2)) AS i FROM w, range(1, {LONGEST + 1}) z(size) WHERE len(ws) >= size) t),
f AS (SELECT lang, size, phrase, CAST(count(*) AS HUGEINT) AS a FROM grams GROUP BY 1, 2, 3),
c AS (SELECT *, string_split(phrase, ' ') AS ws FROM f WHERE size > 1 AND a >= {LEAST}),
cut AS (SELECT lang, phrase, size, a, k, array_to_string(ws[1 : k], ' ') AS lp, array_to_string(ws[k + 1 : size], ' ') AS rp FROM c, range(1, {LONGEST}) z(k) WHERE k < size),
scored AS (SELECT cut.lang, cut.phrase, cut.size, cut.a, k, l.a AS l, r.a AS r, 1000000 * cut.a * cut.a // (l.a * r.a) AS score
  FROM cut JOIN f l ON l.lang = cut.lang AND l.phrase = lp JOIN f r ON r.lang = cut.lang AND r.phrase = rp),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
y AS (SELECT lang, a, array_to_string(ws[i : i + part - 1], ' ') AS phrase FROM c, range(2, {LONGEST}) p(part), range(1, {LONGEST}) r(i) WHERE part < size AND i + part - 1 <= size),
inside AS (SELECT DISTINCT x.lang, x.phrase FROM c x JOIN y ON x.lang = y.lang AND x.phrase = y.phrase AND 100 * y.a >= {SUBSUMED_PERCENT} * x.a),
n AS (SELECT lang, sum(a) AS n FROM f WHERE size = 1 GROUP BY 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best ANTI JOIN inside USING (lang, phrase))
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN n USING (lang) WHERE rank <= {TOP}"""
