"""A causal self-attention model of subword ids, trained in numpy over all blocks, mixed with word counts.

The next id is drawn in two steps. First one of HEADS outcomes: the most frequent ids each have one, all other ids
that begin a word share one, all others another; then, for the shared ones, an id by its share of the ids there.
Logits of outcomes are log bigram counts given the id before, plus what one layer of causal attention over the
last ids adds. Counts cover the whole training text, and attention is trained on every window of it. Outcomes are drawn by the layer
alone; inside a shared one an id has its share after the very id before it, from counts of all pairs of ids, which meet in hash
buckets, drawn to its share of all ids there. A word's probability is half that of its ids and half its smoothed share of all words.

Texts are encoded once; blocks hold their ids. A word is known by its ids, as no two words have the same ones.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.llm import blocks, subwords
from meterline.llm.ngram_join import message, messages, numbers
from meterline.llm.tables import read, written

MESSAGE = "kind int, to long, of long, x binary, y binary"
WORDS, IDS, COUNTS, TOTALS, PAIRS, BIGRAMS = range(6)
#: Outcomes of the first step, and ids known as what came before. The last two outcomes are shared.
HEADS, BEFORE = 64, 1024
#: The part of the subword model in a word.
PART = 0.5
#: How many pairs an id's share of its outcome weighs as, beside the counted pairs with the same id before.
PAIR_PRIOR = 20.0
WIDTH, STRIDE, CONTEXT = 16, 16, 8
END_ID = 50256
VOCABULARY = 50257
#: Sums of arrays go through so many rows on their way to the driver.
FAN_IN = 32


def held_out(doc_id: int | None) -> bool:
    """crc32 of the id as text mod 10 is 0; a row without id is held out."""
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 10 == 0


@dataclass
class Ids:
    """What is fixed before training: outcomes and inputs of ids, and log10 shares inside shared outcomes."""

    outcome: np.ndarray
    input: np.ndarray
    share: np.ndarray


@dataclass
class Model:
    weights: dict[str, np.ndarray]
    bias: np.ndarray
    n_windows: int = 0


def ids_from_counts(counts: np.ndarray, begins: np.ndarray) -> Ids:
    order = np.argsort(-counts, kind="stable")
    order = np.concatenate([[END_ID], order[order != END_ID]])
    outcome = np.where(begins, HEADS - 2, HEADS - 1)
    outcome[order[: HEADS - 2]] = np.arange(HEADS - 2)
    inputs = np.full(len(counts), BEFORE - 1)
    inputs[order[: BEFORE - 2]] = np.arange(1, BEFORE - 1)  # 0 stands before the first id
    share = np.ones(len(counts))
    for shared in (HEADS - 2, HEADS - 1):
        own = outcome == shared
        share[own] = (counts[own] + 0.1) / (counts[own] + 0.1).sum()
    return Ids(outcome.astype(np.uint8), inputs.astype(np.uint16), np.log10(share).astype(np.float32))


def begin_weights() -> dict[str, np.ndarray]:
    rng = np.random.default_rng(17)
    small = lambda *shape: (rng.normal(size=shape) * 0.3).astype(np.float32)
    return {"e": small(BEFORE, WIDTH), "p": small(CONTEXT + STRIDE, WIDTH), "q": small(WIDTH, WIDTH), "k": small(WIDTH, WIDTH), "v": small(WIDTH, WIDTH), "u": np.zeros((2 * WIDTH, HEADS), np.float32)}


def bigram_logits(pairs: np.ndarray) -> np.ndarray:
    """Log shares of outcomes given the id before, each row drawn to the shares of all."""
    all_ = pairs.sum(axis=0) + 0.5
    smooth = pairs + 20.0 * all_ / all_.sum()
    return np.log(smooth / smooth.sum(axis=1, keepdims=True)).astype(np.float32)


MASK = np.where(np.arange(CONTEXT + STRIDE)[None] <= np.arange(CONTEXT, CONTEXT + STRIDE)[:, None], 0, -1e9).astype(np.float32)


def forward(w: dict[str, np.ndarray], bias: np.ndarray, x: np.ndarray, pad: np.ndarray) -> dict[str, np.ndarray]:
    """x: inputs of windows, CONTEXT old places and STRIDE to score; pad: 0, or a large negative number at places before the text."""
    n = len(x)
    a = w["e"].take(x, axis=0)
    a += w["p"]
    h = np.empty((n, STRIDE, 2 * WIDTH), a.dtype)
    h[..., :WIDTH] = a[:, CONTEXT:]
    kv = (a.reshape(-1, WIDTH) @ np.hstack([w["k"], w["v"]])).reshape(n, -1, 2 * WIDTH)
    k, v = kv[..., :WIDTH], kv[..., WIDTH:]
    q = (h.reshape(-1, 2 * WIDTH)[:, :WIDTH] @ w["q"] / a.dtype.type(WIDTH**0.5)).reshape(n, STRIDE, WIDTH)
    s = q @ np.ascontiguousarray(k.transpose(0, 2, 1))
    s += MASK
    s += pad[:, None]
    np.exp(np.minimum(s, 60, out=s), out=s)
    s /= (s @ np.ones(s.shape[2], s.dtype))[..., None]
    h[..., WIDTH:] = s @ v
    z = (h.reshape(-1, 2 * WIDTH) @ w["u"]).reshape(n, STRIDE, -1)
    z += bias.take(x[:, CONTEXT:], axis=0)
    np.exp(np.clip(z, -60, 60, out=z), out=z)
    return {"a": a, "q": q, "k": k, "v": v, "s": s, "h": h, "z": z, "total": z @ np.ones(z.shape[2], z.dtype)}


def step(w: dict[str, np.ndarray], bias: np.ndarray, x: np.ndarray, pad: np.ndarray, y: np.ndarray, use: np.ndarray, squares: dict[str, np.ndarray], rate: float) -> None:
    """One step of Adagrad on windows: the gradient of the mean loss over the places in use."""
    f = forward(w, bias, x, pad)
    kind, n = f["a"].dtype.type, len(x)
    part = use.ravel() / kind(max(1, int(use.sum())))
    z = f["z"].reshape(n * STRIDE, -1)
    z *= (part / f["total"].ravel())[:, None]
    z[np.arange(len(z)), y.ravel()] -= part
    h, s, a = f["h"].reshape(-1, 2 * WIDTH), f["s"], f["a"].reshape(-1, WIDTH)
    g = {"u": h.T @ z}
    dh = (z @ w["u"].T).reshape(n, STRIDE, -1)
    seen = np.ascontiguousarray(dh[..., WIDTH:])
    dkv = np.empty((n, CONTEXT + STRIDE, 2 * WIDTH), kind)
    dkv[..., WIDTH:] = s.transpose(0, 2, 1) @ seen
    ds = seen @ np.ascontiguousarray(f["v"].transpose(0, 2, 1))
    ds *= s
    ds -= s * (ds @ np.ones(ds.shape[2], kind))[..., None]
    dq = (ds @ f["k"]).reshape(-1, WIDTH) / kind(WIDTH**0.5)
    dkv[..., :WIDTH] = ds.transpose(0, 2, 1) @ f["q"]
    dkv = dkv.reshape(-1, 2 * WIDTH)
    g["q"] = h[:, :WIDTH].T @ dq
    g["k"], g["v"] = np.split(a.T @ dkv, 2, axis=1)
    da = (dkv @ np.hstack([w["k"], w["v"]]).T).reshape(n, -1, WIDTH)
    da[:, CONTEXT:] += (dq @ w["q"].T).reshape(n, STRIDE, -1)
    da[:, CONTEXT:] += dh[..., :WIDTH]
    g["p"] = da.sum(axis=0)
    place = (x.ravel().astype(np.int64)[:, None] * WIDTH + np.arange(WIDTH)).ravel()
    g["e"] = np.bincount(place, da.ravel(), w["e"].size).reshape(w["e"].shape).astype(kind)
    for name, grad in g.items():
        squares[name] += grad * grad
        w[name] -= rate * grad / np.sqrt(squares[name] + 1e-8)


def windows(ids: np.ndarray, sizes: np.ndarray, known: Ids) -> tuple[np.ndarray, ...]:
    """Windows over texts in a row: inputs, pads, outcomes, ids, whether a place counts, and the text of each window.

    A window scores STRIDE ids and sees CONTEXT places before them; the next one begins where it ends, so each
    id is scored once. An id's input is the id before it.
    """
    n_windows = -(-sizes // STRIDE)
    text = np.repeat(np.arange(len(sizes)), n_windows)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
    begin = (np.cumsum(sizes) - sizes)[text]
    place = nth[:, None] * STRIDE + np.arange(-CONTEXT, STRIDE)
    inside = np.clip(place - 1, 0, np.maximum(sizes - 1, 0)[text][:, None])
    inputs = known.input[ids]
    x = np.where(place > 0, inputs[begin[:, None] + inside], 0)
    pad = np.where(place >= 0, 0, -1e9).astype(np.float32)
    scored = place[:, CONTEXT:]
    use = scored < sizes[text][:, None]
    target = ids[begin[:, None] + np.minimum(scored, sizes[text][:, None] - 1)]
    return x, pad, known.outcome[target].astype(np.int64), target, use, text


def encoder(vocabulary: str) -> subwords.WordIds:
    return subwords.rank_words(vocabulary)


def with_ends(ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.insert(ids, np.cumsum(sizes), END_ID), sizes + 1


def encoded(vocabulary: str):
    """What turns (doc_id, text) into (doc_id, ids, sizes): ids of 16 bits, and how many of them each word has."""

    def view(table: pa.Table) -> pa.Table:
        encode = encoder(vocabulary)
        out_ids: list[bytes] = []
        out_sizes: list[bytes] = []
        for run in subwords.some_rows(blocks.raw_texts(table["text"])):
            ids, sizes, n_words = encode.by_word([t.lower().split() for _, t in run])
            ids, sizes = ids.astype(np.uint16), sizes.astype(np.uint32)
            words = np.concatenate([[0], np.cumsum(n_words)])
            places = np.concatenate([[0], np.cumsum(sizes.astype(np.int64))])[words]
            for k in range(len(run)):
                out_ids.append(ids[places[k] : places[k + 1]].tobytes())
                out_sizes.append(sizes[words[k] : words[k + 1]].tobytes())
        return pa.table({"doc_id": table["doc_id"], "ids": pa.array(out_ids, pa.large_binary()), "sizes": pa.array(out_sizes, pa.large_binary())})

    return view


class Texts:
    """A block's texts as ids in a row, each text with its end."""

    def __init__(self, payloads: pa.ChunkedArray):
        table = blocks.opened(payloads)
        self.doc_ids = table["doc_id"]
        self.held_out = np.array([held_out(i) for i in table["doc_id"].to_pylist()], bool)
        sizes = [np.frombuffer(v.as_buffer(), np.uint32) for v in table["sizes"]]
        self.n_words = np.array([len(v) for v in sizes], np.int64)
        self.word_sizes = np.concatenate([np.zeros(0, np.uint32), *sizes]).astype(np.int64)
        words = np.concatenate([np.zeros(0, np.uint16), *(np.frombuffer(v.as_buffer(), np.uint16) for v in table["ids"])])
        self._words = words
        upto = np.concatenate([[0], np.cumsum(self.word_sizes)])
        n_ids = np.diff(upto[np.concatenate([[0], np.cumsum(self.n_words)])])
        self.ids, self.sizes = with_ends(words, n_ids)

    @cached_property
    def word_keys(self) -> np.ndarray:
        return word_keys(self._words, self.word_sizes)


def word_keys(ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A hash for each word, from its ids in order."""
    if not len(sizes):
        return np.zeros(0, np.uint64)
    begin = np.cumsum(sizes) - sizes
    nth = (np.arange(len(ids)) - np.repeat(begin, sizes)).astype(np.uint64)
    each = blocks.mixed((ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93) + nth * np.uint64(0xA0761D6478BD642F))
    return blocks.mixed(np.add.reduceat(each, begin) + sizes.astype(np.uint64))


def counted(values: np.ndarray, use: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order, and how often each occurs where use holds."""
    distinct = np.unique(values)
    some, n = np.unique(values[use], return_counts=True)
    times = np.zeros(len(distinct), np.int32)
    times[np.searchsorted(distinct, some)] = n
    return distinct, times


def announce(table: pa.Table, lay: blocks.Layout) -> pa.Table:
    """From a block: its distinct words and pairs of ids with their counts in training texts, and the counts of ids there."""
    own = table["block"][0].as_py()
    it = Texts(table["payload"])
    keys, times = counted(it.word_keys, ~np.repeat(it.held_out, it.n_words))
    out = [message(WORDS, b, own, keys[x], times[x]) for b, x in blocks.by_bucket(word_bucket(keys, lay.n_buckets), lay.n_buckets)]
    trained = ~np.repeat(it.held_out, it.sizes)
    codes, times = counted(pair_codes(it.ids, it.sizes), trained)
    for b, x in blocks.by_bucket(word_bucket(codes, lay.n_buckets), lay.n_buckets):
        out.append(message(PAIRS, 2 * lay.n_buckets + b, own, codes[x], times[x]))
    seen = np.bincount(it.ids[trained], minlength=VOCABULARY)
    used = np.flatnonzero(seen)
    out.append(message(IDS, lay.n_buckets + own % lay.n_buckets, own, used, seen[used]))
    return messages(out)


def pair_codes(ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The id before and the id, as one number for each id; the end stands before the first id of a text."""
    return ids_before(ids, sizes).astype(np.uint32) << np.uint32(16) | ids.astype(np.uint32)


def ids_before(ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    before = np.concatenate([[END_ID], ids[:-1]])
    before[np.cumsum(sizes)[:-1]] = END_ID
    return before


def with_pairs(logs: np.ndarray, pairs: np.ndarray, befores: np.ndarray) -> np.ndarray:
    """log10 probability of ids from that without pairs, the counts of their pairs, and those of all pairs with the ids before."""
    return np.log10((pairs + PAIR_PRIOR * 10.0 ** logs.astype(np.float64)) / (befores + PAIR_PRIOR))


def shares(known: Ids, ids: np.ndarray, before: np.ndarray, pairs: np.ndarray, befores: np.ndarray) -> np.ndarray:
    """log10 probability of ids in their outcomes, given the ids before: 0 for an outcome of one id. befores: how many pairs each id before has in each shared outcome."""
    out = np.zeros(len(ids))
    at = np.flatnonzero(known.outcome[ids] >= HEADS - 2)
    out[at] = with_pairs(known.share[ids[at]], pairs[at], befores[before[at], known.outcome[ids[at]] - (HEADS - 2)])
    return out


def word_bucket(keys: np.ndarray, n_buckets: int) -> np.ndarray:
    return (blocks.mixed(keys.astype(np.uint64) ^ np.uint64(0x8EBC6AF09C88C6E3)) % np.uint64(n_buckets)).astype(np.int64)


def meet(table: pa.Table) -> pa.Table:
    """In a bucket: the count of every word or pair over all blocks, told to each block that has it; how many words there are; and the pairs themselves."""
    kinds = table["kind"].to_numpy()
    passed = table.filter(pa.array(kinds == IDS))
    at = np.flatnonzero((kinds == WORDS) | (kinds == PAIRS))
    if not len(at):
        return passed
    pairs = kinds[at[0]] == PAIRS
    keys = [numbers(table["x"][int(k)].as_py(), np.uint32 if pairs else np.uint64) for k in at]
    times = np.concatenate([numbers(table["y"][int(k)].as_py(), np.int32) for k in at]).astype(np.int64)
    distinct, group = np.unique(np.concatenate(keys), return_inverse=True)
    totals = np.bincount(group, times).astype(np.int64)
    bucket = table["to"][0].as_py()
    rows = [message(BIGRAMS, -1, bucket, distinct, totals) if pairs else message(TOTALS, -1, bucket, np.array([totals.sum(), (totals > 0).sum()]))]
    for k, part in zip(at, np.split(totals[group], np.cumsum([len(x) for x in keys])[:-1])):
        rows.append(message(COUNTS, table["of"][int(k)].as_py(), bucket, part))
    return pa.concat_tables([passed, messages(rows)])


def pairs_of(df: DataFrame) -> DataFrame:
    """(at, amount) rows from x and y of messages."""

    def unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, y in zip(batch.column("x"), batch.column("y")):
                yield pa.RecordBatch.from_arrays([pa.array(numbers(v.as_py())) for v in (x, y)], ["at", "amount"])

    return df.select("x", "y").mapInArrow(unfold, "at long, amount long")


SUM_SCHEMA = "slot long, amount binary"


def sum_of(parts: DataFrame, size: int) -> np.ndarray:
    """Sums rows (slot, amount) of arrays of a fixed size: those of a slot in a task, then the slots, FAN_IN at most, on the driver."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for amount in batch.column("amount"):
                total += np.frombuffer(amount.as_buffer())
        yield pa.RecordBatch.from_arrays([pa.array([0], pa.int64()), pa.array([total.tobytes()], pa.binary())], ["slot", "amount"])

    rows = parts.repartition(FAN_IN, "slot").mapInArrow(add, SUM_SCHEMA).toArrow()
    return np.sum([np.zeros(size), *(np.frombuffer(v.as_buffer()) for v in rows["amount"])], axis=0)


def bigram_bias(met: DataFrame, known: Ids) -> np.ndarray:
    """Log shares of outcomes given the id before, from all pairs of the training texts."""

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, slot = np.zeros(BEFORE * HEADS), 0
        for batch in batches:
            for of, x, y in zip(*(batch.column(c).to_pylist() for c in ("of", "x", "y"))):
                codes, slot = numbers(x, np.uint32), of % FAN_IN
                before = codes >> np.uint32(16)
                # the end stands before the first id of a text, where the model's input is 0
                inputs = np.where(before == END_ID, 0, known.input[before]).astype(np.int64)
                pairs += np.bincount(inputs * HEADS + known.outcome[codes & np.uint32(0xFFFF)], numbers(y), BEFORE * HEADS)
        yield pa.RecordBatch.from_arrays([pa.array([slot], pa.int64()), pa.array([pairs.tobytes()], pa.binary())], ["slot", "amount"])

    told = met.where(F.col("kind") == BIGRAMS).select("of", "x", "y")
    return bigram_logits(sum_of(told.mapInArrow(tally, SUM_SCHEMA), BEFORE * HEADS).reshape(BEFORE, HEADS))


def shared_befores(met: DataFrame, known: Ids) -> np.ndarray:
    """For each id, how many pairs of the training texts have it before an id of each shared outcome."""

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 * VOCABULARY, np.int64)
        for batch in batches:
            for x, y in zip(*(batch.column(c).to_pylist() for c in ("x", "y"))):
                codes, outcome = numbers(x, np.uint32), known.outcome[numbers(x, np.uint32) & np.uint32(0xFFFF)].astype(np.int64)
                at = np.flatnonzero(outcome >= HEADS - 2)
                np.add.at(total, 2 * (codes[at] >> np.uint32(16)).astype(np.int64) + outcome[at] - (HEADS - 2), numbers(y)[at])
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["at", "amount"])

    told = met.where(F.col("kind") == BIGRAMS).select("x", "y")
    rows = told.mapInArrow(tally, "at long, amount long").groupBy("at").agg(F.sum("amount").alias("amount")).toArrow()  # two rows for each id at most
    out = np.zeros(2 * VOCABULARY, np.int64)
    out[rows["at"].to_numpy()] = rows["amount"].to_numpy()
    return out.reshape(VOCABULARY, 2)


def train(packed: DataFrame, known: Ids, bias: np.ndarray, batch_windows: int = 96, rate: float = 0.05) -> Model:
    """Each block takes steps from the same beginning on all windows of its training texts; weights are then averaged by
    how many windows a block has. So they depend on the blocks alone, not on how these are dealt to tasks. What a
    block gives is of fixed size.
    """
    first = begin_weights()
    names = list(first)
    n_weights = sum(v.size for v in first.values())

    def learn(table: pa.Table) -> pa.Table:
        it = Texts(table["payload"])
        trained = ~it.held_out
        w = {k: v.copy() for k, v in first.items()}
        squares = {k: np.full_like(v, 1e-3) for k, v in w.items()}
        seen, ends = 0, np.cumsum(it.sizes)
        for part in some_texts(it.sizes):
            own = part[trained[part]]
            if not len(own):
                continue
            ids = it.ids[np.repeat(trained[part], it.sizes[part]).nonzero()[0] + ends[part[0]] - it.sizes[part[0]]]
            x, pad, y, _, use, _ = windows(ids, it.sizes[own], known)
            order = np.random.default_rng(seen).permutation(len(x))
            for some in np.split(order, range(batch_windows, len(order), batch_windows)):
                step(w, bias, x[some], pad[some], y[some], use[some], squares, rate)
            seen += len(x)
        amount = np.concatenate([*(w[k].ravel() * float(seen) for k in names), [seen]]).astype(np.float64)
        return pa.table({"slot": pa.array([table["block"][0].as_py() % FAN_IN], pa.int64()), "amount": pa.array([amount.tobytes()], pa.binary())})

    total = sum_of(packed.groupBy("block").applyInArrow(learn, SUM_SCHEMA), n_weights + 1)
    weights, begin = {}, 0
    for k in names:
        part = total[begin : begin + first[k].size] / max(total[n_weights], 1)
        weights[k] = (part if total[n_weights] else first[k].ravel()).reshape(first[k].shape).astype(np.float32)
        begin += first[k].size
    return Model(weights, bias, int(total[n_weights]))


def some_texts(sizes: np.ndarray, most: int = 400_000) -> list[np.ndarray]:
    """Runs of texts in order with about so many ids each."""
    return np.split(np.arange(len(sizes)), np.flatnonzero(np.diff(np.cumsum(sizes) // most)) + 1) if len(sizes) else []


def inputs_before(ids: np.ndarray, sizes: np.ndarray, known: Ids) -> np.ndarray:
    before = np.concatenate([[0], known.input[ids[:-1]]]).astype(np.int64)
    before[np.cumsum(sizes)[:-1]] = 0
    return before


def id_scores(model: Model, known: Ids, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """log10 probability of each id of texts in a row, by its outcome and its share of all ids there."""
    return outcome_scores(model, known, ids, sizes) + known.share[ids]


def outcome_scores(model: Model, known: Ids, ids: np.ndarray, sizes: np.ndarray, most: int = 128) -> np.ndarray:
    """log10 probability of the outcome of each id of texts in a row, in batches of windows.

    As forward() has it, with what depends on one id alone taken from tables that are made once.
    """
    w = model.weights
    scale = np.float32(WIDTH**0.5)
    of_q, of_k, of_v = w["e"] @ w["q"] / scale, w["e"] @ w["k"], w["e"] @ w["v"]
    place_q, place_k, place_v = w["p"][CONTEXT:] @ w["q"] / scale, w["p"] @ w["k"], w["p"] @ w["v"]
    of_z, place_z = w["e"] @ w["u"][:WIDTH] + model.bias, w["p"][CONTEXT:] @ w["u"][:WIDTH]
    last = w["u"][WIDTH:]
    before = inputs_before(ids, sizes, known)
    # every text gets CONTEXT places before it, and is filled up to whole windows
    n_windows = -(-sizes // STRIDE)
    room = CONTEXT + n_windows * STRIDE
    begin = np.cumsum(room) - room
    at = np.repeat(begin + CONTEXT - np.cumsum(sizes) + sizes, sizes) + np.arange(len(ids))
    row, target = np.zeros(int(room.sum()), np.int64), np.zeros(int(room.sum()), np.int64)
    row[at], target[at] = before, known.outcome[ids]
    text = np.repeat(np.arange(len(sizes)), n_windows)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
    starts = begin[text] + nth * STRIDE
    logs = np.zeros(len(row), np.float32)
    places = np.arange(CONTEXT + STRIDE)
    one, ones = np.ones(CONTEXT + STRIDE, np.float32), np.ones(HEADS, np.float32)
    for a in range(0, len(starts), most):
        where = starts[a : a + most, None] + places
        x = row[where]
        late = x[:, CONTEXT:]
        k = of_k.take(x, axis=0)
        k += place_k
        v = of_v.take(x, axis=0)
        v += place_v
        s = (of_q.take(late, axis=0) + place_q) @ np.ascontiguousarray(k.transpose(0, 2, 1))
        s += MASK
        s[nth[a : a + most] == 0, :, :CONTEXT] = -1e9
        np.exp(s, out=s)
        seen = s @ v
        seen /= (s @ one)[..., None]
        z = (seen.reshape(-1, WIDTH) @ last).reshape(len(x), STRIDE, HEADS)
        z += of_z.take(late, axis=0)
        z += place_z
        own = where[:, CONTEXT:]
        chosen = np.take_along_axis(z, target[own][..., None], 2)[..., 0]
        np.exp(z, out=z)
        logs[own] = chosen - np.log(z @ ones)
    return logs[at] / np.float32(np.log(10))


def score_documents(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Per row of docs: doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score.

    Training texts are those of rows for which held_out() is false. Words are lower-cased in A-Z; a text is its words and one
    end. base_score adds up log10((c + 0.1) / (N + 0.1 (V + 1))) over words and the end; score is the model's log10
    probability of the same words (each encoded after a space) and the end, word by word a mixture with that share. Counts of words and of pairs of ids meet
    in buckets by hash and go back to the blocks that have them; nothing of the size of the vocabulary of words is sent to all.

    A null or empty text is an end alone. Very long texts are learnt and scored whole. A row without doc_id is held out. Repeated rows are scored each and
    counted each. Other columns are ignored; an empty table gives no rows; without training texts all counts are 0.
    """
    docs = docs.select("doc_id", "text")
    lay = blocks.layout(docs, fewest=4)  # attention learns more from few large blocks
    packed = blocks.chunks(docs, lay, encoded(vocabulary))
    packed = packed.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "block").persist(StorageLevel.DISK_ONLY)
    met = written(packed.groupBy("block").applyInArrow(lambda t: announce(t, lay), MESSAGE).groupBy("to").applyInArrow(meet, MESSAGE), "word-counts")
    totals = pairs_of(met.where(F.col("kind") == IDS)).groupBy("at").agg(F.sum("amount").alias("amount")).toArrow()  # a row for each id at most
    counts = np.zeros(VOCABULARY, np.int64)
    counts[totals["at"].to_numpy()] = totals["amount"].to_numpy()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2, np.int64)
        for batch in batches:
            for x in batch.column("x"):
                total += numbers(x.as_py())
        yield pa.RecordBatch.from_arrays([pa.array(total[k : k + 1]) for k in range(2)], ["n", "v"])

    n_v = met.where(F.col("kind") == TOTALS).select("x").mapInArrow(add, "n long, v long").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).head()
    n_texts = int(counts[END_ID])
    n_train, n_distinct = (n_v.n or 0) + n_texts, (n_v.v or 0) + (n_texts > 0)
    known = ids_from_counts(counts, subwords.begins_word(subwords.ranks_of(vocabulary)))
    model, befores = train(packed, known, bigram_bias(met, known)), shared_befores(met, known)

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        it = Texts(left["payload"])
        answers = dict(zip(right["of"].to_pylist(), right["x"].to_pylist()))

        def answered(values: np.ndarray, shift: int) -> np.ndarray:
            distinct, inverse = np.unique(values, return_inverse=True)
            times = np.zeros(len(distinct), np.int64)
            for b, x in blocks.by_bucket(word_bucket(distinct, lay.n_buckets), lay.n_buckets):
                times[x] = numbers(answers[shift + b])
            return times[inverse]

        times = answered(it.word_keys, 0)
        log = np.log10((times + 0.1) / (n_train + 0.1 * (n_distinct + 1)))
        end = np.log10((n_texts + 0.1) / (n_train + 0.1 * (n_distinct + 1)))
        n_texts_here = len(it.n_words)
        upto = np.cumsum(it.n_words)
        units = np.insert(log, upto, end)  # words of each text, then its end
        unit_sizes = np.insert(it.word_sizes, upto, 1)
        unit_text = np.repeat(np.arange(n_texts_here), it.n_words + 1)
        base = np.bincount(unit_text, units, n_texts_here)
        n_known = np.bincount(unit_text, np.insert(times, upto, n_texts) > 0, n_texts_here).astype(np.int64)
        pairs = answered(pair_codes(it.ids, it.sizes), 2 * lay.n_buckets)
        in_outcomes = shares(known, it.ids, ids_before(it.ids, it.sizes), pairs, befores)
        logs, done = [], 0
        for part in some_texts(it.sizes):
            n = int(it.sizes[part].sum())
            own = slice(done, done + n)
            done += n
            logs.append(outcome_scores(model, known, it.ids[own], it.sizes[part]) + in_outcomes[own])
        by_ids = np.add.reduceat(np.concatenate(logs), np.cumsum(unit_sizes) - unit_sizes)
        both = np.logaddexp(by_ids * np.log(10) + np.log(PART), units * np.log(10) + np.log(1 - PART)) / np.log(10)
        return pa.table(
            {
                "doc_id": it.doc_ids, "held_out": pa.array(it.held_out), "n_tokens": pa.array(it.n_words + 1), "n_known": pa.array(n_known),
                "train_tokens": pa.array(np.full(n_texts_here, n_train, np.int64)), "base_score": pa.array(base), "score": pa.array(np.bincount(unit_text, both, n_texts_here)),
            }
        )

    told = met.where(F.col("kind") == COUNTS).select("to", "of", "x")
    scores = packed.groupBy("block").cogroup(told.groupBy("to")).applyInArrow(
        score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )
    try:
        return written(scores, "scores")
    finally:
        packed.unpersist()


def op4_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(read(spark, sf_dir, "documents"), subwords.vocabulary_path("byte_bpe_50k.tiktoken"))
