"""Jaccard join of word shingles by partitioning the universe of shingles.

Two sets whose sizes add up to n and whose Jaccard similarity is at least 3/4 differ in at most n/7 elements. Sets are put
in size bands; a band cuts the universe of shingles into more segments than elements by which its sets may
differ, so two similar sets agree in a whole segment: segments are indexed by hash. A set with too few filled
segments counts some of them twice by also taking those that differ in one element (one-deletion
neighbourhoods), and then takes empty ones. Which segments a set asks for is allocated by cost: the rarest first.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.llm import blocks
from meterline.llm import words as word_scan
from meterline.llm.components import components
from meterline.llm.tables import LOWER_SQL, WORDS_SQL, read, written

WIDTH = 5
#: All bytes but the six word breaks.
WORD_BYTES = ~np.isin(np.arange(256), [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
MESSAGE = "kind int, to long, of long, x binary, y binary"
#: Kinds of messages.
DOCS, BARE, LINKS, PAIRS, KEYS, COUNTS, LABELS, SENT = range(8)
#: The low two bits of a key: a filled segment; what only waits to be asked for; what asks.
SEGMENT, WAITS, ASKS = range(3)
FIRST_SEGMENTS = 8
U = np.uint64


def message(kind: int, to: int, of: int, x: np.ndarray | bytes = b"", y: np.ndarray | bytes = b"") -> tuple:
    return kind, to, of, *(v if isinstance(v, bytes) else v.tobytes() for v in (x, y))


def messages(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) or [[]] * 5
    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=["kind", "to", "of", "x", "y"])


def numbers(value: bytes, kind=np.int64) -> np.ndarray:
    return np.frombuffer(value, kind)


def linked(n_a, n_b, n_common):
    """100 * intersection >= 75 * union, in whole numbers."""
    return 100 * n_common >= 75 * (n_a + n_b - n_common)


class Bands:
    """Size bands [low, high] with high < low * 4 / 3 or one size, so a set asks its own band and the one below."""

    def __init__(self, largest: int):
        low = [1]
        while low[-1] <= max(largest, 1):
            low.append(max(low[-1] + 1, -(-low[-1] * 4 // 3)))
        self.low = np.array(low, np.int64)
        self.high = self.low[1:] - 1
        #: More segments than any pair with its smaller set in the band may differ by.
        self.segments = (self.high * 4 // 3 + self.high) // 7 + 1
        #: Of these, the first few are indexed with one element left out, too.
        self.thinned = np.where(self.segments <= 12, self.segments, np.maximum(12, -(-self.segments * 8 // 100)))

    def of(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.low, sizes, side="right") - 1


def shingle_sets(texts: pa.ChunkedArray) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its five-word shingles; fewer words are one shingle, none make none."""
    words = word_scan.scan(pa.concat_arrays([c.cast(pa.large_binary()) for c in texts.chunks]) if texts.num_chunks else pa.array([], pa.large_binary()), WORD_BYTES)
    hashes = words.hashes[0]
    keys, begin = blocks.window_hashes(hashes, WIDTH, blocks.FOR_KEY), np.cumsum(words.sizes) - words.sizes
    out = []
    for a, n in zip(begin.tolist(), words.sizes.tolist()):
        if n >= WIDTH:
            out.append(np.unique(keys[a : a + n - WIDTH + 1]))
        elif n:
            out.append(blocks.mixed((hashes[a : a + n] * blocks.FOR_KEY[16 + 8 * n :][:n]).sum(keepdims=True) + U(n)))
        else:
            out.append(np.zeros(0, U))
    return out


@dataclass
class Level:
    """The segments that the sets of a block have in their own band (own) or in the band below."""

    own: bool
    set_of: np.ndarray  # by segment
    key: np.ndarray  # by segment, low bits clear
    double: np.ndarray  # the key under which sets with one more element wait
    filled: np.ndarray
    thin_set: np.ndarray  # by element left out
    thin_segment: np.ndarray
    thin_key: np.ndarray  # the segment without it
    thin_wait: np.ndarray
    need: np.ndarray  # by set: one more than the elements it may differ by; 0 where it doesn't ask
    twice: np.ndarray  # by segment: counted twice
    bare: np.ndarray  # by segment: empty, yet asked for


def level(elements: np.ndarray, set_of: np.ndarray, sizes: np.ndarray, own: bool) -> Level:
    bands = Bands(int(sizes.max(initial=1)))
    band = bands.of(sizes) - (not own)
    asks = (band >= 0) & (own | (bands.high[np.maximum(band, 0)] * 4 >= sizes * 3))
    band = np.where(asks, band, 0)
    n_segments = np.where(asks, bands.segments[band], 0)
    need = np.where(asks, (sizes + np.minimum(sizes, bands.high[band])) // 7 + 1, 0)
    begin = np.cumsum(n_segments) - n_segments
    total = int(n_segments.sum())
    use = asks[set_of]
    elements, of = elements[use], set_of[use]
    salt = blocks.mixed(band.astype(U) + U(0x9E3779B97F4A7C15))
    segment = (blocks.mixed(elements ^ salt[of]) % np.maximum(n_segments, 1).astype(U)[of]).astype(np.int64)
    at = begin[of] + segment
    weight = blocks.mixed(elements * U(0xD6E8FEB86659FD93))
    total_weight = np.zeros(total, U)
    np.add.at(total_weight, at, weight)
    count = np.bincount(at, minlength=total)
    segment_set = np.repeat(np.arange(len(sizes)), n_segments)
    place = np.arange(total) - begin[segment_set]
    name = blocks.mixed(salt[segment_set] + place.astype(U) * U(0xA0761D6478BD642F))
    clear = ~U(3)
    other = U(0xE7037ED1A0B428DB)
    key = blocks.mixed(total_weight + name) & clear
    double = blocks.mixed((total_weight + name) ^ other) & clear
    thinned = (place < bands.thinned[band][segment_set]) & (count >= 2)
    left_out = thinned[at]
    thin_at, thin_weight = at[left_out], (total_weight + name)[at[left_out]] - weight[left_out]
    filled = count > 0
    missing = np.maximum(need - np.bincount(segment_set[filled], minlength=len(sizes)), 0)

    def first(which: np.ndarray, most: np.ndarray) -> np.ndarray:
        upto = np.cumsum(which)
        before = np.concatenate([[0], upto])[begin]
        return which & (upto - before[segment_set] <= most[segment_set])

    twice = first(thinned, missing)
    missing = missing - np.bincount(segment_set[twice], minlength=len(sizes))
    bare = first(~filled, missing)
    return Level(own, segment_set, key, double, filled, of[left_out], thin_at, blocks.mixed(thin_weight) & clear, blocks.mixed(thin_weight ^ other) & clear, need, twice, bare)


def keys_of(x: Level) -> tuple[np.ndarray, np.ndarray]:
    """All keys that a block announces for a level, and the set of each."""
    thin = x.twice[x.thin_segment]
    parts = [
        (x.key[x.filled] | U(SEGMENT), x.set_of[x.filled]),
        (x.double[x.twice] | U(ASKS), x.set_of[x.twice]),
        (x.thin_key[thin] | U(SEGMENT), x.thin_set[thin]),
        (x.key[x.bare] | U(ASKS), x.set_of[x.bare]),
    ]
    if x.own:
        parts += [(x.key[~x.filled] | U(WAITS), x.set_of[~x.filled]), (x.thin_wait | U(WAITS), x.thin_set)]
    keys, sets = zip(*parts)
    return np.concatenate(keys), np.concatenate(sets)


def bucket_of(keys: np.ndarray, n_buckets: int) -> np.ndarray:
    return (blocks.mixed(keys >> U(2)) % U(n_buckets)).astype(np.int64)


class Block:
    """The shingle sets of a block of documents; equal sets are one, with the first document for all."""

    def __init__(self, payloads: pa.ChunkedArray):
        table = blocks.opened(payloads)
        ids = table["doc_id"]
        self.valid = ids.is_valid().to_numpy()
        self.ids = ids.fill_null(0).to_numpy()
        rows = shingle_sets(table["text"])
        self.sizes = np.array([len(r) for r in rows], np.int64)
        self.same: list[tuple[int, int]] = []
        self.sets: list[np.ndarray] = []
        owners: list[int] = []
        known: dict[bytes, int] = {}
        for k, row in enumerate(rows):
            if not self.valid[k] or not len(row):
                continue
            name = row.tobytes() if len(row) < 4 else blocks.mixed(row).sum().tobytes() + np.bitwise_xor.reduce(row).tobytes() + row[:2].tobytes()
            if name in known:
                self.same.append((owners[known[name]], int(self.ids[k])))
            else:
                known[name] = len(owners)
                owners.append(int(self.ids[k]))
                self.sets.append(row)
        self.owners = np.array(owners, np.int64)
        self.set_sizes = np.array([len(s) for s in self.sets], np.int64)
        self.elements = np.concatenate([np.zeros(0, U), *self.sets])
        self.set_of = np.repeat(np.arange(len(self.sets)), self.set_sizes)
        #: A hash of each set: copies in other blocks have the same.
        self.names = np.add.reduceat(blocks.mixed(self.elements ^ U(0xA24BAED4963EE407)), np.cumsum(self.set_sizes) - self.set_sizes) if self.sets else np.zeros(0, U)

    def sketches(self, own: bool, bits: float = 2) -> tuple[np.ndarray, np.ndarray]:
        """By set the words of its sketch, and all sketches in a row: for each of so many shares of the universe an element
        whether it holds an odd number of elements.

        The width is that of the own band, or of the band below. Sketches of two sets differ in at most as many bits as the sets
        differ in elements.
        """
        bands = Bands(int(self.set_sizes.max(initial=1)))
        words = np.ceil(bits * bands.high[np.maximum(bands.of(self.set_sizes) - (not own), 0)] / 64).astype(np.int64)
        begin = np.cumsum(words) - words
        share = blocks.mixed(self.elements ^ U(0x8EBC6AF09C88C6E3)) % (64 * words[self.set_of]).astype(U)
        odd = np.bincount(64 * begin[self.set_of] + share.astype(np.int64), minlength=64 * int(words.sum())) & 1
        return words, np.packbits(odd.astype(np.uint8)).view(U)

    def level(self, own: bool) -> Level:
        return level(self.elements, self.set_of, self.set_sizes, own)


def lower_words(table: pa.Table) -> pa.Table:
    """Texts as lower-case words with a space between."""
    texts = pa.array([b" ".join(t.lower().split()) for t in blocks.raw_texts(table["text"])], pa.large_binary())
    return table.set_column(table.schema.get_field_index("text"), "text", texts)


class Joined:
    """Which places are linked already."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def top(self, k: int) -> int:
        while self.up[k] != k:
            self.up[k] = k = self.up[self.up[k]]
        return k

    def join(self, a: int, b: int) -> None:
        a, b = self.top(a), self.top(b)
        self.up[max(a, b)] = min(a, b)


def same_key(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of keys (stable), and for each in that order the place in it where its run begins."""
    order = np.argsort(keys, kind="stable")
    new = np.concatenate([[True], np.diff(keys[order]) != 0])[: len(keys)]
    return order, np.flatnonzero(new)[np.cumsum(new) - 1]


SENT_SCHEMA = "to long, keys binary, at binary, asks binary, docs binary, labels binary, sizes binary, names binary, words binary, sketches binary"
#: A key's sets look for their nearest among so many at a time before all sets that are still apart meet.
NEAR = 512


def sent(lay: blocks.Layout, keys: np.ndarray, entry: np.ndarray, asks: np.ndarray, docs: np.ndarray, labels: np.ndarray, sizes: np.ndarray, names: np.ndarray, words: np.ndarray, sketches: np.ndarray) -> pa.Table:
    """Keys to their buckets; what a bucket must know of a set (an entry) goes there once, however many keys bring it."""
    begin = np.cumsum(words) - words
    rows = []
    for b, x in blocks.by_bucket(bucket_of(keys, lay.n_buckets), lay.n_buckets):
        own, at = np.unique(entry[x], return_inverse=True)
        sketch = sketches[ranges(begin[own], words[own])]
        at = at.astype(np.uint16 if len(own) <= 1 << 16 else np.uint32)
        values = short(keys[x]), at, np.packbits(asks[x].astype(bool)), docs[own], labels[own], sizes[own].astype(np.int32), names[own], words[own].astype(np.int32), sketch
        rows.append((b, *(v.tobytes() for v in values)))
    fields = [c.split()[0] for c in SENT_SCHEMA.split(", ")]
    columns = list(zip(*rows)) or [[]] * len(fields)
    return pa.table([pa.array(c, pa.int64() if n == "to" else pa.binary()) for c, n in zip(columns, fields)], names=fields)


def short(keys: np.ndarray) -> np.ndarray:
    """The low five bytes of keys. Their buckets follow from all eight, and keys that are taken for one only let more sets meet."""
    return np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5])


def long(value: bytes) -> np.ndarray:
    out = np.zeros((len(value) // 5, 8), np.uint8)
    out[:, :5] = numbers(value, np.uint8).reshape(-1, 5)
    return out.view("<u8").ravel()


def ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """begin[0], begin[0] + 1, ... of each range, in a row."""
    ends = np.cumsum(size)
    return np.repeat(begin - ends + size, size) + np.arange(int(ends[-1]) if len(ends) else 0)


class Bucket:
    """All keys of a bucket, and the sets that bring them."""

    def __init__(self, table: pa.Table):
        def joined(name: str, kind) -> np.ndarray:
            return np.concatenate([np.zeros(0, kind), *(numbers(v, kind) for v in table[name].to_pylist())])

        keys = [long(v) for v in table["keys"].to_pylist()]
        sizes = [len(v) // 8 for v in table["docs"].to_pylist()]
        self.keys = np.concatenate(keys)
        at = [numbers(v, np.uint16 if n <= 1 << 16 else np.uint32) for v, n in zip(table["at"].to_pylist(), sizes)]
        self.entry = np.concatenate(at).astype(np.int64) + np.repeat(np.cumsum(sizes) - sizes, [len(k) for k in keys])
        self.asks = np.concatenate([np.unpackbits(numbers(v, np.uint8), count=len(k)) for v, k in zip(table["asks"].to_pylist(), keys)])
        self.docs, self.labels, self.sizes = joined("docs", np.int64), joined("labels", np.int64), joined("sizes", np.int32).astype(np.int64)
        self.names = joined("names", U)
        self.words, self.sketches = joined("words", np.int32).astype(np.int64), joined("sketches", U)
        self.begin = np.cumsum(self.words) - self.words

    def first_copies(self, by: np.ndarray, entry: np.ndarray) -> np.ndarray:
        """For each place the first place, by document, with the same number in by and an equal set: equal in hash, size and sketch."""
        columns = by, self.names[entry], self.sizes[entry], self.words[entry]
        order = np.lexsort((self.docs[entry], *columns))
        new = np.ones(len(order), bool)
        new[1:] = np.any([np.diff(v[order]) != 0 for v in columns], axis=0)
        first = np.empty(len(order), np.int64)
        first[order] = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
        copies = np.flatnonzero(first != np.arange(len(first)))
        other = copies[self.apart(entry[copies], entry[first[copies]]) != 0]
        first[other] = other
        return first

    def apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """In how many bits the sketches of entries differ; sketches of different widths are never near."""
        out = np.full(len(a), 1 << 40, np.int64)
        equal = self.words[a] == self.words[b]
        for w in np.unique(self.words[a[equal]]).tolist():
            rows = np.flatnonzero(equal & (self.words[a] == w))
            for x in np.split(rows, range(max(1, (1 << 20) // w), len(rows), max(1, (1 << 20) // w))):
                places = np.arange(w)
                differ = self.sketches[self.begin[a[x], None] + places] ^ self.sketches[self.begin[b[x], None] + places]
                out[x] = np.bitwise_count(differ).sum(axis=1)
        return out

    def meetings(self, probe: np.ndarray, index: np.ndarray, keys: np.ndarray, most: int = 1 << 18) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Entries (asking, indexed) under one key, with different labels, whose sizes and sketches let them link.

        probe and index are places in keys. All that one place asks comes in one batch.
        """
        if not (len(probe) and len(index)):
            return
        known, run = np.unique(keys[index], return_inverse=True)
        names, name = np.unique(self.labels[self.entry[index]], return_inverse=True)
        code = run * len(names) + name
        order = np.argsort(code, kind="stable")
        code, index = code[order], index[order]
        probe = probe[np.isin(keys[probe], known)]
        base = np.searchsorted(known, keys[probe]) * len(names)
        own = self.labels[self.entry[probe]]
        place = np.searchsorted(names, own)
        there = names[np.minimum(place, len(names) - 1)] == own
        cut = [np.searchsorted(code, c) for c in (base, base + place, base + place + there, base + len(names))]
        n = cut[1] - cut[0] + cut[3] - cut[2]
        probe, cut, n = probe[n > 0], [c[n > 0] for c in cut], n[n > 0]
        first = 0
        while first < len(probe):
            last = max(first + 1, int(np.searchsorted(np.cumsum(n[first:]), most)) + first)
            part = slice(first, last)
            begin = np.stack([cut[0][part], cut[2][part]], 1).ravel()
            size = np.stack([cut[1][part] - cut[0][part], cut[3][part] - cut[2][part]], 1).ravel()
            a, b = np.repeat(self.entry[probe[part]], n[part]), self.entry[index[ranges(begin, size)]]
            small, large = np.minimum(self.sizes[a], self.sizes[b]), np.maximum(self.sizes[a], self.sizes[b])
            fits = (4 * small >= 3 * large) & (self.words[a] == self.words[b])
            a, b = a[fits], b[fits]
            near = self.apart(a, b) <= (self.sizes[a] + self.sizes[b]) // 7
            yield a[near], b[near]
            first = last

    def pairs(self, found: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        a, b = (self.docs[np.concatenate([np.zeros(0, np.int64), *x])] for x in (zip(*found) if found else ((), ())))
        pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0)
        return pairs[pairs[:, 0] != pairs[:, 1]]


def announce_copies(table: pa.Table, lay: blocks.Layout) -> pa.Table:
    """From a block: its documents, links inside it, and a few keys of one set of each group of linked ones."""
    own = table["block"][0].as_py()
    block = Block(table["payload"])
    links = list(block.same)
    out = sent(lay, *[np.zeros(0, k) for k in (U, np.int64, np.int8, np.int64, np.int64, np.int64, U, np.int64, U)])
    if block.sets:
        own_level = block.level(True)
        # sets that agree in one of a few segments are compared with the first of them
        filled = np.flatnonzero(own_level.filled)
        rank = np.arange(len(filled)) - np.searchsorted(own_level.set_of[filled], own_level.set_of[filled])
        some = filled[rank < FIRST_SEGMENTS]
        keys, sets = own_level.key[some], own_level.set_of[some]
        order, begin = same_key(keys)
        joined = Joined(len(block.sets))
        for a, b in np.unique(np.stack([sets[order[begin]], sets[order]], 1), axis=0).tolist():
            if joined.top(a) != joined.top(b) and linked(len(block.sets[a]), len(block.sets[b]), len(np.intersect1d(block.sets[a], block.sets[b], assume_unique=True))):
                joined.join(a, b)
                links.append((int(block.owners[a]), int(block.owners[b])))
        top = np.array([joined.top(k) for k in range(len(block.sets))])
        by_group = np.lexsort((sets, top[sets], keys))
        first = by_group[np.concatenate([[True], (np.diff(keys[by_group]) != 0) | (np.diff(top[sets[by_group]]) != 0)])]
        out = sent(lay, keys[first], sets[first], np.ones(len(first)), block.owners, block.owners[top], block.set_sizes, block.names, *block.sketches(True, 0.5))
    a, b = np.array(links, np.int64).reshape(-1, 2).T
    valid = block.valid
    rows = [(DOCS, block.ids[valid].tobytes(), block.sizes[valid].tobytes()), (BARE, b"", block.sizes[~valid].tobytes()), (LINKS, np.ascontiguousarray(a).tobytes(), np.ascontiguousarray(b).tobytes())]
    told = pa.table({"to": pa.array([lay.n_buckets + 4 * own + k for k, _, _ in rows], pa.int64()), "keys": pa.array([x for _, x, _ in rows], pa.binary()), "at": pa.array([y for _, _, y in rows], pa.binary())})
    return pa.concat_tables([out, told], promote_options="default")


def meet_copies(table: pa.Table, lay: blocks.Layout) -> pa.Table:
    """In a bucket: each set with the first and with the nearest set under each of its keys. What blocks say of themselves passes."""
    bucket = table["to"][0].as_py()
    if bucket >= lay.n_buckets:
        return messages([((bucket - lay.n_buckets) % 4, -1, -1, x, y) for x, y in zip(table["keys"].to_pylist(), table["at"].to_pylist())])
    it = Bucket(table)
    docs = it.docs[it.entry]
    order = np.lexsort((docs, it.keys))
    new = np.concatenate([[True], np.diff(it.keys[order]) != 0])[: len(order)]
    begin = np.flatnonzero(new)[np.cumsum(new) - 1]
    found = [(it.entry[order[begin]], it.entry[order])]
    within = Bucket.__new__(Bucket)
    within.__dict__.update(it.__dict__, entry=it.entry[order])
    # a copy meets the first of its like under the key; only that one looks for what is near
    first = within.first_copies(it.keys[order], within.entry)
    found.append((within.entry[first], within.entry))
    place = np.flatnonzero(first == np.arange(len(order)))
    # a long run is cut into shares by document
    n = np.bincount(begin[place], minlength=len(order))[begin]
    share = blocks.mixed(docs[order].astype(U)) % np.maximum(-(-n // NEAR), 1).astype(U)
    keys = blocks.mixed(it.keys[order] + share * U(0x9E3779B97F4A7C15))
    for a, b in within.meetings(place, place, keys):
        if len(a):
            by = np.lexsort((it.docs[b], it.apart(a, b), a))
            by = by[np.concatenate([[True], np.diff(a[by]) != 0])]
            found.append((a[by], b[by]))
    return pair_messages(it.pairs(found), lay)


def labels_of(block: "Block", told: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The component of each set of a block as far as links are known, and whether it has any; else its own document."""
    known = {}
    for kind, x, y in zip(*(told[c].to_pylist() for c in ("kind", "x", "y"))):
        if kind == LABELS:
            known.update(zip(numbers(x).tolist(), numbers(y).tolist()))
    return np.array([known.get(i, i) for i in block.owners.tolist()], np.int64), np.array([i in known for i in block.owners.tolist()], bool)


class Announced:
    """The distinct keys of a block by bucket: those of one component of several documents, and all others."""

    def __init__(self, block: "Block", told: pa.Table):
        self.label, member = labels_of(block, told)
        self.levels = [block.level(own) for own in (True, False)]
        parts = [keys_of(x) for x in self.levels]
        self.sizes = [len(k) for k, _ in parts]
        self.all_keys = np.concatenate([k for k, _ in parts])
        self.sets = np.concatenate([s for _, s in parts])
        self.keys, self.place, self.here = np.unique(self.all_keys, return_inverse=True, return_counts=True)
        of = self.label[self.sets]
        self.component = np.zeros(len(self.keys), np.int64)
        self.component[self.place] = of
        self.mixed = np.zeros(len(self.keys), bool)
        np.logical_or.at(self.mixed, self.place, of != self.component[self.place])
        self.whole = np.zeros(len(self.keys), bool)  # all its sets are of one component of several documents
        self.whole[self.place] = member[self.sets]
        self.whole &= ~self.mixed

    def by_bucket(self, lay: blocks.Layout) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        for b, x in blocks.by_bucket(bucket_of(self.keys, lay.n_buckets), lay.n_buckets):
            yield b, x[self.whole[x]], x[~self.whole[x]]


def announce(left: pa.Table, right: pa.Table, lay: blocks.Layout) -> pa.Table:
    """From a block: all its keys to their buckets, with components where these are known."""
    if not len(left):
        return messages([])
    own = left["block"][0].as_py()
    block = Block(left["payload"])
    if not block.sets:
        return messages([])
    it = Announced(block, right)
    return messages([message(KEYS, b, own, short(it.keys[np.concatenate([x, y])]), it.component[x]) for b, x, y in it.by_bucket(lay)])


def meet(table: pa.Table) -> pa.Table:
    """In a bucket: how many blocks have each key (as far as 255); one for a key that one component alone has."""
    of = table["of"].to_pylist()
    parts = [long(x) for x in table["x"].to_pylist()]
    components_ = [numbers(y) for y in table["y"].to_pylist()]
    keys = np.concatenate(parts)
    whole = np.concatenate([np.arange(len(p)) < len(c) for p, c in zip(parts, components_)])
    base, tag = keys >> U(2), (keys & U(3)).astype(np.int64)
    _, group = np.unique(base, return_inverse=True)
    n_groups = int(group.max(initial=-1)) + 1
    have = [np.bincount(group[tag == t], minlength=n_groups) for t in range(3)]
    low, high = np.full(n_groups, np.iinfo(np.int64).max), np.full(n_groups, np.iinfo(np.int64).min)
    component = np.concatenate(components_)
    np.minimum.at(low, group[whole], component)
    np.maximum.at(high, group[whole], component)
    one = (np.bincount(group[~whole], minlength=n_groups) == 0) & (low == high)
    answer = np.select([tag == SEGMENT, tag == WAITS], [have[SEGMENT][group], 255 * (have[ASKS][group] > 0)], have[WAITS][group] + 1)
    answer = np.where(one[group], np.where(tag == WAITS, 0, 1), np.minimum(answer, 255)).astype(np.uint8)
    rows = [message(COUNTS, b, table["to"][0].as_py(), part) for b, part in zip(of, np.split(answer, np.cumsum([len(p) for p in parts])[:-1]))]
    return messages(rows)


def ask(left: pa.Table, right: pa.Table, lay: blocks.Layout) -> pa.Table:
    """From a block that knows how common its keys are: those that sets ask for, and those that others may ask for."""
    empty = sent(lay, *[np.zeros(0, k) for k in (U, np.int64, np.int8, np.int64, np.int64, np.int64, U, np.int64, U)])
    if not len(left):
        return empty
    block = Block(left["payload"])
    if not block.sets:
        return empty
    counts = {of: numbers(x, np.uint8) for kind, of, x in zip(*(right[c].to_pylist() for c in ("kind", "of", "x"))) if kind == COUNTS}
    it = Announced(block, right)
    others = np.zeros(len(it.keys), np.int64)
    for b, x, y in it.by_bucket(lay):
        others[np.concatenate([x, y])] = counts[b]
    tags = it.keys & U(3)
    # other blocks with the key and other sets here; what waits costs where it is asked for
    costs = np.where(tags == WAITS, others > 0, others - 1 + np.where((tags == SEGMENT) & it.mixed, it.here - 1, 0))
    cost = costs[it.place]
    keys, entries, asks, begin = [], [], [], 0
    n_sets = len(block.sets)
    for x, size in zip(it.levels, it.sizes):
        own_cost, level_sets, level_keys = (v[begin : begin + size] for v in (cost, it.sets, it.all_keys))
        begin += size
        n_filled, n_twice = int(x.filled.sum()), int(x.twice.sum())
        by_cost = np.lexsort((own_cost[:n_filled], level_sets[:n_filled]))
        ordered = level_sets[by_cost]
        rank = np.arange(n_filled) - np.searchsorted(ordered, ordered)
        asked = np.zeros(size, bool)
        asked[by_cost] = rank < x.need[ordered]
        n_asks = n_filled + n_twice + int(x.twice[x.thin_segment].sum()) + int(x.bare.sum())
        asked[n_filled:n_asks] = True
        asked &= own_cost > 0
        keys.append(level_keys[asked])
        entries.append(level_sets[asked] + (0 if x.own else n_sets))
        asks.append(np.ones(int(asked.sum())))
        if x.own:
            indexed = own_cost > 0
            indexed[n_filled:n_asks] = False
            keys.append(level_keys[indexed])
            entries.append(level_sets[indexed])
            asks.append(np.zeros(int(indexed.sum())))
    words, sketches = zip(block.sketches(True), block.sketches(False))
    twice = [np.concatenate([v, v]) for v in (block.owners, it.label, block.set_sizes, block.names)]
    return sent(lay, np.concatenate(keys) & ~U(3), np.concatenate(entries), np.concatenate(asks), *twice, np.concatenate(words), np.concatenate(sketches))


def candidates(table: pa.Table, lay: blocks.Layout) -> pa.Table:
    """In a bucket: all pairs of a set that asks and one that is indexed, in different components, that may link. Of equal sets in a component the first stands for all."""
    it = Bucket(table)
    it.entry = it.first_copies(it.labels, np.arange(len(it.docs)))[it.entry]
    order = np.lexsort((it.entry, it.keys, it.asks))
    again = np.all([np.diff(v[order]) == 0 for v in (it.entry, it.keys, it.asks)], axis=0)
    once = order[np.concatenate([[True], ~again])[: len(order)]]
    found = []
    for a, b in it.meetings(once[it.asks[once] == 1], once[it.asks[once] == 0], it.keys):
        if len(a):
            pairs = np.unique(a * len(it.docs) + b)
            found.append((pairs // len(it.docs), pairs % len(it.docs)))
    return pair_messages(it.pairs(found), lay)


def pair_messages(pairs: np.ndarray, lay: blocks.Layout) -> pa.Table:
    """Pairs to shares by their hash, so that those of several buckets become one before they are rows."""
    share = blocks.mixed(pairs[:, 0].astype(U) * U(0xA0761D6478BD642F) ^ pairs[:, 1].astype(U)) % U(lay.n_buckets)
    return messages([message(PAIRS, b, -1, *(np.ascontiguousarray(c) for c in pairs[x].T)) for b, x in blocks.by_bucket(share.astype(np.int64), lay.n_buckets)])


def distinct_pairs(table: pa.Table) -> pa.Table:
    a, b = (np.concatenate([numbers(v) for v in table[c].to_pylist()]) for c in ("x", "y"))
    a, b = np.unique(np.stack([a, b], 1), axis=0).T
    return pa.table({"a": np.ascontiguousarray(a), "b": np.ascontiguousarray(b)})


def as_rows(df: DataFrame, schema: str) -> DataFrame:
    """Rows of two longs from the x and y of messages."""

    def unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, y in zip(batch.column("x"), batch.column("y")):
                yield pa.RecordBatch.from_arrays([pa.array(numbers(v.as_py())) for v in (x, y)], [c.split()[0] for c in schema.split(", ")])

    return df.select("x", "y").mapInArrow(unfold, schema)


def with_blocks(pairs: DataFrame, lay: blocks.Layout, schema: str) -> DataFrame:
    """Rows of two longs with the block of each, as ids."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (c.to_numpy() for c in batch.columns)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(lay.block_of(a), pa.int64()), pa.array(lay.block_of(b), pa.int64())], [c.split()[0] for c in schema.split(", ")])

    return pairs.mapInArrow(place, schema)


def verified(pairs: DataFrame, packed: DataFrame, lay: blocks.Layout) -> DataFrame:
    """Of distinct pairs (a, b) those that are linked: texts of a travel once to each block that holds a b."""
    placed = written(with_blocks(pairs, lay, "a long, b long, a_block long, b_block long"), "pairs")
    wanted = placed.select("a", "a_block", "b_block").distinct()

    def send(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        if len(right):
            table = blocks.opened(left["payload"])
            ids = table["doc_id"].fill_null(-(2**63)).to_numpy()
            for to in np.unique(right["b_block"].to_numpy()):
                mine = right["a"].to_numpy()[right["b_block"].to_numpy() == to]
                rows.append(message(SENT, int(to), -1, blocks.packed(table.take(pa.array(np.flatnonzero(np.isin(ids, mine)))).combine_chunks())))
        return messages(rows)

    texts = packed.groupBy("block").cogroup(wanted.groupBy("a_block")).applyInArrow(send, MESSAGE)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            to = batch.column("b_block").to_numpy()
            order = np.argsort(to, kind="stable")
            for x in np.split(order, np.flatnonzero(np.diff(to[order])) + 1):
                if len(x):
                    yield messages([message(PAIRS, int(to[x[0]]), -1, batch.column("a").to_numpy()[x], batch.column("b").to_numpy()[x])]).to_batches()[0]

    asked = placed.mapInArrow(gather, MESSAGE)

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if len(right):
            rows = list(zip(*(right[c].to_pylist() for c in ("kind", "x", "y"))))
            pairs = np.concatenate([np.stack([numbers(x), numbers(y)], 1) for kind, x, y in rows if kind == PAIRS])

            def sets(table: pa.Table, wanted: np.ndarray) -> dict[int, list[np.ndarray]]:
                ids = table["doc_id"].fill_null(-(2**63)).to_numpy()
                table = table.take(pa.array(np.flatnonzero(np.isin(ids, wanted))))
                found: dict[int, list[np.ndarray]] = {}
                for i, row in zip(table["doc_id"].to_pylist(), shingle_sets(table["text"])):
                    found.setdefault(i, []).append(row)
                return found

            there: dict[int, list[np.ndarray]] = {}
            for kind, x, _ in rows:
                if kind == SENT:
                    for i, found in sets(pa.ipc.open_stream(x).read_all(), pairs[:, 0]).items():
                        there[i] = found
            here = sets(blocks.opened(left["payload"]), pairs[:, 1])
            for a, b in pairs.tolist():
                if any(linked(len(s), len(t), len(np.intersect1d(s, t, assume_unique=True))) for s in there.get(a, ()) for t in here.get(b, ())):
                    out.append((a, b))
        a, b = np.array(out, np.int64).reshape(-1, 2).T
        return pa.table({"a": a, "b": b})

    return packed.groupBy("block").cogroup(texts.unionByName(asked).groupBy("to")).applyInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per row of docs: doc_id, n_shingles (distinct five-word shingles) and component_id.

    Words are lower-cased in A-Z. Documents link when 100 * intersection >= 75 * union; component_id is the smallest
    doc_id that links reach. Sets meet in two steps. (1) Under a few of its segments a set meets the first and the nearest set:
    that finds most groups of copies in a number of pairs that grows with the sets alone. (2) All keys of all blocks are counted in
    buckets, with the components of (1). Sets ask for their cheapest segments among the keys that more than one component
    has, and meet all sets of other components there. Sketches leave out pairs that differ in more bits
    than linked sets can. All pairs of both steps are verified on whole sets, so (1) and the sketches only save work.

    Null texts and texts without words have no shingles and no links; fewer than five words are one
    shingle. Very long texts are taken whole: a set has more segments and a wider sketch the larger it is. Rows that share a
    doc_id are one document in links, each with its own n_shingles. Rows
    without doc_id have no links and a null component_id. Other columns are ignored; an empty table gives no rows.
    """
    docs = docs.select("doc_id", "text")
    spark = docs.sparkSession
    lay = blocks.layout(docs, block_bytes=2 << 20)
    packed = blocks.chunks(docs, lay, lower_words).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "block").persist(StorageLevel.DISK_ONLY)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            to = batch.column("block").to_numpy()
            order = np.argsort(to, kind="stable")
            for x in np.split(order, np.flatnonzero(np.diff(to[order])) + 1):
                if len(x):
                    yield messages([message(LABELS, int(to[x[0]]), -1, batch.column("id").to_numpy()[x], batch.column("label").to_numpy()[x])]).to_batches()[0]

    try:
        copies = packed.groupBy("block").applyInArrow(lambda t: announce_copies(t, lay), SENT_SCHEMA).groupBy("to").applyInArrow(lambda t: meet_copies(t, lay), MESSAGE)
        copies = written(copies, "copies")
        inside = as_rows(copies.where(F.col("kind") == LINKS), "a long, b long")
        first = copies.where(F.col("kind") == PAIRS).groupBy("to").applyInArrow(distinct_pairs, "a long, b long")
        labels = components(inside.unionByName(verified(first, packed, lay)))
        told = written(with_blocks(labels, lay, "id long, label long, block long, label_block long").mapInArrow(gather, MESSAGE), "labels")
        keys = packed.groupBy("block").cogroup(told.groupBy("to")).applyInArrow(lambda a, b: announce(a, b, lay), MESSAGE)
        counts = keys.groupBy("to").applyInArrow(meet, MESSAGE)
        asked = packed.groupBy("block").cogroup(counts.unionByName(told).groupBy("to")).applyInArrow(lambda a, b: ask(a, b, lay), SENT_SCHEMA)
        met = asked.groupBy("to").applyInArrow(lambda t: candidates(t, lay), MESSAGE)
        rest = met.groupBy("to").applyInArrow(distinct_pairs, "a long, b long")
        known = labels.where("id <> label").toDF("a", "b")
        labels = components(known.unionByName(verified(rest, packed, lay)))
    finally:
        packed.unpersist()
    with_id = as_rows(copies.where(F.col("kind") == DOCS), "doc_id long, n_shingles long")
    joined = with_id.join(labels.toDF("doc_id", "label"), "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("label", "doc_id").alias("component_id"))

    def without_id(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for y in batch.column("y"):
                sizes = pa.array(numbers(y.as_py()))
                yield pa.RecordBatch.from_arrays([pa.nulls(len(sizes), pa.int64()), sizes, pa.nulls(len(sizes), pa.int64())], ["doc_id", "n_shingles", "component_id"])

    bare = copies.where(F.col("kind") == BARE).select("y").mapInArrow(without_id, "doc_id long, n_shingles long, component_id long")
    return joined.unionByName(bare)


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id, in the columns of docs, unchanged.

    Rows that share an id are documents of their own: of equal or near texts among them one stays, different texts all
    stay. Rows without an id, null texts and texts without words have no duplicates and stay. Very long texts are compared whole. Columns may have any name
    and type; an empty table gives no rows.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    repeated = docs.where(F.col("doc_id").isNotNull()).groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("id"))
    boxed = docs.select(F.col("doc_id").alias("id"), row)
    if repeated.isEmpty():
        lost = near_duplicates(docs).where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias("id"))
        return boxed.join(lost, "id", "left_anti").select("row.*")
    # rows of repeated ids get numbers of their own, below all ids
    lowest = docs.agg(F.min("doc_id").alias("least")).head().least
    many = written(boxed.join(repeated, "id", "left_semi").withColumn("number", F.lit(lowest - 1) - F.monotonically_increasing_id()), "repeated")
    numbered = boxed.join(repeated, "id", "left_anti").withColumn("number", F.col("id")).unionByName(many)
    found = near_duplicates(numbered.select(F.col("number").alias("doc_id"), F.col("row.text").alias("text"))).select(F.col("doc_id").alias("number"), "component_id")
    least = found.where(F.col("number").isNotNull()).join(numbered.select("number", "id"), "number").groupBy("component_id").agg(F.min(F.struct("id", "number")).alias("least"))
    stays = least.select("least.number")
    return numbered.where(F.col("number").isNull()).unionByName(numbered.join(stays, "number", "left_semi").select(*numbered.columns)).select("row.*")


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))


OP9_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, {WORDS_SQL.format(text=LOWER_SQL.format(text="text"))} AS ws FROM documents),
shingles AS (SELECT DISTINCT doc_id, s FROM (SELECT doc_id, unnest(CASE WHEN len(ws) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(ws) < {WIDTH} THEN [array_to_string(ws, ' ')]
  ELSE list_transform(range(1, len(ws) - {WIDTH - 2}), lambda i: array_to_string(ws[i : i + {WIDTH - 1}], ' ')) END) AS s FROM d) t),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM common JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y WHERE 100 * c >= 75 * (a.n + b.n - c)),
reach AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y),
least AS (SELECT x, min(y) AS y FROM reach GROUP BY 1)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(y, d.doc_id)) AS component_id FROM d LEFT JOIN sizes USING (doc_id) LEFT JOIN least ON x = d.doc_id"""
