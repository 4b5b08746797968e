"""Subword ids of whole texts by way of their distinct words; vocabularies are public files at a given path."""

from __future__ import annotations

import base64
import os
from collections.abc import Callable, Iterable
from itertools import chain

import numpy as np


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: Marks at the end of a word that make a piece of their own after letters.
MARKS = ".,;:!?#$%&*+-/=@\\^_`~()[]{}\""


class Numbers(dict):
    """Numbers for words in the order in which they are first asked for; `new` has those that came since it was last emptied."""

    def __init__(self):
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self[word] = len(self)
        self.new.append(word)
        return len(self) - 1


class WordIds:
    """Remembers the ids of words, so that each word is encoded once until `most` are known.

    encode takes a list of words as strings and gives all their ids in a row, and how many ids each word has.
    """

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], most: int = 800_000):
        self.encode, self.most = encode, most
        self.forget()

    def forget(self) -> None:
        self.known = Numbers()
        self.begin, self.size, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def _learn(self) -> None:
        """Encodes the words that were numbered since the last time."""
        new, self.known.new = self.known.new, []
        if not new:
            return
        try:
            flat, size = self.encode([w.decode() for w in new])
        except BaseException:
            self.forget()
            raise
        self.begin = np.concatenate([self.begin, len(self.flat) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.flat = np.concatenate([self.flat, flat])

    def by_word(self, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of all words of all texts in a row, how many ids each word has, and how many words each text."""
        if len(self.known) > self.most:
            self.forget()
        n_words = np.fromiter(map(len, texts), np.int64, len(texts))
        at = np.fromiter(map(self.known.__getitem__, chain.from_iterable(texts)), np.int64, int(n_words.sum()))
        self._learn()
        size = self.size[at]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.repeat(self.begin[at] - ends + size, size) + np.arange(total)], size, n_words

    def __call__(self, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words of all texts in a row, and how many ids each text has."""
        ids, size, n_words = self.by_word(texts)
        upto = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(n_words)])]
        return ids, np.diff(upto)


_LOADED: dict[str, WordIds] = {}


def letters_apart(tokenizer) -> bool:
    """Whether letters, and marks after them, are pieces of their own whatever stands beside them, and letters the same in either case."""
    if tokenizer.model.end_of_word_suffix is None or tokenizer.normalizer is None:
        return False
    pieces = [x for x, _ in tokenizer.pre_tokenizer.pre_tokenize_str(f"ab{MARKS} c")]
    return tokenizer.normalizer.normalize_str("AZ") == "az" and pieces == ["ab", MARKS, "c"]


def bpe_words(path: str) -> WordIds:
    """Ids by a `tokenizers` file, words alone; kept for the life of a Python worker.

    Right for tokenizers whose pieces never reach over the six word breaks, as both BPE files here. Where letters stand apart from the marks
    after them, a word of letters goes to the model at once, or with others in one text, and what the marks give is remembered.
    """
    if path not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        apart, model = letters_apart(tokenizer), tokenizer.model
        tails: dict[str, list[int]] = {}

        def encode(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
            ids: list[list[int]] = [[]] * len(words)
            cores = [w.rstrip(MARKS) for w in words]
            letters = np.fromiter((apart and c.isalpha() for c in cores), bool, len(cores))
            ascii_ = np.fromiter(map(str.isascii, cores), bool, len(cores))
            for k in np.flatnonzero(letters & ascii_).tolist():
                ids[k] = [t.id for t in model.tokenize(cores[k].lower())]
            others = np.flatnonzero(letters & ~ascii_)
            for some in np.split(others, range(1024, len(others), 1024)):  # what the library makes of a word is large, so few are held at a time
                made = tokenizer.encode(" ".join(cores[k] for k in some), add_special_tokens=False)
                of = np.array(made.word_ids, np.int64)
                if len(of) and of[-1] + 1 == len(some):  # each word is at least one piece, so each is one
                    flat, ends = made.ids, np.flatnonzero(np.diff(of, append=-1)) + 1
                    for k, begin, end in zip(some.tolist(), [0, *ends[:-1].tolist()], ends.tolist()):
                        ids[k] = flat[begin:end]
                else:
                    letters[some] = False
            marked = np.fromiter(map(len, words), np.int64, len(words)) > np.fromiter(map(len, cores), np.int64, len(cores))
            for k in np.flatnonzero(letters & marked).tolist():
                tail = words[k][len(cores[k]) :]
                if tail not in tails:
                    tails[tail] = tokenizer.encode(tail, add_special_tokens=False).ids
                ids[k] = ids[k] + tails[tail]
            others = np.flatnonzero(~letters)
            for some in np.split(others, range(1024, len(others), 1024)):
                for k, x in zip(some.tolist(), tokenizer.encode_batch_fast([words[k] for k in some], add_special_tokens=False)):
                    ids[k] = x.ids
            size = np.fromiter(map(len, ids), np.int64, len(ids))
            return np.fromiter(chain.from_iterable(ids), np.int32, int(size.sum())), size

        _LOADED[path] = WordIds(encode)
    return _LOADED[path]


def ranks_of(path: str) -> dict[bytes, int]:
    """The pieces of a `tiktoken` file with their ids."""
    with open(path, "rb") as lines:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}


def rank_words(path: str) -> WordIds:
    """Ids by a `tiktoken` file, each word after a space; kept for the life of a Python worker.

    Special tokens in a text are ordinary text. Many words go through as one text: pieces don't reach over a space, so a word begins at each
    id whose piece begins with one. Where these are not as many as the words, words are encoded one by one.
    """
    if path not in _LOADED:
        import public_tokenizers
        import tiktoken

        ranks = ranks_of(path)
        begins = begins_word(ranks)
        one = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

        def some(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
            ids = np.array(one(" " + " ".join(words)) if all(map(str.isprintable, words)) else [], np.int32)
            at = np.flatnonzero(begins[ids])
            if len(at) == len(words):
                return ids, np.diff(at, append=len(ids))
            each = [one(" " + w) for w in words]
            size = np.fromiter(map(len, each), np.int64, len(each))
            return np.fromiter(chain.from_iterable(each), np.int32, int(size.sum())), size

        def encode(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
            ids, sizes = zip(*(some(words[k : k + 256]) for k in range(0, len(words), 256)))
            return np.concatenate(ids), np.concatenate(sizes)

        _LOADED[path] = WordIds(encode)
    return _LOADED[path]


def begins_word(ranks: dict[bytes, int]) -> np.ndarray:
    """For each id up to one beyond the last, whether its piece begins with a space."""
    out = np.zeros(max(ranks.values()) + 2, bool)
    out[[k for piece, k in ranks.items() if piece.startswith(b" ")]] = True
    return out


def some_rows(texts: Iterable, most_bytes: int = 4 << 20):
    """Runs of (place, text) with at most so many bytes of text, one text at least."""
    run, size = [], 0
    for k, text in enumerate(texts):
        if run and size + len(text) > most_bytes:
            yield run
            run, size = [], 0
        run.append((k, text))
        size += len(text)
    if run:
        yield run
