"""Token ids of whole texts by a public tokenizer, with a bounded memory of words inside a task.

The library's time goes into merging bytes of words.  Where a text divides into words that the
tokenizer treats alone, only words not met before are handed to it; the ids of a text are those
of its words in order.  A text for which that is not certain (control or rare blanks, strings of
special tokens) is handed over whole.  The ids equal those of the whole text in either case.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from tokenizers import Tokenizer

from entityloom.llm.common import give_back

# A task has one core; threads of the library would only hold memory of their own.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Texts are taken together up to so many bytes.
PIECE = 1_500_000
#: Words remembered by a worker process, about 60 bytes each; above it those not met of late are forgotten.
MEMORY_WORDS = 1_300_000
_MARK = "\u241e"
_NO_IDS = np.empty(0, np.uint32)


class _Grown:
    """An array that is appended to."""

    def __init__(self, dtype):
        self.held, self.size = np.empty(1024, dtype), 0

    def add(self, values: np.ndarray) -> None:
        if self.size + len(values) > len(self.held):
            self.held = np.concatenate((self.held[: self.size], np.empty(self.size // 2 + len(values), self.held.dtype)))
        self.held[self.size : self.size + len(values)] = values
        self.size += len(values)

    @property
    def values(self) -> np.ndarray:
        return self.held[: self.size]


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places ``start, start + 1 ..`` of all ranges, one after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


class WordMemory:
    """Ids of words by one or more encoders, remembered in flat arrays.

    A word is found by its 64-bit hash and then compared byte by byte.  ``encoders`` take a list of words
    and give their ids in one array and the number of ids of each.
    """

    def __init__(self, encoders: list[Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]], most: int):
        self.encoders, self.most, self.turn = encoders, most, 0
        self._empty()

    def _empty(self) -> None:
        self.hashes = np.empty(0, np.uint64)
        self.rows = np.empty(0, np.int64)
        self.keys, self.key_ends, self.turns = _Grown(np.uint8), _Grown(np.int64), _Grown(np.int64)
        self.ids = [_Grown(np.uint32) for _ in self.encoders]
        self.id_ends = [_Grown(np.int64) for _ in self.encoders]

    def _span(self, ends: _Grown, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and length of each row."""
        stop = ends.values[rows]
        start = np.where(rows > 0, ends.values[rows - 1], 0)
        return start, stop - start

    def _add(self, hashes: np.ndarray, words: list[bytes], coded: list[tuple[np.ndarray, np.ndarray]]) -> None:
        first = self.key_ends.size
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        self.key_ends.add(np.cumsum(sizes) + self.keys.size)
        self.keys.add(np.frombuffer(b"".join(words), np.uint8))
        self.turns.add(np.full(len(words), self.turn))
        for (flat, counts), ids, ends in zip(coded, self.ids, self.id_ends, strict=True):
            ends.add(np.cumsum(counts) + ids.size)
            ids.add(flat)
        order = np.argsort(hashes, kind="stable")
        at = np.searchsorted(self.hashes, hashes[order])
        self.hashes = np.insert(self.hashes, at, hashes[order])
        self.rows = np.insert(self.rows, at, first + order)

    def _forget(self) -> None:
        """Keep the half that was met last."""
        rows = np.sort(np.argsort(self.turns.values, kind="stable")[self.turns.size - self.most // 2 :])
        words, hashes = self._words(rows), np.empty(self.turns.size, np.uint64)
        hashes[self.rows] = self.hashes
        coded = []
        for ids, ends in zip(self.ids, self.id_ends, strict=True):
            start, length = self._span(ends, rows)
            coded.append((ids.values[_ranges(start, length)], length))
        self._empty()
        self._add(hashes[rows], words, coded)

    def _words(self, rows: np.ndarray) -> list[bytes]:
        start, length = self._span(self.key_ends, rows)
        raw = self.keys.values.tobytes()
        return [raw[s : s + n] for s, n in zip(start.tolist(), length.tolist(), strict=True)]

    def look_up(self, words: list[bytes]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each encoder an array of ids, and the start and number of each word's ids in it; words are distinct."""
        self.turn += 1
        if self.key_ends.size > self.most:
            self._forget()
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
        order = np.argsort(hashes)  # looked up in order, neighbours lie together in memory
        at = np.empty(len(words), np.int64)
        at[order] = np.minimum(np.searchsorted(self.hashes, hashes[order]), max(len(self.hashes) - 1, 0))
        rows = np.full(len(words), -1, np.int64)
        met = np.flatnonzero(self.hashes[at] == hashes) if len(self.hashes) else np.empty(0, np.int64)
        found = self.rows[at[met]]
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        start, length = self._span(self.key_ends, found)
        same_size = length == sizes[met]
        met, found, start, length = met[same_size], found[same_size], start[same_size], length[same_size]
        mine = np.frombuffer(b"".join([words[i] for i in met.tolist()]), np.uint8)
        wrong = np.flatnonzero(self.keys.values[_ranges(start, length)] != mine)
        if len(wrong):  # words that share a hash: the later one is encoded each time
            bad = np.unique(np.searchsorted(np.cumsum(length), wrong, side="right"))
            met, found = np.delete(met, bad), np.delete(found, bad)
        rows[met] = found
        self.turns.held[found] = self.turn
        new = np.flatnonzero(rows < 0)
        if len(new):
            missing = [words[i] for i in new.tolist()]
            rows[new] = self.key_ends.size + np.arange(len(new))
            self._add(hashes[new], missing, [encode(missing) for encode in self.encoders])
        return [(ids.values, *self._span(ends, rows)) for ids, ends in zip(self.ids, self.id_ends, strict=True)]


def split_units(texts: list[str], separator: str = " ") -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct units of texts as bytes, the unit at each place, and the number of places of each text."""
    split = pc.split_pattern(pa.array(texts, pa.string()), separator)
    coded = pc.dictionary_encode(pc.list_flatten(split))
    return coded.dictionary.cast(pa.binary()), coded.indices.to_numpy(), pc.list_value_length(split).to_numpy()


def spread(found: tuple[np.ndarray, np.ndarray, np.ndarray], at: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all places one after another, and where those of each text end."""
    flat, start, length = found
    lengths = length[at]
    ends = np.cumsum(lengths)
    return flat[_ranges(start[at], lengths)], ends[np.cumsum(sizes) - 1]


class Encoder:
    """Ids of texts; one for each worker process and file, see ``encoder``."""

    def __init__(self, path: str, words: int = MEMORY_WORDS):
        self.tokenizer = Tokenizer.from_file(path)
        # Does a blank belong to the next word's ids?  Ask the tokenizer itself.
        ids = lambda s: self.tokenizer.encode(s, add_special_tokens=False).ids
        self.joins_blank = ids("a b") != ids("a") + ids("b")
        # Words are told apart in one call by a mark that the tokenizer treats alone.
        self.mark = "\n" if self.joins_blank else f" {_MARK} "
        self.mark_ids = ids(self.mark)
        self.memory = WordMemory([self._ids_of], words)

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def _marked(self, words: list[str]) -> list[np.ndarray]:
        """Ids of new words.  They go to the library as one text with marks between them."""
        ids = self.tokenizer.encode_batch_fast([self.mark.join(words)], add_special_tokens=False)[0].ids
        flat = np.array(ids, dtype=np.uint32)
        marks = np.flatnonzero(flat == self.mark_ids[-1])
        if len(marks) != len(words) - 1:  # a word holds the mark's last id
            return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        wide = len(self.mark_ids) - 1
        starts = np.concatenate(([0], marks + 1)).tolist()
        stops = np.append(marks - wide, len(flat)).tolist()
        return [flat[a:b] for a, b in zip(starts, stops, strict=True)]

    def _ids_of(self, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words in one array, and how many each has."""
        words = [w.decode() for w in raw]
        out: list[np.ndarray] = [_NO_IDS] * len(words)
        # Words with a newline before them are few; they would be taken for marks.
        for group in ([i for i, w in enumerate(words) if w[:1] != "\n"], [i for i, w in enumerate(words) if w[:1] == "\n"]):
            for s in range(0, len(group), 500):
                part = group[s : s + 500]
                for i, ids in zip(part, self._marked([words[i] for i in part]), strict=True):
                    out[i] = ids
        return np.concatenate([_NO_IDS, *out]), np.fromiter(map(len, out), np.int64, len(out))

    def _is_sure(self, text: str) -> bool:
        """No blanks but space and newline, no control characters, marks or special tokens.

        A byte-level tokenizer joins blanks with the next word; there only single blanks between
        words are sure.
        """
        if not text.replace("\n", " ").isprintable() or "<|" in text or _MARK in text:
            return False
        if not self.joins_blank:
            return True
        return text[0] not in " \n" and text[-1] not in " \n" and not any(x in text for x in ("  ", "\n\n", " \n", "\n "))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        out: list[np.ndarray | None] = [None] * len(texts)
        sure = []
        for i, t in enumerate(texts):
            if t and self._is_sure(t):
                sure.append(i)
            else:
                out[i] = self._whole(t) if t else np.empty(0, np.uint32)
        if sure:
            if self.joins_blank:
                # A mark before each text keeps its first word, without a blank, apart from the same word inside.
                lines = ["\x01" + texts[i].replace("\n", " \n") for i in sure]
            else:
                lines = [texts[i].replace("\n", " ") for i in sure]
            units, at, sizes = split_units(lines)
            words = units.to_pylist()
            if self.joins_blank:
                words = [w if w[:1] == b"\n" else w[1:] if w[:1] == b"\x01" else b" " + w for w in words]
            stream, text_ends = spread(self.memory.look_up(words)[0], at, sizes)
            for i, s, e in zip(sure, np.concatenate(([0], text_ends[:-1])), text_ends, strict=True):
                out[i] = stream[s:e]
        return out


@lru_cache(maxsize=1)
def encoder(path: str, words: int) -> Encoder:
    return Encoder(path, words)


def forget() -> None:
    """Drop the encoder of this worker, for tasks after which the worker goes on to other work."""
    encoder.cache_clear()
    give_back()


def encoded(texts: pa.Array, path: str, words: int = MEMORY_WORDS) -> Iterable[tuple[int, np.ndarray]]:
    """(row, ids) for each text of an Arrow array, NULL as empty; a bounded piece is held at a time."""
    enc, start = encoder(path, words), 0
    while start < len(texts):
        part, size, at = [], 0, start
        while at < len(texts) and size < PIECE:
            part.append(texts[at].as_py() or "")
            size += len(part[-1])
            at += 1
        yield from zip(range(start, at), enc.encode(part), strict=True)
        start = at
    give_back()
