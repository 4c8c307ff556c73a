"""Tables of distinct text chunks, kept per Python worker.

A tokenizer whose pieces never span a chunk boundary gives the same ids chunk by chunk as
over the whole text. Natural text repeats its chunks, so each distinct chunk is encoded
once per worker and the ids are put back by position with numpy gathers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are worked on in slices of about this many characters, which bounds a worker's memory.
SLICE_CHARS = 1_000_000

#: Chunk keys -> all their ids, and where among these each key's begin and how many they are.
EncodeMany = Callable[[list[str]], tuple[np.ndarray, np.ndarray, np.ndarray]]


def laid_out(found: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A list of id lists in the form of EncodeMany."""
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    flat = np.fromiter(chain.from_iterable(found), np.uint32, int(lengths.sum()))
    return flat, np.cumsum(lengths) - lengths, lengths


class ChunkTable:
    """Distinct chunks with their ids (``keep_ids``) or only the number of their ids.

    ``encode_many`` turns a list of chunk keys into ids. A table of more
    than ``max_entries`` chunks is cut back to its most used ones, so that a worker's memory
    stays bounded; that changes only how often a chunk is encoded, never a result.
    """

    def __init__(self, encode_many: EncodeMany, keep_ids: bool = True,
                 max_entries: int = 500_000, seed: dict[str, int] | None = None) -> None:
        self.encode_many, self.keep_ids, self.max_entries = encode_many, keep_ids, max_entries
        self.seed = seed or {}
        self._clear()

    def _clear(self) -> None:
        self.codes: dict[str, int] = {}  # in the order of the codes
        self.lengths = np.zeros(1024, np.int64)
        self.starts = np.zeros(1024, np.int64)
        self.ids = np.zeros(8192, np.uint32)
        self.uses = np.zeros(1024, np.int64)
        self.used = 0
        if self.seed:
            self.codes.update(zip(self.seed, range(len(self.seed))))
            self._room(len(self.codes))
            self.lengths[: len(self.seed)] = np.fromiter(self.seed.values(), np.int64, len(self.seed))

    def _cut_back(self) -> None:
        """Keep the chunks that were used most, at most half of ``max_entries`` of them."""
        words = list(self.codes)
        uses = self.uses[: len(words)]
        top = np.argsort(-uses, kind="stable")[: self.max_entries // 2]
        top = top[uses[top] > 1]
        kept, lengths = [words[i] for i in top], self.lengths[top]
        ids, _ = self.gather(top) if self.keep_ids else (None, None)
        seed, self.seed = self.seed, {}
        self._clear()
        self.seed = seed
        self.codes = dict(zip(kept, range(len(kept))))
        self._room(len(kept))
        self.lengths[: len(kept)] = lengths
        if self.keep_ids:
            self.ids, self.used = ids.copy(), len(ids)
            self.starts[: len(kept)] = np.cumsum(lengths) - lengths

    def _room(self, entries: int) -> None:
        if entries > len(self.lengths):
            size = 2 * entries
            self.lengths = np.resize(self.lengths, size)
            self.starts = np.resize(self.starts, size)
            old, self.uses = self.uses, np.zeros(size, np.int64)
            self.uses[: len(old)] = old

    def _add(self, words: list[str]) -> None:
        first = len(self.codes) - len(words)
        self._room(len(self.codes))
        flat, starts, lengths = self.encode_many(words)
        self.lengths[first:first + len(words)] = lengths
        if self.keep_ids:
            if self.used + len(flat) > len(self.ids):
                self.ids = np.resize(self.ids, 2 * (self.used + len(flat)))
            self.ids[self.used:self.used + len(flat)] = flat
            self.starts[first:first + len(words)] = self.used + starts
            self.used += len(flat)

    def lookup(self, words: list[str] | pa.Array) -> np.ndarray:
        """Codes of the words; unknown words are encoded first. Arrow finds the distinct words,
        so that each of these is looked up once however often it comes."""
        if len(self.codes) > self.max_entries:
            self._cut_back()
        found = (words if isinstance(words, pa.Array) else pa.array(words, pa.large_string())).dictionary_encode()
        distinct, at = found.dictionary.to_numpy(zero_copy_only=False).tolist(), found.indices.to_numpy()
        codes = np.fromiter(map(self.codes.get, distinct, repeat(-1)), np.int64, len(distinct))
        unknown = np.flatnonzero(codes < 0)
        if len(unknown):
            new = [distinct[i] for i in unknown.tolist()]
            first = len(self.codes)
            codes[unknown] = np.arange(first, first + len(new))
            self.codes.update(zip(new, range(first, first + len(new))))
            self._add(new)
        self.uses[codes] += np.bincount(at, minlength=len(distinct))
        return codes[at]

    def gather(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the coded chunks in order, and the number of ids of each chunk."""
        lengths = self.lengths[codes]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        at = np.repeat(self.starts[codes] - (ends - lengths), lengths)
        at += np.arange(total)
        return self.ids[at], lengths


def slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Index ranges over ``texts`` of about SLICE_CHARS characters, at least one text each."""
    start = chars = 0
    for i, text in enumerate(texts):
        chars += len(text)
        if chars >= SLICE_CHARS:
            yield start, i + 1
            start, chars = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def _cut(parts: list[list[str] | str]) -> tuple[list[str] | pa.Array, list[int]]:
    """The chunk keys of all parts, and where each part's begin and end among them. Parts that
    are texts are cut at their spaces, by Arrow."""
    if parts and isinstance(parts[0], str):
        cut = pc.split_pattern(pa.array(parts, pa.large_string()), " ")
        return cut.flatten(), cut.offsets.to_pylist()
    return list(chain.from_iterable(parts)), [0, *np.cumsum(list(map(len, parts))).tolist()]


def encode_texts(texts: list[str], split: Callable[[str], list[str] | str | None],
                 whole: Callable[[str], Iterable[int]], table: ChunkTable) -> Iterator[np.ndarray]:
    """The ids of each text. ``split`` gives a text's chunk keys (a list, or in one text with a
    space between any two), or None for a text whose chunks are not independent; such a text
    is encoded by ``whole``."""
    for start, end in slices(texts):
        parts = [split(text) for text in texts[start:end]]
        words, bounds = _cut([p for p in parts if p is not None])
        ids, lengths = table.gather(table.lookup(words))
        ends = np.concatenate(([0], np.cumsum(lengths)))[bounds].tolist()
        n = 0
        for text, p in zip(texts[start:end], parts):
            if p is None:
                yield np.fromiter(whole(text), np.uint32)
            else:
                yield ids[ends[n]:ends[n + 1]]
                n += 1


def count_texts(texts: list[str], split: Callable[[str], list[str] | None],
                whole: Callable[[str], Iterable[int]], table: ChunkTable) -> np.ndarray:
    """The number of ids of each text, as ``encode_texts`` would give."""
    counts = np.zeros(len(texts), np.int64)
    for start, end in slices(texts):
        parts = [split(text) for text in texts[start:end]]
        words = [w for p in parts if p is not None for w in p]
        codes = table.lookup(words)  # may enlarge the table's arrays
        sums = np.concatenate(([0], np.cumsum(table.lengths[codes])))
        word = 0
        for i, p in enumerate(parts, start):
            if p is None:
                counts[i] = len(list(whole(texts[i])))
            else:
                counts[i] = sums[word + len(p)] - sums[word]
                word += len(p)
    return counts
