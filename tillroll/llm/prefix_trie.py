"""BPE encoding by a depth-first walk over the trie of distinct words (operator 13).

The encoding of a word's first d letters is that of a shorter beginning plus one last token,
and that last token is the only one that can stand there: of all tokens that end at letter
d, exactly one stays apart from the last token of the beginning before it. So each node of
the trie of words needs one state, its last token, worked out from the states of the nodes
above it, and words that begin alike share these states.

The walk takes the distinct words in sorted order, which is the depth-first order of their
trie; the stack holds the states of the present path. Two tokens stay apart if no merge
across their border comes before the merges that build them from inside.

Pre-tokens come from the library, so that its classes of letters hold; ids do not.
"""

from __future__ import annotations

import functools
import hashlib
import json
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.byte_bpe import JOINED, SPACE, UNLED, chunk_text, split, tokenizer
from tillroll.llm.chunks import ChunkTable, EncodeMany, encode_texts, laid_out

#: Words whose ids a worker keeps; beyond it they are worked out anew.
MAX_WORDS = 500_000
ROWS = 512


def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: itself where it prints,
    else the next letter from 256 on."""
    printing = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printing]
    return {chr(b): b for b in printing} | {chr(256 + i): b for i, b in enumerate(others)}


class _Ending(dict):
    """The longest ending of a path that some token begins with. ``tokens``: all tokens that
    end the path and their lengths, longest first. Looked up with a letter it gives the
    ending of the path with that letter added, worked out when first asked for."""

    __slots__ = ("text", "tokens", "trie")

    def __init__(self, text: str, trie: "Trie") -> None:
        super().__init__()
        self.text, self.trie = text, trie
        ends = (text[i:] for i in range(len(text)))
        self.tokens = [(trie.tokens[end], len(end)) for end in ends if end in trie.tokens]

    def __missing__(self, letter: str) -> "_Ending":
        text = self.text + letter
        while text not in self.trie.beginnings:
            text = text[1:]
        found = self[letter] = self.trie.ending(text)
        return found


class Trie:
    """Encodes words, written in byte letters, over the merges of a byte-level BPE file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocabulary: dict[str, int] = model["vocab"]
        self.parts: dict[int, tuple[int, int]] = {}
        self.made: dict[int, int] = {}
        self.rank: dict[tuple[int, int], int] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            pair = vocabulary[left], vocabulary[right]
            token = vocabulary[left + right]
            self.rank[pair] = rank
            if token not in self.parts:
                self.parts[token], self.made[token] = pair, rank
        self._apart: dict[int, bool] = {}
        # a token that its own letters would not be merged to is never the last one
        self.tokens = {word: i for word, i in vocabulary.items()
                       if len(word) == 1 or (i in self.parts and self._whole(i))}
        self.beginnings = {word[:n] for word in self.tokens for n in range(len(word) + 1)}
        self._endings: dict[str, _Ending] = {}

    def ending(self, text: str) -> _Ending:
        if text not in self._endings:
            self._endings[text] = _Ending(text, self)
        return self._endings[text]

    def _whole(self, token: int) -> bool:
        """Whether the two parts of a token stay apart until its own merge."""
        left, right = self.parts[token]
        return not self._crossed(left, right, self.made[token])

    def _crossed(self, left: int, right: int, before: float) -> bool:
        """Whether a merge across the border of two tokens comes ``before`` that rank. A token
        at the border lasts until the merge that takes it into the next larger part; of two
        places with the same merge, the left one goes first."""
        a, a_ends = left, before
        while True:
            b, b_ends = right, before
            while True:
                rank = self.rank.get((a, b))
                if rank is not None and rank < a_ends and (rank <= b_ends if b_ends < before else rank < before):
                    return True
                if b not in self.parts:
                    break
                b, b_ends = self.parts[b][0], self.made[b]
            if a not in self.parts:
                return False
            a, a_ends = self.parts[a][1], self.made[a]

    def apart(self, key: int) -> bool:
        """Whether two tokens that meet, ``left << 20 | right``, stay as they are."""
        if len(self._apart) > 4 * MAX_WORDS:
            self._apart.clear()
        found = self._apart[key] = not self._crossed(key >> 20, key & 0xFFFFF, float("inf"))
        return found

    def encode(self, words: Iterable[str]) -> dict[str, list[int]]:
        """Ids of each distinct word. Each node of the words' trie is worked out once."""
        apart = self._apart
        last, width, endings = [0], [0], [self.ending("")]  # by depth on the present path
        path, out = "", {}
        for word in sorted(set(words)):
            shared, most = 0, min(len(word), len(path))
            while shared < most and word[shared] == path[shared]:
                shared += 1
            depth = shared + 1
            del last[depth:], width[depth:], endings[depth:]
            ending = endings[shared]
            for letter in word[shared:]:
                ending = ending[letter]
                for token, n in ending.tokens:
                    if n == depth:
                        break
                    key = last[depth - n] << 20 | token
                    if apart[key] if key in apart else self.apart(key):
                        break
                last.append(token)
                width.append(n)
                endings.append(ending)
                depth += 1
            ids, depth = [], len(word)
            while depth:
                ids.append(last[depth])
                depth -= width[depth]
            ids.reverse()
            out[word] = ids
            path = word
        return out


@functools.lru_cache(maxsize=2)
def trie(path: str) -> Trie:
    return Trie(path)


@functools.lru_cache(maxsize=2)
def _specials(path: str) -> dict[str, int]:
    """Added tokens, found in a text before it is cut into words."""
    with open(path, encoding="utf-8") as f:
        added = json.load(f)["added_tokens"]
    for token in added:
        if token["single_word"] or token["lstrip"] or token["rstrip"] or token["normalized"]:
            raise ValueError(f"added token {token['content']!r} does not stand for its plain text")
    return {token["content"]: token["id"] for token in added}


def _words(path: str, text: str) -> list[str | int]:
    """The pre-tokens of a text in byte letters, and the ids of added tokens in it."""
    pre = tokenizer(path).pre_tokenizer
    specials = _specials(path)
    found: list[str | int] = []
    start = 0
    while True:
        at, token = min(((i, -len(s), s) for s in specials if (i := text.find(s, start)) >= 0),
                        default=(len(text), 0, None))[::2]
        found += [word for word, _ in pre.pre_tokenize_str(text[start:at])]
        if token is None:
            return found
        found.append(specials[token])
        start = at + len(token)


class WordIds:
    """A worker's ids of distinct words; cleared when it holds more than MAX_WORDS."""

    def __init__(self, path: str) -> None:
        self.path, self.known = path, {}

    def ids(self, chunks: list[list[str | int]]) -> list[list[int]]:
        if len(self.known) > MAX_WORDS:
            self.known = {}
        known = self.known
        new = {w for words in chunks for w in words if w not in known and isinstance(w, str)}
        known.update(trie(self.path).encode(new))
        out = []
        for words in chunks:
            if len(words) == 1 and words[0] in known:
                out.append(known[words[0]])
            else:
                out.append([i for w in words for i in (known[w] if isinstance(w, str) else (w,))])
        return out


@functools.lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def encode_many(path: str) -> EncodeMany:
    """Chunk keys -> their ids. Words led by a space are cut into pre-tokens in lines of JOINED
    words: only a word's first pre-token begins with a space."""
    def run(keys: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        chunks: list[list[str | int]] = [[]] * len(keys)
        pre, specials = tokenizer(path).pre_tokenizer, _specials(path)
        plain, single = [], []
        for i, key in enumerate(keys):
            (single if key[:1] == UNLED or key.split() != [key] or any(s in key for s in specials)
             else plain).append(i)
        for at in range(0, len(plain), JOINED):
            line = plain[at:at + JOINED]
            cut: list[list[str | int]] = []
            for word, _ in pre.pre_tokenize_str(" " + " ".join([keys[i] for i in line])):
                if word[0] == SPACE:
                    cut.append([word])
                else:
                    cut[-1].append(word)
            if len(cut) == len(line):
                for i, words in zip(line, cut):
                    chunks[i] = words
            else:
                single += line
        for i in single:
            chunks[i] = _words(path, chunk_text(keys[i]))
        return laid_out(word_ids(path).ids(chunks))
    return run


def encode_whole(path: str):
    return lambda text: word_ids(path).ids([_words(path, text)])[0]


@functools.lru_cache(maxsize=2)
def _table(path: str) -> ChunkTable:
    return ChunkTable(encode_many(path))


def encode(texts: list[str], path: str) -> Iterator[np.ndarray]:
    """The ids of each text."""
    return encode_texts(texts, split, encode_whole(path), _table(path))


@functools.lru_cache(maxsize=2)
def _token_bytes(path: str) -> list[bytes]:
    letters = byte_letters()
    vocabulary = tokenizer(path).get_vocab(with_added_tokens=True)
    out = [b""] * (max(vocabulary.values()) + 1)
    for word, i in vocabulary.items():
        out[i] = bytes(map(letters.__getitem__, word))
    return out


def decode(ids: np.ndarray, path: str) -> str:
    """The text of the ids, added tokens too; bytes that are no UTF-8 become U+FFFD."""
    return b"".join(map(_token_bytes(path).__getitem__, ids.tolist())).decode("utf-8", "replace")


def _mapped(docs: DataFrame, path: str, id_col: str, text_col: str, fields: list[T.StructField],
            made) -> DataFrame:
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                texts = part.column("text").to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), *made(texts, list(encode(texts, path)))],
                    names=["id", *[f.name for f in fields]])

    schema = T.StructType([T.StructField("id", texts.schema["id"].dataType), *fields])
    return texts.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def encode_decode(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col``, text (null: empty), ids array<int>, decoded string.

    ``ids`` are the library's without added special tokens; special strings inside a text are
    their own ids. An empty text has no ids. Texts of any length are encoded whole, a few of
    them at a time. Repeated rows give repeated results, a null id is carried through, an
    empty table gives none, and columns other than the two named are not read.
    """
    def made(texts: list[str], arrays: list[np.ndarray]) -> list[pa.Array]:
        return [pa.array(texts, pa.string()),
                pa.array([a.astype(np.int32) for a in arrays], pa.list_(pa.int32())),
                pa.array([decode(a, path) for a in arrays], pa.string())]

    return _mapped(docs, path, id_col, text_col, [
        T.StructField("text", T.StringType()), T.StructField("ids", T.ArrayType(T.IntegerType(), False)),
        T.StructField("decoded", T.StringType())], made)


def digests(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col``, n_tokens, ids_sha256 (of the ids as little-endian
    unsigned 32-bit integers), decoded_sha256 (of the decoded text in UTF-8). The work of
    ``encode_decode``, and its rules for odd rows; ids and texts stay in the Python worker."""
    def made(_: list[str], arrays: list[np.ndarray]) -> list[pa.Array]:
        return [pa.array([len(a) for a in arrays], pa.int64()),
                pa.array([hashlib.sha256(a.astype("<u4").tobytes()).hexdigest() for a in arrays], pa.string()),
                pa.array([hashlib.sha256(decode(a, path).encode()).hexdigest() for a in arrays], pa.string())]

    return _mapped(docs, path, id_col, text_col, [
        T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType())], made)
