"""Byte-level BPE of the tokenizers library, chunk by chunk.

The byte-level pre-tokenizer lets a single space lead the word behind it and never joins a
word to the space after it. Cutting before a space therefore keeps every pre-token whole,
unless a run of white space holds two or more spaces: there the run itself is one
pre-token and a cut inside it would change the ids. Such texts are encoded whole. Two more
cuts that fall between pre-tokens make the distinct chunks fewer: around single line
breaks, and between a letter or digit and a comma or full stop that ends the word.
"""

from __future__ import annotations

import functools
import os
import re

import numpy as np

from tillroll.llm.chunks import ChunkTable, EncodeMany, laid_out

#: Marks the keys of chunks that no space leads: a private character, not taken from texts.
UNLED = "\ue000"
#: How byte-level vocabularies write a space.
SPACE = "\u0120"
#: New words that are encoded as one line.
JOINED = 256
_SPACE_RUN = re.compile(r" \s* ")
_BREAK_SPACE, _SPACE_BREAK = re.compile(r"\n\s"), re.compile(r"[^\S\n]\n")
# searches for one fixed set of characters are several times faster than those for a class
_OTHER_SPACE = re.compile("[" + "".join(chr(i) for i in range(0x3001) if chr(i).isspace() and chr(i) not in " \n") + "]")
#: A comma or full stop behind a sign or white space.
_BESIDE_SIGN = re.compile(r"[,.](?<=[\W_].)")


@functools.lru_cache(maxsize=4)
def tokenizer(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs one worker per core
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


def marked(text: str) -> str | None:
    """The text's chunk keys, a space between any two: a word stands for itself led by a space,
    a key that begins with UNLED for the rest of it. None for texts whose chunks are not
    independent."""
    if UNLED in text:
        return None
    if _OTHER_SPACE.search(text):
        runs, beside = _SPACE_RUN.search(text), _BREAK_SPACE.search(text) or _SPACE_BREAK.search(text)
    else:  # spaces and line breaks alone
        beside = "\n\n" in text or "\n " in text or " \n" in text
        runs = "  " in text or (beside and _SPACE_RUN.search(text))
    if runs:
        return None
    # not where a line break stands beside other white space or at an end
    if not beside and "\n" in text and text[0] != "\n" and text[-1] != "\n":
        text = text.replace("\n", f" {UNLED}\n {UNLED}")
    # not where a comma or full stop follows another sign, which it may be joined to
    if text and text[0] not in ",." and not _BESIDE_SIGN.search(text):
        text = text.replace(", ", f" {UNLED}, ").replace(". ", f" {UNLED}. ")
    return UNLED + text


def split(text: str) -> list[str] | None:
    """The chunk keys of ``marked`` as a list."""
    keys = marked(text)
    return None if keys is None else keys.split(" ")


def chunk_text(key: str) -> str:
    return key[1:] if key.startswith(UNLED) else " " + key


def encode_whole(path: str):
    return lambda text: tokenizer(path).encode(text, add_special_tokens=False).ids


@functools.lru_cache(maxsize=4)
def _opens_with_space(path: str) -> np.ndarray:
    """For each id whether its token begins with a space."""
    vocabulary = tokenizer(path).get_vocab()
    opens = np.zeros(max(vocabulary.values()) + 1, bool)
    opens[[i for token, i in vocabulary.items() if token.startswith(SPACE)]] = True
    return opens


def encode_many(path: str) -> EncodeMany:
    """Chunk keys -> their ids. Words led by a space and without other white space are
    encoded as lines of JOINED words: such a word's first token, and no other, begins with a
    space, which shows where each word's ids begin. All other keys, and the words of a line
    that doesn't hold to that, are encoded by themselves."""
    def encoded(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return laid_out([e.ids for e in tokenizer(path).encode_batch_fast(texts, add_special_tokens=False)])

    def run(keys: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        starts, lengths = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        single = [i for i, key in enumerate(keys) if key[:1] == UNLED]
        plain = [i for i, key in enumerate(keys) if key[:1] != UNLED]
        lines, joined = [], []
        for at in range(0, len(plain), JOINED):
            line = plain[at:at + JOINED]
            text = " ".join([keys[i] for i in line])
            if "  " in text or len(text.split()) != len(line):  # empty words, or white space in one
                single += [i for i in line if keys[i].split() != [keys[i]]]
                line = [i for i in line if keys[i].split() == [keys[i]]]
                text = " ".join([keys[i] for i in line])
            lines.append(line)
            joined.append(" " + text)
        flat, _, sizes = encoded(joined)
        first = np.flatnonzero(_opens_with_space(path)[flat])
        ends = np.cumsum(sizes)
        opened = np.diff(np.searchsorted(first, np.concatenate(([0], ends))))
        at = 0
        for line, n, end in zip(lines, opened.tolist(), ends.tolist()):
            if line and n == len(line):
                begin = first[at:at + n]
                starts[line] = begin
                lengths[line] = np.diff(begin, append=end)
            else:
                single += line
            at += n
        alone, begin, sizes = encoded([chunk_text(keys[i]) for i in single])
        starts[single], lengths[single] = len(flat) + begin, sizes
        return np.concatenate((flat, alone)), starts, lengths
    return run


@functools.lru_cache(maxsize=2)
def id_table(path: str) -> ChunkTable:
    """This worker's table of chunk ids: a larger one, so that few chunks are encoded again."""
    return ChunkTable(encode_many(path), max_entries=1_000_000)
