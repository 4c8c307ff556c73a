import hashlib
import random

import numpy as np
import pytest

from tests.llm.test_tokens import PARTS
from tillroll.llm import byte_bpe, prefix_trie
from tillroll.llm.queries import BYTE_BPE, op13_prefix_trie_bpe


def _library(text):
    ids = byte_bpe.tokenizer(BYTE_BPE).encode(text or "", add_special_tokens=False).ids
    return ids, byte_bpe.tokenizer(BYTE_BPE).decode(ids, skip_special_tokens=False)


def _texts():
    draw = random.Random(11)
    for _ in range(3000):
        yield "".join(draw.choices(PARTS, k=draw.randint(0, 25)))
        yield "".join(draw.choices("aeinorstldh   aaabbAEI\x85\x1c🙂\n.,", k=draw.randint(0, 60)))
        yield "".join(chr(draw.choice([draw.randint(0, 0x2ff), draw.randint(0x300, 0xd7ff),
                                       draw.randint(0xe000, 0x1ffff)])) for _ in range(draw.randint(0, 20)))
    yield "a" * 5000 + " " * 300 + "-" * 777 + "ab" * 2000 + "<|endoftext|>" * 3


def test_trie_is_the_library():
    texts = list(_texts())
    for text, ids in zip(texts, prefix_trie.encode(texts, BYTE_BPE)):
        want, decoded = _library(text)
        assert ids.tolist() == want, repr(text)
        assert prefix_trie.decode(ids, BYTE_BPE) == decoded == text


def test_every_token_stays_whole():
    """Each token's own letters are merged to it, so none is left out of the walk."""
    trie = prefix_trie.trie(BYTE_BPE)
    model = byte_bpe.tokenizer(BYTE_BPE).model
    whole = {word: i for word, i in byte_bpe.tokenizer(BYTE_BPE).get_vocab(with_added_tokens=False).items()
             if [t.id for t in model.tokenize(word)] == [i]}
    assert trie.tokens == whole


def test_decoding_of_cut_letters():
    """Ids that end inside a letter decode as the library's do."""
    for ids in ([447], [447, 247], [20543, 447], list(range(100, 256)), []):
        assert prefix_trie.decode(np.array(ids, np.uint32), BYTE_BPE) == \
            byte_bpe.tokenizer(BYTE_BPE).decode(ids, skip_special_tokens=False)


def test_prefixes_are_worked_out_once(monkeypatch):
    """Words that begin alike cost one state for each node of their trie."""
    trie = prefix_trie.Trie(BYTE_BPE)
    words = ["abcdefgh" * 4 + tail for tail in ("", "x", "xy", "xyz", "q")]
    steps = []
    original = prefix_trie._Ending.__getitem__ if "__getitem__" in vars(prefix_trie._Ending) else dict.__getitem__

    class Counted(prefix_trie._Ending):
        def __getitem__(self, letter):
            steps.append(letter)
            try:
                return original(self, letter)
            except KeyError:
                return self.__missing__(letter)

    monkeypatch.setattr(prefix_trie, "_Ending", Counted)
    got = trie.encode(words)
    assert len(steps) == 32 + 3 + 1
    for word in words:
        assert got[word] == _library(word)[0]


@pytest.mark.parametrize("frame", ["docs", "odd", "empty"])
def test_digests(request, frame):
    df = request.getfixturevalue(frame)
    want = []
    for r in df.collect():
        ids, decoded = _library(r.text)
        want.append((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(decoded.encode()).hexdigest()))
    assert sorted(map(tuple, prefix_trie.digests(df, BYTE_BPE).collect()), key=str) == sorted(want, key=str)
    both = sorted(((r.doc_id, r.text, r.ids, r.decoded) for r in prefix_trie.encode_decode(df, BYTE_BPE).collect()), key=str)
    assert both == sorted(((r.doc_id, r.text or "", *_library(r.text)) for r in df.collect()), key=str)


def test_query(spark):
    rows = op13_prefix_trie_bpe(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
    assert set(rows[0].asDict()) == {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"}
