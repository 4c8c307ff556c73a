import hashlib
import random
import zlib

import numpy as np
import pytest

from tillroll.llm import binary_ids, byte_bpe, chunks, sentence_pieces, token_counts
from tillroll.llm.queries import BYTE_BPE, PIECES
from tillroll.llm.storage import new_path

PARTS = list("ab. ,;:!?'\n\n  \t\xa0 é5²中_-)(\"<|▁") + ["'s", "'ll", "<|endoftext|>", "the "]


def _texts(n=4000):
    draw = random.Random(3)
    return ["".join(draw.choices(PARTS, k=draw.randint(0, 25))) for _ in range(n)]


def _bpe(text):
    return byte_bpe.tokenizer(BYTE_BPE).encode(text or "", add_special_tokens=False).ids


def test_chunked_bpe_is_the_library():
    texts = _texts()
    table = chunks.ChunkTable(byte_bpe.encode_many(BYTE_BPE), max_entries=500)
    got = chunks.encode_texts(texts, byte_bpe.split, byte_bpe.encode_whole(BYTE_BPE), table)
    for text, ids in zip(texts, got):
        assert ids.tolist() == _bpe(text), repr(text)
    counted = chunks.ChunkTable(byte_bpe.encode_many(BYTE_BPE), keep_ids=False, max_entries=500, seed={"a": 1})
    n = chunks.count_texts(texts, byte_bpe.split, byte_bpe.encode_whole(BYTE_BPE), counted)
    assert n.tolist() == [len(_bpe(t)) for t in texts]


def test_chunked_pieces_are_the_library():
    texts = _texts()
    sp = sentence_pieces.processor(PIECES)
    assert sentence_pieces.can_split(PIECES)
    table = chunks.ChunkTable(sentence_pieces.encode_many(PIECES), max_entries=500)
    got = chunks.encode_texts(texts, sentence_pieces.split, sentence_pieces.encode_whole(PIECES), table)
    for text, ids in zip(texts, got):
        assert ids.tolist() == sp.encode(text), repr(text)


@pytest.mark.parametrize("frame", ["docs", "odd", "empty"])
def test_token_counts(request, frame):
    df = request.getfixturevalue(frame)
    got = sorted(map(tuple, token_counts.token_counts(df, BYTE_BPE, limit=5).collect()), key=str)
    want = [(r.doc_id, len((r.text or "").encode()), len(_bpe(r.text)), len(_bpe(r.text)) > 5) for r in df.collect()]
    assert got == sorted(want, key=str)


def test_token_counts_of_pieces(odd):
    sp = sentence_pieces.processor(PIECES)
    got = sorted((r.doc_id or 0, r.n_tokens) for r in token_counts.token_counts(odd, PIECES).collect())
    assert got == sorted((r.doc_id or 0, len(sp.encode(r.text or ""))) for r in odd.collect())


@pytest.mark.parametrize("frame", ["docs", "odd", "empty"])
def test_pieces_and_digests(request, frame):
    df = request.getfixturevalue(frame)
    sp = sentence_pieces.processor(PIECES)
    want = []
    for r in df.collect():
        ids = [1, *sp.encode(r.text or ""), 2]
        want.append((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(sp.decode(ids).encode()).hexdigest()))
    assert sorted(map(tuple, sentence_pieces.digests(df, PIECES).collect()), key=str) == sorted(want, key=str)
    both = {(r.doc_id, r.text): (r.ids, r.decoded) for r in sentence_pieces.encode_decode(df, PIECES).collect()}
    for r in df.collect():
        ids = [1, *sp.encode(r.text or ""), 2]
        assert both[(r.doc_id, r.text or "")] == (ids, sp.decode(ids))


@pytest.mark.parametrize("counts", [[5, 1, 1, 0, 7, 3], [1], [0, 4, 0], [2, 2], list(range(1, 400)), [1 << i for i in range(30)]])
def test_code_lengths_are_prefix_free_and_limited(counts):
    lengths = binary_ids.code_lengths(np.array(counts), max_length=12)
    used = lengths[np.array(counts) > 0]
    assert ((lengths > 0) == (np.array(counts) > 0)).all() and used.max() <= 12
    assert sum(2.0 ** -int(n) for n in used) <= 1 + 1e-12


def test_code_lengths_are_optimal():
    import heapq
    counts = np.random.default_rng(5).integers(1, 10_000, 300)
    heap = list(map(int, counts))
    heapq.heapify(heap)
    cost = 0
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        cost += both
        heapq.heappush(heap, both)
    assert int((binary_ids.code_lengths(counts, 18).astype(int) * counts).sum()) == cost


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 5000])
def test_pack_round_trip(n):
    draw = np.random.default_rng(n)
    ids = np.minimum(draw.geometric(0.02, n), 900).astype(np.uint32)
    lengths = binary_ids.code_lengths(np.bincount(ids, minlength=1000), 18)
    bits, offsets = binary_ids.pack(ids, binary_ids.canonical_codes(lengths), lengths)
    table = np.concatenate((lengths, np.zeros(24, np.uint8))).tobytes()
    assert (binary_ids.unpack(bits, offsets, n, table) == ids).all()


@pytest.mark.parametrize("frame", ["docs", "odd", "empty"])
def test_binary_ids_round_trip(spark, request, frame):
    df = request.getfixturevalue(frame)
    out = new_path(spark, "test")
    binary_ids.write_ids(df, BYTE_BPE, out)
    got = sorted(binary_ids.read_ids(spark, out).collect(), key=lambda r: r.start)
    want = sorted(((r.doc_id, [*_bpe(r.text), 0]) for r in df.collect()),
                  key=lambda x: (x[0] is not None, x[0] or 0, np.array(x[1], "<u2").tobytes()))
    start = 0
    assert len(got) == len(want)
    for r, (doc_id, ids) in zip(got, want):
        assert (r.doc_id, r.start, r.n_tokens, r.ids) == (doc_id, start, len(ids), ids)
        start += len(ids)
    crc = {(r.doc_id, r.start): r.ids_crc32
           for r in binary_ids.read_ids(spark, out, binary_ids.crc32_of, "ids_crc32 long").collect()}
    for r in got:
        assert crc[(r.doc_id, r.start)] == zlib.crc32(np.array(r.ids, "<u4").tobytes())


def test_chunks_of_a_worker_are_encoded_once():
    """900,000 distinct words, twice over: each is encoded once, and repeated words get one code."""
    table, encoded = byte_bpe.id_table.__wrapped__(BYTE_BPE), []

    def one_id_each(keys):
        encoded.append(len(keys))
        return np.arange(len(keys), dtype=np.uint32), np.arange(len(keys)), np.ones(len(keys), np.int64)

    table.encode_many = one_id_each
    words = [f"w{i}" for i in range(900_000)]
    for first in (0, 300_000, 600_000) * 2:
        some = words[first:first + 300_000]
        codes = table.lookup(some + some[:5] + ["w0", "w0"])
        assert codes[:5].tolist() == codes[300_000:300_005].tolist() and codes[-1] == codes[-2]
        assert len(set(codes.tolist())) == 300_000 + (first > 0)
    assert encoded == [300_000] * 3
    assert table.lookup([]).tolist() == []


def test_marked_texts_are_the_library():
    """Chunk keys cut by Arrow give the library's ids, slice by slice, empty texts among them."""
    texts = _texts() + [""] * 3
    table = byte_bpe.id_table.__wrapped__(BYTE_BPE)
    for some in (texts, texts[:1], [""], ["a  b"], []):
        got = chunks.encode_texts(some, byte_bpe.marked, byte_bpe.encode_whole(BYTE_BPE), table)
        assert [ids.tolist() for ids in got] == [_bpe(t) for t in some]
