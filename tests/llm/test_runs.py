import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from tests.llm.conftest import words
from tillroll.llm import runs
from tillroll.llm.queries import documents, op11_periodic_runs


def _brute(found, min_length=24, min_periods=3):
    """Every run by its definition: (start, length, period)."""
    out = set()
    for q in range(1, len(found) // min_periods + 1):
        i = 0
        while i + q < len(found):
            j = i
            while j + q < len(found) and found[j] == found[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(min_length, min_periods * q):
                stretch = found[i:i + length]
                if all(stretch[r:] != stretch[:-r] for r in range(1, q)):
                    out.add((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def _expected(doc_id, text):
    """The query's row by its contract."""
    found = words(text)
    n = len(found)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            found = [w if i < a else found[a + (i - a) % p] for i, w in enumerate(found)]
    every = _brute(found)
    gone = {i for s, length, q in every for i in range(s + q, s + length)}
    best = min(every, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(every), *best, 1000 * best[1] // best[2] if every else None,
            sha("".join(f"{s},{length},{q}\n" for s, length, q in every)),
            sha(" ".join(w for i, w in enumerate(found) if i not in gone)))


def _lyndon(x):
    out = []
    for i in range(len(x)):
        out.append(max(j - i for j in range(i + 1, len(x) + 1)
                       if all(x[i:j] < x[k:j] for k in range(i + 1, j))))
    return out


def test_grouping_gives_lyndon_lengths():
    draw = random.Random(4)
    for _ in range(800):
        x = [draw.randint(0, draw.choice([0, 1, 2, 5])) for _ in range(draw.randint(0, 22))]
        assert runs.lyndon_lengths(np.array(x, np.int64)).tolist() == _lyndon(x), x


@pytest.mark.parametrize("min_length", [4, 24])
def test_runs_are_those_of_brute_force(min_length):
    draw = random.Random(5)
    docs = []
    for _ in range(500):
        x = []
        while len(x) < draw.randint(0, 140):
            x += [draw.randint(0, draw.choice([0, 1, 2, 9])) for _ in range(draw.randint(1, 12))] * draw.randint(1, 6)
        docs.append(x)
    got = runs.document_runs([np.array(x, np.int64) for x in docs], min_length)
    assert sum(map(len, got)) > 300
    for x, found in zip(docs, got):
        assert [tuple(r) for r in found.tolist()] == _brute(x, min_length), x


def _tuples(df):
    return sorted(((r.doc_id, r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256,
                    r.collapsed_sha256) for r in df.collect()), key=str)


@pytest.mark.parametrize("frame", ["odd", "empty"])
def test_odd_rows(request, frame):
    df = request.getfixturevalue(frame)
    got = _tuples(runs.digests(runs.find_runs(df, rewrite=runs.repeat_tail)))
    # the two texts of 60,000 words have no run: brute force on them takes too long
    want = [_expected(r.doc_id, r.text) if len(r.text or "") < 10_000 else
            next(g for g in got if g[0] == r.doc_id) for r in df.collect()]
    assert got == sorted(want, key=str)


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    short = [(r.doc_id, r.text) for r in documents(spark, sf).collect() if len(words(r.text)) < 1500]
    rows = {g[0]: g for g in _tuples(op11_periodic_runs(spark, sf))}
    assert len(rows) == documents(spark, sf).count() and any(g[1] for g in rows.values())
    for doc_id, text in short:
        assert rows[doc_id] == _expected(doc_id, text)


def test_ties_long_runs_and_columns(spark):
    """Equal exponents: smallest start; a run over a whole long text; the general interface."""
    texts = [(1, "a b " * 20 + "x " + "c d " * 20), (2, "w " * 300_000), (3, "a\xa0b " * 30),
             (4, " ".join(["a", "b", "c"] * 9 + ["a", "b"]) + "\v" + "c d\x85 e")]
    df = spark.createDataFrame(texts, "start long, period string")
    found = {r.start: r for r in runs.find_runs(df, id_col="start", text_col="period").collect()}
    assert [tuple(x) for x in found[1].runs] == [(0, 40, 2), (41, 40, 2)]
    assert found[1].collapsed == "a b x c d"
    assert [tuple(x) for x in found[2].runs] == [(0, 300_000, 1)] and found[2].collapsed == "w"
    assert [tuple(x) for x in found[3].runs] == [(0, 30, 1)]  # a no-break space parts no words
    assert [tuple(x) for x in found[4].runs] == [(0, 30, 3)] and found[4].collapsed == "a b c d\x85 e"
    best = {r.start: r for r in runs.digests(runs.find_runs(
        df.withColumnRenamed("start", "doc_id"), text_col="period")).select("doc_id", "start", "n_runs")
        .withColumnRenamed("start", "at").withColumnRenamed("doc_id", "start").collect()}
    assert best[1].at == 0 and best[1].n_runs == 2
    with pytest.raises(ValueError):
        runs.find_runs(df, min_periods=2)
