import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import words
from tillroll.llm import mixing, ngram_join, quality_lines, topk
from tillroll.llm.components import connected_components


# ---- n-gram join ---------------------------------------------------------------------
def _shingles(text):
    w = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x) for x in words(text)]
    if len(w) < 5:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4))


def _components(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def _brute_join(rows):
    sets = [(d, _shingles(t)) for d, t in rows]
    holders = {}
    for i, (_, s) in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    pairs = []
    for i, (d, s) in enumerate(sets):
        for j, n in Counter(j for x in s for j in holders[x] if j < i).items():
            other = sets[j]
            if d is not None and other[0] is not None and 100 * n >= 75 * (len(s) + len(other[1]) - n):
                pairs.append((d, other[0]))
    of = _components(pairs, {d for d, _ in sets if d is not None})
    return sorted(((d, len(s), of.get(d)) for d, s in sets), key=str)


def _check_join(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(map(tuple, ngram_join.join(df).collect()), key=str)
    assert got == _brute_join(rows)


def test_join_of_near_copies_passages_and_short_texts(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "CHUNK", 8)  # groups of several chunks
    draw = random.Random(4)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = draw.choices(vocabulary, k=40)
    rows = []
    for base in range(6):  # chains and clusters of copies with a few edits each
        text = draw.choices(vocabulary, k=draw.randint(6, 80))
        for copy in range(25 if base == 0 else 6):
            edited = list(text)
            for _ in range(draw.randint(0, max(1, len(text) // 25))):
                edited[draw.randrange(len(edited))] = draw.choice(vocabulary)
            rows.append((len(rows), " ".join(edited)))
    for _ in range(40):  # documents that share a passage
        rows.append((len(rows), " ".join(draw.choices(vocabulary, k=draw.randint(3, 30)) + passage)))
    for n in range(1, 6):
        rows += [(len(rows), " ".join(vocabulary[:n])), (len(rows) + 1, " ".join(vocabulary[:n]).upper())]
    rows += [(len(rows), ""), (len(rows) + 1, None), (3, rows[3][1]), (5, rows[70][1])]
    _check_join(spark, rows)


def test_join_of_copies_that_are_dealt_once(spark, monkeypatch):
    """A text that is a third of the rows, among others that push it out of what a task remembers."""
    monkeypatch.setattr(ngram_join, "DEALT", 3)
    draw = random.Random(21)
    hot = [f"h{i}" for i in range(60)]
    near = [*hot[:-1], "other"]
    rows = []
    for i in range(90):
        own = [f"z{draw.randrange(30)}" for _ in range(draw.randint(1, 40))]
        rows.append((i, " ".join(hot if i % 3 == 0 else near if i % 30 == 1 else own)))
    rows += [(i + 100, rows[draw.randrange(90)][1]) for i in range(30)]
    _check_join(spark, rows)


def test_join_without_grouping_hashes(spark, monkeypatch):
    """Links that no minimum hash brings together are found by the matrix."""
    monkeypatch.setattr(ngram_join, "grouped", lambda sets, percent: sets.select("rep", F.col("rep").alias("grp")).distinct())
    draw = random.Random(8)
    rows = []
    for _ in range(30):
        text = [f"x{draw.randrange(200)}" for _ in range(draw.randint(20, 60))]
        for _ in range(3):
            edited = list(text)
            edited[draw.randrange(len(edited))] = "edit"
            rows.append((len(rows), " ".join(edited)))
    _check_join(spark, rows)


def test_join_of_texts_around_one_passage(spark, monkeypatch):
    """Sets of many sizes that a shared passage fills by more or less than six sevenths."""
    monkeypatch.setattr(ngram_join, "grouped", lambda sets, percent: sets.select("rep", F.col("rep").alias("grp")).distinct())
    draw = random.Random(12)
    passage = [f"p{i}" for i in range(70)]
    rows = []
    for n in range(60):
        own = [f"o{draw.randrange(40)}" for _ in range(n % 30)]
        cut = draw.randint(0, 20)
        rows.append((n, " ".join(own + passage[cut:] if n % 2 else passage[:70 - cut] + own)))
    _check_join(spark, rows)


@pytest.mark.parametrize("frame", ["docs", "odd", "empty"])
def test_join_tables(request, frame):
    df = request.getfixturevalue(frame)
    got = sorted(map(tuple, ngram_join.join(df).collect()), key=str)
    assert got == _brute_join([(r.doc_id, r.text) for r in df.collect()])


def test_word_hashes_do_not_depend_on_place():
    text = "alpha beta gamma delta epsilon zeta " * 60_000
    h, place = ngram_join.word_hashes([text, "", "beta alpha", "x" * 3_000_000 + " alpha"])
    assert len(set(h[:360_000].reshape(-1, 6).T.tolist()[0])) == 1
    assert h[place[2]] == h[1] and h[place[2] + 1] == h[0] and h[-1] == h[0]
    assert place.tolist() == [0, 360_000, 360_000, 360_002, 360_004]


def test_components(spark):
    draw = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 180)] + [(draw.randrange(90), draw.randrange(90)) for _ in range(60)]
    edges += [(7, 7), (180, 100), (300, 299)]
    got = dict(map(tuple, connected_components(spark.createDataFrame(edges, "a long, b long")).collect()))
    want = _components(edges, {n for e in edges for n in e})
    assert all(got.get(n, n) == c for n, c in want.items()) and set(got) <= set(want)
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


# ---- mixing --------------------------------------------------------------------------
@pytest.mark.parametrize("frame", ["docs", "odd", "empty"])
def test_mix(request, frame):
    df = request.getfixturevalue(frame)
    rows = df.collect()
    got = mixing.taken_words(df, block=64, bucket_rows=7).collect()
    assert sorted((str(r.doc_id), r["size"]) for r in got) == sorted((str(r.doc_id), len(words(r.text))) for r in rows)
    sizes = Counter()
    for r in rows:
        sizes[r.source] += len(words(r.text))
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    target = dict(zip(names, mixing.waterfill([sizes[n] for n in names], [(3, 1, 2)[i % 3] for i in range(len(names))],
                                              1.5 * sum(sizes.values()), 2)))
    by_size = {}
    for r in got:
        assert r.taken <= 2 * r["size"]
        by_size.setdefault((r.source_size, r.target), 0)
        by_size[r.source_size, r.target] += r.taken
    assert set(by_size) == {(sizes[n], target[n]) for n in names}
    want = Counter()
    for n in names:
        want[sizes[n], target[n]] += int(target[n])
    assert {k: v for k, v in by_size.items()} == dict(want)
    again = mixing.taken_words(df, block=64, bucket_rows=7).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_waterfill():
    assert mixing.waterfill([10, 10, 10], [3, 1, 2], 45, 2) == [20.0, pytest.approx(25 / 3), pytest.approx(50 / 3)]
    assert mixing.waterfill([0, 5], [3, 1], 7.5, 2) == [0.0, 7.5]
    assert mixing.waterfill([5], [3], 7.5, 2) == [7.5]


def test_schedule_follows_the_targets_everywhere(spark):
    slots = mixing.schedule(spark, [300_000.0, 100_000.0, 200_000.0], 100).orderBy("slot").collect()
    assert [r.slot for r in slots] == list(range(6000))
    seen = Counter()
    for i, r in enumerate(slots, 1):
        assert r["rank"] == seen[r.source_no]
        seen[r.source_no] += 1
        assert all(abs(seen[s] - i * w) < 8 for s, w in ((0, 1 / 2), (1, 1 / 6), (2, 1 / 3)))


def test_mixed_documents(docs):
    rows = {r.doc_id: r for r in docs.collect()}
    placed = {r.doc_id: r.taken for r in mixing.taken_words(docs).collect()}
    got = Counter()
    for r in mixing.mixed_documents(docs).collect():
        got[r.doc_id] += len(words(r.text))
        assert " ".join(words(r.text)) in " ".join(words(rows[r.doc_id].text))
    assert got == {d: n for d, n in placed.items() if n}


# ---- quality -------------------------------------------------------------------------
def _base(text):
    text = text or ""
    w = words(text)
    grams = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if grams[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if words(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
            len(w) < 10 or 100 * len(covered) > 20 * len(w))


@pytest.mark.parametrize("frame", ["docs", "odd", "empty"])
def test_quality_base(request, frame):
    df = request.getfixturevalue(frame)
    got = sorted((str(r[0]), tuple(r[1:7]), r.kept) for r in quality_lines.quality(df).collect())
    assert [g[:2] for g in got] == sorted((str(r.doc_id), _base(r.text)) for r in df.collect())
    assert not any(kept for _, base, kept in got if base[-1])


def test_repeated_windows(spark):
    draw = random.Random(6)
    texts = [" ".join(draw.choices("abc", k=draw.randint(0, 40))) for _ in range(200)]
    texts += [" ".join(["same"] * 30), "\x0ba b\x0cc\rd e a b c d e"]
    df = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    got = {r.doc_id: tuple(r[1:7]) for r in quality_lines.quality(df).collect()}
    assert got == {i: _base(t) for i, t in enumerate(texts)}


def test_lines_of_many_documents_are_removed(spark):
    body = lambda i, n: " ".join(f"w{i}x{j}" for j in range(n))
    common = "please accept our 12 terms and conditions before reading on"
    rows = [(i, f"{body(i, 40)}\n{common}", "a") for i in range(8)]  # little to lose
    rows += [(100 + i, f"{body(100 + i, 5)}\n{common.upper().replace('12', '99')}", "a") for i in range(4)]  # depleted
    rows += [(200 + i, f"{body(200, 20)}\nonly in copies, many of them here", "a") for i in range(30)]  # copies of one text
    rows += [(300 + i, f"{body(300 + i, 5)}\n{common}", None) for i in range(3)]  # another host: rare there
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r for r in quality_lines.quality(df, max_documents=10).collect()}
    assert all(got[i].kept and got[i].removed_words == 10 for i in range(8))
    assert not any(got[100 + i].kept for i in range(4))
    assert all(got[200 + i].kept and got[200 + i].removed_words == 0 for i in range(30))
    assert all(got[300 + i].kept for i in range(3))


@pytest.mark.parametrize("n", [100, 400])
def test_line_limit_follows_the_host(spark, n):
    """Production parameters: the same share of a host's texts counts at every size."""
    letters = str.maketrans("0123456789", "abcdefghij")  # digits would count as equal
    body = lambda i, n: " ".join(f"w{i}x{j}".translate(letters) for j in range(n))
    common, rarer = "please accept our terms and conditions before reading on", "a line that few hold"
    rows = []
    for h, host in enumerate(("a", None)):
        for i in range(n):
            d = 10_000 * h + i
            tail = common if i < n // 10 else rarer if i < n // 10 + n // 25 else ""
            rows.append((d, f"{body(d, 5 if i % 2 else 40)} and some more of them here\n{tail}", host))
    rows += [(90_000 + i, f"{body(90_000, 20)}\nonly in copies, many of them here", "a") for i in range(n // 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r for r in quality_lines.quality(df).collect()}
    for d, text, _ in rows:
        assert got[d].removed_words == (9 if common in text else 0), d
    small = spark.createDataFrame([(i, f"{body(i, 12)}\n{common}", "a") for i in range(5)],
                                  "doc_id long, text string, source string")
    assert all(r.kept and r.removed_words == 0 for r in quality_lines.quality(small).collect())
    # a document of which little but the line is left goes
    odd = spark.createDataFrame([(i, f"{body(i, 4)}\n{common}" if i < 40 else body(i, 20), "a") for i in range(n)],
                                "doc_id long, text string, source string")
    assert {r.doc_id for r in quality_lines.quality(odd).collect() if not r.kept} == set(range(40))


# ---- top-k ---------------------------------------------------------------------------
def _brute_top(rows, k=5):
    good = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, a in [(q, a) for q, a in good if q % 50 == 0]:
        scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in good if i != q and len(a) == len(b))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("kind", ["random", "clusters", "ties", "few"])
def test_top_k(spark, monkeypatch, kind):
    monkeypatch.setattr(topk, "LEAF", 8)
    draw = np.random.default_rng(3)
    n = {"few": 4}.get(kind, 700)
    v = draw.normal(size=(n, 6))
    if kind == "clusters":
        v = v[draw.integers(0, 5, n)] + 0.05 * v
    if kind == "ties":
        v = np.round(v[draw.integers(0, 3, n)])
    rows = [(i, [float(np.float32(x)) for x in a]) for i, a in enumerate(v)]
    rows += [(5000, None), (5050, [1.0, None]), (5100, [float("nan")] * 6), (5150, [float("inf")] * 6),
             (5200, [1.0, 2.0]), (5250, [0.5, 0.5]), (None, [1.0] * 6), (5300, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = topk.top_k(df, df.filter("vec_id % 50 = 0"), shard_rows=100, block_rows=4)
    assert sorted(map(tuple, got.collect())) == _brute_top(rows)


def test_top_k_large_components_and_empty(spark):
    rows = [(50 * i, [float(2 ** 21 + i), float(-i), 3.0]) for i in range(5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = []
    for q, a in rows:
        s = sorted((-sum(int(256 * x) * int(256 * y) for x, y in zip(a, b)), i) for i, b in rows if i != q)
        want += [(q, n + 1, i, -x) for n, (x, i) in enumerate(s)]
    assert sorted(map(tuple, topk.top_k(df, df).collect())) == sorted(want)
    assert topk.top_k(df.limit(0), df.limit(0)).collect() == []


def test_top_k_of_repeated_queries_and_a_hot_id(spark, monkeypatch):
    monkeypatch.setattr(topk, "LEAF", 8)
    v = np.random.default_rng(4).normal(size=(600, 6))
    rows = [(i, [float(np.float32(x)) for x in a]) for i, a in enumerate(v)]
    rows += [rows[0]] * 2 + [rows[50], (100, rows[7][1]), rows[3]]  # queries, one id with two vectors, a candidate
    rows += [(601, rows[9][1])] * 300  # a third of all rows
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = topk.top_k(df, df.filter("vec_id % 50 = 0"), shard_rows=100, block_rows=4)
    assert sorted(map(tuple, got.collect())) == _brute_top(rows)
    trees = topk.shards(topk.quantised(df, "vec_id", "embedding", 256), 100).collect()
    sizes = [len(topk._unpack(r.blob)["ids"]) for r in trees]
    assert sum(sizes) == len(rows) and max(sizes) < 200
