import hashlib

import numpy as np

import __spark_entry__
import corpus_pipeline
from tests.llm.conftest import SF, words
from tests.llm.test_corpus import _brute_join
from tillroll.llm import language_id, mixing, ngram_join, pii, sentence_pieces
from tillroll.llm.queries import PIECES


def test_registered():
    keys = list(__spark_entry__.queries())
    assert [k for k in keys if k.startswith("op")] == [
        "op1_top_k", "op2_html_text", "op3_mixing", "op4_sentence_pieces", "op5_language_id", "op6_pii",
        "op7_ngram_join", "op8_binary_ids", "op9_token_counts", "op10_quality_lines",
        "op11_periodic_runs", "op12_turn_repair", "op13_prefix_trie_bpe"]
    assert "pipeline" in keys and "q32" in keys
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "personal_data", "mix", "pieces"]


def test_run_equals_brute_force(spark, docs):
    """The stages by plain Python over the whole table, each on what the last one kept."""
    rows = {r.doc_id: r for r in docs.collect()}
    model = language_id.train(docs)
    kept = {}
    for d, r in sorted(rows.items()):
        (name,), _ = language_id.predict([r.text or ""], model)
        if any(c.isalpha() for c in r.text or ""):  # all that have a letter stay
            assert name != "und"
            kept[d] = r.text
    assert len(kept) > 0.9 * len(rows)
    first = {d for d, _, c in _brute_join(list(kept.items())) if d == c}
    finder = pii.Finder(pii.train())
    masked = {}
    for d in first:
        ((_, every),) = pii.spans([kept[d]], finder)
        masked[d] = pii.masked(kept[d], every)
    frame = spark.createDataFrame([(d, t, rows[d].source) for d, t in masked.items()], "doc_id long, text string, source string")
    taken = {r.doc_id: r.taken for r in mixing.taken_words(frame).collect()}
    assert sum(taken.values()) > 1.4 * sum(len(words(t)) for t in masked.values())
    sp = sentence_pieces.processor(PIECES)
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in got} == {d for d, n in taken.items() if n}
    for r in got:
        text = masked[r.doc_id]
        n = len(words(text))
        decoded = sp.decode(r.ids)
        assert r.n_tokens == len(r.ids) and r.ids[0] == 1 and r.ids[-1] == 2
        assert r.ids_sha256 == hashlib.sha256(np.array(r.ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
        if taken[r.doc_id] in (n, 2 * n):
            assert decoded == text
        else:
            assert " ".join(words(decoded)) in " ".join(words(text))


def test_stages_keep_the_columns_and_odd_rows(spark, odd, empty):
    docs = odd
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert tuple(out.columns) == corpus_pipeline.COLUMNS, name
        out.collect()
    assert corpus_pipeline.near_duplicates(spark, odd, SF).filter("doc_id is null").count() == 2
    assert sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, odd, SF).filter("doc_id is not null").collect()) \
        == [1, 2, 3, 4, 5, 7, 8, 9, 10, 11]
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).collect() == [], name


def test_null_and_repeated_ids_lose_nothing(spark):
    text = lambda name, n: " ".join(f"{name}{i}" for i in range(n))
    rows = [(None, text("a", 40), "s"), (None, text("b", 30), "s"), (None, text("c", 20), None), (7, text("d", 50), "s"),
            (7, text("e", 25), "s"), (7, text("e", 25), "s"), (8, text("f", 35), "t"), (9, text("f", 35), "t")]
    df = spark.createDataFrame([(d, t, "en", s, len(t)) for d, t, s in rows],
                               "doc_id long, text string, lang string, source string, n_chars long")
    first = corpus_pipeline.near_duplicates(spark, df, SF)
    kept = [r.text for r in first.collect()]
    assert sorted(kept) == sorted({t for _, t, _ in rows})  # of the exact copies of a row, and of 8 and 9, one
    want = {}  # taken words by text: the mix's own count
    for r in mixing.taken_words(first).collect():
        want[str(r.doc_id), r["size"]] = r.taken
    got = {}
    for r in corpus_pipeline.mix(spark, first, SF).collect():
        whole = next(t for t in kept if r.text in t)
        key = str(r.doc_id), len(words(whole))
        got[key] = got.get(key, 0) + len(words(r.text))
    assert got == {k: n for k, n in want.items() if n}
    assert sum(got.values()) == 300 and {k[0] for k in got} == {"None", "7", "8"}


def test_language_rejects_texts_without_letters(spark, odd):
    kept = {r.doc_id for r in corpus_pipeline.language(spark, odd, SF).collect()}
    assert not kept & {1, 2, 3, 8} and {4, 10, 12} <= kept


def test_personal_data_masks_and_keeps(spark):
    df = spark.createDataFrame([(1, "write ann@example.org or 10.1.2.3", "en", "a", 3), (2, None, None, None, None)],
                               "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.personal_data(spark, df, SF).orderBy("doc_id").collect()
    assert [(r.text, r.n_chars) for r in got] == [("write <email> or <ip>", 21), (None, None)]


def test_join_is_the_operator(docs):
    assert ngram_join.join(docs).count() == docs.count()
