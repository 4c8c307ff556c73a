import hashlib
import random
import re

import numpy as np
import pytest

from pyspark.sql import functions as F

from tillroll.llm import html_text, language_id, pii

# ---- pages ---------------------------------------------------------------------------
TREE = html_text.train_tree(*html_text.labelled_rows())


def test_tree_learns_its_table():
    x, y = html_text.labelled_rows()
    assert (html_text.classify(TREE, x) == y.astype(bool)).all()


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("just words, no markup", "just words, no markup"),
    ("<p>a &amp; b&nbsp;c &lt;d&gt; &#233;<p>next\n  line", "a & b c <d> é next line"),
    ("<article><p>in<b>side</b> one<p>two <!-- no --> three<script>var x='</p>';</script></article><footer>f</footer>",
     "inside one two three"),
    ("<nav><a href='x'>m</a></nav><main><h1>T</h1><p>x &lt; y</p><aside>s</aside></main><div class=ad>buy</div>", "T x < y"),
    ("<article><p>kept</p><div class='comments'><p>first comment, long enough to be text</p></div></article>", "kept"),
    ("<article><p>unclosed <b>tags <i>here<p>and a cut <a href='x", "unclosed tags here and a cut"),
    ("<article><p title=\"a > b\">quoted</p></article><form><p>Your mail</p></form>", "quoted"),
    ("<article><p>a<span class='ad'>buy</span> b</p></article>", "a b"),
    ("<article><p>one<br>two</p></article><!-- never closed <p>x</p>", "one two"),
    ("<title>t</title><article><textarea>x</textarea><p>y", "y"),
    ("<p>1 < 2 and 3 > 2</p>", "1 < 2 and 3 > 2"),
])
def test_main_text(page, text):
    assert html_text.main_text(page, TREE) == text


def test_broken_markup_does_not_crash():
    draw = random.Random(5)
    parts = ["<", ">", "<p", "</p>", "<a href='", "\"", "</", "<!--", "-->", "x y", "&amp", "<script>", "<div class=ad>", "/>"]
    for _ in range(2000):
        html_text.main_text("".join(draw.choices(parts, k=12)), TREE)


def test_extract_rows(spark):
    pages = [(1, "u", None, "x"), (1, "u", None, "x"), (None, None, "<p>word here</p>", "y"), (2, "v", "<p>" + "long text " * 50_000, "z")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, text string")
    got = sorted((r.page_id or 0, r.url or "", r.n_chars, r.text[:9]) for r in html_text.extract(df).collect())
    assert got == [(0, "", 9, "word here"), (1, "u", 0, ""), (1, "u", 0, ""), (2, "v", 499_999, "long text")]
    assert html_text.extract(df.limit(0)).collect() == []


# ---- personal data -------------------------------------------------------------------
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _digits(s):
    return re.sub("[^0-9]", "", s)


def _luhn(d):
    doubled = [int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))]
    return sum(doubled) % 10 == 0


def _base(text):
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 14 <= len(_digits(m[0])) <= 19 and _luhn(_digits(m[0]))]
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    return sorted(out)


def test_base_spans_random():
    draw = random.Random(9)
    parts = ["a", "b.c", "@", "x.org", ".", "-", " ", "1", "25", "255", "256", "4111 1111 1111 1111", "+1", "(678)", " 555-5272",
             "é", "5500-0000-0000-0004", "10.0.0.1", "user@mail.example.com", "007.1.2.3", "\n"]
    for _ in range(20_000):
        text = "".join(draw.choices(parts, k=draw.randint(1, 12)))
        assert pii.base_spans(text) == _base(text), repr(text)


def test_crf_finds_other_forms_and_leaves_numbers_alone():
    finder = pii.Finder(pii.train())
    texts = ["please call (555) 123-4567 today or write", "the cell is 415-555-0132 now", "in the year 1999 and on page 12 of 300",
             "it cost 12.50 or 1,000 in 2020", "no numbers in here at all", "mail [x] card 3782 822463 10005 expired",
             "write to bob@host for more", "a 4 digit 2024 year and 7 8 9 10"]
    found = [[pii.KINDS[k] for _, k, _ in spans] for _, spans in pii.spans(texts, finder)]
    assert found == [["phone"], ["phone"], [], [], [], ["card"], ["email"], []]


def test_decoding_stretches_equals_decoding_whole_texts():
    """Words without signs between such words are O, so stretches decode like whole texts."""
    model = pii.train()
    finder = pii.Finder(model)
    draw = random.Random(2)
    parts = ["call", "(555)", "123-4567", "the", "year", "1999", "bob@host", "12", "card", "4111", "word", "10.0.0.12", "tel", "a"]
    for _ in range(300):
        text = " ".join(draw.choices(parts, k=draw.randint(1, 25)))
        tokens = [(m.start(), m.end()) for m in re.finditer(r"\S+", text)]
        signs = [bool(re.search(r"[0-9@+]", text[a:b])) for a, b in tokens]
        near = [any(signs[max(0, i - 1):i + 2]) for i in range(len(tokens))]
        shapes = ["a", *(pii.shape(text[a:b]) if n else "a" for (a, b), n in zip(tokens, near)), "a"]
        # the whole text at once, with the constraint as a prohibitive emission
        e = np.array([finder.emission(tuple(shapes[i:i + 3])) if near[i] else np.array([0.0] + [-1e9] * 4)
                      for i in range(len(tokens))])
        whole = pii.viterbi([e], model["t"])[0]
        parts_found = {}
        for run in pii.stretches(text):
            s = ["a", *(pii.shape(text[a:b]) for a, b in run), "a"]
            em = np.array([finder.emission(tuple(s[j:j + 3])) for j in range(len(run))])
            parts_found.update(zip(run, pii.viterbi([em], model["t"])[0]))
        assert [int(x) for x in whole] == [int(parts_found.get(t, 0)) for t in tokens], text
        assert set(parts_found) == {t for t, n in zip(tokens, near) if n}


@pytest.mark.parametrize("frame", ["docs", "odd", "empty"])
def test_find(request, frame):
    df = request.getfixturevalue(frame)
    got = sorted(map(tuple, pii.find(df).collect()), key=str)
    assert len(got) == df.count()
    want = []
    for r in df.collect():
        base = _base(r.text or "")
        want.append((r.doc_id, *[sum(k == n for _, k, _ in base) for n in range(4)],
                     hashlib.sha256(pii.joined(base).encode()).hexdigest()))
    assert [g[:6] for g in got] == [w for w in sorted(want, key=str)]


def test_mask(spark):
    df = spark.createDataFrame([(1, "mail ann@x.example.org now", "z"), (2, None, "z"), (3, "", None)], "doc_id long, text string, kind string")
    got = [r.text for r in pii.mask(df).orderBy("doc_id").collect()]
    assert got == ["mail <email> now", None, ""] and pii.mask(df).columns == df.columns


# ---- languages -----------------------------------------------------------------------
def test_counts_are_those_of_one_text():
    texts = ["Ab c", "", "ÉTÉ été", "a-b  c3d", "x" * 300]
    together, has = language_id.counts(texts)
    for i, t in enumerate(texts):
        alone, one = language_id.counts([t])
        assert (alone[0] == together[i]).all() and one[0] == has[i] == any(c.isalpha() for c in t)


def test_held_out_accuracy(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language_id.identify(df, language_id.train(df), columns=("lang",)).collect()
    held = [r for r in found if r.held_out]
    assert len(found) == 1000 and len(held) > 200
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in found)


def test_odd_documents(odd, empty, docs):
    model = language_id.train(docs)
    got = language_id.identify(odd, model).collect()
    assert len(got) == odd.count()
    by = {r.doc_id: r for r in got}
    for doc in (1, 2, 3, 8):
        assert (by[doc].lang_pred, by[doc].score) == ("und", 0.0)
    assert by[4].lang_pred in model["names"]
    assert language_id.identify(empty, model).collect() == []
    assert {r.lang_pred for r in language_id.identify(odd, language_id.train(empty)).collect()} == {"und"}


def test_sample_is_the_first_of_each_language_by_hash(spark, monkeypatch):
    """Hot language, copies of one row, one id with several texts, null ids and languages."""
    rows = [(i, f"text number {i}", "de" if i % 4 else "nl") for i in range(300)]
    rows += [(7, "one row again", "de")] * 200 + [(8, f"same id {i}", "de") for i in range(50)]
    rows += [(None, "no id", "nl"), (1, None, "de"), (3, "no language", None), (5, "12 34", "de"), (9, "x" * 900, "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    seen = []
    monkeypatch.setattr(language_id, "fit", lambda texts, langs: seen.append(sorted(zip(langs, texts))))
    hashed = docs.withColumns({"a": F.xxhash64("doc_id"), "b": F.xxhash64("text"), "out": language_id.held_out("doc_id")})
    usable = {(r.lang, r.a, r.b, r.text) for r in hashed.collect()
              if r.lang and r.text and not r.out and len(r.text) <= 500 and any(c.isalpha() for c in r.text)}
    for per, total in ((40, 1000), (10_000, 10_000), (40, 50)):
        language_id.train(docs, per_language=per, max_documents=total, max_chars=500)
        ranked = [(n, *row) for lang in ("de", "nl")
                  for n, row in enumerate(sorted(r for r in usable if r[0] == lang)[:per])]
        assert seen.pop() == sorted((r[1], r[4]) for r in sorted(ranked)[:total])


def test_a_single_language_and_families():
    model = language_id.fit(["ein kurzer text", "noch ein text"], ["de", "de"])
    assert language_id.predict(["irgend ein text"], model)[0] == ["de"]
    assert language_id.family_of("pt-BR") == language_id.family_of("es") != language_id.family_of("de")
    assert language_id.family_of("tlh") == "tlh"


def test_skipped_elements_end_where_they_end():
    tree = html_text.train_tree(*html_text.labelled_rows())
    article = " ".join(f"word{i}" for i in range(60))
    page = lambda before: f"<html><body><div>{before}</div><article><p>{article}</p></article></body></html>"
    for before in ("<svg class='icon' width=9 />", "<math/>", "<svg><path d='m1'/></svg>", "<svg><title/><svg/></svg>",
                   "<button>Menu", "<map name=m><area href=x>", "<select><option>one<option>two", "<canvas/>", "<video>",
                   "<noscript>", "<object data=x>", "<button>Menu<button>More</button>"):
        assert html_text.main_text(page(before), tree) == article, before
    for tag in html_text.SKIPPED:
        closed = f"<article><p>{article} <{tag}>dropped <b>and</b> <{tag}x>gone</{tag}> {article}</p></article>"
        assert html_text.main_text(closed, tree) == f"{article} {article}", tag
    # an unclosed one whose name comes again behind the article
    again = f"<body><button>Menu<article><p>{article}</p></article><p><button>Send</button></p></body>"
    assert article in html_text.main_text(again, tree) and "Send" not in html_text.main_text(again, tree)


def test_an_end_tag_behind_many_open_elements():
    tree = html_text.train_tree(*html_text.labelled_rows())
    article = " ".join(f"word{i}" for i in range(60))
    for opened in ("<div>" * 300, "<span>" * 300, "<div><b>" * 150):
        page = f"<body><nav>{opened}menu</nav><article><p>{article}</p></article></body>"
        assert html_text.main_text(page, tree) == article, opened[:12]
    found = html_text.blocks("<p>" + "<b>" * 300 + "one<p>two<ul><li>" + "<i>" * 300 + "three<li>four</ul>")
    assert [b[0] for b in found] == ["one", "two", "three", "four"]
