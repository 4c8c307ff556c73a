"""Language identification by hierarchical discrimination (operator 5).

The language's family is predicted first (multinomial logistic regression); within a
family one-versus-one linear support vector machines separate the related languages. Both
work on hashed character uni-, bi- and trigrams of the whole text, counted with numpy for
many documents at once. The models are fitted in the driver on a bounded sample:
``per_language`` labelled documents of each language, by hashes of id and text.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.chunks import slices

BITS = 12
WIDTH = 1 << BITS
DIMS = 3 * WIDTH  # uni-, bi- and trigrams
UNDETERMINED = "und"
SAMPLE_PARTS = 64  # a language's documents are sampled in so many parts first

#: Families of common languages; fixed values. A language that is not named is a family of its own.
FAMILIES = {
    "germanic": "en de nl af sv da no nb nn is fo lb fy yi sco nds".split(),
    "romance": "fr es it pt ro ca gl oc la ast an lmo scn sc rm wa fur".split(),
    "slavic": "ru uk be pl cs sk sl hr sr bs mk bg sh hsb dsb".split(),
    "baltic": "lt lv".split(),
    "uralic": "fi et hu se".split(),
    "turkic": "tr az kk ky uz tk tt ba".split(),
    "celtic": "ga gd cy br gv kw".split(),
    "indic": "hi ur bn pa gu mr ne or as si sa".split(),
    "semitic": "ar he mt am".split(),
}


def family_of(language: str) -> str:
    base = language.lower().replace("_", "-").split("-")[0]
    return next((name for name, members in FAMILIES.items() if base in members), language)


# ---- features ------------------------------------------------------------------------
@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-gram counts (documents x DIMS) and whether each text has a letter.

    Letters are lowered; all other characters count as one kind of gap between words.
    """
    joined = "".join(f" {t.lower()} " for t in texts)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.array([len(t.lower()) + 2 for t in texts])
    doc = np.repeat(np.arange(len(texts)), sizes)
    letter = _letters()[points]
    x = np.where(letter, points, 32).astype(np.uint32)
    keep = letter | np.concatenate(([True], letter[:-1])) | (np.concatenate(([-1], doc[:-1])) != doc)
    x, doc, letter = x[keep], doc[keep], letter[keep]
    out = np.zeros((len(texts), DIMS), np.float32)
    has = np.zeros(len(texts), bool)
    has[doc[letter]] = True
    down = np.uint32(32 - BITS)
    base = doc * WIDTH
    one = (x * np.uint32(2654435761)) >> down
    two = ((x[:-1] * np.uint32(2246822519) + x[1:]) * np.uint32(3266489917)) >> down
    three = (((x[:-2] * np.uint32(2246822519) + x[1:-1]) * np.uint32(3266489917) + x[2:])
             * np.uint32(668265263)) >> down
    for n, grams in enumerate((one, two, three)):
        same = doc[: len(doc) - n] == doc[n:]
        cells = (base[: len(doc) - n] + grams)[same]
        out[:, n * WIDTH:(n + 1) * WIDTH] = np.bincount(
            cells, minlength=len(texts) * WIDTH).reshape(len(texts), WIDTH)
    return out, has


def scaled(raw: np.ndarray) -> np.ndarray:
    """Square roots of the shares within uni-, bi- and trigrams: rows of equal length."""
    out = np.sqrt(raw, dtype=np.float32)
    for n in range(3):
        part = out[:, n * WIDTH:(n + 1) * WIDTH]
        part /= np.maximum(np.sqrt((part ** 2).sum(axis=1, keepdims=True)), 1e-9)
    return out


# ---- models --------------------------------------------------------------------------
def fit_logistic(x: np.ndarray, y: np.ndarray, k: int, steps: int = 150, rate: float = 4.0,
                 decay: float = 1e-4) -> np.ndarray:
    """Weights (DIMS + 1) x k of a multinomial logistic regression."""
    x = np.hstack((x, np.ones((len(x), 1), np.float32)))
    w = np.zeros((x.shape[1], k), np.float32)
    speed = np.zeros_like(w)
    truth = np.eye(k, dtype=np.float32)[y]
    balance = (len(y) / (k * np.bincount(y, minlength=k)))[y][:, None].astype(np.float32)
    for _ in range(steps):
        p = softmax(x @ w)
        grad = x.T @ ((truth - p) * balance) / len(x) - decay * w
        speed = 0.9 * speed + rate * grad
        w += speed
    return w


def fit_svm(x: np.ndarray, y: np.ndarray, steps: int = 150, rate: float = 1.0, decay: float = 1e-4) -> np.ndarray:
    """Weights (DIMS + 1) of a linear support vector machine (squared hinge); y is -1 or 1."""
    x = np.hstack((x, np.ones((len(x), 1), np.float32)))
    w = np.zeros(x.shape[1], np.float32)
    speed = np.zeros_like(w)
    share = np.where(y > 0, 1 / max(1, (y > 0).sum()), 1 / max(1, (y < 0).sum())).astype(np.float32)
    for _ in range(steps):
        slack = np.maximum(0, 1 - y * (x @ w))
        speed = 0.9 * speed + rate * (x.T @ (share * y * slack) - decay * w)
        w += speed
    return w


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(texts: list[str], languages: list[str]) -> dict:
    """The hierarchy: families, and a machine for each two languages of a family."""
    names = sorted(set(languages))
    families = sorted({family_of(n) for n in names})
    if not names:
        return {"names": [], "families": [], "family_w": np.zeros((DIMS + 1, 0), np.float32), "members": [],
                "pairs": [], "pair_w": np.zeros((DIMS + 1, 0), np.float32)}
    x = np.concatenate([scaled(counts(texts[a:b])[0]) for a, b in slices(texts)])
    y = np.array([names.index(n) for n in languages])
    family = np.array([families.index(family_of(n)) for n in names])
    members = [np.flatnonzero(family == f).tolist() for f in range(len(families))]
    pairs = [(a, b) for m in members for i, a in enumerate(m) for b in m[i + 1:]]
    machines = []
    for a, b in pairs:
        rows = (y == a) | (y == b)
        machines.append(fit_svm(x[rows], np.where(y[rows] == a, 1.0, -1.0).astype(np.float32)))
    return {"names": names, "families": families,
            "family_w": fit_logistic(x, family[y], len(families)), "members": members, "pairs": pairs,
            "pair_w": np.stack(machines, axis=1) if machines else np.zeros((DIMS + 1, 0), np.float32)}


def predict(texts: list[str], model: dict) -> tuple[list[str], np.ndarray]:
    """Language and score (0 to 1) of each text; no letter, or no model: undetermined, 0.

    The score is the family's probability times the logistic of the smallest margin by
    which the language wins its machines.
    """
    raw, has = counts(texts)
    names: list[str] = [UNDETERMINED] * len(texts)
    score = np.zeros(len(texts))
    if not model["names"]:
        return names, score
    x = scaled(raw)
    p = softmax(x @ model["family_w"][:-1] + model["family_w"][-1])
    margins = x @ model["pair_w"][:-1] + model["pair_w"][-1]
    family = p.argmax(axis=1)
    for i in np.flatnonzero(has):
        own = model["members"][family[i]]
        votes = dict.fromkeys(own, 0)
        least = dict.fromkeys(own, np.inf)
        for (a, b), m in zip(model["pairs"], margins[i]):
            if a in votes:
                win, lose = (a, b) if m > 0 else (b, a)
                votes[win] += 1
                least[win] = min(least[win], abs(m))
        best = max(own, key=lambda c: (votes[c], least[c], -c))
        names[i] = model["names"][best]
        score[i] = p[i, family[i]] * (1.0 if least[best] == np.inf else 1 / (1 + np.exp(-4 * least[best])))
    return names, np.clip(score, 0, 1)


# ---- on Spark ------------------------------------------------------------------------
def held_out(id_col: str):
    """True for the documents that no model may learn from: crc32 of the id as text, mod 4, is 2."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def train(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          per_language: int = 400, max_documents: int = 8_000, max_chars: int = 50_000) -> dict:
    """The hierarchy from at most ``per_language`` labelled documents of each language, at most
    ``max_documents`` in all (dealt evenly to the languages), each of at most ``max_chars``
    characters; the driver holds no more than those and one row of counts for each.

    Hashes of ids and texts are chosen first, first within parts of a language, so that a
    language with most of the rows is no task's alone; only the chosen texts move. Rows that
    repeat an id with its text count once.
    """
    usable = docs.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"),
                         F.col(text_col).alias("text")) \
        .filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out("id"))
    usable = (usable.filter((F.length("text") <= max_chars) & F.col("text").rlike(r"\p{L}"))
              .select("lang", "text", F.xxhash64("id").alias("h_id"), F.xxhash64("text").alias("h_text")))
    key = ["lang", "h_id", "h_text"]
    chosen = usable.groupBy(*key).agg(F.pmod(F.hash(*key), F.lit(SAMPLE_PARTS)).alias("part"))
    for group in (["lang", "part"], ["lang"]):
        first = Window.partitionBy(*group).orderBy("h_id", "h_text")
        chosen = chosen.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= per_language)
    chosen = chosen.orderBy("n", "lang").limit(max_documents).select(*key)
    # at most max_documents small rows are broadcast; copies of a chosen text end in their tasks
    sample = (usable.join(F.broadcast(chosen), key, "left_semi").groupBy(*key)
              .agg(F.first("text").alias("text")).select("lang", "text").collect())
    sample.sort(key=lambda r: (r.lang, r.text))
    return fit([r.text for r in sample], [r.lang for r in sample])


def identify(docs: DataFrame, model: dict, *, id_col: str = "doc_id", text_col: str = "text",
             columns: tuple[str, ...] = ()) -> DataFrame:
    """``id_col``, held_out, lang_pred, score and the further ``columns``, one row per input row.

    Only the text is an input of a prediction. A null text, or one without letters, is
    ``und`` with score 0. Repeated rows give repeated results; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # DIMS x (families + pairs) floats
    carried = [c for c in columns if c != text_col]  # the text itself is sent once
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"),
                       held_out(id_col).alias("_held"), *[F.col(c) for c in carried])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                some = batch.slice(first, 256)
                texts = [t or "" for t in some.column("_text").to_pylist()]
                for a, b in slices(texts):
                    names, score = predict(texts[a:b], model)
                    part = some.slice(a, b - a)
                    yield pa.RecordBatch.from_arrays(
                        [part.column("_id"), part.column("_held"), pa.array(names, pa.string()), pa.array(score),
                         *[part.column("_text" if x == text_col else x) for x in columns]],
                        names=["_id", "_held", "_lang", "_score", *columns])

    schema = T.StructType([T.StructField("_id", rows.schema["_id"].dataType), T.StructField("_held", T.BooleanType()),
                           T.StructField("_lang", T.StringType()), T.StructField("_score", T.DoubleType()),
                           *[docs.schema[c] for c in columns]])
    return rows.mapInArrow(run, schema).select(
        F.col("_id").alias(id_col), F.col("_held").alias("held_out"), F.col("_lang").alias("lang_pred"),
        F.col("_score").alias("score"), *columns)
