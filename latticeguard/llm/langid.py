"""Language identification by string kernels.

Kernel: the blended spectrum of n-gram presence. A text is the set of its 1-, 2- and 3-grams over a
learned alphabet (lower-cased letters; every run of other characters is one blank); the kernel of
two texts is the number of n-grams they share, divided by the root of the product of their own
numbers. It is approximated from landmark texts (Nyström): with K the kernel of the landmarks, a
text's features are its kernel values with them times K to the power -1/2, on which one ridge
regression per language, against the rest, is solved in closed form.

The fit uses a bounded sample of labelled rows: `SAMPLE` rows in all, shared evenly by the
languages and drawn by hash of the text, of which `LANDMARKS` are landmarks. Workers send only the
n-gram sets of the sample to the driver. Every text is scored whole, in Arrow batches: presence
matrix times landmark matrix, then times the weights.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from latticeguard.llm.common import free_name, materialize

SAMPLE = 2_000
LANDMARKS = 128
#: Letters told apart (with 0 for blanks and 1 for all other letters, seven bits a character).
ALPHABET = 126
RIDGE = 1e-3
UNKNOWN = "und"
_ROWS_AT_ONCE = 128
_BITS = 7
_OFFSETS = (0, 1 << _BITS, (1 << _BITS) + (1 << 2 * _BITS))
_GRAMS = _OFFSETS[2] + (1 << 3 * _BITS)


def letter_codes(alphabet: str) -> np.ndarray:
    """Code of each character of the first plane: 0 no letter, 1 a letter, 2 and up those of the alphabet."""
    table = np.fromiter((chr(c).isalpha() for c in range(1 << 16)), np.uint8, 1 << 16)
    for code, letter in enumerate(alphabet, 2):
        table[ord(letter)] = code
    return table


def encode(text: str, table: np.ndarray) -> np.ndarray:
    """Codes of a text: letters, and one blank between and around their runs; empty without letters."""
    points = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
    codes = table[np.minimum(points, 0xFFFF)]
    far = np.flatnonzero(points > 0xFFFF)
    if far.size:
        codes[far] = [chr(c).isalpha() for c in points[far].tolist()]
    if not codes.any():
        return codes[:0]
    codes = np.concatenate(([0], codes, [0])).astype(np.int64)
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] > 0) | (codes[:-1] > 0)
    return codes[keep]


def grams(codes: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The distinct n-grams of encoded text; `last` is a scratch array of _GRAMS integers."""
    two = codes[:-1] << _BITS | codes[1:]
    three = two[:-1] << _BITS | codes[2:]
    every = np.concatenate((codes, two + _OFFSETS[1], three + _OFFSETS[2]))
    order = np.arange(len(every), dtype=np.int32)
    last[every] = order  # of each n-gram, one position stays
    return every[last[every] == order]


def scratch() -> np.ndarray:
    return np.zeros(_GRAMS, np.int32)


@dataclass
class Model:
    """What scoring needs; `languages` is empty if there was nothing to learn from."""

    alphabet: str
    languages: list[str]
    vocabulary: np.ndarray  # the landmarks' n-grams
    landmarks: np.ndarray  # presence, landmarks x vocabulary, as packed bits
    sizes: np.ndarray  # n-grams of each landmark
    weights: np.ndarray  # landmarks x languages


def _sample(labelled: DataFrame, text: str, lang: str) -> DataFrame:
    """(text, lang): at most SAMPLE rows, as many for each language, distinct texts, by hash of the text."""
    rows = labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where(
        F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    hashed = materialize(rows.select("lang", F.xxhash64("text").alias("h")).distinct(), "langid-hashes")
    langs = hashed.select("lang").distinct().count()
    each = max(2, SAMPLE // max(1, langs))
    drawn = hashed.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).where(F.col("n") <= each)
    drawn = materialize(drawn, "langid-drawn")
    return materialize(rows.withColumn("h", F.xxhash64("text")).join(drawn, ["lang", "h"]).dropDuplicates(["lang", "h"])
                       .select("text", "lang", "h"), "langid-sample")


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """The model of labelled rows; rows with a null language, or no letter in the text, teach nothing."""
    sample = _sample(labelled, text, lang)
    letters = (sample.select(F.explode(F.split(F.lower("text"), "")).alias("c"))
               .where(F.col("c").rlike(r"^\p{L}$") & (F.length(F.encode("c", "UTF-8")) <= 3))
               .groupBy("c").count().orderBy(F.desc("count"), "c").limit(ALPHABET).collect())
    alphabet = "".join(sorted(c for r in letters if len(c := r["c"]) == 1))

    @F.arrow_udf("array<int>")
    def sets(column: pa.Array) -> pa.Array:
        table, last = letter_codes(alphabet), scratch()
        return pa.array([np.sort(grams(encode(t, table), last)).astype(np.int32) for t in column.to_pylist()],
                        pa.list_(pa.int32()))

    rows = sample.select("lang", "h", sets("text").alias("grams")).orderBy("lang", "h").toArrow()
    languages = sorted(set(rows.column("lang").to_pylist()))
    if not languages:
        return Model(alphabet, [], np.zeros(0, np.int32), np.zeros((0, 0), np.uint8), np.zeros(0), np.zeros((0, 0)))
    lists = rows.column("grams").combine_chunks()
    values, bounds = lists.values.to_numpy(), lists.offsets.to_numpy()
    own = [values[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]
    of = np.array([languages.index(x) for x in rows.column("lang").to_pylist()])
    each = max(1, LANDMARKS // len(languages))
    chosen = np.concatenate([np.flatnonzero(of == c)[:each] for c in range(len(languages))])
    vocabulary = np.unique(np.concatenate([own[i] for i in chosen]))
    marks = np.stack([np.isin(vocabulary, own[i], assume_unique=True) for i in chosen])
    sizes = np.array([len(own[i]) for i in chosen], float)

    def kernel(sets_: list[np.ndarray]) -> np.ndarray:
        shared = np.stack([marks[:, np.searchsorted(vocabulary, s[np.isin(s, vocabulary)])].sum(axis=1) for s in sets_])
        return shared / np.sqrt(np.array([max(1, len(s)) for s in sets_])[:, None] * sizes[None, :])

    values, vectors = np.linalg.eigh(kernel([own[i] for i in chosen]))
    root = vectors * np.where(values > 1e-9, 1 / np.sqrt(np.maximum(values, 1e-9)), 0) @ vectors.T
    features = kernel(own) @ root
    wanted = (of[:, None] == np.arange(len(languages))[None, :]).astype(float)
    solved = np.linalg.solve(features.T @ features + RIDGE * len(own) * np.eye(len(chosen)), features.T @ wanted)
    return Model(alphabet, languages, vocabulary, np.packbits(marks, axis=1), sizes, root @ solved)


class Scorer:
    """A model unpacked in a worker."""

    def __init__(self, model: Model):
        self.model = model
        self.table = letter_codes(model.alphabet)
        self.last = scratch()
        self.slot = np.full(_GRAMS, -1, np.int32)
        self.slot[model.vocabulary] = np.arange(len(model.vocabulary))
        self.marks = np.unpackbits(model.landmarks, axis=1, count=len(model.vocabulary)).astype(np.float32).T

    def score(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """(language, score) of each text; the score is the winning regression's value, held within 0 and 1."""
        model = self.model
        present = np.zeros((len(texts), len(model.vocabulary)), np.float32)
        sizes = np.zeros(len(texts))
        for row, text in enumerate(texts):
            codes = encode(text, self.table) if text else ()
            if len(codes):
                found = grams(codes, self.last)
                sizes[row] = len(found)
                slots = self.slot[found]
                present[row, slots[slots >= 0]] = 1
        shared = (present @ self.marks).astype(float)
        values = shared / np.sqrt(np.maximum(sizes, 1)[:, None] * model.sizes[None, :]) @ model.weights
        best = values.argmax(axis=1)
        top = np.clip(values[np.arange(len(texts)), best], 0, 1)
        return ([model.languages[b] if n else UNKNOWN for b, n in zip(best, sizes, strict=True)],
                np.where(sizes > 0, top, 0).tolist())


_PREDICTION = T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType())])


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """`docs` with lang_pred and score.

    Null or empty text, or text without a letter, is `und` with score 0, as is every text under a
    model that learned no language. Repeated rows get equal results; an empty table gives no rows.
    New columns get an underscore in front where `docs` has their name already.
    """
    scorer: list[Scorer] = []

    @F.arrow_udf(_PREDICTION)
    def scored(column: pa.Array) -> pa.Array:
        if not model.languages:
            return pa.array([{"lang": UNKNOWN, "score": 0.0}] * len(column), _ARROW)
        if not scorer:
            scorer.append(Scorer(model))
        langs, scores = [], []
        for at in range(0, len(column), _ROWS_AT_ONCE):
            some = scorer[0].score(column.slice(at, _ROWS_AT_ONCE).to_pylist())
            langs += some[0]
            scores += some[1]
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang", "score"])

    out = free_name(docs, "prediction")
    lang, score = free_name(docs, "lang_pred"), free_name(docs, "score")
    return docs.withColumn(out, scored(F.col(text))).select(
        *(F.col(f"`{c}`") for c in docs.columns), F.col(f"{out}.lang").alias(lang), F.col(f"{out}.score").alias(score))


_ARROW = pa.struct([("lang", pa.string()), ("score", pa.float64())])
