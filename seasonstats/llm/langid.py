"""Language identification by a blended-spectrum string kernel.

A text is the set of its byte sequences of one, two and three bytes, in lower case and with white space, digits and
marks as blanks. The kernel of two texts is, for each length, the number of shared sequences over the root of both
numbers, averaged. Landmark texts of every language span a Nystrom feature space, in which kernel ridge regression
separates each language from the others. As kernel and regression are linear in a text's presence vector, they fold into
one matrix per length, and a batch of texts is scored by a product of its presence matrix with them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seasonstats.llm.text import chunks, release
from seasonstats.sources.shared import materialize

UNDETERMINED = "und"
LENGTHS = (1, 2, 3)
TRAINING, LANDMARKS = 192, 64  # texts of a language to learn from at most, and landmarks among them
RIDGE, SHARPNESS = 1e-2, 4.0
CHUNK = 1 << 20

# Bytes as 155 symbols: a blank, 26 letters without case, and the bytes beyond ASCII.
_FOLD = np.zeros(256, np.uint8)
_FOLD[65:91] = _FOLD[97:123] = np.arange(1, 27)
_FOLD[128:] = np.arange(27, 155)
SYMBOLS = 155


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return _FOLD[raw], offsets - offsets[0]


def _sequences(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(number of each byte sequence within a text, its text)."""
    count = max(0, len(data) - length + 1)
    codes = np.zeros(count, np.int32)
    for i in range(length):
        codes = codes * SYMBOLS + data[i : i + count]
    texts = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))[:count]
    inside = np.arange(count) + length <= offsets[1:][texts]
    return codes[inside], texts[inside]


class KernelModel:
    """The folded model: for each length the known sequences and a weight for each and every language."""

    def __init__(self, languages: list[str], known: list[np.ndarray], weights: list[np.ndarray]):
        self.languages, self.known, self.weights = languages, known, weights
        self.places = None

    def __getstate__(self):
        return self.__dict__ | {"places": None}

    def presence(self, texts: pa.Array) -> list[np.ndarray]:
        """For each length a matrix of texts by known sequences."""
        if self.places is None:
            self.places = []
            for length, known in zip(LENGTHS, self.known, strict=True):
                place = np.full(SYMBOLS**length, len(known), np.int32)
                place[known] = np.arange(len(known))
                self.places.append(place)
        data, offsets = _bytes(texts)
        out = []
        for length, known, place in zip(LENGTHS, self.known, self.places, strict=True):
            codes, owner = _sequences(data, offsets, length)
            seen = np.zeros((len(texts), len(known) + 1), np.float32)
            seen.ravel()[owner.astype(np.int64) * (len(known) + 1) + place[codes]] = 1
            out.append(seen[:, :-1])
        return out

    def scores(self, texts: pa.Array) -> np.ndarray:
        total = np.zeros((len(texts), len(self.languages)))
        for seen, weights in zip(self.presence(texts), self.weights, strict=True):
            total += (seen @ weights) / np.sqrt(np.maximum(seen.sum(axis=1), 1))[:, None]
        return total

    def predict(self, texts: pa.Array) -> tuple[pa.Array, pa.Array]:
        """(language, score); a text without a letter is undetermined with score 0."""
        lettered = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)
        if not self.languages:
            return pa.array([UNDETERMINED] * len(texts)), pa.array(np.zeros(len(texts)))
        scores = SHARPNESS * self.scores(texts)
        odds = np.exp(scores - scores.max(axis=1, keepdims=True))
        odds /= odds.sum(axis=1, keepdims=True)
        best = odds.argmax(axis=1)
        names = np.array(self.languages, object)[best]
        names[~lettered] = UNDETERMINED
        return pa.array(names, pa.string()), pa.array(np.where(lettered, odds.max(axis=1), 0.0))


def fit_kernel(texts: list[str], labels: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> KernelModel:
    """One-versus-rest ridge regression on the Nystrom features of ``texts``; the first texts of a label are landmarks."""
    languages = sorted(set(labels))
    if not languages:
        return KernelModel([], [np.zeros(0, np.int64)] * len(LENGTHS), [np.zeros((0, 0))] * len(LENGTHS))
    seen: dict[str, int] = {}
    chosen = []
    for i, label in enumerate(labels):
        seen[label] = seen.get(label, 0) + 1
        if seen[label] <= landmarks:
            chosen.append(i)
    data, offsets = _bytes(pa.array([texts[i] for i in chosen], pa.string()))
    known = [np.unique(_sequences(data, offsets, length)[0]) for length in LENGTHS]
    blank = KernelModel(languages, known, [])
    presence = [p.astype(np.float64) for p in blank.presence(pa.array(texts, pa.string()))]
    scaled = [p / np.sqrt(np.maximum(p.sum(axis=1), 1))[:, None] for p in presence]
    kernel = sum(s @ s[chosen].T for s in scaled) / len(LENGTHS)  # texts by landmarks
    values, vectors = np.linalg.eigh(kernel[chosen])
    large = values > 1e-8 * values[-1]
    root = vectors[:, large] / np.sqrt(values[large])
    features = kernel @ root
    targets = np.where(np.array(labels, object)[:, None] == np.array(languages, object)[None, :], 1.0, -1.0)
    # A label's texts weigh as much as another's, however many were found.
    weight = np.array([1.0 / labels.count(x) for x in labels])[:, None]
    weight *= len(labels) / len(languages)
    inner = features.T @ (features * weight) + ridge * len(labels) * np.eye(features.shape[1])
    solved = root @ np.linalg.solve(inner, features.T @ (targets * weight))
    weights = [(s[chosen].T @ solved / len(LENGTHS)).astype(np.float32) for s in scaled]
    return KernelModel(languages, known, weights)


def is_held_out(id_column: Column, folds: int = 4, fold: int = 2) -> Column:
    """Whether the checksum of the id as text leaves ``fold``; false for a null id."""
    return F.coalesce(F.pmod(F.crc32(id_column.cast("string")), F.lit(folds)) == fold, F.lit(False))


def training_texts(docs: DataFrame, lang_column: str, learn: Column, id_column: str, text_column: str, most: int):
    """Up to ``most`` texts per language, drawn by the hash of their ids: [(text, lang)], a bounded sample."""
    usable = docs.where(learn & F.col(lang_column).isNotNull() & F.col(text_column).isNotNull()).select(
        F.col(id_column).alias("id"), F.col(text_column).alias("text"), F.col(lang_column).alias("lang"),
        F.xxhash64(F.lit(7), F.col(id_column)).alias("draw"),
    )
    # A row per language, stored: so small a table is broadcast, and no text is shuffled to be drawn or not.
    counts = materialize(usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "languages")
    # About three times as many as needed, so that the exact choice orders few rows of a language.
    part = F.least(F.lit(1.0), F.lit(3.0 * most) / F.col("n"))
    drawn = usable.join(counts, "lang").where(F.pmod("draw", F.lit(1 << 20)) < F.ceil(part * (1 << 20)))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "id", "text"))
    rows = drawn.withColumn("place", place).where(F.col("place") <= most).orderBy("lang", "place").collect()
    return [(r["text"], r["lang"]) for r in rows]


def identify_languages(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang", training: int = TRAINING
) -> DataFrame:
    """All columns of ``docs`` with held_out, lang_pred and score (these replace columns of the same names).

    The model learns from at most ``training`` texts of a language (a documented bound) with a label and an id that is
    not held out and not null; a prediction reads the whole text and nothing else. Null texts and those without a letter
    are ``und`` with score 0, as is everything if there is nothing to learn from. Repeated rows are predicted alike.
    """
    learn = F.col(id_column).isNotNull() & ~is_held_out(F.col(id_column))
    sample = training_texts(docs, lang_column, learn, id_column, text_column, training)
    model = fit_kernel([t for t, _ in sample], [x for _, x in sample])
    named = docs.drop("held_out", "lang_pred", "score").withColumn("held_out", is_held_out(F.col(id_column)))
    names = named.columns

    def predicted(batches):
        release()
        for batch in batches:
            for part in chunks(batch, text_column, CHUNK):
                lang, score = model.predict(part.column(text_column))
                yield pa.RecordBatch.from_arrays([*part.columns, lang, score], [*names, "lang_pred", "score"])
        model.places = None
        release()

    schema = T.StructType([*named.schema.fields]).add("lang_pred", "string").add("score", "double")
    return named.mapInArrow(predicted, schema)
