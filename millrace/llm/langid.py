"""Language of a text by string kernels: blended-spectrum presence, Nyström, ridge regression.

Two texts are compared by the number of byte n-grams (1 to 4 bytes, letters lower-cased,
other ASCII as spaces) present in both, over the geometric mean of their numbers.  The
kernel is approximated from landmark texts (Nyström): with L the landmarks' presence
matrix and K its kernel, a text x maps to K^(-1/2) k(x, L).  One ridge regression per
language on these features gives the scores.  Presence is kept over hashed n-grams.

Presence says little once most n-grams are there, so a long text is cut into equal
stretches of bounded size, all of it, and stands for the mean of their normalised presence,
weighted by their letters.  The kernel of two texts is then the mean over their stretches,
and the margins of a text are the mean of the margins of its stretches.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm import hashing
from millrace.llm.common import add_columns, held_out, ready

#: Hashed n-grams; the presence of a stretch is this many bits.
SLOTS = 8192
#: Bytes of a stretch at most; a shorter text is one stretch.
SPAN = 4096
LONGEST = 4
#: Labelled texts per language used for training, and as landmarks, at most.
MAX_TRAIN_PER_LANG = 500
LANDMARKS_PER_LANG = 48
RIDGE = 1e-3
UNKNOWN = "und"

_LETTER = regex.compile(r"\p{L}")
_FOLD = np.arange(256, dtype=np.uint64)
_FOLD[hashing.NO_LETTER] = 32
_FOLD[65:91] += np.uint64(32)
_STRETCH = 1 << 18


def _presence(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    out = np.zeros((len(starts), SLOTS), np.uint8)
    for i, (start, end) in enumerate(zip(starts, ends, strict=True)):
        for lo in range(start, end, _STRETCH):  # these overlap by an n-gram less one
            part = _FOLD[data[lo : min(lo + _STRETCH + LONGEST - 1, end)]]
            grams = np.zeros(len(part), np.uint64)
            for n in range(LONGEST):
                if len(part) <= n:
                    break
                grams = grams[: len(part) - n] * np.uint64(0x100000001B3) + part[n:] + np.uint64(1)
                slots = (grams * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(51)
                out[i, slots.astype(np.int64)] = 1
    return out


def presence(texts: pa.Array) -> np.ndarray:
    """A row of ``SLOTS`` zeros and ones per text."""
    data, at = hashing.flat(texts)
    return _presence(data, at[:-1], at[1:])


def _normed(seen: np.ndarray) -> np.ndarray:
    x = seen.astype(np.float32)
    return x / np.sqrt(np.maximum(x.sum(axis=1, keepdims=True), 1))


def averaged(texts: pa.Array, times: np.ndarray | None = None) -> np.ndarray:
    """Mean normalised presence of the stretches of each text, times a matrix if one is given."""
    data, at = hashing.flat(texts)
    size = np.diff(at)
    n = np.maximum(-(-size // SPAN), 1)
    own = np.repeat(np.arange(len(size)), n)
    nth = np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)
    cut = lambda k: at[own] + size[own] * k // n[own]
    lows, highs = cut(nth), cut(nth + 1)
    weight = np.array([np.count_nonzero(~hashing.NO_LETTER[data[lo:hi]]) for lo, hi in zip(lows, highs, strict=True)], float)
    total = np.bincount(own, weight, len(size))[own]
    weight = np.where(total > 0, weight / np.maximum(total, 1), 1 / n[own]).astype(np.float32)
    ends = np.minimum(highs + LONGEST - 1, at[own + 1])  # n-grams over a cut belong to the stretch before it
    out = np.zeros((len(size), SLOTS if times is None else times.shape[1]), np.float32)
    for lo in range(0, len(own), 256):
        some = slice(lo, lo + 256)
        rows = _normed(_presence(data, lows[some], ends[some]))
        np.add.at(out, own[some], weight[some, None] * (rows if times is None else rows @ times))
    return out


@dataclass(frozen=True)
class Model:
    languages: list[str]
    #: n-grams x landmarks
    landmarks: np.ndarray
    #: landmarks x languages
    weights: np.ndarray

    def predict(self, texts: pa.Array) -> tuple[list[str], list[float]]:
        langs, scores = [], []
        direct = self.landmarks @ self.weights
        for lo in range(0, len(texts), 256):
            part = texts.slice(lo, 256)
            known = [t is not None and _LETTER.search(t) is not None for t in part.to_pylist()]
            if not self.languages:
                langs += [UNKNOWN] * len(part)
                scores += [0.0] * len(part)
                continue
            margins = averaged(part, direct)
            best = margins.argmax(axis=1)
            # margins aim at 1 for the language and -1 for the others
            shown = np.clip((margins[np.arange(len(best)), best] + 1) / 2, 0, 1)
            langs += [self.languages[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
            scores += [float(s) if k else 0.0 for s, k in zip(shown, known, strict=True)]
        return langs, scores


def solve(kernel: np.ndarray, langs: list[str], marks: np.ndarray) -> Model:
    """Nyström features of the training texts, and one ridge regression per language.

    ``kernel`` is that of training texts x landmarks, ``marks`` are landmarks x n-grams.
    """
    names = sorted(set(langs))
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(float))
    keep = values > 1e-6 * values[-1]
    root = vectors[:, keep] / np.sqrt(values[keep])
    phi = kernel.astype(float) @ root
    y = np.where(np.array(langs)[:, None] == np.array(names)[None, :], 1.0, -1.0)
    # languages weigh alike, however many texts each one has
    share = np.array([1.0 / langs.count(name) for name in names])
    w = share[[names.index(x) for x in langs]][:, None] * len(langs) / len(names)
    gram = phi.T @ (w * phi) + RIDGE * len(langs) * np.eye(phi.shape[1])
    beta = np.linalg.solve(gram, phi.T @ (w * y))
    return Model(names, np.ascontiguousarray(marks.T), np.ascontiguousarray((root @ beta).astype(np.float32)))


def fit(
    docs: DataFrame, id_: str = "doc_id", text: str = "text", lang: str = "lang",
    per_lang: int = MAX_TRAIN_PER_LANG, landmarks_per_lang: int = LANDMARKS_PER_LANG,
) -> Model:
    """Learn from at most ``per_lang`` texts of each language, none of them held out.

    Rows are taken by a hash of the id.  The texts themselves stay on the executors: a
    landmark comes to the driver as ``SLOTS`` numbers, any other text as its kernel with the
    landmarks.  Rows with a null id, text or language, and
    texts without a letter, teach nothing.  Without any row the model knows no language.
    """
    ready(docs.sparkSession)
    given = docs.select(
        F.col(f"`{id_}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("text"),
        F.col(f"`{lang}`").cast("string").alias("lang"),
    ).where("id is not null and lang is not null and text is not null").where(~held_out("id"))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    # far more than ``per_lang`` rows of a language lie below this share of all hashes; the
    # others are left out where they are read, and the first ones by hash stay the same
    ids = given.select("id", "lang")
    share = ids.groupBy("lang").agg((F.lit(16.0 * per_lang) / F.count(F.lit(1))).alias("share"))
    near = ids.join(share, "lang").where(F.xxhash64("id") / F.lit(2.0**64) + 0.5 <= F.col("share"))
    chosen = near.select("id", "lang").withColumn("place", F.row_number().over(order)).where(F.col("place") <= per_lang)
    sample = given.join(F.broadcast(chosen), ["id", "lang"]).select("place", "lang", "text")

    def rows(given: DataFrame, times=None) -> tuple[list[str], np.ndarray]:
        """Languages of texts with a letter, and a row of numbers for each."""

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = [_LETTER.search(t) is not None for t in batch.column("text").to_pylist()]
                batch = batch.filter(pa.array(keep, pa.bool_()))
                numbers = averaged(batch.column("text"), None if times is None else times.value)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("place"), batch.column("lang"), pa.array([r.tobytes() for r in numbers], pa.binary())],
                    names=["place", "lang", "numbers"],
                )

        got = sorted(tuple(r) for r in given.mapInArrow(work, "place int, lang string, numbers binary").collect())
        numbers = np.frombuffer(b"".join(bytes(b) for _, _, b in got), np.float32)
        return [name for _, name, _ in got], numbers.reshape(len(got), -1) if got else np.zeros((0, SLOTS), np.float32)

    _, marks = rows(sample.where(F.col("place") <= landmarks_per_lang))
    if not len(marks):
        _, marks = rows(sample)
    if not len(marks):
        return Model([], np.zeros((SLOTS, 0), np.float32), np.zeros((0, 0), np.float32))
    langs, kernel = rows(sample, docs.sparkSession.sparkContext.broadcast(np.ascontiguousarray(marks.T)))
    return solve(kernel, langs, marks)


def predict(
    df: DataFrame, model: Model, text: str = "text", lang: str = "lang_pred", score: str = "score"
) -> DataFrame:
    """Append the language of every whole text and its score (0 to 1).

    ``und`` with score 0 where the text is null or has no letter, or where the model knows
    no language.  Columns with these names are replaced.
    """
    sent = ready(df.sparkSession).sparkContext.broadcast(model)

    def work(columns: list[pa.Array]) -> list[pa.Array]:
        langs, scores = sent.value.predict(columns[0])
        return [pa.array(langs, pa.string()), pa.array(scores, pa.float64())]

    return add_columns(df, [text], f"`{lang}` string, `{score}` double", work)
