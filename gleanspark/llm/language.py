"""Language identification by string kernels.

The kernel of two texts blends, over the orders 1 to 3, the share of character
n-grams both hold (presence, not counts), each order scaled by the sizes of the
two sets. A bounded sample of labelled rows gives Nystroem landmarks and the
training rows of one-versus-rest kernel ridge regression. As the kernel is
linear in the presence vectors, landmarks, whitening and ridge weights fold into
one matrix per order, by which batches of presence vectors are multiplied.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


ORDERS = (1, 2, 3)
#: Buckets that the n-grams of each order are hashed to.
BUCKETS = 1 << 14
#: Labelled rows of each language that are learned from, and those among them that are landmarks.
TRAINING_PER_LANGUAGE = 256
LANDMARKS_PER_LANGUAGE = 48
#: The same for all languages together, which bounds the driver's memory (6 KB a row, 200 KB a landmark).
TRAINING_ROWS = 8192
LANDMARKS = 1024
RIDGE = 1e-3
UNDETERMINED = "und"
_BATCH = 64
_NOT_LETTERS = re.compile(r"[\W\d_]+")
#: Fixed odd multipliers of the n-gram hash.
_TERMS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], dtype=np.uint32)


def letters(text: str | None) -> str:
    """The text in lower case, everything but letters as single blanks; empty without a letter."""
    found = _NOT_LETTERS.sub(" ", (text or "").lower()).strip()
    return f" {found} " if any(c.isalpha() for c in found) else ""


def presence(texts: list[str]) -> np.ndarray:
    """A row per text, a column per order and bucket: whether the text holds such an n-gram."""
    out = np.zeros((len(texts), len(ORDERS) * BUCKETS), dtype=bool)
    for row, text in enumerate(texts):
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        for block, n in enumerate(ORDERS):
            if len(points) < n:
                continue
            total = np.zeros(len(points) - n + 1, dtype=np.uint32)
            for i in range(n):
                total = (total ^ points[i : i + len(total)]) * _TERMS[i]
                total ^= total >> np.uint32(15)
            out[row, block * BUCKETS + (total % np.uint32(BUCKETS)).astype(np.int64)] = True
    return out


def scaled(found: np.ndarray) -> np.ndarray:
    """Presence vectors scaled so that their products are the blended kernel; 1 for equal texts."""
    blocks = found.reshape(len(found), len(ORDERS), BUCKETS).astype(np.float32)
    sizes = blocks.sum(axis=2, keepdims=True)
    return (blocks / np.sqrt(np.maximum(sizes, 1) * len(ORDERS))).reshape(len(found), -1)


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    weights: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        kept = [letters(t) for t in texts]
        if not self.languages or not kept:
            return [UNDETERMINED] * len(kept), [0.0] * len(kept)
        margins = scaled(presence(kept)) @ self.weights
        best = margins.argmax(axis=1)
        sure = np.clip((margins.max(axis=1) + 1) / 2, 0, 1)
        names = [self.languages[b] if k else UNDETERMINED for b, k in zip(best, kept)]
        return names, [float(s) if k else 0.0 for s, k in zip(sure, kept)]


def solve(found: np.ndarray, labels: list[str], landmarks: np.ndarray, ridge: float = RIDGE) -> LanguageModel:
    """Ridge regression of +1 and -1 for each language on the Nystroem features of the training rows."""
    languages = sorted(set(labels))
    if not languages:
        return LanguageModel([], np.zeros((len(ORDERS) * BUCKETS, 0), dtype=np.float32))
    base = scaled(found[landmarks])
    values, vectors = np.linalg.eigh((base @ base.T).astype(np.float64))
    kept = values > 1e-6 * values.max()
    whitening = vectors[:, kept] / np.sqrt(values[kept])
    # In batches, as a scaled row takes 32 times the memory of its bits.
    kernel = np.concatenate([scaled(found[i : i + _BATCH]) @ base.T for i in range(0, len(found), _BATCH)])
    features = kernel.astype(np.float64) @ whitening
    targets = np.where(np.array(labels)[:, None] == np.array(languages)[None, :], 1.0, -1.0)
    # Each language weighs alike, however many rows it gave.
    share = {lang: labels.count(lang) for lang in languages}
    weigh = np.array([len(labels) / (len(languages) * share[lang]) for lang in labels])[:, None]
    gram = features.T @ (features * weigh) + ridge * len(labels) * np.eye(features.shape[1])
    ridge_weights = np.linalg.solve(gram, features.T @ (targets * weigh))
    return LanguageModel(languages, (base.T @ (whitening @ ridge_weights)).astype(np.float32))


def fit(
    labelled: DataFrame,
    training: int = TRAINING_PER_LANGUAGE,
    landmarks: int = LANDMARKS_PER_LANGUAGE,
    ridge: float = RIDGE,
) -> LanguageModel:
    """Fit on ``(doc_id, text, lang)``: per language the ``training`` rows whose ids hash lowest.

    The choice reads ids and labels only and is cut per task before the
    shuffle; the driver gets the presence bits of the chosen rows, 6 KB each.
    """
    languages = max(1, labelled.select("lang").distinct().count())
    training, landmarks = max(1, min(training, TRAINING_ROWS // languages)), max(1, min(landmarks, LANDMARKS // languages))
    spot = F.xxhash64("doc_id")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(spot, "doc_id"))
    chosen = labelled.select("doc_id", "lang").withColumn("rank", rank).where(F.col("rank") <= training)
    # At most `training` ids of each language.
    chosen = F.broadcast(chosen.groupBy("doc_id").agg(F.min("rank").alias("rank")))

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [letters(t) for t in batch.column("text").to_pylist()]
            rows = np.array([i for i, k in enumerate(kept) if k], dtype=np.int64)
            for low in range(0, len(rows), _BATCH):
                part = rows[low : low + _BATCH]
                found = np.packbits(presence([kept[i] for i in part]), axis=1)
                taken = batch.take(pa.array(part))
                yield pa.RecordBatch.from_arrays(
                    [taken.column("lang"), taken.column("rank"), pa.array([b.tobytes() for b in found], pa.binary())],
                    names=["lang", "rank", "bits"],
                )

    rows = labelled.join(chosen, "doc_id").select("lang", "rank", "text")
    got = rows.mapInArrow(bits, "lang string, rank int, bits binary").collect()
    got.sort(key=lambda r: (r["lang"], r["rank"], bytes(r["bits"])))
    packed = np.frombuffer(b"".join(r["bits"] for r in got), dtype=np.uint8).reshape(-1, len(ORDERS) * BUCKETS // 8)
    found = np.unpackbits(packed, axis=1).view(bool)
    first = np.array([i for i, r in enumerate(got) if r["rank"] <= landmarks], dtype=np.int64)
    if not len(first):
        first = np.arange(len(got))
    return solve(found, [r["lang"] for r in got], first, ridge)


def is_held_out(doc_id: Column, folds: int, held: int) -> Column:
    """Whether a row is held out: crc32 of the id as text, modulo ``folds``, is ``held``."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(folds)) == held, F.lit(False))


def identify(
    docs: DataFrame,
    model: LanguageModel | None = None,
    lang_col: str = "lang",
    folds: int = 5,
    held: int = 0,
    carry: bool = False,
) -> DataFrame:
    """One row per document: ``doc_id, held_out, lang_pred, score, no_letters``.

    Without a ``model`` one is fitted on the labelled rows that are not held
    out. A null text, or one without a letter, is ``und`` with score 0; so is
    every text when there is nothing to learn from. ``no_letters`` goes by the text
    alone, whatever labels were learned. Rows without id or label are predicted
    but not learned from; repeated rows are predicted each. Whole texts are read,
    however long. Other columns are not read, so their names cannot clash; with
    ``carry`` each row comes back as it was in a further column ``row``. No rows give
    no rows.
    """
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.col(lang_col).cast("string").alias("lang"),
    ).withColumn("held_out", is_held_out(F.col("doc_id"), folds, held))
    if model is None:
        model = fit(texts.where("doc_id is not null and lang is not null and not held_out").select("doc_id", "text", "lang"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = ["doc_id", "held_out", "lang_pred", "score", "no_letters"]

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, len(whole), _BATCH):
                batch = whole.slice(low, _BATCH)
                given = batch.column(2).to_pylist()
                found, scores = shared.value.predict(given)
                empty = [n == UNDETERMINED and not letters(t) for n, t in zip(found, given)]
                yield pa.RecordBatch.from_arrays(
                    [
                        *batch.columns[:2],
                        pa.array(found, pa.string()),
                        pa.array(scores, pa.float64()),
                        pa.array(empty, pa.bool_()),
                        *batch.columns[3:],
                    ],
                    names=names + batch.schema.names[3:],
                )

    schema = "doc_id long, held_out boolean, lang_pred string, score double, no_letters boolean"
    doc_id = F.col("doc_id").cast("long")
    rows = docs.select(doc_id.alias("doc_id"), is_held_out(doc_id, folds, held).alias("held_out"), F.col("text").cast("string").alias("text"))
    if carry:
        whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
        rows = docs.select(doc_id.alias("doc_id"), is_held_out(doc_id, folds, held).alias("held_out"), F.col("text").cast("string").alias("text"), whole)
        schema += f", row {rows.schema['row'].dataType.simpleString()}"
    return rows.mapInArrow(predict, schema)
