"""Quality scores from compressed sizes under two zstandard dictionaries.

One dictionary is trained on labelled good text, one on labelled bad text. A text
is cut into short pieces, so that what it shares with a dictionary counts more
than what it shares with itself, and every piece is compressed with both. The
normalised difference of the two sums, and how far the better one shrinks the
text, are calibrated by a logistic regression on rows no dictionary has seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleanspark.llm.language import is_held_out
from gleanspark.llm.tables import materialize

#: Labelled documents of each label that are learned from: half for the dictionary, half to calibrate.
TRAINING_PER_LABEL = 2000
#: Pieces of a document that its dictionary is trained on; those whose hashes are lowest.
PIECES_PER_DOCUMENT = 16
PIECE_BYTES = 512
DICTIONARY_BYTES = 112 * 1024
LEVEL = 3
#: Score from which a document is predicted to be of label 1.
THRESHOLD = 0.3
_RIDGE = 1e-3


def pieces(text: str | None, size: int = PIECE_BYTES) -> Iterator[bytes]:
    """The whole text in UTF-8, in pieces of ``size`` bytes."""
    data = memoryview((text or "").encode("utf-8", "replace"))
    for start in range(0, len(data), size):
        yield bytes(data[start : start + size])


def dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A trained dictionary; the samples themselves where they are too few to train on."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:size]


def _compressor(content: bytes, level: int) -> zstandard.ZstdCompressor:
    options = {"level": level, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
    if len(content) < 8:  # less than a dictionary can be
        return zstandard.ZstdCompressor(**options)
    shared = zstandard.ZstdCompressionDict(content)
    shared.precompute_compress(level=level)
    return zstandard.ZstdCompressor(dict_data=shared, **options)


@dataclass
class QualityModel:
    """Two dictionaries and the calibration of the sizes they give."""

    good: bytes = b""
    bad: bytes = b""
    #: Intercept and one weight per feature; without weights every score is the intercept's.
    weights: np.ndarray = field(default_factory=lambda: np.zeros(1))
    mean: np.ndarray = field(default_factory=lambda: np.zeros(2))
    scale: np.ndarray = field(default_factory=lambda: np.ones(2))
    piece_bytes: int = PIECE_BYTES
    level: int = LEVEL

    def __post_init__(self) -> None:
        self._ready: tuple | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_ready": None}

    def features(self, text: str | None) -> tuple[float, float] | None:
        """(normalised difference of sizes, log of the smaller share); None for an empty text."""
        if self._ready is None:
            self._ready = (_compressor(self.good, self.level), _compressor(self.bad, self.level))
        by_good, by_bad = self._ready
        good = bad = plain = 0
        for piece in pieces(text, self.piece_bytes):
            good += len(by_good.compress(piece))
            bad += len(by_bad.compress(piece))
            plain += len(piece)
        if not plain:
            return None
        return (bad - good) / (bad + good), float(np.log(min(bad, good) / plain))

    def score(self, texts: list[str | None]) -> np.ndarray:
        """The probability of label 1; an empty text stands where the average text does."""
        if len(self.weights) == 1:
            return np.full(len(texts), 1 / (1 + np.exp(-self.weights[0])))
        rows = [self.features(t) for t in texts]
        known = np.array([self.mean if r is None else r for r in rows], dtype=float).reshape(len(rows), 2)
        margin = self.weights[0] + ((known - self.mean) / self.scale) @ self.weights[1:]
        return 1 / (1 + np.exp(-np.clip(margin, -50, 50)))


def logistic(rows: np.ndarray, labels: np.ndarray, share: np.ndarray, ridge: float = _RIDGE) -> np.ndarray:
    """Weighted logistic regression by Newton's steps; intercept first, the other weights shrunk."""
    given = np.column_stack([np.ones(len(rows)), rows])
    penalty = ridge * share.sum() * np.eye(given.shape[1])
    penalty[0, 0] = 1e-9
    weights = np.zeros(given.shape[1])
    for _ in range(100):
        found = 1 / (1 + np.exp(-np.clip(given @ weights, -50, 50)))
        slope = given.T @ (share * (found - labels)) + penalty @ weights
        bend = (given * (share * found * (1 - found))[:, None]).T @ given + penalty
        step = np.linalg.solve(bend, slope)
        weights = weights - step
        if np.abs(step).max() < 1e-9:
            break
    return weights


def _constant(counts: dict[int, int]) -> QualityModel:
    """The share of label 1, where there is but one label or none."""
    share = (counts.get(1, 0) + 0.5) / (sum(counts.values()) + 1)
    return QualityModel(weights=np.array([np.log(share / (1 - share))]))


def fit(
    texts: DataFrame,
    marks: DataFrame,
    training: int = TRAINING_PER_LABEL,
    per_document: int = PIECES_PER_DOCUMENT,
    piece_bytes: int = PIECE_BYTES,
    dictionary_bytes: int = DICTIONARY_BYTES,
    level: int = LEVEL,
) -> QualityModel:
    """Fit on the ``texts`` ``(doc_id, text)`` that ``marks`` ``(doc_id, label)`` label 0 or 1.

    Of each label the ``training`` documents whose ids hash lowest are taken, by
    ids alone; only theirs are the texts that move. Rows that repeat an id and
    label count once. The driver gets ``per_document`` pieces of every other
    document and two numbers of each of the rest. The shares of the labels are
    those of all labelled rows.
    """
    spark = texts.sparkSession
    ids = materialize(marks.distinct().join(texts.select("doc_id"), "doc_id", "left_semi"))
    counts = {r["label"]: r["n"] for r in ids.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        return _constant(counts)
    # Ids that hash low enough, some four times as many as are taken, so that few are ranked.
    spot = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    low = reduce(lambda c, n: c.when(F.col("label") == n, spot < (4 * training << 30) // counts[n]), counts, F)
    rank = F.row_number().over(Window.partitionBy("label").orderBy(spot, "doc_id"))
    chosen = ids.where(low).withColumn("rank", rank).where(F.col("rank") <= training)
    # At most `training` ids of each label; of texts that share an id one, the smallest.
    sample = texts.join(F.broadcast(chosen), "doc_id")
    sample = materialize(sample.groupBy("label", "rank").agg(F.min("text").alias("text")))

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for text in batch.column(1).to_pylist():
                every = {xxhash.xxh64_intdigest(p): p for p in pieces(text, piece_bytes)}
                kept.append([every[h] for h in sorted(every)[:per_document]])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kept, pa.list_(pa.binary()))], names=["label", "kept"])

    taken = sample.where("rank % 2 = 1").select("label", "text").mapInArrow(take, "label int, kept array<binary>").collect()
    samples = {label: sorted(bytes(p) for r in taken if r["label"] == label for p in r["kept"]) for label in (0, 1)}
    model = QualityModel(
        dictionary(samples[1], dictionary_bytes), dictionary(samples[0], dictionary_bytes), piece_bytes=piece_bytes, level=level
    )
    shared = spark.sparkContext.broadcast(model)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.features(t) for t in batch.column(1).to_pylist()]
            kept = [i for i, f in enumerate(found) if f is not None]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(kept, pa.int64())), *(pa.array([found[i][k] for i in kept], pa.float64()) for k in (0, 1))],
                names=["label", "gain", "size"],
            )

    rest = sample.where("rank % 2 = 0").select("label", "text").mapInArrow(measure, "label int, gain double, size double").collect()
    if {r["label"] for r in rest} != {0, 1}:
        return _constant(counts)
    rest.sort(key=tuple)
    rows = np.array([(r["gain"], r["size"]) for r in rest])
    labels = np.array([r["label"] for r in rest], dtype=float)
    model.mean, model.scale = rows.mean(axis=0), rows.std(axis=0) + 1e-6
    # Every label weighs as much as it has rows, however many were sampled.
    share = np.where(labels == 1, counts[1] / (labels == 1).sum(), counts[0] / (labels == 0).sum())
    model.weights = logistic((rows - model.mean) / model.scale, labels, share * len(labels) / share.sum())
    return model


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    model: QualityModel | None = None,
    label_col: str = "quality",
    threshold: float = THRESHOLD,
    folds: int = 5,
    held: int = 0,
) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``.

    Without a ``model`` one is fitted on the labelled rows that are not held out.
    Whole texts are compressed where they were read, however long, a piece at a
    time. A null text counts as empty; an empty one gets the score of the average
    text. Rows without id, and labels without id or other than 0 and 1, are not
    learned from; where a document has both labels it is learned as either. With
    labels of one kind, or none, every score is the share of label 1. Repeated
    rows and ties are scored each; no rows give none. Other columns of either
    table are not read, so their names cannot clash.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if model is None:
        marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
        marks = marks.where("doc_id is not null and label in (0, 1)").where(~is_held_out(F.col("doc_id"), folds, held)).distinct()
        model = fit(texts, marks)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = shared.value.score(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], names=["doc_id", "score"])

    scored = texts.mapInArrow(score, "doc_id long, score double")
    return scored.select(
        "doc_id",
        is_held_out(F.col("doc_id"), folds, held).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
