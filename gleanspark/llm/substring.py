"""Repeated passages across documents, found from fixed-block anchors.

Every document is cut into non-overlapping blocks of half a window. A passage of
a whole window holds such a block of each document it lies in, so the blocks are
the index, and every rolling window of block length probes it. Blocks that another
document holds too are the anchors; the windows around them are compared across
documents by hash, and runs of equal windows are the maximal exact repeats.

Blocks go by one hash of 64 bits, whose errors can only add candidates. Windows go by
two of them, on words hashed twice with other numbers: among 1e12 windows less than
1e-14 false repeats are expected (5e23 pairs, 2^-128 each).
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanspark.llm.tables import materialize, pick, read_texts
from gleanspark.llm.words import SECOND, WHITE, as_long, find_words, hash_words, text_pieces, windows_long

WINDOW_WORDS = 50
#: Rolling windows that one task compares at a time, 4 bytes each.
BUCKET_WORDS = 4_000_000
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def _hashed(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first row, word hashes, word bounds of the texts)``."""
    for row, data, bounds in text_pieces(column):
        starts, ends, words = find_words(data, bounds, WHITE)
        yield row, hash_words(data, starts, ends), words


def _hashed_twice(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """As :func:`_hashed`, with other hashes of the words behind the first."""
    for row, data, bounds in text_pieces(column):
        starts, ends, words = find_words(data, bounds, WHITE)
        yield row, hash_words(data, starts, ends), hash_words(data, starts, ends, SECOND), words


def _inside(bounds: np.ndarray, n: int, size: int) -> np.ndarray:
    """Places from which ``size`` words lie in one text, of the first ``n``."""
    end = np.repeat(bounds[1:], np.diff(bounds))
    return np.arange(n) + size <= end[:n]


def _word_counts(texts: DataFrame) -> DataFrame:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [(v.as_py() or "").encode().split() for v in batch.column(1)]
            sums = [hashlib.sha256(b" ".join(w)).hexdigest() for w in words]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(w) for w in words], pa.int64()), pa.array(sums, pa.string())],
                names=["doc_id", "n_words", "sha256"],
            )

    return texts.mapInArrow(count, "doc_id long, n_words long, sha256 string")


def _block_rows(texts: DataFrame, size: int) -> DataFrame:
    """``(hash, doc_id, block)`` of all non-overlapping blocks."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for row, hashes, bounds in _hashed(batch.column(1)):
                rolled = windows_long(hashes, size)
                per_text = np.diff(bounds) // size
                text = np.repeat(np.arange(len(per_text)), per_text)
                block = np.arange(len(text)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
                found = rolled[bounds[text] + block * size] if len(text) else rolled[:0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(as_long(found)), pa.array(ids[row + text]), pa.array(block.astype(np.int32))],
                    names=["hash", "doc_id", "block"],
                )

    return texts.mapInArrow(cut, "hash long, doc_id long, block int")


def _shared_blocks(texts: DataFrame, size: int, total_words: int, bucket_words: int) -> DataFrame:
    """Hashes of the blocks that rolling windows of two documents or more hold.

    A piece of texts sends each hash at most twice (once if only one of its
    documents holds it), 32 bits of it, packed by bucket. So a passage that a
    third of the documents share costs two entries a piece, and no more than
    four bytes are shuffled for a word. False hits of the shortened hashes add
    candidates only.
    """
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bits = max(1, math.ceil(math.log2(max(2, parts, total_words / bucket_words))))
    shift, drop = np.uint64(64 - bits), np.uint64(bits)
    edges = np.arange(1, 1 << bits, dtype=np.uint64) << shift

    def short(hashes: np.ndarray) -> np.ndarray:
        return ((hashes << drop) >> np.uint64(32)).astype(np.uint32)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, hashes, bounds in _hashed(batch.column(1)):
                rolled = windows_long(hashes, size)
                at = np.flatnonzero(_inside(bounds, len(rolled), size))
                text = np.searchsorted(bounds, at, "right") - 1
                blocks = np.unique(rolled[at[(at - bounds[text]) % size == 0]])
                rolled = rolled[at]
                order = np.argsort(rolled, kind="stable")
                rolled, text = rolled[order], text[order]
                new_hash = np.concatenate(([True], rolled[1:] != rolled[:-1]))[: len(rolled)]
                new_text = new_hash | np.concatenate(([True], text[1:] != text[:-1]))[: len(rolled)]
                rolled, new_hash = rolled[new_text], new_hash[new_text]
                second = np.concatenate(([False], new_hash[:-1]))[: len(rolled)] & ~new_hash
                rolled = rolled[new_hash | second]
                probes, packed = short(rolled), np.concatenate(([0], np.searchsorted(rolled, edges), [len(rolled)]))
                places = np.concatenate(([0], np.searchsorted(blocks, edges), [len(blocks)]))
                full = np.flatnonzero(np.diff(packed))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(full.astype(np.int32)),
                        pa.array([probes[packed[b] : packed[b + 1]].tobytes() for b in full], pa.binary()),
                        pa.array([blocks[places[b] : places[b + 1]].tobytes() for b in full], pa.binary()),
                    ],
                    names=["bucket", "probes", "blocks"],
                )

    def meet(table: pa.Table) -> pa.Table:
        probes = np.sort(np.frombuffer(b"".join(table.column("probes").to_pylist()), dtype=np.uint32))
        twice = np.unique(probes[1:][probes[1:] == probes[:-1]])
        blocks = np.unique(np.frombuffer(b"".join(table.column("blocks").to_pylist()), dtype=np.uint64))
        if len(twice):
            at = np.minimum(np.searchsorted(twice, short(blocks)), len(twice) - 1)
            blocks = blocks[twice[at] == short(blocks)]
        else:
            blocks = blocks[:0]
        return pa.table({"hash": as_long(blocks)})

    packed = texts.mapInArrow(probe, "bucket int, probes binary, blocks binary")
    return packed.groupBy("bucket").applyInArrow(meet, "hash long")


def _suspect_windows(suspects: DataFrame, window: int, size: int) -> DataFrame:
    """``(hash, second, doc_id, place)`` of the windows all of whose blocks are anchors."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, anchors = batch.column(0).to_numpy(), batch.column(2)
            for row, hashes, others, bounds in _hashed_twice(batch.column(1)):
                rolled, second = windows_long(hashes, window), windows_long(others, window)
                ok = _inside(bounds, len(rolled), window)
                text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[: len(rolled)]
                for i in range(len(bounds) - 1):
                    n = int(bounds[i + 1] - bounds[i])
                    if n < window:
                        continue
                    # One more block for the last windows, whose second block is cut off.
                    anchor = np.zeros(n // size + 2, dtype=bool)
                    anchor[anchors[row + i].values.to_numpy()] = True
                    first = np.arange(n - window + 1)
                    good = anchor[-(-first // size)]
                    ok[bounds[i] : bounds[i] + len(first)] &= good
                at = np.flatnonzero(ok)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(as_long(rolled[at])),
                        pa.array(as_long(second[at])),
                        pa.array(ids[row + text[at]]),
                        pa.array((at - bounds[text[at]]).astype(np.int32)),
                    ],
                    names=["hash", "second", "doc_id", "place"],
                )

    return suspects.mapInArrow(emit, "hash long, second long, doc_id long, place int")


def _cut_words(suspects: DataFrame, window: int) -> DataFrame:
    """Words covered by the repeated windows (``places``) removed; spans in words."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, sums, spans = [], [], []
            for text, places in zip(batch.column(1), batch.column(2)):
                words = (text.as_py() or "").encode().split()
                change = np.zeros(len(words) + 1, dtype=np.int64)
                np.add.at(change, places.values.to_numpy(), 1)
                np.add.at(change, places.values.to_numpy() + window, -1)
                gone = np.cumsum(change[:-1]) > 0
                edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(np.int8), [0]))))
                removed.append(int(gone.sum()))
                spans.append([{"start": int(a), "end": int(b)} for a, b in zip(edges[::2], edges[1::2])])
                sums.append(hashlib.sha256(b" ".join([w for w, g in zip(words, gone) if not g])).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(removed, pa.int64()),
                    pa.array(sums, pa.string()),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                ],
                names=["doc_id", "n_removed", "kept_sha256", "spans"],
            )

    return suspects.mapInArrow(cut, "doc_id long, n_removed long, kept_sha256 string, spans array<struct<start:long,end:long>>")


def repeated_passages(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW_WORDS,
    bucket_words: int = BUCKET_WORDS,
) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_removed, kept_sha256, spans`` (in words).

    A word goes when a window of ``window`` words that covers it also starts in
    a document with a smaller id. Documents of equal words are told apart first:
    of those only the one with the smallest id is searched, the others repeat
    it whole. ``window`` is even, or the last word of a window is no part of an
    anchor, which costs candidates only.

    Null and empty texts have no words. An id stands for one text; a repeated
    row has no smaller id and gives its result again. A row without id keeps
    its words and is nobody's source. A very long text is cut by the task that reads it,
    its windows are rows of their own. Other columns of the input are not read. No rows
    give no rows.
    """
    # Any window of 2 * size - 1 words holds a whole block.
    size = window // 2
    texts = read_texts(docs, id_col, text_col)
    counts = materialize(_word_counts(texts))
    known = counts.where("doc_id is not null")
    # Written, so that both sides of the join are plain exchanges and a hot text is split.
    firsts = materialize(known.groupBy("sha256").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("rows")).where("rows > 1").drop("rows"))
    copies = known.join(firsts, "sha256").where("doc_id > first_id")
    copies = materialize(copies.select("doc_id", "n_words").dropDuplicates(["doc_id"]))
    total = known.agg(F.sum("n_words")).first()[0] or 0

    # Too short for a window, or a copy: no windows of its own.
    searched = pick(texts.where("doc_id is not null"), copies.select("doc_id"), how="left_anti")
    shared = _shared_blocks(searched, size, total, bucket_words)
    anchors = materialize(
        _block_rows(searched, size).join(shared, "hash", "left_semi").groupBy("doc_id").agg(F.collect_set("block").alias("blocks"))
    )
    suspects = materialize(pick(texts, anchors.select("doc_id")).dropDuplicates(["doc_id"]).join(anchors, "doc_id"))
    windows = materialize(_suspect_windows(suspects.select("doc_id", "text", "blocks"), window, size))
    sources = windows.groupBy("hash", "second").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))
    # As above, for the windows of a hot passage.
    sources = materialize(sources.where("first_id < last_id").drop("last_id"))
    repeats = windows.join(sources, ["hash", "second"]).where("doc_id > first_id").groupBy("doc_id").agg(F.collect_list("place").alias("places"))
    cut = _cut_words(suspects.select("doc_id", "text").join(repeats, "doc_id"), window)
    whole = copies.where(F.col("n_words") >= window).select("doc_id", F.lit(True).alias("whole"))
    no_spans = F.lit(None).cast("array<struct<start:bigint,end:bigint>>")
    return (
        counts.join(whole, "doc_id", "left")
        .join(cut, "doc_id", "left")
        .select(
            "doc_id",
            "n_words",
            F.when(F.col("whole"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
            F.when(F.col("whole"), F.lit(EMPTY_SHA)).otherwise(F.coalesce("kept_sha256", "sha256")).alias("kept_sha256"),
            F.when(F.col("whole"), F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_words").alias("end"))))
            .otherwise(F.coalesce("spans", no_spans, F.array().cast("array<struct<start:bigint,end:bigint>>")))
            .alias("spans"),
        )
    )
