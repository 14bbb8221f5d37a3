"""Best-fit decreasing packing of token pieces into sequences of a fixed capacity.

Pieces of one length are alike, so the packing is decided on the counts of the
lengths: whole ranges of alike bins take whole ranges of alike pieces. That plan
has a size which depends on the capacity alone. Pieces find their bin by their
rank among those of their length, which Spark numbers without a hot group.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleanspark.llm.tables import materialize, read_texts

CAPACITY = 1024
END_ID = 2
#: Documents encoded together.
_ROWS = 256
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class Capacities:
    """A segment tree over remaining capacities that finds the smallest occupied one from a given size on."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.used = [False] * (2 * self.leaves)

    def mark(self, capacity: int, occupied: bool) -> None:
        node = self.leaves + capacity
        self.used[node] = occupied
        while node > 1:
            node //= 2
            self.used[node] = self.used[2 * node] or self.used[2 * node + 1]

    def tightest(self, size: int) -> int | None:
        """The smallest occupied capacity of at least ``size``, in logarithmic time."""
        node = self.leaves + size
        if self.used[node]:
            return size
        while node > 1:
            if node % 2 == 0 and self.used[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.used[2 * node] else 2 * node + 1
                return node - self.leaves
            node //= 2
        return None


@dataclass(frozen=True)
class Placement:
    """Pieces of ``length`` with ranks from ``rank`` on: ``per_bin`` in each bin from ``bin`` on, behind ``offset``."""

    length: int
    rank: int
    per_bin: int
    bin: int
    offset: int


def best_fit_plan(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[Placement], int]:
    """Best-fit decreasing over counted lengths; the placements and the number of bins.

    The same bins as placing piece by piece: the tightest bin that holds a piece
    holds the next one of that length too, until less than the length is left.
    """
    tree, open_bins = Capacities(capacity), [[] for _ in range(capacity + 1)]
    placements: list[Placement] = []
    bins = 0

    def put(left: int, first: int, count: int) -> None:
        if left and count:
            open_bins[left].append((first, count))
            tree.mark(left, True)

    for length in sorted((n for n in counts if counts[n]), reverse=True):
        rank, rest = 0, counts[length]
        while rest:
            left = tree.tightest(length)
            if left is None:
                per_bin = capacity // length
                left, first, available = capacity, bins, -(-rest // per_bin)
                bins += available
            else:
                per_bin = left // length
                first, available = open_bins[left].pop()
                needed = -(-rest // per_bin)
                if needed < available:
                    open_bins[left].append((first + needed, available - needed))
                    available = needed
                tree.mark(left, bool(open_bins[left]))
            taken = min(rest, available * per_bin)
            placements.append(Placement(length, rank, per_bin, first, capacity - left))
            full, partial = divmod(taken, per_bin)
            put(left - per_bin * length, first, full)
            if partial:
                put(left - partial * length, first + full, 1)
            rank, rest = rank + taken, rest - taken
    return placements, bins


def _encoder(path: str | None):
    """The byte-level vocabulary; its rank file gives the ids of the same vocabulary's ``tokenizers`` file, faster."""
    import base64

    import public_tokenizers
    import tiktoken

    with open(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
    special = {"<|endoftext|>": len(ranks)}
    return tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)


def cut(n_ids: int, capacity: int) -> list[tuple[int, int]]:
    """``(start, length)`` of a document's pieces: whole ones of the capacity, the rest in front."""
    head = n_ids % capacity
    edges = ([0] if head else []) + list(range(head, n_ids + 1, capacity))
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def token_pieces(
    docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, ranks_path: str | None = None, with_ids: bool = False
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` (and ``ids``) of every document's ids with the end id behind."""
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
    if with_ids:
        schema = schema.append(pa.field("ids", pa.list_(pa.int32())))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = None
        for whole in batches:
            encoding = encoding or _encoder(ranks_path)
            for low in range(0, len(whole), _ROWS):
                batch = whole.slice(low, _ROWS)
                rows = []
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    tokens = encoding.encode(text.as_py() or "", allowed_special="all")
                    tokens.append(end_id)
                    ids = np.array(tokens, dtype="<u4")
                    for piece, (start, length) in enumerate(cut(len(ids), capacity)):
                        part = ids[start : start + length]
                        row = (doc_id, piece, start, length, zlib.crc32(part.tobytes()))
                        rows.append(row + (part.tolist(),) if with_ids else row)
                columns = list(zip(*rows)) if rows else [[] for _ in schema]
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, schema)], schema=schema)

    return read_texts(docs).mapInArrow(encode, _PIECES + (", ids array<int>" if with_ids else ""))


def assign(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (a written table) with ``sequence_id`` and ``offset``.

    Ranks within a length are taken in salted parts, ordered by id, and shifted
    by the parts before; of the data only the counts of the at most ``capacity``
    lengths reach the driver.
    """
    spark = pieces.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    salted = pieces.withColumn("_part", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(parts)))
    sizes = salted.groupBy("length", "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("length").orderBy("_part")) - F.col("_n")
    shifts = sizes.select("length", "_part", before.alias("_before"))
    place = F.row_number().over(Window.partitionBy("length", "_part").orderBy("doc_id", "piece"))
    ranked = (
        salted.withColumn("_place", place)
        .join(shifts, ["length", "_part"])
        .select(*pieces.columns, (F.col("_place") + F.col("_before") - 1).alias("rank"))
    )
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    placements, _ = best_fit_plan(counts, capacity)
    table = np.array([(p.length, p.rank, p.per_bin, p.bin, p.offset) for p in placements], dtype=np.int64).reshape(-1, 5)
    names = ranked.schema.names

    def place_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Placements come by falling length and rising rank.
        falling = -table[:, 0]
        for batch in batches:
            length, rank = batch.column(names.index("length")).to_numpy(), batch.column(names.index("rank")).to_numpy()
            first, last = np.searchsorted(falling, -length, "left"), np.searchsorted(falling, -length, "right")
            found = np.empty(len(length), dtype=np.int64)
            for a in np.unique(first):
                rows = np.flatnonzero(first == a)
                b = last[rows[0]]
                found[rows] = a + np.searchsorted(table[a:b, 1], rank[rows], "right") - 1
            entry = table[found] if len(found) else np.zeros((0, 5), dtype=np.int64)
            at = rank - entry[:, 1]
            kept = [c for n, c in zip(names, batch.columns) if n != "rank"]
            bins, offsets = entry[:, 3] + at // entry[:, 2], entry[:, 4] + (at % entry[:, 2]) * entry[:, 0]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(bins), pa.array(offsets)], names=[n for n in names if n != "rank"] + ["sequence_id", "offset"]
            )

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return ranked.mapInArrow(place_rows, f"{kept}, sequence_id long, offset long")


def pack(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, ranks_path: str | None = None) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    A null or empty text is the end id alone. Repeated rows are packed each on
    its own; a null id stays null. No rows give no rows.
    """
    return assign(materialize(token_pieces(docs, capacity, end_id, ranks_path)), capacity)


def packed_tokens(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, ranks_path: str | None = None) -> DataFrame:
    """The pieces of :func:`pack` with their ids, which ``sequence_id`` and ``offset`` put in order."""
    return assign(materialize(token_pieces(docs, capacity, end_id, ranks_path, with_ids=True)), capacity)
