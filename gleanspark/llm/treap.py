"""Ranked lexical search: K2-treaps over the grid of terms and documents.

The documents are cut into blocks. The grid of a block, a row per term and a
column per document, is a compressed quadtree: a cell stands for a range of terms
and a range of documents, is kept only where it holds postings, and knows the
largest impact among them. The upper levels split terms 256-fold while they halve
the documents, until a cell is a stretch of one term's row; a stretch with one
posting, or of ``LEAF`` documents, ends its path. A search follows the paths of
all rows of an item jointly: the range of documents with the largest sum of
weighted cell maxima is split first, ranges that cannot reach the ten best any
more are left, and at the end of the paths postings are summed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleanspark.llm.tables import materialize, read_texts
from gleanspark.llm.words import NOT_ALNUM, find_words, hash_words, lower, text_pieces
from gleanspark.session import PAYLOAD_OPTIONS, small_batches

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TOP = 10
#: Bytes of text whose terms are sorted together; a longer text is cut between words.
SLICE_BYTES = 1 << 22
#: Documents at the end of a path: 2 ** LEAF_BITS.
LEAF_BITS = 6
#: Bits of term numbers that each of the upper levels splits by.
ROW_BITS = 8
#: Characters of terms of the items that are searched for in one pass over the index.
ITEM_CHARS = 1 << 22
#: Pairs of items and terms that descend side by side.
_PAIRS = 1 << 15
_NO_ID = np.iinfo(np.int64).max
#: Bytes of text whose documents are a block; a longer text is a block of its own.
BLOCK_BYTES = 1 << 22
_INDEX_OPTIONS = {**PAYLOAD_OPTIONS, "parquet.block.size": str(16 << 20), "compression": "zstd"}


def _slices(data: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Runs of about ``limit`` bytes that end where no word is cut."""
    start = 0
    while start < len(data):
        end = min(start + limit, len(data))
        while end < len(data):
            gap = np.flatnonzero(NOT_ALNUM[data[end : end + 4096]])
            if len(gap):
                end += int(gap[0])
                break
            end = min(end + 4096, len(data))
        yield start, end
        start = end


def _words(data: np.ndarray, bounds: np.ndarray, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """``(bytes, starts, ends, text of each word)`` by slices of the bytes."""
    for begin, end in _slices(data, limit):
        part = data[begin:end]
        local = np.clip(bounds - begin, 0, len(part))
        starts, ends, _ = find_words(part, local, NOT_ALNUM)
        yield begin, starts, ends, np.searchsorted(bounds, starts + begin, side="right") - 1


def _heads(*columns: np.ndarray) -> np.ndarray:
    """Where a sorted table's rows differ from the row before."""
    if not len(columns[0]):
        return np.zeros(0, dtype=np.int64)
    new = np.zeros(len(columns[0]), dtype=bool)
    new[0] = True
    for column in columns:
        new[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(new)


@dataclass
class Postings:
    """The postings of a block, by term and document; terms by hash."""

    hashes: np.ndarray
    bounds: np.ndarray
    letters: np.ndarray
    row: np.ndarray
    doc: np.ndarray
    count: np.ndarray
    sizes: np.ndarray


def _places(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of stretches one after the other, and their bounds."""
    bounds = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
    return np.arange(bounds[-1]) + np.repeat(starts - bounds[:-1], sizes), bounds


def _gather(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    places, bounds = _places(starts, sizes)
    return data[places], bounds


def postings(data: np.ndarray, bounds: np.ndarray, limit: int = SLICE_BYTES) -> Postings:
    """Count the terms of each text, a slice of the bytes at a time."""
    found, sizes = [], np.zeros(len(bounds) - 1, dtype=np.int64)
    for begin, starts, ends, doc in _words(data, bounds, limit):
        sizes += np.bincount(doc, minlength=len(sizes))
        hashes = hash_words(data[begin : begin + (int(ends[-1]) if len(ends) else 0)], starts, ends)
        order = np.argsort(hashes, kind="stable")
        hashes, doc = hashes[order], doc[order]
        heads = _heads(hashes, doc)
        counts = np.diff(np.append(heads, len(hashes)))
        first = order[heads]
        found.append((hashes[heads], doc[heads], counts, starts[first] + begin, ends[first] - starts[first]))
    if not found:
        none = np.zeros(0, dtype=np.int64)
        return Postings(np.zeros(0, dtype=np.uint64), np.zeros(1, dtype=np.int64), np.zeros(0, dtype=np.uint8), none, none, none, sizes)
    hashes, doc, counts, at, size = (np.concatenate(part) for part in zip(*found))
    if len(found) > 1:
        order = np.lexsort((doc, hashes))
        hashes, doc, counts, at, size = hashes[order], doc[order], counts[order], at[order], size[order]
        heads = _heads(hashes, doc)
        counts = np.add.reduceat(counts, heads)
        hashes, doc, at, size = hashes[heads], doc[heads], at[heads], size[heads]
    heads = _heads(hashes)
    letters, term_bounds = _gather(data, at[heads], size[heads])
    row = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(hashes))))
    return Postings(hashes[heads], term_bounds, letters, row, doc, counts, sizes)


def length_measure(sizes: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """``100 - 90 + (90 * n * N) div L`` for each document, in integers of any size where 64 bits do not do."""
    if not terms:
        return np.full(len(sizes), 10, dtype=np.int64)
    if 90 * int(sizes.max(initial=0)) * documents < 2**63:
        return 10 + (90 * sizes * documents) // terms
    return np.array([10 + (90 * int(n) * documents) // terms for n in sizes], dtype=np.int64)


@dataclass
class Treap:
    """The quadtree of a block. Nodes are numbered level by level; postings are in the order of rows and documents."""

    ids: np.ndarray
    #: Levels that split documents, and those of them that split terms as well.
    levels: int
    row_levels: int
    row_bits: int
    #: Nodes before each level.
    begins: np.ndarray
    #: Key of each node down to the first level of single rows: its terms, then its documents.
    keys: np.ndarray
    best: np.ndarray
    #: First child, and whether there is a left and a right one; no child ends the path.
    child: np.ndarray
    sides: np.ndarray
    low: np.ndarray
    high: np.ndarray
    doc: np.ndarray
    impact: np.ndarray

    @property
    def last(self) -> int:
        return self.levels - LEAF_BITS

    def row_shift(self, level: int) -> int:
        return max(0, self.row_bits - ROW_BITS * level)


def _bits(n: int) -> int:
    return max(0, int(n - 1).bit_length())


def build(ids: np.ndarray, row: np.ndarray, doc: np.ndarray, impact: np.ndarray, rows: int) -> Treap:
    """The tree over postings sorted by row and document."""
    row_bits = _bits(rows)
    row_levels = -(-row_bits // ROW_BITS)
    levels = max(_bits(len(ids)), row_levels + LEAF_BITS)
    treap = Treap(ids, levels, row_levels, row_bits, *([None] * 7), doc.astype(np.int32), impact.astype(np.int32))
    keys, best, child, sides, low, high, begins = [], [], [], [], [], [], [0]

    # The upper levels: cells of several rows, from the stretches of single rows at their end.
    top = (row << row_levels) | (doc >> (levels - row_levels))
    heads = _heads(top)
    cell_row, cell_doc = row[heads], doc[heads]
    cell_best = np.maximum.reduceat(impact, heads) if len(heads) else impact[:0]
    for level in range(row_levels):
        shift = treap.row_shift(level)
        key = ((cell_row >> shift) << level) | (cell_doc >> (levels - level))
        order = np.argsort(key, kind="stable")
        at = _heads(key[order])
        keys.append(key[order][at])
        best.append(np.maximum.reduceat(cell_best[order], at) if len(at) else cell_best)
        begins.append(begins[-1] + len(at))
        empty = np.zeros(len(at), dtype=np.int64)
        for column, value in ((child, -1), (sides, 0), (low, 0), (high, 0)):
            column.append(empty + value)

    # The lower levels: halves of one row, as long as they hold more than one posting.
    starts, ends = heads, np.append(heads[1:], len(top))[: len(heads)]
    padded = np.append(impact, 0)
    for level in range(row_levels, treap.last + 1):
        if level == row_levels:
            keys.append(top[heads])
        # Every other stretch is a gap, where paths ended before.
        best.append(np.maximum.reduceat(padded, np.stack([starts, ends], axis=1).ravel())[::2] if len(starts) else impact[:0])
        begins.append(begins[-1] + len(starts))
        low.append(starts)
        high.append(ends)
        split = (ends - starts > 1) & (level < treap.last)
        some = np.flatnonzero(split)
        bit = levels - level - 1
        # The middle of each stretch: its first posting in the right half.
        held = ends[some] - starts[some]
        inside = np.repeat(np.arange(len(some)), held)
        place, _ = _places(starts[some], held)
        left = np.bincount(inside, weights=(doc[place] >> bit) & 1 == 0, minlength=len(some)).astype(np.int64)
        middle = starts[some] + left
        has_left, has_right = left > 0, middle < ends[some]
        side = np.zeros(len(starts), dtype=np.int64)
        side[some] = has_left + 2 * has_right
        number = has_left.astype(np.int64) + has_right
        first = np.full(len(starts), -1, dtype=np.int64)
        first[some] = begins[-1] + np.cumsum(number) - number
        child.append(first)
        sides.append(side)
        both = np.stack([np.where(has_left, starts[some], -1), np.where(has_right, middle, -1)], axis=1).ravel()
        stop = np.stack([middle, ends[some]], axis=1).ravel()
        starts, ends = both[both >= 0], stop[both >= 0]

    treap.begins = np.array(begins, dtype=np.int64)
    treap.keys = np.concatenate([np.zeros(0, dtype=np.int64), *keys])
    treap.best, treap.child, treap.low, treap.high = (
        np.concatenate([np.zeros(0, dtype=np.int64), *part]).astype(np.int32) for part in (best, child, low, high)
    )
    treap.sides = np.concatenate([np.zeros(0, dtype=np.int64), *sides]).astype(np.uint8)
    return treap


class Search:
    """The best documents of each item over all blocks met so far."""

    def __init__(self, item_of: np.ndarray, weight: np.ndarray, items: int, top: int = TOP) -> None:
        """``item_of`` and ``weight``: the item and the weight of each pair of an item and a term, by item."""
        self.item_of, self.weight, self.top = item_of, weight, top
        self.scores = np.zeros((items, top), dtype=np.int64)
        self.ids = np.full((items, top), _NO_ID, dtype=np.int64)

    def meet(self, treap: Treap, rows: np.ndarray) -> None:
        """Search one block; ``rows`` are the rows of the pairs' terms in it, or -1."""
        pairs = np.flatnonzero(rows >= 0)
        at = 0
        while at < len(pairs):
            end = min(at + _PAIRS, len(pairs))
            if end < len(pairs):  # no item is cut
                item = self.item_of[pairs[end - 1]]
                begin = int(np.searchsorted(self.item_of[pairs], item, side="left"))
                end = begin if begin > at else int(np.searchsorted(self.item_of[pairs], item, side="right"))
            self._descend(treap, pairs[at:end], rows[pairs[at:end]])
            at = end

    def _children(self, treap: Treap, nodes: np.ndarray, rows: np.ndarray, level: np.ndarray, place: np.ndarray, side: int) -> np.ndarray:
        """The cells of the rows below ``nodes`` in the left or right half of their documents; -1 for none."""
        out = np.full(len(nodes), -1, dtype=np.int64)
        have = nodes >= 0
        for upper in range(treap.row_levels):
            some = np.flatnonzero(have & (level == upper))
            if len(some):
                key = ((rows[some] >> treap.row_shift(upper + 1)) << (upper + 1)) | (2 * place[some] + side)
                keys = treap.keys[treap.begins[upper + 1] : treap.begins[upper + 2]]
                spot = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                out[some] = np.where(keys[spot] == key, treap.begins[upper + 1] + spot, -1)
        some = np.flatnonzero(have & (level >= treap.row_levels))
        node = nodes[some]
        sides = treap.sides[node]
        below = np.where(sides & (1 << side), treap.child[node] + (side if side == 0 else sides & 1), -1)
        # A path that ended with one posting goes on to the half that holds it.
        half = (treap.doc[treap.low[node]] >> (treap.levels - level[some] - 1)) & 1
        out[some] = np.where(sides > 0, below, np.where(half == side, node, -1))
        return out

    def _descend(self, treap: Treap, pairs: np.ndarray, rows: np.ndarray) -> None:
        items, pair_item = np.unique(self.item_of[pairs], return_inverse=True)
        weight = self.weight[pairs]
        heads = _heads(pair_item)
        scores, ids = self.scores[items], self.ids[items]
        n, each = len(items), np.arange(len(items))
        room = 16
        bound = np.full((n, room), -1, dtype=np.int64)
        level = np.zeros((n, room), dtype=np.int64)
        place = np.zeros((n, room), dtype=np.int64)
        nodes = np.full((room, len(pairs)), -1, dtype=np.int32)
        nodes[0] = 0
        bound[:, 0] = np.add.reduceat(weight * treap.best[0], heads)
        used = 1
        while True:
            best = bound[:, :used].argmax(axis=1)
            most, depth, where = bound[each, best], level[each, best], place[each, best]
            start = np.minimum(where << (treap.levels - depth), len(treap.ids) - 1)
            worst = scores[:, -1]
            # Ids rise within a block, so a range that can but tie must begin below the last id.
            active = (most > 0) & ((most > worst) | ((most == worst) & (treap.ids[start] < ids[:, -1])))
            if not active.any():
                break
            bound[each[active], best[active]] = -1
            inner, leaf = active & (depth < treap.last), active & (depth == treap.last)
            if inner.any():
                mine = np.flatnonzero(inner[pair_item])
                of = pair_item[mine]
                above = nodes[best[of], mine]
                if used + 2 > room:
                    bound, level, place = (np.pad(a, ((0, 0), (0, room)), constant_values=v) for a, v in ((bound, -1), (level, 0), (place, 0)))
                    nodes = np.pad(nodes, ((0, room), (0, 0)), constant_values=-1)
                    room *= 2
                for side in (0, 1):
                    below = self._children(treap, above, rows[mine], depth[of], where[of], side)
                    nodes[used, mine] = below
                    value = np.zeros(len(pairs), dtype=np.int64)
                    value[mine] = np.where(below >= 0, weight[mine] * treap.best[np.maximum(below, 0)], 0)
                    bound[inner, used] = np.add.reduceat(value, heads)[inner]
                    level[inner, used] = depth[inner] + 1
                    place[inner, used] = 2 * where[inner] + side
                    used += 1
            if leaf.any():
                self._sum(treap, leaf, best, where, pair_item, nodes, weight, scores, ids)
        self.scores[items], self.ids[items] = scores, ids

    def _sum(self, treap, leaf, best, where, pair_item, nodes, weight, scores, ids) -> None:
        """Add up the postings below the cells of a range of documents, and keep the best."""
        mine = np.flatnonzero(leaf[pair_item])
        node = nodes[best[pair_item[mine]], mine]
        mine, node = mine[node >= 0], node[node >= 0]
        sizes = (treap.high[node] - treap.low[node]).astype(np.int64)
        spot, _ = _places(treap.low[node], sizes)
        slot = np.cumsum(leaf) - 1
        width = 1 << LEAF_BITS
        to = np.repeat(slot[pair_item[mine]], sizes) * width + (treap.doc[spot] & (width - 1))
        value = np.repeat(weight[mine], sizes) * treap.impact[spot]
        room = int(leaf.sum()) * width
        # In two parts, as bincount adds doubles: both stay exact.
        total = np.bincount(to, value >> 24, room).astype(np.int64) << 24
        total += np.bincount(to, value & 0xFFFFFF, room).astype(np.int64)
        total = total.reshape(-1, width)
        who = np.flatnonzero(leaf)
        found, column = np.nonzero(total)
        doc = (where[who][found] << LEAF_BITS) + column
        item, score, doc_id = who[found], total[found, column], treap.ids[doc]
        better = (score > scores[item, -1]) | ((score == scores[item, -1]) & (doc_id < ids[item, -1]))
        item, score, doc_id = item[better], score[better], doc_id[better]
        if not len(item):
            return
        # Old and new in one list, by item, score and id; the first of each item stay.
        some = np.unique(item)
        item = np.concatenate([np.repeat(some, self.top), item])
        score = np.concatenate([scores[some].ravel(), score])
        doc_id = np.concatenate([ids[some].ravel(), doc_id])
        order = np.lexsort((doc_id, -score, item))
        item, score, doc_id = item[order], score[order], doc_id[order]
        begins = _heads(item)
        rank = np.arange(len(item)) - np.repeat(begins, np.diff(np.append(begins, len(item))))
        kept = rank < self.top
        scores[item[kept], rank[kept]], ids[item[kept], rank[kept]] = score[kept], doc_id[kept]


# --- the index as a table -------------------------------------------------------------------------

_NUMBERS = {
    "ids": np.int64, "measure": np.int64, "hashes": np.uint64, "term_sizes": np.int32, "letters": np.uint8, "df": np.int32,
    "begins": np.int64, "keys": np.int64, "best": np.int32, "sides": np.uint8, "sizes": np.int32, "doc": np.int32, "count": np.int32,
}
#: Kept as differences, which are small.
_STEPS = ("ids", "hashes", "keys", "doc")
_INDEX = ", ".join(["levels int", "row_levels int", "row_bits int", *(f"{name} binary" for name in _NUMBERS)])


def _pack(name: str, values: np.ndarray) -> bytes:
    """Bytes of equal weight together, which compression makes small."""
    values = np.ascontiguousarray(values, dtype=_NUMBERS[name])
    if name in _STEPS:
        values = np.diff(values, prepend=values.dtype.type(0))
    return values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def _read(batch: pa.RecordBatch, row: int, name: str) -> np.ndarray:
    kind = np.dtype(_NUMBERS[name])
    data = np.frombuffer(batch.column(batch.schema.get_field_index(name))[row].as_buffer(), dtype=np.uint8)
    values = np.ascontiguousarray(data.reshape(kind.itemsize, -1).T).view(kind).ravel()
    return np.cumsum(values, dtype=kind) if name in _STEPS else values


def impacts(count: np.ndarray, measure: np.ndarray) -> np.ndarray:
    """The part of a posting in a score that its term's weight is taken times."""
    return (1_000_000_000 * count) // (1000 * count + 8 * measure)


def _write_block(ids: np.ndarray, measure: np.ndarray, found: Postings, row: np.ndarray, doc: np.ndarray, count: np.ndarray) -> list:
    """The columns of a block. What follows from others is left out: impacts, children, places, the maxima of single postings."""
    tree = build(ids, row, doc, impacts(count, measure[doc]), len(found.hashes))
    sizes = tree.high - tree.low
    columns = {
        "ids": ids, "measure": measure, "hashes": found.hashes, "term_sizes": np.diff(found.bounds), "letters": found.letters,
        "df": np.bincount(row, minlength=len(found.hashes)), "begins": tree.begins, "keys": tree.keys, "best": tree.best[sizes != 1],
        "sides": tree.sides, "sizes": sizes, "doc": doc, "count": count,
    }
    return [tree.levels, tree.row_levels, tree.row_bits, *(_pack(name, columns[name]) for name in _NUMBERS)]


def _read_block(batch: pa.RecordBatch, row: int) -> Treap:
    levels, row_levels, row_bits = (batch.column(i)[row].as_py() for i in range(3))
    ids, measure, begins, keys, stored, sides, sizes, doc, count = (
        _read(batch, row, name) for name in ("ids", "measure", "begins", "keys", "best", "sides", "sizes", "doc", "count")
    )
    impact = impacts(count.astype(np.int64), measure[doc])
    first = int(begins[row_levels])
    children = (sides & 1) + (sides >> 1)
    child = np.full(len(sides), -1, dtype=np.int64)
    if len(begins) > row_levels + 1:
        child[first:] = begins[row_levels + 1] + np.cumsum(children[first:], dtype=np.int64) - children[first:]
    child[children == 0] = -1
    low = np.zeros(len(sides), dtype=np.int64)
    for level in range(row_levels, len(begins) - 1):
        here = np.arange(begins[level], begins[level + 1])
        if level == row_levels:
            low[here] = np.cumsum(sizes[here], dtype=np.int64) - sizes[here]
        left, right = here[sides[here] & 1 > 0], here[sides[here] & 2 > 0]
        low[child[left]] = low[left]
        beside = (sides[right] & 1).astype(np.int64)
        low[child[right] + beside] = low[right] + beside * sizes[child[right]]
    best = np.zeros(len(sides), dtype=np.int64)
    best[sizes != 1] = stored
    best[sizes == 1] = impact[low[sizes == 1]]
    return Treap(ids, levels, row_levels, row_bits, begins, keys, best, child, sides, low, low + sizes, doc, impact)


def totals(docs: DataFrame) -> tuple[int, int]:
    """``(N, L)``: the texts with a term, and all terms."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        documents = terms = 0
        for batch in batches:
            for _, data, bounds in text_pieces(batch.column(0)):
                sizes = np.zeros(len(bounds) - 1, dtype=np.int64)
                for _, starts, _, doc in _words(data, bounds, SLICE_BYTES):
                    sizes += np.bincount(doc, minlength=len(sizes))
                documents += int((sizes > 0).sum())
                terms += int(sizes.sum())
        yield pa.RecordBatch.from_arrays([pa.array([documents]), pa.array([terms])], names=["documents", "terms"])

    counted = docs.select("text").mapInArrow(count, "documents long, terms long")
    row = counted.agg(F.sum("documents"), F.sum("terms")).first()
    return int(row[0] or 0), int(row[1] or 0)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, int]:
    """The treaps of all documents, a written table with a row per block, and the number of texts with a term.

    A block is a run of rows with ``BLOCK_BYTES`` of text, of what Spark hands a
    task at a time, or one longer text. Every row is indexed, with all its terms.
    """
    texts = read_texts(docs, id_col, text_col)
    documents, terms = totals(texts)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data, bounds in text_pieces(batch.column(1), BLOCK_BYTES):
                ids = pc.fill_null(batch.column(0).slice(at, len(bounds) - 1), _NO_ID).to_numpy(zero_copy_only=False)
                order = np.argsort(ids, kind="stable")
                found = postings(lower(data), bounds)
                place = np.empty(len(ids), dtype=np.int64)
                place[order] = np.arange(len(ids))
                row, doc, count = found.row, place[found.doc], found.count
                if (order[1:] < order[:-1]).any():
                    by = np.lexsort((doc, row))
                    row, doc, count = row[by], doc[by], count[by]
                measure = length_measure(found.sizes[order], documents, terms)
                block = _write_block(ids[order], measure, found, row, doc, count)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v], pa.int32() if isinstance(v, int) else pa.binary()) for v in block],
                    names=["levels", "row_levels", "row_bits", *_NUMBERS],
                )

    return materialize(texts.mapInArrow(index, _INDEX), _INDEX_OPTIONS), documents


@dataclass
class Terms:
    """The distinct terms of the items searched for, by hash."""

    hashes: np.ndarray
    letters: np.ndarray
    bounds: np.ndarray

    @staticmethod
    def of(terms: list[str]) -> tuple[Terms, list[str]]:
        given = [t.encode() for t in terms]
        letters = np.frombuffer(b"".join(given), dtype=np.uint8)
        bounds = np.concatenate(([0], np.cumsum([len(t) for t in given], dtype=np.int64)))
        hashes = hash_words(letters, bounds[:-1], bounds[1:])
        order = np.argsort(hashes, kind="stable")
        letters, new = _gather(letters, bounds[:-1][order], np.diff(bounds)[order])
        return Terms(hashes[order], letters, new), [terms[i] for i in order]

    def rows(self, batch: pa.RecordBatch, row: int) -> np.ndarray:
        """The row of each term in a block, or -1; equal hashes are told apart by their letters."""
        hashes, term_sizes, letters = (_read(batch, row, name) for name in ("hashes", "term_sizes", "letters"))
        bounds = np.concatenate(([0], np.cumsum(term_sizes, dtype=np.int64)))
        out = np.full(len(self.hashes), -1, dtype=np.int64)
        if not len(hashes):
            return out
        spot = np.minimum(np.searchsorted(hashes, self.hashes), len(hashes) - 1)
        sizes = np.diff(self.bounds)
        same = np.flatnonzero((hashes[spot] == self.hashes) & (bounds[spot + 1] - bounds[spot] == sizes))
        if len(same):
            theirs, _ = _gather(letters, bounds[spot[same]], sizes[same])
            ours, heads = _gather(self.letters, self.bounds[:-1][same], sizes[same])
            same = same[np.add.reduceat((theirs != ours).astype(np.int64), heads[:-1]) == 0]
        out[same] = spot[same]
        return out


def term_weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def _search(index: DataFrame, documents: int, items: list[tuple[int, list[str]]], top: int) -> DataFrame:
    """``(item_key, score, doc_id)``: the best of each task."""
    context = index.sparkSession.sparkContext
    terms, names = Terms.of(sorted({t for _, held in items for t in held}))
    shared = context.broadcast(terms)

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(len(shared.value.hashes), dtype=np.int64)
        for batch in batches:
            for row in range(len(batch)):
                rows = shared.value.rows(batch, row)
                some = rows >= 0
                found[some] += _read(batch, row, "df")[rows[some]]
        some = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(found[some], pa.int64())], names=["term", "df"])

    vocabulary = index.select("hashes", "term_sizes", "letters", "df")
    # One row for each term of these items, whose number is bounded with them.
    counted = vocabulary.mapInArrow(frequencies, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect()
    weights = np.zeros(len(names), dtype=np.int64)
    for r in counted:
        weights[r["term"]] = term_weight(documents, r["df"])
    number = {name: i for i, name in enumerate(names)}
    pairs = [(i, number[t]) for i, (_, held) in enumerate(items) for t in held]
    item_of, term_of = (np.array(column, dtype=np.int64) for column in zip(*pairs))
    item_keys = np.array([key for key, _ in items], dtype=np.int64)
    plan = context.broadcast((item_of, term_of, weights[term_of], item_keys))

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item_of, term_of, weight, item_keys = plan.value
        search = Search(item_of, weight, len(item_keys), top)
        for batch in batches:
            for row in range(len(batch)):
                rows = shared.value.rows(batch, row)[term_of]
                if (rows < 0).all():
                    continue
                search.meet(_read_block(batch, row), rows)
        item, place = np.nonzero(search.scores)
        found = search.ids[item, place]
        yield pa.RecordBatch.from_arrays(
            [pa.array(item_keys[item]), pa.array(search.scores[item, place]), pa.array(found, pa.int64(), mask=found == _NO_ID)],
            names=["item_key", "score", "doc_id"],
        )

    return index.mapInArrow(best, "item_key long, score long, doc_id long")


def ranked_search(docs: DataFrame, items: DataFrame, top: int = TOP, item_chars: int = ITEM_CHARS) -> DataFrame:
    """One row per item and place: ``item_id, rank, doc_id, score``.

    All documents are indexed; the items are searched for in parts of about
    ``item_chars`` characters, each in two passes over the index, of which the
    first counts the documents of their terms. A task sends the best of each item
    alone; these are ranked in as many groups an item as the square root of the
    blocks, and then once more.

    Null and empty texts have no terms, on either side; they count nowhere and an
    item without terms gets no rows. Every item row is ranked for itself, repeated
    ids too; a repeated document is a document each time, and its equal rows are
    interchangeable. Of equal scores smaller ids come first; a document without
    id comes last and has a null ``doc_id``. Very long texts are counted in slices
    between words. Empty tables give no rows. Other columns are not read, so their
    names cannot clash.
    """
    spark = docs.sparkSession
    low = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    asked = items.select(
        F.monotonically_increasing_id().alias("item_key"),
        "item_id",
        F.array_distinct(F.regexp_extract_all(low, F.lit(TERM), F.lit(0))).alias("terms"),
    )
    asked = materialize(asked.where(F.size("terms") > 0))
    letters = asked.agg(F.sum(F.length(F.array_join("terms", "")))).first()[0] or 0
    parts = max(1, -(-letters // item_chars))
    part = F.pmod(F.xxhash64("item_key"), F.lit(parts))
    found = spark.createDataFrame([], "item_key long, score long, doc_id long")
    index, documents = build_index(docs)
    blocks = index.count()
    with small_batches(spark, 1):
        for number in range(parts):
            rows = asked.where(part == number).select("item_key", "terms").collect()
            if rows and documents:
                some = sorted((r["item_key"], r["terms"]) for r in rows)
                found = found.union(materialize(_search(index, documents, some, top)))
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    group = F.pmod(F.xxhash64("doc_id", "score"), F.lit(max(1, math.isqrt(blocks))))
    by_group = Window.partitionBy("item_key", "group").orderBy(*order)
    found = found.withColumn("group", group).withColumn("rank", F.row_number().over(by_group)).where(F.col("rank") <= top)
    rank = F.row_number().over(Window.partitionBy("item_key").orderBy(*order))
    ranked = found.select("item_key", "score", "doc_id").withColumn("rank", rank).where(F.col("rank") <= top)
    return ranked.join(asked.select("item_key", "item_id"), "item_key").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
