"""Benchmark decontamination with one Aho-Corasick automaton over the items' words.

A window of 13 words always holds a whole one of the 7-word blocks that an item
is cut into from its first word on. So the patterns of the automaton are these
blocks, which together are as long as the benchmark, and items too short for a
window as a whole. Words are written as numbers of three characters. Where a
block is found in a text, the run of equal words around it is followed to both
ends; a run of 13 words is hit, with all windows in it.
"""

from __future__ import annotations

import hashlib
from array import array
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanspark.llm.tables import materialize, read_texts
from gleanspark.llm.words import NOT_ALNUM, find_words

WINDOW_WORDS = 13
#: A document is contaminated when at least this part of its words is hit: 1 / 20.
PARTS = 20
#: Characters of the items that are searched for in one reading of the documents; some 30 bytes of memory each.
ITEM_CHARS = 4_000_000

#: Bytes of a text whose words are taken apart at a time.
PIECE = 1 << 20

#: Per byte: lower case for A-Z, a blank for what separates words.
_NORMAL = bytes(0x20 if NOT_ALNUM[b] else b + 0x20 if 0x41 <= b <= 0x5A else b for b in range(256))
#: First characters of a word's number, and the others, which are different ones, so that no number starts within another.
_FIRST, _OTHER = 100, 155
_UNKNOWN = "\xff" * 3


def normal_words(text: str | None) -> list[bytes]:
    """The words of a text: runs of ASCII letters, digits and anything beyond ASCII, A-Z lower-cased."""
    return (text or "").encode().translate(_NORMAL).split()


def word_pieces(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, in lists of about ``PIECE`` bytes."""
    normal = text.translate(_NORMAL)
    at = 0
    while at < len(normal):
        end = normal.find(b" ", at + PIECE)
        end = len(normal) if end < 0 else end
        yield normal[at:end].split()
        at = end


def _code(number: int) -> str:
    """Three characters for a number below 2.4 million."""
    rest, low = divmod(number, _OTHER)
    first, middle = divmod(rest, _OTHER)
    if first >= _FIRST:
        raise ValueError("too many different words in one part of a benchmark")
    return chr(first) + chr(_FIRST + middle) + chr(_FIRST + low)


@dataclass
class Items:
    """The distinct word sequences of some items, as numbers of their words, and the ids that have each."""

    words: list[bytes]
    sequences: list[list[int]]
    ids: list[list[str]]
    window: int = WINDOW_WORDS
    _ready: tuple | None = field(default=None, repr=False)

    @staticmethod
    def of(items: list[tuple[object, str | None]], window: int = WINDOW_WORDS) -> Items:
        numbers: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set[str]] = defaultdict(set)
        for item_id, text in items:
            sequence = tuple(numbers.setdefault(w, len(numbers)) for w in normal_words(text))
            if sequence:
                found[sequence].add(str(item_id))
        order = sorted(found)
        return Items(list(numbers), [list(s) for s in order], [sorted(found[s]) for s in order], window)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_ready": None}

    def _build(self) -> tuple:
        numbers = {w: i for i, w in enumerate(self.words)}
        codes = [_code(i) for i in range(len(self.words))] + [_UNKNOWN]
        size = (self.window + 1) // 2
        places: dict[str, list[tuple[int, int, int]]] = defaultdict(list)
        for s, sequence in enumerate(self.sequences):
            n = len(sequence)
            spans = [(0, n)] if n < self.window else [(at, size) for at in range(0, n - size + 1, size)]
            for at, length in spans:
                places["".join([codes[w] for w in sequence[at : at + length]])].append((s, at, length))
        found = ahocorasick.Automaton()
        for pattern, where in places.items():
            found.add_word(pattern, where)
        if places:
            found.make_automaton()
        return numbers, codes, found

    def scan(self, words: list[bytes]) -> tuple[dict[int, int], set[str]]:
        """Runs of hit words as first word and length, and the ids of the items that occur."""
        return self.scan_pieces([words])[1:]

    def scan_pieces(self, pieces: Iterable[list[bytes]]) -> tuple[int, dict[int, int], set[str]]:
        """The number of words of one text, given in pieces, and what :meth:`scan` gives."""
        if self._ready is None:
            self._ready = self._build()
        numbers, codes, automaton = self._ready
        hits: dict[int, int] = {}
        items: set[str] = set()
        # Of a word its number and code are held, 7 bytes, whatever its length.
        text, written = array("i"), []
        for words in pieces:
            found = [numbers.get(w, -1) for w in words]
            text.extend(found)
            written.append("".join([codes[w] for w in found]))
        if not len(automaton) or not text:
            return len(text), hits, items
        # How far the words of an item were followed, by item and difference of places.
        reach: dict[tuple[int, int], int] = {}
        for last, where in automaton.iter("".join(written)):
            end = last // 3 + 1
            for s, at, length in where:
                sequence = self.sequences[s]
                first = end - length
                key = (s, first - at)
                if reach.get(key, 0) >= end:
                    continue
                start, i = first, at
                while start and i and text[start - 1] == sequence[i - 1]:
                    start, i = start - 1, i - 1
                stop, j = end, at + length
                while stop < len(text) and j < len(sequence) and text[stop] == sequence[j]:
                    stop, j = stop + 1, j + 1
                reach[key] = stop
                if stop - start >= min(self.window, len(sequence)):
                    hits[start] = max(hits.get(start, 0), stop - start)
                    items.update(self.ids[s])
        return len(text), hits, items


#: The items a worker is searching for, with their automaton: built once in each worker.
_held: dict[str, Items] = {}


def _items_of(shared) -> Items:
    given = shared.value
    key, items = given
    if key not in _held:
        _held.clear()
        _held[key] = items
    return _held[key]


def _bytes(value: pa.Scalar) -> bytes:
    return value.as_buffer().to_pybytes() if value.is_valid else b""


_HITS = "hits array<struct<first:long,count:long>>, items array<string>"
_RESULT = (
    "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, "
    "items array<string>, spans array<struct<start:long,end:long>>"
)


def benchmark_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window_words: int = WINDOW_WORDS,
    parts: int = PARTS,
    item_chars: int = ITEM_CHARS,
) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated, items, spans``.

    ``spans`` are the hit stretches in code points of the original text. Each
    text is normalised and scanned once, where it was read; nothing is
    shuffled. A benchmark of more than ``item_chars`` characters, of any size, is
    searched for in parts of about so many: each part is one reading of the
    documents, and the hits of a document are brought together at the end.

    A null or empty text has no words and is clean; so is every text where the
    benchmark is empty. Items that repeat count once; items without id or
    without words count not at all. Repeated documents give repeated rows, a
    null id stays null. A very long text is scanned whole, by itself. Other
    columns are not read, so their names cannot clash. No rows give no rows.
    """
    spark = docs.sparkSession
    asked = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    asked = asked.where(F.col("item_id").isNotNull() & F.col("text").isNotNull())
    size = asked.agg(F.sum(F.length("text"))).first()[0] or 0
    rounds = max(1, -(-size // item_chars))
    texts = read_texts(docs, id_col, text_col)

    def held(number: int):
        part = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(rounds)) == number) if rounds > 1 else asked
        items = Items.of([(r["item_id"], r["text"]) for r in part.distinct().collect()], window_words)
        key = hashlib.sha256(repr((items.words, items.sequences, items.ids, window_words)).encode()).hexdigest()
        return spark.sparkContext.broadcast((key, items))

    if rounds == 1:
        shared = held(0)

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            items = _items_of(shared)
            for batch in batches:
                texts, counts, hits, names = [], [], [], []
                # The words of one text at a time; texts without a hit are not kept.
                for value in batch.column(1):
                    text = _bytes(value)
                    n_words, runs, ids = items.scan_pieces(word_pieces(text))
                    counts.append(n_words)
                    hits.append(runs)
                    names.append(ids)
                    texts.append(text if runs else b"")
                yield _result(batch.column(0), texts, counts, hits, names, parts)

        return texts.mapInArrow(scan, _RESULT)

    # Rows are told apart by a key that is written with them, as ids may be null or repeat.
    texts = materialize(texts.withColumn("row_key", F.monotonically_increasing_id()))
    every = None
    for number in range(rounds):
        shared = held(number)

        def look(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items = _items_of(shared)
            for batch in batches:
                keys, hits, names = [], [], []
                for key, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                    _, runs, ids = items.scan_pieces(word_pieces(_bytes(value)))
                    if runs:
                        keys.append(key)
                        hits.append([{"first": a, "count": n} for a, n in runs.items()])
                        names.append(sorted(ids))
                kinds = (pa.int64(), pa.list_(pa.struct([("first", pa.int64()), ("count", pa.int64())])), pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip((keys, hits, names), kinds)], names=["row_key", "hits", "items"])

        found = materialize(texts.select("row_key", "text").mapInArrow(look, f"row_key long, {_HITS}"))
        every = found if every is None else every.unionByName(found)
    # One row a document and part that has hits.
    merged = every.groupBy("row_key").agg(F.flatten(F.collect_list("hits")).alias("hits"), F.flatten(F.collect_list("items")).alias("items"))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [_bytes(v) for v in batch.column(1)]
            hits: list[dict[int, int]] = [{} for _ in texts]
            for i, runs in enumerate(batch.column(2).to_pylist()):
                for run in runs or ():
                    hits[i][run["first"]] = max(hits[i].get(run["first"], 0), run["count"])
            items = [set(names or ()) for names in batch.column(3).to_pylist()]
            yield _result(batch.column(0), texts, [sum(map(len, word_pieces(t))) for t in texts], hits, items, parts)

    rows = texts.join(merged, "row_key", "left").select("doc_id", "text", "hits", "items")
    return rows.mapInArrow(gather, _RESULT)


def _spans(text: bytes, covered: np.ndarray) -> list[dict[str, int]]:
    """Runs of covered words in code points of the text they were taken from."""
    data = np.frombuffer(text, dtype=np.uint8)
    starts, ends, _ = find_words(data, np.array([0, len(data)]), NOT_ALNUM)
    points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    edges = np.flatnonzero(np.diff(np.concatenate(([0], covered.astype(np.int8), [0]))))
    return [
        {"start": int(points[starts[a]]), "end": int(points[ends[b - 1]])} for a, b in zip(edges[::2], edges[1::2])
    ]


def _result(doc_ids, texts, n_words, hits, items, parts) -> pa.RecordBatch:
    n_hit, spans = [0] * len(texts), [[] for _ in texts]
    for i, found in enumerate(hits):
        if found:
            covered = np.zeros(n_words[i], dtype=bool)
            for first, count in found.items():
                covered[first : first + count] = True
            n_hit[i], spans[i] = int(covered.sum()), _spans(texts[i], covered)
    names = [sorted(found) for found in items]
    columns = {
        "doc_id": doc_ids,
        "n_words": pa.array(n_words, pa.int64()),
        "n_hit": pa.array(n_hit, pa.int64()),
        "n_items": pa.array([len(x) for x in names], pa.int64()),
        "items_sha256": pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in names], pa.string()),
        "contaminated": pa.array([h > 0 and parts * h >= n for h, n in zip(n_hit, n_words)], pa.bool_()),
        "items": pa.array(names, pa.list_(pa.string())),
        "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
    }
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
