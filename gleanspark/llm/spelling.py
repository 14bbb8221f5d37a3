"""Spelling variants: near words found by one edit matrix over the sorted vocabulary.

The vocabulary is sorted by length and word, and once more by length and reversed
word, and cut into blocks. Two words one edit apart share the first or the last
half of the shorter one, so a word is looked for where its first half stands in
the one list, and where its last half stands in the other. There the list is
walked by its longest common prefixes: words that share a prefix share the rows
of the edit matrix up to it, of which only the band of one edit is kept, and a
range whose prefix is already more than one edit away is left as a whole. The
rows of all words looked for in a block are filled side by side.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanspark.llm.tables import materialize, read_texts

RUN = r"[A-Za-zÀ-ÿ]+"
#: Runs whose crc32 this divides lose a letter.
DAMAGE = 97
MIN_LETTERS = 5
MIN_COUNT = 3
#: A form has at least so many times the occurrences of the word.
FORM_TIMES = 2
#: Words of a block of the sorted list, and its letters.
BLOCK_WORDS = 1 << 14
_BLOCK_LETTERS = 1 << 21
#: Blocks at most; a larger vocabulary has larger blocks, so that their first words fit in memory.
_MAX_BLOCKS = 100_000
#: Words that are looked for in one copy of a block, and their letters.
_LOOKED_FOR = 1 << 16
_LOOKED_FOR_LETTERS = 1 << 24
#: Words whose matrices are filled side by side, and letters of words compared at a time.
_SIDE_BY_SIDE = 1 << 9
_COMPARED_LETTERS = 1 << 24
_FAR = 9

_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def vocabulary(docs: DataFrame, damage: int = DAMAGE, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT) -> DataFrame:
    """``(word, n)``: the words of all texts with their occurrences, counted map-side first."""
    texts = read_texts(docs)
    runs = texts.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(RUN), F.lit(0))).alias("run"),
    ).where(F.length("run") >= min_letters)
    run = F.when(F.col("run").rlike("[A-Z]"), F.translate("run", _CAPITALS, _CAPITALS.lower())).otherwise(F.col("run"))
    runs = runs.select("id", run.alias("run")).withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run")))
    at = F.pmod("h", F.length("run")).cast("int")
    damaged = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = runs.select(F.when(F.col("h") % damage == 0, damaged).otherwise(F.col("run")).alias("word"))
    words = words.where(F.length("word") >= min_letters)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def shared_letters(size: int) -> int:
    """So many letters a word has in common with any near word, at its begin or at its end."""
    return (size - 1) // 2


def _matrix(keys: list[bytes], size: int) -> np.ndarray:
    return np.frombuffer(b"".join(keys), dtype=np.uint8).reshape(len(keys), size)


def _prefixes(rows: np.ndarray, size: int) -> np.ndarray:
    return np.ascontiguousarray(rows[:, :size]).view(f"S{size}").ravel()


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the words of the rows of ``a`` and ``b`` differ by exactly one edit; widths differ by one at most."""
    if a.shape[1] > b.shape[1]:
        a, b = b, a
    short, long = a.shape[1], b.shape[1]
    head = np.cumprod(a == b[:, :short], axis=1, dtype=np.int8).sum(axis=1, dtype=np.int64)
    tail = np.cumprod((a == b[:, long - short :])[:, ::-1], axis=1, dtype=np.int8).sum(axis=1, dtype=np.int64)
    if short == long:
        return (head < short) & (head + tail >= short - 1)
    return head + tail >= short


def near_pairs(words: np.ndarray, wanted: np.ndarray, shared: int) -> tuple[np.ndarray, np.ndarray]:
    """Places ``(in wanted, in words)`` of words one edit apart that share their first ``shared`` letters.

    Both are matrices of letters, a word a row; ``words`` is sorted and its rows
    differ, and the widths differ by one at most.
    """
    size, length = words.shape[1], wanted.shape[1]
    none = np.zeros(0, dtype=np.int64)
    if not len(words) or not len(wanted):
        return none, none
    differ = words[1:] != words[:-1]
    lcp = np.concatenate(([-1], np.where(differ.any(axis=1), differ.argmax(axis=1), size)))
    heads = _prefixes(words, shared)
    first, last = (np.searchsorted(heads, _prefixes(wanted, shared), side) for side in ("left", "right"))
    found_wanted, found_words = [], []

    def finish(who: np.ndarray, row: np.ndarray) -> None:
        step = max(1, _COMPARED_LETTERS // size)
        for at in range(0, len(who), step):
            some, other = who[at : at + step], row[at : at + step]
            hit = one_edit(wanted[some], words[other])
            found_wanted.append(some[hit])
            found_words.append(other[hit])

    for begin in range(0, len(wanted), _SIDE_BY_SIDE):
        who = np.arange(begin, min(begin + _SIDE_BY_SIDE, len(wanted)))
        low, high = first[who], last[who]
        # Row `shared` of each matrix, columns shared - 1 to shared + 1: the prefix is the same.
        band = np.tile(np.array([1, 0, 1], dtype=np.int8), (len(who), 1))
        depth = shared
        while len(who):
            single = high - low == 1
            finish(who[single], low[single])
            open_ = high - low > 1
            who, low, high, band = who[open_], low[open_], high[open_], band[open_]
            if not len(who) or depth == size:
                break
            # The ranges of words that share one letter more, and that letter.
            starts = np.flatnonzero(lcp <= depth)
            a, b = np.searchsorted(starts, low), np.searchsorted(starts, high)
            parts = b - a
            parent = np.repeat(np.arange(len(who)), parts)
            place = np.arange(len(parent)) - np.repeat(np.cumsum(parts) - parts, parts) + a[parent]
            ends = np.append(starts, len(words))
            low, high, who, above = starts[place], ends[place + 1], who[parent], band[parent]
            letter = words[low, depth]
            # The next row of the band from the row above.
            cost = np.full((len(who), 3), _FAR, dtype=np.int8)
            for k in range(3):
                column = depth - 1 + k
                if column < length:
                    cost[:, k] = letter != wanted[who, column]
            band = np.minimum(above + cost, _FAR)
            band[:, :2] = np.minimum(band[:, :2], above[:, 1:] + 1)
            for k in (1, 2):
                band[:, k] = np.minimum(band[:, k], band[:, k - 1] + 1)
            depth += 1
            # What is left of both words adds at least the difference of what is left.
            columns = depth - 1 + np.arange(3)
            band[:, columns > length] = _FAR
            alive = (band + np.abs((size - depth) - (length - columns))).min(axis=1) <= 1
            who, low, high, band = who[alive], low[alive], high[alive], band[alive]
    return np.concatenate([none, *found_wanted]), np.concatenate([none, *found_words])


def _cut_blocks(block_words: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        group, words, letters = None, 0, 0
        for batch in batches:
            blocks = np.empty(len(batch), dtype=np.int64)
            backs, sizes = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy()
            for i in range(len(batch)):
                if (backs[i], sizes[i]) != group or words >= block_words or letters >= _BLOCK_LETTERS:
                    group, words, letters = (backs[i], sizes[i]), 0, 0
                    number += 1
                words += 1
                letters += int(sizes[i])
                blocks[i] = number
            yield pa.RecordBatch.from_arrays([pa.array(blocks), *batch.columns], names=["block", *batch.schema.names])

    return cut


def sorted_lists(words: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``(block, back, size, key, n)``: the words by length and letters, forward and reversed, in blocks of one length."""
    count = words.count()
    block_words = max(block_words, 2 * count // _MAX_BLOCKS + 1)
    # Letters are below U+0100, so one byte each keeps their order.
    sides = [
        words.select(F.lit(back).alias("back"), F.length("word").alias("size"), F.encode(word, "ISO-8859-1").alias("key"), "n")
        for back, word in ((0, F.col("word")), (1, F.reverse("word")))
    ]
    tasks = words.sparkSession.sparkContext.defaultParallelism
    parts = max(1, min(tasks, count // 4096), count >> 19)
    order = ["back", "size", "key"]
    ordered = sides[0].union(sides[1]).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return ordered.mapInArrow(_cut_blocks(block_words), "block long, back int, size int, key binary, n long")


def _places(starts: dict[tuple[int, int], tuple[list[bytes], list[int]]], min_letters: int):
    """Sends every word to the blocks where a near word may stand."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            backs, sizes, keys = (batch.column(k).to_pylist() for k in range(3))
            rows, targets = [], []
            for i, key in enumerate(keys):
                size = sizes[i]
                head = key[: shared_letters(size)]
                # No letter is 0xFF twice over: what starts with `head` sorts below this.
                after = head + b"\xff" * (size + 2)
                for other in (size - 1, size, size + 1):
                    first, blocks = starts.get((backs[i], other), ((), ()))
                    if other < min_letters or not blocks:
                        continue
                    low = max(0, bisect_right(first, head) - 1)
                    for at in range(low, max(low, bisect_right(first, after) - 1) + 1):
                        rows.append(i)
                        targets.append(blocks[at])
            kept = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(targets, pa.int64()), *kept.columns], names=["block", *batch.schema.names])

    return send


def _look(table: pa.Table) -> pa.Table:
    """The near words of the words looked for in one block: their number and the most frequent one."""
    listed = table.filter(pc.equal(table["wanted"], False))
    wanted = table.filter(pc.equal(table["wanted"], True))
    out: dict[str, list] = {"word": [], "n_near": [], "form": [], "form_n": []}
    if len(listed) and len(wanted):
        size, back = listed["size"][0].as_py(), listed["back"][0].as_py()
        listed = listed.sort_by("key")
        keys, counts = listed["key"].to_pylist(), listed["n"].to_numpy()
        words = _matrix(keys, size)
        for length in (size - 1, size, size + 1):
            some = wanted.filter(pc.equal(wanted["size"], length))
            if not len(some):
                continue
            asked = some["key"].to_pylist()
            letters = _matrix(asked, length)
            shared = shared_letters(length)
            who, row = near_pairs(words, letters, shared)
            if back and len(who):
                # Pairs that share their first half as well were found in the other list.
                again = (words[row, size - shared :] == letters[who, length - shared :]).all(axis=1)
                who, row = who[~again], row[~again]
            if not len(who):
                continue
            text = [k[::-1] if back else k for k in keys]
            # Of each word's near words the most frequent, then the smallest; rows are sorted as read.
            rank = np.argsort(np.argsort(np.array(text, dtype=object), kind="stable"), kind="stable") if back else np.arange(len(keys))
            order = np.lexsort((rank[row], -counts[row], who))
            who, row = who[order], row[order]
            heads = np.flatnonzero(np.concatenate(([True], who[1:] != who[:-1])))
            out["n_near"].extend(np.diff(np.append(heads, len(who))).tolist())
            out["form_n"].extend(counts[row[heads]].tolist())
            out["form"].extend(text[r].decode("latin-1") for r in row[heads])
            out["word"].extend((asked[w][::-1] if back else asked[w]).decode("latin-1") for w in who[heads])
    types = {"word": pa.string(), "n_near": pa.int64(), "form": pa.string(), "form_n": pa.int64()}
    return pa.table({name: pa.array(out[name], t) for name, t in types.items()})


def near_words(words: DataFrame, block_words: int = BLOCK_WORDS, looked_for: int = _LOOKED_FOR, min_letters: int = MIN_LETTERS) -> DataFrame:
    """``(word, n_near, form, form_n)``, several rows a word: its near words in one place of a list, counted, and the most frequent.

    A block is copied once for every ``looked_for`` words that are to be looked
    for in it, so no task holds more than one block and about so many words,
    however many words begin alike.
    """
    spark = words.sparkSession
    lists = materialize(sorted_lists(words, block_words))
    # One row a block: their number is bounded by _MAX_BLOCKS, and by one a length and task.
    firsts = lists.groupBy("block", "back", "size").agg(F.min("key").alias("key")).collect()
    starts: dict[tuple[int, int], tuple[list[bytes], list[int]]] = {}
    for r in sorted(firsts, key=lambda r: (r["back"], r["size"], bytes(r["key"]))):
        keys, blocks = starts.setdefault((r["back"], r["size"]), ([], []))
        keys.append(bytes(r["key"]))
        blocks.append(r["block"])
    shape = "block long, back int, size int, key binary, n long"
    wanted = materialize(lists.select("back", "size", "key", "n").mapInArrow(_places(starts, min_letters), shape))
    copies = F.greatest(F.ceil(F.count(F.lit(1)) / looked_for), F.ceil(F.sum("size") / _LOOKED_FOR_LETTERS))
    copies = materialize(wanted.groupBy("block").agg(copies.cast("int").alias("copies")))
    total = copies.agg(F.sum("copies")).first()[0] or 0
    small = F.broadcast(copies)  # one row a block, see above
    dealt = wanted.join(small, "block").withColumn("copy", F.pmod(F.xxhash64("key"), "copies").cast("int"))
    listed = lists.join(small, "block").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    names = ["block", "copy", "back", "size", "key", "n"]
    both = dealt.select(*names, F.lit(True).alias("wanted")).union(listed.select(*names, F.lit(False).alias("wanted")))
    tasks = max(1, min(total, 4 * spark.sparkContext.defaultParallelism), total // 16)
    return (
        both.repartition(tasks, "block", "copy")
        .groupBy("block", "copy")
        .applyInArrow(_look, "word string, n_near long, form string, form_n long")
    )


def follow(forms: DataFrame) -> DataFrame:
    """``(word, root)`` from ``(word, form)``: pointers are doubled until none moves on.

    A form has twice its word's occurrences, so there are no cycles and the number
    of rounds is the logarithm of a logarithm of the largest count.
    """
    at = materialize(forms.select("word", F.col("form").alias("root")))
    while True:
        onward = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = materialize(at.join(onward, "root", "left").select("word", "root", "next"))
        at = moved.select("word", F.coalesce("next", "root").alias("root"))
        if moved.where("next is not null").isEmpty():
            return at


def spelling_variants(
    docs: DataFrame,
    damage: int = DAMAGE,
    min_letters: int = MIN_LETTERS,
    min_count: int = MIN_COUNT,
    form_times: int = FORM_TIMES,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """One row per word: ``word, form, root, n, n_near, form_n``.

    Null and empty texts have no words; a row without id is hashed with an empty
    id; repeated rows count each. Equal counts are decided by code points. Runs of
    any length are words, compared whole. No rows give none; other columns are
    not read, so their names cannot clash. ``min_letters`` is at least 3.
    """
    words = materialize(vocabulary(docs, damage, min_letters, min_count))
    parts = materialize(near_words(words, block_words, min_letters=min_letters))
    best = F.struct((-F.col("form_n")).alias("less"), F.col("form").alias("form"))
    rows = words.select("word", "n", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("struct<less:long,form:string>").alias("best"))
    rows = rows.union(parts.select("word", F.lit(None).cast("long"), "n_near", best))
    found = rows.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min("best").alias("best"))
    fits = -F.col("best.less") >= form_times * F.col("n")
    found = materialize(
        found.select(
            "word", F.when(fits, F.col("best.form")).alias("form"), "n", "n_near", F.when(fits, -F.col("best.less")).alias("form_n")
        )
    )
    roots = follow(found.where("form is not null").select("word", "form"))
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
