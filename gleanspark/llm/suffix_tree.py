"""A probabilistic suffix tree over words: learned from counts of the whole corpus, used to score texts.

The root is the add-one word distribution. The tree has two parts, and a context
becomes a state in both when the divergence of its next-word distribution from that
of the longest state that ends it, times its count, passes ``MIN_DIVERGENCE``.

Frequent contexts travel with the tasks. A context of one to ``MAX_DEPTH`` words is
one of them when it makes up ``MIN_SHARE`` of the training tokens; its next words
are kept that take ``MIN_NEXT`` of it or ``MIN_SHARE`` of all tokens. So this part
has a bounded size: at most 1 / MIN_SHARE contexts a depth, 1 / MIN_NEXT next words
each. All words in it have a share of ``MIN_SHARE * MIN_NEXT`` at least.

All other words are contexts of one word in a written table, which grows with the
corpus: their next words are kept that follow ``MIN_PAIR`` times, an absolute count.
Such a state changes the score of a token by a sum of two terms, the mass it leaves
to the root and the gain of the next word, so that texts meet the states in two
shuffled joins, one by word, which also brings the counts of the words that do not
travel, and one by pair.

Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanspark.llm.language import is_held_out
from gleanspark.llm.tables import materialize
from gleanspark.llm.words import _TERMS, WHITE, as_long, find_words, hash_words, lower, mix, text_pieces

MAX_DEPTH = 3
MIN_SHARE = 1e-5
MIN_NEXT = 0.05
#: Times that a next word must follow a context of the written table.
MIN_PAIR = 2
#: Nats; a context must explain this much of the corpus to be a state.
MIN_DIVERGENCE = 20.0
#: Pseudo-count by which each state leans on its parent.
PARENT_WEIGHT = 1.0
#: Taken off each count of a next word, for the parent's share.
DISCOUNT = 0.75
#: Tokens or pairs a task counts before it hands the counts on.
COUNTED = 4_000_000
#: Pairs that one task adds up at a time.
BUCKET_PAIRS = 4_000_000
END = np.uint64(0x5BD1E9955BD1E995)


def _tokens(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first row, token hashes, bounds)``, an end token behind each text."""
    for row, data, bounds in text_pieces(column):
        data = lower(data)
        starts, ends, words = find_words(data, bounds, WHITE)
        hashes = hash_words(data, starts, ends)
        yield row, np.insert(hashes, words[1:], END), words + np.arange(len(words))


def _lookup(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places in the rising ``keys``; -1 where there is none."""
    if not len(keys) or not len(wanted):
        return np.full(len(wanted), -1, dtype=np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


@dataclass
class Level:
    """Contexts of one depth: their rising ``keys``, their words (places in the tree's), counts and parents."""

    keys: np.ndarray
    words: np.ndarray
    counts: np.ndarray
    #: Place of the context without its first word, one depth up.
    parent: np.ndarray
    state: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=bool))
    #: log10 of the mass that a state leaves to its parent.
    left: np.ndarray = field(default_factory=lambda: np.zeros(0))
    #: Context and next word as one rising key, and the count.
    pairs: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))
    pair_counts: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))

    def share(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The part of a next word's probability that the states themselves give; 0 for words they do not hold."""
        found = _lookup(self.pairs, _pair(context, word))
        own = self.pair_counts[np.maximum(found, 0)] - DISCOUNT if len(self.pairs) else np.zeros(len(found))
        return np.where((found >= 0) & (word >= 0), own, 0) / (self.counts[context] + PARENT_WEIGHT)


@dataclass
class SuffixTree:
    words: np.ndarray
    word_counts: np.ndarray
    tokens: int
    distinct: int
    #: From this share of the tokens on, words are held here.
    min_word_share: float
    levels: list[Level]
    #: log10 of the mass that each word leaves to the root as a context of the written table; 0 where it is no state.
    word_left: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def base(self, counts: np.ndarray) -> np.ndarray:
        return (counts + 1) / (self.tokens + self.distinct + 1)

    def contexts(self, hashes: np.ndarray, bounds: np.ndarray, depth: int) -> np.ndarray:
        """For each token the place of the context of ``depth`` words before it, or -1."""
        out = np.full(len(hashes), -1, dtype=np.int64)
        n = len(hashes) - depth
        if n > 0:
            raw = np.zeros(n, dtype=np.uint64)
            for i in range(depth):
                raw += hashes[i : i + n] * _TERMS[i]
            start = np.repeat(bounds[:-1], np.diff(bounds))
            inside = np.flatnonzero(np.arange(depth, len(hashes)) - start[depth:] >= depth)
            out[inside + depth] = _lookup(self.levels[depth - 1].keys, mix(raw[inside]))
        return out

    def outside(self, hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Places of the tokens that follow a word which is no context of the levels."""
        follows = np.ones(len(hashes), dtype=bool)
        follows[bounds[:-1]] = False
        if self.levels:
            follows &= self.contexts(hashes, bounds, 1) < 0
        return np.flatnonzero(follows)

    def score(self, hashes: np.ndarray, bounds: np.ndarray, word: np.ndarray) -> np.ndarray:
        """log10 of each token's probability by the levels, without the base part of the words that are not held here."""
        held = word >= 0
        logs = np.zeros(len(hashes))
        logs[held] = np.log10(self.base(self.word_counts[word[held]]))
        # From short to long contexts: a state mixes its own counts with what its parent says.
        for depth, level in enumerate(self.levels, 1):
            context = self.contexts(hashes, bounds, depth)
            at = np.flatnonzero(context >= 0)
            at = at[level.state[context[at]]] if len(level.state) else at[:0]
            if not len(at):
                continue
            c = context[at]
            own, parent = level.share(c, word[at]), logs[at] + level.left[c]
            logs[at] = np.where(own > 0, np.log10(own + 10.0**parent), parent)
        return logs


def _pair(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    return (context << 32) | (word & 0xFFFFFFFF)


def _pair_key(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """One hash for two words, given by theirs."""
    return mix(context * _TERMS[0] + word * _TERMS[1])


@F.pandas_udf(T.LongType())
def _pair_keys(context: pd.Series, word: pd.Series) -> pd.Series:
    return pd.Series(as_long(_pair_key(context.to_numpy(np.int64).view(np.uint64), word.to_numpy(np.int64).view(np.uint64))))


def _word_counts(texts: DataFrame) -> DataFrame:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def hand_on() -> pa.RecordBatch:
            words, counts = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(as_long(words)), pa.array(counts.astype(np.int64))], names=["word", "count"])

        for batch in batches:
            for _, hashes, _ in _tokens(batch.column(1)):
                held.append(hashes)
                if sum(map(len, held)) >= COUNTED:
                    yield hand_on()
                    held = []
        if held:
            yield hand_on()

    rows = texts.mapInArrow(count, "word long, count long")
    return materialize(rows.groupBy("word").agg(F.sum("count").alias("count")))


def _pack(buckets: int, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """Counted pairs as blobs by bucket: the differences of the rising keys, and the counts."""
    bucket = (mix(keys.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    keys, counts, bounds = keys[order], counts[order], np.searchsorted(bucket[order], np.arange(buckets + 1))
    rows = []
    for b in np.flatnonzero(np.diff(bounds)):
        part = keys[bounds[b] : bounds[b + 1]]
        steps = np.diff(part, prepend=np.int64(0))
        # Bytes of equal weight together, most of them zero, which the shuffle's compression removes.
        packed = steps.view(np.uint8).reshape(-1, 8).T.tobytes()
        rows.append((int(b), packed, counts[bounds[b] : bounds[b + 1]].astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()))
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.int32(), pa.binary(), pa.binary()))],
        names=["bucket", "keys", "counts"],
    )


def _unpack(keys: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    steps = np.ascontiguousarray(np.frombuffer(keys, dtype=np.uint8).reshape(8, -1).T).view(np.int64).ravel()
    found = np.ascontiguousarray(np.frombuffer(counts, dtype=np.uint8).reshape(4, -1).T).view("<u4").ravel()
    return np.cumsum(steps), found.astype(np.int64)


def _pair_counts(texts: DataFrame, tree: SuffixTree, depth: int, buckets: int, keep: Callable) -> DataFrame:
    """``(pair, count)`` for the contexts of ``depth`` and the words the tree holds, of those that ``keep`` says."""
    shared = texts.sparkSession.sparkContext.broadcast(tree)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, held = shared.value, []

        def hand_on() -> pa.RecordBatch:
            return _pack(buckets, *np.unique(np.concatenate(held), return_counts=True))

        for batch in batches:
            for _, hashes, bounds in _tokens(batch.column(1)):
                context = known.contexts(hashes, bounds, depth)
                at = np.flatnonzero(context >= 0)
                word = _lookup(known.words, hashes[at])
                held.append(_pair(context[at], word)[word >= 0])
                if sum(map(len, held)) >= COUNTED:
                    yield hand_on()
                    held = []
        if sum(map(len, held)):
            yield hand_on()

    def add_up(table: pa.Table) -> pa.Table:
        parts = [_unpack(k.as_py(), c.as_py()) for k, c in zip(table.column("keys"), table.column("counts"))]
        keys, counts = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        keys, counts = keys[first], np.add.reduceat(counts, first)
        kept = keep(shared.value, keys, counts)
        return pa.table({"pair": keys[kept], "count": counts[kept]})

    packed = texts.mapInArrow(count, "bucket int, keys binary, counts binary")
    return packed.groupBy("bucket").applyInArrow(add_up, "pair long, count long")


def learn(
    texts: DataFrame,
    counts: DataFrame,
    max_depth: int = MAX_DEPTH,
    min_share: float = MIN_SHARE,
    min_next: float = MIN_NEXT,
    min_divergence: float = MIN_DIVERGENCE,
) -> SuffixTree:
    """The tree of the training ``texts``, whose words' ``counts`` are given."""
    row = counts.agg(F.sum("count").alias("n"), F.count(F.lit(1)).alias("v")).first()
    tokens, distinct = int(row["n"] or 0), int(row["v"])
    # At most 1 / (min_share * min_next) words.
    often = counts.where(F.col("count") >= tokens * (min_share * min_next)).toPandas()
    words = often["word"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(words)
    words, word_counts = words[order], often["count"].to_numpy(np.int64)[order]
    tree = SuffixTree(words, word_counts, tokens, distinct, min_share * min_next, [])
    chosen = np.flatnonzero((word_counts >= tokens * min_share) & (words != END))
    contexts, seen = chosen[:, None], word_counts[chosen]
    buckets = max(int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(tokens / BUCKET_PAIRS))
    for depth in range(1, max_depth + 1):
        if not len(contexts):
            break
        keys = _keys(words, contexts)
        order = np.argsort(keys)
        contexts = contexts[order]
        # As frequent as its longer context at least, so a candidate too.
        parent = _lookup(tree.levels[-1].keys, _keys(words, contexts[:, 1:])) if tree.levels else np.zeros(0, dtype=np.int64)
        level = Level(keys[order], contexts, seen[order], parent)
        tree.levels.append(level)
        least = tokens * min_share

        def keep(known: SuffixTree, pairs: np.ndarray, found: np.ndarray, depth=depth, least=least) -> np.ndarray:
            return (found >= min_next * known.levels[depth - 1].counts[pairs >> 32]) | (found >= least)

        # At most 1 / min_next next words of a context, and 1 / min_share pairs more of each depth.
        got = _pair_counts(texts, tree, depth, buckets, keep).toPandas().sort_values("pair")
        pairs, found = got["pair"].to_numpy(np.int64), got["count"].to_numpy(np.int64)
        _test(tree, depth, pairs, found, min_next, least, min_divergence)
        longer = (found >= least) & (words[pairs & 0xFFFFFFFF] != END)
        contexts = np.column_stack((level.words[pairs[longer] >> 32], pairs[longer] & 0xFFFFFFFF))
        seen = found[longer]
    return tree


def _test(tree: SuffixTree, depth: int, pairs: np.ndarray, found: np.ndarray, min_next: float, least: float, min_divergence: float) -> None:
    """Make states of the contexts whose next words diverge from what their parents say."""
    level = tree.levels[depth - 1]
    context, word = pairs >> 32, pairs & 0xFFFFFFFF
    kept = (found >= min_next * level.counts[context]) | (found >= least)
    context, word, pairs, found = context[kept], word[kept], pairs[kept], found[kept]
    share = found / level.counts[context]
    expected = _expected(tree, depth, context, word)
    # What is not kept counts as one more symbol on both sides.
    n = len(level.keys)
    rest = np.maximum(1 - np.bincount(context, share, n), 1e-12)
    rest_expected = np.maximum(1 - np.bincount(context, expected, n), 1e-12)
    divergence = np.bincount(context, share * np.log(share / expected), n) + rest * np.log(rest / rest_expected)
    level.state = divergence * level.counts >= min_divergence
    of_state = level.state[context]
    level.pairs, level.pair_counts = pairs[of_state], found[of_state]
    held = np.bincount(context[of_state], found[of_state] - DISCOUNT, n)
    level.left = np.log10((level.counts - held + PARENT_WEIGHT) / (level.counts + PARENT_WEIGHT))


def _expected(tree: SuffixTree, depth: int, context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """What the parents of contexts of ``depth`` say of their next words, the root being the base distribution."""
    chance = tree.base(tree.word_counts[word])
    suffixes = []
    for level in reversed(tree.levels[1:depth]):
        context = level.parent[context]
        suffixes.append(context)
    for level, place in zip(tree.levels, reversed(suffixes)):
        mixed = level.share(place, word) + 10.0 ** level.left[place] * chance
        chance = np.where(level.state[place], mixed, chance)
    return chance


def _keys(words: np.ndarray, contexts: np.ndarray) -> np.ndarray:
    """The hash of each context's words, as :meth:`SuffixTree.contexts` takes it from a text."""
    total = np.zeros(len(contexts), dtype=np.uint64)
    for i in range(contexts.shape[1]):
        total += words[contexts[:, i]] * _TERMS[i]
    return mix(total)


def _followers(texts: DataFrame, tree: SuffixTree, min_pair: int) -> DataFrame:
    """``(context, word, count)``: the words that follow a word outside the levels ``min_pair`` times or more."""
    shared = texts.sparkSession.sparkContext.broadcast(tree)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, contexts, words = shared.value, [], []

        def hand_on() -> pa.RecordBatch:
            context, word = np.concatenate(contexts), np.concatenate(words)
            keys = _pair_key(context, word)
            order = np.argsort(keys)
            keys = keys[order]
            runs = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            first, counts = order[runs], np.diff(runs, append=len(keys))
            columns = [pa.array(as_long(context[first])), pa.array(as_long(word[first])), pa.array(counts.astype(np.int64))]
            return pa.RecordBatch.from_arrays(columns, names=["context", "word", "count"])

        for batch in batches:
            for _, hashes, bounds in _tokens(batch.column(1)):
                at = known.outside(hashes, bounds)
                contexts.append(hashes[at - 1])
                words.append(hashes[at])
                if sum(map(len, words)) >= COUNTED:
                    yield hand_on()
                    contexts, words = [], []
        if sum(map(len, words)):
            yield hand_on()

    rows = texts.mapInArrow(count, "context long, word long, count long")
    return rows.groupBy("context", "word").agg(F.sum("count").alias("count")).where(F.col("count") >= min_pair)


def learn_table(
    texts: DataFrame, counts: DataFrame, tree: SuffixTree, min_pair: int = MIN_PAIR, min_divergence: float = MIN_DIVERGENCE
) -> tuple[DataFrame, DataFrame]:
    """The written part of the tree: states ``(context, total, left)`` and next words ``(pair, gain)``, in log10.

    A token after a state has ``left`` more than its base score, and ``gain`` besides
    where the state holds it. Sets the ``word_left`` of the words that travel.
    """
    pairs = materialize(_followers(texts, tree, min_pair))
    total = F.lit(float(tree.tokens + tree.distinct + 1))
    found = pairs.join(counts.select(F.col("word").alias("context"), F.col("count").alias("total")), "context")
    found = materialize(found.join(counts.select("word", ((F.col("count") + 1) / total).alias("base")), "word"))
    share = F.col("count") / F.col("total")
    summed = found.groupBy("context", "total").agg(
        F.sum(F.col("count") - DISCOUNT).alias("held"),
        F.sum(share * F.log(share / F.col("base"))).alias("divergence"),
        # What is not kept counts as one more symbol on both sides.
        F.greatest(1 - F.sum(share), F.lit(1e-12)).alias("rest"),
        F.greatest(1 - F.sum("base"), F.lit(1e-12)).alias("rest_base"),
    )
    divergence = F.col("divergence") + F.col("rest") * F.log(F.col("rest") / F.col("rest_base"))
    left = (F.col("total") - F.col("held") + PARENT_WEIGHT) / (F.col("total") + PARENT_WEIGHT)
    chosen = summed.where(divergence * F.col("total") >= min_divergence)
    states = materialize(chosen.select("context", "total", F.log10(left).alias("left")))
    own = (F.col("count") - DISCOUNT) / (F.col("total") + PARENT_WEIGHT)
    held = found.join(states.select("context", "left"), "context")
    gain = F.log10(1 + own / (F.pow(F.lit(10.0), F.col("left")) * F.col("base")))
    gains = materialize(held.select(_pair_keys("context", "word").alias("pair"), gain.alias("gain")))
    tree.word_left = np.zeros(len(tree.words))
    # Words of the tree only, at most 1 / min_word_share.
    often = states.where(F.col("total") >= tree.tokens * tree.min_word_share).toPandas()
    place = _lookup(tree.words, often["context"].to_numpy(np.int64).view(np.uint64))
    tree.word_left[place[place >= 0]] = often["left"].to_numpy(np.float64)[place >= 0]
    return states, gains


def _counted(values: np.ndarray, text: np.ndarray, n: int) -> tuple[pa.Array, pa.Array]:
    """The distinct values of each of ``n`` texts and their times, as two list columns."""
    order = np.argsort(values)
    # Sixteen bits are sorted by counting.
    order = order[np.argsort(text[order].astype(np.uint16 if n < 1 << 16 else np.uint32), kind="stable")]
    values, text = values[order], text[order]
    new = np.ones(len(values), dtype=bool)
    new[1:] = (values[1:] != values[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    edges = pa.array(np.searchsorted(text[first], np.arange(n + 1)).astype(np.int32))
    times = np.diff(first, append=len(values)).astype(np.int32)
    return pa.ListArray.from_arrays(edges, pa.array(as_long(values[first]))), pa.ListArray.from_arrays(edges, pa.array(times))


def _listed(values: np.ndarray, text: np.ndarray, n: int) -> pa.Array:
    """The values of each of ``n`` texts, which rise, as a list column."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(text, np.arange(n + 1)).astype(np.int32)), pa.array(as_long(values)))


def score_texts(rows: DataFrame, tree: SuffixTree, counts: DataFrame, states: DataFrame, gains: DataFrame) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` of ``(doc_id, text, held_out)``.

    Words of the tree are scored where the text is read. Each other word of a
    document is one row, which meets the corpus counts and the state of the word in
    a join, and so is each pair of words behind a context of the written table. The
    sums per row of the input are merged before they are shuffled.
    """
    shared = rows.sparkSession.sparkContext.broadcast(tree)
    names = ["doc_id", "held_out", "n_tokens", "known", "base", "model", "words", "times", "pairs"]

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for row, hashes, bounds in _tokens(batch.column(1)):
                n = len(bounds) - 1
                word = _lookup(known.words, hashes)
                owner = np.repeat(np.arange(n), np.diff(bounds))
                held = word >= 0
                base = np.zeros(len(word))
                base[held] = np.log10(known.base(known.word_counts[word[held]]))
                model = known.score(hashes, bounds, word)
                at = known.outside(hashes, bounds)
                before = word[at - 1]
                left = np.zeros(len(at))
                left[before >= 0] = known.word_left[before[before >= 0]]
                model[at] += left
                # Whether a word that does not travel is a state is seen in the join.
                at = at[(before < 0) | (left < 0)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(row, n),
                        batch.column(2).slice(row, n),
                        pa.array(np.diff(bounds)),
                        pa.array(np.bincount(owner[held], minlength=n)),
                        pa.array(np.bincount(owner, base, n)),
                        pa.array(np.bincount(owner, model, n)),
                        *_counted(hashes[~held], owner[~held], n),
                        _listed(_pair_key(hashes[at - 1], hashes[at]), owner[at], n),
                    ],
                    names=names,
                )

    schema = (
        "doc_id long, held_out boolean, n_tokens long, known long, base double, model double, "
        "words array<long>, times array<int>, pairs array<long>"
    )
    scored = rows.select("doc_id", "text", "held_out").mapInArrow(local, schema)
    # Ids may be null or repeat; the key is written with the row, so it stays the same in all readings.
    scored = materialize(scored.withColumn("row_key", F.monotonically_increasing_id()))

    words = scored.select("row_key", F.explode(F.arrays_zip("words", "times")).alias("w"))
    words = words.select("row_key", F.col("w.words").alias("word"), F.col("w.times").alias("times"))
    less = counts.where(F.col("count") < tree.tokens * tree.min_word_share)
    less = less.join(states.select(F.col("context").alias("word"), "left"), "word", "left")
    total = F.lit(float(tree.tokens + tree.distinct + 1))
    log = F.log10((F.coalesce("count", F.lit(0)) + 1) / total)
    rare = words.join(less, "word", "left").select(
        "row_key",
        (F.col("times") * log).alias("rare"),
        F.when(F.col("count").isNotNull(), F.col("times")).alias("rare_known"),
        (F.col("times") * F.coalesce("left", F.lit(0.0))).alias("more"),
    )
    behind = scored.select("row_key", F.explode("pairs").alias("pair")).join(gains, "pair").select(
        "row_key", F.lit(0.0).alias("rare"), F.lit(None).cast("int").alias("rare_known"), F.col("gain").alias("more")
    )
    sums = rare.unionByName(behind).groupBy("row_key").agg(*[F.sum(c).alias(c) for c in ("rare", "rare_known", "more")])
    rest = F.coalesce("rare", F.lit(0.0))
    return (
        scored.drop("words", "times", "pairs")
        .join(sums, "row_key", "left")
        .select(
            "doc_id",
            "held_out",
            "n_tokens",
            (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
            F.lit(tree.tokens).cast("long").alias("train_tokens"),
            (F.col("base") + rest).alias("base_score"),
            (F.col("model") + rest + F.coalesce("more", F.lit(0.0))).alias("score"),
        )
    )


def language_model_scores(
    docs: DataFrame,
    folds: int = 7,
    held: int = 2,
    max_depth: int = MAX_DEPTH,
    min_share: float = MIN_SHARE,
    min_next: float = MIN_NEXT,
    min_divergence: float = MIN_DIVERGENCE,
    min_pair: int = MIN_PAIR,
) -> DataFrame:
    """Score every text by the tree of the rows that are not held out (crc32 of the id, modulo ``folds``, is ``held``).

    A null or empty text is the end token alone. Rows without id are scored but
    not learned from. A repeated row is learned from and scored each time, rows
    of one id each by their own text. With nothing to learn from, every token has the
    base probability 1. Very long texts are scored in tasks as all others; their
    distinct words and pairs are rows of the joins. Other columns are not read, so
    their names cannot clash. No rows give no rows.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        is_held_out(F.col("doc_id"), folds, held).alias("held_out"),
    )
    training = rows.where("doc_id is not null and not held_out").select("doc_id", "text")
    counts = _word_counts(training)
    tree = learn(training, counts, max_depth, min_share, min_next, min_divergence)
    states, gains = learn_table(training, counts, tree, min_pair, min_divergence)
    return score_texts(rows, tree, counts, states, gains)
