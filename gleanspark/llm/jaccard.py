"""Exact Jaccard join of shingle sets, with the relations between sets used to skip work.

Sets that are equal are one set. Tokens are put in one global order, those that
many sets hold last, and the first tokens of each set form the index lists, each
entry with its position and the set's size. Two devices keep similar sets from
being compared pair by pair:

* every list has a leader; each set is first compared with its leaders only, and
  the sets found similar to one form its block. A block carries the largest
  distance (symmetric difference) of its sets to the leader;
* between blocks that are already linked nothing is left to find. For two others
  the leaders' answer is computed once, and the answers of their sets follow from
  it within those distances; list positions and sizes give a second bound for the
  whole block. Only blocks that pass both are compared set by set.

Distances are bounded from below by parity sketches (a bit per token), and every
link is confirmed on the whole sets. Tokens are 64-bit hashes of word shingles.

Links are counted in the same way: sets of one leader whose distances to it prove that they
link are counted by distance, not pair by pair. Of the others only those are compared
that differ from the leader in the same tokens.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanspark.llm.components import connected_components
from gleanspark.llm.tables import materialize, pick, read_texts
from gleanspark.llm.words import WHITE, as_long, find_words, hash_words, lower, mix, text_pieces, windows_short

SHINGLE_WORDS = 4
#: Similarity in hundredths.
PERCENT = 85
#: Tokens that a task counts together, and the count from which it reports one.
COUNTED_TOKENS = 8_000_000
REPORTED = 2
#: A token is put last if reports say that at least one in so many documents holds it.
#: Their number is thus at most this times the mean set size, whatever the input.
FREQUENT_PARTS = 20_000
#: Rounds of comparing sets with their lists' leaders.
LEADER_ROUNDS = 2


def _ragged(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values, kind))


def _sets(column: pa.Array, size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first row, tokens, bounds)``: distinct shingle hashes of each text, rising."""
    for row, data, bounds in text_pieces(column):
        data = lower(data)
        starts, ends, words = find_words(data, bounds, WHITE)
        hashes = hash_words(data, starts, ends)
        counts = np.diff(words)
        rolled = windows_short(hashes, size)
        text = np.repeat(np.arange(len(counts)), counts)
        inside = np.arange(len(rolled)) + size <= words[1:][text[: len(rolled)]]
        tokens, owner = rolled[inside], text[: len(rolled)][inside]
        short = np.flatnonzero((counts > 0) & (counts < size))
        if len(short):
            # Fewer words than a shingle: all of them as one, told apart by their number.
            whole = [windows_short(hashes[words[i] : words[i + 1]], int(counts[i]))[0] + np.uint64(counts[i]) for i in short]
            tokens = np.concatenate((tokens, mix(np.array(whole, dtype=np.uint64))))
            owner = np.concatenate((owner, short))
        order = np.argsort(tokens, kind="stable")
        order = order[np.argsort(owner[order].astype(np.uint32), kind="stable")]
        tokens, owner = tokens[order], owner[order]
        new = np.ones(len(tokens), dtype=bool)
        new[1:] = (tokens[1:] != tokens[:-1]) | (owner[1:] != owner[:-1])
        tokens, owner = tokens[new], owner[new]
        yield row, tokens, np.searchsorted(owner, np.arange(len(counts) + 1))


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(values, dtype=np.uint64)))
    return total[bounds[1:]] - total[bounds[:-1]]


def _profiles(texts: DataFrame, size: int) -> DataFrame:
    """A row per document with set size and 128-bit set key, and rows of tokens that one task met often."""
    names = ["doc_id", "n", "key_1", "key_2", "token", "count"]

    def report(held: list[np.ndarray]) -> pa.RecordBatch:
        tokens, counts = np.unique(np.concatenate(held), return_counts=True)
        often = counts >= REPORTED
        n = int(often.sum())
        none = pa.nulls(n, pa.int64())
        found = [none, none, none, none, pa.array(as_long(tokens[often])), pa.array(counts[often].astype(np.int64))]
        return pa.RecordBatch.from_arrays(found, names=names)

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            for row, tokens, bounds in _sets(batch.column(1), size):
                n = len(bounds) - 1
                keys = [_sums(mix(tokens ^ np.uint64(salt)), bounds) for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F)]
                none = pa.nulls(n, pa.int64())
                found = [batch.column(0).slice(row, n), pa.array(np.diff(bounds)), *(pa.array(as_long(k)) for k in keys), none, none]
                yield pa.RecordBatch.from_arrays(found, names=names)
                # Equal sets are one.
                fresh = np.ones(n, dtype=bool)
                for i, key in enumerate(zip(keys[0].tolist(), keys[1].tolist())):
                    fresh[i] = key not in seen
                    seen.add(key)
                held.append(tokens[np.repeat(fresh, np.diff(bounds))])
                if sum(map(len, held)) >= COUNTED_TOKENS:
                    yield report(held)
                    held, seen = [], set()
        if held:
            yield report(held)

    return texts.mapInArrow(profile, "doc_id long, n long, key_1 long, key_2 long, token long, count long")


def _prefixes(texts: DataFrame, size: int, percent: int, often: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """``(id, n, prefix, sketch)``: the first tokens in the global order, and the parity sketch."""
    shared = texts.sparkSession.sparkContext.broadcast(often)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, levels = shared.value
        for batch in batches:
            for row, tokens, bounds in _sets(batch.column(1), size):
                n = np.diff(bounds)
                owner = np.repeat(np.arange(len(n)), n)
                # Parity of the tokens that fall on each bit; about a bit a token, by powers of two.
                longs = 2 ** np.ceil(np.log2(np.maximum(n, 64) / 64)).astype(np.int64)
                words = np.concatenate(([0], np.cumsum(longs)))
                bit = (tokens & (longs[owner] * 64 - 1).astype(np.uint64)).astype(np.int64) + 64 * words[owner]
                sketch = np.packbits(np.bincount(bit, minlength=64 * int(words[-1])) & 1, bitorder="little").view(np.int64)
                if len(known) and len(tokens):
                    at = np.minimum(np.searchsorted(known, tokens), len(known) - 1)
                    level = np.where(known[at] == tokens, levels[at], 0).astype(np.uint16)
                    order = np.argsort(level, kind="stable")
                    order = order[np.argsort(owner[order].astype(np.uint32), kind="stable")]
                    tokens = tokens[order]
                length = np.where(n > 0, n - (percent * n + 99) // 100 + 1, 0)
                place = np.arange(len(tokens)) - np.repeat(bounds[:-1], n)
                prefix = tokens[place < length[owner]]
                found = [
                    batch.column(0).slice(row, len(n)),
                    pa.array(n.astype(np.int32)),
                    _ragged(as_long(prefix), np.concatenate(([0], np.cumsum(length))), pa.int64()),
                    _ragged(sketch, words, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(found, names=["id", "n", "prefix", "sketch"])

    return texts.mapInArrow(cut, "id long, n int, prefix array<long>, sketch array<long>")


def _whole_sets(texts: DataFrame, size: int) -> DataFrame:
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, tokens, bounds in _sets(batch.column(1), size):
                found = [batch.column(0).slice(row, len(bounds) - 1), _ragged(as_long(tokens), bounds, pa.int64())]
                yield pa.RecordBatch.from_arrays(found, names=["id", "tokens"])

    return texts.mapInArrow(emit, "id long, tokens array<long>")


def _may_link(overlap: Column, n: Column, m: Column, percent: int) -> Column:
    """Whether an overlap of at most ``overlap`` can reach the similarity."""
    return (100 + percent) * overlap.cast("long") >= percent * (n.cast("long") + m.cast("long"))


def _distance(a: str, b: str) -> Column:
    """Differing bits of two sketches, at most the sets' distance; the longer one is folded once to the shorter."""

    def folded(x: str, y: str) -> str:
        halves = f"zip_with(slice({x}, 1, size({y})), slice({x}, size({y}) + 1, size({y})), (p, q) -> p ^ q)"
        return f"if(size({x}) = 2 * size({y}), {halves}, {x})"

    bits = f"zip_with({folded(a, b)}, {folded(b, a)}, (p, q) -> bit_count(p ^ q))"
    # Sizes that differ by more have sets too different to link; null ends the sum at zero.
    return F.expr(f"aggregate({bits}, 0, (s, x) -> s + coalesce(x, 0))")


class _Join:
    """The tables that the rounds share."""

    def __init__(self, texts: DataFrame, prefixes: DataFrame, size: int, percent: int):
        self.texts, self.size, self.percent = texts, size, percent
        self.sketches = prefixes.select("id", "n", "sketch")

    def near(self, pairs: DataFrame, slack: Column) -> DataFrame:
        """Distinct pairs ``(a, b)`` whose sketches differ by no more than linked sets and ``slack`` allow."""
        one = self.sketches.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("s_a"))
        two = self.sketches.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("s_b"))
        least = (100 - self.percent) * (F.col("n_a").cast("long") + F.col("n_b"))
        close = (100 + self.percent) * (_distance("s_a", "s_b") - slack) <= least
        return pairs.join(one, "a").join(two, "b").where(close).drop("s_a", "s_b")

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """Of the written pairs ``(a, b)`` those that link, with the distance of the two sets."""
        ids = materialize(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct())
        sets = materialize(_whole_sets(pick(self.texts, ids).dropDuplicates(["doc_id"]), self.size))
        one = sets.select(F.col("id").alias("a"), F.col("tokens").alias("t_a"))
        two = sets.select(F.col("id").alias("b"), F.col("tokens").alias("t_b"))
        both = F.size(F.array_intersect("t_a", "t_b"))
        met = pairs.select("a", "b").join(one, "a").join(two, "b")
        met = met.select("a", "b", F.size("t_a").alias("n_a"), F.size("t_b").alias("n_b"), both.alias("both"))
        links = met.where(_may_link(F.col("both"), F.col("n_a"), F.col("n_b"), self.percent))
        return materialize(links.select("a", "b", (F.col("n_a") + F.col("n_b") - 2 * F.col("both")).alias("distance")))


def _led(join: _Join, lists: DataFrame) -> DataFrame:
    """Links of each entry with the leader of its list, the entry with the smallest id."""
    leaders = lists.groupBy("token").agg(F.min(F.struct("id", "n", "pos")).alias("l"))
    bound = F.least(F.col("n") - F.col("pos"), F.col("l.n") - F.col("l.pos"))
    met = lists.join(leaders, "token").where(F.col("id") > F.col("l.id"))
    pairs = met.where(_may_link(bound, F.col("n"), F.col("l.n"), join.percent)).select(F.col("id").alias("a"), F.col("l.id").alias("b"))
    return join.confirmed(materialize(join.near(pairs.distinct(), F.lit(0)).select("a", "b")))


def _placed(lists: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The leaders that sets follow, as written ``(id, leader, distance)``, and the list entries with leader, distance and root."""
    followers = links.groupBy("a").agg(F.min(F.struct("b", "distance")).alias("l"))
    followers = materialize(followers.select(F.col("a").alias("id"), F.col("l.b").alias("leader"), F.col("l.distance").alias("distance")))
    entries = (
        lists.join(followers, "id", "left")
        .join(connected_components(links), "id", "left")
        .select(
            "token", "id", "n", "pos",
            F.coalesce("leader", "id").alias("leader"),
            F.coalesce("distance", F.lit(0)).alias("distance"),
            F.coalesce("root", "id").alias("root"),
        )
    )
    return followers, materialize(entries)


def _between(join: _Join, entries: DataFrame, apart: bool) -> DataFrame:
    """Links between sets of different leaders: those that the leaders' links leave ``apart``, or those that they connect."""
    group = "root" if apart else "leader"
    mixed = entries.groupBy("token").agg(F.min(group).alias("low"), F.max(group).alias("high")).where("low < high").select("token")
    blocks = (
        entries.join(mixed, "token", "left_semi")
        .groupBy("token", "root", "leader", "pos")
        .agg(
            F.min("n").alias("n_min"), F.max("n").alias("n_max"),
            (F.max("n") - F.col("pos")).alias("left"), F.max("distance").alias("radius"),
        )
    )
    blocks = materialize(blocks)
    names = ["root", "leader", "pos", "n_min", "n_max", "left", "radius"]
    one = blocks.select("token", *[F.col(c).alias(f"{c}_1") for c in names])
    two = blocks.select("token", *[F.col(c).alias(f"{c}_2") for c in names])
    # A list's block holds the sets of one leader that have the token at one position.
    # What is left of them behind it bounds every overlap, so whole blocks are skipped.
    within = _may_link(F.least("left_1", "left_2"), F.col("n_min_1"), F.col("n_min_2"), join.percent)
    if apart:
        met = one.join(two, "token").where(F.col("root_1") < F.col("root_2")).where(within)
    else:
        met = one.withColumnRenamed("root_1", "root").join(two.withColumnRenamed("root_2", "root"), ["token", "root"])
        met = met.where(F.col("leader_1") < F.col("leader_2")).where(within)
    slack = F.col("radius_1") + F.col("radius_2")
    # How far blocks may differ from their leaders, in distance and in size.
    grown = F.ceil((100 - join.percent) * (F.col("n_max_1") + F.col("n_max_2")) / F.lit(100 + join.percent))
    pairs = met.groupBy(F.col("leader_1").alias("a"), F.col("leader_2").alias("b")).agg(F.max(slack + grown).alias("slack"))
    # Only what a leader's answer leaves open is looked into.
    base = F.floor((100 - join.percent) * (F.col("n_a") + F.col("n_b")) / F.lit(100 + join.percent))
    open_pairs = join.near(pairs, F.greatest(F.lit(0), F.col("slack") - base)).select(F.col("a").alias("leader_1"), F.col("b").alias("leader_2"))
    spots = met.select("token", "leader_1", "pos_1", "leader_2", "pos_2").join(open_pairs, ["leader_1", "leader_2"])
    left = entries.select("token", *[F.col(c).alias(f"{c}_1") for c in ("id", "n", "pos", "leader")])
    right = entries.select("token", *[F.col(c).alias(f"{c}_2") for c in ("id", "n", "pos", "leader")])
    found = spots.join(left, ["token", "leader_1", "pos_1"]).join(right, ["token", "leader_2", "pos_2"])
    bound = F.least(F.col("n_1") - F.col("pos_1"), F.col("n_2") - F.col("pos_2"))
    return _compared(join, found.where(_may_link(bound, F.col("n_1"), F.col("n_2"), join.percent)))


def _compared(join: _Join, found: DataFrame) -> DataFrame:
    """Links among the pairs ``(id_1, id_2)``."""
    pairs = found.select(F.greatest("id_1", "id_2").alias("a"), F.least("id_1", "id_2").alias("b")).distinct()
    return join.confirmed(materialize(join.near(pairs, F.lit(0)).select("a", "b")))


def _room(n: Column, distance: Column, percent: int) -> Column:
    """What a set adds to the room between it and the others of its leader.

    Two sets link when (100 + percent) * distance <= (100 - percent) * (n + m), and
    their distance is at most the sum of those to the leader. So two sets of a leader
    whose rooms add up to 0 or more link, whatever they hold.
    """
    return (100 - percent) * n.cast("long") - (100 + percent) * distance.cast("long")


def _stars(followers: DataFrame, sizes: DataFrame, weights: DataFrame, percent: int) -> DataFrame:
    """``(id, leader, n, distance, weight, room)`` of all sets that follow a leader or are one and follow none."""
    own = followers.select(F.col("leader").alias("id")).distinct().join(followers.select("id"), "id", "left_anti")
    stars = followers.unionByName(own.select("id", F.col("id").alias("leader"), F.lit(0).alias("distance")))
    stars = stars.join(sizes.select("id", "n"), "id").join(weights, "id")
    return materialize(stars.withColumn("room", _room(F.col("n"), F.col("distance"), percent)))


def _differences(join: _Join, stars: DataFrame) -> DataFrame:
    """``(leader, token, id, distance, room, pos)``: the tokens in which a set and its leader differ, those that it can meet another set by.

    The distance of two sets of one leader is the sum of those to it, less twice
    the tokens that both differences hold. So where rooms prove no link, one needs
    shared differences: as many as the rooms lack, at least those that the widest
    room of the leader leaves. As in any join by overlap the rarest of a set's
    differences, all but that many less one, hold one that the other set has too.
    The leader's own links follow from the distances.
    """
    followers = stars.where("distance > 0")
    groups = followers.groupBy("leader").agg(F.count(F.lit(1)).alias("sets"), F.min("room").alias("low"), F.max("room").alias("top"))
    need = F.greatest(F.lit(1), F.ceil(-(F.col("room") + F.col("top")) / F.lit(2 * (100 + join.percent)))).alias("need")
    unproven = followers.join(groups.where("sets > 1 and low < 0"), "leader").where("room + low < 0")
    unproven = materialize(unproven.select("leader", "id", "distance", "room", need).where("need <= distance"))
    ids = materialize(unproven.select(F.explode(F.array("leader", "id")).alias("doc_id")).distinct())
    sets = materialize(_whole_sets(pick(join.texts, ids).dropDuplicates(["doc_id"]), join.size))
    both = unproven.join(sets, "id").join(sets.select(F.col("id").alias("leader"), F.col("tokens").alias("led")), "leader")
    differ = F.concat(F.array_except("tokens", "led"), F.array_except("led", "tokens"))
    tokens = materialize(both.select(*unproven.columns, F.explode(differ).alias("token")))
    shared = materialize(tokens.groupBy("leader", "token").agg(F.count(F.lit(1)).alias("often")).where("often > 1"))
    rare = Window.partitionBy("leader", "id").orderBy(F.coalesce("often", F.lit(1)), "token")
    placed = tokens.join(shared, ["leader", "token"], "left").withColumn("pos", F.row_number().over(rare) - 1)
    return materialize(placed.where("pos <= distance - need and often > 1").select("leader", "token", "id", "distance", "room", "pos"))


def _under_one_leader(join: _Join, stars: DataFrame) -> DataFrame:
    """Links between sets of one leader that their rooms do not prove; each such pair is looked at once."""
    entries = _differences(join, stars)
    names = ["id", "distance", "room", "pos"]
    one = entries.where("room < 0").select("leader", "token", *[F.col(c).alias(f"{c}_1") for c in names])
    two = entries.select("leader", "token", *[F.col(c).alias(f"{c}_2") for c in names])
    met = one.join(two, ["leader", "token"]).where("room_1 + room_2 < 0 and (room_2 >= 0 or id_2 < id_1)")
    # No more differences are shared than stand behind the first that is.
    behind = F.least(F.col("distance_1") - F.col("pos_1"), F.col("distance_2") - F.col("pos_2"))
    return _compared(join, met.where(2 * (100 + join.percent) * behind >= -(F.col("room_1") + F.col("room_2"))))


def _proven(stars: DataFrame) -> DataFrame:
    """``(id, proven)``: the documents of other sets of its leader that a set links with by their rooms.

    Equal rooms of one leader count together, so no more meets in a task than
    there are different rooms, which the length of the texts bounds.
    """
    cells = stars.groupBy("leader", "room").agg(F.sum("weight").alias("weight"))
    # Each room asks for all from its negative on, after the sets that have just that.
    asked = F.array(
        F.struct(F.col("room").alias("at"), F.col("weight"), F.lit(None).cast("long").alias("of")),
        F.struct((-F.col("room")).alias("at"), F.lit(0).cast("long").alias("weight"), F.col("room").alias("of")),
    )
    down = Window.partitionBy("leader").orderBy(F.desc("at"), F.col("of").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    totals = cells.select("leader", F.inline(asked)).withColumn("total", F.sum("weight").over(down)).where("of is not null")
    totals = materialize(totals.select("leader", F.col("of").alias("room"), "total"))
    # A set of room 0 or more has counted itself.
    return stars.join(totals, ["leader", "room"]).select("id", (F.col("total") - F.when(F.col("room") >= 0, F.col("weight")).otherwise(0)).alias("proven"))


def _degrees(join: _Join, entries: DataFrame, followers: DataFrame, between: DataFrame, members: DataFrame) -> DataFrame:
    """``(class_id, n_links)``: the other documents that one of the class links with, equal ones included.

    ``between`` has the links across the components of the leaders' links. What is
    left lies within one: sets of different leaders, and of one leader.
    """
    weights = materialize(members.groupBy(F.col("class_id").alias("id")).agg(F.count(F.lit(1)).alias("weight")))
    stars = _stars(followers, join.sketches, weights, join.percent)
    pairs = between.unionByName(_between(join, entries, apart=False)).unionByName(_under_one_leader(join, stars))
    both = materialize(pairs.select(F.col("a").alias("of"), F.col("b").alias("id")).union(pairs.select("b", "a")))
    met = both.join(weights, "id").select(F.col("of").alias("id"), F.col("weight").alias("links"))
    own = weights.select("id", (F.col("weight") - 1).alias("links"))
    links = own.union(met).union(_proven(stars)).groupBy(F.col("id").alias("class_id")).agg(F.sum("links").alias("n_links"))
    return materialize(links)


def similar_sets(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    percent: int = PERCENT,
    leader_rounds: int = LEADER_ROUNDS,
    count_links: bool = False,
) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, class_id``, and ``n_links`` with ``count_links``.

    Documents link when 100 * intersection >= percent * union of their sets of
    ``shingle_words``-word shingles; ``component_id`` is the smallest id that
    links reach, ``class_id`` the smallest id of an equal set, ``n_links`` the
    number of other ids that one links with.

    A null or empty text has no shingles and links with nothing, so its
    component is itself. A row without id links with nothing and has a null
    component. Repeated rows give repeated results; an id stands for one text,
    however often it is repeated. A very long text is hashed in the task that reads it;
    its set is one row. Other columns of the input are not read. No rows give no rows.
    """
    texts = read_texts(docs, id_col, text_col)
    profiles = materialize(_profiles(texts, shingle_words))
    sets = profiles.where("n is not null").select("doc_id", "n", "key_1", "key_2")
    total = sets.count()
    # At most FREQUENT_PARTS times the mean set size, see there.
    reported = profiles.where("token is not null").groupBy("token").agg(F.sum("count").alias("count"))
    got = reported.where(F.col("count") * FREQUENT_PARTS >= total).toPandas()
    tokens, counts = got["token"].to_numpy(np.int64).view(np.uint64), got["count"].to_numpy(np.int64)
    order = np.argsort(tokens)
    # Any function of a token orders it; a logarithmic level fits 16 bits.
    often = (tokens[order], np.minimum(65535, 512 * np.log2(counts[order])).astype(np.uint16))

    filled = sets.where("n > 0 and doc_id is not null")
    # Written, so that the join meets plain tables on both sides and a hot key can be split.
    classes = materialize(filled.groupBy("key_1", "key_2", "n").agg(F.min("doc_id").alias("class_id")))
    members = materialize(filled.join(classes, ["key_1", "key_2", "n"]).select("doc_id", "class_id"))
    copies = materialize(members.where("doc_id > class_id").select("doc_id").distinct())
    single = pick(texts.where("doc_id is not null"), copies, how="left_anti")
    prefixes = materialize(_prefixes(single, shingle_words, percent, often).where("n > 0").dropDuplicates(["id"]))
    join = _Join(texts, prefixes, shingle_words, percent)
    entries = prefixes.select("id", "n", F.posexplode("prefix").alias("pos", "token"))
    shared = entries.groupBy("token").agg(F.count(F.lit(1)).alias("sets")).where("sets > 1").select("token")
    lists = materialize(entries.join(shared, "token", "left_semi"))

    links = _led(join, lists)
    for _ in range(leader_rounds - 1):
        alone = lists.join(links.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "id", "left_anti")
        links = materialize(links.unionByName(_led(join, alone)))
    followers, entries = _placed(lists, links)
    between = _between(join, entries, apart=True)
    links = links.unionByName(between)
    roots = connected_components(links).select(F.col("id").alias("class_id"), "root")
    members = members.dropDuplicates(["doc_id"])
    found = members.join(roots, "class_id", "left")
    added = []
    if count_links:
        found = found.join(_degrees(join, entries, followers, between, members), "class_id")
        added = [F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")]
    found = found.withColumn("component_id", F.coalesce("root", "class_id")).drop("root")
    return (
        sets.select("doc_id", F.col("n").alias("n_shingles"))
        .join(found, "doc_id", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.coalesce("component_id", "doc_id").alias("component_id"),
            F.coalesce("class_id", "doc_id").alias("class_id"),
            *added,
        )
    )
