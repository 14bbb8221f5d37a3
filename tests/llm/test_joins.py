"""Jaccard join, repeated passages and benchmark hits against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from gleanspark.llm import decontaminate, jaccard, substring
from gleanspark.llm import words as hashing
from gleanspark.llm.components import connected_components
from tests.llm.conftest import AWKWARD

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def families(seed, n=6, members=12, words=90):
    """Texts with near copies at many distances, shared passages and equal sets."""
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [draw.choice(vocabulary) for _ in range(60)]
    rows = []
    for _ in range(n):
        base = [draw.choice(vocabulary) for _ in range(draw.randint(5, words))]
        for m in range(members):
            text = list(base)
            for _ in range(draw.choice([0, 0, 1, 1, 2, 3, 6])):
                text[draw.randrange(len(text))] = draw.choice(vocabulary).upper()
            if m % 4 == 0:
                at = draw.randrange(len(text))
                text[at:at] = passage[draw.randrange(8) :]
            rows.append(" ".join(text))
    draw.shuffle(rows)
    ids = draw.sample(range(10_000), len(rows))
    return list(zip(ids, rows))


def brute_components(rows, size=4, percent=85):
    sets = {}
    for i, text in rows:
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(LOWER)) if x]
        sets[i] = {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    links = dict.fromkeys(ids, 0)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                links[a] += 1
                links[b] += 1
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i), links[i]) for i in ids}


@pytest.mark.parametrize("seed, rounds", [(1, 2), (2, 1), (3, 3)])
def test_jaccard_components(documents, seed, rounds):
    rows = families(seed)
    found = jaccard.similar_sets(documents(rows), leader_rounds=rounds, count_links=True).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in found} == brute_components(rows)


@pytest.mark.parametrize("seed, changes", [(1, 2), (2, 5), (3, 9)])
def test_links_under_one_leader_are_counted(documents, seed, changes):
    """A large family around one text, with copies: most links are proven by distances, some are compared, some are none."""
    draw = random.Random(seed)
    base = [f"w{draw.randrange(4000)}" for _ in range(120)]
    rows = [(10, " ".join(base))]
    for i in range(11, 150):
        text = list(base)
        for _ in range(draw.randint(0, changes)):
            text[draw.randrange(len(text))] = f"v{draw.randrange(30)}"
        rows.append((i, " ".join(text[draw.choice([0, 0, 3]) :])))
    wanted = brute_components(rows)
    found = jaccard.similar_sets(documents(rows), count_links=True).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in found} == wanted
    plain = jaccard.similar_sets(documents(rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in plain} == {i: v[:2] for i, v in wanted.items()}


def test_few_sets_of_a_large_family_are_compared(documents, monkeypatch):
    """Near copies that differ from their leader in other places than each other are not brought together."""
    draw = random.Random(5)
    base = [f"w{i}" for i in range(150)]
    rows = [(1, " ".join(base))]
    for i in range(2, 122):
        text = list(base)
        for at in draw.sample(range(150), 2):
            text[at] = f"v{i}-{at}"
        rows.append((i, " ".join(text)))
    found, compared = [], jaccard._compared
    monkeypatch.setattr(jaccard, "_compared", lambda join, pairs: found.append(pairs.count()) or compared(join, pairs))
    result = jaccard.similar_sets(documents(rows), count_links=True).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in result} == brute_components(rows)
    assert sum(found) < 120 * 119 // 2 // 8


def test_jaccard_awkward_rows(documents):
    found = jaccard.similar_sets(documents(AWKWARD), count_links=True).collect()
    named = [(i, t) for i, t in AWKWARD if i is not None]
    assert len(found) == len(AWKWARD)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in found if r.doc_id is not None} == brute_components(named)
    assert sorted((r.n_shingles, r.component_id, r.n_links) for r in found if r.doc_id is None) == [(0, None, 0), (6, None, 0)]
    assert jaccard.similar_sets(documents([]), count_links=True).count() == 0


def test_components_of_long_paths(spark):
    path = [(i, i + 1) for i in range(40)] + [(100, 101), (200, 200)]
    found = connected_components(spark.createDataFrame(path, "a long, b long")).collect()
    assert {r.id: r.root for r in found} == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def brute_passages(rows, window):
    words = {i: (t or "").split() for i, t in rows}
    first = {}
    for i, w in words.items():
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            first[key] = min(first.get(key, i), i)
    out = {}
    for i, w in words.items():
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < i:
                gone.update(range(k, k + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out[i] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


@pytest.mark.parametrize("seed, window", [(4, 10), (5, 20), (6, 11), (7, 50)])
def test_repeated_passages(documents, seed, window):
    rows = families(seed, members=10, words=160)
    found = substring.repeated_passages(documents(rows), window=window, bucket_words=500).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in found} == brute_passages(rows, window)
    assert all(sum(s.end - s.start for s in r.spans) == r.n_removed for r in found)


def test_passages_of_awkward_rows(documents):
    found = substring.repeated_passages(documents(AWKWARD)).collect()
    named = [(i, t) for i, t in AWKWARD if i is not None]
    assert len(found) == len(AWKWARD)
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in found if r.doc_id is not None} == brute_passages(named, 50)
    assert sorted((r.n_words, r.n_removed) for r in found if r.doc_id is None) == [(0, 0), (9, 0)]
    assert substring.repeated_passages(documents([])).count() == 0


def brute_hits(rows, items, size=13):
    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))

    windows = {}
    for item, text in items:
        w = words(text)
        for k in range(max(1, len(w) - size + 1) if w else 0):
            windows.setdefault(tuple(w[k : k + size]), set()).add(str(item))
    out = []
    for i, text in rows:
        w, hit, names = words(text), set(), set()
        for k in range(len(w)):
            for n in {len(x) for x in windows}:
                if k + n <= len(w) and tuple(w[k : k + n]) in windows:
                    hit.update(range(k, k + n))
                    names |= windows[tuple(w[k : k + n])]
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(names), digest, len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


HIT_COLUMNS = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def test_second_hashes_of_words_are_other_functions_of_the_word():
    text = " ".join([f"w{i}" for i in range(20_000)] + ["x" * 5000, "x" * 4999 + "y"] + [f"w{i}" for i in range(20_000)]).encode()
    data = np.frombuffer(text, dtype=np.uint8)
    starts, ends, _ = hashing.find_words(data, np.array([0, len(data)]), hashing.WHITE)
    first, second = hashing.hash_words(data, starts, ends), hashing.hash_words(data, starts, ends, hashing.SECOND)
    for found in (first, second):
        assert (found[:20_000] == found[20_002:]).all() and len(np.unique(found)) == 20_002
    # Half of the bits differ.
    assert abs(np.unpackbits((first ^ second).view(np.uint8)).mean() - 0.5) < 0.01


@pytest.mark.parametrize("limit", [10**6, 900])
def test_benchmark_hits(spark, documents, rows_of, limit):
    draw = random.Random(3)
    vocabulary = ["alpha", "Beta", "3", "été", "d", "straße", "x"]
    text = lambda n: "".join(draw.choice(vocabulary) + draw.choice([" ", ", ", "-\n"]) for _ in range(n))
    items = [(k, text(draw.randint(0, 30))) for k in range(20)] + [(3, "Beta"), (None, "x x"), (50, None), (51, "d été")]
    rows = [(100 + k, text(draw.randint(0, 60)) + (items[k % 20][1].upper() if k % 3 else "")) for k in range(60)] + AWKWARD
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.benchmark_hits(documents(rows), benchmark, item_chars=limit)
    assert rows_of(found, *HIT_COLUMNS) == brute_hits(rows, [i for i in items if i[0] is not None])


def test_hit_spans_are_places_of_the_original(spark, documents):
    words = "one two three four five six seven eight nine ten eleven twelve thirteen"
    benchmark = spark.createDataFrame([(1, words)], "item_id long, text string")
    text = "Été \U0001f34e! " + words.upper().replace(" ", " -- ") + "; ende"
    (row,) = decontaminate.benchmark_hits(documents([(1, text)]), benchmark).collect()
    (span,) = row.spans
    assert text[span.start : span.end] == words.upper().replace(" ", " -- ")


def test_empty_benchmark_and_limits(spark, documents):
    empty = spark.createDataFrame([], "item_id long, text string")
    found = decontaminate.benchmark_hits(documents(AWKWARD), empty)
    assert found.where("contaminated or n_hit > 0").count() == 0 and found.count() == len(AWKWARD)
    assert decontaminate.benchmark_hits(documents([]), empty).count() == 0


@pytest.mark.parametrize("window", [1, 2, 5, 13])
def test_blocks_find_every_window(window):
    draw = random.Random(window)
    for _ in range(60):
        items = [(k, " ".join(draw.choices("abc", k=draw.randint(0, 40)))) for k in range(4)]
        text = draw.choices("abcd", k=80)
        for _, item in items:
            words = item.split()
            at, cut = draw.randrange(80), draw.randint(0, max(0, len(words) - 1))
            text[at : at + len(words) - cut] = words[cut:]
        windows = {tuple(w[k : k + window]) for _, i in items if (w := i.split()) for k in range(max(1, len(w) - window + 1))}
        hit = {p for n in {len(x) for x in windows} for k in range(len(text) - n + 1) if tuple(text[k : k + n]) in windows for p in range(k, k + n)}
        runs, _ = decontaminate.Items.of(items, window).scan([w.encode() for w in text])
        assert {p for a, n in runs.items() for p in range(a, a + n)} == hit


def test_long_runs_and_large_benchmarks_take_linear_time():
    words = [f"w{i}" for i in range(100_000)]
    found = decontaminate.Items.of([(k, " ".join(words[k * 1000 : (k + 1) * 1000])) for k in range(100)] + [(100, "one and same " * 5000)])
    assert found.scan([w.encode() for w in words]) == ({k * 1000: 1000 for k in range(100)}, {str(k) for k in range(100)})
    runs, names = found.scan([b"one", b"and", b"same"] * 20)
    assert max(runs.values()) == 60 and names == {"100"}


def test_words_in_pieces_are_the_words(monkeypatch):
    monkeypatch.setattr(decontaminate, "PIECE", 7)
    for text in ["", " ", "a", "One, two--THREE  four5 f\u00fcnf " * 20, "x" * 50, " leading and trailing \n"]:
        pieces = list(decontaminate.word_pieces(text.encode()))
        assert [w for piece in pieces for w in piece] == decontaminate.normal_words(text)
    found = decontaminate.Items.of([("a", "one two three four five")], 4)
    text = b"zero ONE two, three four; five six"
    assert found.scan_pieces(decontaminate.word_pieces(text)) == (7, *found.scan(decontaminate.normal_words(text.decode()))) == (7, {1: 5}, {"a"})
