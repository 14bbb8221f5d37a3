"""Compression quality, treap search and spelling variants against brute force."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import zstandard

from gleanspark.llm import quality, spelling, treap
from tests.llm.conftest import AWKWARD

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- quality ---------------------------------------------------------------------------------


def good(seed):
    draw = random.Random(seed)
    return " ".join("".join(draw.choice(["ka", "lo", "men", "ti", "sur", "ve"]) for _ in range(draw.randint(1, 4))) for _ in range(60))


def bad(seed):
    return " | ".join(w + "$$$" for w in good(seed).split())


@pytest.fixture(scope="module")
def labels(spark):
    def make(rows):
        given = [(i, q, 0, "x", "y") for i, q in rows]
        return spark.createDataFrame(given, "doc_id long, quality int, score int, text string, rank string")

    return make


def test_quality_of_held_out_rows(documents, labels):
    rows = [(i, (bad if i % 4 == 0 else good)(i)) for i in range(600)]
    found = quality.quality_scores(documents(rows), labels([(i, int(i % 4 != 0)) for i in range(600)])).collect()
    assert len(found) == 600 and all(0 <= r.score <= 1 for r in found)
    assert {r.doc_id: r.held_out for r in found} == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in range(600)}
    held = [r for r in found if r.held_out]
    assert sum(r.predicted == int(r.doc_id % 4 != 0) for r in held) >= 0.97 * len(held)
    assert all(r.predicted == int(r.score >= 0.3) for r in found)


def test_held_out_labels_are_not_learned(documents, labels):
    rows = [(i, (bad if i % 4 == 0 else good)(i)) for i in range(200)]
    marks = [(i, int(i % 4 != 0)) for i in range(200)]
    flipped = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q) for i, q in marks]
    scores = [
        sorted((r.doc_id, r.score) for r in quality.quality_scores(documents(rows), labels(m)).collect()) for m in (marks, flipped)
    ]
    assert scores[0] == scores[1]


def test_quality_of_awkward_rows(documents, labels):
    few = labels([(5, 1), (2, 0), (8, 1), (8, 0), (8, 1), (None, 1), (1, None), (3, 7), (404, 1)])
    for given in (few, labels([]), labels([(i, 1) for i in range(10)])):
        found = quality.quality_scores(documents(AWKWARD), given).collect()
        assert len(found) == len(AWKWARD)
        assert all(0 <= r.score <= 1 for r in found)
    assert {r.score for r in quality.quality_scores(documents(AWKWARD), labels([])).collect()} == {0.5}
    assert quality.quality_scores(documents([]), few).count() == 0


def test_sizes_are_those_of_the_pieces():
    model = quality.QualityModel(good=good(1).encode() * 9, bad=bad(2).encode() * 9)
    text = (good(3) + "é\U0001f34e") * 40
    data = text.encode()
    sizes = []
    for content in (model.good, model.bad):
        shared = zstandard.ZstdCompressionDict(content)
        tool = zstandard.ZstdCompressor(level=3, dict_data=shared, write_content_size=False, write_checksum=False, write_dict_id=False)
        sizes.append(sum(len(tool.compress(data[i : i + 512])) for i in range(0, len(data), 512)))
    gain, size = model.features(text)
    assert gain == pytest.approx((sizes[1] - sizes[0]) / sum(sizes), abs=0.01) and gain > 0
    assert size == pytest.approx(math.log(min(sizes) / len(data)), abs=0.05)
    assert model.features("") is None and model.features(None) is None


def test_calibration_finds_the_share_of_labels():
    draw = np.random.default_rng(5)
    rows = draw.normal(size=(4000, 2))
    labels = (draw.random(4000) < 1 / (1 + np.exp(-(0.5 + 2 * rows[:, 0])))).astype(float)
    weights = quality.logistic(rows, labels, np.ones(4000))
    assert weights == pytest.approx([0.5, 2, 0], abs=0.15)


# --- search ----------------------------------------------------------------------------------


def brute_search(docs, items, top=10):
    pattern = re.compile(treap.TERM)
    terms = [pattern.findall((t or "").translate(LOWER)) for _, t in docs]
    counts = [Counter(t) for t in terms]
    n_docs, n_terms = sum(bool(t) for t in terms), sum(map(len, terms))
    df = Counter(t for c in counts for t in c)
    out = []
    for item_id, text in items:
        asked = set(pattern.findall((text or "").translate(LOWER)))
        scored = []
        for (doc_id, _), held, words in zip(docs, counts, terms):
            if not words:
                continue
            m = 100 - 90 + (90 * len(words) * n_docs) // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * held[t]) // (1000 * held[t] + 8 * m))
                for t in asked & held.keys()
            )
            if score > 0:
                scored.append((-score, math.inf if doc_id is None else doc_id))
        for rank, (score, doc_id) in enumerate(sorted(scored)[:top], 1):
            out.append((item_id, rank, None if doc_id == math.inf else doc_id, -score))
    return sorted(out, key=repr)


def invented_docs(n, seed=1, words=400):
    draw = random.Random(seed)
    weights = [1 / (k + 1) for k in range(words)]
    return [
        (i, " ".join(f"Wä{k}" if k % 3 else f"w{k}," for k in draw.choices(range(words), weights, k=draw.choice((3, 20, 150)))))
        for i in draw.sample(range(10 * n), n)
    ]


@pytest.fixture(scope="module")
def benchmark(spark):
    def make(rows):
        given = [(i, t, 1.0, 7, "z") for i, t in rows]
        return spark.createDataFrame(given, "item_id long, text string, score double, doc_id long, terms string").repartition(2)

    return make


def search_rows(found):
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in found.collect()), key=repr)


@pytest.mark.parametrize("item_chars", [1 << 22, 60])
def test_search_equals_brute_force(documents, benchmark, item_chars):
    docs = invented_docs(900)
    items = [(i, t) for i, t in enumerate(t for _, t in invented_docs(25, seed=2))] + [(99, "unheard of"), (98, "w0 w0 w3")]
    found = treap.ranked_search(documents(docs, partitions=5), benchmark(items), item_chars=item_chars)
    assert search_rows(found) == brute_search(docs, items)


def test_search_of_awkward_rows(documents, benchmark):
    items = [(1, "the same few WORDS"), (1, "word1 word2"), (2, None), (3, ""), (4, "?!"), (None, "row text"), (5, "äpfel Äpfel")]
    assert search_rows(treap.ranked_search(documents(AWKWARD), benchmark(items))) == brute_search(AWKWARD, items)
    assert treap.ranked_search(documents([]), benchmark(items)).count() == 0
    assert treap.ranked_search(documents(AWKWARD), benchmark([])).count() == 0
    assert treap.ranked_search(documents([(1, None), (2, "")]), benchmark(items)).count() == 0


def test_search_of_many_copies_keeps_the_smallest_ids(documents, benchmark):
    docs = [(i, "one passage that all share") for i in range(3000, 0, -1)] + [(10_000 + i, f"other {i}") for i in range(3000)]
    found = search_rows(treap.ranked_search(documents(docs, partitions=7), benchmark([(1, "a passage to share")])))
    assert [r[2] for r in sorted(found, key=lambda r: r[1])] == list(range(1, 11))


def random_postings(draw, n_docs, n_rows, n):
    pairs = sorted({(draw.randrange(n_rows), draw.randrange(n_docs)) for _ in range(n)} | {(r, draw.randrange(n_docs)) for r in range(n_rows)})
    row, doc = (np.array(c, dtype=np.int64) for c in zip(*pairs))
    return row, doc, np.array([draw.randint(1, 1000) for _ in pairs], dtype=np.int64)


@pytest.mark.parametrize("n_docs, n_rows, n", [(1, 1, 1), (3, 300, 400), (700, 2, 900), (1000, 700, 6000), (200, 70_000, 90_000)])
def test_cells_hold_the_maxima_and_searches_are_exact(n_docs, n_rows, n):
    draw = random.Random(n)
    row, doc, impact = random_postings(draw, n_docs, n_rows, n)
    ids = np.arange(n_docs, dtype=np.int64) * 3
    tree = treap.build(ids, row, doc, impact, n_rows)
    for level in range(tree.last + 1):
        begin, end = tree.begins[level], tree.begins[level + 1]
        cells = defaultdict(int)
        for r, d, v in zip(row, doc, impact):
            key = (r >> tree.row_shift(level), d >> (tree.levels - level))
            cells[key] = max(cells[key], v)
        if level <= tree.row_levels:
            assert tree.best[begin:end].tolist() == [cells[k] for k in sorted(cells)]
        else:  # cells of one posting end the path
            assert set(tree.best[begin:end].tolist()) <= set(cells.values())
    asked = [sorted(draw.sample(range(n_rows), min(n_rows, draw.randint(1, 30)))) for _ in range(20)]
    weights = [draw.randint(0, 9) for _ in range(n_rows)]
    item_of = np.array([i for i, held in enumerate(asked) for _ in held])
    rows = np.array([r for held in asked for r in held])
    search = treap.Search(item_of, np.array([weights[r] for r in rows], dtype=np.int64), len(asked), 5)
    search.meet(tree, rows)
    assert [s.size for s in (search.scores, search.ids)] == [100, 100]
    for i, held in enumerate(asked):
        total = Counter()
        for r, d, v in zip(row, doc, impact):
            if r in held:
                total[int(d) * 3] += weights[r] * int(v)
        best = sorted((-s, d) for d, s in total.items() if s > 0)[:5]
        have = [(-int(s), int(d)) for s, d in zip(search.scores[i], search.ids[i]) if s > 0]
        assert have == best


def test_postings_do_not_depend_on_the_slices():
    texts = [t for _, t in invented_docs(60, seed=4)] + ["", "x" * 5000]
    data = "".join(texts).encode()
    bounds = np.concatenate(([0], np.cumsum([len(t.encode()) for t in texts])))
    data = np.frombuffer(data, dtype=np.uint8)
    whole, cut = treap.postings(data, bounds), treap.postings(data, bounds, 64)
    for name in ("hashes", "bounds", "letters", "row", "doc", "count", "sizes"):
        assert np.array_equal(getattr(whole, name), getattr(cut, name)), name


def test_a_block_is_read_as_it_was_written():
    texts = [t for _, t in invented_docs(300, seed=6)]
    data = np.frombuffer("".join(texts).encode(), dtype=np.uint8)
    bounds = np.concatenate(([0], np.cumsum([len(t.encode()) for t in texts])))
    found = treap.postings(data, bounds)
    ids, measure = np.arange(300) * 7 - 5, treap.length_measure(found.sizes, 300, int(found.sizes.sum()))
    block = treap._write_block(ids, measure, found, found.row, found.doc, found.count)
    batch = pa.RecordBatch.from_arrays([pa.array([v]) for v in block], names=["levels", "row_levels", "row_bits", *treap._NUMBERS])
    tree = treap.build(ids, found.row, found.doc, treap.impacts(found.count, measure[found.doc]), len(found.hashes))
    read = treap._read_block(batch, 0)
    lower = slice(tree.begins[tree.row_levels], None)
    for name in ("ids", "begins", "keys", "best", "sides", "doc", "impact"):
        assert np.array_equal(getattr(read, name), getattr(tree, name)), name
    assert all(np.array_equal(getattr(read, n)[lower], getattr(tree, n)[lower]) for n in ("child", "low", "high"))


def test_lengths_are_exact_beyond_64_bits():
    sizes = np.array([10**9, 3], dtype=np.int64)
    assert treap.length_measure(sizes, 10**12, 10**15).tolist() == [10 + 90 * 10**9 * 10**12 // 10**15, 10 + 90 * 3 // 1000]


# --- spelling --------------------------------------------------------------------------------


def brute_words(docs):
    counted = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= 5:
                counted[run] += 1
    return {w: n for w, n in counted.items() if n >= 3}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute_variants(docs):
    words = brute_words(docs)
    forms, near = {}, {}
    for w in words:
        close = [v for v in words if one_edit(w, v)]
        near[w] = len(close)
        best = min(close, key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best and words[best] >= 2 * words[w] else None
    out = []
    for w in words:
        root = w
        while forms[root]:
            root = forms[root]
        out.append((w, forms[w], root, words[w], near[w], words.get(forms[w])))
    return sorted(out, key=repr)


COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def misspelt(n, seed):
    draw = random.Random(seed)
    stems = ["colour", "theatre", "analyse", "élève", "straße", "abcabcabc", "aaaaa", "aaaaaa", "Müller"]
    docs = []
    for i in range(n):
        words = []
        for _ in range(40):
            w = draw.choice(stems)
            if draw.random() < 0.5:
                at = draw.randrange(len(w))
                w = draw.choice((w[:at] + w[at + 1 :], w[:at] + draw.choice("aeÿ") + w[at:], w[:at] + draw.choice("ouÀ") + w[at + 1 :]))
            words.append(w)
        docs.append((i, " ".join(words)))
    return docs


@pytest.mark.parametrize("block_words", [1 << 14, 5])
def test_variants_equal_brute_force(documents, rows_of, block_words):
    docs = misspelt(60, 3)
    assert rows_of(spelling.spelling_variants(documents(docs), block_words=block_words), *COLUMNS) == brute_variants(docs)


def test_variants_of_awkward_rows(documents, rows_of):
    giant = "q" * 30_000
    docs = AWKWARD + [(20, f"{giant} {giant} {giant} {giant}x {giant}x {giant}x"), (None, "nameless nameless nameless")]
    assert rows_of(spelling.spelling_variants(documents(docs)), *COLUMNS) == brute_variants(docs)
    assert spelling.spelling_variants(documents([])).count() == 0
    assert spelling.spelling_variants(documents([(1, None), (2, "")])).count() == 0


def test_a_hot_prefix_is_looked_for_in_copies(documents, spark, rows_of):
    draw = random.Random(8)
    words = sorted({"hot" + "".join(draw.choice("abc") for _ in range(4)) for _ in range(60)})
    frame = spark.createDataFrame([(w, 3 + i) for i, w in enumerate(words)], "word string, n long")
    for looked_for in (1 << 16, 7):
        found = Counter()
        for r in spelling.near_words(frame, 10, looked_for).collect():
            found[r.word] += r.n_near
        assert found == Counter({w: k for w in words if (k := sum(one_edit(w, v) for v in words))})


@pytest.mark.parametrize("size, length", [(6, 5), (6, 6), (6, 7)])
def test_the_band_finds_what_whole_matrices_find(size, length):
    draw = random.Random(size * length)
    words = sorted({bytes(draw.choice(b"ab") for _ in range(size)) for _ in range(40)})
    wanted = sorted({bytes(draw.choice(b"ab") for _ in range(length)) for _ in range(40)})
    shared = spelling.shared_letters(length)
    who, row = spelling.near_pairs(spelling._matrix(words, size), spelling._matrix(wanted, length), shared)
    found = {(wanted[a], words[b]) for a, b in zip(who, row)}
    assert len(found) == len(who)
    assert found == {(a, b) for a in wanted for b in words if one_edit(a.decode(), b.decode()) and a[:shared] == b[:shared]}
