from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleanspark.llm import exact_dedup, packing
from tests.llm.conftest import AWKWARD


def expected_groups(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    ids, sizes = defaultdict(list), Counter(norm)
    for (i, _), t in zip(rows, norm):
        if i is not None:
            ids[t].append(i)
    out = []
    for (i, _), t in zip(rows, norm):
        keep = min(ids[t], default=None)
        out.append((i, keep, sizes[t], i is not None and i == keep, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=repr)


COLUMNS = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def test_groups_of_awkward_rows(documents, rows_of):
    found = exact_dedup.exact_groups(documents(AWKWARD))
    assert rows_of(found, *COLUMNS) == expected_groups(AWKWARD)


def test_colliding_hashes_are_told_apart_by_bytes(documents, rows_of):
    rows = [(i, f"text {i % 7}\t x" + " " * (i % 3)) for i in range(60)] + [(99, None)]
    found = exact_dedup.exact_groups(documents(rows), digest=lambda t: F.length(t).cast("string").cast("binary"))
    assert rows_of(found, *COLUMNS) == expected_groups(rows)


def test_no_rows(documents):
    assert exact_dedup.exact_groups(documents([])).count() == 0
    assert packing.pack(documents([])).count() == 0


def piecewise(lengths, capacity):
    """Best-fit decreasing, one piece at a time."""
    bins = []
    for length in sorted(lengths, reverse=True):
        fits = [i for i, left in enumerate(bins) if left >= length]
        if fits:
            best = min(fits, key=lambda i: (bins[i], i))
            bins[best] -= length
        else:
            bins.append(capacity - length)
    return bins


@pytest.mark.parametrize("seed", range(30))
def test_counted_plan_equals_piecewise_best_fit(seed):
    draw = random.Random(seed)
    capacity = draw.choice([7, 16, 50, 100])
    lengths = [draw.randint(1, capacity) for _ in range(draw.randint(0, 400))]
    if seed % 3 == 0:
        lengths += [draw.randint(1, capacity)] * 300
    placements, bins = packing.best_fit_plan(Counter(lengths), capacity)
    assert bins == len(piecewise(lengths, capacity))
    used, ranks = defaultdict(list), defaultdict(list)
    counts = Counter(lengths)
    for k, p in enumerate(placements):
        later = [q.rank for q in placements[k + 1 :] if q.length == p.length]
        end = later[0] if later else counts[p.length]
        for rank in range(p.rank, end):
            at = rank - p.rank
            used[p.bin + at // p.per_bin].append((p.offset + at % p.per_bin * p.length, p.length))
            ranks[p.length].append(rank)
    assert {n: sorted(r) for n, r in ranks.items()} == {n: list(range(c)) for n, c in counts.items()}
    for placed in used.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= capacity
    assert sorted(capacity - sum(n for _, n in placed) for placed in used.values()) == sorted(piecewise(lengths, capacity))


def test_cut_puts_the_rest_in_front():
    assert packing.cut(2500, 1024) == [(0, 452), (452, 1024), (1476, 1024)]
    assert packing.cut(1024, 1024) == [(0, 1024)]
    assert packing.cut(1, 1024) == [(0, 1)]


def test_packed_documents_round_trip(documents):
    import public_tokenizers
    from tokenizers import Tokenizer

    rows = AWKWARD + [(100 + i, "some words <|endoftext|> é " * (i * 13 % 90)) for i in range(60)]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    wanted = {i: tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for i, t in rows if i is not None}
    found = packing.packed_tokens(documents(rows)).toPandas()
    for _, piece in found.iterrows():
        assert zlib.crc32(np.array(piece["ids"], dtype="<u4").tobytes()) == piece["ids_crc32"]
    for doc_id, ids in wanted.items():
        pieces = found[found.doc_id == doc_id].drop_duplicates("piece").sort_values("piece")
        assert [t for part in pieces.ids for t in part] == ids
        assert list(pieces.start) == list(np.cumsum([0, *pieces.length])[:-1])
        assert all(n == 1024 for n in pieces.length[1:])
    for _, sequence in found.groupby("sequence_id"):
        placed = sequence.sort_values("offset")
        assert list(placed.offset) == list(np.cumsum([0, *placed.length])[:-1])
        assert placed.length.sum() <= 1024
    assert found.sequence_id.nunique() == len(piecewise(list(found.length), 1024))
