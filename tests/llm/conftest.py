"""Small inputs for the operators: awkward rows, and columns whose names the operators use themselves."""

from __future__ import annotations

import pytest

LONG = " ".join(f"word{i % 977}" for i in range(40_000))

#: (doc_id, text): nulls, empty and blank texts, a very long text, ties, and a repeated row.
AWKWARD = [
    (7, None),
    (3, ""),
    (9, " \n\t "),
    (None, "a text whose row has no id at all"),
    (None, None),
    (5, LONG),
    (6, LONG),
    (2, "the same few words"),
    (8, "the same few words"),
    (8, "the same few words"),
    (1, "ein paar Wörter über Äpfel \U0001f34e und Kelvin"),
]


@pytest.fixture(scope="session")
def documents(spark):
    def make(rows, lang="en", partitions=3):
        """A documents table; the extra columns clash with names inside the operators."""
        given = [(i, t, lang if not callable(lang) else lang(i), "src0", 1, b"x", [1], "y") for i, t in rows]
        schema = "doc_id long, text string, lang string, source string, n int, hash binary, tokens array<int>, rank string"
        return spark.createDataFrame(given, schema).repartition(partitions)

    return make


@pytest.fixture(scope="session")
def rows_of():
    def collect(frame, *columns):
        return sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=repr)

    return collect
