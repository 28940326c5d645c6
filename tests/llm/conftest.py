from __future__ import annotations

import random

import pytest

from tidewright.llm.common import importable

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session", autouse=True)
def workers_find_the_library(spark):
    importable(spark)


def words(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n)]


def awkward_rows() -> list[tuple]:
    """Nulls in every column, empty and very long texts, ties, repeated rows, copies, near copies and shared passages."""
    rng = random.Random(5)
    base, passage = words(rng, 120), words(rng, 70)
    near = [*base[:60], "changed", *base[61:]]
    rows = [
        (1, " ".join(base), "en", "a", 1),
        (2, " ".join(base).upper(), None, "b", None),
        (3, " ".join(near), "en", None, 3),
        (4, "", "en", "a", 0),
        (5, None, None, None, None),
        (6, " \t\n ", "en", "b", 2),
        (7, "one two three", "en", "b", 2),
        (8, "One  two\tthree", "en", "b", 2),
        (9, " ".join(words(rng, 30) + passage + words(rng, 10)), "de", "c", 9),
        (10, " ".join(passage + words(rng, 200)), "de", "c", 9),
        (11, " ".join(words(rng, 20_000)), "de", "c", 9),
        (None, " ".join(base), "fr", "a", 1),
        (None, "no id here", "fr", "a", 1),
        (12, "é ü " * 60, "fr", "d", 1),
        (13, "again and " * 80, "fr", "d", 1),
        (14, "same row", "fr", "d", 1),
        (14, "same row", "fr", "d", 1),
        (15, "same id", "fr", "d", 1),
        (15, "other text", "fr", "d", 1),
    ]
    rows += [(100 + i, f"filler {i} " + " ".join(words(rng, 60)), "en", "a" if i % 2 else "c", i) for i in range(10)]
    return rows


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), DOCS).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def clashing(spark):
    """Columns with the names that the operators use or return."""
    names = "keep_id group_size kept TEXT_SHA256 n_words n_removed kept_text print ranges node component copies size target rows source_size digest _digest _keep_id _is_hot __kept"
    extra = ", ".join(f"{n} string" for n in names.split())
    rows = [(i, f"row {i % 3} text", "en", "s", 1, *["x"] * len(names.split())) for i in range(6)]
    return spark.createDataFrame(rows, f"{DOCS}, {extra}")
