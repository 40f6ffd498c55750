import pytest

#: Columns named like those that operators use within.
ODD = "node long, slot long, rep long, comp long, size long, bucket long, block long, stats array<double>, h long, place long, line_no int, score double, lang string, source string"
SCHEMA = f"doc_id long, text string, {ODD}"
LONG = " ".join(f"w{i % 997}x{i % 89}" for i in range(30_000))
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today", "a"),
    (2, "The quick brown fox jumps over the lazy dog near the river bank today", "a"),
    (3, None, "a"),
    (4, "", None),
    (5, " \t\n ", None),
    (6, "one", "b"),
    (6, "one", "b"),
    (6, "another text with the same id as the one before it", "c"),
    (None, "a row without any id at all but with quite some words", None),
    (8, LONG, "b"),
    (9, LONG + " tail", "a"),
    (10, "Écrit à marie@exemple.fr ou +33 1 23 45 67 89, carte 4111 1111 1111 1111 \U0001f600 fin", "c"),
    (11, "same same same same same same same same same same same same same same same same same same same same same", "c"),
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and very long texts, repeated rows and ids, clashing column names."""
    rows = [(i, t, *range(7), [1.0], *range(2), 0, 0.5, None, s) for i, t, s in TEXTS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
