import pytest

SF = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "size int, mixed string, verdict string, part int, fingerprint string, __tag long")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in any column, empty and very long texts, repeated rows and ids, clashing columns."""
    long = " ".join(f"w{i % 977} o{i % 31}" for i in range(60_000))
    rows = [
        (1, "the quick brown fox jumps over the lazy dog", "en", "a", 43, 1, "m", "v", 1, "f", 1),
        (1, "the quick brown fox jumps over the lazy dog", "en", "a", 43, 1, "m", "v", 1, "f", 1),
        (2, None, "en", "a", None, None, None, None, None, None, None),
        (3, "", None, None, 0, 2, "m", "v", 2, "f", 2),
        (4, " \t\n ", "de", None, 4, 2, "m", "v", 2, "f", 2),
        (None, "the quick brown fox jumps over the lazy cat", "en", "b", 43, 1, "m", "v", 1, "f", 1),
        (None, None, None, None, None, None, None, None, None, None, None),
        (5, long, "en", "b", len(long), 1, "m", "v", 1, "f", 1),
        (6, long, "en", "c", len(long), 1, "m", "v", 1, "f", 1),
        (7, "token = \"24be64439e3e49cf46b2d7c90f3602a3d0b907ff\" x", "fr", "c", 52, 1, "m", "v", 1, "f", 1),
        (1, "another text of the same id", "en", "a", 27, 1, "m", "v", 1, "f", 1),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
