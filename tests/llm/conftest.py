import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, sha string, key string, shard string"


@pytest.fixture
def frame(spark):
    """Documents from (doc_id, text[, lang]), with extra columns whose names clash with the operators' own."""
    def make(rows):
        return spark.createDataFrame([(r[0], r[1], r[2] if len(r) > 2 else "en", "s", None, "x", "y", "z") for r in rows], SCHEMA)
    return make


@pytest.fixture
def odd(frame):
    """Nulls, empty and long texts, ties and repeated rows."""
    long = "wide words and wider words go on " * 4000
    return frame([(1, None), (2, ""), (3, " \t\n"), (4, "a b"), (4, "a b"), (5, "a\tb"), (None, "a b"), (None, None), (6, long), (7, long), (8, "Ünï ço dé"), (9, "!!! 123"), (10, "  lead and trail  ")])
