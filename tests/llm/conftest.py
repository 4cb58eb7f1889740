from __future__ import annotations

import pytest

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"

LONG = " ".join(f"word{i % 977} of{i % 31}" for i in range(60_000))


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in any column, empty and very long texts, ties and repeated
    rows, and extra columns that clash with names used inside operators."""
    rows = [
        (1, "the quick brown fox jumps over the lazy dog again and again", "en", "a", 5),
        (2, "", "en", "a", 0), (3, None, "en", "b", None), (4, " \n\t ", None, "b", 4),
        (5, LONG, "en", None, len(LONG)), (None, None, None, None, None), (None, "two words", "de", None, 9),
        (6, "same text here", "de", "a", 1), (6, "same text here", "de", "a", 1), (6, "same text here", "de", "a", 2),
        (6, "other text of the same id", "de", "c", 1), (7, "same text here", "fr", "c", 1),
        (8, "ünïcödé 🙂 é 日本語 text", "fr", "é", 3), (100, "x", "en", "a", 1), (101, "123 456", "en", "a", 1),
        (-3, "a\nb\n\nc a\nb", "en", "", 1),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    clash = ["id", "digest", "fp", "rows", "copies", "key", "pos", "leaf", "gone", "doc", "rank", "_text", "_id", "block",
             "size", "n_lines", "score", "count", "start", "piece"]
    return df.selectExpr("*", *(f"cast(null as string) as `{c}`" for c in clash))


@pytest.fixture(scope="session")
def none(odd):
    return odd.filter("false")
