import pytest

# Texts that every operator must take: null, empty, blank, marks only, one word, very long, repeated, odd letters.
LONG = " ".join(f"word{i % 977} and{i % 13}" for i in range(60_000))
ODD = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "!!! 123 ..."),
    (5, "Word"),
    (6, LONG),
    (7, "The same text twice over, the same text."),
    (7, "The same text twice over, the same text."),
    (8, "The same text twice over, the same text."),
    (None, "A text without an id, but with words in it."),
    (9, "Ünïcode ñandú ΟΔΟΣ İstanbul é 日本 <|startoftext|> it's o'clock.,"),
    (10, " no-break separators\x1cfile\x85next"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Odd texts with columns whose names clash with those of the operators."""
    rows = [(k, t, "en", "src", 1, 0.5, "x", 7) for k, t in ODD]
    schema = (
        "doc_id long, text string, lang string, source string, n_chars long, score double, fingerprint string, "
        "component long"
    )
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
