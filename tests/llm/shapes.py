import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    # Names that operators use for results of their own.
    "score double, features string, hits int, items int, ids string, removed string, kept string, "
    "node int, hash string, shard string, size string"
)
FILLER = (None,) * 11
LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(30_000))


def document(doc_id, text):
    return (doc_id, text, None, None, None if text is None else len(text), *FILLER)


@pytest.fixture
def documents(spark):
    """Frame of documents with columns whose names clash, from (id, text) pairs."""
    return lambda *pairs: spark.createDataFrame([document(*p) for p in pairs], SCHEMA)


@pytest.fixture
def odd(documents):
    """Null, empty, blank and very long texts, a null id, repeated rows and ties."""
    return documents(
        (1, None), (2, ""), (3, "  \n\t "), (4, LONG), (5, "one"), (6, "one"), (6, "one"), (None, "one"),
        (7, "Ünï ÇÖDÉ 日本語 \x00 x"), (8, "a\nb\nc\nd\ne\nf"), (9, "a\nb\nc\nd\ne\nf"), (None, None))


@pytest.fixture
def folder(spark, tmp_path):
    """Writes frames as tables of a data folder and returns its path."""
    def write(**tables):
        for name, df in tables.items():
            df.write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write
