import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parents[2]))

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from texts, or from (doc_id, text) or (doc_id, text, source) tuples."""
    def make(rows):
        full = []
        for i, row in enumerate(rows):
            row = row if isinstance(row, tuple) else (i, row)
            full.append((row[0], row[1], "en", row[2] if len(row) > 2 else f"src{i % 3}",
                         len(row[1]) if row[1] is not None else None))
        return spark.createDataFrame(
            full, "doc_id long, text string, lang string, source string, n_chars long")
    return make


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="session")
def document_rows(documents):
    return [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]


#: Names that operators use themselves; none may disturb them.
CLASHING = ["row", "key", "id", "sha", "kept", "size", "target", "place", "tokens", "lines", "score",
            "cls", "n", "bucket", "base", "terms", "host", "path", "rule", "bad", "template", "part", "of"]


@pytest.fixture(scope="session")
def clash():
    from pyspark.sql import functions as F

    def add(df):
        return df.select("*", *[F.lit(None).cast("string").alias(c) for c in CLASHING])
    return add


ODD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (4, "one"), (None, "no id"), (5, "word " * 3000),
    (6, "x" * 60_000), (7, "a b c d e f g h"), (8, "a b c d e f g h"), (9, "Été \U0001f600 café"),
]


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    """Nulls, empty, repeated, tied and very long texts."""
    return make_docs(ODD)
