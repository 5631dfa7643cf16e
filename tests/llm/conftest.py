import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table read from files, as operators get it, from (doc_id, text) or longer rows."""
    import tempfile

    def build(rows, schema=DOCS):
        width = len(schema.split(","))
        full = [(tuple(r) + (None,) * width)[:width] for r in rows]
        path = tempfile.mkdtemp(prefix="docs-") + "/t"
        spark.createDataFrame(full, schema).write.parquet(path)
        return spark.read.schema(schema).parquet(path)

    return build


@pytest.fixture
def odd(docs_of):
    """Nulls in any column, empty, white, very long and repeated texts, and repeated rows."""
    return docs_of(
        [
            (1, None, None, None, None),
            (2, "", "en", "a", 0),
            (3, " \n\t ", "en", "a", 4),
            (4, "one two three four five six seven eight nine ten eleven", "en", "a", 55),
            (4, "one two three four five six seven eight nine ten eleven", "en", "a", 55),
            (5, "one two three four five six seven eight nine ten eleven", None, "b", 55),
            (None, "a row without an id", "en", "a", 19),
            (6, "word " * 30_000, "en", "a", 150_000),
            (7, "x" * 100_000, "de", "c", 100_000),
            (8, "Ünïcode 你好 😀 ÉÀ", "fr", "c", 16),
        ]
    )


@pytest.fixture
def none(docs_of):
    return docs_of([])


@pytest.fixture
def clash(docs_of):
    """Columns named as the operators name their own."""
    names = "record bucket place shard slot part start ids n_tokens uid piece length score kept component_id arrived meta line lines key n word words pos"
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} string" for n in names.split())
    return docs_of([(1, "some plain words here"), (2, "other plain words there")], schema)
