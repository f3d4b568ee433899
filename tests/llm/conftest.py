import pytest
from pyspark.sql import types as t

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def docs(spark):
    """Rows of (doc_id, text), or texts alone, as a table with the columns of ``documents``."""

    def make(rows, slices=3):
        pairs = [r if isinstance(r, tuple) else (k, r) for k, r in enumerate(rows)]
        full = [(i, x, "en", "s", None if x is None else len(x)) for i, x in pairs]
        return spark.createDataFrame(full, t._parse_datatype_string(DOCS)).repartition(slices)

    return make


@pytest.fixture(scope="session")
def shared(tmp_path_factory, spark):
    """Where the session names no checkpoint folder, tests name one."""
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('shared')}")
    return spark.conf.get("spark.checkpoint.dir")


@pytest.fixture(autouse=True)
def _shared(shared):
    return shared


#: Empty, null, blank, repeated, tied and odd texts, and a long one.
EDGES = [
    None, "", " ", "\n", "a", "a", "ab", "abc", "ein Wort", "▁x▁", "été \U0001F600 ß", "\t \r\n\x0b", None,
    "one two three four five six seven eight nine ten eleven twelve thirteen fourteen",
    "x" * 70_000, "word " * 12_000, "1.1." * 9_000, "a@" * 9_000, "+1 (23) " * 5_000, "line\n" * 9_000,
]


@pytest.fixture(scope="session")
def edges():
    return EDGES
