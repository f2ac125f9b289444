import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that operators use inside
        *[
            T.StructField(c, T.StringType())
            for c in ("score", "node", "h1", "rep", "row", "length", "entity", "vals", "_kept_id")
        ],
    ]
)
LONG = " ".join(f"word{i % 977}" for i in range(60_000))
PROSE = (
    "The quick brown fox jumps over the lazy dog and then it walks home along the river "
    "where the old mill stands. Nobody knows who built it or why it was left alone."
)


def row(doc_id, text, lang="en"):
    n = None if text is None else len(text)
    return (doc_id, text, lang, "src", n, *["clash"] * 9)


EDGE_ROWS = [
    row(1, PROSE),
    row(2, PROSE.upper()),
    row(3, PROSE + " Really."),
    row(4, None),
    row(5, ""),
    row(6, " \n\t "),
    row(7, "one"),
    row(8, "One  two"),
    row(9, LONG),
    row(9, LONG),
    row(10, PROSE),
    row(None, PROSE),
    row(None, None),
    row(11, "12345 !!! ???", None),
    row(12, "x" * 50_000),
    row(13, "Straße ﬁ İstanbul 東京 🙂 \x00 ▁ " * 5, "de"),
]


@pytest.fixture(scope="session")
def edge_docs(spark):
    return spark.createDataFrame(EDGE_ROWS, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(texts, lang="en"):
        rows = texts.items() if isinstance(texts, dict) else enumerate(texts)
        return spark.createDataFrame([row(i, t, lang) for i, t in rows], SCHEMA)

    return make
