import pytest
from pyspark.sql import types as T

DOCUMENT = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])

#: Names that operators use themselves.
CLASHING = "score key size copies target spans bucket piece rank label h n task nth component_id kept words bands _id _key _text _nth id_ key_ text_"


@pytest.fixture
def documents(spark):
    """A documents table of (doc_id, text, source); with columns that clash, if asked for."""

    def make(rows, clashing=False):
        full = [(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows]
        schema = T.StructType(list(DOCUMENT))
        if clashing:
            for name in CLASHING.split():
                schema.add(name, T.StringType())
            full = [r + ("x",) * len(CLASHING.split()) for r in full]
        return spark.createDataFrame(full, schema)

    return make


@pytest.fixture
def rows():
    """Sorted tuples of chosen columns."""

    def take(df, *columns):
        return sorted((tuple(r) for r in df.select(*columns).collect()), key=lambda r: tuple((v is None, str(v)) for v in r))

    return take
