import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])


@pytest.fixture(scope="session")
def docs_of(spark):
    """(doc_id, text[, lang[, source]]) tuples as a documents table, with extra columns of clashing names."""

    def build(rows, **extra):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        from pyspark.sql import functions as F
        for name, value in extra.items():
            df = df.withColumn(name, F.lit(value))
        return df

    return build


AWKWARD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "word"), (5, "Ünïcode ñandú 漢字 𝒳 text"), (6, "a " * 3000), (7, "x" * 20000),
    (8, "same text here for two rows"), (8, "same text here for two rows"), (9, "same text here for two rows"), (None, "no id"),
    (10, "12345 67890 !!! ???"), (11, "line one\nline two\r\nline three\x0bfour\x0cfive"),
]
