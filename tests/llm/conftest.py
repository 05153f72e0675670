import pytest
from pyspark.sql import Row
from pyspark.sql import types as T

#: doc_id, text, lang, source, n_chars as in the documents table, with an extra column of a clashing name.
DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("TEXT ", T.StringType()),
    T.StructField("n_words", T.StringType())])


@pytest.fixture(scope="session")
def documents(spark):
    """documents(list of texts or (doc_id, text) or (doc_id, text, lang)) -> DataFrame."""
    def make(rows):
        full = []
        for i, r in enumerate(rows):
            r = r if isinstance(r, tuple) else (i, r)
            full.append((r[0], r[1], r[2] if len(r) > 2 else None, None, None if r[1] is None else len(r[1]), "x", None))
        return spark.createDataFrame(full, DOCUMENTS).repartition(3)
    return make


#: Texts that every per-document operator must get through.
ODD_TEXTS = [None, "", " ", "\n\n  \t", "a", "A b", "word " * 30_000, "ß é ü 你好 world", "<|endoftext|> x", "a  b   c\n\n\nd \n e",
             "x" * 5000, "same text twice", "same text twice", " \x1c odd", "tab\tand\x0bvt", "\U0001f600 it's we'll 123 4567 !!??"]
