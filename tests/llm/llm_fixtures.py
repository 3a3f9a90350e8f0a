

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def documents(spark):
    """Builds a ``documents`` table with extra columns of clashing names from ``(doc_id, text, lang, source)`` rows."""

    def build(rows, clash=True):
        full = [(i, t, lang, src, None if t is None else len(t)) for i, t, lang, src in rows]
        df = spark.createDataFrame(full, DOCS)
        if clash:
            from pyspark.sql import functions as F

            for name in ("key", "size", "node", "row", "did", "th", "rank", "length", "target", "x.y", "_d", "_s", "kept", "token"):
                df = df.withColumn(name, F.lit(f"clash {name}"))
        return df

    return build


TEXTS = (None, "", " \t\n", "one", "one two", "...", "a b c d e", "a b c d e", "é ü 漢字 😀", "<|endoftext|> Σας İ", "x" * 3000)
