"""Small tables for the tests of this folder."""

import os

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
has_vocabularies = pytest.mark.skipif(not os.path.exists("/opt/tokenizers"), reason="no vocabulary files")


def docs_frame(spark, rows):
    """documents rows from (doc_id, text[, source])."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
    return spark.createDataFrame(full, DOCS)


ODD_TEXTS = [None, "", " \t\n", "one", "one two three", "A b Été 日本", "x" * 40_000, "same text here now", "same text here now"]


@pytest.fixture()
def odd_docs(spark):
    """Nulls, empty and long texts, repeated rows, null ids and sources, and extra
    columns whose names clash with the operators' own."""
    from pyspark.sql import functions as F

    rows = [(i, t, None if i % 3 == 0 else f"s{i % 2}") for i, t in enumerate(ODD_TEXTS)]
    rows += [(None, "no id", "s0"), (7, ODD_TEXTS[7], "s1"), (None, None, None)]
    df = docs_frame(spark, rows)
    for name in ("size", "fp", "score", "key", "range", "shard", "length", "piece", "value", "block", "pos", "carried"):
        df = df.withColumn(name, F.lit("x"))
    return df
