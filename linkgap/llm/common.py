"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_run_dir

#: White space of the word rules: space and the ASCII controls 9-13.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"

#: Columns of the documents table, in order.
DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once under the shared folder and read back. Cuts the
    lineage and fixes every computed value."""
    out = new_run_dir(df.sparkSession, name)
    df.write.parquet(out)
    return df.sparkSession.read.schema(df.schema).parquet(out)


@contextmanager
def _setting(spark: SparkSession, name: str, value: str):
    """``name`` is ``value`` inside; the session's own value, if any, comes back after."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def arrow_batches(spark: SparkSession, size: int):
    """Jobs run inside hand rows to Python in Arrow batches of about ``size`` bytes (a longer row is a batch of its
    own); the session's own size comes back after."""
    return _setting(spark, "spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def shuffles_dropped(spark: SparkSession):
    """The shuffle files of a write run inside go when it ends, not when the driver happens to collect its garbage."""
    return _setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def word_count(text: Column) -> Column:
    """Number of words (runs without white space); null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hash60(*parts: Column) -> Column:
    """Uniform 60-bit key: the first 15 hex digits of the MD5 of the parts
    (null: a mark of its own), joined by a separator. A SQL engine can repeat it."""
    joined = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("\x00")) for p in parts])
    return F.conv(F.substring(F.md5(joined), 1, 15), 16, 10).cast("long")


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
