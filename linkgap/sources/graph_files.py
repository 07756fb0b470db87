"""Web-graph text files: vertices, edges and ranks (tab separated, gzip,
no quoting, columns picked by 1-based position) and ``key=value`` stats.

Only the wanted columns are looked at; a line may have more. Reads are
typed: a bad number or a missing column aborts instead of turning into a
null. A ``.gz`` file is one split; convert each release to Parquet once
(``pipeline.convert_release``) and run everything else on that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import GRAPH_COLUMNS

_TYPES = {"id": T.LongType(), "src": T.LongType(), "dst": T.LongType(),
          "hc_pos": T.LongType(), "pr_pos": T.LongType(), "rev_domain": T.StringType()}


def _typed(parts: Column, name: str, position: int) -> Column:
    raw = F.get(parts, F.lit(position - 1))
    kind = _TYPES.get(name, T.StringType())
    value = raw if isinstance(kind, T.StringType) else raw.try_cast(kind)
    broken = F.raise_error(F.concat(F.lit(f"column {position} ({name}) is missing or malformed in line: "),
                                    F.array_join(parts, "\t"))).cast(kind)
    return F.when(value.isNull(), broken).otherwise(value).alias(name)


def _read_tsv(spark: SparkSession, path: str, cols: dict[str, int], comment: str | None = None) -> DataFrame:
    """The columns at their 1-based positions; blank lines (and ``comment`` lines) are skipped."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    if comment:
        lines = lines.where(~F.col("value").startswith(comment))
    parts = F.split("value", "\t")
    return lines.select(*[_typed(parts, n, p) for n, p in cols.items()])


def read_vertices(spark: SparkSession, path: str, cols=GRAPH_COLUMNS["vertices"]) -> DataFrame:
    """(id, rev_domain)."""
    return _read_tsv(spark, path, cols).select("id", "rev_domain")


def read_edges(spark: SparkSession, path: str, cols=GRAPH_COLUMNS["edges"]) -> DataFrame:
    """(src, dst)."""
    return _read_tsv(spark, path, cols).select("src", "dst")


def read_ranks(spark: SparkSession, path: str, cols=GRAPH_COLUMNS["ranks"]) -> DataFrame:
    """(rev_domain, hc_pos, pr_pos); the ``#`` header line is skipped."""
    return _read_tsv(spark, path, cols, comment="#").select("rev_domain", "hc_pos", "pr_pos")


def read_stats(spark: SparkSession, path: str) -> DataFrame:
    """(key, value long) from ``key=value`` / ``key<TAB>value`` lines.
    Only all-digit values are kept (floats, lists, blank lines and lines
    without a separator drop out); for a repeated key the last line wins."""
    lines = spark.read.text(path).withColumn("_line", F.monotonically_increasing_id())
    parts = F.split(F.regexp_replace("value", "=", "\t"), "\t")
    kv = lines.select(F.trim(parts.getItem(0)).alias("key"),
                      F.trim(F.get(parts, F.lit(1))).alias("v"), "_line")
    kv = kv.where(F.col("v").rlike(r"^[0-9]+$"))
    return kv.groupBy("key").agg(F.max_by(F.col("v").cast("long"), F.col("_line")).alias("value"))


def nodes_total(stats: DataFrame) -> int:
    """The ``nodes`` value; raises when absent (one tiny row to the driver)."""
    r = stats.where(F.col("key") == "nodes").select("value").limit(1).collect()
    if not r:
        raise ValueError("the graph statistics hold no integer 'nodes' line")
    return int(r[0]["value"])


def read_slice(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Headerless typed slice file; a 0-byte file is 0 rows, blank lines are
    skipped, a bad number aborts."""
    return (spark.read.schema(schema).option("sep", "\t").option("header", "false")
            .option("quote", "").option("mode", "FAILFAST").csv(path))


# --- writers ---------------------------------------------------------------

def _write_tsv(df: DataFrame, path: str, header: bool = False) -> None:
    (df.write.mode("overwrite").option("sep", "\t").option("header", str(header).lower())
     .option("quote", "").option("compression", "gzip").csv(path))


def write_graph_files(vertices: DataFrame, edges: DataFrame, ranks: DataFrame,
                      stats: DataFrame, out_dir: str) -> dict[str, str]:
    """Write one release in web-graph file layout (each file is a folder of
    gzip parts): ids in name order, ranks with a ``#`` header line, stats
    as ``key=value`` lines plus a non-integer line readers must skip."""
    paths = {k: f"{out_dir}/{k}" for k in ("vertices", "edges", "ranks", "stats")}
    _write_tsv(vertices.select("id", "rev_domain").orderBy("rev_domain"), paths["vertices"])
    _write_tsv(edges.select("src", "dst"), paths["edges"])
    cols = ("hc_pos", "hc_val", "pr_pos", "pr_val", "rev_domain")
    spark = ranks.sparkSession
    header = spark.createDataFrame([(0, "\t".join(f"#{c}" for c in cols))], "k long, value string")
    body = ranks.select(F.col("hc_pos").alias("k"),
                        F.concat_ws("\t", *[F.col(c).cast("string") for c in cols]).alias("value"))
    # The header line sorts first; the CSV writer would quote a leading '#'.
    (header.unionByName(body).orderBy("k").select("value")
     .write.mode("overwrite").option("compression", "gzip").text(paths["ranks"]))
    kv = stats.select("key", F.col("value").cast("double").alias("value"))
    avg = (kv.groupBy().pivot("key", ["nodes", "arcs"]).agg(F.first("value"))
           .select(F.concat(F.lit("avgoutdegree="), F.try_divide("arcs", "nodes").cast("string")).alias("value")))
    lines = stats.select(F.concat("key", F.lit("="), F.col("value").cast("string")).alias("value")).unionByName(avg)
    lines.coalesce(1).write.mode("overwrite").text(paths["stats"])
    return paths
