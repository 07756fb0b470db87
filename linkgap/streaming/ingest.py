"""Recurring arrival of new releases as a Structured Streaming job.

Each JSON line dropped into ``arrivals_dir`` announces one release: its
label and the paths of its graph files (vertices, edges, ranks, stats in
web-graph text layout). A file-source stream picks up new announcements;
``foreachBatch`` converts each announced release to Parquet and runs the
resumable extract+load for it. Loads are idempotent per release label and
commit through the ledger, so a micro-batch replayed after a failure
re-publishes the same rows, and the stream's checkpoint (under the shared
folder) makes every announcement run to completion once.

Announcements that repeat are one; two that name different files for one
release stop the stream before anything of the batch is loaded. The batch
handler takes the announcement rows one by one (a few short strings each);
the graph data itself is processed by Spark jobs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..config import Targets
from ..operators.load import file_state
from ..plans import pipeline as pl
from ..sources import graph_files as gf

ARRIVAL = T.StructType([T.StructField(n, T.StringType(), True)
                        for n in ("label", "vertices", "edges", "ranks", "stats")])


class ArrivalError(Exception):
    pass


def release_from_files(spark: SparkSession, label: str, vertices: str, edges: str, ranks: str,
                       stats: str) -> pl.ReleaseInputs:
    return pl.ReleaseInputs(
        label,
        vertices=lambda: gf.read_vertices(spark, vertices),
        edges=lambda: gf.read_edges(spark, edges),
        ranks=lambda: gf.read_ranks(spark, ranks),
        stats=lambda: gf.read_stats(spark, stats),
        identity="|".join((label, *(file_state(spark, p) for p in (vertices, edges, ranks, stats)))))


def ingest_stream(spark: SparkSession, arrivals_dir: str, root: str, targets: Targets,
                  checkpoint: str | None = None, max_files: int = 10,
                  available_now: bool = True) -> StreamingQuery:
    """Start the stream; with ``available_now`` it processes what has
    arrived and stops (run it from a scheduler), else it keeps polling."""
    arrivals = (spark.readStream.schema(ARRIVAL).option("maxFilesPerTrigger", max_files)
                .json(arrivals_dir))

    def handle(batch: DataFrame, epoch_id: int) -> None:
        announced = batch.distinct()
        clash = (announced.groupBy("label").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or label is null")
                 .agg(F.count(F.lit(1)), F.min("label")).first())
        if clash[0]:
            raise ArrivalError(f"{clash[0]} release(s) announced without a label or with differing files "
                               f"(first: {clash[1]})")
        for a in announced.orderBy("label").toLocalIterator():
            rel = release_from_files(spark, a["label"], a["vertices"], a["edges"], a["ranks"], a["stats"])
            parquet = pl.convert_release(spark, rel, f"{root}/input/release={a['label']}/epoch={epoch_id}")
            pl.run_release(spark, root, parquet, targets)

    w = (arrivals.writeStream.foreachBatch(handle)
         .option("checkpointLocation", checkpoint or f"{root}/_stream_checkpoint"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
