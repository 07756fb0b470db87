"""Publishing one release into the three raw tables, all or nothing.

Layout under ``root``::

    raw_backlink_edges/release=R/run=U/part-*.parquet
    raw_domain_ranks/release=R/run=U/...
    raw_graph_stats/release=R/run=U/...
    release_coverage/release=R/run=U/... the targets each source domain links to
    _ledger/part-*.parquet          one row per committed (release, run)
    _steps/part-*.parquet           one row per finished extraction step

A load validates first (no unresolved source ids), writes the three tables
into a fresh ``run`` partition, and commits by appending one ledger row,
written last. Readers take, per release, the newest committed run and read
its folders by path, so a crash before the commit publishes nothing, a rerun replaces the
release as a whole (also when the new release is empty), and a failed
rerun leaves the previous run in place.
"""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from .transform import release_coverage

TABLES = ("raw_backlink_edges", "raw_domain_ranks", "raw_graph_stats")
#: Each release's coverage state, written with its run.
COVERAGE = "release_coverage"
_SCHEMAS = {COVERAGE: schemas.COVERAGE, "raw_backlink_edges": schemas.RAW_EDGES, "raw_domain_ranks": schemas.RAW_RANKS,
            "raw_graph_stats": schemas.RAW_STATS}


class LoadError(Exception):
    pass


def resolve_edges(edges: DataFrame, sources: DataFrame) -> DataFrame:
    """edges ⋈ sources on source_id -> (source_id, source_rev_domain,
    target_domain). A shuffle join; a hot source id on the edge side is
    split by AQE's skew-join handling."""
    s = sources.select("source_id", F.col("rev_domain").alias("source_rev_domain"))
    return edges.join(s, "source_id", "inner").select("source_id", "source_rev_domain", "target_domain")


def unresolved_edges(edges: DataFrame, sources: DataFrame) -> DataFrame:
    """Edge rows whose source id has no source row (a null id is
    unresolved too, as with NOT EXISTS)."""
    return edges.join(sources.select("source_id"), "source_id", "left_anti")


def unresolved_examples(unresolved: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` smallest distinct unresolved ids (distributed top-k)."""
    return unresolved.select("source_id").distinct().orderBy(F.col("source_id").asc_nulls_first()).limit(n)


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Every run of a raw table (committed or not), partition columns typed."""
    if not path_exists(spark, f"{root}/{table}"):
        return spark.createDataFrame([], _SCHEMAS[table])
    return spark.read.schema(_SCHEMAS[table]).parquet(f"{root}/{table}")


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder of this package's own making, if it is there."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def file_state(spark: SparkSession, path: str) -> str:
    """Path, length and modification time of a file, or of the files of a folder,
    through the Hadoop file system (any store). A missing path is its name alone."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return path
    found = fs.listStatus(p)  # of a file: itself
    return path + "|" + ";".join(sorted(f"{s.getPath().getName()}:{s.getLen()}:{s.getModificationTime()}" for s in found))


def read_ledger(spark: SparkSession, root: str) -> DataFrame:
    if not path_exists(spark, f"{root}/_ledger"):
        return spark.createDataFrame([], schemas.LEDGER)
    return spark.read.schema(schemas.LEDGER).parquet(f"{root}/_ledger")


def committed_runs(spark: SparkSession, root: str) -> DataFrame:
    """(release, run): the newest commit per release."""
    led = read_ledger(spark, root)
    return led.groupBy("release").agg(F.max_by("run", F.struct("committed_at", "run")).alias("run"))


def committed_pairs(spark: SparkSession, root: str) -> list[tuple[str, str]]:
    """The newest committed (release, run) per release, on the driver: one
    short row per release, so the list is bounded by the release count."""
    return sorted((r["release"], r["run"]) for r in committed_runs(spark, root).collect())


def published(spark: SparkSession, root: str, table: str,
              pairs: list[tuple[str, str]] | None = None) -> DataFrame:
    """The committed rows of a raw table, without the ``run`` column. The folders of the
    committed runs, one per release, are read by path: no other run's folder is
    listed or opened."""
    pairs = committed_pairs(spark, root) if pairs is None else pairs
    if not pairs:
        return spark.createDataFrame([], _SCHEMAS[table]).drop("run")
    return (spark.read.schema(_SCHEMAS[table]).option("basePath", f"{root}/{table}")
            .parquet(*[f"{root}/{table}/release={release}/run={run}" for release, run in pairs]).drop("run"))


def staged_releases(spark: SparkSession, root: str) -> int | None:
    """Published releases that have staged edges, from the commit rows; None if one was
    committed without that number."""
    newest = read_ledger(spark, root).groupBy("release").agg(
        F.max_by(F.struct("coverage"), F.struct("committed_at", "run")).alias("c"))
    n, known, filled = newest.agg(F.count(F.lit(1)), F.count("c.coverage"), F.count(F.when(F.col("c.coverage") > 0, 1))).first()
    return filled if n == known else None


def release_counts(spark: SparkSession, root: str, release: str | None = None) -> DataFrame:
    """(release, table_name, row_count) of the committed runs; a release
    without rows in a table shows 0."""
    pairs = [p for p in committed_pairs(spark, root) if release is None or p[0] == release]
    rel = spark.createDataFrame([(p[0],) for p in pairs], "release string")
    parts = []
    for t in TABLES:
        c = published(spark, root, t, pairs).groupBy("release").agg(F.count(F.lit(1)).alias("row_count"))
        parts.append(rel.join(c, "release", "left")
                     .select("release", F.lit(t).alias("table_name"),
                             F.coalesce("row_count", F.lit(0)).cast("long").alias("row_count")))
    return reduce(DataFrame.unionByName, parts)


def _lit_row(spark: SparkSession, schema, values) -> DataFrame:
    """A one-row DataFrame built JVM-side (no Python data transfer)."""
    cols = [F.lit(v).cast(f.dataType).alias(f.name) for f, v in zip(schema.fields, values)]
    return spark.range(1).select(*cols)


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def load_release(spark: SparkSession, root: str, release: str, edges: DataFrame,
                 sources: DataFrame, ranks: DataFrame, nodes_total: int,
                 inputs_hash: str = "") -> dict[str, int]:
    """Validate, write, commit. Returns {table: rows} for this release.

    ``edges`` (source_id, target_domain), ``sources`` (source_id,
    rev_domain), ``ranks`` (rev_domain, hc_pos, pr_pos) are the release's
    slices. The edge table is resolved and validated in one pass (an
    observation counts edges without a source row and null names); with any such edge, or a rank
    without a name, the run is never committed and LoadError is raised, so nothing of it is
    published. The release's coverage state is written with it, from its own edges."""
    run = f"{_now():%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"

    def target(table: str) -> str:
        return f"{root}/{table}/release={release}/run={run}"

    s = sources.select("source_id", F.col("rev_domain").alias("source_rev_domain"), F.lit(True).alias("_known"))
    joined = edges.join(s, "source_id", "left")
    known, nameless = F.col("_known").isNotNull(), F.col("source_rev_domain").isNull()
    obs = Observation(f"load-{run}")
    checked = joined.observe(obs, F.count(F.when(~known, 1)).alias("unresolved"), F.count(F.when(known, 1)).alias("rows"),
                             F.count(F.when(known & nameless, 1)).alias("nameless"),
                             F.count(F.when(F.col("target_domain").isNull(), 1)).alias("targetless"))
    (checked.where(known).select("source_id", "source_rev_domain", "target_domain")
     .write.mode("errorifexists").parquet(target("raw_backlink_edges")))
    m = obs.get
    if m["unresolved"]:
        unresolved = unresolved_edges(edges, sources)
        ex = ", ".join(str(r["source_id"]) for r in unresolved_examples(unresolved).collect())
        raise LoadError(f"release {release!r} not loaded: {m['unresolved']} of its edges name a source id that "
                        f"the sources lack (smallest such ids: {ex})")

    for n, what in ((m["nameless"], "come from a source without a name"), (m["targetless"], "have no target domain")):
        if n:
            raise LoadError(f"release {release!r} not loaded: {n} of its edges {what}")

    robs = Observation(f"ranks-{run}")
    (ranks.select(F.col("rev_domain").alias("source_rev_domain"), F.col("hc_pos").cast("long"),
                  F.col("pr_pos").cast("long"))
     .observe(robs, F.count(F.lit(1)).alias("rows"), F.count(F.when(F.col("source_rev_domain").isNull(), 1)).alias("nameless"))
     .write.mode("errorifexists").parquet(target("raw_domain_ranks")))
    if robs.get["nameless"]:
        raise LoadError(f"release {release!r} not loaded: {robs.get['nameless']} of its ranks have no domain name")
    cobs = Observation(f"coverage-{run}")
    written = spark.read.schema("source_id long, source_rev_domain string, target_domain string").parquet(target("raw_backlink_edges"))
    (release_coverage(written).observe(cobs, F.count(F.lit(1)).alias("rows"))
     .write.mode("errorifexists").parquet(target(COVERAGE)))
    _lit_row(spark, schemas.RAW_STATS[:1], [int(nodes_total)]).write.mode("errorifexists") \
        .parquet(target("raw_graph_stats"))

    counts = {"raw_backlink_edges": int(m["rows"]), "raw_domain_ranks": int(robs.get["rows"]),
              "raw_graph_stats": 1}
    # The commit: one small file appended last.
    _lit_row(spark, schemas.LEDGER, [release, run, _now(), counts["raw_backlink_edges"],
                                     counts["raw_domain_ranks"], counts["raw_graph_stats"], inputs_hash,
                                     int(cobs.get["rows"])]) \
        .write.mode("append").parquet(f"{root}/_ledger")
    return counts


def vacuum(spark: SparkSession, root: str, retain: int = 1) -> list[str]:
    """Delete run folders no reader selects anymore: committed runs older
    than the newest ``retain`` of their release, and uncommitted runs
    (failed or crashed loads) that started before the newest commit. A run
    newer than the newest commit may be a load in progress and is kept.
    Readers pin their (release, run) pairs when they build a plan, so run
    this between jobs, not while a query over an older run is executing.
    Only folder metadata is touched on the driver (one entry per run)."""
    by_release: dict[str, list[str]] = {}
    for r in read_ledger(spark, root).orderBy(F.col("committed_at").desc()).collect():
        by_release.setdefault(r["release"], []).append(r["run"])
    keep = {(rel, run) for rel, runs in by_release.items() for run in runs[:retain]}
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    deleted = []
    for table in (*TABLES, COVERAGE):
        pattern = jvm.org.apache.hadoop.fs.Path(f"{root}/{table}/release=*/run=*")
        fs = pattern.getFileSystem(conf)
        for st in fs.globStatus(pattern) or []:
            path = st.getPath()
            run = path.getName().split("=", 1)[1]
            release = path.getParent().getName().split("=", 1)[1]
            runs = by_release.get(release, [])
            if (release, run) in keep or not runs:
                continue
            if run in runs or run < runs[0]:
                fs.delete(path, True)
                deleted.append(str(path))
    return deleted


# --- step ledger (resume) -------------------------------------------------

def read_steps(spark: SparkSession, root: str) -> DataFrame:
    if not path_exists(spark, f"{root}/_steps"):
        return spark.createDataFrame([], schemas.STEP_LEDGER)
    return spark.read.schema(schemas.STEP_LEDGER).parquet(f"{root}/_steps")


def mark_step_done(spark: SparkSession, root: str, release: str, step: str,
                   inputs_hash: str, rows: int) -> None:
    _lit_row(spark, schemas.STEP_LEDGER, [release, step, inputs_hash, int(rows), _now()]) \
        .write.mode("append").parquet(f"{root}/_steps")


def pending_steps(planned: DataFrame, done: DataFrame) -> DataFrame:
    """Planned (release, step, inputs_hash) rows without a finished twin.
    A changed targets/input hash makes an old step pending again."""
    return planned.join(done.select("release", "step", "inputs_hash"),
                        ["release", "step", "inputs_hash"], "left_anti")

