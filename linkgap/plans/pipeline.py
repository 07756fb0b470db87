"""End-to-end plans: releases -> published raw tables -> mart.

``run_release`` is the recoverable E+L of one release: each extraction
step writes its slice as Parquet under ``root/slices`` and records itself
in the step ledger (with a hash of targets and inputs), so a rerun skips
finished steps and reads their slices back; the load always runs and is
idempotent. Releases are processed one after another (a failed one stops
the run; earlier ones stay published), each as ordinary Spark jobs.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..config import DEFAULT_PARAMS, ScoreParams, Targets
from ..operators import extract as ex
from ..operators import load as ld
from ..operators.keyfilter import plan_bytes
from ..operators.transform import coverage_of_releases, opportunity_mart
from ..sources.graph_files import nodes_total

STEPS = ("extract:edges", "extract:sources", "extract:ranks", "load")


@dataclass
class ReleaseInputs:
    """One release's graph as DataFrames (from files or derived)."""

    label: str
    vertices: DataFrame  # id, rev_domain
    edges: DataFrame     # src, dst
    ranks: DataFrame     # rev_domain, hc_pos, pr_pos (+ anything else)
    stats: DataFrame     # key, value
    identity: str = ""   # what the inputs are (paths, versions) for the step hash


def _df(x) -> DataFrame:
    """Inputs may be given as zero-argument factories, so that a resumed
    run never opens a file whose step is already done."""
    return x() if callable(x) else x


#: Bytes of scanned input that one converting task is to sort; gzip text grows some fourfold.
SPREAD_BYTES = 32 << 20


def files_wanted(df: DataFrame) -> int:
    """Files for the size of the input; 1 if it is unknown."""
    size = plan_bytes(df)
    return max(1, -(-size // SPREAD_BYTES)) if size < 1 << 60 else 1


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt evenly over as many partitions as its input size asks for,
    where its scan has fewer (unsplittable files). An input of unknown size stays as it is."""
    wanted = files_wanted(df)
    return df.repartition(wanted) if df.rdd.getNumPartitions() < wanted else df


def ranged(df: DataFrame, key: str, salt: str, stage: str) -> DataFrame:
    """``df`` in files of consecutive ``key`` values, sorted by it inside. Bounds fall
    inside a key that holds more than a file's share, by a hash of ``salt``, so no key is one task's.

    Bounds are sampled before rows are dealt: an unsplittable input is first written to ``stage`` by
    all tasks, so that its one reading task runs once."""
    wanted = files_wanted(df)
    if wanted == 1:
        return df.sortWithinPartitions(key, salt)
    if df.rdd.getNumPartitions() < wanted:
        spread(df).write.mode("overwrite").parquet(stage)
        df = df.sparkSession.read.schema(df.schema).parquet(stage)
    return df.repartitionByRange(wanted, F.col(key), F.xxhash64(salt)).sortWithinPartitions(key, salt)


def convert_release(spark: SparkSession, rel: ReleaseInputs, out: str, stats_fn=None) -> ReleaseInputs:
    """One-off conversion of a release's graph to Parquet. A gzip text file
    is one split: its one reading task deals the rows out (``spread``). Vertices are then
    ranged by name and edges by destination (``ranged``): a file holds a narrow interval, so the target
    ``IN`` filters pass over all other files by their footers, and a popular
    destination lies in as many files as its edges fill.
    ``stats_fn(vertices, edges)``, when given, derives the stats lines from
    the converted files instead of taking ``rel.stats``."""
    paths = {k: f"{out}/{k}" for k in ("vertices", "edges", "ranks", "stats")}
    stage = {k: f"{out}/_stage-{k}" for k in ("vertices", "edges")}
    ranged(_df(rel.vertices).select("id", "rev_domain"), "rev_domain", "id", stage["vertices"]) \
        .write.mode("overwrite").parquet(paths["vertices"])
    ranged(_df(rel.edges).select("src", "dst"), "dst", "src", stage["edges"]) \
        .write.mode("overwrite").parquet(paths["edges"])
    for path in stage.values():
        ld.drop_folder(spark, path)
    _df(rel.ranks).select("rev_domain", "hc_pos", "pr_pos").write.mode("overwrite").parquet(paths["ranks"])
    stats = (stats_fn(spark.read.parquet(paths["vertices"]), spark.read.parquet(paths["edges"]))
             if stats_fn else _df(rel.stats))
    stats.select("key", "value").write.mode("overwrite").parquet(paths["stats"])
    return ReleaseInputs(rel.label, *(spark.read.parquet(paths[k]) for k in ("vertices", "edges", "ranks", "stats")),
                         identity=rel.identity)


def inputs_hash(targets: Targets, identity: str) -> str:
    payload = json.dumps({"targets": [(t.key, t.domain, *t.aliases) for t in targets.all], "inputs": identity},
                         sort_keys=True)
    return hashlib.sha256(payload.encode()).hexdigest()[:16]


def _slice_path(root: str, label: str, h: str, name: str) -> str:
    """Slices of other targets or inputs lie elsewhere and are never mixed in."""
    return f"{root}/slices/release={label}/inputs={h}/{name}"


def _step(spark, root, done: dict, label, step, h, name, compute) -> DataFrame:
    """Run ``compute`` unless the step is recorded done with this hash."""
    path = _slice_path(root, label, h, name)
    schema = {"edges": schemas.SLICE_EDGES, "sources": schemas.SLICE_SOURCES, "ranks": schemas.SLICE_RANKS}[name]
    if (step, h) not in done:
        obs = Observation(f"{step}-{label}-{h}")
        compute().observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
        ld.mark_step_done(spark, root, label, step, h, obs.get["rows"])
    return spark.read.schema(schema).parquet(path)


def run_release(spark: SparkSession, root: str, rel: ReleaseInputs, targets: Targets) -> dict[str, int]:
    """Extract (resumable) and load one release; returns the row counts."""
    h = inputs_hash(targets, rel.identity or rel.label)
    # This release's finished steps: a few rows per rerun, read once.
    done = {(r["step"], r["inputs_hash"]): r["rows"] for r in
            ld.read_steps(spark, root).where(F.col("release") == rel.label).collect()}
    ids = None

    def lookup():
        nonlocal ids
        if ids is None:
            ids = ex.find_target_ids(_df(rel.vertices), targets)
        return ids

    edges = _step(spark, root, done, rel.label, "extract:edges", h, "edges",
                  lambda: ex.inbound_edges(_df(rel.edges), lookup()))
    sources = _step(spark, root, done, rel.label, "extract:sources", h, "sources",
                    lambda: ex.source_domains(_df(rel.vertices), edges))
    ranks = _step(spark, root, done, rel.label, "extract:ranks", h, "ranks",
                  lambda: ex.source_ranks(_df(rel.ranks), sources))
    counts = ld.load_release(spark, root, rel.label, edges, sources, ranks, nodes_total(_df(rel.stats)), h)
    ld.mark_step_done(spark, root, rel.label, "load", h, counts["raw_backlink_edges"])
    return counts


def load_from_slices(spark: SparkSession, root: str, slice_dirs: dict[str, str]) -> dict[str, dict[str, int]]:
    """Quick path: load finished slices (``edges.tsv``, ``sources.tsv``,
    ``ranks.tsv``, ``graph.stats`` per release folder) without extraction.
    Every file must exist before anything is loaded."""
    from ..sources.graph_files import read_slice, read_stats
    names = ("edges.tsv", "sources.tsv", "ranks.tsv", "graph.stats")
    missing = [f"{d}/{n}" for d in slice_dirs.values() for n in names if not ld.path_exists(spark, f"{d}/{n}")]
    if missing:
        raise FileNotFoundError(f"missing slice file(s): {', '.join(missing)}")
    out = {}
    for label, d in slice_dirs.items():
        out[label] = ld.load_release(
            spark, root, label,
            read_slice(spark, f"{d}/edges.tsv", schemas.SLICE_EDGES),
            read_slice(spark, f"{d}/sources.tsv", schemas.SLICE_SOURCES),
            read_slice(spark, f"{d}/ranks.tsv", schemas.SLICE_RANKS),
            nodes_total(read_stats(spark, f"{d}/graph.stats")))
    return out


def run_releases(spark: SparkSession, root: str, releases: list[ReleaseInputs],
                 targets: Targets) -> dict[str, dict[str, int]]:
    """Every release in order; the first failure propagates."""
    return {r.label: run_release(spark, root, r, targets) for r in releases}


def planned_steps(spark: SparkSession, releases: list[ReleaseInputs], targets: Targets) -> DataFrame:
    rows = [(r.label, s, inputs_hash(targets, r.identity or r.label)) for r in releases for s in STEPS]
    return spark.createDataFrame(rows, "release string, step string, inputs_hash string")


def pending_steps_for(spark: SparkSession, root: str, planned: DataFrame) -> DataFrame:
    """Planned steps not yet recorded done (with the same inputs hash)."""
    return ld.pending_steps(planned, ld.read_steps(spark, root))


def raw_tables(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(edges, ranks, stats) as published: the newest committed run per release."""
    pairs = ld.committed_pairs(spark, root)
    return tuple(ld.published(spark, root, t, pairs) for t in ld.TABLES)  # type: ignore[return-value]


def mart_from_root(spark: SparkSession, root: str, targets: Targets,
                   params: ScoreParams = DEFAULT_PARAMS, overrides: DataFrame | None = None) -> DataFrame:
    """The mart from the published tables. Coverage is merged from the state that each release's
    load wrote, so a new release costs its own edges only; a table with a release loaded
    before there was such a state falls back to the raw edges."""
    e, r, s = raw_tables(spark, root)
    n_releases = ld.staged_releases(spark, root)
    coverage = None
    if n_releases is not None:
        coverage = coverage_of_releases(ld.published(spark, root, ld.COVERAGE), targets, n_releases)
    return opportunity_mart(e, r, s, targets, params, overrides, coverage)


def write_mart(mart: DataFrame, path: str) -> DataFrame:
    """Materialise the mart (a table has no order; sort on read)."""
    mart.write.mode("overwrite").parquet(path)
    return mart.sparkSession.read.parquet(path)


def release_select(spark: SparkSession, root: str, label: str) -> DataFrame:
    """One release's published edges (partition-pruned on ``release``)."""
    return ld.published(spark, root, "raw_backlink_edges").where(F.col("release") == label)
