"""Extraction of one release: from the full web graph down to the slices
that touch the tracked targets.

Plan shape at scale (billions of edges): the target lookup is a pushed-down
``IN`` filter on the vertex scan (a handful of keys, row groups skipped on
the sorted name column); the edge filter is an ``IN`` on ``dst`` plus a
literal id -> name map — no join and no shuffle over the edge list, so the
targets' huge in-degree can never skew anything. Source names and ranks
are semi joins whose small side is data-dependent: the planner broadcasts it
when it is small; beyond that a bitmap of the keys, of bounded size, is tested at the
scan, and only rows that pass it are shuffled (``keyfilter.semi_join``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Targets
from .keyfilter import semi_join


class ExtractError(Exception):
    pass


def _rev_map(spark: SparkSession, targets: Targets) -> dict[str, str]:
    """Reversed name -> target domain, for the domains and their aliases (a few rows of configuration)."""
    return {r["rev_domain"]: r["domain"] for r in targets.names_df(spark).collect()}


def target_ids(vertices: DataFrame, targets: Targets) -> DataFrame:
    """(id, target_domain) of the vertices named like a target or one of its aliases."""
    return _target_vertices(vertices, targets).select("id", "target_domain")


def _target_vertices(vertices: DataFrame, targets: Targets) -> DataFrame:
    revs = _rev_map(vertices.sparkSession, targets)
    name = F.create_map(*[F.lit(x) for kv in revs.items() for x in kv])
    return (vertices.where(F.col("rev_domain").isin(list(revs)))
            .select("id", "rev_domain", name[F.col("rev_domain")].alias("target_domain")))


def missing_targets(found: DataFrame, targets: Targets) -> DataFrame:
    """Target domains with no vertex: (target_domain). Anti join against a
    DataFrame of len(targets) rows."""
    spark = found.sparkSession
    t = targets.to_df(spark).select(F.col("domain").alias("target_domain"))
    return t.join(found.select("target_domain"), "target_domain", "left_anti")


def missing_targets_df(vertices: DataFrame, targets: DataFrame) -> DataFrame:
    """Rows of ``targets`` (target_domain, rev_domain) without a vertex of
    that name. Lazy variant for target lists that are themselves data."""
    found = vertices.select("rev_domain").join(targets.select("rev_domain"), "rev_domain", "left_semi")
    return targets.join(found, "rev_domain", "left_anti").select("target_domain")


def find_target_ids(vertices: DataFrame, targets: Targets) -> dict[int, str]:
    """Eager lookup (id -> target domain); every target must have exactly
    one vertex, an alias at most one (its id maps to the target, too). One row per tracked
    name reaches the driver: the vertices of a name are counted where they lie."""
    per_name = _target_vertices(vertices, targets).groupBy("rev_domain", "target_domain").agg(
        F.min("id").alias("id"), F.count(F.lit(1)).alias("n")).collect()
    names = {r["rev_domain"]: r["name"] for r in targets.names_df(vertices.sparkSession).collect()}
    repeated = {names[r["rev_domain"]]: r["n"] for r in per_name if r["n"] > 1}
    if repeated:
        raise ExtractError("more than one vertex carries the name of a target: "
                           + ", ".join(f"{d} ({n} vertices)" for d, n in sorted(repeated.items())))
    found = {int(r["id"]): r["target_domain"] for r in per_name}
    absent = sorted({t.domain for t in targets.all} - {names[r["rev_domain"]] for r in per_name})
    if absent:
        raise ExtractError(f"no vertex carries the name of {len(absent)} tracked domain(s): {', '.join(absent)}")
    return found


def inbound_edges(edges: DataFrame, ids: dict[int, str]) -> DataFrame:
    """Edges into a target, destination id replaced by the target domain:
    (source_id, target_domain); duplicates kept. ``ids`` is the bounded
    result of ``find_target_ids``."""
    if not ids:
        return edges.where(F.lit(False)).select(F.col("src").alias("source_id"),
                                                F.lit(None).cast("string").alias("target_domain"))
    name = F.create_map(*[x for i, d in sorted(ids.items()) for x in (F.lit(i).cast("long"), F.lit(d))])
    return (edges.where(F.col("dst").isin(sorted(ids)))
            .select(F.col("src").alias("source_id"), name[F.col("dst")].alias("target_domain")))


def source_domains(vertices: DataFrame, inbound: DataFrame) -> DataFrame:
    """(source_id, rev_domain) of every vertex that links into a target."""
    ids = inbound.select(F.col("source_id").alias("id"))
    return semi_join(vertices.select("id", "rev_domain"), ids, "id").select(F.col("id").alias("source_id"), "rev_domain")


def source_ranks(ranks: DataFrame, sources: DataFrame) -> DataFrame:
    """(rev_domain, hc_pos, pr_pos) of the source domains; the ``#`` header
    line of a rank file never matches a name and drops out."""
    return semi_join(ranks.select("rev_domain", "hc_pos", "pr_pos"), sources, "rev_domain")
