"""Report stage: same-company merge over the whole mart, top-N, rows,
sections and totals.

Only the final N rows are ever small enough to number with a plain window;
the merge itself is a grouped aggregation over the whole mart (partial
aggregation before the shuffle, so a canonical domain with many duplicates
does not pile raw rows onto one task).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..config import DEFAULT_PARAMS, ScoreParams, Targets
from ..functions.labels import category_title, links_to_label, yes_no
from ..functions.scoring import competitor_count, opportunity_score
from ..session import new_run_dir, shared_dir
from .quality import check_unique
from .ranking import rank_positions
from .transform import total_order


class ReportError(Exception):
    pass


def canonical_domain(mart: DataFrame, duplicates: DataFrame) -> DataFrame:
    """(source_domain, canonical_domain): one hop, unmapped keep their own
    name. No broadcast hint: the duplicate list's size is data; AQE
    broadcasts it at runtime when it measures small."""
    d = duplicates.select(F.col("duplicate_domain").alias("source_domain"), "canonical_domain")
    return (mart.select("source_domain").join(d, "source_domain", "left")
            .select("source_domain", F.coalesce("canonical_domain", "source_domain").alias("canonical_domain")))


def matched_pairs(mart: DataFrame, duplicates: DataFrame) -> DataFrame:
    """The mart's rows and the duplicate list's domains in one full outer pass: the mart's columns, ``canonical_domain``
    (own name where unmapped), ``_listed`` (the list's domain), ``_in_mart``, ``_as_duplicate`` and ``_as_canonical`` (how often
    the list names the domain so)."""
    roles = duplicates.select(F.col("duplicate_domain").alias("_listed"), "canonical_domain", F.lit(1).alias("_d")).unionByName(
        duplicates.select(F.col("canonical_domain").alias("_listed"), F.lit(None).cast("string").alias("canonical_domain"), F.lit(0).alias("_d")))
    listed = roles.groupBy("_listed").agg(F.min("canonical_domain").alias("canonical_domain"), F.sum("_d").alias("_as_duplicate"),
                                          F.sum(1 - F.col("_d")).alias("_as_canonical"))
    both = mart.withColumn("_in_mart", F.lit(True)).join(listed, F.col("source_domain") == F.col("_listed"), "full_outer")
    return both.withColumn("canonical_domain", F.coalesce("canonical_domain", "source_domain"))


def _violations() -> dict[str, tuple[Column, Column]]:
    """What a merge must not meet: (how many a row of ``matched_pairs`` stands for, the name shown)."""
    one, listed = F.lit(1), F.col("_listed")
    return {
        "domains listed as a duplicate more than once": (F.when(F.col("_as_duplicate") > 1, one), listed),
        "domains of duplicate pairs missing from the mart": (F.when(F.col("_in_mart").isNull(), one), listed),
        "canonical domains that are duplicates themselves": (F.when(F.col("_as_duplicate") > 0, F.col("_as_canonical")), listed),
    }


def observed_pairs(mart: DataFrame, duplicates: DataFrame) -> tuple[DataFrame, dict[str, tuple[int, str | None]]]:
    """The mart's rows with their ``canonical_domain``, written once under the shared folder, and what was observed while they
    were: by violation its exact count and the first name; ``the mart is empty`` has the count 1 if so."""
    found = _violations()
    counts = [F.count("_in_mart").alias("rows")]
    for k, (n, name) in enumerate(found.values()):
        counts += [F.coalesce(F.sum(n), F.lit(0)).alias(f"n{k}"), F.min(F.when(n > 0, name)).alias(f"first{k}")]
    spark, obs = mart.sparkSession, Observation()
    both, out = matched_pairs(mart, duplicates), new_run_dir(spark, "merge")
    both.observe(obs, *counts).write.parquet(out)
    seen = obs.get
    violations = {what: (seen[f"n{k}"], seen[f"first{k}"]) for k, what in enumerate(found)}
    violations["the mart is empty"] = (int(not seen["rows"]), None)
    return spark.read.schema(both.schema).parquet(out).where("_in_mart"), violations


def checked_pairs(mart: DataFrame, duplicates: DataFrame) -> DataFrame:
    """``observed_pairs``, stopping before a merge that would lose or double a
    company: an empty mart, a domain listed as a duplicate more than once, a pair with a domain that the
    mart lacks, a canonical domain that is itself a duplicate."""
    pairs, violations = observed_pairs(mart, duplicates)
    problems = [what if first is None else f"{what}: {n} (first: {first})" for what, (n, first) in violations.items() if n]
    if problems:
        raise ReportError("; ".join(problems))
    return pairs


def merge_duplicates(mart: DataFrame, duplicates: DataFrame, targets: Targets,
                     params: ScoreParams = DEFAULT_PARAMS, check: bool = True, pairs: DataFrame | None = None) -> DataFrame:
    """One row per company over the whole mart: flags, present_in_both and
    authority are the max over the group; the count is re-summed; the score
    is recomputed only where something merged; the category comes from the
    canonical row; ``n_merged`` counts the merged duplicates and
    ``merged_from`` names them in mart order (comma separated, empty when
    nothing merged). The aggregates combine map-side; only the names of
    curated duplicates are gathered, so a list is as long as its company's entries
    in the curated file. With ``check`` the rows come from ``checked_pairs``, which stops at an
    unsafe list; ``pairs`` gives rows that were matched before."""
    comp = targets.competitor_flags
    m = pairs
    if m is None:
        m = checked_pairs(mart, duplicates) if check else matched_pairs(mart, duplicates).where("_in_mart")
    is_canon = F.col("source_domain") == F.col("canonical_domain")
    in_order = F.struct((-F.col("opportunity_score")).alias("a"), (-F.col("competitor_count")).alias("b"),
                        (-F.col("authority_percentile")).alias("c"), F.col("source_domain").alias("d"))
    g = m.groupBy("canonical_domain").agg(
        *[F.max(c).alias(c) for c in comp],
        F.max("present_in_both").alias("present_in_both"),
        F.max("authority_percentile").alias("authority_percentile"),
        F.max(F.when(is_canon, F.col("category"))).alias("category"),
        F.max(F.when(is_canon, F.col("opportunity_score"))).alias("_canon_score"),
        F.count(F.when(~is_canon, F.lit(1))).alias("n_merged"),
        F.collect_list(F.when(~is_canon, in_order)).alias("_merged"))
    cnt = competitor_count(comp)
    new_score = opportunity_score(cnt, len(comp), F.col("authority_percentile"), F.col("present_in_both"), params)
    return g.select(
        F.col("canonical_domain").alias("source_domain"), "category", *comp,
        cnt.alias("competitor_count"), "present_in_both", "authority_percentile",
        F.when(F.col("n_merged") > 0, new_score).otherwise(F.col("_canon_score")).alias("opportunity_score"),
        "n_merged", F.array_join(F.transform(F.array_sort("_merged"), lambda x: x["d"]), ", ").alias("merged_from"))


def ranked(df: DataFrame, name: str = "rank") -> DataFrame:
    """Whole table numbered 1.. by the total order (distributed)."""
    return rank_positions(df, total_order(), name)


def top_k(merged: DataFrame, n: int, require_full: bool = True) -> DataFrame:
    """The ``n`` best rows by the total order, numbered 1..n. With
    ``require_full``, fewer than ``n`` candidates is an error (the report
    never pads)."""
    # TakeOrderedAndProject: per-task top-n, then merge. The ≤ n rows are used
    # several times downstream (check, rows, lists): a reliable checkpoint in the
    # shared folder makes this the only run of the whole-mart merge.
    shared_dir(merged.sparkSession)
    top = merged.orderBy(*total_order()).limit(n).checkpoint(eager=True)
    if require_full and (have := top.count()) < n:
        raise ReportError(f"the report asks for {n} companies, the merged mart has {have}")
    # Numbering ≤ n rows: the single window partition is bounded by n.
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*total_order())).cast("long"))


def missing_keys(left: DataFrame, right: DataFrame, on: str, right_on: str | None = None) -> DataFrame:
    """Rows of ``left`` whose ``on`` value is absent from ``right``."""
    r = right.select(F.col(right_on or on).alias(on)).distinct()
    return left.join(r, on, "left_anti")


def report_rows(top: DataFrame, actions: DataFrame, targets: Targets,
                curated: DataFrame | None = None) -> DataFrame:
    """Rows of the report: rank, domain, category (+ title), links-to label,
    Yes/No, authority, score, action (+ 'Also linked via ...').

    Hard failures: duplicate action keys; a shown domain without an action;
    with ``curated`` (the override list) given, a shown domain without a
    curated category row."""
    dup = check_unique(actions, "source_domain").agg(F.count(F.lit(1)), F.min("source_domain")).first()
    if dup[0]:
        raise ReportError(f"{dup[0]} domain(s) have a duplicate action (first: {dup[1]})")
    missing = missing_keys(top.select("source_domain"), actions, "source_domain").collect()  # ≤ n rows
    if missing:
        raise ReportError("shown without an action: " + ", ".join(sorted(r[0] for r in missing)))
    if curated is not None:
        unc = missing_keys(top.select("source_domain"), curated, "source_domain").collect()  # ≤ n rows
        if unc:
            raise ReportError("shown without a curated category: " + ", ".join(sorted(r[0] for r in unc)))
    a = actions.select("source_domain", "action")
    j = top.join(F.broadcast(a.join(top.select("source_domain"), "source_domain", "left_semi")),
                 "source_domain", "inner")
    action = F.when(F.col("n_merged") > 0,
                    F.concat(F.col("action"), F.lit(" Also linked via "), F.col("merged_from"), F.lit(".")))
    return j.select(
        "rank", "source_domain", "category", category_title("category").alias("category_title"),
        links_to_label(targets.competitor_flags, targets.names).alias("links_to"),
        yes_no("present_in_both").alias("present_label"),
        "authority_percentile", "opportunity_score",
        action.otherwise(F.col("action")).alias("action"))


def category_sections(top: DataFrame) -> DataFrame:
    """Sections: categories by best score desc (ties: best rank first)."""
    s = top.groupBy("category").agg(
        F.count(F.lit(1)).alias("n_rows"), F.max("opportunity_score").alias("best_score"),
        F.min("rank").alias("best_rank"))
    w = Window.orderBy(F.col("best_score").desc(), F.col("best_rank").asc())  # ≤ n rows
    return s.select("category", category_title("category").alias("title"), "n_rows", "best_score",
                    "best_rank", F.row_number().over(w).cast("long").alias("section_order"))


def report_totals(mart: DataFrame, merged: DataFrame, top: DataFrame) -> DataFrame:
    """(candidates, distinct_companies, shown, merged_among_shown)."""
    return top.agg(
        mart.agg(F.count(F.lit(1))).scalar().alias("candidates"),
        merged.agg(F.count(F.lit(1))).scalar().alias("distinct_companies"),
        F.count(F.lit(1)).alias("shown"),
        F.coalesce(F.sum("n_merged"), F.lit(0)).cast("long").alias("merged_among_shown"))


def release_nodes(stats: DataFrame) -> DataFrame:
    """(release, nodes_total, nodes_label) ordered by release; no release at all stops the report."""
    if not stats.limit(1).count():
        raise ReportError("no release has graph statistics")
    return (stats.select("release", "nodes_total",
                         F.concat(F.format_number(F.col("nodes_total").cast("double"), 0),
                                  F.lit(" domains")).alias("nodes_label"))
            .orderBy("release"))


def write_report(rows: DataFrame, sections: DataFrame, totals: DataFrame, out_dir: str) -> None:
    """Report tables as CSV with a header (each holds at most N rows, so one
    file each)."""
    for name, df, order in (("rows", rows, "rank"), ("sections", sections, "section_order"),
                            ("totals", totals, None)):
        d = df.orderBy(order) if order else df
        d.coalesce(1).write.mode("overwrite").option("header", "true").csv(f"{out_dir}/{name}")
