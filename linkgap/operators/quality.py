"""Data-quality checks. Each returns a DataFrame of violations (empty =
pass); ``dq_summary`` counts them all in one distributed job."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import ScoreParams, Targets


def check_unique(df: DataFrame, cols: list[str] | str) -> DataFrame:
    """Key values that occur more than once: (cols..., n)."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def check_empty(df: DataFrame) -> DataFrame:
    """One violation row when ``df`` has no rows."""
    n = df.agg(F.count(F.lit(1)).alias("n"))
    return n.where(F.col("n") == 0)


def check_min_rows(df: DataFrame, n: int) -> DataFrame:
    """One violation row when ``df`` has fewer than ``n`` rows."""
    c = df.limit(n).agg(F.count(F.lit(1)).alias("n"))
    return c.where(F.col("n") < n)


def check_chains(duplicates: DataFrame) -> DataFrame:
    """Duplicate pairs whose canonical is itself a duplicate (a chain would
    split a company in a one-hop mapping)."""
    d = duplicates.select(F.col("duplicate_domain").alias("canonical_domain")).distinct()
    return duplicates.join(d, "canonical_domain", "left_semi")


def check_pairs_in_mart(duplicates: DataFrame, mart: DataFrame) -> DataFrame:
    """Duplicate-list domains (either side) that are not mart rows."""
    names = duplicates.select(F.col("canonical_domain").alias("source_domain")).unionByName(
        duplicates.select(F.col("duplicate_domain").alias("source_domain"))).distinct()
    return names.join(mart.select("source_domain"), "source_domain", "left_anti")


def row_check_counts(df: DataFrame, conditions: dict[str, F.Column]) -> DataFrame:
    """(check, violations) of several row-level conditions in one pass over
    ``df`` (one aggregate row, stacked). A null condition is no violation,
    as in SQL filters."""
    agg = df.agg(*[F.count(F.when(c, 1)).cast("long").alias(n) for n, c in conditions.items()])
    rows = F.array(*[F.struct(F.lit(n).alias("check"), F.col(n).alias("violations")) for n in conditions])
    return agg.select(F.explode(rows).alias("r")).select("r.check", "r.violations")


def mart_check_counts(mart: DataFrame, targets: Targets, params: ScoreParams) -> DataFrame:
    """The mart checks as (check, violations) from one pass: rows are added up by domain (map-side first), so the
    same rows tell the row-level checks, uniqueness and emptiness."""
    bad = {
        "mart_domain_not_null": F.col("source_domain").isNull(),
        "mart_own_flag_zero": ~F.col("links_own").isin([0]),
        "mart_score_not_null": F.col("opportunity_score").isNull(),
        "mart_competitor_count_range": (F.col("competitor_count") < F.lit(params.min_competitors))
        | (F.col("competitor_count") > F.lit(len(targets.competitors))),
    }
    by_domain = mart.groupBy("source_domain").agg(F.count(F.lit(1)).alias("_n"),
                                                  *[F.count(F.when(c, 1)).alias(n) for n, c in bad.items()])
    sums = by_domain.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in bad],
                         F.count(F.when(F.col("_n") > 1, 1)).alias("mart_domain_unique"),
                         F.when(F.count(F.lit(1)) == 0, 1).otherwise(0).cast("long").alias("mart_not_empty"))
    names = [*bad, "mart_domain_unique", "mart_not_empty"]
    rows = F.array(*[F.struct(F.lit(n).alias("check"), F.col(n).alias("violations")) for n in names])
    return sums.select(F.explode(rows).alias("r")).select("r.check", "r.violations")


def dq_summary(checks: list[tuple[str, DataFrame]], counted: list[DataFrame] = ()) -> DataFrame:
    """(check, violations) for every check; ``counted`` adds (check,
    violations) frames computed elsewhere (e.g. ``row_check_counts``)."""
    parts = [df.agg(F.count(F.lit(1)).cast("long").alias("violations")).select(
        F.lit(name).alias("check"), "violations") for name, df in checks]
    return reduce(DataFrame.unionByName, parts + list(counted))
