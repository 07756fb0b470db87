"""Dimension data of a link-gap run: tracked targets, scoring parameters,
category rules and releases.

Everything here is small, driver-side configuration. It enters Spark plans
as literals (``F.lit``) or as tiny DataFrames whose row count is known on
the driver, so every broadcast of it has a proven size bound.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


@dataclass(frozen=True)
class Target:
    """One tracked domain. ``key`` names the ``links_<key>`` flag column;
    links to one of its ``aliases`` count as links to the domain."""

    key: str
    domain: str
    aliases: tuple[str, ...] = ()


@dataclass(frozen=True)
class Targets:
    """The own domain plus the competitor domains whose linkers we mine.

    The own flag is always named ``links_own``; competitor flags are
    ``links_<key>`` in the given (report) order.
    """

    own: Target
    competitors: tuple[Target, ...]
    display_names: tuple[str, ...] = ()

    @property
    def all(self) -> tuple[Target, ...]:
        return (Target("own", self.own.domain, self.own.aliases),) + tuple(self.competitors)

    @property
    def competitor_flags(self) -> list[str]:
        return [f"links_{t.key}" for t in self.competitors]

    @property
    def flag_columns(self) -> list[str]:
        return self.competitor_flags + ["links_own"]

    @property
    def names(self) -> list[str]:
        """Display names of the competitors, for the links-to label."""
        if self.display_names:
            return list(self.display_names)
        return [t.key.capitalize() for t in self.competitors]

    def to_df(self, spark: SparkSession) -> DataFrame:
        """(key, domain, rev_domain, role) — one row per target, size len(all)."""
        return self.names_df(spark).where("name = domain").select("key", "domain", "rev_domain", "role")

    def names_df(self, spark: SparkSession) -> DataFrame:
        """(key, domain, name, rev_domain, role) — one row per name of a target: the domain, then its aliases."""
        from .functions.domains import reverse_domain

        rows = [(t.key, t.domain, name, "own" if t.key == "own" else "competitor")
                for t in self.all for name in (t.domain, *t.aliases)]
        df = spark.createDataFrame(rows, "key string, domain string, name string, role string")
        return df.select("key", "domain", "name", reverse_domain("name").alias("rev_domain"), "role")


@dataclass(frozen=True)
class ScoreParams:
    """Score weights and the minimum number of linked competitors."""

    w_gap: float = 0.5
    w_auth: float = 0.3
    w_pers: float = 0.2
    min_competitors: int = 2


@dataclass(frozen=True)
class Release:
    id: str
    label: str
    crawls: tuple[str, ...] = field(default_factory=tuple)


# ---------------------------------------------------------------------------
# Fixed values. These must equal the reference's for identical results.
# ---------------------------------------------------------------------------

# Tracked domains of the reference deployment (own first, then competitors
# in report order) and their display names.
REFERENCE_TARGETS = Targets(
    own=Target("own", "omni.co"),
    competitors=(
        Target("sigma", "sigmacomputing.com"),
        Target("hex", "hex.tech"),
        Target("mode", "mode.com"),
        Target("lightdash", "lightdash.com"),
    ),
    display_names=("Sigma", "Hex", "Mode", "Lightdash"),
)

# Score weights and minimum competitor count.
DEFAULT_PARAMS = ScoreParams(w_gap=0.5, w_auth=0.3, w_pers=0.2, min_competitors=2)

# Keyword categories: ordered, the first unanchored regex that matches wins;
# the optional suffix is an extra LIKE '%<suffix>' test of the same rule.
CATEGORY_RULES: tuple[tuple[str, str, str | None], ...] = (
    ("listicle/review", "(top10|best|review|vs|compare|toplist)", None),
    ("community/education", "(learn|course|academy|tutorial|univ|school|edu)", ".edu"),
    ("dev-tooling/data-content", "(dev|docs|github|stack|engineer|data|analytics)", None),
    ("news/media", "(news|daily|weekly|times|post|magazine|media)", None),
    ("directory", "(directory|list|tools|apps|software|saas)", None),
)
DEFAULT_CATEGORY = "other"

# Releases of the reference deployment.
REFERENCE_RELEASES = (
    Release("cc-main-2026-mar-apr-may", "2026-05",
            ("CC-MAIN-2026-12", "CC-MAIN-2026-17", "CC-MAIN-2026-21")),
    Release("cc-main-2026-apr-may-jun", "2026-06",
            ("CC-MAIN-2026-17", "CC-MAIN-2026-21", "CC-MAIN-2026-25")),
)

# Number of rows shown in the report.
TOP_N = 25

# 1-based column positions in the web-graph text files.
GRAPH_COLUMNS = {
    "vertices": {"id": 1, "rev_domain": 2},
    "edges": {"src": 1, "dst": 2},
    "ranks": {"hc_pos": 1, "pr_pos": 3, "rev_domain": 5},
}
# ---------------------------------------------------------------------------


def releases_df(spark: SparkSession, releases=REFERENCE_RELEASES) -> DataFrame:
    schema = T.StructType([
        T.StructField("id", T.StringType(), False),
        T.StructField("label", T.StringType(), False),
        T.StructField("crawls", T.ArrayType(T.StringType()), False),
    ])
    return spark.createDataFrame([(r.id, r.label, list(r.crawls)) for r in releases], schema)


def select_releases(releases, release_id: str | None = None):
    """All releases, or the one with ``release_id``; an unknown id raises."""
    if release_id is None:
        return list(releases)
    todo = [r for r in releases if r.id == release_id]
    if not todo:
        raise ValueError(f"unknown release {release_id!r}; known: {[r.id for r in releases]}")
    return todo
