"""Semantic layer over the mart: named dimensions and measures, a default
filter, sample queries and a general ``topic_query``.

Metric definitions are Python data; a query becomes one DataFrame plan
(filter -> group/aggregate or select -> sort -> limit). Field metadata
(label, format, ...) rides on the output columns.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Targets


@dataclass(frozen=True)
class Dimension:
    name: str
    label: str
    description: str = ""
    group_label: str | None = None
    synonyms: tuple[str, ...] = ()
    format: str | None = None
    primary_key: bool = False


@dataclass(frozen=True)
class Measure:
    name: str
    label: str
    aggregate: str            # count | average
    column: str | None = None
    format: str | None = None
    description: str = ""


@dataclass(frozen=True)
class Filter:
    field: str
    op: str                   # >=, >, <=, <, =, !=
    value: object


@dataclass(frozen=True)
class Sort:
    field: str
    desc: bool = False


@dataclass(frozen=True)
class TopicModel:
    dimensions: dict[str, Dimension]
    measures: dict[str, Measure]
    default_filters: tuple[Filter, ...] = field(default_factory=tuple)

    def lookup(self, text: str) -> str:
        """Field name for a name, label or synonym (case-insensitive)."""
        t = text.strip().lower()
        for f in list(self.dimensions.values()) + list(self.measures.values()):
            names = {f.name.lower(), f.label.lower()} | {s.lower() for s in getattr(f, "synonyms", ())}
            if t in names:
                return f.name
        raise KeyError(text)


def topic_model(targets: Targets, min_competitors: int = 2) -> TopicModel:
    """Dimensions and measures over the mart (the constant own flag is
    left out)."""
    dims = [
        Dimension("source_domain", "Referring Domain", "Referring domain that links to competitors but not to us.",
                  synonyms=("referring domain", "linking site"), primary_key=True),
        Dimension("category", "Outreach Category", "Outreach category of the domain.",
                  synonyms=("outreach category", "content type")),
    ]
    for t, name in zip(targets.competitors, targets.names):
        dims.append(Dimension(f"links_{t.key}", f"Links to {name}", f"1 if the domain links to {t.domain}, else 0.",
                              group_label="Competitor Links"))
    dims += [
        Dimension("competitor_count", "Competitor Count", "Number of tracked competitors linked.",
                  synonyms=("competitor coverage", "number of competitors")),
        Dimension("present_in_both", "Present in Both Releases", "1 if seen linking in every loaded release."),
        Dimension("releases_seen", "Releases Seen", "Number of releases with a link to a target."),
        Dimension("authority_percentile", "Authority Percentile", "Centrality rank as a percentile.",
                  format="percent_1"),
        Dimension("opportunity_score", "Opportunity Score", "Weighted gap, authority and persistence.",
                  synonyms=("priority score", "ranking score"), format="number_2"),
    ]
    measures = [
        Measure("opportunity_count", "Opportunity Count", "count", description="Number of gap domains."),
        Measure("avg_opportunity_score", "Avg Opportunity Score", "average", "opportunity_score", "number_2",
                "Mean opportunity score of the domains."),
        Measure("avg_competitor_coverage", "Avg Competitor Coverage", "average", "competitor_count", "number_1",
                "Mean number of tracked competitors the domains link to."),
    ]
    return TopicModel({d.name: d for d in dims}, {m.name: m for m in measures},
                      (Filter("competitor_count", ">=", min_competitors),))


_OPS = {">=": Column.__ge__, ">": Column.__gt__, "<=": Column.__le__, "<": Column.__lt__,
        "=": Column.__eq__, "!=": Column.__ne__}


def _metadata(field) -> dict:
    """What a column tells its reader: label, format, and what else the field has."""
    meta = {"label": field.label, "format": field.format, "description": getattr(field, "description", ""),
            "group_label": getattr(field, "group_label", ""), "synonyms": list(getattr(field, "synonyms", ()))}
    return {k: v for k, v in meta.items() if v}


def _measure_col(m: Measure) -> Column:
    meta = _metadata(m)
    if m.aggregate == "count":
        c = F.count(F.lit(1))
    elif m.aggregate == "average":
        c = F.avg(F.col(m.column))
    else:
        raise ValueError(f"unknown aggregate {m.aggregate}")
    return c.alias(m.name, metadata=meta)


def topic_query(mart: DataFrame, model: TopicModel, fields: list[str],
                filters: tuple[Filter, ...] | None = None, sorts: tuple[Sort, ...] = (),
                limit: int | None = None) -> DataFrame:
    """Dimensions in ``fields`` are grouped, measures aggregated; without
    measures the dimensions are selected row by row. ``filters=None``
    applies the model's default filters; pass ``()`` to remove them."""
    df = mart
    for f in (model.default_filters if filters is None else filters):
        df = df.where(_OPS[f.op](F.col(f.field), F.lit(f.value)))
    dims = [f for f in fields if f in model.dimensions]
    meas = [f for f in fields if f in model.measures]
    unknown = set(fields) - set(dims) - set(meas)
    if unknown:
        raise KeyError(f"unknown fields {sorted(unknown)}")
    # sort fields that are not shown: measures are aggregated as well, dimensions
    # are carried row by row (a grouped query has no single value of them)
    hidden = [s.field for s in sorts if s.field not in fields]
    if meas and (other := [f for f in hidden if f not in model.measures]):
        raise KeyError(f"cannot sort groups by {sorted(other)}")
    more = [f for f in dict.fromkeys(hidden) if not meas]
    dim_cols = [F.col(d).alias(d, metadata=_metadata(model.dimensions[d])) for d in dims]
    if meas:
        out = df.groupBy(*dim_cols).agg(*[_measure_col(model.measures[m]) for m in dict.fromkeys(
            meas + [f for f in hidden if f in model.measures])])
    else:
        out = df.select(*dim_cols, *[F.col(d) for d in more])
    if sorts:
        out = out.orderBy(*[F.col(s.field).desc() if s.desc else F.col(s.field).asc() for s in sorts])
    out = out.select(*fields)
    if limit is not None:
        out = out.limit(limit)
    return out


def top_opportunities_query(mart: DataFrame, model: TopicModel, n: int = 25) -> DataFrame:
    """Sample query 'Top 25 Opportunities': score desc, limit n (the rest of
    the total order added as tie-break so the result is deterministic)."""
    fields = ["source_domain", "category", "competitor_count", "authority_percentile", "opportunity_score"]
    sorts = (Sort("opportunity_score", True), Sort("competitor_count", True),
             Sort("authority_percentile", True), Sort("source_domain"))
    return topic_query(mart, model, fields, sorts=sorts, limit=n)


def by_category_query(mart: DataFrame, model: TopicModel) -> DataFrame:
    """Sample query 'Opportunities by Category': count and average score per
    category, average score desc."""
    return topic_query(mart, model, ["category", "opportunity_count", "avg_opportunity_score"],
                       sorts=(Sort("avg_opportunity_score", True), Sort("category")))
