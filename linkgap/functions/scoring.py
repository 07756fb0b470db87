"""Score, authority and category expressions (built-in Columns only)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import CATEGORY_RULES, DEFAULT_CATEGORY, ScoreParams


def competitor_count(flag_cols: list[str]) -> Column:
    """Sum of the competitor flags, added left to right (own flag excluded)."""
    return reduce(lambda a, b: a + b, [F.col(c) for c in flag_cols])


def authority_percentile(hc_pos, nodes_total) -> Column:
    """``1 - (hc_pos - 1) / nodes_total`` in double precision; 1 is the best
    rank. Not clamped. A zero node count gives null (try_divide) instead of
    an ANSI error, which downstream coalesces to 0."""
    hc = F.col(hc_pos) if isinstance(hc_pos, str) else hc_pos
    n = F.col(nodes_total) if isinstance(nodes_total, str) else nodes_total
    return F.lit(1.0) - F.try_divide(hc.cast("double") - F.lit(1.0), n.cast("double"))


def opportunity_score(count: Column, n_competitors: int, authority: Column,
                      present: Column, p: ScoreParams) -> Column:
    """``w_gap*count/n + w_auth*authority + w_pers*present``, evaluated left to
    right in double precision (the order matters for bit-equal results)."""
    gap = F.lit(float(p.w_gap)) * count / F.lit(float(n_competitors))
    return gap + F.lit(float(p.w_auth)) * authority + F.lit(float(p.w_pers)) * present


def keyword_category(domain, rules=CATEGORY_RULES, default: str = DEFAULT_CATEGORY) -> Column:
    """Ordered keyword rules: the first unanchored regex hit wins."""
    d = F.col(domain) if isinstance(domain, str) else domain
    expr = None
    for name, pattern, suffix in rules:
        cond = d.rlike(pattern)
        if suffix:
            cond = cond | d.endswith(suffix)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)
