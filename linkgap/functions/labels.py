"""Display columns of the report (labels and number formats)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def links_to_label(flag_cols: list[str], names: list[str]) -> Column:
    """``"Sigma, Hex"``: names of the linked competitors in fixed order."""
    parts = [F.when(F.col(c) == 1, F.lit(n)) for c, n in zip(flag_cols, names)]
    return F.concat_ws(", ", *parts)  # concat_ws skips the nulls of unset flags


def yes_no(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c != 0, F.lit("Yes")).otherwise(F.lit("No"))


def category_title(c) -> Column:
    """Title case like Python's ``str.title``: every letter that follows a
    non-letter is upper-cased (``dev-tooling/data-content`` ->
    ``Dev-Tooling/Data-Content``). Plain ``initcap`` only splits on spaces."""
    c = F.col(c) if isinstance(c, str) else c
    pieces = F.split(c, r"(?<=[^a-zA-Z])")
    return F.array_join(F.transform(pieces, lambda p: F.initcap(p)), "")


def fmt_fixed(c, digits: int) -> Column:
    """Fixed-point text with thousands separators, rounded by the value's exact
    binary expansion. ``format_number`` does so except below the first shown
    digit, where it takes half a unit for a tie; there the result is one unit or none."""
    c = F.col(c) if isinstance(c, str) else c
    half = 0.5 * 10.0 ** -digits
    at_half = Decimal(half) > Decimal(5).scaleb(-digits - 1)  # whether that double lies above the exact half
    up = (F.abs(c) >= F.lit(half)) if at_half else (F.abs(c) > F.lit(half))
    sign = F.when(c < 0, F.lit("-")).otherwise(F.lit(""))
    unit, none = f"{10.0 ** -digits:.{digits}f}", f"{0:.{digits}f}"
    small = F.concat(sign, F.when(up, F.lit(unit)).otherwise(F.lit(none)))
    return F.when(F.abs(c) < F.lit(10.0 ** -digits), small).otherwise(F.format_number(c, digits))


def fmt_percent(c, digits: int = 1) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.concat(fmt_fixed(c * F.lit(100.0), digits), F.lit("%"))
