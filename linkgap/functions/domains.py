"""Domain-key column functions (all JVM-side built-ins, no UDF).

* ``normalize_domain``: trim whitespace, lowercase, strip every trailing
  dot, strip one leading ``www.`` — in that order.
* ``reverse_domain``: normalise, then reverse the dot-separated labels
  (``omni.co`` <-> ``co.omni``); self-inverse on clean names.
* ``unreverse_domain``: what the staging layer applies to graph names:
  reverse the labels and lowercase, without the other normalisation steps.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_domain(c) -> Column:
    c = _col(c)
    trimmed = F.regexp_replace(c, r"^\s+|\s+$", "")
    no_dots = F.regexp_replace(F.lower(trimmed), r"\.+$", "")
    return F.regexp_replace(no_dots, r"^www\.", "")


def _reverse_labels(c: Column) -> Column:
    # split() takes a regex, so the dot is escaped; trailing empty labels are kept.
    return F.array_join(F.reverse(F.split(c, r"\.", -1)), ".")


def reverse_domain(c) -> Column:
    return _reverse_labels(normalize_domain(c))


def unreverse_domain(c) -> Column:
    return F.lower(_reverse_labels(_col(c)))


def url_host(c) -> Column:
    """Host part of an absolute URL without user and port; the empty string
    when there is none, null for a null URL."""
    return F.regexp_extract(_col(c), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1)

