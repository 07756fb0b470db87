"""Declared schemas (never inferred)."""

from pyspark.sql import types as T

_L, _S, _D, _I = T.LongType(), T.StringType(), T.DoubleType(), T.IntegerType()


def _struct(*fields, nullable=True):
    return T.StructType([T.StructField(n, t, nullable) for n, t in fields])


# Web-graph text files (tab separated, no quoting).
VERTICES = _struct(("id", _L), ("rev_domain", _S))
EDGES = _struct(("src", _L), ("dst", _L))
RANKS_FILE = _struct(("hc_pos", _L), ("hc_val", _D), ("pr_pos", _L), ("pr_val", _D), ("rev_domain", _S))

# Per-release slices (what extraction hands to the loader).
SLICE_EDGES = _struct(("source_id", _L), ("target_domain", _S))
SLICE_SOURCES = _struct(("source_id", _L), ("rev_domain", _S))
SLICE_RANKS = _struct(("rev_domain", _S), ("hc_pos", _L), ("pr_pos", _L))

# Published raw tables; release and run are partition columns.
RAW_EDGES = _struct(("source_id", _L), ("source_rev_domain", _S), ("target_domain", _S),
                    ("release", _S), ("run", _S))
RAW_RANKS = _struct(("source_rev_domain", _S), ("hc_pos", _L), ("pr_pos", _L),
                    ("release", _S), ("run", _S))
RAW_STATS = _struct(("nodes_total", _L), ("release", _S), ("run", _S))
# One release's coverage: the targets each source domain links to.
COVERAGE = _struct(("source_domain", _S), ("targets", T.ArrayType(_S)), ("release", _S), ("run", _S))
LEDGER = _struct(("release", _S), ("run", _S), ("committed_at", T.TimestampType()),
                 ("edges", _L), ("ranks", _L), ("stats", _L), ("inputs_hash", _S), ("coverage", _L))
STEP_LEDGER = _struct(("release", _S), ("step", _S), ("inputs_hash", _S), ("rows", _L),
                      ("done_at", T.TimestampType()))

# Curated CSV files (header line, standard quoting).
OVERRIDES = _struct(("source_domain", _S), ("category", _S))
ACTIONS = _struct(("source_domain", _S), ("action", _S))
DUPLICATES = _struct(("canonical_domain", _S), ("duplicate_domain", _S), ("note", _S))
