"""Best-fit packing by minimum bin slack.

Texts become token pieces of at most ``capacity`` tokens. Pieces of equal
length are interchangeable, so the packing is planned on the number of pieces
of each length: at most ``capacity`` counts, whatever the corpus. Per bin, a
bitset subset-sum dynamic programme over the lengths still available finds the
fullest feasible combination that holds the longest one left; the combination
is then removed, at once for as many bins as its lengths last. Each planned
pattern names, for every length, which pieces (by rank within the length) go
to which of its bins and where; a join on length and rank hands them out.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import rank_positions
from .common import hash60, stored
from .token_ids import rounds, worker_ids

CAPACITY = 4096
END_ID = 1
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _pieces_of(batches: Iterator[pa.RecordBatch], path: str, capacity: int) -> Iterator[pa.RecordBatch]:
    worker = worker_ids(path)
    end = END_ID.to_bytes(4, "little")
    for batch in batches:
        for part in rounds(batch, 1):
            ids, offsets = worker.of(part.column(1))
            view, out = memoryview(ids).cast("B"), []
            for doc_id, low, high in zip(part.column(0).to_pylist(), offsets.tolist(), offsets[1:].tolist()):
                total = high - low + 1  # with the end id
                for k, at in enumerate(range(0, total, capacity)):
                    stop = min(at + capacity, total)
                    crc = zlib.crc32(view[4 * (low + at):4 * min(low + stop, high)])
                    out.append((doc_id, k, at, stop - at, zlib.crc32(end, crc) if stop == total else crc))
            cols = list(zip(*out)) or [()] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             names=["doc_id", "piece", "start", "length", "ids_crc32"])


def token_pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``: every text's ids and the end
    id, cut into pieces of ``capacity`` only where longer. Null is empty (one
    piece: the end id)."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(lambda it: _pieces_of(it, tokenizer_path, capacity), PIECES)


def _fullest(room: int, lengths: list[int], counts: dict[int, int]) -> dict[int, int]:
    """The multiset of available lengths with the largest sum up to ``room``,
    long lengths preferred. Bit s of a step's bitset: sum s can be reached."""
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for n in lengths:
        if n > room:
            continue
        left, block = min(counts[n], room // n), 1
        while left > 0:  # binary blocks 1, 2, 4, ... of one length
            k = min(block, left)
            steps.append((n, k, reach))
            reach |= (reach << (n * k)) & mask
            left -= k
            block *= 2
        if reach >> room:
            break
    total, chosen = reach.bit_length() - 1, {}
    for n, k, before in reversed(steps):
        if not total:
            break
        if not (before >> total) & 1:
            total -= n * k
            chosen[n] = chosen.get(n, 0) + k
    return chosen


def plan_patterns(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """[(pattern, bins)]: a pattern is {length: pieces per bin}, used for so
    many bins. Work and result depend on the distinct lengths (at most
    ``capacity``), not on how many pieces there are."""
    counts = {n: c for n, c in histogram.items() if c > 0}
    order = sorted(counts, reverse=True)
    plan = []
    while order:
        longest = order[0]
        counts[longest] -= 1
        fill = _fullest(capacity - longest, [n for n in order if counts[n]], counts)
        counts[longest] += 1
        fill[longest] = fill.get(longest, 0) + 1
        bins = min(counts[n] // k for n, k in fill.items())
        for n, k in fill.items():
            counts[n] -= k * bins
        plan.append((fill, bins))
        order = [n for n in order if counts[n]]
    return plan


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (with ``doc_id``, ``piece``, ``length``; lengths 1 to
    ``capacity``) plus ``sequence_id`` and ``offset``.

    Pieces of one length are ranked by a hash of their id and then by a row number, so a hot
    length (copies, the full pieces of long texts, rows that repeat wholly) is spread over all tasks. Null ids and
    repeated rows are placed like any other; no rows in, no rows out. A piece
    outside 1 to ``capacity`` raises. Runs jobs when called.
    """
    spark = pieces.sparkSession
    spread = pieces.withColumn("_spread", hash60(F.col("doc_id"), F.col("piece"))).withColumn(
        "_copy", F.monotonically_increasing_id())
    ranked = rank_positions(spread, [F.col(c).asc() for c in ("_spread", "doc_id", "piece", "_copy")],
                            "_rank", group="length").drop("_spread", "_copy")
    # at most `capacity` rows reach the driver: one count per length
    histogram = {r["length"]: r["n"] for r in ranked.groupBy("length").agg(F.count("*").alias("n"))
                 .limit(capacity + 1).collect()}
    if any(not n or not 0 < n <= capacity for n in histogram):
        raise ValueError(f"piece lengths must lie between 1 and {capacity}")
    given, rows, sequence = dict.fromkeys(histogram, 0), [], 0
    for fill, bins in plan_patterns(histogram, capacity):
        offset = 0
        for n, k in sorted(fill.items(), reverse=True):
            rows.append((n, given[n] + 1, given[n] + k * bins, k, sequence, offset))
            given[n] += k * bins
            offset += n * k
        sequence += bins
    # Intervals of ranks by length, gathered to one row per length: at most
    # `capacity` rows; the join key is the length, the interval is found inside.
    slots = spark.createDataFrame(rows, "length long, low long, high long, k int, first_bin long, first_offset long")
    return _hand_out(ranked, slots)


def _hand_out(ranked: DataFrame, slots: DataFrame) -> DataFrame:
    # size: one row per (pattern, length); patterns are bounded by the distinct lengths
    per_length = F.broadcast(slots.groupBy("length").agg(F.sort_array(F.collect_list(
        F.struct("low", "high", "k", "first_bin", "first_offset"))).alias("_slots")))
    hit = F.expr("filter(_slots, s -> s.low <= _rank and s.high >= _rank)")[0]
    at = F.col("_rank") - F.col("_hit.low")
    return (ranked.join(per_length, "length").withColumn("_hit", hit)
            .withColumn("sequence_id", F.col("_hit.first_bin") + F.floor(at / F.col("_hit.k")).cast("long"))
            .withColumn("offset", F.col("_hit.first_offset") + F.pmod(at, F.col("_hit.k")) * F.col("length"))
            .drop("_slots", "_hit", "_rank"))


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                   capacity: int = CAPACITY) -> DataFrame:
    """Token pieces of all documents, packed: ``doc_id, piece, start, length,
    ids_crc32, sequence_id, offset``. The pieces (no texts) are written once."""
    pieces = stored(token_pieces(docs, tokenizer_path, id_col, text_col, capacity), "pieces")
    return pack(pieces, capacity).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
