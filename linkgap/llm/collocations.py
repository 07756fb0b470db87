"""Phrase collocations by SETM: relations of occurrences, merge-joined with themselves.

An occurrence relation of length k holds (piece, position, phrase), sorted. It is
stored in blocks of whole documents: the phrase codes of a block lie in order of
their positions, with a gap between pieces, and phrases are named by the hashes of
their words. A block is a row group of its own, so that whoever reads or writes a relation holds
one block at a time, however many a file has. Joining a relation with itself at adjacent positions gives the
phrases of one more word; their groups are counted over all blocks (equal ones are
added up inside a task before they move), and only occurrences of frequent groups stay for the next length.
Groups are counted in passes over the relation, each pass those of a share of the hashes; there are as many as it
takes for what lies shuffled at a time to be a small share of all word occurrences.

That semi-join goes through a bitmap of the frequent groups' hashes of fixed
size: it keeps every frequent group whatever their number, and the few others that it lets
pass fall at the next count. Word hashes are checked to be free of
collisions over the whole corpus; if they are not, another seed is taken.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import rank_positions
from ..session import new_run_dir
from .common import arrow_batches, shuffles_dropped, stored
from .token_ids import rounds

MAX_WORDS = 3
MIN_COUNT = 10
#: A phrase is dropped if a longer one has at least this share (percent) of its occurrences.
COVERED_PERCENT = 50
TOP = 2000
#: Bytes of text in a block.
BLOCK_BYTES = 1 << 20
#: Bits of the bitmap of frequent groups, a power of two (8 MB).
FILTER_BITS = 26
#: A pass over a relation counts at most about one in so many of all word occurrences.
PASSES = 4
NO_LANG = "und"

_CLASS = np.zeros(256, np.uint8)  # 0: part of a word, 1: between words, 2: between pieces
_CLASS[list(b" \t")] = 1
_CLASS[list(b".,;:!?\n\x0b\x0c\r")] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLOCK = "block long, seq binary, lang array<string>, word array<string>, hash array<long>, n array<long>"


# -- relations of a block -------------------------------------------------------

def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(words in lower case, text of each, whether each begins a piece) of all texts; null is empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, 8 * texts.offset)
    if not len(texts) or offsets[0] == offsets[-1]:
        return pa.array([], pa.large_string()), np.empty(0, np.int64), np.empty(0, bool)
    data = np.frombuffer(texts.buffers()[2], np.uint8, int(offsets[-1] - offsets[0]), int(offsets[0]))
    offsets = offsets - offsets[0]
    kind = _CLASS[data]
    inside = kind == 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[heads] = inside[heads]  # a text begins a word anew
    starts = np.flatnonzero(first)
    if not len(starts):
        return pa.array([], pa.large_string()), np.empty(0, np.int64), np.empty(0, bool)
    sizes = np.add.reduceat(inside, starts, dtype=np.int64)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(ends), pa.py_buffer(_LOWER[data[inside]]))
    text = np.searchsorted(offsets, starts, side="right") - 1
    breaks = np.cumsum(kind == 2, dtype=np.int32)[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (text[1:] != text[:-1]) | (breaks[1:] != breaks[:-1])
    return words, text, new


def _blocks(seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in rounds(batch, 1, BLOCK_BYTES):
                words, text, new = split_words(part.column(1))
                if not len(words):
                    continue
                words, langs = words.dictionary_encode(), part.column(0).dictionary_encode()
                key = words.indices.to_numpy().astype(np.int64) * len(langs.dictionary) + langs.indices.to_numpy()[text]
                found, code, n = np.unique(key, return_inverse=True, return_counts=True)
                seq = np.zeros(len(key) + int(new.sum()), "<u4")
                seq[np.arange(len(key)) + np.cumsum(new)] = code + 1
                names = words.dictionary.take(pa.array(found // len(langs.dictionary))).to_pylist()
                of = langs.dictionary.take(pa.array(found % len(langs.dictionary))).to_pylist()
                hashes = np.array([xxhash.xxh64_intdigest(f"{b}\t{a}", seed) for a, b in zip(names, of)], np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block]), pa.array([seq.tobytes()], pa.binary()), pa.array([of], pa.list_(pa.string())),
                     pa.array([names], pa.list_(pa.string())), pa.array([hashes.view(np.int64)], pa.list_(pa.int64())),
                     pa.array([n], pa.list_(pa.int64()))], names=["block", "seq", "lang", "word", "hash", "n"])
                block += 1
    return run


def _turned(key: np.ndarray, k: int) -> np.ndarray:
    """Hashes of a phrase's word ``k`` (0 the first), turned by 17 bits more than those of the word before."""
    key, turn = key.view(np.uint64), np.uint64(17 * k % 64)
    return key << turn | key >> (np.uint64(64) - turn) if turn else key.copy()


def _mixed(keys: list[np.ndarray]) -> np.ndarray:
    """One hash of the words' hashes."""
    return reduce(np.bitwise_xor, [_turned(key, k) for k, key in enumerate(keys)])


def _mixed_column(keys: list[str]) -> Column:
    """The same as a Spark column."""
    out = F.col(keys[0])
    for k, key in enumerate(keys[1:], 1):
        turn = 17 * k % 64
        out = out.bitwiseXOR(F.shiftleft(key, turn).bitwiseOR(F.shiftrightunsigned(key, 64 - turn)))
    return out


def frequent_filter(frequent: DataFrame, keys: list[str], bits: int = FILTER_BITS) -> np.ndarray:
    """The bitmap of the frequent groups' hashes as 64-bit words; its size is fixed by ``bits``,
    and so is what reaches the driver."""
    h = _mixed_column(keys)
    word = h.bitwiseAND(F.lit((1 << bits - 6) - 1)).alias("word")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, 58).cast("int")).alias("bit")
    rows = frequent.select(word, bit).groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(1 << bits - 6, np.uint64)
    out[rows["word"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return out


def _passes(keys: list[np.ndarray], bitmap: np.ndarray) -> np.ndarray:
    h = _mixed(keys)
    return (bitmap[h & np.uint64(len(bitmap) - 1)] >> (h >> np.uint64(58)) & np.uint64(1)).astype(bool)


def _longer(seq: np.ndarray, keys: list[np.ndarray], share: int = 0,
            of: int = 1) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Merge-join of a relation with itself at adjacent positions: (seq, word hashes, counts) of
    the phrases of one more word. Code 0 of ``seq``: no phrase begins here. Of ``of`` shares of the
    phrases, by hash, only number ``share``."""
    both = np.flatnonzero((seq[:-1] > 0) & (seq[1:] > 0))
    if of > 1:
        h = _mixed(keys)[seq[both] - 1] ^ _turned(keys[-1], len(keys))[seq[both + 1] - 1]  # _mixed of the longer phrase
        both = both[(h >> np.uint64(32)) % np.uint64(of) == share]
    pair = seq[both].astype(np.int64) * (len(keys[0]) + 1) + seq[both + 1]
    found, code, n = np.unique(pair, return_inverse=True, return_counts=True)
    out = np.zeros(len(seq), "<u4")
    out[both] = code + 1
    left, right = found // (len(keys[0]) + 1) - 1, found % (len(keys[0]) + 1) - 1
    return out, [k[left] for k in keys] + [keys[-1][right]], n


def _kept(seq: np.ndarray, keys: list[np.ndarray], passes: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The relation without the phrases that do not pass."""
    renamed = np.concatenate([[0], np.where(passes, np.cumsum(passes), 0)]).astype("<u4")
    return renamed[seq], [k[passes] for k in keys]


def _relations(batches: Iterator[pa.RecordBatch], bitmap) -> Iterator[tuple[int, np.ndarray, list[np.ndarray]]]:
    for batch in batches:
        for row in range(batch.num_rows):
            seq = np.frombuffer(batch.column(1)[row].as_py(), "<u4")
            keys = [np.asarray(batch.column(k)[row].values) for k in range(2, batch.num_columns)]
            yield batch.column(0)[row].as_py(), *_kept(seq, keys, _passes(keys, bitmap.value))


def _counting(bitmap, share: int, of: int):
    """Groups (word hashes, count) of a share of the phrases of one more word, a block at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, seq, keys in _relations(batches, bitmap):
            _, keys, n = _longer(seq, keys, share, of)
            yield pa.RecordBatch.from_arrays([pa.array(k) for k in keys] + [pa.array(n)],
                                             names=[*(f"h{k}" for k in range(len(keys))), "n"])
    return run


def _extending(bitmap, longer):
    """The relation of one more word, frequent groups only."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, seq, keys in _relations(batches, bitmap):
            seq, keys, _ = _longer(seq, keys)
            seq, keys = _kept(seq, keys, _passes(keys, longer.value))
            if seq.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block]), pa.array([seq.tobytes()], pa.binary()), *(pa.array([k], pa.list_(pa.int64())) for k in keys)],
                    names=["block", "seq", *(f"h{k}" for k in range(len(keys)))])
    return run


# -- over all blocks --------------------------------------------------------------

def _written(df: DataFrame, name: str) -> DataFrame:
    """A relation, stored with a row group for each block: Spark's reader takes up to 4096 rows of a group at once."""
    out = new_run_dir(df.sparkSession, name)
    df.write.option("compression", "zstd").option("parquet.block.row.count.limit", 1).parquet(out)
    return df.sparkSession.read.schema(df.schema).parquet(out)


def _occurrences(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The stored relation of single words, and all words (lang, word, hash, f)."""
    for seed in range(8):
        blocks = _written(docs.mapInArrow(_blocks(seed), _BLOCK), "phrase-words")
        rows = blocks.select(F.explode(F.arrays_zip("lang", "word", "hash", "n")).alias("r")).select("r.*")
        words = stored(rows.groupBy("lang", "word", "hash").agg(F.sum("n").alias("f")), "phrase-vocabulary")
        if not words.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").limit(1).count():
            return blocks, words
    raise RuntimeError("no seed without a collision of word hashes")


def frequent_phrases(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", max_words: int = MAX_WORDS,
                     min_count: int = MIN_COUNT) -> tuple[DataFrame, DataFrame]:
    """((lang, words array, f) of every phrase of 1 to ``max_words`` words that occurs at least
    ``min_count`` times, (lang, n) with all word occurrences). Stored when called."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANG)).alias("lang"),
                       F.col(text_col).cast("string").alias("text"))
    blocks, words = _occurrences(rows)
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    frequent = stored(words.where(F.col("f") >= min_count), "phrase-frequent")
    phrases = [frequent.select("lang", F.array("word").alias("words"), "f")]
    occurrences = words.agg(F.sum("f")).first()[0] or 1
    relation, found, keys = blocks.select("block", "seq", F.col("hash").alias("h0")), frequent, ["hash"]
    for k in range(2, max_words + 1):
        bitmap = spark.sparkContext.broadcast(frequent_filter(found, keys))  # FILTER_BITS bits
        keys = [f"h{j}" for j in range(k)]
        # no more phrases of k words occur than frequent ones of one word less
        passes = max(1, -(-PASSES * (found.agg(F.sum("f")).first()[0] or 0) // occurrences))
        counted = []
        for share in range(passes):  # each one's shuffle is gone before the next
            groups = relation.mapInArrow(_counting(bitmap, share, passes), ", ".join(f"{c} long" for c in keys) + ", n long")
            groups = groups.groupBy(*keys).agg(F.sum("n").alias("f")).where(F.col("f") >= min_count)
            counted.append(stored(groups, "phrase-groups"))
        found = reduce(DataFrame.union, counted)
        named = found
        for j, key in enumerate(keys):  # frequent groups only; a shuffle join unless the planner finds a side small
            name = frequent.select(F.col("hash").alias(key), F.col("word").alias(f"w{j}"), *(["lang"] if not j else []))
            named = named.join(name, key)
        phrases.append(named.select("lang", F.array(*[f"w{j}" for j in range(k)]).alias("words"), "f"))
        if k < max_words:
            longer = spark.sparkContext.broadcast(frequent_filter(found, keys))
            schema = "block long, seq binary, " + ", ".join(f"{c} array<long>" for c in keys)
            relation = _written(relation.mapInArrow(_extending(bitmap, longer), schema), "phrase-relation")
    return stored(reduce(DataFrame.union, phrases), "phrases"), totals


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", max_words: int = MAX_WORDS,
                 min_count: int = MIN_COUNT, covered_percent: int = COVERED_PERCENT, top: int = TOP) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's phrases of 2 to ``max_words`` words by score.

    Score: a * a over l * r in millionths, floored, for the cut into two parts (l and r times) that makes it
    smallest, ties to the earliest. A phrase contained in a longer one with ``covered_percent`` of its
    occurrences is dropped. Ties of score go to the larger count, then to the phrase. Arithmetic is
    exact up to 10^15 occurrences (38-digit decimals).

    A null language is ``und`` (with documents that say so); null, empty and blank texts have no words; a text of
    any length is read whole; repeated rows count each. Other columns are ignored, whatever their names. An empty table
    gives no rows. ``top`` limits each language's rows.
    """
    with arrow_batches(docs.sparkSession, 2 * BLOCK_BYTES), shuffles_dropped(docs.sparkSession):  # these jobs run at once
        phrases, totals = frequent_phrases(docs, lang_col, text_col, max_words, min_count)
    names = phrases.select("lang", F.array_join("words", " ").alias("phrase"), "f")
    candidates = phrases.where(F.size("words") > 1).select("lang", "words", F.col("f").alias("a"))
    size = F.size("words")
    cuts = candidates.select("lang", "words", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("cut"))
    cuts = cuts.select("lang", "words", "a", "cut", F.array_join(F.slice("words", F.lit(1), F.col("cut")), " ").alias("left"),
                       F.array_join(F.slice("words", F.col("cut") + 1, F.size("words") - F.col("cut")), " ").alias("right"))
    cuts = cuts.join(names.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    cuts = cuts.join(names.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    a, l, r = (F.col(c).cast("decimal(15,0)") for c in ("a", "l", "r"))
    scored = cuts.withColumn("_square", F.lit(1_000_000).cast("decimal(7,0)") * (a * a)).withColumn("_parts", l * r)
    scored = scored.withColumn("score", F.expr("_square div _parts").cast("long"))
    best = scored.groupBy("lang", "words", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("best"))
    # contiguous parts of 2 words and more of every longer candidate
    spans = F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda n: F.transform(
        F.sequence(F.lit(1), F.size("words") - n + 1), lambda at: F.array_join(F.slice("words", at, n), " "))))
    covering = (candidates.where(size > 2).select("lang", F.explode(spans).alias("phrase"), "a")
                .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    left = (best.withColumn("phrase", F.array_join("words", " ")).join(covering, ["lang", "phrase"], "left")
            .where(~F.coalesce(F.col("longer") * 100 >= F.col("a") * covered_percent, F.lit(False))))
    # numbered over range-sorted partitions: a language's candidates are never one task's
    rows = left.select("lang", "phrase", "a", "best.l", "best.r", "best.score")
    ranked = rank_positions(rows, [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()], "rank", group="lang")
    return ranked.where(F.col("rank") <= top).join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
