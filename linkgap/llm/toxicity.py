"""Toxicity by weak supervision.

Many simple voters look at a text: lexicons of words and word beginnings
(one general list, the others mined from the labelled training rows), patterns,
and counts of hits. A generative label model (class prior, each voter's
chances of voting toxic, clean or not at all given the class, and the voters'
correlations beyond the class) is fitted to the votes alone by expectation
maximisation; correlated voters share their weight. Its posterior labels train
a linear classifier over the lexicon entries and counts, which scores every text.

The model is fitted on at most ``MAX_LABELLED`` labelled rows, taken by a hash of
the id; scoring covers every row and whole texts.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored

#: Labelled rows the model is fitted on, at most. Documented bound of the sample.
MAX_LABELLED = 20_000
#: Word beginnings looked at.
STEM_LENGTHS = (3, 4, 5, 6)
MIN_SUPPORT = 3
MIN_LOG_ODDS = 2.0
MIN_PRECISION = 0.9
MAX_CHANCE = 5e-4
FOLDS = 4
#: Entries a task holds before it hands their counts on.
HELD_ENTRIES = 200_000

#: General insults; whole words.
GENERAL = ("idiot", "moron", "stupid", "loser", "scum", "trash", "pathetic", "worthless", "disgusting", "clown",
           "dumb", "imbecile", "vermin", "filth", "freak", "jerk", "creep", "coward", "liar", "pig")

_WORDS = re.compile(r"[^\W\d_]+")
_PATTERNS = (re.compile(r"\byou(?:'re| are| people)\b"), re.compile(r"!{2,}"), re.compile(r"\bshut up\b|\bgo away\b"))


def entries_of(text: str) -> set[str]:
    """``=word`` for the whole words of a text, ``stem`` for their beginnings."""
    out = set()
    for w in set(_WORDS.findall(text.lower())):
        if len(w) >= 3:
            out.add("=" + w)
            out.update(w[:k] for k in STEM_LENGTHS if len(w) > k)
    return out


class Finder:
    """Finds lexicon entries in a text: one automaton pass over the whole text."""

    def __init__(self, entries: list[str]):
        import ahocorasick

        at: dict[str, list[tuple[int, bool]]] = {}
        for i, e in enumerate(entries):
            at.setdefault(e.lstrip("="), []).append((i, e.startswith("=")))
        self.machine = ahocorasick.Automaton()
        for key, what in at.items():
            self.machine.add_word(key, (len(key), what))
        if at:
            self.machine.make_automaton()
        self.empty = not at

    def find(self, text: str) -> tuple[dict[int, int], int]:
        """(entry index -> times), number of words holding a hit."""
        hits: dict[int, int] = {}
        places = set()
        if self.empty:
            return hits, 0
        low = text.lower()
        n = len(low)
        for end, (length, what) in self.machine.iter(low):
            start = end - length + 1
            if start and low[start - 1].isalpha():
                continue
            ends = end + 1 == n or not low[end + 1].isalpha()
            for i, whole in what:
                if whole == ends:  # a beginning is shorter than its word
                    hits[i] = hits.get(i, 0) + 1
                    places.add(start)
        return hits, len(places)


@dataclass
class Model:
    """Lexicon entries with their weights, and the weights of the counts."""

    entries: list[str]
    weights: np.ndarray
    count_weight: float
    rate_weight: float
    bias: float


# -- features and votes -------------------------------------------------------

def _counts(words_hit: int, text: str) -> tuple[float, float]:
    """Damped number of words hit, and damped hits per thousand characters."""
    return math.log1p(words_hit), math.log1p(1000.0 * words_hit / (len(text) + 200))


def _patterns(text: str) -> list[int]:
    low = text.lower()
    letters = sum(map(str.isalpha, text))
    return [*(1 if p.search(low) else 0 for p in _PATTERNS),
            1 if letters > 40 and sum(map(str.isupper, text)) > 0.5 * letters else 0]


def voters(entries: list[str]) -> np.ndarray:
    """The lexicon voter of each entry: by kind (whole word, length of stem) and fold."""
    kind = [0 if e.startswith("=") else 1 + STEM_LENGTHS.index(len(e)) for e in entries]
    fold = [sum(map(ord, e)) % FOLDS for e in entries]
    return np.array(kind, int) * FOLDS + np.array(fold, int)


def votes(hits: list[dict[int, int]], words_hit: np.ndarray, sizes: np.ndarray, patterns: np.ndarray,
          entries: list[str]) -> np.ndarray:
    """Matrix of votes, a row per text: 1 toxic, -1 clean, 0 none."""
    by = voters(entries)
    n_lexicons = (1 + len(STEM_LENGTHS)) * FOLDS
    lexicon = np.zeros((len(hits), n_lexicons), int)
    for row, found in enumerate(hits):
        lexicon[row, by[list(found)]] = 1
    general = {i for i, e in enumerate(entries) if e[1:] in GENERAL and e[0] == "="}
    hit_general = np.array([bool(general & found.keys()) for found in hits], int)
    rate = 1000.0 * words_hit / (sizes + 200)
    counts = np.column_stack([hit_general, words_hit >= 2, words_hit >= 4, rate >= 1.0,
                              -(words_hit == 0).astype(int), -(rate < 0.3).astype(int)]).astype(int)
    return np.column_stack([lexicon, counts, patterns])


# -- the label model ----------------------------------------------------------

@dataclass
class LabelModel:
    prior: float
    chances: np.ndarray       # (2, voters, 3): class; vote -1, 0, 1
    correlations: np.ndarray  # (voters, voters), beyond the class
    shares: np.ndarray        # weight left to each voter
    posterior: np.ndarray


def fit_label_model(v: np.ndarray, rounds: int = 30) -> LabelModel:
    """Accuracies and correlations of the voters from their votes alone."""
    n, m = v.shape
    if not n:
        return LabelModel(0.0, np.full((2, m, 3), 1 / 3), np.eye(m), np.ones(m), np.zeros(0))
    toxic, clean = (v == 1).sum(1), (v == -1).sum(1)
    q = np.where((toxic >= 2) & (toxic > clean), 0.9, 0.05)
    onehot = np.stack([v == -1, v == 0, v == 1], axis=2).astype(float)
    shares, rho = np.ones(m), np.eye(m)
    chances = np.zeros((2, m, 3))
    for _ in range(rounds):
        prior = float(np.clip((q.sum() + 1) / (n + 2), 1e-4, 0.5))
        for k, w in enumerate((1 - q, q)):
            chances[k] = (np.einsum("i,imj->mj", w, onehot) + 0.5) / (w.sum() + 1.5)
        expected = (chances[:, :, 2] - chances[:, :, 0])
        residual = v - ((1 - q)[:, None] * expected[0] + q[:, None] * expected[1])
        spread = residual.std(0) + 1e-9
        rho = (residual - residual.mean(0)).T @ (residual - residual.mean(0)) / n / np.outer(spread, spread)
        np.fill_diagonal(rho, 1.0)
        shares = 1 / (1 + np.clip(rho - 0.1, 0, None).sum(1) - 0.9)
        gain = np.log(chances[1]) - np.log(chances[0])
        logit = math.log(prior / (1 - prior)) + (np.einsum("imj,mj->im", onehot, gain) * shares).sum(1)
        new = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        done = np.abs(new - q).max() < 1e-6
        q = new
        if done:
            break
    return LabelModel(prior, chances, rho, shares, q)


def fit_linear(hits: list[dict[int, int]], extra: np.ndarray, n_entries: int, target: np.ndarray,
               ridge: float = 0.3, steps: int = 600) -> np.ndarray:
    """Weights (entries, the columns of ``extra``, bias) of a logistic model of the
    soft labels; classes weigh alike up to a factor of four."""
    n, k = len(hits), extra.shape[1]
    rows = np.repeat(np.arange(n), [len(h) for h in hits])
    cols = np.array([i for h in hits for i in h], int)
    w = np.zeros(n_entries + k + 1)
    first = np.zeros_like(w)
    second = np.zeros_like(w)
    share = max(target.mean(), 1e-6)
    weight = np.where(target > 0.5, min(4.0, max(1.0, 0.5 / share)), 1.0)
    for step in range(1, steps + 1):
        z = np.bincount(rows, w[cols], n) + extra @ w[n_entries:-1] + w[-1]
        g = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target)
        grad = np.r_[np.bincount(cols, g[rows], n_entries), extra.T @ g, g.sum()]
        grad[:-1] += ridge * w[:-1]
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad * grad
        w -= 0.05 * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-9)
    return w


# -- fitting over Spark -------------------------------------------------------

def training_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "toxic", limit: int = MAX_LABELLED) -> DataFrame:
    """(text, toxic) of at most ``limit`` labelled ids of documents outside the held-out fold, one row an id
    (of different texts under an id the one of smallest hash). Ids with null or contradicting labels are left out."""
    by_id = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
             .groupBy(F.col(id_col).cast("long").alias("_id"))
             .agg(F.min(label_col).alias("_low"), F.max(label_col).alias("_high")).where("_low = _high"))
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    taken = (by_id.where(~fold_of(F.col("_id"))).join(rows.select("_id").distinct(), "_id")
             .select("_id", F.col("_low").cast("int").alias("toxic")).orderBy(F.xxhash64("_id"), "_id").limit(limit))
    # the taken labels are at most `limit` short rows
    found = rows.join(F.broadcast(taken), "_id")
    first = F.min(F.struct(F.xxhash64("text").alias("hash"), "text", "toxic")).alias("first")
    return found.groupBy("_id").agg(first).select("first.text", "first.toxic")


def fold_of(doc_id):
    """Whether an id is held out: crc32 of its digits is divisible by 5 (null: no)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _counted(toxic: Counter, clean: Counter) -> pa.RecordBatch:
    keys = list(toxic.keys() | clean.keys())
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([toxic[k] for k in keys], pa.int64()),
                                       pa.array([clean[k] for k in keys], pa.int64())],
                                      names=["entry", "n_toxic", "n_clean"])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts per entry and class, summed within a task, handed on whenever ``HELD_ENTRIES`` are held."""
    toxic, clean = Counter(), Counter()
    for batch in batches:
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            (toxic if label else clean).update(entries_of(text))
            if len(toxic) + len(clean) >= HELD_ENTRIES:
                yield _counted(toxic, clean)
                toxic, clean = Counter(), Counter()
    yield _counted(toxic, clean)


def tells_toxic(n_toxic: int, n_clean: int, toxic: int, clean: int) -> bool:
    """Whether an entry's texts (of so many of each class) mark the toxic class:
    enough precision and log odds, and a chance of at most ``MAX_CHANCE`` (Chernoff bound of the
    binomial tail) that an entry without bearing on the class looks like this."""
    a, b = toxic + 1, clean + 1
    n = n_toxic + n_clean
    if n_toxic < max(MIN_SUPPORT, MIN_PRECISION * n):
        return False
    if math.log((n_toxic + 0.5) / a) - math.log((n_clean + 0.5) / b) < MIN_LOG_ODDS:
        return False
    rate, seen = a / (a + b), n_toxic / n
    gain = seen * math.log(seen / rate) + ((1 - seen) * math.log((1 - seen) / (1 - rate)) if n_clean else 0.0)
    return seen > rate and n * gain >= -math.log(MAX_CHANCE)


def _accepted(batches: Iterator[pa.RecordBatch], toxic: int, clean: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())
        yield batch.filter(pa.array([tells_toxic(t, c, toxic, clean) for t, c in pairs], pa.bool_()))


def mine_entries(rows: DataFrame) -> list[str]:
    """The general list and every entry that ``tells_toxic`` accepts, most toxic texts first."""
    schema = "entry string, n_toxic long, n_clean long"
    n = {r["toxic"] != 0: r["count"] for r in rows.groupBy((F.col("toxic") != 0).cast("int").alias("toxic")).count()
         .collect()}
    n_toxic, n_clean = n.get(True, 0), n.get(False, 0)
    # only accepted entries reach the driver
    good = (rows.mapInArrow(_count, schema).groupBy("entry")
            .agg(F.sum("n_toxic").alias("n_toxic"), F.sum("n_clean").alias("n_clean"))
            .where(F.col("n_toxic") >= MIN_SUPPORT)
            .mapInArrow(lambda it: _accepted(it, n_toxic, n_clean), schema).collect())
    mined = [e for _, e in sorted(((r["n_toxic"], r["entry"]) for r in good), key=lambda x: (-x[0], x[1]))]
    general = ["=" + w for w in GENERAL]
    return [*general, *(e for e in mined if e not in general)]


def _features(batches: Iterator[pa.RecordBatch], entries: list[str]) -> Iterator[pa.RecordBatch]:
    finder = Finder(entries)
    for batch in batches:
        found = [(*finder.find(t), len(t), _patterns(t)) for t in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([list(f[0]) for f in found], pa.list_(pa.int32())), pa.array([f[1] for f in found], pa.int64()),
             pa.array([f[2] for f in found], pa.int64()), pa.array([f[3] for f in found], pa.list_(pa.int32()))],
            names=["hits", "words_hit", "size", "patterns"])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", limit: int = MAX_LABELLED) -> Model:
    """The classifier. Without toxic training rows it rests on the general list alone."""
    rows = stored(training_rows(docs, labels, id_col, text_col, label_col, limit), "toxicity-training")
    if not rows.where("toxic <> 0").limit(1).count():
        return Model(["=" + w for w in GENERAL], np.full(len(GENERAL), 4.0), 0.5, 0.0, -3.0)
    entries = mine_entries(rows)
    # at most `limit` rows of a few numbers each reach the driver
    seen = rows.select("text").mapInArrow(
        lambda it: _features(it, entries), "hits array<int>, words_hit long, size long, patterns array<int>").collect()
    seen.sort(key=lambda r: (r["size"], r["words_hit"], r["hits"]))
    hits = [dict.fromkeys(r["hits"], 1) for r in seen]
    words_hit, sizes = np.array([r["words_hit"] for r in seen]), np.array([r["size"] for r in seen])
    v = votes(hits, words_hit, sizes, np.array([r["patterns"] for r in seen], int), entries)
    labelled = fit_label_model(v)
    extra = np.column_stack([np.log1p(words_hit), np.log1p(1000.0 * words_hit / (sizes + 200))])
    w = fit_linear(hits, extra, len(entries), labelled.posterior)
    return Model(entries, w[:-3], float(w[-3]), float(w[-2]), float(w[-1]))


def _score(batches: Iterator[pa.RecordBatch], model: Model, at: int, name: str) -> Iterator[pa.RecordBatch]:
    finder = Finder(model.entries)
    weights = model.weights.tolist()
    for batch in batches:
        out = []
        for text in batch.column(at):
            text = text.as_py() or ""
            hits, words_hit = finder.find(text)
            count, rate = _counts(words_hit, text)
            z = model.bias + sum(weights[i] for i in hits) + model.count_weight * count + model.rate_weight * rate
            out.append(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.float64())],
                                         names=[*batch.schema.names, name])


def score(docs: DataFrame, model: Model, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the toxicity ``name`` (0 to 1) of every whole text. A null
    text is empty. The model, bounded by the entries of the training rows, goes to the tasks
    with the function."""
    from pyspark.sql import types as T
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])
    at = docs.columns.index(text_col)
    return docs.mapInArrow(lambda it: _score(it, model, at, name), schema)


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``: null and
    empty texts score by the bias alone, null ids are not held out, repeated
    rows score alike, extra columns are ignored, an empty table gives no rows."""
    model = fit(docs, labels)
    rows = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"))
    return score(rows, model).select("doc_id", fold_of(F.col("doc_id")).alias("held_out"), "score",
                                     (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_clean(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows that score 0.5 or more; same columns, whatever their names.

    Null and empty texts score by the bias alone and stay unless that rejects them; texts of any length are scored
    whole; rows that repeat are scored alike; null ids pass through; an empty table gives no rows. No
    labels: the general list alone speaks."""
    from .common import fresh_name
    name = fresh_name(docs, "score")
    return score(docs, fit(docs, labels), name=name).where(F.col(name) < 0.5).select(*docs.columns)
