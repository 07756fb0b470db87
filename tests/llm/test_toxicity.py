import math
import random
import zlib

import numpy as np
from conftest import SF01, has_data
from llm_rows import docs_frame, odd_docs  # noqa: F401

from linkgap.llm import toxicity as X

LABELS = "doc_id long, quality int, toxic int"


def made(n=700, seed=4):
    """Documents of invented words; the toxic ones hold words that begin with a stem."""
    rng = random.Random(seed)
    syllables = [a + b for a in "bdfglmnprst" for b in "aeiou"]
    word = lambda: "".join(rng.choices(syllables, k=rng.randint(2, 4)))
    rows, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rng.randint(20, 120))]
        toxic = i % 9 == 0
        for _ in range(rng.randint(2, 5) if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(["idiot", "zkor" + word(), "zkor" + word(), "qqaf" + word()]))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_finder_sees_whole_words_and_beginnings():
    f = X.Finder(["=idiot", "zko", "=zko"])
    hits, words = f.find("Idiot idiots zkora! un-zko xzko ZKO")
    assert hits == {0: 1, 1: 1, 2: 2} and words == 4
    assert X.Finder([]).find("x") == ({}, 0) and f.find("") == ({}, 0)


def test_label_model_finds_accuracies_and_correlations():
    rng = np.random.default_rng(0)
    y = rng.random(4000) < 0.2
    def voter(hit, false):
        return np.where(y, rng.random(4000) < hit, rng.random(4000) < false).astype(int)
    good, weak = voter(0.9, 0.01), voter(0.6, 0.2)
    clean = -voter(0.05, 0.95)
    other = voter(0.8, 0.02)
    v = np.column_stack([good, other, weak, weak, clean])
    m = X.fit_label_model(v)
    assert ((m.posterior >= 0.5) == y).mean() > 0.95
    assert abs(m.chances[1, 0, 2] - 0.9) < 0.06 and m.chances[0, 0, 2] < 0.05
    assert m.correlations[2, 3] > 0.95 and m.shares[2] < 0.6 < m.shares[0]
    assert X.fit_label_model(v[:0]).posterior.size == 0


def test_entries_need_more_than_chance():
    assert X.tells_toxic(30, 1, 100, 900) and not X.tells_toxic(3, 0, 100, 200)
    assert not X.tells_toxic(30, 10, 100, 900) and not X.tells_toxic(1, 0, 1, 1)


def test_the_sample_is_one_row_an_id_that_has_a_document(spark):
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    ids = [i for i in range(400) if not held(i)]
    docs = [(i, f"text {i}") for i in ids[:40]] + [(ids[0], f"text {ids[0]}")] * 100 + [(ids[1], "another text")] * 50
    labels = spark.createDataFrame([(i, 1, i % 2) for i in ids], LABELS)
    df = docs_frame(spark, docs).repartition(5)
    assert X.training_rows(df, labels).count() == 40
    got = [r.text for r in X.training_rows(df, labels, limit=30).collect()]
    assert len(got) == len(set(got)) == 30 and sum(t == "another text" or t == f"text {ids[1]}" for t in got) <= 1


def test_rare_telling_words_are_mined_beside_many_common_ones(spark):
    # 21,000 words in every row of both classes, and more telling words than any fixed share of them
    letters = "bcdfghjklm"
    name = lambda i: "".join(letters[int(c)] for c in f"{i:05d}")
    common = " ".join("a" + name(i) for i in range(21_000))
    telling = ["z" + name(i) for i in range(2_500)]
    rows = [(common + " " + " ".join(telling), 1)] * 3 + [(common, 1)] + [(common, 0)] * 60
    got = X.mine_entries(spark.createDataFrame(rows, "text string, toxic int").repartition(4))
    assert {"=" + w for w in telling} <= set(got) and not any(e.startswith("=a") for e in got)


def test_learns_from_the_training_fold_alone(spark):
    rows, labels = made()
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    df = docs_frame(spark, rows)
    got = {r.doc_id: r for r in X.score_documents(df, spark.createDataFrame(labels, LABELS)).collect()}
    assert {i for i, r in got.items() if r.held_out} == {i for i, _ in rows if held(i)}
    tests = [(got[i].predicted, t) for i, _, t in labels if held(i)]
    assert sum(p == t for p, t in tests) >= 0.97 * len(tests)
    # labels of the held-out fold change nothing
    other = [(i, 1, 1 - t if held(i) else t) for i, _, t in labels]
    again = {r.doc_id: r.score for r in X.score_documents(df, spark.createDataFrame(other, LABELS)).collect()}
    assert again == {i: r.score for i, r in got.items()}


def test_odd_rows_no_labels_and_contradictions(spark, odd_docs):  # noqa: F811
    none = spark.createDataFrame([], LABELS)
    rows = X.score_documents(odd_docs, none).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert [r.held_out for r in rows if r.doc_id is None] == [False] * 2
    odd = spark.createDataFrame([(1, 1, None), (2, 1, 0), (2, 1, 1), (None, 1, 1), (99, 1, 1)], LABELS)
    assert X.training_rows(odd_docs, odd).count() == 0
    assert X.score_documents(odd_docs.limit(0), none).count() == 0
    kept = X.keep_clean(spark, odd_docs, none)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()
    insult = docs_frame(spark, [(1, "you pathetic idiot"), (2, "a kind word")])
    assert [r.predicted for r in X.score_documents(insult, none).orderBy("doc_id").collect()] == [1, 0]


@has_data
def test_held_out_accuracy(spark):
    from linkgap.llm.queries import QUERIES
    sf = SF01.replace("0.01", "0.1")
    got = QUERIES["op10_toxicity"](spark, sf).where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    rows = got.select("predicted", "toxic").collect()
    hit = sum(r.predicted and r.toxic for r in rows)
    assert hit >= 0.9 * sum(r.toxic for r in rows) and hit >= 0.9 * sum(r.predicted for r in rows)


def plain_hits(entries, text):
    """(entry index -> times, words hit) by looking at every word."""
    hits, words_hit = {}, 0
    for w in X._WORDS.findall(text.lower()):
        mine = [i for i, e in enumerate(entries) if (e == "=" + w if e[0] == "=" else len(e) < len(w) and w.startswith(e))]
        for i in mine:
            hits[i] = hits.get(i, 0) + 1
        words_hit += bool(mine)
    return hits, words_hit


def plain_posterior(v, rounds=30):
    """The label model by loops over rows and voters."""
    n, m = len(v), len(v[0])
    q = [0.9 if sum(x == 1 for x in r) >= max(2, sum(x == -1 for x in r) + 1) else 0.05 for r in v]
    shares = [1.0] * m
    for _ in range(rounds):
        prior = min(0.5, max(1e-4, (sum(q) + 1) / (n + 2)))
        p = [[[(sum(w for w, r in zip(weight, v) if r[j] == vote) + 0.5) / (sum(weight) + 1.5) for vote in (-1, 0, 1)]
              for j in range(m)] for weight in ([1 - x for x in q], q)]
        res = [[r[j] - sum(w * (p[k][j][2] - p[k][j][0]) for k, w in ((0, 1 - x), (1, x))) for j in range(m)] for r, x in zip(v, q)]
        mean = [sum(r[j] for r in res) / n for j in range(m)]
        cov = [[sum((r[a] - mean[a]) * (r[b] - mean[b]) for r in res) / n for b in range(m)] for a in range(m)]
        sd = [cov[a][a] ** 0.5 + 1e-9 for a in range(m)]
        rho = [[1.0 if a == b else cov[a][b] / (sd[a] * sd[b]) for b in range(m)] for a in range(m)]
        shares = [1 / (1 + sum(max(0.0, x - 0.1) for x in rho[a]) - 0.9) for a in range(m)]
        new = []
        for r in v:
            z = math.log(prior / (1 - prior)) + sum(shares[j] * math.log(p[1][j][r[j] + 1] / p[0][j][r[j] + 1]) for j in range(m))
            new.append(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
        done = max(abs(a - b) for a, b in zip(new, q)) < 1e-6
        q = new
        if done:
            break
    return q


def test_label_model_equals_plain_loops():
    rng = random.Random(3)
    v = [[rng.choice([1, 0, 0] if (t := rng.random() < 0.3) else [0, 0, 0, 1]), rng.choice([1, 1, 0]) if t else 0,
          -1 if not t and rng.random() < 0.8 else 0] for _ in range(150)]
    v = [r + [r[1]] for r in v]  # a copy of a voter
    got = X.fit_label_model(np.array(v)).posterior
    assert np.allclose(got, plain_posterior(v), atol=1e-6)


@has_data
def test_scores_of_the_query_equal_a_plain_loop(spark):
    import pyarrow.parquet as pq
    sf = SF01.replace("0.01", "0.001")
    docs = pq.read_table(f"{sf}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    df, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = X.fit(df, labels)
    got = {r.doc_id: r.score for r in X.score(df.select("doc_id", "text"), model).collect()}
    for d in docs:
        text = d["text"] or ""
        hits, n = plain_hits(model.entries, text)
        assert (hits, n) == X.Finder(model.entries).find(text)
        z = (model.bias + sum(model.weights[i] for i in hits) + model.count_weight * math.log(1 + n)
             + model.rate_weight * math.log(1 + 1000 * n / (len(text) + 200)))
        assert abs(got[d["doc_id"]] - 1 / (1 + math.exp(-max(-30, min(30, z))))) < 1e-12
