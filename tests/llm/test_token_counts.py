import os
import random
import re

import pyarrow as pa
import pytest
from conftest import SF001
from llm_rows import docs_frame, has_vocabularies, odd_docs  # noqa: F401

from linkgap.llm import token_counts
from linkgap.llm.token_counts import MARK, TrieCounter, count_tokens, zipf_scores


def plain_count(word, scores, unknown):
    """Tokens of the best segmentation, by trying all of them."""
    best = {0: (0.0, 0)}
    text = MARK + word
    for end in range(1, len(text) + 1):
        options = [(best[end - 1][0] + unknown, -(best[end - 1][1] + len(text[end - 1].encode())))]
        options += [(best[a][0] + scores[text[a:end]], -(best[a][1] + 1)) for a in range(end) if text[a:end] in scores]
        score, n = max(options)
        best[end] = (score, -n)
    return best[len(text)][1]


@pytest.mark.parametrize("seed", range(5))
def test_counts_equal_all_segmentations(seed):
    rng = random.Random(seed)
    pieces = {"".join(rng.choices("ab" + MARK, k=rng.randint(1, 4))) for _ in range(25)}
    scores = {p: -float(rng.randint(1, 9)) for p in pieces}
    counter = TrieCounter(scores)
    words = {"".join(rng.choices("abcé", k=rng.randint(1, 9))) for _ in range(300)}
    counter.learn(words)
    assert {w: counter.counts[w] for w in words} == {w: plain_count(w, scores, counter.unknown) for w in words}


def test_shared_prefixes_are_computed_once():
    counter = TrieCounter({"a": -1.0, "b": -1.0, MARK: -1.0})
    states = lambda: len(counter.forward)  # noqa: E731  a state is computed when its node is made
    counter.learn({"a" * 50 + c for c in "abab"} | {"a" * k for k in range(1, 50)})
    assert states() == 1 + 1 + 51 + 1  # the root, the mark, 51 a's, one b
    # later batches: what is in the trie is not computed again
    counter.learn({"a" * 50, "a" * 20, "a" * 50 + "b"})
    assert states() == 54
    counter.learn({"a" * 53, "a" * 50 + "ba"})
    assert states() == 54 + 2 + 1
    assert counter.counts["a" * 53] == 54


def plain_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_counts_of_texts_equal_a_plain_loop():
    rng = random.Random(7)
    scores = {p: -float(rng.randint(1, 9)) for p in ("a", "b", "ab", MARK + "a", "bb", MARK, "ba")}
    counter = TrieCounter(scores)
    texts = ["".join(rng.choices("aabbé \t\n\x0b\x1c", k=rng.randint(0, 40))) for _ in range(200)] + [None, "", "  "]
    for part in (texts[:90], texts[90:], []):
        words, tokens = counter.of(pa.array(part, pa.string()))
        assert list(zip(words.tolist(), tokens.tolist())) == [
            (len(plain_words(t)), sum(plain_count(w, scores, counter.unknown) for w in plain_words(t))) for t in part]


@has_vocabularies
def test_query_equals_a_plain_loop(spark):
    import pyarrow.parquet as pq
    from linkgap.llm.queries import PIECES, op6_token_counts, tokenizer_path
    from tokenizers import Tokenizer, models
    scores = zipf_scores(tokenizer_path(PIECES))
    low = min(scores.values())
    vocab = [("<unk>", low), *((f"<0x{i:02X}>", low) for i in range(256)), *scores.items()]
    other = Tokenizer(models.Unigram(vocab=vocab, unk_id=0, byte_fallback=True))
    known, want = {}, []
    for d in pq.read_table(f"{SF001}/documents.parquet", columns=["doc_id", "text"]).to_pylist():
        words = plain_words(d["text"])
        for w in set(words) - set(known):
            known[w] = len(other.encode(MARK + w, add_special_tokens=False).ids)
        want.append((d["doc_id"], len(words), sum(known[w] for w in words)))
    assert sorted(tuple(r) for r in op6_token_counts(spark, SF001).collect()) == sorted(want)


@has_vocabularies
def test_counts_equal_an_independent_unigram_model(spark):
    from linkgap.llm.queries import PIECES, tokenizer_path
    from tokenizers import Tokenizer, models
    scores = zipf_scores(tokenizer_path(PIECES))
    low = min(scores.values())
    vocab = [("<unk>", low), *((f"<0x{i:02X}>", low) for i in range(256)), *scores.items()]
    other = Tokenizer(models.Unigram(vocab=vocab, unk_id=0, byte_fallback=True))
    counter = TrieCounter(scores)
    words = {"日本", "ÿẞ", "x" * 50, "ﬁ#!", "internationalization"}
    if os.path.exists(SF001):
        for r in spark.read.parquet(f"{SF001}/documents.parquet").select("text").collect():
            words.update((r.text or "").split(" ")[:50])
    words.discard("")
    counter.learn(words)
    assert all(counter.counts[w] == len(other.encode(MARK + w, add_special_tokens=False).ids) for w in words)


@has_vocabularies
def test_rows_odd_texts_and_a_cache_that_starts_anew(spark, odd_docs, monkeypatch):  # noqa: F811
    from linkgap.llm.queries import PIECES, tokenizer_path
    got = count_tokens(odd_docs, tokenizer_path(PIECES))
    rows = got.collect()
    assert len(rows) == odd_docs.count() and got.columns == ["doc_id", "n_words", "n_tokens"]
    assert all(r.n_tokens >= r.n_words >= 0 for r in rows) and {(r.n_words, r.n_tokens) for r in rows if r.doc_id in (0, 1, 2)} == {(0, 0)}
    assert count_tokens(odd_docs.limit(0), tokenizer_path(PIECES)).count() == 0
    scores = zipf_scores(tokenizer_path(PIECES))
    whole = TrieCounter(scores)
    monkeypatch.setattr(token_counts, "CACHE_WORDS", 3)
    small = TrieCounter(scores)
    texts = [f"w{i} same words again {i}" for i in range(30)]
    words, tokens = whole.of(pa.array(texts))
    assert [tuple(int(x[0]) for x in small.of(pa.array([t]))) for t in texts] == list(zip(words.tolist(), tokens.tolist()))
