"""Token counts by trie-shared dynamic programming.

A text's pre-tokens are its words (runs without ASCII white space), each with
the vocabulary's word mark before it; its token count is the sum over them. A word's
tokens are those of its best unigram segmentation: the pieces of highest summed
score, fewer pieces on a tie. A task's distinct words are the paths of a trie that it keeps
over its batches. Every node holds its forward score, the best over all pieces that
end at it, computed once when a word first reaches it, and the tokens of that best
segmentation: at a word's end, its count.

The vocabulary file gives the pieces; scores follow Zipf's law over its order
(rank r: log of 1 / (r + 1), normalised), or can be given. A character that no piece covers
counts as its UTF-8 bytes, at 10 below the lowest score.
"""

from __future__ import annotations

import math
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .token_ids import rounds, split_texts

MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: Words in a worker's trie; it starts anew when there are more (two to four nodes a word, about 300 MB).
CACHE_WORDS = 1_000_000
_SPACES = bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")


def zipf_scores(path: str) -> dict[str, float]:
    """Piece -> log probability, of the ordinary pieces of a sentencepiece file in its order."""
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=path)
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())
              if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
    norm = math.log(sum(1 / (r + 1) for r in range(len(pieces))))
    return {p: -math.log(r + 1) - norm for r, p in enumerate(pieces)}


class TrieCounter:
    """Counts tokens of words, sharing the forward scores of their prefixes."""

    def __init__(self, scores: dict[str, float]):
        # every end of a piece -> the piece's score, or None if it is only the end of longer ones:
        # going back from a character, the first end that is missing ends the search
        self.ends: dict[str, float | None] = {}
        for p in scores:
            for k in range(len(p)):
                self.ends.setdefault(p[k:])
        self.ends.update(scores)
        self.unknown = min(scores.values(), default=0.0) - UNKNOWN_PENALTY
        self.clear()

    def clear(self) -> None:
        """An empty trie: the root, with nothing before it."""
        self.child: dict[int, int] = {}  # node and next character -> node
        self.forward, self.tokens = array("d", [0.0]), array("q", [0])
        self.counts: dict[str, int] = {"": 0}

    def learn(self, words: list[str] | set[str]) -> None:
        """Puts words into the trie; forward scores of nodes that are there are taken, not computed."""
        ends, unknown, child = self.ends, self.unknown, self.child
        all_forward, all_tokens = self.forward, self.tokens
        # along the path of the word before: its characters, nodes, scores and tokens
        path, nodes, forward, tokens = "", [0], [0.0], [0]
        for word in sorted(words):
            marked = MARK + word
            shared = 0
            for a, b in zip(path, marked):
                if a != b:
                    break
                shared += 1
            del nodes[shared + 1:], forward[shared + 1:], tokens[shared + 1:]
            node = nodes[-1]
            for i in range(shared, len(marked)):
                c = marked[i]
                step = node * 0x110000 + ord(c)
                node = child.get(step)
                if node is None:
                    end = i + 1
                    best, fewest = forward[i] + unknown, tokens[i] + len(c.encode("utf-8", "surrogatepass"))
                    for begin in range(i, -1, -1):
                        try:
                            s = ends[marked[begin:end]]
                        except KeyError:
                            break
                        if s is not None:
                            s += forward[begin]
                            if s > best or s == best and tokens[begin] + 1 < fewest:
                                best, fewest = s, tokens[begin] + 1
                    node = child[step] = len(all_forward)
                    all_forward.append(best)
                    all_tokens.append(fewest)
                    forward.append(best)
                    tokens.append(fewest)
                else:
                    forward.append(all_forward[node])
                    tokens.append(all_tokens[node])
                nodes.append(node)
            path = marked
            self.counts[word] = tokens[-1]

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(words, tokens) of each text."""
        distinct, codes, ends = split_texts(texts, _SPACES)
        words = distinct.to_pylist()
        found = list(map(self.counts.get, words))
        new = [w for w, n in zip(words, found) if n is None]
        if new:
            if len(self.counts) + len(new) > CACHE_WORDS and len(self.counts) > 1:
                self.clear()
                new = words
            self.learn(new)
            found = list(map(self.counts.__getitem__, words))
        if not len(codes):
            return np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        by_code = np.array([[w != "", n] for w, n in zip(words, found)], np.int64)
        sums = np.concatenate([np.zeros((1, 2), np.int64), by_code[codes].cumsum(0)])
        per_text = sums[ends[1:]] - sums[ends[:-1]]
        return per_text[:, 0], per_text[:, 1]


_WORKER: dict[str, TrieCounter] = {}


def _count(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    # one counter per worker process: Spark keeps its Python workers for later tasks
    counter = _WORKER.get(path) or _WORKER.setdefault(path, TrieCounter(zipf_scores(path)))
    for batch in batches:
        for part in rounds(batch, 1):
            words, tokens = counter.of(part.column(1))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(words), pa.array(tokens)],
                                             names=["doc_id", "n_words", "n_tokens"])


def count_tokens(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_tokens`` for every row, over its whole text.

    Null and empty texts count 0; null ids pass through; repeated rows count each; other
    columns are ignored; an empty table gives no rows. One pass, no shuffle.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(lambda it: _count(it, vocabulary_path), "doc_id long, n_words long, n_tokens long")
