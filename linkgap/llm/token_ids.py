"""Token ids of whole texts, a batch at a time.

The vocabulary drops white space and no rule of it reaches across a space, so
a text's ids are those of its chunks between spaces in a row. A batch's chunks
are told apart by dictionary encoding, the distinct ones are parted into a word
of plain letters (in lower case) and the marks after it (the vocabulary tokenises
letters and marks apart), and only words not met before are tokenised. The ids of
all occurrences are then gathered from those of the distinct chunks.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Entries of each of the two generations of a worker's word cache (together about 80 MB).
CACHE_WORDS = 200_000
#: Bytes of text that one round takes (a longer text is a round of its own).
ROUND_BYTES = 3 << 20
_SPACES = bytes.maketrans(b"\n\t\r", b"   ")
#: A word of plain letters and marks after it; the apostrophe begins the vocabulary's own endings and is none of them.
_PLAIN = "^(?P<word>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<tail>[!-&(-/:-@\\[-`{-~]*)$"
_JOIN = 256


def gather(pool: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs ``pool[start:start + length]`` one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return pool[np.repeat(starts - (ends - lengths), lengths) + np.arange(total)]


def split_texts(texts: pa.Array, table: bytes) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct chunks, code of every chunk in order, offsets by text): the texts' chunks between
    spaces, after their bytes went through ``table`` (which maps ASCII to ASCII). Null is empty; runs of spaces hold empty chunks."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return pa.array([], pa.large_string()), np.empty(0, np.int64), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, 8 * texts.offset)
    data = texts.buffers()[2]
    data = b"" if data is None else data.slice(int(offsets[0]), int(offsets[-1] - offsets[0])).to_pybytes().translate(table)
    clean = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(offsets - offsets[0]), pa.py_buffer(data))
    split = pc.split_pattern(clean, " ")
    coded = split.flatten().dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(), split.offsets.to_numpy().astype(np.int64)


class TokenIds:
    """Ids under the tokenizer file ``path``, with a bounded cache of words."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks use the cores
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for token, i in vocab.items() if token.endswith("</w>")]] = True

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of words of plain lower-case letters. Unknown ones are tokenised joined by
        spaces and their ids parted at the tokens that end a word."""
        found = list(map(self.cache.get, words))
        new = []
        for k, ids in enumerate(found):
            if ids is None:
                ids = self.older.get(words[k])
                if ids is None:
                    new.append(k)
                else:
                    found[k] = self.cache[words[k]] = ids
        groups = [new[i:i + _JOIN] for i in range(0, len(new), _JOIN)]
        for group, ids in zip(groups, self._encode([" ".join([words[k] for k in g]) for g in groups])):
            data, at = ids.tobytes(), 0
            for k, stop in zip(group, (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()):
                found[k] = self.cache[words[k]] = data[at:stop]
                at = stop
        if len(self.cache) > CACHE_WORDS:  # what is not asked for again in a generation goes
            self.cache, self.older = {}, self.cache
        return found

    def _chunks(self, chunks: pa.StringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pool, starts, lengths): the ids of distinct chunks."""
        parts = pc.extract_regex(chunks, _PLAIN)
        plain = pc.is_valid(parts).to_numpy(zero_copy_only=False)
        words = pc.utf8_lower(parts.field("word").filter(pa.array(plain))).dictionary_encode()
        tails = parts.field("tail").filter(pa.array(plain)).dictionary_encode()
        other = chunks.filter(pa.array(~plain)).to_pylist()
        runs = self._words(words.dictionary.to_pylist())
        apart = self._encode(tails.dictionary.to_pylist() + other)
        sizes = np.array([len(r) // 4 for r in runs] + [len(a) for a in apart], np.int64)
        pool = np.concatenate([np.frombuffer(b"".join(runs), "<u4"), *apart])
        at = np.cumsum(sizes) - sizes
        first, n_tails = len(runs), len(tails.dictionary)
        # two runs a chunk: its word and its tail; any other chunk and nothing
        one, two = np.empty(len(chunks), np.int64), np.zeros(len(chunks), np.int64)
        one[plain] = words.indices.to_numpy()
        one[~plain] = np.arange(len(other)) + first + n_tails
        two[plain] = tails.indices.to_numpy() + first
        starts = np.stack([at[one], at[two]], 1)
        lengths = np.stack([sizes[one], np.where(plain, sizes[two], 0)], 1)
        flat = gather(pool, starts.ravel(), lengths.ravel())
        whole = lengths.sum(1)
        return flat, np.cumsum(whole) - whole, whole

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets): text ``k`` has ``ids[offsets[k]:offsets[k + 1]]``. Null is empty."""
        distinct, codes, ends = split_texts(texts, _SPACES)
        if not len(codes):
            return np.empty(0, "<u4"), np.zeros(len(texts) + 1, np.int64)
        pool, starts, lengths = self._chunks(distinct.cast(pa.string()))
        sizes = lengths[codes]
        return gather(pool, starts[codes], sizes), np.concatenate([[0], np.cumsum(sizes)])[ends]


def rounds(batch: pa.RecordBatch, column: int, size: int | None = None) -> Iterator[pa.RecordBatch]:
    """``batch`` cut into runs of rows with about ``size`` bytes of text (``ROUND_BYTES`` if not given)."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy().astype(np.int64)
    cut = np.flatnonzero(np.diff((np.cumsum(sizes) - 1) // (size or ROUND_BYTES))) + 1
    edges = [0, *cut.tolist(), batch.num_rows]
    for low, high in zip(edges, edges[1:]):
        if high > low:
            yield batch.slice(low, high - low)


_WORKER: dict[str, TokenIds] = {}


def worker_ids(path: str) -> TokenIds:
    """One cache per worker process: Spark keeps its Python workers for later tasks."""
    return _WORKER.get(path) or _WORKER.setdefault(path, TokenIds(path))
