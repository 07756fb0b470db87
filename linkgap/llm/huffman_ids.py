"""Token ids as binary files under a canonical, length-limited Huffman code.

Ids are counted over the whole corpus; package-merge gives the best code lengths
of at most ``MAX_BITS`` bits, and the lengths alone (a byte an id) fix the
canonical code. Documents are sorted by id and every sorted partition becomes one
file of independent blocks of whole documents, with the bit offset of every
``STEP``-th token as a checkpoint. A block is decoded by table, all its
checkpoints at once: each step looks up one code per checkpoint.

A folder holds ``_codes`` (code length by id), ``_files.json`` (files in order
with their documents, ids and blocks; written last, so a reader sees a finished
folder or none) and the files. A file is its blocks, then a row (place, bytes, documents, ids) of
64-bit numbers a block, then the number of blocks. A block is four 64-bit numbers
(documents, ids, checkpoints, bytes of code), the documents' ids, whether each has one, their
numbers of ids, the checkpoints and the code, most significant bit first. Numbers
are little-endian.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition,
                                    WriterCommitMessage)

from ..session import new_run_dir
from .token_ids import rounds, worker_ids
from .warc import _open_fs

END_ID = 1
#: Longest code; a vocabulary of more than 2 ** MAX_BITS ids gets the bits it needs.
MAX_BITS = 20
#: Tokens from one checkpoint to the next, and tokens that close a block at a document's end.
STEP, BLOCK = 256, 1 << 18
#: Blocks of a reading task.
TASK_BLOCKS = 32
SCHEMA = "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary"


# -- the code -----------------------------------------------------------------

def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Code length of every id (0: does not occur) by package-merge: no code of at most
    ``max_bits`` bits has a smaller total. Ties go to the smaller id."""
    present = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    n = len(present)
    if n < 2:
        lengths[present] = 1
        return lengths
    max_bits = max(max_bits, (n - 1).bit_length())
    order = present[np.argsort(counts[present], kind="stable")]
    leaves = counts[order].astype(np.int64)
    rows, packages = [], np.empty(0, np.int64)
    for _ in range(max_bits):
        merged = np.concatenate([leaves, packages])
        by = np.argsort(merged, kind="stable")  # a leaf before a package of its weight
        rows.append(np.cumsum(by < n))
        merged = merged[by]
        packages = merged[:len(merged) // 2 * 2].reshape(-1, 2).sum(1)
    taken = 2 * n - 2
    for leaves_before in reversed(rows):
        if not taken:
            break
        k = int(leaves_before[taken - 1])
        lengths[order[:k]] += 1
        taken = 2 * (taken - k)
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """The codes: shorter ones first, ids of one length in ascending order, each one more than the last."""
    codes = np.zeros(len(lengths), np.uint64)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    if len(order):
        top = int(lengths.max())
        span = np.uint64(1) << (top - lengths[order]).astype(np.uint64)
        codes[order] = (np.cumsum(span) - span) >> (top - lengths[order]).astype(np.uint64)
    return codes


class Code:
    """Encoder and table decoder of a list of code lengths."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths.astype(np.int64)
        self.codes = canonical_codes(lengths)
        self.bits = int(lengths.max()) if len(lengths) else 0
        order = np.lexsort((np.arange(len(lengths)), lengths))
        order = order[lengths[order] > 0]
        span = 1 << (self.bits - self.lengths[order])
        self.symbol = np.zeros(1 << self.bits, np.uint32)
        self.length = np.ones(1 << self.bits, np.int64)
        used = int(span.sum())  # less than the table if there is a single id
        self.symbol[:used] = np.repeat(order.astype(np.uint32), span)
        self.length[:used] = np.repeat(self.lengths[order], span)

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """(code bytes, bit offset of every ``STEP``-th id)."""
        if not len(ids):
            return b"", np.empty(0, np.int64)
        size = self.lengths[ids]
        if not size.all():
            raise ValueError("an id has no code")
        at = np.cumsum(size) - size
        word, shift = at >> 6, 64 - (at & 63) - size
        code = self.codes[ids]
        inside = shift >= 0
        high = np.where(inside, code << np.maximum(shift, 0).astype(np.uint64), code >> np.maximum(-shift, 0).astype(np.uint64))
        starts = np.concatenate([[0], np.flatnonzero(np.diff(word)) + 1])
        out = np.zeros(int(word[-1]) + 2, np.uint64)
        out[word[starts]] = np.add.reduceat(high, starts)  # bits of different ids never meet: a sum is their union
        over = ~inside
        out[word[over] + 1] |= code[over] << (64 + shift[over]).astype(np.uint64)
        total = int(at[-1] + size[-1])
        return out.astype(">u8").tobytes()[:-(-total // 8)], at[::STEP]

    def decode(self, data: bytes, checkpoints: np.ndarray, n: int) -> np.ndarray:
        """``n`` ids, from all checkpoints in step."""
        if not n:
            return np.empty(0, np.uint32)
        pad = np.frombuffer(data + bytes(STEP * 4 + 8), np.uint8).astype(np.uint32)
        window = pad[:-3] << 24 | pad[1:-2] << 16 | pad[2:-1] << 8 | pad[3:]
        out = np.empty((min(STEP, n), len(checkpoints)), np.uint32)
        at, drop = checkpoints.astype(np.int64), np.uint32(32 - self.bits)
        for step in range(len(out)):  # the last run may be shorter: what it reads beyond is cut off
            entry = window[at >> 3] << (at & 7).astype(np.uint32) >> drop
            out[step] = self.symbol[entry]
            at = at + self.length[entry]
            if step % 64 == 63:
                np.minimum(at, 8 * (len(window) - 1) - 64 * 32, out=at)
        return out.T.ravel()[:n]


# -- blocks -------------------------------------------------------------------

def write_block(code: Code, doc_ids: list[int | None], sizes: list[int], ids: np.ndarray) -> bytes:
    data, checkpoints = code.encode(ids)
    head = np.array([len(doc_ids), len(ids), len(checkpoints), len(data)], "<u8")
    return b"".join([head.tobytes(), np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
                     np.array([d is not None for d in doc_ids], "u1").tobytes(), np.array(sizes, "<u8").tobytes(),
                     checkpoints.astype("<u8").tobytes(), data])


def read_block(code: Code, block: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document ids, whether each has one, numbers of ids, ids)."""
    docs, n, marks, size = np.frombuffer(block, "<u8", 4).tolist()
    at = 32
    doc_ids = np.frombuffer(block, "<i8", docs, at)
    known = np.frombuffer(block, "u1", docs, at := at + 8 * docs)
    sizes = np.frombuffer(block, "<u8", docs, at := at + docs)
    checkpoints = np.frombuffer(block, "<u8", marks, at := at + 8 * docs)
    at += 8 * marks
    if at + size != len(block):
        raise ValueError("a block is cut short")
    return doc_ids, known.astype(bool), sizes.astype(np.int64), code.decode(block[at:], checkpoints, n)


# -- the data source ----------------------------------------------------------

@dataclass
class Written(WriterCommitMessage):
    part: int
    name: str
    docs: int
    tokens: int
    blocks: int


def _read(path: str, name: str) -> bytes:
    system, base = _open_fs(path)
    with system.open_input_file(f"{base}/{name}") as f:
        return f.read()


def _write(path: str, name: str, data: bytes) -> None:
    system, base = _open_fs(path)
    system.create_dir(base, recursive=True)
    with system.open_output_stream(f"{base}/{name}") as f:
        f.write(data)


class HuffmanWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path, self.width = options["path"], int(options.get("idbytes", 4))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        """One file of the partition's rows (doc_id, ids) in their order. A file of a failed attempt is not listed."""
        code = Code(np.frombuffer(_read(self.path, "_codes"), np.uint8))
        part = TaskContext.get().partitionId()
        out = Written(part, f"part-{part:06d}-{uuid.uuid4().hex[:8]}.huf", 0, 0, 0)
        system, base = _open_fs(self.path)
        doc_ids, held, n, at, index = [], [], 0, 0, []
        with system.open_output_stream(f"{base}/{out.name}") as f:
            def close() -> None:
                nonlocal n, at
                if doc_ids:
                    sizes = [len(h) // self.width for h in held]
                    block = write_block(code, doc_ids, sizes, np.frombuffer(b"".join(held), f"<u{self.width}"))
                    f.write(block)
                    index.append((at, len(block), len(doc_ids), n))
                    at += len(block)
                    out.docs, out.tokens, out.blocks = out.docs + len(doc_ids), out.tokens + n, out.blocks + 1
                    doc_ids.clear()
                    held.clear()
                    n = 0
            for batch in iterator:
                for doc_id, ids in zip(batch.column(0).to_pylist(), batch.column(1)):
                    doc_ids.append(doc_id)
                    held.append(ids.as_py())
                    n += len(held[-1]) // self.width
                    if n >= BLOCK:
                        close()
            close()
            f.write(np.array(index, "<u8").tobytes() + np.array([len(index)], "<u8").tobytes())
        return out

    def commit(self, messages: list[Written | None]) -> None:
        files = sorted((vars(m) for m in messages if m is not None and m.docs), key=lambda m: m["part"])
        _write(self.path, "_files.json", json.dumps(files).encode())

    def abort(self, messages: list[Written | None]) -> None:
        """Nothing to undo: files that the list does not name are not read."""


class Blocks(InputPartition):
    """Blocks ``first`` to ``last`` of a file whose ids begin at ``start``."""

    def __init__(self, name: str, start: int, first: int, last: int):
        super().__init__((name, start, first, last))


class HuffmanReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.full = options["path"], options.get("ids", "full") == "full"

    def partitions(self) -> list[InputPartition]:
        """Some ``TASK_BLOCKS`` blocks of a file each: one entry a file reaches the driver."""
        out, start = [], 0
        for f in json.loads(_read(self.path, "_files.json")):
            out += [Blocks(f["name"], start, k, min(k + TASK_BLOCKS, f["blocks"])) for k in range(0, f["blocks"], TASK_BLOCKS)]
            start += f["tokens"]
        return out or [Blocks("", 0, 0, 0)]

    def read(self, partition: Blocks) -> Iterator[pa.RecordBatch]:
        name, start, first, last = partition.value
        if not name:
            return
        code = Code(np.frombuffer(_read(self.path, "_codes"), np.uint8))
        system, base = _open_fs(self.path)
        with system.open_input_file(f"{base}/{name}") as f:
            size = f.size()
            f.seek(size - 8)
            n = int(np.frombuffer(f.read(8), "<u8")[0])
            f.seek(size - 8 - 32 * n)
            index = np.frombuffer(f.read(32 * n), "<u8").reshape(n, 4).astype(np.int64)
            start += int(index[:first, 3].sum())
            for at, length, _, tokens in index[first:last].tolist():
                f.seek(at)
                doc_ids, known, sizes, ids = read_block(code, f.read(length))
                edges = np.concatenate([[0], np.cumsum(sizes)])
                if edges[-1] != tokens or len(ids) != tokens:
                    raise ValueError(f"a block of {name} holds other ids than its file lists")
                view = memoryview(ids.astype("<u4")).cast("B")
                runs = [view[4 * a:4 * b] for a, b in zip(edges.tolist(), edges[1:].tolist())]
                yield pa.RecordBatch.from_arrays([
                    pa.array(doc_ids, pa.int64(), mask=~known), pa.array(start + edges[:-1]), pa.array(sizes),
                    pa.array([zlib.crc32(r) for r in runs], pa.int64()),
                    pa.array([bytes(r) for r in runs] if self.full else [None] * len(runs), pa.binary())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"])
                start += tokens


class HuffmanDataSource(DataSource):
    """``spark.read.format("huffman_ids").load(path)``: documents in order. Option ``ids``: full, or
    digest (the ids themselves stay null). Writing takes rows (doc_id, ids) in order."""

    @classmethod
    def name(cls) -> str:
        return "huffman_ids"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> HuffmanReader:
        return HuffmanReader(self.options)

    def writer(self, schema, overwrite: bool) -> HuffmanWriter:
        return HuffmanWriter(self.options)


# -- the operator -------------------------------------------------------------

def id_width(vocabulary: int) -> int:
    """Bytes of an id between the passes."""
    return 2 if vocabulary <= 1 << 16 else 4


def _tokens(path: str, end_id: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker = worker_ids(path)
        kind = f"<u{id_width(len(worker.ends))}"
        end = b"" if end_id is None else np.array([end_id], kind).tobytes()
        for batch in batches:
            for part in rounds(batch, 1):
                ids, at = worker.of(part.column(1))
                ids = ids.astype(kind)
                runs = [ids[a:b].tobytes() + end for a, b in zip(at.tolist(), at[1:].tolist())]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(runs, pa.binary())], names=["doc_id", "ids"])
    return run


def _counts(kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                found = np.bincount(np.frombuffer(b"".join(batch.column(0).slice(at, 1000).to_pylist()), kind), minlength=len(total))
                found[:len(total)] += total
                total = found
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(total[ids], pa.int64())], names=["id", "n"])
    return run


def write_ids(docs: DataFrame, path: str, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
              end_id: int | None = END_ID, max_bits: int = MAX_BITS) -> np.ndarray:
    """Writes the ids of every whole text of ``docs``, each with the end id behind it (none if
    null), under ``path`` in ascending id order; returns the code lengths.

    A null text is empty. Null ids come first; rows that share an id are ordered by their token ids, and equal ones
    are each kept. Other columns are ignored, whatever their names. An empty table gives a folder
    without files, which reads as no rows. The ids (no texts) are stored once between the passes. The driver
    sees one count per id of the vocabulary and one entry per file.
    """
    spark = docs.sparkSession
    width = id_width(len(worker_ids(tokenizer_path).ends))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = new_run_dir(spark, "token-ids")
    rows.mapInArrow(_tokens(tokenizer_path, end_id), "doc_id long, ids binary").write.option("compression", "zstd").parquet(out)
    tokens = spark.read.schema("doc_id long, ids binary").parquet(out)
    # bounded by the vocabulary
    found = tokens.select("ids").mapInArrow(_counts(f"<u{width}"), "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(max([r["id"] for r in found], default=-1) + 1, np.int64)
    counts[[r["id"] for r in found]] = [r["n"] for r in found]
    lengths = code_lengths(counts, max_bits)
    _write(path, "_codes", lengths.tobytes())
    # the row number parts rows that repeat wholly, so a hot id is sorted by many tasks
    ordered = (tokens.withColumn("copy", F.monotonically_increasing_id())
               .orderBy(F.col("doc_id").asc_nulls_first(), F.xxhash64("ids"), "copy").select("doc_id", "ids"))
    spark.dataSource.register(HuffmanDataSource)
    ordered.write.format("huffman_ids").option("idbytes", width).mode("append").save(path)
    return lengths


def read_ids(spark: SparkSession, path: str, ids: str = "full") -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32, ids`` (little-endian 32-bit numbers) of the documents under ``path``."""
    spark.dataSource.register(HuffmanDataSource)
    return spark.read.format("huffman_ids").option("ids", ids).load(path)
