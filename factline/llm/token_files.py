"""Token-id files coded by a static range asymmetric numeral system (rANS).

A file is a folder of self-contained blocks in ascending doc_id order, one row each in a
Parquet container, so any store that Spark reaches can hold it and a lost executor leaves no
half-written block.  All blocks share one frequency table, counted over the whole corpus and
kept beside them.  A block holds whole documents: their ids and lengths, the ids' code words,
the coder's states, and checkpoints.  Token t of a block belongs to lane t mod K, so a decoder
works on K tokens at once; a checkpoint (states and word position every INTERVAL steps) lets
several decoders share a block.  Table and blocks end in a CRC-32.

Block layout, little endian: magic 4s, then 7 uint32 (documents, tokens, lanes, interval, words,
checkpoints, CRC of the table), doc_ids int64, a byte each for null doc_ids, lengths int64,
states uint64[lanes], checkpoint positions uint32, checkpoint states uint64[checkpoints, lanes],
words uint32, CRC uint32.  Table: magic 4s, scale uint32, symbols uint32, symbol ids uint32,
frequencies uint32, CRC uint32.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from factline.llm._common import release, stage
from factline.llm.tokens import encode_documents, id_type

LANES = 1024
INTERVAL = 256
BLOCK_TOKENS = 1 << 20
_LOW = np.uint64(1 << 31)
_MASK32 = np.uint64(0xFFFFFFFF)
_HEAD = "<4s7I"


class CorruptBlock(ValueError):
    pass


# --- frequency table ---------------------------------------------------------------------


def make_table(symbols: np.ndarray, counts: np.ndarray) -> bytes:
    """Frequencies in proportion to the counts, each at least 1, that sum to a power of two."""
    order = np.argsort(symbols)
    symbols, counts = symbols[order].astype(np.uint32), counts[order].astype(np.float64)
    scale = max(12, min(22, int(2 * max(1, len(symbols)) - 1).bit_length() + 1))
    total = 1 << scale
    freq = np.maximum(1, np.floor(counts / max(1.0, counts.sum()) * total)).astype(np.int64)
    if len(freq):
        largest = np.argsort(-freq, kind="stable")
        freq[largest[0]] += max(0, total - freq.sum())
        for k in largest:
            if (over := int(freq.sum()) - total) <= 0:
                break
            freq[k] -= min(over, int(freq[k]) - 1)
    body = struct.pack("<4s2I", b"FRQ1", scale, len(symbols)) + symbols.tobytes() + freq.astype(np.uint32).tobytes()
    return body + struct.pack("<I", zlib.crc32(body))


class Table:
    def __init__(self, data: bytes):
        if data[:4] != b"FRQ1" or zlib.crc32(data[:-4]) != struct.unpack("<I", data[-4:])[0]:
            raise CorruptBlock("frequency table")
        _, self.scale, n = struct.unpack_from("<4s2I", data)
        self.crc = struct.unpack("<I", data[-4:])[0]
        self.symbols = np.frombuffer(data, np.uint32, n, 12)
        freq = np.frombuffer(data, np.uint32, n, 12 + 4 * n)
        size = int(self.symbols.max()) + 1 if n else 1
        self.freq, self.start = np.zeros(size, np.uint64), np.zeros(size, np.uint64)
        self.freq[self.symbols] = freq
        self.start[self.symbols] = np.cumsum(freq, dtype=np.uint64) - freq
        self.slot = np.repeat(self.symbols, freq)  # slot -> symbol


# --- blocks ------------------------------------------------------------------------------


def encode_block(doc_ids: list[int | None], lengths: np.ndarray, tokens: np.ndarray, table: Table) -> bytes:
    n = len(tokens)
    lanes = int(min(LANES, max(1, n // INTERVAL)))
    steps = -(-n // lanes)
    x = np.full(lanes, _LOW, np.uint64)
    scale, top = np.uint64(table.scale), np.uint64(31 - table.scale + 32)
    f_all, c_all = table.freq[tokens], table.start[tokens]
    out: list[np.ndarray] = []
    marks: list[np.ndarray] = []
    for s in range(steps - 1, -1, -1):
        f, c = f_all[s * lanes : (s + 1) * lanes], c_all[s * lanes : (s + 1) * lanes]
        y = x[: len(f)]
        full = y >= (f << top)
        out.append((y[full] & _MASK32).astype(np.uint32))
        y = np.where(full, y >> np.uint64(32), y)
        q = y // f
        x[: len(f)] = (q << scale) + (y - q * f) + c
        if s and s % INTERVAL == 0:
            marks.append(x.copy())
    out.reverse(), marks.reverse()
    sizes = np.r_[0, np.cumsum([len(w) for w in out])].astype(np.uint32)
    at = sizes[np.arange(1, len(marks) + 1) * INTERVAL] if marks else np.zeros(0, np.uint32)
    words = np.concatenate(out) if out else np.zeros(0, np.uint32)
    body = b"".join([
        struct.pack(_HEAD, b"RNS1", len(lengths), n, lanes, INTERVAL, len(words), len(marks), table.crc),
        np.array([d or 0 for d in doc_ids], np.int64).tobytes(), np.array([d is None for d in doc_ids], np.uint8).tobytes(), lengths.astype(np.int64).tobytes(),
        x.tobytes(), at.astype(np.uint32).tobytes(), b"".join(m.tobytes() for m in marks), words.tobytes(),
    ])
    return body + struct.pack("<I", zlib.crc32(body))


def _decode(words: np.ndarray, x: np.ndarray, first: int, last: int, n: int, table: Table) -> np.ndarray:
    """Tokens of the steps [first, last) from the states before them."""
    lanes, x, at = len(x), x.copy(), 0
    scale, mask = np.uint64(table.scale), np.uint64((1 << table.scale) - 1)
    out = np.empty(max(0, min(n, last * lanes) - first * lanes), np.uint32)
    for s in range(first, last):
        m = min(lanes, n - s * lanes)
        y = x[:m]
        slot = y & mask
        symbol = table.slot[slot]
        y = table.freq[symbol] * (y >> scale) + slot - table.start[symbol]
        short = np.flatnonzero(y < _LOW)
        y[short] = (y[short] << np.uint64(32)) | words[at : at + len(short)]
        at += len(short)
        x[:m] = y
        out[(s - first) * lanes : (s - first) * lanes + m] = symbol
    return out


class Block:
    """A parsed block; raises CorruptBlock if the checksum or the table doesn't fit."""

    def __init__(self, data: bytes, table: Table):
        if data[:4] != b"RNS1" or zlib.crc32(data[:-4]) != struct.unpack("<I", data[-4:])[0]:
            raise CorruptBlock("block checksum")
        _, docs, self.n, self.lanes, self.interval, words, marks, crc = struct.unpack_from(_HEAD, data)
        if crc != table.crc:
            raise CorruptBlock("block of another table")
        self.table, at = table, struct.calcsize(_HEAD)

        def take(dtype, count):
            nonlocal at
            x = np.frombuffer(data, dtype, count, at)
            at += x.nbytes
            return x

        ids, null = take(np.int64, docs), take(np.uint8, docs)
        self.doc_ids = [None if z else int(i) for i, z in zip(ids, null, strict=True)]
        self.lengths = take(np.int64, docs)
        self.states = take(np.uint64, self.lanes)
        self.at = take(np.uint32, marks)
        self.marks = take(np.uint64, marks * self.lanes).reshape(marks, self.lanes)
        self.words = take(np.uint32, words)

    def sections(self) -> int:
        return len(self.at) + 1

    def decode(self, section: int | None = None) -> np.ndarray:
        """All tokens, or those between two checkpoints."""
        steps = -(-self.n // self.lanes)
        if section is None:
            return _decode(self.words, self.states, 0, steps, self.n, self.table)
        state, at = (self.marks[section - 1], int(self.at[section - 1])) if section else (self.states, 0)
        return _decode(self.words[at:], state, section * self.interval, min(steps, (section + 1) * self.interval), self.n, self.table)


# --- Spark -------------------------------------------------------------------------------


def _count_tokens(dtype: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 16, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                ids = np.frombuffer(b"".join(batch.column(0).slice(at, 1024).to_pylist()), dtype)
                n = np.bincount(ids, minlength=len(total))
                total = np.r_[total, np.zeros(len(n) - len(total), np.int64)] + n if len(n) > len(total) else total + n
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], ["token", "n"])

    return run


def _write(table_bytes: bytes, dtype: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, part, block = Table(table_bytes), TaskContext.get().partitionId(), 0
        docs: list[int | None] = []
        ids: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal block, size
            lengths = np.array([len(x) for x in ids], np.int64)
            data = encode_block(docs, lengths, np.concatenate(ids), table)
            row = pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([block], pa.int64()), pa.array([size], pa.int64()), pa.array([data], pa.binary())], ["part", "block", "n_tokens", "data"])
            docs.clear(), ids.clear()
            block, size = block + 1, 0
            return row

        for batch in batches:
            for d, x in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                docs.append(d)
                ids.append(np.frombuffer(x.as_py(), dtype))
                size += len(ids[-1])
                if size >= BLOCK_TOKENS:
                    yield flush()
        if docs:
            yield flush()

    return run


def _read(table_bytes: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table(table_bytes)
        for batch in batches:
            for part, block, data in zip(*(batch.column(i) for i in range(3)), strict=True):
                b = Block(data.as_py(), table)
                tokens = b.decode().astype("<u4")
                ends = np.cumsum(b.lengths)
                starts = ends - b.lengths
                n = len(ends)
                ids = [tokens[a:e].tobytes() for a, e in zip(starts, ends, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.as_py()] * n, pa.int64()), pa.array([block.as_py()] * n, pa.int64()), pa.array(b.doc_ids, pa.int64()), pa.array(starts), pa.array(b.lengths), pa.array([zlib.crc32(x) for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                    ["part", "block", "doc_id", "at", "n_tokens", "ids_crc32", "ids"],
                )

    return run


def _without_ids(read):
    return lambda batches: (b.select(range(6)) for b in read(batches))


def write_token_file(tokens: DataFrame, path: str, dtype: str = "<u4") -> None:
    """Writes ``tokens`` (doc_id, ids: little-endian ids of ``dtype``) as a file at ``path``.

    Documents with a null doc_id come first; equal doc_ids keep together.  An empty table gives
    a file without blocks.  ``tokens`` is read three times: pass a stored table."""
    spark = tokens.sparkSession
    counts = tokens.select("ids").mapInArrow(_count_tokens(dtype), "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    rows = counts.collect()  # at most one row a vocabulary entry
    table = make_table(np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int64))
    spark.createDataFrame([(bytearray(table),)], "data binary").coalesce(1).write.parquet(f"{path}/table")
    ordered = tokens.select("doc_id", "ids").repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    blocks = ordered.mapInArrow(_write(table, dtype), "part long, block long, n_tokens long, data binary")
    blocks.write.option("compression", "uncompressed").parquet(f"{path}/blocks")


def read_token_file(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """doc_id, start (tokens of all documents before it), n_tokens, ids_crc32, and the ids themselves if asked for."""
    table = bytes(spark.read.schema("data binary").parquet(f"{path}/table").first()[0])
    blocks = spark.read.schema("part long, block long, n_tokens long, data binary").parquet(f"{path}/blocks")
    sizes = blocks.select("part", "block", "n_tokens")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = parts.withColumn("base", F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)))  # one row a partition of the writer
    own = sizes.withColumn("inside", F.sum("n_tokens").over(W.partitionBy("part").orderBy("block").rowsBetween(W.unboundedPreceding, -1)))
    first = own.join(before, "part").select("part", "block", (F.coalesce("base", F.lit(0)) + F.coalesce("inside", F.lit(0))).alias("first"))
    schema = "part long, block long, doc_id long, at long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids
    read = _read(table)
    rows = blocks.select("part", "block", "data").mapInArrow(read if with_ids else _without_ids(read), schema)
    joined = rows.join(first, ["part", "block"])
    return joined.select("doc_id", (F.col("first") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)


def encode_corpus(documents: DataFrame, tokenizer: str, path: str, end_id: int = 0) -> None:
    """Tokenizes whole texts (null: empty), adds ``end_id`` to each document, writes the file."""
    dtype = id_type(tokenizer)
    tokens = stage(encode_documents(documents, tokenizer, end_id, dtype), "tokens")
    release()
    write_token_file(tokens, path, dtype)
    release()
