"""Token counts by separator scan of flat, unindexed token files.

A flat file is token ids and nothing else, each document followed by an end-of-document id, in
ascending doc_id order; it is stored as blocks of equal size that cut documents anywhere, one row a
block of a Parquet container, so that any store Spark reaches can hold it.  Each block is searched for the
end id at once; a prefix scan over the blocks' summaries (tokens, ends, place of the last end)
gives every block its place, the number of documents before it, and where its first document
began, perhaps many blocks earlier.  The scan runs per file and then over the files, so no task
sees more summaries than one file has blocks, or than there are files.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from factline.llm._common import small_batches
from factline.llm.tokens import Encoder, id_type

BLOCK_TOKENS = 1 << 20
LEVEL = 6
_FLAT = "file long, block long, data binary"


def _flatten(block_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, block, rest = TaskContext.get().partitionId(), 0, b""
        size = 4 * block_tokens

        def row(data: bytes) -> pa.RecordBatch:
            nonlocal block
            block += 1
            return pa.RecordBatch.from_arrays([pa.array([file], pa.int64()), pa.array([block - 1], pa.int64()), pa.array([data], pa.binary())], ["file", "block", "data"])

        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                rest += b"".join(batch.column(0).slice(at, 1024).to_pylist())
                cut = len(rest) // size * size
                for k in range(0, cut, size):
                    yield row(rest[k : k + size])
                rest = rest[cut:]
        if rest:
            yield row(rest)

    return run


def write_flat(tokens: DataFrame, path: str, block_tokens: int = BLOCK_TOKENS) -> None:
    """Writes the ids of ``tokens`` (doc_id, ids: little-endian uint32, each with its end id) in ascending doc_id order."""
    ordered = tokens.select("doc_id", "ids").repartitionByRange("doc_id").sortWithinPartitions("doc_id").select("ids")
    ordered.mapInArrow(_flatten(block_tokens), _FLAT).write.option("compression", "uncompressed").parquet(path)


def _squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, print, text) with the texts compressed one by one, for the way to their place."""
    pack = zstandard.ZstdCompressor(level=LEVEL).compress
    for batch in batches:
        packed = pa.array([pack((t or "").encode("utf-8")) for t in batch.column(2).to_pylist()], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), packed], ["doc_id", "print", "packed"])


def _tokenize(path: str, end_id: int, dtype: str, block_tokens: int):
    """(doc_id, packed text) -> blocks of a flat file, and beside them the order of its documents."""
    schema = pa.schema([("file", pa.int64()), ("block", pa.int64()), ("data", pa.binary()), ("docs", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, file, block, lists, rest = Encoder.of(path), TaskContext.get().partitionId(), 0, 0, b""
        unpack = zstandard.ZstdDecompressor().decompress
        size = np.dtype(dtype).itemsize * block_tokens
        row = lambda k, data, docs: pa.RecordBatch.from_pylist([{"file": file, "block": k, "data": data, "docs": docs}], schema)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                ids = encoder.encode([unpack(t).decode("utf-8") for t in part.column(1).to_pylist()])
                rest += b"".join(np.append(x, np.uint32(end_id)).astype(dtype).tobytes() for x in ids)
                yield row(lists, None, part.column(0).to_pylist())
                lists += 1
                cut = len(rest) // size * size
                for k in range(0, cut, size):
                    yield row(block, rest[k : k + size], None)
                    block += 1
                rest = rest[cut:]
        if rest:
            yield row(block, rest, None)

    return run


def tokenize_flat(documents: DataFrame, tokenizer: str, end_id: int, path: str, block_tokens: int = BLOCK_TOKENS) -> str:
    """Writes whole texts (null: empty) as flat files, one a task, in ascending order of doc_id.

    Rows without a doc_id come first; rows of one doc_id follow each other by their text's hash.  So
    the files say the same however the table was split.  They have no index; which document stands
    where in the order is kept in rows of their own (docs) for whoever wants names.  Texts travel to
    their place in the order compressed, as Spark's own compression of a shuffle leaves them twice as
    large as the files.  Returns the type of the ids."""
    dtype = id_type(tokenizer)
    text = F.col("text").cast("string")
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("print"), text.alias("text"))
    by = (F.col("doc_id").asc_nulls_first(), F.col("print").asc())
    with small_batches(documents.sparkSession):
        packed = docs.mapInArrow(_squeeze, "doc_id long, print long, packed binary")
        ordered = packed.repartitionByRange(*by).sortWithinPartitions(*by).select("doc_id", "packed")
        files = ordered.mapInArrow(_tokenize(tokenizer, end_id, dtype, block_tokens), f"{_FLAT}, docs array<long>")
        files.write.option("compression", "zstd").option("parquet.compression.codec.zstd.level", LEVEL).parquet(path)
    return dtype


def document_order(flat: DataFrame) -> DataFrame:
    """doc_id, ordinal of every document of the files that tokenize_flat wrote."""
    lists = flat.filter("docs is not null").select("file", "block", "docs")
    n = lists.select("file", "block", F.size("docs").cast("long").alias("n"))
    upto = lambda w: w.rowsBetween(W.unboundedPreceding, -1)
    inside = n.withColumn("inside", F.coalesce(F.sum("n").over(upto(W.partitionBy("file").orderBy("block"))), F.lit(0)))
    files = n.groupBy("file").agg(F.sum("n").alias("f_n"))  # one row a file
    files = files.withColumn("before", F.coalesce(F.sum("f_n").over(upto(W.orderBy("file"))), F.lit(0)))
    first = inside.join(files, "file").select("file", "block", (F.col("before") + F.col("inside")).alias("first"))
    each = lists.join(first, ["file", "block"]).select("first", F.posexplode("docs").alias("k", "doc_id"))
    return each.select("doc_id", (F.col("first") + F.col("k")).alias("ordinal"))


def _scan(end_id: int, dtype: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                ids = np.frombuffer(batch.column(2)[row].as_py(), dtype)
                at = np.flatnonzero(ids == end_id)
                last = int(at[-1]) if len(at) else None
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, 1), batch.column(1).slice(row, 1), pa.array([len(ids)], pa.int64()), pa.array([len(at)], pa.int64()), pa.array([last], pa.int64()), pa.array([at.astype(np.int32).tobytes()], pa.binary())],
                    ["file", "block", "n", "ends", "last", "at"],
                )

    return run


def _lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, ordinal, began, at in zip(*(batch.column(i) for i in range(4)), strict=True):
            at = np.frombuffer(at.as_py(), np.int32) + np.int64(first.as_py())
            start = np.r_[np.int64(began.as_py()), at[:-1] + 1]
            n = len(at)
            yield pa.RecordBatch.from_arrays([pa.array(ordinal.as_py() + np.arange(n)), pa.array(start), pa.array(at + 1 - start), pa.array([True] * n)], ["ordinal", "start", "n_tokens", "closed"])


def count_tokens(flat: DataFrame, end_id: int, dtype: str = "<u4") -> DataFrame:
    """ordinal, start, n_tokens (with the end id), closed: one row a document of a flat file (file, block, data).

    Tokens after the last end id make up one more document with closed = false.  Files and
    blocks are taken in their order; a document may run over any number of them.  An empty
    file gives no rows.  ``flat`` is scanned twice: once for the summaries, once for the places."""
    found = flat.select("file", "block", "data").mapInArrow(_scan(end_id, dtype), "file long, block long, n long, ends long, last long, at binary")
    s = found.select("file", "block", "n", "ends", "last")
    inside, over = W.partitionBy("file").orderBy("block"), W.orderBy("file")
    upto = lambda w: w.rowsBetween(W.unboundedPreceding, -1)
    s = s.withColumn("first", F.coalesce(F.sum("n").over(upto(inside)), F.lit(0))).withColumn("before", F.coalesce(F.sum("ends").over(upto(inside)), F.lit(0)))
    s = s.withColumn("open", F.max(F.col("first") + F.col("last") + 1).over(upto(inside)))
    files = s.groupBy("file").agg(F.sum("n").alias("f_n"), F.sum("ends").alias("f_ends"), F.max(F.col("first") + F.col("last") + 1).alias("f_open"))
    files = files.withColumn("f_first", F.coalesce(F.sum("f_n").over(upto(over)), F.lit(0))).withColumn("f_before", F.coalesce(F.sum("f_ends").over(upto(over)), F.lit(0)))
    files = files.withColumn("f_began", F.coalesce(F.max(F.col("f_first") + F.col("f_open")).over(upto(over)), F.lit(0)))
    places = s.join(files, "file").select(
        "file", "block", (F.col("f_first") + F.col("first")).alias("first"), (F.col("f_before") + F.col("before")).alias("ordinal"), F.coalesce(F.col("f_first") + F.col("open"), "f_began").alias("began")
    )
    schema = "ordinal long, start long, n_tokens long, closed boolean"
    closed = found.filter("ends > 0").select("file", "block", "at").join(places, ["file", "block"]).select("first", "ordinal", "began", "at").mapInArrow(_lengths, schema)
    total = files.agg(F.sum("f_n").alias("n"), F.sum("f_ends").alias("ends"), F.max(F.col("f_first") + F.col("f_open")).alias("began"))
    left = total.select("ends", F.coalesce("began", F.lit(0)).alias("start"), (F.col("n") - F.coalesce("began", F.lit(0))).alias("k")).filter("k > 0")
    return closed.unionByName(left.select(F.col("ends").alias("ordinal"), "start", F.col("k").alias("n_tokens"), F.lit(False).alias("closed")))

