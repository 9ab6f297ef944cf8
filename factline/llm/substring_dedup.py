"""Substring dedup by fixed-block anchors.

Non-overlapping reference blocks of ``(window + 1) // 2`` words, at multiples of that length
in every document, are indexed; every rolling window of the same length probes the index.
Any run of ``window`` words contains a whole reference block, so no repeat is missed.  Around
the anchors that hit, the runs of ``window`` words are looked up by a 64-bit fingerprint; runs
that touch make up the maximal exact repeats, which are removed from all documents but the one
with the smallest id.

Index, probes and replies travel packed: a row holds the sorted fingerprints that one group of
documents sends to one bucket of the fingerprint space, each value once however many documents
of the group have it, so a passage that a third of all documents share is one entry a group.
A group's texts are brought together before each of these steps: it sends a bucket one row, however
its documents lie in the input, so rows are at most groups times buckets.
Groups and buckets grow in number with the input.  Their size is TARGET_BYTES, and beyond some 2 TB
grows with the square root of the input, so that a packet keeps PACKET_BYTES of text on average and
rows stay few: 160 MB a group for 100 TB.  Fingerprints have 64 bits: a window is taken for
another's copy with a chance of about (windows^2 / 2^64).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factline.llm._common import NOT_SPACE, chunks, discard, hash_spans, hash_windows, owners, release, stage, utf8, word_spans

TARGET_BYTES = 24 << 20
#: Text behind the rows that one group sends to one bucket, at least, on average.
PACKET_BYTES = 256
_FRAGMENT = 30


def layout(size: int) -> tuple[int, int]:
    """Groups and bits of the bucket number, for so many bytes of text."""
    target = max(TARGET_BYTES, isqrt(size * PACKET_BYTES))
    n = max(8, -(-size // target))
    bits = max(3, (n - 1).bit_length())
    assert bits + _FRAGMENT <= 64 and n < 1 << 31, "fingerprints and group numbers are too short for this input"
    return n, bits


class _Words:
    """Word spans and hashes of a chunk of documents."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.starts, self.ends, self.first = word_spans(data, offsets, NOT_SPACE)
        self.hash = hash_spans(data, self.starts, self.ends)
        self.doc = owners(self.first)

    def windows(self, k: int, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Hashes and first words of all windows of k words inside one document."""
        h = hash_windows(self.hash, k, salt)
        at = np.flatnonzero(self.doc[: len(h)] == self.doc[k - 1 : k - 1 + len(h)]) if len(h) else np.zeros(0, np.int64)
        return h[at], at


def _short(h: np.ndarray, bits: int) -> np.ndarray:
    return h >> np.uint64(64 - bits - _FRAGMENT)


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Where each run of equal rows begins."""
    if not len(columns[0]):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.r_[True, np.logical_or.reduce([x[1:] != x[:-1] for x in columns])])


def _probes(block: int, bits: int):
    """One group's texts -> packed anchors, a row a bucket: uint32 of 30 bits of fingerprint, 'indexed', 'in several documents'."""

    def run(key: tuple, docs: pa.Table) -> pa.Table:
        found = [np.zeros(0, np.uint64)]
        data, offsets = utf8(docs.column("text"))
        for _, part, ends in chunks(data, offsets):
            w = _Words(part, ends)
            h, pos = w.windows(block)
            short, doc = _short(h, bits), w.doc[pos]
            order = np.argsort(short, kind="stable")  # documents stay in order in a run
            short, doc, indexed = short[order], doc[order], ((pos - w.first[doc]) % block == 0)[order]
            run = _runs(short)
            if not len(run):
                continue
            last = np.append(run[1:], len(short)) - 1
            entry = short[run] << np.uint64(2)
            entry |= np.logical_or.reduceat(indexed, run).astype(np.uint64) << np.uint64(1)
            entry |= (doc[run] != doc[last]).astype(np.uint64)
            found.append(entry)
        entry = np.concatenate(found)
        del found
        entry.sort()
        run = _runs(entry >> np.uint64(2))
        if not len(run):
            return pa.table({"bucket": pa.array([], pa.int64()), "grp": pa.array([], pa.int64()), "packed": pa.array([], pa.binary())})
        several = np.diff(np.append(run, len(entry))) > 1  # a chunk has whole documents, and a value once
        entry = np.bitwise_or.reduceat(entry, run) | several.astype(np.uint64)
        bucket, entry = (entry >> np.uint64(_FRAGMENT + 2)).astype(np.int64), entry.astype(np.uint32)
        cut = _runs(bucket)
        packed = [entry[a:b].tobytes() for a, b in zip(cut, np.append(cut, len(entry))[1:], strict=True)]
        return pa.table({"bucket": bucket[cut], "grp": pa.array([key[0].as_py()] * len(cut), pa.int64()), "packed": pa.array(packed, pa.binary())})

    return run


def _unpack(rows: pa.Table, name: str, dtype) -> tuple[np.ndarray, np.ndarray]:
    """All packed values of a table, and the row of each."""
    parts = [np.frombuffer(x, dtype) for c in rows.column(name).chunks for x in c.to_pylist()]
    return (np.concatenate(parts) if parts else np.zeros(0, dtype)), np.repeat(np.arange(len(parts)), [len(p) for p in parts])


def _hits(key: tuple, rows: pa.Table) -> pa.Table:
    """One bucket: fingerprints that some document indexes and two or more documents have, for each group that has them."""
    entry, row = _unpack(rows, "packed", np.uint32)
    group = rows.column("grp").to_numpy()
    order = np.argsort(entry, kind="stable")
    value = entry[order] >> np.uint32(2)
    run = _runs(value)
    if not len(run):
        return pa.table({"bucket": pa.array([], pa.int64()), "grp": pa.array([], pa.int64()), "hits": pa.array([], pa.binary())})
    count = np.diff(np.append(run, len(value)))
    flags = np.bitwise_or.reduceat(entry[order], run)
    # rows of one doc_id may be in several groups, and count as several documents: then more hits than needed
    hit = ((flags & 2) > 0) & ((count > 1) | ((flags & 1) > 0))
    keep = np.repeat(hit, count)
    g, v = group[row[order[keep]]], value[keep]
    both = np.unique((g.astype(np.uint64) << np.uint64(32)) | v.astype(np.uint64))
    g, v = (both >> np.uint64(32)).astype(np.int64), (both & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    cut = _runs(g)
    packed = [v[a:b].tobytes() for a, b in zip(cut, np.append(cut, len(v))[1:], strict=True)]
    return pa.table({"bucket": pa.array([key[0].as_py()] * len(cut), pa.int64()), "grp": g[cut], "hits": pa.array(packed, pa.binary())})


def _windows(window: int, block: int, bits: int):
    """One group's documents and anchors -> packed windows around the anchors: fingerprint, smallest doc_id, 'others too'."""

    def run(key: tuple, docs: pa.Table, hits: pa.Table) -> pa.Table:
        names, types = ["bucket", "grp", "prints", "docs", "several"], [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
        known = [
            (np.uint64(b) << np.uint64(_FRAGMENT)) | np.frombuffer(x, np.uint32).astype(np.uint64)
            for b, x in zip(hits.column("bucket").to_pylist(), hits.column("hits").to_pylist(), strict=True)
        ]
        known = np.sort(np.concatenate(known)) if known else np.zeros(0, np.uint64)
        found_h, found_d = [], []
        ids = docs.column("doc_id").to_numpy()
        data, offsets = utf8(docs.column("text"))
        if len(known):
            for at, part, ends in chunks(data, offsets):
                w = _Words(part, ends)
                anchors, pos = w.windows(block)
                here = np.zeros(len(w.hash) + 1, bool)
                short = _short(anchors, bits)
                here[pos[known[np.minimum(np.searchsorted(known, short), len(known) - 1)] == short]] = True
                n = np.r_[0, np.cumsum(here)]
                h, pos = w.windows(window, 1)
                ok = n[pos + window - block + 1] > n[pos]
                found_h.append(h[ok]), found_d.append(ids[at + w.doc[pos[ok]]])
        h = np.concatenate(found_h) if found_h else np.zeros(0, np.uint64)
        d = np.concatenate(found_d) if found_d else np.zeros(0, np.int64)
        order = np.argsort(h, kind="stable")
        h, d = h[order], d[order]
        at = _runs(h)
        if not len(at):
            return pa.table([pa.array([], t) for t in types], names=names)
        low, high, h = np.minimum.reduceat(d, at), np.maximum.reduceat(d, at), h[at]
        where = (h >> np.uint64(64 - bits)).astype(np.int64)
        cut = _runs(where)
        spans = list(zip(cut, np.append(cut, len(h))[1:], strict=True))
        return pa.table(
            [pa.array(where[cut]), pa.array([key[0].as_py()] * len(cut), pa.int64()), *(pa.array([x[a:b].tobytes() for a, b in spans], pa.binary()) for x in (h, low, low != high))],
            names=names,
        )

    return run


def _earliest(key: tuple, rows: pa.Table) -> pa.Table:
    """One bucket of windows -> for each group, those of its windows that another document has, with the smallest doc_id of all."""
    h, row = _unpack(rows, "prints", np.uint64)
    low, several = _unpack(rows, "docs", np.int64)[0], _unpack(rows, "several", bool)[0]
    group = rows.column("grp").to_numpy()
    order = np.argsort(h, kind="stable")
    h, low, several, row = h[order], low[order], several[order], row[order]
    run = _runs(h)
    if not len(run):
        return pa.table({"grp": pa.array([], pa.int64()), "prints": pa.array([], pa.binary()), "docs": pa.array([], pa.binary())})
    count = np.diff(np.append(run, len(h)))
    least = np.minimum.reduceat(low, run)
    repeated = np.repeat((count > 1) | np.logical_or.reduceat(several, run), count)
    # a group needs no reply for a window of which it has only the first document
    keep = repeated & (several | (low != np.repeat(least, count)))
    g, h, least = group[row[keep]], h[keep], np.repeat(least, count)[keep]
    order = np.argsort(g, kind="stable")
    g, h, least = g[order], h[order], least[order]
    cut = _runs(g)
    spans = list(zip(cut, np.append(cut, len(g))[1:], strict=True))
    return pa.table({"grp": g[cut], "prints": pa.array([h[a:b].tobytes() for a, b in spans], pa.binary()), "docs": pa.array([least[a:b].tobytes() for a, b in spans], pa.binary())})


def _covered(at: np.ndarray, n: int, window: int) -> np.ndarray:
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, at, 1)
    np.add.at(step, np.minimum(at + window, n), -1)
    return np.cumsum(step[:-1]) > 0


def _spans(mask: np.ndarray) -> list[tuple[int, int]]:
    edge = np.diff(np.r_[0, mask.astype(np.int8), 0])
    return list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True))


_OUT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string, repeats array<struct<first_word:long,n_words:long>>"


def _whole(window: int):
    """Documents that nothing is removed from -> the result rows."""
    cut, none = _cut(window), pa.table({"prints": pa.array([], pa.binary()), "docs": pa.array([], pa.binary())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from cut((), pa.Table.from_batches([batch]), none).to_batches()

    return run


def _cut(window: int):
    """One group's documents and the repeats among them -> the result rows."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept_text", pa.string()), ("repeats", pa.list_(pa.struct([("first_word", pa.int64()), ("n_words", pa.int64())])))])

    def run(_: tuple, docs: pa.Table, replies: pa.Table) -> pa.Table:
        prints, _row = _unpack(replies, "prints", np.uint64)
        earliest = _unpack(replies, "docs", np.int64)[0]
        order = np.argsort(prints)
        prints, earliest = prints[order], earliest[order]
        ids = docs.column("doc_id").fill_null(0).to_numpy()
        missing = docs.column("doc_id").is_null().to_numpy()
        nulls = docs.column("text").is_null().to_numpy()
        data, offsets = utf8(docs.column("text"))
        out = []
        for at, part, ends in chunks(data, offsets):
            w = _Words(part, ends)
            covered = np.zeros(len(w.hash), bool)
            if len(prints):
                h, pos = w.windows(window, 1)
                i = np.minimum(np.searchsorted(prints, h), len(prints) - 1)
                hit = (prints[i] == h) & (earliest[i] < ids[at + w.doc[pos]])
                covered = _covered(pos[hit], len(w.hash), window)  # windows end inside their document
            text = part.tobytes()
            for k in range(len(ends) - 1):
                lo, hi = w.first[k], w.first[k + 1]
                gone = covered[lo:hi]
                body, runs = text[ends[k] : ends[k + 1]], []
                if gone.any():
                    runs = _spans(gone)
                    left, kept = ends[k], []
                    for a, b in runs:
                        kept.append(text[left : w.starts[lo + a]])
                        left = w.starts[lo + b] if lo + b < hi else w.ends[hi - 1]
                    body = b"".join([*kept, text[left : ends[k + 1]]])
                    words = b" ".join(text[a:b] for a, b in zip(w.starts[lo:hi][~gone], w.ends[lo:hi][~gone], strict=True))
                else:
                    words = b" ".join(body.translate(_SPACES).split(b" ")) if hi > lo else b""
                    words = b" ".join(x for x in words.split(b" ") if x)
                out.append((None if missing[at + k] else int(ids[at + k]), int(hi - lo), int(gone.sum()), hashlib.sha256(words).hexdigest(), None if nulls[at + k] else body.decode("utf-8", "replace"), [{"first_word": a, "n_words": b - a} for a, b in runs]))
        return pa.Table.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out, strict=True), schema.types, strict=True)] if out else [pa.array([], t) for t in schema.types], schema=schema)

    return run


_SPACES = bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")


def remove_repeats(documents: DataFrame, window: int = 13) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, kept_text, repeats (first word and length of each maximal run removed).

    A word goes if it is covered by ``window`` consecutive words that also occur in a document
    with a smaller doc_id; windows are judged on the input.  ``kept_text`` keeps the white space
    before each kept word, ``kept_sha256`` is of the kept words joined by one space.  A null or
    empty text has no words (kept_text stays null if it was).  Repeats inside one document, and
    among rows with the same doc_id, stay.  Texts without a doc_id are left whole and take part in
    nothing.  Other columns are ignored; an empty table gives an empty result."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    named = docs.filter("doc_id is not null")
    groups, bits = layout(named.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    block = (window + 1) // 2
    named = named.withColumn("grp", F.pmod(F.xxhash64("doc_id", "text"), F.lit(groups)))  # rows of one doc_id spread, too
    owned = named.filter("text is not null")
    probes = owned.select("grp", "text").groupBy("grp").applyInArrow(_probes(block, bits), "bucket long, grp long, packed binary")
    hits = stage(probes.groupBy("bucket").applyInArrow(_hits, "bucket long, grp long, hits binary"), "anchors")
    release()
    windows = (
        owned.groupBy("grp")
        .cogroup(hits.groupBy("grp"))
        .applyInArrow(_windows(window, block, bits), "bucket long, grp long, prints binary, docs binary, several binary")
    )
    replies = stage(windows.groupBy("bucket").applyInArrow(_earliest, "grp long, prints binary, docs binary"), "repeats")
    discard(hits)
    release()
    nameless = docs.filter("doc_id is null").mapInArrow(_whole(window), _OUT)
    return named.groupBy("grp").cogroup(replies.groupBy("grp")).applyInArrow(_cut(window), _OUT).unionByName(nameless)
