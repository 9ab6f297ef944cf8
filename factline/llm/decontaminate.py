"""Benchmark decontamination by a distributed positional inverted index.

The index is dealt by document: each shard (a run of whole documents) stores, for every term of
its texts, the sorted positions of that term in the shard.  One pass over the texts writes it to
the shared folder, for all items that will be asked for; nothing is shuffled.  Terms that no item
has are left out if the items' vocabulary is small enough to send (SENT_TERMS); it is the same index
without them.

Test items are the query set.  They are read in blocks of at most BLOCK_ITEMS items, one at a time,
so that neither the driver nor a task ever holds more than a block.  For a block, the index's term
counts, summed over all shards, rank the terms of each test window from rare to common.  A window
is looked up by the list of its rarest term, moved by that term's offset, then intersected with the
moved lists of the other terms in order of rarity; what is left after the last term is an exact
phrase match.  With ``slop`` > 0 a term may stand up to that many words from its place: a proximity
match.  What a block finds is staged; in the end every document gets what all blocks found in it.

Terms are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factline.llm._common import ALNUM, LOWER, chunks, hash_spans, owners, signed, stage, utf8, word_spans

BLOCK_ITEMS = 50_000
#: A block also ends where its texts reach so many bytes.
BLOCK_BYTES = 16 << 20
#: Text of a shard, about: small enough that its row is no outsized object for the JVM's collector.
SHARD_BYTES = 256 << 10
#: Distinct terms of all items that are sent to every executor, 8 bytes each; beyond, the index has all terms.
SENT_TERMS = 2_000_000
_SHARD = "rows binary, doc_ids array<long>, first binary, terms binary, counts binary, positions binary"


class Queries:
    """A block of items: their terms, and windows as term numbers (-1 past a short window's end)."""

    def __init__(self, items: list[tuple[str, str | None]], width: int):
        texts = pa.array([t or "" for _, t in items], pa.large_string())
        data, offsets = utf8(texts)
        data = LOWER[data]
        starts, ends, first = word_spans(data, offsets, ALNUM)
        words = hash_spans(data, starts, ends)
        self.terms, number = np.unique(words, return_inverse=True)
        self.items = [i for i, _ in items]
        seen: dict[bytes, int] = {}
        self.of: list[list[int]] = []  # items of each window
        rows = []
        for k in range(len(items)):
            w = number[first[k] : first[k + 1]]
            for j in range(max(1, len(w) - width + 1) if len(w) else 0):
                row = np.full(width, -1, np.int64)
                row[: min(width, len(w) - j)] = w[j : j + width]
                at = seen.setdefault(row.tobytes(), len(rows))
                if at == len(rows):
                    rows.append(row), self.of.append([])
                if not self.of[at] or self.of[at][-1] != k:
                    self.of[at].append(k)
        self.windows = np.array(rows, np.int64).reshape(-1, width)
        self.length = (self.windows >= 0).sum(1)


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts -> their distinct terms."""
    for batch in batches:
        data, offsets = utf8(batch.column(0))
        for _, part, ends in chunks(data, offsets):
            part = LOWER[part]
            starts, stops, _first = word_spans(part, ends, ALNUM)
            yield pa.RecordBatch.from_arrays([pa.array(signed(np.unique(hash_spans(part, starts, stops))))], ["term"])


def vocabulary(benchmark: DataFrame) -> np.ndarray | None:
    """The sorted terms of all items, or none if they are more than SENT_TERMS."""
    terms = benchmark.filter("item_id is not null").select(F.col("text").cast("string")).mapInArrow(_terms, "term long").distinct()
    found = terms.limit(SENT_TERMS + 1).toArrow().column(0).to_numpy()
    return np.sort(found.astype(np.int64).view(np.uint64)) if len(found) <= SENT_TERMS else None


def _index(gap: int, wanted):
    """Documents -> shards: positions of each term (of the wanted ones, if any are given), and the place of each document in them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number = batch.column(2).to_numpy()
            data, offsets = utf8(batch.column(1))
            for at, part, ends in chunks(data, offsets, SHARD_BYTES):
                part = LOWER[part]
                starts, stops, first = word_spans(part, ends, ALNUM)
                term, doc = hash_spans(part, starts, stops), owners(first)
                pos = np.arange(len(term)) + doc * gap  # no match can span two documents
                if wanted is not None:
                    known = _find(wanted.value, term)[1]
                    term, pos = term[known], pos[known]
                order = np.argsort(term, kind="stable")
                own, count = np.unique(term, return_counts=True)
                place = first + np.arange(len(first)) * gap
                n = len(ends) - 1
                columns = [number[at : at + n].tobytes(), None, place.tobytes(), own.tobytes(), count.astype(np.int32).tobytes(), pos[order].astype(np.int32).tobytes()]
                arrays = [pa.array([c], pa.binary()) if c is not None else pa.array([batch.column(0).slice(at, n).to_pylist()], pa.list_(pa.int64())) for c in columns]
                yield pa.RecordBatch.from_arrays(arrays, ["rows", "doc_ids", "first", "terms", "counts", "positions"])

    return run


def _counts(terms: np.ndarray):
    """Shards -> for the given terms (sorted), how often each stands in them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(terms), np.int64)
        for batch in batches:
            for t, c in zip(batch.column(0), batch.column(1), strict=True):
                at, has = _find(np.frombuffer(t.as_py(), np.uint64), terms)
                total[has] += np.frombuffer(c.as_py(), np.int32)[at[has]]
        known = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(known, pa.int64()), pa.array(total[known], pa.int64())], ["term", "n"])

    return run


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place of each wanted value in sorted keys, and whether it is there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def _near(keys: np.ndarray, wanted: np.ndarray, slop: int) -> np.ndarray:
    """Whether sorted ``keys`` has a value in [wanted - slop, wanted + slop]."""
    i = np.searchsorted(keys, wanted - slop)
    return (i < len(keys)) & (keys[np.minimum(i, len(keys) - 1)] <= wanted + slop) if len(keys) else np.zeros(len(wanted), bool)


def intersect(shard: dict, q: Queries, order: np.ndarray, slop: int) -> tuple[np.ndarray, np.ndarray]:
    """(window, start) of all matches in a shard; ``order``: each window's offsets from its rarest term on."""
    if not len(order):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    span = np.int64(1) << np.int64(33)
    at, has = _find(shard["terms"], q.terms)
    size = np.where(has, shard["counts"][at] if len(shard["counts"]) else 0, 0).astype(np.int64)
    bound = np.r_[0, np.cumsum(shard["counts"].astype(np.int64))][at]
    # the lists of the block's terms, one after another
    inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    positions = shard["positions"][np.repeat(bound, size) + inside].astype(np.int64)
    keys = np.repeat(np.arange(len(size)), size) * span + positions
    list_at = np.cumsum(size) - size
    rarest = q.windows[np.arange(len(order)), order[:, 0]]
    n = size[rarest]
    window = np.repeat(np.arange(len(order)), n)
    within = np.arange(len(window)) - np.repeat(np.cumsum(n) - n, n)
    start = positions[np.repeat(list_at[rarest], n) + within] - order[window, 0]
    for step in range(1, order.shape[1]):
        offset = order[window, step]
        term = q.windows[window, offset]
        ok = (term < 0) | _near(keys, term * span + start + offset, slop)
        window, start = window[ok], start[ok]
    ok = start >= 0
    return window[ok], start[ok]


def _search(q: Queries, order: np.ndarray, slop: int):
    """Shards -> the documents with a match: row, spans, items, matches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gap = _gap(q.windows.shape[1], slop)
        for batch in batches:
            for k in range(batch.num_rows):
                shard = {c: np.frombuffer(batch.column(i)[k].as_py(), t) for i, (c, t) in enumerate(_BINARY.items())}
                window, start = intersect(shard, q, order, slop)
                if not len(window):
                    continue
                place = shard["first"]
                doc = np.clip(np.searchsorted(place, start + slop, "right") - 1, 0, max(0, len(place) - 2))
                by = np.argsort(doc, kind="stable")
                docs, edge = np.unique(doc[by], return_index=True)
                out: list[list] = [[] for _ in _HITS]
                for d, a, b in zip(docs.tolist(), edge.tolist(), [*edge[1:].tolist(), len(by)], strict=True):
                    own = by[a:b]
                    n = int(place[d + 1] - place[d]) - gap
                    hit = np.zeros(n + 1, np.int64)
                    items: set[str] = set()
                    matches: dict[tuple[int, int], set[str]] = {}
                    for w, s in zip(window[own].tolist(), (start[own] - place[d]).tolist(), strict=True):
                        hit[max(0, min(s, n))] += 1
                        hit[max(0, min(s + int(q.length[w]), n))] -= 1
                        found = {q.items[i] for i in q.of[w]}
                        items |= found
                        matches.setdefault((s, int(q.length[w])), set()).update(found)
                    runs = np.diff(np.r_[0, (np.cumsum(hit)[:-1] > 0).astype(np.int8), 0])
                    out[0].append(int(shard["rows"][d]))
                    out[1].append([{"first_word": int(x), "n_words": int(y - x)} for x, y in zip(np.flatnonzero(runs == 1), np.flatnonzero(runs == -1), strict=True)])
                    out[2].append(sorted(items))
                    out[3].append([{"first_word": s, "n_words": m, "items": sorted(i)} for (s, m), i in sorted(matches.items())])
                yield pa.RecordBatch.from_arrays([pa.array(column, t) for column, t in zip(out, _HITS.values(), strict=True)], list(_HITS))

    return run


def _documents(gap: int):
    """Shards -> row, doc_id, n_words of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, ids, first in zip(*(batch.column(i) for i in range(3)), strict=True):
                n_words = np.diff(np.frombuffer(first.as_py(), np.int64)) - gap
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(rows.as_py(), np.int64)), pa.array(ids.as_py(), pa.int64()), pa.array(n_words)], ["row", "doc_id", "n_words"])

    return run


_SPAN = pa.struct([("first_word", pa.int64()), ("n_words", pa.int64())])
_MATCH = pa.struct([("first_word", pa.int64()), ("n_words", pa.int64()), ("items", pa.list_(pa.string()))])
_BINARY = {"rows": np.int64, "first": np.int64, "terms": np.uint64, "counts": np.int32, "positions": np.int32}
_HITS = {"row": pa.int64(), "spans": pa.list_(_SPAN), "items": pa.list_(pa.string()), "matches": pa.list_(_MATCH)}
_FOUND = "row long, spans array<struct<first_word:long,n_words:long>>, items array<string>, matches array<struct<first_word:long,n_words:long,items:array<string>>>"


def _gap(width: int, slop: int) -> int:
    return width + 2 * slop + 1


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[str, str | None]]]:
    block, size = [], 0
    for r in benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("string")).filter("item_id is not null").toLocalIterator():
        block.append((r[0], r[1]))
        size += len(r[1] or "")
        if len(block) >= BLOCK_ITEMS or size >= BLOCK_BYTES:
            yield block
            block, size = [], 0
    yield block


def build_index(documents: DataFrame, width: int = 10, slop: int = 0, terms: np.ndarray | None = None) -> DataFrame:
    """The staged index of all texts, for windows of up to ``width`` words and that slop; of all terms if none are given."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    docs = docs.withColumn("row", F.monotonically_increasing_id())  # kept in the index: rows may share a doc_id or have none
    return stage(docs.mapInArrow(_index(_gap(width, slop), None if terms is None else docs.sparkSession.sparkContext.broadcast(terms)), _SHARD), "postings")


def search_index(shards: DataFrame, items: list[tuple[str, str | None]], width: int, slop: int) -> DataFrame:
    """row, spans, items, matches of the documents in which a block of items has a match."""
    q = Queries(items, width)
    per = shards.select("terms", "counts").mapInArrow(_counts(q.terms), "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    n = np.zeros(len(q.terms) + 1, np.int64)
    for r in per.collect():  # one row a term of the block
        n[r["term"]] = r["n"]
    rank = np.where(q.windows < 0, np.iinfo(np.int64).max, n[q.windows])
    order = np.argsort(rank, axis=1, kind="stable")
    return stage(shards.select(*_BINARY).mapInArrow(_search(q, order, slop), _FOUND), "matches")


def find_contamination(documents: DataFrame, benchmark: DataFrame, width: int = 10, slop: int = 0) -> DataFrame:
    """doc_id, n_words, spans (words hit, as maximal runs), items (ids of items with a match),
    matches (each place and length, with the ids found there).

    A window is ``width`` consecutive words of an item, or all of them if fewer.  A null or empty
    text has no words; items without words match nothing, items with a null item_id are ignored,
    items that share an id count as one.  Every row gives a row, whether it repeats a doc_id or has
    none.  Other columns are ignored; empty tables give no matches."""
    shards = build_index(documents, width, slop, vocabulary(benchmark))
    hits = reduce(DataFrame.unionByName, [search_index(shards, items, width, slop) for items in _blocks(benchmark)])
    lists = [F.flatten(F.collect_list(c)).alias(c) for c in ("spans", "items", "matches")]
    found = hits.groupBy("row").agg(*lists).select(*_HITS).mapInArrow(_merged, _FOUND)
    every = shards.select("rows", "doc_ids", "first").mapInArrow(_documents(_gap(width, slop)), "row long, doc_id long, n_words long")
    none = [F.coalesce(c, F.array().cast(found.schema[c].dataType)).alias(c) for c in ("spans", "items", "matches")]
    return every.join(found, "row", "left").select("doc_id", "n_words", *none)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the blocks found in a document, as one block would tell it."""
    for batch in batches:
        rows = batch.to_pylist()
        for r in rows:
            spans: list[dict] = []
            for s in sorted(r["spans"], key=lambda s: s["first_word"]):
                if spans and s["first_word"] <= (end := spans[-1]["first_word"] + spans[-1]["n_words"]):
                    spans[-1]["n_words"] = max(end, s["first_word"] + s["n_words"]) - spans[-1]["first_word"]
                else:
                    spans.append(s)
            matches: dict[tuple[int, int], set[str]] = {}
            for m in r["matches"]:
                matches.setdefault((m["first_word"], m["n_words"]), set()).update(m["items"])
            r["spans"], r["items"] = spans, sorted(set(r["items"]))
            r["matches"] = [{"first_word": s, "n_words": n, "items": sorted(i)} for (s, n), i in sorted(matches.items())]
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in _HITS.items()], list(_HITS))
