"""Best-fit packing of documents into sequences by the linear grouping scheme.

Documents over the capacity are cut into full pieces and a rest.  Large pieces, sorted by length,
are dealt into groups of equal cardinality and each length is rounded up to its group's largest,
which leaves few sizes.  Which configurations of these sizes to use, and how often, is a linear
program; it is solved by column generation (a basis of configurations, and a knapsack that finds the
one to bring in).  Whole multiples are taken, and the actual lengths take the rounded ones' places,
which only frees room.  Pieces that the fractions leave over are few: sequences are filled from
them one pattern at a time, the largest piece with the subset of the others that leaves least room.
Small pieces go best-fit into what is left.  Several numbers of groups are tried, the last with a
group a length, which rounds nothing and has too many sizes for the program, so that all of it is
filled by patterns.  The plan with the fewest sequences is kept; one that meets the lower bound (all
tokens over the capacity) ends the search.

The plan needs the histogram of lengths only, at most ``capacity`` numbers, so its size has a bound
that doesn't grow with the input.  It says, for a run of the pieces of one length, in which run of
sequences and where they go; every piece then finds its place by its rank among its length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from factline.llm._common import stage
from factline.llm.tokens import Encoder

#: Groups (0: one a length) and the smallest share of the capacity that counts as large, as tried.
SCHEMES = ((24, 4), (100, 8), (0, 8), (0, 4096))
#: Exchanges in the basis, a group; the solution is used as far as it has come by then.
EXCHANGES = 30
Entry = tuple[int, int, int, int, int, int]  # length, first rank, pieces, first sequence, pieces a sequence, offset


class _Bins:
    """Sequences as runs with equal room, by the room that is left."""

    def __init__(self, capacity: int):
        self.capacity, self.n, self.plan = capacity, 0, []
        self.rooms: list[int] = []
        self.runs: dict[int, list[tuple[int, int]]] = {}

    def add(self, room: int, first: int, count: int) -> None:
        if count and room:
            if room not in self.runs:
                insort(self.rooms, room)
                self.runs[room] = []
            self.runs[room].append((first, count))

    def open(self, count: int) -> int:
        self.n += count
        return self.n - count

    def best_fit(self, length: int, rank: int, n: int) -> None:
        """Places n pieces of one length, each where it leaves the least room."""
        while n:
            at = bisect_left(self.rooms, length)
            if at == len(self.rooms):
                q = self.capacity // length
                self.add(self.capacity, self.open(-(-n // q)), -(-n // q))
                continue
            room = self.rooms[at]
            first, count = self.runs[room].pop()
            if not self.runs[room]:
                del self.runs[room], self.rooms[at]
            q = room // length  # a sequence that took one is the tightest for the next
            full = min(count, n // q)
            if full:
                self.plan.append((length, rank, full * q, first, q, self.capacity - room))
                self.add(room - q * length, first, full)
                rank, n, first, count = rank + full * q, n - full * q, first + full, count - full
            if count and n:  # the last of them
                self.plan.append((length, rank, n, first, n, self.capacity - room))
                self.add(room - n * length, first, 1)
                rank, n, first, count = rank + n, 0, first + 1, count - 1
            self.add(room, first, count)


def _knapsack(sizes: list[int], values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The configuration of the greatest value, sizes used as often as wanted."""
    best, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for i, (s, v) in enumerate(zip(sizes, values, strict=True)):
        for a in range(s, capacity + 1, s) if v > 0 else ():
            here = best[a : a + s]
            more = best[a - s : a - s + len(here)] + v
            better = more > here + 1e-12
            here[better] = more[better]
            last[a : a + s][better] = i
    used, c = np.zeros(len(sizes)), capacity
    while last[c] >= 0:
        used[last[c]] += 1
        c -= sizes[last[c]]
    return float(used @ values), used


def optimise(sizes: list[int], demand: list[int], capacity: int) -> list[tuple[list[int], int]]:
    """(groups, times): configurations of the linear program's solution, as often as whole numbers go."""
    n = len(sizes)
    basis, x = np.diag([float(capacity // s) for s in sizes]), np.array([d / (capacity // s) for s, d in zip(sizes, demand, strict=True)])
    for _ in range(EXCHANGES * n):
        value, new = _knapsack(sizes, np.linalg.solve(basis.T, np.ones(n)), capacity)
        if value <= 1 + 1e-9:
            break
        step = np.linalg.solve(basis, new)
        ratio = np.where(step > 1e-9, x / np.where(step > 1e-9, step, 1), np.inf)
        out = int(np.argmin(ratio))
        basis[:, out] = new
        x = x - ratio[out] * step
        x[out] = ratio[out] if np.isfinite(ratio[out]) else 0.0
        x = np.maximum(x, 0)
    left, found = list(demand), []
    for k in np.argsort(-x):
        config = [g for g in range(n) for _ in range(int(round(basis[g, k])))]
        times = min([int(x[k] + 1e-6), *(left[g] // c for g, c in Counter(config).items())])
        if times > 0:
            found.append((config, times))
            for g, c in Counter(config).items():
                left[g] -= c * times
    return found


def fills(counts: dict[int, int], capacity: int) -> Iterator[tuple[list[int], int]]:
    """(lengths, times): the largest piece left with the subset of the others that leaves least room, until none is left."""
    left = {n: c for n, c in sorted(counts.items(), reverse=True) if c}
    while left:
        first = next(iter(left))
        room = capacity - first
        reach, layers, full = 1, [], (1 << (room + 1)) - 1
        for n, c in left.items():
            for _ in range(min(c - (n == first), room // n)):
                wider = (reach | reach << n) & full
                if wider == reach:
                    break
                layers.append((n, reach))
                reach = wider
            if reach >> room:
                break
        total, chosen = reach.bit_length() - 1, [first]
        for n, before in reversed(layers):
            if not before >> total & 1:
                chosen.append(n)
                total -= n
        used = Counter(chosen)
        times = min(left[n] // k for n, k in used.items())
        for n, k in used.items():
            left[n] -= k * times
            if not left[n]:
                del left[n]
        yield chosen, times


def _substitute(bins: _Bins, queues: dict[int, list[tuple[int, int, int]]], config: list[int], times: int) -> None:
    """The actual pieces of each place of a configuration, as runs of (length, first rank, pieces)."""
    first = bins.open(times)
    columns = []
    for g in config:
        need, column = times, []
        while need:
            length, rank, k = queues[g].pop()
            use = min(k, need)
            column.append([length, rank, use])
            if k > use:
                queues[g].append((length, rank + use, k - use))
            need -= use
        columns.append(column[::-1])
    while times:
        k = min(c[-1][2] for c in columns)
        offset = 0
        for c in columns:
            length, rank, n = c[-1]
            bins.plan.append((length, rank, k, first, 1, offset))
            offset += length
            c[-1] = [length, rank + k, n - k]
            if n == k:
                c.pop()
        bins.add(bins.capacity - offset, first, k)
        first, times = first + k, times - k


def _scheme(counts: dict[int, int], capacity: int, groups: int, share: int) -> _Bins:
    bins = _Bins(capacity)
    large = [(n, counts[n]) for n in sorted(counts, reverse=True) if n * share > capacity]
    each = max(1, -(-sum(c for _, c in large) // max(1, groups)))
    queues: dict[int, list[tuple[int, int, int]]] = {0: []}
    room = each
    for length, count in large:
        rank = 0
        while count:
            if not room:
                queues[len(queues)] = []
                room = each
            k = min(room, count)
            queues[len(queues) - 1].append((length, rank, k))
            rank, count, room = rank + k, count - k, room - k
    if large and groups:
        sizes = [q[0][0] for q in queues.values()]
        demand = [sum(k for _, _, k in q) for q in queues.values()]
        for q in queues.values():
            q.reverse()  # its largest go last
        for config, times in optimise(sizes, demand, capacity):
            _substitute(bins, queues, config, times)
    rest: dict[int, list[tuple[int, int, int]]] = {}
    for q in queues.values():
        for run in q:
            rest.setdefault(run[0], []).append(run)
    for lengths, times in fills({n: sum(k for _, _, k in runs) for n, runs in rest.items()}, capacity):
        _substitute(bins, rest, lengths, times)
    for length in sorted(counts, reverse=True):
        if length * share <= capacity:
            bins.best_fit(length, 0, counts[length])
    return bins


def plan(counts: dict[int, int], capacity: int) -> tuple[int, list[Entry]]:
    """Sequences and plan for so many pieces of each length (1 to capacity)."""
    least, best = -(-sum(n * c for n, c in counts.items()) // capacity), None
    for groups, share in SCHEMES:
        bins = _scheme(counts, capacity, groups, share)
        if best is None or bins.n < best.n:
            best = bins
        if best.n == least:
            break
    return best.n, best.plan


def _pieces(path: str, end_id: int, capacity: int):
    names = ["part", "doc_id", "piece", "start", "length", "ids_crc32", "k"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = Encoder.of(path), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)  # pieces of each length so far in this task
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                cut = batch.slice(at, 512)
                rows: list[tuple] = []
                for doc, ids in zip(cut.column(0).to_pylist(), encoder.encode([t or "" for t in cut.column(1).to_pylist()]), strict=True):
                    ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                    for piece, a in enumerate(range(0, len(ids), capacity)):
                        x = ids[a : a + capacity]
                        rows.append((part, doc, piece, a, len(x), zlib.crc32(x.tobytes()), int(seen[len(x)])))
                        seen[len(x)] += 1
                columns = list(zip(*rows, strict=True)) or [[]] * 7
                yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int32() if n == "piece" else pa.int64()) for c, n in zip(columns, names, strict=True)], names)

    return run


def _place(entries: list[Entry]):
    table = np.array(sorted(entries), np.int64).reshape(-1, 6)
    keys = table[:, 0] << np.int64(44) | table[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            row = table[np.searchsorted(keys, length << np.int64(44) | rank, "right") - 1] if len(length) else table[:0]
            k, q = rank - row[:, 1], row[:, 4]
            sequence, offset = row[:, 3] + k // np.maximum(q, 1), row[:, 5] + k % np.maximum(q, 1) * length
            keep = batch.select(["doc_id", "piece", "start", "length", "ids_crc32"])
            yield pa.RecordBatch.from_arrays([*keep.columns, pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())], [*keep.schema.names, "sequence_id", "offset"])

    return run


def pack_documents(documents: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: every piece's place in a sequence.

    A null or empty text is its end id alone.  Rows that repeat a doc_id, or have none, are packed
    like any other.  Other columns are ignored; an empty table gives an empty result."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "part long, doc_id long, piece int, start long, length long, ids_crc32 long, k long"
    pieces = stage(docs.mapInArrow(_pieces(tokenizer, end_id, capacity), schema), "pieces")
    per = stage(pieces.groupBy("length", "part").count(), "lengths")
    counts = {r[0]: r[1] for r in per.groupBy("length").agg(F.sum("count")).collect()}  # at most ``capacity`` rows
    _, entries = plan(counts, capacity)
    upto = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    base = per.select("length", "part", F.coalesce(F.sum("count").over(upto), F.lit(0)).alias("base"))
    ranked = pieces.join(base, ["length", "part"]).withColumn("rank", F.col("base") + F.col("k"))
    return ranked.mapInArrow(_place(entries), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
