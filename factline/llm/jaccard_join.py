"""N-gram Jaccard join: size-banded tiles, bitmap bounds, exact sorted-array intersection.

Sets whose Jaccard similarity is at least t have sizes within a factor t and differ in at
most (1-t)/(1+t) * (|A|+|B|) members.  Size bands alone leave quadratic tiles, so each band
is cut further without loss: a band whose largest set has b members is dealt by hash into
k > (1-t)/(1+t) * 2b parts, so two similar sets have a part in which they agree member for
member, and meet in the tile (band, part, hash of the part's members).  A part that is empty
in both agrees without giving a tile; a set whose empty parts could hide every agreement is
dealt again by a second, third and fourth hash, and if all four fail, it goes to a tile of
its band.  So no similar pair can miss.

In a tile every set is first compared with the tile's smallest id.  Components of those
links leave few tiles with more than one component; only these are compared pair by pair,
in sub-tiles of bounded size ordered by set size: first each set with the one that the bounds
put nearest to it in another component, then whatever is still in different components.  Popcounts of signatures (2048 bits, four a
member for large sets) bound the overlap from above; the survivors' sorted hash arrays are intersected exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from math import floor

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from factline.llm._common import LOWER, NOT_SPACE, binary, chunks, discard, hash_spans, hash_windows, mix, release, signed, stage, utf8, word_spans
from factline.llm.components import components

BITS = 2048
ROUNDS = 4
TILE = 512
PART = 4
_BAND = 1.5
_SET = "doc_id long, n long, f1 long, f2 long, bitmap binary"


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """Each document's sorted distinct shingle hashes: k words, or all words if fewer; none without words."""
    data = LOWER[data]
    starts, ends, first = word_spans(data, offsets, NOT_SPACE)
    words = hash_spans(data, starts, ends)
    windows = hash_windows(words, k)
    for i in range(len(first) - 1):
        lo, hi = first[i], first[i + 1]
        if hi - lo >= k:
            yield np.unique(windows[lo : hi - k + 1])
        elif hi > lo:
            yield hash_windows(words[lo:hi], int(hi - lo), 1)
        else:
            yield np.zeros(0, np.uint64)


def bands(t: Fraction) -> list[tuple[int, int, int, int]]:
    """(smallest size, largest size, parts, parts in excess) of each band, for sets up to 2^40 members."""
    out, low = [], 0
    while low < 1 << 40:
        high = max(low + 1, floor(low * _BAND))
        differ = floor((1 - t) / (1 + t) * 2 * high)
        spare = 0 if differ == 0 else 1 + high // 60
        out.append((int(-(-(t * (low + 1)) // 1)), high, differ + 1 + spare, spare))
        low = high
    return out


def tile_keys(u: np.ndarray, table: list[tuple[int, int, int, int]]) -> np.ndarray:
    """The tiles of one set."""
    n, out = len(u), []
    for level, (low, high, parts, spare) in enumerate(table):
        if n > high:
            continue
        if n < low:
            break
        for turn in range(ROUNDS):
            h = mix(u + np.uint64(0x51ED270B27F1A36D * (turn + 1) % (1 << 64)))
            part = (h >> np.uint64(11)) % np.uint64(parts)
            order = np.argsort(part, kind="stable")
            part, h = part[order], h[order]
            at = np.flatnonzero(np.diff(part, prepend=np.uint64(parts + 1)))
            sums = np.add.reduceat(h, at)
            sizes = np.diff(np.append(at, n)).astype(np.uint64)
            out.append(mix(sums + mix(part[at] * np.uint64(8191) + np.uint64(level * 8 + turn)) + sizes))
            if parts - len(at) <= spare:  # more parts agree than are empty
                break
        else:
            out.append(mix(np.array([level + (1 << 40)], np.uint64)))
    # 48 bits, as the keys outweigh the texts on their way; tiles that share a key are one tile, which loses nothing
    return np.concatenate(out) & np.uint64((1 << 48) - 1) if out else np.zeros(0, np.uint64)


def bitmap(u: np.ndarray) -> bytes:
    size = max(BITS, 1 << (4 * len(u) - 1).bit_length()) if len(u) else BITS  # else long sets fill it
    bits = np.zeros(size, bool)
    bits[(mix(u) >> np.uint64(32)).astype(np.int64) % size] = True
    return np.packbits(bits).tobytes()


def _prints(u: np.ndarray) -> tuple[int, int]:
    return int(np.add.reduce(mix(u))), int(np.bitwise_xor.reduce(mix(u ^ np.uint64(0xA5A5A5A5))))


def _describe(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()  # equal sets of one task need a signature only once
        for batch in batches:
            named = batch.column(0).is_valid().to_pylist()
            data, offsets = utf8(batch.column(1))
            for at, part, ends in chunks(data, offsets):
                n, f1, f2, maps = [], [], [], []
                for i, u in enumerate(shingle_sets(part, ends, k)):
                    both = _prints(u)
                    new = len(u) > 0 and named[at + i] and both not in seen
                    if new:
                        seen.add(both)
                    n.append(len(u)), f1.append(both[0]), f2.append(both[1]), maps.append(bitmap(u) if new else None)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(n)), pa.array(n, pa.int64()), *(pa.array(np.array(f, np.uint64).view(np.int64)) for f in (f1, f2)), pa.array(maps, pa.binary())],
                    ["doc_id", "n", "f1", "f2", "bitmap"],
                )

    return run


def _deal(k: int, t: Fraction):
    """(key, doc_id) of every set and tile; tiles are worked out here, not kept, as they outweigh the texts."""
    table = bands(t)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()  # equal sets of one task need tiles only once
        for batch in batches:
            ids = batch.column(0).to_numpy()
            data, offsets = utf8(batch.column(1))
            for at, part, ends in chunks(data, offsets):
                keys, owner = [], []
                for i, u in enumerate(shingle_sets(part, ends, k)):
                    if len(u) and (both := _prints(u)) not in seen:
                        seen.add(both), keys.append(tile_keys(u, table)), owner.append(ids[at + i])
                if keys:
                    yield pa.RecordBatch.from_arrays([pa.array(signed(np.concatenate(keys))), pa.array(np.repeat(owner, [len(x) for x in keys]))], ["key", "doc_id"])

    return run


def _shared_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (key, doc_id) -> those of tiles with two or more sets, with the tile's first.

    Holds one batch and one row, whatever a tile's size."""
    key = pivot = last = None
    for batch in batches:
        k, d = (batch.column(i).to_numpy() for i in (0, 1))
        if not len(k):
            continue
        new = np.r_[k[0] != key, k[1:] != k[:-1]] if key is not None else np.r_[True, k[1:] != k[:-1]]
        at = np.flatnonzero(new)
        heads = np.r_[pivot if not new[0] else d[0], d[at[at > 0]]] if len(at) == 0 or at[0] > 0 else d[at]
        run = np.cumsum(new) - (1 if new[0] else 0)
        p = heads[run]
        twice = np.r_[(not new[0]) and d[0] == last, (~new[1:]) & (d[1:] == d[:-1])]
        keep = (d != p) & ~twice
        key, pivot, last = k[-1], p[-1], d[-1]
        if keep.any():
            yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (k, d, p)], ["key", "doc_id", "pivot"])


def most_shared(n1: np.ndarray, n2: np.ndarray, m1: np.ndarray, m2: np.ndarray) -> np.ndarray:
    """An upper bound of |A & B|: a bit that only A sets stands for at least one member that B lacks."""
    bits = lambda x: np.bitwise_count(x).sum(-1, dtype=np.int64)
    return np.minimum(n1 - bits(m1 & ~m2), n2 - bits(m2 & ~m1))


def may_link(n1: np.ndarray, n2: np.ndarray, m1: np.ndarray, m2: np.ndarray, t: Fraction) -> np.ndarray:
    """Whether bit counts allow |A & B| >= t/(1+t) * (|A| + |B|)."""
    most = most_shared(n1, n2, m1, m2)
    return most * (t.numerator + t.denominator) >= t.numerator * (n1 + n2)


def _bitmap(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint64)


def _fold(x: np.ndarray, words: int) -> np.ndarray:
    """A signature at a smaller size: both sizes are powers of two, so a member's place is taken modulo."""
    return x if len(x) == words else np.bitwise_or.reduce(x.reshape(-1, words), axis=0)


def _sized(stack: np.ndarray, rows: np.ndarray, words: int) -> np.ndarray:
    """Some of a stack's signatures, at a smaller size."""
    return np.bitwise_or.reduce(stack.reshape(len(stack), -1, words)[rows], axis=1)


def _allowed(n1: int, n2: int, x: np.ndarray, y: np.ndarray, t: Fraction) -> bool:
    words = min(len(x), len(y))
    return bool(may_link(np.array([n1]), np.array([n2]), _fold(x, words)[None], _fold(y, words)[None], t)[0])


def _bounded(t: Fraction):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, n1, n2 = (batch.column(i).to_numpy() for i in range(4))
            ok = np.array([_allowed(p, q, _bitmap(x.as_py()), _bitmap(y.as_py()), t) for p, q, x, y in zip(n1, n2, batch.column(4), batch.column(5), strict=True)], bool)
            yield pa.RecordBatch.from_arrays([pa.array(a[ok]), pa.array(b[ok])], ["a", "b"])

    return run


def _tile_pairs(t: Fraction, nearest: bool):
    """One sub-tile pair (about 2 * TILE rows): pairs of different components that the bounds allow,
    or of these, for each set, only the one with the highest bound."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        k, i, j = (x.as_py() for x in key)
        tile, ids, comp, n = (rows.column(c).to_numpy() for c in ("tile", "doc_id", "comp", "n"))
        maps = [_bitmap(x) for c in rows.column("bitmap").chunks for x in c.to_pylist()]
        words = np.array([len(x) for x in maps])
        place, stacks = np.zeros(len(maps), np.int64), {}
        for size in np.unique(words):
            own = np.flatnonzero(words == size)
            place[own], stacks[size] = np.arange(len(own)), np.stack([maps[i] for i in own])
        left, right = np.flatnonzero(tile == i), np.flatnonzero(tile == j)
        out, like = [], []
        for x in left:
            y = right[right > x] if i == j else right
            y = y[comp[y] != comp[x]]
            y = y[np.minimum(n[y], n[x]) * t.denominator >= np.maximum(n[y], n[x]) * t.numerator]
            if len(y):
                ok, likeness = np.zeros(len(y), bool), np.zeros(len(y))
                for size in np.unique(words[y]):  # at one size each
                    w, these = min(size, words[x]), np.flatnonzero(words[y] == size)
                    mine, nx = _fold(maps[x], w)[None], n[x]
                    for part in (w // PART, w):  # a part of the bits bounds too, and rules most pairs out
                        theirs = stacks[size].reshape(-1, size // w, w)[place[y[these]], :, :part]
                        theirs = theirs[:, 0] if size == w else np.bitwise_or.reduce(theirs, axis=1)
                        these = these[may_link(np.full(len(these), nx), n[y[these]], mine[:, :part], theirs, t)]
                    ok[these] = True
                    if nearest and len(these):
                        theirs = _sized(stacks[size], place[y[these]], w)
                        likeness[these] = most_shared(np.full(len(these), nx), n[y[these]], mine, theirs) / (n[y[these]] + nx)
                which = np.argmax(np.where(ok, likeness, -1), keepdims=True) if nearest and ok.any() else ok
                y = y[which]
                out.append(np.stack([np.full(len(y), ids[x]), ids[y]])), like.append(likeness[which])
        xy = np.concatenate(out, 1) if out else np.zeros((2, 0), np.int64)
        same = lambda v: np.full(xy.shape[1], v, np.int64)
        return pa.table({"key": same(k), "i": same(i), "j": same(j), "x": xy[0], "y": xy[1], "likeness": np.concatenate(like) if like else np.zeros(0)})

    return run


def _arrays(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            data, offsets = utf8(batch.column(1))
            for at, part, ends in chunks(data, offsets):
                sets = list(shingle_sets(part, ends, k))
                yield pa.RecordBatch.from_arrays([pa.array(ids[at : at + len(sets)]), binary(sets)], ["doc_id", "members"])

    return run


def _intersect(t: Fraction):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep[i] = both * t.denominator >= t.numerator * (len(x) + len(y) - both)
            yield batch.select([0, 1]).filter(pa.array(keep))

    return run


def _verify(pairs: DataFrame, sets: DataFrame, docs: DataFrame, k: int, t: Fraction) -> DataFrame:
    """Those of the distinct ``pairs`` (a < b) that link."""
    one = lambda c: sets.select(F.col("doc_id").alias(c), F.col("n").alias(f"n_{c}"), F.col("bitmap").alias(f"m_{c}"))
    both = pairs.join(one("a"), "a").join(one("b"), "b").select("a", "b", "n_a", "n_b", "m_a", "m_b")
    likely = stage(both.mapInArrow(_bounded(t), "a long, b long"), "likely")
    wanted = likely.select(F.col("a").alias("doc_id")).union(likely.select("b")).distinct()
    members = docs.join(wanted, "doc_id", "left_semi").mapInArrow(_arrays(k), "doc_id long, members binary")
    members = stage(members.dropDuplicates(["doc_id"]), "members")
    side = lambda c: members.select(F.col("doc_id").alias(c), F.col("members").alias(f"s_{c}"))
    full = likely.join(side("a"), "a").join(side("b"), "b").select("a", "b", "s_a", "s_b")
    verified = stage(full.mapInArrow(_intersect(t), "a long, b long"), "verified")
    discard(likely, members)
    release()
    return verified


def _ranked(rows: DataFrame) -> DataFrame:
    """``rows`` and tile: sub-tiles of about TILE sets in order of set size.

    Only the distinct sizes of a tile are ranked; sets of one size share their ranks by hash."""
    sizes = rows.groupBy("key", "n").agg(F.count("*").alias("own"))
    before = F.coalesce(F.sum("own").over(W.partitionBy("key").orderBy("n").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    ranks = sizes.withColumn("before", before)
    rank = F.col("before") + F.pmod(F.xxhash64("doc_id"), F.col("own"))
    return rows.join(ranks, ["key", "n"]).withColumn("tile", F.floor(rank / TILE)).select(*rows.columns, "tile")


def jaccard_components(documents: DataFrame, k: int = 5, threshold: tuple[int, int] = (4, 5)) -> DataFrame:
    """doc_id, n_shingles, component_id: the smallest doc_id that links reach, itself included.

    ``threshold`` is a fraction; documents link when their sets' Jaccard similarity reaches it.
    A null or empty text has an empty set and links with nothing.  A text of fewer than k words
    is one shingle.  Rows that repeat a doc_id each give a row; they are expected to repeat the
    text too.  A null doc_id gives no links: the component is that of its
    copies, or null.  Other columns are ignored; an
    empty table gives an empty result."""
    t = Fraction(*threshold)
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    described = stage(docs.mapInArrow(_describe(k), _SET), "sets")
    # staged, so that the join is one of plain exchanges, which Spark splits where one set has a third of all rows
    first = stage(described.filter("n > 0 and doc_id is not null").groupBy("f1", "f2").agg(F.min("doc_id").alias("rep")), "firsts")
    rep = stage(described.select("doc_id", "n", "f1", "f2").join(first, ["f1", "f2"], "left").select("doc_id", "n", F.when(F.col("n") > 0, F.col("rep")).alias("rep")), "reps")
    discard(first)
    release()
    keyed = described.filter("bitmap is not null and doc_id is not null")
    dealt = docs.filter("doc_id is not null").mapInArrow(_deal(k, t), "key long, doc_id long")
    shared = dealt.repartition("key").sortWithinPartitions("key", "doc_id").mapInArrow(_shared_tiles, "key long, doc_id long, pivot long")
    shared = stage(shared, "tiles")
    release()
    of = rep.filter("rep is not null").select("doc_id", "rep").distinct()
    tiles = (
        shared.join(of.withColumnRenamed("rep", "x"), "doc_id")
        .join(of.select(F.col("doc_id").alias("pivot"), F.col("rep").alias("p")), "pivot")
        .filter("x <> p")
    )
    tiles = stage(tiles.select("key", "x", "p"), "stars")
    # a set's signature comes from any of its copies
    sets = stage(
        keyed.select("doc_id", "n", "bitmap").join(of, "doc_id").groupBy("rep").agg(F.min("n").alias("n"), F.min("bitmap").alias("bitmap")).withColumnRenamed("rep", "doc_id"),
        "signatures",
    )
    discard(described, shared)
    tried = stage(tiles.select(F.least("x", "p").alias("a"), F.greatest("x", "p").alias("b")).distinct(), "tried")
    links = _verify(tried, sets, docs, k, t)
    comp = components(links)
    # tiles that still hold more than one component; of tiles with the same members, one is enough
    members = tiles.select("key", F.col("x").alias("id")).union(tiles.select("key", F.col("p").alias("id"))).distinct()
    members = members.join(comp, "id", "left").select("key", "id", F.coalesce("component", "id").alias("comp"))
    open_tiles = (
        members.groupBy("key")
        .agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("size"), F.sum(F.xxhash64("id").cast("decimal(38,0)")).alias("sum"))
        .filter("lo <> hi")
        .groupBy("size", "sum")
        .agg(F.min("key").alias("key"))
    )
    rest = stage(members.join(open_tiles, "key").select("key", "size", F.col("id").alias("doc_id"), "comp").join(sets, "doc_id"), "open")
    discard(tiles)
    release()
    small = rest.filter(F.col("size") <= TILE).withColumn("tile", F.lit(0).cast("long"))
    big = _ranked(rest.filter(F.col("size") > TILE))
    cut = small.unionByName(big)
    last = F.floor((F.col("size") - 1) / TILE)
    with_tiles = cut.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    dealt = with_tiles.select("key", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"), "tile", "doc_id", "comp", "n", "bitmap")
    pairs, ends = "key long, i long, j long, x long, y long, likeness double", (F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    near = stage(dealt.groupBy("key", "i", "j").applyInArrow(_tile_pairs(t, nearest=True), pairs), "near")
    release()
    one = near.groupBy("x").agg(F.max(F.struct("likeness", "y")).alias("best")).select("x", "best.y")  # one a set, over all its tiles
    fresh = stage(one.select(*ends).distinct().join(tried, ["a", "b"], "left_anti"), "nearest")
    more = _verify(fresh, sets, docs, k, t)
    final = comp
    if not more.isEmpty():
        links = links.unionByName(more)
        final = components(links)
    # sub-tiles without a pair have no other; in the rest, all pairs of what are still different components
    again = dealt.drop("comp").join(near.select("key", "i", "j").distinct(), ["key", "i", "j"], "left_semi")
    again = again.join(final.withColumnRenamed("id", "doc_id"), "doc_id", "left").withColumn("comp", F.coalesce("component", "doc_id")).drop("component")
    found = again.groupBy("key", "i", "j").applyInArrow(_tile_pairs(t, nearest=False), pairs).select(*ends).distinct()
    rest = _verify(stage(found.join(tried.unionByName(fresh), ["a", "b"], "left_anti"), "found"), sets, docs, k, t)
    if not rest.isEmpty():
        final = components(links.unionByName(rest))
    out = rep.join(final.withColumnRenamed("id", "rep"), "rep", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "rep", "doc_id").alias("component_id"))
