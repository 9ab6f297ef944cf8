"""Tokenizing whole texts with the tokenizers library, each distinct piece once a worker.

Both vocabularies cut a text into pieces before the merges, and a piece's ids do not depend on
its neighbours.  For texts of code points below U+0300 the cuts are found for a whole chunk at
once; the library encodes each piece that the worker has not met, and the ids are put together
by position.  Any other text goes to the library as a whole.  Both ways give the library's ids.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factline.llm._common import _power, mix

#: Pieces that a worker remembers; when full it starts anew, which costs time, never ids.
MEMORY = 1_500_000
_LIMIT = 0x300
#: Characters cut at once.
_CHUNK = 2 << 20
_workers: dict[str, Encoder] = {}


def _classes() -> np.ndarray:
    """Of code points below the limit: 0 white space, 1 letter, 2 number, 3 other."""
    import regex

    text = "".join(map(chr, range(_LIMIT)))
    out = np.full(_LIMIT, 3, np.int8)
    for k, pattern in ((0, r"\s"), (1, r"\p{L}"), (2, r"\p{N}")):
        out[[m.start() for m in regex.finditer(pattern, text)]] = k
    return out


class Encoder:
    """One vocabulary file.  ``kind`` says how its file cuts texts: 'byte' keeps white space, 'word' drops it."""

    def __init__(self, path: str):
        import json
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True  # their strings in a text are ordinary text
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.kind = "word" if spec["model"].get("end_of_word_suffix") else "byte"
        if hasattr(self.library.model, "_resize_cache"):
            self.library.model._resize_cache(0)  # pieces come once: the library's own memory only costs time
        self.feed = np.uint32(spec["model"]["vocab"].get("\u010a", 0))
        self.closing = np.zeros(len(spec["model"]["vocab"]) + len(spec["added_tokens"]) + 1, bool)
        self.closing[[i for t, i in spec["model"]["vocab"].items() if t.endswith("</w>")]] = True
        self.classes = _classes()
        self.lower = np.array([ord(c) if len(c := chr(i).lower()) == 1 else 0xFFFF for i in range(_LIMIT)], np.uint32)
        self.power = np.cumprod(np.full(64, 0x9E3779B97F4A7C15, np.uint64), dtype=np.uint64)
        self._reset()

    @classmethod
    def of(cls, path: str) -> Encoder:
        if path not in _workers:
            _workers[path] = cls(path)
        return _workers[path]

    def _reset(self) -> None:
        self.known = np.zeros(0, np.uint64)  # hashes, sorted
        self.number = np.zeros(0, np.int32)
        self.ids = np.zeros(1 << 20, np.uint32)
        self.at = np.zeros(1 << 18, np.int64)
        self.n = np.zeros(1 << 18, np.int32)
        self.used = 0

    def _plain(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        out: list[np.ndarray | None] = [None] * len(texts)
        fast, size = [], 0
        for i, t in enumerate(texts):
            if not t:
                out[i] = np.zeros(0, np.uint32)
                continue
            fast.append(i)
            size += len(t)
            if size > _CHUNK or i == len(texts) - 1:
                self._chunk(texts, fast, out)
                fast, size = [], 0
        self._chunk(texts, fast, out)
        return out

    def _chunk(self, texts: list[str], which: list[int], out: list) -> None:
        if not which:
            return
        points = [np.frombuffer(texts[i].encode("utf-32-le", "surrogatepass"), np.uint32) for i in which]
        ok = [int(p.max()) < _LIMIT and not (self.kind == "word" and (p == 0x130).any()) for p in points]
        for i, good in zip(which, ok, strict=True):
            if not good:
                out[i] = self._plain(texts[i])
        points = [p for p, good in zip(points, ok, strict=True) if good]
        which = [i for i, good in zip(which, ok, strict=True) if good]
        if not which:
            return
        data = np.concatenate(points)
        offsets = np.r_[0, np.cumsum([len(p) for p in points])]
        if self.kind == "word":
            data = self.lower[data]
        start, end = self._pieces(data, offsets)
        numbers = self._numbers(data, start, end)
        n, at = self.n[numbers], self.at[numbers]
        total = np.r_[0, np.cumsum(n, dtype=np.int64)]
        flat = self.ids[np.repeat(at - total[:-1], n) + np.arange(total[-1])]
        edge = total[np.searchsorted(start, offsets)]
        for k, i in enumerate(which):
            out[i] = flat[edge[k] : edge[k + 1]]

    def _pieces(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of every piece that the file's pattern finds."""
        kind = self.classes[data]
        begin = np.ones(len(data), bool)
        begin[1:] = kind[1:] != kind[:-1]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        begin |= edge[:-1]
        run = begin.copy()  # runs of one class
        if self.kind == "word":
            begin |= kind == 2  # each number alone
        # contractions: an apostrophe that begins a run and, with 'byte', follows no blank
        tick = np.flatnonzero((data == 39) & run)
        if self.kind == "byte":
            before = (tick > 0) & (data[tick - 1] == 32) & ~edge[tick]
            tick = tick[~before]
            # a run of white space before other text ends one character early; a blank joins what follows
            after = np.flatnonzero(run[1:] & (kind[:-1] == 0) & ~edge[1:-1]) + 1
            begin[after - 1] = True
            begin[after[data[after - 1] == 32]] = False
        if len(tick):
            begin, tick = begin, tick[tick + 1 < len(data)]
            pad = np.r_[data, 0, 0]
            ends = np.r_[edge[:-1], True, True]
            a, b = pad[tick + 1], pad[tick + 2]
            one = np.isin(a, [ord(c) for c in "stmd"]) & ~ends[tick + 1]
            two = ~one & ~ends[tick + 1] & ~ends[np.minimum(tick + 2, len(data))] & (((a == 114) & (b == 101)) | ((a == 118) & (b == 101)) | ((a == 108) & (b == 108)))
            for hit, width in ((tick[one], 2), (tick[two], 3)):
                for j in range(1, width):
                    begin[hit + j] = False
                hit = hit[hit + width < len(data)]
                begin[hit + width] |= kind[hit + width] != 0 if self.kind == "word" else True
        start = np.flatnonzero(begin)
        end = np.append(start[1:], len(data))
        if self.kind == "word":
            keep = kind[start] != 0
            start, end = start[keep], end[keep]
        return start, end

    def _numbers(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The worker's number of each piece; pieces it has not met are encoded and remembered."""
        if len(start) == 0:
            return np.zeros(0, np.int64)
        up, down = _power(len(data))
        run = np.empty(len(data) + 1, np.uint64)
        run[0] = 0
        np.cumsum((data.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(0x2545F4914F6CDD1D)) * up[: len(data)], out=run[1:])
        h = mix((run[end] - run[start]) * down[start] + (end - start).astype(np.uint64))
        values, first, inverse = np.unique(h, return_index=True, return_inverse=True)
        if len(self.known) + len(values) > MEMORY:
            self._reset()
        place = np.searchsorted(self.known, values)
        number = np.full(len(values), -1, np.int64)
        if len(self.known):
            near = np.minimum(place, len(self.known) - 1)
            number = np.where(self.known[near] == values, self.number[near], -1).astype(np.int64)
        new = np.flatnonzero(number < 0)
        if len(new):
            where = first[new]
            text = data.astype("<u4").tobytes()
            words = [text[4 * a : 4 * b].decode("utf-32-le", "surrogatepass") for a, b in zip(start[where].tolist(), end[where].tolist(), strict=True)]
            number[new] = self._learn(words)
            self.known, self.number = np.insert(self.known, place[new], values[new]), np.insert(self.number, place[new], number[new])
        return number[inverse]

    def _lengths_and_ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of each piece.  Pieces go to the library in lines of many, told apart by the line
        feed's id, or by the mark on each word's last id; white space goes by itself."""
        n = np.zeros(len(words), np.int32)
        single = [i for i, w in enumerate(words) if w[-1].isspace() or not w.strip()]
        alone = [self._plain(words[i]) for i in single]
        lined = np.setdiff1d(np.arange(len(words)), single)
        lines = [[words[i] for i in lined[a : a + 400]] for a in range(0, len(lined), 400)]
        ids = [np.array(e.ids, np.uint32) for e in self.library.encode_batch_fast(["\n".join(x) for x in lines], add_special_tokens=False)]
        parts, lengths = [], []
        for line, x in zip(lines, ids, strict=True):
            if self.kind == "word":
                last = np.flatnonzero(self.closing[x])
                count = np.diff(last, prepend=-1)
            else:
                cut = np.flatnonzero(x == self.feed)
                count = np.diff(np.r_[-1, cut, len(x)]) - 1
                x = np.delete(x, cut)
            if len(count) != len(line) or count.sum() != len(x):
                one = [self._plain(w) for w in line]
                count, x = np.array([len(y) for y in one]), np.concatenate(one)
            parts.append(x), lengths.append(count)
        n[lined] = np.concatenate(lengths) if lengths else 0
        n[single] = [len(x) for x in alone]
        if not single:
            return n, np.concatenate(parts)
        flat = np.zeros(int(n.sum()), np.uint32)
        owner = np.repeat(np.isin(np.arange(len(words)), single), n)
        flat[~owner] = np.concatenate(parts) if parts else 0
        flat[owner] = np.concatenate(alone)
        return n, flat

    def _learn(self, words: list[str]) -> np.ndarray:
        n, flat = self._lengths_and_ids(words)
        base = len(self.known)
        while base + len(words) > len(self.at):
            self.at, self.n = np.r_[self.at, np.zeros_like(self.at)], np.r_[self.n, np.zeros_like(self.n)]
        while self.used + len(flat) > len(self.ids):
            self.ids = np.r_[self.ids, np.zeros_like(self.ids)]
        self.ids[self.used : self.used + len(flat)] = flat
        self.n[base : base + len(words)] = n
        self.at[base : base + len(words)] = self.used + np.cumsum(n) - n
        self.used += len(flat)
        numbers = np.arange(base, base + len(words))
        return numbers


def id_type(path: str) -> str:
    """Two bytes an id where the vocabulary allows, else four."""
    return "<u2" if Encoder.of(path).library.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4"


def _encode(path: str, end_id: int, name: str, dtype: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(path)
        for batch in batches:
            text = batch.schema.get_field_index("text")
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                ids = encoder.encode([t or "" for t in part.column(text).to_pylist()])
                packed = pa.array([np.append(x, np.uint32(end_id)).astype(dtype).tobytes() for x in ids], pa.binary())
                yield part.set_column(text, pa.field(name, pa.binary()), packed)

    return run


def encode_documents(documents: DataFrame, path: str, end_id: int, dtype: str = "<u4") -> DataFrame:
    """doc_id, ids: little-endian unsigned token ids (32-bit if not said otherwise) of the whole text, then ``end_id``.

    A null or empty text has only the end id.  Other columns are ignored."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(_encode(path, end_id, "ids", dtype), "doc_id long, ids binary")
