"""Each operator against brute force, an exact round trip or held-out accuracy, and its edge cases."""

import hashlib
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from factline.llm import _common, decontaminate, html_extract, jaccard_join, language_id, packing, quality, queries, substring_dedup, token_counts, token_files, tokens, url_filters
from factline.llm.components import components

SPACE = re.compile("[^\x20\x09-\x0d]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, bitmap string, rep string, grp long"


def lower(x):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in x or "")


@pytest.fixture(scope="module")
def texts():
    """Prose, exact and near copies, shared passages, ties, nulls, empty and long texts."""
    rng = random.Random(11)
    vocabulary = ["".join(rng.choice("abcdéß") for _ in range(rng.randint(2, 7))) for _ in range(900)]
    make = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    out, passage = [], make(60)
    for k in range(150):
        w = make(rng.choice([1, 3, 4, 8, 14, 40, 120, 300]))
        if k % 6 == 0:
            at = rng.randint(0, len(w))
            w[at:at] = passage[rng.randint(0, 20) : rng.randint(35, 60)]
        out.append(w)
        for _ in range(rng.choice([0, 0, 0, 1, 4])):
            c = list(w)
            for _ in range(rng.choice([0, 1, 2, len(c) // 25, len(c) // 12])):
                c[rng.randrange(len(c))] = rng.choice(vocabulary)
            out.append(c)
    rows = [" ".join(w) if k % 3 else "\n".join(w).title() for k, w in enumerate(out)]
    rows += [None, "", "  \n", "AB", "ab", "x " * 30000, " ".join(make(9000)), "### $$$ &&& " * 20, "It's 1 <|endoftext|> İ中а́ 'll"]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(k, t, ["en", "fr", None][k % 3], f"s{k % 2}" if k % 5 else None, 1, "clash", "clash", 7) for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).persist()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize(("k", "t", "tile"), [(4, (85, 100), 512), (5, (4, 5), 3)])
def test_jaccard_components(docs, texts, k, t, tile, monkeypatch):
    monkeypatch.setattr(jaccard_join, "TILE", tile)
    sets = []
    for x in texts:
        w = SPACE.findall(lower(x))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    parent = list(range(len(sets)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and both * t[1] >= t[0] * (len(sets[i]) + len(sets[j]) - both) and both:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(docs, k, t).collect()}
    assert got == {i: (len(s), root(i)) for i, s in enumerate(sets)}


def test_bitmap_bound_never_cuts_a_link():
    from fractions import Fraction

    rng = np.random.default_rng(1)
    for _ in range(200):
        a = rng.integers(0, 1 << 60, rng.integers(1, 3000), dtype=np.uint64)
        b = np.unique(np.r_[a[: rng.integers(1, len(a) + 1)], rng.integers(0, 1 << 60, 40, dtype=np.uint64)])
        a = np.unique(a)
        both = len(np.intersect1d(a, b))
        maps = [np.frombuffer(jaccard_join.bitmap(x), np.uint64)[None] for x in (a, b)]
        t = Fraction(both, len(a) + len(b) - both)
        assert not both or jaccard_join._allowed(len(a), len(b), maps[0][0], maps[1][0], t)


def test_batches_are_small_whatever_the_rows(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes]), pa.array([batch.num_rows])], ["bytes", "n"])

    rows = spark.range(64).select(F.repeat(F.lit("x"), F.when(F.col("id") == 5, 9_000_000).otherwise(300_000).cast("int")).alias("text"))
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    found = _common.stage(rows.coalesce(1).mapInArrow(sizes, "bytes long, n long"), "sizes").collect()
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == before
    assert sum(r.n for r in found) == 64 and all(r.n <= 1 + _common.BATCH_BYTES // 300_000 for r in found)
    assert max(r.bytes for r in found) < 9_000_000 + 2 * _common.BATCH_BYTES


def test_components_of_a_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(90, 80), (5, 5), (7, 8)], "a long, b long")
    got = {r.id: r.component for r in components(links).collect()}
    assert got == dict.fromkeys(range(41), 0) | {80: 80, 90: 80}


def test_substring_dedup(docs, texts):
    words = [SPACE.findall(x or "") for x in texts]
    first = {}
    for i, w in enumerate(words):
        for j in range(len(w) - 12):
            first.setdefault(tuple(w[j : j + 13]), i)
    for r in substring_dedup.remove_repeats(docs, 13).collect():
        w = words[r.doc_id]
        gone = {p for j in range(len(w) - 12) if first[tuple(w[j : j + 13])] < r.doc_id for p in range(j, j + 13)}
        kept = [x for p, x in enumerate(w) if p not in gone]
        assert (r.n_words, r.n_removed, r.kept_sha256) == (len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest())
        assert SPACE.findall(r.kept_text or "") == kept
        assert {p for s in r.repeats for p in range(s.first_word, s.first_word + s.n_words)} == gone


def test_substring_dedup_with_many_groups(spark, docs, monkeypatch):
    """Groups and buckets beyond 2^17, as terabytes have: the same rows as with few."""
    docs = docs.filter("length(text) < 400 and doc_id < 120")
    few = sorted(map(tuple, substring_dedup.remove_repeats(docs).select("doc_id", "n_removed", "kept_sha256").collect()), key=str)
    monkeypatch.setattr(substring_dedup, "layout", lambda size: (1 << 20, 20))
    many = sorted(map(tuple, substring_dedup.remove_repeats(docs).select("doc_id", "n_removed", "kept_sha256").collect()), key=str)
    assert many == few and any(r[1] for r in few)


def test_substring_dedup_a_group_sends_a_bucket_one_row(docs, monkeypatch):
    """However a group's documents lie in the input: packets don't multiply with its chunks."""
    hits = substring_dedup._hits

    def once(key, rows):
        groups = rows.column("grp").to_pylist()
        assert len(groups) == len(set(groups))
        return hits(key, rows)

    want = sorted(map(tuple, substring_dedup.remove_repeats(docs).select("doc_id", "n_removed", "kept_sha256").collect()), key=str)
    monkeypatch.setattr(substring_dedup, "_hits", once)
    got = substring_dedup.remove_repeats(docs.repartition(7)).select("doc_id", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, got), key=str) == want and any(r[1] for r in want)


def test_substring_dedup_across_the_chunks_of_a_group(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "layout", lambda size: (1, 3))
    rows, passage = [], [f"p{i}" for i in range(13)]
    for k in range(4):
        words = [f"d{k}w{i}" for i in range(50_000)]  # a chunk each
        words[100 + k : 100 + k] = passage
        rows.append((k, " ".join(words)))
    assert len(rows[0][1]) > _common.CHUNK_BYTES / 2
    got = substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: [tuple(x) for x in r.repeats] for r in got} == {0: [], 1: [(101, 13)], 2: [(102, 13)], 3: [(103, 13)]}


def test_layout_keeps_packets_large():
    for size in (0, 1, 10**9, 30 * 10**9, 10**14):
        groups, bits = substring_dedup.layout(size)
        assert groups <= 1 << bits < 4 * groups and size / groups / (1 << bits) >= substring_dedup.PACKET_BYTES / 4 or size < 10**13
    assert substring_dedup.layout(10**14)[0] < 700_000


@pytest.mark.parametrize("block", [50_000, 3])
def test_decontamination(spark, docs, texts, block, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", block)
    pattern = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    words = [pattern.findall(lower(x)) for x in texts]
    long = [w for w in words if len(w) > 30]
    items = [(1, " ".join(long[0][3:20])), (2, " ".join(long[1][5:14])), (3, "zz " + " ".join(long[2][:12])), (4, None), (5, ""), (6, long[3][0]), (7, " ".join(long[0][3:20]))]
    windows = {}
    for i, t in items:
        w = pattern.findall(lower(t))
        for j in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[j : j + 10]), set()).add(str(i))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    for r in decontaminate.find_contamination(docs, benchmark, 10).collect():
        w, hit, found = words[r.doc_id], set(), set()
        for q, ids in windows.items():
            for j in range(len(w) - len(q) + 1):
                if tuple(w[j : j + len(q)]) == q:
                    hit |= set(range(j, j + len(q)))
                    found |= ids
        assert (r.n_words, {p for s in r.spans for p in range(s.first_word, s.first_word + s.n_words)}, set(r["items"])) == (len(w), hit, found)


def test_blocks_of_items_change_nothing(spark, monkeypatch):
    w = [f"w{i}" for i in range(40)]
    docs = [(1, " ".join(w)), (1, " ".join(w[:15])), (1, " ".join(w)), (2, "x y"), (2, None), (None, " ".join(w))]
    items = [("b", " ".join(w[2:16])), ("a", " ".join(w[2:16])), ("b", " ".join(w[9:25])), (None, "x y"), ("c", "x"), ("c", "y"), ("b", " ".join(w[2:16]))]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    results = []
    for block, sent in ((50_000, 10**6), (2, 3), (1, 10**6)):
        monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", block)
        monkeypatch.setattr(decontaminate, "SENT_TERMS", sent)
        rows = decontaminate.find_contamination(docs, benchmark, 10).collect()
        results.append(sorted((r.asDict(recursive=True) for r in rows), key=str))
    assert results[0] == results[1] == results[2]
    got = [(r["doc_id"], r["n_words"], [(s["first_word"], s["n_words"]) for s in r["spans"]], r["items"]) for r in results[0]]
    want = [(1, 15, [(2, 13)], ["a", "b"]), (1, 40, [(2, 23)], ["a", "b"]), (1, 40, [(2, 23)], ["a", "b"]), (2, 0, [], []), (2, 2, [(0, 2)], ["c"]), (None, 40, [(2, 23)], ["a", "b"])]
    assert sorted(got, key=str) == want


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "one two x three four"), (2, "one y y y two three four")], "doc_id long, text string")
    q = spark.createDataFrame([("a", "one two three four")], "item_id string, text string")
    found = lambda slop: {r.doc_id for r in decontaminate.find_contamination(docs, q, 4, slop).collect() if r["items"]}
    assert (found(0), found(1), found(3)) == (set(), {1}, {1, 2})


def test_quality(docs, texts):
    for r in quality.judge(docs).collect():
        x = texts[r.doc_id] or ""
        w = SPACE.findall(x)
        c = Counter(tuple(w[j : j + 5]) for j in range(len(w) - 4))
        twice = {p for j in range(len(w) - 4) if c[tuple(w[j : j + 5])] > 1 for p in range(j, j + 5)}
        lines = [line for line in x.split("\n") if SPACE.search(line)]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), sum(ch in "#*$%&|<>" for ch in x), len(lines) - len(set(lines)), len(twice))
        assert r.base_failed == (len(w) < 10 or 100 * len(twice) > 20 * len(w)) and (not r.kept or not r.base_failed)


def test_sketches_merge_to_close_quartiles(spark):
    values = [int(random.Random(i).lognormvariate(6, 1)) for i in range(3000)]
    df = spark.createDataFrame([(i % 7, v) for i, v in enumerate(values)], "g int, v long")
    q = quality.quartiles(quality.merge(quality.sketch(df.withColumn("a", F.lit(1)), ["g", "a"]), ["a"]), ["a"]).first()
    for p, got in ((0.25, q.q25), (0.75, q.q75)):
        exact = sorted(values)[int(p * len(values))]
        assert exact * 30 / 32 - 1 <= got <= exact * 33 / 32


def test_packing(docs, texts):
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = packing.pack_documents(docs, path, 64, 1).collect()
    library = tokens.Encoder(path).library
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for i, t in enumerate(texts):
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        got = sorted(by_doc[i], key=lambda r: r.piece)
        assert [(r.piece, r.start, r.length, r.ids_crc32) for r in got] == [(k, a, len(ids[a : a + 64]), zlib.crc32(ids[a : a + 64].tobytes())) for k, a in enumerate(range(0, len(ids), 64))]
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 64
    assert len(by_sequence) <= 1.02 * -(-sum(r.length for r in rows) // 64) + 1


def test_plan_places_everything_once():
    rng = random.Random(2)
    for gen in (lambda: rng.randint(1, 100), lambda: rng.randint(30, 60), lambda: rng.choice([33, 34, 67]), lambda: 1):
        counts = Counter(gen() for _ in range(1500))
        n, entries = packing.plan(counts, 100)
        room, ranks = Counter(), {}
        for length, rank, k, first, q, _ in entries:
            for i in range(k):
                room[first + i // q] += length
                ranks.setdefault(length, []).append(rank + i)
        assert max(room.values()) <= 100 and len(room) == n and all(sorted(ranks[x]) == list(range(c)) for x, c in counts.items())


def best_fit_decreasing(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        room = min((r for r in rooms if r >= n), default=None)
        if room is not None:
            rooms.remove(room)
        rooms.append((capacity if room is None else room) - n)
    return len(rooms)


@pytest.mark.parametrize(("low", "high", "slack"), [(600, 1500, 0.01), (1100, 2500, 0.01), (1, 4096, 0.03), (30, 60, 0.0)])
def test_plan_needs_few_sequences(low, high, slack):
    """No more than best-fit decreasing or filling pattern by pattern, and near the lower bound."""
    rng = random.Random(low)
    lengths = [rng.randint(low, high) for _ in range(1000)]
    counts = Counter(lengths)
    n, _ = packing.plan(counts, 4096)
    by_fill = sum(times for _, times in packing.fills(counts, 4096))
    simple = best_fit_decreasing(lengths, 4096)
    assert -(-sum(lengths) // 4096) <= n <= min(by_fill, simple) and n <= (1 + slack) * -(-sum(lengths) // 4096) + 1
    assert low < 600 or n < simple


def test_configurations_solve_the_program():
    """The textbook case: 97 of 45, 610 of 36, 395 of 31, 211 of 14 from rolls of 100 need 452.25 rolls."""
    found = packing.optimise([45, 36, 31, 14], [97, 610, 395, 211], 100)
    used = Counter()
    for config, times in found:
        assert sum((45, 36, 31, 14)[g] for g in config) <= 100
        used.update({g: times * c for g, c in Counter(config).items()})
    assert all(used[g] <= d for g, d in enumerate([97, 610, 395, 211])) and 449 <= sum(t for _, t in found) <= 453


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_tokens_are_the_librarys(name, texts):
    rng = random.Random(4)
    odd = ["".join(rng.choice("'std revlm a1.\n \t éÉß") for _ in range(rng.randint(0, 25))) for _ in range(1500)]
    encoder = tokens.Encoder(public_tokenizers.path(name))
    every = [t or "" for t in texts] + odd
    for t, got in zip(every, encoder.encode(every), strict=True):
        assert got.tolist() == encoder.library.encode(t, add_special_tokens=False).ids


def test_token_file_round_trip(spark, docs, texts, tmp_path):
    path = public_tokenizers.path("byte_bpe_50k.json")
    token_files.encode_corpus(docs, path, f"{tmp_path}/file", 0)
    library, start = tokens.Encoder(path).library, 0
    got = {r.doc_id: r for r in token_files.read_token_file(spark, f"{tmp_path}/file").collect()}
    for i, t in enumerate(texts):
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4").tobytes()
        r = got[i]
        assert (r.start, r.n_tokens, r.ids_crc32, bytes(r.ids)) == (start, len(ids) // 4, zlib.crc32(ids), ids)
        start += len(ids) // 4


def test_block_sections_and_corruption():
    rng = np.random.default_rng(3)
    ids = np.minimum(rng.geometric(0.01, 700_000), 5000).astype(np.uint32)
    table = token_files.Table(token_files.make_table(*np.unique(ids, return_counts=True)))
    data = token_files.encode_block([1, None], np.array([len(ids) - 5, 5]), ids, table)
    block = token_files.Block(data, table)
    assert block.sections() > 2 and (block.decode() == ids).all() and block.doc_ids == [1, None]
    assert (np.concatenate([block.decode(k) for k in range(block.sections())]) == ids).all()
    for at in (10, len(data) // 2, len(data) - 1):
        with pytest.raises(token_files.CorruptBlock):
            token_files.Block(data[:at] + bytes([data[at] ^ 1]) + data[at + 1 :], table)


@pytest.mark.parametrize("size", [1 << 20, 37, 1])
def test_token_counts(spark, size, tmp_path):
    rng = random.Random(size)
    lengths = [rng.choice([0, 1, 5, 40, 200]) for _ in range(60 if size > 1 else 12)]
    rows = [(i, bytearray(np.array([*[7] * n, 9], "<u4").tobytes())) for i, n in enumerate(lengths)]
    token_counts.write_flat(spark.createDataFrame(rows, "doc_id long, ids binary").repartition(3), f"{tmp_path}/flat", size)
    flat = spark.read.parquet(f"{tmp_path}/flat")
    got = sorted((r.ordinal, r.start, r.n_tokens, r.closed) for r in token_counts.count_tokens(flat, 9).collect())
    ends = np.cumsum([n + 1 for n in lengths])
    assert got == [(i, int(e) - n - 1, n + 1, True) for i, (e, n) in enumerate(zip(ends, lengths, strict=True))]
    tail = spark.createDataFrame([(10**9, 0, bytearray(np.array([7, 7], "<u4").tobytes()))], flat.schema)
    more = token_counts.count_tokens(flat.unionByName(tail), 9).filter("not closed").collect()
    assert [(r.ordinal, r.start, r.n_tokens) for r in more] == [(len(lengths), int(ends[-1]), 2)]


def test_flat_files_name_every_document(spark, docs, texts, tmp_path):
    path = public_tokenizers.path("byte_bpe_50k.json")
    dtype = token_counts.tokenize_flat(docs, path, 50256, f"{tmp_path}/flat", 1000)
    flat = spark.read.parquet(f"{tmp_path}/flat")
    n = {r.ordinal: r.n_tokens for r in token_counts.count_tokens(flat.filter("data is not null"), 50256, dtype).collect()}
    got = {r.doc_id: n[r.ordinal] for r in token_counts.document_order(flat).collect()}
    library = tokens.Encoder(path).library
    want = {i: len(library.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in enumerate(texts)}
    assert got == want
    assert {r.doc_id: r.ordinal for r in token_counts.document_order(flat).collect()} == {i: i for i in want}


def test_flat_files_do_not_depend_on_the_split(spark, tmp_path):
    rows = [(k % 5 if k % 7 else None, f"w{k} " * (k % 4)) for k in range(30)] + [(4, None), (4, "")]
    df, results = spark.createDataFrame(rows, "doc_id long, text string"), []
    for n in (1, 4):
        token_counts.tokenize_flat(df.repartition(n), public_tokenizers.path("byte_bpe_50k.json"), 50256, f"{tmp_path}/{n}", 16)
        flat = spark.read.parquet(f"{tmp_path}/{n}")
        counts = token_counts.count_tokens(flat.filter("data is not null"), 50256, "<u2")
        found = counts.join(token_counts.document_order(flat), "ordinal").select("ordinal", "doc_id", "start", "n_tokens")
        results.append(sorted(map(tuple, found.collect())))
    assert results[0] == results[1] and len(results[0]) == len(rows)
    assert [r[1] for r in results[0]] == sorted((i for i, _ in rows), key=lambda i: -1 if i is None else i)


def test_language_accuracy_and_undetermined(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = queries.op1_language_id(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in out) >= 0.97 * len(out) and all(0 <= r.score <= 1 for r in out)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "123 $$"), (4, "a")], "doc_id long, text string")
    got = {r.doc_id: r.lang_pred for r in language_id.identify(odd, {"x": b"abc", "y": b"def"}).collect()}
    assert [got[k] for k in (1, 2, 3)] == ["und"] * 3 and got[4] in ("x", "y")


def test_html(spark):
    page = "<html><body><nav><a href=/>Menu</a></nav><div id='cookie-notice'>C</div><article><h1>T</h1><p>A <b>b</b>c<script>x<p></script> d<br>e &lt;p&gt; &eacute;<p>q<ul><li>1<li>2</ul><form>f</form><section class='comments'>z</section></article><footer>F</footer>"
    generic = [f"<body><div class='top'>Same words everywhere</div><div class='body'><p>text {i}</p><p>more {i * i}</p></div>" for i in range(6)]
    rows = [(1, "http://a.b/x", page), (2, None, None), (3, "x", ""), *[(10 + i, f"https://c.d/{i}", g) for i, g in enumerate(generic)]]
    got = {r.page_id: r for r in html_extract.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[1].text == "T\n\nA bc d e <p> é\n\nq\n\n1\n\n2" and got[1].n_chars == len(got[1].text)
    assert got[2].text == got[3].text == ""
    assert [got[10 + i].text for i in range(6)] == [f"text {i}\n\nmore {i * i}" for i in range(6)]


def test_html_keeps_near_copies_and_articles(spark):
    shared = [f"shared paragraph number {k} of the story" for k in range(9)]
    ps = lambda own: "".join(f"<p>{t}</p>" for t in own)
    copies = [[*shared, f"ending number {i} of the same story"] for i in range(30)]
    rows, want = [], {}
    for i in range(3):
        rows.append((i, "http://near.a/", f"<body><article>{ps(copies[i])}</article></body>"))
        rows.append((10 + i, "http://near.b/", f"<body>{ps(copies[i])}</body>"))
        want[i] = want[10 + i] = "\n\n".join(copies[i])
        rows.append((20 + i, "http://head.a/", f"<body><article><h2>Summary</h2><p>a text of its own {i}</p></article></body>"))
        want[20 + i] = f"Summary\n\na text of its own {i}"
    for i in range(30):
        rows.append((100 + i, "http://many.a/", f"<body>{ps(copies[i])}</body>"))
        want[100 + i] = "\n\n".join(copies[i])
    for i in range(4):
        own = [f"page {i} has its own text {k}" for k in range(10)]
        rows.append((200 + i, "http://many.a/", f"<body>{ps(own)}</body>"))
        want[200 + i] = "\n\n".join(own)
    got = html_extract.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert {r.page_id: r.text for r in got.collect()} == want


def test_html_tells_siblings_of_one_style_apart(spark):
    notice = "".join(f"<p>notice {k}</p>" for k in range(9))
    one = [f"<body><div>{notice}</div><div><p>the story of page {i}, longer than every notice put together on it, by far and wide</p></div></body>" for i in range(5)]
    many = [f"<body><div><p>notice</p></div><div>{''.join(f'<p>story {i} part {k} of it</p>' for k in range(i + 1))}</div></body>" for i in range(5)]
    rows = [*[(i, "http://one.a/", x) for i, x in enumerate(one)], *[(10 + i, "http://many.a/", x) for i, x in enumerate(many)]]
    got = {r.page_id: r.text for r in html_extract.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [got[i] for i in range(5)] == [f"the story of page {i}, longer than every notice put together on it, by far and wide" for i in range(5)]
    assert [got[10 + i] for i in range(5)] == ["\n\n".join(f"story {i} part {k} of it" for k in range(i + 1)) for i in range(5)]


def merged_tree(pages, gamma):
    """The importance of all branches of one host's pages, merged one by one: {(steps from the root): importance}."""
    from math import log

    seen, texts, ways = Counter(), {}, {}
    for page in pages:
        below = {}
        for k in page.judged():
            e, child = page.owner[k], ("", k)
            while child not in below.setdefault(e, []):
                below[e].append(child)
                e, child = page.parents[e], (page.styles[e], e)
                if child[1] == 0:
                    break

        def walk(e, at):
            seen[at] += 1
            names = [name for name, _ in below[e]]
            steps = tuple(n for i, n in enumerate(names) if i == 0 or n != names[i - 1])
            ways.setdefault(at, Counter())[steps] += 1
            run, j = 0, 0
            for i, (name, x) in enumerate(below[e]):
                if i:
                    run, j = (run, j + 1) if name == names[i - 1] else (run + 1, 0)
                here = (*at, (steps, run, j))
                if name:
                    walk(x, here)
                else:
                    seen[here] += 1
                    texts.setdefault(here, Counter())[page.text[x]] += 1

        if below:
            walk(0, ())
    out = {}

    def spread(counts, m):
        return sum(k / m * log(k) / log(m) for k in counts.values()) if m > 1 else 0.0

    for at in sorted(seen, key=len, reverse=True):
        m = seen[at]
        if at in texts:
            out[at] = 1 - spread(texts[at], m) * (1 - 1 / m**2)
            continue
        total, share = 0.0, gamma ** len(ways[at])
        for steps, k in ways[at].items():
            own = [x for x in seen if len(x) == len(at) + 1 and x[:-1] == at and x[-1][0] == steps]
            total += k / m * sum(seen[x] * out[x] for x in own) / sum(seen[x] for x in own)
        out[at] = (1 - share) * (1 - spread(ways[at], m)) + share * total
    return out


def test_style_tree_against_brute_force(spark):
    rng = random.Random(8)
    markup = []
    for i in range(12):
        menu = "".join(f"<a>{x}</a> <b>!</b>" for x in ("home", "news"))
        story = "".join(rng.choice([f"<p>own {i} {j}</p>", f"<ul><li>item {rng.randint(0, 3)}<li>x</ul>", "<p>told everywhere</p>", f"loose text {rng.randint(0, 2)}<br>"]) for j in range(rng.randint(1, 5)))
        side = rng.choice(["", "<div class=x><p>see too</p><p>and this</p></div>", f"<div class=x><p>see {i}</p></div>"])
        deep = "<div>" * (i % 4) + f"<span>deep {i % 2}</span>" + "</div>" * (i % 4)
        markup.append(f"<body><div class=top>{menu}</div><div class=mid>{story}</div>{side}{deep}</body>")
    df = spark.createDataFrame([(i, f"http://h.x/{i}", m) for i, m in enumerate(markup)], "page_id long, url string, html string")
    want = merged_tree([html_extract.Page(m) for m in markup], html_extract.GAMMA)
    got = html_extract.style_tree(df).collect()
    assert sorted(round(r.importance, 9) for r in got) == sorted(round(x, 9) for x in want.values())
    assert sum(r.leaf for r in got) == sum(not any(y[: len(x)] == x and y != x for y in want) for x in want)


def test_tree_decides_where_no_element_names_the_article(spark, monkeypatch):
    """Branches that every page fills alike go, with what little they have of their own; the tree off, they stay."""
    rows, want = [], {}
    for i in range(8):
        menu = "".join(f"<li>entry {k}" for k in range(6))
        foot = "".join(f"<p>imprint line {k}</p>" for k in range(12)) + f"<p>page built at 10:0{i}</p>"
        story = [f"the story of page {i}, told in part {k}, in words that no other page has" for k in range(2 + i % 3)]
        rows.append((i, "http://plain.x/", f"<body><div><ul>{menu}</ul></div><div>{''.join(f'<p>{t}</p>' for t in story)}</div><table><tr><td>{foot}</table></body>"))
        want[i] = "\n\n".join(story)
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"node": F.lit(1), "host": F.lit("clash"), "low": F.lit(2), "text": F.lit("t")})
    results = []
    for most in (html_extract.SENT_NODES, 0):
        monkeypatch.setattr(html_extract, "SENT_NODES", most)
        results.append({r.page_id: r.text for r in html_extract.extract_text(df.union(df)).collect()})
    assert results[0] == results[1] == want
    off = {r.page_id: r.text for r in html_extract.extract_text(df, threshold=-1.0).collect()}
    assert all(off[i] != want[i] for i in want)


def test_tile_keys_are_short_and_similar_sets_still_meet():
    rng = np.random.default_rng(5)
    table = jaccard_join.bands(Fraction(4, 5))
    for n in (3, 20, 150, 900):
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        b = np.unique(np.r_[a[: len(a) - n // 10], rng.integers(0, 1 << 63, n // 10, dtype=np.uint64)])
        x, y = (jaccard_join.tile_keys(u, table) for u in (a, b))
        assert max(x.max(), y.max()) < 1 << 48 and len(np.intersect1d(x, y))


def test_tree_judges_articles_too(spark, monkeypatch):
    """What every page of a host has at one place of its article goes; headings, cells and lists of what stays do not, and no article is emptied."""
    rows, want = [], {}
    for i in range(12):
        story = [f"the story of page {i}, told in part {k}, in words that no other page has" for k in range(2 + i % 3)]
        table = f"<table><tr><th>Name<td>name {i}</table>"
        box = "<div><h3>More from us</h3><p>Get our letter every day</p><ul><li>by post<li>by wire</ul></div>"
        page = f"<body><article><h1>title {i}</h1>{box}<h2>Summary</h2><section>{''.join(f'<p>{t}</p>' for t in story)}</section>{table}</article><p>outside {i}</p></body>"
        rows.append((i, "http://inside.x/", page))
        want[i] = "\n\n".join([f"title {i}", "Summary", *story, "Name", f"name {i}"])
        rows.append((20 + i, "http://alike.x/", f"<body><div>{' '.join(story)} and so on</div><main><p>Come back later</p></main></body>"))
        want[20 + i] = "Come back later"
        if i < 9:  # too few pages
            rows.append((40 + i, "http://few.x/", page))
            want[40 + i] = "\n\n".join([f"title {i}", "More from us", "Get our letter every day", "by post", "by wire", "Summary", *story, "Name", f"name {i}"])
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for most in (html_extract.SENT_NODES, 0):
        monkeypatch.setattr(html_extract, "SENT_NODES", most)
        assert {r.page_id: r.text for r in html_extract.extract_text(df).collect()} == want
    off = {r.page_id: r.text for r in html_extract.extract_text(df, threshold=-1.0).collect()}
    assert {i for i in want if off[i] != want[i]} == set(range(12))


def test_names_do_not_rule_out_what_holds_the_text(spark):
    cases = [
        "<div class='layout no-sidebar'><article><p>the text</p></article></div>", "<form id=aspnetForm><article><p>the text</p></article><input value=x></form>", "<div class='post comments-open'><p>the text</p></div>",
        "<div class=has-header><p>the text</p></div>", "<div class='ad-free'><p>the text</p></div>", "<div id=search-results><p>the text</p></div>", "<article><p class='share-price'>the text</p></article>",
        "<form id=aspnetForm><div><p>the text</p></div></form>", "<div class=search><main><p>the text</p><div class='ad-banner'>buy</div></main></div><div class=related><article>more</article></div>",
        "<article><header class=entry-header>the text</header><div class='comment-list'><article>me too</article></div><p hidden>no</p></article><div id=siteFooter>f</div>", "<div>" * 5000 + "the text" + "</div>" * 5000,
        "<div class=main-nav>menu</div><div><p>the text</p></div><div class='cookie_notice'>c</div><section class=comments><p>me</p></section>",
    ]
    df = spark.createDataFrame([(i, f"http://h{i}.x/", f"<body>{c}</body>") for i, c in enumerate(cases)], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_extract.extract_text(df).collect()}
    assert got == dict.fromkeys(range(len(cases)), "the text")


def test_url_filters(spark):
    entries = spark.createDataFrame([("domain", "b.c", "2024-01-10", "add"), ("domain", "b.c", "2024-03-05", "remove"), ("domain", "b.c", "2024-03-05", "add"), ("prefix", "x.y/p", "2024-02-01", "add"), ("host", "x.y", "2024-02-03", "remove"), (None, "q", "2024-01-01", "add")], "kind string, pattern string, day string, action string").withColumn("day", F.to_date("day"))
    cases = [("http://u@A.b.c:80/z?q", "2024-01-10", True), ("//b.c", "2024-01-09", False), ("https://b.c/", "2024-03-04", True), ("https://b.c/", "2024-03-05", False), ("http://ab.c", "2024-02-01", False), ("http://x.y/p/r", "2024-06-01", True), ("http://x.y/pq", "2024-06-01", False), (None, "2024-06-01", False), ("no url", "2024-06-01", False), ("http://b.c", None, False)]
    captures = spark.createDataFrame([(i, u, d) for i, (u, d, _) in enumerate(cases)], "page_id long, url string, fetched string").withColumn("fetched", F.to_date("fetched"))
    got = {r.page_id: r.blocked for r in url_filters.filter_urls(captures, entries).collect()}
    assert got == {i: b for i, (_, _, b) in enumerate(cases)}


def test_patterns_of_any_depth(spark):
    labels, steps = ".".join(f"l{i}" for i in range(40)), "/".join(f"s{i}" for i in range(40))
    entries = spark.createDataFrame([("domain", labels, "2024-01-01", "add"), ("prefix", f"h.x/{steps}", "2024-01-01", "add")], "kind string, pattern string, day string, action string").withColumn("day", F.to_date("day"))
    cases = [(f"http://a.{labels}/", True), (f"http://{labels}", True), (f"http://{labels[1:]}", False), (f"http://h.x/{steps}/more", True), (f"http://h.x/{steps}9", False)]
    captures = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(cases)], "page_id long, url string").withColumn("fetched", F.to_date(F.lit("2024-05-01")))
    got = {r.page_id: r.blocked for r in url_filters.filter_urls(captures, entries).collect()}
    assert got == {i: b for i, (_, b) in enumerate(cases)}
    clash = captures.withColumns({"kind": F.lit("x"), "pattern": F.lit("y"), "key": F.lit(1), "at": F.lit("z")})
    again = url_filters.filter_urls(clash.union(clash), entries)
    assert again.count() == 2 * len(cases) and again.filter("blocked").count() == 6
    assert url_filters.filter_urls(captures, entries.limit(0)).filter("blocked").count() == 0
    assert url_filters.filter_urls(captures.limit(0), entries).count() == 0


def test_empty_tables(spark, empty, tmp_path):
    path = public_tokenizers.path("byte_bpe_50k.json")
    token_files.encode_corpus(empty, path, f"{tmp_path}/none", 0)
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    benchmark = spark.createDataFrame([], "item_id long, text string")
    results = [
        jaccard_join.jaccard_components(empty), substring_dedup.remove_repeats(empty), decontaminate.find_contamination(empty, benchmark), quality.judge(empty), packing.pack_documents(empty, path),
        token_files.read_token_file(spark, f"{tmp_path}/none"), language_id.identify(empty, language_id.train(empty)), html_extract.extract_text(pages),
    ]
    assert [r.count() for r in results] == [0] * len(results)


def test_repeated_rows_and_missing_ids(spark):
    text = " ".join(f"w{i}" for i in range(40))
    df = spark.createDataFrame([(1, text), (1, text), (2, text), (None, text), (3, None)], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in jaccard_join.jaccard_components(df).collect()) == [(0, 1), (1, 1), (1, 1), (2, 1), (3, 3)]
    assert sorted((r.doc_id or 0, r.n_removed) for r in substring_dedup.remove_repeats(df).collect()) == [(0, 0), (1, 0), (1, 0), (2, 40), (3, 0)]
    nameless = substring_dedup.remove_repeats(df.filter("doc_id is null")).first()
    assert (nameless.n_words, nameless.kept_text) == (40, text)
    path = public_tokenizers.path("word_bpe_49k.json")
    assert packing.pack_documents(df, path).count() == 5
