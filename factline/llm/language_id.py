"""Language ID by compression: the language whose dictionary packs a text smallest.

Each language has a raw-content zstandard dictionary made of whole labelled texts.  A text's
letters are lower-cased and compressed with each dictionary; the smallest result names the language.  Where
the runner-up is nearly as small, the answer is marked as rejected.

The dictionaries come from a bounded sample: for each language at most SAMPLE_ROWS texts, those
with the smallest hash of their doc_id, up to DICTIONARY_BYTES.  All other work covers all rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SAMPLE_ROWS = 200
DICTIONARY_BYTES = 64 << 10
#: More languages than this are an error, so that the models have a bound.
MAX_LANGUAGES = 256
MIN_MARGIN = 0.01
LEVEL = 5
_LETTER = regex.compile(r"\p{L}")
_OTHER = regex.compile(r"[^\p{L}]+")


def _letters(text: str) -> bytes:
    """What is compressed: lower-case letters, anything else as one blank."""
    return _OTHER.sub(" ", text.lower()).encode("utf-8", "replace")


def train(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS, dictionary_bytes: int = DICTIONARY_BYTES) -> dict[str, bytes]:
    """lang -> dictionary, from rows (doc_id, text, lang); rows without text or lang are left out."""
    rows = labelled.filter("text is not null and lang is not null and length(text) > 0")
    order = W.partitionBy("lang").orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id")
    # the window sees no texts, and Spark limits it before the shuffle
    picked = rows.select("doc_id", "lang").withColumn("k", F.row_number().over(order)).filter(F.col("k") <= sample_rows)
    counts = picked.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    ids = [r[0] for r in picked.select("doc_id").distinct().collect()]  # at most MAX_LANGUAGES * sample_rows
    chosen = rows.filter(F.col("doc_id").isin(ids)).select("lang", "text", F.xxhash64(F.col("doc_id").cast("string")).alias("h")).orderBy("h") if ids else None
    out: dict[str, list[bytes]] = {}
    size: dict[str, int] = {}
    for lang, text, _ in chosen.toLocalIterator() if chosen is not None else ():
        data = _letters(text)
        if size.get(lang, 0) + len(data) <= dictionary_bytes or lang not in out:
            out.setdefault(lang, []).append(data)
            size[lang] = size.get(lang, 0) + len(data)
    return {lang: b"\n".join(reversed(parts)) for lang, parts in sorted(out.items())}


def _classify(models: dict[str, bytes], min_margin: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard as z

        names = list(models)
        packers = []
        for name in names:
            d = z.ZstdCompressionDict(models[name], dict_type=z.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            packers.append(z.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_dict_id=False, write_checksum=False).compress)
        for batch in batches:
            lang, score, rejected = [], [], []
            for x in batch.column(1):
                text = x.as_py()
                if not text or not names or not _LETTER.search(text):
                    lang.append("und"), score.append(0.0), rejected.append(True)
                    continue
                data = _letters(text)
                sizes = [len(pack(data)) for pack in packers]
                best = min(range(len(sizes)), key=sizes.__getitem__)
                other = min((s for i, s in enumerate(sizes) if i != best), default=sizes[best] * 2)
                margin = 1 - sizes[best] / other
                lang.append(names[best]), score.append(max(0.0, min(1.0, margin))), rejected.append(margin < min_margin)
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(batch.schema)) if i != 1), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())], [*(n for i, n in enumerate(batch.schema.names) if i != 1), "lang_pred", "score", "rejected"])

    return run


def identify(documents: DataFrame, models: dict[str, bytes], min_margin: float = MIN_MARGIN) -> DataFrame:
    """doc_id, lang_pred, score (1 - smallest / next smallest size), rejected (score under ``min_margin``).

    A text that is null or has no letter gives 'und', score 0, rejected; so does any text if there
    are no models.  Equal sizes go to the first language by name, and are rejected.  Only the text
    is looked at; rows that repeat a doc_id each give a row.  An empty table gives an empty result."""
    kind = documents.schema["doc_id"].dataType.simpleString()
    docs = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(_classify(models, min_margin), f"doc_id {kind}, lang_pred string, score double, rejected boolean")
