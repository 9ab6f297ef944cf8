"""Quality rules with adaptive thresholds from mergeable quantile sketches.

Every text is measured once.  Each measure's distribution over a language and source is kept as
a histogram sketch with cells of 1/256 relative width: two sketches merge by adding cells, in any
order and with the same result, so partial counts travel instead of rows, and the sketches of a
language or of everything are sums of the finer ones.  A document fails a measure beyond
``q75 + REACH * max(q75 - q25, spread)`` of its own group (or below the mirrored fence, where low
values are bad too); a group of fewer than MIN_ROWS documents uses its language's sketch, or that
of all documents.  Thresholds are joined back to the measures.

Everything is DataFrame functions: no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from factline.llm._common import stage

SPACE = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
REPEAT_PERCENT = 20
MIN_ROWS = 50
REACH = 5
#: measure, in thousandths: (least spread, whether low values are bad too).  The least spread decides only where
#: more than half of a group has the same value, as with measures that are mostly 0.
MEASURES = {"word_length": (150, True), "symbols_per_word": (40, False), "repeated_lines": (60, False)}
#: Groups whose thresholds are sent to every executor, some 100 bytes each; more are joined.
SENT_GROUPS = 100_000


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is worked out once."""
    return F.transform(F.array(value), body)[0]


def _windows(words: Column, of) -> Column:
    return F.when(F.size(words) >= WINDOW, F.transform(F.sequence(F.lit(1), F.size(words) - (WINDOW - 1)), of))


def _repeated_words(words: Column) -> Column:
    """Words inside windows whose exact word sequence comes twice or more."""

    def covered(sorted_windows: Column) -> Column:
        n = F.size(sorted_windows)
        pairs = F.zip_with(
            F.slice(sorted_windows, F.lit(1), n - 1),
            F.slice(sorted_windows, F.lit(2), n - 1),
            lambda a, b: F.when(a["s"] == b["s"], F.array(a["i"], b["i"])).otherwise(F.expr("cast(array() as array<int>)")),
        )
        places = F.array_sort(F.array_distinct(F.flatten(pairs)))
        start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
        return F.aggregate(places, start, lambda acc, p: F.struct((acc["n"] + p + WINDOW - F.greatest(p, acc["end"])).cast("long").alias("n"), (p + WINDOW).alias("end")), lambda acc: acc["n"])

    exact = _windows(words, lambda i: F.struct(F.array_join(F.slice(words, i, WINDOW), " ").alias("s"), i.alias("i")))
    return _let(F.array_sort(exact), covered)


def measure(documents: DataFrame) -> DataFrame:
    """doc_id, lang, source, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, base_failed."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    docs = documents.select("doc_id", F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"), text.alias("text"))
    docs = docs.withColumn("words", F.array_remove(F.split("text", SPACE), ""))
    docs = docs.withColumn("lines", F.filter(F.split("text", "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")))
    docs = docs.withColumn("prints", _windows(F.col("words"), lambda i: F.xxhash64(F.slice("words", i, WINDOW))))
    # equal windows have equal prints: without equal prints nothing repeats
    repeats = F.col("prints").isNotNull() & (F.size(F.array_distinct("prints")) < F.size("prints"))
    out = docs.select(
        "doc_id",
        "lang",
        "source",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.translate("text", " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(repeats, _repeated_words(F.col("words"))).otherwise(F.lit(0).cast("long")).alias("n_repeat_words"),
    )
    return out.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")))


def _thousandths() -> dict[str, Column]:
    share = lambda a, b: F.floor(1000 * F.col(a) / F.greatest(F.col(b), F.lit(1))).cast("long")
    return {"word_length": share("word_chars", "n_words"), "symbols_per_word": share("n_symbols", "n_words"), "repeated_lines": share("n_dup_lines", "n_lines")}


def cell(v: Column) -> Column:
    """The lower end of the sketch's cell: exact below 512, then 1/256 of the value wide at most."""
    shift = F.greatest(F.length(F.bin(v)) - 9, F.lit(0))
    return F.floor(v / F.pow(F.lit(2.0), shift)).cast("long") * F.pow(F.lit(2.0), shift).cast("long")


def sketch(values: DataFrame, keys: list[str], value: str = "v") -> DataFrame:
    """keys, cell, n: one sketch per key; partial counts are added before rows move."""
    return values.groupBy(*keys, cell(F.col(value)).alias("cell")).agg(F.count("*").alias("n"))


def merge(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """The sum of all sketches that agree in ``keys``."""
    return sketches.groupBy(*keys, "cell").agg(F.sum("n").alias("n"))


def quartiles(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """keys, n, q25, q75: the cells in which those ranks fall."""
    upto = W.partitionBy(*keys).orderBy("cell").rowsBetween(W.unboundedPreceding, 0)
    ranked = sketches.withColumn("upto", F.sum("n").over(upto)).withColumn("all", F.sum("n").over(W.partitionBy(*keys)))
    at = lambda p: F.min(F.when(F.col("upto") * 4 >= F.col("all") * p, F.col("cell")))
    return ranked.groupBy(*keys).agg(F.max("all").alias("n"), at(1).alias("q25"), at(3).alias("q75"))


def thresholds(measures: DataFrame) -> DataFrame:
    """lang, source, and for each measure lo_<measure> and hi_<measure> (thousandths)."""
    each = F.array(*[F.struct(F.lit(k).alias("measure"), v.alias("v")) for k, v in _thousandths().items()])
    long = measures.filter("not base_failed").select("lang", "source", F.explode(each).alias("m")).select("lang", "source", "m.measure", "m.v")
    fine = stage(sketch(long, ["lang", "source", "measure"]), "sketches")
    per = lambda keys, s: quartiles(merge(fine, keys) if s else fine, keys).select(*keys, *[F.col(c).alias(f"{c}_{s}") for c in ("n", "q25", "q75")])
    own = quartiles(fine, ["lang", "source", "measure"])
    both = own.join(per(["lang", "measure"], "lang"), ["lang", "measure"]).join(per(["measure"], "all"), "measure")
    pick = lambda c: F.when(F.col("n") >= MIN_ROWS, F.col(c)).when(F.col("n_lang") >= MIN_ROWS, F.col(f"{c}_lang")).otherwise(F.col(f"{c}_all"))
    both = both.select("lang", "source", "measure", pick("q25").alias("q25"), pick("q75").alias("q75"))
    aggs = []
    for name, (spread, _) in MEASURES.items():
        reach = REACH * F.greatest(F.col("q75") - F.col("q25"), F.lit(spread))
        here = F.col("measure") == name
        aggs += [F.max(F.when(here, F.col("q25") - reach)).alias(f"lo_{name}"), F.max(F.when(here, F.col("q75") + reach)).alias(f"hi_{name}")]
    return both.groupBy("lang", "source").agg(*aggs)


def judge(documents: DataFrame) -> DataFrame:
    """The columns of measure() and ``kept``: false if the base rules or a threshold reject the document.

    A null text counts as empty (no words: fails); a null lang or source counts as ''.  Rows that
    repeat a doc_id are judged each by itself.  A group whose documents all fail the base rules has
    no thresholds and needs none.  Other columns are ignored; an empty table gives an empty result."""
    measures = stage(measure(documents), "measures")
    limits = stage(thresholds(measures), "limits")
    limits = F.broadcast(limits) if limits.count() <= SENT_GROUPS else limits
    bad = F.lit(False)
    for name, value in _thousandths().items():
        bad = bad | F.coalesce(value > F.col(f"hi_{name}"), F.lit(False))
        if MEASURES[name][1]:
            bad = bad | F.coalesce(value < F.col(f"lo_{name}"), F.lit(False))
    joined = measures.join(limits, ["lang", "source"], "left")
    return joined.withColumn("kept", ~F.col("base_failed") & ~bad).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
