"""URL filters as a temporal list join.

A list is a log of dated entries that add or remove a pattern.  The entries of a pattern become
validity intervals [from, to), only changes of state begin one.  Every capture is evaluated against
the entries active at its own fetch time, so a replayed crawl gives the answers of its day.

Patterns are of kind ``domain`` (the host and all hosts below it), ``host`` or ``prefix`` (scheme
dropped, whole path segments).  A capture has one key a host label and a path segment, as deep as the
list's deepest pattern goes, each of which may match one pattern.  Intervals of one pattern don't
overlap, and each is cut at period ends, so a (pattern, period) has only as many intervals as it
changed in that period.  Keys travel as hashes; the pattern itself is compared where hashes meet.
Captures are reduced to distinct places and days before they meet the lists, and both sides of that
join are plain exchanges, which Spark splits where a listed host holds a large share of them.

Everything is DataFrame functions: no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def normal(url: Column) -> Column:
    """host/path in lower-case host, without scheme, user, port, query and fragment; null if there is no host."""
    host = F.lower(F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1))
    path = F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//[^/?#]*([^?#]*)", 1)
    return F.when(F.length(host) > 0, F.concat(F.regexp_replace(host, r"\.+$", ""), F.regexp_replace(path, "/+$", "")))


def intervals(entries: DataFrame) -> DataFrame:
    """(kind, pattern, day, action 'add' or 'remove') -> kind, pattern, valid_from, valid_to (null: still valid).

    On one day a removal outranks an addition.  Adding what is listed and removing what isn't change
    nothing; rows with a null kind, pattern, day or another action are ignored."""
    good = entries.filter("kind is not null and pattern is not null and day is not null and action in ('add', 'remove')")
    daily = good.groupBy("kind", "pattern", "day").agg(F.min(F.col("action") == "add").alias("on"))
    by = W.partitionBy("kind", "pattern").orderBy("day")
    changes = daily.withColumn("was", F.lag("on").over(by)).filter(F.col("on") != F.coalesce("was", F.lit(False)))
    spans = changes.withColumn("valid_to", F.lead("day").over(by))
    return spans.filter("on").select("kind", "pattern", F.col("day").alias("valid_from"), "valid_to")


def _parts(text: Column, mark: str) -> Column:
    return F.size(F.split(text, mark))


def _keys(where: Column, labels: int, segments: int) -> Column:
    """Every (kind, pattern) that could match a normal URL, of so many labels and segments at most."""
    names, steps = F.split(F.split_part(where, F.lit("/"), F.lit(1)), r"\."), F.split(where, "/")
    pattern = lambda kind, parts, mark: F.struct(F.lit(kind).alias("kind"), F.array_join(parts, mark).alias("pattern"))
    upto = lambda n, most: F.sequence(F.lit(1), F.least(n, F.lit(most)))
    none = F.array().cast("array<struct<kind:string,pattern:string>>")
    up = F.transform(upto(F.size(names), labels), lambda i: pattern("domain", F.slice(names, F.size(names) - i + 1, i), ".")) if labels else none
    down = F.transform(upto(F.size(steps), segments), lambda i: pattern("prefix", F.slice(steps, F.lit(1), i), "/")) if segments else none
    return F.concat(up, F.array(F.struct(F.lit("host").alias("kind"), steps[0].alias("pattern"))), down)


def filter_urls(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """page_id, url, fetched, blocked, n_entries, reason (first active entry as kind:pattern), listed_since.

    ``captures``: page_id, url, fetched (date).  A null or hostless url, or a null date, matches nothing.
    Of several active entries the reason is the smallest by kind, then pattern.  Patterns may have any
    number of labels and segments.  Rows that repeat a page_id each give a row; other columns are
    ignored; an empty list blocks nothing, an empty table of captures gives an empty result."""
    captures = captures.select("page_id", "url", "fetched", normal(F.col("url")).alias("at"))
    listed = intervals(entries)
    deepest = lambda kind, mark: F.max(F.when(F.col("kind") == kind, _parts(F.col("pattern"), mark)))
    labels, segments = (n or 0 for n in listed.agg(deepest("domain", r"\."), deepest("prefix", "/")).first())
    period, key = (lambda c: F.trunc(c, "month")), F.xxhash64("kind", "pattern").alias("key")
    # one row for each place and day
    places = captures.filter("at is not null and fetched is not null").select("at", "fetched").distinct()
    each = places.select("at", "fetched", F.explode(_keys(F.col("at"), labels, segments)).alias("k")).select("at", "fetched", "k.kind", "k.pattern")
    keyed = each.select(key, period("fetched").alias("period"), "at", "fetched", "kind", "pattern")
    last = captures.agg(F.max("fetched").alias("last"))
    spans = listed.crossJoin(F.broadcast(last))  # one row
    until = F.least(F.coalesce(F.date_sub("valid_to", 1), F.col("last")), F.col("last"))
    months = F.sequence(period("valid_from"), period(until), F.expr("interval 1 month"))
    cut = spans.filter(F.col("valid_from") <= until).select(key, F.explode(months).alias("period"), F.col("kind").alias("l_kind"), F.col("pattern").alias("l_pattern"), "valid_from", "valid_to")
    active = (F.col("valid_from") <= F.col("fetched")) & (F.col("valid_to").isNull() | (F.col("valid_to") > F.col("fetched")))
    hits = keyed.join(cut, ["key", "period"]).filter((F.col("kind") == F.col("l_kind")) & (F.col("pattern") == F.col("l_pattern")) & active)
    found = hits.groupBy("at", "fetched").agg(F.count("*").alias("n_entries"), F.min(F.struct("kind", "pattern", "valid_from")).alias("first"))
    out = captures.join(found, ["at", "fetched"], "left")
    return out.select(
        "page_id", "url", "fetched", F.col("first").isNotNull().alias("blocked"), F.coalesce("n_entries", F.lit(0)).cast("long").alias("n_entries"),
        F.when(F.col("first").isNotNull(), F.concat_ws(":", "first.kind", "first.pattern")).alias("reason"), F.col("first.valid_from").alias("listed_since"),
    )
