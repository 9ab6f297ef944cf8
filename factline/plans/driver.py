"""Every operator on logs derived from the test tables, with its twin in DuckDB's SQL.

The tables hold no filings.  LINES makes a revision log of each part's quantity, FACTS versions of
each nation's revenue by quarter and year, WEEKS weekly counts of events; the same SQL text derives
them on both engines."""

from __future__ import annotations

import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factline.config import metric_concepts, metric_rows
from factline.functions import numbers, prose
from factline.operators import asof, quality, research
from factline.operators.versioning import reconcile
from factline.plans import reads
from factline.plans.pipeline import decided_counts
from factline.schemas import fit
from factline.sources.bronze import reporting_currency
from factline.sources.store import Lake

LINES = """select concat('P', cast(l_partkey as varchar(20))) as ticker, 'github' as taxonomy, concat('part-', cast(l_partkey as varchar(20))) as concept, 'commits' as unit,
 cast(null as date) as period_start, date '2000-01-01' as period_end, l_quantity as value, concat('o', cast(l_orderkey as varchar(20))) as accn, 'GitHub' as form,
 cast(l_shipdate as date) as filed, l_orderkey, l_partkey from lineitem"""

_SALES = """sales as (select n_name as ticker, cast(o_orderdate as date) as od, cast(l_shipdate as date) as sd, cast(l_extendedprice as decimal(18,2)) as v
 from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey),
quarters as (select ticker, make_date(cast(extract(year from od) as int), cast(extract(quarter from od) as int) * 3 - 2, 1) as period_start,
 last_day(make_date(cast(extract(year from od) as int), cast(extract(quarter from od) as int) * 3, 1)) as period_end, sd, v from sales),
q as (select ticker, period_start, period_end, coalesce(sum(case when sd <= period_end + 30 then v end), cast(0 as decimal(18,2))) as early, sum(v) as late from quarters group by ticker, period_start, period_end),
y as (select ticker, make_date(cast(extract(year from od) as int), 1, 1) as period_start, make_date(cast(extract(year from od) as int), 12, 31) as period_end, sum(v) as late from sales group by 1, 2, 3),
f as (
 select ticker, 'Revenues' as concept, period_start, period_end, cast(early as double) as value, period_end + 30 as known_from, make_date(cast(extract(year from period_end) as int), 12, 31) + 60 as known_to, 'initial' as change_type from q
  where extract(month from period_end) < 12
 union all select ticker, 'Revenues', period_start, period_end, cast(late as double), make_date(cast(extract(year from period_end) as int), 12, 31) + 60, cast(null as date), 'restatement' from q where extract(month from period_end) < 12
 union all select ticker, 'Revenues', period_start, period_end, cast(late as double), period_end + 60, cast(null as date), 'initial' from y
 union all select ticker, 'SalesRevenueNet', period_start, period_end, cast(late as double) + 1, period_end + 60, cast(null as date), 'initial' from y where ticker < 'NATION_2'
 union all select ticker, 'Assets', cast(null as date), period_end, cast(late as double), period_end + 45, cast(null as date), 'initial' from q where extract(month from period_end) = 6)"""
FACTS = f"""with {_SALES} select concat_ws('|', ticker, concept, cast(period_end as varchar(10)), cast(known_from as varchar(10)), coalesce(cast(period_start as varchar(10)), '')) as version_id,
 concat_ws('|', ticker, 'us-gaap', concept, 'USD', coalesce(cast(period_start as varchar(10)), ''), cast(period_end as varchar(10))) as fact_key,
 ticker, ticker as entity_name, 'us-gaap' as taxonomy, concept, 'USD' as unit, period_start, period_end, value, known_from, known_to,
 concat('f-', cast(known_from as varchar(10))) as source_accn, '10-Q' as source_form, change_type from f"""
WEEKS = """with w as (select event_type as ticker, concat('r/', cast(user_id % 7 as varchar(5))) as repo, cast(date_trunc('week', ts) as date) as period_start, cast(count(*) as double) as n from events group by 1, 2, 3)
select concat_ws('|', ticker, repo, cast(period_start as varchar(10))) as fact_key, concat_ws('|', ticker, repo, cast(period_start as varchar(10))) as version_id, ticker, ticker as entity_name, 'github' as taxonomy, repo as concept,
 'commits' as unit, period_start, period_start + 6 as period_end, n as value, greatest(period_start + 7, date '2024-01-20') as known_from, cast(null as date) as known_to, 'gh' as source_accn, 'GitHub' as source_form, 'initial' as change_type from w"""
_PAIRS = "select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice / 1000 as a, l_extendedprice / 1000 / (1 + l_suppkey % 12) * (1 + l_linenumber / 1000.0) as b, case when l_linenumber % 2 = 0 then 'shares' else 'USD/shares' end as unit from lineitem"
_ORDERED = "select l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_extendedprice, 2) as a, round(l_extendedprice, 1) as b, round(l_extendedprice / 7, 4) as c from lineitem"
DAY, LATER = "1995-08-15", "1998-01-01"
# Small cases of each rule and what they must give.
_CASES = [
    ("AA", "NetIncomeLoss", "USD", "2022-01-01", "2022-12-31", 100.25, "f1", "2023-02-01"), ("AA", "NetIncomeLoss", "USD", "2022-01-01", "2022-12-31", 90.75, "f2", "2024-02-01"),
    ("BB", "NetIncomeLoss", "USD", "2022-01-01", "2022-12-31", 100.0, "f1", "2024-02-01"), ("BB", "NetIncomeLoss", "USD", "2022-01-01", "2022-12-31", 101.0, "f2", "2024-02-01"),
    ("CC", "NetIncomeLoss", "USD", "2022-01-01", "2022-12-31", 100.0, "f1", "2024-02-01"), ("CC", "NetIncomeLoss", "USD", "2022-01-01", "2022-12-31", 200.0, "f1", "2024-02-01"),
    ("DD", "EarningsPerShareDiluted", "USD/shares", "2022-01-01", "2022-12-31", -0.1502, "f1", "2023-02-01"), ("DD", "EarningsPerShareDiluted", "USD/shares", "2022-01-01", "2022-12-31", -0.0015, "f2", "2024-02-01"),
    ("EE", "EarningsPerShareDiluted", "USD/shares", "2022-01-01", "2022-12-31", 11.89, "f1", "2023-02-01"), ("EE", "EarningsPerShareDiluted", "USD/shares", "2022-01-01", "2022-12-31", 2.97, "f2", "2024-02-01"),
    ("FF", "NetIncomeLoss", "USD", "2021-01-01", "2021-12-31", 9857e6, "f1", "2022-02-01"), ("FF", "NetIncomeLoss", "USD", "2022-01-01", "2022-12-31", 13185e6, "f2", "2023-02-01"),
    ("FF", "NetIncomeLoss", "USD", "2021-01-01", "2021-12-31", 13185e6, "f3", "2024-02-01"), ("FF", "NetIncomeLoss", "USD", "2022-01-01", "2022-12-31", 9857e6, "f3", "2024-02-01"),
    ("GG", "Revenues", "USD", "2022-01-01", "2022-06-30", 4167e6, "f1", "2022-08-01"), ("GG", "Revenues", "USD", "2022-04-01", "2022-06-30", 2230e6, "f1", "2022-08-01"), ("GG", "Revenues", "USD", "2022-01-01", "2022-06-30", 2230e6, "f2", "2023-08-01"),
    ("HH", "Revenues", "USD", "2022-01-01", "2022-12-31", 5000.5, "f1", "2023-02-01"), ("HH", "Revenues", "USD", "2022-01-01", "2022-12-31", 5000.5, "f2", "2024-02-01"),
    ("II", "NetIncomeLoss", "USD", "2022-01-01", "2022-12-31", -10.253, "f1", "2023-02-01"), ("II", "NetIncomeLoss", "USD", "2022-01-01", "2022-12-31", -10.25, "f2", "2024-02-01"),
]
_EXPECTED = [
    ("AA", "f1", "initial", "", ""), ("AA", "f2", "restatement", "", "restatement"), ("BB", "f1", "initial", "", ""), ("BB", "f2", "held", "same_day_conflict", ""), ("CC", "f1", "held", "conflict_within_filing", ""), ("CC", "f1", "held", "conflict_within_filing", ""),
    ("DD", "f1", "initial", "", ""), ("DD", "f2", "held", "suspected_scale_error", ""), ("EE", "f1", "initial", "", ""), ("EE", "f2", "restatement", "", "split_adjustment"), ("FF", "f1", "initial", "", ""), ("FF", "f2", "initial", "", ""),
    ("FF", "f3", "held", "suspected_wrong_period", ""), ("FF", "f3", "held", "suspected_wrong_period", ""), ("GG", "f1", "initial", "", ""), ("GG", "f1", "initial", "", ""), ("GG", "f2", "held", "suspected_wrong_period", ""),
    ("HH", "f1", "initial", "", ""), ("HH", "f2", "confirmation", "", ""), ("II", "f1", "initial", "", ""), ("II", "f2", "restatement", "", "rounding"),
]

# Figures on the wrong year or span, and how each must be judged.
_YEARS = {"A": ("2011-10-01", "2011-12-31"), "B": ("2012-10-01", "2012-12-31"), "C": (None, "2011-12-31"), "D": (None, "2012-12-31"), "E": ("2012-01-01", "2012-12-31"), "F": ("2011-01-01", "2011-12-31")}
_WRONG = [  # case, concept, unit, period, value, filing, day, verdict
    ("swap of instants", "Assets", "USD", "C", 25278e6, "f1", "2012-02-01", "initial"), ("swap of instants", "Assets", "USD", "D", 32555e6, "f2", "2013-02-01", "initial"),
    ("swap of instants", "Assets", "USD", "C", 32555e6, "f3", "2014-02-01", "wrong"), ("swap of instants", "Assets", "USD", "D", 25278e6, "f3", "2014-02-01", "wrong"),
    ("half swap", "Revenues", "USD", "A", 17431e6, "f1", "2012-02-01", "initial"), ("half swap", "Revenues", "USD", "A", 21268e6, "f2", "2013-01-30", "wrong"), ("half swap", "Revenues", "USD", "B", 17431e6, "f2", "2013-01-30", "wrong"),
    ("half swap of instants", "Assets", "USD", "C", 17431e6, "f1", "2012-02-01", "initial"), ("half swap of instants", "Assets", "USD", "C", 21268e6, "f2", "2013-01-30", "wrong"), ("half swap of instants", "Assets", "USD", "D", 17431e6, "f2", "2013-01-30", "wrong"),
    ("round figures prove nothing", "Shares", "shares", "A", 459e6, "f1", "2012-02-01", "initial"), ("round figures prove nothing", "Shares", "shares", "A", 460e6, "f2", "2013-01-30", "restatement"), ("round figures prove nothing", "Shares", "shares", "B", 459e6, "f2", "2013-01-30", "initial"),
    ("taint of another concept", "Revenues", "USD", "A", 17431e6, "f1", "2012-02-01", "initial"), ("taint of another concept", "NetIncomeLoss", "USD", "A", 177e6, "f1", "2012-02-01", "initial"),
    ("taint of another concept", "Revenues", "USD", "A", 21268e6, "f2", "2013-01-30", "wrong"), ("taint of another concept", "Revenues", "USD", "B", 17431e6, "f2", "2013-01-30", "wrong"),
    ("taint of another concept", "NetIncomeLoss", "USD", "A", 97e6, "f2", "2013-01-30", "wrong"), ("taint of another concept", "NetIncomeLoss", "USD", "B", 177e6, "f2", "2013-01-30", "wrong"),
    ("taint spares other spans", "Revenues", "USD", "A", 17431e6, "f1", "2012-02-01", "initial"), ("taint spares other spans", "Revenues", "USD", "A", 21268e6, "f2", "2013-01-30", "wrong"),
    ("taint spares other spans", "Revenues", "USD", "B", 17431e6, "f2", "2013-01-30", "wrong"), ("taint spares other spans", "Revenues", "USD", "E", 61093e6, "f2", "2013-01-30", "initial"), ("taint spares other spans", "Assets", "USD", "C", 5.5e9, "f2", "2013-01-30", "initial"),
    ("a copy of last year's value", "Revenues", "USD", "F", 100e6, "f1", "2012-02-01", "initial"), ("a copy of last year's value", "Revenues", "USD", "E", 120e6, "f2", "2013-02-01", "initial"),
    ("a copy of last year's value", "Revenues", "USD", "F", 120e6, "f3", "2014-02-01", "restatement"), ("a copy of last year's value", "Revenues", "USD", "E", 120e6, "f3", "2014-02-01", "confirmation"),
    ("a quarter's figure on the year", "Revenues", "USD", "E", 4167e6, "f1", "2013-02-01", "initial"), ("a quarter's figure on the year", "Revenues", "USD", "B", 2230e6, "f1", "2013-02-01", "initial"),
    ("a quarter's figure on the year", "Revenues", "USD", "E", 2230e6, "f2", "2014-02-01", "wrong"), ("a quarter's figure on the year", "Revenues", "USD", "E", 4167e6, "f3", "2015-02-01", "confirmation"),
]


def _sql(spark: SparkSession, sf_dir: str, text: str, *tables: str) -> DataFrame:
    for t in tables:
        spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)
    return spark.sql(text.replace("varchar(10)", "string").replace("varchar(20)", "string").replace("varchar(5)", "string"))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, LINES, "lineitem")


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fit(_sql(spark, sf_dir, FACTS, "lineitem", "orders", "customer", "nation"), "facts_history")


def weeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fit(_sql(spark, sf_dir, WEEKS, "events"), "facts_history")


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return asof.metric_history(facts(spark, sf_dir), metric_concepts(spark))


def as_observations(f: DataFrame) -> DataFrame:
    return fit(f.withColumns({"accn": F.col("source_accn"), "form": F.col("source_form"), "filed": F.col("known_from")}), "observations")


def rule_cases(spark: SparkSession) -> DataFrame:
    df = spark.createDataFrame(_CASES, "ticker string, concept string, unit string, s string, e string, value double, accn string, f string")
    return df.select("ticker", F.col("ticker").alias("entity_name"), F.lit("us-gaap").alias("taxonomy"), "concept", "unit", F.to_date("s").alias("period_start"), F.to_date("e").alias("period_end"), "value", "accn", F.lit("10-K").alias("form"), F.to_date("f").alias("filed"))


def _wrong_periods(spark, d):
    cases = {c: f"T{k}" for k, c in enumerate(dict.fromkeys(r[0] for r in _WRONG))}
    rows = [(cases[c], c, "us-gaap", concept, unit, *_YEARS[p], v, a, "10-K", f) for c, concept, unit, p, v, a, f, _ in _WRONG]
    df = spark.createDataFrame(rows, "ticker string, entity_name string, taxonomy string, concept string, unit string, s string, e string, value double, accn string, form string, f string")
    df = df.withColumns({"period_start": F.to_date("s"), "period_end": F.to_date("e"), "filed": F.to_date("f")})
    decided = reconcile(df).decided
    verdict = F.when(F.col("reason") == "suspected_wrong_period", "wrong").otherwise(F.coalesce(F.concat_ws(" ", F.when(F.col("action") == "held", "held"), "reason"), F.lit("")))
    return decided.select(F.col("entity_name").alias("case_name"), "concept", "period_start", "period_end", "accn", F.when(F.col("action") == "held", verdict).otherwise(F.col("action")).alias("verdict"))


METRIC = ["ticker", "metric", "period_start", "period_end", "value", "known_from"]


def _versions(spark, d):
    r = reconcile(lines(spark, d))
    return r.versions.select("ticker", "value", "known_from", "known_to", "source_accn", "change_type")


def _decisions(spark, d):
    return decided_counts(reconcile(lines(spark, d)).decided)


def _incremental(spark, d):
    """The log in two batches, the second against the state that the first left."""
    log = lines(spark, d)
    first = reconcile(log.filter("filed < date '1995-01-01'"))
    first.decided.persist()
    second = reconcile(log.filter("filed >= date '1995-01-01'"), first.records.select("fact_key", "accn", "value"), asof.facts_current(first.versions), first.corrections)
    return second.decided.filter("action <> 'already_seen'").groupBy("action").agg(F.count("*").alias("n"))


def _rule_cases(spark, d):
    r = reconcile(rule_cases(spark))
    kind = r.changes.select("fact_key", F.col("new_accn").alias("accn"), "classification")
    return r.decided.join(kind, ["fact_key", "accn"], "left").select("ticker", "accn", "action", F.coalesce("reason", F.lit("")).alias("reason"), F.coalesce("classification", F.lit("")).alias("classification"))


def _merge(spark, d):
    """Versions written and closed through the lake, read back."""
    lake = Lake(spark, (spark.sparkContext.getConf().get("spark.checkpoint.dir") or "file://" + tempfile.mkdtemp()) + f"/lake-{abs(hash(d)) % 10**9}-{spark.sparkContext.startTime}-{id(object())}")
    f = facts(spark, d).persist()
    none = f.limit(0).select("fact_key", "source_accn", "known_from", F.col("known_from").alias("known_to"))
    lake.merge_facts(none, f.filter("change_type = 'initial'").withColumn("known_to", F.lit(None).cast("date")))
    ends = f.filter("change_type = 'initial' and known_to is not null").select("fact_key", "source_accn", "known_from", "known_to")
    lake.merge_facts(ends, f.filter("change_type = 'restatement'"))
    return lake.read("facts_history").select("version_id", "value", "known_from", "known_to", "change_type")


def _changes(spark, d):
    f = facts(spark, d)
    new = f.filter("change_type = 'restatement'").select("fact_key", "ticker", "period_end", F.col("value").alias("new_value"), F.col("known_from").alias("effective_date"))
    old = f.filter("change_type = 'initial' and known_to is not null").select("fact_key", F.col("value").alias("old_value"))
    both = new.join(old, "fact_key").withColumn("pct_change", numbers.pct_change(F.col("old_value"), F.col("new_value"))).withColumn("change_id", F.col("fact_key")).withColumn("classification", F.lit("restatement"))
    return reads.changes(both, None, "1994-01-01", None, 1.0, 50).select("ticker", "period_end", "effective_date", "old_value", "new_value")


def _compare(spark, d):
    f = facts(spark, d)
    log = f.filter("change_type = 'restatement'").select("fact_key", F.col("source_accn").alias("new_accn"), F.lit("restatement").alias("classification"), F.lit("x").alias("explanation"))
    return reads.compare_as_of(asof.metric_history(f, metric_concepts(spark)), log, "nation_3", "revenue", DAY, LATER).select("period_start", "period_end", "value_before", "value_after", "classification")


def _growth(spark, d):
    g = research.growth(history(spark, d), "revenue", "quarter")
    return g.select("ticker", "period_end", "first_published", *[F.round(c, 4).alias(c) for c in ("growth_then", "growth_now")])


def _differing(spark, d):
    g = research.differing(research.growth(history(spark, d), "revenue", "quarter"), 1.0)
    return g.select("ticker", "period_end", "cur_then", "cur_now", research.cause().alias("cause"))


# Faults for the gates: each nation has one of its own.
FAULTY = f"""select case when concept = 'SalesRevenueNet' then 'twice' else version_id end as version_id, fact_key, ticker, entity_name, taxonomy, concept, case when ticker = 'NATION_9' then 'shares' else unit end as unit, period_start, period_end,
 case when ticker = 'NATION_10' then cast(null as double) else value end as value, case when ticker = 'NATION_6' and concept = 'Assets' then cast(null as date) else known_from end as known_from,
 case when ticker < 'NATION_2' then known_to + 10 when ticker = 'NATION_3' then known_from - 5 when ticker = 'NATION_4' then known_from + 1000 else known_to end as known_to,
 source_accn, source_form, case when ticker = 'NATION_5' then 'odd' else change_type end as change_type from ({FACTS}) all_facts"""
CHANGED = f"""select case when ticker = 'NATION_8' then 'same' else version_id end as change_id, case when ticker = 'NATION_7' then cast(null as varchar(10)) else 'why' end as explanation
 from ({FACTS}) all_facts where change_type = 'restatement'"""


def _report(spark, d):
    """Every suite of the three gates, over tables with faults."""
    tables = ("lineitem", "orders", "customer", "nation")
    f, changes = fit(_sql(spark, d, FAULTY, *tables), "facts_history").persist(), _sql(spark, d, CHANGED, *tables)
    o = as_observations(f).unionByName(as_observations(weeks(spark, d))).persist()
    rows = quality.run_suites("pre_publish", quality.PRE, quality.batch_views(o, LATER))
    views = quality.history_views(f, o.withColumn("value", F.when(F.col("ticker") != "NATION_11", F.col("value")).otherwise(F.col("value") + 1)), changes, LATER)
    rows += quality.run_suites("post_publish", quality.POST, views) + quality.run_suites("reconciliation", quality.RECONCILIATION, views)
    return spark.createDataFrame([(r["gate"], r["suite"], r["check"], r["column"], r["failing_rows"]) for r in rows], "gate string, suite string, `check` string, `column` string, failing_rows long")


def _parity(spark, d):
    f = facts(spark, d)
    latest = asof.observations_latest(as_observations(f.filter("change_type = 'initial'")))
    return quality.value_parity(asof.facts_current(f), latest, "fact_key", ["value"]).select("fact_key", F.col("l.value").alias("published"), F.col("r.value").alias("source"))


def _scalar(text: str, **columns):
    return lambda spark, d: _sql(spark, d, text, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *[c.alias(n) for n, c in columns.items()])


def _errors(spark, d):
    c = lines(spark, d).select(F.substring("ticker", 1, 2).alias("ticker"), F.when(F.col("value") > 25, "suspected_wrong_period").when(F.col("value") > 5, "suspected_scale_error").otherwise("late_arrival").alias("reason_code"), "accn", F.col("filed").alias("period_end"), "filed")
    return research.source_errors(c)


def _currency(spark, d):
    orders = spark.read.parquet(f"{d}/orders.parquet")
    units = orders.select(F.concat(F.lit("C"), (F.col("o_custkey") % 97).cast("string")).alias("ticker"), F.when(F.col("o_orderkey") % 3 == 0, "EUR").when(F.col("o_orderkey") % 3 == 1, "USD").otherwise("shares").alias("unit"), (F.col("o_orderkey") % 5).alias("n"))
    return reporting_currency(units)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    h, f = history, facts
    return {
        "versions_basic": _versions, "decisions": _decisions, "decisions_incremental": _incremental, "rule_cases": _rule_cases, "wrong_period_cases": _wrong_periods, "merge_facts": _merge,
        "facts_as_of": lambda s, d: asof.facts_as_of(f(s, d), DAY).select("version_id", "value"),
        "facts_current": lambda s, d: asof.facts_current(f(s, d)).select("version_id", "value"),
        "metric_history": lambda s, d: h(s, d).select(*METRIC, "known_to", "priority", "period_type"),
        "metrics_as_of": lambda s, d: asof.metrics_as_of(h(s, d), LATER).select(*METRIC, "concept"),
        "metric_values": lambda s, d: reads.metric_values(h(s, d), "nation_3", "revenue", LATER, "annual").select(*METRIC),
        "quarterly_as_of": lambda s, d: asof.quarterly_as_of(h(s, d), LATER).select("ticker", "metric", "period_start", "period_end", F.round("value", 2).alias("value"), "known_from", "derived"),
        "fact_history": lambda s, d: reads.fact_history(h(s, d), "nation_3", "revenue", "1995-03-31").select(*METRIC, "known_to"),
        "compare_as_of": _compare, "changes_feed": _changes, "growth_then_vs_now": _growth, "growth_causes": _differing,
        "observations_latest": lambda s, d: asof.observations_latest(as_observations(f(s, d))),
        "dq_open_versions": lambda s, d: asof.open_versions(f(s, d)),
        "dq_invalid_intervals": lambda s, d: asof.invalid_intervals(f(s, d).withColumn("known_to", F.when(F.col("ticker") < "NATION_2", F.date_sub("known_to", 400)).otherwise(F.col("known_to")))),
        "dq_overlaps": lambda s, d: asof.overlapping_versions(f(s, d).withColumn("known_to", F.when(F.col("ticker") < "NATION_2", F.date_add("known_to", 10)).otherwise(F.col("known_to")))),
        "dq_freshness": lambda s, d: asof.days_since_last_filing(as_observations(f(s, d)), LATER),
        "dq_collection": lambda s, d: asof.days_since_last_collection(as_observations(weeks(s, d)), "2024-03-01"),
        "dq_check_report": _report, "value_parity": _parity,
        "developer_activity": lambda s, d: asof.developer_activity_as_of(weeks(s, d), "2024-01-22").select("ticker", "repo", "week_start", "commits"),
        "backfill_weeks": lambda s, d: research.backfill(weeks(s, d)),
        "activity_trend": lambda s, d: research.trend(weeks(s, d), "2024-03-01"),
        "source_errors": _errors, "reporting_currency": _currency,
        "company_rollup": lambda s, d: reads.companies(f(s, d).unionByName(weeks(s, d)), as_observations(f(s, d)).withColumn("cik", F.length("ticker").cast("long"))),
        "split_detect": lambda s, d: _scalar(_PAIRS, ratio=numbers.detect_split(F.col("a"), F.col("b"), F.col("unit")))(s, d),
        "scale_jump": lambda s, d: _scalar(_ORDERED, factor=numbers.scale_jump(F.col("a"), F.col("b") / 100))(s, d),
        "rounding_detect": lambda s, d: _scalar(_ORDERED, same=numbers.is_rounding(F.col("a"), F.col("b")), digits=numbers.significant_digits(F.col("b")), distinct_figure=numbers.distinctive(F.col("b")))(s, d),
        "period_types": lambda s, d: f(s, d).groupBy(prose.period_type(F.col("period_start"), F.col("period_end")).alias("period_type")).agg(F.count("*").alias("n")),
    }


def oracle_sql() -> dict[str, str]:
    facts_ = f"facts as ({FACTS})"
    weeks_ = f"weeks as ({WEEKS})"
    concepts = "concepts(metric, kind, unit_pattern, taxonomy, concept, priority) as (values " + ", ".join(f"('{r[0]}', '{r[2]}', '{r[3]}', '{r[4]}', '{r[5]}', {r[6]})" for r in metric_rows()) + ")"
    kind = "case when period_start is null then 'instant' when period_end - period_start + 1 between 80 and 100 then 'quarter' when period_end - period_start + 1 between 350 and 380 then 'annual' else 'ytd' end"
    hist = f"{facts_}, {concepts}, hist as (select f.*, c.metric, c.kind, c.priority, {kind} as period_type from facts f join concepts c on f.taxonomy = c.taxonomy and f.concept = c.concept and regexp_full_match(f.unit, c.unit_pattern))"
    on = lambda day: f"known_from <= date '{day}' and (known_to is null or known_to > date '{day}')"
    best = lambda day, name: f"{name} as (select * from hist where {on(day)} qualify row_number() over (partition by ticker, metric, period_start, period_end order by priority) = 1)"
    cols = ", ".join(METRIC)
    walk = f"""with recursive obs as ({LINES}), per as (select ticker, accn, filed, count(distinct value) over (partition by ticker, accn) as k, value from obs),
      one as (select ticker, accn, min(filed) as filed, min(value) as value, min(k) as k from (select ticker, accn, filed, value, (select count(distinct value) from obs o where o.ticker = p.ticker and o.accn = p.accn) as k from obs p) group by ticker, accn),
      seq as (select ticker, accn, filed, value, row_number() over (partition by ticker order by filed, accn) as i from one where k = 1),
      walk as (select ticker, i, accn, filed, value, 'initial' as action, '' as reason, value as cur, filed as since from seq where i = 1
        union all select s.ticker, s.i, s.accn, s.filed, s.value,
          case when s.value = w.cur then 'confirmation' when s.filed = w.since then 'held' else 'restatement' end, case when s.value <> w.cur and s.filed = w.since then 'same_day_conflict' else '' end,
          case when s.value <> w.cur and s.filed > w.since then s.value else w.cur end, case when s.value <> w.cur and s.filed > w.since then s.filed else w.since end
        from walk w join seq s on s.ticker = w.ticker and s.i = w.i + 1)"""
    walk = walk.replace(", per as (select ticker, accn, filed, count(distinct value) over (partition by ticker, accn) as k, value from obs)", "").replace(
        "select ticker, accn, min(filed) as filed, min(value) as value, min(k) as k from (select ticker, accn, filed, value, (select count(distinct value) from obs o where o.ticker = p.ticker and o.accn = p.accn) as k from obs p) group by ticker, accn",
        "select ticker, accn, min(filed) as filed, min(value) as value, count(distinct value) as k from obs group by ticker, accn",
    )
    step = """union all select s.ticker, s.i, s.accn, s.filed, s.value, case when s.value = w.cur then 'confirmation' when s.filed = w.since then 'held' else 'restatement' end,
        case when s.value <> w.cur and s.filed > w.since then s.value else w.cur end, case when s.value <> w.cur and s.filed > w.since then s.filed else w.since end"""
    part = lambda name, when: f"{name} as (select ticker, accn, min(filed) as filed, min(value) as value, count(distinct value) as k from obs where {when} group by ticker, accn)"
    clash = lambda name, when: f"select distinct o.ticker, o.accn, o.value from obs o join {name} p on p.ticker = o.ticker and p.accn = o.accn and p.k > 1 where {when}"
    early, late = "filed < date '1995-01-01'", "filed >= date '1995-01-01'"
    # two batches, each folded by itself, the second from the state that the first leaves
    incremental = f"""with recursive obs as ({LINES}), {part("p1", early)}, {part("p2", late)},
      s1 as (select ticker, accn, filed, value, row_number() over (partition by ticker order by filed, accn) as i from p1 where k = 1),
      w1 as (select ticker, i, accn, filed, value, 'initial' as action, value as cur, filed as since from s1 where i = 1 {step} from w1 w join s1 s on s.ticker = w.ticker and s.i = w.i + 1),
      held as (select ticker, accn, value from w1 where action = 'held' union {clash("p1", "o." + early)}),
      state as (select ticker, cur, since from w1 qualify row_number() over (partition by ticker order by i desc) = 1),
      c2 as (select p2.*, w.value as was from p2 left join w1 w on w.ticker = p2.ticker and w.accn = p2.accn and w.action <> 'held' where k = 1),
      s2 as (select ticker, accn, filed, value, row_number() over (partition by ticker order by filed, accn) as i from c2 where was is null),
      f2 as (select s.*, t.cur, t.since from s2 s left join state t using (ticker) where i = 1),
      w2 as (select ticker, i, accn, filed, value, case when cur is null then 'initial' when value = cur then 'confirmation' when filed = since then 'held' else 'restatement' end as action,
          case when cur is null or value <> cur and filed > since then value else cur end as cur, case when cur is null or value <> cur and filed > since then filed else since end as since from f2
        {step} from w2 w join s2 s on s.ticker = w.ticker and s.i = w.i + 1),
      every as (select ticker, accn, value, action from w2 union all select ticker, accn, value, 'held' from c2 where was <> value union all select *, 'held' from ({clash("p2", "o." + late)}))
      select case when e.action = 'held' and h.accn is not null then 'held_before' else e.action end as action, count(*) as n from every e left join held h using (ticker, accn, value) group by 1"""
    ratio = "coalesce(" + ", ".join(f"case when abs(big / {r} - small) <= 0.02 * small or (cents and abs(big / {r} - small) <= 0.0051) then {r} end" for r in numbers.SPLIT_RATIOS) + ")"
    factor = "coalesce(" + ", ".join(f"case when abs(big / {r} - small) <= 0.02 * small or abs(big / {r} - small) <= half then {r} end" for r in numbers.SCALE_FACTORS) + ")"
    places = "case " + " ".join(f"when abs(round(small, {k}) - small) <= 1e-12 then {k}" for k in range(7)) + " else 6 end"
    even = lambda x, k: f"round_even({x}, {k})"
    digits = lambda x: f"length(regexp_replace(replace(split_part(format('{{:.11e}}', abs({x})), 'e', 1), '.', ''), '^0+|0+$', '', 'g'))"
    kept = lambda fine, coarse: "coalesce(" + ", ".join(f"case when abs({even(coarse, k)} - {coarse}) <= 1e-9 * greatest(1, abs({coarse})) then {even(fine, k)} end" for k in range(-9, 7)) + f", {even(fine, 6)})"
    rounds = lambda fine, coarse: f"({digits(coarse)} >= 3 and abs({kept(fine, coarse)} - {coarse}) <= 1e-9 * greatest(1, abs({coarse})))"
    growth = f"""with {hist}, m as (select * from hist where metric = 'revenue' and period_type = 'quarter'),
      p as (select ticker, period_start, period_end, min(known_from) as first_published from m group by all),
      pairs as (select c.*, p.period_start as ps, p.period_end as pe from p c join p on p.ticker = c.ticker and c.period_end - p.period_end between 358 and 372 and abs((p.period_end - p.period_start) - (c.period_end - c.period_start)) <= 10),
      v as (select x.*,
        (select arg_min(value, priority) from m where m.ticker = x.ticker and m.period_start = x.period_start and m.period_end = x.period_end and m.known_from <= x.first_published and (m.known_to is null or m.known_to > x.first_published)) as cur_then,
        (select arg_min(value, priority) from m where m.ticker = x.ticker and m.period_start = x.ps and m.period_end = x.pe and m.known_from <= x.first_published and (m.known_to is null or m.known_to > x.first_published)) as prev_then,
        (select arg_min(value, priority) from m where m.ticker = x.ticker and m.period_start = x.period_start and m.period_end = x.period_end and m.known_to is null) as cur_now,
        (select arg_min(value, priority) from m where m.ticker = x.ticker and m.period_start = x.ps and m.period_end = x.pe and m.known_to is null) as prev_now from pairs x),
      g as (select *, 100 * (cur_then / prev_then - 1) as growth_then, 100 * (cur_now / prev_now - 1) as growth_now from v where prev_then > 0 and prev_now > 0 and cur_then is not null and cur_now is not null)"""
    k = "greatest(abs(cur_then / prev_then), abs(cur_now / prev_now)) / least(abs(cur_then / prev_then), abs(cur_now / prev_now))"
    mixed = " or ".join(f"abs({k} - {r}) <= 0.05 * {r}" for r in numbers.SPLIT_RATIOS)
    batch = [  # suite, check, column, what fails of o
        *[("observation_batch", "not_null", c, f"{c} is null") for c in ("ticker", "concept", "period_end", "value", "accn", "filed")],
        ("observation_batch", "in_set", "taxonomy", "taxonomy not in ('us-gaap', 'ifrs-full', 'github')"), ("observation_batch", "matches_regex", "ticker", "not regexp_full_match(ticker, '[A-Z][A-Z.\\-]{0,9}')"),
        ("observation_batch", "in_set", "unit_matches_config", "not case when taxonomy = 'github' then unit = 'commits' else exists (select 1 from concepts c where c.taxonomy = o.taxonomy and c.concept = o.concept and regexp_full_match(o.unit, c.unit_pattern)) end"),
        ("observation_batch", "in_range", "period_days", "period_end - period_start + 1 < 1"), ("observation_batch", "in_range", "filing_lag_days", "filed - period_end < 0"), ("observation_batch", "in_range", "days_filed_in_future", f"filed - date '{LATER}' > 0"),
        ("sec_filings", "matches_regex", "accn", "taxonomy in ('us-gaap', 'ifrs-full') and not regexp_full_match(accn, '\\d{10}-\\d{2}-\\d{6}')"), ("sec_filings", "in_set", "form", "taxonomy in ('us-gaap', 'ifrs-full') and form not in " + str(quality.FORMS)),
        ("developer_activity", "matches_regex", "accn", "taxonomy = 'github' and not regexp_full_match(accn, 'gh-\\d{4}-\\d{2}-\\d{2}')"), ("developer_activity", "in_range", "period_days", "taxonomy = 'github' and period_end - period_start + 1 <> 7"), ("developer_activity", "in_range", "value", "taxonomy = 'github' and value < 0"),
    ]
    source = "(select fact_key, arg_max(case when ticker = 'NATION_11' then value + 1 else value end, (filed, accn)) as value from o where value is not null group by fact_key)"
    silent = lambda tax, key: f"(select {key}, date '{LATER}' - max(filed) as days from o where {tax} group by {key})"
    audits = [  # gate, suite, check, column, failing rows
        ("pre_publish", "observation_batch", "columns_exist", None, "0"), ("pre_publish", "observation_batch", "row_count", None, "0"),
        ("post_publish", "history_invariants", "unique", "version_id", "(select count(*) from (select 1 from f group by version_id having count(*) > 1))"), ("post_publish", "history_invariants", "not_null", "known_from", "(select count(*) from f where known_from is null)"),
        ("post_publish", "history_invariants", "in_set", "change_type", "(select count(*) from f where change_type not in ('initial', 'restatement', 'manual_correction'))"),
        ("post_publish", "exactly_one_current_version_per_fact", "in_range", "open_versions", "(select count(*) from (select 1 from f group by fact_key having count(*) filter (where known_to is null) <> 1))"),
        ("post_publish", "no_empty_or_negative_intervals", "row_count", None, "(select count(*) from f where known_to <= known_from)"),
        ("post_publish", "no_overlapping_versions", "row_count", None, "(select count(*) from f a join f b on a.fact_key = b.fact_key and a.version_id < b.version_id and a.known_from < coalesce(b.known_to, date '9999-12-31') and b.known_from < coalesce(a.known_to, date '9999-12-31'))"),
        ("post_publish", "every_change_is_explained", "not_null", "explanation", "(select count(*) from log where explanation is null)"), ("post_publish", "every_change_is_explained", "unique", "change_id", "(select count(*) from (select 1 from log group by change_id having count(*) > 1))"),
        ("post_publish", "every_company_is_fresh", "in_range", "days_since_last_filing", f"(select count(*) from {silent('taxonomy <> ' + chr(39) + 'github' + chr(39), 'ticker')} where days > 120)"),
        ("post_publish", "developer_activity_is_fresh", "in_range", "days_since_last_collection", f"(select count(*) from {silent('taxonomy = ' + chr(39) + 'github' + chr(39), 'concept')} where days > 3)"),
        ("reconciliation", "published_matches_source", "row_count_parity", None, f"abs((select count(*) from f where known_to is null) - (select count(*) from {source}))"),
        ("reconciliation", "published_matches_source", "value_parity", None, f"(select count(*) from (select fact_key, value from f where known_to is null) a full join {source} b on a.fact_key = b.fact_key where a.fact_key is null or b.fact_key is null or a.value is distinct from b.value)"),
    ]
    text = lambda x: "null" if x is None else f"'{x}'"
    audits += [("pre_publish", suite, check, column, f"(select count(*) from o where {bad})") for suite, check, column, bad in batch]
    report = f"""with f as ({FAULTY}), {concepts}, log as ({CHANGED}), {weeks_}, every as (select * from f union all by name select * from weeks),
      o as (select fact_key, ticker, taxonomy, concept, unit, period_start, period_end, value, source_accn as accn, source_form as form, known_from as filed from every) """
    report += " union all ".join(f"select {text(g)} as gate, {text(s)} as suite, {text(c)} as \"check\", {text(col)} as \"column\", cast({n} as bigint) as failing_rows" for g, s, c, col, n in audits)
    expected = "select * from (values " + ", ".join(str(r) for r in _EXPECTED) + ") t(ticker, accn, action, reason, classification)"
    return {
        "versions_basic": walk + " select ticker, value, filed as known_from, lead(filed) over (partition by ticker order by i) as known_to, accn as source_accn, action as change_type from walk where action in ('initial', 'restatement')",
        "decisions": walk + " select action, reason, count(*) as n from walk group by all union all select 'held', 'conflict_within_filing', sum(k) from one where k > 1 having sum(k) > 0",
        "decisions_incremental": incremental,
        "rule_cases": expected,
        "wrong_period_cases": "select case_name, concept, cast(s as date) as period_start, cast(e as date) as period_end, accn, verdict from (values " + ", ".join(
            "(" + ", ".join("null" if x is None else "'" + x.replace("'", "''") + "'" for x in (c, concept, *_YEARS[p], a, verdict)) + ")" for c, concept, _, p, _, a, _, verdict in _WRONG) + ") t(case_name, concept, s, e, accn, verdict)",
        "merge_facts": f"with {facts_} select version_id, value, known_from, known_to, change_type from facts",
        "facts_as_of": f"with {facts_} select version_id, value from facts where {on(DAY)}",
        "facts_current": f"with {facts_} select version_id, value from facts where known_to is null",
        "metric_history": f"with {hist} select {cols}, known_to, priority, period_type from hist",
        "metrics_as_of": f"with {hist}, {best(LATER, 'b')} select {cols}, concept from b",
        "metric_values": f"with {hist}, {best(LATER, 'b')} select {cols} from b where ticker = 'NATION_3' and metric = 'revenue' and period_type = 'annual'",
        "quarterly_as_of": f"""with {hist}, {best(LATER, 'b')}, r as (select * from b where period_type = 'quarter')
          select ticker, metric, period_start, period_end, round(value, 2) as value, known_from, false as derived from r
          union all select y.ticker, y.metric, cast(max(r.period_end) + 1 as date), y.period_end, round(y.value - sum(r.value), 2), greatest(y.known_from, max(r.known_from)), true
          from b y join r on r.ticker = y.ticker and r.metric = y.metric and r.period_start >= y.period_start and r.period_end < y.period_end
          where y.period_type = 'annual' and y.kind = 'flow' and not exists (select 1 from r z where z.ticker = y.ticker and z.metric = y.metric and z.period_end = y.period_end)
          group by y.ticker, y.metric, y.period_end, y.value, y.known_from having count(*) = 3""",
        "fact_history": f"with {hist} select {cols}, known_to from hist where ticker = 'NATION_3' and metric = 'revenue' and period_end = date '1995-03-31'",
        "compare_as_of": f"""with {hist}, {best(DAY, 'a')}, {best(LATER, 'b')} select period_start, period_end, a.value as value_before, b.value as value_after, case when b.change_type = 'restatement' then 'restatement' end as classification
          from a join b using (ticker, metric, period_start, period_end) where ticker = 'NATION_3' and metric = 'revenue' and a.value <> b.value""",
        "changes_feed": f"""with {facts_} select n.ticker, n.period_end, n.known_from as effective_date, o.value as old_value, n.value as new_value from facts n join facts o using (fact_key)
          where n.change_type = 'restatement' and o.change_type = 'initial' and o.known_to is not null and n.known_from >= date '1994-01-01' and (o.value = 0 or abs(100 * (n.value - o.value) / abs(o.value)) >= 1)
          order by effective_date desc, n.ticker, fact_key limit 50""",
        "growth_then_vs_now": growth + " select ticker, period_end, first_published, round(growth_then, 4) as growth_then, round(growth_now, 4) as growth_now from g",
        "growth_causes": growth + f""" select ticker, period_end, cur_then, cur_now, case when cur_then * cur_now > 0 and ({mixed}) then 'a split lies between the two years'
          when cur_now <> cur_then and prev_now <> prev_then then 'revised on both sides' when prev_now <> prev_then then 'base year revised' else 'latest year revised' end as cause from g where abs(growth_now - growth_then) > 1""",
        "observations_latest": f"with {facts_} select fact_key, arg_max(value, (known_from, source_accn)) as value from facts group by fact_key",
        "dq_open_versions": f"with {facts_} select fact_key, count(*) filter (where known_to is null) as open_versions from facts group by fact_key",
        "dq_invalid_intervals": f"with {facts_}, x as (select version_id, known_from, case when ticker < 'NATION_2' then known_to - 400 else known_to end as known_to from facts) select * from x where known_to <= known_from",
        "dq_overlaps": f"""with {facts_}, x as (select fact_key, version_id, known_from, coalesce(case when ticker < 'NATION_2' then known_to + 10 else known_to end, date '9999-12-31') as e from facts)
          select a.fact_key, a.version_id as version_a, b.version_id as version_b from x a join x b on a.fact_key = b.fact_key and a.version_id < b.version_id and a.known_from < b.e and b.known_from < a.e""",
        "dq_freshness": f"with {facts_} select ticker, taxonomy, date '{LATER}' - max(known_from) as days_since_last_filing from facts group by ticker, taxonomy",
        "dq_collection": f"with {weeks_} select concept as repo, date '2024-03-01' - max(known_from) as days_since_last_collection from weeks group by concept",
        "dq_check_report": report,
        "value_parity": f"with {facts_} select c.fact_key, c.value as published, o.value as source from facts c left join facts o on o.fact_key = c.fact_key and o.change_type = 'initial' where c.known_to is null and (o.value is null or o.value <> c.value)",
        "developer_activity": f"with {weeks_} select ticker, concept as repo, period_start as week_start, value as commits from weeks where known_from <= date '2024-01-22'",
        "backfill_weeks": f"with {weeks_} select ticker, concept as repo, count(*) as weeks, min(period_start) as first_week, max(period_end) as last_week, min(known_from) as first_collected, count(*) filter (where known_from - period_end > 7) as backfilled_weeks from weeks group by all",
        "activity_trend": f"""with {weeks_}, w as (select ticker, period_start, sum(value) as c, row_number() over (partition by ticker order by period_start desc) as n from weeks group by ticker, period_start)
          select ticker, sum(c) filter (where n <= 13) as last_13_weeks, sum(c) filter (where n between 14 and 26) as prior_13_weeks from w group by ticker""",
        "source_errors": f"""with o as ({LINES}), c as (select substring(ticker, 1, 2) as ticker, case when value > 25 then 'suspected_wrong_period' when value > 5 then 'suspected_scale_error' end as reason_code, accn, filed from o)
          select ticker, reason_code, count(distinct accn) as filings, count(*) as values_held, min(filed) as first_period, max(filed) as last_period, min(filed) as first_filed from c where reason_code is not null group by all""",
        "reporting_currency": """select ticker, unit as currency from (select concat('C', cast(o_custkey % 97 as varchar)) as ticker, case when o_orderkey % 3 = 0 then 'EUR' when o_orderkey % 3 = 1 then 'USD' end as unit, sum(o_orderkey % 5) as n from orders group by 1, 2)
          where unit is not null qualify row_number() over (partition by ticker order by n desc, unit) = 1""",
        "company_rollup": f"""with {facts_}, {weeks_}, u as (select ticker, entity_name, taxonomy, known_from from facts union all select ticker, entity_name, taxonomy, known_from from weeks)
          select ticker, min(entity_name) as entity_name, bool_or(taxonomy = 'github') as has_activity, bool_or(taxonomy <> 'github') as has_filings, max(known_from) as last_known_from,
          case when bool_or(taxonomy <> 'github') then length(ticker) end as cik from u group by ticker""",
        "split_detect": f"with p as ({_PAIRS}), x as (select *, greatest(abs(a), abs(b)) as big, least(abs(a), abs(b)) as small, unit = 'USD/shares' and least(abs(a), abs(b)) >= 0.10 as cents from p) select l_orderkey, l_linenumber, l_partkey, l_suppkey, case when a <> 0 and b <> 0 then {ratio} end as ratio from x",
        "scale_jump": f"with p as ({_ORDERED}), x as (select *, greatest(a, b / 100) as big, least(a, b / 100) as small from p), y as (select *, 0.5 * pow(10.0, -({places})) as half from x) select l_orderkey, l_linenumber, l_partkey, l_suppkey, {factor} as factor from y",
        "rounding_detect": f"""with p as ({_ORDERED}) select l_orderkey, l_linenumber, l_partkey, l_suppkey, a <> b and (a > 0) = (b > 0) and abs(b - a) <= 0.005 * greatest(abs(a), abs(b)) and ({rounds("a", "b")} or {rounds("b", "a")}) as same,
          {digits("b")} as digits, length(regexp_replace(cast(cast(round_even(abs(b) * 100, 0) as decimal(38, 0)) as varchar), '0+$', '')) >= 4 as distinct_figure from p""",
        "period_types": f"with {facts_} select {kind} as period_type, count(*) as n from facts group by 1",
    }
