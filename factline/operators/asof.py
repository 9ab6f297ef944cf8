"""The semantic layer: facts and metrics as they were known on a day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from factline.functions.prose import period_type


def known_on(day: Column) -> Column:
    return (F.col("known_from") <= day) & (F.col("known_to").isNull() | (F.col("known_to") > day))


def _day(d) -> Column:
    return d if isinstance(d, Column) else F.lit(d).cast("date")


def facts_as_of(facts: DataFrame, day) -> DataFrame:
    return facts.filter(known_on(_day(day)))


def facts_current(facts: DataFrame) -> DataFrame:
    return facts.filter("known_to is null")


def metric_history(facts: DataFrame, concepts: DataFrame) -> DataFrame:
    """Every version of every metric.  The metric map has one row a configured concept, so Spark may broadcast it."""
    whole = F.concat(F.lit("\\A(?:"), F.col("unit_pattern"), F.lit(")\\z"))
    joined = facts.join(concepts, ["taxonomy", "concept"]).filter(F.rlike(F.col("unit"), whole))
    return joined.withColumn("period_type", period_type(F.col("period_start"), F.col("period_end"))).drop("unit_pattern")


def metrics_as_of(history: DataFrame, day) -> DataFrame:
    """The concept of the best priority for each metric and period; ties go to the smallest concept and unit."""
    rank = F.row_number().over(W.partitionBy("ticker", "metric", "period_start", "period_end").orderBy("priority", "taxonomy", "concept", "unit", "version_id"))
    return history.filter(known_on(_day(day))).withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


_QUARTER = ["ticker", "entity_name", "metric", "label", "kind", "unit", "period_start", "period_end", "value", "known_from", "source_form", "derived"]


def quarterly_as_of(history: DataFrame, day) -> DataFrame:
    """Reported quarters, and fourth quarters as the year less its three quarters where none was reported."""
    m = metrics_as_of(history, day)
    reported = m.filter("period_type = 'quarter'").withColumn("derived", F.lit(False)).select(*_QUARTER)
    year = m.filter("period_type = 'annual' and kind = 'flow'")
    q = reported.select("ticker", "metric", F.col("period_start").alias("q_start"), F.col("period_end").alias("q_end"), F.col("value").alias("q_value"), F.col("known_from").alias("q_from"))
    open_year = year.join(reported.select("ticker", "metric", "period_end"), ["ticker", "metric", "period_end"], "left_anti")
    inside = open_year.join(q, ["ticker", "metric"]).filter("q_start >= period_start and q_end < period_end")
    keys = ["ticker", "entity_name", "metric", "label", "kind", "unit", "period_end", "value", "known_from"]
    three = inside.groupBy(*keys).agg(F.count("*").alias("n"), F.sum("q_value").alias("spent"), F.max("q_end").alias("last"), F.max("q_from").alias("q_from")).filter("n = 3")
    fourth = three.select(
        "ticker", "entity_name", "metric", "label", "kind", "unit", F.date_add("last", 1).alias("period_start"), "period_end", (F.col("value") - F.col("spent")).alias("value"),
        F.greatest("known_from", "q_from").alias("known_from"), F.lit("derived: FY - Q1..Q3").alias("source_form"), F.lit(True).alias("derived"),
    )
    return reported.unionByName(fourth)


def developer_activity_as_of(facts: DataFrame, day) -> DataFrame:
    return facts_as_of(facts.filter("taxonomy = 'github'"), day).select(
        "ticker", F.col("concept").alias("repo"), F.col("period_start").alias("week_start"), F.col("period_end").alias("week_end"), F.col("value").alias("commits"), F.col("known_from").alias("collected_on"), "change_type"
    )


def observations_latest(observations: DataFrame) -> DataFrame:
    good = observations.filter("value is not null")
    return good.groupBy("fact_key").agg(F.max_by("value", F.struct("filed", "accn")).alias("value"))


def open_versions(facts: DataFrame) -> DataFrame:
    return facts.groupBy("fact_key").agg(F.count_if(F.col("known_to").isNull()).alias("open_versions"))


def invalid_intervals(facts: DataFrame) -> DataFrame:
    return facts.filter("known_to is not null and known_to <= known_from").select("version_id", "known_from", "known_to")


def overlapping_versions(facts: DataFrame) -> DataFrame:
    """Pairs of overlapping versions.  Only versions that a running maximum shows to overlap an earlier one, and their facts, are paired."""
    end = F.coalesce("known_to", F.lit("9999-12-31").cast("date"))
    before = F.max(end).over(W.partitionBy("fact_key").orderBy("known_from", "version_id").rowsBetween(W.unboundedPreceding, -1))
    bad = facts.withColumn("_before", before).filter(F.col("_before") > F.col("known_from")).select("fact_key").distinct()
    v = facts.join(bad, "fact_key", "left_semi").select("fact_key", "version_id", "known_from", end.alias("end"))
    a, b = v.alias("a"), v.alias("b")
    pairs = a.join(b, (F.col("a.fact_key") == F.col("b.fact_key")) & (F.col("a.version_id") < F.col("b.version_id")) & (F.col("a.known_from") < F.col("b.end")) & (F.col("b.known_from") < F.col("a.end")))
    return pairs.select("a.fact_key", F.col("a.version_id").alias("version_a"), F.col("b.version_id").alias("version_b"))


def days_since_last_filing(observations: DataFrame, today) -> DataFrame:
    """Only the taxonomy (or taxonomies) that a company used last."""
    own = observations.filter("taxonomy in ('us-gaap', 'ifrs-full') and form <> 'MANUAL'").groupBy("ticker", "taxonomy").agg(F.datediff(_day(today), F.max("filed")).cast("long").alias("days_since_last_filing"))
    return own.withColumn("_least", F.min("days_since_last_filing").over(W.partitionBy("ticker"))).filter("days_since_last_filing = _least").drop("_least")


def days_since_last_collection(observations: DataFrame, today) -> DataFrame:
    return observations.filter("taxonomy = 'github'").groupBy(F.col("concept").alias("repo")).agg(F.datediff(_day(today), F.max("filed")).cast("long").alias("days_since_last_collection"))


def register(spark: SparkSession, facts: DataFrame, observations: DataFrame, concepts: DataFrame, today=None) -> None:
    """Views, and table functions that take a day, for Spark SQL."""
    day, history = _day(today) if today else F.current_date(), metric_history(facts, concepts)
    views = {
        "facts_history": facts, "observations": observations, "metric_concepts": concepts, "metric_history": history, "facts_current": facts_current(facts), "observations_latest": observations_latest(observations),
        "dq_open_versions_per_fact": open_versions(facts), "dq_invalid_intervals": invalid_intervals(facts), "dq_overlapping_versions": overlapping_versions(facts),
        "dq_days_since_last_filing": days_since_last_filing(observations, day), "dq_days_since_last_collection": days_since_last_collection(observations, day),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    on = "known_from <= d and (known_to is null or known_to > d)"
    columns = lambda df: ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)
    spark.sql(f"create or replace temporary function facts_as_of(d date) returns table ({columns(facts)}) return select * from facts_history where {on}")
    names = ", ".join(history.columns)
    best = "row_number() over (partition by ticker, metric, period_start, period_end order by priority, taxonomy, concept, unit, version_id)"
    spark.sql(f"create or replace temporary function metrics_as_of(d date) returns table ({columns(history)}) return select {names} from (select *, {best} as _rank from metric_history where {on}) where _rank = 1")
    spark.sql(
        f"create or replace temporary function developer_activity_as_of(d date) returns table (ticker string, repo string, week_start date, week_end date, commits double, collected_on date, change_type string) "
        f"return select ticker, concept, period_start, period_end, value, known_from, change_type from facts_history where taxonomy = 'github' and {on}"
    )
    same = "q.ticker = y.ticker and q.metric = y.metric"
    spark.sql(
        f"""create or replace temporary function quarterly_as_of(d date)
        returns table (ticker string, entity_name string, metric string, label string, kind string, unit string, period_start date, period_end date, value double, known_from date, source_form string, derived boolean)
        return with m as (select * from metrics_as_of(d)), q as (select * from m where period_type = 'quarter'), y as (select * from m where period_type = 'annual' and kind = 'flow'),
          open_years as (select y.* from y left anti join q on {same} and q.period_end = y.period_end)
        select ticker, entity_name, metric, label, kind, unit, period_start, period_end, value, known_from, source_form, false from q
        union all
        select y.ticker, y.entity_name, y.metric, y.label, y.kind, y.unit, date_add(max(q.period_end), 1), y.period_end, y.value - sum(q.value), greatest(y.known_from, max(q.known_from)), 'derived: FY - Q1..Q3', true
        from open_years y join q on {same} and q.period_start >= y.period_start and q.period_end < y.period_end
        group by y.ticker, y.entity_name, y.metric, y.label, y.kind, y.unit, y.period_end, y.value, y.known_from having count(*) = 3"""
    )
