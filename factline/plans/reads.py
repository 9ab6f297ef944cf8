"""Named reads over the lake's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factline.operators import asof


def quarterly(history: DataFrame, ticker: str, metric: str, as_of) -> DataFrame:
    own = history.filter((F.col("ticker") == ticker.upper()) & (F.col("metric") == metric))
    return asof.quarterly_as_of(own, as_of).orderBy(F.asc_nulls_last("period_end"))


def metric_values(history: DataFrame, ticker: str, metric: str, as_of, period_type: str | None = None) -> DataFrame:
    own = asof.metrics_as_of(history.filter((F.col("ticker") == ticker.upper()) & (F.col("metric") == metric)), as_of)
    return (own.filter(F.col("period_type") == period_type) if period_type else own).orderBy(F.asc_nulls_last("period_end"), F.asc_nulls_first("period_start"))


def fact_history(history: DataFrame, ticker: str, metric: str, period_end, period_start=None) -> DataFrame:
    own = history.filter((F.col("ticker") == ticker.upper()) & (F.col("metric") == metric) & (F.col("period_end") == F.lit(period_end).cast("date")))
    own = own.filter(F.col("period_start") == F.lit(period_start).cast("date")) if period_start else own
    return own.orderBy(F.asc_nulls_first("period_start"), "known_from")


def developer_activity(facts: DataFrame, ticker: str, as_of) -> DataFrame:
    return asof.developer_activity_as_of(facts.filter(F.col("ticker") == ticker.upper()), as_of).orderBy("repo", "week_start")


def compare_as_of(history: DataFrame, changes: DataFrame, ticker: str, metric: str, before, after) -> DataFrame:
    """Periods whose value differs between two days, with the change that says why.  Periods without a start never match."""
    own = history.filter((F.col("ticker") == ticker.upper()) & (F.col("metric") == metric))
    a = asof.metrics_as_of(own, before).select("period_start", "period_end", F.col("value").alias("value_before"))
    b = asof.metrics_as_of(own, after).select("period_start", "period_end", "fact_key", "unit", F.col("value").alias("value_after"), "known_from", "source_accn")
    both = a.join(b, ["period_start", "period_end"]).filter("value_before <> value_after")
    c = changes.select(F.col("fact_key").alias("c_key"), "new_accn", "classification", "explanation")
    why = both.join(c, F.col("c_key").eqNullSafe(F.col("fact_key")) & (F.col("new_accn") == F.col("source_accn")), "left")
    return why.select("period_start", "period_end", "unit", "value_before", "value_after", "known_from", "source_accn", "classification", "explanation").orderBy("period_end")


def changes(log: DataFrame, ticker: str | None = None, since=None, classification: str | None = None, min_abs_pct: float = 0.0, limit: int = 100) -> DataFrame:
    """Newest first; a change without a percentage always passes."""
    df = log.filter(F.col("pct_change").isNull() | (F.abs("pct_change") >= min_abs_pct))
    for column, value in (("ticker", ticker and ticker.upper()), ("classification", classification)):
        df = df.filter(F.col(column) == value) if value else df
    df = df.filter(F.col("effective_date") >= F.lit(since).cast("date")) if since else df
    return df.orderBy(F.desc("effective_date"), "ticker", "change_id").limit(limit)


def corrections(table: DataFrame, status: str | None = "pending") -> DataFrame:
    return (table.filter(F.col("status") == status) if status else table).orderBy(F.desc("filed"), "correction_id")


def runs(table: DataFrame, limit: int = 20) -> DataFrame:
    return table.orderBy(F.desc("started_at"), "run_id").limit(limit)


def companies(facts: DataFrame, observations: DataFrame) -> DataFrame:
    """One row a ticker: names, what is there, when it was last heard of."""
    name = F.min(F.when(F.col("taxonomy") != "github", F.col("entity_name")))
    own = facts.groupBy("ticker").agg(
        F.coalesce(name, F.min("entity_name")).alias("entity_name"), F.bool_or(F.col("taxonomy") == "github").alias("has_activity"), F.bool_or(F.col("taxonomy") != "github").alias("has_filings"), F.max("known_from").alias("last_known_from")
    )
    return own.join(observations.groupBy("ticker").agg(F.min("cik").alias("cik")), "ticker", "left")
