"""Stored tables, as declared schemas; every read and write is cast to them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OBSERVATIONS = """fact_key string, ticker string, cik long, entity_name string, taxonomy string, concept string, unit string,
 period_start date, period_end date, value double, accn string, form string, fiscal_year int, fiscal_period string, filed date,
 frame string, recorded_at timestamp, run_id string"""
FACTS = """version_id string, fact_key string, ticker string, entity_name string, taxonomy string, concept string, unit string,
 period_start date, period_end date, value double, known_from date, known_to date, source_accn string, source_form string,
 change_type string, recorded_at timestamp, run_id string"""
CHANGES = """change_id string, fact_key string, ticker string, entity_name string, concept string, unit string, period_start date,
 period_end date, old_value double, new_value double, pct_change double, effective_date date, old_accn string, new_accn string,
 new_form string, classification string, headline string, guidance string, explanation string, recorded_at timestamp, run_id string"""
CORRECTIONS = """correction_id string, fact_key string, ticker string, entity_name string, taxonomy string, concept string, unit string,
 period_start date, period_end date, current_value double, proposed_value double, accn string, form string, filed date,
 reason_code string, detail string, status string, created_at timestamp, run_id string, reviewed_by string, reviewed_at timestamp,
 review_note string"""
RUNS = """run_id string, source string, tickers string, started_at timestamp, finished_at timestamp, status string,
 observations_in long, new_facts long, restatements long, confirmations long, already_seen long, quarantined long, dq_warnings long,
 message string"""
DQ = """run_id string, gate string, suite string, dataset string, check string, column string, status string, severity string,
 failing_rows long, message string, observed string, recorded_at timestamp"""

TABLES = {
    name: " ".join(ddl.split())
    for name, ddl in {"observations": OBSERVATIONS, "facts_history": FACTS, "change_log": CHANGES, "corrections": CORRECTIONS, "pipeline_runs": RUNS, "dq_results": DQ}.items()
}

TAXONOMIES = ("us-gaap", "ifrs-full", "github")
CHANGE_TYPES = ("initial", "restatement", "manual_correction")
CLASSIFICATIONS = ("restatement", "split_adjustment", "rounding", "manual_correction", "data_revision")
REASONS = ("conflict_within_filing", "same_filing_value_changed", "late_arrival", "same_day_conflict", "suspected_wrong_period", "suspected_scale_error")


def columns(table: str) -> list[tuple[str, str]]:
    return [tuple(c.split()) for c in TABLES[table].split(", ")] if ", " in TABLES[table] else []


def fit(df: DataFrame, table: str) -> DataFrame:
    """``df`` with exactly the table's columns and types; columns it lacks are null."""
    have = set(df.columns)
    return df.select(*[(F.col(n) if n in have else F.lit(None)).cast(t).alias(n) for n, t in columns(table)])


def fact_key():
    """The identity of a number; a missing start keeps its place."""
    return F.concat_ws("|", "ticker", "taxonomy", "concept", "unit", F.coalesce(F.col("period_start").cast("string"), F.lit("")), F.col("period_end").cast("string"))
