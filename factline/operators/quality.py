"""Declared data-quality gates: every suite of a dataset is one aggregate pass.

Nulls pass in_set, in_range and matches_regex; not_null is for them."""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factline.config import METRICS, UNIT_PATTERNS, metric_rows
from factline.operators import asof
from factline.schemas import CHANGE_TYPES, TAXONOMIES, fit

# The accepted forms.
FORMS = ("10-K", "10-Q", "10-K/A", "10-Q/A", "10-KT", "10-KT/A", "8-K", "8-K/A", "20-F", "20-F/A", "40-F", "6-K", "6-K/A", "S-1", "S-1/A", "S-4", "S-4/A", "DEF 14A")


class GateFailed(RuntimeError):
    def __init__(self, gate: str, failures: list[dict]):
        super().__init__(f"{gate}: " + "; ".join(f"{f['suite']} {f['check']} {f['column'] or ''} ({f['failing_rows']} rows)" for f in failures))
        self.failures = failures


def check(kind: str, column: str | None = None, severity: str = "error", **options) -> dict:
    return {"check": kind, "column": column, "severity": severity, **options}


PRE = [
    ("observation_batch", "batch_observations_dq", [
        check("columns_exist", columns=["fact_key", "ticker", "taxonomy", "concept", "unit", "period_end", "value", "accn", "filed"]),
        check("row_count", min=1),
        *[check("not_null", c) for c in ("ticker", "concept", "period_end", "value", "accn", "filed")],
        check("in_set", "taxonomy", values=TAXONOMIES), check("matches_regex", "ticker", pattern=r"[A-Z][A-Z.\-]{0,9}"), check("in_set", "unit_matches_config", values=[True]),
        check("in_range", "period_days", min=1), check("in_range", "filing_lag_days", min=0), check("in_range", "days_filed_in_future", max=0),
    ]),
    ("sec_filings", "batch_filings_dq", [check("matches_regex", "accn", pattern=r"\d{10}-\d{2}-\d{6}"), check("in_set", "form", severity="warn", values=FORMS)]),
    ("developer_activity", "batch_developer_activity_dq", [check("matches_regex", "accn", pattern=r"gh-\d{4}-\d{2}-\d{2}"), check("in_range", "period_days", min=7, max=7), check("in_range", "value", min=0)]),
]
POST = [
    ("history_invariants", "facts_history", [check("unique", "version_id"), check("not_null", "known_from"), check("in_set", "change_type", values=CHANGE_TYPES)]),
    ("exactly_one_current_version_per_fact", "dq_open_versions_per_fact", [check("in_range", "open_versions", min=1, max=1)]),
    ("no_empty_or_negative_intervals", "dq_invalid_intervals", [check("row_count", max=0)]),
    ("no_overlapping_versions", "dq_overlapping_versions", [check("row_count", max=0)]),
    ("every_change_is_explained", "change_log", [check("not_null", "explanation"), check("unique", "change_id")]),
    ("every_company_is_fresh", "dq_days_since_last_filing", [check("in_range", "days_since_last_filing", severity="warn", max=120)]),
    ("developer_activity_is_fresh", "dq_days_since_last_collection", [check("in_range", "days_since_last_collection", severity="warn", max=3)]),
]
RECONCILIATION = [
    ("published_matches_source", "facts_current", [check("row_count_parity", reference="observations_latest", tolerance=0.0), check("value_parity", key="fact_key", columns=["value"], reference="observations_latest")])
]


def _bad(c: dict) -> Column:
    col = F.col(c["column"])
    if c["check"] == "not_null":
        return F.count_if(col.isNull())
    if c["check"] == "in_set":
        return F.count_if(col.isNotNull() & ~col.isin(list(c["values"])))
    if c["check"] == "matches_regex":
        return F.count_if(~col.rlike(f"\\A(?:{c['pattern']})\\z"))
    low = col < c["min"] if "min" in c else F.lit(False)
    return F.count_if(low | (col > c["max"] if "max" in c else F.lit(False)))


def value_parity(left: DataFrame, right: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Keys that one side lacks, or whose values differ (null equals null)."""
    a, b = left.select(key, F.struct(*columns).alias("l")), right.select(key, F.struct(*columns).alias("r"))
    return a.join(b, key, "full_outer").filter(F.col("l").isNull() | F.col("r").isNull() | ~F.col("l").eqNullSafe(F.col("r")))


def run_suites(gate: str, suites: list, datasets: dict[str, DataFrame]) -> list[dict]:
    """One result a check; ``status`` passed or failed, ``failing_rows``, ``observed``."""
    out = []
    for suite, name, checks in suites:
        df = datasets[name]
        simple = [c for c in checks if c["check"] in ("not_null", "in_set", "matches_regex", "in_range") and c["column"] in df.columns]
        row = df.agg(F.count("*").alias("n"), *[_bad(c).alias(f"c{i}") for i, c in enumerate(simple)]).first()
        for c in checks:
            kind, observed = c["check"], {}
            if c in simple:
                bad = row[f"c{simple.index(c)}"]
            elif kind == "columns_exist":
                observed["missing"] = sorted(set(c["columns"]) - set(df.columns))
                bad = len(observed["missing"])
            elif kind == "row_count":
                observed["rows"] = row["n"]
                bad = max(0, c.get("min", 0) - row["n"], row["n"] - c.get("max", row["n"]))
            elif kind == "unique":
                bad = df.groupBy(c["column"]).count().filter("count > 1").count()
            elif kind == "row_count_parity":
                other = datasets[c["reference"]].count()
                observed = {"rows": row["n"], "reference": other}
                bad = 0 if abs(row["n"] - other) <= c["tolerance"] * max(1, other) else abs(row["n"] - other)
            elif kind == "value_parity":
                bad = value_parity(df, datasets[c["reference"]], c["key"], c["columns"]).count()
            else:
                bad = row["n"]  # its column is missing
            out.append({"gate": gate, "suite": suite, "dataset": name, "check": kind, "column": c["column"], "status": "failed" if bad else "passed", "severity": c["severity"], "failing_rows": int(bad), "message": f"{kind} failed" if bad else "", "observed": json.dumps(observed)})
    return out


def failures(results: list[dict], severity: str = "error") -> list[dict]:
    return [r for r in results if r["status"] == "failed" and r["severity"] == severity]


def batch_views(batch: DataFrame, today) -> dict[str, DataFrame]:
    rows = [(r[4], r[5], r[3]) for r in metric_rows(METRICS)]
    patterns = {}
    for taxonomy, concept, pattern in rows:
        patterns.setdefault(pattern, []).append(f"{taxonomy}|{concept}")
    named = F.concat_ws("|", "taxonomy", "concept")
    fits = F.lit(False)
    for pattern in UNIT_PATTERNS.values():
        fits = fits | (named.isin(patterns.get(pattern, [])) & F.coalesce(F.col("unit").rlike(f"\\A(?:{pattern})\\z"), F.lit(False)))
    day = F.lit(today).cast("date")
    df = batch.withColumns({
        "period_days": F.datediff("period_end", "period_start") + 1, "filing_lag_days": F.datediff("filed", "period_end"), "days_filed_in_future": F.datediff("filed", day),
        "unit_matches_config": F.when(F.col("taxonomy") == "github", F.col("unit") == "commits").otherwise(fits),
    })
    return {"batch_observations_dq": df, "batch_filings_dq": df.filter("taxonomy in ('us-gaap', 'ifrs-full')"), "batch_developer_activity_dq": df.filter("taxonomy = 'github'")}


def history_views(facts: DataFrame, observations: DataFrame, changes: DataFrame, today) -> dict[str, DataFrame]:
    return {
        "facts_history": facts, "change_log": changes, "facts_current": asof.facts_current(facts), "observations_latest": asof.observations_latest(observations),
        "dq_open_versions_per_fact": asof.open_versions(facts), "dq_invalid_intervals": asof.invalid_intervals(facts), "dq_overlapping_versions": asof.overlapping_versions(facts),
        "dq_days_since_last_filing": asof.days_since_last_filing(observations, today), "dq_days_since_last_collection": asof.days_since_last_collection(observations, today),
    }


def check_batch(batch: DataFrame, today) -> list[dict]:
    return run_suites("pre_publish", PRE, batch_views(batch, today))


def audit(facts: DataFrame, observations: DataFrame, changes: DataFrame, today) -> list[dict]:
    views = history_views(facts, observations, changes, today)
    return run_suites("post_publish", POST, views) + run_suites("reconciliation", RECONCILIATION, views)


def as_rows(spark, results: list[dict], run_id: str, at: datetime) -> DataFrame:
    names = ["gate", "suite", "dataset", "check", "column", "status", "severity", "failing_rows", "message", "observed"]
    schema = ", ".join(f"`{n}` {'long' if n == 'failing_rows' else 'string'}" for n in names)
    df = spark.createDataFrame([tuple(r[n] for n in names) for r in results], schema)
    return fit(df.withColumn("run_id", F.lit(run_id)).withColumn("recorded_at", F.lit(at)), "dq_results")
