"""Review of held values: approve or reject."""

from __future__ import annotations

from datetime import UTC, date, datetime

from pyspark.sql import functions as F

from factline.functions.numbers import stable_id
from factline.operators.explain import explain
from factline.operators.quality import GateFailed, audit, failures
from factline.schemas import fit
from factline.sources.store import Lake


class ReviewError(ValueError):
    pass


def _pending(lake: Lake, correction_id: str):
    rows = lake.read("corrections").filter(F.col("correction_id") == correction_id)
    found = rows.first()
    if found is None:
        raise ReviewError(f"no correction {correction_id}")
    if found["status"] != "pending":
        raise ReviewError(f"{correction_id} is {found['status']}")
    return rows, found


def _decided(rows, status: str, reviewer: str, note: str, now: datetime):
    return rows.withColumns({"status": F.lit(status), "reviewed_by": F.lit(reviewer), "reviewed_at": F.lit(now), "review_note": F.lit(note)})


def reject(lake: Lake, correction_id: str, reviewer: str, note: str = "") -> int:
    rows, _ = _pending(lake, correction_id)
    return lake.change(upserts={"corrections": _decided(rows, "rejected", reviewer, note, datetime.now(UTC))})


def approve(lake: Lake, correction_id: str, reviewer: str, note: str, effective: date | None = None, today: date | None = None) -> int:
    """Publishes the held value from ``effective`` (today if not given) on; all in one commit, made only if the audit passes."""
    if not (note or "").strip():
        raise ReviewError("a note is required")
    rows, c = _pending(lake, correction_id)
    now = datetime.now(UTC)
    effective = effective or now.date()
    open_ = lake.read("facts_history").filter((F.col("fact_key") == c["fact_key"]) & F.col("known_to").isNull())
    cur = open_.first()
    if cur is not None and cur["known_from"] >= effective:
        raise ReviewError(f"the current version is known from {cur['known_from']}")
    run = f"review-{correction_id}"
    base = rows.withColumns({"recorded_at": F.lit(now), "run_id": F.lit(run)})
    day = F.lit(effective)
    version = base.select(
        "*", F.col("proposed_value").alias("value"), day.alias("known_from"), F.lit(None).cast("date").alias("known_to"), F.col("accn").alias("source_accn"), F.concat("form", F.lit(", as reviewed")).alias("source_form"),
        F.lit("manual_correction").alias("change_type"), stable_id(F.col("fact_key"), F.col("correction_id"), day, F.lit("manual_correction")).alias("version_id"),
    )
    old = (lambda n, t: F.lit(cur[n] if cur is not None else None).cast(t))
    change = base.select(
        "*", F.coalesce(old("value", "double"), F.col("proposed_value")).alias("old_value"), F.col("proposed_value").alias("new_value"), F.coalesce(old("source_form", "string"), F.col("form")).alias("old_form"),
        F.coalesce(old("known_from", "date"), F.col("filed")).alias("old_filed"), F.lit(reviewer).alias("reviewer"), F.lit(note).alias("note"),
    )
    change = explain(change.withColumn("filed", day), manual=True)
    if cur is None:
        change = change.withColumn("old_value", F.lit(float("nan"))).withColumn("pct_change", F.lit(None).cast("double"))
    change = change.withColumns({
        "change_id": stable_id(F.col("fact_key"), F.col("correction_id"), F.lit("manual")), "effective_date": day, "old_accn": F.coalesce(old("source_accn", "string"), F.lit("")), "new_accn": F.col("accn"),
        "new_form": F.concat("form", F.lit(", as reviewed")),
    })
    decision = base.withColumns({"value": F.col("proposed_value"), "accn": F.concat(F.lit("manual:"), F.col("correction_id")), "form": F.lit("MANUAL"), "filed": day})
    closed = open_.withColumn("known_to", day)
    base, files = lake.plan(
        {"change_log": fit(change, "change_log"), "observations": fit(decision, "observations")},
        {"facts_history": fit(closed, "facts_history").unionByName(fit(version, "facts_history")), "corrections": _decided(rows, "approved", reviewer, note, now)},
    )
    bad = failures(audit(lake.of(files, "facts_history"), lake.of(files, "observations"), lake.of(files, "change_log"), today or now.date()))
    if bad:
        raise GateFailed("review", bad)
    return lake.commit(base, files)
