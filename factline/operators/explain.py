"""Change classification and its wording.

Input columns: ticker, entity_name, taxonomy, concept, unit, period_start, period_end, old_value,
new_value, old_form, old_filed, form, filed; for reviewed changes reviewer and note."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factline.functions.numbers import detect_split, is_rounding, pct_change
from factline.functions.prose import company_name, concept_label, describe_period, form_name, format_value, human_date, size_word


def classify(manual: Column | bool = False) -> Column:
    """manual correction, data revision, rounding, split, restatement: the first that holds."""
    old, new, unit = F.col("old_value"), F.col("new_value"), F.col("unit")
    return (
        F.when(F.lit(manual) if isinstance(manual, bool) else manual, "manual_correction")
        .when(F.col("taxonomy") == "github", "data_revision")
        .when(is_rounding(old, new), "rounding")
        .when(detect_split(old, new, unit).isNotNull(), "split_adjustment")
        .otherwise("restatement")
    )


def explain(changes: DataFrame, manual: bool = False) -> DataFrame:
    """Adds pct_change, classification, headline, guidance, explanation."""
    old, new, unit = F.col("old_value"), F.col("new_value"), F.col("unit")
    df = changes.withColumn("pct_change", pct_change(old, new)).withColumn("classification", classify(manual)).withColumn("_ratio", detect_split(old, new, unit))
    kind = F.col("classification")
    text = lambda *parts: F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])
    who, what, when = company_name(F.col("ticker"), F.col("entity_name")), concept_label(F.col("concept")), describe_period(F.col("period_start"), F.col("period_end"))
    values = text(format_value(old, unit), " to ", format_value(new, unit))
    reverse = F.when(F.when(unit.endswith("/shares"), F.abs(new) > F.abs(old)).otherwise(F.abs(new) < F.abs(old)), "reverse ").otherwise("")
    move = F.when(F.abs(old) > F.abs(new), "divided").otherwise("multiplied")
    note = F.col("note") if "note" in df.columns else F.lit("")
    reviewer = F.col("reviewer") if "reviewer" in df.columns else F.lit("")
    grew = F.when(new > old, "grew").otherwise("shrank")
    headline = (
        F.when(kind == "manual_correction", text(who, ": ", what, " ", when, " corrected by review from ", values, "."))
        .when(kind == "data_revision", text(who, ": commits in ", F.col("concept"), " for the week of ", human_date(F.col("period_start")), " revised from ", values, "."))
        .when(kind == "rounding", text(who, ": ", what, " ", when, " stated with another rounding, ", values, "."))
        .when(kind == "split_adjustment", text(who, ": ", what, " ", when, " restated from ", values, " for a ", reverse, F.col("_ratio").cast("string"), "-for-1 stock split."))
        .otherwise(text(who, ": ", what, " ", when, " restated from ", values, size_word(F.col("pct_change")), "."))
    )
    source = text("First in ", form_name(F.col("old_form")), " of ", human_date(F.col("old_filed")), ", now in ", form_name(F.col("form")), " of ", human_date(F.col("filed")), ".")
    detail = (
        F.when(kind == "manual_correction", text("Reviewed by ", reviewer, ": ", note, ". ", source))
        .when(kind == "data_revision", text("Collected on ", human_date(F.col("old_filed")), " and again on ", human_date(F.col("filed")), "; the count ", grew, "."))
        .when(kind == "split_adjustment", text("The figure was ", move, " by ", F.col("_ratio").cast("string"), ". ", source))
        .otherwise(source)
    )
    guidance = (
        F.when(kind == "manual_correction", "Queries for dates before the review still give the earlier value.")
        .when(kind == "data_revision", F.when(new > old, "Late pushes and merges add commits to past weeks.").otherwise("Rewritten history takes commits from past weeks."))
        .when(kind == "rounding", "No change in substance.")
        .when(kind == "split_adjustment", "Compare only figures on one share basis.")
        .otherwise("Back-tests should use the value known on their date.")
    )
    df = df.withColumn("headline", headline).withColumn("guidance", guidance)
    return df.withColumn("explanation", F.concat_ws(" ", "headline", detail, "guidance")).drop("_ratio")
