"""From observations to versions: a keyed, ordered fold in Catalyst.

The batch is dealt once by fact; a fact's filings, one row each, become a sorted array, and a fold over
it, as a higher-order function, decides what happens to each.  Evidence about the whole batch comes
from joins on a series and on dates a year apart, and arrives at the facts as small maps by filing, so
that the batch itself is not dealt again.  A first fold over the facts that have such evidence finds
the filings that can't be trusted.  A fact has few filings, so an array is small; nothing runs in
Python."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from factline.functions.numbers import distinctive, last_digit, scale_factor, stable_id
from factline.operators.explain import explain
from factline.schemas import fact_key, fit

SERIES = ["ticker", "taxonomy", "concept", "unit", "weeks"]
# How far apart two ends lie that are one year apart, and units whose periods don't add up.
YEAR = (358, 372)
NOT_SUMMED = ("shares", "commits")
_FOLD_OUT = "array<struct<action:string,reason:string,old_value:double,old_from:date,old_accn:string,old_form:string>>"
_TWINS = "array<struct<end:date,took:boolean,now:array<double>>>"
_OPEN = ["cur_value", "cur_from", "cur_accn", "cur_form", "cur_distinct", "cur_half"]


class Result:
    """``decided``: every (fact, filing) with its action; the rest is what to write, planned on first use unless given."""

    def __init__(
        self, decided: DataFrame, records: DataFrame | None = None, versions: DataFrame | None = None, closures: DataFrame | None = None, changes: DataFrame | None = None, corrections: DataFrame | None = None
    ) -> None:
        self.decided = decided
        given = {"records": records, "versions": versions, "closures": closures, "changes": changes, "corrections": corrections}
        self.__dict__ |= {name: df for name, df in given.items() if df is not None}

    def counters(self) -> dict[str, int]:
        names = {"initial": "new_facts", "restatement": "restatements", "confirmation": "confirmations", "already_seen": "already_seen", "held": "quarantined", "held_before": "quarantine_already_recorded"}
        found = {r[0]: r[1] for r in self.decided.groupBy("action").count().collect()}
        return {v: found.get(k, 0) for k, v in names.items()}

    @cached_property
    def records(self) -> DataFrame:
        return fit(self.decided.filter("action in ('initial', 'restatement', 'confirmation')"), "observations")

    @cached_property
    def _moved(self) -> DataFrame:
        return self.decided.filter("action in ('initial', 'restatement')")

    @cached_property
    def _lined(self) -> DataFrame:
        """What moved, with the next move of the same fact and whether there was one before."""
        by = W.partitionBy("fact_key").orderBy("filed")
        return self._moved.withColumn("known_to", F.lead("filed").over(by)).withColumn("before", F.lag("filed").over(by))

    @cached_property
    def versions(self) -> DataFrame:
        versions = self._lined.select(
            "*", F.col("filed").alias("known_from"), F.col("accn").alias("source_accn"), F.col("form").alias("source_form"), F.col("action").alias("change_type"),
            stable_id(F.col("fact_key"), F.col("accn"), F.col("filed"), F.col("action")).alias("version_id"),
        )
        return fit(versions, "facts_history")

    @cached_property
    def closures(self) -> DataFrame:
        """Ends of versions that an earlier batch published."""
        first = self._lined.filter("before is null and action = 'restatement'")
        return first.select("fact_key", F.col("old_accn").alias("source_accn"), F.col("old_from").alias("known_from"), F.col("filed").alias("known_to"))

    @cached_property
    def changes(self) -> DataFrame:
        changes = explain(self._moved.filter("action = 'restatement'").withColumnRenamed("value", "new_value").withColumn("old_filed", F.col("old_from")))
        ids = stable_id(F.col("fact_key"), F.col("old_accn"), F.col("accn")).alias("change_id")
        return fit(changes.select("*", ids, F.col("filed").alias("effective_date"), F.col("accn").alias("new_accn"), F.col("form").alias("new_form")), "change_log")

    @cached_property
    def corrections(self) -> DataFrame:
        held = self.decided.filter("action = 'held'").select(
            "*", stable_id(F.col("fact_key"), F.col("accn"), F.col("value")).alias("correction_id"), F.when(F.col("reason") != "conflict_within_filing", F.col("old_value")).alias("current_value"),
            F.col("value").alias("proposed_value"), F.col("reason").alias("reason_code"), F.concat(F.lit("held: "), F.translate("reason", "_", " ")).alias("detail"), F.lit("pending").alias("status"), F.col("recorded_at").alias("created_at"),
        )
        return fit(held.dropDuplicates(["fact_key", "accn", "proposed_value"]), "corrections")


def _pairs(ends: DataFrame) -> DataFrame:
    """SERIES, period_end, e_end: ends of one series that lie a year apart, found by buckets as wide as the band."""
    day, low, high = F.unix_date("period_end"), *YEAR
    wide = high - low + 1
    at = lambda d: F.floor(d / wide)
    near = F.array(*[at(day + d) for d in (-high, -low, low, high)])
    probes = ends.select(*SERIES, "period_end", F.explode(F.array_distinct(near)).alias("bucket"))
    found = probes.join(ends.select(*SERIES, F.col("period_end").alias("e_end"), at(day).alias("bucket")), [*SERIES, "bucket"])
    return found.filter(F.abs(F.datediff("e_end", "period_end")).between(low, high)).drop("bucket")


def _twins(obs: DataFrame, pairs: DataFrame) -> DataFrame:
    """fact_key, twins: by filing, for each end a year away in the series, whether the value stood there
    earlier, and what the same filing says of it."""
    # instants form a series, too: their weeks are -1, never null
    e = obs.select(*SERIES, F.col("period_end").alias("e_end"), F.col("value").alias("e_value"), F.col("filed").alias("e_filed"), F.col("accn").alias("e_accn")).distinct()
    rows = obs.groupBy("fact_key", "accn", *SERIES, "period_end").agg(F.min(F.struct("filed", "value")).alias("o")).select("fact_key", "accn", *SERIES, "period_end", "o.*")
    near = rows.join(pairs, [*SERIES, "period_end"]).join(e, [*SERIES, "e_end"])
    per = near.groupBy("fact_key", "accn", "e_end").agg(
        F.max((F.col("e_value") == F.col("value")) & (F.col("e_filed") < F.col("filed"))).alias("took"),
        F.collect_set(F.when(F.col("e_accn") == F.col("accn"), F.col("e_value"))).alias("now"),
    )
    by_filing = per.groupBy("fact_key", "accn").agg(F.array_sort(F.collect_list(F.struct(F.col("e_end").alias("end"), "took", "now"))).alias("twins"))
    return _by_filing(by_filing, "twins")


def _shorter(obs: DataFrame) -> DataFrame:
    """fact_key, shorter: by filing, weeks of a shorter period with the same end and value, stated no later."""
    keys = ["ticker", "taxonomy", "concept", "unit", "period_end", "value"]
    spans = obs.filter(F.col("weeks").between(0, 1 << 30) & (F.col("value") != 0) & ~F.col("unit").isin(*NOT_SUMMED))
    e = spans.groupBy(*keys, F.col("weeks").alias("e_weeks")).agg(F.min("filed").alias("e_filed"))
    own = spans.select("fact_key", "accn", "filed", "weeks", *keys)
    hit = own.join(e, keys).filter("e_weeks < weeks and e_filed <= filed")
    return _by_filing(hit.groupBy("fact_key", "accn").agg(F.min("e_weeks").alias("shorter")), "shorter")


def _by_filing(rows: DataFrame, value: str) -> DataFrame:
    return rows.groupBy("fact_key").agg(F.map_from_entries(F.collect_list(F.struct("accn", value))).alias(value))


def _let(x: Column, then: Callable[[Column], Column]) -> Column:
    """``then(x)`` with x worked out once: inside a lambda, a column used twice is evaluated twice."""
    return F.get(F.transform(F.array(x), then), 0)


def _twin(o: Column, cur: Column, cur_distinct: Column) -> Column:
    """The first end that says the value belongs to another year, else null."""

    def suspect(t: Column) -> Column:
        new = t["took"] & (F.size(t["now"]) > 0) & ~F.array_contains(t["now"], o["value"]) & o["distinct"]
        old = F.array_contains(t["now"], cur) & (t["took"] | cur_distinct)
        return F.coalesce(F.when(cur.isNull(), new).otherwise(old), F.lit(False))

    return F.get(F.filter(o["twins"], suspect), 0)["end"]


def _taint(facts: DataFrame) -> DataFrame:
    """ticker, accn, weeks, period_end of filings that put figures on the wrong year; both years count."""
    out = "array<struct<accn:string,ends:array<date>>>"
    start = F.struct(F.col("cur_value").alias("prior"), F.col("cur_distinct").alias("distinct"), F.expr(f"cast(array() as {out})").alias("out"))

    def step(acc: Column, o: Column) -> Column:
        same = F.coalesce(acc["prior"] == o["value"], F.lit(False))

        def then(twin: Column) -> Column:
            marked = F.concat(acc["out"], F.array(F.struct(o["accn"].alias("accn"), F.array(F.col("period_end"), twin).alias("ends")))).cast(out)
            stays = same | twin.isNotNull()
            pick = lambda new, old: F.when(stays, acc[old]).otherwise(o[new])
            return F.struct(pick("value", "prior").alias("prior"), pick("distinct", "distinct").alias("distinct"), F.when(~same & twin.isNotNull(), marked).otherwise(acc["out"]).alias("out"))

        return _let(_twin(o, acc["prior"], acc["distinct"]), then)

    fresh = F.filter("filings", lambda o: ~o["skip"])
    found = facts.select("ticker", "weeks", F.explode(F.aggregate(fresh, start, step, lambda a: a["out"])).alias("t"))
    return found.select("ticker", "weeks", F.col("t.accn").alias("accn"), F.explode("t.ends").alias("period_end")).distinct()


def _walk(filings: Column) -> Column:
    """Every filing's action, in order; the first rule that holds.  Filings to skip change nothing."""
    state = ["value", "since", "accn", "form", "distinct", "half"]
    start = F.struct(*[F.col("cur_from" if c == "since" else f"cur_{c}").alias(c) for c in state], F.expr(f"cast(array() as {_FOLD_OUT})").alias("out"))

    def step(acc: Column, o: Column) -> Column:
        none, equal = acc["since"].isNull(), o["value"] == acc["value"]
        twin = _twin(o, F.when(~none, acc["value"]), acc["distinct"]).isNotNull()
        half = F.when(F.abs(o["value"]) < F.abs(acc["value"]), o["half"]).otherwise(acc["half"])
        reason = (
            F.when(o["skip"] | (~none & equal), F.lit(None))
            .when(~none & (o["filed"] < acc["since"]), F.lit("late_arrival"))
            .when(twin | o["tainted"] | (~none & o["shorter"].isNotNull()), F.lit("suspected_wrong_period"))
            .when(none, F.lit(None))
            .when((F.col("unit") != "commits") & scale_factor(acc["value"], o["value"], half).isNotNull(), F.lit("suspected_scale_error"))
            .when(o["filed"] == acc["since"], F.lit("same_day_conflict"))
        )

        def decide(reason: Column) -> Column:
            action = F.when(o["skip"], F.lit(None)).when(reason.isNotNull(), "held").when(none, "initial").when(equal, "confirmation").otherwise("restatement")
            return F.struct(action.alias("action"), reason.alias("reason"))

        def move(d: Column) -> Column:
            event = F.struct(
                d["action"].alias("action"), d["reason"].alias("reason"), acc["value"].alias("old_value"), acc["since"].alias("old_from"), acc["accn"].alias("old_accn"), acc["form"].alias("old_form")
            )
            moves = F.coalesce(d["action"].isin("initial", "restatement"), F.lit(False))
            kept = [F.when(moves, o["filed" if c == "since" else c]).otherwise(acc[c]).alias(c) for c in state]
            return F.struct(*kept, F.concat(acc["out"], F.array(event)).cast(_FOLD_OUT).alias("out"))

        return _let(_let(reason.cast("string"), decide), move)

    return F.aggregate(filings, start, step, lambda a: a["out"])


def reconcile(observations: DataFrame, seen: DataFrame | None = None, current: DataFrame | None = None, known: DataFrame | None = None, run_id: str = "run", recorded_at: datetime | None = None) -> Result:
    """Decides on every observation of a batch.

    ``seen``: (fact_key, accn, value) already recorded; ``current``: open versions of facts_history;
    ``known``: corrections of any status.  One small job looks which kinds of evidence the batch can
    have; the rest is lazy.  Observations without fact_key, value, accn or filed are
    ignored, they never pass the first gate.  Observations of equal filing date go by accn."""
    now = F.lit(recorded_at) if recorded_at else F.current_timestamp()
    obs = fit(observations.withColumn("fact_key", fact_key()), "observations").drop("recorded_at", "run_id")
    obs = obs.filter("fact_key is not null and value is not null and accn is not null and filed is not null")
    weeks = F.when(F.col("period_start").isNull(), F.lit(-1)).otherwise(F.bround(F.datediff("period_end", "period_start") / 7, 0).cast("int"))
    obs = obs.withColumn("weeks", weeks)
    fixed = ["ticker", "taxonomy", "concept", "unit", "period_start", "period_end", "weeks"]  # the same for all rows of a fact
    rest = [c for c in obs.columns if c not in ("fact_key", "accn", "filed", "value", *fixed)]
    # one row a fact, filing and value: of equal rows the first by its other columns; two values of a filing clash.
    # Hashes lead the keys, since they sort far quicker than texts.
    obs_ = obs.withColumns({"_fact": F.xxhash64("fact_key"), "_filing": F.xxhash64("fact_key", "accn")}).repartition("fact_key")
    filing = W.partitionBy("_filing", "fact_key", "accn")
    same = F.row_number().over(W.partitionBy("_filing", "fact_key", "accn", "value").orderBy("filed", *rest))
    one = obs_.withColumn("_k", same).filter("_k = 1").withColumn("clash", F.count("*").over(filing) > 1)
    one = one.withColumns({"distinct": distinctive(F.col("value")), "half": last_digit(F.abs("value"))})
    each = F.array_sort(F.collect_list(F.struct("filed", "accn", "value", *rest, "clash", "distinct", "half")))
    facts = one.groupBy("_fact", "fact_key").agg(*[F.first(c).alias(c) for c in fixed], each.alias("filings")).drop("_fact")

    def given(df: DataFrame, name: str, other: DataFrame | None, kind: str) -> DataFrame:
        return df.withColumn(name, F.lit(None).cast(kind)) if other is None else df.join(other, "fact_key", "left")

    before = None if seen is None else _by_filing(seen.groupBy("fact_key", "accn").agg(F.min("value").alias("seen")), "seen")
    # branches for evidence that the batch can't have are left out of the plan
    ends = obs.select(*SERIES, "period_end").distinct()
    pairs = _pairs(ends)
    spans = ends.filter((F.col("weeks") >= 0) & ~F.col("unit").isin(*NOT_SUMMED))
    some = {r[0] for r in pairs.limit(1).select(F.lit("pairs")).union(spans.limit(1).select(F.lit("spans"))).collect()}
    twins = _twins(obs, pairs) if "pairs" in some else None
    shorter = _shorter(obs) if "spans" in some else None
    if current is None:
        open_ = None
        facts = facts.withColumns({"cur_value": F.lit(None).cast("double"), "cur_from": F.lit(None).cast("date"), "cur_accn": F.lit(None).cast("string"), "cur_form": F.lit(None).cast("string")})
    else:
        open_ = current.filter("known_to is null").select("fact_key", F.col("value").alias("cur_value"), F.col("known_from").alias("cur_from"), F.col("source_accn").alias("cur_accn"), F.col("source_form").alias("cur_form"))
        facts = facts.join(open_, "fact_key", "left")
    facts = facts.withColumns({"cur_distinct": distinctive(F.col("cur_value")), "cur_half": last_digit(F.abs("cur_value"))})
    facts = given(given(given(facts, "seen", before, "map<string,double>"), "twins", twins, f"map<string,{_TWINS}>"), "shorter", shorter, "map<string,int>")
    names = ["filed", "accn", "value", *rest, "clash", "distinct", "half"]

    def known_of(o: Column) -> Column:
        was = F.try_element_at("seen", o["accn"])
        more = [was.alias("was"), (was.isNotNull() | o["clash"]).alias("skip"), F.coalesce(F.try_element_at("twins", o["accn"]), F.expr(f"cast(array() as {_TWINS})")).alias("twins"), F.try_element_at("shorter", o["accn"]).alias("shorter")]
        return F.struct(*[o[n].alias(n) for n in names], *more)

    facts = facts.select("fact_key", *fixed, *_OPEN, F.transform("filings", known_of).alias("filings"))
    if twins is None:
        taint = None
    else:
        bad = _taint(facts.filter(F.exists("filings", lambda o: F.size(o["twins"]) > 0)))
        taint = obs.select("fact_key", "ticker", "accn", "weeks", "period_end").join(bad, ["ticker", "accn", "weeks", "period_end"], "left_semi").groupBy("fact_key").agg(F.collect_set("accn").alias("tainted"))
    facts = given(facts, "tainted", taint, "array<string>")
    marked = F.transform("filings", lambda o: o.withField("tainted", F.coalesce(F.array_contains("tainted", o["accn"]), F.lit(False))))
    held = None if known is None else known.groupBy("fact_key").agg(F.collect_set(F.struct("accn", F.col("proposed_value").alias("value"))).alias("known"))
    facts = given(facts.select("fact_key", *fixed, *_OPEN, marked.alias("filings")), "known", held, "array<struct<accn:string,value:double>>")
    walked = facts.select("fact_key", *fixed, "known", "filings", _walk(F.col("filings")).alias("events"))
    each = walked.select("fact_key", *fixed, "known", F.inline(F.arrays_zip("filings", "events"))).select("fact_key", *fixed, "known", "filings.*", "events.*")
    clash, changed = F.col("clash"), F.col("was") != F.col("value")
    nothing = clash | F.col("was").isNotNull()
    decided = each.withColumns({
        "reason": F.when(clash, "conflict_within_filing").when(changed, "same_filing_value_changed").otherwise(F.col("reason")),
        "action": F.when(clash | changed, "held").when(F.col("was").isNotNull(), "already_seen").otherwise(F.col("action")),
        "old_value": F.when(clash, F.lit(None)).when(F.col("was").isNotNull(), F.col("was")).otherwise(F.col("old_value")),
        **{c: F.when(~nothing, F.col(c)) for c in ("old_from", "old_accn", "old_form")},
    })
    again = (F.col("action") == "held") & F.coalesce(F.array_contains("known", F.struct("accn", "value")), F.lit(False))
    decided = decided.withColumn("action", F.when(again, "held_before").otherwise(F.col("action")))
    order = [c for c in obs.columns if c != "weeks"]
    return Result(decided.select(*order, "action", "reason", "old_value", "old_from", "old_accn", "old_form", now.alias("recorded_at"), F.lit(run_id).alias("run_id")))
