"""The versioning plan against a fold written for this test, one observation after another, over random batches."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from factline.operators import asof
from factline.operators.versioning import reconcile

DAY = dt.date
PERIODS = [(DAY(y, 10, 1), DAY(y, 12, 31)) for y in (2010, 2011, 2012)] + [(DAY(y, 1, 1), DAY(y, 12, 31)) for y in (2010, 2011, 2012)] + [(None, DAY(y, 12, 31)) for y in (2010, 2011, 2012)]
KINDS = [("us-gaap", "Revenues", "USD"), ("us-gaap", "NetIncomeLoss", "USD"), ("us-gaap", "Assets", "USD"), ("us-gaap", "EarningsPerShareDiluted", "USD/shares"), ("us-gaap", "Diluted", "shares"), ("github", "a/b", "commits")]
VALUES = {"USD": [13185e6, 9857e6, 17431e6, 21268e6, 100e6, 131.85e6, 0.0, -9857e6], "USD/shares": [11.89, 2.97, 0.1189, -0.1502, -0.0015, 1.74, 0.17], "shares": [459e6, 460e6, 24.94e9, 2.494e9], "commits": [40.0, 47.0, 4000.0, 0.0]}


def batch(rng):
    """Rows (taxonomy, concept, unit, start, end, value, accn, filed) of one company."""
    kinds, periods = rng.sample(KINDS, rng.randint(1, 3)), rng.sample(PERIODS, rng.randint(1, 5))
    filings = [(f"f{i}", DAY(2013, 1, 1) + dt.timedelta(rng.choice([0, 30, 30, 60, 90]) * i)) for i in range(rng.randint(1, 6))]
    favourite = {(k, p): rng.choice(VALUES[k[2]]) for k in kinds for p in periods}
    rows = []
    for accn, filed in filings:
        swap = rng.random() < 0.3
        for k in kinds:
            for p in periods:
                if rng.random() < 0.65:
                    value = favourite[k, p] if rng.random() < 0.6 else rng.choice(VALUES[k[2]])
                    if swap and rng.random() < 0.8:
                        value = favourite[k, rng.choice(periods)]
                    rows.append((*k, *p, value, accn, filed))
                    if rng.random() < 0.05:
                        rows.append((*k, *p, rng.choice([value, value, rng.choice(VALUES[k[2]])]), accn, filed))
    rng.shuffle(rows)
    return rows


def tells_apart(v):
    digits = str(round(abs(v) * 100)).rstrip("0")
    return len(digits) >= 4


def off_by_a_scale(a, b):
    if a * b <= 0:
        return False
    big, small = max(abs(a), abs(b)), min(abs(a), abs(b))
    places = next((k for k in range(7) if abs(round(small, k) - small) <= 1e-12), 6)
    return any(abs(big / f - small) <= max(0.02 * small, 0.5 / 10**places) for f in (100, 1000, 1e6))


class Company:
    """What is known of one company, and how a batch changes it."""

    def __init__(self):
        self.recorded, self.open, self.held = {}, {}, set()

    def take(self, rows):
        span = lambda r: -1 if r[3] is None else round((r[4] - r[3]).days / 7)
        fact = lambda r: r[:5]
        by_filing, out = defaultdict(set), []
        for r in rows:
            by_filing[fact(r), r[6], r[7]].add(r[5])
        todo = defaultdict(list)
        for (f, accn, filed), values in by_filing.items():
            if len(values) > 1:
                out += [(f, accn, v, "held", "conflict_within_filing") for v in values]
            elif (f, accn) in self.recorded:
                same = self.recorded[f, accn] in values
                out.append((f, accn, *values, *(("already_seen", None) if same else ("held", "same_filing_value_changed"))))
            else:
                todo[f].append((filed, accn, *values))

        def twin(f, filed, accn, value, cur):
            for end in sorted({r[4] for r in rows}):
                if not 358 <= abs((end - f[4]).days) <= 372:
                    continue
                there = [r for r in rows if r[:3] == f[:3] and r[4] == end and span(r) == span(f)]
                took = any(r[5] == value and r[7] < filed for r in there)
                now = {r[5] for r in there if r[6] == accn}
                if cur is None and took and now and value not in now and tells_apart(value) or cur is not None and cur in now and (took or tells_apart(cur)):
                    return end
            return None

        bad = set()
        for f, filings in todo.items():
            cur = self.open.get(f, (None, None))[0]
            for filed, accn, value in sorted(filings):
                if cur == value:
                    continue
                end = twin(f, filed, accn, value, cur)
                if end:
                    bad |= {(accn, span(f), f[4]), (accn, span(f), end)}
                else:
                    cur = value
        for f, filings in todo.items():
            for filed, accn, value in sorted(filings):
                cur, since = self.open.get(f, (None, None))
                shorter = f[3] and f[2] not in ("shares", "commits") and value and any(r[3] and r[:3] == f[:3] and r[4] == f[4] and span(r) < span(f) and r[5] == value and r[7] <= filed for r in rows)
                wrong = twin(f, filed, accn, value, cur) or (accn, span(f), f[4]) in bad
                if cur is None:
                    verdict = ("held", "suspected_wrong_period") if wrong else ("initial", None)
                elif cur == value:
                    verdict = ("confirmation", None)
                elif filed < since:
                    verdict = ("held", "late_arrival")
                elif wrong or shorter:
                    verdict = ("held", "suspected_wrong_period")
                elif f[2] != "commits" and off_by_a_scale(cur, value):
                    verdict = ("held", "suspected_scale_error")
                elif filed == since:
                    verdict = ("held", "same_day_conflict")
                else:
                    verdict = ("restatement", None)
                out.append((f, accn, value, *verdict))
                if verdict[0] in ("initial", "restatement"):
                    self.open[f] = value, filed
                if verdict[0] != "held":
                    self.recorded[f, accn] = value
        out = [(f, a, v, "held_before" if act == "held" and (f, a, v) in self.held else act, why) for f, a, v, act, why in out]
        self.held |= {(f, a, v) for f, a, v, act, _ in out if act == "held"}
        return out


def frame(spark, batches):
    rows = [(f"T{k}", *map(str, r[:3]), r[3], r[4], r[5], r[6], "10-K", r[7]) for k, rows in enumerate(batches) for r in rows]
    df = spark.createDataFrame(rows, "ticker string, taxonomy string, concept string, unit string, period_start date, period_end date, value double, accn string, form string, filed date")
    return df.withColumn("entity_name", F.col("ticker"))


def told(decided):
    rows = decided.select("ticker", "taxonomy", "concept", "unit", "period_start", "period_end", "accn", "value", "action", "reason").collect()
    return sorted(((r[0], r[1:6], r[6], r[7], r[8], r[9]) for r in rows), key=str)


@pytest.fixture(scope="module")
def batches():
    rng = random.Random(17)
    return [batch(rng) for _ in range(600)]


def test_random_batches(spark, batches):
    want = sorted(((f"T{k}", *x) for k, rows in enumerate(batches) for x in Company().take(rows)), key=str)
    result = reconcile(frame(spark, batches))
    result.decided.persist()
    got = told(result.decided)
    assert got == want
    reasons = {x[5] for x in want}
    assert reasons >= {"suspected_wrong_period", "suspected_scale_error", "same_day_conflict", "conflict_within_filing"}
    versions = result.versions.persist()
    assert asof.overlapping_versions(versions).count() == asof.invalid_intervals(versions).count() == result.closures.count() == 0
    assert asof.open_versions(versions).filter("open_versions <> 1").count() == 0
    # the order and the number of partitions of the input change nothing
    turned = [rows[::-1] for rows in batches]
    assert told(reconcile(frame(spark, turned).repartition(7)).decided) == got


def test_random_batches_in_parts(spark, batches):
    """Three batches, each with the state that the ones before left; the second has some filings of the first again, changed."""
    rng, cuts = random.Random(3), [[], [], []]
    for rows in batches[:200]:
        parts = [[], [], []]
        for r in rows:
            k = rng.randrange(3)
            parts[k].append(r)
            if k < 2 and rng.random() < 0.15:
                parts[k + 1].append(r if rng.random() < 0.5 else (*r[:5], r[5] + 1.0, *r[6:]))
        for own, p in zip(cuts, parts, strict=True):
            own.append(p)
    companies = [Company() for _ in batches[:200]]
    seen = current = known = None
    for part in cuts:
        want = sorted(((f"T{k}", *x) for k, (c, rows) in enumerate(zip(companies, part, strict=True)) for x in c.take(rows)), key=str)
        r = reconcile(frame(spark, part), seen, current, known)
        r.decided.persist()
        assert told(r.decided) == want
        records, closures = r.records.select("fact_key", "accn", "value"), r.closures.withColumn("over", F.lit(True))
        versions = r.versions if current is None else r.versions.unionByName(current.join(closures.select("fact_key", "over"), "fact_key", "left").filter("over is null").drop("over"))
        # stored, as a lake would
        seen = spark.createDataFrame((records if seen is None else records.unionByName(seen)).collect(), records.schema)
        known = spark.createDataFrame((r.corrections if known is None else r.corrections.unionByName(known)).collect(), r.corrections.schema)
        current = spark.createDataFrame(versions.filter("known_to is null").collect(), versions.schema)
        assert current.groupBy("fact_key").count().filter("count > 1").count() == 0
