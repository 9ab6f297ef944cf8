import datetime as dt
import json
import random
import threading
import urllib.error
import urllib.request

import pytest
from pyspark.sql import functions as F

from factline import cli
from factline.config import metric_concepts
from factline.functions import numbers, prose
from factline.operators import asof, quality, review
from factline.operators.versioning import reconcile
from factline.plans import driver, pipeline, reads, server
from factline.sources import bronze, store
from factline.sources.store import CommitConflict, Lake
from factline.streaming import ingest as streaming


def obs(rows):
    """(ticker, concept, unit, start, end, value, accn, filed) rows as a frame builder."""

    def build(spark):
        df = spark.createDataFrame(rows, "ticker string, concept string, unit string, s string, e string, value double, accn string, f string")
        return df.select("ticker", F.col("ticker").alias("entity_name"), F.lit("us-gaap").alias("taxonomy"), "concept", "unit", F.to_date("s").alias("period_start"), F.to_date("e").alias("period_end"), "value", "accn", F.lit("10-K").alias("form"), F.to_date("f").alias("filed"))

    return build


def test_rule_cases(spark):
    got = sorted(map(tuple, driver.queries()["rule_cases"](spark, "").collect()))
    assert got == sorted(driver._EXPECTED)


def fold(filings):
    """The walk of one fact, without evidence of other periods."""
    cur, since, out = None, None, []
    for filed, accn, value in sorted(filings):
        if since is None:
            action = "initial"
        elif value == cur:
            action = "confirmation"
        elif filed == since:
            action = "held"
        else:
            action = "restatement"
        if action in ("initial", "restatement"):
            cur, since = value, filed
        out.append((accn, action))
    return out


def test_random_histories(spark):
    rng, rows, want = random.Random(5), [], {}
    for k in range(300):
        history = [(str(dt.date(2024, 1, 1) + dt.timedelta(rng.randint(0, 60))), f"a{i:02}", rng.choice([100.0, 90.0, 95.0, 25.0])) for i in range(rng.randint(1, 12))]
        rows += [(f"T{k}", "NetIncomeLoss", "USD", "2023-01-01", "2023-12-31", v, a, d) for d, a, v in history]
        want |= {(f"T{k}", a): x for a, x in fold(history)}
    df = obs(rows)(spark)
    r = reconcile(df)
    got = {(x.ticker, x.accn): x.action for x in r.decided.select("ticker", "accn", "action").collect()}
    assert got == want
    assert asof.overlapping_versions(r.versions).count() == 0 and asof.invalid_intervals(r.versions).count() == 0
    assert asof.open_versions(r.versions).filter("open_versions <> 1").count() == 0


def test_state_makes_a_second_run_empty(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    df = obs([("AA", "NetIncomeLoss", "USD", "2022-01-01", "2022-12-31", 100.0, "0000000001-23-000001", "2023-02-01"), ("AA", "NetIncomeLoss", "USD", "2022-01-01", "2022-12-31", 91.5, "0000000001-24-000001", "2024-02-01"), ("BB", "NetIncomeLoss", "USD", "2022-01-01", "2022-12-31", 1.5, "0000000001-23-000003", "2023-02-01"), ("BB", "NetIncomeLoss", "USD", "2022-01-01", "2022-12-31", 7.25, "0000000001-23-000004", "2023-02-01")])(spark)
    today = dt.date(2024, 3, 1)
    from factline.schemas import fact_key, fit

    df = fit(df.withColumn("fact_key", fact_key()), "observations")
    first = pipeline.ingest(lake, df, today=today)
    assert (first["new_facts"], first["restatements"], first["quarantined"]) == (2, 1, 1)
    again = pipeline.ingest(lake, df, today=today)
    assert (again["new_facts"], again["restatements"], again["already_seen"], again["quarantined"]) == (0, 0, 3, 0)
    assert lake.read("pipeline_runs").count() == 2
    held = lake.read("corrections").first()
    with pytest.raises(review.ReviewError):
        review.approve(lake, held["correction_id"], "me", " ")
    review.approve(lake, held["correction_id"], "me", "checked", dt.date(2023, 6, 1), today)
    versions = {(r.value, r.change_type): r.known_to for r in lake.read("facts_history").filter("ticker = 'BB'").collect()}
    assert versions == {(1.5, "initial"): dt.date(2023, 6, 1), (7.25, "manual_correction"): None}
    with pytest.raises(review.ReviewError):
        review.reject(lake, held["correction_id"], "me")
    before = lake.version()
    with pytest.raises(CommitConflict):
        lake._commit(before - 1, lake.manifest())


def test_failed_gate_and_audit_change_nothing(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    from factline.schemas import fact_key, fit

    good = fit(obs([("AA", "NetIncomeLoss", "USD", "2022-01-01", "2022-12-31", 100.0, "0000000001-23-000001", "2023-02-01")])(spark).withColumn("fact_key", fact_key()), "observations")
    with pytest.raises(quality.GateFailed):
        pipeline.ingest(lake, good.withColumn("unit", F.lit("shares")), today=dt.date(2024, 1, 1))

    def broken(*args):
        r = reconcile(*args)
        return type(r)(r.decided, r.records, r.versions.withColumn("change_type", F.lit("bug")), r.closures, r.changes, r.corrections)

    with pytest.raises(quality.GateFailed):
        pipeline.ingest(lake, good, today=dt.date(2024, 1, 1), rule=broken)
    assert lake.read("facts_history").count() == lake.read("observations").count() == 0
    assert [r.status for r in lake.read("pipeline_runs").collect()] == ["failed", "failed"]
    assert lake.read("dq_results").filter("status = 'failed'").count() >= 2


def test_gate_finds_each_fault(spark):
    from factline.schemas import fact_key, fit

    row = ("AA", "NetIncomeLoss", "USD", "2022-01-01", "2022-12-31", 100.0, "0000000001-23-000001", "2023-02-01")
    good = fit(obs([row])(spark).withColumn("fact_key", fact_key()), "observations")
    today = dt.date(2024, 1, 1)
    assert not quality.failures(quality.check_batch(good, today))
    faults = {"ticker": ("aa", "matches_regex"), "taxonomy": ("xx", "in_set"), "accn": ("1", "matches_regex"), "value": (None, "not_null"), "filed": (dt.date(2025, 1, 1), "in_range")}
    for column, (value, check) in faults.items():
        bad = quality.failures(quality.check_batch(good.withColumn(column, F.lit(value).cast(good.schema[column].dataType)), today))
        assert check in {b["check"] for b in bad}, column
    assert "columns_exist" in {b["check"] for b in quality.failures(quality.check_batch(good.drop("value"), today))}
    assert "row_count" in {b["check"] for b in quality.failures(quality.check_batch(good.limit(0), today))}


def test_numbers(spark):
    cases = [(11.89, 2.97, "USD/shares", 4), (1.74, 0.17, "USD/shares", 10), (2494e6, 24940e6, "shares", 10), (100.0, 50.0, "USD", None), (-4.0, 2.0, "shares", None)]
    df = spark.createDataFrame(cases, "a double, b double, unit string, want int")
    assert df.filter(~numbers.detect_split(F.col("a"), F.col("b"), F.col("unit")).eqNullSafe(F.col("want"))).count() == 0
    rounding = [(-10.253, -10.25, True), (-450198000.0, -450200000.0, True), (459e6, 460e6, False), (100.0, 100.0, False), (1.0, -1.0, False)]
    df = spark.createDataFrame(rounding, "a double, b double, want boolean")
    assert df.filter(numbers.is_rounding(F.col("a"), F.col("b")) != F.col("want")).count() == 0
    jumps = [(-0.1502, -0.0015, 100), (-0.072, -0.0007, 100), (5.0, 5000.0, 1000), (10.0, 11.0, None)]
    df = spark.createDataFrame(jumps, "a double, b double, want int")
    assert df.filter(~numbers.scale_jump(F.col("a"), F.col("b")).eqNullSafe(F.col("want"))).count() == 0
    text = [(1.5e9, "USD", "$1.50bn"), (-2.5e6, "USD", "-$2.50m"), (2.97, "USD/shares", "$2.97"), (2494e6, "shares", "2,494.0m shares"), (47.0, "commits", "47 commits"), (3e9, "TWD", "TWD 3.00bn")]
    df = spark.createDataFrame(text, "v double, unit string, want string")
    assert df.filter(prose.format_value(F.col("v"), F.col("unit")) != F.col("want")).count() == 0


def test_payloads(spark, tmp_path):
    fact = {"start": "2022-01-01", "end": "2022-12-31", "val": 5, "accn": "a", "fy": 2022, "fp": "FY", "form": "10-K", "filed": "2023-02-01"}
    facts = {"cik": 7, "entityName": "Acme", "_landed": {"ticker": "ACME"}, "facts": {"us-gaap": {"NetIncomeLoss": {"units": {"USD": [fact], "EUR": [fact]}}, "Other": {"units": {"USD": [fact] * 3}}}}}
    week = 1704585600  # a Sunday
    weeks = {"source": "github", "ticker": "ACME", "repo": "a/b", "fetched_at": "2024-01-20T10:00:00Z", "weeks": [{"week": week, "total": 4, "days": []}, {"week": week + 7 * 86400, "total": 9, "days": []}]}
    paths = [bronze.land(str(tmp_path), "x", f"ticker={k}", p, dt.datetime(2024, 1, 20, tzinfo=dt.UTC)) for k, p in enumerate((facts, weeks))]
    rows = bronze.observations(bronze.read_payloads(spark, paths)).orderBy("taxonomy").collect()
    assert [(r.taxonomy, r.unit, r.value, str(r.period_end)) for r in rows] == [("github", "commits", 4.0, "2024-01-13"), ("us-gaap", "USD", 5.0, "2022-12-31")]
    assert bronze.sample_files(str(tmp_path)) == sorted(paths)
    assert bronze.sample_files(f"file://{tmp_path}", ["9"]) == [] and [f.removeprefix("file:") for f in bronze.sample_files(f"file://{tmp_path}")] == sorted(paths)
    with pytest.raises(ValueError):
        pipeline.extract("sec", str(tmp_path))


def test_client_waits_and_gives_up():
    answers, waits = iter([(429, b""), (200, b"[1]")]), []
    with pytest.raises(bronze.RateLimited, match="GITHUB_TOKEN"):
        bronze.GitHubClient(fetch=lambda u, h: (403, b"", {"X-RateLimit-Remaining": "0"}), sleep=waits.append).weeks("a/b")
    with pytest.raises(OSError, match="later"):
        bronze.GitHubClient(fetch=lambda u, h: (202, b""), sleep=waits.append).weeks("a/b")
    with pytest.raises(ValueError):
        bronze.Client("")
    assert bronze.Client("me", fetch=lambda u, h: next(answers), sleep=waits.append).get_json("u") == [1] and 1.0 in waits
    with pytest.raises(OSError):
        bronze.Client("me", fetch=lambda u, h: (404, b""), sleep=waits.append).get_json("u")
    assert pipeline.run_summary([{"status": "succeeded"}]) is None and not pipeline.alert("x", "http://x", lambda r: 1 / 0)


def network(calls):
    """Answers of both services for one company."""
    fact = {"start": "2022-01-01", "end": "2022-12-31", "val": 5, "accn": "0000000001-23-000001", "fy": 2022, "fp": "FY", "form": "10-K", "filed": "2023-02-01"}
    more = [fact, fact | {"val": 9, "accn": "0000000001-24-000001", "filed": "2024-02-01"}, fact | {"val": 10, "accn": "0000000001-24-000002", "filed": "2024-02-01"}]

    def fetch(url, headers):
        calls.append(url)
        if url.endswith("company_tickers.json"):
            return 200, json.dumps({"0": {"ticker": "nvda", "cik_str": 7}}).encode()
        if "companyfacts" in url:
            return 200, json.dumps({"cik": 7, "entityName": "N Corp", "facts": {"us-gaap": {"NetIncomeLoss": {"units": {"USD": more}}}}}).encode()
        if calls.count(url) < 2:
            return 202, b""
        return 200, json.dumps([{"week": 1704585600, "total": 4, "days": []}]).encode()

    return fetch


def test_command_line_streams_and_http(spark, tmp_path, capsys):
    lake, root, calls = str(tmp_path / "lake"), str(tmp_path / "bronze"), []
    sec = bronze.SecClient("me me@x", fetch=network(calls), sleep=lambda s: None)
    assert cli.main(["--lake", lake, "ingest", "--source", "sec", "--bronze", root, "NVDA", "NOPE"], spark, sec) == 0
    assert json.loads(capsys.readouterr().out.splitlines()[-1])["restatements"] == 1
    hub = bronze.GitHubClient(fetch=network(calls), sleep=lambda s: None)
    at = dt.datetime(2024, 1, 20, tzinfo=dt.UTC)
    first = pipeline.extract("github", root, ["NVDA"], hub, at)
    before = len(calls)
    assert len(first) == 2 and pipeline.extract("github", root, ["NVDA"], hub, at.replace(hour=9)) == first and len(calls) == before
    # the same landed files as a stream: commits come in, filings are there already
    streaming.follow(Lake(spark, lake), root, str(tmp_path / "checkpoint")).awaitTermination()
    runs = Lake(spark, lake).read("pipeline_runs").orderBy("started_at").collect()
    assert [(r.source, r.status, r.new_facts, r.already_seen) for r in runs] == [("sec", "succeeded", 1, 0), ("stream", "succeeded", 2, 2)]

    def out(*args, code=0):
        assert cli.main(["--lake", lake, *args], spark) == code
        return capsys.readouterr().out

    assert '"value": 5.0' in out("asof", "nvda", "net_income", "--as-of", "2023-06-01") and '"value": 9.0' in out("asof", "nvda", "net_income", "--period-type", "annual")
    assert out("history", "nvda", "net_income", "2022-12-31").count("known_from") == 2
    assert "(full year to 31 Dec 2022)" in out("changes", "--ticker", "nvda", "--min-pct", "50") and out("changes", "--min-pct", "90") == ""
    held = json.loads(out("corrections", "list"))
    assert held["reason_code"] == "same_day_conflict" and out("runs").count("run_id") == 2 and "Net income" not in out("study")
    assert out("corrections", "approve", held["correction_id"], code=2) == out("corrections", "reject", "none", "--reviewer", "me", code=2) == ""
    with pytest.raises(SystemExit):
        cli.main(["--lake", lake, "changes", "--classification", "bogus"], spark)

    made = server.make_server(Lake(spark, lake))
    threading.Thread(target=made.serve_forever, daemon=True).start()

    def get(path):
        try:
            with urllib.request.urlopen(f"http://127.0.0.1:{made.server_port}{path}", timeout=60) as r:
                return r.status, json.loads(r.read())
        except urllib.error.HTTPError as e:
            return e.code, json.loads(e.read())

    value = "/api/companies/NVDA/metrics/net_income"
    assert get("/health")[1]["last_run"]["status"] == "succeeded" and len(get("/api/metrics")[1]) == 9
    assert [(c["ticker"], c["name"], c["cik"]) for c in get("/api/companies")[1]] == [("NVDA", "Nvidia", 7)]
    assert [r["value"] for r in get(f"{value}?as_of=2023-06-01")[1]] == [5.0] and get(f"{value}?as_of=2020-01-01") == (200, [])
    assert [(r["value_before"], r["value_after"], r["classification"]) for r in get(f"{value}/compare?before=2023-06-01&after=2024-06-01")[1]] == [(5.0, 9.0, "restatement")]
    assert len(get(f"{value}/history?period_end=2022-12-31")[1]) == 2 and get(f"{value}/quarterly")[0] == 200
    assert len(get("/api/companies/NVDA/developer-activity")[1]) == 2 and len(get("/api/changes?limit=1000")[1]) == 1 and len(get("/api/runs")[1]) == 2
    assert get("/api/corrections")[1][0]["reason"]
    bad = ("/api/companies/NVDA/metrics/none", "/x", f"{value}/compare?before=2024-01-01&after=2023-01-01", "/api/changes?classification=x", "/api/changes?limit=1001", "/api/runs?limit=201", f"{value}?as_of=x")
    assert [get(b)[0] for b in bad] == [404, 404, 422, 422, 422, 422, 422]
    assert cli.main(["--lake", lake, "corrections", "reject", held["correction_id"], "--reviewer", "me"], spark) == 0
    assert get("/api/corrections") == (200, []) and len(get("/api/corrections?status=rejected")[1]) == 1
    made.shutdown()


def test_two_writers(spark, tmp_path):
    lake, other = Lake(spark, str(tmp_path / "lake")), Lake(spark, str(tmp_path / "lake"))
    facts = driver.facts(spark, "/root/testdata/sf0.001").limit(20).persist()
    none = facts.limit(0).select("fact_key", "source_accn", "known_from", "known_to")
    start = lake.version()
    plan = lake.plan_facts(none, facts)
    assert lake.of(plan[1], "facts_history").count() == 20 and lake.read("facts_history").count() == 0  # seen by none before the commit
    runs = other.read("pipeline_runs")
    other.append("pipeline_runs", spark.createDataFrame([("r",) + (None,) * (len(runs.columns) - 1)], runs.schema))
    lake.commit(*plan)  # another table changed: both stay
    assert lake.read("facts_history").count() == 20 and lake.read("pipeline_runs").count() == 1
    late = other.plan_facts(none, facts.withColumn("version_id", F.concat("version_id", F.lit("x"))), base=start)
    with pytest.raises(CommitConflict):
        other.commit(*late)
    with pytest.raises(CommitConflict):
        lake.restore(start, expect=start)
    was = lake.version()
    lake.restore(start, expect=was)
    assert lake.read("facts_history").count() == 0 and lake.read("facts_history", was).count() == 20 and lake.read("pipeline_runs").count() == 1


def test_buckets_grow_with_the_table(spark, tmp_path, monkeypatch):
    lake = Lake(spark, str(tmp_path / "lake"))
    facts = driver.facts(spark, "/root/testdata/sf0.001").limit(40).persist()
    none = facts.limit(0).select("fact_key", "source_accn", "known_from", "known_to")
    lake.merge_facts(none, facts.withColumn("known_to", F.lit(None).cast("date")))
    monkeypatch.setattr(store, "BUCKET_BYTES", 1)
    ends = facts.filter("known_to is not null").select("fact_key", "source_accn", "known_from", "known_to")
    lake.merge_facts(ends, facts)
    assert lake.manifest()["_buckets"]["facts_history"] == 2 * store.BUCKETS
    got, want = ({(r.version_id, r.known_to) for r in df.collect()} for df in (lake.read("facts_history"), facts))
    assert got == want


def test_reads_and_table_functions(spark):
    d = "/root/testdata/sf0.001"
    facts, concepts = driver.facts(spark, d), metric_concepts(spark)
    asof.register(spark, facts, driver.as_observations(facts), concepts)
    by_sql = spark.sql(f"select * from metrics_as_of(date '{driver.LATER}')")
    assert by_sql.count() == asof.metrics_as_of(asof.metric_history(facts, concepts), driver.LATER).count() > 0
    h = asof.metric_history(facts, concepts)
    quarters, own = spark.sql(f"select * from quarterly_as_of(date '{driver.LATER}')"), asof.quarterly_as_of(h, driver.LATER)
    assert sorted(map(str, quarters.collect())) == sorted(map(str, own.select(quarters.columns).collect())) and own.filter("derived").count() > 0
    assert spark.table("dq_open_versions_per_fact").filter("open_versions <> 1").count() == spark.table("dq_overlapping_versions").count() == 0
    log = spark.range(12_000).select(F.col("id").cast("string").alias("change_id"), F.lit("A").alias("ticker"), F.lit(1.0).alias("pct_change"), F.current_date().alias("effective_date"))
    assert reads.changes(log, limit=20_000).count() == 12_000
    assert reads.quarterly(h, "nation_3", "revenue", driver.LATER).filter("derived").count() > 0
