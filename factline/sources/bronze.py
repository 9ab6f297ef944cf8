"""Payload files as landed, and their parsing into observations."""

from __future__ import annotations

import gzip
import json
import logging
import os
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterable
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from factline.config import METRICS, NAMES, REPOSITORIES, metric_rows
from factline.schemas import fact_key, fit

log = logging.getLogger(__name__)
_ROW = "struct<start:string,end:string,val:double,accn:string,fy:int,fp:string,form:string,filed:string,frame:string>"
FACTS = f"cik long, entityName string, _landed struct<ticker:string>, facts map<string,map<string,struct<units:map<string,array<{_ROW}>>>>>"
ACTIVITY = "source string, ticker string, repo string, fetched_at string, weeks array<struct<week:long,total:int>>"


class Client:
    """JSON over HTTP with a least spacing between calls, and waiting longer each time on 429 and 5xx.

    ``fetch(url, headers) -> (status, body[, headers])`` stands for the network."""

    retries = 4

    def __init__(self, user_agent: str, spacing: float = 0.15, fetch: Callable | None = None, sleep: Callable[[float], None] = time.sleep, headers: dict | None = None):
        if not user_agent:
            raise ValueError("a User-Agent is required")
        self.headers, self.spacing, self.fetch, self.sleep, self.last = {"User-Agent": user_agent} | (headers or {}), spacing, fetch or _http, sleep, 0.0

    def get_json(self, url: str, retries: int | None = None):
        retries = self.retries if retries is None else retries
        for attempt in range(retries + 1):
            self.sleep(max(0.0, self.last + self.spacing - time.monotonic()))
            self.last = time.monotonic()
            status, body, *more = self.fetch(url, self.headers)
            if status == 200:
                return json.loads(body)
            if status == 204:
                return []
            left = {k.lower(): v for k, v in (more[0] if more else {}).items()}.get("x-ratelimit-remaining")
            if status in (403, 429) and left == "0":
                raise RateLimited(f"{url}: no requests left; a token (GITHUB_TOKEN) allows more")
            if attempt == retries or not (status in (202, 429) or status >= 500):
                raise OSError(f"{url}: " + ("not computed yet, ask again later" if status == 202 else f"HTTP {status}"))
            self.sleep(min(2.0**attempt, 30.0))


class RateLimited(OSError):
    pass


class SecClient(Client):
    """Company facts; the service asks for a User-Agent with an address to write to."""

    # The service's addresses.
    TICKERS = "https://www.sec.gov/files/company_tickers.json"
    FACTS = "https://data.sec.gov/api/xbrl/companyfacts/CIK{:010d}.json"

    def __init__(self, user_agent: str | None = None, **options):
        super().__init__(user_agent or os.environ.get("SEC_USER_AGENT", ""), **options)

    def ciks(self) -> dict[str, int]:
        return {r["ticker"].upper(): int(r["cik_str"]) for r in self.get_json(self.TICKERS).values()}

    def facts(self, cik: int) -> dict:
        return self.get_json(self.FACTS.format(cik))


class GitHubClient(Client):
    """Weekly commits; statistics that are still being computed are asked for again."""

    API = "https://api.github.com"
    retries = 6

    def __init__(self, token: str | None = None, **options):
        token = token or os.environ.get("GITHUB_TOKEN")
        headers = {"Accept": "application/vnd.github+json"} | ({"Authorization": f"Bearer {token}"} if token else {})
        super().__init__("factline", headers=headers, **{"spacing": 0.0} | options)

    def weeks(self, repo: str) -> list[dict]:
        return self.get_json(f"{self.API}/repos/{repo}/stats/commit_activity")


def _http(url: str, headers: dict) -> tuple[int, bytes, dict]:
    try:
        with urllib.request.urlopen(urllib.request.Request(url, headers=headers), timeout=60) as r:  # noqa: S310
            return r.status, r.read(), dict(r.headers)
    except urllib.error.HTTPError as e:
        return e.code, b"", dict(e.headers or {})


class Files:
    """Landed files under a root: a local folder, or one in any store that Spark reaches (with ``://`` in its name)."""

    def __init__(self, root: str):
        self.root, self.far = root.rstrip("/"), "://" in root
        if self.far:
            spark = SparkSession.active()
            self.path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
            self.fs = self.path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def list(self) -> list[str]:
        if not self.far:
            return sorted(str(f) for f in Path(self.root).rglob("*.json.gz"))
        found, at = [], self.fs.listFiles(self.path(self.root), True) if self.fs.exists(self.path(self.root)) else None
        while at is not None and at.hasNext():
            found.append(at.next().getPath().toString())
        return sorted(f for f in found if f.endswith(".json.gz"))

    def write(self, name: str, data: bytes) -> str:
        """A file that is there stays."""
        where = f"{self.root}/{name}"
        if self.far:
            if not self.fs.exists(self.path(where)):
                out = self.fs.create(self.path(where), False)
                out.write(bytearray(data))
                out.close()
        elif not Path(where).exists():
            Path(where).parent.mkdir(parents=True, exist_ok=True)
            Path(where).write_bytes(data)
        return where


def land(root: str, source: str, name: str, payload: dict, at: datetime | None = None) -> str:
    """Writes a payload once, compressed, by source, name and time; a file that is there stays."""
    at = at or datetime.now(UTC)
    data = gzip.compress(json.dumps(payload, separators=(",", ":")).encode(), mtime=0)
    return Files(root).write(f"{source}/{name}/fetched_at={at:%Y%m%dT%H%M%SZ}.json.gz", data)


def extract_filings(tickers: Iterable[str], root: str, client: SecClient | None = None, at: datetime | None = None) -> list[str]:
    """Lands the company facts of each known ticker; unknown ones are logged and skipped."""
    client = client or SecClient()
    ciks, out = client.ciks(), []
    for t in (t.upper() for t in tickers):
        if t in ciks:
            out.append(land(root, "companyfacts", f"ticker={t}", client.facts(ciks[t]) | {"_landed": {"ticker": t}}, at))
        else:
            log.error("unknown ticker %s", t)
    return out


def extract_activity(tickers: Iterable[str] | None, root: str, client: GitHubClient | None = None, at: datetime | None = None, repositories: dict = REPOSITORIES) -> list[str]:
    """Lands one snapshot a repository and UTC day; a second run on the day uses the first one's file."""
    client, at, out = client or GitHubClient(), at or datetime.now(UTC), []
    wanted = {t.upper() for t in tickers} if tickers else set(repositories)
    there = Files(f"{root}/activity").list()
    for ticker in sorted(wanted & set(repositories)):
        for repo in repositories[ticker]:
            name = f"repo={repo.replace('/', '__')}"
            today = [f for f in there if f"/{name}/fetched_at={at:%Y%m%d}T" in f]
            payload = None if today else {"source": "github", "ticker": ticker, "repo": repo, "fetched_at": at.isoformat(), "weeks": client.weeks(repo)}
            out.append(today[0] if today else land(root, "activity", name, payload, at))
    return out


def sample_files(root: str, tickers: Iterable[str] | None = None) -> list[str]:
    files, want = Files(root).list(), {t.upper() for t in tickers or ()}
    return [f for f in files if not want or f.rsplit("/", 1)[-1].split(".")[0].split("__")[0] in want or any(f"/ticker={t}/" in f for t in want)]


def read_payloads(spark: SparkSession, paths: list[str]) -> DataFrame:
    """One row a file, plain or compressed."""
    if not paths:
        return spark.createDataFrame([], "value string")
    return spark.read.text(paths, wholetext=True)


def company_facts(payloads: DataFrame, metrics: dict = METRICS) -> DataFrame:
    """Observations of curated concepts in the company's reporting currency.

    The currency is the three-letter unit with most rows, over all concepts; ties go to the first by name."""
    spark = payloads.sparkSession
    p = payloads.select(F.from_json("value", FACTS).alias("p")).select("p.*").filter("facts is not null")
    p = p.withColumn("ticker", F.coalesce("_landed.ticker", F.lit("")))
    units = p.select("ticker", "cik", "entityName", F.explode("facts").alias("taxonomy", "concepts")).filter("taxonomy in ('us-gaap', 'ifrs-full')")
    units = units.select("*", F.explode("concepts").alias("concept", "c")).select("ticker", "cik", "entityName", "taxonomy", "concept", F.explode("c.units").alias("unit", "rows"))
    currency = reporting_currency(units.select("ticker", "unit", F.size("rows").alias("n")))
    curated = spark.createDataFrame([(r[4], r[5]) for r in metric_rows(metrics)], "taxonomy string, concept string").distinct()
    mine = units.join(curated, ["taxonomy", "concept"], "left_semi").join(currency, "ticker", "left")
    mine = mine.filter((F.col("unit") == "shares") | F.col("currency").isNull() | (F.split_part("unit", F.lit("/"), F.lit(1)) == F.col("currency")))
    rows = mine.select("ticker", "cik", F.coalesce("entityName", "ticker").alias("entity_name"), "taxonomy", "concept", "unit", F.explode("rows").alias("r"))
    out = rows.select("*", F.to_date("r.start").alias("period_start"), F.to_date("r.end").alias("period_end"), F.col("r.val").alias("value"), F.col("r.accn").alias("accn"), F.coalesce("r.form", F.lit("")).alias("form"), F.col("r.fy").alias("fiscal_year"), F.col("r.fp").alias("fiscal_period"), F.to_date("r.filed").alias("filed"), F.col("r.frame").alias("frame"))
    return fit(out.withColumn("fact_key", fact_key()), "observations")


def reporting_currency(units: DataFrame) -> DataFrame:
    """ticker, currency from (ticker, unit, n)."""
    n = units.filter(F.col("unit").rlike(r"\A[A-Z]{3}\z")).groupBy("ticker", "unit").agg(F.sum("n").alias("n"))
    best = F.row_number().over(W.partitionBy("ticker").orderBy(F.desc("n"), "unit"))
    return n.withColumn("k", best).filter("k = 1").select("ticker", F.col("unit").alias("currency"))


def _named(ticker):
    return F.coalesce(*[F.when(ticker == t, F.lit(name)) for t, name in NAMES.items()], ticker)


def commit_activity(payloads: DataFrame) -> DataFrame:
    """Observations of complete weeks; a value is known from the day it was collected."""
    p = payloads.select(F.from_json("value", ACTIVITY).alias("p")).select("p.*").filter("source = 'github'")
    w = p.select("ticker", "repo", F.to_date(F.substring("fetched_at", 1, 10)).alias("filed"), F.explode("weeks").alias("w"))
    start = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(F.col("w.week") / 86400).cast("int"))
    w = w.withColumn("period_start", start).withColumn("period_end", F.date_add("period_start", 6)).filter("period_end < filed")
    out = w.select("ticker", _named(F.col("ticker")).alias("entity_name"), F.lit("github").alias("taxonomy"), F.col("repo").alias("concept"), F.lit("commits").alias("unit"), "period_start", "period_end", F.col("w.total").cast("double").alias("value"), F.concat(F.lit("gh-"), F.col("filed").cast("string")).alias("accn"), F.lit("GitHub").alias("form"), "filed")
    return fit(out.withColumn("fact_key", fact_key()), "observations")


def observations(payloads: DataFrame) -> DataFrame:
    """Both kinds of payload; the file's ``source`` field tells them apart."""
    kind = F.get_json_object("value", "$.source")
    return company_facts(payloads.filter(F.coalesce(kind, F.lit("")) != "github")).unionByName(commit_activity(payloads.filter(kind == "github")))
