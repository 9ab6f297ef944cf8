"""Reads over HTTP, as JSON: every one takes the day as of which it is asked.

Tables are kept for as long as the lake's state stays the same; a commit, or a lake made anew, drops them."""

from __future__ import annotations

import json
import re
import threading
from collections.abc import Callable
from datetime import date
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs, unquote, urlsplit

from pyspark.sql import DataFrame

from factline.config import METRICS, NAMES, metric_concepts
from factline.operators import asof
from factline.plans import reads
from factline.schemas import CLASSIFICATIONS, REASONS
from factline.sources.store import Lake

PERIOD_TYPES = ("quarter", "annual", "ytd", "instant")
STATUSES = ("pending", "approved", "rejected")
#: Rows a caller may ask for.
MOST_CHANGES, MOST_RUNS = 1000, 200
_WHY = {
    "suspected_wrong_period": "The filing seems to give another period's figure here.", "suspected_scale_error": "Old and new figure differ by a power of a thousand or a hundred, as units do.",
    "late_arrival": "An older filing came in late and says something else.", "same_day_conflict": "Two filings of one day disagree.",
    "conflict_within_filing": "One filing gives two values.", "same_filing_value_changed": "A filing that was recorded before now says something else.",
}
assert set(_WHY) == set(REASONS)


class Refused(Exception):
    def __init__(self, status: int, why: str):
        super().__init__(why)
        self.status = status


class Api:
    """``get(path with query) -> (status, body)``."""

    def __init__(self, lake: Lake):
        self.lake, self.lock, self.kept, self.tables = lake, threading.Lock(), None, {}
        company = r"/api/companies/([^/]+)"
        self.routes: list[tuple[str, Callable]] = [
            (r"/health", self.health), (r"/api/metrics", self.metrics), (r"/api/companies", self.companies), (company + r"/metrics/([^/]+)/quarterly", self.quarterly),
            (company + r"/metrics/([^/]+)/history", self.history), (company + r"/metrics/([^/]+)/compare", self.compare), (company + r"/metrics/([^/]+)", self.values),
            (company + r"/developer-activity", self.activity), (r"/api/changes", self.changes), (r"/api/corrections", self.corrections), (r"/api/runs", self.runs),
        ]

    def get(self, target: str) -> tuple[int, object]:
        url = urlsplit(target)
        query = {k: v[-1] for k, v in parse_qs(url.query).items()}
        try:
            for pattern, answer in self.routes:
                if m := re.fullmatch(pattern, url.path):
                    return 200, answer(*map(unquote, m.groups()), **{"query": query})
            return 404, {"detail": "no such path"}
        except Refused as e:
            return e.status, {"detail": str(e)}

    def table(self, name: str) -> DataFrame:
        with self.lock:
            state = self.lake.state()
            if state != self.kept:
                for df in self.tables.values():
                    df.unpersist()
                self.kept, self.tables = state, {}
            if name not in self.tables:
                self.tables[name] = (asof.metric_history(self.lake.read("facts_history"), metric_concepts(self.lake.spark)) if name == "metric_history" else self.lake.read(name)).persist()
            return self.tables[name]

    @staticmethod
    def rows(df: DataFrame) -> list[dict]:
        return [r.asDict() for r in df.collect()]  # one company's series, or as many rows as asked for

    @staticmethod
    def day(query: dict, name: str, default: date | None = None) -> date:
        try:
            return date.fromisoformat(query[name]) if name in query or default is None else default
        except (KeyError, ValueError):
            raise Refused(422, f"{name} must be a date") from None

    @staticmethod
    def choice(query: dict, name: str, of: tuple, default: str | None = None) -> str | None:
        value = query.get(name, default)
        if value is not None and value not in of:
            raise Refused(422, f"{name} must be one of {', '.join(of)}")
        return value

    @staticmethod
    def number(query: dict, name: str, default: float, most: float | None = None) -> float:
        try:
            value = float(query.get(name, default))
        except ValueError:
            raise Refused(422, f"{name} must be a number") from None
        if most is not None and not 0 <= value <= most:
            raise Refused(422, f"{name} must be between 0 and {most}")
        return value

    def metric(self, name: str) -> DataFrame:
        if name not in METRICS:
            raise Refused(404, f"unknown metric {name}")
        return self.table("metric_history")

    def health(self, query):
        last = self.rows(reads.runs(self.table("pipeline_runs"), 1))
        return {"status": "ok", "last_run": last[0] if last else None}

    def metrics(self, query):
        return [{"metric": m, "label": label, "kind": kind} for m, (label, kind, _, _) in METRICS.items()]

    def companies(self, query):
        found = reads.companies(self.table("facts_history"), self.table("observations")).orderBy("ticker")
        return [r | {"name": NAMES.get(r["ticker"], r["entity_name"])} for r in self.rows(found)]

    def quarterly(self, ticker, metric, query):
        return self.rows(reads.quarterly(self.metric(metric), ticker, metric, self.day(query, "as_of", date.today())))

    def values(self, ticker, metric, query):
        kind = self.choice(query, "period_type", PERIOD_TYPES)
        return self.rows(reads.metric_values(self.metric(metric), ticker, metric, self.day(query, "as_of", date.today()), kind))

    def history(self, ticker, metric, query):
        start = self.day(query, "period_start") if "period_start" in query else None
        return self.rows(reads.fact_history(self.metric(metric), ticker, metric, self.day(query, "period_end"), start))

    def compare(self, ticker, metric, query):
        history, before, after = self.metric(metric), self.day(query, "before"), self.day(query, "after", date.today())
        if after < before:
            raise Refused(422, "after lies before before")
        return self.rows(reads.compare_as_of(history, self.table("change_log"), ticker, metric, before, after))

    def activity(self, ticker, query):
        return self.rows(reads.developer_activity(self.table("facts_history"), ticker, self.day(query, "as_of", date.today())))

    def changes(self, query):
        since = self.day(query, "since") if "since" in query else None
        kind, limit = self.choice(query, "classification", CLASSIFICATIONS), int(self.number(query, "limit", 100, MOST_CHANGES))
        return self.rows(reads.changes(self.table("change_log"), query.get("ticker"), since, kind, self.number(query, "min_abs_pct", 0.0), limit))

    def corrections(self, query):
        found = self.rows(reads.corrections(self.table("corrections"), self.choice(query, "status", STATUSES, "pending")))
        return [r | {"name": NAMES.get(r["ticker"], r["ticker"]), "reason": _WHY.get(r["reason_code"], r["reason_code"])} for r in found]

    def runs(self, query):
        return self.rows(reads.runs(self.table("pipeline_runs"), int(self.number(query, "limit", 20, MOST_RUNS))))


def make_server(lake: Lake, host: str = "127.0.0.1", port: int = 0) -> ThreadingHTTPServer:
    api = Api(lake)

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self) -> None:  # noqa: N802
            status, body = api.get(self.path)
            data = json.dumps(body, default=str).encode()
            self.send_response(status)
            self.send_header("Content-Type", "application/json")
            self.send_header("Content-Length", str(len(data)))
            self.end_headers()
            self.wfile.write(data)

        def log_message(self, *_: object) -> None:
            pass

    return ThreadingHTTPServer((host, port), Handler)


def serve(lake: Lake, host: str, port: int) -> None:
    with make_server(lake, host, port) as server:
        server.serve_forever()
