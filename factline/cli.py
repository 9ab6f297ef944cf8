"""Command line: ingest, asof, history, changes, corrections, runs, study, serve."""

from __future__ import annotations

import argparse
import json
import sys
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from factline.config import NAMES, metric_concepts
from factline.operators import asof, research, review
from factline.operators.quality import GateFailed
from factline.plans import pipeline, reads, server
from factline.schemas import CLASSIFICATIONS
from factline.sources.bronze import Client, GitHubClient, SecClient
from factline.sources.store import Lake


def _print(df: DataFrame) -> None:
    for row in df.toLocalIterator():
        print(json.dumps(row.asDict(), default=str))


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="factline")
    p.add_argument("--lake", default="lake")
    sub = p.add_subparsers(dest="command", required=True)
    i = sub.add_parser("ingest")
    i.add_argument("tickers", nargs="*")
    i.add_argument("--source", choices=("sample", "sec", "github"), default="sample")
    i.add_argument("--bronze", default="bronze")
    i.add_argument("--paths", nargs="*")
    i.add_argument("--sec-user-agent")
    a = sub.add_parser("asof")
    a.add_argument("ticker"), a.add_argument("metric")
    a.add_argument("--as-of", default=str(date.today()))
    a.add_argument("--period-type", choices=server.PERIOD_TYPES)
    a.add_argument("--quarterly", action="store_true")
    h = sub.add_parser("history")
    h.add_argument("ticker"), h.add_argument("metric"), h.add_argument("period_end"), h.add_argument("--period-start")
    c = sub.add_parser("changes")
    c.add_argument("--ticker"), c.add_argument("--since"), c.add_argument("--classification", choices=CLASSIFICATIONS), c.add_argument("--min-pct", "--min-abs-pct", type=float, default=0.0), c.add_argument("--limit", type=int, default=50)
    r = sub.add_parser("corrections")
    r.add_argument("action", choices=("list", "approve", "reject"))
    r.add_argument("id", nargs="?"), r.add_argument("--reviewer", default=""), r.add_argument("--note", default=""), r.add_argument("--effective"), r.add_argument("--status", default="pending", choices=("pending", "approved", "rejected", "all"))
    sub.add_parser("runs").add_argument("--limit", type=int, default=20)
    s = sub.add_parser("study")
    s.add_argument("--as-of", default=str(date.today())), s.add_argument("--out")
    v = sub.add_parser("serve")
    v.add_argument("--host", default="127.0.0.1"), v.add_argument("--port", type=int, default=8000)
    return p


def _ingest(lake: Lake, a: argparse.Namespace, client: Client | None) -> int:
    if a.source == "sec":
        client = client or SecClient(a.sec_user_agent)
    elif a.source == "github":
        client = client or GitHubClient()
    tickers = a.tickers or (list(NAMES) if a.source == "sec" else None)
    paths = a.paths or pipeline.extract(a.source, a.bronze, tickers, client)
    print(json.dumps(pipeline.run(lake, paths, a.source), default=str))
    return 0


def main(argv: list[str] | None = None, spark: SparkSession | None = None, client: Client | None = None) -> int:
    """0 if all went well, 1 if a gate refused, 2 for wrong use or a review that can't be."""
    a = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("factline").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    lake = Lake(spark, a.lake)
    history = lambda: asof.metric_history(lake.read("facts_history"), metric_concepts(spark))
    try:
        if a.command == "ingest":
            return _ingest(lake, a, client)
        elif a.command == "asof":
            _print(reads.quarterly(history(), a.ticker, a.metric, a.as_of) if a.quarterly else reads.metric_values(history(), a.ticker, a.metric, a.as_of, a.period_type))
        elif a.command == "history":
            _print(reads.fact_history(history(), a.ticker, a.metric, a.period_end, a.period_start))
        elif a.command == "changes":
            _print(reads.changes(lake.read("change_log"), a.ticker, a.since, a.classification, a.min_pct, a.limit))
        elif a.command == "corrections" and a.action == "list":
            _print(reads.corrections(lake.read("corrections"), None if a.status == "all" else a.status))
        elif a.command == "corrections":
            if not a.id or not a.reviewer:
                print("approve and reject need an id and --reviewer", file=sys.stderr)
                return 2
            review.reject(lake, a.id, a.reviewer, a.note) if a.action == "reject" else review.approve(lake, a.id, a.reviewer, a.note, date.fromisoformat(a.effective) if a.effective else None)
        elif a.command == "runs":
            _print(reads.runs(lake.read("pipeline_runs"), a.limit))
        elif a.command == "serve":
            server.serve(lake, a.host, a.port)
        else:
            text = research.study(history(), lake.read("facts_history"), lake.read("corrections"), a.as_of)
            if a.out:
                with open(a.out, "w", encoding="utf-8") as f:
                    f.write(text)
            else:
                print(text)
        return 0
    except GateFailed as e:
        print(e, file=sys.stderr)
        return 1
    except ValueError as e:  # wrong use, or a review that can't be
        print(e, file=sys.stderr)
        return 2


if __name__ == "__main__":
    sys.exit(main())
