"""The metric map and other small dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# What a unit must look like for each kind of metric.
UNIT_PATTERNS = {"flow": "[A-Z]{3}", "instant": "[A-Z]{3}", "per_share": "[A-Z]{3}/shares", "shares": "shares"}
# Metric -> label, kind, US GAAP concepts, IFRS concepts, each in order of priority.
METRICS = {
    "revenue": ("Revenue", "flow", ("RevenueFromContractWithCustomerExcludingAssessedTax", "Revenues", "SalesRevenueNet"), ("Revenue", "RevenueFromContractsWithCustomers")),
    "operating_income": ("Operating income", "flow", ("OperatingIncomeLoss",), ("ProfitLossFromOperatingActivities",)),
    "net_income": ("Net income", "flow", ("NetIncomeLoss",), ("ProfitLossAttributableToOwnersOfParent", "ProfitLoss")),
    "rnd_expense": ("R&D expense", "flow", ("ResearchAndDevelopmentExpense",), ("ResearchAndDevelopmentExpense",)),
    "eps_diluted": ("Diluted EPS", "per_share", ("EarningsPerShareDiluted",), ("DilutedEarningsLossPerShare",)),
    "diluted_shares": ("Diluted weighted-average shares", "shares", ("WeightedAverageNumberOfDilutedSharesOutstanding",), ("AdjustedWeightedAverageShares",)),
    "cash": ("Cash and cash equivalents", "instant", ("CashAndCashEquivalentsAtCarryingValue",), ("CashAndCashEquivalents",)),
    "total_assets": ("Total assets", "instant", ("Assets",), ("Assets",)),
    "stockholders_equity": ("Stockholders' equity", "instant", ("StockholdersEquity",), ("EquityAttributableToOwnersOfParent", "Equity")),
}
# Default universe, display names, repositories.
NAMES = {"AMZN": "Amazon", "IREN": "IREN", "NVDA": "Nvidia", "MU": "Micron", "TSM": "TSMC", "META": "Meta", "MSFT": "Microsoft", "HNGE": "Hinge Health", "SIMO": "Silicon Motion"}
REPOSITORIES = {"NVDA": ("NVIDIA/cccl", "NVIDIA/cutlass"), "META": ("pytorch/pytorch",), "MSFT": ("microsoft/vscode", "microsoft/TypeScript"), "AMZN": ("aws/aws-cdk",)}
# How forms are called in prose.
FORMS = {
    "10-K": "annual report (10-K)", "10-K/A": "amended annual report (10-K/A)", "10-Q": "quarterly report (10-Q)", "10-Q/A": "amended quarterly report (10-Q/A)",
    "8-K": "current report (8-K)", "8-K/A": "amended current report (8-K/A)", "DEF 14A": "proxy statement (DEF 14A)", "20-F": "annual report (20-F)",
}
CONCEPT_SCHEMA = "metric string, label string, kind string, unit_pattern string, taxonomy string, concept string, priority int"


def metric_rows(metrics: dict = METRICS) -> list[tuple]:
    rows = []
    for name, (label, kind, gaap, ifrs) in metrics.items():
        tagged = [("us-gaap", c) for c in gaap] + [("ifrs-full", c) for c in ifrs]
        rows += [(name, label, kind, UNIT_PATTERNS[kind], taxonomy, concept, k) for k, (taxonomy, concept) in enumerate(tagged)]
    return rows


def metric_concepts(spark: SparkSession, metrics: dict = METRICS) -> DataFrame:
    """One row for each concept of each metric; as many rows as the configuration has entries."""
    return spark.createDataFrame(metric_rows(metrics), CONCEPT_SCHEMA)
