"""The named analytical queries over the warehouse."""

from __future__ import annotations

from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame

from listingflow.sources.store import Warehouse

SQL_DIR = Path(__file__).parent / "sql"

# (name, title), in the order in which they run. What each computes is stated at the head of its SQL.
QUERIES = (
    ("area_leaderboard", "Area leaderboard"),
    ("monthly_rent_index", "Monthly rent index"),
    ("agent_repost_rate", "Agent repost rate"),
    ("model_error_by_segment", "Model error by segment"),
)


@dataclass(frozen=True)
class QueryResult:
    name: str
    title: str
    sql: str
    rows: DataFrame


def run_query(warehouse: Warehouse, name: str) -> tuple[str, DataFrame]:
    """The text of a query and its result over the warehouse as it is now.

    The files name tables in braces; Spark binds them to the warehouse's own frames, so no view of the session's
    is replaced.
    """
    text = (SQL_DIR / f"{name}.sql").read_text(encoding="utf-8")
    tables = {table: rows for table, rows in warehouse.tables().items() if f"{{{table}}}" in text}
    return text.format(**{table: table for table in tables}), warehouse.spark.sql(text, **tables)


def run_all(warehouse: Warehouse) -> list[QueryResult]:
    return [QueryResult(name, title, *run_query(warehouse, name)) for name, title in QUERIES]
