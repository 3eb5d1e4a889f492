"""Query registry, and the SQL twins of the shared inputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfcast.sources.panel import HISTORY_END, HORIZON

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

# The panel rule in SQL, under the name every panel query reads.
PANEL_SQL = f"""
daily AS (
  SELECT l_partkey, n_name AS store_id, p_type AS dept_id,
         CAST(l_shipdate AS DATE) AS day, SUM(l_quantity) AS units
  FROM lineitem
  JOIN part ON p_partkey = l_partkey
  JOIN supplier ON s_suppkey = l_suppkey
  JOIN nation ON n_nationkey = s_nationkey
  GROUP BY l_partkey, n_name, p_type, CAST(l_shipdate AS DATE)
),
numbered AS (
  SELECT *, CAST(date_diff('day', DATE '1995-01-01', day) AS INTEGER) AS dn FROM daily
),
panel AS (
  SELECT CAST(year(day) AS INTEGER) AS year, CAST(month(day) AS INTEGER) AS month, dn,
         CAST(isodow(day) AS INTEGER) AS wday,
         CAST(CASE WHEN day(day) <= 10 THEN 1 ELSE 0 END AS INTEGER) AS snap,
         dept_id, CAST(l_partkey AS VARCHAR) AS item_id, store_id,
         CASE WHEN dn <= {HISTORY_END} THEN units END AS sales,
         CAST(CASE WHEN month(day) = 12 THEN 1 ELSE 0 END AS INTEGER) AS flag_ram,
         CASE WHEN (l_partkey + dn) % 11 = 0 THEN NULL
              ELSE CAST(l_partkey % 50 - 5 AS DOUBLE) END AS Sales_Pred,
         CASE WHEN dn <= {HISTORY_END} THEN units END AS label
  FROM numbered
)"""

PANEL_FIELDS = "year, month, dn, wday, snap, dept_id, item_id, store_id, sales, flag_ram, Sales_Pred"

HELD_OUT_SQL = "substr(md5(item_id || '|' || store_id || '|' || dn), 1, 2) >= 'e6'"

RATED_SQL = """
rated AS (
  SELECT d.doc_id, lang, source, n_chars, quality, toxic
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
)"""

PANEL_KEY = ["item_id", "store_id", "dn"]


def over_panel(body: str) -> str:
    """SQL over the CTE ``panel`` (with ``label``). ``body`` may add CTEs after a comma."""
    return f"WITH {PANEL_SQL}{body}"


def over_rated(body: str) -> str:
    """SQL over the CTE ``rated``: documents with their ratings."""
    return f"WITH {RATED_SQL}{body}"


def register(name: str, sql: str | None = None):
    """Register a query and, where SQL can express it, its check."""

    def add(query: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = query
        if sql is not None:
            SQL[name] = sql
        return query

    return add


VALIDATION_CUT = HISTORY_END
EVALUATION_CUT = HISTORY_END + HORIZON
