"""Registration of queries and the SQL text of the shared panels."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def rnd(column: Column | str, digits: int = 6) -> Column:
    return F.round(column, digits) + F.lit(0.0)


def rounded(df: DataFrame, digits: int = 6, **special: int) -> DataFrame:
    """Round every double column (a few with their own digits) for comparison by value."""
    out = []
    for field in df.schema.fields:
        name = field.name
        if field.dataType.typeName() == "double":
            out.append(rnd(F.col(f"`{name}`"), special.get(name, digits)).alias(name))
        elif field.dataType.typeName() in ("integer", "short"):
            out.append(F.col(f"`{name}`").cast("long").alias(name))
        else:
            out.append(F.col(f"`{name}`"))
    return df.select(*out)


def r(expr: str, name: str | None = None, digits: int = 6) -> str:
    alias = f" AS {name}" if name else ""
    return f"round({expr}, {digits}) + 0.0{alias}"


def rcols(names: list[str], digits: int = 6) -> str:
    return ", ".join(r(n, n, digits) for n in names)


_PRICE = """100 + SUM(l_extendedprice*(1-l_discount))/SUM(l_quantity)/9973 AS adj_close,
  100 + AVG(l_extendedprice/l_quantity)/9973 AS close,
  SUM(l_quantity) AS volume, SUM(l_extendedprice) AS dollar_volume"""

P1 = f"""p1 AS (SELECT CAST(l_shipdate AS DATE) AS date, p_type AS ticker, {_PRICE}
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)"""
P2 = f"""p2 AS (SELECT CAST(l_shipdate AS DATE) AS date,
  'S' || lpad(CAST(l_suppkey AS VARCHAR), 6, '0') AS ticker, {_PRICE}
  FROM lineitem GROUP BY 1, 2)"""
MACRO = """macro AS (SELECT o_orderpriority AS series_id, CAST(o_orderdate AS DATE) AS date,
  avg(o_totalprice)/9973 AS value FROM orders GROUP BY 1, 2)"""


def cal(panel: str) -> str:
    return f"""cal AS (SELECT date, row_number() OVER (ORDER BY date)-1 AS day_idx,
  count(*) OVER () AS n_days, lead(date) OVER (ORDER BY date) AS next_date
  FROM (SELECT DISTINCT date FROM {panel}))"""


def rets(panel: str) -> str:
    return f"""rets AS (SELECT *, adj_close/lag(adj_close) OVER w - 1 AS simple_ret,
  ln(adj_close/lag(adj_close) OVER w) AS log_ret
  FROM {panel} WINDOW w AS (PARTITION BY ticker ORDER BY date))"""


def grid(panel: str) -> str:
    """Dense grid with the row-to-row return, and prices filled forward then backward."""
    return f"""{cal(panel)}, {rets(panel)},
grid0 AS (SELECT c.date, c.day_idx, t.ticker, x.adj_close, x.simple_ret AS ret, x.dollar_volume
  FROM cal c CROSS JOIN (SELECT DISTINCT ticker FROM {panel}) t
  LEFT JOIN rets x ON x.date = c.date AND x.ticker = t.ticker),
grid AS (SELECT *, coalesce(
  last_value(adj_close IGNORE NULLS) OVER (PARTITION BY ticker ORDER BY day_idx
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(adj_close IGNORE NULLS) OVER (PARTITION BY ticker ORDER BY day_idx
    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS filled FROM grid0)"""


def frame(k: int, order: str = "date", part: str = "ticker") -> str:
    return f"(PARTITION BY {part} ORDER BY {order} ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW)"


def full(k: int, x: str, expr: str, order: str = "date") -> str:
    """`expr` may contain {w}, replaced by the frame."""
    return f"CASE WHEN count({x}) OVER {frame(k, order)} = {k} THEN {expr.format(w=frame(k, order))} END"
