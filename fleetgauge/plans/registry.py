"""Registry of runnable queries and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; `sql` is the same result in ANSI SQL over the driver's tables."""

    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


# --- SQL building blocks of the oracles ------------------------------------------------------

FLEET = """fleet AS (
  SELECT 'FD00' || CAST(1 + user_id % 4 AS VARCHAR) AS variant,
         CAST(user_id AS BIGINT) AS unit_id,
         CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INTEGER) AS cycle,
         CAST(0 AS DOUBLE) AS op_setting_1,
         value AS sensor_1,
         CAST(regexp_extract(props, '[0-9]+') AS DOUBLE) AS sensor_2,
         hour(ts) + minute(ts) / CAST(60 AS DOUBLE) AS sensor_3,
         event_type, ts
  FROM events)"""

GAPS = FLEET + """, gaps AS (
  SELECT * REPLACE (CASE WHEN event_type <> 'error' THEN sensor_1 END AS sensor_1) FROM fleet)"""

FROZEN = FLEET + """, frozen AS (
  SELECT * REPLACE (CASE WHEN unit_id % 10 = 0 AND cycle >= 20 THEN 7 ELSE sensor_2 END
                    AS sensor_2) FROM fleet)"""

LABELLED = FLEET + """, labelled AS (
  SELECT *, CAST(rul <= 30 AS INTEGER) AS label_within_x FROM (
    SELECT *, CAST(max(cycle) OVER (PARTITION BY variant, unit_id) - cycle AS INTEGER) AS rul
    FROM fleet))"""

SCORED = LABELLED + """, scored AS (
  SELECT *, sensor_2 / CAST(100 AS DOUBLE) AS risk,
         CAST(90 AS DOUBLE) - cycle + (sensor_2 - 50) / CAST(4 AS DOUBLE) AS predicted_rul
  FROM labelled)"""

WIDE = """wide AS (
  SELECT r_name AS variant, CAST(l_suppkey AS BIGINT) AS unit_id,
         CAST(row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey,
              l_linenumber, l_partkey, l_quantity, l_extendedprice, l_discount, l_tax,
              l_returnflag, l_linestatus) AS INTEGER) AS cycle,
         l_quantity AS sensor_1, l_extendedprice AS sensor_2, l_discount AS sensor_3,
         l_tax AS sensor_4
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
       JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

P = 2147483647


def hash_sql(seed: int, *keys: str) -> str:
    """`key_hash` in SQL."""
    state = f"CAST({seed % P} AS BIGINT)"
    for key in keys:
        state = f"(({state} * 69621 + ((CAST({key} AS BIGINT) % {P} + {P}) % {P}) * 48271 + 11) % {P})"
    state = f"(({state} * {state} + 1013904223) % {P})"
    state = f"(({state} * 630360016 + 7) % {P})"
    return f"(({state} * {state} + {state} + 1) % {P})"


def uniform_sql(seed: int, *keys: str) -> str:
    return f"({hash_sql(seed, *keys)} / CAST({P} AS DOUBLE))"


def text_key_sql(text: str) -> str:
    return f"CAST('0x' || substr(md5({text}), 1, 7) AS BIGINT)"


def r6(expr: str) -> str:
    """Rounded for comparison; adding zero removes a negative zero."""
    return f"round({expr}, 6) + 0.0"


def as_int(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"
