"""The TPC-H-like Parquet tables read as the six source tables.

A test and bench binding: it maps every row of the given tables to the declared
schemas, with padding, replays, orphans and NULLs for the models to handle.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

from stellate.sources.schemas import SCHEMAS

# A range that cuts some dates of the bound data off.
CLIPPED_CALENDAR = (dt.date(1996, 1, 1), dt.date(2000, 12, 31))

# Source table -> its rows; given tables stand in braces.
BINDINGS = {
    "clubs": """
        SELECT s_suppkey AS club_id,
               '  ' || s_name || ' ' AS name,
               if(s_suppkey % 4 = 0, n_name || ' ', n_name) AS city,
               lower(n_name) AS country,
               timestamp '1995-01-01 00:00:00' AS created_at
        FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey""",
    "players": """
        SELECT c_custkey AS player_id,
               if(c_custkey % 33 = 0, '  ' || c_name || '  ', c_name) AS full_name,
               if(c_custkey % 7 = 0, ' Player' || c_custkey || '@Example.com ',
                  'player' || c_custkey || '@example.com') AS email,
               if(c_custkey % 20 = 0, lower(n_name), n_name) AS country,
               CASE WHEN c_custkey % 25 = 0 THEN NULL
                    WHEN c_custkey % 10 = 3 THEN 'x'
                    WHEN c_custkey % 2 = 0 THEN 'm'
                    ELSE 'F' END AS gender,
               if(c_custkey % 97 = 5, NULL,
                  date_add(date '1950-01-01', int(c_custkey * 7919 % 23000))) AS date_of_birth,
               timestamp(date_add(date '1995-01-01', int(c_custkey * 31 % 2000))) AS created_at
        FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey""",
    "tournaments": """
        SELECT p_partkey AS tournament_id,
               if(p_partkey % 50 = 49, -1L, p_partkey div 20) AS club_id,
               ' ' || p_name AS name,
               p_type AS category,
               if(p_size <= 25, 'Indoor', 'Outdoor') AS surface,
               bigint(4000 + 2000 * (p_partkey % 5)) AS entry_fee_cents,
               'AUD' AS currency,
               CASE p_partkey % 3 WHEN 0 THEN 8L WHEN 1 THEN 16L ELSE 32L END AS max_teams,
               date_add(date '1995-01-01', int(p_partkey * 13 % 2500)) AS start_date,
               date_add(date '1995-01-01', int(p_partkey * 13 % 2500 + 1 + p_size % 3)) AS end_date,
               CASE WHEN p_partkey % 13 = 0 THEN 'cancelled'
                    WHEN p_partkey % 29 = 7 THEN NULL
                    WHEN p_partkey % 5 = 0 THEN 'scheduled'
                    ELSE 'completed' END AS status,
               timestamp '1995-01-01 00:00:00' AS created_at
        FROM {part}""",
    "registrations": """
        SELECT l_orderkey * 8 + l_linenumber AS registration_id,
               if(l_partkey % 41 = 11, l_partkey + 1000000, l_partkey) AS tournament_id,
               o_custkey AS player_id,
               if(l_orderkey % 9 = 0, NULL,
                  (o_custkey + 1 + l_linenumber) % (SELECT count(*) FROM {customer})) AS partner_player_id,
               bigint(if(l_linenumber <= 4, l_linenumber, NULL)) AS seed,
               bigint(CASE WHEN l_returnflag NOT IN ('A', 'R') OR l_orderkey % 211 = 0 THEN 0
                           ELSE 4000 + 2000 * (l_partkey % 5) END) AS amount_paid_cents,
               CASE WHEN l_orderkey % 307 = 0 THEN 'unknown'
                    WHEN l_returnflag = 'A' THEN 'paid'
                    WHEN l_returnflag = 'R' THEN 'refunded'
                    WHEN l_linestatus = 'F' THEN 'pending'
                    ELSE 'waived' END AS payment_status,
               timestamp(l_shipdate) AS registered_at
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
    "payments": """
        SELECT o_orderkey AS payment_id,
               o_orderkey * 8 + 1 AS registration_id,
               o_orderpriority AS provider,
               bigint(round(o_totalprice * 100)) AS amount_cents,
               'AUD' AS currency,
               CASE o_orderstatus WHEN 'F' THEN 'succeeded' WHEN 'P' THEN 'refunded'
                                  ELSE 'failed' END AS status,
               timestamp(o_orderdate) AS created_at
        FROM {orders}""",
    "matches": """
        SELECT event_id AS match_id,
               event_id % (SELECT count(*) FROM {part}) AS tournament_id,
               'R' || event_id % 5 AS round,
               'Court ' || (1 + event_id % 6) AS court,
               if(event_id % 101 = 3, NULL, timestamp(ts)) AS scheduled_at,
               user_id AS team1_player1,
               if(event_id % 4 = 0, NULL, user_id + 1) AS team1_player2,
               event_id * 3 div 20 AS team2_player1,
               if(event_id % 6 = 0, NULL,
                  event_id * 7 % (SELECT count(*) FROM {customer})) AS team2_player2,
               if(event_id % 19 = 0, NULL, 1 + (event_id + user_id) % 2) AS winner_team,
               '6-3 6-4' AS score,
               CASE event_type WHEN 'error' THEN 'walkover' WHEN 'view' THEN 'scheduled'
                               ELSE 'played' END AS status
        FROM {events}""",
}


class Bound(Mapping[str, DataFrame]):
    """The six source tables over one data folder; each plan is built once, when asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark = spark
        self._folder = folder
        self._given: dict[str, DataFrame] = {}
        self._bound: dict[str, DataFrame] = {}

    def __getitem__(self, table: str) -> DataFrame:
        if table not in self._bound:
            text = BINDINGS[table]
            given = {name: self._read(name) for name in re.findall(r"{(\w+)}", text)}
            self._bound[table] = self._spark.sql(text, **given).to(SCHEMAS[table])
        return self._bound[table]

    def __iter__(self) -> Iterator[str]:
        return iter(BINDINGS)

    def __len__(self) -> int:
        return len(BINDINGS)

    def _read(self, table: str) -> DataFrame:
        if table not in self._given:
            self._given[table] = self._spark.read.parquet(f"{self._folder}/{table}.parquet")
        return self._given[table]
