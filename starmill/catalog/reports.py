"""Reports: top states, arrivals per month, point lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from starmill.catalog.registry import query
from starmill.operators.dims import time_dim
from starmill.operators.facts import equi_join
from starmill.operators.load import last_write_wins
from starmill.operators.reports import (
    count_by_dim,
    filtered_counts,
    lookup_rows,
    most_frequent_first,
    preview,
    top_n_by_dim,
)


@query("""
SELECT n_name AS state, count(*) AS count
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
GROUP BY n_name ORDER BY count DESC, state LIMIT 10
""")
def top_states(t):
    """The ten nations with the most orders."""
    cities = equi_join(
        t.customer, t.nation, {"c_nationkey": "n_nationkey"}, {"state": "n_name"}, "inner"
    )
    return top_n_by_dim(t.orders, cities, ("o_custkey", "c_custkey"), "state", 10)


@query("""
SELECT month(o_orderdate)::INTEGER AS month, count(*) AS count FROM orders
GROUP BY 1 ORDER BY count DESC, month
""")
def per_month(t):
    time = time_dim(t.orders, ["o_orderdate"])
    counts = count_by_dim(t.orders, time, ("o_orderdate", "start_time"), "month")
    return most_frequent_first(counts, "month")


@query("""
SELECT month(o_orderdate)::INTEGER AS month, count(*) AS count
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
WHERE n_name = 'NATION_7' GROUP BY 1 ORDER BY count DESC, month
""")
def per_month_for_one_nation(t):
    people = equi_join(
        t.customer, t.nation, {"c_nationkey": "n_nationkey"}, {"origin": "n_name"}, "inner"
    ).filter(F.col("origin") == "NATION_7")
    theirs = equi_join(t.orders, people, {"o_custkey": "c_custkey"}, {}, "left_semi")
    time = time_dim(t.orders, ["o_orderdate"])
    counts = count_by_dim(theirs, time, ("o_orderdate", "start_time"), "month")
    return most_frequent_first(counts, "month")


@query("""
SELECT event_id, value FROM events WHERE user_id = 10 AND event_type = 'view'
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1
""")
def session_point_lookup(t):
    """One row by the full key of a table in which later events replace earlier ones."""
    latest = last_write_wins(t.events, ["user_id", "event_type"], ["ts", "event_id"])
    return lookup_rows(latest, {"user_id": 10, "event_type": "view"}, ["event_id", "value"])


@query("""
SELECT event_id, event_type, value FROM events
WHERE user_id = 10 AND event_type = 'purchase' ORDER BY event_id
""")
def session_ordered(t):
    where = {"user_id": 10, "event_type": "purchase"}
    return lookup_rows(t.events, where, ["event_id", "event_type", "value"], ["event_id"])


@query("""
SELECT DISTINCT c_name AS listener
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey WHERE p_name = 'small ring'
""")
def listeners_of_item(t):
    items = t.part.filter(F.col("p_name") == "small ring")
    lines = equi_join(t.lineitem, items, {"l_partkey": "p_partkey"}, {}, "left_semi")
    orders = equi_join(t.orders, lines, {"o_orderkey": "l_orderkey"}, {}, "left_semi")
    people = equi_join(t.customer, orders, {"c_custkey": "o_custkey"}, {}, "left_semi")
    return people.select(F.col("c_name").alias("listener")).distinct()


@query("""
SELECT count(*) FILTER (year(o_orderdate) = 1998) AS in_1998,
       count(*) FILTER (year(o_orderdate) = 1998 AND o_orderstatus = 'F') AS closed_in_1998,
       count(*) FILTER (o_orderstatus = 'F') AS closed,
       max(year(o_orderdate))::INTEGER AS newest_year
FROM orders
""", name="filtered_counts")
def filtered_counts_of_orders(t):
    in_1998, closed = F.year("o_orderdate") == 1998, F.col("o_orderstatus") == "F"
    return t.orders.agg(
        F.count_if(in_1998).alias("in_1998"),
        F.count_if(in_1998 & closed).alias("closed_in_1998"),
        F.count_if(closed).alias("closed"),
        F.max(F.year("o_orderdate")).alias("newest_year"),
    )


@query("""
SELECT count(*) FILTER (s_acctbal < 0) AS in_debt,
       count(*) FILTER (s_nationkey = 3) AS from_three
FROM supplier
""")
def supplier_counts(t):
    conditions = {"in_debt": F.col("s_acctbal") < 0, "from_three": F.col("s_nationkey") == 3}
    return filtered_counts(t.supplier, conditions)


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5")
def preview_of_orders(t):
    dearest = t.orders.select("o_orderkey", "o_totalprice", (-F.col("o_totalprice")).alias("rank"))
    return preview(dearest, 5, ["rank", "o_orderkey"]).drop("rank")
