"""Dimensions: one row per key, time, most frequent value, surrogate keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from starmill.catalog.registry import query
from starmill.operators.dims import (
    argmax_by_group,
    dimension,
    distinct_union,
    project,
    surrogate_key,
    time_dim,
)
from starmill.operators.keyed import with_group_count
from starmill.session import tasks_for


@query("""
SELECT user_id, event_type AS first_type, value AS first_value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1
""")
def user_dim_first(t):
    columns = {"user_id": "user_id", "first_type": "event_type", "first_value": "value"}
    return dimension(t.events, columns, ["user_id"], order=["ts", "event_id"])


@query("""
SELECT user_id, event_type AS last_type, value AS last_value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
""")
def user_dim_latest(t):
    columns = {"user_id": "user_id", "last_type": "event_type", "last_value": "value"}
    return dimension(t.events, columns, ["user_id"], "latest", order=["ts", "event_id"])


@query("""
SELECT p_partkey AS song_id, p_name AS title, p_brand AS artist_id, p_retailprice AS duration
FROM part
""")
def song_dim(t):
    columns = {
        "song_id": "p_partkey",
        "title": "p_name",
        "artist_id": "p_brand",
        "duration": "p_retailprice",
    }
    return dimension(t.part, columns, ["song_id"], "any")


@query("SELECT DISTINCT p_brand AS name, p_type AS location FROM part")
def artist_dim(t):
    columns = {"name": "p_brand", "location": "p_type"}
    return dimension(t.part, columns, ["name"], "distinct")


_TIME_SQL = """
SELECT DISTINCT ts AS start_time, hour(ts)::INTEGER AS hour, day(ts)::INTEGER AS day,
       week(ts)::INTEGER AS week, month(ts)::INTEGER AS month, year(ts)::INTEGER AS year,
       ({weekday})::INTEGER AS weekday
FROM events
"""


@query(_TIME_SQL.format(weekday="dayofweek(ts) + 1"))
def time_dim_sun1(t):
    return time_dim(t.events, ["ts"], "sun1")


@query(_TIME_SQL.format(weekday="dayofweek(ts)"))
def time_dim_sun0(t):
    return time_dim(t.events, ["ts"], "sun0")


@query(_TIME_SQL.format(weekday="isodow(ts) - 1"))
def time_dim_mon0(t):
    return time_dim(t.events, ["ts"], "mon0")


@query("""
WITH roles AS (
    SELECT o_orderdate AS time FROM orders
    UNION SELECT l_shipdate FROM lineitem
    UNION SELECT o_orderdate + INTERVAL 180 DAY FROM orders)
SELECT time, hour(time)::INTEGER AS hour, day(time)::INTEGER AS day,
       week(time)::INTEGER AS week, month(time)::INTEGER AS month,
       year(time)::INTEGER AS year, (dayofweek(time) + 1)::INTEGER AS weekday
FROM roles WHERE time >= TIMESTAMP '1997-01-01'
""")
def time_dim_three_roles(t):
    """Times of three roles, two of them from one table, since a lower bound."""
    since = F.lit("1997-01-01").cast("timestamp")
    expiry = F.expr("o_orderdate + INTERVAL 180 DAYS")
    orders = time_dim(t.orders, ["o_orderdate", expiry], since=since, name="time")
    return distinct_union(orders, time_dim(t.lineitem, ["l_shipdate"], since=since, name="time"))


_SEGMENTS_SQL = """
SELECT * FROM (SELECT c_nationkey, c_mktsegment, count(*) AS people
               FROM customer GROUP BY c_nationkey, c_mktsegment)
"""


def _segments(t):
    return t.customer.groupBy("c_nationkey", "c_mktsegment").agg(F.count("*").alias("people"))


@query(_SEGMENTS_SQL + "QUALIFY rank() OVER (PARTITION BY c_nationkey ORDER BY people DESC) = 1")
def argmax_with_ties(t):
    return argmax_by_group(_segments(t), ["c_nationkey"], "people")


@query(_SEGMENTS_SQL + """QUALIFY row_number() OVER (
    PARTITION BY c_nationkey ORDER BY people DESC, c_mktsegment) = 1""")
def argmax_unique(t):
    return argmax_by_group(_segments(t), ["c_nationkey"], "people", ties="one")


@query("""
SELECT user_id AS id FROM events UNION SELECT c_custkey FROM customer
UNION SELECT s_suppkey FROM supplier
""", name="distinct_union")
def distinct_union_ids(t):
    return distinct_union(
        project(t.events, {"id": "user_id"}),
        project(t.customer, {"id": "c_custkey"}),
        project(t.supplier, {"id": "s_suppkey"}),
    )


@query("SELECT event_id, event_type, count(*) OVER (PARTITION BY event_type) AS frequency FROM events")
def count_over_partition(t):
    return with_group_count(t.events.select("event_id", "event_type"), "event_type")


@query("""
SELECT *, row_number() OVER (ORDER BY o_orderdate, o_custkey) - 1 AS day_key
FROM (SELECT DISTINCT o_orderdate, o_custkey FROM orders)
""")
def surrogate_keys(t):
    days = t.orders.select("o_orderdate", "o_custkey").distinct()
    return surrogate_key(days, ["o_orderdate", "o_custkey"], "day_key", "dense")


@query("""
WITH keys AS (SELECT DISTINCT l_orderkey, l_partkey, l_linenumber FROM lineitem)
SELECT unnest(['hash', 'fast']) AS method, count(*) AS row_count, count(*) AS ids FROM keys
""")
def surrogate_keys_unique(t):
    """Hash and fast keys differ wherever the natural keys do."""
    key = ["l_orderkey", "l_partkey", "l_linenumber"]
    rows = t.lineitem.select(*key)
    # Every key and id is a group of its own, so the tasks that hold them are set by their number.
    tasks = tasks_for(rows.count())
    hashed = surrogate_key(rows.repartition(tasks, *key).distinct(), key, "hash")
    keyed = surrogate_key(hashed, key, "fast", "fast")
    ids = keyed.unpivot([], ["hash", "fast"], "method", "id")
    per_id = ids.repartition(2 * tasks, "method", "id").groupBy("method", "id").count()
    return per_id.groupBy("method").agg(
        F.sum("count").alias("row_count"), F.count("*").alias("ids")
    )
