"""Refresh modes and table contracts."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from starmill.catalog.registry import Tables, query
from starmill.operators import load
from starmill.operators.dims import project
from starmill.schemas import TableSpec

ORDERS = TableSpec(
    "orders_copy", "o_orderkey BIGINT, o_custkey BIGINT, o_totalprice DOUBLE", ("o_orderkey",)
)


def _with_table(t: Tables, spec: TableSpec, fill):
    """Create ``spec`` under a name of its own, fill it, and read its files back."""
    path = t.path(spec.name)
    database = f"starmill_{uuid.uuid4().hex}"
    t.spark.sql(f"CREATE DATABASE {database} LOCATION '{path}-db'")
    try:
        load.create_tables(t.spark, [spec], path, database)
        fill(f"{database}.{spec.name}")
        load.drop_tables(t.spark, [spec], database)
    finally:
        t.spark.sql(f"DROP DATABASE {database} CASCADE")
    return t.spark.read.schema(spec.schema).parquet(f"{path}/{spec.name}")


@query("""
SELECT user_id, arg_min(value, (ts, event_id)) AS first_value,
       arg_max(event_type, (ts, event_id)) AS level
FROM events GROUP BY user_id
""")
def user_dim_partial_upsert(t):
    """Users merged in two batches: the first value stays, the level follows the last event."""
    users = t.events.select(
        "user_id",
        F.col("value").alias("first_value"),
        F.col("event_type").alias("level"),
        "ts",
        "event_id",
    )
    early = F.col("ts") < F.lit("2024-01-10").cast("timestamp")
    none = users.select("user_id", "first_value", "level").limit(0)
    columns = (["user_id"], ["ts", "event_id"], ["level"])
    known = load.upsert(none, users.filter(early), *columns)
    return load.upsert(known, users.filter(~early), *columns)


@query("""
WITH known AS (SELECT * FROM orders WHERE o_orderdate < DATE '1998-01-01'
               QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1)
SELECT o_custkey, o_orderkey, o_orderstatus FROM known
UNION ALL
SELECT o_custkey, o_orderkey, o_orderstatus FROM orders
WHERE o_orderdate >= DATE '1998-01-01' AND o_custkey NOT IN (SELECT o_custkey FROM known)
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1
""")
def insert_ignore(t):
    """First orders of customers, loaded in two batches of which the earlier one wins."""
    orders = t.orders.select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderdate")
    early = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp")
    columns = ["o_custkey", "o_orderkey", "o_orderstatus"]
    order = (["o_custkey"], ["o_orderdate", "o_orderkey"])
    none = orders.select(*columns).limit(0)
    known = load.insert_ignore(none, orders.filter(early), *order)
    return load.insert_ignore(known, orders.filter(~early), *order)


@query("""
SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice
FROM lineitem QUALIFY row_number() OVER (
    PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC) = 1
""")
def last_write_wins(t):
    key = ["l_orderkey", "l_linenumber"]
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    return load.last_write_wins(t.lineitem.select(*key, *order), key, order)


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def dim_full_refresh(t):
    """Loaded twice, held once."""
    orders = load.conform(t.orders, ORDERS)

    def fill(table):
        load.load_table(orders, table, "overwrite")
        load.load_table(orders, table, "overwrite")

    return _with_table(t, ORDERS, fill)


@query("""
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
UNION ALL SELECT o_orderkey, o_custkey, o_totalprice FROM orders
""")
def fact_append(t):
    """Loaded twice, held twice."""
    orders = load.conform(t.orders, ORDERS)

    def fill(table):
        load.load_table(orders, table)
        load.load_table(orders, table)

    return _with_table(t, ORDERS, fill)


@query("SELECT o_orderkey, NULL::BIGINT AS o_custkey, o_totalprice FROM orders")
def insert_column_list(t):
    """An insert that names its columns, in another order and without one of them."""
    rows = project(t.orders, {"o_totalprice": "o_totalprice", "o_orderkey": "o_orderkey"})
    return _with_table(t, ORDERS, lambda table: load.insert_columns(rows, table, rows.columns))


@query("""
SELECT c_custkey::INTEGER AS c_custkey, c_acctbal::DECIMAL(10,0) AS c_acctbal,
       NULL::INTEGER AS c_mktsegment
FROM customer
""")
def conform_contract(t):
    """Order, types and scale of a contract; text that is no number becomes null."""
    spec = TableSpec("customers", "c_custkey INT, c_acctbal DECIMAL, c_mktsegment INT")
    return load.conform(t.customer, spec)


@query("""
SELECT user_id, event_type, ts AS last_time, event_id AS last_id FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1
""")
def keyed_reload(t):
    """Two batches written over one another at a path; rows of the same key are replaced."""
    spec = TableSpec(
        "latest",
        "user_id BIGINT, event_type STRING, last_time TIMESTAMP, last_id BIGINT",
        ("user_id", "event_type"),
    )
    path = t.path("keyed")
    rows = t.events.select(
        *spec.key, F.col("ts").alias("last_time"), F.col("event_id").alias("last_id")
    )
    early = F.col("last_time") < F.lit("2024-01-10").cast("timestamp")
    for batch in (rows.filter(early), rows.filter(~early)):
        load.last_write_into(path, batch, spec.key, ["last_time", "last_id"], spec)
    return load.read_version(t.spark, path, spec.schema)


@query("""
SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem
WHERE l_shipdate IN (SELECT l_shipdate FROM lineitem WHERE l_linenumber = 6)
""")
def incremental_partitions(t):
    """The rows in partitions that a batch touches, here thousands of ship dates."""
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate")
    batch = lines.filter("l_linenumber = 6")
    return load.in_touched_partitions(lines, batch, ["l_shipdate"], lines.columns)


@query("""
SELECT 'customers' AS table_name, UNNEST([
    {'column_name': 'c_custkey',
     'rejected': count(*) FILTER (WHERE c_custkey % 7 = 0)},
    {'column_name': 'c_name', 'rejected': count(*) FILTER (WHERE c_custkey % 5 = 0)},
    {'column_name': 'c_nationkey', 'rejected': 0::BIGINT},
    {'column_name': 'c_nationkey',
     'rejected': count(*) - count(DISTINCT c_nationkey)}], recursive := true)
FROM customer
""")
def load_rejects(t):
    """What a contract refuses: keys that are no numbers, names that are missing, and a column
    taken for a key that repeats."""
    spec = TableSpec(
        "customers", "c_custkey BIGINT, c_name STRING, c_nationkey BIGINT", ("c_nationkey",),
        ("c_name",),
    )
    key = F.col("c_custkey")
    text = F.when(key % 7 == 0, F.concat(key, F.lit("x"))).otherwise(key.cast("string"))
    name = F.when(key % 5 != 0, F.col("c_name"))
    bad = t.customer.select(text.alias("c_custkey"), name.alias("c_name"), "c_nationkey")
    return load.rejects(bad, spec)
