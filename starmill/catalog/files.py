"""Sources and sinks: each query writes a whole table in some format and reads it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from starmill.catalog.registry import query
from starmill.operators import load
from starmill.sources import (
    read_default,
    read_delimited,
    read_format,
    read_inferred,
    read_json,
    read_json_mapped,
    read_quoted,
    render_path,
    stage_raw,
)

_ORDERS_SQL = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders
"""


@query(_ORDERS_SQL)
def roundtrip_json(t):
    path = t.path("json")
    t.orders.write.json(path)
    return read_json(t.spark, path, t.orders.schema)


@query("""
SELECT o_orderkey AS id, o_custkey AS customer, o_totalprice AS price, o_orderstatus AS status
FROM orders
""")
def roundtrip_json_mapped(t):
    """Fields of nested records under other names, from a templated path."""
    root = t.path("mapped")
    record = t.orders.select(
        "o_orderkey", F.struct("o_custkey", "o_orderstatus").alias("who"), "o_totalprice"
    )
    record.write.json(f"{root}/2024/01")
    mapping = {
        "id": "o_orderkey",
        "customer": "who.o_custkey",
        "price": "o_totalprice",
        "status": "who.o_orderstatus",
    }
    path = render_path("{root}/{year}/{month:02d}", root=root, year=2024, month=1)
    return read_json_mapped(t.spark, path, record.schema, mapping)


@query("SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def roundtrip_csv_semicolon(t):
    path = t.path("semicolon")
    t.part.write.options(header=True, sep=";").csv(path)
    return read_delimited(t.spark, path, t.part.schema, sep=";")


@query("SELECT event_id, user_id, props, value FROM events")
def roundtrip_csv_quote_all(t):
    """Every field quoted, with quotes inside the values."""
    path = t.path("quoted")
    events = t.events.select("event_id", "user_id", "props", "value")
    load.save_quoted_csv(events, path)
    return read_delimited(t.spark, path, events.schema)


@query("""
SELECT o_orderkey, o_totalprice, o_orderstatus, year(o_orderdate)::INTEGER AS order_year FROM orders
""")
def roundtrip_parquet_partitioned(t):
    path = t.path("partitioned")
    orders = t.orders.select(
        "o_orderkey", "o_totalprice", "o_orderstatus", F.year("o_orderdate").alias("order_year")
    )
    load.overwrite(orders, path, ["order_year", "o_orderstatus"])
    return read_format(t.spark, "parquet", path, orders.schema)


@query(_ORDERS_SQL)
def roundtrip_recursive(t):
    """A tree of folders, one per status and priority, read as one table."""
    path = t.path("tree")
    folders = t.orders.withColumns(
        {"s": F.col("o_orderstatus"), "p": F.substring("o_orderpriority", 1, 1)}
    )
    folders.write.partitionBy("s", "p").json(path)
    return read_json(t.spark, path, t.orders.schema, recursive=True, pattern="*.json")


@query("SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def roundtrip_default_format(t):
    """Staged as parquet and opened by the default format."""
    path = t.path("default")
    stage_raw(t.supplier, "default", path)
    opened = read_default(t.spark, path)
    return opened.select(*[c for c in opened.columns])


@query("""
SELECT s_suppkey::INTEGER AS s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier
""")
def roundtrip_csv_inferred(t):
    path = t.path("inferred")
    t.supplier.write.option("header", True).csv(path)
    return read_inferred(t.spark, path)


@query("""
SELECT c_mktsegment, count(*)::INTEGER AS people FROM customer GROUP BY c_mktsegment
""")
def report_csv(t):
    path = t.path("report")
    counts = t.customer.groupBy("c_mktsegment").agg(F.count("*").cast("int").alias("people"))
    load.save_report(counts, path)
    return read_delimited(t.spark, path, counts.schema)


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem")
def layout_sorted(t):
    """A copy ordered by partition key and clustering columns."""
    path = t.path("clustered")
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    load.clustered(lines, ["l_orderkey"], ["l_linenumber", "l_partkey"]).write.parquet(path)
    return read_format(t.spark, "parquet", path, lines.schema)


@query("""
SELECT o_orderkey, o_custkey, count(*) AS line_count, sum(l_quantity) AS quantity
FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey, o_custkey
""")
def layout_bucketed_join(t):
    """Two tables bucketed by their join key, joined and grouped without a shuffle."""
    names = {}
    for name, key in (("orders", "o_orderkey"), ("lineitem", "l_orderkey")):
        path = t.path(name)
        table = "starmill_" + path.rsplit("-", 1)[1]
        load.save_bucketed(getattr(t, name), table, 8, [key], path)
        names[name] = t.spark.table(table)
        t.spark.sql(f"DROP TABLE {table}")  # the files stay
    joined = names["orders"].join(names["lineitem"], F.col("o_orderkey") == F.col("l_orderkey"))
    return joined.groupBy("o_orderkey", "o_custkey").agg(
        F.count("*").alias("line_count"), F.sum("l_quantity").alias("quantity")
    )


@query("""
SELECT p_partkey, replace(p_name, ' ', chr(10)) AS p_name,
       'a "' || p_brand || '",' || chr(10) || chr(10) || p_type AS note
FROM part
""")
def roundtrip_csv_line_breaks(t):
    """Line breaks, quotes and commas inside quoted fields, in files that are read in splits."""
    path = t.path("breaks")
    parts = t.part.select(
        "p_partkey",
        F.replace("p_name", F.lit(" "), F.lit("\n")).alias("p_name"),
        F.concat(F.lit('a "'), "p_brand", F.lit('",\n\n'), "p_type").alias("note"),
    )
    load.save_quoted_csv(parts, path)
    return read_quoted(t.spark, path, parts.schema).drop("file", "block", "line")
