"""Quality checks and column profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from starmill.catalog.registry import query
from starmill.operators.profile import (
    column_profile,
    column_stats,
    greatest_deviation,
    group_sum,
)
from starmill.operators.quality import CheckSpec, null_report, repeated_keys, run_checks


def _gaps(t):
    return t.orders.select(
        "o_orderkey",
        F.nullif("o_orderstatus", F.lit("P")).alias("status"),
        F.when(F.col("o_totalprice") > 100000, F.col("o_totalprice")).alias("price"),
    )


_GAPS_SQL = """WITH gaps AS (
    SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status,
           CASE WHEN o_totalprice > 100000 THEN o_totalprice END AS price FROM orders)
"""


@query(_GAPS_SQL + """
SELECT 'o_orderkey' AS column_name, count(*) AS row_count, count(*) - count(o_orderkey) AS null_count FROM gaps
UNION ALL SELECT 'status', count(*), count(*) - count(status) FROM gaps
UNION ALL SELECT 'price', count(*), count(*) - count(price) FROM gaps
""", name="null_report")
def null_report_of_orders(t):
    return null_report(_gaps(t))


@query(_GAPS_SQL + """, empty AS (SELECT * FROM events WHERE event_type = 'none')
SELECT 'gaps' AS table_name, 'not_empty' AS check_name, '' AS column_name,
       0::BIGINT AS violations, true AS passed
UNION ALL SELECT 'gaps', 'not_null', 'status', count(*), count(*) = 0 FROM gaps WHERE status IS NULL
UNION ALL SELECT 'gaps', 'not_null', 'o_orderkey', 0, true
UNION ALL SELECT 'gaps', 'max_length', 'status', 0, true
UNION ALL SELECT 'gaps', 'unique', 'o_orderkey', 0, true
UNION ALL SELECT 'lineitem', 'not_empty', '', 0, true
UNION ALL SELECT 'lineitem', 'unique', 'l_orderkey,l_linenumber', count(*), count(*) = 0
    FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
UNION ALL SELECT 'part', 'not_empty', '', 0, true
UNION ALL SELECT 'part', 'max_length', 'p_name', count(*), count(*) = 0 FROM part WHERE length(p_name) > 10
UNION ALL SELECT 'empty', 'not_empty', '', 1, false
""")
def check_suite(t):
    return run_checks(
        {
            "gaps": (_gaps(t), CheckSpec(["status", "o_orderkey"], ["o_orderkey"], {"status": 1})),
            "lineitem": (t.lineitem, CheckSpec(key=["l_orderkey", "l_linenumber"])),
            "part": (t.part, CheckSpec(max_length={"p_name": 10})),
            "empty": (t.events.filter("event_type = 'none'"), CheckSpec()),
        }
    )


@query("""
SELECT 'orders' AS table_name, count(*) = 0 AS is_empty FROM orders
UNION ALL SELECT 'lineitem', count(*) = 0 FROM lineitem
UNION ALL SELECT 'no events', count(*) = 0 FROM events WHERE event_type = 'none'
""")
def empty_check(t):
    """Emptiness of tables, from the report of a check suite without other checks."""
    none = t.events.filter("event_type = 'none'")
    tables = {"orders": t.orders, "lineitem": t.lineitem, "no events": none}
    report = run_checks({name: (df, CheckSpec()) for name, df in tables.items()})
    return report.select("table_name", (~F.col("passed")).alias("is_empty"))


@query("""
SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem
GROUP BY ALL HAVING count(*) > 1
""")
def key_uniqueness(t):
    return repeated_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


_PROFILED = ["o_orderstatus", "o_orderpriority", "o_custkey", "price"]


@query("""
WITH orders2 AS (SELECT *, CASE WHEN o_totalprice > 400000 THEN o_totalprice::BIGINT // 1000
                           END AS price FROM orders),
long AS (
    SELECT 'o_orderstatus' AS column_name, o_orderstatus AS value FROM orders2
    UNION ALL SELECT 'o_orderpriority', o_orderpriority FROM orders2
    UNION ALL SELECT 'o_custkey', o_custkey::VARCHAR FROM orders2
    UNION ALL SELECT 'price', price::VARCHAR FROM orders2),
counts AS (SELECT column_name, value, count(*) AS frequency FROM long GROUP BY ALL),
totals AS (SELECT column_name, sum(frequency)::BIGINT AS row_count,
                  count(*) AS distinct_values,
                  coalesce(sum(frequency) FILTER (value IS NULL), 0)::BIGINT AS null_count
           FROM counts GROUP BY column_name)
SELECT column_name, row_count, distinct_values, null_count,
       null_count * 100.0::DOUBLE / row_count AS null_percent,
       row_number() OVER (PARTITION BY column_name
                          ORDER BY frequency DESC, value NULLS LAST)::INTEGER AS position,
       value, frequency
FROM counts JOIN totals USING (column_name) QUALIFY position <= 5
""", name="column_profile")
def column_profile_of_orders(t):
    price = F.floor(F.round("o_totalprice").cast("long") / 1000)
    orders = t.orders.withColumn("price", F.when(F.col("o_totalprice") > 400000, price))
    return column_profile(orders, _PROFILED, 5)


@query("""
SELECT 'l_orderkey' AS column_name, count(*) AS row_count,
       count(DISTINCT l_orderkey) AS distinct_values, 0::BIGINT AS null_count FROM lineitem
UNION ALL SELECT 'l_shipdate', count(*), count(DISTINCT l_shipdate), 0 FROM lineitem
UNION ALL SELECT 'l_returnflag', count(*), count(DISTINCT l_returnflag), 0 FROM lineitem
UNION ALL SELECT 'returned', count(*), 2, count(*) FILTER (l_returnflag <> 'R') FROM lineitem
""")
def column_stats_of_lineitem(t):
    returned = F.when(F.col("l_returnflag") == "R", True)
    lines = t.lineitem.withColumn("returned", returned)
    return column_stats(lines, ["l_orderkey", "l_shipdate", "l_returnflag", "returned"])


@query("""
SELECT nullif(event_type, 'error') AS kind, user_id,
       round(sum(value), 4) AS value, sum(event_id)::BIGINT AS ids
FROM events GROUP BY ALL
""")
def group_sum_null_keys(t):
    events = t.events.select(
        F.nullif("event_type", F.lit("error")).alias("kind"),
        "user_id",
        "value",
        F.col("event_id").alias("ids"),
    )
    sums = group_sum(events, ["kind", "user_id"], ["value", "ids"])
    return sums.withColumn("value", F.round("value", 4))


@query("""
SELECT round(max(price), 6) AS p_retailprice, max(nation) AS same
FROM (SELECT stddev_samp(p_retailprice) AS price, stddev_samp(p_size - p_size) AS nation
      FROM part GROUP BY p_brand, p_type)
""")
def fd_check(t):
    """Within brand and type the price varies, a constant does not."""
    parts = t.part.withColumn("same", F.col("p_size") - F.col("p_size"))
    worst = greatest_deviation(parts, ["p_brand", "p_type"], ["p_retailprice", "same"])
    return worst.withColumn("p_retailprice", F.round("p_retailprice", 6))
