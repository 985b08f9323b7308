"""Filters, projections, null handling and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from starmill import functions as S
from starmill.catalog.registry import query
from starmill.operators.nulls import drop_nulls, rows_with_nulls


@query("""
SELECT DISTINCT user_id, event_type AS kind, 'web' AS channel
FROM events WHERE event_type = 'purchase' AND props <> ''
""")
def filter_project_users(t):
    plays = t.events.filter((F.col("event_type") == "purchase") & (F.col("props") != ""))
    renamed = plays.select("USER_ID", "event_type").withColumnRenamed("event_type", "kind")
    return renamed.withColumn("channel", F.lit("web")).distinct().toDF("user_id", "kind", "channel")


def _with_nulls(t):
    """Orders in which some priorities, statuses and prices are missing."""
    return t.orders.select(
        "o_orderkey",
        F.nullif("o_orderstatus", F.lit("P")).alias("status"),
        F.when(F.col("o_totalprice") > 100000, F.col("o_totalprice")).alias("price"),
        F.when(~F.startswith("o_orderpriority", F.lit("5")), F.col("o_orderpriority")).alias("priority"),
    )


_NULLS_SQL = """WITH missing AS (
    SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status,
           CASE WHEN o_totalprice > 100000 THEN o_totalprice END AS price,
           CASE WHEN o_orderpriority NOT LIKE '5%' THEN o_orderpriority END AS priority
    FROM orders)
"""


@query(_NULLS_SQL + "SELECT o_orderkey, status, coalesce(price, 0) AS price, priority FROM missing")
def null_fill(t):
    return _with_nulls(t).na.fill(0, ["price"])


@query(_NULLS_SQL + "SELECT * FROM missing WHERE status IS NOT NULL")
def null_drop_subset(t):
    return drop_nulls(_with_nulls(t), ["status"])


@query(_NULLS_SQL + """SELECT * FROM missing
WHERE status IS NOT NULL AND price IS NOT NULL AND priority IS NOT NULL""")
def null_drop_any(t):
    return drop_nulls(_with_nulls(t))


@query(_NULLS_SQL + """SELECT o_orderkey, status, coalesce(price, 0) AS price, priority FROM missing
WHERE status IS NOT NULL AND priority IS NOT NULL""")
def null_fill_drop(t):
    return drop_nulls(_with_nulls(t).na.fill(0, ["price"]))


@query(_NULLS_SQL + "SELECT * FROM missing WHERE status IS NULL OR price IS NULL OR priority IS NULL")
def null_rows_any(t):
    return rows_with_nulls(_with_nulls(t))


@query("""
SELECT event_id, make_timestamp(epoch_us(ts) // 1000 * 1000) AS play_time,
       ts::DATE AS play_date
FROM events
""")
def epoch_ms_roundtrip(t):
    millis = F.floor(F.unix_micros("ts") / 1000)
    log = t.events.select("event_id", millis.alias("ms"))
    return log.select(
        "event_id",
        S.epoch_millis("ms").alias("play_time"),
        S.epoch_to_date("ms").alias("play_date"),
    )


@query("""
SELECT event_id, make_timestamp(epoch_us(ts) // 1000000 * 1000000) AS play_time,
       make_timestamp((500 - 777 * event_id) // 1000 * 1000000) AS early_time
FROM events
""")
def epoch_seconds(t):
    """Whole seconds, cut towards zero before 1970 too."""
    log = t.events.select(
        "event_id",
        F.floor(F.unix_micros("ts") / 1000).alias("ms"),
        (500 - 777 * F.col("event_id")).alias("early"),
    )
    return log.select(
        "event_id",
        S.epoch_seconds("ms").alias("play_time"),
        S.epoch_seconds("early").alias("early_time"),
    )


@query("""
SELECT o_orderkey, o_orderdate::DATE AS order_date, o_orderdate AS order_time,
       CASE WHEN o_orderstatus = 'F' THEN o_orderdate::DATE END AS closed_date
FROM orders
""")
def sas_date_decode(t):
    day = F.datediff("o_orderdate", F.lit("1960-01-01")).cast("double")
    days = t.orders.select(
        "o_orderkey", day.alias("day"), F.when(F.col("o_orderstatus") == "F", day).alias("closed")
    )
    return days.select(
        "o_orderkey",
        S.sas_day_to_date("day").alias("order_date"),
        S.sas_day_to_timestamp("day").alias("order_time"),
        S.sas_day_to_date("closed").alias("closed_date"),
    )


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate::DATE END AS until_date,
       CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS until_time,
       o_orderdate::DATE AS iso_date
FROM orders
""")
def text_date_decode(t):
    """Dates written as MMddyyyy, or "D/S" for an open end."""
    texts = t.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", "D/S")
        .otherwise(F.date_format("o_orderdate", "MMddyyyy"))
        .alias("until"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("iso"),
    )
    return texts.select(
        "o_orderkey",
        S.parse_date("until", "MMddyyyy").alias("until_date"),
        S.parse_timestamp("until", "MMddyyyy").alias("until_time"),
        S.parse_date("iso", "yyyy-MM-dd").alias("iso_date"),
    )


@query("SELECT event_id, md5(user_id || date_trunc('second', ts)::VARCHAR) AS play_id FROM events")
def md5_play_key(t):
    second = F.date_trunc("second", "ts")
    return t.events.select("event_id", S.md5_key("user_id", second).alias("play_id"))


@query("""
SELECT event_id, value::DECIMAL(18,0) AS whole, (value / 3)::DECIMAL(10,0) AS third FROM events
""")
def decimal_round(t):
    return t.events.select(
        "event_id",
        S.rounded_decimal("value", 18, 0).alias("whole"),
        S.rounded_decimal(F.col("value") / 3, 10, 0).alias("third"),
    )


@query("""
SELECT s_suppkey, s_acctbal::VARCHAR AS lon_text, s_acctbal AS lon,
       s_nationkey::DOUBLE AS lat, NULL::DOUBLE AS height
FROM supplier
""")
def split_coordinates(t):
    text = F.concat_ws(", ", F.col("s_acctbal").cast("string"), F.col("s_nationkey").cast("string"))
    pairs = t.supplier.select("s_suppkey", text.alias("coordinates"))
    return pairs.select(
        "s_suppkey",
        S.pair_part("coordinates", 0).alias("lon_text"),
        S.pair_part("coordinates", 0, as_type="double").alias("lon"),
        S.pair_part("coordinates", 1, as_type="double").alias("lat"),
        S.pair_part("coordinates", 2, as_type="double").alias("height"),
    )


_TRANSPORT_SQL = """WITH transport AS (
    SELECT p_partkey, CASE WHEN p_size > 25 THEN p_name ELSE '' END AS number,
           CASE WHEN p_type <> 'ECONOMY' THEN p_type END AS company,
           CASE WHEN p_size % 2 = 0 THEN p_size::DOUBLE END AS mode
    FROM part)
"""


def _transport(t):
    return t.part.select(
        "p_partkey",
        F.when(F.col("p_size") > 25, F.col("p_name")).otherwise("").alias("number"),
        F.when(F.col("p_type") != "ECONOMY", F.col("p_type")).alias("company"),
        F.when(F.col("p_size") % 2 == 0, F.col("p_size").cast("double")).alias("mode"),
    )


@query(_TRANSPORT_SQL + """
SELECT p_partkey, CASE WHEN number <> '' THEN number
    ELSE 'no' || coalesce(company[1:3], '') || coalesce(mode::VARCHAR, '') END AS transport_no
FROM transport
""")
def fallback_identifier(t):
    named = S.fallback_identifier("number", "company", "mode")
    return _transport(t).select("p_partkey", named.alias("transport_no"))


@query(_TRANSPORT_SQL + """
SELECT p_partkey, CASE WHEN number <> '' THEN number WHEN company IS NOT NULL THEN 'no'
    ELSE 'no' || coalesce(mode::VARCHAR, '') END AS transport_no
FROM transport
""")
def fallback_identifier_strict(t):
    named = S.fallback_identifier("number", "company", "mode", strict=True)
    return _transport(t).select("p_partkey", named.alias("transport_no"))


@query("""
SELECT c_custkey, nullif(trunc(c_acctbal / 1000)::BIGINT, 0) AS thousands,
       trunc(c_acctbal)::BIGINT AS units, NULL::BIGINT AS no_number
FROM customer
""")
def to_long_zero_null(t):
    return t.customer.select(
        "c_custkey",
        S.as_long(F.col("c_acctbal") / 1000, zero_is_null=True).alias("thousands"),
        S.as_long(F.col("c_acctbal").cast("string")).alias("units"),
        S.as_long("c_mktsegment").alias("no_number"),
    )


@query("SELECT p_partkey, upper(p_name) AS title, upper(nullif(p_type, 'ECONOMY')) AS kind FROM part")
def upper_names(t):
    return t.part.select(
        "p_partkey",
        S.upper_text("p_name").alias("title"),
        S.upper_text(F.nullif("p_type", F.lit("ECONOMY"))).alias("kind"),
    )


@query("""
SELECT event_id, user_id, event_type, value, props, ts,
       date_trunc('hour', ts) AS hour_start, hour(ts)::INTEGER AS start_hour
FROM events WHERE event_type = 'purchase'
""")
def view_sql(t):
    """A view, all of its columns, and a column computed from one of the same SELECT."""
    t.events.createOrReplaceTempView("starmill_events")
    return t.spark.sql("""
        SELECT *, date_trunc('hour', ts) AS hour_start, hour(hour_start) AS start_hour
        FROM starmill_events WHERE event_type = 'purchase'
    """)
