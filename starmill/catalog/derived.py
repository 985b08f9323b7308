"""Raw inputs of the jobs, derived from the driver tables, in Spark and as SQL.

Songs come from ``part``, the play log from ``events`` (each event plays the part its JSON
property names), arrivals from ``orders`` and ``customer``, airports and temperatures from
``supplier``, demographics from ``customer``, and code lists from ``nation`` and ``region``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.catalog.registry import Tables
from starmill.operators.load import conform
from starmill.plans.immigration import Inputs
from starmill.schemas import AIRPORTS, DEMOGRAPHICS, IMMIGRATION, PLAY_LOG, TEMPERATURES
from starmill.sources import read_code_tables, read_delimited

# -- music -----------------------------------------------------------------------------------


def _artist():
    """One artist per brand and type, each with several songs."""
    return F.concat_ws(" ", F.col("p_brand"), F.col("p_type"))


def song_metadata(t: Tables) -> DataFrame:
    return t.part.select(
        F.lit(1).alias("num_songs"),
        F.regexp_replace(_artist(), "Brand#", "AR").alias("artist_id"),
        F.col("p_size").cast("double").alias("artist_latitude"),
        (-F.col("p_size")).cast("double").alias("artist_longitude"),
        F.concat(F.lit("Town of "), "p_name").alias("artist_location"),
        _artist().alias("artist_name"),
        F.concat(F.lit("SO"), F.col("p_partkey")).alias("song_id"),
        F.col("p_name").alias("title"),
        F.col("p_retailprice").alias("duration"),
        (F.length("p_type") + 1990).alias("year"),
    )


SONGS_SQL = """songs_raw AS (
    SELECT 1 AS num_songs, replace(p_brand, 'Brand#', 'AR') || ' ' || p_type AS artist_id,
           p_size::DOUBLE AS artist_latitude, (-p_size)::DOUBLE AS artist_longitude,
           'Town of ' || p_name AS artist_location, p_brand || ' ' || p_type AS artist_name,
           'SO' || p_partkey AS song_id, p_name AS title, p_retailprice AS duration,
           (length(p_type) + 1990)::INTEGER AS year
    FROM part)"""


def raw_log(t: Tables) -> DataFrame:
    """The play log under the names of its files. Purchases play a known song, views one of
    another length, and other events are no plays."""
    events = t.events.withColumn("k", F.get_json_object("props", "$.k").cast("long"))
    played = events.join(t.part, F.col("k") == F.col("p_partkey"), "left")
    kind = F.col("event_type")
    user = F.col("user_id")
    rows = played.select(
        _artist().alias("artist"),
        F.lit("Logged In").alias("auth"),
        F.concat(F.lit("First"), user).alias("firstName"),
        F.when(user % 2 == 0, "F").otherwise("M").alias("gender"),
        F.col("event_id").cast("int").alias("itemInSession"),
        F.concat(F.lit("Last"), user).alias("lastName"),
        (F.col("p_retailprice") + F.when(kind == "view", 0.5).otherwise(0.0)).alias("length"),
        F.when(F.col("value") >= 50, "paid").otherwise("free").alias("level"),
        F.concat(F.lit("City "), user % 10).alias("location"),
        F.lit("PUT").alias("method"),
        F.when(kind.isin("purchase", "view"), "NextSong").otherwise(kind).alias("page"),
        F.lit(None).cast("string").alias("registration"),
        user.cast("string").alias("sessionId"),
        F.col("p_name").alias("song"),
        F.lit(200).alias("status"),
        F.floor(F.unix_micros("ts") / 1000).cast("double").alias("ts"),
        F.lit("agent").alias("userAgent"),
        user.cast("string").alias("userId"),
    )
    return rows.to(PLAY_LOG)


LOG_SQL = """log_raw AS (
    SELECT p_brand || ' ' || p_type AS artist, 'Logged In' AS auth, 'First' || user_id AS first_name,
           CASE WHEN user_id % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
           event_id::INTEGER AS item_in_session, 'Last' || user_id AS last_name,
           p_retailprice + CASE WHEN event_type = 'view' THEN 0.5 ELSE 0 END AS length,
           CASE WHEN value >= 50 THEN 'paid' ELSE 'free' END AS level,
           'City ' || (user_id % 10) AS location,
           CASE WHEN event_type IN ('purchase', 'view') THEN 'NextSong'
                ELSE event_type END AS page,
           user_id::VARCHAR AS session_id, p_name AS song, epoch_us(ts) // 1000 AS ts,
           'agent' AS user_agent, user_id::VARCHAR AS user_id
    FROM events LEFT JOIN part
      ON p_partkey = json_extract_string(props, '$.k')::BIGINT),
plays AS (SELECT * FROM log_raw WHERE page = 'NextSong')"""


def write_music(t: Tables) -> tuple[str, str]:
    """Save metadata and log as JSON lines, as the jobs expect them; returns their folders. The log,
    whose lines repeat most of their text, is compressed."""
    songs, log = t.path("song_data"), t.path("log_data")
    song_metadata(t).write.json(f"{songs}/A/B/C")
    raw_log(t).write.json(log, compression="gzip")
    return songs, log


# -- immigration -----------------------------------------------------------------------------


# Orders are from the nineties; arrivals are taken this many days later.
DELAY = 7305


def arrivals(t: Tables) -> DataFrame:
    orders = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).withColumn(
        "arrived", F.date_add("o_orderdate", DELAY)
    )
    day = F.datediff("arrived", F.lit("1960-01-01"))
    status, priority, nation = F.col("o_orderstatus"), F.col("o_orderpriority"), F.col("c_nationkey")
    kind = F.when(status == "F", 1).when(status == "O", 2).otherwise(3)
    none = F.lit(None)
    values = {
        "cic_id": F.col("o_orderkey"),
        "i94yr": F.year("arrived"),
        "i94mon": F.month("arrived"),
        "i94cit": nation,
        "i94res": nation + 1,
        "i94port": F.concat(F.lit("P"), F.lpad(nation.cast("string"), 2, "0")),
        "sas_arrdate": day,
        "i94mode": kind,
        "i94addr": none,
        "sas_depdate": F.when(status != "O", day + 30),
        "i94bir": nation + 20,
        "i94visa": kind,
        "count": F.lit(1),
        "dtadfile": none,
        "visapost": F.nullif("c_mktsegment", F.lit("HOUSEHOLD")),
        "occup": none,
        "entdepa": F.substring(priority, 1, 1),
        "entdepd": status,
        "entdepu": none,
        "matflag": F.when(status != "O", "M"),
        "biryear": F.lit(1990) - nation,
        "dtaddto": F.when(status == "P", "D/S").otherwise(
            F.date_format(F.date_add("arrived", 180), "MMddyyyy")
        ),
        "gender": F.when(F.col("c_acctbal") > 0, "F").otherwise("M"),
        "insnum": none,
        "airline": F.when(~priority.startswith("5"), F.substring("c_mktsegment", 1, 4)),
        "admnum": F.when(~priority.startswith("4"), F.col("o_custkey")),
        "fltno": F.when(
            ~priority.startswith("1") & ~priority.startswith("5"),
            F.concat(F.substring(priority, 3, 3), nation),
        ),
        "visatype": F.concat(F.lit("B"), kind),
    }
    types = {f.name: f.dataType for f in IMMIGRATION.fields}
    return orders.select(*[values[n].cast(types[n]).alias(n) for n in IMMIGRATION.names])


# Arrivals as augmented: dates decoded, transport named, city and state of the port.
ARRIVALS_SQL = """raw AS (
    SELECT *, o_orderdate + INTERVAL 7305 DAY AS arrived,
           date_diff('day', DATE '1960-01-01', arrived::DATE) AS day,
           CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS kind,
           o_orderpriority[1] AS p1, n_name AS nation_name, r_name AS region_name
    FROM orders JOIN customer ON o_custkey = c_custkey
    JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey),
arrivals AS (
    SELECT o_orderkey::DOUBLE AS cic_id, year(arrived)::INTEGER AS i94_year,
           month(arrived)::INTEGER AS i94_month, c_nationkey AS i94cit,
           c_nationkey + 1 AS i94res, 'P' || lpad(c_nationkey::VARCHAR, 2, '0') AS i94port,
           arrived AS arrdate,
           CASE WHEN o_orderstatus <> 'O' THEN arrived + INTERVAL 30 DAY END AS depdate,
           CASE WHEN o_orderstatus <> 'P' THEN arrived + INTERVAL 180 DAY
           END AS expiration_time,
           day AS sas_arrdate, kind, (c_nationkey + 20)::BIGINT AS age,
           nullif(c_mktsegment, 'HOUSEHOLD') AS visapost, p1 AS entdepa,
           o_orderstatus AS entdepd, CASE WHEN o_orderstatus <> 'O' THEN 'M' END AS matflag,
           (1990 - c_nationkey)::BIGINT AS year_of_birth,
           CASE WHEN c_acctbal > 0 THEN 'F' ELSE 'M' END AS gender,
           CASE WHEN p1 <> '5' THEN c_mktsegment[1:4] END AS airline,
           nullif(o_custkey, 0) AS admission_id,
           CASE WHEN p1 NOT IN ('1', '5') THEN o_orderpriority[3:5] || c_nationkey
                ELSE 'no' || CASE WHEN p1 <> '5' THEN c_mktsegment[1:3] ELSE '' END
                     || kind || '.0' END AS transport_no,
           'B' || kind AS visatype,
           CASE WHEN n_regionkey < 4 THEN nation_name ELSE 'No PORT Code' END AS city,
           CASE WHEN n_regionkey < 4 THEN region_name[1:2] ELSE '' END AS state
    FROM raw WHERE p1 <> '4')"""

# Labels of the country and visa codes.
LABELS_SQL = """countries AS (
    SELECT n_nationkey AS code, CASE WHEN n_regionkey = 3 THEN 'No Country Code'
                                     ELSE n_name END AS label
    FROM nation WHERE n_regionkey < 4),
visas AS (SELECT * FROM (VALUES (1, 'Business'), (2, 'Pleasure'), (3, 'Student')) v(code, label)),
modes AS (SELECT * FROM (VALUES (1, 'Air'), (2, 'Sea'), (9, 'Not reported')) v(code, label))"""


def write_codes(t: Tables) -> str:
    """Code lists, a folder per region, each with a country and a port section. The last
    region is left out, and the countries of the one before are labelled as unknown."""
    path = t.path("codes")
    nations = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).filter(
        F.col("r_regionkey") < 4
    )
    key, region = F.col("n_nationkey").cast("string"), F.col("r_regionkey")
    country = F.when(region == 3, F.concat(F.lit("No Country Code ("), key, F.lit(")")))
    entry = F.concat(
        F.lit("   "), key, F.lit(" =  '"), country.otherwise(F.col("n_name")), F.lit("'")
    )
    port = F.concat(
        F.lit("   'P"), F.lpad(key, 2, "0"), F.lit("'\t=\t'"),
        F.col("n_name"), F.lit(", "), F.substring("r_name", 1, 2), F.lit("     '"),
    )
    visas = ["/* I94VISA - Visa categories:", "   1 = Business", "   2 = Pleasure", "   3 = Student"]
    modes = ["/* I94MODE - Modes */", "\t1 = 'Air'", "\t2 = 'Sea'", "\t9 = 'Not reported' ;"]
    fixed = visas + modes
    headers = t.region.filter("r_regionkey < 4").select(
        "r_regionkey",
        F.posexplode(
            F.array(
                *[F.lit(line) for line in fixed],
                F.lit("/* I94CIT & I94RES - valid and invalid codes */"),
                F.lit("/* I94PORT - valid and invalid codes */"),
            )
        ).alias("section", "value"),
    ).select(
        "r_regionkey",
        F.when(F.col("section") == len(fixed) + 1, 200).otherwise(F.col("section")).alias("place"),
        "value",
    )
    listed = nations.select(
        "r_regionkey", (F.col("n_nationkey") + 100).alias("place"), entry.alias("value")
    ).unionByName(
        nations.select(
            "r_regionkey", (F.col("n_nationkey") + 300).alias("place"), port.alias("value")
        )
    )
    (
        headers.unionByName(listed)
        .repartition("r_regionkey")
        .sortWithinPartitions("r_regionkey", "place")
        .select("r_regionkey", "value")
        .write.partitionBy("r_regionkey")
        .text(path)
    )
    return path


def codes(t: Tables) -> DataFrame:
    return read_code_tables(t.spark, f"{write_codes(t)}/*")


def _through_csv(t: Tables, df: DataFrame, schema, label: str, sep: str) -> DataFrame:
    """Write as delimited text with a header and read it back with its schema."""
    path = t.path(label)
    conform(df, schema).write.options(header=True, sep=sep).csv(path)
    return read_delimited(t.spark, path, schema, sep)


def demographics(t: Tables) -> DataFrame:
    nations = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    counted = t.customer.groupBy("c_nationkey", "c_mktsegment").agg(F.count("*").alias("count"))
    key = F.col("n_nationkey")
    rows = counted.join(nations, F.col("c_nationkey") == key).select(
        F.concat(F.lit("Nation_"), key).alias("city"),
        F.col("r_name").alias("state"),
        (key / 10 + 30).alias("median_age"),
        F.when(key != 5, key * 100).alias("male_population"),
        (key * 101).alias("female_population"),
        (key * 201).alias("total_population"),
        F.when(key != 6, key * 3).alias("number_of_veterans"),
        (key * 2).alias("foreign_born"),
        F.lit(2.5).alias("average_household_size"),
        F.substring("r_name", 1, 2).alias("state_code"),
        F.col("c_mktsegment").alias("race"),
        "count",
    )
    return _through_csv(t, rows, DEMOGRAPHICS, "demographics", ";")


DEMOGRAPHICS_SQL = """demographics AS (
    SELECT 'Nation_' || n_nationkey AS city, r_name AS state,
           n_nationkey / 10 + 30 AS median_age,
           CASE WHEN n_nationkey <> 5 THEN n_nationkey * 100.0 END::DOUBLE AS male_population,
           (n_nationkey * 101)::DOUBLE AS female_population,
           (n_nationkey * 201)::INTEGER AS total_population,
           CASE WHEN n_nationkey <> 6 THEN n_nationkey * 3.0 END::DOUBLE AS number_of_veterans,
           (n_nationkey * 2)::DOUBLE AS foreign_born, 2.5::DOUBLE AS average_household_size,
           r_name[1:2] AS state_code, c_mktsegment AS race, count(*)::INTEGER AS count
    FROM customer JOIN nation ON n_nationkey = c_nationkey
    JOIN region ON r_regionkey = n_regionkey
    GROUP BY n_nationkey, r_name, c_mktsegment)"""


def temperatures(t: Tables) -> DataFrame:
    key, balance = F.col("s_nationkey"), F.col("s_acctbal")
    rows = t.supplier.select(
        F.date_format(F.date_add(F.lit("2013-01-01").cast("date"), key * 50), "yyyy-MM-dd").alias("dt"),
        F.when(balance > 0, balance / 100).alias("average_temperature"),
        F.lit(0.5).alias("average_temperature_uncertainty"),
        F.concat(F.lit("nation_"), key).alias("city"),
        F.when(key < 20, "United States").otherwise("Elsewhere").alias("country"),
        F.lit("1N").alias("latitude"),
        F.lit("2W").alias("longitude"),
    )
    return _through_csv(t, rows, TEMPERATURES, "temperatures", ",")


TEMPERATURES_SQL = """temperatures AS (
    SELECT strftime(DATE '2013-01-01' + s_nationkey * 50, '%Y-%m-%d') AS dt,
           CASE WHEN s_acctbal > 0 THEN s_acctbal / 100 END AS average_temperature,
           0.5::DOUBLE AS average_temperature_uncertainty, 'nation_' || s_nationkey AS city,
           CASE WHEN s_nationkey < 20 THEN 'United States' ELSE 'Elsewhere' END AS country,
           '1N' AS latitude, '2W' AS longitude
    FROM supplier)"""


def airports(t: Tables) -> DataFrame:
    key, balance = F.col("s_nationkey"), F.col("s_acctbal")
    rows = t.supplier.select(
        F.concat(F.lit("S"), F.col("s_suppkey")).alias("ident"),
        F.when(balance > 5000, "large_airport").otherwise("small_airport").alias("type"),
        F.col("s_name").alias("name"),
        balance.cast("int").alias("elevation_ft"),
        F.when(key == 3, "AS").alias("continent"),
        F.when(key < 20, "US").otherwise("XX").alias("iso_country"),
        F.concat(F.lit("US-"), key).alias("iso_region"),
        F.concat(F.lit("Town "), key).alias("municipality"),
        F.lit(None).alias("gps_code"),
        F.lit(None).alias("iata_code"),
        F.when(balance > 0, F.concat(F.lit("P"), F.lpad(key.cast("string"), 2, "0"))).alias("local_code"),
        F.concat(-key, F.lit(".25, "), key, F.lit(".5")).alias("coordinates"),
    )
    return _through_csv(t, rows, AIRPORTS, "airports", ",")


AIRPORTS_SQL = """airports AS (
    SELECT 'S' || s_suppkey AS ident,
           CASE WHEN s_acctbal > 5000 THEN 'large_airport' ELSE 'small_airport' END AS type,
           s_name AS name, trunc(s_acctbal)::INTEGER AS elevation_ft,
           CASE WHEN s_nationkey = 3 THEN 'AS' END AS continent,
           CASE WHEN s_nationkey < 20 THEN 'US' ELSE 'XX' END AS iso_country,
           'Town ' || s_nationkey AS municipality,
           CASE WHEN s_acctbal > 0 THEN 'P' || lpad(s_nationkey::VARCHAR, 2, '0')
           END AS local_code,
           ((-s_nationkey) || '.25')::DOUBLE AS longitude,
           (s_nationkey || '.5')::DOUBLE AS latitude
    FROM supplier)"""


def immigration_inputs(t: Tables) -> Inputs:
    return Inputs(arrivals(t), demographics(t), temperatures(t), airports(t), codes(t))
