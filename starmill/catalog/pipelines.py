"""The jobs, run from raw files to their tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from starmill.catalog import derived
from starmill.catalog.registry import Tables, query
from starmill.functions import code_text
from starmill.operators import load
from starmill.operators.facts import equi_join, with_labels
from starmill.operators.nulls import drop_nulls
from starmill.operators.profile import column_profile, greatest_deviation, group_sum
from starmill.operators.quality import coverage
from starmill.plans import exploration, immigration, listening, music
from starmill.schemas import (
    PLAY_LOG_CSV,
    SONG_SESSION,
    USER_LISTENS,
    USER_SESSIONS,
    TableSpec,
    struct,
)
from starmill.sources import read_delimited

# -- music -----------------------------------------------------------------------------------

_MUSIC = "WITH " + derived.SONGS_SQL + ", " + derived.LOG_SQL


def _log(t: Tables):
    return load.conform(
        derived.raw_log(t).select(
            *[F.col(f).alias(name) for name, f in music.LOG_PATHS.items()]
        ),
        music.STAGING_EVENTS,
    )


@query(_MUSIC + """
SELECT make_timestamp(ts * 1000) AS start_time, user_id, level, song_id, artist_id, session_id,
       location, user_agent, year(make_timestamp(ts * 1000))::INTEGER AS year,
       month(make_timestamp(ts * 1000))::INTEGER AS month
FROM plays JOIN songs_raw ON artist = artist_name
""")
def lake_songplays(t):
    """JSON files to five parquet tables; plays match every song of their artist."""
    songs, log = derived.write_music(t)
    return music.build_lake(t.spark, songs, log, t.path("lake"))["songplays"].drop("songplay_id")


@query(_MUSIC + "SELECT song_id, title, duration, year, artist_id FROM songs_raw")
def lake_songs(t):
    songs, _ = derived.write_music(t)
    out = t.path("songs")
    load.overwrite(
        music.songs_of(music.read_songs(t.spark, songs)), out, music.SONGS.partition_by
    )
    return t.spark.read.schema(music.SONGS.schema).parquet(out)


@query(_MUSIC + """
SELECT artist_id, artist_name AS name, artist_location AS location, artist_latitude AS latitude,
       artist_longitude AS longitude
FROM songs_raw QUALIFY row_number() OVER (
    PARTITION BY artist_id ORDER BY artist_name, artist_location, artist_latitude) = 1
""")
def lake_artists(t):
    return music.artists_of(derived.song_metadata(t))


@query(_MUSIC + """
SELECT user_id, first_name, last_name, gender, level FROM plays
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, first_name, last_name, gender, level) = 1
""")
def lake_users(t):
    return music.users_of(music.plays_of(_log(t)))


@query(_MUSIC + """, times AS (SELECT DISTINCT make_timestamp(ts * 1000) AS start_time FROM plays)
SELECT start_time, hour(start_time)::INTEGER AS hour, day(start_time)::INTEGER AS day,
       week(start_time)::INTEGER AS week, month(start_time)::INTEGER AS month,
       year(start_time)::INTEGER AS year, (dayofweek(start_time) + 1)::INTEGER AS weekday
FROM times
""")
def lake_time(t):
    return music.times_of(music.plays_of(_log(t)))


def _database(t: Tables) -> str:
    name = f"starmill_{uuid.uuid4().hex}"
    t.spark.sql(f"CREATE DATABASE {name} LOCATION '{t.path('db')}'")
    return name


_SECONDS = "make_timestamp(ts // 1000 * 1000000)"


@query(_MUSIC + f"""
SELECT DISTINCT {_SECONDS} AS start_time, user_id, level, song_id, artist_id, session_id,
       location, user_agent
FROM plays JOIN songs_raw ON artist = artist_name
""")
def warehouse_songplays(t):
    """JSON files to staging tables to star tables, distinct plays in whole seconds."""
    songs, log = derived.write_music(t)
    database, location = _database(t), t.path("warehouse")
    try:
        music.load_warehouse(t.spark, songs, log, location, database)
    finally:
        t.spark.sql(f"DROP DATABASE {database} CASCADE")
    plays = t.spark.read.schema(music.SONGPLAYS.schema).parquet(f"{location}/songplays")
    return plays.drop("songplay_id", "year", "month")


@query(_MUSIC + "SELECT DISTINCT user_id, first_name, last_name, gender, level FROM plays")
def warehouse_users(t):
    """Every distinct state of a user, so several rows for one whose level changed."""
    return music.users_of(music.plays_of(_log(t), music.WAREHOUSE), music.WAREHOUSE)


@query(_MUSIC + f"""
SELECT md5(session_id || {_SECONDS}::VARCHAR) AS songplay_id, {_SECONDS} AS start_time, user_id,
       level, song_id, artist_id, session_id, location, user_agent
FROM plays LEFT JOIN songs_raw ON song = title AND artist = artist_name AND length = duration
""")
def scheduled_songplays(t):
    """Two runs, the second of which adds only plays that the first did not."""
    songs, log = derived.write_music(t)
    database, location = _database(t), t.path("scheduled")
    run = (t.spark, f"{{root}}{songs}", f"{{root}}{log}", location, database)
    try:
        music.run_scheduled(*run, root="")
        music.run_scheduled(*run, fact_mode="insert_ignore", root="")
    finally:
        t.spark.sql(f"DROP DATABASE {database} CASCADE")
    plays = t.spark.read.schema(music.SONGPLAYS.schema).parquet(f"{location}/songplays")
    return plays.drop("year", "month")


@query(_MUSIC + """
SELECT make_timestamp(ts * 1000) AS start_time, user_id, song_id, artist_id
FROM plays LEFT JOIN songs_raw ON song = title AND artist = artist_name
     AND length::DECIMAL(18,0) = duration::DECIMAL(18,0)
""")
def songplays_by_rounded_length(t):
    """Plays and songs whose lengths agree once both are rounded to whole seconds."""
    rules = music.StarRules(duration_scale=0)
    plays = music.plays_of(_log(t), rules)
    facts = music.songplays_of(plays, derived.song_metadata(t), rules)
    return facts.select("start_time", "user_id", "song_id", "artist_id")


_EARLY_MS = 1704844800000  # 2024-01-10


@query(_MUSIC + """
SELECT user_id, first(first_name ORDER BY ts, item_in_session) AS first_name,
       first(last_name ORDER BY ts, item_in_session) AS last_name,
       first(gender ORDER BY ts, item_in_session) AS gender,
       last(level ORDER BY ts, item_in_session) AS level
FROM plays GROUP BY user_id
""")
def incremental_users(t):
    """Two batches; users keep their names and take their latest level."""
    return _increments(t)["users"]


@query(_MUSIC + """, songs AS (
    SELECT title, artist_name, duration, min(song_id) AS song_id, min(artist_id) AS artist_id
    FROM songs_raw GROUP BY ALL)
SELECT make_timestamp(ts * 1000) AS start_time, user_id, level, song_id, artist_id, session_id,
       location, user_agent
FROM plays LEFT JOIN songs ON song = title AND artist = artist_name AND length = duration
""")
def incremental_songplays(t):
    return _increments(t)["songplays"].drop("songplay_id", "year", "month")


def _increments(t: Tables):
    out, log, songs = t.path("increment"), _log(t), derived.song_metadata(t)
    for early in (True, False):
        batch = log.filter((F.col("ts") < _EARLY_MS) == early)
        tables = music.load_increment(t.spark, songs, batch, out)
    return tables


@query("""
SELECT 'broken' AS reasons, '{"cut off": ' || event_id AS record FROM events WHERE event_id % 50 = 0
UNION ALL
SELECT 'not_null session_id;not_null ts', '{"page":"Page ' || event_id || '"}'
FROM events WHERE event_id % 70 = 0
UNION ALL
SELECT 'max_length page;cast ts', '{"page":"' || repeat('x', 26) || '","session_id":"'
       || event_id || '","ts":1.0E20}'
FROM events WHERE event_id % 90 = 0
""")
def bulk_load_rejects(t):
    """What a bulk load leaves out of a log and lists: lines that are cut off, records without
    their required values, and some with a time out of range and a text too long."""
    songs, log = derived.write_music(t)
    number = F.col("event_id").cast("string")
    kinds = {
        50: F.concat(F.lit('{"cut off": '), number),
        70: F.concat(F.lit('{"page": "Page '), number, F.lit('"}')),
        90: F.concat(F.lit(f'{{"page": "{"x" * 26}", "ts": 1e20, "sessionId": "'), number, F.lit('"}')),
    }
    for every, text in kinds.items():
        t.events.where(F.col("event_id") % every == 0).select(text).write.mode("append").text(log)
    database, location = _database(t), t.path("warehouse")
    try:
        music.load_warehouse(t.spark, songs, log, location, database, allowance=10**9)
    finally:
        t.spark.sql(f"DROP DATABASE {database} CASCADE")
    listed = t.spark.read.json(music.rejects_at(location))
    return listed.select(F.array_join("reasons", ";").alias("reasons"), "record")


@query(_MUSIC + f"""
SELECT md5(session_id || {_SECONDS}::VARCHAR) AS songplay_id, {_SECONDS} AS start_time, user_id,
       level, song_id, artist_id, session_id, location, user_agent
FROM plays LEFT JOIN songs_raw ON song = title AND artist = artist_name AND length = duration
""")
def scheduled_once(t):
    """Three runs over the same log files, which are taken once."""
    songs, log = derived.write_music(t)
    database, location = _database(t), t.path("scheduled")
    try:
        for _ in range(3):
            music.run_scheduled(t.spark, songs, log, location, database, fact_mode="once")
    finally:
        t.spark.sql(f"DROP DATABASE {database} CASCADE")
    plays = t.spark.read.schema(music.SONGPLAYS_BY_LOAD.schema).parquet(f"{location}/songplays")
    return plays.drop("load", "year", "month")


@query(_MUSIC + """, songs AS (
    SELECT title, artist_name, duration, min(song_id) AS song_id, min(artist_id) AS artist_id
    FROM songs_raw GROUP BY ALL)
SELECT make_timestamp(ts * 1000) AS start_time, user_id, level, song_id, artist_id, session_id,
       location, user_agent
FROM plays LEFT JOIN songs ON song = title AND artist = artist_name AND length = duration
""")
def increment_of_files(t):
    """Two runs over folders of files; the second finds none that is new."""
    songs, log = derived.write_music(t)
    out = t.path("increment")
    for _ in range(2):
        tables = music.run_increment(t.spark, songs, log, out)
    return tables["songplays"].drop("songplay_id", "year", "month")


@query("""
SELECT user_id, arg_max(event_type, (ts, event_id)) AS last_type, max(ts) AS last_time
FROM events GROUP BY user_id
""")
def keyed_upsert_by_bucket(t):
    """Users merged into a keyed table by batches of four days, each of which rewrites only the
    buckets of its users."""
    spec = TableSpec(
        "seen", "user_id BIGINT, last_type STRING, last_time TIMESTAMP", ("user_id",), ("user_id",)
    )
    path = t.path("seen")
    rows = t.events.select(
        "user_id", F.col("event_type").alias("last_type"), F.col("ts").alias("last_time"), "event_id"
    )
    batch = F.floor(F.dayofyear("last_time") / 4)
    numbers = [r[0] for r in rows.select(batch).distinct().collect()]
    for n in sorted(numbers):
        load.upsert_into(
            path, rows.where(batch == n), ["user_id"], ["last_time", "event_id"],
            ["last_type", "last_time"], spec, buckets=16,
        )
    return load.read_version(t.spark, path, spec.schema)


# -- listening history -----------------------------------------------------------------------

_HISTORY = "WITH " + derived.LOG_SQL + ", history AS (SELECT * FROM log_raw WHERE artist IS NOT NULL)"


def _history(t: Tables):
    path = t.path("exports")
    derived.raw_log(t).select(*PLAY_LOG_CSV.names).write.options(header=True).csv(path)
    return listening.read_history(t.spark, path)


@query(_HISTORY + """
SELECT artist, first_name AS "firstName", gender, item_in_session::VARCHAR AS "itemInSession",
       last_name AS "lastName", length::VARCHAR AS length, level, location,
       session_id AS "sessionId", song, user_id AS "userId"
FROM history
""")
def history_extract(t):
    path = t.path("extract")
    history = _history(t)
    listening.save_extract(history, path)
    return read_delimited(t.spark, path, history.select(*listening.EXTRACT).schema)


@query(_HISTORY + """
SELECT session_id::INTEGER AS session_id, item_in_session, artist AS artist_name, song, length
FROM history
""")
def history_song_session(t):
    return listening.save_query_table(_history(t), SONG_SESSION, t.path("song_session"))


@query(_HISTORY + """
SELECT session_id::INTEGER AS session_id, user_id::INTEGER AS user_id, item_in_session,
       artist AS artist_name, song, first_name AS user_first_name, last_name AS user_last_name
FROM history
""")
def history_user_sessions(t):
    return listening.save_query_table(_history(t), USER_SESSIONS, t.path("user_sessions"))


@query(_HISTORY + """
SELECT DISTINCT song, user_id::INTEGER AS user_id, artist AS artist_name,
       first_name AS user_first_name, last_name AS user_last_name
FROM history
""")
def history_user_listens(t):
    return listening.save_query_table(_history(t), USER_LISTENS, t.path("user_listens"))


# -- immigration -----------------------------------------------------------------------------

_ARRIVALS = "WITH " + derived.ARRIVALS_SQL


def _decoded(t: Tables):
    return immigration.decode(derived.arrivals(t))


@query(_ARRIVALS + """
SELECT cic_id, arrdate::DATE AS arrdate, depdate::DATE AS depdate,
       expiration_time::DATE AS expiration_date, transport_no, city, state
FROM arrivals
""")
def immigration_augmented(t):
    return immigration.augment(derived.arrivals(t), derived.codes(t)).select(
        "cic_id", "arrdate", "depdate", "expiration_date", "transport_no", "city", "state"
    )


@query(_ARRIVALS + """, times AS (
    SELECT arrdate AS time FROM arrivals UNION SELECT depdate FROM arrivals
    UNION SELECT expiration_time FROM arrivals)
SELECT time, hour(time)::INTEGER AS hour, day(time)::INTEGER AS day, week(time)::INTEGER AS week,
       month(time)::INTEGER AS month, year(time)::INTEGER AS year,
       (dayofweek(time) + 1)::INTEGER AS weekday
FROM times WHERE time >= TIMESTAMP '2015-01-01'
""")
def immigration_time(t):
    return immigration.immigration_time_dim(_decoded(t))


@query(_ARRIVALS + ", " + derived.DEMOGRAPHICS_SQL + ", " + derived.TEMPERATURES_SQL + """,
cities AS (
    SELECT * REPLACE (coalesce(male_population, 0) AS male_population,
                      coalesce(number_of_veterans, 0) AS number_of_veterans),
           upper(city) AS name FROM demographics
    QUALIFY row_number() OVER (PARTITION BY state_code, upper(city) ORDER BY count DESC, race) = 1),
warmth AS (SELECT upper(city) AS name, avg(average_temperature) AS avg_temp FROM temperatures
           WHERE country = 'United States' GROUP BY 1),
known AS (SELECT cities.* EXCLUDE (city, race, count), race AS most_common_race, 'US' AS country,
                 avg_temp
          FROM cities LEFT JOIN warmth ON cities.name = warmth.name),
entered AS (SELECT DISTINCT state AS state_code, city AS name FROM arrivals)
SELECT state_code, name, state, median_age, male_population, female_population,
       total_population, number_of_veterans, foreign_born, average_household_size,
       most_common_race, country, round(avg_temp, 9) AS avg_temp
FROM known FULL JOIN entered USING (state_code, name)
""")
def immigration_city(t):
    city = immigration.city_dim(
        _decoded(t), derived.codes(t), derived.demographics(t), derived.temperatures(t)
    )
    return city.drop("city_id").withColumn("avg_temp", F.round("avg_temp", 9))


@query("WITH " + derived.AIRPORTS_SQL + """
SELECT local_code AS port, name, municipality, iso_country AS country, elevation_ft, longitude,
       latitude, 'NA' AS continent, type
FROM airports WHERE iso_country = 'US'
""")
def immigration_port(t):
    return immigration.port_dim(derived.airports(t)).drop("port_id")


@query(_ARRIVALS + "SELECT DISTINCT visapost AS name FROM arrivals")
def immigration_visa_issuer(t):
    return immigration.visa_issuer_dim(_decoded(t)).drop("visa_issuer_id")


@query(_ARRIVALS + ", " + derived.LABELS_SQL + """
SELECT cic_id, coalesce(c.label, 'No Country Code') AS citizenship,
       CASE WHEN city = 'No PORT Code' THEN city ELSE city || ', ' || state END AS port,
       m.label AS travel_mode, v.label AS visa, city, state
FROM arrivals LEFT JOIN countries c ON c.code = i94cit LEFT JOIN modes m ON m.code = kind
LEFT JOIN visas v ON v.code = kind
""")
def immigration_labels(t):
    """Every label of a record: country, port, travel mode and visa, city and state."""
    codes = derived.codes(t)
    numbered = codes.filter("numeric")
    rows = immigration.with_entry_city(_decoded(t), codes)
    no_port, no_country = immigration.NO_PORT, immigration.NO_COUNTRY
    rows = with_labels(rows, codes, "I94PORT", "i94port", {"port": ("label", no_port)})
    for field, code, out, default in (
        ("I94CIT", "i94cit", "citizenship", no_country),
        ("I94MODE", "i94mode", "travel_mode", None),
        ("I94VISA", "i94visa", "visa", None),
    ):
        rows = with_labels(rows, numbered, field, code_text(code), {out: ("label", default)})
    return rows.select("cic_id", "citizenship", "port", "travel_mode", "visa", "city", "state")


_ALIENS = _ARRIVALS + ", " + derived.LABELS_SQL + """, aliens AS (
    SELECT a.*, coalesce(c.label, 'No Country Code') AS citizenship_origin,
           coalesce(r.label, 'No Country Code') AS residency_origin, v.label AS i94visa
    FROM (SELECT * FROM arrivals WHERE admission_id IS NOT NULL
          QUALIFY row_number() OVER (PARTITION BY admission_id ORDER BY sas_arrdate, cic_id) = 1) a
    LEFT JOIN countries c ON c.code = i94cit LEFT JOIN countries r ON r.code = i94res
    LEFT JOIN visas v ON v.code = kind)
"""


@query(_ALIENS + """
SELECT admission_id, citizenship_origin, residency_origin, gender, age, visatype, i94visa,
       entdepa, entdepd, matflag, year_of_birth
FROM aliens
""")
def immigration_alien(t):
    return immigration.alien_dim(_decoded(t), derived.codes(t))


@query(_ARRIVALS + """
SELECT transport_no, airline AS company, kind::DOUBLE AS mode FROM arrivals
QUALIFY row_number() OVER (PARTITION BY transport_no ORDER BY sas_arrdate, cic_id) = 1
""")
def immigration_logistics(t):
    return immigration.logistics_dim(_decoded(t)).drop("transport_id")


def _build(t: Tables):
    return immigration.build_immigration(t.spark, derived.immigration_inputs(t), t.path("immigration"))


@query(_ARRIVALS + ", " + derived.AIRPORTS_SQL + """
SELECT cic_id, city, state AS state_code, expiration_time, admission_id, arrdate, depdate,
       transport_no, visapost AS visa_issuer,
       i94port IN (SELECT local_code FROM airports
                   WHERE iso_country = 'US' AND local_code IS NOT NULL) AS at_airport,
       i94_year, i94_month
FROM arrivals
""")
def immigration_fact(t):
    """The whole job; keys of the fact are resolved through the saved dimensions again."""
    tables = _build(t)
    rows = tables["immigrations"]
    rows = equi_join(
        rows, tables["city"], {"arrival_city": "city_id"}, {"city": "name", "state_code": "state_code"}
    )
    rows = equi_join(
        rows, tables["logistics"], {"transport_id": "transport_id"}, {"transport_no": "transport_no"}
    )
    rows = equi_join(
        rows, tables["visa_issuer"], {"visa_issuer_id": "visa_issuer_id"}, {"visa_issuer": "name"}
    )
    return rows.select(
        "cic_id", "city", "state_code", "expiration_time", "admission_id", "arrdate", "depdate",
        "transport_no", "visa_issuer", F.col("port_id").isNotNull().alias("at_airport"),
        "i94_year", "i94_month",
    )


def _report(t: Tables, name: str, by: str, **nation: str):
    out = t.path("reports")
    immigration.save_reports(_build(t), out, **nation)
    return read_delimited(t.spark, f"{out}/{name}", struct(f"{by}, count BIGINT"))


@query(_ARRIVALS + """
SELECT region_name AS state, count(*) AS count FROM raw WHERE p1 <> '4' AND n_regionkey < 4
GROUP BY 1 ORDER BY count DESC, state LIMIT 10
""")
def immigration_top_states(t):
    return _report(t, immigration.STATE_REPORT, "state STRING")


@query(_ARRIVALS + """
SELECT i94_month AS month, count(*) AS count FROM arrivals GROUP BY 1
""")
def immigration_months(t):
    return _report(t, immigration.MONTH_REPORT, "month INT")


@query(_ALIENS + """
SELECT i94_month AS month, count(*) AS count
FROM arrivals WHERE admission_id IN (SELECT admission_id FROM aliens WHERE citizenship_origin = 'NATION_6')
GROUP BY 1
""")
def immigration_months_of_one_nation(t):
    report = immigration.NATION_REPORT
    return _report(t, report, "month INT", nation="NATION_6")


def _months(t: Tables) -> str:
    """Raw records in a tree of folders, one per month."""
    path = t.path("months")
    raw = derived.arrivals(t).select("cic_id", "i94mon", "admnum")
    raw.withColumn("month", F.col("i94mon").cast("int")).write.partitionBy("month").parquet(path)
    return path


@query(_ARRIVALS + "SELECT o_orderkey::DOUBLE AS cic_id, month(arrived)::DOUBLE AS i94mon FROM raw")
def immigration_all_months(t):
    return immigration.read_immigration(t.spark, _months(t)).select("cic_id", "i94mon")


@query(_ARRIVALS + """
SELECT o_orderkey::DOUBLE AS cic_id, month(arrived)::DOUBLE AS i94mon
FROM raw WHERE month(arrived) = 4
""")
def immigration_one_month(t):
    path = _months(t)
    april = immigration.read_immigration(t.spark, path, month_file="month={month}", month=4)
    return april.select("cic_id", "i94mon")


# -- exploration -----------------------------------------------------------------------------


@query("WITH " + derived.TEMPERATURES_SQL + """
SELECT count(*) FILTER (dt LIKE '2015%') AS in_year,
       count(*) FILTER (dt LIKE '2015%' AND country = 'United States') AS in_year_at_home,
       count(*) FILTER (country = 'United States') AS at_home,
       max(dt[1:4])::INTEGER AS newest_year
FROM temperatures
""")
def explore_temperatures(t):
    return exploration.temperature_coverage(derived.temperatures(t), 2015)


@query("WITH " + derived.AIRPORTS_SQL + """
SELECT count(*) AS at_home, count(*) - count(continent) AS without_continent,
       count(continent) AS with_continent
FROM airports WHERE iso_country = 'US'
""")
def explore_airports(t):
    return exploration.airport_continents(derived.airports(t))


@query("WITH " + derived.DEMOGRAPHICS_SQL + """
SELECT city, state, male_population, sum(count)::BIGINT AS count FROM demographics GROUP BY ALL
""")
def explore_people(t):
    return group_sum(derived.demographics(t), ["city", "state", "male_population"], ["count"])


@query("WITH " + derived.DEMOGRAPHICS_SQL + """
SELECT round(max(a), 6) AS median_age, round(max(c), 6) AS count
FROM (SELECT stddev_samp(median_age) AS a, stddev_samp(count) AS c FROM demographics GROUP BY city, state)
""")
def explore_deviation(t):
    worst = greatest_deviation(derived.demographics(t), exploration.CITY_KEY, ["median_age", "count"])
    return worst.select(*[F.round(c, 6).alias(c) for c in worst.columns])


@query(_ARRIVALS + ", " + derived.AIRPORTS_SQL + """, seen AS (SELECT DISTINCT local_code FROM airports)
SELECT count(local_code) AS matched, count(*) AS total, count(local_code) / count(*) AS ratio
FROM arrivals LEFT JOIN seen ON i94port = local_code
""")
def explore_ports(t):
    arrivals = drop_nulls(derived.arrivals(t), ["admnum"])
    return coverage(arrivals, derived.airports(t), ("i94port", "local_code"))


@query("WITH " + derived.DEMOGRAPHICS_SQL + """, long AS (
    SELECT 'race' AS column_name, race AS value FROM demographics
    UNION ALL SELECT 'state', state FROM demographics
    UNION ALL SELECT 'male_population', male_population::VARCHAR FROM demographics),
counts AS (SELECT column_name, value, count(*) AS frequency FROM long GROUP BY ALL),
totals AS (SELECT column_name, sum(frequency)::BIGINT AS row_count, count(*) AS distinct_values,
                  coalesce(sum(frequency) FILTER (value IS NULL), 0)::BIGINT AS null_count
           FROM counts GROUP BY column_name)
SELECT column_name, row_count, distinct_values, null_count,
       null_count * 100.0::DOUBLE / row_count AS null_percent,
       row_number() OVER (PARTITION BY column_name
                          ORDER BY frequency DESC, value NULLS LAST)::INTEGER AS position,
       value, frequency
FROM counts JOIN totals USING (column_name) QUALIFY position <= 10
""")
def explore_profile(t):
    return column_profile(derived.demographics(t), ["race", "state", "male_population"], 10)
