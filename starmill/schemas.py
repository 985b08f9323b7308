"""Schemas of the raw inputs and contracts of the tables built from them."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import types as T


_TYPES = {
    "STRING": T.StringType(),
    "INT": T.IntegerType(),
    "BIGINT": T.LongType(),
    "DOUBLE": T.DoubleType(),
    "TIMESTAMP": T.TimestampType(),
    "DECIMAL": T.DecimalType(10, 0),
}


def struct(columns: str) -> T.StructType:
    """A schema from "name TYPE, name TYPE"; unlike Spark's own DDL reader, without a session."""
    pairs = [c.split() for c in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


@dataclass(frozen=True)
class TableSpec:
    """A table contract: columns in order, key, columns without nulls, lengths, layout, and the
    compression of its files, if not the session's."""

    name: str
    columns: str
    key: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    max_length: Mapping[str, int] = field(default_factory=dict)
    partition_by: tuple[str, ...] = ()
    compression: str | None = None

    @property
    def schema(self) -> T.StructType:
        return struct(self.columns)

    def _sql_type(self, field: T.StructField) -> str:
        length = self.max_length.get(field.name)
        return f"VARCHAR({length})" if length else field.dataType.simpleString()

    def unpartitioned(self) -> TableSpec:
        return replace(self, partition_by=())

    def create_statement(self, table: str, location: str) -> str:
        """DDL of a parquet table. Texts of limited length become VARCHAR, for which Spark
        refuses longer values on insert; columns that partition the table come last."""
        plain = [f for f in self.schema.fields if f.name not in self.partition_by]
        parts = [self.schema[c] for c in self.partition_by]
        listed = ", ".join(f"`{f.name}` {self._sql_type(f)}" for f in [*plain, *parts])
        by = ", ".join(f"`{c}`" for c in self.partition_by)
        partitioned = f" PARTITIONED BY ({by})" if by else ""
        options = f" OPTIONS (compression '{self.compression}')" if self.compression else ""
        return (
            f"CREATE TABLE IF NOT EXISTS {table} ({listed}) USING parquet{options}{partitioned}"
            f" LOCATION '{location}'"
        )


# -- raw inputs ------------------------------------------------------------------------------
# Column names, order and types of the raw files (CSV columns go by position).

SONG_METADATA = struct("""
    num_songs INT, artist_id STRING, artist_latitude DOUBLE, artist_longitude DOUBLE,
    artist_location STRING, artist_name STRING, song_id STRING, title STRING,
    duration DOUBLE, year INT
""")

PLAY_LOG = struct("""
    artist STRING, auth STRING, firstName STRING, gender STRING, itemInSession INT,
    lastName STRING, length DOUBLE, level STRING, location STRING, method STRING,
    page STRING, registration STRING, sessionId STRING, song STRING, status INT,
    ts DOUBLE, userAgent STRING, userId STRING
""")

# The log exported as CSV lacks the user agent; all its values are read as text.
PLAY_LOG_CSV = struct("""
    artist STRING, auth STRING, firstName STRING, gender STRING, itemInSession STRING,
    lastName STRING, length STRING, level STRING, location STRING, method STRING,
    page STRING, registration STRING, sessionId STRING, song STRING, status STRING,
    ts STRING, userId STRING
""")

DEMOGRAPHICS = struct("""
    city STRING, state STRING, median_age DOUBLE, male_population DOUBLE,
    female_population DOUBLE, total_population INT, number_of_veterans DOUBLE,
    foreign_born DOUBLE, average_household_size DOUBLE, state_code STRING, race STRING,
    count INT
""")

AIRPORTS = struct("""
    ident STRING, type STRING, name STRING, elevation_ft INT, continent STRING,
    iso_country STRING, iso_region STRING, municipality STRING, gps_code STRING,
    iata_code STRING, local_code STRING, coordinates STRING
""")

TEMPERATURES = struct("""
    dt STRING, average_temperature DOUBLE, average_temperature_uncertainty DOUBLE,
    city STRING, country STRING, latitude STRING, longitude STRING
""")

IMMIGRATION = struct("""
    cic_id DOUBLE, i94yr DOUBLE, i94mon DOUBLE, i94cit DOUBLE, i94res DOUBLE,
    i94port STRING, sas_arrdate DOUBLE, i94mode DOUBLE, i94addr STRING, sas_depdate DOUBLE,
    i94bir DOUBLE, i94visa DOUBLE, count DOUBLE, dtadfile STRING, visapost STRING,
    occup STRING, entdepa STRING, entdepd STRING, entdepu STRING, matflag STRING,
    biryear DOUBLE, dtaddto STRING, gender STRING, insnum STRING, airline STRING,
    admnum DOUBLE, fltno STRING, visatype STRING
""")

# Where a staging column is found in a log record.
LOG_PATHS = {
    "artist": "artist",
    "auth": "auth",
    "first_name": "firstName",
    "gender": "gender",
    "item_in_session": "itemInSession",
    "last_name": "lastName",
    "length": "length",
    "level": "level",
    "location": "location",
    "method": "method",
    "page": "page",
    "registration": "registration",
    "session_id": "sessionId",
    "song": "song",
    "status": "status",
    "ts": "ts",
    "user_agent": "userAgent",
    "user_id": "userId",
}

# -- staging and star tables -----------------------------------------------------------------
# Names, types, keys, required columns and text lengths of the tables.

STAGING_EVENTS = TableSpec(
    "staging_events",
    """artist STRING, auth STRING, first_name STRING, gender STRING, item_in_session INT,
    last_name STRING, length DOUBLE, level STRING, location STRING, method STRING,
    page STRING, registration STRING, session_id STRING, song STRING, status INT,
    ts BIGINT, user_agent STRING, user_id STRING""",
    not_null=("session_id", "ts"),
    max_length={
        "artist": 255, "auth": 25, "first_name": 255, "gender": 1, "last_name": 255,
        "level": 15, "location": 255, "method": 5, "page": 25, "registration": 255,
        "session_id": 30, "song": 255, "user_agent": 255,
    },
)

STAGING_SONGS = TableSpec(
    "staging_songs",
    """num_songs INT, artist_id STRING, artist_latitude DOUBLE, artist_longitude DOUBLE,
    artist_location STRING, artist_name STRING, song_id STRING, title STRING,
    duration DOUBLE, year INT""",
    key=("song_id",),
    not_null=("artist_id",),
    max_length={
        "artist_id": 50, "artist_location": 255, "artist_name": 255, "song_id": 30,
        "title": 255,
    },
)

SONGPLAYS = TableSpec(
    "songplays",
    """songplay_id STRING, start_time TIMESTAMP, user_id STRING, level STRING,
    song_id STRING, artist_id STRING, session_id STRING, location STRING,
    user_agent STRING, year INT, month INT""",
    key=("songplay_id",),
    not_null=("songplay_id", "start_time", "user_id", "level", "session_id"),
    max_length={
        "user_id": 30, "level": 15, "song_id": 30, "artist_id": 30, "session_id": 30,
        "location": 255, "user_agent": 255,
    },
    partition_by=("year", "month"),
    compression="zstd",  # halves the ids, which are most of the table
)

USERS = TableSpec(
    "users",
    "user_id STRING, first_name STRING, last_name STRING, gender STRING, level STRING",
    key=("user_id",),
    not_null=("user_id", "first_name", "last_name", "level"),
    max_length={
        "user_id": 30, "first_name": 255, "last_name": 255, "gender": 1, "level": 15,
    },
)

SONGS = TableSpec(
    "songs",
    "song_id STRING, title STRING, duration DOUBLE, year INT, artist_id STRING",
    key=("song_id",),
    not_null=("song_id", "title", "artist_id", "year", "duration"),
    max_length={"song_id": 30, "title": 255, "artist_id": 30},
    partition_by=("year", "artist_id"),
)

ARTISTS = TableSpec(
    "artists",
    "artist_id STRING, name STRING, location STRING, latitude DOUBLE, longitude DOUBLE",
    key=("artist_id",),
    not_null=("artist_id", "name"),
    max_length={"artist_id": 30, "name": 255, "location": 255},
)

TIME = TableSpec(
    "time",
    """start_time TIMESTAMP, hour INT, day INT, week INT, month INT, year INT,
    weekday INT""",
    key=("start_time",),
    not_null=("start_time", "hour", "day", "week", "month", "year", "weekday"),
)

SONG_SESSION = TableSpec(
    "song_session",
    """session_id INT, item_in_session INT, artist_name STRING, song STRING,
    length DOUBLE""",
    key=("session_id", "item_in_session"),
    not_null=("session_id", "item_in_session"),
)

USER_SESSIONS = TableSpec(
    "user_sessions",
    """session_id INT, user_id INT, item_in_session INT, artist_name STRING, song STRING,
    user_first_name STRING, user_last_name STRING""",
    key=("session_id", "user_id", "item_in_session"),
    not_null=("session_id", "user_id", "item_in_session"),
)

USER_LISTENS = TableSpec(
    "user_listens",
    """song STRING, user_id INT, artist_name STRING, user_first_name STRING,
    user_last_name STRING""",
    key=("song", "user_id", "artist_name"),
    not_null=("song", "user_id", "artist_name"),
)

CITY = TableSpec(
    "city",
    """state_code STRING, name STRING, state STRING, median_age DOUBLE,
    male_population DOUBLE, female_population DOUBLE, total_population INT,
    number_of_veterans DOUBLE, foreign_born DOUBLE, average_household_size DOUBLE,
    most_common_race STRING, country STRING, avg_temp DOUBLE, city_id BIGINT""",
    key=("city_id",),
    not_null=("city_id",),
)

IMMIGRATION_TIME = TableSpec(
    "time",
    "time TIMESTAMP, hour INT, day INT, week INT, month INT, year INT, weekday INT",
    key=("time",),
    not_null=("time",),
)

PORT = TableSpec(
    "port",
    """port STRING, name STRING, municipality STRING, country STRING, elevation_ft INT,
    longitude DOUBLE, latitude DOUBLE, continent STRING, type STRING, port_id BIGINT""",
    key=("port_id",),
    not_null=("port_id",),
)

VISA_ISSUER = TableSpec(
    "visa_issuer",
    "name STRING, visa_issuer_id BIGINT",
    key=("visa_issuer_id",),
    not_null=("visa_issuer_id",),
)

ALIEN = TableSpec(
    "alien",
    """admission_id BIGINT, citizenship_origin STRING, residency_origin STRING,
    gender STRING, age BIGINT, visatype STRING, i94visa STRING, entdepa STRING,
    entdepd STRING, matflag STRING, year_of_birth BIGINT""",
    key=("admission_id",),
    not_null=("admission_id",),
)

LOGISTICS = TableSpec(
    "logistics",
    "transport_no STRING, company STRING, mode DOUBLE, transport_id BIGINT",
    key=("transport_id",),
    not_null=("transport_id",),
)

IMMIGRATIONS = TableSpec(
    "immigrations",
    """cic_id DOUBLE, arrival_city BIGINT, expiration_time TIMESTAMP, admission_id BIGINT,
    arrdate TIMESTAMP, depdate TIMESTAMP, transport_id BIGINT, visa_issuer_id BIGINT,
    port_id BIGINT, i94_year INT, i94_month INT""",
    not_null=("cic_id",),
    partition_by=("i94_year", "i94_month"),
)
