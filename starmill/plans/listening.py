"""Listening history: many CSV exports to one clean extract and three tables made for one
question each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.operators import load
from starmill.operators.contracts import BROKEN, admit
from starmill.operators.dims import project
from starmill.operators.reports import lookup_rows
from starmill.schemas import PLAY_LOG_CSV, SONG_SESSION, USER_LISTENS, USER_SESSIONS, TableSpec
from starmill.session import use_utc
from starmill.sources import read_quoted
from starmill.sources.quoted import PLACE

# The columns of the clean extract.
EXTRACT = [
    "artist", "firstName", "gender", "itemInSession", "lastName", "length", "level",
    "location", "sessionId", "song", "userId",
]

# Where the columns of the query tables come from.
ORIGIN = {
    "session_id": "sessionId",
    "user_id": "userId",
    "item_in_session": "itemInSession",
    "artist_name": "artist",
    "user_first_name": "firstName",
    "user_last_name": "lastName",
    "song": "song",
    "length": "length",
}


EXPORTS = TableSpec("exports", ", ".join(f"{c} STRING" for c in EXTRACT))


def scan_history(spark: SparkSession, path: str) -> DataFrame:
    """All records of a folder of exports with their places, and the text of those that do not
    fit the columns. Fields may hold line breaks."""
    records = read_quoted(spark, path, PLAY_LOG_CSV, recursive=True, broken=BROKEN)
    return records.select(*EXTRACT, BROKEN, *PLACE)


def songs_only(records: DataFrame) -> DataFrame:
    return records.filter(F.col("artist").isNotNull() & (F.col("artist") != ""))


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """All exports of a folder, songs only, with the place each record was found at."""
    return songs_only(scan_history(spark, path).drop(BROKEN))


def save_extract(history: DataFrame, path: str, one_file: bool = False) -> None:
    load.save_quoted_csv(history.select(*EXTRACT), path, one_file)


def query_table(history: DataFrame, spec: TableSpec) -> DataFrame:
    """The rows of one query table: a later line replaces an earlier one of the same key."""
    columns = {f.name: ORIGIN[f.name] for f in spec.schema.fields}
    typed = {name: F.col(c).cast(spec.schema[name].dataType) for name, c in columns.items()}
    place = PLACE
    rows = project(history, {**typed, **{c: c for c in place}})
    return load.last_write_wins(rows, spec.key, place).drop(*place)


def save_query_table(history: DataFrame, spec: TableSpec, path: str) -> DataFrame:
    """Save a query table ordered by its key, for lookups that read few files."""
    rows = load.clustered(query_table(history, spec), spec.key)
    rows.write.mode("overwrite").parquet(path)
    return history.sparkSession.read.schema(spec.schema).parquet(path)


def song_at(song_session: DataFrame, session_id: int, item: int) -> DataFrame:
    where = {"session_id": session_id, "item_in_session": item}
    return lookup_rows(song_session, where, ["artist_name", "song", "length"])


def songs_in_session(user_sessions: DataFrame, session_id: int, user_id: int) -> DataFrame:
    where = {"session_id": session_id, "user_id": user_id}
    shown = ["artist_name", "song", "user_first_name", "user_last_name"]
    return lookup_rows(user_sessions, where, shown, order=["item_in_session"])


def listeners_of(user_listens: DataFrame, song: str) -> DataFrame:
    return lookup_rows(user_listens, {"song": song}, ["user_first_name", "user_last_name"])


def build_history(
    spark: SparkSession, path: str, out: str, allowance: int = 0
) -> dict[str, DataFrame]:
    """Exports to the extract and the three query tables under ``out``.

    Records that do not fit their columns are counted as they are staged: more than ``allowance``
    stop the job, fewer are left out and listed as JSON lines under ``out/rejects``.
    """
    use_utc(spark)
    scan = scan_history(spark, path)
    history = songs_only(admit(scan, EXPORTS, PLACE, allowance, f"{out}/rejects"))
    save_extract(history, f"{out}/extract")
    return {
        spec.name: save_query_table(history, spec, f"{out}/{spec.name}")
        for spec in (SONG_SESSION, USER_SESSIONS, USER_LISTENS)
    }
