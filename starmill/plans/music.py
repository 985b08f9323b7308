"""The music star schema: songs, artists, users, time and song plays.

One set of builders serves four ways of loading that differ in how plays find their song, how
repeated dimension rows are settled, and how times are decoded (``StarRules``).
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import partial, reduce
from operator import and_

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from starmill.functions import epoch_millis, epoch_seconds, md5_key, row_key, rounded_decimal
from starmill.operators import load
from starmill.operators.contracts import BROKEN, admit
from starmill.operators.dataset import LEDGER, Dataset, listed, not_taken
from starmill.operators.dims import dimension, project, surrogate_key, time_dim
from starmill.operators.facts import distinct_matches, equi_join, lookup_one, spread_join
from starmill.operators.quality import CheckSpec, enforce, run_checks
from starmill.schemas import (
    ARTISTS,
    LOG_PATHS,
    PLAY_LOG,
    SONG_METADATA,
    SONGPLAYS,
    SONGS,
    STAGING_EVENTS,
    STAGING_SONGS,
    TIME,
    USERS,
    TableSpec,
)
from starmill.session import small_tasks, stage, together, use_utc
from starmill.sources import arrival, read_json, read_json_mapped, render_path, stage_raw

# Fixed value: the page of a log record that is a song play.
PLAY_PAGE = "NextSong"

STAR = (SONGPLAYS, USERS, SONGS, ARTISTS, TIME)


@dataclass(frozen=True)
class StarRules:
    """Where the loads differ.

    match            "track": title, artist and length agree; "artist": only the name does
    how              "left" keeps plays without a song, "inner" drops them
    single_match     at most one song per play (the first by id)
    keep             rows kept per dimension key: "first", "latest", "any" or "distinct"
    whole_seconds    cut play times to seconds
    weekday          numbering of weekdays in the time table
    play_key         "row": digest of the play; "md5": of session and time; "dense": numbers
    distinct_plays   drop repeated plays
    duration_scale   round lengths to this many digits before they are compared
    """

    match: str = "track"
    how: str = "left"
    single_match: bool = False
    keep: str = "first"
    whole_seconds: bool = False
    weekday: str = "sun1"
    play_key: str = "row"
    distinct_plays: bool = False
    duration_scale: int | None = None


LAKE = StarRules(match="artist", how="inner")
WAREHOUSE = StarRules(
    match="artist",
    how="inner",
    keep="distinct",
    whole_seconds=True,
    weekday="sun0",
    distinct_plays=True,
)
SCHEDULED = StarRules(keep="distinct", whole_seconds=True, weekday="sun0", play_key="md5")
RELATIONAL = StarRules(single_match=True, weekday="mon0")


# -- inputs ----------------------------------------------------------------------------------


def read_songs(spark: SparkSession, path: str) -> DataFrame:
    """Song metadata: a tree of folders with JSON lines files; with the place of each line, so
    that the first to arrive can be told."""
    songs = read_json(spark, path, SONG_METADATA, recursive=True, pattern="*.json")
    return songs.select(*SONG_METADATA.names, *arrival())


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The play log under staging names and types."""
    return load.conform(read_json_mapped(spark, path, PLAY_LOG, LOG_PATHS), STAGING_EVENTS)


#: What a lake asks of its raw records: that they can be parsed into the types of the columns.
RAW_EVENTS = replace(STAGING_EVENTS, not_null=(), max_length={})
RAW_SONGS = replace(STAGING_SONGS, not_null=(), max_length={})
PLACE = ("file", "block", "line")


def scan_songs(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Song metadata with the place of each line, and the text of lines that cannot be parsed."""
    songs = read_json(
        spark, path, SONG_METADATA, recursive=True, pattern="*.json", broken=BROKEN
    )
    return songs.select(*SONG_METADATA.names, BROKEN, *arrival())


def scan_log(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The play log under staging names, with each line's file, and the text of lines that
    cannot be parsed."""
    return read_json_mapped(spark, path, PLAY_LOG, LOG_PATHS, broken=BROKEN)


def rejects_at(out: str) -> str:
    """Where a job lists the records it has left out, as JSON lines."""
    return f"{out}/rejects"


def admit_inputs(
    spark: SparkSession,
    song_path: str | list[str],
    log_path: str | list[str],
    out: str,
    allowance: int = 0,
) -> tuple[DataFrame, DataFrame]:
    """Songs and log, each staged by the pass that counts its bad records. More of them than
    ``allowance`` in either stop the job; fewer are left out and listed at ``rejects_at(out)``."""
    rejects = rejects_at(out)
    staged = together(
        spark,
        {
            "songs": partial(
                admit, scan_songs(spark, song_path), RAW_SONGS, PLACE, allowance, rejects
            ),
            "log": partial(admit, scan_log(spark, log_path), RAW_EVENTS, (), allowance, rejects),
        },
    )
    return staged["songs"], staged["log"]


# -- builders --------------------------------------------------------------------------------


def plays_of(log: DataFrame, rules: StarRules = StarRules()) -> DataFrame:
    """The song plays of a log, with their time."""
    decode = epoch_seconds if rules.whole_seconds else epoch_millis
    return log.filter(F.col("page") == PLAY_PAGE).withColumn("start_time", decode("ts"))


def users_of(plays: DataFrame, rules: StarRules = StarRules()) -> DataFrame:
    columns = {f.name: f.name for f in USERS.schema.fields}
    return dimension(plays, columns, USERS.key, rules.keep, order=["ts"])


def songs_of(songs: DataFrame, rules: StarRules = StarRules()) -> DataFrame:
    return dimension(songs, {f.name: f.name for f in SONGS.schema.fields}, SONGS.key, rules.keep)


ARTIST_COLUMNS = {
    "artist_id": "artist_id",
    "name": "artist_name",
    "location": "artist_location",
    "latitude": "artist_latitude",
    "longitude": "artist_longitude",
}


def artists_of(songs: DataFrame, rules: StarRules = StarRules()) -> DataFrame:
    return dimension(songs, ARTIST_COLUMNS, ARTISTS.key, rules.keep)


def times_of(plays: DataFrame, rules: StarRules = StarRules()) -> DataFrame:
    return time_dim(plays, ["start_time"], rules.weekday)


def songplays_of(
    plays: DataFrame, songs: DataFrame, rules: StarRules = StarRules()
) -> DataFrame:
    """The fact table. ``songs`` is song metadata, or songs joined to their artists."""
    if rules.duration_scale is not None:
        plays = plays.withColumn("length", rounded_decimal("length", 18, rules.duration_scale))
        songs = songs.withColumn(
            "duration", rounded_decimal("duration", 18, rules.duration_scale)
        )
    on = {"artist": "artist_name"}
    if rules.match == "track":
        on = {"song": "title", **on, "length": "duration"}
    take = {"song_id": "song_id", "artist_id": "artist_id"}
    columns = [f.name for f in SONGPLAYS.schema.fields if f.name != "songplay_id"]
    # Each play of an artist meets all songs of the artist, so a loved one is split.
    join = spread_join if rules.match == "artist" else equi_join
    if rules.single_match:
        matched = lookup_one(plays, songs, on, take, order=["song_id", "artist_id"])
    elif rules.distinct_plays and rules.how == "inner":
        own = [c for c in columns if c not in {*take, "year", "month"}]
        matched = distinct_matches(plays, songs, on, take, own, join)
    else:
        matched = join(plays, songs, on, take, rules.how)
    rows = matched.withColumns({"year": F.year("start_time"), "month": F.month("start_time")})
    if rules.distinct_plays:
        rows = rows.select(*columns)
        if rules.single_match or rules.how != "inner":
            rows = rows.distinct()
    else:
        rows = rows.select(*columns, "item_in_session")
    if rules.play_key == "dense":
        keyed = surrogate_key(rows, ["start_time", "user_id", "session_id", "song_id"], "id", "dense")
        keyed = keyed.withColumn("songplay_id", F.col("id").cast("string"))
    elif rules.play_key == "md5":
        keyed = rows.withColumn("songplay_id", md5_key("session_id", "start_time"))
    else:
        keyed = rows.withColumn("songplay_id", row_key(*rows.columns))
    return keyed.select("songplay_id", *columns)


def new_plays(known: DataFrame, plays: DataFrame) -> DataFrame:
    """The plays of a batch that the fact table lacks. Equal plays are counted: of one that
    comes twice and is there once, one is new."""
    columns = plays.columns
    here = plays.groupBy(*columns).agg(F.count(F.lit(1)).alias("here"))
    there = (
        known.groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("there"))
        .withColumnsRenamed({c: f"known_{c}" for c in columns})
    )
    equal = [F.col(c).eqNullSafe(F.col(f"known_{c}")) for c in columns]
    more = F.greatest(F.col("here") - F.coalesce("there", F.lit(0)), F.lit(0))
    copies = F.explode(F.array_repeat(F.lit(1), more.cast("int"))).alias("copy")
    return here.join(there, reduce(and_, equal), "left").select(*columns, copies).drop("copy")


def build_star(log: DataFrame, songs: DataFrame, rules: StarRules) -> dict[str, DataFrame]:
    plays = plays_of(log, rules)
    return {
        "songs": songs_of(songs, rules),
        "artists": artists_of(songs, rules),
        "users": users_of(plays, rules),
        "time": times_of(plays, rules),
        "songplays": songplays_of(plays, songs, rules),
    }


# -- jobs ------------------------------------------------------------------------------------


def build_lake(
    spark: SparkSession,
    song_path: str,
    log_path: str,
    out: str,
    rules: StarRules = LAKE,
    partition_by: Mapping[str, Sequence[str]] | None = None,
    allowance: int = 0,
) -> dict[str, DataFrame]:
    """Raw JSON to five parquet tables under ``out``; returns the tables read back.

    ``partition_by`` replaces the partitions of a table: by default songs have a folder per
    year and artist, which for millions of artists is better a folder per year.

    Records that cannot be parsed, and rows that break the contract of their table, are counted
    by the passes that write. More than ``allowance`` of them in an input or a table stop the job
    before any table is replaced; fewer are left out, and those of the inputs listed.
    """
    use_utc(spark)
    chosen = partition_by or {}
    # The text is parsed once; every table reads the columns it needs of the staged copies.
    songs, log = admit_inputs(spark, song_path, log_path, out, allowance)
    star = build_star(log, songs, rules)
    loads = {spec.name: load.Load(star[spec.name], spec) for spec in STAR}
    written = {spec.name: f"{out}/_new/{uuid.uuid4().hex}-{spec.name}" for spec in STAR}

    def save(spec: TableSpec) -> None:
        by = chosen.get(spec.name, spec.partition_by)
        # Plays stay in the tasks that join them: there may be far more than rows read.
        even = spec is not SONGPLAYS
        load.overwrite(loads[spec.name].rows, written[spec.name], by, even, spec.compression)

    together(spark, {spec.name: partial(save, spec) for spec in STAR})
    try:
        load.refuse([(table, allowance) for table in loads.values()])
        load.replace_folders(spark, {f"{out}/{name}": path for name, path in written.items()})
    finally:
        load.remove_folder(spark, f"{out}/_new")
    return {
        spec.name: spark.read.schema(spec.schema).parquet(f"{out}/{spec.name}") for spec in STAR
    }


def stage_inputs(
    spark: SparkSession,
    song_path: str | list[str],
    log_path: str | list[str],
    location: str,
    database: str,
    allowance: int = 0,
) -> None:
    """Reload both staging tables; what they held before goes. Records that break the contract of
    their staging table are counted by the insert; more than ``allowance`` of them stop the load,
    fewer are left out and listed at ``rejects_at(location)``."""
    loads = [
        load.Load(scan_log(spark, log_path), STAGING_EVENTS),
        load.Load(scan_songs(spark, song_path), STAGING_SONGS),
    ]
    together(
        spark,
        {
            ready.spec.name: partial(
                load.load_table, ready.rows, f"{database}.{ready.spec.name}", "overwrite"
            )
            for ready in loads
        },
    )
    load.refuse([(ready, allowance) for ready in loads])
    for ready in loads:
        if ready.lost():
            ready.rejects().write.mode("append").json(rejects_at(location))


def _warehouse_specs() -> list[TableSpec]:
    """Of the catalog tables only the fact, which grows with every run, is partitioned."""
    others = (STAGING_EVENTS, STAGING_SONGS, USERS, SONGS, ARTISTS, TIME)
    return [SONGPLAYS, *[spec.unpartitioned() for spec in others]]


def load_warehouse(
    spark: SparkSession,
    song_path: str,
    log_path: str,
    location: str,
    database: str = "default",
    rules: StarRules = WAREHOUSE,
    allowance: int = 0,
) -> None:
    """Recreate the tables, stage the inputs, and fill each star table by one insert.

    As by a bulk load, more than ``allowance`` bad records in an input stop the job; the star
    tables of the run before are dropped only after that. Rows that break the contract of a star
    table are not inserted; more than ``allowance`` of them are an error.
    """
    use_utc(spark)
    staging = [spec.unpartitioned() for spec in (STAGING_EVENTS, STAGING_SONGS)]
    load.drop_tables(spark, staging, database)
    load.create_tables(spark, staging, location, database)
    stage_inputs(spark, song_path, log_path, location, database, allowance)
    fresh = [spec for spec in _warehouse_specs() if spec not in staging]
    load.drop_tables(spark, fresh, database)
    for spec in fresh:
        load.remove_folder(spark, f"{location}/{spec.name}")
    load.create_tables(spark, fresh, location, database)
    star = build_star(
        spark.table(f"{database}.{STAGING_EVENTS.name}"),
        spark.table(f"{database}.{STAGING_SONGS.name}"),
        rules,
    )

    loads = {spec.name: load.Load(star[spec.name], spec) for spec in STAR}

    def insert(spec: TableSpec) -> None:
        rows = loads[spec.name].rows
        load.insert_columns(rows, f"{database}.{spec.name}", rows.columns)

    together(spark, {spec.name: partial(insert, spec) for spec in STAR})
    load.refuse([(ready, allowance) for ready in loads.values()])


# The columns that the scheduled run requires to be filled.
REQUIRED = {
    "songplays": ("user_id", "songplay_id"),
    "users": ("first_name", "last_name"),
    "songs": ("song_id", "title", "duration"),
    "artists": ("artist_id", "name"),
    "time": ("hour", "day", "week", "month"),
}


#: The fact of runs that are to be taken once: each load has partitions of its own.
SONGPLAYS_BY_LOAD = replace(
    SONGPLAYS, columns=SONGPLAYS.columns + ", load STRING", partition_by=("load", "year", "month")
)


def unloaded(spark: SparkSession, path: str, ledger: Dataset) -> list[Row]:
    """The files of a log, (path, length, modified), that no load in the ledger has taken."""
    files = listed(spark, path, recursive=True)
    return sorted(not_taken(files, ledger.taken()).collect())  # as many as the scan itself lists


def file_rows(spark: SparkSession, files: list[Row]) -> DataFrame:
    return spark.createDataFrame([tuple(f) for f in files], LEDGER)


def run_scheduled(
    spark: SparkSession,
    song_path: str,
    log_path: str,
    location: str,
    database: str = "default",
    rules: StarRules = SCHEDULED,
    fact_mode: str = "append",
    allowance: int = 0,
    **context: object,
) -> DataFrame:
    """One scheduled run: create tables, stage, load the fact, refresh the dimensions, check.

    ``fact_mode="append"`` adds the plays of the run whatever the table holds, so a repeated
    run doubles them; "insert_ignore" adds only plays that are not there; "once" adds the plays
    of those log files that no run has taken before. For that a ledger at ``location/loads`` lists
    the files of every run that has loaded its fact, and the rows of a run lie in partitions named
    after its files: one that died is overwritten when it is repeated.

    More than ``allowance`` bad records in an input, or rows that break the contract of a table,
    stop the run; fewer are left out, those of the inputs listed. Returns the report of the checks,
    after raising if one failed.
    """
    use_utc(spark)
    song_path, log_path = render_path(song_path, **context), render_path(log_path, **context)
    run = (spark, song_path, log_path, location, database, rules, fact_mode, allowance)
    with small_tasks(spark) as shuffled:
        return _run_scheduled(*run, shuffled)


def _run_scheduled(
    spark: SparkSession,
    song_path: str,
    log_path: str,
    location: str,
    database: str,
    rules: StarRules,
    fact_mode: str,
    allowance: int,
    shuffled: Callable[[int], None],
) -> DataFrame:
    once = fact_mode == "once"
    fact_spec = SONGPLAYS_BY_LOAD if once else SONGPLAYS
    load.create_tables(spark, [fact_spec, *_warehouse_specs()[1:]], location, database)
    files, ledger = [], Dataset(spark, f"{location}/loads")
    if once:
        files = unloaded(spark, log_path, ledger)
        if files:
            stage_inputs(spark, song_path, [f.path for f in files], location, database, allowance)
    else:
        stage_inputs(spark, song_path, log_path, location, database, allowance)
    staged_songs = spark.table(f"{database}.{STAGING_SONGS.name}")
    events = spark.table(f"{database}.{STAGING_EVENTS.name}")
    plays = plays_of(events, rules)
    shuffled(events.count() + staged_songs.count() + spark.table(f"{database}.songplays").count())

    if files or not once:
        ready = load.Load(songplays_of(plays, staged_songs, rules), SONGPLAYS)
        facts = ready.rows
        if fact_mode == "insert_ignore":
            # Two plays of a session may share a second, and a play may match two songs, so plays
            # are told apart by all their columns. Year and month follow from the time among them.
            facts = stage(facts, "songplays")
            known = spark.table(f"{database}.songplays")
            known = load.in_touched_partitions(
                known, facts, SONGPLAYS.partition_by, facts.columns
            )
            facts = new_plays(known, facts)
        if once:
            name = hashlib.md5(repr([tuple(f) for f in files]).encode()).hexdigest()
            load.overwrite_partition(facts, f"{database}.songplays", {"load": name})
        else:
            load.load_table(facts, f"{database}.songplays")
        load.refuse([(ready, allowance)])
        if once:
            with ledger.change() as change:
                change.took(file_rows(spark, files))
                change.publish()

    # The time dimension covers every play in the fact table, not just those of this run.
    loaded = spark.table(f"{database}.songplays")
    dims = {
        "users": users_of(plays, rules),
        "songs": songs_of(staged_songs, rules),
        "artists": artists_of(staged_songs, rules),
        "time": time_dim(loaded, ["start_time"], rules.weekday),
    }
    specs = {spec.name: spec for spec in STAR}
    loads = {name: load.Load(df, specs[name]) for name, df in dims.items()}
    together(
        spark,
        {
            name: partial(load.load_table, ready.rows, f"{database}.{name}", "overwrite")
            for name, ready in loads.items()
        },
    )
    load.refuse([(ready, allowance) for ready in loads.values()])

    checks = run_checks(
        {
            name: (spark.table(f"{database}.{name}"), CheckSpec(not_null=columns))
            for name, columns in REQUIRED.items()
        }
    )
    report = stage(checks, "checks")
    enforce(report)
    return report


def load_increment(
    spark: SparkSession,
    songs: DataFrame,
    log: DataFrame,
    out: str,
    rules: StarRules = RELATIONAL,
    allowance: int = 0,
    files: list[Row] | None = None,
) -> dict[str, DataFrame]:
    """Merge a batch of songs and log records into the tables of the dataset ``out``.

    Songs, artists and times already known stay as they are; users take their latest level, for
    which only the buckets of the batch's users are rewritten. Plays are appended. Songs are loaded
    first, since plays are matched against all songs known.

    All five tables change by one commit, with which the input ``files`` enter the ledger, so a
    run that dies changes nothing. More than ``allowance`` rows of a table that break its contract
    refuse the batch; fewer are left out.
    """
    use_utc(spark)
    songs, log = stage_raw(songs, "songs"), stage_raw(log, "log")
    tables = {spec.name: spec.unpartitioned() for spec in STAR}
    data = Dataset(spark, out)
    with data.change() as change:

        def insert_ignore(name: str, incoming: DataFrame, order: Sequence[str]) -> None:
            spec = tables[name]
            known = data.read(name, spec.schema, change.base)
            added = load.new_rows(known, incoming, spec.key, order)
            change.add(name, added, spec, allowance, alone=True)

        # Of a song or artist that comes twice the first to arrive stays, if the batch tells places.
        place = [c for c in PLACE if c in songs.columns]
        places = {c: c for c in place}
        every = {f.name: f.name for f in SONGS.schema.fields}
        insert_ignore("songs", project(songs, every | places), place)
        insert_ignore("artists", project(songs, ARTIST_COLUMNS | places), place)

        plays = plays_of(log, rules)
        insert_ignore("time", times_of(plays, rules), [])
        users = plays.select(*[f.name for f in USERS.schema.fields], "ts")

        def with_levels(known: DataFrame, batch: DataFrame) -> DataFrame:
            return load.upsert(known, batch, USERS.key, ["ts"], ["level"])

        batch = load.with_whole_keys(users, USERS.key)
        change.merge("users", batch, tables["users"], with_levels, allowance=allowance)

        known = equi_join(
            change.read("songs", SONGS.schema),
            change.read("artists", ARTISTS.schema),
            {"artist_id": "artist_id"},
            {"artist_name": "name"},
            "inner",
        )
        facts = songplays_of(plays, known, rules)
        change.add("songplays", facts, tables["songplays"], allowance)
        if files:
            change.took(file_rows(spark, files))
        change.publish()
    data.vacuum()
    return {name: data.read(name, spec.schema) for name, spec in tables.items()}


def run_increment(
    spark: SparkSession,
    song_path: str,
    log_path: str,
    out: str,
    rules: StarRules = RELATIONAL,
    allowance: int = 0,
) -> dict[str, DataFrame]:
    """Merge the files of songs and log that no run has taken yet. A run that finds none changes
    nothing; a run that died before its commit is repeated as if it had not been."""
    use_utc(spark)
    data = Dataset(spark, out)
    songs, log = unloaded(spark, song_path, data), unloaded(spark, log_path, data)
    if not songs and not log:
        tables = {spec.name: spec.unpartitioned() for spec in STAR}
        return {name: data.read(name, spec.schema) for name, spec in tables.items()}

    def scan(scanner, files: list[Row], path: str) -> DataFrame:
        return scanner(spark, [f.path for f in files]) if files else scanner(spark, path).limit(0)

    rejects = rejects_at(out)
    song_rows = admit(scan(scan_songs, songs, song_path), RAW_SONGS, PLACE, allowance, rejects)
    log_rows = admit(scan(scan_log, log, log_path), RAW_EVENTS, (), allowance, rejects)
    return load_increment(spark, song_rows, log_rows, out, rules, allowance, [*songs, *log])
