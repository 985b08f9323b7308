import json
from dataclasses import replace

import pytest
from conftest import rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from starmill.__main__ import main
from starmill.operators import load
from starmill.operators.contracts import Refused
from starmill.operators.dataset import Change, Dataset
from starmill.operators.quality import CheckSpec, check_table
from starmill.plans import exploration, immigration, listening, music
from starmill.schemas import (
    AIRPORTS,
    DEMOGRAPHICS,
    IMMIGRATION,
    STAGING_EVENTS,
    STAGING_SONGS,
    TEMPERATURES,
    TableSpec,
)
from starmill.sources import read_code_tables

# -- music -----------------------------------------------------------------------------------

SONGS = [
    {"num_songs": 1, "artist_id": "AR1", "artist_latitude": 36.16778, "artist_longitude": -86.77836,
     "artist_location": "Nashville, TN.", "artist_name": "Gloriana", "song_id": "SO1",
     "title": "Clementina Santafè", "duration": 153.33832, "year": 0},
    {"num_songs": 1, "artist_id": "AR2", "artist_latitude": None, "artist_longitude": None,
     "artist_location": "", "artist_name": "Elena", "song_id": "SO2", "title": "Setanta matins",
     "duration": 269.58322, "year": 0},
    {"num_songs": 1, "artist_id": "AR2", "artist_latitude": None, "artist_longitude": None,
     "artist_location": "Dubai", "artist_name": "Elena", "song_id": "SO3", "title": "Other",
     "duration": 100.0, "year": 1999},
]


def play(ts, user, level, artist, song, length, page="NextSong", session=9):
    return {
        "artist": artist, "auth": "Logged In", "firstName": f"F{user}", "gender": "F",
        "itemInSession": ts % 100, "lastName": f"L{user}", "length": length, "level": level,
        "location": "Here", "method": "PUT", "page": page, "registration": 1.5e12,
        "sessionId": session, "song": song, "status": 200, "ts": ts, "userAgent": "agent",
        "userId": user,
    }


LOG = [
    play(1541106106796, "8", "free", "Elena", "Setanta matins", 269.58322),
    play(1541106106999, "8", "paid", "Elena", "Setanta matins", 269.6),
    play(1541107053796, "10", "free", "Nobody", "Nothing", 1.0),
    play(1541107493796, "10", "free", None, None, None, page="Home"),
]


@pytest.fixture
def music_files(tmp_path):
    songs, log = tmp_path / "song_data", tmp_path / "log_data"
    log.mkdir()
    for i, song in enumerate(SONGS):
        folder = songs / "A" / "AB"[i % 2] / "C"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{song['song_id']}.json").write_text(json.dumps(song))
    (log / "2018-11-01-events.json").write_text("\n".join(map(json.dumps, LOG)))
    return str(songs), str(log)


def test_lake(spark, music_files, tmp_path):
    tables = music.build_lake(spark, *music_files, str(tmp_path / "out"))
    assert rows(tables["songs"], "song_id", "artist_id", "year") == [
        ("SO1", "AR1", 0), ("SO2", "AR2", 0), ("SO3", "AR2", 1999)
    ]
    assert rows(tables["artists"], "artist_id", "location") == [("AR1", "Nashville, TN."), ("AR2", "")]
    assert rows(tables["users"], "user_id", "level") == [("10", "free"), ("8", "free")]
    assert tables["time"].count() == 3
    # Two plays of an artist with two songs; the third artist is unknown.
    assert rows(tables["songplays"], "user_id", "song_id", "year", "month") == [
        ("8", song, 2018, 11) for song in ("SO2", "SO2", "SO3", "SO3")
    ]
    assert tables["songplays"].select("songplay_id").distinct().count() == 4
    assert (tmp_path / "out/songs/year=1999/artist_id=AR2").is_dir()


def test_lake_with_other_partitions(spark, music_files, tmp_path):
    out = tmp_path / "out"
    coarse = {"songs": ["year"], "songplays": []}
    tables = music.build_lake(spark, *music_files, str(out), partition_by=coarse)
    assert sorted(p.name for p in (out / "songs").glob("year=*/*.parquet")) != []
    assert rows(tables["songs"], "song_id", "artist_id") == [("SO1", "AR1"), ("SO2", "AR2"), ("SO3", "AR2")]
    assert tables["songplays"].filter("year = 2018").count() == 4
    assert list((out / "songplays").glob("*.parquet"))


def read_music(spark, music_files):
    return music.read_log(spark, music_files[1]), music.read_songs(spark, music_files[0])


@pytest.mark.parametrize(
    "rules, plays, users, times",
    [
        (music.WAREHOUSE, 4, 3, 2),
        (music.SCHEDULED, 3, 3, 2),
        (music.RELATIONAL, 3, 2, 3),
        (music.StarRules(duration_scale=0), 3, 2, 3),
        (music.StarRules(play_key="dense"), 3, 2, 3),
    ],
)
def test_rules(spark, music_files, rules, plays, users, times):
    star = music.build_star(*read_music(spark, music_files), rules)
    counts = {name: df.count() for name, df in star.items()}
    assert (counts["songplays"], counts["users"], counts["time"]) == (plays, users, times)


def test_rounded_lengths_may_match(spark, music_files):
    log, songs = read_music(spark, music_files)
    exact = music.songplays_of(music.plays_of(log), songs)
    assert exact.filter("song_id IS NOT NULL").count() == 1
    rules = music.StarRules(duration_scale=0)
    rounded = music.songplays_of(music.plays_of(log), songs, rules)
    assert rounded.filter("song_id IS NOT NULL").count() == 2


def test_weekday_of_the_warehouse(spark, music_files):
    log, _ = read_music(spark, music_files)
    thursday = music.times_of(music.plays_of(log, music.WAREHOUSE), music.WAREHOUSE)
    assert {r.weekday for r in thursday.collect()} == {4}


@pytest.fixture
def database(spark):
    spark.sql("CREATE DATABASE starmill_test")
    yield "starmill_test"
    spark.sql("DROP DATABASE starmill_test CASCADE")


def test_warehouse(spark, music_files, tmp_path, database):
    for _ in range(2):  # tables are dropped and recreated
        location = str(tmp_path / f"wh{_}")
        music.load_warehouse(spark, *music_files, location, database)
    assert spark.table(f"{database}.staging_events").count() == 4
    assert spark.table(f"{database}.songplays").count() == 4
    assert spark.table(f"{database}.users").count() == 3


def test_scheduled_runs(spark, music_files, tmp_path, database):
    songs, log = music_files
    run = (spark, songs, "{root}/log_data", str(tmp_path / "wh"), database)
    root = log.removesuffix("/log_data")
    report = music.run_scheduled(*run, root=root)
    assert report.count() == 18 and report.filter("NOT passed").isEmpty()
    assert spark.table(f"{database}.songplays").count() == 3
    # Both plays of the first second share session and time, so their keys agree.
    music.run_scheduled(*run, fact_mode="insert_ignore", root=root)
    assert spark.table(f"{database}.songplays").count() == 3
    music.run_scheduled(*run, root=root)
    assert spark.table(f"{database}.songplays").count() == 6
    assert spark.table(f"{database}.time").count() == 2
    assert spark.table(f"{database}.songs").count() == 3


def test_scheduled_run_stops_on_a_failed_check(spark, music_files, tmp_path, database):
    (tmp_path / "bad").mkdir()
    record = {**LOG[0], "firstName": None}
    (tmp_path / "bad" / "x.json").write_text(json.dumps(record))
    with pytest.raises(ValueError, match="users: not_null first_name"):
        music.run_scheduled(spark, music_files[0], str(tmp_path / "bad"), str(tmp_path / "wh"), database)


def test_insert_ignore_keeps_plays_that_share_a_second(spark, music_files, tmp_path, database):
    """Two plays of a session 0.8 s apart, one that comes twice, one that matches two songs."""
    plays = [{**LOG[0], "ts": ts, "itemInSession": i} for i, ts in ((1, 1e12), (2, 1e12 + 800))]
    (tmp_path / "fast").mkdir()
    lines = [json.dumps(p) for p in [*plays, plays[0]]]
    (tmp_path / "fast" / "x.json").write_text("\n".join(lines))
    run = (spark, music_files[0], str(tmp_path / "fast"), str(tmp_path / "wh"), database)
    music.run_scheduled(*run, fact_mode="insert_ignore")
    assert spark.table(f"{database}.songplays").count() == 3
    music.run_scheduled(*run, fact_mode="insert_ignore")
    assert spark.table(f"{database}.songplays").count() == 3
    schema = music.SONGPLAYS.schema
    base = spark.table(f"{database}.songplays").select(schema.names)
    twice = base.limit(1).unionByName(base.limit(1).withColumn("song_id", F.lit("other")))
    known = base.limit(0)
    first = music.new_plays(known, twice).unionByName(known)
    assert rows(first) == rows(twice) and music.new_plays(first, twice).isEmpty()


def test_the_first_song_to_arrive_stays(spark, tmp_path):
    folder = tmp_path / "songs"
    folder.mkdir()
    for name, title in (("a", "Zebra"), ("b", "Apple")):
        song = {"song_id": "S", "title": title, "artist_id": "A", "artist_name": title}
        song |= {"year": 0, "duration": 1.0}
        (folder / f"{name}.json").write_text(json.dumps(song))
    out = str(tmp_path / "inc")
    log = spark.createDataFrame([], STAGING_EVENTS.schema)
    songs = music.read_songs(spark, str(folder))
    tables = music.load_increment(spark, songs, log, out)
    assert rows(tables["songs"], "title") == [("Zebra",)]
    assert rows(tables["artists"], "name") == [("Zebra",)]


def test_jobs_set_their_zone(spark, music_files, tmp_path, conf):
    conf(spark__sql__session__timeZone="America/New_York")
    music.build_lake(spark, *music_files, str(tmp_path / "lake"))
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_increments(spark, music_files, tmp_path):
    log, songs = read_music(spark, music_files)
    out = str(tmp_path / "inc")
    music.load_increment(spark, songs.filter("song_id <> 'SO2'"), log.filter("user_id = '10'"), out)
    tables = music.load_increment(spark, songs, log.filter("user_id = '8'"), out)
    assert rows(tables["users"], "user_id", "level") == [("10", "free"), ("8", "paid")]
    assert tables["songs"].count() == 3
    # The artist came with its second song first, and stays as it came.
    assert rows(tables["artists"], "artist_id", "location") == [("AR1", "Nashville, TN."), ("AR2", "Dubai")]
    assert rows(tables["songplays"], "user_id", "song_id") == [("10", None), ("8", None), ("8", "SO2")]
    before = {name: df.count() for name, df in tables.items()}
    again = music.load_increment(spark, songs, log.limit(0), out)
    assert {name: df.count() for name, df in again.items()} == before


# -- bad input -------------------------------------------------------------------------------


BROKEN_LINE = '{"page": "NextSong", "ts": 15411'


@pytest.fixture
def bad_files(music_files):
    """A log with one line that is cut off, and one with a time that is no number."""
    songs, log = music_files
    wrong = json.dumps({**LOG[0], "ts": "soon"})
    with open(f"{log}/2018-11-02-events.json", "w") as f:
        f.write("\n".join([json.dumps(LOG[1]), BROKEN_LINE, wrong]))
    return songs, log


def listed_rejects(spark, out):
    found = spark.read.json(music.rejects_at(out)).collect()
    return sorted((r.table_name, r.file.split("/")[-1], *r.reasons, r.record[:20]) for r in found)


WANT = [("staging_events", "2018-11-02-events.json", "broken", text[:20]) for text in
        sorted([BROKEN_LINE, json.dumps({**LOG[0], "ts": "soon"})])]


def test_a_lake_stops_on_bad_lines(spark, music_files, bad_files, tmp_path):
    out = str(tmp_path / "out")
    music.build_lake(spark, *bad_files, out, allowance=2)
    assert listed_rejects(spark, out) == sorted(WANT)
    before = rows(spark.read.parquet(f"{out}/users"))
    with pytest.raises(Refused, match=r"(?s)staging_events: broken \(2 of 7 rows\).*11-02-events.json: broken"):
        music.build_lake(spark, *bad_files, out, allowance=1)
    assert rows(spark.read.parquet(f"{out}/users")) == before
    assert not (tmp_path / "out/_new").exists()


def test_a_lake_stops_on_rows_that_break_a_contract(spark, music_files, tmp_path):
    songs, log = music_files
    out = str(tmp_path / "out")
    music.build_lake(spark, songs, log, out)
    with open(f"{log}/x.json", "w") as f:
        f.write(json.dumps({**LOG[0], "userId": "77", "firstName": None}))
    with pytest.raises(Refused, match=r"users: not_null first_name \(1 of 3 rows\)"):
        music.build_lake(spark, songs, log, out)
    tables = music.build_lake(spark, songs, log, out, allowance=1)
    assert rows(tables["users"], "user_id") == [("10",), ("8",)]


def test_a_bulk_load_stops_on_bad_records(spark, music_files, bad_files, tmp_path, database):
    songs, log = music_files
    run = (spark, songs, log, str(tmp_path / "wh"), database)
    music.load_warehouse(*run, allowance=2)
    assert listed_rejects(spark, str(tmp_path / "wh")) == sorted(WANT)
    before = rows(spark.table(f"{database}.users"))
    with open(f"{log}/y.json", "w") as f:
        f.write(json.dumps({**LOG[0], "gender": "female", "sessionId": None}))
    with pytest.raises(Refused, match="max_length gender") as refused:
        music.load_warehouse(*run, allowance=2)
    assert "not_null session_id" in str(refused.value)
    assert rows(spark.table(f"{database}.users")) == before


def test_files_of_a_scheduled_run_are_taken_once(
    spark, music_files, tmp_path, database, monkeypatch
):
    songs, log = music_files
    run = (spark, songs, log, str(tmp_path / "wh"), database)
    plays = lambda: spark.table(f"{database}.songplays").count()
    # A run that dies after the insert and before its files are in the ledger.
    with monkeypatch.context() as m:
        m.setattr(Change, "publish", lambda self: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            music.run_scheduled(*run, fact_mode="once")
    assert plays() == 3
    for _ in range(2):
        music.run_scheduled(*run, fact_mode="once")
        assert plays() == 3
    with open(f"{log}/late.json", "w") as f:
        f.write(json.dumps(play(1541207053796, "11", "free", "Nobody", "Nothing", 1.0)))
    music.run_scheduled(*run, fact_mode="once")
    assert plays() == 4 and spark.table(f"{database}.time").count() == 3
    assert rows(spark.table(f"{database}.users"), "user_id") == [("11",)]  # as staged last


def test_increments_take_files_once(spark, music_files, tmp_path, monkeypatch):
    songs, log = music_files
    out = str(tmp_path / "inc")
    with monkeypatch.context() as m:
        m.setattr(Change, "publish", lambda self: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            music.run_increment(spark, songs, log, out)
    assert Dataset(spark, out).read("songs", music.SONGS.schema).isEmpty()
    for _ in range(2):
        tables = music.run_increment(spark, songs, log, out)
        assert rows(tables["songplays"], "user_id") == [("10",), ("8",), ("8",)]
    with open(f"{log}/late.json", "w") as f:
        f.write(json.dumps(play(1541207053796, "8", "gone", "Elena", "Other", 100.0)))
    tables = music.run_increment(spark, songs, log, out)
    assert rows(tables["songplays"], "user_id", "song_id")[-1] == ("8", "SO3")
    assert rows(tables["users"], "user_id", "level") == [("10", "free"), ("8", "gone")]
    assert Dataset(spark, out).numbers() == [1, 2]


def test_increments_count_bad_lines(spark, music_files, bad_files, tmp_path):
    out = str(tmp_path / "inc")
    with pytest.raises(Refused, match="broken"):
        music.run_increment(spark, *bad_files, out)
    tables = music.run_increment(spark, *bad_files, out, allowance=2)
    assert tables["songplays"].count() == 4
    assert listed_rejects(spark, out) == sorted(WANT)


# -- table contracts -------------------------------------------------------------------------


def test_staging_contracts(spark, music_files):
    log, songs = read_music(spark, music_files)
    assert log.columns == STAGING_EVENTS.schema.names
    report = check_table("log", log, CheckSpec.of(STAGING_EVENTS))
    assert report.filter("NOT passed").isEmpty()
    assert check_table("songs", songs, CheckSpec.of(STAGING_SONGS)).filter("NOT passed").isEmpty()


def test_long_texts_are_refused(spark, tmp_path, database):
    spec = TableSpec("short", "name STRING, n INT", max_length={"name": 3})
    load.create_tables(spark, [spec], str(tmp_path), database)
    load.load_table(spark.createDataFrame([("abc", 1)], "name string, n int"), f"{database}.short")
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
        load.load_table(spark.createDataFrame([("abcd", 1)], "name string, n int"), f"{database}.short")
    assert rows(spark.table(f"{database}.short")) == [("abc", 1)]


def test_reports_refuse_an_existing_target(spark, tmp_path):
    path = str(tmp_path / "report")
    load.save_report(spark.range(1), path)
    with pytest.raises(AnalysisException):
        load.save_report(spark.range(1), path)


# -- listening history -----------------------------------------------------------------------

HEADER = (
    "artist,auth,firstName,gender,itemInSession,lastName,length,level,location,method,page,"
    "registration,sessionId,song,status,ts,userId"
)
DAYS = {
    "2018-11-05": [
        "Down To The Bone,Logged In,Sylvie,F,0,Cruz,333.76608,free,\"Washington, DC\",PUT,NextSong,1.5E+12,182,Keep On Keepin' On,200,1.54111E+12,10",
        "Three Drives,Logged In,Sylvie,F,1,Cruz,411.6371,free,\"Washington, DC\",PUT,NextSong,1.5E+12,182,Greece 2000,200,1.54111E+12,10",
        ",Logged In,Sylvie,F,5,Cruz,,free,\"Washington, DC\",GET,Home,1.5E+12,182,,200,1.54111E+12,10",
    ],
    "2018-11-06": [
        "Faithless,Logged In,Matthew,M,4,Jones,495.3073,paid,\"Janesville, WI\",PUT,NextSong,1.5E+12,338,Music Matters (Mark Knight Dub),200,1.54111E+12,50",
        "Sebastien Tellier,Logged In,Sylvie,F,2,Cruz,377.73016,free,\"Washington, DC\",PUT,NextSong,1.5E+12,182,Kilometer,200,1.54111E+12,10",
        "Faithless,Logged In,Matt,M,9,Jones,495.3073,paid,\"Janesville, WI\",PUT,NextSong,1.5E+12,338,Music Matters (Mark Knight Dub),200,1.54111E+12,50",
    ],
}


@pytest.fixture
def exports(tmp_path):
    folder = tmp_path / "event_data"
    folder.mkdir()
    for day, lines in DAYS.items():
        (folder / f"{day}-events.csv").write_text("\n".join([HEADER, *lines]) + "\n")
    return str(folder)


def test_history(spark, exports, tmp_path):
    tables = listening.build_history(spark, exports, str(tmp_path / "out"))
    song = listening.song_at(tables["song_session"], 338, 4)
    assert rows(song) == [("Faithless", "Music Matters (Mark Knight Dub)", 495.3073)]
    session = listening.songs_in_session(tables["user_sessions"], 182, 10).collect()
    assert [tuple(r) for r in session] == [
        ("Down To The Bone", "Keep On Keepin' On", "Sylvie", "Cruz"),
        ("Three Drives", "Greece 2000", "Sylvie", "Cruz"),
        ("Sebastien Tellier", "Kilometer", "Sylvie", "Cruz"),
    ]
    # The same song twice by one user is one row, as written last.
    listeners = listening.listeners_of(tables["user_listens"], "Music Matters (Mark Knight Dub)")
    assert rows(listeners) == [("Matt", "Jones")]


def test_extract_is_quoted(spark, exports, tmp_path):
    out = tmp_path / "extract"
    listening.save_extract(listening.read_history(spark, exports), str(out), one_file=True)
    (part,) = out.glob("part-*")
    lines = part.read_text().splitlines()
    assert len(lines) == 6
    assert lines[0] == ",".join(f'"{c}"' for c in listening.EXTRACT)
    assert all(line.startswith('"') and line.endswith('"') for line in lines)


# -- immigration -----------------------------------------------------------------------------

CODES = (
    "/* I94CIT & I94RES - countries */\n 115 = 'ICELAND'\n 582 = 'MEXICO'\n"
    "/* I94PORT - ports */\n 'MIA' = 'MIAMI, FL'\n 'NYC' = 'NEW YORK, NY'\n"
    "/* I94VISA - visas\n 2 = Pleasure\n*/\n"
)


def person(cic, cit, port, arrived, admnum, **other):
    values = dict.fromkeys(IMMIGRATION.names)
    values |= {
        "cic_id": cic, "i94yr": 2016.0, "i94mon": 4.0, "i94cit": cit, "i94res": 999.0,
        "i94port": port, "sas_arrdate": arrived, "i94mode": 1.0, "i94visa": 2.0, "count": 1.0,
        "i94bir": 30.0, "biryear": 1986.0, "dtaddto": "09302016", "admnum": admnum, **other,
    }
    return tuple(values[c] for c in IMMIGRATION.names)


@pytest.fixture
def inputs(spark, tmp_path):
    path = tmp_path / "codes.txt"
    path.write_text(CODES)
    people = [
        person(1.0, 115.0, "MIA", 20573.0, 11.0, sas_depdate=20580.0, fltno="FI689", airline="FI", visapost="RKV"),
        person(2.0, 115.0, "MIA", 20574.0, 11.0, dtaddto="D/S", airline="FI"),
        person(3.0, 582.0, "NYC", 20573.0, 12.0, visapost="MEX"),
        person(4.0, 582.0, "QQQ", 20573.0, 13.0, visapost="MEX"),
        person(5.0, 582.0, "MIA", 20573.0, None),
    ]
    cities = [
        ("Miami", "Florida", 40.0, 1.0, None, 10, 5.0, 2.0, 2.5, "FL", race, n)
        for race, n in (("White", 7), ("Asian", 7), ("Other", 1), ("Other", 1))
    ]
    warmth = [
        ("2013-08-01", 30.0, 0.1, "Miami", "United States", "1N", "1W"),
        ("2013-09-01", 20.0, 0.1, "Miami", "United States", "1N", "1W"),
        ("2013-09-01", None, 0.1, "Miami", "United States", "1N", "1W"),
        ("2012-09-01", -5.0, 0.1, "Miami", "Canada", "1N", "1W"),
    ]
    airport = lambda i, country, code: (
        i, "large_airport", f"Airport {i}", 8, None, country, None, "Town", None, None, code, "-80.25, 25.5"
    )
    airports = [airport("a", "US", "MIA"), airport("b", "US", "MIA"), airport("c", "US", None), airport("d", "IS", "NYC")]
    return immigration.Inputs(
        spark.createDataFrame(people, IMMIGRATION),
        spark.createDataFrame(cities, DEMOGRAPHICS),
        spark.createDataFrame(warmth, TEMPERATURES),
        spark.createDataFrame(airports, AIRPORTS),
        read_code_tables(spark, str(path)),
    )


def test_immigration(spark, inputs, tmp_path):
    tables = immigration.build_immigration(spark, inputs, str(tmp_path / "out"))
    assert rows(tables["city"], "state_code", "name", "state", "most_common_race", "female_population", "avg_temp") == [
        ("", "No PORT Code", None, None, None, None),
        ("FL", "MIAMI", "Florida", "Asian", 0.0, 25.0),
        ("NY", "NEW YORK", None, None, None, None),
    ]
    assert rows(tables["port"], "port", "longitude", "latitude", "continent") == [
        (None, -80.25, 25.5, "NA"), ("MIA", -80.25, 25.5, "NA"), ("MIA", -80.25, 25.5, "NA")
    ]
    assert rows(tables["visa_issuer"], "name") == [(None,), ("MEX",), ("RKV",)]
    assert rows(tables["logistics"], "transport_no", "company") == [("FI689", "FI"), ("no1.0", None), ("noFI1.0", "FI")]
    assert rows(tables["alien"], "admission_id", "citizenship_origin", "residency_origin", "i94visa", "age") == [
        (11, "ICELAND", "No Country Code", "Pleasure", 30),
        (12, "MEXICO", "No Country Code", "Pleasure", 30),
        (13, "MEXICO", "No Country Code", "Pleasure", 30),
    ]
    assert rows(tables["time"].selectExpr("cast(time AS date) AS d", "weekday")) == sorted(
        rows(spark.sql("""
            SELECT d, dayofweek(d) FROM VALUES (date '2016-04-29'), (date '2016-04-30'),
            (date '2016-05-06'), (date '2016-09-30') AS t(d)
        """))
    )
    facts = tables["immigrations"]
    assert facts.count() == 4  # one per record with an admission number
    assert facts.filter("port_id IS NULL").count() == 2
    assert facts.filter("visa_issuer_id IS NULL").count() == 1
    assert facts.filter("arrival_city IS NULL").isEmpty()
    assert list((tmp_path / "out/immigrations").glob("*/i94_year=2016/i94_month=4"))

    top = immigration.top_arrival_states(facts, tables["city"], 10)
    assert [tuple(r) for r in top.collect()] == [("Florida", 2)]
    months = immigration.arrivals_per_month(facts, tables["time"])
    assert [tuple(r) for r in months.collect()] == [(4, 4)]
    theirs = immigration.arrivals_per_month_from(facts, tables["time"], tables["alien"])
    assert [tuple(r) for r in theirs.collect()] == [(4, 2)]
    immigration.save_reports(tables, str(tmp_path / "reports"))
    (part,) = (tmp_path / "reports/icelander_per_month").glob("part-*")
    assert part.read_text() == "month,count\n4,2\n"


def test_keys_of_the_fact_are_keys_of_the_dimensions(spark, inputs, tmp_path):
    tables = immigration.build_immigration(spark, inputs, str(tmp_path / "out"))
    for name, key, column in (
        ("city", "city_id", "arrival_city"),
        ("port", "port_id", "port_id"),
        ("visa_issuer", "visa_issuer_id", "visa_issuer_id"),
        ("logistics", "transport_id", "transport_id"),
        ("alien", "admission_id", "admission_id"),
        ("time", "time", "arrdate"),
    ):
        used = tables["immigrations"].select(F.col(column).alias(key)).na.drop()
        assert used.join(tables[name], key, "left_anti").isEmpty(), name


def test_keys_do_not_change_between_runs(spark, inputs, tmp_path):
    first = immigration.build_immigration(spark, inputs, str(tmp_path / "one"))
    second = immigration.build_immigration(spark, inputs, str(tmp_path / "two"))
    for name in ("city", "port", "visa_issuer", "logistics", "immigrations"):
        assert rows(first[name]) == rows(second[name])


def test_seven_tables_are_published_as_one(spark, inputs, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    immigration.build_immigration(spark, inputs, out)
    before = {n: rows(df) for n, df in immigration.read_star(spark, out).items()}
    fewer = replace(inputs, immigration=inputs.immigration.limit(1))
    with monkeypatch.context() as m:
        m.setattr(Change, "publish", lambda self: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            immigration.build_immigration(spark, fewer, out)
    assert {n: rows(df) for n, df in immigration.read_star(spark, out).items()} == before
    reading = immigration.read_star(spark, out)
    immigration.build_immigration(spark, fewer, out)
    assert {n: rows(df) for n, df in reading.items()} == before
    assert immigration.read_star(spark, out)["immigrations"].count() <= 1


def test_months_of_immigration(spark, inputs, tmp_path):
    inputs.immigration.write.parquet(str(tmp_path / "sas/i94_apr16"))
    inputs.immigration.limit(1).write.parquet(str(tmp_path / "sas/i94_may16"))
    folder = str(tmp_path / "sas")
    assert immigration.read_immigration(spark, folder).count() == 6
    april = immigration.read_immigration(spark, folder, month_file="i94_{month}16", month="apr")
    assert april.count() == 5


def test_exploration(spark, inputs):
    report = exploration.explore(
        inputs.demographics, inputs.airports, inputs.temperatures, inputs.immigration, year=2013
    )
    assert rows(report["temperatures by year"]) == [(3, 3, 3, 2013)]
    assert rows(report["airports by continent"]) == [(3, 3, 0)]
    assert rows(report["arrivals at a known airport"]) == [(4, 5, 0.8)]
    assert rows(report["demographics with nulls"], "race") == [("Asian",), ("Other",), ("Other",), ("White",)]
    assert rows(report["people counted per city"], "city", "count") == [("Miami", 16)]
    assert set(rows(report["figures that vary within a city"])[0]) == {0.0, None}
    ports = report["profile of immigration"].filter("column_name = 'i94port' AND position = 1")
    assert rows(ports, "value", "frequency", "distinct_values") == [("MIA", 3, 3)]


# -- command line ----------------------------------------------------------------------------


def test_music_jobs_from_the_command_line(spark, music_files, tmp_path, database):
    songs, log = music_files
    paths = ["--songs", songs, "--log", log]
    main(["lake", *paths, "--out", str(tmp_path / "lake")])
    assert spark.read.parquet(str(tmp_path / "lake/songs")).count() == 3
    main(["increment", *paths, "--out", str(tmp_path / "inc")])
    plays = Dataset(spark, str(tmp_path / "inc")).read("songplays", music.SONGPLAYS.schema)
    assert plays.count() == 3
    templated = ["--songs", songs, "--log", log.replace("log_data", "{kind}_data")]
    out = ["--out", str(tmp_path / "wh"), "--database", database]
    main(["scheduled", *templated, *out, "--context", "kind=log"])
    assert spark.table(f"{database}.songplays").count() == 3
    main(["warehouse", *paths, "--out", str(tmp_path / "wh2"), "--database", database])
    assert spark.table(f"{database}.songplays").count() == 4


def test_history_from_the_command_line(spark, exports, tmp_path):
    main(["history", "--exports", exports, "--out", str(tmp_path / "out")])
    assert spark.read.parquet(str(tmp_path / "out/song_session")).count() == 5


def test_immigration_from_the_command_line(spark, inputs, tmp_path):
    inputs.immigration.write.option("header", True).csv(str(tmp_path / "sas/apr"))
    inputs.demographics.write.options(header=True, sep=";").csv(str(tmp_path / "cities"))
    inputs.temperatures.write.options(header=True).csv(str(tmp_path / "warmth"))
    inputs.airports.write.options(header=True).csv(str(tmp_path / "airports"))
    raw = [
        "--records", str(tmp_path / "sas"), "--month-file", "apr",
        "--format", "csv", "--option", "header=true",
        "--demographics", str(tmp_path / "cities"), "--temperatures", str(tmp_path / "warmth"),
        "--airports", str(tmp_path / "airports"), "--codes", str(tmp_path / "codes.txt"),
    ]
    out, reports = str(tmp_path / "star"), str(tmp_path / "reports")
    main(["immigration", *raw, "--out", out, "--reports", reports])
    arrivals = Dataset(spark, out).read("immigrations", immigration.IMMIGRATIONS.schema)
    assert arrivals.count() == 4
    (part,) = (tmp_path / "reports/most_common_arrival_state").glob("part-*")
    assert part.read_text() == "state,count\nFlorida,2\n"
    main(["explore", *raw, "--out", str(tmp_path / "explored")])
    found = spark.read.json(str(tmp_path / "explored/arrivals_at_a_known_airport"))
    assert rows(found, "matched", "total") == [(4, 5)]


def test_a_scheduled_run_has_small_tasks(spark, music_files, tmp_path, monkeypatch):
    """Its rows compress well, so tasks of the planner's size hold millions of them."""
    seen = {}
    stage = music.stage_inputs

    def staged(*args):
        seen["bytes"] = int(spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes"))
        return stage(*args)

    monkeypatch.setattr(music, "stage_inputs", staged)
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", None)
    spark.sql("CREATE DATABASE small_tasks")
    try:
        music.run_scheduled(spark, *music_files, str(tmp_path / "wh"), "small_tasks")
    finally:
        spark.sql("DROP DATABASE small_tasks CASCADE")
    assert seen["bytes"] <= 16 << 20
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", None) == before
