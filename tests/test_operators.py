import random

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starmill.operators import load
from starmill.operators.dims import (
    argmax_by_group,
    dimension,
    distinct_union,
    surrogate_key,
    time_dim,
)
from starmill.operators.facts import (
    DimJoin,
    distinct_matches,
    equi_join,
    fact,
    hot_keys,
    lookup_one,
    spread_join,
    with_labels,
)
from starmill.operators.keyed import (
    carry_down,
    first_per_key,
    first_ranked,
    last_per_key,
    with_group_count,
)
from starmill.operators.nulls import drop_nulls, rows_with_nulls
from starmill.operators.profile import (
    column_profile,
    column_stats,
    greatest_deviation,
    group_sum,
)
from starmill.operators.quality import CheckSpec, check_table, coverage, enforce, null_report, run_checks
from starmill.operators.reports import count_by_dim, top_n_by_dim
from starmill.schemas import TableSpec

SPARK_TESTS = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


# -- one row per key -------------------------------------------------------------------------


def test_first_and_last_per_key(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "y"), ("a", 1, "w"), (None, 5, "n"), ("b", None, "q"), ("b", 3, "p")],
        "k string, seq int, v string",
    )
    assert rows(first_per_key(df, ["k"], ["seq"])) == [(None, 5, "n"), ("a", 1, "w"), ("b", None, "q")]
    assert rows(last_per_key(df, ["k"], ["seq"])) == [(None, 5, "n"), ("a", 2, "y"), ("b", 3, "p")]


def test_first_per_key_is_cut_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = lambda d: d._jdf.queryExecution().executedPlan().toString()
    assert "partial_min(struct(id" in plan(first_per_key(df, ["k"], ["id"]))
    assert "row_number(), 1, Partial" in plan(first_ranked(df, ["k"], [F.col("id").desc()]))


def test_first_ranked_agrees_with_first_per_key(spark):
    df = spark.createDataFrame(
        [(i % 7, None if i % 5 == 0 else i % 3, i) for i in range(60)], "k int, a int, b int"
    )
    order = [F.col("a"), F.col("b")]
    assert rows(first_ranked(df, ["k"], order)) == rows(first_per_key(df, ["k"], ["a", "b"]))
    backwards = [c.desc() for c in order]
    assert rows(first_ranked(df, ["k"], backwards)) == rows(last_per_key(df, ["k"], ["a", "b"]))


def test_key_only_rows(spark):
    df = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert rows(first_per_key(df, ["k"])) == [(None,), (1,)]


def test_group_count(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "k string")
    assert rows(with_group_count(df, "k")) == [(None, 0), ("a", 2), ("a", 2), ("b", 1)]


@pytest.mark.parametrize("seed", range(3))
def test_carry_down_across_chunks(spark, seed):
    rng = random.Random(seed)
    lines = [
        (g, c, i, f"{g}{c}{i}" if rng.random() < 0.15 else None)
        for g in "xy"
        for c in range(6)
        for i in range(rng.randint(1, 5))
    ]
    want, current = [], {}
    for g, c, i, v in lines:
        current[g] = v or current.get(g)
        want.append((g, c, i, current[g]))
    df = spark.createDataFrame(lines, "g string, c int, i int, v string").repartition(3)
    got = carry_down(df, "v", "under", ["g"], "c", ["i"])
    assert rows(got, "g", "c", "i", "under") == sorted(want)


# -- dimensions ------------------------------------------------------------------------------


def test_dimension_policies(spark):
    log = spark.createDataFrame(
        [(1, "7", "free"), (2, "7", "paid"), (3, "8", "free"), (4, "8", "free")],
        "ts int, userId string, level string",
    )
    columns = {"user_id": "userId", "level": "level"}
    by = lambda keep: rows(dimension(log, columns, ["user_id"], keep, ["ts"]))
    assert by("first") == [("7", "free"), ("8", "free")]
    assert by("latest") == [("7", "paid"), ("8", "free")]
    assert by("distinct") == [("7", "free"), ("7", "paid"), ("8", "free")]
    assert [r[0] for r in by("any")] == ["7", "8"]


def test_argmax_keeps_or_breaks_ties(spark):
    df = spark.createDataFrame(
        [("x", "b", 5), ("x", "a", 5), ("x", "c", 1), ("y", "c", 2)], "city string, race string, n int"
    )
    assert rows(argmax_by_group(df, ["city"], "n")) == [("x", "a", 5), ("x", "b", 5), ("y", "c", 2)]
    assert rows(argmax_by_group(df, ["city"], "n", "one")) == [("x", "a", 5), ("y", "c", 2)]


def test_time_dim_roles(spark):
    df = spark.sql("""
        SELECT timestamp '2016-04-29 00:00:00' AS a, timestamp '2014-12-31 23:00:00' AS b
        UNION ALL SELECT NULL, timestamp '2016-04-29 00:00:00'
    """)
    since = F.lit("2015-01-01").cast("timestamp")
    got = time_dim(df, ["a", "b"], since=since)
    assert [r[1:] for r in rows(got)] == [(0, 29, 17, 4, 2016, 6)]
    assert time_dim(df, ["a", "b"]).count() == 2
    assert time_dim(df, ["b"], distinct=False).count() == 2


def test_distinct_union_is_set_union(spark):
    a = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "x int, y string")
    b = spark.createDataFrame([("b", 2), ("c", 3)], "y string, x int")
    assert rows(distinct_union(a, b)) == [(1, "a"), (2, "b"), (3, "c")]


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_dense_keys_number_all_rows_in_key_order(spark, conf, parts):
    conf(spark__sql__shuffle__partitions=str(parts))
    words = [(f"w{random.Random(i).randint(0, 10**6)}", i % 5) for i in range(200)]
    df = spark.createDataFrame(words, "w string, n int").distinct()
    got = rows(surrogate_key(df, ["w", "n"], "id", "dense"), "id", "w", "n")
    assert [g[0] for g in got] == list(range(len(got)))
    assert [g[1:] for g in got] == sorted(g[1:] for g in got)


def test_hash_keys_do_not_depend_on_layout(spark):
    df = spark.range(500).select(F.col("id").cast("string").alias("k"))
    a = rows(surrogate_key(df, ["k"], "id"))
    assert a == rows(surrogate_key(df.repartition(7), ["k"], "id"))
    assert len({r[1] for r in a}) == 500
    with pytest.raises(ValueError):
        surrogate_key(df, ["k"], "id", "other")


# -- facts -----------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def plays(spark):
    return spark.createDataFrame(
        [(1, "s", "a"), (2, "s", "a"), (3, "t", None), (4, "u", "z")], "id int, song string, artist string"
    )


@pytest.fixture(scope="module")
def songs(spark):
    return spark.createDataFrame(
        [("S2", "s", "a"), ("S1", "s", "a"), ("S3", "t", None), ("S4", "v", "a")],
        "song_id string, title string, name string",
    )


def test_joins(plays, songs):
    on, take = {"artist": "name"}, {"song_id": "song_id"}
    assert len(rows(equi_join(plays, songs, on, take, "inner"))) == 6
    assert len(rows(equi_join(plays, songs, on, take))) == 8
    assert [r[0] for r in rows(equi_join(plays, songs, on, {}, "left_anti"))] == [3, 4]
    assert [r[0] for r in rows(equi_join(plays, songs, on, {}, "left_semi"))] == [1, 2]
    null_safe = equi_join(plays, songs, on, take, null_safe=True).filter("id = 3")
    assert [r.song_id for r in null_safe.collect()] == ["S3"]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salting_changes_nothing(plays, songs, how):
    on, take = {"artist": "name"}, {"song_id": "song_id"}
    plain = equi_join(plays, songs, on, take, how)
    assert rows(plain) == rows(equi_join(plays, songs, on, take, how, salt=5))


def test_salting_refuses_outer_joins(plays, songs):
    with pytest.raises(ValueError):
        equi_join(plays, songs, {"artist": "name"}, {}, "full_outer", salt=2)


def test_lookup_one_keeps_each_row_once(plays, songs):
    found = lookup_one(
        plays, songs, {"song": "title", "artist": "name"}, {"song_id": "song_id"}, ["song_id"]
    )
    assert [(r[0], r[3]) for r in rows(found)] == [(1, "S1"), (2, "S1"), (3, None), (4, None)]


def test_fact_refuses_repeated_dimension_keys(plays, songs):
    join = DimJoin(songs, {"song": "title", "artist": "name"}, {"song_id": "song_id"})
    with pytest.raises(ValueError, match="title, name"):
        fact(plays, [join], verify=True)
    unique = first_per_key(songs, ["title", "name"])
    checked = fact(plays, [DimJoin(unique, join.on, join.take)], verify=True)
    assert checked.count() == plays.count()


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("parts", [2, 5, 40])
def test_spreading_changes_nothing(plays, songs, how, parts):
    on, take = {"artist": "name"}, {"song_id": "song_id"}
    plain = equi_join(plays, songs, on, take, how)
    spread = spread_join(plays, songs, on, take, how, parts)
    assert spread.columns == plain.columns and rows(spread) == rows(plain)
    assert hot_keys(plays, songs, on, parts).count() == (0 if parts == 1 else 1)
    with pytest.raises(ValueError):
        spread_join(plays, songs, on, take, "full_outer")


def test_rows_of_a_hot_artist_are_spread(spark, conf):
    """An artist with a third of all plays and 40 songs, whose joined rows are most of all."""
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__enabled="false",
        spark__sql__shuffle__partitions="16",
    )
    plays = spark.range(6000).selectExpr("id", "if(id % 3 = 0, 'hot', concat('a', id % 500)) artist")
    songs = spark.range(40).selectExpr("concat('h', id) song", "'hot' name").unionByName(
        spark.range(500).selectExpr("concat('s', id) song", "concat('a', id) name")
    )
    on, take = {"artist": "name"}, {"song": "song"}
    hot = hot_keys(plays, songs, on, 32).collect()
    assert [(r[0], r[1]) for r in hot] == [("hot", 31)]

    def fullest(joined):
        per_task = joined.groupBy(F.spark_partition_id().alias("p")).count()
        counts = [r["count"] for r in per_task.collect()]
        return max(counts) / (sum(counts) / 16)

    assert fullest(equi_join(plays, songs, on, take)) > 12
    assert fullest(spread_join(plays, songs, on, take)) < 4
    assert spread_join(plays, songs, on, take).count() == equi_join(plays, songs, on, take).count()


def test_joined_rows_get_tasks_of_a_bounded_size(spark):
    """Few rows on both sides, many when joined: the planner would join them in one task."""
    plays = spark.range(400).selectExpr("id", "concat('a', id % 8) artist")
    songs = spark.range(400).selectExpr("concat('s', id) song", "concat('a', id % 8) name")
    on, take = {"artist": "name"}, {"song": "song"}
    joined = spread_join(plays, songs, on, take, "inner", rows_per_task=1000)
    per_task = [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(per_task) == 20_000 and max(per_task) < 5000
    assert rows(joined) == rows(equi_join(plays, songs, on, take, "inner"))


def test_rows_without_a_key_are_spread_and_kept(spark):
    plays = spark.range(300).selectExpr("id", "if(id < 250, null, 'a') artist")
    songs = spark.range(60).selectExpr("concat('s', id) song", "if(id = 0, null, 'a') name")
    on, take = {"artist": "name"}, {"song": "song"}
    for how in ("left", "inner"):
        joined = spread_join(plays, songs, on, take, how, rows_per_task=100)
        assert rows(joined) == rows(equi_join(plays, songs, on, take, how))


def test_distinct_matches_need_no_shuffle_of_joined_rows(spark, conf):
    conf(spark__sql__adaptive__enabled="false", spark__sql__autoBroadcastJoinThreshold="-1")
    plays = spark.createDataFrame(
        [(1, "x", "A"), (1, "x", "A"), (1, "y", "A"), (1, "x", "B"), (2, None, "A"), (3, "x", None)],
        "user int, item string, artist string",
    )
    schema = "song string, by string, name string"
    songs = [("S1", "P", "A"), ("S1", "P", "A"), ("S2", "P", "A"), (None, None, "A"), ("S3", "P", None)]
    on, take = {"artist": "name"}, {"song": "song", "by": "by"}

    def both(listed):
        right = spark.createDataFrame(listed, schema)
        plain = equi_join(plays, right, on, take, "inner").select("user", "song", "by").distinct()
        found = distinct_matches(plays, right, on, take, ["user"])
        assert rows(found) == rows(plain)
        return found._jdf.queryExecution().executedPlan().toString()

    plan = both(songs)
    assert plan.index("Join") < min(plan.index("Exchange"), plan.index("Aggregate"))
    # One song under two artists, and songs without ids under two.
    both([*songs, ("S1", "P", "B"), (None, None, "B"), ("S4", None, "B")])


def test_hot_key_is_split(spark, conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20k",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="10k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
    )
    facts = spark.range(0, 60000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    dim = spark.range(60000).select("id", (F.col("id") * 2).alias("w"))
    joined = equi_join(facts, dim, {"k": "id"}, {"w": "w"})
    assert joined.filter("w = 14").count() > 20000
    joined.collect()
    assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()


def test_labels(spark):
    codes = spark.createDataFrame(
        [("CIT", "582", "MEXICO", None), ("PORT", "ALC", "ALCAN, AK", "ALCAN"), ("PORT", "XXX", "?", None)],
        "field string, code string, label string, city string",
    )
    df = spark.createDataFrame([(1, "ALC"), (2, "QQQ"), (3, None), (4, "XXX")], "id int, port string")
    got = with_labels(df, codes, "PORT", "port", {"city": ("city", "none"), "text": ("label", None)})
    assert rows(got) == [
        (1, "ALC", "ALCAN", "ALCAN, AK"),
        (2, "QQQ", "none", None),
        (3, None, "none", None),
        (4, "XXX", None, "?"),
    ]


# -- merges ----------------------------------------------------------------------------------

EVENTS = st.lists(
    st.tuples(st.integers(0, 3), st.sampled_from("abc"), st.sampled_from(["free", "paid"])), max_size=8
)


def _frame(spark, events, start=0):
    numbered = [(start + i, *e) for i, e in enumerate(events)]
    return spark.createDataFrame(numbered, "seq int, id int, name string, level string")


@SPARK_TESTS
@given(EVENTS, EVENTS)
def test_merges_follow_the_row_by_row_rules(spark, first, second):
    ignore, merge, last = {}, {}, {}
    for id_, name, level in first + second:
        ignore.setdefault(id_, (name, level))
        merge[id_] = (merge[id_][0] if id_ in merge else name, level)
        last[id_] = (name, level)

    batches = [_frame(spark, first), _frame(spark, second, 100)]
    none = batches[0].drop("seq").limit(0)
    ignored = merged = none
    for batch in batches:
        ignored = load.insert_ignore(ignored, batch, ["id"], ["seq"])
        merged = load.upsert(merged, batch, ["id"], ["seq"], ["level"])
    written = load.last_write_wins(batches[0].union(batches[1]), ["id"], ["seq"]).drop("seq")
    as_rows = lambda d: sorted((k, *v) for k, v in d.items())
    assert rows(ignored) == as_rows(ignore)
    assert rows(merged) == as_rows(merge)
    assert rows(written) == as_rows(last)


def test_merges_are_idempotent(spark):
    batch = _frame(spark, [(1, "a", "free"), (1, "b", "paid"), (2, "c", "free")])
    none = batch.drop("seq").limit(0)
    once = load.upsert(none, batch, ["id"], ["seq"], ["level"])
    assert rows(once) == rows(load.upsert(once, batch, ["id"], ["seq"], ["level"]))
    kept = load.insert_ignore(none, batch, ["id"], ["seq"])
    assert load.new_rows(kept, batch, ["id"], ["seq"]).isEmpty()


def test_only_touched_partitions_are_read(spark, tmp_path):
    path = str(tmp_path / "t")
    rows_of = lambda ids: spark.createDataFrame([(i, i % 5, None if i % 2 else 1) for i in ids], "id int, p int, q int")
    rows_of(range(40)).write.partitionBy("p", "q").parquet(path)
    existing = spark.read.schema("id int, p int, q int").parquet(path)
    incoming = rows_of([6, 11, 47])
    near = load.in_touched_partitions(existing, incoming, ["p", "q"], ["id"], ["p", "q"])
    assert rows(near, "id") == [(i,) for i in range(40) if (i % 5, i % 2) in {(1, 0), (1, 1), (2, 1)}]
    assert rows(load.new_rows(near, incoming, ["id"], [])) == [(47, 2, None)]
    none = load.in_touched_partitions(existing, incoming.limit(0), ["p", "q"], ["id", "p", "q"])
    assert none.isEmpty()
    with pytest.raises(ValueError, match="does not fix the partition columns"):
        load.in_touched_partitions(existing, incoming, ["p", "q"], ["id"], ["p"])


def test_merges_refuse_null_keys(spark):
    batch = _frame(spark, [(1, "a", "free"), (None, "b", "paid")])
    none = batch.drop("seq").limit(0)
    for merged in (
        load.upsert(none, batch, ["id"], ["seq"], ["level"]),
        load.insert_ignore(none, batch, ["id"], ["seq"]),
    ):
        with pytest.raises(Exception, match="null in the key id"):
            merged.collect()


def test_a_run_that_dies_leaves_the_version_before(spark, tmp_path):
    spec = TableSpec("t", "id INT, name STRING, level STRING", ("id",))
    path = str(tmp_path / "t")
    first = _frame(spark, [(1, "a", "free"), (2, "b", "free")])
    load.upsert_into(path, first, ["id"], ["seq"], ["level"], spec)
    before = rows(load.read_version(spark, path, spec.schema))
    fails = first.withColumn("level", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        load.upsert_into(path, fails, ["id"], ["seq"], ["level"], spec)
    # files that no commit names, as a run leaves that is killed before it commits
    first.limit(1).drop("seq").write.parquet(f"{path}/rows/dead")
    assert rows(load.read_version(spark, path, spec.schema)) == before
    second = _frame(spark, [(2, "x", "paid"), (3, "c", "free")])
    load.upsert_into(path, second, ["id"], ["seq"], ["level"], spec)
    want = [(1, "a", "free"), (2, "b", "paid"), (3, "c", "free")]
    assert rows(load.read_version(spark, path, spec.schema)) == want
    # the version before stays for those who read it
    assert load.versions(spark, path) == [1, 2]
    assert rows(load.read_version(spark, path, spec.schema, 1)) == before


def test_keyed_tables_refuse_folders_of_another_kind(spark, tmp_path):
    spec = TableSpec("t", "id INT, name STRING, level STRING", ("id",))
    path = str(tmp_path / "t")
    batch = _frame(spark, [(1, "a", "free")])
    batch.drop("seq").write.parquet(path)
    for merge in (load.upsert_into, load.last_write_into):
        with pytest.raises(ValueError, match="no keyed table"):
            merge(path, batch, ["id"], ["seq"], *([["level"]] if merge is load.upsert_into else []), spec)


def test_contracts_count_and_refuse(spark):
    spec = TableSpec("t", "id INT, name STRING", ("id",), ("name",))
    df = spark.createDataFrame([("1", "a"), ("12x", None), ("1", "b")], "id string, name string")
    # one failed cast, one missing name, and one row more than there are keys
    assert rows(load.rejects(df, spec)) == [("t", "id", 1), ("t", "id", 1), ("t", "name", 1)]
    with pytest.raises(ValueError, match="rejected values"):
        load.accept(df, spec)
    assert rows(load.accept(df, spec, 1)) == [(None, None), (1, "a"), (1, "b")]


def test_upsert_keeps_nulls_of_known_rows(spark):
    known = spark.createDataFrame([(1, None, "free")], "id int, name string, level string")
    batch = spark.createDataFrame([(5, 1, "late", None)], "seq int, id int, name string, level string")
    assert rows(load.upsert(known, batch, ["id"], ["seq"], ["level"])) == [(1, None, None)]


# -- quality and profiles --------------------------------------------------------------------


@pytest.fixture(scope="module")
def gaps(spark):
    return spark.createDataFrame(
        [(1, "a", None), (2, None, 1.0), (2, "bbb", 2.0)], "id int, name string, v double"
    )


def test_check_report(gaps):
    report = check_table("t", gaps, CheckSpec(["name", "v"], ["id"], {"name": 2}))
    assert rows(report, "check_name", "column_name", "violations", "passed") == [
        ("max_length", "name", 1, False),
        ("not_empty", "", 0, True),
        ("not_null", "name", 1, False),
        ("not_null", "v", 1, False),
        ("unique", "id", 1, False),
    ]


def test_enforce_names_all_failures(gaps):
    good = gaps.na.drop()
    enforce(run_checks({"good": (good, CheckSpec(["name"], ["id"]))}))
    with pytest.raises(ValueError, match="bad: not_null v .*; none: not_empty|none: not_empty"):
        enforce(run_checks({"bad": (gaps, CheckSpec(["v"])), "none": (gaps.limit(0), CheckSpec())}))


def test_null_report(gaps):
    assert rows(null_report(gaps)) == [("id", 3, 0), ("name", 3, 1), ("v", 3, 1)]


def test_coverage(spark, gaps):
    dim = spark.createDataFrame([(2,), (2,), (9,)], "key int")
    assert rows(coverage(gaps, dim, ("id", "key"))) == [(2, 3, 2 / 3)]
    assert rows(coverage(gaps.limit(0), dim, ("id", "key"))) == [(0, 0, None)]


def test_profile(gaps):
    got = rows(column_profile(gaps, ["id", "name"], 1))
    assert got == [("id", 3, 2, 0, 0.0, 1, "2", 2), ("name", 3, 3, 1, 100 / 3, 1, "a", 1)]


def test_profile_of_every_value(gaps):
    names = column_profile(gaps, ["name"], 10).select("position", "value", "frequency")
    assert rows(names) == [(1, "a", 1), (2, "bbb", 1), (3, None, 1)]


def test_column_stats(spark, gaps):
    want = [("id", 3, 2, 0), ("name", 3, 3, 1), ("v", 3, 3, 1)]
    assert rows(column_stats(gaps)) == rows(column_stats(gaps, approximate=True)) == want
    many = spark.range(20000).select("id", (F.col("id") % 100).alias("few"))
    about = {r.column_name: r.distinct_values for r in column_stats(many, approximate=True).collect()}
    assert abs(about["id"] - 20000) < 3000 and abs(about["few"] - 100) < 15


def test_rows_with_nulls(gaps):
    assert rows(rows_with_nulls(gaps), "id") == [(1,), (2,)]
    assert rows(rows_with_nulls(gaps, ["v"]), "id") == [(1,)]


def test_drop_nulls_is_na_drop(spark, gaps):
    nan = gaps.union(spark.createDataFrame([(3, "c", float("nan"))], gaps.schema))
    for columns in (["v"], ["name"], ["id"], None):
        assert rows(drop_nulls(nan, columns), "id") == rows(nan.na.drop(subset=columns), "id")
    assert rows(rows_with_nulls(nan, ["v"]), "id") == [(1,), (3,)]


def test_dropped_nulls_reach_the_scan(gaps, tmp_path, spark):
    gaps.write.parquet(str(tmp_path / "t"))
    df = drop_nulls(spark.read.parquet(str(tmp_path / "t")), ["name"])
    assert "PushedFilters: [IsNotNull(name)]" in df._jdf.queryExecution().executedPlan().toString()


def test_group_sums_and_deviation(spark):
    df = spark.createDataFrame(
        [(None, 1, 5.0), (None, 2, 5.0), ("x", 3, 1.0)], "k string, n int, v double"
    )
    assert rows(group_sum(df, ["k"], ["n"])) == [(None, 3), ("x", 3)]
    assert rows(greatest_deviation(df, ["k"], ["v"])) == [(0.0,)]


# -- reports ---------------------------------------------------------------------------------


def test_counts_over_a_dimension(spark):
    facts = spark.createDataFrame([(1,), (1,), (2,), (3,), (None,), (9,)], "city int")
    dim = spark.createDataFrame(
        [(1, "FL"), (2, "CA"), (3, None), (4, "NY")], "city_id int, state string"
    )
    on = ("city", "city_id")
    assert rows(count_by_dim(facts, dim, on, "state")) == [(None, 1), ("CA", 1), ("FL", 2)]
    top = top_n_by_dim(facts, dim, on, "state", 1)
    assert [tuple(r) for r in top.collect()] == [("FL", 2)]


# -- layouts ---------------------------------------------------------------------------------


def test_bucketed_tables_join_without_a_shuffle(spark, conf, tmp_path):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    df = spark.range(1000).select("id", (F.col("id") % 10).alias("v"))
    for name in ("bucketed_a", "bucketed_b"):
        load.save_bucketed(df, name, 4, ["id"], str(tmp_path / name))
    joined = spark.table("bucketed_a").join(spark.table("bucketed_b").drop("v"), "id")
    assert joined.count() == 1000
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    for name in ("bucketed_a", "bucketed_b"):
        spark.sql(f"DROP TABLE {name}")


def test_bucket_sizes_show_a_frequent_key(spark, tmp_path):
    df = spark.range(1000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"))
    sizes = [n for _, n in rows(load.bucket_sizes(df, 32, ["k"]))]
    assert sum(sizes) == 1000 and max(sizes) > 330
    load.save_bucketed(df, "uneven", 32, ["k"], str(tmp_path / "uneven"))
    assert rows(spark.table("uneven")) == rows(df)
    spark.sql("DROP TABLE uneven")


def test_clustered_layout_splits_a_frequent_key(spark, conf):
    conf(spark__sql__shuffle__partitions="6", spark__sql__adaptive__coalescePartitions__enabled="false")
    df = spark.range(6000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), "id")
    out = load.clustered(df, ["k"], ["id"]).withColumn("part", F.spark_partition_id())
    assert out.filter("k = 7").select("part").distinct().count() > 1
    assert rows(out.drop("part")) == rows(df)


def test_rebalanced_writes_keep_all_rows(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") % 3).alias("p"), "id")
    plan = load.rebalanced(df, ["p"])._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan
    load.overwrite(df, str(tmp_path / "t"), ["p"])
    load.append(df.filter("p = 1"), str(tmp_path / "t"), ["p"])
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1333
    assert spark.read.parquet(str(tmp_path / "t/p=1")).count() == 666


def test_empty_inputs(spark):
    none = spark.createDataFrame([], "k string, n int")
    assert surrogate_key(none, ["k"], "id", "dense").count() == 0
    assert first_per_key(none, ["k"], ["n"]).count() == 0
    assert with_group_count(none, "k").count() == 0
    assert load.upsert(none, none, ["k"], ["n"], ["n"]).count() == 0
    assert column_profile(none).count() == 0
    assert rows(null_report(none)) == [("k", 0, 0), ("n", 0, 0)]
    assert top_n_by_dim(none, none, ("k", "k"), "n", 3).count() == 0


def test_ids_are_counted_by_as_many_tasks_as_their_rows_need(spark, tmp_path, monkeypatch):
    from starmill import session
    from starmill.catalog import QUERIES

    monkeypatch.setattr(session, "ROWS_PER_TASK", 100)
    lines = spark.range(950).selectExpr("id l_orderkey", "id % 7 l_partkey", "id % 3 l_linenumber")
    lines.unionByName(lines).write.parquet(f"{tmp_path}/lineitem.parquet")
    found = QUERIES["surrogate_keys_unique"](spark, str(tmp_path))
    assert rows(found) == [("fast", 950, 950), ("hash", 950, 950)]
    plan = found._jdf.queryExecution().toString()
    assert ", 19), REPARTITION_BY_NUM" in plan and ", 38), REPARTITION_BY_NUM" in plan


def test_small_tasks_hold_within_a_job_only(spark, conf, monkeypatch):
    from starmill import session

    most = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    conf(spark__sql__shuffle__partitions="5", **{size.replace(".", "__"): "77m"})
    monkeypatch.setattr(session, "ROWS_PER_TASK", 1000)
    with pytest.raises(KeyError), session.small_tasks(spark) as shuffled:
        assert spark.conf.get(most) == "5" and spark.conf.get(size) == str(8 << 20)
        shuffled(12_345)
        assert spark.conf.get(most) == "13"
        raise KeyError
    assert spark.conf.get(size) == "77m" and spark.conf.get(most, None) is None
