import os
import subprocess

import pytest
from conftest import rows
from pyspark.sql import functions as F

from starmill.operators import load
from starmill.operators.contracts import Load, Refused, faults, refuse, reject_rows
from starmill.operators.dataset import Conflict, Dataset, listed, not_taken
from starmill.schemas import TableSpec

SPEC = TableSpec("t", "id BIGINT, n INT, s STRING", ("id",), ("id",), {"s": 3})
PLAIN = TableSpec("log", "id BIGINT, n INT, s STRING", (), ("id",), {"s": 3})


def made(spark, *ids, n=0, s="ab"):
    return spark.createDataFrame([(i, n, s) for i in ids], "id long, n int, s string")


def newest(existing, incoming):
    return existing.join(incoming.select("id"), "id", "left_anti").unionByName(incoming)


# -- contracts -------------------------------------------------------------------------------


def test_faults_are_counted_by_the_write(spark, tmp_path):
    df = spark.createDataFrame(
        [("1", "2", "abc"), ("x", "3", "abcd"), (None, "z", "a"), ("4", None, None)],
        "id string, n string, s string",
    )
    load_ = Load(df, SPEC)
    load_.rows.write.parquet(f"{tmp_path}/t")
    want = {("read", ""): 4, ("lost", ""): 2, ("cast", "id"): 1, ("not_null", "id"): 1,
            ("cast", "n"): 1, ("cast", "s"): 0, ("max_length", "s"): 1}
    assert {(c, n): k for _, c, n, k in load_.counts()} == want
    assert load_.recount() == load_.counts()
    assert rows(spark.read.parquet(f"{tmp_path}/t"), "id", "n", "s") == [(1, 2, "abc"), (4, None, None)]
    refuse([(load_, 2)])
    with pytest.raises(Refused) as refused:
        refuse([(load_, 1)])
    first, *quoted = str(refused.value).split("\n  ")
    one = "(1 of 4 rows)"
    assert first == (
        f"load refused: t: cast id {one}; t: not_null id {one}; t: cast n {one}; t: max_length s {one}"
    )
    assert 't: not_null id; cast n: {"n":"z","s":"a"}' in quoted and len(quoted) == 2
    listed_ = reject_rows(df, SPEC).select(F.array_join("reasons", ";"), "record").collect()
    assert sorted(map(tuple, listed_)) == [
        ("cast id;max_length s", '{"id":"x","n":"3","s":"abcd"}'),
        ("not_null id;cast n", '{"n":"z","s":"a"}'),
    ]


def test_counting_takes_no_scan_of_its_own(spark, tmp_path):
    made(spark, 1, 2).write.parquet(f"{tmp_path}/in")
    plan = Load(spark.read.parquet(f"{tmp_path}/in"), SPEC).rows._jdf.queryExecution().executedPlan()
    assert plan.toString().count("FileScan") == 1 and "CollectMetrics" in plan.toString()


def test_no_rows_count_as_none(spark, tmp_path):
    empty = Load(spark.createDataFrame([], "id string, n string, s string"), SPEC)
    empty.rows.write.parquet(f"{tmp_path}/t")
    assert {k for *_, k in empty.counts()} == {0}
    refuse([(empty, 0)])


def test_counts_of_tasks_that_ran_twice_refuse_nothing(spark, tmp_path, monkeypatch):
    load_ = Load(made(spark, 1), SPEC)
    load_.rows.write.parquet(f"{tmp_path}/t")
    monkeypatch.setattr(load_, "lost", lambda: 7)
    refuse([(load_, 0)])


def test_every_fault_has_a_name():
    assert list(faults(SPEC)) == [("cast", "id"), ("not_null", "id"), ("cast", "n"), ("cast", "s"),
                                  ("max_length", "s")]


# -- commits ---------------------------------------------------------------------------------


@pytest.fixture
def dataset(spark, tmp_path):
    return Dataset(spark, f"{tmp_path}/data")


def publish(dataset, *changes):
    with dataset.change() as change:
        for name, *args in changes:
            getattr(change, name)(*args)
        return change.publish()


def test_tables_change_together_or_not_at_all(spark, dataset):
    publish(dataset, ("replace", "t", made(spark, 1), SPEC), ("replace", "u", made(spark, 2), SPEC))
    before = dataset.commit()
    with pytest.raises(Refused), dataset.change() as change:
        change.replace("t", made(spark, 3), SPEC)
        change.replace("u", made(spark, 4, s="long"), SPEC)
        change.publish()
    with pytest.raises(ZeroDivisionError), dataset.change() as change:
        change.replace("t", made(spark, 5), SPEC)
        raise ZeroDivisionError
    assert dataset.commit() == before
    assert rows(dataset.read("t", SPEC.schema), "id") == [(1,)]
    assert rows(dataset.read("u", SPEC.schema), "id") == [(2,)]
    assert len(dataset.files.names(f"{dataset.path}/t")) == 1  # what was written is gone


def test_readers_keep_the_commit_they_began_with(spark, dataset):
    publish(dataset, ("replace", "t", made(spark, 1), SPEC))
    reading = dataset.read("t", SPEC.schema)
    publish(dataset, ("replace", "t", made(spark, 2), SPEC))
    dataset.vacuum(keep=2)
    assert rows(reading, "id") == [(1,)]
    assert rows(dataset.read("t", SPEC.schema, dataset.commit(1)), "id") == [(1,)]
    publish(dataset, ("replace", "t", made(spark, 3), SPEC))
    dataset.vacuum(keep=2)
    assert dataset.numbers() == [2, 3]
    assert rows(dataset.read("t", SPEC.schema), "id") == [(3,)]
    assert len(dataset.files.names(f"{dataset.path}/t")) == 2


def test_a_batch_of_one_key_rewrites_one_bucket(spark, dataset):
    publish(dataset, ("merge", "t", made(spark, *range(100)), SPEC, newest, 8))
    first = dataset.commit()
    publish(dataset, ("merge", "t", made(spark, 7, n=1), SPEC, newest))
    changed = {
        b for b in first.tables["t"] if dataset.commit().tables["t"][b] != first.tables["t"][b]
    }
    assert len(first.tables["t"]) == 8 and len(changed) == 1
    got = rows(dataset.read("t", SPEC.schema), "id", "n")
    assert got == [(i, int(i == 7)) for i in range(100)]


def test_the_scan_of_a_merge_reads_only_touched_buckets(spark, dataset):
    publish(dataset, ("merge", "t", made(spark, *range(100)), SPEC, newest, 8))
    seen = []

    def merged(existing, incoming):
        seen.append(len(existing.inputFiles()))
        return newest(existing, incoming)

    publish(dataset, ("merge", "t", made(spark, 7, n=1), SPEC, merged))
    whole = len(dataset.read("t", SPEC.schema).inputFiles())
    assert seen[0] < whole / 4


def test_keys_fall_into_the_same_bucket_whatever_their_type(spark, dataset):
    publish(dataset, ("merge", "t", made(spark, *range(50)), SPEC, newest, 8))
    text = made(spark, 7, 8, n=1).withColumn("id", F.col("id").cast("string"))
    publish(dataset, ("merge", "t", text, SPEC, newest))
    assert rows(dataset.read("t", SPEC.schema).where("n = 1"), "id") == [(7,), (8,)]
    assert dataset.read("t", SPEC.schema).count() == 50


def test_writers_at_once(spark, dataset):
    publish(dataset, ("merge", "t", made(spark, *range(40)), SPEC, newest, 4))
    one, two, three = dataset.change(), dataset.change(), dataset.change()
    one.add("log", made(spark, 1), PLAIN)
    two.add("log", made(spark, 2), PLAIN)
    three.merge("t", made(spark, 1, n=9), SPEC, newest)
    assert [c.publish().number for c in (one, two, three)] == [2, 3, 4]
    assert rows(dataset.read("log", SPEC.schema), "id") == [(1,), (2,)]
    assert rows(dataset.read("t", SPEC.schema).where("n = 9"), "id") == [(1,)]
    late, later = dataset.change(), dataset.change()
    late.merge("t", made(spark, 5, n=8), SPEC, newest)
    later.merge("t", made(spark, 5, n=7), SPEC, newest)
    late.publish()
    with pytest.raises(Conflict):
        later.publish()
    assert rows(dataset.read("t", SPEC.schema).where("id = 5"), "n") == [(8,)]


def test_a_record_is_never_replaced(dataset):
    dataset.files.fs.mkdirs(dataset.files.place(f"{dataset.path}/_commits"))
    assert dataset.files.publish(dataset.record(1), "one")
    assert not dataset.files.publish(dataset.record(1), "two")
    assert dataset.files.read(dataset.record(1)) == "one"
    assert dataset.numbers() == [1]
    assert len(dataset.files.names(f"{dataset.path}/_commits")) == 1


def test_success_markers_do_not_matter(spark, tmp_path):
    """Merges keep known rows also where Spark writes no marker files."""
    conf = spark._jsc.hadoopConfiguration()
    name = "mapreduce.fileoutputcommitter.marksuccessfuljobs"
    conf.set(name, "false")
    try:
        path = f"{tmp_path}/users"
        order = (["id"], ["n"], ["s"], SPEC)
        load.upsert_into(path, made(spark, 1, 2), *order)
        load.upsert_into(path, made(spark, 2, 3, s="cd"), *order)
        got = rows(load.read_version(spark, path, SPEC.schema), "id", "s")
    finally:
        conf.unset(name)
    assert got == [(1, "ab"), (2, "cd"), (3, "cd")]


def test_empty_tables_and_partitions(spark, dataset):
    spec = TableSpec("p", "id BIGINT, n INT, s STRING", partition_by=("n",))
    publish(dataset, ("replace", "p", made(spark), spec), ("add", "log", made(spark), PLAIN))
    assert dataset.read("p", spec.schema).count() == 0
    assert dataset.read("log", PLAIN.schema).count() == 0
    assert dataset.read("nothing", spec.schema).count() == 0
    publish(dataset, ("replace", "p", made(spark, 1, n=4), spec))
    assert rows(dataset.read("p", spec.schema), "id", "n", "s") == [(1, 4, "ab")]
    assert publish(dataset, ("merge", "t", made(spark), SPEC, newest)).tables["t"] == {}
    with pytest.raises(ValueError, match="keyed"), dataset.change() as change:
        change.add("t", made(spark, 1), SPEC)
    with pytest.raises(ValueError, match="not keyed"), dataset.change() as change:
        change.merge("p", made(spark, 1), SPEC, newest)


def test_leftovers_of_dead_writers_go_with_time(spark, dataset):
    dead = dataset.change()
    dead.add("log", made(spark, 1), PLAIN)
    publish(dataset, ("add", "log", made(spark, 2), PLAIN))
    dataset.vacuum()
    assert len(dataset.files.names(f"{dataset.path}/log")) == 2
    dataset.vacuum(older_than_ms=-10**6)
    assert len(dataset.files.names(f"{dataset.path}/log")) == 1
    assert rows(dataset.read("log", PLAIN.schema), "id") == [(2,)]


# -- ledger ----------------------------------------------------------------------------------


def take(spark, dataset, folder):
    new = not_taken(listed(spark, str(folder), pattern="*.txt"), dataset.taken()).collect()
    if new:
        files = spark.createDataFrame(new, "path string, length long, modified timestamp")
        rows_ = spark.read.text([r.path for r in new]).selectExpr("cast(value as bigint) id", "0 n", "'a' s")
        publish(dataset, ("add", "log", rows_, PLAIN), ("took", files))
    return len(new)


def test_files_are_taken_once(spark, dataset, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.txt").write_text("1\n2")
    (folder / "b.txt").write_text("3")
    (folder / "c.csv").write_text("9")
    assert take(spark, dataset, folder) == 2
    assert take(spark, dataset, folder) == 0
    (folder / "d.txt").write_text("4")
    assert take(spark, dataset, folder) == 1
    assert rows(dataset.read("log", PLAIN.schema), "id") == [(1,), (2,), (3,), (4,)]
    os.utime(folder / "a.txt", (1, 1))
    assert take(spark, dataset, folder) == 1  # it has changed


def test_ledgers_are_gathered(spark, dataset, monkeypatch):
    monkeypatch.setattr("starmill.operators.dataset.LEDGERS", 2)
    for i in range(4):
        files = spark.createDataFrame([(f"f{i}", 1, None)], "path string, length long, modified timestamp")
        publish(dataset, ("took", files))
    assert len(dataset.commit().ledgers) == 2
    assert rows(dataset.taken(), "path") == [("f0",), ("f1",), ("f2",), ("f3",)]
    one, two = dataset.change(), dataset.change()
    for change in (one, two):
        change.took(spark.createDataFrame([("g", 1, None)], "path string, length long, modified timestamp"))
    one.publish()
    with pytest.raises(Conflict):
        two.publish()


def test_a_killed_writer_leaves_the_table(spark, tmp_path):
    """A process that ends between writing data and publishing."""
    code = f"""
import os, sys
sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r})
from starmill.session import local_session
from starmill.operators.dataset import Dataset
from starmill.schemas import TableSpec
spark = local_session(1, **{{"spark.log.level": "OFF"}})
spec = TableSpec("t", "id BIGINT")
data = Dataset(spark, {str(tmp_path / "d")!r})
with data.change() as change:
    change.replace("t", spark.range(3), spec)
    change.publish()
change = data.change()
change.replace("t", spark.range(9), spec)
os._exit(9)
"""
    assert subprocess.run(["python", "-c", code], capture_output=True, timeout=120).returncode == 9
    left = Dataset(spark, str(tmp_path / "d"))
    assert len(left.files.names(f"{left.path}/t")) == 2
    assert left.read("t", TableSpec("t", "id BIGINT").schema).count() == 3
