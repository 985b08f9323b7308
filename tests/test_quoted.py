import csv
import io
import random

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from starmill.operators.contracts import Refused
from starmill.operators.load import save_quoted_csv
from starmill.plans import listening
from starmill.schemas import PLAY_LOG_CSV, struct
from starmill.sources import read_quoted
from starmill.sources.quoted import lines_of, records_of

SCHEMA = struct("a STRING, b STRING")


def written(records, newline="\n"):
    out = io.StringIO()
    csv.writer(out, lineterminator=newline).writerows([["a", "b"], *records])
    return out.getvalue()


def read_back(spark, path):
    found = read_quoted(spark, str(path), SCHEMA).collect()
    found.sort(key=lambda r: (r.file, r.block, r.line))
    return [(r.a or "", r.b or "") for r in found]


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("split", [40, 300, 1 << 20])
def test_line_breaks_across_splits(spark, conf, tmp_path, seed, split):
    rng = random.Random(seed)
    parts = ["x", "yy", "\n", '"', ",", " ", "é", "\n\n"]
    records = [
        tuple("v" + "".join(rng.choices(parts, k=rng.randint(0, 9))) for _ in "ab") for _ in range(60)
    ]
    (tmp_path / "f.csv").write_bytes(written(records).encode())
    (tmp_path / "g.csv").write_bytes(written(records[:7]).encode())
    conf(spark__sql__files__maxPartitionBytes=str(split), spark__sql__files__openCostInBytes="1")
    lines = lines_of(spark, str(tmp_path))
    if split == 40:
        assert lines.select("block").distinct().count() > 10
    assert read_back(spark, tmp_path) == records + records[:7]


text = st.text(alphabet='ab"\n, é', max_size=8).map(lambda t: "v" + t)


@settings(deadline=None, max_examples=15, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(text, text), max_size=8))
def test_as_the_csv_module_reads(spark, tmp_path_factory, records):
    path = tmp_path_factory.mktemp("csv") / "f.csv"
    path.write_bytes(written(records, "\r\n").replace("\r\n", "\r\n\r\n", 1).encode())
    want = [tuple(r) for r in csv.reader(io.StringIO(path.read_text(newline=""), newline="")) if r][1:]
    assert read_back(spark, path) == want


def test_what_is_written_is_read(spark, tmp_path):
    df = spark.createDataFrame([("one\ntwo", 'say "hi"'), ("a,b", "x\n\ny"), ("x", "y")], "a string, b string")
    save_quoted_csv(df, str(tmp_path / "out"))
    assert rows(read_quoted(spark, str(tmp_path / "out"), SCHEMA).select("a", "b")) == rows(df)


def test_files_without_line_breaks_are_not_grouped(spark, tmp_path):
    (tmp_path / "f.csv").write_text(written([("x", 'y "z"')]))
    plan = records_of(lines_of(spark, str(tmp_path)))._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Exchange" not in plan


def test_quote_that_is_never_closed(spark, tmp_path):
    (tmp_path / "f.csv").write_text('a,b\nx,y\n"open,z\nx,y\n')
    (tmp_path / "g.csv").write_text("a,b\nx,y\nonly\n")
    found = read_quoted(spark, str(tmp_path), SCHEMA, broken="bad").collect()
    assert sorted((r.a, r.b) for r in found if r.bad is None) == [("x", "y"), ("x", "y")]
    assert sorted(r.bad for r in found if r.bad) == ['"open,z\nx,y', "only"]


def export(**values):
    return [values.get(c, "1") for c in PLAY_LOG_CSV.names]


def test_history_with_line_breaks_and_bad_records(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    records = [export(artist="Two\nLines", song="A"), export(artist="One", song="B", sessionId="2")]
    out = io.StringIO()
    csv.writer(out, lineterminator="\n").writerows([PLAY_LOG_CSV.names, *records])
    (folder / "a.csv").write_text(out.getvalue() + "cut,off\n")
    with pytest.raises(Refused, match="broken"):
        listening.build_history(spark, str(folder), str(tmp_path / "out"))
    tables = listening.build_history(spark, str(folder), str(tmp_path / "out"), allowance=1)
    assert rows(tables["song_session"], "artist_name", "song") == [("One", "B"), ("Two\nLines", "A")]
    (lost,) = spark.read.json(str(tmp_path / "out/rejects")).collect()
    assert (lost.reasons, lost.record) == (["broken"], "cut,off")
