import pytest
from conftest import rows

from starmill.sources import read_code_tables, read_delimited, read_json, render_path
from starmill.session import cluster_settings, new_path, shared_folder

# Section titles, the sign for unknown codes and their labels are fixed values; the rest is invented.
CODES = (
    "options nocenter ;\r\n"
    "/* I94CIT & I94RES - valid and invalid codes */\r\n"
    "  value i94cntyl\r\n"
    "   582 =  'OZ By Balloon, and On Foot (Form 7, no rail)'\r\n"
    "   115 =  'RIX'\r\n"
    "   996 =  'No Country Code (996)' ;\r\n"
    "\r\n"
    "/* I94PORT - codes */\r\n"
    "   'EMR'\t=\t'EMERALD TOWN, KS      '\r\n"
    "   'GIL'\t=\t'GILLIKIN, NE (XQ)'\r\n"
    "   'WIN'\t=\t'WINKIE NV             '\r\n"
    "   'CP '\t=\t'No PORT Code (CP)'\r\n"
    "   'XYZ'\t=\t'No PORT Code (XYZ)'\r\n"
    "   '060'\t=\t'SOMEWHERE, IN, NY'\r\n"
    ";\r\n"
    "/* DAY counts from a day long ago\r\n"
    "   and so on. */\r\n"
    "/* I94MODE - modes */\r\n"
    "\t1 = 'Air'\r\n"
    "\t9 = 'Not reported' ;\r\n"
    "/* I94ADDR - states */\r\n"
    "\t'AL'='ALABAMA'\r\n"
    "/* I94VISA - Visa codes:\r\n"
    "   1 = Business\r\n"
    "   2 = Pleasure\r\n"
    "*/\r\n"
)
COUNTRIES = [
    (field, code, True, label, None, None)
    for field in ("I94CIT", "I94RES")
    for code, label in (
        ("115", "RIX"),
        ("582", "OZ By Balloon, and On Foot (Form 7, no rail)"),
        ("996", "No Country Code"),
    )
]
VISAS = [("I94VISA", "1", True, "Business", None, None), ("I94VISA", "2", True, "Pleasure", None, None)]


@pytest.fixture
def label_file(tmp_path):
    path = tmp_path / "labels.sas"
    path.write_bytes(CODES.encode())
    return str(path)


def test_code_tables(spark, label_file):
    assert rows(read_code_tables(spark, label_file)) == sorted(
        COUNTRIES
        + VISAS
        + [
            ("I94ADDR", "AL", False, "ALABAMA", None, None),
            ("I94MODE", "1", True, "Air", None, None),
            ("I94MODE", "9", True, "Not reported", None, None),
            ("I94PORT", "060", False, "SOMEWHERE, IN, NY", "SOMEWHERE, IN", "NY"),
            ("I94PORT", "EMR", False, "EMERALD TOWN, KS", "EMERALD TOWN", "KS"),
            ("I94PORT", "CP", False, "No PORT Code", "No PORT Code", ""),
            ("I94PORT", "GIL", False, "GILLIKIN, NE (XQ)", "GILLIKIN", "NE"),
            ("I94PORT", "WIN", False, "WINKIE NV", "WINKIE", "NV"),
            ("I94PORT", "XYZ", False, "No PORT Code", "No PORT Code", ""),
        ]
    )


def test_code_tables_strict(spark, label_file):
    assert rows(read_code_tables(spark, label_file, strict=True)) == sorted(
        COUNTRIES_STRICT
        + VISAS
        + [
            ("I94MODE", "1", True, "Air", None, None),
            ("I94MODE", "9", True, "Not reported ;", None, None),
            ("I94PORT", "60", True, "SOMEWHERE, IN, NY", "SOMEWHERE, IN", "NY"),
            ("I94PORT", "EMR", False, "EMERALD TOWN, KS", "EMERALD TOWN", "KS"),
            ("I94PORT", "GIL", False, "GILLIKIN, NE (XQ)", "GILLIKIN", "NE"),
            ("I94PORT", "WIN", False, "WINKIE NV", "", "WI"),
            ("I94PORT", "XYZ", False, "No PORT Code", "", "No"),
        ]
    )


COUNTRIES_STRICT = COUNTRIES


def test_code_tables_over_many_splits(spark, label_file, conf):
    whole = rows(read_code_tables(spark, label_file))
    conf(spark__sql__files__maxPartitionBytes="64b", spark__sql__files__openCostInBytes="0")
    assert spark.read.text(label_file).rdd.getNumPartitions() > 8
    assert rows(read_code_tables(spark, label_file)) == whole


def test_repeated_codes_and_sections(spark, tmp_path):
    (tmp_path / "a.txt").write_text(
        "/* A - one */\n 1 = 'x'\n 2 = 'y'\n 2 = 'z'\n/* B - two */\n 1 = 'b'\n/* A - again */\n 3 = 'w'\n 3 = 'v'\n"
    )
    got = read_code_tables(spark, str(tmp_path)).select("field", "code", "label")
    assert rows(got) == [("A", "3", "v"), ("B", "1", "b")]


def test_delimited_schema_goes_by_position(spark, tmp_path):
    from starmill.schemas import struct

    (tmp_path / "a.csv").write_text('City;Total "Pop"\n"Akron; OH";12\nBath;\n')
    got = read_delimited(spark, str(tmp_path), struct("city STRING, n INT"), sep=";")
    assert rows(got) == [("Akron; OH", 12), ("Bath", None)]


def test_json_tree(spark, tmp_path):
    from starmill.schemas import struct

    for i, folder in enumerate(("A/B/C", "A/B/D", "B")):
        (tmp_path / folder).mkdir(parents=True)
        (tmp_path / folder / "x.json").write_text(f'{{"id": {i}, "more": 1}}\n')
        (tmp_path / folder / "notes.txt").write_text("{}")
    got = read_json(spark, str(tmp_path), struct("id INT"), recursive=True, pattern="*.json")
    assert rows(got) == [(0,), (1,), (2,)]


def test_render_path():
    assert render_path("log/{year}/{month:02d}", year=2018, month=3) == "log/2018/03"


def test_paths_are_fresh_and_shared(spark):
    a, b = new_path(spark, "x"), new_path(spark, "x")
    assert a != b and a.startswith(shared_folder(spark))


def test_shuffles_are_sized_by_their_bytes():
    few, many = cluster_settings(1 << 30), cluster_settings(10 << 40)
    assert few["spark.sql.shuffle.partitions"] == "200"
    assert many["spark.sql.shuffle.partitions"] == str(10 << 12)


class _Session:
    """As much of a session as naming the shared folder takes."""

    def __init__(self, checkpoint=None, **options):
        self.options = {name.replace("__", "."): value for name, value in options.items()}
        self.conf = self
        self.sparkContext = self
        self.getCheckpointDir = lambda: checkpoint

    def get(self, name, default=None):
        return self.options.get(name, default)


def test_the_shared_folder_is_the_one_the_cluster_names():
    named = _Session(spark__checkpoint__dir="hdfs://shared/", spark__master="yarn")
    assert shared_folder(named) == "hdfs://shared"
    assert shared_folder(_Session("hdfs://set/run", spark__master="yarn")) == "hdfs://set/run"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(_Session(spark__master="yarn"))
