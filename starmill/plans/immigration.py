"""The immigration star schema: six dimensions, the arrivals fact, checks and reports."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.functions import (
    as_long,
    code_text,
    fallback_identifier,
    hash_key,
    pair_part,
    parse_date,
    sas_day_to_date,
    upper_text,
)
from starmill.operators import load
from starmill.operators.dataset import Dataset
from starmill.operators.dims import argmax_by_group, dimension, surrogate_key, time_dim
from starmill.operators.facts import DimJoin, equi_join, fact, lookup_one, with_labels
from starmill.operators.nulls import drop_nulls
from starmill.operators.quality import CheckSpec, enforce, run_checks
from starmill.operators.reports import count_by_dim, most_frequent_first, top_n_by_dim
from starmill.schemas import (
    AIRPORTS,
    ALIEN,
    CITY,
    DEMOGRAPHICS,
    IMMIGRATION,
    IMMIGRATION_TIME,
    IMMIGRATIONS,
    LOGISTICS,
    PORT,
    TEMPERATURES,
    VISA_ISSUER,
    TableSpec,
)
from starmill.session import together, use_utc
from starmill.sources import read_code_tables, read_delimited, read_format, render_path

# Labels of unknown codes, the country reported on, and the earliest date kept.
NO_COUNTRY = "No Country Code"
NO_PORT = "No PORT Code"
HOME_COUNTRY = "United States"
HOME_COUNTRY_CODE = "US"
CONTINENT = "NA"
EARLIEST = "2015-01-01"
EXPIRATION_PATTERN = "MMddyyyy"


@dataclass(frozen=True)
class Inputs:
    """The raw frames of the job; ``codes`` as given by ``read_code_tables``."""

    immigration: DataFrame
    demographics: DataFrame
    temperatures: DataFrame
    airports: DataFrame
    codes: DataFrame


def read_immigration(
    spark: SparkSession,
    folder: str,
    fmt: str = "parquet",
    month_file: str | None = None,
    options: Mapping[str, object] | None = None,
    **params: object,
) -> DataFrame:
    """All months under ``folder``, or only the file that ``month_file`` (a template) names.

    Any format of the session will do, with its ``options``. If it is row-oriented, keep the
    records as parquet first (``sources.stage_raw``), since several tables are made of them.
    """
    options = options or {}
    if month_file is None:
        return read_format(spark, fmt, folder, IMMIGRATION, recursive=True, **options)
    path = f"{folder}/{render_path(month_file, **params)}"
    return read_format(spark, fmt, path, IMMIGRATION, **options)


def read_inputs(
    spark: SparkSession, immigration: DataFrame, paths: Mapping[str, str], strict: bool = False
) -> Inputs:
    """Open the side files named "demographics", "temperatures", "airports" and "codes"."""
    return Inputs(
        immigration,
        read_delimited(spark, paths["demographics"], DEMOGRAPHICS, sep=";"),
        read_delimited(spark, paths["temperatures"], TEMPERATURES),
        read_delimited(spark, paths["airports"], AIRPORTS),
        read_code_tables(spark, paths["codes"], strict),
    )


def decode(immigration: DataFrame, strict: bool = False) -> DataFrame:
    """Decode dates and name the transport; records without an admission number are dropped.

    Only projections, so each table built from the result scans just its own columns, and there
    is nothing worth storing in between.
    """
    return drop_nulls(immigration, ["admnum"]).withColumns(
        {
            "arrdate": sas_day_to_date("sas_arrdate"),
            "depdate": sas_day_to_date("sas_depdate"),
            "expiration_date": parse_date("dtaddto", EXPIRATION_PATTERN),
            "transport_no": fallback_identifier("fltno", "airline", "i94mode", strict),
        }
    )


def with_entry_city(decoded: DataFrame, codes: DataFrame) -> DataFrame:
    """Add city and state of the port of entry."""
    ports = codes.filter(~F.col("numeric"))
    labels = {"city": ("city", NO_PORT), "state": ("state", "")}
    return with_labels(decoded, ports, "I94PORT", "i94port", labels)


def augment(immigration: DataFrame, codes: DataFrame, strict: bool = False) -> DataFrame:
    return with_entry_city(decode(immigration, strict), codes)


# -- dimensions ------------------------------------------------------------------------------


def city_dim(
    decoded: DataFrame, codes: DataFrame, demographics: DataFrame, temperatures: DataFrame
) -> DataFrame:
    """Cities known from demographics or as ports of entry, one row per (state code, name).

    Demographics come with a row per race; the row of the most frequent one is kept.
    """
    counted = demographics.na.fill(
        0, ["male_population", "female_population", "number_of_veterans", "foreign_born"]
    ).withColumn("name", upper_text("city"))
    cities = (
        argmax_by_group(counted, ["state_code", "name"], "count", ties="one", order=["race"])
        .withColumnRenamed("race", "most_common_race")
        .withColumn("country", F.lit(HOME_COUNTRY_CODE))
        .drop("city", "count")
    )
    warmth = (
        temperatures.filter(F.col("country") == HOME_COUNTRY)
        .groupBy(upper_text("city").alias("name"))
        .agg(F.avg("average_temperature").alias("avg_temp"))
    )
    with_warmth = cities.join(warmth, "name", "left")
    ports = with_entry_city(decoded.select("i94port").distinct(), codes)
    entered = ports.select(F.col("state").alias("state_code"), F.col("city").alias("name"))
    joined = with_warmth.join(entered.distinct(), ["state_code", "name"], "full_outer")
    keyed = surrogate_key(joined, ["state_code", "name"], "city_id")
    return load.conform(keyed, CITY)


def immigration_time_dim(decoded: DataFrame) -> DataFrame:
    """Days of arrival, departure and expiry, since 2015."""
    days = ["arrdate", "depdate", "expiration_date"]
    since = F.lit(EARLIEST).cast("timestamp")
    return time_dim(decoded, days, "sun1", since=since, name="time")


def port_dim(airports: DataFrame) -> DataFrame:
    """Airports of the home country, whether or not anybody entered there.

    Joining them to the ports of entry, all rows of both sides kept, would add only rows without
    a country, which the filter on the country takes out again. So arrivals are not read.
    """
    at_home = airports.filter(F.col("iso_country") == HOME_COUNTRY_CODE)
    rows = at_home.select(
        F.col("local_code").alias("port"),
        "name",
        "municipality",
        F.col("iso_country").alias("country"),
        "elevation_ft",
        pair_part("coordinates", 0, as_type="double").alias("longitude"),
        pair_part("coordinates", 1, as_type="double").alias("latitude"),
        F.lit(CONTINENT).alias("continent"),
        "type",
        hash_key("ident").alias("port_id"),
    )
    return load.conform(rows, PORT)


def visa_issuer_dim(decoded: DataFrame) -> DataFrame:
    names = decoded.select(F.col("visapost").alias("name")).distinct()
    return surrogate_key(names, ["name"], "visa_issuer_id")


def alien_dim(decoded: DataFrame, codes: DataFrame) -> DataFrame:
    """Persons by admission number, as recorded at their first arrival."""
    people = dimension(
        decoded.filter(as_long("admnum", zero_is_null=True).isNotNull()),
        {
            "admission_id": as_long("admnum", zero_is_null=True),
            "i94cit": "i94cit",
            "i94res": "i94res",
            "gender": "gender",
            "age": as_long("i94bir"),
            "visatype": "visatype",
            "i94visa_code": "i94visa",
            "entdepa": "entdepa",
            "entdepd": "entdepd",
            "matflag": "matflag",
            "year_of_birth": as_long("biryear"),
        },
        ["admission_id"],
        order=["sas_arrdate", "cic_id"],
    )
    numbered = codes.filter("numeric")
    for code, out in (("i94cit", "citizenship_origin"), ("i94res", "residency_origin")):
        labels = {out: ("label", NO_COUNTRY)}
        people = with_labels(people, numbered, code.upper(), code_text(code), labels)
    visa = {"i94visa": ("label", None)}
    people = with_labels(people, numbered, "I94VISA", code_text("i94visa_code"), visa)
    return load.conform(people, ALIEN)


def logistics_dim(decoded: DataFrame) -> DataFrame:
    rows = dimension(
        decoded,
        {"transport_no": "transport_no", "company": "airline", "mode": "i94mode"},
        ["transport_no"],
        order=["sas_arrdate", "cic_id"],
    )
    return surrogate_key(rows, ["transport_no"], "transport_id")


# -- fact ------------------------------------------------------------------------------------


def immigrations_fact(
    decoded: DataFrame, codes: DataFrame, dims: Mapping[str, DataFrame], verify: bool = False
) -> DataFrame:
    """One row per record. A port code shared by several airports counts as the first of them
    by id, so no record is repeated."""
    rows = lookup_one(
        with_entry_city(decoded, codes),
        dims["port"],
        {"i94port": "port"},
        {"port_id": "port_id"},
        ["port_id"],
    )
    joins = [
        DimJoin(
            dims["city"],
            {"city": "name", "state": "state_code"},
            {"arrival_city": "city_id"},
        ),
        DimJoin(
            dims["visa_issuer"], {"visapost": "name"}, {"visa_issuer_id": "visa_issuer_id"}
        ),
        DimJoin(
            dims["logistics"], {"transport_no": "transport_no"}, {"transport_id": "transport_id"}
        ),
    ]
    joined = fact(rows, joins, verify)
    return joined.select(
        "cic_id",
        "arrival_city",
        F.col("expiration_date").cast("timestamp").alias("expiration_time"),
        as_long("admnum", zero_is_null=True).alias("admission_id"),
        F.col("arrdate").cast("timestamp").alias("arrdate"),
        F.col("depdate").cast("timestamp").alias("depdate"),
        "transport_id",
        "visa_issuer_id",
        "port_id",
        as_long("i94yr").cast("int").alias("i94_year"),
        as_long("i94mon").cast("int").alias("i94_month"),
    )


# -- reports ---------------------------------------------------------------------------------


def top_arrival_states(immigrations: DataFrame, city: DataFrame, n: int = 10) -> DataFrame:
    return top_n_by_dim(immigrations, city, ("arrival_city", "city_id"), "state", n)


def arrivals_per_month(immigrations: DataFrame, time: DataFrame) -> DataFrame:
    counts = count_by_dim(immigrations, time, ("arrdate", "time"), "month")
    return most_frequent_first(counts, "month")


def arrivals_per_month_from(
    immigrations: DataFrame, time: DataFrame, alien: DataFrame, country: str = "ICELAND"
) -> DataFrame:
    """Arrivals per month of the citizens of one country."""
    people = alien.filter(F.col("citizenship_origin") == country)
    theirs = equi_join(
        immigrations, people, {"admission_id": "admission_id"}, {}, how="left_semi"
    )
    return arrivals_per_month(theirs, time)


# -- job -------------------------------------------------------------------------------------

SPECS: dict[str, TableSpec] = {
    spec.name: spec
    for spec in (IMMIGRATIONS, CITY, PORT, VISA_ISSUER, LOGISTICS, ALIEN, IMMIGRATION_TIME)
}


def build_dims(decoded: DataFrame, inputs: Inputs) -> dict[str, DataFrame]:
    return {
        "time": immigration_time_dim(decoded),
        "port": port_dim(inputs.airports),
        "visa_issuer": visa_issuer_dim(decoded),
        "alien": alien_dim(decoded, inputs.codes),
        "logistics": logistics_dim(decoded),
        "city": city_dim(decoded, inputs.codes, inputs.demographics, inputs.temperatures),
    }


def build_immigration(
    spark: SparkSession, inputs: Inputs, out: str, strict: bool = False, allowance: int = 0
) -> dict[str, DataFrame]:
    """Dimensions, their checks, then the fact from the written dimensions; all in the dataset
    ``out``, by one commit.

    Written first, the keys in the fact are the keys in the files, and joins see the written sizes.
    Nothing is live before all checks have passed, so a run that fails or dies leaves all seven
    tables of the last run. The checks include that ids are unique, and as an id is computed from
    the columns the fact is joined on, that no join repeats a record. Rows that break the contract
    of their table are counted as they are written: more than ``allowance`` stop the job.
    """
    use_utc(spark)
    data = Dataset(spark, out)
    decoded = decode(inputs.immigration, strict)
    with data.change() as change:

        def write(name: str, df: DataFrame) -> DataFrame:
            change.replace(name, df, SPECS[name], allowance)
            return change.read(name, SPECS[name].schema)

        def check(tables: Mapping[str, DataFrame]) -> None:
            enforce(
                run_checks({name: (df, CheckSpec.of(SPECS[name])) for name, df in tables.items()})
            )

        dims = build_dims(decoded, inputs)
        written = together(spark, {name: partial(write, name, df) for name, df in dims.items()})
        change.refuse()
        check(written)
        facts = immigrations_fact(decoded, inputs.codes, written)
        check({"immigrations": write("immigrations", facts)})
        change.publish()
    data.vacuum()
    return read_star(spark, out)


def read_star(spark: SparkSession, out: str) -> dict[str, DataFrame]:
    """The seven tables of ``build_immigration``, all of the same commit."""
    data = Dataset(spark, out)
    commit = data.commit()
    return {name: data.read(name, spec.schema, commit) for name, spec in SPECS.items()}


# The folders of the reports.
STATE_REPORT = "most_common_arrival_state"
MONTH_REPORT = "most_common_arrival_months"
NATION_REPORT = "icelander_per_month"


def save_reports(
    tables: Mapping[str, DataFrame],
    out: str,
    n: int = 10,
    nation: str = "ICELAND",
    nation_report: str = NATION_REPORT,
) -> None:
    """The three CSV reports; the third, under ``nation_report``, is about one ``nation``."""
    facts, time = tables["immigrations"], tables["time"]
    load.save_report(top_arrival_states(facts, tables["city"], n), f"{out}/{STATE_REPORT}")
    load.save_report(arrivals_per_month(facts, time), f"{out}/{MONTH_REPORT}")
    theirs = arrivals_per_month_from(facts, time, tables["alien"], nation)
    load.save_report(theirs, f"{out}/{nation_report}")
